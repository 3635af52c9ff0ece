"""Plans that are proved as few as can be, also where the bounded search stops short."""

import random
from collections import Counter

import pytest

from tidemark.llm import packing


def smallest(pieces, capacity):
    """By trying every place of each piece."""
    best = [len(pieces)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(pieces):
            best[0] = len(rooms)
            return
        for i in {r: i for i, r in enumerate(rooms) if r >= pieces[k]}.values():
            go(k + 1, [r - pieces[k] if j == i else r for j, r in enumerate(rooms)])
        go(k + 1, [*rooms, capacity - pieces[k]])

    go(0, [])
    return best[0]


def holds(kinds, counts, capacity):
    return all(sum(x * n for x, n in f.items()) <= capacity for _, f in kinds) and all(sum(t * f.get(x, 0) for t, f in kinds) == n for x, n in counts.items())


def triples(n, seed, capacity=2048):
    """Lengths of ``n`` hidden sequences of three pieces that are full to the last token."""
    r, counts = random.Random(seed), Counter()
    for _ in range(n):
        a = r.randint(520, 1000)
        b = r.randint(400, capacity - a - 200)
        counts.update((a, b, capacity - a - b))
    return dict(counts)


def test_fewest_from_a_bad_incumbent():
    """From one piece a sequence the search without bounds comes down to the optimum by itself."""
    r = random.Random(8)
    for _ in range(150):
        pieces = sorted((r.choice([r.randint(8, 60), 25, 33]) for _ in range(r.randint(1, 11))), reverse=True)
        counts = dict(Counter(pieces))
        kinds = packing.fewest(counts, 100, [(n, {x: 1}) for x, n in counts.items()])
        assert sum(t for t, _ in kinds) == smallest(pieces, 100) and holds(kinds, counts, 100)


def test_nothing_to_plan():
    assert packing.plan({}, 10, None) == [] and packing.plan({3: 0}, 10, None) == []
    assert packing.plan({10: 5}, 10, None) == [(5, {10: 5 // 5})]


@pytest.mark.parametrize("seed", range(3))
def test_hidden_triples(seed):
    """A few steps leave a sequence too many; without a bound the hidden plan, or one as short, is found."""
    counts = triples(20, seed)
    short, whole = packing.plan(counts, 2048, steps=5), packing.plan(counts, 2048, steps=None)
    assert sum(t for t, _ in short) == 21 and sum(t for t, _ in whole) == 20
    assert holds(short, counts, 2048) and holds(whole, counts, 2048)


def test_beyond_the_bound_of_steps():
    """22 hidden triples for which all steps of the default aren't enough."""
    counts = triples(22, 0)
    assert sum(t for t, _ in packing.plan(counts, 2048)) == 23
    whole = packing.plan(counts, 2048, steps=None)
    assert sum(t for t, _ in whole) == 22 and holds(whole, counts, 2048)
