"""Candidates of the license scan come from the templates alone and miss no match."""

import random

import pytest

from tidemark.llm import licenses


def edited(r, own, changes):
    """``own`` with as many changed words: replaced, missing or added ones, alone or in stretches."""
    out = list(own)
    while changes:
        size = r.randint(1, min(changes, 4))
        at, kind = r.randrange(len(out) + 1), r.choice("rda")
        size = min(size, len(out) - at) if kind != "a" else size
        if size:
            out[at : at + (size if kind != "a" else 0)] = [r.choice(["the", "of", "new"]) for _ in range(size)] if kind != "d" else []
            changes -= size
    return out


@pytest.mark.parametrize("tolerance", [0, 0.25, 0.6])
def test_no_match_without_a_place(tolerance):
    """Any text within the tolerance of a template has a place within its words, whatever words were changed."""
    r = random.Random(5)
    letters = [f"w{k}" for k in range(6)]
    for _ in range(3000):
        own = [r.choice(letters) for _ in range(r.randint(1, 40))]
        most = int(tolerance * len(own))
        match = edited(r, own, r.randint(0, most))
        if not match:
            continue
        before = ["x"] * r.randrange(5)
        places = licenses.Seeds({"t": own}, tolerance).places([*before, *match, *["x"] * r.randrange(5)])
        assert any(len(before) <= p < len(before) + len(match) for p in places)


def test_all_places_give_the_same_rows(spark, monkeypatch):
    """Judging at every word (brute force) finds what the places find: notices, near and half ones, in long and short texts."""
    r = random.Random(6)
    names, noise = sorted(licenses.TEMPLATES), "the of and to use this code license permission under a file".split()
    texts = []
    for k in range(30):
        parts = []
        for _ in range(r.randint(1, 4)):
            own = licenses.TEMPLATES[r.choice(names)].split()
            parts += [r.choice(noise) for _ in range(r.randrange(20))] + edited(r, own, r.randint(0, max(1, int(0.35 * len(own)))))
        texts.append(" ".join(parts))
    texts += [None, "", "no words of any", "this licence lets you redistribute with permission"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)

    def key(df):
        return sorted((x["doc_id"], x["license"], x["n_changed"], x["matched"]) for x in df.collect())

    got = key(licenses.scan(docs))
    assert len(got) > 25 and {x[0] for x in got} <= set(range(30))
    monkeypatch.setattr(licenses.Seeds, "places", lambda self, own: list(range(len(own))))
    monkeypatch.setattr(licenses, "STRIDE", 1)
    brute = licenses.finder(licenses.TEMPLATES, licenses.TOLERANCE)
    want = sorted((doc, *x[1:2], x[3], x[5]) for doc, text in enumerate(texts[:12]) for x in brute(text or ""))
    assert [x for x in got if x[0] < 12] == want


def test_other_spellings_and_own_templates(spark):
    """No word list decides what is looked at: "licence" for "license", and templates with words of any kind."""
    texts = [licenses.TEMPLATES["Apache-2.0"].replace("icense", "icence"), "see: nothing to see here, really", "nothing"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = {**licenses.TEMPLATES, "own": "nothing to see here"}
    got = [(r["doc_id"], r["license"], r["n_changed"]) for r in licenses.scan(docs, own).collect()]
    assert sorted(got) == [(0, "Apache-2.0", sum("icence" in w for w in licenses.words(texts[0]))), (1, "own", 0)]
    for bad in (-0.1, 1.0):
        with pytest.raises(ValueError):
            licenses.scan(docs, tolerance=bad)


def test_near_notices(spark):
    """A long text of notices just beyond the tolerance is judged once a stride, and has no rows."""
    own = licenses.TEMPLATES["MIT"].split()
    near = " ".join(w if k % 3 else f"{w}x" for k, w in enumerate(own))
    docs = spark.createDataFrame([(1, "\n".join([near] * 500)), (2, "\n".join([near] * 20 + [licenses.TEMPLATES["MIT"]]))], "doc_id long, text string")
    assert [(r["doc_id"], r["license"], r["n_changed"]) for r in licenses.scan(docs).collect()] == [(2, "MIT", 0)]
