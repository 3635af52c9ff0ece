"""Fingerprints against a plain one-permutation MinHash, their estimates against exact similarities, and next rows against a sort."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import dedup, fingerprints, queries


def plain(shingles, bins, bits):
    """Bin by bin, and each empty bin asks the bins in its own order."""
    least = {}
    for x in shingles.tolist():
        b = x >> (64 - bins.bit_length() + 1)
        least[b] = min(x, least.get(b, x))
    order, _ = fingerprints._probes(bins)
    out = []
    for b in range(bins):
        v = least[b] if b in least else next(least[int(p)] for p in order[b] if int(p) in least)
        mixed = fingerprints._mixed(np.array([(v + b * int(dedup._MIX)) % 2**64], "u8"))
        out.append(int(mixed[0]) & ((1 << bits) - 1))
    return out


def test_bins():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 16, 17, 40, 200, 3000):
        for bins, bits in ((512, 4), (64, 8), (128, 1), (2, 2)):
            x = np.unique(rng.integers(0, 2**63, n, dtype="u8") * np.uint64(2))
            got = fingerprints.one_permutation(x, bins, bits)
            assert got.tolist() == plain(x, bins, bits)
            text = fingerprints.packed(got, bits)
            assert len(text) == -(-bins * bits // 8) * 2 and fingerprints.estimate(text, text, bits) == 1


def test_estimates():
    """Unbiased within three standard errors, for many and for few shingles; unrelated single shingles aren't alike."""
    rng = np.random.default_rng(5)
    for n, shared in ((4000, 3000), (4000, 400), (300, 240), (30, 15), (4000, 0)):
        off = []
        for _ in range(60):
            x = np.unique(rng.integers(0, 2**64, 2 * n - shared, dtype="u8"))
            rng.shuffle(x)
            a, b = np.sort(x[:n]), np.sort(x[n - shared :])
            off.append(fingerprints.estimate(*(fingerprints.packed(fingerprints.one_permutation(s)) for s in (a, b))) - shared / (2 * n - shared))
        assert abs(np.mean(off)) < 3 * np.std(off) / 60**0.5 + 0.01 and np.std(off) < 0.03 + 0.6 / n**0.5
    one = [fingerprints.packed(fingerprints.one_permutation(np.array([x], "u8"))) for x in rng.integers(0, 2**64, 30, dtype="u8")]
    assert max(fingerprints.estimate(a, b) for a in one for b in one if a != b) < 0.1
    assert fingerprints.estimate("", "") == 1 and fingerprints.estimate("", one[0]) == 0 and fingerprints.estimate(None, one[0]) is None


def test_next_rows(spark, monkeypatch):
    """Over many parts: gaps, negative ids, repeated ids, null ids; each row's next is that of a sort."""
    monkeypatch.setattr(fingerprints, "PART_BYTES", 2_000)
    rng = random.Random(1)
    ids = rng.sample(range(-(10**6), 10**6), 400) + [2**62, -(2**62)]
    rows = [(i, f"text {i} " * rng.randrange(1, 12)) for i in ids] + [(None, "alone"), (None, "alone"), (None, None)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, part string, next_text string").repartition(7)
    got = fingerprints.with_next(df, {"n": F.length("text")}).collect()
    assert len(got) == len(rows)
    ordered = sorted(r for r in rows if r[0] is not None)
    after = {i: ordered[(k + 1) % len(ordered)][1] for k, (i, _) in enumerate(ordered)}
    for r in got:
        if r["id"] is None:
            assert r["next_text"] is None and r["text"] in ("alone", "")
        else:
            assert r["next_text"] == after[r["id"]] and r["next_n"] == len(after[r["id"]])
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, None)], "doc_id long, text string")
    found = sorted((r["id"], r["text"], r["next_text"]) for r in fingerprints.with_next(twice).collect())
    assert [x[:2] for x in found] == [(1, "a"), (1, "b"), (1, "b"), (2, "")] and sorted(x[2] for x in found) == ["", "a", "b", "b"]
    alone = fingerprints.with_next(spark.createDataFrame([(5, "me")], "doc_id long, text string")).collect()
    assert [(r["id"], r["next_text"]) for r in alone] == [(5, "me")]
    assert fingerprints.with_next(twice.limit(0)).count() == 0


def test_query(spark, tmp_path):
    """Edited texts and their fingerprints, with wide characters, empty and null texts and equal neighbours."""
    rng = random.Random(4)
    make = lambda n: " ".join("".join(rng.choice("aeiouß𝄞dnt") for _ in range(5)) for _ in range(n))
    rows = [(i, make(rng.choice([1, 3, 80, 200, 600]))) for i in range(0, 120, 3)] + [(1, None), (4, ""), (7, "𝄞𝄞𝄞𝄞𝄞"), (10, "x")]
    rows += [(200, rows[5][1]), (201, rows[5][1])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op12_one_permutation_fingerprint(spark, str(tmp_path)).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(rows)
    texts = dict(ordered)
    for k, (i, t) in enumerate(ordered):
        follow, tail = ordered[(k + 1) % len(ordered)][1], len(t) // 4
        edited = t[: len(t) - tail] + follow[:tail]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (dedup.shingle_set(x, 5, dedup.WordHashes()) for x in (t, edited, follow))
        for name, x in (("fingerprint", a), ("edited_fingerprint", b)):
            assert r[name] == (fingerprints.packed(fingerprints.one_permutation(x)) if len(x) else "")
        for name, x in (("near_edited", b), ("near_next", c)):
            both, either = dedup.jaccard(a, x)
            assert abs(r[name] - (both / either if either else 1)) < 0.12
    assert got[200]["fingerprint"] == got[201]["fingerprint"] and got[200]["near_next"] == 1 and texts[200] == texts[201]
