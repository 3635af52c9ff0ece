"""Document fingerprints by one-permutation MinHash, and each row's next row in the order of its ids."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept
from .dedup import _MIX, WordHashes, _mixed, shingle_set

#: Bins of a fingerprint and bits that each keeps.
BINS, BITS = 512, 4
#: Bytes of text that :func:`with_next` sorts in one part, and the most parts (bounds kept by the driver) it makes.
PART_BYTES, MOST_PARTS = 1 << 20, 65_536
#: Ids that the driver looks at for one bound.
IDS_A_BOUND = 30


@cache
def _probes(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Each bin's random order of all bins, and the place of each bin in it: the same for every document."""
    own = np.arange(bins, dtype="u8")
    order = np.argsort(_mixed(own[:, None] * np.uint64(bins) + own[None] + _MIX), axis=1, kind="stable")
    return order.astype("i4"), np.argsort(order, axis=1, kind="stable").astype("i4")


def one_permutation(shingles: np.ndarray, bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """The low bits of each bin's least hash, of sorted distinct 64-bit hashes (at least one).

    High bits of a hash name its bin, so each is looked at once. An empty bin takes the hash of the first full
    one in its own random order of the bins (optimal densification: each full one is equally likely, and the choice is
    that of every other document in which the same are full). What is kept are the low bits of the hash mixed with the bin's number, so
    copies of one hash agree with another document's by chance in each bin for itself.
    """
    numbers = (shingles >> np.uint64(64 - bins.bit_length() + 1)).astype("i8") if bins > 1 else np.zeros(len(shingles), "i8")
    first = np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1])))
    full = np.zeros(bins, bool)
    full[numbers[first]] = True
    least = np.zeros(bins, "u8")
    least[numbers[first]] = shingles[first]
    empty = np.flatnonzero(~full)
    if len(empty):
        order, place = _probes(bins)
        source = np.flatnonzero(full)
        if len(source) <= 16:
            least[empty] = least[source[place[np.ix_(empty, source)].argmin(1)]]
        else:
            at, step = empty, 0
            while len(at):
                asked = order[at, step]
                hit = full[asked]
                least[at[hit]] = least[asked[hit]]
                at, step = at[~hit], step + 1
    return (_mixed(least + np.arange(bins, dtype="u8") * _MIX) & np.uint64((1 << bits) - 1)).astype("u1")


def packed(values: np.ndarray, bits: int = BITS) -> str:
    """Hexadecimal digits of values of ``bits`` bits, side by side."""
    return np.packbits((values[:, None] >> np.arange(bits - 1, -1, -1, dtype="u1")) & 1).tobytes().hex()


def estimate(a: str | None, b: str | None, bits: int = BITS) -> float | None:
    """Estimated Jaccard similarity of two fingerprints: the share of bins that agree, less what agrees by chance, within 0 to 1.

    Two empty fingerprints (no words) are alike, an empty one and another aren't.
    """
    if a is None or b is None:
        return None
    if not a or not b or a == b:
        return float(a == b)
    x, y = (np.unpackbits(np.frombuffer(bytes.fromhex(f), "u1")) for f in (a, b))
    agree = float((~(x != y).reshape(-1, bits).any(axis=1)).mean())
    chance = 0.5**bits
    return max(0.0, (agree - chance) / (1 - chance))


def fingerprint(text: Column, words: int = 5, bins: int = BINS, bits: int = BITS) -> Column:
    """Fingerprint of a whole text: ``bins`` (a power of two) times ``bits`` (1, 2, 4 or 8) as hexadecimal digits.

    Shingles are ``words`` words, A-Z in lower case; fewer words are one shingle. Equal texts have equal fingerprints. Without words
    (null, empty and blank texts) it is the empty string.
    """

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        hashes = kept("word hashes", WordHashes)

        def one(text: str | None) -> str:
            shingles = shingle_set(text, words, hashes)
            return packed(one_permutation(shingles, bins, bits), bits) if len(shingles) else ""

        return pd.Series([one(x) for x in texts], dtype=object)

    return made(text)


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """:func:`estimate` of two columns of fingerprints; null if either is null."""

    @F.pandas_udf("double")
    def made(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([estimate(x, y, bits) for x, y in zip(left, right, strict=True)], dtype="f8")

    return made(a, b)


def with_next(docs: DataFrame, more: dict[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, next_text`` and for each column of ``more`` its own and ``next_`` value: the next row in ascending id, after the last the first.

    Rows of one id follow each other by a hash of their text; equal rows may stand for each other. Rows with a null id have no next
    (nulls) and aren't moved; a null text counts as empty; a single row is its own next. Other columns are not carried.

    Texts move once: ids are cut into parts by bounds from a sample (by hash; it decides the sizes of the parts only), parts are sorted as tasks of their own, and the first rows
    of a part go to the end of the part before it as well. The driver sees one bound and one first id a part.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = base.filter("id is not null")
    n_bytes, n_rows = known.agg(F.sum(F.octet_length("text") + 64), F.count("*")).first()
    parts = int(min(MOST_PARTS, max(1, -(-(n_bytes or 0) // PART_BYTES)), max(1, n_rows)))
    share = min(1.0, IDS_A_BOUND * parts / max(1, n_rows))
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    seen = np.sort(np.array([r["id"] for r in chosen.select("id").collect()], "i8"))
    bounds = np.unique(seen[[len(seen) * k // parts for k in range(1, parts)]]) if len(seen) else seen
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, ids.to_numpy(), side="right"), dtype="i4")

    firsts = sorted(tuple(r) for r in known.select("id", part("id").alias("part")).groupBy("part").agg(F.min("id")).collect())
    before = [(first, firsts[k - 1][0]) for k, (_, first) in enumerate(firsts)]
    before = docs.sparkSession.createDataFrame(before, "id long, before int")
    here = F.struct(F.col("part"), F.lit(False).alias("copy"))
    both = F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, F.struct(F.col("before").alias("part"), F.lit(True).alias("copy"))))
    placed = known.withColumn("part", part("id")).join(F.broadcast(before), "id", "left").withColumn("to", F.explode(both))
    rows = placed.select("to.part", "to.copy", "id", "text", *[c.alias(k) for k, c in _columns(more)])
    order = Window.partitionBy("part").orderBy("copy", "id", F.xxhash64("text"))
    follow = [F.lead(c).over(order).alias(f"next_{c}") for c in ("text", *(more or ()))]
    sorted_ = rows.select("*", *follow).filter("not copy").drop("part", "copy")
    alone = base.filter("id is null").select("id", "text", *[c.alias(k) for k, c in _columns(more)])
    return sorted_.unionByName(alone, allowMissingColumns=True)


def _columns(more: dict[str, Column] | None) -> Iterable[tuple[str, Column]]:
    return (more or {}).items()


def replaced_end(text: Column, other: Column, share: int = 4) -> Column:
    """The text whose last 1/``share`` code points (rounded down) are replaced by as many, or all, first ones of ``other`` (null: none)."""
    n = F.char_length(text)
    tail = F.floor(n / share).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - tail), F.coalesce(F.substring(other, F.lit(1), tail), F.lit("")))
