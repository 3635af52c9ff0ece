"""Adaptors removed from tags as one chain of steps, and its report."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import changes, outermost, pieces, tag_code


@dataclass
class Chain:
    """Both adaptors ('' for none) and the limits of the steps.

    1. ``full``: the whole adaptor with at most ``most`` changes, the rightmost place for the 5' one, then, in what is left, the leftmost for the 3' one. 2. ``inexact``, only on a side without the first: the longest
    proper part at the tag's own end with one change from ``one`` letters on and two from ``two`` on. 3. ``exact``, only on a side without either: the longest shorter part.
    """

    five: str = ""
    three: str = ""
    one: int = 7
    two: int = 10
    most: int = 1
    indels: bool = True
    full: dict = field(init=False)
    part: dict = field(init=False)
    held: dict = field(init=False)

    def __post_init__(self):
        sides = {5: self.five, 3: self.three}
        self.full = {side: changes(a, self.most, self.indels, side == 5, "") if a else {} for side, a in sides.items()}
        self.held = {side: pieces(self.full[side], a) for side, a in sides.items()}
        self.part = {side: {k: self._part(side, a, k) for k in range(len(a) - 1, self.one - 1, -1)} for side, a in sides.items()}

    def _part(self, side: int, adaptor: str, k: int) -> dict[str, int]:
        text, beyond = (adaptor[-k:], adaptor[-k - 1]) if side == 5 else (adaptor[:k], adaptor[k])
        return changes(text, 2 if k >= self.two else 1, self.indels, side == 5, beyond)

    def _place(self, seq: str, side: int) -> tuple[int, int, int] | None:
        """Beginning, length and changes of the outermost full adaptor; at one place the shortest length counts."""
        n, known = len(self.five if side == 5 else self.three), self.full[side]
        if not n:
            return None
        return outermost(seq, known, self.held[side], n, side == 5)

    def _end(self, seq: str, side: int) -> tuple[int, str, int] | None:
        """Length, kind and changes of the part at the tag's end."""
        adaptor = self.five if side == 5 else self.three
        own = (lambda k: seq[:k]) if side == 5 else (lambda k: seq[len(seq) - k :] if k <= len(seq) else "")
        for k, known in self.part[side].items():
            found = known.get(own(k))
            if found is not None:
                return k, "inexact", found
        for k in range(min(self.one - 1, len(adaptor)), 0, -1):
            if own(k) == (adaptor[-k:] if side == 5 else adaptor[:k]):
                return k, "exact", 0
        return None

    def __call__(self, seq: str) -> tuple:
        """``trimmed``, and for the 5' and the 3' side first and last place (from 1, in ``seq``), kind and changes, or four nulls."""
        begin, end, none = 0, len(seq), (None, None, None, None)
        sides = {5: none, 3: none}
        if found := self._place(seq, 5):
            begin = found[0] + found[1]
            sides[5] = (found[0] + 1, begin, "full", found[2])
        if found := self._place(seq[begin:], 3):
            end = begin + found[0]
            sides[3] = (end + 1, end + found[1], "full", found[2])
        if sides[5] is none and self.five and (found := self._end(seq[begin:end], 5)):
            begin = found[0]
            sides[5] = (1, begin, *found[1:])
        if sides[3] is none and self.three and (found := self._end(seq[begin:end], 3)):
            sides[3] = (end - found[0] + 1, end, *found[1:])
            end -= found[0]
        return (seq[begin:end], *sides[5], *sides[3])


_SIDE = "{s}_from int, {s}_to int, {s}_kind string, {s}_changes int"


def trim_chain(seq: Column, chain: Chain) -> Column:
    """The chain's result on each tag, as a struct; dictionaries of the adaptors' variants make a step one lookup a place and length."""
    schema = f"trimmed string, {_SIDE.format(s='five')}, {_SIDE.format(s='three')}"
    names = [c.split()[0] for c in schema.split(", ")]
    whole = {c for c in names if c.endswith(("from", "to", "changes"))}

    @F.pandas_udf(schema)
    def run(tags: pd.Series) -> pd.DataFrame:
        rows = [chain(t) if t is not None else (None,) * 9 for t in tags]
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pd.DataFrame({c: pd.array(x, dtype="Int32") if c in whole else pd.Series(x, dtype=object) for c, x in zip(names, columns, strict=True)})

    return run.asNondeterministic()(seq)  # in name only: so the steps above it don't work it out again


def trimmed_tags(tags: DataFrame, chain: Chain, least_five: int = 0, least_three: int = 0) -> DataFrame:
    """``seq, id, n`` of distinct tags with the chain's columns and ``fate``, before equal results become one.

    ``tags`` has ``seq, id, n``; equal tags are one with the sum of n and the smallest id, so each is trimmed once. ``fate`` is ``five_short`` or ``three_short`` if what was removed there is shorter than
    ``least_five``, ``least_three`` (a side without adaptor counts as 0), else ``cleaned``.
    """
    unique = tags.groupBy("seq").agg(F.min("id").alias("id"), F.sum("n").alias("n"))
    rows = unique.withColumn("t", trim_chain(F.col("seq"), chain)).select("seq", "id", "n", "t.*")
    length = lambda s: F.coalesce(F.col(f"{s}_to") - F.col(f"{s}_from") + 1, F.lit(0))
    return rows.withColumn("fate", F.when(length("five") < least_five, "five_short").when(length("three") < least_three, "three_short").otherwise("cleaned"))


def cleaned_tags(trimmed: DataFrame) -> DataFrame:
    """``seq, id, n, code`` of what is left of cleaned tags: equal ones are one, ``code`` as in ``tag_code`` (0 passes)."""
    rows = trimmed.filter("fate = 'cleaned'").groupBy(F.col("trimmed").alias("seq")).agg(F.min("id").alias("id"), F.sum("n").alias("n"))
    return rows.withColumn("code", tag_code(F.col("seq")))


def trimming_report(trimmed: DataFrame) -> DataFrame:
    """``counter, n, percent``: reads by what was removed on each side, by fate and by filter, with the distinct tags before and after; percent of all reads. Counters without reads are 0."""
    sides = [(s, k, f"{s}_{k}") for s in ("five", "three") for k in ("full", "inexact", "exact")]
    one = trimmed.agg(
        F.sum("n").alias("input"), F.count("*").alias("unique_input"), *[F.sum(F.when(F.col(f"{s}_kind") == k, F.col("n"))).alias(name) for s, k, name in sides],
        *[F.sum(F.when(F.col(f"{s}_kind").isNotNull(), F.col("n"))).alias(f"{s}_any") for s in ("five", "three")], *[F.sum(F.when(F.col("fate") == f, F.col("n"))).alias(f) for f in ("five_short", "three_short")],
        F.count_if(F.col("fate") != "cleaned").alias("dropped"),
    )
    codes = {"too_short": 1, "too_many_n": 2, "low_entropy": 3, "passed": 0}
    two = cleaned_tags(trimmed).agg(F.count("*").alias("unique"), *[F.sum(F.when(F.col("code") == c, F.col("n"))).alias(name) for name, c in codes.items()])
    both = one.join(F.broadcast(two)).withColumn("unique_output", F.col("unique") + F.col("dropped"))
    names = ["input", "unique_input", *[x[2] for x in sides], "five_any", "three_any", "unique_output", "five_short", "three_short", *codes]
    rows = both.select("input", F.explode(F.array(*[F.struct(F.lit(c).alias("counter"), F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias("n")) for c in names])).alias("r"))
    return rows.select("r.counter", "r.n", F.round(100.0 * F.col("r.n") / F.col("input"), 6).alias("percent"))
