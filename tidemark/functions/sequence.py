"""Column functions on sequences and their qualities."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Letters of a batch of texts that are worked on at once.
CELLS = 4_000_000


def letters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def ascii_codes(text: Column) -> Column:
    return F.transform(letters(text), F.ascii)


def solexa_to_phred(q: Column) -> Column:
    return F.round(F.lit(10) * F.log10(F.pow(F.lit(10.0), q / 10.0) + 1), 9)


def quality_trim(reads: DataFrame, score: Callable[[Column], Column], base: int = 33, mean: float = 20.0, most_n: int = 2, least: int = 25) -> DataFrame:
    """Reads cut to the longest prefix whose mean score is at least ``mean``, if it is long enough and has few N.

    Spark works out the score of each code once; batches of reads then look scores up and sum them along their lengths.
    """
    codes = reads.sparkSession.range(2**16).select("id", score(F.col("id").cast("int") - base).cast("double").alias("s")).toPandas()
    table = codes.sort_values("id")["s"].to_numpy("f8")

    @F.pandas_udf("int")
    def kept(quals: pd.Series) -> pd.Series:
        out = np.zeros(len(quals), "i4")
        there = np.flatnonzero(quals.notna().to_numpy())
        sizes = quals.iloc[there].str.len().to_numpy("i8")
        step = max(1, CELLS // max(1, int(sizes.max(initial=1))))
        for begin in range(0, len(there), step):
            some, size = there[begin : begin + step], sizes[begin : begin + step]
            within = np.arange(size.max(initial=0)) < size[:, None]
            scores = np.zeros(within.shape)
            scores[within] = table[np.frombuffer("".join(quals.iloc[some]).encode("utf-32-le"), "u4")]
            good = within & (np.cumsum(scores, 1) >= mean * np.arange(1, within.shape[1] + 1))
            out[some] = np.where(good.any(1), within.shape[1] - good[:, ::-1].argmax(1), 0) if within.shape[1] else 0
        return pd.Series(out).astype("Int32").mask(quals.isna().to_numpy())

    # Not deterministic only in name: so it is worked out once a read, and not again for the filter behind it.
    cut = reads.withColumn("keep", kept.asNondeterministic()(F.col("qual")))
    cut = cut.withColumn("trimmed", F.expr("substr(seq, 1, keep)")).withColumn("tq", F.expr("substr(qual, 1, keep)"))
    return cut.filter((F.col("keep") >= least) & (F.length("trimmed") - F.length(F.translate("trimmed", "N", "")) <= most_n))


def mismatches(a: Column, b: Column) -> Column:
    """Number of places at which two texts of one length differ."""
    return F.size(F.filter(F.zip_with(letters(a), letters(b), lambda x, y: x != y), lambda d: d))


def changes(adaptor: str, most: int, indels: bool = False, five: bool = False, beyond: str = "") -> dict[str, int]:
    """The adaptor and all texts within ``most`` changes of it, with the number of changes: letters replaced by A, C, G, T or N, and with ``indels`` a
    letter left out or put in (not next to an end) with the length kept: a gap draws in ``beyond``, the letter past the adaptor (on the
    left of a 5' adaptor, else on the right), an insertion pushes out the last letter."""
    found = {adaptor: 0}
    for round_ in range(most):
        for text in list(found):
            for p, own in enumerate(text):
                new = [text[:p] + x + text[p + 1 :] for x in "ACGTN" if x != own]
                if indels and 1 < p < len(text) - 2:
                    rest = text[:p] + text[p + 1 :]
                    new.append(beyond + rest if five else rest + beyond)
                    new += [text[:p] + x + text[p : len(text) - 1] for x in "ACGTN"]
                for other in new:
                    found.setdefault(other, round_ + 1)
    return found


def variants(adaptor: str, most: int, indels: bool = False, five: bool = False, beyond: str = "") -> list[str]:
    """The texts of :func:`changes` in order of changes, then letters."""
    found = changes(adaptor, most, indels, five, beyond)
    return sorted(found, key=lambda x: (found[x], x))


def pieces(known: dict[str, int], adaptor: str) -> tuple[str, ...]:
    """Texts of which each of the ``known`` ones holds at least one; '' alone if the adaptor's halves don't do."""
    half = len(adaptor) // 2
    found = (adaptor[:half], adaptor[half:-1])
    return found if all(found) and all(any(p in x for p in found) for x in known) else ("",)


def outermost(seq: str, known: dict[str, int], held: tuple[str, ...], n: int, five: bool) -> tuple[int, int, int] | None:
    """Beginning (from 0), length and changes of the outermost of the ``known`` forms of an adaptor of ``n`` letters: leftmost for 3', rightmost for 5'; lengths n-1, n, n+1 in turn at each place."""
    if not any(p in seq for p in held):
        return None
    places = range(len(seq) - n + 2)
    for i in reversed(places) if five else places:
        for k in (n - 1, n, n + 1):
            found = known.get(seq[i : i + k])
            if found is not None:
                return i, len(seq[i : i + k]), found
    return None


def trim_full(seq: Column, adaptor: str, most: int, five: bool = False, indels: bool = False, beyond: str = "") -> Column:
    """The sequence before the leftmost (3') or behind the rightmost (5') place of an adaptor with at most ``most`` changes."""
    n, known = len(adaptor), changes(adaptor, most, indels, five, beyond)
    held = pieces(known, adaptor)

    def one(text: str | None) -> str | None:
        at = outermost(text, known, held, n, five) if text is not None else None
        return text if at is None else text[at[0] + at[1] :] if five else text[: at[0]]

    @F.pandas_udf("string")
    def rest(texts: pd.Series) -> pd.Series:
        return pd.Series([one(t) for t in texts], dtype=object)

    return rest(seq)


def trim_partial(seq: Column, adaptor: str, least: int, most: Callable[[int], int], five: bool = False) -> Column:
    """The sequence without the longest proper part of the adaptor at its end (a prefix; with ``five`` a suffix at its start), down to ``least`` letters, with at most ``most(k)`` replaced."""
    found = []
    for k in range(len(adaptor) - 1, least - 1, -1):
        part = F.substr(seq, F.lit(1), F.lit(k)) if five else F.substr(seq, F.length(seq) - k + 1, F.lit(k))
        rest = F.substr(seq, F.lit(k + 1)) if five else F.substr(seq, F.lit(1), F.length(seq) - k)
        known = variants(adaptor[-k:] if five else adaptor[:k], most(k))
        found.append(F.when((F.length(seq) >= k) & part.isin(known), rest))
    return F.coalesce(*found, seq)


def trim_tail(seq: Column, adaptor: str, longest: int, five: bool = False) -> Column:
    """The sequence without the longest exact part of the adaptor, of ``longest`` letters or fewer: a prefix at its end, or a suffix at its start."""
    cut = []
    for k in range(longest, 0, -1):
        met = seq.startswith(adaptor[-k:]) if five else seq.endswith(adaptor[:k])
        cut.append(F.when(met, F.substr(seq, F.lit(k + 1)) if five else F.substr(seq, F.lit(1), F.length(seq) - k)))
    return F.coalesce(*cut, seq)


def pair_entropy(seq: Column) -> Column:
    """Entropy to base 16 of the two-letter words of a sequence; the words are listed once, and a word's number is what its removal takes from the list."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(seq) - 1), lambda i: F.substr(seq, i, F.lit(2)))

    def entropy(words: Column) -> Column:
        shares = F.transform(F.array_distinct(words), lambda w: (F.size(words) - F.size(F.array_remove(words, w))) / F.size(words))
        return F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - p * F.log(p) / F.log(F.lit(16.0)))

    # A one-element list binds the words, which a plain expression would list anew for each of them.
    return F.when(F.length(seq) > 1, F.transform(F.array(pairs), entropy)[0]).otherwise(0.0)


def pair_entropies(seq: Column) -> Column:
    """As :func:`pair_entropy`, for tables of many sequences: the words of a batch of sequences are counted together."""

    @F.pandas_udf("double")
    def entropy(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts))
        there = np.flatnonzero((texts.str.len() > 1).fillna(False).to_numpy(bool))
        begin = 0
        while begin < len(there):
            sizes = texts.iloc[there[begin : begin + 10_000]].str.len().to_numpy("i8")
            some = there[begin : begin + max(1, int(np.searchsorted(np.cumsum(sizes), CELLS)))][: len(sizes)]
            size = sizes[: len(some)]
            codes = np.frombuffer("".join(texts.iloc[some]).encode("utf-32-le"), "u4").astype("u8")
            row, ends = np.repeat(np.arange(len(some)), size), np.cumsum(size) - 1
            pair = codes[:-1] << np.uint64(21) | codes[1:]
            same = np.delete(np.arange(len(codes)), ends)  # a text's last letter begins no word
            kinds, number = np.unique(pair[same], return_inverse=True)
            found, n = np.unique(row[same] * len(kinds) + number, return_counts=True)
            of = found // max(1, len(kinds))
            share = n / (size[of] - 1)
            out[some] = np.bincount(of, -share * np.log(share) / np.log(16.0), len(some))
            begin += len(some)
        return pd.Series(out)

    return entropy(seq)


def tag_code(seq: Column) -> Column:
    """1 for a tag shorter than 14, 2 for more than two N, 3 for low entropy of letter pairs, else 0."""
    low = F.round(pair_entropies(seq) / 0.9770337, 9) < 0.5
    return F.when(F.length(seq) < 14, 1).when(F.length(seq) - F.length(F.translate(seq, "N", "")) > 2, 2).when(low, 3).otherwise(0)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTRYKMBVDHN", "TGCAYRMKVBHDN"))


def normalise(seq: Column) -> Column:
    return F.regexp_replace(F.translate(seq, "abcdefghijklmnopqrstuvwxyzU", "ABCDEFGHIJKLMNOPQRSTTVWXYZT"), "[^ACGT]", "N")


def describe(query: Column, target: Column) -> Column:
    """An alignment as differences from its target: runs of matches as ``5M``, a differing letter itself, ``D`` and the target's letter where the query has a gap, ``I`` and the query's where the target has one.

    ``query`` and ``target`` are rows of an alignment, of one length, with ``-`` for gaps.
    """

    def one(q: str, t: str) -> str:
        out, run = [], 0
        for a, b in zip(q, t):  # noqa: B905
            if a == b:
                run += 1
                continue
            if run:
                out.append(f"{run}M")
                run = 0
            out.append("D" + b if a == "-" else "I" + a if b == "-" else a)
        return " ".join([*out, f"{run}M"] if run else out)

    @F.pandas_udf("string")
    def described(queries: pd.Series, targets: pd.Series) -> pd.Series:
        return pd.Series([one(q, t) if q is not None and t is not None else None for q, t in zip(queries, targets, strict=True)], dtype=object)

    return described(query, target)


def restore(target: Column, description: Column) -> Column:
    """The query without its gaps, from its differences and the target without its gaps."""

    def one(text: str, description: str) -> str:
        out, at = [], 0
        for part in description.split(" "):
            if part[-1:] == "M" and part[:-1].isdecimal():
                out.append(text[at : at + int(part[:-1])])
                at += int(part[:-1])
            elif len(part) == 2 and part[0] == "I":
                out.append(part[1:])
            elif part:
                out.append("" if len(part) == 2 and part[0] == "D" else part)
                at += 1
        return "".join(out)

    @F.pandas_udf("string")
    def restored(texts: pd.Series, descriptions: pd.Series) -> pd.Series:
        return pd.Series([one(t, d) if t is not None and d is not None else None for t, d in zip(texts, descriptions, strict=True)], dtype=object)

    return restored(target, description)


def chunks(sequences: DataFrame, size: int, halo: int, id_col: str = "doc_id", seq_col: str = "seq") -> DataFrame:
    """``id_col, origin, seq_col``: sequences in chunks of ``size`` letters, each with up to ``halo`` letters of the next; those without letters have no row."""
    n = F.length(seq_col)
    rows = sequences.filter(n > 0).select(id_col, seq_col, F.explode(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int"))).alias("_k"))
    return rows.select(id_col, (F.col("_k") * size).alias("origin"), F.substr(seq_col, F.col("_k") * size + 1, F.lit(size + halo)).alias(seq_col))
