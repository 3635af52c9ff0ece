"""Language ID by mixture inference: expectation-maximisation over the languages of each document's words."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE, slices

#: Places of the hashed space of n-grams: three bytes of a word in UTF-8, lower case, with a space before and behind it.
PLACES = 1 << 16
#: Steps of expectation-maximisation, at most, and the change at which a document's end.
STEPS, SMALL = 20, 2e-3
#: What a word's likelihood falls to against the best language's, so that one strange word decides nothing.
FLOOR = 1e-4
#: Bytes that are looked up together.
CHUNK = 1 << 21

LETTER = re.compile(r"[^\W\d_]")
#: Letters of ASCII stay, its other signs are spaces, bytes of other characters stay.
_KEPT = bytes(b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))


def buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each with a space before it and one after the last, and where each begins."""
    raw = [text.lower().encode().translate(_KEPT) for text in texts]
    starts = np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])])
    return np.frombuffer(b" " + b" ".join(raw) + b" ", "u1"), starts


def ngrams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the n-grams' last bytes and their hashed places; ``data`` begins and ends with a space.

    An n-gram ends at each byte of a word and at the space behind it; at a word's first byte it begins with two spaces.
    """
    blank = data == 32
    at = np.flatnonzero(~(blank[1:] & blank[:-1])) + 1
    last, before = data[at].astype("u4"), data[at - 1].astype("u4")
    first = np.where(before == 32, np.uint32(32), data[np.maximum(at - 2, 0)].astype("u4"))
    code = (first << np.uint32(16) | before << np.uint32(8) | last) * np.uint32(0x9E3779B1)
    return at, code >> np.uint32(16)


@dataclass
class Model:
    """Languages in order of name, and for each the log probability of every place."""

    languages: list[str]
    logs: np.ndarray  # places x languages


def train(docs: DataFrame, chosen: F.Column, text_col: str = "text", lang_col: str = "lang") -> Model:
    """N-gram counts of the ``chosen`` documents with a text and a language, all of them, by language.

    Each task sums up its documents and sends a count for each language and place it has seen, which Spark sums; the driver
    gets at most PLACES rows a language.
    """
    rows = docs.filter(chosen & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())

    def count(batches):
        import pyarrow as pa

        totals: dict[str, np.ndarray] = {}
        for part in slices(batches):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(part["lang"], part["text"], strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                total = totals.setdefault(lang, np.zeros(PLACES, "i8"))
                for piece in chunks(buffer(texts)[0]):
                    total += np.bincount(ngrams(piece)[1], minlength=PLACES)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["lang", "place", "n"])

    counted = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInArrow(count, "lang string, place int, n bigint")
    got = counted.groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(got["lang"].unique())
    counts = np.zeros((PLACES, max(1, len(languages))))
    for k, lang in enumerate(languages):
        own = got[got["lang"] == lang]
        counts[own["place"].to_numpy(), k] = own["n"].to_numpy()
    seen = max(1, int((counts.sum(1) > 0).sum()))
    return Model(languages, np.log((counts + 0.5) / (counts.sum(0) + 0.5 * seen)).astype("f4"))


def chunks(data: np.ndarray):
    """Pieces of about CHUNK bytes, cut at spaces, each with a space at both ends."""
    at = 0
    while at < len(data) - 1:
        end = min(at + CHUNK, len(data) - 1)
        if end < len(data) - 1:
            later = np.flatnonzero(data[end : end + CHUNK] == 32)
            end = end + int(later[0]) if len(later) else len(data) - 1
        yield data[at : end + 1]
        at = end


def word_likelihoods(data: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins, and its likelihood under each language as a share of the largest."""
    places, rows, offset = [], [], 0
    for piece in chunks(data):
        at, codes = ngrams(piece)
        first = np.flatnonzero(piece[at - 1] == 32)
        if len(first):
            log = np.add.reduceat(logs[codes], first, axis=0)
            log -= log.max(1, keepdims=True)
            places.append(at[first] + offset)
            rows.append(np.maximum(np.exp(log), np.float32(FLOOR)))
        offset += len(piece) - 1
    if not rows:
        return np.zeros(0, "i8"), np.zeros((0, logs.shape[1]), "f4")
    return np.concatenate(places), np.concatenate(rows)


def mixtures(likelihoods: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Language shares of documents whose words lie end to end, ``counts`` (none of them 0) to a document.

    All documents of a batch step together: the expectation shares each word out among the languages, the maximisation
    averages a document's words. Documents that no longer change leave the batch.
    """
    out = np.full((len(counts), likelihoods.shape[1]), 1 / likelihoods.shape[1], "f4")
    left = np.arange(len(counts))
    for _ in range(STEPS):
        shares = out[left]
        weight = likelihoods * np.repeat(shares, counts, axis=0)
        weight /= weight.sum(1, keepdims=True)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        new = (np.add.reduceat(weight, starts, axis=0) / counts[:, None]).astype("f4")
        out[left] = new
        moving = np.abs(new - shares).max(1) >= SMALL
        if not moving.any():
            break
        if moving.mean() < 0.7:
            likelihoods, left, counts = likelihoods[np.repeat(moving, counts)], left[moving], counts[moving]
    return out


def select(shares: np.ndarray, likelihoods: np.ndarray) -> np.ndarray:
    """True for the languages of one document: the largest is kept, and a smaller one while its words gain more likelihood than the penalty of ln(n)."""
    keep = shares > 0.01
    keep[shares.argmax()] = True
    for k in np.lexsort((-np.arange(len(shares)), shares)):  # of equal ones the later first
        if keep[k] and keep.sum() > 1:
            less = keep.copy()
            less[k] = False
            whole = np.log((likelihoods[:, keep] * (shares[keep] / shares[keep].sum())).sum(1)).sum()
            part = np.log((likelihoods[:, less] * (shares[less] / shares[less].sum())).sum(1)).sum()
            if whole - part < np.log(max(2, len(likelihoods))):
                keep = less
    return keep


def identifier(spark: SparkSession, model: Model):
    """A function of a text column: ``lang_pred, score, languages, shares``.

    ``shares`` are the estimated proportions of ``languages``, the set with the best penalised likelihood;
    ``lang_pred`` has the largest share, which is the score. A text that is null or has no letter is ``und`` with score
    0 and no languages; so is every text if no language was learned. Ties go to the first name.
    """
    shared = spark.sparkContext.broadcast(model)

    def batch(texts: list[str | None]) -> list[tuple]:
        it = shared.value
        out = [("und", 0.0, [], [])] * len(texts)
        at = [i for i, text in enumerate(texts) if it.languages and text and LETTER.search(text)]
        if not at:
            return out
        data, begins = buffer([texts[i] for i in at])
        places, rows = word_likelihoods(data, it.logs)
        starts = np.searchsorted(places, begins)
        counts = np.diff(starts)
        some = counts > 0
        shares = np.full((len(at), len(it.languages)), 1 / len(it.languages), "f4")
        shares[some] = mixtures(rows, counts[some])
        for k, i in enumerate(at):
            own = shares[k].astype("f8")
            if own.max() < 0.99 and counts[k]:
                own = np.where(select(own, rows[starts[k] : starts[k] + counts[k]]), own, 0)
            own /= own.sum()
            best = int(own.argmax())
            chosen = [j for j in np.argsort(-own, kind="stable") if own[j] > 0.01 or j == best]
            out[i] = (it.languages[best], float(min(1.0, own[best])), [it.languages[j] for j in chosen], [float(own[j]) for j in chosen])
        return out

    @F.pandas_udf("lang_pred string, score double, languages array<string>, shares array<double>")
    def languages(texts: pd.Series) -> pd.DataFrame:
        rows = [row for at in range(0, len(texts), SLICE) for row in batch(texts.iloc[at : at + SLICE].to_list())]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "languages", "shares"]).astype({"lang_pred": object})

    return languages


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score, languages, shares`` of every whole text, see ``identifier``.

    Repeated rows and null ids are treated each for itself; other columns are not carried.
    """
    found = docs.select(F.col(id_col), identifier(docs.sparkSession, model)(F.col(text_col)).alias("found"))
    return found.select(id_col, "found.lang_pred", "found.score", "found.languages", "found.shares")
