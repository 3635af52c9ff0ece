"""Quality classifier: naive Bayes support vectors over n-gram indicators, by dual coordinate descent."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, map_rows, table

#: Places of the hashed n-gram space.
PLACES = 1 << 18
#: Labelled documents that are learned from, at most; they are the first by hash of doc_id.
TRAINING_ROWS = 20_000
#: Places of theirs that are learned from, at most (4 bytes each on the driver).
TRAINING_VALUES = 40_000_000
#: Words that a Python worker remembers.
REMEMBERED = 300_000


class _Kinds(dict):
    """The kind of a character: A, a, 0, or itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        self[code] = kind
        return kind


_KINDS = _Kinds()
_AGAIN = re.compile(r"([Aa0])\1+|(.)\2{2,}", re.S)
#: Signs that may stand around a word's letters.
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalpha())


def shape(word: str) -> str:
    """The kinds of characters in a word, runs as one, of a sign as two: ``Abc12.`` is ``Aa0.``, ``of%%%`` is ``a%%``."""
    return _AGAIN.sub(lambda m: m[1] or m[2] * 2, word.translate(_KINDS))


class WordCodes:
    """Two hashed codes of a word, its letters' and its shape's, remembered by number."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.numbers: dict[str, int] = {}
        self.table = np.zeros((4096, 2), "u4")

    def __call__(self, words: list[str]) -> np.ndarray:
        """Rows ``letters, shape`` of the words, as unsigned 32-bit numbers."""
        try:
            return self.table[list(map(self.numbers.__getitem__, words))]
        except KeyError:
            if len(self.numbers) > REMEMBERED:
                self.clear()
        for word in words:
            if word not in self.numbers:
                k = self.numbers[word] = len(self.numbers)
                if k == len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                letters = word.strip(SIGNS).lower()
                self.table[k] = zlib.crc32(b"w" + letters.encode()), zlib.crc32(b"s" + shape(word).encode())
        return self.table[list(map(self.numbers.__getitem__, words))]


def features(text: str | None, codes: WordCodes) -> np.ndarray:
    """Sorted distinct places of a text's n-grams: words, their shapes in ones to threes, and repeats of the word before.

    An empty text has the one place of the empty n-gram.
    """
    words = text.split() if text else []
    if not words:
        return np.array([0], "i8")
    rows = codes(words).astype("u8")
    letters, s = rows[:, 0], rows[:, 1]
    prime = np.uint64(0x100000001B3)
    grams = [letters, s * prime + np.uint64(1)]
    if len(words) > 1:
        two = (s[:-1] * prime) ^ s[1:]
        same = (letters[1:] == letters[:-1]).astype("u8")
        grams += [two * prime + np.uint64(2), same * prime + np.uint64(77), (two[same > 0] * prime) + np.uint64(3)]
        if len(words) > 2:
            grams.append(((two[:-1] * prime) ^ s[2:]) * prime + np.uint64(4))
    x = np.concatenate(grams)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((x >> np.uint64(40)) % np.uint64(PLACES - 1) + np.uint64(1)).astype("i8")


@dataclass
class Model:
    """A weight for each place, and the line that turns a margin into a probability."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, x: np.ndarray) -> float:
        return float(self.weights[x].sum() / np.sqrt(len(x)) + self.bias)

    def score(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -40, 40))))


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, rounds: int = 12, seed: int = 5) -> Model:
    """Log-count ratios of the two classes scale the indicators; a linear hinge-loss model is fitted on the scaled rows.

    Dual coordinate descent: each visit of a row sets its multiplier to the best value within [0, cost] while the
    others stay. Every fifth row is set aside, and a logistic line on their margins gives the scores.
    """
    y = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    test = np.arange(len(rows)) % 5 == 4
    train = np.flatnonzero(~test) if (~test).any() else np.arange(len(rows))
    counts = np.ones((2, PLACES))
    for i in train:
        counts[int(y[i] > 0), rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = [ratio[rows[i]] / np.sqrt(len(rows[i])) for i in range(len(rows))]
    squares = np.array([v @ v + 1 for v in values])
    w, bias, alpha = np.zeros(PLACES), 0.0, np.zeros(len(rows))
    # Costs are balanced, so that the rarer class weighs as much as the other.
    share = max(1e-9, float((y[train] > 0).mean()))
    limit = np.where(y > 0, cost * 0.5 / share, cost * 0.5 / max(1e-9, 1 - share))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(train):
            x, v = rows[i], values[i]
            gradient = y[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / squares[i], 0.0), limit[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[x] += step * v
                bias += step
                alpha[i] = new
    model = Model(w * ratio, bias, 1.0, 0.0)
    held = np.flatnonzero(test) if test.any() else train
    margins, target = np.array([model.margin(rows[i]) for i in held]), (y[held] > 0).astype("f8")
    a, b = 1.0, 0.0
    n1, n0 = target.sum(), len(target) - target.sum()
    target = np.where(target > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(100):  # Newton's steps of a ridge logistic line
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * a, (p - target).sum()])
        q = p * (1 - p)
        h = np.array([[(q * margins**2).sum() + 1e-3, (q * margins).sum()], [(q * margins).sum(), q.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    model.slope, model.offset = max(float(a), 1e-3), float(b)
    return model


def train(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS, training_values: int = TRAINING_VALUES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """The model of at most ``training_rows`` labelled documents, the first by hash; None if both labels aren't there.

    Only the chosen documents' places come to the driver: of one row an id (of several the smallest places), and together
    no more than ``training_values``, again the first by hash.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(training_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "text", "label")

    def make():
        codes = kept("word codes", WordCodes)

        def function(columns):
            return {"id": columns["id"], "label": columns["label"], "x": [features(t, codes).astype("i4").tobytes() for t in columns["text"]]}

        return function

    kind = rows.schema["id"].dataType.simpleString()
    got = map_rows(rows, f"id {kind}, label int, x binary", make).groupBy("id", "label").agg(F.min("x").alias("x"))
    got = table(got, "places")
    upto = F.sum(F.octet_length("x") / 4).over(Window.orderBy(F.xxhash64("id"), "id"))  # one row a chosen document
    few = got.select("id", upto.alias("upto")).filter(F.col("upto") <= training_values).select("id")
    got = got.join(F.broadcast(few), "id").toPandas()
    got = got.assign(h=[zlib.crc32(str(i).encode()) for i in got["id"]]).sort_values(["h", "id", "x"])
    if got["label"].nunique() < 2:
        return None
    return fit([np.frombuffer(x, "i4").astype("i8") for x in got["x"]], got["label"].to_numpy())


def scorer(spark: SparkSession, model: Model | None):
    """A function of a text column: its score from 0 to 1, higher if label 1 is likelier; 0.5 without a model."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        it, codes = shared.value, kept("word codes", WordCodes)
        return pd.Series([it.score(features(text, codes)) if it else 0.5 for text in texts], dtype="f8")

    return scores


def score(docs: DataFrame, model: Model | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` of every document; whole texts.

    Null and empty texts have the score of the empty n-gram. Repeated rows and null ids are scored each for itself;
    other columns are not carried.
    """
    scored = docs.select(F.col(id_col), scorer(docs.sparkSession, model)(F.col(text_col)).alias("score"))
    return scored.select(id_col, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
