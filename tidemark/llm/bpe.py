"""Byte-level BPE encoding and decoding with a segment tree over byte positions."""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, map_rows

#: Unicode's White_Space characters: what ``\s`` means to the public encoders (Python's ``regex`` adds four controls).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Pieces that a Python worker remembers, twice over, and the length from which a piece is encoded anew each time.
REMEMBERED, LONGEST = 300_000, 64
NO_PAIR = 1 << 62


def split_pattern(pattern: str) -> regex.Pattern:
    """The pattern with White_Space written out."""
    return regex.compile(
        pattern.replace("[^\\s", f"[^{WHITE}").replace("\\s", f"[{WHITE}]").replace("\\S", f"[^{WHITE}]")
    )


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merge the leftmost pair of lowest rank until no pair has a rank.

    Leaf i of the tree holds ``rank * n + i`` for the pair that begins at byte i, so the root is the leftmost minimum.
    A merge changes three leaves (its own, its right neighbour's, its left neighbour's), each in O(log n).
    """
    if not piece:
        return []
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    tree = [NO_PAIR] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        if (rank := get(piece[i : i + 2])) is not None:
            tree[size + i] = rank * n + i
    for k in range(size - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left < right else right

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        while k > 1:
            other = tree[k ^ 1]
            if other < value:
                value = other
            k >>= 1
            if tree[k] == value:
                return
            tree[k] = value

    end, before = list(range(1, n + 1)), list(range(-1, n))
    while (best := tree[1]) < NO_PAIR:
        i = best % n
        right = end[i]
        stop = end[i] = end[right]
        put(right, NO_PAIR)
        if stop < n:
            before[stop] = i
            rank = get(piece[i : end[stop]])
            put(i, NO_PAIR if rank is None else rank * n + i)
        else:
            put(i, NO_PAIR)
        if i:
            left = before[i]
            rank = get(piece[left:stop])
            put(left, NO_PAIR if rank is None else rank * n + left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Pieces(dict):
    """Packed ids of pieces, remembered; when the memory is full, what wasn't met since it last was is forgotten."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.before = ranks, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
            if len(piece) >= LONGEST:
                return ids
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def rank_encoder(ranks: dict[bytes, int], pattern: str) -> Callable[[str], bytes]:
    """An encoder of texts to packed ids for ranks and a split pattern."""
    split, pieces = split_pattern(pattern), Pieces(ranks)
    return lambda text: b"".join(map(pieces.__getitem__, split.findall(text)))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", packed: bool = False) -> DataFrame:
    """``id_col, ids`` of every text: array<int>, or little-endian unsigned 32-bit integers in a binary if ``packed``.

    A null or empty text has no ids. Rows with equal or null ids are encoded each for itself; other columns, whatever
    their names, are not carried. Whole texts of any length: a piece of n bytes takes O(n log n).
    The driver reads the vocabulary (its size doesn't depend on the data) and broadcasts it.
    """
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))
    key = (ranks_path, pattern)

    def make():
        words = kept(key, lambda: rank_encoder(*shared.value))

        def function(columns):
            ids = [words(text) if text else b"" for text in columns["text"]]
            return {"id": columns["id"], "ids": ids if packed else [np.frombuffer(x, "<u4").astype("i4") for x in ids]}

        return function

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_rows(rows, f"id {kind}, ids {'binary' if packed else 'array<int>'}", make).withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, ids, decoded``: the bytes of each row's ids, an array<int> or a packed binary.

    Null ids decode to no bytes; an id outside the vocabulary fails the task.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        ranks = shared.value
        words = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            words[rank] = token

        def function(columns):
            out = []
            for ids in columns["ids"]:
                if isinstance(ids, bytes):
                    ids = np.frombuffer(ids, "<u4").tolist()
                out.append(b"".join(map(words.__getitem__, ids or ())))
            return {"id": columns["id"], "ids": columns["ids"], "decoded": out}

        return function

    kinds = [df.schema[c].dataType.simpleString() for c in (id_col, ids_col)]
    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    out = map_rows(rows, f"id {kinds[0]}, ids {kinds[1]}, decoded binary", make)
    return out.select(F.col("id").alias(id_col), F.col("ids").alias(ids_col), "decoded")
