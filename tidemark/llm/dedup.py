"""MinHash near-duplicates: bottom-k sketches of one hash function, inverted lists, union-sketch filter, exact Jaccard."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, forget, kept, map_rows, table

#: Retained values a document.
SKETCH = 64
#: Probability with which a pair at exactly the threshold may share fewer retained values than are asked for.
MISS = 1e-6
#: Words whose hashes a Python worker remembers.
REMEMBERED = 200_000
#: Lists up to this length pair all their members; longer ones go by hubs first.
SHORT_LIST = 8
#: Members of a long list, and shingles of theirs, that are compared with as many others in one group.
LIST_BLOCK, BLOCK_VALUES = 1024, 4_000_000
#: Rows up to which the ids of documents to verify (8 bytes each) are broadcast.
BROADCAST_ROWS = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Turns unsigned order into signed order.
_TOP = np.uint64(1 << 63)


class WordHashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``words`` words, A-Z in lower case.

    A text with fewer words has its whole sequence as its one shingle; without words the set is empty. Words end at
    space, tab, line feed, vertical tab, form feed and carriage return, as ``bytes.split`` has it.
    """
    tokens = text.encode().lower().split() if text else ()
    if not tokens:
        return np.zeros(0, "u8")
    h = np.fromiter(map(hashes.__getitem__, tokens), "u8", len(tokens))
    n = min(words, len(h))
    count = len(h) - n + 1
    x = np.full(count, n, "u8")
    for k in range(n):
        x = _mixed(x * _MIX + h[k : k + count])
    return np.unique(x)


def jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and of the union of two sorted sets."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared, len(a) + len(b) - shared


def least_shared(size: int, percent: int, miss: float = MISS) -> int:
    """Values that two sketches of ``size`` share at ``percent`` % Jaccard similarity, but for a probability of ``miss``.

    The sketch of the larger set shares Binomial(size, p) values. p is smallest, the similarity itself, where one set holds
    the other (appended or cut copies), so that case sets the bound; sets of equal size share more.
    """
    p, below = percent / 100, 0.0
    for k in range(size):
        below += math.comb(size, k) * p**k * (1 - p) ** (size - k)
        if below > miss:
            return max(1, k)
    return size


def sketches(docs: DataFrame, words: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """``id, n, class, sketch``: set size, digest of the set, and its ``size`` smallest hashes, in signed order."""

    def make():
        hashes = kept("word hashes", WordHashes)

        def function(columns):
            out = {"id": columns["id"], "n": [], "class": [], "sketch": []}
            for text in columns["text"]:
                x = shingle_set(text, words, hashes)
                out["n"].append(len(x))
                out["class"].append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                out["sketch"].append((x[:size] ^ _TOP).view("i8"))
            return out

        return function

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_rows(rows, f"id {kind}, n bigint, class binary, sketch array<bigint>", make)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, sketch: int = SKETCH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every document; links are pairs with Jaccard of at least ``percent`` %.

    1. Documents with equal shingle sets are one class. 2. Each class puts the rarest of its retained values into
    inverted lists, so many that two linked classes share one: what a sketch that holds the whole set must share follows from the
    threshold; of larger sets ``least_shared`` values, which nested sets at the threshold miss with a probability below MISS.
    3. Short lists pair all members, long ones pair all members with their first class.
    4. Pairs whose union sketch shares as large a part are verified on whole sets. 5. Long lists are compared in
    blocks: each class first within a block of its longest list; then all pairs of a list that are still in different
    components, so that none stays untested. Pairs that aren't linked never leave the task that compares them.

    So a group of thousands of near copies costs a few rows a member, and every link between different texts is kept
    in the components. Nothing that grows with the corpus is collected.

    Null and empty texts have n_shingles 0 and are their own components. Repeated rows are copies; a null id takes the
    component of its exact copies (else null), has no other links and is not kept. Other columns are not carried.
    """
    made = table(sketches(docs, words, sketch, id_col, text_col), "sketches")
    classes = made.filter("class is not null").groupBy("class").agg(
        F.min("id").alias("low"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = table(classes, "classes")
    base = table(made.select("id", "n", "class"), "ids")
    forget(made)

    values = classes.select("class", F.explode("sketch").alias("value"))
    shared = values.groupBy("value").count().filter("count > 1").withColumnRenamed("count", "df")
    rows = values.join(shared, "value").join(classes.select("class", "n", F.size("sketch").alias("s")), "class")
    # Values of one class alone are the rarest: they take the first places of its prefix.
    order = Window.partitionBy("class").orderBy("df", "value")
    place = F.row_number().over(order) + F.col("s") - F.count("*").over(Window.partitionBy("class"))
    whole = F.least(F.ceil(F.lit(percent) * F.col("n") / 100), F.lit(sketch) - F.floor((100 - percent) * F.col("n") / percent))
    asked = F.when(F.col("n") <= sketch, whole).otherwise(least_shared(sketch, percent))
    lists = rows.withColumn("place", place).filter(F.col("place") <= F.col("s") - asked + 1)
    lists = table(lists.select("value", "class", "n"), "lists")
    lengths = lists.groupBy("value").agg(F.count("*").alias("length"), F.min("class").alias("first"), F.bit_xor(F.xxhash64("class")).alias("who")).filter("length > 1")
    # Lists of the same classes give the same pairs: one of them is enough.
    lengths = lengths.groupBy("length", "first", "who").agg(F.min("value").alias("value")).drop("who")
    members = lists.join(lengths, "value")

    short = members.filter(F.col("length") <= SHORT_LIST).select("value", "class", "n")
    other = short.select("value", F.col("class").alias("b"), F.col("n").alias("nb"))
    close = F.least("n", "nb") * 100 >= F.greatest("n", "nb") * percent
    pairs = short.join(other, "value").filter(F.col("class") < F.col("b")).filter(close).select(F.col("class").alias("a"), "b")
    long = table(members.filter(F.col("length") > SHORT_LIST).select("value", "class", "n", "first"), "long")
    hubs = long.filter("class <> first").select(F.least("class", "first").alias("a"), F.greatest("class", "first").alias("b"))
    checker = Verifier(docs, base, classes, words, percent, sketch, id_col, text_col)
    near = checker.near(pairs.unionByName(hubs).distinct())
    sets = checker.sets(near, long)
    edges = table(checker.links(near, sets).unionByName(_long_links(long, None, sets, percent, sketch)), "edges")
    forget(near, lists)
    joined = table(components(edges), "components")
    late = table(_long_links(long, joined, sets, percent, sketch), "edges")
    if late.head(1):
        joined = table(components(edges.unionByName(late)), "components")

    named = joined.join(classes.select(F.col("class").alias("node"), "low"), "node")
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    of = named.join(lowest, "root").select(F.col("node").alias("class"), "component")
    facts = table(classes.join(of, "class", "left").select("class", F.coalesce("component", "low").alias("component")), "classes")
    forget(classes, long, sets, edges, late, joined)
    out = base.join(facts, "class", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _long_links(long: DataFrame, joined: DataFrame | None, sets: DataFrame, percent: int, size: int) -> DataFrame:
    """Links ``a, b`` within the long lists (``value, class, n``): enough of them to join what is linked; pairs never leave a task.

    Without components (``joined``) each class goes to its longest list only, and a block of a list is compared within
    itself: that joins most of a group of near copies. With them, every pair of a list whose classes are still in different
    components is compared: all members in blocks meet, block by block, the members outside the list's largest component.
    """
    within = joined is None
    at = [] if within else ["b_block"]
    blocks = F.greatest(F.ceil(F.col("m") / LIST_BLOCK), F.ceil(F.col("bulk") / BLOCK_VALUES)).cast("int")
    if within:
        lengths = long.groupBy("value").agg(F.count("*").alias("length"))
        longest = Window.partitionBy("class").orderBy(F.desc("length"), "value")
        own = long.join(lengths, "value").withColumn("k", F.row_number().over(longest)).filter("k = 1").withColumn("root", F.col("class"))
        dealt = own.select("value", "class", "n", "root")
        loads = dealt.groupBy("value").agg(F.count("*").alias("m"), F.sum("n").alias("bulk")).filter("m > 1").select("value", blocks.alias("blocks"))
        dealt = dealt.join(loads, "value").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).withColumn("asks", F.lit(True)).withColumn("answers", F.lit(True))
    else:
        label = long.join(joined.withColumnRenamed("node", "class"), "class", "left").select("value", "class", "n", F.coalesce("root", "class").alias("root"))
        by_root = label.groupBy("value", "root").agg(F.count("*").alias("m"), F.sum("n").alias("bulk"))
        lists = by_root.groupBy("value").agg(
            F.max_by("root", F.struct("m", "root")).alias("main"), F.count("*").alias("roots"), F.sum("m").alias("m"), F.sum("bulk").alias("bulk")
        ).filter("roots > 1")
        lists = lists.select("value", "main", blocks.alias("blocks"))
        apart = label.join(lists, "value").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        # A member answers each block that asks; within its own block it asks by the same row.
        asking = apart.filter("root <> main").select("value", F.col("block").alias("b_block")).distinct()
        answers = apart.join(asking, "value").withColumn("asks", (F.col("block") == F.col("b_block")) & (F.col("root") != F.col("main"))).withColumn("answers", F.lit(True))
        every = F.sequence(F.lit(0), F.col("blocks") - 1)
        asks = apart.filter("root <> main").withColumn("b_block", F.col("block")).withColumn("block", F.explode(every)).filter("block <> b_block")
        asks = asks.withColumn("asks", F.lit(True)).withColumn("answers", F.lit(False))
        columns = ["value", "block", "b_block", "class", "n", "root", "asks", "answers"]
        dealt = asks.select(*columns).unionByName(answers.select(*columns))
    met = dealt.join(sets, "class").select("value", "block", *at, "class", "root", "asks", "answers", "set")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        asked, others = group[group["asks"].to_numpy(bool)], group[group["answers"].to_numpy(bool)]
        found = linked_pairs(
            [np.frombuffer(x, "u8") for x in asked["set"]], [np.frombuffer(x, "u8") for x in others["set"]],
            asked["root"].to_list(), others["root"].to_list(), percent, size,
        )
        a, b = asked["class"].to_list(), others["class"].to_list()
        return pd.DataFrame([(min(a[i], b[j]), max(a[i], b[j])) for i, j in found], columns=["a", "b"])

    return met.groupBy("value", "block", *at).applyInPandas(compare, "a binary, b binary")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets in ``a`` with all in ``b``, by products of 0/1 matrices of ``width`` values."""
    out = np.zeros((len(a), len(b)), "f4")
    if not a or not b:
        return out
    every = np.concatenate([*a, *b])
    values, codes = np.unique(every, return_inverse=True)
    rows = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    in_a = rows < len(a)
    both = np.zeros(len(values), "u1")
    both[codes[in_a]] |= 1
    both[codes[~in_a]] |= 2
    number = np.cumsum(both == 3) - 1
    stay = both[codes] == 3
    rows, codes = rows[stay], number[codes[stay]]
    order = np.argsort(codes, kind="stable")
    rows, codes = rows[order], codes[order]
    for low in range(0, int(codes[-1]) + 1 if len(codes) else 0, width):
        x, y = np.searchsorted(codes, (low, low + width))
        m = np.zeros((len(a) + len(b), width), "f4")
        m[rows[x:y], codes[x:y] - low] = 1
        out += m[: len(a)] @ m[len(a) :].T
    return out


def linked_pairs(a: list[np.ndarray], b: list[np.ndarray], root_a: list, root_b: list, percent: int, size: int) -> list[tuple[int, int]]:
    """Positions ``i, j`` of linked pairs that join sets of different roots, none of them twice: a forest over the roots.

    The sketches (the ``size`` smallest values) leave out most pairs; of the rest, the sizes of the intersections of the whole
    sets decide. All pairs are counted at once.
    """
    if not a or not b:
        return []
    n_a, n_b = (np.array([len(x) for x in sets]) for sets in (a, b))
    names = {root: k for k, root in enumerate({*root_a, *root_b})}
    of_a, of_b = (np.array([names[r] for r in roots]) for roots in (root_a, root_b))
    able = (of_a[:, None] != of_b[None]) & (np.minimum(n_a[:, None], n_b) * 100 >= np.maximum(n_a[:, None], n_b) * percent)
    if not able.any():
        return []
    both = shared_counts([x[:size] for x in a], [x[:size] for x in b])
    union = np.minimum(size, np.minimum(n_a, size)[:, None] + np.minimum(n_b, size) - both)
    able &= both * size >= union * least_shared(size, percent)
    rows, columns = np.flatnonzero(able.any(1)), np.flatnonzero(able.any(0))
    shared = shared_counts([a[i] for i in rows], [b[j] for j in columns])
    linked = able[np.ix_(rows, columns)] & (100 * shared >= percent * (n_a[rows][:, None] + n_b[columns] - shared))
    up = np.arange(len(names))

    def top(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return int(k)

    found = []
    for k, i in enumerate(rows):
        near = columns[linked[k]]
        for at in np.unique(of_b[near], return_index=True)[1]:
            j = near[at]
            x, y = top(of_a[i]), top(of_b[j])
            if x != y:
                up[x] = y
                found.append((int(i), int(j)))
    return found


class Verifier:
    """Finds the pairs of classes whose whole sets reach the threshold."""

    def __init__(self, docs: DataFrame, base: DataFrame, classes: DataFrame, words: int, percent: int, size: int, id_col: str, text_col: str):
        self.docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        self.base, self.classes, self.words, self.percent, self.size = base, classes, words, percent, size

    def near(self, pairs: DataFrame) -> DataFrame:
        """The ones of ``pairs`` (a, b) whose union sketch is similar enough.

        The ``size`` smallest values of both sketches are a sample of the union, and the share of them that both have estimates the
        Jaccard similarity. Pairs below ``least_shared`` of ``size`` leave.
        """
        side = lambda c, k: self.classes.select(F.col("class").alias(c), F.col("sketch").alias(k))
        near = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
        union = F.slice(F.array_sort(F.array_union("x", "y")), 1, self.size)
        near = near.select("a", "b", F.size(F.array_intersect(F.array_intersect(union, "x"), "y")).alias("both"), F.size(union).alias("of"))
        return table(near.filter(F.col("both") * self.size >= F.col("of") * least_shared(self.size, self.percent)).select("a", "b"), "near")

    def sets(self, near: DataFrame, long: DataFrame) -> DataFrame:
        """``class, set`` of the classes in ``near`` and ``long``, from one text of each, all read in one pass."""
        words = self.words
        wanted = near.select(F.col("a").alias("class")).unionByName(near.select(F.col("b").alias("class"))).unionByName(long.select("class")).distinct()
        some = self.base.filter("class is not null and id is not null").join(wanted, "class", "left_semi").groupBy("class").agg(F.min("id").alias("id"))
        some = table(some, "wanted")
        ids = some.select("id").distinct()
        texts = self.docs.join(F.broadcast(ids) if some.count() <= BROADCAST_ROWS else ids, "id")

        def make():
            hashes = kept("word hashes", WordHashes)

            def function(columns):
                sets = [shingle_set(text, words, hashes).tobytes() for text in columns["text"]]
                return {"class": [hashlib.blake2b(x, digest_size=16).digest() if x else None for x in sets], "set": sets}

            return function

        made = map_rows(texts.select("text"), "class binary, set binary", make)
        made = table(made.join(some.select("class"), "class", "left_semi").groupBy("class").agg(F.first("set").alias("set")), "sets")
        forget(some)
        return made

    def links(self, near: DataFrame, sets: DataFrame) -> DataFrame:
        """The linked ones of ``near``, by their whole sets."""
        percent = self.percent

        def make():
            def function(columns):
                stay = []
                for x, y in zip(columns["x"], columns["y"], strict=True):
                    shared, union = jaccard(np.frombuffer(x, "u8"), np.frombuffer(y, "u8"))
                    stay.append(100 * shared >= percent * union)
                return {"a": columns["a"], "b": columns["b"], "linked": stay}

            return function

        whole = lambda c, k: sets.select(F.col("class").alias(c), F.col("set").alias(k))
        out = map_rows(near.join(whole("a", "x"), "a").join(whole("b", "y"), "b"), "a binary, b binary, linked boolean", make)
        return out.filter("linked").select("a", "b")
