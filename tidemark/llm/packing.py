"""Best-fit packing of tokenised documents by bin completion over the histogram of piece lengths."""

from __future__ import annotations

import json
import math
import os
import sys
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, map_rows, table

#: Steps of the search beyond the incumbent; the incumbent stays when they are used up.
SEARCH_STEPS = 4_000
#: Fillings tried around one largest document, and steps of their enumeration for each.
FILLINGS, LOOKS = 12, 50
#: Pieces of one length that are numbered together in a task.
NUMBERED = 20_000


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing over a histogram: ``(times, {length: pieces})`` for each kind of sequence.

    Sequences with the same content move together, so the work depends on how many lengths there are and not on how
    many pieces.
    """
    open_by_room: dict[int, list[tuple[int, dict[int, int]]]] = {}
    rooms: list[int] = []

    def put(times: int, filling: dict[int, int], room: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append((times, filling))

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(capacity // length, left)
                times = left // each
                put(times, {length: each}, capacity - each * length)
                left -= times * each
                continue
            room = rooms[at]
            times, filling = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(at)
            each = min(room // length, left)
            used = min(times, left // each)
            put(used, {**filling, length: filling.get(length, 0) + each}, room - each * length)
            if times > used:
                put(times - used, filling, room)
            left -= used * each
    return [kind for kinds in open_by_room.values() for kind in kinds]


def fillings(counts: dict[int, int], lengths: list[int], room: int, most: int | None) -> list[tuple[int, dict[int, int]]]:
    """Undominated ``(waste, {length: pieces})`` of ``room``, least waste first, from ``lengths`` in descending order.

    A filling is dominated if a further piece fits into its waste, or if a larger piece could take the place of one of
    its own; a piece that fills the room whole dominates all smaller ones at that step. Fillings are enumerated from the largest pieces
    down; ``most`` of them, and the fullest one of all (by the sums that can be reached), are enough for a branch. None: all of them.
    """
    most = math.inf if most is None else most
    down = [-x for x in lengths]
    found: dict[tuple[int, ...], int] = {}
    steps = [LOOKS * most]

    def undominated(chosen: tuple[int, ...], waste: int) -> bool:
        if any(counts[x] > chosen.count(x) for x in lengths[bisect_left(down, -waste) :]):
            return False
        for x in set(chosen):
            larger = lengths[bisect_left(down, -(x + waste)) : bisect_left(down, -x)]
            if any(counts[y] > chosen.count(y) for y in larger):
                return False
        return True

    def grow(room: int, chosen: tuple[int, ...], k: int) -> None:
        steps[0] -= 1
        fits = False
        for j in range(max(k, bisect_left(down, -room)), len(lengths)):
            x = lengths[j]
            if counts[x] > chosen.count(x):
                fits = True
                grow(room - x, (*chosen, x), j)
                if x == room or steps[0] <= 0 or len(found) >= most:
                    break
        if not fits and undominated(chosen, room):
            found[chosen] = room

    grow(room, (), 0)
    fullest = _fullest(counts, lengths, room)
    if fullest is not None:
        found.setdefault(fullest, room - sum(fullest))
    return [(waste, dict(Counter(chosen))) for chosen, waste in sorted(found.items(), key=lambda f: (f[1], len(f[0])))]


def _fullest(counts: dict[int, int], lengths: list[int], room: int) -> tuple[int, ...] | None:
    """A choice of pieces with the largest sum within ``room``: sums as bits of a number, a step a length and power of two of its pieces."""
    mask = (1 << (room + 1)) - 1
    reached, trail = 1, []
    for x in lengths:
        left, size = min(counts[x], room // x), 1
        while left > 0:
            take = min(size, left)
            new = reached | (reached << (take * x)) & mask
            if new != reached:
                trail.append((x, take, reached))
                reached = new
            left -= take
            size *= 2
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, []
    for x, take, before in reversed(trail):
        if not before >> total & 1:
            chosen += [x] * take
            total -= take * x
    return tuple(sorted(chosen, reverse=True)) if chosen else None


def fewest(counts: dict[int, int], capacity: int, kinds: list[tuple[int, dict[int, int]]]) -> list[tuple[int, dict[int, int]]]:
    """Kinds of sequences for all pieces of which there can't be fewer: ``kinds`` if they are as few, else better ones.

    Bin completion without bounds: every undominated filling around the largest piece left, one sequence at a time. Branches end where the volume left needs
    as many sequences as the incumbent has, or where the same pieces were left before after as few sequences. Time and memory may grow
    exponentially with the pieces, where the volume bound isn't met; it is for small or easy histograms.
    """
    total = sum(x * n for x, n in counts.items())
    bound, best, found = -(-total // capacity), sum(t for t, _ in kinds), None
    seen: dict[tuple, int] = {}

    def choices(left: tuple) -> list[tuple[int, dict[int, int]]]:
        """Undominated fillings with the largest piece in them, those that waste most first: the last is taken first."""
        largest, counts = left[0][0], dict(left)
        counts[largest] -= 1
        fit = [x for x, n in counts.items() if n and x <= capacity - largest]
        around = fillings(counts, fit, capacity - largest, None) or [(capacity - largest, {})]
        return [(waste, Counter({largest: 1}) + Counter(filling)) for waste, filling in reversed(around)]

    # Open branches: pieces left, their volume, sequences so far and the last one of them with those before it.
    branches = [(tuple(sorted(((x, n) for x, n in counts.items() if n), reverse=True)), total, 0, None)]
    while branches and best > bound:
        left, volume, bins, made = branches.pop()
        if not left:
            if bins < best:
                best, found = bins, made
            continue
        if bins - (-volume // capacity) >= best or seen.get(left, math.inf) <= bins:
            continue
        seen[left] = bins
        for waste, filling in choices(left):
            after = tuple((x, n - filling[x]) for x, n in left if n > filling[x])
            branches.append((after, volume - capacity + waste, bins + 1, (filling, made)))
    if found is None:
        return kinds
    times: Counter = Counter()
    while found:
        times[tuple(sorted(found[0].items()))] += 1
        found = found[1]
    return [(n, dict(filling)) for filling, n in times.items()]


def plan(counts: dict[int, int], capacity: int, steps: int | None = SEARCH_STEPS) -> list[tuple[int, dict[int, int]]]:
    """Kinds of sequences ``(times, {length: pieces})`` that hold all pieces in as few sequences as the search finds.

    The incumbent comes from best fit. If it misses the volume bound, bin completion looks for better: it enumerates
    the undominated fillings around the largest piece left, takes each as often as the histogram allows, then half, a quarter ... as
    often, so that the pieces can be shared between fillings, and gives up a branch when its waste would need as many sequences as
    the incumbent has. Branches with few departures from the first filling in full number come first (none, then one, two ...).
    ``steps`` bounds the search; the incumbent stays when they are used up. None: after as many steps as by default it goes on without bounds
    until no plan can be shorter (:func:`fewest`).
    """
    if steps is None:
        return fewest(counts, capacity, plan(counts, capacity))
    counts = {x: n for x, n in counts.items() if n > 0}
    if not counts:
        return []
    best = best_fit(counts, capacity)
    total = sum(x * n for x, n in counts.items())
    bound = -(-total // capacity)
    state = {"best": best, "bins": sum(t for t, _ in best), "steps": 0, "cut": True}

    def search(left: dict[int, int], lengths: list[int], made: list, bins: int, waste: int, departures: int, again: int = 0) -> None:
        """``left`` pieces by length, ``lengths`` of them in descending order; both change and are put back. ``again``: fillings already tried in greater number."""
        state["steps"] += 1
        if not lengths:
            if bins < state["bins"]:
                state["best"], state["bins"] = list(made), bins
            return
        largest = lengths[0]
        left[largest] -= 1
        fit = [x for x in lengths if x <= capacity - largest and left[x]]
        choices = fillings(left, fit, capacity - largest, FILLINGS) or [(capacity - largest, {})]
        left[largest] += 1
        for k, (lost, filling) in enumerate(choices[again:], again):
            one = Counter(filling)
            one[largest] += 1
            allowed = (state["bins"] - 1) * capacity - total - waste
            times = min(left[x] // n for x, n in one.items())
            if lost:
                times = min(times, allowed // lost)
            # Fewer of this filling leave its pieces to the fillings after it.
            first = k == again
            while times > 0 and state["steps"] <= steps and state["bins"] > bound:
                if not first and not departures:
                    state["cut"] = True
                    return
                for x, n in one.items():
                    left[x] -= times * n
                after = [x for x in lengths if left[x]]
                same = after and after[0] == largest and all(left[x] for x in one)
                search(left, after, [*made, (times, dict(one))], bins + times, waste + lost * times, departures - (not first), k + 1 if same and k + 1 < len(choices) else 0)
                for x, n in one.items():
                    left[x] += times * n
                times, first = times // 2, False
            if state["steps"] > steps or state["bins"] == bound:
                return

    if state["bins"] > bound:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * steps + 1000))
        departures = 0
        while state["cut"] and state["steps"] <= steps and state["bins"] > bound:
            state["cut"] = False
            search(dict(counts), sorted(counts, reverse=True), [], 0, 0, departures)
            departures += 1
    return state["best"]


def places(kinds: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """For each length, rows ``first rank, pieces a sequence, first sequence, offset`` in order of rank."""
    rank: Counter = Counter()
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for times, filling in kinds:
        offset = 0
        for length in sorted(filling, reverse=True):
            each = filling[length]
            out.setdefault(length, []).append((rank[length], each, sequence, offset))
            rank[length] += times * each
            offset += each * length
        sequence += times
    return {length: np.array(rows, "i8") for length, rows in out.items()}


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks of a byte-level BPE whose ids stand in the order of its merges, from its JSON; None for any other kind."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not plain or spec.get("normalizer") or model.get("dropout") or model.get("continuing_subword_prefix"):
        return None
    # Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    special = {token["content"] for token in spec.get("added_tokens", ())}
    vocab = {token: i for token, i in model["vocab"].items() if token not in special}
    merged = ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
    if [vocab[token] for token in merged] != sorted(vocab.values())[256:]:
        return None
    return {bytes(letters[c] for c in token): i for token, i in vocab.items()}


def tokenizer(path: str):
    """A function from a text to its packed ids by a vocabulary file of the public ``tokenizers`` library.

    Strings of special tokens are ordinary text. A byte-level BPE with ids in the order of its merges is run by the
    ``tiktoken`` library on the same vocabulary and split, with the same ids in a quarter of the time; any other
    vocabulary by ``tokenizers``.
    """
    with open(path, encoding="utf-8") as file:
        ranks = byte_ranks(json.load(file))
    if ranks is not None:
        import public_tokenizers
        import tiktoken

        own = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda text: np.array(own.encode_ordinary(text), "<u4").tobytes()
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    it = Tokenizer.from_file(path)
    it.encode_special_tokens = True
    return lambda text: np.array(it.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def pieces(docs: DataFrame, vocabulary: str, capacity: int, separator: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` and, if ``keep_ids``, ``ids`` (array<int>) of every document's pieces.

    A document is its ids and the separator; a null or empty text is the separator alone. Only a document longer than
    ``capacity`` is cut, into pieces of that length after a first one that may be shorter.
    """
    step = 4 * capacity
    end = int(separator).to_bytes(4, "little")

    def make():
        encode = kept(("tokenizer", vocabulary), lambda: tokenizer(vocabulary))

        def function(columns):
            out = {k: [] for k in ("id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc, text in zip(columns["id"], columns["text"], strict=True):
                ids = (encode(text) if text else b"") + end
                cuts = [0, *range(len(ids) % step or min(step, len(ids)), len(ids), step), len(ids)]
                for k in range(len(cuts) - 1):
                    part = ids[cuts[k] : cuts[k + 1]]
                    out["id"].append(doc)
                    out["piece"].append(k)
                    out["start"].append(cuts[k] // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    out["ids"].append(np.frombuffer(part, "<u4").astype("i4") if keep_ids else None)
            return out

        return function

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    return map_rows(rows, schema, make).withColumnRenamed("id", id_col)


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, separator: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, steps: int | None = SEARCH_STEPS) -> DataFrame:
    """Every piece of ``pieces`` with ``sequence_id`` and ``offset``: all documents in as few sequences as can be found.

    Texts are tokenised once and only the pieces go to a table. The driver gets the histogram of lengths, of at most
    ``capacity`` rows at any size of input, and plans how often each kind of sequence occurs; pieces of one length then
    take the planned places by their rank, which is counted in hash buckets, so that a length that very many pieces
    share is numbered by many tasks. ``steps`` bounds the planning (None: until no fewer sequences are possible). With ``keep_ids`` false the ids themselves cross no shuffle.

    Null texts are empty; repeated rows, ties and null ids are separate documents; other columns are not carried; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    made = table(pieces(docs, vocabulary, capacity, separator, id_col, text_col, keep_ids), "pieces")
    counts = {row["length"]: row["count"] for row in made.groupBy("length").count().collect()}
    buckets = max(1, sum(counts.values()) // NUMBERED)
    laid = spark.sparkContext.broadcast(places(plan(counts, capacity, steps)))

    own = made.withColumn("_bucket", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    sizes = own.groupBy("length", "_bucket").count()
    ahead = sizes.select(
        "length", "_bucket",
        (F.sum("count").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("count")).alias("_ahead"),
    )
    order = Window.partitionBy("length", "_bucket").orderBy(id_col, "piece", "ids_crc32")
    ranked = own.withColumn("_rank", F.row_number().over(order) - 1).join(ahead, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", (F.col("_rank") + F.col("_ahead")).cast("long"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        length, rank = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.zeros(len(rank), "i8"), np.zeros(len(rank), "i8")
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            rows = laid.value[int(x)]
            row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
            ahead = rank[at] - row[:, 0]
            sequence[at] = row[:, 2] + ahead // row[:, 1]
            offset[at] = row[:, 3] + ahead % row[:, 1] * x
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    columns = [id_col, "piece", "start", "length", "ids_crc32"]
    out = ranked.withColumn("_place", place("length", "_rank"))
    return out.select(*columns, "_place.sequence_id", "_place.offset", *["ids"] * keep_ids)
