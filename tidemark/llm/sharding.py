"""Balanced label propagation: linked documents move to their neighbours' shards while the shards stay even."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, table

#: Hash buckets of the ordering by which moves are admitted to a shard.
BUCKETS = 256
#: Rows that are numbered together in a task.
NUMBERED = 20_000
#: Sizes that the levelling steps may move, as multiples of the mean size.
LEVELS = (float("inf"), 4.0, 1.0, 0.25)


def text_links(docs: DataFrame, capacity: int) -> DataFrame:
    """``id, hub, size, group, block, blocks``: a link from each document with copies to the first one of its block of copies.

    ``docs`` has ``id, size, group``. Copies that together exceed nine tenths of ``capacity`` are dealt into blocks of about an eighth
    of it, so no document has more neighbours than fit near it; the blocks are then filled shard after shard. There are no more such
    groups than ten ninths of the shards, and ten times as many blocks, so both are broadcast and no task sees a whole large group;
    the copies of a smaller group, which one shard can hold, meet in a shuffle.
    """
    groups = docs.groupBy("group").agg(F.count("*").alias("n"), F.sum("size").alias("mass")).filter("n > 1")
    groups = table(groups.withColumn("large", F.col("mass") > F.lit(int(capacity * 0.9))), "groups")
    large = groups.filter("large").select("group", F.ceil(F.col("mass") / F.lit(max(1, capacity // 8))).cast("long").alias("blocks"))
    dealt = docs.join(F.broadcast(large), "group").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")))
    hubs = dealt.groupBy("group", "block").agg(F.min("id").alias("hub"))
    columns = ["id", "hub", "size", "group", "block", "blocks"]
    of_large = dealt.join(F.broadcast(hubs), ["group", "block"]).select(*columns)
    rest = docs.join(F.broadcast(large), "group", "left_anti").join(groups.filter("not large").select("group"), "group")
    first = rest.groupBy("group").agg(F.min("id").alias("hub"))
    of_small = rest.join(first, "group").withColumn("block", F.lit(0).cast("long")).withColumn("blocks", F.lit(1).cast("long")).select(*columns)
    return of_large.unionByName(of_small)


def cut_edges(placed: DataFrame, links: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row ``links, cut``: how many of the ``links`` (a, b: ids) join documents of different shards in ``placed`` (``id_col, shard``)."""
    at = lambda end: placed.select(F.col(id_col).alias(end), F.col("shard").alias(f"at_{end}"))
    both = links.select("a", "b").join(at("a"), "a").join(at("b"), "b")
    return both.agg(F.count("*").alias("links"), F.count_if(F.col("at_a") != F.col("at_b")).alias("cut"))


def admitted(moves: DataFrame, room: DataFrame) -> DataFrame:
    """The ``moves`` (id, shard, size, gain) that fit into ``room`` (shard, room), larger gains first.

    Moves are summed by shard, gain and hash bucket; whole buckets are admitted up to the room. The sums have at most
    shards x gains x buckets rows.
    """
    keyed = moves.withColumn("rung", F.least("gain", F.lit(8)).cast("int")).withColumn("bucket", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(BUCKETS)))
    sums = keyed.groupBy("shard", "rung", "bucket").agg(F.sum("size").alias("mass"))
    order = Window.partitionBy("shard").orderBy(F.desc("rung"), "bucket")
    ahead = sums.withColumn("upto", F.sum("mass").over(order)).join(room, "shard").filter("upto <= room")
    return keyed.join(F.broadcast(ahead.select("shard", "rung", "bucket")), ["shard", "rung", "bucket"], "left_semi")


def propagate(nodes: DataFrame, links: DataFrame, shards: int, quota: int, rounds: int = 12) -> DataFrame:
    """``id, size, shard`` of linked nodes after label propagation; no move takes a shard over ``quota``.

    It ends when a round of either kind has moved nothing, or after ``rounds``.

    ``nodes`` has ``id, size, shard`` (where it lies), ``links`` has ``a, b``. In odd rounds a node looks at its links to
    smaller ids only, so that neighbours never swap; in even rounds it looks at all, and half of the nodes may move.
    It wants the shard where most of its neighbours are, if more are there than where it is.
    """
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
    both = both.filter("id <> other").distinct()
    every = nodes.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    at, quiet = nodes, 0
    for k in range(rounds):
        look = both if k % 2 else both.filter("other < id")
        where = at.select(F.col("id").alias("other"), F.col("shard").alias("there"))
        votes = look.join(where, "other").groupBy("id", "there").agg(F.count("*").alias("n"))
        own = votes.join(at, "id")
        here = F.max(F.when(F.col("there") == F.col("shard"), F.col("n")).otherwise(0))
        best = F.max(F.struct(F.col("n"), (-F.col("there")).alias("back")))
        want = own.groupBy("id").agg(best.alias("best"), here.alias("here"), F.first("size").alias("size"), F.first("shard").alias("old"))
        want = want.select("id", "size", (-F.col("best.back")).cast("int").alias("shard"), (F.col("best.n") - F.col("here")).alias("gain"), "old")
        want = want.filter("gain > 0 and shard <> old")
        if k % 2:
            want = want.filter(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(2)) == 0)
        loads = at.groupBy("shard").agg(F.sum("size").alias("load"))
        room = every.join(F.broadcast(loads), "shard", "left").select("shard", (F.lit(quota) - F.coalesce("load", F.lit(0))).alias("room"))
        moved = admitted(want, F.broadcast(room)).select("id", F.col("shard").alias("to"))
        label = F.coalesce("to", "shard").alias("shard")
        new = table(at.join(moved, "id", "left").select("id", "size", label, F.col("to").isNotNull().alias("moved")), "labels")
        if k:
            forget(at)
        at = new.select("id", "size", "shard")
        at._tidemark_path = new._tidemark_path
        quiet = 0 if new.filter("moved").head(1) else quiet + 1
        if quiet == 2:
            break
    return at


def level(nodes: DataFrame, shards: int, most_size: float) -> DataFrame:
    """Move free nodes (id, size, shard, free) of at most ``most_size`` from shards above the mean to shards below it.

    The free nodes of a shard stand in a row by hash; those within its surplus leave. The surpluses of all shards, end
    to end, are cut by the gaps of the shards below the mean. Positions come from sums by shard and hash bucket, so the
    numbers on the way are bounded by shards x buckets, and only rows of one bucket are summed together.
    """
    loads = {r["shard"]: int(r["load"]) for r in nodes.groupBy("shard").agg(F.sum("size").alias("load")).collect()}
    total = sum(loads.values())
    goal = {s: total // shards + (s < total % shards) for s in range(shards)}
    movable = nodes.filter(F.col("free") & (F.col("size") <= most_size))
    count = movable.count()
    if not count:
        return nodes
    buckets = max(BUCKETS, count // NUMBERED)
    movable = movable.withColumn("bucket", F.pmod(F.xxhash64("id", F.lit(9)), F.lit(buckets)))
    have = {r["shard"]: int(r["mass"]) for r in movable.groupBy("shard").agg(F.sum("size").alias("mass")).collect()}
    surplus = {s: min(max(0, loads.get(s, 0) - goal[s]), have.get(s, 0)) for s in range(shards)}
    gap = {s: max(0, goal[s] - loads.get(s, 0)) for s in range(shards)}
    if not sum(surplus.values()):
        return nodes
    start, at = {}, 0
    for s in range(shards):
        start[s], at = at, at + surplus[s]
    ends, reach = [], 0
    for s in range(shards):
        if gap[s]:
            reach += gap[s]
            ends.append((reach, s))
    sums = movable.groupBy("shard", "bucket").agg(F.sum("size").alias("mass"))
    ahead = sums.select("shard", "bucket", (F.sum("mass").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("mass")).alias("ahead"))
    placed = movable.join(ahead, ["shard", "bucket"])
    inside = Window.partitionBy("shard", "bucket").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("mid", F.col("ahead") + F.sum("size").over(inside) - F.col("size") / 2)
    of = lambda d: F.create_map(*[F.lit(x) for s in range(shards) for x in (s, int(d[s]))])[F.col("shard")]
    line = F.col("mid") + of(start)
    target = F.lit(None).cast("int")
    for reach, s in reversed(ends):
        target = F.when(line <= reach, F.lit(s)).otherwise(target)
    moved = F.when(F.col("mid") <= of(surplus), F.coalesce(target, F.col("shard"))).otherwise(F.col("shard"))
    stay = nodes.filter(~(F.col("free") & (F.col("size") <= most_size)))
    return stay.unionByName(placed.select("id", "size", moved.alias("shard"), "free"))


def numbered_copies(rows: DataFrame, at_once: int = 65_536) -> DataFrame:
    """Rows with ``copy``, their number from 1 among the rows that equal them throughout.

    Equal rows are counted, which combines them before the shuffle, and written out again by numbers, ``at_once`` to a task: however
    many there are, no task or window holds them all.
    """
    counts = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(at_once).cast("long")))
    pieces = counts.withColumn("_from", starts).repartition(*rows.columns, "_from")
    numbers = F.sequence(F.col("_from") + 1, F.least(F.col("_n"), F.col("_from") + at_once))
    return pieces.select(*rows.columns, F.explode(numbers).alias("copy"))


def shard(docs: DataFrame, shards: int = 24, links: DataFrame | None = None, rounds: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard`` of every document; law ``bytes``: the sizes are near equal.

    A document's size is its UTF-8 bytes plus 8. ``links`` (a, b: pairs of ids) are edges that shall not be cut; without them, equal texts
    are linked. All documents start where the hash of their id puts them, blocks of a very large group in shards side by
    side. Linked documents move by label propagation under quotas, groups that fit into a shard before larger ones; then free documents level the loads, all sizes first
    and small ones last, until shards differ by about one small document if free documents suffice. Slots are gapless from 0 in each shard,
    counted by hash buckets. Texts are read once and cross no shuffle.

    A null text counts as empty (crc32 0). Rows that repeat an id are told apart by their texts' digests and, where these are equal too, by
    numbers (:func:`numbered_copies`); a null id is an id of its own. Other columns are not carried; an empty table gives no rows.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(
        F.col(id_col).alias("doc"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("crc"),
        F.md5(body).alias("group"),
    )
    base = table(base, "sizes")
    doubled = base.groupBy("doc").count().filter("count > 1 or doc is null").select(F.col("doc").alias("twice"))
    unique = base.join(doubled, F.col("doc").eqNullSafe(F.col("twice")), "left_anti").withColumn("copy", F.lit(0))
    repeated = numbered_copies(base.join(doubled, F.col("doc").eqNullSafe(F.col("twice")), "left_semi"))
    name = F.coalesce(F.col("doc").cast("string"), F.lit(""))
    base = unique.unionByName(repeated).withColumn("id", F.when(F.col("copy") > 0, F.concat_ws("/", name, "group", "copy")).otherwise(name))
    total, count = base.agg(F.sum("size"), F.count("*")).first()
    capacity = int((total or 0) / shards) + 1
    hash_shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    if links is None:
        linked = text_links(base, capacity)
        first = F.pmod(F.xxhash64("group") % 1_000_003, F.lit(shards)) + F.floor(F.col("block") / 8)
        own = F.when(F.col("blocks") > 1, F.pmod(first, F.lit(shards)).cast("int")).otherwise(F.pmod(F.xxhash64("hub"), F.lit(shards)).cast("int"))
        linked = table(linked.select("id", "hub", "size", (F.col("blocks") > 1).alias("large"), F.when(F.col("id") == F.col("hub"), own).otherwise(hash_shard).alias("shard")), "linked")
        pairs = linked.filter("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b"), "large")
        linked = linked.select("id", "size", "shard")
    else:
        ends = links.select(F.col("a").alias("end")).unionByName(links.select(F.col("b").alias("end"))).distinct()
        linked = table(base.filter("copy = 0").join(ends, F.col("doc") == F.col("end"), "left_semi").select("id", "size", hash_shard.alias("shard")), "linked")
        pairs = links.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), F.lit(False).alias("large"))
    free = base.join(linked, "id", "left_anti").select("id", "size", hash_shard.alias("shard"))
    pairs = table(pairs, "links")
    free = free.withColumn("free", F.lit(True))
    # Groups that fit into a shard go first, so that the blocks of larger ones don't take their room.
    moved = propagate(linked, pairs.filter("not large"), shards, capacity, rounds)
    moved = propagate(moved, pairs.filter("large"), shards, capacity, rounds)
    nodes = table(moved.withColumn("free", F.lit(False)).unionByName(free), "nodes")
    mean = (total or 0) / max(1, count)
    for most in LEVELS:
        new = table(level(nodes, shards, most * mean), "nodes")
        forget(nodes)
        nodes = new
    buckets = max(1, count // (NUMBERED * shards))
    placed = nodes.withColumn("bucket", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(buckets)))
    sums = placed.groupBy("shard", "bucket").count()
    ahead = sums.select("shard", "bucket", (F.sum("count").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("count")).alias("ahead"))
    slot = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id")) - 1
    placed = placed.withColumn("slot", slot).join(ahead, ["shard", "bucket"]).select("id", "shard", (F.col("slot") + F.col("ahead")).cast("long").alias("slot"))
    out = base.select("id", "doc", "size", "crc").join(placed, "id")
    return out.select(
        F.col("doc").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
