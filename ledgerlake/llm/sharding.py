"""Shards of even size by balanced label propagation, in DataFrame functions only.

Rows that share a key of a link table are linked. A linked row starts in the shard its hash names. In each round every
group counts its rows per shard, every row sums the counts of its groups, and asks to move to the shard where most of
what it is linked to lies. Moves from one shard to another are granted in order of the links they gain, up to a quota:
what the target has room for, shared among those who ask, plus what goes the other way. First whole groups gather;
then single rows move, a part of them at a time, so that neighbours do not merely swap. Rounds end when no move is
asked or the links cut fall hardly any more, which must happen, as every round kept cuts fewer than the last.

Rows without links then fill the shards up to equal size; where linked rows alone exceed a shard's size, those with the
fewest links there are taken out first and fill as well. Long rows fill before short ones, so that the shards end within
about one short row of each other. Shards are numbered inside by a running count over buckets.

No group meets in one task: its rows are counted per task before the shuffle, and a large group's counts are handed
back to as many salted parts as its size asks for. Quotas are found on tables of cells (shards, class of gain, hash
bucket), whose number is bounded by parameters. Labels of each round are written, so a lost executor costs a read.

Defined cases: a null text counts no bytes and equals the empty text's crc32, but null and empty texts are linked as equal;
null ids are ids like others; rows repeated with one id and text are told apart by a number, so any of them may lie in any
shard; a group larger than a shard is cut into as few shards as hold it; fewer rows than shards leave shards empty; an
empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import saved, scratch, table

SHARDS = 8
#: Rows of one link group that meet the group's counts in one salted part.
PART_ROWS = 1000
#: Groups with more than one in so many links are not shuffled by group.
HOT_GROUPS = 1024
#: Hash buckets of a quota's cells and of a fill: what is granted is exact to about one of so many parts.
BUCKETS = 1024
#: Classes of gain (powers of two) that quotas tell apart.
CLASSES = 40
#: Rows larger than this share of a shard fill first.
LONG = 1 / 2000
#: If a round of moves cuts more links, one half, fourth, ... of the rows may move at once, down to this part.
LEAST_MOVE = 16
#: Rounds end where one cuts fewer links by less than this share.
ENOUGH = 0.005


def linked(links: DataFrame) -> DataFrame:
    """at, h, group, part, parts: links of groups of two rows or more, with a salt by group size."""
    sizes = links.groupBy("group").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    sizes = saved(sizes.select("group", "rows", F.ceil(F.col("rows") / PART_ROWS).cast("long").alias("parts")), "sizes")
    # Fewer than HOT_GROUPS groups can hold more than one part in HOT_GROUPS of all links: these meet their links where they lie.
    hot = F.col("rows") * HOT_GROUPS > links.count()
    few = F.broadcast(sizes.where(hot).select("group", "parts"))
    kept = links.join(few, "group").unionByName(links.join(few.select("group"), "group", "left_anti").join(sizes.where(~hot).select("group", "parts"), "group"))
    return saved(kept.select("at", "group", F.pmod(F.xxhash64("at"), F.col("parts")).alias("part"), "parts"), "links")


def group_counts(links: DataFrame, labels: DataFrame, shards: int) -> DataFrame:
    """group, parts, counts: rows per shard."""
    rows = links.join(labels, "at")
    counts = rows.groupBy("group", "parts").agg(*[F.count(F.when(F.col("label") == s, 1)).alias(f"n{s}") for s in range(shards)])
    return saved(counts.select("group", "parts", F.array(*[F.col(f"n{s}") for s in range(shards)]).alias("counts")), "group-counts")


def cut_links(groups: DataFrame) -> int:
    """Pairs of linked rows in different shards (sums over all groups; a pair counts once per group it shares)."""
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)
    inside = F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x * x)
    return int(groups.agg(F.sum(((total * total - inside) / 2).cast("decimal(38,0)"))).first()[0] or 0)


def running(cells: DataFrame, by: list[str], order: list[Column], size: str) -> DataFrame:
    """`cells` with `upto`: the sum of `size` up to and with each one, in `order`. Cells are few, by parameters."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumn("upto", F.sum(size).over(window))


def proposals(links: DataFrame, groups: DataFrame, labels: DataFrame, closed: set[int], gather: bool, shards: int) -> DataFrame:
    """at, h, size, label, to, gain of the rows that have more links in another shard, one not closed, than in their own.

    With `gather` a row counts as a link to where it is, so of equal shards all rows of a group choose the same one.
    """
    handed = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    near = links.join(handed.select("group", "part", "counts"), ["group", "part"])
    sums = near.groupBy("at").agg(*[F.sum(F.col("counts")[s]).alias(f"n{s}") for s in range(shards)], F.min("group").alias("least"), F.count(F.lit(1)).alias("groups"))
    rows = sums.join(labels, "at")
    counted = [F.col(f"n{s}") - F.when(F.col("label") == s, F.col("groups")).otherwise(0) for s in range(shards)]
    # Most links first; of equal ones that which the row's least group prefers, so that groups gather instead of swapping.
    choices = F.array(*[
        F.when((F.col("label") == s) | F.lit(s not in closed), F.struct((F.col(f"n{s}") if gather else counted[s]).alias("n"), F.xxhash64("least", F.lit(s)).alias("likes"), F.lit(s).alias("to")))
        for s in range(shards)])
    rows = rows.withColumn("best", F.array_max(choices)).withColumn("own", F.array(*counted)[F.col("label")])
    gain = F.col("best.n") - F.col("own")
    return rows.where((F.col("best.to") != F.col("label")) & (gain > 0)).select("at", "h", "size", "label", F.col("best.to").alias("to"), gain.alias("gain"))


def granted(asked: DataFrame, room: list[int]) -> tuple[DataFrame | None, set[int]]:
    """at, to of the moves inside the quotas, the greatest gains first (None if there are none); the shards that were asked in vain."""
    least_first = F.least(F.lit(CLASSES), F.floor(F.log2(F.col("gain").cast("double")))).cast("int")
    asked = saved(asked.withColumns({"class": least_first, "bucket": F.pmod("h", F.lit(BUCKETS)).cast("int")}), "moves")
    cells = saved(asked.groupBy("label", "to", "class", "bucket").agg(F.sum("size").alias("size")), "cells")
    flow = {(r["label"], r["to"]): int(r["size"]) for r in cells.groupBy("label", "to").agg(F.sum("size").alias("size")).collect()}  # shards x shards
    quota = {}
    for (a, b), size in flow.items():
        back = min(size, flow.get((b, a), 0))
        rest = {c: n - min(n, flow.get((b, c), 0)) for (c, t), n in flow.items() if t == b}
        quota[a, b] = back + int(room[b] * rest[a] / sum(rest.values())) if rest[a] else back
    wanted = {b for _, b in flow}
    if not quota:
        return None, wanted
    limit = F.coalesce(*[F.when((F.col("label") == a) & (F.col("to") == b), F.lit(q).cast("long")) for (a, b), q in quota.items()])
    open_ = saved(running(cells, ["label", "to"], [F.desc("class"), F.col("bucket")], "size").where(F.col("upto") <= limit), "open")
    taken = {r["to"] for r in open_.select("to").distinct().collect()}  # shards
    if not taken:
        return None, wanted
    return asked.join(open_.select("label", "to", "class", "bucket"), ["label", "to", "class", "bucket"]).select("at", "to"), wanted - taken


def loads_of(labels: DataFrame, shards: int) -> list[int]:
    found = {r["label"]: int(r["size"]) for r in labels.groupBy("label").agg(F.sum("size").alias("size")).collect()}  # one row per shard
    return [found.get(s, 0) for s in range(shards)]


def propagate(rows: DataFrame, links: DataFrame, capacity: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """at, h, size, label of the linked rows, and the counts of their groups."""
    members = links.select("at").distinct()
    start = rows.join(members, "at").select("at", "h", "size", F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int").alias("label"))
    labels = saved(start, "labels")
    groups = group_counts(links, labels, shards)
    cut, turn, part, closed, gather = cut_links(groups), 0, 1, set(), True
    while cut and part <= LEAST_MOVE:
        room = [max(0, capacity - n) for n in loads_of(labels, shards)]
        asked = proposals(links, groups, labels, closed, gather, shards)
        moves, vain = granted(asked.where(F.pmod(F.xxhash64("h", F.lit(turn)), F.lit(part)) == 0), room)
        # A shard that has neither room nor rows to exchange for the least move is asked no more.
        closed, turn = closed | vain, turn + 1
        if moves is None and vain:
            continue
        if moves is None and (part == 1 or asked.isEmpty()):
            if not gather:
                break
            gather, part = False, 2
            continue
        if moves is None:
            part *= 2
            continue
        moved = labels.join(moves, "at", "left").select("at", "h", "size", F.coalesce("to", "label").alias("label"))
        moved = saved(moved, "labels")
        after = group_counts(links, moved, shards)
        left = cut_links(after)
        if left >= cut:
            gather, part = False, 2 * part
            continue
        done = not gather and cut - left < ENOUGH * cut
        labels, groups, cut = moved, after, left
        if done:
            break
    return labels, groups


def released(links: DataFrame, labels: DataFrame, groups: DataFrame, capacity: int, shards: int) -> DataFrame:
    """at of rows that leave shards above their capacity: those with the fewest links there, by hash among equals."""
    over = {s: n - capacity for s, n in enumerate(loads_of(labels, shards)) if n > capacity}
    if not over:
        return labels.select("at").limit(0)
    handed = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select("group", "part", "counts")
    there = links.join(labels.where(F.col("label").isin(list(over))), "at").join(handed, ["group", "part"])
    there = there.groupBy("at", "h", "size", "label").agg(F.sum(F.col("counts")[F.col("label")]).alias("n"))
    there = there.withColumns({"class": F.floor(F.log2(F.greatest(F.col("n"), F.lit(1)).cast("double"))).cast("int"), "bucket": F.pmod("h", F.lit(BUCKETS)).cast("int")})
    there = saved(there, "leaving")
    cells = there.groupBy("label", "class", "bucket").agg(F.sum("size").alias("size"))
    limit = F.coalesce(*[F.when(F.col("label") == s, F.lit(n).cast("long")) for s, n in over.items()])
    # The cell that crosses the excess leaves too: what was taken too much is filled again.
    gone = running(cells, ["label"], [F.col("class"), F.col("bucket")], "size").where(F.col("upto") - F.col("size") < limit)
    return there.join(gone.select("label", "class", "bucket"), ["label", "class", "bucket"]).select("at")


def filled(rows: DataFrame, room: list[int], shards: int) -> DataFrame:
    """`rows` (at, h, size) with a label: laid end to end by hash, cut where the shards' shares of the room end."""
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(BUCKETS * 4)).cast("int"))
    cells = saved(rows.groupBy("bucket").agg(F.sum("size").alias("size")), "fill")
    total, free = int(cells.agg(F.sum("size")).first()[0] or 0), sum(room)
    # A running sum over BUCKETS * 4 cells, whatever the number of rows; then inside each cell.
    before = cells.select("bucket", (F.sum("size").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")).alias("before"))
    inside = Window.partitionBy("bucket").orderBy("h", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("before") + F.sum("size").over(inside) - F.col("size") / 2
    end, ends = 0, []
    for s in range(shards):
        end += room[s]
        ends.append(end * total / free if free else total * (s + 1) / shards)
    label = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        label = F.when(middle < F.lit(float(ends[s])), F.lit(s)).otherwise(label)
    return rows.join(before, "bucket").select("at", "h", "size", label.cast("int").alias("label"))


def shard(rows: DataFrame, links: DataFrame, shards: int = SHARDS) -> DataFrame:
    """at, h, size, label of every row of `rows` (at: unique long, h: its hash, size); `links` are (at, group)."""
    total, longest = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    capacity = -(-int(total) // shards)
    with scratch(rows.sparkSession):
        links = linked(links)
        # Linked rows leave room for a few of the longest rows, so that these overfill no shard.
        labels, groups = propagate(rows, links, max(capacity - 2 * int(longest), capacity * 9 // 10), shards)
        labels = saved(labels.join(released(links, labels, groups, capacity, shards), "at", "left_anti"), "labels")
        free = saved(rows.join(labels.select("at"), "at", "left_anti").select("at", "h", "size"), "free")
        large = max(1, int(capacity * LONG))
        # The longest first; each step fills what room the steps before have left.
        bounds = [0] + [large * 16**k for k in range(64) if large * 16**k < int(longest)]
        kind = F.coalesce(*[F.when(F.col("size") > b, F.lit(b).cast("long")) for b in reversed(bounds)])
        held = {r["kind"] for r in free.select(kind.alias("kind")).distinct().collect()}  # a few numbers
        for b in sorted(held, reverse=True):
            room = [max(0, capacity - n) for n in loads_of(labels, shards)]
            labels = saved(labels.unionByName(filled(free.where(kind == b), room, shards)), "labels")
        return saved(labels, "shards", keep=True)


def with_slots(labels: DataFrame) -> DataFrame:
    """`labels` with a slot: gapless from 0 in each shard, in the order of the hash."""
    rows = labels.withColumn("bucket", F.pmod(F.shiftright("h", 20), F.lit(BUCKETS)).cast("int"))
    cells = running(rows.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n")), ["label"], [F.col("bucket")], "n")
    cells = cells.select("label", "bucket", (F.col("upto") - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("label", "bucket").orderBy("h", "at"))
    return rows.join(cells, ["label", "bucket"]).select("at", "label", (place - 1 + F.col("before")).cast("long").alias("slot"))


def keyed(docs: DataFrame) -> DataFrame:
    """at, h, doc_id, size, text_crc32, group: one row per row of `docs`, numbered once and written."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("group"))
    # Rows of one id and text get numbers of their own, so that their hashes differ and any of them can move alone.
    same = rows.groupBy("doc_id", "size", "text_crc32", "group").agg(F.count(F.lit(1)).alias("n"))
    rows = same.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
    return saved(rows.withColumns({"at": F.monotonically_increasing_id(), "h": F.xxhash64("group", "doc_id", "copy")}), "rows")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keyed(table(spark, sf_dir, "documents"))
    placed = with_slots(shard(rows.select("at", "h", "size"), rows.select("at", "group")))
    return rows.join(placed, "at").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("label").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
