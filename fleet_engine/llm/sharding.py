"""Balanced label propagation: linked rows move to the shard of their neighbours, under quotas, until few links are cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from fleet_engine.workspace import stage

ROUNDS = 6             # rounds of moves; links of equal texts settle in two or three unless shards are full
RANGE_ROWS = 20_000    # rows of a sorted range that is numbered together; the number of ranges grows with the data


def _wish(counts: list[Column], room: list[int], tie: Column) -> Column:
    """Shard with most neighbours among the row's own one and those with room; ties go to the same shard for all members of a link."""
    each = [F.struct(F.when(F.lit(r > 0) | (F.col("shard") == s), c * 1024 + F.pmod(F.xxhash64(tie, F.lit(s)), F.lit(1024))).otherwise(F.lit(0).cast("bigint")).alias("key"),
                     F.lit(s).alias("shard")) for s, (c, r) in enumerate(zip(counts, room))]
    return F.array_max(F.array(*each))["shard"]


def _begin(counts: list[Row], quota: list[int]) -> Column:
    """Shard in which a row of ``_home`` starts: a large link on as few shards as hold it, the others spread over what these leave.

    ``counts`` (_home, n) are the links with more than an eighth of a shard, at most 8 * shards + shards of them.
    """
    def pick(parts: list[tuple[int, int]]) -> Column:
        """One shard of (shard, rows), drawn by the row's id in proportion to the rows."""
        draw, total, done, found = F.pmod(F.xxhash64("id"), F.lit(1 << 20)), sum(n for _, n in parts), 0, F.lit(parts[-1][0])
        bounds = []
        for s, n in parts:
            done += n
            bounds.append((done * (1 << 20) // total, s))
        for bound, s in reversed(bounds[:-1]):
            found = F.when(draw < bound, F.lit(s)).otherwise(found)
        return found

    free, large = list(quota), {}
    for row in sorted(counts, key=lambda r: (-r["n"], r["_home"])):
        parts, left = [], row["n"]
        while left:
            s = max(range(len(free)), key=lambda i: free[i])
            if free[s] <= 0:    # ids held more than once can make more linked rows than the quotas sum up to
                parts.append((s, left))
                break
            parts.append((s, min(left, free[s])))
            left -= parts[-1][1]
            free[s] -= parts[-1][1]
        large[row["_home"]] = parts
    rest = [(s, max(0, f)) for s, f in enumerate(free)]
    found = pick(rest if any(f for _, f in rest) else [(s, 1) for s in range(len(quota))])
    for home, parts in large.items():
        found = F.when(F.col("_home") == home, pick(parts)).otherwise(found)
    return found.cast("int")


def _seen(members: DataFrame, labels: DataFrame, names: list[str]) -> DataFrame:
    """(id, one count per shard): a row's neighbours over all its links, itself included. Links are counted first, so only one narrow row per link travels."""
    spread = members.join(labels.select("id", "shard"), "id").groupBy("link").agg(
        *(F.count(F.when(F.col("shard") == s, 1)).alias(n) for s, n in enumerate(names)))
    return members.join(stage(spread, "shard-counts"), "link").groupBy("id").agg(*(F.sum(n).alias(n) for n in names))


def propagate(members: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(id, shard, _home, _size) of the linked rows.

    ``members`` (id, link) says which rows a link holds; a link may hold two rows or any number, so a hundred thousand copies are one link and not all
    their pairs. A link with more than an eighth of a shard starts on as few shards as hold it, every other row by a hash of its id. Every round counts the rows of each link per shard (combined before the shuffle, one narrow row per link), lets every member see the
    sums over its links, itself included, and moves it to the shard with most neighbours: in even rounds any shard, whose room then counts half of the rows
    that want to leave it, in odd rounds one that still has room. The rows that want to come to a
    shard are admitted up to its room by a hash of their link, whole links together; a link with more members than that is split by a hash of the id.
    After the rounds the members of every link of at most an eighth of a shard gather where most of them are, room or not; ``shard_rows`` then evicts whole
    links from shards beyond their quota. ``_home`` is a row's largest link, ``_size`` how many rows it holds.
    """
    shards = len(quota)
    names = [f"_n{s}" for s in range(shards)]
    counts = [F.col(n) for n in names]
    sizes = members.groupBy("link").agg(F.count(F.lit(1)).alias("_size"))
    # a row's largest link decides with whom it starts and is admitted
    homes = stage(members.join(sizes, "link").groupBy("id").agg(F.max(F.struct("_size", "link")).alias("h"))
                  .select("id", F.col("h.link").alias("_home"), F.col("h._size").alias("_size")), "shard-start")
    large = homes.groupBy("_home").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > min(quota) // 8).collect()    # at most 9 * shards rows
    labels = homes.withColumn("shard", _begin(large, quota))
    members = stage(members, "shard-links")
    for turn in range(rounds):
        load = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}    # one row per shard
        room = [quota[s] - load.get(s, 0) for s in range(shards)]
        wish = stage(labels.join(_seen(members, labels, names), "id")
                     .select("id", "_home", "_size", "shard", _wish(counts, [1] * shards if turn % 2 == 0 else room, F.col("_home")).alias("_to")), "shard-wishes")
        flows = wish.filter("_to <> shard").groupBy("_to").agg(F.count(F.lit(1)).alias("n")).collect()                 # one row per shard
        if not flows and turn % 2:
            labels = wish.select("id", "_home", "_size", "shard")
            break
        leaving = {r["shard"]: r["n"] for r in wish.filter("_to <> shard").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        share = F.lit(0.0)
        for r in flows:
            place = room[r["_to"]] + (leaving.get(r["_to"], 0) / 2 if turn % 2 == 0 else 0)
            share = F.when(F.col("_to") == r["_to"], F.lit(min(1.0, max(0.0, place / r["n"])))).otherwise(share)
        big = F.col("_size") > min(max(1, r) for r in quota) // 8
        draw = F.pmod(F.xxhash64(F.when(big, F.xxhash64("id")).otherwise(F.xxhash64("_home")), F.col("_to"), F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)
        moved = wish.select("id", "_home", "_size", F.when(draw < share, F.col("_to")).otherwise(F.col("shard")).alias("shard"))
        labels = stage(moved, "shard-labels")
    gathered = F.when(F.col("_size") > min(quota) // 8, F.col("shard")).otherwise(_wish(counts, [1] * shards, F.col("_home")))
    return stage(labels.join(_seen(members, labels, names), "id").select("id", "_home", "_size", gathered.alias("shard")), "shard-gathered")


def _whole(ranked: DataFrame, edges: dict[int, int]) -> dict[int, int]:
    """``edges`` (label: rank of the first row beyond the quota), moved down to the first row of the link that an edge would cut, if that link is no larger than
    an eighth of the quota. At most one link per shard is looked up."""
    if not edges:
        return edges
    at = F.lit(False)
    for label, rank in edges.items():
        at = at | ((F.col("_label") == label) & F.col("_rank").isin(rank - 1, rank))
    links: dict[int, list] = {}
    for r in ranked.filter(at).filter(F.col("_home").isNotNull()).select("_label", "_home").collect():      # two rows per label
        links.setdefault(r["_label"], []).append(r["_home"])
    cut = {label: homes[0] for label, homes in links.items() if len(homes) == 2 and homes[0] == homes[1]}
    if not cut:
        return edges
    inside = F.lit(False)
    for label, home in cut.items():
        inside = inside | ((F.col("_label") == label) & (F.col("_home") == home))
    starts = {r["_label"]: r["n"] for r in ranked.filter(inside).groupBy("_label").agg(F.min("_rank").alias("n")).collect()}
    return {label: starts[label] if label in starts and edges[label] - starts[label] <= edges[label] // 8 else edges[label] for label in edges}


def shard_rows(rows: DataFrame, members: DataFrame, shards: int, id_col: str, tie: Column, rounds: int = ROUNDS,
               range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: counts of any two shards differ by at most one, slots run from 0 without gaps.

    Linked rows get the shard that ``propagate`` finds. In a shard beyond its quota the smallest links leave, whole ones; they and the rows without a link fill
    the places left, links next to each other, so that only the edge between two shards can cut one. Numbering is by sorted ranges, larger links first: rows per range and label are
    counted, then summed up, so no task sees more than a range, and a link of any size, or rows alike in all columns, fall into several. ``tie`` orders rows of equal id.
    """
    n = rows.count()
    quota = [n // shards + (1 if s < n % shards else 0) for s in range(shards)]
    labels = propagate(members, quota, rounds)
    ranges = max(1, -(-n // range_rows))
    labelled = stage(rows.join(labels.withColumnRenamed("id", "_id"), F.col(id_col) == F.col("_id"), "left").drop("_id")
                     .withColumn("_label", F.coalesce("shard", F.lit(shards))).drop("shard")
                     .withColumn("_tie", tie).withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    order = [F.col("_label"), F.col("_size").desc_nulls_last(), F.col("_home"), F.col(id_col), F.col("_tie"), F.col("_row")]
    # the number of a sorted row: its partition above the lowest 33 bits, its place in the partition in them
    numbered = stage(labelled.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("_tie", "_row", "_size")
                     .withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)), "shard-ranges")
    sums = numbered.groupBy("_label", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # one row per range, and at most ``shards`` more
    before = sums.select("_label", "_range", "_first", (F.sum("_n").over(Window.partitionBy("_label").orderBy("_range")) - F.col("_n")).alias("_before"))
    ranked = stage(numbered.join(before, ["_label", "_range"]).withColumn("_rank", F.col("_at") - F.col("_first") + F.col("_before"))
                   .drop("_at", "_range", "_first", "_before"), "shard-ranked")
    held = {r["_label"]: r["n"] for r in sums.groupBy("_label").agg(F.sum("_n").alias("n")).collect()}               # one row per shard
    kept = _whole(ranked, {s: quota[s] for s in range(shards) if held.get(s, 0) > quota[s]})
    kept = [kept.get(s, held.get(s, 0)) for s in range(shards)]
    pool, limit, at = F.col("_rank"), F.lit(0), held.get(shards, 0)
    for s in range(shards):
        pool = F.when(F.col("_label") == s, F.col("_rank") - kept[s] + at).otherwise(pool)
        limit = F.when(F.col("_label") == s, F.lit(kept[s])).otherwise(limit)
        at += held.get(s, 0) - kept[s]
    stays = (F.col("_label") < shards) & (F.col("_rank") < limit)
    shard, slot, start = F.lit(None).cast("int"), F.lit(None).cast("bigint"), 0
    for s in range(shards):
        free = quota[s] - kept[s]
        inside = (F.col("_pool") >= start) & (F.col("_pool") < start + free)
        shard, slot = F.when(inside, F.lit(s)).otherwise(shard), F.when(inside, F.col("_pool") - start + kept[s]).otherwise(slot)
        start += free
    return (ranked.withColumn("_pool", pool).withColumn("_stays", stays)
            .withColumn("shard", F.when(F.col("_stays"), F.col("_label")).otherwise(shard).cast("int"))
            .withColumn("slot", F.when(F.col("_stays"), F.col("_rank")).otherwise(slot).cast("bigint"))
            .drop("_label", "_home", "_rank", "_pool", "_stays"))


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(id, size, text_crc32, shard, slot): equal texts are linked and stay together wherever a shard has room for them.

    Size is the UTF-8 bytes of the text (none for NULL) plus 1. NULL texts and NULL ids have no link. The checksum of a NULL text is that of no bytes, 0. Repeated rows
    of an id take a slot each and prefer the same shard. An empty table gives no rows.
    """
    utf8 = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = stage(docs.select(F.col(id_col), (F.octet_length(utf8) + 1).cast("bigint").alias("size"), F.crc32(utf8).cast("bigint").alias("text_crc32"),
                             F.when(F.col(text_col).isNotNull(), F.sha2(utf8, 256)).alias("_text")), "shard-input")
    several = rows.filter(F.col("_text").isNotNull()).groupBy("_text").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_text")
    linked = rows.filter(F.col(id_col).isNotNull()).join(stage(several, "shard-texts"), "_text", "left_semi")
    members = linked.select(F.col(id_col).alias("id"), F.col("_text").alias("link")).distinct()
    return shard_rows(rows, members, shards, id_col, F.coalesce("_text", F.lit("")), rounds).select(id_col, "size", "text_crc32", "shard", "slot")
