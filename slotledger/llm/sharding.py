"""Sharding by balanced label propagation, in DataFrame operations only.

Linked documents start in equal shares, in the order of their group's hash, so that few groups start apart. Round by
round they move to the shard in which most of their group's documents are. Movers have quotas for each pair of shards: a
place may be free, or left in the same round, so that shards without room exchange documents. They enter by the rank of
their group's hash, so groups stay together, and a group larger than a shard fills one shard after another. Documents
without links then fill the shards up to sizes that differ by at most one row.

Only sums for each shard reach the driver. Ranks are made of counts of hash buckets and positions inside a bucket, so
no task sorts a shard; votes are counted before they are shuffled, so a group of a third of all documents is no burden.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotledger.llm.common import stored

SHARDS = 16
ROUNDS = 12
BUCKET_ROWS = 1 << 16
GROUP_BUCKETS, NODE_BUCKETS = 256, 64


def _ranked(df: DataFrame, node: str, rows: int, *by: str) -> DataFrame:
    """Adds "rank": gapless numbers from 0 in each value of ``by``, the same on every run for the same nodes."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-rows // BUCKET_ROWS))
    split = df.withColumn("bucket", F.pmod(F.xxhash64(node), F.lit(buckets)))
    sizes = split.groupBy(*by, "bucket").agg(F.count("*").alias("size"))
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    inside = Window.partitionBy(*by, "bucket").orderBy(node)
    placed = split.withColumn("place", F.row_number().over(inside) - 1)
    return placed.join(offsets, [*by, "bucket"]).withColumn("rank", F.col("offset") + F.col("place")).drop("bucket", "place", "offset")


def _choose(column: Column, values: list) -> Column:
    """values[column], for a short list of numbers."""
    return F.element_at(F.array(*map(F.lit, values)), (column + 1).cast("int"))


def _counts(labels: DataFrame, shards: int) -> list[int]:
    found = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    return [found.get(j, 0) for j in range(shards)]


def _seeded(nodes: DataFrame, shards: int) -> DataFrame:
    """(node, lead, label): equal shares of the nodes, by the order of their leads, so that few groups start apart."""
    sizes = stored(nodes.groupBy("lead").agg(F.count("*").alias("n")).withColumn("bucket", F.pmod("lead", F.lit(BUCKET_ROWS))), "sizes")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    total = sizes.groupBy().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    parts = sizes.groupBy("bucket").agg(F.sum("n").alias("size"))
    offsets = parts.select("bucket", F.coalesce(F.sum("size").over(before.orderBy("bucket")), F.lit(0)).alias("offset"))
    inside = F.coalesce(F.sum("n").over(before.partitionBy("bucket").orderBy("lead")), F.lit(0))
    starts = sizes.withColumn("inside", inside).join(offsets, "bucket").select("lead", "n", (F.col("offset") + F.col("inside")).alias("start"))
    ends = [sum(total // shards + (k < total % shards) for k in range(j + 1)) for j in range(shards)]

    def shard(place: Column) -> Column:
        return reduce(lambda a, j: F.when(place < ends[j], j).otherwise(a), reversed(range(shards - 1)), F.lit(shards - 1)).cast("int")

    starts = starts.select("lead", "start", shard(F.col("start")).alias("label"), shard(F.col("start") + F.col("n") - 1).alias("end"))
    placed = nodes.join(starts, "lead")
    whole = placed.filter("label = end").select("node", "lead", "label")
    # fewer groups than shards lie across an end
    cut = _ranked(placed.filter("label < end").select("node", "lead", "start"), "node", total, "lead")
    return whole.union(cut.select("node", "lead", shard(F.col("start") + F.col("rank")).alias("label")))


def admitted(wanted: list[list[int]], room: list[int]) -> list[list[int]]:
    """How many of the movers wanted[from][to] may go at once: along ways that end in a shard with room, or in a circle.

    So places that others leave in the same round count, and no shard gets more than ``room`` beyond what leaves it.
    """
    shards = len(room)
    left, free = [list(row) for row in wanted], list(room)

    def way(start: int) -> list[int]:
        """The shortest way out of ``start``."""
        came, queue = {}, [start]
        for i in queue:
            for j in range(shards):
                if left[i][j] and j not in came and i != j:
                    came[j] = i
                    if free[j] > 0 and j != start or j == start:
                        out = [j, i]
                        while out[-1] != start:
                            out.append(came[out[-1]])
                        return out[::-1]
                    queue.append(j)
        return []

    for start in range(shards):
        while found := way(start):
            steps = list(zip(found, found[1:], strict=False))
            n = min(left[i][j] for i, j in steps)
            if found[0] != found[-1]:
                n = min(n, free[found[-1]])
                free[found[-1]] -= n
                free[start] += n
            for i, j in steps:
                left[i][j] -= n
    return [[a - b for a, b in zip(x, y, strict=True)] for x, y in zip(wanted, left, strict=True)]


def balanced_labels(links: DataFrame, capacity: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(node, label): shards for all nodes of ``links`` (node long, group), at most capacity[label] nodes in each.

    A node may be in several groups. Capacities must differ by at most one, larger ones first, and suffice for all.
    """
    shards = len(capacity)
    links = stored(links.select("node", "group").distinct(), "links")
    nodes = links.groupBy("node").agg(F.min(F.xxhash64("group")).alias("lead"))
    labels = stored(_seeded(stored(nodes, "leads"), shards), "labels")
    full: dict[int, int] = {}
    idle = 0
    for turn in range(rounds):
        counts = _counts(labels, shards)
        room = [c - n for c, n in zip(capacity, counts, strict=True)]
        # in turn, all shards may be wished for, and those with room that did not turn movers away since they lost members
        full = {j: n for j, n in full.items() if counts[j] >= n}
        open_ = [turn % 2 == 0 or (room[j] > 0 and j not in full) for j in range(shards)]
        votes = [F.count_if(F.col("label") == j).alias(f"n{j}") for j in range(shards)]
        by_group = links.join(labels, "node").groupBy("group").agg(*votes)
        by_node = links.join(by_group, "group").groupBy("node").agg(*[F.sum(f"n{j}").alias(f"n{j}") for j in range(shards)])
        # the most votes among the own shard and open ones; among equals, members of a group agree, differently each round,
        # so that about as many go each way
        offers = F.array(
            *[
                F.struct(
                    F.when((F.col("label") == j) | F.lit(open_[j]), F.col(f"n{j}")).otherwise(-1).alias("n"),
                    F.xxhash64("lead", F.lit(j), F.lit(turn)).alias("tie"),
                    F.lit(j).alias("j"),
                )
                for j in range(shards)
            ]
        )
        bucket = F.pmod("lead", F.lit(GROUP_BUCKETS)) * NODE_BUCKETS + F.pmod(F.xxhash64("node"), F.lit(NODE_BUCKETS))
        wishes = stored(
            labels.join(by_node, "node").select(
                "node", "lead", "label", F.array_max(offers)["j"].cast("int").alias("wish"), bucket.cast("int").alias("bucket")
            ),
            "wishes",
        )
        moving = stored(wishes.filter("wish <> label").groupBy("label", "wish", "bucket").agg(F.count("*").alias("n")), "moving")
        wanted = [[0] * shards for _ in range(shards)]
        for r in moving.groupBy("label", "wish").agg(F.sum("n").alias("n")).collect():
            wanted[r["label"]][r["wish"]] = r["n"]
        quotas = admitted(wanted, room)
        full |= {j: counts[j] for j in range(shards) if any(wanted[i][j] > quotas[i][j] for i in range(shards))}
        idle = 0 if any(map(any, quotas)) else idle + 1
        if idle == 2:
            break
        if idle:
            continue
        # whole buckets below the one in which a quota ends, and the first of that one
        pair = F.col("label") * shards + F.col("wish")
        so_far = F.sum("n").over(Window.partitionBy("label", "wish").orderBy("bucket"))
        left = _choose(pair, [q for row in quotas for q in row]) - so_far + F.col("n")
        ends = moving.withColumn("left", left).filter((F.col("left") >= 0) & (F.col("left") < F.col("n")))
        cuts = {r["label"] * shards + r["wish"]: (r["bucket"], r["left"]) for r in ends.collect()}
        # quotas that take all have no such bucket
        cut = [cuts.get(k, (GROUP_BUCKETS * NODE_BUCKETS, 0)) for k in range(shards * shards)]
        place = F.row_number().over(Window.partitionBy("label", "wish", "bucket").orderBy("lead", "node"))
        last = _choose(pair, [c[0] for c in cut])
        enters = (F.col("bucket") < last) | ((F.col("bucket") == last) & (F.col("place") <= _choose(pair, [c[1] for c in cut])))
        labels = stored(
            wishes.withColumn("place", place).select("node", "lead", F.when(enters, F.col("wish")).otherwise(F.col("label")).alias("label")),
            "labels",
        )
    return labels.select("node", "label")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """A shard and a gapless slot for every document; equal texts are linked, and row counts differ by at most one.

    Columns: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law ("rows"), shard, slot, grown_shard (null).
    Null text counts as empty and is linked with empty texts. Null and repeated ids are rows like any other. More
    shards than documents leave the last shards empty. Further columns are not read; an empty table gives an empty one.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("group"),
            F.monotonically_increasing_id().alias("node"),
        ),
        "documents",
    )
    total = rows.count()
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    groups = rows.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1").select("group")
    links = rows.select("node", "group").join(groups, "group")
    labels = stored(balanced_labels(links, capacity, rounds), "shards")
    filled = _counts(labels, shards)
    linked = _ranked(labels, "node", sum(filled), "label").select("node", F.col("label").alias("shard"), F.col("rank").alias("slot"))
    rest = _ranked(rows.join(labels, "node", "left_anti").select("node"), "node", total - sum(filled))
    ends = [sum(capacity[: j + 1]) - sum(filled[: j + 1]) for j in range(shards)]
    shard = reduce(lambda a, j: F.when(F.col("rank") < ends[j], j).otherwise(a), reversed(range(shards - 1)), F.lit(shards - 1))
    shift = [filled[j] - (ends[j - 1] if j else 0) for j in range(shards)]
    single = rest.select("node", shard.cast("int").alias("shard"), "rank")
    single = single.select("node", "shard", (F.col("rank") + _choose(F.col("shard"), shift)).alias("slot"))
    return rows.join(linked.union(single), "node").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
