"""Mixing sources to target weights by Pfair scheduling.

Each source is a task whose share of the stream is its weight. Its j-th block
may not come before its release floor((j - 1) / share) and has to come by its
deadline ceil(j / share); dealing slots by earliest deadline first then keeps
every source within less than one block of its share at every point.

With integer weights the schedule repeats with a period of their sum, so only
one period is worked out, however long the stream is. When a source runs out,
a new phase deals its share to the others in proportion. The place of a block
is then arithmetic on its number within its source.

A schedule has up to `NODES` sources. More are scheduled as a tree: rare ones
share a node, whose weight is the sum of theirs and whose blocks are dealt to
them by a schedule of its own, so each stays within less than one block of its
share of the node's stream. Schedules below the top are worked out by Spark.
"""

from __future__ import annotations

import heapq
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textweir.llm.common import Scratch

#: Sources of one schedule.
NODES = 256
#: Largest sum of the weights of one schedule, which is its period.
MAX_PERIOD = 1 << 20
#: Hash buckets of a source, within which its rows are numbered.
BUCKETS = 1024
#: Sum of the default weights, and the power of a source's size that they follow.
PERIOD, TEMPER = 1000, 0.5
#: The key for the weight of all sources that have none given.
POOL = "\x00pooled"
PLAN = "node string, first bigint, end bigint, start bigint, period bigint, weight bigint, places array<int>, parent string"


def period(weights: list[int]) -> list[int]:
    """The source of each slot of one period; each gets its weight."""
    total = sum(weights)
    releases: list[list[tuple[int, int]]] = [[] for _ in range(total)]
    for s, w in enumerate(weights):
        for j in range(w):
            releases[j * total // w].append((-(-(j + 1) * total // w), s))
    ready: list[tuple[int, int]] = []
    slots = []
    for released in releases:
        for job in released:
            heapq.heappush(ready, job)
        slots.append(heapq.heappop(ready)[1])
    return slots


def phases(blocks: list[int], weights: list[int]) -> list[tuple[int, int, int, int, int, int, list[int]]]:
    """Rows (source, first block, end block, first slot, period, weight, slots of a period) that place every block."""
    left, done, start, rows = list(blocks), [0] * len(blocks), 0, []
    while active := [s for s, n in enumerate(left) if n]:
        common = gcd(*(weights[s] for s in active))
        share = [weights[s] // common for s in active]
        slots = period(share)
        whole = min(left[s] // w for s, w in zip(active, share, strict=True))
        served = [whole * w for w in share]
        length = whole * len(slots)
        if all(left[s] > n for s, n in zip(active, served, strict=True)):  # then the period in which the first one runs out
            for k in slots:
                served[k] += 1
                length += 1
                if served[k] == left[active[k]]:
                    break
        places: list[list[int]] = [[] for _ in active]
        for at, k in enumerate(slots):
            places[k].append(at)
        for k, s in enumerate(active):
            if served[k]:
                rows.append((s, done[s], done[s] + served[k], start, len(slots), share[k], places[k]))
            done[s] += served[k]
            left[s] -= served[k]
        start += length
    return rows


def default_weights(sizes: list[float]) -> list[int]:
    """Integer weights in proportion to the square roots of the sizes; each is at least one."""
    roots = [n**TEMPER for n in sizes]
    total = sum(roots) or 1
    return [max(1, round(PERIOD * r / total)) for r in roots]


def _rows(nodes: list[str], blocks: list[int], weights: list[int], parent: str) -> list[tuple]:
    return [(nodes[s], *row, parent) for s, *row in phases(blocks, weights)]


def _pooled(spark: SparkSession, rest: DataFrame, scratch: Scratch, nodes: int) -> tuple[list[DataFrame], int, float]:
    """Plans of the levels below the pool for its members (node, blocks, root); the pool's blocks, and the sum of the members' square roots.

    Members are hashed into groups of a few dozen, groups into groups, until
    there are few enough for one schedule. A group's square root is the sum of its members'.
    """
    plans = []
    level, depth = scratch.keep(rest, "pool-0"), 0
    while True:
        count, blocks, root = level.agg(F.count(F.lit(1)), F.sum("blocks"), F.sum("root")).first()
        if not count:
            return plans, 0, 0.0
        groups = 1 if count <= nodes else -(-count // max(2, nodes // 4))
        parent = F.lit(POOL) if groups == 1 else F.concat(F.lit(f"\x00{depth}:"), F.pmod(F.xxhash64("node", F.lit(depth)), F.lit(groups)).cast("string"))
        level = scratch.keep(level.withColumn("parent", parent), f"level-{depth}")

        def plan(group):
            import pandas as pd

            group = group.sort_values("node")
            total = group["root"].sum()
            weights = [max(1, round(PERIOD * r / total)) for r in group["root"]]
            rows = _rows(group["node"].tolist(), group["blocks"].tolist(), weights, group["parent"].iloc[0])
            return pd.DataFrame(rows, columns=[c.split()[0] for c in PLAN.split(", ")])

        plans.append(scratch.keep(level.groupBy("parent").applyInPandas(plan, PLAN), f"plan-{depth}"))
        if groups == 1:
            return plans, int(blocks), float(root)
        level = level.groupBy(F.col("parent").alias("node")).agg(F.sum("blocks").alias("blocks"), F.sum("root").alias("root"))
        depth += 1


def mix(docs: DataFrame, weights: dict[str, int] | None = None, block_rows: int = 1, nodes: int = NODES) -> DataFrame:
    """Every row of `docs`, all columns, with its `mix_block`, `mix_slot` and `mix_position`.

    Ordering by mix_position gives the mixture. A block is `block_rows` rows
    of a source (the last one may have fewer, so positions have gaps there);
    within a source rows come in the order of a hash of the row, and rows
    alike in all columns are interchangeable. Null is a source like any other.

    Every source with an explicit weight is scheduled by it; all others share
    the weight given for POOL (1 by default) in proportion to the square roots
    of their sizes. Without weights all sources have weights in that
    proportion, and those beyond the `nodes` - 1 largest share a node of the
    tree. A weight of 0 or less is none. A source that runs out leaves its
    share to the others, so every row has exactly one place. Columns of `docs`
    with the names added here are replaced; any other may have any name. An
    empty table gives an empty one. Weights that add up to more than
    MAX_PERIOD raise ValueError.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    kept = [c for c in docs.columns if c not in ("mix_block", "mix_slot", "mix_position")]
    hashable = [f.name for f in docs.schema.fields if f.name in kept and "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    hashed = F.xxhash64(*(F.col(f"`{c}`") for c in ("doc_id", *hashable)))
    node = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), node.alias("node"), hashed.alias("hash"))
    rows = rows.withColumn("bucket", F.pmod("hash", F.lit(BUCKETS)).cast("int"))
    sizes = scratch.keep(rows.groupBy("node", "bucket").agg(F.count(F.lit(1)).alias("n")), "sizes")
    before = F.sum("n").over(Window.partitionBy("node").orderBy("bucket")) - F.col("n")
    offsets = scratch.keep(sizes.select("node", "bucket", before.alias("offset")), "offsets")
    blocks = F.ceil(F.sum("n") / block_rows).cast("bigint")
    sources = scratch.keep(sizes.groupBy("node").agg(F.sum("n").alias("n"), blocks.alias("blocks")).withColumn("root", F.pow("n", F.lit(TEMPER))), "sources")
    if weights is None:
        top = sources.orderBy(F.desc("n"), "node").limit(nodes - 1).collect()
    else:
        given = {f"s{s}": w for s, w in weights.items() if w > 0 and s != POOL}
        top = sources.where(F.col("node").isin(*given)).collect() if given else []
    top = sorted(top, key=lambda r: r["node"])
    names = [r["node"] for r in top]
    rest = sources.where(~F.col("node").isin(*names)) if names else sources
    plans, pool_blocks, pool_root = _pooled(spark, rest.select("node", "blocks", "root"), scratch, nodes)
    if weights is None:
        integers = default_weights([r["n"] for r in top] + ([pool_root ** (1 / TEMPER)] if pool_blocks else []))
    else:
        integers = [given[n] for n in names] + ([max(1, weights.get(POOL, 1))] if pool_blocks else [])
    if sum(integers) > MAX_PERIOD:
        raise ValueError(f"the weights add up to more than {MAX_PERIOD}")
    planned = _rows([*names, POOL][: len(integers)], [*(r["blocks"] for r in top), pool_blocks][: len(integers)], integers, "")
    plans.append(scratch.keep(spark.createDataFrame(planned, PLAN), "plan"))

    within = Window.partitionBy("node", "bucket").orderBy("hash", "row.doc_id")
    # Offsets and plans grow with the number of sources: they are tables, which Spark broadcasts only below its threshold.
    ranked = rows.withColumn("rank", F.row_number().over(within)).join(offsets, ["node", "bucket"])
    at = F.col("offset") + F.col("rank") - 1
    found = ranked.select("row", "node", F.floor(at / block_rows).alias("block"), F.pmod(at, F.lit(block_rows)).alias("in_block")).withColumn("slot", F.col("block"))
    for k, plan in enumerate(plans):
        turn = F.col("slot") - F.col("first")
        slot = F.col("start") + F.floor(turn / F.col("weight")) * F.col("period") + F.get("places", F.pmod(turn, F.col("weight")).cast("int"))
        places = found.join(plan, "node").where((F.col("slot") >= F.col("first")) & (F.col("slot") < F.col("end")))
        placed = places.select("row", F.col("parent").alias("node"), "block", "in_block", slot.cast("bigint").alias("slot"))
        if k + 1 < len(plans):  # sources that are scheduled further up
            placed = placed.unionByName(found.join(plan.select("node").distinct(), "node", "left_anti"))
        found = placed
    position = (F.col("slot") * block_rows + F.col("in_block")).alias("mix_position")
    return found.select(*(F.col("row").getField(c).alias(c) for c in kept), F.col("block").alias("mix_block"), F.col("slot").alias("mix_slot"), position)
