"""Resharding by minimum-cost flow.

An old layout keeps documents in shards, each shard in blocks (one folder per
block).  From the byte sizes of the old shards and the capacities of the new
ones a minimum-cost flow says how many bytes go from which old shard to which
new one: staying is free, a moved byte costs its link's price (1 by default),
so the flow moves the fewest bytes.  Whole blocks realise it; only a block that
straddles the end of a flow is cut between documents, largest first, so that
its shares come out to within a small document.  Blocks that stay whole
keep their files, all others are rewritten, and a manifest of the two kinds is
the new layout.

The driver sees shards x blocks sizes (a parameter, not the corpus) and the flow
network has one node per shard.  Sizes count the UTF-8 bytes of the text
(null: none) plus 16.

Defined results: a null ``doc_id`` is placed like any other; repeated rows are
each kept; an empty table gives an empty layout; all columns are carried inside
the struct ``row``, so no name can clash.
"""

from __future__ import annotations

import heapq

import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROW_BYTES = 16


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Cheapest flow {(old, new): bytes} that sends all supply within capacity,
    by successive shortest paths (Bellman-Ford; the network has a node per shard)."""
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are below the bytes held")
    n, m = len(supply), len(capacity)
    price = [[cost(i, j) for j in range(m)] for i in range(n)]
    left, room, flow = list(supply), list(capacity), {}
    while any(left):
        far_o = [0 if left[i] else None for i in range(n)]
        far_n, from_o, from_n = [None] * m, [None] * m, [None] * n
        changed = True
        while changed:
            changed = False
            for i in range(n):
                if far_o[i] is not None:
                    for j in range(m):
                        if far_n[j] is None or far_o[i] + price[i][j] < far_n[j]:
                            far_n[j], from_o[j], changed = far_o[i] + price[i][j], i, True
            for i, j in flow:  # bytes that already go there may be sent elsewhere
                if far_n[j] is not None and (far_o[i] is None or far_n[j] - price[i][j] < far_o[i]):
                    far_o[i], from_n[i], changed = far_n[j] - price[i][j], j, True
        end = min((j for j in range(m) if room[j] and far_n[j] is not None), key=lambda j: far_n[j])
        forward, back, at = [], [], end
        while True:
            i = from_o[at]
            forward.append((i, at))
            if from_n[i] is None:
                break
            back.append((i, from_n[i]))
            at = from_n[i]
        send = min([left[i], room[end], *(flow[x] for x in back)])
        for x in forward:
            flow[x] = flow.get(x, 0) + send
        for x in back:
            flow[x] -= send
            if not flow[x]:
                del flow[x]
        left[i] -= send
        room[end] -= send
    return flow


def write_layout(docs: DataFrame, path: str, shards: int, block_bytes: int = 1 << 28) -> StructType:
    """An old layout to start from: documents by hash in ``shards`` shards, each
    of enough blocks (4 at least) to keep a block near ``block_bytes``; one
    folder per block.  Returns the schema of its rows: the document as one
    struct ``row``, ``old_shard`` and ``old_block``."""
    total = docs.agg(F.sum(size_of(F.col("text"))).alias("n")).first()["n"] or 0
    blocks = max(4, -(-total // (shards * block_bytes)))
    key = F.xxhash64("row.doc_id", "row.text")
    rows = (docs.select(F.struct("*").alias("row"))
            .withColumn("old_shard", F.pmod(key, F.lit(shards)).cast("int"))
            .withColumn("old_block", F.pmod(F.shiftrightunsigned(key, 24), F.lit(blocks)).cast("int")))
    (rows.repartition("old_shard", "old_block").write.option("compression", "zstd")
     .partitionBy("old_shard", "old_block").parquet(path))
    return rows.schema


def transfers(sizes: dict[tuple[int, int], int], capacity: list[int], old_shards: int, cost=None) -> list[tuple[int, int, int, int, int]]:
    """Block transfers (old_shard, old_block, from_byte, to_byte, new_shard);
    the bytes of a block are counted along its own document order."""
    supply = [0] * old_shards
    for (s, _), n in sizes.items():
        supply[s] += n
    flow = min_cost_flow(supply, capacity, cost or (lambda i, j: int(i != j)))
    out = []
    for s in range(old_shards):
        # bytes that stay come first, so that the most blocks stay whole
        goes = sorted(((j, n) for (i, j), n in flow.items() if i == s), key=lambda x: (x[0] != s, x[0]))
        blocks = sorted((b, n) for (i, b), n in sizes.items() if i == s)
        k, used = 0, 0
        for b, n in blocks:
            at = 0
            while at < n:
                j, most = goes[k]
                step = min(n - at, most - used)
                if step:
                    out.append((s, b, at, at + step, j))
                at, used = at + step, used + step
                if used == most and k + 1 < len(goes):
                    k, used = k + 1, 0
    return out


def reshard(spark: SparkSession, old: str, schema: StructType, new: str, old_shards: int, new_shards: int, cost=None) -> DataFrame:
    """Move the layout at ``old`` to ``new_shards`` shards of equal capacity and
    return the new layout: ``row``, ``shard``, ``old_shard``, ``old_block``.

    Files of blocks that stay whole are read where they are; the others are
    rewritten below ``new`` by (shard, old shard, block).
    """
    rows = spark.read.schema(schema).parquet(old)
    sizes = {(r["old_shard"], r["old_block"]): r["n"]  # one row per block
             for r in rows.groupBy("old_shard", "old_block").agg(F.sum(size_of(F.col("row.text"))).alias("n")).collect()}
    total = sum(sizes.values())
    capacity = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    shares: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for s, b, a, z, j in transfers(sizes, capacity, old_shards, cost):
        shares.setdefault((s, b), []).append((j, z - a))
    block = ["old_shard", "old_block"]
    whole = spark.createDataFrame([(*k, v[0][0]) for k, v in shares.items() if len(v) == 1], "old_shard int, old_block int, shard int")
    cut = {k: v for k, v in shares.items() if len(v) > 1}
    cuts = spark.createDataFrame(list(cut), "old_shard int, old_block int")
    placed = rows.join(F.broadcast(whole), block)
    kept = placed.where("shard = old_shard").select("row", "shard", *block)
    moved = placed.where("shard <> old_shard").select("row", "shard", *block)

    # documents of a cut block, large ones first, each to the share with the most room left
    order = Window.partitionBy(*block).orderBy("row.doc_id", F.xxhash64("row.text"), "row.text")
    parted = rows.join(F.broadcast(cuts), block, "left_semi").withColumn("_rank", F.row_number().over(order))

    def split(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        room = [[-n, j] for j, n in cut[tuple(int(k) for k in key)]]
        heapq.heapify(room)
        pdf = pdf.sort_values(["_size", "_rank"], ascending=[False, True])
        to = []
        for n in pdf["_size"].tolist():
            most, j = room[0]
            to.append(j)
            heapq.heapreplace(room, [most + n, j])
        return pdf.assign(shard=to)[["old_shard", "old_block", "_rank", "shard"]]

    to = (parted.select(*block, "_rank", size_of(F.col("row.text")).alias("_size")).groupBy(*block)
          .applyInPandas(split, "old_shard int, old_block int, _rank int, shard int"))
    parted = parted.join(to, [*block, "_rank"]).select("row", "shard", *block)
    (moved.unionByName(parted).repartition("shard", *block).write.option("compression", "zstd")
     .partitionBy("shard", *block).parquet(new))
    return kept.unionByName(spark.read.schema(kept.schema).parquet(new))


def with_slots(layout: DataFrame, *order: str) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard: a running number in each
    (shard, old shard, block) from where the ones before it end."""
    unit = ["shard", "old_shard", "old_block"]
    inside = F.row_number().over(Window.partitionBy(*unit).orderBy(*order))
    count = layout.groupBy(*unit).agg(F.count(F.lit(1)).alias("_n"))  # one row per block and share
    before = Window.partitionBy("shard").orderBy("old_shard", "old_block").rowsBetween(Window.unboundedPreceding, -1)
    base = count.select(*unit, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (layout.withColumn("_at", inside - 1).join(F.broadcast(base), unit)
            .withColumn("slot", (F.col("_at") + F.col("_base")).cast("long")).drop("_at", "_base"))
