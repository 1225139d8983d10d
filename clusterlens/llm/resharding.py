"""Resharding by minimum-cost flow (law ``bytes``: shard sizes near equal).

Old shard sizes and new capacities are the ends of a flow network; moving a
byte between two different shards costs 1 (or what a cost matrix says), keeping
it is free. The cheapest flow says how many bytes go from where to where, and
whole blocks are picked to carry it. Documents with equal texts are a group; a
block holds whole groups: all of an old shard's groups with one hash number,
or a single heavy group. A group larger than a shard's fair share gets a shard
of its own, and the others share the rest.

Spark sums the block sizes; the driver gets one row per block, at most
``blocks`` per shard and as many heavy groups, whatever the table's size.
Affected shards are then rewritten: documents are range-partitioned by (shard,
doc_id) and numbered within their shard from per-part counts.

Defined results: a null text counts as empty (16 bytes) and belongs to the
group of empty texts; documents of equal doc_id stand side by side in text
order, a null id first; an empty table gives empty shards. Only doc_id and
text (and the old shard, if given) are read.
"""

from __future__ import annotations

from collections import defaultdict, deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import table
from clusterlens.session import scratch_path

SHARDS = 40
BLOCKS = 256            # per old shard
OVERHEAD = 16           # bytes a document takes besides its text


class Flow:
    """Minimum-cost flow by successive cheapest paths."""

    def __init__(self, nodes: int):
        self.edges: list[list] = []                     # [to, room, cost]
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def edge(self, a: int, b: int, room: int, cost: int) -> int:
        self.out[a].append(len(self.edges))
        self.edges.append([b, room, cost])
        self.out[b].append(len(self.edges))
        self.edges.append([a, 0, -cost])
        return len(self.edges) - 2

    def sent(self, edge: int) -> int:
        return self.edges[edge ^ 1][1]

    def solve(self, source: int, sink: int) -> int:
        """Send all that fits; the total cost."""
        total = 0
        while True:
            cost, via = {source: 0}, {}
            queue, waiting = deque([source]), {source}
            while queue:
                a = queue.popleft()
                waiting.discard(a)
                for e in self.out[a]:
                    b, room, c = self.edges[e]
                    if room > 0 and cost[a] + c < cost.get(b, float("inf")):
                        cost[b], via[b] = cost[a] + c, e
                        if b not in waiting:
                            queue.append(b)
                            waiting.add(b)
            if sink not in via:
                return total
            path, b = [], sink
            while b != source:
                path.append(via[b])
                b = self.edges[via[b] ^ 1][0]
            amount = min(self.edges[e][1] for e in path)
            for e in path:
                self.edges[e][1] -= amount
                self.edges[e ^ 1][1] += amount
            total += amount * cost[sink]


@dataclass(frozen=True)
class Block:
    old: int
    number: int         # hash number, or the group's hash for a heavy group
    heavy: bool
    size: int


def transfers(supply: list[int], capacity: list[int],
              cost: list[list[int]] | None = None) -> dict[tuple[int, int], int]:
    """Bytes from old shard i to new shard j that cost the least in all."""
    n, m = len(supply), len(capacity)
    net = Flow(n + m + 2)
    source, sink = n + m, n + m + 1
    for i, s in enumerate(supply):
        net.edge(source, i, s, 0)
    for j, c in enumerate(capacity):
        net.edge(n + j, sink, c, 0)
    ways = {(i, j): net.edge(i, n + j, supply[i], cost[i][j] if cost else int(i != j))
            for i in range(n) for j in range(m) if supply[i]}
    net.solve(source, sink)
    return {k: net.sent(e) for k, e in ways.items() if net.sent(e)}


def assign(blocks: list[Block], shards: int, cost: list[list[int]] | None = None) -> dict[Block, int]:
    """New shard of every block."""
    blocks = sorted(blocks, key=lambda b: (-b.size, b.old, b.heavy, b.number))
    out: dict[Block, int] = {}
    total, own = sum(b.size for b in blocks), {}
    # a block above the fair share of what is left takes a shard of its own
    for b in blocks:
        free = shards - len(own)
        if free <= 1 or b.size * free <= total:
            break
        home = b.old if b.old < shards and b.old not in own else \
            min(j for j in range(shards) if j not in own)
        own[home] = b
        out[b] = home
        total -= b.size
    rest = [b for b in blocks if b not in out]
    free = [j for j in range(shards) if j not in own]
    share, extra = divmod(total, len(free))
    capacity = [0] * shards
    for k, j in enumerate(free):
        capacity[j] = share + (k < extra)
    olds = max([b.old for b in rest], default=0) + 1
    held = defaultdict(list)
    for b in rest:
        held[b.old].append(b)
    supply = [sum(b.size for b in held[i]) for i in range(olds)]
    size = [0] * shards
    flow = transfers(supply, capacity, cost)
    for i in range(olds):
        goes = sorted(((f, j) for (a, j), f in flow.items() if a == i and j != i), reverse=True)
        left = held[i]
        for amount, j in goes:      # largest blocks that fit, up to half of one too much
            kept = []
            for b in left:
                if b.size <= amount or b.size - amount < amount and b is left[-1]:
                    out[b] = j
                    amount -= b.size
                else:
                    kept.append(b)
            left = kept
        for b in left:
            stay = i if i < shards and i not in own else max(free, key=lambda j: capacity[j] - size[j])
            out[b] = stay
            size[stay] += b.size if stay != i else 0
    # whole blocks cannot carry the flow to the byte: level out what is left
    size, mine = [0] * shards, defaultdict(list)
    for b in rest:
        size[out[b]] += b.size
        mine[out[b]].append(b)
    for _ in range(20 * len(rest) + 1):
        top, low = max(free, key=size.__getitem__), min(free, key=size.__getitem__)
        gap = size[top] - size[low]
        fits = [b for b in mine[top] if 0 < b.size < gap]
        if not fits:
            break
        b = min(fits, key=lambda b: abs(gap - 2 * b.size))
        mine[top].remove(b)
        mine[low].append(b)
        out[b] = low
        size[top] -= b.size
        size[low] += b.size
    return out


def _sized(docs: DataFrame, doc_id: str, text: str, old: Column | None, shards: int) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    group = F.xxhash64(body)
    # (no layout given: the old one is taken to deal groups by hash)
    old = F.pmod(F.xxhash64(group, F.lit("old")), F.lit(shards)) if old is None else old
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
                       group.alias("group"), old.cast("int").alias("old_shard"))


def plan(sized: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS,
         cost: list[list[int]] | None = None) -> tuple[dict[Block, int], list[int]]:
    """Block -> new shard, and the heavy groups' hashes."""
    total = sized.agg(F.sum("size").alias("n")).first()["n"] or 0
    heavy = sorted(r["group"] for r in
                   sized.groupBy("group").agg(F.sum("size").alias("n"))
                   .where(F.col("n") * (shards * blocks) > total * 4).collect())
    sums = (_with_block(sized, heavy, blocks).groupBy("old_shard", "number", "heavy")
            .agg(F.sum("size").alias("n")).collect())
    return assign([Block(r["old_shard"], r["number"], r["heavy"], r["n"]) for r in sums],
                  shards, cost), heavy


def _with_block(sized: DataFrame, heavy: list[int], blocks: int) -> DataFrame:
    """The block of every document. ``heavy``: at most shards * blocks / 4 groups."""
    is_heavy = F.col("group").isin(heavy) if heavy else F.lit(False)
    return sized.withColumn("heavy", is_heavy).withColumn("number", F.when(
        F.col("heavy"), F.col("group")).otherwise(F.pmod(F.xxhash64("group", F.lit("block")),
                                                         F.lit(blocks))))


def reshard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", old: Column | None = None,
            shards: int = SHARDS, blocks: int = BLOCKS,
            cost: list[list[int]] | None = None) -> tuple[DataFrame, set[int]]:
    """doc_id, text, size, old_shard, shard per document, and the shards whose
    files change (those that give or take a block)."""
    sized = _sized(docs, doc_id, text, old, shards)
    where, heavy = plan(sized, shards, blocks, cost)
    affected = {s for b, j in where.items() if b.old != j for s in (b.old, j)}
    rows = [(b.old, b.number, b.heavy, j) for b, j in where.items()]
    spark = docs.sparkSession
    moves = spark.createDataFrame(rows, "old_shard int, number long, heavy boolean, shard int")
    placed = (_with_block(sized, heavy, blocks)
              .join(F.broadcast(moves), ["old_shard", "number", "heavy"]))
    return placed.select("doc_id", "text", "size", "old_shard", "shard"), affected


def rewrite(placed: DataFrame, path: str, only: set[int] | None = None) -> None:
    """Write the documents (of the shards in ``only``) under ``path``, a folder
    per shard, with ``part`` and ``place`` that order them within the shard."""
    spark = placed.sparkSession
    if only is not None:
        placed = placed.where(F.col("shard").isin(sorted(only)) if only else F.lit(False))
    kind = placed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, shard int, part int, place long"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (placed.select("doc_id", "text", "shard")
               .repartitionByRange(parts, "shard", "doc_id")
               .sortWithinPartitions("shard", "doc_id", "text"))

    def run(batches):
        import numpy as np
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            place = np.empty(len(batch), np.int64)
            for i, s in enumerate(batch.column(2).to_pylist()):
                place[i] = seen[s]
                seen[s] += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(batch), pa.int32()), pa.array(place)],
                names=["doc_id", "text", "shard", "part", "place"])

    ordered.mapInArrow(run, schema).write.partitionBy("shard").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The written documents with ``slot``, gapless from 0 within a shard."""
    docs = spark.read.parquet(path)
    # a row per part and shard that it touches: parts + shards at most
    counts = sorted((r["shard"], r["part"], r["n"]) for r in
                    docs.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).collect())
    rows, before, last = [], 0, None
    for shard, part, n in counts:
        before = 0 if shard != last else before
        rows.append((shard, part, before))
        before, last = before + n, shard
    offsets = spark.createDataFrame(rows, "shard int, part int, before long")
    return docs.join(F.broadcast(offsets), ["shard", "part"]).withColumn(
        "slot", F.col("before") + F.col("place"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    placed, _ = reshard(table(spark, sf_dir, "documents"))
    if placed.isEmpty():
        return placed.selectExpr("doc_id", "size", "0L text_crc32", "'bytes' law", "shard",
                                 "0L slot", "cast(null as int) grown_shard")
    rewrite(placed, path)       # there are no files of the old layout: all are written
    body = F.coalesce("text", F.lit(""))
    return read(spark, path).select(
        "doc_id", (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))
