"""Mixing overlapping sources to target weights by min-cost flow (operator 7).

1. Documents are aggregated by membership pattern (the set of sources they belong to):
   the flow graph has a node per pattern and per source, never per document.
2. Every pattern offers its words up to ``max_repeats`` times; the n-th use costs n, so
   the cost of a pattern is convex and repetition is taken where it is cheapest.
3. A min-cost flow routes words from patterns to the sources' quotas.
4. A pattern that must give F of its S words gives every document F div S times, and
   once more the documents that come first in a seeded order until F mod S is reached.
   The seeded order is cut by buckets: sums per bucket of the hash decide which
   buckets are taken whole, and only the bucket at the cut is put in order.

The driver holds one number per pattern, source and (at most ``BUCKETS``) bucket. Reruns
give the same choice: the order is a hash of seed, doc_id and text.

Defined results: NULL text = size 0; NULL source is a source of its own, last in order;
a document of several sources offers its words once; rows that repeat a document are
documents of their own and tie in the order (both taken or neither, save at the cut);
sources of size 0 have target 0; an empty table gives no row.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import stored

BUCKETS = 4096
SEED = 20240101


def water_fill(sizes: dict, weights: dict, max_repeats: float = 3.0) -> dict:
    """Targets that share all sizes by weight, none above ``max_repeats`` x its source:
    what a full source cannot take is shared among the others by weight."""
    left, open_, target = float(sum(sizes.values())), list(sizes), {}
    while open_:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total > max_repeats * sizes[s]]
        if not over:
            target.update({s: left * weights[s] / total for s in open_})
            break
        for s in over:
            target[s] = float(max_repeats * sizes[s])
        left -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in target]
    return target


def min_cost_flow(patterns: list[tuple[frozenset, int]], quota: dict, max_repeats: int = 3) -> list[dict]:
    """Words each pattern gives to each of its sources: successive shortest paths over
    start -> pattern (``max_repeats`` parallel arcs of costs 1, 2, ...) -> source -> end."""
    sources = list(quota)
    n = 2 + len(patterns) + len(sources)
    end = n - 1
    at_source = {s: 1 + len(patterns) + k for k, s in enumerate(sources)}
    graph: list[list[int]] = [[] for _ in range(n)]
    to, room, cost = [], [], []

    def arc(a: int, b: int, c: int, w: int) -> int:
        for x, y, r, v in ((a, b, c, w), (b, a, 0, -w)):
            graph[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(v)
        return len(to) - 2

    uses = []
    for k, (members, size) in enumerate(patterns, 1):
        for again in range(max_repeats):
            arc(0, k, size, again + 1)
        uses.append({s: arc(k, at_source[s], max_repeats * size, 0) for s in sorted(members, key=source_key) if s in at_source})
    for s in sources:
        arc(at_source[s], end, quota[s], 0)
    potential = [0] * n
    while True:
        far, via = [None] * n, [-1] * n
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > far[x]:
                continue
            for e in graph[x]:
                if room[e] and (far[to[e]] is None or d + cost[e] + potential[x] - potential[to[e]] < far[to[e]]):
                    far[to[e]], via[to[e]] = d + cost[e] + potential[x] - potential[to[e]], e
                    heapq.heappush(heap, (far[to[e]], to[e]))
        if far[end] is None:
            break
        potential = [p + (f if f is not None else far[end]) for p, f in zip(potential, far, strict=True)]
        push, x = None, end
        while x:
            push = room[via[x]] if push is None else min(push, room[via[x]])
            x = to[via[x] ^ 1]
        x = end
        while x:
            room[via[x]] -= push
            room[via[x] ^ 1] += push
            x = to[via[x] ^ 1]
    return [{s: room[e ^ 1] for s, e in own.items()} for own in uses]


def source_key(s):
    """Code-point order, NULL last."""
    return (s is None, s or "")


def mix(docs: DataFrame, weights: dict | None = None, max_repeats: int = 3, seed: int = SEED) -> DataFrame:
    """``docs``: doc_id, size (words), members (array of sources), tie (any orderable text
    or number that tells rows of one doc_id apart). Returns those columns with source_sizes and
    targets (arrays beside members) and taken (words, repeats counted).

    ``weights``: by source; by default 1, 2, 3, 1, 2, 3 ... in code-point order, NULL last.
    """
    spark = docs.sparkSession
    # A source name of NULL becomes a NULL element: sets keep it apart from every text.
    base = docs.select("doc_id", "tie", F.col("size").cast("long").alias("size"), F.array_sort(F.array_distinct("members")).alias("members"),
                       F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("tie")).alias("draw"))
    base = base.withColumn("bucket", F.pmod(F.shiftrightunsigned("draw", 52), F.lit(BUCKETS)).cast("int"))
    base = stored(base, "mix-documents")
    sums = stored(base.groupBy("members", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    found = sums.groupBy("members").agg(F.sum("words").alias("size")).orderBy(F.to_json("members")).toLocalIterator()
    patterns = [(frozenset(r.members), r.members, r["size"]) for r in found]
    sizes: dict = {}
    for members, _, size in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + size
    order = sorted(sizes, key=source_key)
    weights = weights or {s: k % 3 + 1 for k, s in enumerate(order)}
    target = water_fill({s: sizes[s] for s in order}, weights, max_repeats)
    flow = min_cost_flow([(m, size) for m, _, size in patterns], {s: int(round(target[s])) for s in order}, max_repeats)
    plan = [(members, size, min(sum(give.values()), max_repeats * size), [sizes[s] for s in members], [target[s] for s in members])
            for (_, members, size), give in zip(patterns, flow, strict=True)]
    plan = [(m, (f // size if size else 0), (f % size if size else 0), ss, tt) for m, size, f, ss, tt in plan]
    schema = "members array<string>, every long, rest long, source_sizes array<long>, targets array<double>"
    give = spark.createDataFrame(plan, schema)
    # Where the seeded order of each pattern is cut: sums of whole buckets, one row each.
    before = Window.partitionBy("members").orderBy("bucket")
    cut = (sums.join(give, sums["members"].eqNullSafe(give["members"])).select(sums["members"], "bucket", "words", "rest")
           .withColumn("upto", F.sum("words").over(before))
           .where(F.col("upto") > F.col("rest")).groupBy("members")
           .agg(F.min_by(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("words")).alias("room")), F.col("bucket")).alias("cut")))
    rule = stored(give.join(cut.withColumnRenamed("members", "m"), give["members"].eqNullSafe(F.col("m")), "left")
                  .select("members", "every", "rest", "source_sizes", "targets", F.col("cut.bucket").alias("cut_bucket"), F.col("cut.room").alias("room")), "mix-rule")
    # One row per pattern: small against the documents; adaptive execution broadcasts it when it is.
    named = base.join(rule.withColumnRenamed("members", "m"), base["members"].eqNullSafe(F.col("m"))).drop("m")
    whole = named.withColumn("more", F.when(F.col("cut_bucket").isNull() | (F.col("rest") == 0), F.lit(0)).otherwise((F.col("bucket") < F.col("cut_bucket")).cast("int")))
    at_cut = (F.col("bucket") == F.col("cut_bucket")) & (F.col("rest") > 0)
    ordered = Window.partitionBy("members").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = (whole.where(at_cut).withColumn("upto", F.sum("size").over(ordered))
              .withColumn("more", (2 * F.col("upto") - F.col("size") <= 2 * F.col("room")).cast("int")).drop("upto"))
    out = whole.where(~F.coalesce(at_cut, F.lit(False))).unionByName(inside)
    return out.select("doc_id", "tie", "members", "size", "source_sizes", "targets", (F.col("size") * (F.col("every") + F.col("more"))).alias("taken"))
