"""Mixing sources to target weights, as a flow of tokens at least cost.

Documents are added up by *membership pattern* (the set of sources each belongs to). Tokens flow
from patterns to the quotas of their sources. Passing a pattern once is free, and each further
repetition costs more than the one before (``REPEAT_COSTS``, convex), so every pattern is used
up before one is repeated more than it must be. The flow fixes how many words each pattern gives;
documents are then picked in the order of a seeded hash.

Only one row per pattern (counts and sums) reaches the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from harkline.llm.text import word_count
from harkline.operators.frozen import freeze

#: Cost of a token's first, second and third use.
REPEAT_COSTS = (0, 1, 3)
#: Weights of the sources in their order, repeated.
CYCLE = (5, 2, 1)
#: More membership patterns than this are refused: they would no longer fit on the driver.
MAX_PATTERNS = 200_000
#: A pattern's documents are cut at the right place within one of two to the power of so many ranges of their draw.
RANGE_BITS = 12
SEED = 20


def capped_targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size.

    What a share can't take is shared by weight among the others, until none is above.
    """
    targets, open_ = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = float(most * sizes[i])
        left -= sum(targets[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def least_cost_flow(
    supply: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], costs: Sequence[int] = REPEAT_COSTS
) -> list[dict[int, int]]:
    """Tokens that each pattern gives to each of its sources.

    ``supply[p]`` tokens can pass pattern ``p`` once for each entry of ``costs``, at that cost.
    Shortest paths are filled one after the other (with potentials, so that costs stay positive),
    which gives the largest flow at the least cost.
    """
    n, m = len(supply), len(quotas)
    sink, arcs, out = n + m + 1, [], [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, room: int, cost: int) -> int:
        out[a].append(len(arcs))
        arcs.append([b, room, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])
        return len(arcs) - 2

    routes = []
    for p in range(n):
        for cost in costs:
            arc(0, 1 + p, supply[p], cost)
        routes.append({q: arc(1 + p, 1 + n + q, supply[p] * len(costs), 0) for q in members[p]})
    for q in range(m):
        arc(1 + n + q, sink, quotas[q], 0)
    potential = [0] * (sink + 1)
    while True:
        best, via, heap = {0: 0}, {}, [(0, 0)]
        done = set()
        while heap:
            d, a = heapq.heappop(heap)
            if a in done:
                continue
            done.add(a)
            for k in out[a]:
                b, room, cost = arcs[k]
                if room > 0 and (e := d + cost + potential[a] - potential[b]) < best.get(b, 1 << 60):
                    best[b], via[b] = e, k
                    heapq.heappush(heap, (e, b))
        if sink not in best:
            return [{q: arcs[k ^ 1][1] for q, k in route.items()} for route in routes]
        far = max(best.values())
        potential = [potential[a] + best.get(a, far) for a in range(sink + 1)]
        path, a = [], sink
        while a:
            path.append(via[a])
            a = arcs[via[a] ^ 1][0]
        amount = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= amount
            arcs[k ^ 1][1] += amount


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    doc_id: str = "doc_id",
    sources: Column | None = None,
    size: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Adds how much of each document the mix takes.

    ``sources`` is an array of the sources a document belongs to (its column ``source`` alone unless
    given), ``size`` its number of words unless given. ``weights`` are by source; unless given, sources
    in code point order, null last, weigh 5, 2, 1 and so on. The sources share the sum of all sizes.

    Returns ``docs``'s id and ``mix_*`` columns: ``mix_sources``, ``mix_size``, ``mix_source_size`` and
    ``mix_target`` (of the first of its sources), ``mix_copies`` (0 to 3) and ``mix_taken`` (copies times
    size). Rows are told apart by a hash of id and size; equal rows with one id share their fate, up
    to the last one picked. A null size counts as 0, an empty or null list as the one source null.
    No rows give no rows.
    """
    members = F.array("source") if sources is None else sources
    members = F.when(members.isNull() | (F.size(members) == 0), F.array(F.lit(None).cast("string"))).otherwise(F.array_sort(F.array_distinct(members)))
    words = word_count("text") if size is None else F.coalesce(size, F.lit(0)).cast("long")
    rows = docs.select(F.col(doc_id).alias("mix_id"), members.alias("mix_sources"), words.alias("mix_size"))
    draw = F.xxhash64(F.lit(seed), "mix_id", "mix_size")
    rows = freeze(rows.withColumn("mix_draw", draw).withColumn("mix_range", F.shiftrightunsigned(draw, 64 - RANGE_BITS).cast("int")))

    found = rows.groupBy("mix_sources").agg(F.sum("mix_size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = [(list(r[0]), r[1] or 0) for r in found]
    names = sorted({s for p, _ in patterns for s in p}, key=lambda s: (s is None, s or ""))
    weigh = [CYCLE[i % len(CYCLE)] if weights is None else weights.get(s, 0) for i, s in enumerate(names)]
    index = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for p, n in patterns:
        for s in p:
            sizes[index[s]] += n
    total = sum(n for _, n in patterns)
    targets = capped_targets(sizes, weigh, total, len(REPEAT_COSTS)) if sum(weigh) else [0.0] * len(names)
    flow = least_cost_flow([n for _, n in patterns], [[index[s] for s in p] for p, _ in patterns], [round(t) for t in targets])

    spark = docs.sparkSession
    plan = [
        (p, sizes[index[p[0]]], targets[index[p[0]]], (given := sum(f.values())) // n if n else 0, given % n if n else 0)
        for (p, n), f in zip(patterns, flow)
    ]
    schema = "plan_sources array<string>, mix_source_size long, mix_target double, whole int, part long"
    plan = F.broadcast(spark.createDataFrame(plan, schema))  # one row per pattern, at most MAX_PATTERNS
    same = F.col("mix_sources").eqNullSafe(F.col("plan_sources"))
    rows = rows.join(plan, same).drop("plan_sources")

    # Where the part that gets one copy more ends: the range of draws, then the place in it.
    ranges = rows.filter("part > 0").groupBy("mix_sources", "part", "mix_range").agg(F.sum("mix_size").alias("held"))
    before = Window.partitionBy("mix_sources").orderBy("mix_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        ranges.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
        .filter("before < part and before + held >= part")
        .select(F.col("mix_sources").alias("end_sources"), F.col("mix_range").alias("end_range"), (F.col("part") - F.col("before")).alias("end_left"))
    )
    ends = F.broadcast(freeze(ends))
    rows = rows.join(ends, F.col("mix_sources").eqNullSafe(F.col("end_sources")), "left").drop("end_sources")
    order = [F.col("mix_draw"), F.col("mix_id"), F.col("mix_size")]
    earlier = Window.partitionBy("mix_sources").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    last = (
        rows.filter("mix_range = end_range")
        .withColumn("before", F.coalesce(F.sum("mix_size").over(earlier), F.lit(0)))
        .filter("before + mix_size / 2 <= end_left")
        .groupBy(F.col("mix_sources").alias("last_sources"))
        .agg(F.max(F.struct("mix_draw", "mix_id", "mix_size")).alias("last"))
    )
    rows = rows.join(F.broadcast(freeze(last)), F.col("mix_sources").eqNullSafe(F.col("last_sources")), "left")
    more = F.coalesce(
        (F.col("mix_range") < F.col("end_range"))
        | ((F.col("mix_range") == F.col("end_range")) & (F.struct("mix_draw", "mix_id", "mix_size") <= F.col("last"))),
        F.lit(False),
    )
    copies = F.when(F.col("mix_size") > 0, F.col("whole") + more.cast("int")).otherwise(0)
    return rows.select(
        F.col("mix_id").alias(doc_id), "mix_sources", "mix_size", "mix_source_size", "mix_target",
        copies.alias("mix_copies"), (copies * F.col("mix_size")).cast("long").alias("mix_taken"),
    )
