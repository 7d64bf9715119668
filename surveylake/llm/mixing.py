"""Mixing sources to target weights by a min-cost flow over membership patterns.

A document may belong to several sources. Documents are aggregated by the sources they
belong to (the pattern); a pattern's tokens flow to the quotas of its sources. The first pass over a
pattern costs nothing and each further pass costs more than the one before, so the
cheapest flow repeats as evenly as the quotas allow. Only patterns connected by shared sources need a flow of their own;
one that shares none gets its sources' quotas outright. The flow of a pattern is then
spent on documents: whole passes over all of them, and for the rest a seeded selection.

The selection orders a pattern's documents by a seeded hash, cut into buckets of
about equal size. Bucket sums tell where the quota ends; only the documents of that
one bucket are ordered. The gap before the first document that does not fit is then closed
round by round with the largest document that fits. What a few of them leave is spent on all documents that fit,
again in hash order, until none fits, and at last on the one that comes nearest even if it doesn't;
here a document may be taken again, but never more than `MAX_PASSES` times.

Defined results: a null or empty text has size 0 and is taken 0; a null source is a
source of its own, last in order; rows of one id and text share the hash and
are taken alike; a very long text is one document, counted whole; without any tokens all targets are 0; an empty table gives no
rows; the driver holds one row per pattern and source, however many; other columns stay with their rows, those named like a result column are replaced.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveylake.llm.words import stored, word_count

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BUCKETS = 4096
FILL_ROUNDS = 6
# Tables of one row per pattern are broadcast up to so many rows; beyond that Spark chooses the join.
BROADCAST_PATTERNS = 100_000
SEED = 20240501


def targets(sizes: Sequence[int], weights: Sequence[float], total: float | None = None, limit: float = MAX_PASSES) -> list[float]:
    """Shares of `total` by weight, none above `limit` times its size; what is above is shared again by weight among the rest."""
    total = float(sum(sizes)) if total is None else total
    result, rest = [0.0] * len(sizes), total
    free = [i for i in range(len(sizes)) if sizes[i] > 0]
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] / weight > limit * sizes[i]]
        if not over:
            for i in free:
                result[i] = rest * weights[i] / weight
            break
        for i in over:
            result[i] = float(limit * sizes[i])
        rest -= sum(result[i] for i in over)
        settled = set(over)
        free = [i for i in free if i not in settled]
    return result


def cycled_weights(names: Sequence[str | None], weights: Sequence[float] = WEIGHTS) -> dict[str | None, float]:
    """Sources in code point order, a null one last, get the weights in turn."""
    ordered = sorted((n for n in names if n is not None), key=lambda n: [ord(c) for c in n])
    ordered += [None] * (None in names)
    return {name: weights[i % len(weights)] for i, name in enumerate(ordered)}


@dataclass
class _Arc:
    to: int
    room: int
    cost: float
    back: int


def cheapest_flow(
    sizes: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], passes: int = MAX_PASSES
) -> list[list[int]]:
    """Tokens from each pattern to each of its sources, at the least repetition cost, by successive shortest paths.

    Pass r of a pattern costs r * r a token. Quotas that the patterns can't fill stay unfilled.
    """
    n, m = len(sizes), len(quotas)
    source, sink = n + m, n + m + 1
    graph: list[list[_Arc]] = [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, room: int, cost: float) -> tuple[int, int]:
        graph[a].append(_Arc(b, room, cost, len(graph[b])))
        graph[b].append(_Arc(a, 0, -cost, len(graph[a]) - 1))
        return a, len(graph[a]) - 1

    for p, size in enumerate(sizes):
        for r in range(passes):
            arc(source, p, size, float(r * r))
    routes = [[arc(p, n + s, passes * sizes[p], 0.0) for s in members[p]] for p in range(n)]
    for s, quota in enumerate(quotas):
        arc(n + s, sink, quota, 0.0)

    potential = [0.0] * len(graph)
    while True:
        distance, seen, came = [float("inf")] * len(graph), [False] * len(graph), [(-1, -1)] * len(graph)
        distance[source], queue = 0.0, [(0.0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if seen[a]:
                continue
            seen[a] = True
            for i, x in enumerate(graph[a]):
                far = d + x.cost + potential[a] - potential[x.to]
                if x.room > 0 and far < distance[x.to] - 1e-12:
                    distance[x.to], came[x.to] = far, (a, i)
                    heapq.heappush(queue, (far, x.to))
        if not seen[sink]:
            break
        for a, d in enumerate(distance):
            potential[a] += min(d, distance[sink])
        path, at = [], sink
        while at != source:
            path.append(came[at])
            at = came[at][0]
        amount = min(graph[a][i].room for a, i in path)
        for a, i in path:
            x = graph[a][i]
            x.room -= amount
            graph[x.to][x.back].room += amount
    return [[passes * sizes[p] - graph[a][i].room for a, i in route] for p, route in enumerate(routes)]


def order_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def _pattern(sources: Column) -> Column:
    """One string per set of sources, null-safe."""
    return F.to_json(F.struct(F.array_sort(F.array_distinct(sources)).alias("s")), {"ignoreNullFields": "false"})


def pattern_plan(
    sizes: dict[str, int], quota_of: dict[str | None, float], passes: int = MAX_PASSES
) -> dict[str, tuple[int, int]]:
    """Per pattern, the whole passes over its documents and the tokens wanted beyond them.

    Patterns that share no source, directly or through others, can't compete for a quota, so each connected group is
    planned alone, which is exact. A pattern that is alone has no choice: it gives its sources what they ask for, up to its passes.
    """
    members = {p: json.loads(p)["s"] for p in sorted(sizes)}
    group: dict[str | None, str | None] = {}  # sources, each pointing towards the first of its group

    def first(name: str | None) -> str | None:
        while group[name] != name:
            group[name] = group[group[name]]
            name = group[name]
        return name

    for names in members.values():
        for name in names:
            group.setdefault(name, name)
            group[first(name)] = first(names[0])
    together: dict[str | None, list[str]] = {}
    plan = {}
    for pattern, names in members.items():
        if names:
            together.setdefault(first(names[0]), []).append(pattern)
        else:
            plan[pattern] = (0, 0)
    for patterns in together.values():
        names = list(dict.fromkeys(name for p in patterns for name in members[p]))
        quotas = [round(quota_of[name]) for name in names]
        if len(patterns) == 1:
            given = [min(passes * sizes[patterns[0]], sum(quotas))]
        else:
            place = {name: i for i, name in enumerate(names)}
            flows = cheapest_flow([sizes[p] for p in patterns], [[place[n] for n in members[p]] for p in patterns], quotas, passes)
            given = [sum(flow) for flow in flows]
        for p, amount in zip(patterns, given):
            plan[p] = divmod(amount, sizes[p]) if sizes[p] else (0, 0)
    return plan


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows of the driver's plan, broadcast only while they are few."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= BROADCAST_PATTERNS else table


def _unsigned(key: Column) -> Column:
    """A long whose signed order is the unsigned order of the key."""
    return key.bitwiseXOR(F.lit(-(1 << 63)))


def _cuts(units: DataFrame, plan: dict[str, tuple[int, int]], buckets: int) -> dict[str, tuple[int, int]]:
    """Per pattern, the first key that isn't selected, and the tokens still free before it."""
    bucket = F.shiftrightunsigned(F.col("_key"), 64 - (buckets - 1).bit_length()).cast("int")
    quotas = [(p, quota) for p, (_, quota) in plan.items()]
    wanted = small_table(units.sparkSession, quotas, "_pattern string, _quota long")
    earlier = W.partitionBy("_pattern").rowsBetween(W.unboundedPreceding, -1)
    sums = units.withColumn("_bucket", bucket).groupBy("_pattern", "_bucket").agg(F.sum("weight").alias("weight"))
    begun = (
        sums.withColumn("_before", F.coalesce(F.sum("weight").over(earlier.orderBy("_bucket")), F.lit(0)))
        .join(wanted, "_pattern")
        .filter("_before <= _quota and _before + weight > _quota")
        .select("_pattern", "_bucket", (F.col("_quota") - F.col("_before")).alias("_left"))
    )
    begun = F.broadcast(begun) if len(plan) <= BROADCAST_PATTERNS else begun  # one row per pattern at most
    inside = units.withColumn("_bucket", bucket).join(begun, ["_pattern", "_bucket"])
    upto = F.coalesce(F.sum("weight").over(earlier.orderBy(_unsigned(F.col("_key")))), F.lit(0))
    first = (
        inside.withColumn("_upto", upto)
        .filter("_upto <= _left and _upto + weight > _left")
        .select("_pattern", "_key", (F.col("_left") - F.col("_upto")).alias("_left"))
    )
    return {r["_pattern"]: (r["_key"], r["_left"]) for r in first.collect()}


@dataclass(frozen=True)
class Selection:
    """Which documents of each pattern are taken, and how often; one row per pattern."""

    table: DataFrame
    more: DataFrame | None = None  # `_pattern`, `_key` and `_more` of documents taken after the cut; any number

    def copies(self, rows: DataFrame) -> DataFrame:
        """Add `_copies` to rows with `_pattern` and `_key`. The table has one row per pattern."""
        joined = rows.join(self.table, "_pattern")
        joined = joined.withColumn("_copies", _copies()).drop("_passes", "_cut", "_extra")
        if self.more is None:
            return joined
        joined = joined.join(self.more, ["_pattern", "_key"], "left")
        return joined.withColumn("_copies", F.col("_copies") + F.coalesce("_more", F.lit(0))).drop("_more")


def _copies() -> Column:
    below = F.coalesce(_unsigned(F.col("_key")) < _unsigned(F.col("_cut")), F.lit(False))
    return F.col("_passes") + below.cast("int") + F.size(F.filter("_extra", lambda key: key == F.col("_key")))


def select_documents(
    sized: DataFrame, plan: dict[str, tuple[int, int]], buckets: int = BUCKETS, rounds: int = FILL_ROUNDS
) -> Selection:
    """Spend a plan on rows with `_pattern`, `_key` and `size`; `sized` is read several times and should be stored."""
    spark = sized.sparkSession
    units = sized.groupBy("_pattern", "_key").agg(F.sum("size").alias("weight")).filter("weight > 0")
    cuts = _cuts(units, plan, buckets)
    extra: dict[str, list[int]] = {p: [] for p in plan}
    gaps = {p: left for p, (_, left) in cuts.items()}

    more: DataFrame | None = None

    def selection() -> Selection:
        rows = [(p, passes, cuts[p][0] if p in cuts else None, extra[p]) for p, (passes, _) in plan.items()]
        return Selection(small_table(spark, rows, "_pattern string, _passes int, _cut long, _extra array<long>"), more)

    def free(condition: str) -> DataFrame:
        """Units of open patterns, with the pattern's `_gap`, that may be taken once more."""
        gap = small_table(spark, [x for x in gaps.items() if x[1] > 0], "_pattern string, _gap long")
        return selection().copies(units).filter(F.col("_copies") < MAX_PASSES).join(gap, "_pattern").filter(condition)

    def take_nearest(condition: str) -> None:
        if not any(gap > 0 for gap in gaps.values()):
            return
        off = F.abs(F.col("weight") - F.col("_gap")).alias("off")
        best = F.min(F.struct(off, F.col("_copies").alias("copies"), "_key", "weight")).alias("best")
        for row in free(condition).groupBy("_pattern").agg(best).collect():
            extra[row["_pattern"]].append(row.best["_key"])
            gaps[row["_pattern"]] -= row.best["weight"]

    for _ in range(rounds):
        take_nearest("weight <= _gap")
    while any(gap > 0 for gap in gaps.values()):
        fitting = free("weight <= _gap")
        # Documents taken less often come first; each turn takes at least one of every pattern in which one fits.
        sums = fitting.groupBy("_pattern", "_copies").agg(F.sum("weight").alias("weight"))
        least = sums.groupBy("_pattern").agg(F.min(F.struct("_copies", "weight")).alias("least")).collect()
        if not least:
            break
        levels = small_table(spark, [(r["_pattern"], r.least["_copies"]) for r in least], "_pattern string, _copies int")
        level = stored(fitting.join(levels, ["_pattern", "_copies"]).select("_pattern", "_key", "weight"), "mixing-fitting")
        ends = _cuts(level, {r["_pattern"]: (0, gaps[r["_pattern"]]) for r in least}, buckets)
        last = [(r["_pattern"], ends[r["_pattern"]][0] if r["_pattern"] in ends else None) for r in least]
        end = small_table(spark, last, "_pattern string, _end long")
        inside = F.col("_end").isNull() | (_unsigned(F.col("_key")) < _unsigned(F.col("_end")))
        taken = level.join(end, "_pattern").filter(inside).select("_pattern", "_key", F.lit(1).alias("_more"))
        taken = taken if more is None else taken.unionByName(more).groupBy("_pattern", "_key").agg(F.sum("_more").cast("int").alias("_more"))
        more = stored(taken, "mixing-more")
        for r in least:
            p = r["_pattern"]
            gaps[p] = ends[p][1] if p in ends else gaps[p] - r.least["weight"]
    take_nearest("weight < 2 * _gap")
    return selection()


@dataclass(frozen=True)
class Mix:
    selection: Selection
    sources: dict[str | None, tuple[int, float]]  # size and target


def keyed(docs: DataFrame, sources: Column, seed: int = SEED) -> DataFrame:
    """Add `_key`, the seeded place of a document, and `_pattern`, the set of its sources (an array column)."""
    members = F.array_sort(F.array_distinct(sources))
    pattern = F.to_json(F.struct(members.alias("s")), {"ignoreNullFields": "false"})
    return docs.withColumns({"_key": F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), "_pattern": pattern})


def plan_mix(sized: DataFrame, weights: Sequence[float] = WEIGHTS) -> Mix:
    """Targets, flow and selection for stored rows with `_key`, `_pattern` and `size`."""
    rows = sized.groupBy("_pattern").agg(F.sum("size").alias("size")).collect()
    by_pattern = {row["_pattern"]: row["size"] for row in rows}
    sizes: dict[str | None, int] = {}
    for pattern, size in by_pattern.items():
        for name in json.loads(pattern)["s"]:
            sizes[name] = sizes.get(name, 0) + size
    weight_of = cycled_weights(list(sizes), weights)
    aims = targets([sizes[n] for n in weight_of], list(weight_of.values()), sum(by_pattern.values()))
    quota_of = dict(zip(weight_of, aims))
    selection = select_documents(sized, pattern_plan(by_pattern, quota_of))
    return Mix(selection, {n: (sizes[n], quota_of[n]) for n in weight_of})


def sizes_of(docs: DataFrame, sources: Column, seed: int = SEED, keep: Sequence[str] = ()) -> DataFrame:
    """The narrow stored table that planning reads: the columns `keep`, `size`, `_key` and `_pattern`."""
    rows = keyed(docs, sources, seed).select(*keep, word_count(F.col("text")).alias("size"), "_key", "_pattern")
    return stored(rows, "mixing-sizes")


def mix_documents(docs: DataFrame, sources: Column, weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix itself: each document with a word as often as it is taken, with the columns of the input."""
    mix = plan_mix(sizes_of(docs, sources, seed), weights)
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), "doc_id", "text", sources.alias("_sources"))
    taken = mix.selection.copies(keyed(rows, F.col("_sources"), seed)).filter(word_count(F.col("text")) > 0)
    return taken.select(F.explode(F.array_repeat("_row", F.col("_copies"))).alias("_row")).select("_row.*")
