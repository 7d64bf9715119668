"""Nearest neighbours by inner product: stable projections to few dimensions, a kd-tree, and a chi-square stopping test.

Inner product becomes distance: with M no smaller than any norm, a vector x of the index gets one more component
sqrt(M^2 - |x|^2) and a query gets 0, so that |q - x|^2 = |q|^2 + M^2 - 2 q.x. Vectors are first parted by
the size of their norm (a factor of two each), each part with its own M, so one long vector doesn't level the others.

Lengthened vectors are projected by `PROJECTED` Gaussian directions. A projected squared distance over the true one
is chi-square distributed with that many degrees of freedom, whatever the vectors. So neighbours are looked at in the order of their
projected distance and verified on the original vectors; the search ends when the projected distance is so long that a
vector nearer than the last of the k found would come this far out with a chance of 1 - `CERTAINTY` only.

On the cluster the tree has two storeys. Its upper splits, fitted on a bounded sample of the index, deal every vector to a
cell; a task builds the lower part of one cell's tree, whose leaves it visits in the order of their boxes' distances to
the query. A query first searches the cell it falls into, then, with the bound found there, only the cells
whose box passes the stopping test. Cells over `CELL_ROWS` are searched in parts, queries in chunks of `QUERY_ROWS`.

Equal vectors are searched once: a class of them keeps its k + 1 smallest ids, which are all that can be among anyone's k nearest,
as ties go to the smaller id, and a query vector is searched once for all rows that share it.

Defined results: rows whose id or vector is null take no part, nor do vectors that are empty, zero, hold a null
or non-finite component, or whose squared norm is no finite positive double. A query meets vectors of its own number of components
only, and never a row of its own id. Rows that repeat id and vector count once; an id with several vectors is a candidate
and a query with each. With fewer candidates than k all are found. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from surveylake.llm.words import stored

K = 20
QUERY_STEP = 20
# Even, so that the distribution has a closed form.
PROJECTED = 8
CERTAINTY = 0.98
SEED = 7
# Rows of a cell that one task holds, of a leaf, and queries of a task.
CELL_ROWS = 8192
LEAF_ROWS = 64
QUERY_ROWS = 65536
# Rows that fit the upper splits, about; also the bound on what the driver holds of them.
SAMPLE = 32768
MAX_CELLS = 8192


def chi_square_cdf(x: float, degrees: int) -> float:
    term = total = 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_limit(certainty: float, degrees: int) -> float:
    """Where the distribution reaches `certainty`: the test holds beyond this ratio of squared distances."""
    low, high = 0.0, 1.0
    while chi_square_cdf(high, degrees) < certainty:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < certainty else (low, middle)
    return high


@functools.lru_cache(maxsize=64)
def directions(size: int, projected: int) -> np.ndarray:
    """Gaussian directions for vectors of `size` components and the added one."""
    return np.random.default_rng([SEED, size]).standard_normal((size + 1, projected))


@dataclass
class Part:
    """Vectors of one size and band of norms, with the upper splits of their tree (a complete binary tree by node number)."""

    size: int
    band: int
    longest: float
    first_cell: int
    axes: np.ndarray
    values: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.axes) + 1

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        while len(points) and node[0] < len(self.axes):
            right = points[np.arange(len(points)), self.axes[node]] > self.values[node]
            node = 2 * node + 1 + right
        return self.first_cell + node - len(self.axes)


@dataclass
class Index:
    """What every task knows of the index: its parts, and box and number of parts of each cell; `MAX_CELLS` cells a part at most."""

    projected: int
    parts: list[Part]
    low: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    high: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    pieces: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))

    def project(self, vectors: np.ndarray, longest: float | None) -> np.ndarray:
        axes = directions(vectors.shape[1], self.projected)
        out = vectors @ axes[:-1]
        if longest is not None:
            out += np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))[:, None] * axes[-1]
        return out


def upper_splits(points: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Median splits along the widest axis, level by level."""
    axes, values = np.zeros(2**levels - 1, dtype=np.int64), np.zeros(2**levels - 1)
    groups = [points]
    for node in range(len(axes)):
        part = groups[node]
        if len(part):
            axes[node] = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            values[node] = np.median(part[:, axes[node]])
        right = part[:, axes[node]] > values[node] if len(part) else np.zeros(0, dtype=bool)
        groups += [part[~right], part[right]]
    return axes, values


@dataclass
class Leaves:
    """The lower part of a cell's tree: rows ordered by leaf, where each leaf begins, and the leaves' boxes."""

    order: np.ndarray
    bounds: np.ndarray
    low: np.ndarray
    high: np.ndarray


def build_leaves(points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Leaves:
    """A kd-tree split at the median of the widest axis until a leaf has `leaf_rows` rows or fewer."""
    order, ends, open_nodes = np.arange(len(points)), [], [(0, len(points))]
    while open_nodes:
        low, high = open_nodes.pop()
        if high - low <= leaf_rows:
            ends.append(high)
            continue
        part = points[order[low:high]]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        middle = (high - low) // 2
        order[low:high] = order[low:high][np.argpartition(part[:, axis], middle)]
        open_nodes += [(low + middle, high), (low, low + middle)]
    bounds = np.array([0, *ends])
    ordered = points[order]
    starts = bounds[:-1]
    return Leaves(order, bounds, np.minimum.reduceat(ordered, starts), np.maximum.reduceat(ordered, starts))


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added from the first component on, so they don't depend on what else is computed."""
    return np.cumsum(vectors * query, axis=1)[:, -1]


def box_distances(low: np.ndarray, high: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        at = points[:, axis, None]
        out += np.maximum(np.maximum(low[:, axis] - at, at - high[:, axis]), 0) ** 2
    return out


def search_cell(
    points: np.ndarray, vectors: np.ndarray, ids: np.ndarray, longest: float, queries: np.ndarray, projected: np.ndarray,
    bounds: np.ndarray, wanted: int, limit: float, leaf_rows: int = LEAF_ROWS,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query: rows and products of the best `wanted` vectors of the cell, no worse than the query's bound."""
    tree = build_leaves(points, leaf_rows)
    vectors, ids = vectors[tree.order], ids[tree.order]
    for at in range(0, len(queries), 1024):
        near = box_distances(tree.low, tree.high, projected[at : at + 1024])
        for row, (query, bound) in enumerate(zip(queries[at : at + 1024], bounds[at : at + 1024])):
            base = float(query @ query) + longest**2
            slack = 1e-9 * (base + 1)
            leaves = np.argsort(near[row], kind="stable")
            found, products, last, step, done = np.zeros(0, dtype=np.int64), np.zeros(0), bound, 1, 0
            while done < len(leaves):
                # Leaves that pass the stopping test with the neighbours found so far; further ones are farther.
                reach = limit * max(base - 2 * last, 0) + slack if last > -math.inf else math.inf
                taken = leaves[done : done + step]
                taken = taken[near[row][taken] <= reach]
                if not len(taken):
                    break
                rows = np.concatenate([np.arange(tree.bounds[i], tree.bounds[i + 1]) for i in taken])
                rough = vectors[rows] @ query
                rows = rows[rough >= last - slack] if last > -math.inf else rows
                found = np.concatenate([found, rows])
                products = np.concatenate([products, exact_products(vectors[rows], query)])
                if len(found) > wanted:
                    best = np.lexsort((ids[found], -products))[:wanted]
                    found, products = found[best], products[best]
                if len(found) == wanted:
                    last = max(last, float(products.min()))
                done, step = done + step, min(2 * step, 64)
            kept = products >= bound
            yield tree.order[found[kept]], products[kept]


def _doubles(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def usable(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`vec_id`, `vector` (doubles) and its `norm2` of the rows that take part, each id and vector once."""
    # No number is both over and not over another, so a NULL or NaN component or sum fails the test.
    named = rows.select(F.col(id_column).alias("vec_id"), _doubles(F.col(vector)).alias("vector"))
    norm2 = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    sized = named.withColumn("norm2", norm2).filter(F.col("vec_id").isNotNull())
    return sized.filter((F.col("norm2") > 0) & (F.col("norm2") < F.lit(math.inf))).distinct()


KINDS = {"long": LongType(), "array<double>": ArrayType(DoubleType())}


def _with_fields(df: DataFrame, **added: str) -> StructType:
    return StructType([*df.schema.fields, *[StructField(name, KINDS[kind]) for name, kind in added.items()]])


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _by_part(batch: pa.RecordBatch, parts: list[Part]) -> Iterator[tuple[Part, pa.RecordBatch, np.ndarray]]:
    numbers = batch.column(batch.schema.get_field_index("part")).to_numpy()
    for number in np.unique(numbers):
        rows = batch.filter(pa.array(numbers == number))
        yield parts[number], rows, _matrix(rows.column(rows.schema.get_field_index("vector")))


def _projector(index: Index):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows, vectors in _by_part(batch, index.parts):
                points = index.project(vectors, part.longest)
                cells = part.cell_of(points)
                point = pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), index.projected).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(cells, pa.int64()), point], [*rows.schema.names, "cell", "point"]
                )

    return project


def build_index(rows: DataFrame, k: int = K, projected: int = PROJECTED, cell_rows: int = CELL_ROWS) -> tuple[Index, DataFrame]:
    """The index and its stored rows: one per distinct vector, with the k + 1 smallest ids, its cell and projected point."""
    spark = rows.sparkSession
    smallest = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    classes = (
        rows.withColumn("_n", smallest)
        .filter(F.col("_n") <= k + 1)
        .groupBy("vector", "norm2")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("size", F.size("vector"))
        .withColumn("band", F.floor(F.log2(F.sqrt("norm2")) + 0.5).cast("int"))
    )
    classes = stored(classes, "ann-classes")
    counted = classes.groupBy("size", "band").agg(F.count("*").alias("n"), F.max(F.sqrt("norm2")).alias("longest"))
    bands = sorted(counted.collect())  # one row for each number of components and each power of two of the norm
    if not bands:
        return Index(projected, []), classes
    numbered = spark.createDataFrame([(size, band, i) for i, (size, band, *_) in enumerate(bands)], "size int, band int, part int")
    classes = classes.join(F.broadcast(numbered), ["size", "band"])
    total = sum(n for _, _, n, _ in bands)
    sampled = classes.select("part", "vector").sample(min(1.0, SAMPLE / total), SEED).toArrow()
    index, first = Index(projected, []), 0
    for number, (size, band, n, longest) in enumerate(bands):
        mine = sampled.filter(pa.compute.equal(sampled["part"], number)).combine_chunks()["vector"]
        vectors = _matrix(mine.combine_chunks()) if len(mine) else np.zeros((0, size))
        cells = min(n / cell_rows, MAX_CELLS, max(1, len(vectors) / 8))
        axes, values = upper_splits(index.project(vectors, longest), max(0, math.ceil(math.log2(cells))))
        index.parts.append(Part(size, band, longest, first, axes, values))
        first += index.parts[-1].cells
    schema = _with_fields(classes, cell="long", point="array<double>")
    placed = stored(classes.mapInArrow(_projector(index), schema), "ann-index")
    corners = [f(F.col("point")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(projected)]
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), *corners).collect()
    index.low, index.high = np.full((first, projected), math.inf), np.full((first, projected), -math.inf)
    index.pieces = np.zeros(first, dtype=np.int64)
    for row in boxes:
        index.pieces[row["cell"]] = -(-row["n"] // (2 * cell_rows))
        index.low[row["cell"]], index.high[row["cell"]] = row[2 : 2 + projected], row[2 + projected :]
    return index, placed


def _visitor(index: Index, limit: float, home: bool):
    """Which cells a query vector visits: at home the one it falls into, then all others that its bound can't rule out."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(batch.schema.get_field_index("vector")).offsets.to_numpy())
            for size in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == size))
                queries = _matrix(rows.column(rows.schema.get_field_index("vector")))
                points, norms = index.project(queries, None), (queries**2).sum(axis=1)
                parts = [p for p in index.parts if p.size == size]
                if not parts:
                    continue
                homes = parts[-1].cell_of(points)
                at, cell = np.arange(len(queries)), homes
                if not home:
                    bound = rows.column(rows.schema.get_field_index("bound")).to_numpy(zero_copy_only=False)
                    found = []
                    for part in parts:
                        cells = slice(part.first_cell, part.first_cell + part.cells)
                        for start in range(0, len(queries), 4096):
                            some = slice(start, start + 4096)
                            near = box_distances(index.low[cells], index.high[cells], points[some])
                            base = norms[some] + part.longest**2
                            reach = limit * np.maximum(base - 2 * bound[some], 0) + 1e-9 * (base + 1)
                            query, hit = np.nonzero(near <= reach[:, None])
                            found.append(np.stack([query + start, hit + part.first_cell], axis=1))
                    at, cell = np.concatenate(found).T
                    away = cell != homes[at]
                    at, cell = at[away], cell[away]
                pieces = index.pieces[cell]
                at, cell = np.repeat(at, pieces), np.repeat(cell, pieces)
                piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                point = pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), index.projected).cast(pa.list_(pa.float64()))
                visits = pa.RecordBatch.from_arrays([*rows.columns, point], [*rows.schema.names, "point"])
                for start in range(0, len(at), 8192):
                    some = visits.take(pa.array(at[start : start + 8192]))
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns, pa.array(cell[start : start + 8192], pa.int64()), pa.array(piece[start : start + 8192], pa.int64())],
                        [*some.schema.names, "cell", "piece"],
                    )

    return visit


def _cell_searcher(index: Index, wanted: int, limit: float):
    longest_of = np.concatenate([np.full(p.cells, p.longest) for p in index.parts])

    def search(cell: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"qid": [], "ids": [], "score": []}
        if len(cell) and len(queries):
            ids = cell["ids"].to_numpy()
            found = search_cell(
                np.stack(cell["point"].to_numpy()), np.stack(cell["vector"].to_numpy()), np.array([i[0] for i in ids]),
                longest_of[int(cell["cell"].iloc[0])], np.stack(queries["vector"].to_numpy()),
                np.stack(queries["point"].to_numpy()), queries["bound"].to_numpy(), wanted, limit,
            )
            for qid, (rows, products) in zip(queries["qid"], found):
                out["qid"] += [qid] * len(rows)
                out["ids"] += list(ids[rows])
                out["score"] += products.tolist()
        kinds = {"qid": "int64", "ids": "object", "score": "float64"}
        return pd.DataFrame({name: pd.Series(out[name], dtype=kind) for name, kind in kinds.items()})

    return search


def _searched(placed: DataFrame, queries: DataFrame, index: Index, wanted: int, limit: float, home: bool, chunks: int) -> DataFrame:
    schema = _with_fields(queries, point="array<double>", cell="long", piece="long")
    visits = queries.mapInArrow(_visitor(index, limit, home), schema).withColumn("chunk", F.pmod("qid", F.lit(chunks)))
    pieces = F.element_at(F.lit(index.pieces.tolist()), (F.col("cell") + 1).cast("int")) if len(index.pieces) <= 64 else None
    cells = placed.select("cell", "ids", "vector", "point")
    if pieces is None:
        spark = placed.sparkSession
        split = spark.createDataFrame([(c, int(n)) for c, n in enumerate(index.pieces)], "cell long, pieces long")
        cells = cells.join(F.broadcast(split), "cell")
        pieces = F.col("pieces")
    cells = cells.withColumn("piece", F.pmod(F.xxhash64("vector"), pieces)).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    ).select("cell", "ids", "vector", "point", "piece", F.col("chunk").cast("long").alias("chunk"))
    key = ["cell", "piece", "chunk"]
    searched = cells.groupBy(*key).cogroup(visits.withColumn("chunk", F.col("chunk").cast("long")).groupBy(*key))
    return searched.applyInPandas(_cell_searcher(index, wanted, limit), "qid long, ids array<long>, score double")


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = K,
    projected: int = PROJECTED,
    certainty: float = CERTAINTY,
    cell_rows: int = CELL_ROWS,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of the `k` nearest rows found for every query row; both tables have id and vector."""
    limit, wanted = chi_square_limit(certainty, projected), k + 1
    index, placed = build_index(usable(rows, id_column, vector), k, projected, cell_rows)
    asked = stored(usable(queries, id_column, vector).select(F.col("vec_id").alias("query_id"), "vector"), "ann-queries")
    vectors = asked.select("vector").distinct().withColumn("qid", F.monotonically_increasing_id())
    vectors = stored(vectors.withColumn("bound", F.lit(-math.inf)), "ann-query-vectors")
    if not index.parts:
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    chunks = 1 + vectors.count() // QUERY_ROWS
    at_home = stored(_searched(placed, vectors, index, wanted, limit, True, chunks), "ann-home")
    # The least of `wanted` products bounds what the other cells still have to beat.
    bounds = at_home.groupBy("qid").agg(F.when(F.count("*") >= wanted, F.min("score")).alias("_bound"))
    bounded = vectors.join(bounds, "qid", "left").select("vector", "qid", F.coalesce("_bound", "bound").alias("bound"))
    away = _searched(placed, stored(bounded, "ann-bounds"), index, wanted, limit, False, chunks)
    every = at_home.unionByName(away).select("qid", F.explode("ids").alias("vec_id"), "score")
    order = W.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id")
    best = every.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= wanted)
    lists = best.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("_n", "vec_id", "score"))).alias("found"))
    answers = stored(lists.join(vectors.select("qid", "vector"), "qid").select("vector", "found"), "ann-answers")
    # Both sides come from files, so a vector that a third of the queries share can be split.
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    each = asked.join(answers, "vector").select("query_id", F.posexplode(others).alias("_at", "_row"))
    return each.select("query_id", (F.col("_at") + 1).alias("rank"), "_row.vec_id", "_row.score")
