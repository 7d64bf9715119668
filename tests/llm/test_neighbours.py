from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from surveylake.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, rank string, score string, qid long, part int"


def brute(rows, query_ids, k):
    """{query_id: [(rank, vec_id, score)]} over rows (vec_id, vector) that take part; ids are unique."""
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    out = {}
    for q in query_ids:
        scores = neighbours.exact_products(vectors, vectors[ids == q][0])
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(n, int(ids[i]), float(scores[i])) for n, i in enumerate(order, 1)]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(rows) for q, rows in out.items()}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", None, 3, 4) for i, v in rows], SCHEMA)


def recall(got, expected):
    hits = sum(len({i for _, i, _ in rows} & {i for _, i, _ in got.get(q, [])}) for q, rows in expected.items())
    return hits / sum(map(len, expected.values()))


def clustered(seed, n, size, centres=30, lengths=(1.0, 1.0)):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, size))
    vectors = middle[rng.integers(0, centres, n)] + 0.6 * rng.standard_normal((n, size))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    return (vectors * rng.uniform(*lengths, n)[:, None]).astype(np.float32)


def test_given_table(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet")
    asked = rows.filter("vec_id % 20 = 0")
    plain = [(r.vec_id, r.embedding) for r in rows.collect()]
    expected = brute(plain, [i for i, _ in plain if i % 20 == 0], 20)
    got = found(neighbours.nearest(rows, asked))
    assert set(got) == set(expected) and recall(got, expected) >= 0.95
    scores = {(q, i): s for q, found_rows in brute(plain, list(expected), len(plain)).items() for _, i, s in found_rows}
    assert all(scores[q, i] == s for q, near in got.items() for _, i, s in near)


def test_many_cells_and_norms(spark):
    for lengths, least in (((1.0, 1.0), 0.95), ((0.01, 50.0), 0.9)):
        rows = list(enumerate(clustered(3, 6000, 24, lengths=lengths).tolist()))
        df = frame(spark, rows).repartition(8)
        got = found(neighbours.nearest(df, df.filter("vec_id % 40 = 0"), k=10, cell_rows=300))
        expected = brute(rows, range(0, 6000, 40), 10)
        assert recall(got, expected) >= least
        assert all([n for n, *_ in near] == list(range(1, 11)) for near in got.values())


def test_stopping_test_leaves_cells_out(spark):
    vectors = clustered(4, 6000, 8, centres=60)
    rows = list(enumerate(vectors.tolist()))
    df = frame(spark, rows).repartition(8)
    limit = neighbours.chi_square_limit(neighbours.CERTAINTY, neighbours.PROJECTED)
    index, placed = neighbours.build_index(neighbours.usable(df), 5, cell_rows=100)
    assert len(index.parts) == 1 and placed.count() == 6000 and placed.select("cell").distinct().count() > 30
    queries = neighbours.usable(df.filter("vec_id % 50 = 0")).select("vector").withColumn("qid", F.monotonically_increasing_id())
    bounded = queries.withColumn("bound", F.lit(0.95))
    schema = neighbours._with_fields(bounded, point="array<double>", cell="long", piece="long")
    visits = bounded.mapInArrow(neighbours._visitor(index, limit, False), schema).count()
    assert 0 < visits < 0.8 * 120 * index.parts[0].cells


def test_chi_square():
    # Fixed values of the distribution's table: 8 degrees of freedom, 95 % and 99 %.
    assert math.isclose(neighbours.chi_square_limit(0.95, 8), 15.507, abs_tol=1e-3)
    assert math.isclose(neighbours.chi_square_limit(0.99, 8), 20.090, abs_tol=1e-3)
    drawn = (np.random.default_rng(0).standard_normal((20000, 8)) ** 2).sum(axis=1)
    assert abs((drawn <= neighbours.chi_square_limit(0.9, 8)).mean() - 0.9) < 0.01


def test_equal_vectors_ties_and_hot_queries(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(i, [0.9, math.sqrt(1 - 0.81)]) for i in range(300, 340)]
    df = frame(spark, rows + rows[:50])
    got = found(neighbours.nearest(df, df.filter("vec_id % 20 = 0"), k=5, cell_rows=8))
    assert got == brute(rows, range(0, 340, 20), 5)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(None, [1.0, 2.0]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [nan, 1.0]), (120, [inf, 1.0])]
    rows = [(0, [1.0, 1.0]), (1, [2.0, 0.0]), (2, [-1.0, 0.5]), (140, [1.0, 2.0])]
    df = frame(spark, odd + rows + [(160, [1.0, 2.0, 3.0])])
    got = found(neighbours.nearest(df, df.filter("vec_id % 20 = 0")))
    assert got == brute(rows, [0, 140], 20)


def test_repeated_ids(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0])])
    rows = sorted(tuple(r) for r in neighbours.nearest(df, df.filter("vec_id = 0")).collect())
    assert rows == [(0, 1, 1, 1.0), (0, 1, 1, 3.0), (0, 2, 1, 0.0), (0, 2, 1, 1.0)]


def test_empty_table(spark):
    df = frame(spark, [])
    assert neighbours.nearest(df, df).count() == 0
    rows = frame(spark, [(0, [1.0, 2.0])])
    assert neighbours.nearest(rows, rows).count() == 0
