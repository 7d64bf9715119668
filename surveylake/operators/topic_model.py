"""Latent Dirichlet allocation by online variational Bayes over stored word counts, fitted in Spark jobs.

The texts are dealt evenly over a few stored parts. A step reads one part: its tasks infer the topics of every text in it
and sum what each column gives to each topic, Spark adds these sums up, and the driver moves the weights (`k` times
`columns` of them). A pass takes every part once, so every text enters it exactly once, and the perplexity
of all texts comes out of the same jobs. A fit goes on from pass to pass; nothing is started again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.session import scratch_path

# Parts of a pass, and the texts that a part should have at least: fewer texts make fewer parts.
PARTS = 8
PART_TEXTS = 1000
# Rate of step t: (OFFSET + t) ** -DECAY.
OFFSET, DECAY = 1.0, 0.51
# Topics of a text are inferred until they change by this many words on average, or this share of the words per topic.
CHANGE, SHARE = 1e-3, 1e-4
# Cells (a text's distinct columns) that are worked on at a time, and what keeps their likelihoods from being zero.
CHUNK = 1 << 13
TINY = np.float32(1e-30)
# Rows of a step's sums beside those of the columns.
MIXTURE, TEXTS, WORDS, BOUND = -1, -2, -3, -4


def _shifted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x + 6 and 1 / (x + 6) ** 2, where the asymptotic series below are good to 1e-8."""
    y = x + 6
    return y, 1 / (y * y)


def digamma(x: np.ndarray) -> np.ndarray:
    y, r = _shifted(x)
    below = 1 / x + 1 / (x + 1) + 1 / (x + 2) + 1 / (x + 3) + 1 / (x + 4) + 1 / (x + 5)
    return np.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r / 240))) - below


def trigamma(x: np.ndarray) -> np.ndarray:
    y, r = _shifted(x)
    return (1 + 0.5 / y + r * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30)))) / y + sum(1 / (x + i) ** 2 for i in range(6))


def log_gamma(x: np.ndarray) -> np.ndarray:
    y, r = _shifted(x)
    below = np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - r * (1 / 360 - r / 1260)) / y - below


def infer(weights: np.ndarray, counts: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the Dirichlet weights of its topics, and per cell the likelihood up to the text's own factor.

    `weights` has a text's cells as its rows, `counts` their words; cells without words fill up the shorter texts.
    Texts that have settled leave the iteration.
    """
    totals = counts.sum(axis=1, dtype=np.float64)
    gamma = alpha + totals[:, None] / len(alpha)
    enough = np.maximum(CHANGE, SHARE * totals / len(alpha))
    live, c, w = np.arange(len(gamma)), counts, weights
    while len(live):
        own = gamma[live]
        theta = np.exp(digamma(own)).astype(np.float32)
        share = c / (np.matmul(w, theta[:, :, None])[:, :, 0] + TINY)
        new = alpha + theta * np.matmul(share[:, None, :], w)[:, 0, :]
        gamma[live] = new
        moving = np.abs(new - own).mean(axis=1) > enough[live]
        # Cells are copied only where that spares a good part of them.
        if moving.sum() < 0.8 * len(live):
            live, c, w = live[moving], c[moving], w[moving]
    theta = np.exp(digamma(gamma)).astype(np.float32)
    return gamma, np.matmul(weights, theta[:, :, None])[:, :, 0] + TINY


def _chunks(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The texts in groups of about equal numbers of cells."""
    order, low = np.argsort(-sizes, kind="stable"), 0
    while low < len(order):
        high = low + max(1, CHUNK // int(sizes[order[low]]))
        yield order[low:high]
        low = high


def _step_sums(beta, alpha: np.ndarray):
    """Per task: what each column gives to each topic (without the column's own weight), and the sums of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = beta.value
        columns, k = known.shape
        given, mixture, texts, words, bound = np.zeros((k, columns)), np.zeros(k), 0, 0.0, 0.0
        for batch in batches:
            lists, values = batch.column(0), batch.column(1)
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            starts = np.cumsum(sizes) - sizes
            cols, n = lists.flatten().to_numpy(), values.flatten().to_numpy().astype(np.float32)
            for chunk in _chunks(sizes):
                places = np.arange(sizes[chunk[0]])
                inside = places < sizes[chunk, None]
                cells = np.where(inside, starts[chunk, None] + places, 0)
                at, c = cols[cells], np.where(inside, n[cells], np.float32(0))
                gamma, norm = infer(known[at], c, alpha)
                total, expected = gamma.sum(axis=1), digamma(gamma)
                theta, share = np.exp(expected), c / norm
                for topic in range(k):
                    given[topic] += np.bincount(at.ravel(), (theta[:, topic, None] * share).ravel(), minlength=columns)
                expected -= digamma(total)[:, None]
                own = c.sum(axis=1, dtype=np.float64)
                bound += (c * np.log(norm, dtype=np.float64)).sum() - (own * digamma(total)).sum()
                bound += ((alpha - gamma) * expected + log_gamma(gamma) - log_gamma(alpha)).sum()
                bound += (log_gamma(alpha.sum(keepdims=True)) - log_gamma(total)).sum()
                mixture += expected.sum(axis=0)
                texts, words = texts + len(chunk), words + own.sum()
        if not texts:
            return
        used = np.flatnonzero(given.any(axis=0))
        extra = np.zeros((k, 4))
        extra[:, 0], extra[0, 1:] = mixture, (texts, words, bound)
        names = pa.array(np.concatenate([used, [MIXTURE, TEXTS, WORDS, BOUND]]), pa.int32())
        sums = np.concatenate([given[:, used], extra], axis=1)
        yield pa.RecordBatch.from_arrays([names, *map(pa.array, sums)], ["at", *[f"s{i}" for i in range(k)]])

    return run


@dataclass
class Topics:
    """`weights`: one row per topic; `alpha`: the prior of a text's topics; `perplexity`: log, a word, of the last pass."""

    weights: np.ndarray
    alpha: np.ndarray
    perplexity: float = math.inf
    steps: int = 0

    def described(self) -> np.ndarray:
        return self.weights / self.weights.sum(axis=1, keepdims=True)


def deal(numbered: DataFrame, columns: str, path: str) -> int:
    """Store the counts of every text with a word, dealt over the parts row by row; returns their number."""
    part = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(PARTS)).cast("int")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(1)
            lengths = cells.value_lengths().to_numpy()
            if not lengths.sum():
                continue
            owner = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
            at, n = np.unique(owner << 32 | cells.flatten().to_numpy().astype(np.int64), return_counts=True)
            own = at >> 32
            starts = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(at)).astype(np.int32)
            offsets = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(own[starts[:-1]])),
                    pa.ListArray.from_arrays(offsets, pa.array((at & 0xFFFFFFFF).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32))),
                ],
                ["part", "columns", "counts"],
            )

    found = numbered.select(part.alias("part"), F.col(columns).alias("columns"))
    found = found.mapInArrow(count, "part int, columns array<int>, counts array<int>")
    found.write.partitionBy("part").parquet(path)
    return found.sparkSession.read.schema(found.schema).parquet(path).count()


def _step(counted: DataFrame, parts: list[int], topics: Topics, texts: int) -> tuple[float, float]:
    """Move the topics by the texts of some parts; returns their bound and their words."""
    spark, (k, columns) = counted.sparkSession, topics.weights.shape
    beta = np.exp(digamma(topics.weights) - digamma(topics.weights.sum(axis=1, keepdims=True)))
    shared = spark.sparkContext.broadcast(np.ascontiguousarray(beta.T, dtype=np.float32))
    names = [f"s{i}" for i in range(k)]
    rows = counted.filter(F.col("part").isin(parts)).select("columns", "counts")
    sums = rows.mapInArrow(_step_sums(shared, topics.alpha), "at int, " + ", ".join(f"{s} double" for s in names))
    # A row per column in use, whatever the texts.
    found = sums.groupBy("at").agg(*[F.sum(s).alias(s) for s in names]).toArrow()
    shared.unpersist()
    if not found.num_rows:
        return 0.0, 0.0
    at = found["at"].to_numpy()
    values = np.stack([found[s].to_numpy() for s in names])
    given = np.zeros((k, columns))
    given[:, at[at >= 0]] = values[:, at >= 0]
    extra = {int(i): values[:, j] for j, i in enumerate(at) if i < 0}
    seen = extra[TEXTS][0]
    topics.steps += 1
    rate = (OFFSET + topics.steps) ** -DECAY
    topics.weights = (1 - rate) * topics.weights + rate * (1 / k + texts / seen * given * beta)
    # One Newton step for the prior of the texts' topics, left out where it would leave the positive numbers.
    alpha = topics.alpha
    slope = extra[MIXTURE] / seen - (digamma(alpha) - digamma(alpha.sum(keepdims=True)))
    bend, all_bend = -trigamma(alpha), trigamma(alpha.sum(keepdims=True))[0]
    change = -(slope - (slope / bend).sum() / (1 / all_bend + (1 / bend).sum())) / bend
    if (alpha + rate * change > 0).all():
        topics.alpha = alpha + rate * change
    return extra[BOUND][0], extra[WORDS][0]


def fit(
    numbered: DataFrame, column: str, columns: int, k: int, seed: int, tolerance: float, steps: int, max_passes: int
) -> Topics:
    """Passes over all texts until doubling their number changes the perplexity by the share `tolerance` or less.

    At least `steps` steps are made, at most `max_passes` passes.
    """
    path = scratch_path(numbered.sparkSession, "topic-counts")
    texts = deal(numbered, column, path)
    topics = Topics(np.random.default_rng(seed).gamma(100, 1 / 100, (k, columns)), np.full(k, 1 / k))
    if not texts:
        return topics
    counted = numbered.sparkSession.read.schema("columns array<int>, counts array<int>, part int").parquet(path)
    dealt = max(1, min(PARTS, texts // PART_TEXTS))
    before = math.inf
    for done in range(1, max_passes + 1):
        bounds = [_step(counted, list(range(i, PARTS, dealt)), topics, texts) for i in range(dealt)]
        topics.perplexity = -sum(b for b, _ in bounds) / sum(w for _, w in bounds)
        if done & (done - 1) == 0:  # 1, 2, 4, 8, ...
            if abs(before - topics.perplexity) <= tolerance * abs(topics.perplexity) and topics.steps >= steps:
                break
            before = topics.perplexity
    return topics
