"""Toxicity by a convolutional text classifier trained in numpy.

A word is the mean of hashed embeddings: its whole form and its character n-grams. One dimension begins as
the evidence that the bucket's texts are toxic, counted over the rows the weights are fitted on; the others at random. Filters of
several widths run over the words, each filter keeps its largest value in the text (max pooling), and a logistic
layer scores the kept values. Training sends gradients through the winning positions only.

The decision threshold is calibrated for each language on rows the weights were not fitted on. The language is guessed
from the text's function words, never read from a column; the score is shifted so that 0.5 is the threshold.

Every labelled row of the learning folds is learned from: four of five ids fit the weights, the fifth calibrates. The rows are dealt by
id to shards of about SHARD_ROWS, and a task takes whole shards. Texts move once, into the shards, where they meet their labels; most
texts without a label stay where they are, as their ids' slots aren't marked, and the join drops those that share a slot. In each epoch every task starts from the same weights, takes its
rows once in blocks of SCORE_BYTES, and the weights of all tasks are averaged by their rows (with Adagrad's sums, kept per embedding
row between epochs). Thresholds come from counts of all held rows on a grid of GRID in the logit. A task holds the weights and one
block; the driver holds the weights, some 9 MB, and at most 5 x 2 x 100 / GRID counts.
Scoring reads whole texts, one row at a time or a few, in memory bounded by the longest text.

Defined results: a null or empty text is scored as one window without words; labels without a document, and null labels, are not
learned from; of contradicting labels of one id the larger counts; without labels of both kinds every score is the share of toxic labels (0 without any);
repeated rows get equal scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.llm.grams import WordGrams, sums_of_runs
from surveylake.llm.words import Words, pieces, split_words, stored

SHARD_ROWS = 1 << 14
# Slots that the labelled ids are marked in before texts are dealt: so many for each id, and at most.
ID_SLOTS, MOST_SLOTS = 8, 1 << 25
# Rows of embeddings that travel together, and the step of the logits that thresholds are looked for on.
E_BLOCK = 1 << 10
GRID = 1e-3
FOLDS = 5
BUCKET_BITS = 17
GRAMS = (0, 4, 5)
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 16
EPOCHS = 4
BATCH = 32
SCORE_BYTES = 2 << 20
# Frequent function words, by which a text's language is guessed for the threshold only.
FUNCTION_WORDS = {
    "en": ("the", "and", "of", "to", "is", "that", "it", "was", "for", "with"),
    "de": ("der", "die", "und", "das", "ist", "nicht", "ein", "den", "von", "mit"),
    "fr": ("le", "les", "et", "des", "est", "une", "dans", "qui", "pour", "du"),
    "es": ("el", "los", "y", "las", "es", "una", "en", "por", "del", "con"),
}
GROUPS = (*FUNCTION_WORDS, "other")


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is hashed as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def language_groups(words: Words) -> np.ndarray:
    """Per text, the position in GROUPS of the language whose function words are most frequent; the last without any."""
    place = {w: i for i, group in enumerate(FUNCTION_WORDS.values()) for w in group}
    bare = pc.ascii_trim(pc.ascii_lower(words.vocabulary.cast(pa.large_binary()).view(pa.large_string())), ".,;:!?")
    found = pc.index_in(bare, pa.array(place, pa.large_string())).fill_null(-1).to_numpy()
    group = np.append(np.array([*place.values()])[found], 0)
    marked = np.flatnonzero(np.append(found >= 0, False)[words.codes])
    cells = (np.searchsorted(words.bounds, marked, "right") - 1) * len(FUNCTION_WORDS) + group[words.codes[marked]]
    texts = len(words.bounds) - 1
    counts = np.bincount(cells, minlength=texts * len(FUNCTION_WORDS)).reshape(texts, len(FUNCTION_WORDS))
    return np.where(counts.max(axis=1, initial=0) > 0, counts.argmax(axis=1), len(FUNCTION_WORDS))


def padded(words: Words, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word codes with `pad` codes of no word after each text, and the new bounds."""
    counts = words.counts()
    bounds = np.concatenate([[0], np.cumsum(counts + pad)])
    codes = np.full(bounds[-1], len(words.vocabulary), dtype=np.int64)
    codes[np.arange(len(words.codes)) + np.repeat(np.arange(len(counts)) * pad, counts)] = words.codes
    return codes, bounds


class Network:
    """The weights: embeddings E, filters W (one block for each width and place in it), biases b, output v and c."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.E = (rng.standard_normal((1 << BUCKET_BITS, DIM)) * 0.1).astype(np.float32)
        self.W = (rng.standard_normal((DIM, sum(WIDTHS) * FILTERS)) * 0.2).astype(np.float32)
        self.b = np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32)
        self.v = (rng.standard_normal(len(WIDTHS) * FILTERS) * 0.1).astype(np.float32)
        self.c = np.zeros(1, dtype=np.float32)

    def start_from(self, odds: np.ndarray) -> None:
        """Put the evidence for each bucket into the first dimension, which all filters begin to look at."""
        self.E[:, 0] = odds
        self.W[0] += 0.5
        self.v += 0.1

    def projections(self, embeddings: np.ndarray) -> np.ndarray:
        """What each word adds to each filter at each place of its window; the last row is for no word."""
        rows = np.zeros((len(embeddings) + 1, self.W.shape[1]), dtype=np.float32)
        np.matmul(embeddings, self.W, out=rows[:-1])
        return rows

    def windows(self, projected: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """For each width, the value of each filter at each window; windows that pass a text's end are -inf."""
        block = 0
        for width in WIDTHS:
            columns = [slice((block + k) * FILTERS, (block + k + 1) * FILTERS) for k in range(width)]
            out = projected[codes, columns[0]]
            for k in range(1, width):
                out[:-k] += projected[codes[k:], columns[k]]
                out[bounds[1:] - k] = -np.inf
            yield out
            block += width

    def logits(self, words: Words, embeddings: np.ndarray) -> np.ndarray:
        codes, bounds = padded(words, max(WIDTHS))
        projected = self.projections(embeddings)
        by_filter = np.empty(projected.shape[::-1], dtype=np.float32)
        for low in range(0, len(projected), 256):
            by_filter[:, low : low + 256] = projected[low : low + 256].T
        del projected
        pooled = np.empty((len(bounds) - 1, len(self.b)), dtype=np.float32)
        block = 0
        for i, width in enumerate(WIDTHS):
            for f in range(FILTERS):
                out = by_filter[block * FILTERS + f].take(codes)
                for k in range(1, width):
                    out[:-k] += by_filter[(block + k) * FILTERS + f].take(codes[k:])
                    out[bounds[1:] - k] = -np.inf
                pooled[:, i * FILTERS + f] = np.maximum.reduceat(out, bounds[:-1])
            block += width
        values = np.maximum(pooled + self.b, 0).astype(np.float64)
        return values @ self.v.astype(np.float64) + self.c[0]


def embed(grams: WordGrams, table: np.ndarray) -> np.ndarray:
    return grams.sums(table) / np.maximum(grams.totals(), 1)[:, None].astype(np.float32)


def bucket_lists(grams: WordGrams) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words one after another, and where those of each word begin."""
    begins = np.concatenate([[0], np.cumsum(grams.totals())])
    flat, filled = np.zeros(begins[-1], dtype=np.int64), begins[:-1].copy()
    for buckets, counts in zip(grams.buckets, grams.counts):
        flat[np.repeat(filled - (np.cumsum(counts) - counts), counts) + np.arange(len(buckets))] = buckets
        filled += counts
    return flat, begins


def of_words(flat: np.ndarray, begins: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of some words one after another, and how many each has."""
    sizes = begins[words + 1] - begins[words]
    return flat[np.repeat(begins[words] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())], sizes


def texts_of_buckets(words: Words, labels: np.ndarray) -> np.ndarray:
    """Per label and bucket, the number of texts that hold it."""
    seen = np.zeros((2, 1 << BUCKET_BITS), dtype=np.int64)
    flat, begins = bucket_lists(WordGrams(words.vocabulary, GRAMS, BUCKET_BITS))
    for i, label in enumerate(labels):
        own = np.unique(words.codes[words.bounds[i] : words.bounds[i + 1]])
        seen[int(label), np.unique(of_words(flat, begins, own)[0])] += 1
    return seen


def evidence(seen: np.ndarray, totals: np.ndarray, prior: float = 0.5) -> np.ndarray:
    """Per bucket, the log odds of its texts being of label 1 rather than 0, in standard errors; rare buckets stay near 0."""
    rates = np.log((seen + prior) / (totals[:, None] + 2 * prior))
    return (rates[1] - rates[0]) / np.sqrt((1 / (seen + prior)).sum(axis=0))


class _Trainer:
    """Adagrad on the logistic loss; embedding rows without a gradient are left alone."""

    def __init__(self, network: Network, seen: dict[str, np.ndarray], rate: float = 0.05):
        self.net, self.seen, self.rate = network, seen, rate

    def take(self, words: Words, labels: np.ndarray) -> None:
        """The texts that the next batches are of."""
        self.words, self.labels = words, labels
        self.flat, self.begins = bucket_lists(WordGrams(words.vocabulary, GRAMS, BUCKET_BITS))

    def _step(self, name: str, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        seen, value = self.seen[name], getattr(self.net, name)
        seen[rows] += gradient * gradient
        value[rows] -= self.rate * gradient / np.sqrt(seen[rows])

    def batch(self, texts: np.ndarray) -> None:
        net, all_words = self.net, self.words
        ranges = [all_words.codes[all_words.bounds[i] : all_words.bounds[i + 1]] for i in texts]
        used, codes = np.unique(np.concatenate(ranges), return_inverse=True)
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in ranges])])
        flat, sizes = of_words(self.flat, self.begins, used)
        emb = np.zeros((0, DIM), dtype=np.float32)
        if len(used):
            emb = sums_of_runs(net.E, flat, np.cumsum(sizes) - sizes, sizes) / sizes[:, None].astype(np.float32)
        codes, bounds = padded(Words(bounds, codes, used), max(WIDTHS))
        projected = net.projections(emb)
        best, where = [], []
        for out in net.windows(projected, codes, bounds):
            place = np.stack([out[a:b].argmax(axis=0) + a for a, b in zip(bounds[:-1], bounds[1:])])
            where.append(place)
            best.append(np.take_along_axis(out, place, axis=0))
        pooled = np.maximum(np.concatenate(best, axis=1) + net.b, 0)
        score = 1 / (1 + np.exp(-(pooled @ net.v + net.c[0])))
        error = ((score - self.labels[texts]) / len(texts)).astype(np.float32)
        back = error[:, None] * net.v * (pooled > 0)
        d_projected = np.zeros_like(projected)
        block = 0
        for i, width in enumerate(WIDTHS):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            for k in range(width):
                column = (block + k) * FILTERS + np.arange(FILTERS)
                np.add.at(d_projected, (codes[where[i] + k], np.broadcast_to(column, where[i].shape)), part)
            block += width
        d_projected = d_projected[:-1]
        touched = np.flatnonzero(d_projected.any(axis=1))
        d_emb = d_projected[touched] @ net.W.T / sizes[touched, None].astype(np.float32)
        if len(touched):
            rows, _ = of_words(self.flat, self.begins, used[touched])
            unique, inverse = np.unique(rows, return_inverse=True)
            d_rows = np.zeros((len(unique), DIM), dtype=np.float32)
            np.add.at(d_rows, inverse, np.repeat(d_emb, sizes[touched], axis=0))
            self._step("W", emb.T @ d_projected)
            self._step("E", d_rows, unique)
        self._step("v", error @ pooled)
        self._step("b", back.sum(axis=0))
        self._step("c", np.array([error.sum()], dtype=np.float32))


def threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The cut with the best weighted F1; of equally good cuts, the middle of the widest gap."""
    order = np.argsort(logits)[::-1]
    ranked, positive = logits[order], weights[order] * (labels[order] == 1)
    hit = np.cumsum(positive)
    f1 = 2 * hit / (np.cumsum(weights[order]) + positive.sum())
    gap = ranked - np.append(ranked[1:], ranked[-1] - 1)
    score = np.where(gap > 0, f1, 0)
    top = np.flatnonzero(score >= score.max() - 1e-9)
    i = top[gap[top].argmax()]
    return float(ranked[i] - gap[i] / 2)


def thresholds(held: list[tuple[int, int, float, int]], prior: np.ndarray) -> np.ndarray:
    """The cut of each language group from counts of (group, label, logit); `prior` weighs the rows of a label."""
    groups, labels, logits, n = (np.array(column) for column in zip(*held)) if held else (np.zeros(0, dtype=int),) * 4
    weights = n * prior[labels]

    def least(own: np.ndarray) -> int:
        return min(n[own & (labels == 0)].sum(), n[own & (labels == 1)].sum())

    every = np.ones(len(n), dtype=bool)
    overall = threshold(logits, labels, weights) if least(every) > 0 else 0.0
    cuts = np.full(len(GROUPS), overall)
    for g in range(len(GROUPS)):
        own = groups == g
        if least(own) >= 10:
            cuts[g] = threshold(logits[own], labels[own], weights[own])
    return cuts


def _blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray]]:
    """Words and labels of blocks of texts (`text`, `toxic`)."""
    for batch in rows:
        for piece in pieces(batch, limit=SCORE_BYTES):
            yield split_words(piece.column("text")), piece.column("toxic").to_numpy().astype(np.float32)


PARTS = "name string, place int, task int, weight double, data binary"


def _sent(arrays: dict[str, np.ndarray], weight: float) -> Iterator[pa.RecordBatch]:
    """A task's arrays in blocks of rows."""
    task = TaskContext.get().partitionId()
    for name, values in arrays.items():
        for place, low in enumerate(range(0, len(values), E_BLOCK)):
            data = values[low : low + E_BLOCK].astype(np.float64 if name == "texts" else np.float32).tobytes()
            columns = [[name], [place], [task], [weight], [data]]
            types = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["name", "place", "task", "weight", "data"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the same place, weighed and added up in the order of the tasks; one sum is held at a time."""
    key, total, weights = None, None, 0.0

    def done() -> pa.RecordBatch:
        columns = [[key[0]], [key[1]], [0], [weights], [total.tobytes()]]
        types = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["name", "place", "task", "weight", "data"])

    for batch in batches:
        for name, place, _, weight, data in zip(*[c.to_pylist() for c in batch.columns]):
            if (name, place) != key:
                if key is not None:
                    yield done()
                key, total, weights = (name, place), 0.0, 0.0
            total = total + weight * np.frombuffer(data, dtype=np.float64 if name == "texts" else np.float32).astype(np.float64)
            weights += weight
    if key is not None:
        yield done()


def _gathered(parts: DataFrame) -> dict[str, tuple[np.ndarray, float]]:
    """The weighted sums of all tasks' arrays, flat, and the sums of their weights; the driver gets one copy of the arrays."""
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = parts.repartition(tasks, "name", "place").sortWithinPartitions("name", "place", "task").mapInArrow(_merge, PARTS)
    rows = sorted(merged.collect(), key=lambda r: (r["name"], r["place"]))
    return {
        name: (np.concatenate([np.frombuffer(r["data"], dtype=np.float64) for r in rows if r["name"] == name]), weight)
        for name, weight in {r["name"]: r["weight"] for r in rows}.items()
    }


def _epoch(state, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, seen, taken = Network.__new__(Network), {}, 0
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for name in "EWbvc":
            setattr(network, name, state.value[name].copy())
            seen[name] = np.array(np.broadcast_to(state.value["seen " + name], getattr(network, name).shape))
        trainer = _Trainer(network, seen, rate)
        for words, labels in _blocks(batches):
            trainer.take(words, labels)
            taken += len(labels)
            order = rng.permutation(len(labels))
            for low in range(0, len(order), BATCH):
                trainer.batch(order[low : low + BATCH])
        if taken:
            seen["E"] = seen["E"].mean(axis=1, keepdims=True)
            yield from _sent({n: getattr(network, n) for n in "EWbvc"} | {"seen " + n: seen[n] for n in "EWbvc"}, taken)

    return run


def _held_counts(state):
    """Per language group, label and logit on the grid, the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, found = Network.__new__(Network), {}
        for name in "EWbvc":
            setattr(network, name, state.value[name])
        for words, labels in _blocks(batches):
            logits = network.logits(words, embed(WordGrams(words.vocabulary, GRAMS, BUCKET_BITS), network.E))
            steps = np.round(np.clip(logits, -50, 50) / GRID).astype(np.int64)
            for key in zip(language_groups(words).tolist(), labels.astype(int).tolist(), steps.tolist()):
                found[key] = found.get(key, 0) + 1
        if found:
            columns = [*zip(*found), tuple(found.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["language", "toxic", "step", "n"])

    return run


def fit(rows: DataFrame, shares: tuple[float, float], parts: tuple[int, int], seed: int = 11) -> bytes:
    """Train on the rows that aren't `held` and calibrate on the others; the model as bytes.

    `rows` have `text`, `toxic` and `held`, `parts` of them labels 0 and 1; `shares` are those of the labels in the whole table.
    """
    context = rows.sparkSession.sparkContext
    fitting, network = rows.filter("not held").select("text", "toxic"), Network(seed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, totals = np.zeros((2, 1 << BUCKET_BITS), dtype=np.int64), np.zeros(2)
        for words, labels in _blocks(batches):
            seen += texts_of_buckets(words, labels)
            totals += np.bincount(labels.astype(int), minlength=2)
        yield from _sent({"texts": np.concatenate([totals, seen.ravel()])}, 1.0)

    counted = _gathered(fitting.mapInArrow(count, PARTS)).get("texts", (np.zeros(2 + (2 << BUCKET_BITS)), 0))[0]
    network.start_from(evidence(counted[2:].reshape(2, -1), counted[:2]) / 3)
    state = {name: getattr(network, name) for name in "EWbvc"}
    state |= {"seen " + name: np.full_like(state[name][:, :1] if name == "E" else state[name], 1e-6) for name in "EWbvc"}
    for epoch in range(EPOCHS):
        shared = context.broadcast(state)
        gathered = _gathered(fitting.mapInArrow(_epoch(shared, 0.05 / (1 + epoch), seed + epoch), PARTS))
        state |= {name: (total / weight).reshape(state[name].shape).astype(np.float32) for name, (total, weight) in gathered.items()}
        shared.unpersist()
    shared = context.broadcast(state)
    held = rows.filter("held").select("text", "toxic").mapInArrow(_held_counts(shared), "language long, toxic long, step long, n long")
    held = held.groupBy("language", "toxic", "step").agg(F.sum("n").alias("n")).orderBy("language", "toxic", "step").collect()
    shared.unpersist()
    prior = np.array(shares) / np.maximum(1, parts)
    cuts = thresholds([(r["language"], r["toxic"], r["step"] * GRID, r["n"]) for r in held], prior)
    out = io.BytesIO()
    np.savez(out, **{name: state[name] for name in "EWbvc"}, cuts=cuts)
    return out.getvalue()


class Scorer:
    def __init__(self, model: bytes):
        stored_arrays = np.load(io.BytesIO(model))
        self.network = Network.__new__(Network)
        for name in "EWbvc":
            setattr(self.network, name, stored_arrays[name])
        self.cuts = stored_arrays["cuts"]

    def scores(self, texts: pa.Array) -> np.ndarray:
        words = split_words(texts)
        embeddings = embed(WordGrams(words.vocabulary, GRAMS, BUCKET_BITS), self.network.E)
        shifted = self.network.logits(words, embeddings) - self.cuts[language_groups(words)]
        # Rounded, so that the rows scored together don't show in the last digits.
        return np.round(1 / (1 + np.exp(-np.clip(shifted, -50, 50))), 5)


def perhaps_known(docs: DataFrame, known: DataFrame, ids: int) -> DataFrame:
    """The rows of all known ids, and of a few others: those whose id shares a slot with one. More ids than slots only let more through."""
    slots = min(MOST_SLOTS, 64 * max(1, -(-ids * ID_SLOTS // 64)))
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(slots))
    marked = known.select(slot.alias("_slot")).groupBy(F.shiftrightunsigned("_slot", 6).alias("_word"))
    marked = marked.agg(F.bit_or(F.expr("shiftleft(1L, cast(_slot & 63 AS int))")).alias("_marks"))
    rows = docs.filter("doc_id is not null").filter(fold(F.col("doc_id")) != 0).withColumn("_slot", slot)
    found = (F.shiftrightunsigned("_slot", 6) == F.col("_word")) & (F.getbit("_marks", F.col("_slot").bitwiseAND(63)) == 1)
    return rows.join(F.broadcast(marked), found, "left_semi").drop("_slot")


def learning_rows(docs: DataFrame, known: DataFrame, ids: int, shards: int) -> DataFrame:
    """`text`, `toxic` and `held` of every labelled row, an id's equal texts once, dealt to shards by id and in the order of its hash."""
    rows = perhaps_known(docs.select("doc_id", "text"), known, ids).repartition(shards, "doc_id")
    rows = rows.join(known.repartition(shards, "doc_id"), "doc_id").dropDuplicates(["doc_id", "text"])
    key = F.xxhash64("doc_id")
    held = (F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) == 0).alias("held")
    return stored(rows.sortWithinPartitions(key, "doc_id", "text").select("text", "toxic", held), "toxicity-rows")


def train(docs: DataFrame, labels: DataFrame) -> bytes | float:
    """The model from all labelled rows of the learning folds; without both labels, the share of toxic ones."""
    known = (
        labels.filter("toxic is not null and doc_id is not null")
        .filter(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    known = stored(known, "toxicity-labels")
    counts = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    shares = (counts.get(0, 0) / max(1, total), counts.get(1, 0) / max(1, total))
    shards = max(1, -(-total // SHARD_ROWS))
    rows = learning_rows(docs, known, total, shards)
    found = {row.toxic: row.n for row in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (found.get(0) and found.get(1)):
        return shares[1]
    return fit(rows.coalesce(min(shards, docs.sparkSession.sparkContext.defaultParallelism)), shares, (found[0], found[1]))


def score_documents(docs: DataFrame, model: bytes | float) -> DataFrame:
    """`doc_id` and `score` of every row."""
    if not isinstance(model, bytes):
        return docs.select("doc_id", F.lit(float(model)).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 2 MB, whatever the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for piece in pieces(batch, limit=SCORE_BYTES):
                scores = pa.array(scorer.scores(piece.column(1)), pa.float64())
                yield pa.RecordBatch.from_arrays([piece.column(0), scores], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
