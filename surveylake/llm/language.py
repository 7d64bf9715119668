"""Language identification in two steps: the family first, then one-versus-one linear SVMs inside it.

Features are frequencies of hashed character n-grams of words. All models are linear in them, so a word's part in
every decision is computed once per distinct word and summed over the text.

Families come from a fixed table; a language that isn't in it is a family of its own. Each family has a
linear SVM against the others, each pair of languages of a family one against each other. The family with the
largest margin wins, then the language with most won pairs; ties go to the larger sum of margins, then to the lower code point.

Bound: models are fitted in one task, on at most `SAMPLE` ids per language and `SAMPLE_ROWS` in all, chosen by a hash of the id, with one text each
and `SAMPLE_BYTES` together; what a language's ids hold beyond its share of the bytes is not learned from. The `MAX_LANGUAGES` languages with most
learning rows are learned (ties to the lower code), so a long tail of stray codes does not stop the fit; the others are not predicted.
Prediction reads whole texts of all rows.

Defined results: a null text or one without a letter is `und` with score 0, and so is every text when nothing could be learned; rows with a null
language or id or without a letter are not learned from; one learned language is predicted for every text with a letter;
repeated rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io
import itertools
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveylake.llm.grams import WordGrams
from surveylake.llm.toxicity import fold
from surveylake.llm.words import fitting_texts, pieces, split_words, sums_between

SAMPLE = 300
SAMPLE_ROWS = 6000
SAMPLE_BYTES = 128 << 20
MAX_LANGUAGES = 200
BUCKET_BITS = 13
GRAMS = (1, 2, 3, 4)
ROUNDS = 200
UNKNOWN = "und"
# Languages by family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
LETTER = r"\p{L}"


def family_of(language: str) -> str:
    base = language.lower().replace("_", "-").split("-")[0]
    return next((family for family, members in FAMILIES.items() if base in members), f"only {language}")


def frequencies(texts: pa.Array) -> np.ndarray:
    """Rows of n-gram frequencies, one per text."""
    words = split_words(texts)
    grams = WordGrams(words.vocabulary, GRAMS, BUCKET_BITS)
    rows = np.zeros((len(texts), 1 << BUCKET_BITS), dtype=np.float32)
    lists = []
    for buckets, counts in zip(grams.buckets, grams.counts):
        lists.append((buckets, counts, np.cumsum(counts) - counts))
    for i in range(len(texts)):
        codes = words.codes[words.bounds[i] : words.bounds[i + 1]]
        for buckets, counts, begins in lists:
            own = counts[codes]
            where = np.repeat(begins[codes] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            rows[i] += np.bincount(buckets[where], minlength=rows.shape[1])
        rows[i] /= max(1.0, rows[i].sum())
    return rows


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """A linear SVM (squared hinge loss, y of -1 and 1, classes weighted alike) by accelerated gradient descent."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    x = np.concatenate([x, np.ones((len(x), 1), dtype=np.float32)], axis=1)
    limit = 2 * float((weight[:, None] * x * x).sum()) + penalty
    w = ahead = np.zeros(x.shape[1])
    for i in range(rounds):
        short = np.maximum(0, 1 - y * (x @ ahead))
        gradient = penalty * ahead - 2 * x.T @ (weight * y * short)
        new = ahead - gradient / limit
        ahead, w = new + i / (i + 3) * (new - w), new
    return w[:-1].astype(np.float32), float(w[-1])


def fit(texts: pa.Array, languages: Sequence[str]) -> bytes:
    """All family and pair models, as bytes."""
    x, names = frequencies(texts), sorted(set(languages), key=lambda n: [ord(c) for c in n])
    labels = np.array([names.index(n) for n in languages])
    scale = 1 / (x.std(axis=0) + 1e-4)  # rare n-grams count as much as frequent ones
    centre = x.mean(axis=0)
    x = (x - centre) * scale / np.sqrt(x.shape[1])
    families = sorted({family_of(n) for n in names})
    member = np.array([families.index(family_of(n)) for n in names])
    pairs = [(a, b) for a, b in itertools.combinations(range(len(names)), 2) if member[a] == member[b]]
    models = []
    for f in range(len(families) if len(families) > 1 else 0):
        models.append(svm(x, np.where(member[labels] == f, 1.0, -1.0)))
    for a, b in pairs:
        own = (labels == a) | (labels == b)
        models.append(svm(x[own], np.where(labels[own] == a, 1.0, -1.0)))
    table = np.stack([w for w, _ in models], axis=1) if models else np.zeros((x.shape[1], 0), dtype=np.float32)
    bias = np.array([b for _, b in models])
    # Centre and scale are folded into the weights, so that frequencies are used as they are.
    table = table * (scale / np.sqrt(x.shape[1]))[:, None]
    bias = bias - centre @ table
    out = io.BytesIO()
    head = {"names": names, "families": families, "pairs": pairs}
    np.savez(out, table=table.astype(np.float32), bias=bias, head=np.array(json.dumps(head)))
    return out.getvalue()


class Predictor:
    def __init__(self, model: bytes):
        arrays = np.load(io.BytesIO(model))
        self.table, self.bias = arrays["table"], arrays["bias"]
        head = json.loads(str(arrays["head"]))
        self.names, self.families, self.pairs = head["names"], head["families"], head["pairs"]
        self.member = np.array([self.families.index(family_of(n)) for n in self.names])

    def margins(self, texts: pa.Array) -> np.ndarray:
        words = split_words(texts)
        grams = WordGrams(words.vocabulary, GRAMS, BUCKET_BITS)
        of_word = np.concatenate([grams.sums(self.table), grams.totals()[:, None].astype(np.float32)], axis=1)
        sums = sums_between(of_word[words.codes], words.bounds)
        return sums[:, :-1] / np.maximum(sums[:, -1:], 1) + self.bias

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        margins, n = self.margins(texts), len(texts)
        count = len(self.families) if len(self.families) > 1 else 0
        family = margins[:, :count].argmax(axis=1) if count else np.zeros(n, dtype=np.int64)
        sure = margins[np.arange(n), family] if count else np.full(n, 1.0)
        wins, sums = np.zeros((n, len(self.names))), np.zeros((n, len(self.names)))
        least = np.full((n, len(self.names)), np.inf)
        for i, (a, b) in enumerate(self.pairs):
            margin = margins[:, count + i]
            for side, value in ((a, margin), (b, -margin)):
                wins[:, side] += value > 0
                sums[:, side] += np.tanh(value)
                least[:, side] = np.minimum(least[:, side], value)
        rank = wins + sums / (4.0 * max(1, len(self.names)))
        rank[self.member[None, :] != family[:, None]] = -np.inf
        best = rank.argmax(axis=1)
        weakest = np.minimum(sure, least[np.arange(n), best])
        score = 1 / (1 + np.exp(-2 * np.clip(weakest, -20, 20)))
        lettered = pc.match_substring_regex(texts.fill_null(""), LETTER).to_numpy(zero_copy_only=False)
        names = [self.names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
        return names, np.where(lettered, score, 0.0)


def train(docs: DataFrame, sample: int = SAMPLE) -> bytes | None:
    """The models from documents of the learning folds, fitted in one task; None without any."""
    narrow = docs.select("doc_id", F.col("lang").alias("_lang")).filter("doc_id is not null and _lang is not null")
    learning = narrow.filter(fold(F.col("doc_id")) != 0)
    most = learning.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(MAX_LANGUAGES)
    languages = [row["_lang"] for row in most.collect()]
    learned = F.broadcast(docs.sparkSession.createDataFrame([(name,) for name in languages], "_lang string"))
    sample = min(sample, SAMPLE_ROWS // max(1, len(languages)))
    first = F.row_number().over(W.partitionBy("_lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = learning.join(learned, "_lang").distinct().withColumn("_n", first).filter(F.col("_n") <= sample).select("doc_id", "_lang")
    chosen = docs.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").filter("lang = _lang")
    texts = fitting_texts(chosen.filter(F.col("text").rlike(LETTER)), "lang", SAMPLE_BYTES // max(1, len(languages)))
    rows = texts.select(F.xxhash64("doc_id").alias("key"), "text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        received = [b for b in batches if b.num_rows]
        if received:
            table = pa.Table.from_batches(received).sort_by([("key", "ascending"), ("text", "ascending")]).combine_chunks()
            model = fit(table["text"].combine_chunks(), table["lang"].to_pylist())
            yield pa.RecordBatch.from_pydict({"model": [model]})

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(found[0].model) if found else None


def identify(docs: DataFrame, model: bytes | None) -> DataFrame:
    """`doc_id`, `lang_pred` and `score` of every row."""
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by buckets and languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(shared.value)
        for batch in batches:
            for piece in pieces(batch):
                names, scores = predictor.predict(piece.column(1))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
