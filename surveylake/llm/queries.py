"""The operators of this package as queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm import (
    chat,
    decontamination,
    importance,
    language,
    mixing,
    neighbours,
    phrases,
    pii,
    quality,
    sharding,
    simhash,
    token_blocks,
    toxicity,
)
from surveylake.llm.words import stored
from surveylake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
ARROW_BATCH_BYTES = 16 << 20

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(bounded_batches(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Batches sent to Python are cut by bytes too, since a row may hold a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed, slot_map = sharding.shard_documents(docs, scratch_path(spark, "slot-map"), SHARDS)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    narrow = placed.select("doc_id", "size", crc.alias("text_crc32"), "virtual_slot", "shard", "map_version")
    return sharding.position(narrow, slot_map, ["doc_id", "text_crc32", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = mixing.sizes_of(docs, F.array("source"), keep=["doc_id", "source"])
    mix = mixing.plan_mix(sized)
    per_source = mixing.small_table(
        spark,
        [(name, size, target) for name, (size, target) in mix.sources.items()],
        "source string, source_size long, target double",
    ).withColumnRenamed("source", "_source")
    rows = mix.selection.copies(sized)
    return rows.join(per_source, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("_copies")).cast("long").alias("taken"), "source"
    )


EXTRA_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]

OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), parts AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS n,
    length(regexp_replace(coalesce(role, ''), '([<\[\\])', '\1\\', 'g'))
      + length(regexp_replace(coalesce(text, ''), '([<\[\\])', '\1\\', 'g'))
      + length('<|turn|><|text|><|end|>') AS chars,
    count(*) OVER (PARTITION BY conv_id) AS turns
  FROM turns
), prefixes AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS prefix FROM parts
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(prefix) FILTER (role = 'assistant' OR n = turns))::BIGINT AS formatted_chars
FROM prefixes GROUP BY conv_id
"""


@query("op4_chat", OP4_SQL)
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat.digest(stored(chat.examples(turns.unionByName(extra)), "chat-examples"))


OP5_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents
), doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM doc_words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0
), item_words AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark
), item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM item_words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0
), sized AS (
  SELECT *, count(*) OVER (PARTITION BY item_id) AS item_shingles FROM item_shingles
)
SELECT doc_id, item_id, max(item_shingles)::BIGINT AS item_shingles, count(*) AS matched,
  count(*) / max(item_shingles)::DOUBLE AS containment
FROM doc_shingles JOIN sized USING (shingle)
GROUP BY doc_id, item_id HAVING count(*) / max(item_shingles)::DOUBLE >= 0.8
"""


@query("op5_decontamination", OP5_SQL)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = stored(decontamination.item_index(table(spark, sf_dir, "benchmark")), "benchmark-index")
    return decontamination.find_items(table(spark, sf_dir, "documents"), index)


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.write_ledger(table(spark, sf_dir, "documents"), scratch_path(spark, "quality-ledger"))
    base = quality.failed(F.col("bits"), quality.BASE)
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~quality.failed(F.col("bits"), quality.POLICIES[quality.CURRENT])).alias("kept"),
        "bits",
    )


@query("quality_ablation")
def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every rule of every policy rejects, alone or with others; from the stored ledger, the texts are read once."""
    ledger = quality.write_ledger(table(spark, sf_dir, "documents"), scratch_path(spark, "quality-ledger"))
    parts = [quality.ablation(ledger, rules).select(F.lit(v).alias("policy"), "*") for v, rules in quality.POLICIES.items()]
    return reduce(DataFrame.unionByName, parts)


def word_vocabulary() -> str:
    """The vocabulary file's place on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op7_token_blocks")
def op7_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-blocks")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    token_blocks.write_blocks(table(spark, sf_dir, "documents"), path, word_vocabulary, shards)
    return token_blocks.read_documents(token_blocks.read_blocks(spark, path))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs)).select(
        "doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score"
    )


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.fit(pii.labelled_table())
    return pii.find_personal_data(table(spark, sf_dir, "documents"), field)


@query("op11_neighbours")
def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = rows.filter(F.pmod("vec_id", F.lit(neighbours.QUERY_STEP)) == 0)
    return neighbours.nearest(rows, asked)


# DuckDB has no CRC-32, so its table is made by the rule of the polynomial and run over each distinct word's bytes.
OP12_SQL = r"""
WITH crc_step AS (
  SELECT i::BIGINT AS i, list_reduce([i::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
  FROM range(256) AS r(i)
), crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM crc_step
), source_words AS (
  SELECT doc_id, row_number() OVER () AS row_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), target_words AS (
  SELECT regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), used AS (
  SELECT row_id, unnest(w) AS word FROM source_words
), aimed AS (
  SELECT unnest(w) AS word FROM target_words
), vocabulary AS (
  SELECT DISTINCT word FROM (SELECT word FROM used UNION ALL SELECT word FROM aimed)
), hashed AS (
  SELECT word, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(1, strlen(word) + 1),
      lambda b: ('0x' || hex(word)[2 * b - 1:2 * b])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM vocabulary, crc_table
), s AS (
  SELECT bucket, count(*) AS s FROM used JOIN hashed USING (word) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS t FROM aimed JOIN hashed USING (word) GROUP BY bucket
), totals AS (
  SELECT (SELECT count(*) FROM used)::DOUBLE AS all_s, (SELECT count(*) FROM aimed)::DOUBLE AS all_t
), gain AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)
    / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), totals
), summed AS (
  SELECT row_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM used JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY row_id
), scored AS (
  SELECT doc_id, row_id, coalesce(len(w), 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))))::BIGINT AS score
  FROM source_words LEFT JOIN summed USING (row_id)
), ranked AS (
  SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (row_id)
"""


@query("op12_importance", OP12_SQL)
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, target).select("doc.doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM texts
), totals AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang
), runs AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM pieces, range(1, 6) AS sizes(k), unnest(range(1, len(w) - k + 2)) AS places(i)
), f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS f, string_split(phrase, ' ') AS w
  FROM runs GROUP BY lang, k, phrase HAVING count(*) >= 100
), covering AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(f) AS longer
  FROM f, range(2, 5) AS inner_sizes(size), unnest(range(1, k - size + 2)) AS places(i)
  WHERE k > size GROUP BY ALL
), candidates AS (
  SELECT f.* FROM f LEFT JOIN covering USING (lang, phrase) WHERE k >= 2 AND (longer IS NULL OR 100 * longer < 100 * f)
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, z.n, cut, (1000 * c.f * z.n) // (x.f * y.f) AS score
  FROM candidates AS c, unnest(range(1, k)) AS split_places(cut)
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')
  JOIN totals AS z ON z.lang = c.lang
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS choice FROM cuts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE choice = 1
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


@query("op13_phrases", OP13_SQL)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(table(spark, sf_dir, "documents"))
    return found.withColumn("rank", F.col("rank").cast("long"))
