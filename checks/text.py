"""Text preparation, scoring, reprocessing, training and object queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveylake.functions.expressions import EMAIL_PATTERN, NUMBER_PATTERN, has_pii, needs_translation, run_id
from surveylake.operators.calibration import calibrate, calibration_counts, calibration_table
from surveylake.operators.corrections import (
    BATCH_SIZE,
    RANDOM_SEED,
    apply_corrections,
    combine_corrections,
    consolidate_runs,
    correction_metrics,
    correction_summary,
    dashboard_trimmed,
    dashboard_union,
    low_confidence,
    reprocess_batches,
    reprocess_gate,
    write_batches,
)
from surveylake.operators.scoring import (
    FAMILY_TOPICS,
    TOPICS,
    assemble_predictions,
    confidence,
    score_topics,
    to_long,
    withhold_level3,
)
from surveylake.operators.text import clean_prep, model_family, scorable
from surveylake.operators.training import (
    SYNTHETIC_ALLOWED,
    classifier_metrics,
    cross_score,
    discover_topics,
    featurize,
    topic_training_rows,
    topic_word_counts,
    train_topics,
    training_gate,
    training_merge,
)
from surveylake.session import scratch_path
from surveylake.sinks.objects import copy_failures, copy_objects, copy_report
from surveylake.sources.objects import list_objects, prefix_counts

from .adapters import PREDICTIONS_SQL, RESPONSES_SQL, TEXTS_SQL, predictions, responses, table, texts
from .registry import query

# --- preparation ---------------------------------------------------------------------

# The fallback of a blank text is its source name.
CLEANED_SQL = f"""
cleaned AS (
  SELECT record_id, channel, source,
         trim(regexp_replace(coalesce(nullif(trim(text), ''), source), '[[:cntrl:]\\s]+', ' ', 'g'), ' ')
           AS customer_text_clean,
         coalesce(lower(trim(lang)) IN ('spanish', 'es'), false) AS needs_translation,
         regexp_matches(coalesce(nullif(trim(text), ''), source), '{EMAIL_PATTERN}|{NUMBER_PATTERN}')
           AS has_pii
  FROM texts)
"""


def cleaned(spark, folder, *metadata):
    """Cleaned texts with anything to score."""
    usable = scorable(texts(spark, folder), "text", "source")
    return clean_prep(usable, "record_id", "text", "source", "lang", metadata)


@query(
    "clean_prep",
    f"""WITH {TEXTS_SQL}, {CLEANED_SQL}
    SELECT record_id, customer_text_clean, has_pii, needs_translation FROM cleaned
    WHERE length(customer_text_clean) >= 1""",
)
def _clean_prep(spark, folder):
    return cleaned(spark, folder)


@query(
    "pii_flag",
    f"WITH {TEXTS_SQL}, {CLEANED_SQL} SELECT record_id, has_pii FROM cleaned",
)
def _pii_flag(spark, folder):
    return texts(spark, folder).select("record_id", has_pii(F.col("text")).alias("has_pii"))


@query(
    "language_routing",
    f"""WITH {TEXTS_SQL}, {CLEANED_SQL}
    SELECT channel, needs_translation, count(*) AS texts FROM cleaned GROUP BY ALL""",
)
def _language_routing(spark, folder):
    routed = texts(spark, folder).select("channel", needs_translation(F.col("lang")).alias("needs_translation"))
    return routed.groupBy("channel", "needs_translation").agg(F.count(F.lit(1)).alias("texts"))


@query(
    "run_id",
    f"""WITH {RESPONSES_SQL}
    SELECT DISTINCT channel || '-inference-' || strftime(event_ts, '%Y-%m-%d-%H-%M-%S') AS run_id FROM responses""",
)
def _run_id(spark, folder):
    r = responses(spark, folder)
    return r.select(run_id(F.col("channel"), F.col("event_ts")).alias("run_id")).distinct()


@query(
    "model_routing",
    f"""WITH {RESPONSES_SQL}
    SELECT contact_record_id, channel,
           CASE WHEN channel IN ('sms_transactional', 'sms_relational') THEN 'sms_web' ELSE 'default' END AS model_family
    FROM responses""",
)
def _model_routing(spark, folder):
    r = responses(spark, folder)
    return r.select("contact_record_id", "channel", model_family(F.col("channel")).alias("model_family"))


# --- predictions and corrections --------------------------------------------------------

CONFIDENCES = [confidence(t) for t in TOPICS]
LOW_SQL = " OR ".join(f"{c} < 0.5" for c in CONFIDENCES)
LOW_CTE = f"""WITH {RESPONSES_SQL}, {PREDICTIONS_SQL},
low AS (SELECT * FROM predictions WHERE ({LOW_SQL})
        AND record_id NOT IN (SELECT contact_record_id FROM responses WHERE campaign = 'Other'))"""


def low(spark, folder):
    p = predictions(spark, folder)
    return low_confidence(p, p.filter(F.col("campaign") == "Other"))


@query(
    "assemble_predictions",
    f"WITH {RESPONSES_SQL}, {PREDICTIONS_SQL} SELECT * FROM predictions",
)
def _assemble_predictions(spark, folder):
    p = predictions(spark, folder)
    return assemble_predictions(p.select("record_id", "channel", "campaign"), to_long(p))


@query(
    "level3_threshold",
    f"""WITH {RESPONSES_SQL}, {PREDICTIONS_SQL}
    SELECT record_id, CASE WHEN level3_subcategory_confidence >= 0.75 THEN level3_subcategory END AS level3_subcategory
    FROM predictions""",
)
def _level3_threshold(spark, folder):
    return withhold_level3(predictions(spark, folder)).select("record_id", "level3_subcategory")


@query(
    "low_confidence",
    f"""{LOW_CTE} SELECT record_id, channel,
    array_to_string(list_filter([{", ".join(f"CASE WHEN {confidence(t)} < 0.5 THEN '{t}' END" for t in TOPICS)}],
                                lambda x: x IS NOT NULL), ',') AS low_topics FROM low""",
)
def _low_confidence(spark, folder):
    return low(spark, folder).select("record_id", "channel", F.array_join("low_topics", ",").alias("low_topics"))


BATCHES_CTE = f"""{LOW_CTE},
batches AS (
  SELECT *, CAST((row_number() OVER (ORDER BY md5(record_id || '{RANDOM_SEED}'), record_id) - 1) // {BATCH_SIZE}
                 AS BIGINT) AS batch_index
  FROM low)"""


@query("reprocess_batches", f"{BATCHES_CTE} SELECT record_id, batch_index FROM batches")
def _reprocess_batches(spark, folder):
    """Written as JSON lines and read back."""
    root = scratch_path(spark, "batches")
    write_batches(reprocess_batches(low(spark, folder)).select("record_id", "batch_index", "low_topics"), root)
    return spark.read.schema("record_id bigint, batch_index bigint").json(root).select("record_id", "batch_index")


# Two outputs for a low record: one for every topic, and a later one for some topics of the web channels.
OUTPUTS_SQL = f"""
outputs AS (
  SELECT record_id, 0 AS batch_index, {", ".join(f"upper({t}) AS {t}" for t in TOPICS)} FROM low
  UNION ALL
  SELECT record_id, 1, 'second', level2_category, NULL, NULL, 'true', NULL FROM low WHERE channel LIKE 'api%'),
corrections AS (
  SELECT record_id, {", ".join(TOPICS)} FROM outputs
  QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY batch_index DESC) = 1)
"""


def outputs(spark, folder):
    """Both outputs of a record come out of one reading of it."""
    none, api = F.lit(None).cast("string"), F.col("channel").startswith("api")
    first = F.struct(F.lit(0).alias("batch_index"), *[F.upper(t).alias(t) for t in TOPICS])
    second = (F.lit("second"), F.col("level2_category"), none, none, F.lit("true"), none)
    later = F.struct(F.lit(1).alias("batch_index"), *[value.alias(t) for value, t in zip(second, TOPICS)])
    both = F.when(api, F.array(first, later)).otherwise(F.array(first))
    return low(spark, folder).select("record_id", F.inline(both))


@query("combine_corrections", f"{LOW_CTE}, {OUTPUTS_SQL} SELECT * FROM corrections")
def _combine_corrections(spark, folder):
    return combine_corrections(outputs(spark, folder))


OVERLAY_SQL = f"""
overlay AS (
  SELECT p.record_id, p.channel, p.campaign,
         {", ".join(f"coalesce(c.{t}, p.{t}) AS {t}, p.{confidence(t)}" for t in TOPICS)}
  FROM predictions p LEFT JOIN corrections c ON p.record_id = c.record_id)
"""


def overlay(spark, folder):
    return apply_corrections(predictions(spark, folder), combine_corrections(outputs(spark, folder)))


@query("apply_corrections", f"{LOW_CTE}, {OUTPUTS_SQL}, {OVERLAY_SQL} SELECT * FROM overlay")
def _apply_corrections(spark, folder):
    return overlay(spark, folder)


@query(
    "correction_metrics",
    f"{LOW_CTE}, {OUTPUTS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{t}' AS topic, count(c.{t}) AS corrected,
        count(*) FILTER (WHERE c.{t} IS NOT NULL AND c.{t} IS DISTINCT FROM p.{t}) AS changed
        FROM predictions p JOIN corrections c USING (record_id)"""
        for t in TOPICS
    ),
)
def _correction_metrics(spark, folder):
    return correction_metrics(predictions(spark, folder), combine_corrections(outputs(spark, folder)))


@query(
    "dashboard_trimmed",
    f"{LOW_CTE}, {OUTPUTS_SQL}, {OVERLAY_SQL} SELECT record_id, channel, {', '.join(TOPICS)} FROM overlay",
)
def _dashboard_trimmed(spark, folder):
    return dashboard_trimmed(overlay(spark, folder), ["channel"])


SOURCES = ("ivr", "sms_relational", "sms_transactional")


@query(
    "dashboard_union",
    f"""WITH {RESPONSES_SQL}, {PREDICTIONS_SQL}
    SELECT record_id, {", ".join(TOPICS)}, channel AS source_system,
           CASE WHEN channel = 'ivr' THEN campaign END AS campaign
    FROM predictions WHERE channel IN {SOURCES}""",
)
def _dashboard_union(spark, folder):
    """The three dashboard sources; only the ivr table has a campaign column."""
    p = predictions(spark, folder)

    def source(name):
        return dashboard_trimmed(p.filter(F.col("channel") == name), ["campaign"] if name == "ivr" else [])

    return dashboard_union({name: source(name) for name in SOURCES})


# --- training -----------------------------------------------------------------------------

# Base rows are all labelled texts, the toxic ones marked synthetic; the low-quality ones come back corrected.
TRAINING_SQL = f"""
base AS (SELECT record_id, text, {", ".join(TOPICS)}, is_urgent = 'true' AS is_synthetic FROM texts WHERE labelled),
corrected AS (SELECT record_id, text, {", ".join(t if t != "is_urgent" else "'false' AS is_urgent" for t in TOPICS)},
                     false AS is_synthetic FROM texts WHERE labelled AND is_actionable = 'false'),
merged AS (SELECT * FROM (SELECT * FROM base WHERE record_id NOT IN (SELECT record_id FROM corrected)
                          UNION ALL SELECT * FROM corrected) WHERE length(trim(text, ' ')) >= 3)
"""


def training_parts(spark, folder):
    labelled = texts(spark, folder).filter("labelled").select("record_id", "text", *TOPICS)
    base = labelled.withColumn("is_synthetic", F.col("is_urgent") == "true")
    wrong = labelled.filter(F.col("is_actionable") == "false")
    corrected = wrong.withColumns({"is_urgent": F.lit("false"), "is_synthetic": F.lit(False)})
    return base, corrected


@query("training_merge", f"WITH {TEXTS_SQL}, {TRAINING_SQL} SELECT * FROM merged")
def _training_merge(spark, folder):
    return training_merge(*training_parts(spark, folder))


@query(
    "topic_training_rows",
    f"WITH {TEXTS_SQL}, {TRAINING_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS topic, {t} AS label, count(*) AS rows FROM merged"
        + ("" if SYNTHETIC_ALLOWED[t] else " WHERE NOT is_synthetic")
        + f" GROUP BY {t} HAVING {t} IS NOT NULL"
        for t in TOPICS
    ),
)
def _topic_training_rows(spark, folder):
    rows = topic_training_rows(training_merge(*training_parts(spark, folder)))
    return rows.groupBy("topic", "label").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "training_gate",
    f"""WITH {TEXTS_SQL}, {TRAINING_SQL}, n AS (SELECT count(*) AS current_record_count FROM corrected)
    SELECT current_record_count, 10::BIGINT AS last_trained_record_count,
           current_record_count - 10 AS new_records_since_training,
           current_record_count - 10 >= 100 AS should_train,
           CASE WHEN current_record_count - 10 >= 100 THEN 'CONTINUE' ELSE 'SKIP' END AS instruction FROM n""",
)
def _training_gate(spark, folder):
    return training_gate(training_parts(spark, folder)[1], last_trained_count=10)


def _featured(spark, folder):
    """Cleaned texts with features and known labels, written once for all fits."""
    root = scratch_path(spark, "features")
    prepared = cleaned(spark, folder, "channel", *TOPICS).withColumn("model_family", model_family(F.col("channel")))
    featurize(prepared).drop("customer_text_clean").write.parquet(root)
    return spark.read.parquet(root)


def _scored(spark, folder):
    featured = _featured(spark, folder)
    models = train_topics(featured, scratch_path(spark, "models"))
    renamed = featured.withColumnsRenamed({t: f"true_{t}" for t in TOPICS})
    return score_topics(renamed, models), models


@query("train_topics")
def _train_topics(spark, folder):
    """One row per trained model: classes and features."""
    models = train_topics(_featured(spark, folder), scratch_path(spark, "models"))
    rows = [(key, len(labels), model.numFeatures) for key, (model, labels) in models.items()]
    return spark.createDataFrame(rows, "model string, classes int, features int")


@query("score_topics")
def _score_topics(spark, folder):
    scored, _ = _scored(spark, folder)
    return withhold_level3(scored).select("record_id", *TOPICS, *[F.round(c, 4).alias(c) for c in CONFIDENCES])


@query("score_sentiment")
def _score_sentiment(spark, folder):
    featured = _featured(spark, folder)
    models = train_topics(featured, scratch_path(spark, "models"), ["overall_sentiment"])
    scored = score_topics(featured.drop("overall_sentiment"), models)
    return scored.select(
        "record_id", "overall_sentiment", F.round("overall_sentiment_confidence", 4).alias("confidence")
    )


@query("classifier_metrics")
def _classifier_metrics(spark, folder):
    return classifier_metrics(_scored(spark, folder)[0])


@query(
    "classifier_metrics_counts",
    f"""WITH {RESPONSES_SQL}, {PREDICTIONS_SQL},
    pairs AS ({" UNION ALL ".join(
        f"SELECT '{t}' AS topic, {t} AS predicted, CASE WHEN {confidence(t)} < 0.5 THEN '{t}_0' ELSE {t} END AS actual"
        f" FROM predictions" for t in TOPICS)}),
    s AS (SELECT topic, actual AS label, count(*) AS support, count(*) FILTER (WHERE actual = predicted) AS correct
          FROM pairs GROUP BY ALL),
    p AS (SELECT topic, predicted AS label, count(*) AS predicted_rows FROM pairs GROUP BY ALL)
    SELECT topic, label, coalesce(support, 0) AS support, coalesce(predicted_rows, 0) AS predicted_rows,
           coalesce(correct, 0) AS correct, round(coalesce(correct, 0) / nullif(predicted_rows, 0), 6) AS precision,
           round(correct / nullif(support, 0), 6) AS recall
    FROM s FULL JOIN p USING (topic, label)""",
)
def _classifier_metrics_counts(spark, folder):
    """The metrics over the fixed predictions; the true label is the predicted one where confidence is high."""
    p = predictions(spark, folder)
    truth = {f"true_{t}": F.when(F.col(confidence(t)) < 0.5, f"{t}_0").otherwise(F.col(t)) for t in TOPICS}
    metrics = classifier_metrics(p.withColumns(truth))
    return metrics.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


FOLD_TOPICS = ("overall_sentiment", "is_urgent")


@query(
    "out_of_fold_support",
    f"""WITH {TEXTS_SQL}, {CLEANED_SQL},
    parted AS (SELECT t.*, CAST(('0x' || substr(md5(t.record_id || '/{RANDOM_SEED}'), 1, 8))::BIGINT % 3 AS INTEGER) AS fold
               FROM texts t JOIN cleaned c USING (record_id) WHERE length(customer_text_clean) >= 1),
    pairs AS ({" UNION ALL ".join(f"SELECT fold, '{t}' AS topic, {t} AS label FROM parted" for t in FOLD_TOPICS)})
    SELECT fold, topic, label, count(*) AS support, count(*) AS measured FROM pairs WHERE label IS NOT NULL GROUP BY ALL""",
)
def _out_of_fold_support(spark, folder):
    """Per part, topic and label: labelled rows, and those that a model of the other parts has predicted."""
    scored = cross_score(_featured(spark, folder), scratch_path(spark, "folds"), FOLD_TOPICS, folds=3)
    cells = [F.struct(F.lit(t).alias("topic"), F.col(f"true_{t}").alias("label"), F.col(t).alias("p")) for t in FOLD_TOPICS]
    rows = scored.select("fold", F.inline(F.array(*cells))).filter(F.col("label").isNotNull())
    return rows.groupBy("fold", "topic", "label").agg(F.count(F.lit(1)).alias("support"), F.count("p").alias("measured"))


# Predictions are right with a chance that follows their confidence, by a digest of its own.
CALIBRATION_CTE = f"""WITH {RESPONSES_SQL}, {PREDICTIONS_SQL},
judged AS ({" UNION ALL ".join(
    f"SELECT '{t}' AS topic, CASE WHEN {t in FAMILY_TOPICS} AND channel IN ('sms_transactional', 'sms_relational')"
    f" THEN 'sms_web' ELSE 'default' END AS model_family, CAST(floor({confidence(t)} * 100) AS INTEGER) AS bin,"
    f" CAST('0x' || substr(md5(record_id || '{t}/right'), 1, 6) AS BIGINT) % 1001 < 1000 * {confidence(t)} AS is_right"
    f" FROM predictions" for t in TOPICS)}),
counts AS (SELECT topic, model_family, bin, count(*) AS rows, count(*) FILTER (WHERE is_right) AS correct FROM judged GROUP BY ALL),
running AS (SELECT *, sum(rows) OVER w AS all_rows, sum(correct) OVER w AS all_correct FROM counts
            WINDOW w AS (PARTITION BY topic, model_family ORDER BY bin)),
shares AS (
  SELECT a.topic, a.model_family, a.bin AS low, b.bin AS high,
         (b.all_correct - a.all_correct + a.correct)::DOUBLE / (b.all_rows - a.all_rows + a.rows)::DOUBLE AS share
  FROM running a JOIN running b ON a.topic = b.topic AND a.model_family = b.model_family AND a.bin <= b.bin),
lows AS (
  SELECT c.topic, c.model_family, c.bin, s.low, min(s.share) AS least
  FROM counts c JOIN shares s ON c.topic = s.topic AND c.model_family = s.model_family AND s.low <= c.bin AND s.high >= c.bin
  GROUP BY ALL),
fitted AS (SELECT topic, model_family, bin, max(least) AS calibrated FROM lows GROUP BY ALL),
grid AS (SELECT topic, model_family, CAST(b AS INTEGER) AS bin FROM (SELECT DISTINCT topic, model_family FROM counts), range(101) AS r(b)),
calibration AS (
  SELECT g.*, coalesce(c.rows, 0) AS rows, coalesce(c.correct, 0) AS correct,
         coalesce((SELECT max_by(f.calibrated, f.bin) FROM fitted f
                   WHERE f.topic = g.topic AND f.model_family = g.model_family AND f.bin <= g.bin),
                  (SELECT min_by(f.calibrated, f.bin) FROM fitted f
                   WHERE f.topic = g.topic AND f.model_family = g.model_family)) AS calibrated
  FROM grid g LEFT JOIN counts c USING (topic, model_family, bin))"""


def _judged(spark, folder):
    p = predictions(spark, folder).withColumn("model_family", model_family(F.col("channel")))
    truth = {}
    for t in TOPICS:
        digest = F.md5(F.concat(F.col("record_id").cast("string"), F.lit(f"{t}/right")))
        drawn = F.conv(F.substring(digest, 1, 6), 16, 10).cast("bigint") % 1001
        truth[f"true_{t}"] = F.when(drawn < 1000 * F.col(confidence(t)), F.col(t)).otherwise(F.lit("another"))
    return p.withColumns(truth)


@query("calibration_table", f"{CALIBRATION_CTE} SELECT * FROM calibration")
def _calibration_table(spark, folder):
    """The pooled fit against the largest of the least mean shares, which defines it."""
    return calibration_table(calibration_counts(_judged(spark, folder)))


@query(
    "calibrated_low_confidence",
    f"""{CALIBRATION_CTE} SELECT record_id, {", ".join(
        f"(SELECT c.calibrated FROM calibration c WHERE c.topic = '{t}' AND c.bin = CAST(floor({confidence(t)} * 100) AS INTEGER)"
        f" AND c.model_family = CASE WHEN {t in FAMILY_TOPICS} AND channel IN ('sms_transactional', 'sms_relational')"
        f" THEN 'sms_web' ELSE 'default' END) AS {confidence(t)}" for t in TOPICS)}
    FROM predictions WHERE least({", ".join(
        f"(SELECT c.calibrated FROM calibration c WHERE c.topic = '{t}' AND c.bin = CAST(floor({confidence(t)} * 100) AS INTEGER)"
        f" AND c.model_family = CASE WHEN {t in FAMILY_TOPICS} AND channel IN ('sms_transactional', 'sms_relational')"
        f" THEN 'sms_web' ELSE 'default' END)" for t in TOPICS)}) < 0.5""",
)
def _calibrated_low_confidence(spark, folder):
    """The records under a threshold once confidences are chances of being right."""
    judged = _judged(spark, folder)
    table_path = scratch_path(spark, "calibration")
    calibration_table(calibration_counts(judged)).write.parquet(table_path)
    calibrated = calibrate(judged, spark.read.parquet(table_path))
    return low_confidence(calibrated).select("record_id", *CONFIDENCES)


@query(
    "topic_word_counts",
    f"""WITH {TEXTS_SQL}, {CLEANED_SQL},
    parts AS (SELECT record_id, unnest(regexp_extract_all(lower(customer_text_clean), '[\\p{{L}}\\p{{N}}]+')) AS term
              FROM cleaned WHERE length(customer_text_clean) >= 1)
    SELECT term, count(*) AS occurrences, count(DISTINCT record_id) AS texts FROM parts GROUP BY term""",
)
def _topic_word_counts(spark, folder):
    return topic_word_counts(cleaned(spark, folder)).select("term", "occurrences", "texts")


@query("discover_topics")
def _discover_topics(spark, folder):
    return discover_topics(cleaned(spark, folder).select("customer_text_clean"))


# --- objects ------------------------------------------------------------------------------


def _inventory(spark, folder):
    """The table files, listed as one prefix below the parent folder."""
    root, _, name = folder.rstrip("/").rpartition("/")
    return root, list_objects(spark, f"file://{root}", [name], partitions=4)


@query("file_inventory")
def _file_inventory(spark, folder):
    return _inventory(spark, folder)[1].select("path", "length")


@query("file_prefix_counts")
def _file_prefix_counts(spark, folder):
    return prefix_counts(_inventory(spark, folder)[1])


def _copied(spark, folder):
    """Copy all table files and write the outcome once."""
    root, inventory = _inventory(spark, folder)
    target = scratch_path(spark, "copy").removeprefix("file:")
    copy_objects(inventory, f"file://{root}", f"file://{target}", partitions=8).write.parquet(f"{target}-results")
    return spark.read.parquet(f"{target}-results"), target


@query("file_copy", "SELECT * FROM orders")
def _file_copy(spark, folder):
    """The copied orders file, read back from the target."""
    _, target = _copied(spark, folder)
    name = folder.rstrip("/").rpartition("/")[2]
    return spark.read.parquet(f"{target}/{name}/orders.parquet")


@query("copy_report")
def _copy_report(spark, folder):
    results, _ = _copied(spark, folder)
    failures = copy_failures(results).agg(F.count(F.lit(1))).scalar()
    return copy_report(results).withColumn("reported_failures", failures)


# --- reprocessing reports -----------------------------------------------------------------


@query(
    "reprocess_gate",
    f"""{LOW_CTE} SELECT count(*) AS total_low_confidence_records,
    CAST(ceil(count(*) / {BATCH_SIZE}) AS BIGINT) AS batch_count, count(*) > 0 AS run FROM low""",
)
def _reprocess_gate(spark, folder):
    return reprocess_gate(low(spark, folder))


@query(
    "correction_summary",
    f"""{LOW_CTE}, {OUTPUTS_SQL},
    joined AS (SELECT c.record_id IS NOT NULL AS corrected,
                      {", ".join(f"c.{t} IS NOT NULL AND c.{t} IS DISTINCT FROM p.{t} AS {t}" for t in TOPICS)}
               FROM predictions p LEFT JOIN corrections c USING (record_id)),
    names AS (SELECT list_filter([{", ".join(f"CASE WHEN bool_or({t}) THEN '{t}' END" for t in TOPICS)}],
                                 lambda x: x IS NOT NULL) AS n FROM joined)
    SELECT count(*) AS all_columns_rows, count(*) FILTER (WHERE corrected) AS corrected_rows,
           count(*) FILTER (WHERE {" OR ".join(TOPICS)}) AS records_replaced,
           CAST(len(any_value(n)) AS INTEGER) AS updated_column_count,
           array_to_string(any_value(n), ',') AS updated_columns
    FROM joined, names""",
)
def _correction_summary(spark, folder):
    return correction_summary(predictions(spark, folder), combine_corrections(outputs(spark, folder)))


@query(
    "consolidate_runs",
    f"""{LOW_CTE}, {OUTPUTS_SQL},
    runs AS (SELECT record_id, {", ".join(TOPICS)}, 'run-1' AS run_id FROM predictions
             UNION ALL SELECT record_id, {", ".join(TOPICS)}, 'run-2' FROM corrections)
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY run_id DESC) = 1""",
)
def _consolidate_runs(spark, folder):
    """The first run covers every record, the second those that were corrected."""
    first = dashboard_trimmed(predictions(spark, folder)).withColumn("run_id", F.lit("run-1"))
    second = combine_corrections(outputs(spark, folder)).withColumn("run_id", F.lit("run-2"))
    return consolidate_runs(first.unionByName(second))
