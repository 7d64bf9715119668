"""The test tables seen as the operators' inputs, in Spark and in SQL.

Each adapter uses its whole table. The SQL text beside it defines the same
relation for the comparison.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.channels import CHANNEL_NAMES, Channel, channel_specs
from surveylake.operators.scoring import TOPICS, confidence

AS_OF = date(2001, 8, 15)      # orders run from 1995 to this month
RUN_DATE = date(2024, 2, 1)    # events cover January 2024
SPECS = channel_specs()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- responses over events -------------------------------------------------------

RESPONSES_SQL = """
responses AS (
  SELECT event_id AS contact_record_id,
         CAST(user_id AS VARCHAR) AS cas_account_number,
         date_trunc('day', ts) AS event_ts,
         CAST(ts AS DATE) AS response_received_date,
         CAST(date_trunc('week', ts) AS DATE) AS event_date,
         event_type AS intent,
         event_type AS survey_name,
         CAST(event_id % 2 AS VARCHAR) AS survey_id,
         'C' AS case_type,
         CAST(NULL AS TIMESTAMP) AS queue_time,
         CASE WHEN (event_id // 5) % 10 = 0 THEN NULL
              WHEN (event_id // 5) % 10 IN (1, 2) THEN 'Other' ELSE 'Main' END AS campaign,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS comment,
         CASE event_id % 5 WHEN 0 THEN 'ivr' WHEN 1 THEN 'sms_transactional' WHEN 2 THEN 'sms_relational'
                           WHEN 3 THEN 'api_transactional' ELSE 'api_relational' END AS channel,
         CAST(value AS VARCHAR) AS q1,
         CAST((event_id // 5) % 5 + 1 AS VARCHAR) AS q2,
         CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id % 10 AS VARCHAR) END AS q3
  FROM events)
"""


def responses(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_id")
    k = F.expr("(event_id div 5) % 10")
    channel = F.array(*[F.lit(c) for c in CHANNEL_NAMES])
    return table(spark, folder, "events").select(
        event.alias("contact_record_id"),
        F.col("user_id").cast("string").alias("cas_account_number"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("event_ts"),
        F.col("ts").cast("date").alias("response_received_date"),
        F.date_trunc("week", "ts").cast("date").alias("event_date"),
        F.col("event_type").alias("intent"),
        F.col("event_type").alias("survey_name"),
        (event % 2).cast("string").alias("survey_id"),
        F.lit("C").alias("case_type"),
        F.lit(None).cast("timestamp_ntz").alias("queue_time"),
        F.when(k == 0, F.lit(None)).when(k.isin(1, 2), "Other").otherwise("Main").alias("campaign"),
        F.when(event % 3 != 0, F.col("props")).alias("comment"),
        F.element_at(channel, (event % 5 + 1).cast("int")).alias("channel"),
        F.col("value").cast("string").alias("q1"),
        F.expr("(event_id div 5) % 5 + 1").cast("string").alias("q2"),
        F.when(event % 7 == 0, "n/a").otherwise((event % 10).cast("string")).alias("q3"),
    )


IDENTITY = (
    "event_date",
    "contact_record_id",
    "cas_account_number",
    "response_received_date",
    "event_ts",
    "queue_time",
    "survey_id",
    "survey_name",
    "case_type",
    "intent",
)


def channel_raw(spark: SparkSession, folder: str, channel: Channel) -> DataFrame:
    return _as_channel(responses(spark, folder), channel)


def _as_channel(r: DataFrame, channel: Channel) -> DataFrame:
    """One channel's responses under the channel's own column names.

    The survey-language comment is filled on half of the rows, the plain one on
    all, so both branches of the coalesce are taken.
    """
    r = r.filter(F.col("channel") == channel.name)
    in_language, plain = channel.comment_columns
    columns = {s.source: F.col(f"q{i}") for i, s in enumerate(channel.scores, start=1)}
    columns |= {raw: F.col("intent") for _, raw in channel.text_questions}
    columns[in_language] = F.when(F.col("survey_id") == "0", F.col("comment"))
    columns[plain] = F.col("comment")
    if channel.campaign_filter:
        columns["campaign"] = F.col("campaign")
    return r.select(*IDENTITY, *[c.alias(name) for name, c in columns.items()])


def raw_channels(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    r = responses(spark, folder)
    return {name: _as_channel(r, spec) for name, spec in SPECS.items()}


# The lookup derives from the event types present: "signup" has no entry, "error"
# has a NULL target, "view" two candidates, "click" an untrimmed upper-case key.
INTENT_MAP_SQL = """
intent_map AS (
  SELECT DISTINCT CASE WHEN event_type = 'click' THEN ' Click ' ELSE event_type END AS old_intent,
         CASE event_type WHEN 'error' THEN NULL WHEN 'purchase' THEN 'Payment' ELSE 'Navigation' END AS new_intent
  FROM events WHERE event_type <> 'signup'
  UNION ALL
  SELECT DISTINCT upper(event_type), 'Web ' || event_type FROM events WHERE event_type = 'view'),
clean_map AS (
  SELECT regexp_replace(lower(trim(old_intent)), '\\s+', ' ', 'g') AS intent_key,
         min(lower(trim(new_intent))) AS mapped
  FROM intent_map GROUP BY 1)
"""


def intent_map(spark: SparkSession, folder: str) -> DataFrame:
    kinds = table(spark, folder, "events").select("event_type").distinct()
    kind = F.col("event_type")
    first = kinds.filter(kind != "signup").select(
        F.when(kind == "click", " Click ").otherwise(kind).alias("old_intent"),
        F.when(kind == "error", F.lit(None)).when(kind == "purchase", "Payment").otherwise("Navigation").alias("new_intent"),
    )
    second = kinds.filter(kind == "view").select(F.upper(kind), F.concat(F.lit("Web "), kind))
    return first.union(second)


MAPPED_SQL = """
mapped AS (
  SELECT r.* REPLACE (coalesce(m.mapped, r.intent) AS intent), m.mapped AS mapped_intent
  FROM responses r LEFT JOIN clean_map m
    ON regexp_replace(lower(trim(r.intent)), '\\s+', ' ', 'g') = m.intent_key)
"""

# --- history over orders ----------------------------------------------------------

ORDERS_SQL = """
history AS (
  SELECT CAST(o_orderdate AS DATE) AS event_date,
         o_orderkey AS contact_record_id,
         CAST(o_custkey AS VARCHAR) AS cas_account_number,
         CASE o_orderkey % 5 WHEN 0 THEN 'ivr' WHEN 1 THEN 'sms_transactional' WHEN 2 THEN 'sms_relational'
                             WHEN 3 THEN 'api_transactional' ELSE 'api_relational' END AS channel,
         TRY_CAST(nullif(regexp_extract(o_orderpriority, '^(\\d+)', 1), '') AS DOUBLE) AS q1,
         o_totalprice AS q2,
         CAST(o_orderkey % 10 AS DOUBLE) AS q3
  FROM orders)
"""


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Stored responses over seven years; the scores come through the api relational rule."""
    from surveylake.functions.expressions import leading_number

    channel = F.array(*[F.lit(c) for c in CHANNEL_NAMES])
    return table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.col("o_orderkey").alias("contact_record_id"),
        F.col("o_custkey").cast("string").alias("cas_account_number"),
        F.element_at(channel, (F.col("o_orderkey") % 5 + 1).cast("int")).alias("channel"),
        leading_number(F.col("o_orderpriority")).alias("q1"),
        F.col("o_totalprice").alias("q2"),
        (F.col("o_orderkey") % 10).cast("double").alias("q3"),
    )


# --- account snapshots over customer ------------------------------------------------

SNAPSHOTS_SQL = """
snapshots AS (
  SELECT c_custkey AS account_number, c_acctbal AS current_balance, c_mktsegment AS segment,
         c_nationkey AS nation, DATE '2024-01-01' AS insert_date FROM customer
  UNION ALL
  SELECT c_custkey, c_acctbal * 1.1, c_mktsegment, c_nationkey, DATE '2024-02-01'
  FROM customer WHERE c_custkey % 20 <> 0),
latest AS (SELECT * FROM snapshots WHERE insert_date = (SELECT max(insert_date) FROM snapshots))
"""


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots of every customer; accounts divisible by 20 closed before the second."""
    c = table(spark, folder, "customer")
    columns = [
        F.col("c_custkey").alias("account_number"),
        F.col("c_acctbal").alias("current_balance"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    ]
    january = c.select(*columns, F.lit(date(2024, 1, 1)).alias("insert_date"))
    february = c.filter(F.col("c_custkey") % 20 != 0).select(*columns, F.lit(date(2024, 2, 1)).alias("insert_date"))
    return january.union(february.withColumn("current_balance", F.col("current_balance") * 1.1))


def arrears_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshots under the arrears column names."""
    s = snapshots(spark, folder)
    return s.select(
        "account_number",
        F.lit(None).cast("double").alias("30_day_arrears"),
        F.lit(None).cast("double").alias("60_day_arrears"),
        F.lit(None).cast("double").alias("90_day_arrears"),
        F.col("segment").alias("tariff_rate_code"),
        "current_balance",
        F.lit("A").alias("agreement_status_code"),
        F.lit(None).cast("string").alias("critical_facility_code"),
        "insert_date",
    )


def account_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshots under the account column names."""
    s = snapshots(spark, folder)
    return s.select(
        "account_number",
        F.lit("B").alias("bal_billing_code"),
        F.col("segment").alias("current_credit_history_code"),
        F.lit(None).cast("string").alias("electric_rate_code"),
        F.col("nation").cast("string").alias("Division"),
        F.lit(None).cast("string").alias("zip_code"),
        F.lit("N").alias("bi_directional_ind"),
        "insert_date",
    )


def outages(spark: SparkSession, folder: str) -> DataFrame:
    """One outage per customer with orders: from the first to the last order date."""
    return table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("account_number")).agg(
        F.max("o_orderdate").alias("ami_lost_power_restored_datetm"),
        F.min("o_orderdate").alias("ami_lost_power_off_datetm"),
    )


# Responses with a customer account on some rows of the non-ivr channels, none in ivr.
TWO_ACCOUNTS_SQL = """
two_accounts AS (
  SELECT *, CASE WHEN channel <> 'ivr' AND survey_id = '0' THEN cas_account_number END AS customer_account_number
  FROM responses)
"""


def two_accounts(spark: SparkSession, folder: str) -> DataFrame:
    filled = (F.col("channel") != "ivr") & (F.col("survey_id") == "0")
    return responses(spark, folder).withColumn(
        "customer_account_number", F.when(filled, F.col("cas_account_number"))
    )


# --- predictions over responses ------------------------------------------------------


def _prediction_sql(topic: str) -> str:
    digest = f"md5(contact_record_id || '{topic}')"
    return (
        f"'{topic}_' || substr({digest}, 7, 1) AS {topic}, "
        f"(CAST('0x' || substr({digest}, 1, 6) AS BIGINT) % 1001) / 1000.0::DOUBLE AS {confidence(topic)}"
    )


PREDICTIONS_SQL = f"""
predictions AS (
  SELECT contact_record_id AS record_id, channel, campaign, {", ".join(_prediction_sql(t) for t in TOPICS)}
  FROM responses)
"""


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Six labels with confidences per response, fixed by a digest of id and topic."""
    columns = []
    for topic in TOPICS:
        digest = F.md5(F.concat(F.col("contact_record_id").cast("string"), F.lit(topic)))
        number = F.conv(F.substring(digest, 1, 6), 16, 10).cast("bigint")
        columns.append(F.concat(F.lit(f"{topic}_"), F.substring(digest, 7, 1)).alias(topic))
        columns.append((number % 1001 / F.lit(1000.0)).alias(confidence(topic)))
    return responses(spark, folder).select(
        F.col("contact_record_id").alias("record_id"), "channel", "campaign", *columns
    )


# --- texts over documents ---------------------------------------------------------------

TEXTS_SQL = """
texts AS (
  SELECT d.doc_id AS record_id, d.text, d.lang, d.source,
         CASE d.doc_id % 5 WHEN 0 THEN 'ivr' WHEN 1 THEN 'sms_transactional' WHEN 2 THEN 'sms_relational'
                           WHEN 3 THEN 'api_transactional' ELSE 'api_relational' END AS channel,
         CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'POSITIVE' WHEN l.quality = 0 AND l.toxic = 1 THEN 'NEGATIVE'
              WHEN l.quality = 1 THEN 'MIXED' WHEN l.quality = 0 THEN 'NEUTRAL' END AS overall_sentiment,
         CASE WHEN l.doc_id IS NOT NULL THEN d.source END AS level2_category,
         CASE WHEN l.doc_id IS NOT NULL THEN d.source || '/' || d.lang END AS level3_subcategory,
         CASE WHEN l.doc_id IS NOT NULL THEN d.lang END AS level4_team,
         CASE l.quality WHEN 1 THEN 'true' WHEN 0 THEN 'false' END AS is_actionable,
         CASE l.toxic WHEN 1 THEN 'true' WHEN 0 THEN 'false' END AS is_urgent,
         l.doc_id IS NOT NULL AS labelled
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as comments, with six topic labels where the label table has them."""
    d = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    j = d.join(labels, "doc_id", "left")
    labelled, good, bad = F.col("quality").isNotNull(), F.col("quality") == 1, F.col("toxic") == 1
    channel = F.array(*[F.lit(c) for c in CHANNEL_NAMES])
    sentiment = (
        F.when(good & ~bad, "POSITIVE").when(~good & bad, "NEGATIVE").when(good, "MIXED").when(~good, "NEUTRAL")
    )
    return j.select(
        F.col("doc_id").alias("record_id"),
        "text",
        "lang",
        "source",
        F.element_at(channel, (F.col("doc_id") % 5 + 1).cast("int")).alias("channel"),
        sentiment.alias("overall_sentiment"),
        F.when(labelled, F.col("source")).alias("level2_category"),
        F.when(labelled, F.concat("source", F.lit("/"), "lang")).alias("level3_subcategory"),
        F.when(labelled, F.col("lang")).alias("level4_team"),
        F.when(good, "true").when(~good, "false").alias("is_actionable"),
        F.when(bad, "true").when(~bad, "false").alias("is_urgent"),
        labelled.alias("labelled"),
    )


