"""Queries on published parts and on dashboards by change."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from surveylake.operators.corrections import combine_corrections
from surveylake.operators.rollups import monthly_yago
from surveylake.session import scratch_path
from surveylake.sinks.dashboards import correct_dashboard, read_dashboard, write_dashboard
from surveylake.sinks.versions import publish, publish_table, read_published, read_table

from .adapters import AS_OF, ORDERS_SQL, history, predictions
from .registry import query
from .rollups import YAGO_SQL, rounded
from .text import LOW_CTE, OUTPUTS_SQL, OVERLAY_SQL, outputs

PARTS = ("contact_record_id", "channel", "q2", "event_date")


@query(
    "published_dates",
    f"""WITH {ORDERS_SQL} SELECT contact_record_id, channel, q2, event_date FROM history
    WHERE NOT (month(event_date) = 3 AND contact_record_id % 2 = 1) AND month(event_date) <> 4""",
)
def _published_dates(spark, folder):
    """All dates; then those of March replaced by their even records, and those of April by nothing."""
    h, root = history(spark, folder).select(*PARTS), scratch_path(spark, "published")
    days = [row.event_date for row in h.select("event_date").distinct().collect()]  # the calendar
    publish(h, root, days)
    march, april = ([d for d in days if d.month == month] for month in (3, 4))
    publish(h.filter((F.month("event_date") == 3) & (F.col("contact_record_id") % 2 == 0)), root, march)
    publish(h.filter(F.lit(False)), root, april)
    return read_published(spark, root, h.schema)


@query(
    "published_rollups",
    f"WITH {ORDERS_SQL} SELECT channel, {YAGO_SQL} GROUP BY channel, month(event_date), year(event_date)",
)
def _published_rollups(spark, folder):
    """The monthly figures as of an earlier day, replaced by those of today, read back."""
    h, root = history(spark, folder), scratch_path(spark, "published-rollups")
    publish_table(rounded(monthly_yago(h, date(AS_OF.year - 1, 6, 30), "channel")), root)
    now = rounded(monthly_yago(h, AS_OF, "channel"))
    publish_table(now, root)
    return read_table(spark, root, now.schema)


@query("dashboard_by_change", f"{LOW_CTE}, {OUTPUTS_SQL}, {OVERLAY_SQL} SELECT * FROM overlay")
def _dashboard_by_change(spark, folder):
    """The stored predictions with corrections laid over them, bucket by bucket."""
    p, root = predictions(spark, folder), scratch_path(spark, "dashboard")
    write_dashboard(p, root)
    correct_dashboard(spark, root, p.schema, combine_corrections(outputs(spark, folder)))
    return read_dashboard(spark, root, p.schema)
