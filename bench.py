"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Each query is evaluated in full: every row and column goes to a sink that discards it.
HEADLINE = (
    "daily_run_scores",
    "final_responses",
    "dedup_all_channels",
    "dedup_removed",
    "dedup_report",
    "intent_mapping",
    "input_profile",
    "quarantine_ivr",
    "cumulative_scores_by_channel",
    "monthly_yago_by_channel",
    "enrich_all",
    "append_missing",
    "new_records_check",
    "write_final",
    "clean_prep",
    "low_confidence",
    "reprocess_batches",
    "apply_corrections",
    "assemble_predictions",
    "training_merge",
    "score_sentiment",
    "file_copy",
)


def main() -> None:
    import checks.responses  # noqa: F401
    import checks.rollups  # noqa: F401
    import checks.text  # noqa: F401
    from checks.registry import QUERIES
    from surveylake.session import cpu_count, local_session

    cpus = cpu_count()
    spark = local_session("bench", cpus=cpus, shuffle_partitions=cpus)
    times: dict[str, float] = {}
    for name in HEADLINE:
        measured = []
        for _ in range(RUNS + 1):  # the first run warms up and is not counted
            started = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - started)
        times[name] = round(statistics.median(measured[1:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "median seconds per query, summed over the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(FOLDER).name.removeprefix("sf"),
        "cpus": cpus,
        "spark": spark.version,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
