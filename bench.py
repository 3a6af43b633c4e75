"""Times the reports; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose tables and cores. With
``BENCH_COPIES`` set, the events are first stored that many times over, each
copy with its own sessions, and only the event halves are timed on them, beside
the three-branch form with joins.
"""

import json
import os
import statistics
import sys
import tempfile
import time
from functools import partial
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from erabridge import REPORTS, ga4_half, read_partitioned_events  # noqa: E402
from erabridge.operators.sessions import (  # noqa: E402
    session_report_by_joins,
    session_reports,
)
from erabridge.session import settings_for  # noqa: E402
from workload.adapters import event_rows  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "0"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SHUFFLE_BYTES_PER_EVENT = 160


def session() -> SparkSession:
    scale = max(COPIES, 1) * 100_000 * SHUFFLE_BYTES_PER_EVENT
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
    )
    cores = int(CPUS) if CPUS.isdigit() else os.cpu_count()
    for key, value in settings_for(scale, cores).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored_copies(spark: SparkSession) -> str:
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/events"
    apart = F.col("copy").cast("bigint") * 10**9
    session_id = F.col("event_bundle_sequence_id") + apart
    (
        event_rows(spark, SF_DIR)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
        .withColumn("event_bundle_sequence_id", session_id)
        .drop("copy")
        .repartition("event_date")
        .write.partitionBy("event_date")
        .parquet(path)
    )
    return path


def workload(spark: SparkSession) -> dict:
    if not COPIES:
        names = [f"report_{name}" for name in REPORTS]
        names.append("ga4_all_session_reports")
        return {name: partial(QUERIES[name], spark, SF_DIR) for name in names}
    events = read_partitioned_events(spark, stored_copies(spark))
    dims = {
        "campaign": "traffic_source.name",
        "device": "device.category",
        "source": "traffic_source.source",
    }
    return {
        **{
            f"ga4_{name}": partial(ga4_half, spec, events)
            for name, spec in REPORTS.items()
        },
        "ga4_all_session_reports": partial(session_reports, events, dims),
        "campaign_by_joins": partial(
            session_report_by_joins, events, "campaign", dims["campaign"]
        ),
    }


def seconds(build) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = session()
    queries = workload(spark)
    for build in queries.values():
        seconds(build)
    # Runs alternate between queries, so that none has the warmest turn.
    timings = {name: [] for name in queries}
    for _ in range(RUNS):
        for name, build in queries.items():
            timings[name].append(seconds(build))
    medians = {n: round(statistics.median(t), 4) for n, t in timings.items()}
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(medians.values()), 4),
                "unit": "sec",
                "queries": medians,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "copies": COPIES or 1,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
