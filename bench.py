"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8).
Each query runs to completion into a sink that discards its rows. `clean_rows_per_sec` is the rate of
the bar cleaner on the same rows many times over, spread like the splits of a large folder.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADLINE = (
    "norm_headers", "lenient_cast", "parse_trade_date", "not_null_gate",
    "qc_bad_date", "qc_ohlc", "qc_duplicates",
    "clean_bars", "clean_index", "clean_fo", "clean_deliverable", "clean_master",
    "dedupe_first_cm", "dedupe_first_fo",
    "t_latest", "t_table_counts", "t_top_gainers", "t_top_losers", "t_volume_leaders",
    "t_delivery_spike", "t_fo_most_traded", "t_fo_open_interest", "t_index_history",
    "t_delivery_ratio",
    "anomaly_extreme_move", "anomaly_delivery_mismatch", "anomaly_counts", "anomaly_samples",
    "master_drift", "month_coverage", "detect_gaps", "cross_tables", "status_by_month",
    "upsert_bars", "upsert_fo", "export_parquet", "zip_member", "file_fingerprint",
    "ingest_incremental", "restate_day", "scan_raw", "report_lines", "report_json",
)
COPIES = 20


def run(df: DataFrame) -> float:
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def clean_rate(spark: SparkSession, sf_dir: str, cpus: int) -> float:
    """Rows per second through the bar cleaner, parsing and deduplication included."""
    from eodlake.fixtures import bridge
    from eodlake.operators.clean import clean_bars

    raw = bridge.raw(spark, sf_dir, "cm")
    many = (
        raw.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
        .withColumn("SYMBOL", F.concat("SYMBOL", F.col("_copy").cast("string")))
        .drop("_copy")
        .repartition(cpus * 4)
        .persist()
    )
    n = many.count()
    rows = clean_bars(many).rows
    run(rows)
    seconds = run(rows)
    many.unpersist()
    return n / seconds


def main() -> None:
    from eodlake.fixtures.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("eodlake-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["t_latest"](spark, sf_dir))  # start-up and class loading stay out of the figures
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "shuffle_partitions": cpus,
                "clean_rows_per_sec": round(clean_rate(spark, sf_dir, cpus)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
