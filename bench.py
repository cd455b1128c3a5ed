"""Time the headline work and print one JSON line.

Set-up (untimed) stores the cleaned rows, the raw text rows and the fact table as parquet, the
way a running lake holds them. Each figure is the median of three runs into the ``noop`` sink
after one warm-up run. ``value`` is the feature transform, the one step with a published
baseline; ``queries`` has everything.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from tillworks.operators import breakdowns, cleaning, incremental, kpis, validation
from tillworks.operators.fact_shape import to_fact_columns
from tillworks.operators.features import add_features
from tillworks.plans.catalog import CATALOG
from tillworks.session import build_session, fresh_path
from tillworks.plans.load import Lake, LoadOptions, load_files
from tillworks.sources import csv_files, lake, star_tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(build) -> float:
    seconds = []
    for attempt in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        if attempt:
            seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", **{
            "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")

    def stored(rows, name):
        path = fresh_path(spark, f"bench-{name}")
        rows.repartition(int(CPUS)).write.parquet(path)
        return spark.read.parquet(path)

    clean = stored(star_tables.clean_rows(spark, FOLDER), "clean")
    raw = stored(star_tables.dirty_rows(spark, FOLDER), "raw")
    fact_path = fresh_path(spark, "bench-fact")
    lake.write_fact(star_tables.fact_sales(spark, FOLDER), fact_path)
    fact = lake.read_fact(spark, fact_path)
    rows = clean.count()

    csv = csv_files.write_csv(raw, fresh_path(spark, "bench-csv"))

    def load():
        """Files to fact table in a lake of their own; what is timed is the whole run."""
        done = load_files(Lake(spark, fresh_path(spark, "bench-lake")), csv, LoadOptions(on_invalid="quarantine"))
        if done.status not in ("SUCCESS", "PARTIAL"):
            raise RuntimeError(done.error_message)
        return spark.range(1)

    work = {
        "feature_transform": lambda: add_features(clean),
        "feature_transform_to_fact": lambda: to_fact_columns(add_features(clean)),
        "fact_from_star_tables": lambda: star_tables.fact_sales(spark, FOLDER),
        "validate": lambda: validation.validate(raw),
        "clean": lambda: cleaning.clean(raw),
        "clean_stats": lambda: cleaning.cleaning_stats(raw),
        "batch_unique": lambda: incremental.unique_in_batch(fact),
        "antijoin": lambda: incremental.not_in_target(fact, fact.where(F.col("invoice_year") < 1998)),
        "src_csv": lambda: csv_files.read_raw(spark, csv),
        "file_manifest": lambda: csv_files.file_manifest(spark, csv),
        "load_files": load,
        "high_watermark": lambda: incremental.high_watermark_of_table(fact),
        "kpi_set_full": lambda: kpis.kpi_set_full(fact),
        "kpi_set_basic": lambda: kpis.kpi_set_basic(fact),
        "brk_segments": lambda: breakdowns.segments(fact),
        "brk_top_products": lambda: breakdowns.top_products(fact),
        **{name: (lambda report=CATALOG[name]: report(fact)) for name in ("q08", "q12", "q18", "q21", "q22", "q23", "q24", "q25")},
    }
    seconds = {name: timed(build) for name, build in work.items()}
    print(json.dumps({
        "metric": "feature_transform",
        "value": seconds["feature_transform"],
        "unit": "sec",
        "queries": seconds,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
        "rows": rows,
        "rows_per_second": round(rows / seconds["feature_transform"]),
        "total": round(sum(seconds.values()), 3),
        "cpus": int(CPUS),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
