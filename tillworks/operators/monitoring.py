"""Reports on the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import schema as S
from tillworks.functions import numeric as N

HEALTH_WINDOW = 50


def _newest(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id"))


def _is(status: str) -> Column:
    return F.col("status") == status


def _millis(duration: Column) -> Column:
    """Durations have three decimals; whole milliseconds average exactly."""
    return (duration * 1000).cast(N.WIDE)


def _average_duration() -> Column:
    duration = F.col("execution_duration")
    return N.half_up(_millis(F.sum(duration)), N.whole(F.count(duration)) * N.whole(1000), 2)


def latest_runs_view(runs: DataFrame) -> DataFrame:
    return _newest(runs).limit(50).select(
        "run_id", "pipeline_name", "source_file", "status", "started_at", "completed_at", "rows_read",
        "rows_inserted", "rows_skipped", "rows_invalid", F.col("execution_duration").cast("double").alias("execution_duration"),
    )


def failed_runs_view(runs: DataFrame) -> DataFrame:
    return _newest(runs.where(_is(S.FAILED))).select(
        "run_id", "pipeline_name", "source_file", "started_at", "error_message",
        F.col("execution_duration").cast("double").alias("execution_duration"),
    )


def daily_view(runs: DataFrame) -> DataFrame:
    return (
        runs.groupBy(F.to_date("started_at").alias("run_date"))
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            F.count_if(_is(S.SUCCESS)).alias("successful_runs"),
            F.count_if(_is(S.FAILED)).alias("failed_runs"),
            F.sum("rows_read").alias("total_rows_read"),
            F.sum("rows_inserted").alias("total_rows_inserted"),
            F.sum("rows_skipped").alias("total_rows_skipped"),
            _average_duration().alias("avg_duration_seconds"),
        )
        .orderBy(F.desc("run_date"))
    )


def _quality() -> Column:
    return F.coalesce(N.percent(F.col("rows_valid"), F.when(F.col("rows_read") > 0, F.col("rows_read"))), F.lit(100.0))


def quality_view(runs: DataFrame) -> DataFrame:
    return _newest(runs).select(
        "run_id", "source_file", "rows_read", "rows_valid", "rows_invalid",
        _quality().alias("data_quality_rate_pct"), "started_at",
    )


def latest_run(runs: DataFrame) -> DataFrame:
    return _newest(runs).limit(1)


def recent_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    return _newest(runs).limit(limit)


def failed_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    return _newest(runs.where(_is(S.FAILED))).limit(limit)


def daily_summary(runs: DataFrame, limit_days: int = 30) -> DataFrame:
    return daily_view(runs).limit(limit_days)


def quality_summary(runs: DataFrame, limit: int = 20) -> DataFrame:
    return quality_view(runs).limit(limit)


def lineage(entries: DataFrame, run_id: str | None = None, limit: int = 20) -> DataFrame:
    """All entries of a run, or the newest ones of any run."""
    newest = [F.desc("created_at"), F.desc("lineage_id")]
    if run_id:
        return entries.where(F.col("run_id") == run_id).orderBy(*newest)
    return entries.orderBy(*newest).limit(limit)


def health(runs: DataFrame, window: int = HEALTH_WINDOW) -> DataFrame:
    """One row on the last runs; an empty log reads NO_RUNS."""
    counted = _newest(runs).limit(window).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(_is(S.FAILED)).alias("failed_runs"),
        F.count_if(_is(S.SUCCESS)).alias("successful_runs"),
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).cast("bigint").alias("total_rows_inserted"),
        F.coalesce(_average_duration(), F.lit(0.0)).alias("avg_duration_seconds"),
    )
    rate = F.coalesce(N.percent(F.col("successful_runs"), F.col("total_runs"), 1), F.lit(100.0))
    failed = F.col("failed_runs")
    status = (
        F.when(F.col("total_runs") == 0, "NO_RUNS")
        .when((rate < 80.0) | (failed > 2), "CRITICAL")
        .when((rate < 95.0) | (failed > 0), "WARNING")
        .otherwise("HEALTHY")
    )
    return counted.select(
        status.alias("health_status"), rate.alias("success_rate_pct"), "total_runs", "failed_runs",
        "total_rows_inserted", "avg_duration_seconds",
    )


def counters(runs: DataFrame) -> DataFrame:
    """Totals over the whole log and the newest quality score, one row per metric."""
    totals = runs.agg(
        F.count(F.lit(1)).alias("pipeline_runs_total"),
        F.count_if(F.upper("status") == S.FAILED).alias("pipeline_failures_total"),
        F.sum("execution_duration").alias("pipeline_duration_seconds_total"),
        F.sum("rows_read").alias("rows_processed_total"),
        F.sum("rows_inserted").alias("rows_inserted_total"),
        F.sum("rows_skipped").alias("rows_skipped_total"),
        F.max_by(_quality(), F.struct("started_at", "run_id")).alias("data_quality_score"),
    )
    kinds = {name: "gauge" if name == "data_quality_score" else "counter" for name in totals.columns}
    empty = {name: 100.0 if kind == "gauge" else 0.0 for name, kind in kinds.items()}
    return totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("metric"), F.lit(kind).alias("type"),
            F.coalesce(F.col(name).cast("double"), F.lit(empty[name])).alias("value"),
        )
        for name, kind in kinds.items()
    ])))
