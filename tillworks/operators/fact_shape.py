"""Feature columns in the shape of the fact table, and the table's own rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import schema as S


def to_fact_columns(features: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Rename to warehouse names, in warehouse order and types, followed by ``keep`` as is.

    Absent columns are left out, and a value that does not fit its type becomes null, for the
    constraints to catch.
    """
    types = {field.name: field.dataType for field in S.FACT_SCHEMA}
    return features.select(
        *[
            F.col(source).try_cast(types[target]).alias(target)
            for source, target in S.FACT_COLUMN_MAP.items()
            if source in features.columns
        ],
        *keep,
    )


def constraint_flags() -> dict:
    """Name of each rule of the fact table -> predicate that is true where a row breaks it."""
    required = [name for name in S.FACT_COLUMN_MAP.values()]
    absent = F.lit(False)
    for name in required:
        absent = absent | F.col(name).isNull()
    return {
        "null_in_required_column": absent,
        "quantity_zero": F.col("quantity") == 0,
        "unit_price_negative": F.col("unit_price") < 0,
        "month_out_of_range": ~F.col("invoice_month").between(1, 12),
        "quarter_out_of_range": ~F.col("invoice_quarter").between(1, 4),
        "hour_out_of_range": ~F.col("invoice_hour").between(0, 23),
    }


def constraint_violations(fact: DataFrame) -> DataFrame:
    """One row with the number of rows breaking each rule, from one pass."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(broken).alias(name) for name, broken in constraint_flags().items()],
    )


def meets_constraints() -> Column:
    """True where a row breaks no rule of the fact table."""
    broken = F.lit(False)
    for predicate in constraint_flags().values():
        broken = broken | F.coalesce(predicate, F.lit(False))
    return ~broken
