"""Many distinct counts from one scan.

A report that counts distinct invoices, customers and products would make Spark copy every
line once per distinct expression. Here each line is copied once per *thing counted*, as a
``(kind, group, member)`` key. The first aggregation keeps one row per key and is combined
before its shuffle, so a key that holds a large share of the lines is a single row per task by
then. The second one counts members per group, again combined first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """One thing to count: which lines take part, how they group, what is distinct in a group."""

    name: str
    lines: Column
    member: Column | None = None
    group: Column | None = None
    subgroup: Column | None = None


def _text(value: Column | None) -> Column:
    return (F.lit(None) if value is None else value).cast("string")


def tally(
    lines: DataFrame, kinds: list[Kind], sums: dict[str, tuple[Column, list[str]]], marks: dict[str, Column]
) -> DataFrame:
    """One row per (kind, group, subgroup).

    ``members`` is the distinct count; each mark becomes the number of members with at least
    one line bearing it; each sum is taken over all lines of a group, for the kinds it names.
    """
    keys = F.array(*[
        F.struct(
            F.when(kind.lines, kind.name).alias("kind"),
            _text(kind.group).alias("group"),
            _text(kind.subgroup).alias("subgroup"),
            _text(kind.member).alias("member"),
        )
        for kind in kinds
    ])
    values = {**{name: value for name, (value, _) in sums.items()}, **marks}
    wanted = {name: F.when(F.col("kind").isin(of), F.col(name)) for name, (_, of) in sums.items()}
    return (
        lines.select(*[value.alias(name) for name, value in values.items()], F.inline(keys))
        .where(F.col("kind").isNotNull())
        .groupBy("kind", "group", "subgroup", "member")
        .agg(
            *[F.sum(value).alias(name) for name, value in wanted.items()],
            *[F.bool_or(name).alias(name) for name in marks],
        )
        .groupBy("kind", "group", "subgroup")
        .agg(
            F.count("member").alias("members"),
            *[F.sum(name).alias(name) for name in sums],
            *[F.count_if(F.col(name) & F.col("member").isNotNull()).alias(name) for name in marks],
        )
    )
