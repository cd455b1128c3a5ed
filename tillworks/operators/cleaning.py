"""Raw text rows to clean typed rows: trim, drop impossible, fill in, deduplicate, cast.

The steps run in that order. All but the deduplication are projections and filters; that one
keeps a row by rank within its key, which Spark bounds per task before the shuffle, so a key
with very many copies sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks import schema as S
from tillworks.functions.dates import to_moment
from tillworks.functions.text import is_missing_word, strip


def number(value: Column) -> Column:
    """Text as a number; null when it is not one.

    A number ends in a digit or a dot, which leaves out the spellings only the JVM accepts
    (``1.5d``, ``NaN``), and has no ``x`` in it (``0x1p3``).
    """
    # One pattern: Spark works a value out anew for each place it stands in, in filters at least.
    return F.when(value.rlike(r"\A[^xX]*[0-9.] *\z"), value.try_cast("double"))


def price_value(value: Column) -> Column:
    """Unit price, with the decimals needed to round only the line total.

    Text that is no number counts as zero. A number too large for the type stays null, for the
    fact table's rules to reject.
    """
    return F.coalesce(value.try_cast("decimal(14,4)"), F.when(number(value).isNull(), F.lit(0).cast("decimal(14,4)")))


# --- steps -------------------------------------------------------------------------------


def trim_text(raw: DataFrame) -> DataFrame:
    """Strip every text column."""
    texts = [name for name, kind in raw.dtypes if kind == "string"]
    return raw.withColumns({name: strip(F.col(name)) for name in texts})


def upper_code(value: Column) -> Column:
    return F.upper(strip(value.cast("string")))


def upper_codes(raw: DataFrame) -> DataFrame:
    """Invoice and stock codes as upper-case text, whatever type they came in."""
    return raw.withColumns({
        name: upper_code(F.col(name)) for name in ("InvoiceNo", "StockCode") if name in raw.columns
    })


def title_country(raw: DataFrame) -> DataFrame:
    if "Country" not in raw.columns:
        return raw
    return raw.withColumn("Country", F.initcap(strip(F.col("Country"))))


def is_possible(columns: list[str]) -> Column:
    """True for rows with a price of zero or more and an invoice number."""
    keep = F.lit(True)
    if "UnitPrice" in columns:
        keep = keep & F.coalesce(number(F.col("UnitPrice").cast("string")) >= 0, F.lit(False))
    if "InvoiceNo" in columns:
        keep = keep & F.coalesce(~F.col("InvoiceNo").isin("", "NAN"), F.lit(False))
    return keep


def drop_invalid(raw: DataFrame) -> DataFrame:
    return raw.where(is_possible(raw.columns))


def _text(name: str, stripped: bool, kind: str = "string") -> Column:
    value = F.col(name)
    if kind in ("double", "float"):  # whole numbers as digits, without an exponent
        whole = value.try_cast("decimal(38,0)")
        value = F.when(whole == value, whole.cast("string")).otherwise(value.cast("string"))
    value = value.cast("string")
    return value if stripped else strip(value)


def impute_customer(raw: DataFrame, stripped: bool = False) -> DataFrame:
    """Guests for missing ids; ids read as numbers lose their ``.0``."""
    if "CustomerID" not in raw.columns:
        return raw
    text = _text("CustomerID", stripped, dict(raw.dtypes)["CustomerID"])
    known = F.regexp_replace(text, r"^(\d+)\.0$", "$1")
    return raw.withColumn("CustomerID", F.when(is_missing_word(text), S.GUEST_ID).otherwise(known))


def impute_description(raw: DataFrame, stripped: bool = False) -> DataFrame:
    if "Description" not in raw.columns:
        return raw
    text = _text("Description", stripped)
    return raw.withColumn("Description", F.when(is_missing_word(text), S.UNKNOWN_DESCRIPTION).otherwise(text))


def _dedupe_keys(columns: list[str]) -> list[Column]:
    """Key columns; equal quantities match however they are written."""
    names = [name for name in S.DEDUPE_KEY if name in columns] or columns
    text = F.col("Quantity").cast("string") if "Quantity" in columns else None
    return [
        F.coalesce(number(text).cast("string"), text) if name == "Quantity" else F.col(name)
        for name in names
    ]


def dedupe(raw: DataFrame, first_by: list[str] = ()) -> DataFrame:
    """One row per key: the first by ``first_by`` (say, the file name), then by all columns.

    A distributed read has no row order, so the remaining columns decide which copy stays; the
    outcome is the same on every run.
    """
    decided = {*first_by, *S.DEDUPE_KEY} - {"Quantity"}
    order = [F.col(name) for name in [*first_by, *[name for name in raw.columns if name not in decided]]]
    in_key = Window.partitionBy(*_dedupe_keys(raw.columns)).orderBy(*order)
    return raw.withColumn("_copy", F.row_number().over(in_key)).where(F.col("_copy") == 1).drop("_copy")


def cast_types(raw: DataFrame) -> DataFrame:
    """Final types; unreadable numbers become zero and unreadable dates null."""
    casts = {}
    if "Quantity" in raw.columns:
        casts["Quantity"] = F.coalesce(
            number(F.col("Quantity").cast("string")).try_cast("bigint"), F.lit(0).cast("bigint")
        )
    if "UnitPrice" in raw.columns:
        casts["UnitPrice"] = price_value(F.col("UnitPrice").cast("string")).cast("decimal(14,4)")
    if "InvoiceDate" in raw.columns and dict(raw.dtypes)["InvoiceDate"] == "string":
        casts["InvoiceDate"] = to_moment(F.col("InvoiceDate"))
    return raw.withColumns(casts)


def normalise(raw: DataFrame) -> DataFrame:
    """The text steps in one go, each value stripped once: every row stays."""
    shaped = {name: F.col(name) for name, kind in raw.dtypes if kind == "string"}
    shaped |= {name: F.col(name).cast("string") for name in ("InvoiceNo", "StockCode") if name in raw.columns}
    finish = {"InvoiceNo": F.upper, "StockCode": F.upper, "Country": F.initcap}
    return raw.withColumns({
        name: finish.get(name, lambda text: text)(strip(value)) for name, value in shaped.items()
    })


def clean(raw: DataFrame, first_by: list[str] = ()) -> DataFrame:
    kept = drop_invalid(normalise(raw))
    filled = impute_description(impute_customer(kept, stripped=True), stripped=True)
    return cast_types(dedupe(filled, first_by))


def _missing_values(columns: list[str]) -> Column:
    """How many fields of a row with stripped text will be filled in."""
    missing = F.lit(0)
    for name in ("CustomerID", "Description"):
        if name in columns:
            missing = missing + is_missing_word(F.col(name).cast("string")).cast("int")
    return missing


def row_counts(raw: DataFrame) -> DataFrame:
    """Rows in, rows dropped as impossible, fields filled in: one pass without a shuffle."""
    return normalise(raw).agg(*row_counters(raw.columns))


def row_counters(columns: list[str], among: Column | None = None) -> list[Column]:
    """The counts of ``row_counts`` over normalised rows, for one aggregate with other counts;
    ``among`` chooses the rows that are cleaned."""
    among = F.lit(True) if among is None else among
    keep, zero = is_possible(columns), F.lit(0).cast("bigint")
    return [
        F.count_if(among).alias("initial_rows"),
        F.count_if(among & ~keep).alias("invalid_prices_removed"),
        F.coalesce(F.sum(F.when(among & keep, _missing_values(columns))), zero).alias("nulls_imputed"),
    ]


def stats_after(counts: DataFrame, final_rows: int) -> DataFrame:
    """Full statistics from ``row_counts`` and the number of rows a stored ``clean`` result has."""
    final = F.lit(final_rows).cast("bigint")
    return counts.select(
        "initial_rows",
        (F.col("initial_rows") - F.col("invalid_prices_removed") - final).alias("duplicates_removed"),
        "invalid_prices_removed",
        "nulls_imputed",
        final.alias("final_rows"),
    )


def cleaning_stats(raw: DataFrame) -> DataFrame:
    """What ``clean`` would do to these rows, from one scan and one shuffle on the dedupe key."""
    text = normalise(raw)
    flagged = text.withColumns({"_keep": is_possible(text.columns), "_missing": _missing_values(text.columns)})
    flagged = impute_customer(flagged, stripped=True)
    key = F.struct(*[value.alias(f"k{i}") for i, value in enumerate(_dedupe_keys(text.columns))])
    copies = flagged.groupBy("_keep", F.when(F.col("_keep"), key).alias("_key")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_missing").alias("missing")
    )
    kept, zero = F.col("_keep"), F.lit(0).cast("bigint")
    total = F.coalesce(F.sum("rows"), zero)
    invalid = F.coalesce(F.sum(F.when(~kept, F.col("rows"))), zero)
    final = F.count_if(kept)
    return copies.agg(
        total.alias("initial_rows"),
        (total - invalid - final).alias("duplicates_removed"),
        invalid.alias("invalid_prices_removed"),
        F.coalesce(F.sum(F.when(kept, F.col("missing"))), zero).alias("nulls_imputed"),
        final.alias("final_rows"),
    )
