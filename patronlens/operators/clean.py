"""Invoice-line cleaning: typing, filters, amounts and the month cutoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from patronlens import schemas as S
from patronlens.functions import dates, numbers, text

BAD_DATE, BAD_CUSTOMER = "unreadable date", "unreadable customer id"


def _kind(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _customer_text(df: DataFrame) -> Column:
    """Customer id as text of a whole number: 17850.0 -> '17850'."""
    value, kind = F.col(S.CUSTOMER), _kind(df, S.CUSTOMER)
    if isinstance(kind, T.IntegralType):
        return value.cast("string")
    whole = value.try_cast("double").try_cast("bigint")
    if isinstance(kind, T.StringType):
        whole = F.coalesce(value.try_cast("bigint"), whole)
    return whole.cast("string")


def _moment(df: DataFrame) -> Column:
    """The date; null for a text that is none."""
    value, kind = F.col(S.DATE), _kind(df, S.DATE)
    return dates.parse_timestamp(value) if isinstance(kind, T.StringType) else value.cast("timestamp_ntz")


def _parsed(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with more columns, made by a generator of one row: filters and projections above
    read the results instead of repeating the parsing."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def judged(raw: DataFrame) -> DataFrame:
    """`raw` with date and customer parsed (null where that fails) and `reason`, which says
    what was unreadable; null for all other lines."""
    found = _parsed(raw, _date=_moment(raw), _customer=_customer_text(raw))
    reason = (F.when(F.col(S.DATE).isNotNull() & F.col("_date").isNull(), BAD_DATE)
              .when(F.col(S.CUSTOMER).isNotNull() & F.col("_customer").isNull(), BAD_CUSTOMER))
    return found.withColumn("reason", reason).withColumns(
        {S.DATE: F.col("_date"), S.CUSTOMER: F.col("_customer")}).drop("_date", "_customer")


def _readable(df: DataFrame, name: str, parsed: Column, said: str, on_bad: str) -> DataFrame:
    """`df` with the column parsed; a value that is none raises (in a filter, so it does
    whichever columns are asked for) or is null. Typed columns are only cast."""
    kind = _kind(df, name)
    if isinstance(kind, T.IntegralType) or (name == S.DATE and not isinstance(kind, T.StringType)):
        return df.withColumn(name, parsed)
    found = _parsed(df, _value=parsed)
    if on_bad == "raise":
        message = F.concat(F.lit(f"{said}: "), F.col(name).cast("string"))
        found = found.filter(F.when(F.col(name).isNotNull() & F.col("_value").isNull(),
                                    F.raise_error(message).cast("boolean")).otherwise(True))
    return found.withColumn(name, F.col("_value")).drop("_value")


def _number(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    return value if isinstance(_kind(df, name), T.DoubleType) else value.try_cast("double")


def _invoice() -> Column:
    return F.coalesce(F.col(S.INVOICE).cast("string"), F.lit(S.MISSING_INVOICE))


def keep_line(df: DataFrame) -> Column:
    """True for lines that survive cleaning, false or null for others. A plain conjunction,
    so each part is pushed to the scan it belongs to."""
    return (F.col(S.CUSTOMER).isNotNull()
            & ~_invoice().startswith("C")
            & (_number(df, S.QUANTITY) > 0)
            & (_number(df, S.PRICE) > 0))


def clean_sales(raw: DataFrame, on_bad: str = "raise", also: Column | None = None) -> DataFrame:
    """Keep priced, positive, uncancelled lines that name a customer, and those for which
    `also` holds.

    Adds `amount_cents` (bigint) and `total_amount` (its decimal form). An unreadable date
    or customer id of a kept line raises, whatever columns are used; with on_bad="null" the
    date becomes null and the line with the bad customer id is dropped."""
    keep = keep_line(raw)
    kept = raw.filter(keep if also is None else keep | also)
    kept = _readable(kept, S.DATE, _moment(raw), BAD_DATE, on_bad)
    kept = _readable(kept, S.CUSTOMER, _customer_text(raw), BAD_CUSTOMER, on_bad)
    kept = kept.withColumns({S.QUANTITY: _number(raw, S.QUANTITY), S.PRICE: _number(raw, S.PRICE),
                             S.INVOICE: _invoice()})
    if on_bad != "raise" and also is None:
        kept = kept.filter(F.col(S.CUSTOMER).isNotNull())
    kept = kept.withColumn("amount_cents",
                           numbers.line_cents(F.col(S.QUANTITY), F.col(S.PRICE)))
    kept = kept.withColumn("total_amount", numbers.to_money(F.col("amount_cents")))
    if S.DESCRIPTION in raw.columns:
        kept = kept.withColumn(S.DESCRIPTION, F.coalesce(
            text.strip_upper(F.col(S.DESCRIPTION).cast("string")), F.lit(S.MISSING_DESCRIPTION)))
    return kept


def clean_stats(raw: DataFrame) -> DataFrame:
    """Rows before and after cleaning, rows dropped and their share in percent (1 digit)."""
    return (raw.agg(F.count(F.lit(1)).alias("rows_before"),
                    F.count_if(keep_line(raw)).alias("rows_after"))
            .withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))
            .withColumn("dropped_pct", numbers.float_round(
                F.col("rows_dropped") / F.nullif(F.col("rows_before"), F.lit(0)).cast("double")
                * F.lit(100.0), 1)))


def filter_by_month(df: DataFrame, year: int, month: int, inclusive_end: bool = False,
                    on_bad: str = "raise") -> DataFrame:
    """All lines up to the end of the month (see `dates.cutoff` for the last day)."""
    limit = dates.cutoff(dates.period_name(year, month), inclusive_end)
    return _readable(df, S.DATE, _moment(df), BAD_DATE, on_bad).filter(
        F.col(S.DATE) <= dates.timestamp_literal(limit))


def transactions(clean: DataFrame) -> DataFrame:
    """Cleaned raw lines under the warehouse's names, as scoring and ranking read them."""
    renamed = {S.CUSTOMER: "customer_id", S.INVOICE: "invoice_no", S.PRODUCT: "stock_code",
               S.DESCRIPTION: "description", S.COUNTRY: "country", S.DATE: "invoice_date",
               S.QUANTITY: "quantity", S.PRICE: "unit_price"}
    return clean.withColumnsRenamed({k: v for k, v in renamed.items() if k in clean.columns})
