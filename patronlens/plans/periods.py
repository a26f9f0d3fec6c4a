"""Period runs: source file -> warehouse -> scores -> recommendations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from patronlens import schemas as S
from patronlens.functions import dates
from patronlens import staging
from patronlens.operators import (clean, dims, facts, quality, recommend, rfm, scoring,
                                  states)
from patronlens.sources import files
from patronlens.sources.warehouse import Warehouse
from patronlens.staging import stage

FLOW = "monthly-run"


def load_lines(store: Warehouse, lines: DataFrame, periods: Sequence[str],
               through: str) -> int:
    """Store staged, cleaned lines of the given periods (they have a `period`): their monthly
    reductions, the state of period `through`, the dimensions and the facts; returns the
    number of facts written. Reads nothing of other months but the state before them."""
    for table, reduce in (("month_invoices", states.month_invoices),
                          ("month_countries", states.month_countries),
                          ("month_products", states.month_products)):
        store.replace_periods(table, reduce(lines), periods)
    _carry(store, periods, through)
    _merge_dimensions(store, lines, periods, through)
    if not periods:
        return 0
    resolved = facts.resolve_keys(
        facts.staging_facts(lines), store.read("dim_customer"), store.read("dim_product"),
        store.read("dim_geography"), keep=("period",))
    _check_members(store)
    store.replace_periods("fact_sales", resolved, periods)
    return store.read("fact_sales").filter(F.col("period").isin(list(periods))).count()


def _months(store: Warehouse, table: str, after: str, through: str) -> DataFrame:
    return store.read(table).filter((F.col("period") > after) & (F.col("period") <= through))


def _carry(store: Warehouse, periods: Sequence[str], through: str) -> None:
    """The state of `through` from the latest one before the first changed period, and the
    months since. States of changed or later periods are out of date and go."""
    first = min([*periods, through])
    known = store.periods("state_customer")
    base = max((p for p in known if p < first), default="")
    for table in ("state_customer", "state_country", "state_product"):
        store.drop_periods(table, [p for p in known if p >= first])
    invoices = stage(_months(store, "month_invoices", base, through), "new-invoices")
    low, high = invoices.agg(F.min("invoice_no"), F.max("invoice_no")).first()
    # an invoice seen before has a number in this range; files and row groups of the other
    # months are skipped by the least and greatest numbers they hold
    earlier = store.read("month_invoices").filter(
        (F.col("period") <= base) & F.col("invoice_no").between(low, high)).select(
        "customer_id", "invoice_no", "paid")

    def before(table: str) -> DataFrame:
        return store.read(table).filter(F.col("period") == base)

    folded = {
        "state_customer": states.fold_customers(before("state_customer"), invoices, earlier),
        "state_country": states.fold_countries(
            before("state_country"), _months(store, "month_countries", base, through)),
        "state_product": states.fold_products(
            before("state_product"), _months(store, "month_products", base, through))}
    for table, state in folded.items():
        store.replace_periods(table, state.withColumn("period", F.lit(through)), [through])


def _merge_dimensions(store: Warehouse, lines: DataFrame, periods: Sequence[str],
                      through: str) -> None:
    """Members that occur in the loaded periods take what the state now says of them."""
    def loaded(table: str) -> DataFrame:
        return store.read(table).filter(F.col("period").isin(list(periods)))

    def state(table: str, of: str, key: str) -> DataFrame:
        return store.read(table).filter(F.col("period") == through).join(
            loaded(of).select(key).distinct(), key, "left_semi")

    now = F.localtimestamp()
    store.upsert_keyed(
        "dim_customer", "customer_key",
        states.customers(state("state_customer", "month_invoices", "customer_id"),
                         state("state_country", "month_invoices", "customer_id")),
        ("country", "first_order", "last_order", "total_orders", "updated_at"),
        {"created_at": now, "updated_at": now})
    store.upsert_keyed("dim_product", "product_key",
                       states.products(state("state_product", "month_products", "stock_code")),
                       ("description",), {"created_at": now})
    # every day between the first and the last sale, also those between two loads
    known = store.read("dim_date").select(F.col("full_date").cast("timestamp_ntz").alias("invoice_date"))
    store.upsert("dim_date", dims.dim_date(lines.select("invoice_date").unionByName(known)))
    if not store.exists("dim_geography"):  # the member that facts without a country point to
        store.replace("dim_geography", store.spark.createDataFrame(
            [(facts.UNKNOWN_GEO_KEY, S.UNKNOWN_COUNTRY)], S.TABLES["dim_geography"]))
    store.upsert_keyed("dim_geography", "geo_key",
                       loaded("month_countries").select("country").distinct())


def _check_members(store: Warehouse) -> None:
    """Unique keys, natural and surrogate, and no null ones in the dimensions that facts are
    about to point to. Facts take their keys from these tables and drop rows without one, so
    they can have no orphans."""
    for table, key in (("dim_customer", "customer_key"), ("dim_product", "product_key"),
                       ("dim_geography", "geo_key"), ("dim_date", "date_key")):
        members = store.read(table)
        for columns in {(key,), tuple(S.KEYS[table])}:
            if not quality.duplicate_keys(members, columns).isEmpty():
                raise ValueError(f"{table}: repeated {', '.join(columns)}")
            if any(quality.null_counts(members, columns).first()):
                raise ValueError(f"{table}: null in {', '.join(columns)}")


def _history(store: Warehouse, periods: Sequence[str], inclusive_end: bool) -> DataFrame:
    """Score the periods and save history, latest scores and recommendations; the latest
    scores only move forward in time. One period is scored from its running state, many from
    the stored facts; products are ranked by all sales of a segment's members."""
    last = max(periods)
    stored = store.read("fact_sales").filter(F.col("period") <= last)
    customers, products = store.read("dim_customer"), store.read("dim_product")
    if len(periods) == 1:
        state = store.read("state_customer").filter(F.col("period") == last)
        totals = states.rfm_of(state, last)
    else:
        totals = rfm.backfill_rfm(facts.fact_lines(stored, customers), periods, inclusive_end)
    segmented = stage(scoring.score_and_segment(totals), "segmented")
    store.replace_periods("rfm_snapshot", scoring.as_snapshot(segmented), periods)

    known = store.read("customer_rfm").agg(F.max("period")).collect()[0][0]
    if known is None or last >= known:
        store.replace("customer_rfm",
                      scoring.as_latest(segmented.filter(F.col("period") == last)))

    ranked = recommend.recommend(facts.fact_lines(stored, customers, products), segmented,
                                 periods, inclusive_end=inclusive_end)
    store.replace_periods("product_recommendation", recommend.describe(ranked, products), periods)
    return segmented


NO_PRODUCT = "no product: counted for the customer, not a fact"


def _new_lines(store: Warehouse, source: str, period: str, skip: Sequence[str],
               inclusive_end: bool, encoding: str, on_bad: str) -> DataFrame:
    """Cleaned lines up to the end of a period that do not enter one of the periods to skip,
    staged with the period they enter.

    One job writes good and unreadable lines and counts the latter. They are an error after
    it has seen all of them, or, with on_bad="quarantine", rows of the quarantine table."""
    raw = files.extract_data(store.spark, source, encoding)
    files.validate_schema(raw)
    year, month = (int(part) for part in period.split("-"))
    bad = F.col("reason").isNotNull()
    lines = clean.judged(raw.withColumn("_raw", F.to_json(F.struct(*raw.columns))))
    limit = dates.timestamp_literal(dates.cutoff(period, inclusive_end))
    lines = lines.filter(bad | (F.col(S.DATE) <= limit)).withColumn("_raw", F.when(
        bad | F.col(S.PRODUCT).isNull() if S.PRODUCT in raw.columns else bad, F.col("_raw")))
    lines = clean.transactions(clean.clean_sales(lines, "keep", also=bad)).withColumn(
        "period", dates.entry_period(F.col("invoice_date"), inclusive_end))
    if skip:
        lines = lines.filter(bad | ~F.col("period").isin(*skip))
    seen = Observation()
    lines = stage(lines.observe(seen, *[
        F.count_if(F.col("reason") == reason).alias(f"n{i}")
        for i, reason in enumerate((clean.BAD_DATE, clean.BAD_CUSTOMER))]), "new-lines")
    dates_, customers = seen.get["n0"], seen.get["n1"]
    if dates_ + customers and on_bad == "raise":
        example = lines.filter(bad).select("reason", "_raw").first()
        raise ValueError(f"{dates_} lines with an unreadable date, {customers} with an unreadable "
                         f"customer id, such as {example.reason}: {example._raw}")
    if on_bad == "quarantine":
        store.append("quarantine", lines.filter(F.col("_raw").isNotNull()).select(
            F.lit(period).alias("run_period"),
            F.coalesce("reason", F.lit(NO_PRODUCT)).alias("reason"), F.col("_raw").alias("line")))
    return lines.filter(~bad).drop("reason", "_raw")


def run_period(spark: SparkSession, source: str, root: str, year: int, month: int,
               inclusive_end: bool = False, reload_all: bool = False,
               encoding: str = "auto", on_bad: str = "raise") -> dict:
    """Bring the warehouse to the end of a month and score that month.

    The month itself is loaded, and earlier months not stored yet; `reload_all` loads the
    earlier ones again too. Lines of other months are passed over when the source is read,
    and their stored facts only when products are ranked. A rerun leaves the same tables. `on_bad`: see `_new_lines`."""
    store = Warehouse(spark, root)
    period, started, rows = dates.period_name(year, month), dt.datetime.now(), 0
    status, error = "failed", None
    try:
        with staging.scope(spark):
            stored = set() if reload_all else set(store.periods("fact_sales")) - {period}
            new = _new_lines(store, source, period, sorted(stored), inclusive_end, encoding, on_bad)
            found = {r.period for r in new.select("period").distinct().collect()}  # a row a month
            rows = load_lines(store, new, sorted(found | {period}), period)
            _history(store, [period], inclusive_end)
        status = "success"
    except Exception as failure:
        error = str(failure)
        raise
    finally:
        store.log_run(period, FLOW, status, rows, started, error)
    return {"period": period, "rows_loaded": rows, "status": status}


def run_backfill(spark: SparkSession, source: str, root: str, periods: Sequence[str],
                 inclusive_end: bool = False, encoding: str = "auto",
                 on_bad: str = "raise") -> dict:
    """All periods in one pass over the source: the facts up to the last period are loaded
    once and every period is scored from them together."""
    store = Warehouse(spark, root)
    periods = sorted(set(periods))
    last = periods[-1]
    started, rows, status, error = dt.datetime.now(), 0, "failed", None
    try:
        with staging.scope(spark):
            lines = _new_lines(store, source, last, (), inclusive_end, encoding, on_bad)
            found = {r.period for r in lines.select("period").distinct().collect()}  # a row a month
            rows = load_lines(store, lines, sorted(found | set(periods)), last)
            _history(store, periods, inclusive_end)
        status = "success"
    except Exception as failure:
        error = str(failure)
        raise
    finally:
        store.log_run(f"{periods[0]}..{last}", FLOW, status, rows, started, error)
    return {"periods": periods, "rows_loaded": rows, "status": status}
