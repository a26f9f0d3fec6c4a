"""Every query by name, over the driver's tables.

Customer and product tables, latest scores and history are built once per application and
folder as staged tables, the way reports share stored tables; everything else is computed
from the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from patronlens.functions import dates, numbers
from patronlens.operators import (clean, dims, facts, ordering, quality, recommend, rfm, scoring,
                                  states)
from patronlens.plans import business, history, segments
from patronlens import schemas as S
from patronlens.schemas import DETAIL_ROWS
from patronlens.sources import files, testtables
from patronlens.sources.warehouse import Warehouse, merge, read_sql
from patronlens.staging import new_path, source_version, stage, stage_once

PERIODS = dates.period_range("1999-01", "2000-01")
PERIOD = PERIODS[-1]  # the latest scores are those of the latest period
PAIR = ("1999-06", "1999-12")
EVENT_CUTOFF = dt.datetime(2024, 1, 15)
SEGMENT = "Loyal Customers"
JOURNEY_CUSTOMER = "7"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(spark, sf_dir))
    _QUERIES[build.__name__] = plain
    return build


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so any SQL engine's result compares equal."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs ---------------------------------------------------------------------------

def _raw(spark, sf_dir, country=False):
    return testtables.retail_lines(spark, sf_dir, country)


def _sales(spark, sf_dir, country=False):
    return clean.transactions(clean.clean_sales(_raw(spark, sf_dir, country)))


def _purchases(spark, sf_dir):
    return clean.transactions(clean.clean_sales(testtables.purchase_lines(spark, sf_dir)))


def _segment_period(spark, sf_dir):
    return scoring.score_and_segment(rfm.period_rfm(_sales(spark, sf_dir), PERIOD))


def _segment_periods(spark, sf_dir):
    return scoring.score_and_segment(rfm.backfill_rfm(_sales(spark, sf_dir), PERIODS))


def _once(spark, label, sf_dir, build):
    """A table shared by reports, until the tables it is made of change."""
    return stage_once(spark, (label, sf_dir, source_version(spark, sf_dir)), label, build)


def _segmented(spark, sf_dir):
    return _once(spark, "period", sf_dir,
                      lambda: _segment_period(spark, sf_dir))


def _segmented_periods(spark, sf_dir):
    return _once(spark, "periods", sf_dir,
                      lambda: _segment_periods(spark, sf_dir))


def _latest(spark, sf_dir):
    return scoring.as_latest(_segmented(spark, sf_dir)).drop("calculated_at")


def _snapshots(spark, sf_dir):
    return scoring.as_snapshot(_segmented_periods(spark, sf_dir))


def _products(spark, sf_dir):
    return _once(spark, "products", sf_dir,
                      lambda: dims.dim_product(_sales(spark, sf_dir)))


def _customers(spark, sf_dir):
    return _once(spark, "customers", sf_dir,
                      lambda: dims.dim_customer(_sales(spark, sf_dir, country=True)))


def _recommended(spark, sf_dir):
    ranked = recommend.recommend(_sales(spark, sf_dir), _segmented(spark, sf_dir), [PERIOD])
    return recommend.describe(ranked, _products(spark, sf_dir))


# --- cleaning and warehouse -------------------------------------------------------------

@_query
def clean_sales(spark, sf_dir):
    return _sales(spark, sf_dir, country=True)


@_query
def clean_stats(spark, sf_dir):
    return clean.clean_stats(_raw(spark, sf_dir))


@_query
def cutoff_slice(spark, sf_dir):
    return clean.filter_by_month(_raw(spark, sf_dir), 1999, 12)


@_query
def dim_customer(spark, sf_dir):
    return dims.dim_customer(_sales(spark, sf_dir, country=True))


@_query
def dim_product(spark, sf_dir):
    return dims.dim_product(_sales(spark, sf_dir))


@_query
def dim_date(spark, sf_dir):
    return dims.dim_date(_sales(spark, sf_dir))


@_query
def dim_geography(spark, sf_dir):
    return dims.dim_geography(_sales(spark, sf_dir, country=True))


@_query
def fact_load(spark, sf_dir):
    return _star(spark, sf_dir)[0]


def _star(spark, sf_dir):
    """Facts with surrogate keys, and the customer, product and country tables with theirs;
    the cleaned lines are written once, all four are made of them."""
    sales = stage(facts.staging_facts(_sales(spark, sf_dir, country=True)), "lines")
    customers, products, geography = [
        ordering.number_rows(sales.select(name).filter(F.col(name).isNotNull()).distinct(),
                             name, key)
        for name, key in (("customer_id", "customer_key"), ("stock_code", "product_key"),
                          ("country", "geo_key"))]
    return (facts.resolve_keys(sales, customers, products, geography),
            customers, products, geography)


def _star_lines(spark, sf_dir):
    """Sales as the reports of the star schema read them: facts joined with their members."""
    return facts.fact_lines(*_star(spark, sf_dir))


@_query
def star_monthly_overview(spark, sf_dir):
    return business.monthly_overview(_star_lines(spark, sf_dir))


@_query
def star_by_country(spark, sf_dir):
    return business.by_country(_star_lines(spark, sf_dir))


@_query
def star_rfm_base(spark, sf_dir):
    return rfm.period_rfm(_star_lines(spark, sf_dir), PERIOD)


@_query
def star_top_products(spark, sf_dir):
    return business.top_products(_star_lines(spark, sf_dir), _products(spark, sf_dir))


# --- merges and month loads ---------------------------------------------------------------

def _customers_of(spark, sf_dir, condition):
    return dims.dim_customer(_sales(spark, sf_dir, country=True).filter(condition))


@_query
def upsert_update(spark, sf_dir):
    """Customers as of mid-1999, merged with those of the later sales: known ones take the
    new country, last order and number of orders."""
    return merge(_customers_of(spark, sf_dir, "invoice_date <= timestamp_ntz'1999-06-30'"),
                 _customers_of(spark, sf_dir, "invoice_date > timestamp_ntz'1999-06-30'"),
                 ["customer_id"], ("country", "last_order", "total_orders"))


@_query
def upsert_ignore(spark, sf_dir):
    """The same two tables, known customers left as they are."""
    return merge(_customers_of(spark, sf_dir, "invoice_date <= timestamp_ntz'1999-06-30'"),
                 _customers_of(spark, sf_dir, "invoice_date > timestamp_ntz'1999-06-30'"),
                 ["customer_id"])


@_query
def upsert_stored(spark, sf_dir):
    """`upsert_update` by way of a stored table, whose second merge rewrites the buckets it
    touches."""
    store = Warehouse(spark, new_path(spark, "warehouse"), bucket_rows=2000)
    for condition in ("invoice_date <= timestamp_ntz'1999-06-30'",
                      "invoice_date > timestamp_ntz'1999-06-30'"):
        store.upsert_keyed("dim_customer", "customer_key", _customers_of(spark, sf_dir, condition),
                           ("country", "last_order", "total_orders"))
    return store.read("dim_customer").select(
        "customer_id", "country", "first_order", "last_order", "total_orders")


def _stored_history(spark, sf_dir):
    store = Warehouse(spark, new_path(spark, "warehouse"))
    store.replace_periods("rfm_snapshot", _snapshots(spark, sf_dir), PERIODS)
    store.register_views()


@_query
def stored_segment_monthly(spark, sf_dir):
    """The stored view of segments by month, asked in SQL with a parameter."""
    _stored_history(spark, sf_dir)
    return read_sql(spark, "SELECT * FROM vw_segment_monthly WHERE period >= :first",
                    {"first": PERIODS[0]})


@_query
def stored_segment_migration(spark, sf_dir):
    """The stored view of moves between segments, asked in SQL with a parameter."""
    _stored_history(spark, sf_dir)
    return read_sql(spark, "SELECT * FROM vw_segment_migration WHERE period_from >= :first",
                    {"first": PERIODS[0]})


# --- months folded into a running state ---------------------------------------------------

def _months(spark, sf_dir, name, reduce):
    lines = _once(spark, "month-lines", sf_dir, lambda: _sales(spark, sf_dir, country=True).withColumn(
        "period", dates.entry_period(F.col("invoice_date"))))
    return _once(spark, name, sf_dir, lambda: reduce(lines))


def _folded(months, through, fold):
    """The state of `through` in three steps, each with the months since the one before."""
    state, done = None, ""
    for border in (PERIODS[0], PERIODS[-2], through):
        new = months.filter((F.col("period") > done) & (F.col("period") <= border))
        state = stage(fold(new.limit(0) if state is None else state, new,
                           months.filter(F.col("period") <= done)), "state")
        done = border
    return state


def _carried_customers(spark, sf_dir, through):
    def fold(state, new, earlier):
        if "total_orders" not in state.columns:
            state = spark.createDataFrame([], S.TABLES["state_customer"])
        return states.fold_customers(state, new, earlier)

    return _folded(_months(spark, sf_dir, "month_invoices", states.month_invoices), through, fold)


@_query
def rfm_carried(spark, sf_dir):
    """`rfm_base` from the state of the period before and one month."""
    return states.rfm_of(_carried_customers(spark, sf_dir, PERIOD), PERIOD)


@_query
def dim_customer_carried(spark, sf_dir):
    countries = _folded(_months(spark, sf_dir, "month_countries", states.month_countries), "9999-12",
                        lambda state, new, _: states.fold_countries(state, new))
    return states.customers(_carried_customers(spark, sf_dir, "9999-12"), countries)


@_query
def dim_product_carried(spark, sf_dir):
    return states.products(_folded(
        _months(spark, sf_dir, "month_products", states.month_products), "9999-12",
        lambda state, new, _: states.fold_products(state, new)))


def _stored_facts(spark, sf_dir):
    """A warehouse in the shared folder that holds all facts, in the periods they enter."""
    store = Warehouse(spark, new_path(spark, "warehouse"))
    resolved = stage(fact_load(spark, sf_dir).withColumn(
        "period", dates.entry_period(F.col("invoice_date"))), "resolved")
    periods = [r.period for r in resolved.select("period").distinct().collect()]  # a row a month
    store.replace_periods("fact_sales", resolved, periods)
    return store


def _fact_counts(store):
    """Counts of all stored facts, those of all periods."""
    return store.read("fact_sales").groupBy("period").agg(
        F.count(F.lit(1)).alias("facts"),
        F.sum(F.col("quantity").cast("bigint")).alias("units"))


def _month_replaced(spark, sf_dir):
    """June 1999 loaded again with its large lines only; other months stay."""
    store = _stored_facts(spark, sf_dir)
    june = stage(store.read("fact_sales").filter("period = '1999-06' AND quantity > 25"), "june")
    store.replace_periods("fact_sales", june, ["1999-06"])
    return store


def _month_deleted(spark, sf_dir):
    """The facts dated in June 1999 removed."""
    store = _stored_facts(spark, sf_dir)
    store.delete_sales_of_month(1999, 6)
    return store


@_query
def facts_month_replaced(spark, sf_dir):
    return _fact_counts(_month_replaced(spark, sf_dir))


@_query
def facts_month_deleted(spark, sf_dir):
    return _fact_counts(_month_deleted(spark, sf_dir))


@_query
def clean_text(spark, sf_dir):
    """The lines as a text file would hold them: parsed, cleaned, and equal to typed ones."""
    raw = _raw(spark, sf_dir, country=True)
    as_text = raw.withColumns({
        S.DATE: F.date_format(S.DATE, "M/d/yyyy H:mm"),
        S.CUSTOMER: F.concat(F.col(S.CUSTOMER).cast("string"), F.lit(".0")),
        S.QUANTITY: F.col(S.QUANTITY).cast("string"), S.PRICE: F.col(S.PRICE).cast("string"),
        S.DESCRIPTION: F.concat(F.lit(" "), F.lower(S.DESCRIPTION), F.lit("\t"))})
    return clean.transactions(clean.clean_sales(as_text))


@_query
def csv_sales(spark, sf_dir):
    """The lines written as CSV files with line breaks inside the descriptions, and read back."""
    raw = _raw(spark, sf_dir, country=True)
    path = new_path(spark, "sales") + ".csv"
    raw.withColumns({
        S.DATE: F.date_format(S.DATE, "M/d/yyyy H:mm"),
        S.DESCRIPTION: F.replace(S.DESCRIPTION, F.lit(" "), F.lit("\n"))}).write.option(
        "header", True).option("escape", '"').csv(path)
    found = clean.transactions(clean.clean_sales(files.extract_csv(spark, path)))
    return found.withColumn("description", F.replace("description", F.lit("\n"), F.lit(" ")))


@_query
def fact_periods(spark, sf_dir):
    """Lines and revenue per entry period, of retail lines and purchase events together."""
    both = [df.select("invoice_no", "invoice_date", "amount_cents") for df in (
        _sales(spark, sf_dir), _purchases(spark, sf_dir))]
    return (both[0].unionByName(both[1])
            .groupBy(dates.entry_period(F.col("invoice_date")).alias("period"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("amount_cents").alias("cents")))


@_query
def dq_unique(spark, sf_dir):
    return quality.duplicate_keys(
        testtables.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query
def dq_orphans(spark, sf_dir):
    """Sales of customers whom a customer table as of the cutoff would not know yet."""
    known = clean.filter_by_month(_raw(spark, sf_dir), 1999, 12)
    parents = clean.transactions(clean.clean_sales(known)).select("customer_id").distinct()
    return quality.orphans(_sales(spark, sf_dir), parents, "customer_id")


@_query
def dq_nulls(spark, sf_dir):
    return quality.null_counts(_sales(spark, sf_dir, country=True), [
        "customer_id", "invoice_no", "stock_code", "invoice_date", "country"])


# --- scores -----------------------------------------------------------------------------

@_query
def rfm_base(spark, sf_dir):
    return rfm.period_rfm(_sales(spark, sf_dir), PERIOD)


@_query
def rfm_base_events(spark, sf_dir):
    sold = rfm.sold_until(_purchases(spark, sf_dir), EVENT_CUTOFF)
    return rfm.compute_rfm(sold, EVENT_CUTOFF.date().isoformat())


@_query
def rfm_base_open(spark, sf_dir):
    """No cutoff: the reference is a day after the latest sale, time of day included."""
    return rfm.compute_rfm(rfm.sold_until(_purchases(spark, sf_dir), None))


@_query
def rfm_thresholds(spark, sf_dir):
    states = _segmented_periods(spark, sf_dir)
    return (scoring.rfm_thresholds(states)
            .select("period", "metric", "n", "method",
                    F.posexplode(F.arrays_zip("quantile_edges", "width_edges")).alias("i", "e"))
            .select("period", "metric", "n", "method", (F.col("i") + 1).alias("edge"),
                    F.round("e.quantile_edges", 6).alias("quantile_edge"),
                    F.round("e.width_edges", 6).alias("width_edge")))


@_query
def rfm_scored(spark, sf_dir):
    return _segmented(spark, sf_dir).drop("segment")


@_query
def rfm_segments(spark, sf_dir):
    return _segment_period(spark, sf_dir)


@_query
def rfm_latest(spark, sf_dir):
    return _latest(spark, sf_dir)


@_query
def rfm_snapshot(spark, sf_dir):
    return scoring.as_snapshot(_segmented(spark, sf_dir))


@_query
def rfm_backfill(spark, sf_dir):
    return scoring.as_snapshot(_segment_periods(spark, sf_dir))


# --- business reports -------------------------------------------------------------------

@_query
def kpi_summary(spark, sf_dir):
    sales = _sales(spark, sf_dir)
    return business.kpi_summary(
        _customers(spark, sf_dir), _products(spark, sf_dir), sales,
        _latest(spark, sf_dir), _snapshots(spark, sf_dir))


@_query
def monthly_overview(spark, sf_dir):
    return business.monthly_overview(_sales(spark, sf_dir))


@_query
def overview_kpis(spark, sf_dir):
    return business.overview_kpis(business.monthly_overview(_sales(spark, sf_dir)), [1998, 1999])


@_query
def year_list(spark, sf_dir):
    return business.year_list(business.monthly_overview(_sales(spark, sf_dir)))


@_query
def top_products(spark, sf_dir):
    return business.top_products(_sales(spark, sf_dir), _products(spark, sf_dir))


@_query
def by_country(spark, sf_dir):
    return business.by_country(_sales(spark, sf_dir, country=True))


@_query
def top_countries(spark, sf_dir):
    return business.top_countries(_sales(spark, sf_dir, country=True))


@_query
def by_weekday(spark, sf_dir):
    return business.by_weekday(_sales(spark, sf_dir))


@_query
def cohort_new_customers(spark, sf_dir):
    return business.cohort_new_customers(_customers(spark, sf_dir))


# --- segment reports --------------------------------------------------------------------

@_query
def segment_distribution(spark, sf_dir):
    return segments.segment_distribution(_latest(spark, sf_dir))


@_query
def segment_summary(spark, sf_dir):
    return segments.segment_summary(_latest(spark, sf_dir))


@_query
def segment_share(spark, sf_dir):
    return segments.segment_share(_latest(spark, sf_dir))


@_query
def segment_scores_long(spark, sf_dir):
    return segments.segment_scores_long(_latest(spark, sf_dir))


@_query
def segment_detail(spark, sf_dir):
    return segments.segment_detail(
        _latest(spark, sf_dir), _customers(spark, sf_dir), SEGMENT)


@_query
def segment_detail_top(spark, sf_dir):
    return segments.segment_detail(
        _latest(spark, sf_dir), _customers(spark, sf_dir), SEGMENT, limit=DETAIL_ROWS)


@_query
def segment_kpis(spark, sf_dir):
    return segments.segment_kpis(_latest(spark, sf_dir), SEGMENT)


@_query
def segment_names(spark, sf_dir):
    return segments.segment_names(_latest(spark, sf_dir))


@_query
def monetary_outliers(spark, sf_dir):
    return segments.monetary_outliers(_latest(spark, sf_dir))


@_query
def monetary_histogram(spark, sf_dir):
    return segments.monetary_histogram(_latest(spark, sf_dir))


@_query
def monetary_boxplot(spark, sf_dir):
    return segments.monetary_boxplot(_latest(spark, sf_dir))


# --- history ----------------------------------------------------------------------------

@_query
def segment_monthly(spark, sf_dir):
    return history.segment_monthly(_snapshots(spark, sf_dir))


@_query
def segment_timeseries(spark, sf_dir):
    return history.segment_timeseries(_snapshots(spark, sf_dir))


@_query
def segment_trend(spark, sf_dir):
    return history.segment_trend(_snapshots(spark, sf_dir), SEGMENT)


@_query
def segment_stats(spark, sf_dir):
    return history.segment_stats(_snapshots(spark, sf_dir), PERIOD)


@_query
def segment_migration(spark, sf_dir):
    return history.segment_migration(_snapshots(spark, sf_dir))


@_query
def migration_pair(spark, sf_dir):
    return history.migration_pair(_snapshots(spark, sf_dir), *PAIR)


@_query
def migration_matrix(spark, sf_dir):
    return history.migration_matrix(history.migration_pair(_snapshots(spark, sf_dir), *PAIR))


@_query
def top_migrations(spark, sf_dir):
    return history.top_migrations(history.migration_pair(_snapshots(spark, sf_dir), *PAIR))


@_query
def customer_growth(spark, sf_dir):
    return history.customer_growth(_snapshots(spark, sf_dir))


@_query
def period_list(spark, sf_dir):
    return history.period_list(_snapshots(spark, sf_dir))


@_query
def journey_candidates(spark, sf_dir):
    return history.journey_candidates(_snapshots(spark, sf_dir))


@_query
def customer_journey(spark, sf_dir):
    return history.customer_journey(_snapshots(spark, sf_dir), JOURNEY_CUSTOMER)


@_query
def journey_latest(spark, sf_dir):
    return history.journey_latest(_snapshots(spark, sf_dir))


# --- recommendations --------------------------------------------------------------------

@_query
def sales_with_segment(spark, sf_dir):
    return recommend.sales_with_segment(
        _sales(spark, sf_dir), _segmented(spark, sf_dir), PERIOD).select(
        "customer_id", "segment", "stock_code", "description",
        F.col("quantity").cast("bigint").alias("quantity"), "total_amount", "invoice_date")


def _star_products(spark, sf_dir):
    return facts.fact_lines(*_star(spark, sf_dir)[:3])


@_query
def star_sales_with_segment(spark, sf_dir):
    """`sales_with_segment` from facts joined with their customers and products."""
    lines = _star_products(spark, sf_dir)
    return recommend.sales_with_segment(lines, _segmented(spark, sf_dir), PERIOD).select(
        "customer_id", "segment", "stock_code", F.col("quantity").cast("bigint").alias("quantity"),
        numbers.to_money(F.col("amount_cents")).alias("total_amount"), "invoice_date")


@_query
def star_recommendations(spark, sf_dir):
    """`recommendations` from facts joined with their customers and products."""
    ranked = recommend.recommend(_star_products(spark, sf_dir), _segmented(spark, sf_dir), [PERIOD])
    return recommend.describe(ranked, _products(spark, sf_dir))


@_query
def recommendations(spark, sf_dir):
    return _recommended(spark, sf_dir)


@_query
def recommendations_backfill(spark, sf_dir):
    ranked = recommend.recommend(_sales(spark, sf_dir), _segmented_periods(spark, sf_dir), PERIODS)
    return recommend.describe(ranked, _products(spark, sf_dir))


@_query
def reco_period(spark, sf_dir):
    return history.reco_period(_recommended(spark, sf_dir), PERIOD)


@_query
def reco_compare(spark, sf_dir):
    return history.reco_compare(_recommended(spark, sf_dir), PERIOD)
