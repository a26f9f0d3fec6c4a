"""Each registered query as plain SQL over the same tables, for checking."""

from __future__ import annotations

from patronlens import schemas as S
from patronlens.functions import dates
from patronlens.plans.registry import (JOURNEY_CUSTOMER, PAIR, PERIOD, PERIODS, SEGMENT)

_LINES = """
lines AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || o_orderkey AS invoice_no,
         'P' || l_partkey AS stock_code, upper(trim(p_name)) AS description, p_name,
         l_quantity AS quantity, p_retailprice AS unit_price, o_orderdate AS invoice_date,
         CAST(o_custkey AS VARCHAR) AS customer_id, n_name AS country,
         CAST(round_even(l_quantity * p_retailprice * 100, 0) AS BIGINT) AS cents
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey)"""

_SALES = _LINES + """,
sales AS (SELECT * FROM lines
          WHERE NOT starts_with(invoice_no, 'C') AND quantity > 0 AND unit_price > 0)"""

_PURCHASES = """
purchases AS (
  SELECT CAST(event_id AS VARCHAR) AS invoice_no, CAST(user_id AS VARCHAR) AS customer_id,
         ts AS invoice_date, CAST(round_even(value * 100, 0) AS BIGINT) AS cents
  FROM events WHERE event_type = 'purchase' AND value > 0)"""

_PRODUCTS = """
products AS (
  SELECT stock_code, description FROM (
    SELECT stock_code, description, row_number() OVER (
      PARTITION BY stock_code ORDER BY invoice_date, description) AS nr FROM sales)
  WHERE nr = 1)"""

_CUSTOMERS = """
countries AS (
  SELECT customer_id, country FROM (
    SELECT customer_id, country, row_number() OVER (
      PARTITION BY customer_id ORDER BY count(*) DESC, country) AS nr
    FROM sales GROUP BY customer_id, country) WHERE nr = 1),
customers AS (
  SELECT s.customer_id, any_value(c.country) AS country, min(invoice_date) AS first_order,
         max(invoice_date) AS last_order, count(DISTINCT invoice_no) AS total_orders
  FROM sales s JOIN countries c USING (customer_id) GROUP BY s.customer_id)"""

_FIVE = "".join(f"+ CASE WHEN v / unit > CASE WHEN method = 'quantile' THEN q{k} ELSE w{k} END "
                f"THEN 1 ELSE 0 END " for k in range(1, 5))

# Five equal steps from 0 to 1 as the binning's floats have them.
_FIFTHS = ("0.0e0", "0.2e0", "0.4e0", "0.6000000000000001e0", "0.8e0", "1.0e0")


def _neighbours(k: int) -> str:
    """The two ordered values around the k-th fifth and the position between them."""
    place = f"((n - 1)::DOUBLE * {_FIFTHS[k]})"
    return (f"max(v / unit::DOUBLE) FILTER (WHERE rk = floor({place})) AS a{k}, "
            f"max(v / unit::DOUBLE) FILTER (WHERE rk = least(floor({place}) + 1, n - 1)) AS b{k}, "
            f"any_value({place} - floor({place})) AS t{k}")


def _q(k: int) -> str:
    return (f"CASE WHEN t{k} < 0.5e0 THEN a{k} + (b{k} - a{k}) * t{k} "
            f"ELSE b{k} - (b{k} - a{k}) * (1.0e0 - t{k}) END")


def _case_rules() -> str:
    rules = " ".join(
        f"WHEN r_score BETWEEN {a} AND {b} AND f_score BETWEEN {c} AND {d} "
        f"AND m_score BETWEEN {e} AND {f} THEN '{name}'"
        for name, a, b, c, d, e, f in S.SEGMENT_RULES)
    return f"CASE {rules} ELSE '{S.DEFAULT_SEGMENT}' END"


def _periods(first: str, last: str) -> str:
    return f""",
periods AS (
  SELECT strftime(d, '%Y-%m') AS period, CAST(last_day(d) AS TIMESTAMP) AS cutoff
  FROM (SELECT unnest(generate_series(TIMESTAMP '{first}-01', TIMESTAMP '{last}-01',
                                      INTERVAL 1 MONTH)) AS d)),
base AS (
  SELECT customer_id, period,
         CAST((epoch_us(any_value(cutoff)) + 86400000000 - epoch_us(max(invoice_date)))
              // 86400000000 AS INTEGER) AS recency,
         count(DISTINCT invoice_no) AS frequency,
         CAST(sum(cents) AS BIGINT) AS monetary_cents, max(invoice_date) AS last_purchase
  FROM sales JOIN periods ON invoice_date <= cutoff WHERE cents > 0
  GROUP BY customer_id, period)"""


_SCORED = f""",
long AS (
  SELECT period, customer_id, 'recency' AS metric, CAST(recency AS BIGINT) AS v, 1.0 AS unit FROM base
  UNION ALL SELECT period, customer_id, 'frequency', frequency, 1.0 FROM base
  UNION ALL SELECT period, customer_id, 'monetary', monetary_cents, 100.0 FROM base),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY period, metric ORDER BY v) - 1 AS rk,
         count(*) OVER (PARTITION BY period, metric) AS n FROM long),
around AS (
  SELECT period, metric, any_value(n) AS n, min(v) / any_value(unit)::DOUBLE AS low,
         max(v) / any_value(unit)::DOUBLE AS high, {", ".join(_neighbours(k) for k in range(6))}
  FROM ranked GROUP BY period, metric),
spread AS (
  SELECT period, metric, n, low, high, {", ".join(f"{_q(k)} AS q{k}" for k in range(6))} FROM around),
widened AS (
  SELECT *, CASE WHEN low < high THEN 0.0::DOUBLE WHEN low = 0 THEN 0.001::DOUBLE
                 ELSE 0.001::DOUBLE * abs(low) END AS slack FROM spread),
thresholds AS (
  SELECT *, {", ".join(f"{k}.0::DOUBLE * ((high + slack - (low - slack)) / 5.0::DOUBLE) + (low - slack) AS w{k}" for k in range(1, 5))},
         CASE WHEN q0 < q1 AND q1 < q2 AND q2 < q3 AND q3 < q4 AND q4 < q5
              THEN 'quantile' ELSE 'width' END AS method FROM widened),
marks AS (
  SELECT l.period, l.customer_id, l.metric, 1 {_FIVE} AS mark
  FROM (SELECT period, customer_id, metric, v, unit::DOUBLE AS unit FROM long) l
  JOIN thresholds t ON l.period = t.period AND l.metric = t.metric),
scores AS (
  SELECT period, customer_id,
         CAST(6 - max(CASE WHEN metric = 'recency' THEN mark END) AS INTEGER) AS r_score,
         CAST(max(CASE WHEN metric = 'frequency' THEN mark END) AS INTEGER) AS f_score,
         CAST(max(CASE WHEN metric = 'monetary' THEN mark END) AS INTEGER) AS m_score
  FROM marks GROUP BY period, customer_id),
scored AS (
  SELECT b.*, r_score, f_score, m_score,
         CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score,
         r_score + f_score + m_score AS rfm_total
  FROM base b JOIN scores s ON b.period = s.period AND b.customer_id = s.customer_id),
seg AS (SELECT *, {_case_rules()} AS segment FROM scored),
latest AS (
  SELECT customer_id, recency, frequency, monetary_cents / 100.0::DOUBLE AS monetary, r_score,
         f_score, m_score, rfm_score, rfm_total, segment, period, monetary_cents FROM seg),
snap AS (
  SELECT CAST(last_day(CAST(period || '-01' AS DATE)) AS VARCHAR) AS snapshot_date, customer_id,
         recency, frequency, monetary_cents / 100.0::DOUBLE AS monetary, r_score, f_score,
         m_score, rfm_score, segment, period, monetary_cents FROM seg)"""

_ONE = _SALES + _periods(PERIOD, PERIOD) + _SCORED
_MANY = _SALES + _periods(PERIODS[0], PERIODS[-1]) + _SCORED

_SEG_COLUMNS = ("customer_id, recency, frequency, monetary_cents, last_purchase, period, "
                "r_score, f_score, m_score, rfm_score, rfm_total")
_SNAP_COLUMNS = ("snapshot_date, customer_id, recency, frequency, monetary, r_score, f_score, "
                 "m_score, rfm_score, segment, period")


def _half_up(total: str, count: str, k: int) -> str:
    """total / count to log10(k) digits, halves up, in whole numbers."""
    return f"((2 * ({total}) * {k} + ({count})) // (2 * ({count}))) / {k}.0::DOUBLE"


def _money_mean(total: str, count: str) -> str:
    return f"((2 * ({total}) + ({count})) // (2 * ({count}))) / 100.0::DOUBLE"


def _even(value: str, digits: int) -> str:
    k = 10 ** digits
    return f"round_even(({value}) * {k}.0::DOUBLE, 0) / {k}.0::DOUBLE"


def _metric_case() -> str:
    whens = " ".join(f"WHEN '{s}' THEN '{m}'" for s, m in S.SEGMENT_METRIC.items())
    return f"CASE segment {whens} END"


_RECO = f""",
placed AS (
  SELECT s.stock_code, s.cents, s.quantity, s.invoice_date, g.segment, g.period,
         max(s.invoice_date) OVER (PARTITION BY g.period, g.segment) AS ref
  FROM sales s JOIN seg g ON s.customer_id = g.customer_id
  JOIN periods p ON g.period = p.period AND s.invoice_date <= p.cutoff WHERE s.cents > 0),
sums AS (
  SELECT period, segment, stock_code, {_metric_case()} AS metric, sum(cents) AS cents,
         sum(CAST(quantity AS BIGINT)) AS units,
         sum(1.0::DOUBLE / (1 + (epoch_us(ref) - epoch_us(invoice_date)) // 86400000000)) AS weight
  FROM placed GROUP BY period, segment, stock_code),
topped AS (
  SELECT *, max(cents) OVER w AS top_cents, max(units) OVER w AS top_units,
         max(weight) OVER w AS top_weight
  FROM sums WINDOW w AS (PARTITION BY period, segment)),
points AS (
  SELECT *, CASE metric
    WHEN 'revenue' THEN ((2 * cents * 10000 + top_cents) // (2 * top_cents)) / 100.0::DOUBLE
    WHEN 'recency_weighted' THEN {_even("weight / top_weight * 100.0::DOUBLE", 2)}
    ELSE {_even("units::DOUBLE / top_units::DOUBLE * 100.0::DOUBLE", 2)} END AS score FROM topped),
{_PRODUCTS},
reco AS (
  SELECT segment, stock_code, description, score, CAST(rank AS INTEGER) AS rank, period FROM (
    SELECT *, row_number() OVER (PARTITION BY period, segment ORDER BY score DESC, stock_code) AS rank
    FROM points) JOIN products USING (stock_code) WHERE rank <= {S.TOP_RECOMMENDATIONS})"""

_MONTHLY = f"""
  SELECT year(invoice_date) AS y, month(invoice_date) AS m, count(DISTINCT invoice_no) AS orders,
         count(DISTINCT customer_id) AS customers, sum(cents) AS cents
  FROM sales GROUP BY ALL"""

_MONTHLY_SHOWN = f"""
  SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month,
         y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS ym,
         orders, customers, cents / 100.0::DOUBLE AS revenue,
         {_money_mean("cents", "orders")} AS aov FROM ({_MONTHLY})"""

_SEG_MONTHLY = f"""
  SELECT period, segment, count(*) AS customer_count,
         {_half_up("sum(recency)", "count(*)", 10)} AS avg_recency,
         {_half_up("sum(frequency)", "count(*)", 10)} AS avg_frequency,
         {_money_mean("sum(monetary_cents)", "count(*)")} AS avg_monetary,
         sum(monetary_cents) / 100.0::DOUBLE AS total_revenue
  FROM snap GROUP BY period, segment"""

# One pass: each customer's segments in the two periods side by side.
_PAIR = f"""
  SELECT from_seg, to_seg, count(*) AS customers FROM (
    SELECT max(segment) FILTER (period = '{PAIR[0]}') AS from_seg,
           max(segment) FILTER (period = '{PAIR[1]}') AS to_seg
    FROM snap GROUP BY customer_id)
  WHERE from_seg IS NOT NULL AND to_seg IS NOT NULL GROUP BY 1, 2"""

_P95 = """,
limits AS (
  SELECT segment, max(v) AS top, any_value(n) AS n,
         max(CASE WHEN rk = ((n - 1) * 19) // 20 THEN v END) * (20 - ((any_value(n) - 1) * 19) % 20)
         + max(CASE WHEN rk = ((n - 1) * 19 + 19) // 20 THEN v END) * (((any_value(n) - 1) * 19) % 20)
         AS p95_x20
  FROM (SELECT segment, monetary_cents AS v, count(*) OVER (PARTITION BY segment) AS n,
               row_number() OVER (PARTITION BY segment ORDER BY monetary_cents) - 1 AS rk
        FROM latest) GROUP BY segment)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _detail(limit: str = "") -> str:
    return _with(_ONE + "," + _CUSTOMERS, f"""
        SELECT l.customer_id, recency, frequency, monetary, rfm_score, country
        FROM latest l LEFT JOIN customers c ON l.customer_id = c.customer_id
        WHERE segment = '{SEGMENT}' ORDER BY monetary DESC, l.customer_id {limit}""")


def oracle_sql() -> dict[str, str]:
    sql = {}

    # cleaning and warehouse
    sql["clean_sales"] = _with(_SALES, """
        SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price,
               customer_id, country, cents AS amount_cents, cents / 100.0::DOUBLE AS total_amount
        FROM sales""")
    sql["clean_stats"] = _with(_SALES, f"""
        SELECT a AS rows_before, b AS rows_after, a - b AS rows_dropped,
               {_even("(a - b) / a::DOUBLE * 100.0::DOUBLE", 1)} AS dropped_pct
        FROM (SELECT (SELECT count(*) FROM lines) AS a, (SELECT count(*) FROM sales) AS b)""")
    sql["cutoff_slice"] = _with(_LINES, """
        SELECT invoice_no AS InvoiceNo, stock_code AS StockCode, p_name AS Description,
               quantity AS Quantity, invoice_date AS InvoiceDate, unit_price AS UnitPrice,
               CAST(customer_id AS BIGINT) AS CustomerID
        FROM lines WHERE invoice_date <= TIMESTAMP '1999-12-31 00:00:00'""")
    sql["dim_customer"] = _with(_SALES + "," + _CUSTOMERS, "SELECT * FROM customers")
    sql["dim_product"] = _with(_SALES + "," + _PRODUCTS, "SELECT * FROM products")
    sql["dim_date"] = _with(_SALES, """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
               strftime(d, '%Y-%m-%d') AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
               monthname(d) AS month_name, CAST(week(d) AS INTEGER) AS week,
               CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
               isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(min(invoice_date), max(invoice_date),
                                            INTERVAL 1 DAY)) AS d FROM sales)""")
    sql["dim_geography"] = _with(_SALES, "SELECT DISTINCT country FROM sales")
    sql["fact_load"] = _with(_SALES + """,
        c AS (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key
              FROM (SELECT DISTINCT customer_id FROM sales)),
        p AS (SELECT stock_code, row_number() OVER (ORDER BY stock_code) AS product_key
              FROM (SELECT DISTINCT stock_code FROM sales)),
        g AS (SELECT country, row_number() OVER (ORDER BY country) AS geo_key
              FROM (SELECT DISTINCT country FROM sales))""", """
        SELECT invoice_no, customer_key, product_key,
               CAST(strftime(invoice_date, '%Y%m%d') AS INTEGER) AS date_key, geo_key,
               CAST(quantity AS INTEGER) AS quantity, unit_price,
               cents / 100.0::DOUBLE AS total_amount, invoice_date
        FROM sales JOIN c USING (customer_id) JOIN p USING (stock_code) JOIN g USING (country)""")
    sql["clean_text"] = sql["clean_sales"]  # the given dates have whole minutes
    early, late = "invoice_date <= TIMESTAMP '1999-06-30'", "invoice_date > TIMESTAMP '1999-06-30'"
    both = ""
    for name, when in (("old", early), ("new", late)):
        both += _CUSTOMERS.replace("countries", f"countries_{name}").replace(
            "customers AS", f"{name} AS").replace("sales", f"sales_{name}").replace(
            "countries_" + name + " AS", f", countries_{name} AS" if name == "new"
            else f"countries_{name} AS", 1)
    halves = (f", sales_old AS (SELECT * FROM sales WHERE {early}),"
              f" sales_new AS (SELECT * FROM sales WHERE {late}),")
    for query, takes in (("upsert_update", "n"), ("upsert_ignore", "o")):
        keeps = "o" if takes == "n" else "n"
        sql[query] = _with(_SALES + halves + both, f"""
            SELECT customer_id, coalesce({takes}.country, {keeps}.country) AS country,
                   coalesce(o.first_order, n.first_order) AS first_order,
                   coalesce({takes}.last_order, {keeps}.last_order) AS last_order,
                   coalesce({takes}.total_orders, {keeps}.total_orders) AS total_orders
            FROM old o FULL JOIN new n USING (customer_id)""")
    counts = """
        SELECT strftime(CASE WHEN invoice_date <= CAST(last_day(invoice_date) AS TIMESTAMP)
                             THEN invoice_date ELSE invoice_date + INTERVAL 1 DAY END,
                        '%Y-%m') AS period,
               count(*) AS facts, CAST(sum(CAST(quantity AS INTEGER)) AS BIGINT) AS units
        FROM sales WHERE """
    june = "invoice_date >= TIMESTAMP '1999-06-01' AND invoice_date < TIMESTAMP '1999-07-01'"
    sql["facts_month_deleted"] = _with(_SALES, f"{counts} NOT ({june}) GROUP BY 1")
    sql["facts_month_replaced"] = _with(_SALES, f"""{counts}
        NOT (quantity <= 25 AND invoice_date > TIMESTAMP '1999-05-31'
             AND invoice_date <= TIMESTAMP '1999-06-30') GROUP BY 1""")
    sql["fact_periods"] = _with(_SALES + "," + _PURCHASES, """
        SELECT strftime(CASE WHEN invoice_date <= CAST(last_day(invoice_date) AS TIMESTAMP)
                             THEN invoice_date ELSE invoice_date + INTERVAL 1 DAY END,
                        '%Y-%m') AS period,
               count(*) AS lines, CAST(sum(cents) AS BIGINT) AS cents
        FROM (SELECT invoice_date, cents FROM sales
              UNION ALL SELECT invoice_date, cents FROM purchases) GROUP BY 1""")
    sql["dq_unique"] = """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY ALL HAVING count(*) > 1"""
    sql["dq_orphans"] = _with(_SALES, """
        SELECT customer_id, count(*) AS rows_affected FROM sales
        WHERE customer_id NOT IN (SELECT customer_id FROM sales
                                  WHERE invoice_date <= TIMESTAMP '1999-12-31 00:00:00')
        GROUP BY customer_id""")
    sql["dq_nulls"] = _with(_SALES, "SELECT " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in (
            "customer_id", "invoice_no", "stock_code", "invoice_date", "country")) + " FROM sales")

    # scores
    sql["rfm_base"] = _with(_SALES + _periods(PERIOD, PERIOD), "SELECT * FROM base")
    sql["rfm_base_events"] = _with(_PURCHASES, """
        SELECT customer_id, CAST((epoch_us(TIMESTAMP '2024-01-16 00:00:00')
                  - epoch_us(max(invoice_date))) // 86400000000 AS INTEGER) AS recency,
               count(DISTINCT invoice_no) AS frequency,
               CAST(sum(cents) AS BIGINT) AS monetary_cents, max(invoice_date) AS last_purchase
        FROM purchases WHERE cents > 0 AND invoice_date <= TIMESTAMP '2024-01-15 00:00:00'
        GROUP BY customer_id""")
    sql["rfm_base_open"] = _with(_PURCHASES, """
        SELECT customer_id, CAST(((SELECT epoch_us(max(invoice_date)) FROM purchases WHERE cents > 0)
                  + 86400000000 - epoch_us(max(invoice_date))) // 86400000000 AS INTEGER) AS recency,
               count(DISTINCT invoice_no) AS frequency,
               CAST(sum(cents) AS BIGINT) AS monetary_cents, max(invoice_date) AS last_purchase
        FROM purchases WHERE cents > 0 GROUP BY customer_id""")
    sql["rfm_thresholds"] = _with(_MANY, "\nUNION ALL ".join(
        f"SELECT period, metric, n, method, {k} AS edge, round(q{k}, 6) AS quantile_edge, "
        f"round(w{k}, 6) AS width_edge FROM thresholds" for k in range(1, 5)))
    sql["rfm_scored"] = _with(_ONE, f"SELECT {_SEG_COLUMNS} FROM scored")
    sql["rfm_segments"] = _with(_ONE, f"SELECT {_SEG_COLUMNS}, segment FROM seg")
    sql["rfm_latest"] = _with(_ONE, """
        SELECT customer_id, recency, frequency, monetary, r_score, f_score, m_score, rfm_score,
               rfm_total, segment, period FROM latest""")
    sql["rfm_snapshot"] = _with(_ONE, f"SELECT {_SNAP_COLUMNS} FROM snap")
    sql["rfm_backfill"] = _with(_MANY, f"SELECT {_SNAP_COLUMNS} FROM snap")

    # business reports
    sql["kpi_summary"] = _with(_MANY, f"""
        SELECT customers, products, orders, cents / 100.0::DOUBLE AS revenue,
               (SELECT count(*) FROM snap WHERE period = '{PERIOD}') AS rfm_count,
               (SELECT count(DISTINCT period) FROM snap) AS periods,
               (SELECT max(period) FROM snap) AS latest_period,
               CASE WHEN cents >= 100000000 THEN printf('£%.1fM', cents / 100000000.0::DOUBLE)
                    WHEN cents >= 100000 THEN printf('£%.1fK', cents / 100000.0::DOUBLE)
                    ELSE printf('£%.0f', cents / 100.0::DOUBLE) END AS revenue_label
        FROM (SELECT count(DISTINCT customer_id) AS customers, count(DISTINCT stock_code) AS products,
                     count(DISTINCT invoice_no) AS orders, sum(cents) AS cents FROM sales)""")
    sql["monthly_overview"] = _with(_SALES, _MONTHLY_SHOWN)
    sql["overview_kpis"] = _with(_SALES, f"""
        SELECT sum(cents) / 100.0::DOUBLE AS revenue, CAST(sum(orders) AS BIGINT) AS orders,
               CAST(sum(customers) AS BIGINT) AS customers,
               {_money_mean("sum(aov_cents)", "count(*)")} AS avg_aov
        FROM (SELECT *, (2 * cents + orders) // (2 * orders) AS aov_cents FROM ({_MONTHLY}))
        WHERE y IN (1998, 1999)""")
    sql["year_list"] = _with(_SALES, """
        SELECT DISTINCT CAST(year(invoice_date) AS INTEGER) AS year FROM sales""")
    sql["top_products"] = _with(_SALES + "," + _PRODUCTS, f"""
        SELECT stock_code, description, cents / 100.0::DOUBLE AS revenue, units_sold, orders,
               customers, stock_code || '  ' || substr(description, 1, 24) AS label
        FROM (SELECT stock_code, sum(cents) AS cents,
                     CAST(sum(CAST(quantity AS BIGINT)) AS BIGINT) AS units_sold,
                     count(DISTINCT invoice_no) AS orders, count(DISTINCT customer_id) AS customers
              FROM sales GROUP BY stock_code) JOIN products USING (stock_code)
        ORDER BY cents DESC, stock_code LIMIT {S.TOP_PRODUCTS}""")
    country = """
        SELECT country, count(DISTINCT customer_id) AS customers,
               sum(cents) / 100.0::DOUBLE AS revenue, count(DISTINCT invoice_no) AS orders
        FROM sales GROUP BY country"""
    sql["by_country"] = _with(_SALES, country)
    sql["top_countries"] = _with(
        _SALES, country + f" ORDER BY sum(cents) DESC, country LIMIT {S.TOP_COUNTRIES}")
    sql["by_weekday"] = _with(_SALES, """
        SELECT dayname(invoice_date) AS day_name, CAST(isodow(invoice_date) - 1 AS INTEGER)
               AS day_of_week, count(DISTINCT invoice_no) AS orders,
               sum(cents) / 100.0::DOUBLE AS revenue
        FROM sales GROUP BY 1, 2""")
    sql["cohort_new_customers"] = _with(_SALES, """
        SELECT strftime(first_order, '%Y-%m') AS cohort_month, count(*) AS new_customers
        FROM (SELECT customer_id, min(invoice_date) AS first_order FROM sales GROUP BY 1) GROUP BY 1""")

    # segment reports
    sql["segment_distribution"] = _with(_ONE, f"""
        SELECT segment, n, {_even("n / (sum(n) OVER ())::DOUBLE * 100.0::DOUBLE", 1)} AS pct
        FROM (SELECT segment, count(*) AS n FROM latest GROUP BY segment)""")
    sql["segment_summary"] = _with(_ONE, f"""
        SELECT segment, count(*) AS customers,
               {_even("sum(recency) / count(*)::DOUBLE", 1)} AS avg_recency,
               {_even("sum(frequency) / count(*)::DOUBLE", 1)} AS avg_frequency,
               {_half_up("sum(monetary_cents)", "count(*) * 100", 10)} AS avg_monetary,
               ((sum(monetary_cents) + 5) // 10) / 10.0::DOUBLE AS total_revenue
        FROM latest GROUP BY segment""")
    sql["segment_share"] = _with(_ONE, f"""
        SELECT segment, customers, {_even("customers / (sum(customers) OVER ())::DOUBLE", 6)}
               AS customer_share, cents / 100.0::DOUBLE AS revenue,
               {_even("cents / (sum(cents) OVER ())::DOUBLE", 6)} AS revenue_share
        FROM (SELECT segment, count(*) AS customers, sum(monetary_cents) AS cents
              FROM latest GROUP BY segment)""")
    sql["segment_scores_long"] = _with(_ONE, "\nUNION ALL ".join(
        f"SELECT segment, '{name}' AS indicator, "
        f"{_even(f'sum({c}) / count(*)::DOUBLE', 2)} AS value FROM latest GROUP BY segment"
        for c, name in (("r_score", "Recency"), ("f_score", "Frequency"), ("m_score", "Monetary"))))
    sql["segment_detail"] = _detail()
    sql["segment_detail_top"] = _detail(f"LIMIT {S.DETAIL_ROWS}")
    sql["segment_kpis"] = _with(_ONE, f"""
        SELECT count(*) AS customers, {_even("sum(recency) / count(*)::DOUBLE", 0)} AS avg_recency,
               {_even("sum(frequency) / count(*)::DOUBLE", 1)} AS avg_frequency,
               {_half_up("sum(monetary_cents)", "count(*) * 100", 10)} AS avg_monetary
        FROM latest WHERE segment = '{SEGMENT}'""")
    sql["segment_names"] = _with(_ONE, "SELECT DISTINCT segment FROM latest")
    sql["monetary_outliers"] = _with(_ONE + _P95, """
        SELECT l.segment, any_value(p95_x20) / 2000.0::DOUBLE AS p95,
               any_value(top) / 100.0::DOUBLE AS max_monetary,
               any_value(top) * 40 > any_value(p95_x20) * 3 AS has_outlier,
               count(*) FILTER (WHERE monetary_cents * 20 > p95_x20) AS customers_above_p95
        FROM latest l JOIN limits USING (segment) GROUP BY l.segment""")
    sql["monetary_histogram"] = _with(_ONE + _P95, """
        SELECT segment, CAST(least((monetary_cents * 6000) // (p95_x20 * 11), 30) + 1 AS INTEGER) AS bin,
               count(*) AS customers
        FROM latest JOIN limits USING (segment) GROUP BY 1, 2""")
    sql["monetary_boxplot"] = _with(_ONE + """,
        box AS (
          SELECT segment, count(*) AS customers, min(monetary_cents) AS low, max(monetary_cents) AS high,
                 quantile_cont(monetary_cents::DOUBLE, 0.25) AS q1,
                 quantile_cont(monetary_cents::DOUBLE, 0.5) AS q2,
                 quantile_cont(monetary_cents::DOUBLE, 0.75) AS q3
          FROM latest GROUP BY segment)""", """
        SELECT segment, any_value(customers) AS customers, any_value(low) / 100.0::DOUBLE AS min,
               any_value(q1) / 100.0::DOUBLE AS q1, any_value(q2) / 100.0::DOUBLE AS median,
               any_value(q3) / 100.0::DOUBLE AS q3, any_value(high) / 100.0::DOUBLE AS max,
               min(monetary_cents) FILTER (WHERE inside) / 100.0::DOUBLE AS lower_fence,
               max(monetary_cents) FILTER (WHERE inside) / 100.0::DOUBLE AS upper_fence
        FROM (SELECT *, monetary_cents BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
              FROM latest JOIN box USING (segment)) GROUP BY segment""")

    # history
    sql["segment_monthly"] = _with(_MANY, _SEG_MONTHLY)
    sql["segment_timeseries"] = _with(_MANY, """
        SELECT period, segment, count(*) AS n, sum(monetary_cents) / 100.0::DOUBLE AS revenue
        FROM snap GROUP BY period, segment""")
    sql["segment_trend"] = _with(
        _MANY, f"SELECT * FROM ({_SEG_MONTHLY}) WHERE segment = '{SEGMENT}'")
    sql["segment_stats"] = _with(_MANY, f"""
        SELECT segment, count(*) AS customers,
               {_money_mean("sum(monetary_cents)", "count(*)")} AS avg_monetary,
               {_half_up("sum(frequency)", "count(*)", 100)} AS avg_orders
        FROM snap WHERE period = '{PERIOD}' GROUP BY segment""")
    sql["segment_migration"] = _with(_MANY, """
        SELECT period_from, period_to, segment_from, segment_to, count(*) AS customer_count
        FROM (SELECT period AS period_from, segment AS segment_from,
                     lead(period) OVER w AS period_to, lead(segment) OVER w AS segment_to
              FROM snap WINDOW w AS (PARTITION BY customer_id ORDER BY period))
        WHERE segment_to <> segment_from GROUP BY ALL""")
    sql["migration_pair"] = _with(_MANY, _PAIR)
    cells = ", ".join(f"CAST(coalesce(sum(customers) FILTER (WHERE to_seg = '{s}'), 0) AS BIGINT) "
                      f"AS \"{s}\"" for s in S.SEGMENTS)
    names = ", ".join(f"('{s}')" for s in S.SEGMENTS)
    sql["migration_matrix"] = _with(_MANY, f"""
        SELECT name AS from_seg, {cells} FROM (VALUES {names}) t(name)
        LEFT JOIN ({_PAIR}) ON from_seg = name GROUP BY name""")
    sql["top_migrations"] = _with(_MANY, f"""
        SELECT * FROM ({_PAIR}) WHERE from_seg <> to_seg
        ORDER BY customers DESC, from_seg, to_seg LIMIT {S.TOP_MOVES}""")
    sql["customer_growth"] = _with(_MANY, """
        SELECT count(*) AS periods, min(period) AS first_period, max(period) AS last_period,
               arg_min(n, period) AS first_customers, arg_max(n, period) AS last_customers,
               arg_max(n, period) - arg_min(n, period) AS growth
        FROM (SELECT period, count(*) AS n FROM snap GROUP BY period)""")
    sql["period_list"] = _with(_MANY, "SELECT DISTINCT period FROM snap")
    sql["journey_candidates"] = _with(_MANY, f"""
        SELECT * FROM (SELECT customer_id, count(*) AS n_periods FROM snap GROUP BY customer_id)
        WHERE n_periods >= {S.JOURNEY_MIN_PERIODS}
        ORDER BY n_periods DESC, customer_id LIMIT {S.JOURNEY_CANDIDATES}""")
    sql["customer_journey"] = _with(_MANY, f"""
        SELECT period, segment, recency, frequency, monetary, r_score, f_score, m_score,
               r_score + f_score + m_score AS rfm_total,
               monetary_cents / 10000.0::DOUBLE AS monetary_per_100,
               split_part(segment, ' ', 1) AS label
        FROM snap WHERE customer_id = '{JOURNEY_CUSTOMER}'""")
    sql["journey_latest"] = _with(_MANY, """
        SELECT customer_id, count(*) AS n_periods, max(period) AS latest_period,
               arg_max(segment, period) AS current_segment, arg_max(monetary, period) AS latest_monetary
        FROM snap GROUP BY customer_id""")

    # recommendations
    sql["sales_with_segment"] = _with(_ONE, f"""
        SELECT s.customer_id, segment, stock_code, description, CAST(quantity AS BIGINT) AS quantity,
               cents / 100.0::DOUBLE AS total_amount, invoice_date
        FROM sales s JOIN seg ON s.customer_id = seg.customer_id
        WHERE cents > 0 AND invoice_date <= TIMESTAMP '{dates.cutoff(PERIOD)}'""")
    sql["recommendations"] = _with(_ONE + _RECO, "SELECT * FROM reco")
    sql["recommendations_backfill"] = _with(_MANY + _RECO, "SELECT * FROM reco")
    sql["reco_period"] = _with(_ONE + _RECO, """
        SELECT segment, stock_code, description, score, rank,
               stock_code || '  ' || substr(description, 1, 28) AS label FROM reco""")
    sql["reco_compare"] = _with(_ONE + _RECO, f"""
        SELECT segment, rank, stock_code, substr(description, 1, 26) AS short_description, score
        FROM reco WHERE rank <= {S.COMPARE_ROWS}""")
    for name in ("monthly_overview", "by_country", "rfm_base", "top_products"):
        sql[f"star_{name}"] = sql[name]
    # the same results by other ways
    for name, same in (("csv_sales", "clean_sales"), ("upsert_stored", "upsert_update"),
                       ("rfm_carried", "rfm_base"), ("dim_customer_carried", "dim_customer"),
                       ("dim_product_carried", "dim_product"),
                       ("stored_segment_monthly", "segment_monthly"),
                       ("stored_segment_migration", "segment_migration"),
                       ("star_recommendations", "recommendations")):
        sql[name] = sql[same]
    sql["star_sales_with_segment"] = f"""
        SELECT customer_id, segment, stock_code, quantity, total_amount, invoice_date
        FROM ({sql["sales_with_segment"]})"""
    return sql
