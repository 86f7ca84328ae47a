"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL works on the flat test tables (orders, lineitem, part, customer, nation) and writes the
receipt mapping of ``tillroll.sources.testdata`` in flat form, then each model as plain SQL.
Nothing here is used by the library.
"""

from __future__ import annotations

from tillroll.schemas import NOT_NULL_CONTRACT

# Flat receipts, lines and payments (same fixed values as the Spark mapping).
_BASE = """
rc AS (
  SELECT o.o_orderkey AS okey, copies.k AS copy,
         {reference} AS receipt_ref,
         o.o_orderkey AS sequence_num,
         o.o_orderkey % 5 + 1 AS terminal_num,
         {date} AS receipt_date,
         CAST(o.o_orderdate AS DATE) AS receipt_day,
         CASE WHEN o.o_orderkey % 17 = 0 THEN CAST(0 AS DECIMAL(10,2))
              ELSE CAST(o.o_totalprice AS DECIMAL(10,2)) END AS total_dec,
         o.o_orderpriority AS priority,
         'Clerk#' || CAST(o.o_orderkey % 37 AS VARCHAR) AS cashier_name,
         CAST(n.n_nationkey AS VARCHAR) AS business_abn,
         n.n_name AS business_name,
         o.o_orderkey % 10 <> 0 AS has_customer,
         c.c_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN (VALUES (1), (2)) copies(k) ON {delivered}
),
rcpt AS (
  SELECT *,
         CAST(total_dec AS DOUBLE) AS receipt_total,
         CAST(CAST(total_dec * 0.10 AS DECIMAL(10,2)) AS DOUBLE) AS gst,
         CASE WHEN has_customer THEN c_name END AS customer_name,
         CASE WHEN has_customer THEN CAST(floor(total_dec) AS BIGINT) END AS customer_points
  FROM rc
),
lp AS (
  SELECT rc.okey, rc.copy, rc.receipt_ref,
         p.p_name AS product_name,
         CAST(CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) * 0.6 AS DECIMAL(10,2)) AS DOUBLE)
           AS product_cost,
         CAST({price} AS DOUBLE) AS product_price,
         {quantity} AS product_quantity,
         {discount} AS discount, l.l_discount, l.l_linenumber
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN rc ON rc.okey = l.l_orderkey
),
promo AS (
  SELECT receipt_ref, product_name, discount, CAST(l_linenumber AS BIGINT) AS per_quantity
  FROM lp WHERE l_discount > 0
),
pay AS (
  SELECT receipt_ref, priority AS payment_method, receipt_total AS payment_amount
  FROM rcpt WHERE okey % 7 <> 0
  UNION ALL
  SELECT receipt_ref, 'Cash', CAST(10 AS DOUBLE) FROM rcpt WHERE okey % 7 = 0
  UNION ALL
  SELECT receipt_ref, priority, CAST(total_dec - 10 AS DOUBLE)
  FROM rcpt WHERE okey % 7 = 0
)"""

_MODELS = {
    "n_receipts": """SELECT receipt_ref, sequence_num, receipt_date, gst, terminal_num,
        receipt_total FROM rcpt""",
    "n_businesses": "SELECT receipt_ref, business_abn, business_name FROM rcpt",
    "n_cashiers": "SELECT receipt_ref, cashier_name FROM rcpt",
    "n_customers": "SELECT receipt_ref, customer_name, customer_points FROM rcpt",
    "n_products": """SELECT receipt_ref, product_name, product_cost, product_price,
        product_quantity FROM lp""",
    "m_business_sales": """
      SELECT business_abn, business_name, receipt_ref, receipt_date, receipt_total, gst,
             year(receipt_day) AS "year", month(receipt_day) AS "month",
             monthname(receipt_day) AS month_name
      FROM rcpt""",
    # Exact arithmetic on the delivered values, rounded to cents only in the sums below.
    "m_exact_lines": """
      SELECT receipt_ref, product_name, product_quantity,
             CAST(product_cost AS DECIMAL(20,6)) * CAST(product_quantity AS DECIMAL(12,4)) AS total_cost,
             CAST(product_price AS DECIMAL(20,6)) * CAST(product_quantity AS DECIMAL(12,4)) AS total_price
      FROM n_products""",
    "m_priced_lines": """
      SELECT p.receipt_ref, total_cost, total_price,
             CASE WHEN floor(p.product_quantity / nullif(d.per_quantity, 0)) * d.per_quantity > 0
                       AND d.discount IS NOT NULL
                  THEN CAST(total_price AS DECIMAL(28,10)) * (1 - CAST(d.discount AS DECIMAL(8,7)))
                  ELSE CAST(total_price AS DECIMAL(28,10)) END AS price_after_discount
      FROM m_exact_lines p LEFT JOIN promo d
        ON p.receipt_ref = d.receipt_ref AND p.product_name = d.product_name""",
    "m_sale_profits": """
      SELECT receipt_ref,
             CAST(CAST(sum(total_cost) AS DECIMAL(18,2)) AS DOUBLE) AS total_cost,
             CAST(CAST(sum(total_price) AS DECIMAL(18,2)) AS DOUBLE) AS total_price,
             CAST(CAST(sum(price_after_discount) AS DECIMAL(18,2)) AS DOUBLE)
               AS total_price_after_discount,
             CAST(CAST(sum(price_after_discount - total_cost) AS DECIMAL(18,2)) AS DOUBLE)
               AS total_profit
      FROM m_priced_lines GROUP BY receipt_ref""",
    "m_business_sales_profits": """
      SELECT b.business_abn, b.business_name, b.receipt_date, b."year", b."month", b.month_name,
             b.receipt_ref, b.receipt_total, b.gst, p.total_cost, p.total_price,
             p.total_price_after_discount, p.total_profit
      FROM m_business_sales b JOIN m_sale_profits p ON b.receipt_ref = p.receipt_ref""",
    "m_business_monthly_profits": """
      SELECT business_abn, business_name, "year", "month", month_name,
             CAST(CAST(sum(CAST(total_profit AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE)
               AS total_monthly_profit,
             count(receipt_ref) AS num_of_sales
      FROM m_business_sales_profits
      GROUP BY business_abn, business_name, "year", "month", month_name""",
    "m_business_customers": """
      SELECT receipt_ref, customer_name, business_name, receipt_total AS amount_spent
      FROM rcpt WHERE has_customer AND business_name IS NOT NULL AND total_dec > 0""",
    "m_business_customers_summary": """
      SELECT business_name, customer_name,
             CAST(CAST(sum(CAST(amount_spent AS DECIMAL(18,6))) AS DECIMAL(18,2)) AS DOUBLE)
               AS amount_spent,
             count(receipt_ref) AS num_purchases
      FROM m_business_customers GROUP BY business_name, customer_name""",
    "m_business_employees": """
      SELECT business_name, year(receipt_day) AS "year", month(receipt_day) AS "month",
             monthname(receipt_day) AS month_name, cashier_name
      FROM rcpt
      GROUP BY ALL""",
    "m_business_employee_stats": """
      SELECT business_name, "year", "month", month_name, count(cashier_name) AS num_employees
      FROM m_business_employees GROUP BY business_name, "year", "month", month_name""",
    "m_employees_left": """
      SELECT business_name,
             CASE WHEN last_idx % 12 + 1 >= 7 THEN last_idx // 12
                  ELSE last_idx // 12 - 1 END AS fiscal_year,
             count(*) AS num_employee_left
      FROM (SELECT business_name, cashier_name, max("year" * 12 + "month" - 1) AS last_idx
            FROM m_business_employees WHERE cashier_name IS NOT NULL
            GROUP BY business_name, cashier_name) s
      WHERE last_idx < (SELECT max("year" * 12 + "month" - 1) FROM m_business_employees
                        WHERE cashier_name IS NOT NULL)
      GROUP BY 1, 2""",
    "m_turnover_by_period": """
      SELECT w.business_name, w.fiscal_year,
             'July ' || CAST(w.fiscal_year AS VARCHAR) || ' - June '
               || CAST(w.fiscal_year + 1 AS VARCHAR) AS year_period,
             w."July", w."June",
             (w."July" + w."June") / 2 AS annual_avg_employee,
             CAST(coalesce(l.num_employee_left, 0) AS BIGINT) AS num_employee_left,
             coalesce(l.num_employee_left, 0) / ((w."July" + w."June") / 2) * 100
               AS annual_turnover_rate
      FROM (SELECT business_name,
                   CASE WHEN "month" >= 7 THEN "year" ELSE "year" - 1 END AS fiscal_year,
                   CAST(max(CASE WHEN month_name = 'July' THEN num_employees END) AS DOUBLE)
                     AS "July",
                   CAST(max(CASE WHEN month_name = 'June' THEN num_employees END) AS DOUBLE)
                     AS "June"
            FROM m_business_employee_stats WHERE "month" IN (6, 7)
            GROUP BY 1, 2) w
      LEFT JOIN m_employees_left l
        ON w.business_name = l.business_name AND w.fiscal_year = l.fiscal_year""",
}

_QUERIES = {
    "receipts": "SELECT * FROM n_receipts",
    "receipt_businesses": "SELECT * FROM n_businesses",
    "receipt_cashiers": "SELECT * FROM n_cashiers",
    "receipt_customers": "SELECT * FROM n_customers",
    "receipt_payments": "SELECT receipt_ref, payment_method, payment_amount FROM pay",
    "receipt_products": "SELECT * FROM n_products",
    "receipt_promotions": "SELECT receipt_ref, product_name, discount, per_quantity FROM promo",
    "business_sales": "SELECT * FROM m_business_sales",
    "sale_profits": "SELECT * FROM m_sale_profits",
    "sale_profits_fanout": "SELECT * FROM m_sale_profits",
    "business_sales_profits": "SELECT * FROM m_business_sales_profits",
    "business_monthly_profits": "SELECT * FROM m_business_monthly_profits",
    "monthly_profit_series": """
      SELECT *, CAST("month" AS VARCHAR) || '-' || CAST("year" AS VARCHAR) AS month_year
      FROM m_business_monthly_profits""",
    "business_customers": "SELECT * FROM m_business_customers",
    "business_customers_summary": "SELECT * FROM m_business_customers_summary",
    "top_ten_customers_by_business_value": """
      SELECT business_name, customer_name, amount_spent, num_purchases, ranking FROM (
        SELECT *, row_number() OVER (PARTITION BY business_name
                   ORDER BY amount_spent DESC, num_purchases DESC,
                            customer_name ASC NULLS LAST) AS ranking
        FROM m_business_customers_summary) t
      WHERE ranking <= 10""",
    "top_ten_customers_by_num_purchases": """
      SELECT business_name, customer_name, num_purchases, amount_spent, ranking FROM (
        SELECT *, row_number() OVER (PARTITION BY business_name
                   ORDER BY num_purchases DESC, amount_spent DESC,
                            customer_name ASC NULLS LAST) AS ranking
        FROM m_business_customers_summary) t
      WHERE ranking <= 10""",
    "business_employees": "SELECT * FROM m_business_employees",
    "business_employee_stats": "SELECT * FROM m_business_employee_stats",
    "employee_attendences": """
      SELECT business_name, "year", "month", month_name,
             string_agg(cashier_name, ', ' ORDER BY cashier_name) AS unique_employees
      FROM m_business_employees GROUP BY business_name, "year", "month", month_name""",
    "june_july_headcount": """
      SELECT *, CAST("month" AS VARCHAR) || '-' || CAST("year" AS VARCHAR) AS month_year
      FROM m_business_employee_stats WHERE "month" IN (6, 7)""",
    "employees_left": "SELECT * FROM m_employees_left",
    "turnover_by_period": "SELECT * FROM m_turnover_by_period",
    "turnover_summary": """
      SELECT business_name, round(avg(annual_turnover_rate), 2) AS avg_turnover_rate,
             median(annual_turnover_rate) AS median_turnover_rate
      FROM m_turnover_by_period GROUP BY business_name""",
    "products": """
      SELECT p.receipt_ref, p.product_name, p.product_cost, p.product_price, p.product_quantity,
             coalesce(d.discount, 0.0) AS discount,
             CAST(coalesce(d.per_quantity, 0) AS BIGINT) AS per_quantity
      FROM n_products p LEFT JOIN promo d
        ON p.receipt_ref = d.receipt_ref AND p.product_name = d.product_name""",
    "sales_details": """
      SELECT r.receipt_ref, r.business_name, r.receipt_date,
             month(r.receipt_day) AS "month", year(r.receipt_day) AS "year",
             format('{}-{}', month(r.receipt_day), year(r.receipt_day)) AS month_year,
             p.product_name, p.product_cost, p.product_price, p.product_quantity
      FROM rcpt r JOIN lp p USING (receipt_ref)""",
    "staging_row_count": "SELECT count(*) AS num_rows FROM rcpt",
    "businesses": "SELECT DISTINCT business_name FROM n_businesses",
}

_NORMALISED_SQL = {
    "receipts": "n_receipts", "receipt_businesses": "n_businesses",
    "receipt_cashiers": "n_cashiers", "receipt_customers": "n_customers",
    "receipt_payments": "pay", "receipt_products": "n_products", "receipt_promotions": "promo",
}


def _contract_sql() -> str:
    parts = []
    for table, cols in NOT_NULL_CONTRACT.items():
        for c in cols:
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count "
                f"FROM {_NORMALISED_SQL[table]}")
    return "\nUNION ALL\n".join(parts)


_QUERIES["contract_report"] = _contract_sql()
# The JSON and CSV round trips re-read what Spark wrote from the same tables.
_QUERIES["receipts_from_json"] = _QUERIES["receipts"]
_QUERIES["receipt_products_from_json"] = _QUERIES["receipt_products"]
_QUERIES["receipts_from_csv"] = _QUERIES["receipts"]


# What the variants of the mapping change, in the same terms as the module docstring of the mapping.
_PLAIN = {
    "reference": "CAST(o.o_orderkey AS VARCHAR)",
    "date": "strftime(o.o_orderdate, '%Y/%m/%d')",
    "delivered": "copies.k = 1",
    "price": "CAST(p.p_retailprice AS DECIMAL(10,2))",
    "quantity": "trunc(l.l_quantity)::DOUBLE",
    "discount": "l.l_discount",
}
_FINE_TERMS = {
    "price": "CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) * 1.0003 AS DECIMAL(12,4))",
    "quantity": "l.l_quantity / 4",
    "discount": "l.l_discount / 8",
}
_REPEATED = {
    "reference": "CASE WHEN o.o_orderkey % 97 <> 0 THEN CAST(o.o_orderkey AS VARCHAR) END",
    "delivered": "(copies.k = 1 OR o.o_orderkey % 50 = 0)",
}
_MIXED_DATES = {
    "date": """CASE o.o_orderkey % 3 WHEN 0 THEN strftime(o.o_orderdate, '%Y/%m/%d')
        WHEN 1 THEN strftime(o.o_orderdate, '%Y-%m-%d') ELSE strftime(o.o_orderdate, '%Y/%-m/%-d') END""",
}
# The joins on receipt_ref as plain SQL joins, for receipts that repeat or lack it.
_QUERIES_REPEATED = {
    "business_sales": """
      SELECT b.business_abn, b.business_name, r.receipt_ref, r.receipt_date, r.receipt_total, r.gst,
             year(r.receipt_day) AS "year", month(r.receipt_day) AS "month", monthname(r.receipt_day) AS month_name
      FROM rcpt r JOIN n_businesses b ON r.receipt_ref = b.receipt_ref""",
    "business_employees": """
      SELECT DISTINCT b.business_name, year(r.receipt_day) AS "year", month(r.receipt_day) AS "month",
             monthname(r.receipt_day) AS month_name, c.cashier_name
      FROM n_businesses b JOIN n_cashiers c ON b.receipt_ref = c.receipt_ref JOIN rcpt r ON r.receipt_ref = b.receipt_ref""",
    "sales_details": """
      SELECT r.receipt_ref, b.business_name, r.receipt_date,
             month(r.receipt_day) AS "month", year(r.receipt_day) AS "year",
             format('{}-{}', month(r.receipt_day), year(r.receipt_day)) AS month_year,
             p.product_name, p.product_cost, p.product_price, p.product_quantity
      FROM rcpt r JOIN n_businesses b ON r.receipt_ref = b.receipt_ref JOIN n_products p ON r.receipt_ref = p.receipt_ref""",
}
VARIANTS = {
    "_fine_terms": (_FINE_TERMS, ["sale_profits", "business_monthly_profits"]),
    "_repeated": (_REPEATED, ["business_sales", "sale_profits", "business_sales_profits", "business_monthly_profits",
                              "business_employees", "products", "sales_details"]),
    "_mixed_dates": (_MIXED_DATES, ["business_sales"]),
}


#: Queries whose models are also built load by load, with the same results.
INCREMENTAL = ["business_monthly_profits", "business_monthly_profits_repeated", "business_customers_summary", "employee_attendences",
               "turnover_by_period", "contract_report"]


#: Queries whose models are also built from receipts that went through CSV files by kind.
FROM_CSV = ["receipt_payments", "receipt_products", "receipt_promotions", "business_monthly_profits",
            "business_monthly_profits_repeated", "business_sales_profits_repeated"]


def _with(changes: dict | None = None, models: dict | None = None) -> str:
    ctes = [_BASE.strip().format(**_PLAIN | (changes or {}))]
    ctes += [f"{name} AS ({body})" for name, body in (_MODELS | (models or {})).items()]
    return "WITH " + ",\n".join(ctes) + "\n"


def oracle_queries() -> dict[str, str]:
    out = {k: _with() + v for k, v in _QUERIES.items()}
    for suffix, (changes, names) in VARIANTS.items():
        joined = suffix == "_repeated"
        models = {"m_business_sales": _QUERIES_REPEATED["business_sales"],
                  "m_business_employees": _QUERIES_REPEATED["business_employees"]} if joined else None
        for name in names:
            query = _QUERIES_REPEATED.get(name, _QUERIES[name]) if joined else _QUERIES[name]
            out[name + suffix] = _with(changes, models) + query
    out |= {name + "_incremental": out[name] for name in INCREMENTAL}
    out |= {name + "_from_csv": out[name] for name in FROM_CSV}
    out["orphan_lines_from_csv"] = f"""{_with(_REPEATED)} SELECT kind, receipt_ref, count(*) AS num_lines, max(line) AS last_line FROM (
        SELECT 'Products' AS kind, okey, receipt_ref, row_number() OVER (PARTITION BY okey, copy) AS line FROM lp
        UNION ALL SELECT 'Promotions', okey, receipt_ref, row_number() OVER (PARTITION BY okey, copy) FROM lp WHERE l_discount > 0
        UNION ALL SELECT 'Payments', okey, receipt_ref, unnest(range(1, CASE WHEN okey % 7 = 0 THEN 3 ELSE 2 END)) FROM rcpt) x
      WHERE receipt_ref IS NULL OR okey % 11 = 0 GROUP BY kind, receipt_ref"""
    out["turnover_summary_by_rank"] = out["turnover_summary"]
    one_more = _MODELS["m_employees_left"].replace("count(*) AS num_employee_left", "count(*) + 1 AS num_employee_left")
    out["turnover_with_user_leavers"] = _with(models={"m_employees_left": one_more}) + _QUERIES["turnover_by_period"]
    out["monthly_profits_served"] = f"""{_with()} SELECT business_name, "year", "month", total_monthly_profit, num_of_sales
      FROM ({_QUERIES["business_monthly_profits"]}) m WHERE business_name = 'NATION_7' """
    out["rejected_receipts"] = """SELECT 'bad' AS folder,
      '{"Reference":"' || o_orderkey || '","Total":"no number"}' AS document FROM orders WHERE o_orderkey % 50 = 0"""
    out["load_outcomes"] = """SELECT 'good' AS folder, count(*) AS num_good, 0::BIGINT AS num_bad FROM orders
      UNION ALL SELECT 'bad', 0, count(*) FROM orders WHERE o_orderkey % 50 = 0"""
    fits = [("receipts", c) for c in ("gst", "terminal_num")] + [
        (t, c) for t, cs in {"receipt_customers": ["customer_points"], "receipt_payments": ["payment_amount"],
                             "receipt_products": ["product_cost", "product_price", "product_quantity"],
                             "receipt_promotions": ["discount", "per_quantity"]}.items() for c in cs]
    out["type_report"] = "\n".join(
        [f"SELECT 'receipts' AS table_name, '{c}' AS column_name, count(*) AS misfit_count FROM orders WHERE {misfit} UNION ALL"
         for c, misfit in (("sequence_num", "o_orderkey * 1000000 > 2147483647"), ("receipt_date", "o_orderkey % 13 = 0"),
                           ("receipt_total", "o_orderkey % 7 = 0"))]
        + [" UNION ALL ".join(f"SELECT '{t}', '{c}', 0" for t, c in fits)])
    return out
