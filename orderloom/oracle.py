"""Reference SQL for DuckDB: every query again, written from the source tables.

Each text starts from the registered views. Shared parts are common table expressions; a query
lists the ones it needs and `_sql` puts them in front in this order.
"""

from __future__ import annotations

PARTS: dict[str, str] = {}

PARTS["numbered"] = """
SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    CAST(l_quantity AS INTEGER) AS quantity,
    CAST(row_number() OVER (
        PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity,
            l_discount, l_tax, l_returnflag, l_linestatus
    ) AS INTEGER) AS line_number
FROM lineitem
"""

PARTS["priced"] = """
SELECT n.l_linenumber, n.l_quantity, n.l_discount,
    printf('TXN%07d', n.l_orderkey) AS transaction_id,
    n.line_number,
    CAST(o.o_orderdate AS DATE) AS order_date,
    printf('CUST%05d', o.o_custkey) AS customer_id,
    printf('PROD%05d', p.p_partkey) AS product_id,
    p.p_name AS product_name,
    p.p_type AS product_category,
    CAST(CAST((2 * n.cents + n.quantity) // (2 * n.quantity) AS DECIMAL(14, 0))
        * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(12, 2)) AS unit_price,
    n.quantity,
    CAST(n.l_discount AS DECIMAL(5, 4)) AS discount,
    CAST(p.p_retailprice AS DECIMAL(12, 2)) AS unit_cost,
    r.r_name AS customer_region,
    o.o_orderpriority AS sales_channel
FROM numbered n
JOIN orders o ON o.o_orderkey = n.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation a ON a.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = a.n_regionkey
JOIN part p ON p.p_partkey = n.l_partkey
"""

PARTS["measured"] = """
SELECT *,
    CAST(round(unit_price * quantity * (CAST(1 AS DECIMAL(5, 4)) - discount), 2)
        AS DECIMAL(14, 2)) AS revenue,
    CAST(round(unit_cost * quantity, 2) AS DECIMAL(14, 2)) AS total_cost
FROM priced
"""

PARTS["sales"] = """
SELECT *, CAST(revenue - total_cost AS DECIMAL(14, 2)) AS profit,
    CAST(year(order_date) AS INTEGER) AS year
FROM measured
"""

# The faulty texts, chosen by source quantity and discount.
PARTS["dirty"] = """
SELECT transaction_id,
    CASE WHEN l_quantity = 38 AND l_discount = 0.0 THEN '0' || CAST(l_linenumber AS VARCHAR)
         WHEN l_quantity = 38 AND l_discount = 0.01 THEN CAST(l_linenumber AS VARCHAR) || '.0'
         ELSE CAST(l_linenumber AS VARCHAR) END AS line_number,
    CASE WHEN l_quantity = 50 AND l_discount = 0.0 THEN 'not a date'
         WHEN l_quantity = 50 AND l_discount = 0.01 THEN '1997-13-01'
         ELSE CAST(order_date AS VARCHAR) END AS order_date,
    customer_id, product_id, product_name,
    CASE WHEN l_quantity = 41 AND l_discount = 0.0 THEN 'MISFILED'
         ELSE product_category END AS product_category,
    CASE WHEN l_quantity = 46 AND l_discount = 0.0 THEN '0.00'
         WHEN l_quantity = 46 AND l_discount = 0.01 THEN 'dear'
         ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
    CASE WHEN l_quantity = 48 AND l_discount = 0.0 THEN '2.5'
         WHEN l_quantity = 48 AND l_discount = 0.01 THEN 'many'
         WHEN l_quantity = 47 AND l_discount = 0.0 THEN '0'
         WHEN l_quantity = 47 AND l_discount = 0.01 THEN '-3'
         ELSE CAST(quantity AS VARCHAR) END AS quantity,
    CASE WHEN l_quantity = 44 AND l_discount = 0.0 THEN '1.5'
         WHEN l_quantity = 44 AND l_discount = 0.01 THEN '-0.1'
         WHEN l_quantity = 44 AND l_discount = 0.02 THEN '1500'
         ELSE CAST(discount AS VARCHAR) END AS discount,
    CASE WHEN l_quantity = 45 AND l_discount = 0.0 THEN '-1.00'
         WHEN l_quantity = 43 AND l_discount = 0.0 THEN CAST(revenue + 1 AS VARCHAR)
         ELSE CAST(revenue AS VARCHAR) END AS revenue,
    CASE WHEN l_quantity = 39 AND l_discount = 0.0 THEN NULL
         WHEN l_quantity = 39 AND l_discount = 0.01 THEN '-2.00'
         ELSE CAST(unit_cost AS VARCHAR) END AS unit_cost,
    CAST(total_cost AS VARCHAR) AS total_cost,
    CAST(profit AS VARCHAR) AS profit,
    CASE WHEN l_quantity = 49 AND l_discount = 0.0 THEN NULL
         WHEN l_quantity = 42 AND l_discount = 0.0 THEN 'ATLANTIS'
         ELSE customer_region END AS customer_region,
    CASE WHEN l_quantity = 40 AND l_discount = 0.0 THEN 'FAX'
         ELSE sales_channel END AS sales_channel
FROM sales
"""

PARTS["parsed"] = """
SELECT *,
    CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS p_date,
    CASE WHEN TRY_CAST(quantity AS DOUBLE) = floor(TRY_CAST(quantity AS DOUBLE))
         THEN TRY_CAST(quantity AS INTEGER) END AS p_quantity,
    TRY_CAST(line_number AS INTEGER) AS p_line,
    TRY_CAST(unit_price AS DECIMAL(14, 4)) AS p_price,
    TRY_CAST(unit_cost AS DECIMAL(14, 4)) AS p_cost,
    TRY_CAST(discount AS DECIMAL(8, 4)) AS p_discount,
    TRY_CAST(revenue AS DECIMAL(16, 2)) AS p_revenue,
    TRY_CAST(total_cost AS DECIMAL(16, 2)) AS p_total,
    TRY_CAST(profit AS DECIMAL(16, 2)) AS p_profit
FROM dirty
"""

PARTS["judged"] = """
SELECT *,
    round(p_price * p_quantity * (CAST(1 AS DECIMAL(8, 4)) - p_discount), 2) AS e_revenue,
    round(p_cost * p_quantity, 2) AS e_total,
    round(p_price * p_quantity * (CAST(1 AS DECIMAL(8, 4)) - p_discount), 2)
        - round(p_cost * p_quantity, 2) AS e_profit
FROM parsed
"""

PARTS["dim_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
    CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
    monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(year(d) AS INTEGER) AS year, dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend
FROM (
    SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS d
    FROM sales
)
"""

PARTS["dim_customer"] = """
SELECT CAST(row_number() OVER (ORDER BY customer_id) AS INTEGER) AS customer_key, *
FROM (SELECT DISTINCT customer_id, customer_region AS region FROM sales)
"""

PARTS["dim_category"] = """
SELECT CAST(row_number() OVER (ORDER BY category_name) AS INTEGER) AS category_key, *
FROM (SELECT DISTINCT product_category AS category_name FROM sales)
"""

PARTS["dim_product"] = """
SELECT CAST(row_number() OVER (ORDER BY product_id) AS INTEGER) AS product_key,
    product_id, product_name, category_key
FROM (SELECT DISTINCT product_id, product_name, product_category FROM sales) p
JOIN dim_category c ON c.category_name = p.product_category
"""

PARTS["dim_channel"] = """
SELECT CAST(row_number() OVER (ORDER BY channel_name) AS INTEGER) AS channel_key, *
FROM (SELECT DISTINCT sales_channel AS channel_name FROM sales)
"""

PARTS["fact_sales"] = """
SELECT row_number() OVER (
        ORDER BY order_date, transaction_id, line_number
    ) AS sales_key,
    transaction_id, line_number, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
    customer_key, product_key, channel_key, quantity, unit_price, discount, revenue, unit_cost,
    total_cost, profit
FROM sales s
JOIN dim_customer USING (customer_id)
JOIN dim_product USING (product_id)
JOIN dim_channel h ON h.channel_name = s.sales_channel
"""

# The broken warehouse: rows missing, repeated or damaged in every table.
PARTS["bad_date"] = """
SELECT * REPLACE (
    CASE WHEN day = 28 THEN full_date + 1 ELSE full_date END AS full_date,
    CASE WHEN day = 30 THEN 32 ELSE day END AS day,
    CASE WHEN month = 11 THEN 13 ELSE month END AS month,
    CASE WHEN day = 31 THEN 'a long month' ELSE month_name END AS month_name,
    CASE WHEN day = 29 THEN 5 ELSE quarter END AS quarter,
    CASE WHEN month = 12 THEN 1980 ELSE year END AS year,
    CASE WHEN day = 27 THEN 'a long weekday' ELSE day_of_week END AS day_of_week)
FROM dim_date WHERE NOT (month = 2 AND day = 15)
"""

PARTS["bad_customer"] = """
SELECT CASE WHEN customer_key % 11 = 0 THEN -customer_key ELSE customer_key END AS customer_key,
    CASE WHEN region = 'ASIA' THEN lower(customer_id)
         WHEN customer_key % 7 = 0 THEN customer_id || repeat('0', 20) ELSE customer_id END AS customer_id,
    CASE WHEN customer_key % 13 = 0 THEN repeat(region, 20) ELSE region END AS region
FROM (
    SELECT * FROM dim_customer WHERE region <> 'AFRICA'
    UNION ALL
    SELECT * FROM dim_customer WHERE region = 'EUROPE'
)
"""

PARTS["bad_category"] = """
SELECT CASE WHEN category_name = 'LARGE' THEN -category_key ELSE category_key END AS category_key,
    CASE WHEN category_name = 'SMALL' THEN repeat(category_name, 30) ELSE category_name END AS category_name
FROM (
    SELECT * FROM dim_category WHERE category_name <> 'ECONOMY'
    UNION ALL
    SELECT * FROM dim_category WHERE category_name = 'PROMO'
)
"""

PARTS["bad_product"] = """
SELECT CASE WHEN product_key % 50 = 7 THEN -product_key ELSE product_key END AS product_key,
    CASE WHEN product_key % 50 = 8 THEN 'X' || product_id
         WHEN product_key % 50 = 9 THEN product_id || repeat('0', 20) ELSE product_id END AS product_id,
    CASE WHEN product_name = 'blue widget' THEN NULL
         WHEN product_key % 50 = 10 THEN repeat(product_name, 40) ELSE product_name END AS product_name,
    category_key
FROM (
    SELECT * FROM dim_product WHERE product_name <> 'red widget'
    UNION ALL
    SELECT * FROM dim_product WHERE product_name = 'small ring'
)
"""

PARTS["bad_channel"] = """
SELECT CASE WHEN channel_name = '2-HIGH' THEN -channel_key ELSE channel_key END AS channel_key,
    CASE WHEN channel_name = '3-MEDIUM' THEN repeat(channel_name, 10) ELSE channel_name END AS channel_name
FROM (
    SELECT * FROM dim_channel WHERE channel_name <> '5-LOW'
    UNION ALL
    SELECT * FROM dim_channel WHERE channel_name = '1-URGENT'
)
"""

PARTS["damaged"] = """
SELECT CASE WHEN quantity = 45 THEN -sales_key ELSE sales_key END AS sales_key,
    CASE quantity WHEN 44 THEN lower(transaction_id) WHEN 43 THEN transaction_id || repeat('0', 20)
        ELSE transaction_id END AS transaction_id,
    CASE quantity WHEN 42 THEN 40000 WHEN 41 THEN -line_number ELSE line_number END AS line_number,
    date_key, customer_key, product_key,
    CASE WHEN quantity <> 49 THEN channel_key END AS channel_key,
    CASE WHEN quantity = 40 THEN 0 ELSE quantity END AS quantity,
    CAST(CASE quantity WHEN 39 THEN 0 WHEN 35 THEN CAST(unit_price AS DECIMAL(20, 2)) + 100000000000
        ELSE unit_price END AS DECIMAL(20, 2)) AS unit_price,
    CAST(CASE quantity WHEN 38 THEN 1.5 WHEN 30 THEN 15 ELSE discount END AS DECIMAL(20, 4)) AS discount,
    CAST(CASE quantity WHEN 50 THEN revenue + 1 WHEN 37 THEN -1
        WHEN 34 THEN CAST(revenue AS DECIMAL(20, 2)) + 10000000000000
        ELSE revenue END AS DECIMAL(20, 2)) AS revenue,
    CAST(CASE quantity WHEN 46 THEN -1 WHEN 31 THEN CAST(unit_cost AS DECIMAL(20, 2)) + 100000000000
        ELSE unit_cost END AS DECIMAL(20, 2)) AS unit_cost,
    CAST(CASE quantity WHEN 36 THEN -1 WHEN 32 THEN CAST(total_cost AS DECIMAL(20, 2)) + 10000000000000
        ELSE total_cost END AS DECIMAL(20, 2)) AS total_cost,
    CAST(CASE quantity WHEN 33 THEN CAST(profit AS DECIMAL(20, 2)) + 10000000000000
        ELSE profit END AS DECIMAL(20, 2)) AS profit
FROM fact_sales
"""

PARTS["bad_fact"] = """
SELECT * FROM damaged
UNION ALL
SELECT * FROM damaged WHERE quantity = 47
"""

NEEDS = {
    "priced": ["numbered"],
    "measured": ["priced"],
    "sales": ["measured"],
    "dirty": ["sales"],
    "parsed": ["dirty"],
    "judged": ["parsed"],
    "dim_date": ["sales"],
    "dim_customer": ["sales"],
    "dim_category": ["sales"],
    "dim_product": ["dim_category"],
    "dim_channel": ["sales"],
    "fact_sales": ["dim_customer", "dim_product", "dim_channel"],
    "bad_date": ["dim_date"],
    "bad_customer": ["dim_customer"],
    "bad_category": ["dim_category"],
    "bad_product": ["dim_product"],
    "bad_channel": ["dim_channel"],
    "damaged": ["fact_sales"],
    "bad_fact": ["damaged"],
}

CLEAN = ["dim_date", "dim_customer", "dim_category", "dim_product", "dim_channel", "fact_sales"]
BAD = ["bad_date", "bad_customer", "bad_category", "bad_product", "bad_channel", "bad_fact"]


def _sql(body: str, *parts: str, **extra: str) -> str:
    """Query text with the named parts, what those need, and its own expressions in front."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        wanted.add(name)
        for other in NEEDS.get(name, []):
            add(other)

    for name in parts or ("sales",):
        add(name)
    pieces = {name: text for name, text in PARTS.items() if name in wanted}
    pieces.update(extra)
    heads = ",\n".join(f"{name} AS ({text})" for name, text in pieces.items())
    return f"WITH {heads}\n{body}"


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


def _segment(by: str, source: str = "sales") -> str:
    """All segment measures by natural keys."""
    return f"""
SELECT {by},
    CAST(sum(revenue) AS DOUBLE) AS revenue,
    CAST(sum(profit) AS DOUBLE) AS profit,
    CAST(sum(quantity) AS BIGINT) AS units_sold,
    count(DISTINCT transaction_id) AS transactions,
    count(DISTINCT customer_id) AS unique_customers,
    CAST(sum(profit) AS DOUBLE) / nullif(CAST(sum(revenue) AS DOUBLE), 0) AS gross_margin,
    CAST(sum(revenue) AS DOUBLE) / nullif(count(DISTINCT transaction_id), 0)
        AS average_order_value
FROM {source} GROUP BY ALL
"""


def _growth(name: str, partition: str = "") -> str:
    window = f"OVER ({partition} ORDER BY year)"
    return (
        f"({name} - lag({name}) {window}) / nullif(lag({name}) {window}, 0) AS {name}_yoy_growth"
    )


def _yoy(source: str, partition: str = "") -> str:
    return f"""
SELECT *, {_growth("revenue", partition)}, {_growth("profit", partition)} FROM {source}
"""


def _latest(segment: str) -> str:
    return f"""
SELECT t.*, y.revenue_yoy_growth, y.profit_yoy_growth
FROM totals t
JOIN grown y USING ({segment})
WHERE y.year = (SELECT max(year) FROM grown z WHERE z.{segment} = y.{segment})
"""


def _latest_parts(segment: str, attribute: str) -> dict[str, str]:
    return {
        "totals": _segment(f"{attribute} AS {segment}"),
        "yearly": _segment(f"{attribute} AS {segment}, year"),
        "grown": _yoy("yearly", f"PARTITION BY {segment}"),
        "latest": _latest(segment),
    }


OVERVIEW = """
SELECT
    CAST(sum(revenue) AS DOUBLE) AS total_revenue,
    CAST(sum(profit) AS DOUBLE) AS total_profit,
    CAST(sum(profit) AS DOUBLE) / nullif(CAST(sum(revenue) AS DOUBLE), 0) AS gross_margin,
    count(DISTINCT transaction_id) AS transactions,
    CAST(sum(quantity) AS BIGINT) AS units_sold,
    CAST(sum(revenue) AS DOUBLE) / nullif(count(DISTINCT transaction_id), 0)
        AS average_order_value,
    CAST(sum(revenue) AS DOUBLE) / nullif(count(DISTINCT customer_id), 0)
        AS average_revenue_per_customer,
    count(DISTINCT customer_id) AS unique_customers,
    (SELECT count(*) FROM (SELECT customer_id FROM {source} GROUP BY 1
        HAVING count(DISTINCT transaction_id) >= 2)) AS repeat_customers,
    CAST((SELECT count(*) FROM (SELECT customer_id FROM {source} GROUP BY 1
        HAVING count(DISTINCT transaction_id) >= 2)) AS DOUBLE)
        / nullif(count(DISTINCT customer_id), 0) AS repeat_customer_rate
FROM {source}
"""

CONTEXT = """
SELECT * FROM sales
WHERE year IN (1996, 1997, 1998) AND customer_region IN ('ASIA', 'EUROPE')
  AND product_category IN ('PROMO', 'SMALL', 'ECONOMY')
  AND sales_channel IN ('1-URGENT', '2-HIGH')
"""

PRODUCT_BY = "product_id, product_name, product_category AS category_name"

CUSTOMER_SUMS = """
SELECT customer_id, customer_region AS region, sum(revenue) AS revenue, sum(profit) AS profit,
    count(DISTINCT transaction_id) AS transactions
FROM sales GROUP BY ALL
"""

PRODUCT_SUMS = """
SELECT product_id, product_name, CAST(sum(revenue) AS DOUBLE) AS revenue,
    CAST(sum(profit) AS DOUBLE) AS profit,
    CAST(sum(profit) AS DOUBLE) / nullif(CAST(sum(revenue) AS DOUBLE), 0) AS margin
FROM sales GROUP BY ALL
"""

# The mean of the two middle amounts in cents is exact, so is its division.
MEDIAN = "quantile_cont(CAST(round(revenue * 100) AS BIGINT), 0.5) / 100"

MARGIN = "CAST(sum(profit) AS DOUBLE) / nullif(CAST(sum(revenue) AS DOUBLE), 0)"


def _ranks(function: str) -> str:
    return f"""
SELECT *, {function}() OVER (ORDER BY revenue DESC) AS revenue_rank,
    {function}() OVER (ORDER BY profit DESC) AS profit_rank,
    {function}() OVER (ORDER BY profit) AS bottom_profit_rank
FROM products
"""


def _concentration(n: int) -> str:
    return _sql(
        f"""
SELECT (SELECT count(*) FROM best) AS top_customer_count,
    CAST((SELECT sum(revenue) FROM best) AS DOUBLE) AS top_customer_revenue,
    CAST((SELECT sum(revenue) FROM best) AS DOUBLE)
        / CAST((SELECT sum(revenue) FROM sales) AS DOUBLE) AS top_customer_revenue_share
""",
        customers=CUSTOMER_SUMS,
        best=f"SELECT * FROM customers ORDER BY revenue DESC, customer_id LIMIT {n}",
    )


# ---------------------------------------------------------------- sources and storage


def _sources() -> dict[str, str]:
    texts = ", ".join(
        f"CAST({name} AS VARCHAR) AS {name}"
        for name in (
            "transaction_id line_number order_date customer_id product_id product_name "
            "product_category unit_price quantity discount revenue unit_cost total_cost profit "
            "customer_region sales_channel"
        ).split()
    )
    counts = {name: f"(SELECT count(*) FROM {name})" for name in CLEAN}
    rows = counts["fact_sales"]
    return {
        "src_csv_contract": _sql(f"SELECT {texts} FROM sales"),
        "derive_line_measures": _sql(
            "SELECT transaction_id, line_number, CAST(revenue AS DOUBLE) AS revenue, "
            "CAST(total_cost AS DOUBLE) AS total_cost, CAST(profit AS DOUBLE) AS profit FROM sales"
        ),
        "wh_init": _sql(
            _union(
                f"SELECT '{name}' AS table_name, {count} AS rows_before, "
                "CAST(0 AS BIGINT) AS rows_after"
                for name, count in counts.items()
            ),
            *CLEAN,
        ),
        "wh_row_counts": _sql(
            _union(
                f"SELECT '{name}' AS table_name, {count} AS row_count"
                for name, count in counts.items()
            ),
            *CLEAN,
        ),
        "wh_roundtrip": _sql(
            """
SELECT CAST(date_key // 10000 AS INTEGER) AS sale_year, count(*) AS row_count,
    min(sales_key) AS first_key, max(sales_key) AS last_key,
    CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(total_cost) AS DOUBLE) AS total_cost
FROM fact_sales GROUP BY 1
""",
            "fact_sales",
        ),
        "wh_publish": _sql(
            _union(
                f"SELECT {number} AS position, '{step}' AS step, {accepted} AS accepted, "
                f"{rows} AS fact_rows"
                for number, (step, accepted) in enumerate(
                    {"load": "true", "load_broken": "false", "append_repeated": "false"}.items(), 1
                )
            ),
            "fact_sales",
        ),
    }


# ---------------------------------------------------------------- validation

RAW_NULLABLE = (
    "transaction_id line_number order_date customer_id product_id product_name product_category "
    "unit_price quantity discount revenue unit_cost total_cost profit customer_region sales_channel"
).split()

UNPARSED = " OR ".join(
    f"({name} IS NOT NULL AND {parsed} IS NULL)"
    for name, parsed in {
        "line_number": "p_line",
        "quantity": "p_quantity",
        "unit_price": "p_price",
        "unit_cost": "p_cost",
        "discount": "p_discount",
        "revenue": "p_revenue",
        "total_cost": "p_total",
        "profit": "p_profit",
    }.items()
)

MISMATCH = "p_revenue <> e_revenue OR p_total <> e_total OR p_profit <> e_profit"

ROW_RULES = {
    "null_values": " OR ".join(f"{name} IS NULL" for name in RAW_NULLABLE),
    "invalid_order_date": "order_date IS NOT NULL AND p_date IS NULL",
    "invalid_numbers": UNPARSED,
    "nonpositive_counts": "p_line <= 0 OR p_quantity <= 0",
    "nonpositive_prices": "p_price <= 0 OR p_cost <= 0",
    "negative_amounts": "p_revenue < 0 OR p_total < 0",
    "discount_out_of_range": "p_discount < 0 OR p_discount > 1",
    "financial_mismatch": MISMATCH,
}

CHECK_ORDER = [
    "empty_dataset",
    "null_values",
    "duplicate_lines",
    "invalid_order_date",
    "invalid_numbers",
    "nonpositive_counts",
    "nonpositive_prices",
    "negative_amounts",
    "discount_out_of_range",
    "financial_mismatch",
    "unstable_customer_id",
    "unstable_product_id",
    "unstable_transaction_id",
]

ATTRIBUTES = {
    "customer_id": {"customer_region": "customer_region"},
    "product_id": {"product_name": "product_name", "product_category": "product_category"},
    "transaction_id": {
        "order_date": "CAST(p_date AS VARCHAR)",
        "customer_id": "customer_id",
        "customer_region": "customer_region",
        "sales_channel": "sales_channel",
    },
}


def _unstable(key: str) -> str:
    flags = {
        name: f"count(DISTINCT coalesce({value}, '(none)')) > 1"
        for name, value in ATTRIBUTES[key].items()
    }
    columns = ", ".join(f"{flag} AS unstable_{name}" for name, flag in flags.items())
    return f"SELECT {key}, {columns} FROM judged GROUP BY {key} HAVING {' OR '.join(flags.values())}"


DUPLICATES = """
SELECT transaction_id,
    coalesce(CAST(p_line AS VARCHAR), CAST(line_number AS VARCHAR)) AS line_number,
    count(*) AS copies
FROM judged GROUP BY 1, 2 HAVING count(*) > 1
"""


def _check_row(name: str, count: str) -> str:
    return (
        f"SELECT CAST({CHECK_ORDER.index(name) + 1} AS INTEGER) AS check_no, "
        f"'{name}' AS check_name, CAST(({count}) AS BIGINT) AS violation_count"
    )


def _row_check_rows() -> list[str]:
    empty = "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM judged"
    return [
        _check_row("empty_dataset", empty),
        *[
            _check_row(name, f"SELECT count(*) FROM judged WHERE {rule}")
            for name, rule in ROW_RULES.items()
        ],
    ]


def _all_check_rows() -> str:
    return _union(
        [
            *_row_check_rows(),
            _check_row("duplicate_lines", f"SELECT count(*) FROM ({DUPLICATES})"),
            *[
                _check_row(f"unstable_{key}", f"SELECT count(*) FROM ({_unstable(key)})")
                for key in ATTRIBUTES
            ],
        ]
    )


CLEAN_JUDGED = """
SELECT *, order_date AS p_date, quantity AS p_quantity, line_number AS p_line,
    unit_price AS p_price, unit_cost AS p_cost, discount AS p_discount, revenue AS p_revenue,
    total_cost AS p_total, profit AS p_profit,
    round(unit_price * quantity * (CAST(1 AS DECIMAL(5, 4)) - discount), 2) AS e_revenue,
    round(unit_cost * quantity, 2) AS e_total,
    round(unit_price * quantity * (CAST(1 AS DECIMAL(5, 4)) - discount), 2)
        - round(unit_cost * quantity, 2) AS e_profit
FROM sales
"""


def _validation() -> dict[str, str]:
    expected = ", ".join(
        f"CAST(p_{short} AS DOUBLE) AS {name}, CAST(e_{short} AS DOUBLE) AS expected_{name}"
        for short, name in {"revenue": "revenue", "total": "total_cost", "profit": "profit"}.items()
    )
    return {
        "val_row_checks": _sql(_union(_row_check_rows()), "judged"),
        "val_null_columns": _sql(
            _union(
                f"SELECT '{name}' AS column_name, count(*) AS null_count "
                f"FROM dirty WHERE {name} IS NULL"
                for name in RAW_NULLABLE
            ),
            "dirty",
        ),
        "val_duplicate_lines": _sql(DUPLICATES, "judged"),
        "val_financial": _sql(
            f"SELECT transaction_id, line_number, {expected} FROM judged WHERE {MISMATCH}", "judged"
        ),
        "val_fd_customer": _sql(_unstable("customer_id"), "judged"),
        "val_fd_product": _sql(_unstable("product_id"), "judged"),
        "val_fd_transaction": _sql(_unstable("transaction_id"), "judged"),
        "val_source_clean": _sql(_all_check_rows(), judged=CLEAN_JUDGED),
        "val_source_dirty": _sql(_all_check_rows(), "judged"),
        "val_model_nulls": _sql(
            _union(
                f"SELECT '{name}' AS table_name, count(*) AS null_rows FROM {bad} "
                f"WHERE {' OR '.join(f'{column} IS NULL' for column in TABLE_COLUMNS[name])}"
                for name, bad in zip(CLEAN, BAD)
            ),
            *BAD,
        ),
        "val_model_fks": _sql(
            _union(
                f"SELECT '{table}' AS table_name, '{key}' AS key_name, "
                f"count(DISTINCT coalesce(t.{key}, -1)) AS unresolved_keys, "
                f"count(*) AS unresolved_rows FROM {BAD_NAME[table]} t "
                f"WHERE NOT EXISTS (SELECT 1 FROM {BAD_NAME[owner]} o WHERE o.{key} = t.{key})"
                for table, key, owner in REFERENCES
            ),
            *BAD,
        ),
    }


TABLE_COLUMNS = {
    "dim_date": (
        "date_key full_date day month month_name quarter year day_of_week is_weekend"
    ).split(),
    "dim_customer": "customer_key customer_id region".split(),
    "dim_category": "category_key category_name".split(),
    "dim_product": "product_key product_id product_name category_key".split(),
    "dim_channel": "channel_key channel_name".split(),
    "fact_sales": (
        "sales_key transaction_id line_number date_key customer_key product_key channel_key "
        "quantity unit_price discount revenue unit_cost total_cost profit"
    ).split(),
}
REFERENCES = [
    ("fact_sales", "date_key", "dim_date"),
    ("fact_sales", "customer_key", "dim_customer"),
    ("fact_sales", "product_key", "dim_product"),
    ("fact_sales", "channel_key", "dim_channel"),
    ("dim_product", "category_key", "dim_category"),
]
BAD_NAME = dict(zip(CLEAN, BAD))


# ---------------------------------------------------------------- model


def _model() -> dict[str, str]:
    money = "unit_price discount revenue unit_cost total_cost profit".split()
    fact = ", ".join(
        f"CAST({name} AS DOUBLE) AS {name}" if name in money else name
        for name in TABLE_COLUMNS["fact_sales"]
    )
    return {
        "dim_date": _sql(
            "SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date", "dim_date"
        ),
        **{
            name: _sql(f"SELECT * FROM {name}", name)
            for name in ("dim_customer", "dim_category", "dim_product", "dim_channel")
        },
        "fact_sales": _sql(f"SELECT {fact} FROM fact_sales", "fact_sales"),
        "enrich_sales": _sql(
            """
SELECT transaction_id, line_number, CAST(order_date AS VARCHAR) AS full_date, year, customer_id,
    customer_region AS region, product_id, product_name, product_category AS category_name,
    sales_channel AS channel_name, quantity, CAST(revenue AS DOUBLE) AS revenue,
    CAST(profit AS DOUBLE) AS profit
FROM sales
"""
        ),
    }


# ---------------------------------------------------------------- integrity and constraints

FORMULAS = {
    "revenue_calculation": "revenue = round(unit_price * quantity "
    "* (CAST(1 AS DECIMAL(5, 4)) - discount), 2)",
    "cost_calculation": "total_cost = round(unit_cost * quantity, 2)",
    "profit_calculation": "profit = revenue - total_cost",
}


def _integrity(names: dict[str, str]) -> str:
    def row(check: str, count: str) -> str:
        return (
            f"SELECT '{check}' AS check_name, CAST(({count}) AS BIGINT) AS violation_count"
        )

    def nulls(table: str, columns: str) -> str:
        condition = " OR ".join(f"{column} IS NULL" for column in columns.split())
        return f"(SELECT count(*) FROM {names[table]} WHERE {condition})"

    rows = [
        row(
            f"orphan_{key}s",
            f"SELECT count(*) FROM {names[table]} t LEFT JOIN "
            f"(SELECT DISTINCT {key} AS known FROM {names[owner]}) o ON o.known = t.{key} "
            "WHERE o.known IS NULL",
        )
        for table, key, owner in REFERENCES
    ]
    for check, table, columns in [
        ("duplicate_customer_ids", "dim_customer", "customer_id"),
        ("duplicate_product_ids", "dim_product", "product_id"),
        ("duplicate_category_names", "dim_category", "category_name"),
        ("duplicate_channel_names", "dim_channel", "channel_name"),
        ("duplicate_sales_lines", "fact_sales", "transaction_id, line_number"),
    ]:
        rows.append(
            row(
                check,
                f"SELECT count(*) FROM (SELECT {columns} FROM {names[table]} "
                "GROUP BY ALL HAVING count(*) > 1)",
            )
        )
    broken = " OR ".join(f"NOT ({formula})" for formula in FORMULAS.values())
    rows.append(
        row(
            "financial_reconciliation_failures",
            f"SELECT count(*) FROM {names['fact_sales']} WHERE {broken}",
        )
    )
    fact_columns = " ".join(TABLE_COLUMNS["fact_sales"][1:])
    rows.append(row("unexpected_fact_nulls", "SELECT " + nulls("fact_sales", fact_columns)))
    dimension_nulls = " + ".join(
        [
            nulls("dim_date", "full_date month year"),
            nulls("dim_customer", "customer_id region"),
            nulls("dim_category", "category_name"),
            nulls("dim_product", "product_id product_name category_key"),
            nulls("dim_channel", "channel_name"),
        ]
    )
    rows.append(row("unexpected_dimension_nulls", "SELECT " + dimension_nulls))
    return _union(rows)


CONDITIONS = {
    "dim_date": {
        "day_range": "day BETWEEN 1 AND 31",
        "month_range": "month BETWEEN 1 AND 12",
        "quarter_range": "quarter BETWEEN 1 AND 4",
        "year_range": "year BETWEEN 1990 AND 2100",
        "date_key_matches_date": "date_key = CAST(strftime(full_date, '%Y%m%d') AS INTEGER)",
        "month_name_length": "length(month_name) <= 9",
        "day_of_week_length": "length(day_of_week) <= 9",
    },
    "dim_customer": {
        "customer_key_positive": "customer_key > 0",
        "customer_id_format": "regexp_matches(customer_id, '^CUST[0-9]{5,}$')",
        "customer_id_length": "length(customer_id) <= 20",
        "region_length": "length(region) <= 50",
    },
    "dim_category": {
        "category_key_positive": "category_key > 0",
        "category_name_length": "length(category_name) <= 100",
    },
    "dim_product": {
        "product_key_positive": "product_key > 0",
        "product_id_format": "regexp_matches(product_id, '^PROD[0-9]{5,}$')",
        "product_id_length": "length(product_id) <= 20",
        "product_name_length": "length(product_name) <= 150",
    },
    "dim_channel": {
        "channel_key_positive": "channel_key > 0",
        "channel_name_length": "length(channel_name) <= 50",
    },
    "fact_sales": {
        "sales_key_positive": "sales_key > 0",
        "transaction_id_format": "regexp_matches(transaction_id, '^TXN[0-9]{7,}$')",
        "transaction_id_length": "length(transaction_id) <= 20",
        "line_number_positive": "line_number > 0",
        "line_number_range": "line_number BETWEEN -32768 AND 32767",
        "quantity_positive": "quantity > 0",
        "unit_price_positive": "unit_price > 0",
        "discount_range": "discount BETWEEN 0 AND 1",
        "revenue_nonnegative": "revenue >= 0",
        "unit_cost_nonnegative": "unit_cost >= 0",
        "total_cost_nonnegative": "total_cost >= 0",
        **FORMULAS,
        **{
            f"{name}_precision": f"abs({name}) < {bound}"
            for name, bound in {
                "unit_price": "10000000000",
                "discount": "10",
                "revenue": "1000000000000",
                "unit_cost": "10000000000",
                "total_cost": "1000000000000",
                "profit": "1000000000000",
            }.items()
        },
    },
}

UNIQUE = {
    "dim_date": ["date_key", "full_date"],
    "dim_customer": ["customer_key", "customer_id"],
    "dim_category": ["category_key", "category_name"],
    "dim_product": ["product_key", "product_id"],
    "dim_channel": ["channel_key", "channel_name"],
    "fact_sales": ["sales_key", "transaction_id, line_number"],
}


def _constraints(names: dict[str, str]) -> str:
    rows = []

    def add(table: str, constraint: str, source: str) -> None:
        rows.append(
            f"SELECT '{table}' AS table_name, '{constraint}' AS constraint_name, "
            f"count(*) AS violations FROM {source}"
        )

    for table, source in names.items():
        for column in TABLE_COLUMNS[table]:
            add(table, f"{column}_not_null", f"{source} WHERE {column} IS NULL")
        for constraint, condition in CONDITIONS[table].items():
            add(table, constraint, f"{source} WHERE NOT ({condition})")
        for columns in UNIQUE[table]:
            name = columns.replace(", ", "_")
            add(
                table,
                f"{name}_unique",
                f"(SELECT {columns} FROM {source} GROUP BY ALL HAVING count(*) > 1)",
            )
    for table, key, owner in REFERENCES:
        add(
            table,
            f"{key}_reference",
            f"{names[table]} t WHERE t.{key} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {names[owner]} o WHERE o.{key} = t.{key})",
        )
    return _union(rows)


UNFIT = """
SELECT reason, count(*) AS row_count FROM (
    SELECT unnest([
        CASE WHEN NOT line_number BETWEEN -32768 AND 32767
            THEN 'line_number = ' || line_number || ' does not fit smallint' END,
        CASE WHEN abs(unit_price) >= 10000000000
            THEN 'unit_price = ' || unit_price || ' does not fit decimal(12,2)' END,
        CASE WHEN abs(discount) >= 10 THEN 'discount = ' || discount || ' does not fit decimal(5,4)' END,
        CASE WHEN abs(revenue) >= 1000000000000
            THEN 'revenue = ' || revenue || ' does not fit decimal(14,2)' END,
        CASE WHEN abs(unit_cost) >= 10000000000
            THEN 'unit_cost = ' || unit_cost || ' does not fit decimal(12,2)' END,
        CASE WHEN abs(total_cost) >= 1000000000000
            THEN 'total_cost = ' || total_cost || ' does not fit decimal(14,2)' END,
        CASE WHEN abs(profit) >= 1000000000000
            THEN 'profit = ' || profit || ' does not fit decimal(14,2)' END
    ]) AS reason
    FROM bad_fact
) WHERE reason IS NOT NULL GROUP BY reason
"""


def _checks() -> dict[str, str]:
    clean = {name: name for name in CLEAN}
    return {
        "integrity_clean": _sql(_integrity(clean), *CLEAN),
        "integrity_dirty": _sql(_integrity(BAD_NAME), *BAD),
        "orphan_lines": _sql(
            _union(
                f"SELECT 'orphan_{key}s' AS check_name, CAST(t.{key} AS BIGINT) AS key_value, "
                f"count(*) AS line_count FROM {BAD_NAME[table]} t WHERE NOT EXISTS "
                f"(SELECT 1 FROM {BAD_NAME[owner]} o WHERE o.{key} = t.{key}) GROUP BY t.{key}"
                for table, key, owner in REFERENCES
            ),
            *BAD,
        ),
        "duplicate_lines": _sql(
            "SELECT transaction_id, line_number, count(*) AS copies FROM bad_fact "
            "GROUP BY 1, 2 HAVING count(*) > 1",
            "bad_fact",
        ),
        "fact_row_count": _sql("SELECT count(*) AS fact_row_count FROM fact_sales", "fact_sales"),
        "constraint_report": _sql(_constraints(clean), *CLEAN),
        "constraint_report_dirty": _sql(_constraints(BAD_NAME), *BAD),
        "unfit_values": _sql(UNFIT, "bad_fact"),
    }


# ---------------------------------------------------------------- filters


def _filters() -> dict[str, str]:
    def lines(condition: str) -> str:
        return _sql(
            "SELECT k.sales_key, s.transaction_id, s.line_number, s.quantity, "
            "CAST(s.revenue AS DOUBLE) AS revenue, CAST(s.profit AS DOUBLE) AS profit "
            "FROM sales s JOIN fact_sales k USING (transaction_id, line_number) "
            f"WHERE {condition}",
            "fact_sales",
        )

    def options(facet: str, column: str, table: str) -> str:
        return (
            f"SELECT '{facet}' AS facet, row_number() OVER (ORDER BY v) AS position, "
            f"CAST(v AS VARCHAR) AS value FROM (SELECT DISTINCT {column} AS v FROM {table})"
        )

    overview = OVERVIEW.replace("FROM {source}\n", ", count(*) > 0 AS has_sales FROM chosen\n")
    overview = overview.replace("{source}", "chosen")
    return {
        "filter_all_dims": lines(
            "s.year IN (1996, 1997, 1998) AND s.customer_region IN ('ASIA', 'EUROPE') "
            "AND s.product_category IN ('PROMO', 'SMALL', 'ECONOMY') "
            "AND s.sales_channel IN ('1-URGENT', '2-HIGH')"
        ),
        "filter_year": lines("s.year IN (1996, 1997)"),
        "filter_region": lines("s.customer_region = 'ASIA'"),
        "filter_category": lines("s.product_category IN ('PROMO', 'SMALL')"),
        "filter_channel": lines("s.sales_channel = '5-LOW'"),
        "filter_options": _sql(
            _union(
                [
                    options("years", "year", "dim_date"),
                    options("regions", "customer_region", "sales"),
                    options("categories", "product_category", "sales"),
                    options("channels", "sales_channel", "sales"),
                ]
            ),
            "dim_date",
        ),
        "filtered_overview": _sql(overview, chosen=CONTEXT),
        "filtered_products": _sql(
            _ranks("dense_rank"), chosen=CONTEXT, products=_segment(PRODUCT_BY, "chosen")
        ),
        "filtered_channels": _sql(
            _segment("sales_channel AS channel_name", "chosen"), chosen=CONTEXT
        ),
    }


# ---------------------------------------------------------------- KPIs


def _percent(value: str) -> str:
    """One decimal, rounded half up on the shortest decimal form."""
    exact = f"CAST(CAST(({value}) * 100 AS VARCHAR) AS DECIMAL(38, 17))"
    return f"printf('%.1f%%', CAST(round({exact}, 1) AS DOUBLE))"


def _growth_text(name: str) -> str:
    return f"{name} || ' latest YoY revenue growth is ' || {_percent('revenue_yoy_growth')} || '.'"


# Evidence sentences.
EVIDENCE = {
    1: f"'Latest YoY growth gap: ' || {_percent('revenue_yoy_growth - profit_yoy_growth')} || '.'",
    2: f"'Gross margin decreased ' || {_percent('f.gross_margin - l.gross_margin')} "
    "|| ' from the first to the latest year.'",
    3: f"product_name || ' margin is ' || {_percent('gross_margin')} || ' versus ' "
    f"|| {_percent(f'(SELECT {MARGIN} FROM sales)')} || ' overall.'",
    4: _growth_text("category_name"),
    5: _growth_text("region"),
    6: "arg_max(channel_name, average_order_value) || printf(' AOV is %.1fx ', "
    "CAST(round(CAST(CAST(max(average_order_value) / min(average_order_value) AS VARCHAR) "
    "AS DECIMAL(38, 17)), 1) AS DOUBLE)) || arg_min(channel_name, average_order_value) || '.'",
    7: f"printf('Top %d customers contribute ', n) || {_percent('share')} || ' of revenue.'",
}


def _insights(chosen: str = "", *, texts: bool = False) -> str:
    """Findings on all sales, or on those that a condition chooses; `texts` adds the sentences."""
    def finding(number: int, condition: str, value: str, subject: str, source: str) -> str:
        text = f", {EVIDENCE[number]} AS evidence" if texts else ""
        return (
            f"SELECT {number} AS rule_no, '{condition}' AS condition, {value} AS evidence_value, "
            f"CAST({subject} AS VARCHAR) AS evidence_subject{text} FROM {source}"
        )

    rules = [
        finding(
            1,
            "Profit growth trails revenue growth",
            "revenue_yoy_growth - profit_yoy_growth",
            "year",
            "annual WHERE year = (SELECT max(year) FROM annual WHERE revenue_yoy_growth IS NOT NULL "
            "AND profit_yoy_growth IS NOT NULL) "
            "AND revenue_yoy_growth - profit_yoy_growth >= 0.03",
        ),
        finding(
            2,
            "Revenue is growing while margin is compressing",
            "f.gross_margin - l.gross_margin",
            "l.year",
            "annual f, annual l WHERE f.year = (SELECT min(year) FROM annual) "
            "AND l.year = (SELECT max(year) FROM annual) AND (SELECT count(*) FROM annual) >= 2 "
            "AND NOT EXISTS (SELECT 1 FROM annual WHERE revenue_yoy_growth <= 0) "
            "AND l.gross_margin < f.gross_margin - 0.005",
        ),
        finding(
            3,
            "Major product has weak margin",
            "gross_margin",
            "product_name",
            "(SELECT * FROM products WHERE revenue >= (SELECT " + MEDIAN + " FROM products) "
            "ORDER BY gross_margin NULLS LAST, product_id LIMIT 1) "
            f"WHERE gross_margin <= (SELECT {MARGIN} FROM sales) - 0.10",
        ),
        finding(
            4,
            "Category revenue is declining",
            "revenue_yoy_growth",
            "category_name",
            "(SELECT * FROM categories WHERE revenue_yoy_growth < 0 "
            "ORDER BY revenue_yoy_growth, category_name LIMIT 1)",
        ),
        finding(
            5,
            "Fastest-growing region",
            "revenue_yoy_growth",
            "region",
            "(SELECT * FROM regions WHERE revenue_yoy_growth IS NOT NULL "
            "ORDER BY revenue_yoy_growth DESC, region LIMIT 1)",
        ),
        finding(
            6,
            "Channel order values differ materially",
            "max(average_order_value) / min(average_order_value)",
            "arg_max(channel_name, average_order_value)",
            "channels HAVING count(*) > 1 AND min(average_order_value) > 0 "
            "AND max(average_order_value) / min(average_order_value) >= 1.5",
        ),
        finding(
            7,
            "Revenue is concentrated among top customers",
            "share",
            "n",
            "(SELECT count(*) AS n, CAST(sum(revenue) AS DOUBLE) "
            "/ CAST((SELECT sum(revenue) FROM sales) AS DOUBLE) AS share "
            "FROM (SELECT * FROM customers ORDER BY revenue DESC, customer_id LIMIT 10)) "
            "WHERE share >= 0.20",
        ),
    ]

    def latest(name: str, attribute: str, prefix: str) -> dict[str, str]:
        parts = _latest_parts(name, attribute)
        renamed = {
            key: text.replace("FROM totals t", f"FROM {prefix}_totals t")
            .replace("grown", f"{prefix}_grown")
            .replace("FROM yearly", f"FROM {prefix}_yearly")
            for key, text in parts.items()
        }
        return {
            f"{prefix}_totals": renamed["totals"],
            f"{prefix}_yearly": renamed["yearly"],
            f"{prefix}_grown": renamed["grown"],
            prefix: renamed["latest"],
        }

    return _sql(
        _union(rules),
        yearly=_segment("year"),
        annual=_yoy("yearly"),
        products=_segment(PRODUCT_BY),
        **latest("category_name", "product_category", "categories"),
        **latest("region", "customer_region", "regions"),
        channels=_segment("sales_channel AS channel_name"),
        customers=CUSTOMER_SUMS,
        **({"sales": f"SELECT * FROM ({PARTS['sales']}) WHERE {chosen}"} if chosen else {}),
    )


CUSTOMER_ORDERS = """
SELECT customer_id, count(DISTINCT transaction_id) AS order_count FROM sales GROUP BY 1
"""


def _kpis() -> dict[str, str]:
    category = _latest_parts("category_name", "product_category")
    region = _latest_parts("region", "customer_region")
    reconciled = _union(
        f"""
SELECT '{name}' AS segment, CAST(sum(part) AS DOUBLE) AS segment_revenue,
    CAST((SELECT sum(revenue) FROM sales) AS DOUBLE) AS total_revenue,
    sum(part) = (SELECT sum(revenue) FROM sales) AND sum(gain) = (SELECT sum(profit) FROM sales)
        AND sum(units) = (SELECT sum(quantity) FROM sales) AS reconciled
FROM (SELECT sum(revenue) AS part, sum(profit) AS gain, sum(quantity) AS units
    FROM sales GROUP BY {column})
"""
        for name, column in {
            "category_name": "product_category",
            "region": "customer_region",
            "channel_name": "sales_channel",
        }.items()
    )
    weak = f"""
SELECT product_id, product_name, revenue, profit, margin FROM products
WHERE revenue >= (SELECT {MEDIAN} FROM products)
  AND margin < (SELECT {MARGIN} FROM sales)
"""
    return {
        "executive_overview": _sql(OVERVIEW.replace("{source}", "sales")),
        "customer_orders": _sql(CUSTOMER_ORDERS),
        "having_repeat_customers": _sql(
            f"{CUSTOMER_ORDERS} HAVING count(DISTINCT transaction_id) >= 2"
        ),
        "repeat_customer_rate": _sql(
            f"""
SELECT count(*) AS customers, count(*) FILTER (WHERE order_count >= 2) AS repeat_customers,
    CAST(count(*) FILTER (WHERE order_count >= 2) AS DOUBLE) / count(*) AS repeat_customer_rate
FROM ({CUSTOMER_ORDERS})
"""
        ),
        "revenue_by_year": _sql(
            "SELECT year, CAST(sum(revenue) AS DOUBLE) AS revenue, "
            "CAST(sum(profit) AS DOUBLE) AS profit FROM sales GROUP BY 1"
        ),
        "annual_performance": _sql(_yoy("yearly"), yearly=_segment("year")),
        "monthly_trend": _sql(_segment("strftime(order_date, '%Y-%m-01') AS month")),
        "category_annual": _sql(
            "SELECT * FROM grown", **{k: category[k] for k in ("yearly", "grown")}
        ),
        "category_performance": _sql(
            """
SELECT *, dense_rank() OVER (ORDER BY revenue DESC) AS revenue_rank,
    dense_rank() OVER (ORDER BY profit DESC) AS profit_rank
FROM latest
""",
            **category,
        ),
        "region_annual": _sql(
            "SELECT * FROM grown", **{k: region[k] for k in ("yearly", "grown")}
        ),
        "region_performance": _sql("SELECT * FROM latest", **region),
        "channel_performance": _sql(_segment("sales_channel AS channel_name")),
        "product_performance": _sql(_ranks("rank"), products=_segment(PRODUCT_BY)),
        "product_dense_ranks": _sql(_ranks("dense_rank"), products=_segment(PRODUCT_BY)),
        "median_product_revenue": _sql(
            f"SELECT {MEDIAN} AS median FROM products", products=PRODUCT_SUMS
        ),
        "portfolio_margin": _sql(f"SELECT {MARGIN} AS margin FROM sales"),
        "weak_margin_products": _sql(weak, products=PRODUCT_SUMS),
        "customer_value": _sql(
            """
SELECT customer_id, region, revenue AS lifetime_revenue, profit AS lifetime_profit, units_sold,
    transactions, unique_customers, gross_margin, average_order_value,
    row_number() OVER (ORDER BY revenue DESC, customer_id) AS revenue_rank,
    revenue / CAST((SELECT sum(revenue) FROM sales) AS DOUBLE) AS revenue_share
FROM customers
""",
            customers=_segment("customer_id, customer_region AS region"),
        ),
        "top_customer_concentration": _concentration(10),
        "top_n_concentration": _concentration(25),
        "repeat_vs_onetime": _sql(
            """
SELECT CASE WHEN transactions >= 2 THEN 'Repeat' ELSE 'One-time' END AS customer_type,
    count(*) AS customers, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM customers GROUP BY 1
""",
            customers=CUSTOMER_SUMS,
        ),
        "segment_totals_reconcile": _sql(reconciled),
        "insights": _insights(),
        "insights_two_years": _insights(
            "year IN (1997, 2000) AND customer_region = 'AMERICA' "
            "AND product_category IN ('ECONOMY', 'LARGE')"
        ),
        "insights_margin": _insights(
            "year IN (1997, 1999) AND customer_region = 'AFRICA' AND product_category = 'ECONOMY'",
            texts=True,
        ),
        "insights_narrow": _insights(
            "year = 2001 AND customer_region = 'MIDDLE EAST' AND product_category = 'PROMO'"
        ),
        "sql_executive_summary": _sql(OVERVIEW.replace("{source}", "sales")),
        "sql_annual": _sql(
            "SELECT year, revenue, profit, gross_margin, revenue_yoy_growth, profit_yoy_growth "
            "FROM grown",
            yearly=_segment("year"),
            grown=_yoy("yearly"),
        ),
        "sql_monthly": _sql(
            "SELECT month, revenue, profit, gross_margin, transactions FROM monthly",
            monthly=_segment("strftime(order_date, '%Y-%m-01') AS month"),
        ),
        "sql_category_annual": _sql(
            "SELECT category_name, year, revenue, profit, revenue_yoy_growth FROM grown",
            **{k: category[k] for k in ("yearly", "grown")},
        ),
        "sql_products": _sql(
            f"SELECT * EXCLUDE (transactions, unique_customers, average_order_value) "
            f"FROM ({_ranks('rank')})",
            products=_segment(PRODUCT_BY),
        ),
        "sql_weak_margins": _sql(weak, products=PRODUCT_SUMS),
        "sql_region_annual": _sql(
            "SELECT region, year, revenue, profit, gross_margin, revenue_yoy_growth, "
            "profit_yoy_growth FROM grown",
            **{k: region[k] for k in ("yearly", "grown")},
        ),
        "sql_channels": _sql(_segment("sales_channel AS channel_name")),
        "sql_customers": _sql(
            """
SELECT customer_id, region, CAST(revenue AS DOUBLE) AS lifetime_revenue,
    CAST(profit AS DOUBLE) AS lifetime_profit, transactions,
    row_number() OVER (ORDER BY revenue DESC, customer_id) AS revenue_rank,
    CAST(revenue AS DOUBLE) / CAST((SELECT sum(revenue) FROM sales) AS DOUBLE) AS revenue_share
FROM customers
""",
            customers=CUSTOMER_SUMS,
        ),
        "sql_concentration": _concentration(10)
        .replace("(SELECT count(*) FROM best) AS top_customer_count,", "")
        .replace("top_customer_revenue", "top_revenue"),
    }


# ---------------------------------------------------------------- reports


def _reports() -> dict[str, str]:
    def long(key: str) -> str:
        name = key.split(" AS ")[-1]
        return _sql(
            f"SELECT {name}, 'revenue' AS metric, revenue AS usd FROM totals UNION ALL "
            f"SELECT {name}, 'profit', profit FROM totals",
            totals=_segment(key),
        )

    def top(metric: str) -> str:
        return _sql(
            f"SELECT dense_rank() OVER (ORDER BY {metric} DESC) AS {metric}_rank, product_id, "
            f"product_name, {metric} FROM products ORDER BY {metric} DESC, product_id LIMIT 10",
            products=_segment(PRODUCT_BY),
        )

    def short(value: str) -> str:
        return (
            f"CASE WHEN abs({value}) >= 1000000 THEN printf('$%.2fM', {value} / 1000000) "
            f"WHEN abs({value}) >= 1000 THEN printf('$%.1fK', {value} / 1000) "
            f"ELSE format('${{:,.2f}}', {value}) END"
        )

    def percent(value: str) -> str:
        return f"printf('%.1f%%', {value} * 100)"

    def whole(value: str) -> str:
        return f"format('{{:,}}', {value})"

    share = (
        "(SELECT CAST(sum(revenue) AS DOUBLE) FROM (SELECT * FROM customers "
        "ORDER BY revenue DESC, customer_id LIMIT 10)) / total_revenue"
    )
    cards = [
        ("Total Revenue", short("total_revenue")),
        ("Total Profit", short("total_profit")),
        ("Gross Margin", percent("gross_margin")),
        ("Transactions", whole("transactions")),
        ("Average Order Value", "format('${:,.2f}', average_order_value)"),
        ("Unique Customers", whole("unique_customers")),
        ("Repeat Customer Rate", percent("repeat_customer_rate")),
        ("Unique Customers", whole("unique_customers")),
        ("Repeat Customer Rate", percent("repeat_customer_rate")),
        ("Revenue per Customer", short("average_revenue_per_customer")),
        ("Top 10 Revenue Share", percent(f"({share})")),
    ]
    region = _latest_parts("region", "customer_region")
    channel = {"totals": _segment("sales_channel AS channel_name")}
    bin_number = "CAST(least(floor(35 * (revenue - low) / nullif(high - low, 0)) + 1, 35) AS BIGINT)"
    return {
        "headline_cards": _sql(
            _union(
                f"SELECT CAST({number} AS INTEGER) AS position, '{label}' AS label, "
                f"{text} AS value FROM overview"
                for number, (label, text) in enumerate(cards, 1)
            ),
            overview=OVERVIEW.replace("{source}", "sales"),
            customers=CUSTOMER_SUMS,
        ),
        "monthly_long": long("strftime(order_date, '%Y-%m-01') AS month"),
        "annual_long": long("year"),
        "category_long": long("product_category AS category_name"),
        "region_long": long("customer_region AS region"),
        "channel_long": long("sales_channel AS channel_name"),
        "product_margin_scatter": _sql(
            f"SELECT product_id, product_name, category_name, revenue, profit, gross_margin, "
            f"(SELECT {MARGIN} FROM sales) AS portfolio_margin FROM products",
            products=_segment(PRODUCT_BY),
        ),
        "top_products_revenue": top("revenue"),
        "top_products_profit": top("profit"),
        "category_revenue_series": _sql(
            "SELECT product_category AS category_name, year, CAST(sum(revenue) AS DOUBLE) AS revenue "
            "FROM sales GROUP BY ALL"
        ),
        "product_table": _sql(
            "SELECT product_name, category_name, revenue, profit, gross_margin FROM products",
            products=_segment(PRODUCT_BY),
        ),
        "regions_by_revenue": _sql("SELECT region, revenue FROM latest", **region),
        "regions_by_growth": _sql("SELECT region, revenue_yoy_growth FROM latest", **region),
        "regions_by_margin": _sql("SELECT region, gross_margin FROM latest", **region),
        "channels_by_revenue": _sql("SELECT channel_name, revenue FROM totals", **channel),
        "channels_by_margin": _sql("SELECT channel_name, gross_margin FROM totals", **channel),
        "channels_by_order_value": _sql(
            "SELECT channel_name, average_order_value FROM totals", **channel
        ),
        "top_customers_15": _sql(
            "SELECT customer_id, region, CAST(revenue AS DOUBLE) AS lifetime_revenue "
            "FROM customers ORDER BY revenue DESC, customer_id LIMIT 15",
            customers=CUSTOMER_SUMS,
        ),
        "customer_revenue_histogram": _sql(
            f"""
SELECT bin, low + (bin - 1) * ((high - low) / 35) AS bin_start,
    low + bin * ((high - low) / 35) AS bin_end, count(*) AS customers
FROM (
    SELECT coalesce({bin_number}, 1) AS bin, low, high
    FROM (SELECT CAST(revenue AS DOUBLE) AS revenue,
            (SELECT CAST(min(revenue) AS DOUBLE) FROM customers) AS low,
            (SELECT CAST(max(revenue) AS DOUBLE) FROM customers) AS high
        FROM customers)
)
GROUP BY bin, low, high
""",
            customers=CUSTOMER_SUMS,
        ),
    }


# ---------------------------------------------------------------- reconciliation


def _reconciliation() -> dict[str, str]:
    def entry(area: str, segment: str, metric: str, source: str, value: str | None = None) -> str:
        value = f"CAST({value or metric} AS DOUBLE)"
        return (
            f"SELECT '{area}' AS area, CAST({segment} AS VARCHAR) AS segment, "
            f"'{metric}' AS metric, {value} AS sql_value, {value} AS df_value, "
            f"{value} - {value} AS abs_diff, true AS within_tolerance FROM {source}"
        )

    overview = (
        "total_revenue total_profit gross_margin transactions units_sold average_order_value "
        "unique_customers repeat_customers repeat_customer_rate"
    ).split()
    money = ["revenue", "profit"]
    rows = [entry("overview", "'all'", metric, "overview") for metric in overview]
    rows += [entry("annual", "year", metric, "annual") for metric in money]
    rows += [entry("products", "product_id", metric, "products") for metric in money]
    rank = "rank() OVER (ORDER BY revenue DESC)"
    rows.append(entry("products", "product_id", "revenue_rank", "products", rank))
    rows += [entry("regions", "region || '/' || year", metric, "regions") for metric in money]
    rows += [
        entry("channels", "channel_name", metric, "channels")
        for metric in [*money, "gross_margin", "average_order_value"]
    ]
    share = (
        "CAST(sum(revenue) AS DOUBLE) / CAST((SELECT sum(revenue) FROM sales) AS DOUBLE)"
    )
    rows.append(
        entry(
            "concentration",
            "'all'",
            "share",
            "(SELECT * FROM customers ORDER BY revenue DESC, customer_id LIMIT 10)",
            share,
        )
    )
    measures = {
        "rows": "count(*)",
        **{name: f"sum({name})" for name in ("quantity", "revenue", "total_cost", "profit")},
    }
    return {
        "reconcile_kpis": _sql(
            _union(rows),
            overview=OVERVIEW.replace("{source}", "sales"),
            annual=_segment("year"),
            products=_segment(PRODUCT_BY),
            regions=_segment("customer_region AS region, year"),
            channels=_segment("sales_channel AS channel_name"),
            customers=CUSTOMER_SUMS,
        ),
        "reconcile_raw_vs_fact": _sql(
            _union(
                f"SELECT '{name}' AS measure, "
                f"CAST((SELECT {value} FROM sales) AS DOUBLE) AS raw_value, "
                f"CAST((SELECT {value} FROM fact_sales) AS DOUBLE) AS fact_value, "
                f"CAST((SELECT {value} FROM sales) - (SELECT {value} FROM fact_sales) AS DOUBLE) "
                "AS difference"
                for name, value in measures.items()
            ),
            "fact_sales",
        ),
    }


def oracle_sql() -> dict[str, str]:
    return {
        **_sources(),
        **_validation(),
        **_model(),
        **_checks(),
        **_filters(),
        **_kpis(),
        **_reports(),
        **_reconciliation(),
    }
