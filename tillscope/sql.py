"""The analytics as SQL: temporary table functions over a fact table, called with bound parameters.

``register`` makes one function per report; they can be joined and filtered like
tables: ``SELECT * FROM top_customers(5)``. Parameters are values, never text of a
statement: ``call`` and ``spark.sql(..., args=...)`` bind them, so quotes in a value
change nothing but the value. The functions are SQL, so Spark plans them as part of the
statement that calls them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillscope.schemas import ALL_COUNTRIES, ALL_CUSTOMERS, ALL_PRODUCTS, ONE_TIME, POSTAGE, REPEAT, SEGMENT_TYPES


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _chosen(parameter: str, everything: str) -> str:
    """Whether a filter choice means anything: not for null, an empty text or the word for all."""
    return f"coalesce({parameter}, '') NOT IN ('', {_text(everything)})"


def _percentage(part: str, whole: str) -> str:
    ratio = f"try_divide(CAST({part} AS DECIMAL(20,0)) * 100.0, CAST({whole} AS DECIMAL(20,0)))"
    return f"CAST(round({ratio}, 2) AS DECIMAL(9,2))"


_MONTH = "trunc(invoice_date, 'MM')"
_TYPE = f"CASE WHEN count(invoice_no) = 1 THEN {_text(ONE_TIME)} ELSE {_text(REPEAT)} END"
_KIND = (
    "CASE "
    + " ".join(f"WHEN segment = {_text(k)} THEN {_text(v)}" for k, v in SEGMENT_TYPES.items())
    + f" ELSE {_text(ONE_TIME)} END"
)
_CHOICES = "segment STRING DEFAULT NULL, country STRING DEFAULT NULL, product STRING DEFAULT NULL"
_POSTAGE = ", ".join(map(_text, POSTAGE))


def _bodies(table: str) -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, columns, query). A function may use those before it."""
    bought = f"{table} t WHERE NOT t.is_cancellation AND t.customer_id IS NOT NULL"
    types = f"""SELECT customer_id, {_TYPE} AS customer_type
        FROM (SELECT DISTINCT t.customer_id, t.invoice_no FROM {bought}) GROUP BY customer_id"""
    chosen = f"""SELECT t.invoice_no, t.invoice_date, t.description, t.revenue FROM {table} t
        LEFT JOIN ({types}) k ON t.customer_id = k.customer_id
        WHERE NOT t.is_cancellation
          AND (NOT {_chosen('selected_lines.country', ALL_COUNTRIES)} OR t.country = selected_lines.country)
          AND (NOT {_chosen('selected_lines.product', ALL_PRODUCTS)} OR t.description = selected_lines.product)
          AND (NOT {_chosen('selected_lines.segment', ALL_CUSTOMERS)} OR k.customer_type = {_KIND.replace('segment', 'selected_lines.segment')})"""

    def lines(name: str) -> str:
        return f"selected_lines({name}.segment, {name}.country, {name}.product)"

    return {
        "binary_tenths": (
            "x DOUBLE", "DOUBLE",
            # the digits of a double by its binary value, in whole numbers
            """CASE WHEN abs(x) >= 4503599627370496D THEN x ELSE sign(x) * CAST((floor(abs(x)) * 10
                 + shiftright(CAST((abs(x) - floor(abs(x))) * 144115188075855872D AS BIGINT) * 10, 57)
                 + CASE WHEN (CAST((abs(x) - floor(abs(x))) * 144115188075855872D AS BIGINT) * 10 & 144115188075855871L) > 72057594037927936L
                          OR ((CAST((abs(x) - floor(abs(x))) * 144115188075855872D AS BIGINT) * 10 & 144115188075855871L) = 72057594037927936L
                              AND shiftright(CAST((abs(x) - floor(abs(x))) * 144115188075855872D AS BIGINT) * 10, 57) % 2 = 1)
                        THEN 1 ELSE 0 END) AS DECIMAL(20,0)) / 10 END""",
        ),
        "monthly_net_revenue": (
            "", "month DATE, net_revenue DECIMAL(30,4)",
            f"SELECT {_MONTH}, sum(revenue) FROM {table} GROUP BY 1",
        ),
        "monthly_gross_revenue": (
            "", "month DATE, gross_revenue DECIMAL(30,4)",
            f"SELECT {_MONTH}, sum(revenue) FROM {table} WHERE NOT is_cancellation GROUP BY 1",
        ),
        "average_order_value": (
            "", "average_order_value DECIMAL(34,8)",
            f"""SELECT avg(revenue) FROM (SELECT sum(revenue) AS revenue FROM {table}
                WHERE NOT is_cancellation GROUP BY invoice_no)""",
        ),
        "customer_segments": (
            "", "customer_type STRING, customer_count BIGINT, percentage DECIMAL(9,2)",
            f"""SELECT customer_type, n, {_percentage('n', 'sum(n) OVER ()')}
                FROM (SELECT customer_type, count(*) AS n FROM ({types}) GROUP BY customer_type)""",
        ),
        "customer_cohorts": (
            "", "customer_id STRING, first_purchase_month DATE",
            f"SELECT t.customer_id, trunc(min(t.invoice_date), 'MM') FROM {bought} GROUP BY t.customer_id",
        ),
        "purchase_months": (
            "", "customer_id STRING, purchase_month DATE",
            f"SELECT DISTINCT t.customer_id, trunc(t.invoice_date, 'MM') FROM {bought}",
        ),
        "month_numbers": (
            "", "customer_id STRING, first_purchase_month DATE, purchase_month DATE, month_number INT",
            """SELECT customer_id, first, purchase_month,
                      (year(purchase_month) - year(first)) * 12 + month(purchase_month) - month(first)
               FROM (SELECT *, min(purchase_month) OVER (PARTITION BY customer_id) AS first FROM purchase_months())""",
        ),
        "cohort_counts": (
            "", "first_purchase_month DATE, month_number INT, active_customers BIGINT",
            "SELECT first_purchase_month, month_number, count(*) FROM month_numbers() GROUP BY 1, 2",
        ),
        "cohort_retention": (
            "", "first_purchase_month DATE, month_number INT, active_customers BIGINT, retention_percentage DECIMAL(9,2)",
            f"""SELECT *, {_percentage('active_customers', '''first(active_customers) OVER
                (PARTITION BY first_purchase_month ORDER BY month_number ASC NULLS LAST)''')} FROM cohort_counts()""",
        ),
        "cohort_matrix": (
            "", "first_purchase_month DATE, m0 DECIMAL(9,2), m1 DECIMAL(9,2), m2 DECIMAL(9,2), m3 DECIMAL(9,2)",
            f"""SELECT first_purchase_month, {', '.join(_percentage(f'a{m}', 'a0') for m in range(4))}
                FROM (SELECT first_purchase_month, {', '.join(f'max(active_customers) FILTER (WHERE month_number = {m}) AS a{m}' for m in range(4))}
                      FROM cohort_counts() GROUP BY first_purchase_month)""",
        ),
        "top_customers": (
            "places INT DEFAULT 10", "customer_id STRING, total_revenue DECIMAL(30,4)",
            f"""SELECT customer_id, total FROM (
                  SELECT customer_id, sum(revenue) AS total, row_number() OVER (ORDER BY sum(revenue) DESC NULLS FIRST, customer_id) AS place
                  FROM {table} WHERE customer_id IS NOT NULL GROUP BY customer_id)
                WHERE place <= top_customers.places""",
        ),
        "top_products": (
            "places INT DEFAULT 10", "stock_code STRING, description STRING, total_revenue DECIMAL(30,4)",
            f"""SELECT stock_code, description, total FROM (
                  SELECT stock_code, description, sum(revenue) AS total, row_number() OVER (
                    ORDER BY sum(revenue) DESC NULLS FIRST, stock_code ASC NULLS LAST, description ASC NULLS LAST) AS place
                  FROM {table} WHERE NOT is_cancellation AND description NOT IN ({_POSTAGE}) GROUP BY stock_code, description)
                WHERE place <= top_products.places""",
        ),
        "selected_lines": (
            _CHOICES, "invoice_no STRING, invoice_date TIMESTAMP_NTZ, description STRING, revenue DECIMAL(20,4)", chosen,
        ),
        "summary_monthly": (
            _CHOICES, "month STRING, revenue DECIMAL(38,4), orders BIGINT",
            f"""SELECT date_format(month, 'yyyy-MM'), coalesce(sum(revenue), 0), count(invoice_no)
                FROM (SELECT {_MONTH} AS month, invoice_no, sum(revenue) AS revenue FROM {lines('summary_monthly')} GROUP BY 1, 2)
                GROUP BY month""",
        ),
        "summary_totals": (
            _CHOICES, "revenue DECIMAL(38,4), orders BIGINT, aov DECIMAL(38,8)",
            f"""SELECT coalesce(sum(revenue), 0), count(invoice_no), coalesce(avg(revenue), 0)
                FROM (SELECT invoice_no, sum(revenue) AS revenue FROM {lines('summary_totals')} GROUP BY invoice_no)""",
        ),
        "summary_products": (
            _CHOICES + ", places INT DEFAULT 5", "name STRING, revenue DECIMAL(30,4), share DOUBLE",
            f"""SELECT description, revenue, CASE WHEN whole = 0 THEN 0D
                         ELSE binary_tenths(CAST(revenue AS DOUBLE) * 100 / CAST(whole AS DOUBLE)) END
                FROM (SELECT description, coalesce(revenue, 0) AS revenue, sum(revenue) OVER () AS whole,
                             row_number() OVER (ORDER BY description IS NULL, coalesce(revenue, 0) DESC, description) AS place
                      FROM (SELECT description, sum(revenue) AS revenue FROM {lines('summary_products')} GROUP BY description))
                WHERE place <= summary_products.places AND description IS NOT NULL""",
        ),
        "ask_context": (
            "question STRING", "question STRING, context STRING",
            f"""SELECT trim(ask_context.question), to_json(struct(trim(ask_context.question) AS question, struct(
                  struct(CAST(totals.revenue AS STRING) AS revenue, totals.orders, totals.customers) AS totals, listed.top_products) AS data))
                FROM (SELECT coalesce(sum(revenue), 0) AS revenue, count(DISTINCT invoice_no) AS orders,
                             count(DISTINCT customer_id) AS customers FROM {table} WHERE NOT is_cancellation) totals,
                     (SELECT transform(sort_array(collect_list(struct(-revenue AS place, name, revenue))),
                             p -> struct(p.name AS product, CAST(p.revenue AS STRING) AS revenue)) AS top_products
                      FROM summary_products(places => 10)) listed""",
        ),
    }


#: Functions that are no reports.
HELPERS = ("binary_tenths", "selected_lines")


def register(spark: SparkSession, table: str) -> list[str]:
    """Makes the temporary functions over a catalog table or view; returns the names of the reports."""
    bodies = _bodies(table)
    for name, (parameters, columns, query) in bodies.items():
        kind = columns if name == "binary_tenths" else f"TABLE ({columns})"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {query}")
    return [name for name in bodies if name not in HELPERS]


def call(spark: SparkSession, name: str, **parameters) -> DataFrame:
    """The rows of a registered report; parameters are bound by name."""
    if not name.isidentifier() or not all(p.isidentifier() for p in parameters):
        raise ValueError(f"not a report: {name}")
    given = ", ".join(f"{p} => :{p}" for p in parameters)
    return spark.sql(f"SELECT * FROM {name}({given})", args=parameters)
