"""Registered queries by name. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import inputs
from tillscope import sql
from tillscope.operators import clean, profile, quality, standardize, upsert
from tillscope.plans import cohorts, context, customers, products, revenue
from tillscope.plans.summary import Summary
from tillscope.session import shared_folder, stored
from tillscope.sinks import keyed, writers
from tillscope.sinks.results import api_rows
from tillscope.sources.demo import generate_transactions
from tillscope.sources.files import nulls_from_text, read_csv_text, read_preview, read_upload
from tillscope.sources.tables import as_transactions, ensure_tenant_table, tenant_rows
from tillscope.sources.uploads import upload_reports

Query = Callable[[SparkSession, str], DataFrame]

COUNTRY = "NATION_7"
PRODUCT = "small ring"
OWNER = 7
OTHER_OWNER = 11
RANKED = 200
STAMP = "2026-01-01 12:00:00"
QUESTION = "Which products should we promote?"


def _on_transactions(plan: Callable[[DataFrame], DataFrame], **shape) -> Query:
    return lambda spark, sf_dir: api_rows(plan(inputs.transactions(spark, sf_dir, **shape)))


def _summary(part: str, segment=None, country=None, product=None, **kwargs) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        needs_place = bool(country) or "owner_id" in kwargs
        rows = inputs.transactions(
            spark, sf_dir, country=needs_place, yearly_accounts=segment is not None
        )
        summary = Summary(rows, segment=segment, country=country, product=product, **kwargs)
        result = summary.top_products() if part == "products" else getattr(summary, part)
        if part == "totals":
            result = result.withColumn("aov", F.round("aov", 4))
        return api_rows(result)

    return run


def _lines_by_type(rows: DataFrame) -> DataFrame:
    typed = customers.lines_with_type(rows)
    return typed.groupBy("customer_type").agg(F.count("*").alias("lines"), F.sum("revenue").alias("revenue"))


def _rounded_aov(rows: DataFrame) -> DataFrame:
    value = F.round("average_order_value", 4).alias("average_order_value")
    return revenue.average_order_value(rows).select(value)


def _cohort_matrix(rows: DataFrame) -> DataFrame:
    return cohorts.cohort_matrix(rows, max_month=3)


def _wide_matrix(rows: DataFrame) -> DataFrame:
    return cohorts.cohort_matrix(rows, max_month=5)


def _ranked_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api_rows(products.with_rank(Summary(inputs.transactions(spark, sf_dir)).top_products()))


def _joined(report: DataFrame, column: str) -> DataFrame:
    return report.withColumn(column, F.array_join(column, ", "))


def _table_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.transactions(spark, sf_dir, country=True)
    return _joined(quality.table_health(rows), "missing_columns")


def _health_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.health_verdicts(quality.table_health(inputs.transactions(spark, sf_dir, country=True)))


def _uploaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nulls_from_text(inputs.raw_upload(spark, sf_dir))


def _standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.standardize(_uploaded(spark, sf_dir), date_format="yyyy-MM-dd")


def _csv_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(quality.csv_quality(_uploaded(spark, sf_dir)), "missing")


def _visible_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = Summary(inputs.transactions(spark, sf_dir)).top_products(RANKED)
    return api_rows(products.visible_products(best, PRODUCT))


def _partial_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(quality.csv_quality(_uploaded(spark, sf_dir).drop("qty")), "missing")


def _dated_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(quality.csv_quality(nulls_from_text(inputs.dated_upload(spark, sf_dir))), "missing")


def _large_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nulls_from_text(inputs.large_upload(spark, sf_dir))
    return quality.validation_report(standardize.standardize(rows, date_format="yyyy-MM-dd"))


def _owner_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = inputs.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("owner_id"))
    return quality.owners_health(inputs.transactions(spark, sf_dir, country=True), owners)


def _preview_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(quality.preview_scan(inputs.preview_upload(spark, sf_dir)), "missing")


def _quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scan_findings(quality.csv_quality(_uploaded(spark, sf_dir)))


def _preview_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.preview_scan(inputs.preview_upload(spark, sf_dir))
    return quality.scan_verdicts(report)


def _describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    described = profile.describe(df, columns)
    return described.withColumns({c: F.round(c, 6) for c in described.columns if c not in ("column", "count")})


def _describe_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = profile.describe_times(inputs.raw_retail(spark, sf_dir), ["InvoiceDate"])
    points = [c for c in described.columns if c not in ("column", "count")]
    return described.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in points})


def _stored_duplicates(raw: DataFrame) -> DataFrame:
    """The sheet is read twice, so its joins are made once."""
    return profile.duplicate_count(stored(raw, "sheet"))


def _on_raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: api_rows(plan(inputs.raw_retail(spark, sf_dir)))


def _month_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Summary(inputs.transactions(spark, sf_dir)).monthly


def _upsert(spark: SparkSession, sf_dir: str, stamp=None) -> DataFrame:
    return upsert.upsert_latest(
        inputs.account_settings(spark, sf_dir),
        inputs.settings_changes(spark, sf_dir),
        keys=["owner_id"],
        order_column="updated_at",
        stamp=stamp,
    )


def _upsert_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, F.expr(f"timestamp_ntz'{STAMP}'"))


def _from_sql(name: str, yearly: bool = False, **parameters) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs.transactions(spark, sf_dir, country=True, yearly_accounts=yearly).createOrReplaceTempView("sql_lines")
        sql.register(spark, "sql_lines")
        return api_rows(sql.call(spark, name, **parameters))

    return run


def _stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings as a stored table in buckets; the changes of some customers applied to it."""
    name = f"keyed_{uuid.uuid4().hex}"
    keyed.create_keyed(
        inputs.account_settings(spark, sf_dir), name, ["owner_id"], location=f"{shared_folder(spark)}/{name}"
    )
    keyed.upsert_stored(inputs.settings_changes(spark, sf_dir), name, "updated_at")
    return keyed.keyed_rows(spark, name)


def _stored_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two owners stored; one owner's replaced by what wasn't cancelled; totals by owner."""
    name = f"tenants_{uuid.uuid4().hex}"
    ensure_tenant_table(spark, name, f"{shared_folder(spark)}/{name}")
    rows = inputs.transactions(spark, sf_dir, country=True).drop("stock_code")
    for owner in (OWNER, OTHER_OWNER):
        writers.replace_owner(tenant_rows(rows, owner), owner, name)
    kept = tenant_rows(spark.table(name), OWNER).where(~F.col("is_cancellation"))
    writers.replace_owner(kept, OWNER, name)
    totals = as_transactions(spark.table(name)).groupBy("owner_id").agg(
        F.count("*").alias("lines"), F.countDistinct("invoice_no").alias("orders"), F.sum("revenue").alias("revenue")
    )
    return api_rows(totals)


def _csv(df: DataFrame, name: str) -> str:
    """``df`` as CSV files with headers in the shared folder, one for each task."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def _csv_file_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv(inputs.raw_upload(spark, sf_dir), "upload")
    return _joined(quality.csv_quality(read_upload(spark, f"{path}/*.csv")), "missing")


def _csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with line breaks, quotes and commas, written to CSV and read back in splits."""
    path = _csv(inputs.noted_events(spark, sf_dir), "notes")
    return read_csv_text(spark, f"{path}/*.csv", multi_line=True)


def _csv_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of files that hold the events in order."""
    path = _csv(inputs.raw_upload(spark, sf_dir, numbered=True).orderBy("event_id"), "preview")
    return read_preview(spark, f"{path}/*.csv")


def _upload_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three uploads with headers of their own, a folder each, in one job; figures summed by folder."""
    root = f"{shared_folder(spark)}/uploads-{uuid.uuid4().hex}"
    for name, df in inputs.uploads(spark, sf_dir).items():
        df.write.option("header", True).option("escape", '"').csv(f"{root}/{name}")
    report = upload_reports(spark, f"{root}/*/*.csv")
    figures = ("rows", "incomplete", "invalidDates", "invalidNumbers", "cancellations")
    return report.groupBy(F.regexp_extract("file", "/([a-z]+)/[^/]*$", 1).alias("upload"), "status", "columns", "mapped").agg(
        F.array_join(F.max("missing"), ", ").alias("missing"), *[F.sum(f).alias(f) for f in figures]
    )


QUERIES: dict[str, Query] = {
    # Revenue and orders
    "monthly_net_revenue": _on_transactions(revenue.monthly_net_revenue),
    "monthly_gross_revenue": _on_transactions(revenue.monthly_gross_revenue),
    "average_order_value": _on_transactions(_rounded_aov),
    "latest_month": lambda spark, sf_dir: api_rows(revenue.month_highlights(_month_points(spark, sf_dir))),
    "month_totals": lambda spark, sf_dir: api_rows(
        revenue.totals_from_months(_month_points(spark, sf_dir)).withColumn("aov", F.round("aov", 4))
    ),
    # Customers
    "customer_segments": _on_transactions(customers.customer_segments, priced=False, yearly_accounts=True),
    "lines_by_customer_type": _on_transactions(_lines_by_type, yearly_accounts=True),
    "top_customers": _on_transactions(customers.top_customers),
    # Cohorts
    "customer_cohorts": _on_transactions(cohorts.customer_cohorts, priced=False, yearly_accounts=True),
    "purchase_months": _on_transactions(cohorts.purchase_months, priced=False, yearly_accounts=True),
    "month_numbers": _on_transactions(cohorts.month_numbers, priced=False, yearly_accounts=True),
    "cohort_counts": _on_transactions(cohorts.cohort_counts, priced=False, yearly_accounts=True),
    "cohort_retention": _on_transactions(cohorts.cohort_retention, priced=False, yearly_accounts=True),
    "cohort_matrix": _on_transactions(_cohort_matrix, priced=False, yearly_accounts=True),
    "cohort_matrix_wide": _on_transactions(_wide_matrix, priced=False, yearly_accounts=True),
    "lifetime_retention": _on_transactions(cohorts.cohort_retention, priced=False),
    # Products
    "top_products": _on_transactions(products.top_products),
    "ranked_products": _ranked_products,
    # Filtered summary
    "summary_monthly": _summary("monthly"),
    "summary_totals": _summary("totals"),
    "summary_products": _summary("products"),
    "summary_monthly_repeat": _summary("monthly", segment="Repeat customers"),
    "summary_monthly_one_time": _summary("monthly", segment="One-time customers"),
    "summary_totals_repeat": _summary("totals", segment="Repeat customers"),
    "summary_totals_one_time": _summary("totals", segment="One-time customers"),
    "summary_products_repeat": _summary("products", segment="Repeat customers"),
    "summary_monthly_country": _summary("monthly", country=COUNTRY),
    "summary_totals_country": _summary("totals", country=COUNTRY),
    "summary_totals_product": _summary("totals", product=PRODUCT),
    "summary_products_product": _summary("products", product=PRODUCT),
    "summary_totals_all_filters": _summary(
        "totals", segment="Repeat customers", country=COUNTRY, product=PRODUCT
    ),
    "tenant_summary_totals": _summary("totals", owner_id=OWNER),
    "tenant_summary_repeat": _summary("totals", segment="Repeat customers", owner_id=OWNER),
    "tenant_summary_repeat_own": _summary(
        "totals", segment="Repeat customers", owner_id=OWNER, segment_scope="owner"
    ),
    "visible_product": _visible_product,
    # Question context
    "ask_context": lambda spark, sf_dir: context.ask_context(inputs.transactions(spark, sf_dir), QUESTION),
    # Quality
    "table_health": _table_health,
    "health_verdicts": _health_verdicts,
    "csv_quality": _csv_quality,
    "quality_verdicts": _quality_verdicts,
    "preview_scan": _preview_scan,
    "preview_verdicts": _preview_verdicts,
    "validation_rules": lambda spark, sf_dir: quality.validation_report(_standardized(spark, sf_dir)),
    "upload_standardize": lambda spark, sf_dir: api_rows(
        standardize.upload_records(_standardized(spark, sf_dir), OWNER)
    ),
    "csv_quality_partial": _partial_upload,
    "csv_quality_dates": _dated_quality,
    "validation_large_numbers": _large_numbers,
    "owner_health": _owner_health,
    # Cleaning and profiling
    "clean_transactions": _on_raw(lambda raw: clean.to_transactions(clean.clean(raw))),
    "profile_shape": _on_raw(profile.shape),
    "profile_nulls": _on_raw(profile.null_counts),
    "profile_duplicates": _on_raw(_stored_duplicates),
    "profile_describe": _on_raw(_describe),
    "profile_describe_times": _describe_times,
    "profile_cancelled": _on_raw(lambda raw: _describe(profile.cancelled_rows(raw), ["Quantity", "UnitPrice"])),
    "profile_flags": _on_raw(profile.cancellation_flags),
    "revenue_describe": _on_raw(lambda raw: _describe(clean.price_lines(raw), ["Revenue"])),
    "price_sign_counts": _on_raw(lambda raw: profile.price_sign_counts(clean.price_lines(raw))),
    "negative_price_rows": _on_raw(lambda raw: profile.negative_price_rows(clean.price_lines(raw))),
    "zero_price_rows": _on_raw(lambda raw: profile.zero_price_rows(clean.price_lines(raw))),
    "extreme_revenue": _on_raw(lambda raw: profile.extreme_revenue(clean.price_lines(raw))),
    # Generated lines and upsert
    "demo_transactions": lambda spark, sf_dir: api_rows(
        generate_transactions(inputs.order_months(spark, sf_dir))
    ),
    "upsert_latest": _upsert,
    "upsert_stamped": _upsert_stamped,
    # The same reports as SQL functions with bound parameters
    "sql_cohort_retention": _from_sql("cohort_retention", yearly=True),
    "sql_customer_segments": _from_sql("customer_segments", yearly=True),
    "sql_summary_products": _from_sql("summary_products", yearly=True, segment="Repeat customers"),
    "sql_summary_monthly": _from_sql("summary_monthly", country=COUNTRY),
    # Stored tables and files
    "stored_upsert": _stored_upsert,
    "stored_tenants": _stored_tenants,
    "csv_file_quality": _csv_file_quality,
    "csv_records": _csv_records,
    "csv_preview": _csv_preview,
    "upload_reports": _upload_reports,
}
