"""DuckDB SQL for every registered query, written independently of the Spark code."""

from __future__ import annotations

from registry.catalog import COUNTRY, OTHER_OWNER, OWNER, PRODUCT, QUESTION, RANKED, STAMP


def _transactions(yearly: bool = False) -> str:
    account = "cast(o_custkey as varchar)"
    if yearly:
        account += " || '-' || cast(year(o_orderdate) as varchar)"
    return f"""
    t as (
      select concat(case when l_returnflag='R' then 'C' else '' end, cast(o_orderkey as varchar)) as invoice_no,
             cast(l_partkey as varchar) as stock_code, p_name as description,
             cast(case when l_returnflag='R' then -l_quantity else l_quantity end as decimal(18,4)) as quantity,
             o_orderdate as invoice_date, cast(p_retailprice as decimal(18,4)) as unit_price,
             case when o_custkey % 10 = 0 then null else {account} end as customer_id,
             n_name as country, c_nationkey as owner_id,
             cast(cast(case when l_returnflag='R' then -l_quantity else l_quantity end as decimal(10,0))
                  * cast(p_retailprice as decimal(10,4)) as decimal(20,4)) as revenue,
             l_returnflag='R' as is_cancellation
      from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey
           join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
    )"""


def _tenths(value: str) -> str:
    """A double to 1 place by its binary value."""
    return f"cast(printf('%.1f', cast({value} as double)) as double)"


def _percent(part: str, whole: str) -> str:
    """Percentage to 2 places, halves up, in whole-number arithmetic."""
    return f"((({part}) * 20000 + ({whole})) // (2 * ({whole}))) / 100.0::double"


MONTH = "strftime(invoice_date, '%Y-%m')"

# A customer with one invoice has the same smallest and greatest invoice.
KINDS = """
    kinds as (
      select customer_id, if(min(invoice_no) = max(invoice_no), 'One-time', 'Repeat') as customer_type
      from t where not is_cancellation and customer_id is not null group by all
    )"""

# A visit is a month in which a customer buys; the earliest names the cohort.
VISITS = """
    visits as (
      select customer_id, month, min(month) over (partition by customer_id) as cohort
      from (select distinct customer_id, date_trunc('month', invoice_date) as month
            from t where not is_cancellation and customer_id is not null)
    ),
    aged as (select *, cast(date_diff('month', cohort, month) as integer) as age from visits)"""


def _summary(part: str, where: str = "", yearly: bool = False) -> str:
    lines = f"""with {_transactions(yearly)}, {KINDS},
    chosen as (select * from t where not is_cancellation {where}),
    orders as (
      select invoice_no, date_trunc('month', invoice_date) as month, sum(revenue) as value from chosen group by all
    )"""
    if part == "monthly":
        return lines + """
    select strftime(month, '%Y-%m') as month, cast(sum(value) as double) as revenue, count(invoice_no) as orders
    from orders group by month"""
    if part == "totals":
        return lines + """
    select cast(ifnull(sum(value), 0) as double) as revenue, count(invoice_no) as orders,
           round(ifnull(avg(value), 0), 4) as aov
    from (select invoice_no, sum(value) as value from orders group by invoice_no)"""
    return lines + f""",
    products as (
      select description as name, cast(sum(revenue) as double) as revenue,
             cast(sum(sum(revenue)) over () as double) as whole
      from chosen group by description
    )
    select name, revenue, if(whole = 0, 0, {_tenths('revenue * 100 / whole')}) as share
    from products where name is not null
    qualify row_number() over (order by revenue desc, name) <= 5"""


def _raw() -> str:
    return """
    sheet as (
      select concat(case when l_returnflag='R' then 'C' else '' end, cast(l_orderkey as varchar)) as InvoiceNo,
             cast(l_partkey as varchar) as StockCode,
             case when l_orderkey % 53 = 0 then null else p_name end as Description,
             cast(case when l_returnflag='R' then -l_quantity else l_quantity end as bigint) as Quantity,
             o_orderdate as InvoiceDate,
             cast(case when l_partkey % 97 = 0 then 0 when l_partkey % 101 = 0 then -1
                  else p_retailprice end as decimal(18,4)) as UnitPrice,
             case when o_custkey % 10 = 0 then null else o_custkey end as CustomerID,
             n_name as Country
      from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey
           join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
    ),
    raw as (select * from sheet union all select * from sheet where StockCode like '%7')"""


PRICED = """
    priced as (
      select *, cast(Quantity * UnitPrice as decimal(20,4)) as Revenue, starts_with(InvoiceNo, 'C') as IsCancellation
      from (select distinct * from raw) where Description is not null
    )"""


def _describe(source: str, columns: list[str]) -> str:
    rows = []
    for c in columns:
        v = f"cast({c} as double)"
        rows.append(
            f"""select '{c}' as "column", count({c}) as count, round(avg({v}), 6) as mean,
                round(stddev_samp({v}), 6) as std, round(min({v}), 6) as min,
                round(quantile_cont({v}, 0.25), 6) as q25, round(quantile_cont({v}, 0.5), 6) as q50,
                round(quantile_cont({v}, 0.75), 6) as q75, round(max({v}), 6) as max from {source}"""
        )
    return " union all ".join(rows)


UPLOAD = """
    u as (
      select case when event_id % 17 = 0 then null else cast(event_id % 4000 as varchar) end as order_id,
             cast(user_id as varchar) as customer_id,
             case when event_id % 23 = 0 then 'not-a-date' when event_id % 29 = 0 then null
                  else strftime(ts, '%Y-%m-%d') end as order_date,
             event_type as product,
             case when event_id % 31 = 0 then 'x' when event_id % 37 = 0 then '-1'
                  else cast(event_id % 7 as varchar) end as qty,
             case when event_id % 41 = 0 then null else cast(cast(value as decimal(18,2)) as varchar) end as unit_price
      from events
    ),
    typed as (
      select *, try_cast(order_date as timestamp) as d, try_cast(qty as double) as q, try_cast(unit_price as double) as p
      from u
    )"""

UPLOAD_REPORT = f"""with {UPLOAD},
    report as (
      select count(*) as rows, 6 as columns, 6 as mapped, 'Revenue, Country, Cancellation flag' as missing,
             count(*) filter (where order_id is null or product is null or d is null or q is null or p is null) as incomplete,
             (select count(*) from u) - (select count(*) from (select distinct * from u)) as "duplicateRows",
             count(*) filter (where d is null) as "invalidDates",
             count(*) filter (where q is null or p is null) as "invalidNumbers",
             count(*) filter (where q < 0) as cancellations
      from typed
    ),
    scored as (select *, {_tenths('greatest(0, 100 - incomplete / rows * 100)')} as quality from report)"""

PREVIEW_REPORT = """with p as (
      select case when event_id % 17 = 0 then '' else cast(event_id % 4000 as varchar) end as "Invoice No",
             case when event_id % 23 = 0 then 'soon' when event_id % 29 = 0 then ''
                  else strftime(ts, '%Y-%m-%d') end as "Order Date",
             event_type as "Item",
             case when event_id % 31 = 0 then 'x' else cast(event_id % 7 as varchar) end as "Qty",
             case when event_id % 41 = 0 then '' else cast(cast(value as decimal(18,2)) as varchar) end as "Sales",
             case when event_id % 19 = 0 then 'Cancelled' when event_id % 43 = 0 then 'RETURNED' else 'ok' end as "Status"
      from events
    ),
    report as (
      select count(*) as rows, 6 as columns, 6 as mapped, 'Customer ID, Unit price, Country' as missing,
             count(*) filter (where "Invoice No" = '' or "Item" = '' or "Order Date" = '' or "Qty" = '' or "Sales" = '') as incomplete,
             (select count(*) from p) - (select count(*) from (select distinct * from p)) as "duplicateRows",
             count(*) filter (where "Order Date" <> '' and try_cast("Order Date" as timestamp) is null) as "invalidDates",
             count(*) filter (where ("Qty" <> '' and try_cast("Qty" as double) is null)
                                 or ("Sales" <> '' and try_cast("Sales" as double) is null)) as "invalidNumbers",
             count(*) filter (where regexp_matches("Status", 'cancel|return|credit|true|^1$', 'i')) as cancellations
      from p
    ),
    scored as (
      select *, cast(greatest(0, floor(100.0 * (rows - incomplete - "invalidDates" - "invalidNumbers") / rows + 0.5)) as bigint) as quality
      from report
    )"""


def _scan_verdicts() -> str:
    faults = 'incomplete + "duplicateRows" + "invalidDates" + "invalidNumbers"'
    return f"""
    select 0 as position, 'scan_completeness' as check_code, incomplete as failing, rows as total,
           case when quality >= 90 then 'pass' else 'warn' end as state from scored
    union all select 1, 'scan_mapping', 9 - mapped, 9, 'warn' from scored
    union all select 2, 'scan_faults', {faults}, rows, case when {faults} > 0 then 'warn' else 'pass' end from scored
    union all select 3, 'scan_returns', cancellations, rows, 'info' from scored"""


def _scan_findings() -> str:
    """The verdicts, each with the figures it rests on."""
    at = {"columns": 0, "quality": 0, "missing": 1, "incomplete": 2, "duplicateRows": 2, "invalidDates": 2, "invalidNumbers": 2}
    figures = ", ".join(f'case when position = {i} then scored."{name}" end as "{name}"' for name, i in at.items())
    return f""", verdicts as ({_scan_verdicts()})
    select verdicts.*, {figures} from verdicts, scored"""


UPSERTED = """with rows as (
          select c_custkey as owner_id, c_name as workspace_name, c_mktsegment as currency,
                 timestamp '1990-01-01 00:00:00' as updated_at, 0 as change from customer
          union all
          select o_custkey, 'after order ' || o_orderkey, o_orderpriority, o_orderdate, 1 from orders
        )
        select owner_id, workspace_name, currency, updated_at from rows
        qualify row_number() over (partition by owner_id
                                   order by updated_at desc, change desc, workspace_name desc, currency desc) = 1"""

SCAN_COLUMNS = (
    'rows, columns, mapped, missing, incomplete, "duplicateRows", "invalidDates", "invalidNumbers", '
    "cancellations, quality"
)

HEALTH = f"""with {_transactions()},
    report as (
      select count(*) as rows_analyzed, count(*) filter (where is_cancellation) as cancellations,
             count(*) filter (where description is null or invoice_date is null or revenue is null) as incomplete_rows
      from t
    ),
    scored as (
      select case when rows_analyzed > 0 then 'connected' else 'dataset_empty' end as status,
             'transactions' as source_table, rows_analyzed, 9 as columns_mapped, 9 as columns_expected,
             '' as missing_columns,
             case when rows_analyzed > 0 then {_tenths('greatest(0, 100 - incomplete_rows / rows_analyzed * 100)')} end as quality_score,
             cancellations, incomplete_rows
      from report
    )"""

REPEAT = " and customer_id in (select customer_id from kinds where customer_type = 'Repeat')"
ONE_TIME = " and customer_id in (select customer_id from kinds where customer_type = 'One-time')"
IN_COUNTRY = f" and country = '{COUNTRY}'"
OF_PRODUCT = f" and description = '{PRODUCT}'"
OF_OWNER = f" and owner_id = {OWNER}"

REPEAT_OWN = f""" and customer_id in (
      select customer_id from t where not is_cancellation and owner_id = {OWNER}
      group by customer_id having count(distinct invoice_no) > 1)"""

COHORT = "strftime(cohort, '%Y-%m') as first_purchase_month"


def _retention(yearly: bool) -> str:
    return f"""with {_transactions(yearly)}, {VISITS},
        present as (select cohort, age, count(*) as active_customers from aged group by all),
        sizes as (select cohort, active_customers as size from present where age = 0)
        select {COHORT}, age as month_number, active_customers,
               {_percent('active_customers', 'size')} as retention_percentage
        from present join sizes using (cohort)"""


def _present(month: int) -> str:
    return f"nullif(count(*) filter (where age = {month}), 0)"


def _matrix(months: int) -> str:
    cells = ", ".join(f"{_percent(_present(m), _present(0))} as m{m}" for m in range(months))
    return f"with {_transactions(True)}, {VISITS} select {COHORT}, {cells} from aged group by cohort"


MONTHLY_POINTS = f"""with {_transactions()},
    points as (
      select {MONTH} as month, sum(revenue) as revenue, count(distinct invoice_no) as orders
      from t where is_cancellation = false group by 1
    )"""

ORACLES: dict[str, str] = {
    "monthly_net_revenue": f"""with {_transactions()}
        select {MONTH} as month, cast(sum(revenue) as double) as net_revenue from t group by 1""",
    "monthly_gross_revenue": f"""with {_transactions()}
        select {MONTH} as month, cast(sum(revenue) as double) as gross_revenue
        from t where is_cancellation = false group by 1""",
    "average_order_value": f"""with {_transactions()}
        select round(avg(o), 4) as average_order_value
        from (select sum(revenue) as o from t where is_cancellation = false group by invoice_no)""",
    "latest_month": MONTHLY_POINTS
    + """select l.month as latest_month, cast(l.revenue as double) as latest_revenue, l.orders as latest_orders,
               h.month as highest_month, cast(h.revenue as double) as highest_revenue
        from (select * from points order by month desc limit 1) l,
             (select * from points order by revenue desc, month limit 1) h""",
    "month_totals": MONTHLY_POINTS
    + """select cast(sum(revenue) as double) as revenue, cast(sum(orders) as bigint) as orders,
               round(cast(sum(revenue) as double) / sum(orders), 4) as aov from points""",
    "customer_segments": f"""with {_transactions(True)}, {KINDS}
        select customer_type, count(*) as customer_count,
               {_percent('count(*)', '(select count(*) from kinds)')} as percentage
        from kinds group by customer_type""",
    "lines_by_customer_type": f"""with {_transactions(True)}, {KINDS}
        select customer_type, count(*) as lines, cast(sum(revenue) as double) as revenue
        from t left join kinds using (customer_id) group by 1""",
    "top_customers": f"""with {_transactions()}
        select customer_id, cast(total as double) as total_revenue
        from (select customer_id, sum(revenue) as total from t where customer_id is not null group by 1
              order by total desc nulls first, customer_id limit 10)""",
    "customer_cohorts": f"""with {_transactions(True)}, {VISITS}
        select distinct customer_id, {COHORT} from visits""",
    "purchase_months": f"""with {_transactions(True)}, {VISITS}
        select customer_id, strftime(month, '%Y-%m') as purchase_month from visits""",
    "month_numbers": f"""with {_transactions(True)}, {VISITS}
        select customer_id, {COHORT}, strftime(month, '%Y-%m') as purchase_month, age as month_number from aged""",
    "cohort_counts": f"""with {_transactions(True)}, {VISITS}
        select {COHORT}, age as month_number, count(*) as active_customers from aged group by all""",
    "cohort_retention": _retention(True),
    "lifetime_retention": _retention(False),
    "cohort_matrix": _matrix(4),
    "cohort_matrix_wide": _matrix(6),
    "top_products": f"""with {_transactions()}
        select stock_code, description, cast(total as double) as total_revenue
        from (select stock_code, description, sum(revenue) as total from t
              where is_cancellation = false and description not in ('DOTCOM POSTAGE', 'POSTAGE')
              group by 1, 2 order by total desc nulls first, stock_code nulls last, description nulls last limit 10)""",
    "ranked_products": "select *, '0' || row_number() over (order by revenue desc, name) as rank from ("
    + _summary("products")
    + ")",
    "summary_monthly": _summary("monthly"),
    "summary_totals": _summary("totals"),
    "summary_products": _summary("products"),
    "summary_monthly_repeat": _summary("monthly", REPEAT, True),
    "summary_monthly_one_time": _summary("monthly", ONE_TIME, True),
    "summary_totals_repeat": _summary("totals", REPEAT, True),
    "summary_totals_one_time": _summary("totals", ONE_TIME, True),
    "summary_products_repeat": _summary("products", REPEAT, True),
    "summary_monthly_country": _summary("monthly", IN_COUNTRY),
    "summary_totals_country": _summary("totals", IN_COUNTRY),
    "summary_totals_product": _summary("totals", OF_PRODUCT),
    "summary_products_product": _summary("products", OF_PRODUCT),
    "summary_totals_all_filters": _summary("totals", REPEAT + IN_COUNTRY + OF_PRODUCT, True),
    "tenant_summary_totals": _summary("totals", OF_OWNER),
    "tenant_summary_repeat": _summary("totals", REPEAT + OF_OWNER, True),
    "tenant_summary_repeat_own": _summary("totals", REPEAT_OWN + OF_OWNER, True),
    "visible_product": f"""select * from ({_summary('products').replace('<= 5', f'<= {RANKED}')}) where name = '{PRODUCT}'""",
    "ask_context": f"""with {_transactions()},
        g as (select * from t where is_cancellation = false),
        totals as (
          select '{{"revenue":"' || coalesce(sum(revenue), 0) || '","orders":' || count(distinct invoice_no)
                 || ',"customers":' || count(distinct customer_id) || '}}' as text from g
        ),
        best as (
          select description, sum(revenue) as revenue from g where description is not null
          group by 1 order by revenue desc, description limit 10
        ),
        listed as (
          select string_agg('{{"product":"' || description || '","revenue":"' || revenue || '"}}', ','
                            order by revenue desc, description) as text from best
        )
        select '{QUESTION}' as question,
               '{{"question":"{QUESTION}","data":{{"totals":' || totals.text || ',"top_products":['
               || listed.text || ']}}}}' as context
        from totals, listed""",
    "table_health": HEALTH + " select * from scored",
    "health_verdicts": HEALTH
    + """
        select 0 as position, 'table_present' as check_code, null::bigint as failing, null::bigint as total,
               case when rows_analyzed > 0 then 'pass' else 'warn' end as state from scored
        union all select 1, 'table_mapping', 0, 9, 'pass'
        union all select 2, 'table_rows', null, rows_analyzed, case when rows_analyzed > 0 then 'pass' else 'info' end from scored
        union all select 3, 'table_completeness', incomplete_rows, rows_analyzed,
               case when quality_score >= 90 then 'pass' else 'warn' end from scored
        union all select 4, 'table_values', incomplete_rows, rows_analyzed,
               case when incomplete_rows > 0 then 'warn' else 'pass' end from scored
        union all select 5, 'table_faults', incomplete_rows, rows_analyzed,
               case when incomplete_rows > 0 then 'warn' else 'info' end from scored
        union all select 6, 'table_returns', cancellations, rows_analyzed, 'info' from scored""",
    "owner_health": f"""with {_transactions()},
        counted as (
          select n_nationkey as owner_id, count(t.owner_id) as rows_analyzed,
                 count(*) filter (where is_cancellation) as cancellations,
                 count(*) filter (where t.owner_id is not null
                   and (description is null or invoice_date is null or revenue is null)) as incomplete_rows
          from nation left join t on owner_id = n_nationkey group by 1
        )
        select owner_id, if(rows_analyzed > 0, 'connected', 'dataset_empty') as status, rows_analyzed,
               if(rows_analyzed > 0, {_tenths('greatest(0, 100 - incomplete_rows / rows_analyzed * 100)')}, null) as quality_score,
               cancellations, incomplete_rows
        from counted""",
    "csv_quality": UPLOAD_REPORT + f" select {SCAN_COLUMNS} from scored",
    "csv_quality_partial": f"""with {UPLOAD},
        p as (select * exclude (qty) from u)
        select count(*) as rows, 5 as columns, 5 as mapped, 'Quantity, Revenue, Country, Cancellation flag' as missing,
               0::bigint as incomplete, count(*) - (select count(*) from (select distinct * from p)) as "duplicateRows",
               0::bigint as "invalidDates", 0::bigint as "invalidNumbers", 0::bigint as cancellations,
               cast(null as double) as quality from p""",
    "csv_quality_dates": f"""with u as (
          select cast(event_id % 4000 as varchar) as o, user_id, event_type, event_id % 7 as q,
                 cast(value as decimal(18,2)) as p, if(event_id % 23 = 0, null, date_trunc('minute', ts)) as d
          from events
        )
        select count(*) as rows, 6 as columns, 6 as mapped, 'Revenue, Country, Cancellation flag' as missing,
               count(*) filter (where d is null) as incomplete,
               count(*) - (select count(*) from (select distinct * from u)) as "duplicateRows",
               count(*) filter (where d is null) as "invalidDates", 0::bigint as "invalidNumbers",
               0::bigint as cancellations,
               {_tenths('100 - count(*) filter (where d is null) / count(*) * 100')} as quality from u""",
    "validation_large_numbers": """with n as (
          select count(*) filter (where event_id % 43 = 0 or event_id % 47 = 0 or event_id % 59 = 0) as large from events
        )
        select 0 as position, 'order_id_missing' as rule, 'Some orders are missing order IDs.' as message, 0 as rows
        union all select 1, 'date_missing', 'Some rows have missing dates.', 0
        union all select 2, 'quantity_missing', 'Some rows have missing quantities.', 0
        union all select 3, 'price_missing', 'Some rows have missing prices.', 0
        union all select 4, 'quantity_not_positive', 'Some rows have zero or negative quantities.', 0
        union all select 5, 'price_not_positive', 'Some rows have zero or negative prices.', 0
        union all select 6, 'number_not_stored', 'Some rows have numbers too large to store.', large from n""",
    "quality_verdicts": UPLOAD_REPORT + _scan_findings(),
    "preview_scan": PREVIEW_REPORT + f" select {SCAN_COLUMNS} from scored",
    "preview_verdicts": PREVIEW_REPORT + _scan_verdicts(),
    "validation_rules": f"""with {UPLOAD}
        select 0 as position, 'order_id_missing' as rule, 'Some orders are missing order IDs.' as message,
               count(*) filter (where order_id is null) as rows from typed
        union all select 1, 'date_missing', 'Some rows have missing dates.', count(*) filter (where d is null) from typed
        union all select 2, 'quantity_missing', 'Some rows have missing quantities.', count(*) filter (where q is null) from typed
        union all select 3, 'price_missing', 'Some rows have missing prices.', count(*) filter (where p is null) from typed
        union all select 4, 'quantity_not_positive', 'Some rows have zero or negative quantities.', count(*) filter (where q <= 0) from typed
        union all select 5, 'price_not_positive', 'Some rows have zero or negative prices.', count(*) filter (where p <= 0) from typed
        union all select 6, 'number_not_stored', 'Some rows have numbers too large to store.',
               count(*) filter (where abs(q) >= 1e14 or abs(p) >= 1e14 or abs(q * p) >= 1e16) from typed""",
    "upload_standardize": f"""with {UPLOAD}
        select order_id as invoice_no, customer_id, product as description, q as quantity, d as invoice_date,
               p as unit_price, 'Unknown' as country,
               cast(cast(q * p as decimal(20,4)) as double) as revenue, coalesce(q < 0, false) as is_cancellation,
               {OWNER} as owner_id
        from typed""",
    "clean_transactions": f"""with {_raw()}, {PRICED}
        select InvoiceNo as invoice_no, StockCode as stock_code, Description as description,
               cast(Quantity as double) as quantity, InvoiceDate as invoice_date, cast(UnitPrice as double) as unit_price,
               cast(CustomerID as varchar) as customer_id, Country as country, cast(Revenue as double) as revenue,
               IsCancellation as is_cancellation
        from priced where UnitPrice > 0""",
    "profile_shape": f"with {_raw()} select count(*) as rows, 8 as columns from raw",
    "profile_nulls": f"with {_raw()} "
    + " union all ".join(
        f"""select '{c}' as "column", count(*) filter (where {c} is null) as nulls from raw"""
        for c in ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    ),
    "profile_duplicates": f"""with {_raw()}
        select (select count(*) from raw) - (select count(*) from (select distinct * from raw)) as duplicates""",
    "profile_describe": f"with {_raw()} " + _describe("raw", ["Quantity", "UnitPrice", "CustomerID"]),
    "profile_describe_times": f"""with {_raw()}, s as (select epoch(InvoiceDate) as v from raw),
        p as (
          select count(v) as count, avg(v) as mean, min(v) as min, quantile_cont(v, 0.25) as q25,
                 quantile_cont(v, 0.5) as q50, quantile_cont(v, 0.75) as q75, max(v) as max from s
        )
        select 'InvoiceDate' as "column", count, """
    + ", ".join(
        f"strftime(make_timestamp(cast(round({c} * 1000000) as bigint)), '%Y-%m-%d %H:%M:%S') as {c}"
        for c in ["mean", "min", "q25", "q50", "q75", "max"]
    )
    + " from p",
    "profile_cancelled": f"with {_raw()}, c as (select * from raw where starts_with(InvoiceNo, 'C')) "
    + _describe("c", ["Quantity", "UnitPrice"]),
    "profile_flags": f"""with {_raw()}
        select coalesce(starts_with(InvoiceNo, 'C'), false) as is_cancellation, count(*) as rows from raw group by 1""",
    "revenue_describe": f"with {_raw()}, {PRICED} " + _describe("priced", ["Revenue"]),
    "price_sign_counts": f"""with {_raw()}, {PRICED}
        select count(*) filter (where UnitPrice < 0) as negative_prices,
               count(*) filter (where UnitPrice = 0) as zero_prices,
               count(*) filter (where UnitPrice > 0) as positive_prices from priced""",
    "negative_price_rows": f"""with {_raw()}, {PRICED}
        select InvoiceNo, StockCode, Description, Quantity, InvoiceDate, cast(UnitPrice as double) as UnitPrice,
               CustomerID, Country, cast(Revenue as double) as Revenue, IsCancellation
        from priced where UnitPrice < 0""",
    "zero_price_rows": f"""with {_raw()}, {PRICED}
        select InvoiceNo, StockCode, Description, Quantity, InvoiceDate, cast(UnitPrice as double) as UnitPrice,
               CustomerID, Country, cast(Revenue as double) as Revenue, IsCancellation
        from (select * from priced where UnitPrice = 0 order by all nulls last limit 10)""",
    "extreme_revenue": f"""with {_raw()}, {PRICED}
        select InvoiceNo, StockCode, Quantity, cast(UnitPrice as double) as UnitPrice, cast(Revenue as double) as Revenue
        from (select * from priced where abs(Revenue) > 10000
              order by abs(Revenue) desc, InvoiceNo, StockCode, Quantity, UnitPrice, Revenue limit 10)""",
    "demo_transactions": """with months as (
          select year(o_orderdate) as y, month(o_orderdate) as m,
                 sum(cast(round(o_totalprice * 100) as bigint))::hugeint as cents, count(*) as n
          from orders group by 1, 2
        ),
        numbered as (
          select y, m, cents, n, i, row_number() over (order by y, m, i) as k
          from months, lateral (select unnest(generate_series(1, n)) as i)
        ),
        priced as (select *, cast((cents * 200 + n) // (2 * n) as double) / 10000 as price, (i * 7 + m) % 5 as r from numbered)
        select 'DEMO-' || y || '-' || lpad(cast(m as varchar), 2, '0') || '-' || format('{:05d}', i) as invoice_no,
               'SKU-' || lpad(cast(r + 1 as varchar), 2, '0') as stock_code,
               case r when 0 then 'Sterling silver pendant' when 1 then 'Classic leather tote'
                      when 2 then 'Ceramic coffee set' when 3 then 'Linen lounge shirt' else 'Hand-poured candle' end as description,
               1.0::double as quantity,
               make_timestamp(y, m, 1, 0, 0, 0) + to_days(cast(i % 28 as integer)) as invoice_date,
               price as unit_price,
               case when k <= 3197 then 'C-ONE-' || format('{:05d}', k)
                    else 'C-REP-' || format('{:05d}', (k - 3198) % 5215 + 1) end as customer_id,
               case (i + m) % 3 when 0 then 'United Kingdom' when 1 then 'United States' else 'Germany' end as country,
               price as revenue, false as is_cancellation
        from priced""",
    "upsert_stamped": f"""with changed as (
          select o_custkey as owner_id, 'after order ' || o_orderkey as workspace_name, o_orderpriority as currency
          from orders
          qualify row_number() over (partition by o_custkey order by 'after order ' || o_orderkey desc, o_orderpriority desc) = 1
        )
        select owner_id, workspace_name, currency, timestamp '{STAMP}' as updated_at from changed
        union all
        select c_custkey, c_name, c_mktsegment, timestamp '1990-01-01 00:00:00' from customer
        where c_custkey not in (select owner_id from changed)""",
    "upsert_latest": UPSERTED,
    "stored_upsert": UPSERTED,
    "stored_tenants": f"""with {_transactions()},
        kept as (select * from t where owner_id = {OTHER_OWNER} or (owner_id = {OWNER} and not is_cancellation))
        select owner_id, count(*) as lines, count(distinct invoice_no) as orders, cast(sum(revenue) as double) as revenue
        from kept group by owner_id""",
    "csv_file_quality": UPLOAD_REPORT + f" select {SCAN_COLUMNS} from scored",
    "csv_records": """select cast(event_id as varchar) as event_id,
               'said "' || event_type || '", ' || repeat('then' || chr(10), (event_id % 4)::int)
                 || if(event_id % 5 = 0, '"', 'end') as note, event_type as kind
        from events""",
    "csv_preview": f"""with {UPLOAD.replace("select case when event_id % 17", "select event_id, case when event_id % 17", 1)}
        select cast(event_id as varchar) as event_id, coalesce(order_id, '') as order_id, customer_id,
               coalesce(order_date, '') as order_date, product, qty, coalesce(unit_price, '') as unit_price
        from u order by u.event_id limit 300""",
    "upload_reports": f"""with {UPLOAD},
        marked as (select event_id % 23 = 0 as bad from events)
        select 'plain' as upload, 'ok' as status, 6 as columns, 6 as mapped, 'Revenue, Country, Cancellation flag' as missing,
               count(*) as rows,
               count(*) filter (where order_id is null or product is null or d is null or q is null or p is null) as incomplete,
               count(*) filter (where d is null) as "invalidDates", count(*) filter (where q is null or p is null) as "invalidNumbers",
               count(*) filter (where q < 0) as cancellations
        from typed
        union all
        select 'dated', 'ok', 6, 6, 'Revenue, Country, Cancellation flag', count(*), count(*) filter (where bad),
               count(*) filter (where bad), 0, 0 from marked
        union all
        select 'bare', 'ok', 3, 3, 'Customer ID, Order date, Revenue, Unit price, Country, Cancellation flag', count(*), 0, 0, 0, 0 from u""",
}

# The SQL functions answer the same questions.
ORACLES |= {
    "sql_cohort_retention": ORACLES["cohort_retention"],
    "sql_customer_segments": ORACLES["customer_segments"],
    "sql_summary_products": ORACLES["summary_products_repeat"],
    "sql_summary_monthly": ORACLES["summary_monthly_country"],
}
