"""Reference answers as single SQL statements over the test tables.

Written independently of the DataFrame code: typed values come straight from the
tables, and the plan join is a union folded by cell. One list of named steps
feeds every statement.
"""

from __future__ import annotations

_STEPS = {
    "places": """
        select n_nationkey, n_name, r_name
        from nation left join region on n_regionkey = r_regionkey""",
    "raw_orders": """
        select
            (case when l_orderkey % 10 = 9 then 'ORD9-' else 'ORD0-' end)
              || l_orderkey || '-' || l_linenumber
              || (case when l_orderkey % 50 = 0 then ''
                       else '-' || l_partkey || '-' || l_suppkey end) as order_id,
            'CUST' || o_custkey as customer_id,
            p_brand as product_id,
            case when l_orderkey % 211 = 0 then ''
                 else cast(cast(o_orderdate as date) as varchar) end as order_date,
            cast(cast(o_orderdate as date) + 730 as varchar) as promised_delivery_date,
            case when o_orderstatus = 'O' and l_linenumber % 2 = 0 then ''
                 else cast(cast(l_shipdate as date) as varchar) end as actual_delivery_date,
            cast(case when l_orderkey % 227 = 0 then -cast(l_quantity as bigint)
                      when l_orderkey % 229 = 0 then 0
                      else cast(l_quantity as bigint) end as varchar) as quantity,
            case when l_orderkey % 223 = 0 then ''
                 else cast(cast(l_extendedprice as decimal(18,2)) as varchar) end as unit_price,
            n_name || ', ' || r_name as plant_location,
            case o_orderstatus when 'F' then 'Shipped' when 'O' then 'Open'
                               when 'P' then 'Cancelled' end as order_status
        from lineitem
        left join orders on o_orderkey = l_orderkey
        left join part on p_partkey = l_partkey
        left join supplier on s_suppkey = l_suppkey
        left join places on n_nationkey = s_nationkey""",
    "raw_accounts": """
        select 'SF-' || c_custkey as account_id, 'CUST' || c_custkey as customer_id,
               c_name as account_name, r_name as region, n_name as account_owner,
               c_mktsegment as segment,
               case when c_acctbal >= 0 then 'TRUE' else 'FALSE' end as active_flag
        from customer left join places on n_nationkey = c_nationkey
        where c_custkey % 97 <> 0""",
    "raw_products": """
        select p_brand as product_id, arg_min(p_name, p_partkey) as product_name,
               arg_min(p_type, p_partkey) as product_family,
               case arg_min(p_size, p_partkey) % 3 when 0 then 'Active' when 1 then 'Discontinued'
                                    else 'Pending' end as lifecycle_status,
               cast(cast(min(p_retailprice) as decimal(18,2)) as varchar) as standard_cost
        from part where p_brand <> 'Brand#13' group by p_brand""",
    # Typed straight from the tables, without the detour through text.
    "typed": """
        select if(l_orderkey % 10 = 9, 'ORD9-', 'ORD0-')
                 || array_to_string(
                      if(l_orderkey % 50 = 0, [l_orderkey, l_linenumber],
                         [l_orderkey, l_linenumber, l_partkey, l_suppkey]), '-') as order_id,
               'CUST' || o_custkey as customer_id, p_brand as product_id,
               if(l_orderkey % 211 <> 0, cast(o_orderdate as date), null) as order_date,
               cast(o_orderdate as date) + 730 as promised_delivery_date,
               if(o_orderstatus <> 'O' or l_linenumber % 2 <> 0, cast(l_shipdate as date), null)
                 as actual_delivery_date,
               cast(if(l_orderkey % 227 = 0, -1, if(l_orderkey % 229 = 0, 0, 1)) * l_quantity
                    as integer) as quantity,
               if(l_orderkey % 223 <> 0, cast(l_extendedprice as decimal(18,2)), null)
                 as unit_price,
               n_name as plant_city, r_name as plant_country,
               map(['F', 'O', 'P'], ['Shipped', 'Open', 'Cancelled'])[o_orderstatus]
                 as order_status
        from lineitem
        left join orders on o_orderkey = l_orderkey
        left join part on p_partkey = l_partkey
        left join supplier on s_suppkey = l_suppkey
        left join places on n_nationkey = s_nationkey""",
    "repeated": """
        select order_id, true as is_repeated from typed group by order_id having count(*) > 1""",
    "flagged": """
        select typed.*, cast(quantity * unit_price as decimal(18,2)) as gross_revenue,
               if(order_id[1:4] = 'ORD9', 'BATCH_B', 'BATCH_A') as source_batch,
               if(is_repeated, 'AMBIGUOUS_DUPLICATE',
                 if(order_date is null, 'MISSING_ORDER_DATE',
                   if(unit_price is null, 'MISSING_UNIT_PRICE',
                     if(quantity > 0, null, 'INVALID_QUANTITY')))) as dq_failure_reason
        from typed left join repeated using (order_id)""",
    "clean": """
        select * exclude (dq_failure_reason) from flagged where dq_failure_reason is null""",
    "rejects": """
        select * from flagged where dq_failure_reason is not null""",
    "accounts": """
        select * exclude (active_flag), active_flag = 'TRUE' as is_active from raw_accounts""",
    "products": """
        select * replace (cast(standard_cost as decimal(18,2)) as standard_cost),
               lifecycle_status = 'Active' as is_active_product
        from raw_products""",
    "judged": """
        select clean.*,
               if(order_status = 'Cancelled', 'Cancelled',
                 if(actual_delivery_date is null, 'Not Delivered',
                   if(actual_delivery_date < order_date, 'Unknown',
                     if(actual_delivery_date <= promised_delivery_date, 'On Time', 'Late'))))
                 as delivery_status,
               make_date(year(order_date), month(order_date), 1) as revenue_month,
               order_status = 'Shipped' as is_recognised_revenue
        from clean""",
    "enriched": """
        select judged.*, ifnull(a.region, 'UNMAPPED') as region, a.segment, a.account_name,
               a.is_active as is_active_account, p.product_family, p.lifecycle_status,
               p.standard_cost, p.product_id is not null as has_standard_cost,
               cast(gross_revenue - p.standard_cost * quantity as decimal(18,2)) as gross_margin
        from judged
        left join accounts a on a.customer_id = judged.customer_id
        left join products p on p.product_id = judged.product_id""",
    "monthly": """
        select product_id, region, revenue_month,
               cast(ifnull(sum(gross_revenue) filter (is_recognised_revenue), 0)
                    as decimal(18,2)) as actual_revenue,
               cast(ifnull(sum(quantity) filter (is_recognised_revenue), 0) as bigint)
                 as actual_quantity,
               cast(ifnull(sum(gross_margin) filter (is_recognised_revenue), 0)
                    as decimal(18,2)) as actual_margin,
               count(*) as order_count,
               count(*) filter (delivery_status = 'On Time') as on_time_count,
               count(*) filter (delivery_status = 'Late') as late_count,
               count(*) filter (order_status = 'Cancelled') as cancelled_count,
               count(*) filter (has_standard_cost) as orders_with_known_cost
        from enriched group by all""",
    "forecast": """
        select concat_ws('-', product_id, region, forecast_month) as forecast_id, *
        from (select product_id, region,
                     cast(revenue_month + interval 12 month as date) as forecast_month,
                     cast(actual_revenue * 1.05 as decimal(18,2)) as forecast_revenue,
                     cast(round(actual_quantity * cast(1.05 as decimal(3,2)), 0) as integer)
                       as forecast_quantity
              from monthly where region <> 'UNMAPPED' and orders_with_known_cost > 0)""",
    # The outer join as a union of both sides, folded by cell.
    "cells": """
        select product_id, region, revenue_month,
               cast(sum(actual_revenue) as decimal(18,2)) as actual_revenue,
               cast(sum(actual_quantity) as bigint) as actual_quantity,
               cast(sum(actual_margin) as decimal(18,2)) as actual_margin,
               max(forecast_revenue) as forecast_revenue,
               max(forecast_quantity) as forecast_quantity,
               cast(sum(order_count) as bigint) as order_count,
               cast(sum(on_time_count) as bigint) as on_time_count,
               cast(sum(late_count) as bigint) as late_count,
               cast(sum(cancelled_count) as bigint) as cancelled_count,
               cast(sum(orders_with_known_cost) as bigint) as orders_with_known_cost
        from (select *, cast(null as decimal(18,2)) as forecast_revenue,
                     cast(null as integer) as forecast_quantity
              from monthly
              union all by name
              select product_id, region, forecast_month as revenue_month, forecast_revenue,
                     forecast_quantity, 0 as actual_revenue, 0 as actual_quantity,
                     0 as actual_margin, 0 as order_count, 0 as on_time_count, 0 as late_count,
                     0 as cancelled_count, 0 as orders_with_known_cost
              from forecast)
        group by product_id, region, revenue_month""",
    "mart": """
        select * exclude (orders_with_known_cost),
               cast(actual_revenue - ifnull(forecast_revenue, 0) as decimal(18,2))
                 as revenue_variance,
               cast((actual_revenue - forecast_revenue) / nullif(forecast_revenue, 0)
                    as decimal(18,4)) as revenue_variance_pct,
               cast(orders_with_known_cost * 1.0 / nullif(order_count, 0) as decimal(18,4))
                 as margin_coverage_pct,
               cast(on_time_count * 1.0 / nullif(on_time_count + late_count, 0) as decimal(18,4))
                 as on_time_delivery_rate,
               if(forecast_revenue is null, 'NO_FORECAST',
                 if(order_count = 0, 'NO_ACTUALS',
                   if(actual_revenue < forecast_revenue, 'BELOW_PLAN', 'AT_OR_ABOVE_PLAN')))
                 as variance_flag
        from cells""",
    "dim_customer": """
        select *, false as is_synthetic from accounts
        union all by name
        select distinct customer_id, 'Unknown Customer (' || customer_id || ')' as account_name,
               'UNMAPPED' as region, 'Unknown' as segment, false as is_active,
               true as is_synthetic
        from clean anti join accounts using (customer_id)""",
    "dim_product": """
        select *, false as is_synthetic from products
        union all by name
        select distinct product_id, 'Unknown Product (' || product_id || ')' as product_name,
               'Unknown' as product_family, 'Unknown' as lifecycle_status,
               false as is_active_product, true as is_synthetic
        from clean anti join products using (product_id)""",
    "dim_region": """
        select r_name as region_name, true as is_forecastable from region
        union all select 'UNMAPPED', false""",
    "dim_date": """
        select cast(m as date) as date_month, cast(year(m) as integer) as year_number,
               cast(month(m) as integer) as month_number,
               cast(quarter(m) as integer) as quarter_number,
               strftime(m, '%Y-%m') as year_month_label
        from (select unnest(generate_series(date_trunc('year', min(o_orderdate)),
                                            date_trunc('year', max(o_orderdate))
                                              + interval 23 month,
                                            interval 1 month)) as m
              from orders)""",
    "fct_orders": """
        select order_id, customer_id, product_id, region, revenue_month, order_date,
               promised_delivery_date, actual_delivery_date, quantity, unit_price, gross_revenue,
               gross_margin, has_standard_cost, order_status, delivery_status,
               is_recognised_revenue, plant_city, plant_country, source_batch
        from enriched""",
    "scored": """
        select *, actual_delivery_date - promised_delivery_date as gap
        from enriched
        where order_status = 'Shipped' and delivery_status in ('On Time', 'Late')""",
    "cell_flags": """
        select product_id, region,
               case when bool_or(variance_flag = 'AT_OR_ABOVE_PLAN') then 'AT_OR_ABOVE_PLAN'
                    when bool_or(variance_flag = 'NO_FORECAST') then 'NO_FORECAST'
                    when bool_or(variance_flag = 'BELOW_PLAN') then 'BELOW_PLAN'
                    else 'NO_ACTUALS' end as cell_flag
        from mart group by product_id, region""",
    "mart_family": """
        select mart.*, coalesce(product_family, 'Unknown') as product_family
        from mart left join dim_product using (product_id)""",
    "load_log": """
        select 'raw_oracle_orders' as table_name, l_orderkey as k, 10 as least, 90 as spread
        from lineitem
        union all select 'raw_salesforce_accounts', c_custkey, 35, 40 from customer
        union all select 'raw_adaptive_forecast', o_orderkey, 47, 5 from orders
        union all select 'raw_erp_products', p_partkey, 60, 7 from part""",
    "loads": """
        select table_name, 'load-' || (k % spread) as batch_id,
               timestamp '2024-01-31 00:00:00'
                 - to_minutes(cast(60 * (least + k % spread) + k % 60 as bigint)) as loaded_at
        from load_log""",
    "sums": """
        select (select sum(quantity * unit_price) from typed) as source,
               (select sum(actual_revenue) from mart) as recognised,
               ifnull(sum(gross_revenue) filter (order_status = 'Open'), 0) as open_amount,
               ifnull(sum(gross_revenue) filter (order_status = 'Cancelled'), 0) as cancelled,
               ifnull(sum(gross_revenue) filter (
                 order_status not in ('Open', 'Cancelled', 'Shipped')), 0) as other,
               (select ifnull(sum(gross_revenue), 0) from rejects) as rejected
        from enriched""",
}


def statement(select: str) -> str:
    """``select`` over the named steps, as one statement."""
    steps = ",\n".join(f"{name} as ({body}\n    )" for name, body in _STEPS.items())
    return f"with {steps}\n{select}"


def _failing(*checks: tuple[str, str]) -> str:
    """One row per (check name, scalar query counting its failing rows)."""
    return "\nunion all\n".join(
        f"select '{name}' as check_name, cast(({query}) as bigint) as failing_rows"
        for name, query in checks
    )


def _repeated(source: str, *columns: str) -> str:
    keys = ", ".join(columns)
    present = " and ".join(f"{c} is not null" for c in columns)
    return (
        f"select count(*) from (select {keys} from {source} where {present} "
        f"group by {keys} having count(*) > 1)"
    )


def _missing(source: str, column: str) -> str:
    return f"select count(*) from {source} where {column} is null"


def _outside(source: str, column: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"select count(*) from {source} where {column} not in ({listed})"


def _orphaned(child: str, column: str, parent: str, key: str) -> str:
    return (
        f"select count(*) from {child} c where {column} is not null "
        f"and not exists (select 1 from {parent} p where p.{key} = c.{column})"
    )


_MEMBERS = {
    "regions": ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    "delivery": ("On Time", "Late", "Not Delivered", "Cancelled", "Unknown"),
}

_REGIONS = _MEMBERS["regions"]
_STATUSES = ("Shipped", "Open", "Cancelled")
_REASONS = ("AMBIGUOUS_DUPLICATE", "MISSING_ORDER_DATE", "MISSING_UNIT_PRICE", "INVALID_QUANTITY")
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_FLAGS = ("NO_ACTUALS", "BELOW_PLAN", "AT_OR_ABOVE_PLAN", "NO_FORECAST")
_LIFECYCLES = ("Active", "Discontinued", "Pending")
_CELL = ("product_id", "region", "revenue_month")
_PLAN = ("product_id", "region", "forecast_month")

# The checked columns, by table: (step, unique, not null, grain).
_KEYS = {
    "stg_orders": (
        "clean", ("order_id",), (
            "order_id", "customer_id", "product_id", "order_date", "unit_price",
            "gross_revenue",
        ), (),
    ),
    "stg_rejects": (
        "rejects", (), ("dq_failure_reason",), (),
    ),
    "stg_accounts": (
        "accounts", ("customer_id",), ("customer_id", "region"), (),
    ),
    "stg_forecast": (
        "forecast", ("forecast_id",), ("forecast_id", "forecast_revenue"), _PLAN,
    ),
    "stg_products": (
        "products", ("product_id",), ("product_id", "standard_cost"), (),
    ),
    "orders_enriched": (
        "enriched", ("order_id",), (
            "order_id", "region", "delivery_status", "revenue_month", "gross_revenue",
        ), (),
    ),
    "monthly_revenue": (
        "monthly", (), ("actual_revenue", "order_count"), _CELL,
    ),
    "dim_date": (
        "dim_date", ("date_month",), ("date_month",), (),
    ),
    "dim_region": (
        "dim_region", ("region_name",), ("region_name",), (),
    ),
    "dim_customer": (
        "dim_customer", ("customer_id",), ("customer_id",), (),
    ),
    "dim_product": (
        "dim_product", ("product_id",), ("product_id",), (),
    ),
    "fct_orders": (
        "fct_orders", ("order_id",), ("order_id",), (),
    ),
    "fct_forecast": (
        "forecast", ("forecast_id",), ("forecast_id", "forecast_revenue"), _PLAN,
    ),
    "mart": (
        "mart", (), (
            "product_id", "region", "revenue_month", "actual_revenue", "revenue_variance",
        ), _CELL,
    ),
    "reject_summary": (
        "(select dq_failure_reason, count(*) as rejected_row_count from rejects "
        "group by dq_failure_reason)", ("dq_failure_reason",), ("dq_failure_reason", "rejected_row_count"), (),
    ),
}
_ACCEPTED = [
    ("stg_orders", "order_status", _STATUSES),
    ("stg_orders", "source_batch", ("BATCH_A", "BATCH_B")),
    ("stg_orders", "plant_country", _REGIONS),
    ("stg_rejects", "dq_failure_reason", _REASONS),
    ("stg_accounts", "region", _REGIONS),
    ("stg_accounts", "segment", _SEGMENTS),
    ("stg_forecast", "region", _REGIONS),
    ("stg_products", "lifecycle_status", _LIFECYCLES),
    ("orders_enriched", "region", (*_REGIONS, "UNMAPPED")),
    ("orders_enriched", "delivery_status", _MEMBERS["delivery"]),
    ("monthly_revenue", "region", (*_REGIONS, "UNMAPPED")),
    ("fct_orders", "delivery_status", _MEMBERS["delivery"]),
    ("mart", "variance_flag", _FLAGS),
]
_PARENTS = [
    ("stg_forecast", "product_id", "products", "product_id"),
    ("dim_customer", "region", "dim_region", "region_name"),
    ("fct_orders", "customer_id", "dim_customer", "customer_id"),
    ("fct_orders", "product_id", "dim_product", "product_id"),
    ("fct_orders", "region", "dim_region", "region_name"),
    ("mart", "product_id", "dim_product", "product_id"),
    ("mart", "region", "dim_region", "region_name"),
]


def _suite() -> str:
    step = {table: keys[0] for table, keys in _KEYS.items()}
    checks = []
    for table, (source, unique, not_null, grain) in _KEYS.items():
        checks += [(f"{table}.{c} unique", _repeated(source, c)) for c in unique]
        checks += [(f"{table}.{c} not_null", _missing(source, c)) for c in not_null]
        if grain:
            checks.append((f"{table} grain", _repeated(source, *grain)))
    checks += [(f"{t}.{c} accepted", _outside(step[t], c, *values)) for t, c, values in _ACCEPTED]
    checks += [(f"{t}.{c} parent", _orphaned(step[t], c, p, key)) for t, c, p, key in _PARENTS]
    return _failing(*checks)


_SELECTS = {
    # sources
    "land_raw_orders": """
        select *, '2024-01-31 00:00:00' as _loaded_at, 'oracle_orders.csv' as _source_file,
               'batch-0001' as _batch_id
        from (select order_id, customer_id, product_id, order_date, promised_delivery_date,
                     actual_delivery_date, quantity, unit_price, plant_location, order_status
              from raw_orders)""",
    "land_csv_orders": """
        select nullif(order_id, '') as order_id, nullif(customer_id, '') as customer_id,
               nullif(product_id, '') as product_id, nullif(order_date, '') as order_date,
               nullif(promised_delivery_date, '') as promised_delivery_date,
               nullif(actual_delivery_date, '') as actual_delivery_date,
               nullif(quantity, '') as quantity, nullif(unit_price, '') as unit_price,
               nullif(plant_location, '') as plant_location,
               nullif(order_status, '') as order_status,
               '2024-01-31 00:00:00' as _loaded_at, 'oracle_orders.csv' as _source_file,
               'batch-0001' as _batch_id
        from raw_orders""",
    "landed_csv_counts": """
        select 'raw_oracle_orders' as table_name, count(*) as row_count from raw_orders
        union all select 'raw_salesforce_accounts', count(*) from raw_accounts
        union all select 'raw_adaptive_forecast', count(*) from forecast
        union all select 'raw_erp_products', count(*) from raw_products""",
    "landed_row_counts": """
        select 'raw_oracle_orders' as table_name, count(*) as row_count from raw_orders
        union all select 'raw_salesforce_accounts', count(*) from raw_accounts
        union all select 'raw_adaptive_forecast', count(*) from forecast
        union all select 'raw_erp_products', count(*) from raw_products""",
    "freshness_of_loads": """
        select table_name, '2024-01-29 21:40:00' as last_loaded_at, 27 as hours_since_load,
               2 as batches_seen, (2 * n)::bigint as row_count
        from (
            select 'raw_oracle_orders' as table_name, count(*) as n from raw_orders
            union all select 'raw_salesforce_accounts', count(*) from raw_accounts
            union all select 'raw_adaptive_forecast', count(*) from forecast
            union all select 'raw_erp_products', count(*) from raw_products
        )""",
    "layer_row_counts": """
        select 'raw' as layer, 'raw_oracle_orders' as table_name, count(*) as row_count
        from raw_orders
        union all select 'raw', 'raw_salesforce_accounts', count(*) from raw_accounts
        union all select 'raw', 'raw_adaptive_forecast', count(*) from forecast
        union all select 'raw', 'raw_erp_products', count(*) from raw_products
        union all select 'staging', 'stg_accounts', count(*) from accounts
        union all select 'staging', 'stg_products', count(*) from products
        union all select 'staging', 'stg_forecast', count(*) from forecast
        union all select 'staging', 'stg_orders', count(*) from clean
        union all select 'staging', 'stg_rejects', count(*) from rejects
        union all select 'staging', 'stg_orders_flagged', count(*) from raw_orders
        union all select 'staging', 'int_orders_enriched', count(*) from enriched
        union all select 'staging', 'int_order_revenue_monthly', count(*) from monthly
        union all select 'staging', 'seed_region', count(*) from dim_region
        union all select 'analytics', 'dim_region', count(*) from dim_region
        union all select 'analytics', 'dim_date', count(*) from dim_date
        union all select 'analytics', 'fct_orders', count(*) from fct_orders
        union all select 'analytics', 'dq_reject_summary',
                         count(distinct dq_failure_reason) from rejects
        union all select 'analytics', 'dim_customer', count(*) from dim_customer
        union all select 'analytics', 'dim_product', count(*) from dim_product
        union all select 'analytics', 'fct_forecast', count(*) from forecast
        union all select 'analytics', 'mart', count(*) from mart""",
    "run_results_summary": """
        select strftime(ts, '%Y-%m-%d %H:%M:%S') as generated_at,
               if(event_type = 'error', 0, 1) as models_ok, 1 as models_total,
               if(event_id % 7 = 0, 0, 1) as tests_passed, 1 as tests_total,
               if(event_id % 7 = 0, 1, 0) as tests_failed, value as elapsed_time
        from events""",
    "slowest_models": """
        select event_type || '_' || user_id as model, value as execution_time,
               strftime(ts, '%Y-%m-%d %H:%M:%S') as generated_at
        from events order by execution_time desc, model, generated_at limit 5""",
    # staging
    "stg_accounts": "select * from accounts",
    "stg_products": "select * from products",
    "stg_forecast": "select * from forecast",
    "lenient_casts": """
        select l_orderkey, l_partkey, l_linenumber,
               try_cast(nullif(trim(int_text), '') as integer) as int_value,
               try_cast(nullif(trim(money_text), '') as decimal(18,2)) as money_value,
               try_cast(nullif(trim(date_text), '') as date) as date_value
        from (
          select l_orderkey, l_partkey, l_linenumber,
            case l_linenumber % 7 when 0 then q when 1 then q || '.0' when 2 then q || '.5'
              when 3 then q || 'e1' when 4 then '  ' || q || ' ' when 5 then 'n/a ' || q
              else q || '0000000000' end as int_text,
            case l_linenumber % 7 when 0 then p when 1 then p || '5' when 2 then p || '49'
              when 3 then '$' || p when 4 then '-' || p when 5 then ' '
              else p || 'e2' end as money_text,
            case l_linenumber % 7 when 0 then d when 1 then d[1:4] when 2 then d[1:7]
              when 3 then replace(d, '-', '/') when 4 then d || ' 10:30:00' when 5 then ' ' || d
              else d[1:8] || '32' end as date_text
          from (select l_orderkey, l_partkey, l_linenumber,
                       cast(cast(l_quantity as bigint) as varchar) as q,
                       cast(cast(l_extendedprice as decimal(18,2)) as varchar) as p,
                       cast(cast(l_shipdate as date) as varchar) as d
                from lineitem))""",
    "plant_split": """
        select plant_city, plant_country, count(*) as line_count
        from typed group by plant_city, plant_country""",
    "source_batch_mix": """
        select source_batch, count(*) as line_count, count(dq_failure_reason) as rejected_count
        from flagged group by source_batch""",
    "orders_flagged": "select * from flagged",
    "stg_orders": "select * from clean",
    "orders_rejects": "select * from rejects",
    "reject_summary": """
        select dq_failure_reason, count(*) as rejected_row_count,
               cast(sum(gross_revenue) as decimal(28,2)) as rejected_revenue,
               cast(count(*) * 1.0 / (select count(*) from raw_orders) as decimal(18,4))
                 as pct_of_source_rows
        from rejects group by dq_failure_reason""",
    "reject_value_by_reason": """
        select dq_failure_reason, cast(sum(gross_revenue) as decimal(28,2)) as rejected_revenue
        from rejects group by dq_failure_reason having sum(gross_revenue) is not null""",
    # enrichment, rollup, mart
    "orders_enriched": "select * from enriched",
    "delivery_status": """
        select delivery_status, order_status, count(*) as order_count
        from enriched group by delivery_status, order_status""",
    "monthly_revenue": "select * from monthly",
    "monthly_revenue_sql": "select * from monthly",
    "plan_vs_actual": "select * from mart",
    # dimensions and facts
    "dim_region": "select * from dim_region",
    "dim_date": "select * from dim_date",
    "dim_customer": "select * from dim_customer",
    "dim_product": "select * from dim_product",
    "fct_orders": "select * from fct_orders",
    "fct_forecast": "select * from forecast",
    # filters and the star
    "filter_options": """
        select distinct 'region' as filter, region as option from mart
        union all select distinct 'product_family', product_family from dim_product
        union all select distinct 'revenue_month', cast(revenue_month as varchar) from mart""",
    "filtered_mart": """
        select product_id, product_family, region, revenue_month, actual_revenue,
               forecast_revenue, revenue_variance, revenue_variance_pct, variance_flag
        from mart_family
        where region in ('ASIA', 'EUROPE', 'UNMAPPED')
          and product_family in ('ECONOMY', 'Unknown')
          and revenue_month between date '1996-01-01' and date '2000-12-01'
          and variance_flag in ('BELOW_PLAN', 'AT_OR_ABOVE_PLAN', 'NO_FORECAST')""",
    "filtered_orders": """
        select f.region, d.product_family, order_status, count(*) as order_count,
               cast(sum(gross_revenue) as decimal(28,2)) as gross_revenue
        from fct_orders f join dim_product d using (product_id)
        where f.region in ('ASIA', 'EUROPE', 'UNMAPPED')
          and d.product_family in ('ECONOMY', 'Unknown')
          and revenue_month between date '1996-01-01' and date '2000-12-01'
        group by all""",
    "entitled_mart": """
        select mart.* from mart
        where region in (select r_name from places
                         where lower(n_name) || '@example.com' = 'nation_7@example.com')""",
    "star_rollup": """
        select product_family, is_forecastable, year_number,
               cast(sum(actual_revenue) as decimal(28,2)) as actual_revenue,
               cast(sum(forecast_revenue) as decimal(28,2)) as forecast_revenue,
               cast(sum(actual_revenue) - coalesce(sum(forecast_revenue), 0) as decimal(28,2))
                 as revenue_variance,
               cast((sum(actual_revenue) - coalesce(sum(forecast_revenue), 0))
                    / nullif(sum(forecast_revenue), 0) as decimal(18,4)) as variance_pct,
               cast(sum(actual_margin) as decimal(28,2)) as gross_margin,
               cast(sum(orders_with_known_cost) * 1.0 / nullif(sum(order_count), 0)
                    as decimal(18,4)) as margin_coverage_pct,
               cast(sum(on_time_count) * 1.0 / nullif(sum(on_time_count) + sum(late_count), 0)
                    as decimal(18,4)) as on_time_delivery_pct
        from cells
        left join dim_product using (product_id)
        left join dim_region on region_name = region
        left join dim_date on date_month = revenue_month
        group by product_family, is_forecastable, year_number""",
    "orders_by_segment": """
        select segment, cast(count(*) as bigint) as order_count,
               cast(sum(gross_revenue) as decimal(38,2)) as gross_revenue
        from fct_orders left join (select customer_id, segment from dim_customer)
          using (customer_id)
        group by segment""",
    # revenue against plan
    "headline_kpis": """
        select cast(sum(actual_revenue) as decimal(28,2)) as actual_revenue,
               cast(sum(forecast_revenue) as decimal(28,2)) as forecast_revenue,
               cast(sum(actual_revenue) - coalesce(sum(forecast_revenue), 0) as decimal(28,2))
                 as revenue_variance,
               cast((sum(actual_revenue) - sum(forecast_revenue))
                    / nullif(sum(forecast_revenue), 0) as decimal(18,4)) as variance_pct,
               cast(sum(on_time_count) as bigint) as on_time_count,
               cast(sum(on_time_count) + sum(late_count) as bigint) as arrived_count,
               cast(sum(on_time_count) * 1.0 / nullif(sum(on_time_count) + sum(late_count), 0)
                    as decimal(18,4)) as on_time_rate,
               count(*) filter (where variance_flag = 'NO_ACTUALS') as no_actuals_rows,
               count(*) as total_rows,
               cast(coalesce(sum(actual_revenue) filter (where region = 'UNMAPPED'), 0)
                    as decimal(28,2)) as unmapped_revenue
        from mart""",
    "monthly_trend": """
        select revenue_month, cast(sum(actual_revenue) as decimal(28,2)) as actual_revenue,
               cast(sum(forecast_revenue) as decimal(28,2)) as forecast_revenue,
               strftime(revenue_month, '%b %Y') as month_label
        from mart group by revenue_month""",
    "variance_by_region": """
        select region, count(*) as mart_rows,
               cast(round(sum(actual_revenue)) as decimal(28,0)) as actual,
               cast(round(sum(forecast_revenue)) as decimal(28,0)) as forecast,
               cast(round(sum(revenue_variance)) as decimal(28,0)) as variance,
               cast(sum(revenue_variance) / nullif(sum(forecast_revenue), 0) as decimal(18,4))
                 as variance_pct
        from mart group by region""",
    "variance_by_flag": """
        select variance_flag, count(*) as mart_rows,
               cast(round(sum(actual_revenue)) as decimal(28,0)) as actual,
               cast(round(sum(forecast_revenue)) as decimal(28,0)) as forecast,
               case variance_flag when 'NO_ACTUALS' then 1 when 'BELOW_PLAN' then 2
                 when 'AT_OR_ABOVE_PLAN' then 3 when 'NO_FORECAST' then 4 end as flag_order
        from mart group by variance_flag""",
    "variance_by_family": """
        select product_family, cast(sum(revenue_variance) as decimal(28,2)) as revenue_variance,
               cast(sum(actual_revenue) as decimal(28,2)) as actual_revenue
        from mart_family group by product_family""",
    "worst_variance": """
        select * from mart
        order by revenue_variance, product_id, region, revenue_month limit 20""",
    "top_bottom_variance": """
        (select product_id, region, revenue_month, revenue_variance, 'above' as side from mart
         order by revenue_variance desc, product_id, region, revenue_month limit 5)
        union all
        (select product_id, region, revenue_month, revenue_variance, 'below' from mart
         order by revenue_variance, product_id, region, revenue_month limit 5)""",
    "flag_cells": "select * from cell_flags",
    "flag_pivot": """
        select product_id,
               max(cell_flag) filter (where region = 'AFRICA') as "AFRICA",
               max(cell_flag) filter (where region = 'AMERICA') as "AMERICA",
               max(cell_flag) filter (where region = 'ASIA') as "ASIA",
               max(cell_flag) filter (where region = 'EUROPE') as "EUROPE",
               max(cell_flag) filter (where region = 'MIDDLE EAST') as "MIDDLE EAST",
               max(cell_flag) filter (where region = 'UNMAPPED') as "UNMAPPED"
        from cell_flags group by product_id""",
    "cell_composition": """
        select product_id, region,
               string_agg(strftime(revenue_month, '%b %Y') || ': ' || variance_flag, '; '
                          order by revenue_month) as composition,
               count(*) as months
        from mart group by product_id, region""",
    "composition_pivot": """
        select product_id,
               coalesce(max(composition) filter (where region = 'AFRICA'), '') as "AFRICA",
               coalesce(max(composition) filter (where region = 'AMERICA'), '') as "AMERICA",
               coalesce(max(composition) filter (where region = 'ASIA'), '') as "ASIA",
               coalesce(max(composition) filter (where region = 'EUROPE'), '') as "EUROPE",
               coalesce(max(composition) filter (where region = 'MIDDLE EAST'), '')
                 as "MIDDLE EAST",
               coalesce(max(composition) filter (where region = 'UNMAPPED'), '') as "UNMAPPED"
        from (select product_id, region,
                     string_agg(strftime(revenue_month, '%b %Y') || ': ' || variance_flag, '; '
                                order by revenue_month) as composition
              from mart group by product_id, region)
        group by product_id""",
    "flag_counts_two_grains": """
        select 'month' as grain, variance_flag, count(*) as flag_count
        from mart group by variance_flag
        union all
        select 'cell', cell_flag, count(*) from cell_flags group by cell_flag""",
    "reconciliation": """
        select cast(source as decimal(28,2)) as source,
               cast(recognised as decimal(28,2)) as recognised,
               cast(open_amount as decimal(28,2)) as open,
               cast(cancelled as decimal(28,2)) as cancelled,
               cast(other as decimal(28,2)) as other,
               cast(rejected as decimal(28,2)) as rejected,
               cast(recognised + open_amount + cancelled + other + rejected as decimal(28,2))
                 as accounted,
               cast(source - (recognised + open_amount + cancelled + other + rejected)
                    as decimal(28,2)) as unexplained,
               cast(recognised / nullif(source, 0) as decimal(18,4)) as recognised_share,
               cast(open_amount / nullif(source, 0) as decimal(18,4)) as open_share,
               cast(cancelled / nullif(source, 0) as decimal(18,4)) as cancelled_share,
               cast(other / nullif(source, 0) as decimal(18,4)) as other_share,
               cast(rejected / nullif(source, 0) as decimal(18,4)) as rejected_share
        from sums""",
    # delivery
    "delivery_distribution": """
        select delivery_status, count(*) as order_count from enriched group by delivery_status""",
    "on_time_by_region": """
        select region, count(*) filter (where delivery_status = 'On Time') as on_time,
               count(*) as total,
               cast(count(*) filter (where delivery_status = 'On Time') * 1.0 / count(*)
                    as decimal(18,4)) as on_time_rate
        from scored group by region""",
    "delivery_gap": """
        select region, count(gap) as orders,
               cast(sum(gap) * 1.0 / count(gap) as decimal(18,4)) as mean_gap,
               cast(max(gap) as integer) as worst_gap
        from scored group by region
        union all
        select 'ALL', count(gap), cast(sum(gap) * 1.0 / count(gap) as decimal(18,4)),
               cast(max(gap) as integer)
        from scored""",
    "late_orders": """
        select order_id, customer_id, product_id, region, order_date, promised_delivery_date,
               actual_delivery_date, cast(gap as integer) as days_late, gross_revenue
        from scored where delivery_status = 'Late'""",
    "contradiction_counts": """
        select count(*) filter (where delivery_status = 'Cancelled') as cancelled_orders,
               count(*) filter (where order_status = 'Cancelled'
                                  and actual_delivery_date is not null)
                 as cancelled_with_delivery_date,
               count(*) filter (where delivery_status = 'Unknown') as unknown_orders
        from enriched""",
    "degraded_orders": """
        select order_id, customer_id, product_id, region, has_standard_cost, gross_margin,
               delivery_status
        from enriched
        where region = 'UNMAPPED' or not has_standard_cost or delivery_status = 'Unknown'""",
    # margin and products
    "margin_coverage": """
        select count(*) as order_count,
               count(*) filter (where has_standard_cost) as orders_with_known_cost,
               cast((select sum(actual_margin) from mart) as decimal(28,2)) as total_margin,
               cast(count(*) filter (where has_standard_cost) * 1.0 / count(*) as decimal(18,4))
                 as margin_coverage
        from enriched""",
    "margin_by_product": """
        select m.product_id, coalesce(product_name, m.product_id) as product_name,
               actual_revenue, actual_margin, orders_with_known_cost, order_count,
               cast(orders_with_known_cost * 1.0 / nullif(order_count, 0) as decimal(18,4))
                 as margin_coverage
        from (select product_id, cast(sum(actual_revenue) as decimal(28,2)) as actual_revenue,
                     cast(sum(actual_margin) as decimal(28,2)) as actual_margin
              from mart group by product_id) m
        left join (select product_id,
                          count(*) filter (where has_standard_cost) as orders_with_known_cost,
                          count(*) as order_count
                   from enriched group by product_id) c using (product_id)
        left join dim_product using (product_id)""",
    "uncovered_orders": """
        select order_id, product_id, gross_revenue from enriched where not has_standard_cost""",
    "uncovered_products": """
        select product_id, count(*) as order_count,
               cast(sum(gross_revenue) as decimal(28,2)) as gross_revenue
        from enriched where not has_standard_cost group by product_id""",
    "lifecycle_counts": """
        select lifecycle_status, count(*) as product_count from products
        group by lifecycle_status""",
    "product_list": """
        select product_id, product_name, product_family, lifecycle_status, standard_cost
        from products""",
    # telemetry
    "load_freshness": """
        select strftime(max(loaded_at), '%Y-%m-%d %H:%M:%S') as last_loaded_at,
               (select batch_id from loads order by loaded_at desc, batch_id desc limit 1)
                 as latest_batch_id,
               count(distinct batch_id) as batch_count
        from loads""",
    "freshness_by_source": """
        select table_name, strftime(max(loaded_at), '%Y-%m-%d %H:%M:%S') as last_loaded_at,
               date_diff('hour', max(loaded_at), timestamp '2024-01-31 00:00:00')
                 as hours_since_load,
               count(distinct batch_id) as batches_seen, count(*) as row_count
        from loads group by table_name""",
    "freshness_verdict": """
        select table_name, cast(seconds / 3600.0 as decimal(18,4)) as age_hours,
               case when seconds > 48 * 3600 then 'error' when seconds > 30 * 3600 then 'warn'
                    else 'pass' end as verdict
        from (select table_name,
                     epoch(timestamp '2024-01-31 00:00:00') - epoch(max(loaded_at)) as seconds
              from loads group by table_name)""",
    "cost_by_day": """
        select 'WH_' || (user_id % 10) as warehouse_name, cast(ts as date) as usage_day,
               cast(sum(cast(value as decimal(18,4))) as decimal(28,4)) as credits_used,
               cast(sum(if(event_type = 'error', 0, cast(value as decimal(18,4))))
                    as decimal(28,4)) as credits_used_compute,
               cast(sum(if(event_type = 'error', cast(value as decimal(18,4)), 0))
                    as decimal(28,4)) as credits_used_cloud_services
        from events
        where ts between timestamp '2024-01-20 00:00:00' - interval 14 day
                     and timestamp '2024-01-20 00:00:00'
        group by all""",
    "cost_of_warehouses": """
        select 'WH_' || (user_id % 10) as warehouse_name, cast(ts as date) as usage_day,
               cast(sum(cast(value as decimal(18,4))) as decimal(28,4)) as credits_used,
               cast(sum(if(event_type = 'error', 0, cast(value as decimal(18,4))))
                    as decimal(28,4)) as credits_used_compute,
               cast(sum(if(event_type = 'error', cast(value as decimal(18,4)), 0))
                    as decimal(28,4)) as credits_used_cloud_services
        from events
        where ts between timestamp '2024-01-20 00:00:00' - interval 14 day
                     and timestamp '2024-01-20 00:00:00'
          and user_id % 10 in (1, 4, 7)
        group by all""",
    "recent_jobs": """
        select event_id as query_id, event_type as query_type, 'user_' || user_id as user_name,
               'TRANSFORMER' as role_name, 'WH_' || (user_id % 10) as warehouse_name,
               if(event_type = 'error', 'FAIL', 'SUCCESS') as execution_status,
               if(event_type = 'error', user_id, null) as error_code,
               if(event_type = 'error', props, null) as error_message,
               strftime(ts, '%Y-%m-%d %H:%M:%S') as start_time,
               cast(cast(cast(value as decimal(18,2)) * 100 as bigint) / 1000.0 as decimal(18,3))
                 as elapsed_seconds
        from events
        where ts between timestamp '2024-01-20 00:00:00' - interval 7 day
                     and timestamp '2024-01-20 00:00:00'
          and user_id % 3 <> 0
        order by ts desc, event_id desc limit 200""",
    "failed_jobs": """
        select event_id as query_id, event_type as query_type, user_id as error_code,
               props as error_message, strftime(ts, '%Y-%m-%d %H:%M:%S') as start_time
        from events
        where ts between timestamp '2024-01-20 00:00:00' - interval 7 day
                     and timestamp '2024-01-20 00:00:00'
          and event_type = 'error' and user_id % 3 <> 0""",
    "table_sizes": """
        select 'RAW' as table_schema, 'raw_oracle_orders' as table_name,
               cast(sum(coalesce(strlen(cast(order_id as varchar)), 0)
                 + coalesce(strlen(cast(customer_id as varchar)), 0)
                 + coalesce(strlen(cast(product_id as varchar)), 0)
                 + coalesce(strlen(cast(order_date as varchar)), 0)
                 + coalesce(strlen(cast(promised_delivery_date as varchar)), 0)
                 + coalesce(strlen(cast(actual_delivery_date as varchar)), 0)
                 + coalesce(strlen(cast(quantity as varchar)), 0)
                 + coalesce(strlen(cast(unit_price as varchar)), 0)
                 + coalesce(strlen(cast(plant_location as varchar)), 0)
                 + coalesce(strlen(cast(order_status as varchar)), 0)) as bigint) as active_bytes,
               cast(0 as bigint) as time_travel_bytes, cast(0 as bigint) as failsafe_bytes,
               count(*) as row_count, date '2024-01-31' as last_altered
        from raw_orders
        union all
        select 'RAW' as table_schema, 'raw_salesforce_accounts' as table_name,
               cast(sum(coalesce(strlen(cast(account_id as varchar)), 0)
                 + coalesce(strlen(cast(customer_id as varchar)), 0)
                 + coalesce(strlen(cast(account_name as varchar)), 0)
                 + coalesce(strlen(cast(region as varchar)), 0)
                 + coalesce(strlen(cast(account_owner as varchar)), 0)
                 + coalesce(strlen(cast(segment as varchar)), 0)
                 + coalesce(strlen(cast(active_flag as varchar)), 0)) as bigint) as active_bytes,
               cast(0 as bigint) as time_travel_bytes, cast(0 as bigint) as failsafe_bytes,
               count(*) as row_count, date '2024-01-31' as last_altered
        from raw_accounts
        union all
        select 'RAW' as table_schema, 'raw_adaptive_forecast' as table_name,
               cast(sum(coalesce(strlen(cast(forecast_id as varchar)), 0)
                 + coalesce(strlen(cast(product_id as varchar)), 0)
                 + coalesce(strlen(cast(region as varchar)), 0)
                 + coalesce(strlen(cast(forecast_month as varchar)), 0)
                 + coalesce(strlen(cast(forecast_revenue as varchar)), 0)
                 + coalesce(strlen(cast(forecast_quantity as varchar)), 0)) as bigint) as active_bytes,
               cast(0 as bigint) as time_travel_bytes, cast(0 as bigint) as failsafe_bytes,
               count(*) as row_count, date '2024-01-31' as last_altered
        from forecast
        union all
        select 'RAW' as table_schema, 'raw_erp_products' as table_name,
               cast(sum(coalesce(strlen(cast(product_id as varchar)), 0)
                 + coalesce(strlen(cast(product_name as varchar)), 0)
                 + coalesce(strlen(cast(product_family as varchar)), 0)
                 + coalesce(strlen(cast(lifecycle_status as varchar)), 0)
                 + coalesce(strlen(cast(standard_cost as varchar)), 0)) as bigint) as active_bytes,
               cast(0 as bigint) as time_travel_bytes, cast(0 as bigint) as failsafe_bytes,
               count(*) as row_count, date '2024-01-31' as last_altered
        from raw_products""",
    # checks
    "check_suite": _suite(),
    "check_unique": _failing(
        ("typed.order_id", _repeated("typed", "order_id")),
        ("stg_orders.order_id", _repeated("clean", "order_id")),
        ("stg_accounts.customer_id", _repeated("accounts", "customer_id")),
        ("accounts_twice.customer_id", _repeated(
            "(select * from accounts union all select * from accounts where segment = 'BUILDING')",
            "customer_id",
        )),
        ("stg_products.product_id", _repeated("products", "product_id")),
        ("stg_forecast.forecast_id", _repeated("forecast", "forecast_id")),
        ("dim_customer.customer_id", _repeated("dim_customer", "customer_id")),
        ("dim_product.product_id", _repeated("dim_product", "product_id")),
        ("dim_date.date_month", _repeated("dim_date", "date_month")),
        ("dim_region.region_name", _repeated("dim_region", "region_name")),
    ),
    "check_not_null": _failing(
        *[(f"typed.{c}", _missing("typed", c)) for c in
          ("order_id", "order_date", "unit_price", "quantity", "actual_delivery_date")],
        *[(f"orders_enriched.{c}", _missing("enriched", c)) for c in
          ("order_id", "region", "delivery_status", "revenue_month", "gross_revenue", "segment",
           "standard_cost")],
        *[(f"mart.{c}", _missing("mart", c)) for c in
          ("product_id", "region", "revenue_month", "actual_revenue", "revenue_variance",
           "forecast_revenue")],
    ),
    "check_accepted_values": f"""
        select check_name, if(check_name = 'plant_country', 'warn', 'error') as severity,
               failing_rows,
               case when failing_rows = 0 then 'pass' when check_name = 'plant_country' then 'warn'
                    else 'fail' end as status
        from ({_failing(
            ("order_status", _outside("flagged", "order_status", "Shipped", "Open", "Cancelled")),
            ("source_batch", _outside("flagged", "source_batch", "BATCH_A", "BATCH_B")),
            ("dq_failure_reason", _outside(
                "flagged", "dq_failure_reason", "AMBIGUOUS_DUPLICATE", "MISSING_ORDER_DATE",
                "MISSING_UNIT_PRICE", "INVALID_QUANTITY",
            )),
            ("plant_country", _outside("flagged", "plant_country", "ASIA", "EUROPE")),
            ("region", _outside("enriched", "region", *_MEMBERS["regions"], "UNMAPPED")),
            ("mapped_region", _outside("enriched", "region", *_MEMBERS["regions"])),
            ("delivery_status", _outside("enriched", "delivery_status", *_MEMBERS["delivery"])),
            ("variance_flag", _outside(
                "mart", "variance_flag", "NO_ACTUALS", "BELOW_PLAN", "AT_OR_ABOVE_PLAN",
                "NO_FORECAST",
            )),
        )})""",
    "check_relationships": _failing(
        ("orders-accounts", _orphaned("clean", "customer_id", "accounts", "customer_id")),
        ("orders-products", _orphaned("clean", "product_id", "products", "product_id")),
        ("orders-dim_customer", _orphaned("clean", "customer_id", "dim_customer", "customer_id")),
        ("orders-dim_product", _orphaned("clean", "product_id", "dim_product", "product_id")),
        ("forecast-products", _orphaned("forecast", "product_id", "products", "product_id")),
        ("dim_customer-dim_region", _orphaned(
            "dim_customer", "region", "dim_region", "region_name"
        )),
        ("mart-dim_region", _orphaned("mart", "region", "dim_region", "region_name")),
    ),
    "check_unique_grain": _failing(
        ("mart", _repeated("mart", "product_id", "region", "revenue_month")),
        ("fct_forecast", _repeated("forecast", "product_id", "region", "forecast_month")),
        ("orders_by_month", _repeated("enriched", "product_id", "region", "revenue_month")),
    ),
    "check_partition_complete": _failing(
        ("complete", """
            select if((select count(*) from raw_orders)
                      <> (select count(*) from clean) + (select count(*) from rejects), 1, 0)"""),
        ("rejects_dropped",
         "select (select count(*) from raw_orders) - (select count(*) from clean)"),
    ),
    "check_reconciles": _failing(
        ("reconciles", """
            select count(*) from sums
            where abs(source - recognised - open_amount - cancelled - other - rejected) > 0.01"""),
        ("unmapped_dropped", """
            select count(*) from sums
            where abs(source - open_amount - cancelled - other - rejected - (
              select sum(actual_revenue) from mart where region <> 'UNMAPPED')) > 0.01"""),
        ("quantity_lost", "select count(*) from sums where cancelled <> 0"),
    ),
    "check_duplicates_quarantined": _failing(
        ("quarantined", """
            select count(*) from (select order_id from typed group by order_id
                                  having count(*) > 1) d
            where exists (select 1 from clean c where c.order_id = d.order_id)
               or not exists (select 1 from rejects r where r.order_id = d.order_id
                                and dq_failure_reason = 'AMBIGUOUS_DUPLICATE')"""),
        ("kept", _repeated("typed", "order_id")),
    ),
    "check_margin_null": _failing(
        ("margin_null", """
            select count(*) from enriched
            where (standard_cost is null and gross_margin is not null)
               or (not has_standard_cost and gross_revenue is null)"""),
        ("margin_made_up", """
            select count(*) from enriched
            where standard_cost is null and gross_revenue is not null"""),
    ),
    "check_unmapped": _failing(
        ("unmapped", """
            select count(*) from enriched e
            where (region = 'UNMAPPED') = exists (
              select 1 from accounts a where a.customer_id = e.customer_id)"""),
        ("accounts_lost", """
            select count(*) from enriched e
            where (region = 'UNMAPPED') = exists (
              select 1 from accounts a where a.customer_id = e.customer_id
                and a.segment <> 'BUILDING')"""),
        ("rows_kept", "select 0"),
        ("rows_dropped", """
            select count(*) from clean c
            where not exists (
              select 1 from accounts a where a.customer_id = c.customer_id)"""),
    ),
    "check_cancelled": _failing(
        ("cancelled", """
            select count(*) from enriched
            where order_status = 'Cancelled' and delivery_status <> 'Cancelled'"""),
        ("date_wins", """
            select count(*) from enriched
            where order_status = 'Cancelled' and actual_delivery_date is not null"""),
    ),
    "check_backdated": _failing(
        ("backdated", """
            select count(*) from enriched
            where actual_delivery_date < order_date
              and delivery_status not in ('Unknown', 'Cancelled')"""),
        ("rule_ignored",
         "select count(*) from enriched where actual_delivery_date < order_date"),
        ("backdated_rows",
         "select count(*) from enriched where actual_delivery_date < order_date"),
    ),
    "check_outer_join_survival": _failing(
        ("full_outer", """
            select greatest(0, (select count(*) from forecast)
                               - (select count(forecast_revenue) from mart))
                 + greatest(0, (select count(*) from monthly where region = 'UNMAPPED')
                               - (select count(*) from mart where region = 'UNMAPPED'))"""),
        ("inner", """
            select (select count(*) from forecast)
                 - (select count(*) from forecast f join monthly m
                      on m.product_id = f.product_id and m.region = f.region
                     and m.revenue_month = f.forecast_month)
                 + (select count(*) from monthly where region = 'UNMAPPED')"""),
    ),
}

ORACLE_SQL = {key: statement(select) for key, select in _SELECTS.items()}
