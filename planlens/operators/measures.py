"""Aggregates over the published star: variance, delivery, margin, reconciliation.

Filters compose before any of these; reconciliation takes unfiltered inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planlens.functions import casts, rules
from planlens.operators import joins
from planlens.schemas import GRAIN

_WHOLE = "decimal(28,0)"


def _whole(value: Column) -> Column:
    return F.round(value, 0).cast(_WHOLE)


# -- filters ---------------------------------------------------------------


def with_family(facts: DataFrame, products: DataFrame) -> DataFrame:
    """Attach ``product_family``; a product the dimension lacks is 'Unknown'."""
    families = products.select("product_id", "product_family")
    found = joins.lookup(facts, families, "product_id")
    return found.withColumn("product_family", F.coalesce("product_family", F.lit(rules.UNKNOWN)))


def apply_filters(
    facts: DataFrame,
    products: DataFrame,
    *,
    regions: Sequence[str] = (),
    families: Sequence[str] = (),
    months: tuple[str, str] | None = None,
) -> DataFrame:
    """Restrict a fact by region, family and month range (both ends included).

    An empty list means no filter. Fact filters come before the family lookup,
    so they reach the scan; chosen families restrict the dimension first and
    semi-join the fact.
    """
    facts = restrict(facts, regions=regions, months=months)
    if not families:
        return with_family(facts, products)
    chosen = products.where(F.col("product_family").isin(list(families)))
    chosen = chosen.select("product_id", "product_family")
    return joins.lookup(facts, chosen, "product_id").where(F.col("product_family").isNotNull())


def filter_options(mart: DataFrame, products: DataFrame) -> DataFrame:
    """The choices each filter offers, as (filter, option) rows."""

    def options(label: str, df: DataFrame, column: str) -> DataFrame:
        return df.select(F.lit(label).alias("filter"), F.col(column).cast("string").alias("option"))

    return (
        options("region", mart, "region")
        .unionByName(options("product_family", products, "product_family"))
        .unionByName(options("revenue_month", mart, "revenue_month"))
        .distinct()
        .orderBy("filter", "option")
    )


def entitled(mart: DataFrame, mapping: DataFrame, user: str) -> DataFrame:
    """Only the regions mapped to ``user``: of the mart, or of what it is made from."""
    allowed = mapping.where(F.col("user") == user).select("region").distinct()
    return mart.join(allowed, "region", "left_semi").select(*mart.columns)


def restrict(
    facts: DataFrame,
    *,
    regions: Sequence[str] = (),
    months: tuple[str, str] | None = None,
    month: str = "revenue_month",
) -> DataFrame:
    """Rows of the regions and of the month range, both ends included; empty means all."""
    if regions:
        facts = facts.where(F.col("region").isin(list(regions)))
    if months:
        facts = facts.where(F.col(month).between(*[F.lit(m).cast("date") for m in months]))
    return facts


def detail_table(mart: DataFrame, flags: Sequence[str] = ()) -> DataFrame:
    """Cells of the chosen flags (none chosen = all), worst variance first."""
    if flags:
        mart = mart.where(F.col("variance_flag").isin(list(flags)))
    return mart.select(
        "product_id", "product_family", "region", "revenue_month", "actual_revenue",
        "forecast_revenue", "revenue_variance", "revenue_variance_pct", "variance_flag",
    ).orderBy("revenue_variance", *GRAIN)


# -- revenue against plan --------------------------------------------------


def variance_by_region(mart: DataFrame) -> DataFrame:
    plan, variance = F.sum("forecast_revenue"), F.sum("revenue_variance")
    return (
        mart.groupBy("region")
        .agg(
            F.count("*").alias("mart_rows"),
            _whole(F.sum("actual_revenue")).alias("actual"),
            _whole(plan).alias("forecast"),
            _whole(variance).alias("variance"),
            casts.ratio(variance, plan).alias("variance_pct"),
        )
        .orderBy("variance", "region")
    )


def variance_by_flag(mart: DataFrame) -> DataFrame:
    """In the fixed flag order."""
    return (
        mart.groupBy("variance_flag")
        .agg(
            F.count("*").alias("mart_rows"),
            _whole(F.sum("actual_revenue")).alias("actual"),
            _whole(F.sum("forecast_revenue")).alias("forecast"),
        )
        .withColumn("flag_order", rules.ordinal(F.col("variance_flag"), rules.VARIANCE_FLAGS))
        .orderBy("flag_order")
    )


def variance_by_family(mart: DataFrame) -> DataFrame:
    """``mart`` carries ``product_family``."""
    return (
        mart.groupBy("product_family")
        .agg(
            F.sum("revenue_variance").alias("revenue_variance"),
            F.sum("actual_revenue").alias("actual_revenue"),
        )
        .orderBy("revenue_variance", "product_family")
    )


def monthly_trend(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("revenue_month")
        .agg(
            F.sum("actual_revenue").alias("actual_revenue"),
            F.sum("forecast_revenue").alias("forecast_revenue"),
        )
        .withColumn("month_label", F.date_format("revenue_month", "MMM yyyy"))
        .orderBy("revenue_month")
    )


def headline_kpis(mart: DataFrame) -> DataFrame:
    """One row: the totals a summary page leads with."""
    actual, plan = F.sum("actual_revenue"), F.sum("forecast_revenue")
    variance = actual - F.coalesce(plan, F.lit(0))
    on_time = F.sum("on_time_count")
    arrived = on_time + F.sum("late_count")
    unmapped = F.when(F.col("region") == rules.UNMAPPED, F.col("actual_revenue"))
    return mart.agg(
        actual.alias("actual_revenue"),
        plan.alias("forecast_revenue"),
        variance.cast("decimal(28,2)").alias("revenue_variance"),
        casts.ratio(variance, plan).alias("variance_pct"),
        on_time.alias("on_time_count"),
        arrived.alias("arrived_count"),
        casts.ratio(on_time, arrived).alias("on_time_rate"),
        F.count_if(F.col("variance_flag") == "NO_ACTUALS").alias("no_actuals_rows"),
        F.count("*").alias("total_rows"),
        F.coalesce(F.sum(unmapped), F.lit(0).cast("decimal(28,2)")).alias("unmapped_revenue"),
    )


def worst_variance(mart: DataFrame, limit: int = 20) -> DataFrame:
    return mart.orderBy("revenue_variance", *GRAIN).limit(limit)


def top_bottom_variance(mart: DataFrame, limit: int = 5) -> DataFrame:
    """The cells furthest above and furthest below plan, from one pass over the mart.

    Every cell stands once on each side, by its distance; a task passes on no more than
    ``limit`` cells a side.
    """
    side = lambda name, sign: F.struct(
        F.lit(name).alias("side"), (F.col("revenue_variance") * sign).alias("_distance")
    )
    both = mart.select(
        *GRAIN, "revenue_variance", F.inline(F.array(side("above", -1), side("below", 1)))
    )
    nearest = Window.partitionBy("side").orderBy("_distance", *GRAIN)
    return (
        both.withColumn("_place", F.row_number().over(nearest))
        .where(F.col("_place") <= limit)
        .select(*GRAIN, "revenue_variance", "side")
    )


# -- product x region cells ------------------------------------------------


def _notable_flag() -> Column:
    """The most notable outcome any month of the cell reached."""
    flag = F.col("variance_flag")
    return F.min_by(flag, rules.ordinal(flag, rules.CELL_PRIORITY))


def flag_cells(mart: DataFrame) -> DataFrame:
    return mart.groupBy("product_id", "region").agg(_notable_flag().alias("cell_flag"))


def flag_pivot(mart: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Products down, regions across; listing the regions saves a pass to find them.

    A region that is not listed fails the query: its cells would be missing from the result.
    """
    return _across(mart, regions, _notable_flag()).orderBy("product_id")


def _across(mart: DataFrame, regions: Sequence[str], value: Column) -> DataFrame:
    region = F.coalesce("region", F.lit("NULL"))
    known = F.when(F.col("region").isin(list(regions)), F.col("region")).otherwise(
        F.raise_error(F.concat(F.lit("region is not listed: "), region))
    )
    listed = mart.withColumn("region", known)
    return listed.groupBy("product_id").pivot("region", sorted(regions)).agg(value)


def composition_pivot(mart: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Each cell's months as in ``cell_composition``, products down and regions across; a
    cell without months is the empty text."""
    wide = _across(mart, regions, _composition())
    cells = [F.coalesce(F.col(f"`{r}`"), F.lit("")).alias(r) for r in sorted(regions)]
    return wide.select("product_id", *cells).orderBy("product_id")


def cell_composition(mart: DataFrame) -> DataFrame:
    """Each cell's months in order, as "Jan 2024: FLAG; Feb 2024: FLAG".

    The list holds one short entry per calendar month, because the mart has one
    row per cell and month.
    """
    return mart.groupBy("product_id", "region").agg(
        _composition().alias("composition"), F.count("*").alias("months")
    )


def _composition() -> Column:
    months = F.array_sort(F.collect_list(F.struct("revenue_month", "variance_flag")))
    text = F.transform(
        months,
        lambda m: F.concat(
            F.date_format(m["revenue_month"], "MMM yyyy"), F.lit(": "), m["variance_flag"]
        ),
    )
    return F.array_join(text, "; ")


def flag_counts_two_grains(mart: DataFrame) -> DataFrame:
    """Flags counted per product-region-month and per product-region cell.

    The mart is read once: it is grouped by flag and, in the same aggregate, by cell, and
    the cells are then counted by the flag that is theirs.
    """
    month_flag = mart.withColumn("_flag", F.col("variance_flag"))
    sets = month_flag.groupingSets(
        [["_flag"], ["product_id", "region"]], "_flag", "product_id", "region"
    ).agg(
        F.grouping("_flag").alias("_is_cell"), F.count("*").alias("_months"),
        _notable_flag().alias("_cell_flag"),
    )
    of_cell = F.col("_is_cell") == 1
    return (
        sets.select(
            F.when(of_cell, "cell").otherwise("month").alias("grain"),
            F.when(of_cell, F.col("_cell_flag")).otherwise(F.col("_flag")).alias("variance_flag"),
            F.when(of_cell, 1).otherwise(F.col("_months")).alias("_n"),
        )
        .groupBy("grain", "variance_flag")
        .agg(F.sum("_n").alias("flag_count"))
    )


# -- delivery --------------------------------------------------------------


def _scored(orders: DataFrame) -> DataFrame:
    """Shipped orders that arrived and can be held to their promise."""
    return orders.where(
        (F.col("order_status") == "Shipped")
        & F.col("delivery_status").isin("On Time", "Late")
    )


def _gap_days() -> Column:
    return F.date_diff("actual_delivery_date", "promised_delivery_date")


def delivery_distribution(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("delivery_status")
        .agg(F.count("*").alias("order_count"))
        .orderBy("order_count", "delivery_status")
    )


def on_time_by_region(orders: DataFrame) -> DataFrame:
    on_time = F.count_if(F.col("delivery_status") == "On Time")
    return (
        _scored(orders)
        .groupBy("region")
        .agg(
            on_time.alias("on_time"),
            F.count("*").alias("total"),
            casts.ratio(on_time, F.count("*")).alias("on_time_rate"),
        )
        .orderBy("on_time_rate", "region")
    )


def delivery_gap(orders: DataFrame) -> DataFrame:
    """Mean and worst gap in days, per region and overall (region 'ALL').

    The overall row is summed from the regional rows, so orders are read once.
    """
    by_region = (
        _scored(orders)
        .groupBy("region")
        .agg(
            F.sum(_gap_days()).alias("gap_days"),
            F.count(_gap_days()).alias("orders"),
            F.max(_gap_days()).alias("worst_gap"),
        )
    )
    scopes = F.explode(F.array(F.col("region"), F.lit("ALL")))
    return (
        by_region.withColumn("scope", scopes)
        .groupBy(F.col("scope").alias("region"))
        .agg(
            F.sum("orders").alias("orders"),
            casts.ratio(F.sum("gap_days"), F.sum("orders")).alias("mean_gap"),
            F.max("worst_gap").alias("worst_gap"),
        )
        .orderBy("mean_gap", "region")
    )


def late_orders(orders: DataFrame) -> DataFrame:
    return (
        orders.where(
            (F.col("order_status") == "Shipped") & (F.col("delivery_status") == "Late")
        )
        .select(
            "order_id", "customer_id", "product_id", "region", "order_date",
            "promised_delivery_date", "actual_delivery_date",
            _gap_days().alias("days_late"), "gross_revenue",
        )
        .orderBy(F.desc("days_late"), "order_id")
    )


def contradiction_counts(orders: DataFrame) -> DataFrame:
    """Orders whose dates contradict their status or each other."""
    return orders.agg(
        F.count_if(F.col("delivery_status") == "Cancelled").alias("cancelled_orders"),
        F.count_if(
            (F.col("delivery_status") == "Cancelled") & F.col("actual_delivery_date").isNotNull()
        ).alias("cancelled_with_delivery_date"),
        F.count_if(F.col("delivery_status") == rules.UNKNOWN).alias("unknown_orders"),
    )


def degraded_orders(orders: DataFrame) -> DataFrame:
    """Kept for their revenue, with one attribute honestly unknown."""
    return (
        orders.where(
            (F.col("region") == rules.UNMAPPED)
            | ~F.col("has_standard_cost")
            | (F.col("delivery_status") == rules.UNKNOWN)
        )
        .select(
            "order_id", "customer_id", "product_id", "region", "has_standard_cost",
            "gross_margin", "delivery_status",
        )
        .orderBy("order_id")
    )


# -- margin and products ---------------------------------------------------


def margin_coverage(orders: DataFrame) -> DataFrame:
    """Margin total of recognised orders next to the share of orders it can speak for."""
    known = F.count_if("has_standard_cost")
    margin = F.when(F.col("is_recognised_revenue"), F.col("gross_margin"))
    return orders.agg(
        F.count("*").alias("order_count"),
        known.alias("orders_with_known_cost"),
        F.coalesce(F.sum(margin), F.lit(0).cast("decimal(28,2)")).alias("total_margin"),
        casts.ratio(known, F.count("*")).alias("margin_coverage"),
    )


def margin_by_product(mart: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Each side is one row per product before it is joined."""
    by_product = mart.groupBy("product_id").agg(
        F.sum("actual_revenue").alias("actual_revenue"),
        F.sum("actual_margin").alias("actual_margin"),
    )
    coverage = orders.groupBy("product_id").agg(
        F.count_if("has_standard_cost").alias("orders_with_known_cost"),
        F.count("*").alias("order_count"),
    )
    names = products.select("product_id", "product_name")
    return (
        by_product.join(coverage, "product_id", "left")
        .join(names, "product_id", "left")
        .select(
            "product_id",
            F.coalesce("product_name", "product_id").alias("product_name"),
            "actual_revenue",
            "actual_margin",
            "orders_with_known_cost",
            "order_count",
            casts.ratio(F.col("orders_with_known_cost"), F.col("order_count")).alias(
                "margin_coverage"
            ),
        )
        .orderBy(F.desc("actual_margin"), "product_id")
    )


def uncovered_orders(orders: DataFrame) -> DataFrame:
    """Orders without a standard cost, as rows: the list has no bound."""
    return (
        orders.where(~F.col("has_standard_cost"))
        .select("order_id", "product_id", "gross_revenue")
        .orderBy("order_id")
    )


def uncovered_products(orders: DataFrame) -> DataFrame:
    return (
        orders.where(~F.col("has_standard_cost"))
        .groupBy("product_id")
        .agg(F.count("*").alias("order_count"), F.sum("gross_revenue").alias("gross_revenue"))
        .orderBy("product_id")
    )


def lifecycle_counts(products: DataFrame) -> DataFrame:
    return (
        products.where(~F.col("is_synthetic"))
        .groupBy("lifecycle_status")
        .agg(F.count("*").alias("product_count"))
        .orderBy(F.desc("product_count"), "lifecycle_status")
    )


def product_list(products: DataFrame) -> DataFrame:
    return (
        products.where(~F.col("is_synthetic"))
        .select("product_id", "product_name", "product_family", "lifecycle_status", "standard_cost")
        .orderBy("product_id")
    )


# -- reconciliation --------------------------------------------------------

BUCKETS = ("recognised", "open", "cancelled", "other", "rejected")


def source_revenue(price: Column, quantity: Column) -> Column:
    """A landed line's revenue, straight from its texts.

    The price has the currency's two places, as published. The quantity is the number its
    text says, with its fraction and whatever its size: what the integer cast rounds or
    loses is revenue of the source.
    """
    return casts.lenient_money(price) * quantity.try_cast("decimal(20,4)")


def source_lines(raw_orders: DataFrame) -> DataFrame:
    """The revenue of every landed line, straight from its text."""
    revenue = source_revenue(F.trim("unit_price"), F.trim("quantity"))
    return raw_orders.select(revenue.alias("gross_revenue"))


def _unrecognised_bucket() -> Column:
    return rules.first_match(
        (F.col("order_status") == "Open", "open"),
        (F.col("order_status") == "Cancelled", "cancelled"),
        otherwise="other",
    )


def unrecognised_sums() -> dict[str, Column]:
    """Aggregates over enriched orders: revenue per bucket that no cell recognises."""
    waiting = F.when(~F.col("is_recognised_revenue"), _unrecognised_bucket())
    return {
        f"{bucket}_revenue": F.sum(F.when(waiting == bucket, F.col("gross_revenue")))
        for bucket in BUCKETS[1:4]
    }


def reconciliation_totals(
    lines: DataFrame,
    cells: DataFrame,
    *,
    sources: Sequence[str] = ("source",),
    recognised: dict[str, Column] | None = None,
) -> DataFrame:
    """One row: the source, and every place its revenue can land, from two passes.

    ``lines`` are flagged lines that carry their source revenue (``sources``, more than one
    to compare several readings of the text); ``cells`` is the mart with the
    ``unrecognised_sums`` of its cells. Both are only summed, so whatever computes the lines
    is read once, and what gets lost or multiplied on the way to the mart still shows.
    ``recognised`` names sums of the mart's revenue under a condition.
    """
    recognised = recognised or {"recognised": F.lit(True)}
    amount = lambda c: F.sum(c).cast("decimal(28,2)")
    rejected = F.when(F.col("dq_failure_reason").isNotNull(), F.col("gross_revenue"))
    parts = [
        lines.agg(*[amount(c).alias(c) for c in sources], amount(rejected).alias("rejected")),
        cells.agg(
            *[amount(F.when(kept, F.col("actual_revenue"))).alias(n) for n, kept in recognised.items()],
            *[amount(f"{b}_revenue").alias(b) for b in BUCKETS[1:4]],
        ),
    ]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    zero = F.lit(0).cast("decimal(28,2)")
    return both.agg(*[
        F.coalesce(F.sum(c), zero).cast("decimal(28,2)").alias(c) for c in both.columns
    ])


def reconciliation_amounts(
    source: DataFrame, mart: DataFrame, orders: DataFrame, rejects: DataFrame
) -> DataFrame:
    """(bucket, amount) for the source and for every place its revenue can land.

    The source side is ``source_lines``; the recognised side is read from the mart, so
    revenue lost or multiplied on the way there shows up as a difference.
    """
    parts = [
        (source, F.lit("source"), "gross_revenue"),
        (mart, F.lit("recognised"), "actual_revenue"),
        (orders.where(~F.col("is_recognised_revenue")), _unrecognised_bucket(), "gross_revenue"),
        (rejects, F.lit("rejected"), "gross_revenue"),
    ]
    tagged = [
        df.select(bucket.alias("bucket"), F.col(amount).cast("decimal(28,2)").alias("amount"))
        for df, bucket, amount in parts
    ]
    union = tagged[0]
    for part in tagged[1:]:
        union = union.unionByName(part)
    return union.groupBy("bucket").agg(F.sum("amount").alias("amount"))


def reconciliation(amounts: DataFrame) -> DataFrame:
    """One row: every bucket, its share of the source, and what is unexplained."""
    zero = F.lit(0).cast("decimal(28,2)")

    def total(bucket: str) -> Column:
        matched = F.when(F.col("bucket") == bucket, F.col("amount"))
        return F.coalesce(F.sum(matched), zero).cast("decimal(28,2)").alias(bucket)

    return explained(amounts.agg(total("source"), *[total(b) for b in BUCKETS]))


def explained(totals: DataFrame) -> DataFrame:
    """Totals by bucket in a row, with each one's share of the source, and what is
    unexplained; further columns come along."""
    accounted = sum((F.col(b) for b in BUCKETS[1:]), F.col(BUCKETS[0])).cast("decimal(28,2)")
    return totals.select(
        "source",
        *BUCKETS,
        accounted.alias("accounted"),
        (F.col("source") - accounted).cast("decimal(28,2)").alias("unexplained"),
        *[casts.ratio(F.col(b), F.col("source")).alias(f"{b}_share") for b in BUCKETS],
        *[c for c in totals.columns if c not in ("source", *BUCKETS)],
    )


# -- the star --------------------------------------------------------------


def star(cells: DataFrame, products: DataFrame, regions: DataFrame, dates: DataFrame) -> DataFrame:
    """Cells with their dimension attributes, many-to-one on every side."""
    product = products.select(
        "product_id", "product_name", "product_family", "lifecycle_status", "is_synthetic"
    )
    region = regions.select(F.col("region_name").alias("region"), "is_forecastable")
    date = dates.select(
        F.col("date_month").alias("revenue_month"), "year_number", "quarter_number",
        "year_month_label",
    )
    return joins.lookups(cells, dict(zip(GRAIN, (product, region, date))))


def measures(cells: DataFrame, *dimensions: str) -> DataFrame:
    """The semantic measures by any dimensions: ratios of sums, NULL on a zero base."""
    actual, plan = F.sum("actual_revenue"), F.sum("forecast_revenue")
    variance = actual - F.coalesce(plan, F.lit(0))
    on_time = F.sum("on_time_count")
    return cells.groupBy(*dimensions).agg(
        actual.alias("actual_revenue"),
        plan.alias("forecast_revenue"),
        variance.cast("decimal(28,2)").alias("revenue_variance"),
        casts.ratio(variance, plan).alias("variance_pct"),
        F.sum("actual_margin").alias("gross_margin"),
        casts.ratio(F.sum("orders_with_known_cost"), F.sum("order_count")).alias(
            "margin_coverage_pct"
        ),
        casts.ratio(on_time, on_time + F.sum("late_count")).alias("on_time_delivery_pct"),
    )


def orders_by_customer_attribute(
    orders: DataFrame, customers: DataFrame, attribute: str
) -> DataFrame:
    """Order facts by one attribute of the customer dimension.

    Orders are rolled up per customer before the join, so a customer with a
    large share of all orders is still one row there.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.count("*").alias("order_count"), F.sum("gross_revenue").alias("gross_revenue")
    )
    return (
        per_customer.join(customers.select("customer_id", attribute), "customer_id", "left")
        .groupBy(attribute)
        .agg(
            F.sum("order_count").alias("order_count"),
            F.sum("gross_revenue").cast("decimal(38,2)").alias("gross_revenue"),
        )
    )
