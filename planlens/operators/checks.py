"""Data-quality checks. Each is a set of failing rows; the runner counts them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planlens.functions import rules

# -- generic checks: functions returning the failing rows --------------------


def not_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values held by more than one row. A row missing any of them is not compared."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(present).groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def without_parent(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child keys the parent lacks, with their row counts.

    Keys are counted first, so the anti join sees one row per key.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count("*").alias("n"))
    )
    return keys.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_unaccepted(column: str, values: Sequence[str]) -> Column:
    """Outside the accepted values; NULL passes."""
    return F.coalesce(~F.col(column).isin(list(values)), F.lit(False))


# -- counting ----------------------------------------------------------------


def counted(name: str, failures: DataFrame, rows: Column | None = None) -> DataFrame:
    """(check_name, failing_rows) for a DataFrame of failures."""
    total = F.count("*") if rows is None else F.coalesce(F.sum(rows), F.lit(0))
    return failures.agg(total.cast("bigint").alias("failing_rows")).select(
        F.lit(name).alias("check_name"), "failing_rows"
    )


def row_checks(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Many per-row checks of one table in a single pass: {name: failing condition}."""
    counts = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.count_if(condition).alias("failing_rows"),
        )
        for name, condition in conditions.items()
    ]
    return df.agg(F.array(*counts).alias("checks")).select(F.inline("checks"))


# -- many checks, one read of each table ----------------------------------------


@dataclass(frozen=True)
class Rows:
    """Rows that meet a condition fail."""

    name: str
    table: str
    condition: Column


@dataclass(frozen=True)
class Unique:
    """Values on more than one row fail; a row missing any of the columns is not compared."""

    name: str
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Orphans:
    """Rows whose value no row of the parent has fail; rows without a value pass."""

    name: str
    table: str
    column: str
    parent: str
    parent_column: str


Check = Rows | Unique | Orphans


_BITS = 62  # checks that share a subject: one bit of a long each


def in_one_pass(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(check_name, failing_rows) of all ``checks``, with one read of each table and one shuffle.

    Checks of the same columns share a subject, and so do the conditions of a table. A row becomes
    one short record per subject of its table, with the key that is checked or the conditions that
    it fails, if any; as a parent, one per key that it offers. Records are counted per subject and
    key before the shuffle, so a hot key, or a condition that every row fails, is a record per
    task. Keys of different tables meet there, so no table is joined or broadcast.
    """
    if not checks:
        raise ValueError("no checks")
    wide = max([1, *[len(c.columns) for c in checks if isinstance(c, Unique)]])
    sharing: dict[tuple, int] = {}
    subjects: dict[tuple, int] = {}
    places: list[tuple[int, int]] = []  # subject and bit of each check
    failed: dict[tuple[str, int], list[Column]] = {}
    records: dict[str, list[Column]] = {}
    none = F.lit(None).cast("string")

    def record(table: str, subject: int, keys: Sequence[Column], where: Column, offered: int = 0) -> None:
        padded = [*keys, *[none] * (wide - len(keys))]
        fields = [F.lit(subject).alias("subject"), F.lit(offered).cast("long").alias("offered")]
        fields += [k.alias(f"key{n}") for n, k in enumerate(padded)]
        records.setdefault(table, []).append(F.when(where, F.struct(*fields)))

    def of(table: str, columns: Sequence[str], subject: int, offered: int = 0) -> None:
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        record(table, subject, [F.col(c).cast("string") for c in columns], present, offered)

    for check in checks:
        columns = check.columns if isinstance(check, Unique) else (
            (check.column,) if isinstance(check, Orphans) else ())
        number = sharing.get((check.table, columns), 0)
        sharing[check.table, columns] = number + 1
        key = (check.table, columns, number // _BITS)
        if key not in subjects:
            subjects[key] = len(subjects)
            if columns:
                of(check.table, columns, subjects[key])
        subject, bit = subjects[key], number % _BITS
        places.append((subject, bit))
        if isinstance(check, Rows):
            fails = F.when(check.condition, F.lit(1 << bit).cast("long")).otherwise(0)
            failed.setdefault((check.table, subject), []).append(fails)
        elif isinstance(check, Orphans):
            of(check.parent, (check.parent_column,), subject, 1 << bit)
    for (table, subject), bits in failed.items():
        mask = reduce(lambda a, b: a + b, bits)
        record(table, subject, [mask.cast("string")], mask != 0)

    # Without higher-order functions, so that conditions and keys are compiled code.
    read = [
        tables[table].select(F.inline(F.array(*of_table))).where("subject is not null")
        for table, of_table in records.items()
    ]
    keys = [f"key{n}" for n in range(wide)]
    counted_keys = together(read).groupBy("subject", *keys).agg(
        F.count_if(F.col("offered") == 0).alias("n"), F.bit_or("offered").alias("known")
    )
    by_condition = F.col("subject").isin([subject for _, subject in failed])
    met = F.when(by_condition, F.col("key0").cast("long")).otherwise(F.col("known"))
    found = counted_keys.groupBy(
        "subject", met.alias("bits"), (F.col("n") > 1).alias("repeated")
    ).agg(F.sum("n").alias("n"), F.count("*").alias("keys"))

    def listed(values: Sequence) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("id").cast("int") + 1)

    spark = read[0].sparkSession
    asked = spark.range(len(checks)).select(
        "id", listed([c.name for c in checks]).alias("check_name"),
        listed([type(c).__name__ for c in checks]).alias("kind"),
        listed([subject for subject, _ in places]).alias("subject"),
        listed([bit for _, bit in places]).alias("bit"),
    )
    has_bit = F.bit_get("bits", "bit") == 1
    failing = (
        F.when(F.col("kind") == Unique.__name__, F.when(F.col("repeated"), F.col("keys")))
        .when(has_bit == (F.col("kind") == Rows.__name__), F.col("n"))
    )
    return asked.join(found, "subject", "left").groupBy("id", "check_name").agg(
        F.coalesce(F.sum(failing), F.lit(0).cast("bigint")).alias("failing_rows")
    ).drop("id")


def together(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def verdicts(results: DataFrame, warn_only: Sequence[str] = ()) -> DataFrame:
    """Add severity and status; a warning never fails a run."""
    severity = F.when(F.col("check_name").isin(list(warn_only)), "warn").otherwise("error")
    return results.select(
        "check_name",
        severity.alias("severity"),
        "failing_rows",
        F.when(F.col("failing_rows") == 0, "pass")
        .when(severity == "warn", "warn")
        .otherwise("fail")
        .alias("status"),
    )


# -- invariants of this model ------------------------------------------------


def partition_complete(raw: DataFrame, clean: DataFrame, rejects: DataFrame) -> DataFrame:
    """Source lines minus clean minus rejected, when not zero."""
    tagged = [
        df.agg(F.count("*").alias("n")).select((F.lit(sign) * F.col("n")).alias("n"))
        for df, sign in ((raw, 1), (clean, -1), (rejects, -1))
    ]
    return together(tagged).agg(F.sum("n").alias("missing_rows")).where(F.col("missing_rows") != 0)


def is_unreconciled(tolerance: str = "0.01") -> Column:
    """More than a cent is unexplained."""
    return F.abs("unexplained") > F.lit(tolerance).cast("decimal(28,2)")


def unreconciled(reconciliation: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """The reconciliation row, when more than a cent is unexplained."""
    return reconciliation.where(is_unreconciled(tolerance)).select(
        "source", "accounted", "unexplained"
    )


def duplicates_not_quarantined(
    typed: DataFrame, clean: DataFrame, rejects: DataFrame
) -> DataFrame:
    """Ids repeated in the source whose copies are not all rejected as duplicates.

    One shuffle of (id, where found), combined before it.
    """
    quarantined = rejects.where(F.col("dq_failure_reason") == rules.DEFECT_REASONS[0])
    sides = {"source": typed, "kept": clean, "quarantined": quarantined}
    found = together([
        df.select("order_id", F.lit(side).alias("side")) for side, df in sides.items()
    ])
    return (
        found.groupBy("order_id")
        .agg(*[F.count_if(F.col("side") == side).alias(side) for side in sides])
        .where(
            (F.col("source") > 1) & ((F.col("kept") > 0) | (F.col("quarantined") != F.col("source")))
        )
    )


def margin_without_cost(enriched: DataFrame) -> DataFrame:
    """A margin made up for an unknown cost, or revenue lost with it."""
    return enriched.where(
        (F.col("standard_cost").isNull() & F.col("gross_margin").isNotNull())
        | (~F.col("has_standard_cost") & F.col("gross_revenue").isNull())
    )


def wrongly_unmapped(enriched: DataFrame, accounts: DataFrame) -> DataFrame:
    """Customers tagged UNMAPPED though an account gives them a region, or mapped
    though none does; with their order counts. What enrichment dropped is ``dropped``'s."""
    known = accounts.where(F.col("region").isNotNull()).select(
        "customer_id", F.lit(True).alias("known")
    )
    per_customer = enriched.groupBy("customer_id").agg(
        F.count_if(F.col("region") == rules.UNMAPPED).alias("unmapped"),
        F.count_if(F.col("region") != rules.UNMAPPED).alias("mapped"),
    )
    wrong = F.when(F.col("known"), F.col("unmapped")).otherwise(F.col("mapped"))
    return (
        per_customer.join(known, "customer_id", "left")
        .select("customer_id", wrong.alias("n"))
        .where(F.col("n") > 0)
    )


def dropped(orders: DataFrame, enriched: DataFrame) -> DataFrame:
    """How many clean orders enrichment lost or multiplied, if any."""
    count = F.count("*").cast("bigint")
    both = together([orders.agg(count.alias("n")), enriched.agg((-count).alias("n"))])
    return both.agg(F.abs(F.sum("n")).alias("n")).where(F.col("n") != 0)


def cancelled_but_delivered(enriched: DataFrame) -> DataFrame:
    return enriched.where(
        (F.col("order_status") == "Cancelled") & (F.col("delivery_status") != "Cancelled")
    )


def backdated_misjudged(enriched: DataFrame) -> DataFrame:
    """Delivered before ordered, yet not Unknown. Cancelled outranks it."""
    return enriched.where(
        (F.col("actual_delivery_date") < F.col("order_date"))
        & ~F.col("delivery_status").isin(rules.UNKNOWN, "Cancelled")
    )


def backdated_count(enriched: DataFrame, expected: int | None = None) -> DataFrame:
    """How many orders are backdated, when that is not ``expected``."""
    count = enriched.agg(
        F.count_if(F.col("actual_delivery_date") < F.col("order_date")).alias("backdated")
    )
    return count if expected is None else count.where(F.col("backdated") != expected)


def lost_by_outer_join(forecast: DataFrame, monthly: DataFrame, mart: DataFrame) -> DataFrame:
    """Plan rows, or unmapped cells, that went in and did not come out, or came out
    multiplied (a negative ``n``)."""
    unmapped = F.count_if(F.col("region") == rules.UNMAPPED)
    zero = F.lit(0).cast("bigint")
    sides = [
        forecast.agg(F.count("*").alias("plan"), zero.alias("unmapped")),
        monthly.agg(zero.alias("plan"), unmapped.alias("unmapped")),
        mart.agg(
            (-F.count("forecast_revenue")).alias("plan"), (-unmapped).alias("unmapped")
        ),
    ]
    missing = together(sides).agg(F.sum("plan").alias("plan"), F.sum("unmapped").alias("unmapped"))
    return missing.select(
        F.inline(F.array(
            F.struct(F.lit("plan rows").alias("lost"), F.col("plan").alias("n")),
            F.struct(F.lit("unmapped cells").alias("lost"), F.col("unmapped").alias("n")),
        ))
    ).where(F.col("n") != 0)


# -- the model's suite -------------------------------------------------------


@dataclass
class Expectations:
    """Column checks of one table."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    accepted: dict[str, Sequence[str]] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    grain: Sequence[str] = ()

    def checks(self, table: str) -> list[Check]:
        return [
            *[Rows(f"{table}.{c} not_null", table, is_missing(c)) for c in self.not_null],
            *[Rows(f"{table}.{c} accepted", table, is_unaccepted(c, v)) for c, v in self.accepted.items()],
            *[Unique(f"{table}.{c} unique", table, (c,)) for c in self.unique],
            *([Unique(f"{table} grain", table, tuple(self.grain))] if self.grain else []),
            *[Orphans(f"{table}.{c} parent", table, c, *parent) for c, parent in self.parents.items()],
        ]


# The accepted vocabulary of the published model.
DOMAINS = {
    "regions": ("LATAM", "North America", "EMEA", "APAC"),
    "segments": ("Enterprise", "Mid-Market", "SMB"),
    "lifecycles": ("Active", "Discontinued", "Pending"),
    "plant_countries": ("Costa Rica", "USA"),
}

# A new plant country is news, not corruption.
WARN_ONLY = ("stg_orders.plant_country accepted",)


def model_expectations(domains: dict[str, Sequence[str]] = DOMAINS) -> dict[str, Expectations]:
    """The column checks of every layer, for the given vocabulary. Tables,
    columns and which check each has."""
    regions = tuple(domains["regions"])
    all_regions = (*regions, rules.UNMAPPED)
    plan_grain = ("product_id", "region", "forecast_month")
    cell_grain = ("product_id", "region", "revenue_month")
    return {
        "stg_orders": Expectations(
            unique=["order_id"],
            not_null=["order_id", "customer_id", "product_id", "order_date", "unit_price",
                      "gross_revenue"],
            accepted={
                "order_status": rules.ORDER_STATUSES,
                "source_batch": rules.SOURCE_BATCHES,
                "plant_country": domains["plant_countries"],
            },
        ),
        "stg_rejects": Expectations(
            not_null=["dq_failure_reason"],
            accepted={"dq_failure_reason": rules.DEFECT_REASONS},
        ),
        "stg_accounts": Expectations(
            unique=["customer_id"],
            not_null=["customer_id", "region"],
            accepted={"region": regions, "segment": domains["segments"]},
        ),
        "stg_forecast": Expectations(
            unique=["forecast_id"],
            not_null=["forecast_id", "forecast_revenue"],
            accepted={"region": regions},
            parents={"product_id": ("stg_products", "product_id")},
            grain=plan_grain,
        ),
        "stg_products": Expectations(
            unique=["product_id"],
            not_null=["product_id", "standard_cost"],
            accepted={"lifecycle_status": domains["lifecycles"]},
        ),
        "orders_enriched": Expectations(
            unique=["order_id"],
            not_null=["order_id", "region", "delivery_status", "revenue_month", "gross_revenue"],
            accepted={"region": all_regions, "delivery_status": rules.DELIVERY_STATUSES},
        ),
        "monthly_revenue": Expectations(
            not_null=["actual_revenue", "order_count"],
            accepted={"region": all_regions},
            grain=cell_grain,
        ),
        "dim_date": Expectations(unique=["date_month"], not_null=["date_month"]),
        "dim_region": Expectations(unique=["region_name"], not_null=["region_name"]),
        "dim_customer": Expectations(
            unique=["customer_id"],
            not_null=["customer_id"],
            parents={"region": ("dim_region", "region_name")},
        ),
        "dim_product": Expectations(unique=["product_id"], not_null=["product_id"]),
        "fct_orders": Expectations(
            unique=["order_id"],
            not_null=["order_id"],
            accepted={"delivery_status": rules.DELIVERY_STATUSES},
            parents={
                "customer_id": ("dim_customer", "customer_id"),
                "product_id": ("dim_product", "product_id"),
                "region": ("dim_region", "region_name"),
            },
        ),
        "fct_forecast": Expectations(
            unique=["forecast_id"], not_null=["forecast_id", "forecast_revenue"], grain=plan_grain
        ),
        "mart": Expectations(
            not_null=["product_id", "region", "revenue_month", "actual_revenue",
                      "revenue_variance"],
            accepted={"variance_flag": rules.VARIANCE_FLAGS},
            parents={
                "product_id": ("dim_product", "product_id"),
                "region": ("dim_region", "region_name"),
            },
            grain=cell_grain,
        ),
        "reject_summary": Expectations(
            unique=["dq_failure_reason"], not_null=["dq_failure_reason", "rejected_row_count"]
        ),
    }


def suite_checks(
    expectations: dict[str, Expectations], only: Sequence[str] | None = None
) -> list[Check]:
    """The column checks of the named tables, in their order."""
    return [c for table in only or expectations for c in expectations[table].checks(table)]


def run_suite(
    tables: dict[str, DataFrame],
    expectations: dict[str, Expectations],
    only: Sequence[str] | None = None,
) -> DataFrame:
    """(check_name, failing_rows) for every column check of the named tables."""
    return in_one_pass(tables, suite_checks(expectations, only))
