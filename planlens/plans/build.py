"""Land, build and check the whole model as catalog tables.

Each layer is written once, as drafts, checked, and only then takes the place of what was
there: a layer that fails its checks leaves the published one as it is. The next layer reads
it back, so no step recomputes another's shuffle, and a lost executor costs a re-read.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planlens.operators import checks, dims, enrich, mart, measures, monthly, quality
from planlens.plans.pipeline import Pipeline
from planlens.session import settle
from planlens.sources.landing import land_raw
from planlens.sources.publish import Warehouse, concurrently

# Published names, (layer, table) by the name used here.
TABLES = {
    "stg_accounts": ("staging", "stg_salesforce__accounts"),
    "stg_products": ("staging", "stg_erp__products"),
    "stg_forecast": ("staging", "stg_adaptive__forecast"),
    "stg_flagged": ("staging", "stg_oracle__orders_flagged"),
    "stg_orders": ("staging", "stg_oracle__orders"),
    "stg_rejects": ("staging", "stg_oracle__orders_rejects"),
    "orders_enriched": ("staging", "int_orders_enriched"),
    "monthly_revenue": ("staging", "int_order_revenue_monthly"),
    "seed_region": ("staging", "seed_region"),
    "dim_region": ("analytics", "dim_region"),
    "dim_date": ("analytics", "dim_date"),
    "dim_customer": ("analytics", "dim_customer"),
    "dim_product": ("analytics", "dim_product"),
    "fct_orders": ("analytics", "fct_orders"),
    "fct_forecast": ("analytics", "fct_forecast"),
    "mart": ("analytics", "mart_revenue_performance"),
    "reject_summary": ("analytics", "dq_reject_summary"),
}


# By month, so that month filters prune.
PARTITIONED = {"fct_orders": ("revenue_month",), "mart": ("revenue_month",)}


class CheckFailed(RuntimeError):
    """A layer's checks failed; nothing downstream of it was built."""


class Build:
    """One run over landed tables. ``tables`` holds each stored table by name."""

    def __init__(
        self,
        spark: SparkSession,
        warehouse: Warehouse,
        *,
        domains: dict | None = None,
        expected_backdated: int | None = None,
        regions: list[tuple[str, str]] | None = None,
        calendar: tuple[str, str] | None = None,
    ) -> None:
        """``regions``: (name, "true" where a plan can match it); ``calendar``: the first day
        and the one after the last. Both default to the fixed values of ``dims``."""
        self.spark = spark
        self.warehouse = warehouse
        self.expectations = checks.model_expectations(domains or checks.DOMAINS)
        self.expected_backdated = expected_backdated
        self.regions = regions or dims.REGION_SEED
        self.calendar = calendar or (dims.SPINE_START, dims.SPINE_END)
        self.tables: dict[str, DataFrame] = {}
        self.results: list[DataFrame] = []

    def _draft(self, **tables: DataFrame) -> None:
        """Store the named tables, which must not depend on each other, as drafts."""
        stored = concurrently(*[
            partial(self.warehouse.draft, *TABLES[name], df, PARTITIONED.get(name, ()))
            for name, df in tables.items()
        ])
        self.tables.update(zip(tables, stored))

    def _promote(self, *names: str) -> None:
        """Let the drafts, once checked, replace their tables."""
        stored = concurrently(*[
            partial(self.warehouse.promote, *TABLES[name], PARTITIONED.get(name, ()))
            for name in names
        ])
        self.tables.update(zip(names, stored))

    def _check(self, names: list[str], singular: list[DataFrame] = ()) -> None:
        """Run the checks of a layer; an error stops the build, a warning does not."""
        parts = [checks.run_suite(self.tables, self.expectations, names), *singular]
        verdicts = checks.verdicts(checks.together(parts), checks.WARN_ONLY)
        # One row per check: the table is as long as the suite, not the data.
        rows = verdicts.collect()
        self.results.append(self.spark.createDataFrame(rows, verdicts.schema))
        failed = [f"{r.check_name}: {r.failing_rows}" for r in rows if r.status == "fail"]
        if failed:
            raise CheckFailed("; ".join(failed))

    def run(self) -> DataFrame:
        """Build every layer; one row per check."""
        raw = {
            name: self.warehouse.read("raw", table)
            for name, table in (
                ("orders", "raw_oracle_orders"), ("accounts", "raw_salesforce_accounts"),
                ("products", "raw_erp_products"), ("forecast", "raw_adaptive_forecast"),
            )
        }
        self._draft(seed_region=dims.region_seed(self.spark, self.regions))
        self._promote("seed_region")
        plan = Pipeline(
            raw_orders=raw["orders"], raw_accounts=raw["accounts"],
            raw_products=raw["products"], raw_forecast=raw["forecast"],
            regions=self.tables["seed_region"], calendar=dims.calendar_bounds(self.spark, *self.calendar),
        )
        self._staging(plan)
        self._intermediate()
        self._marts(plan)
        return checks.together(self.results)

    def _staging(self, plan: Pipeline) -> None:
        # The list of repeated ids decides how the lines meet it: it is stored to be measured.
        duplicates = settle(plan.duplicates)
        flagged = quality.flag_orders(
            plan.typed, duplicates, filter_bits=quality.filter_bits(duplicates)
        )
        # Flagged lines are stored once; clean lines and rejects are views on them.
        self._draft(
            stg_flagged=flagged, stg_accounts=plan.accounts, stg_products=plan.products,
            stg_forecast=plan.forecast,
        )
        self.tables["stg_orders"] = quality.clean_orders(self.tables["stg_flagged"])
        self.tables["stg_rejects"] = quality.rejected_orders(self.tables["stg_flagged"])
        clean, rejects = self.tables["stg_orders"], self.tables["stg_rejects"]
        self._check(
            ["stg_orders", "stg_rejects", "stg_accounts", "stg_forecast", "stg_products"],
            [
                checks.counted(
                    "partition_complete",
                    checks.partition_complete(plan.raw_orders, clean, rejects),
                ),
                checks.counted(
                    "duplicates_quarantined",
                    checks.duplicates_not_quarantined(plan.typed, clean, rejects),
                ),
            ],
        )
        self._promote("stg_flagged", "stg_accounts", "stg_products", "stg_forecast")
        flagged = ".".join(TABLES["stg_flagged"])
        columns = ", ".join(quality.ORDER_COLUMNS)
        self.tables["stg_orders"] = self.warehouse.view(
            *TABLES["stg_orders"],
            f"SELECT {columns} FROM {flagged} WHERE dq_failure_reason IS NULL",
        )
        self.tables["stg_rejects"] = self.warehouse.view(
            *TABLES["stg_rejects"],
            f"SELECT {columns}, dq_failure_reason FROM {flagged} "
            "WHERE dq_failure_reason IS NOT NULL",
        )

    def _intermediate(self) -> None:
        t = self.tables
        self._draft(
            orders_enriched=enrich.enrich_orders(
                t["stg_orders"], t["stg_accounts"], t["stg_products"]
            )
        )
        enriched = t["orders_enriched"]
        self._draft(monthly_revenue=monthly.monthly_revenue(enriched))
        backdated = [checks.counted("backdated_misjudged", checks.backdated_misjudged(enriched))]
        if self.expected_backdated is not None:
            backdated.append(checks.counted(
                "backdated_count", checks.backdated_count(enriched, self.expected_backdated)
            ))
        self._check(
            ["orders_enriched", "monthly_revenue"],
            [
                checks.counted("margin_without_cost", checks.margin_without_cost(enriched)),
                checks.counted(
                    "wrongly_unmapped",
                    checks.wrongly_unmapped(enriched, t["stg_accounts"]), F.col("n"),
                ),
                checks.counted(
                    "rows_dropped", checks.dropped(t["stg_orders"], enriched), F.col("n")
                ),
                checks.counted(
                    "cancelled_but_delivered", checks.cancelled_but_delivered(enriched)
                ),
                *backdated,
            ],
        )
        self._promote("orders_enriched", "monthly_revenue")

    def _marts(self, plan: Pipeline) -> None:
        t = self.tables
        clean = t["stg_orders"]
        self._draft(
            fct_orders=enrich.fct_orders(t["orders_enriched"]),
            dim_customer=dims.dim_customer(t["stg_accounts"], clean),
            dim_product=dims.dim_product(t["stg_products"], clean),
            reject_summary=quality.reject_summary(t["stg_flagged"]),
            fct_forecast=enrich.fct_forecast(t["stg_forecast"]),
            dim_date=plan.dim_date,
            dim_region=dims.dim_region(t["seed_region"]),
        )
        # The plan's grain is checked before the outer join: a repeated plan key
        # would multiply actuals.
        self._check(["dim_region", "dim_date", "dim_customer", "dim_product", "fct_orders",
                     "fct_forecast", "reject_summary"])
        self._promote("dim_region", "dim_date", "dim_customer", "dim_product", "fct_orders",
                      "fct_forecast", "reject_summary")
        self._draft(mart=mart.plan_vs_actual(t["monthly_revenue"], t["fct_forecast"]))
        amounts = measures.reconciliation_amounts(
            measures.source_lines(plan.raw_orders), t["mart"], t["fct_orders"], t["stg_rejects"]
        )
        self._check(
            ["mart"],
            [
                checks.counted(
                    "reconciles", checks.unreconciled(measures.reconciliation(amounts))
                ),
                checks.counted(
                    "mart.revenue_month parent",
                    checks.without_parent(
                        t["mart"], "revenue_month", t["dim_date"], "date_month"
                    ), F.col("n"),
                ),
                checks.counted(
                    "outer_join_survival",
                    checks.lost_by_outer_join(t["fct_forecast"], t["monthly_revenue"], t["mart"]),
                    F.col("n"),
                ),
            ],
        )
        self._promote("mart")


def build(spark: SparkSession, data_dir: str, **options) -> DataFrame:
    """Land the extracts under ``data_dir``, build and check; one row per check."""
    warehouse = Warehouse(spark)
    land_raw(spark, data_dir, warehouse)
    return Build(spark, warehouse, **options).run()
