"""Every layer of the model, wired lazily from the four landed tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planlens.operators import conform, dims, enrich, mart, measures, monthly, quality
from planlens.session import settle


class Pipeline:
    """Layers as DataFrames. Nothing runs until an action.

    ``settled`` stores the flagged and the enriched lines and the monthly rollup when they
    are first asked for, for plans that read them from several branches; or only those of
    them that it names.
    """

    settled: bool | tuple[str, ...] = False

    def __init__(
        self,
        *,
        raw_orders: DataFrame,
        raw_accounts: DataFrame,
        raw_products: DataFrame,
        raw_forecast: DataFrame,
        regions: DataFrame,
        calendar: DataFrame,
        settled: bool | tuple[str, ...] = False,
    ) -> None:
        self.raw_orders = raw_orders
        self.raw_accounts = raw_accounts
        self.raw_products = raw_products
        self.raw_forecast = raw_forecast
        self.regions = regions
        self.calendar = calendar
        self.settled = settled

    def _kept(self, df: DataFrame, layer: str) -> DataFrame:
        named = self.settled if isinstance(self.settled, bool) else layer in self.settled
        return settle(df) if named else df

    @cached_property
    def accounts(self) -> DataFrame:
        return conform.stage_accounts(self.raw_accounts)

    @cached_property
    def products(self) -> DataFrame:
        return conform.stage_products(self.raw_products)

    @cached_property
    def forecast(self) -> DataFrame:
        return conform.stage_forecast(self.raw_forecast)

    @cached_property
    def typed(self) -> DataFrame:
        return conform.type_orders(self.raw_orders)

    @cached_property
    def duplicates(self) -> DataFrame:
        return quality.duplicate_ids(self.typed)

    @property
    def _filter_bits(self) -> int | None:
        """Size of the filter of ``duplicates``, for a stored list too long to broadcast."""
        return None

    def _flag(self, typed: DataFrame) -> DataFrame:
        duplicates = self.duplicates
        return quality.flag_orders(typed, duplicates, filter_bits=self._filter_bits)

    @cached_property
    def flagged(self) -> DataFrame:
        return self._kept(self._flag(self.typed), "flagged")

    @cached_property
    def orders(self) -> DataFrame:
        return quality.clean_orders(self.flagged)

    @cached_property
    def rejects(self) -> DataFrame:
        return quality.rejected_orders(self.flagged)

    @cached_property
    def enriched(self) -> DataFrame:
        return self._kept(
            enrich.enrich_orders(self.orders, self.accounts, self.products), "enriched"
        )

    @cached_property
    def monthly(self) -> DataFrame:
        return self._kept(monthly.monthly_revenue(self.enriched), "monthly")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self.accounts, self.orders)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.products, self.orders)

    @cached_property
    def dim_region(self) -> DataFrame:
        return dims.dim_region(self.regions)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.calendar)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return enrich.fct_orders(self.enriched)

    @cached_property
    def fct_forecast(self) -> DataFrame:
        return enrich.fct_forecast(self.forecast)

    @cached_property
    def cells(self) -> DataFrame:
        return mart.plan_cells(self.monthly, self.fct_forecast)

    @cached_property
    def mart(self) -> DataFrame:
        return mart.plan_vs_actual(self.monthly, self.fct_forecast)

    def mart_of(self, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """The mart of what ``keep(rows, month column)`` leaves of actuals and plan.

        The outer join merges its keys, so a filter on them above it would reach neither
        side; before it, it reaches both scans.
        """
        return mart.plan_vs_actual(
            keep(self.monthly, "revenue_month"), keep(self.fct_forecast, "forecast_month")
        )

    def reconciliation_totals(
        self, recognised: dict[str, Column] | None = None, **readings: Column
    ) -> DataFrame:
        """Source, buckets and mart in one row. The raw text is read once for its lines (and
        its ids for the repeated ones); the flagged lines are stored, the only copy, and read
        by the two passes that are summed.

        ``readings`` are other quantity texts, each with a source total of its own.
        """
        sources = {
            name: measures.source_revenue(F.col("unit_price"), quantity)
            for name, quantity in {"source": F.col("quantity"), **readings}.items()
        }
        typed = conform.type_orders(self.raw_orders, **sources)
        lines = settle(self._flag(typed))
        enriched = enrich.enrich_orders(
            quality.clean_orders(lines), self.accounts, self.products
        )
        cells = monthly.monthly_revenue(enriched, **measures.unrecognised_sums())
        return measures.reconciliation_totals(
            lines, mart.plan_vs_actual(cells, self.fct_forecast),
            sources=[*sources], recognised=recognised,
        )

    @cached_property
    def reject_summary(self) -> DataFrame:
        return quality.reject_summary(self.flagged)
