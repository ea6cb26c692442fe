"""The model over the star-schema test tables.

Those tables have neither the extract shape nor its defects, so this derives
both by fixed rules on their keys. Everything comes out as text, as an extract
would, and grows with the tables.
"""

from __future__ import annotations

import zlib
from datetime import datetime
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planlens.functions import casts, rules
from planlens.operators import joins, monthly, observe, quality
from planlens.plans.pipeline import Pipeline
from planlens.schemas import RAW_SCHEMAS, SOURCE_TABLES
from planlens.session import delete_on_exit, shared_folder
from planlens.sources.landing import Batch, land_raw, read_extract, stamp_metadata
from planlens.sources.publish import Warehouse
from planlens.sources.run_artifacts import read_run_artifacts

AS_OF = "2024-01-31 00:00:00"
BATCH_ID = "batch-0001"
COMMITTED_LOADS = {"batch-0001": "2024-01-28T22:10:00+00:00", "batch-0002": "2024-01-29T21:40:00+00:00"}
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


# The columns used, so that opening a table needs no job to read its footers.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
}

_RAW = {
    "raw_oracle_orders": "raw_orders",
    "raw_salesforce_accounts": "raw_accounts",
    "raw_adaptive_forecast": "raw_forecast",
    "raw_erp_products": "raw_products",
}

# Results that a build stores, and that are bounded by the cells or by the repeated ids.
_STORED = {
    "duplicate_ids": "_id_key string, n bigint",
    "monthly_revenue": "product_id string, region string, revenue_month date, "
                       "actual_revenue decimal(18,2), actual_quantity bigint, "
                       "actual_margin decimal(18,2), order_count bigint, on_time_count bigint, "
                       "late_count bigint, cancelled_count bigint, orders_with_known_cost bigint",
}

# Rows of the stored lists of repeated ids, by path.
_COUNTS: dict[str, int] = {}

# Paths landed by this process. The checkpoint folder is new in every session.
_LANDED: set[str] = set()


def _every(column: str, modulus: int, remainder: int = 0) -> Column:
    return F.col(column) % modulus == remainder


class SampleModel(Pipeline):
    """A ``Pipeline`` whose raw layer is derived from ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str, settled: bool | tuple[str, ...] = False) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.settled = settled

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def _land(self, name: str, derive: Callable[[], DataFrame]) -> DataFrame:
        """Land a derived extract once per session, as loading would, and read it back."""
        path = f"{shared_folder(self.spark)}/landed/{zlib.crc32(self.sf_dir.encode())}/{name}"
        if path not in _LANDED:
            derive().write.mode("overwrite").parquet(path)
            delete_on_exit(self.spark, path)
            _LANDED.add(path)
        return self.spark.read.schema(RAW_SCHEMAS.get(name) or _STORED[name]).parquet(path)

    @cached_property
    def duplicates(self) -> DataFrame:
        """Stored once per session, as a build does: the ids are counted in one shuffle."""
        return self._land("duplicate_ids", lambda: quality.duplicate_ids(self.typed))

    @property
    def _filter_bits(self) -> int | None:
        key = f"{shared_folder(self.spark)}/landed/{zlib.crc32(self.sf_dir.encode())}/duplicate_ids"
        if key not in _COUNTS:
            _COUNTS[key] = self.duplicates.count()
        return quality.filter_bits(self.duplicates, _COUNTS[key])

    @cached_property
    def monthly(self) -> DataFrame:
        """Stored once per session: the plan is derived from it, and the actuals are it."""
        return self._land("monthly_revenue", lambda: monthly.monthly_revenue(self.enriched))

    @cached_property
    def places(self) -> DataFrame:
        """Nation with its region name: 25 rows."""
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self._land("raw_oracle_orders", self._derive_orders)

    def _derive_orders(self) -> DataFrame:
        headers = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            "o_custkey",
            "o_orderstatus",
            F.col("o_orderdate").cast("date").alias("o_orderdate"),
        )
        brands = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        plants = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        places = self.places.select(
            F.col("n_nationkey").alias("s_nationkey"),
            F.concat("n_name", F.lit(", "), "r_name").alias("plant_location"),
        )
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            F.round("l_quantity").cast("bigint").alias("pieces"),
            F.col("l_extendedprice").cast(casts.MONEY).alias("price"),
            F.col("l_shipdate").cast("date").alias("l_shipdate"),
        )
        # All three grow with the lines, so these joins are shuffles at every size. The lines
        # are narrow while they move: headers come last, names of places after them. Keys are
        # unique, so a partition's share of them is a small table and the lines need no sort.
        lines = joins.lookups(lines, {
            "l_suppkey": plants.hint("shuffle_hash"),
            "l_partkey": brands.hint("shuffle_hash"),
            "l_orderkey": headers.hint("shuffle_hash"),
            "s_nationkey": places,
        })

        short_id = F.concat(
            F.when(_every("l_orderkey", 10, 9), "ORD9-").otherwise("ORD0-"),
            F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
        )
        full_id = F.concat_ws(
            "-", short_id, F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
        )
        status = (
            F.when(F.col("o_orderstatus") == "F", "Shipped")
            .when(F.col("o_orderstatus") == "O", "Open")
            .when(F.col("o_orderstatus") == "P", "Cancelled")
        )
        undelivered = (F.col("o_orderstatus") == "O") & _every("l_linenumber", 2)
        quantity = F.when(_every("l_orderkey", 227), -F.col("pieces")).when(
            _every("l_orderkey", 229), F.lit(0).cast("bigint")
        ).otherwise(F.col("pieces"))
        return lines.select(
            F.when(_every("l_orderkey", 50), short_id).otherwise(full_id).alias("order_id"),
            F.concat(F.lit("CUST"), F.col("o_custkey").cast("string")).alias("customer_id"),
            F.col("p_brand").alias("product_id"),
            F.when(_every("l_orderkey", 211), "").otherwise(F.col("o_orderdate").cast("string"))
            .alias("order_date"),
            F.date_add("o_orderdate", 730).cast("string").alias("promised_delivery_date"),
            F.when(undelivered, "").otherwise(F.col("l_shipdate").cast("string"))
            .alias("actual_delivery_date"),
            quantity.cast("string").alias("quantity"),
            F.when(_every("l_orderkey", 223), "")
            .otherwise(F.col("price").cast("string"))
            .alias("unit_price"),
            "plant_location",
            status.alias("order_status"),
        )

    @cached_property
    def raw_accounts(self) -> DataFrame:
        return self._land("raw_salesforce_accounts", self._derive_accounts)

    def _derive_accounts(self) -> DataFrame:
        return (
            self.table("customer")
            .where(~_every("c_custkey", 97))
            .join(self.places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.concat(F.lit("SF-"), F.col("c_custkey").cast("string")).alias("account_id"),
                F.concat(F.lit("CUST"), F.col("c_custkey").cast("string")).alias("customer_id"),
                F.col("c_name").alias("account_name"),
                F.col("r_name").alias("region"),
                F.col("n_name").alias("account_owner"),
                F.col("c_mktsegment").alias("segment"),
                F.when(F.col("c_acctbal") >= 0, "TRUE").otherwise("FALSE").alias("active_flag"),
            )
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        return self._land("raw_erp_products", self._derive_products)

    def _derive_products(self) -> DataFrame:
        """One product per brand, described by its first part; 'Brand#13' is left out."""
        lifecycle = F.element_at(
            F.array(F.lit("Active"), F.lit("Discontinued"), F.lit("Pending")),
            F.min_by("p_size", "p_partkey") % 3 + 1,
        )
        return (
            self.table("part")
            .where(F.col("p_brand") != "Brand#13")
            .groupBy(F.col("p_brand").alias("product_id"))
            .agg(
                F.min_by("p_name", "p_partkey").alias("product_name"),
                F.min_by("p_type", "p_partkey").alias("product_family"),
                lifecycle.alias("lifecycle_status"),
                F.min("p_retailprice").cast(casts.MONEY).cast("string").alias("standard_cost"),
            )
        )

    @cached_property
    def raw_forecast(self) -> DataFrame:
        return self._land("raw_adaptive_forecast", self._derive_forecast)

    def _derive_forecast(self) -> DataFrame:
        """Plan: last year's recognised revenue plus 5 percent, a year on."""
        cell = (F.col("region") != rules.UNMAPPED) & (F.col("orders_with_known_cost") > 0)
        month = F.add_months("revenue_month", 12).cast("string")
        uplift = F.lit("1.05").cast("decimal(3,2)")
        return self.monthly.where(cell).select(
            F.concat_ws("-", "product_id", "region", month).alias("forecast_id"),
            "product_id",
            "region",
            month.alias("forecast_month"),
            casts.money(F.col("actual_revenue") * uplift).cast("string").alias("forecast_revenue"),
            F.round(F.col("actual_quantity") * uplift, 0).cast("bigint").cast("string")
            .alias("forecast_quantity"),
        )

    @cached_property
    def regions(self) -> DataFrame:
        listed = self.table("region").select(
            F.col("r_name").alias("region_name"), F.lit("true").alias("is_forecastable")
        )
        unmapped = self.spark.range(1).select(
            F.lit(rules.UNMAPPED).alias("region_name"), F.lit("false").alias("is_forecastable")
        )
        return listed.unionByName(unmapped)

    @cached_property
    def calendar(self) -> DataFrame:
        """Whole years from the first order to a year past the last, for the plan."""
        return self.table("orders").agg(
            F.trunc(F.min("o_orderdate"), "year").alias("start"),
            F.add_months(F.trunc(F.max("o_orderdate"), "year"), 24).alias("end"),
        )

    @cached_property
    def load_log(self) -> DataFrame:
        """Load metadata of the four landed tables, aged by row key."""

        def stamped(source: str, key: str, least: int, spread: int) -> DataFrame:
            age = F.make_dt_interval(
                F.lit(0), F.lit(least) + F.col(key) % spread, F.col(key) % 60
            )
            return self.table(source).select(
                (F.lit(AS_OF).cast("timestamp") - age).alias("_loaded_at"),
                F.concat(F.lit("load-"), (F.col(key) % spread).cast("string")).alias("_batch_id"),
            )

        return observe.load_log({
            "raw_oracle_orders": stamped("lineitem", "l_orderkey", 10, 90),
            "raw_salesforce_accounts": stamped("customer", "c_custkey", 35, 40),
            "raw_adaptive_forecast": stamped("orders", "o_orderkey", 47, 5),
            "raw_erp_products": stamped("part", "p_partkey", 60, 7),
        })

    @cached_property
    def job_history(self) -> DataFrame:
        failed = F.col("event_type") == "error"
        return self.table("events").select(
            F.col("event_id").alias("query_id"),
            F.col("event_type").alias("query_type"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
            F.lit("TRANSFORMER").alias("role_name"),
            F.when(_every("user_id", 3), "OTHER").otherwise("SHOP").alias("database_name"),
            F.concat(F.lit("WH_"), (F.col("user_id") % 10).cast("string")).alias("warehouse_name"),
            F.when(failed, "FAIL").otherwise("SUCCESS").alias("execution_status"),
            F.when(failed, F.col("user_id")).alias("error_code"),
            F.when(failed, F.col("props")).alias("error_message"),
            F.col("ts").alias("start_time"),
            F.round(F.col("value").cast(casts.MONEY) * 100, 0).cast("bigint")
            .alias("total_elapsed_time"),
        )

    @cached_property
    def compute_usage(self) -> DataFrame:
        credits = F.col("value").cast(casts.RATIO)
        none = F.lit(0).cast(casts.RATIO)
        failed = F.col("event_type") == "error"
        return self.table("events").select(
            F.concat(F.lit("WH_"), (F.col("user_id") % 10).cast("string")).alias("warehouse_name"),
            F.col("ts").alias("start_time"),
            credits.alias("credits_used"),
            F.when(failed, none).otherwise(credits).alias("credits_used_compute"),
            F.when(failed, credits).otherwise(none).alias("credits_used_cloud_services"),
        )

    @cached_property
    def run_documents(self) -> DataFrame:
        """Run artifacts as JSON text, one per event: a model and its test."""
        failed = F.col("event_type") == "error"
        model = F.struct(
            F.concat(F.lit("model.shop."), "event_type", F.lit("_"), F.col("user_id").cast("string"))
            .alias("unique_id"),
            F.when(failed, "error").otherwise("success").alias("status"),
            F.col("value").alias("execution_time"),
        )
        test = F.struct(
            F.concat(F.lit("test.shop.check_"), "event_type").alias("unique_id"),
            F.when(_every("event_id", 7), "fail").otherwise("pass").alias("status"),
            F.lit(0.5).alias("execution_time"),
        )
        return self.table("events").select(
            F.to_json(F.struct(
                F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("generated_at"))
                .alias("metadata"),
                F.col("value").alias("elapsed_time"),
                F.array(model, test).alias("results"),
            )).alias("document")
        )

    @cached_property
    def run_artifacts(self) -> DataFrame:
        """The artifacts read from files, as a run leaves them: a folder per kind of event, an
        artifact per line, and one line that is none."""
        folder = f"{shared_folder(self.spark)}/artifacts/{zlib.crc32(self.sf_dir.encode())}"
        if folder not in _LANDED:
            broken = self.spark.range(1).select(F.lit('{"metadata": ').alias("document"))
            kind = F.get_json_object("document", "$.results[1].unique_id")
            lines = self.run_documents.unionByName(broken).select(
                "document", F.coalesce(F.substring_index(kind, "_", -1), F.lit("none")).alias("kind")
            )
            lines.hint("rebalance", "kind").write.mode("overwrite").partitionBy("kind").text(folder)
            delete_on_exit(self.spark, folder)
            _LANDED.add(folder)
        return read_run_artifacts(self.spark, folder, multi_line=False)

    @cached_property
    def table_stats(self) -> DataFrame:
        """The landed tables, whole rows; one more that was dropped and one of another
        catalog."""
        altered = F.lit(AS_OF).cast("date")
        raw = {("RAW", name): df for name, df in self.raw_tables.items()}
        listed = observe.table_stats(raw, catalog="SHOP", altered=altered)
        dropped = observe.table_stats(
            {("RAW", "old_accounts"): self.raw_accounts}, catalog="SHOP", altered=altered
        ).withColumn("deleted", altered)
        foreign = observe.table_stats(
            {("RAW", "accounts"): self.raw_accounts}, catalog="OTHER", altered=altered
        )
        return listed.unionByName(dropped).unionByName(foreign)

    @property
    def raw_tables(self) -> dict[str, DataFrame]:
        return {table: getattr(self, layer) for table, layer in _RAW.items()}

    def extract_folder(self, *file_names: str) -> str:
        """The folder of the extracts, with at least those named in it: CSV as a source would send
        it, a folder of compressed files each. One alone is written as it is derived; several
        from the landed tables, which the plan needs anyway."""
        folder = f"{shared_folder(self.spark)}/extracts/{zlib.crc32(self.sf_dir.encode())}"
        for file_name in file_names:
            path = f"{folder}/{file_name}"
            if path not in _LANDED:
                layer = _RAW[SOURCE_TABLES[file_name]]
                alone = len(file_names) == 1
                rows = getattr(self, f"_derive_{layer[4:]}")() if alone else getattr(self, layer)
                rows.write.mode("overwrite").csv(path, header=True, escape='"', compression="gzip")
                delete_on_exit(self.spark, path)
                _LANDED.add(path)
        return folder

    def landed_extract(self, file_name: str) -> DataFrame:
        """An extract read and stamped as a load does; the source file is the folder's name."""
        rows = read_extract(self.spark, self.extract_folder(file_name), file_name)
        source = F.element_at(F.split("_metadata.file_path", "/"), -2)
        return stamp_metadata(
            rows.select("*", source.alias("_source")),
            loaded_at=F.lit(AS_OF).cast("timestamp"), source_file=F.col("_source"),
            batch_id=F.lit(BATCH_ID),
        ).drop("_source")

    @cached_property
    def commit_log(self) -> DataFrame:
        """The warehouse's log after the extracts were landed twice, into a layer of their own."""
        number = zlib.crc32(self.sf_dir.encode())
        layer, folder = f"landed_{number}", f"{shared_folder(self.spark)}/landed/{number}"
        warehouse = Warehouse(self.spark, {layer: folder})
        if folder not in _LANDED:
            delete_on_exit(self.spark, folder)
            for batch, loaded_at in COMMITTED_LOADS.items():
                landing = Batch(batch_id=batch, loaded_at=datetime.fromisoformat(loaded_at))
                land_raw(self.spark, self.extract_folder(*SOURCE_TABLES), warehouse, landing, layer=layer)
            _LANDED.add(folder)
        return warehouse.load_log(layer)

    @cached_property
    def entitlements(self) -> DataFrame:
        """User-to-region mapping: one manager per nation."""
        return self.places.select(
            F.concat(F.lower("n_name"), F.lit("@example.com")).alias("user"),
            F.col("r_name").alias("region"),
        )
