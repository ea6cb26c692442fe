"""Landing, the layered build, and reading published tables."""

import os
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

import fixtures
from planlens.operators import checks, measures
from planlens.plans.build import TABLES, Build, CheckFailed, build
from planlens.schemas import METADATA_COLUMNS, RAW_SCHEMAS, SOURCE_TABLES
from planlens.session import folder_bytes, settle, shared_folder, shuffle_partitions
from planlens.sources.landing import Batch, land_raw
from planlens.sources.publish import Warehouse

DOMAINS = {
    **checks.DOMAINS, "plant_countries": ("Norway", "Sweden"),
}
# The hand-written extracts with what the checks rightly refuse taken out.
ACCOUNTS = [row for row in fixtures.ACCOUNTS if row[3]]
PRODUCTS = [row for row in fixtures.PRODUCTS if row[4]]
ORDERS = [row for row in fixtures.ORDERS if row[9] != "Returned"]


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = fixtures.write_extracts(tmp_path_factory.mktemp("extracts"))
    return land_raw(spark, folder, Warehouse(spark)), folder


def test_every_row_lands_as_text_with_metadata(spark, landed):
    counts, _ = landed
    assert counts == {
        "raw_oracle_orders": len(fixtures.ORDERS), "raw_salesforce_accounts": 3,
        "raw_erp_products": 3, "raw_adaptive_forecast": len(fixtures.FORECAST),
    }
    batches = set()
    for file_name, table in SOURCE_TABLES.items():
        df = spark.table(f"raw.{table}")
        assert df.columns == [*RAW_SCHEMAS[table].names, *METADATA_COLUMNS]
        assert {t for c, t in df.dtypes if c != "_loaded_at"} == {"string"}
        assert {r[0] for r in df.select("_source_file").distinct().collect()} == {file_name}
        batches |= {tuple(r) for r in df.select("_batch_id", "_loaded_at").distinct().collect()}
    assert len(batches) == 1


def test_duplicates_blanks_and_quoted_commas_survive_landing(spark, landed):
    orders = spark.table("raw.raw_oracle_orders")
    assert orders.where("order_id = 'D1'").count() == 2
    assert orders.where("order_id = 'E3'").first().unit_price in ("", None)
    assert orders.where("order_id = 'A1'").first().plant_location == "Oslo, Norway"


def test_quotes_and_backslashes_inside_cells(spark, landed, tmp_path):
    name = 'Pump "B", 5\\" wide'
    folder = fixtures.write_extracts(tmp_path, products=[("P1", name, "Tools", "Active", "2.00")])
    land_raw(spark, folder, Warehouse(spark))
    assert spark.table("raw.raw_erp_products").first().product_name == name
    land_raw(spark, landed[1], Warehouse(spark))


def test_landing_replaces(spark, landed, tmp_path):
    folder = fixtures.write_extracts(tmp_path, orders=fixtures.ORDERS[:2])
    counts = land_raw(spark, folder, Warehouse(spark), Batch(batch_id="second"))
    assert counts["raw_oracle_orders"] == 2
    assert spark.table("raw.raw_oracle_orders").count() == 2
    land_raw(spark, landed[1], Warehouse(spark))


def test_a_missing_extract_stops_the_load_before_it_writes(spark, landed, tmp_path):
    folder = fixtures.write_extracts(tmp_path, orders=fixtures.ORDERS[:1])
    (tmp_path / "product_master.csv").unlink()
    with pytest.raises(AnalysisException):
        land_raw(spark, folder, Warehouse(spark))
    assert spark.table("raw.raw_oracle_orders").count() == len(fixtures.ORDERS)


def test_a_foreign_header_is_refused(spark, landed, tmp_path):
    folder = fixtures.write_extracts(tmp_path)
    path = tmp_path / "oracle_orders.csv"
    path.write_text(path.read_text().replace("quantity", "qty", 1))
    with pytest.raises(ValueError, match="oracle_orders.csv"):
        land_raw(spark, folder, Warehouse(spark))
    assert spark.table("raw.raw_oracle_orders").count() == len(fixtures.ORDERS)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = fixtures.write_extracts(
        tmp_path_factory.mktemp("good"), orders=ORDERS, accounts=ACCOUNTS, products=PRODUCTS,
        forecast=[row for row in fixtures.FORECAST],
    )
    return build(spark, folder, domains=DOMAINS, expected_backdated=2)


def test_build_publishes_and_checks_everything(spark, built):
    rows = {r.check_name: r for r in built.collect()}
    assert len(rows) == 81
    assert {r.status for r in rows.values()} <= {"pass", "warn"}
    warned = [name for name, r in rows.items() if r.status == "warn"]
    assert warned == ["stg_orders.plant_country accepted"]
    for layer, table in TABLES.values():
        assert spark.catalog.tableExists(f"{layer}.{table}")
    kinds = {t.name: t.tableType for t in spark.catalog.listTables("staging")}
    assert kinds["stg_oracle__orders"] == "VIEW"


def test_published_mart_is_partitioned_and_readable(spark, built):
    warehouse = Warehouse(spark)
    mart = warehouse.read(*TABLES["mart"])
    assert len(mart.columns) == 17
    worst = warehouse.read(
        *TABLES["mart"], columns=["region", "revenue_variance"], order_by=["revenue_variance"]
    )
    assert worst.first().revenue_variance == measures.worst_variance(mart, 1).first().revenue_variance
    root = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    parts = os.listdir(f"{root}/analytics.db/mart_revenue_performance")
    assert "revenue_month=2025-01-01" in parts


def test_published_tables_answer_plain_sql(spark, built):
    rows = spark.sql(
        "select variance_flag, count(*) as n from analytics.mart_revenue_performance "
        "group by variance_flag"
    ).collect()
    assert {r.variance_flag for r in rows} == {
        "NO_ACTUALS", "BELOW_PLAN", "AT_OR_ABOVE_PLAN", "NO_FORECAST",
    }


def test_a_failed_check_stops_what_depends_on_it(spark, built, tmp_path):
    """A repeated plan key fails in staging, so the mart keeps its old content."""
    before = spark.table("analytics.mart_revenue_performance").count()
    extra = ("F-9", *fixtures.FORECAST[0][1:])
    folder = fixtures.write_extracts(
        tmp_path, orders=ORDERS, accounts=ACCOUNTS, products=PRODUCTS,
        forecast=[*fixtures.FORECAST, extra],
    )
    warehouse = Warehouse(spark)
    land_raw(spark, folder, warehouse)
    with pytest.raises(CheckFailed, match="stg_forecast grain"):
        Build(spark, warehouse, domains=DOMAINS).run()
    assert spark.table("analytics.mart_revenue_performance").count() == before


def test_a_malformed_row_leaves_the_previous_load(spark, landed, tmp_path):
    def contents():
        return {t: sorted(map(repr, spark.table(f"raw.{t}").collect())) for t in SOURCE_TABLES.values()}

    before = contents()
    folder = fixtures.write_extracts(tmp_path, accounts=fixtures.ACCOUNTS[:1])
    with open(tmp_path / "oracle_orders.csv", "a") as handle:
        handle.write("only,three,cells\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        land_raw(spark, folder, Warehouse(spark))
    assert contents() == before
    assert not [t.name for t in spark.catalog.listTables("raw") if t.name.endswith("__next")]


def test_line_breaks_in_cells_are_an_option(spark, landed, tmp_path):
    name = "Pump\nwith a break"
    folder = fixtures.write_extracts(tmp_path, products=[("P1", name, "Tools", "Active", "2.00")])
    land_raw(spark, folder, Warehouse(spark), multi_line=["product_master.csv"])
    assert spark.table("raw.raw_erp_products").first().product_name == name
    land_raw(spark, landed[1], Warehouse(spark))


def test_build_takes_its_regions_and_years(spark, tmp_path):
    regions = [("North", "true"), ("South", "true"), ("UNMAPPED", "false")]
    swap = {"EMEA": "North", "APAC": "South", "LATAM": "South"}
    orders = [(*r[:3], r[3].replace("2025", "2026") if r[0] == "A1" else r[3], *r[4:]) for r in ORDERS]
    folder = fixtures.write_extracts(
        tmp_path, orders=orders, accounts=[(*r[:3], swap[r[3]], *r[4:]) for r in ACCOUNTS],
        products=PRODUCTS,
        forecast=[("F-1", "P1", "North", "2025-01-01", "60.00", "12"), ("F-2", "P1", "South", "2026-12-01", "5.00", "5")],
    )
    domains = {**DOMAINS, "regions": ("North", "South")}
    years = ("2025-01-01", "2027-01-01")
    rows = build(spark, folder, domains=domains, regions=regions, calendar=years).collect()
    assert {r.status for r in rows} <= {"pass", "warn"}
    assert spark.table("analytics.dim_date").count() == 24
    with pytest.raises(CheckFailed, match="mart.revenue_month parent"):
        build(spark, folder, domains=domains, regions=regions, calendar=("2025-01-01", "2026-06-01"))


def test_stored_copies_go_with_the_session(tmp_path):
    """A session of its own, whose query fails, leaves no folder behind."""
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from planlens.session import build_session, settle, shared_folder
spark = build_session(spark__master="local[1]", spark__ui__enabled="false")
spark.sparkContext.setCheckpointDir({str(tmp_path)!r})
assert settle(spark.range(3)).count() == 3
raise SystemExit(3)
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=120)
    assert done.returncode == 3, done.stderr[-2000:]
    for _ in range(50):  # the JVM ends a little after the driver
        left = list(tmp_path.rglob("settled/*"))
        if not left:
            break
        time.sleep(0.2)
    assert not left


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://x:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_settle_uses_the_shared_folder(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "cast(id as decimal(18,2)) as amount")
    kept = settle(df)
    assert kept.schema.simpleString() == df.schema.simpleString()
    assert sorted(r.id for r in kept.collect()) == list(range(10))
    folder = shared_folder(spark).removeprefix("file:")
    assert kept.inputFiles() and all(f"{folder}/settled/" in f for f in kept.inputFiles())


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10 * 1024**4) == 81920
    assert shuffle_partitions(100 * 1024**4) == 819_200


def test_folder_bytes_counts_every_file(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"12345")
    (tmp_path / "y").write_bytes(b"123")
    assert folder_bytes(spark, str(tmp_path)) == 8
