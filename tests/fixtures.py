"""Hand-written extracts: every row is here for one branch of one rule."""

from __future__ import annotations

from planlens.operators import dims
from planlens.plans.pipeline import Pipeline
from planlens.schemas import RAW_SCHEMAS

# order_id, customer, product, ordered, promised, delivered, quantity, price, plant, status
ORDERS = [
    ("A1", "C1", "P1", "2025-01-10", "2025-01-20", "2025-01-18", "10", "5.00", "Oslo, Norway", "Shipped"),
    ("A2", "C1", "P1", "2025-01-11", "2025-01-20", "2025-01-20", "2", "7.50", "Oslo, Norway", "Shipped"),
    ("A3", "C2", "P1", "2025-01-12", "2025-01-20", "2025-01-21", "3", "4.00", "Oslo, Norway", "Shipped"),
    # delivered without a promise: late
    ("A4", "C2", "P2", "2025-02-01", "", "2025-02-05", "1", "100.00", "Lyon", "Shipped"),
    # delivered before it was ordered
    ("A5", "C2", "P2", "2025-02-10", "2025-02-20", "2025-02-09", "1", "50.00", "Oslo, Norway", "Shipped"),
    # cancelled and backdated and dated: cancelled wins
    ("A6", "C1", "P2", "2025-02-10", "2025-02-20", "2025-02-01", "4", "25.00", "Oslo, Norway", "Cancelled"),
    ("A7", "C1", "P2", "2025-02-10", "2025-02-20", "", "4", "25.00", "Oslo, Norway", "Open"),
    # no such customer, no such product
    ("ORD9-1", "C9", "P1", "2025-01-15", "2025-01-25", "2025-01-24", "6", "5.00", "Oslo, Norway", "Shipped"),
    ("ORD9-2", "C1", "P9", "2025-01-15", "2025-01-25", "2025-01-24", "2", "30.00", "Oslo, Norway", "Shipped"),
    # a known product whose cost is not known; a known account without a region
    ("A8", "C1", "P3", "2025-03-01", "2025-03-09", "2025-03-08", "2", "9.00", "Oslo, Norway", "Shipped"),
    ("A9", "C3", "P1", "2025-03-01", "2025-03-09", "2025-03-08", "1", "9.00", "Oslo, Norway", "Shipped"),
    # outside the status vocabulary
    ("B1", "C1", "P1", "2025-03-02", "2025-03-09", "2025-03-08", "1", "11.00", "Oslo, Norway", "Returned"),
    # spaces around everything; a date with a time, a quantity with decimals
    (" B2 ", " C1 ", " P1 ", " 2025-03-03 ", "2025/03/09", "2025-03-08 10:00:00", " 31.0 ", " 2.00 ", " Oslo ,  Norway ", " Shipped "),
    ("B3", "C1", "P1", "2025-03-04", "2025-03-09", "2025-03-08", "1e2", "1.005", "Oslo, Norway", "Shipped"),
    # one id on two lines, then on three with gaps: the duplicate outranks the gaps
    ("D1", "C1", "P1", "2025-01-10", "2025-01-20", "2025-01-18", "10", "5.00", "Oslo, Norway", "Shipped"),
    ("D1", "C1", "P1", "2025-01-10", "2025-01-20", "2025-01-18", "99", "5.00", "Oslo, Norway", "Shipped"),
    ("D2", "C1", "P1", "", "", "", "", "", "", "Shipped"),
    ("D2", "C1", "P1", "2025-01-10", "", "", "1", "1.00", "", "Open"),
    ("D2", "C1", "P1", "2025-01-10", "", "", "-1", "1.00", "", "Open"),
    # two lines without an id are duplicates of each other
    ("", "C1", "P1", "2025-01-10", "2025-01-20", "2025-01-18", "1", "5.00", "Oslo, Norway", "Shipped"),
    ("  ", "C1", "P1", "2025-01-10", "2025-01-20", "2025-01-18", "2", "5.00", "Oslo, Norway", "Shipped"),
    # single defects, and two at once: date before price before quantity
    ("E1", "C1", "P1", "", "2025-01-20", "2025-01-18", "10", "5.00", "Oslo, Norway", "Shipped"),
    ("E2", "C1", "P1", "2025", "2025-01-20", "2025-01-18", "10", "5.00", "Oslo, Norway", "Shipped"),
    ("E3", "C1", "P1", "2025-02-30", "2025-01-20", "2025-01-18", "10", "", "Oslo, Norway", "Shipped"),
    ("E4", "C1", "P1", "2025-01-10", "2025-01-20", "2025-01-18", "0", "n/a", "Oslo, Norway", "Shipped"),
    ("E5", "C1", "P1", "2025-01-10", "2025-01-20", "2025-01-18", "-15", "5.00", "Oslo, Norway", "Shipped"),
    ("E6", "C1", "P1", "2025-01-10", "2025-01-20", "2025-01-18", "0", "5.00", "Oslo, Norway", "Shipped"),
    ("E7", "C1", "P1", "2025-01-10", "2025-01-20", "2025-01-18", "abc", "5.00", "Oslo, Norway", "Shipped"),
    # cells that only ever see cancelled orders, against a plan and against none
    ("F1", "C2", "P1", "2025-04-02", "2025-04-09", "2025-04-08", "5", "10.00", "Oslo, Norway", "Cancelled"),
    ("F2", "C2", "P2", "2025-04-02", "2025-04-09", "2025-04-08", "5", "10.00", "Oslo, Norway", "Cancelled"),
]

ACCOUNTS = [
    ("S1", "C1", "North Clinic", "EMEA", "Ada", "SMB", "TRUE"),
    ("S2", "C2", "South Clinic", "APAC", "Bob", "Enterprise", " true "),
    ("S3", "C3", "Lost Clinic", "", "Cid", "SMB", "FALSE"),
]

PRODUCTS = [
    ("P1", "Widget", "Tools", "Active", "2.00"),
    ("P2", "Gadget", "Toys", "Discontinued", "60.00"),
    ("P3", "Gizmo", "Toys", "Pending", ""),
]

FORECAST = [
    ("F-1", "P1", "EMEA", "2025-01-01", "60.00", "12"),     # actual 65.00
    ("F-2", "P1", "APAC", "2025-01-01", "500.00", "50"),    # actual 12.00
    ("F-3", "P1", "LATAM", "2025-01-01", "70.00", "7"),     # no orders
    ("F-4", "P1", "APAC", "2025-04-01", "10.00", "1"),      # all cancelled
    ("F-5", "P2", "APAC", "2025-04-01", "0.00", "0"),       # all cancelled, zero plan
    ("F-6", "P2", "EMEA", "2025-02-01", "0.00", "0"),       # zero plan, nothing recognised
    ("F-7", "P2", "LATAM", "2025-05-01", "0.00", "0"),      # zero plan, no orders
]

REASONS = {
    "D1": "AMBIGUOUS_DUPLICATE", "D2": "AMBIGUOUS_DUPLICATE", None: "AMBIGUOUS_DUPLICATE",
    "E1": "MISSING_ORDER_DATE", "E2": "MISSING_ORDER_DATE", "E3": "MISSING_ORDER_DATE",
    "E4": "MISSING_UNIT_PRICE",
    "E5": "INVALID_QUANTITY", "E6": "INVALID_QUANTITY", "E7": "INVALID_QUANTITY",
}


def frames(spark):
    rows = {
        "raw_oracle_orders": ORDERS, "raw_salesforce_accounts": ACCOUNTS,
        "raw_erp_products": PRODUCTS, "raw_adaptive_forecast": FORECAST,
    }
    return {name: spark.createDataFrame(data, RAW_SCHEMAS[name]) for name, data in rows.items()}


def sample_pipeline(spark):
    raw = frames(spark)
    return Pipeline(
        raw_orders=raw["raw_oracle_orders"],
        raw_accounts=raw["raw_salesforce_accounts"],
        raw_products=raw["raw_erp_products"],
        raw_forecast=raw["raw_adaptive_forecast"],
        regions=dims.region_seed(spark),
        calendar=dims.calendar_bounds(spark),
    )


def write_extracts(folder, orders=ORDERS, accounts=ACCOUNTS, products=PRODUCTS, forecast=FORECAST):
    """The extracts as CSV files, quoted where a cell holds a comma."""
    import csv

    from planlens.schemas import SOURCE_TABLES

    rows = {
        "raw_oracle_orders": orders, "raw_salesforce_accounts": accounts,
        "raw_erp_products": products, "raw_adaptive_forecast": forecast,
    }
    for file_name, table in SOURCE_TABLES.items():
        with open(folder / file_name, "w", newline="") as handle:
            writer = csv.writer(handle)
            writer.writerow(RAW_SCHEMAS[table].names)
            writer.writerows(rows[table])
    return str(folder)
