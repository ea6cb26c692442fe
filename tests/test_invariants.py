"""Random dirty extracts against a plain-Python account of the rules."""

import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal as D

import pytest

import fixtures
from planlens.operators import checks, dims, measures
from planlens.plans.pipeline import Pipeline
from planlens.schemas import RAW_SCHEMAS


def dirty_orders(seed, n=400):
    rng = random.Random(seed)
    dates = ["2025-01-10", "2025-01-31", "2025-02-15", "2025-03-01", "", "2025", "bad", "2025-02-30"]
    rows = []
    for i in range(n):
        order_id = rng.choice(["HOT"] * 3 + [""] + [f"X{rng.randrange(n)}"] * 6)
        rows.append((
            order_id, rng.choice(["C1", "C2", "C3", "C9", ""]), rng.choice(["P1", "P2", "P3", "P9"]),
            rng.choice(dates), rng.choice(dates), rng.choice(dates),
            rng.choice(["1", "2", "31", "0", "-4", "", "x", "3.0"]),
            rng.choice(["1.00", "2.50", "99.99", "", "free"]),
            "Oslo, Norway", rng.choice(["Shipped", "Open", "Cancelled"]),
        ))
    return rows


def number(text):
    try:
        return D(text).quantize(D("0.01"), ROUND_HALF_UP) if text else None
    except ArithmeticError:
        return None


def day(text):
    return text if len(text) == 10 and text != "2025-02-30" else None


def expected_reasons(rows):
    copies = Counter(r[0] for r in rows)
    reasons = Counter()
    for row in rows:
        quantity, price = number(row[6]), number(row[7])
        if copies[row[0]] > 1:
            reasons["AMBIGUOUS_DUPLICATE"] += 1
        elif day(row[3]) is None:
            reasons["MISSING_ORDER_DATE"] += 1
        elif price is None:
            reasons["MISSING_UNIT_PRICE"] += 1
        elif quantity is None or quantity <= 0:
            reasons["INVALID_QUANTITY"] += 1
        else:
            reasons[None] += 1
    return reasons


@pytest.mark.parametrize("seed", [1, 2])
def test_dirty_extracts_partition_and_reconcile(spark, seed):
    rows = dirty_orders(seed)
    raw = fixtures.frames(spark)
    p = Pipeline(
        raw_orders=spark.createDataFrame(rows, RAW_SCHEMAS["raw_oracle_orders"]),
        raw_accounts=raw["raw_salesforce_accounts"], raw_products=raw["raw_erp_products"],
        raw_forecast=raw["raw_adaptive_forecast"], regions=dims.region_seed(spark),
        calendar=dims.calendar_bounds(spark), settled=True,
    )
    got = {r.dq_failure_reason: r["count"] for r in
           p.flagged.groupBy("dq_failure_reason").count().collect()}
    assert got == dict(expected_reasons(rows))
    assert checks.partition_complete(p.raw_orders, p.orders, p.rejects).count() == 0

    source = sum(
        (q * price for q, price in ((number(r[6]), number(r[7])) for r in rows)
         if q is not None and price is not None), D(0),
    )
    amounts = measures.reconciliation_amounts(
        measures.source_lines(p.raw_orders), p.mart, p.fct_orders, p.rejects
    )
    row = measures.reconciliation(amounts).first()
    assert row.source == source and row.unexplained == 0
