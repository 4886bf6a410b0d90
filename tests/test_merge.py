"""The set-based upsert against row-by-row upserts, run one statement per row."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from creditflow.operators import merge, outbox
from creditflow.plans import inputs
from oracle_check import rows_of

TYPES = {"string": "VARCHAR", "integer": "INTEGER", "long": "BIGINT", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


def one_by_one(spec: merge.MergeSpec, target: list, batch: list) -> list[tuple]:
    con = duckdb.connect()
    names = spec.table.fieldNames()
    columns = ", ".join(
        f"{f.name} {TYPES[f.dataType.typeName()]}" + (" PRIMARY KEY" if f.name == spec.key else "")
        for f in spec.table
    )
    con.execute(f"CREATE TABLE t ({columns})")
    marks = ", ".join("?" for _ in names)
    con.executemany(f"INSERT INTO t VALUES ({marks})", [tuple(r) for r in target])
    sets = [f"{c} = EXCLUDED.{c}" for c in spec.refresh]
    sets += [f"{c} = {v}" for c, v in spec.reset.items()]
    upsert = f"INSERT INTO t VALUES ({marks}) ON CONFLICT ({spec.key}) DO UPDATE SET "
    for row in batch:
        con.execute(upsert + ", ".join(sets), list(row))
    return con.execute(f"SELECT {', '.join(names)} FROM t").fetchall()


CASES = [
    (merge.INCOME, "income_sent", "income"),
    (merge.NPL_FROM_INCOME, "npl_income", "npl_income"),
    (merge.NPL_FROM_REQUEST, "npl_request", "npl_request"),
    (merge.LOAN, "loan_sent", "loan"),
]


@pytest.mark.parametrize("spec, held, new", CASES, ids=[c[0].name for c in CASES])
def test_upsert_equals_row_by_row(spark, data, spec, held, new):
    """Keys in the table, keys new to it, and both kinds repeated within the batch."""
    names = spec.table.fieldNames()
    low = F.substring_index("request_id", "-", -1).cast("int") < 120
    target = getattr(inputs.processed_flow(spark, data), held).filter(low).select(names)
    batch = getattr(inputs.reissue_flow(spark, data), new).filter(low).select(names)
    order = inputs.REISSUE_ORDER
    got = merge.upsert(target, batch, spec, order)
    arrivals = batch.orderBy("request_id", *order).collect()
    assert len(arrivals) > len({r.request_id for r in arrivals})
    expected = one_by_one(spec, target.collect(), arrivals)
    assert rows_of(names, got.collect()) == rows_of(names, expected)


def test_new_key_twice_in_a_batch(spark):
    """Kept columns from the first row, refreshed ones from the last, resets at once."""
    spec = merge.INCOME

    def row(key, income, consumed, sent, customer):
        return (key, "a", customer, 0, 1, 1, 1, "batch", True, "s", income, consumed, sent, None)

    target = spark.createDataFrame([row("old", 1.0, 10, True, 1)], spec.table)
    batch = spark.createDataFrame(
        [row("new", 2.0, 21, True, 2), row("new", 3.0, 22, True, 3), row("once", 4.0, 23, True, 4),
         row("old", 5.0, 24, True, 5)],
        spec.table,
    )
    got = {
        r.request_id: (r.predicted_income, r.e1_consumed_at, r.sent_to_npl, r.customer_id)
        for r in merge.upsert(target, batch, spec, ["e1_consumed_at"]).collect()
    }
    assert got == {
        "new": (3.0, 22, False, 2),
        "once": (4.0, 23, True, 4),
        "old": (5.0, 24, False, 1),
    }


def test_hot_key_is_reduced_before_the_shuffle(spark, data):
    batch = inputs.reissue_flow(spark, data).income
    plan = merge.fold(batch, merge.INCOME, inputs.REISSUE_ORDER)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in text and "partial_max_by" in text


def test_metrics_merge_overwrites_by_window(spark):
    spec = merge.METRICS
    old = spark.createDataFrame([(0, 10, 1, 5, 1, 0, 1.0, 1.0, 1.0, 0.1, 0, 1.0)], spec.table)
    new = spark.createDataFrame(
        [(0, 10, 1, 9, 2, 0, 1.0, 3.0, 1.5, 0.2, 0, 1.0),
         (10, 20, 11, 12, 0, 1, 0.0, 0.0, 0.0, 0.9, 1, 2.0)],
        spec.table,
    )
    got = merge.upsert(old, new, spec, ["window_end"]).orderBy("bucket_start").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in new.collect()]


def test_mark_touches_only_sent_rows(spark, data):
    flow = inputs.order_flow(spark, data)
    table = flow.loan
    some = outbox.hand_over(table.filter("loan_decision"), outbox.DISBURSEMENT, F.lit(0))
    marked = outbox.mark_sent(table, some, outbox.DISBURSEMENT)
    assert marked.filter("sent_to_ldis <> loan_decision").count() == 0
    assert marked.filter("NOT loan_decision AND e6_produced_at IS NOT NULL").count() == 0
    assert marked.filter("loan_decision AND e5_produced_at <> e6_produced_at").count() == 0
    assert marked.count() == table.count()
