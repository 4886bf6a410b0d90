"""The physical plans that the operators rely on at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from creditflow import session
from creditflow.operators import outbox
from creditflow.plans import catalog, inputs

QUERIES = catalog.registered()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, data, name):
    """Batch queries stay inside the engine and never pair all rows."""
    text = plan(QUERIES[name](spark, data))
    assert not re.search(r"Python|Arrow|Pandas", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


def shuffles(text: str) -> list[str]:
    """Every exchange that moves rows between tasks, but for broadcasts."""
    return re.findall(r"(?<!Broadcast)Exchange (?:hash|range|RoundRobin|single)\w*[^\n]*", text, re.IGNORECASE)


def test_metrics_shuffle_windows_only(spark, data):
    """One exchange, behind a partial aggregate; the only broadcast is the industry table."""
    text = plan(QUERIES["window_metrics"](spark, data))
    assert len(shuffles(text)) == 1 and "partial_sum" in text
    assert text.count("BroadcastExchange") == 1 and "LocalTableScan" in text


def test_scoring_needs_no_shuffle(spark, data):
    for name in ("request_routing", "loan_decision", "decision_analytics"):
        assert not shuffles(plan(QUERIES[name](spark, data)))


def test_scans_read_needed_columns_only(spark, data):
    text = plan(QUERIES["income_prediction"](spark, data))
    assert "o_custkey" in text and "o_totalprice" not in text and "o_orderstatus" not in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan(QUERIES["credit_score_bands"](spark, data))


def scans(text: str) -> int:
    return len(re.findall(r"FileScan parquet", text))


@pytest.mark.parametrize(
    "name, most",
    [("outbox_mark_sent", 1), ("metrics_pivot", 1), ("window_metrics", 1), ("loan_decision", 1), ("loan_report", 1),
     ("dash_latest", 2), ("latest_by_source", 2), ("npl_report", 3), ("latest_prospect_npl", 3), ("upsert_loan", 2)],
)
def test_scans(spark, data, name, most):
    """A flow reads its orders once; a look-up or an anchor once more (the text shows a subquery twice)."""
    assert scans(plan(QUERIES[name](spark, data))) <= most


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_few_scans_of_any_query(spark, data, name):
    """Three stage tables and a reference at most."""
    assert scans(plan(QUERIES[name](spark, data))) <= 4


def test_one_pass_over_both_ways_equals_their_union(spark, data):
    from oracle_check import rows_of

    flow = inputs.order_flow(spark, data)
    one, two = flow.npl, flow.npl_union
    assert one.schema.names == two.schema.names
    assert rows_of(one.columns, one.collect()) == rows_of(two.columns, two.collect())


def test_a_batch_cut_to_its_ends_merges_alike(spark, data):
    from creditflow.operators import merge
    from oracle_check import rows_of

    held = inputs.processed_flow(spark, data).loan_sent
    whole, cut = inputs.reissue_flow(spark, data).loan, inputs.reissue_ends(spark, data).loan
    a, b = (merge.upsert(held, batch, merge.LOAN, inputs.REISSUE_ORDER) for batch in (whole, cut))
    assert cut.count() < whole.count() and rows_of(a.columns, a.collect()) == rows_of(b.columns, b.collect())
    raw = inputs.reissue_flow(spark, data).requests.select("request_id", "system_time", "customer_id", "prospect_id", "income_source")
    got = merge.ends(raw, "request_id", inputs.REISSUE_ORDER)
    by_key = {}
    for r in raw.collect():
        by_key.setdefault(r.request_id, []).append((r.system_time, r.customer_id, r.prospect_id))
    ends = {}
    for r in got.collect():
        ends.setdefault(r.request_id, []).append((r.system_time, r.customer_id, r.prospect_id))
    assert {k: sorted(v) for k, v in ends.items()} == {k: [min(v), max(v)] if len(v) > 1 else v for k, v in by_key.items()}


def test_lookup_filters_on_the_raw_key(spark, data):
    text = plan(QUERIES["request_lookup"](spark, data))
    assert re.search(r"DataFilters: \[[^\]]*o_orderkey[^\]]*ubquery", text)


def test_pivot_needs_one_more_shuffle(spark, data):
    text = plan(QUERIES["metrics_pivot"](spark, data))
    assert len(shuffles(text)) == 2


def test_no_plan_depends_on_the_size_of_the_machine():
    from pathlib import Path

    import creditflow

    for file in Path(creditflow.__file__).parent.rglob("*.py"):
        if "llm" not in file.parts:
            assert not re.search(r"getNumPartitions|defaultParallelism", file.read_text()), file


def test_status_filter_reaches_the_scan(spark, data):
    text = plan(inputs.processed_flow(spark, data).income)
    assert re.search(r"PushedFilters: \[[^\]]*Not\(EqualTo\(o_orderstatus,P\)\)", text)


def test_pending_flag_reaches_the_scan(spark, data, tmp_path):
    """Row groups whose rows are all sent are skipped by their statistics."""
    inputs.order_flow(spark, data).loan.write.parquet(str(tmp_path / "loan"))
    table = spark.read.parquet(str(tmp_path / "loan"))
    text = plan(outbox.pending(table, outbox.DISBURSEMENT))
    assert re.search(r"PushedFilters: \[[^\]]*Not\(EqualTo\(sent_to_ldis,true\)\)", text)


def test_sent_row_groups_are_skipped(spark, data, tmp_path):
    """Of a sent and an unsent file the scan delivers only the rows of the unsent one."""
    flow = inputs.order_flow(spark, data)
    done = F.col("e4_consumed_at") % 2 == 0
    path = str(tmp_path / "loan")
    flow.loan_sent.filter(done).coalesce(1).write.parquet(path)
    todo = flow.loan.filter(~done).coalesce(1)
    todo.write.mode("append").parquet(path)
    found = outbox.pending(spark.read.parquet(path), outbox.DISBURSEMENT)
    assert len(found.collect()) == todo.count()
    executed = found._jdf.queryExecution().executedPlan()
    scan = executed.collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() == todo.count()


def test_the_flow_brings_what_it_needs_to_any_session(spark, data):
    """No query leaves its scoring to interpreted methods; what the submitter set stays."""
    other = spark.newSession()
    for key in session.FLOW_DEFAULTS:
        other.conf.unset(key)
    QUERIES["upsert_loan"](other, data)
    assert {key: other.conf.get(key) for key in session.FLOW_DEFAULTS} == session.FLOW_DEFAULTS
    given = dict.fromkeys(session.FLOW_DEFAULTS, "12345")
    for key, value in given.items():
        other.conf.set(key, value)
    QUERIES["upsert_loan"](other, data)
    assert {key: other.conf.get(key) for key in given} == given


def test_upsert_shuffles_each_side_once(spark, data):
    """Raw rows are dealt by the key; scoring, fold and join need no other exchange."""
    for name in ("upsert_income", "upsert_loan"):
        text = plan(QUERIES[name](spark, data))
        assert len(shuffles(text)) == 2 and re.search(r"HashAggregate\(keys=\[request_id[^\n]*partial_max\(packed", text)


def test_top_k_is_not_a_sort(spark, data):
    assert "TakeOrderedAndProject" in plan(QUERIES["newest_100"](spark, data))


def test_running_count_shuffles_rows_once(spark, data):
    """Rows are dealt by (key, slice) only; the join with the slice offsets reuses that."""
    text = plan(QUERIES["event_counter"](spark, data))
    rows = re.findall(r"Exchange hashpartitioning\([^)]*_slice[^)]*\)[^\n]*\n[^\n]*event_id", text)
    assert len(rows) == 1


def test_sent_log_is_reduced_before_the_anti_join(spark, data):
    text = plan(QUERIES["outbox_anti"](spark, data))
    assert "LeftAnti" in text and text.index("LeftAnti") < text.rindex("HashAggregate")
