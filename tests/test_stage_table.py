"""The stage table: merge, replay, outbox passes, layout, moved rows, partial rewrites."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from creditflow import schemas
from creditflow.operators import merge, outbox
from creditflow.plans import inputs
from creditflow.sources.stage_table import ConcurrentCommit, StageTable
from creditflow.sources.topics import read_topic_batch
from creditflow.streaming.jobs import run_outbox
from oracle_check import rows_of

ORDER = inputs.REISSUE_ORDER


def rows(df):
    return rows_of(df.columns, df.collect())


@pytest.fixture
def income(spark, tmp_path):
    return StageTable(spark, str(tmp_path / "income"), schemas.INCOME_TABLE, buckets=4)


@pytest.mark.parametrize("day_of", [None, "system_time"])
def test_merges_equal_the_batch_form(spark, data, tmp_path, day_of):
    """With day partitions the time of a key must not change, so the batch repeats the orders."""
    held, flow = inputs.processed_flow(spark, data), inputs.order_flow(spark, data)
    table = StageTable(
        spark, str(tmp_path / "t"), schemas.INCOME_TABLE, buckets=4, day_of=day_of
    )
    first = held.income_sent.filter(F.col("system_time") < 900_000_000_000)
    again = flow.income.filter(F.col("system_time") < 900_000_000_000)
    table.merge(first, merge.INCOME, ORDER)
    table.merge(again, merge.INCOME, ORDER)
    assert rows(table.read()) == rows(merge.upsert(first, again, merge.INCOME, ORDER))


def test_rewrites_only_touched_buckets(spark, data, income):
    flow = inputs.order_flow(spark, data)
    income.merge(flow.income, merge.INCOME, ORDER)
    before = income.snapshot()
    one = flow.income.filter("request_id = 'req-1' OR request_id = 'req-3'").limit(1)
    after = income.merge(one, merge.INCOME, ORDER)
    changed = [p for p in after.dirs if after.dirs[p] != before.dirs[p]]
    assert len(before.dirs) == 4 and len(changed) <= 1
    assert income.read().count() == flow.income.count()


def test_one_file_per_bucket(spark, data, income, tmp_path):
    income.merge(inputs.order_flow(spark, data).income, merge.INCOME, ORDER)
    files = list((tmp_path / "income" / "data").rglob("*.parquet"))
    assert len(files) == 4


def test_replay_keeps_the_table(spark, data, income):
    """Draws depend on the request alone, so feeding a batch twice changes nothing but flags."""
    flow = inputs.order_flow(spark, data)
    income.merge(flow.income_sent, merge.INCOME, ORDER)
    income.merge(flow.income, merge.INCOME, ORDER)
    got = income.read()
    assert got.filter("sent_to_npl").count() == 0
    assert rows(got.drop("sent_to_npl")) == rows(flow.income_sent.drop("sent_to_npl"))


def test_a_batch_id_merges_once(spark, data, income):
    flow = inputs.order_flow(spark, data)
    income.merge(flow.income, merge.INCOME, ORDER, writer="w", batch_id=0)
    again = income.merge(flow.income, merge.INCOME, ORDER, writer="w", batch_id=0)
    assert again.version == 1


def test_outbox_pass(spark, data, tmp_path):
    """The second pass finds nothing; the marks carry the time that was sent."""
    flow = inputs.order_flow(spark, data)
    table = StageTable(spark, str(tmp_path / "loan"), schemas.LOAN_TABLE, buckets=4)
    table.merge(flow.loan, merge.LOAN, ORDER)
    topic = str(tmp_path / "e6")
    assert run_outbox(table, outbox.DISBURSEMENT, topic, flow.clock("e6_produce"))
    assert not run_outbox(table, outbox.DISBURSEMENT, topic, flow.clock("e6_produce"))
    sent = read_topic_batch(spark, topic, schemas.DECISION_RESULT)
    assert rows(sent) == rows(flow.e6)
    assert rows(table.read()) == rows(flow.loan_sent)


def test_outbox_order_puts_missing_times_last(spark, data):
    flow = inputs.order_flow(spark, data)
    times = [
        (r.e2_consumed_at, r.e3_consumed_at)
        for r in outbox.ordered(flow.npl, outbox.NPL).collect()
    ]
    prospects = [t for t in times if t[0] is not None]
    assert times[: len(prospects)] == sorted(prospects)
    assert [t[1] for t in times[len(prospects):]] == sorted(t[1] for t in times if t[0] is None)


def test_a_row_upserted_meanwhile_is_not_marked(spark, data, income):
    """Between sending and marking some requests come in again, with another clock."""
    flow, again = inputs.order_flow(spark, data), inputs.reissue_flow(spark, data).income
    income.merge(flow.income, merge.INCOME, ORDER)
    sent = outbox.hand_over(income.read(), outbox.INCOME, F.lit(0))
    income.merge(again, merge.INCOME, ORDER)
    income.mark_sent(sent, outbox.INCOME)
    changed = {r.request_id for r in again.select("request_id").distinct().collect()}
    pending = {r.request_id for r in outbox.pending(income.read(), outbox.INCOME).collect()}
    assert pending == changed and len(changed) < income.read().count()


def test_a_second_writer_is_refused(spark, data, income, monkeypatch):
    """A writer whose version another one has taken fails, and the table keeps the first one's rows."""
    flow = inputs.order_flow(spark, data)
    income.merge(flow.income_sent, merge.INCOME, ORDER)
    before, commit = income.snapshot(), StageTable._commit
    income.merge(flow.income, merge.INCOME, ORDER)
    kept = rows(income.read())
    with pytest.raises(ConcurrentCommit):
        commit(income, type(before)(before.version + 1, before.dirs, {}, before.layout))
    assert rows(income.read()) == kept


def small(spark, rows_in):
    """Income rows of (request number, system_time)."""
    base = spark.createDataFrame(rows_in, "n long, system_time long")
    values = {f.name: F.lit(None).cast(f.dataType) for f in schemas.INCOME_TABLE}
    values |= {
        "request_id": F.concat(F.lit("req-"), F.col("n").cast("string")), "system_time": F.col("system_time"),
        "sent_to_npl": F.lit(False), "predicted_income": F.col("n").cast("double"),
    }
    return base.select(*[values[f.name].alias(f.name) for f in schemas.INCOME_TABLE])


def test_another_layout_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    table = StageTable(spark, path, schemas.INCOME_TABLE, buckets=4)
    table.merge(small(spark, [(i, 0) for i in range(200)]), merge.INCOME, ["system_time"])
    for other in ({"buckets": 8}, {"buckets": 4, "day_of": "system_time"}):
        with pytest.raises(ValueError):
            StageTable(spark, path, schemas.INCOME_TABLE, **other).merge(small(spark, [(1, 0)]), merge.INCOME, ["system_time"])
    assert table.read().count() == 200


def test_a_changed_time_moves_no_row_twice(spark, tmp_path):
    """A key that comes again with another day stays one row, in the part of its stored time."""
    day = 86_400_000
    table = StageTable(spark, str(tmp_path / "t"), schemas.INCOME_TABLE, buckets=4, day_of="system_time")
    table.merge(small(spark, [(i, day) for i in range(200)]), merge.INCOME, ["system_time"])
    table.merge(small(spark, [(i, 4 * day) for i in range(50)] + [(900, 4 * day)]), merge.INCOME, ["system_time"])
    table.merge(small(spark, [(i, 2 * day) for i in range(190, 210)]), merge.INCOME, ["system_time"])
    got = [r.request_id for r in table.read().collect()]
    assert len(got) == len(set(got)) == 211


def test_marks_of_unknown_keys_change_nothing(spark, tmp_path):
    table = StageTable(spark, str(tmp_path / "t"), schemas.INCOME_TABLE, buckets=4, day_of="system_time")
    sent = outbox.hand_over(small(spark, [(7, 0)]), outbox.INCOME, F.lit(0))
    table.mark_sent(sent, outbox.INCOME)
    assert table.read().count() == 0
    table.merge(small(spark, [(i, 0) for i in range(20)]), merge.INCOME, ["system_time"])
    table.mark_sent(outbox.hand_over(small(spark, [(500, 0), (3, 0)]), outbox.INCOME, F.lit(0)), outbox.INCOME)
    got = {r.request_id: r.sent_to_npl for r in table.read().collect()}
    assert len(got) == 20 and [k for k, v in got.items() if v] == ["req-3"]


def test_a_small_batch_rewrites_its_own_part(spark, tmp_path):
    day = 86_400_000
    table = StageTable(spark, str(tmp_path / "t"), schemas.INCOME_TABLE, buckets=4, day_of="auto")
    before = table.merge(small(spark, [(i, i % 10 * day) for i in range(400)]), merge.INCOME, ["system_time"])
    after = table.merge(small(spark, [(3, 3 * day)]), merge.INCOME, ["system_time"])
    assert len(before.dirs) == 40
    assert sum(after.dirs[p] != before.dirs[p] for p in after.dirs) == 1


def test_expire_keeps_what_snapshots_use(spark, data, income, tmp_path):
    flow = inputs.order_flow(spark, data)
    for _ in range(3):
        income.merge(flow.income, merge.INCOME, ORDER)
    before = rows(income.read())
    income.expire(keep=1)
    assert len(list((tmp_path / "income" / "data").iterdir())) == 1
    assert rows(income.read()) == before
    income.merge(flow.income, merge.INCOME, ORDER)
    assert rows(income.read()) == before


def test_second_consumer_has_its_own_flag(spark, data, tmp_path):
    flow = inputs.order_flow(spark, data)
    table = StageTable(spark, str(tmp_path / "loan"), schemas.LOAN_TABLE, buckets=2)
    table.merge(flow.loan, merge.LOAN, ORDER)
    assert run_outbox(table, outbox.DISBURSEMENT, str(tmp_path / "e6"))
    assert run_outbox(table, outbox.NOTIFICATION, str(tmp_path / "e5"))
    assert not run_outbox(table, outbox.NOTIFICATION, str(tmp_path / "e5"))
    assert table.read().filter("sent_to_ns AND sent_to_ldis").count() == flow.loan.count()


def test_lookup_reads_one_bucket(spark, data, income):
    flow = inputs.order_flow(spark, data)
    income.merge(flow.income, merge.INCOME, ORDER)
    key = flow.income.agg(F.max("request_id")).first()[0]
    found = income.lookup(key)
    assert [r.request_id for r in found.collect()] == [key]
    assert len(found.inputFiles()) == 1
    assert income.lookup("req-none").count() == 0


def test_since_skips_older_days(spark, data, tmp_path):
    flow = inputs.order_flow(spark, data)
    metrics = flow.metrics("1 day")
    table = StageTable(spark, str(tmp_path / "m"), schemas.WINDOW_METRICS, key="bucket_start",
                       buckets=1, day_of="bucket_start")
    table.merge(metrics, merge.METRICS, ["window_end"])
    newest = metrics.agg(F.max("bucket_start")).first()[0]
    recent = table.since(newest - 3 * 86_400_000)
    assert 0 < len(recent.inputFiles()) <= 4
    assert rows(recent) == rows(
        metrics.select(recent.columns).filter(F.col("bucket_start") >= newest - 3 * 86_400_000))
