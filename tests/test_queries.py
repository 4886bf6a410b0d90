"""Every registered query against its reference SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from creditflow.plans import catalog, oracle
from oracle_check import compare, connect

QUERIES = catalog.registered()
SQL = oracle.statements()
# No approved loan reaches the operator's own line: high default risk is a hard rejection.
MAY_BE_EMPTY = {"alerts_default_line"}


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, data, con, name):
    n_rows, problems = compare(QUERIES[name](spark, data), con, SQL[name])
    assert not problems
    assert n_rows > 0 or name in MAY_BE_EMPTY


def test_contract_holds_every_query():
    assert QUERIES.keys() <= contract.queries().keys()
    assert SQL.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize(
    "name, by",
    [("outbox_pending_income", ["e1_consumed_at", "request_id"]), ("loan_report", ["system_time"])],
)
def test_sorted_output(spark, data, name, by):
    got = [tuple(r[c] for c in by) for r in QUERIES[name](spark, data).collect()]
    assert got == sorted(got, reverse=name == "loan_report") and len(got) > 10


def test_pending_loans_come_oldest_first(spark, data):
    """Messages carry no e4 time; their order is that of the loan table."""
    from creditflow.plans.inputs import order_flow

    times = {r.request_id: r.e4_consumed_at for r in order_flow(spark, data).loan.select("request_id", "e4_consumed_at").collect()}
    got = [(times[r.requestId], r.requestId) for r in QUERIES["outbox_pending_loan"](spark, data).collect()]
    assert got == sorted(got) and len(got) > 10


def test_entry(spark, data):
    assert contract.entry(spark).count() > 0
