"""Loan requests and stage tables derived from the star-schema tables.

One loan request per order, and one re-issued request per line item of an order. Every column
is a function of its row, so deriving them needs no shuffle. The stage clocks that stand in for
the wall clock are drawn too (up to five seconds behind ``system_time``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow import schemas
from creditflow.functions.clock import DAY_MS, epoch_ms
from creditflow.functions.draws import Draw, keyed_draws, uniform
from creditflow.operators import merge, outbox
from creditflow.operators.metrics import event_time, window_metrics
from creditflow.operators.records import to_message
from creditflow.plans import stages
from creditflow.sources.tables import table

CUSTOMER_SHARE = 0.8
MAX_LATENCY_MS = 5000.0


def _request_id(order_key: str) -> Column:
    return F.concat(F.lit("req-"), F.col(order_key).cast("string"))


def _requests(df: DataFrame, order_key: str, entity: str, date: str) -> DataFrame:
    base_ms = epoch_ms(F.col(date)) + (F.col(order_key) * 1000) % DAY_MS
    ids = df.withColumn("application_id", F.concat(F.lit("app-"), F.col(order_key).cast("string")))
    if "request_id" not in df.columns:
        ids = ids.withColumn("request_id", _request_id(order_key))
    return stages.route_requests(
        ids,
        is_customer=uniform(order_key, "is_customer") < CUSTOMER_SHARE,
        entity=F.col(entity),
        sequential_ms=base_ms,
        wall_ms=base_ms,
    )


# The key behind a derived request id.
ORDER_KEY = "substring_index(request_id, '-', -1)"


def order_draws() -> Draw:
    """Draws of the first issue of a request."""
    return keyed_draws(ORDER_KEY)


def reissue_draws() -> Draw:
    """Draws of a re-issued request: they differ from issue to issue."""
    return keyed_draws(f"concat({ORDER_KEY}, '@', system_time)")


def wall_clock(draw: Draw, stage: str) -> Column:
    """The wall clock at which ``stage`` handles a request."""
    return F.col("system_time") + (draw("lat_" + stage) * MAX_LATENCY_MS).cast("bigint")


@dataclass(frozen=True)
class Flow:
    """All messages and stage rows that follow from a set of requests."""

    requests: DataFrame
    draw: Draw

    def where(self, condition: Column) -> Flow:
        """The flow of the requests that meet a condition."""
        return Flow(self.requests.filter(condition), self.draw)

    def clock(self, stage: str) -> Column:
        return wall_clock(self.draw, stage)

    @cached_property
    def prospects(self) -> DataFrame:
        return self.requests.filter(~F.col("is_customer"))

    @cached_property
    def customers(self) -> DataFrame:
        return self.requests.filter("is_customer")

    @cached_property
    def e1(self) -> DataFrame:
        return to_message(self.prospects, schemas.INCOME_REQUEST)

    @cached_property
    def e3(self) -> DataFrame:
        return to_message(self.customers, schemas.NPL_REQUEST)

    @cached_property
    def income(self) -> DataFrame:
        return stages.stage_income(self.e1, self.clock("e1_consume"))

    @cached_property
    def income_sent(self) -> DataFrame:
        return outbox.hand_over(self.income, outbox.INCOME, self.clock("e2_produce"))

    @cached_property
    def e2(self) -> DataFrame:
        return outbox.messages(self.income_sent, outbox.INCOME)

    @cached_property
    def npl_income(self) -> DataFrame:
        return stages.stage_npl_income(
            self.e2, self.clock("e2_consume"), self.draw
        )

    @cached_property
    def npl_request(self) -> DataFrame:
        return stages.stage_npl_request(
            self.e3, self.clock("e3_consume"), self.draw
        )

    @cached_property
    def npl(self) -> DataFrame:
        return stages.risk_rows(self.requests, self.clock, self.draw)

    @cached_property
    def npl_union(self) -> DataFrame:
        """The same by way of the income table and of its two writers."""
        return stages.npl_inputs(self.npl_income, self.npl_request)

    @cached_property
    def npl_sent(self) -> DataFrame:
        return outbox.hand_over(self.npl, outbox.NPL, self.clock("e4_produce"))

    @cached_property
    def e4(self) -> DataFrame:
        return outbox.messages(self.npl_sent, outbox.NPL)

    @cached_property
    def loan(self) -> DataFrame:
        return stages.stage_decision(
            self.e4, self.clock("e4_consume"), self.draw
        )

    @cached_property
    def loan_sent(self) -> DataFrame:
        return outbox.hand_over(self.loan, outbox.DISBURSEMENT, self.clock("e6_produce"))

    @cached_property
    def e6(self) -> DataFrame:
        return outbox.messages(self.loan_sent, outbox.DISBURSEMENT)

    @cached_property
    def analytics(self) -> DataFrame:
        return stages.stage_analytics(self.e6, self.clock("analytics"))

    @cached_property
    def notifications(self) -> DataFrame:
        return stages.stage_notify(self.e6, self.clock("notify"))

    def metrics(self, size: str) -> DataFrame:
        return window_metrics(event_time(self.analytics, "timestamp"), size)


def order_requests(spark: SparkSession, folder: str, which: Column | None = None) -> DataFrame:
    """Requests of all orders, or of those that meet ``which``."""
    orders = table(spark, folder, "orders")
    orders = orders if which is None else orders.filter(which)
    return _requests(orders, "o_orderkey", "o_custkey", "o_orderdate")


def order_flow(spark: SparkSession, folder: str, which: Column | None = None) -> Flow:
    """The flow of all orders, or of those that meet ``which``, each request issued once."""
    return Flow(order_requests(spark, folder, which), order_draws())


def processed_flow(spark: SparkSession, folder: str) -> Flow:
    """The flow of the orders that are no longer pending: what a stage table holds already."""
    return order_flow(spark, folder).where(F.col("o_orderstatus") != "P")


def processed_flow_by_key(spark: SparkSession, folder: str) -> Flow:
    """The same, dealt by the request's id before anything is scored.

    A merge needs its rows by key in any case. Dealt while they are raw the rows are narrow, and
    all that is derived from them is derived behind the shuffle.
    """
    orders = table(spark, folder, "orders").filter(F.col("o_orderstatus") != "P")
    raw = orders.select(_request_id("o_orderkey").alias("request_id"), "o_orderkey", "o_custkey", "o_orderdate")
    return Flow(_requests(raw.repartition("request_id"), "o_orderkey", "o_custkey", "o_orderdate"), order_draws())


def reissue_flow(spark: SparkSession, folder: str) -> Flow:
    """The flow of re-issued requests, one per line item: keys repeat within the batch."""
    lineitem = table(spark, folder, "lineitem")
    return Flow(
        _requests(lineitem, "l_orderkey", "l_suppkey", "l_shipdate"), reissue_draws()
    )


def reissue_ends(spark: SparkSession, folder: str) -> Flow:
    """The flow of the first and the newest re-issue of each request.

    Of a re-issue only ship date and supplier differ within its request; both go into one number
    that ranks them as :data:`REISSUE_ORDER` does.
    """
    lineitem = table(spark, folder, "lineitem")
    packed = F.shiftleft(epoch_ms(F.col("l_shipdate")), _ENTITY_BITS) + F.col("l_suppkey") % stages.ID_RANGE
    cut = merge.ends(lineitem.select(_request_id("l_orderkey").alias("request_id"), packed.alias("packed")), "request_id", ["packed"])
    raw = cut.select(
        "request_id",
        F.expr(f"cast({ORDER_KEY} as bigint)").alias("l_orderkey"),
        F.col("packed").bitwiseAND(F.lit((1 << _ENTITY_BITS) - 1)).alias("l_suppkey"),
        F.timestamp_millis(F.shiftright("packed", _ENTITY_BITS)).alias("l_shipdate"),
    )
    return Flow(_requests(raw, "l_orderkey", "l_suppkey", "l_shipdate"), reissue_draws())


# Bits that hold any id of an entity (below ``stages.ID_RANGE``).
_ENTITY_BITS = 20


# Rank of a re-issued row among those of its request. Rows that tie are equal in every column.
REISSUE_ORDER = ["system_time", "customer_id", "prospect_id"]
