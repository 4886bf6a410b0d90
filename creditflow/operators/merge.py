"""Keyed upserts with a rule per column, as set operations.

A stage writes with insert-or-update semantics: a key the table lacks is inserted whole, a key
it holds has only some columns refreshed. Applied row by row, a key that comes twice in one
batch is inserted by its first row and refreshed by the later ones. The set form keeps that
result: the batch is folded to one row per key first, then joined once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditflow import schemas


@dataclass(frozen=True)
class MergeSpec:
    """What happens when a key meets a row that is already there.

    refresh: columns taken from the newest row of the key.
    reset: columns set to a fixed value.
    All other columns keep the value of the row that first inserted the key.
    """

    name: str
    table: StructType
    refresh: tuple[str, ...]
    reset: dict[str, object] = field(default_factory=dict)
    key: str = "request_id"

    @property
    def kept(self) -> list[str]:
        used = {self.key, *self.refresh, *self.reset}
        return [c for c in self.table.fieldNames() if c not in used]


INCOME = MergeSpec(
    name="income",
    table=schemas.INCOME_TABLE,
    refresh=("predicted_income", "e1_consumed_at"),
    reset={"sent_to_npl": False},
)

# A prospect that comes again is marked unsent for the stage behind it, not for the next one:
# the row is refreshed but not handed on again.
NPL_FROM_INCOME = MergeSpec(
    name="npl_from_income",
    table=schemas.NPL_TABLE,
    refresh=("credit_score", "predicted_npl", "npl_requested_at", "e2_consumed_at"),
    reset={"sent_to_npl": False},
)

NPL_FROM_REQUEST = MergeSpec(
    name="npl_from_request",
    table=schemas.NPL_TABLE,
    refresh=("credit_score", "predicted_npl", "e3_consumed_at"),
    reset={"sent_to_ldes": False},
)

LOAN = MergeSpec(
    name="loan",
    table=schemas.LOAN_TABLE,
    refresh=(
        "e4_consumed_at", "debt_to_income_ratio", "employment_industry",
        "employment_stability", "loan_decision", "loan_amount",
    ),
    reset={"sent_to_ns": False, "sent_to_ldis": False},
)

def _newest_per_window(name: str, table: StructType) -> MergeSpec:
    """A window that is emitted again replaces its earlier state."""
    key = "bucket_start"
    rest = tuple(c for c in table.fieldNames() if c != key)
    return MergeSpec(name=name, table=table, key=key, refresh=rest)


METRICS = _newest_per_window("metrics", schemas.WINDOW_METRICS)
NOTIFICATION_METRICS = _newest_per_window("notification_metrics", schemas.NOTIFICATION_METRICS)


def _literal(spec: MergeSpec, name: str) -> str:
    return f"CAST('{spec.reset[name]}' AS {spec.table[name].dataType.simpleString()})"


def ends(raw: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first and the newest row of each key, by ``order``; a key of one row has that one.

    Row-by-row upserts of a batch leave what those of its ends leave: the first row inserts, the
    newest refreshes, and that there was a second one resets. So a batch is cut to its ends while
    its rows are raw and narrow, and only those are scored. Both ends are partial aggregates, and
    the rows come out dealt by the key: a merge on it needs no other shuffle. Where
    ``order`` is one number, the rest of the row is unpacked from it and nothing is sorted.
    """
    rest = [c for c in raw.columns if c != key]
    if rest == list(order) and len(rest) == 1:
        low, high, value = F.min(rest[0]), F.max(rest[0]), F.col("_end").alias(rest[0])
    else:
        row = F.struct(*order, *[c for c in rest if c not in order])
        low, high, value = F.min(row), F.max(row), F.col("_end.*")
    both = raw.groupBy(key).agg(low.alias("_low"), high.alias("_high"), F.count(F.lit(1)).alias("_n"))
    picked = F.when(F.col("_n") > 1, F.array("_low", "_high")).otherwise(F.array("_low"))
    return both.select(key, F.explode(picked).alias("_end")).select(key, value)


def fold(batch: DataFrame, spec: MergeSpec, order: Sequence[str]) -> DataFrame:
    """One row per key: what row-by-row upserts of the batch into an empty table would leave.

    ``order`` must rank the rows of a key. First and last row are partial aggregates, so a key
    that holds a large share of the batch is reduced before the shuffle. ``_rows`` counts the
    rows behind each key.
    """
    rank = F.struct(*order)
    first_cols = [*spec.kept, *spec.reset]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    if first_cols:
        aggs.append(F.min_by(F.struct(*first_cols), rank).alias("_first"))
    if spec.refresh:
        aggs.append(F.max_by(F.struct(*spec.refresh), rank).alias("_last"))
    per_key = batch.groupBy(spec.key).agg(*aggs)

    def column(name: str) -> str:
        if name == spec.key:
            return name
        if name in spec.refresh:
            return f"_last.{name} AS {name}"
        if name in spec.reset:
            again = _literal(spec, name)
            return f"CASE WHEN _rows > 1 THEN {again} ELSE _first.{name} END AS {name}"
        return f"_first.{name} AS {name}"

    return per_key.selectExpr(*[column(c) for c in spec.table.fieldNames()], "_rows")


def merge_folded(target: DataFrame, folded: DataFrame, spec: MergeSpec) -> DataFrame:
    """The table after the folded batch: one full outer join on the key."""
    held = target.withColumn("_present", F.lit(True)).alias("t")
    joined = held.join(folded.alias("n"), spec.key, "full_outer")

    def column(name: str) -> str:
        old, new = f"t.{name}", f"n.{name}"
        if name == spec.key:
            return name
        if name in spec.refresh:
            value = f"CASE WHEN n._rows IS NULL THEN {old} ELSE {new} END"
        elif name in spec.reset:
            again = _literal(spec, name)
            value = (
                f"CASE WHEN n._rows IS NULL THEN {old}"
                f" WHEN t._present THEN {again} ELSE {new} END"
            )
        else:
            value = f"CASE WHEN t._present THEN {old} ELSE {new} END"
        return f"{value} AS {name}"

    return joined.selectExpr(*[column(c) for c in spec.table.fieldNames()])


def upsert(
    target: DataFrame, batch: DataFrame, spec: MergeSpec, order: Sequence[str]
) -> DataFrame:
    """The table after all rows of ``batch``. ``target`` holds each key once."""
    return merge_folded(target, fold(batch, spec, order), spec)
