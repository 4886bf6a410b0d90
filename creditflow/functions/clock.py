"""Stage clocks, latencies and epoch formatting. All times are epoch milliseconds.

A request carries a sequential event clock and the wall clock (``system_time``) at which it
was made. A later stage stamps its event clock forward by the wall time that has passed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 24 * 60 * 60 * 1000


def now_ms() -> Column:
    """The wall clock: one value per query or micro-batch."""
    return F.unix_millis(F.current_timestamp())


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def shifted(base: Column, proc_ms: Column, system_time: Column) -> Column:
    """``base`` moved by the wall time since the request was made."""
    return base + (proc_ms - system_time)


def decision_clock(
    is_customer: Column, npl_at: Column, income_at: Column, proc_ms: Column, system_time: Column
) -> Column:
    """Customers enter at the risk stage, prospects at the income stage."""
    return F.when(is_customer, shifted(npl_at, proc_ms, system_time)).otherwise(
        shifted(income_at, proc_ms, system_time)
    )


def processing_time(
    is_customer: Column, npl_at: Column, income_at: Column, system_time: Column, proc_ms: Column
) -> Column:
    """Elapsed time since the request's own start, falling back to the wall clock."""
    return (
        F.when(is_customer & (npl_at > 0), proc_ms - npl_at)
        .when(income_at > 0, proc_ms - income_at)
        .otherwise(proc_ms - system_time)
    )


def event_or_system_time(event: Column, system: Column, proc_ms: Column) -> Column:
    return F.coalesce(event, system, proc_ms)


def epoch_text(ms: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS.mmm`` in the session time zone; null stays null."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss.SSS")


def nanos(ms: Column) -> Column:
    return ms * F.lit(1000000).cast("bigint")
