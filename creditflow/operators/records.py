"""Record mapping between messages and stage rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from creditflow.schemas import snake


def from_message(df: DataFrame, message: StructType, zero_longs: bool = False) -> DataFrame:
    """Rename and cast the fields of a message; a null boolean reads as false.

    ``zero_longs`` also reads a null nullable long as 0, as the disbursement stage does.
    """

    def field(f) -> str:
        value = f"CAST({f.name} AS {f.dataType.simpleString()})"
        if isinstance(f.dataType, BooleanType):
            value = f"coalesce({value}, false)"
        elif zero_longs and f.nullable and isinstance(f.dataType, LongType):
            value = f"coalesce({value}, 0L)"
        return f"{value} AS {snake(f.name)}"

    return df.selectExpr(*[field(f) for f in message])


def to_message(df: DataFrame, message: StructType, zero_longs: bool = False) -> DataFrame:
    """The message fields of a stage table, under their wire names.

    ``zero_longs`` writes a time that the table lacks as 0.
    """

    def field(f) -> str:
        value = f"CAST({snake(f.name)} AS {f.dataType.simpleString()})"
        if zero_longs and isinstance(f.dataType, LongType):
            value = f"coalesce({value}, 0L)"
        return f"{value} AS {f.name}"

    return df.selectExpr(*[field(f) for f in message])


def conform(df: DataFrame, table: StructType) -> DataFrame:
    """Exactly the columns of ``table``, in its order; missing ones are null."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()})"
            f" AS {f.name}"
            for f in table
        ]
    )


def effective_id(is_customer: Column, customer_id: Column, prospect_id: Column) -> Column:
    return F.when(is_customer, customer_id).otherwise(prospect_id)


def common_tags(df: DataFrame, environment: str = "development") -> DataFrame:
    """The tags every metric point carries, as text."""
    return df.withColumns(
        {
            "tag_customer_id": F.col("customer_id").cast("string"),
            "tag_application_id": F.col("application_id"),
            "tag_environment": F.lit(environment),
        }
    )
