"""Topics: append-only logs of messages with a fixed schema.

A topic is a directory of parquet files that a stream reads as they arrive, or a broker topic
read and written through the session's Kafka connector. The directory form needs no package;
the broker form and the Avro codec need the ``spark-sql-kafka`` and ``spark-avro`` packages on
the cluster and are plain configuration here.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

# A message as a broker holds it.
WIRE = StructType([StructField("key", StringType()), StructField("value", BinaryType())])


# --- directory topics -------------------------------------------------------------------


def read_topic(
    spark: SparkSession,
    path: str,
    schema: StructType,
    start: str = "earliest",
    since: Column | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of the topic's messages.

    ``earliest`` reads everything. ``latest`` skips what was there before: a directory has no
    offsets, so ``since`` is the condition that tells new messages from old ones.
    """
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest or latest, not {start}")
    if start == "latest" and since is None:
        raise ValueError("a directory topic read from latest needs a condition in since")
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.parquet(path)
    return stream if start == "earliest" else stream.filter(since)


def read_topic_batch(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def append_topic(messages: DataFrame, path: str, broker: dict[str, str] | None = None) -> None:
    """Append a batch of messages, in its order, to a directory or with ``broker`` options to a
    broker, which takes (key, value) pairs only."""
    if broker is not None:
        messages.write.format("kafka").options(**broker).save()
    else:
        messages.write.mode("append").parquet(path)


def read_text_topic(spark: SparkSession, path: str) -> DataFrame:
    """A stream of text messages in column ``value``."""
    return spark.readStream.text(path)


def read_bytes_topic(spark: SparkSession, path: str) -> DataFrame:
    """A stream of raw payloads in column ``value``, one per file."""
    stream = (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .load(path)
    )
    return stream.select("path", F.col("content").alias("value"))


# --- broker topics ----------------------------------------------------------------------


def kafka_source_options(
    topic: str,
    servers: str = "localhost:9092",
    group: str | None = None,
    start: str = "earliest",
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``. Offsets live in the query's checkpoint."""
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest or latest, not {start}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if group:
        options["groupIdPrefix"] = group
    return options


def kafka_sink_options(topic: str, servers: str = "localhost:9092") -> dict[str, str]:
    """Options for a write with ``format("kafka")``, which delivers at least once."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


# --- encoding ---------------------------------------------------------------------------


def avro_schema(schema: StructType, name: str, namespace: str = "loan") -> str:
    """The Avro record schema of a message; a nullable field is a union with null."""
    kinds = {"string": "string", "integer": "int", "long": "long", "double": "double",
             "boolean": "boolean"}
    fields = []
    for f in schema:
        kind = kinds[f.dataType.typeName()]
        field: dict[str, object] = {"name": f.name, "type": ["null", kind] if f.nullable else kind}
        if f.nullable:
            field["default"] = None
        fields.append(field)
    record = {"type": "record", "name": name, "namespace": namespace, "fields": fields}
    return json.dumps(record)


def encode(
    df: DataFrame, schema: StructType, key: str | None = None, fmt: str = "json",
    record: str = "Message",
) -> DataFrame:
    """Messages as (key, value) pairs. Without ``key`` the key is null."""
    body = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    if fmt == "json":
        value = F.to_json(body).cast("binary")
    elif fmt == "avro":
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(body, avro_schema(schema, record))
    else:
        raise ValueError(f"fmt must be json or avro, not {fmt}")
    key_column = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(key_column.alias("key"), value.alias("value"))


def decode(
    df: DataFrame, schema: StructType, fmt: str = "json", mode: str = "FAILFAST",
    record: str = "Message",
) -> DataFrame:
    """The message fields of a ``value`` column. A bad record fails the job, as does a null."""
    value = F.coalesce(
        F.col("value"), F.raise_error(F.lit("null record")).cast("binary")
    )
    if fmt == "json":
        body = F.from_json(value.cast("string"), schema, {"mode": mode})
    elif fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        body = from_avro(value, avro_schema(schema, record), {"mode": mode})
    else:
        raise ValueError(f"fmt must be json or avro, not {fmt}")
    return df.select(body.alias("m")).select("m.*")


def split_bad(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Good messages, and the rejects with their reason, instead of failing the job.

    A message is bad when it is null, is not JSON, has a field of the wrong type, or lacks a
    required field.
    """
    lenient = StructType([StructField(f.name, f.dataType) for f in schema])
    corrupt = "_corrupt"
    probe = StructType([*lenient, StructField(corrupt, StringType())])
    text = F.col("value").cast("string")
    parsed = df.withColumn(
        "m",
        F.from_json(
            text, probe, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
        ),
    )
    missing = F.lit(False)
    for f in schema:
        if not f.nullable:
            missing = missing | F.col(f"m.{f.name}").isNull()
    reason = (
        F.when(F.col("value").isNull(), "null record")
        .when(F.col(f"m.{corrupt}").isNotNull(), "malformed")
        .when(missing, "missing field")
    )
    marked = parsed.withColumn("reason", reason)
    good = marked.filter(F.col("reason").isNull()).select(
        *[F.col(f"m.{f.name}").alias(f.name) for f in schema]
    )
    bad = marked.filter(F.col("reason").isNotNull()).select("value", "reason")
    return good, bad
