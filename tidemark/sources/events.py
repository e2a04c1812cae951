"""Change events: reading, parsing the envelope, typing the row images."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lsn import lsn_to_num
from tidemark.functions.rows import evaluated_once

OPERATIONS = ("INSERT", "UPDATE", "DELETE")

RAW_SCHEMA = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

_SOURCE = T.StructType(
    [
        T.StructField("database", T.VariantType()),
        T.StructField("schema", T.VariantType()),
        T.StructField("schema_name", T.VariantType()),
        T.StructField("table", T.VariantType()),
        T.StructField("transaction_id", T.LongType()),
        T.StructField("lsn", T.StringType()),
        T.StructField("connector_version", T.StringType()),
    ]
)

# Images stay JSON text here: Spark keeps the text of an object read as string. Fields that must be
# strings are variants, as a number read as string would pass for one.
_WIRE = T.StructType(
    [
        T.StructField("event_id", T.VariantType()),
        T.StructField("event_timestamp", T.StringType()),
        T.StructField("source", _SOURCE),
        T.StructField("operation", T.StringType()),
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("_corrupt", T.StringType()),
    ]
)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Raw messages stored as parquet with value, topic, partition, offset."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def read_event_lines(spark: SparkSession, path: str, topic: str = "") -> DataFrame:
    """Raw messages stored one per text line; the offset numbers rows within a file split."""
    lines = spark.read.text(path).withColumn("_row", F.monotonically_increasing_id())
    return lines.select(
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.shiftright("_row", 33).cast("int").alias("partition"),
        F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"),
    )


def stream_events(
    spark: SparkSession,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Live raw messages, from a folder of parquet files or from Kafka topics.

    Kafka starts at the earliest offset; afterwards the checkpoint decides.
    """
    if kafka is not None:
        reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        for key, value in kafka.items():
            reader = reader.option(key, value)
        return reader.load().select("value", "topic", "partition", "offset")
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def uuid_from(text: Column) -> Column:
    """uuid-shaped text from the md5 of ``text``; equal on every recomputation."""
    digest = F.md5(text.cast("string"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, at, size) for at, size in cuts])


def _is_object(text: Column) -> Column:
    return F.ltrim(text).startswith("{")


# Fixed value: numbers beyond it are milliseconds since the epoch, others seconds.
_EPOCH_SECONDS_TO = 20_000_000_000


def _moment(text: Column) -> Column:
    """Time of ISO text or of a number since the epoch; null where it is neither."""
    number = text.try_cast("decimal(28,6)")
    micros = F.when(F.abs(number) > _EPOCH_SECONDS_TO, number * 1_000).otherwise(number * 1_000_000)
    return F.when(
        text.rlike(r"^-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?$"), F.timestamp_micros(micros.try_cast("bigint"))
    ).otherwise(F.try_to_timestamp(text))


def _string_of(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.variant_get(value, "$", "string"))


def parse_events(raw: DataFrame, value_col: str = "value", now: Column | None = None) -> DataFrame:
    """Raw messages to envelope columns plus ``deser_error`` and ``schema_error``.

    Null values are skipped. ``deser_error`` is set for bytes that are not UTF-8,
    empty messages, broken JSON and text around the one JSON value; ``schema_error`` for valid JSON that is not a
    change event; the event id, database, schema and table must be JSON strings, and the time ISO text
    or a number since the epoch. A missing event id is derived from the message position, so a
    retried task gives the same id; a missing time becomes ``now``.
    Images may be objects or JSON text holding an object.
    """
    binary = raw.schema[value_col].dataType == T.BinaryType()
    rows = raw.where(F.col(value_col).isNotNull())
    as_text = F.col(value_col).cast("string")
    readable = F.is_valid_utf8(as_text) if binary else F.lit(True)
    rows = rows.withColumn("raw_text", F.when(readable, as_text))
    rows = evaluated_once(
        rows,
        _wire=F.from_json("raw_text", _WIRE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}),
    )
    wire = F.col("_wire")
    empty = F.length(F.trim("raw_text")) == 0
    suspicious = wire.isNull() | wire["_corrupt"].isNotNull()
    # The JSON readers stop after the first value. Where something may follow it, the text must also
    # parse as the only element of a list and as the only value of an object.
    body = F.rtrim("raw_text")
    more = ~body.endswith("}") | body.rlike(r"\}\s*(?:[^\s,}]|,\s*\{)")
    alone = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))).isNotNull() & F.try_parse_json(
        F.concat(F.lit('{"_":'), body, F.lit("}"))
    ).isNotNull()
    broken = F.when(suspicious, F.try_parse_json("raw_text").isNull()).otherwise(False) | F.when(
        more, ~alone
    ).otherwise(False)
    deser_error = (
        F.when(F.col("raw_text").isNull(), "invalid UTF-8")
        .when(empty, "empty message")
        .when(broken, "invalid JSON")
    )
    source = wire["source"]
    # A filter on the errors would compute these anew for every mention.
    rows = evaluated_once(
        rows,
        deser_error=deser_error,
        _id=_string_of(wire["event_id"]),
        _database=_string_of(source["database"]),
        _schema=_string_of(F.coalesce(source["schema"], source["schema_name"])),
        _table=_string_of(source["table"]),
        _stamped=_moment(wire["event_timestamp"]),
    )
    stamped = F.col("_stamped")
    schema_error = (
        F.when(~_is_object(F.col("raw_text")), "not an object")
        .when(source.isNull(), "source")
        .when(F.col("_database").isNull(), "source.database")
        .when(F.col("_schema").isNull(), "source.schema")
        .when(F.col("_table").isNull(), "source.table")
        .when(F.col("_id").isNull() & ~F.coalesce(F.schema_of_variant(wire["event_id"]) == "VOID", F.lit(True)), "event_id")
        .when(wire["operation"].isNull() | ~wire["operation"].isin(*OPERATIONS), "operation")
        .when(wire["event_timestamp"].isNotNull() & stamped.isNull(), "event_timestamp")
        .when(~_is_object(wire["before"]), "before")
        .when(~_is_object(wire["after"]), "after")
        .when(wire["_corrupt"].isNotNull(), "field type")
    )
    place = [c for c in ("topic", "partition", "offset") if c in raw.columns]
    position = F.concat_ws(":", *[F.col(c).cast("string") for c in place]) if place else F.col("raw_text")
    return rows.select(
        *place,
        "raw_text",
        F.col(value_col).cast("binary").alias("raw_value"),
        F.octet_length(F.col(value_col)).alias("raw_size_bytes"),
        "deser_error",
        F.when(F.col("deser_error").isNull(), schema_error).alias("schema_error"),
        F.col("_id").alias("wire_event_id"),
        F.coalesce("_id", uuid_from(position)).alias("event_id"),
        F.coalesce(stamped, now if now is not None else F.current_timestamp()).alias("event_timestamp"),
        F.when(
            source.isNotNull(),
            F.struct(
                F.col("_database").alias("database"),
                F.col("_schema").alias("schema"),
                F.col("_table").alias("table"),
                source["transaction_id"].alias("transaction_id"),
                source["lsn"].alias("lsn"),
                source["connector_version"].alias("connector_version"),
            ),
        ).alias("source"),
        lsn_to_num(source["lsn"]).alias("lsn_num"),
        wire["operation"].alias("operation"),
        wire["before"].alias("before"),
        wire["after"].alias("after"),
        F.coalesce(wire["schema_version"], F.lit(1)).alias("schema_version"),
        wire["metadata"].alias("metadata"),
    )


def valid_events(parsed: DataFrame) -> DataFrame:
    """Parsed events without errors."""
    return parsed.where(F.col("deser_error").isNull() & F.col("schema_error").isNull()).drop(
        "deser_error", "schema_error", "wire_event_id", "raw_text", "raw_value", "raw_size_bytes"
    )


def image_map(image: Column) -> Column:
    """A JSON row image as map<string,string>; explicit nulls stay as null entries."""
    return F.from_json(image, T.MapType(T.StringType(), T.StringType()))


# Spellings of a true and a false boolean on the wire.
_TRUE = ("t", "true", "yes", "on", "1")
_FALSE = ("f", "false", "no", "off", "0")


def wire_cast(text: Column, to: T.DataType) -> Column:
    """Text of a wire value as ``to``; null where it does not fit."""
    if isinstance(to, T.BooleanType):
        lowered = F.lower(text)
        return F.when(lowered.isin(*_TRUE), True).when(lowered.isin(*_FALSE), False)
    if isinstance(to, T.TimestampType):
        return F.try_to_timestamp(text)
    if isinstance(to, T.StringType):
        return text
    return text.try_cast(to)


def typed_rows(events: DataFrame, table_schema: T.StructType, image: str = "after") -> DataFrame:
    """The row image as typed columns; text that does not fit is kept in ``_rescued``."""
    held = evaluated_once(events, _image=image_map(F.col(image)))
    cells = {f.name: F.col("_image")[f.name] for f in table_schema.fields}
    typed = {f.name: wire_cast(cells[f.name], f.dataType) for f in table_schema.fields}
    rescued = F.map_filter(
        F.create_map(
            *[
                part
                for name in cells
                for part in (F.lit(name), F.when(typed[name].isNull(), cells[name]))
            ]
        ),
        lambda _, text: text.isNotNull(),
    )
    kept = [c for c in events.columns if c not in table_schema.names and c not in ("before", "after")]
    return held.select(*kept, *[typed[name].alias(name) for name in cells], rescued.alias("_rescued"))


def split_registry_header(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Split a framed message into schema id and body.

    Byte 0 must be 0x00 and bytes 1-4 hold the id, high byte first; anything else
    becomes a row with ``frame_error``.
    """
    value = F.col(value_col)
    long_enough = F.octet_length(value) >= 5
    magic = F.hex(F.substring(value, 1, 1)) == "00"
    error = F.when(~F.coalesce(long_enough, F.lit(False)), "too short").when(~magic, "bad magic byte")
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    good = F.coalesce(long_enough & magic, F.lit(False))
    return df.select(
        *[c for c in df.columns if c != value_col],
        F.when(good, schema_id).alias("schema_id"),
        F.when(good, F.expr(f"substring(`{value_col}`, 6)")).alias("body"),
        error.alias("frame_error"),
    )
