"""Building, keying, ordering and routing change events; transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lsn import lsn_to_num
from tidemark.functions.ordered import running_sum_in_series
from tidemark.session import swept, written
from tidemark.sources.events import uuid_from


def _present(image: Column) -> Column:
    """An image counts when it is an object with at least one key."""
    return F.coalesce(F.size(F.json_object_keys(image)) > 0, F.lit(False))


def entity_key(before: str = "before", after: str = "after", event_id: str = "event_id") -> Column:
    """``id`` of the after image, or of the before image when after is absent or empty.

    When the chosen image has no ``id`` the event id is the key.
    """
    image = F.when(_present(F.col(after)), F.col(after)).otherwise(F.col(before))
    return F.coalesce(F.get_json_object(image, "$.id"), F.col(event_id))


def order_by_entity(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """Same entity, same partition, in log order inside it.

    This layout is a promise to consumers, so one entity is never split; use the
    keyed operators in ``changes`` for work that must survive a hot entity.
    """
    keyed = events.withColumn("entity_key", entity_key())
    placed = keyed.repartition(partitions, "entity_key") if partitions else keyed.repartition("entity_key")
    return placed.sortWithinPartitions("entity_key", "lsn_num", "event_id")


def topic_name(source: str = "source", template: str = "cdc.{database}.{schema}.{table}") -> Column:
    """Topic of an event; the template may use database, schema and table."""
    out: Column = F.lit(template)
    for part in ("database", "schema", "table"):
        out = F.replace(out, F.lit("{" + part + "}"), F.col(source)[part])
    return out


def split_by_table(events: DataFrame, tables: Sequence[str]) -> dict[str, DataFrame]:
    """One lazy frame per table name."""
    return {name: events.where(F.col("source")["table"] == name) for name in tables}


_KEEP_NULLS = {"ignoreNullFields": "false"}


def _envelope(
    rows: DataFrame, source: tuple[str, str, str], operation: Column, key: Column, before: Column, after: Column,
    at: Column | None, lsn: Column | None, xid: Column | None, schema_version: int,
) -> DataFrame:
    """Events with the columns that ``parse_events`` gives, and ``entity_key``.

    The id follows from the content, so a recomputed task gives the same one and equal
    changes at equal positions are duplicates.
    """
    position = F.lit(None).cast("string") if lsn is None else lsn.cast("string")
    moved = rows.select(
        F.struct(
            *[F.lit(v).alias(n) for n, v in zip(("database", "schema", "table"), source)],
            (F.lit(None) if xid is None else xid).cast("bigint").alias("transaction_id"),
            position.alias("lsn"), F.lit(None).cast("string").alias("connector_version"),
        ).alias("source"),
        operation.alias("operation"), key.cast("string").alias("entity_key"), before.alias("before"), after.alias("after"),
        (F.current_timestamp() if at is None else at.cast("timestamp")).alias("event_timestamp"),
    )
    content = F.to_json(F.struct("source", "operation", "entity_key", "before", "after"))
    return moved.select(
        uuid_from(content).alias("event_id"), "event_timestamp", "source", lsn_to_num(F.col("source.lsn")).alias("lsn_num"),
        "operation", "entity_key", "before", "after", F.lit(schema_version).alias("schema_version"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
    )


def to_change_events(
    df: DataFrame,
    operation: str,
    table: str,
    key: str,
    database: str = "source_db",
    schema: str = "public",
    at: Column | None = None,
    lsn: Column | None = None,
    xid: Column | None = None,
    schema_version: int = 1,
) -> DataFrame:
    """Rows as whole change events of one kind, as ``parse_events`` would give them.

    INSERT carries the row as ``after``, DELETE as ``before``. For UPDATE ``df``
    needs struct columns ``before`` and ``after``. ``at``, ``lsn`` and ``xid`` are expressions over
    ``df``; without ``at`` the time is now, and events without a position cannot be folded in order.
    """
    nothing = F.lit(None).cast("string")
    if operation == "UPDATE":
        old, new = F.to_json("before", _KEEP_NULLS), F.to_json("after", _KEEP_NULLS)
        name = F.col("after")[key]
    else:
        row = F.to_json(F.struct(*[F.col(c) for c in df.columns]), _KEEP_NULLS)
        old, new = (row, nothing) if operation == "DELETE" else (nothing, row)
        name = F.col(key)
    return _envelope(df, (database, schema, table), F.lit(operation), name, old, new, at, lsn, xid, schema_version)


def diff_snapshots(
    old: DataFrame, new: DataFrame, key: str, table: str, database: str = "source_db", schema: str = "public",
    at: Column | None = None, lsn: Column | None = None, schema_version: int = 1,
) -> DataFrame:
    """The change log that turns snapshot ``old`` into ``new``: one full outer join on the key.

    ``at`` and ``lsn`` are the time and position of the new snapshot, the same for all its changes.
    """
    columns = new.columns
    left = old.select(F.col(key).alias("_key"), F.struct(*[F.col(c) for c in columns]).alias("_old"))
    right = new.select(F.col(key).alias("_key"), F.struct(*[F.col(c) for c in columns]).alias("_new"))
    both = left.join(right, "_key", "full_outer")
    operation = (
        F.when(F.col("_old").isNull(), "INSERT")
        .when(F.col("_new").isNull(), "DELETE")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "UPDATE")
    )
    changed = both.withColumn("operation", operation).where("operation IS NOT NULL")
    return _envelope(
        changed, (database, schema, table), F.col("operation"), F.col("_key"),
        F.to_json("_old", _KEEP_NULLS), F.to_json("_new", _KEEP_NULLS), at, lsn, None, schema_version,
    )


def to_messages(events: DataFrame) -> DataFrame:
    """Events as wire messages: the topic of the table, the entity as message key, and the JSON envelope."""
    envelope = F.struct(
        "event_id", F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_timestamp"),
        "operation", "source", F.try_parse_json("before").alias("before"), F.try_parse_json("after").alias("after"),
        "schema_version", "metadata",
    )
    return events.select(topic_name().alias("topic"), F.col("entity_key").alias("key"), F.to_json(envelope).cast("binary").alias("value"))


def assemble_transactions(
    log: DataFrame, slice_steps: int = 1 << 30, tie_break: Sequence[str] = ("event_id",)
) -> DataFrame:
    """Row changes of committed transactions, numbered inside each.

    ``log`` has type (BEGIN, INSERT, UPDATE, DELETE, COMMIT), xid, lsn and the row
    columns. Output is one row per change with its commit position and place in
    the transaction, never an array per transaction, so a bulk load in one
    transaction stays spread. Open and empty transactions give no rows.

    The log is written once, as changes and commits both come from it, and commits are
    joined by merge: they are too many to broadcast, and skew handling needs plain shuffles on both sides.
    """
    rows = swept(log.withColumn("lsn_num", lsn_to_num(F.col("lsn"))), "decoded-log")
    commits = rows.where("type = 'COMMIT'").groupBy("xid").agg(
        F.min("lsn_num").alias("commit_lsn_num"), F.min_by("lsn", "lsn_num").alias("commit_lsn")
    )
    changes = rows.where(F.col("type").isin("INSERT", "UPDATE", "DELETE")).join(
        written(commits, "commits").hint("merge"), "xid"
    )
    return running_sum_in_series(
        written(changes, "committed-changes"),
        ["xid"],
        ["lsn_num", *tie_break],
        {"position": F.lit(1)},
        F.floor(F.col("lsn_num") / F.lit(slice_steps)).cast("bigint"),
    )


def transaction_summary(assembled: DataFrame) -> DataFrame:
    """One row per committed transaction."""
    return assembled.groupBy("xid", "commit_lsn").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("lsn_num").alias("first_lsn_num"),
        F.max("lsn_num").alias("last_lsn_num"),
    )
