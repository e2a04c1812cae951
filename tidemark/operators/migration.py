"""Bringing rows of one schema version to another."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.events import wire_cast

#: The columns of a row while it moves: name -> expression over the stored columns, in order.
Fields = dict[str, Column]
Step = Callable[[Fields], Fields]


@dataclass
class Plan:
    """Ordered steps from one version to the next; each returns the plan for chaining.

    Steps on absent columns do nothing, and ``add`` leaves a present one alone. A step rewrites
    expressions, so plans and chains of plans become one projection.
    """

    source: str
    target: str
    steps: list[Step] = field(default_factory=list)

    def _then(self, step: Step) -> Plan:
        self.steps.append(step)
        return self

    def add(self, name: str, default=None, kind: str = "string") -> Plan:
        def step(row: Fields) -> Fields:
            return row if name in row else {**row, name: F.lit(None).cast(kind) if default is None else F.lit(default)}

        return self._then(step)

    def remove(self, name: str) -> Plan:
        return self._then(lambda row: {n: c for n, c in row.items() if n != name})

    def rename(self, old: str, new: str) -> Plan:
        """A present ``new`` gives way to ``old`` and is kept where ``old`` is null, as in tables of many versions."""

        def step(row: Fields) -> Fields:
            if old not in row or old == new:
                return row
            if new not in row:
                return {new if n == old else n: c for n, c in row.items()}
            return {n: F.coalesce(row[old], c) if n == new else c for n, c in row.items() if n != old}

        return self._then(step)

    def copy(self, old: str, new: str) -> Plan:
        return self._then(lambda row: {**row, new: row[old]} if old in row else row)

    def transform(self, name: str, how: Callable[[Column], Column]) -> Plan:
        """``how`` maps the column; where no expression exists, call a pandas UDF in it."""
        return self._then(lambda row: {**row, name: how(row[name])} if name in row else row)

    def change_type(self, name: str, kind: str) -> Plan:
        return self.transform(name, lambda c: c.try_cast(kind))

    def add_fields(self, defaults: Mapping) -> Plan:
        for name, default in defaults.items():
            self.add(name, default)
        return self

    def remove_fields(self, names: Sequence[str]) -> Plan:
        for name in names:
            self.remove(name)
        return self

    def rename_fields(self, names: Mapping[str, str]) -> Plan:
        for old, new in names.items():
            self.rename(old, new)
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        return _projected(df, [self])


def _compiled(df: DataFrame, chain: Sequence[Plan]) -> Fields:
    """The columns of ``df`` after all steps of a chain."""
    row = {name: F.col(f"`{name}`") for name in df.columns}
    return reduce(lambda r, step: step(r), [s for plan in chain for s in plan.steps], row)


def _projected(df: DataFrame, chain: Sequence[Plan]) -> DataFrame:
    return df.select(*[c.alias(name) for name, c in _compiled(df, chain).items()])


class Migrations:
    """Known plans, and the shortest chain of them between two versions."""

    def __init__(self, plans: Sequence[Plan] = ()):
        self._plans: dict[str, list[Plan]] = {}
        for plan in plans:
            self.add(plan)

    def add(self, plan: Plan) -> Migrations:
        self._plans.setdefault(plan.source, []).append(plan)
        return self

    def sources(self) -> list[str]:
        return sorted(self._plans)

    def path(self, source: str, target: str) -> list[Plan] | None:
        """Fewest plans from ``source`` to ``target``; empty for the same version."""
        waiting = deque([(source, [])])
        reached = {source}
        while waiting:
            version, chain = waiting.popleft()
            if version == target:
                return chain
            for plan in self._plans.get(version, []):
                if plan.target not in reached:
                    reached.add(plan.target)
                    waiting.append((plan.target, [*chain, plan]))
        return None

    def migrate(self, df: DataFrame, source: str, target: str) -> DataFrame:
        chain = self.path(source, target)
        if chain is None:
            raise ValueError(f"no migration from {source} to {target}")
        return _projected(df, chain)

    def migrate_all(self, df: DataFrame, version_col: str, target: str) -> DataFrame:
        """Rows of many versions as one table at ``target``; see ``unmigratable`` for the rest.

        The chains of all versions become one projection that chooses by the row's version, so the
        table is read once. A column that a version's chain does not yield is null in its rows; a pandas
        UDF in a chain sees the rows of all versions.
        """
        version = F.col(f"`{version_col}`")
        chains = {v: self.path(v, target) for v in sorted({*self.sources(), target})}
        rows = {v: _compiled(df, chain) for v, chain in chains.items() if chain is not None}
        names = dict.fromkeys(name for row in rows.values() for name in row if name != version_col)

        def of(name: str) -> Column:
            parts = [(v, row[name]) for v, row in rows.items() if name in row]
            return reduce(lambda acc, p: acc.when(version == p[0], p[1]), parts[1:], F.when(version == parts[0][0], parts[0][1]))

        return df.where(version.isin(*rows)).select(*[of(n).alias(n) for n in names], F.lit(target).alias(version_col))

    def unmigratable(self, df: DataFrame, version_col: str, target: str) -> DataFrame:
        """Rows whose version has no way to ``target``."""
        versions = [v for v in {*self.sources(), target} if self.path(v, target) is not None]
        return df.where(F.col(version_col).isNull() | ~F.col(version_col).isin(*versions))


# ---- value converters ---------------------------------------------------------------


def string_to_int(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.when(c.isNull(), F.lit(0)))


def int_to_string(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def epoch_ms_to_iso(c: Column) -> Column:
    """Milliseconds to ISO text in UTC; the fraction appears only when there is one."""
    moment = F.timestamp_millis(c)
    whole = c % 1000 == 0
    return F.when(whole, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )


def iso_to_epoch_ms(c: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(c))


def json_to_map(c: Column) -> Column:
    return F.from_json(F.coalesce(c, F.lit("{}")), T.MapType(T.StringType(), T.StringType()))


def map_to_json(c: Column) -> Column:
    return F.coalesce(F.to_json(c), F.lit("{}"))


# ---- conforming to a declared schema ------------------------------------------------

# Primitive type names of the schema language.
_PRIMITIVES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
}


def _spark_type(kind) -> tuple[T.DataType, bool]:
    """Spark type of a declared type, and whether null is allowed."""
    if isinstance(kind, list):
        real = [k for k in kind if k != "null"]
        return _spark_type(real[0])[0], "null" in kind
    if isinstance(kind, dict):
        if kind.get("logicalType", "").startswith("timestamp"):
            return T.TimestampType(), False
        if kind["type"] == "record":
            return declared_struct(kind), False
        if kind["type"] == "map":
            return T.MapType(T.StringType(), _spark_type(kind["values"])[0]), False
        if kind["type"] == "array":
            return T.ArrayType(_spark_type(kind["items"])[0]), False
        if kind["type"] == "enum":
            return T.StringType(), False
        return _spark_type(kind["type"])
    return _PRIMITIVES[kind], False


def _symbols(kind) -> list[str] | None:
    """Symbols of a declared enum, or of the enum in a union."""
    parts = kind if isinstance(kind, list) else [kind]
    return next((p["symbols"] for p in parts if isinstance(p, dict) and p["type"] == "enum"), None)


def declared_struct(schema: str | dict) -> T.StructType:
    """A record schema as StructType; defaults and enum symbols go into the field metadata."""
    record = json.loads(schema) if isinstance(schema, str) else schema
    fields = []
    for f in record["fields"]:
        kind, nullable = _spark_type(f["type"])
        extra = {"default": json.dumps(f["default"])} if "default" in f else {}
        if _symbols(f["type"]):
            extra["symbols"] = _symbols(f["type"])
        fields.append(T.StructField(f["name"], kind, nullable, extra))
    return T.StructType(fields)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the schema with defaults for missing values.

    ``nonconforming`` lists fields whose value does not fit, or that are required
    and have neither value nor default. An enum takes its symbols only.
    """
    columns, faults = [], []
    for f in schema.fields:
        have = f.name in df.columns
        raw = F.col(f.name) if have else F.lit(None).cast("string")
        nested = isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType))
        same = have and df.schema[f.name].dataType == f.dataType
        value = raw if same or nested and have else wire_cast(raw.cast("string"), f.dataType) if not nested else F.lit(None).cast(f.dataType)
        if "symbols" in f.metadata:
            value = F.when(value.isin(*f.metadata["symbols"]), value)
        default = json.loads(f.metadata["default"]) if "default" in f.metadata else None
        filled = value
        if default is not None:
            fallback = F.from_json(F.lit(f.metadata["default"]), f.dataType) if nested else F.lit(default).cast(f.dataType)
            filled = F.coalesce(value, F.when(raw.isNull(), fallback))
        missing = raw.isNull() & filled.isNull() if "default" not in f.metadata and not f.nullable else F.lit(False)
        faults.append(F.when(missing | (raw.isNotNull() & value.isNull()), F.lit(f.name)))
        columns.append(filled.alias(f.name))
    return df.select(*columns, F.array_compact(F.array(*faults)).alias("nonconforming"))
