"""Schema history as a table: differences, compatibility, change classes, registration.

The registry holds one JSON schema per (subject, version); ``schema_fields`` turns
it into rows of fields, and everything else compares those rows. The transitive
levels ask about all earlier versions without pairing versions: they use running
counts and the sets of a field's earlier types. Versions are linked once, by slices of
a subject's versions, and what is computed per version or field stays in its slice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ordered import number_rows
from tidemark.functions.rows import evaluated_once
from tidemark.session import written

# Lossless numeric promotions.
PROMOTIONS = ("int>long", "int>float", "int>double", "long>float", "long>double", "float>double")

LEVELS = (
    "NONE", "BACKWARD", "BACKWARD_TRANSITIVE", "FORWARD", "FORWARD_TRANSITIVE", "FULL", "FULL_TRANSITIVE",
)

_KEY = ["subject", "version"]


def canonical_json(schema_json: Column) -> Column:
    """Compact JSON with sorted keys."""
    return F.to_json(F.parse_json(schema_json))


def fingerprint(schema_json: Column) -> Column:
    """First 16 hex digits of the sha256 of the canonical JSON."""
    return F.substring(F.sha2(canonical_json(schema_json), 256), 1, 16)


def _numbered(version: Column) -> Column:
    """The slice of a version: a subject with many versions is spread over its slices."""
    return F.floor(version / 1000).cast("bigint")


def linked_versions(registry: DataFrame) -> DataFrame:
    """Every version with the version and schema before and after it in its subject (null at the ends).

    One shuffle brings a slice of versions together, and neighbours are looked up inside it. Only subjects
    of several slices (``_sliced``) have borders, whose schemas are carried over.
    """
    keyed = registry.where("subject IS NOT NULL AND version IS NOT NULL")
    rows = keyed.select(*_KEY, "schema_json", _numbered(F.col("version")).alias("_slice"))
    each = F.count(F.lit(1)).over(Window.partitionBy("subject"))
    several = rows.select("subject", "_slice").distinct().withColumn("_n", each).where("_n > 1").drop("_n")
    several = written(several, "sliced-subjects")
    inside = Window.partitionBy("subject", "_slice").orderBy("version")
    one = F.struct("version", "schema_json")
    # An explicit shuffle, so that schemas move once and not their fields, even where no neighbour is asked for.
    placed = rows.repartition("subject", "_slice")
    linked = placed.withColumns({"_before": F.lag(one).over(inside), "_after": F.lead(one).over(inside)})
    if several.isEmpty():
        linked = linked.withColumn("_sliced", F.lit(False))
    else:
        ends = linked.join(several.hint("merge"), ["subject", "_slice"], "left_semi").where("_before IS NULL OR _after IS NULL")
        borders = ends.groupBy("subject", "_slice").agg(
            F.min_by(one, "version").alias("_first"), F.max_by(one, "version").alias("_last")
        )
        by_slice = Window.partitionBy("subject").orderBy("_slice")
        carry = borders.select(
            "subject", "_slice", F.lag("_last").over(by_slice).alias("_ended"), F.lead("_first").over(by_slice).alias("_begins"),
            F.lit(True).alias("_many"),
        )
        linked = linked.join(carry.hint("merge"), ["subject", "_slice"], "left").withColumns({
            "_before": F.coalesce("_before", "_ended"), "_after": F.coalesce("_after", "_begins"),
            "_sliced": F.coalesce("_many", F.lit(False)),
        })
    return linked.select(
        *_KEY, "schema_json", "_slice", "_sliced",
        F.col("_before.version").alias("old_version"), F.col("_before.schema_json").alias("old_json"),
        F.col("_after.version").alias("next_version"), F.col("_after.schema_json").alias("next_json"),
    )


_BODY = "struct<fields:array<map<string,string>>>"
_ATTRIBUTES = ("type", "has_default", "default_value", "doc")


def _attributes(field: Column) -> list[Column]:
    """The columns ``_ATTRIBUTES`` of a field's map."""
    return [
        field["type"].alias("type"), F.map_contains_key(field, "default").alias("has_default"),
        field["default"].alias("default_value"), field["doc"].alias("doc"),
    ]


def schema_fields(registry: DataFrame) -> DataFrame:
    """One row per field: subject, version, position, field, type, has_default, default_value, doc.

    A union type keeps its JSON array text. ``old_version`` and ``next_version`` name the neighbours of
    the version; they and their schemas are looked up unless given. ``was`` holds the attributes
    of the field in the version before, ``dropped`` tells that the version after lacks it, and
    ``_leads`` that no earlier field of the version has its name. Rows stay where their slice of versions is.
    """
    linked = registry if "next_json" in registry.columns else linked_versions(registry)
    body = lambda text: F.from_json(text, _BODY)["fields"]
    parsed = evaluated_once(
        linked, _fields=body("schema_json"), _old=body("old_json"),
        _next=F.transform(body("next_json"), lambda f: f["name"]),
    )
    names = F.transform("_fields", lambda f: f["name"])
    # Only names that repeat have to be looked up again.
    parsed = parsed.withColumn("_names", F.when(F.size(F.array_distinct(names)) < F.size(names), names))
    rows = parsed.select(
        *_KEY, "old_version", "next_version", "_slice", "_sliced", "_old", "_next", "_names",
        F.posexplode("_fields").alias("position", "_f"),
    ).withColumn("field", F.col("_f")["name"])
    was = F.get(F.filter("_old", lambda f: f["name"].eqNullSafe(F.col("field"))), F.lit(0))
    held = F.coalesce(F.exists("_next", lambda n: n.eqNullSafe(F.col("field"))), F.lit(False))
    rows = rows.withColumn("_was", was)
    return rows.select(
        *_KEY, "position", "field", *_attributes(F.col("_f")), "old_version", "next_version",
        F.when(F.col("_was").isNotNull(), F.struct(*_attributes(F.col("_was")))).alias("was"),
        (F.col("next_version").isNotNull() & ~held).alias("dropped"),
        F.coalesce(F.array_position("_names", F.col("field")) == F.col("position") + 1, F.lit(True)).alias("_leads"),
        "_slice", "_sliced",
    )


def type_names(kind: Column) -> Column:
    """Type text as an array of names; nested types count by their own ``type``."""
    union = F.from_json(kind, "array<string>")
    names = F.when(F.ltrim(kind).startswith("["), union).otherwise(F.array(kind))
    return F.transform(
        names, lambda t: F.when(t.startswith("{"), F.get_json_object(t, "$.type")).otherwise(t)
    )


def type_compatible(old: Column, new: Column) -> Column:
    """Equal, a superset union, or at least one numeric promotion."""
    return _fits(old, new, type_names(old), type_names(new))


def _fits(old: Column, new: Column, before: Column, after: Column) -> Column:
    """``type_compatible`` for types whose names are known."""
    promoted = F.exists(
        before, lambda o: F.exists(after, lambda n: F.concat(o, F.lit(">"), n).isin(*PROMOTIONS))
    )
    return (old == new) | (F.size(F.array_except(before, after)) == 0) | promoted


def has_default(flag: Column, kind: Column) -> Column:
    """An explicit default, or a union that starts with null."""
    return flag | (F.ltrim(kind).startswith("[") & (F.element_at(type_names(kind), 1) == "null"))


def _side_by_side(fields: DataFrame) -> DataFrame:
    """Fields of each version beside those of the version before it.

    A field row has its own past, and one that the following version lacks is also sent there, as
    ``old`` alone; nothing is shuffled. ``starts`` marks the rows of a subject's first version, which
    has nothing to compare with.
    """
    attributes = F.struct(*[F.col(a) for a in _ATTRIBUTES])
    nothing = F.lit(None).cast(fields.schema["was"].dataType)
    own = F.struct(
        F.col("version").alias("version"), attributes.alias("new"), F.col("was").alias("old"), F.col("old_version").isNull().alias("starts")
    )
    gone = F.struct(
        F.col("next_version").alias("version"), nothing.alias("new"), attributes.alias("old"), F.lit(False).alias("starts")
    )
    sent = F.when(F.col("dropped"), F.array(own, gone)).otherwise(F.array(own))
    return fields.where("_leads").select("subject", "field", F.inline(sent)).select(*_KEY, "field", "new", "old", "starts")


def schema_diff(fields: DataFrame) -> DataFrame:
    """Added, removed and modified fields between consecutive versions."""
    both = _side_by_side(fields).where("NOT starts")
    old, new = F.col("old"), F.col("new")

    def moved(attribute: str) -> Column:
        return ~old[attribute].eqNullSafe(new[attribute])

    kind = (
        F.when(old.isNull(), "added")
        .when(new.isNull(), "removed")
        .when(moved("type") | moved("default_value") | moved("doc"), "modified")
    )
    both = both.withColumn("change", kind).where("change IS NOT NULL")
    changed = F.col("change") == "modified"
    pairs = [
        F.when(changed & moved(a), side[a]).alias(f"{label}_{name}")
        for a, name in (("type", "type"), ("default_value", "default"), ("doc", "doc"))
        for label, side in (("old", old), ("new", new))
    ]
    return both.select(*_KEY, "field", "change", *pairs)


def _issues(level: str) -> Column:
    """Array of issues of one field, from the columns of ``_side_by_side``."""
    old, new, compared = F.col("old"), F.col("new"), ~F.col("starts")
    backward = (
        F.when(old.isNull() & ~has_default(new["has_default"], new["type"]), "missing_default")
        .when(old.isNotNull() & new.isNotNull() & ~type_compatible(old["type"], new["type"]), "type_change")
    )
    forward = F.when(new.isNull() & ~has_default(old["has_default"], old["type"]), "removed_required")
    kinds = []
    if level.startswith(("BACKWARD", "FULL")):
        kinds.append(F.when(compared, backward))
    if level.startswith(("FORWARD", "FULL")):
        kinds.append(F.when(compared, forward))
    return F.array_compact(F.array(*kinds)) if kinds else F.array().cast("array<string>")


def compatibility_issues(fields: DataFrame, level: str) -> DataFrame:
    """Issues of each version against the one before it."""
    both = _side_by_side(fields)
    return both.select(*_KEY, "field", F.explode(_issues(level)).alias("issue"))


def _before_slices(rows: DataFrame) -> DataFrame:
    """What earlier slices say about a slice of versions, for subjects of several: one row per slice.

    ``_versions`` before it, ``_asked`` (fields that some version required) and, per field, how often it was
    held, in which types, and whether it was required.
    """
    several = rows.where("_sliced")
    place = ["subject", "_slice"]
    by_field = Window.partitionBy("subject", "field").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    by_slice = Window.partitionBy("subject").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = several.groupBy(*place, "field").agg(
        F.count(F.lit(1)).alias("_n"), F.collect_set("kind").alias("_kinds"), F.max("needed").alias("_needed")
    )
    known = parts.select(
        *place, "field", F.sum("_n").over(by_field).alias("held"),
        F.array_distinct(F.flatten(F.collect_list("_kinds").over(by_field))).alias("kinds"),
        F.max("_needed").over(by_field).alias("needed"),
    )
    packed = known.where("held IS NOT NULL").groupBy(*place).agg(
        F.collect_list(F.struct("field", "held", "kinds", "needed")).alias("_known")
    )
    first = several.where("needed").groupBy("subject", "field").agg(F.min("_slice").alias("_slice"))
    first = first.groupBy(*place).agg(F.count(F.lit(1)).alias("_new"))
    sizes = several.select(*place, "version").distinct().groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    totals = sizes.join(first.hint("merge"), place, "left").select(
        *place, F.sum("_n").over(by_slice).alias("_versions"), F.sum(F.coalesce("_new", F.lit(0))).over(by_slice).alias("_asked")
    )
    return totals.join(packed.hint("merge"), place, "left")


def _transitive_errors(fields: DataFrame, level: str) -> DataFrame:
    """Every version with the number of its errors against all earlier ones.

    Backwards these are fields that some earlier version lacks or holds in another type, forwards
    fields that an earlier version required and this one lacks. All windows lie in a slice of
    versions, where the field rows are already.
    """
    kind = F.struct(F.col("type").alias("type"), type_names(F.col("type")).alias("names"))
    needed = F.coalesce(~has_default(F.col("has_default"), F.col("type")), F.lit(False))
    narrow = fields.where("_leads").select("subject", "_slice", "_sliced", "version", "field", "type", "has_default")
    rows = evaluated_once(narrow, kind=kind, needed=needed).drop("type", "has_default")
    rows = rows.join(_before_slices(rows).hint("merge"), ["subject", "_slice"], "left").withColumn(
        "_mine", F.get(F.filter("_known", lambda k: k["field"] == F.col("field")), F.lit(0))
    ).drop("_known")

    slice_of = Window.partitionBy("subject", "_slice").orderBy("version")
    of_field = Window.partitionBy("subject", "_slice", "field").orderBy("version")
    upto = of_field.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = of_field.rangeBetween(Window.unboundedPreceding, -1)
    was_needed = F.coalesce(F.col("_mine.needed"), F.lit(False))
    rows = rows.withColumns({
        "_held": F.count(F.lit(1)).over(upto) + F.coalesce("_mine.held", F.lit(0)),
        "_kinds": F.collect_set("kind").over(earlier),
        "_kept": F.coalesce(F.max("needed").over(earlier), F.lit(False)) | was_needed,
        "_fresh": F.col("needed") & (F.count(F.when(F.col("needed"), 1)).over(upto) == 1) & ~was_needed,
    })
    old_types = F.concat("_kinds", F.coalesce("_mine.kinds", F.array().cast(rows.schema["_kinds"].dataType)))
    new = F.col("kind")
    retyped = F.exists(old_types, lambda o: ~_fits(o["type"], new["type"], o["names"], new["names"]))
    rows = rows.select(
        "subject", "_slice", "version", "needed", "_held", "_kept", "_fresh", "_versions", "_asked",
        F.coalesce(retyped, F.lit(False)).cast("int").alias("_retyped"),
    ).withColumns({
        "_nth": F.dense_rank().over(slice_of) + F.coalesce("_versions", F.lit(0)),
        "_before": F.coalesce(
            F.sum(F.col("_fresh").cast("int")).over(slice_of.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ) + F.coalesce("_asked", F.lit(0)),
    })
    # Held in every version so far when both counts agree.
    lacking = (F.col("needed") & (F.col("_held") < F.col("_nth"))).cast("int")
    errors = []
    if level.startswith(("BACKWARD", "FULL")):
        errors.append(F.sum(lacking + F.col("_retyped")))
    if level.startswith(("FORWARD", "FULL")):
        errors.append(F.max("_before") - F.sum(F.col("_kept").cast("int")))
    return rows.groupBy("subject", "_slice", "version").agg(reduce(Column.__add__, errors).cast("bigint").alias("errors"))


def check_compatibility(fields: DataFrame, level: str) -> DataFrame:
    """Verdict and number of issues for every version of every subject.

    Plain levels compare with the version before, ``*_TRANSITIVE`` with all
    earlier ones. Type changes matter backwards only.
    """
    if level not in LEVELS:
        raise ValueError(f"unknown level {level}")
    if level.endswith("TRANSITIVE"):
        counted = _transitive_errors(fields, level)
    else:
        counted = _side_by_side(fields).groupBy(*_KEY).agg(
            F.sum(F.size(_issues(level))).cast("bigint").alias("errors")
        )
    return counted.select(
        *_KEY, F.lit(level).alias("level"), (F.col("errors") == 0).alias("is_compatible"), "errors"
    )


def classify_change(fields: DataFrame) -> DataFrame:
    """none, backward_compatible or breaking for every version after the first.

    A type change breaks even when fields are added at the same time.
    """
    both = _side_by_side(fields).where("NOT starts")
    old, new = F.col("old"), F.col("new")
    nullable = F.array_contains(type_names(new["type"]), "null") & F.ltrim(new["type"]).startswith("[")
    breaking = (
        new.isNull()
        | (old.isNull() & ~(new["has_default"] | nullable))
        | (old.isNotNull() & new.isNotNull() & (old["type"] != new["type"]))
    )
    differs = ~old.eqNullSafe(new)
    return (
        both.groupBy(*_KEY)
        .agg(F.max(F.coalesce(breaking, F.lit(False))).alias("_b"), F.max(differs).alias("_d"))
        .select(
            *_KEY,
            F.when(F.col("_b"), "breaking").when(F.col("_d"), "backward_compatible").otherwise("none").alias(
                "change_type"
            ),
        )
    )


def parse_version(text: Column) -> Column:
    """``v?major.minor[.patch]`` as a struct that compares numerically; null otherwise."""
    pattern = r"^v?(\d+)\.(\d+)(?:\.(\d+))?$"

    def part(i: int) -> Column:
        return F.regexp_extract(text, pattern, i)

    return F.when(
        text.rlike(pattern),
        F.struct(
            part(1).cast("int").alias("major"),
            part(2).cast("int").alias("minor"),
            F.when(part(3) == "", 0).otherwise(part(3).try_cast("int")).alias("patch"),
        ),
    )


def version_text(version: Column) -> Column:
    return F.concat_ws(".", version["major"], version["minor"], version["patch"])


def same_major(a: Column, b: Column) -> Column:
    """Whether two parsed versions promise compatibility."""
    return a["major"] == b["major"]


def suggest_version(current: Column, change_type: Column) -> Column:
    """Next version text: same, minor or major bump."""
    v = parse_version(current)
    return (
        F.when(change_type == "none", version_text(v))
        .when(change_type == "breaking", F.concat_ws(".", v["major"] + 1, F.lit(0), F.lit(0)))
        .otherwise(F.concat_ws(".", v["major"], v["minor"] + 1, F.lit(0)))
    )


def latest_schema(registry: DataFrame) -> DataFrame:
    """The newest version of every subject."""
    return registry.groupBy("subject").agg(
        F.max("version").alias("version"), F.max_by("schema_json", "version").alias("schema_json")
    )


def schema_at(registry: DataFrame, subject: str, version: int) -> DataFrame:
    return registry.where((F.col("subject") == subject) & (F.col("version") == version))


def subjects(registry: DataFrame) -> DataFrame:
    return registry.select("subject").distinct()


def register_versions(registry: DataFrame, candidates: DataFrame, level: str = "BACKWARD") -> DataFrame:
    """Decide on every candidate schema, in order: registered, duplicate or incompatible.

    ``registry`` has subject, version, schema_id, schema_json; ``candidates`` has subject, seq,
    schema_json. A candidate is compared with the newest version of its subject, which may be
    the candidate before it; a duplicate of any version of its subject gets the id that one has.
    All subjects advance together: one round per position, in which every subject that still has
    a candidate has its next one judged. Ids go by round, then subject. Rows that repeat a
    (subject, seq) are judged one after the other.
    """
    order = Window.partitionBy("subject").orderBy("seq", "schema_json")
    pending = written(
        evaluated_once(candidates.select("subject", "seq", "schema_json"), fingerprint=fingerprint(F.col("schema_json")))
        .withColumn("position", F.row_number().over(order)),
        "candidates",
    )
    names = ["subject", "version", "schema_id", "schema_json", "fingerprint"]
    known = written(evaluated_once(registry.select(*names[:4]), fingerprint=fingerprint(F.col("schema_json"))), "known-versions")
    last = pending.agg(F.coalesce(F.max("position"), F.lit(0))).first()[0]
    top = known.agg(F.coalesce(F.max("schema_id"), F.lit(0))).first()[0]
    rounds = []
    for position in range(1, last + 1):
        decided = written(_judged(known, pending.where(F.col("position") == position), level), "decisions")
        fresh = number_rows(decided.where("outcome = 'registered'").select("subject"), [F.col("subject")], "_nth")
        decided = written(
            decided.join(fresh, "subject", "left").withColumn(
                "schema_id", F.when(F.col("outcome") == "registered", F.lit(top) + F.col("_nth")).otherwise(F.col("_known_id"))
            ).drop("_nth"),
            "decisions",
        )
        added = decided.where("outcome = 'registered'").select(*names)
        known, top = known.unionByName(added), top + added.count()
        rounds.append(decided.select("subject", "seq", "outcome", "version", "schema_id", "fingerprint"))
    if not rounds:
        empty = known.where("false")
        return empty.join(candidates.where("false").select("seq"), F.lit(True)).select(
            "subject", "seq", F.lit("").alias("outcome"), "version", "schema_id", "fingerprint"
        )
    return reduce(DataFrame.unionByName, rounds)


def _judged(known: DataFrame, offered: DataFrame, level: str) -> DataFrame:
    """One candidate per subject with its outcome, its version if registered, and the id of its equal as ``_known_id``."""
    mine = known.join(offered.select("subject"), "subject", "left_semi")
    equal = mine.groupBy("subject", "fingerprint").agg(F.min("schema_id").alias("_known_id"))
    newest = mine.groupBy("subject").agg(F.max("version").alias("_latest"), F.max_by("schema_json", "version").alias("_latest_json"))
    judged = written(offered.join(equal, ["subject", "fingerprint"], "left").join(newest, "subject", "left"), "offered")

    none, missing, one, two = F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(1), F.lit(2)
    versions = F.array(
        F.struct(
            one.alias("version"), F.col("_latest_json").alias("schema_json"), none.alias("old_version"), missing.alias("old_json"),
            two.alias("next_version"), F.col("schema_json").alias("next_json"),
        ),
        F.struct(
            two.alias("version"), F.col("schema_json").alias("schema_json"), one.alias("old_version"), F.col("_latest_json").alias("old_json"),
            none.alias("next_version"), missing.alias("next_json"),
        ),
    )
    linked = judged.where("_latest IS NOT NULL").select("subject", F.inline(versions))
    fields = schema_fields(linked.withColumns({"_slice": F.lit(0).cast("bigint"), "_sliced": F.lit(False)}))
    refused = (
        check_compatibility(fields, level)
        .where("version = 2 AND NOT is_compatible")
        .select("subject", F.lit(True).alias("_refused"))
    )
    outcome = (
        F.when(F.col("_refused"), "incompatible").when(F.col("_known_id").isNotNull(), "duplicate").otherwise("registered")
    )
    decided = judged.join(refused, "subject", "left").withColumn("outcome", outcome)
    return decided.select(
        "subject", "seq", "schema_json", "fingerprint", "outcome",
        F.when(F.col("outcome") == "registered", F.coalesce("_latest", F.lit(0)) + 1).alias("version"),
        F.when(F.col("outcome") == "duplicate", F.col("_known_id")).alias("_known_id"),
    )
