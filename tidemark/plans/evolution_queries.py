"""Schema history and migration queries; every line item contributes one schema version."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import evolution, migration
from tidemark.plans import adapters as a
from tidemark.plans.registry import plain, query
from tidemark.session import swept, written

_TYPES = ("int", "long", "float", "double", "string", '["null","string"]', '["string","null"]')


def registry(spark, d):
    """Orders are subjects, line numbers versions; each schema has three of five fields."""
    li = a.table(spark, d, "lineitem")
    # Versions count the items of an order over all columns that matter, so repeated line numbers stay apart.
    parts = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    one = li.select(
        "l_orderkey", F.struct(*parts).alias("r"),
        F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", *parts)).alias("version"),
    )
    types = F.array(*[F.lit(t if t.startswith("[") else f'"{t}"') for t in _TYPES])
    fields = []
    for i in range(3):
        kind = F.element_at(types, ((F.col("r.l_suppkey") + i) % len(_TYPES) + 1).cast("int"))
        default = F.when((F.col("r.l_quantity").cast("int") + i) % 3 == 0, ',"default":0').otherwise("")
        doc = F.concat(F.lit(',"doc":"d'), (F.col("version") % 2).cast("string"), F.lit('"')) if i == 0 else F.lit("")
        name = ((F.col("r.l_partkey") + 2 * i) % 5).cast("string")
        fields.append(F.concat(F.lit('{"name":"f'), name, F.lit('","type":'), kind, default, doc, F.lit("}")))
    body = F.concat(F.lit('{"type":"record","name":"row","fields":['), F.concat_ws(",", *fields), F.lit("]}"))
    return one.select(
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("subject"),
        F.col("version").cast("bigint").alias("version"),
        body.alias("schema_json"),
    )


_TYPE_ROWS = ", ".join(f"({i}, '{t}')" for i, t in enumerate(_TYPES))

HISTORY = f"""reg AS (
  SELECT l_orderkey, l_partkey AS pk, l_suppkey AS sk, CAST(l_quantity AS INTEGER) AS q, 'order-' || l_orderkey AS subject,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS version
  FROM lineitem),
fields AS (
  SELECT subject, version, i AS position, 'f' || (pk + 2 * i) % 5 AS field, t.type, (q + i) % 3 = 0 AS has_default,
         CASE WHEN (q + i) % 3 = 0 THEN '0' END AS default_value, CASE WHEN i = 0 THEN 'd' || version % 2 END AS doc,
         (q + i) % 3 = 0 OR t.type LIKE '["null"%' AS filled
  FROM reg, (VALUES (0), (1), (2)) n(i), (VALUES {_TYPE_ROWS}) t(k, type) WHERE t.k = (sk + i) % {len(_TYPES)}),
vers AS (SELECT *, lag(version) OVER (PARTITION BY subject ORDER BY version) AS old_version
  FROM (SELECT DISTINCT subject, version FROM fields)),
news AS (SELECT f.*, v.old_version FROM fields f JOIN vers v USING (subject, version) WHERE v.old_version IS NOT NULL),
olds AS (SELECT f.* REPLACE (v.version AS version), v.old_version FROM fields f
  JOIN vers v ON f.subject = v.subject AND f.version = v.old_version),
both_f AS (SELECT coalesce(n.subject, o.subject) AS subject, coalesce(n.version, o.version) AS version,
    coalesce(n.field, o.field) AS field, n.field IS NULL AS gone, o.field IS NULL AS fresh,
    n.type AS nt, o.type AS ot, n.default_value AS nd, o.default_value AS od, n.doc AS ndoc, o.doc AS odoc,
    n.has_default AS nh, n.filled AS nf, o.filled AS of_
  FROM news n FULL JOIN olds o ON n.subject = o.subject AND n.version = o.version AND n.field = o.field),
promo(o, n) AS (VALUES ('int', 'long'), ('int', 'float'), ('int', 'double'), ('long', 'float'), ('long', 'double'), ('float', 'double')),
compat AS (SELECT x.type AS ot, y.type AS nt, x.type = y.type
    OR (x.type = 'string' AND y.type LIKE '[%') OR (x.type LIKE '[%' AND y.type LIKE '[%')
    OR EXISTS (SELECT 1 FROM promo WHERE o = x.type AND n = y.type) AS fits
  FROM (VALUES {_TYPE_ROWS}) x(k, type), (VALUES {_TYPE_ROWS}) y(k, type))"""

_H = a.with_ctes(HISTORY)


def fields(spark, d):
    """Field rows; the registry is written first, as it would be stored."""
    return evolution.schema_fields(swept(registry(spark, d), "registry"))


query(
    "schema_fields",
    _H + """SELECT subject, version, position, field, type, has_default, default_value, doc FROM fields""",
)(lambda spark, d: plain(
    fields(spark, d).select("subject", "version", "position", "field", "type", "has_default", "default_value", "doc")
))

query(
    "schema_diff",
    _H
    + """SELECT subject, version, field, change,
      CASE WHEN change = 'modified' AND ot <> nt THEN ot END AS old_type, CASE WHEN change = 'modified' AND ot <> nt THEN nt END AS new_type,
      CASE WHEN change = 'modified' AND od IS DISTINCT FROM nd THEN od END AS old_default,
      CASE WHEN change = 'modified' AND od IS DISTINCT FROM nd THEN nd END AS new_default,
      CASE WHEN change = 'modified' AND odoc IS DISTINCT FROM ndoc THEN odoc END AS old_doc,
      CASE WHEN change = 'modified' AND odoc IS DISTINCT FROM ndoc THEN ndoc END AS new_doc
      FROM (SELECT *, CASE WHEN fresh THEN 'added' WHEN gone THEN 'removed'
        WHEN ot <> nt OR od IS DISTINCT FROM nd OR odoc IS DISTINCT FROM ndoc THEN 'modified' END AS change FROM both_f)
      WHERE change IS NOT NULL""",
)(lambda spark, d: evolution.schema_diff(fields(spark, d)))

_BACK = "count(*) FILTER ((fresh AND NOT nf) OR (NOT fresh AND NOT gone AND NOT fits))"
_FORW = "count(*) FILTER (gone AND NOT of_)"
for _level, _errors in (("BACKWARD", _BACK), ("FORWARD", _FORW), ("FULL", f"{_BACK} + {_FORW}")):
    query(
        f"compat_{_level.lower()}",
        _H
        + f""", e AS (SELECT subject, version, {_errors} AS errors FROM both_f LEFT JOIN compat USING (ot, nt) GROUP BY 1, 2)
      SELECT v.subject, v.version, '{_level}' AS level, coalesce(errors, 0) = 0 AS is_compatible, coalesce(errors, 0) AS errors
      FROM vers v LEFT JOIN e USING (subject, version)""",
    )(lambda spark, d, level=_level: plain(evolution.check_compatibility(fields(spark, d), level)))

# All earlier versions, compared the long way round.
_TBACK = """(SELECT count(DISTINCT n.field) FROM fields n WHERE n.subject = v.subject AND n.version = v.version AND NOT n.filled
    AND EXISTS (SELECT 1 FROM vers u WHERE u.subject = v.subject AND u.version < v.version
      AND NOT EXISTS (SELECT 1 FROM fields o WHERE o.subject = u.subject AND o.version = u.version AND o.field = n.field)))
  + (SELECT count(DISTINCT n.field) FROM fields n JOIN fields o ON n.subject = o.subject AND n.field = o.field
       AND o.version < n.version JOIN compat c ON c.ot = o.type AND c.nt = n.type
     WHERE n.subject = v.subject AND n.version = v.version AND NOT c.fits)"""
_TFORW = """(SELECT count(DISTINCT o.field) FROM fields o WHERE o.subject = v.subject AND o.version < v.version AND NOT o.filled
    AND NOT EXISTS (SELECT 1 FROM fields n WHERE n.subject = v.subject AND n.version = v.version AND n.field = o.field))"""
for _level, _errors in (
    ("BACKWARD_TRANSITIVE", _TBACK), ("FORWARD_TRANSITIVE", _TFORW), ("FULL_TRANSITIVE", f"{_TBACK} + {_TFORW}"),
):
    query(
        f"compat_{_level.lower()}",
        _H
        + f"""SELECT subject, version, '{_level}' AS level, errors = 0 AS is_compatible, errors
      FROM (SELECT v.subject, v.version, {_errors} AS errors FROM vers v)""",
    )(lambda spark, d, level=_level: plain(evolution.check_compatibility(fields(spark, d), level)))

query(
    "change_type",
    _H
    + """SELECT subject, version, CASE WHEN bool_or(gone OR (fresh AND NOT (nh OR nt LIKE '[%')) OR (NOT gone AND NOT fresh AND ot <> nt)) THEN 'breaking'
        WHEN bool_or(fresh OR gone OR ot <> nt OR od IS DISTINCT FROM nd OR odoc IS DISTINCT FROM ndoc) THEN 'backward_compatible'
        ELSE 'none' END AS change_type FROM both_f GROUP BY 1, 2""",
)(lambda spark, d: evolution.classify_change(fields(spark, d)))

query(
    "suggested_versions",
    _H
    + """, c AS (SELECT subject, version, bool_or(gone OR (fresh AND NOT (nh OR nt LIKE '[%')) OR (NOT gone AND NOT fresh AND ot <> nt)) AS b,
        bool_or(fresh OR gone OR ot <> nt OR od IS DISTINCT FROM nd OR odoc IS DISTINCT FROM ndoc) AS x FROM both_f GROUP BY 1, 2)
      SELECT subject, version, CASE WHEN b THEN '2.0.0' WHEN x THEN '1.' || (version + 1) || '.0' ELSE '1.' || version || '.0' END AS suggested FROM c""",
)(
    lambda spark, d: evolution.classify_change(fields(spark, d)).select(
        "subject", "version",
        evolution.suggest_version(
            F.concat(F.lit("v1."), F.col("version").cast("string")), F.col("change_type")
        ).alias("suggested"),
    )
)

_CANON = """reg_json AS (
  SELECT r.subject, r.version, '{"fields":[' || string_agg('{' || CASE WHEN has_default THEN '"default":0,' ELSE '' END
      || CASE WHEN doc IS NOT NULL THEN '"doc":"' || doc || '",' ELSE '' END || '"name":"' || field || '","type":'
      || CASE WHEN type LIKE '[%' THEN type ELSE '"' || type || '"' END || '}', ',' ORDER BY position)
      || '],"name":"row","type":"record"}' AS canon
  FROM reg r JOIN fields f USING (subject, version) GROUP BY 1, 2)"""

query(
    "fingerprints",
    a.with_ctes(HISTORY, _CANON) + "SELECT subject, version, substr(sha256(canon), 1, 16) AS fingerprint FROM reg_json",
)(
    lambda spark, d: registry(spark, d).select(
        "subject", "version", evolution.fingerprint(F.col("schema_json")).alias("fingerprint")
    )
)

query(
    "latest_schema",
    a.with_ctes(HISTORY, _CANON)
    + "SELECT subject, max(version) AS version, substr(sha256(arg_max(canon, version)), 1, 16) AS fingerprint FROM reg_json GROUP BY 1",
)(
    lambda spark, d: evolution.latest_schema(registry(spark, d)).select(
        "subject", "version", evolution.fingerprint(F.col("schema_json")).alias("fingerprint")
    )
)


def _register(spark, d):
    """Versions up to 4 are registered (id = order * 10 + version); later ones are offered, and judged one after the other."""
    r = written(registry(spark, d), "registry")
    known = r.where("version <= 4").withColumn(
        "schema_id", F.substring_index("subject", "-", -1).cast("bigint") * 10 + F.col("version")
    )
    return plain(
        evolution.register_versions(known, r.where("version > 4").withColumnRenamed("version", "seq"), "BACKWARD")
        .select("subject", "seq", "outcome", "version", "schema_id")
    )


query(
    "register",
    a.with_ctes(HISTORY, _CANON)
    + """, known AS (SELECT *, CAST(split_part(subject, '-', 2) AS BIGINT) * 10 + version AS schema_id FROM reg_json WHERE version <= 4),
      cand AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY version) AS nth FROM reg_json WHERE version > 4),
      pairs AS (SELECT o.subject, o.version AS o, n.version AS n FROM reg_json o JOIN reg_json n ON n.subject = o.subject AND n.version > o.version AND n.version > 4),
      bad AS (SELECT p.* FROM pairs p WHERE
        EXISTS (SELECT 1 FROM fields n WHERE n.subject = p.subject AND n.version = p.n AND NOT n.filled AND NOT EXISTS (
          SELECT 1 FROM fields o WHERE o.subject = p.subject AND o.version = p.o AND o.field = n.field))
        OR EXISTS (SELECT 1 FROM fields n JOIN fields o ON o.subject = n.subject AND o.field = n.field JOIN compat k ON k.ot = o.type AND k.nt = n.type
          WHERE n.subject = p.subject AND n.version = p.n AND o.version = p.o AND NOT k.fits)),
      same AS (SELECT c.subject, c.version AS n, k.version AS o FROM cand c JOIN reg_json k ON k.subject = c.subject AND k.canon = c.canon AND k.version < c.version),
      walk AS (
        SELECT subject, 0 AS nth, max(version) AS newest, max(version) AS number, list(version) AS held, '' AS outcome, CAST(NULL AS BIGINT) AS seq
        FROM (SELECT subject, version FROM known UNION SELECT subject, NULL FROM cand) GROUP BY 1
        UNION ALL
        SELECT subject, nth, CASE WHEN outcome = 'registered' THEN seq ELSE newest END, number + (outcome = 'registered')::INT,
          CASE WHEN outcome = 'registered' THEN list_append(held, seq) ELSE held END, outcome, seq
        FROM (SELECT w.subject, c.nth, w.newest, coalesce(w.number, 0) AS number, w.held, c.version AS seq,
          CASE WHEN EXISTS (SELECT 1 FROM bad b WHERE b.subject = w.subject AND b.o = w.newest AND b.n = c.version) THEN 'incompatible'
            WHEN EXISTS (SELECT 1 FROM same s WHERE s.subject = w.subject AND s.n = c.version AND list_contains(w.held, s.o)) THEN 'duplicate'
            ELSE 'registered' END AS outcome
          FROM walk w JOIN cand c ON c.subject = w.subject AND c.nth = w.nth + 1)),
      done AS (SELECT * FROM walk WHERE nth > 0),
      ids AS (SELECT subject, version, schema_id FROM known UNION ALL
        SELECT subject, seq, (SELECT max(schema_id) FROM known) + row_number() OVER (ORDER BY nth, subject) FROM done WHERE outcome = 'registered')
      SELECT d.subject, d.seq, d.outcome, CASE WHEN d.outcome = 'registered' THEN d.number END AS version,
        CASE WHEN d.outcome = 'registered' THEN i.schema_id WHEN d.outcome = 'duplicate' THEN
          (SELECT min(x.schema_id) FROM same s JOIN ids x ON x.subject = s.subject AND x.version = s.o
           WHERE s.subject = d.subject AND s.n = d.seq AND list_contains(d.held, s.o)) END AS schema_id
      FROM done d LEFT JOIN ids i ON i.subject = d.subject AND i.version = d.seq""",
)(_register)

query(
    "version_order",
    """SELECT l_orderkey % 97 || '.' || l_linenumber || CASE WHEN l_orderkey % 2 = 0 THEN '.3' ELSE '' END AS text,
      CAST(l_orderkey % 97 AS BIGINT) AS major, CAST(l_linenumber AS BIGINT) AS minor,
      CAST(CASE WHEN l_orderkey % 2 = 0 THEN 3 ELSE 0 END AS BIGINT) AS patch, count(*) AS uses,
      l_orderkey % 97 > 10 OR (l_orderkey % 97 = 10 AND (l_linenumber > 2 OR (l_linenumber = 2 AND l_orderkey % 2 = 0))) AS after_10_2
      FROM lineitem GROUP BY ALL""",
)(
    lambda spark, d: plain(
        a.table(spark, d, "lineitem")
        .select(
            F.concat(
                F.expr("cast(l_orderkey % 97 AS string)"), F.lit("."), F.col("l_linenumber").cast("string"),
                F.when(F.col("l_orderkey") % 2 == 0, ".3").otherwise(""),
            ).alias("text")
        )
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("uses"))
        .withColumn("v", evolution.parse_version(F.col("text")))
        .select(
            "text", "v.major", "v.minor", "v.patch", "uses",
            (F.col("v") > evolution.parse_version(F.lit("v10.2"))).alias("after_10_2"),
        )
    )
)

_PLANS = migration.Migrations(
    [
        migration.Plan("1", "2").rename("name_text", "full_name").add("country", "unknown"),
        migration.Plan("2", "3")
        .change_type("balance", "bigint")
        .transform("full_name", F.upper)
        .copy("full_name", "search_name")
        .remove("country"),
        migration.Plan("1", "9").remove("balance"),
    ]
)


def _mixed(spark, d):
    """Customers written under three schema versions, and some under an unknown one."""
    c = a.table(spark, d, "customer")
    version = F.expr("cast(CASE WHEN c_custkey % 11 = 0 THEN 7 ELSE 1 + c_custkey % 3 END AS string)")
    return c.select(
        "c_custkey",
        version.alias("version"),
        F.when(version == "1", F.col("c_name")).alias("name_text"),
        F.when(version != "1", F.col("c_name")).alias("full_name"),
        F.col("c_acctbal").alias("balance"),
    )


def _migrated(spark, d):
    mixed = _mixed(spark, d)
    done = _PLANS.migrate_all(mixed, "version", "3")
    lost = _PLANS.unmigratable(mixed, "version", "3")
    return done.select("c_custkey", "version", "full_name", "balance", "search_name").unionByName(
        lost.select(
            "c_custkey", "version", "full_name", F.lit(None).cast("bigint").alias("balance"),
            F.lit(None).cast("string").alias("search_name"),
        )
    )


query(
    "migrate_mixed",
    """SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '7' ELSE '3' END AS version,
      CASE WHEN c_custkey % 11 = 0 OR c_custkey % 3 = 2 THEN c_name ELSE upper(c_name) END AS full_name,
      CASE WHEN c_custkey % 11 = 0 OR c_custkey % 3 = 2 THEN NULL ELSE CAST(trunc(c_acctbal) AS BIGINT) END AS balance,
      CASE WHEN c_custkey % 11 = 0 OR c_custkey % 3 = 2 THEN NULL ELSE upper(c_name) END AS search_name
      FROM customer""",
)(
    # Rows already at version 3 keep their exact balance; it is not part of the result.
    lambda spark, d: _migrated(spark, d).withColumn(
        "balance", F.when(F.col("search_name").isNotNull(), F.col("balance").cast("bigint"))
    )
)

_AVSC = """{"type": "record", "name": "event", "fields": [
  {"name": "event_id", "type": "long"},
  {"name": "event_type", "type": {"type": "enum", "name": "kind", "symbols": ["click", "view"]}},
  {"name": "value", "type": ["null", "double"], "default": null},
  {"name": "user_id", "type": "int"},
  {"name": "region", "type": "string", "default": "none"},
  {"name": "session", "type": "string"}]}"""

query(
    "conform",
    """SELECT CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id END AS event_id,
      CASE WHEN event_type IN ('click', 'view') THEN event_type END AS event_type, value,
      CAST(user_id AS BIGINT) AS user_id, 'none' AS region, CASE WHEN event_id % 7 <> 0 THEN 's' || user_id END AS session,
      concat_ws(',', CASE WHEN event_id % 5 = 0 THEN 'event_id' END, CASE WHEN event_type NOT IN ('click', 'view') THEN 'event_type' END,
        CASE WHEN event_id % 7 = 0 THEN 'session' END) AS nonconforming FROM events""",
)(
    lambda spark, d: plain(
        migration.conform(
            a.table(spark, d, "events").select(
                F.expr("CASE WHEN event_id % 5 = 0 THEN concat('x', event_id) ELSE cast(event_id AS string) END").alias("event_id"),
                "event_type", "value", "user_id",
                F.expr("CASE WHEN event_id % 7 <> 0 THEN concat('s', user_id) END").alias("session"),
            ),
            migration.declared_struct(_AVSC),
        ).withColumn("nonconforming", F.array_join("nonconforming", ","))
    )
)

query(
    "converters",
    """SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS BIGINT), 0) AS number,
      CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS text,
      strftime(make_timestamp(event_id * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS iso, event_id * 1000 AS ms,
      json_extract_string(props, '$.k') AS k, CASE WHEN event_id % 3 = 0 THEN '{}' ELSE '{"k":"' || json_extract_string(props, '$.k') || '"}' END AS json
      FROM events""",
)(
    lambda spark, d: (
        lambda e: e.select(
            "event_id",
            migration.string_to_int(F.expr("CASE WHEN event_id % 3 <> 0 THEN cast(user_id AS string) END")).alias("number"),
            migration.int_to_string(F.expr("CASE WHEN event_id % 3 <> 0 THEN user_id END")).alias("text"),
            migration.epoch_ms_to_iso(F.col("event_id") * 1000).alias("iso"),
            migration.iso_to_epoch_ms(migration.epoch_ms_to_iso(F.col("event_id") * 1000)).alias("ms"),
            migration.json_to_map(F.col("props"))["k"].alias("k"),
            migration.map_to_json(
                F.when(F.col("event_id") % 3 != 0, migration.json_to_map(F.col("props")))
            ).alias("json"),
        )
    )(a.table(spark, d, "events"))
)
