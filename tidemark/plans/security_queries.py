"""Encryption, audit and access queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.ordered import time_slice
from tidemark.operators import access, audit, encryption
from tidemark.plans import adapters as a
from tidemark.plans.metric_queries import events
from tidemark.plans.registry import plain, query
from tidemark.session import scratch_path

# Keys of the checks only; real keys come from the caller.
_KEY_TEXT = "0123456789abcdef"
_NEW_KEY_TEXT = "fedcba9876543210"


def _key():
    return F.lit(_KEY_TEXT)


def _new_key():
    return F.lit(_NEW_KEY_TEXT)


def _customers(spark, d):
    return a.customers(spark, d).select(
        "id", "email", "phone",
        F.struct("first_name", F.col("phone").alias("home_phone")).alias("contact"),
        F.array(F.struct(F.col("phone").alias("number"), F.col("first_name").alias("label"))).alias("lines"),
    )


def _sealed(spark, d):
    return encryption.encrypt_fields(_customers(spark, d), _key(), ["EMAIL", "number"], [".*phone"])


query(
    "encrypt_roundtrip",
    a.with_ctes(a.CUSTOMERS)
    + """SELECT id, email, phone, phone AS home_phone, phone AS number, first_name AS label, '' AS problems, true AS was_sealed FROM customers""",
)(
    lambda spark, d: encryption.decrypt_fields(
        _sealed(spark, d).withColumn(
            "was_sealed",
            encryption.is_encrypted(F.col("email"))
            & encryption.is_encrypted(F.col("contact.home_phone"))
            & encryption.is_encrypted(F.col("lines")[0]["number"])
            & ~encryption.is_encrypted(F.col("contact.first_name")),
        ),
        _key(),
    ).select(
        "id", "email", "phone", "contact.home_phone", F.col("lines")[0]["number"].alias("number"),
        F.col("lines")[0]["label"].alias("label"), F.array_join("decrypt_errors", ",").alias("problems"), "was_sealed",
    )
)

def _half_sealed(spark, d):
    """Every third e-mail and every fifth nested phone were sealed with another key."""

    def sealed(name, every):
        value = F.col(name)
        return F.when(F.col("id") % every == 0, encryption.encrypt_value(value, _new_key())).otherwise(
            encryption.encrypt_value(value, _key())
        )

    return a.customers(spark, d).select(
        "id", sealed("email", 3).alias("email"), F.struct(sealed("phone", 5).alias("phone")).alias("contact"),
        F.array(F.struct(sealed("phone", 7).alias("number"))).alias("lines"),
    )


query(
    "decrypt_errors",
    a.with_ctes(a.CUSTOMERS)
    + """SELECT id, CASE WHEN id % 3 <> 0 THEN email END AS email, CASE WHEN id % 5 <> 0 THEN phone END AS phone,
      concat_ws(',', CASE WHEN id % 3 = 0 AND email IS NOT NULL THEN 'email' END,
        CASE WHEN id % 5 = 0 AND phone IS NOT NULL THEN 'contact.phone' END,
        CASE WHEN id % 7 = 0 AND phone IS NOT NULL THEN 'lines.number' END) AS problems FROM customers""",
)(
    lambda spark, d: encryption.decrypt_fields(_half_sealed(spark, d), _key()).select(
        "id",
        # What stays closed is a ciphertext with a random start.
        F.when(~encryption.is_encrypted(F.col("email")), F.col("email")).alias("email"),
        F.when(~encryption.is_encrypted(F.col("contact.phone")), F.col("contact.phone")).alias("phone"),
        F.array_join("decrypt_errors", ",").alias("problems"),
    )
)

query(
    "rotate_roundtrip",
    a.with_ctes(a.CUSTOMERS) + """SELECT id, email, 'k2' AS key_id, 'plain' AS note FROM customers""",
)(
    lambda spark, d: encryption.decrypt_fields(
        encryption.rotate_key(
            a.customers(spark, d).select(
                "id", encryption.encrypt_value(F.col("email"), _key()).alias("email"), F.lit("plain").alias("note")
            ),
            ["email", "note"], _key(), _new_key(), encryption.KeyInfo("k2"),
        ).drop("rotate_errors"),
        _new_key(),
    ).select("id", "email", "key_id", "note")
)

# ---- audit --------------------------------------------------------------------------


def audit_events(spark, d):
    """Events as audit records."""
    return events(spark, d).select(
        F.concat(F.lit("evt-"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("event_id"),
        F.when(F.col("event_type") == "error", "access.denied").otherwise(F.concat(F.lit("data."), "event_type")).alias("event_type"),
        F.col("ts").alias("timestamp"),
        F.expr("CASE WHEN value >= 30 THEN 'CRITICAL' WHEN value >= 20 THEN 'SECURITY' WHEN value >= 10 THEN 'WARNING' ELSE 'INFO' END").alias("level"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user"),
        F.when(F.col("event_type") == "error", "denied").otherwise("ok").alias("result"),
    )


_AUDIT = a.with_ctes(
    """aud AS (SELECT 'evt-' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS event_id,
  CASE WHEN event_type = 'error' THEN 'access.denied' ELSE 'data.' || event_type END AS event_type, ts AS "timestamp",
  CASE WHEN value >= 30 THEN 'CRITICAL' WHEN value >= 20 THEN 'SECURITY' WHEN value >= 10 THEN 'WARNING' ELSE 'INFO' END AS level,
  'user-' || user_id AS "user", CASE WHEN event_type = 'error' THEN 'denied' ELSE 'ok' END AS result FROM events)"""
)

query(
    "audit_query",
    _AUDIT
    + """SELECT event_id, CAST("timestamp" AS VARCHAR) AS "timestamp", "user" FROM aud
      WHERE "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" <= TIMESTAMP '2024-01-25' AND event_type = 'access.denied' AND level = 'INFO'
      ORDER BY aud."timestamp" DESC, event_id DESC LIMIT 50""",
)(
    lambda spark, d: plain(
        audit.query_audit(
            audit_events(spark, d), "2024-01-05", "2024-01-25", event_type="access.denied", level="INFO", limit=50
        ).select("event_id", "timestamp", "user")
    )
)

query(
    "audit_latest",
    _AUDIT + """SELECT event_id, "user" FROM aud ORDER BY "timestamp" DESC, event_id DESC LIMIT 20""",
)(lambda spark, d: audit.latest(audit_events(spark, d), 20).select("event_id", "user"))

query(
    "audit_stats",
    _AUDIT + """SELECT event_type, level, result, count(*) AS events FROM aud GROUP BY 1, 2, 3""",
)(lambda spark, d: audit.audit_counts(audit_events(spark, d), ["event_type", "level", "result"]))

query(
    "denied_bursts",
    _AUDIT
    + """SELECT "user", CAST(CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS VARCHAR) AS window_start, count(*) AS denied FROM aud
      WHERE event_type = 'access.denied' GROUP BY 1, 2 HAVING count(*) >= 2""",
)(lambda spark, d: plain(audit.denied_bursts(audit_events(spark, d), 2, "1 day")))


def _audit_roundtrip(spark, d):
    path = scratch_path(spark, "audit")
    audit.append_audit(audit_events(spark, d), path)
    return audit.read_audit(spark, path, "2024-01-10", "2024-01-12").select("event_id", "level", F.col("day").cast("string").alias("day"))


query(
    "audit_roundtrip",
    _AUDIT
    + """SELECT event_id, level, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day FROM aud
      WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
)(_audit_roundtrip)

_ROTATE = 40


def _numbered(spark, d):
    """Audit records in one log per event type, rotated after forty records."""
    e = audit_events(spark, d).withColumn("log", F.col("event_type"))
    placed = audit.number_lines(e, ["timestamp", "event_id"], time_slice(F.col("timestamp"), 86400), _ROTATE)
    record = F.to_json(F.struct("event_id", "event_type", "level", "user"))
    return placed.select("log", "segment", "position", record.alias("record"))


_NUMBERED = f"""num AS (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY "timestamp", event_id) - 1) AS n FROM aud),
rec AS (SELECT event_type AS log, n // {_ROTATE} AS segment, n % {_ROTATE} AS position,
  '{{"event_id":"' || event_id || '","event_type":"' || event_type || '","level":"' || level || '","user":"' || "user" || '"' AS head FROM num),
chain AS (
  SELECT log, segment, position, head || '}}' AS line FROM rec WHERE position = 0
  UNION ALL
  SELECT r.log, r.segment, r.position, r.head || ',"previous_hash":"' || sha256(c.line) || '"}}'
  FROM chain c JOIN rec r ON r.log = c.log AND r.segment = c.segment AND r.position = c.position + 1)"""

query("build_chain", _AUDIT + f", {_NUMBERED} SELECT log, segment, position, line FROM chain")(
    lambda spark, d: audit.build_chain(_numbered(spark, d))
)


def _tampered(spark, d):
    """Chained segments; in some of them one line was changed afterwards."""
    lines = audit.build_chain(_numbered(spark, d)).withColumn("log", F.concat_ws("/", "log", F.col("segment").cast("string")))
    changed = (F.col("segment") % 5 == 2) & (F.col("position") == 7)
    return lines.withColumn(
        "line", F.when(changed, F.regexp_replace("line", '"user":"', '"user":"x')).otherwise(F.col("line"))
    ).select("log", "position", "line")


query(
    "verify_chain",
    _AUDIT
    + f""", {_NUMBERED} SELECT log || '/' || segment AS log, count(*) AS lines, NOT (segment % 5 = 2 AND count(*) > 8) AS intact,
      CASE WHEN segment % 5 = 2 AND count(*) > 8 THEN 8 END AS first_break FROM rec GROUP BY log, segment""",
)(lambda spark, d: plain(audit.verify_chain(_tampered(spark, d), slice_rows=16)))

# ---- access -------------------------------------------------------------------------

ROLES = (
    *access.DEFAULT_ROLES,
    access.Role("support", ("read:orders:own", "update:orders"), ("loop",)),
    access.Role("loop", ("execute:refund",), ("support",)),
)


def _grants(spark, d):
    users = events(spark, d).select(F.col("user_id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user")).distinct()
    names = F.array(*[F.lit(n) for n in ("admin", "reader", "writer", "operator", "support", "ghost")])
    roles = users.where("user_id % 7 <> 0").select("user", F.element_at(names, (F.col("user_id") % 6 + 1).cast("int")).alias("role"))
    direct = users.where("user_id % 5 = 0").select("user", F.lit("Delete:Orders:own").alias("permission"))
    return access.effective_permissions(roles, ROLES, direct)


_GRANTS = """granted(role, permission) AS (VALUES ('admin', '*:*'), ('reader', 'read:*'), ('reader', 'list:*'), ('writer', 'read:*'), ('writer', 'list:*'),
    ('writer', 'create:*'), ('writer', 'update:*'), ('operator', 'read:*'), ('operator', 'list:*'), ('operator', 'execute:*'),
    ('support', 'read:orders:own'), ('support', 'update:orders'), ('loop', 'execute:refund')),
inherits(role, parent) AS (VALUES ('writer', 'reader'), ('support', 'loop'), ('loop', 'support')),
closure AS (SELECT DISTINCT role, role AS r FROM granted UNION SELECT c.role, i.parent FROM closure c JOIN inherits i ON i.role = c.r),
users AS (SELECT DISTINCT user_id, 'u' || user_id AS "user" FROM events),
perms AS (
  SELECT DISTINCT "user", permission FROM users JOIN closure c ON user_id % 7 <> 0
    AND c.role = ['admin', 'reader', 'writer', 'operator', 'support', 'ghost'][user_id % 6 + 1] JOIN granted g ON g.role = c.r
  UNION SELECT "user", 'delete:orders:own' FROM users WHERE user_id % 5 = 0)"""
_ACCESS = a.with_ctes(_GRANTS)

query("effective_permissions", _ACCESS + 'SELECT "user", permission FROM perms')(
    lambda spark, d: _grants(spark, d)
)


def _requests(spark, d):
    return events(spark, d).select(
        F.col("event_id").alias("request_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
        F.expr("element_at(array('read', 'update', 'delete', 'execute', '*'), cast(event_id % 5 + 1 AS int))").alias("action"),
        F.expr("element_at(array('orders', 'customers', 'refund', '*'), cast(event_id % 4 + 1 AS int))").alias("resource"),
        F.expr("element_at(array(NULL, 'own', 'all', '*'), cast(event_id div 7 % 4 + 1 AS int))").alias("scope"),
    )


_REQUESTS = """req AS (SELECT event_id AS request_id, 'u' || user_id AS "user", ['read', 'update', 'delete', 'execute', '*'][event_id % 5 + 1] AS action,
  ['orders', 'customers', 'refund', '*'][event_id % 4 + 1] AS resource, [NULL, 'own', 'all', '*'][event_id // 7 % 4 + 1] AS scope FROM events),
pp AS (SELECT "user", split_part(permission, ':', 1) AS a, split_part(permission, ':', 2) AS r, nullif(split_part(permission, ':', 3), '') AS s FROM perms)"""

query(
    "access_eval",
    _ACCESS
    + f""", {_REQUESTS} SELECT request_id, EXISTS (SELECT 1 FROM pp WHERE pp."user" = req."user"
        AND (a = action OR a = '*' OR action = '*') AND (r = resource OR r = '*' OR resource = '*')
        AND (s IS NULL OR scope IS NULL OR s = scope OR s = '*' OR scope = '*')) AS allowed FROM req""",
)(
    lambda spark, d: access.evaluate_access(_requests(spark, d), _grants(spark, d)).select("request_id", "allowed")
)

POLICIES = (
    access.Policy("orders", ("read", "update")),
    access.Policy("orders", ("*",), ("execute",)),
    access.Policy("customers", ("read", "delete"), ("delete",)),
    access.Policy("*", ("read", "update", "execute")),
)

query(
    "policy_eval",
    _ACCESS
    + f""", {_REQUESTS} SELECT request_id, action IN ('read', 'update', 'execute') AND CASE resource
        WHEN 'orders' THEN action IN ('read', 'update') AND action <> 'execute'
        WHEN 'customers' THEN action IN ('read', 'delete') AND action <> 'delete' ELSE true END AS allowed FROM req""",
)(lambda spark, d: access.evaluate_policies(_requests(spark, d), POLICIES).select("request_id", "allowed"))
