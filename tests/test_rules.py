"""Edge rules on small frames."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lsn import lsn_to_num, num_to_lsn
from tidemark.functions.ordered import number_rows, previous_in_series, running_sum_in_series
from tidemark.operators import (
    access, alerts, changes, dlq, encryption, envelope, evolution, fanout, metrics, migration, quality, regions,
    replica, stages,
)
from tidemark.sources.events import parse_events, typed_rows

SOURCE = {"database": "source_db", "schema": "public", "table": "customers", "transaction_id": 12345, "lsn": "0/ABC123"}
UUID = "00000000-0000-0000-0000-00000000000{}"


def event(n, operation="INSERT", before=None, after=None, **more):
    return json.dumps(
        {"event_id": UUID.format(n), "operation": operation, "source": SOURCE, "before": before, "after": after, **more},
        ensure_ascii=False,
    )


def raw(spark, values):
    rows = [
        Row(value=v.encode() if isinstance(v, str) else v, topic="t", partition=0, offset=i)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "value binary, topic string, partition int, offset bigint")


def test_parse_kinds(spark):
    values = [
        event(1, after={"id": 1}), "{invalid json", "", bytes.fromhex("00FF807FABCD"), '{"foo":"bar","baz":123}',
        None, "[1]", json.dumps({"event_id": "x", "operation": "INSERT", "source": None, "after": {"id": 1}}),
    ]
    got = {r.offset: (r.deser_error, r.schema_error) for r in parse_events(raw(spark, values)).collect()}
    assert got == {
        0: (None, None), 1: ("invalid JSON", None), 2: ("empty message", None), 3: ("invalid UTF-8", None),
        4: (None, "source"), 6: (None, "not an object"), 7: (None, "source"),
    }


def test_parse_checks_json_types_and_epoch_times(spark):
    def with_source(**more):
        return json.dumps({"event_id": "x", "operation": "DELETE", "source": {**SOURCE, **more}, "before": {"id": 1}})

    plain_event = {"operation": "DELETE", "source": SOURCE, "before": {"id": 1}}
    values = [
        json.dumps({"event_id": 12, **plain_event}), json.dumps({"event_id": None, **plain_event}), with_source(database=5),
        with_source(table=["a"]), with_source(schema=True), with_source(),
        *[json.dumps({"event_id": "x", "event_timestamp": t, **plain_event}) for t in (1700000000, 1700000000.25, 1700000000250, "2023-11-14T22:13:20Z", "soon", True)],
    ]
    rows = parse_events(raw(spark, values)).orderBy("offset")
    assert [r.schema_error for r in rows.collect()] == [
        "event_id", None, "source.database", "source.table", "source.schema", None, None, None, None, None, "event_timestamp", "event_timestamp",
    ]
    at = rows.selectExpr("offset", "unix_micros(event_timestamp) AS t").where("offset BETWEEN 6 AND 9").collect()
    assert [r.t for r in at] == [1_700_000_000_000_000, 1_700_000_000_250_000, 1_700_000_000_250_000, 1_700_000_000_000_000]
    assert rows.where("offset = 1").first().event_id


def test_parse_keeps_unicode_and_large_images(spark):
    big = {f"f{i}": "x" * 1000 for i in range(1000)}
    names = {"id": 7, "name": "日本語 🎉 Привет مرحبا", "none": None}
    rows = parse_events(raw(spark, [event(1, after=big), event(2, after=names)])).orderBy("offset").collect()
    assert json.loads(rows[0].after) == big
    assert json.loads(rows[1].after) == names


def test_pass_rate_of_five_valid_and_three_invalid(spark):
    good = [event(i, after={"id": i + 1, "email": "a@b.co"}) for i in range(5)]
    bad = [event(6, operation="NOPE", after={"id": 1, "email": "a@b.co"}), event(7), event(8, operation="DELETE")]
    stats = stages.stage_stats(stages.stage_events(raw(spark, good + bad))).first()
    assert (stats.quality_passed, stats.quality_failed, stats.quality_pass_rate) == (5, 3, 62.5)


def test_pass_rate_is_full_when_nothing_was_checked(spark):
    assert stages.stage_stats(stages.stage_events(raw(spark, ["{bad"]))).first().quality_pass_rate == 100.0


def test_dead_letter_keeps_the_original_event(spark):
    odd = {"id": 0, "nested": {"list": [1, {"a": None}]}, "name": "名前", "email": "a@b.co"}
    text = event(1, after=odd)
    entry = stages.rejected(stages.stage_events(raw(spark, [text]))).first()
    assert entry.failure_reason == "quality_failure"
    assert entry.original_event == text
    again = dlq.replay_dlq(stages.rejected(stages.stage_events(raw(spark, [text]))), ["quality_failure"]).first()
    assert bytes(again.value).decode() == text and again.retry_count == 1


def test_unreadable_messages_are_kept_byte_for_byte(spark):
    for text in ("{broken" + "x" * 700, "name=1"):
        entries = stages.rejected(stages.stage_events(raw(spark, [text])))
        assert bytes(dlq.replay_dlq(entries, ["deser_error"]).first().value).decode() == text


def test_only_one_json_value_is_an_event(spark):
    one = event(1)
    for text in (one + " trailing", one + one, one + "," + one, one + "]", one.replace('"', "'")):
        assert parse_events(raw(spark, [text])).first().deser_error is not None, text
    listed = event(1, after={"id": 1, "list": [{"a": 1}, {"b": "} x"}]})
    assert parse_events(raw(spark, [listed])).first().deser_error is None


def test_quality_message_counts_the_rest(spark):
    df = spark.range(1).select(
        F.array(*[F.struct(F.lit(f"m{i}").alias("message")) for i in range(5)]).alias("failures")
    )
    assert df.select(dlq.quality_message()).first()[0] == "Quality checks failed: m0, m1, m2 (and 2 more)"


def test_rules(spark):
    rules = quality.Checker("c").add(
        quality.required("a"), quality.type_is("b", "int"), quality.in_range("n", 1, 10),
        quality.matches("p", "ab"), quality.one_of("e", ["x"]),
        quality.custom("boom", lambda v: F.lit(None).cast("boolean"), "null is a failure"),
    )
    rows = spark.createDataFrame(
        [('{"a":"","b":true,"n":10,"p":"abc","e":"x"}',), ('{"b":1.5,"n":"5","p":"xab","e":"y"}',), ('{"a":1}',)], "j string"
    )
    got = [[f.rule for f in r.failures] for r in rules.apply(rows, "j").collect()]
    assert got == [
        ["boom"], ["required_a", "type_b", "range_n", "pattern_p", "enum_e", "boom"], ["boom"],
    ]


def test_warnings_can_pass(spark):
    df = spark.createDataFrame([(None,)], "a string")
    checker = quality.Checker("c").add(quality.required("a", quality.WARNING))
    assert not checker.apply(df).first().passed
    assert checker.apply(df, fail_on="error").first().passed


def test_lsn(spark):
    df = spark.createDataFrame([("0/9",), ("0/10",), ("16/B374D848",), ("FFFFFFFF/FFFFFFFF",), ("bad",)], "l string")
    got = df.select(lsn_to_num(F.col("l")).alias("n")).withColumn("t", num_to_lsn(F.col("n"))).collect()
    assert [int(r.n) if r.n is not None else None for r in got] == [9, 16, 0x16B374D848, 2**64 - 1, None]
    assert got[2].t == "16/B374D848" and got[0].t == "0/00000009"


def test_entity_key(spark):
    df = spark.createDataFrame(
        [("e1", '{"id":1}', '{"id":2}'), ("e2", '{"id":1}', "{}"), ("e3", '{"id":1}', '{"x":2}'), ("e4", None, None)],
        "event_id string, before string, after string",
    )
    assert [r[0] for r in df.select(envelope.entity_key()).collect()] == ["2", "1", "e3", "e4"]


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])


def log(spark, *rows):
    return spark.createDataFrame(
        [(f"e{n}", n, op, before, after) for n, op, before, after in rows],
        "event_id string, lsn_num bigint, operation string, before string, after string",
    ).withColumn("lsn_num", F.col("lsn_num").cast("decimal(20,0)"))


def test_fold_tells_absent_null_and_unchanged_apart(spark):
    events = log(
        spark,
        (1, "INSERT", None, '{"id":0,"a":"x","b":1}'),
        (2, "UPDATE", None, '{"id":0,"b":null}'),
        (3, "UPDATE", None, '{"id":0,"a":"__unchanged__"}'),
        (4, "INSERT", None, '{"id":1,"a":"y","b":2}'),
        (5, "DELETE", '{"id":1}', None),
        (6, "UPDATE", None, '{"id":1,"b":9}'),
        (7, "INSERT", None, '{"id":2,"a":"z"}'),
        (8, "DELETE", '{"id":2}', None),
        (9, "DELETE", '{"id":77}', None),
    )
    got = sorted(tuple(r) for r in changes.latest_state(events, SCHEMA).drop("_lsn").collect())
    assert got == [(0, "x", None), (1, None, 9)]
    replica_rows = changes.apply_changes(changes.empty_replica(spark, SCHEMA), events, SCHEMA)
    assert sorted(tuple(r) for r in changes.live_rows(replica_rows).collect()) == got
    twice = changes.apply_changes(replica_rows, events, SCHEMA)
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, replica_rows.collect()), key=str)


def test_late_change_does_not_undo_a_newer_one(spark):
    first = changes.apply_changes(
        changes.empty_replica(spark, SCHEMA), log(spark, (5, "DELETE", '{"id":1}', None), (6, "INSERT", None, '{"id":2,"a":"new"}')), SCHEMA
    )
    late = log(spark, (3, "UPDATE", None, '{"id":1,"a":"ghost"}'), (4, "UPDATE", None, '{"id":2,"a":"old"}'))
    assert [tuple(r) for r in changes.live_rows(changes.apply_changes(first, late, SCHEMA)).collect()] == [(2, "new", None)]


def test_replica_batch_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "replica")
    replica.create_replica(spark, path, SCHEMA)
    one = log(spark, *[(i, "INSERT", None, f'{{"id":{i},"a":"v"}}') for i in range(20)])
    two = log(spark, (30, "UPDATE", None, '{"id":3,"b":5}'), (31, "DELETE", '{"id":4}', None))
    for n, batch in ((0, one), (1, two), (1, two)):
        replica.apply_batch(spark, path, batch, n, SCHEMA)
    rows = {r.id: (r.a, r.b) for r in replica.read_replica(spark, path, SCHEMA).collect()}
    assert len(rows) == 19 and rows[3] == ("v", 5) and 4 not in rows


def test_replica_runs_against_batches_applied_one_by_one(spark, tmp_path, monkeypatch):
    """Late and repeated changes over many batches, through levels and a new base, with old folders gone."""
    import os
    import random

    monkeypatch.setattr(replica, "FANOUT", 3)
    monkeypatch.setattr(replica, "SMALL_BASE", 40)
    draw, path = random.Random(3), str(tmp_path / "replica")
    replica.create_replica(spark, path, SCHEMA)
    want, levels = changes.empty_replica(spark, SCHEMA), set()
    for n in range(11):
        rows = []
        for _ in range(8):
            i, lsn = draw.randrange(20), draw.randrange(200)
            kind = draw.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
            image = f'{{"id":{i},"a":"{lsn}"}}' if draw.random() < 0.5 else f'{{"id":{i},"b":{lsn}}}'
            rows.append((lsn, kind, image if kind == "DELETE" else None, None if kind == "DELETE" else image))
        batch = log(spark, *rows)
        for _ in range(2 if n in (4, 7) else 1):
            replica.apply_batch(spark, path, batch, n, SCHEMA)
        levels |= {r.level for r in replica.runs(spark, path)}
        want = spark.createDataFrame(changes.apply_changes(want, batch, SCHEMA).collect(), changes.replica_schema(SCHEMA))
        got = replica.read_replica(spark, path, SCHEMA, with_tombstones=True)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), n
    assert levels >= {-1, 0, 1} and any(r.name.endswith("base") for r in replica.runs(spark, path))
    named = {r.name for b in (None, 10) for r in replica.runs(spark, path, b)}
    assert set(os.listdir(f"{path}/runs")) == named and len(os.listdir(f"{path}/manifest")) <= 3


def test_typed_rows_rescue(spark):
    df = spark.createDataFrame([('{"id":"12","a":null,"b":"many"}',)], "after string")
    row = typed_rows(df, SCHEMA).first()
    assert (row.id, row.a, row.b, row._rescued) == (12, None, None, {"b": "many"})


def test_series_functions_match_plain_windows(spark):
    from pyspark.sql import Window

    df = spark.range(500).selectExpr("id % 3 AS k", "id AS t", "id * 7 % 11 AS v")
    w = Window.partitionBy("k").orderBy("t")
    want = df.withColumn("p", F.lag("v").over(w)).withColumn("s", F.sum("v").over(w))
    got = previous_in_series(df, ["k"], ["t"], {"p": F.col("v")}, F.floor(F.col("t") / 17).cast("bigint"))
    got = running_sum_in_series(got, ["k"], ["t"], {"s": F.col("v")}, F.floor(F.col("t") / 40).cast("bigint"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_number_rows_with_one_dominant_group(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, id % 5, 9) AS k", "id")
    got = number_rows(df, [F.col("id").desc()], "n", keys=["k"])
    for k, ids in {k: sorted((r.id for r in df.collect() if r.k == k), reverse=True) for k in (0, 9)}.items():
        assert [r.id for r in got.where(F.col("k") == k).orderBy("n").collect()] == ids


def test_rank_percentile_rule(spark):
    df = spark.range(1, 5).selectExpr("id AS v")
    assert metrics.rank_percentile(df, "v", {"p": 0.5}).first().p == 3
    assert metrics.rank_percentile(spark.range(1, 101).selectExpr("id AS v"), "v", {"p": 0.99}).first().p == 100
    assert metrics.rank_percentile(df.where("v > 9"), "v", {"p": 0.5}).first().p == 0


def test_histogram_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert [(r.bucket_count, r["count"], r.avg) for r in metrics.histogram(empty, "v", [1.0]).collect()] == [(0, 0, 0.0)] * 2


def test_counter_reset(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 15.0), (3, 2.0)], "s int, value double").selectExpr(
        "'a' AS k", "timestamp_seconds(s) AS ts", "value"
    )
    got = [r.increase for r in metrics.counter_increase(df, ["k"], 60).orderBy("ts").collect()]
    assert got == [None, 5.0, 7.0]


def test_quantile_in_infinite_bucket(spark):
    df = spark.createDataFrame([(1.0, 1), (5.0, 2), (float("inf"), 10)], "le double, cumulative_count int")
    assert metrics.histogram_quantile(df, 0.9).first().quantile == 5.0
    assert metrics.histogram_quantile(df, 0.15).first().quantile == pytest.approx(3.0)


def test_pending_run_vanishes_and_alert_resolves(spark):
    rule = alerts.AlertRule("r", F.col("x") > 0, "warning", "m", for_seconds=20)
    ticks = [(0, 1), (10, 0), (20, 1), (30, 1), (40, 1), (50, None), (60, 1)]
    wide = spark.createDataFrame(ticks, "s int, x int").selectExpr("timestamp_seconds(s) AS ts", "x")
    rows = alerts.alert_states(alerts.evaluate_rules(wide, [rule]), [rule]).collect()
    assert [(r.started_at.second, r.fired_at.second, r.resolved_at.second) for r in rows] == [(20, 40, 50)]


def test_compatibility_levels(spark):
    def schema(*fields):
        return json.dumps({"type": "record", "name": "r", "fields": list(fields)})

    old = schema({"name": "id", "type": "int"}, {"name": "x", "type": "string"})
    cases = {
        "promoted": schema({"name": "id", "type": "long"}, {"name": "x", "type": "string"}),
        "no_default": schema({"name": "id", "type": "int"}, {"name": "x", "type": "string"}, {"name": "y", "type": "int"}),
        "nullable": schema({"name": "id", "type": "int"}, {"name": "x", "type": ["null", "string"]}, {"name": "y", "type": ["null", "int"]}),
        "removed": schema({"name": "id", "type": "int"}),
    }
    registry = spark.createDataFrame(
        [(s, v, j) for s, new in cases.items() for v, j in ((1, old), (2, new))], "subject string, version int, schema_json string"
    )
    fields = evolution.schema_fields(registry)

    def verdicts(level):
        return {r.subject: r.is_compatible for r in evolution.check_compatibility(fields, level).where("version = 2").collect()}

    assert verdicts("BACKWARD") == {"promoted": True, "no_default": False, "nullable": True, "removed": True}
    assert verdicts("FORWARD") == {"promoted": True, "no_default": True, "nullable": True, "removed": False}
    assert verdicts("NONE") == dict.fromkeys(cases, True)


def test_migration_path():
    plans = migration.Migrations([migration.Plan("1", "2"), migration.Plan("2", "3"), migration.Plan("1", "3")])
    assert [p.target for p in plans.path("1", "3")] == ["3"]
    assert plans.path("2", "2") == [] and plans.path("3", "1") is None


def test_encryption_rejects_unusable_keys():
    with pytest.raises(ValueError):
        encryption.rotate_key(None, [], None, None, encryption.KeyInfo("k", active=False))


def test_role_cycles_end():
    roles = [access.Role("a", ("x:y",), ("b",)), access.Role("b", ("z:w",), ("a",))]
    assert access.role_permissions(roles) == {"a": ["x:y", "z:w"], "b": ["x:y", "z:w"]}


def test_fanout_retries_then_dead_letters(spark):
    calls, waits, dead = [], [], []

    def broken(df):
        calls.append(1)
        raise RuntimeError("down")

    batch = parse_events(raw(spark, [event(1, after={"id": 1})]))
    done = fanout.route(batch, {"a": broken, "b": lambda df: df.count()}, lambda df: dead.extend(df.collect()), sleep=waits.append)
    assert [(d.sink, d.ok) for d in done] == [("a", False), ("b", True)]
    assert len(calls) == 3 and waits == [1.0, 2.0]
    assert dead[0].failure_reason == "sink_failure" and dead[0].failed_sink == "a"


def test_weights_of_regions():
    assert [r.share for r in regions.KNOWN_REGIONS[:2]] == [90, 80]


def test_layers(spark, tmp_path):
    from tidemark.plans import adapters as a
    from tidemark.plans.layers import build_layers

    d = "/root/testdata/sf0.001"
    items = a.order_items(spark, d)
    layers = build_layers(
        spark,
        {"customers": a.customers(spark, d), "products": a.products(spark, d), "orders": a.orders(spark, d), "order_items": items},
        str(tmp_path), a.AS_OF,
    )
    assert layers["mart_customer_360"].count() > 0 and spark.table("stg_orders").count() > 0


def test_top_k_is_cut_before_the_shuffle(spark):
    from tidemark.operators.gold import top_products_by_category

    df = spark.range(100).selectExpr("id % 3 AS category", "id AS product_id", "id * 2 AS total_revenue")
    plan = top_products_by_category(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rename_onto_a_present_column(spark):
    from tidemark.operators import migration

    rows = spark.createDataFrame([("1", "a", None), ("2", None, "b")], "v string, old string, new string")
    moved = migration.Migrations([migration.Plan("1", "2").rename("old", "new")]).migrate_all(rows, "v", "2")
    assert {(r.v, r.new) for r in moved.collect()} == {("2", "a"), ("2", "b")}


def test_conform_nested_default_and_symbols(spark):
    from tidemark.operators import migration

    schema = migration.declared_struct({"fields": [
        {"name": "kind", "type": ["null", {"type": "enum", "name": "k", "symbols": ["x"]}], "default": None},
        {"name": "tags", "type": {"type": "array", "items": "string"}, "default": ["t"]},
    ]})
    rows = migration.conform(spark.createDataFrame([("x",), ("y",), (None,)], "kind string"), schema).collect()
    assert [(r.kind, r.tags, r.nonconforming) for r in rows] == [("x", ["t"], []), (None, ["t"], ["kind"]), (None, ["t"], [])]


def test_closed_ciphertexts_stay(spark):
    from tidemark.operators import encryption

    right, wrong = F.lit("0123456789abcdef").cast("binary"), F.lit("fedcba9876543210").cast("binary")
    rows = spark.range(1).select(F.array(F.struct(encryption.encrypt_value(F.lit("p"), wrong).alias("n"))).alias("c"),
                                 F.array(encryption.encrypt_value(F.lit("q"), right)).alias("l"))
    opened = encryption.decrypt_fields(rows, right).first()
    assert opened.decrypt_errors == ["c.n"] and opened.c[0].n and opened.l == ["q"]
