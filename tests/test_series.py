"""Growth over trailing windows, value slices and number types on awkward rows."""

import datetime as dt
import json
import random
from pathlib import Path

from pyspark.sql import functions as F
from tidemark.functions import ordered
from tidemark.operators import envelope, evolution, metrics, quality


def test_growth_equals_brute_force(spark):
    """Restarts, equal times, gaps longer than a window, and a series that is one sample."""
    rng = random.Random(4)
    rows, at, value = [], 0, 0
    for i in range(900):
        at += rng.choice([0, 1, 7, 30, 59, 60, 61, 400])
        value = rng.randrange(5) if rng.random() < 0.1 else value + rng.randrange(9)
        rows.append(("a", i, at, float(value)))
    rows.append(("b", 0, 5, 3.0))
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, n, base + dt.timedelta(seconds=t), v) for k, n, t, v in rows], "k string, n int, ts timestamp, value double")
    found = {(r["k"], r["n"]): r for r in metrics.counter_increase(df, ["k"], 60, tie_break=["n"]).collect()}
    series = [r for r in rows if r[0] == "a"]
    deltas = [0.0, *[b[3] if b[3] < a[3] else b[3] - a[3] for a, b in zip(series, series[1:])]]
    for _, n, t, _ in series:
        inside = [i for i, r in enumerate(series) if t - 60 < r[2] <= t]
        want = sum(deltas[i] for i in inside[1:]) if len(inside) > 1 else None
        assert found["a", n]["increase"] == want
        elapsed = t - series[inside[0]][2]
        assert found["a", n]["rate"] == (None if want is None or not elapsed else want / elapsed)
    assert found["b", 0]["increase"] is None


def test_ranks_over_many_slices(spark, monkeypatch):
    monkeypatch.setattr(metrics, "SLICE_VALUES", 10)
    values = [(i * 37 % 1000) / 8 for i in range(1000)]
    df = spark.createDataFrame([("x", v) for v in values] + [("y", 1.0)] * 50, "g string, v double")
    found = {r["g"]: r for r in metrics.rank_percentile(df, "v", {"p50": 0.5, "p99": 0.99}, ["g"]).collect()}
    ranked = sorted(values)
    assert (found["x"]["p50"], found["x"]["p99"]) == (ranked[500], ranked[990]) and found["y"]["p99"] == 1.0


def test_whole_numbers_beyond_a_long_are_int(spark):
    kinds = {"12345678901234567890": "int", "-98765432109876543210": "int", "12": "int", "12.0": "float", "1e3": "float", "1.5": "float"}
    df = spark.createDataFrame([(t, f'{{"n": {t}}}') for t in kinds], "t string, row string")
    cell = df.select("t", F.parse_json("row").alias("_row")).select("t", quality._cell("n")["kind"].alias("kind"))
    assert {r["t"]: r["kind"] for r in cell.collect()} == kinds


def test_machines_of_a_busy_key_over_batches(spark, tmp_path):
    """A rule and a region with most rows, in batches that cut their runs, against a loop over the ticks."""
    import random
    from datetime import datetime, timedelta

    from tidemark.streaming import stateful

    draw = random.Random(5)
    start = datetime(2020, 1, 1)
    ticks = [(key, i, start + timedelta(seconds=60 * i), draw.random() < 0.8) for key, n in (("hot", 600), ("cold", 30)) for i in range(n)]
    cuts = [0, 7, 200, 201, 450, 600]
    alerts = stateful.alert_sink(str(tmp_path / "alerts"), {"hot": 240, "cold": 0}, slice_seconds=3600)
    health = stateful.region_health_sink(str(tmp_path / "health"), slice_seconds=3600)
    schema = "key string, check_id bigint, ts timestamp, ok boolean"
    for batch, (low, high) in enumerate(zip(cuts, cuts[1:])):
        rows = spark.createDataFrame([t for t in ticks if low <= t[1] < high], schema)
        for _ in range(2 if batch == 2 else 1):  # one batch is delivered twice
            alerts(rows.selectExpr("key AS rule", "ts", "ok AS met"), batch)
            health(rows.selectExpr("key AS region", "check_id", "ts", "ok AS passed"), batch)

    told, states = set(), set()
    for key, wait in (("hot", 240), ("cold", 0)):
        since, fired, fails, oks, status = None, False, 0, 0, "unknown"
        for _, i, ts, ok in (t for t in ticks if t[0] == key):
            if ok:
                since = since or ts
                if not fired and (ts - since).total_seconds() >= wait:
                    fired = True
                    told.add((key, since, "firing", ts))
            else:
                if fired:
                    told.add((key, since, "resolved", ts))
                since, fired = None, False
            fails, oks = (0, oks + 1) if ok else (fails + 1, 0)
            status = ("healthy" if oks >= 2 else status) if ok else ("unhealthy" if fails >= 3 else "degraded")
            states.add((key, i, status))
    found = stateful.machine_rows(spark, str(tmp_path / "alerts")).collect()
    assert len(found) == len(told) and {tuple(r) for r in found} == told
    found = stateful.machine_rows(spark, str(tmp_path / "health")).collect()
    assert len(found) == len(states) and {tuple(r) for r in found} == states


def _joins(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_carry_is_never_broadcast(spark):
    """Sizes are guessed far too small below parsed rows, as they are here, and there may be as many slices as rows."""
    rows = spark.range(60).selectExpr("cast(id % 20 AS string) AS k", "id AS at", "CASE WHEN id % 3 = 0 THEN id END AS v")
    by = F.floor(F.col("at") / 7)
    known = ordered.last_known_in_series(rows, ["k"], ["at"], {"was": F.col("v")}, by)
    near = ordered.previous_in_series(rows, ["k"], ["at"], {"was": F.col("v")}, by)
    total = ordered.running_sum_in_series(rows, ["k"], ["at"], {"n": F.lit(1)}, by)
    for found in (known, near, total):
        assert "Broadcast" not in _joins(found)
    latest = lambda i: next((j for j in range(i - 20, -1, -20) if j % 3 == 0), None)
    assert {r["at"]: r["was"] for r in known.collect()} == {i: latest(i) for i in range(60)}
    assert {r["at"]: r["was"] for r in near.collect()} == {i: i - 20 if i >= 20 and (i - 20) % 3 == 0 else None for i in range(60)}
    assert {r["at"]: r["n"] for r in total.collect()} == {i: i // 20 + 1 for i in range(60)}


def test_commits_are_never_broadcast(spark, monkeypatch):
    """Changes and commits are read from one written log, and neither side of their join is broadcast."""
    plans, keep = {}, envelope.written
    monkeypatch.setattr(envelope, "written", lambda df, label: (plans.update({label: _joins(df)}), keep(df, label))[1])
    log = spark.range(200).selectExpr(
        "CASE id % 4 WHEN 0 THEN 'BEGIN' WHEN 3 THEN 'COMMIT' ELSE 'INSERT' END AS type", "id div 4 AS xid",
        "concat('0/', hex(id + 1)) AS lsn", "cast(id AS string) AS event_id",
    ).where("id <> 7")
    found = envelope.assemble_transactions(log)
    assert "Broadcast" not in plans["committed-changes"] and "FileScan parquet" in plans["committed-changes"]
    got = {int(r["event_id"]): (r["xid"], r["commit_lsn"], r["position"]) for r in found.collect()}
    assert got == {i: (i // 4, f"0/{i // 4 * 4 + 4:X}", i % 4) for i in range(200) if i % 4 in (1, 2) and i // 4 != 1}


def _compatible(old, new):
    from tidemark.operators.evolution import PROMOTIONS

    before, after = ([t] if isinstance(t, str) else t for t in (old, new))
    return old == new or set(before) <= set(after) or any(f"{o}>{n}" in PROMOTIONS for o in before for n in after)


def test_versions_across_slices(spark):
    """A subject of three slices and some of one against the rules applied to every pair of versions."""
    rng = random.Random(7)
    kinds = ["int", "long", "string", ["null", "string"], ["string", "null"]]
    history = {}
    for subject, size in (("hot", 2300), ("a", 5), ("b", 1), ("c", 40)):
        for v in range(1, size + 1):
            # Most fields keep their type; rare ones appear and go.
            names = [n for n in ("x", "y", "z") if rng.random() < 0.95] + [f"r{rng.randrange(40)}"] * (rng.random() < 0.3)
            history[subject, v + 10 * (v > 1500)] = {
                n: (rng.choice(kinds) if rng.random() < 0.02 else "int", rng.random() < 0.5) for n in names
            }
    rows = [
        (s, v, json.dumps({"fields": [{"name": n, "type": t, **({"default": 0} if d else {})} for n, (t, d) in f.items()]}))
        for (s, v), f in history.items()
    ]
    registry = spark.createDataFrame(rows, "subject string, version bigint, schema_json string")
    fields = evolution.schema_fields(registry)
    fills = lambda t, d: d or (isinstance(t, list) and t[0] == "null")
    plain, every, moves = {}, {}, set()
    for subject in {s for s, _ in history}:
        versions = sorted(v for s, v in history if s == subject)
        seen, types, required, last = {}, {}, set(), None
        for i, v in enumerate(versions):
            now = history[subject, v]
            back = sum(not fills(t, d) and seen.get(n, 0) < i for n, (t, d) in now.items())
            back += sum(any(not _compatible(json.loads(o), t) for o in types.get(n, ())) for n, (t, _) in now.items())
            if now or i + 1 < len(versions):
                every[subject, v] = back + len(required - set(now))
            gone = [] if last is None else [n for n in last if n not in now]
            if last is not None:
                fresh = [n for n in now if n not in last]
                plain[subject, v] = sum(not fills(*now[n]) for n in fresh) + sum(not fills(*last[n]) for n in gone) + sum(
                    not _compatible(last[n][0], now[n][0]) for n in now if n in last)
                moves |= {(subject, v, n, "added") for n in fresh} | {(subject, v, n, "removed") for n in gone}
                moves |= {(subject, v, n, "modified") for n in now if n in last and (now[n][0] != last[n][0] or now[n][1] != last[n][1])}
            else:
                plain[subject, v] = 0
            for n, (t, d) in now.items():
                seen[n] = seen.get(n, 0) + 1
                types.setdefault(n, set()).add(json.dumps(t))
                if not fills(t, d):
                    required.add(n)
            last = now
    count = lambda level: {(r["subject"], r["version"]): r["errors"] for r in evolution.check_compatibility(fields, level).collect()}
    empty = {k for k, f in history.items() if not f}
    assert count("FULL") == {k: n for k, n in plain.items() if k not in empty or n}
    got = count("FULL_TRANSITIVE")
    assert got == {k: n for k, n in every.items() if k not in empty} and any(n > 2 for (s, v), n in got.items() if v > 2000)
    assert {(r["subject"], r["version"], r["field"], r["change"]) for r in evolution.schema_diff(fields).collect()} == moves


def test_compatibility_shuffles_schemas_once(spark):
    """After the versions are linked only one row per version and task moves."""
    registry = spark.createDataFrame([("a", 1, '{"fields":[{"name":"x","type":"int"}]}')], "subject string, version bigint, schema_json string")
    fields = evolution.schema_fields(registry)
    shuffles = lambda level: _joins(evolution.check_compatibility(fields, level)).count("Exchange hashpartitioning")
    assert shuffles("FULL") == 2 and shuffles("FULL_TRANSITIVE") == 1
    assert _joins(evolution.schema_diff(fields)).count("Exchange hashpartitioning") == 1


def test_messages_are_judged_once(spark, tmp_path):
    """Neither a filter on the errors nor the two halves of the quality split parse and judge a message again."""
    from tidemark.plans import quality_queries
    from tidemark.sources import events

    spark.range(1).selectExpr("cast('{}' AS binary) AS value", "'t' AS topic", "0 AS partition", "0L AS offset").write.parquet(str(tmp_path / "raw"))
    plan = _joins(events.valid_events(events.parse_events(events.read_events(spark, str(tmp_path / "raw")))).select("event_id", "source"))
    assert plan.count(r"\}\s*(?:[^\s,}]|,\s*\{)") == 1
    assert "from_json" not in _joins(quality_queries._split(spark, "/root/testdata/sf0.001"))


def test_arrived_rows_are_kept_once(spark):
    """When the last wave has arrived, the table that was cut into waves goes before the stream runs."""
    from tidemark.plans.stream_queries import _Arrivals

    arrivals, seen = _Arrivals(spark, spark.range(9), "numbers", wave=F.col("id") % 3), []
    folder = Path(arrivals.rows.inputFiles()[0].removeprefix("file:")).parent
    arrivals.run(lambda: seen.append((folder.exists(), spark.read.parquet(arrivals.path).count())))
    assert seen == [(True, 3), (True, 6), (False, 9)]
