"""Rules and panels over metric samples."""

import pytest
from pyspark.sql import functions as F
from tidemark.operators import alerts
from tidemark.operators.measures import Measure, measured
from tidemark.plans import metric_queries


@pytest.fixture(scope="module")
def targets(spark):
    """Two targets, one of which is down from 00:03 to 00:07, and a counter that restarts."""
    rows = []
    for minute in range(12):
        ts = f"2024-01-01 00:{minute:02d}:10"
        rows += [(ts, "up", {"job": "cdc", "instance": "a"}, 1.0), (ts, "up", {"job": "cdc", "instance": "b"}, 0.0 if 3 <= minute <= 7 else 1.0)]
        rows.append((ts, "errors", {"instance": "a"}, float([0, 5, 10, 2, 4, 6, 8, 10, 12, 14, 16, 18][minute])))
        rows.append((ts, "errors", {"instance": "b"}, 7.0))
    return spark.createDataFrame(rows, "ts string, name string, labels map<string,string>, value double").withColumn("ts", F.to_timestamp("ts"))


def test_one_of_two_targets_down_fires(targets):
    rules = alerts.metric_rules()
    found = alerts.alert_states(alerts.evaluate_rules(alerts.metric_rule_inputs(targets), rules), rules).collect()
    down = [r for r in found if r["rule"] == "CDCConsumerDown"]
    assert [(r["labels"], str(r["started_at"]), str(r["fired_at"]), str(r["resolved_at"])) for r in down] == [
        ('instance="b",job="cdc"', "2024-01-01 00:04:00", "2024-01-01 00:05:00", "2024-01-01 00:09:00")
    ]


def test_growth_per_series_and_summed(targets):
    each = Measure("each", "increase", "errors", 120, by=None)
    total = Measure("total", "increase", "errors", 120)
    by = Measure("by", "rate", "errors", 60, by=("instance",))
    rows = measured(targets, [each, total, by]).orderBy("tick").collect()
    of = lambda name, labels: [r["value"] for r in rows if r["measure"] == name and r["labels"] == labels]
    assert of("each", 'instance="a"')[:5] == [0.0, 5.0, 10.0, 7.0, 4.0]  # 10 to 2 is a restart: growth of 2
    assert set(of("each", 'instance="b"')) == {0.0}
    assert of("total", "")[:5] == [0.0, 5.0, 10.0, 7.0, 4.0]
    assert of("by", 'instance="a"')[1] == 5 / 60


def test_no_samples(targets):
    rules = alerts.metric_rules()
    none = targets.where("false")
    assert alerts.evaluate_rules(alerts.metric_rule_inputs(none), rules).count() == 0
    assert alerts.panels(none).count() == 0


def test_all_rules_fire_on_the_derived_samples(spark):
    rules = alerts.metric_rules()
    inputs = alerts.metric_rule_inputs(metric_queries.pipeline_samples(spark, "/root/testdata/sf0.01"))
    fired = alerts.alert_states(alerts.evaluate_rules(inputs, rules), rules).select("rule").distinct().collect()
    assert {r["rule"] for r in fired} == {r.name for r in rules}
