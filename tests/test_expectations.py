"""Expectations of a stream, by micro-batch."""

import shutil

from test_streaming import NOON, call, put

from tidemark.plans.calls import bronze_call_rules
from tidemark.streaming import expectations as E


def rows(spark, path):
    return {(r.batch, r.rule): (r.passed, r.failed) for r in E.read_metrics(spark, path).collect()}


def test_each_batch_reports_once_also_when_it_is_repeated(spark, tmp_path):
    landing, out, metrics, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "metrics"), tmp_path / "check"
    rules = bronze_call_rules()
    put(landing, "1.json", [call("a", NOON), call(None, None), call("b", NOON, duration=-1)])
    E.ingest_calls_counted(spark, str(landing), out, metrics, str(check), rules)
    before = str(tmp_path / "before")
    shutil.copytree(check, before)
    put(landing, "2.json", [call("c", NOON, duration=-1), call("d", None)])
    E.ingest_calls_counted(spark, str(landing), out, metrics, str(check), rules)
    want = rows(spark, metrics)
    assert want[0, "valid_epoch"] == (2, 1) and want[0, "non_negative_duration"] == (2, 1)
    assert want[1, "valid_epoch"] == (1, 1) and want[1, "valid_call_id"] == (2, 0)
    # the second batch once more, from the checkpoint of the first
    E.ingest_calls_counted(spark, str(landing), str(tmp_path / "again"), metrics, before, rules)
    assert rows(spark, metrics) == want
    assert {r.rule: (r.passed, r.failed) for r in E.totals(spark, metrics).collect()}["non_negative_duration"] == (3, 2)


def test_nothing_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    E.ingest_calls_counted(spark, str(tmp_path / "in"), str(tmp_path / "o"), str(tmp_path / "m"), str(tmp_path / "c"), bronze_call_rules())
    assert rows(spark, str(tmp_path / "m")) == {}
