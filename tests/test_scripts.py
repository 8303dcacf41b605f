"""The tooling scripts: plan summaries and event-log stage times."""

import contextlib
import importlib.util
import io
import json
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load(name):
    spec = importlib.util.spec_from_file_location(name, os.path.join(ROOT, "scripts", f"{name}.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_plan_summary_lists_shuffles_joins_and_pruning(spark):
    explain = _load("explain_plans")
    a = spark.range(100).selectExpr("id % 7 AS k", "id")
    df = a.groupBy("k").count()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    s = explain.summarize(buf.getvalue())
    assert any(sh.startswith("hashpartitioning(k") for sh in s["shuffles"])
    assert s["joins"] == [] and s["broadcasts"] == 0
    assert "HashAggregate" in s["tree"]


def test_stage_times_reads_an_event_log(tmp_path, capsys):
    stage_times = _load("stage_times")
    events = [
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Submission Time": 1000, "Stage IDs": [3],
         "Properties": {"spark.jobGroup.id": "q1"}},
        {"Event": "SparkListenerStageCompleted",
         "Stage Info": {"Stage ID": 3, "Stage Name": "parquet at x", "Number of Tasks": 4,
                        "Submission Time": 1100, "Completion Time": 1600}},
        {"Event": "SparkListenerJobEnd", "Job ID": 1, "Completion Time": 1700},
    ]
    log = tmp_path / "events_1_local-1"
    log.write_text("\n".join(json.dumps(e) for e in events) + "\n", encoding="utf-8")
    import sys

    argv = sys.argv
    sys.argv = ["stage_times.py", str(tmp_path)]
    try:
        stage_times.main()
    finally:
        sys.argv = argv
    out = capsys.readouterr().out
    assert "700" in out and "q1" in out  # job time of the group
    assert "500" in out and "parquet at x" in out  # the stage
