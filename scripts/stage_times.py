"""Summarize a Spark event log: wall time per job group and the slowest stages.

Usage: python scripts/stage_times.py EVENT_LOG_FILE_OR_DIR [top_n]
(the bench labels each query's jobs with the query name as the job group).
"""

from __future__ import annotations

import collections
import json
import os
import sys


def events(path: str):
    if os.path.isdir(path):
        files = sorted(
            os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith(("events_", "local-", "app-"))
        )
    else:
        files = [path]
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard

            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                for line in text:
                    yield json.loads(line)
        else:
            with open(f, encoding="utf-8") as fh:
                for line in fh:
                    yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    job_group, job_start, job_time = {}, {}, collections.Counter()
    stage_job, stage_info = {}, []
    jobs_per_group = collections.Counter()
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            group = props.get("spark.jobGroup.id", "-")
            job_group[e["Job ID"]] = group
            job_start[e["Job ID"]] = e["Submission Time"]
            jobs_per_group[group] += 1
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
        elif kind == "SparkListenerJobEnd":
            jid = e["Job ID"]
            job_time[job_group.get(jid, "-")] += e["Completion Time"] - job_start.get(jid, e["Completion Time"])
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Submission Time" in info and "Completion Time" in info:
                group = job_group.get(stage_job.get(info["Stage ID"]), "-")
                stage_info.append((info["Completion Time"] - info["Submission Time"], group, info["Stage Name"], info["Number of Tasks"]))
    print("job time per group (ms), jobs:")
    for group, ms in job_time.most_common():
        print(f"  {ms:8d}  {jobs_per_group[group]:3d}  {group}")
    print(f"slowest {top} stages (ms, group, tasks, name):")
    for ms, group, name, tasks in sorted(stage_info, reverse=True)[:top]:
        print(f"  {ms:8d}  {group:28s} {tasks:5d}  {name[:70]}")


if __name__ == "__main__":
    main()
