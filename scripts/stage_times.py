"""Summarise a Spark event log: per job, its stages with wall time, task
time, tasks, input rows and shuffle read/write bytes.

    python scripts/stage_times.py <event log file> [min_stage_seconds]
"""
import json
import os
import sys
from collections import defaultdict


def lines(path: str):
    """Events of a log file, or of a rolling log folder (events_<n>_...)."""
    files = [path]
    if os.path.isdir(path):
        ev = [f for f in os.listdir(path) if f.startswith("events_")]
        ev.sort(key=lambda f: int(f.split("_")[1]))
        files = [os.path.join(path, f) for f in ev]
    for f in files:
        if f.endswith(".zstd"):
            import io
            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def main(path: str, min_s: float = 0.0) -> None:
    stages, tasks = {}, defaultdict(lambda: [0, 0.0, 0, 0, 0])
    job_stages, job_desc = {}, {}
    for line in lines(path):
        if line.strip():
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                job_stages[ev["Job ID"]] = ev.get("Stage IDs", [])
                props = ev.get("Properties") or {}
                job_desc[ev["Job ID"]] = (props.get("spark.job.description")
                                          or props.get("callSite.short") or "")
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                sub, done = info.get("Submission Time"), info.get("Completion Time")
                if sub and done:
                    stages[info["Stage ID"]] = (info.get("Stage Name", ""), (done - sub) / 1000.0)
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                t = tasks[ev["Stage ID"]]
                t[0] += 1
                t[1] += (m.get("Executor Run Time") or 0) / 1000.0
                t[2] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                sr = m.get("Shuffle Read Metrics") or {}
                t[3] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                t[4] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    for job, sids in sorted(job_stages.items()):
        shown = [s for s in sids if s in stages and stages[s][1] >= min_s]
        if not shown:
            continue
        print(f"job {job}: {job_desc.get(job, '')[:80]}")
        for s in shown:
            name, wall = stages[s]
            n, cpu, rows, rd, wr = tasks[s]
            print(f"  stage {s:4d} {wall:7.2f}s wall {cpu:7.2f}s task  {n:4d} tasks  "
                  f"in={rows:>9d} rows  shuffle r={rd / 1e6:7.1f}MB w={wr / 1e6:7.1f}MB  {name[:50]}")


if __name__ == "__main__":
    main(sys.argv[1], float(sys.argv[2]) if len(sys.argv) > 2 else 0.0)
