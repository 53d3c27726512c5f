"""Stage and task times per query from a Spark event log.

Usage: python tools/event_log_summary.py <event log file or folder>

Reads the JSON lines Spark writes with ``spark.eventLog.enabled`` (see
``BENCH_EVENT_LOG`` in ``bench.py``), groups jobs by their description
(``bench:<query>``) and prints, per query: jobs, stages, tasks, summed job
wall time, summed task run time, and shuffle bytes written and read. Jobs
without a description are grouped under ``-``.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path: str) -> list[str]:
    """Event files under ``path``: plain logs, or the ``events_*`` files of
    Spark's rolling log folders (``eventlog_v2_<app>/``)."""
    if not os.path.isdir(path):
        return [path]
    found = []
    for root, _, names in os.walk(path):
        for n in sorted(names):
            if n.startswith((".", "appstatus")):
                continue
            found.append(os.path.join(root, n))
    return sorted(found)


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    elif path.endswith((".lz4", ".snappy", ".lzf")):
        raise SystemExit(f"{path}: codec not supported here; set spark.eventLog.compression.codec=zstd")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def summarise(path: str) -> dict[str, dict[str, float]]:
    job_desc: dict[int, str] = {}
    job_start: dict[int, int] = {}
    stage_job: dict[int, int] = {}
    out: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for f in _files(path):
        for line in _lines(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                jid = ev["Job ID"]
                desc = (ev.get("Properties") or {}).get("spark.job.description") or "-"
                job_desc[jid], job_start[jid] = desc, ev.get("Submission Time", 0)
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = jid
                out[desc]["jobs"] += 1
            elif kind == "SparkListenerJobEnd":
                jid = ev["Job ID"]
                out[job_desc.get(jid, "-")]["job_ms"] += ev.get("Completion Time", 0) - job_start.get(jid, 0)
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                desc = job_desc.get(stage_job.get(info["Stage ID"], -1), "-")
                out[desc]["stages"] += 1
                out[desc]["tasks"] += info.get("Number of Tasks", 0)
            elif kind == "SparkListenerTaskEnd":
                desc = job_desc.get(stage_job.get(ev.get("Stage ID"), -1), "-")
                m = ev.get("Task Metrics") or {}
                out[desc]["task_ms"] += m.get("Executor Run Time", 0)
                out[desc]["shuffle_write_bytes"] += (m.get("Shuffle Write Metrics") or {}).get(
                    "Shuffle Bytes Written", 0)
                r = m.get("Shuffle Read Metrics") or {}
                out[desc]["shuffle_read_bytes"] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
    return out


def main() -> None:
    res = summarise(sys.argv[1])
    cols = ["jobs", "stages", "tasks", "job_ms", "task_ms", "shuffle_write_bytes", "shuffle_read_bytes"]
    print("| description | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for desc in sorted(res):
        print(f"| {desc} | " + " | ".join(str(int(res[desc][c])) for c in cols) + " |")


if __name__ == "__main__":
    main()
