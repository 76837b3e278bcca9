"""Summarise a Spark event log: per job group (query), the slowest stages with
task count, total task time, median and max task time (skew = max / median).

Usage: python scripts/stage_report.py <event-log-file-or-dir> [top_n]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
from collections import defaultdict


def events(path):
    files = [path]
    if os.path.isdir(path):  # rolling logs: eventlog_v2_<app>/events_<n>_<app>
        files = sorted(os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs
                       if not f.startswith(".") and "appstatus" not in f)
    for f in files:
        if f.endswith(".zstd"):
            import io
            import zstandard
            with open(f, "rb") as raw:
                fh = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                for line in fh:
                    yield json.loads(line)
            continue
        with open(f) as fh:
            for line in fh:
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    stage_group, tasks, names = {}, defaultdict(list), {}
    for ev in events(path):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
            for st in ev.get("Stage Infos", []):
                stage_group[st["Stage ID"]] = group
                names[st["Stage ID"]] = st.get("Stage Name", "")
        elif kind == "SparkListenerTaskEnd":
            info = ev["Task Info"]
            tasks[ev["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
    per_group = defaultdict(list)
    for sid, durs in tasks.items():
        per_group[stage_group.get(sid, "-")].append((sum(durs), sid, durs))
    for group, stages in sorted(per_group.items(), key=lambda g: -sum(s[0] for s in g[1])):
        print(f"{group}: task time {sum(s[0] for s in stages) / 1000:.1f}s in {len(stages)} stages")
        for total, sid, durs in sorted(stages, reverse=True)[:top]:
            med = statistics.median(durs)
            print(f"  stage {sid:4d} tasks {len(durs):4d} total {total / 1000:6.1f}s median {med / 1000:5.2f}s "
                  f"max {max(durs) / 1000:5.2f}s skew {max(durs) / med if med else 0:5.1f}  {names.get(sid, '')[:50]}")


if __name__ == "__main__":
    main()
