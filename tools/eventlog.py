"""Per-query jobs, stages, input and shuffle volume from Spark's event log.

Runs the given queries (default: the bench headline set) through the noop
sink with the event log written to a fresh scratch folder, then sums the
stage metrics of each query's job group into STAGES.md.
Usage: python tools/eventlog.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
from collections import defaultdict

ROOT = __file__.rsplit("/tools/", 1)[0]
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from edgefilter.plans.registry import queries  # noqa: E402
from edgefilter.session import get_session  # noqa: E402

METRICS = {
    "internal.metrics.input.recordsRead": "input_rows",
    "internal.metrics.shuffle.write.bytesWritten": "shuffle_write",
    "internal.metrics.shuffle.read.remoteBytesRead": "shuffle_read",
    "internal.metrics.shuffle.read.localBytesRead": "shuffle_read",
    "internal.metrics.executorRunTime": "run_ms",
    "internal.metrics.memoryBytesSpilled": "spill",
}


def parse(log_dir: str) -> dict:
    stage_group, out = {}, defaultdict(lambda: defaultdict(float))
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p))
    for path in paths:
        if os.path.basename(path).startswith("appstatus"):
            continue
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                if group:
                    out[group]["jobs"] += 1
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                group = stage_group.get(info["Stage ID"])
                if group is None:
                    continue
                out[group]["stages"] += 1
                for acc in info.get("Accumulables", []):
                    name = METRICS.get(acc.get("Name"))
                    if name:
                        out[group][name] += float(acc.get("Value") or 0)
    return out


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def main():
    args = sys.argv[1:]
    reuse = next((a.split("=", 1)[1] for a in args if a.startswith("--log=")), None)
    args = [a for a in args if not a.startswith("--log=")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or HEADLINE
    log_dir = reuse or tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    if reuse is None:
        spark = get_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                   "spark.eventLog.compress": "false", "spark.driver.memory": "16g"})
        qs = queries()
        for name in names:
            spark.sparkContext.setJobGroup(name, name)
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.stop()
    stats = parse(log_dir)
    mb = lambda v: f"{v / 1e6:.1f}"
    lines = ["# Stage metrics per query", "",
             f"From Spark's event log, `tools/eventlog.py` at `{sf_dir}`, local[8]. Input is",
             "records read by scans (cached blocks included), shuffle is bytes written by",
             "map stages, task time is summed executor run time.", "",
             "| query | jobs | stages | input rows | shuffle write MB | shuffle read MB | spill MB | task time s |",
             "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name in names:
        s = stats.get(name, {})
        lines.append(f"| {name} | {int(s.get('jobs', 0))} | {int(s.get('stages', 0))} | "
                     f"{int(s.get('input_rows', 0))} | {mb(s.get('shuffle_write', 0))} | "
                     f"{mb(s.get('shuffle_read', 0))} | {mb(s.get('spill', 0))} | "
                     f"{s.get('run_ms', 0) / 1000:.1f} |")
    with open(os.path.join(ROOT, "STAGES.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
