"""Summarise the physical plan of every registered query into PLANS.md.

For each query: shuffles, join strategies, broadcasts, window group limits,
Python evaluation nodes (there should be none outside the ML stages), and
the columns each parquet scan reads. Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from edgefilter.plans.registry import oracle_sql, queries  # noqa: E402
from edgefilter.session import get_session  # noqa: E402

NODES = [
    ("Exchange hashpartitioning", r"(?<!Broadcast)Exchange \(\d+\)"),
    ("BroadcastExchange", r"BroadcastExchange"),
    ("SortMergeJoin", r"SortMergeJoin"),
    ("BroadcastHashJoin", r"BroadcastHashJoin"),
    ("BroadcastNestedLoopJoin", r"BroadcastNestedLoopJoin"),
    ("HashAggregate", r"HashAggregate|ObjectHashAggregate|SortAggregate"),
    ("WindowGroupLimit", r"WindowGroupLimit"),
    ("TakeOrderedAndProject", r"TakeOrderedAndProject"),
    ("PythonEval", r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"),
]


def plan_text(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarise(text: str) -> dict:
    tree = text.split("\n\n", 1)[0]
    out = {}
    for name, pat in NODES:
        out[name] = len(re.findall(pat, tree))
    scans = re.findall(r"Scan parquet[^\n]*\n(?:[^\n]*\n)*?ReadSchema: (struct<[^\n]*>)", text)
    locs = re.findall(r"Location: [^\[]*\[([^\]]*)\]", text)
    out["scans"] = [f"{l.rsplit('/', 1)[-1].replace('.parquet', '')}: {s}" for l, s in zip(locs, scans)]
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session()
    qs, sqls = queries(), oracle_sql()
    lines = ["# Physical plans", "",
             f"Generated by `tools/plans.py` at `{sf_dir}` (initial adaptive plans; AQE may",
             "coalesce partitions or turn a sort-merge join into a broadcast at run time).",
             "Stream queries show the plan of the table they read back.", "",
             "| query | oracle | shuffles | bcast | SMJ | BHJ | BNLJ | agg | WGL | topN | python | scans (read schema) |",
             "| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name in sorted(qs):
        df = qs[name](spark, sf_dir)
        s = summarise(plan_text(df))
        scans = "<br>".join(s["scans"]) if s["scans"] else "—"
        lines.append(
            f"| {name} | {'sql' if name in sqls else 'rows'} | {s['Exchange hashpartitioning']} | "
            f"{s['BroadcastExchange']} | {s['SortMergeJoin']} | {s['BroadcastHashJoin']} | "
            f"{s['BroadcastNestedLoopJoin']} | {s['HashAggregate']} | {s['WindowGroupLimit']} | "
            f"{s['TakeOrderedAndProject']} | {s['PythonEval']} | {scans} |")
        print(name, flush=True)
    with open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
