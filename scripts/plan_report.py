"""Summarize the executed physical plans of the headline queries.

usage: python scripts/plan_report.py [sf_dir] > PLANS.md

For each query: exchanges by kind, join strategies, Python stages, and
every Parquet scan with its pushed filters and read schema, taken from the
final adaptive plan after one run.
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from edulens.plans import catalog  # noqa: E402
from edulens.session import build_session  # noqa: E402


STAGES = {"ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage", "TableCacheQueryStage"}
JOINS = {"BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"}


def nodes(node):
    """The nodes of an executed plan, subqueries included; what is reused is named, not entered again."""
    name = node.nodeName()
    yield name, node
    if name in ("ReusedExchange", "ReusedSubquery"):
        return
    if name == "AdaptiveSparkPlan":
        yield from nodes(node.executedPlan())
    if name in STAGES:
        yield from nodes(node.plan())
    for below in (node.children(), node.subqueries()):
        for k in range(below.size()):
            yield from nodes(below.apply(k))


def summarize(df) -> dict:
    """Nodes of the final plan after one run."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    found = collections.defaultdict(collections.Counter)
    scans = []
    for name, node in nodes(execution.executedPlan()):
        text = node.simpleString(100_000)
        if name == "Exchange":
            found["exchanges"][re.match(r"Exchange (\w+)", text).group(1)] += 1
        elif name in ("BroadcastExchange", "ReusedExchange"):
            found["exchanges"][{"BroadcastExchange": "broadcast"}.get(name, "reused")] += 1
        elif name in JOINS:
            found["joins"][name] += 1
        elif "Pandas" in name or "Python" in name or "Arrow" in name:
            found["python"][name] += 1
        elif name in ("Subquery", "SubqueryBroadcast", "ReusedSubquery"):
            found["subqueries"]["reused" if name == "ReusedSubquery" else "run"] += 1
        elif "parquet" in text and "ReadSchema" in text:
            table = re.search(r"/([A-Za-z_]+)(?:\.parquet)?\]", text)
            part, pushed, schema = (re.search(p, text) for p in (
                r"PartitionFilters: \[(.*?)\], PushedFilters", r"PushedFilters: \[(.*?)\], ReadSchema", r"ReadSchema: struct<(.*)>"))
            scans.append((table.group(1) if table else "?", ", ".join(x.group(1) for x in (part, pushed) if x and x.group(1)),
                          ",".join(c.split(":")[0] for c in schema.group(1).split(",")) if schema else ""))
    return {k: dict(found[k]) for k in ("exchanges", "joins", "python", "subqueries")} | {"scans": scans}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8, extra={"spark.sql.maxMetadataStringLength": "10000"})
    catalog.materialize_star(spark, sf_dir)
    print(f"# Physical plans of the headline queries ({os.path.basename(sf_dir)}, local[8], AQE final plans)\n")
    print("Generated by `python scripts/plan_report.py`. Counts are plan nodes of the final adaptive plan,")
    print("subqueries included; `reused` counts exchanges read twice but computed once.\n")
    for name in bench.HEADLINE:
        s = summarize(catalog.QUERIES[name](spark, sf_dir))
        print(f"## {name}\n")
        print(f"- exchanges: {s['exchanges'] or 'none'}")
        print(f"- joins: {s['joins'] or 'none'}; subqueries: {s['subqueries'] or 'none'}; scans: {len(s['scans'])}")
        print(f"- Python stages: {s['python'] or 'none'}")
        for t, pushed, cols in sorted(set(s["scans"])):
            print(f"- scan `{t}` reads [{cols}]" + (f", pushed: {pushed}" if pushed else ""))
        print()
    spark.stop()


if __name__ == "__main__":
    main()
