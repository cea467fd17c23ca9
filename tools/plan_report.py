"""Summarise the physical plan of every registered query into PLANS.md.

usage: python tools/plan_report.py [sf_dir] [out.md]

For each query: shuffles (Exchange), broadcasts, sort-merge joins, whole-
stage-codegen spans, Python evaluation (should be none), and each Parquet
scan's pushed filters and read schema. Each query is run first
(``collect``; the results are small at the test scale), so the report shows
the final adaptive plan -- what actually ran, after AQE coalesced
partitions or switched joins.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from geonest.plans.explain import plan_text  # noqa: E402
from geonest.registry import QUERIES  # noqa: E402
from geonest.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    """Counts over the nodes of the plan that ran: for an adaptive plan,
    only the ``Final Plan`` subtree (its ``Initial Plan`` is listed too)."""
    tree = plan.split("\n\n\n")[0]
    m = re.search(r"== Final Plan ==\n(.*?)\n\+- == Initial Plan ==", tree, re.S)
    ids = set(re.findall(r"\((\d+)\)", m.group(1) if m else tree))
    blocks = {}
    for block in re.split(r"\n(?=\(\d+\) )", plan):
        h = re.match(r"\((\d+)\) (\w+)", block)
        if h and h.group(1) in ids:
            blocks[h.group(1)] = (h.group(2), block)
    names = [n for n, _ in blocks.values()]
    scans = []
    for name, block in blocks.values():
        if name != "Scan":
            continue
        loc = re.search(r"Location: \w+ \[([^\]]*)\]", block)
        table = loc.group(1).rstrip("/").split("/")[-1].split(",")[0] if loc else "?"
        table = re.sub(r"-[0-9a-f]{12}$", "", table)  # scratch folders carry a run id
        pushed = re.search(r"PushedFilters: \[(.*)\]", block)
        parts = re.search(r"PartitionFilters: \[(.*)\]", block)
        schema = re.search(r"ReadSchema: (struct<.*>)", block)
        scans.append(
            {
                "table": table,
                "pushed": pushed.group(1) if pushed else "",
                "partition": parts.group(1) if parts else "",
                "schema": schema.group(1) if schema else "",
            }
        )
    joins = sorted(n for n in names if n.endswith("Join"))
    return {
        "exchanges": names.count("Exchange"),
        "broadcasts": names.count("BroadcastExchange"),
        "joins": ", ".join(joins) or "-",
        "codegen": len({c for _, b in blocks.values() for c in re.findall(r"\[codegen id : (\d+)\]", b)}),
        "python": any(n in names for n in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")),
        "cartesian": any(n in names for n in ("CartesianProduct", "BroadcastNestedLoopJoin")),
        "scans": scans,
    }


def final_nodes(plan: str) -> list[str]:
    """Operator names of the final plan tree, top-down (adaptive wrappers
    and stage markers left out); an exchange shows its kind."""
    tree = plan.split("\n\n\n")[0]
    m = re.search(r"== Final Plan ==\n(.*?)\n\+- == Initial Plan ==", tree, re.S)
    details = {
        b.group(1): b.group(0) for b in re.finditer(r"^\((\d+)\) \w+.*?(?=^\(\d+\) |\Z)", plan, re.S | re.M)
    }
    skip = {"AdaptiveSparkPlan", "ResultQueryStage", "ShuffleQueryStage", "AQEShuffleRead", "ColumnarToRow"}
    out = []
    for line in (m.group(1) if m else tree).splitlines():
        n = re.search(r"(?:\+- |^\s*)(?:\* )?(\w+)[^(]*\((\d+)\)", line)
        if not n or n.group(1) in skip:
            continue
        name, block = n.group(1), details.get(n.group(2), "")
        if name == "Exchange":
            kind = "rebalance" if "REBALANCE_PARTITIONS_BY_COL" in block else (
                "single" if "SinglePartition" in block else "hash")
            name = f"Exchange[{kind}]"
        out.append(name)
    return out


def write_frames(spark, sf: str):
    """(label, frame) for the frames the location and news sinks write."""
    from geonest import fixtures as FX
    from geonest import schemas as S
    from geonest.operators.enrich import transform_countries
    from geonest.operators.flatten import flatten_cities, flatten_states
    from geonest.plans.news import NEWS_PARTITIONS, news_articles
    from geonest.registry import RUN_TS, _landed
    from geonest.sinks.files import cluster_by, guard_partition_values
    from geonest.sources.news import read_response_log

    def sink(df, parts):
        return cluster_by(guard_partition_values(df, parts), parts)

    yield "fixture: nested documents from the flat tables", FX.location_docs_frame(spark, sf)
    docs = FX.location_docs(spark, sf)
    yield "countries by `country_code`", sink(
        transform_countries(docs, FX.population_frame(spark, sf), RUN_TS), S.PARTITIONING["countries"]
    )
    yield "states by `country_code, state_code`", sink(flatten_states(docs, True, RUN_TS), S.PARTITIONING["states"])
    yield "cities by `country_code, state_code`", sink(
        flatten_cities(docs, True, RUN_TS), S.PARTITIONING["cities"]
    )
    articles, _ = news_articles(read_response_log(spark, _landed(spark, sf)))
    yield "news articles by `date, country, topic`", sink(articles, NEWS_PARTITIONS)


def short(s: str, n: int = 400) -> str:
    s = re.sub(r"#\d+", "", s)
    return s if len(s) <= n else s[: n - 1] + "…"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(__file__)), "PLANS.md")
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tools/plan_report.py` at `{os.path.basename(sf)}`: final adaptive plans of each query "
        "after it ran (AQE has coalesced partitions and picked joins). Counts are nodes of the final plan; codegen spans are "
        "distinct whole-stage-codegen stages. Python evaluation and cartesian products are expected to be "
        "absent everywhere. Queries that write tables show only their final read of the written table here.",
        "",
        "| Query | Shuffles | Broadcasts | Joins that ran | Codegen spans | Python | Cartesian |",
        "| --- | --- | --- | --- | --- | --- | --- |",
    ]
    details = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()  # run it: explain then shows the final adaptive plan
        s = summarise(plan_text(df, "formatted"))
        lines.append(
            f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | {s['joins']} | {s['codegen']} | "
            f"{'yes' if s['python'] else 'no'} | {'yes' if s['cartesian'] else 'no'} |"
        )
        details.append(f"### `{name}`")
        details.append("")
        for sc in s["scans"]:
            details.append(f"- scan `{sc['table']}`: ReadSchema `{short(sc['schema'])}`")
            if sc["pushed"]:
                details.append(f"  - PushedFilters `{short(sc['pushed'])}`")
            if sc["partition"]:
                details.append(f"  - PartitionFilters `{short(sc['partition'])}`")
        details.append("")
    lines += ["", "## Write plans", "",
              "The frames the sinks write, run once through the `noop` sink. `rebalance` on the partition columns "
              "clusters rows so each task writes few folders; AQE splits a hot partition value.", "",
              "| Written frame | Plan (final, top-down) |", "| --- | --- |"]
    for label, frame in write_frames(spark, sf):
        frame.write.format("noop").mode("overwrite").save()
        nodes = final_nodes(plan_text(frame, "formatted"))
        lines.append(f"| {label} | {' → '.join(nodes)} |")
    lines += ["", "## Scans per query", ""] + details
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
