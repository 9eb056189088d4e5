"""Read facts off a DataFrame's physical plan (used by tests and the bench)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The physical plan as text, including subquery plans."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(df: DataFrame, pattern: str) -> int:
    return len(re.findall(pattern, physical_plan(df)))


def scans(df: DataFrame) -> list[dict[str, str]]:
    """Each Parquet scan: file, read schema, pushed filters."""
    out = []
    for m in re.finditer(
        r"FileScan parquet [^\n]*?PushedFilters: (\[[^\n]*?\]), ReadSchema: (struct<[^\n]*?>)",
        physical_plan(df),
    ):
        loc = re.search(r"\[file:[^\]]*/([^/\]]+)\]", m.group(0))
        out.append(
            {"table": loc.group(1) if loc else "?", "pushed": m.group(1), "schema": m.group(2)}
        )
    return out


def exchanges(df: DataFrame) -> int:
    return count_nodes(df, r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)")


def has_python(df: DataFrame) -> bool:
    return count_nodes(df, r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF)") > 0


def _tree_lines(plan: str) -> list[tuple[int, str]]:
    """(column, text) of each operator line in a plan tree string; the
    column is where the operator name starts, so children sit deeper."""
    out = []
    for line in plan.splitlines():
        m = re.match(r"^([\s:|]*)(\+- |:- )?(\*?\(?\d*\)?\s*)?([A-Z].*)$", line)
        if not m or not (m.group(2) or not m.group(1)):
            continue
        out.append((len(line) - len(m.group(4)), m.group(4)))
    return out


def _children(lines: list[tuple[int, str]], i: int) -> list[int]:
    depth = lines[i][0]
    kids, child_depth = [], None
    for j in range(i + 1, len(lines)):
        d, text = lines[j]
        if d <= depth:
            break
        if child_depth is None:
            child_depth = d
        if d == child_depth and not text.startswith(("Subquery", "ReusedSubquery")):
            kids.append(j)
    return kids


_AGGREGATE = re.compile(r"(HashAggregate|ObjectHashAggregate|SortAggregate)")
_PASS_THROUGH = re.compile(r"(Project|Filter) ")


def _producers(lines, i) -> list[str]:
    """Operators that produce node i's rows, looking through projections,
    filters and unions."""
    text = lines[i][1]
    if _PASS_THROUGH.match(text) or text.startswith("Union"):
        out = []
        for k in _children(lines, i):
            out.extend(_producers(lines, k))
        return out
    return [text]


def shuffle_inputs(df: DataFrame) -> list[tuple[str, str]]:
    """For each shuffle (hash, range or single-partition Exchange), each
    operator producing its rows (through projections, filters and unions):
    (exchange text, producer text)."""
    lines = _tree_lines(physical_plan(df))
    pairs = []
    for i, (_, text) in enumerate(lines):
        if re.match(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", text):
            for k in _children(lines, i):
                for producer in _producers(lines, k):
                    pairs.append((text, producer))
    return pairs


def unaggregated_shuffles(df: DataFrame) -> list[tuple[str, str]]:
    """Shuffles fed by rows that are neither aggregated nor a bounded,
    parameter-sized range (e.g. the days of a report window)."""
    return [
        (ex, producer)
        for ex, producer in shuffle_inputs(df)
        if not (_AGGREGATE.match(producer) or producer.startswith("Range ("))
    ]
