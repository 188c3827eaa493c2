"""Guards that read a query's plan before it runs."""

from __future__ import annotations

import io
import re
from collections.abc import Iterable
from contextlib import redirect_stdout

from pyspark.sql import DataFrame

UNITS = {"B": 1, "KiB": 1 << 10, "MiB": 1 << 20, "GiB": 1 << 30, "TiB": 1 << 40, "PiB": 1 << 50, "EiB": 1 << 60}
DEFAULT_SCAN_LIMIT = 10 << 30


class PartitionFilterError(RuntimeError):
    """A table was read without a filter on its partition column, or by a scan that does not show its filters."""


class ScanLimitError(RuntimeError):
    """A query would read more than it may."""


def plan_text(df: DataFrame, mode: str) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


# Leaves of a plan that read no table.
NO_TABLE = ("LocalTableScan", "Range", "OneRowRelation", "EmptyRelation")


def file_scans(df: DataFrame) -> list[dict[str, str]]:
    """Operator, location, partition filters and pushed filters of every leaf of the plan that reads something."""
    text = plan_text(df, "formatted")
    scans = []
    for block in re.split(r"\n\s*\n", text):
        head = re.match(r"\(\d+\) (.+)", block.strip())
        reads = head and not re.search(r"^Input(?: \[\d+\])?:|^Arguments: \d+$", block, re.M)
        if reads and not head[1].startswith((*NO_TABLE, "ReusedExchange", "AdaptiveSparkPlan", "Subquery", "ReusedSubquery")):
            part = dict(re.findall(r"^(Location|PartitionFilters|PushedFilters|ReadSchema): (.*)$", block, re.M))
            kept = {k: part.get(k, "") for k in ("Location", "PartitionFilters", "PushedFilters", "ReadSchema")}
            scans.append({"Operator": head[1].split(" (")[0].strip(), **kept})
    return scans


def require_partition_filter(df: DataFrame, column: str, exempt: Iterable[str] = ()) -> DataFrame:
    """The query itself, if every scanned table is limited by its partition column.

    A scan that does not list its partition filters (a connector's, an RDD's) is refused: nothing shows what it reads.
    """
    exempt = tuple(exempt)
    named = re.compile(rf"(?<![\w.`]){re.escape(column)}(?:#\d+)?(?!\w)")
    for scan in file_scans(df):
        if scan["Location"] and any(e in scan["Location"] for e in exempt):
            continue
        tests = [t for t in re.split(r", (?![^(]*\))", scan["PartitionFilters"].strip("[]")) if named.search(t)]
        if not [t for t in tests if "isnotnull" not in t]:
            what = scan["Location"] or scan["Operator"]
            raise PartitionFilterError(f"{what} is read without a filter on {column}")
    return df


def scan_bytes(df: DataFrame) -> int:
    """Estimated bytes of the plan's inputs: catalog tables after partition pruning, bare paths before it."""
    text = plan_text(df, "cost").split("== Physical Plan ==")[0].split("== Optimized Logical Plan ==")[1]
    total = 0
    lines = [line for line in text.splitlines() if line.strip()]
    depth = [re.match(r"[\s:+\-|]*", line).end() for line in lines]
    for i, line in enumerate(lines):
        if i + 1 < len(lines) and depth[i + 1] > depth[i]:
            continue  # not a leaf
        m = re.search(r"sizeInBytes=([\d.]+(?:E\+?\d+)?) ([KMGTPE]?i?B)", line)
        if not m:
            raise ScanLimitError(f"the size of an input is not known: {line.strip()[:200]}")
        total += int(float(m.group(1)) * UNITS[m.group(2)])
    return total


def require_scan_within(df: DataFrame, limit: int = DEFAULT_SCAN_LIMIT) -> DataFrame:
    """The query itself, if its inputs stay within the limit."""
    size = scan_bytes(df)
    if size > limit:
        raise ScanLimitError(f"would read {size:,} bytes, limit {limit:,}")
    return df
