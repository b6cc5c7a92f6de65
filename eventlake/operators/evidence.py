"""What an executed plan has really done, from Spark's own metrics."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame


def files_read(frame: DataFrame) -> int:
    """Data files that the scans of an executed frame were given, after pruning by partition and
    file; row groups may be skipped inside them.

    Looks into cached frames and into the stages of adaptive execution. A frame that has not run
    has read nothing.
    """
    return _metric(frame, "numFiles")


def rows_read(frame: DataFrame) -> int:
    """Rows that the file scans of an executed frame have given, before its filters: those of row
    groups that pushed filters could not skip."""
    return _metric(frame, "numOutputRows")


def _metric(frame: DataFrame, name: str) -> int:
    scans = _scans(frame._jdf.queryExecution().executedPlan())
    return sum(node.metrics().apply(name).value() for node in scans)


def scan_count(frame: DataFrame) -> int:
    """File scans in the plan of a frame; one that is used twice counts twice."""
    return len(list(_scans(frame._jdf.queryExecution().executedPlan())))


def _scans(node) -> Iterator:
    name = node.nodeName()
    if name.startswith("Scan parquet"):
        yield node
    elif name == "AdaptiveSparkPlan":
        yield from _scans(node.executedPlan())
    elif name.endswith("QueryStage"):
        yield from _scans(node.plan())
    elif name.startswith("InMemoryTableScan") or name.startswith("Scan In-memory"):
        yield from _scans(node.relation().cachedPlan())
    else:
        children = node.children()
        for i in range(children.size()):
            yield from _scans(children.apply(i))
