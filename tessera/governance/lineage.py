"""Lineage of committed runs: a small labelled graph of datasets and jobs."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.governance.control import ControlPlane


def record(control: ControlPlane, run_id: str, job: str, sources: Sequence[str], target: str, columns: Mapping[str, Mapping[str, str]] | None = None) -> int:
    """source -reads-> job and source -derives-> target for each source, job -writes-> target; the new edges.

    What is there already isn't repeated; a dataset that derives from itself is a ValueError.
    columns: for each source, the target's columns and what they come from; kept with the
    derives edge.
    """
    if target in sources:
        raise ValueError(f"{target} can't derive from itself")
    before = control.rows("SELECT count(*) FROM lineage_edge")[0][0]
    with control.transaction() as c:
        nodes = [("job", job), ("dataset", target), *(("dataset", s) for s in sources)]
        c.executemany("INSERT OR IGNORE INTO lineage_node (kind, name) VALUES (?, ?)", nodes)
        of = {n: c.execute("SELECT id FROM lineage_node WHERE kind = ? AND name = ?", n).fetchone()[0] for n in nodes}
        edges = [(of["job", job], of["dataset", target], "writes", run_id, None)]
        for s in sources:
            mapping = json.dumps(dict(columns[s]), sort_keys=True) if columns and s in columns else None
            edges += [(of["dataset", s], of["job", job], "reads", run_id, None), (of["dataset", s], of["dataset", target], "derives", run_id, mapping)]
        c.executemany("INSERT OR IGNORE INTO lineage_edge (source, target, kind, run_id, column_mapping) VALUES (?, ?, ?, ?, ?)", edges)
    return control.rows("SELECT count(*) FROM lineage_edge")[0][0] - before


def upstream(control: ControlPlane, dataset: str) -> set[str]:
    """All datasets that one derives from, at any distance."""
    found = control.rows(
        "WITH RECURSIVE up(name) AS (SELECT ? UNION SELECT l.source FROM lineage l JOIN up ON l.target = up.name WHERE l.edge = 'derives') SELECT name FROM up", dataset
    )
    return {r["name"] for r in found} - {dataset}


def columns_of(control: ControlPlane, dataset: str) -> dict[str, dict[str, str]]:
    """Of the newest edge from each source: what the dataset's columns come from."""
    found = control.rows("SELECT source, column_mapping FROM lineage WHERE target = ? AND edge = 'derives' AND column_mapping IS NOT NULL", dataset)
    return {r["source"]: json.loads(r["column_mapping"]) for r in found}


def as_dataframe(spark: SparkSession, control: ControlPlane) -> DataFrame:
    rows = [tuple(r) for r in control.rows("SELECT source_kind, source, edge, target_kind, target, run_id FROM lineage")]
    return spark.createDataFrame(rows, "source_kind string, source string, edge string, target_kind string, target string, run_id string")
