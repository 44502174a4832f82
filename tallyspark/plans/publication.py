"""Publications: immutable documents that name one version of every output table of a pipeline.

A run writes its versions first and its document last, in one file, so an abandoned run leaves the head as
it was. Readers take one head and read nothing but the versions it names.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial
from typing import TypeVar

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..operators.quality import GATES, GateError, enforce, run_gates
from ..operators.serving import Frames
from ..schemas import AUDIT, PUBLICATION
from ..session import path_exists
from ..sources.versions import Store


class Publications:
    def __init__(self, store: Store):
        self.store, self.path = store, f"{store.root}/publications"

    def all(self) -> DataFrame:
        if not path_exists(self.store.spark, self.path):
            return self.store.spark.createDataFrame([], PUBLICATION)
        return self.store.spark.read.schema(PUBLICATION).parquet(self.path)

    def head(self, pipeline: str) -> Row | None:
        """The latest document of a pipeline: one bounded control row."""
        rows = self.all().where(F.col("pipeline") == pipeline).orderBy(F.col("sequence").desc()).limit(1).collect()
        return rows[0] if rows else None

    def publish(self, pipeline: str, sequence: int, as_of, bound: int, visibility: str, versions: dict[str, str], created_by: str) -> None:
        self.store.write_down()
        row = [(pipeline, sequence, as_of, bound, visibility, versions, created_by)]
        self.store.spark.createDataFrame(row, PUBLICATION).coalesce(1).write.mode("append").parquet(self.path)

    def frames(self, document: Row) -> Frames:
        """The tables of a publication at their pinned versions, each opened when it is asked for."""
        return Frames({t: partial(self.store.read, t, v) for t, v in document["versions"].items()})


def append_audit(store: Store, **facts) -> None:
    """Append one typed row about a run."""
    names = [c.split()[0] for c in AUDIT.replace("map<string,string>", "map").split(", ")]
    store.spark.createDataFrame([tuple(facts.get(n) for n in names)], AUDIT).coalesce(1).write.mode("append").parquet(f"{store.root}/pipeline_runs")


T = TypeVar("T")


def audited(store: Store, pipeline: str, dataset: str, run_id: str, work: Callable[[dict], T]) -> T:
    """Run work and record how it went, also when it fails.

    ``work`` may put further facts of the audit row into the mapping that it is given. The rows put out are those
    that the store counted while it wrote them, so nothing is read again.
    """
    facts = {"run_id": run_id, "pipeline": pipeline, "dataset": dataset, "started_at": datetime.now(timezone.utc)}
    store.rows.clear()
    try:
        out = work(facts)
    except Exception as e:
        kind = "gate" if isinstance(e, GateError) else type(e).__name__
        append_audit(store, **facts, ended_at=datetime.now(timezone.utc), status="FAILED", failure=f"{kind}: {e}"[:500])
        raise
    append_audit(store, **({"output_rows": sum(store.rows.values())} | facts), ended_at=datetime.now(timezone.utc), status="SUCCEEDED")
    return out


def audits(store: Store) -> DataFrame:
    """The audit rows of all runs."""
    return store.spark.read.schema(AUDIT).parquet(f"{store.root}/pipeline_runs")


def write_audit_publish(store: Store, df: DataFrame, table: str, version: int | str, publish: Callable[[str], None] | None = None, gates: dict | None = None) -> DataFrame:
    """Write a candidate, run the table's gates on what was written, and publish it; without ``publish`` it stays hidden.

    A hidden candidate stands beside what is published, so the first write of a table must be published. A name has
    letters, digits, dashes and underscores, and is not that of the published state.
    """
    if not re.fullmatch("[A-Za-z0-9_-]+", str(version)) or str(version) == "main":
        raise ValueError(f"a candidate can't be named {version!r}")
    if publish is None and not path_exists(store.spark, f"{store.root}/{table}"):
        raise ValueError(f"the first write of {table} must be published")
    candidate = store.write(df, table, f"candidate-{version}")
    enforce(table, run_gates(candidate, gates if gates is not None else GATES[table]))
    if publish:
        publish(f"candidate-{version}")
    return candidate
