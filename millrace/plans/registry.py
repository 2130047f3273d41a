"""Model versions, aliases and the run log, as small tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace.functions.times import processing_time
from millrace.plans.store import Store
from millrace.sources.tables import TableMissing

CHALLENGER, CHAMPION, RETIRED, REJECTED = "challenger", "champion", "retired", "rejected"
RUN_COLUMNS = "run_id STRING, kind STRING, parent_id STRING, params MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>"


class Registry:
    """Each alias is held by one version; a version is a saved ``PipelineModel``."""

    def __init__(self, store: Store, now: datetime | None = None):
        self.store = store
        self.now = now
        self._aliases = store.control("aliases")
        self._versions = store.control("versions")
        self._runs = store.control("runs")

    # -- run log ---------------------------------------------------------------------------------------------------

    def log_runs(self, runs: list[dict]) -> list[str]:
        """Append runs of ``kind`` with ``params`` and ``metrics``; returns their ids."""
        rows = [
            (
                run.get("run_id") or uuid.uuid4().hex,
                run["kind"],
                run.get("parent_id"),
                {k: str(v) for k, v in run.get("params", {}).items()},
                {k: float(v) for k, v in run.get("metrics", {}).items() if v is not None},
            )
            for run in runs
        ]
        df = self.store.spark.createDataFrame(rows, RUN_COLUMNS).coalesce(1)
        self._runs.append(df.withColumn("created_at", processing_time(self.now)))
        return [row[0] for row in rows]

    def runs(self):
        """The run log."""
        return self._runs.read()

    def last_trained_count(self) -> int:
        """Labelled rows at the last successful training; 0 before the first."""
        try:
            runs = self._runs.read()
        except TableMissing:
            return 0
        count = F.col("params")["n_labeled"].cast("long")
        return runs.filter("kind = 'training'").agg(F.max_by(count, "created_at").alias("n")).first()["n"] or 0

    # -- versions and aliases --------------------------------------------------------------------------------------

    def register(self, model: PipelineModel, run_id: str, params: Mapping, alias: str) -> int:
        """Save a model as the next version and give it an alias."""
        spark = self.store.spark
        version = self._versions.read().count() + 1 if self._versions.exists() else 1
        model.write().overwrite().save(self.store.model_path(version))
        row = spark.createDataFrame(
            [(version, run_id, {k: str(v) for k, v in params.items()})],
            "version INT, run_id STRING, params MAP<STRING,STRING>",
        )
        self._versions.append(row.coalesce(1).withColumn("created_at", processing_time(self.now)))
        self.set_alias(alias, version)
        return version

    def set_alias(self, alias: str, version: int) -> None:
        """Move an alias to a version."""
        row = self.store.spark.createDataFrame([(alias, version)], "alias STRING, version INT").coalesce(1)
        self._aliases.merge(row.withColumn("updated_at", processing_time(self.now)), ["alias"])

    def drop_alias(self, alias: str) -> None:
        """Take an alias away; nothing happens when nobody holds it."""
        if self._aliases.exists():
            self._aliases.delete(self.store.spark.createDataFrame([(alias,)], "alias STRING"), ["alias"])

    def version_of(self, alias: str) -> int | None:
        """The version that holds an alias."""
        try:
            row = self._aliases.read().filter(F.col("alias") == alias).select("version").first()
        except TableMissing:
            return None
        return None if row is None else row["version"]

    def load(self, version: int) -> PipelineModel:
        return PipelineModel.load(self.store.model_path(version))
