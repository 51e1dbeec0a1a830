"""Progress of a run, so that a rerun goes on where the last one stopped.

A stage that is done appends one row to ``<out>/_stages/<run_id>``: its id, the
id of the stage it was built after (the first: the fingerprint of the input
files) and what it found (rows per table, gate results). A rerun takes a stage
over when its newest row is done, was built after the stage that stands now,
and its tables still hold those rows. A stage that runs again has a new id, so
everything after it runs again too. One runner at a time may hold a run_id.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "step int, stage string, state string, id string, after string, found string"


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Names, lengths and modification times of all files of a folder as sums
    of hashes, in no order; contents are not read. A missing folder has none:
    it is the load that refuses it."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    except AnalysisException:
        return ""
    one = F.struct("path", "length", "modificationTime")
    total = files.agg(*[F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("string")
                        for h in (F.xxhash64(one), F.xxhash64(F.lit("again"), one))], F.count(F.lit(1)).cast("string")).first()
    return ":".join(total)


class Stages:
    """The stages of one run, in the order they are asked for."""

    def __init__(self, spark: SparkSession, path: str, inputs: str, known: bool, resume: bool):
        """``known``: an earlier run may have left a log; ``resume``: its stages count."""
        self.spark, self.path, self.after, self.resume = spark, path, inputs, resume
        self.reused: list[str] = []
        self.rows: dict[str, int] = {}  # of every stored table, by folder/table
        rows = self._log() if known else []
        self.step = max((r["step"] for r in rows), default=0)
        self.newest = {r["stage"]: r for r in sorted(rows, key=lambda r: r["step"])}

    def _log(self) -> list:
        try:
            return self.spark.read.schema(LOG).json(self.path).collect()
        except AnalysisException:
            return []

    def _append(self, stage: str, state: str, id: str, found) -> None:
        self.step += 1
        row = dict(step=self.step, stage=stage, state=state, id=id, after=self.after, found=json.dumps(found))
        self.spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()]).coalesce(1).write.mode("append").json(self.path)

    def run(self, stage: str, build: Callable, take: Callable):
        """``build()`` gives (value, found); ``take(found)`` the same value from
        what an earlier run stored, or None if that is no longer whole."""
        row = self.newest.get(stage)
        if row and self.resume and row["state"] == "done" and row["after"] == self.after:
            self.found = json.loads(row["found"])
            value = take(self.found)
            if value is not None:
                self.after = row["id"]
                self.reused.append(stage)
                return value
        if row:  # its tables are about to be overwritten: the old row counts no more
            self._append(stage, "begun", "", None)
        value, self.found = build()
        id = uuid.uuid4().hex
        self._append(stage, "done", id, self.found)
        self.after = id
        return value

    def layer(self, stage: str, base: str, write: Callable[[], dict[str, tuple[DataFrame, int]]]) -> dict[str, DataFrame]:
        """A stage that stores tables under ``base``; ``write`` tells each with its rows."""
        def build():
            stored = write()
            return {t: df for t, (df, _) in stored.items()}, {t: n for t, (_, n) in stored.items()}

        def take(rows):
            try:
                tables = {t: self.spark.read.parquet(f"{base}/{t}") for t in rows}
            except AnalysisException:
                return None
            return tables if all(tables[t].count() == n for t, n in rows.items()) else None

        tables = self.run(stage, build, take)
        self.rows |= {f"{base.rsplit('/', 1)[1]}/{t}": n for t, n in self.found.items()}
        return tables

    def gate(self, stage: str, check: Callable[[], list], number: Callable):
        """A stage that only finds: lists of rows whose ``actual`` is ``number``
        of text. One that fails raises, so it is never taken over."""
        def build():
            found = check()
            return found, json.loads(json.dumps(found, default=str))

        def take(found):
            for r in found[0]:
                r["actual"] = None if r["actual"] is None else number(r["actual"])
            return found

        return self.run(stage, build, take)
