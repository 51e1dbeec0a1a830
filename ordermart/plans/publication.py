"""Published versions of a mart.

A version is one manifest, ``<out>/_published/v<number>.json``: the run it shows
and the rows of every table of it. A publisher takes the number after the newest
and creates that manifest only if nobody has: it is written aside and moved into
place by a rename that never overwrites, so two publishers at one instant get two
versions, in the order of their renames, and a reader sees whole manifests only.
(The rename is atomic on HDFS and on local disks; on an object store the guarantee
is the store's.)

A reader resolves a version once and reads the tables of that version, whatever is
published after it. ``vacuum`` removes what no kept version shows.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version bigint, run_id string, run_ts string, published_at string, tables map<string,bigint>"
TRIES = 1000  # publishers that may be in each other's way at one instant


class PublicationError(RuntimeError):
    """A published version is gone, or no longer holds the rows it showed."""


@dataclass(frozen=True)
class Version:
    spark: SparkSession
    out_dir: str
    version: int
    run_id: str
    published_at: _dt.datetime
    tables: dict

    @property
    def base(self) -> str:
        return f"{self.out_dir}/_runs/{self.run_id}"

    def read(self, layer: str, table: str) -> DataFrame:
        try:
            return self.spark.read.parquet(f"{self.base}/{layer}/{table}")
        except AnalysisException as e:
            raise PublicationError(f"version {self.version} of {self.out_dir} has no {layer}/{table}") from e

    def verify(self) -> None:
        """Every table still has the rows that were published (from the footers)."""
        wrong = []
        for name, rows in sorted(self.tables.items()):
            found = self.read(*name.split("/")).count()
            if found != rows:
                wrong.append(f"{name}: published {rows}, stored {found}")
        if wrong:
            raise PublicationError(f"version {self.version} of {self.out_dir}: {wrong}")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """A file with this text, unless there is one of that name: False then."""
    folder, name = path.rsplit("/", 1)
    aside, fs = _path(spark, f"{folder}/_{name}.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    target, _ = _path(spark, path)
    try:
        if fs.getUri().getScheme() == "file":  # a rename there overwrites; a link does not
            os.link(aside.toUri().getPath(), target.toUri().getPath())
            return True
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        never = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(aside, target, never)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    finally:
        fs.delete(aside, False)


def versions(spark: SparkSession, out_dir: str) -> list[Version]:
    """All published versions, the newest first."""
    out_dir = out_dir.rstrip("/")
    folder, fs = _path(spark, f"{out_dir}/_published")
    if not fs.exists(folder):
        return []
    rows = spark.read.schema(MANIFEST).option("pathGlobFilter", "v*.json").json(f"{out_dir}/_published").collect()
    found = [Version(spark, out_dir, r["version"], r["run_id"], _dt.datetime.fromisoformat(r["published_at"]), r["tables"] or {})
             for r in rows]
    return sorted(found, key=lambda v: -v.version)


def resolve(spark: SparkSession, out_dir: str, version: int | None = None) -> Version | None:
    """That version, or the newest; None before the first."""
    found = versions(spark, out_dir)
    if version is None:
        return found[0] if found else None
    for v in found:
        if v.version == version:
            return v
    raise PublicationError(f"{out_dir} has no version {version}")


def publish(spark: SparkSession, out_dir: str, run_id: str, run_ts: _dt.datetime, tables: dict) -> Version:
    """The run becomes the newest version; ``tables`` maps layer/table to rows."""
    out_dir = out_dir.rstrip("/")
    newest = resolve(spark, out_dir)
    number = newest.version if newest else 0
    for _ in range(TRIES):
        number += 1
        now = _dt.datetime.now(_dt.timezone.utc)
        manifest = dict(version=number, run_id=run_id, run_ts=run_ts.isoformat(), published_at=now.isoformat(), tables=tables)
        if _create(spark, f"{out_dir}/_published/v{number:010d}.json", json.dumps(manifest)):
            return Version(spark, out_dir, number, run_id, now, tables)
    raise PublicationError(f"{out_dir}: no free version after {TRIES} tries")


def _newest_change(spark: SparkSession, folder: str) -> _dt.datetime | None:
    """When a file below the folder last changed; None if it holds none."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    except AnalysisException:
        return None
    at = files.agg(F.unix_micros(F.max("modificationTime"))).first()[0]
    return None if at is None else _dt.datetime.fromtimestamp(at / 1e6, _dt.timezone.utc)


def vacuum(spark: SparkSession, out_dir: str, keep: int = 2,
           grace: _dt.timedelta = _dt.timedelta(days=1)) -> dict:
    """Removes versions that are neither among the newest ``keep`` nor were the
    newest within ``grace`` (a reader may still be at them), then the runs no
    kept version shows. A run never published, perhaps under way, stays until
    nothing in it or its stage log has changed for ``grace``, which must be longer
    than a stage and than a reader's work. Manifests go first: no reader resolves a
    version whose tables are being removed. Returns what went."""
    if keep < 1:
        raise ValueError("keep is at least 1: the newest version stays")
    out_dir = out_dir.rstrip("/")
    since = _dt.datetime.now(_dt.timezone.utc) - grace
    listed = versions(spark, out_dir)
    # a version was the newest until the next one came
    until = {v.version: newer.published_at for newer, v in zip(listed, listed[1:])}
    gone = [v for i, v in enumerate(listed) if i >= keep and until[v.version] < since]
    for v in gone:
        manifest, fs = _path(spark, f"{out_dir}/_published/v{v.version:010d}.json")
        fs.delete(manifest, False)
    shown = {v.run_id for v in versions(spark, out_dir)}  # listed again: a run may have been published meanwhile
    once = {v.run_id for v in gone}
    runs, fs = _path(spark, f"{out_dir}/_runs")
    removed = []
    for status in fs.listStatus(runs) if fs.exists(runs) else []:
        run_id = status.getPath().getName()
        if run_id in shown:
            continue
        places = [f"{out_dir}/{kind}/{run_id}" for kind in ("_runs", "_stages")]
        changes = [_dt.datetime.fromtimestamp(status.getModificationTime() / 1e3, _dt.timezone.utc)]
        changes += [c for c in (_newest_change(spark, p) for p in places) if c is not None]
        if run_id not in once and max(changes) >= since:
            continue
        for p in places:
            place, fs = _path(spark, p)
            fs.delete(place, True)
        removed.append(run_id)
    return {"versions": sorted(v.version for v in gone), "runs": sorted(removed)}
