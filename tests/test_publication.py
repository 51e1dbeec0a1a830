"""Versions: one number a publisher, readers at the version they resolved,
removal that spares what a reader may be at."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from csv_files import small_sources
from ordermart.plans import pipeline, publication

TS = dt.datetime(2018, 1, 1)
NONE = dt.timedelta(0)


def _run(spark, out, run_id, rows, publish=True):
    """A run of one table, with its stage log."""
    spark.range(rows).write.parquet(f"{out}/_runs/{run_id}/views/t")
    spark.range(1).write.json(f"{out}/_stages/{run_id}")
    return publication.publish(spark, out, run_id, TS, {"views/t": rows}) if publish else None


def test_publishers_at_one_instant_get_a_version_each(spark, tmp_dir):
    out = os.path.join(tmp_dir, "mart")
    assert publication.versions(spark, out) == [] and publication.resolve(spark, out) is None
    os.makedirs(f"{out}/_runs")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: publication.publish(spark, out, f"r{i}", TS, {}), range(8)))
    assert sorted(v.version for v in made) == list(range(1, 9))
    listed = publication.versions(spark, out)
    assert {(v.version, v.run_id) for v in listed} == {(v.version, v.run_id) for v in made}
    assert [v.version for v in listed] == list(range(8, 0, -1))
    assert not [f for f in os.listdir(f"{out}/_published") if f.startswith("_v")]


def test_a_manifest_is_never_overwritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p", "v1.json")
    assert publication._create(spark, path, "first") and not publication._create(spark, path, "second")
    assert open(path).read() == "first"


def test_readers_stay_at_their_version(spark, tmp_dir):
    out = os.path.join(tmp_dir, "mart")
    _run(spark, out, "a", 1)
    at = pipeline.published(spark, out)
    _run(spark, out, "b", 2)
    assert at.read("views", "t").count() == 1
    assert pipeline.read_published(spark, out, "views", "t").count() == 2
    assert pipeline.read_published(spark, out, "views", "t", version=1).count() == 1
    with pytest.raises(publication.PublicationError, match="no version 7"):
        pipeline.published(spark, out, 7)
    with pytest.raises(publication.PublicationError, match="has no views/u"):
        at.read("views", "u")
    at.verify()
    spark.range(5).write.mode("overwrite").parquet(f"{out}/_runs/a/views/t")
    with pytest.raises(publication.PublicationError, match="published 1, stored 5"):
        at.verify()


def test_vacuum_spares_readers_and_runs_under_way(spark, tmp_dir):
    out = os.path.join(tmp_dir, "mart")
    for i, run_id in enumerate("abc", 1):
        _run(spark, out, run_id, i)
    publication.publish(spark, out, "a", TS, {"views/t": 1})  # shown again, as version 4
    _run(spark, out, "under_way", 1, publish=False)
    # all were the newest within the last hour
    assert publication.vacuum(spark, out, keep=1, grace=dt.timedelta(hours=1)) == {"versions": [], "runs": []}
    assert publication.vacuum(spark, out, keep=2, grace=NONE)["versions"] == [1, 2]
    left = publication.versions(spark, out)
    assert [(v.version, v.run_id) for v in left] == [(4, "a"), (3, "c")]
    for v in left:
        v.verify()
    assert sorted(os.listdir(f"{out}/_runs")) == ["a", "c"] == sorted(os.listdir(f"{out}/_stages"))
    # numbers go on after the newest one left
    assert publication.publish(spark, out, "c", TS, {"views/t": 3}).version == 5
    with pytest.raises(ValueError):
        publication.vacuum(spark, out, keep=0)


def test_vacuum_keeps_a_young_run_never_published(spark, tmp_dir):
    out = os.path.join(tmp_dir, "mart")
    assert publication.vacuum(spark, out) == {"versions": [], "runs": []}
    _run(spark, out, "young", 1, publish=False)
    assert publication.vacuum(spark, out, grace=dt.timedelta(hours=1))["runs"] == []
    assert publication.vacuum(spark, out, grace=NONE)["runs"] == ["young"]


def test_a_run_publishes_its_rows_and_is_not_run_anew(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "mart")
    os.makedirs(src)
    small_sources(src)
    res = pipeline.run_pipeline(spark, out, source_dir=src, export=False, run_id="r")
    at = pipeline.published(spark, out)
    assert (at.version, at.run_id) == (res.version, "r") == (1, "r")
    assert {n.split("/")[0] for n in at.tables} == {"raw", "staging", "analytics", "views"}
    assert at.tables["views/dashboard_summary"] == 1
    at.verify()
    with pytest.raises(publication.PublicationError, match="is published"):
        pipeline.run_pipeline(spark, out, source_dir=src, export=False, run_id="r")
    assert pipeline.run_pipeline(spark, out, source_dir=src, export=False, run_id="r", resume=True).version == 2


def test_a_manifest_is_moved_by_a_rename_that_never_overwrites(spark, tmp_dir):
    """The way of file systems other than the local one, seen through a view of it."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pub.link./data", f"file://{tmp_dir}")
    path = "viewfs://pub/data/v1.json"
    assert publication._create(spark, path, "first") and not publication._create(spark, path, "second")
    assert open(os.path.join(tmp_dir, "v1.json")).read() == "first"
    assert [f for f in os.listdir(tmp_dir) if f.endswith(".json") or f.startswith("_")] == ["v1.json"]
