"""Rows name the file they are from, and every file's records are accounted for."""

import os

import pytest
from pyspark.sql import functions as F

from csv_files import write_csv
from ordermart.schemas import RAW_COLUMNS, RAW_FILE_OF
from ordermart.sources import csv_ingest
from ordermart.sources.raw import run_timestamp, to_raw

CELLS = {
    "sellers": lambda k, i: [f"s{k}-{i}", "01000", "town", "SP"],
    "order_reviews": lambda k, i: [f"r{k}-{i}", "o1", "5", "", "two\nlines, \"said\"", "2017-01-01 00:00:00", "2017-01-02 00:00:00"],
}


def deliver(folder, table, sizes):
    names = {}
    for k, (name, n) in enumerate(sizes.items()):
        path = os.path.join(folder, RAW_FILE_OF[table], name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        write_csv(path, RAW_COLUMNS[table], [CELLS[table](k, i) for i in range(n)])
        names[f"{RAW_FILE_OF[table]}/{name}"] = n
    return names


def load(spark, folder, table):
    return to_raw(csv_ingest.read_files(spark, folder, table), table, run_timestamp())


def found(spark, folder, table, raw):
    return {r["source_file"]: tuple(r)[1:] for r in csv_ingest.reconcile_files(spark, folder, table, raw).collect()}


@pytest.mark.parametrize("table", sorted(CELLS))
def test_rows_of_a_folder_name_their_files(spark, tmp_dir, table):
    names = deliver(tmp_dir, table, {"a.csv": 3, "day=1/x.csv": 2, "day=2/x.csv": 1, "none.csv": 0})
    raw = load(spark, tmp_dir, table)
    assert raw.columns == [*RAW_COLUMNS[table], "source_file", "loaded_at"]
    key = RAW_COLUMNS[table][0]
    by_file = {r["source_file"]: r for r in raw.groupBy("source_file").agg(F.count("*").alias("n"), F.collect_set(F.substring(key, 2, 1)).alias("of")).collect()}
    assert {f: r["n"] for f, r in by_file.items()} == {f: n for f, n in names.items() if n}
    assert all(len(r["of"]) == 1 for r in by_file.values())
    assert found(spark, tmp_dir, table, raw) == {f: (n, n, "PASS") for f, n in names.items() if n}


@pytest.mark.parametrize("table", sorted(CELLS))
def test_a_single_file_keeps_its_declared_name(spark, tmp_dir, table):
    write_csv(os.path.join(tmp_dir, RAW_FILE_OF[table]), RAW_COLUMNS[table], [CELLS[table](0, i) for i in range(4)])
    raw = load(spark, tmp_dir, table)
    assert found(spark, tmp_dir, table, raw) == {RAW_FILE_OF[table]: (4, 4, "PASS")}


@pytest.mark.parametrize("table", sorted(CELLS))
def test_lost_repeated_and_foreign_rows_show_by_file(spark, tmp_dir, table):
    names = list(deliver(tmp_dir, table, {"a.csv": 3, "b.csv": 2, "c.csv": 1}))
    raw = load(spark, tmp_dir, table)
    # as many rows in all: a's last is lost, b's are whole, c's is there twice
    key = RAW_COLUMNS[table][0]
    kept = raw.where(~F.col(key).endswith("0-2")).unionByName(raw.where(F.col("source_file") == names[2]))
    assert kept.count() == 6
    assert found(spark, tmp_dir, table, kept) == {names[0]: (3, 2, "FAIL"), names[1]: (2, 2, "PASS"), names[2]: (1, 2, "FAIL")}
    foreign = raw.withColumn("source_file", F.lit("other.csv"))
    assert found(spark, tmp_dir, table, foreign)["other.csv"] == (0, 6, "FAIL")


@pytest.mark.parametrize("table", sorted(CELLS))
def test_every_file_of_a_folder_has_the_declared_header(spark, tmp_dir, table):
    deliver(tmp_dir, table, {"a.csv": 3})
    wrong = ["renamed", *RAW_COLUMNS[table][1:]]
    write_csv(os.path.join(tmp_dir, RAW_FILE_OF[table], "b.csv"), wrong, [CELLS[table](1, 0)])
    with pytest.raises(Exception, match="(?i)renamed|header"):
        load(spark, tmp_dir, table).collect()
