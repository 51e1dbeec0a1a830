import csv
import os
import random

import pytest

from ordermart.schemas import RAW_COLUMNS, RAW_FILE_OF, raw_text_schema
from ordermart.sources import csv_ingest, csv_records

TABLE = "order_reviews"


@pytest.fixture()
def small_splits(spark):
    """Splits of 512 bytes, so that a small file is many tasks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "512")
    yield
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def rows(n, seed=1):
    r = random.Random(seed)
    texts = ["", "plain", 'said "so"', "two\nlines", "crlf\r\ninside", "\n", '"', '""', "a,b", 'x",\n"y', "é日本", " blanks ",
             "many\n" * 400, "\r", "end\\"]
    return [[f"r{i}", f"o{i % 7}", str(1 + i % 5), r.choice(texts), r.choice(texts), "2017-11-11 00:00:00", "2017-11-12 00:00:00"]
            for i in range(n)]


def write(folder, name, data, end="\n", bom=False, last_end=True):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write("﻿" if bom else "")
        csv.writer(f, lineterminator=end).writerows([RAW_COLUMNS[TABLE], *data])
    if not last_end:
        with open(path, "rb+") as f:
            f.truncate(os.path.getsize(path) - len(end))
    return path


def as_multiline(spark, path):
    return (spark.read.schema(raw_text_schema(TABLE)).option("header", True).option("mode", "FAILFAST").option("quote", '"')
            .option("escape", '"').option("multiLine", True).csv(path))


def cells(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def by_csv_module(data):
    return sorted((tuple(c if c != "" else None for c in r) for r in data), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_in_many_splits(spark, tmp_dir, small_splits, end):
    data = rows(300)
    path = write(tmp_dir, RAW_FILE_OF[TABLE], data, end, bom=True)
    assert csv_records.lines(spark, path).rdd.getNumPartitions() > 100
    got = csv_ingest.read_source(spark, tmp_dir, TABLE)
    assert cells(got) == by_csv_module(data)
    assert [r.records for r in csv_records.record_counts(spark, path).collect()] == [300]


def test_equals_the_multiline_reader(spark, tmp_dir, small_splits):
    path = write(tmp_dir, RAW_FILE_OF[TABLE], rows(200, 2), last_end=False)
    assert cells(csv_ingest.read_source(spark, tmp_dir, TABLE)) == cells(as_multiline(spark, path))


def test_a_folder_of_files(spark, tmp_dir, small_splits):
    folder = os.path.join(tmp_dir, RAW_FILE_OF[TABLE])
    parts = [rows(40, k) for k in range(3)]
    for k, part in enumerate(parts):
        write(folder, f"part-{k}.csv", part, ["\n", "\r\n", "\n"][k])
    assert cells(csv_ingest.read_source(spark, tmp_dir, TABLE)) == by_csv_module([r for p in parts for r in p])
    assert sorted(r.records for r in csv_records.record_counts(spark, folder).collect()) == [40, 40, 40]


def test_only_a_header(spark, tmp_dir):
    write(tmp_dir, RAW_FILE_OF[TABLE], [])
    assert csv_ingest.read_source(spark, tmp_dir, TABLE).count() == 0


@pytest.mark.parametrize("tail", ['r9,o1,5,"open', "r9,o1,5\n"])
def test_broken_files_abort(spark, tmp_dir, tail):
    path = write(tmp_dir, RAW_FILE_OF[TABLE], rows(20))
    with open(path, "a") as f:
        f.write(tail)
    with pytest.raises(Exception, match="Unpaired quote|MALFORMED|malformed"):
        csv_ingest.read_source(spark, tmp_dir, TABLE).collect()
