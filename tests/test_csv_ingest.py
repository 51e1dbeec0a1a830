import os

import pytest

from csv_files import small_sources, write_csv
from ordermart.schemas import RAW_COLUMNS, RAW_FILE_OF
from ordermart.sources import csv_ingest
from ordermart.sources.raw import run_timestamp


def test_ingest_reads_traps_exactly(spark, tmp_dir):
    small_sources(tmp_dir)
    raw = csv_ingest.ingest(spark, tmp_dir, run_timestamp())
    assert set(raw) == set(RAW_COLUMNS)
    rev = {r["review_id"]: r for r in raw["order_reviews"].collect()}
    assert len(rev) == 3                                    # embedded newline: still one row
    assert rev["r1"]["review_comment_message"] == 'said "great"\r\nsecond line'  # kept verbatim
    assert rev["r2"]["review_comment_message"] == "a\\b"    # backslash kept
    assert rev["r2"]["review_comment_title"] is None        # 'NA' is a null token
    assert rev["r1"]["review_comment_title"] is None        # blank is NULL
    cust = raw["customers"].collect()
    assert {r["customer_zip_code_prefix"] for r in cust} == {"01037", "20000"}  # leading zero kept
    assert cust[0]["customer_city"] in (" Sao Paulo", "campinas ", "rio")      # no trimming on load
    tr = raw["product_category_translation"].collect()       # BOM + CRLF file
    assert [tuple(r[:2]) for r in tr] == [("beleza_saude", "health_beauty")]
    o = {r["order_id"]: r for r in raw["orders"].collect()}
    assert o["o3"]["order_approved_at"] is None              # 'NaN' token
    assert {r["source_file"] for r in cust} == {RAW_FILE_OF["customers"]}
    assert len({r["loaded_at"] for t in raw for r in raw[t].select("loaded_at").collect()}) == 1


@pytest.mark.parametrize("header", [
    ["customer_unique_id", "customer_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city"],
    ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state", "x"],
    ["Customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
])
def test_header_must_match_exactly(spark, tmp_dir, header):
    small_sources(tmp_dir)
    write_csv(os.path.join(tmp_dir, RAW_FILE_OF["customers"]), header, [["a"] * len(header)])
    with pytest.raises(csv_ingest.SourceError):
        csv_ingest.ingest(spark, tmp_dir, run_timestamp())


def test_missing_file(spark, tmp_dir):
    small_sources(tmp_dir)
    os.remove(os.path.join(tmp_dir, RAW_FILE_OF["sellers"]))
    with pytest.raises(FileNotFoundError):
        csv_ingest.ingest(spark, tmp_dir, run_timestamp())


def test_short_row_fails_fast(spark, tmp_dir):
    small_sources(tmp_dir)
    write_csv(os.path.join(tmp_dir, RAW_FILE_OF["sellers"]), RAW_COLUMNS["sellers"], [["s1", "01037"]])
    with pytest.raises(Exception):
        csv_ingest.ingest(spark, tmp_dir, run_timestamp())["sellers"].collect()


def test_null_tokens(spark, tmp_dir):
    from ordermart.schemas import NULL_TOKENS

    small_sources(tmp_dir)
    rows = [[f"s{i}", t, "x", "SP"] for i, t in enumerate(NULL_TOKENS)] + [["s_ok", " NA", "x", "SP"]]
    write_csv(os.path.join(tmp_dir, RAW_FILE_OF["sellers"]), RAW_COLUMNS["sellers"], rows)
    got = {r["seller_id"]: r["seller_zip_code_prefix"]
           for r in csv_ingest.ingest(spark, tmp_dir, run_timestamp())["sellers"].collect()}
    assert all(got[f"s{i}"] is None for i in range(len(NULL_TOKENS)))
    assert got["s_ok"] == " NA"


def test_every_file_of_a_folder_must_have_the_header(spark, tmp_dir):
    small_sources(tmp_dir)
    folder = os.path.join(tmp_dir, RAW_FILE_OF["sellers"])
    os.remove(folder)
    os.makedirs(folder)
    write_csv(os.path.join(folder, "a.csv"), RAW_COLUMNS["sellers"], [["s1", "01037", "x", "SP"]])
    write_csv(os.path.join(folder, "b.csv"), RAW_COLUMNS["sellers"], [["s2", "01037", "x", "SP"]])
    assert csv_ingest.ingest(spark, tmp_dir, run_timestamp())["sellers"].count() == 2
    write_csv(os.path.join(folder, "b.csv"), [c.upper() for c in RAW_COLUMNS["sellers"]], [["s2", "01037", "x", "SP"]])
    with pytest.raises(Exception):
        csv_ingest.ingest(spark, tmp_dir, run_timestamp())["sellers"].collect()
