"""Every registered query against its DuckDB oracle on the smallest scale."""


from oracle_compare import compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as ent

    df = ent.entry(spark)
    assert df.count() > 0
    assert "order_month" in df.columns


def test_all_queries_match_oracle(spark):
    import __spark_entry__ as ent

    from ordermart.plans.catalog import QUERIES

    assert set(QUERIES) <= set(ent.oracle_sql())
    res = compare(spark, SF, list(QUERIES))
    bad = {k: v for k, v in res.items() if not v.startswith("OK")}
    assert not bad, bad
