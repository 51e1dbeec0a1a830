"""Input columns that are named like the operators' own helper columns."""

import pytest
from pyspark.sql import functions as F

from helpers import docs_of, odd_rows
from ordermart.llm import exact_dedup, mixing, simhash

NAMES = ["__gone", "__d", "__digest", "__id", "__k", "__ties", "__size", "__key", "__mix", "__source", "__plan", "__copy", "own0"]


@pytest.mark.parametrize("rows_of", [exact_dedup.keep_one, simhash.keep_one, mixing.mixed])
def test_columns_named_like_helpers_go_through(spark, rows_of):
    docs = docs_of(spark, odd_rows())
    named = docs.withColumns({c: F.concat(F.lit(c), F.coalesce("text", F.lit(""))) for c in NAMES})
    out = rows_of(named)
    assert out.columns == named.columns
    got = out.collect()
    assert all(r[c] == c + (r["text"] or "") for r in got for c in NAMES)
    want = rows_of(docs).collect()
    assert sorted((tuple(r[c] for c in docs.columns) for r in got), key=str) == sorted(map(tuple, want), key=str) and want
    empty = rows_of(named.limit(0))
    assert empty.columns == named.columns and empty.collect() == []
