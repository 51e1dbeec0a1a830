import hashlib

from helpers import collect, docs_of, odd_rows, with_extra

from ordermart.llm import exact_dedup as ed
from ordermart.llm.common import scratch_path


def brute(rows):
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for doc, text, *_ in rows:
        ids = [d for d in groups[text or ""] if d is not None]
        keep = max(ids) if ids else None
        out.append((doc, hashlib.sha256((text or "").encode()).hexdigest(), keep, len(groups[text or ""]), doc == keep))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, bytes(r.digest).hex(), r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


def test_matches_brute_force_on_odd_rows(spark):
    docs = with_extra(docs_of(spark, odd_rows()))
    for batches in (1, 2, 3):
        index = ed.DigestIndex(spark, scratch_path(spark, "t"), buckets=4)
        assert found(ed.dedup(docs, index, batches)) == brute(odd_rows())


def test_empty_table(spark):
    docs = docs_of(spark, [])
    assert ed.dedup(docs, ed.DigestIndex(spark, scratch_path(spark, "t"), 4)).count() == 0
    assert ed.keep_one(docs).count() == 0


def test_index_persists_and_new_data_is_deduplicated_against_it(spark):
    path = scratch_path(spark, "t")
    first = ed.DigestIndex(spark, path, buckets=4)
    ed.dedup(docs_of(spark, [(1, "x", "en", "s"), (2, "y", "en", "s")]), first)
    spark.sql(f"DROP TABLE {first.table}")  # as in a new session: only the files are left
    again = ed.DigestIndex(spark, path, buckets=4)
    rows = collect(ed.dedup(docs_of(spark, [(7, "y", "en", "s"), (8, "z", "en", "s"), (9, "z", "en", "s")]), again), "doc_id")
    assert [(r["doc_id"], r["keep_id"], r["kept"]) for r in rows] == [(7, 2, False), (8, 9, False), (9, 9, True)]
    assert again.read().count() == 3


def test_anti_join_reads_the_index_without_exchange(spark):
    index = ed.DigestIndex(spark, scratch_path(spark, "t"), buckets=4)
    index.append(ed.digests(docs_of(spark, odd_rows())))
    plan = index.unseen(ed.digests(docs_of(spark, odd_rows())))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange") == 1  # the new digests' aggregate


def test_keep_one_keeps_columns_and_one_row_of_each_text(spark):
    docs = with_extra(docs_of(spark, odd_rows()))
    kept = ed.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({r[1] or "" for r in odd_rows()})
    assert {r.doc_id for r in kept.collect()} == {2, 4, 5, 6, 7, 8, 9}
