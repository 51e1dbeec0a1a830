from helpers import docs_of, odd_rows, with_extra

from ordermart.llm import line_dedup as ld


def brute(rows, least):
    sites = {}
    for _, text, _, source in rows:
        for line in (text or "").split("\n"):
            sites.setdefault(line.strip(" "), set()).add(source)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not x.strip(" ") or len(sites[x.strip(" ")]) < least]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in df.select("doc_id", "text", "n_lines", "n_removed").collect()), key=str)


def spread(n_sites):
    """Lines on 1 to n_sites sites, around and far beyond the threshold."""
    rows = []
    for i in range(n_sites):
        lines = [f"line on {k}" + " " * (i % 3) for k in range(1, n_sites + 1) if i < k]
        rows.append((i, "\n".join([*lines, "", f"own {i}", "everywhere", "everywhere"]), "en", f"site{i}"))
    return rows + [(1000, None, None, None), (1001, "line on 4\nown 1001", "en", None), (1001, "line on 4\nown 1001", "en", None)]


def test_matches_brute_force(spark):
    for rows, least in ((spread(40), 5), (spread(40), 30), (odd_rows(), 2), (odd_rows(), 5)):
        docs = with_extra(docs_of(spark, rows))
        out = ld.dedup_lines(docs, least)
        assert found(out) == brute(rows, least)


def test_empty_table(spark):
    assert ld.dedup_lines(docs_of(spark, [])).count() == 0


def test_all_copies_of_a_text_lose_the_line(spark):
    rows = [(i, "head\nbody of all", "en", f"s{i % 9}") for i in range(300)]
    assert {r[1] for r in found(ld.dedup_lines(docs_of(spark, rows)))} == {""}
