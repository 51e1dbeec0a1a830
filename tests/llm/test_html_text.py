import numpy as np
import pytest

from ordermart.llm import html_text as ht

SHELL = ("<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
         "<body><nav><ul><li><a href='/a'>Menu one</a><li>two</ul></nav><!-- ad --><div class=\"ad\">Buy &amp; sell</div>{}"
         "<footer>&copy; site</footer></body></html>")


def text(page):
    import pandas as pd

    return ht.extract_part(pd.DataFrame({"page_id": [1], "url": ["u"], "html": [page]}))["text"][0]


@pytest.mark.parametrize("body,want", [
    ("<article><h1>Title</h1><p>One\n two&amp;&amp; &#233;<p>Three<br>four</article>", "Title\n\nOne two&& é\n\nThree four"),
    ("<article><p><b>open<br><p>next <i>it</i>alic</p></article>", "open\n\nnext italic"),
    ("<article><header><h1>In</h1></header><p>a</p><div class='share social'>Share</div><aside>side</aside>"
     "<form><p>mail</p><input></form><section id=comments><p>c</p></section><p>b</p></article>", "In\n\na\n\nb"),
    ("<main><div>x</div><script>no</script><div>y</div></main><div>outside</div>", "x\n\ny"),
    ("<div role=main><p>m</p></div><p>o</p>", "m"),
    ("<div class=cookie-notice>cookies</div><p>plain page</p><div id='sidebar'>s</div>", "plain page"),
    ("<header>head</header><article>a &lt;b&gt; <![CDATA[c]]></article>", "a <b> c"),
    ("<article><span class=ad>x</span>text <span>in <span>two</span></span> end</article>", "text in two end"),
    ("<article><p title=\"a>b\">quoted</p><p hidden>h</p><p style='display: none'>h</p></article>", "quoted"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>c1<td>c2</table></article>", "1\n\n2\n\nc1\n\nc2"),
    ("<article>unclosed <p>to the end", "unclosed\n\nto the end"),
    ("", ""),
])
def test_blocks(body, want):
    assert text(SHELL.format(body)) == want


@pytest.mark.parametrize("page,want", [
    ("<html><head><title>T</title><meta charset=utf-8><body><p>a</p></body></html>", "a"),
    ("<!DOCTYPE html><html><head><title>T</title><link rel=x><div><article><p>a</p></article></div>", "a"),
    ("<head><style>p{}</style>bare text<p>b", "bare text\n\nb"),
    ("<body><div class='no-sidebar'><nav>n</nav><article><p>a</p></article></div></body>", "a"),
    ("<body><div class='has-nav'><p>no article is marked</p></div></body>", "no article is marked"),
    ("<body><div id=share-page><div class='promo wide'><main><p>a</p></main></div></div></body>", "a"),
    ("<body><article class='post social'><p>a</p><div class='social'>s</div></article></body>", "a"),
    ("<body><main id='share-price'><div class=related><article class=sponsored><p>a</p></article></div></main></body>", "a"),
    ("<body><form id=f><div class=menu>m</div><article><p>a</p><form><p>b</p></form></article></form></body>", "a"),
    ("<body><form action=/><nav>n</nav><p>the text of the whole page</p></form><p>end</p></body>", "the text of the whole page\n\nend"),
    ("<body><article><p>a</p><ol class=comments><li><article class=comment><p>c</p></article></ol></article></body>", "a"),
])
def test_no_rule_drops_an_article(page, want):
    assert text(page) == want


PROSE = " ".join(f"word{i}" for i in range(40))
LINKS = "".join(f"<li><a href=/{i}>another piece of this site</a></li>" for i in range(20))


@pytest.mark.parametrize("page,want", [
    (f"<body><p>a</p><div class='related-work'><h2>Related work</h2><p>{PROSE}</p></div></body>", f"a\n\nRelated work\n\n{PROSE}"),
    (f"<body><p>a</p><div id='share'><p>{PROSE} <a href=/x>a source</a></p></div></body>", f"a\n\n{PROSE} a source"),
    (f"<article><p>a</p><section class=social-policy><p>{PROSE}</p><p>b</p></section></article>", f"a\n\n{PROSE}\n\nb"),
    (f"<body><p>a</p><div class=related><div class=share><p>{PROSE}</p></div></div></body>", f"a\n\n{PROSE}"),
    # lists of links, short texts and words that leave no doubt
    (f"<body><p>a</p><ul class=related>{LINKS}</ul></body>", "a"),
    (f"<article><p>a</p><ul class='related share'>{LINKS}</ul></article>", "a"),
    ("<body><p>a</p><div class=share>Share it with all of your friends</div></body>", "a"),
    (f"<body><p>a</p><div class='related sidebar'><p>{PROSE}</p></div></body>", "a"),
    (f"<body><p>a</p><div class=related><div class=comments><p>{PROSE}</p></div></div></body>", "a"),
    (f"<body><p>a</p><form class=share><p>x</p></form><p>{PROSE}</p></body>", f"a\n\n{PROSE}"),
])
def test_doubtful_words_drop_no_prose(page, want):
    assert text(page) == want


def test_the_array_decides_prose_under_a_doubtful_word(spark):
    """What the host repeats of it goes, as it is; unique runs stay."""
    site = own_text(10**6, 40)
    page = "<body><p>{}</p><div class=share><p>{}</p></div><div class='related-work'><p>{}</p></div></body>"
    texts = texts_of(spark, [page.format(own_text(i), site, own_text(100 + i)) for i in range(12)])
    assert texts == {i: f"{own_text(i)}\n\n{own_text(100 + i)}" for i in range(12)}
    assert texts == texts_of(spark, [page.format(own_text(i), site, own_text(100 + i)) for i in range(12)], part_bytes=2000, coverage=False)


def test_odd_markup_never_fails():
    for page in (None, "", "<", "<p", "<!--", "<script>", "</p>", "a<b", "<a title=\"x>y", "&", "&#x110000;", "<article", "x" * 200000,
                 "<p>" * 20000 + "deep", "<div>" * 3000 + "t"):
        assert isinstance(text(page), str)
    assert text("a < b &amp; c") == "a < b & c"


def slow_cover(streams, run):
    where = {}
    for p, s in enumerate(streams):
        for i in range(len(s) - run + 1):
            where.setdefault(tuple(s[i:i + run]), set()).add(p)
    out = []
    for s in streams:
        mark = [False] * len(s)
        for i in range(len(s) - run + 1):
            if len(where[tuple(s[i:i + run])]) > 1:
                mark[i:i + run] = [True] * run
        out += mark
    return out


def test_suffix_array_covers_repeats_across_pages():
    r = np.random.default_rng(4)
    for run in (1, 2, 3, 6, 8):
        for _ in range(20):
            streams = [r.integers(0, 4, r.integers(0, 40)).tolist() for _ in range(6)]
            tokens = np.array([t for s in streams for t in s], np.int64)
            page = np.repeat(np.arange(6), [len(s) for s in streams])
            assert ht.repeated(tokens, page, run).tolist() == slow_cover(streams, run)


def page_rows(n):
    notice = "<div>Please read our house rules before you write to us</div>"
    return [(i, f"https://h.example.com/{i}", f"<body>{notice}<div>{i} has words of its own, {i * i} of them</div></body>") for i in range(n)]


def test_repeated_runs_go_where_no_article_is_marked(spark):
    pages = spark.createDataFrame(page_rows(12), "page_id bigint, url string, html string")
    for r in ht.main_texts(pages).collect():
        assert r.text == f"{r.page_id} has words of its own, {r.page_id ** 2} of them" and r.repeated_tokens == 10


NOTICE = "Please read our house rules before you write to us"


def own_text(i, n=30):
    r = np.random.default_rng(i)
    return " ".join(f"w{x}" for x in r.integers(0, 10**6, n))


def texts_of(spark, htmls, **options):
    rows = [(i, f"https://h.example.com/{i}", x) for i, x in enumerate(htmls)]
    out = ht.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string"), **options).collect()
    return {r.page_id: r.text for r in out}


def test_near_copies_keep_their_body(spark):
    def page(date, body):
        return f"<body><div>{NOTICE}</div><div>Printed on {date}</div><div>{body}</div><div>{body[::-1]}</div></body>"

    bodies = [(f"{1 + i} May 2024", own_text(99)) for i in range(12)]  # near copies: one body, another date
    bodies += [(f"day {i}", own_text(i)) for i in range(12)] + [("day 3", own_text(3))] * 3  # and exact copies
    got = texts_of(spark, [page(*b) for b in bodies])
    for i, (date, body) in enumerate(bodies):
        assert got[i] == f"Printed on {date}\n\n{body}\n\n{body[::-1]}"


def test_parts_do_not_change_the_result(spark):
    # pairs of pages that share a run, a notice, near copies, repeated rows and null ones
    htmls = [f"<p>{own_text(i)}</p><div>{own_text(1000 + i // 2, 8)}</div><div>{NOTICE}</div>" for i in range(40)]
    htmls += [f"<p>No {i}</p><p>{own_text(2000)}</p><div>{NOTICE}</div>" for i in range(10)]
    rows = [(i, "https://h.example.com/x", x) for i, x in enumerate(htmls)] + [(0, "https://h.example.com/x", htmls[0])] * 60
    rows += [(None, None, f"<p>{own_text(3000)}</p>")] * 40 + [(7, None, f"<p>{own_text(3000)}</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    whole, cut = (sorted((str(tuple(r)) for r in ht.main_texts(pages, part_bytes=b).collect())) for b in (1 << 20, 600))
    assert cut == whole and len(cut) == len(rows)
    by_id = {r.page_id: r for r in ht.main_texts(pages, part_bytes=600).where("url IS NOT NULL").collect()}
    for i in range(40):
        assert by_id[i].repeated_tokens == 8 + len(NOTICE.split()) and NOTICE not in by_id[i].text


def test_notices_go_from_inside_articles(spark):
    quote = "a line that only some of the pages hold in common"
    htmls = [f"<article><h1>{i}</h1><div>{NOTICE}</div><p>{own_text(i)}</p>{f'<p>{quote}</p>' if i < 9 else ''}</article>"
             for i in range(24)]
    got = texts_of(spark, htmls)
    assert all(got[i] == f"{i}\n\n{own_text(i)}" + (f"\n\n{quote}" if i < 9 else "") for i in range(24))


def test_passages_of_a_block_stay_in_it(spark):
    quote = "so it was said by one and all of them that day"
    htmls = [f"<div>{own_text(i)} {quote} {own_text(i + 50)}</div>" for i in range(10)]
    got = texts_of(spark, htmls)
    assert all(f"<div>{got[i]}</div>" == x for i, x in enumerate(htmls))


def test_copies_of_a_whole_page_stay(spark):
    rows = [(i, "https://h.example.com/x", "<p>the very same words on every page</p>") for i in range(4)]
    rows += [(9, None, "<article>a</article>"), (10, "odd url", None), (None, None, None), (9, None, "<article>a</article>")]
    out = ht.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert sorted(r.text for r in out) == ["", "", "a", "a"] + ["the very same words on every page"] * 4
    assert all(r.n_chars == len(r.text) for r in out)


def test_hot_host_is_cut_into_parts(spark):
    pages = spark.createDataFrame(page_rows(60), "page_id bigint, url string, html string")
    out = ht.main_texts(pages, part_bytes=2000)
    assert {r.text for r in out.collect()} == {f"{i} has words of its own, {i * i} of them" for i in range(60)}
    assert ht.main_texts(pages.limit(0)).count() == 0


def test_driver_pages_have_their_article(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in ht.op7_html_text(spark, "/root/testdata/sf0.01").collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_common_runs_decide_as_all_counts_do(spark):
    """A notice on every page of a hot host, rarer lines, near copies, repeated rows: the texts of all cuts and of both ways to count."""
    htmls = [f"<p>{own_text(i)}</p><div>{own_text(1000 + i // 2, 8)}</div><div>{NOTICE}</div>" + f"<div>{own_text(77, 9)}</div>" * (i % 5 == 0)
             + f"<div>{own_text(78, 9)}</div>" * (i % 20 == 0) for i in range(80)]
    htmls += [f"<p>No {i}</p><p>{own_text(2000)}</p><div>{NOTICE}</div>" for i in range(10)]
    rows = [(i, "https://h.example.com/x", x) for i, x in enumerate(htmls)] + [(0, "https://h.example.com/x", htmls[0])] * 60
    rows += [(500 + i, f"https://o{i % 3}.example.com/", x) for i, x in enumerate(htmls[:30])] + [(None, None, None), (9, None, "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)

    def texts(**options):
        return sorted(str((r.page_id, r.url, r.text, r.n_chars)) for r in ht.main_texts(pages, **options).collect())

    whole = texts(coverage=True)
    assert whole == texts(coverage=False) == texts(coverage=False, part_bytes=600) == texts(coverage=False, part_bytes=4000)
    assert not any(NOTICE in x for x in whole) and len(whole) == len(rows)


def test_pages_are_exchanged_once(spark):
    out = ht.main_texts(spark.createDataFrame(page_rows(60), "page_id bigint, url string, html string").repartition(3), part_bytes=2000, coverage=False)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_token_hashes_follow_the_string():
    import pyarrow as pa

    words = [f"w{i}" for i in range(5000)] + ["", "é", "日本", "ab", "ba", "a" * 3000, "a" * 2999]
    h = ht.token_hashes(pa.array(words))
    assert len(set(h.tolist())) == len(words)
    assert (ht.token_hashes(pa.array(["x", *words[::-1]]).slice(1)) == h[::-1]).all()
    assert ht.token_hashes(pa.array([], pa.string())).tolist() == []
