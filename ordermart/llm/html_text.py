"""Main text of HTML pages, with a suffix array for each host.

Pages are parsed to blocks of text in page order. The token streams of a
host's pages, all their blocks included, are concatenated and a suffix array
finds the runs of tokens that repeat across distinct pages: menus, adverts,
notices and footers of the site. Blocks in elements that never hold the
article (navigation, footers, forms, adverts, comments, ...) are dropped. Of
what is left (the article where a page marks one, else all), the blocks go that
lie (nearly) wholly in runs of many pages, on pages whose other text is a good part
and far less common; inside a marked article only those of at least half of the
host's pages. Other blocks stay whole, also those that copies and near copies of
the page repeat.

A host is cut into parts of bounded size by a hash of the page, so a host with
a third of all pages is many tasks, each with a suffix array of its own. Runs
of a host of several parts are counted over all its parts by their keys, those
that may be common at least, and joined to the parts, so the result does not
depend on the cut.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces_of, stored

MIN_RUN, PART_BYTES = 6, 1 << 20
#: an element of a doubtful word is prose from so many words on, and so many for each link in it
PROSE, LINK_WORDS = 24, 12
#: a block goes if this share of it lies in runs of at least so many pages and this share of the host's (inside a marked
#: article: the second), and this share of the page's text in runs of at most half as many pages
WHOLE, PAGES, OF_HOST, OWN = 0.9, 4, (0.1, 0.5), 0.25
#: base of the rolling hash and the multipliers of its finishing mix (odd 64-bit constants)
BASE, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: a random number for each byte value
BYTES = np.random.default_rng(64).integers(0, 1 << 64, 256, np.uint64)

# HTML element names and the class words of page furniture.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var"}
DROPPED = {"nav", "footer", "aside", "button", "select", "option", "dialog", "menu", "head", "audio", "video", "map"}
HEAD = {"base", "basefont", "bgsound", "link", "meta", "title", "style", "script", "noscript", "template", "noframes"}
MAIN = {"article", "main"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog",
                 "menu", "menubar", "toolbar"}
DROPPED_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner",
                 "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "sidebar", "cookie", "cookies",
                 "consent", "notice", "notices", "comment", "comments", "disqus", "newsletter", "subscribe", "popup", "modal",
                 "share", "social", "related", "widget"}
#: words that also name parts of an article (related work, market share, social policy)
DOUBTFUL_WORDS = {"related", "share", "social"}
HEADER_WORDS = {"header", "masthead"}
COMMENT_WORDS = {"comment", "comments", "disqus"}
#: "no-sidebar" or "has-nav" tells of a layout, it isn't a sidebar
LAYOUT_WORDS = {"no", "non", "not", "has", "have", "with", "without", "hide"}

MARKUP = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+(?:>|\Z)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORDS = re.compile(r"[a-z]+|[0-9]+")
ROLE_MAIN = re.compile(r"""role\s*=\s*["']?main\b""", re.IGNORECASE)


def _class_words(attributes: str) -> set[str]:
    """Words of an element's classes and id, without names of layouts."""
    out: set[str] = set()
    for name, value in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for one in value.strip("\"'").lower().split():
                words = WORDS.findall(one)
                if not LAYOUT_WORDS.intersection(words):
                    out.update(words)
    return out


def _drops(tag: str, attributes: str, in_main: bool) -> tuple[bool, bool, bool]:
    """Whether an element is dropped with all in it, whether it is dropped
    unless it is or holds an article (rules of forms, classes and ids), and
    whether only doubtful words tell so."""
    if tag in DROPPED or (tag == "header" and not in_main):
        return True, False, False
    if not attributes.strip(" /"):
        return False, tag == "form", False
    soft = tag == "form"
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role" and value in DROPPED_ROLES:
            return True, False, False
        if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value)):
            return True, False, False
        soft = soft or name == "role" and value == "form"
    if soft or tag in ("body", "html"):
        return False, soft, False
    words = _class_words(attributes)
    named = words & (DROPPED_WORDS if in_main else DROPPED_WORDS | HEADER_WORDS)
    return False, bool(named), bool(named) and named <= DOUBTFUL_WORDS


def blocks_of(page: str) -> list[tuple[str, bool, bool]]:
    """(text, dropped, in an article) of each block of a page, in page order.

    A form, class or id drops no element that is or holds an article or main;
    an article inside one that is named a comment counts as its comment. Nor
    does a form drop more than half of the text: it is then around the page.
    Nor does a doubtful word drop prose: what the host repeats of it goes by the
    suffix array, unique runs stay."""
    out: list[tuple[str, bool, bool, tuple]] = []
    # tag, dropped, in an article, elements a form, class or id would drop, of the open elements
    stack: list[tuple[str, bool, bool, tuple]] = []
    text: list[str] = []
    start = state = (False, False, ())
    forms: set[int] = set()
    doubtful: dict[int, int] = {}  # of those elements, links in each that only doubtful words would drop
    holds: set[int] = set()  # of those elements, the ones that hold an article
    n_soft = 0

    def close_block():
        joined = " ".join("".join(text).split())
        if joined:
            out.append((joined, *state))
        text.clear()

    def pop_to(k: int):
        nonlocal state
        close_block()
        del stack[k:]
        state = stack[-1][1:] if stack else start

    def add(piece: str):
        # text ends the head, whose end tag may be omitted
        if stack and stack[-1][0] == "head" and piece.strip():
            pop_to(len(stack) - 1)
        text.append(piece)

    at, n = 0, len(page)
    while at < n:
        m = MARKUP.search(page, at)
        if m is None:
            add(html.unescape(page[at:]))
            break
        if m.start() > at:
            add(html.unescape(page[at:m.start()]))
        at = m.end()
        if m[1] is not None:
            add(m[1])
        if m[3] is None:
            continue
        closing, tag, attributes = m[2], m[3].lower(), m[4]
        if not closing and stack and stack[-1][0] == "head" and tag not in HEAD and tag not in ("head", "html"):
            pop_to(len(stack) - 1)
        if tag == "br" or tag == "wbr":
            text.append(" " if tag == "br" else "")
        elif closing:
            if tag in INLINE:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        if stack[k][1:] != state or k and stack[k - 1][1:] != stack[k][1:]:
                            pop_to(k)
                        else:
                            del stack[k:]
                        break
                    if stack[k][0] not in INLINE:
                        break
            else:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        pop_to(k)
                        break
                else:
                    close_block()
        elif tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            at = end.start() if end else n
        elif tag in ("html", "head", "body") and any(x[0] == tag or x[0] != "html" for x in stack):
            pass  # a browser ignores these inside the page
        elif tag in VOID:
            if tag == "hr":
                close_block()
        else:
            if tag not in INLINE:
                close_block()
                # an open paragraph or item ends where the next block or item begins
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p" or (tag == stack[k][0] and tag in ("li", "option", "dt", "dd", "tr", "td", "th")):
                        pop_to(k)
                        break
                    if stack[k][0] not in INLINE:
                        break
            main = tag in MAIN or bool(attributes and ROLE_MAIN.search(attributes))
            inside = state[1] or main
            hard, soft, doubt = _drops(tag, attributes, inside)
            if tag == "a" and doubtful:
                for k in doubtful.keys() & set(state[2]):
                    doubtful[k] += 1
            dropped, softs = state[0] or hard, state[2]
            if main and not dropped and not (state[1] and COMMENT_WORDS & _class_words(attributes)):
                holds.update(softs)
                soft = False
            if soft:
                softs = (*softs, n_soft)
                if tag == "form":
                    forms.add(n_soft)
                if doubt:
                    doubtful[n_soft] = 0
                n_soft += 1
            if (dropped, inside, softs) != state and tag in INLINE:
                close_block()
            if not (attributes.rstrip().endswith("/") and tag in ("path", "g")):
                stack.append((tag, dropped, inside, softs))
                state = (dropped, inside, softs)
    close_block()
    if doubtful:
        words = dict.fromkeys(doubtful, 0)
        for joined, hard, _, softs in out:
            if not hard:
                for k in doubtful.keys() & set(softs):
                    words[k] += joined.count(" ") + 1
        holds.update(k for k, n in words.items() if n >= max(PROSE, LINK_WORDS * doubtful[k]))
    if forms - holds:
        explicit = any(inside and not hard for _, hard, inside, _ in out)
        total, of_form = 0, dict.fromkeys(forms, 0)
        for joined, hard, inside, softs in out:
            if not hard and inside >= explicit:
                total += len(joined)
                for k in forms.intersection(softs):
                    of_form[k] += len(joined)
        holds.update(k for k, size in of_form.items() if size and 2 * size > total)
    return [(joined, hard or not holds.issuperset(softs), inside) for joined, hard, inside, softs in out]


def groups_of(tokens: np.ndarray, page: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``run`` tokens, equal runs in one group after the
    other, and where each group begins. ``page`` ascends; runs do not cross pages.

    The suffix array is built by prefix doubling and needs no more than ``run``
    tokens of order: suffixes of equal rank then share their first ``run``."""
    n = len(tokens)
    if n < run:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rank, length = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1, 1
    ends = np.searchsorted(page, page, "right")  # where each token's page ends
    place = np.arange(n)
    while length < run:
        step = min(length, run - length)
        after = np.where(place + step < ends, rank[np.minimum(place + step, n - 1)], 0)
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        length += step
    suffixes = np.argsort(rank, kind="stable")
    suffixes = suffixes[place[suffixes] + run <= ends[suffixes]]
    group = rank[suffixes]
    return suffixes, np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else suffixes


def distinct(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """How many distinct values each of ``n`` groups has."""
    order = np.lexsort((values, groups))
    groups, values = groups[order], values[order]
    new = np.append(True, (groups[1:] != groups[:-1]) | (values[1:] != values[:-1]))[:len(groups)]
    return np.bincount(groups[new], minlength=n)


def cover(starts: np.ndarray, run: int, n: int) -> np.ndarray:
    """Which of ``n`` tokens lie in a run that begins at one of ``starts``."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + run, -1)
    return np.cumsum(marks[:-1]) > 0


def repeated(tokens: np.ndarray, page: np.ndarray, run: int) -> np.ndarray:
    """Which tokens lie in a run of ``run`` or more tokens that occurs on two
    or more pages. ``page`` ascends; runs do not cross pages."""
    suffixes, first = groups_of(tokens, page, run)
    size = np.diff(np.append(first, len(suffixes)))
    spread = distinct(np.repeat(np.arange(len(first)), size), page[suffixes], len(first)) > 1
    return cover(suffixes[np.repeat(spread, size)], run, len(tokens))


def levels(counts: np.ndarray, run: int) -> np.ndarray:
    """For each token the largest count of the runs it lies in, at least 1;
    ``counts`` are those of the runs that begin at each token."""
    out = np.maximum(counts, 1)
    for k in range(1, min(run, len(counts))):
        out[k:] = np.maximum(out[k:], counts[:len(counts) - k])
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(33)) * MIX1
    h = (h ^ h >> np.uint64(33)) * MIX2
    return h ^ h >> np.uint64(33)


def token_hashes(tokens: pa.Array) -> np.ndarray:
    """64-bit hash of each string: a number per byte value, times a power for its place."""
    ends = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset:tokens.offset + len(tokens) + 1].astype(np.int64)
    if not len(tokens) or ends[-1] == ends[0]:
        return np.zeros(len(tokens), np.uint64)
    data, sizes = np.frombuffer(tokens.buffers()[2], np.uint8)[ends[0]:ends[-1]], np.diff(ends)
    powers = np.cumprod(np.full(int(sizes.max()), BASE, np.uint64))
    terms = BYTES[data] * powers[np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], sizes)]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])[ends - ends[0]]
    return _mixed(sums[1:] - sums[:-1])


class Pages:
    """Parsed pages: their blocks, which of these may be text, the token
    stream, and the 64-bit key of the run that begins at each token."""

    def __init__(self, htmls, run: int, hosts: np.ndarray):
        self.blocks, self.explicit = [], []
        texts: list[str] = []
        for x in htmls:
            blocks = blocks_of(x) if isinstance(x, str) else []
            explicit = any(inside and not dropped for _, dropped, inside in blocks)
            self.explicit.append(explicit)
            self.blocks.append([(text, not dropped and inside >= explicit) for text, dropped, inside in blocks])
            texts += [b[0] for b in blocks]
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        coded = lists.flatten().dictionary_encode()
        self.tokens = np.asarray(coded.indices).astype(np.int64)
        #: tokens of each block, of all pages in a sequence
        self.sizes = np.asarray(pc.list_value_length(lists)).astype(np.int64)
        of_page = np.repeat(np.arange(len(self.blocks)), [len(b) for b in self.blocks])
        self.page = np.repeat(of_page, self.sizes)
        n = len(self.tokens)
        #: starts of whole runs, and their keys
        self.starts = np.flatnonzero(np.arange(n) + run <= np.searchsorted(self.page, self.page, "right"))
        known = token_hashes(coded.dictionary)
        keys = hosts.astype(np.int64).view(np.uint64)[self.page[self.starts]]
        for k in range(run):
            keys = keys * BASE + known[self.tokens[self.starts + k]]
        self.keys = _mixed(keys)


def extract_part(rows: pd.DataFrame, run: int = MIN_RUN, shared: pd.DataFrame | None = None) -> pd.DataFrame:
    """Main texts of the pages of one part of a host. ``shared``: the part's
    runs (key, n_pages) that a host of several parts repeats. Rows of one id are
    one page to the counts; without ids each row is a page."""
    ids = rows["id"].to_numpy() if "id" in rows else np.arange(len(rows))
    pages = Pages(rows["html"], run, rows["seed"].to_numpy() if "seed" in rows else np.zeros(len(rows), np.int64))
    suffixes, first = groups_of(pages.tokens, pages.page, run)
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(suffixes))))
    n_pages = np.zeros(len(pages.tokens), np.int64)  # of the run that begins at a token
    n_pages[suffixes] = distinct(group, ids[pages.page[suffixes]], len(first))[group]
    if shared is not None and len(shared):
        shared = shared.sort_values("key")
        known, keys = shared["key"].to_numpy(), pages.keys.view(np.int64)
        place = np.searchsorted(known, keys).clip(max=len(known) - 1)
        hit = known[place] == keys
        n_pages[pages.starts[hit]] = shared["n_pages"].to_numpy()[place[hit]]
    of_host = (rows["host_pages"].max() if "host_pages" in rows else 0) or len(np.unique(ids))
    level = levels(n_pages, run)
    texts, removed, at, sizes = [], [], 0, iter(pages.sizes.tolist())
    for blocks, explicit in zip(pages.blocks, pages.explicit, strict=True):
        kept, begin = [], at
        for (text, keep), size in zip(blocks, sizes):
            if keep:
                kept.append((text, np.sort(level[at:at + size])))
            at += size
        own, least = [], max(PAGES, OF_HOST[explicit] * of_host)
        rest = np.sort(np.concatenate([x for _, x in kept])) if kept else level[:0]
        for text, of_block in kept:
            of_block = of_block[int((1 - WHOLE) * len(of_block))]
            if of_block < least or np.searchsorted(rest, of_block // 2, "right") < OWN * len(rest):
                own.append(text)
        texts.append("\n\n".join(own or [text for text, _ in kept]))
        removed.append(int((level[begin:at] > 1).sum()))
    return pd.DataFrame({"page_id": rows["page_id"], "url": rows["url"], "text": texts,
                         "n_chars": [len(t) for t in texts], "repeated_tokens": removed})


def host_of(url):
    """The host of a URL, lower-case; null or other text: empty."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def shared_runs(rows: DataFrame, run: int) -> DataFrame:
    """group, key and n_pages of the runs that two or more pages of a
    host share, for each group (part) that holds one of these pages.

    ``rows``: group, seed (of the host), id (of the page) and html. A run is a
    row for each of its pages, so that no key has more than one row a page."""

    def read(batches):
        for batch in batches:
            for part in pieces_of(batch, "html", 8 << 20):
                groups, seeds, ids = (np.asarray(part.column(c)) for c in ("group", "seed", "id"))
                rows = np.unique(ids, return_index=True)[1]  # repeated rows are one page
                pages = Pages([part.column("html")[k].as_py() for k in rows.tolist()], run, seeds[rows])
                at = rows[pages.page[pages.starts]]
                yield pa.RecordBatch.from_arrays([pa.array(pages.keys.view(np.int64)), pa.array(ids[at]), pa.array(groups[at])],
                                                 names=["key", "page", "group"])

    found = rows.select("group", "seed", "id", "html").mapInArrow(read, "key bigint, page bigint, group bigint")
    of_key = Window.partitionBy("key")
    return (found.withColumn("before", F.lag("page").over(of_key.orderBy("page")))
            .withColumn("n_pages", F.count_if(F.col("before").isNull() | (F.col("before") != F.col("page"))).over(of_key))
            .where("n_pages > 1").select("key", "group", "n_pages").dropDuplicates(["key", "group"]))


def _part_pages(rows: pd.DataFrame, run: int) -> tuple[Pages, np.ndarray, np.ndarray]:
    """The distinct pages of a part: parsed, their ids, and which are rows repeated."""
    once = rows.drop_duplicates("id")
    return Pages(once["html"], run, once["seed"].to_numpy()), once["id"].to_numpy(), once["again"].to_numpy(bool)


def common_here(rows: pd.DataFrame, run: int) -> np.ndarray:
    """Keys of the runs of a part that may be common on its host.

    A run is common from half of the pages on that a block of it must be on to
    go. What is common on a host is as common on the pages of one of its parts at
    least, so only these few runs are counted over all parts. Rows repeated may
    lie in several parts: all their runs are candidates."""
    pages, _, again = _part_pages(rows, run)
    of_host = int(rows["host_pages"].max())
    share = max(PAGES, OF_HOST[0] * of_host) / 2 / of_host
    keys, group = np.unique(pages.keys, return_inverse=True)
    at = pages.page[pages.starts]
    single = ~again[at]
    n = distinct(group[single], at[single], len(keys))
    found = n >= max(share * (~again).sum(), 1)
    found[group[~single]] = True
    return keys[found].view(np.int64)


def counts_here(rows: pd.DataFrame, keys: np.ndarray, run: int) -> pd.DataFrame:
    """key, page (the id of a page whose rows are repeated, else null) and n
    (distinct pages) of the runs ``keys`` in a part."""
    pages, ids, again = _part_pages(rows, run)
    keys = np.sort(keys)
    place = np.searchsorted(keys, pages.keys.view(np.int64)).clip(max=max(len(keys) - 1, 0))
    hit = keys[place] == pages.keys.view(np.int64) if len(keys) else np.zeros(len(place), bool)
    group, at = place[hit], pages.page[pages.starts[hit]]
    single = ~again[at]
    n = distinct(group[single], at[single], len(keys))
    pairs = np.unique(np.stack([group[~single], at[~single]]), axis=1) if (~single).any() else np.empty((2, 0), np.int64)
    out = pd.DataFrame({"key": keys[n > 0], "n": n[n > 0]})
    out["page"] = pd.array([None] * len(out), "Int64")
    more = pd.DataFrame({"key": keys[pairs[0]], "n": np.ones(pairs.shape[1], np.int64), "page": pd.array(ids[pairs[1]], "Int64")})
    return pd.concat([out, more])[["key", "page", "n"]] if len(more) else out[["key", "page", "n"]]


def common_runs(dealt: DataFrame, parts: DataFrame, run: int) -> DataFrame:
    """group, salt, key and n_pages: the exact number of pages of the host on
    which each run is that may be common, for every part of the host.

    ``dealt`` is read here as it is for the extraction, dealt to the same parts:
    Spark exchanges the pages once for all readings."""
    few = "seed bigint, key bigint"

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["host_pages"].isna().all():  # one part has its whole host
            return pd.DataFrame({"seed": np.empty(0, np.int64), "key": np.empty(0, np.int64)})
        keys = common_here(rows, run)
        return pd.DataFrame({"seed": np.full(len(keys), rows["seed"].iloc[0]), "key": keys})

    def count(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"seed": np.empty(0, np.int64), "key": np.empty(0, np.int64), "page": pd.array([], "Int64"),
                                 "n": np.empty(0, np.int64)})
        out = counts_here(rows, asked["key"].to_numpy(), run)
        out.insert(0, "seed", rows["seed"].iloc[0])
        return out

    asked = dealt.groupBy("group", "salt").applyInPandas(find, few).distinct().join(parts, "seed").select("group", "salt", "key")
    each = (dealt.groupBy("group", "salt").cogroup(asked.groupBy("group", "salt"))
            .applyInPandas(count, f"{few}, page bigint, n bigint"))
    pages = each.groupBy("seed", "key", "page").agg(F.when(F.col("page").isNull(), F.sum("n")).otherwise(1).alias("n"))
    total = pages.groupBy("seed", "key").agg(F.sum("n").alias("n_pages")).where("n_pages > 1")
    return total.join(parts, "seed").select("group", "salt", "key", "n_pages")


def main_texts(pages: DataFrame, run: int = MIN_RUN, part_bytes: int = PART_BYTES, coverage: bool = True) -> DataFrame:
    """page_id, url, text, n_chars and, with ``coverage``, repeated_tokens
    (tokens of the page in runs that its host repeats) of every page.

    The text needs the counts of common runs only, and they are few; the
    coverage needs those of all runs, a row for each token of the large hosts.

    Null or empty html: empty text. Null or odd URLs form one host. Broken and
    unclosed markup is read as a browser would, nothing fails. Rows repeated
    with one page_id, url and html are extracted each, and are one page to the
    counts. Very long pages are read whole. A part holds about ``part_bytes`` of
    a host's html, or one longer page; the result does not depend on it. An
    empty table gives no rows. Other columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    rows = rows.withColumns({"seed": F.xxhash64("host"), "id": F.xxhash64("page_id", "url", "html")})
    # hosts of several parts, at most one row for each part_bytes of html
    sizes = stored(rows.groupBy("host", "seed").agg(F.sum(F.octet_length("html")).alias("bytes"), F.count_distinct("id").alias("host_pages"))
                   .where(F.col("bytes") > part_bytes)
                   .select(F.col("host").alias("__host"), F.col("seed").alias("__seed"), F.ceil(F.col("bytes") / part_bytes).alias("parts"),
                           "host_pages"), "hosts")
    group = F.xxhash64("host", F.pmod("id", F.coalesce("parts", F.lit(1))))
    placed = rows.join(sizes.drop("__seed"), F.col("host") == F.col("__host"), "left").withColumn("group", group)
    # parts that repeated rows make too large, at most one row for each part_bytes of html
    heavy = stored(placed.where("parts IS NOT NULL").groupBy("group").agg(F.sum(F.octet_length("html")).alias("bytes"))
                   .where(F.col("bytes") > 4 * part_bytes)
                   .select(F.col("group").alias("__group"), F.ceil(F.col("bytes") / part_bytes).alias("salts")), "heavy")
    repeats = stored(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("__id")), "repeated-pages")

    def salted(df: DataFrame, salt) -> DataFrame:
        return df.join(heavy, F.col("group") == F.col("__group"), "left").withColumn("salt", salt)

    salts = F.coalesce("salts", F.lit(1))
    every_salt = F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))
    # any deal of a part's rows will do, each salt gets all its shared runs
    dealt = (salted(placed.join(repeats, F.col("id") == F.col("__id"), "left"), F.pmod(F.monotonically_increasing_id(), salts))
             .select("group", "salt", "page_id", "url", "html", "seed", "id", "host_pages", F.col("__id").isNotNull().alias("again")))
    if coverage:
        shared = salted(shared_runs(placed.where("parts IS NOT NULL"), run), every_salt).select("group", "salt", "key", "n_pages")
    else:
        numbers = sizes.select(F.col("__host").alias("host"), F.col("__seed").alias("seed"),
                               F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
        parts = salted(numbers.select("seed", F.xxhash64("host", "part").alias("group")), every_salt).select("seed", "group", "salt")
        shared = common_runs(dealt, stored(parts, "parts"), run)
    kind = "page_id bigint, url string, text string, n_chars bigint" + ", repeated_tokens bigint" * coverage
    names = ["page_id", "url", "text", "n_chars", "repeated_tokens"][:4 + coverage]

    def extract(rows: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):  # no row was dealt this salt
            return pd.DataFrame({name: np.empty(0, kind) for name, kind in (
                ("page_id", np.int64), ("url", object), ("text", object), ("n_chars", np.int64), ("repeated_tokens", np.int64))})[names]
        return extract_part(rows.fillna({"host_pages": 0}), run, shared)[names]

    return (dealt.groupBy("group", "salt").cogroup(shared.groupBy("group", "salt")).applyInPandas(extract, kind))


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"), coverage=False)
