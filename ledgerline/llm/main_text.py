"""Main text of web pages: a suffix order of each host's tokens, and page structure.

A page is read once into blocks of text. Blocks inside menus, footers, asides, forms, adverts, notices,
comments and the like are left out by their elements, roles and class names. A class name or id counts as a whole: all
of its words must be known, so "related-work" and "no-sidebar" do not.

The token suffixes of all pages of a host are ordered by prefix doubling: suffixes that begin with the same tokens have
one rank, ranks are shuffled, and only suffixes that share theirs with another page go on to twice the length, until
none does. Runs of at least ``RUN`` tokens that stand on two of the host's pages are boilerplate. Those are found among
few suffixes: each run holds an anchor, the least of the hashes of its ``ANCHOR`` neighbouring tokens, which is the same wherever
the run stands, so runs whose anchor is on one page only are left out before they are shuffled. No task holds a host.

Structure comes second. Blocks of the article (or, without one, of the main element; or of one that stands in an element
left out by its name) are the text, and what they share with other pages stays: equal articles are no boilerplate.
In an article, blocks of an element whose name ends in a known word ("main-nav") lose their repeated runs. A page
that marks neither article nor main element loses them in all of its blocks; tokens beside a run stay.

Pages of equal content are one page there: copies keep their text. Null html is empty; a page without text gives "".
A null url belongs to a host of its own name. Repeated rows are rows of their own and not two pages.
"""

from __future__ import annotations

import re
from functools import reduce
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.arrays import mixed, slices
from ledgerline.llm.fuzzy_lines import _values
from ledgerline.llm.linking import bitmap, marked
from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import land

#: Tokens of a run that is boilerplate when it is repeated (a power of two).
RUN = 8
#: Tokens of an anchor.
ANCHOR = RUN // 2
#: Anchors are dealt in so many passes, one after the other, so that not all of them are on disk at once.
PASSES = 2
#: Code points whose suffixes are made at once.
CHUNK = 300_000

# Element names, roles and words of class names.
LEFT_OUT = {
    "nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "button", "select", "textarea", "svg", "dialog",
    "menu", "object", "canvas", "audio", "video", "head", "title", "math", "datalist", "search",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar"}
WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu",
    "breadcrumb", "breadcrumbs", "sidebar", "footer", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "comment", "comments", "respond", "disqus", "related", "recommended", "share", "sharing", "social", "widget", "pagination", "banner",
    "toolbar", "alert",
}
#: Words that may stand beside these in a name.
BESIDE = {
    "area", "articles", "bar", "block", "bottom", "box", "button", "buttons", "container", "count", "form", "global", "icon", "icons", "inner", "item", "items", "left", "link", "links",
    "list", "media", "message", "outer", "panel", "posts", "primary", "reply", "right", "secondary", "section", "site", "slot", "stories", "text", "thread", "title", "top", "unit",
    "wrap", "wrapper",
}
#: Words that keep a name from ending in what the element is ("content-with-menu").
BEFORE = {"no", "not", "non", "without", "with", "has", "hide", "hidden", "on", "in", "and", "under", "below", "after"}
#: Words of names in which articles are not the page's.
OTHERS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "comment", "comments", "respond", "disqus", "related", "recommended"}
#: Elements that take no meaning from an id in an article, where ids are made from headings.
TEXT_BLOCKS = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "pre", "blockquote", "ul", "ol", "li", "dl", "dt", "dd", "table", "tr", "td", "th", "figure", "figcaption", "caption"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "rb", "rp", "rt",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "br", "picture", "source", "nobr",
}
#: Elements that end when one of their own kind begins, up to the element that holds them.
ENDED_BY = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "blockquote", "td", "th", "aside", "nav", "header", "footer", "form", "figure", "menu"}
#: Elements whose start ends a paragraph.
ENDS_PARAGRAPH = HOLDERS - {"td", "th", "body"} | {"h1", "h2", "h3", "h4", "h5", "h6", "hr", "pre", "p", "address", "fieldset"}

#: NAMED_OUT: left out by its name, so that an article or main element in it is INNER.
OUT, ARTICLE, MAIN, OTHER, INNER, NAMED_OUT = 0, 1, 2, 3, 4, 5
#: Added to ARTICLE, MAIN and INNER in an element whose name ends in a known word.
DOUBT = 8

_NAME_PARTS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


def _parts(name: str) -> list[str]:
    return [p for x in _NAME_PARTS.split(name) if not x[:1].isdigit() and (p := x.lower().rstrip("0123456789"))]


def _named(names: str) -> set[str]:
    """The words of WORDS, and header, in those names all of whose words are known ("cookie-notice", "adSlot2"; not "related-work")."""
    found = set()
    for name in names.split():
        parts = set(_parts(name))
        own = parts & (WORDS | {"header"})
        if own and parts <= WORDS | BESIDE | ({"header", "page", "main"} if "header" in own else set()):
            found |= own
    return found


def _doubtful(names: str) -> bool:
    """Whether a name ends in one of WORDS after others ("main-nav", "google-ads"; not "content-with-menu")."""
    return any(len(parts) > 1 and parts[-1] in WORDS and not set(parts) & BEFORE for parts in map(_parts, names.split()))


class _Blocks(HTMLParser):
    """Collects (kind, text) of a page's blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = [("", OTHER)]
        self.blocks: list[tuple[int, str]] = []
        self.parts: list[str] = []
        self.kind = OTHER

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text and self.kind not in (OUT, NAMED_OUT):
                self.blocks.append((self.kind, text))
            self.parts = []

    def kind_of(self, tag: str, attributes: dict[str, str | None]) -> int:
        above, doubt = self.open[-1][1] & ~DOUBT, self.open[-1][1] & DOUBT
        if above == OUT or tag in LEFT_OUT or "hidden" in attributes or attributes.get("aria-hidden") == "true":
            return OUT
        role = (attributes.get("role") or "").lower()
        if role in ROLES or tag == "header" and above not in (ARTICLE, MAIN, INNER):
            return OUT
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style") or ""):
            return OUT
        inside = above in (ARTICLE, MAIN, INNER)
        if tag not in ("html", "body", "article", "main"):
            names = attributes.get("class") or ""
            if not (inside and (tag in TEXT_BLOCKS or tag in INLINE)):
                names += " " + (attributes.get("id") or "")
            words = _named(names)
            if words & OTHERS:
                return OUT
            if words & WORDS or "header" in words and not inside:
                return NAMED_OUT
            if inside and tag not in INLINE and _doubtful(names):
                doubt = DOUBT
        elif tag == "article" and _named(attributes.get("class") or "") & {"comment", "comments", "ad", "advert", "sponsored", "related"}:
            return OUT
        if tag == "article" or role == "article" or attributes.get("itemprop") == "articleBody":
            return INNER if above in (NAMED_OUT, INNER) else ARTICLE
        if tag == "main" or role == "main":
            return {OTHER: MAIN, NAMED_OUT: INNER}.get(above, above)
        return above | doubt

    def close_to(self, at: int) -> None:
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            elif tag == "hr":
                self.flush()
            return
        ended = ENDED_BY.get(tag, set()) | ({"p"} if tag in ENDS_PARAGRAPH else set())
        if ended:
            for at in range(len(self.open) - 1, 0, -1):
                name = self.open[at][0]
                if name in ended:
                    self.flush()
                    self.close_to(at)
                    break
                if name in HOLDERS:
                    break
        kind = self.kind_of(tag, dict(attrs))
        if tag not in INLINE or kind != self.open[-1][1]:
            self.flush()
        self.open.append((tag, kind))
        self.kind = kind

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)  # "/>" has no meaning outside void elements

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                kind = self.open[at - 1][1]
                if tag not in INLINE or kind != self.open[-1][1]:
                    self.flush()
                self.close_to(at)
                self.kind = kind
                return

    def handle_data(self, data):
        self.parts.append(data)


def blocks(html: str) -> list[tuple[int, str]]:
    """(kind, text) of the blocks that structure does not leave out, in page order."""
    reader = _Blocks()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


def repeated(tokens: np.ndarray, pages: np.ndarray) -> np.ndarray:
    """Which tokens lie in a run of RUN tokens that stands on two pages or more: the plain version, in one process.

    Suffixes are ranked by prefix doubling up to RUN tokens; suffixes of one rank begin with the same
    run. Runs do not go over the end of a page.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < RUN:
        after = np.full(n, -1, np.int64)
        after[: max(0, n - length)] = rank[length:]
        after[: max(0, n - length)][pages[length:] != pages[: n - length]] = -1
        rank = np.unique((rank << 32) | (after + 1), return_inverse=True)[1].astype(np.int64)
        length *= 2
    inside = np.zeros(n, bool)
    if n >= RUN:
        inside[: n - RUN + 1] = pages[RUN - 1 :] == pages[: n - RUN + 1]
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(low, rank[inside], pages[inside])
    np.maximum.at(high, rank[inside], pages[inside])
    starts = inside & (low[rank] < high[rank])
    change = np.zeros(n + 1, np.int64)
    change[:n] += starts
    at = np.flatnonzero(starts) + RUN
    change[at] -= 1
    return np.cumsum(change)[:n] > 0


class _Suffixes:
    """The tokens of some pages, and hashes of what their suffixes begin with; pages: the texts of each (not none)."""

    def __init__(self, pages: list[list[str]], hosts: np.ndarray):
        joined = [" ".join(texts) for texts in pages]
        whole = " ".join(joined)
        self.values, _ = _values([whole])
        spaces = np.flatnonzero(np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        self.begins, self.ends = np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(whole)]])
        counts = np.array([x.count(" ") + 1 for x in joined])
        self.page = np.repeat(np.arange(len(pages)), counts)
        self.at = np.arange(len(self.page)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.salt = hosts.astype(np.int64).view(np.uint64)[self.page]

    def hashes(self, length: int) -> np.ndarray:
        """One for each run of so many tokens, apart by host; runs may go over the end of a page."""
        if len(self.page) < length:
            return np.zeros(0, np.uint64)
        return mixed(slices(self.values, self.begins[: len(self.page) - length + 1], self.ends[length - 1 :]) ^ self.salt[: len(self.page) - length + 1])

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, anchor) of each run of RUN tokens that lies in one page."""
        own = self.hashes(ANCHOR)
        n = max(0, len(self.page) - RUN + 1)
        least = own[:n].copy()
        for shift in range(1, RUN - ANCHOR + 1):
            np.minimum(least, own[shift : shift + n], out=least)
        starts = np.flatnonzero(self.page[:n] == self.page[RUN - 1 :]) if n else np.zeros(0, np.int64)
        return starts, least[starts].view(np.int64)


def page_runs(texts: list[str], host: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start) of all runs of RUN tokens of one page, and how many tokens each block has."""
    hashes = _Suffixes([texts], np.array([host])).hashes(RUN).view(np.int64)
    return hashes, np.arange(len(hashes), dtype=np.int32), np.array([t.count(" ") + 1 for t in texts], np.int64)


def _suffixes(batch: pa.RecordBatch):
    """(contents of the pages, their suffixes) of a batch's pages, in runs of about CHUNK code points."""
    contents, hosts, texts = batch.column("content").to_numpy(), batch.column("host_id").to_numpy(), batch.column("texts").to_pylist()
    start = 0
    while start < len(texts):
        stop, n = start, 0
        while stop < len(texts) and n < CHUNK:
            stop, n = stop + 1, n + sum(map(len, texts[stop]))
        yield contents[start:stop], _Suffixes(texts[start:stop], hosts[start:stop])
        start = stop


def _anchors(contents: DataFrame, turn: int) -> DataFrame:
    """anchor, content of the runs of RUN tokens whose anchor is of this turn's; neighbouring runs of one anchor are one row."""

    def made(batches):
        for batch in batches:
            for own, suffixes in _suffixes(batch):
                starts, anchors = suffixes.anchors()
                of = own[suffixes.page[starts]]
                new = anchors % PASSES == turn
                new[1:] &= (anchors[1:] != anchors[:-1]) | (of[1:] != of[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(anchors[new]), pa.array(of[new])], ["anchor", "content"])

    return mapped(contents, made, "anchor long, content long")


def _anchored(contents: DataFrame, anchors: DataFrame) -> DataFrame:
    """anchor, content, at, rank of the runs of RUN tokens whose anchor may be among anchors."""
    sent = contents.sparkSession.sparkContext.broadcast(bitmap(anchors))

    def made(batches):
        for batch in batches:
            for own, suffixes in _suffixes(batch):
                starts, found = suffixes.anchors()
                held = marked(sent.value, found)
                if held.any():
                    starts = starts[held]
                    columns = (found[held], own[suffixes.page[starts]], suffixes.at[starts].astype(np.int32), suffixes.hashes(RUN)[starts].view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "content", "at", "rank"])

    return mapped(contents, made, "anchor long, content long, at int, rank long")


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Those values of a column that two contents have."""
    return rows.groupBy(key).agg(F.min("content").alias("x"), F.max("content").alias("y")).where("x <> y").select(key)


def repeats(contents: DataFrame) -> DataFrame:
    """content, at, length: token runs that another content of the same host has too, the longest found at each start.

    contents: content, host_id, texts (not none); copies of a content are one. Lengths are doubled from RUN on, so a
    longer run is covered by those of its starts.
    """
    anchors = reduce(DataFrame.union, [land(_shared(_anchors(contents, turn), "anchor"), "repeated_anchors") for turn in range(PASSES)])
    ranked = _anchored(contents, anchors).join(anchors, "anchor", "left_semi").select("content", "at", "rank").distinct()
    length, levels = RUN, []
    while True:
        ranked = land(ranked, "suffix_ranks")
        tied = land(ranked.join(_shared(ranked, "rank"), "rank", "left_semi").select("content", "at", "rank"), "tied_suffixes")
        levels.append(tied.select("content", "at", F.lit(length).alias("length")))
        if tied.isEmpty():
            break
        after = tied.select("content", (F.col("at") - length).alias("at"), F.col("rank").alias("after"))
        ranked = tied.join(after, ["content", "at"]).select("content", "at", F.xxhash64("rank", "after").alias("rank"))
        length *= 2
    return reduce(DataFrame.union, levels).groupBy("content", "at").agg(F.max("length").alias("length"))


def without_runs(texts: list[str], may_go: list[bool], starts: list[int], lengths: list[int]) -> list[str]:
    """The texts without the tokens of runs (token places are counted over all texts), in those that may lose some."""
    counts = np.array([t.count(" ") + 1 for t in texts], np.int64)
    change = np.zeros(counts.sum() + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.array(starts, np.int64) + lengths, -1)
    gone, ends, out = np.cumsum(change)[:-1] > 0, np.cumsum(counts).tolist(), []
    for text, may, end, n in zip(texts, may_go, ends, counts.tolist()):
        own = gone[end - n : end]
        out.append(" ".join(token for token, off in zip(text.split(" "), own.tolist()) if not off) if may and own.any() else text)
    return out


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text (the main text) of each row of pages; other columns are ignored."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = rows.select("page_id", "url", F.xxhash64(host).alias("host_id"), "html")

    def split(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [blocks(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), part.column("host_id"), pa.array([[k for k, _ in x] for x in found], pa.list_(pa.int32())), pa.array([[t for _, t in x] for x in found], pa.list_(pa.string()))],
                    ["page_id", "url", "host_id", "kinds", "texts"],
                )

    parsed = mapped(rows, split, "page_id long, url string, host_id long, kinds array<int>, texts array<string>")
    parsed = land(parsed.withColumn("content", F.xxhash64("host_id", "texts")), "page_blocks")
    kinds = F.transform("kinds", lambda kind: kind.bitwiseAND(~DOUBT))
    best = F.coalesce(*[F.when(F.array_contains(kinds, kind), kind) for kind in (ARTICLE, MAIN, INNER)], F.lit(OTHER))
    judged = parsed.withColumn("best", best)
    # Runs of all pages count; those of pages whose blocks all stay are not needed any more.
    open_ = (F.col("best") == OTHER) | F.exists("kinds", lambda kind: kind >= DOUBT)
    wanted = judged.where(open_).select("content").distinct()
    runs = repeats(parsed.where("size(texts) > 0").select("content", "host_id", "texts")).join(wanted, "content", "left_semi")
    spans = land(runs.groupBy("content").agg(F.collect_list("at").alias("starts"), F.collect_list("length").alias("lengths")), "spans")

    def cut(batches):
        for batch in batches:
            left = []
            for kinds, texts, best, starts, lengths in zip(*(batch.column(c).to_pylist() for c in ("kinds", "texts", "best", "starts", "lengths"))):
                if starts:
                    texts = without_runs(texts, [best == OTHER or kind >= DOUBT for kind in kinds], starts, lengths)
                left.append([text for kind, text in zip(kinds, texts) if text and kind & ~DOUBT == best])
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(left, pa.list_(pa.string()))], ["page_id", "url", "texts"])

    decided = mapped(judged.where(open_).join(spans, "content", "left"), cut, "page_id long, url string, texts array<string>")
    whole = F.filter("texts", lambda _, i: F.get(kinds, i) == F.col("best"))
    stays = judged.where(~open_).select("page_id", "url", whole.alias("texts"))
    return stays.union(decided).select("page_id", "url", F.array_join("texts", "\n").alias("text"))
