"""Main text of web pages by consensus of a host's pages.

Every page is parsed, and its containers (body, main, article, div, td) are scored by the
running text they hold. A container is known by its path of tags and classes with numbers
generalised. Each page votes for the paths of its containers, Spark sums the votes of a
host's pages, and each page is then extracted by its host's winning path. Where that path is
absent or holds next to nothing of the page's text, the best of the host's other paths takes
its place, and at last the page's own best container; so it does for a page without a host.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import checkpoint, fields, map_arrow, read

#: Elements of the HTML standard by their part in a page.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = set("body main article div td".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp noembed noframes".split())
SKIPPED = set("script style noscript template head title nav header footer aside form button select textarea iframe object svg canvas dialog menu audio video".split())
SKIPPED_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words in a class or id that name what stands around an article.
SKIPPED_WORDS = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside rail widget widgets"
    " ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner notice notices cookie cookies consent gdpr"
    " popup modal overlay alert toast newsletter subscribe subscription signup login comment comments commentlist reply replies respond disqus discussion"
    " social share sharing related recommended recommendations pagination pager paging toolbar search form hidden copyright".split()
)
#: Such words name something else in the class of a page's frame.
FRAMES = set("html body main".split())
ARTICLE_WORDS = set("comment reply ad ads advert promo sponsored related teaser".split())
#: `has-sidebar`, `no-ads` and the like tell of the page, not of the element.
ABOUT = ("has-", "no-", "with-", "without-", "is-", "not-")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
#: An open element of the key is closed by the start of one of the values.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr", "tbody", "tfoot"}}
#: An end tag of these does not reach beyond the containers around it.
_INNER = {"p", "li", "dt", "dd", "td", "th", "tr", "h1", "h2", "h3", "h4", "h5", "h6"}
_FENCE = CONTAINERS | {"section", "table", "ul", "ol", "dl", "blockquote"}


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text else {}


def _is_skipped(tag: str, attributes: dict[str, str], by_class: bool) -> bool:
    if tag in SKIPPED:
        return True
    if not attributes or tag in FRAMES:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in SKIPPED_ROLES:
        return True
    if not by_class:
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    names = [re.sub(r"(?<=[a-z])(?=[A-Z])", "-", x).lower() for x in names]
    words = {w for x in names if not x.startswith(ABOUT) for w in _WORD.findall(x)}
    return bool(words & (ARTICLE_WORDS if tag == "article" else SKIPPED_WORDS))


#: A longer path goes on from a hash of itself, so that deep nesting takes no more memory.
_LONGEST_PATH = 256


def _below(path: str, step: str) -> str:
    path = f"{path}>{step}"
    return path if len(path) <= _LONGEST_PATH else f"#{hashlib.blake2b(path.encode('utf-8', 'surrogatepass'), digest_size=12).hexdigest()}"


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A step of a generalised path: the tag and its first class, numbers as `#`."""
    name = (attributes.get("class", "").split() or [""])[0].lower()
    name = re.sub(r"[0-9a-f]*[0-9][0-9a-f]*", "#", name)
    return f"{tag}.{name}" if name else tag


#: A path is poor on a page where its score is below this share of the page's best.
POOR = 0.2
#: The paths of a host are those with at least this share of all its votes: 20 at most.
LEAST_VOTES = 0.05


class Page:
    """The containers of a page and its blocks of text, without what stands around an article."""

    def __init__(self, html: str, by_class: bool = True):
        #: (path, container above or -1, tag), and (container, direct, text, characters in links).
        self.containers: list[tuple[str, int, str]] = [("", -1, "body")]
        self.blocks: list[tuple[int, bool, str, int]] = []
        # open elements: tag, skipped, container, path
        self._open: list[tuple[str, bool, int, str]] = [("", False, 0, "")]
        self._tags: Counter[str] = Counter()
        self._text: list[str] = []
        self._linked = self._links = 0
        self._read(html, by_class)
        self._flush()

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                tag, _, container, _ = self._open[-1]
                self.blocks.append((container, tag in CONTAINERS, text, min(self._linked, len(text))))
            self._text = []
        self._linked = 0

    def _read(self, html: str, by_class: bool) -> None:
        at, end = 0, len(html)
        while at < end:
            found = _TOKEN.search(html, at)
            stop = found.start() if found else end
            if stop > at and not self._open[-1][1]:
                text = unescape(html[at:stop]) if "&" in html[at:stop] else html[at:stop]
                self._text.append(text)
                if self._links:
                    self._linked += len(text)
            if not found:
                return
            at = found.end()
            tag = found[2]
            if not tag:
                continue
            tag = tag.lower()
            if found[1]:
                self._close(tag)
                continue
            if tag in VOID:
                if tag == "br":
                    self._text.append(" ")
                elif tag == "hr":
                    self._flush()
                continue
            if tag in RAW:
                close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                at = close.end() if close else end
                continue
            self._start(tag, found[3], by_class)

    def _start(self, tag: str, rest: str, by_class: bool) -> None:
        if tag == "a":
            self._links += 1
        _, skipped, container, path = self._open[-1]
        block = tag in BLOCKS
        attributes = _attributes(rest)
        skip = skipped or _is_skipped(tag, attributes, by_class)
        if not block and skip == skipped and tag not in SKIPPED:
            return
        if block:
            self._flush()
            top = self._open[-1][0]
            if top == "p" or tag in _CLOSES.get(top, ()):
                self._drop(1)
                if tag == "tr" and self._open[-1][0] == "tr":
                    self._drop(1)
                _, skipped, container, path = self._open[-1]
                skip = skipped or _is_skipped(tag, attributes, by_class)
        if not skip and block:
            path = _below(path, _step(tag, attributes)) if tag in CONTAINERS or tag == "section" else path
            if tag in CONTAINERS:
                self.containers.append((path, container, tag))
                container = len(self.containers) - 1
        self._open.append((tag, skip, container, path))
        self._tags[tag] += 1

    def _drop(self, n: int) -> None:
        """Close the n innermost elements."""
        for tag, *_ in self._open[-n:]:
            self._tags[tag] -= 1
        del self._open[-n:]

    def _close(self, tag: str) -> None:
        if tag == "a":
            self._links = max(0, self._links - 1)
        if tag in BLOCKS:
            self._flush()
        if not self._tags[tag]:  # else it is looked for through all that is open
            return
        for i in range(len(self._open) - 1, 0, -1):
            name = self._open[i][0]
            if name == tag:
                self._drop(len(self._open) - i)
                return
            if tag in _INNER and name in _FENCE:
                return

    def scores(self) -> dict[str, float]:
        """For each path the score of its best container."""
        own = defaultdict(float)
        for container, direct, text, linked in self.blocks:
            worth = max(0, len(text) - 2 * linked)
            tag = self.containers[container][2]
            # text right within a div makes it a paragraph as much as a container
            worth_here = 0.7 * worth if direct and tag in ("div", "td") else worth
            own[container] += worth_here * (2.5 if tag in ("article", "main") else 1)
            share = 0.5
            above = self.containers[container][1]
            while above >= 0 and share > 0.05:
                own[above] += share * worth * (2.5 if self.containers[above][2] in ("article", "main") else 1)
                above, share = self.containers[above][1], share / 2
        best: dict[str, float] = {}
        for container, score in own.items():
            path = self.containers[container][0]
            best[path] = max(best.get(path, 0.0), score)
        return best

    def text(self, paths: list[str]) -> str:
        """The blocks within containers of the first path; if that is poor here, of the other one with
        the best score; if that is poor as well, of the page's best."""
        scores = self.scores()
        best = max(scores, key=lambda x: (scores[x], -len(x), x), default="")
        others = sorted((x for x in paths[1:] if x in scores), key=lambda x: -scores[x])
        path = next((x for x in [*paths[:1], *others] if x in scores and scores[x] >= POOR * scores[best]), best)
        inside = []
        for own, above, _ in self.containers:
            inside.append(own == path or (above >= 0 and inside[above]))
        return "\n".join(text for container, _, text, _ in self.blocks if inside[container])


def parse(html: str | None) -> Page:
    """A page; one that is nothing but skipped classes is read again with classes ignored."""
    page = Page(html or "")
    return page if page.blocks or not html else Page(html, by_class=False)


def host_of(url):
    """The host of a url column, lower case without port and `www.`; empty for a null."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def host_paths(pages: DataFrame) -> DataFrame:
    """The ``paths`` of every host with LEAST_VOTES of its votes: most votes first, then the shorter, then by name.

    Pages without a host are no host: they have no vote.
    """

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, str], float] = defaultdict(float)

        def out():
            hosts, paths = zip(*total, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(paths), pa.array(list(total.values()))], names=["host", "path", "votes"])

        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                scores = parse(html.as_py()).scores()
                top = max(scores.values(), default=0)
                for path, score in scores.items():
                    if score >= 0.25 * top > 0:
                        total[host, path] += round(score / top, 6)
                if len(total) > 50_000:
                    yield out()
                    total.clear()
        if total:
            yield out()

    own = pages.select(host_of(F.col("url")).alias("host"), "html").where("host <> ''")
    rows = map_arrow(own, votes, "host string, path string, votes double")
    summed = checkpoint(rows.groupBy("host", "path").agg(F.sum(F.col("votes").cast("decimal(28,6)")).alias("votes")))
    whole = summed.groupBy("host").agg(F.sum("votes").alias("all"))
    kept = summed.join(whole, "host").where(F.col("votes") >= LEAST_VOTES * F.col("all"))
    order = F.struct((-F.col("votes")).alias("votes"), F.length("path").alias("length"), F.col("path").alias("path"))
    return kept.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["path"]).alias("paths"))


#: Hosts up to this many are sent to every task, with 20 paths of 256 characters at most; more
#: are joined by shuffle.
BROADCAST_HOSTS = 10_000


def extract_pages(pages: DataFrame, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """``pages`` (url, html and others) with ``text`` and ``n_chars`` in place of the html.

    A null html is empty and gives an empty text; a page without a host (or with a null url) is
    extracted by itself. Elements may be nested to any depth. Repeated rows vote and stay row by
    row. Columns of these names are replaced. An empty table gives an empty result.
    """
    paths = checkpoint(host_paths(pages))
    few = paths.count() <= broadcast_hosts
    pages = pages.drop("text", "n_chars")
    rows = pages.withColumn("_host", host_of(F.col("url")))
    paths = paths.withColumnsRenamed({"host": "_host", "paths": "_paths"})
    rows = rows.join(F.broadcast(paths) if few else paths, "_host", "left").drop("_host")
    names = [c for c in pages.columns if c != "html"]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [parse(html.as_py()).text(paths or []) for html, paths in zip(batch.column("html"), batch.column("_paths").to_pylist(), strict=True)]
            columns = [*(batch.column(c) for c in names), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "text", "n_chars"])

    return map_arrow(rows, extract, ", ".join([*fields(pages, *names), "text string, n_chars long"]))


def op3_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
