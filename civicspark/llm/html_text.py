"""The main text of web pages by text-to-tag ratio, from streaming parser events."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end the block before them and begin one of their own.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol optgroup option p pre script section select style "
    "summary table tbody td template textarea tfoot th thead title tr ul".split()
)
#: Elements a region of content can be.
REGION = frozenset("article main section div td body html".split())
NEVER = frozenset("head title script style noscript template nav footer aside menu form button select textarea iframe object svg canvas dialog".split())
#: Words of a class, id or role that name something other than the article.
OTHER = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer header masthead cookie cookies consent notice popup modal newsletter subscribe share sharing social "
    "related recommended comment comments disqus reply replies respond widget toolbar pagination pager search login signup contentinfo "
    "complementary alert dialog".split()
)
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
#: An open element that ends when one of these begins.
ENDS = {
    "p": BLOCK - {"body", "html", "head"}, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option"}),
    "head": frozenset({"body"}),
}
#: What an end tag or an implied end doesn't reach across.
SCOPE = frozenset("html body article main section aside div table td th ul ol form".split())
#: Standard deviation, in lines, of the Gaussian that smooths the ratios.
SIGMA = 1.0


class Line:
    __slots__ = ("text", "plain", "tags", "region", "out")

    def __init__(self, text: str, plain: int, tags: int, region: int, out: bool):
        self.text, self.plain, self.tags, self.region, self.out = text, plain, tags, region, out


class Lines(HTMLParser):
    """A page as lines: runs of text between block boundaries, with the tags met on the way.

    Regions are numbered as they open, so a region's parent has a smaller number; -1 is the page.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # name, not the article, not so even for an article inside, innermost region
        self.open: list[tuple[str, bool, bool, int]] = []
        self.count: Counter = Counter()  # open elements by name
        self.parents: list[int] = []
        self.articles: list[int] = []  # a region's innermost article or main element, itself included
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def state(self) -> tuple[bool, bool, int]:
        return self.open[-1][1:] if self.open else (False, False, -1)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            out, _, region = self.state()
            self.lines.append(Line(text, max(0, len(text) - self.linked), self.tags, region, out))
        self.parts, self.tags, self.linked = [], 0, 0

    def close_until(self, name: str, across: frozenset = SCOPE) -> None:
        if not self.count[name]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            here = self.open[i][0]
            if here == name:
                self.count.subtract(x[0] for x in self.open[i:])
                del self.open[i:]
                return
            if here in across:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        for name, ended in ENDS.items():
            if tag in ended:
                self.close_until(name)
        out, hard, region = self.state()
        given = dict(attrs)
        words = set(re.split(r"[^a-z0-9]+", " ".join(str(given.get(k) or "") for k in ("class", "id", "role")).lower()))
        if tag in ("article", "main"):
            out = hard or bool(words & COMMENTS)
        elif tag not in ("html", "body"):
            hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in str(given.get("style") or "").replace(" ", "")
            inside = region >= 0 and self.articles[region] >= 0
            out = out or tag in NEVER or (tag == "header" and not inside) or bool(words & OTHER) or hidden
        if tag in REGION:
            above = self.articles[region] if region >= 0 else -1
            self.parents.append(region)
            region = len(self.parents) - 1
            self.articles.append(region if tag in ("article", "main") else above)
        self.count[tag] += 1
        self.open.append((tag, out, hard or (out and tag != "form"), region))

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if tag not in VOID:
            self.close_until(tag, frozenset() if tag in SCOPE else SCOPE)

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.count["a"]:
            self.linked += len(data.strip())

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...`` up to the next ``>`` is a comment, whatever its keyword."""
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else -1


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(values, kernel / kernel.sum(), "full")[reach : reach + len(values)]


def threshold(values: np.ndarray) -> float:
    """Halfway between the means of two clusters, low and high."""
    low, high = float(values.min()), float(values.max())
    for _ in range(32):
        cut = (low + high) / 2
        below, above = values[values <= cut], values[values > cut]
        if not len(above):
            break
        was, (low, high) = (low, high), (float(below.mean()), float(above.mean()))
        if was == (low, high):
            break
    return (low + high) / 2


def main_text(html: str | None) -> str:
    """The article of one page; see ``extract``."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    lines, parents, articles = parser.lines, parser.parents, parser.articles
    there = [x for x in lines if not x.out]
    if not there:
        return ""
    ratio = smooth(np.array([0.0 if x.out else x.plain / max(1, x.tags) for x in lines]))
    high = ratio > threshold(ratio) if len(lines) > 1 else np.ones(1, bool)
    best = [x.region for x, h in zip(lines, high) if h and not x.out]
    named = {articles[x.region] for x in there if x.region >= 0 and articles[x.region] >= 0}
    if named:
        # The innermost article around each line of the high cluster; all of the page's if none is high.
        wanted = {articles[r] for r in best if r >= 0 and articles[r] >= 0} or named
    else:
        wanted = {common(best or [x.region for x in there], parents)}
    # parents come before what is in them
    inside = [False] * (len(parents) + 1)
    inside[-1] = -1 in wanted
    for r, parent in enumerate(parents):
        inside[r] = r in wanted or inside[parent]
    return "\n\n".join(x.text for x in there if inside[x.region])


def common(regions: list[int], parents: list[int]) -> int:
    """The smallest region that holds all ``regions``."""
    if -1 in regions:
        return -1
    held = [0] * len(parents)
    for r in regions:
        held[r] += 1
    for r in range(len(parents) - 1, -1, -1):
        if held[r] == len(regions):
            return r
        if parents[r] >= 0:
            held[parents[r]] += held[r]
    return -1


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch["html"]]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    A page is cut into lines at block elements; character references are decoded, white space
    becomes one space. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
    and reader comments are told by element, class, id or role and count as empty lines. Each
    line's characters outside links are divided by its tags; the ratios are smoothed by a Gaussian
    and cut in two clusters. An article or main element with a line in the high cluster is content;
    on pages without one, the smallest container that holds all of them. All its lines are kept, short
    and linked ones too, joined by an empty line. Malformed markup never fails: unknown
    declarations are comments, stray ends are passed over, what is open at the end is closed; time and
    memory grow with the page, however deep its elements nest. Null or empty html, or a page of nothing else, gives an empty text; a
    page without any tag is its own single line. Ids and urls pass as they are, null and repeated
    ones too.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (page_id, url)}
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(_run, f"page_id {kinds[page_id]}, url {kinds[url]}, text string, n_chars long")


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
