"""The main text of web pages: parser events, text-to-tag ratios, smoothing, thresholds, regions.

The standard library's parser streams a page as events. They become lines, one per block element,
each with its characters, its tags and the container it stands in. The ratio of characters (without
those of links) to tags is smoothed over neighbouring lines with a Gaussian, and a threshold between the two clusters
of ratios tells dense lines from sparse ones. The container that holds most of the dense text is the region of the
article: its lines are the main text, short ones included, but for containers within it whose own
ratio lies below the threshold. Names only lend weight: the text of a part that calls itself a menu, an advert,
a comment section and the like counts for a twentieth, so that its ratio is that of a sparse one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.5  # of the Gaussian, in lines
MARKED_WEIGHT = 0.05  # of a character in a part whose name says that it is no main text
RECOVERIES = 50  # unfinished tags of a page that are passed over one by one
REGION_SHARE = 0.6  # of a container's dense text: a part with that much is looked into further

# Elements that begin a block, that hold other blocks, that hold nothing, whose text is not shown as text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article aside body center details dialog div footer form header main menu nav section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("audio button canvas datalist embed head iframe noscript object script select style svg template textarea title video".split())
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"})
# Elements, words of class and id names, and roles, that mark parts beside the main text.
MARKED = frozenset("aside dialog footer form header menu nav search".split())
FURNITURE = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted promotion recommended related replies respond share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar widget".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_NAME = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class _Part:
    """A container, or any element whose name marks it: the part around it, and how much its text weighs."""

    around: int
    weight: float
    header: bool  # nothing but a page or article header marks it


@dataclass
class _Line:
    text: str
    tags: int
    linked: int
    part: int
    heading: bool


class _Lines(HTMLParser):
    """Collects lines and parts. Work per event does not grow with the depth of the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.parts = [_Part(-1, 1.0, False)]
        self.open: list[tuple[str, int, bool]] = []  # element, part, unseen
        self.depths: dict[str, list[int]] = {}  # of the open elements of a name
        self.blocks: list[int] = []  # depths of the open blocks
        self.walls: list[int] = []  # depths of the open articles, which stray end tags do not end
        self.pieces: list[str] = []
        self.tags = self.linked = 0
        self.heading = False

    def read(self, html: str) -> None:
        """Parse a page. A tag or comment that never ends is passed over up to the next ``>``.

        Looking for its end takes the whole rest of the page, so after ``RECOVERIES`` of them the rest goes.
        """
        self.feed(html)
        for _ in range(RECOVERIES):
            rest = self.rawdata
            if not rest.startswith("<") or ">" not in rest:
                break
            self.rawdata = ""
            self.feed(rest[rest.index(">") + 1 :])
        if self.rawdata.startswith("<"):
            self.rawdata = ""
        self.close()
        self.flush()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section, which HTML does not have, is a comment, whatever it holds."""
        return self.parse_bogus_comment(i)

    def _here(self) -> tuple[int, bool]:
        return self.open[-1][1:] if self.open else (0, False)

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.lines.append(_Line(text, self.tags, self.linked, self._here()[0], any(self.depths.get(h) for h in HEADINGS)))
            self.tags = 0
        self.pieces, self.linked = [], 0

    def _end(self, depth: int) -> None:
        """End the open elements from this depth on."""
        while len(self.open) > depth:
            self.depths[self.open.pop()[0]].pop()
        while self.blocks and self.blocks[-1] >= depth:
            self.blocks.pop()
        while self.walls and self.walls[-1] >= depth:
            self.walls.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
            # A block ends an open paragraph, and the inline elements left open in it.
            if self.blocks and self.open[self.blocks[-1]][0] == "p":
                self._end(self.blocks[-1])
        if tag == "br":
            self.pieces.append(" ")
        if tag in VOID:
            return
        if tag in ("article", "main"):
            # An article is no part of a navigation or page header left open before it.
            left = [self.depths[name][0] for name in ("nav", "header", "head") if self.depths.get(name)]
            if left:
                self._end(min(left))
        part, unseen = self._here()
        marked = self._marked(tag, attrs)
        if tag in CONTAINERS or marked:
            around = self.parts[part]
            weight = MARKED_WEIGHT if marked else around.weight
            header = tag == "header" and around.weight == 1.0 or around.header and not marked
            self.parts.append(_Part(part, weight, header))
            part = len(self.parts) - 1
        depth = len(self.open)
        self.open.append((tag, part, unseen or tag in UNSEEN))
        self.depths.setdefault(tag, []).append(depth)
        if tag in BLOCKS:
            self.blocks.append(depth)
        if tag in ("article", "main"):
            self.walls.append(depth)

    @staticmethod
    def _marked(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in MARKED:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        for name, value in attrs:
            value = (value or "").lower()
            if name in ("class", "id") and not FURNITURE.isdisjoint(_NAME.findall(value)):
                return True
            if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style" and _HIDDEN.search(value):
                return True
        return False

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self._end(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        depths = self.depths.get(tag)
        # A stray end tag does not end the article around it.
        if depths and (not self.walls or depths[-1] >= self.walls[-1] or tag in ("html", "body")):
            self._end(depths[-1])

    def handle_data(self, data: str) -> None:
        if not self._here()[1]:
            self.pieces.append(data)
            if self.depths.get("a"):
                self.linked += len(data.strip())


def _threshold(ratio: np.ndarray) -> float:
    """The border between two clusters of log ratios (two means)."""
    x = np.log1p(ratio)
    low, high = x.min(), x.max()
    for _ in range(20):
        border = (low + high) / 2
        below, above = x[x <= border], x[x > border]
        if not len(below) or not len(above):
            break
        low, high = below.mean(), above.mean()
    # Ratios that all lie close together are one cluster.
    return 0.0 if high - low < np.log(4) else float(np.expm1((low + high) / 2))


def _upwards(values: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Sums of each part together with all parts in it; a part comes after the one around it."""
    total = values.tolist()
    for part in range(len(total) - 1, 0, -1):
        total[around[part]] += total[part]
    return np.array(total)


def main_text(html: str) -> str:
    """The main text of one page: its blocks in page order, joined by an empty line."""
    parser = _Lines()
    parser.read(html)
    lines, parts = parser.lines, parser.parts
    if not lines:
        return ""
    around = np.array([part.around for part in parts])
    weight = np.array([part.weight for part in parts])
    part = np.array([line.part for line in lines])
    heading = np.array([line.heading for line in lines])
    size = np.array([len(line.text) for line in lines])
    tags = np.maximum([line.tags for line in lines], 1)
    plain = np.maximum(size - [line.linked for line in lines], 0)
    # The heading of an article may stand in a header of its own.
    header = np.array([p.header for p in parts])[part] & heading
    content = plain * np.where(header, 1.0, weight[part])
    ratio = content / tags
    reach = np.arange(-int(3 * SIGMA), int(3 * SIGMA) + 1)
    bell = np.exp(-(reach**2) / (2 * SIGMA**2))
    smooth = np.convolve(np.pad(ratio, len(reach) // 2, mode="edge"), bell / bell.sum(), mode="valid")
    border = _threshold(smooth)
    dense = smooth >= border

    n = len(parts)
    mass = _upwards(np.bincount(part, content * dense, n), around)
    region = _region(mass, around)
    region = _with_headings(region, part, heading, weight, around)
    # Within the region a part counts by its own text: with that of the parts around it, it would pass for theirs.
    own = _upwards(np.bincount(part, content, n), around) / np.maximum(_upwards(np.bincount(part, tags, n), around), 1)
    kept = np.zeros(n, bool)
    kept[region] = True
    for p in range(region + 1, n):
        kept[p] = kept[around[p]] and own[p] >= border and weight[p] == weight[region]
    chosen = (kept[part] | header & kept[around[part]]) & (plain > 0.1 * size)
    return "\n\n".join(line.text for line, keep in zip(lines, chosen) if keep)


def _region(mass: np.ndarray, around: np.ndarray) -> int:
    """From the whole page into the part that holds most of what is dense, as long as there is one."""
    heaviest: dict[int, int] = {}
    for p in range(1, len(mass)):
        a = int(around[p])
        if a not in heaviest or mass[p] > mass[heaviest[a]]:
            heaviest[a] = p
    region = 0
    while region in heaviest and mass[heaviest[region]] > REGION_SHARE * mass[region]:
        region = heaviest[region]
    return region


def _with_headings(region: int, part: np.ndarray, heading: np.ndarray, weight: np.ndarray, around: np.ndarray) -> int:
    """The part around a region, as long as the only lines that it adds directly are headings."""
    while region > 0:
        beside = part == around[region]
        if not beside.any() or not heading[beside].all() or weight[around[region]] < 1.0:
            return region
        region = int(around[region])
    return region


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, len(batch), 256):  # bounded output batches
            some = batch.slice(first, 256)
            texts = [main_text(html.as_py() or "") for html in some.column("html")]
            yield pa.RecordBatch.from_arrays([some.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``, in its place.

    NULL, empty and text-free pages have the empty text. Every row is read by itself, so repeated rows
    stay repeated. A column called ``text`` gives way to the new one; others pass through.
    """
    carry = [c for c in pages.columns if c not in ("html", "text")]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("html").cast("string"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string"
    return rows.mapInArrow(_extracted, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in carry], "text")
