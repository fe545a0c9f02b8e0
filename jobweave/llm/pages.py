"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of element paths.  A node's presentation importance is the
entropy of the child sequences seen there; a block's content importance falls with the number of pages that
share its text and, outside the article, with the share of it that is links.  Both start from a prior that
stands for a few pages, so a host of one page has a tree as well, and are combined from the leaves up.  Names
of classes and ids are priors: those of reader comments, adverts, notices and the like make a branch worthless
unless it holds the article.  Branches of low importance are cut out of each page, beside elements that are
furniture by their tag or role; what is left of the article is the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_groups, written

#: Weight of a node's children against its own presentation.
DAMPING = 0.9
#: A branch below this importance is cut.
LOW_IMPORTANCE = 0.2
#: Importance before any page is seen and the pages it stands for: of a node, and of one with a doubtful name.
PRIOR, DOUBTFUL = (0.6, 2.0), (0.1, 1.0)

# Elements of HTML by their kind.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PROSE = frozenset("article main p h1 h2 h3 h4 h5 h6 blockquote pre li ul ol dl dt dd table tbody tr td th".split())
FURNITURE_TAGS = frozenset(
    "aside button datalist dialog footer head header input menu nav object search select svg audio video canvas "
    "fieldset".split()
)
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split()
)
# Words in classes and ids.  Those of readers and furniture count anywhere in a name, those of
# doubt may be borne by main text as well; a name with a word of layout says how a page is built, not what it holds.
READER_WORDS = frozenset("comment comments reply replies respond disqus".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr nav navbar "
    "navigation menu breadcrumb breadcrumbs pager pagination sidebar footer masthead topbar toolbar signup subscribe "
    "newsletter popup modal".split()
)
DOUBTFUL_WORDS = frozenset(
    "side form related share sharing search social notice notices alert hidden header banner overlay promotion subscription "
    "login discussion recommended recommendations aside widget".split()
)
LAYOUT_WORDS = frozenset("has no not with without is layout grid column columns template theme".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th".split())
CLOSED_BY_SAME = {
    "li": ("ul", "ol", "menu"),
    "dt": ("dl",),
    "dd": ("dl",),
    "option": ("select", "datalist"),
    "tr": ("table",),
    "td": ("tr", "table"),
    "th": ("tr", "table"),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|noscript|template|iframe|noembed|noframes|xmp)\b[^>]*>.*?(?:</\1[^>]*>|\Z)"
    r"|<[a-z/](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|<[a-z/!?][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_NAME = re.compile(r"</?\s*([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s=/>"'<]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NOT_LETTERS = re.compile(r"[^a-z]+")


@dataclass
class Element:
    tag: str
    path: str
    furniture: bool
    in_article: int
    in_main: bool
    block: bool


@dataclass
class Block:
    path: str
    in_article: int
    in_main: bool
    text: str
    links: int = 0

    @property
    def prose(self) -> bool:
        return _tag(self.path) in PARAGRAPHS


def _tag(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def _attributes(tag: str) -> dict[str, str]:
    body = _NAME.sub("", tag, count=1).rstrip(">")
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(body)}


def _names(attributes: dict[str, str]) -> list[str]:
    """Class and id names, each as lower-case words joined by hyphens."""
    names = [n for key in ("class", "id") for n in attributes.get(key, "").split()]
    return [w for n in names if (w := _NOT_LETTERS.sub("-", _HUMP.sub("-", n).lower()).strip("-"))]


def _is_furniture(tag: str, attributes: dict[str, str], parent: Element) -> bool:
    if tag in ("html", "body", "main") or (tag == "header" and parent.in_article):
        return False
    if tag in FURNITURE_TAGS or attributes.get("role", "").lower() in FURNITURE_ROLES:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    names = _names(attributes)
    if tag in ("a", "ins", "span"):  # not in the tree, which is one of blocks
        return any(n in FURNITURE_WORDS or n in READER_WORDS for n in names)
    return tag == "article" and any(n.startswith(("comment", "reply")) for n in names)


def name_kind(path: str) -> str | None:
    """What the names of a path's last element make of it: "reader", "furniture", "doubtful" or nothing."""
    tag, *names = path.rpartition("/")[2].split(".")
    if tag in ("html", "body", "main", "article"):
        return None
    words = {w for n in names if LAYOUT_WORDS.isdisjoint(n.split("-")) for w in n.split("-")}
    if words & READER_WORDS:
        return "reader"
    if tag == "form" or words & FURNITURE_WORDS:
        return "furniture"
    return "doubtful" if words & DOUBTFUL_WORDS else None


def parse(page: str | None) -> tuple[list[Block], dict[str, list[str]]]:
    """Text blocks outside furniture tags in page order, and the child paths of every block element."""
    page = page or ""
    root = Element("", "", False, 0, False, True)
    stack = [root]
    blocks: list[Block] = []
    children: dict[str, list[str]] = {}
    words: list[str] = []
    links = articles = 0

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            owner = next(e for e in reversed(stack) if e.block)
            blocks.append(Block(owner.path, owner.in_article, owner.in_main, text, min(links, len(text))))
        links = 0

    def pop(depth: int) -> None:
        if any(e.block for e in stack[depth:]):
            flush()
        del stack[depth:]

    def close(tag: str, until: tuple[str, ...] = ()) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            element = stack[depth]
            if element.tag == tag:
                pop(depth)
                return
            if element.tag in until or (tag not in BLOCKS and element.block):
                return

    at = 0
    for found in _TOKEN.finditer(page):
        if found.start() > at and not stack[-1].furniture:
            words.append(html.unescape(page[at : found.start()]))
            if any(e.tag == "a" for e in stack):
                links += len(words[-1])
        at = found.end()
        token = found[0]
        name = _NAME.match(token)
        if name is None or found[1]:
            continue
        tag = name[1].lower()
        if token[1] == "/":
            close(tag)
            continue
        block = tag in BLOCKS
        if block:
            close("p", ("table", "td", "th", "button"))
        if tag in CLOSED_BY_SAME:
            for same in ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,):
                close(same, CLOSED_BY_SAME[tag])
            if tag == "tr":
                close("tr", ("table",))
        if tag == "br":
            if not stack[-1].furniture:
                words.append(" ")
            continue
        if block:
            flush()
        if tag in VOID:
            continue
        parent = stack[-1]
        attributes = _attributes(token) if len(token) > len(tag) + 2 else {}
        path = parent.path
        if block:
            label = ".".join([tag, *sorted(_names(attributes))])
            path = f"{parent.path}/{label}"
            children.setdefault(parent.path, []).append(path)
        furniture = parent.furniture or _is_furniture(tag, attributes, parent)
        articles += tag == "article"
        stack.append(
            Element(
                tag,
                path,
                furniture,
                0 if furniture else parent.in_article or (articles if tag == "article" else 0),
                (parent.in_main or tag == "main" or attributes.get("role", "").lower() == "main") and not furniture,
                block,
            )
        )
    if at < len(page) and not stack[-1].furniture:
        words.append(html.unescape(page[at:]))
    flush()
    return blocks, children


def _protected(path: str) -> bool:
    """Prose directly under an article or main element is content whatever other pages say."""
    tags = [label.partition(".")[0] for label in path.split("/")]
    for k, tag in enumerate(tags):
        if tag in ("article", "main"):
            return all(t in PROSE for t in tags[k:])
    return False


def main_text(blocks: list[Block], cut: frozenset[str] | set[str] = frozenset()) -> str:
    """Blocks of the article, or of main, or of the page, without the cut branches.

    The articles are left for main or the page when more prose stands outside them than in the longest of
    them, and main when more stands outside it.
    """
    if cut:
        blocks = [b for b in blocks if cut.isdisjoint(_above(b.path))]
    longest: dict[int, int] = {}
    for b in blocks:
        longest[b.in_article] = longest.get(b.in_article, 0) + len(b.text)
    longest.pop(0, None)
    main = sum(len(b.text) for b in blocks if b.in_main)
    if longest and sum(len(b.text) for b in blocks if b.prose and not b.in_article) <= max(longest.values()):
        blocks = [b for b in blocks if b.in_article]
    elif main and sum(len(b.text) for b in blocks if b.prose and not b.in_main) <= main:
        blocks = [b for b in blocks if b.in_main]
    return "\n".join(b.text for b in blocks)


def _number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def page_nodes(blocks: list[Block], children: dict[str, list[str]]) -> list[dict]:
    """The page's part of the style tree: presentation of each node and content of each block."""
    rows = []
    for path, below in children.items():
        run = [c for k, c in enumerate(below) if k == 0 or below[k - 1] != c]
        rows.append({"path": path, "content": False, "feature": _number("\n".join(run)), "chars": 0, "links": 0})
    for path, text, links in {(b.path, b.text, b.links) for b in blocks}:
        rows.append({"path": path, "content": True, "feature": _number(text), "chars": len(text), "links": links})
    return rows


def _above(path: str) -> Iterator[str]:
    """A path and all above it."""
    while path:
        yield path
        path = path.rpartition("/")[0]


def low_branches(nodes: pd.DataFrame) -> list[str]:
    """Highest branches of one host's tree whose combined importance is low.

    ``nodes`` has for each path and kind (presentation or content): pages, importance, chars and links.
    """
    own: dict[str, dict[bool, tuple[float, int]]] = {}
    dense: dict[str, float] = {}
    every = article = 0
    sums = {"all": {}, "article": {}}
    heads, prose, protected = set(), set(), set()
    for row in nodes.itertuples():
        path, content = row.path, bool(row.content)
        own.setdefault(path, {})[content] = (float(row.importance), int(row.pages))
        above = list(_above(path))
        if any(_tag(p) in ("main", "h1") for p in above):
            heads.update(above)
        if not content:
            continue
        inside = any(_tag(p) in ("article", "main") for p in above)
        dense[path] = 0.0 if inside else int(row.links) / max(1, int(row.chars))
        if _tag(path) in PARAGRAPHS:
            prose.update(above)
        if _protected(path):
            protected.update(above)
        if not any(name_kind(p) == "reader" for p in above):
            every += int(row.chars)
            article += int(row.chars) * inside
            for p in above:
                sums["all"][p] = sums["all"].get(p, 0) + int(row.chars)
                sums["article"][p] = sums["article"].get(p, 0) + int(row.chars) * inside

    def worthless(path: str) -> bool:
        """Whether names alone decide: unless the branch holds the article, or most text where there is none."""
        kind = name_kind(path)
        if kind is None or (kind == "doubtful" and path in prose):
            return False
        if kind == "reader":
            return path not in heads
        if article:
            return 2 * sums["article"].get(path, 0) <= article
        return path not in heads and 2 * sums["all"].get(path, 0) <= every

    below: dict[str, list[str]] = {}
    for path in own:
        below.setdefault(path.rpartition("/")[0], []).append(path)
    combined: dict[str, float] = {}
    named = {path for path in own if path and worthless(path)}
    for path in sorted(own, key=lambda p: -p.count("/")):
        if path in named:
            combined[path] = 0.0
            continue
        prior, weight = DOUBTFUL if name_kind(path) == "doubtful" else PRIOR
        smooth = {k: (weight * prior + n * x) / (weight + n) for k, (x, n) in own[path].items()}
        parts = [combined[c] for c in below.get(path, ()) if c != path]
        if True in smooth:
            parts.append(smooth[True] * (1 - dense[path]))
        mean = sum(parts) / len(parts) if parts else 0.0
        share = DAMPING if parts else 0.0
        combined[path] = (1 - share) * smooth.get(False, 0.0) + share * mean
    low = {
        p for p in own
        if p in named or (p and combined[p] < LOW_IMPORTANCE and p not in protected and _tag(p) not in ("html", "body"))
    }
    return sorted(p for p in low if not any(q in low for q in _above(p.rpartition("/")[0])))


OUTLINE = (
    "page_id long, url string, host string, same long, "
    "blocks array<struct<path: string, in_article: int, in_main: boolean, text: string>>, "
    "nodes array<struct<path: string, content: boolean, feature: long, chars: long, links: long>>"
)
_BLOCKS = pa.list_(pa.struct([("path", pa.string()), ("in_article", pa.int32()), ("in_main", pa.bool_()), ("text", pa.string())]))
_NODES = pa.list_(
    pa.struct([("path", pa.string()), ("content", pa.bool_()), ("feature", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())])
)


def outlines(pages: DataFrame) -> DataFrame:
    """Every page parsed once: its text blocks, its part of the style tree, and a hash of its text before any cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                parsed = [parse(page) for page in batch.column("html").to_pylist()]
                blocks = [
                    [{"path": b.path, "in_article": b.in_article, "in_main": b.in_main, "text": b.text} for b in found]
                    for found, _ in parsed
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in ("page_id", "url", "host")),
                        pa.array([_number(main_text(found)) for found, _ in parsed], pa.int64()),
                        pa.array(blocks, _BLOCKS),
                        pa.array([page_nodes(*p) for p in parsed], _NODES),
                    ],
                    names=["page_id", "url", "host", "same", "blocks", "nodes"],
                )

    return pages.mapInArrow(run, OUTLINE)


def site_branches(parsed: DataFrame) -> DataFrame:
    """(host, cut, _n): the low-importance branches of every host that has some, and the host's pages.

    Pages of a host with the same text count as one page, so copies make no text look like furniture.  Counting
    is done before rows meet in one task; a host's task gets one row per path.
    """
    nodes = parsed.select("host", "same", F.explode("nodes").alias("node")).select("host", "same", "node.*")
    seen = nodes.distinct().groupBy("host", "path", "content", "feature").agg(
        F.count("*").alias("n"), F.max("chars").alias("chars"), F.max("links").alias("links")
    )
    n = F.col("n").cast("double")
    # content: a text on n of m pages has entropy log n / log m; presentation: -sum p log p / log m
    per_path = seen.groupBy("host", "path", "content").agg(
        F.sum("n").alias("total"),
        F.sum(n * F.log(n)).alias("n_log_n"),
        F.sum(F.col("n") * F.col("chars")).alias("chars"),
        F.sum(F.col("n") * F.col("links")).alias("links"),
    )
    total = F.col("total").cast("double")
    spread = F.when(F.col("total") <= 1, F.lit(1.0)).otherwise(1 - F.col("n_log_n") / (total * F.log(total)))
    per_path = per_path.select("host", "path", "content", F.col("total").alias("pages"), spread.alias("importance"), "chars", "links")

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        low = low_branches(pdf)
        rows = [(pdf["host"].iloc[0], low)] if low else []
        return pd.DataFrame(rows, columns=["host", "cut"], dtype=object)

    cuts = per_path.groupBy("host").applyInPandas(cut, "host string, cut array<string>")
    return cuts.join(parsed.groupBy("host").agg(F.count("*").alias("_n")), "host")


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page row.

    A null or empty html gives an empty text.  A null url belongs to the host of all that have none.  Pages
    stored twice give two rows; extra columns are not read; broken or cut-off markup is read as far as it
    goes.
    """
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.lower(F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit(""))).alias("host"),
    )
    parsed = written(outlines(source))
    branches = written(site_branches(parsed))
    rows = parsed.select("page_id", "url", "host", "blocks")
    joined = with_groups(rows, "host", branches, "page_id", rows.count()).select("page_id", "url", "blocks", "cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(batch.column("blocks").to_pylist(), batch.column("cut").to_pylist(), strict=True)
            texts = [main_text([Block(**b) for b in blocks], frozenset(cut or ())) for blocks, cut in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                schema=RESULT,
            )

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
