"""Main text of web pages by consensus host paths.

1. Every page is parsed once; each container (an element that holds blocks of text) is scored by the
   text of all blocks below it, each less twice its link text. A page votes for its containers'
   generalised paths (tag and class names without digits) in per mille of all its main text.
2. Spark adds up the votes per host and path. Of the paths to an ``article`` or ``main`` with half of the
   host's text or more, the one with most of it wins, the deepest of several; without such a path, the
   deepest to another container, cells and quotes aside, with nearly all of it. Headings weigh ten times
   their length, so a nested section never stands for an article whose title it lacks.
3. Pages are extracted again with their host's path; a page of which that path has less than half
   falls back to its own winner by the same rule.

Votes are partial sums per task before the shuffle, so a host with a third of all pages is a few rows
per task. Pages are joined with the winners, one narrow row per host.

Inside the chosen containers navigation, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments are left out, by tag or by class and id names. Ids of headings and paragraphs
and ids that only begin like such a name are slugs of main text, as are classes of headings and
paragraphs. Character references are
decoded, white space inside a block becomes one space, blocks are joined by one space.

Defined results: null and empty pages, and pages without main text, give an empty text. A null or
malformed address belongs to the host ''. Ties go to the path that sorts last. Repeated rows vote
repeatedly and give repeated results. Very long pages are parsed once from start to end, like others. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import html as markup
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import named, text_batches
from starmill.session import stored

FLUSH = 20_000
ROOT = "html"

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template textarea title iframe noembed noframes xmp svg math".split()
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s"
    " samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("article main section div td body center blockquote".split())
DROPPED = frozenset(
    "nav header footer aside form button select option dialog menu head audio video canvas"
    " object".split()
)
# Class and id names of what is not main text.
DROPPED_NAMES = (
    "ad|ads|advert|advertisement|adsense|sponsor|sponsored|promo|banner|menu|nav|navbar|navigation|"
    "breadcrumb|breadcrumbs|sidebar|footer|header|masthead|cookie|cookies|notice|consent|gdpr|popup|"
    "modal|newsletter|subscribe|signup|share|sharing|social|related|recommended|comment|comments|"
    "disqus|replies|widget|pagination|pager|login|search|toolbar|skip"
)
NEVER_DROPPED = frozenset("html body main article h1 h2 h3 h4 h5 h6 p".split())
PREFERRED = ("article", "main")
PASSED_OVER = ("td", "blockquote")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HALF, NEARLY_ALL, HEADING_WEIGHT = 0.5, 0.99, 10
# Elements that end when one of the same group begins.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
}
SCOPES = frozenset("ul ol dl table article section div main body td blockquote".split())
CLOSES_P = frozenset(
    "address article aside blockquote center dd details div dl dt fieldset figure footer form h1 h2"
    " h3 h4 h5 h6 header hr li main menu nav ol p pre section table td th tr ul".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""\b(class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
DROPPED_ID = re.compile(DROPPED_NAMES, re.IGNORECASE)
DROPPED_NAME = re.compile(rf"(?:{DROPPED_NAMES})(?:[-_].*)?", re.IGNORECASE)


class _Element:
    __slots__ = ("tag", "path", "parent", "dropped", "link", "chosen", "depth")

    def __init__(self, tag: str, attributes: str, parent: _Element | None, want: str | None) -> None:
        classes, ids = [], []
        if attributes:
            found = ATTRIBUTE.findall(attributes)
            ids = [x for k, *v in found if k.lower() == "id" for x in "".join(v).split()]
            classes = [x for k, *v in found if k.lower() == "class" for x in "".join(v).split()]
            general = sorted({c for x in classes if (c := re.sub(r"\d+", "", x.lower()).strip("-_"))})
            step = ".".join([tag, *general])
        else:
            step = tag
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.path = f"{parent.path}>{step}" if parent else step
        self.dropped = bool(parent and parent.dropped) or tag in DROPPED or (
            tag not in NEVER_DROPPED
            and (any(map(DROPPED_NAME.fullmatch, classes)) or any(map(DROPPED_ID.fullmatch, ids)))
        )
        self.link = tag == "a" or bool(parent and parent.link)
        self.chosen = bool(parent and parent.chosen) or (want is not None and self.path == want)


def walk(page: str, want: str | None = None) -> Iterator[tuple[_Element, str, int]]:
    """Blocks of the page: the element that holds each, its text, its characters inside links.

    Elements under the path ``want`` are marked as chosen.
    """
    root = _Element(ROOT, "", None, want)
    here, parts, linked, at = root, [], 0, 0

    def block() -> Iterator[tuple[_Element, str, int]]:
        nonlocal parts, linked
        text, parts = " ".join("".join(parts).split()), []
        links, linked = linked, 0
        holder = here
        while holder.tag in INLINE and holder.parent:
            holder = holder.parent
        if text:
            yield holder, text, links

    def gather(raw: str) -> None:
        nonlocal linked
        if raw and not here.dropped:
            text = markup.unescape(raw)
            parts.append(text)
            if here.link:
                linked += len(text.strip())

    for token in TOKEN.finditer(page):
        gather(page[at:token.start()])
        at = token.end()
        closing, tag = token.group(2), token.group(3)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            found = here
            while found and found.tag != tag:
                found = found.parent if found.tag not in SCOPES or tag in SCOPES else None
            if found and found.parent:
                if tag not in INLINE:
                    yield from block()
                here = found.parent
            continue
        if tag in ("html", "br"):
            parts.append(" ")
            continue
        if tag not in INLINE:
            yield from block()
            ending = CLOSES.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
            found, last = here, None
            while ending and found and found.tag not in SCOPES - ending:
                if found.tag in ending:
                    last = found
                found = found.parent
            here = last.parent if last else here
        if tag not in VOID and not token.group(4).rstrip().endswith("/") or tag in CONTAINERS:
            here = _Element(tag, token.group(4), here, want)
    rest = page[at:]
    cut = rest.find("<")  # a tag that the page's end cuts off is no text
    if cut >= 0 and re.match(r"<[a-zA-Z/!]", rest[cut:]):
        rest = rest[:cut]
    gather(rest)
    yield from block()


def _holder(element: _Element) -> _Element | None:
    """The nearest container around a block's element."""
    while element and element.tag not in CONTAINERS:
        element = element.parent
    return element


def container_scores(page: str) -> dict[str, int]:
    """The page's containers by path: the main text below each; all of it under the root's path."""
    worth: dict[int, dict[_Element, int]] = defaultdict(lambda: defaultdict(int))
    for element, text, linked in walk(page):
        value = (len(text) - 2 * linked) * (HEADING_WEIGHT if element.tag in HEADINGS else 1)
        if value > 0 and not element.dropped:
            holder = _holder(element) or element
            worth[holder.depth][holder] += value
    scores: dict[str, int] = defaultdict(int)
    for depth in range(max(worth, default=-1), -1, -1):
        for element, value in worth[depth].items():
            if element.tag in CONTAINERS or element.parent is None:
                scores[element.path] += value
            if element.parent is not None:
                worth[depth - 1][element.parent] += value
    return dict(scores)


def _tag(path: str) -> str:
    """The tag name of a path's last step."""
    return path.rsplit(">", 1)[-1].split(".")[0]


def _best(scores: dict[str, int]) -> str:
    """The winning path of one page, by the rule for hosts."""
    total = scores.get(ROOT, 0)

    def rank(path: str) -> tuple:
        depth, score = path.count(">"), scores[path]
        named = _tag(path) in PREFERRED and score >= HALF * total
        return (1, score, depth, path) if named else (0, depth, score, path)

    fit = [k for k, score in scores.items() if rank(k)[0]
           or score >= NEARLY_ALL * total and _tag(k) not in PASSED_OVER]
    return max(fit, key=rank, default=ROOT)


def main_text(page: str, want: str | None) -> str:
    """Text of the containers under the path ``want``, else of those that the page itself prefers."""
    if not page:
        return ""
    scores = container_scores(page)
    if want is None or scores.get(want, 0) < HALF * scores.get(ROOT, 0) or not scores:
        want = _best(scores)
    return " ".join(
        text for element, text, _ in walk(page, want) if element.chosen and not element.dropped
    )


def _votes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[str, str], int] = defaultdict(int)

    def flush() -> pa.RecordBatch:
        rows = [(host, path, n) for (host, path), n in sums.items()]
        sums.clear()
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
            ["host", "path", "votes"],
        )

    for batch, pages in text_batches(batches, "html"):
        for host, page in zip(batch.column("host").to_pylist(), pages):
            scores = container_scores(page)
            for path, score in scores.items():
                sums[host, path] += 1000 * score // scores[ROOT]
            if len(sums) > FLUSH:
                yield flush()
    yield flush()


def _extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, pages in text_batches(batches, "html"):
        texts = [main_text(p, w) for p, w in zip(pages, batch.column("path").to_pylist())]
        yield pa.RecordBatch.from_arrays([
            batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()),
        ], ["page_id", "url", "text", "n_chars"])


def host_of(url: Column) -> Column:
    """The address's host in small letters, without user and port; '' if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, the main text and its number of code points, one row per page."""
    rows = pages.select(
        named(pages, "page_id").cast("long").alias("page_id"),
        named(pages, "url").alias("url"),
        host_of(named(pages, "url")).alias("host"),
        named(pages, "html").alias("html"),
    )
    votes = rows.select("host", "html").mapInArrow(_votes, "host string, path string, votes long")
    summed = stored(
        votes.groupBy("host", "path").agg(F.sum("votes").alias("votes")), "host-votes"
    )
    totals = summed.filter(F.col("path") == ROOT).select("host", F.col("votes").alias("total"))
    share, depth = F.col("votes") / F.col("total"), F.regexp_count("path", F.lit(">"))
    tag = F.regexp_extract("path", "([^>.]*)[^>]*$", 1)
    preferred = (tag.isin(*PREFERRED) & (share >= HALF)).cast("int")
    first, second = F.col("votes"), depth
    rank = F.struct(
        preferred.alias("preferred"),
        F.when(preferred == 1, first).otherwise(second).alias("first"),
        F.when(preferred == 1, second).otherwise(first).alias("second"),
        "path",
    )
    winners = stored(
        summed.join(totals, "host")
        .filter((preferred == 1) | (share >= NEARLY_ALL) & ~tag.isin(*PASSED_OVER))
        .groupBy("host").agg(F.max(rank).alias("best"))
        .select("host", F.col("best.path").alias("path")),
        "host-paths",
    )
    return rows.join(winners, "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long"
    )
