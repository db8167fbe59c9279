"""Extract the main text of web pages.

A page is read into blocks. Elements that name themselves as menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles or reader comments are left out. Where the page marks its article (``article``, ``main``), the
blocks in it are the main text, but for those that stand whole in the articles of more than half of the distinct pages of
the host, which make up the smaller part of a page's article. Where it marks none, the unnamed boilerplate is found by repetition:
runs of ``RUN`` tokens are told by 64-bit hashes, and a block goes if runs that other distinct pages of the host share
cover all of it. Pages of equal streams count once.

A host's pages are dealt over groups of bounded size, which are units of work only: the distinct page streams that hold
a run are counted over all groups of the host.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelstat.llm.common import mix, prefix_hashes, sized_slices, span_hashes, stored, table, text_bytes
from reelstat.session import broadcast_if_small

# Tokens of a shared run, distinct pages that must share it, and pages of one host that are looked at together.
RUN, PAGES, GROUP = 8, 3, 256

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)""",
    re.DOTALL,
)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.IGNORECASE)
_PART = re.compile(r"[a-z0-9]+")
_MARKED = re.compile(r"<(?:article|main)\b", re.IGNORECASE)
# A further part of a class or id that only says how a named element looks, as in "ad-box" or "cookie-notice-2".
_LOOKS = re.compile(
    r"\d+|box|bar|block|list|section|area|container|wrapper|wrap|inner|outer|top|bottom|"
    r"left|right|links?|form|widget|posts|articles|stories|items|icons|buttons?"
)
_BEFORE = {"has", "no", "with", "without", "is", "hide", "hidden", "show", "page", "layout"}

# Fixed values of HTML and of common page layouts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe xmp noembed noframes".split())
# Left out whole as well, but an unclosed one ends at the next tag instead of the page.
SKIPPED = set("noscript template svg select button".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
OUT = set("head nav header footer aside form dialog menu".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
OUT_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
# Words that name an element, anywhere in the page, as the last telling part of a class or id.
OUT_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted cookie cookies consent gdpr "
    "notice notices notification popup modal overlay newsletter subscribe subscription signup share sharing social "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager comment comments disqus respond "
    "replies related recommended".split()
)
# And outside the marked article only.
OUTER_WORDS = set("header masthead topbar toolbar footer banner alert login search side widget widgets".split())
COMMENT_WORDS = {"comment", "comments", "disqus", "respond", "replies"}
RELATED_WORDS = {"related", "recommended", "sponsored", "promo", "promoted"}
# Words that inside an article name something else only if the whole class or id is made of such words.
VAGUE_WORDS = set("notice notices notification subscription menu navigation replies respond".split())
# An article of a page counts if it has this share of the longest one's characters, or more.
LEAST_ARTICLE = 0.5
# A block of marked articles is the host's and not the article's if it is in more than this share of its distinct articles,
# and only from articles that keep this share of their characters: copies of an article share most of theirs.
TEMPLATE, KEPT = 0.5, 0.5
# What an element adds to the count of elements left out, if it wraps other articles than the page's.
STRONG = 1 << 10


def _telling(value: str, in_main: bool = False) -> set[str]:
    """The last part of each class or id, without parts that tell looks; none where it says that another element is there."""
    words = set()
    for token in value.lower().strip("\"'").split():
        parts = _PART.findall(token)
        while len(parts) > 1 and _LOOKS.fullmatch(parts[-1]):
            parts.pop()
        if not parts or len(parts) > 1 and parts[-2] in _BEFORE:
            continue
        if in_main and parts[-1] in VAGUE_WORDS and not set(parts) <= OUT_WORDS:
            continue
        words.add(parts[-1])
    return words


def _named_out(name: str, tag: str, in_main: bool) -> int:
    """More than 0 where an opening tag starts something that is not main text."""
    if name in OUT:
        return 1
    words, roles = set(), set()
    for key, value in _MARKS.findall(tag):
        if key.lower() == "role":
            roles.update(_PART.findall(value.lower()))
        elif key.lower() == "class" or name not in HEADINGS:
            words |= _telling(value, in_main)
    if name in ("html", "body", "main"):
        return 0
    if name == "article":
        return STRONG * bool(words & COMMENT_WORDS)
    if words & (COMMENT_WORDS | RELATED_WORDS):
        return STRONG
    return int(bool(roles & OUT_ROLES or words & OUT_WORDS or not in_main and words & OUTER_WORDS))


def blocks(page: str | None) -> tuple[list[str], bool]:
    """The blocks of a page that are not named as something else, and whether they come from a marked article.

    An article in a wrapper whose name leaves it out counts if the page marks no other.
    """
    found = _blocks(page or "", False)
    if not found[1] and page and _MARKED.search(page):
        wrapped = _blocks(page, True)
        return wrapped if wrapped[1] else found
    return found


def _blocks(page: str, wrapped: bool) -> tuple[list[str], bool]:
    main: list[tuple[int, str]] = []  # number of the article, block
    rest: list[str] = []
    text: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # name, change of out, marks the main text
    out = in_main = articles = 0
    seen_main = False

    def flush() -> None:
        joined = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if joined and in_main:
            # Text of the main element beside its articles has the number 0.
            main.append((articles if any(n == "article" and m for n, _, m in stack) else 0, joined))
        elif joined:
            rest.append(joined)

    def keep(piece: str) -> None:
        if piece and (not out or in_main and out == 1 and _heading_of_article(stack)):
            text.append(piece)

    place, n = 0, len(page)
    for found in iter(lambda: _TOKEN.search(page, place), None):
        keep(page[place : found.start()])
        tag, place = found.group(), found.end()
        named = _NAME.match(tag)
        if not named:
            continue
        name = named.group(1).lower()
        if name in RAW:
            if tag[1] != "/" and not tag.endswith("/>"):
                close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, place)
                place = close.end() if close else n
            continue
        if name in SKIPPED:
            if tag[1] != "/" and not tag.endswith("/>"):
                ahead = re.compile(rf"<(/?){name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, place)
                following = _TOKEN.search(page, place)
                # These do not hold one another: another one ahead of the end means that this one was never closed.
                if ahead and ahead.group(1):
                    place = ahead.end()
                else:
                    place = following.start() if following else n
            continue
        if name == "br":
            keep(" ")
            continue
        if name in BLOCK:
            flush()
        if tag[1] == "/":
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is not None:
                for _, was_out, was_main in stack[depth:]:
                    out -= was_out
                    in_main -= was_main
                del stack[depth:]
        elif name not in VOID and not tag.endswith("/>"):
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                _, was_out, was_main = stack.pop()
                out -= was_out
                in_main -= was_main
            leaves = _named_out(name, tag, in_main > 0)
            marks = not leaves and (name in ("article", "main") or 'role="main"' in tag.lower())
            if marks and out:
                # Within, nothing of the wrapper counts, until the entry is taken off again.
                marks = wrapped and name in ("article", "main") and not any(_holds_no_article(e) for e in stack)
                leaves = -out if marks else 0
            articles += marks and name == "article" and not any(n == "article" and m for n, _, m in stack)
            stack.append((name, int(leaves), marks))
            out += leaves
            in_main += marks
            seen_main |= marks
    keep(page[place:])
    flush()
    return (_longest(main), True) if seen_main else (rest, False)


def _longest(main: list[tuple[int, str]]) -> list[str]:
    """The blocks of the page's article: of several, those that are not much shorter than the longest, as teasers are."""
    sizes: Counter[int] = Counter()
    for number, block in main:
        sizes[number] += len(block)
    most = max((n for number, n in sizes.items() if number), default=0)
    return [block for number, block in main if not number or sizes[number] >= LEAST_ARTICLE * most]


def _holds_no_article(entry: tuple[str, int, bool]) -> bool:
    """Whether an open element cannot wrap the page's article: a tag of its own, or comments and related articles."""
    return entry[1] > 0 and (entry[0] in OUT or entry[1] == STRONG)


def _heading_of_article(stack: list[tuple[str, int, bool]]) -> bool:
    """Whether the place is a heading in the header of the article itself."""
    names = [name for name, _, _ in stack]
    left = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][1] > 0)
    return names[left] == "header" and any(name in HEADINGS for name in names[left + 1 :])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sized_slices(batches, 2):
        found = [blocks(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([b for b, _ in found], pa.list_(pa.string())),
                pa.array([m for _, m in found], pa.bool_()),
            ],
            names=["page_id", "url", "blocks", "marked"],
        )


def runs(streams: list[list[str]]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]], np.ndarray]:
    """Hash of the run of RUN tokens at every place, hash of each page's stream, block of every place, its tokens.

    Places whose run would leave the page have the hash 0. Every block ends with a mark that is a token too, so a row of
    short blocks can make a run.
    """
    hashes, block, kinds, marks = [], [], [], []
    for p, stream in enumerate(streams):
        own = [t for text in stream for t in (*text.split(), "\n")]
        data, starts = text_bytes(pa.array(own, pa.string()))
        tokens = span_hashes(prefix_hashes(data), starts[:-1], starts[1:]) if len(own) else np.zeros(0, np.uint64)
        found = np.zeros(len(own), np.uint64)
        n = max(len(own) - RUN + 1, 0)
        run = np.zeros(n, np.uint64)
        for k in range(RUN):
            run = mix(run + np.uint64(1)) ^ tokens[k : k + n]
        found[:n] = np.maximum(mix(run), np.uint64(1))
        hashes.append(found)
        whole = np.uint64(len(own))
        weights = mix(np.arange(len(own), dtype=np.uint64) + np.uint64(1))
        kinds.append(mix(np.sum(tokens * weights, dtype=np.uint64) + whole))
        block += [(p, b) for b, text in enumerate(stream) for _ in range(len(text.split()) + 1)]
        marks.append(np.array([t == "\n" for t in own], bool))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(hashes, np.uint64), np.array(kinds, np.uint64), block, join(marks, bool)


def gone(streams: list[list[str]], shared: np.ndarray) -> list[list[bool]]:
    """For each page's blocks whether runs of the given hashes cover them whole."""
    hashes, _, block, marks = runs(streams)
    cover = np.zeros(len(hashes) + RUN + 1, np.int64)
    starts = np.flatnonzero(np.isin(hashes, shared) & (hashes != 0))
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + RUN, -1)
    covered = np.cumsum(cover)[: len(hashes)] > 0
    out = [[True] * len(s) for s in streams]
    for at in np.flatnonzero(~covered & ~marks):
        p, b = block[at]
        out[p][b] = False
    return out


def _host_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, run, kind) of the different runs of each page; run 0 counts the pages themselves."""
    for batch in batches:
        for host, stream in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            hashes, kinds, _, _ = runs([stream])
            own = np.unique(np.concatenate([np.zeros(1, np.uint64), hashes]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([host] * len(own), pa.string()), pa.array(own.view(np.int64)), pa.array(np.full(len(own), kinds[0]).view(np.int64))],
                names=["host", "run", "kind"],
            )


def _group_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for host, group, stream in zip(*(batch.column(k).to_pylist() for k in range(3))):
            own = np.unique(runs([stream])[0])
            own = own[own != 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([host] * len(own), pa.string()), pa.array([group] * len(own), pa.int64()), pa.array(own.view(np.int64))],
                names=["host", "group", "run"],
            )


def _drop_shared(key: tuple, pages_: pa.Table, shared: pa.Table) -> pa.Table:
    pages_ = pages_.sort_by("page_id")
    streams = pages_.column("blocks").to_pylist()
    flags = gone(streams, shared.column("run").to_numpy().view(np.uint64)) if len(streams) else []
    texts = ["\n\n".join(b for b, g in zip(s, f) if not g) for s, f in zip(streams, flags)]
    return pa.table({"page_id": pages_.column("page_id"), "url": pages_.column("url"), "text": pa.array(texts, pa.string())})


def _without_template(marked: DataFrame) -> DataFrame:
    """page_id, url and text of marked pages (page_id, url, host, blocks), without the blocks that the host puts in its articles."""
    articles = marked.where(F.size("blocks") > 0).select("host", "blocks", F.xxhash64("blocks").alias("kind"))
    held = articles.select("host", "kind", F.explode("blocks").alias("block"))
    held = held.select("host", "kind", F.xxhash64("block").alias("block")).distinct()
    distinct = articles.select("host", "kind").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    several = held.groupBy("host", "block").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES)
    shared = several.join(distinct, "host").where(F.col("n") > TEMPLATE * F.col("articles"))
    # Fewer than 1 / TEMPLATE times the blocks of a mean article for each host.
    known = stored(shared.groupBy("host").agg(F.collect_list("block").alias("gone")), "page-templates")
    left = F.filter("blocks", lambda b: ~F.array_contains("gone", F.xxhash64(b)))
    size = lambda blocks: F.length(F.array_join(blocks, ""))
    own = F.when(size(left) >= KEPT * size("blocks"), left)
    kept = marked.join(broadcast_if_small(known), "host", "left")
    return kept.select("page_id", "url", F.array_join(F.coalesce(own, "blocks"), "\n\n").alias("text"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page.

    Needs page_id, url and html; other columns are ignored. A null page has an empty text, repeated rows stay, pages of
    a null url make up a host, an empty table gives no rows.
    """
    needed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    read = stored(
        needed.mapInArrow(_read, "page_id long, url string, blocks array<string>, marked boolean"), "page-blocks"
    )
    host = F.coalesce(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), F.lit(""))
    marked = _without_template(read.filter("marked").withColumn("host", F.lower(host)))
    unmarked = read.filter("not marked").withColumn("host", F.lower(host))
    groups = unmarked.groupBy("host").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    dealt = unmarked.join(groups, "host").withColumn("group", F.pmod(F.xxhash64("page_id"), F.col("groups")))
    dealt = stored(dealt.select("host", "group", "page_id", "url", "blocks"), "page-groups")
    long = "host string, run long, kind long"
    held = dealt.select("host", "blocks").mapInArrow(_host_runs, long).distinct()
    # Different page streams that hold a run, over all groups of the host.
    counted = held.groupBy("host", "run").agg(F.count("*").alias("n"))
    several = stored(counted.filter((F.col("n") >= 2) | (F.col("run") == 0)), "page-runs")
    sizes = several.filter("run = 0").select("host", F.least(F.lit(PAGES), F.greatest(F.lit(2), "n")).alias("enough"))
    shared = several.filter("run <> 0").join(sizes, "host").filter(F.col("n") >= F.col("enough")).select("host", "run")
    # Each group gets those of its host's runs that its own pages hold.
    own = dealt.select("host", "group", "blocks").mapInArrow(_group_runs, "host string, group long, run long").distinct()
    shared = own.join(shared, ["host", "run"])
    judged = dealt.groupBy("host", "group").cogroup(shared.groupBy("host", "group")).applyInArrow(
        _drop_shared, "page_id long, url string, text string"
    )
    return marked.unionAll(judged)


def op2_html(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))
