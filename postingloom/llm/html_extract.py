"""Main text of web pages: structure first, then passages that many pages of a host repeat."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from itertools import chain
from itertools import compress as compress_by
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from postingloom.llm.common import BATCH_BYTES, SMALL, shipped, shuffles_removed, stored, stored_by, text_or_empty

#: Most pages of a chunk, and most characters of its words unless it is one page.
PAGES, CHARS = 2048, BATCH_BYTES

#: Elements whose content is never shown as text. Fixed values.
HIDDEN = frozenset("script style noscript template svg math iframe object canvas video audio head title select datalist".split())
#: Their content is raw up to the closing tag. Fixed values.
RAW = frozenset("script style noscript template iframe textarea title".split())
#: Elements around a page's main text. Fixed values.
CHROME = frozenset("nav header footer aside form menu dialog button textarea fieldset".split())
MAIN = frozenset("article main".split())
#: Marks of an article element that is not the page's own. Fixed values.
FOREIGN_WORDS = frozenset("comment comments reply replies related teaser promo ad ads advert advertisement sponsored".split())
#: Elements that end a run of text. Fixed values.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that mark menus, notices, adverts, comments and the like. Fixed values.
CHROME_WORDS = frozenset(
    "ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice"
    " notices alert newsletter subscribe subscription signup popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs"
    " sidebar aside widget related recommended recommendations share sharing social comment comments disqus reply replies respond"
    " footer header masthead toolbar pagination pager skip search login complementary contentinfo search searchbox".split()
)

#: Words of a name that say whose or what shape, beside a word of CHROME_WORDS. Fixed values.
SHAPE_WORDS = frozenset(
    "area articles bar block body bottom box btn button buttons col container content count entry form group icons inline inner item items"
    " left links list main media outer panel post posts reader right row section slot text thread top unit user users visitor wrap wrapper"
    .split()
)
#: Words of a name for what readers wrote. Fixed values.
READER_WORDS = frozenset("comment comments disqus discussion feedback replies reply respond responses".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ANY_ATTRIBUTE = re.compile(r"""([^\s"'=/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_MAY_HIDE = re.compile(r"hidden|display", re.I)
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_WORDS = re.compile(r"[a-z]+")
#: Words of a name like content-sidebar-wrap, which is laid around a page's main text. Fixed values.
WRAPPER_WORDS = frozenset("wrap wrapper container content layout page site main body with".split())
_ELSEWHERE = (["has"], ["no"], ["with"], ["is"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Inside an article a header holds its heading.
_ARTICLE_CHROME = (CHROME_WORDS | READER_WORDS) - {"header", "masthead"}
#: Chrome by its name or class around an article, a form or layout wrapper around it, and what is not shown at all.
_APART, _WRAPPER, _UNSEEN = 1, 2, 3


def _names(attributes: str) -> list[tuple[str, list[str]]]:
    """(attribute, words of the name) for each name in class, id and role."""
    found = []
    for attribute, *values in _ATTRIBUTE.findall(attributes):
        for name in "".join(values).split():
            found.append((attribute.lower(), _WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())))
    return found


def _marks(attributes: str) -> set[str]:
    """Words of class, id and role; a name like has-sidebar says what is elsewhere."""
    return {word for _, words in _names(attributes) if words[:1] not in _ELSEWHERE for word in words}


def _is_chrome_of_article(name: str, attributes: str) -> bool:
    """Whether an element inside an article is no part of it, by its whole names.

    A class or role counts if all its words do, so related-posts does and related-work doesn't. An id is
    the author's anchor and counts on no heading, and elsewhere only for what readers wrote."""
    for attribute, words in _names(attributes):
        kinds = READER_WORDS if attribute == "id" else _ARTICLE_CHROME
        if attribute == "id" and name in _HEADINGS or kinds.isdisjoint(words):
            continue
        if all(word in kinds or word in SHAPE_WORDS for word in words):
            return True
    return False


def _hides(attributes: str) -> bool:
    """Whether an attribute hides the element: hidden or aria-hidden by their whole name, display: none in a style."""
    if not _MAY_HIDE.search(attributes):
        return False
    for name, *values in _ANY_ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if (
            name == "hidden" and value.lower() != "false"
            or name == "aria-hidden" and value.strip().lower() == "true"
            or name == "style" and _NOT_SHOWN.search(value)
        ):
            return True
    return False


def _chrome(name: str, attributes: str, in_article: bool) -> int:
    """0 for an element that is no chrome, or how much it leaves out: itself only, or an article inside it as well."""
    if name in HIDDEN or attributes and name not in ("html", "body") and _hides(attributes):
        return _UNSEEN
    if name in CHROME and not (name == "header" and in_article):
        return _WRAPPER if name == "form" else _APART
    if not attributes or name in ("html", "body"):
        return 0
    marks = _marks(attributes)
    if name in MAIN:
        return 0 if FOREIGN_WORDS.isdisjoint(marks) else _APART
    if not _is_chrome_of_article(name, attributes) if in_article else CHROME_WORDS.isdisjoint(marks) and READER_WORDS.isdisjoint(marks):
        return 0
    return _WRAPPER if FOREIGN_WORDS.isdisjoint(marks) and not WRAPPER_WORDS.isdisjoint(marks) else _APART


def blocks(html: str) -> tuple[list[str], list[str]]:
    """Text blocks in page order: those of the article, and those outside it that are not chrome.

    An article is what article or main elements hold. Within it as without, hidden elements and chrome are
    left out, but an article's own header stays: it holds the heading. Elements that are never closed end with the one around them.

    An article or main inside chrome switches the text on again: always inside a form or a layout wrapper,
    and a main wherever it is. An article inside other chrome may be a teaser or a comment, so it
    counts where there is none that less chrome surrounds. Nothing inside a hidden element counts."""
    article, outside, _ = _blocks(html)
    return [text for _, text in article], [text for _, text in outside]


def _blocks(html: str) -> tuple[list[tuple[int, str]], list[tuple[int, str]], list[str]]:
    """The blocks of :func:`blocks`, each with its place among all shown blocks, and the latter, chrome included. Chrome inside
    a block follows it."""
    article: list[tuple[int, int, str]] = []  # how much chrome is around it, its place, and the block
    outside: list[tuple[int, str]] = []
    shown: list[str] = []
    run: list[str] = []
    chrome: list[str] = []
    open_tags: list[tuple[str, tuple[int, ...]]] = []  # name, and the counts around it
    # Depths of the open tags by name, and of those that are blocks: no closing tag walks what is open.
    depths: dict[str, list[int]] = {}
    open_blocks: list[int] = []
    # Chrome since the article began and what of it may hold teasers; such chrome around the article; hidden elements; articles.
    n_chrome = n_apart = n_around = n_unseen = n_main = 0
    at, end = 0, len(html)

    def flush() -> None:
        if run:
            text = " ".join(unescape("".join(run)).split())
            run.clear()
            if text:
                if n_main:
                    article.append((n_around, len(shown), text))
                else:
                    outside.append((len(shown), text))
                shown.append(text)
        if chrome:
            text = " ".join(unescape("".join(chrome)).split())
            chrome.clear()
            if text:
                shown.append(text)

    def leave(depth: int) -> None:
        nonlocal n_chrome, n_apart, n_around, n_unseen, n_main
        if len(open_tags) > depth:
            n_chrome, n_apart, n_around, n_unseen, n_main = open_tags[depth][1]
            while len(open_tags) > depth:
                depths[open_tags.pop()[0]].pop()
            while open_blocks and open_blocks[-1] >= depth:
                open_blocks.pop()

    while at < end:
        found = _TOKEN.search(html, at)
        stop = found.start() if found else end
        if stop > at and not n_unseen:
            (chrome if n_chrome else run).append(html[at:stop])
        if not found:
            break
        at = max(found.end(), stop + 1)
        if found.group(0).startswith("<![CDATA["):
            continue
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS or name in HIDDEN or name in CHROME:
            flush()
        if found.group(1):
            if depths.get(name):
                depth = depths[name][-1]
                # A stray closing tag of an inline element does not end the block around it.
                if name in BLOCKS or name in HIDDEN or not open_blocks or open_blocks[-1] <= depth:
                    leave(depth)
            continue
        attributes = found.group(3) or ""
        if name in VOID or attributes.endswith("/"):
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if (name == "p" or name == "li") and open_blocks and open_tags[open_blocks[-1]][0] == name:
            leave(open_blocks[-1])
        if name == "body" and depths.get("head"):
            leave(depths["head"][0])
        kind = _chrome(name, attributes, n_main > 0)
        depths.setdefault(name, []).append(len(open_tags))
        if name in BLOCKS:
            open_blocks.append(len(open_tags))
        open_tags.append((name, (n_chrome, n_apart, n_around, n_unseen, n_main)))
        if kind == _UNSEEN:
            n_unseen += 1
        elif kind:
            n_chrome += 1
            n_apart += kind == _APART
        elif name in MAIN:
            n_around += n_apart if n_main or name == "article" else 0
            n_chrome = n_apart = 0
            n_main += 1
    flush()
    nearest = min((around for around, _, _ in article), default=0)
    return [(at, text) for around, at, text in article if around == nearest], outside, shown


def stream(html: str) -> tuple[bool, list[str], list[tuple[int, int]]]:
    """Whether a page has an article, all its shown words in page order, chrome included, and the (start, number) of those that
    are its main text: the article, or without one what is no chrome."""
    article, outside, shown = _blocks(html)
    own = {at for at, _ in article or outside}
    words: list[str] = []
    spans: list[tuple[int, int]] = []
    for at, text in enumerate(shown):
        start = len(words)
        words += text.split(" ")
        if at in own:
            spans.append((start, len(words) - start))
    return bool(article), words, spans


def host_of(url: str | Column) -> Column:
    """Host of a url in lower case; empty where there is none."""
    given = F.col(url) if isinstance(url, str) else url
    return F.lower(F.regexp_extract(F.coalesce(given, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _stored_in_chunks(frame: DataFrame, html: bool) -> DataFrame:
    """The frame, stored with chunk, at (place in its chunk) and n_words; a column html becomes words, has_article and own.

    A chunk holds pages that one task read one after another, at most PAGES of them, and CHARS characters unless one page is longer.
    It lies in one bucket, so each step takes whole chunks as they lie and words are never shuffled."""

    def rows_in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, at, chars = TaskContext.get().partitionId() << 24, 0, 0
        for whole in batches:
            for first in range(0, whole.num_rows, PAGES):
                batch = whole.slice(first, PAGES)
                columns = {name: batch.column(name) for name in batch.schema.names}
                if html:
                    found = [stream(page.as_py()) for page in columns.pop("html")]
                    columns["words"] = pa.array([" ".join(words) for _, words, _ in found], pa.string())
                    columns["has_article"] = pa.array([has_article for has_article, _, _ in found], pa.bool_())
                    columns["own"] = pa.array([[n for span in own for n in span] for _, _, own in found], pa.list_(pa.int32()))
                chunks, places, numbers = [], [], []
                for words in columns["words"].to_pylist():
                    if at == PAGES or at and chars + len(words) > CHARS:
                        chunk, at, chars = chunk + 1, 0, 0
                    chunks.append(chunk)
                    places.append(at)
                    numbers.append(words.count(" ") + 1)
                    at, chars = at + 1, chars + len(words)
                columns |= {"chunk": pa.array(chunks, pa.int64()), "at": pa.array(places, pa.int32()), "n_words": pa.array(numbers, pa.int32())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = StructType([field for field in frame.schema if field.name != "html"])
    if html:
        schema = schema.add("words", "string").add("has_article", "boolean").add("own", ArrayType(IntegerType()))
    rows = frame.mapInArrow(rows_in_chunks, schema.add("chunk", "long").add("at", "integer").add("n_words", "integer"))
    if html:
        rows = rows.withColumn("page", F.xxhash64("host", "words"))
    return stored_by(rows, "chunk", "html-streams")


def _least_hashes(words: list[str], salts: np.ndarray, run: int) -> np.ndarray:
    """For each window of ``run`` words the least hash of the windows of two thirds as many words inside it."""
    inner = max(1, run - run // 3)
    n = len(words) - run + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(crc32, map(str.encode, words)), np.uint64, len(words))
    grams = salts[: len(words) - inner + 1].astype(np.uint64)
    for k in range(inner):
        grams = (grams ^ hashes[k : k + len(grams)]) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
    least = grams[:n].copy()
    for k in range(1, run - inner + 1):
        np.minimum(least, grams[k : k + n], out=least)
    return least


def window_marks(words: list[str], run: int, host: str | None = None) -> np.ndarray:
    """A mark for each window of ``run`` words: the least hash of the windows of two thirds as many words inside it.

    Equal windows of a host have equal marks, and neighbouring windows mostly share theirs, so a page has far fewer marks than words."""
    return _least_hashes(words, np.full(len(words), crc32((host or "").encode())), run).view(np.int64)


def _windows(texts: list[str], hosts: list[str | None], run: int, bits: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts, where each text begins among them, and of each window its text, its first word and its mark.

    A mark is cut to 32 bits and ``bits`` before them that tell its shard. Marks that fall together cost time only."""
    split = [text.split(" ") for text in texts]
    words = list(chain.from_iterable(split))
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    ends = np.cumsum(sizes)
    salts = np.repeat(np.fromiter((crc32((host or "").encode()) for host in hosts), np.uint64, len(hosts)), sizes)
    marks = _least_hashes(words, salts, run) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32 - bits)
    at = np.flatnonzero(np.arange(len(marks)) + run <= np.repeat(ends, sizes)[: len(marks)])
    return words, ends - sizes, np.repeat(np.arange(len(split)), sizes)[at], at, marks[at]


def _packed(marks: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending 32-bit marks as differences, byte by byte, and their counts."""
    steps = np.diff(marks, prepend=np.uint32(0)).astype("<u4")
    return compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes() + counts.astype(np.uint8).tobytes(), 1, -15)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(decompress(packed, -15), np.uint8).reshape(5, -1)
    return np.cumsum(np.ascontiguousarray(planes[:4].T).view("<u4").ravel(), dtype=np.uint32), planes[4]


def _marks_of(run: int, least: int, bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of a chunk and its first ones of equal pages: per shard the marks, each with the number of first pages it is on, at most ``least``."""

    def marks_of_chunk(rows: pa.Table, firsts: pa.Table) -> pa.Table:
        _, _, text, _, marks = _windows(rows["words"].to_pylist(), rows["host"].to_pylist(), run, bits)
        is_first = np.isin(rows["at"].to_numpy(), firsts["at"].to_numpy())
        order = np.lexsort((text, marks))
        text, marks = text[order], marks[order]
        new = np.ones(len(marks), bool)
        new[1:] = (marks[1:] != marks[:-1]) | (text[1:] != text[:-1])
        text, marks = text[new], marks[new]
        marks, begins = np.unique(marks, return_index=True)
        counts = np.minimum(np.add.reduceat(is_first[text].astype(np.int64), begins), least) if len(marks) else begins
        shards, cuts = np.unique(marks >> np.uint64(32), return_index=True)
        parts = [(m.astype(np.uint32), n) for m, n in zip(np.split(marks, cuts[1:]), np.split(counts, cuts[1:]))] if len(marks) else []
        chunk = rows["chunk"][0].as_py()
        return pa.table(
            {
                "shard": pa.array(shards.astype(np.int32), pa.int32()),
                "chunk": pa.array([chunk] * len(parts), pa.int64()),
                "marks": pa.array([_packed(m, n) for m, n in parts], pa.binary()),
            }
        )

    return marks_of_chunk


def _shared_of(least: int) -> Callable[[pa.Table], pa.Table]:
    """Of a shard: per chunk those of its marks that are on ``least`` pages in all."""

    def shared_of_shard(rows: pa.Table) -> pa.Table:
        shard = np.uint64(rows["shard"][0].as_py() << 32)
        found = [_unpacked(packed) for packed in rows["marks"].to_pylist()]
        marks, where = np.unique(np.concatenate([m for m, _ in found]), return_inverse=True)
        # Sums of whole numbers below 2**53 are exact in double precision.
        shared = marks[np.bincount(where, np.concatenate([n for _, n in found])) >= least]
        kept = [(m[np.isin(m, shared, assume_unique=True)] | shard).astype("<u8").tobytes() for m, _ in found]
        table = pa.table({"chunk": rows["chunk"], "marks": pa.array(kept, pa.binary())})
        return table.filter(pa.array([len(m) > 0 for m in kept], pa.bool_()))

    return shared_of_shard


def _suffixes_of(run: int, bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of a chunk, its first ones of equal pages and its shared marks: the distinct marked suffixes, each with a page (by chunk and at)
    and place that has it, and with the number of first pages it is on."""

    def suffixes_of_chunk(rows: pa.Table, told: pa.Table) -> pa.Table:
        hosts, numbers = rows["host"].to_pylist(), rows["at"].to_numpy()
        words, begins, text, at, marks = _windows(rows["words"].to_pylist(), hosts, run, bits)
        is_first = np.isin(numbers, told["at"].drop_null().to_numpy()).tolist()
        marked = np.isin(marks, np.frombuffer(b"".join(told["marks"].drop_null().to_pylist()), "<u8"))
        seen: dict[tuple[str | None, str], list[int]] = {}  # page and place that have it first, first pages, page that had it last
        for page, place in zip(text[marked].tolist(), at[marked].tolist()):
            suffix = hosts[page], " ".join(words[place : place + run])
            known = seen.get(suffix)
            if known is None:
                seen[suffix] = [page, place, int(is_first[page]), page]
            elif known[3] != page:
                known[2] += is_first[page]
                known[3] = page
        page, place, n, _ = np.array(list(seen.values()), np.int64).reshape(-1, 4).T
        return pa.table(
            {
                "host": pa.array([host for host, _ in seen], pa.string()),
                "prefix": pa.array([prefix for _, prefix in seen], pa.string()),
                "number": pa.array(rows["chunk"].to_numpy()[page] * PAGES + numbers[page], pa.int64()),
                "place": pa.array((place - begins[page]).astype(np.int32), pa.int32()),
                "n": pa.array(n, pa.int64()),
            }
        )

    return suffixes_of_chunk


def _repeats(rows: DataFrame, run: int, pages: int) -> DataFrame:
    """(chunk, at, place): for each distinct ``run`` words of a chunk that ``pages`` pages of the host have, a page and place that has them."""
    n_words = rows.agg(F.sum("n_words")).first()[0] or 0
    bits = min(24, max(4, (n_words >> 21).bit_length()))
    least = min(pages, 255)
    number = F.col("chunk") * PAGES + F.col("at")
    chunk_and_at = F.expr(f"number div {PAGES}").alias("chunk"), F.pmod("number", F.lit(PAGES)).cast("int").alias("at")
    firsts = rows.groupBy("page").agg(F.min(number).alias("number")).select(*chunk_and_at)
    chunks = rows.select("chunk", "at", "host", "words").groupBy("chunk")
    marks = chunks.cogroup(firsts.groupBy("chunk")).applyInArrow(_marks_of(run, least, bits), "shard int, chunk long, marks binary")
    shared = marks.groupBy("shard").applyInArrow(_shared_of(least), "chunk long, marks binary")
    told = firsts.withColumn("marks", F.lit(None).cast("binary")).unionByName(shared.withColumn("at", F.lit(None).cast("int")))
    kinds = "host string, prefix string, number long, place int, n long"
    suffixes = chunks.cogroup(told.groupBy("chunk")).applyInArrow(_suffixes_of(run, bits), kinds)
    # Stored, since rows dealt by range are made twice, first to find the bounds.
    with shuffles_removed(rows.sparkSession):
        array = stored(suffixes, "html-suffixes", **SMALL)
    array = array.repartitionByRange("host", "prefix").sortWithinPartitions("host", "prefix", "number")
    of_pages = F.sum("n").over(Window.partitionBy("host", "prefix"))
    return array.withColumn("of_pages", of_pages).where(F.col("of_pages") >= pages).select(*chunk_and_at, "place")


def _covered(rows: pa.Table, repeats: pa.Table, run: int) -> tuple[list[str], list[int], np.ndarray]:
    """All words of a chunk, where each page begins among them, and whether the chunk's repeats cover each word."""
    hosts, numbers = rows["host"].to_pylist(), rows["at"].to_numpy()
    words, begins, text, at, marks = _windows(rows["words"].to_pylist(), hosts, run, 8)
    edges = np.zeros(len(words) + 1, np.int64)
    if repeats.num_rows:
        order = np.argsort(numbers)
        pages = order[np.searchsorted(numbers, repeats["at"].to_numpy(), sorter=order)]
        places = begins[pages] + repeats["place"].to_numpy()
        known = {(hosts[page], " ".join(words[place : place + run])) for page, place in zip(pages.tolist(), places.tolist())}
        marked = np.isin(marks, marks[np.searchsorted(at, places)])
        for page, place in zip(text[marked].tolist(), at[marked].tolist()):
            if (hosts[page], " ".join(words[place : place + run])) in known:
                edges[place] += 1
                edges[place + run] -= 1
    return words, begins.tolist(), np.cumsum(edges[:-1]) > 0


def repeated_places(streams: DataFrame, run: int, pages: int) -> DataFrame:
    """(page, covered) from (page, host, words): word places that runs of ``run`` words or more, shared by ``pages`` pages of the host, cover.

    A suffix array of each host: the suffixes of all its pages are sorted, over range partitions, by host and their first ``run`` words.
    Neighbours that have at least ``run`` words in common thus have equal keys and lie in one partition, and no deeper order
    is needed: a longer run is covered by its overlapping beginnings. page is one for streams of equal words
    and host, so copies count once.

    Pages are looked at in chunks, and equal suffixes of a chunk are one row of the array that says on how many pages they are
    and where one is.
    A suffix enters the array only if its mark (:func:`window_marks`) is on ``pages`` pages. Any other begins
    no such run, since all places of a run have the same mark; so this leaves out no repeat. Marks go to their shards as
    differences, with a count for each chunk in place of the pages; the words of the pages stay where they are stored."""

    def covered_of_chunk(rows: pa.Table, repeats: pa.Table) -> pa.Table:
        _, begins, covered = _covered(rows, repeats, run)
        ends = [*begins[1:], len(covered)]
        places = [np.flatnonzero(covered[begin:end]).astype(np.int32) for begin, end in zip(begins, ends)]
        table = pa.table({"page": rows["page"], "covered": pa.array(places, pa.list_(pa.int32()))})
        return table.filter(pa.array([len(found) > 0 for found in places], pa.bool_()))

    given = streams.select("page", "host", text_or_empty("words").alias("words"))
    rows = _stored_in_chunks(given, html=False)
    schema = StructType([given.schema["page"]]).add("covered", ArrayType(IntegerType()))
    repeats = _repeats(rows, run, pages).groupBy("chunk")
    return rows.select("chunk", "at", "page", "host", "words").groupBy("chunk").cogroup(repeats).applyInArrow(covered_of_chunk, schema).dropDuplicates(["page"])


def main_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", run: int = 10, min_pages: int = 3
) -> DataFrame:
    """(page_id, url, text, n_chars, n_repeated), one row per row of ``pages``.

    The suffix array of each host (:func:`repeated_places`) is made of all shown words of all its pages, menus and articles included; n_repeated
    is the number of a page's words that repeated runs cover. A page with an article or main element gives the blocks
    of that, whole, whatever other pages repeat. Other pages give the blocks that are not chrome, without the words that runs of
    ``run`` words or more on ``min_pages`` pages of the host cover. Null or empty html gives an empty text; a null url
    is a host of its own; page_id is passed through, null or repeated. Only these three
    columns are read, so further ones may have any name. No rows give no rows."""

    def text_of_chunk(rows: pa.Table, repeats: pa.Table) -> pa.Table:
        words, begins, covered = _covered(rows, repeats, run)
        ends = [*begins[1:], len(words)]
        texts = []
        for begin, has_article, own in zip(begins, rows["has_article"].to_pylist(), rows["own"].to_pylist()):
            kept: list[str] = []
            for start, n in zip(own[::2], own[1::2]):
                at = slice(begin + start, begin + start + n)
                kept += words[at] if has_article else compress_by(words[at], ~covered[at])
            texts.append(" ".join(kept))
        n_repeated = [int(np.count_nonzero(covered[begin:end])) for begin, end in zip(begins, ends)]
        return pa.table(
            {"page_id": rows["page_id"], "url": rows["url"], "text": pa.array(texts, pa.string()), "n_repeated": pa.array(n_repeated, pa.int64())}
        )

    read = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(url).alias("host"), text_or_empty(html).alias("html")
    )
    rows = _stored_in_chunks(read, html=True)
    # Stored as well, so that the array's shuffle is gone before the texts are made.
    with shuffles_removed(pages.sparkSession):
        repeats = stored(_repeats(rows, run, min_pages), "html-repeats", **SMALL).groupBy("chunk")
    schema = StructType([read.schema["page_id"], read.schema["url"]]).add("text", "string").add("n_repeated", "long")
    found = rows.drop("page", "n_words").groupBy("chunk").cogroup(repeats).applyInArrow(text_of_chunk, schema)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")


shipped(__name__)
