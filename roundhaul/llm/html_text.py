"""Main text of web pages: host suffix arrays for what repeats, the page's own marks for its article.

A page is read into blocks of text, each marked by the elements around it: part of an article,
part of a page's frame (menus, headers, footers, side bars, notices, adverts, forms, comments),
or open. A class or id makes a frame if it names nothing else (`site-header`, not `has-sidebar`), and an
article or main part inside such a container, or in a form, is no part of the frame; around cards, replies
and adverts it is. Inside an article whole class names of containers count, not ids. The token streams of a host's pages are put one after another and their suffixes
sorted by the first `run_words` tokens; a run of that many tokens that stands on two distinct
pages covers its tokens as boilerplate, longer repeats are covered by the runs in them. Covered
tokens are cut out of open blocks and the unique runs stay, also beside an article. What a page
itself marks settles the rest: its article (or else its main part) is kept even where other pages
repeat it, its frame is dropped even where it is unique.

Hosts with more than `bucket_pages` pages are dealt into buckets of about that many, so that no
host's pages meet in one task. Runs of such a host that touch an open block are counted over all
its pages and the repeated ones are sent back to the buckets that hold them, so what counts as
repeated doesn't depend on the host's size. Where no large host has open blocks, nothing is counted.

NULL and empty pages have the empty text. A page without a host is grouped with others without
one. Unclosed elements, comments and scripts end with the page, unclosed pictures and players with the
block around them. Repeated rows of a page_id are one page: what they share is no repeat; rows without
a page_id are told apart by their html. Whole pages are read.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhaul.llm.common import mix64, reachable
from roundhaul.llm.hashing import range_hashes

RUN_WORDS = 8
#: Pages of a bucket, and bytes of their html, on average; larger hosts are dealt into several.
BUCKET_PAGES, BUCKET_BYTES = 256, 64 * 1024**2
#: Hosts whose page counts are sent to every task, at most; with more of them, they are joined.
SENT_HOSTS = 100_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?][^>]*+>"
    r"|(?P<text>[^<]++|<)",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([a-z:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
NAME_PARTS = re.compile(r"[a-z]+|[0-9]+")

# Element names of HTML by their part in a page.
BLOCK = frozenset(
    "address article aside blockquote body center caption dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
HELD = frozenset(
    "address article aside blockquote body button details dialog div dl fieldset figure footer form head header html "
    "label li main menu nav ol section span table td tr ul".split()
)
FRAME_ELEMENTS = frozenset("nav footer aside form button menu dialog head header fieldset label".split())
FRAME_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar".split())
#: Elements whose content is no text of the page. Where they aren't closed, the first last to the page's end, the second
#: to the end of the block around them.
RAW = frozenset("script style template textarea title".split())
EMBEDDED = frozenset("noscript svg iframe select object canvas video audio".split())
#: Words of a class or an id that name a part of the frame.
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices popup modal overlay sidebar side widget menu navbar nav navigation breadcrumb breadcrumbs footer "
    "masthead topbar header comment comments disqus replies share sharing social related recommended newsletter subscribe "
    "subscription signup login search pagination pager toolbar form".split()
)
#: Those of them that frame whole articles, such as cards and replies.
CARD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar widget comment comments disqus "
    "replies related recommended".split()
)
#: Words that may stand beside them in one name without another meaning.
BESIDE = frozenset(
    "site page main global top bottom left right primary secondary box bar slot unit item items list links block section area "
    "container posts articles stories".split()
)
#: Elements that can't hold a block: where they aren't closed, the next block ends them.
LINES = frozenset("p h1 h2 h3 h4 h5 h6 dt summary caption legend".split())
ARTICLE_WORDS = frozenset("article post story entry".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

ARTICLE, MAIN, OPEN, FRAME = 0, 1, 2, 3
#: Frames that an article in them is no part of: by their name, and forms, which may hold a whole page.
NAMED, FORM = 4, 5


def _frame_words(token: str) -> set[str]:
    """The frame words of a class or an id, if it says nothing else: `site-header`, but not `has-sidebar`."""
    parts = set(NAME_PARTS.findall(token))
    found = parts & FRAME_WORDS
    return found if all(part in FRAME_WORDS or part in BESIDE or part.isdigit() for part in parts) else set()


def _mark(name: str, attrs: str, inside: int) -> int:
    """The part that an element opens, given the one it stands in."""
    if inside == FRAME:
        return FRAME
    found = {m[0].lower(): m[1].strip("\"'").lower() for m in ATTRIBUTE.findall(attrs)} if attrs.strip() else {}
    role, classes = found.get("role"), found.get("class", "").split()
    form = name == "form" or role == "form"
    if name in FRAME_ELEMENTS and not form and not (name == "header" and inside == ARTICLE):
        return FRAME
    if "hidden" in found or role in FRAME_ROLES and not form or form and inside == ARTICLE:
        return FRAME
    if name in ("article", "main") or role in ("article", "main"):
        if any(n == "comments" or NAME_PARTS.findall(n)[:1] == ["comment"] for n in classes):
            return FRAME
        return ARTICLE if inside == ARTICLE or "article" in (name, role) else MAIN
    if name in LINES:
        framing = set() if inside == ARTICLE else FRAME_WORDS.intersection(classes)
        return FRAME if framing else inside
    if inside == ARTICLE:
        return FRAME if FRAME_WORDS.intersection(classes) else ARTICLE
    if name not in ("html", "body"):
        framing = {word for token in (*classes, found.get("id", "")) for word in _frame_words(token)}
        if framing:
            return FRAME if framing & CARD_WORDS else NAMED
    if form:
        return FORM if inside == OPEN else inside
    words = {part for token in (*classes, found.get("id", "")) for part in NAME_PARTS.findall(token)}
    return MAIN if inside in (OPEN, FORM) and words & ARTICLE_WORDS else inside


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(part, text) of the page's blocks in order; white space in a block is one space, none at its ends."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    ends: dict[str, list[int]] = {}
    part, at = OPEN, 0

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append((part, text))
        held.clear()

    def closed(name: str) -> int:
        """Where the element that just began is closed; -1 if nowhere."""
        if name not in ends:
            ends[name] = [m.end() for m in re.finditer(rf"</{name}\s*>", page, re.IGNORECASE)]
        place = bisect_left(ends[name], at + 1)
        return ends[name][place] if place < len(ends[name]) else -1

    while at < len(page):
        match = TOKEN.match(page, at)
        at = match.end()
        text = match["text"]
        if text is not None:
            held.append(html.unescape(text))
            continue
        name, opens = (match["name"] or "").lower(), not match["close"]
        if opens and (name in RAW or name in EMBEDDED):
            if name in EMBEDDED and match["attrs"].rstrip().endswith("/"):
                continue
            end = closed(name)
            if end >= 0:
                at = end
            elif name in RAW:
                break
            else:
                flush()
                stack.append((name, part))
                part = FRAME
            continue
        if name in ("br", "wbr"):
            held.append(" " if name == "br" else "")
        if name in BLOCK:
            flush()
            while stack and stack[-1][0] in EMBEDDED:
                part = stack.pop()[1]
            if opens and stack and stack[-1][0] in LINES:
                part = stack.pop()[1]
        if name in HELD and name not in VOID:
            if opens:
                inner = _mark(name, match["attrs"], part)
                if inner != part:
                    flush()
                stack.append((name, part))
                part = inner
            elif any(name == open_name for open_name, _ in stack):
                flush_part = part
                while stack:
                    open_name, outer = stack.pop()
                    flush_part = outer
                    if open_name == name:
                        break
                if flush_part != part:
                    flush()
                    part = flush_part
        elif name and opens and name not in VOID and name in BLOCK and match["attrs"].strip():
            # A paragraph or heading that names itself part of the frame: it lasts to its end tag or the next block.
            if _mark(name, match["attrs"], part) == FRAME and part != FRAME:
                stack.append((name, part))
                part = FRAME
        elif not opens and stack and stack[-1][0] == name:
            flush()
            part = stack.pop()[1]
    flush()
    return out


def main_parts(blocks: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The blocks with the page's best mark kept as ARTICLE, its frame as FRAME, all others as OPEN.

    A form on a page without an article or main part is open if it holds most of what is open.
    """
    size = Counter()
    for part, text in blocks:
        size[part] += len(text)
    best = ARTICLE if size[ARTICLE] else MAIN
    whole_page = not size[best] and size[FORM] > size[OPEN]
    kinds = {best: ARTICLE, FRAME: FRAME, NAMED: FRAME, FORM: OPEN if whole_page else FRAME}
    return [(kinds.get(part, OPEN), text) for part, text in blocks]


def repeated_tokens(tokens: np.ndarray, page: np.ndarray, length: int) -> np.ndarray:
    """Which tokens lie in a run of `length` tokens that stands on two distinct pages.

    `page` ascends. Suffixes are sorted by their first `length` tokens, by prefix doubling.
    """
    covered = np.zeros(len(tokens), bool)
    if len(tokens) < length:
        return covered
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while width < length:
        step = min(width, length - width)
        after = np.zeros_like(rank)
        after[:-step] = np.where(page[step:] == page[:-step], rank[step:], 0)  # a suffix ends with its page
        rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        width += step
    whole = np.zeros(len(tokens), bool)
    whole[: len(tokens) - length + 1] = page[length - 1 :] == page[: len(tokens) - length + 1]
    starts = np.flatnonzero(whole)
    order = starts[np.argsort(rank[starts], kind="stable")]  # equal runs side by side, by page
    ranks, pages = rank[order], page[order]
    edge = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])) if len(order) else order
    last = np.append(edge[1:], len(order)) - 1
    several = pages[edge] != pages[last] if len(order) else np.zeros(0, bool)
    hits = order[np.repeat(several, last - edge + 1)]
    return spread(hits, length, len(tokens))


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of texts, one after another, and how many each text has."""
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    space = np.flatnonzero(data == 32)
    starts, ends = np.append(0, space + 1), np.append(space, len(data))
    return range_hashes(data, starts, ends), np.array([text.count(" ") + 1 for text in texts], np.int64)


def run_hashes(tokens: np.ndarray, page: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of `length` tokens within a page start, and a hash of each."""
    if len(tokens) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(page[length - 1 :] == page[: len(tokens) - length + 1])
    sums = np.zeros(len(starts), np.uint64)
    for i, factor in enumerate(mix64(np.arange(1, length + 1, dtype=np.uint64)) | np.uint64(1)):
        sums += tokens[starts + i] * factor
    return starts, mix64(sums)


def spread(starts: np.ndarray, length: int, count: int) -> np.ndarray:
    """Which of `count` tokens lie in the runs of `length` tokens at `starts`."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0


def of_host(runs: np.ndarray, host: str) -> np.ndarray:
    """The hashes of runs on a host."""
    return mix64(runs ^ np.frombuffer(hashlib.blake2b(host.encode(), digest_size=8).digest(), np.uint64))


def main_texts(
    pages: list[list[tuple[int, str]]], identity: list, run_words: int, host: str = "", repeated: np.ndarray | None = None
) -> list[str]:
    """The main text of each page of one host; pages of one identity are one page.

    `repeated` has the hashes of runs that are known to repeat on the host.
    """
    texts = [text for blocks in pages for _, text in blocks]
    parts = np.array([part for blocks in pages for part, _ in blocks], np.int64)
    number = {key: i for i, key in enumerate(dict.fromkeys(identity))}
    order = sorted(range(len(pages)), key=lambda i: number[identity[i]])
    if order != list(range(len(pages))):
        found = main_texts([pages[i] for i in order], [identity[i] for i in order], run_words, host, repeated)
        return [text for _, text in sorted(zip(order, found, strict=True))]
    owner = np.repeat([number[key] for key in identity], [len(blocks) for blocks in pages])
    if not texts:
        return [""] * len(pages)
    tokens, counts = token_hashes(texts)
    block = np.repeat(np.arange(len(texts)), counts)
    covered = repeated_tokens(tokens, owner[block], run_words)
    if repeated is not None and len(repeated):
        begins, runs = run_hashes(tokens, np.repeat(np.arange(len(pages)), list(map(len, pages)))[block], run_words)
        covered |= spread(begins[np.isin(of_host(runs, host), repeated)], run_words, len(tokens))
    dirty = np.bincount(block, covered, len(texts)) > 0
    first = np.append(0, np.cumsum(counts))
    out, at = [], 0
    for blocks in pages:
        kept = []
        for part, text in blocks:
            if part == ARTICLE or part == OPEN and not dirty[at]:
                kept.append(text)
            elif part == OPEN:
                words, gone = text.split(" "), covered[first[at] : first[at + 1]]
                run = " ".join(word for word, cut in zip(words, gone.tolist(), strict=True) if not cut)
                kept.extend([run] if run else [])
            at += 1
        out.append("\n".join(kept))
    return out


def parsed(pages: pa.Array) -> list[list[tuple[int, str]]]:
    return [main_parts(blocks_of(page or "")) for page in pages.to_pylist()]


def hosts_asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hosts with open blocks, of (host, html)."""
    for batch in batches:
        found = set()
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            for host, blocks in zip(part.column(0).to_pylist(), parsed(part.column(1)), strict=True):
                if any(kind == OPEN for kind, _ in blocks):
                    found.add(host)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["host"])


def page_runs(length: int, touching_open: bool):
    """A function from (host, html, owner) to (run, owner) for all runs, or for those that touch an open block."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 50):
                part = batch.slice(start, 50)
                runs, owners = [], []
                rows = zip(part.column(0).to_pylist(), parsed(part.column(1)), part.column(2).to_pylist(), strict=True)
                for host, blocks, owner in rows:
                    if not blocks or touching_open and all(kind != OPEN for kind, _ in blocks):
                        continue
                    tokens, counts = token_hashes([text for _, text in blocks])
                    begins, hashes = run_hashes(tokens, np.zeros(len(tokens), np.int8), length)
                    if touching_open:
                        open_tokens = np.repeat([kind == OPEN for kind, _ in blocks], counts)
                        seen = np.append(0, np.cumsum(open_tokens))
                        hashes = hashes[seen[begins + length] > seen[begins]]
                    runs.append(np.unique(of_host(hashes, host)))
                    owners.append(np.full(len(runs[-1]), owner, np.int64))
                if runs:
                    columns = [np.concatenate(runs).view(np.int64), np.concatenate(owners)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["run", "owner"])

    return listed


def repeats(asked: DataFrame, run_words: int) -> DataFrame:
    """place and run for each run of (page_id, html, host, place) that touches an open block and stands on two pages of its host."""
    runs = asked.select("host", "html", "owner")
    runs = runs.mapInArrow(page_runs(run_words, False), "run long, owner long")
    runs = runs.groupBy("run").agg(F.min("owner").alias("least"), F.max("owner").alias("most"))
    asks = asked.select("host", "html", "place").mapInArrow(page_runs(run_words, True), "run long, place long").distinct()
    return asks.join(runs.where("least <> most").select("run"), "run").select("place", "run")


def extract(pages: DataFrame, run_words: int = RUN_WORDS, bucket_pages: int = BUCKET_PAGES) -> DataFrame:
    """page_id, url, text and n_chars for each row of (page_id, url, html)."""
    reachable(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    # What tells pages apart: the id, or the html where there is none.
    owner = F.when(F.col("page_id").isNotNull(), F.xxhash64("page_id")).otherwise(F.xxhash64(F.lit("html"), "html"))
    given = pages.select("page_id", "url", "html", host.alias("host"), owner.alias("owner"))
    parts = F.greatest(F.ceil(F.count("*") / bucket_pages), F.ceil(F.sum(F.octet_length("html")) / BUCKET_BYTES))
    large = given.groupBy("host").agg(parts.alias("n")).where(F.col("n") > 1)
    n_large = large.limit(SENT_HOSTS + 1).count()
    if n_large <= SENT_HOSTS:
        large = F.broadcast(large)
    bucket = F.pmod("owner", F.coalesce("n", F.lit(1)))
    dealt = given.join(large, "host", "left").select("page_id", "url", "html", "host", "owner", bucket.alias("bucket"), "n")
    asking = []
    if n_large:
        asking = given.join(large, "host").select("host", "html").mapInArrow(hosts_asking, "host string")
        asking = asking.distinct().limit(SENT_HOSTS + 1).collect()
    kind = pages.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                rows = parsed(part.column(2))
                columns = [part.column(name) for name in ("page_id", "url", "host", "owner", "bucket")]
                parts = pa.array([[p for p, _ in row] for row in rows], pa.list_(pa.int8()))
                texts = pa.array([[t for _, t in row] for row in rows], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*columns, parts, texts], ["page_id", "url", "host", "owner", "bucket", "parts", "texts"]
                )

    schema = f"page_id {kind}, url string, host string, owner long, bucket long, parts array<tinyint>, texts array<string>"
    blocks = dealt.drop("n").mapInArrow(read, schema)

    def joined(table: pa.Table, repeated: np.ndarray | None = None) -> pa.Table:
        rows = zip(table.column("parts").to_pylist(), table.column("texts").to_pylist(), strict=True)
        held = [list(zip(parts, texts, strict=True)) for parts, texts in rows]
        texts = main_texts(held, table.column("owner").to_pylist(), run_words, table.column("host")[0].as_py(), repeated)
        sizes = pa.array([len(text) for text in texts], pa.int64())
        return pa.table([table.column("page_id"), table.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    out = f"page_id {kind}, url string, text string, n_chars long"
    if not asking:
        return blocks.groupBy("host", "bucket").applyInArrow(lambda table: joined(table), out)

    def answered(table: pa.Table, answers: pa.Table) -> pa.Table:
        repeated = answers.column("run").to_numpy().view(np.uint64)
        keys = ["host", "bucket"]
        groups = table.select(keys).group_by(keys).aggregate([]).to_pylist()  # one, unless two have the same place
        alone = [table.filter((pc.field("host") == g["host"]) & (pc.field("bucket") == g["bucket"])) for g in groups]
        return pa.concat_tables([joined(part, repeated) for part in alone])

    place = F.xxhash64("host", "bucket")
    if len(asking) > SENT_HOSTS:
        asked = dealt.where("n > 1")
    else:
        asked = dealt.join(F.broadcast(pages.sparkSession.createDataFrame(asking, "host string")), "host")
    answers = repeats(asked.withColumn("place", place), run_words)
    placed = blocks.withColumn("place", place)
    return placed.groupBy("place").cogroup(answers.groupBy("place")).applyInArrow(answered, out)
