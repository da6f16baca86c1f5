"""Main text of web pages: structural rules, then a suffix array over each host.

Structure.  One pass over the tags drops scripts, styles, navigation, forms,
footers and the like by element, and adverts, notices, sidebars, comments and
others whose role, class or id says so, and takes what stands inside ``article``
(else ``main``, else the body).  A name counts only as a whole: every part of it
must mark boilerplate or be a neutral word such as ``box``.  Block elements part
blocks; character references are decoded.

Host suffix array.  The token streams of a host's pages are laid end to end,
each closed by its own mark.  Suffixes are ranked by prefix doubling up to
``min_tokens`` tokens - all that telling long repeats from unique text needs -
and equal ranks are counted over distinct pages.  Hosts over ``shard_pages`` pages
are dealt into shards by page hash, so no host has to fit a task, and the counts of
a substring are summed over all shards of its host in which ``share_in_body / 2`` of
the pages hold it.  What stands on ``min_pages`` pages and a share of the host's is
boilerplate: ``share_in_article`` where an ``article`` or ``main`` element says what
the main text is, ``share_in_body`` where nothing does.  Tokens that it covers go;
unique runs stay.  A page without a unique run of ``min_tokens`` is a copy of
others and stays whole, and so does an article most of which would go.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own; unclosed elements end with what holds them, unclosed comments, scripts
and tags with the page; a stray quote is part of its tag; repeated rows each count
as a page; texts are never cut; extra columns are not carried.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm import textbatch as tb
from skytrace.llm.common import materialise, prepare


@dataclass(frozen=True)
class HtmlParams:
    min_tokens: int = 8
    min_pages: int = 4
    share_in_article: float = 0.5
    share_in_body: float = 0.1
    shard_pages: int = 256
    #: Pages that a task which ranks shards has in hand, about; tasks grow in number with the input, not in size (layout only).
    task_pages: int = 2048
    #: Boilerplate substrings that are broadcast, at most; beyond that pages are joined with their host's (layout only).
    broadcast_rows: int = 2_000_000


TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.DOTALL)

#: Elements whose content is not markup.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
DROPPED = RAW | {"nav", "aside", "form", "footer", "noscript", "template", "iframe", "svg", "math", "button", "select", "object", "canvas", "dialog", "menu", "head", "audio", "video", "map", "datalist"}
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class or id that mark boilerplate, and words that may stand beside them.
UNWANTED = set("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent gdpr notice newsletter signup subscribe comment comments disqus sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead share sharing pagination pager popup modal".split())
NEUTRAL = set("site page main top bottom left right box bar list item block area container wrapper wrap inner outer section panel slot unit widget group form message overlay button buttons links link text content body header js".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")


def marks(token: str) -> bool:
    """Whether a class or id, as a whole, marks boilerplate."""
    parts = [p for p in re.split(r"[^a-z]+", token) if p]
    return not UNWANTED.isdisjoint(parts) and all(p in UNWANTED or p in NEUTRAL for p in parts)


def unwanted(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element and all in it are no part of the main text."""
    if name in DROPPED or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key in ("class", "id"):
            if any(marks(x) for x in value.split()):
                return True
        elif key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def blocks(page: str) -> list[str]:
    return main_blocks(page)[0]


def main_blocks(page: str) -> tuple[list[str], bool]:
    """Blocks of the main text, white space collapsed, and whether an element names it as such."""
    kept: dict[str, list[str]] = {"article": [], "main": [], "body": []}
    depth = {"article": 0, "main": 0}
    skip, nested = "", 0
    parts: list[str] = []
    where = "body"
    at = 0

    def close() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                kept[where].append(text)
            parts.clear()

    while True:
        m = TAG.search(page, at)
        if not skip:
            piece = page[at : m.start() if m else len(page)]
            if piece:
                parts.append(entities.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        ends = bool(m[1])
        if skip:
            if name == skip:
                nested += -1 if ends else name not in VOID
                if nested == 0:
                    skip = ""
                continue
            # what was never closed ends where the article or the page body does
            if not (name in ("article", "main") and (not ends or depth[name]) and skip not in ("article", "main")) and not (name == "body" and (ends or skip == "head")):
                continue
            skip = ""
        if name in BLOCKS:
            close()
        if not ends and unwanted(name, m[3], depth["article"] + depth["main"] > 0) and name not in VOID:
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}[\s/>]|</{re.escape(name)}\Z", re.IGNORECASE).search(page, at)
                stop = page.find(">", end.start()) if end else -1
                at = stop + 1 if stop >= 0 else len(page)
            else:
                close()
                skip, nested = name, 1
            continue
        if name in depth:
            depth[name] = max(depth[name] + (-1 if ends else 1), 0)
            where = "article" if depth["article"] else "main" if depth["main"] else "body"
    close()
    named = kept["article"] or kept["main"]
    return named or kept["body"], bool(named)


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, and where each text's begin (one more at the end)."""
    data, off = tb.utf8(pa.array(texts, pa.large_string()))
    starts, ends = tb.runs(data != 32, off)
    return tb.hash_spans(data, starts, ends - starts, seed=4), np.searchsorted(starts, off)


def repeats(streams: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``length``-token substrings of the streams, by suffix rank, and on how many streams each stands."""
    lens = np.array([len(s) for s in streams], np.int64)
    if not len(lens) or lens.max() < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    flat = np.concatenate(streams)
    _, ids = np.unique(flat, return_inverse=True)
    page = np.repeat(np.arange(len(streams)), lens + 1)
    rank = np.full(len(page), -1, np.int64)
    ends = np.cumsum(lens + 1) - 1
    marks_ = np.zeros(len(page), bool)
    marks_[ends] = True
    rank[~marks_] = ids
    rank[ends] = ids.max() + 1 + np.arange(len(ends))  # closing marks are all different
    width = 1
    while width < length:
        step = min(width, length - width)
        after = np.full(len(rank), -1, np.int64)
        after[: len(rank) - step] = rank[step:]
        _, rank = np.unique(rank * (len(page) + 1) + after + 1, return_inverse=True)
        width += step
    whole = np.ones(len(rank), bool)  # suffixes with enough tokens before their page's mark
    for k in range(length):
        whole[np.maximum(ends - k, 0)] = False
    at = np.flatnonzero(whole)
    pairs = np.unique(rank[at] * len(streams) + page[at])
    found, pages = np.unique(pairs // len(streams), return_counts=True)
    some = np.empty(rank.max() + 1, np.int64)
    some[rank[at]] = at
    place = some[found]
    return window_hashes(flat, place - page[place], length), pages


def window_hashes(tokens: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(begin), np.uint64)
    for k in range(length):
        out = tb.mix(out * tb.M1 + tokens[begin + k])
    return out


def host_key(hosts: list[str]) -> np.ndarray:
    data, off = tb.utf8(pa.array(hosts, pa.large_string()))
    return tb.hash_spans(data, off[:-1], np.diff(off), seed=6)


def without(text: str, named: bool, hit: np.ndarray, params: HtmlParams) -> str:
    """``text`` without the tokens that its repeated substrings, at the places ``hit``, cover."""
    words = text.split(" ")
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + params.min_tokens, -1)
    cover = np.cumsum(edge)[:-1] > 0
    starts, ends = tb.runs(~cover, np.array([0, len(cover)]))
    if not (ends - starts >= params.min_tokens).any() or named and 2 * cover.sum() > len(cover):
        return text
    return " ".join(w for w, c in zip(words, cover.tolist()) if not c)


def cleaned(pages: list[tuple[list[str], bool]], hosts: list[str], keys: np.ndarray, strict: np.ndarray, params: HtmlParams) -> list[str]:
    """Texts of pages without their host's boilerplate: ``keys`` are its substrings, in order, ``strict`` those that go from articles too."""
    texts = [" ".join(b) for b, _ in pages]
    if not len(keys) or not texts:
        return texts
    hashes, first = token_hashes(texts)
    host = host_key(hosts)
    for i, (a, z) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if z - a < params.min_tokens:
            continue
        own = tb.mix(window_hashes(hashes, np.arange(a, z - params.min_tokens + 1), params.min_tokens) ^ host[i])
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        hit = (keys[at] == own) & (strict[at] | (not pages[i][1]))
        if hit.any():
            texts[i] = without(texts[i], pages[i][1], np.flatnonzero(hit), params)
    return texts


def boilerplate(rows: DataFrame, params: HtmlParams) -> DataFrame:
    """(host, key, strict): substrings that are boilerplate on their host, and whether they are inside articles too."""
    sizes = materialise(rows.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= params.min_pages), "hosts")
    total = sizes.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]  # one value
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // params.task_pages))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in tb.slices(batches, "html", 4 << 20):
            text = [" ".join(blocks(h or "")) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.large_string())], names=["page_id", "host", "text"])

    parsed = rows.join(sizes.select("host"), "host", "left_semi").select("page_id", "host", "html").mapInArrow(parse, "page_id long, host string, text string")
    large = sizes.where(F.col("pages") > params.shard_pages)
    shards = F.coalesce(F.ceil(F.col("pages") / params.shard_pages), F.lit(1))
    dealt = parsed.join(large, "host", "left").withColumn("shard", F.pmod(F.xxhash64("page_id", "text"), shards)).select("host", "shard", "text")

    def count(group: pa.Table) -> pa.Table:
        hashes, first = token_hashes(group.column("text").to_pylist())
        found, pages = repeats([hashes[a:b] for a, b in zip(first, first[1:])], params.min_tokens)
        often = (pages >= 2) & (pages >= params.share_in_body / 2 * group.num_rows)
        host = group.column("host")[0].as_py()
        key = tb.mix(found[often] ^ host_key([host])[0])
        return pa.table({"host": pa.array([host] * len(key), pa.string()), "key": pa.array(key.view(np.int64)), "n": pa.array(pages[often])})

    counts = dealt.repartition(tasks, "host", "shard").groupBy("host", "shard").applyInArrow(count, "host string, key long, n long").groupBy("host", "key").agg(F.sum("n").alias("n"))
    least = lambda share: F.greatest(F.lit(params.min_pages), F.ceil(F.col("pages") * share))
    found = counts.join(sizes, "host").where(F.col("n") >= least(params.share_in_body))
    return materialise(found.select("host", "key", (F.col("n") >= least(params.share_in_article)).alias("strict")), "boilerplate")


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame, params: HtmlParams = HtmlParams()) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    prepare(spark)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html")
    found = boilerplate(rows, params)

    def tidy(batch: pa.RecordBatch, keys: np.ndarray, strict: np.ndarray) -> pa.RecordBatch:
        main = [main_blocks(h or "") for h in batch.column(3).to_pylist()]
        texts = cleaned(main, batch.column(2).to_pylist(), keys, strict, params)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.large_string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    if found.count() <= params.broadcast_rows:
        table = found.select("key", "strict").toArrow()
        key = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        shared = spark.sparkContext.broadcast((key[order], table.column("strict").to_numpy()[order].astype(bool)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, _, _ in tb.slices(batches, "html", 4 << 20):
                yield tidy(batch, *shared.value)

        return rows.mapInArrow(run, EXTRACTED)

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in tb.slices(batches, "html", 4 << 20):
            entries = {(e["key"], e["strict"]) for x in dict(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())).values() for e in x or []}
            key = np.array([k for k, _ in entries], np.int64).view(np.uint64)
            order = np.argsort(key)
            yield tidy(batch, key[order], np.array([s for _, s in entries], bool)[order])

    by_host = found.groupBy("host").agg(F.collect_list(F.struct("key", "strict")).alias("entries"))
    return rows.join(by_host, "host", "left").select("page_id", "url", "host", "html", "entries").mapInArrow(run_joined, EXTRACTED)
