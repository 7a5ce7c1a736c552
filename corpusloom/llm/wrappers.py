"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page becomes a stream of symbols: opening and closing tags, and one symbol per text. Repeated
neighbouring groups are folded into (group)+. The streams of a host are aligned one after another:
what only one side has becomes optional, groups known to one side fold the other, and texts are
slots. The result is the host's wrapper. Streams are counted first, and hosts with many different
ones are aligned in parts whose wrappers are aligned again, so a host of any number of pages is
shared by many tasks.

Each page is then read through its host's wrapper. Texts that stand in one slot of nearly all
different pages of a host, in the article or not, are not its text; nor are menus, headers,
footers, asides, forms, adverts, notices and comments. Of the rest, slots in the article are the
text. Where the page has more text outside, or no article, all slots are.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from difflib import SequenceMatcher
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, stored

LONGEST_GROUP = 16  # symbols of a group that repeats
STREAMS_EACH = 100  # streams or wrappers that one task aligns
BROADCAST_BYTES = 4 << 20
FEWEST_PAGES = 3  # different pages of a host, to call a text of them fixed
FIXED_SHARE = 0.9  # of them that hold a fixed text

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME_PARTS = re.compile(r"[^a-z]+")

_RAW = frozenset("script style noscript template textarea iframe svg title xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
_LEFT_OUT = frozenset("nav footer aside form head button select dialog menu datalist object".split())
_LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar".split())
_LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice notices"
    " popup modal newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments"
    " reply replies disqus share sharing social related widget login".split()
)
_CLOSES = {  # an opening tag ends an open element of these names, up to the element that holds them
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_NO_P = _BLOCKS - {"html", "body", "head", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "li", "dd", "dt"}

ARTICLE, BODY, OUT = "#a", "#b", "#x"


def _left_out(name: str, attributes: str, in_article: bool) -> bool:
    if name in _LEFT_OUT or name == "header" and not in_article:
        return True
    for key, *values in _ATTRIBUTE.findall(attributes) if "=" in attributes else ():
        value = next((v for v in values if v), "").lower()
        if key.lower() == "role":
            if value in _LEFT_OUT_ROLES:
                return True
        elif name not in ("html", "body", "article", "main") or "comment" in value:
            if _LEFT_OUT_NAMES.intersection(_NAME_PARTS.split(value)):
                return True
    return False


def stream(html: str) -> tuple[list[str], list[str | None], list[int]]:
    """Symbols of a page, the text of each text symbol, and the block each text belongs to."""
    symbols: list[str] = []
    texts: list[str | None] = []
    blocks: list[int] = []
    open_: list[tuple[str, bool, bool]] = []  # name, left out, article
    out = article = False
    block = at = 0

    def add_text(raw: str):
        if raw.strip():
            symbols.append(OUT if out else ARTICLE if article else BODY)
            texts.append(entities.unescape(raw))
            blocks.append(block)
        elif raw and texts and texts[-1] is not None and blocks[-1] == block:
            texts[-1] += " "
        elif raw:
            symbols.append("#s")
            texts.append(" ")
            blocks.append(block)

    def close_to(depth: int):
        nonlocal out, article
        del open_[depth:]
        out = bool(open_) and open_[-1][1]
        article = bool(open_) and open_[-1][2]

    while True:
        m = _TOKEN.search(html, at)
        add_text(html[at : m.start()] if m else html[at:])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in _BLOCKS:
            block += 1
        symbols.append(f"<{m[1]}{name}")
        texts.append(" " if name == "br" else None)
        blocks.append(block)
        if m[1]:
            depth = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            if depth is not None:
                close_to(depth)
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if name in _NO_P:
            depth = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == "p"), None)
            if depth is not None:
                close_to(depth)
        if name in _CLOSES:
            ends, holders = _CLOSES[name]
            depth = None
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in holders:
                    break
                if open_[i][0] in ends:
                    depth = i
            if depth is not None:
                close_to(depth)
        if name not in _VOID and not m[3].endswith("/"):
            out = out or _left_out(name, m[3], article)
            role = "main" in m[3] and ("role", "main") in {(k.lower(), (a or b or c).lower()) for k, a, b, c in _ATTRIBUTE.findall(m[3])}
            article = article or name in ("article", "main") or role
            open_.append((name, out, article))
    return symbols, texts, blocks


# A wrapper is a list of items: a symbol, or [mark, item, ...] with mark "+" (repeated) or "?" (optional).


def folded(items: list) -> list:
    """items with neighbouring repeats of a group as ["+", *group], short groups first."""
    size = 1
    while size <= min(LONGEST_GROUP, len(items) // 2):
        out, i, n = [], 0, len(items)
        while i < n:
            group, times = items[i : i + size], 1
            while len(group) == size and items[i + times * size : i + (times + 1) * size] == group:
                times += 1
            if times > 1:
                out.append(["+", *group] if size > 1 or group[0][0] != "+" else group[0])
                i += times * size
            else:
                out.append(items[i])
                i += 1
        if len(out) == n:
            size += 1
        items = out
    return items


def _known_groups(items: list) -> list[list]:
    found = []
    for item in items:
        if isinstance(item, list):
            found += _known_groups(item[1:])
            if item[0] == "+" and item not in found:
                found.append(item)
    return found


def _fold_known(items: list, groups: list[list]) -> list:
    """items with single occurrences of known repeated groups written as the groups."""
    for group in groups:
        body, size, out, i = group[1:], len(group) - 1, [], 0
        while i < len(items):
            if items[i] == group or items[i : i + size] == body:
                step = 1 if items[i] == group else size
                if not out or out[-1] != group:
                    out.append(group)
                i += step
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _bare(items: list) -> list[str]:
    """Keys for alignment: an optional item counts as its content."""
    return [json.dumps(i[1] if isinstance(i, list) and i[0] == "?" and len(i) == 2 else i) for i in items]


def aligned(a: list, b: list) -> list:
    """One wrapper for two: mismatches become optional, repeats on one side hold for both."""
    a, b = _fold_known(a, _known_groups(b)), _fold_known(b, _known_groups(a))
    out: list = []

    def optional(items):
        for item in items:
            item = item if isinstance(item, list) and item[0] == "?" else ["?", item]
            if not out or out[-1] != item:
                out.append(item)

    i = j = 0
    for x, y, n in SequenceMatcher(None, _bare(a), _bare(b), autojunk=False).get_matching_blocks():
        optional(a[i:x])
        optional(b[j:y])
        for k in range(n):
            left, right = a[x + k], b[y + k]
            out.append(left if isinstance(left, list) and left[0] == "?" else right)
        i, j = x + n, y + n
    return out


def slots(symbols: list[str], wrapper: list) -> list[int]:
    """For each symbol of a page the item of the wrapper that it belongs to, -1 for none."""
    parts: list[tuple[str, int]] = [(json.dumps(s), 1) for s in symbols]
    items: list = list(symbols)
    for group in _known_groups(wrapper):
        body, size, new, sizes, i = group[1:], len(group) - 1, [], [], 0
        while i < len(items):
            whole = items[i] == group
            if whole or items[i : i + size] == body:
                step = 1 if whole else size
                width = sum(w for _, w in parts[i : i + step])
                if new and new[-1] == group:
                    sizes[-1] = (sizes[-1][0], sizes[-1][1] + width)
                else:
                    new.append(group)
                    sizes.append((json.dumps(group), width))
                i += step
            else:
                new.append(items[i])
                sizes.append(parts[i])
                i += 1
        items, parts = new, sizes
    at = [-1] * len(parts)
    for x, y, n in SequenceMatcher(None, _bare(wrapper), [p for p, _ in parts], autojunk=False).get_matching_blocks():
        at[y : y + n] = range(x, x + n)
    return [s for s, (_, width) in zip(at, parts) for _ in range(width)]


def joined_blocks(texts: list[str | None], blocks: list[int], keep: list[bool]) -> str:
    """Kept texts by block, white space as one space, blocks joined by an empty line."""
    out: dict[int, list[str]] = {}
    for text, block, kept in zip(texts, blocks, keep):
        if text is not None and (kept or not text.strip()):
            out.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in out.values())
    return "\n\n".join(line for line in lines if line)


def host_of(url: str | None) -> str:
    rest = (url or "").split("://", 1)[-1]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower()


def _skeleton(symbols: list[str]) -> list:
    return folded([s for s in symbols if s != "#s"])


def _streams(batches: Batches) -> Batches:
    for batch in batches:
        hosts = [host_of(u) for u in batch.column("url").to_pylist()]
        shapes = [json.dumps(_skeleton(stream(h)[0])) for h in batch.column("html").to_pylist()]
        yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(shapes, pa.string())], names=["host", "wrapper"])


def _merge(table: pa.Table) -> pa.Table:
    host = table.column("host")[0].as_py()
    shapes = sorted(set(table.column("wrapper").to_pylist()), key=lambda s: (-len(s), s))
    wrapper = json.loads(shapes[0])
    for shape in shapes[1:]:
        wrapper = aligned(wrapper, json.loads(shape))
    return pa.table({"host": [host], "wrapper": [json.dumps(wrapper)]})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host and wrapper (JSON) of pages (url, html): one row per host."""
    shapes = stored(mapped(pages.select("url", "html"), _streams, "host string, wrapper string").distinct(), "streams")
    while True:
        sizes = shapes.groupBy("host").agg(F.ceil(F.count("*") / STREAMS_EACH).alias("parts"))
        if sizes.filter("parts > 1").isEmpty():
            return stored(shapes.groupBy("host").applyInArrow(_merge, "host string, wrapper string"), "wrappers")
        dealt = shapes.join(sizes, "host").withColumn("part", F.pmod(F.xxhash64("wrapper"), "parts"))
        merged = dealt.select("host", "part", "wrapper").groupBy("host", "part").applyInArrow(_merge, "host string, wrapper string")
        shapes = stored(merged, "wrappers")


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _placed_digests(symbols: list[str], texts: list[str | None], wrapper: list) -> list[tuple[int, int] | None]:
    """Slot and digest of each text that is not left out, None for any other symbol; slot -1 is none."""
    at = slots(symbols, wrapper)
    return [(a, _digest(" ".join(t.split()))) if s in (ARTICLE, BODY) else None for a, s, t in zip(at, symbols, texts)]


def _slot_texts(batches: Batches) -> Batches:
    """host, whether the page has an article, slot, digest of a text there, digest of the page's
    texts; one row of slot -2 per page."""
    wrappers: dict[str, list] = {}
    for batch in batches:
        known: set[tuple[str, bool, int, int, int]] = set()
        for host, html, shape in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "wrapper"))):
            symbols, texts, _ = stream(html)
            if shape not in wrappers:
                wrappers[shape] = json.loads(shape)
            placed = [p for p in _placed_digests(symbols, texts, wrappers[shape]) if p]
            page = _digest(" ".join(str(digest) for _, digest in placed))
            known.update((host, ARTICLE in symbols, slot, digest, page) for slot, digest in [(-2, 0), *placed])
        hosts, kinds, *rest = zip(*known) if known else ((),) * 5
        columns = [pa.array(hosts, pa.string()), pa.array(kinds, pa.bool_()), *(pa.array(c, pa.int64()) for c in rest)]
        yield pa.record_batch(columns, names=["host", "article", "slot", "digest", "page"])


def _text_slots(symbols: list[str], texts: list[str | None], placed: list, fixed: set[tuple[int, int]]) -> list[bool]:
    """Whether each symbol is of the main text: not left out, not fixed, and in the article unless
    the page has more text outside."""
    free = [p is not None and p not in fixed for p in placed]
    size = {ARTICLE: 0, BODY: 0}
    for f, s, t in zip(free, symbols, texts):
        if f:
            size[s] += len(" ".join(t.split()))
    kinds = (ARTICLE,) if size[ARTICLE] >= size[BODY] else (ARTICLE, BODY)
    return [f and s in kinds for f, s in zip(free, symbols)]


def _extract(batches: Batches) -> Batches:
    wrappers: dict[str, list] = {}
    for batch in batches:
        out = []
        for html, shape, fixed in zip(*(batch.column(c).to_pylist() for c in ("html", "wrapper", "fixed"))):
            symbols, texts, blocks = stream(html)
            if shape not in wrappers:
                wrappers[shape] = json.loads(shape)
            article = ARTICLE in symbols
            same = {(f["slot"], f["digest"]) for f in fixed or () if f["article"] == article}
            placed = _placed_digests(symbols, texts, wrappers[shape])
            out.append(joined_blocks(texts, blocks, _text_slots(symbols, texts, placed, same)))
        yield pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"]
        )


def fixed_texts(read: DataFrame) -> DataFrame:
    """host and fixed: slots and digests of the texts that nearly all different pages of it hold.

    Pages with an article and pages without are counted apart; copies of a page count once."""
    found = mapped(read, _slot_texts, "host string, article boolean, slot long, digest long, page long")
    key = ["host", "article", "slot", "digest"]
    counts = stored(found.distinct().groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") >= FEWEST_PAGES), "slots")
    pages_of = counts.filter("slot = -2").select("host", "article", F.col("n").alias("pages"))
    return stored(
        counts.filter("slot <> -2")
        .join(pages_of, ["host", "article"])
        .filter(F.col("n") >= FIXED_SHARE * F.col("pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("article", "slot", "digest"))).alias("fixed")),  # nearly all on each page
        "fixed",
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text of each row of pages (page_id, url, html).

    Null html is empty and gives an empty text; pages without url share one host; repeated rows
    give repeated results; other columns are ignored; an empty table gives an empty result.
    Character references are decoded, white space inside a block is one space, blocks are joined by
    an empty line.
    """
    filled = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    wrappers = infer_wrappers(filled)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:.*?://)?([^/?#]*)", 1))
    size = wrappers.agg(F.coalesce(F.sum(F.length("wrapper")), F.lit(0)).alias("n")).first()["n"]
    if size <= BROADCAST_BYTES:
        wrappers = F.broadcast(wrappers)
    read = filled.withColumn("host", host).join(wrappers, "host")
    fixed = fixed_texts(read.select("host", "html", "wrapper"))
    size = fixed.agg(F.coalesce(F.sum(F.size("fixed")), F.lit(0)).alias("n")).first()["n"] * 20
    rows = read.join(F.broadcast(fixed) if size <= BROADCAST_BYTES else fixed, "host", "left")
    return mapped(rows.select("page_id", "url", "html", "wrapper", "fixed"), _extract, "page_id long, url string, text string")
