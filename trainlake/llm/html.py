"""Main text of web pages by equivalence classes of template tokens.

A token is the place of an element in its page: the path of containers down to it, with their
classes and ids. Tokens of one host with the same number of occurrences on every page form an
equivalence class (their vectors are compared as keyed sums over the pages, so no vector is
ever put together). A class belongs to the template if its tokens occur once on at least half of the host's
pages, and if each lies within other tokens of the template only: the classes
nest. What stands between template tokens are slots: text is in the slot of the nearest token around it, also
where sections are repeated or on few pages. Slots with text that differs between pages, is mostly
not links and is in no menu, header, footer or the like are kept. So are all texts of article and main, also lists of links; texts that
are the same on all pages within the slot that holds most of what differs (a lead line); and long texts that are the same
on all pages where next to nothing differs (one article under many dates).
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.llm.common import fresh
from trainlake.session import materialise

# Elements and words in class and id of what is no main text.
DROPPED = set("head title script style noscript template svg iframe object nav aside footer form button select textarea dialog menu".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion nav navbar navigation menu header footer sidebar "
    "notice cookie consent popup modal newsletter subscribe subscription comment comments respond disqus share sharing social related "
    "breadcrumb breadcrumbs widget login search replies reply cookies gdpr ccpa advertising masthead pagination pager subnav signup optin overlay lightbox toolbar".split()
)
# What may stand beside those words in a name made of several, such as site-header or share-buttons.
BESIDE = set("site page main top bottom left right side primary secondary global mobile sub dropdown bar box area list block container wrapper wrap inner section slot unit links item items buttons form posts articles".split())
HEADER_BESIDE = set("site top global".split())
# Elements that no mark drops.
KEPT = set("html body main article".split())
# Elements that hold others and make paths, and elements that end a block of text.
CONTAINERS = set("html head body header nav main article section aside footer div form ul ol table h1 h2 h3 h4 h5 h6 title".split()) | DROPPED
BLOCKS = CONTAINERS | set("p li dl dt dd tr td th thead tbody tfoot caption blockquote pre figure figcaption address hr".split())
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>script|style|noscript|template|iframe|svg)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Other elements that are dropped by their marks.
MARKED = {"p", "li", "span"}
_NAMES = re.compile(r"[.\s]+")
_PARTS = re.compile(r"[^a-z]+")
SUPPORT = 0.5
FEW_PAGES = 3
#: Containers below this depth count as part of the one at this depth when the template is sought; their text is kept or dropped like any other.
DEPTH = 64
#: A text that is the same on all pages is an article from this length on, if it is so many times as long as what differs.
SAME_CHARS, SAME_TIMES = 100, 3


def host(url):
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _marks(attrs: str) -> str:
    """Class, id and role as one string."""
    return ".".join((m[2] or m[3] or m[4] or "").lower().replace("/", "-") for m in _ATTR.finditer(attrs)) if attrs else ""


def _names_dropped(name: str, heads: bool) -> bool:
    """Whether a whole class, id or role is one of the dropped words, or made of them and what may stand beside; heads: headers are kept."""
    parts = {x for x in _PARTS.split(name) if x}
    if parts in ({"side", "bar"}, {"nav", "bar"}):
        return True
    words = parts & DROPPED_WORDS
    if words == {"header"}:
        return not heads and parts <= words | HEADER_BESIDE
    return bool(words) and parts <= words | BESIDE


def _is_dropped(tag: str, marks: str, within_article: bool) -> bool:
    if tag in KEPT:
        return False
    if tag in DROPPED or (tag == "header" and not within_article):
        return True
    heads = within_article or tag in ("h1", "h2", "h3", "h4", "h5", "h6")
    return bool(marks) and any(_names_dropped(x, heads) for x in _NAMES.split(marks))


def events(page: str) -> Iterator[tuple[str, tuple, bool, bool]]:
    """The text pieces of a page: text or a block end (None), path of containers, whether dropped, whether in a link."""
    stack: list[tuple[str, bool]] = []
    open_: Counter[str] = Counter()
    at, links, n_dropped = 0, 0, 0
    path: tuple = ()

    def push(tag: str, marks: str, drop: bool) -> None:
        nonlocal path, n_dropped
        if len(stack) < DEPTH:
            path += (f"{tag}.{marks}" if marks else tag,)
        stack.append((tag, drop))
        open_[tag] += 1
        n_dropped += drop

    def pop() -> str:
        nonlocal path, n_dropped
        tag, drop = stack.pop()
        if len(stack) < DEPTH:
            path = path[:-1]
        open_[tag] -= 1
        n_dropped -= drop
        return tag

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield page[at : m.start()], path, n_dropped > 0, links > 0
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "a":
            links = 0 if m["end"] else 1
        if tag in BLOCKS:
            yield None, path, n_dropped > 0, False
        elif tag == "br":
            yield " ", path, n_dropped > 0, False
        # p, li and span are held only where they are dropped, and those of one kind within, to find the end.
        if tag in BLOCKS and not (m["end"] and tag in CONTAINERS):
            while stack and (stack[-1][0] == "span" and tag not in CONTAINERS or stack[-1][0] == "p" or (stack[-1][0] == tag == "li" and not m["end"])):
                pop()
        if tag not in CONTAINERS and tag not in MARKED:
            continue
        if m["end"]:
            if open_[tag]:
                while pop() != tag:
                    pass
        elif not (m["attrs"] or "").endswith("/"):
            marks = _marks(m["attrs"])
            drop = _is_dropped(tag, marks, open_["article"] + open_["main"] > 0)
            # Within a dropped one of its kind it is dropped anyway.
            if tag not in MARKED or drop or open_[tag]:
                push(tag, marks, drop or tag in MARKED)
    if at < len(page):
        yield page[at:], path, n_dropped > 0, links > 0


def _clean(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def _tokens(pages: DataFrame) -> DataFrame:
    """For each page and path: how often it opens, the characters of its own text that is not dropped, those in links, and a hash of that text."""
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("page", pa.int64()), ("n", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64()), ("digest", pa.int64())])

    def count(batches):
        for b in batches:
            out = []
            for key, name, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                seen: dict[tuple, list] = {(): [1, 0, 0, []]}
                opened = ()
                for text, path, dropped, linked in events(page.as_py() or ""):
                    if path != opened:
                        common = next((k for k, (x, y) in enumerate(zip(path, opened, strict=False)) if x != y), min(len(path), len(opened)))
                        for k in range(common, len(path)):
                            seen.setdefault(path[: k + 1], [0, 0, 0, []])[0] += 1
                        opened = path
                    found = _clean(text) if text and not dropped else ""
                    if found:
                        entry = seen[path]
                        entry[1] += len(found)
                        entry[2] += len(found) if linked else 0
                        entry[3].append(found)
                for path, (n, chars, linked, texts) in seen.items():
                    digest = xxhash.xxh3_64_intdigest("\n".join(texts)) >> 1
                    out.append((name, "/".join(path), key, n, chars, linked, digest))
            columns = zip(*out, strict=True) if out else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return pages.mapInArrow(count, "host string, path string, page long, n long, chars long, linked long, digest long")


def slots(pages: DataFrame) -> DataFrame:
    """host, the paths of its slots that hold main text, and those of its whole template; pages has page (a number), host and html.

    The path of the page itself is empty; it is always in the template.

    A host of fewer than FEW_PAGES pages shows no template; it gets no slots.
    """
    tokens = _tokens(pages.select("page", "host", "html"))
    per = tokens.groupBy("host", "path").agg(
        F.sum(F.expr("n * shiftright(xxhash64(page), 33)")).alias("vector"), F.count(F.lit(1)).alias("on"), F.count_if(F.col("n") == 1).alias("single"),
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), (F.min("digest") != F.max("digest")).alias("differs"),
    )
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= FEW_PAGES)
    per = materialise(per.join(sizes, "host"), "page-tokens")
    once = per.filter(F.col("single") >= SUPPORT * F.col("pages"))
    # Tokens of one vector are a class; all its tokens are in the template or none.
    classes = once.groupBy("host", "vector", "on").agg(F.collect_list("path").alias("paths"))
    # At most twice as many tokens as an average page has: each is on half of the pages.
    template = classes.groupBy("host").agg(F.flatten(F.collect_list("paths")).alias("paths"))
    within = lambda p, t: (t == "") | F.startswith(F.concat(p, F.lit("/")), F.concat(t, F.lit("/")))
    depth = lambda p: F.when(p == "", 0).otherwise(F.size(F.split(p, "/")))
    # A token nests if each token around it is in the template, and so is counted with it; the page itself is.
    nested = F.filter("paths", lambda p: F.size(F.filter("paths", lambda t: (t != "") & within(p, t))) == depth(p))
    template = materialise(template.select("host", F.array_union(nested, F.array(F.lit(""))).alias("template")), "template")
    # All text belongs to the nearest token of the template around it, also where what holds it is repeated or on few pages only.
    holder = F.array_max(F.transform(F.filter("template", lambda t: within(F.col("path"), t)), lambda t: F.struct(F.length(t).alias("size"), t.alias("path"))))["path"]
    in_article = lambda p: p.rlike(r"(^|/)(article|main)(\.|/|$)")
    fit = per.filter((F.col("chars") > 0) & ((2 * F.col("linked") <= F.col("chars")) | in_article(F.col("path"))))
    # Written, so that the join of a large host can be split; text of one page only differs from the other pages.
    held = materialise(fit.join(template, "host").select("host", holder.alias("slot"), "chars", "on", (F.col("differs") | (F.col("on") == 1)).alias("differs")), "slot-texts")
    by_slot = held.groupBy("host", "slot").agg((F.bool_or("differs") | in_article(F.col("slot"))).alias("sure"), F.sum("chars").alias("chars"), F.max("on").alias("on"))
    # At most as many slots as the template has tokens.
    by_host = by_slot.groupBy("host").agg(F.collect_list(F.struct("slot", "sure", "chars", "on")).alias("all"), F.sum(F.when(F.col("sure"), F.col("chars"))).alias("sure_chars"))
    most = F.filter("all", lambda s: s.sure & (2 * s.chars >= F.col("sure_chars")) & ~s.slot.rlike(r"^(html[^/]*/?)?(body[^/]*)?$"))

    def is_text(s):
        long = (s.chars >= SAME_TIMES * F.col("sure_chars")) & (s.chars >= SAME_CHARS * s.on)
        return s.sure | long | F.exists(most, lambda m: within(s.slot, m.slot))

    good = by_host.filter("sure_chars IS NOT NULL").select("host", F.transform(F.filter("all", is_text), lambda s: s.slot).alias("slots"))
    return good.join(template, "host").select("host", "slots", "template")


def main_text(page: str | None, kept: list[str] | None, template: list[str] | None = None) -> str:
    """The blocks in the kept slots, or without slots those of article or main, or else all that is not dropped.

    A block is in the slot of the nearest token of the template around it (without a template, of the nearest slot).
    A page that lacks all of its host's slots is read as one without.
    """
    pieces = list(events(page or ""))
    inside = lambda p: any(x.split(".")[0] in ("article", "main") for x in p)
    as_path = lambda k: tuple(k.split("/")) if k else ()
    slots_ = {as_path(k) for k in kept or ()}
    tokens = slots_.union(as_path(k) for k in template or ())
    nearest: dict[tuple, bool] = {}

    def holds(p):
        if p not in nearest:
            nearest[p] = next((p[:k] in slots_ for k in range(len(p), -1, -1) if p[:k] in tokens), False)
        return nearest[p]

    with_text = [p for text, p, dropped, _ in pieces if text and not dropped and _clean(text)]
    if not any(map(holds, with_text)):
        holds = inside if any(map(inside, with_text)) else lambda p: True
    blocks, held = [], []
    for text, path, dropped, _ in pieces:
        if text is None:
            blocks.append("".join(held))
            held = []
        elif not dropped and holds(path):
            held.append(text)
    blocks.append("".join(held))
    return "\n".join(b for b in map(_clean, blocks) if b)


def extract(pages: DataFrame) -> DataFrame:
    """pages with one more column, the main text of the whole html.

    pages needs url and html; the new column is the last one, ``main_text`` (with underscores where there is one already).
    NULL and empty pages have an empty text; pages of any length and depth are read whole, in one row. Pages without a url are pages of one host without a name. Character references are decoded,
    white space in a block becomes one blank, blocks are joined by line breaks. Rows are treated one by one; repeated ones count as
    pages of their own in the template. An empty table gives no rows.
    """
    at, name, found, around, text = fresh(pages, "page_number", "page_host", "slots", "template", "main_text")
    marked = pages.select("*", host(F.col("url").cast("string")).alias(name), F.monotonically_increasing_id().alias(at))
    # Written, so that the join knows its size, and adaptive execution can split the pages of a large host.
    kept = materialise(slots(marked.select(F.col(at).alias("page"), F.col(name).alias("host"), F.col("html").cast("string").alias("html"))), "slots")
    joined = marked.join(kept.select(F.col("host").alias(name), F.col("slots").alias(found), F.col("template").alias(around)), name, "left")

    def cut(pages_: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, slots_, templates in pages_:
            yield pd.Series([main_text(h, None if s is None else list(s), None if t is None else list(t)) for h, s, t in zip(htmls, slots_, templates, strict=True)], dtype=object)

    return joined.select(*pages.columns, F.pandas_udf(cut, "string")(F.col("html").cast("string"), F.col(found), F.col(around)).alias(text))
