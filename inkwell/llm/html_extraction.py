"""Main text of web pages by template deduction over equivalence classes of tokens.

A token is a tag or a line of text together with its path of open elements. Its occurrences are
counted over all distinct pages of a host. Tokens of one kind with the same occurrence vector form an
equivalence class; a class is valid if its tokens come in one order on every page. Classes nest by the
paths of their tokens. The valid classes are the template. What stands between its tokens are the
slots, and the slot region that holds the bulk of the varying text is the article. Inside it, parts
that cannot be article by their tag or role are left out, and so are lines that occur exactly as often
as the article's element on every page. A part whose id or class only sounds like no article is left
out if the template or its links or form confirm it, and never if it is a heading.
"""

from __future__ import annotations

import html
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import join_unique, lookup, small_batches, written

#: Distinct pages of a host that a line's class needs; fewer cannot tell a template from a quotation.
SUPPORT = 3
#: The part of the varying text that the article's element holds, where no tag names it.
BULK = 0.7
MILLION = 1_000_000

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "svg", "math", "object", "title", "xmp", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "td", "th", "ruby", "rt", "rp",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
    "main", "nav", "ol", "p", "pre", "section", "table", "ul", "figure", "details",
}
OUTSIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "head", "menu", "input", "canvas", "audio", "video"} | RAW
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form", "status", "toolbar"}
MARKS = {
    "nav", "navbar", "navigation", "menu", "submenu", "header", "masthead", "footer", "sidebar", "side", "aside", "ad", "ads", "adv", "advert", "adverts",
    "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert",
    "popup", "modal", "overlay", "comment", "comments", "respond", "reply", "replies", "disqus", "discussion", "share", "sharing", "social", "related", "recommended",
    "newsletter", "subscribe", "subscription", "signup", "login", "breadcrumb", "breadcrumbs", "pagination", "pager", "widget", "toolbar", "search", "copyright",
    "skip", "hidden", "print", "tags", "feedback", "paywall",
}
MAIN_TAGS = {"article": 2, "main": 1}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTROLS = {"form", "button", "select", "input", "textarea"}
SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass
class Line:
    """A block of text with where it stands."""

    path: tuple[int, ...]
    text: str
    linked: int
    key: int = 0


@dataclass
class Page:
    """Elements (parent, token, whether outside an article by tag or role, whether only its id or class says so, whether it holds a form) and lines."""

    parent: list[int]
    token: list[str]
    name: list[str]
    outside: list[bool]
    marked: list[bool]
    control: list[bool]
    lines: list[Line]


def marked_outside(name: str, attributes: str, inside_main: bool) -> tuple[str, bool, bool]:
    """The element's token (name, id and classes), whether it is no part of an article, and whether only its id or class says so."""
    found = {}
    for key, value in ATTRIBUTE.findall(attributes) if attributes.strip(" /") else ():
        found.setdefault(key.lower(), html.unescape(value.strip("\"'")).lower())
    label = f"{found.get('id', '')} {found.get('class', '')}".strip()
    out = name in OUTSIDE or (name == "header" and not inside_main) or found.get("role") in ROLES
    out = out or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    marked = False
    if not out and label and name not in HEADINGS and name not in ("html", "body", "article", "main"):
        marked = any(part in MARKS for part in SPLIT.split(label))
    return f"{name}.{label}" if label else name, out, marked


def parse(text: str) -> Page:
    """One pass over the tags; unclosed paragraphs, list items and cells end where the next one begins."""
    page = Page([-1], ["#"], ["#"], [False], [False], [False], [])
    stack, buffer, linked, at, length = [0], [], 0, 0, len(text)

    def flush() -> None:
        nonlocal linked
        line = " ".join("".join(buffer).split())
        if line:
            page.lines.append(Line(tuple(stack), line, linked))
        buffer.clear()
        linked = 0

    def close_to(depth: int) -> None:
        del stack[depth:]

    while at < length:
        hit = TAG.search(text, at)
        piece = text[at : hit.start() if hit else length]
        if piece:
            piece = html.unescape(piece)
            buffer.append(piece)
            if any(page.name[e] == "a" for e in stack):
                linked += len(piece)
        if not hit:
            break
        at = hit.end()
        name = hit[2] or hit[5]
        if not name:
            continue
        name, closing = name.lower(), bool(hit[1] or hit[4])
        if name not in INLINE:
            flush()
        elif name in ("td", "th"):
            buffer.append(" ")
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if page.name[stack[depth]] == name:
                    close_to(depth)
                    break
            continue
        if name in CLOSES_P or name in ("li", "tr", "td", "th", "dt", "dd", "option"):
            ends = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(name, ("p",))
            stops = ("ul", "ol", "table", "dl", "article", "div", "section", "body") if "p" not in ends else ("article", "div", "section", "body", "td", "li")
            for depth in range(len(stack) - 1, 0, -1):
                if page.name[stack[depth]] in ends:
                    close_to(depth)
                    break
                if page.name[stack[depth]] in stops:
                    break
        inside = any(page.name[e] in MAIN_TAGS for e in stack)
        token, out, marked = marked_outside(name, hit[3] or hit[6] or "", inside)
        page.parent.append(stack[-1])
        page.token.append(token)
        page.name.append(name)
        page.outside.append(out or page.outside[stack[-1]])
        page.marked.append(marked)
        page.control.append(False)
        if name in CONTROLS:
            for e in stack:
                page.control[e] = True
        if name in VOID or (hit[3] or hit[6] or "").endswith("/"):
            continue
        stack.append(len(page.parent) - 1)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(text, at)
            at = end.end() if end else length
            stack.pop()
    flush()
    return page


def paths(page: Page) -> list[str]:
    """The path token of every element: its own token after those of the elements around it, inline ones left out."""
    out = [""] * len(page.parent)
    for i, up in enumerate(page.parent):
        own = page.token[i] if page.name[i] not in INLINE else ""
        out[i] = page.token[i] if up < 0 else f"{out[up]}>{own}" if own else out[up]
    return out


def one_order(seen: list, size: int) -> list | None:
    """The order in which the ``size`` tokens of a class come on a page, None if they have no single one."""
    first = seen[:size]
    return first if len(set(first)) == size and seen == first * (len(seen) // size) else None


def valid_classes(occurrences: list[Counter], orders: list[list[str]]) -> dict[tuple[int, ...], list[str]]:
    """Equivalence classes of a few pages in memory; ``host_tokens`` finds the same over all pages of all hosts."""
    vectors: dict[str, list[int]] = defaultdict(lambda: [0] * len(occurrences))
    for page, counts in enumerate(occurrences):
        for token, n in counts.items():
            vectors[token][page] = n
    classes: dict[tuple[int, ...], list[str]] = defaultdict(list)
    for token, vector in vectors.items():
        classes[tuple(vector)].append(token)
    out = {}
    for vector, tokens in classes.items():
        if sum(n > 0 for n in vector) * 2 > len(vector):
            found = [one_order([t for t in order if t in set(tokens)], len(tokens)) for n, order in zip(vector, orders) if n]
            if found[0] and all(x == found[0] for x in found):
                out[vector] = found[0]
    return out


def unlinked(line: Line) -> int:
    return max(0, len(line.text) - 2 * line.linked)


def bulk(page: Page) -> tuple[list[Line], int]:
    """The lines that show where the article is, and their size: those under no mark, or all if marks hold more than half of the text."""
    lines = [x for x in page.lines if not page.outside[x.path[-1]]]
    plain = [x for x in lines if not any(page.marked[e] for e in x.path)]
    size, whole = sum(map(unlinked, plain)), sum(map(unlinked, lines))
    return (plain, size or 1) if 2 * size >= whole else (lines, whole)


def confirmed(page: Page, lines: list[Line], within: set[int], repeated: set[int]) -> set[int]:
    """The marked elements below those of ``within`` that are no article: mostly links, a small part with a form, or nothing but ``repeated`` lines."""
    parts: dict[int, list[Line]] = defaultdict(list)
    for line in lines:
        depth = next((k for k, e in enumerate(line.path) if e in within), -1)
        for e in line.path[depth + 1 :]:
            if page.marked[e]:
                parts[e].append(line)
    whole, out = sum(len(x.text) for x in lines), set()
    for e, own in parts.items():
        size = sum(len(x.text) for x in own)
        links = 2 * sum(x.linked for x in own) >= size
        if links or (page.control[e] and 2 * size < whole) or all(x.key in repeated for x in own):
            out.add(e)
    return out


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def sketch(text: str) -> tuple[Page, list[int], list[int]]:
    """The parsed page with digests in place of tokens, and the digest and depth of every element's path."""
    page = parse(text)
    names = paths(page)
    known = {name: digest(name) for name in set(names)}
    for line in page.lines:
        line.key = digest(f"{known[names[line.path[-1]]]} {line.text}")
    page.token = []
    return page, [known[n] for n in names], [n.count(">") for n in names]


def packed(text: str) -> bytes:
    """The sketch of a page as plain values, without the classes of this module."""
    page, keys, depths = sketch(text)
    lines = [(x.path, x.text, x.linked, x.key) for x in page.lines]
    return pickle.dumps((page.parent, page.name, page.outside, page.marked, page.control, lines, keys, depths), 5)


def unpacked(data: bytes) -> tuple[Page, list[int], list[int]]:
    parent, name, outside, marked, control, lines, keys, depths = pickle.loads(data)
    return Page(parent, [], name, outside, marked, control, [Line(*x) for x in lines]), keys, depths


def token_orders(page: Page, keys: list[int]) -> tuple[list[int], list[int]]:
    """The tags and the lines of a page in their order."""
    return [k for k, name in zip(keys, page.name) if name not in INLINE], [x.key for x in page.lines]


def token_rows(site: str, mark: str, page: Page, keys: list[int], depths: list[int], out: dict) -> None:
    """Add the page to the sums of its tokens: vector, pages, share of the varying text, article tags, characters; then fixed values of a token."""
    tags, lines = token_orders(page, keys)
    share, size, tagged = Counter(), Counter(), {}
    plain, whole = bulk(page)
    for line in plain:
        for k in {keys[e] for e in line.path}:
            share[k] += unlinked(line)
    for line in page.lines:
        if not page.outside[line.path[-1]]:
            for k in {keys[e] for e in line.path} | {line.key}:
                size[k] += len(line.text)
    for e, name in enumerate(page.name):
        if name in MAIN_TAGS:
            tagged[keys[e]] = MAIN_TAGS[name]
    depth = dict(zip(keys, depths))
    first = {x.key: x for x in page.lines}
    for kind, order in enumerate((tags, lines)):
        for k, n in Counter(order).items():
            row = out.get((site, kind, k))
            if row is None:
                heads = kind == 1 and any(page.name[e] in HEADINGS for e in first[k].path)
                under = sorted({keys[e] for e in first[k].path}) if kind else []
                row = out[site, kind, k] = [0, 0, 0, 0, 0, 0 if kind else depth[k], heads, under]
            row[0] ^= digest(f"{mark} {n}")
            row[1] += 1
            if not kind:
                row[2] += MILLION * share[k] // whole
                row[3] += tagged.get(k, 0)
            row[4] += size[k]


def article_text(page: Page, keys: list[int], main: int | None, template: set[int], repeated: set[int]) -> str:
    """The lines of the article: those below the element ``main``, without marked parts that are confirmed and lines of the template."""
    own = [x for x in page.lines if not page.outside[x.path[-1]]]
    within = {e for e, k in enumerate(keys) if k == main}
    inside = [x for x in own if any(e in within for e in x.path)]
    if not inside:
        within = {e for e, name in enumerate(page.name) if name in MAIN_TAGS}
        inside = [x for x in own if any(e in within for e in x.path)] or own
    drop = confirmed(page, inside, within, repeated)
    return "\n".join(x.text for x in inside if x.key not in template and not any(e in drop for e in x.path))


def host_tokens(parsed: DataFrame) -> DataFrame:
    """``site, kind, token, vector, pages, share, tagged, size, depth, heading, under, total``: the tokens of valid classes on more than half of a site's pages."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict = {}
            for site, mark, data in zip(batch["site"], batch["mark"], batch["page"]):
                token_rows(site, mark, *unpacked(data), out)
            yield pd.DataFrame([(*k, *v) for k, v in out.items()], columns=names)

    names = ["site", "kind", "token", "vector", "pages", "share", "tagged", "size", "depth", "heading", "under"]
    schema = "site string, kind int, token long, vector long, pages long, share long, tagged long, size long, depth int, heading boolean, under array<long>"
    sums = [F.bit_xor("vector").alias("vector"), *(F.sum(n).alias(n) for n in ("pages", "share", "tagged", "size"))]
    fixed = [F.any_value(n).alias(n) for n in ("depth", "heading", "under")]
    counted = parsed.mapInPandas(count, schema).groupBy("site", "kind", "token").agg(*sums, *fixed)
    totals = written(parsed.groupBy("site").agg(F.count("*").alias("total")), "site-pages")
    tokens = written(counted.join(lookup(totals, 64), "site").where("2 * pages > total"), "site-tokens")
    several = tokens.groupBy("site", "kind", "vector").agg(F.collect_list("token").alias("tokens")).where("size(tokens) > 1")
    several = written(several.groupBy("site").agg(F.collect_list(F.struct("kind", "vector", "tokens")).alias("classes")), "site-classes")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, classes = {}, {}
            for site, data, given in zip(batch["site"], batch["page"], batch["classes"]):
                if site not in classes:
                    classes[site] = [(c["kind"], c["vector"], set(c["tokens"])) for c in given]
                    classes[site].append([{t: c[1] for c in classes[site] if c[0] == kind for t in c[2]} for kind in (0, 1)])
                page, keys, _ = unpacked(data)
                *known, places = classes[site]
                seen = defaultdict(list)
                for kind, order in enumerate(token_orders(page, keys)):
                    for t in order:
                        if t in places[kind]:
                            seen[kind, places[kind][t]].append(t)
                for kind, vector, members in known:
                    if own := seen.get((kind, vector)):
                        order = one_order(own, len(members))
                        found.setdefault((site, kind, vector), set()).add(digest(str(order)) if order else None)
            rows = [(*k, None not in v, min(v - {None}, default=0), max(v - {None}, default=0)) for k, v in found.items()]
            yield pd.DataFrame(rows, columns=["site", "kind", "vector", "ordered", "least", "most"])

    orders = parsed.select("site", "page").join(lookup(several, 8192), "site")
    orders = orders.mapInPandas(check, "site string, kind int, vector long, ordered boolean, least long, most long")
    orders = orders.groupBy("site", "kind", "vector").agg(F.bool_and("ordered").alias("ordered"), F.min("least").alias("least"), F.max("most").alias("most"))
    broken = written(orders.where("not ordered or least <> most").select("site", "kind", "vector"), "broken-classes")
    return tokens.join(lookup(broken, 64), ["site", "kind", "vector"], "left_anti")


def templates(tokens: DataFrame) -> DataFrame:
    """``site, main, template, repeated``: the article's element, the lines of its class inside it, and all lines of valid classes.

    Lines that would take half of the article's text are no template: those pages are near copies.
    """
    best = lambda when, first: F.max(F.when(when, F.struct(F.col(first).cast("long").alias("first"), "share", "token", "vector", "size")))
    named = best((F.col("tagged") > 0) & (F.col("share") > 0), "tagged")
    likely = best(F.col("share") >= BULK * MILLION * F.col("total"), "depth")
    mains = written(tokens.where("kind = 0").groupBy("site").agg(F.coalesce(named, likely).alias("main")), "site-mains")
    lines = tokens.where(f"kind = 1 and total >= {SUPPORT}").join(lookup(mains, 128), "site")
    inside = F.expr("vector = main.vector and array_contains(under, main.token)")
    lines = lines.groupBy("site").agg(
        F.collect_list("token").alias("repeated"), F.collect_list(F.when(inside & ~F.col("heading"), F.col("token"))).alias("template"),
        F.sum(F.when(inside, F.col("size")).otherwise(0)).alias("taken"))
    out = mains.join(lines, "site", "left")
    few = F.coalesce(2 * F.col("taken") < F.col("main.size"), F.lit(False))
    none = F.array().cast("array<long>")
    return out.select("site", F.col("main.token").alias("main"), F.when(few, F.col("template")).otherwise(none).alias("template"), F.coalesce("repeated", none).alias("repeated"))


def distinct_pages(parsed: DataFrame) -> DataFrame:
    """The first row by ``place`` of each page of a site; only the digests of pages and the places of copies move."""
    keys = parsed.select("site", "mark", "place")
    first = keys.groupBy("site", "mark").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    first = written(first.where("n > 1"), "copied-pages")
    later = written(join_unique(keys, first, ["site", "mark"], "n").where("place <> first").select("place"), "page-copies")
    return parsed.join(lookup(later, 16), "place", "left_anti")


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Null html counts as empty and gives an empty text. A page of no host, and the only page of a
    host, is its own template. A page is parsed and its template applied where it lies; only sums of tokens
    move, counted over all distinct pages of a host, so no host needs a large task. Repeated rows give
    equal rows; an empty table gives none; other columns are left out.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("mark", F.md5("html")).withColumn("host", host_of("url"))
    rows = rows.withColumn("site", F.when(F.col("host") == "", F.concat(F.lit("//"), "mark")).otherwise(F.col("host")))

    rows = rows.select("page_id", "url", "site", "mark", "html", F.monotonically_increasing_id().alias("place"))
    kept = "page_id {0}, url {1}, site string, mark string, place long".format(*(rows.schema[c].dataType.simpleString() for c in ("page_id", "url")))

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            done: dict[str, bytes] = {}
            for mark, text in zip(batch["mark"].to_pylist(), batch["html"].to_pylist()):
                if mark not in done:
                    done[mark] = packed(text)
            found = pa.array([done[mark] for mark in batch["mark"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in batch.schema.names if c != "html"), found],
                                             names=[*(c for c in batch.schema.names if c != "html"), "page"])

    parsed = written(rows.mapInArrow(read, f"{kept}, page binary"), "parsed-pages")
    known = written(templates(host_tokens(distinct_pages(parsed))), "site-templates")

    def apply(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts, sets, done = [], {}, {}
            columns = (batch[c].to_pylist() for c in ("site", "mark", "page", "main", "template", "repeated"))
            for site, mark, data, main, *lines in zip(*columns):
                if site not in sets:
                    sets[site] = [main, *(set(x or ()) for x in lines)]
                if (site, mark) not in done:
                    page, keys, _ = unpacked(data)
                    done[site, mark] = article_text(page, keys, *sets[site])
                texts.append(done[site, mark])
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    # a template holds the digests of a site's lines, so pages go on without moving
    found = parsed.drop("place").join(lookup(known, 2048), "site", "left")
    out = found.mapInArrow(apply, "{}, text string".format(kept.split(", site")[0]))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
