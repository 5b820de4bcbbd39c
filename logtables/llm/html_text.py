"""Main text of web pages by tag-path ratios.

A page is cut into blocks, each with the path of tags from the root to the block. Per path, over the whole page, two
ratios are added up: the text ratio (characters outside links per block) and the punctuation ratio (marks that end or
join clauses, per block). Each is smoothed with the paths beside it in page order, which keeps short content paths
between long ones, both are fused into one weight, and the paths at or above a share of the page's best are content.
Where the page says itself what a part is (article, nav, a class name such as "sidebar"), that is fused in as well: a
path under a part that is never content weighs nothing, and a path under a part marked as content weighs several times
as much and may have more links. Names and forms only lower a path's weight, and not if the part holds most of the
page's text outside links; but what a name tells to be reader comments is never content, however much it holds. The ratios decide on every
page, marked or not.

Then the ratios judge containers: where the content paths hold most of the text of a marked part, its other blocks are content too, and so are
blocks between two content blocks of one parent, unless they are lowered or mostly links. So short lists, quotes, tables and captions
inside an article stay.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
#: A new list item or cell doesn't close one outside of these.
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
         "option": ("select",), "tbody": ("table",), "tfoot": ("table",), "p": ("td", "th", "table", "article", "section", "div", "body", "aside")}
NEVER = frozenset("head nav header footer aside button select option dialog menu label input".split())
LOWERING = frozenset("form fieldset".split())
CONTENT = frozenset("article main".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary dialog alert menu menubar toolbar".split())
LOWERING_ROLES = frozenset("search form".split())
#: Class names and ids, whole or their last word, that lower a part, unless the first word says something of the layout.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus footer foot form gdpr header masthead menu menus modal nav navbar navigation newsletter notice "
    "notices notification pager pagination popup promo promoted promotion related replies respond share sharing sidebar "
    "side skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
#: Words of names of reader comments, and last words of names that only tell something about them.
COMMENTS = frozenset("comment comments commentlist commentarea disqus replies respond".split())
ABOUT = frozenset("allowed closed count counter disabled enabled form icon link number off on open toggle".split())
LAYOUT = frozenset("has have hide is no not show with without".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
MARKS = re.compile(r"[.,;:!?…。、，；：！？]")
#: Paths of this share of the best weight are content.
SHARE = 0.1
#: The weight of a path that the page marks as content, and how much less of its text must be outside links.
MARKED = 4.0
#: The weight of a path for each part above it that a name, a form or fieldset lowers.
LOWERED = 0.02


def blocks_of(page: str) -> list[tuple[str, int, tuple[str, ...], str, int, tuple[int, ...], int]]:
    """Blocks in page order: (path, -1 never content, 1 marked content, else 0; lowered parts above; text; characters in links;
    numbers of its element and those above, its own last; number of the nearest marked one or 0)."""
    # tag, path, kind, in a link, lowered parts, elements, nearest marked element
    stack: list[tuple[str, str, int, bool, tuple[str, ...], tuple[int, ...], int]] = [("", "", 0, False, (), (), 0)]
    blocks: list[tuple[str, int, tuple[str, ...], str, int, tuple[int, ...], int]] = []
    elements = 0
    parts: list[str] = []
    linked = 0
    raw = None
    depth = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                at = next(s for s in reversed(stack) if s[0] not in INLINE)
                blocks.append((at[1], at[2], at[4], text, linked, at[5], at[6]))
            parts.clear()
        linked = 0

    def close(tag: str, within: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                if tag not in INLINE:
                    flush()
                    del stack[i:]
                else:
                    del stack[i]
                return
            if stack[i][0] in within:
                return

    pos = 0
    while True:
        m = TOKEN.match(page, pos)
        if not m:
            break
        pos = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                parts.append(piece)
                if stack[-1][3]:
                    linked += len(piece)
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "br":
                parts.append(" ")
            elif tag == "p" and not any(s[0] == "p" for s in stack):
                flush()
            else:
                close(tag)
            continue
        if tag in ("svg", "math") and m[3].rstrip().endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
            if tag not in INLINE and tag != "svg" and tag != "math":
                parts.append(" ")
            if end or tag not in ("svg", "math"):  # a drawing or formula without an end ends at the next tag
                pos = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag in ("br", "hr", "wbr", "img", "input") and tag != "wbr":
                parts.append(" ") if tag == "br" else None
                if tag == "hr":
                    flush()
            continue
        if m[3].rstrip().endswith("/") and tag not in INLINE and tag not in CLOSES_P:
            continue
        if tag in CLOSES_P:
            close("p", SCOPE["p"])
        for other in SIBLINGS.get(tag, ()):
            close(other, SCOPE[tag])
        if tag not in INLINE:
            flush()
        top = stack[-1]
        kind, lowered, label, content = kind_of(tag, m[3], top[2])
        path = top[1] if tag in INLINE else f"{top[1]}/{label}"
        # a lowered inline tag has no step in the path
        above = (*top[4], f"{top[1]}/{label}") if lowered else top[4]
        elements += 1
        chain = top[5] if tag in INLINE else (*top[5], elements)
        stack.append((tag, path, kind, top[3] or tag == "a", above, chain, elements if content else top[6]))
        depth = max(depth, len(stack))
    flush()
    return blocks


def kind_of(tag: str, attributes: str, above: int) -> tuple[int, bool, str, bool]:
    """Whether a part is never content (-1), in marked content (1) or neither (0), if it is lowered, its step in the path, if it is itself a mark."""
    names: list[str] = []
    kind, lowered, content = above, tag in LOWERING, tag in CONTENT
    if attributes and not attributes.isspace():
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                names += value.split()
            elif name == "role" and value.lower() in NEVER_ROLES:
                kind = -1
            elif name == "role" and value.lower() in LOWERING_ROLES:
                lowered = True
            elif name == "role" and value.lower() in ("main", "article"):
                content = True
            elif name in ("hidden",) or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                kind = -1
        if re.search(r"(?:^|\s)hidden(?:\s|$)", attributes):
            kind = -1
    if kind < 0 or tag in NEVER:
        return -1, False, tag, False
    if tag in ("html", "body"):
        return kind, False, tag, False
    if tag not in INLINE and any(map(of_comments, names)):
        return -1, False, tag, False
    lowered = not content and (lowered or any(map(lowers, names)))
    return int(content or kind), lowered, f"{tag}.{'.'.join(sorted(names))}" if names and tag not in INLINE else tag, content


def of_comments(name: str) -> bool:
    words = [w.lower() for w in WORD.findall(name)]
    return any(w in COMMENTS for w in words) and words[0] not in LAYOUT and words[-1] not in ABOUT


def lowers(name: str) -> bool:
    words = [w.lower() for w in WORD.findall(name)]
    return name.lower() in NAMES or bool(words) and words[-1] in NAMES and words[0] not in LAYOUT


def main_text(page: str | None, share: float = SHARE) -> str:
    """The page's main text; empty if there is none."""
    if not page:
        return ""
    blocks = [(b[:3], *b[3:]) for b in blocks_of(page) if b[1] >= 0]  # path, text, linked, elements, marked
    if not blocks:
        return ""
    paths: dict[tuple[str, int, tuple[str, ...]], list[float]] = {}
    for path, text, linked, *_ in blocks:
        sums = paths.setdefault(path, [0, 0, 0, 0])
        sums[0] += max(0, len(text) - linked)
        sums[1] += len(MARKS.findall(text)) if not linked else 0
        sums[2] += 1
        sums[3] += len(text)
    order = list(paths)  # by first place in the page
    ratio = [paths[p][0] / paths[p][2] for p in order]
    marks = [paths[p][1] / paths[p][2] for p in order]
    most = holding_most(paths)
    factor = {}
    for p in order:
        low = sum(part not in most for part in p[2])
        factor[p] = LOWERED**low if low else MARKED if p[1] > 0 else 1.0
    weight = {p: a * (1 + b) * factor[p] for p, a, b in zip(order, smoothed(ratio), smoothed(marks))}
    best = max(weight.values())
    kept = {p for p, w in weight.items() if w >= share * best and 2 * max(1.0, factor[p]) * paths[p][0] >= paths[p][3]}
    return " ".join(text for (_, text, *_), stays in zip(blocks, contained(blocks, [b[0] in kept for b in blocks])) if stays)


def contained(blocks: list[tuple], kept: list[bool]) -> list[bool]:
    """The blocks that stay, with those that their container keeps: see the module's docstring."""
    whole: dict[int, list[float]] = {}
    parts_of: dict[int, set[str]] = {}
    span: dict[int, list[int]] = {}
    for (_, _, parts), *_, marked in blocks:
        if marked:
            # what is lowered above the marked part is so for all of it
            common = parts_of.setdefault(marked, set(parts))
            common &= set(parts)
    for i, ((_, _, parts), text, linked, chain, marked) in enumerate(blocks):
        if marked and not set(parts) - parts_of[marked]:
            sums = whole.setdefault(marked, [0, 0])
            sums[0] += len(text) - linked
            sums[1] += (len(text) - linked) * kept[i]
        if kept[i] and len(chain) > 1:
            span.setdefault(chain[-2], [i, i, len(parts)])[1] = i
    out = list(kept)
    for i, ((_, _, parts), text, linked, chain, marked) in enumerate(blocks):
        free = len(text) - linked
        if out[i]:
            continue
        held, all_kept = whole.get(marked, (0, 0))
        if held and 2 * all_kept >= held and not set(parts) - parts_of[marked] and 2 * MARKED * free >= len(text):
            out[i] = True
        elif 2 * free >= len(text):
            out[i] = any(e in span and span[e][0] < i < span[e][1] and len(parts) <= span[e][2] for e in chain[:-1])
    return out


def holding_most(paths: dict[tuple[str, int, tuple[str, ...]], list[float]]) -> set[str]:
    """Lowered parts that hold most of the page's text outside links; marked text outside of lowered parts counts by its weight."""
    held: dict[str, float] = {}
    everything = 0.0
    for (_, kind, parts), sums in paths.items():
        everything += sums[0] * (MARKED if kind > 0 and not parts else 1)
        for part in set(parts):
            held[part] = held.get(part, 0) + sums[0]
    return {part for part, n in held.items() if 2 * n > everything}


def smoothed(values: list[float]) -> list[float]:
    n = len(values)
    return [(2 * values[i] + values[max(0, i - 1)] + values[min(n - 1, i + 1)]) / 4 for i in range(n)]


def extract_main_text(pages: DataFrame, page: str = "html", output: str = "text") -> DataFrame:
    """The columns of pages without ``page``, and the main text in ``output``, which replaces a column of that name.

    Character references are decoded, white space inside a block becomes one space, blocks are joined in page order
    by one space. Null and empty pages, and pages without content, have an empty text. Broken markup is read to its
    end: unknown tags are block tags, missing end tags are closed by what follows. Rows are independent of each
    other; repeated rows stay, an empty table gives no rows.
    """
    others = [c for c in pages.columns if c not in (page, output)]
    rows = pages.select(F.struct(*others).alias("row"), F.col(page).alias("page"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    made = rows.mapInArrow(extract, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    return made.select("row.*", F.col("text").alias(output))
