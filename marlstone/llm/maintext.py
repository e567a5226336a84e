"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines of text. Parts that a page never shows as text or names as its
frame (scripts, nav, footer, form and the like) and the step from one container to a sibling
leave WINDOW empty lines. The evidence of a line is its length outside links. Text beside a
marked article, and under class words that name parts beside the text, has a constant for
evidence, whatever its length. Over a sliding window of WINDOW lines the evidence is summed.
Lines in a window without evidence are cut out; of the segments between them those stay in
which a window reaches SURGE, from surge to dive point. A segment of the text that is no surge
and not links stays if it lies between two of them (in a marked article: before the last), or
shares its innermost container with one. If no window of the page reaches SURGE, lines under
class words that may also name the text count by a share; if still none does, all segments of
the text that are not links stay.

A form that holds an article or most of the page's text is read as any other part.

Defined results: a null or empty page, or one without article text, gives the
empty string; pages of any length are read whole; repeated rows give the same text
again; segments of equal length are kept alike; an empty table gives an empty
result. Only the key columns and the html are read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship

WINDOW = 2
#: Characters of evidence that make a window part of the text.
SURGE = 100
#: Shares of a line's evidence under class words beside the text, and under class words of such parts only.
HINTED, NAMED = 1 / 4, 1 / 100
#: Evidence of a line that mark-up puts beside the text: a constant, so that no length makes such lines a surge.
ASIDE = 1.0
#: Share of a line's text that must be outside links for its segment to be text, on pages without a surge.
UNLINKED = 0.25
#: Elements whose text is not read at all, elements of the page's frame, elements that start a block, empty elements.
RAW = frozenset("script style title textarea noscript template svg iframe noembed noframes xmp math".split())
FRAME = frozenset("head nav header footer aside menu form button select option dialog fieldset object embed canvas audio video map applet datalist".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dir div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption search".split())
#: Blocks that hold other blocks; a step over two of their edges parts segments.
CONTAINER = frozenset("article body div fieldset form hgroup main section table".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that mark parts beside the article, and those that mark the article.
BESIDE = frozenset(
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs header masthead banner footer foot sidebar rail widget widgets ad ads adv advert adverts advertisement advertisements adsense adbox adslot sponsor sponsored promo promos promotion newsletter subscribe subscription signup login register cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox share sharing social related recommended recommendations trending popular more comment comments disqus reply replies respond feedback pagination pager toolbar skip search copyright disclaimer complementary contentinfo dialog paywall".split()
)
ARTICLE = frozenset("article content main body post entry story text".split())
#: Of BESIDE, the words that count even next to a word of ARTICLE.
STRONG = BESIDE - frozenset("header more notice banner respond reply search".split())

#: Words that say nothing of their own in a class.
GENERIC = frozenset("area bar block bottom box btn button buttons center col column container count form global group inner item items js left link links list outer page panel primary right row secondary section site slot thread top unit user users wrap wrapper".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_END = {name: re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE) for name in RAW}


def _role(name: str, attributes: str) -> tuple[str, float]:
    """('hidden', 'article' or '', share of its text's evidence)."""
    if name in FRAME:
        return "hidden", 1.0
    marked = name in ("article", "main")
    if not attributes.strip():
        return "article" if marked else "", 1.0
    values = {m[1].lower(): html_lib.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    style = values.get("style", "").replace(" ", "").lower()
    if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return "hidden", 1.0
    if name in ("html", "body"):
        return "", 1.0
    share = _share(name, [part for k in ("class", "id", "role") for part in values.get(k, "").split()], marked)
    marked |= values.get("role") in ("main", "article") or values.get("itemprop") == "articleBody"
    return "article" if marked and share == 1 else "", share


def _share(name: str, parts: list[str], marked: bool) -> float:
    """What class words leave of the evidence: of a paragraph, and where other words stand beside them, never less than HINTED."""
    if name not in BLOCK and "-" not in name:
        return 1.0
    tokens = [{w.lower() for w in _WORDS.findall(part)} for part in parts if not re.match(r"(?:has|with|no|without|is|not)[-_]", part)]
    beside = STRONG if marked or any(t & ARTICLE for t in tokens) else BESIDE
    hits = [t for t in tokens if t & beside]
    if not hits:
        return 1.0
    named = any(all(w in BESIDE or w in GENERIC or w in ARTICLE or w.isdigit() for w in t) for t in hits)
    return NAMED if named and (name in CONTAINER or name in ("ul", "ol", "dl", "table", "figure", "details") or "-" in name) else HINTED


class Line(NamedTuple):
    """A line of text; the empty text is an empty line."""

    text: str
    free: int = 0  # characters outside links
    share: float = 1.0
    inside: bool = False  # a marked article
    container: int = -1


def lines_of(page: str) -> list[Line]:
    """The lines of the page with the empty lines that its mark-up leaves."""
    lines, forms = _walk(page, frozenset())
    return _walk(page, forms)[0] if forms else lines


def _walk(page: str, clear: frozenset[int]) -> tuple[list[Line], frozenset[int]]:
    """(lines, starts of the outermost forms that hold an article or most text); the forms that start at ``clear`` hide nothing."""
    out: list[Line] = []
    gap = [Line("")] * WINDOW
    stack: list[tuple[str, str, float]] = []  # name, role, share
    opened: Counter[str] = Counter()  # open elements by name
    containers = [-1]  # open ones by number
    edges = numbered = 0  # edges of containers since the last line, containers so far
    hidden = inside = links = frames = hinted = 0
    shares = [1.0]  # product of the open shares, by hint
    text: list[str] = []
    free = 0
    seen_article = False
    endless_title = False
    form_at, forms, in_forms = -1, 0, 0  # start of the outermost open form, open forms, those of them that hide
    held: dict[int, list] = {}  # by outermost form: whether it holds an article, characters
    total = 0

    def flush():
        nonlocal free, edges
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                if edges > 1:
                    out.extend(gap)
                edges = 0
                out.append(Line(joined, free, shares[-1], inside > 0, containers[-1]))
            text.clear()
        free = 0

    def leave(count: int):
        nonlocal hidden, inside, links, forms, in_forms, form_at, edges, frames, hinted
        for _ in range(count):
            name, role, share = stack[-1]
            if role or share != 1 or name in CONTAINER:
                flush()
            stack.pop()
            opened[name] -= 1
            links -= name == "a"
            if name in CONTAINER:
                containers.pop()
                edges += 1
            if name == "form":
                forms -= 1
                in_forms -= role == "hidden"
                form_at = form_at if forms else -1
            if role or share != 1:
                hidden -= role == "hidden"
                frames -= role == "hidden" and name in FRAME
                inside -= role == "article"
                if share != 1:
                    shares.pop()
                    hinted -= 1
                if not hidden:
                    out.extend(gap)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if page.startswith("<!", m.start()) or page.startswith("<?", m.start()):
                continue
            if hidden == in_forms:  # nothing but forms hides this
                n = len(m[0].strip())
                total += n
                if form_at in held:
                    held[form_at][1] += n
            if not hidden:
                plain = m[0] if "&" not in m[0] else html_lib.unescape(m[0])
                text.append(plain)
                free += 0 if links else len(plain.strip())
            continue
        name, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if closing:
            if name in BLOCK:
                flush()
            if opened[name]:  # what is left here was entered once, so that all of the page costs its length
                leave(next(k for k, x in enumerate(reversed(stack), 1) if x[0] == name))
            continue
        if name in RAW:
            if not attributes.rstrip().endswith("/") and not (name == "title" and endless_title):
                end = _END[name].search(page, at)
                # an unclosed raw element swallows the rest of its page, as in browsers; a title only its line
                endless_title |= not end and name == "title"
                at = end.end() if end else (size if name != "title" else at)
            continue
        role, share = _role("div" if name == "form" and m.start() in clear else name, attributes)
        if name in BLOCK:
            flush()
        if name in VOID:
            continue
        if name == "body" and opened["head"]:  # an unclosed head ends here
            leave(next(len(stack) - k for k, x in enumerate(stack) if x[0] == "head"))
        if role == "article" and (hidden or hinted) and not frames and not seen_article:
            leave(len(stack) - next(k for k, x in enumerate(stack) if x[1] == "hidden" or x[2] != 1))  # what is beside the only article was left open
        if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
            leave(1)  # these end where the next one begins
        if name in ("p", "b", "i", "em", "strong", "span", "u", "font", "small") and not role and share == 1 and not hidden:
            continue  # their end tags change nothing
        if role == "article" and hidden == in_forms and form_at in held:
            held[form_at][0] = True
        if name == "form":
            if not forms:
                form_at = m.start()
                if _role("div", attributes) == ("", 1.0):
                    held[form_at] = [False, 0]
            forms += 1
            in_forms += role == "hidden"
        if role or share != 1:
            flush()
            if not hidden:
                out.extend(gap)
            hidden += role == "hidden"
            frames += role == "hidden" and name in FRAME
            if share != 1:
                shares.append(shares[-1] * share)
                hinted += 1
            if role == "article":
                inside += 1
                seen_article |= not hidden
        elif name in CONTAINER:
            flush()
        stack.append((name, role, share))
        opened[name] += 1
        links += name == "a"
        if name in CONTAINER:
            numbered += 1
            containers.append(numbered)
            edges += 1
    flush()
    return out, frozenset(at for at, (article, n) in held.items() if article or n * 2 > total)


def window_sums(values: list[float]) -> list[float]:
    """Sums of the windows of WINDOW values; a shorter list is one window."""
    n = min(WINDOW, len(values))
    return [sum(values[k : k + n]) for k in range(len(values) - n + 1)] if n else []


def segments(values: list[float]) -> list[tuple[int, int, float]]:
    """(surge line, dive line, highest window sum) of the ranges of lines that are in no window without evidence."""
    sums = window_sums(values)
    n = len(values) - len(sums) + 1 if sums else 0
    out: list[tuple[int, int, float]] = []
    start, out_until = None, 0
    for k in range(len(values) + 1):
        if k < len(sums) and sums[k] == 0:
            out_until = k + n
        if k < out_until or k == len(values):
            if start is not None:
                # windows that reach over an edge count what is inside, as the empty lines there add nothing
                out.append((start, k, max(sums[max(0, start - n + 1) : k])))
                start = None
        elif start is None:
            start = k
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines = lines_of(page)
    marked = any(x.inside and x.free for x in lines)
    ours = [(x.inside or not marked) and x.share > NAMED for x in lines]
    found = segments([x.free if o and x.share == 1 else min(x.free, ASIDE) for x, o in zip(lines, ours)])
    surges = [peak >= SURGE for _, _, peak in found]
    if not any(surges):  # the text may stand under class words that also name parts beside it
        found = segments([x.free * x.share if o else min(x.free, ASIDE) for x, o in zip(lines, ours)])
        surges = [peak >= SURGE for _, _, peak in found]
    own = [[x for x, o in zip(lines[a:b], ours[a:b]) if o and x.text] for a, b, _ in found]
    read = [any(x.free and x.free >= UNLINKED * len(x.text) for x in part) for part in own]  # not links alone
    if any(surges):
        first, last = surges.index(True), len(surges) - 1 - surges[::-1].index(True)
        text_in = {x.container for part, surge in zip(own, surges) if surge for x in part}
        near = [k < last and (marked or k > first) or any(x.container in text_in for x in part) for k, part in enumerate(own)]
        kept = [part for part, surge, r, n in zip(own, surges, read, near) if surge or r and n]
    else:
        kept = [part for part, r in zip(own, read) if r]
        if not kept:  # links or named parts are all there is
            kept = [[x for x in lines[a:b] if x.text] for a, b, _ in found if any(x.free for x in lines[a:b])]
    return "\n".join(x.text for part in kept for x in part)


def extract_main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(keep columns, text, n_chars) of every page; one narrow pass, no shuffle."""

    ship(pages.sparkSession)

    def extract(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*batch.schema.names[1:], "text", "n_chars"])

    picked = pages.select(F.col(html_col).cast("string").alias("_html"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)))
    kinds = ", ".join(f"k{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    return picked.mapInArrow(extract, f"{kinds}, text string, n_chars bigint").toDF(*keep, "text", "n_chars")
