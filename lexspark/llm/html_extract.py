"""Operator 13: the main text of web pages by block rules in two passes.

A page is read tag by tag, with the tolerance that real pages need: raw-text elements run to their
own end tag, comments to their end, quotes count only behind an equals sign, unclosed and stray tags
are survived. Text between block-level tags is a block; inline tags do not part words. A block in a
container that its tag, role, class or visibility names as no part of an article (menus, headers,
footers, sidebars, notices, adverts, forms, reader comments) is bad from the start.

First pass: what a block's own figures say. Many linked characters make it bad; length with many
stop words makes it good; short blocks and those with a middling share of stop words stay ambiguous.
Where the page marks its article (article, main, an article body by role, class or property), only
that part can be good, and within it a block that is not mostly links is doubted only when it is
short and no sentence. Second pass: an ambiguous block takes the label of the nearest decided block
before or behind it; between two at the same distance that differ, a heading takes the one behind
it, a sentence-like block is good and others are bad; with no decided block at all it is good.

Pages are independent, so this is one pass over the rows with no shuffle; a task holds a slice of
pages at a time and one page's blocks, however long the page.

Defined results: a null or empty html has the empty text and no blocks; null page_id and repeated
rows are extracted row by row; html without any tag is one block; an empty table gives an empty
table; only page_id, url and html are read, so other columns cannot clash.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import slices

# HTML's elements by their part in a page.
BLOCK_TAGS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("iframe noembed noframes script style textarea title xmp".split())
DROPPED_TAGS = frozenset("applet aside audio button canvas datalist dialog footer head map math menu nav noscript object optgroup option select svg template video".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

# Words in classes and ids that name what is no part of an article, and what is its body.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disclaimer disqus footer gdpr hidden legal login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination paywall popup promo promotion recommendations recommended related replies respond search share sharebar sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
BODY_WORDS = frozenset("article body content entry main page post story text".split())
BODY_LEADS = frozenset("article entry main post story".split())
LAYOUT_WORDS = frozenset("has is no not with without".split())

# Frequent function words of six languages.
STOP_WORDS = frozenset(
    (
        "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which will with you "
        "aber als am an auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch nur oder sich sie sind so und von war werden wie wir zu zum zur über "
        "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous "
        "al como con cuando de del donde el ella en era es esta este fue ha hay la las lo los más no nos o para pero por que se sin sobre su sus también un una y ya "
        "alla che ci come con da dal dei della di e gli ho i il la le lo ma nel non per più questo si sono una "
        "ao as com da das do dos e em foi mais mas na nas não o os ou para pela pelo por que se seu sua um uma"
    ).split()
)

_TAG = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>|[!?/][^>]*+>)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/>"']+)""")
_NAMED = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE_END = re.compile(r"""[.!?…:;。！？][)\]»”’"']*$""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW_TAGS}


@dataclass(frozen=True)
class Rules:
    """Thresholds. Lengths are code points; densities are shares of linked characters and of stop words."""

    link_share: float = 0.33
    link_share_inside: float = 0.5
    short: int = 70
    long: int = 120
    stop_low: float = 0.15
    stop_high: float = 0.30
    stop_words: frozenset = STOP_WORDS


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    container: "Container | None"
    regions: tuple
    label: str = ""
    first: str = ""


@dataclass
class Container:
    """A part of the page that is no part of its article. A form is none if it turns out to hold the article."""

    kind: str
    drop: bool = True


@dataclass
class _Open:
    tag: str
    container: Container | None
    regions: tuple


def _attributes(given: str) -> dict[str, str]:
    return {(name or bare).lower(): entities.unescape(a or b or c or "") for name, a, b, c, bare in _ATTRIBUTE.findall(given)}


def _named(value: str) -> tuple[bool, bool]:
    """Whether the items of a class or id name an article's body, and whether they name something else."""
    body = other = False
    for item in value.split():
        words = [w.lower() for w in _PARTS.findall(item)]
        if not words or words[0] in LAYOUT_WORDS:
            continue
        if len(words) > 1 and words[0] in BODY_LEADS and all(w in BODY_WORDS for w in words) or words in (["content"], ["article"], ["story"]):
            body = True
        elif any(w in DROPPED_WORDS for w in words):
            other = True
    return body, other and not body


def _role_of(tag: str, given: str) -> tuple[str | None, int]:
    """The kind of container that a start tag opens, if it is no part of an article, and the rank of the article's part that it opens."""
    rank = 2 if tag == "article" else 1 if tag == "main" else 0
    if tag in DROPPED_TAGS or tag == "form":
        return tag, 0
    kind = "header" if tag == "header" else None
    if given and _NAMED.search(given):
        a = _attributes(given)
        if "hidden" in a or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
            return "hidden", 0
        role = a.get("role", "").lower()
        if tag not in ("html", "body", "main"):
            if role in DROPPED_ROLES:
                return role, 0
            body, other = _named(f"{a.get('class', '')} {a.get('id', '')}")
            if other:
                return "named", 0
            rank = max(rank, int(body and tag not in HEADINGS and tag in BLOCK_TAGS))
        if role == "main":
            rank = max(rank, 1)
        if a.get("itemprop", "").lower() == "articlebody":
            rank = 2
    return kind, rank


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in its order, each with its container and the parts of an article around it."""
    out: list[Block] = []
    stack: list[_Open] = [_Open("", None, ())]
    count: dict[str, int] = {}
    pieces: list[str] = []
    linked: list[str] = []
    regions = links = headings = 0

    def flush() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                top = stack[-1]
                inked = len("".join(entities.unescape("".join(linked)).split())) if linked else 0
                out.append(Block(text, inked, headings > 0, top.container, top.regions))
            pieces.clear()
            linked.clear()

    def add(text: str) -> None:
        if text:
            pieces.append(text)
            if links:
                linked.append(text)

    at, end = 0, page.rfind(">") + 1
    while at < end and (m := _TAG.search(page, at, end)):
        add(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        tag = name.lower()
        if not m[1]:
            if tag in RAW_TAGS:
                close = _RAW_END[tag].search(page, at)
                at = close.start() if close else len(page)
                continue
            if tag == "br":
                add(" ")
            if tag in BLOCK_TAGS or tag in DROPPED_TAGS:
                flush()
            if tag in VOID_TAGS:
                continue
            if tag == "p":  # a new paragraph ends an open one, and what was left open within it
                _close("p", stack, count, ("article", "body", "div", "li", "main", "section", "td"))
                links, headings = count.get("a", 0), sum(count.get(h, 0) for h in HEADINGS)
            top = stack[-1]
            kind, rank = _role_of(tag, m[3])
            container, around = top.container, top.regions
            if kind and container is None:
                container = Container("heading-only" if kind == "header" and around else kind)
            elif rank and container is not None and (container.kind == "form" or tag == "main"):
                container.drop = False
                container = None
            if rank and container is None:
                regions += 1
                around = (*around, (rank, regions))
            stack.append(_Open(tag, container, around))
            count[tag] = count.get(tag, 0) + 1
            links += tag == "a"
            headings += tag in HEADINGS
        else:
            if tag in BLOCK_TAGS or tag in DROPPED_TAGS:
                flush()
            _close(tag, stack, count, ())
            links, headings = count.get("a", 0), sum(count.get(h, 0) for h in HEADINGS)
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[A-Za-z/!]", rest)  # a tag that the page's end cuts off
        add(rest[: cut.start()] if cut else rest)
    flush()
    return out


def _close(tag: str, stack: list[_Open], count: dict[str, int], stop: tuple) -> None:
    """Closes the innermost open element of the tag and all within it; nothing if none is open, or one of `stop` lies between."""
    if not count.get(tag):
        return
    if stop:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].tag == tag:
                break
            if stack[at].tag in stop:
                return
    while len(stack) > 1:
        gone = stack.pop()
        count[gone.tag] -= 1
        if gone.tag == tag:
            return


def _dropped(b: Block) -> bool:
    c = b.container
    return c is not None and c.drop and not (c.kind == "heading-only" and b.heading)


def _article(blocks: list[Block]) -> set[int] | None:
    """The blocks of the page's marked article, by number; None if it marks none that can be trusted.

    Parts of the higher rank count before those of the lower. A single part is trusted; several,
    such as a list of teasers, only if they hold a third of the text that is not linked.
    """
    free = [(k, b) for k, b in enumerate(blocks) if not _dropped(b)]
    plain = sum(len(b.text) - b.linked for _, b in free)
    for rank in (2, 1):
        inside = [(k, b, next((r for r in b.regions if r[0] == rank), None)) for k, b in free]
        inside = [(k, b, r) for k, b, r in inside if r]
        held = sum(len(b.text) - b.linked for _, b, _ in inside)
        if held and (len({r for *_, r in inside}) == 1 or 3 * held >= plain):
            return {k for k, *_ in inside}
    return None


def _first_pass(b: Block, inside: bool, rules: Rules) -> str:
    """good, bad, or ambiguous as near (like a sentence) or short."""
    size = len(b.text)
    share = b.linked / max(1, sum(map(len, b.text.split()))) if b.linked else 0.0
    if inside:
        if share > rules.link_share_inside and not b.heading:
            return "bad"
        return "good" if size >= rules.short or b.heading or _SENTENCE_END.search(b.text) else "short"
    words = [w for at in range(0, size, 1 << 16) for w in _WORD.findall(b.text[at : at + (1 << 16)].lower())]
    stops = sum(w in rules.stop_words for w in words) / max(1, len(words))
    spaced = b.text.isascii() or any(c < "ɐ" and c.isalpha() for c in b.text)
    if share > rules.link_share or "©" in b.text:
        return "bad"
    if size < rules.short and (len(words) < 10 or not spaced):
        return "bad" if b.linked else "near" if _SENTENCE_END.search(b.text) and stops >= rules.stop_low else "short"
    if not spaced:
        return "good" if size >= rules.short else "near"
    if stops >= rules.stop_high:
        return "good" if size >= rules.long else "near"
    if stops >= rules.stop_low:
        return "good" if size >= 2 * rules.long else "near"
    return "bad"


def classify(blocks: list[Block], rules: Rules = Rules()) -> list[Block]:
    """Sets the labels of blocks: first, what the first pass says, and label, good or bad."""
    article = _article(blocks)
    for k, b in enumerate(blocks):
        b.first = "dropped" if _dropped(b) else "outside" if article is not None and k not in article else _first_pass(b, article is not None, rules)
        b.label = {"good": "good", "near": "", "short": ""}.get(b.first, "bad")
    # Within a marked article only its own blocks are neighbours.
    row = [b for b in blocks if article is None or b.first not in ("dropped", "outside")]
    n = len(row)
    before: list[tuple[int, str]] = [(n + 1, "")] * n
    seen: tuple[int, str] | None = None
    for k, b in enumerate(row):
        before[k] = (k - seen[0], seen[1]) if seen else (n + 1, "")
        seen = (k, b.label) if b.label else seen
    behind, final = None, []
    for k in range(n - 1, -1, -1):
        b = row[k]
        if b.label:
            behind = (k, b.label)
            continue
        (far, left), (near, right) = before[k], (behind[0] - k, behind[1]) if behind else (n + 1, "")
        if not left and not right:
            final.append((b, "good"))
        elif far != near:
            final.append((b, left if far < near else right))
        elif left == right:
            final.append((b, left))
        else:
            final.append((b, right if b.heading else "good" if b.first == "near" else "bad"))
    for b, label in final:
        b.label = label
    return blocks


def main_text(page: str | None, rules: Rules = Rules()) -> tuple[str, int, int]:
    """The main text of a page, its blocks and those kept."""
    blocks = classify(blocks_of(page or ""), rules)
    kept = [b.text for b in blocks if b.label == "good"]
    return "\n".join(kept), len(blocks), len(kept)


def _extract(rules: Rules):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            found = [main_text(h, rules) for h in batch.column(2).to_pylist()]
            text = [f[0] for f in found]
            counts = [pa.array(c, pa.int64()) for c in ([len(t) for t in text], [f[1] for f in found], [f[2] for f in found])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), *counts], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    return run


def extract_pages(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per row of pages: page_id, url, text, n_chars, n_blocks, n_kept."""
    out = "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long"
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(_extract(rules), out)


def _listed(rules: Rules):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            for k, page in enumerate(batch.column(1).to_pylist()):
                found = classify(blocks_of(page or ""), rules)
                if found:
                    names = ["page_id", "block", "text", "linked", "first", "kept"]
                    cols = [pa.array([batch.column(0)[k].as_py()] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array([b.text for b in found], pa.string())]
                    cols += [pa.array([b.linked for b in found], pa.int64()), pa.array([b.first for b in found], pa.string()), pa.array([b.label == "good" for b in found])]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def page_blocks(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per block of a page: page_id, block, text, linked (characters in links), first (the first pass's class), kept. For tuning rules."""
    return pages.select(F.col("page_id").cast("long"), F.col("html").cast("string")).mapInArrow(_listed(rules), "page_id long, block int, text string, linked long, first string, kept boolean")
