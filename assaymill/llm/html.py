"""Main text of web pages by two passes over their blocks.

Pass one looks at each block alone: its length, the share of stop words, the share of
its characters inside links, and where it stands in the markup. It decides a block as
text or boilerplate or leaves it open. Pass two gives open blocks the label of the nearest
decided neighbours. Inside a marked article a block is never decided as boilerplate
for few stop words alone; it stays open and follows its neighbours there. A lone block of
links decides only itself there, and where nothing is decided as text, open blocks are kept.

The part of the page (its main element, each article, or the rest) that holds most decided
text says where the text is. The other parts add what is decided as text: an article beside
the main text counts whole if it has any such block and as a teaser if it has none.

Defined cases: a null or empty page gives an empty text; unclosed, misnested and cut-off
markup is read as far as it goes, in time linear in the page; a head left open ends where something
stands that belongs in the body; attribute values without quotes may hold quotes and end with a slash.
Null ids and urls are kept, repeated rows each get their own result, a table without rows gives
none; columns other than ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import small_batches

RESULT = "page_id bigint, url string, text string, n_chars bigint"

SHORT, LONG = 70, 200  # characters
STOP_LOW, STOP_HIGH = 0.30, 0.32  # share of stop words
LINKS = 0.5  # share of characters inside links

# Frequent function words of the languages at hand; a parameter of ``extract``.
STOP_WORDS = frozenset("""
the of and to in a is that it for on as with was be by are this from at or an not have has which he his they
der die das und in den von zu mit ist im für auf sich ein eine dem des nicht als auch es an er
le la les de des et en un une du que est pour dans qui par sur au pas avec il ce ne se
el los las y que del se por con para su una lo al es como no más pero
""".split())

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""
address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select
summary table tbody td textarea tfoot th thead title tr ul
""".split())
DROPPED = frozenset("""
aside button canvas dialog footer form head header iframe math menu nav noscript object select svg template
textarea title
""".split())
WRAPPERS = frozenset("form nav header".split())
CLOSED_BY_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                     "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# What may stand in the head of a page; any other start tag ends a head that was left open.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
FOREIGN = frozenset("svg math".split())  # only these can close themselves with a slash
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                  "menubar toolbar".split())
# A class or id says what a part of the page is for: one of these words, alone or beside others.
PURPOSES = frozenset("""
ad ads adsense banner sidebar cookie cookies consent gdpr notification newsletter subscribe signup popup modal overlay
paywall comment comments commentlist disqus reply replies respond nav navbar navigation menu breadcrumb breadcrumbs
pagination pager masthead siteheader pageheader topbar footer widget toolbar login copyright disclaimer header
""".split())
PURPOSE_STEMS = ("advert", "promo", "sponsor")
# Words that also name topics: they say a purpose only among words of page layout.
TOPICAL = frozenset("notice notices share sharing social related recommended recommendations search skip".split())
LAYOUT = frozenset("""
a area articles bar block blocks bottom box btn button buttons container content contents div element footer form group
header icon icons inner input item items js left link links list main media menu module nav now outer page panel post
posts primary region right row secondary section site stories story tools top widget wrap wrapper
""".split())
JOINING = frozenset("and at for from in of on or the to und de la y et".split())
NEGATED = frozenset("no has with without hide".split())


def _says_purpose(name: str) -> bool:
    """Whether a class or id names a part that is no text of the article."""
    words = [w for w in re.split("[-_]+", re.sub(r"(side|sign|top|log|site|page)[-_](bar|up|in|header)(?![a-z])", r"\1\2", name)) if w]
    if not words or words[0] in NEGATED or JOINING.intersection(words):
        return False
    if any(w in PURPOSES or w.startswith(PURPOSE_STEMS) for w in words):
        return True
    return any(w in TOPICAL for w in words) and all(w in TOPICAL or w in LAYOUT or w.isdigit() for w in words)


TALK = re.compile(r"(?i)comment|disqus|repl(y|ies)|respond")
TOKEN = re.compile(r"""(?xis)
    <!--.*?(?:-->|\Z) | <[!?][^>]*(?:>|\Z)
  | <(?P<raw>script|style|xmp|noembed|noframes)\b[^>]*>.*?(?:</(?P=raw)[^>]*>|\Z)
  | <(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)
    (?P<attrs>(?: [\s/]++ (?: [^\s/>][^\s/>=]*+ (?: \s*+=\s*+ (?: "[^"]*+" | '[^']*+' | [^\s>"'][^\s>]*+ )?+ )?+ )?+ )*+)
    [^>]*+(?:>|\Z)""")
ATTRIBUTE = re.compile(r"""(?is)(?<![\w-])(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(slots=True)
class Block:
    text: str
    linked: float  # share of characters inside links
    zone: int  # 0: anywhere, 1: in main, 2: in an article
    article: int  # which article of the page, from 1; 0: none
    dropped: bool  # the markup says it is no text of the article


def _purpose(name: str, attrs: str, zone: int) -> tuple[bool, bool, int]:
    """Of an element: dropped, holds reader comments, zone of what is inside."""
    found: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(attrs) if attrs else ():
        found.setdefault(key.lower(), unescape(value.strip("\"'")).lower())
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    marked = [x for x in names if _says_purpose(x)]
    talk = any(TALK.search(x) for x in marked)
    if "hidden" in found or found.get("aria-hidden") == "true" or \
            re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")):
        return True, talk, zone
    role = found.get("role", "")
    if name in ("html", "body", "main", "article") and not talk:
        return False, False, {"main": max(zone, 1), "article": 2}.get(name, zone)
    if zone and (name == "header" or marked and all("header" in x for x in marked)):
        return False, False, zone  # the head of an article belongs to it
    dropped = name in DROPPED or role in ROLES or bool(marked) and name not in ("p", "span", "a", "b", "i", "em", "strong")
    if not dropped and (role == "main" or "articlebody" in found.get("itemprop", "")):
        zone = max(zone, 2 if "articlebody" in found.get("itemprop", "") else 1)
    return dropped, talk, zone


def blocks(html: str) -> list[Block]:
    """The blocks of a page in page order, white space made single, empty ones left out."""
    out: list[Block] = []
    # name, dropped, comments, zone, inside a link, article
    stack: list[tuple[str, bool, bool, int, bool, int]] = [("", False, False, 0, False, 0)]
    opened: Counter[str] = Counter()  # by name, so that an end tag without a start costs nothing
    around = 0  # open elements that may stand around a whole page though they are marked as none of its text
    articles = 0
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            _, dropped, _, zone, _, article = stack[-1]
            out.append(Block(text, min(1.0, linked / len(text)), zone, article, dropped))
        parts.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal around
        for element in stack[depth:]:
            opened[element[0]] -= 1
            around -= element[0] in WRAPPERS and element[1]
        del stack[depth:]

    def innermost(name: str) -> int:
        return next(depth for depth in range(len(stack) - 1, 0, -1) if stack[depth][0] == name)

    at = 0
    for token in TOKEN.finditer(html):
        if token.start() > at:
            parts.append(text := html[at:token.start()])
            if stack[-1][4]:
                linked += len(text.strip())
        at = token.end()
        if not (name := (token["name"] or "").lower()):
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if token["end"]:
            if opened[name]:
                close(innermost(name))
            continue
        if opened["head"] and name not in IN_HEAD:
            flush()
            close(innermost("head"))
        if name in VOID or name in FOREIGN and token["attrs"].endswith("/"):
            continue
        for sibling in (CLOSED_BY_SIBLING.get(name), {"p"} if name in BLOCKS else None):
            if sibling and stack[-1][0] in sibling:
                close(len(stack) - 1)
        above, dropped, talk, zone, link, article = stack[-1]
        own, own_talk, zone = _purpose(name, token["attrs"], zone)
        if zone == 2 and not article:
            article = articles = articles + 1
        if dropped and not talk and not own and name in ("article", "main") and around:
            dropped = False  # an unclosed menu or a form around the page
        stack.append((name, dropped or own, talk or own_talk, zone, link or name == "a", article))
        opened[name] += 1
        around += name in WRAPPERS and stack[-1][1]
    parts.append(html[at:])
    flush()
    return out


def _first_pass(block: Block, stop_words: frozenset[str]) -> bool | None:
    """True: text, False: boilerplate, None: open."""
    if block.dropped or block.linked > LINKS:
        return False
    if len(block.text) < SHORT:
        return None if block.zone or not block.linked else False
    words = WORD.findall(block.text.lower())
    share = sum(w in stop_words for w in words) / max(1, len(words))
    if share >= STOP_HIGH and len(block.text) > LONG:
        return True
    if share >= STOP_LOW or block.zone:
        return None if share < STOP_HIGH or len(block.text) <= LONG else True
    return False


def _taking_part(found: list[Block], labels: list[bool | None]) -> tuple[int, list[Block], list[bool | None]]:
    """Of a page that marks main or articles: the zone with the text, the blocks that take part, their labels."""
    text: Counter[tuple[int, int]] = Counter()  # decided as text, by zone and article
    free: Counter[tuple[int, int]] = Counter()  # not decided as boilerplate
    for block, label in zip(found, labels):
        if label is not False:
            free[block.zone, block.article] += len(block.text)
            if label:
                text[block.zone, block.article] += len(block.text)
    marked = Counter({k: n for k, n in free.items() if k[0]})
    if text:
        # Text outside of all marks counts where it is more than all the marked text.
        inside = Counter({k: n for k, n in text.items() if k[0]})
        outside = text.total() - inside.total()
        lead = 0 if outside > inside.total() else max(inside, key=lambda k: (inside[k], k))[0]
    else:
        lead = max(marked, key=lambda k: (marked[k], k))[0] if marked else max(b.zone for b in found if not b.dropped)

    def takes_part(block: Block, label: bool | None) -> bool:
        if block.dropped:
            return lead == 0 and block.zone == 0
        if block.zone == lead:
            return True
        if block.zone == 2:
            return (2, block.article) in text
        return label is True and (block.zone == 1 or lead == 0)

    kept = [i for i, (b, x) in enumerate(zip(found, labels)) if takes_part(b, x)]
    return lead, [found[i] for i in kept], [labels[i] for i in kept]


def main_text(html: str | None, stop_words: frozenset[str] = STOP_WORDS) -> str:
    found = blocks(html or "")
    labels = [_first_pass(b, stop_words) for b in found]
    zone = max((b.zone for b in found if not b.dropped), default=0)
    if zone:
        zone, found, labels = _taking_part(found, labels)
    decided = [i for i, x in enumerate(labels) if x is not None]
    if zone:
        linked = [x is False for x in (None, *labels, None)]
        decided = [i for i in decided if labels[i] or linked[i] or linked[i + 2]] if True in labels else []
    if not decided:
        default = bool(zone) or sum(len(b.text) for b in found) > LONG
        return "\n".join(b.text for b, x in zip(found, labels) if default and x is not False)
    kept, after = [], 0
    for i, block in enumerate(found):
        while after < len(decided) and decided[after] < i:
            after += 1
        label = labels[i]
        if label is None:
            right = decided[after] if after < len(decided) else None
            left = decided[after - 1] if after else None
            if left is None or right is None:
                label = labels[left if right is None else right]
            elif labels[left] == labels[right]:
                label = labels[left]
            elif i - left != right - i:
                label = labels[left if i - left < right - i else right]
            else:
                label = bool(zone) or len(block.text) >= SHORT
        if label:
            kept.append(block.text)
    return "\n".join(kept)


def extract(pages: DataFrame, stop_words: frozenset[str] = STOP_WORDS) -> DataFrame:
    """One row per page: ``RESULT``."""
    small_batches(pages.sparkSession)
    frame = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(h, stop_words) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return frame.mapInArrow(run, RESULT)
