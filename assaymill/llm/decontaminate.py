"""Benchmark decontamination with a generalised suffix automaton.

The words of the benchmark items form one automaton that accepts every run of words of
every item. A document's words are streamed through it; at each word the automaton gives
the longest run ending there that some item contains. Runs of ``window`` words or more are
hits, and so is the whole of an item that is shorter than a window. Training text is
then cut (``clean``): contaminated spans go, and documents that are mostly
contaminated go whole.

Words are lower-cased (A-Z only) runs of letters, digits and characters beyond ASCII.

Size: items are dealt into blocks of at most ``BLOCK_WORDS`` words (longer items in
pieces that overlap by ``window - 1`` words, which keeps every window). A block's words are
what is broadcast; its automaton has at most two states for each word. Tasks keep
one automaton for each block up to ``CACHED`` and build further ones anew for each batch.

Defined cases: null texts have no words; items without words match nothing; repeated items
and items that share an id are one item of that id; an empty benchmark leaves every
document clean. Null item ids count as the text ``null``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import small_batches

WINDOW = 10
BLOCK_WORDS = 200_000
CACHED = 4
RESULT = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
          "contaminated boolean")

_SEPARATORS = bytes(0 if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else b for b in range(256))
_FOLD = bytes(32 if b == 0 else b + 32 if 65 <= b <= 90 else b for b in _SEPARATORS)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


class Automaton:
    """Suffix automaton over the words of several items."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        items = list(items)
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        # States at which a hit ends: that of each window, and of each whole short item.
        self.items: dict[int, set[str]] = {}
        self.short: set[int] = set()
        for name, words in items:
            state = 0
            for i, word in enumerate(words, 1):
                state = self.next[state][word]
                if i >= window:
                    while self.length[self.link[state]] >= window:
                        state = self.link[state]
                    self.items.setdefault(state, set()).add(name)
            if 0 < len(words) < window:
                self.short.add(state)
                self.items.setdefault(state, set()).add(name)
        # The nearest state with hits on the way up from each state, itself included.
        self.mark = [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.mark[state] = state if state in self.items else self.mark[self.link[state]]

    def _extend(self, last: int, word: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (old := nxt[last].get(word)) is not None:
            if length[old] == length[last] + 1:
                return old
            return self._split(last, old, word)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and word not in nxt[at]:
            nxt[at][word] = new
            at = link[at]
        if at >= 0:
            old = nxt[at][word]
            link[new] = old if length[old] == length[at] + 1 else self._split(at, old, word)
        return new

    def _split(self, at: int, old: int, word: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[old]))
        length.append(length[at] + 1)
        link.append(link[old])
        link[old] = copy
        while at >= 0 and nxt[at].get(word) == old:
            nxt[at][word] = copy
            at = link[at]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges [i, j), in order, disjoint; and the items with an occurring hit."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        mark, items, short = self.mark, self.items, self.short
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        state = size = 0
        step = nxt[0]
        for i, word in enumerate(words):
            to = step.get(word)
            if to is None:
                if not state:
                    continue
                state = link[state]
                while state >= 0 and (to := nxt[state].get(word)) is None:
                    state = link[state]
                if state < 0:
                    state = size = 0
                    step = nxt[0]
                    continue
                size = length[state]
            state, size = to, size + 1
            step = nxt[state]
            start = i + 1 - size if size >= window else -1
            at = mark[state]
            while at:
                # What is accepted here is a suffix of the match, if the match is long enough.
                if size >= (length[at] if at in short else window):
                    found |= items[at]
                    if at in short:
                        start = i + 1 - length[at] if start < 0 else min(start, i + 1 - length[at])
                at = mark[link[at]]
            if start >= 0:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, found


def _merged(parts: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    if len(parts) == 1:
        return parts[0]
    out: list[tuple[int, int]] = []
    for a, b in sorted(x for part in parts for x in part):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_AUTOMATA: dict[tuple, Automaton] = {}


def _automaton(block: Broadcast, window: int) -> Automaton:
    if (key := (id(block.value), window)) not in _AUTOMATA:
        if len(_AUTOMATA) >= CACHED:
            _AUTOMATA.pop(next(iter(_AUTOMATA)))
        _AUTOMATA[key] = Automaton([(n, w.split()) for n, w in block.value], window)
    return _AUTOMATA[key]


def item_blocks(items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text",
                block_words: int = BLOCK_WORDS) -> list[Broadcast]:
    """The items' words, broadcast in blocks of bounded size.

    The items come to the driver one row after the other and leave it block by block.
    """
    sc = items.sparkSession.sparkContext
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("name"),
                        F.col(text).alias("text")).toLocalIterator()
    blocks, block, size = [], [], 0
    for row in rows:
        words = words_of(row.text)
        step = max(1, block_words - window + 1)
        pieces = [words] if len(words) <= block_words else [
            words[i:i + block_words] for i in range(0, len(words) - window + 1, step)]
        for piece in pieces:
            if block and size + len(piece) > block_words:
                blocks.append(sc.broadcast(block))
                block, size = [], 0
            if piece:
                block.append((row.name, b" ".join(piece)))
                size += len(piece)
    if block:
        blocks.append(sc.broadcast(block))
    return blocks


def scan_words(words: list[bytes], blocks: list[Broadcast], window: int) -> tuple[list[tuple[int, int]], set[str]]:
    parts, found = [], set()
    for block in blocks:
        spans, names = _automaton(block, window).scan(words)
        parts.append(spans)
        found |= names
    return (_merged(parts) if parts else []), found


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id",
                  text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: ``RESULT``."""
    small_batches(docs.sparkSession)
    blocks = item_blocks(items, window, block_words=block_words)
    frame = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            n_words, n_hit, n_items, digests = [], [], [], []
            for value in batch.column("text"):
                words = words_of(value.as_py())
                spans, found = scan_words(words, blocks, window)
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in spans))
                n_items.append(len(found))
                digests.append(hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(n_items, pa.int64()), pa.array(digests, pa.string()),
                 pa.array([n > 0 for n in n_hit], pa.bool_())], [c.split()[0] for c in RESULT.split(", ")])

    return frame.mapInArrow(run, RESULT)


def cut(text: str, spans: list[tuple[int, int]], mark: str = " ") -> str:
    """The text without the words of ``spans``, and what stood between them."""
    data = text.encode("utf-8", "replace")
    bounds = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:bounds[a][0]].rstrip())
        at = bounds[b - 1][1]
    out.append(data[at:].lstrip())
    return mark.join(x.decode("utf-8", "ignore") for x in out if x)


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, longest: int = WINDOW - 1,
          coverage: float = 0.5, text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without contamination, with their own columns.

    Spans of more than ``longest`` words, and whole short items, are cut out of the text;
    a document whose hit words are more than ``coverage`` of its words goes whole.
    """
    small_batches(docs.sparkSession)
    blocks = item_blocks(items, window, block_words=block_words)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            kept, texts = [], []
            for i, value in enumerate(batch.column(at)):
                value = value.as_py()
                words = words_of(value)
                spans, _ = scan_words(words, blocks, window)
                spans = [s for s in spans if s[1] - s[0] > longest or s[1] - s[0] < window]
                if spans and sum(b - a for a, b in spans) > coverage * len(words):
                    continue
                kept.append(i)
                texts.append(cut(value, spans) if spans else value)
            rows = batch.take(pa.array(kept, pa.int64()))
            yield rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
