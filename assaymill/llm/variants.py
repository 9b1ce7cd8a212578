"""Spelling variants: words at one edit from each other, found by pivotal grams.

Bigrams stand in one order, rarest among the words first. A word's prefix is its three rarest
bigrams (all that tie with the third included). Its pivots are two of these that do
not overlap, chosen by dynamic programming for the least sum of frequencies. One edit
cannot touch both pivots, and of two near words the one whose prefix ends earlier in the order has
every pivot that the edit left intact in the prefix of the other. So pivots are indexed
and looked up with the other words' prefixes, both ways round.

Position limits: an intact pivot stands at the same distance from the end (edit on its left) or from
the start (edit on its right), and the limits differ by one at most. An edit
before the second pivot leaves all from there on as it is; any other edit leaves all up to the
end of the first pivot. The rest of the word, ``span`` long on the indexed side, is cut in half
and one half is intact, too. The index key is made of ``span`` and the intact parts, so words that only
share a frequent bigram never meet. Candidates are verified by their edit distance.

Defined cases: a null text has no words, a null id counts as empty; a text of any length
is read whole; repeated rows count each time; no words give no rows. Only
the named columns are read, so others may be called anything.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import small_batches, stored, text_groups

RUN = re.compile("[a-zÀ-ÿ]+")  # after A-Z became a-z
DROPPED_EVERY = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
HELD = 1 << 18  # words that a task counts before it passes them on
PREFIX = 3  # two edits' worth of bigrams for one edit, and one more


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n) over whole texts, with the letter dropped that the document's id says."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            ids = batch.column(0)
            for at, texts in text_groups(batch.column(1)):
                for k, text in enumerate(texts):
                    if not text:
                        continue
                    start = zlib.crc32(f"{ids[at + k].as_py() or ''}:".encode())
                    for word, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % DROPPED_EVERY == 0:
                            i = h % len(word)
                            word = word[:i] + word[i + 1:]
                        if len(word) >= least_length:
                            seen[word] += n
                    if len(seen) >= HELD:
                        yield passed_on()
        yield passed_on()

    parts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def gram_order(words: DataFrame) -> dict[str, tuple[int, str]]:
    """Each bigram's place in the order: in how many words it stands, then itself.

    Bounded by the alphabet: 90 letters make at most 8,100 bigrams.
    """
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.array_distinct(F.transform(places, lambda i: F.substr("word", i, F.lit(2))))).alias("gram"))
    return {r.gram: (r.n, r.gram) for r in grams.groupBy("gram").agg(F.count("*").alias("n")).toLocalIterator()}


def prefix(word: str, order: dict[str, tuple[int, str]]) -> list[int]:
    """Where the word's rarest bigrams stand: ``PREFIX`` of them, and all equal to the last."""
    keys = [order[word[i:i + 2]] for i in range(len(word) - 1)]
    last = sorted(keys)[:PREFIX][-1]
    return [i for i, key in enumerate(keys) if key <= last]


def pivots(word: str, places: Sequence[int], order: dict[str, tuple[int, str]]) -> tuple[int, int]:
    """Two bigrams of the prefix that do not overlap, with the least sum of frequencies.

    ``best`` is the cheapest first one among those that end before the second begins; there
    always are two, because one bigram overlaps with two others at most.
    """
    cost = {i: order[word[i:i + 2]][0] for i in places}
    chosen, waiting, best = None, 0, None
    for i in places:
        while places[waiting] + 2 <= i:
            if best is None or cost[places[waiting]] < cost[best]:
                best = places[waiting]
            waiting += 1
        if best is not None and (chosen is None or cost[best] + cost[i] < cost[chosen[0]] + cost[chosen[1]]):
            chosen = best, i
    return chosen


def _key(side: str, span: int, *parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join((side, str(span), *parts))) - (1 << 63)


def index_keys(word: str, first: int, second: int) -> set[int]:
    """What an intact part of the word looks like, for each place at which an edit may be."""
    half, rest = second // 2, len(word) - first - 2
    kept = rest - rest // 2
    return {
        _key("a", second, word[half:]),  # an edit in the first half of what stands before the second pivot
        _key("b", second, word[:half], word[second:]),  # in its second half
        _key("c", rest, word[:first + 2 + rest // 2]),  # in the second half of what follows the first pivot
        _key("d", rest, word[:first + 2], word[len(word) - kept:]),  # in its first half
    }


def lookup_keys(word: str, places: Sequence[int]) -> set[int]:
    """The index keys of near words that have one of ``places`` as the intact pivot."""
    keys = set()
    for i in places:
        for span in (i - 1, i, i + 1):
            half = span // 2
            if span >= 2 and half <= i:
                tail = i - (span - half)  # where the second half would begin here
                if tail >= 0:
                    keys.add(_key("a", span, word[tail:]))
                keys.add(_key("b", span, word[:half], word[i:]))
        rest = len(word) - i - 2
        for span in (rest - 1, rest, rest + 1):
            half = span // 2
            if span >= 2 and half <= rest:
                keys.add(_key("c", span, word[:i + 2 + half]))
                if span - half <= rest:
                    keys.add(_key("d", span, word[:i + 2], word[len(word) - (span - half):]))
    return keys


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), both ways round, for all pairs of ``words`` (word, n) at edit distance one.

    Words are distinct and at least five code points long.
    """
    order = words.sparkSession.sparkContext.broadcast(gram_order(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = order.value
        for batch in batches:
            source, keys, indexed = [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                places = prefix(word, ranks)
                mine, theirs = index_keys(word, *pivots(word, places, ranks)), lookup_keys(word, places)
                keys += [*mine, *theirs]
                indexed += [True] * len(mine) + [False] * len(theirs)
                source += [i] * (len(mine) + len(theirs))
            rows = batch.take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(indexed), rows.column(0), rows.column(1)],
                                             ["key", "indexed", "word", "n"])

    small_batches(words.sparkSession)
    entries = stored(words.select("word", "n").mapInArrow(run, "key bigint, indexed boolean, word string, n bigint"), "gram-keys")
    index = entries.where("indexed").select("key", "word", "n")
    lookups = entries.where("not indexed").select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = index.join(lookups, "key").where("word <> near")
    found = met.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")
    back = found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.unionByName(back).distinct()


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest n, where that is twice the word's n or more.

    Ties go to the smallest word in code-point order, which is the order of UTF-8 bytes.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    top = pairs.groupBy("word").agg(best.alias("best"), F.count("*").alias("n_near"))
    known = words.join(top, "word", "left")
    taken = -F.col("best.less") >= 2 * F.col("n")
    return known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """``formed`` with ``root``: the last word on the way along the forms.

    The count at least doubles with every form, so a way is never longer than the binary logarithm of the
    largest count, and each round doubles how far a word sees.
    """
    named = stored(formed.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        onward = named.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(named.join(onward, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        named = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return formed.join(named, "word")


def grouped(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = stored(word_counts(docs).where(F.col("n") >= LEAST_COUNT), "words")
    return roots(stored(forms(words, near_pairs(words)), "forms"))
