"""Spelling variants against comparing every pair of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assaymill.llm import variants

SCHEMA = "doc_id long, text string, word string, n string, key double"


def distance_one(a, b):
    """Exactly one insertion, deletion or replacement."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_counts(rows):
    seen = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= 5:
                seen[word] += 1
    return {w: n for w, n in seen.items() if n >= 3}


def brute(counts):
    near = {w: [v for v in counts if distance_one(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), None if form[w] is None else counts[form[w]]))
    return out


def result(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash", 1.0) for r in rows], SCHEMA)
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.grouped(df).collect()}


def test_grouped_against_all_pairs(spark):
    r = random.Random(5)
    letters = "abcdeéñÿ×"
    words = ["".join(r.choice(letters[:4]) for _ in range(r.randint(5, 7))) for _ in range(250)] + ["aaaaa", "aaaaaa", "aaaaaaa", "ababababab", "abababababa"]
    for _ in range(400):  # chains of edits, at every place
        w, i = r.choice(words), r.randint(0, 7)
        words.append(r.choice([w[:i] + r.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + r.choice(letters) + w[i + 1:]]))
    rows = [(k, " ".join(r.choice(words).capitalize() if k % 2 else r.choice(words) for _ in range(200))) for k in range(60)]
    rows += [(None, " ".join(words)), (None, " ".join(words)), (0, None), (1, ""), (2, "\0 \n 12 ßéé"), (3, " ".join(words * 40)), rows[0]]
    rows += [(i, "xylophones") for i in range(400)]  # some lose a letter by their id
    expected = brute(brute_counts(rows))
    assert len([x for x in expected if x[1] != x[2] and x[1]]) > 0 and len(expected) > 300
    assert result(spark, rows) == expected


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "one two")], [(1, "single single single")]])
def test_hardly_any_words(spark, rows):
    assert result(spark, rows) == brute(brute_counts(rows))


@settings(max_examples=400, deadline=None)
@given(st.text("abc", min_size=5, max_size=11), st.integers(0, 11), st.sampled_from("abc"), st.integers(0, 2), st.randoms())
def test_near_words_share_a_key(word, at, letter, kind, rng):
    """Whatever the order of the bigrams, two near words meet one way round or the other."""
    at = min(at, len(word) - (kind > 0))
    other = [word[:at] + letter + word[at:], word[:at] + word[at + 1:], word[:at] + letter + word[at + 1:]][kind]
    if other == word or len(other) < 5:
        return
    order = {a + b: (rng.randint(1, 4), a + b) for a in "abc" for b in "abc"}

    def both(w):
        places = variants.prefix(w, order)
        first, second = variants.pivots(w, places, order)
        pairs = [(a, b) for a in places for b in places if a + 2 <= b]
        cost = {p: order[word_[p:p + 2]][0] for word_ in [w] for p in places}
        assert first + 2 <= second and cost[first] + cost[second] == min(cost[a] + cost[b] for a, b in pairs)
        return variants.index_keys(w, first, second), variants.lookup_keys(w, places)

    (index_a, lookup_a), (index_b, lookup_b) = both(word), both(other)
    assert index_a & lookup_b or index_b & lookup_a
