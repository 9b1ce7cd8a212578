"""Multiset fingerprints: order independence, arithmetic, likeness in several scripts, hot and null ids."""

import hashlib
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assaymill.llm import fingerprints

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
PARAGRAPH = st.text(st.sampled_from("ab .dгя漢字ไ\t\u3000"), max_size=12)


@few
@given(st.lists(st.tuples(st.lists(PARAGRAPH, min_size=1, max_size=6), st.lists(PARAGRAPH, min_size=1, max_size=4), st.randoms()),
                min_size=1, max_size=30))
def test_paragraphs_are_a_multiset(spark, cases):
    rows = []
    for i, (one, two, rng) in enumerate(cases):
        mixed = [*one, *two]
        rng.shuffle(mixed)
        rows.append((i, "\n".join(one), "\n".join(two), "\n".join([*one, *two]), "\n".join(mixed)))
    df = spark.createDataFrame(rows, "i int, a string, b string, both string, mixed string")
    prints = df.select(*[fingerprints.fingerprint(F.col(c)).alias(c) for c in ("a", "b", "both", "mixed")])
    for r in prints.select("both", "mixed", "b", fingerprints.add(F.col("a"), F.col("b")).alias("sum"),
                           fingerprints.subtract(F.col("both"), F.col("a")).alias("rest")).collect():
        assert r.both == r.mixed == r.sum and r.rest == r.b


def text_of(rng, letters, joint, words):
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(300)]
    return joint.join(rng.choice(vocabulary) for _ in range(words))


def test_likeness_in_four_scripts(spark):
    rows = []
    for n, (letters, joint) in enumerate([("abcdefghijklm", " "), ("абвгдежзиклмн", " "), ("ابتثجحخدذرزسشص", " "),
                                          ("".join(map(chr, range(0x4E00, 0x4F00))), "")]):
        for k in range(6):
            text = text_of(random.Random(100 * n + k), letters, joint, 300)
            cut = len(text) - len(text) // 4
            other = text_of(random.Random(100 * n + k + 50), letters, joint, 300)
            rows.append((n, text, text[:cut] + other[:len(text) - cut], other))
    df = spark.createDataFrame(rows, "script int, text string, edited string, other string")
    p = df.select("script", *[fingerprints.fingerprint(F.col(c)).alias(c) for c in ("text", "edited", "other")])
    for r in p.select("script", fingerprints.likeness(F.col("text"), F.col("edited")).alias("near"),
                      fingerprints.likeness(F.col("text"), F.col("other")).alias("far")).collect():
        assert r.near > 0.5 and r.far < 0.45 and r.near > r.far + 0.2, r


def test_edits_over_paragraphs_equal_a_fresh_fingerprint(spark):
    rng = random.Random(9)
    texts = ["\n".join(text_of(rng, "abcde", " ", rng.randint(0, 12)) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts += ["", "one line only", "\n", "\n\n\n\n", "ends\n"]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "doc_id long, text string, print string, _slice string")
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    edits = {}
    for i, t in enumerate(texts):
        q, follow = len(t) // 4, texts[(i + 1) % len(texts)]
        edits[i] = t[:len(t) - q] + follow[:q]
    fresh = spark.createDataFrame(list(edits.items()), "doc_id long, text string").select(
        "doc_id", fingerprints.as_hex(fingerprints.fingerprint(F.col("text"))).alias("p"))
    for r in fresh.collect():
        assert got[r.doc_id].edited_fingerprint == r.p
        assert got[r.doc_id].edited_sha256 == hashlib.sha256(edits[r.doc_id].encode()).hexdigest()


def test_hot_and_null_ids_follow_each_other_across_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i} " * (1 + i % 4)) for i in range(1500)] + [(7, "same")] * 40
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        named = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
        got = fingerprints.with_next(named, "doc_id", ["text"], ["h"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    assert len(order) == len(rows)
    follows = {}
    for a, b in zip(order, order[1:] + order[:1]):
        follows.setdefault((a.doc_id, a.text), []).append(b.text)
    mine = {}
    for r in got:
        mine.setdefault((r.doc_id, r.text), []).append(r.text_next)
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in follows.items()}


def test_no_rows(spark):
    assert fingerprints.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_shingle_counts(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(9000)}" for _ in range(n)) for n in (0, 1, 3, 16, 17, 18, 256, 257, 258, 600, 4100)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    words = F.split("text", " ")
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(3)]))
    for r in df.select("i", fingerprints.fingerprint(F.col("text")).alias("p"), runs.alias("runs")).collect():
        hashes = r.runs if texts[r.i] else []
        bits = [sum(h >> b & 1 for h in hashes) for b in range(64)]
        assert r.p[fingerprints.EXACT:] == [bits[i] + (bits[i + 32] << 32) for i in range(32)] + [len(hashes)]
