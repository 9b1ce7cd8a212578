"""The Merkle manifest against a tree built in one piece."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from assaymill.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, digest string, pos int, nodes string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def brute_path(levels, i):
    found = []
    for level in levels[:-1]:
        found.append((i ^ 1) < len(level) and (i ^ 1 < i, level[i ^ 1]))
        i >>= 1
    return found


def brute_fold(d, steps):
    for step in steps:
        d = sha(d) if not step else sha(step[1] + d) if step[0] else sha(d + step[1])
    return d


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows):
    """The report for (doc_id, text, lang, source, n_chars) rows, as a sorted list."""
    def leaf(r, more=0):
        return sha("".join(map(field, (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1]))))

    groups = {}
    for r in rows:
        groups.setdefault("" if r[2] is None else "=" + r[2], []).append(r)
    order = sorted(groups, key=lambda k: k.encode())
    trees = {}
    for k in order:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[k] = brute_levels([leaf(r) for r in groups[k]])
    top = brute_levels([trees[k][-1][0] for k in order])
    out = []
    for n, k in enumerate(order):
        for i, r in enumerate(groups[k]):
            steps = brute_path(trees[k], i) + brute_path(top, n)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = brute_fold(leaf(r, int(hit)), steps)
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], sha("".join(s[1] for s in steps if s)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def reported(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash", 1, "clash") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.report(df).collect()), key=str)


def test_report_with_nulls_ties_and_long_texts(spark):
    rows = [(i, f"text {i} é𝄞", ["en", "de", None, "", "=x", "zz"][i % 6 if i % 3 else 0], "s", i) for i in range(700)]
    rows += [(None, "no id", "en", None, 1), (None, "no id", "en", None, 1), (3, "same id", "en", "s", 2), (3, None, "en", "s", None)]
    rows += [(9000, "", "en", "s", 0), (9001, "long " * 60_000, "one", None, None), (2**62, "x", None, None, 2**62)]
    rows += [(0, "text 0 é𝄞", "en", "s", 0)] * 3
    assert reported(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", "s", 1)], [(None, None, None, None, None)]])
def test_report_on_hardly_any_rows(spark, rows):
    assert reported(spark, rows) == brute(rows)


def test_largest_length_becomes_null(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 0][:1]
    (row,) = reported(spark, [(ids[0], "a", "en", "s", 2**63 - 1)])
    assert row[5] == sha(f"1:{ids[0]}1:s2:en-1:a" if ids[0] < 10 else f"2:{ids[0]}1:s2:en-1:a") and not row[6]


def test_versions_share_untouched_nodes_over_three_layers(spark):
    n = merkle.BLOCK ** 2 + 300
    rows = spark.range(n).select(F.lit("k").alias("key"), F.col("id").alias("at"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"),
                                 F.when(F.col("id") % 9000 == 7, F.sha2(F.lit("other").cast("binary"), 256)).alias("tampered"))
    rows = rows.unionByName(spark.createDataFrame([("l", 0, sha("lone"), None)], rows.schema))
    made = merkle.manifest(rows, ["at"], ["at", "tampered"])
    digests = [sha(str(i)) for i in range(n)]
    levels = brute_levels(digests)
    base = {(r.height, r.pos): r.digest for r in merkle.base_nodes(made).where("key = 'k'").collect()}
    assert base == {(h, i): d for h, level in enumerate(levels) for i, d in enumerate(level)}
    copied = {}
    for r in merkle.versions(made, "tampered").collect():
        copied.setdefault(r.leaf, {})[r.height, r.pos] = r.digest
    assert sorted(copied) == list(range(7, n, 9000))
    for leaf, nodes in copied.items():
        changed = brute_levels([*digests[:leaf], sha("other"), *digests[leaf + 1:]])
        differing = {(h, i): d for h, level in enumerate(changed) for i, d in enumerate(level) if d != levels[h][i]}
        assert {k: d for k, d in nodes.items() if k[1] >= 0} == differing  # the ancestors alone, nothing else
        assert nodes[len(levels), -1] == sha(changed[-1][0] + sha("lone"))
    proofs = merkle.proofs(made, "at bigint", "tampered").where("at % 9000 = 7 or at % 5000 = 0 or leaf = subroot")
    for r in proofs.collect():
        if r.leaf == r.subroot:
            assert r.leaf == sha("lone") and r.steps == ["L" + levels[-1][0]]
        else:
            assert (r.folded == r.root) == (r.at % 9000 != 7) and r.folded == (copied[r.at][len(levels), -1] if r.at % 9000 == 7 else r.root)
