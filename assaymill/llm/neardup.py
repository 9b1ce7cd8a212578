"""Near-duplicate classes by weighted MinHash.

Texts are compared by their shingles of five words, each weighted by
``(1 + ln tf) * idf``. Improved consistent weighted sampling draws ``ROWS * BANDS`` samples
per text; two texts agree on one with the probability of their weighted Jaccard
similarity. Texts with equal samples in a whole band are candidates, candidates are
verified by their exact weighted Jaccard similarity, and verified links form
classes.

``idf`` is 1 for shingles in up to half of the texts, or up to ``FEW`` texts, and falls with
the logarithm of the share of texts beyond that: it plays down what everybody quotes, but
not the text of a group of copies that holds a third of all rows. Document frequencies cover all texts; they are kept per
hashed bin, less the median bin, which stands for chance meetings.

Texts whose words are the same are one node from the start. Within a bucket the nodes are
sorted by their next samples and those up to ``REACH`` places apart become candidates, so
work is linear in a bucket however large it is; the sort is a range partitioning, so a
bucket may span tasks. Direct neighbours are verified first; of the others only those that
are not in one class by then. Buckets of up to ``REACH`` + 1 nodes are complete. The nodes of
larger ones also meet by their rarest shingles: two texts of similarity t share one of the
first shingles, rare ones first, that hold 1 - t of the larger text's weight and
1 - 2t / (1 + t) of the smaller one's. That finds every pair which is still in two
classes; passages that a whole bucket quotes stand behind the rare shingles and join nothing.

Defined cases: null texts count as empty; texts of fewer than five words have their words
as one shingle; texts without words are copies of each other if they are the same text.
Rows are told apart by id and text, so null and repeated ids are fine; of rows that are
equal in both one is kept.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import groups, small_batches, stored, text_groups
from assaymill.llm.components import components
from assaymill.llm.decontaminate import words_of

SHINGLE = 5
ROWS, BANDS = 4, 12
SIMILARITY = 0.8
ESTIMATE = 0.6  # candidates whose samples agree less are 3.5 standard errors below SIMILARITY
BINS = 1 << 16
COMMON = 0.5  # share of texts up to which a shingle has full weight
FEW = 500  # texts up to which a shingle has full weight, however few there are in all
LEAST_IDF = 0.1
IDS = (1 << 48) - 1
REACH = 6
ALIKE = 0.4  # as ``ESTIMATE``, for pairs that share a rare shingle: 7 standard errors below
SKETCH = 23  # least number of samples that agree in their last two bits: 7 standard errors below SIMILARITY
SIZES = np.log(1.25) / 4  # step between classes of weight, in logarithms
BLOCK = 1 << 16  # shingles sampled at a time


HELD_WORDS = 1 << 18  # words that a task keeps the hashes of; a worker is used again, so they go with the task


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def _released(run):
    """``run`` over the batches of a task, without the hashes it kept once it is over."""
    def over(batches):
        try:
            yield from run(batches)
        finally:
            _hashes.clear()

    return over


def _mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = (x ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def shingles(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of several texts: the text, the 48-bit id and the number of occurrences of each distinct shingle."""
    lookup = _hashes.__getitem__
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.zeros(int(sizes.sum()) + SHINGLE * len(words), np.uint64)
    at = np.cumsum(sizes + SHINGLE) - sizes - SHINGLE
    for start, text in zip(at.tolist(), words):
        flat[start:start + len(text)] = np.fromiter(map(lookup, text), np.uint64, len(text))
    counts = np.where(sizes > 0, np.maximum(1, sizes - SHINGLE + 1), 0)
    owner = np.repeat(np.arange(len(words)), counts)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + at[owner]
    value = np.zeros(len(owner), np.uint64)
    for i in range(SHINGLE):
        value = value * np.uint64(0xD6E8FEB86659FD93) + flat[first + i]
    keys = owner.astype(np.uint64) << np.uint64(48) | _mixed(value) >> np.uint64(16)
    keys, times = np.unique(keys, return_counts=True)
    return (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64(IDS), times


def _bin(ids: np.ndarray) -> np.ndarray:
    return (_mixed(ids, 0x51ED270B) >> np.uint64(48)).astype(np.int64)


@functools.cache
def _quantiles() -> tuple[np.ndarray, np.ndarray]:
    """Of Gamma(2, 1) at 65536 even steps: the quantile and its logarithm."""
    u = (np.arange(65536) + 0.5) / 65536
    low, high = np.zeros(65536), np.full(65536, 40.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - np.exp(-x) * (1 + x) < u
        low, high = np.where(below, x, low), np.where(below, high, x)
    return x.astype(np.float32), np.log(x).astype(np.float32)


def samples(owner: np.ndarray, ids: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """``ROWS * BANDS`` samples (32 bits each) per text; 0 for texts without shingles.

    For every sample and shingle: r and c from Gamma(2, 1), beta uniform, all of them
    hashed from the shingle; t = floor(ln w / r + beta); the shingle with the least
    ln c - r (t - beta + 1) is drawn, together with its t.
    """
    count = ROWS * BANDS
    r_of, log_c_of = _quantiles()
    least = np.full((count, texts), np.iinfo(np.int64).max)
    low16 = np.uint64(0xFFFF)
    for i in range(0, len(ids), BLOCK):
        own, some = owner[i:i + BLOCK], ids[i:i + BLOCK]
        log_w = np.log(weights[i:i + BLOCK]).astype(np.float32)
        plain = not log_w.any()
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        base, heads = _mixed(some), own[starts]
        name = base & np.uint64(0xFFFFFFFF)
        for k in range(count):
            h = _mixed(base, 0xA0761D6478BD642F * (k + 1) & (2**64 - 1))
            r = r_of[h >> np.uint64(48)]
            log_c = log_c_of[h >> np.uint64(32) & low16]
            beta = (h & np.uint64(0xFFFFFFFF)).astype(np.float32) * np.float32(2**-32)
            if plain:
                value, drawn = log_c - r * (1 - beta), name
            else:
                t = np.floor(log_w / r + beta)
                value = log_c - r * (t - beta + 1)
                drawn = name + t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)
            # As integers in the order of the floats, with the drawn shingle below.
            bits = value.view(np.int32)
            bits = bits ^ (bits >> 31 & np.int32(0x7FFFFFFF))
            packed = bits.astype(np.int64) << 32 | drawn.view(np.int64)
            best = np.minimum.reduceat(packed, starts)
            least[k, heads] = np.minimum(least[k, heads], best)
    out = (least & 0xFFFFFFFF).astype(np.uint32).view(np.int32).T
    out[least[0] == np.iinfo(np.int64).max] = 0
    return np.ascontiguousarray(out)


def weigh(ids: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(times)) * idf[_bin(ids)]


def similarity(a: list[bytes], b: list[bytes], idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts' words."""
    owner, ids, times = shingles([a, b])
    weights = weigh(ids, times, idf)
    cut = int(np.searchsorted(owner, 1))
    (x, u), (y, v) = (ids[:cut], weights[:cut]), (ids[cut:], weights[cut:])
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = np.minimum(u[i], v[j]).sum()
    total = u.sum() + v.sum() - shared
    return float(shared / total) if total else 0.0


def frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, float]:
    """Of all texts: those with a shingle in each hashed bin, and the number of texts with words."""
    def run(batches):
        sums, seen = np.zeros(BINS, np.int64), 0
        for batch in batches:
            for _, texts in text_groups(batch.column("text")):
                words = [words_of(t) for t in texts]
                sums += np.bincount(_bin(shingles(words)[1]), minlength=BINS)
                seen += sum(map(bool, words))
        bins = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, bins]), pa.array(np.r_[seen, sums[bins]])], ["bin", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(_released(run), "bin bigint, n bigint") \
        .groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(BINS + 1)
    sums[counted["bin"].to_numpy()] = counted["n"].to_numpy()  # -1, the last, has the number of texts
    return sums[:-1], sums[-1]


def idf_of(sums: np.ndarray, total: float) -> np.ndarray:
    total = max(FEW / COMMON, total)
    share = np.clip((sums - np.median(sums)) / total, 1 / total, 1)
    return np.clip(np.log(share) / np.log(COMMON), LEAST_IDF, 1).astype(np.float64)


def idf_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The weight of each hashed bin of shingles, from the document frequencies over all texts."""
    return idf_of(*frequencies(docs, text))


def signatures(docs: DataFrame, idf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, h (of the text), node (128 bits of the words), sample (array of int)."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(content).alias("h"), content.alias("text"))
    count = ROWS * BANDS

    def run(batches):
        for batch in batches:
            nodes, worded, parts = [], [], [np.zeros((0, count), np.int32)]
            for _, texts in text_groups(batch.column("text")):
                words = [words_of(t) for t in texts]
                nodes += [xxhash.xxh3_128_digest(b" ".join(w)) if w else xxhash.xxh3_128_digest(t.encode(), seed=1)
                          for w, t in zip(words, texts)]
                worded += map(bool, words)
                owner, ids, times = shingles(words)
                parts.append(samples(owner, ids, weigh(ids, times, idf.value), len(texts)))
            flat = np.concatenate(parts).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(nodes, pa.binary()),
                 pa.array(worded, pa.bool_()),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, count), pa.int32()), pa.array(flat))],
                ["doc_id", "h", "node", "worded", "sample"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_released(run), f"doc_id {kind}, h bigint, node binary, worded boolean, sample array<int>")


def neighbours(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates (a, b, step), a < b: at most ``REACH`` places apart in some band's bucket; crowded ids.

    ``nodes`` has ``id`` and ``sample``. Ids are crowded in a bucket of more than ``REACH`` + 1.
    """
    edge = REACH + 1

    def bands(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            sample = batch.column("sample").values.to_numpy().view(np.uint32).astype(np.uint64).reshape(len(ids), -1)
            wide = np.concatenate([sample, sample[:, :ROWS]], axis=1)
            for band in range(BANDS):
                key = np.full(len(ids), band, np.uint64)
                order = np.zeros(len(ids), np.uint64)
                for i in range(ROWS):
                    key = _mixed(key * np.uint64(31) + wide[:, band * ROWS + i])
                    order = order << np.uint64(16) | wide[:, (band + 1) * ROWS + i] & np.uint64(0xFFFF)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(order.view(np.int64)), pa.array(ids)], ["bucket", "next", "id"])

    def close(batches):
        head: list[tuple[int, int]] = []
        tail = np.zeros((0, 2), np.int64)
        for batch in batches:
            rows = np.c_[batch.column("bucket").to_numpy(), batch.column("id").to_numpy()]
            head += [tuple(x) for x in rows[:edge - len(head)].tolist()]
            old, rows = len(tail), np.concatenate([tail, rows])
            for step in range(1, REACH + 1):
                # Pairs that end in this batch.
                first = max(0, old - step)
                left, right = rows[first:len(rows) - step], rows[first + step:]
                same = left[:, 0] == right[:, 0]
                n = int(same.sum())
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(left[same, 1]), pa.array(right[same, 1]), pa.array(np.full(n, step, np.int64)),
                         *[pa.nulls(n, pa.int64())] * 3], names)
            full = np.flatnonzero(rows[:len(rows) - edge, 0] == rows[edge:, 0])
            if len(full):
                crowd = np.unique(rows[(full[:, None] + np.arange(edge + 1)).reshape(-1), 1])
                yield pa.RecordBatch.from_arrays([pa.array(crowd), *[pa.nulls(len(crowd), pa.int64())] * 5], names)
            tail = rows[-edge:]
        if head:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            ends = [*((part, i, *x) for i, x in enumerate(head)), *((part, edge + i, *x) for i, x in enumerate(tail.tolist()))]
            columns = list(zip(*ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[3], pa.int64()), pa.nulls(len(ends), pa.int64()), pa.nulls(len(ends), pa.int64()),
                 *[pa.array(c, pa.int64()) for c in columns[:3]]], names)

    names = ["a", "b", "step", "part", "place", "bucket"]
    banded = nodes.select("id", "sample").mapInArrow(bands, "bucket bigint, next bigint, id bigint")
    dealt = banded.repartitionByRange("bucket", "next", "id").sortWithinPartitions("bucket", "next", "id")
    found = stored(dealt.mapInArrow(close, ", ".join(f"{n} bigint" for n in names)), "neighbours")
    # Where a bucket crosses from one partition into the next: at most 2 * edge rows of each.
    ends: dict[int, list[list[tuple[int, int]]]] = {}
    for r in found.where("part is not null").orderBy("part", "place").collect():
        ends.setdefault(r.part, [[], []])[r.place >= edge].append((r.bucket, r.a))
    crossing, crowd, before = [], [], []
    for head, tail in ends.values():
        for i, (bucket, a) in enumerate(before):
            crossing += [(a, b, len(before) - i + j) for j, (other, b) in enumerate(head)
                         if other == bucket and len(before) - i + j <= REACH]
        around = before + head
        for i in range(len(around) - edge):
            if around[i][0] == around[i + edge][0]:
                crowd += [(a,) for _, a in around[i:i + edge + 1]]
        before = tail if len(tail) == edge else (before + tail)[-edge:]
    pairs = found.where("part is null and b is not null").select("a", "b", "step")
    crowded = found.where("part is null and b is null").select("a")
    if crowd:
        crowded = crowded.unionByName(nodes.sparkSession.createDataFrame(sorted(set(crowd)), "a bigint"))
    if crossing:
        pairs = pairs.unionByName(nodes.sparkSession.createDataFrame(crossing, "a bigint, b bigint, step bigint"))
    pairs = pairs.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.min("step").alias("step"))
    return pairs, crowded.select(F.col("a").alias("id")).distinct()


def rare_entries(owner: np.ndarray, ids: np.ndarray, weights: np.ndarray, sums: np.ndarray, texts: int,
                 least: float) -> tuple[np.ndarray, ...]:
    """owner, key, weight of the text, weight from the shingle on, and whether the entry probes.

    Shingles stand in the order of ``sums``, rare ones first. A text is found under those
    before which less than 1 - 2t / (1 + t) of its weight stands, and looks among texts of its
    weight or less with those before which less than 1 - t stands. The key holds the shingle
    and the class of weight; a text looks only in classes that can still reach t from there.
    """
    order = np.lexsort((ids, sums[_bin(ids)], owner))
    owner, ids, weights = owner[order], ids[order], weights[order]
    whole = np.bincount(owner, weights, texts)
    rest = whole[owner] - (np.cumsum(weights) - weights - (np.cumsum(whole) - whole)[owner])
    all_, slack = whole[owner], 1 - 1e-9
    found = np.flatnonzero(rest >= 2 * least / (1 + least) * all_ * slack)
    looks = np.flatnonzero(rest >= least * all_ * slack)

    def size(weight: np.ndarray) -> np.ndarray:
        return np.floor(np.log(weight) / SIZES).astype(np.int64)

    low = size(least * all_[looks] * slack)
    high = size(np.minimum(all_, rest * (1 + least) / least - all_)[looks] / slack)
    times = np.maximum(high - low, 0) + 1
    looks, low = np.repeat(looks, times), np.repeat(low, times)
    low += np.arange(len(low)) - np.repeat(np.cumsum(times) - times, times)
    at, sizes = np.r_[found, looks], np.r_[size(all_[found]), low]
    keys = _mixed(ids[at] ^ _mixed(sizes.view(np.uint64), 0x2545F491))
    return owner[at], keys.view(np.int64), all_[at], rest[at], np.arange(len(at)) >= len(found)


def sketches(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last two bits of each text's samples, as two numbers."""
    half = ROWS * BANDS // 2
    bits = (sample.reshape(-1, 2, half) & 3).astype(np.int64) << (2 * np.arange(half))
    both = bits.sum(axis=2)
    return both[:, 0], both[:, 1]


def _agreeing(a: str, b: str) -> Column:
    """How many of the two-bit fields of two sketches are equal."""
    apart = F.col(a).bitwiseXOR(F.col(b))
    fields = F.lit(sum(1 << 2 * i for i in range(ROWS * BANDS // 2)))
    return F.lit(ROWS * BANDS // 2) - F.bit_count(apart.bitwiseOR(F.shiftright(apart, 1)).bitwiseAND(fields))


def by_rare_shingles(texts: DataFrame, idf, sums, least: float) -> DataFrame:
    """Candidates (a, b, la, lb), a < b, of different labels: all pairs that can have similarity ``least``.

    ``texts`` has ``id``, ``label``, ``sample`` and ``text``.
    """
    def entries(batches):
        last = None
        for batch in batches:
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            again = np.r_[last is not None and ids[0] == last, ids[1:] == ids[:-1]] if len(ids) else np.zeros(0, bool)
            if len(ids):
                last = ids[-1]
            one, two = sketches(batch.column("sample").flatten().to_numpy().reshape(len(ids), -1))
            for start, some in text_groups(batch.column("text")):
                words = [[] if again[start + i] else words_of(t) for i, t in enumerate(some)]
                owner, shingle, times = shingles(words)
                of, key, whole, rest, probes = rare_entries(
                    owner, shingle, weigh(shingle, times, idf.value), sums.value, len(some), least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ids[start + of]), pa.array(labels[start + of]), pa.array(whole),
                     pa.array(rest), pa.array(probes), pa.array(one[start + of]), pa.array(two[start + of])], names)

    def shared(batches):
        # Of the sorted entries those whose key has two labels; a run at the end of a batch is kept.
        for batch in batches:
            key, label = batch.column("key").to_numpy(), batch.column("label").to_numpy()
            if not len(key):
                continue
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            several = np.minimum.reduceat(label, starts) < np.maximum.reduceat(label, starts)
            several[[0, -1]] = True
            yield batch.filter(pa.array(np.repeat(several, np.diff(np.r_[starts, len(key)]))))

    names = ["key", "id", "label", "whole", "rest", "probes", "one", "two"]
    kinds = "key bigint, id bigint, label bigint, whole double, rest double, probes boolean, one bigint, two bigint"
    listed = stored(texts.mapInArrow(_released(entries), kinds), "rare")
    kept = stored(listed.repartitionByRange("key", "label", "id").sortWithinPartitions("key", "label", "id")
                  .mapInArrow(shared, kinds), "rare_shared")
    # Pairs inside the label that holds most of a key are never formed.
    most = kept.groupBy("key", "label").agg(F.count("*").alias("n"), F.max("probes").alias("p"), F.min("probes").alias("f")) \
        .groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.count("*").alias("labels"),
                            F.max("p").alias("p"), F.min("f").alias("f")) \
        .where("labels > 1 and p and not f").select("key", "most")
    kept = stored(kept.join(most.hint("merge"), "key").withColumn("main", F.col("label") == F.col("most")).drop("most"), "rare_main")
    found, looks = kept.where("not probes").alias("f"), kept.where("probes").alias("l")
    bound = (F.col("f.whole") + F.col("l.whole")) * (least / (1 + least) * (1 - 1e-9))
    meet = (F.col("f.key") == F.col("l.key")) & (F.col("f.label") != F.col("l.label")) \
        & (F.col("f.whole") <= F.col("l.whole") * (1 + 1e-9)) & (F.least("f.rest", "l.rest") >= bound) \
        & (_agreeing("f.one", "l.one") + _agreeing("f.two", "l.two") >= SKETCH)
    pairs = [f.alias("f").join(l.alias("l").hint("merge"), meet).select(
        F.least("f.id", "l.id").alias("a"), F.greatest("f.id", "l.id").alias("b"),
        F.when(F.col("f.id") < F.col("l.id"), F.col("f.label")).otherwise(F.col("l.label")).alias("la"),
        F.when(F.col("f.id") < F.col("l.id"), F.col("l.label")).otherwise(F.col("f.label")).alias("lb"))
        for f, l in ((found.where("not main"), looks), (found.where("main"), looks.where("not main")))]
    return pairs[0].unionByName(pairs[1]).distinct()


@dataclass(frozen=True)
class Classes:
    rows: DataFrame  # doc_id, h, id of the node: one row per document
    nodes: DataFrame  # id, doc_id and h of the first row, class_id, class_h, n


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> Classes:
    """The class of every document: the id of its first document (by id, then by a hash of the text)."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    sums, total = frequencies(docs, text)
    shared, rarity = (spark.sparkContext.broadcast(x) for x in (idf_of(sums, total), sums))
    signed = stored(signatures(docs, shared, doc_id, text), "signatures")
    nodes = stored(
        signed.groupBy("node").agg(F.min(F.struct("doc_id", "h")).alias("head"), F.first("worded").alias("worded"),
                                   F.first("sample").alias("sample"), F.count("*").alias("n"))
        .select(F.monotonically_increasing_id().alias("id"), "node", "head.*", "worded", "sample", "n"), "nodes")

    worded = nodes.where("worded")
    pairs, crowded = neighbours(worded)
    left = worded.select(F.col("id").alias("a"), F.struct("doc_id", "h").alias("x"), F.col("sample").alias("sa"))
    right = worded.select(F.col("id").alias("b"), F.struct("doc_id", "h").alias("y"), F.col("sample").alias("sb"))
    agree = F.aggregate(F.zip_with("sa", "sb", lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, p: s + p)
    likely = stored(
        pairs.join(left, "a").join(right, "b").where(agree >= int(ESTIMATE * ROWS * BANDS))
        .select("a", "b", "x", "y", "step"), "candidates")

    content = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(content).alias("h"), content.alias("text"))

    def verify(batches):
        for batch in batches:
            sizes = [pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False) for c in ("u", "v")]
            for i, j in groups(sizes[0] + sizes[1]):
                some = batch.slice(i, j - i)
                keep = [similarity(words_of(u), words_of(v), shared.value) >= least
                        for u, v in zip(some.column("u").to_pylist(), some.column("v").to_pylist())]
                yield some.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def verified(candidates: DataFrame) -> DataFrame:
        # Both texts of each candidate meet under the candidate, not under a text.
        wanted = candidates.select("a", "b", F.explode(F.array(
            F.struct(F.lit(0).alias("side"), "x.*"), F.struct(F.lit(1).alias("side"), "y.*"))).alias("w")).select(
            "a", "b", "w.side", F.col("w.doc_id").alias("of"), F.col("w.h").alias("of_h"))
        # Merged at every size, so that the plan for few candidates is the plan for many.
        met = wanted.join(texts.hint("merge"), F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("of_h") == F.col("h")))
        both = met.groupBy("a", "b").agg(
            F.first(F.when(F.col("side") == 0, F.col("text")), ignorenulls=True).alias("u"),
            F.first(F.when(F.col("side") == 1, F.col("text")), ignorenulls=True).alias("v"))
        return stored(both.mapInArrow(_released(verify), "a bigint, b bigint"), "verified")

    links = verified(likely.where("step = 1"))
    labels = components(links)
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    apart = likely.where("step > 1").join(of_a, "a", "left").join(of_b, "b", "left").where(
        F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b", "x", "y")
    more = verified(apart)
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(links)

    if not crowded.isEmpty():
        label = labels.select(F.col("node").alias("id"), "label")
        heads = worded.join(crowded.hint("merge"), "id").join(label.hint("merge"), "id", "left").select(
            "id", F.coalesce("label", "id").alias("label"), F.col("doc_id").alias("of"), F.col("h").alias("of_h"), "sample")
        met = heads.join(texts.hint("merge"), F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("of_h") == F.col("h")))
        pairs = by_rare_shingles(met.select("id", "label", "sample", "text"), shared, rarity, least)
        alike = stored(
            pairs.join(left, "a").join(right, "b").where(agree >= int(ALIKE * ROWS * BANDS))
            .select("a", "b", "la", "lb", "x", "y", agree.alias("agree")), "alike")
        # The likeliest pair of every two classes first; the others where it has not joined them.
        two = [F.least("la", "lb"), F.greatest("la", "lb")]
        first = alike.groupBy(*(c.alias(n) for c, n in zip(two, ("la", "lb")))).agg(
            F.max_by(F.struct("a", "b", "x", "y"), F.struct("agree", "a", "b")).alias("pair")).select("pair.*")
        more = verified(first)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)
        of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("na"))
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("nb"))
        rest = alike.join(of_a, "a", "left").join(of_b, "b", "left").where(
            F.coalesce("na", "a") != F.coalesce("nb", "b")).select("a", "b", "x", "y")
        more = verified(rest.join(first.select("a", "b"), ["a", "b"], "left_anti"))
        if not more.isEmpty():
            labels = components(links.unionByName(more))
    placed = stored(nodes.join(labels, nodes.id == labels.node, "left").select(
        "id", nodes.node, "doc_id", "h", "n", F.coalesce("label", "id").alias("label")), "placed")
    first = placed.groupBy("label").agg(
        F.min(F.struct("doc_id", "h")).alias("head"), F.sum("n").alias("class_size"))
    named = stored(placed.join(first, "label").select(
        "id", "node", F.col("head.doc_id").alias("class_id"), F.col("head.h").alias("class_h"), "class_size"), "classes")
    rows = signed.select("doc_id", "h", "node").join(named, "node").select(
        "doc_id", "h", "class_id", "class_h", "class_size")
    return Classes(rows, named)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept (it is the first of its class)."""
    rows = classify(docs, doc_id, text).rows
    return rows.select("doc_id", "class_id", "class_size", (
        F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("h") == F.col("class_h"))).alias("kept"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first document of each class, with its own columns."""
    heads = classify(docs, doc_id, text).rows.where(
        F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("h") == F.col("class_h")))
    heads = stored(heads.groupBy(F.col("doc_id").alias("_of"), F.col("h").alias("_of_h")).agg(
        F.count("*").alias("_rows")), "heads")
    content = F.coalesce(F.col(text), F.lit(""))
    whole = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), F.xxhash64(content).alias("h"))
    found = whole.join(heads, F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("h") == F.col("_of_h")))
    once = found.where("_rows = 1").select("row.*")
    repeated = found.where("_rows > 1").dropDuplicates(["_of", "_of_h"]).select("row.*")
    return once.unionByName(repeated)
