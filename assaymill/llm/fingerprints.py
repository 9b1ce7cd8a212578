"""Homomorphic multiset fingerprints, in DataFrame functions only.

Each paragraph (line) is hashed into a wide vector; a text's fingerprint is the sum of
its paragraphs' vectors, each lane modulo 2**32. So the order of paragraphs does not matter,
and adding or removing one is an addition or subtraction (``add``, ``subtract``).

The vector has two parts. ``EXACT`` lanes come from the paragraph as a whole and decide
equality. The other lanes count, over all of the paragraph's shingles of ``SHINGLE`` words, how many of
their 64-bit hashes have a given bit set; both belong to the paragraph alone. A word is what stands between white space; in scripts that are
written without spaces each character is one. Two bits share a long, 32 bits apart, so that
one addition serves both and no lane runs over. Around their mean these counters are a random projection of
the shingles, so ``likeness`` reads 2<a,b> / (<a,a> + <b,b>) from them; its standard error is
about 1/8 for unrelated texts.

Defined cases: a null text counts as empty, an empty text as one empty paragraph; null ids come
first, rows of equal id stand in the order of a hash of their text, and equal rows are interchangeable; a
table of one row is followed by itself. Very long texts need no other memory than their own
shingles' hashes. Only the named columns are read, so others may be called anything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.operators.ordered import sliced

EXACT = 16
PACKED = 32  # longs that hold the 64 bit counters
LOW = 0xFFFFFFFF
# Bits of a counter, and how many sums of the counters before fit into one, a sign bit left free: 7 hashes
# into four bits, 18 such sums (126 hashes) into eight, any number of those into 32.
WIDTHS = [(4, 7), (8, 18), (32, None)]
SHINGLE = 3
# Thai, Lao, Tibetan, Burmese, Khmer, kana, Han: written without spaces between words.
UNSPACED = r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
WORD = rf"[{UNSPACED}]|[^\s{UNSPACED}]+"


def _array(values: list[Column]) -> Column:
    return F.array(*values)


def _zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0).cast("bigint"), n)


def fingerprint(text: Column) -> Column:
    """Array of longs: ``EXACT`` lanes, ``PACKED`` pairs of counters, the number of pieces."""
    text = F.coalesce(text, F.lit(""))
    seeds = EXACT // 2
    hashed = F.transform(
        F.split(text, "\n", -1),
        lambda p: F.array(*[F.xxhash64(F.lit(seed), p) for seed in range(seeds)]))
    exact = F.aggregate(hashed, _zeros(EXACT), lambda acc, h: F.array(*[
        (acc[i] + (h[i // 2].bitwiseAND(F.lit(LOW)) if i % 2 == 0
                   else F.shiftrightunsigned(h[i // 2], 32))).bitwiseAND(F.lit(LOW))
        for i in range(EXACT)]))
    shingles = F.flatten(F.transform(F.split(text, "\n", -1), _shingles))
    return F.concat(exact, _once(shingles, lambda s: F.concat(_bit_counts(s), F.array(F.size(s).cast("bigint")))))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, which may name the value several times, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _bit_counts(hashes: Column) -> Column:
    """How many hashes have each bit set: ``PACKED`` longs, bit i in the low half of long i, bit i + 32 in its high half.

    A long holds the counters of every w-th bit, so w longs take in a hash by w additions. Small
    counters are added up into wider ones before one can run over; nothing is left out.
    """
    sums, before = hashes, 1
    for width, fit in WIDTHS:
        add_up = _added(before, width)
        sums, before = _once(sums, add_up if fit is None else _in_groups(add_up, fit)), width
    return sums


def _added(before: int, width: int) -> Callable[[Column], Column]:
    """Adds up longs with counters of ``before`` bits (hashes: of one) into ``width`` longs with counters of ``width`` bits."""
    mask = sum(((1 << before) - 1) << at for at in range(0, 64, width))
    field = F.lit(int.from_bytes(mask.to_bytes(8), signed=True))

    def counter(group: Column, j: Column) -> Column:
        def plus(acc: Column, x: Column) -> Column:
            own, by = (x, j) if before == 1 else (F.get(x, j % before), j - j % before)
            return acc + F.call_function("shiftrightunsigned", own, by).bitwiseAND(field)

        return F.aggregate(group, F.lit(0).cast("bigint"), plus)

    return lambda group: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: counter(group, j))


def _in_groups(add_up: Callable[[Column], Column], fit: int) -> Callable[[Column], Column]:
    def run(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(s) + 1, F.lit(fit)), lambda at: at <= F.size(s))
        return F.transform(starts, lambda at: _once(F.slice(s, at, F.lit(fit)), add_up))

    return run


def _shingles(paragraph: Column) -> Column:
    """Hashes of the runs of ``SHINGLE`` words; a shorter paragraph with words is one run."""
    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<bigint>"))

    return _once(F.regexp_extract_all(paragraph, F.lit(WORD), F.lit(0)), runs)


def _lanewise(a: Column, b: Column, sign: int) -> Column:
    """Lane by lane modulo 2**32, for both lanes of a packed long."""
    def one(x: Column, y: Column) -> Column:
        low = (x.bitwiseAND(F.lit(LOW)) + sign * y.bitwiseAND(F.lit(LOW))).bitwiseAND(F.lit(LOW))
        high = (F.shiftrightunsigned(x, 32) + sign * F.shiftrightunsigned(y, 32)).bitwiseAND(F.lit(LOW))
        return F.shiftleft(high, 32).bitwiseOR(low)

    return F.zip_with(a, b, one)


def add(a: Column, b: Column) -> Column:
    """The fingerprint of both texts' paragraphs together."""
    return _lanewise(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    """The fingerprint of a without the paragraphs of b."""
    return _lanewise(a, b, -1)


def as_hex(lanes: Column) -> Column:
    """A text of fixed length, equal for equal fingerprints."""
    exact = F.transform(F.slice(lanes, 1, EXACT), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    rest = F.transform(F.slice(lanes, EXACT + 1, PACKED + 1), lambda x: F.lpad(F.lower(F.hex(x)), 16, "0"))
    return F.concat(F.array_join(exact, ""), F.array_join(rest, ""))


def _centred(lanes: Column) -> Column:
    """Each bit's counter minus its mean under random hashes, times two."""
    n = lanes[EXACT + PACKED]
    packed = F.slice(lanes, EXACT + 1, PACKED)
    return F.concat(
        F.transform(packed, lambda x: (2 * x.bitwiseAND(F.lit(LOW)) - n).cast("double")),
        F.transform(packed, lambda x: (2 * F.shiftrightunsigned(x, 32) - n).cast("double")))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1; 1 for equal fingerprints."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    x, y = _centred(a), _centred(b)
    length = dot(x, x) + dot(y, y)
    value = F.when(length > 0, 2 * dot(x, y) / length).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def with_next(docs: DataFrame, key: str, columns: list[str], order: list[str], suffix: str = "_next") -> DataFrame:
    """Every row with ``columns`` of the next row in ascending ``key``, then ``order`` (after the last: the first).

    Rows are cut into slices of even size, a hot key included. The rows that begin a slice also go to the
    slice before it, those that begin the table to the last one, so no window has to look beyond its own.
    """
    by = [key, *order]
    cut = sliced(docs, by, edges=True)
    least = docs.agg(F.min_by(F.struct(*by), F.struct(*by)).alias("least")).scalar()
    top = cut.agg(F.max("_slice")).scalar()
    first = F.struct(*by).eqNullSafe(least)
    places = F.array_compact(F.array(
        F.struct(F.col("_slice").alias("slice"), F.lit(0).alias("guest")),
        F.when(F.col("_edge"), F.struct((F.col("_slice") - 1).alias("slice"), F.lit(1).alias("guest"))),
        F.when(first, F.struct(top.alias("slice"), F.lit(2).alias("guest")))))
    dealt = cut.withColumn("_in", F.explode(places))
    along = Window.partitionBy("_in.slice").orderBy("_in.guest", *[F.col(c).asc_nulls_first() for c in by])
    following = F.lead(F.struct(*columns)).over(along)
    return dealt.withColumn("_following", following).where("_in.guest = 0").select(
        *docs.columns, *[F.col("_following")[c].alias(c + suffix) for c in columns])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts and of their edits: the last quarter replaced from the next text.

    The edit's fingerprint is the text's, less the paragraphs from the cut on, plus the new ones.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(F.col(key).alias("doc_id"), content.alias("text"), F.xxhash64(content).alias("_h"))
    marked = named.withColumn("print", fingerprint(F.col("text")))
    paired = with_next(marked, "doc_id", ["text", "print"], ["_h"])
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    kept = F.left(F.col("text"), n - quarter)
    edited = paired.select(
        "doc_id", "text", n.cast("bigint").alias("n_chars"), "print", "print_next",
        F.concat(kept, F.left(F.col("text_next"), quarter)).alias("edited"),
        # Characters before the paragraph in which the edit begins.
        (n - quarter - F.length(F.substring_index(kept, "\n", -1))).alias("same"))
    behind = [F.substring(F.col(c), F.col("same") + 1, F.length(c)) for c in ("text", "edited")]
    changed = add(subtract(F.col("print"), fingerprint(behind[0])), fingerprint(behind[1]))
    edited = edited.withColumn("edited_print", F.when(F.col("same") > 0, changed).otherwise(fingerprint(F.col("edited"))))
    return edited.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_hex(F.col("print")).alias("fingerprint"), as_hex(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("print_next")).alias("near_next"))
