"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger has
a row for each blob, with the spans found by each rule version that has read it.
A run reads the text only of blobs that some current rule version has not seen, applies
to each just the rules it lacks, and joins the ledger back to all paths. Copies, however many,
are scanned once.

Spans are in code points, end exclusive. Within a rule they are the leftmost
non-overlapping matches of its pattern, of which those below ``least`` characters in
``group`` are dropped afterwards.

Defined cases: a null text counts as empty and has no spans; an empty table gives an empty
result; repeated rows each get their row; a null path stays null; other columns may be called anything.
Texts of any length and with any number of hits are scanned whole: patterns repeat only single
characters, which Java's matcher does without recursion, and positions are added up in two levels.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import stored

SPANS = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # Java regular expression
    version: int = 1
    group: int = 0  # the group whose length counts
    least: int = 0
    hints: tuple[str, ...] = ()  # lower case; a text without any of them has no match

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The first three rules are given. The others are shapes of well-known keys.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=8, hints=("passw", "secret", "token", "apikey", "api_key")),
    Rule("access", r"AKIA[A-Z0-9]+", least=16, hints=("akia",)),
    Rule("hex", r"[0-9a-f]{32,}"),  # the same as runs of any length of which short ones are dropped
)
RULES = BASE + (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
)


RUN = 256  # elements that are added up one by one
PIECE = 1 << 14  # code points in a piece of a text that is cut by positions


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``values`` added up (or otherwise combined, from 0) from the first to each.

    In two levels, runs of ``RUN`` and then their results, because every step of an aggregate copies
    the array so far; the work stays near the number of elements up to a million of them.
    """
    none = F.array().cast("array<int>")

    def along(array: Column) -> Column:
        return F.aggregate(array, none, lambda done, x: F.concat(
            done, F.array(combine(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)), x))))

    def joined(runs: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), along(F.transform(runs, lambda r: F.get(r, F.size(r) - 1))))
        return F.flatten(F.zip_with(runs, F.slice(before, 1, F.size(runs)),
                                    lambda run, b: F.transform(run, lambda x: combine(b, x))))

    def whole(array: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(array) - 1) / RUN).cast("int"))
        runs = F.transform(starts, lambda k: along(F.slice(array, k * RUN + 1, F.lit(RUN))))
        return F.when(F.size(array) > 0, _let(runs, joined)).otherwise(none)

    return _let(values, whole)


def matches(text: Column, rule: Rule) -> Column:
    """The spans of one rule in a text."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.split(text, rule.pattern, -1)
    lengths = F.transform(found, lambda m: F.length(m))
    steps = F.zip_with(F.transform(F.slice(between, 1, F.size(found)), lambda p: F.length(p)), lengths,
                       lambda gap, own: gap + own)
    ends = running(steps, lambda x, y: x + y)
    counted = lengths if rule.group == 0 else F.transform(
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda g: F.length(g))
    sized = F.zip_with(lengths, counted, lambda own, n: F.struct(own.alias("own"), n.alias("counted")))
    placed = F.zip_with(ends, sized, lambda end, x: F.struct(
        (end - x["own"]).alias("start"), end.alias("end"), x["counted"].alias("counted")))
    spans = F.transform(F.filter(placed, lambda x: x["counted"] >= rule.least),
                        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    hit = text.rlike(rule.pattern)
    if rule.hints:
        hit = reduce(lambda a, b: a | b, [F.lower(text).contains(h) for h in rule.hints]) & hit
    return F.when(hit, spans).otherwise(F.array()).cast(SPANS)


@dataclass(frozen=True)
class Scan:
    ledger: DataFrame  # blob, results map<rule@version, spans>; replaces the ledger that was given
    by_path: DataFrame  # the path columns, blob, results of the current rules


def scan(versions: DataFrame, paths: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES,
         ledger: DataFrame | None = None) -> Scan:
    """Bring the ledger up to date with ``versions`` and report each of their rows."""
    content = F.coalesce(F.col(text), F.lit(""))
    addressed = versions.select(
        *[F.col(f"`{p}`").alias(f"_path_{i}") for i, p in enumerate(paths)],
        content.alias("_text"), F.sha2(content.cast("binary"), 256).alias("blob"))
    none = F.create_map().cast(f"map<string,{SPANS}>")
    lacking = reduce(lambda a, b: a | b, [~F.map_contains_key("results", F.lit(r.key)) for r in rules])
    if ledger is None:
        known = addressed.groupBy("blob").agg(F.first("_text").alias("_text")).withColumn("results", none)
    else:
        # Hashes meet the ledger first; only texts that some rule version has not read are moved.
        hashes = addressed.select("blob").distinct().join(ledger.select("blob", "results"), "blob", "left")
        unseen = hashes.withColumn("results", F.coalesce("results", none)).where(lacking)
        texts = addressed.join(unseen.select("blob"), "blob", "left_semi")
        known = texts.groupBy("blob").agg(F.first("_text").alias("_text")).join(unseen, "blob")
    # A rule version is applied only where the blob has no result of it.
    new = [F.when(~F.map_contains_key("results", F.lit(r.key)), matches(F.col("_text"), r)) for r in rules]
    entries = F.filter(F.array(*[
        F.when(spans.isNotNull(), F.struct(F.lit(r.key).alias("key"), spans.alias("value")))
        for r, spans in zip(rules, (F.col(f"_new_{i}") for i in range(len(rules))))]), lambda x: x.isNotNull())
    scanned = known.select("blob", "results", *[c.alias(f"_new_{i}") for i, c in enumerate(new)])
    scanned = stored(scanned.select(
        "blob", F.map_concat("results", F.map_from_entries(entries)).alias("results")), "ledger")
    whole = scanned if ledger is None else scanned.unionByName(
        ledger.select("blob", "results").join(scanned, "blob", "left_anti"))
    by_path = addressed.drop("_text").join(whole, "blob").select(
        *[F.col(f"_path_{i}").alias(p) for i, p in enumerate(paths)], "blob",
        F.map_filter("results", lambda k, v: k.isin(*[r.key for r in rules])).alias("results"))
    return Scan(whole, by_path)


def spans_of(results: Column, rules: tuple[Rule, ...]) -> Column:
    """All spans of some rules: kind, start, end, in the order of start, then of the rules."""
    def ranked(rank: int, rule: Rule) -> Column:
        own = F.coalesce(F.try_element_at(results, F.lit(rule.key)), F.array().cast(SPANS))
        return F.transform(own, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")))

    parts = [ranked(rank, rule) for rank, rule in enumerate(rules)]
    return F.array_sort(F.concat(*parts))


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mark``.

    The text is cut into pieces first, since a place in a long one is found from its beginning; what
    stands between two marks is then made of the pieces it touches.
    """
    count = F.floor(F.length(text) / PIECE).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), count), lambda k: F.substring(text, k * PIECE + 1, F.lit(PIECE)))
    # Before each span, where the spans so far have ended; a span that begins earlier adds no mark.
    ended = F.concat(F.array(F.lit(0)), running(F.transform(spans, lambda s: s["end"]), F.greatest))

    def between(parts: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
        inside = F.substring(F.get(parts, first), start % PIECE + 1, end - start)
        across = F.concat(
            F.substring(F.get(parts, first), start % PIECE + 1, F.lit(PIECE)),
            F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            F.substring(F.get(parts, last), F.lit(1), end % PIECE))
        return F.when(first == last, inside).otherwise(across)

    def cut(known: Column) -> Column:
        kept = F.zip_with(F.slice(known["ended"], 1, F.size(spans)), spans, lambda at, s: F.when(
            s["start"] >= at, F.concat(between(known["pieces"], at, s["start"]), F.lit(mark))).otherwise(""))
        return F.concat(F.array_join(kept, ""), between(known["pieces"], F.get(known["ended"], F.size(spans)), F.length(text)))

    whole = _let(F.struct(pieces.alias("pieces"), ended.alias("ended")), cut)
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redact(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; all columns and rows stay.

    The ledger says which blobs have secrets; only their spans meet the rows.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    ledger = scan(docs.select(F.col(text).alias("text")), [], rules=rules).ledger
    spans = stored(ledger.select("blob", spans_of(F.col("results"), rules).alias("spans")).where(F.size("spans") > 0), "spans")
    rows = docs.select(F.struct("*").alias("row"), F.sha2(content.cast("binary"), 256).alias("blob"))
    met = rows.join(spans, "blob", "left")
    whole = F.col("row")[text]
    return met.select(*[
        (F.when(F.col("spans").isNull(), whole).otherwise(redacted(whole, F.col("spans"), mark)) if c == text
         else F.col("row")[c]).alias(c) for c in docs.columns])
