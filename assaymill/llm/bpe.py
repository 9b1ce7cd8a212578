"""Byte-level BPE encoding and decoding of whole texts, long ones in overlapping chunks.

A text of up to ``CHUNK`` characters is one chunk. A longer one is cut into chunks that run
``OVERLAP`` characters into the next; tasks pre-tokenise the chunks independently, each as if
its text began there. Pre-tokenising looks ahead only, so once two readings of the same
place share a boundary they agree from there on: the first shared boundary in the overlap is
where the left chunk ends and the right one begins (``stitch``). Boundaries within
``GUARD`` characters of a chunk's end are not trusted, as what follows the cut could
change them. Pieces between shared boundaries are encoded in parallel and joined in
order. Where an overlap has no shared boundary (a single pre-token longer than it) the two
chunks become one piece. Decoding joins the raw bytes of the ids.

Defined cases: a null text counts as empty and has no ids; repeated rows each get their
row; a table without rows gives none. Columns to carry are named by the caller.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import small_batches, stored, text_groups

CHUNK = 1 << 16
OVERLAP = 1 << 12
GUARD = 64


@functools.cache
def _vocabulary(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), table


@functools.cache
def _pattern(pattern: str):
    return regex.compile(pattern)


def _encoded(batch: pa.RecordBatch, carried: list[str], path: str, pattern: str,
             decoded: str | None = None) -> Iterator[pa.RecordBatch]:
    """The carried columns and the ids of the texts, and their bytes under the name ``decoded``, some texts at a time."""
    encoding, table = _vocabulary(path, pattern)
    for at, texts in text_groups(batch.column("_text")):
        ids = [encoding.encode_ordinary(t) for t in texts]
        columns = [*(batch.column(c).slice(at, len(texts)) for c in carried),
                   pa.array([np.array(i, np.int32) for i in ids], pa.list_(pa.int32()))]
        if decoded:
            columns.append(pa.array([b"".join([table[i] for i in own]) for own in ids], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, [*carried, "ids", *([decoded] if decoded else [])])


def _starts(text: str, pattern: str) -> list[int]:
    """Where pre-tokens begin after something other than white space.

    Only there may a text be cut: the pattern looks ahead from white space alone.
    """
    return [p for m in _pattern(pattern).finditer(text) if (p := m.start()) and not text[p - 1].isspace()]


def boundaries(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """For each chunk the boundaries in its head and in its tail overlap, in text positions."""
    def run(batches):
        for batch in batches:
            heads, tails = [], []
            for text, n, last in zip(batch.column("piece").to_pylist(), batch.column("n").to_pylist(),
                                     batch.column("last").to_pylist()):
                trusted = len(text) if last else len(text) - GUARD
                found = [p for p in _starts(text, pattern) if p < trusted]
                heads.append([n * chunk + p for p in found if p < overlap])
                tails.append([n * chunk + p for p in found if p >= chunk])
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), batch.column("n"), pa.array(heads, pa.list_(pa.int64())),
                 pa.array(tails, pa.list_(pa.int64()))], ["blob", "n", "head", "tail"])

    return chunks.mapInArrow(run, "blob string, n int, head array<bigint>, tail array<bigint>")


def stitch(marks: DataFrame) -> DataFrame:
    """For each text the positions at which it is cut: the first shared boundary of each overlap.

    A chunk's reading is right from the first boundary that it shares with the chunk before.
    After an overlap without one, nothing vouches for the readings, so the rest of
    that text stays one piece.
    """
    right = marks.select("blob", (F.col("n") - 1).alias("n"), "head").where("n >= 0")
    met = marks.select("blob", "n", "tail").join(right, ["blob", "n"]).select(
        "blob", "n", F.array_min(F.array_intersect("head", "tail")).alias("at"))
    found = met.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("n", "at"))).alias("met"),
        F.min(F.when(F.col("at").isNull(), F.col("n"))).alias("gap"))
    return found.select("blob", F.transform(
        F.filter("met", lambda x: F.col("gap").isNull() | (x["n"] < F.col("gap"))), lambda x: x["at"]).alias("cuts"))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           chunk: int = CHUNK, overlap: int = OVERLAP, decoded: str | None = None) -> DataFrame:
    """The columns in ``keep``, then ``ids`` (array of int), for every row.

    ``decoded`` names a further column with the bytes that the ids decode to. It is made where the ids are,
    so that a task needs one Python worker for both.
    """
    small_batches(docs.sparkSession)
    if not 2 * GUARD < overlap <= chunk:
        raise ValueError("the overlap must be longer than twice the guard and no longer than a chunk")
    content = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(*[F.col(f"`{c}`").alias(f"_keep_{i}") for i, c in enumerate(keep)],
                        content.alias("_text"))
    names = {f"_keep_{i}": c for i, c in enumerate(keep)}
    kinds = dict(named.dtypes)

    def run(batches):
        for batch in batches:
            yield from _encoded(batch, carried, path, pattern, decoded)

    carried = list(names)
    head = "".join(f"{c} {kinds[c]}, " for c in carried)
    short = named.where(F.length("_text") <= chunk).mapInArrow(
        run, head + "ids array<int>" + (f", `{decoded}` binary" if decoded else ""))

    # Long texts, each once however many rows have it.
    long = named.where(F.length("_text") > chunk).withColumn("blob", F.sha2(F.col("_text").cast("binary"), 256))
    texts = stored(long.select("blob", "_text").dropDuplicates(["blob"]), "long-texts")
    count = F.ceil(F.length("_text") / chunk).cast("int")
    chunks = texts.select("blob", "_text", count.alias("count"), F.explode(F.sequence(F.lit(0), count - 1)).alias("n"))
    chunks = chunks.select(
        "blob", "n", (F.col("n") == F.col("count") - 1).alias("last"),
        F.substring(F.col("_text"), F.col("n") * chunk + 1, F.lit(chunk + overlap)).alias("piece"))
    marks = boundaries(chunks.repartition("blob", "n"), pattern, chunk, overlap)
    cut = texts.join(stitch(stored(marks, "boundaries")), "blob", "left")
    cuts = F.concat(F.array(F.lit(0).cast("bigint")), F.coalesce("cuts", F.array().cast("array<bigint>")))
    pieces = cut.select("blob", "_text", cuts.alias("cuts")).select("blob", "_text", "cuts", F.posexplode("cuts").alias("n", "at"))
    pieces = pieces.select("blob", "n", F.substring(
        F.col("_text"), (F.col("at") + 1).cast("int"),
        (F.coalesce(F.try_element_at("cuts", F.col("n") + 2), F.length("_text").cast("bigint")) - F.col("at")).cast("int"))
        .alias("_text")).repartition("blob", "n")

    def run_pieces(batches):
        for batch in batches:
            yield from _encoded(batch, ["blob", "n"], path, pattern)

    encoded = pieces.mapInArrow(run_pieces, "blob string, n int, ids array<int>")
    whole = encoded.groupBy("blob").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("n", "ids"))), lambda x: x["ids"])).alias("ids"))
    joined = long.drop("_text").join(stored(whole, "long-ids"), "blob").select(*carried, "ids")
    if decoded:
        joined = decode(joined, path, pattern, out=decoded)
    return short.unionByName(joined).withColumnsRenamed(names)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids as a binary column."""
    def run(batches):
        _, table = _vocabulary(path, pattern)
        for batch in batches:
            data = [b"".join([table[i] for i in x.as_py()]) if x.is_valid else None for x in batch.column(ids)]
            yield batch.append_column(out, pa.array(data, pa.binary()))

    kinds = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{kinds}, `{out}` binary")


def digest_ids(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """``encoded`` without its ids but with their number and the SHA-256 of their little-endian bytes."""
    rest = [c for c in encoded.columns if c != ids]

    def run(batches):
        for batch in batches:
            lists = batch.column(ids)
            values, offsets = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
            digests = [hashlib.sha256(values[a:b].tobytes()).hexdigest() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(np.diff(offsets).astype(np.int64)), pa.array(digests, pa.string())],
                [*rest, "n_tokens", "ids_sha256"])

    kinds = "".join(f"`{c}` {t}, " for c, t in encoded.dtypes if c != ids)
    return encoded.mapInArrow(run, f"{kinds}n_tokens bigint, ids_sha256 string")
