"""Language identification as mixture inference.

A document is a mixture of languages: each of its words was drawn from one of them.
A word's likelihood under a language is the product of its letter trigrams' smoothed
probabilities. Expectation-maximisation estimates the proportions; the set of
languages is the one with the highest log-likelihood minus half a log(words) for each
language after the first.

Most documents need no iteration. The log-likelihood is concave in the proportions, so
from the best single language b no mixture gains more than
``max over l of sum(p(word|l) / p(word|b) - 1)``. Where that bound is below the
penalty of a second language, {b} is proven best.

The score is the share of the first language times how sure the set is: one language against
the other single ones, several against the best single one. A text is explained if its
penalised likelihood under the set is above that of letters drawn from all trigram bins evenly.

Memory: the model is ``languages x BINS`` floats, whatever the size of the corpus;
texts are worked through in groups of bounded size.

Defined cases: a null text, an empty one and one without letters give ``und`` with score 0;
so does every text when nothing can be learned from. Ties go to the language that sorts
first. Repeated rows each get their own result. Columns other than the named ones are
neither read nor returned.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import GROUP_CHARS, groups, small_batches, text_groups

BINS = 1 << 16  # hashed trigrams
SMOOTHING = 0.05
ROUNDS = 12
MODEL_BYTES = 256 << 20  # the model is broadcast; more languages than fit are refused
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _trigrams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each letter: its position, the bin of the trigram around it, and whether a word starts."""
    codes = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, 0)
    at = np.flatnonzero(letter)
    mixed = codes[at - 1] * np.uint32(0x9E3779B1) ^ codes[at] * np.uint32(0x85EBCA77) \
        ^ codes[at + 1] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return at, mixed >> np.uint32(16), ~letter[at - 1]


def _slices(text: str) -> Iterator[str]:
    """A text in slices of bounded size, cut at white space where there is some."""
    while len(text) > 2 * GROUP_CHARS:
        cut = text.rfind(" ", GROUP_CHARS, 2 * GROUP_CHARS) + 1 or 2 * GROUP_CHARS
        yield text[:cut]
        text = text[cut:]
    yield text


def _words(texts: list[str | None], model: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihoods (words x languages), and the row and the number of letters of each word."""
    parts, rows, letters = [], [], []
    for i, j in groups([len(t or "") for t in texts]):
        if j - i == 1:
            pieces, owner = list(_slices(texts[i] or "")), None
        else:
            pieces = [" ".join((t or "") for t in texts[i:j])]
            # A text may get longer in lower case; positions are counted after it.
            sizes = [len((t or "").lower()) + 1 for t in texts[i:j]]
            owner = np.cumsum(sizes)
        for piece in pieces:
            at, bins, first = _trigrams(piece)
            if not len(at):
                continue
            starts = np.flatnonzero(first)
            if not first[0]:
                starts = np.r_[0, starts]
            parts.append(np.add.reduceat(model[bins], starts, axis=0))
            letters.append(np.diff(np.r_[starts, len(at)]))
            rows.append(np.full(len(starts), i) if owner is None else
                        i + np.searchsorted(owner, at[starts] - 1, side="right"))
    if not parts:
        return np.zeros((0, model.shape[1]), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(rows), np.concatenate(letters)


def _mixtures(loglik: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Proportions (documents x languages) of the best language set of each document.

    Backward elimination: fit all languages, drop the one with the smallest share,
    fit again, and keep the set with the highest penalised log-likelihood.
    """
    docs, langs = len(starts), loglik.shape[1]
    peak = loglik.max(axis=1, keepdims=True)
    likelihood = np.exp((loglik - peak).astype(np.float64))
    owner = np.repeat(np.arange(docs), counts)
    offset = np.add.reduceat(peak[:, 0].astype(np.float64), starts)
    allowed = np.ones((docs, langs), bool)
    best, chosen = np.full(docs, -np.inf), np.zeros((docs, langs))
    for size in range(langs, 0, -1):
        share = allowed / size
        for _ in range(ROUNDS if size > 1 else 0):
            joint = likelihood * share[owner]
            joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
            share = np.add.reduceat(joint, starts, axis=0) / counts[:, None]
        seen = np.log(np.maximum((likelihood * share[owner]).sum(axis=1), 1e-300))
        value = offset + np.add.reduceat(seen, starts) - 0.5 * (size - 1) * np.log(counts)
        better = value >= best
        best, chosen = np.where(better, value, best), np.where(better[:, None], share, chosen)
        weakest = np.where(allowed, share, np.inf).argmin(axis=1)
        allowed[np.arange(docs), weakest] = False
    return chosen


def infer(texts: list[str | None], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (rows x languages; all 0 without letters) and how sure the set of languages is."""
    return explain(texts, model)[:2]


def explain(texts: list[str | None], model: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``infer``, and whether the set of languages explains the text."""
    langs = model.shape[1]
    share, sure, explained = np.zeros((len(texts), langs)), np.zeros(len(texts)), np.zeros(len(texts), bool)
    loglik, rows, letters = _words(texts, model)
    if not len(rows):
        return share, sure, explained
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    counts, docs = np.diff(np.r_[starts, len(rows)]), rows[starts]
    total = np.add.reduceat(loglik.astype(np.float64), starts, axis=0)
    single = total.argmax(axis=1)
    relative = np.exp(np.minimum(
        loglik - loglik[np.arange(len(rows)), np.repeat(single, counts)][:, None], 60), dtype=np.float64)
    gain = (np.add.reduceat(relative, starts, axis=0) - counts[:, None]).max(axis=1)
    share[docs, single] = 1.0
    scaled = np.exp(total - total.max(axis=1, keepdims=True))
    scaled /= scaled.sum(axis=1, keepdims=True)
    open_ = np.flatnonzero(gain > 0.5 * np.log(counts))
    fit, several = total.max(axis=1), np.zeros(len(docs), bool)
    if len(open_) and langs > 1:
        part = loglik[np.isin(np.repeat(np.arange(len(docs)), counts), open_)].astype(np.float64)
        own = counts[open_]
        first = np.r_[0, np.cumsum(own)[:-1]]
        share[docs[open_]] = chosen = _mixtures(part, first, own)
        peak = part.max(axis=1)
        seen = np.log(np.maximum((np.exp(part - peak[:, None]) * np.repeat(chosen, own, axis=0)).sum(axis=1), 1e-300))
        size = (chosen > 0).sum(axis=1)
        several[open_] = size > 1
        fit[open_] = np.add.reduceat(seen + peak, first) - 0.5 * (size - 1) * np.log(own)
    sure[docs] = np.where(several, 1 / (1 + np.exp(np.clip(total.max(axis=1) - fit, -700, 700))),
                          scaled[np.arange(len(docs)), share[docs].argmax(axis=1)])
    explained[docs] = fit > -np.log(BINS) * np.add.reduceat(letters, starts)
    return share, sure, explained


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages, sorted, and log P(trigram bin | language) as (BINS, languages).

    Counts cover every given row; tasks send sums per bin, and Spark adds them up.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")) \
        .where("text is not null and lang is not null")
    names = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if len(names) * BINS * 4 > MODEL_BYTES:
        raise ValueError(f"{len(names)} languages need a model of more than {MODEL_BYTES} bytes")
    index = {name: i for i, name in enumerate(names)}

    def count(batches):
        sums = np.zeros(len(index) * BINS, np.int64)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, texts in text_groups(batch.column("text")):
                by_lang: dict[str, list[str]] = {}
                for name, text in zip(langs[at:], texts):
                    by_lang.setdefault(name, []).append(text)
                for name, own in by_lang.items():
                    for piece in _slices(" ".join(own)):
                        sums[index[name] * BINS:][:BINS] += np.bincount(_trigrams(piece)[1], minlength=BINS)
        bins = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(sums[bins])], ["bin", "n"])

    counted = rows.mapInArrow(count, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
    table = counted.toPandas() if names else None
    sums = np.zeros(len(names) * BINS)
    if names:
        sums[table["bin"].to_numpy()] = table["n"].to_numpy()
    sums = sums.reshape(len(names), BINS)
    model = np.log((sums + SMOOTHING) / (sums.sum(axis=1, keepdims=True) + SMOOTHING * BINS))
    return names, np.ascontiguousarray(model.T, np.float32)


def _predicted(frame: DataFrame, names: list[str], model: np.ndarray, carried: list[str], schema: str) -> DataFrame:
    """``carried`` columns and lang_pred, score, n_langs, explained; the text is in ``text`` or in ``row``."""
    small_batches(frame.sparkSession)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            column = batch.column("text") if "text" in batch.schema.names else batch.column("row").field("text")
            share, sure = np.zeros((batch.num_rows, max(1, len(names)))), np.zeros(batch.num_rows)
            explained = np.zeros(batch.num_rows, bool)
            for at, texts in text_groups(column) if names else ():
                own = slice(at, at + len(texts))
                share[own], sure[own], explained[own] = explain(texts, shared.value)
            top, peak = share.argmax(axis=1), share.max(axis=1)
            labels = [names[k] if p > 0 else UNKNOWN for k, p in zip(top, peak)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(labels, pa.string()),
                 pa.array(np.clip(peak * sure, 0, 1)), pa.array((share > 0.01).sum(axis=1).astype(np.int32)),
                 pa.array(explained)],
                [*carried, "lang_pred", "score", "n_langs", "explained"])

    return frame.mapInArrow(predict, f"{schema}, lang_pred string, score double, n_langs int, explained boolean")


def identify(docs: DataFrame, names: list[str], model: np.ndarray, held_out: Column) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, n_langs."""
    frame = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), "text")
    return _predicted(frame, names, model, ["doc_id", "held_out"], "doc_id bigint, held_out boolean").drop("explained")


def annotate(docs: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """Every row of ``docs`` whole as the struct ``row``, next to lang_pred, score, n_langs, explained."""
    frame = docs.select(F.struct("*").alias("row"))
    return _predicted(frame, names, model, ["row"], f"row {frame.schema['row'].dataType.simpleString()}")
