"""Wavelet matrices of token ids against the plain lists of ids."""

import io
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assaymill.llm import wavelet

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True
SCHEMA = "doc_id long, text string, start string, ids string, path int, part string"


def direct(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def opened(ids, docs=(1,), lengths=None):
    return wavelet.Shard(io.BytesIO(wavelet.matrix_bytes(np.array(ids, np.uint32), list(docs), lengths or [len(ids)])))


@pytest.mark.parametrize("n,top", [(0, 1), (1, 0), (1, 7), (1000, 1), (5000, 50_256), (wavelet.BLOCK_BITS * 2 + 5, 300), (3000, 2**31 - 1)])
def test_shard_access_rank_select(n, top):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % (top + 1)).astype(np.uint32)
    shard = opened(ids)
    assert np.array_equal(shard.tokens(), ids)
    at = rng.integers(0, n, min(n, 300)) if n else np.zeros(0, np.int64)
    assert np.array_equal(shard.access(at), ids[at])
    for token in {*ids[at][:15].tolist(), 0, top, top + 1}:
        places = np.flatnonzero(ids == token)
        assert shard.rank(token) == len(places)
        assert np.array_equal(shard.select(token, np.arange(len(places))), places)
        for end in at[:5].tolist():
            assert shard.rank(token, end) == int((ids[:end] == token).sum())


class Counted(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        data = super().read(n)
        self.read_bytes += len(data)
        return data


def test_reading_one_place_fetches_one_block_a_plane():
    ids = np.random.default_rng(3).integers(0, 50_000, wavelet.BLOCK_BITS * 40)
    file = Counted(wavelet.matrix_bytes(ids, [1], [len(ids)]))
    shard = wavelet.Shard(file)
    file.read_bytes = 0
    assert shard.access(np.array([1_234_567])).tolist() == [ids[1_234_567]]
    assert file.read_bytes < len(file.getvalue()) / 30


UNICODE = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t\r\x1c\x85\xa0\u2028\u3000.,'!aZé9ſß٣½漢🙂")), max_size=60)


@settings(max_examples=500, deadline=None)
@given(UNICODE, st.lists(st.sampled_from([" ", "  ", "\n", "'s", "'LL", ".", ",", "word", "Ünd", "3.14", "a,b", ").", "<|endoftext|>", " \x1f", "x"]), max_size=30))
def test_units_give_the_ids_of_the_whole_text(text, parts):
    units = wavelet._Units(TOKENIZER, np.uint32)
    for t in (text, "".join(parts), text + "".join(parts)):
        assert np.frombuffer(units.of(t), np.uint32).tolist() == direct(t)[:-1]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    texts = ["", None, "!!! ! !", "<|endoftext|>", "a\x1cb \x1c c", "long word " * 30_000, "äöü 漢字 🙂 é"]
    made = [(i * 7 % 211, " ".join(r.choice(["the", "lorem", "ipsum,", "dolor.", "x1"]) for _ in range(r.randint(0, 80)))) for i in range(300)]
    made += [(1000 + i, t) for i, t in enumerate(texts)]
    return made + [(None, "no id"), (None, None), (None, "no id"), (5, "same id"), (5, "same id")]


@pytest.fixture(scope="module")
def shards(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash", 1, "clash") for r in rows], SCHEMA).repartition(5)
    return wavelet.write(df, PATH, shard_tokens=2000)


def test_documents_come_back_in_order(spark, rows, shards):
    got = sorted(wavelet.read(shards, with_ids=True).collect(), key=lambda r: r.start)
    assert len(got) == len(rows) and shards.count() > 5
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((d, tuple(direct(t))) for d, t in rows)


def test_access_count_and_occurrences_over_all_shards(spark, shards):
    got = sorted(wavelet.read(shards, with_ids=True).collect(), key=lambda r: r.start)
    ids = [i for r in got for i in r.ids]
    owner = [r.doc_id for r in got for _ in r.ids]
    asked = [*range(0, len(ids), 7), len(ids) - 1, len(ids), -1, 10**12, None, 7, 7]
    found = wavelet.token_at(shards, spark.createDataFrame([(p, "clash") for p in asked], "pos long, path string"), width=1000)
    assert Counter(map(tuple, found.collect())) == Counter((p, ids[p]) for p in asked if p is not None and 0 <= p < len(ids))
    wanted = [0, ids[5], 50_000, 77_777, ids[5]]
    assert {tuple(r) for r in wavelet.count(shards, wanted).collect()} == {(t, ids.count(t)) for t in wanted}
    places = Counter(map(tuple, wavelet.occurrences(shards, wanted, at_once=50).collect()))
    assert places == Counter((t, p, owner[p]) for t in set(wanted) for p in range(len(ids)) if ids[p] == t)


def test_no_documents(spark):
    none = wavelet.write(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert none.count() == 0 and wavelet.read(none).count() == 0 and wavelet.count(none, [0]).count() == 0
    assert wavelet.token_at(none, spark.range(5), "id").count() == 0


def test_query_against_the_library(spark, sf_dir):
    from assaymill.llm import queries

    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    want, start = set(), 0
    for r in docs:
        ids = direct(r.text)
        want.add((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert {tuple(r) for r in queries.QUERIES["op13_wavelet_shards"](spark, sf_dir).collect()} == want
