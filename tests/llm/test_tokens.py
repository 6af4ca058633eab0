"""Token counts and packing against the libraries."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagloom.llm.packing import UnitEncoder, pack, plan_slots
from tagloom.llm.token_count import MergeCounter, count_tokens

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "the", "Straße", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "▁", "é", "🙂", "漢字", "1234", "</s>", "<0x0A>",
         "'s", "...", "　", "\xa0", "\x00", "<|endoftext|>", "Ünïcödé", "foo,", "(bar)", "x" * 60]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.text(max_size=40)
DOCS = [(1, "the cat sat\non the mat"), (2, None), (3, ""), (4, "word " * 5000), (4, "word " * 5000), (None, "no id"),
        (5, "<|endoftext|> is text"), (6, "x" * 30000)]


@pytest.fixture(scope="module")
def counter():
    return MergeCounter(PIECES)


@pytest.fixture(scope="module")
def encoder():
    return UnitEncoder(BYTES, RANKS)


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
FULL = Tokenizer.from_file(BYTES)


@settings(max_examples=400, deadline=None)
@given(text=TEXTS)
def test_counts_as_the_library(counter, text):
    assert counter.count(text) == len(LIBRARY.encode(text))


@settings(max_examples=400, deadline=None)
@given(text=TEXTS)
def test_ids_as_the_library(encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == FULL.encode(text, add_special_tokens=False).ids


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n_tokens string").repartition(3)


def test_count_rows(spark):
    got = sorted(map(tuple, count_tokens(frame(spark, DOCS), PIECES).collect()), key=str)
    want = []
    for doc, text in DOCS:
        n = len(LIBRARY.encode(text or ""))
        want.append((doc, len((text or "").encode()), n, n > 4096))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert count_tokens(frame(spark, []), PIECES).count() == 0
    assert pack(frame(spark, []), BYTES, RANKS).count() == 0


def check_packing(rows, docs, size=1024):
    wanted = sorted((zlib.crc32(np.array((FULL.encode(t or "", add_special_tokens=False).ids + [2]), "<u4").tobytes()[4 * s: 4 * (s + n)]), s, n)
                    for _, t in docs for s, n in cuts(len(FULL.encode(t or "", add_special_tokens=False).ids) + 1, size))
    assert sorted((r["ids_crc32"], r["start"], r["length"]) for r in rows) == wanted
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def cuts(n, size):
    first = (n - 1) % size + 1
    return [(0, first), *[(s, size) for s in range(first, n, size)]]


def test_packing_rows(spark):
    rows = pack(frame(spark, DOCS), BYTES, RANKS).collect()
    check_packing(rows, DOCS)
    assert sorted(r["piece"] for r in rows if r["doc_id"] == 6) == list(range(len([r for r in rows if r["doc_id"] == 6])))


def test_packing_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = pack(docs, BYTES, RANKS).collect()
    bins = check_packing(rows, [tuple(r) for r in docs.collect()])
    assert bins <= 1.01 * sum(r["length"] for r in rows) / 1024 + 1


def best_fit(lengths, size):
    free = []
    for n in sorted(lengths, reverse=True):
        at = min((i for i, f in enumerate(free) if f >= n), key=lambda i: free[i], default=None)
        if at is None:
            free.append(size - n)
        else:
            free[at] -= n
    return len(free)


@settings(max_examples=100, deadline=None)
@given(counts=st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_plan_is_best_fit(counts):
    slots = plan_slots(counts, 40)
    used = defaultdict(list)
    ranks = defaultdict(list)
    for length, lo, hi, first, offset in slots:
        for r in range(lo, hi):
            used[first + r - lo].append((offset, length))
            ranks[length].append(r)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 40
    assert len(used) == best_fit([k for k, n in counts.items() for _ in range(n)], 40)
