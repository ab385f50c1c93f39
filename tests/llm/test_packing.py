import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarterdeck.llm import packing

DOCS = "doc_id long, text string, length string, offset string"
WORDS = [
    "the", "The,", "THE!!", "don't", "it's.", "a.b", "...", "x,,", "naïve.", "É", "İx.", "ﬁ", "á.", "é!", "<|endoftext|>", "<|endoftext|>.",
    "re$$$", "12.5,", "٣.", "Ⅷ.", "ß?", " ", "x y", "漢字。", "漢字.", "|", "don’t.", "ΣΑΣ.", "ΑΣ", "😀!", "a😀.", "½.", "ö", "#tag#", "​",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(WORDS) | st.text(max_size=6).filter(lambda t: "\ud800" not in t), max_size=12), st.sampled_from([" ", "\n", "\t ", "\x0b"]))
def test_ids_of_words_are_ids_of_texts(words, space):
    ids = _ids()
    text = space.join(words).encode("utf-8", "replace").decode()
    assert np.frombuffer(ids.encode(text), "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


_KEPT = []


def _ids():
    if not _KEPT:
        _KEPT.append(packing.WordIds(packing.VOCABULARY))
    return _KEPT[0]


def test_ids_of_documents(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 500)  # both generations turn over
    ids = packing.WordIds(packing.VOCABULARY)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        want = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(ids.encode(r["text"]), "<u4").tolist() == want


def best_fit(lengths, capacity):
    """Number of sequences by best fit of the longest first, one piece at a time."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= n]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80))
def test_runs_are_placed_as_single_pieces_would_be(lengths):
    counts = collections.Counter(lengths)
    runs, opened = packing.place_runs(counts, 20)
    order, free = sorted(lengths), collections.defaultdict(list)
    covered = []
    for position, count, sequence, offset in runs:
        for k in range(count):
            covered.append(position + k)
            free[sequence + k].append((offset, order[position + k]))
    assert sorted(covered) == list(range(len(lengths)))
    assert sorted(free) == list(range(opened))
    for held in free.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 20
    assert opened == best_fit(lengths, 20)


def check_packing(rows, docs, tokenizer, capacity):
    held, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        cuts = range(0, len(ids), capacity)
        want = [(k, a, len(ids[a : a + capacity]), zlib.crc32(ids[a : a + capacity].tobytes())) for k, a in enumerate(cuts)]
        assert sorted(by_doc[doc_id]) == want
    assert set(by_doc) == set(docs)
    return len(held)


def test_documents_are_packed_as_by_best_fit(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack_documents(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    n = check_packing(rows, texts, tokenizer, packing.CAPACITY)
    assert n == best_fit([r["length"] for r in rows], packing.CAPACITY)


def test_nulls_long_texts_and_copies(spark, tokenizer):
    texts = {1: None, 2: "", 3: "word " * 9000, 4: "word " * 2047, 5: "word " * 2048, None: "x y z"} | {100 + k: "a copy of a text" for k in range(300)}
    rows = packing.pack_documents(spark.createDataFrame([(d, t, "c", "c") for d, t in texts.items()], DOCS)).collect()
    check_packing(rows, texts, tokenizer, packing.CAPACITY)


def test_repeated_rows_and_empty_table(spark):
    rows = packing.pack_documents(spark.createDataFrame([(1, "same text", "c", "c")] * 20, DOCS)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 20
    assert packing.pack_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_pieces_with_their_ids(spark, tokenizer):
    docs = spark.createDataFrame([(1, "some words here", "c", "c")], DOCS)
    got = packing.pieces(docs, keep_ids=True).first()
    assert list(got["ids"]) == [*tokenizer.encode("some words here", add_special_tokens=False).ids, 0]
