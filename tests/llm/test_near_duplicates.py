import collections
import itertools
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from quarterdeck.llm import simhash
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, class string"


@pytest.mark.parametrize("text", [None, "", " \n", "a", "A b", "one Two three", "é Ü x  y", "w " * 50_000, "\x0b\x0c a\tb"])
def test_fingerprint(text):
    assert simhash.simhash(text, 3) & (1 << 64) - 1 == brute.fingerprint(text)


def clustered(seed: int, n: int) -> np.ndarray:
    """Random fingerprints, some of them a few bits from others, and a dense ball."""
    rng = np.random.default_rng(seed)
    free = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n).astype(np.uint64)
    near = free.copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    ball = np.uint64(0x123456789ABCDEF0) ^ rng.integers(0, 1 << 9, n).astype(np.uint64)
    return np.unique(np.concatenate((free, near, ball, np.array([0, 7, 2**64 - 1], dtype=np.uint64))))


@pytest.mark.parametrize("depth", [0, 3])
@pytest.mark.parametrize("distance", [0, 1, 3, 6])
def test_trie_join_finds_the_classes_of_all_pairs(depth, distance):
    values = clustered(distance, 150)
    got_values, smallest = simhash.linked_classes(values, values, distance, depth)
    want = brute.components(values.tolist(), distance)
    assert np.array_equal(got_values, values) and [values[i] for i in want] == smallest.tolist()


def test_trie_join_in_small_steps(monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 16)
    values = clustered(9, 100)
    _, smallest = simhash.linked_classes(values, values, 3, 0)
    assert [values[i] for i in brute.components(values.tolist(), 3)] == smallest.tolist()


def test_components_of_long_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5000, 4999), (4999, 5000), (6, 6)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(301)} | {1000 + k: 1000 for k in range(400)} | {5000: 4999, 4999: 4999}
    assert got == want


@pytest.mark.parametrize("rows_per_prefix", [1 << 15, 8])
def test_links_across_prefixes_and_crowded_ones(spark, monkeypatch, rows_per_prefix):
    monkeypatch.setattr(simhash, "ROWS_PER_PREFIX", rows_per_prefix)  # the small one salts the ball's prefix
    values = clustered(5, 120)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame, 3)).collect()}
    got, want = collections.defaultdict(set), collections.defaultdict(set)
    for v, i in zip(values, brute.components(values.tolist(), 3), strict=True):
        signed = int(v.view(np.int64))
        got[roots.get(signed, signed)].add(int(v))
        want[i].add(int(v))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_trie_join_of_many_values_keeps_no_tables_of_them():
    rng = np.random.default_rng(2)
    right = np.unique(rng.integers(0, 1 << 57, 200_000, dtype=np.uint64))
    left = right[:8000]
    tracemalloc.start()
    try:
        simhash.linked_classes(left, right, 3, 7)
        assert tracemalloc.get_traced_memory()[1] < 100e6
    finally:
        tracemalloc.stop()


def test_two_sides_are_joined_with_each_other_only():
    left, right = np.array([8, 9, 1 << 40], dtype=np.uint64), np.array([9, 1 << 50, (1 << 50) + 1], dtype=np.uint64)
    values, smallest = simhash.linked_classes(left, right, 1, 0)
    assert values.tolist() == [8, 9, 1 << 40, 1 << 50, (1 << 50) + 1] and smallest.tolist() == [8, 8, 1 << 40, 1 << 50, (1 << 50) + 1]


@pytest.mark.parametrize("distance", [0, 1, 3, 6])
def test_copies_of_a_fingerprint_do_not_grow_with_the_table(spark, monkeypatch, distance):
    monkeypatch.setattr(simhash, "ROWS_PER_PREFIX", 64)
    values = np.random.default_rng(4).integers(-(1 << 63), (1 << 63) - 1, 3000, dtype=np.int64)
    frame = spark.createDataFrame([(int(v),) for v in values], "fingerprint long")
    got = collections.Counter(r["fingerprint"] for r in simhash.grouped(frame, distance).collect())
    assert got == dict.fromkeys(values.tolist(), distance + 1)


def test_crowded_groups_are_cut_and_all_pairs_meet(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS_PER_PREFIX", 8)
    values = [(k * 2654435761 % (1 << 48)) - (1 << 60) for k in range(200)]  # the first block is equal in all
    groups = collections.defaultdict(list)
    for r in simhash.grouped(spark.createDataFrame([(v,) for v in values], "fingerprint long"), 3).collect():
        if r["block"] == 0:
            groups[r["prefix"], r["parts"]].append(r["fingerprint"])
    assert len(groups) > 1 and max(map(len, groups.values())) <= 8 * 8
    assert {p for g in groups.values() for p in itertools.combinations(sorted(g), 2)} == set(itertools.combinations(sorted(values), 2))


@pytest.mark.parametrize("distance", [0, 1, 3, 6])
def test_links_give_the_classes_of_all_pairs(spark, monkeypatch, distance):
    monkeypatch.setattr(simhash, "ROWS_PER_PREFIX", 16)
    values = clustered(11, 150)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame, distance)).collect()}
    signed = values.view(np.int64).tolist()
    got, want = collections.defaultdict(set), collections.defaultdict(set)
    for v, i in zip(signed, brute.components(values.tolist(), distance), strict=True):
        got[roots.get(v, v)].add(v)
        want[i].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_a_task_holds_few_groups_at_once(rows):
    keys = [k for k in range(60) for _ in range(1 + k % 5)]
    frame = pd.DataFrame({"block": 0, "prefix": keys, "fingerprint": range(len(keys))})
    batches = [frame[at : at + 4] for at in range(0, len(frame), 4)]
    got = list(simhash.whole_groups(iter([frame[:0], *batches]), ["block", "prefix"], rows))
    assert [f for part, _ in got for f in part["fingerprint"]] == list(range(len(keys)))
    assert all(len(part) < rows + 4 + 5 for part, _ in got)
    begins = [part["fingerprint"].iloc[s] for part, starts in got for s in starts]
    assert begins == [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]


def test_documents_match_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    prints = [brute.fingerprint(r["text"]) for r in rows]
    want = {(r["doc_id"], f"{p:016x}", rows[i]["doc_id"]) for r, p, i in zip(rows, prints, brute.components(prints, 3), strict=True)}
    assert {tuple(r) for r in simhash.near_duplicates(docs).collect()} == want


def awkward():
    rows = [(k, "the same words in every copy of this text", "en", "s", 1, "f", "c") for k in range(50, 0, -1)]
    rows += [(99, None, None, None, None, None, None), (98, "", "en", "s", 0, "", ""), (None, " ", "en", "s", 0, "", "")]
    rows += [(200, "once only here are some words", "en", "s", 1, "", "")] * 3 + [(None, "null id and own words alone", None, None, None, "", "")] * 2
    return rows


def test_nulls_repeats_and_ties(spark):
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(spark.createDataFrame(awkward(), DOCS)).collect())
    want = collections.Counter({(k, 1): 1 for k in range(1, 51)}) + collections.Counter({(99, 98): 1, (98, 98): 1, (None, 98): 1, (200, 200): 3, (None, None): 2})
    assert got == want


def test_one_row_of_each_component_stays(spark):
    docs = spark.createDataFrame(awkward(), DOCS)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 1), (False, 98), (False, 200), (True, 0)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0
