import collections
import re

import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import mixing

SCHEMA = "doc_id long, text string, source string, index long, start long, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(*r, -1, -1, "own") for r in rows], SCHEMA).repartition(6)


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Source -> target by sharing anew, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, found = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not above:
            return found | {s: weight[s] * level for s in open_}
        found |= {s: most * sizes[s] for s in above}
        left, open_ = left - sum(most * sizes[s] for s in above), open_ - above
    return found


def check(spark, rows, **settings):
    """Rows of the mix per document, held against what must hold for every mix."""
    docs = frame(spark, rows)
    mixed = mixing.mix(docs, keep_words=True, **settings)
    got = mixing.spans(mixed).collect()
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = plain_targets(dict(sizes), **{k: v for k, v in settings.items() if k in ("weights", "share")}, most=settings.get("passes", 2))
    sources = {r["index"]: r for r in mixed.sources.collect()}
    assert {r["source"]: r["source_size"] for r in sources.values()} == dict(sizes)
    assert {r["source"]: r["target"] for r in sources.values()} == pytest.approx(want)
    taken, by_doc, by_word = collections.Counter(), collections.Counter(), collections.Counter()
    places = {r["place"]: r for r in mixed.docs.collect()}
    assert len(places) == len(rows)
    for r in got:
        source = sources[r["index"]]["source"]
        taken[source] += r["taken"]
        by_doc[r["place"]] += r["taken"]
        assert r["words"] == places[r["place"]]["words"][r["from"] : r["from"] + r["taken"]] and places[r["place"]]["source"] == source
        by_word.update((r["place"], k) for k in range(r["from"], r["from"] + r["taken"]))
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.5 + 1e-6 * target
        # Words of one source are taken as often as each other, to one pass.
        often = [by_word[p, k] for p, d in places.items() if d["source"] == source for k in range(d["size"])]
        assert not often or max(often) - min(often) <= 1
    assert all(n <= settings.get("passes", 2) * places[p]["size"] for p, n in by_doc.items())
    slots = [tuple(r) for r in mixed.slots.select("index", "slot", "shard").collect()]
    assert len(set(s[:2] for s in slots)) == len(slots)
    full = collections.Counter(s[2] for s in slots)
    assert sorted(full) == list(range(len(full))) and all(n == settings.get("shard", 256) for s, n in full.items() if s < len(full) - 1)
    return got, sources


def corpus(count, hot=False):
    names = ["b", "a", None, "é", "", "Z"]
    return [
        (None if k % 11 == 0 else k // 2, None if k % 13 == 0 else " \t".join(f"w{k}.{j}" for j in range(k * 7 % 23)), "b" if hot and k % 3 else names[k % 6])
        for k in range(count)
    ]


@pytest.mark.parametrize("block, shard", [(1, 5), (7, 4), (64, 256)])
def test_whole_mix(spark, block, shard):
    check(spark, corpus(150), block=block, shard=shard)


def test_hot_source_repeated_rows_and_long_texts(spark):
    rows = corpus(120, hot=True) + [(7, "one two three", "b")] * 150 + [(8, "long " * 5000, "a"), (9, "\x0b \n", "Z")]
    check(spark, rows, block=16, shard=8)


def test_other_settings(spark):
    check(spark, corpus(80), block=5, shard=3, weights=(1, 10), share=0.3)
    check(spark, corpus(80), block=5, shard=3, share=3.7, passes=3)
    check(spark, corpus(80), block=5, shard=3, share=5.0)  # more than two passes give


def test_shards_draw_by_the_targets(spark):
    rows = [(k, "x " * 64, "abc"[k % 3]) for k in range(900)]
    _, sources = check(spark, rows, block=8, shard=300)
    slots = mixing.mix(frame(spark, rows), block=8, shard=300).slots
    counts = {(r["shard"], r["index"]): r["count"] for r in slots.groupBy("shard", "index").count().collect()}
    total = sum(counts.values())
    for index, source in sources.items():
        share = source["wanted"] / total
        drawn = [counts.get((s, index), 0) for s in range(total // 300)]
        spread = (300 * share * (1 - share)) ** 0.5
        assert all(abs(n - 300 * share) < 5 * spread for n in drawn) and len(set(drawn)) > 1


def test_given_tables_and_reruns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first = mixing.mix_documents(docs).collect()
    again = mixing.mix_documents(docs.repartition(3).orderBy("text")).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again)) and len(first) == docs.count()
    sizes = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in first} == sizes
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in first)


def test_texts_and_files(spark, tmp_path):
    docs = frame(spark, corpus(60))
    texts = mixing.mixed_texts(docs, block=7, shard=4).collect()
    assert all(1 <= len(r["text"].split(" ")) <= 7 for r in texts)
    mixing.write_mix(docs, str(tmp_path / "mix"), block=7, shard=4)
    written = spark.read.parquet(str(tmp_path / "mix"))
    assert sorted((r["index"], r["slot"], r["text"]) for r in written.collect()) == sorted((r["index"], r["slot"], r["text"]) for r in texts)


def test_empty_tables(spark):
    assert mixing.mix_documents(frame(spark, [])).count() == 0
    got = mixing.mix_documents(frame(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_permutations(spark):
    for size in (1, 2, 3, 10, 97):
        ids = spark.range(size)
        key = [F.lit(5), F.lit(size)]
        there = ids.withColumn("to", mixing.permuted(F.col("id"), F.lit(size), key))
        back = there.withColumn("back", mixing.permuted(F.col("to"), F.lit(size), key, inverse=True)).collect()
        assert sorted(r["to"] for r in back) == list(range(size)) and all(r["back"] == r["id"] for r in back)
        if size > 10:
            assert [r["to"] for r in back] != list(range(size))
