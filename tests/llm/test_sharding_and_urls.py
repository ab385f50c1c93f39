import collections
import zlib

from quarterdeck.llm import sharding, url_rules
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string"


def test_interleaving_matches_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sharding.shard_rows(docs).collect()
    rows = docs.select("doc_id", "source", "text").collect()
    want = {d: (s, k) for d, s, k in brute.shards([(r["doc_id"], r["source"]) for r in rows], 40, 7)}
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want
    texts = {r["doc_id"]: r["text"] for r in rows}
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))


def test_interleaving_of_hot_sources_nulls_and_repeats(spark):
    rows = [(k, "x" * (k % 5), None, "hot" if k % 2 else None if k % 6 else f"s{k}", 1, "own") for k in range(500)]
    rows += [(7, "same", None, "hot", 1, "own")] * 200 + [(None, None, None, None, None, None)] * 3
    docs = spark.createDataFrame(rows, DOCS)
    got = sharding.shard_rows(docs, shards=9).collect()
    assert len(got) == len(rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(9)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1


def test_shards_match_the_mixture(spark):
    rows = [(k, "", None, "abc"[min(k % 7, 2)], 0, "") for k in range(1400)]
    narrow = spark.createDataFrame(rows, DOCS).drop("shard")
    shares = sharding.interleave(narrow, 10, 1).groupBy("shard", "source").count().collect()
    whole = collections.Counter(r[3] for r in rows)
    assert len(shares) == 30
    assert all(abs(r["count"] - whole[r["source"]] / 10) <= 1 for r in shares)


def test_empty_table(spark):
    assert sharding.shard_rows(spark.createDataFrame([], DOCS)).count() == 0
    assert url_rules.judge_pages(spark.createDataFrame([], "page_id long, url string, host string")).count() == 0


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "https://A.Net/x?q=http://b.org/fr/", "http://a.net#f",
    "http://example.net/en/1", "http://www.example.net/en/", "http://xexample.net/en/", "http://example.net/en",
    "http://example.com/de/x", "http://example.com.org/de/", "http://b.org/fr/y", "http://org/fr/", "http://borg/fr/",
    "http://a..net/x", "http://example.net./en/", "http://net:80/", "http://x/a\nb", "x://y://z.net/", "http://é.net/ü?",
]


def test_urls_match_plain_python(spark):
    rows = [(k, u, "clash") for k, u in enumerate(URLS * 3)] + [(None, "http://hot.net/", "clash")] * 400
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = collections.Counter(map(tuple, url_rules.judge_pages(pages).collect()))
    assert got == collections.Counter((k, *brute.judge_url(u, url_rules.RULES)) for k, u, _ in rows)


def test_nested_rules_and_many_partitions(spark):
    rules = [("com", "/", "a"), ("b.com", "/x", "b"), ("b.com", "/", "c"), ("a.b.com", "/", "d"), ("c.com", "/", "e"), ("z", "", "f")]
    hosts = ["com", "b.com", "a.b.com", "q.a.b.com", "ab.com", "c.com", "d.com", "z", "y.z", "co", "comz"]
    rows = [(k, f"http://{h}{p}") for k, (h, p) in enumerate((h, p) for h in hosts for p in ("", "/", "/x", "/xy/z") for _ in range(20))]
    frame = url_rules.rules_table(spark, rules)
    got = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string"), frame, default="none")
    want = sorted((k, u, *brute.judge_url(u, rules, "none")) for k, u in rows)
    assert sorted(map(tuple, got.collect())) == want


def test_no_rules(spark):
    frame = url_rules.rules_table(spark, []).union(spark.createDataFrame([(None, "/", "block")], "h string, p string, v string"))
    got = url_rules.judge(spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string"), frame).collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [(None, "allow")]


def test_hosts_after_a_hot_one_without_adaptive_execution(spark):
    rows = [(k, f"http://hot.net/{k}") for k in range(6000)] + [(6000 + k, f"http://hox{k}.net/") for k in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(8)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for n in (13, 24):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got = url_rules.judge(pages, url_rules.rules_table(spark, [("hot.net", "/", "block")])).collect()
            assert {r["page_id"] for r in got if r["verdict"] == "block"} == set(range(6000))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
