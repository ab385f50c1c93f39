import corpus_pipeline
from quarterdeck.llm import classifier, decontamination, secrets, simhash
from quarterdeck.llm.common import landed, table
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_stages_follow_each_other(spark):
    docs = table(spark, SF, "documents")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing",
    ]
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in at.select("doc_id", "text").collect()}
        at = landed(stage(spark, at, SF), name)
        if name == "best_fit_packing":
            assert {r["doc_id"] for r in at.collect()} == set(before)
            break
        assert at.columns == columns
        after = {r["doc_id"]: r["text"] for r in at.select("doc_id", "text").collect()}
        assert set(after) <= set(before) <= ids
        if name == "simhash_near_dedup":
            rows = sorted(before.items())
            roots = brute.components([brute.fingerprint(t) for _, t in rows], 3)
            assert set(after) == {rows[i][0] for i in set(roots)}
        if name == "benchmark_decontamination":
            assert set(before) - set(after) and all(after[d] == before[d] for d in after)
        if name == "secret_scans":
            assert set(after) == set(before) and not any(secrets.scan(t) for t in after.values())
            assert any(after[d] != before[d] for d in after)


def test_stages_on_an_empty_table(spark):
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_stages_keep_other_columns(spark):
    docs = spark.createDataFrame(
        [(1, "good words in a text", "en", "s", 5, [1]), (None, None, None, None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long, more array<int>",
    )
    items = table(spark, SF, "benchmark")
    for kept in (
        classifier.accepted(docs, table(spark, SF, "labels")), simhash.one_of_each(docs), decontamination.clean(docs, items), secrets.redacted(docs),
    ):
        assert kept.columns == docs.columns and kept.count() == 2


def test_columns_that_the_stages_would_use_themselves(spark):
    """A caller's own `_row`, `_score` and `_fingerprint` come back as they were."""
    from quarterdeck.llm import classifier, decontamination, simhash

    rows = [(k, f"some words of text number {k} that stand here", "own", 7, "x") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string, _score int, _fingerprint string")
    labels = spark.createDataFrame([(k, 1) for k in range(20)], "doc_id long, quality int")
    items = spark.createDataFrame([(1, "nothing of that kind is in any of the texts")], "item_id long, text string")
    for kept in (classifier.accepted(docs, labels), simhash.one_of_each(docs), decontamination.clean(docs, items)):
        assert kept.columns == docs.columns
        assert {tuple(r)[2:] for r in kept.collect()} == {("own", 7, "x")}
