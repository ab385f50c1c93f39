import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import classifier, lm
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, score string, held_out string, block string"


def test_features_are_words_and_grams():
    rows = lambda t: sorted(classifier.feature_rows(t).tolist())
    assert rows(None) == rows("") == rows(" \n") == []
    assert rows("ab cd ab") == sorted(rows("ab") * 2 + rows("cd"))
    assert len(rows("abc")) == 1 + 3 + 2 + 1  # the word, and n-grams of its five marked letters
    many = " ".join(f"w{k}" for k in range(300))
    assert rows(many) == sorted(sum((rows(f"w{k}") for k in range(300)), []))


def test_features_do_not_depend_on_steps(monkeypatch):
    text = "some words that are hashed in small steps and in one"
    whole = sorted(classifier.feature_rows(text).tolist())
    monkeypatch.setattr(classifier, "WORDS_AT_ONCE", 2)
    assert sorted(classifier.feature_rows(text).tolist()) == whole


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = classifier.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    judged = scores.filter("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    good, bad = (judged[judged.quality == q].score.to_numpy() for q in (1, 0))
    assert (judged.predicted == judged.quality).mean() > 0.94
    assert (good[:, None] > bad[None, :]).mean() > 0.85
    assert (good >= classifier.THRESHOLD).mean() > 0.98


def test_classifier_on_awkward_tables(spark):
    rows = [(k, f"fine words here {k}" if k % 2 else f"junk### junk### {k}", "en", "c", "c", "c") for k in range(60)]
    rows += [(None, "null id", None, None, None, None), (90, None, "en", "c", "c", "c"), (91, "", "en", "c", "c", "c"), (7, "twice", "en", "c", "c", "c")]
    rows.append((92, "long " * 200_000, "en", "c", "c", "c"))
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)] + [(None, 1, 0), (91, None, 0), (3, 1, 0), (5, 7, 0)], "doc_id long, quality int, text int")
    got = classifier.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    unlabelled = classifier.classify(docs, labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
    assert classifier.classify(docs.limit(0), labels).count() == 0
    kept = classifier.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in got)


def check_base(rows, got):
    want = brute.base_scores(rows)
    assert len(got) == len(rows)
    for r in got:
        held_out, n, known, train, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held_out, n, known, train)
        assert abs(r["base_score"] - base) < 1e-8 * max(1, abs(base)) and r["score"] <= 1e-9


def test_lm_base_matches_plain_python(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lm.score_documents(docs).collect()
    check_base([tuple(r) for r in docs.select("doc_id", "text").collect()], got)
    # The model beats the unigrams on text that it has not seen.
    unseen = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_lm_on_awkward_tables(spark):
    rows = [(k, t) for k, t in enumerate([None, "", "A b", "a B a", "é É", "w " * 100_000, " \x0b\x0c ", "end"] * 4)] + [(None, "nothing known")]
    docs = spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], DOCS)
    check_base(rows, lm.score_documents(docs).collect())
    held_out = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
    got = lm.score_documents(held_out).collect()
    assert got and all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in got)
    assert lm.score_documents(docs.limit(0)).count() == 0


def corpus_of(known, tokens, distinct):
    return lm.Corpus(sum(c for _, c in known) + int(tokens.sum()), len(known) + int(distinct.sum()), known, tokens, distinct)


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    tokens, distinct = np.zeros(lm.ENDINGS, np.int64), np.zeros(lm.ENDINGS, np.int64)
    tokens[3], distinct[3] = 30, 5
    corpus = corpus_of([("", 10), ("the", 90), ("of", 40)], tokens, distinct)
    model = lm.start(corpus.noise())
    for a in model.arrays():
        a += rng.normal(0, 0.7, a.shape)
    scorer = lm.Scorer(model, corpus)
    n = len(corpus.noise())
    for one, two in ((n, n), (3, n), (n - 1, 5)):
        # Every word that can follow: known ones, counted ones of an ending, and each ending's unseen one.
        total = 0.0
        for k in range(n):
            share = 10 ** ((scorer.one[one, k] + scorer.two[two, k] - scorer.log_z[one, two]) / np.log(10))
            seen = [30 // 5] * 5 if k == 3 else []
            inside = sum((c + 1) / (tokens[k] + distinct[k] + 1) for c in [*seen, 0]) if k < lm.ENDINGS else 1
            total += share * inside
        assert total == pytest.approx(1, abs=1e-9)


def test_noise_contrastive_training_learns_a_chain():
    """In a text where each word fixes the next, the model gets far below the unigram entropy."""
    counts = np.zeros(lm.ENDINGS, np.int64)
    corpus = corpus_of([("", 1), *((f"w{k}", 1000) for k in range(6))], counts, counts)
    noise = corpus.noise()
    k = lm.ENDINGS + 1 + np.arange(30_000) % 6
    starts = np.array([0])
    trainer = lm.Trainer(lm.start(noise), noise, 1)
    for _ in range(5):
        trainer.block(k, starts)
    scorer = lm.Scorer(trainer.model, corpus)
    assert scorer.log10(k, np.zeros(len(k)), starts).mean() > 0.4 * np.log10(1 / 6)


def test_an_id_that_comes_often_is_learned_once(spark):
    docs = [(k, ("good words here " if k % 2 else "bad stuff there ") * 9) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    repeated = frame.unionByName(spark.createDataFrame([(1, docs[1][1])] * 3000 + [(3, None)], "doc_id long, text string"))
    once, often = classifier.fit(frame.filter("doc_id <> 3"), labels), classifier.fit(repeated.filter("doc_id <> 3"), labels)
    assert (once.vectors == often.vectors).all() and (once.bias == often.bias).all()
    assert classifier.classify(repeated, labels).count() == 3201
