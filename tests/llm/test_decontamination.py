import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterdeck.llm import decontamination as d

DOCS = "doc_id long, text string, lang string, source string, item_id string, hash string"
QUESTION = (
    "On Monday Alice drove 120 km to meet Robert, and then Alice drove another 80 km back to the old station."
    " How many km did Alice drive in total on that day?"
)
OTHER = "a train with nine wagons leaves the northern harbour before dawn and carries salt to the mills along the quiet river"


def swapped(text, **pairs):
    for a, b in pairs.items():
        text = text.replace(a.strip("_"), b)
    return text


def filler(k, n=60):
    rng = np.random.default_rng(k)
    return " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))


CASES = {
    1: filler(1) + ". " + QUESTION + " " + filler(2),
    2: filler(3) + ". " + swapped(QUESTION, Alice="Bertha", Robert="Karl", _120="45", _80="300") + " " + filler(4),
    3: filler(5) + ". " + QUESTION.replace("then Alice", "then Carol").replace("did Alice", "did Dora"),
    4: filler(6, 400),
    5: OTHER.upper().replace("THE ", "THE, "),
    6: " ".join(OTHER.split()[:9]) + " " + filler(7),
    7: None,
    8: "",
}
ITEMS = [(10, QUESTION), (11, OTHER), (12, "too short"), (13, None), (None, OTHER), (14, "seven plain words make up this question")]


def frames(spark):
    docs = spark.createDataFrame([(k, t, "en", "s", "clash", "clash") for k, t in CASES.items()], DOCS)
    return docs, spark.createDataFrame([(k, t, "clash") for k, t in ITEMS], "item_id long, text string, doc_id string")


def test_copies_and_re_parameterised_questions(spark):
    docs, items = frames(spark)
    got = {(r["doc_id"], r["item_id"]): r["n_changed"] for r in d.leaks(docs, items).collect()}
    assert set(got) == {(1, 10), (2, 10), (5, 11)}  # in 3 one name has three replacements, 6 holds too little
    assert got[1, 10] == 0 and got[2, 10] >= 4


def test_clean_keeps_the_rest(spark):
    docs, items = frames(spark)
    extra = docs.limit(0).union(spark.createDataFrame([(None, "null id stays", None, None, None, None)] * 2, DOCS))
    kept = d.clean(docs.union(extra), items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 3, 4, 6, 7, 8]
    leaked_null = spark.createDataFrame([(None, QUESTION, None, None, None, None), (4, filler(8), None, None, None, None)], DOCS)
    assert [r["doc_id"] for r in d.clean(leaked_null, items).collect()] == [4]


def test_short_items_and_empty_tables(spark):
    docs, items = frames(spark)
    own = spark.createDataFrame([(1, filler(1) + " Seven plain words make up this question! " + filler(2), "", "", "", "")], DOCS)
    assert [(r["doc_id"], r["item_id"]) for r in d.leaks(own, items).collect()] == [(1, 14)]
    assert d.leaks(docs.limit(0), items).count() == 0 and d.leaks(docs, items.limit(0)).count() == 0
    assert d.clean(docs, items.limit(0)).count() == len(CASES)


def test_same_windows_as_plain_python(spark):
    """Leaks of verbatim text equal those found by comparing word windows."""
    sf = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    words = lambda t: (t or "").lower().split()
    want = set()
    windows = {}
    for r in items.collect():
        w = words(r["text"])
        for k in range(len(w) - 7):
            windows.setdefault(tuple(w[k : k + 8]), set()).add(r["item_id"])
    sizes = {r["item_id"]: len(words(r["text"])) - 7 for r in items.collect()}
    for r in docs.select("doc_id", "text").collect():
        w, hits = words(r["text"]), {}
        for k in range(len(w) - 7):
            for item in windows.get(tuple(w[k : k + 8]), ()):
                hits[item] = hits.get(item, 0) + 1
        want |= {(r["doc_id"], i) for i, n in hits.items() if n >= 0.5 * sizes[i]}
    got = {(r["doc_id"], r["item_id"]) for r in d.leaks(docs, items).collect()}
    assert want and got == want


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80))
def test_canonical_forms_of_any_text(text):
    template, kind, value = d.Templates().canonical(text.encode("utf-8", "replace").decode())
    assert len(template) == len(kind) == len(value)


def test_placeholders():
    t = d.Templates()
    kinds = lambda text: t.canonical(text)[1].tolist()
    assert kinds("The car cost $1,200.50 and ran 40 km to Paris. It was five days old, 3kg") == [0, 0, 0, 1, 0, 0, 1, 3, 0, 2, 0, 0, 1, 3, 0, 3]
    assert np.array_equal(t.canonical("He paid 3 dollars to Ann.")[0], t.canonical("he paid 9,50 euros to Bob")[0])
    assert not np.array_equal(t.canonical("He paid 3 dollars to Ann.")[0], t.canonical("He paid Ann dollars to 3.")[0])


def test_filter_lets_all_of_the_benchmark_through(spark):
    _, items = frames(spark)
    cut = d.item_windows(items)
    words, bits = d.filter_bits(cut)
    hashes = np.array([r["hash"] for r in cut.collect()], dtype=np.int64).view(np.uint64)
    assert d._passes(hashes, words, bits).all()
    assert d._passes(np.random.default_rng(0).integers(0, 1 << 62, 10_000, dtype=np.uint64), words, bits).mean() < 0.01


def leaked(spark, texts, items):
    docs = spark.createDataFrame([(k, t, "", "", "", "") for k, t in enumerate(texts)], DOCS)
    found = d.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r["doc_id"], r["item_id"]) for r in found}


def test_inserted_and_dropped_words_hide_nothing(spark):
    for n in (14, 37, 50):
        item = filler(n, n).split()
        texts = [" ".join([filler(1), *item[:k], "newword", *item[k:], filler(2)]) for k in range(n + 1)]
        texts += [" ".join([filler(1), *item[:k], *item[k + 1 :], filler(2)]) for k in range(n)]
        got = {k for k, _ in leaked(spark, texts, [(1, " ".join(item))])}
        # with 14 words no window but one or two is left of an item whose middle word is gone
        need = [len([i for i in range(n - 7) if k <= i or i + 8 <= k]) for k in range(n + 1)]
        need += [len([i for i in range(n - 7) if k < i or i + 8 <= k]) for k in range(n)]
        assert got == {k for k, left in enumerate(need) if left >= 0.5 * (n - 7) or left >= 24}
        assert n == 14 or len(got) == len(texts)


def test_slots_refilled_with_another_number_of_words(spark):
    texts = [
        swapped(QUESTION, Alice="Mary Ann", Robert="Karl von Berg"), swapped(QUESTION, _120="twenty five", _80="one hundred"),
        QUESTION.replace("120 km", "120km").replace("80 km", "45km"), swapped(QUESTION, _120="twenty-five"),
    ]
    assert leaked(spark, [f"{filler(1)}. {t} {filler(2)}" for t in texts], [(10, QUESTION)]) == {(k, 10) for k in range(4)}
    forms = [d.Templates().collapsed(t) for t in ("it ran 120 km to the sea", "it ran 120km to the sea")]
    assert all(np.array_equal(a, b) for a, b in zip(*forms))


def test_contradicting_slots_drop_their_windows_only(spark):
    story = f"Once {QUESTION[3:]} {OTHER}. It then happened that Alice wrote down how many bags of salt the mills had taken from them"
    fruit = "a farmer fills her basket with 5 apples and 5 pears before she walks along the river to the market where she sells all of it and"
    fruit += " then goes home again to count what is left of the fruit"
    texts = [story.replace("then Alice", "then Carol", 1), fruit.replace("5 apples", "3 apples").replace("5 pears", "7 pears")]
    assert leaked(spark, [f"{filler(1)}. {t} {filler(2)}" for t in texts], [(0, story), (1, fruit)]) == {(0, 0), (1, 1)}


def test_rows_are_judged_by_themselves(spark):
    _, items = frames(spark)
    changed = swapped(QUESTION, Alice="Bertha", Robert="Karl", _120="45"), swapped(QUESTION, Alice="Dora", Robert="Paul", _120="77")
    texts = [(None, QUESTION), (None, "a clean row without an id"), (None, None), (5, changed[0]), (5, changed[1]), (5, filler(9))]
    docs = spark.createDataFrame([(k, t, "", "", "", "") for k, t in texts], DOCS)
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in d.leaks(docs, items).collect()) == [(0, 10), (5, 10), (5, 10)]
    assert {(r["doc_id"], r["text"]) for r in d.clean(docs, items).collect()} == {texts[1], texts[2], texts[5]}
