"""Quality rules: word and line counts, and divergence of a document's histograms from its language's.

Two histograms per document, of character classes and of its language's common words, are compared with the same
histograms pooled over the language by the Jensen-Shannon distance (base 2, 0 to 1). Built-in functions only; the
pooled references are one row per known language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import SPACES, landed, let

#: Frequent function words per language. Fixed values.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht".split(),
    "en": "the of and to in a is that for it as was with be by on".split(),
    "es": "de la que el en y a los se del las un por con no una".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par".split(),
}
N_WORDS = 16
CLASSES = ("lower", "upper", "letter", "digit", "plain", "other")
#: Punctuation of ordinary prose.
PLAIN_MARKS = ".,;:?'\"()-"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Largest distances of a kept document; a histogram of fewer than the least number of entries is not judged.
MAX_CLASS_DISTANCE = 0.15
MAX_WORD_DISTANCE = 0.35
MIN_CLASS_CHARS = 200
MIN_COMMON_OF_WORDS = 80


def _repeated_words(words: str) -> Column:
    """Words inside 3-word windows that occur twice or more in the text, first occurrences included.

    Windows are told apart by a 64-bit hash. Only a text with fewer distinct hashes than windows is sorted.
    """
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashed = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(3))))
    return F.when(F.size(words) >= 3, hashed).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: str) -> Column:
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(ordered: Column) -> Column:
        """Positions, in text order, of the windows that stand beside an equal one when sorted by hash."""
        same = lambda x, i: (x["h"] == F.get(ordered, i + 1)["h"]) | (x["h"] == F.get(ordered, i - 1)["h"])
        found = F.filter(ordered, lambda x, i: F.coalesce(same(x, i), F.lit(False)))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        """A window adds the words that the window before it does not cover."""
        added = F.transform(
            at, lambda x, i: F.when(i == 0, F.lit(3)).otherwise(F.least(x - F.get(at, i - 1), F.lit(3)))
        )
        return F.aggregate(added, F.lit(0), lambda total, x: total + x)

    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(some, let(let(pairs, repeated), covered)).otherwise(F.lit(0))


def measure(docs: DataFrame) -> DataFrame:
    """The base counts and both histograms of every whole text: doc_id, language, counts, classes, common.

    A null text has no words. `language` is empty for a null or unknown language; its `common` histogram is all zero.
    """
    known = F.col("lang").isin(*COMMON_WORDS)
    text = docs.select(
        "doc_id",
        F.when(known, F.col("lang")).otherwise(F.lit("")).alias("language"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    split = text.select(
        "doc_id",
        "language",
        F.array_remove(F.split("text", SPACES, -1), "").alias("words"),
        F.regexp_replace("text", SPACES, "").alias("solid"),
        F.filter(F.split("text", "\n", -1), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))).alias("lines"),
    )
    lists = F.create_map(*(F.lit(x) for k, v in COMMON_WORDS.items() for x in (k, v)), F.lit(""), F.array().cast("array<string>"))
    counted = split.select(
        "doc_id",
        "language",
        F.size("words").alias("n_words"),
        F.length("solid").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _repeated_words("words").alias("windows"),
        F.regexp_replace("solid", r"\p{Ll}+", "").alias("no_lower"),
        F.transform(
            F.element_at(lists, F.col("language")),
            lambda w: F.size("words") - F.size(F.array_remove("words", w)),
        ).alias("common"),
    )
    peeled = counted.withColumn("no_upper", F.regexp_replace("no_lower", r"\p{Lu}+", ""))
    peeled = peeled.withColumn("no_letter", F.regexp_replace("no_upper", r"\p{L}+", ""))
    peeled = peeled.withColumn("no_digit", F.regexp_replace("no_letter", r"\p{N}+", ""))
    other = F.length(F.translate("no_digit", PLAIN_MARKS, ""))
    lengths = [F.col("word_chars"), *(F.length(c) for c in ("no_lower", "no_upper", "no_letter", "no_digit")), other]
    classes = [a - b for a, b in zip(lengths, lengths[1:], strict=False)] + [other]
    return peeled.select(
        "doc_id",
        "language",
        F.col("n_words").cast("long"),
        F.col("word_chars").cast("long"),
        (F.length("no_lower") - F.length(F.translate("no_lower", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long"),
        _covered("windows").cast("long").alias("n_repeat_words"),
        F.array(*(c.cast("long") for c in classes)).alias("classes"),
        F.when(F.size("common") > 0, F.transform("common", lambda c: c.cast("long")))
        .otherwise(F.array_repeat(F.lit(0).cast("long"), N_WORDS)).alias("common"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
    )


def references(chosen: DataFrame) -> DataFrame:
    """Histograms pooled over the chosen documents of each known language, and over those of all languages ('')."""
    sums = [F.sum(F.col(c)[i]).alias(f"{c}_{i}") for c, n in (("classes", len(CLASSES)), ("common", N_WORDS)) for i in range(n)]
    total = [F.sum("n_words").alias("words")]
    by_language = chosen.filter("language <> ''").groupBy("language").agg(*sums, *total)
    everything = chosen.groupBy(F.lit("").alias("language")).agg(*sums, *total)
    return by_language.unionByName(everything).select(
        "language",
        F.array(*(f"classes_{i}" for i in range(len(CLASSES)))).alias("ref_classes"),
        F.array(*(f"common_{i}" for i in range(N_WORDS))).alias("ref_common"),
        F.col("words").alias("ref_words"),
    )


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms given as counts; null if one of them is empty."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x).cast("double")
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def term(x: Column, y: Column) -> Column:
        m = (x["p"] + y["p"]) / 2
        return (part(x["p"], m) + part(y["p"], m)) / 2

    share = lambda a: F.transform(a, lambda x: F.struct((x / F.nullif(total(a), F.lit(0.0))).alias("p")))
    terms = F.zip_with(share(counts), share(reference), term)
    distance = F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))
    return F.when((total(counts) > 0) & (total(reference) > 0), distance)


def _compared(measured: DataFrame, found: DataFrame) -> DataFrame:
    """Add both distances from the references found, and whether they are small enough."""
    counted = measured.join(F.broadcast(found), "language", "left")  # a row per known language and one for all
    rest = lambda common, words: F.concat(common, F.array(words - F.aggregate(common, F.lit(0).cast("long"), lambda s, x: s + x)))
    words = js_distance(rest(F.col("common"), F.col("n_words")), rest(F.col("ref_common"), F.col("ref_words")))
    distances = counted.withColumns(
        {
            "class_distance": js_distance(F.col("classes"), F.col("ref_classes")),
            "word_distance": F.when(F.col("language") != "", words),
        }
    )
    far = (F.col("word_chars") >= MIN_CLASS_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)
    odd = (F.col("n_words") >= MIN_COMMON_OF_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE)
    alike = ~F.coalesce(far, F.lit(False)) & ~F.coalesce(odd, F.lit(False))
    return distances.withColumn("kept", ~F.col("base_failed") & alike).drop("ref_classes", "ref_common", "ref_words")


def judge(docs: DataFrame) -> DataFrame:
    """All rows of `docs` with counts, distances and verdict.

    Fails: the base rules, or a histogram too far from the reference of the document's language. References are pooled
    twice: over all documents that pass the base rules, then over those of them that are near the first pooling, so odd
    documents do not blur what they are held against. Documents of unknown language have no common-word histogram and are
    held against the characters of all languages. Distances are null where a histogram or its reference is empty; that
    never fails a document. Columns beside doc_id, text and lang are not read.
    """
    measured = landed(measure(docs), "quality")
    first = references(measured.filter(~F.col("base_failed")))
    return _compared(measured, references(_compared(measured, first).filter("kept").select(measured.columns)))


def _sql_distances(chosen: str) -> str:
    """Jensen-Shannon distances of all histograms from those pooled over the chosen documents."""
    return f"""(
  SELECT r, kind, sqrt(greatest(sum(
      CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END
    ) / 2, 0)) AS d
  FROM (
    SELECT r, kind, n / nullif(sum(n) OVER (PARTITION BY r, kind), 0) AS p,
      m / nullif(sum(m) OVER (PARTITION BY r, kind), 0) AS q
    FROM hist JOIN (
      SELECT language, kind, bin, sum(n) AS m FROM hist WHERE r IN (SELECT r FROM {chosen}) AND language <> '' GROUP BY ALL
      UNION ALL SELECT '', kind, bin, sum(n) FROM hist WHERE r IN (SELECT r FROM {chosen}) AND kind = 'class' GROUP BY ALL
    ) USING (language, kind, bin)
  ) GROUP BY r, kind
)"""


def _sql_kept(distances: str) -> str:
    return f"""(
  SELECT r FROM base WHERE NOT base_failed
    AND NOT (word_chars >= {MIN_CLASS_CHARS} AND coalesce((SELECT d FROM {distances} x WHERE x.r = base.r AND kind = 'class'), 0) > {MAX_CLASS_DISTANCE})
    AND NOT (n_words >= {MIN_COMMON_OF_WORDS} AND coalesce((SELECT d FROM {distances} x WHERE x.r = base.r AND kind = 'word'), 0) > {MAX_WORD_DISTANCE})
)"""


_LISTS = " ".join(f"WHEN '{k}' THEN [{', '.join(repr(w) for w in v)}]" for k, v in COMMON_WORDS.items())
SQL = rf"""
WITH t AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    CASE WHEN lang IN ({", ".join(repr(k) for k in COMMON_WORDS)}) THEN lang ELSE '' END AS language
  FROM documents
), w AS MATERIALIZED (
  SELECT r, doc_id, language, list_filter(regexp_split_to_array(text, '{SPACES}'), lambda x: x <> '') AS words,
    regexp_replace(text, '{SPACES}', '', 'g') AS solid,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), covered AS MATERIALIZED (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows), (VALUES (0), (1), (2)) AS s(k)
  WHERE n > 1 GROUP BY r
), peeled AS (
  SELECT *, regexp_replace(solid, '\p{{Ll}}+', '', 'g') AS no_lower FROM w
), peeled2 AS (
  SELECT *, regexp_replace(no_lower, '\p{{Lu}}+', '', 'g') AS no_upper,
    regexp_replace(no_lower, '\p{{L}}+', '', 'g') AS no_letter, regexp_replace(no_lower, '[\p{{L}}\p{{N}}]+', '', 'g') AS no_digit
  FROM peeled
), base AS MATERIALIZED (
  SELECT r, doc_id, language, words, len(words) AS n_words, length(solid) AS word_chars,
    length(regexp_replace(no_digit, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(words) < {MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MAX_REPEATED_PERCENT} * len(words) AS base_failed,
    [length(solid) - length(no_lower), length(no_lower) - length(no_upper), length(no_upper) - length(no_letter),
     length(no_letter) - length(no_digit), length(regexp_replace(no_digit, '[^.,;:?''"()-]', '', 'g')),
     length(regexp_replace(no_digit, '[.,;:?''"()-]', '', 'g'))] AS classes
  FROM peeled2 LEFT JOIN covered USING (r)
), counted AS (
  SELECT r, language, n_words, list_transform(CASE language {_LISTS} END, lambda c: len(list_filter(words, lambda x: x = c))) AS common
  FROM base WHERE language <> ''
), hist AS MATERIALIZED (
  SELECT r, language, 'class' AS kind, unnest(range(1, {len(CLASSES) + 1})) AS bin, unnest(classes) AS n FROM base
  UNION ALL
  SELECT r, language, 'word', unnest(range(1, {N_WORDS + 2})), unnest(list_append(common, n_words - list_sum(common))) FROM counted
), first AS (SELECT r FROM base WHERE NOT base_failed),
d1 AS MATERIALIZED {_sql_distances("first")},
near AS MATERIALIZED {_sql_kept("d1")},
d2 AS MATERIALIZED {_sql_distances("near")},
good AS MATERIALIZED {_sql_kept("d2")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, r IN (SELECT r FROM good) AS kept
FROM base
"""

CONTRACT = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()


def judge_documents(docs: DataFrame) -> DataFrame:
    return judge(docs).select(*CONTRACT)
