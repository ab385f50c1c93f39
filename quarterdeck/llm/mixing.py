"""Mixing sources to target weights.

A source's documents, in a seeded order, are one stream of words, cut into blocks of fixed length. Output shards hold a
fixed number of block slots; each shard draws multinomial counts of its slots per source. Draws beyond a source's quota are
dealt anew to sources short of theirs, so every source gets its target to the word. A source's slots map to its blocks
through pseudorandom permutations of the block numbers, one per pass over the source, so no block comes again before all
others had their turn, and the blocks are joined to the slots by source and number. Built-in functions only; what goes
through the driver are totals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import SPACES, landed, running

#: Words of a block, blocks of a shard.
BLOCK = 512
SHARD = 256
#: Weights of the sources in order, repeating; share of all words to take; passes over a source at most.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
SEED = 11
#: Rounds of the permutation.
ROUNDS = 24


@dataclass
class Mix:
    """sources: index, source, source_size, target, quota, ...; docs: place, doc_id, source, size, index, start, and the
    words if kept; slots: index, slot, shard, block, cut (words taken of the block)."""

    sources: DataFrame
    docs: DataFrame
    slots: DataFrame
    block: int


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES, -1), "")


def permuted(index: Column, size: Column, key: list[Column], inverse: bool = False) -> Column:
    """A pseudorandom permutation of 0 to size - 1, chosen by `key`: swap-or-not, which needs no power of two.

    A round pairs x with k - x (mod size) and swaps the pair or not by a coin of the larger, so a round is its own inverse.
    """

    def round_(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        coin = F.xxhash64(*key, r, F.greatest(x, partner), F.lit("coin")).bitwiseAND(1)
        return F.when(coin == 1, partner).otherwise(x)

    numbers = range(ROUNDS)[::-1] if inverse else range(ROUNDS)
    return F.aggregate(F.array(*map(F.lit, numbers)), index.cast("long"), round_)


def targets(sources: DataFrame, share: float, passes: int) -> DataFrame:
    """Add `target`: shares by `weight`, none above `passes` times its source's size, the excess shared anew.

    Each round adds sources that reach their bound; the round's totals alone pass the driver.
    """
    bound = passes * F.col("source_size")
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    before, full, open_weight = None, 0, sources.agg(F.sum("weight")).first()[0]
    level = 0.0
    while open_weight and (full, open_weight) != before:
        before, level = (full, open_weight), (total - full) / open_weight
        at_bound = F.col("weight") * F.lit(level) >= bound
        full, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(at_bound, bound)), F.lit(0)), F.sum(F.when(~at_bound, F.col("weight")))
        ).first()
    level = level if open_weight else float("inf")
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), bound.cast("double")))


def _quotas(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """Add quota (words), blocks, wanted (slots) and last_cut, the words taken of the last slot.

    A slot is worth a block, but the source's last block may be shorter; where it comes in the last pass decides how many
    slots the rest of the quota needs.
    """
    size, rest, at = F.col("source_size"), F.col("_rest"), F.col("_at")
    before = lambda n: F.when(n <= at, n * block).otherwise((n - 1) * block + F.col("_short"))
    return (
        sources.withColumn("quota", F.round("target").cast("long"))
        .withColumn("blocks", F.ceil(size / block).cast("long"))
        .withColumns(
            {
                "_pass": F.when(size > 0, F.expr("quota div source_size")).otherwise(0),
                "_rest": F.when(size > 0, F.col("quota") % size).otherwise(0),
                "_short": size - (F.col("blocks") - 1) * block,
            }
        )
        .withColumn("_at", F.when(size > 0, permuted(F.col("blocks") - 1, F.col("blocks"), _pass_key(F.col("_pass"), seed), True)))
        .withColumn(
            "_more",
            F.when(rest == 0, 0)
            .when(rest <= at * block, F.ceil(rest / block))
            .when(rest <= at * block + F.col("_short"), at + 1)
            .otherwise(F.ceil((rest - F.col("_short")) / block) + 1).cast("long"),
        )
        .withColumn("wanted", F.col("_pass") * F.col("blocks") + F.col("_more"))
        .withColumn("last_cut", F.when(rest > 0, rest - before(F.col("_more") - 1)).otherwise(F.lit(block)).cast("long"))
        .drop("_pass", "_rest", "_short", "_at", "_more")
    )


def _pass_key(number: Column, seed: int) -> list[Column]:
    return [F.lit(seed), F.col("index"), number]


def _units(df: DataFrame, count: str) -> DataFrame:
    """`count` rows for each row, numbered by `unit` from 0."""
    return df.filter(F.col(count) > 0).withColumn("unit", F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1)))


def _dealt(sources: DataFrame, shard: int, seed: int) -> DataFrame:
    """index, slot (0 to wanted - 1) and shard: multinomial counts per shard, then the excess to sources short of slots."""
    spark = sources.sparkSession
    total, members = sources.agg(F.coalesce(F.sum("wanted"), F.lit(0)), F.count("*")).first()
    # Drawn numbers find their source by equal stretches of numbers; a source lists those it reaches into.
    width = max(total // (4 * max(members, 1)), 1)
    reach = sources.filter("wanted > 0").select(
        "index", "low", "wanted",
        F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(low + wanted - 1) div {width}"))).alias("stretch"),
    )
    drawn = spark.range(total).select(
        F.expr(f"id div {shard}").alias("shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(total, 1))).alias("drawn")
    )
    hit = drawn.withColumn("stretch", F.expr(f"drawn div {width}")).join(reach, "stretch").filter("drawn >= low and drawn < low + wanted")
    counts = running(hit.groupBy("index", "shard").agg(F.count("*").alias("n")), [F.col("index"), F.col("shard")], {"from": F.col("n")}, "draws")
    drew = counts.groupBy("index").agg(F.min("from").alias("lead"), F.sum("n").alias("drew"))
    state = landed(
        sources.join(drew, "index", "left").select("index", "wanted", "lead", F.coalesce("drew", F.lit(0)).alias("drew")), "drew"
    )
    # A source's draws take its slots in a permuted order, so those beyond its quota come from all shards alike.
    drawn_slot = permuted(F.col("from") - F.col("lead") + F.col("unit"), F.col("drew"), [F.lit(seed), F.lit("draw"), F.col("index")])
    units = _units(counts, "n").join(state, "index").select("index", "shard", "wanted", drawn_slot.alias("slot"))
    units = landed(units, "drawn")
    kept = units.filter("slot < wanted").select("index", "slot", "shard")
    free = running(units.filter("slot >= wanted"), [F.col("index"), F.col("slot")], {"rank": F.lit(1).cast("long")}, "free")
    lacking = state.filter("drew < wanted").withColumn("lack", F.col("wanted") - F.col("drew"))
    lacking = running(lacking.select("index", "drew", "lack"), [F.col("index")], {"rank": F.col("lack")}, "lacking")
    open_ = max(lacking.agg(F.sum("lack")).first()[0] or 0, 1)
    places = free.select("shard", permuted(F.col("rank"), F.lit(open_), [F.lit(seed), F.lit("free")]).alias("turn"))
    takers = _units(lacking, "lack").select("index", (F.col("drew") + F.col("unit")).alias("slot"), (F.col("rank") + F.col("unit")).alias("turn"))
    return kept.unionByName(takers.join(places, "turn").select("index", "slot", "shard"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = SEED,
    keep_words: bool = False,
) -> Mix:
    """Mix all documents: `share` times all their words, dealt to the sources by weight.

    A null text and one of white space have no words; such rows and sources without words take nothing. A null source is a
    source of its own, the last. Repeated rows each count. An empty table gives an empty mix. Columns beside doc_id, source
    and text are not read.
    """
    kept = words_of(F.col("text"))
    size = F.size(kept) if keep_words else F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    read = docs.select(
        "doc_id", "source", size.cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("check"), *([kept.alias("words")] if keep_words else []),
    )
    measured = landed(read, "measured")
    by_source = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    numbered = running(by_source, order, {"index": F.lit(1).cast("long"), "first": F.col("source_size")}, "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("index") % len(weights)).cast("int") + 1)
    weighed = landed(numbered.withColumn("weight", weight), "weights")
    wanted = _quotas(targets(weighed, share, passes), block, seed)
    sources = running(wanted, [F.col("index")], {"low": F.col("wanted")}, "quotas")

    # Rows that are equal in all of this differ by a random number, so that they spread; their places are interchangeable.
    finest = [*order, F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id"), F.col("size"), F.col("check"), F.col("salt")]
    placed = running(
        measured.withColumn("salt", F.rand(seed)), finest, {"place": F.lit(1).cast("long"), "start": F.col("size")}, "streams"
    ).drop("salt", "check")
    own = sources.select(F.col("source").alias("_source"), "index", "first")
    streams = placed.join(own, placed["source"].eqNullSafe(own["_source"])).withColumn("start", F.col("start") - F.col("first"))

    number = F.expr("slot div blocks")
    dealt = _dealt(sources, shard, seed).join(sources.select("index", "blocks", "wanted", "last_cut"), "index")
    slots = dealt.select(
        "index", "slot", "shard",
        permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), _pass_key(number, seed)).alias("block"),
        F.when(F.col("slot") == F.col("wanted") - 1, F.col("last_cut")).otherwise(block).cast("long").alias("cut"),
    )
    return Mix(sources, streams.drop("first", "_source"), slots, block)


def spans(mixed: Mix) -> DataFrame:
    """The content of the mix: index, slot, shard, at (place in the slot), place, doc_id, from (words of the document before)
    and taken (words), with the words themselves if the mix kept them. Only spans of one word or more are listed."""
    size, start, n = F.col("size"), F.col("start"), mixed.block
    words = "words" in mixed.docs.columns

    def piece(block: Column) -> Column:
        begin = F.greatest(block * n - start, F.lit(0))
        fields = [block.alias("block"), (start + begin - block * n).alias("at"), begin.alias("from"),
                  (F.least((block + 1) * n - start, size) - begin).alias("length")]
        if words:
            fields.append(F.slice("words", begin.cast("int") + 1, n).alias("words"))
        return F.struct(*fields)

    touched = F.sequence(F.expr(f"start div {n}"), F.expr(f"(start + size - 1) div {n}"))
    pieces = mixed.docs.filter("size > 0").select("place", "doc_id", "index", F.explode(F.transform(touched, piece)).alias("p"))
    joined = pieces.select("place", "doc_id", "index", "p.*").join(mixed.slots, ["index", "block"])
    taken = F.least(F.col("length"), F.col("cut") - F.col("at"))
    cut = joined.withColumn("taken", taken).filter("taken > 0")
    if words:
        cut = cut.withColumn("words", F.slice("words", 1, F.col("taken").cast("int")))
    return cut.drop("length", "cut")


def mixed_texts(docs: DataFrame, **settings) -> DataFrame:
    """shard, index, slot and text of every block of the mix, words joined by spaces. A block bounds what is gathered."""
    parts = F.sort_array(F.collect_list(F.struct("at", "words")))
    rows = spans(mix(docs, keep_words=True, **settings)).groupBy("shard", "index", "slot").agg(parts.alias("parts"))
    return rows.select("shard", "index", "slot", F.array_join(F.flatten("parts.words"), " ").alias("text"))


def write_mix(docs: DataFrame, path: str, **settings) -> None:
    """One folder per shard, its blocks in a seeded order."""
    rows = mixed_texts(docs, **settings).withColumn("turn", F.xxhash64("index", "slot"))
    rows.repartition("shard").sortWithinPartitions("shard", "turn").drop("turn").write.partitionBy("shard").parquet(path)


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row, also of those without words."""
    mixed = mix(docs)
    taken = spans(mixed).groupBy("place").agg(F.sum("taken").alias("taken"))
    sources = mixed.sources.select("index", "source_size", "target")
    return (
        mixed.docs.join(taken, "place", "left").join(sources, "index")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    )
