"""SimHash near-duplicates by a binary trie self-join.

Distinct 64-bit fingerprints form a binary trie. Two of its nodes at one depth are visited together with the number of
bits in which their prefixes differ; a pair of nodes over the budget is pruned with everything below it. Spark deals the
fingerprints out by blocks of their bits, one block more than bits may differ: one block at least is equal in both of a
pair, so each fingerprint goes to one group for each block, however many there are. A task rotates the block of a group
to the front and walks the trie below it. It takes so many groups at once as bound its memory, and reports a spanning
forest of the links it finds, never all pairs of a group; its classes are then joined across tasks by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import fresh, landed
from quarterdeck.session import checkpointed

BITS = 64
SEED = 42
#: Fingerprints that a task walks at once; a group of four times as many is cut into parts of twice as many.
ROWS_PER_PREFIX = 1 << 15
#: Pairs of nodes, or of fingerprints, expanded at once; more of them wait on a stack.
PAIRS_AT_ONCE = 1 << 18
#: Pairs of fingerprints below a pair of nodes that are compared one by one.
LEAF_PAIRS = 1 << 10


def simhash(text: str | None, words: int) -> int:
    """Majority of the bits of the shingles' XXH64, as a signed long. A-Z are lower-cased; no words give 0."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    size = min(words, len(tokens))
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(size)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=">u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bits take eight bytes' worth of room each
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(hashes)).view(">i8")
    return int(majority[0])


def fingerprints(docs: DataFrame, words: int, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint (signed long) of every whole text."""

    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([simhash(t, words) for t in batch], dtype="int64")

    return docs.withColumn(out, fingerprint(F.col(text)))


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the classes of linked rows: hook the larger label to the smaller one, then shorten the paths."""
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return labels
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = labels[labels]
            if np.array_equal(shorter, labels):
                break
            labels = shorter


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of every range, and before it the place of its range."""
    sizes = ends - starts
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) + (starts - np.cumsum(sizes) + sizes)[which]


def _slices(sizes: np.ndarray) -> Iterator[slice]:
    """Slices with PAIRS_AT_ONCE in all at most, or a single entry."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, side="right")))
        yield slice(at, to)
        at = to


def _walk(values: np.ndarray, depth: int, pairs: tuple[np.ndarray, ...], distance: int) -> np.ndarray:
    """For each value the first place of its class over all links below the given pairs of nodes.

    A node is a range of `values` with equal leading bits, sorted and distinct. A pair is (start, end, start, end,
    differing bits among the first `depth`): of a node and itself, or of one and a later one.
    """
    labels = np.arange(len(values))
    ones: dict[int, np.ndarray] = {}  # by depth: how many of the values before a place have that bit
    stack = [(depth, pairs)]
    while stack:
        d, pairs = stack.pop()
        if len(pairs[0]) > PAIRS_AT_ONCE:
            half = len(pairs[0]) // 2
            stack += [(d, tuple(c[:half] for c in pairs)), (d, tuple(c[half:] for c in pairs))]
            continue
        x, x_end, y, y_end, errors = pairs
        # Whatever lies below can't break the budget any more: all of it is one class.
        whole = errors + (BITS - d) <= distance
        few = ~whole & ((x_end - x) * (y_end - y) <= LEAF_PAIRS)
        for part in _slices((x_end - x + y_end - y)[whole]):
            first, last, other, end = (c[whole][part] for c in pairs[:4])
            which, i = _spans(np.concatenate((first, other)), np.concatenate((last, end)))
            labels = _merge(labels, np.tile(first, 2)[which], i)
        for part in _slices(((x_end - x) * (y_end - y))[few]):  # few leaves: the rest of their bits at once
            first, last, other, end = (c[few][part] for c in pairs[:4])
            which, i = _spans(first, last)
            row, j = _spans(np.maximum(other[which], i + 1), end[which])
            i = i[row]
            near = np.bitwise_count(values[i] ^ values[j]) <= distance
            labels = _merge(labels, i[near], j[near])
        go = ~(whole | few)
        if not go.any():
            continue
        x, x_end, y, y_end, errors = (c[go] for c in pairs)
        if d not in ones:
            bit = (values >> np.uint64(BITS - d - 1)) & np.uint64(1)
            ones[d] = np.append(np.zeros(1, np.int32), np.cumsum(bit, dtype=np.int32))
        x_mid, y_mid = x_end - (ones[d][x_end] - ones[d][x]), y_end - (ones[d][y_end] - ones[d][y])
        two = x != y  # the children of a node and itself meet once
        found = []
        for a, a_end, b, b_end, differ, meet in (
            (x, x_mid, y, y_mid, 0, True), (x_mid, x_end, y_mid, y_end, 0, True),
            (x, x_mid, y_mid, y_end, 1, True), (x_mid, x_end, y, y_mid, 1, two),
        ):
            alive = (a < a_end) & (b < b_end) & (errors + differ <= distance) & meet
            found.append((a[alive], a_end[alive], b[alive], b_end[alive], errors[alive] + differ))
        stack.append((d + 1, tuple(np.concatenate(c) for c in zip(*found, strict=True))))
    return labels


def linked_classes(left: np.ndarray, right: np.ndarray, distance: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all values of both sides that links between a left and a right value join.

    Both are sorted and distinct; `depth` is how many leading bits the nodes at the start have. Returns the sorted
    distinct values and, for each, the smallest value of its class.
    """
    nodes = []
    for side in (left, right):
        prefix = side >> np.uint64(BITS - depth) if depth else np.zeros_like(side)
        starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(side)), bool), prefix[1:] != prefix[:-1])))
        nodes.append((starts, np.append(starts, len(side))[1:], prefix[starts]))
    x, y = (g.ravel() for g in np.meshgrid(*(np.arange(len(n[0])) for n in nodes), indexing="ij"))
    errors = np.bitwise_count(nodes[0][2][x] ^ nodes[1][2][y]).astype(np.int64)
    x, y, errors = (c[errors <= distance] for c in (x, y, errors))
    pairs = nodes[0][0][x], nodes[0][1][x], nodes[1][0][y] + len(left), nodes[1][1][y] + len(left), errors
    labels = _walk(np.concatenate((left, right)), depth, pairs, distance)
    values = np.union1d(left, right)
    place = np.searchsorted(values, np.concatenate((left, right)))
    # A value of both sides may have two labels: it joins them.
    smallest = _merge(np.arange(len(values)), place, place[labels])
    return values, values[smallest]


def blocks(distance: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of `distance` + 1 blocks, of which two near fingerprints have one in common."""
    edges = [BITS * k // (distance + 1) for k in range(distance + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def grouped(distinct: DataFrame, distance: int) -> DataFrame:
    """(block, prefix, parts, fingerprint): every fingerprint once for each block, `prefix` being the bits of that block.

    Two near fingerprints meet in a group of equal (block, prefix, parts). A group with far more rows than planned is cut
    by the fingerprints' hashes, and its rows go to every pair of parts that has theirs.
    """
    none = F.lit(0).cast("long")

    def prefix(start: int, width: int) -> Column:
        if width in (0, BITS):
            return F.col("fingerprint") if width else none
        return F.shiftrightunsigned(F.shiftleft("fingerprint", start), BITS - width)

    keys = [F.struct(F.lit(k).alias("block"), prefix(*b).alias("prefix")) for k, b in enumerate(blocks(distance))]
    keyed = distinct.select("fingerprint", F.explode(F.array(*keys)).alias("key")).select("fingerprint", "key.*")
    crowded = landed(
        keyed.groupBy("block", "prefix").count().filter(F.col("count") > 4 * ROWS_PER_PREFIX)
        .select("block", "prefix", F.ceil(F.col("count") / (2 * ROWS_PER_PREFIX)).cast("int").alias("cut")), "crowded",
    )
    if crowded.isEmpty():
        return keyed.select("block", "prefix", none.alias("parts"), "fingerprint")
    cut, own, other = F.coalesce("cut", F.lit(1)).cast("long"), F.col("own"), F.col("other")
    others = F.when(cut == 1, F.array(none)).otherwise(F.array_remove(F.sequence(none, cut - 1), own))
    return (
        keyed.join(crowded, ["block", "prefix"], "left")
        .withColumn("own", F.pmod(F.xxhash64("fingerprint"), cut))
        .withColumn("other", F.explode(others))
        .select("block", "prefix", (F.least(own, other) * cut + F.greatest(own, other)).alias("parts"), "fingerprint")
    )


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str], rows: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows that come with equal keys together, cut anew between groups: of `rows` rows, or of one group if it has more.

    With each frame come the places where its groups begin.
    """
    held: list[pd.DataFrame] = []

    def joined() -> tuple[pd.DataFrame, np.ndarray]:
        frame = pd.concat(held, ignore_index=True)
        columns = [frame[k].to_numpy() for k in keys]
        return frame, np.flatnonzero(np.logical_or.reduce([np.append(True, c[1:] != c[:-1]) for c in columns]))

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        if sum(map(len, held)) >= rows:
            frame, starts = joined()
            if len(starts) > 1:
                yield frame[: starts[-1]], starts[:-1]
            held = [frame[starts[-1] :]]
    if held:
        yield joined()


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints of at most `distance` differing bits."""
    first_bits = np.array([start for start, _ in blocks(distance)], dtype=np.uint64)
    depth, rows = BITS // (distance + 1), ROWS_PER_PREFIX
    keys = ["block", "prefix", "parts"]

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_groups(batches, keys, rows):
            sizes = np.diff(np.append(starts, len(frame)))
            fingerprint = frame["fingerprint"].to_numpy(np.int64)
            bits, by = fingerprint.view(np.uint64), first_bits[frame["block"].to_numpy()]
            rotated = (bits << by) | (bits >> ((np.uint64(BITS) - by) % np.uint64(BITS)))
            order = np.lexsort((rotated, np.repeat(np.arange(len(starts)), sizes)))
            x, end = starts[sizes > 1], (starts + sizes)[sizes > 1]
            labels = _walk(rotated[order], depth, (x, end, x, end, np.zeros(len(x), np.int64)), distance)
            linked = labels != np.arange(len(labels))
            fingerprint = fingerprint[order]
            yield pd.DataFrame({"a": fingerprint[linked], "b": fingerprint[labels[linked]]})

    dealt = grouped(distinct, distance).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(join, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; the root is the smallest node of its component.

    Large-star and small-star by turns until nothing changes. Every step is a minimum per node, combined before the
    shuffle, and a join back; each round is checkpointed, so its lineage stays short.
    """
    current = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )  # every larger neighbour to the smallest one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        )
        current = checkpointed(small)
        # decimals: the sum of many 64-bit numbers may not fit a long
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now


def with_components(rows: DataFrame, distance: int) -> DataFrame:
    """Add `class` (a fingerprint, equal within a component) to landed rows with a `fingerprint` column."""
    roots = components(links(rows.select("fingerprint").distinct(), distance))
    return (
        rows.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .withColumn("class", F.coalesce("root", "fingerprint"))
        .drop("root")
    )


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable over links) of every row.

    Null and empty texts have fingerprint zero and link like any other. A null doc_id is never the smallest; a component
    of null ids only has a null component_id. Repeated rows give repeated results. Other columns are not read.
    """
    rows = landed(fingerprints(docs.select("doc_id", "text"), words).select("doc_id", "fingerprint"), "fingerprints")
    classed = with_components(rows, distance)
    # Both group sums are combined before the shuffle, however many copies a class has.
    smallest = classed.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return classed.join(smallest, "class").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """One row of each component, the one with the smallest doc_id, with the columns of `docs`.

    Rows are numbered when they are landed, so repeated rows and null ids also leave exactly one.
    """
    row, mark = fresh("_row", docs), fresh("_fingerprint", docs)
    rows = landed(fingerprints(docs.withColumn(row, F.monotonically_increasing_id()), words, out=mark), "deduplication")
    keys = rows.select(F.col(row).alias("row"), "doc_id", F.col(mark).alias("fingerprint"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = with_components(keys, distance).groupBy("class").agg(first).select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(docs.columns)
