"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question with other figures or other people keeps its template.
Windows of templates are hashed and hash-joined with the windows of the benchmark; each match brings the words that
stand in its slots. A run of names, or of numbers and units, is one slot, so a slot may be refilled with another number of
words. Matching windows are chained in the order of document and item, over inserted and dropped words. Along one chain, a
slot value of the item must always be replaced by one value of the document, else the windows with that slot don't count,
unless nothing in them is replaced. An item is leaked where enough of its windows count.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import fresh, landed

WINDOW = 8
#: Least number of ordinary words in a window; an item with fewer is not searched for.
MIN_LITERALS = 4
#: Share of an item's windows, or number of its windows in one alignment, that make a leak.
MIN_SHARE = 0.5
MIN_WINDOWS = 24
#: Words by which the alignment may move from one window of a chain to the next.
MAX_DRIFT = WINDOW
#: Bits of the filter that spares the join most windows; a fuller filter lets more through, never fewer.
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 20, 1 << 27
#: Words that a worker keeps, and characters of the texts that it takes together.
KEPT_WORDS = 400_000
JOINT_CHARS = 1 << 18

#: Units of measurement and of money. Fixed values.
UNITS = frozenset(
    "mm cm km kg mg ml kb mb gb tb hz khz mhz ghz kwh mph kmh inch inches foot feet yard yards mile miles meter meters metre"
    " metres kilometer kilometers kilometre kilometres centimeter centimeters centimetre centimetres gram grams kilogram"
    " kilograms pound pounds ounce ounces ton tons liter liters litre litres gallon gallons second seconds minute minutes"
    " hour hours day days week weeks month months year years percent degree degrees dollar dollars euro euros cent cents"
    .split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
_MEASURE = re.compile(r"([+-]?\d[\d.,:/]*)([A-Za-z]+)")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
#: Marks that only end a word.
_MARKS = b".,;:!?\"')]"
LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3
#: Weight of a word's hash by its place in a run is this number's power; the first weighs one.
_STEP = 0x9E3779B97F4A7C15


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))


_HOLDERS = {kind: _hash(f"<{kind}>") for kind in (NUMBER, NAME, UNIT)}
_HOLDER_OF = np.array([0, *_HOLDERS.values()], np.uint64)
_LISTED = {w.encode(): NUMBER for w in NUMBER_WORDS} | {w.encode(): UNIT for w in UNITS - NUMBER_WORDS}
#: By kind, what runs together: numbers and units do.
_RUNS = np.array([LITERAL, NUMBER, NAME, NUMBER], np.int8)


def _classes(word: str) -> tuple[bool, bool, int, int, int]:
    """Kept, ends a sentence, kind at the start of a sentence, kind elsewhere, hash of the lower-cased core."""
    ends = word.rstrip("\"')]»”").endswith((".", "!", "?", ":"))
    core = word if _NUMBER.fullmatch(word) else _EDGES.sub("", word)
    if not core:
        return False, ends, 0, 0, 0
    low = core.lower()
    value = _hash(low)
    if _NUMBER.fullmatch(core) or all(w in NUMBER_WORDS for w in low.split("-")):
        kind = NUMBER
    elif low in UNITS:
        kind = UNIT
    elif (m := _MEASURE.fullmatch(core)) and m[2].lower() in UNITS | {"m", "g", "l", "s", "h", "w", "v"}:
        kind = UNIT
        value = (_hash(m[1]) + _STEP * _hash(m[2].lower())) % (1 << 64)  # as if written as two words
    else:
        kind = LITERAL
    name = NAME if kind == LITERAL and core[0].isupper() and not core.isupper() else kind
    return True, ends, kind, name, value


def _plain_classes(word: bytes) -> tuple[bool, bool, int, int, int] | None:
    """`_classes` of a word of ASCII letters and marks at its end, by look-ups alone; most words are of that kind."""
    plain = word.rstrip(_MARKS)
    if not plain.isalpha():
        return None
    low = plain.lower()
    kind = _LISTED.get(low, LITERAL)
    name = NAME if kind == LITERAL and low != plain and plain[:1].isupper() and not plain.isupper() else kind
    ends = len(plain) < len(word) and word.rstrip(b"\"')]").endswith((b".", b"!", b"?", b":"))
    return True, ends, kind, name, xxhash.xxh64_intdigest(low)


class Templates(dict):
    """Canonical forms of texts. Maps words to rows of arrays with what they give, filled as words are met.

    Texts are taken many at a time, as most are short beside the cost of a call; `doc` tells whose a word is.
    """

    def __init__(self):
        super().__init__()
        # By row: kept, ends, kind at a start and kind elsewhere in one byte; the value hash.
        self.codes, self.values = bytearray(), array("Q")

    def _forget_half(self) -> None:
        """Drop the words that were met first; those that are still used come back."""
        half = len(self) // 2
        words = list(self)[half:]
        self.codes, self.values = self.codes[half:], self.values[half:]
        self.clear()
        self.update(zip(words, range(len(words)), strict=True))

    def __missing__(self, word: bytes) -> int:
        row = self[word] = len(self.codes)
        kept, ends, at_start, elsewhere, value = _plain_classes(word) or _classes(word.decode("utf-8"))
        self.codes.append(kept | ends << 1 | at_start << 2 | elsewhere << 4)
        self.values.append(value)
        return row

    def canonical(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Template hash, kind and value hash of every word that is more than punctuation."""
        return self._words([text])[:3]

    def collapsed(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same with one entry for a run of names, or of numbers and units, inside a sentence."""
        return self.collapsed_all([text])[:3]

    def collapsed_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """`collapsed` of several texts, one after the other, and which text each entry is of."""
        template, kind, value, starts, doc = self._words(texts)
        slot = kind != LITERAL
        tails = np.flatnonzero(slot[1:] & slot[:-1]) + 1
        tails = tails[(_RUNS[kind[tails]] == _RUNS[kind[tails - 1]]) & ~starts[tails] & (doc[tails] == doc[tails - 1])]
        if not len(tails):
            return template, kind, value, doc
        first = np.flatnonzero(np.concatenate(([True], tails[1:] != tails[:-1] + 1)))
        place = np.arange(len(tails)) - np.repeat(first, np.diff(np.append(first, len(tails)))) + 1
        heads = tails - place
        weights = np.full(place.max() + 1, _STEP, np.uint64)
        weights[0] = 1
        with np.errstate(over="ignore"):
            np.add.at(value, heads, value[tails] * np.cumprod(weights)[place])
        np.maximum.at(kind, heads, kind[tails])  # a quantity with a unit is a unit
        template[heads] = _HOLDER_OF[kind[heads]]
        keep = np.ones(len(kind), bool)
        keep[tails] = False
        return template[keep], kind[keep], value[keep], doc[keep]

    def _words(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        if len(self) > KEPT_WORDS:
            self._forget_half()
        split = [(text or "").encode("utf-8", "replace").split() for text in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        rows = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        doc = np.repeat(np.arange(len(split)), counts)
        codes = np.frombuffer(self.codes, np.uint8)[rows] if len(rows) else np.zeros(0, np.uint8)
        kept = (codes & 1).astype(bool)
        starts = np.ones(len(rows), bool)
        starts[1:] = codes[:-1] & 2 != 0
        starts[(np.cumsum(counts) - counts)[counts > 0]] = True
        kind = np.where(starts, codes >> 2 & 3, codes >> 4).astype(np.int8)[kept]
        value = np.frombuffer(self.values, np.uint64)[rows[kept]] if len(self.values) else np.zeros(0, np.uint64)
        template = value.copy()
        for k, holder in _HOLDERS.items():
            template[kind == k] = np.uint64(holder)
        return template, kind, value, starts[kept], doc[kept]


_WORKER: list[Templates] = []


def worker_templates() -> Templates:
    """Those of this worker process, kept from task to task."""
    if not _WORKER:
        _WORKER.append(Templates())
    return _WORKER[0]


def together(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Neighbouring texts in lists of bounded length, a longer text by itself."""
    held, size = [], 0
    for text in texts:
        length = len(text or "")
        if held and size + length > JOINT_CHARS:
            yield held
            held, size = [], 0
        held.append(text)
        size += length
    if held:
        yield held


def window_hashes(template: np.ndarray, kind: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each window of `size` words, and whether it has enough ordinary words to say something."""
    n = len(template) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    with np.errstate(over="ignore"):
        h = np.full(n, size, np.uint64)
        for k in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + template[k : k + n]
            h ^= h >> np.uint64(29)
    literals = np.concatenate(([0], np.cumsum(kind == LITERAL)))
    return h, literals[size:] - literals[:-size] >= MIN_LITERALS


def _window(position: int, at: int, size: int, hashes, kind, value) -> dict:
    slots = [{"at": int(k), "value": int(np.int64(value[at + k]))} for k in np.flatnonzero(kind[at : at + size] != LITERAL)]
    return {"position": position, "hash": int(hashes[at].view(np.int64)), "slots": slots}


_WINDOWS = "array<struct<position:int,hash:bigint,slots:array<struct<at:int,value:bigint>>>>"


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, size, position, hash, slots: an item shorter than a window is one window of its own size."""

    @F.pandas_udf(f"array<struct<size:int,windows:{_WINDOWS}>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        templates = Templates()
        for batch in batches:
            out = []
            for text in batch:
                template, kind, value = templates.collapsed(text)
                size = min(WINDOW, len(template))
                hashes, telling = window_hashes(template, kind, size) if size else (np.zeros(0, np.uint64), np.zeros(0, bool))
                value = value.view(np.int64)
                found = [_window(int(i), int(i), size, hashes, kind, value) for i in np.flatnonzero(telling)]
                out.append([{"size": size, "windows": found}])
            yield pd.Series(out)

    found = items.dropna(subset=["item_id"]).select("item_id", F.explode(cut("text")).alias("c"))
    return found.select("item_id", "c.size", F.explode("c.windows").alias("w")).select("item_id", "size", "w.*")


def filter_bits(windows: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter (64-bit words, number of bits) of the benchmark's hashes, two bits each.

    Built by Spark; its size is bounded, so it may go to every task however large the benchmark is.
    """
    hashes = windows.select("hash").distinct()
    wanted = 16 * hashes.count()
    bits = MIN_FILTER_BITS
    while bits < min(wanted, MAX_FILTER_BITS):
        bits *= 2
    places = hashes.select(F.explode(F.array("hash", F.shiftrightunsigned("hash", 32))).alias("h")).select(
        F.col("h").bitwiseAND(F.lit(bits - 1).cast("long")).alias("b")
    )
    mask = F.expr("bit_or(shiftleft(1L, cast(b & 31 as int)))").alias("mask")
    rows = places.groupBy(F.shiftright("b", 5).alias("word")).agg(mask).toArrow()
    words = np.zeros(bits // 32, np.uint32)
    words[rows["word"].to_numpy()] = rows["mask"].to_numpy().astype(np.uint32)
    return words, bits


def _passes(hashes: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for shift in (0, 32):
        b = (hashes >> np.uint64(shift)) & np.uint64(bits - 1)
        found &= (words[(b >> np.uint64(5)).astype(np.int64)] >> (b & np.uint64(31)).astype(np.uint32)) & 1 == 1
    return found


def chains(windows: list[dict]) -> list[list[dict]]:
    """Matching windows of one document and item in chains, longest first; no window is in two.

    Along a chain the places in the document and in the item grow, and the alignment moves by MAX_DRIFT words at most from
    window to window. Each window follows the longest chain that it may, of equals the one with the nearest alignment.
    """
    windows = sorted(windows, key=lambda w: (w["doc_at"], w["position"]))
    length, before = [1] * len(windows), [-1] * len(windows)
    along: dict[int, tuple[list[int], list[int]]] = {}  # shift -> places in the document, windows
    for k, w in enumerate(windows):
        at, shift = w["doc_at"], w["doc_at"] - w["position"]
        for drift in _DRIFTS:
            if shift + drift in along:
                places, ends = along[shift + drift]
                last = bisect_left(places, at + min(drift, 0)) - 1  # the item's positions grow too
                if last >= 0 and length[ends[last]] >= length[k]:
                    length[k], before[k] = length[ends[last]] + 1, ends[last]
        places, ends = along.setdefault(shift, ([], []))
        places.append(at)
        ends.append(k)
    found, used = [], [False] * len(windows)
    for k in sorted(range(len(windows)), key=lambda k: -length[k]):
        linked = []
        while k >= 0 and not used[k]:
            used[k] = True
            linked.append(windows[k])
            k = before[k]
        if linked:
            found.append(linked)
    return found


_DRIFTS = sorted(range(-MAX_DRIFT, MAX_DRIFT + 1), key=abs)
_BEST = "n_windows long, n_slots int, n_changed int"
_BEST_ARROW = pa.struct([("n_windows", pa.int64()), ("n_slots", pa.int32()), ("n_changed", pa.int32())])


def best_copy(windows: list[dict], item_windows: int) -> dict | None:
    """Windows, slots and changed slots of the best copy of an item in a document; None if there is no leak.

    Chains are judged, and every single alignment for itself, so a contradiction behind an inserted word hides nothing.
    """
    single: dict[int, list[dict]] = {}
    for w in windows:
        single.setdefault(w["doc_at"] - w["position"], []).append(w)
    best = None
    for copy in [*chains(windows), *single.values()]:
        stands: dict[int, set[int]] = {}
        for w in copy:
            for s in w["slots"]:
                stands.setdefault(s["item"], set()).add(s["doc"])
        copy = [w for w in copy if all(s["item"] == s["doc"] for s in w["slots"]) or all(len(stands[s["item"]]) == 1 for s in w["slots"])]
        slots = {(s["item"], s["doc"]) for w in copy for s in w["slots"]}
        n, changed = len({w["position"] for w in copy}), sum(item != doc for item, doc in slots)
        if (n >= MIN_SHARE * item_windows or n >= MIN_WINDOWS) and (best is None or (n, -changed, len(slots)) > best):
            best = n, -changed, len(slots)
    return best and {"n_windows": best[0], "n_slots": best[2], "n_changed": -best[1]}


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, n_slots, n_changed) for every leaked item of every document.

    `n_changed` counts the item's slot values that the document replaces. Null and empty texts and items hold nothing, null
    items are left out. Every row is a document of its own, whatever its doc_id; repeated rows repeat theirs. Columns beside
    ids and texts are not read.
    """
    rows = docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id())
    return _leaks(rows, items).drop("_row")


def _leaks(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The same with `_row`, for rows numbered in that column."""
    cut = landed(item_windows(items.select("item_id", "text")), "benchmark")
    words, bits = filter_bits(cut)
    sizes = sorted(r["size"] for r in cut.select("size").distinct().collect())  # at most WINDOW of them
    held = rows.sparkSession.sparkContext.broadcast(words)  # at most MAX_FILTER_BITS

    @F.pandas_udf(_WINDOWS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        templates = worker_templates()
        for batch in batches:
            out: list[list[dict]] = []
            for texts in together(batch):
                template, kind, value, doc = templates.collapsed_all(texts)
                signed, found = value.view(np.int64), [[] for _ in texts]
                for size in sizes:
                    hashes, telling = window_hashes(template, kind, size)
                    at = np.flatnonzero(telling & (doc[size - 1 :] == doc[: len(hashes)]))  # within one text
                    at = at[_passes(hashes[at], held.value, bits)]
                    for i, first in zip(at.tolist(), np.searchsorted(doc, doc[at]).tolist(), strict=True):
                        found[doc[i]].append(_window(i - first, i, size, hashes, kind, signed))
                out += found
            yield pd.Series(out)

    # Landed, as numbers given while the texts are read must not be given twice.
    searched = landed(
        rows.select("_row", "doc_id", F.explode(search("text")).alias("w")).select("_row", "doc_id", "w.*"), "windows"
    )
    matched = (
        searched.withColumnsRenamed({"position": "doc_at", "slots": "doc_slots"})
        .join(cut, "hash")
        .select(
            "_row", "doc_id", "item_id", "doc_at", "position",
            F.zip_with("slots", "doc_slots", lambda i, d: F.struct(i["value"].alias("item"), d["value"].alias("doc"))).alias("slots"),
        )
    )
    totals = cut.groupBy("item_id").agg(F.count("*").alias("item_windows"))
    # One row's windows: bounded by its text and the item.
    met = matched.groupBy("_row", "doc_id", "item_id").agg(F.collect_list(F.struct("doc_at", "position", "slots")).alias("windows"))
    positions = F.size(F.array_distinct(F.transform("windows", lambda w: w["position"])))
    enough = (positions >= MIN_SHARE * F.col("item_windows")) | (positions >= MIN_WINDOWS)

    @F.arrow_udf(_BEST)
    def judged(windows: pa.Array, total: pa.Array) -> pa.Array:
        return pa.array([best_copy(w, n) for w, n in zip(windows.to_pylist(), total.to_pylist(), strict=True)], _BEST_ARROW)

    return (
        met.join(totals, "item_id").filter(enough)
        .select("_row", "doc_id", "item_id", "item_windows", judged("windows", "item_windows").alias("b")).filter("b is not null")
        .select("_row", "doc_id", "item_id", "b.n_windows", "item_windows", "b.n_slots", "b.n_changed")
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs`, with their columns, without a leak; each is judged by itself, repeated rows and null ids too."""
    row = fresh("_row", docs)
    rows = landed(docs.withColumn(row, F.monotonically_increasing_id()), "decontamination")
    found = _leaks(rows.select(F.col(row).alias("_row"), "doc_id", "text"), items).select(F.col("_row").alias(row)).distinct()
    return rows.join(found, row, "left_anti").select(docs.columns)
