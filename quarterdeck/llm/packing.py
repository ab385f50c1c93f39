"""Best-fit packing of token sequences.

The rounds of the bulk-synchronous method run in one loop over lengths on the driver (`place_runs`), not in Spark: pieces
and the gaps of open sequences are kept sorted by size, the longest unplaced pieces take the next larger gap (their
successor in the order), ranks settle which piece gets which gap, and the gaps shrink; pieces without a successor open new
sequences. Pieces of one length are interchangeable, and so are the gaps of sequences with one
content, so a run of either is held as its count and its range of ranks: the rounds run over at most `capacity` runs,
whatever the number of documents. Spark range-sorts the pieces by length, which gives every piece its rank, and each range
partition sweeps over the table of placed runs, sorted the same way, to give its pieces their places.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import landed, numbered

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a worker keeps, in each of two generations.
KEPT_WORDS = 600_000
_MARKS = ".,;:!?*$%&#"
_ASCII_MARKS = _MARKS.encode()
#: The letters that stand for bytes in a byte-level vocabulary: printable ones of Latin-1 for themselves, the others for the
#: code points from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LETTERS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(0x100 + k) for k, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))
}


class WordIds:
    """Ids of whole texts, as little-endian 32-bit bytes, by a tokenizer whose tokens never span white space.

    Words repeat far more often than texts, so the ids of a word are kept. A word of letters and trailing punctuation is
    two pre-tokens, each encoded by itself, so its letters are kept without the punctuation too.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.model = self.tokenizer.model
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _encode(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _keep(self, word: bytes, ids: bytes) -> bytes:
        if len(self.young) >= KEPT_WORDS:
            self.old, self.young = self.young, {}
        self.young[word] = ids
        return ids

    def _part(self, key: bytes) -> bytes:
        ids = self.young.get(key)
        if ids is None:
            ids = self._keep(key, self.old.get(key) or self._new_part(key))
        return ids

    def _new_part(self, key: bytes) -> bytes:
        text = key.decode()
        if text.isalpha() and text.islower() and max(text) <= "ÿ":  # nothing to normalise or to cut: the merges alone are left
            tokens = self.model.tokenize(text if text.isascii() else "".join(map(_BYTE_LETTERS.__getitem__, key)))
            return struct.pack(f"<{len(tokens)}I", *(t.id for t in tokens))
        return self._encode(text)

    def __getitem__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            plain = word.rstrip(_ASCII_MARKS)
            if plain.isalpha():  # ASCII letters
                ids = self._part(plain.lower()) + (self._part(word[len(plain) :]) if len(plain) < len(word) else b"")
                return self._keep(word, ids)
            text = word.decode("utf-8", "replace")
            letters = text.rstrip(_MARKS)
            if letters.isalpha() and max(letters) <= "ÿ":  # Latin letters, in their composed form
                ids = self._part(letters.lower().encode()) + (self._part(text[len(letters) :].encode()) if len(letters) < len(text) else b"")
            elif unicodedata.normalize("NFC", letters).lower().isalpha():  # still one pre-token; other scripts keep the tokenizer's own rules
                ids = self._part(letters.encode()) + (self._part(text[len(letters) :].encode()) if len(letters) < len(text) else b"")
            else:
                ids = self._encode(text)
        return self._keep(word, ids)

    def encode(self, text: str | None) -> bytes:
        words = (text or "").encode("utf-8", "replace").split()
        found = []
        for w in words:
            ids = self.young.get(w)
            found.append(self[w] if ids is None else ids)
        return b"".join(found)


_WORKER: dict[str, WordIds] = {}


def word_ids(vocabulary: str) -> WordIds:
    """The ids of this worker process, kept from task to task."""
    if vocabulary not in _WORKER:
        _WORKER[vocabulary] = WordIds(vocabulary)
    return _WORKER[vocabulary]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32, and `ids` if asked for.

    A null or empty text is the end id alone. Only a document longer than the capacity is cut.
    """
    fields = "piece:int,start:bigint,length:bigint,ids_crc32:bigint" + ",ids:array<int>" * keep_ids

    @F.pandas_udf(f"array<struct<{fields}>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids = word_ids(vocabulary)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for text in batch:
                tokens = ids.encode(text) + end
                row = []
                for k, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at : at + 4 * capacity]
                    piece = {"piece": k, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                    row.append(piece | ({"ids": np.frombuffer(part, "<u4").astype(np.int32)} if keep_ids else {}))
                rows.append(row)
            yield pd.Series(rows)

    return docs.select("doc_id", F.explode(cut("text")).alias("p")).select("doc_id", "p.*")


def place_runs(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Best-fit of runs of equal lengths, longest first, and the number of sequences opened.

    Returns (first position, count, first sequence, offset) per placed run: the pieces at these positions of the order by
    length go to consecutive sequences at one offset. A run of gaps is (free room, first sequence, count).
    """
    first, total = {}, 0
    for length in sorted(counts):
        first[length], total = total, total + counts[length]
    gaps: list[tuple[int, int, int]] = []
    placed, opened = [], 0
    for length in sorted(counts, reverse=True):
        position, left = first[length], counts[length]
        while left:
            at = bisect_left(gaps, (length,))
            if at < len(gaps):  # the smallest gaps that fit
                room, sequence, size = gaps.pop(at)
            else:
                room, sequence, size = capacity, opened, -(-left // (capacity // length))
                opened += size
            # Best fit fills a gap as often as it can before it takes the next one; only the last may end up less full.
            times = room // length
            used = min(size, -(-left // times))
            last = min(times, left - (used - 1) * times)
            for again in range(times):
                taken = used if again < last else used - 1
                if taken:
                    placed.append((position, taken, sequence, capacity - room + again * length))
                    position, left = position + taken, left - taken
            shorter = int(last < times)
            for rest in (
                (room - times * length, sequence, used - shorter),
                (room - last * length, sequence + used - 1, shorter),
                (room, sequence + used, size - used),
            ):
                if rest[0] and rest[2]:
                    insort(gaps, rest)
    return placed, opened


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset (gapless from 0) to all pieces; a piece has a `length` of 1 to `capacity`.

    Equal lengths are ordered by doc_id and piece; equal rows get neighbouring places. An empty table stays empty.
    """
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs, _ = place_runs(counts, capacity)  # both are bounded by the capacity, not by the data
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 4)
    order = [F.col(c) for c in ("length", "doc_id", "piece", "start")]
    ranked, _ = numbered(found, order, "_position")
    @F.pandas_udf("sequence_id long, offset long")
    def sweep(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for positions in batches:
            run = table[np.searchsorted(table[:, 0], positions.to_numpy(), side="right") - 1]
            yield pd.DataFrame({"sequence_id": run[:, 2] + positions.to_numpy() - run[:, 0], "offset": run[:, 3]})

    return ranked.withColumn("_place", sweep("_position")).select(*found.columns, "_place.*")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """All documents cut into pieces and packed; columns beside doc_id and text are not read."""
    return pack(landed(pieces(docs.select("doc_id", "text"), capacity, vocabulary), "pieces"), capacity)
