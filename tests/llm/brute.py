"""Plain Python versions of what the corpus operators must return."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shards(rows, count: int, seed: int):
    """(doc_id, shard, slot) from rows (doc_id, source)."""
    by_source = collections.defaultdict(list)
    for doc_id, source in rows:
        key = hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        by_source["" if source is None else "=" + source].append((key, doc_id))
    order = []
    for source, members in by_source.items():
        members.sort(key=lambda m: (m[0], m[1] is not None, m[1] or 0))
        order += [((2 * k + 1) / (2 * len(members)), source, m[0], m[1]) for k, m in enumerate(members)]
    order.sort(key=lambda x: x[:3])
    out, slots = [], collections.Counter()
    for place, (*_, doc_id) in enumerate(order):
        shard = place * count // len(order)
        out.append((doc_id, shard, slots[shard]))
        slots[shard] += 1
    return out


def text_counts(text: str | None):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    often = collections.Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
    )


def base_spans(text: str | None):
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    letters = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", "password|passwd|secret|token|api_?key")
    pattern = re.compile(assign.replace("password|passwd|secret|token|api_?key", letters))
    found = [("assign", m.start(), m.end()) for m in pattern.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def fingerprint(text: str | None, words: int = 3) -> int:
    tokens = WORD.findall(ascii_lower(text or ""))
    if not tokens:
        return 0
    size = min(words, len(tokens))
    hashes = [xxhash.xxh64_intdigest(" ".join(tokens[i : i + size]).encode(), 42) for i in range(len(tokens) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values: list[int], distance: int) -> list[int]:
    """For each value the smallest index reachable over pairs of at most `distance` differing bits."""
    array = np.array(values, dtype=np.uint64)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(array)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= distance):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def judge_url(url: str | None, rules, default: str = "allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = ascii_lower(host)
    fits = [(h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


def base_scores(rows):
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score) from rows (doc_id, text)."""
    counts, tokens = collections.Counter(), {}
    for doc_id, text in rows:
        own = [*WORD.findall(ascii_lower(text or "")), ""]
        held_out = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2
        tokens[doc_id] = held_out, own
        if not held_out:
            counts.update(own)
    n, v = sum(counts.values()), len(counts)
    return {
        d: (h, len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own))
        for d, (h, own) in tokens.items()
    }
