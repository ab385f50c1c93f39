"""Secret scan: fixed token patterns, and assignment-aware lexing.

Lines with an assignment are lexed into names, operators, literals and references, as source code, shell, JSON, YAML and
INI write them; a value may go on in the next lines, in triple quotes or in a YAML block. Constants are propagated: a name that is assigned another name, or literals joined by `+`, stands for
those literals. A literal that reaches a sensitively named target is scored by that name and by its own look, and so are
the literals that are joined there, together.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns. A match that is too short is dropped after matching.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run too short holds no longer one
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")

#: Parts of sensitive names and what they weigh. Fixed values.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "credential": 0.9,
    "credentials": 0.9, "apikey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "privatekey": 1.0, "auth": 0.7, "bearer": 0.8,
    "pin": 0.6, "salt": 0.6, "signature": 0.5, "cookie": 0.5, "key": 0.4, "pass": 0.9, "passcode": 1.0, "passkey": 0.9, "pat": 0.8,
    "otp": 0.7, "jwt": 0.9, "hmac": 0.7, "oauth": 0.7, "authkey": 0.9, "authtoken": 1.0, "signingkey": 1.0, "encryptionkey": 1.0,
    "masterkey": 1.0, "sharedkey": 0.9, "sessionid": 0.8, "cred": 0.9, "creds": 0.9,
}
#: Values that stand for no secret. Fixed values.
PLACEHOLDERS = frozenset("changeme password secret token none null true false example placeholder todo xxx redacted default".split())
MIN_LENGTH = 6
MIN_SCORE = 0.5

_LEX = re.compile(
    r"""(?P<quote>["'`])
      |(?P<compare>==|!=|<=|>=|::|//)
      |(?P<assign>:=|=>|=|:)
      |(?P<plus>\+)
      |(?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.\-][A-Za-z0-9_$]+)*)
      |(?P<bare>[A-Za-z0-9/_][A-Za-z0-9+/_.=~!@%^*-]*)
      |(?P<bracket>[\[\](){},;])
      |(?P<space>[\x20\t]+)
      |(?P<other>.)""",
    re.VERBOSE,
)
#: A string from behind its opening quote.
_CLOSING = {
    '"': re.compile(r'(?:[^"\\\n]|\\.)*"'),
    "'": re.compile(r"(?:[^'\\\n]|\\.)*'"),
    "`": re.compile(r"[^`\n]*`"),
}
#: Words before a declared name.
_DECLARE = frozenset("var const let val static final mut pub private public protected readonly export declare dim lateinit".split())
_BLOCK = re.compile(r"[\x20\t]*[|>][-+0-9]*[\x20\t]*(?:#.*)?\r?$")
_BARE = re.compile(r"[A-Za-z0-9+/_.=~!@%^*$-]+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def name_weight(name: str) -> float:
    """How sensitive a target's name is: its weightiest part or pair of neighbouring parts."""
    parts = [p.lower() for p in _PART.findall(name)]
    joined = parts + [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)


def literal_weight(value: str) -> float:
    """How much a literal looks like a secret: entropy per character, kinds of characters, length."""
    if len(value) < MIN_LENGTH or value.lower() in PLACEHOLDERS or value.startswith(("${", "<", "{{", "%(")):
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if kinds < 2 and len(value) < 20 or any(c.isspace() for c in value):
        return 0.3
    return min(1.0, entropy / 3.0)


class _Line:
    """Tokens of one line without white space: (kind, start, end, text), positions in the whole text.

    A quote that nothing closes is a sign like others. What follows it in the line was looked through then: a further quote
    of its kind there is an escaped one, and what follows that is cut the same way, so nothing closes it either.
    """

    def __init__(self, text: str, start: int, end: int):
        self.tokens, unclosed, at = [], set(), start
        while at < end:
            found = _LEX.match(text, at, end)
            kind, stop = found.lastgroup, found.end()
            if kind == "quote":
                quote = found[0]
                closed = None if quote in unclosed else _CLOSING[quote].match(text, stop, end)
                if closed:
                    kind, stop = "string", closed.end()
                else:
                    unclosed.add(quote)
                    kind = "other"
            if kind != "space":
                self.tokens.append((kind, at, stop, text[at:stop]))
            at = stop


def pairs(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Assignments of a text, in order: target name and the spans of the literals that it then stands for."""
    constants: dict[str, list[tuple[int, int]]] = {}
    start = 0
    for line in text.split("\n"):
        end = start + len(line)
        if "=" in line or ":" in line:
            tokens = _Line(text, start, end).tokens
            own = len(tokens)
            if any(t[0] == "assign" for t in tokens):
                tokens += _continued(text, tokens, end)
            for i in range(1, own):
                if tokens[i][0] != "assign":
                    continue
                targets = _targets(tokens, i)
                if not targets:
                    continue
                if tokens[i][3] == ":" and _BLOCK.match(line, tokens[i][2] - start):
                    spans = _block(text, start, end)
                else:
                    spans = _value(text, tokens, i + 1, own, constants)
                for target in targets if spans else ():
                    constants[target.lower()] = spans
                    yield target, spans
        start = end + 1


def _continued(text: str, tokens: list, end: int) -> list:
    """Tokens of the next lines with words, as far as a line ends in an operator, a bracket or a backslash, or `+` follows."""
    more: list = []
    last = tokens[-1:]
    while last and end < len(text):
        start, end = end + 1, (text.find("\n", end + 1) + 1 or len(text) + 1) - 1
        opened = last[0][0] in ("assign", "plus") or last[0][3] in ("(", "\\")
        if text[start:end].isspace() or start == end:
            if opened:
                continue
            break
        if not opened and not text[start:end].lstrip().startswith("+"):
            break
        found = _Line(text, start, end).tokens
        if any(t[0] == "assign" for t in found):  # a statement of its own
            break
        more += found
        last = found[-1:]
    return more


def _block(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Spans of the lines of the YAML block below the line from `start` to `end`: those indented more than it."""
    line = text[start:end]
    indent, spans = len(line) - len(line.lstrip()), []
    while end < len(text):
        start, end = end + 1, (text.find("\n", end + 1) + 1 or len(text) + 1) - 1
        line = text[start:end]
        if line.strip() and len(line) - len(line.lstrip()) <= indent:
            break
        spans += _stripped(text, start, end)
    return spans


def _stripped(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Spans of the lines between two places, without white space around them."""
    return [(start + m.start(), start + m.end()) for m in re.finditer(r"\S(?:[^\n]*\S)?", text[start:end])]


def _targets(tokens: list, at: int) -> list[str]:
    """Names that an operator assigns to: the one left of it, and the declared one, left of a type or brackets."""
    found = [_target(tokens, at - 1)]
    if tokens[at][3] in ("=", ":="):
        left = at - 1
        while left >= 0 and tokens[left][0] != "assign" and tokens[left][3] not in (";", "{", "}"):
            left -= 1
        if left > 0 and tokens[left][3] == ":":  # name: type =
            found.append(_target(tokens, left - 1))
        names = [k for k in range(left + 1, at) if tokens[k][0] == "name"]
        if names and tokens[names[0]][3].lower() in _DECLARE:  # var name type =
            found += [tokens[k][3] for k in names if tokens[k][3].lower() not in _DECLARE][:1]
        if tokens[at - 1][3] == "]":  # name[] =, name[32] =
            k = at - 1
            while k > 0 and (tokens[k][3] in ("[", "]") or tokens[k - 1][3] == "["):
                k -= 1
            found.append(_target(tokens, k))
    return list(dict.fromkeys(f for f in found if f))


def _target(tokens: list, at: int) -> str | None:
    """The name left of an operator: plain or dotted, a quoted key, or an index with a quoted key."""
    if tokens[at][3] == "]" and at >= 2 and tokens[at - 1][0] == "string":
        at -= 1
    kind, _, _, text = tokens[at]
    if kind == "name":
        return text
    if kind == "string" and len(text) > 2:
        return text[1:-1]
    return None


def _value(text: str, tokens: list, at: int, own: int, constants: dict) -> list[tuple[int, int]]:
    """Spans of the literals right of an operator: strings, known names, or one unquoted word; `+` joins more.

    Tokens from `own` on are of later lines. There an unquoted word counts if nothing follows it.
    """
    spans: dict[tuple[int, int], None] = {}  # in order, each once: `x = x + x` adds nothing
    inside = False
    while at < len(tokens):
        kind, a, b, word = tokens[at]
        follows = tokens[at + 1] if at + 1 < len(tokens) else None
        if word in ("(", "\\") and (inside or not spans) and follows and at + 1 >= own:
            inside, at = True, at + 1
            continue
        if kind == "string":
            if b - a > 2:
                spans[a + 1, b - 1] = None
            elif text[b : b + 1] == word[0] and (close := text.find(word[0] * 3, b + 1)) >= 0:
                return [*spans, *_stripped(text, b + 1, close)]
        elif kind == "name" and word.lower() in constants:
            spans |= dict.fromkeys(constants[word.lower()])
        elif kind in ("name", "bare") and not (follows and follows[3] == "("):
            bare = _BARE.match(text, a)
            if at < own or bare.end() >= tokens[-1][2]:
                spans[bare.start(), bare.end()] = None
            break
        else:
            break
        if follows and inside and (follows[0] == "string" or follows[3] == "\\"):  # neighbours in brackets are joined
            at += 1
            continue
        if not follows or follows[0] != "plus":
            break
        at += 2
    return list(spans)


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a whole text in code points, by start and then kind. Null and empty texts have none."""
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if "=" in text or ":" in text:
        literal: set[tuple[int, int]] = set()
        for name, spans in pairs(text):
            weight = name_weight(name)
            if not weight:
                continue
            literal.update(s for s in spans if weight * literal_weight(text[slice(*s)]) >= MIN_SCORE)
            # Parts that say little alone may be a secret when they are joined, as they are where they are used.
            if len(spans) > 1 and weight * literal_weight("".join(text[slice(*s)] for s in spans)) >= MIN_SCORE:
                literal.update(spans)
        found += [("literal", a, b) for a, b in literal]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every stretch that spans cover replaced by the mark."""
    if not text:
        return text
    out, at = [], 0
    for _, a, b in scan(text):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def spans_of(text: Column) -> Column:
    """array<struct<kind, start, end>> of a text column."""

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] for t in batch])

    return spans(text)


def report(docs: DataFrame) -> DataFrame:
    """Counts per fixed kind, the hash of their spans and all spans, for every row. Other columns are not read."""

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                spans = scan(text)
                base = [s for s in spans if s[0] != "literal"]
                counts = Counter(k for k, _, _ in base)
                sha = hashlib.sha256(_written(base).encode()).hexdigest()
                rows.append((counts["assign"], counts["access"], counts["hex"], sha, _written(spans)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", digest("text").alias("d")).select("doc_id", "d.*")


def redacted(docs: DataFrame) -> DataFrame:
    """All rows of `docs` with secrets in `text` replaced and `n_chars`, where there is one, as long as the new text.

    Null and empty texts stay as they are, repeated rows stay repeated, an empty table stays empty.
    """

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([redact(t) for t in batch], dtype=object)

    changed = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return changed.select(docs.columns)
