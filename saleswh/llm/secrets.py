"""Secret scans: an assignment-aware lexer over source and configuration syntax.

Three fixed patterns give the base spans. The lexer adds literals: it reads
name-literal pairs (``name = "x"``, ``name: x``, ``"name": "x"``, ``name => x``,
``name := x``, quoted pieces joined by ``+``), propagates constants through
names assigned earlier in the text, and scores each literal by the sensitive
words of the name it ends up in and by its own shape.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.common import in_slices, per_batch

Span = tuple[int, int, str]

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so short ones need not be matched first
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "literal")

# How much a word of a name says about its value.
NAME_WORDS = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 2.5, "secret": 3.0, "token": 2.5, "apikey": 3.0,
    "credential": 2.5, "credentials": 2.5, "private": 1.5, "auth": 1.5, "bearer": 2.0, "signing": 1.5,
    "encryption": 1.5, "access": 1.0, "api": 1.0, "key": 1.5,
}
LEAST_NAME, LEAST_SCORE, LEAST_LITERAL = 2.5, 5.0, 8
#: What a text must hold to be lexed: some word that counts in a name.
HINTS = "|".join(NAME_WORDS)
ASSIGNS = "[:=]"

_LEX = re.compile(
    r"""
    (?P<blank>[ \t]+)
  | (?P<line>[\r\n;]+)
  | (?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
  | (?P<op>:=|=>|==|!=|<=|>=|=|:)
  | (?P<plus>\+)
  | (?P<name>[A-Za-z_][A-Za-z0-9_]*(?:[.-][A-Za-z0-9_]+)*)
  | (?P<other>[0-9][A-Za-z0-9+/_.-]*|.)
    """,
    re.VERBOSE | re.DOTALL,
)
_BARE = re.compile(r"[A-Za-z0-9+/_.=~!@$%^&*-]+")
_NAME = re.compile(r"[A-Za-z0-9_.-]+")
_JOIN = re.compile(r"[ \t]*\+[ \t]*")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str, lowered: str | None = None) -> list[Span]:
    """Leftmost matches of each kind that do not overlap, without those that are too short."""
    found: list[Span] = []
    low = text.lower() if lowered is None else lowered
    if any(x in low for x in ("passw", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def name_weight(name: str) -> float:
    """The sensitive words of a name, by camel case and separators; also two words run together."""
    words = [w.lower() for w in _WORD.findall(name)]
    joined = [a + b for a, b in zip(words, words[1:], strict=False)]
    paired = sum(w in ("apikey", "accesskey", "privatekey") for w in joined)
    return sum(NAME_WORDS.get(w, 0.0) for w in words) + paired


def literal_weight(value: str) -> float:
    """Up to 4 for entropy per character, less for what looks like prose, a path or a placeholder."""
    if len(value) < LEAST_LITERAL or len(set(value)) < 5:
        return 0.0
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    score = min(entropy, 4.0) + 0.5 * (kinds - 1)
    if re.search(r"\s", value) or re.fullmatch(r"[a-z]+([._-][a-z]+)*|(\$|%|<|\{).*", value, re.IGNORECASE):
        score -= 3.0
    return score


def lexed_pairs(text: str) -> Iterator[tuple[str, str, int, int]]:
    """``(name, value, start, end)`` of each assignment, constants resolved; spans are those of the literal."""
    known: dict[str, tuple[str, int, int]] = {}
    target: str | None = None
    last: str | None = None
    at = 0
    while at < len(text):
        if target is not None:
            # Behind an operator: a quoted literal (or several joined), a known name or a bare word.
            value, start, end, pos, quoted = "", -1, -1, at, False
            while True:
                m = _LEX.match(text, pos)
                if m and m.lastgroup == "blank":
                    pos = m.end()
                    continue
                if m and m.lastgroup == "text":
                    value += m[0][1:-1]
                    start = m.start() + 1 if start < 0 else start
                    end = m.end() - 1
                    pos, quoted = m.end(), True
                    after = _JOIN.match(text, pos)
                    if after:
                        pos = after.end()
                        continue
                elif m and m.lastgroup == "name" and m[0] in known and not quoted:
                    value, start, end = known[m[0]]
                    pos = m.end()
                elif not quoted and (bare := _BARE.match(text, pos)):
                    value, start, end, pos = bare[0], bare.start(), bare.end(), bare.end()
                break
            if value:
                known[target] = (value, start, end)
                yield target, value, start, end
            target, last = None, None
            at = max(pos, at + (0 if value else 1))
            continue
        m = _LEX.match(text, at)
        at = m.end()
        kind = m.lastgroup
        if kind == "name":
            last = m[0]
        elif kind == "text":
            last = m[0][1:-1] if _NAME.fullmatch(m[0][1:-1]) else None
        elif kind == "op" and last and m[0] in (":", "=", ":=", "=>"):
            target = last
        elif kind in ("line", "other", "plus"):
            last = None


def literal_spans(text: str) -> list[Span]:
    """Literals whose name and shape together score as a secret; a literal is given once."""
    found = set()
    for name, value, start, end in lexed_pairs(text):
        weight = name_weight(name)
        if weight >= LEAST_NAME and weight + literal_weight(value) >= LEAST_SCORE and literal_weight(value) > 1.5:
            found.add((start, end, "literal"))
    return sorted(found)


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, each by start and then by kind as listed in ``KINDS``."""
    if not text:
        return [], []
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    low = text.lower()
    base = sorted(base_spans(text, low), key=order)
    more = literal_spans(text) if re.search(HINTS, low) and re.search(ASSIGNS, low) else []
    return base, sorted(base + more, key=order)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _suspects(texts: pa.Array) -> list[str | None]:
    """Texts that can have a span; for the others null, which saves reading them in Python."""
    maybe = pc.match_substring_regex(
        texts, rf"AKIA[A-Z0-9]|[0-9a-f]{{16}}|(?i:({HINTS})[A-Za-z0-9_.\-]*[\"']?[ \t]*(:|=))"
    )
    return pc.if_else(pc.fill_null(maybe, False), texts, pa.scalar(None, texts.type)).to_pylist()


def scan_secrets(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id``, counts per kind, ``base_sha256`` over the base spans and all ``spans``.

    Offsets are code points, ends exclusive. Null or empty texts have no spans;
    each of repeated rows gets its own; a null doc_id stays null.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [find_spans(text) for text in _suspects(batch.column(1))]
            counts = [Counter(kind for _, _, kind in both[1]) for both in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array([c[kind] for c in counts], pa.int64()) for kind in KINDS),
                    pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in rows], pa.string()),
                    pa.array([_joined(s) for _, s in rows], pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"],
            )

    return per_batch(
        documents.select(F.col("doc_id").cast("long"), "text"),
        scan,
        "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, base_sha256 string, spans string",
    )


def redacted(text: str, spans: list[Span], mask: str) -> str:
    """Each maximal covered run replaced by ``mask``."""
    parts, at = [], 0
    end = 0
    for start, stop, _ in sorted(spans):
        if start > end or not parts:
            parts += [text[at:start], mask]
            at = stop
        at = end = max(end, stop, at)
    return "".join([*parts, text[at:]])


def redact_secrets(documents: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``documents`` with every found span masked and ``n_chars`` renewed; all rows and columns stay."""
    columns = documents.columns
    schema = documents.schema

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        size = columns.index("n_chars") if "n_chars" in columns else None
        for batch in in_slices(batches):
            texts = batch.column(at)
            clean = []
            for text, suspect in zip(texts.to_pylist(), _suspects(texts), strict=True):
                spans = find_spans(suspect)[1]
                clean.append(redacted(text, spans, mask) if spans else text)
            arrays = list(batch.columns)
            arrays[at] = pa.array(clean, texts.type)
            if size is not None:
                old = arrays[size].to_pylist()
                new = [
                    len(c) if c != t and n is not None else n
                    for c, t, n in zip(clean, texts.to_pylist(), old, strict=True)
                ]
                arrays[size] = pa.array(new, arrays[size].type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return per_batch(documents, redact, schema)
