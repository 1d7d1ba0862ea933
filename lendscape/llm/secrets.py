"""Secret scans: fixed patterns plus sliding-window entropy over candidate strings.

Fixed kinds, each leftmost and non-overlapping: ``assign`` (a credential name, a sign, a value
of six or more characters), ``access`` (access key ids) and ``hex`` (long hexadecimal runs).

Method: runs of at least ``WINDOW`` token characters are candidates. A window of ``WINDOW``
characters slides over each; the counts of its characters change by one in and one out, and the
Shannon entropy follows from them incrementally. A candidate is a secret (kind ``entropy``) when
a window reaches the threshold of the candidate's character class, unless it is on the allow
list: plain words and numbers, UUIDs, runs that say they are examples, and names, paths and web
addresses of which every segment between signs is a word, a word with a number behind it (``v2``)
or a number.
Candidates inside a fixed match are not reported again. One that reaches beyond fixed matches is
reported whole when it or a part left outside them is a secret.

* NULL or empty text: zero counts, empty digest and spans.
* Offsets are code points, ends exclusive; whole texts of any length are scanned.
* Repeated rows and ids: one result row per input row. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscape.llm import arrow as A

KINDS = ("assign", "access", "hex", "entropy")
NAMES = "password|passwd|secret|token|api_?key"
VALUE_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
WINDOW = 20
SIGNS = "+/_-="
# Bits per character that a window of a class must reach.
THRESHOLDS = {"hex": 3.0, "alphanumeric": 3.6, "base64": 3.8}
# What may stand between the signs of a name, a path or an address.
SEGMENT = "(?:[A-Za-z]{1,24}[0-9]{0,4}|[0-9]{1,20})"
ALLOWED = (
    r"[A-Za-z]+",
    r"[0-9+/_.=-]+",
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    rf"[/_.=+-]*(?:{SEGMENT}[/_.=+-]+)*{SEGMENT}?",
    r"(?i:.*(?:example|sample|placeholder|your[_-]?key|changeme|x{8}|0{8}|1234567).*)",
)


def _either_case(names: str) -> bytes:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", names).encode()


_ASSIGN = re.compile(
    b"(" + _either_case(NAMES) + rb""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_NAMES = [re.compile(n.encode()) for n in NAMES.replace("api_?key", "apikey|api_key").split("|")]
_KEY_ID = re.compile(b"AKIA")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = A.byte_class(lambda b: chr(b) in "0123456789abcdef")
_CANDIDATE = A.byte_class(lambda b: b < 128 and (chr(b).isalnum() or chr(b) in SIGNS))
_ALLOWED = re.compile("|".join(f"(?:{p})" for p in ALLOWED))
_TERM = [0.0] + [n / WINDOW * math.log2(n / WINDOW) for n in range(1, WINDOW + 1)]


def window_entropy(text: str) -> float:
    """Highest entropy of any window of ``WINDOW`` characters, by incremental counts."""
    counts: dict[str, int] = {}
    entropy = best = 0.0
    for i, new in enumerate(text):
        if i >= WINDOW:
            n = counts[text[i - WINDOW]]
            entropy += _TERM[n] - _TERM[n - 1]
            counts[text[i - WINDOW]] = n - 1
        n = counts.get(new, 0)
        entropy += _TERM[n] - _TERM[n + 1]
        counts[new] = n + 1
        if i >= WINDOW - 1 and entropy > best:
            best = entropy
    return best


def character_class(text: str) -> str:
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text):
        return "hex"
    return "alphanumeric" if text.isalnum() else "base64"


def is_secret(text: str) -> bool:
    """Entropy verdict on one candidate."""
    if len(text) < WINDOW or _ALLOWED.fullmatch(text):
        return False
    return window_entropy(text) >= THRESHOLDS[character_class(text)]


def outside(start: int, end: int, fixed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the fixed matches leave of a range."""
    out = []
    for s, e in sorted(fixed):
        if start < s:
            out.append((start, s))
        start = max(start, e)
    return [*out, (start, end)] if start < end else out


def find(array: pa.Array) -> list[list[tuple[int, str, int]]]:
    """Per text: (start, kind, end) in code points, sorted by start and kind."""
    out: list[list[tuple[int, str, int]]] = []
    for a, b in A.slices(array):
        out.extend(_find(array.slice(a, b - a)))
    return out


def _long_runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int):
    starts, ends, _ = A.spans(data, offsets, member)
    keep = ends - starts >= least
    starts, ends = starts[keep], ends[keep]
    return zip((np.searchsorted(offsets, starts, "right") - 1).tolist(), starts.tolist(), ends.tolist())


def _find(array: pa.Array) -> list[list[tuple[int, str, int]]]:
    data, offsets = A.buffer_of(array)
    raw = data.tobytes()
    n = len(array)
    found: list[list[tuple[int, str, int]]] = [[] for _ in range(n)]
    for i, start, end in _long_runs(data, offsets, _HEX, HEX_MIN):
        found[i].append((start, "hex", end))
    lowered = A.LOWER[data].tobytes()
    for i in _holders(_NAMES, lowered, offsets):
        for m in _ASSIGN.finditer(raw, offsets[i], offsets[i + 1]):
            if m.end(2) - m.start(2) >= VALUE_MIN:
                found[i].append((m.start(), "assign", m.end()))
    for i in _holders([_KEY_ID], raw, offsets):
        for m in _ACCESS.finditer(raw, offsets[i], offsets[i + 1]):
            if m.end() - m.start() >= ACCESS_MIN:
                found[i].append((m.start(), "access", m.end()))
    ahead: dict[int, list[tuple[int, int]]] = {}
    near: dict[int, list[tuple[int, int]]] = {}
    # Candidates of a text come in order, so its fixed matches are walked beside them.
    for i, start, end in _long_runs(data, offsets, _CANDIDATE, WINDOW):
        if i not in ahead:
            ahead[i] = sorted(((s, e) for s, _, e in found[i]), reverse=True)
        fixed = [x for x in near.get(i, ()) if x[1] > start]
        while ahead[i] and ahead[i][-1][0] < end:
            x = ahead[i].pop()
            if x[1] > start:
                fixed.append(x)
        near[i] = fixed
        if any(s <= start and end <= e for s, e in fixed):
            continue
        parts = outside(start, end, fixed) if fixed else []
        if is_secret(raw[start:end].decode()) or any(
            is_secret(raw[a:b].decode().strip(SIGNS)) for a, b in parts
        ):
            found[i].append((start, "entropy", end))
    return [_in_code_points(raw, int(offsets[i]), x) if x else x for i, x in enumerate(found)]


def _holders(patterns: list[re.Pattern], raw: bytes, offsets: np.ndarray) -> list[int]:
    """Texts in which one of the patterns begins."""
    hits = [m.start() for p in patterns for m in p.finditer(raw)]
    return np.unique(np.searchsorted(offsets, hits, "right") - 1).tolist() if hits else []


def _in_code_points(raw: bytes, base: int, found: list) -> list[tuple[int, str, int]]:
    at, last, count = {}, base, 0
    for pos in sorted({p for s, _, e in found for p in (s, e)}):
        count += len(raw[last:pos].decode())
        at[pos], last = count, pos
    return sorted(((at[s], k, at[e]) for s, k, e in found), key=lambda x: (x[0], KINDS.index(x[1])))


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per fixed kind, digest of the fixed spans, all spans. No shuffle."""

    def run(table: pa.Table) -> pa.Table:
        found = find(A.texts(table["_text"]))
        base = [[x for x in spans if x[1] != "entropy"] for spans in found]
        counts = {
            f"n_{k}": pa.array([sum(x[1] == k for x in spans) for spans in base], pa.int64())
            for k in KINDS[:3]
        }
        digests = [hashlib.sha256(joined(x).encode()).hexdigest() for x in base]
        return pa.table(
            {id_col: table[id_col], **counts, "base_sha256": digests, "spans": [joined(x) for x in found]}
        )

    kind = docs.schema[id_col].dataType.simpleString()
    needed = docs.select(id_col, F.col(text).cast("string").alias("_text"))
    schema = f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return A.map_tables(needed, run, schema)


def redact(array: pa.Array, mark: str = "<secret>") -> list[str]:
    """Texts with every span replaced; overlapping spans are replaced once."""
    out = []
    for value, spans in zip(array.to_pylist(), find(array)):
        parts, at = [], 0
        for start, _, end in spans:
            if end > at:
                parts += [value[at:start], mark] if start >= at else []
                at = end
        out.append("".join(parts) + value[at:] if spans else value)
    return out
