"""Secret scan with structural confirmation.

Base patterns find assignments, access keys and long hex strings. Candidates in base64,
base64url or hex are then decoded and reported as further spans only if their structure
holds: signed tokens need three segments, a JSON header that names an algorithm and a JSON
payload; key encodings need a DER sequence whose nested lengths fill the input exactly, or
the length-prefixed fields of the SSH wire format. A key in base64 takes whole lines, the
last of any length, the others of 24 characters or more. Between lines may stand any white
space and what it becomes when a key is written into another text: escaped line ends, quotes
and the sign that joins quoted parts, marks of quoted mail, comments, lists and tables. Its own lengths say where it
ends, so each line of a run is tried as a key's first, and within a line each place where a
key's first characters stand; the keys of adjacent lines are told apart. Hex may follow ``0x``.

Cases: a null or empty text has no spans. A match that fails its length test is dropped
after it has used up its characters. Repeated rows give repeated results. Offsets are code
points, the end is exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldora.llm.rows import document_columns

# The base patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32}")
KINDS = ("assign", "access", "hex", "token", "key")
BASE = KINDS[:3]

_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
# what may stand between two lines of a key
_JOINT = r"""(?:\s|\\[rnt]|["'`,;>#*|]|(?<=["'`\s])\+(?=\s))+"""
_SIGN = "[A-Za-z0-9+/_-]"
# lines of at least 24 characters and a last one of any length
_ENCODED = re.compile(rf"{_SIGN}{{24,}}(?:{_JOINT}{_SIGN}{{24,}})*(?:{_JOINT}{_SIGN}{{1,23}})?={{0,2}}(?:\s+={{1,2}})?")
_JOINTS = re.compile(_JOINT)
_PADDING = re.compile(r"[\s=]*$")
# first characters of a DER sequence of 128 bytes or more, and of SSH keys
_FIRSTS = re.compile(r"MI[IGH]|b3BlbnNzaC1rZXktdjEA|AAAA(?:[BC]3NzaC1|E2VjZHNh|[GI]nNr)")
_HEXES = re.compile(
    r"(?<![0-9A-Za-z])(?:0[xX])?((?:[0-9a-f]{2}){24,}|(?:[0-9A-F]{2}){24,})(?![0-9A-Za-z])"
)
_SSH_NAMES = (b"ssh-", b"ecdsa-", b"sk-")
_SSH_MAGIC = b"openssh-key-v1\x00"
_SSH_TAG = 16  # bytes an authenticated cipher adds after the private part

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_token long, n_key long, "
    "base_sha256 string, spans string"
)
Span = tuple[int, int, str]


def decoded(text: str) -> bytes | None:
    """Bytes of a base64 or base64url string, padded or not; None if it is neither."""
    body = re.sub(r"\s", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except ValueError:
        return None


def is_signed_token(text: str) -> bool:
    """Three segments, a JSON header with an algorithm, a JSON payload, a fitting signature."""
    parts = text.split(".")
    if len(parts) != 3:
        return False
    try:
        header, payload = (json.loads(decoded(p) or b"") for p in parts[:2])
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(payload, dict):
        return False
    algorithm = header.get("alg")
    if not isinstance(algorithm, str):
        return False
    return (parts[2] == "") == (algorithm.lower() == "none") and decoded(parts[2]) is not None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the elements that fill ``data`` exactly, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size = int.from_bytes(data[at : at + n], "big")
            if size < 0x80:  # DER wants the short form here
                return None
            at += n
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    """One sequence that holds whole elements, with a version or an algorithm first."""
    top = der_items(data) if data[:1] == b"\x30" else None
    if not top or len(top) != 1:
        return False
    inner = der_items(top[0][1])
    if not inner or len(inner) < 2:
        return False
    for tag, content in inner:
        if tag & 0x20 and der_items(content) is None:
            return False
    if inner[0][0] == 0x02:  # version, then integers, an algorithm or a private value
        return len(inner[0][1]) == 1 and inner[0][1][0] <= 3 and inner[1][0] in (0x02, 0x04, 0x30)
    algorithm = der_items(inner[0][1]) if inner[0][0] == 0x30 else None
    return bool(algorithm) and algorithm[0][0] == 0x06 and inner[1][0] in (0x03, 0x04)


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields that fill the input, the first a key type; or the private form."""
    if data.startswith(_SSH_MAGIC):
        return _fields(data[len(_SSH_MAGIC) :], least=3) is not None
    fields = _fields(data, least=2, whole=True)
    return fields is not None and fields[0].startswith(_SSH_NAMES)


def _fields(data: bytes, least: int, whole: bool = False) -> list[bytes] | None:
    found, at = [], 0
    while at + 4 <= len(data) and (whole or len(found) < least):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        found.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    if len(found) < least or (whole and at != len(data)):
        return None
    return found


def _is_key(data: bytes | None) -> bool:
    return data is not None and len(data) >= 24 and (is_der_key(data) or is_ssh_key(data))


class _Run:
    """Lines of base64 characters, read as bytes from the start of any line; a line is cut where
    a key's first characters stand."""

    def __init__(self, text: str):
        self.lines, at = [], 0
        end = _PADDING.search(text).start()
        for joint in [*_JOINTS.finditer(text, 0, end), None]:
            to = joint.start() if joint else end
            cuts = [m.start() for m in _FIRSTS.finditer(text, at, to) if m.start() > at]
            self.lines += [x for x in zip([at, *cuts], [*cuts, to]) if x[0] < x[1]]
            at = joint.end() if joint else end
        self.body = "".join(text[a:b] for a, b in self.lines).replace("-", "+").replace("_", "/")
        self.cuts = [0, *itertools.accumulate(b - a for a, b in self.lines)]
        self.line_at = {c: k for k, c in enumerate(self.cuts)}

    def read(self, line: int, at: int, to: int) -> bytes:
        """Bytes ``at`` to ``to`` of what starts with ``line``; fewer where the run ends."""
        start = self.cuts[line]
        piece = self.body[start + at // 3 * 4 : start + -(-to // 3) * 4]
        piece = piece[: len(piece) - (len(piece) % 4 == 1)]
        data = base64.b64decode(piece + "=" * (-len(piece) % 4))
        return data[at % 3 : at % 3 + to - at]

    def after(self, line: int, size: int) -> int | None:
        """The line after ``size`` bytes from ``line``; None if they do not end with a line."""
        return self.line_at.get(self.cuts[line] - (-size * 4 // 3))

    def number(self, line: int, at: int) -> int | None:
        data = self.read(line, at, at + 4)
        return int.from_bytes(data, "big") if len(data) == 4 else None

    def sizes(self, line: int) -> Iterator[int]:
        """Lengths that a key starting with ``line`` can have, likeliest first."""
        head = self.read(line, 0, len(_SSH_MAGIC))
        rest = (self.cuts[-1] - self.cuts[line]) * 3 // 4
        if head[:1] == b"\x30" and len(head) > 6:
            n = head[1] & 0x7F if head[1] & 0x80 else 0
            yield 2 + n + (int.from_bytes(head[2 : 2 + n], "big") if n else head[1])
        elif head == _SSH_MAGIC:
            at = len(head)
            for _ in range(3):  # cipher, derivation and its options
                at += 4 + (self.number(line, at) or 0)
            fields = self.number(line, at)
            at += 4
            while fields is not None and fields >= 0 and at <= rest:  # public keys, private part
                at += 4 + (self.number(line, at) or 0)
                fields -= 1
            yield at
            yield at + _SSH_TAG
            marker = self.body[self.cuts[-2] :].startswith("+++++")  # -----END
            yield (self.cuts[-1 - marker] - self.cuts[line]) * 3 // 4
        elif head[4:].startswith(_SSH_NAMES):
            at, ends = 0, []
            while (size := self.number(line, at)) is not None and at + 4 + size <= rest:
                at += 4 + size
                after = self.after(line, at)
                if after is not None:
                    ends.append(at)
                    if self.read(after, 4, 10).startswith(_SSH_NAMES):  # the next key
                        break
            yield from reversed(ends)


def encoded_keys(text: str) -> list[tuple[int, int]]:
    """(start, end) of the keys in lines of base64, with the padding of the last line."""
    run, found, line = _Run(text), [], 0
    while line < len(run.lines):
        for size in run.sizes(line):
            after = run.after(line, size)
            if after is not None and after > line and _is_key(run.read(line, 0, size)):
                end = run.lines[after - 1][1]
                end += re.match(r"={0,2}(?:\s+={1,2})?" if size % 3 else "={0,2}", text[end:]).end()
                found.append((run.lines[line][0], end))
                line = after - 1
                break
        line += 1
    return found


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if LONG_HEX.search(text):
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= 32]
    return found


def confirmed_spans(text: str) -> list[Span]:
    """Spans whose decoded structure is that of a signed token or a key."""
    found = []
    if "." in text:
        for m in _TOKEN.finditer(text):
            if is_signed_token(m[0]):
                found.append((m.start(), m.end(), "token"))
    for m in _ENCODED.finditer(text):
        found += [(m.start() + a, m.start() + b, "key") for a, b in encoded_keys(m[0])]
    for m in _HEXES.finditer(text):
        if _is_key(bytes.fromhex(m[1])):
            found.append((m.start(1), m.end(1), "key"))
    return sorted(set(found))


def find_spans(text: str) -> list[Span]:
    """All spans by start, then kind in the order of KINDS."""
    found = base_spans(text) + confirmed_spans(text)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """``text`` with every run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, end, _ in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    for batch in batches:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        digests, spans = [], []
        for value in batch.column(1):
            found = find_spans(value.as_py() or "")
            for kind in KINDS:
                counts[kind].append(sum(s[2] == kind for s in found))
            base = written([s for s in found if s[2] in BASE])
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            spans.append(written(found))
        arrays = [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS)]
        arrays += [pa.array(digests, pa.string()), pa.array(spans, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: counts per kind, a digest of the base spans, all spans.

    ``n_assign``, ``n_access`` and ``n_hex`` count base spans, ``n_token`` and ``n_key`` the
    structurally confirmed ones.
    """
    return document_columns(docs).select("doc_id", "text").mapInArrow(_scan, SCHEMA)


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with the spans replaced by ``mark``; ``n_chars`` follows if there is one.

    Every row and column stays; a null text stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                texts.append(redacted(text, find_spans(text), mark) if text else text)
            column = pa.array(texts, batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), column)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out
