"""Secret scans: base patterns, and key encodings confirmed by their structure.

The base patterns are plain matches. Base64 or hex characters are reported as well
if, and only if, their decoded bytes parse as a key: nested lengths must add up
exactly (DER, OpenSSH), and a signed token must carry a JSON header that names its
algorithm. Looking random is never enough. A key in base64 may begin anywhere in a
run, its own lengths say where it ends, and it may be broken into lines, by line
breaks or by their escapes in JSON and source.

Each row is scanned whole and on its own, so nothing is shuffled. A null text
counts as empty; a row with a null id stays; repeated rows give repeated results;
other columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns, their kinds in report order, and least lengths.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # greedy, so a match is a whole run
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "pem", "jwt", "key64", "keyhex")

# Candidates that are decoded and parsed.
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----((?:[A-Za-z0-9+/=\s]|\\+[nrt])*?)-----END \1PRIVATE KEY-----")
# The first character of JSON that is an object, after white space or not, is one of these in base64.
JWT = re.compile(r"(?<![A-Za-z0-9_.-])([eICD][A-Za-z0-9_-]{7,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
BREAK = r"[ \t]*(?:\\+[nr]|[\r\n])(?:\\+[nrt]|\s)*"
# The first characters of a DER sequence or an OpenSSH container, in base64.
START64 = re.compile(r"M[A-I]|b3BlbnNzaC1rZXktdjEA")
LINE64 = re.compile(rf"([A-Za-z0-9+/_-]+)(={{0,2}})(?:{BREAK}(?=[A-Za-z0-9+/_=-]))?")
LEAST_64 = 32
# The object identifiers below which PKCS#5 and PKCS#12 have their encryption schemes.
ENCRYPTING = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
RUNHEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{48,}(?![0-9A-Fa-f])")


def decode64(run: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, with or without padding."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER items that fill ``data`` exactly, else None.

    Constructed items must themselves be filled exactly, down to 8 levels.
    """
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > len(data):
                return None
            length, at = int.from_bytes(data[at : at + size], "big"), at + size
            if length < 0x80:  # DER asks for the shortest form
                return None
        if at + length > len(data):
            return None
        content, at = data[at : at + length], at + length
        if tag & 0x20 and (depth >= 8 or der_items(content, depth + 1) is None):
            return None
        items.append((tag, content))
    return items


def is_der_key(data: bytes) -> bool:
    """PKCS#1, PKCS#8 (plain or encrypted), SEC1 and DSA private keys."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    outer = der_items(data)
    if outer is None or len(outer) != 1:
        return False
    items = der_items(outer[0][1]) or []
    tags = [tag for tag, _ in items]
    if tags[:2] == [0x30, 0x04] and len(tags) == 2:
        # An algorithm and octets are an encrypted key only if the algorithm encrypts by password; a mere digest looks alike.
        inner = der_items(items[0][1]) or []
        return bool(inner) and inner[0][0] == 0x06 and inner[0][1].startswith(ENCRYPTING)
    if len(tags) < 2 or tags[0] != 0x02 or items[0][1] not in (b"\x00", b"\x01"):
        return False
    if tags[1] == 0x30:
        inner = der_items(items[1][1]) or []
        return len(tags) >= 3 and tags[2] == 0x04 and bool(inner) and inner[0][0] == 0x06
    if tags[1] == 0x04:
        return items[0][1] == b"\x01" and len(items[1][1]) >= 16
    return len(tags) >= 6 and all(tag == 0x02 for tag in tags)


def is_openssh_key(data: bytes) -> bool:
    return openssh_size(data) is not None


def openssh_size(data: bytes) -> int | None:
    """Bytes of an OpenSSH container: length-prefixed strings, then as many keys as it says. None if it is not one."""
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return None
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        found, at = data[at + 4 : at + 4 + size], at + 4 + size
        return found

    if any(field() is None for _ in range(3)) or at + 4 > len(data):
        return None
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    whole = 1 <= keys <= 64 and all(field() is not None for _ in range(keys)) and field() is not None
    return at if whole else None


def is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_openssh_key(data))


def is_signed_token(header: str, payload: str) -> bool:
    """A token whose header is a JSON object that names an algorithm, and whose payload is JSON."""
    parts = []
    for part in (header, payload):
        data = decode64(part)
        if data is None:
            return False
        try:
            parts.append(json.loads(data.decode("utf-8")))
        except (ValueError, RecursionError):
            return False
    return isinstance(parts[0], dict) and isinstance(parts[0].get("alg"), str) and isinstance(parts[1], dict)


def der_size(head: bytes) -> int:
    """Bytes of the DER sequence that begins with ``head``, by its length; 0 if no key begins so."""
    at, length = 2, head[1]
    if length & 0x80:
        at += length & 0x7F
        if not 3 <= at <= 6:
            return 0
        length = int.from_bytes(head[2:at], "big")
    return at + length if head[0] == 0x30 and head[at] in (0x02, 0x30) else 0


def run64(text: str, at: int, most: int | None = None) -> tuple[str, list[tuple[int, int, int]]]:
    """Base64 characters from ``at`` on without line breaks, and start, characters and padding of each line, until there are ``most``."""
    lines, spans, n = [], [], 0
    while (most is None or n < most) and (m := LINE64.match(text, at)):
        lines.append(m[1])
        spans.append((at, len(m[1]), len(m[2])))
        n, at = n + len(m[1]), m.end()
        if m[2] or at == m.end(1):
            break
    return "".join(lines), spans


def key64_end(text: str, start: int) -> int | None:
    """Where a key in base64 that begins at ``start`` ends, padding included; None if there is none."""
    head, _ = run64(text, start, 12)
    if len(head) < 12:
        return None
    ssh = head[0] == "b"
    size = None if ssh else der_size(decode64(head[:12]))
    if size == 0:
        return None
    body, spans = run64(text, start, None if ssh else -(-size * 4 // 3))
    if ssh:
        size = openssh_size(decode64(body[: len(body) - (len(body) % 4 == 1)])) or 0
    need = -(-size * 4 // 3)
    if not LEAST_64 <= need <= len(body) or not (ssh or is_der_key(decode64(body[:need])[:size])):
        return None
    left = need
    for at, n, pad in spans:
        if left <= n:
            break
        left -= n
    if left == n:
        return at + n + pad
    # Padding that fits all up to here says that the key is only the head of a longer value.
    if pad and (need - left + n + pad) % 4 == 0:
        return at + n + pad if ssh else None
    return at + left


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, unordered."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_VALUE]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of candidates whose decoded structure is that of a key or token."""
    spans = []
    if "-----BEGIN" in text:
        for m in PEM.finditer(text):
            if is_key(decode64(re.sub(r"\s+|\\+[nrt]", "", m[2]))):
                spans.append((m.start(), 3, m.end()))
    framed = [(start, end) for start, _, end in spans]
    spans += [(m.start(), 4, m.end()) for m in JWT.finditer(text) if is_signed_token(m[1], m[2])]
    last = 0
    for m in START64.finditer(text):
        if m.start() >= last and (end := key64_end(text, m.start())):
            last = end
            # A key of several lines between its BEGIN and END is reported already.
            whole = LINE64.match(text, m.start()).end(2) >= end
            if whole or not any(a <= m.start() and end <= b for a, b in framed):
                spans.append((m.start(), 5, end))
    for m in RUNHEX.finditer(text):
        if len(m[0]) % 2 == 0 and m[0][:2].lower() in ("30", "6f") and is_key(bytes.fromhex(m[0])):
            spans.append((m.start(), 6, m.end()))
    return spans


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SCHEMA = "n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts per base kind, a digest of the base spans, all spans.

    ``spans`` lists ``kind:start:end`` in code points, ordered by start and then
    kind. A document without secrets has an empty list and the digest of nothing.
    """
    kind_of_id = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = sorted(base_spans(text))
                more = confirmed_spans(text)
                counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts, len(more), digest, written(sorted(base + more))))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            names = ["n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [id_col, *names])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind_of_id}, {SCHEMA}")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[{kind}]") -> DataFrame:
    """The same rows and columns, with every found span replaced by ``mark``.

    Overlapping spans become one mark, of the first kind. A null text stays null.
    All columns are carried along as they are.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else masked(t, mark) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def masked(text: str, mark: str) -> str:
    out, at = [], 0
    for start, kind, end in sorted(base_spans(text) + confirmed_spans(text)):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark.format(kind=KINDS[kind])]
        at = end
    return "".join([*out, text[at:]])
