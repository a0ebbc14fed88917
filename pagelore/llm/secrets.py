"""Secrets in whole texts: fixed patterns, and candidates that must decode and parse.

A run of base64 or hex counts only if its bytes are a private key whose nested lengths add up,
or UTF-8 text, of one line or many, that holds a secret of any kind itself; a signed token only if its header and claims parse. Every
span is in code points, end exclusive.
"""

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.llm.texthash import slices

# The base patterns, the part of a match that is measured, its least length.
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": (re.compile(_ASSIGN, re.ASCII), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
# The order of kinds that start at the same place.
KINDS = ("assign", "access", "hex", "jwt", "pem", "key", "hexkey", "encoded")

_JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
_PEM = re.compile(r"-----BEGIN ([A-Z]+ )?PRIVATE KEY-----([A-Za-z0-9+/=\s]*)-----END \1?PRIVATE KEY-----")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
# Whole runs of digits, whatever stands around them: 0x3082..., x'3082...', 3082...h.
_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
# No plain text: control characters other than tabs, line ends and form feeds.
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
_OPENSSH = b"openssh-key-v1\0"

# What a text must contain for a kind to be searched in it; a text without it has no such span.
_HINTS = {
    "assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""",
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
    "jwt": r"eyJ[A-Za-z0-9_-]+\.eyJ",
    "pem": r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----",
    "base64": r"[A-Za-z0-9+/_-]{24}",
    "hexkey": r"[0-9A-Fa-f]{48}",
}


def _decoded(run: str) -> bytes | None:
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, stop) of the DER values that fill a range exactly; None if they do not."""
    items = []
    while at < end:
        if end - at < 2:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
        if at + size > end:
            return None
        items.append((tag, at, at + size))
        at += size
    return items


def _is_der_key(data: bytes) -> bool:
    outer = der_items(data, 0, len(data))
    if outer is None or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    items = der_items(data, outer[0][1], outer[0][2])
    if items is None or len(items) < 3 or items[0][0] != 0x02 or items[0][2] - items[0][1] != 1:
        return False
    tags = [tag for tag, _, _ in items]
    if tags[1] == 0x30 and tags[2] == 0x04:  # any algorithm: its name, then the key in a string
        name = der_items(data, *items[1][1:])
        return bool(name) and name[0][0] == 0x06
    if tags[1] == 0x04:  # elliptic curve
        return data[items[0][1]] == 1 and tags[2] in (0xA0, 0xA1)
    return len(items) >= 6 and all(tag == 0x02 for tag in tags[:6])  # RSA and DSA: numbers


def _is_openssh_key(data: bytes) -> bool:
    if not data.startswith(_OPENSSH):
        return False
    at, fields = len(_OPENSSH), 0
    while at + 4 <= len(data) and fields < 3:  # cipher, key derivation, its options
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        fields += 1
    if fields < 3 or at + 4 > len(data):
        return False
    at, keys = at + 4, int.from_bytes(data[at : at + 4], "big")
    for _ in range(min(keys, 64) + 1):  # the public keys, then the private part
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return keys >= 1 and at == len(data)


def is_private_key(data: bytes) -> bool:
    return _is_der_key(data) or _is_openssh_key(data)


def is_signed_token(header: str, claims: str) -> bool:
    """Whether both parts decode to JSON objects and the header names an algorithm."""
    try:
        first, second = (json.loads(_decoded(part) or b"") for part in (header, claims))
    except (ValueError, RecursionError):
        return False
    return isinstance(first, dict) and isinstance(first.get("alg"), str) and isinstance(second, dict)


def base_spans(text: str, kinds=tuple(BASE)) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns: matches from the left that do not overlap, of
    which those with too short a value are dropped."""
    found = []
    for kind in kinds:
        pattern, group, least = BASE[kind]
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), kind, m.end()))
    return found


def _hidden(data: bytes) -> bool:
    """Whether decoded bytes are plain text with a secret of any kind in it.

    A run inside that text is decoded again; each time at least a quarter of the length goes.
    """
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return not _CONTROL.search(text) and bool(spans_of(text))


def confirmed_spans(text: str, kinds) -> list[tuple[int, str, int]]:
    found = []
    if "jwt" in kinds:
        found += [(m.start(), "jwt", m.end()) for m in _JWT.finditer(text) if is_signed_token(m[1], m[2])]
    if "pem" in kinds:
        for m in _PEM.finditer(text):
            data = _decoded("".join(m[2].split()))
            if data is not None and is_private_key(data):
                found.append((m.start(), "pem", m.end()))
    if "base64" in kinds:
        for m in _BASE64.finditer(text):
            data = _decoded(m[0])
            if data is not None and is_private_key(data):
                found.append((m.start(), "key", m.end()))
            elif data is not None and _hidden(data):
                found.append((m.start(), "encoded", m.end()))
    if "hexkey" in kinds:
        for m in _HEX.finditer(text):
            data = bytes.fromhex(m[0])
            if is_private_key(data):
                found.append((m.start(), "hexkey", m.end()))
            elif _hidden(data):
                found.append((m.start(), "encoded", m.end()))
    return found


def spans_of(text: str, kinds=tuple(_HINTS)) -> list[tuple[int, str, int]]:
    """All spans of a text by start, then by the order of :data:`KINDS`."""
    found = base_spans(text, [k for k in BASE if k in kinds]) + confirmed_spans(text, kinds)
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[1]), span[2]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, secrets): kind, start and end of every secret, in order, one row a document.

    Null and empty texts have none; repeated rows and null ids stay rows of their own. Columns
    other than doc_id and text are ignored.
    """
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = pc.fill_null(part.column(1), "")
                wanted: dict[int, list[str]] = {}
                for kind, hint in _HINTS.items():
                    hits = pc.match_substring_regex(texts, hint).to_numpy(zero_copy_only=False)
                    for i in hits.nonzero()[0].tolist():
                        wanted.setdefault(i, []).append(kind)
                found = [
                    [
                        {"kind": kind, "start": start, "end": end}
                        for start, kind, end in spans_of(texts[i].as_py(), wanted[i])
                    ]
                    if i in wanted else []
                    for i in range(part.num_rows)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(item))], ["doc_id", "secrets"]
                )

    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return wanted.mapInArrow(
        run, "doc_id long, secrets array<struct<kind:string,start:long,end:long>>"
    )
