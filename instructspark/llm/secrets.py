"""Secret scans with structural confirmation of encoded candidates.

Three plain patterns find the base kinds (``assign``, ``access``, ``hex``), each
leftmost and non-overlapping on its own.  On top, encoded candidates are decoded
and parsed before they are reported:

* ``jwt``: three base64url segments whose first decodes to a JSON object naming an
  ``alg`` and whose second decodes to a JSON object (a signed token);
* ``key``: a PEM block, or a base64 or hex run, whose decoded bytes are one DER
  SEQUENCE with consistent nested lengths all the way down, holding an INTEGER or
  an OBJECT IDENTIFIER (the encodings of private and public keys), or an OpenSSH
  private key (``openssh-key-v1`` followed by length-prefixed fields that fit).

Positions are code points, ends exclusive.  Texts are scanned whole.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
from collections.abc import Iterator

import re

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: the base patterns and their least lengths.
ASSIGN = regex.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", regex.IGNORECASE)
ASSIGN_LEAST = 6
ACCESS = regex.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = regex.compile(r"[0-9a-f]+")
HEX_LEAST = 24

KINDS = ("assign", "access", "hex", "jwt", "key")
# The standard library's engine scans these simple classes several times faster.
_LONG_HEX = re.compile(f"(?<![0-9a-f])[0-9a-f]{{{HEX_LEAST},}}")

JWT = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,64})-----([A-Za-z0-9+/=\s]+?)-----END \1-----")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}")
# Maximal runs of 32 bytes or more; one of odd length decodes to nothing.
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")
OPENSSH = b"openssh-key-v1\x00"
DEEPEST = 16


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base matches: (kind, start, end), leftmost non-overlapping per kind, short ones dropped."""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    # Runs of hex digits are maximal, so those of the least length on are the long matches.
    spans += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    return spans


def _der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """(length, position after the length octets) of a DER element whose tag is before ``at``."""
    if at >= len(data):
        return None
    first = data[at]
    if first < 0x80:
        return first, at + 1
    octets = first & 0x7F
    if octets == 0 or octets > 4 or at + 1 + octets > len(data):
        return None
    length = int.from_bytes(data[at + 1 : at + 1 + octets], "big")
    if length < 0x80 or data[at + 1] == 0:
        return None  # not the shortest form
    return length, at + 1 + octets


def _der_elements(data: bytes, start: int, end: int, depth: int, seen: set[int]) -> bool:
    """True if ``data[start:end]`` is a run of DER elements whose nested lengths all fit."""
    at = start
    while at < end:
        tag = data[at]
        if tag & 0x1F == 0x1F:
            return False  # long tag numbers do not occur in key encodings
        found = _der_length(data, at + 1)
        if found is None:
            return False
        length, body = found
        if body + length > end:
            return False
        seen.add(tag)
        if tag & 0x20:  # constructed: its content must parse as well
            if depth >= DEEPEST or not _der_elements(data, body, body + length, depth + 1, seen):
                return False
        at = body + length
    return at == end


def is_der_key(data: bytes) -> bool:
    """One DER SEQUENCE spanning all bytes, consistent throughout, holding an INTEGER or an OID."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    found = _der_length(data, 1)
    if found is None or found[1] + found[0] != len(data):
        return False
    seen: set[int] = set()
    return _der_elements(data, 0, len(data), 0, seen) and bool(seen & {0x02, 0x06})


def is_openssh_key(data: bytes) -> bool:
    """The OpenSSH private key format: magic, then length-prefixed fields that fit."""
    if not data.startswith(OPENSSH):
        return False
    at = len(OPENSSH)
    for _ in range(3):  # cipher, kdf name, kdf options
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4 + size
        if at > len(data):
            return False
    return at + 4 <= len(data) and int.from_bytes(data[at : at + 4], "big") >= 1


def _b64(text: str, url: bool = False) -> bytes | None:
    body = "".join(text.split())
    body += "=" * (-len(body) % 4)
    try:
        return (base64.urlsafe_b64decode if url else base64.b64decode)(body.encode("ascii"))
    except (binascii.Error, ValueError):
        return None


def _json_object(data: bytes | None) -> dict | None:
    if data is None:
        return None
    try:
        value = json.loads(data.decode("utf-8"))
    except (UnicodeDecodeError, ValueError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(token: str) -> bool:
    """A JSON header with a string ``alg`` and a JSON payload, both base64url."""
    head, payload, _ = token.split(".", 2)
    header = _json_object(_b64(head, url=True))
    return bool(header) and isinstance(header.get("alg"), str) and _json_object(_b64(payload, url=True)) is not None


def _is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_openssh_key(data))


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans the method adds: signed tokens and decoded key encodings."""
    spans = [("jwt", m.start(), m.end()) for m in JWT.finditer(text) if is_signed_token(m.group())]
    inside: list[tuple[int, int]] = []
    for m in PEM.finditer(text):
        if _is_key(_b64(m.group(2))):
            spans.append(("key", m.start(), m.end()))
            inside.append((m.start(), m.end()))
    covered = lambda s, e: any(a <= s and e <= b for a, b in inside)
    for m in BASE64.finditer(text):
        if not covered(m.start(), m.end()) and _is_key(_b64(m.group())):
            spans.append(("key", m.start(), m.end()))
    for m in HEX_RUN.finditer(text):
        if len(m.group()) % 2 == 0 and not covered(m.start(), m.end()) and _is_key(bytes.fromhex(m.group())):
            spans.append(("key", m.start(), m.end()))
    return spans


def joined(spans: list[tuple[str, int, int]]) -> str:
    """``kind:start:end`` by start, then kind in the order of ``KINDS``, comma-joined."""
    order = {kind: i for i, kind in enumerate(KINDS)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(set(spans), key=lambda t: (t[1], order[t[0]], t[2])))


def scan(text: str | None) -> dict:
    """Counts of base kinds, the digest of base spans and all spans of one text (NULL: empty)."""
    text = text or ""
    base = base_spans(text)
    found = base + confirmed_spans(text)
    listed = joined(base)
    return {
        "n_assign": sum(1 for k, _, _ in base if k == "assign"),
        "n_access": sum(1 for k, _, _ in base if k == "access"),
        "n_hex": sum(1 for k, _, _ in base if k == "hex"),
        "n_confirmed": len(found) - len(base),
        "base_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "spans": joined(found),
    }


RESULT = "n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"


def find_secrets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: ``key`` and the columns of ``scan`` for its whole text.

    NULL and empty texts have no spans (digest of the empty string).  Every row gives
    one row, repeated ones too; a NULL key stays NULL.  Other columns are not carried,
    so their names cannot clash.  A text is held once in a Python worker, as long as
    it is; the patterns run in linear passes.
    """
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([scan(t) for t in batch["_t"]], columns=[c.split()[0] for c in RESULT.split(", ")])
            found.insert(0, key, batch["_k"].to_numpy())
            yield found

    picked = df.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t"))
    return picked.mapInPandas(run, f"`{key}` {key_type}, {RESULT}")
