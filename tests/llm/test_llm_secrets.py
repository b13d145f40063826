"""Secret scans: base spans against the standard library's re, confirmed encodings by construction."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re

from instructspark.llm.secrets import find_secrets, is_der_key, scan

KINDS = ["assign", "access", "hex"]
PLAIN = [
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I), "assign"),
    (re.compile(r"AKIA[A-Z0-9]+"), "access"),
    (re.compile(r"[0-9a-f]+"), "hex"),
]


def plain_base(text):
    spans = []
    for pattern, kind in PLAIN:
        for m in pattern.finditer(text):
            if kind == "assign" and len(m.group(2)) < 6 or kind == "access" and len(m.group()) < 20 or kind == "hex" and len(m.group()) < 24:
                continue
            spans.append((m.start(), KINDS.index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(spans))


def _der(tag, body):
    n = len(body)
    length = bytes([n]) if n < 128 else bytes([0x80 | len(n.to_bytes(4, "big").lstrip(b"\0"))]) + n.to_bytes(4, "big").lstrip(b"\0")
    return bytes([tag]) + length + body


KEY = _der(0x30, _der(0x02, b"\x00") + _der(0x30, _der(0x06, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + _der(0x05, b""))
           + _der(0x04, _der(0x30, _der(0x02, b"\x00") + _der(0x02, bytes(range(1, 130))) + _der(0x02, b"\x01\x00\x01"))))


def test_base_spans_equal_re():
    rng = random.Random(5)
    parts = ["token = ", "PASSWORD: '", "api_key=", "apikey:", "AKIA", "ABCDEFGHIJ0123456789XYZ", "deadbeef",
             "0123456789abcdef0123456789", "é", " ", "\n", "secret\"=", "x" * 8, "short", "=", "'", "ÅKIA"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        found = scan(text)
        base = plain_base(text)
        assert found["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), text
        assert found["n_assign"] == base.count("assign:") and found["n_hex"] == base.count("hex:")


def test_positions_are_code_points():
    text = "ü€😀 token='abcdef1'"
    assert scan(text)["spans"] == "assign:4:18"


def test_confirmed_encodings():
    assert is_der_key(KEY)
    pem = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(
        base64.b64encode(KEY).decode()[i : i + 64] for i in range(0, len(base64.b64encode(KEY)), 64)
    ) + "\n-----END PRIVATE KEY-----"
    text = "see " + pem + " end"
    assert scan(text)["spans"] == f"key:4:{4 + len(pem)}"
    hexed = KEY.hex()
    found = scan("k " + hexed)
    assert f"key:2:{2 + len(hexed)}" in found["spans"] and found["n_hex"] == 1
    raw = base64.b64encode(KEY).decode()
    assert scan(raw)["spans"] == f"key:0:{len(raw)}"

    def part(obj):
        return base64.urlsafe_b64encode(json.dumps(obj).encode()).decode().rstrip("=")

    token = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJlc2ln"
    assert scan(f"Bearer {token}")["spans"] == f"jwt:7:{7 + len(token)}"
    openssh = base64.b64encode(b"openssh-key-v1\x00" + b"\x00\x00\x00\x04none" * 2 + b"\x00\x00\x00\x00" + b"\x00\x00\x00\x01" + b"x" * 40).decode()
    assert scan(openssh)["n_confirmed"] == 1


def test_random_encodings_are_not_confirmed():
    rng = random.Random(6)
    for _ in range(300):
        blob = bytes(rng.randrange(256) for _ in range(rng.randint(30, 200)))
        assert scan(base64.b64encode(blob).decode())["n_confirmed"] == 0
        assert scan(blob.hex())["n_confirmed"] == 0
    bad = bytearray(KEY)
    bad[1] -= 1
    assert not is_der_key(bytes(bad))
    assert scan("a.b.c aaaaaaaaaa.bbbbbbbbbb.cc")["n_confirmed"] == 0


def test_rows_nulls_repeats_and_long_texts(spark):
    long_text = ("word " * 200_000) + "token: 'abcdefghij' " + "0" * 30
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "secret=abcdef", "z"), (3, long_text, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = {(r["doc_id"], i): r for i, r in enumerate(find_secrets(df).orderBy("doc_id").collect())}
    got = sorted(out.values(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert len(got) == 5
    assert got[0]["doc_id"] is None and got[0]["n_assign"] == 1
    empty = hashlib.sha256(b"").hexdigest()
    assert [r["base_sha256"] for r in got[1:4]] == [empty] * 3
    assert got[4]["n_assign"] == 1 and got[4]["n_hex"] == 1
    assert find_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0
