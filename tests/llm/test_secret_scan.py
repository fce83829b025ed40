"""Secrets: base patterns by a plain version, keys and tokens built by hand, all against the query's SQL."""

import base64
import hashlib
import json
import random
import re

import duckdb
import pytest

from fundlake.llm import queries, secret_scan

DOCS = "doc_id long, text string"


def tlv(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8)
    return bytes([tag]) + size + body


def whole(r, bits):
    return tlv(2, b"\0" + r.getrandbits(bits).to_bytes(bits // 8))


def rsa(r):
    return tlv(0x30, tlv(2, b"\0"), *[whole(r, 512) for _ in range(8)])


def sec1(r):
    return tlv(0x30, tlv(2, b"\1"), tlv(4, r.randbytes(32)), tlv(0xA0, tlv(6, bytes.fromhex("2a8648ce3d030107"))))


def pkcs8(r):
    return tlv(0x30, tlv(2, b"\0"), tlv(0x30, tlv(6, bytes.fromhex("2b6570"))), tlv(4, tlv(4, r.randbytes(32))))


def encrypted(r, scheme="2a864886f70d01050d"):
    return tlv(0x30, tlv(0x30, tlv(6, bytes.fromhex(scheme)), tlv(0x30, r.randbytes(20))), tlv(4, r.randbytes(64)))


def ssh(r):
    field = lambda x: len(x).to_bytes(4) + x
    return b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4) + field(r.randbytes(51)) + field(r.randbytes(136))


def public(r):
    return tlv(0x30, tlv(0x30, tlv(6, bytes.fromhex("2b6570"))), tlv(3, r.randbytes(33)))


def b64(data):
    return base64.b64encode(data).decode()


def pem(data, end="\n"):
    x = b64(data)
    return "-----BEGIN PRIVATE KEY-----" + end + end.join(x[i : i + 64] for i in range(0, len(x), 64)) + end + "-----END PRIVATE KEY-----"


def token(header, claims, mark="c2ln"):
    part = lambda x: base64.urlsafe_b64encode(x if isinstance(x, bytes) else json.dumps(x).encode()).decode().rstrip("=")
    return ".".join((part(header), part(claims), mark))


def made():
    r = random.Random(3)
    keys = [rsa(r), sec1(r), pkcs8(r), encrypted(r), encrypted(r, "2a864886f70d010c0103"), ssh(r)]
    rows = [f"é ü {pem(k)} after" for k in keys] + [f"key = '{b64(k)}' é" for k in keys] + [f"x {k.hex()} y" for k in keys] + [f"x {k.hex().upper()}7f\n" for k in keys]
    rows += [pem(keys[0], "\r\n") + "\n" + pem(keys[1]), b64(keys[2]).rstrip("=") + "AAAA more", b64(keys[0])[:-8]]
    no = [public(r), encrypted(r, "2b0e03021a"), tlv(0x30, tlv(2, b"\5"), *[whole(r, 64) for _ in range(8)]), tlv(0x30, *[whole(r, 64)] * 3), r.randbytes(60), tlv(0x30, tlv(2, b"\1"), tlv(4, b"short")), rsa(r)[:-5], ssh(r)[:-4]]
    rows += [f"no {b64(k)} and {k.hex()}" for k in no] + ["M" + "ABCD" * 20, "MAP\nMAN\nMAPPED" + "\nWORD" * 30]
    good = {"alg": "HS256", "typ": "JWT"}
    rows += [f"Bearer {token(good, {'sub': 1})}!", f"a.{token(good, {})}", token({"alg": "none"}, {}, ""), token(good, {}, ""), token({"typ": 1}, {}), token({"alg": 5}, {}), token(good, [1]), token(["alg"], {}), token(good, b"\xff\xfe"), "eyJhbGciOiJI.x.y", token(b'{"alg": "x"', {}), f"{token(good, {'b': 'é'})} {token(good, {'c': [1, {'d': None}]})}"]
    rows += ["password=abcdef", 'PassWord" : "abc.def/g"', "secret:token:abcdef", "token = = abcdef", "api_key=12345", "APIKEY:  '123456'", "apikey=x\napi__key=abcdefg", "paſſword=abcdef toKen=abcdef", "tokentoken=======", "passwd=abcde passwd=abcdef", "secret = \tabcdef", "secret=password=abc"]
    rows += ["AKIA" + "A1" * 8, "AKIA" + "A1" * 7 + "Z", "AKIAAKIA" + "B" * 12, "xAKIA" + "Q" * 40, "éAKIA" + "0" * 16 + "a" + "AKIA" + "0" * 16]
    rows += ["0123456789abcdef01234567", "x0123456789abcdef0123456g", "g" + "ab" * 30 + "G" + "cd" * 12, "\U0001f600 " + "f" * 24, "a" * 23 + " " + "b" * 23]
    rows += ["", None, "plain words only", " " * 50, "token " * 30 + "=" * 50]
    alphabet = ["token", "=", ":", " ", '"', "secret", "abcdef", "AKIA", "0a1b2c3d", "Z9", "\n", "MII", ".", "eyJ", "é"]
    rows += ["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(200)]
    return list(enumerate(rows))


def plain(text):
    """Base spans by patterns as stated, one match after the other."""
    found = []
    for i, (pattern, group, least) in enumerate(((r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6), (r"AKIA[A-Z0-9]+", 0, 20), (r"[0-9a-f]+", 0, 24))):
        flags = re.ASCII | (re.IGNORECASE if i == 0 else 0)
        found += [(m.start(), i, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found)]


@pytest.fixture(scope="module")
def got(spark):
    return {r.doc_id: r for r in secret_scan.report(spark.createDataFrame(made(), DOCS).repartition(3)).collect()}


def test_base(got):
    for i, text in made():
        base = plain(text or "")
        assert [x for x in got[i].spans.split(",") if x and x.split(":")[0] in ("assign", "access", "hex")] == base
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex"))


def test_keys_and_tokens(got):
    texts = dict(made())
    told = {i: [(x.split(":")[0], texts[i][int(x.split(":")[1]) : int(x.split(":")[2])]) for x in r.spans.split(",") if x.startswith(("key", "jwt"))] for i, r in got.items()}
    r = random.Random(3)
    keys = [rsa(r), sec1(r), pkcs8(r), encrypted(r), encrypted(r, "2a864886f70d010c0103"), ssh(r)]
    for i, k in enumerate(keys):
        assert [(kind, x.replace("\n", "")) for kind, x in told[i]] == [("key", b64(k).rstrip("="))]
        assert told[6 + i] == [("key", b64(k).rstrip("="))]
        assert told[12 + i] == [("key", k.hex())] and told[18 + i] == [("key", k.hex().upper())]
    assert [len(told[i]) for i in (24, 25, 26)] == [2, 1, 0]
    assert not any(told[i] for i in range(27, 37))
    assert [len(told[i]) for i in range(37, 49)] == [1, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0, 2]


def test_sql(got):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", made())
    found = con.execute(queries.oracle_sql()["op13_secret_scan"])
    names = [d[0] for d in found.description]
    assert names == list(next(iter(got.values())).asDict())
    for row in found.fetchall():
        assert row == tuple(got[row[0]]), dict(made())[row[0]]


def test_edges(spark):
    long = "word token=abcdefgh " * 100_000
    rows = [(None, None, "x"), (None, "secret=abcdefg", "x"), (1, "", "x"), (1, "", "x"), (2, long, "x")]
    got = [tuple(r) for r in secret_scan.report(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()]
    assert sorted((r[0] or 0, r[1]) for r in got) == [(0, 0), (0, 1), (1, 0), (1, 0), (2, 100_000)]
    assert secret_scan.report(spark.createDataFrame([], DOCS)).collect() == []


def test_redact(spark):
    rows = [(1, f"a secret={'ab' * 12} b {token({'alg': 'x'}, {})}"), (2, None), (3, "é AKIA" + "0" * 16 + "é")]
    assert [tuple(r) for r in secret_scan.redact(spark.createDataFrame(rows, DOCS)).orderBy("doc_id").collect()] == [(1, "a <assign> b <jwt>"), (2, None), (3, "é <access>é")]
