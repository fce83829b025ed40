"""Secret scans with structural confirmation.

Base kinds (assign, access, hex) are patterns with a least length; their matches
are the leftmost non-overlapping ones, and a match that fails is passed over
whole. The method adds kinds whose candidates are decoded and parsed before
anything is reported:

jwt  three base64url segments. The first must decode to a JSON object with a
     string member ``alg``, the second to a JSON object, and the third must be
     there unless ``alg`` is none.
key  runs of base64 (also over several lines, as in PEM) or hex that decode to a
     private key. DER: an outer SEQUENCE whose nested lengths fill it exactly
     and whose members' tags spell PKCS#1, DSA, SEC 1, PKCS#8 or encrypted
     PKCS#8 (with an identifier of a password scheme). OpenSSH: the magic and a
     chain of length-prefixed fields up to the private block. The span ends with
     the last character of the structure, whatever follows it in the run.

Certificates, public keys, signatures, digests and random runs decode too, but
spell none of these, so they are not reported as keys. Base spans stay, whether
or not they overlap an added one. A text is scanned in one pass a kind, in time
proportional to its length. Positions are code points, end exclusive.

Edge cases: a null or empty text has a row with no spans; rows are never
dropped, merged or matched by id (null and repeated ids pass), other columns do
not matter, an empty table gives an empty result. A match over a very long text
is one span like any other.
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

from fundlake.llm.scratch import tune

#: Patterns of the base kinds, and the group and its least length. Letters of names match in either case, ASCII only.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
#: The least length is in these patterns: a run that is too short has no longer part.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
#: A JSON object begins with "{": e and one of w-z, 0-9, - and _ in base64url.
JWT = re.compile(r"(?<![A-Za-z0-9_.-])e[w-z0-9_-][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
#: A SEQUENCE begins with the byte 30: M and one of A-P. Lines of a PEM body belong together.
DER64 = re.compile(r"(?<![A-Za-z0-9+/])M[A-P][A-Za-z0-9+/]{14,}(?:\r?\n[A-Za-z0-9+/]+)*")
SSH64 = re.compile(r"(?<![A-Za-z0-9+/])b3BlbnNzaC1rZXktdjEA[A-Za-z0-9+/]+(?:\r?\n[A-Za-z0-9+/]+)*")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70656[Ee]7373682[Dd]6[Bb]65792[Dd]763100)[0-9A-Fa-f]{16,}")
MAGIC = b"openssh-key-v1\0"
#: Tags of the members of a private key's SEQUENCE. Fixed values of the formats.
LAYOUTS = re.compile(r"(?:02){9}|(?:02){6}|0204(?:a0)?(?:a1)?|023004(?:a0)?(?:81|a1)?|3004")
#: Identifiers of encrypted PKCS#8: PKCS#5 schemes and those of PKCS#12.
SCHEMES = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
KINDS = ("assign", "access", "hex", "jwt", "key")
BASE = 3

Span = tuple[int, int, int]  # start, kind, end


def _json(segment: str) -> object:
    try:
        return json.loads(base64.urlsafe_b64decode(segment + "=" * (-len(segment) % 4)).decode())
    except (ValueError, RecursionError):
        return None


def is_token(text: str) -> bool:
    """A signed token: header and claims are JSON objects, the header names its algorithm."""
    head, claims, mark = text.split(".")
    header = _json(head)
    if not (isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(_json(claims), dict)):
        return False
    return bool(mark) or header["alg"].lower() == "none"


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the contents of the DER element at a place; None if it has no definite length that fits."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n >= 0x80:
        many = n - 0x80
        if not 1 <= many <= 4 or at + many > end:
            return None
        n, at = int.from_bytes(data[at : at + many]), at + many
    return (tag, at, at + n) if at + n <= end else None


def members(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill data[at:end]; None if they don't fill it exactly."""
    found = []
    while at < end:
        x = element(data, at, end)
        if x is None or len(found) == 16:  # no layout has as many
            return None
        found.append(x)
        at = x[2]
    return found


def der_key(data: bytes) -> int:
    """Bytes of the private key that data begins with; 0 if there is none."""
    outer = element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or (inner := members(data, *outer[1:])) is None:
        return 0
    tags = "".join(f"{x[0]:02x}" for x in inner)
    if not LAYOUTS.fullmatch(tags):
        return 0
    if tags.startswith("02") and data[inner[0][1] : inner[0][2]] not in (b"\0", b"\1"):
        return 0  # all begin with a version
    if tags.startswith("0204") and inner[1][2] - inner[1][1] < 16:
        return 0  # too short for a curve's secret
    if "30" in tags:
        algorithm = inner[tags.index("30") // 2]
        named = element(data, *algorithm[1:])
        if named is None or named[0] != 0x06:
            return 0
        if tags == "3004" and not data[named[1] : named[2]].startswith(SCHEMES):
            return 0
    return outer[2]


def ssh_key(data: bytes) -> int:
    """Bytes of the OpenSSH private key that data begins with; 0 if there is none."""
    if not data.startswith(MAGIC):
        return 0
    at, keys = len(MAGIC), 0
    for field in range(5):  # cipher, function, its options, then the keys and the private block
        if field == 3:
            keys, at = int.from_bytes(data[at : at + 4]), at + 4
            if keys != 1:
                return 0
        if at + 4 > len(data):
            return 0
        n = int.from_bytes(data[at : at + 4])
        at += 4 + n
        if at > len(data) or (n == 0 and field != 2):
            return 0
    return at


def _key64(run: str) -> int:
    """Characters of the run (lines of base64) that its key takes; 0 if it is none."""
    plain = run.replace("\r", "").replace("\n", "")
    try:
        data = base64.b64decode(plain[: len(plain) // 4 * 4] + ("" if len(plain) % 4 < 2 else plain[len(plain) // 4 * 4 :] + "=" * (-len(plain) % 4)))
    except binascii.Error:
        return 0
    size = der_key(data) or ssh_key(data)
    chars = -(-size * 4 // 3)
    if len(plain) == len(run) or not chars:
        return chars
    for m in re.finditer("[\r\n]+", run):  # line breaks before the last character do not count
        if m.start() >= chars:
            break
        chars += len(m[0])
    return chars


def _key16(run: str) -> int:
    data = bytes.fromhex(run[: len(run) // 2 * 2])
    return 2 * (der_key(data) or ssh_key(data))


def scan(text: str) -> list[Span]:
    """(start, kind, end) of all spans, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    found += [(m.start(), 3, m.end()) for m in JWT.finditer(text) if is_token(m[0])]
    for pattern, size in ((DER64, _key64), (SSH64, _key64), (HEX_KEY, _key16)):
        found += [(m.start(), 4, m.start() + n) for m in pattern.finditer(text) if (n := size(m[0]))]
    return sorted(found)


def _said(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, all spans as kind:start:end, counts of the added kinds."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_spans = [scan(x) if x else [] for x in batch["text"].to_pylist()]
            base = [[x for x in spans if x[1] < BASE] for spans in all_spans]
            counts = [pa.array([sum(x[1] == k for x in spans) for spans in all_spans], pa.int64()) for k in range(len(KINDS))]
            digests = pa.array([hashlib.sha256(_said(x).encode()).hexdigest() for x in base])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *counts[:BASE], digests, pa.array([_said(x) for x in all_spans], pa.string()), *counts[BASE:]], names=names)

    ids = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[f"n_{k}" for k in KINDS[:BASE]], "base_sha256", "spans", *[f"n_{k}" for k in KINDS[BASE:]]]
    kinds = [ids, *["long"] * BASE, "string", "string", *["long"] * (len(KINDS) - BASE)]
    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))


def redact(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with every span replaced by its kind in angle brackets; spans that overlap are replaced as one, by the first's kind."""
    tune(docs.sparkSession)

    def clean(text: str) -> str:
        out, done = [], 0
        for start, kind, end in scan(text):
            if start >= done:
                out += [text[done:start], f"<{KINDS[kind]}>"]
            done = max(done, end)
        return "".join(out) + text[done:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([x and clean(x) for x in batch["text"].to_pylist()], pa.string())], names=["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string")
