"""Personal data: patterns propose, checksums confirm, context words score.

Everything here is built from SQL functions; no Python runs on the executors.
For each kind a regular expression proposes the leftmost non-overlapping spans,
a validator confirms them (octets up to 255, Luhn for card numbers, mod 97 for
IBANs, digit counts for phone numbers), and words of the kind's vocabulary in
the 40 characters before or after raise the score. The base kinds (email, ip,
card, phone) keep every confirmed span, whatever its score. The kinds added by
the method (iban, ssn) need a score of at least ``MIN_SCORE``: an IBAN has it by
its checksum, a number in the shape of an SSN only with a context word nearby.

Long texts take time in proportion to their length (but for a factor of the
number of binary digits of the number of matches): repeats are possessive where
nothing may be given back, an email is only tried where its run of characters
begins or the match before ended, positions are running sums of lengths, and
context is looked up in pieces of the text. Positions are code points, end
exclusive.

Edge cases: a null text counts as empty and gets a row with no spans; rows are
never dropped, merged or matched by id; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.5
CONTEXT = 40
#: Characters of the pieces out of which a match's surroundings are taken.
PIECE = 1024
#: kind, proposing pattern, cheap test that must hold for the text, validator of the match m, prior, context words.
KINDS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(t, '@')", "true", 0.9, "mail|contact|kontakt|correo|courriel"),
    ("ip", r"[0-9]++(?:\.[0-9]++){3}", "rlike(t, '[0-9][.][0-9]')", "forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)", 0.6, "ip|host|server|addr|login"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", "rlike(t, '[0-9]')", "length(translate(m, ' -', '')) BETWEEN 14 AND 19 AND luhn_check(translate(m, ' -', ''))", 0.8, "card|visa|master|credit|karte|carte|tarjeta"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains(t, '+')", "length(regexp_replace(m, '[^0-9]', '')) BETWEEN 10 AND 15", 0.7, "phone|tel|call|mobil|fax"),
    ("iban", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9_])", "rlike(t, '[A-Z][A-Z][0-9][0-9]')", "aggregate(split(concat(substr(replace(m, ' ', ''), 5), substr(m, 1, 4)), ''), 0, (a, c) -> CASE WHEN c = '' THEN a WHEN c <= '9' THEN (a * 10 + ascii(c) - 48) % 97 ELSE (a * 100 + ascii(c) - 55) % 97 END) = 1", 0.8, "iban|bank|account|konto|compte|cuenta"),
    ("ssn", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])", "rlike(t, '[0-9]-[0-9][0-9]-[0-9]')", "NOT rlike(m, '^(000|666|9)|-00-|0000$')", 0.2, "ssn|social|security|tax|sozial"),
)
BASE = ("email", "ip", "card", "phone")


_KIND = "array<struct<start:int,ord:int,end:int,kind:string,score:double>>"


def _let(value: str, name: str, body: str) -> str:
    """SQL of body with name standing for value, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _running(xs: str, join: str = "a + b") -> str:
    """SQL of the running sums (or whatever joins a and b) of an array of numbers from 0 on, in as many passes as its size has binary digits."""
    shifted = "slice(concat(array_repeat(0, CAST(shiftleft(1, k) AS int)), acc), 1, size(acc))"
    return f"aggregate(sequence(0, length(bin(size({xs}))) - 1), {xs}, (acc, k) -> zip_with(acc, {shifted}, (a, b) -> {join}))"


def _around(start: str, length: str) -> str:
    """SQL of length characters of the text from start on (0: its first), out of the few pieces that hold them."""
    first, last = f"({start}) div {PIECE}", f"({start} + {length} - 1) div {PIECE}"
    held = f"CASE WHEN {last} <= {first} + 1 THEN concat(get(ts, CAST({first} AS int)), CASE WHEN {last} > {first} THEN coalesce(get(ts, CAST({last} AS int)), '') ELSE '' END) ELSE array_join(slice(ts, CAST({first} AS int) + 1, CAST({last} - {first} AS int) + 1), '') END"
    return f"substr({held}, CAST(({start}) % {PIECE} AS int) + 1, {length})"


def _spans(order: int, kind: str, pattern: str, test: str, valid: str, prior: float, words: str) -> str:
    """SQL of an array of (start, order, end, kind, score); t is the text."""
    p = "r'" + pattern + "'"
    check = valid.replace("(m,", "(x.m,").replace(" m,", " x.m,").replace("(m ", "(x.m ")
    near = _around(f"greatest(x.e - length(x.m) - {CONTEXT}, 0)", f"(length(x.m) + {2 * CONTEXT})")
    span = f"named_struct('start', x.e - length(x.m), 'ord', {order}, 'end', x.e, 'kind', '{kind}', 'score', round({prior}D + if(rlike(lower({near}), '{words}'), 0.3D, 0D), 2))"
    scored = f"CASE WHEN size(good) = 0 THEN CAST(array() AS {_KIND}) ELSE {_let(f"regexp_extract_all(t, '(?s).{{1,{PIECE}}}', 0)", 'ts', f'transform(good, x -> {span})')} END"
    good = _let(f"filter(zip_with(ms, es, (m, e) -> named_struct('m', m, 'e', e)), x -> {check})", "good", scored)
    ends = _let("zip_with(ms, slice(ps, 1, size(ms)), (m, p) -> length(p) + length(m))", "ls", _let(_running("ls"), "es", good))
    found = _let(f"regexp_extract_all(t, {p}, 0)", "ms", f"CASE WHEN size(ms) = 0 THEN CAST(array() AS {_KIND}) ELSE {_let(f'split(t, {p}, -1)', 'ps', ends)} END")
    return f"CASE WHEN {test} THEN {found} ELSE CAST(array() AS {_KIND}) END"


def find(text: str = "text") -> dict[str, Column]:
    """One column of confirmed spans for each kind, named by kind, over a column t."""
    return {k[0]: F.expr(_spans(i, *k)) for i, k in enumerate(KINDS)}


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, text and spans: an array of (start, ord, end, kind, score) sorted by start, then kind."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    found = rows.select("doc_id", "t", *[c.alias(k) for k, c in find().items()])
    added = [F.filter(k[0], lambda x: x.score >= MIN_SCORE).alias(k[0]) if k[0] not in BASE else F.col(k[0]) for k in KINDS]
    return found.select("doc_id", F.col("t").alias("text"), *added).select("doc_id", "text", *[k[0] for k in KINDS], F.array_sort(F.concat(*[F.col(k[0]) for k in KINDS])).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """doc_id and text with every span replaced by its kind in angle brackets; spans that overlap are replaced as one, by the first's kind."""
    piece = _around("x.before", "(x.start - x.before)")
    said = f"array_join(transform(heads, x -> concat(CASE WHEN x.start > x.before THEN {piece} ELSE '' END, '<', x.kind, '>')), '')"
    heads = "filter(zip_with(spans, slice(concat(array(0), es), 1, size(spans)), (x, e) -> named_struct('start', x.start, 'kind', x.kind, 'before', e)), (x, i) -> i = 0 OR x.start >= x.before)"
    done = _let("transform(spans, x -> x.end)", "ls", _let(_running("ls", "greatest(a, b)"), "es", _let(heads, "heads", _let(f"regexp_extract_all(text, '(?s).{{1,{PIECE}}}', 0)", "ts", f"concat({said}, substr(text, element_at(es, -1) + 1))"))))
    return detect(docs).select("doc_id", F.expr(f"CASE WHEN size(spans) = 0 THEN text ELSE {done} END").alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as kind:start:end."""
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    base = F.filter("spans", lambda x: x.ord < len(BASE))
    score = F.coalesce(F.array_max(F.transform("spans", lambda x: x.score)), F.lit(0.0))
    return detect(docs).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
        said("spans").alias("spans"),
        *[F.size(k[0]).cast("long").alias(f"n_{k[0]}") for k in KINDS if k[0] not in BASE],
        score.alias("max_score"),
    )
