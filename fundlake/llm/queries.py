"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.line_dedup import line_report

    return line_report(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
hot AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN hot USING (k) GROUP BY doc_id
"""


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.substring_dedup import window_report

    return window_report(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(list_slice(w, p, p + 34), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 34, 0) + 1)) AS p FROM w)),
dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY g) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS q FROM dup),
word AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS q FROM w),
kept AS (
  SELECT doc_id, count(g.q) AS removed, string_agg(t, ' ' ORDER BY q) FILTER (WHERE g.q IS NULL) AS k
  FROM word LEFT JOIN gone g USING (doc_id, q) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.chat import format_chats

    return format_chats(table(spark, sf_dir, "conversations"))


def op3_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.ctw import score

    return score(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.pii import report

    return report(table(spark, sf_dir, "documents"))


def _pii_sql() -> str:
    """The kinds' plain patterns (possessive marks and lookarounds only save time or mean a word boundary)."""
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", 0.9, "mail|contact|kontakt|correo|courriel"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda p: p::DOUBLE)) <= 255", 0.6, "ip|host|server|addr|login"),
        ("card", r"[0-9]([\x20-]?[0-9])+", "length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse(d), i, 1)::INT ELSE (substr(reverse(d), i, 1)::INT * 2) // 10 + (substr(reverse(d), i, 1)::INT * 2) % 10 END)) % 10 = 0", 0.8, "card|visa|master|credit|karte|carte|tarjeta"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 10 AND 15", 0.7, "phone|tel|call|mobil|fax"),
        ("iban", r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b", "list_reduce(list_concat([0], list_transform(string_split(substr(replace(m, ' ', ''), 5) || substr(m, 1, 4), ''), lambda c: ord(c))), lambda a, c: CASE WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1", 0.8, "iban|bank|account|konto|compte|cuenta"),
        ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "NOT regexp_matches(m, '^(000|666|9)|-00-|0000$')", 0.2, "ssn|social|security|tax|sozial"),
    )
    parts = [
        f"""SELECT doc_id, '{k}' AS kind, {i} AS ord, s, s + length(m) AS e,
              round({prior} + CASE WHEN regexp_matches(lower(substr(t, greatest(s - 40, 0) + 1, length(m) + 80)), '{words}') THEN 0.3 ELSE 0 END, 2) AS score
            FROM (
              SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d,
                     (sum(length(p) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m))::BIGINT AS s
              FROM (
                SELECT doc_id, t, unnest(ms) AS m, unnest(list_slice(ps, 1, len(ms))) AS p, unnest(range(1, len(ms) + 1)) AS i
                FROM (SELECT doc_id, t, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS ps FROM docs)))
            WHERE {valid}"""
        for i, (k, p, valid, prior, words) in enumerate(kinds)
    ]
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(parts)}),
spans AS (SELECT *, concat_ws(':', kind, s, e) AS x FROM found WHERE ord < 4 OR score >= 0.5)
SELECT doc_id,
       {', '.join(f"count(x) FILTER (WHERE kind = '{k[0]}')::BIGINT AS n_{k[0]}" for k in kinds)},
       sha256(coalesce(string_agg(x, ',' ORDER BY s, ord) FILTER (WHERE ord < 4), '')) AS base_sha256,
       coalesce(string_agg(x, ',' ORDER BY s, ord), '') AS spans,
       coalesce(max(score), 0)::DOUBLE AS max_score
FROM docs LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(x) AS n, array_to_string(x, ' ') AS g FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: list_slice(w, i, i + 9))) AS x
    FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS g FROM (
    SELECT doc_id, n, w, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS p FROM dw, sizes)),
hits AS (SELECT doc_id, item_id, p, n FROM grams JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.near_dedup import near_groups

    return near_groups(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS g
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach(doc_id, r) AS (SELECT a, b FROM edges UNION SELECT reach.doc_id, e.b FROM reach JOIN edges e ON e.a = reach.r),
comp AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(r, w.doc_id)) AS component_id,
       least(w.doc_id, coalesce(r, w.doc_id)) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.topk import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.where("vec_id % 20 = 0"), vectors, 20)


OP9_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.quality import report

    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, greatest(len(w) - k + 1, 0) + 1)) AS p FROM words, range(1, 6) AS r(k))),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT * FROM f WHERE k > 1),
kept AS (
  SELECT * FROM candidates x WHERE NOT EXISTS (
    SELECT 1 FROM candidates y WHERE y.lang = x.lang AND y.k > x.k AND y.f >= x.f AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' '))),
cuts AS (
  SELECT lang, phrase, f AS a, c, array_to_string(list_slice(w, 1, c), ' ') AS head, array_to_string(list_slice(w, c + 1, k), ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM kept)),
scores AS (
  SELECT lang, phrase, a, c, l, r, n, (1000::HUGEINT * a * n) // (l::HUGEINT * r) AS score
  FROM cuts JOIN (SELECT lang, phrase AS head, f AS l FROM f) USING (lang, head) JOIN (SELECT lang, phrase AS tail, f AS r FROM f) USING (lang, tail) JOIN totals USING (lang)),
low AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_filter([
    CASE WHEN len(w) < 50 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END], lambda x: x IS NOT NULL) AS fails
  FROM words LEFT JOIN marks USING (doc_id)),
same AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, step::INT AS step, substr(filter_order, step, 1) AS l, substr(filter_order, 1, step - 1) AS before FROM orders, range(1, 6) AS r(step)),
seen AS (
  SELECT part, filter_order, step, l, n, good, toxic, list_contains(fails, l) AS own, len(fails) AS many,
         len(list_filter(fails, lambda x: contains(before, x))) > 0 AS earlier
  FROM same, steps),
told AS (
  SELECT part, filter_order, step, l,
         coalesce(sum(n) FILTER (WHERE NOT own AND NOT earlier), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE own AND NOT earlier), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE own AND earlier), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE own AND many = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE own AND NOT earlier), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE own AND NOT earlier), 0)::BIGINT AS toxic_lost
  FROM seen GROUP BY ALL)
SELECT * EXCLUDE (l), (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley FROM told
"""


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundlake.llm.secret_scan import report

    return report(table(spark, sf_dir, "documents"))


def _matches(kind: str, order: int, pattern: str) -> str:
    """Matches m of a pattern in docs (doc_id, t), with the code point s at which each begins."""
    return f"""SELECT doc_id, '{kind}' AS kind, {order} AS ord, m, (sum(length(p) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m))::BIGINT AS s
      FROM (
        SELECT doc_id, unnest(ms) AS m, unnest(list_slice(ps, 1, len(ms))) AS p, unnest(range(1, len(ms) + 1)) AS i
        FROM (SELECT doc_id, regexp_extract_all(t, $${pattern}$$) AS ms, string_split_regex(t, $${pattern}$$) AS ps FROM docs))"""


def _der(at: str, h: str = "h") -> dict[str, str]:
    """Tag, first place of the contents and place after them of the DER element at a place of a hex string; null if it has no definite length."""
    byte = f"try_cast('0x' || substr({h}, {at} + 2, 2) AS INT)"
    many = f"(CASE WHEN {byte} < 128 THEN 0 WHEN {byte} BETWEEN 129 AND 132 THEN {byte} - 128 END)"
    size = f"(CASE WHEN {byte} < 128 THEN {byte} ELSE try_cast('0x' || substr({h}, {at} + 4, 2 * {many}) AS BIGINT) END)"
    return {"tag": f"substr({h}, {at}, 2)", "start": f"({at} + 4 + 2 * {many})", "end": f"({at} + 4 + 2 * {many} + 2 * {size})"}


def _secret_sql() -> str:
    """Patterns by regular expressions, tokens by JSON functions, keys by a recursive walk over the hex form of their bytes."""
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    names = "|".join(either(w) for w in ("password", "passwd", "secret", "token")) + f"|{either('api')}_?{either('key')}"
    assign = rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    token = r"(^|[^A-Za-z0-9_.-])(e[w-z0-9_-][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*)"
    lines = r"(?:\r?\n[A-Za-z0-9+/]+)*"
    der64 = rf"(^|[^A-Za-z0-9+/])(M[A-P][A-Za-z0-9+/]{{14,}}{lines})"
    ssh64 = rf"(^|[^A-Za-z0-9+/])(b3BlbnNzaC1rZXktdjEA[A-Za-z0-9+/]+{lines})"
    hexed = r"(^|[^0-9A-Fa-f])((?:30|6[Ff]70656[Ee]7373682[Dd]6[Bb]65792[Dd]763100)[0-9A-Fa-f]{16,})"
    json = lambda i: f"try(decode(from_base64(rpad(translate(w[{i}], '-_', '+/'), ((length(w[{i}]) + 3) // 4 * 4)::INT, '='))))"
    outer, member = _der("1"), _der("pos")
    field = lambda at: f"try_cast('0x' || substr(h, {at}, 8) AS BIGINT)"
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(_matches(*x) for x in (("assign", 0, assign), ("access", 1, "AKIA[A-Z0-9]+"), ("hex", 2, "[0-9a-f]+"), ("jwt", 3, token), ("der64", 4, der64), ("ssh64", 4, ssh64), ("hexed", 4, hexed)))}),
own AS (
  SELECT * EXCLUDE (s, m), s + CASE WHEN ord > 2 THEN length(m) - length(run) ELSE 0 END AS s, run
  FROM (SELECT *, CASE ord WHEN 0 THEN m WHEN 1 THEN m WHEN 2 THEN m WHEN 3 THEN regexp_extract(m, $${token}$$, 2)
                  ELSE CASE kind WHEN 'der64' THEN regexp_extract(m, $${der64}$$, 2) WHEN 'ssh64' THEN regexp_extract(m, $${ssh64}$$, 2) ELSE regexp_extract(m, $${hexed}$$, 2) END END AS run FROM raw)),
tokens AS (
  SELECT doc_id, s, run, w[3] AS mark, {json(1)} AS head, {json(2)} AS claims FROM (SELECT *, string_split(run, '.') AS w FROM own WHERE ord = 3)),
jwt AS (
  SELECT doc_id, s, run FROM tokens
  WHERE json_valid(head) AND json_valid(claims)
    AND CASE WHEN json_valid(head) THEN json_type(head) = 'OBJECT' AND coalesce(json_type(head, '$.alg') = 'VARCHAR', false) END
    AND CASE WHEN json_valid(claims) THEN json_type(claims) = 'OBJECT' END
    AND (mark <> '' OR CASE WHEN json_valid(head) THEN lower(json_extract_string(head, '$.alg')) = 'none' END)),
runs AS (
  SELECT row_number() OVER () AS id, doc_id, s, run, kind,
         CASE WHEN kind = 'hexed' THEN lower(substr(run, 1, length(run) // 2 * 2))
              ELSE lower(hex(try(from_base64(rpad(substr(b, 1, length(b) - CASE WHEN length(b) % 4 = 1 THEN 1 ELSE 0 END), ((length(b) - CASE WHEN length(b) % 4 = 1 THEN 1 ELSE 0 END + 3) // 4 * 4)::INT, '='))))) END AS h
  FROM (SELECT *, regexp_replace(run, '[\r\n]', '', 'g') AS b FROM own WHERE ord = 4)),
walk(id, h, pos, fin, ms) AS (
  SELECT id, h, pos, fin, [] :: STRUCT(tag VARCHAR, a BIGINT, z BIGINT)[] FROM (SELECT id, h, {outer['start']}::BIGINT AS pos, {outer['end']}::BIGINT AS fin, {outer['tag']} AS tag FROM runs)
  WHERE tag = '30' AND fin <= length(h) + 1
  UNION ALL
  SELECT id, h, next, fin, list_append(ms, struct_pack(tag := tag, a := start, z := next))
  FROM (SELECT id, h, fin, ms, {member['tag']} AS tag, {member['start']}::BIGINT AS start, {member['end']}::BIGINT AS next FROM walk WHERE pos < fin AND len(ms) < 16 AND pos + 4 <= fin)
  WHERE next <= fin),
spelt AS (
  SELECT id, h, fin, list_transform(ms, lambda m: [m.a, m.z]) AS ms, array_to_string(list_transform(ms, lambda m: m.tag), '') AS tags FROM walk WHERE pos = fin),
der AS (
  SELECT id, (fin - 1) // 2 AS size
  FROM (SELECT *, CASE WHEN starts_with(tags, '30') THEN 1 ELSE 2 END AS i FROM spelt WHERE regexp_full_match(tags, '(02){{9}}|(02){{6}}|0204(a0)?(a1)?|023004(a0)?(81|a1)?|3004'))
  WHERE (NOT starts_with(tags, '02') OR substr(h, ms[1][1], ms[1][2] - ms[1][1]) IN ('00', '01'))
    AND (NOT starts_with(tags, '0204') OR ms[2][2] - ms[2][1] >= 32)
    AND (NOT contains(tags, '30') OR coalesce(substr(h, ms[i][1], 2) = '06' AND {_der("ms[i][1]")['end']} <= ms[i][2], false))
    AND (tags <> '3004' OR regexp_matches(substr(h, {_der("ms[1][1]")['start']}, {_der("ms[1][1]")['end']} - {_der("ms[1][1]")['start']}), '^2a864886f70d01(05|0c01)'))),
ssh0 AS (SELECT id, h, 31 AS p FROM runs WHERE starts_with(h, '6f70656e7373682d6b65792d763100')),
ssh1 AS (SELECT id, h, p + 8 + 2 * {field('p')} AS p FROM ssh0 WHERE {field('p')} > 0),
ssh2 AS (SELECT id, h, p + 8 + 2 * {field('p')} AS p FROM ssh1 WHERE {field('p')} > 0),
ssh3 AS (SELECT id, h, p + 8 + 2 * {field('p')} AS p FROM ssh2 WHERE length(substr(h, p, 8)) = 8),
ssh4 AS (SELECT id, h, p + 16 + 2 * {field('p + 8')} AS p FROM ssh3 WHERE substr(h, p, 8) = '00000001' AND {field('p + 8')} > 0),
ssh AS (SELECT id, (p + 7 + 2 * {field('p')}) // 2 AS size FROM ssh4 WHERE length(substr(h, p, 8)) = 8 AND {field('p')} > 0 AND p + 7 + 2 * {field('p')} <= length(h)),
keys AS (
  SELECT doc_id, s, CASE WHEN kind = 'hexed' THEN 2 * size
    ELSE list_filter(range(1, length(run) + 1), lambda i: substr(run, i, 1) NOT IN (chr(10), chr(13)))[(size * 4 + 2) // 3] END AS n
  FROM runs JOIN (SELECT * FROM der UNION ALL SELECT * FROM ssh) USING (id)),
spans AS (
  SELECT doc_id, kind, ord, s, s + length(run) AS e, concat_ws(':', kind, s, s + length(run)) AS x FROM own
  WHERE (ord = 0 AND length(regexp_extract(run, $${assign}$$, 2)) >= 6) OR (ord = 1 AND length(run) >= 20) OR (ord = 2 AND length(run) >= 24)
  UNION ALL SELECT doc_id, 'jwt', 3, s, s + length(run), concat_ws(':', 'jwt', s, s + length(run)) FROM jwt
  UNION ALL SELECT doc_id, 'key', 4, s, s + n, concat_ws(':', 'key', s, s + n) FROM keys)
SELECT doc_id,
       count(x) FILTER (WHERE ord = 0)::BIGINT AS n_assign, count(x) FILTER (WHERE ord = 1)::BIGINT AS n_access, count(x) FILTER (WHERE ord = 2)::BIGINT AS n_hex,
       sha256(coalesce(string_agg(x, ',' ORDER BY s, ord) FILTER (WHERE ord < 3), '')) AS base_sha256,
       coalesce(string_agg(x, ',' ORDER BY s, ord), '') AS spans,
       count(x) FILTER (WHERE ord = 3)::BIGINT AS n_jwt, count(x) FILTER (WHERE ord = 4)::BIGINT AS n_key
FROM docs LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""


def _tidy(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query in a scope of its own: a call deletes the intermediate tables of the call before."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from fundlake.llm.scratch import scoped

        with scoped(spark, query.__name__):
            return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_substring_dedup, op2_chat_format, op3_ctw_score, op4_mix_sources, op5_pii, op6_decontaminate, op7_line_dedup, op8_near_dedup, op9_top_k, op10_quality, op11_collocations, op12_filter_audit, op13_secret_scan)
    return {f.__name__: _tidy(f) for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1_SQL,
        "op5_pii": _pii_sql(),
        "op6_decontaminate": OP6_SQL,
        "op7_line_dedup": OP7_SQL,
        "op8_near_dedup": OP8_SQL,
        "op9_top_k": OP9_SQL,
        "op11_collocations": OP11_SQL,
        "op12_filter_audit": OP12_SQL,
        "op13_secret_scan": _secret_sql(),
    }
