"""Scalar functions, filters and name rules, one column an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions import dates, names, variants
from fundlake.functions import numbers as N
from fundlake.functions import text as X
from fundlake.plans import export
from fundlake.plans.registry import Tables, query

K = "c_custkey"
_RAW = f"concat('  Fonds ', c_name, ' (oud): a_b, é-', CAST({K} % 7 AS STRING), '  | x ')"


@query(f"""SELECT {K}, lower(t) AS low, trim(t) AS stripped, replace(t, '#', '-') AS replaced, '  Fonds ' || c_name || ' (Oud): A_B, É-' || ({K} % 7) || '  | X ' AS title, starts_with(trim(t), 'Fonds') AS starts,
trim(split_part(t, '(', 1)) AS before_bracket, substr(t, strpos(t, ':') + 1) AS after_colon, split_part(trim(t), ' ', -1) AS last_word, array_to_string(string_split(t, ' '), '_') AS joined, substr(t, 1, 10) AS cut
FROM (SELECT {K}, c_name, {_RAW} AS t FROM customer)""")
def q_text_parts(t: Tables) -> DataFrame:
    """STR-01, STR-02, STR-03, STR-04: case, ends, replacement, parts, joining, cutting."""
    c = F.col("t")
    words = F.split(X.strip(c), " ")
    return t.customer.select(K, F.expr(_RAW).alias("t")).select(
        K, F.lower(c).alias("low"), X.strip(c).alias("stripped"), F.replace(c, F.lit("#"), F.lit("-")).alias("replaced"), X.title_case(c).alias("title"), X.strip(c).startswith("Fonds").alias("starts"),
        X.strip(F.split_part(c, F.lit("("), F.lit(1))).alias("before_bracket"), F.get(F.split(c, ":", 2), 1).alias("after_colon"), F.element_at(words, -1).alias("last_word"), F.array_join(F.split(c, " "), "_").alias("joined"), F.substring(c, 1, 10).alias("cut"),
    )


@query(f"""SELECT {K}, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS collapsed, regexp_replace(t, '[^\\p{{L}}\\p{{N}} _-]', '', 'g') AS kept, regexp_replace(t, '[^a-zA-Z0-9\\s]', '', 'g') AS plain,
regexp_extract(t, '#(\\d+)', 1) AS grp, array_to_string(regexp_extract_all(t, '[0-9]+'), ',') AS numbers, len(string_split_regex(t, '[,:|]'))::INTEGER AS parts,
((length(t) - length(replace(t, '(oud)', ''))) / 5)::INTEGER AS literal_hits, contains(t, '3') OR contains(t, 'zz') AS any_word, contains(t, 'Fonds') AND contains(t, '3') AS all_words, regexp_matches(t, '[0-9]') AS has_digit, replace(t, '|', '') AS cell
FROM (SELECT {K}, {_RAW} AS t FROM customer)""")
def q_text_patterns(t: Tables) -> DataFrame:
    """STR-05, STR-06, STR-07, STR-08, STR-09, STR-10, STR-11, STR-13, STR-14, STR-16."""
    c = F.col("t")
    return t.customer.select(K, F.expr(_RAW).alias("t")).select(
        K, X.squeeze(c).alias("collapsed"), F.regexp_replace(c, r"[^\p{L}\p{N} _-]", "").alias("kept"), F.regexp_replace(c, r"[^a-zA-Z0-9\s]", "").alias("plain"),
        X.group(c, r"#(\d+)").alias("grp"), F.array_join(X.groups(c, r"([0-9]+)"), ",").alias("numbers"), F.size(F.split(c, "[,:|]")).alias("parts"),
        F.regexp_count(c, F.lit(X.quote("(oud)"))).alias("literal_hits"), X.contains_any(c, ("3", "zz")).alias("any_word"), (c.contains("Fonds") & c.contains("3")).alias("all_words"), c.rlike(r"\d").alias("has_digit"), F.replace(c, F.lit("|"), F.lit("")).alias("cell"),
    )


def _n(e: str) -> str:
    return f"CAST({e} AS STRING)"


@query(f"""SELECT {K}, TRY_CAST(concat({K} % 90, '.', 10 + {K} % 80) AS DOUBLE) AS cost, CASE WHEN {K} % 4 = 0 THEN NULL ELSE {K} % 50 + 0.5::DOUBLE END AS first_decimal, TRY_CAST(concat('-', {K} % 30, '.2') AS DOUBLE) AS signed,
CASE WHEN {K} % 300 BETWEEN 60 AND 250 THEN ({K} % 300)::DOUBLE END AS coverage,
CASE {K} % 4 WHEN 0 THEN ({K} * 0.5)::DOUBLE WHEN 1 THEN ({K} * 0.5)::DOUBLE / 1000 ELSE CASE WHEN {K} * 0.5 > 100 THEN ({K} * 0.5)::DOUBLE / 1000 ELSE ({K} * 0.5)::DOUBLE END END AS billions,
({K} % 40 + 0.25)::DOUBLE AS cell, ({K} * 1000 + {K} % 1000)::BIGINT AS last_token FROM customer""")
def q_number_rules(t: Tables) -> DataFrame:
    """NUM-07, NUM-08, NUM-09, NUM-10, NUM-11, NUM-16, NUM-17."""
    unit = F.expr(f"CASE {K} % 4 WHEN 0 THEN 'Miljard' WHEN 1 THEN 'mln' END")
    return t.customer.select(
        K,
        N.cost(F.expr(f"concat({_n(K + ' % 90')}, ',', {_n('10 + ' + K + ' % 80')}, '%')")).alias("cost"),
        N.first_decimal(F.expr(f"CASE WHEN {K} % 4 = 0 THEN ' None ' ELSE concat('ca. ', {_n(K)}, ' of ', {_n(K + ' % 50')}, ',5 pct') END")).alias("first_decimal"),
        N.signed(F.expr(f"concat('rendement -', {_n(K + ' % 30')}, ',2%')")).alias("signed"),
        N.coverage(F.expr(f"concat({_n(K + ' % 300')}, '%')")).alias("coverage"),
        N.billions(F.col(K) * 0.5, unit).alias("billions"),
        N.cost(F.expr(f"concat({_n(K + ' % 40')}, ',25%')")).alias("cell"),
        N.last_token(F.expr(f"concat('Totaal deelnemers ', {_n(K)}, '.', lpad({_n(K + ' % 1000')}, 3, '0'))")).alias("last_token"),
    )


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS day, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE)::VARCHAR ELSE '2024-01-02' END AS token,
CASE WHEN o_orderkey % 2 = 0 THEN (1 + o_orderkey % 28) || '-apr-26' END AS leading, true AS past FROM orders""")
def q_date_rules(t: Tables) -> DataFrame:
    """DAT-02, DAT-03, DAT-04, DAT-06."""
    day = F.to_date("o_orderdate")
    stamp = F.when(F.col("o_orderkey") % 3 == 0, F.concat(day.cast("string"), F.lit(" 10:11:12")))
    line = F.expr("CASE WHEN o_orderkey % 2 = 0 THEN concat(CAST(1 + o_orderkey % 28 AS STRING), '-Apr-26 Fonds') ELSE 'Fonds 1-apr-26' END")
    return t.orders.select("o_orderkey", day.cast("string").alias("day"), dates.date_token(stamp, F.lit("2024-01-02 09:00")).alias("token"), dates.leading_date(line).alias("leading"), (F.current_timestamp() > F.col("o_orderdate").cast("timestamp")).alias("past"))


_SITE = f"concat(CASE {K} % 3 WHEN 0 THEN 'https://' WHEN 1 THEN 'http://' ELSE '' END, 'www.fonds', CAST({K} AS STRING), '.nl/a/b/', CASE WHEN {K} % 2 = 0 THEN '#top' ELSE '' END)"


@query(f"""SELECT {K}, CASE WHEN {K} % 3 = 2 THEN 'https://' || u ELSE u END AS full_url, replace(url_encode('fonds ' || c_name), '%20', '+') AS form, url_encode('fonds ' || c_name) AS quoted,
regexp_replace(regexp_replace(u, '#.*$', ''), '/$', '') AS bare, {K} % 3 <> 2 AS same_site, '/?fund=' || url_encode(c_name) AS link FROM (SELECT {K}, c_name, {_SITE} AS u FROM customer)""")
def q_url_rules(t: Tables) -> DataFrame:
    """URL-02, URL-03, URL-04, URL-05, PRJ-06."""
    u, name = F.col("u"), F.concat(F.lit("fonds "), "c_name")
    rows = t.customer.select(K, "c_name", F.expr(_SITE).alias("u"))
    bare = F.regexp_replace(F.regexp_replace(u, "#.*$", ""), "/$", "")
    return rows.select(K, names.with_scheme(u).alias("full_url"), F.url_encode(name).alias("form"), F.replace(F.url_encode(name), F.lit("+"), F.lit("%20")).alias("quoted"), bare.alias("bare"), names.host(u).contains(F.concat(F.lit("fonds"), F.col(K).cast("string"))).alias("same_site"), export.fund_link(F.col("c_name")).alias("link"))


_WEB = f"CASE {K} % 6 WHEN 1 THEN '' WHEN 2 THEN 'None' WHEN 3 THEN ' NaN ' WHEN 4 THEN concat('https://linkedin.com/', CAST({K} AS STRING)) WHEN 5 THEN concat('https://fonds', CAST({K} AS STRING), '.nl') END"


@query(f"""SELECT {K}, {K} % 6 = 0 AS is_null, {K} % 6 <> 0 AS not_null, {K} % 6 < 2 AS empty, {K} % 6 > 2 AS website, {K} % 6 < 4 AS blank, coalesce({K} % 6 = 5, false) AS own_site FROM customer""")
def q_blank_rules(t: Tables) -> DataFrame:
    """FLT-01, FLT-02, FLT-03, FLT-16, FLT-19."""
    w = F.col("w")
    rows = t.customer.select(K, F.expr(_WEB).alias("w"))
    own = F.coalesce(names.has_website(w) & ~names.blank(w) & ~w.contains("linkedin"), F.lit(False))
    return rows.select(K, w.isNull().alias("is_null"), w.isNotNull().alias("not_null"), (w.isNull() | (w == "")).alias("empty"), names.has_website(w).alias("website"), names.blank(w).alias("blank"), own.alias("own_site"))


@query("SELECT page_id, lower(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title FROM pages WHERE regexp_matches(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), 'the|und|que') AND NOT regexp_matches(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), 'dear|[$]')")
def q_title_filter(t: Tables) -> DataFrame:
    """FLT-10: words that a title must and must not have."""
    low = F.lower(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    return t.pages.where(X.contains_any(low, ("the", "und", "que")) & ~X.contains_any(low, ("dear", "$"))).select("page_id", low.alias("title"))


@query(f"SELECT {K}, c_acctbal FROM customer WHERE c_nationkey = 7")
def q_by_parameter(t: Tables) -> DataFrame:
    """FLT-11, SRC-02: a named parameter, never a pasted value."""
    return t.spark.sql(f"SELECT {K}, c_acctbal FROM {{c}} WHERE c_nationkey = :nation", args={"nation": 7}, c=t.customer)


_HOLE = f"SELECT {K}, CASE WHEN {K} % 3 = 0 THEN NULL ELSE c_acctbal END AS aum, CASE WHEN {K} % 4 = 0 THEN NULL ELSE {K} % 200 END AS ratio, c_mktsegment AS category FROM customer"


@query(f"SELECT aum, ratio, category FROM ({_HOLE}) WHERE aum IS NOT NULL AND ratio IS NOT NULL")
def q_scatter(t: Tables) -> DataFrame:
    """FLT-13, VIZ-01: rows that have both coordinates."""
    rows = t.customer.selectExpr(K, f"CASE WHEN {K} % 3 = 0 THEN NULL ELSE c_acctbal END AS aum", f"CASE WHEN {K} % 4 = 0 THEN NULL ELSE {K} % 200 END AS ratio", "c_mktsegment AS category")
    return export.scatter(rows, "aum", "ratio", "category")


@query("SELECT c_mktsegment AS value, count(*) AS n FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1")
def q_pie(t: Tables) -> DataFrame:
    """VIZ-02: shares of a column's values without nulls."""
    return export.pie(t.customer.select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg")), "seg")


@query(f"SELECT {K}, floor(log10(abs(c_acctbal) + 1) * 1000)::BIGINT AS tick, CASE WHEN c_acctbal > 0 THEN true ELSE false END AS shown FROM customer")
def q_log_axis(t: Tables) -> DataFrame:
    """MATH-07: places on a logarithmic axis; what is not above 0 has none."""
    return t.customer.select(K, F.floor(F.log10(F.abs("c_acctbal") + 1) * 1000).alias("tick"), (F.col("c_acctbal") > 0).alias("shown"))


_LABEL = f"CASE {K} % 4 WHEN 0 THEN concat('Stichting Pensioenfonds ', c_name, ' (oud) (gesloten)') WHEN 1 THEN concat('Pensioenfonds ', c_name) WHEN 2 THEN concat('Bpf ', c_name, ' kring 2') ELSE concat('IFF ', c_name) END"
_OWN, _FROM, _NEW = f"CASE {K} % 3 WHEN 0 THEN NULL WHEN 1 THEN 'nan' ELSE 'Eigen' END", f"CASE WHEN {K} % 5 = 0 THEN 'DNB Appendix' ELSE 'site' END", f"CASE {K} % 4 WHEN 0 THEN 'bedrijfstak' WHEN 1 THEN 'Algemeen' WHEN 2 THEN 'nan' ELSE 'Anders' END"


@query(f"""SELECT {K}, CASE {K} % 4 WHEN 0 THEN c_name WHEN 1 THEN c_name WHEN 2 THEN 'Bpf ' || c_name || ' kring 2' ELSE 'IFF ' || c_name END AS short,
CASE {K} % 4 WHEN 2 THEN 'APF' WHEN 3 THEN 'Bedrijf' END AS guessed, CASE {K} % 4 WHEN 0 THEN c_name || ' (oud) (gesloten)' WHEN 1 THEN c_name ELSE l END AS searched,
CASE WHEN {K} % 4 <> 2 AND ({K} % 3 < 2 OR {K} % 5 = 0) THEN CASE {K} % 4 WHEN 0 THEN 'Bedrijfstakpensioenfonds' WHEN 1 THEN 'APF' ELSE 'Anders' END ELSE {_OWN} END AS imported FROM (SELECT {K}, c_name, {_LABEL} AS l FROM customer)""")
def q_name_rules(t: Tables) -> DataFrame:
    """PRJ-10, NRM-03, NRM-05, NRM-06."""
    name = F.expr(_LABEL)
    searched = F.replace(F.replace(name, F.lit("Stichting "), F.lit("")), F.lit("Pensioenfonds "), F.lit(""))
    return t.customer.select(K, names.short_label(name).alias("short"), names.guessed_category(name).alias("guessed"), searched.alias("searched"), names.imported_category(F.expr(_OWN), F.expr(_FROM), F.expr(_NEW)).alias("imported"))


@query(f"SELECT {K}, x.n::INTEGER AS n, x.name AS name FROM (SELECT {K}, unnest([{{'n': 1, 'name': 'a' || {K}}}, {{'n': 2, 'name': 'b'}}]) AS x FROM customer)")
def q_json_lists(t: Tables) -> DataFrame:
    """JSN-03, SRC-30, SRC-31, UDF-04: a reply in a code fence, its nested list as rows."""
    from fundlake.sources import documents as D

    reply = F.concat(F.lit('```json\n{"value": [{"n": 1, "name": "a'), F.col(K).cast("string"), F.lit('"}, {"n": 2, "name": "b"}]}\n```'))
    parsed = D.parse_reply(reply, "value array<struct<n: int, name: string>>")
    return t.customer.select(K, F.explode(parsed["value"]).alias("x")).select(K, "x.n", "x.name")


@query(f"SELECT {K}, CASE {K} % 3 WHEN 0 THEN 'Global,a,b' WHEN 1 THEN 'a,b' ELSE 'b' END AS list, CASE WHEN {K} % 2 = 0 THEN 3 ELSE 0 END::INTEGER AS got, CASE WHEN {K} % 3 = 2 THEN 'Other' ELSE 'Pacific' END AS key, CASE WHEN {K} % 3 = 0 THEN 'a' ELSE 'none' END AS first_hit FROM customer")
def q_list_rules(t: Tables) -> DataFrame:
    """ARR-02, ARR-03, ARR-04, ARR-06: insert at the head, look up with a default, rename a key, first or a default."""
    k = F.col(K)
    base = F.when(k % 3 == 2, F.array(F.lit("b"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    led = F.when(k % 3 == 0, F.array_prepend(base, F.lit("Global"))).otherwise(base)
    held = F.create_map(F.lit(0), F.lit(3))
    key = F.create_map(F.when(k % 3 == 2, "Pacific/Other").otherwise("Pacific"), F.lit(1))
    renamed = F.get(F.map_keys(F.transform_keys(key, lambda a, _: F.when(a == "Pacific/Other", "Other").otherwise(a))), 0)
    return t.customer.select(K, F.array_join(led, ",").alias("list"), F.coalesce(F.try_element_at(held, (k % 2).cast("int")), F.lit(0)).alias("got"), renamed.alias("key"), F.coalesce(X.first_where(led, lambda x: (x == "a") & (k % 3 == 0)), F.lit("none")).alias("first_hit"))


@query(f"SELECT {K}, length(c_name)::INTEGER AS n, upper(c_mktsegment) AS seg FROM customer")
def q_row_functions(t: Tables) -> DataFrame:
    """UDF-01, UDF-02: what ran by row in a lambda, or by file in a process pool, is a Column expression on all cores."""
    return t.customer.select(K, F.length("c_name").alias("n"), F.upper("c_mktsegment").alias("seg"))


# Replies of a service: nested, in a fence, broken, a list, or with values of another type.
_REPLIES = """CASE event_id % 6 WHEN 0 THEN concat('```json\n{"fund": {"id": ', event_id, ', "name": "Fonds ', event_id, '", "values": [{"y": 2023, "v": 1.5}, {"y": 2024, "v": "n.v.t."}, {"y": ', event_id, '}]}}\n```')
  WHEN 1 THEN concat('{"fund": {"id": "', event_id, '", "values": []}}') WHEN 2 THEN '{"fund": {"id":' WHEN 3 THEN concat('[{"id": ', event_id, '}]') WHEN 4 THEN concat('  {"fund": {"id": null, "values": [{"y": 1, "v": ', event_id, '.25}]}}') END"""
_REPLY = f"SELECT event_id, try_cast(trim(regexp_replace(r, '```(json)?', '', 'g'), chr(32) || chr(10)) AS JSON) AS j FROM (SELECT event_id, {_REPLIES.replace('concat(', 'concat(').replace(chr(92) + 'n', chr(10))} AS r FROM events)"


@query(f"SELECT event_id, j IS NOT NULL AS valid, TRY_CAST(json_extract_string(j, '$.fund.id') AS BIGINT) AS id, json_extract_string(j, '$.fund.name') AS name, json_extract_string(j, '$.fund.values[1].v') AS second FROM ({_REPLY})")
def q_variant_fields(t: Tables) -> DataFrame:
    """JSN-01, JSN-02, SRC-31: fields of replies of unknown shape, by path and type."""
    v = variants.reply(F.expr(_REPLIES))
    rows = t.events.select("event_id", v.alias("v"))
    return rows.select("event_id", F.col("v").isNotNull().alias("valid"), variants.field(F.col("v"), "$.fund.id", "long").alias("id"), variants.field(F.col("v"), "$.fund.name").alias("name"), variants.field(F.col("v"), "$.fund.values[1].v").alias("second"))


@query(f"""SELECT event_id, i::INTEGER AS pos, TRY_CAST(json_extract_string(j, '$.fund.values[' || i || '].y') AS BIGINT) AS year, TRY_CAST(json_extract_string(j, '$.fund.values[' || i || '].v') AS DOUBLE) AS value
FROM ({_REPLY}), range(0, 3) r(i) WHERE i < json_array_length(j, '$.fund.values')""")
def q_variant_entries(t: Tables) -> DataFrame:
    """JSN-03, SRC-30: the entries of a list within each reply."""
    rows = t.events.select("event_id", variants.reply(F.expr(_REPLIES)).alias("v"))
    return variants.entries(rows, "v", "$.fund.values").select("event_id", "pos", variants.field(F.col("value"), "$.y", "long").alias("year"), variants.field(F.col("value"), "$.v", "double").alias("value"))
