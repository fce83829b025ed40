"""Queries on text: numbers, dates, names, extractors, links. Report text is made up inside each query, alike in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions import dates, names
from fundlake.functions import numbers as N
from fundlake.functions.text import count_words, group
from fundlake.operators import extract as X
from fundlake.operators import regions as R
from fundlake.operators import resolve
from fundlake.plans.registry import Tables, query
from fundlake.sources import documents as D
from fundlake.sources import html


def _s(e: str) -> str:
    return f"CAST({e} AS STRING)"


K = "p_partkey"
PCT = r"(\d{1,2}(?:[.,]\d{1,2})?)\s*%"


def _report(t: Tables, text: str) -> DataFrame:
    return t.part.select(K, F.expr(text).alias("t"))


def _first(values: str, low: float, high: float, sign: str = ">=") -> str:
    return f"list_filter(list_transform({values}, lambda x: TRY_CAST(replace(x, ',', '.') AS DOUBLE)), lambda v: v {sign} {low} AND v <= {high})[1]"


_EQUITY = f"concat('fonds ', {_s(K)}, ': aandelen ', CASE WHEN {K} % 7 = 0 THEN '0% en ' ELSE '' END, {_s(K + ' % 120')}, ',5 % en zakelijke waarden ', {_s(K + ' % 97')}, '.25%')"


@query(f"SELECT {K}, coalesce({_first(f"regexp_extract_all(substr(t, strpos(t, 'aandelen') + 8, 500), '{PCT}', 1)", 0, 100, '>')}, {_first(f"regexp_extract_all(substr(t, strpos(t, 'zakelijke waarden') + 17, 500), '{PCT}', 1)", 0, 100, '>')}) AS pct FROM (SELECT {K}, {_EQUITY} AS t FROM part)")
def q_first_pct(t: Tables) -> DataFrame:
    """EX-01."""
    return _report(t, _EQUITY).select(K, X.equity_share(F.col("t")).alias("pct"))


_PATTERNED = f"concat(CASE {K} % 5 WHEN 0 THEN concat({_s(K + ' % 99')}, '% in aandelen') WHEN 1 THEN concat('zakelijke waarden: ', {_s(K + ' % 99')}, ',5%') WHEN 2 THEN concat('aandelenportefeuille van ', {_s(K + ' % 99')}, '%') WHEN 3 THEN concat('strategische allocatie naar aandelen is ', {_s(K + ' % 99')}, '%') ELSE concat('aandelen | ', {_s(K + ' % 99')}, ',25 %') END, ' van het vermogen')"
_P = (rf"{PCT}\s*(?:in\s+)?(?:aandelen|zakelijke waarden)", rf"(?:aandelen|zakelijke waarden)[:\s]+{PCT}", rf"aandelenportefeuille\s+van\s+{PCT}", rf"strategische allocatie[^\d]{{0,50}}?aandelen[^\d]{{0,20}}?{PCT}", rf"aandelen[^\d\n%]{{0,30}}{PCT}")


@query(f"SELECT {K}, coalesce({', '.join(_first(f"regexp_extract_all(t, '{p}', 1)", 5, 95) for p in _P)}) AS pct FROM (SELECT {K}, {_PATTERNED} AS t FROM part)")
def q_pct_priority(t: Tables) -> DataFrame:
    """EX-02."""
    return _report(t, _PATTERNED).select(K, X.equity_share_patterned(F.col("t")).alias("pct"))


_COVERAGE = f"concat('de actuele dekkingsgraad was ', {_s(K + ' % 300')}, ',3% en de beleidsdekkingsgraad ', {_s('40 + ' + K + ' % 150')}, ' %; vereiste dekkingsgraad 115,2%')"


def _ratio(label: str) -> str:
    v = f"TRY_CAST(trim(replace(replace(nullif(regexp_extract(t, '(?:{label}).{{0,150}}?(\\d{{2,3}}(?:[.,]\\d)?\\s*%)', 1), ''), '%', ''), ',', '.')) AS DOUBLE)"
    return f"CASE WHEN {v} BETWEEN 60 AND 250 THEN {v} END"


@query(f"SELECT {K}, {', '.join(f'{_ratio(label)} AS {c}' for c, label in X.COVERAGE.items())} FROM (SELECT {K}, {_COVERAGE} AS t FROM part)")
def q_bounded_number(t: Tables) -> DataFrame:
    """EX-12: the first match decides, in bounds or not."""
    return _report(t, _COVERAGE).select(K, *[X.coverage_ratio(F.col("t"), label).alias(c) for c, label in X.COVERAGE.items()])


_NUMBER = f"CASE {K} % 8 WHEN 0 THEN concat({_s(K)}, '.234,5') WHEN 1 THEN concat({_s(K)}, ',234.5') WHEN 2 THEN concat({_s(K)}, '.250') WHEN 3 THEN concat({_s(K)}, ',5') WHEN 4 THEN concat({_s(K)}, ',345') WHEN 5 THEN concat({_s(K)}, '.1') WHEN 6 THEN {_s(K)} ELSE 'onbekend' END"
_LATER = "(length(s) - length(regexp_replace(s, '^.*,', '')) > length(s) - length(regexp_replace(s, '^.*\\.', '')))"
_NUM3 = f"TRY_CAST(CASE WHEN s LIKE '%,%' AND s LIKE '%.%' THEN CASE WHEN {_LATER} THEN replace(replace(s, '.', ''), ',', '.') ELSE replace(s, ',', '') END WHEN s LIKE '%,%' THEN CASE WHEN s LIKE '%,___' THEN replace(s, ',', '') ELSE replace(s, ',', '.') END WHEN s LIKE '%.%' AND s LIKE '%.___' THEN replace(s, '.', '') ELSE s END AS DOUBLE)"
_N4 = "TRY_CAST(replace(replace(s, '.', ''), ' ', '') AS BIGINT)"


@query(f"SELECT {K}, TRY_CAST(replace(s, ',', '.') AS DOUBLE) AS n1, TRY_CAST(replace(replace(s, '.', ''), ',', '.') AS DOUBLE) AS n2, {_NUM3} AS n3, CASE WHEN s NOT LIKE '%,%' AND {_N4} >= 10 AND {_N4} NOT BETWEEN 2010 AND 2030 THEN {_N4} END AS n4 FROM (SELECT {K}, {_NUMBER} AS s FROM part)")
def q_dutch_number(t: Tables) -> DataFrame:
    """NUM-01 to NUM-04."""
    s = F.col("t")
    return _report(t, _NUMBER).select(K, N.comma_decimal(s).alias("n1"), N.dotted_thousands(s).alias("n2"), N.dutch_number(s).alias("n3"), N.count(s).alias("n4"))


@query("SELECT o_orderkey, round_even(CASE WHEN v > 1e6 THEN v / 1e6 WHEN v > 1e3 THEN v / 1e3 ELSE v END, CASE WHEN v > 1e3 THEN 2 ELSE 10 END) AS millions, CASE WHEN v BETWEEN 2010 AND 2030 THEN NULL WHEN v < 100 THEN v WHEN v > 1e5 THEN v / 1e6 ELSE v / 1e3 END AS cost FROM (SELECT o_orderkey, floor(o_totalprice * CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0.001 END) * 10 + 3 AS v FROM orders)")
def q_magnitudes(t: Tables) -> DataFrame:
    """NUM-12, NUM-13."""
    v = (F.floor(F.col("o_totalprice") * F.when(F.col("o_orderkey") % 2 == 0, 1.0).otherwise(0.001)) * 10 + 3).cast("double")
    return t.orders.select("o_orderkey", N.millions(v).alias("millions"), N.total_cost(v).alias("cost"))


_MONTH = "CASE month(o_orderdate) " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(dates.MONTHS, 1)) + " END"
_DATE = f"CASE o_orderkey % 4 WHEN 0 THEN concat('202', {_s('o_orderkey % 10')}, '-0', {_s('1 + o_orderkey % 9')}, '-1', {_s('o_orderkey % 10')}) WHEN 1 THEN 'onbekend' ELSE concat({_s('day(o_orderdate)')}, ' ', {_MONTH}, ' ', {_s('year(o_orderdate)')}) END"


@query(f"SELECT o_orderkey, CAST(CASE WHEN d LIKE '202%-%' THEN TRY_CAST(d AS DATE) WHEN d = 'onbekend' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS STRING) AS d FROM (SELECT o_orderkey, o_orderdate, {_DATE} AS d FROM orders)")
def q_dutch_date(t: Tables) -> DataFrame:
    """DAT-01."""
    return t.orders.select("o_orderkey", dates.dutch_date(F.expr(_DATE)).cast("string").alias("d"))


_TITLE = "CASE WHEN o_orderkey % 3 = 0 THEN 'Verslag' WHEN o_orderkey % 3 = 1 THEN concat('Jaarverslag ', CAST(year(o_orderdate) AS STRING)) END"


@query(f"SELECT o_orderkey, CASE WHEN t IS NOT NULL THEN coalesce(TRY_CAST(nullif(regexp_extract(right(t, 4), '^\\s*([+-]?\\d+)', 1), '') AS INTEGER), 0) END AS year FROM (SELECT o_orderkey, {_TITLE} AS t FROM orders)")
def q_year_suffix(t: Tables) -> DataFrame:
    """PRJ-03, DAT-05."""
    return t.orders.select("o_orderkey", dates.year_suffix(F.expr(_TITLE)).alias("year"))


_FUND = "concat('Stichting Pensioenfonds ', c_name, CASE WHEN c_custkey % 3 = 0 THEN ' (gesloten)' ELSE '' END)"
_CLEAN = "trim(replace(replace(replace(replace(replace(replace(lower({0}), 'pensioenfonds', ''), 'stichting', ''), '(gesloten)', ''), '(wordt gesloten)', ''), 'bedrijfstak', ''), 'spf', ''))"


@query(f"SELECT c_custkey, {_CLEAN.format('n')} AS clean, replace(replace(replace(replace(lower(n), 'pensioenfonds', ''), 'stichting', ''), '(gesloten)', ''), ' ', '') AS packed, regexp_matches(lower(n), '\\(gesloten\\)|wordt gesloten|liquidatie') AS closed FROM (SELECT c_custkey, {_FUND} AS n FROM customer)")
def q_name_clean(t: Tables) -> DataFrame:
    """NRM-01, NRM-02, NRM-07, FLT-18."""
    n = F.expr(_FUND)
    return t.customer.select("c_custkey", names.clean_name(n).alias("clean"), names.packed_name(n).alias("packed"), names.is_closed(n).alias("closed"))


_WANTED = "(SELECT DISTINCT concat('Pensioenfonds ', p_name) AS name FROM part)"
_FUNDS = "(SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN concat('Stichting ', p_name, ' NL ', p_partkey) ELSE concat(p_name, ' ', p_partkey) END AS name FROM part UNION ALL SELECT 1000000000 + s_suppkey, s_name FROM supplier)"


@query(f"WITH w AS (SELECT name, {_CLEAN.format('name')} AS c FROM {_WANTED}), f AS (SELECT id, {_CLEAN.format('name')} AS d FROM {_FUNDS}) SELECT name, (SELECT min(id) FROM f WHERE c = d OR (length(c) > 5 AND contains(d, c)) OR (length(d) > 5 AND contains(c, d))) AS id FROM w")
def q_containment_match(t: Tables) -> DataFrame:
    """JN-14, JN-15."""
    wanted = t.part.select(F.concat(F.lit("Pensioenfonds "), "p_name").alias("name")).distinct()
    k, key = F.col("p_partkey"), F.col("p_partkey").cast("string")
    own = F.when(k % 2 == 0, F.concat(F.lit("Stichting "), "p_name", F.lit(" NL "), key)).otherwise(F.concat("p_name", F.lit(" "), key))
    funds = t.part.select(k.alias("id"), own.alias("name")).union(t.supplier.select(F.lit(1000000000) + F.col("s_suppkey"), "s_name"))
    return resolve.match_regulator(wanted, funds)


@query()
def q_fuzzy(t: Tables) -> DataFrame:
    """JN-25: no SQL has the matching-blocks ratio; tested against the library function."""
    wanted = t.part.select(F.translate(F.col("p_name"), "aeiou", "eaiuo").alias("name")).distinct()
    funds = t.part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    return resolve.match_fuzzy(wanted, funds)


_CELL = f"CASE {K} % 4 WHEN 0 THEN concat('North America: ', {_s(K + ' % 90 + 1')}, '.0, Europe: 20.0') WHEN 1 THEN 'Europe: 95.0' WHEN 2 THEN concat('Pacific/Other: 10, Europe: ', {_s(K + ' % 50')}) END"
_GEO = f"CASE {K} % 3 WHEN 0 THEN 'Global, Netherlands' WHEN 1 THEN 'Europe, Emerging Markets' ELSE 'North America, Pacific/Other' END"


@query(f"""WITH s AS (SELECT {K} AS fund_id, {_CELL} AS e, {_GEO} AS g FROM part),
x AS (SELECT fund_id, unnest(string_split(e, ',')) AS p FROM s WHERE e IS NOT NULL),
y AS (SELECT fund_id, trim(split_part(p, ':', 1)) AS r, trim(split_part(p, ':', 2))::DOUBLE AS w FROM x),
z AS (SELECT fund_id, r, CASE WHEN (sum(w) OVER (PARTITION BY fund_id)) > 0 AND ((sum(w) OVER (PARTITION BY fund_id)) < 90 OR (sum(w) OVER (PARTITION BY fund_id)) > 110) THEN w / (sum(w) OVER (PARTITION BY fund_id)) * 100 ELSE w END AS w FROM y),
m AS (SELECT fund_id, trim(unnest(string_split(g, ','))) AS r FROM s WHERE e IS NULL AND g NOT LIKE '%Global%'),
q AS (SELECT fund_id, r, CASE r WHEN 'North America' THEN 63.0 WHEN 'Europe' THEN 16.0 WHEN 'Emerging Markets' THEN 11.0 ELSE 10.0 END AS w FROM m),
a AS (SELECT * FROM z UNION ALL SELECT fund_id, r, w / sum(w) OVER (PARTITION BY fund_id) * 100 FROM q
  UNION ALL SELECT fund_id, r, w FROM s, (VALUES ('North America', 63.0), ('Europe', 16.0), ('Emerging Markets', 11.0), ('Other', 10.0)) v(r, w) WHERE e IS NULL AND g LIKE '%Global%')
SELECT fund_id, CASE WHEN r = 'Pacific/Other' THEN 'Other' ELSE r END AS region, round_even(w::DOUBLE, 2) AS weight_pct FROM a""")
def q_regional_imputation(t: Tables) -> DataFrame:
    """IMP-01, AGG-18, AGG-19, RSH-02."""
    return R.regional_weights(t.part.select(F.col(K).alias("fund_id"), F.expr(_CELL).alias("explicit_geographic_weights"), F.expr(_GEO).alias("geographic_allocation")))


_MIX = f"concat('Aandelen: ', {_s(K + ' % 60')}, ',1% | Vastrentend: ', {_s(K + ' % 40')}, ',2% | Vastgoed: onbekend')"


@query(f"SELECT {K}, TRY_CAST(replace(regexp_extract(lower(m), 'aandelen[^\\d]*(\\d+(?:[.,]\\d+)?)', 1), ',', '.') AS DOUBLE) AS equity, TRY_CAST(replace(regexp_extract(string_split(lower(m), '|')[2], '(\\d+(?:[.,]\\d+)?)', 1), ',', '.') AS DOUBLE) AS fixed FROM (SELECT {K}, {_MIX} AS m FROM part)")
def q_mix_decode(t: Tables) -> DataFrame:
    """NUM-05, NUM-06."""
    return _report(t, _MIX).select(K, N.mix_share(F.col("t"), "aandelen").alias("equity"), N.allocation(F.col("t"), ["vastrentend", "obligaties"]).alias("fixed"))


_COST = f"concat('de vermogensbeheerkosten ', CASE {K} % 4 WHEN 0 THEN concat('waren 0,', {_s('10 + ' + K + ' % 80')}, ' %') WHEN 1 THEN concat({_s(K + ' % 90')}, ' bps') WHEN 2 THEN concat('1.', {_s('10 + ' + K + ' % 80')}, ' totaal') ELSE 'onbekend' END)"


@query(f"""SELECT {K}, CASE {K} % 4 WHEN 0 THEN '0.' || {_s('10 + ' + K + ' % 80')} || '%' WHEN 1 THEN '0.' || lpad({_s(K + ' % 90')}, 2, '0') || '0%' WHEN 2 THEN '1.' || {_s('10 + ' + K + ' % 80')} || '%' ELSE 'Unknown' END AS cost FROM part""")
def q_cost_ratio(t: Tables) -> DataFrame:
    """EX-18, NUM-14."""
    return _report(t, _COST).select(K, X.cost_ratio(F.col("t"), X.COST_RATIOS["vermogensbeheerkosten"]).alias("cost"))


_CLASS = f"concat('Vastrentende waarden (obligaties) ', {_s(K + ' % 99')}, ',25%; private equity en hedgefunds circa ', {_s(K + ' % 30')}, ' %. Vastgoed: geen')"


@query(f"SELECT {K}, {', '.join(f"TRY_CAST(replace(nullif(regexp_extract(t, '(?i)(?:{w})[^\\d]{{0,40}}?{PCT}', 1), ''), ',', '.') AS DOUBLE) AS {c}" for c, w in X.CLASSES.items())} FROM (SELECT {K}, {_CLASS} AS t FROM part)")
def q_asset_classes(t: Tables) -> DataFrame:
    """EX-21."""
    return _report(t, _CLASS).select(K, *[X.asset_class(F.col("t"), w).alias(c) for c, w in X.CLASSES.items()])


_AUM = f"concat('het belegd vermogen van € ', {_s(K + ' % 500 + 1')}, CASE {K} % 3 WHEN 0 THEN ',5 miljard' WHEN 1 THEN '.400 miljoen' ELSE ' euro' END)"


@query(f"SELECT {K}, coalesce(TRY_CAST(replace(replace(nullif(regexp_extract(t, '([\\d.,]+)\\s*(?:miljard|mrd|bn|billion)', 1), ''), '.', ''), ',', '.') AS DOUBLE), TRY_CAST(replace(replace(nullif(regexp_extract(t, '([\\d.,]+)\\s*(?:miljoen|mln|m|million)', 1), ''), '.', ''), ',', '.') AS DOUBLE) / 1000) AS aum FROM (SELECT {K}, {_AUM} AS t FROM part)")
def q_assets(t: Tables) -> DataFrame:
    """EX-22."""
    return _report(t, _AUM).select(K, X.assets_of_report(F.col("t")).alias("aum"))


_YEAR = f"CASE {K} % 4 WHEN 0 THEN concat('jaarverslag over ', {_s('2018 + ' + K + ' % 8')}) WHEN 1 THEN concat({_s('2020 + ' + K + ' % 5')}, ' was het jaarverslag') WHEN 2 THEN concat('2021 2022 2022 ', {_s('2020 + ' + K + ' % 5')}) ELSE 'geen jaar' END"


@query(f"""WITH x AS (SELECT {K}, {_YEAR} AS t FROM part),
y AS (SELECT {K}, unnest(regexp_extract_all(t, '\\b(202[0-4])\\b', 1)) AS y, generate_subscripts(regexp_extract_all(t, '\\b(202[0-4])\\b', 1), 1) AS i FROM x),
c AS (SELECT {K}, y, count(*) AS n, min(i) AS i FROM y GROUP BY 1, 2), m AS (SELECT {K}, arg_max(y, struct_pack(n := n, i := -i)) AS y FROM c GROUP BY 1)
SELECT x.{K}, coalesce(nullif(regexp_extract(t, '(?:jaarverslag|annual report).{{0,15}}(202[0-4])', 1), ''), nullif(regexp_extract(t, '(202[0-4]).{{0,15}}(?:jaarverslag|annual report)', 1), ''), m.y)::INTEGER AS year FROM x LEFT JOIN m ON x.{K} = m.{K}""")
def q_report_year(t: Tables) -> DataFrame:
    """EX-31, AGG-13."""
    return _report(t, _YEAR).select(K, X.report_year(F.col("t")).alias("year"))


_ESG = f"concat(CASE {K} % 3 WHEN 0 THEN 'Art. 8 SFDR. ' WHEN 1 THEN 'een donkergroen fonds. ' ELSE '' END, CASE WHEN {K} % 2 = 0 THEN 'Wij sluiten tabak en kernwapens uit. ' ELSE '' END, 'CO2: ', {_s(K + ' % 100')}, '% reductie in 20', {_s('25 + ' + K + ' % 30')})"


@query(f"SELECT {K}, CASE {K} % 3 WHEN 0 THEN 'Artikel 8 (Lichtgroen)' WHEN 1 THEN 'Artikel 9 (Donkergroen)' END AS sfdr, CASE WHEN {K} % 2 = 0 THEN 'Tabak, Controversiële Wapens' END AS excluded, {_s(K + ' % 100')} || '% reductie in 20' || {_s('25 + ' + K + ' % 30')} AS goal FROM part")
def q_esg_extract(t: Tables) -> DataFrame:
    """EX-36 to EX-38."""
    e = F.col("t")
    return _report(t, _ESG).select(K, X.sfdr_class(e).alias("sfdr"), X.exclusions(e).alias("excluded"), X.co2_goal(e).alias("goal"))


_ROW = f"concat('Fonds ', {_s(K)}, ' 2027 (april) Van 1-1-2026 naar 1-4-2027solidair ', CASE WHEN {K} % 2 = 0 THEN 'ja' ELSE 'nee' END, ' ', {_s(K + ' % 900 + 1')}, ',500', 'AZL')"


@query(f"SELECT {K}, 'Fonds ' || {_s(K)} AS name, '2027 (april)' AS date, 'solidair' AS contract, CASE WHEN {K} % 2 = 0 THEN 'ja' ELSE 'nee' END AS invaren, round_even((({K} % 900 + 1) * 1000 + 500) / 1000.0::DOUBLE, 0)::BIGINT AS deelnemers_k, 'AZL' AS uitvoerder FROM part")
def q_transition_rows(t: Tables) -> DataFrame:
    """EX-39, NUM-15."""
    return _report(t, _ROW).select(K, X.transition_row(F.col("t")).alias("r")).select(K, "r.*")


_STYLE = f"concat('de aandelen: ', repeat('passief beleggen; ', CAST({K} % 4 AS INT)), repeat('met actief beheer gedaan; ', CAST({K} % 3 AS INT)))"


@query(f"""WITH x AS (SELECT {K}, {K} % 4 AS p, {K} % 3 AS a FROM part), y AS (SELECT {K}, p, a, (p + a) AS w FROM x),
s AS (SELECT {K}, CASE WHEN p > 0 THEN w ELSE 0 END AS passive, CASE WHEN a > 0 THEN w ELSE 0 END AS active FROM y)
SELECT {K}, CASE WHEN passive = 0 AND active = 0 THEN NULL WHEN passive > active * 1.5 THEN 'Passive' WHEN active > passive * 1.5 THEN 'Active' ELSE 'Mixed (Active & Passive)' END AS style FROM s""")
def q_style_score(t: Tables) -> DataFrame:
    """EX-09: every window holds the whole sentence, so each occurrence counts for each style named."""
    return _report(t, _STYLE).select(K, X.management_style(F.col("t")).alias("style"))


@query("SELECT doc_id, (len(regexp_extract_all(lower(text), '\\bthe\\b')) + len(regexp_extract_all(lower(text), '\\band\\b')))::INTEGER AS n FROM documents")
def q_keyword_counts(t: Tables) -> DataFrame:
    """EX-10, STR-12."""
    return t.documents.select("doc_id", count_words(F.lower("text"), ("the", "and")).alias("n"))


@query("SELECT doc_id, line_no::INTEGER AS line_no, md5(line) AS digest FROM (SELECT doc_id, n AS line_no, line, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS r FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents) WHERE regexp_matches(line, '[0-9]{3}')) WHERE r <= 2")
def q_grep(t: Tables) -> DataFrame:
    """EX-43 to EX-45."""
    rows = D.lines(t.documents.select("doc_id", "text"))
    return D.grep(rows, ["doc_id"], "line_no", "line", "[0-9]{3}", most=2).select("doc_id", "line_no", F.md5("line").alias("digest"))


_FEE = f"concat('Performance fee in 2023 bedroeg ', {_s(K)}, CASE {K} % 3 WHEN 0 THEN '.250.000' WHEN 1 THEN ',5' ELSE '' END, ' euro')"


@query(f"SELECT {K}, CASE WHEN v > 1e6 THEN round_even(v / 1e6, 2) WHEN v > 1e3 THEN round_even(v / 1e3, 2) ELSE v END AS fee FROM (SELECT {K}, CASE {K} % 3 WHEN 0 THEN {K} * 1e6 + 250000 WHEN 1 THEN {K} + 0.5 ELSE {K} END::DOUBLE AS v FROM part)")
def q_performance_fee(t: Tables) -> DataFrame:
    """EX-29, NUM-03, NUM-12; the year is taken out first, as any number near would be."""
    return _report(t, _FEE).select(K, X.performance_fee(F.replace("t", F.lit(" in 2023"), F.lit(""))).alias("fee"))


_LINKS = "WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">', 1)) AS href, unnest(regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1)) AS text, generate_subscripts(regexp_extract_all(html, '<a href=\"([^\"]*)\">', 1), 1) - 1 AS pos FROM pages)"


@query(_LINKS + " SELECT page_id, pos::INTEGER AS pos, href, trim(text) AS label FROM a")
def q_links(t: Tables) -> DataFrame:
    """SRC-22."""
    return html.links(t.pages.select("page_id", "html")).select("page_id", "pos", "href", "label")


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, len(list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> ''))::INTEGER AS depth FROM pages")
def q_url_parts(t: Tables) -> DataFrame:
    """URL-01, URL-06."""
    u = F.col("url")
    return t.pages.select("page_id", names.host(u).alias("host"), names.path(u).alias("path"), names.depth(u).alias("depth"))


_URL = f"concat('https://www.', CASE {K} % 3 WHEN 0 THEN 'pensioenfonds' WHEN 1 THEN 'fonds' ELSE 'linkedin.com/' END, {_s(K)}, CASE WHEN {K} % 2 = 0 THEN '.nl' ELSE '.com' END, CASE {K} % 5 WHEN 0 THEN '/' WHEN 1 THEN '/nieuws/x' WHEN 2 THEN '/over/ons' ELSE '' END)"


@query(f"SELECT {K}, CASE WHEN {K} % 3 = 2 THEN -100 WHEN {K} % 5 = 1 THEN -50 ELSE CASE WHEN {K} % 2 = 0 THEN 10 ELSE 0 END + CASE WHEN {K} % 3 = 0 THEN 20 ELSE 0 END + CASE WHEN {K} >= 100 THEN 30 ELSE 0 END + CASE WHEN {K} % 5 IN (0, 3, 4) THEN 15 ELSE -6 END END::INTEGER AS score, CASE WHEN {K} % 5 = 1 AND {K} % 3 <> 2 THEN 'news' END AS kind FROM part")
def q_url_score(t: Tables) -> DataFrame:
    """MATH-06, EX-49."""
    u, name = F.col("t"), F.concat(F.lit("Stichting "), F.col(K).cast("string"))
    return _report(t, _URL).select(K, names.site_score(u, name).alias("score"), F.when(~u.contains("linkedin"), X.link_type(u, F.lit("https://other.nl/"))).alias("kind"))


@query("SELECT page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title FROM pages")
def q_title(t: Tables) -> DataFrame:
    """SRC-21: one tag's text."""
    return t.pages.select("page_id", F.coalesce(group(F.col("html"), "<h1>([^<]*)</h1>"), F.lit("")).alias("title"))


_BARE = r"regexp_replace(regexp_replace(html, '<(script|style|noscript|template)\b.*?</(script|style|noscript|template)\s*>|<!--.*?-->', ' ', 'gis'), '<[^>]*>', ' ', 'g')"


@query(f"SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace({_BARE}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&'), '\\s+', ' ', 'g'))) AS digest FROM pages")
def q_visible_text(t: Tables) -> DataFrame:
    """SRC-20; tested against the parser as well."""
    return t.pages.select("page_id", F.md5(html.visible_text(F.col("html"))).alias("digest"))


_TWIN = "CASE WHEN c_custkey % 3 = 0 THEN 'Corporate' WHEN c_custkey % 3 = 1 THEN 'Sector' ELSE 'Other' END"


@query(f"SELECT c_custkey, CASE c WHEN 'Corporate' THEN 'Bedrijf' WHEN 'Sector' THEN 'Tak' ELSE c END AS category FROM (SELECT c_custkey, {_TWIN} AS c FROM customer)")
def q_category_map(t: Tables) -> DataFrame:
    """NRM-04."""
    return t.customer.select("c_custkey", names.dutch_category(F.expr(_TWIN)).alias("category"))


@query("""SELECT doc_id, y AS year, NULL::DOUBLE AS beleggingsrendement_pct, NULL::DOUBLE AS economische_dekkingsgraad_pct, NULL::DOUBLE AS nominale_dekkingsgraad_pct,
CASE y WHEN 2023 THEN (doc_id % 90 + 60.5)::DOUBLE ELSE 101.1 END AS beleidsdekkingsgraad_pct, NULL::DOUBLE AS reele_dekkingsgraad_pct, NULL::DOUBLE AS indexatieverlening_pct, NULL::DOUBLE AS cpi_pct
FROM (SELECT DISTINCT o_orderkey AS doc_id FROM orders), (VALUES (2023), (2022)) v(y)""")
def q_key_figures(t: Tables) -> DataFrame:
    """EX-13 over spans made from orders: a header of years and one row of numbers for each order's document."""
    from fundlake.operators.layout import key_figures

    docs = t.orders.select(F.col("o_orderkey").alias("doc_id")).distinct()
    spans = F.expr("array(named_struct('x', 10D, 'y', 5D, 'text', 'Kerncijfers'), named_struct('x', 100D, 'y', 50D, 'text', '2023'), named_struct('x', 200D, 'y', 51D, 'text', '2022'), named_struct('x', 300D, 'y', 49D, 'text', '2021'), named_struct('x', 10D, 'y', 80D, 'text', 'Beleidsdekkingsgraad'), named_struct('x', 110D, 'y', 81D, 'text', concat(doc_id % 90 + 60, ',5%')), named_struct('x', 190D, 'y', 79D, 'text', '101,1'))")
    return key_figures(docs.select("doc_id", F.lit(0).alias("page_no"), F.explode(spans).alias("s")).select("doc_id", "page_no", "s.*"))
