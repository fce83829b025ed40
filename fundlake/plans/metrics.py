"""Extractors, each over report text made up from part keys; the SQL says what the text holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators import curation as C
from fundlake.operators import annotate as A
from fundlake.operators import extract as X
from fundlake.plans.registry import Tables, query

K = "p_partkey"


def _s(e: str) -> str:
    return f"CAST({e} AS STRING)"


def _texts(t: Tables, text: str) -> DataFrame:
    return t.part.select(K, F.expr(text).alias("t"))


def _pages(t: Tables, text: str) -> DataFrame:
    return t.part.select(F.col(K).alias("doc_id"), F.lit(0).alias("page_no"), F.expr(text).alias("text"))


_LINES = f"concat('Verslag\\nwij beleggen in aandelen\\n', CASE WHEN {K} % 3 = 0 THEN concat({_s(K + ' % 120')}, ',5%') ELSE 'geen getal' END, '\\nzakelijke waarden ', {_s('10 + ' + K + ' % 60')}, '%')"


@query(f"SELECT {K} AS doc_id, CASE WHEN {K} % 3 = 0 AND {K} % 120 + 0.5 BETWEEN 5 AND 95 THEN ({K} % 120 + 0.5)::DOUBLE ELSE (10 + {K} % 60)::DOUBLE END AS pct FROM part")
def q_equity_of_lines(t: Tables) -> DataFrame:
    """EX-03, WIN-04: a line that names equity, or a bare percentage up to two lines away."""
    return C.equity_share_of_lines(_pages(t, _LINES))


_PAGE = f"CASE {K} % 3 WHEN 0 THEN concat('Onze Aandelenportefeuille: circa ', {_s(K + ' % 150')}, ',5 % van het geheel') WHEN 1 THEN concat('aandelenfondsen ', {_s('1 + ' + K + ' % 99')}, '%') ELSE 'obligaties 40%' END"


@query(f"SELECT {K}, CASE {K} % 3 WHEN 0 THEN CASE WHEN {K} % 150 < 100 THEN ({K} % 150 + 0.5)::DOUBLE END WHEN 1 THEN (1 + {K} % 99)::DOUBLE END AS pct FROM part")
def q_equity_of_page(t: Tables) -> DataFrame:
    """EX-04, FLT-17: the first number after the word, if it can be a share."""
    return _texts(t, _PAGE).select(K, X.equity_share_of_page(F.col("t")).alias("pct"))


_SNIPPET = f"concat('het fonds belegt ', {_s('1 + ' + K + ' % 98')}, ',5% in aandelen', CASE {K} % 4 WHEN 0 THEN ', passief' WHEN 1 THEN ', actief en passief' WHEN 2 THEN ' via stock picking' ELSE '' END, CASE WHEN {K} % 3 = 0 THEN ', smart beta' WHEN {K} % 3 = 1 THEN ', marktkapitalisatie' ELSE '' END, CASE WHEN {K} % 2 = 0 THEN ', duurzaam' ELSE '' END, CASE {K} % 5 WHEN 0 THEN ', wereldwijd en europa' WHEN 1 THEN ', europa en usa' WHEN 2 THEN ', nederland' ELSE '' END)"


@query(f"""SELECT {K}, (1 + {K} % 98 + 0.5)::DOUBLE AS pct, (1 + {K} % 98 + 0.5)::DOUBLE AS allocation_pct,
CASE {K} % 4 WHEN 0 THEN 'Passive' WHEN 1 THEN 'Mixed' WHEN 2 THEN 'Active' END AS style,
CASE {K} % 3 WHEN 0 THEN 'Factor' WHEN 1 THEN 'Non-Factor' END AS factor, CASE WHEN {K} % 2 = 0 THEN 'Yes' END AS esg,
CASE {K} % 5 WHEN 0 THEN 'Global' WHEN 1 THEN 'Europe, North America' WHEN 2 THEN 'Netherlands' END AS geo FROM part""")
def q_snippet_traits(t: Tables) -> DataFrame:
    """EX-05, EX-11: share and traits of a search result."""
    c = F.col("t")
    return _texts(t, _SNIPPET).select(K, X.equity_share_of_snippet(c).alias("pct"), X.snippet_traits(c).alias("x")).select(K, "pct", "x.*")


_NOTES = f"concat_ws('\\n', concat('het beleid voor aandelen ', repeat('x', 60 + CAST({K} % 10 AS INT))), 'te kort: beleid aandelen', concat('  strategie passief ', repeat('y', 200)), concat('aandelen zonder toon ', repeat('z', 300)), concat('portefeuille actief ', repeat('w', 120)), concat('beleid passief ', repeat('v', 70)))"


@query(f"SELECT {K}, concat_ws(' | ', 'strategie passief ' || repeat('y', 200), 'portefeuille actief ' || repeat('w', 120), CASE WHEN 25 + 60 + {K} % 10 >= 85 THEN 'het beleid voor aandelen ' || repeat('x', (60 + {K} % 10)::INT) END) AS notes FROM part")
def q_strategy_notes(t: Tables) -> DataFrame:
    """EX-06, SRT-07: the three longest paragraphs on policy, of equals the earlier."""
    return _texts(t, _NOTES).select(K, X.strategy_notes(F.col("t")).alias("notes"))


# Reports: every document with passages put before and after it, so that what is looked for stands in noise.
_HEADS = ("Onze aandelen staan in Noord-Amerika 45,5% en europa (20 %), 100% japan; wereldwijd, passief volgens de benchmark. ", "Zakelijke waarden: europees\n33% en 7,5 % opkomende markten, geen actief beheer, indexvolgend. ", "Regio nederland 12% en 3% azië; equity actief beheer tegen een benchmark, ook deels passief. ", "Geen woord over beleggen. ", "Allocatie: overig 150%, other 0%, pacific 9,25%. Aandelenportefeuille: usa 61 procent, 61% usa. ")
_TAILS = (" De equity is deels passief, de tracking error laag; dutch en europe 5%", " niet meer actief belegd in aandelen wereldwijd, japan", "", " verenigde staten 40% aandelen\n emerging markets 8%")


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("\n", "' || chr(10) || '") + "'" for v in values) + "]"


_REPORTS = f"SELECT doc_id, lower({_list(_HEADS)}[(doc_id % {len(_HEADS)} + 1)::INT] || text || {_list(_TAILS)}[(doc_id % {len(_TAILS)} + 1)::INT]) AS t FROM documents WHERE text IS NOT NULL"


def _marks(t: Tables) -> DataFrame:
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("doc_id") % len(values) + 1).cast("int"))
    return A.annotations(t.documents.select("doc_id", F.concat(pick(_HEADS), "text", pick(_TAILS)).alias("text")), by="doc_id")


def _windows(words: tuple[str, ...], before: int, after: int) -> str:
    """Windows w about every place of a word in the reports, by word (o) and place."""
    parts = [f"SELECT doc_id, {i} AS o, '{w}' AS kw, unnest(list_slice(ps, 1, len(ps) - 1)) AS p, unnest(range(1, len(ps))) AS k, t FROM (SELECT *, string_split(t, '{w}') AS ps FROM r)" for i, w in enumerate(words)]
    return f"""r AS ({_REPORTS}),
places AS (SELECT doc_id, o, kw, t, k, (sum(length(p)) OVER (PARTITION BY doc_id, o ORDER BY k) + (k - 1) * length(kw))::BIGINT AS s FROM ({' UNION ALL '.join(parts)})),
win AS (SELECT doc_id, o, s, substr(t, greatest(s - {before}, 0) + 1, s + length(kw) + {after} - greatest(s - {before}, 0)) AS w FROM places)"""


_LABELLED = ", ".join(f"('{label}', {i}, '{'|'.join(ws)}')" for i, (label, ws) in enumerate(X.REGION_LABELS))


@query(f"""WITH {_windows(X.REGION_FOCUS, 300, 300)},
hits AS (SELECT doc_id, label, count(*) AS n, min([o, s, i]) AS f FROM win, (VALUES {_LABELLED}) v(label, i, words) WHERE regexp_matches(w, words) GROUP BY 1, 2),
top AS (SELECT doc_id, list(label ORDER BY n DESC, f) AS a FROM hits GROUP BY 1),
led AS (SELECT doc_id, CASE WHEN list_contains(a, 'North America') AND list_contains(a, 'Europe') AND NOT list_contains(a, 'Global') THEN list_prepend('Global', a) ELSE a END AS a FROM top),
given AS (SELECT doc_id, CASE WHEN list_contains(a, 'Global') AND list_contains(a, 'Netherlands') AND len(a) > 2 THEN list_filter(a, lambda x: x <> 'Netherlands') ELSE a END AS a FROM led)
SELECT doc_id, array_to_string(a[:3], ', ') AS regions FROM given""")
def q_regions_named(t: Tables) -> DataFrame:
    """EX-07, ARR-02: labels about a word for equity; some lead, some give way."""
    return A.regions_named(_marks(t))


_WORDS = ", ".join(f"({i}, '{w}', '{region}')" for i, (w, region) in enumerate(X.REGIONS.items()))
_SHARE = r"([0-9]{1,2}(?:[.,][0-9]{1,2})?)\s*%"


@query(f"""WITH {_windows(X.WEIGHT_FOCUS, 0, 1000)},
x AS (SELECT doc_id, o, s, i, region, regexp_extract(w, word || '.{{0,30}}?' || $${_SHARE}$$, 1) AS a, regexp_extract(w, $${_SHARE}$$ || '.{{0,30}}?' || word, 1) AS b FROM win, (VALUES {_WORDS}) v(i, word, region) WHERE contains(w, word)),
y AS (SELECT doc_id, region, try_cast(replace(v, ',', '.') AS DOUBLE) AS weight, [back, o, s, i] AS place FROM (SELECT doc_id, region, a AS v, 0 AS back, o, s, i FROM x UNION ALL SELECT doc_id, region, b, 1, o, s, i FROM x)),
z AS (SELECT doc_id, region, arg_min(weight, place) AS weight, min(place) AS place FROM y WHERE weight > 0 AND weight <= 100 GROUP BY 1, 2)
SELECT doc_id, string_agg(region || ': ' || weight::VARCHAR, ', ' ORDER BY place) AS weights FROM z GROUP BY 1""")
def q_region_weights(t: Tables) -> DataFrame:
    """EX-08, JN-29: every region word against every window; a region's first weight stays."""
    return A.region_weights(_marks(t)).select("doc_id", X.weights_text(F.col("weights")).alias("weights"))


_ANY = lambda words: "'" + "|".join(words) + "'"


@query(f"""WITH {_windows(X.STYLE_FOCUS, 200, 200)},
c AS (SELECT doc_id, regexp_matches(w, {_ANY(X.ACTIVE_WORDS)}) AS a, regexp_matches(w, {_ANY(X.PASSIVE_WORDS)}) AS p, regexp_matches(w, {_ANY(X.DENIALS)}) AS d, contains(w, '{X.PARTLY_PASSIVE[0]}') AS x FROM win WHERE regexp_matches(w, {_ANY(X.EQUITY)})),
n AS (SELECT doc_id, 2 * count(*) FILTER (WHERE a AND d) + count(*) FILTER (WHERE p) AS passive, count(*) FILTER (WHERE a AND NOT d) + count(*) FILTER (WHERE p AND x) AS active FROM c GROUP BY 1),
m AS (SELECT r.doc_id, coalesce(passive, 0) + CASE WHEN regexp_matches(t, {_ANY(X.NO_ACTIVE)}) THEN 5 ELSE 0 END + CASE WHEN regexp_matches(t, {_ANY(X.ONLY_PASSIVE)}) THEN 5 ELSE 0 END AS passive, coalesce(active, 0) AS active FROM r LEFT JOIN n USING (doc_id))
SELECT doc_id, CASE WHEN passive > active * 1.5 THEN 'Passive' WHEN active > passive * 1.5 THEN 'Active' ELSE 'Mixed (Active & Passive)' END AS style FROM m WHERE passive + active > 0""")
def q_style_windows(t: Tables) -> DataFrame:
    """EX-09: windows about words of a style that name equity; denials count against the style."""
    return A.management_style(_marks(t))


@query(f"""WITH r AS ({_REPORTS}),
words AS (SELECT unnest({_list(A.VOCABULARY)}) AS word),
hits AS (SELECT doc_id, word, unnest(list_slice(ps, 1, len(ps) - 1)) AS p, unnest(range(1, len(ps))) AS k FROM (SELECT doc_id, word, string_split(t, word) AS ps FROM r, words WHERE contains(t, word)))
SELECT doc_id, word, count(*) AS n, (sum(s))::BIGINT AS places FROM (SELECT doc_id, word, sum(length(p)) OVER (PARTITION BY doc_id, word ORDER BY k) + (k - 1) * length(word) AS s FROM hits) GROUP BY 1, 2""")
def q_annotations(t: Tables) -> DataFrame:
    """EX-01 to EX-35: the table that extractors share: every place of every word, words within words too."""
    words = _marks(t).where("kind = 'word'")
    return words.groupBy("doc_id", "word").agg(F.count("*").alias("n"), F.sum("start").alias("places"))


_SAID = ("De actuele dekkingsgraad was 104,5% en de beleidsdekkingsgraad steeg naar\n111% . Het fonds is artikel 8 SFDR en sluit tabak en kernwapens uit. ", "Jaarverslag over 2023: beleidsdekkingsgraad van ongeveer 99 %, performance fee 2.500, indexatie van 3,2% en later 4%. Donkergroen, geen kansspelen. ", "In 2022 (annual report) daalde co2 met 30 % reductie voor 2030. Prestatievergoeding: circa 1,25 miljoen. ", "De maanddekkingsgraad is 45% en later 120,1%. Art. 9 van de SFDR, lichtgroen. Vermindering van 50% co2 tegen 2040; toeslag 12%, verhoogd met 1,5 %. ", "2021, 2022 en 2022, global compact en steenkolen. ")
_SAYING = f"SELECT doc_id, {_list(_SAID)}[(doc_id % {len(_SAID)} + 1)::INT] || text || {_list(_SAID[::-1])}[(doc_id % 7 % {len(_SAID)} + 1)::INT] AS t FROM documents WHERE text IS NOT NULL"
_KINDS = ", ".join(f"CASE WHEN regexp_matches(low, '\\b({words})\\b') THEN '{kind}' END" for kind, words in X.EXCLUSIONS)
_RATIO = lambda label: f"try_cast(replace(replace(nullif(regexp_extract(low, '(?:{label}).{{0,150}}?([0-9]{{2,3}}(?:[.,][0-9])?\\s*%)', 1), ''), '%', ''), ',', '.') AS DOUBLE)"
_RISE = "(?i)(?:verhog(?:ing|en)|indexatie|toeslag|verhoogd).*?(?:met\\s*)?([0-9,.]+)\\s*%"


@query(f"""WITH d AS (SELECT doc_id, t, lower(t) AS low FROM ({_SAYING})),
e AS (SELECT *, {_RATIO(X.COVERAGE['maanddekkingsgraad_pct'])} AS maand, {_RATIO(X.COVERAGE['beleidsdekkingsgraad_pct'])} AS beleid,
  regexp_extract(t, '(?i)\\b((?:artikel\\s*|art\\.\\s*)[89])\\s*(?:van de\\s*)?(?:sfdr)?\\b', 1) AS art,
  list_filter(list_transform(regexp_extract_all(t, '{_RISE}', 1), lambda x: try_cast(replace(x, ',', '.') AS DOUBLE)), lambda x: x BETWEEN 0 AND 10) AS rises,
  regexp_extract_all(low, '\\b(202[0-4])\\b', 1) AS years FROM d),
y AS (SELECT doc_id, arg_min(y, [-n, i]) AS common FROM (SELECT doc_id, y, count(*) AS n, min(i) AS i FROM (SELECT doc_id, unnest(years) AS y, unnest(range(len(years))) AS i FROM e) GROUP BY 1, 2) GROUP BY 1)
SELECT e.doc_id, CASE WHEN maand BETWEEN 60 AND 250 THEN maand END AS maand, CASE WHEN beleid BETWEEN 60 AND 250 THEN beleid END AS beleid,
  CASE WHEN contains(art, '8') THEN 'Artikel 8 (Lichtgroen)' WHEN contains(art, '9') THEN 'Artikel 9 (Donkergroen)' WHEN regexp_matches(low, '\\blichtgroen') THEN 'Artikel 8 (Lichtgroen)' WHEN regexp_matches(low, '\\bdonkergroen') THEN 'Artikel 9 (Donkergroen)' END AS sfdr,
  nullif(concat_ws(', ', {_KINDS}), '') AS exclusions, rises[1] AS rise,
  coalesce(nullif(regexp_extract(low, '(?:jaarverslag|annual report).{{0,15}}(202[0-4])', 1), ''), nullif(regexp_extract(low, '(202[0-4]).{{0,15}}(?:jaarverslag|annual report)', 1), ''), common)::INTEGER AS year
FROM e LEFT JOIN y USING (doc_id)""")
def q_report_metrics(t: Tables) -> DataFrame:
    """EX-12, EX-31, EX-33, EX-36, EX-37 over whole documents with passages before and after."""
    pick = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))
    c, low = F.col("t"), F.lower("t")
    rows = t.documents.where("text IS NOT NULL").select("doc_id", F.concat(pick(_SAID, F.col("doc_id")), "text", pick(_SAID[::-1], F.col("doc_id") % 7)).alias("t"))
    return rows.select("doc_id", X.coverage_ratio(low, X.COVERAGE["maanddekkingsgraad_pct"]).alias("maand"), X.coverage_ratio(low, X.COVERAGE["beleidsdekkingsgraad_pct"]).alias("beleid"), X.sfdr_class(c).alias("sfdr"), X.exclusions(c).alias("exclusions"), X.indexation_of_site(c).alias("rise"), X.report_year(low).alias("year"))


_FLAT = f"concat('kerncijfers 2024 2023 2022 \\nBeleidsdekkingsgraad ', {_s('100 + ' + K + ' % 40')}, ',5% 111,2% -', {_s(K + ' % 9')}, ',1% \\n')"


@query(f"SELECT {K}, x.y AS year, x.v AS value FROM (SELECT {K}, unnest([{{'y': '2024', 'v': (100 + {K} % 40 + 0.5)::DOUBLE}}, {{'y': '2023', 'v': 111.2::DOUBLE}}, {{'y': '2022', 'v': (-({K} % 9) - 0.1)::DOUBLE}}]) AS x FROM part)")
def q_flat_figures(t: Tables) -> DataFrame:
    """EX-14: years and numbers of flattened lines, paired in order."""
    pairs = _texts(t, _FLAT).select(K, F.explode(C.flat_figures(F.col("t"), "beleidsdekkingsgraad")).alias("x"))
    return pairs.select(K, F.col("x.year").alias("year"), F.col("x.value").alias("value"))


_PEOPLE = f"concat('actieve deelnemers ', {_s('10 + ' + K + ' % 80')}, '.', lpad({_s(K + ' % 1000')}, 3, '0'), ' ; slapers ', {_s('100 + ' + K + ' % 900')}, ' ; gepensioneerden 2024 ; totaal aantal deelnemers onbekend')"


@query(f"""SELECT {K}, (10 + {K} % 80) * 1000 + {K} % 1000 AS deelnemers_actief, 100 + {K} % 900 AS deelnemers_slapers,
100 + {K} % 900 AS deelnemers_gepensioneerd, NULL::BIGINT AS deelnemers_totaal FROM part""")
def q_participants(t: Tables) -> DataFrame:
    """EX-15: four counts; where none follows that can be one, the last number before the label counts."""
    # The year after the third label is no count; before the fourth, where none follows, stands that year last.
    return _texts(t, _PEOPLE).select(K, *[X.participants(F.col("t"), label).alias(c) for c, label in X.PARTICIPANTS.items()])


_COSTS = f"concat('in 2024: kosten per deelnemer 2023 : € ', {_s('50 + ' + K + ' % 900')}, ' euro\\npensioenuitvoeringskosten 2022 ', CASE {K} % 3 WHEN 0 THEN concat({_s('1 + ' + K + ' % 90')}, ',5 miljoen') WHEN 1 THEN concat({_s('200 + ' + K + ' % 700')}, ' duizend') ELSE ' ' END)"


@query(f"SELECT {K}, (50 + {K} % 900)::DOUBLE AS per_head, CASE {K} % 3 WHEN 0 THEN (1 + {K} % 90 + 0.5)::DOUBLE WHEN 1 THEN (200 + {K} % 700) / 1000.0::DOUBLE END AS total FROM part")
def q_costs(t: Tables) -> DataFrame:
    """EX-16, EX-17: cost per participant and in total; years are no costs."""
    c = F.col("t")
    return _texts(t, _COSTS).select(K, X.cost_per_participant(c).alias("per_head"), X.total_cost(c).alias("total"))


_MIXED = f"CASE {K} % 4 WHEN 0 THEN concat('de beleggingsmix: aandelen ', {_s('1 + ' + K + ' % 60')}, ',5 %, obligaties 30,0 %, vastgoed 9,9 %') WHEN 1 THEN concat('portefeuille met aandelen van ', {_s('10 + ' + K + ' % 60')}, ',5 en vastrentend van 40,1') WHEN 2 THEN 'onze beleggingsmix' ELSE 'niets' END"


@query(f"""SELECT {K}, CASE {K} % 4 WHEN 0 THEN 'Aandelen: ' || (1 + {K} % 60) || ',5% | Vastrentend: 30,0% | Vastgoed: 9,9%' WHEN 2 THEN 'Mentions mix but exact % parsed failed' ELSE 'Unknown' END AS strict,
CASE {K} % 4 WHEN 0 THEN 'Aandelen: ' || (1 + {K} % 60) || ',5% | Vastrentend: 30,0% | Vastgoed: 9,9%' WHEN 1 THEN 'Aandelen: ' || (10 + {K} % 60) || ',5% | Vastrentend: 40,1%' WHEN 2 THEN 'Mentions mix but exact % parsed failed' ELSE 'Unknown' END AS relaxed FROM part""")
def q_asset_mix(t: Tables) -> DataFrame:
    """EX-19, EX-20: shares of three classes, with and without the percent sign."""
    c = F.col("t")
    return _texts(t, _MIXED).select(K, X.asset_mix(c).alias("strict"), X.asset_mix(c, relaxed=True).alias("relaxed"))


_ASSETS = f"CASE {K} % 4 WHEN 0 THEN concat('belegd vermogen van € ', {_s('1 + ' + K + ' % 900')}, '.250.000 euro') WHEN 1 THEN concat('belegd vermogen was ', {_s('1 + ' + K + ' % 9000')}, ',5 miljoen') WHEN 2 THEN concat('totale vermogen: ', {_s('1 + ' + K + ' % 900')}, ',25 mld') ELSE 'vermogen onbekend' END"


@query(f"SELECT {K}, CASE {K} % 4 WHEN 0 THEN ((1 + {K} % 900) * 1000000 + 250000) / 1e9::DOUBLE WHEN 1 THEN (1 + {K} % 9000 + 0.5) / 1e3::DOUBLE WHEN 2 THEN (1 + {K} % 900 + 0.25)::DOUBLE END AS aum FROM part")
def q_assets_patterned(t: Tables) -> DataFrame:
    """EX-23: eight patterns in turn."""
    return _texts(t, _ASSETS).select(K, X.assets_patterned(F.col("t")).alias("aum"))


_FIGURES = f"concat_ws('\\n', 'kerncijfers', 'Belegd vermogen', concat({_s('1 + ' + K + ' % 900')}, ',5 ', CASE WHEN {K} % 2 = 0 THEN 'miljard' ELSE 'miljoen' END), 'slot')"


@query(f"SELECT {K} AS doc_id, CASE WHEN {K} % 2 = 0 THEN CASE WHEN 1 + {K} % 900 + 0.5 <= 600 THEN (1 + {K} % 900 + 0.5)::DOUBLE END ELSE CASE WHEN (1 + {K} % 900 + 0.5) / 1000 >= 0.01 THEN (1 + {K} % 900 + 0.5) / 1000::DOUBLE END END AS aum FROM part WHERE CASE WHEN {K} % 2 = 0 THEN 1 + {K} % 900 + 0.5 <= 600 ELSE (1 + {K} % 900 + 0.5) / 1000 >= 0.01 END")
def q_assets_of_lines(t: Tables) -> DataFrame:
    """EX-24, WIN-03: a line that names assets and the two after it, in bounds."""
    from fundlake.sources import documents as D

    rows = D.context(D.lines(_pages(t, _FIGURES)), ["doc_id"], "line_no", "line", 0, 2)
    found = rows.where(F.lower("line").contains("belegd vermogen")).withColumn("aum", X.assets_of_lines(F.col("context"))).where("aum IS NOT NULL")
    return found.groupBy("doc_id").agg(F.min_by("aum", "line_no").alias("aum"))


_WEB = f"concat('Het vermogen van ', {_s('1 + ' + K + ' % 2000')}, CASE WHEN {K} % 2 = 0 THEN ',5 miljard' ELSE ',25 miljoen' END, ' ; het vermogen bedroeg 3,2 miljard ; totaal vermogen 7,5 miljard ; dekkingsgraad ', {_s('40 + ' + K + ' % 200')}, '%')"


@query(f"""SELECT {K}, CASE WHEN {K} % 2 = 0 THEN round_even((1 + {K} % 2000 + 0.5)::DOUBLE, 3) ELSE round_even((1 + {K} % 2000 + 0.25) / 1000::DOUBLE, 3) END AS page_bn,
CASE WHEN {K} % 2 = 0 THEN (1 + {K} % 2000 + 0.5)::DOUBLE ELSE 3.2 END AS said_bn,
CASE WHEN 40 + {K} % 200 BETWEEN 50 AND 200 THEN (40 + {K} % 200)::DOUBLE END AS ratio, 7.5::DOUBLE AS most_bn, 7.5::DOUBLE AS snippet_bn FROM part""")
def q_assets_of_web(t: Tables) -> DataFrame:
    """EX-25 to EX-28, AGG-26: amounts on web pages and in search results."""
    low, m = F.lower("t"), X.snippet_metrics(F.lower("t"))
    return _texts(t, _WEB).select(K, X.assets_of_page(F.col("t")).alias("page_bn"), m["aum_euro_bn"].alias("said_bn"), m["dekkingsgraad_pct"].alias("ratio"), X.largest_amount(F.col("t")).alias("most_bn"), X.assets_of_snippets(F.regexp_replace(low, "vermogen van [^;]*;", "")).alias("snippet_bn"))


_INDEX = f"CASE {K} % 3 WHEN 0 THEN 'de benchmark is msci world index en ftse all-share index.' WHEN 1 THEN 'wij volgen de bloomberg euro return' ELSE 'geen' END"


@query(f"SELECT {K}, CASE {K} % 3 WHEN 0 THEN 'Ftse All-Share Index, Msci World Index' WHEN 1 THEN 'Bloomberg Euro Return' ELSE 'None explicitly identified' END AS names FROM part")
def q_benchmarks(t: Tables) -> DataFrame:
    """EX-30: names of indexes, distinct and in order."""
    return _texts(t, _INDEX).select(K, X.benchmarks(F.col("t")).alias("names"))


_RISE = f"concat('voor de actieve deelnemers is de indexatie ', {_s(K + ' % 9')}, ',25% ; een verhoging van ', {_s('1 + ' + K + ' % 15')}, ',1 %')"


@query(f"SELECT {K}, ({K} % 9)::VARCHAR || ',25' AS actives, ({K} % 9 + 0.25)::DOUBLE AS site FROM part")
def q_indexation(t: Tables) -> DataFrame:
    """EX-32, EX-33: the rise of a group's pensions, and that which a site names first."""
    c = F.col("t")
    return _texts(t, _RISE).select(K, X.indexation_of_window(c, "actieve deelnemers|actieven").alias("actives"), X.indexation_of_site(c).alias("site"))


_PARTIES = f"concat(CASE {K} % 3 WHEN 0 THEN 'De pensioenuitvoerder is Appel Diensten, sinds 2020. ' WHEN 1 THEN 'TKP doet de administratie van het fonds. ' ELSE 'Er staat niets. ' END, CASE WHEN {K} % 2 = 0 THEN 'De fiduciair beheerder is Kempen Capital. ' ELSE '' END, CASE {K} % 5 WHEN 0 THEN 'Er is eigen beheer.' WHEN 1 THEN 'Er is geen eigen beheer.' ELSE '' END)"


@query(f"SELECT {K}, CASE {K} % 3 WHEN 0 THEN 'Appel Diensten' WHEN 1 THEN 'TKP' END AS administrator, CASE WHEN {K} % 2 = 0 THEN 'Kempen Capital' END AS fiduciary, CASE WHEN {K} % 5 = 0 THEN 'Ja' ELSE 'Nee' END AS internal FROM part")
def q_parties(t: Tables) -> DataFrame:
    """EX-34: who administers, who manages, and whether inside the fund."""
    c = F.col("t")
    return _texts(t, _PARTIES).select(K, X.administrator(c).alias("administrator"), X.fiduciary(c).alias("fiduciary"), X.managed_internally(c).alias("internal"))


_HEDGE = f"CASE {K} % 3 WHEN 0 THEN concat('Begin. Wij kopen opties tegen dalingen van ', {_s(K)}, ' punten. Daarna   niets. Slot.') WHEN 1 THEN 'Het renterisico afgedekt heeft afdekking van privacy. Ja.' ELSE 'Niets hier.' END"


@query(f"SELECT {K}, CASE {K} % 3 WHEN 0 THEN 'Begin. Wij kopen opties tegen dalingen van ' || {K}::VARCHAR || ' punten. Daarna niets.' ELSE 'Unknown' END AS said FROM part")
def q_protection(t: Tables) -> DataFrame:
    """EX-35, STR-10: sentences on protection with their neighbours."""
    return _texts(t, _HEDGE).select(K, X.protection(F.col("t")).alias("said"))


_PLAN = f"concat_ws('\\n', 'Planning', '1-jan-26 12 Fonds A', concat('Fonds B ', {_s(K)}), '', '1-apr-27 Fonds C', '1-jul-27 totaal 3', 'Fonds D')"


@query(f"SELECT {K} AS doc_id, x.n::INTEGER AS line_no, x.d AS date, x.f AS fund FROM (SELECT {K}, unnest([{{'n': 1, 'd': '1-jan-26', 'f': 'Fonds A'}}, {{'n': 2, 'd': '1-jan-26', 'f': 'Fonds B ' || {K}}}, {{'n': 4, 'd': '1-apr-27', 'f': 'Fonds C'}}]) AS x FROM part)")
def q_planning_list(t: Tables) -> DataFrame:
    """EX-40, WIN-12, DAT-04: a date holds until the next one, a total ends the list."""
    from fundlake.sources import documents as D

    return C.planning_list(D.lines(_pages(t, _PLAN)))


_DIRECTORY = f"concat_ws('\\n', 'Pensioenfonds Vroeg', 'Corporate', concat('Pensioenfonds ', {_s(K)}), 'zomaar tekst', 'APF', 'Stap (kring A)')"


@query(f"SELECT {K} AS doc_id, x.n::INTEGER AS line_no, x.f AS name, x.c AS category FROM (SELECT {K}, unnest([{{'n': 0, 'f': 'Pensioenfonds Vroeg', 'c': 'General'}}, {{'n': 2, 'f': 'Pensioenfonds ' || {K}, 'c': 'Corporate'}}, {{'n': 5, 'f': 'Stap (kring A)', 'c': 'APF'}}]) AS x FROM part)")
def q_directory(t: Tables) -> DataFrame:
    """EX-41, SRC-16, WIN-10: landed paragraphs of a directory; a header holds until the next."""
    from fundlake.sources import documents as D

    return C.directory(D.lines(_pages(t, _DIRECTORY)))


_BOARD = f"CASE {K} % 4 WHEN 0 THEN 'Voorzitter: Jan de Vries' WHEN 1 THEN 'A.B. Jansen - bestuurslid' WHEN 2 THEN 'het bestuur vergadert' ELSE 'Directeur' END"


@query(f"SELECT {K}, CASE {K} % 4 WHEN 1 THEN 'A.B. Jansen' END AS name, CASE {K} % 4 WHEN 1 THEN 'A.B. Jansen - bestuurslid' END AS role FROM part")
def q_people(t: Tables) -> DataFrame:
    """EX-42, STR-15: a name by its shape in a block that names a role."""
    return _texts(t, _BOARD).select(K, X.person(F.col("t")).alias("p")).select(K, "p.*")


_HREF = f"concat('https://fonds.nl/docs/', CASE {K} % 4 WHEN 0 THEN 'Jaarverslag-2023' WHEN 1 THEN 'duurzaam-verslag' WHEN 2 THEN 'transitieplan' ELSE 'jaarverslag-2019' END, CASE WHEN {K} % 3 = 0 THEN '.html' ELSE '.pdf' END)"


@query(f"SELECT {K}, {K} % 4 = 0 AND {K} % 3 <> 0 AS report, {K} % 4 = 1 AND {K} % 3 <> 0 AS esg, {K} % 4 = 2 AND {K} % 3 <> 0 AS transition FROM part")
def q_report_links(t: Tables) -> DataFrame:
    """EX-46 to EX-48: links to reports by their address and text."""
    h = F.col("t")
    return _texts(t, _HREF).select(K, X.is_report_link(h, F.lit("download")).alias("report"), X.is_esg_link(h, F.lit(None).cast("string")).alias("esg"), X.is_transition_link(h, F.lit("https://fonds.nl/")).alias("transition"))


@query(f"SELECT {K} AS doc_id, ({K} % 900 + 1 + 0.25)::DOUBLE AS fee FROM part WHERE {K} % 2 = 0")
def q_table_fees(t: Tables) -> DataFrame:
    """SRC-14, EX-29: tables as rows of cells; the first row's fee, in millions."""
    rows = F.expr(f"array(array('Kosten', '2023'), array(CASE WHEN {K} % 2 = 0 THEN 'Performance fee' ELSE 'Overig' END, concat({_s(K + ' % 900 + 1')}, ',25')), array('performance fee', '3,5'))")
    tables = t.part.select(F.col(K).alias("doc_id"), F.lit(0).alias("page_no"), F.lit(0).alias("table_no"), F.when(F.col(K) % 2 == 0, rows).otherwise(F.slice(rows, 1, 2)).alias("rows"))
    return C.table_fees(tables)


@query(f"WITH f AS (SELECT {K}, ({K} % 7) * 1.5 AS v FROM part) SELECT {K} % 5 AS grp, count(*) AS tried, count(*) FILTER (WHERE v > 0) AS found, round(100.0 * count(*) FILTER (WHERE v > 0) / count(*), 2) AS rate FROM f GROUP BY 1")
def q_success_rates(t: Tables) -> DataFrame:
    """AGG-25: how many were tried and found, and the rate, by group."""
    rows = t.part.select((F.col(K) % 5).alias("grp"), ((F.col(K) % 7) * 1.5).alias("v"))
    found = F.count_if(F.col("v") > 0)
    return rows.groupBy("grp").agg(F.count("*").alias("tried"), found.alias("found"), F.round(100.0 * found / F.count("*"), 2).alias("rate"))


@query(f"SELECT {K}, sum(v) OVER (PARTITION BY {K} % 10 ORDER BY {K} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS total FROM (SELECT {K}, {K} % 13 AS v FROM part)")
def q_rolling(t: Tables) -> DataFrame:
    """WIN-07: a window of rows before the current one."""
    w = Window.partitionBy(F.col(K) % 10).orderBy(K).rowsBetween(-3, 0)
    return t.part.select(K, F.sum(F.col(K) % 13).over(w).alias("total"))
