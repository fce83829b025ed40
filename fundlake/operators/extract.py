"""Metrics out of report text, as Column expressions over a text column.

Each function names its operator of the survey's inventory (EX-..). Order is
word by word of the list, then by position; windows may overlap; the first
value within bounds wins unless said otherwise. Texts are lower-cased by the
caller where the docstring says so. Null text gives null (or the sentinel of
the operator). The patterns below are fixed values of the report language.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.functions import numbers as N
from fundlake.functions.text import contains_any, count_where, count_words, first, first_where, group, groups, keyword_windows, let, quote, squeeze, strip, title_case, windows

# Number shapes.
PCT = r"(\d{1,2}(?:[.,]\d{1,2})?)\s*%"
AMOUNT = r"([\d.,]+)"
EQUITY = ("aandelen", "zakelijke waarden", "equity")
# Region words and what they stand for.
REGIONS = {
    "noord-amerika": "North America", "noord amerika": "North America", "verenigde staten": "North America", "usa": "North America", "north america": "North America",
    "europa": "Europe", "europees": "Europe", "europe": "Europe",
    "opkomende markten": "Emerging Markets", "emerging markets": "Emerging Markets",
    "nederland": "Netherlands", "dutch": "Netherlands",
    "azië": "Pacific/Other", "pacific": "Pacific/Other", "asia": "Pacific/Other", "japan": "Pacific/Other", "other": "Pacific/Other", "overig": "Pacific/Other",
}
# Words of a region in a sentence about equity.
REGION_LABELS = (
    ("Global", ("wereldwijd", "globaal", "global")),
    ("Europe", ("europa", "europees", "europe")),
    ("North America", ("noord-amerika", "noord amerika", "verenigde staten", "usa", "north america")),
    ("Emerging Markets", ("opkomende markten", "emerging markets", "azië", "pacific", "asia", "japan")),
    ("Netherlands", ("nederland", "dutch")),
)


# Words about which regions, weights and styles are looked for.
REGION_FOCUS = ("aandelen", "zakelijke waarden", "equity", "aandelenportefeuille", "regio")
WEIGHT_FOCUS = ("aandelen", "zakelijke waarden", "equity", "aandelenportefeuille", "regio", "allocatie")
STYLE_FOCUS = ("actief beheer", "passief", "indexvolgend", "tracking error", "benchmark")
# Words of the two styles, of denial, and those that decide.
ACTIVE_WORDS = ("actief beheer", "actieve", "actief")
PASSIVE_WORDS = ("passief", "indexvolgend", "tracker", "passieve")
DENIALS = ("geen actief", "niet actief", "niet meer actief", "0% van de technische voorzieningen", "uitsluitend passief")
PARTLY_PASSIVE = ("deels passief",)
NO_ACTIVE = ("niet meer actief belegd", "niet actief belegd", "geen actief beheer")
ONLY_PASSIVE = ("volledig passief", "geheel passief", "uitsluitend passief")


def _when(value: Column, low: float, high: float) -> Column:
    return F.when(value.between(low, high), value)


def equity_share(text: Column) -> Column:
    """EX-01 (lower case): in the 500 characters after a word for equity, the first percentage over 0 up to 100."""
    found = F.flatten(F.transform(keyword_windows(text, EQUITY, 0, 500, own=False), lambda w: groups(w, PCT)))
    return N.first_between(found, 0, 100, open_low=True)


def equity_share_patterned(text: Column) -> Column:
    """EX-02 (lower case): by pattern in turn, the first percentage from 5 to 95."""
    patterns = (
        rf"{PCT}\s*(?:in\s+)?(?:aandelen|zakelijke waarden)",
        rf"(?:aandelen|zakelijke waarden)[:\s]+{PCT}",
        rf"aandelenportefeuille\s+van\s+{PCT}",
        rf"strategische allocatie[^\d]{{0,50}}?aandelen[^\d]{{0,20}}?{PCT}",
        rf"aandelen[^\d\n%]{{0,30}}{PCT}",
    )
    return F.coalesce(*[N.first_between(groups(text, p), 5, 95) for p in patterns])


def equity_share_of_page(text: Column) -> Column:
    """EX-04 (any case): the first number after the word; kept if over 0 and up to 100."""
    v = N.comma_decimal(group(text, r"(?iu)aandelen(?:portefeuille|fondsen)?[\s:]*[^\d]{0,40}([\d,.]+)\s*%"))
    return F.when((v > 0) & (v <= 100), v)


def equity_share_of_snippet(text: Column) -> Column:
    """EX-05 (lower case): the first percentage before the word, unbounded."""
    return N.comma_decimal(group(text, rf"{PCT}\s*(?:in\s+)?aandelen"))


def strategy_notes(text: Column) -> Column:
    """EX-06: of paragraphs of 80 characters and more that speak of policy and equity the three longest, earlier first if equal."""
    # Words that a paragraph on strategy has.
    targets = ("aandelen", "beleggingsbeleid", "aandelenportefeuille", "passief", "actief")
    tones = ("beleid", "strategie", "allocatie", "portefeuille")
    lines = F.filter(F.split(text, "\n"), lambda p: (F.length(F.lower(p)) >= 80) & contains_any(F.lower(p), targets) & contains_any(F.lower(p), tones))
    ranked = F.array_sort(F.transform(lines, lambda p, i: F.struct((-F.length(strip(p))).alias("n"), i.alias("i"), strip(p).alias("p"))))
    return F.when(F.size(lines) > 0, F.substring(F.array_join(F.transform(F.slice(ranked, 1, 3), lambda x: x.p), " | "), 1, 1500))


def regions_named(text: Column) -> Column:
    """EX-07 (lower case): up to three labels by how many windows of 300 characters about a word name them.

    Global leads if both North America and Europe are named; the Netherlands give way to Global among more than two."""
    named = lambda w: F.filter(F.array(*[F.when(contains_any(w, ws), F.lit(label)) for label, ws in REGION_LABELS]), lambda x: x.isNotNull())
    has = lambda a, v: F.array_contains(a, v)

    def ranked(all_: Column) -> Column:
        counted = F.transform(F.array_distinct(all_), lambda v: F.struct((-F.size(F.filter(all_, lambda x: x == v))).alias("n"), F.array_position(all_, v).alias("i"), v.alias("v")))
        return F.transform(F.array_sort(counted), lambda x: x.v)

    def led(top: Column) -> Column:
        return F.when(has(top, "North America") & has(top, "Europe") & ~has(top, "Global"), F.concat(F.array(F.lit("Global")), top)).otherwise(top)

    def given_way(top: Column) -> Column:
        top = F.when(has(top, "Global") & has(top, "Netherlands") & (F.size(top) > 2), F.array_remove(top, "Netherlands")).otherwise(top)
        return F.when(F.size(top) > 0, F.array_join(F.slice(top, 1, 3), ", "))

    return let(let(let(F.flatten(F.transform(keyword_windows(text, REGION_FOCUS, 300, 300), named)), ranked), led), given_way)


def region_weights(text: Column) -> Column:
    """EX-08 (lower case): (region, weight) pairs, the first valid percentage of each region.

    First all windows with the number after the region's word, then all with it before; within a window by word."""
    around = keyword_windows(text, WEIGHT_FOCUS, 0, 1000)

    def found(pattern: str) -> Column:
        def of(w: Column) -> Column:
            one = lambda word, region: F.struct(F.lit(region).alias("region"), N.comma_decimal(group(w, pattern.format(quote(word)))).alias("weight"))
            return F.array(*[one(word, region) for word, region in REGIONS.items()])

        return F.filter(F.flatten(F.transform(around, of)), lambda x: (x.weight > 0) & (x.weight <= 100))

    all_ = F.concat(found(rf"{{}}.{{{{0,30}}}}?{PCT.replace('{', '{{').replace('}', '}}')}"), found(rf"{PCT.replace('{', '{{').replace('}', '}}')}.{{{{0,30}}}}?{{}}"))
    # First wins: a pair is kept if no earlier one has its region.
    kept = F.aggregate(all_, F.array().cast("array<struct<region:string,weight:double>>"), lambda acc, x: F.when(F.exists(acc, lambda y: y.region == x.region), acc).otherwise(F.array_append(acc, x)))
    return F.when(F.size(kept) > 0, kept)


def weights_text(weights: Column) -> Column:
    """The cell form of region weights: 'Europe: 13.0, Other: 7.0'."""
    return F.array_join(F.transform(weights, lambda x: F.concat(x.region, F.lit(": "), x.weight.cast("string"))), ", ")


def management_style(text: Column) -> Column:
    """EX-09 (lower case): active against passive by score; a side leads by half as much again, else mixed."""
    around = keyword_windows(text, STYLE_FOCUS, 200, 200)
    denied = lambda w: contains_any(w, DENIALS)
    actively = lambda w: contains_any(w, ACTIVE_WORDS)
    passively = lambda w: contains_any(w, PASSIVE_WORDS)
    partly = lambda w: contains_any(w, PARTLY_PASSIVE)
    strong = lambda words: F.when(contains_any(text, words), 5).otherwise(0)

    def scores(near: Column) -> Column:
        passive = strong(NO_ACTIVE) + strong(ONLY_PASSIVE)
        passive = passive + 2 * count_where(near, lambda w: actively(w) & denied(w)) + count_where(near, passively)
        active = count_where(near, lambda w: actively(w) & ~denied(w)) + count_where(near, lambda w: passively(w) & partly(w))
        return F.struct(passive.alias("passive"), active.alias("active"))

    return F.when(text.isNotNull(), let(let(F.filter(around, lambda w: contains_any(w, EQUITY)), scores), lambda x: style_of(x.passive, x.active)))


def style_of(passive: Column, active: Column) -> Column:
    """The style that two scores speak for; null if both are 0."""
    return (
        F.when((passive == 0) & (active == 0), None)
        .when(passive > active * 1.5, "Passive")
        .when(active > passive * 1.5, "Active")
        .when((active > 0) & (passive > 0), "Mixed (Active & Passive)")
        .when(passive >= active, "Passive")
        .otherwise("Active")
    )


def esg_score(text: Column) -> Column:
    # Words of the ESG score.
    return count_words(text, ("esg", "duurzaamheid", "duurzaam", "maatschappelijk verantwoord", "mvo", "sri", "uitsluitingen", "klimaat", "co2"))


def factor_score(text: Column) -> Column:
    """Factor words; those of everyday use count only near one that shows what is meant."""
    # Words of the factor score.
    plain = count_words(text, ("factorbeleggen", "factor investing", "smart beta", "low volatility", "lage volatiliteit", "factoren"))
    vague = [windows(text, rf"(?U)\b{w}\b", 100, 100) for w in ("value", "momentum", "quality", "kwaliteit", "size")]
    return plain + sum((count_where(w, lambda x: contains_any(x, ("factor", "smart beta", "aandelen", "premie"))) for w in vague), F.lit(0))


def esg_focus(text: Column) -> Column:
    """EX-10 (lower case)."""
    n = esg_score(text)
    return F.when(text.isNull(), None).when(n > 50, "High (Extensive ESG/Sustainability Focus)").when(n > 10, "Medium (Mentions ESG/Exclusions)").otherwise("Standard")


def factor_style(text: Column) -> Column:
    """EX-10 (lower case)."""
    n = factor_score(text)
    denied = contains_any(text, ("geen factorbeleggen", "geen factoren", "niet in factoren"))
    return F.when(text.isNull(), None).when(denied, "No").when(n > 15, "Yes (Strong Factor/Smart Beta Focus)").when(n > 3, "Yes (Mentions Factor Investing)").when(n == 0, "No (No specific mention)").otherwise("Unknown")


def snippet_traits(text: Column) -> Column:
    """EX-11 (lower case): style, factor, esg and geo of a search result, by the words it holds."""
    # Words of a search result's traits, here and below.
    active, passive = contains_any(text, ("actief",)), contains_any(text, ("passief", "indexvolgend"))
    style = F.when(active & passive, "Mixed").when(passive | contains_any(text, ("tracker",)), "Passive").when(active | contains_any(text, ("stock picking",)), "Active")
    factor = F.when(contains_any(text, ("factorbeleggen", "smart beta", "factoren")), "Factor").when(contains_any(text, ("market cap", "marktkapitalisatie")), "Non-Factor")
    esg = F.when(contains_any(text, ("esg", "duurzaam", "uitsluiting", "klimaat", "groen")), "Yes")
    some = (("Europe", ("europa", "europees")), ("North America", ("noord-amerika", "noord amerika", "verenigde staten", "usa")), ("Emerging Markets", ("opkomende markten", "emerging markets", "azië")), ("Netherlands", ("nederland",)))
    list_ = F.array_join(F.array(*[F.when(contains_any(text, ws), F.lit(label)) for label, ws in some]), ", ")
    geo = F.when(contains_any(text, ("wereldwijd", "globaal", "global")), "Global").when(F.length(list_) > 0, list_)
    return F.struct(equity_share_of_snippet(text).alias("allocation_pct"), style.alias("style"), factor.alias("factor"), esg.alias("esg"), geo.alias("geo"))


def coverage_ratio(text: Column, label: str) -> Column:
    """EX-12 (lower case): the first percentage within 150 characters of the label, if from 60 to 250; no second try."""
    return N.coverage(group(text, rf"(?:{label}).{{0,150}}?(\d{{2,3}}(?:[.,]\d)?\s*%)"))


# Labels of the three ratios.
COVERAGE = {"maanddekkingsgraad_pct": "maanddekkingsgraad|actuele dekkingsgraad|dekkingsgraad ultimo", "beleidsdekkingsgraad_pct": "beleidsdekkingsgraad", "vereiste_dekkingsgraad_pct": r"vereiste\s+dekkingsgraad"}
# Labels of the participant counts.
PARTICIPANTS = {"deelnemers_actief": "actieve deelnemers|actieven|werknemers", "deelnemers_slapers": "gewezen deelnemers|slapers|oud-werknemers", "deelnemers_gepensioneerd": "pensioengerechtigden|gepensioneerden", "deelnemers_totaal": "totaal aantal deelnemers|totaal deelnemers|totaal verzekerden"}


def participants(text: Column, label: str) -> Column:
    """EX-15 (lower case): at each label the first number of the 150 characters after, else the last of those before."""
    shape = r"(?<!\S)(\d{1,3}(?:\.\d{3})+|\d{2,6})(?!\S)"
    after, before = windows(text, label, 0, 150, own=False), windows(text, label, 150, 0, own=False)
    both = F.arrays_zip(after.alias("a"), before.alias("b"))
    return first(F.filter(F.transform(both, lambda x: F.coalesce(N.count(first(groups(x.a, shape))), N.count(F.try_element_at(groups(x.b, shape), F.lit(-1))))), lambda v: v.isNotNull()))


def cost_per_participant(text: Column) -> Column:
    """EX-16 (lower case): after a label, on its line, the first number of 2 to 4 digits that is no year."""
    tails = groups(text, r"(?d)(?:uitvoeringskosten per deelnemer|kosten per deelnemer|uitvoeringskosten|kostprijs per deelnemer)(.{0,200})")
    found = F.flatten(F.transform(tails, lambda w: groups(w, r"(?:€|eur)?\s*(\d{2,4})(?!\S)")))
    return first_where(F.transform(found, lambda s: s.try_cast("double")), lambda v: ~v.between(2010, 2030))


def total_cost(text: Column) -> Column:
    """EX-17 (lower case): after a label, on its line, the first number that can be a cost, in millions."""
    tails = groups(text, r"(?d)(?:pensioenuitvoeringskosten|totale uitvoeringskosten|uitvoeringskosten)(.{0,200})")
    found = F.flatten(F.transform(tails, lambda w: groups(w, r"(?:€|eur)?\s*(\d{1,4}[,.]\d{1,3}|\d{1,4})(?=\s|m|miljoen|duizend|$)")))
    return first(F.filter(F.transform(found, lambda s: N.total_cost(N.dotted_thousands(s))), lambda v: v.isNotNull()))


def cost_ratio(text: Column, label: str) -> Column:
    """EX-18 (lower case): per label a percentage, else basis points, else a bare ratio within 400 characters of its line.

    The first below 5, else the first, else 'Unknown'; as text with a percent sign."""
    tails = groups(text, rf"(?d)(?:{label})(.{{0,400}})")
    with_point = lambda s: F.concat(F.replace(s, F.lit(","), F.lit(".")), F.lit("%"))
    one = lambda w: F.coalesce(with_point(group(w, r"(\d+[,.]\d+)\s*%")), N.basis_points(N.comma_decimal(group(w, r"(\d+[,.]?\d*)\s*(?:bps|basispunten|basis points)"))), with_point(group(w, r"(?<!\S)([0-4][,.]\d{2,4})(?!\S)")))
    all_ = F.filter(F.transform(tails, one), lambda v: v.isNotNull())
    return F.coalesce(first_where(all_, lambda v: N.cost(v) < 5), first(all_), F.lit("Unknown"))


# Labels of the two ratios.
COST_RATIOS = {"vermogensbeheerkosten": "vermogensbeheerkosten|kosten vermogensbeheer|beheerkosten|uitvoeringskosten", "transactiekosten": "transactiekosten|kosten transactie"}


def asset_mix(text: Column, relaxed: bool = False) -> Column:
    """EX-19, relaxed EX-20 (lower case): the first share of each of three classes in windows about a word for the mix."""
    # Words for the mix and its classes, here and below.
    around = windows(text, "beleggingsmix|asset allocatie|strategische allocatie|portefeuille", 50, 200)
    tail = r"[^\d]{0,80}?(\d{1,2}[,.]\d{1,2})\s*%?" if relaxed else r"(?d).*?(\d+[,.]\d+)\s*%"
    share = lambda words: first(F.filter(F.transform(around, lambda w: group(w, f"(?:{words}){tail}")), lambda v: v.isNotNull()))
    parts = [F.concat(F.lit(f"{label}: "), share(words), F.lit("%")) for label, words in (("Aandelen", "aandelen"), ("Vastrentend", "vastrentend|obligaties"), ("Vastgoed", "vastgoed|onroerend"))]
    mix = F.concat_ws(" | ", *parts)
    return F.when(F.length(mix) > 0, mix).when(text.contains("beleggingsmix"), "Mentions mix but exact % parsed failed").otherwise("Unknown")


# Words of the asset classes.
CLASSES = {"fixed_income_pct": "vastrentend|obligatie", "real_estate_pct": "vastgoed|onroerend goed", "alternatives_pct": "alternatiev|private equity|infrastructuur|hedgefund|hedge fund"}


def asset_class(text: Column, words: str) -> Column:
    """EX-21 (any case): the first percentage within 40 characters, without digits between."""
    return N.comma_decimal(group(text, rf"(?iu)(?:{words})[^\d]{{0,40}}?{PCT}"))


def assets_of_report(text: Column) -> Column:
    """EX-22 (lower case), in billions: per label and occurrence billions, else millions, within 400 characters."""
    around = keyword_windows(text, ("belegd vermogen", "balanstotaal", "beschikbaar vermogen", "totaal belegd", "vermogen van"), 0, 400, own=False)
    one = lambda w: F.coalesce(N.dotted_thousands(group(w, rf"(?:€|eur)?\s*{AMOUNT}\s*(?:miljard|mrd|bn|billion)")), N.dotted_thousands(group(w, rf"(?:€|eur)?\s*{AMOUNT}\s*(?:miljoen|mln|m|million)")) / 1000)
    return first(F.filter(F.transform(around, one), lambda v: v.isNotNull()))


def assets_patterned(text: Column) -> Column:
    """EX-23 (lower case), in billions: eight patterns in turn; a full number is in euros."""
    # Shapes and labels of amounts, here and below.
    full, short, long = r"(\d{1,3}(?:\.\d{3}){2,3})", r"(\d{1,4}(?:,\d{1,2})?)\s*(?:mln|miljoen|milj)", r"(\d{1,3}(?:,\d{1,2})?)\s*(?:mld|miljard)"
    scale = {full: 1e9, short: 1e3, long: 1.0}
    order = [("belegd vermogen", x) for x in (full, short, long)] + [("totaal belegd vermogen", x) for x in (full, short, long)] + [("totale vermogen", x) for x in (short, long)]
    return F.coalesce(*[N.dotted_thousands(group(text, rf"{label}[^\d]{{1,30}}{x}")) / scale[x] for label, x in order])


def assets_of_lines(context: Column) -> Column:
    """EX-24 (any case), in billions: the first amount of a line that names assets and the two after it."""
    label = r"(?iu)belegd\s+vermogen|beschikbaar\s+vermogen|beleggingen[\s\w]*totaal|vermogen\s+aan\s+het\s+eind"
    shape = r"(?iu)(?:€|eur)?\s*(\d{1,3}(?:[.,]\d{3})*(?:[.,]\d+)?)\s*(miljard|mln|miljoen|mrd)?"
    pairs = F.arrays_zip(groups(context, shape, 1).alias("n"), groups(context, shape, 2).alias("u"))
    values = F.filter(F.transform(pairs, lambda x: N.billions(N.dotted_thousands(x.n), x.u)), lambda v: v.isNotNull())
    return F.when(context.rlike(label), _when(first(values), 0.01, 600))


def assets_of_snippets(text: Column) -> Column:
    """EX-25 (lower case), in billions: of all amounts after a word for assets the first from 0.01 to 600."""
    p = r"(?U)(?:vermogen|beheer|balans|eur|€)\w{0,20}\s+(\d{1,4}(?:[.,]\d{1,3})?)\s+(miljard|miljoen|mld|mln)"
    pairs = F.arrays_zip(groups(text, p, 1).alias("n"), groups(text, p, 2).alias("u"))
    return first_where(F.transform(pairs, lambda x: N.billions(N.comma_decimal(x.n), x.u)), lambda v: v.between(0.01, 600))


def assets_of_page(text: Column) -> Column:
    """EX-26 (any case), in billions to three places."""
    p = r"(?iu)(?:belegd vermogen|vermogen van|pensioenvermogen|belegde vermogen)[\s:]*(?:van\s*)?(?:ruim\s*|ongeveer\s*|circa\s*)?€?\s*([\d,.]+)\s*(miljoen|miljard|mld|mln)"
    return F.bround(N.billions(N.comma_decimal(group(text, p, 1)), group(text, p, 2)), 3)


def snippet_metrics(text: Column) -> Column:
    """EX-27 (lower case): assets in billions, and the coverage ratio where the text speaks of one."""
    aum = F.coalesce(N.dotted_thousands(group(text, rf"(?:€|eur)?\s*{AMOUNT}\s*(?:miljard|mrd|bn|billion)")), N.dotted_thousands(group(text, rf"(?:€|eur)?\s*{AMOUNT}\s*(?:miljoen|mln|m|million)")) / 1000)
    ratio = F.when(text.contains("dekkingsgraad"), _when(N.comma_decimal(group(text, r"(\d{2,3}(?:[.,]\d{1,2})?)\s*%")), 50, 200))
    return F.struct(aum.alias("aum_euro_bn"), ratio.alias("dekkingsgraad_pct"))


def largest_amount(text: Column) -> Column:
    """EX-28 (any case): the largest amount of assets named, in billions."""
    p = r"(?iu)(?:belegd|beheerd|totaal)\s+vermogen[^\d]{0,40}(\d{1,3}(?:[.,]\d{3})*(?:[.,]\d+)?)\s*(miljard|mld|mrd|miljoen|mln)?"
    pairs = F.arrays_zip(groups(text, p, 1).alias("n"), groups(text, p, 2).alias("u"))
    return F.array_max(F.transform(pairs, lambda x: N.billions(N.dotted_thousands(x.n), x.u)))


_FEE = r"(\d{1,4}(?:[.,]\d{3})*(?:[.,]\d+)?)\b"


def performance_fee(page: Column) -> Column:
    """EX-29, first pass over a page's text, in millions. Unlike the reference's, a number without points may have any digits before its decimals."""
    return N.millions(N.dutch_number(group(F.replace(page, F.lit("\n"), F.lit(" ")), rf"(?iu)(?:performance\s*fee|prestatievergoeding|prestatiebeloning)[^\d]{{0,35}}?{_FEE.replace('{1,4}', '+')}")))


def performance_fee_of_row(cells: Column) -> Column:
    """EX-29, second pass over a table's row: its last number, if the row names the fee."""
    row = F.lower(F.array_join(F.filter(cells, lambda x: F.length(x) > 0), " "))
    v = N.dutch_number(F.try_element_at(groups(row, _FEE), F.lit(-1)))
    return F.when(row.rlike("performance fee|prestatievergoeding") & (v != 0), N.millions(v))


# Index providers.
PROVIDERS = r"msci|ftse|bloomberg|barclays|dow jones|s&p|gbi|euribor|sonia|aex|eonia|iboxx|stoxx|gresb|j\.p\. morgan|jp morgan|citi|bofa|russell|refinitiv|solactive"


def benchmarks(text: Column) -> Column:
    """EX-30 (lower case): the index names of a report in order, or a sentinel."""
    tails = groups(text, r"(?d)(?:benchmark|graadmeter|referentie-index|referentie|normportefeuille|meetlat|beleggingscategorie)(.{0,500})")
    near = F.flatten(F.transform(tails, lambda w: groups(w, rf"((?:{PROVIDERS})\b[a-z0-9\-\s()+&,.]+?(?:index|return|tr|nr|\b[0-9]%|hedged|unhedged|benchmark|maatstaf))")))
    sweep = groups(text, rf"((?:{PROVIDERS})\b[a-z0-9\-\s(),.]+?(?:index|return|benchmark|tr|nr))")
    names = F.transform(F.concat(near, sweep), lambda x: title_case(strip(x)))
    kept = F.array_sort(F.array_distinct(F.filter(names, lambda x: (F.length(x) > 5) & (F.length(x) < 80))))
    return F.when(F.size(kept) > 0, F.array_join(kept, ", ")).otherwise("None explicitly identified")


def report_year(text: Column) -> Column:
    """EX-31 (lower case): beside a word for the report, else the year most often named, the earlier named if equal."""
    word = "jaarverslag|annual report"
    count = lambda years: F.transform(F.array_distinct(years), lambda y: F.struct((-F.size(F.filter(years, lambda x: x == y))).alias("n"), F.array_position(years, y).alias("i"), y.alias("y")))
    counted = let(groups(text, r"(?U)\b(202[0-4])\b"), count)
    return F.coalesce(group(text, rf"(?d)(?:{word}).{{0,15}}(202[0-4])"), group(text, rf"(?d)(202[0-4]).{{0,15}}(?:{word})"), first(F.array_sort(counted)).y).cast("int")


def indexation_of_window(window: Column, people: str) -> Column:
    """EX-32 (lower case): the percentage after the group's word, else before it."""
    return F.coalesce(group(window, rf"(?:{people})[^\d%]*?(\d+[,.]\d+)\s*%"), group(window, rf"(\d+[,.]\d+)\s*%[^\d%]*?(?:{people})"))


def indexation_of_site(text: Column) -> Column:
    """EX-33 (any case): the first percentage from 0 to 10 after a word for a rise."""
    return N.first_between(groups(text, r"(?iud)(?:verhog(?:ing|en)|indexatie|toeslag|verhoogd).*?(?:met\s*)?([\d,.]+)\s*%"), 0, 10)


# Known organisations, and words that show their part.
ADMINISTRATORS = ("APG", "PGGM", "AZL", "TKP", "MN", "Appel", "Centric", "Achmea", "Syntrus", "Blue Sky Group", "DCP", "Visma", "AON")
FIDUCIARIES = ("Achmea IM", "BlackRock", "Goldman Sachs", "MN", "APG", "PGGM", "Robeco", "Kempen", "Cardano", "Russell", "Willis Towers Watson", "Aegon", "NNIP", "BMO", "F&C", "Baudet")
ADMINISTRATOR_WORDS = ("pensioenuitvoerder", "uitvoeringsorganisatie", "uitvoering van de pensioenregeling", "administratie", "uitvoerder", "pensioenadministratie")
FIDUCIARY_WORDS = ("fiduciair", "vermogensbeheerder", "integraal vermogensbeheerder", "uitbesteding van het vermogensbeheer", "extern beheer")
_ENTITY = r".*?(?:is|bij)\s+([A-Z][A-Za-z\s&]+?)(?=\.|,| en| is| verzorgt)"


def _entity(text: Column, label: str, known: tuple[str, ...], words: tuple[str, ...]) -> Column:
    # What follows the first label is searched once, and only names that the text has are looked at.
    said = let(F.get(F.split(text, rf"(?ius)(?:{label})", 2), 1), lambda rest: F.replace(strip(group(rest, rf"(?ius)^{_ENTITY}")), F.lit("\n"), F.lit(" ")))
    named = F.transform(F.regexp_extract_all(text, F.lit(rf"(?iud)\b({'|'.join(map(quote, known))})\b"), F.lit(1)), F.lower)
    around = lambda k: F.lower(F.call_function("regexp_extract", text, F.concat(F.lit(r"(?iud)(.{0,50}\b"), F.replace(k, F.lit("&"), F.lit(r"\&")), F.lit(r"\b.{0,50})")), F.lit(1)))
    beside = let(named, lambda names: F.get(F.filter(F.array(*map(F.lit, known)), lambda k: F.array_contains(names, F.lower(k)) & contains_any(around(k), words)), 0))
    return let(said, lambda s: F.coalesce(F.when((F.length(s) > 2) & (F.length(s) < 50), s), beside))


def administrator(text: Column) -> Column:
    """EX-34: whoever the text says administers, else the first known one named beside a word for it."""
    return _entity(text, "pensioenuitvoerder|uitvoeringsorganisatie|pensioenadministratie|administrateur", ADMINISTRATORS, ADMINISTRATOR_WORDS)


def fiduciary(text: Column) -> Column:
    """EX-34."""
    return _entity(text, "fiduciair(?: beheerder)?|integraal vermogensbeheerder|externe vermogensbeheerder", FIDUCIARIES, FIDUCIARY_WORDS)


def managed_internally(text: Column) -> Column:
    """EX-34: 'Ja' if a word for it stands without a denial in the 40 characters about its first mention."""
    context = lambda k: group(text, rf"(?iud)(.{{0,40}}\b{quote(k)}\b.{{0,40}})")
    yes = [F.coalesce(~context(k).rlike(r"(?iu)\b(geen|niet|uitbesteed)\b"), F.lit(False)) for k in ("intern beheer", "eigen beheer", "zelfstandig beheer", "binnen het fonds")]
    return F.when(reduce(lambda a, b: a | b, yes), "Ja").otherwise("Nee")


def protection(text: Column) -> Column:
    """EX-35: sentences on protection with their neighbours, up to four different ones, or 'Unknown'."""
    sentences = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), r"(?<=[.!?]) +")
    # Words of protection, here and below.
    words = r"(?U)\b(optie|opties|swaptions|swaption|afdekken|afdekking)\b|\bneerwaarts|\bdalingen\b|\bkoersdaling"
    around = F.transform(sentences, lambda s, i: F.when(F.lower(s).rlike(words), squeeze(F.array_join(F.slice(sentences, F.greatest(i, F.lit(1)), F.when(i == 0, 2).otherwise(3)), " "))))

    def fits(c: Column) -> Column:
        low = F.lower(c)
        hedge = low.contains("renterisico afgedekt") & ~low.rlike("optie|swaption")
        return ~low.rlike("persoons|privacy|avg") & low.rlike("optie|swaption|neerwaarts|risico|bescherm|afdek") & ~hedge

    kept = F.slice(F.array_distinct(F.filter(around, lambda c: c.isNotNull() & fits(c))), 1, 4)
    return F.when(F.size(kept) > 0, F.array_join(kept, " | ")).otherwise("Unknown")


def sfdr_class(text: Column) -> Column:
    """EX-36 (any case): the first article named decides, else a colour."""
    article = group(text, r"(?iu)\b((?:artikel\s*|art\.\s*)[89])\s*(?:van de\s*)?(?:sfdr)?\b")
    light, dark = F.lit("Artikel 8 (Lichtgroen)"), F.lit("Artikel 9 (Donkergroen)")
    return F.when(article.contains("8"), light).when(article.contains("9"), dark).when(text.rlike(r"(?iu)\blichtgroen"), light).when(text.rlike(r"(?iu)\bdonkergroen"), dark)


# Kinds of exclusion, in the order of the cell.
EXCLUSIONS = (
    ("Tabak", "tabak|sigaretten"),
    ("Controversiële Wapens", "controversiële wapens|omstreden wapens|kernwapens|clustermunitie"),
    ("Kolen / Fossiel", "kolen|steenkolen|teerzand|fossiele brandstoffen"),
    ("Gokken", "gokken|kansspelen"),
    ("Mensenrechtenschendingen", "kinderarbeid|mensenrechten|global compact"),
)


def exclusions(text: Column) -> Column:
    """EX-37 (any case)."""
    found = F.concat_ws(", ", *[F.when(F.lower(text).rlike(rf"(?U)\b({words})\b"), F.lit(kind)) for kind, words in EXCLUSIONS])
    return F.when(F.length(found) > 0, found)


def co2_goal(text: Column) -> Column:
    """EX-38 (any case): topic, share, year; else reduction, share, topic, year."""
    one = r"(?iud)(?:co2|co₂|klimaat|broeikasgassen|emissie).{0,50}?(\d{1,3})\s*%\s*(?:reductie|vermindering|lager).{0,40}?(20[2-5][0-9])"
    two = r"(?iud)(?:reductie|vermindering).{0,30}?(\d{1,3})\s*%.{0,40}?(?:co2|co₂|broeikasgassen|emissie).{0,40}?(20[2-5][0-9])"
    said = lambda p: F.concat(group(text, p, 1), F.lit("% reductie in "), group(text, p, 2))
    return F.coalesce(said(one), said(two))


def transition_row(line: Column) -> Column:
    """EX-39 (any case): the six cells of a row of the transition overview, null for other lines."""
    p = r"(?iu)^(.+?)\s+(202[4-8](?:\s*\([a-z]+\))?|onbekend)\s+(?:Van.*?naar.*?|Pensioenen.*?)?(solidair|flexibel(?:\s*\+\s*rdr)?|biedt beide aan|onbekend)\s+(ja|nee|onbekend)\s+([\d,.]+)([A-Za-z].*)$"
    row = strip(line)
    cell = lambda i: strip(F.regexp_extract(row, p, i))
    cells = F.struct(cell(1).alias("name"), cell(2).alias("date"), cell(3).alias("contract"), cell(4).alias("invaren"), N.thousands(F.regexp_extract(row, p, 5)).alias("deelnemers_k"), cell(6).alias("uitvoerder"))
    return F.when(row.rlike(p) & ~row.rlike("Naam fonds|Deelnemers"), cells)


def fund_line(line: Column) -> Column:
    """EX-41: 'header', 'fund' or null for a line of a directory of funds."""
    t = strip(line)
    header = F.lower(t).rlike("industry-wide|sector|corporate|company|professional|apf|general pension fund|mandatory") & (F.length(t) < 50) & ~t.contains(":")
    fund = t.rlike("Pensioen|APF$") | (t.contains("(") & t.contains(")") & (F.length(t) < 60))
    return F.when(t == "", None).when(header, "header").when(fund, "fund")


# Roles on a board, in the order in which they are looked for.
ROLES = ("voorzitter", "bestuurslid", "directeur", "ceo", "cfo", "cro", "secretaris", "penningmeester", "uitvoerend bestuurder", "hoofd", "manager", "lid bestuur", "lid verantwoordingsorgaan", "lid raad van toezicht", "sleutelfunctiehouder", "directie")


def person(block: Column) -> Column:
    """EX-42: the name in a text block that names a role: the first part of 2 to 4 words in the shape of a name."""
    role = first(F.filter(F.array(*map(F.lit, ROLES)), lambda r: F.lower(block).contains(r)))
    parts = F.transform(F.split(block, r"[:|,\-(]"), lambda p: strip(F.replace(p, F.lit(")"), F.lit(""))))
    shape = r"^([A-Z]\.?\s?)+[A-Z][a-z]+"
    fits = lambda p: F.size(F.split(p, r"\s+")).between(2, 4) & ~F.lower(p).contains(role) & (p.rlike(shape) | ((title_case(p) == p) & p.rlike(r"\p{L}")))
    name = first_where(parts, fits)
    return F.when(F.length(block).between(5, 150) & role.isNotNull() & F.length(name).between(6, 39), F.struct(name.alias("name"), F.substring(block, 1, 100).alias("role")))


def is_report_link(href: Column, text: Column, words: tuple[str, ...] = ("jaarverslag", "annual report", "jaarrekening"), years: tuple[str, ...] = ("2024", "2023", "2022", "2021")) -> Column:
    """EX-46: a PDF that one of the words names, of a recent year, or called jaarverslag with no older year."""
    h, t = F.lower(href), F.lower(text)
    pdf = h.endswith(".pdf") | h.contains(".pdf?") | h.contains("/pdf/")
    either = lambda xs: contains_any(h, xs) | contains_any(t, xs)
    return pdf & either(words) & (either(years) | (h.contains("jaarverslag") & ~h.rlike("2018|2019|2020")))


def is_esg_link(href: Column, text: Column) -> Column:
    """EX-47."""
    both = F.concat(F.lower(href), F.lit("\n"), F.lower(F.coalesce(text, F.lit(""))))
    return F.lower(href).contains(".pdf") & both.rlike("duurzaam|esg|maatschappelijk|mvo") & both.rlike("verslag|rapport")


def is_transition_link(href: Column, url: Column) -> Column:
    """EX-48."""
    return F.lower(href).contains(".pdf") & F.lower(href).contains("transitie") & ~url.rlike("google|mailto:")


def link_type(url: Column, page: Column) -> Column:
    """EX-49: document by ending; news by path, if it is an article's and not the page itself; else null."""
    from fundlake.functions.names import depth

    low = F.lower(url)
    return F.when(low.rlike(r"\.(pdf|docx|xlsx|doc)$"), "document").when(low.rlike("/nieuws/|/actueel/") & (url != page) & (depth(url) > 1), "news")
