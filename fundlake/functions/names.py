"""Names of funds: cleaning, categories, states; and addresses of their sites."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.functions.text import strip

# What is taken out of a name, in this order.
NAME_TOKENS = ("pensioenfonds", "stichting", "(gesloten)", "(wordt gesloten)", "bedrijfstak", "spf")
# English category to Dutch.
CATEGORIES = {
    "Corporate": "Bedrijf",
    "Occupational": "Beroep",
    "Industry-wide": "Tak",
    "Sector": "Tak",
    "tak": "Tak",
    "General": "APF",
    "Pension Insurers (Pensioenverzekeraars)": "Verzekeraar",
    "Pension Insurers": "Verzekeraar",
}
# Sites that are not a fund's own.
BAD_DOMAINS = (
    "wikipedia.org", "dnb.nl", "pensioenfederatie.nl", "companyinfo.nl", "kvk.nl", "youtube.com", "facebook.com", "linkedin.com", "overheid.nl",
    "werkenbij", "vacatures", "rtlnieuws", "nu.nl", "nrc.nl", "fd.nl", "volkskrant", "telegraaf", "nos.nl", "rijksoverheid.nl", "toezicht.dnb.nl",
    "radar.avrotros.nl", "wijzeringeldzaken.nl", "pensioenklokkenluider.nl", "pensioenkijker.nl", "pensioenduidelijkheid.nl", "bing.com", "google.com",
    "glassdoor.", "indeed.",
)
# Words of a name that say nothing.
GENERIC_WORDS = ("nederland", "stichting", "pensioenfonds", "algemeen", "personeel", "en")


def remove(c: Column, tokens: tuple[str, ...]) -> Column:
    for t in tokens:
        c = F.replace(c, F.lit(t), F.lit(""))
    return c


def clean_name(c: Column) -> Column:
    """NRM-01."""
    return strip(remove(F.lower(c), NAME_TOKENS))


def packed_name(c: Column, closed: bool = True) -> Column:
    """NRM-02: without spaces; closed: without the mark of closed funds too."""
    return remove(F.lower(c), ("pensioenfonds", "stichting", *(("(gesloten)",) if closed else ()), " "))


def short_label(c: Column) -> Column:
    """PRJ-10: what stands from the first parenthesis to the last goes, then the prefix."""
    return F.replace(F.replace(F.regexp_replace(c, r" \(.*\)", ""), F.lit("Stichting "), F.lit("")), F.lit("Pensioenfonds "), F.lit(""))


def dutch_category(c: Column) -> Column:
    """NRM-04: unknown categories stay."""
    pairs = [F.lit(x) for pair in CATEGORIES.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def guessed_category(name: Column) -> Column:
    """NRM-05."""
    low = F.lower(name)
    return F.when(low.rlike(r"kring|\(stap\)|\(hnp|\(de nationale\)|\(unilever\)", ), "APF").when(low.rlike("bpf|bpl|levensmiddelen|binnenvaart"), "Tak").when(low.contains("iff"), "Bedrijf")


def blank(c: Column) -> Column:
    """Null, empty, or one of the words that stand for it."""
    return c.isNull() | F.lower(strip(c)).isin("", "nan", "none")


def imported_category(own: Column, source: Column, new: Column) -> Column:
    """NRM-06: a new category, by its standard name, replaces a blank one or one from the regulator's list."""
    low = F.lower(new)
    standard = F.when(low.contains("bedrijf"), "Bedrijfstakpensioenfonds").when(low.contains("beroep"), "Beroepspensioenfonds").when(low.contains("onderneming"), "Ondernemingspensioenfonds").when(low.contains("algemeen"), "APF").otherwise(new)
    usable = new.isNotNull() & (F.length(new) > 0) & (low != "nan")
    return F.when(usable & (blank(own) | source.eqNullSafe(F.lit("DNB Appendix"))), standard).otherwise(own)


def is_closed(name: Column) -> Column:
    """FLT-18."""
    return F.lower(name).rlike(r"\(gesloten\)|wordt gesloten|liquidatie")


def has_website(c: Column) -> Column:
    """FLT-03."""
    return c.isNotNull() & (c != "") & (c != "None")


def with_scheme(url: Column, scheme: str = "https://") -> Column:
    """URL-02."""
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(scheme), url))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def depth(url: Column) -> Column:
    """URL-06: how many parts a path has."""
    return F.size(F.filter(F.split(path(url), "/"), lambda x: x != ""))


def resolve(base: Column, href: Column) -> Column:
    """URL-01: an address as seen from a page. Dot segments at the start of a relative path are walked up."""
    scheme, root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)$", "$1/")
    folder = F.regexp_extract(folder, r"^(.*/)", 1)
    plain = F.concat(folder, F.regexp_replace(href, r"^(\./)+", ""))
    ups = F.length(F.regexp_extract(href, r"^((?:\.\./)+)", 1)) / 3
    parts = F.split(F.regexp_replace(F.substring(folder, F.length(root) + 2, 1 << 30), "/$", ""), "/")
    kept = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - ups.cast("int"), F.lit(0))), "/")
    up = F.concat(root, F.lit("/"), F.when(F.length(kept) > 0, F.concat(kept, F.lit("/"))).otherwise(""), F.regexp_replace(href, r"^(\.\./)+", ""))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), href))
        .when(href == "", base)
        .when(href.startswith("../"), up)
        .otherwise(plain)
    )


def site_score(url: Column, name: Column) -> Column:
    """MATH-06: how likely an address is the site of a fund of this name."""
    low, domain = F.lower(url), F.lower(host(url))
    words = F.split(F.translate(F.lower(name), "-/()&", "  "), r"\s+")
    own = F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*GENERIC_WORDS))
    hits = F.size(F.filter(own, lambda w: domain.contains(w)))
    shape = F.when(path(url).isin("", "/", "/nl", "/home"), 15).otherwise(-2 * F.size(F.split(path(url), "/")))
    bad = F.exists(F.array(*map(F.lit, BAD_DOMAINS)), lambda b: low.contains(b))
    score = F.when(domain.endswith(".nl"), 10).otherwise(0) + F.when(domain.contains("pensioen"), 20).otherwise(0) + 30 * hits + shape
    return F.when(bad, -100).when(low.contains("pdf") | low.contains("nieuws"), -50).otherwise(score)
