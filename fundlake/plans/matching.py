"""Joins of names, files and rows, each against the same rule in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions import likeness
from fundlake.operators import curation, resolve
from fundlake.plans.registry import Tables, query


@query("SELECT s_name AS name, n_name AS style, s_acctbal AS pct FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def q_funds_with_strategy(t: Tables) -> DataFrame:
    """JN-01."""
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("name"), F.col("n_name").alias("style"), F.col("s_acctbal").alias("pct"))


@query("SELECT c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%' AND c_acctbal > 0 AND o_totalprice IS NOT NULL")
def q_documents_of_funds(t: Tables) -> DataFrame:
    """JN-06: a join under several conditions on either side, each applied before it."""
    docs = t.orders.where((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").startswith("1") & F.col("o_totalprice").isNotNull())
    return docs.join(t.customer.where("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_orderkey")


_FILES = "(SELECT CASE WHEN o_custkey % 3 > 0 THEN 'data/' || o_custkey || '_' ELSE 'data/verslag_' || o_custkey || '-' END || year(o_orderdate) || '.pdf' AS path FROM orders)"


def _files(t: Tables) -> DataFrame:
    """Reports; only some are named by a fund's id."""
    key = F.col("o_custkey").cast("string")
    head = F.when(F.col("o_custkey") % 3 > 0, F.concat(F.lit("data/"), key, F.lit("_"))).otherwise(F.concat(F.lit("data/verslag_"), key, F.lit("-")))
    return t.orders.select(F.concat(head, F.year("o_orderdate").cast("string"), F.lit(".pdf")).alias("path"))


def _funds(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


@query(f"SELECT c_custkey AS id, min(path) AS path FROM {_FILES}, customer WHERE starts_with(path, 'data/' || c_custkey || '_') GROUP BY 1")
def q_first_file(t: Tables) -> DataFrame:
    """JN-13, SRT-12: the first file whose name begins with a fund's id; the id is read from the name, so this is a keyed join."""
    return resolve.first_file(_funds(t), _files(t))


@query(f"SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 7 <> 0 AND EXISTS (SELECT 1 FROM {_FILES} WHERE starts_with(path, 'data/' || c_custkey || '_'))")
def q_unextracted(t: Tables) -> DataFrame:
    """JN-12, DQ-04: funds with a report file and no value taken from it."""
    return curation.unextracted(_funds(t), t.customer.where("c_custkey % 7 = 0").select(F.col("c_custkey").alias("fund_id")), _files(t))


# Names: words of parts, in the forms that the sources use, and names that nothing is part of.
_NAMED = "(SELECT p_partkey AS id, 'Stichting Pensioenfonds ' || p_name || ' ' || p_partkey AS name, p_partkey % 3 AS ratio FROM part UNION ALL SELECT 1000000000 + s_suppkey, s_name, 1 FROM supplier)"


def _named(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    rows = t.part.select(k.alias("id"), F.concat(F.lit("Stichting Pensioenfonds "), "p_name", F.lit(" "), k.cast("string")).alias("name"), (k % 3).alias("ratio"))
    return rows.union(t.supplier.select(F.lit(1000000000) + F.col("s_suppkey"), "s_name", F.lit(1).cast("long")))


_LINES = "(SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN 'overgang ' || replace(p_name, ' ', '') || p_partkey || ' in 2026' ELSE p_name || ' en meer' END AS name FROM part)"


def _lines(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(F.when(k % 2 == 0, F.concat(F.lit("overgang "), F.replace("p_name", F.lit(" "), F.lit("")), k.cast("string"), F.lit(" in 2026"))).otherwise(F.concat("p_name", F.lit(" en meer"))).alias("name")).distinct()


def _packed(x: str, closed: bool = False) -> str:
    out = f"replace(replace(lower({x}), 'pensioenfonds', ''), 'stichting', '')"
    return f"replace({f"replace({out}, '(gesloten)', '')" if closed else out}, ' ', '')"


@query(f"""WITH f AS (SELECT id, name, {_packed('name')} AS p FROM {_NAMED}), w AS (SELECT name, {_packed('name')} AS q, replace(lower(split_part(name, ' ', 1)), 'kring', '') AS core FROM {_LINES}),
a AS (SELECT w.name, min(f.id) AS id FROM w JOIN f ON length(p) > 4 AND contains(q, p) GROUP BY 1), b AS (SELECT w.name, min(f.id) AS id FROM w JOIN f ON length(core) > 3 AND contains(lower(f.name), core) GROUP BY 1)
SELECT w.name, coalesce(a.id, b.id) AS id FROM w LEFT JOIN a USING (name) LEFT JOIN b USING (name)""")
def q_match_planning(t: Tables) -> DataFrame:
    """JN-16: the fund's packed name in the line, else the line's first word in the fund's name."""
    return resolve.match_planning(_lines(t), _named(t))


_SHORT = "(SELECT DISTINCT split_part(p_name, ' ', 2) || ' ' || p_partkey % 40 AS name FROM part)"


@query(f"SELECT w.name, f.id FROM {_SHORT} w JOIN {_NAMED} f ON length(lower(w.name)) > 3 AND (contains(lower(w.name), lower(f.name)) OR contains(lower(f.name), lower(w.name)))")
def q_match_short(t: Tables) -> DataFrame:
    """JN-17, JN-22: all pairs of which one name holds the other."""
    wanted = t.part.select(F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "), (F.col("p_partkey") % 40).cast("string")).alias("name")).distinct()
    return resolve.match_short(wanted, _named(t))


@query(f"SELECT w.name FROM {_SHORT} w WHERE NOT EXISTS (SELECT 1 FROM {_NAMED} f WHERE ratio <> 0 AND (contains(lower(w.name), lower(f.name)) OR contains(lower(f.name), lower(w.name))))")
def q_unmatched(t: Tables) -> DataFrame:
    """JN-19: names that no fund with a ratio goes with."""
    wanted = t.part.select(F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "), (F.col("p_partkey") % 40).cast("string")).alias("name")).distinct()
    return resolve.unmatched(wanted, _named(t))


_ROWS = "(SELECT p_partkey AS row_no, lower(p_name) || ' ' || p_partkey AS label FROM part)"


@query(f"""WITH r AS (SELECT * FROM {_ROWS}), f AS (SELECT id, lower(name) AS n FROM {_NAMED}),
a AS (SELECT id, row_no, 0 AS rule FROM f JOIN (VALUES ('ring', 'red widget'), ('bolt', 'small')) v(in_name, in_row) ON contains(n, in_name) JOIN r ON contains(label, in_row)),
p AS (SELECT id, trim(replace(replace(n, 'pensioenfonds', ''), 'stichting', '')) AS c FROM f),
b AS (SELECT id, row_no, 1 AS rule FROM p JOIN r ON label = c OR (length(label) > 3 AND contains(c, label)) OR (length(c) > 3 AND contains(label, c))),
x AS (SELECT *, min(rule) OVER (PARTITION BY id) AS m FROM (SELECT * FROM a UNION ALL SELECT * FROM b))
SELECT id, 'c' || max(row_no) AS cell FROM x WHERE rule = m GROUP BY id""")
def q_row_alias(t: Tables) -> DataFrame:
    """JN-20, JN-21: rows of a page by alias, else by containment; the last row counts."""
    rows = t.part.select(F.col("p_partkey").alias("row_no"), F.concat(F.lower("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("label"), F.array(F.concat(F.lit("c"), F.col("p_partkey").cast("string"))).alias("cells"))
    aliases = t.spark.createDataFrame([("ring", "red widget"), ("bolt", "small")], "in_name string, in_row string")
    return curation.by_row_alias(_named(t).select("id", "name"), rows, aliases).select("id", F.get("cells", 0).alias("cell"))


@query(f"SELECT w.name, min(f.id) AS id FROM {_SHORT} w LEFT JOIN {_NAMED} f ON f.name ILIKE '%' || w.name || '%' GROUP BY 1")
def q_like_first(t: Tables) -> DataFrame:
    """JN-23: the first row whose name has the words, in any case; null if none."""
    wanted = t.part.select(F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "), (F.col("p_partkey") % 40).cast("string")).alias("name")).distinct()
    return resolve.match_like(wanted, _named(t))


_UNIQUE = "(SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN 'Stichting Pensioenfonds ' || p_name || ' ' || p_partkey % 50 WHEN 1 THEN upper('Stichting Pensioenfonds ' || p_name || ' ' || p_partkey % 50) WHEN 2 THEN split_part(p_name, ' ', 2) || ' ' || p_partkey % 50 || ' (oud)' ELSE split_part(p_name, ' ', 2) || ' ' || p_partkey % 50 || ' / niets' END AS name FROM part)"


def _only(part: str) -> str:
    return f"SELECT name, min(id) AS id FROM (SELECT w.name, f.id FROM w JOIN f ON length({part}) > 0 AND contains(lower(f.fund), lower({part}))) GROUP BY name HAVING count(*) = 1"


@query(f"""WITH w AS (SELECT * FROM {_UNIQUE}), f AS (SELECT id, name AS fund FROM {_NAMED}),
r AS (SELECT w.name, min(f.id) AS id, 0 AS rule FROM w JOIN f ON w.name = f.fund GROUP BY 1 UNION ALL SELECT *, 1 FROM ({_only('w.name')}) UNION ALL SELECT w.name, min(f.id), 2 FROM w JOIN f ON lower(w.name) = lower(f.fund) GROUP BY 1
  UNION ALL SELECT *, 3 FROM ({_only("CASE WHEN contains(w.name, '(') THEN rtrim(split_part(w.name, '(', 1)) END")})
  UNION ALL SELECT name, arg_min(id, pos), 4 FROM (SELECT name, pos, min(id) AS id FROM (SELECT name, pos, f.id FROM (SELECT name, unnest(range(len(string_split(name, '/')))) AS pos, trim(unnest(string_split(name, '/'))) AS part FROM w WHERE contains(name, '/')) JOIN f ON contains(lower(fund), lower(part))) GROUP BY 1, 2 HAVING count(*) = 1) GROUP BY 1)
SELECT w.name, arg_min(r.id, r.rule) AS id FROM w LEFT JOIN r USING (name) GROUP BY 1""")
def q_match_unique(t: Tables) -> DataFrame:
    """JN-24: a cascade: exact, contained in one only, in any case, before a bracket, between slashes."""
    k, tail = F.col("p_partkey"), (F.col("p_partkey") % 50).cast("string")
    full = F.concat(F.lit("Stichting Pensioenfonds "), "p_name", F.lit(" "), tail)
    short = F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "), tail)
    wanted = t.part.select(F.when(k % 4 == 0, full).when(k % 4 == 1, F.upper(full)).when(k % 4 == 2, F.concat(short, F.lit(" (oud)"))).otherwise(F.concat(short, F.lit(" / niets"))).alias("name")).distinct()
    return resolve.match_unique(wanted, _named(t))


@query(f"WITH m AS (SELECT w.name, min(f.id) AS id FROM {_SHORT} w LEFT JOIN {_NAMED} f ON contains(lower(f.name), lower(w.name)) GROUP BY 1) SELECT m.name, f.name AS fund, f.ratio FROM m LEFT JOIN {_NAMED} f ON m.id = f.id")
def q_enriched(t: Tables) -> DataFrame:
    """JN-26: each row with the columns of the fund found for it, nulls where none is."""
    wanted = t.part.select(F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "), (F.col("p_partkey") % 40).cast("string")).alias("name")).distinct()
    found = resolve.match_like(wanted, _named(t))
    return found.join(_named(t).withColumnRenamed("name", "fund"), "id", "left").select("name", "fund", "ratio")


_PDFS = "(SELECT 'data/' || replace(p_name, ' ', '-') || '-' || p_partkey || '.pdf' AS path FROM part)"
_WORDS = "(SELECT id, list_filter(w, lambda x: length(x) > 2) AS two, list_filter(w, lambda x: length(x) > 4) AS four FROM (SELECT id, regexp_split_to_array(lower(name), '[^a-z0-9]+') AS w FROM (SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN p_name || ' bv' WHEN 1 THEN p_name || ' ' || p_brand || ' bv' ELSE p_name || ' ' || p_partkey END AS name FROM part UNION ALL SELECT 1000000000 + s_suppkey, s_name FROM supplier)))"


@query(f"""WITH c AS (SELECT id, path, CASE WHEN len(two) > 0 AND len(list_filter(two, lambda w: NOT contains(path, w))) = 0 THEN 0 WHEN len(list_filter(four, lambda w: contains(path, w))) > 0 THEN 1 END AS rank FROM {_WORDS}, {_PDFS})
SELECT id, arg_min(path, struct_pack(r := rank, p := path)) AS path FROM c WHERE rank IS NOT NULL GROUP BY id""")
def q_match_file(t: Tables) -> DataFrame:
    """JN-27: the file with all of a name's words, else with any long one."""
    k, key = F.col("p_partkey"), F.col("p_partkey").cast("string")
    files = t.part.select(F.concat(F.lit("data/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), key, F.lit(".pdf")).alias("path"))
    name = F.when(k % 3 == 0, F.concat("p_name", F.lit(" bv"))).when(k % 3 == 1, F.concat("p_name", F.lit(" "), "p_brand", F.lit(" bv"))).otherwise(F.concat("p_name", F.lit(" "), key))
    funds = t.part.select(k.alias("id"), name.alias("name")).union(t.supplier.select(F.lit(1000000000) + F.col("s_suppkey"), "s_name"))
    return resolve.match_file(funds, files)


@query("""WITH f AS (SELECT s_suppkey AS id, 'Fonds ' || s_name AS name FROM supplier), s AS (SELECT 'pensioenfonds fonds ' || s_name AS name, s_acctbal AS aum FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT 'Nieuw ' || n_name, n_nationkey::DOUBLE FROM nation)
SELECT f.id, f.name, CASE WHEN f.id % 2 = 0 THEN s.aum ELSE -1 END AS aum, NULL::VARCHAR AS data_source FROM f LEFT JOIN s ON s.name = 'pensioenfonds ' || lower(substr(f.name, 1, 1)) || substr(f.name, 2)
UNION ALL SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY name), name, aum, 'DNB Appendix' FROM s WHERE name LIKE 'Nieuw%'""")
def q_merge_regulator(t: Tables) -> DataFrame:
    """IMP-03: a regulator's sheet updates the funds it names and adds the others under new ids."""
    funds = t.supplier.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("Fonds "), "s_name").alias("name"), F.lit(-1.0).alias("aum"), F.lit(None).cast("string").alias("data_source"))
    sheet = t.supplier.where("s_suppkey % 2 = 0").select(F.concat(F.lit("pensioenfonds fonds "), "s_name").alias("name"), F.col("s_acctbal").alias("aum"))
    fresh = t.nation.select(F.concat(F.lit("Nieuw "), "n_name").alias("name"), F.col("n_nationkey").cast("double").alias("aum"))
    return curation.merge_regulator(funds, sheet.union(fresh), ["aum"])


@query("""SELECT p_partkey, CASE WHEN p_partkey = 3 THEN 99.0 WHEN p_name ILIKE '%ring%' THEN 7.0 ELSE p_retailprice END AS price FROM part""")
def q_manual_patches(t: Tables) -> DataFrame:
    """IMP-02: patches by pattern, then by key."""
    from fundlake.operators import merge

    rows = t.part.select("p_partkey", "p_name", F.col("p_retailprice").alias("price"))
    liked = merge.update_like(rows, t.spark.createDataFrame([("ring", 7.0, 1)], "pattern string, value double, ord int"), "p_name", "price")
    return merge.update(liked, t.spark.createDataFrame([(3, 99.0)], "p_partkey long, price double"), ["p_partkey"], ["price"]).select("p_partkey", "price")


@query("SELECT p_partkey, 2.0 * length(p_name) / (2 * length(p_name) + p_partkey % 9) AS score FROM part")
def q_similarity(t: Tables) -> DataFrame:
    """STR-17, UDF-03: the matching-blocks ratio; where one name goes on after the other it is known in closed form."""
    longer = F.concat(F.upper("p_name"), F.expr("repeat('#', CAST(p_partkey % 9 AS INT))"))
    return t.part.select("p_partkey", likeness.ratio(F.col("p_name"), longer).alias("score"))
