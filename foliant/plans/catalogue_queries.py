"""Registered queries of the catalogue engine on the driver's tables, and their SQL.

regions, nations, suppliers, parts and line items stand for ideas, topics,
authors, works and references; documents for texts. Where no table has the
marked text that an operator reads, both sides build it from the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import parsing as P
from foliant.functions import similarity as S
from foliant.functions import text as T
from foliant.operators import build
from foliant.operators import catalogue as C
from foliant.operators import entities as E
from foliant.operators import folds, layout, search
from foliant.operators import segmentation as G
from foliant.sources import files, shared
from foliant.streaming import watch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Counts and reads.


@_register("""
SELECT r_regionkey AS number, r_name AS name,
  (SELECT count(*) FROM nation n WHERE n.n_regionkey = r.r_regionkey) AS n_topics,
  (SELECT count(*) FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey WHERE n.n_regionkey = r.r_regionkey) AS n_refs
FROM region r ORDER BY number""")
def catalog_parent_counts(spark, sf_dir):
    nation, supplier = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "supplier")
    in_region = supplier.join(nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
    out = C.counted(_t(spark, sf_dir, "region").select("r_regionkey", "r_name"), "r_regionkey", nation, "n_regionkey", "n_topics")
    out = C.counted(out, "r_regionkey", in_region, "n_regionkey", "n_refs")
    return out.select(F.col("r_regionkey").alias("number"), F.col("r_name").alias("name"), "n_topics", "n_refs").orderBy("number")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_parent_counts(spark, sf_dir)


@_register("""
WITH t AS (SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 3 = 0 THEN (n_nationkey // 3 + 1)::VARCHAR ELSE (n_nationkey // 3 + 1)::VARCHAR || chr(96 + n_nationkey % 3) END AS label FROM nation)
SELECT label, n_name AS title, CASE WHEN regexp_matches(label, '[a-z]$') THEN regexp_extract(label, '^[0-9]+') END AS parent_label,
  (SELECT count(*) FROM supplier s WHERE s.s_nationkey = t.n_nationkey) AS n_refs,
  row_number() OVER (ORDER BY regexp_matches(label, '[a-z]$'), regexp_extract(label, '^[0-9]+')::INT, label)::INT AS ord FROM t""")
def catalog_child_detail(spark, sf_dir):
    from pyspark.sql import Window

    k = F.col("n_nationkey")
    number = (F.floor(k / 3) + 1).cast("string")
    label = F.when(k % 3 == 0, number).otherwise(F.concat(number, F.chr(96 + k % 3)))
    topics = _t(spark, sf_dir, "nation").select("n_nationkey", label.alias("label"), F.col("n_name").alias("title"))
    out = C.counted(topics, "n_nationkey", _t(spark, sf_dir, "supplier"), "s_nationkey", "n_refs")
    # a topic list is short: its order is one window
    return out.select("label", "title", P.parent_label(F.col("label")).alias("parent_label"), "n_refs", F.row_number().over(Window.orderBy(*C.order_key(F.col("label")))).alias("ord"))


@_register("""
SELECT l_orderkey AS topic, l_linenumber AS ref, s_name AS author, p_name AS work, n_name AS volume_display
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey LEFT JOIN nation ON n_nationkey = s_nationkey
WHERE l_returnflag = 'R' AND l_quantity >= 45 ORDER BY author, work, ref""")
def refs_by_topic(spark, sf_dir):
    refs = _t(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' and l_quantity >= 45").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    supplier = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = refs.join(supplier, refs["l_suppkey"] == supplier["s_suppkey"]).join(part, F.col("l_partkey") == F.col("p_partkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return out.select(F.col("l_orderkey").alias("topic"), F.col("l_linenumber").alias("ref"), F.col("s_name").alias("author"), F.col("p_name").alias("work"), F.col("n_name").alias("volume_display")).orderBy("author", "work", "ref")


@_register("""
SELECT s_suppkey AS id, s_name AS name,
  (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_suppkey = s_suppkey) AS n_works,
  (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) AS n_refs
FROM supplier ORDER BY lower(s_name)""")
def author_counts(spark, sf_dir):
    # one pass over the references: pairs first, then authors
    pairs = _t(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    counts = pairs.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n_works"), F.sum("n").alias("n_refs"))
    out = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name").join(counts, "s_suppkey", "left")
    return out.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.coalesce("n_works", F.lit(0)).alias("n_works"), F.coalesce("n_refs", F.lit(0)).alias("n_refs")).orderBy(F.lower("name"))


@_register("""
SELECT * FROM (SELECT s_suppkey AS author_id, p_partkey AS id, p_name AS title, p_brand AS volume, count(*) AS n_refs
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
WHERE lower(s_name) = lower('SUPPLIER#000000003') GROUP BY ALL) ORDER BY lower(title), id""")
def author_works(spark, sf_dir):
    author = _t(spark, sf_dir, "supplier").filter(F.lower("s_name") == F.lower(F.lit("SUPPLIER#000000003"))).select("s_suppkey")
    counts = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").join(author, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n_refs"))
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    out = counts.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return out.select(F.col("l_suppkey").alias("author_id"), F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("volume"), "n_refs").orderBy(F.lower("title"), "id")


@_register("""
SELECT s_suppkey AS author_id, s_name AS author, p_partkey AS work_id, p_name AS work, count(l_orderkey) AS n_refs
FROM (SELECT DISTINCT l_suppkey AS a, l_partkey AS w FROM lineitem) JOIN supplier ON s_suppkey = a JOIN part ON p_partkey = w
LEFT JOIN lineitem ON l_suppkey = a AND l_partkey = w AND l_returnflag = 'A' GROUP BY ALL""")
def author_work_index(spark, sf_dir):
    # authorships and their references come from one aggregation
    pairs = _t(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count(F.when(F.col("l_returnflag") == "A", F.col("l_orderkey"))).alias("n_refs"))
    out = pairs.join(_t(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")).join(_t(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return out.select(F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("author"), F.col("p_partkey").alias("work_id"), F.col("p_name").alias("work"), "n_refs")


@_register("""
SELECT l_orderkey AS idea, l_linenumber AS label, o_orderpriority AS topic, s_name AS author, l_quantity AS page
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE l_partkey = 77 ORDER BY idea, label""")
def work_detail_refs(spark, sf_dir):
    refs = _t(spark, sf_dir, "lineitem").filter("l_partkey = 77").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    orders, supplier = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    out = refs.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return out.select(F.col("l_orderkey").alias("idea"), F.col("l_linenumber").alias("label"), F.col("o_orderpriority").alias("topic"), F.col("s_name").alias("author"), F.col("l_quantity").alias("page")).orderBy("idea", "label")


_PAGES_SQL = "SELECT (l_suppkey % 54 + 1)::INT AS volume_id, (l_quantity::INT)::VARCHAR || chr((96 + 1 + l_orderkey % 4)::INT) AS page_marker, l_orderkey * 10 + l_linenumber AS text_offset, l_partkey AS word_count FROM lineitem"


def _pages(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 54 + 1).cast("int").alias("volume_id"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.chr(97 + F.col("l_orderkey") % 4)).alias("page_marker"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("text_offset"),
        F.col("l_partkey").alias("word_count"),
    )


@_register(f"SELECT volume_id, page_marker, min(text_offset) AS text_offset, arg_min(word_count, text_offset) AS word_count FROM ({_PAGES_SQL}) WHERE volume_id = 4 AND page_marker = '7b' GROUP BY ALL")
def page_lookup(spark, sf_dir):
    found = _pages(spark, sf_dir).filter("volume_id = 4 and page_marker = '7b'")
    return found.groupBy("volume_id", "page_marker").agg(F.min("text_offset").alias("text_offset"), F.min_by("word_count", "text_offset").alias("word_count"))


@_register(f"SELECT * FROM ({_PAGES_SQL}) WHERE volume_id = 4 AND regexp_replace(page_marker, '[a-d]$', '')::INT BETWEEN 9 AND 12 ORDER BY page_marker, text_offset")
def page_range(spark, sf_dir):
    return C.page_range(_pages(spark, sf_dir), 4, "12b", "9a")


@_register(f"""SELECT volume_id, page_marker, regexp_extract(page_marker, '^([0-9]+)', 1)::INT AS page, regexp_extract(page_marker, '([a-d])$', 1) AS col, count(*) AS n
FROM ({_PAGES_SQL}) GROUP BY ALL ORDER BY volume_id, page, page_marker""")
def marker_order(spark, sf_dir):
    rows = _pages(spark, sf_dir).withColumn("m", P.marker(F.col("page_marker")))
    return rows.groupBy("volume_id", "page_marker", F.col("m.page").alias("page"), F.col("m.col").alias("col")).agg(F.count("*").alias("n")).orderBy("volume_id", "page", "page_marker")


# Titles.

_TITLES_SQL = "SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN ' ' || p_name || '.,' WHEN 1 THEN p_name || ' [' || p_size || ']' WHEN 2 THEN left(p_name, 5) WHEN 3 THEN upper(p_name) ELSE p_name || '  -' END AS title, p_brand AS volume FROM part"
_KEY_SQL = r"trim(regexp_replace(regexp_replace(lower(regexp_replace(trim(title), '[.,;:\- ]+$', '')), '[\[\](){}]', '', 'g'), '\s+', ' ', 'g'))"
_GATE_SQL = rf"(length(title) >= 6 AND NOT regexp_matches(title, '[0-9\[]') AND NOT regexp_matches(title, '[\]-]$') AND length({_KEY_SQL}) >= 6 AND regexp_matches({_KEY_SQL}, '[a-z]{{5,}}'))"


def _titles(spark, sf_dir) -> DataFrame:
    n, name = F.col("p_partkey") % 5, F.col("p_name")
    title = F.when(n == 0, F.concat(F.lit(" "), name, F.lit(".,"))).when(n == 1, F.concat(name, F.lit(" ["), F.col("p_size").cast("string"), F.lit("]"))).when(n == 2, F.left(name, F.lit(5))).when(n == 3, F.upper(name)).otherwise(F.concat(name, F.lit("  -")))
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), title.alias("title"), F.col("p_brand").alias("volume"))


@_register(f"SELECT id, title, {_KEY_SQL} AS title_key, {_GATE_SQL} AS passes FROM ({_TITLES_SQL})")
def title_noise_gate(spark, sf_dir):
    return _titles(spark, sf_dir).select("id", "title", P.title_key(F.col("title")).alias("title_key"), P.passes_noise_gate(F.col("title")).alias("passes"))


@_register("""
WITH r AS (SELECT l_partkey AS id, count(*) AS n FROM lineitem GROUP BY 1),
t AS (SELECT p_partkey AS id, p_brand AS volume, lower(p_name) AS norm, coalesce(n, 0) AS n_refs FROM part LEFT JOIN r ON id = p_partkey)
SELECT volume, norm, id, n_refs FROM (SELECT *, row_number() OVER (PARTITION BY volume, norm ORDER BY n_refs DESC, id) AS k FROM t) WHERE k = 1""")
def title_best_per_group(spark, sf_dir):
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("volume"), F.lower("p_name").alias("norm"))
    works = C.counted(parts, "id", _t(spark, sf_dir, "lineitem"), "l_partkey", "n_refs")
    return C.best_per_group(works, ["volume", "norm"], [F.desc("n_refs"), F.col("id")]).select("volume", "norm", "id", "n_refs")


@_register()
def works_catalogue(spark, sf_dir):
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("volume_id"), F.col("p_name").alias("title"))
    works = C.counted(parts, "id", _t(spark, sf_dir, "lineitem"), "l_partkey", "n_refs")
    return E.works_catalogue(works).select("id", "title", "volume_id", "n_refs")


@_register()
def works_dedup(spark, sf_dir):
    """Variants of titles moved to their heads in the references; no reference is lost."""
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("volume_id"), F.col("p_name").alias("title"))
    refs = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("work_id"))
    works = C.counted(parts, "id", refs, "work_id", "n_refs")
    mapping = E.title_clusters(works, "volume_id", "id", "title", "n_refs").select(F.col("id").alias("variant"), F.col("head").alias("canonical"))
    return C.remap(refs, "work_id", mapping).groupBy("work_id").agg(F.count("*").alias("n_refs"))


# Invariants.


@_register("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def orphan_check(spark, sf_dir):
    returned = _t(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    return C.orphans(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", returned, "l_orderkey")


@_register("SELECT text, count(*) AS c FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_check(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("text", *[x.alias(k) for x, k in ((F.xxhash64("text"), "h"), (F.hash("text"), "g"))])
    # count by 96-bit names, then fetch the few texts
    named = docs.groupBy("h", "g").agg(F.count("*").alias("c")).filter("c > 1")
    return docs.join(named, ["h", "g"]).groupBy("text").agg(F.first("c").alias("c"))


@_register("""
SELECT n::INT AS l_quantity FROM range(1, 61) t(n) WHERE n NOT IN (SELECT l_quantity::INT FROM lineitem WHERE l_quantity IS NOT NULL)""")
def coverage_check(spark, sf_dir):
    return C.missing_numbers(_t(spark, sf_dir, "lineitem"), "l_quantity", 1, 60)


@_register("SELECT lang, avg((length(text) > 300)::INT) AS long_share, count(*) AS n, count(*) FILTER (text IS NULL OR trim(text) = '') AS n_empty FROM documents GROUP BY lang")
def ratio_check(spark, sf_dir):
    return _t(spark, sf_dir, "documents").groupBy("lang").agg(C.share(F.length("text") > 300).alias("long_share"), F.count("*").alias("n"), F.count_if(F.col("text").isNull() | (F.trim("text") == "")).alias("n_empty"))


@_register("SELECT count(*) AS n FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)")
def distinct_pairs(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct().agg(F.count("*").alias("n"))


@_register("SELECT s_suppkey AS id FROM supplier EXCEPT SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_linenumber = 7")
def missing_volumes(spark, sf_dir):
    have = _t(spark, sf_dir, "lineitem").filter("l_quantity > 49 and l_linenumber = 7").select(F.col("l_suppkey").alias("id"))
    return files.missing(_t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")), have, "id")


# Building tables.


@_register("""
WITH m AS (SELECT min(p_partkey) AS canonical, p_brand, p_name FROM part GROUP BY p_brand, p_name),
v AS (SELECT p_partkey AS variant, canonical FROM part JOIN m USING (p_brand, p_name))
SELECT canonical AS work_id, count(*) AS n_refs, count(DISTINCT l_suppkey) AS n_authors FROM lineitem JOIN v ON variant = l_partkey GROUP BY 1""")
def dedup_remap(spark, sf_dir):
    from pyspark.sql import Window

    part = _t(spark, sf_dir, "part")
    mapping = part.select(F.col("p_partkey").alias("variant"), F.min("p_partkey").over(Window.partitionBy("p_brand", "p_name")).alias("canonical"))
    refs = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("work_id"), "l_suppkey")
    return C.remap(refs, "work_id", mapping).groupBy("work_id").agg(F.count("*").alias("n_refs"), F.count_distinct("l_suppkey").alias("n_authors"))


@_register("""
WITH f AS (SELECT l_suppkey, l_partkey % 50 AS grp, min(l_orderkey * 10 + l_linenumber) AS p FROM lineitem GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY p, l_suppkey, grp) AS id, l_suppkey, grp FROM f""")
def first_seen_dims(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") % 50).alias("grp"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("p"))
    return C.first_seen(rows, ["l_suppkey", "grp"], "p")


@_register(r"""
WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN '.' ELSE '' END END AS n, c_nationkey FROM customer),
b AS (SELECT *, CASE WHEN length(trim(n)) >= 3 THEN trim(n) ELSE 'Author ' || c_nationkey END AS name FROM a),
c AS (SELECT *, coalesce(nullif(regexp_replace(lower(name), '[^a-z]', '', 'g'), ''), lower(name)) AS canon FROM b),
d AS (SELECT canon, c_nationkey AS number, arg_min(name, c_custkey) AS name, min(c_custkey) AS p FROM c GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY p, name, number) AS id, name, number FROM d""")
def author_dimension(spark, sf_dir):
    k = F.col("c_custkey")
    name = F.when(k % 7 == 0, "x").otherwise(F.concat("c_mktsegment", F.when(k % 3 == 0, ".").otherwise("")))
    rows = _t(spark, sf_dir, "customer").select(name.alias("name"), F.col("c_nationkey").alias("number"), "c_custkey")
    return C.get_or_create_authors(rows, "name", "number", "c_custkey")


@_register("""
WITH d AS (SELECT p_brand AS volume_id, lower(trim(p_name)) AS title_norm, arg_min(trim(p_name), p_partkey) AS title, min(p_partkey) AS p FROM part GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY p, volume_id, title_norm, title) AS id, volume_id, title, title_norm FROM d""")
def work_dimension(spark, sf_dir):
    return C.get_or_create_works(_t(spark, sf_dir, "part"), "p_brand", "p_name", "p_partkey")


@_register("""
WITH o AS (SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 6 = 0 THEN lower(c_name) ELSE upper(c_name) END AS v FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0)
SELECT * FROM n UNION ALL SELECT * FROM o WHERE k NOT IN (SELECT k FROM n)""")
def upsert_rows(spark, sf_dir):
    # old and new together are all customers; some are new twice
    customer, k = _t(spark, sf_dir, "customer"), F.col("c_custkey")
    old = customer.filter(k % 3 != 0).select(k.alias("k"), F.col("c_name").alias("v"))
    new = customer.filter((k % 2 == 0) | (k % 3 == 0)).select(k.alias("k"), F.upper("c_name").alias("v"), F.lit(1).alias("seq"))
    again = customer.filter(k % 6 == 0).select(k.alias("k"), F.lower("c_name").alias("v"), F.lit(2).alias("seq"))
    return C.upsert(old, new.unionByName(again), ["k"], [F.desc("seq")])


@_register("""
WITH o AS (SELECT DISTINCT c_nationkey AS k, 'old' AS v FROM customer WHERE c_nationkey < 5), n AS (SELECT c_nationkey AS k, arg_min(c_name, c_custkey) AS v FROM customer GROUP BY 1)
SELECT * FROM o UNION ALL SELECT * FROM n WHERE k NOT IN (SELECT k FROM o)""")
def insert_ignored(spark, sf_dir):
    customer = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_name").alias("v"), "c_custkey")
    old = customer.filter("k < 5").select("k", F.lit("old").alias("v")).distinct()
    return C.insert_ignore(old, customer, ["k"], [F.col("c_custkey")])


@_register("""
SELECT r_name AS name, '[' || string_agg('{"id":"' || n_nationkey || '","desc":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS subtopics
FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name""")
def json_subtopics(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("t"))
    out = _t(spark, sf_dir, "region").join(nation, F.col("r_regionkey") == F.col("n_regionkey"))
    return out.select(F.col("r_name").alias("name"), files.as_json(F.transform("t", lambda x: F.struct(x["n_nationkey"].cast("string").alias("id"), x["n_name"].alias("desc")))).alias("subtopics"))


@_register("""
WITH l AS (SELECT c_custkey AS id, lower(c_name) AS k1, c_mktsegment AS k2 FROM customer), r AS (SELECT s_suppkey AS rid, 'customer#' || right(s_name, 9) AS k1, CASE WHEN s_suppkey = 2 THEN 'BUILDING' END AS k2 FROM supplier),
m AS (SELECT id, 0 AS b, min(rid) AS rid FROM l JOIN r USING (k1) GROUP BY id UNION ALL SELECT id, 1, min(rid) FROM l JOIN r ON l.k2 = r.k2 GROUP BY id)
SELECT id, arg_min(rid, b) AS rid, min(b)::INT AS matched_by FROM m GROUP BY id""")
def cascade_match(spark, sf_dir):
    left = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lower("c_name").alias("k1"), F.col("c_mktsegment").alias("k2"))
    right = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("rid"), F.concat(F.lit("customer#"), F.right("s_name", F.lit(9))).alias("k1"), F.when(F.col("s_suppkey") == 2, "BUILDING").alias("k2"))
    return C.cascade_match(left, right, [("k1", "k1"), ("k2", "k2")], "id", "rid")


@_register(r"""
WITH f AS (SELECT n_nationkey, 'dir/Volume ' || n_nationkey || ' - ' || n_name || ', ' || upper(n_name) || CASE WHEN n_nationkey % 4 = 0 THEN '.pdf' ELSE '.txt' END AS path FROM nation)
SELECT path, CASE WHEN path LIKE '%.txt' THEN regexp_extract(path, 'Volume\s+([0-9]+)', 1)::INT END AS number, nullif(regexp_extract(path, 'Volume\s+[0-9]+\s+-\s+(.+?)\.txt$', 1), '') AS display, regexp_extract(path, 'Volume\s+([0-9]+)', 1)::INT AS vol FROM f""")
def volume_names(spark, sf_dir):
    k = F.col("n_nationkey")
    path = F.concat(F.lit("dir/Volume "), k.cast("string"), F.lit(" - "), "n_name", F.lit(", "), F.upper("n_name"), F.when(k % 4 == 0, ".pdf").otherwise(".txt"))
    rows = _t(spark, sf_dir, "nation").select(path.alias("path")).withColumn("v", P.volume_name(F.col("path")))
    return rows.select("path", "v.number", "v.display", P.volume_of(F.col("path")).alias("vol"))



def _citations(spark, sf_dir) -> DataFrame:
    item, supplier, part = _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "supplier"), _t(spark, sf_dir, "part")
    rows = item.join(supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")).join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"), (F.col("l_orderkey") % 102 + 1).cast("int").alias("idea_number"), F.col("l_linenumber").cast("string").alias("topic_label"), F.col("l_suppkey").cast("int").alias("author_number"),
        F.regexp_replace("s_name", "[^A-Za-z]", "").alias("author"), F.col("p_name").alias("work"), F.col("l_quantity").cast("int").cast("string").alias("page_start"), F.col("l_quantity").cast("int").cast("string").alias("page_end"), F.when(F.col("l_orderkey") % 2 == 0, F.col("p_name")).otherwise("").alias("cited"),
    )


@_register("""
WITH c AS (SELECT l_orderkey * 10 + l_linenumber AS position, (l_orderkey % 102 + 1)::INT AS idea_number, l_linenumber::VARCHAR AS topic_label, l_suppkey::INT AS author_number, lower(p_name) AS tn, p_name AS work, s_nationkey AS volume_id, (l_quantity::INT)::VARCHAR AS page_start
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey WHERE s_suppkey % 10 <> 3),
a AS (SELECT author_number, row_number() OVER (ORDER BY min(position), author_number) AS author_id FROM c GROUP BY 1),
w AS (SELECT volume_id, tn, row_number() OVER (ORDER BY min(position), volume_id, tn) AS work_id FROM c GROUP BY 1, 2)
SELECT position, idea_number, topic_label, author_id, work_id, page_start, page_start AS page_end, work AS ref_text FROM c JOIN a USING (author_number) JOIN w USING (volume_id, tn) WHERE topic_label::INT <= 5""")
def build_references(spark, sf_dir):
    supplier = _t(spark, sf_dir, "supplier")
    volume_of = supplier.filter("s_suppkey % 10 <> 3").select(F.col("s_suppkey").cast("int").alias("author_number"), F.col("s_nationkey").alias("volume_id"))
    topics = spark.range(1, 103).select(F.col("id").cast("int").alias("idea_number"), F.explode(F.array(*[F.lit(str(k)) for k in range(1, 6)])).alias("label"))
    return build.build_references(_citations(spark, sf_dir), volume_of, topics)["references"]


@_register("""
WITH n AS (SELECT n_nationkey AS volume_id, unnest([n_name, 'Anonymous ' || chr(65 + n_regionkey)]) AS name, unnest([0, 1]) AS nth FROM nation),
a AS (SELECT volume_id, name, row_number() OVER (ORDER BY volume_id, nth) AS id FROM n)
SELECT id AS author_id, id AS work_id FROM a""")
def volume_index(spark, sf_dir):
    display = F.concat("n_name", F.lit(", Anonymous "), F.chr(65 + F.col("n_regionkey")))
    rows = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("number"), display.alias("display"), F.lit("x.txt").alias("path"))
    return build.index_volumes(rows)["authorships"]


@_register("""
WITH r AS (SELECT n_regionkey + 1 AS topic_id, n_nationkey, n_name, row_number() OVER (ORDER BY n_regionkey, n_nationkey) AS id FROM nation)
SELECT id, topic_id::INT AS topic_id, id AS subtopic_id, 1 AS author_id, id AS work_id, 'PLATO' AS author, 7 AS volume, (n_nationkey + 1) || 'a' AS page_start, (n_nationkey + 2) || 'b' AS page_end FROM r""")
def csv_star_schema(spark, sf_dir):
    from pyspark.sql import Window

    k = F.col("n_nationkey")
    line = F.concat(F.lit("7 PLATO: Work "), F.chr(65 + k), F.lit(", "), (k + 1).cast("string"), F.lit("a-"), (k + 2).cast("string"), F.lit("b"))
    rows = _t(spark, sf_dir, "nation").select(
        (F.col("n_regionkey") + 1).cast("int").alias("number"), F.lit("TOPIC").alias("name"), F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).alias("ord"), k.cast("string").alias("code"), F.col("n_name").alias("description"), F.array(line).alias("refs")
    )
    return build.star_schema(rows)["reference"].select("id", "topic_id", "subtopic_id", "author_id", "work_id", "author", "volume", "page_start", "page_end")


@_register("""
SELECT s_suppkey AS vol, (length(s_name) + 25)::INT AS start, CASE WHEN s_suppkey % 2 = 0 THEN 'own' ELSE 'spare ' || s_suppkey END AS outline FROM supplier""")
def chapter_repair(spark, sf_dir):
    """The start of an introduction found backward, and an empty outline from a second source."""
    supplier = _t(spark, sf_dir, "supplier")
    text = F.concat("s_name", F.lit(" ANGEL INTRODUCTION old\n\nx ANGEL words\nINTRODUCTION prose"))
    rows = supplier.select(F.col("s_suppkey").alias("vol"), F.when(F.col("s_suppkey") % 2 == 0, "own").otherwise("").alias("outline"), build.intro_start(text, F.lit("ANGEL"), F.lit(0), F.length(text)).alias("start"))
    spare = supplier.select(F.col("s_suppkey").alias("vol"), F.concat(F.lit("spare "), F.col("s_suppkey").cast("string")).alias("outline"))
    return build.with_fallback(rows, spare, "vol", "outline").select("vol", "start", "outline")


@_register(r"""
WITH p AS (SELECT o_orderkey AS page, 'Chapter ' || (o_orderkey % 102 + 1) || ': NAME ' || chr((65 + o_orderkey % 26)::INT) || 'X' AS t FROM orders WHERE o_orderkey % 3 = 0)
SELECT regexp_extract(t, 'Chapter ([0-9]+)', 1)::INT AS number, arg_max(regexp_extract(t, ': (.*)', 1), page) AS name, max(page) AS page FROM p GROUP BY 1""")
def chapter_map(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("Chapter "), (k % 102 + 1).cast("string"), F.lit(": NAME "), F.chr(65 + k % 26), F.lit("X"))).otherwise("prose")
    return build.chapter_map(_t(spark, sf_dir, "orders").select(k.alias("page"), text.alias("text")), "page")


# Lines and cleaning.

_LINES_SQL = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::INT AS line_no FROM documents"


@_register(rf"SELECT doc_id, line_no, line, length(regexp_extract_all(line, '\S+'))::INT AS words FROM ({_LINES_SQL})")
def line_explode(spark, sf_dir):
    return G.lines(_t(spark, sf_dir, "documents"), "doc_id").select("doc_id", "line_no", "line", T.word_count(F.col("line")).alias("words"))


@_register(rf"""
WITH l AS (SELECT doc_id, line_no, trim(line) AS s FROM (SELECT doc_id, line_no, CASE WHEN line_no % 3 = 0 THEN regexp_replace(line, '[a-z]', '#', 'g') ELSE line END AS line FROM ({_LINES_SQL})))
SELECT doc_id, line_no FROM l WHERE length(s) > 8 AND length(regexp_replace(s, '[^\p{{L}}\p{{N}}\s]', '', 'g')) / length(s) < 0.4""")
def garbage_lines(spark, sf_dir):
    rows = G.lines(_t(spark, sf_dir, "documents"), "doc_id")
    spoilt = F.when(F.col("line_no") % 3 == 0, F.regexp_replace("line", "[a-z]", "#")).otherwise(F.col("line"))
    return rows.filter(T.is_garbage(spoilt)).select("doc_id", "line_no")


@_register(r"""
WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+') AS w FROM documents)
SELECT doc_id, (len(w) < 8 OR len(list_filter(w, lambda x : length(x) >= 4)) / greatest(len(w), 1) < 0.2) AS decorative, length(trim(text)) >= 80 AS native_text FROM w""")
def decorative_flag(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.is_decorative(F.col("text")).alias("decorative"), T.has_native_text(F.col("text")).alias("native_text"))


@_register(r"""
SELECT doc_id, regexp_replace(replace(text, 'tion', 't-' || chr(10) || 'ion'), '([\p{L}\p{N}_])-\n([\p{L}\p{N}_])', '\1\2', 'g') AS joined FROM documents""")
def dehyphenate(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.dehyphenate(F.replace("text", F.lit("tion"), F.lit("t-\nion"))).alias("joined"))


@_register(r"""
WITH m AS (SELECT o_orderkey, 'Chapter ' || (o_orderkey % 90) || ': NAME OF IT' || chr(10) || 'line of prose ' || o_orderpriority || chr(10) || (o_orderkey % 1000) || chr(10) || 'THE GREAT IDEAS ' || o_custkey || chr(10) || chr(10) || '3a to 4b ' || o_custkey || chr(10) || 'more prose, 12' AS t FROM orders)
SELECT o_orderkey, 'line of prose ' || regexp_extract(t, 'prose (.*)', 1) || chr(10) || chr(10) || 'more prose, 12' AS stripped FROM m""")
def header_strip(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.concat(F.lit("Chapter "), (k % 90).cast("string"), F.lit(": NAME OF IT\nline of prose "), "o_orderpriority", F.lit("\n"), (k % 1000).cast("string"), F.lit("\nTHE GREAT IDEAS "), F.col("o_custkey").cast("string"), F.lit("\n\n3a to 4b "), F.col("o_custkey").cast("string"), F.lit("\nmore prose, 12"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", T.strip_running_headers(text).alias("stripped"))


_TOKEN_SQL = r"regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+')"
#: Written out once more, so that a wrong entry of the table shows.
_WORDS_SQL = """MAP {'vhole': 'whole', 'Vhole': 'Whole', 'vhich': 'which', 'Vhich': 'Which', 'vith': 'with', 'vould': 'would', 'Vould': 'Would', 'vork': 'work', 'Vork': 'Work', 'vorld': 'world', 'Vorld': 'World', 'vhen': 'when', 'Vhen': 'When', 'vere': 'were', 'Vere': 'Were', 'vay': 'way', 'vill': 'will',
 'lias': 'has', 'Lias': 'Has', 'tlie': 'the', 'Tlie': 'The', 'llie': 'the', 'niatter': 'matter', 'Niatter': 'Matter', 'iiian': 'man', 'hfe': 'life', 'Hfe': 'Life', 'CHAFFER': 'CHAPTER', 'Chapteri': 'Chapter 1', 'JudaeoChristian': 'Judaeo-Christian', 'senseperception': 'sense-perception', 'Senseperception': 'Sense-perception',
 'liave': 'have', 'liat': 'that', 'nianv': 'many', 'jov': 'joy', 'gocxl': 'good', 'hojx': 'hope', 'happv': 'happy', 'happilv': 'happily', 'wdth': 'with', 'tliat': 'that', 'Citxl': 'God', 'Gixl': 'God', 'Gtxl': 'God', 'Sirints': 'Saints'}"""


@_register(rf"""
WITH t AS (SELECT doc_id, list_transform({_TOKEN_SQL}, lambda x : coalesce({_WORDS_SQL}[x], x)) AS t
  FROM (SELECT doc_id, replace(replace(text, 'the ', 'tlie '), ' in ', ' arc ') AS text FROM documents))
SELECT doc_id, array_to_string(list_transform(t, lambda x, i : CASE
  WHEN x IN ('oi', 'ol', 'ot') AND regexp_matches(coalesce(t[i+1], ''), '^\s+$') AND regexp_matches(coalesce(t[i+2], ''), '^[a-z]') THEN 'of'
  WHEN x = 'docs' AND NOT regexp_matches(coalesce(t[i+1], ''), '^\s*\.') THEN 'does'
  WHEN x = 'arc' AND NOT (i >= 3 AND regexp_matches(t[greatest(i-1, 1)], '^\s+$') AND lower(t[greatest(i-2, 1)]) IN ('an', 'the', 'this', 'that', 'each', 'every', 'any', 'no', 'its', 'their', 'his', 'her', 'our', 'your', 'one')) THEN 'are'
  ELSE x END), '') AS fixed FROM t""")
def ocr_word_fixes(spark, sf_dir):
    spoilt = F.replace(F.replace("text", F.lit("the "), F.lit("tlie ")), F.lit(" in "), F.lit(" arc "))
    return _t(spark, sf_dir, "documents").select("doc_id", T.fix_words(spoilt).alias("fixed"))


#: One spoilt text a rule; what each becomes stands in the SQL.
_SPOILT = (
    r"a ha\e and gi\en", r"li\'ing e\'ade", r"ser\ices de\elopment", r"x \\hich po\\er", r"gro\\'th common\\^ ealth", r"\^'orld \^ rites", r"theor\' glor\ facult\'i", r"Boo\s wor\s loo\not", r"E\'OLUTION x\ristotle", r"whate\-er \vc ne\v",
    "I'he i'hc 'I'his", "Ix* Ix-causc Ix-fore Ix^hold", "Ix Paris", "m.an am.ong w'ith", "C»xyz CiOti ma^e", "Scotus Engena Darw in", "vhole Vhole vill hfe", "oi men and ot Kant", "docs it docs.", "an arc they arc", "ofGod inParis  now",
)


@_register(r"""
SELECT p_partkey, list_extract(['a have and given', 'living evade', 'services development', 'x which power', 'growth commonwealth', 'world writes', 'theory glory faculty', 'Books works look not', 'EVOLUTION Aristotle', 'whatever we new',
  'The the This', 'be because before behold', 'In Paris', 'man among with', 'God God make', 'Scotus Erigena Darwin', 'whole Whole will life', 'of men and ot Kant', 'does it docs.', 'an arc they are', 'of God in Paris now'], (p_partkey % 21 + 1)::INT) AS fixed FROM part""")
def ocr_repairs(spark, sf_dir):
    spoilt = F.element_at(F.array(*[F.lit(x) for x in _SPOILT]), (F.col("p_partkey") % len(_SPOILT) + 1).cast("int"))
    return _t(spark, sf_dir, "part").select("p_partkey", T.correct(spoilt).alias("fixed"))


@_register("""
WITH c AS (SELECT p_partkey, p_size, p_partkey % 6 AS k FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN 'S' || p_size || '. Title of it' WHEN 1 THEN p_size || '^. Title of it' WHEN 2 THEN p_size || 'fl Title of it' WHEN 3 THEN p_size || ' B Title of it' WHEN 4 THEN p_size || ' . Title of it' ELSE 'j' || p_size || '(7. Title of it' END AS raw,
  CASE k WHEN 0 THEN '5' || p_size || '. Title of it' WHEN 1 THEN p_size || 'b. Title of it' WHEN 2 THEN p_size || 'a. Title of it' WHEN 3 THEN p_size || 'b. Title of it' WHEN 4 THEN p_size || '. Title of it' ELSE '7' || p_size || 'a. Title of it' END AS fixed FROM c""")
def subtopic_codes(spark, sf_dir):
    n, k, rest = F.col("p_size").cast("string"), F.col("p_partkey") % 6, F.lit("Title of it")
    raw = F.when(k == 0, F.concat(F.lit("S"), n, F.lit(". "), rest)).when(k == 1, F.concat(n, F.lit("^. "), rest)).when(k == 2, F.concat(n, F.lit("fl "), rest)).when(k == 3, F.concat(n, F.lit(" B "), rest)).when(k == 4, F.concat(n, F.lit(" . "), rest)).otherwise(F.concat(F.lit("j"), n, F.lit("(7. "), rest))
    return _t(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"), T.fix_subtopic_code(raw).alias("fixed"))


@_register(rf"""
WITH l AS (SELECT doc_id, line_no, CASE WHEN line_no % 4 = 0 THEN '' WHEN line_no % 7 = 0 THEN '***' ELSE line END AS line FROM ({_LINES_SQL})),
k AS (SELECT doc_id, line_no, trim(line) AS s, sum((trim(line) = '')::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM l
  WHERE NOT (trim(line) LIKE '[PAGE %' OR (trim(line) <> '' AND (regexp_matches(trim(line), '^[\p{{L}}\p{{N}}]{{1,4}}$') OR regexp_matches(trim(line), '^[^\p{{L}}\p{{N}}\s]+$'))))),
g AS (SELECT doc_id, island, string_agg(s, ' ' ORDER BY line_no) AS text FROM k WHERE s <> '' GROUP BY 1, 2)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY island)::INT AS para, text FROM g""")
def paragraph_join(spark, sf_dir):
    rows = G.lines(_t(spark, sf_dir, "documents"), "doc_id")
    rows = rows.withColumn("line", F.when(F.col("line_no") % 4 == 0, "").when(F.col("line_no") % 7 == 0, "***").otherwise(F.col("line")))
    return G.paragraphs(rows, "doc_id")


@_register(rf"""
WITH l AS (SELECT doc_id, line_no, CASE WHEN line_no % 2 = 0 THEN '[' || line_no || chr((97 + line_no % 4)::INT) || '] ' || line ELSE line END AS line FROM ({_LINES_SQL})),
m AS (SELECT *, nullif(regexp_extract(line, '\[([0-9]{{1,4}}[a-d]?)\](\s|$)', 1), '') AS mark FROM l),
w AS (SELECT *, sum((mark IS NOT NULL)::INT) OVER o AS page, sum(length(line) + 1) OVER o - length(line) - 1 AS before FROM m WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
b AS (SELECT *, CASE WHEN mark IS NOT NULL THEN substring(line, position('[' || mark || ']' IN line) + length(mark) + 2) ELSE line END AS body FROM w WHERE page > 0),
g AS (SELECT doc_id, page, max(mark) AS page_marker, max(CASE WHEN mark IS NOT NULL THEN before + position('[' || mark || ']' IN line) - 1 END)::BIGINT AS text_offset, trim(string_agg(body, chr(10) ORDER BY line_no)) AS text FROM b GROUP BY 1, 2)
SELECT doc_id, page_marker, text_offset, text, len(regexp_extract_all(text, '\S+'))::INT AS word_count FROM g WHERE len(regexp_extract_all(text, '\S+')) >= 5""")
def page_segmentation(spark, sf_dir):
    rows = G.lines(_t(spark, sf_dir, "documents"), "doc_id")
    n = F.col("line_no")
    rows = rows.withColumn("line", F.when(n % 2 == 0, F.concat(F.lit("["), n.cast("string"), F.chr(97 + n % 4), F.lit("] "), "line")).otherwise(F.col("line")))
    return G.marked_pages(rows, "doc_id")


# Small languages.

_ROMAN = "CASE WHEN {0} = 0 THEN '' ELSE repeat('x', ({0} // 10)::INT) || CASE {0} % 10 WHEN 1 THEN 'i' WHEN 2 THEN 'ii' WHEN 3 THEN 'iii' WHEN 4 THEN 'iv' WHEN 5 THEN 'v' WHEN 6 THEN 'vi' WHEN 7 THEN 'vii' WHEN 8 THEN 'viii' WHEN 9 THEN 'ix' ELSE '' END END"


def _roman(n):
    unit = F.element_at(F.array(*[F.lit(x) for x in ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")]), (n % 10 + 1).cast("int"))
    return F.concat(F.repeat(F.lit("x"), F.floor(n / 10).cast("int")), unit)


@_register(f"SELECT p_partkey, {_ROMAN.format('(p_partkey % 40)')} AS numeral, nullif(p_partkey % 40, 0)::INT AS value FROM part")
def roman_to_int(spark, sf_dir):
    numeral = _roman(F.col("p_partkey") % 40)
    return _t(spark, sf_dir, "part").select("p_partkey", numeral.alias("numeral"), P.roman(numeral).alias("value"))


@_register("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 1 THEN l_linenumber || chr((95 + l_linenumber)::INT) ELSE l_linenumber::VARCHAR END AS label,
  CASE WHEN l_linenumber > 1 THEN l_linenumber::VARCHAR END AS parent FROM lineitem""")
def label_parent(spark, sf_dir):
    n = F.col("l_linenumber")
    label = F.when(n > 1, F.concat(n.cast("string"), F.chr(95 + n))).otherwise(n.cast("string"))
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", label.alias("label"), P.parent_label(label).alias("parent"))


_REF_SQL = "SELECT l_orderkey, l_linenumber, 'bk ' || l_linenumber || ' ' || l_partkey % 999 + 1 || 'a-' || l_partkey % 999 + 2 || 'b; ' || l_suppkey % 999 + 1 || 'c / On Work, ch 2 ' || (l_quantity::INT) || 'd passim' AS rest FROM lineitem"


def _refs(spark, sf_dir) -> DataFrame:
    part, supp = (F.col("l_partkey") % 999 + 1).cast("string"), (F.col("l_suppkey") % 999 + 1).cast("string")
    rest = F.concat(F.lit("bk "), F.col("l_linenumber").cast("string"), F.lit(" "), part, F.lit("a-"), (F.col("l_partkey") % 999 + 2).cast("string"), F.lit("b; "), supp, F.lit("c / On Work, ch 2 "), F.col("l_quantity").cast("int").cast("string"), F.lit("d passim"))
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", rest.alias("rest"), part.alias("a"), supp.alias("s"))


@_register(r"""
SELECT l_orderkey, l_linenumber, unnest([1, 2, 3]) AS nth, unnest([(l_partkey % 999 + 1) || 'a', (l_suppkey % 999 + 1) || 'c', (l_quantity::INT) || 'd']) AS page_start, unnest([(l_partkey % 999 + 2) || 'b', (l_suppkey % 999 + 1) || 'c', (l_quantity::INT) || 'd']) AS page_end FROM lineitem""")
def page_refs(spark, sf_dir):
    found = _refs(spark, sf_dir).select("l_orderkey", "l_linenumber", F.posexplode(P.page_refs(F.col("rest"))).alias("i", "r"))
    return found.select("l_orderkey", "l_linenumber", (F.col("i") + 1).alias("nth"), F.col("r.start").alias("page_start"), F.col("r.end").alias("page_end"))


@_register(r"""
SELECT l_orderkey, l_linenumber, unnest(['bk ' || l_linenumber, 'bk ' || l_linenumber, 'On Work, ch 2']) AS work, unnest([(l_partkey % 999 + 1) || 'a', (l_suppkey % 999 + 1) || 'c', (l_quantity::INT) || 'd']) AS page_start, unnest([(l_partkey % 999 + 2) || 'b', (l_suppkey % 999 + 1) || 'c', (l_quantity::INT) || 'd']) AS page_end FROM lineitem""")
def ref_chunks(spark, sf_dir):
    found = P.chunk_rows(_refs(spark, sf_dir).select("l_orderkey", "l_linenumber", "rest"), "rest")
    return found.select("l_orderkey", "l_linenumber", "work", F.col("start").alias("page_start"), F.col("end").alias("page_end"))


@_register("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ', part i, q 22, a 3, ans 130d-131c' WHEN 1 THEN '"' || p_name || ', bk v' WHEN 2 THEN p_name || '  451c-453b;' ELSE 'II [' || p_size || ']' END AS raw,
  CASE WHEN p_partkey % 4 = 3 THEN '' ELSE p_name END AS title FROM part""")
def work_title_norm(spark, sf_dir):
    k, name = F.col("p_partkey") % 4, F.col("p_name")
    raw = F.when(k == 0, F.concat(name, F.lit(", part i, q 22, a 3, ans 130d-131c"))).when(k == 1, F.concat(F.lit('"'), name, F.lit(", bk v"))).when(k == 2, F.concat(name, F.lit("  451c-453b;"))).otherwise(F.concat(F.lit("II ["), F.col("p_size").cast("string"), F.lit("]")))
    return _t(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"), P.work_title(raw).alias("title"))


@_register("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_linenumber % 3 AS k, l_suppkey::VARCHAR AS s, l_quantity::INT AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN k < 2 THEN s END AS number, CASE k WHEN 0 THEN 'PLATO' WHEN 1 THEN 'ST. AUGUSTINE' END AS author, CASE k WHEN 0 THEN 'Republic' WHEN 1 THEN trim(repeat('long ', 16)) END AS title,
  CASE k WHEN 0 THEN q || 'c' WHEN 1 THEN q || 'a' END AS page_start, CASE k WHEN 0 THEN q + 2 || 'b' END AS page_end FROM l""")
def csv_references(spark, sf_dir):
    q, k, s = F.col("l_quantity").cast("int"), F.col("l_linenumber") % 3, F.col("l_suppkey").cast("string")
    usual = F.concat(s, F.lit(" PLATO: Republic, "), q.cast("string"), F.lit("c-"), (q + 2).cast("string"), F.lit("b"))
    # no comma: a title of 80 characters at most
    long = F.concat(s, F.lit(" ST. AUGUSTINE: "), F.repeat(F.lit("long "), F.lit(20)), q.cast("string"), F.lit("a"))
    line = F.when(k == 0, usual).when(k == 1, long).otherwise("no reference at all")
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", P.csv_reference(line).alias("r")).select("l_orderkey", "l_linenumber", "r.*")


# Chapters: 3 a supplier, header variants, outline, references.


def _volumes(spark, sf_dir) -> DataFrame:
    """(vol, text): an index volume for each supplier, built from its number and name; the chapters of odd ones have misread and stray topics, several works in a citation and a continued one."""
    k = F.col("s_suppkey").cast("string")
    plain = F.concat(F.lit("1. The concept of a sample\n2. The division of samples into kinds\n2^. The order among kinds of sample\nREFERENCES\n1. The concept of a sample\n7 Plato: Republic, bk v "), k, F.lit("c-453b; 457a\n2. The division of samples into kinds\n8 Aristotle: Metaphysics, bk i\n500a-501b\n2^. The order among kinds of sample\n7 Plato: Timaeus "), k, F.lit("a\n"))
    odd = F.concat(F.lit("1. The concept of a sample\n3. The jump over a number\n2. The division of samples into kinds\n1. The stray line that goes back\n2. The order among kinds of sample\nREFERENCES\n1. The concept of a sample\n7 Plato: Republic, bk v "), k, F.lit("c-453b / Laws, bk i 640a; 641b\nbk ii 650c\n3. The jump over a number\n8 Aristotle: Physics 259a\n2. The division of samples into kinds\n"))
    chapter = lambda head: F.concat(F.lit(f"{head}\nINTRODUCTION\nSome prose about number "), k, F.lit(" follows in a line of its own.\nOUTLINE OF TOPICS\n"), F.when(F.col("s_suppkey") % 2 == 1, odd).otherwise(plain), F.lit("CROSS-REFERENCES\nFor: Other matters, see elsewhere.\nADDITIONAL READINGS\nBook one.\n"))
    text = F.concat(F.lit("Contents\nChapter 1: Angel 5\n"), chapter("Chapter 1: ANGEL"), chapter("Chapter 2\n: BEING"), chapter("Chapter iii: CAUSE"))
    return _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("vol"), text.alias("text"))


@_register("""
SELECT s_suppkey AS vol, unnest([1, 2, 3]) AS number, unnest(['ANGEL', 'BEING', 'CAUSE']) AS name,
  unnest(CASE WHEN s_suppkey % 2 = 1 THEN [3, 23, 44] ELSE [3, 22, 42] END) AS line_no, unnest(CASE WHEN s_suppkey % 2 = 1 THEN [23, 44, NULL] ELSE [22, 42, NULL] END) AS next_line FROM supplier""")
def chapter_header_pick(spark, sf_dir):
    return G.chapter_starts(G.lines(_volumes(spark, sf_dir), "vol"), "vol")


@_register("""
WITH c AS (SELECT s_suppkey AS vol, unnest([1, 2, 3]) AS number FROM supplier)
SELECT vol, number, 'INTRODUCTION' || chr(10) || 'Some prose about number ' || vol || ' follows in a line of its own.' AS introduction, 'For: Other matters, see elsewhere.' AS cross_references FROM c""")
def idea_bodies(spark, sf_dir):
    rows = G.chapter_lines(G.lines(_volumes(spark, sf_dir), "vol"), "vol")
    return G.idea_bodies(rows, ["vol", "number"])


@_register("""
WITH c AS (SELECT s_suppkey AS vol, unnest([1, 2, 3]) AS number FROM supplier),
t(odd, label, title, parent_label) AS (VALUES (0, '1', 'The concept of a sample', NULL), (0, '2', 'The division of samples into kinds', NULL), (0, '2a', 'The order among kinds of sample', '2'),
  (1, '1', 'The concept of a sample', NULL), (1, '1a', 'The jump over a number', '1'), (1, '2', 'The division of samples into kinds', NULL), (1, '2a', 'The order among kinds of sample', '2'))
SELECT vol, number, label, title, parent_label FROM c JOIN t ON odd = vol % 2""")
def outline_labels(spark, sf_dir):
    rows = G.chapter_lines(G.lines(_volumes(spark, sf_dir), "vol"), "vol")
    return folds.topics(rows, ["vol", "number"]).drop("line_no")


@_register("""
WITH c AS (SELECT s_suppkey AS vol, unnest([1, 2, 3]) AS number FROM supplier),
r(odd, topic_label, author_number, author, work, a, b) AS (VALUES (0, '1', 7, 'Plato', 'Republic', '#c', '453b'), (0, '1', 7, 'Plato', 'Republic', '457a', '457a'), (0, '2', 8, 'Aristotle', 'Metaphysics', '500a', '501b'), (0, '2', 8, 'Aristotle', 'Metaphysics', '500a', '501b'), (0, '2a', 7, 'Plato', 'Timaeus', '#a', '#a'),
  (1, '1', 7, 'Plato', 'Republic', '#c', '453b'), (1, '1', 7, 'Plato', 'Laws', '640a', '640a'), (1, '1', 7, 'Plato', 'Laws', '641b', '641b'), (1, '1', 7, 'Plato', 'Laws', '650c', '650c'), (1, '1a', 8, 'Aristotle', 'Physics', '259a', '259a'))
SELECT vol, number, topic_label, author_number, author, work, replace(a, '#', vol::VARCHAR) AS page_start, replace(b, '#', vol::VARCHAR) AS page_end FROM c JOIN r ON odd = vol % 2""")
def citation_fold(spark, sf_dir):
    # a supplier's number is a page number here, of up to the digits of a long
    pages = P.page_ref(19)
    rows = G.chapter_lines(G.lines(_volumes(spark, sf_dir), "vol"), "vol")
    found = folds.citations(rows, ["vol", "number"], pages=pages)
    return found.select("vol", "number", "topic_label", "author_number", "author", P.work_title(F.col("work_raw"), pages).alias("work"), "page_start", "page_end")


@_register("""
WITH c AS (SELECT s_suppkey AS k FROM supplier)
SELECT k AS vol, 'Prose ' || k || chr(10) AS intro, 'OUTLINE OF TOPICS' || chr(10) || '1. One' || chr(10) AS outline, 'REFERENCES' || chr(10) || '7 Plato' || chr(10) AS refs, 'CROSS-REFERENCES' || chr(10) || 'For: ' || k || chr(10) AS crossrefs, 'ADDITIONAL READINGS' || chr(10) || 'Book' AS additional FROM c""")
def section_split(spark, sf_dir):
    k = F.col("s_suppkey").cast("string")
    text = F.concat(F.lit("Prose "), k, F.lit("\nOUTLINE OF TOPICS\n1. One\nREFERENCES\n7 Plato\nCROSS-REFERENCES\nFor: "), k, F.lit("\nADDITIONAL READINGS\nBook"))
    return _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("vol"), P.sections(text).alias("s")).select("vol", "s.*")


@_register("""
SELECT s_suppkey AS vol, unnest([1, 2]) AS number, unnest([2 + length(s_name), 31 + 2 * length(s_name)])::BIGINT AS start FROM supplier""")
def chapter_boundaries(spark, sf_dir):
    text = F.concat("s_name", F.lit("\n\nChapter 1: ANGEL\nlong text \n"), "s_name", F.lit("\nBEING\nINTRODUCTION follows here"))
    rows = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("vol"), text.alias("text"))
    return folds.chapter_boundaries(rows, "vol", [(1, "ANGEL"), (2, "BEING"), (3, "CAUSE")])


@_register("""
SELECT n_regionkey AS vol, 1 AS number, 'SAMPLE' AS name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey)::INT AS ord, n_nationkey::VARCHAR AS code, n_name AS description, ['7 PLATO: ' || n_name] AS refs FROM nation""")
def structured_references(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation")
    part = F.concat(F.lit("#"), F.col("n_nationkey").cast("string"), F.lit(". "), "n_name", F.lit("\n7 PLATO: "), "n_name")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", part.alias("p")))), lambda x: x["p"]), "\n")
    text = nation.groupBy(F.col("n_regionkey").alias("vol")).agg(F.concat(F.lit("lost line\n§==Chapter 1: Sample==\ndropped\n"), body).alias("text"))
    return G.structured_references(G.lines(text, "vol"), "vol")


@_register("""
SELECT s_suppkey AS vol, unnest(['PREFACE', 'EXPLANATION OF REFERENCE STYLE', 'A NOTE ON THE INDEX']) AS section, unnest([1, 2, 4]) AS ord,
  unnest(['This is a line of prose that is long enough ' || s_suppkey || chr(10) || chr(10) || 'a second paragraph goes on', 'Another line of prose that is also long enough', 'Its note has a line of prose that is long enough']) AS body FROM supplier""")
def front_matter(spark, sf_dir):
    text = F.concat(F.lit("Title\nPREFACE ix\nThis is a line of prose that is long enough "), F.col("s_suppkey").cast("string"), F.lit("\nPREFACE xii\n\n12\na second paragraph goes on\nEXPLANATION OF REFERENCE STYLE\n\nAnother line of prose that is also long enough\nA NOTE ON THE INDEX\nIts note has a line of prose that is long enough\nPREFACE\nChapter 1: ANGEL\nrest of it, in a line of prose that is long enough"))
    rows = G.lines(_t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("vol"), text.alias("text")), "vol")
    return G.front_matter(rows, "vol", G.FRONT_MATTER | {"A NOTE ON THE INDEX": 4})


@_register("""
SELECT s_suppkey AS vol, 'CHAPTER: ' || s_name || chr(10) || chr(10) || 'INTRODUCTION' || chr(10) || chr(10) || 'prose' || CASE WHEN s_suppkey % 2 = 0 THEN chr(10) || chr(10) || 'REFERENCES' || chr(10) || chr(10) || 'refs' ELSE '' END AS chapter,
 'prose' || chr(10) || chr(10) || 'REFERENCES' || chr(10) || chr(10) || CASE WHEN s_suppkey % 2 = 0 THEN 'refs' ELSE '[sem referências]' END AS combined, CASE WHEN s_suppkey % 2 = 0 THEN 'Chapter ' || s_suppkey || ': ' || s_name || chr(10) || chr(10) || 'refs' END AS map FROM supplier""")
def chapter_files(spark, sf_dir):
    refs, none = F.when(F.col("s_suppkey") % 2 == 0, "refs").otherwise(""), F.lit("")
    return _t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("vol"),
        files.chapter_file(F.col("s_name"), F.lit("prose"), none, refs, none).alias("chapter"),
        files.combined_file(F.lit("prose"), none, refs, none, none).alias("combined"),
        files.map_file(F.col("s_suppkey"), F.col("s_name"), refs).alias("map"),
    )


@_register(r"""
SELECT p_partkey, 'is one ever OUTLINE OF TOPICS ' || p_size AS unfused, 'Head ' || p_size || chr(10) || chr(10) || 'Tail' AS plain, CASE WHEN p_partkey % 3 = 0 THEN 'GOD' WHEN p_partkey % 3 = 1 THEN 'HONOR' ELSE 'LIFE AND DEATH' END AS idea,
  'A Man''S War-Peace ' || p_size || 'X' AS title, 'good-evil-' || p_size AS slug, 'car-of-god-' || p_size AS singular, '5' || p_size || '. Title' || chr(10) || 'plain line' || chr(10) || p_size || 'b. Other' AS codes,
  'x REFERENCES in a line' || chr(10) AS intro, 'OUTLINE OF TOPICS' || chr(10) || p_size || '. One' || chr(10) AS outline, 'REFERENCES' || chr(10) || 'r' AS refs, 'ph' || p_size AS name_key FROM part""")
def text_rules(spark, sf_dir):
    n = F.col("p_size").cast("string")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    idea = F.when(F.col("p_partkey") % 3 == 0, " CiOD ").when(F.col("p_partkey") % 3 == 1, "IIONOR").otherwise("LIFE  AND\nDEATH")
    strict = P.sections(text("x REFERENCES in a line\nOUTLINE OF TOPICS\n", n, ". One\nREFERENCES\nr"), strict=True)
    return _t(spark, sf_dir, "part").select(
        "p_partkey",
        T.split_fused_headers(text("is one everOUTLINE OF TOPICS ", n)).alias("unfused"),
        T.strip_boilerplate(text("Head ", n, "\nTo find the passages cited, see x\ny consult the Preface.\nTail")).alias("plain"),
        T.clean_idea_name(idea).alias("idea"),
        T.title_case(text("a man's WAR-peace ", n, "x")).alias("title"),
        T.slug(text(" Good & Evil ", n)).alias("slug"),
        T.singular_slug(text("Cars of gods ", n)).alias("singular"),
        T.fix_outline_codes(text("S", n, ". Title\nplain line\n", n, "^. Other")).alias("codes"),
        strict["intro"].alias("intro"), strict["outline"].alias("outline"), strict["refs"].alias("refs"),
        S.name_key(text("P. H. ", n)).alias("name_key"),
    )


@_register("""
WITH f AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'Notes ' || s_suppkey || '.pdf' WHEN s_suppkey % 3 = 1 THEN 'Great, Volume ' || s_suppkey || '.PDF' ELSE 'Volume ' || s_suppkey || '.txt' END AS name, s_suppkey * 1000 AS size, s_suppkey FROM supplier)
SELECT CASE WHEN s_suppkey % 3 = 1 THEN s_suppkey::INT END AS vol, name, size, (SELECT count(*) FROM f WHERE s_suppkey % 3 <> 2) AS files FROM f WHERE s_suppkey % 3 <> 2""")
def remote_listing(spark, sf_dir):
    k = F.col("s_suppkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("Notes "), k, F.lit(".pdf"))).when(k % 3 == 1, F.concat(F.lit("Great, Volume "), k, F.lit(".PDF"))).otherwise(F.concat(F.lit("Volume "), k, F.lit(".txt")))
    listed = files.listing(spark, _t(spark, sf_dir, "supplier").select(name.alias("name"), (k * 1000).alias("size")))
    # the report has one row
    return listed.crossJoin(F.broadcast(files.listing_report(listed).select("files")))


@_register("SELECT n_nationkey::VARCHAR AS k, n_name AS v, CASE WHEN n_regionkey % 2 = 0 THEN n_regionkey::VARCHAR END AS r FROM nation")
def csv_round_trip(spark, sf_dir):
    """A table written as CSV, all fields as text, and read back."""
    path = f"{shared.folder(spark)}/csv-{spark.sparkContext.applicationId}-{next(_numbers)}"
    rows = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"), F.when(F.col("n_regionkey") % 2 == 0, F.col("n_regionkey")).alias("r"))
    files.write_csv(rows, path)
    return spark.read.option("header", True).csv(path)


@_register("SELECT n_regionkey AS k, count(*) AS n, max(CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END) AS v FROM nation WHERE n_regionkey <> 2 GROUP BY 1")
def partitions_reloaded(spark, sf_dir):
    """Partitions of a table: one loaded anew, one deleted, the others as they were."""
    path = f"{shared.folder(spark)}/parts-{spark.sparkContext.applicationId}-{next(_numbers)}"
    rows = _t(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("k"), F.col("n_name").alias("v"))
    files.replace_partitions(rows, path, "k")
    files.replace_partitions(rows.filter("k = 1").withColumn("v", F.lower("v")), path, "k", [1, 2])
    return spark.read.schema("v string, k int").parquet(path).groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("v"))


# Layout.


def _blocks(spark, sf_dir) -> DataFrame:
    """Line items as blocks of pages, an order a page."""
    n = F.col("l_linenumber")
    left = F.when(n % 2 == 1, 40.0).otherwise(320.0)
    return _t(spark, sf_dir, "lineitem").select(
        F.floor(F.col("l_orderkey") / 50).alias("doc"), F.col("l_orderkey").cast("int").alias("page"), F.lit(600.0).alias("width"), F.lit(800.0).alias("height"),
        left.alias("x0"), (n * 150.0).alias("y0"), F.when(F.col("l_quantity") > 45, 590.0).otherwise(left + 240).alias("x1"), (n * 150.0 + 90).alias("y1"),
        F.concat(F.lit("block "), F.col("l_partkey").cast("string")).alias("text"), F.lit(0).alias("btype"),
    )


_BLOCKS_SQL = "SELECT l_orderkey // 50 AS doc, l_orderkey::INT AS page, CASE WHEN l_linenumber % 2 = 1 THEN 40.0 ELSE 320.0 END AS x0, l_linenumber * 150.0 AS y0, CASE WHEN l_quantity > 45 THEN 590.0 WHEN l_linenumber % 2 = 1 THEN 280.0 ELSE 560.0 END AS x1, l_linenumber * 150.0 + 90 AS y1, 'block ' || l_partkey AS text FROM lineitem"


@_register(f"""
WITH b AS (SELECT *, CASE WHEN x1 <= 312 THEN 'a' WHEN x0 >= 288 THEN 'b' END AS col FROM ({_BLOCKS_SQL}))
SELECT doc, page, col, string_agg(text, chr(10) ORDER BY y0, x0, text) AS text FROM b WHERE col IS NOT NULL GROUP BY 1, 2, 3""")
def layout_columns(spark, sf_dir):
    return layout.columns(_blocks(spark, sf_dir), ["doc", "page"])


@_register(f"SELECT doc, page, avg((abs((x0 + x1) / 2 - 300) <= 12)::INT) > 0.4 AS single FROM ({_BLOCKS_SQL}) GROUP BY 1, 2")
def single_column(spark, sf_dir):
    return layout.single_column(_blocks(spark, sf_dir), ["doc", "page"])


@_register(f"SELECT doc, page, text, row_number() OVER (PARTITION BY doc ORDER BY page, (x0 >= 300)::INT, y0, x0, text)::INT AS pos FROM ({_BLOCKS_SQL})")
def reading_order(spark, sf_dir):
    return layout.reading_order(_blocks(spark, sf_dir), ["doc"]).select("doc", "page", "text", "pos")


@_register(f"""
WITH b AS (SELECT *, CASE WHEN x1 <= 312 THEN 'a' WHEN x0 >= 288 THEN 'b' END AS col FROM ({_BLOCKS_SQL})),
c AS (SELECT doc, page, col, string_agg(text, chr(10) ORDER BY y0, x0, text) AS text FROM b WHERE col IS NOT NULL AND page >= 1 GROUP BY 1, 2, 3)
SELECT doc, string_agg('[' || page || col || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY page, col) AS text FROM c GROUP BY doc""")
def formatted_pages(spark, sf_dir):
    return layout.formatted_pages(layout.columns(_blocks(spark, sf_dir), ["doc", "page"]), ["doc"], "page")


@_register(f"""
WITH o AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY page, (x0 >= 300)::INT, y0, x0, text) AS pos, x0 - CASE WHEN x0 < 300 THEN 40.0 ELSE 310.0 END AS indent, substring(text, 7)::INT AS k FROM ({_BLOCKS_SQL})),
t AS (SELECT *, CASE k % 4 WHEN 0 THEN 'block ' || k WHEN 1 THEN 'A block ' || k || '-' WHEN 2 THEN 'block ' || k || '-' ELSE '"A block ' || k END AS text FROM o),
f AS (SELECT *, lag(text) OVER (PARTITION BY doc ORDER BY pos) AS before FROM t),
g AS (SELECT *, sum((before IS NULL OR (indent >= 8 AND NOT regexp_matches(text, '^[a-z]') AND NOT before LIKE '%-'))::INT) OVER (PARTITION BY doc ORDER BY pos) AS para FROM f)
SELECT doc, para::INT AS para, replace(string_agg(text, ' ' ORDER BY pos), '- ', '') AS text FROM g GROUP BY doc, para""")
def block_paragraphs(spark, sf_dir):
    rows = layout.reading_order(_blocks(spark, sf_dir), ["doc"]).withColumn("margin", F.when(F.col("col") == 0, 40.0).otherwise(310.0))
    k = F.substr("text", F.lit(7)).cast("int")
    before, after = F.when(k % 4 == 1, "A block ").when(k % 4 == 3, '"A block ').otherwise("block "), F.when((k % 4).isin(1, 2), "-").otherwise("")
    text = F.concat(before, k.cast("string"), after)
    return folds.block_paragraphs(rows.withColumn("text", text), ["doc"])


# Entities.


@_register("""
WITH n AS (SELECT p_partkey AS k, p_brand AS block, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS n FROM part)
SELECT a.block, left(a.n, 3) AS prefix, a.k AS a, b.k AS b, a.n AS name_a, b.n AS name_b FROM n a JOIN n b ON a.block = b.block AND left(a.n, 3) = left(b.n, 3) AND a.k < b.k AND abs(length(a.n) - length(b.n)) <= 4""")
def blocked_pairs(spark, sf_dir):
    return E.blocked_pairs(_t(spark, sf_dir, "part"), "p_partkey", "p_name", "p_brand")


@_register()
def fuzzy_author_lookup(spark, sf_dir):
    words = F.concat(F.element_at(F.split("p_name", " "), 1), F.lit(" "), F.element_at(F.split("p_name", " "), -1))
    known = _t(spark, sf_dir, "part").groupBy(words.alias("name")).agg(F.min("p_partkey").alias("id"))
    scanned = known.select(F.regexp_replace(F.regexp_replace("name", "i", "l"), "^.", "F").alias("seen"))
    return E.fuzzy_lookup(scanned, "seen", known, "name", "id")


@_register()
def fuzzy_author_merge(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 3 == 0, F.regexp_replace("p_name", "e", "c")).otherwise(F.col("p_name"))
    names = part.groupBy(name.alias("name"), F.col("p_size").alias("number")).agg(F.min("p_partkey").alias("id"))
    return E.merge_authors(names)


@_register("""
WITH a AS (SELECT p_partkey AS id, p_name AS name, p_size AS number, (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 48) AS n_refs FROM part),
c AS (SELECT *, regexp_replace(lower(name), '[^a-z]', '', 'g') AS canon FROM a),
r AS (SELECT *, row_number() OVER (PARTITION BY number, canon ORDER BY (n_refs > 0) DESC, id) AS k FROM c)
SELECT id, name, number, n_refs FROM r WHERE k = 1 AND n_refs > 0""")
def volume_split_collapse(spark, sf_dir):
    authors = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("number"))
    return E.collapse_splits(C.counted(authors, "id", _t(spark, sf_dir, "lineitem").filter("l_quantity > 48"), "l_partkey", "n_refs")).select("id", "name", "number", "n_refs")


@_register(r"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM documents), s AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM t),
p AS (SELECT doc_id, len(t) AS length, unnest(t) AS term FROM t), f AS (SELECT doc_id, length, term, count(*) AS tf FROM p WHERE term IN ('the', 'of', 'and') GROUP BY ALL),
d AS (SELECT term, count(*) AS df FROM f GROUP BY term),
r AS (SELECT doc_id AS doc, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS score FROM f JOIN d USING (term) CROSS JOIN s GROUP BY doc_id HAVING count(*) = 3)
SELECT doc, round(score, 6) AS score FROM r ORDER BY r.score DESC, doc LIMIT 20""")
def search_bm25(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    found = search.search(search.postings(docs, "doc_id", ["text"]), search.statistics(docs, "doc_id", ["text"]), "the OF, and", 20)
    return found.select("doc", F.round("score", 6).alias("score"))


_HITS_SQL = """SELECT o_orderkey AS id, (o_custkey % 5)::BIGINT AS idea_number, (o_orderkey % 7 + 1)::VARCHAR AS topic_label, (o_custkey % 10)::BIGINT AS author_id, (o_orderkey % 200)::BIGINT AS work_id, o_custkey % 90 + 1 || 'a' AS page_start, o_custkey % 90 + 2 || 'b' AS page_end,
  CASE WHEN o_orderkey % 2 = 0 THEN 'bk ' || o_orderkey % 7 + 1 || ' of the Évidence ' || o_orderstatus ELSE 'of evidence, ch ' || o_orderkey % 7 + 1 END AS ref_text FROM orders"""


def _references(spark, sf_dir) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    n, page = (k % 7 + 1).cast("string"), c % 90
    text = F.when(k % 2 == 0, F.concat(F.lit("bk "), n, F.lit(" of the Évidence "), "o_orderstatus")).otherwise(F.concat(F.lit("of evidence, ch "), n))
    return _t(spark, sf_dir, "orders").select(
        k.alias("id"), (c % 5).alias("idea_number"), n.alias("topic_label"), (c % 10).alias("author_id"), (k % 200).alias("work_id"),
        F.concat((page + 1).cast("string"), F.lit("a")).alias("page_start"), F.concat((page + 2).cast("string"), F.lit("b")).alias("page_end"), text.alias("ref_text"),
    )


def _search(spark, sf_dir, query: str, limit: int) -> DataFrame:
    """``query`` over references' texts, works' titles and authors' names, shown with all that they belong to; nations stand for volumes, regions for ideas."""
    refs = _references(spark, sf_dir)
    authors = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    works = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), (F.col("p_partkey") % 30).cast("int").alias("volume_id"))
    volumes = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("number"), F.col("n_name").alias("display_name"))
    ideas = _t(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("number"), F.col("r_name").alias("name"))
    topics = _t(spark, sf_dir, "nation").filter("n_nationkey < 20").select((F.col("n_nationkey") % 5).cast("long").alias("idea_number"), (F.floor(F.col("n_nationkey") / 5) + 1).cast("string").alias("label"), F.col("n_name").alias("title"))
    indexed = refs.select("id", "ref_text", "author_id", "work_id").join(authors.withColumnRenamed("id", "author_id"), "author_id").join(works.select(F.col("id").alias("work_id"), "title"), "work_id")
    fields = ["ref_text", "title", "name"]
    found = search.match(search.positions(indexed, "id", fields), search.lengths(indexed, "id", fields), query, limit)
    return search.hits(found, refs, authors, works, volumes, ideas, topics).withColumn("score", F.round("score", 6))


_FOUND_SQL = r"""
r AS ({refs}), i AS (SELECT r.*, s_name AS author_name, p_name AS work_title, (p_partkey % 30)::INT AS volume_id FROM r JOIN supplier ON s_suppkey = author_id JOIN part ON p_partkey = work_id),
t AS (SELECT id, ' ' || trim(regexp_replace(strip_accents(lower(ref_text)), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' ' AS f1, ' ' || trim(regexp_replace(lower(work_title), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' ' AS f2, ' ' || trim(regexp_replace(lower(author_name), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' ' AS f3 FROM i),
n AS (SELECT *, len(regexp_extract_all(f1 || f2 || f3, '[\p{{L}}\p{{N}}]+')) AS length FROM t),
a AS (SELECT id, length, {counts} FROM n),
s AS (SELECT count(*) AS rows, avg(length) AS mean, {dfs} FROM a),
f AS (SELECT id, round({score}, 9) AS score FROM a CROSS JOIN s WHERE {where} ORDER BY 2 DESC, 1 LIMIT {limit})
SELECT id, idea_number, r_name AS idea_name, topic_label, o.n_name AS topic_title, author_name, work_title, volume_id, v.n_name AS volume_display, page_start, page_end, ref_text, round(score, 6) AS score
FROM f JOIN i USING (id) LEFT JOIN nation v ON v.n_nationkey = volume_id JOIN region ON r_regionkey = idea_number LEFT JOIN nation o ON o.n_nationkey < 20 AND o.n_nationkey % 5 = idea_number AND (o.n_nationkey // 5 + 1)::VARCHAR = topic_label"""


def _found_sql(patterns: list[str], where: str, limit: int) -> str:
    """SQL of a search for patterns, each counted in three fields."""
    counts = ", ".join(" + ".join(f"len(regexp_extract_all({f}, '{p}'))" for f in ("f1", "f2", "f3")) + f" AS tf{k}" for k, p in enumerate(patterns))
    dfs = ", ".join(f"count(*) FILTER (tf{k} > 0) AS df{k}" for k in range(len(patterns)))
    score = " + ".join(f"greatest(ln((rows - df{k} + 0.5) / (df{k} + 0.5)), 1e-6) * tf{k} * 2.2 / (tf{k} + 1.2 * (0.25 + 0.75 * length / mean))" for k in range(len(patterns)))
    return "WITH " + _FOUND_SQL.format(refs=_HITS_SQL, counts=counts, dfs=dfs, score=score, where=where, limit=limit)


@_register(_found_sql([" of the evidence ", " supplier ", " 00000000[^ ]*"], "tf0 > 0 AND tf1 > 0 AND tf2 > 0", 50))
def search_hits(spark, sf_dir):
    return _search(spark, sf_dir, 'SUPPLIER "of the évidence" AND 00000000*', 50)


@_register(_found_sql([" ch ", " 3", " 000000002 ", " evidence "], "((tf0 > 0 AND tf1 > 0) OR tf2 > 0) AND NOT (tf3 > 0 AND tf0 = 0)", 40).replace("' 3'", "' 3 '"))
def search_boolean(spark, sf_dir):
    # the last atom is in every text: it shuts out what has no chapter
    return _search(spark, sf_dir, "((ch AND 3) OR 000000002) NOT (evidence NOT ch)", 40)


@_register(f"WITH p AS ({_PAGES_SQL}) SELECT DISTINCT volume_id, page_marker FROM p WHERE EXISTS (SELECT 1 FROM p q WHERE q.volume_id = p.volume_id AND q.page_marker = p.page_marker AND q.text_offset % 7 = 0)")
def pages_by_markers(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return C.pages_of(pages, pages.filter("text_offset % 7 = 0")).select("volume_id", "page_marker").distinct()


@_register(f"""
WITH p AS (SELECT DISTINCT volume_id, page_marker FROM ({_PAGES_SQL})),
r AS (SELECT (l_suppkey % 54 + 1)::INT AS volume_id, l_orderkey AS ref, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity::INT || 'c' ELSE (l_quantity::INT)::VARCHAR END AS page_start FROM lineitem WHERE l_linenumber <> 3)
SELECT volume_id, page_marker, count(*) AS n, min(ref) AS first_ref FROM p JOIN r USING (volume_id) WHERE page_marker = CASE WHEN regexp_matches(page_start, '[a-d]$') THEN page_start ELSE page_start || 'a' END GROUP BY ALL""")
def references_on_pages(spark, sf_dir):
    q, n = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber")
    # line 3 has no page that could be read
    start = F.when(n == 3, "?").when(n % 2 == 0, F.concat(q, F.lit("c"))).otherwise(q)
    refs = _t(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 54 + 1).cast("int").alias("volume_id"), F.col("l_orderkey").alias("ref"), start.alias("page_start"))
    return C.references_on_pages(refs, _pages(spark, sf_dir)).groupBy("volume_id", "page_marker").agg(F.count("*").alias("n"), F.min("ref").alias("first_ref"))


@_register("SELECT s_suppkey % 2 + 2 AS volume_id, s_suppkey % 102 + 1 AS number, s_name AS name FROM supplier WHERE (s_suppkey % 2 = 0 AND s_suppkey % 102 + 1 <= 50) OR (s_suppkey % 2 = 1 AND s_suppkey % 102 + 1 >= 51)")
def merged_chapters(spark, sf_dir):
    k = F.col("s_suppkey")
    chapters = _t(spark, sf_dir, "supplier").select((k % 2 + 2).alias("volume_id"), (k % 102 + 1).alias("number"), F.col("s_name").alias("name"))
    return C.merge_volumes(chapters, [(2, 1, 50), (3, 51, 102)])


@_register("""
WITH a AS (SELECT p_partkey AS k, p_name AS n FROM part)
SELECT k, array_to_string(list_sort(list_distinct([regexp_replace(w, 's$', '') FOR w IN string_split(lower(n), ' ') IF w <> ''])), '-') AS key FROM a""")
def word_set_keys(spark, sf_dir):
    # the words of a name in reverse, with an "&" and a plural, have the key of the name
    words = F.split("p_name", " ")
    other = F.concat(F.array_join(F.reverse(words), " & "), F.lit("s-"), F.upper(words[0]))
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), T.word_set(other).alias("key"))


@_register("""
WITH m AS (SELECT min(p_partkey) OVER (PARTITION BY p_brand, p_name) AS canonical, p_partkey AS variant FROM part),
w AS (SELECT canonical AS id FROM m GROUP BY 1), a AS (SELECT DISTINCT l_suppkey AS author_id, canonical AS work_id FROM lineitem JOIN m ON variant = l_partkey), r AS (SELECT canonical AS work_id FROM lineitem JOIN m ON variant = l_partkey)
SELECT id, (SELECT count(*) FROM a WHERE work_id = id) AS n_authors, (SELECT count(*) FROM r WHERE work_id = id) AS n_refs FROM w""")
def works_merged(spark, sf_dir):
    from pyspark.sql import Window

    part, line = _t(spark, sf_dir, "part"), _t(spark, sf_dir, "lineitem")
    mapping = part.select(F.col("p_partkey").alias("variant"), F.min("p_partkey").over(Window.partitionBy("p_brand", "p_name")).alias("canonical"))
    pairs = line.select(F.col("l_suppkey").alias("author_id"), F.col("l_partkey").alias("work_id"))
    merged = C.merge_works(part.select(F.col("p_partkey").alias("id")), pairs.distinct(), pairs, mapping)
    out = C.counted(merged["works"], "id", merged["authorships"], "work_id", "n_authors")
    return C.counted(out, "id", merged["references"], "work_id", "n_refs")


@_register("SELECT 'authors' AS name, count(*) AS n_rows FROM supplier UNION ALL SELECT 'references', count(*) FROM lineitem UNION ALL SELECT 'works', count(*) FROM part")
def build_statistics(spark, sf_dir):
    return C.build_statistics({"authors": _t(spark, sf_dir, "supplier"), "references": _t(spark, sf_dir, "lineitem"), "works": _t(spark, sf_dir, "part")})


@_register("""
WITH l AS (SELECT l_orderkey AS doc, l_linenumber AS n, CASE WHEN l_linenumber % 2 = 1 THEN 40.0 ELSE 320.0 END AS x, l_partkey::VARCHAR AS t, max(l_quantity) OVER (PARTITION BY l_orderkey) > 45 AS wide, count(DISTINCT l_linenumber % 2) OVER (PARTITION BY l_orderkey) > 1 AS both_sides FROM lineitem),
k AS (SELECT *, CASE WHEN wide THEN (x >= 300)::INT ELSE 0 END AS col FROM l WHERE NOT wide OR both_sides)
SELECT doc, col, min(CASE WHEN wide THEN x ELSE 40.0 END) AS x0, string_agg(t, ' ' ORDER BY n, t) AS text FROM k GROUP BY 1, 2""")
def spine_split(spark, sf_dir):
    from pyspark.sql import Window

    n, order = F.col("l_linenumber"), Window.partitionBy("l_orderkey")
    right = F.when(F.max("l_quantity").over(order) > 45, 560.0).otherwise(280.0)
    rows = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc"), F.lit(1).alias("page"), F.lit(1).alias("block"), F.lit(600.0).alias("width"), F.lit(40.0).alias("bx0"), F.lit(10.0).alias("by0"), right.alias("bx1"),
        F.when(n % 2 == 1, 40.0).otherwise(320.0).alias("lx0"), (n * 12.0).alias("ly0"), n.alias("line_no"), F.col("l_partkey").cast("string").alias("text"),
    )
    return layout.split_at_spine(rows, ["doc"]).select("doc", "col", "x0", "text")


# Streams.


@_register("SELECT event_type, count(*) AS n, sum(event_id) AS ids FROM events GROUP BY event_type")
def stream_drain(spark, sf_dir):
    """The events as a watched folder, taken by a stream in one available-now run."""
    schema = _t(spark, sf_dir, "events").schema
    base = f"{shared.folder(spark)}/drain-{spark.sparkContext.applicationId}-{abs(hash(sf_dir)) % 10**8}-{next(_numbers)}"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    watch.drain(stream, f"{base}/out", f"{base}/state", lambda rows: rows.select("event_id", "event_type"))
    watch.drain(stream, f"{base}/out", f"{base}/state", lambda rows: rows.select("event_id", "event_type"))
    return spark.read.schema("event_id long, event_type string").parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


_numbers = iter(range(10**9))
