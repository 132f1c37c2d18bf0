"""Resolution, spatial joins, reconciliation and case selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopy.functions import spatial, text
from canopy.operators import dedup, merge, resolve
from canopy.plans import bindings as b

_GRAMS = r"(SELECT list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i::INT, 3))))))"


def place_ladder(spark: SparkSession, sf: str) -> DataFrame:
    r = resolve.resolve(b.place_requests(spark, sf), *b.address_registry(spark, sf), b.areas(spark, sf))
    return r.withColumn("caveats", F.array_join("caveats", ","))


def place_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Share of each level: the whole is summed in one row and joined, no window over all rows."""
    n = place_ladder(spark, sf).groupBy(F.coalesce("level", F.lit("none")).alias("level")).agg(F.count("*").alias("n"))
    order = F.when(F.col("level") == "address", 1).when(F.col("level") == "postcode", 2).when(F.col("level") == "buurt", 3).otherwise(4)
    return n.select("level", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 3).alias("share"), order.alias("rank")).orderBy("rank")


def area_of_point(spark: SparkSession, sf: str) -> DataFrame:
    """Points of orders in the smallest area that holds them, with the area's parent; points in none stay."""
    points = b.place_requests(spark, sf).select("id", "x", "y")
    a = b.areas(spark, sf)
    return points.join(resolve.areas_of(points, a), "id", "left").join(a.select("area", "code", "parent"), "area", "left").select("id", "area", "code", "parent")


def permit_placement(spark: SparkSession, sf: str) -> DataFrame:
    requests, areas = b.place_requests(spark, sf), b.areas(spark, sf)
    return resolve.placement(resolve.resolve(requests, *b.address_registry(spark, sf), areas), requests, areas)


def similar_names(spark: SparkSession, sf: str) -> DataFrame:
    parts = b.table(spark, sf, "part").select(F.col("p_name").alias("wanted")).distinct()
    streets = b.table(spark, sf, "part").select(F.reverse("p_name").alias("r"), "p_name").select(F.concat("p_name", F.lit(" x")).alias("naam")).distinct()
    return resolve.similar_streets(parts, streets).withColumn("sim", F.round("sim", 9))


def fallback_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Line items' trees under a first id that often misses, else a second that sometimes does."""
    li = b.fellings(spark, sf).select("felling", F.split("felling", "-")[2].cast("long").alias("part"))
    rows = li.select("felling", F.when(F.col("part") % 4 == 0, "").when(F.col("part") % 4 == 1, F.concat(F.lit("x"), F.col("part"))).otherwise(F.col("part").cast("string")).alias("tree_id"), F.when(F.col("part") % 8 != 1, F.col("part").cast("string")).alias("new_tree_id"))
    master = b.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("tree"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    r = resolve.fallback(rows, master, "tree_id", "new_tree_id")
    return r.groupBy("via").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("long")).alias("x_sum"))


def area_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Nations in regions, dangling ones kept and marked."""
    n = b.table(spark, sf, "nation").withColumn("parent", F.when(F.col("n_nationkey") % 7 == 0, 99).otherwise(F.col("n_regionkey")))
    r = b.table(spark, sf, "region")
    return n.join(r, F.col("parent") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", "r_name", F.col("r_regionkey").isNull().alias("dangling"))


def scoped_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of nations of one region: two chained semi-joins."""
    region = b.table(spark, sf, "region").filter("r_name LIKE 'A%'")
    nation = b.table(spark, sf, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    return b.table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", "c_nationkey")


def centroids(spark: SparkSession, sf: str) -> DataFrame:
    a = b.areas(spark, sf).withColumn("c", spatial.centroid(F.element_at("polygon", 1)))
    return a.select("area", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"), spatial.ewkt(F.round("c.x", 1), F.round("c.y", 1)).alias("ewkt"))


def nearest_vote(spark: SparkSession, sf: str) -> DataFrame:
    """By permit with a point, the area most of its fellings within 100 lie in."""
    p = b.permits(spark, sf).filter("x IS NOT NULL").select("zaak", F.col("x").alias("px"), F.col("y").alias("py"))
    p = p.withColumn("_c", F.explode(spatial.neighbour_cells(F.col("px"), F.col("py"), 100)))
    f = b.fellings(spark, sf).select(F.col("area"), F.col("x"), F.col("y"), spatial.cell(F.col("x"), 100).alias("cx"), spatial.cell(F.col("y"), 100).alias("cy"))
    near = p.join(f, (F.col("_c.cx") == F.col("cx")) & (F.col("_c.cy") == F.col("cy"))).filter((F.col("px") - F.col("x")) ** 2 + (F.col("py") - F.col("y")) ** 2 <= 10000)
    votes = near.groupBy("zaak", "area").agg(F.count("*").alias("votes"))
    return dedup.first_by(votes, ["zaak"], [F.col("votes").desc(), F.col("area")])


# Reconciliation ----------------------------------------------------------

def _now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


def _snapshots(spark, sf):
    c = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("raw"), F.col("c_acctbal").alias("amount"))
    k = F.col("id") % 10
    deleted = F.when(k.isin(7, 8), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    target = c.filter(k < 9)
    staging = c.filter(k.isin(0, 1, 2, 3, 7, 9)).withColumn("raw", F.when(k.isin(2, 7), F.concat("raw", F.lit("!"))).when(k == 3, F.lit(None)).otherwise(F.col("raw")))
    return target, staging, deleted


_SNAP_SQL = """c AS (SELECT c_custkey AS id, c_mktsegment AS raw, c_acctbal AS amount, c_custkey % 10 AS k FROM customer),
    t AS (SELECT id, raw, amount, CASE WHEN k IN (7, 8) THEN TIMESTAMP '2024-01-01' END AS source_deleted_at FROM c WHERE k < 9),
    s AS (SELECT id, CASE WHEN k IN (2, 7) THEN raw || '!' WHEN k = 3 THEN NULL ELSE raw END AS raw, amount FROM c WHERE k IN (0, 1, 2, 3, 7, 9)),
    j AS (SELECT t.id AS tid, s.id AS sid, t.raw AS traw, s.raw AS sraw, t.amount AS ta, s.amount AS sa, t.source_deleted_at AS td FROM t FULL JOIN s ON t.id = s.id)"""
_DEL_SQL = "CASE WHEN sid IS NULL THEN coalesce(td, TIMESTAMP '2024-06-01') END AS source_deleted_at"


def merge_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    t, s, d = _snapshots(spark, sf)
    return merge.keep_first_load(t.withColumn("source_deleted_at", d), s, ["id"], _now())


def merge_refresh(spark: SparkSession, sf: str) -> DataFrame:
    t, s, d = _snapshots(spark, sf)
    return merge.refresh(t.withColumn("source_deleted_at", d).withColumn("via", F.when(F.col("id") % 2 == 0, "tree_id")), s, ["id"], "raw", ["via"], _now())


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    t, s, _ = _snapshots(spark, sf)
    return merge.upsert(t.withColumn("loaded_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), s, ["id"], "loaded_at", _now())


def merge_metrics(spark: SparkSession, sf: str) -> DataFrame:
    t, s, _ = _snapshots(spark, sf)
    return merge.upsert_metrics(t.withColumn("run_id", F.lit("run-1")), s.withColumn("run_id", F.lit("run-2")), ["id"])


def merge_states(spark: SparkSession, sf: str) -> DataFrame:
    t, s, _ = _snapshots(spark, sf)
    return merge.changes(t, s, ["id"]).groupBy("state").agg(F.count("*").alias("n"))


# Cases -------------------------------------------------------------------


def _publications(spark, sf):
    o = b.table(spark, sf, "orders")
    kind = F.element_at(F.array(*[F.lit(k) for k in text.KINDS]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_custkey") % 17 != 0, F.col("o_custkey").cast("string")).alias("zaaknummer"), kind.alias("kind"), F.col("o_orderdate").cast("date").alias("available"))


_PUB_SQL = "pub AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 17 <> 0 THEN o_custkey::VARCHAR END AS zaaknummer, ['ontwerpbesluit', 'besluit', 'aanvraag', 'verlenging', 'ingetrokken'][(o_orderkey % 5 + 1)::INT] AS kind, o_orderdate::DATE AS available FROM orders)"
_CASE_SQL = _PUB_SQL + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY zaaknummer ORDER BY CASE kind WHEN 'besluit' THEN 0 ELSE 1 END, available DESC, id) AS rn FROM pub WHERE zaaknummer IS NOT NULL AND kind IN ('besluit', 'ontwerpbesluit')),
    cases AS (SELECT zaaknummer, count(*) AS n_publications FROM pub WHERE zaaknummer IS NOT NULL GROUP BY 1)"""


def select_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.audited_decisions(_publications(spark, sf))


def case_scope(spark: SparkSession, sf: str) -> DataFrame:
    """How many cases are audited, excluded, pending, unresolved or keyless."""
    pubs = _publications(spark, sf)
    cases = dedup.audited_decisions(pubs).withColumn("area_code", F.when(F.col("decision") % 6 != 0, F.when(F.col("decision") % 3 == 1, "N01").otherwise("A01")))
    keyless = pubs.filter("zaaknummer IS NULL").select(F.lit(None).cast("string").alias("zaaknummer"), F.lit(None).cast("long").alias("decision"), F.lit(None).cast("string").alias("area_code"))
    return resolve.scope(cases.select("zaaknummer", "decision", "area_code").unionByName(keyless)).groupBy("status").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (place_ladder, place_levels, area_of_point, permit_placement, similar_names, fallback_lookup, area_hierarchy, scoped_areas, centroids, nearest_vote, merge_keep_first, merge_refresh, merge_upsert, merge_metrics, merge_states, select_decisions, case_scope)}

_LADDER_SQL = f"""{b.REGISTRY_SQL},
    found AS (SELECT n.*, s.naam FROM numbers n LEFT JOIN streets s ON n.street = s.ident),
    one AS (SELECT r.id, 'postcode_number' AS via, f.ident, ax, ay, coalesce(f."begin" <= r.asked AND (f."end" IS NULL OR f."end" > r.asked), false) AS valid, 0.0 AS sim FROM requests r JOIN found f USING (postcode, huisnummer)),
    named AS (SELECT id, huisnummer, asked, lower(street) AS wanted FROM requests WHERE street IS NOT NULL AND huisnummer IS NOT NULL AND id NOT IN (SELECT id FROM one)),
    two AS (SELECT r.id, 'street' AS via, f.ident, ax, ay, coalesce(f."begin" <= r.asked AND (f."end" IS NULL OR f."end" > r.asked), false) AS valid, 0.0 AS sim FROM named r JOIN found f ON r.wanted = lower(f.naam) AND r.huisnummer = f.huisnummer),
    rest AS (SELECT * FROM named WHERE id NOT IN (SELECT id FROM two)),
    g1 AS (SELECT wanted, {_GRAMS.format('wanted')} AS g FROM (SELECT DISTINCT wanted FROM rest)), g2 AS (SELECT naam, {_GRAMS.format('naam')} AS h FROM (SELECT DISTINCT lower(naam) AS naam FROM found WHERE naam IS NOT NULL)),
    likes AS (SELECT wanted, naam, len(list_intersect(g, h)) / len(list_distinct(list_concat(g, h))) AS sim FROM g1, g2 WHERE len(list_intersect(g, h)) / len(list_distinct(list_concat(g, h))) > 0.55),
    three AS (SELECT r.id, 'fuzzy' AS via, f.ident, ax, ay, coalesce(f."begin" <= r.asked AND (f."end" IS NULL OR f."end" > r.asked), false) AS valid, l.sim FROM rest r JOIN likes l USING (wanted) JOIN found f ON lower(f.naam) = l.naam AND f.huisnummer = r.huisnummer),
    hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, valid DESC, ident) AS rn FROM (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three)) WHERE rn = 1),
    pip AS (SELECT id, min(area) AS area FROM requests JOIN areas ON x > x0 AND x < x0 + 540 AND y > y0 AND y < y0 + 490 GROUP BY id),
    lad AS (SELECT r.id, CASE WHEN h.ident IS NOT NULL THEN 'address' WHEN r.postcode IN (SELECT postcode FROM numbers) THEN 'postcode' WHEN p.area IS NOT NULL THEN 'buurt' END AS level, via, ident, ax, ay, p.area, valid FROM requests r LEFT JOIN hits h USING (id) LEFT JOIN pip p USING (id)),
    ladder AS (SELECT id, level, via, ident, ax, ay, CASE WHEN level = 'buurt' THEN area END AS area, CASE level WHEN 'address' THEN 90 WHEN 'postcode' THEN 70 WHEN 'buurt' THEN 50 END::INT AS cents,
      CASE WHEN level = 'address' THEN CASE WHEN valid THEN 'valid_at_date' ELSE 'any_time' END END AS time_match, CASE WHEN level = 'address' AND NOT valid THEN 'timeMismatch' WHEN level = 'buurt' THEN 'unresolvedLocation' ELSE '' END AS caveats FROM lad)"""

ORACLE = {
    "permit_placement": f"""WITH {_LADDER_SQL}, spot AS (SELECT l.id, l.level, l.area, CASE l.level WHEN 'address' THEN l.ax WHEN 'postcode' THEN r.x END AS x, CASE l.level WHEN 'address' THEN l.ay WHEN 'postcode' THEN r.y END AS y FROM ladder l JOIN requests r USING (id)),
        ins AS (SELECT spot.id, min(a.area) AS inside FROM spot JOIN areas a ON spot.x > x0 AND spot.x < x0 + 540 AND spot.y > y0 AND spot.y < y0 + 490 GROUP BY 1),
        pl AS (SELECT spot.id, level, CASE WHEN level = 'buurt' THEN spot.area ELSE inside END AS placed FROM spot LEFT JOIN ins USING (id)) SELECT pl.id, level, placed, code, placed IS NULL AS unresolved, coalesce(code LIKE 'N%', false) AS in_scope FROM pl LEFT JOIN areas a ON a.area = placed""",
    "place_ladder": f"WITH {_LADDER_SQL} SELECT * FROM ladder",
    "place_levels": f"WITH {_LADDER_SQL} SELECT coalesce(level, 'none') AS level, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 3) AS share, CASE coalesce(level, 'none') WHEN 'address' THEN 1 WHEN 'postcode' THEN 2 WHEN 'buurt' THEN 3 ELSE 4 END::INT AS rank FROM ladder GROUP BY 1",
    "area_of_point": f"WITH {b.REGISTRY_SQL}, pip AS (SELECT id, min(area) AS area FROM requests JOIN areas ON x > x0 AND x < x0 + 540 AND y > y0 AND y < y0 + 490 GROUP BY id) SELECT r.id, p.area, a.code, a.parent FROM requests r LEFT JOIN pip p USING (id) LEFT JOIN areas a USING (area)",
    "similar_names": f"WITH a AS (SELECT DISTINCT p_name AS wanted, {_GRAMS.format('p_name')} AS g FROM part), b AS (SELECT DISTINCT p_name || ' x' AS naam, {_GRAMS.format(chr(40) + 'p_name || chr(32) || chr(120)' + chr(41))} AS h FROM part), s AS (SELECT wanted, naam, len(list_intersect(g, h)) / len(list_distinct(list_concat(g, h))) AS sim FROM a, b) SELECT wanted, naam, round(sim, 9) AS sim FROM s WHERE sim > 0.55",
    "fallback_lookup": f"""WITH {b.FELLINGS_SQL}, r AS (SELECT felling, split_part(felling, '-', 3)::BIGINT AS part FROM fellings), q AS (SELECT felling, CASE part % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' || part ELSE part::VARCHAR END AS a, CASE WHEN part % 8 <> 1 THEN part::VARCHAR END AS b FROM r),
        m AS (SELECT p_partkey::VARCHAR AS tree, p_size AS x FROM part), v AS (SELECT CASE WHEN m1.tree IS NOT NULL THEN 'tree_id' WHEN m2.tree IS NOT NULL THEN 'new_tree_id' ELSE 'unresolved' END AS via, CASE WHEN m1.tree IS NOT NULL THEN m1.x ELSE m2.x END AS x
        FROM q LEFT JOIN m m1 ON nullif(q.a, '') = m1.tree LEFT JOIN m m2 ON nullif(q.b, '') = m2.tree) SELECT via, count(*) AS n, sum(x)::BIGINT AS x_sum FROM v GROUP BY via""",
    "area_hierarchy": "SELECT n_nationkey, n_name, r_name, r_regionkey IS NULL AS dangling FROM (SELECT *, CASE WHEN n_nationkey % 7 = 0 THEN 99 ELSE n_regionkey END AS parent FROM nation) LEFT JOIN region ON parent = r_regionkey",
    "scoped_areas": "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name LIKE 'A%'))",
    "centroids": f"WITH {b.REGISTRY_SQL} SELECT area, round((x0 + 270)::DOUBLE, 6) AS x, round((y0 + 245)::DOUBLE, 6) AS y, 'SRID=28992;POINT(' || (x0 + 270)::DOUBLE::VARCHAR || ' ' || (y0 + 245)::DOUBLE::VARCHAR || ')' AS ewkt FROM areas",
    "nearest_vote": f"""WITH {b.PERMITS_SQL}, {b.FELLINGS_SQL}, p AS (SELECT *, unnest([floor(x / 100)::BIGINT - 1, floor(x / 100)::BIGINT, floor(x / 100)::BIGINT + 1]) AS cx FROM permits WHERE x IS NOT NULL), f AS (SELECT *, floor(x / 100)::BIGINT AS cx FROM fellings),
        v AS (SELECT zaak, f.area, count(*) AS votes FROM p JOIN f USING (cx) WHERE (p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y) <= 10000 GROUP BY 1, 2) SELECT zaak, area, votes FROM (SELECT *, row_number() OVER (PARTITION BY zaak ORDER BY votes DESC, area) AS rn FROM v) WHERE rn = 1""",
    "merge_keep_first": f"WITH {_SNAP_SQL} SELECT coalesce(tid, sid) AS id, CASE WHEN tid IS NULL THEN sraw ELSE traw END AS raw, CASE WHEN tid IS NULL THEN sa ELSE ta END AS amount, {_DEL_SQL} FROM j",
    "merge_refresh": f"WITH {_SNAP_SQL} SELECT coalesce(tid, sid) AS id, CASE WHEN sid IS NULL THEN traw ELSE sraw END AS raw, CASE WHEN tid IS NULL THEN sa ELSE ta END AS amount, CASE WHEN tid % 2 = 0 THEN 'tree_id' END AS via, {_DEL_SQL} FROM j",
    "merge_upsert": f"WITH {_SNAP_SQL} SELECT coalesce(tid, sid) AS id, CASE WHEN sid IS NULL THEN traw ELSE sraw END AS raw, coalesce(ta, sa) AS amount, CASE WHEN tid IS NULL OR (sid IS NOT NULL AND (traw IS DISTINCT FROM sraw OR ta IS DISTINCT FROM sa)) THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '2024-01-01' END AS loaded_at FROM j",
    "merge_metrics": f"WITH {_SNAP_SQL} SELECT coalesce(tid, sid) AS id, CASE WHEN sid IS NULL THEN traw ELSE sraw END AS raw, coalesce(ta, sa) AS amount, CASE WHEN tid IS NULL OR (sid IS NOT NULL AND (traw IS DISTINCT FROM sraw OR ta IS DISTINCT FROM sa)) THEN 'run-2' ELSE 'run-1' END AS run_id FROM j",
    "merge_states": f"WITH {_SNAP_SQL} SELECT CASE WHEN tid IS NULL THEN 'new' WHEN sid IS NULL THEN 'gone' WHEN traw IS DISTINCT FROM sraw OR ta IS DISTINCT FROM sa THEN 'changed' ELSE 'same' END AS state, count(*) AS n FROM j GROUP BY 1",
    "select_decisions": f"WITH {_CASE_SQL} SELECT c.zaaknummer, n_publications, r.id AS decision, r.id IS NULL AS pending FROM cases c LEFT JOIN ranked r ON c.zaaknummer = r.zaaknummer AND rn = 1",
    "case_scope": f"""WITH {_CASE_SQL}, d AS (SELECT c.zaaknummer, r.id AS decision FROM cases c LEFT JOIN ranked r ON c.zaaknummer = r.zaaknummer AND rn = 1),
        s AS (SELECT CASE WHEN decision IS NULL THEN 'pending' WHEN decision % 6 = 0 THEN 'unresolved' WHEN decision % 3 = 1 THEN 'audited' ELSE 'excluded' END AS status FROM d UNION ALL SELECT 'keyless' FROM pub WHERE zaaknummer IS NULL) SELECT status, count(*) AS n FROM s GROUP BY 1""",
}
