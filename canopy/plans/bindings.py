"""Domain roles on the star-schema tables, in Spark and as SQL common table expressions.

Permits are open orders, fellings are line items, areas are grid squares by
supplier, addresses are customers in streets named after nations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.spatial import rectangle
from canopy.operators.resolve import best_known
from canopy.sources.files import small_tasks


SPREAD = 1 << 14


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_tasks(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, rows: int = SPREAD) -> DataFrame:
    """A table's rows by their first column over as many tasks as they need, however few files and row groups they come from.

    For rows that are about to become many: what a task holds then doesn't grow with the table.
    """
    return df.repartition(-(-df.count() // rows) or 1, df.columns[0])


def _areas(spark, sf):
    """How many areas there are, as a scalar subquery."""
    return table(spark, sf, "supplier").agg(F.count("*").alias("n")).scalar()


def permits(spark: SparkSession, sf: str) -> DataFrame:
    """zaak, pub, area, tier, x, y."""
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    o = o.withColumn("area", F.col("o_custkey") % _areas(spark, sf)).withColumn("tier", F.element_at(F.array(F.lit("address"), F.lit("postcode"), F.lit("buurt")), (F.col("o_orderkey") % 3 + 1).cast("int")))
    has = F.col("tier") != "buurt"
    x = ((F.col("area") % 32) * 400 + (F.col("o_orderkey") * 37) % 400).cast("double")
    y = (F.floor(F.col("area") / 32) * 400 + (F.col("o_orderkey") * 91) % 400).cast("double")
    return o.select(F.col("o_orderkey").alias("zaak"), F.col("o_orderdate").cast("date").alias("pub"), "area", "tier", F.when(has, x).alias("x"), F.when(has, y).alias("y"))


def fellings(spark: SparkSession, sf: str) -> DataFrame:
    """felling, felled, area, x, y: line items by their four-column key.

    They are dealt out first, as a task that reads would hold nearly all of its rows as groups of its own.
    """
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    g = table(spark, sf, "lineitem").select(*keys, "l_shipdate").repartition(*keys).groupBy(*keys).agg(F.min("l_shipdate").alias("felled"))
    g = g.withColumn("area", F.col("l_suppkey") % _areas(spark, sf))
    return g.select(
        F.concat_ws("-", *keys).alias("felling"),
        "felled",
        "area",
        ((F.col("area") % 32) * 400 + (F.col("l_partkey") * 53) % 400).cast("double").alias("x"),
        (F.floor(F.col("area") / 32) * 400 + (F.col("l_orderkey") * 29) % 400).cast("double").alias("y"),
    )


PERMITS_SQL = """permits AS (SELECT zaak, pub, area, tier, CASE WHEN tier <> 'buurt' THEN ((area % 32) * 400 + (zaak * 37) % 400)::DOUBLE END AS x,
    CASE WHEN tier <> 'buurt' THEN ((area // 32) * 400 + (zaak * 91) % 400)::DOUBLE END AS y FROM (
    SELECT o_orderkey AS zaak, o_orderdate::DATE AS pub, o_custkey % (SELECT count(*) FROM supplier) AS area, ['address', 'postcode', 'buurt'][(o_orderkey % 3 + 1)::INT] AS tier FROM orders WHERE o_orderstatus = 'P'))"""
FELLINGS_SQL = """fellings AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS felling, felled, area, ((area % 32) * 400 + (l_partkey * 53) % 400)::DOUBLE AS x,
    ((area // 32) * 400 + (l_orderkey * 29) % 400)::DOUBLE AS y FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, min(l_shipdate) AS felled, l_suppkey % (SELECT count(*) FROM supplier) AS area FROM lineitem GROUP BY ALL))"""
WINDOW_END_SQL = "(CASE WHEN month(pub) = 2 AND day(pub) = 29 THEN make_date(year(pub) + 3, 3, 1) ELSE (pub + INTERVAL 3 YEAR)::DATE END)"
PAIRS_SQL = f"""{PERMITS_SQL}, {FELLINGS_SQL},
    ends AS (SELECT *, {WINDOW_END_SQL} AS pub_end FROM permits),
    pairs AS (SELECT zaak, felling, tier, sqrt((p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y)) AS dist, date_diff('day', pub, felled::DATE) AS lag
      FROM ends p JOIN fellings f ON p.area = f.area AND felled BETWEEN pub::TIMESTAMP AND pub_end::TIMESTAMP
      UNION ALL SELECT zaak, felling, tier, sqrt((p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y)) AS dist, date_diff('day', pub, felled::DATE) AS lag
      FROM (SELECT *, unnest([floor(x / 200)::BIGINT - 1, floor(x / 200)::BIGINT, floor(x / 200)::BIGINT + 1]) AS cx FROM ends WHERE x IS NOT NULL) p
      JOIN (SELECT *, floor(x / 200)::BIGINT AS cx FROM fellings) f ON p.cx = f.cx AND p.area <> f.area AND felled BETWEEN pub::TIMESTAMP AND pub_end::TIMESTAMP
      AND (p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y) <= 40000)"""


# Addresses ---------------------------------------------------------------


def address_registry(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """streets, numbers and objects, best-known versions only."""
    streets = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("ident"), F.concat(F.lit("Straat van "), "n_name").alias("naam"))
    c = table(spark, sf, "customer")
    begin = F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 1500).cast("int"))
    numbers = c.select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("ident"),
        F.concat(F.lpad((F.col("c_custkey") % 400 + 1000).cast("string"), 4, "0"), F.lit("AA")).alias("postcode"),
        (F.col("c_custkey") % 97 + 1).cast("int").alias("huisnummer"),
        F.col("c_nationkey").cast("string").alias("street"),
        begin.alias("begin"),
        F.when(F.col("c_custkey") % 3 == 0, F.date_add(begin, (F.col("c_custkey") % 700).cast("int"))).alias("end"),
        F.lit(None).cast("date").alias("eindregistratie"),
    )
    # Some numbers were registered wrongly before; only what is best known counts.
    mistaken = numbers.filter(F.col("ident").cast("long") % 11 == 0).withColumn("huisnummer", F.col("huisnummer") + 1).withColumn("eindregistratie", F.col("begin"))
    numbers = best_known(numbers.unionByName(mistaken)).drop("eindregistratie")
    point = c.select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("number"), (F.col("c_custkey") % 3).alias("k"), (F.col("c_custkey") % 1000).cast("double").alias("x"), (F.floor(F.col("c_custkey") / 1000)).cast("double").alias("y"))
    home = point.filter("k = 0").drop("k")
    berth = point.filter("k = 1").select("number", F.expr("x - 5 + 5").alias("x"), "y")
    stand = point.filter("k = 2").drop("k")
    return streets, numbers, home.unionByName(berth).unionByName(stand)


def place_requests(spark: SparkSession, sf: str) -> DataFrame:
    """id, postcode, huisnummer, street, at, x, y: exact, misspelt, partial and point-only requests."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 4
    name = F.concat(F.lit("straat VAN nation_"), (F.col("o_custkey") % 30).cast("string"))
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.when(k.isin(0, 2), F.concat(F.lpad((F.col("o_custkey") % 450 + 1000).cast("string"), 4, "0"), F.lit("AA"))).alias("postcode"),
        F.when(k != 3, (F.col("o_custkey") % 97 + 1).cast("int")).alias("huisnummer"),
        F.when(k == 1, name).when(k == 2, F.concat(F.lit("Strat van Nation_"), (F.col("o_custkey") % 30).cast("string"))).alias("street"),
        F.col("o_orderdate").cast("date").alias("at"),
        ((F.col("o_orderkey") * 7) % 2900).cast("double").alias("x"),
        ((F.col("o_orderkey") * 13) % 2900).cast("double").alias("y"),
    )


def areas(spark: SparkSession, sf: str) -> DataFrame:
    """area, code, parent, polygon: a square a nation on a grid of 500, each but the last row overlapping the next."""
    nk = F.col("n_nationkey")
    x, y = (nk % 5) * 500 + 3, F.floor(nk / 5) * 500 + 7
    return table(spark, sf, "nation").select(
        F.concat(F.lit("area-"), F.lpad(nk.cast("string"), 2, "0")).alias("area"),
        F.concat(F.when(nk % 2 == 0, "N").otherwise("A"), F.lpad(nk.cast("string"), 2, "0")).alias("code"),
        F.col("n_regionkey").alias("parent"),
        rectangle(x, y, x + 540, y + 490).alias("polygon"),
    )


REGISTRY_SQL = """streets AS (SELECT n_nationkey::VARCHAR AS ident, 'Straat van ' || n_name AS naam FROM nation),
    numbers AS (SELECT lpad(c_custkey::VARCHAR, 9, '0') AS ident, lpad((c_custkey % 400 + 1000)::VARCHAR, 4, '0') || 'AA' AS postcode, (c_custkey % 97 + 1)::INT AS huisnummer, c_nationkey::VARCHAR AS street,
      b AS "begin", CASE WHEN c_custkey % 3 = 0 THEN b + (c_custkey % 700)::INT END AS "end", (c_custkey % 1000)::DOUBLE AS ax, (c_custkey // 1000)::DOUBLE AS ay
      FROM (SELECT *, DATE '1994-01-01' + (c_custkey % 1500)::INT AS b FROM customer)),
    requests AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 IN (0, 2) THEN lpad((o_custkey % 450 + 1000)::VARCHAR, 4, '0') || 'AA' END AS postcode,
      CASE WHEN o_orderkey % 4 <> 3 THEN (o_custkey % 97 + 1)::INT END AS huisnummer,
      CASE o_orderkey % 4 WHEN 1 THEN 'straat VAN nation_' || (o_custkey % 30)::VARCHAR WHEN 2 THEN 'Strat van Nation_' || (o_custkey % 30)::VARCHAR END AS street,
      o_orderdate::DATE AS asked, ((o_orderkey * 7) % 2900)::DOUBLE AS x, ((o_orderkey * 13) % 2900)::DOUBLE AS y FROM orders),
    areas AS (SELECT 'area-' || lpad(n_nationkey::VARCHAR, 2, '0') AS area, (CASE WHEN n_nationkey % 2 = 0 THEN 'N' ELSE 'A' END) || lpad(n_nationkey::VARCHAR, 2, '0') AS code, n_regionkey AS parent,
      (n_nationkey % 5) * 500 + 3 AS x0, (n_nationkey // 5) * 500 + 7 AS y0 FROM nation)"""
