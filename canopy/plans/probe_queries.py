"""Probe analytics: rates, quantiles, roll-ups, cross-tabs, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopy.functions import dates, text
from canopy.operators import dedup, mentions
from canopy.plans.bindings import table


def gate_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of several tables that carry each reference system; the union must have one."""
    out = None
    for name, srid in (("nation", 28992), ("region", 28992), ("supplier", 28992), ("part", 4326)):
        part = table(spark, sf, name).select(F.lit(name).alias("source"), F.lit(srid).alias("srid"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("srid").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"))


def filtered_counts(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("open"), F.count_if(F.col("o_totalprice") > 250000).alias("large"), F.count_distinct("o_custkey").alias("customers"))


def rollup_shares(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").rollup("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("negative"), F.grouping_id().alias("level"))
    return c.select(F.when(F.col("level") >= 2, "ALL").otherwise(F.col("c_mktsegment")).alias("segment"), F.when(F.col("level") >= 1, "ALL").otherwise(F.col("c_nationkey").cast("string")).alias("nation"), "n", "negative", F.round(100.0 * F.col("negative") / F.nullif(F.col("n"), F.lit(0)), 2).alias("share"))


def rollup_ordered(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "orders").rollup("o_orderstatus").agg(F.count("*").alias("n"))
    return c.orderBy(F.col("o_orderstatus").asc_nulls_first())


def quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.percentile("l_quantity", 0.5).alias("median"), F.round(F.avg("l_quantity"), 6).alias("mean"), F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"), F.percentile("l_quantity", 0.9).alias("p90"),
    )


def agg_strings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_set("n_name")), ",").alias("names"), F.count_distinct("n_name").alias("n"))


def value_frequency(spark: SparkSession, sf: str) -> DataFrame:
    """The ten most common values: a report, so the limit is the feature."""
    return table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "p_brand").limit(10)


def populate_rates(spark: SparkSession, sf: str) -> DataFrame:
    """By column, how many rows have a value: one aggregate, then unpivoted."""
    d = table(spark, sf, "documents")
    cols = d.columns
    filled = lambda c: F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(c)
    return d.agg(*map(filled, cols)).unpivot([], cols, "name", "filled")


def quarter_volume(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.groupBy(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")).agg(F.count("*").alias("n"))


def year_volume(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"), F.count_if(F.col("o_custkey") % 10 == 0).alias("district"), F.count_if(F.col("o_orderstatus") == "F").alias("decisions"))


def date_offsets(spark: SparkSession, sf: str) -> DataFrame:
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lag = dates.lag_days(F.col("l_shipdate"), F.col("o_orderdate"))
    return j.withColumn("lag", lag).groupBy("o_orderpriority").agg(F.min("lag").alias("least"), F.percentile("lag", 0.5).alias("median"), F.max("lag").alias("most"), F.round(F.avg(F.when(F.col("lag") < 0, 1.0).otherwise(0.0)), 6).alias("negative"))


def date_concentration(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date")).groupBy("o_orderstatus", "day").agg(F.count("*").alias("n"))
    top = dedup.first_by(o, ["o_orderstatus"], [F.col("n").desc(), F.col("day")]).select("o_orderstatus", F.col("day").alias("top_day"), F.col("n").alias("top_n"))
    return o.groupBy("o_orderstatus").agg(F.count("*").alias("days")).join(top, "o_orderstatus")


def share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"))
    return n.select("l_returnflag", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4).alias("share"))


def distinct_on(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return dedup.first_by(o, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")])


def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of each stratum in a stated order: a sampling operator, so the cap is the feature."""
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_discount") > F.col("l_tax"), "disagree").when(F.col("l_quantity") > 40, "residual").otherwise("easy").alias("stratum"))
    w = Window.partitionBy("stratum").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    cap = F.when(F.col("stratum") == "easy", 100).otherwise(120)  # the constant bound below lets each task keep its own first rows only
    return d.withColumn("rn", F.row_number().over(w)).filter("rn <= 120").filter(F.col("rn") <= cap).groupBy("stratum").agg(F.count("*").alias("n"), F.max("l_orderkey").alias("last_order"))


def gold_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Exact matches of two readings, null equal to null, and where they disagree."""
    e = table(spark, sf, "events").withColumn("a", F.get_json_object("props", "$.k").cast("int")).withColumn("b", F.when(F.col("event_id") % 7 != 0, F.col("a"))).withColumn("a", F.when(F.col("event_id") % 14 != 0, F.col("a")))
    same = F.col("a").eqNullSafe(F.col("b"))
    return e.groupBy("event_type").agg(F.round(F.avg(same.cast("double")), 6).alias("accuracy"), F.count_if(~same).alias("disagree"), F.count_if(F.col("a").isNull() & F.col("b").isNull()).alias("both_null"))


def ordered_union(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("at"))
    return dedup.ordered_union([o.filter("at % 3 = 0"), o.filter("at % 3 = 1"), o], "id", "at")


def last_wins(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.groupBy("user_id").agg(F.max_by(F.struct("event_type", "value"), F.struct("ts", "event_id")).alias("r"), F.count("*").alias("n")).select("user_id", "r.event_type", "r.value", "n")


def semi_anti_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("k")).distinct().withColumn("hit", F.lit(True))
    return c.join(o, F.col("c_custkey") == F.col("k"), "left").groupBy("c_mktsegment").agg(F.count_if("hit").alias("with_large"), F.count_if(F.col("hit").isNull()).alias("without"))


def title_kinds(spark: SparkSession, sf: str) -> DataFrame:
    t = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("  Besluit ", "ONTWERPBESLUIT ", "aanvraag ", "Verlenging ", "Ingetrokken ", "Mededeling besluit ")]), (F.col("p_partkey") % 6 + 1).cast("int")), "p_name")
    return table(spark, sf, "part").select("p_partkey", text.title_kind(t).alias("kind"), text.doctype(t).alias("doctype"), text.slug(t).alias("slug"))


def title_addresses(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    t = F.concat(F.lit("Besluit kap "), F.when(k % 4 == 0, F.lit("Dam-weg ")).when(k % 4 == 1, F.lit("Örehof ")).otherwise(F.lit("9x ")), F.when(k % 5 == 0, F.lit("8-H")).otherwise((k % 200).cast("string")), F.lit(" "), F.when(k % 7 == 0, F.lit("geen")).otherwise(F.concat((k % 9000 + 1000).cast("string"), F.when(k % 2 == 0, F.lit(" ")).otherwise(F.lit("")), F.lit("AB"))), F.lit(" Stad"))
    a = text.title_address(t)
    return table(spark, sf, "customer").select("c_custkey", a["postcode"].alias("postcode"), a["huisnummer"].alias("huisnummer"), a["street"].alias("street"))


def naive_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = F.concat(F.lit("kappen van "), (F.col("p_size") % 40).cast("string"), F.element_at(F.array(*[F.lit(x) for x in (" bomen", " Boom en 7 bomen", " houtopstanden", "bom")]), (F.col("p_partkey") % 4 + 1).cast("int")))
    return table(spark, sf, "part").select("p_partkey", text.naive_count(t).alias("n"))


_FORMS = [("of the", "c1"), ("The", "c2"), ("and", "c3"), ("que", "c4"), ("in the", "c1")]


def phrase_matches(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return mentions.phrase_matches(d, spark.createDataFrame(_FORMS, "form string, concept string"), 2).groupBy("id", "concept").agg(F.count("*").alias("n"), F.min("pos").cast("int").alias("first"))


def merged_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of one event type of a user less than a day apart."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    far = lambda w: (F.col("ts").cast("timestamp").cast("long") - F.lag(F.col("ts").cast("timestamp").cast("long")).over(w)) >= 86400
    runs = mentions.merge_adjacent(e, "user_id", ["ts", "event_id"], "event_type", far)
    return runs.groupBy("user_id", "run").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.max("event_type").alias("event_type"))


def bound_activities(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    verb = F.col("event_type") == "click"
    m = e.select("user_id", "ts", "event_id", F.when(verb, F.concat(F.lit("a"), F.col("event_id") % 5)).alias("activity"), F.when(~verb, F.col("event_type")).alias("noun"), F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 9).cast("int")).alias("number"), (F.col("event_id") % 2 == 0).alias("singular"))
    return mentions.bind_left(m, "user_id", ["ts", "event_id"]).groupBy("activity", "noun").agg(F.count("*").alias("n"), F.sum("number").alias("total"))


def clause_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """How many texts state how many different activities."""
    t = F.concat(F.lit("kappen van "), (F.col("p_size") % 5).cast("string"), F.lit(" bomen"), F.when(F.col("p_partkey") % 2 == 0, " en herplanten van twee bomen").otherwise(""), F.when(F.col("p_partkey") % 3 == 0, ", rooien van 1 boom").otherwise(""), F.when(F.col("p_partkey") % 7 == 0, ", diverse bomen").otherwise(""))
    acts = table(spark, sf, "part").select(text.activities(t).alias("acts"))
    verbs = F.size(F.array_distinct(F.transform("acts", lambda a: a["verb"])))
    return acts.groupBy(verbs.alias("verbs")).agg(F.count("*").alias("n"), F.sum(text.felling_total(F.col("acts"))).alias("felling"), F.count_if(text.conflated(F.col("acts"))).alias("conflated"), F.sum(F.size(F.filter("acts", lambda a: a["bucket"] == "countless"))).alias("countless"))


def json_props(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("total"), F.max("k").alias("most"))


def html_text(spark: SparkSession, sf: str) -> DataFrame:
    """Pages' titles and their context of a keyword."""
    p = table(spark, sf, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return p.select("page_id", title.alias("title"), F.sha2(text.strip_xml(F.regexp_extract("html", "<h1>(.*?)</h1>", 1)), 256).alias("heading"), text.keyword_context(title, "the", 5).alias("context"))


def string_tools(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_name")
    return table(spark, sf, "part").select(
        "p_partkey", text.escape_literal(F.concat(F.lit('"'), n, F.lit("\\\t"))).alias("escaped"), text.strip_prefix(F.concat(F.lit("id/"), n), "id/").alias("bare"),
        text.redact(F.concat(F.lit("host=x password="), F.col("p_brand"), F.lit(" user=y"))).alias("redacted"), F.sha2(n, 256).alias("sha"), text.build_url(F.lit("https://example.org/q"), {"b": n, "a": F.col("p_partkey").cast("string")}).alias("url"),
    )


def window_ends(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(d.alias("day")).distinct().select("day", dates.plus_years(F.col("day"), 3).alias("day_end"), dates.since(F.date_add("day", 9000)).alias("next_since"))


def backoff(spark: SparkSession, sf: str) -> DataFrame:
    return spark.range(1, 9).select(F.col("id").alias("attempt"), dates.backoff_seconds(F.col("id")).alias("seconds"))


def incremental_harvest(spark: SparkSession, sf: str) -> DataFrame:
    """A second harvest with overlap: what is new by id and content, and the next mark."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("ts").cast("date").alias("day"), F.concat_ws("|", "event_type", F.col("value").cast("decimal(12,2)").cast("string")).alias("content"))
    mark = e.filter("id % 10 < 6").agg(F.date_sub(F.max("day"), dates.OVERLAP_DAYS).alias("since")).scalar()
    known = e.filter("id % 10 < 6").withColumn("content_sha256", F.sha2(F.when(F.col("id") % 20 == 1, F.concat("content", F.lit("!"))).otherwise(F.col("content")), 256))
    arrived = e.filter(F.col("day") >= mark)
    fresh = dedup.unseen_content(arrived, known)
    return fresh.agg(F.count("*").alias("fresh"), F.max("day").alias("next_mark"), F.count_if(F.col("id") % 20 == 1).alias("changed"))


def latest_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The latest version of each artifact, by name order, and how often the content changed."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("artifact"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("version"), F.sha2(F.coalesce("props", F.lit("")), 256).alias("sha"), "event_id")
    return dedup.landed_versions(e, "artifact", "version", "sha", "event_id", F.substring("version", 1, 8))


QUERIES = {f.__name__: f for f in (
    gate_counts, filtered_counts, rollup_shares, rollup_ordered, quantiles, agg_strings, value_frequency, populate_rates, quarter_volume, year_volume, date_offsets, date_concentration, share_of_total, distinct_on, stratified_sample,
    gold_accuracy, ordered_union, last_wins, semi_anti_counts, title_kinds, title_addresses, naive_counts, json_props, html_text, phrase_matches, merged_mentions, bound_activities, clause_histogram, string_tools, window_ends, backoff, incremental_harvest, latest_versions)}

_TITLE = "(['  Besluit ', 'ONTWERPBESLUIT ', 'aanvraag ', 'Verlenging ', 'Ingetrokken ', 'Mededeling besluit '][(p_partkey % 6 + 1)::INT] || p_name)"
ORACLE = {
    "phrase_matches": """WITH d AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents), s AS (SELECT id, i, w[i] AS a, w[i] || ' ' || w[i + 1] AS b FROM (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
        m AS (SELECT id, i, CASE a WHEN 'the' THEN 'c2' WHEN 'and' THEN 'c3' WHEN 'que' THEN 'c4' END AS concept FROM s UNION ALL SELECT id, i, CASE WHEN b IN ('of the', 'in the') THEN 'c1' END FROM s) SELECT id, concept, count(*) AS n, (min(i) - 1)::INT AS first FROM m WHERE concept IS NOT NULL GROUP BY 1, 2""",
    "merged_mentions": """WITH e AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND epoch(date_trunc('second', ts)) - epoch(date_trunc('second', lag(ts) OVER w)) < 86400 THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        r AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM e) SELECT user_id, run::BIGINT AS run, count(*) AS n, min(event_id) AS first, max(event_type) AS event_type FROM r GROUP BY 1, 2""",
    "bound_activities": """WITH m AS (SELECT *, last_value(CASE WHEN event_type = 'click' THEN 'a' || (event_id % 5) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS activity FROM events)
        SELECT activity, event_type AS noun, count(*) AS n, sum(coalesce(CASE WHEN event_id % 3 = 0 THEN event_id % 9 END, CASE WHEN event_id % 2 = 0 THEN 1 END))::BIGINT AS total FROM m WHERE event_type <> 'click' GROUP BY 1, 2""",
    "clause_histogram": """WITH p AS (SELECT p_size % 5 AS k, p_partkey % 2 = 0 AS h, p_partkey % 3 = 0 AS r, p_partkey % 7 = 0 AS c FROM part) SELECT (1 + h::INT + r::INT)::INT AS verbs, count(*) AS n, sum(k + CASE WHEN r THEN 1 ELSE 0 END)::BIGINT AS felling, count(*) FILTER (h) AS conflated, sum(c::INT)::BIGINT AS countless FROM p GROUP BY 1""",
    "gate_counts": "SELECT srid::INT AS srid, count(*) AS n, count(DISTINCT source) AS sources FROM (SELECT 'nation' AS source, 28992 AS srid FROM nation UNION ALL SELECT 'region', 28992 FROM region UNION ALL SELECT 'supplier', 28992 FROM supplier UNION ALL SELECT 'part', 4326 FROM part) GROUP BY srid",
    "filtered_counts": "SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS open, count(*) FILTER (o_totalprice > 250000) AS large, count(DISTINCT o_custkey) AS customers FROM orders",
    "rollup_shares": "SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'ALL' ELSE c_mktsegment END AS segment, CASE WHEN grouping(c_nationkey) = 1 THEN 'ALL' ELSE c_nationkey::VARCHAR END AS nation, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS negative, round(100.0::DOUBLE * count(*) FILTER (c_acctbal < 0) / nullif(count(*), 0), 2) AS share FROM customer GROUP BY ROLLUP (c_mktsegment, c_nationkey)",
    "rollup_ordered": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus) ORDER BY o_orderstatus NULLS FIRST",
    "quantiles": "SELECT l_returnflag, percentile_cont(0.5) WITHIN GROUP (ORDER BY l_quantity) AS median, round(avg(l_quantity), 6) AS mean, min(l_quantity) AS least, max(l_quantity) AS most, percentile_cont(0.9) WITHIN GROUP (ORDER BY l_quantity) AS p90 FROM lineitem GROUP BY 1",
    "agg_strings": "SELECT n_regionkey, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS names, count(DISTINCT n_name) AS n FROM nation GROUP BY 1",
    "value_frequency": "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10",
    "populate_rates": "SELECT name, filled FROM (UNPIVOT (SELECT count(*) FILTER (doc_id IS NOT NULL) AS doc_id, count(*) FILTER (text <> '') AS text, count(*) FILTER (lang <> '') AS lang, count(*) FILTER (source <> '') AS source, count(*) FILTER (n_chars IS NOT NULL) AS n_chars FROM documents) ON COLUMNS(*) INTO NAME name VALUE filled)",
    "quarter_volume": "SELECT year(o_orderdate)::INT AS year, quarter(o_orderdate)::INT AS quarter, count(*) AS n FROM orders GROUP BY 1, 2",
    "year_volume": "SELECT year(o_orderdate)::INT AS year, count(*) AS n, count(*) FILTER (o_custkey % 10 = 0) AS district, count(*) FILTER (o_orderstatus = 'F') AS decisions FROM orders GROUP BY 1",
    "date_offsets": "WITH j AS (SELECT o_orderpriority, date_diff('day', o_orderdate::DATE, l_shipdate::DATE)::INT AS lag FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT o_orderpriority, min(lag) AS least, percentile_cont(0.5) WITHIN GROUP (ORDER BY lag) AS median, max(lag) AS most, round(avg(CASE WHEN lag < 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS negative FROM j GROUP BY 1",
    "date_concentration": "WITH d AS (SELECT o_orderstatus, o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1, 2) SELECT o_orderstatus, count(*) AS days, (list({'d': day, 'n': n} ORDER BY n DESC, day))[1].d AS top_day, (list({'d': day, 'n': n} ORDER BY n DESC, day))[1].n AS top_n FROM d GROUP BY 1",
    "share_of_total": "SELECT l_returnflag, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS share FROM lineitem GROUP BY 1",
    "distinct_on": "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_custkey, o_orderdate DESC NULLS LAST, o_orderkey",
    "stratified_sample": "WITH s AS (SELECT l_orderkey, CASE WHEN l_discount > l_tax THEN 'disagree' WHEN l_quantity > 40 THEN 'residual' ELSE 'easy' END AS stratum, l_linenumber, l_partkey, l_suppkey FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM s) SELECT stratum, count(*) AS n, max(l_orderkey) AS last_order FROM r WHERE rn <= CASE stratum WHEN 'easy' THEN 100 ELSE 120 END GROUP BY 1",
    "gold_accuracy": "WITH e AS (SELECT event_type, CASE WHEN event_id % 14 <> 0 THEN k END AS a, CASE WHEN event_id % 7 <> 0 THEN k END AS b FROM (SELECT *, (props::JSON->>'$.k')::INT AS k FROM events)) SELECT event_type, round(avg(CASE WHEN a IS NOT DISTINCT FROM b THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy, count(*) FILTER (a IS DISTINCT FROM b) AS disagree, count(*) FILTER (a IS NULL AND b IS NULL) AS both_null FROM e GROUP BY 1",
    "ordered_union": "WITH o AS (SELECT o_custkey AS id, o_orderkey AS at, CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS bucket FROM orders) SELECT DISTINCT ON (id) id, bucket::INT AS bucket, \"at\" FROM o ORDER BY id, bucket, \"at\"",
    "last_wins": "SELECT user_id, event_type, value, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE rn = 1",
    "semi_anti_counts": "SELECT c_mktsegment, count(*) FILTER (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)) AS with_large, count(*) FILTER (NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)) AS without FROM customer GROUP BY 1",
    "title_kinds": f"SELECT p_partkey, CASE WHEN t LIKE 'ontwerpbesluit%' THEN 'ontwerpbesluit' WHEN t LIKE 'besluit%' THEN 'besluit' WHEN t LIKE 'aanvraag%' THEN 'aanvraag' WHEN t LIKE 'verlenging%' THEN 'verlenging' WHEN t LIKE 'ingetrokken%' THEN 'ingetrokken' ELSE 'other' END AS kind, CASE WHEN t LIKE '%ingetrokken%' THEN 'ingetrokken' WHEN t LIKE '%verlengd%' THEN 'verlengd' WHEN t LIKE '%kennisgeving%' THEN 'kennisgeving' WHEN t LIKE '%besluit%' THEN 'besluit' WHEN t LIKE '%aanvraag%' THEN 'aanvraag' ELSE 'other' END AS doctype, regexp_replace(regexp_replace(t, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM (SELECT p_partkey, lower(trim({_TITLE})) AS t FROM part)",
    "title_addresses": """SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 9000 + 1000) || 'AB' END AS postcode, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 THEN (c_custkey % 200)::INT END AS huisnummer,
        CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 THEN CASE c_custkey % 4 WHEN 0 THEN 'Dam-weg' WHEN 1 THEN 'Örehof' END END AS street FROM customer""",
    "naive_counts": "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN (p_size % 40)::BIGINT WHEN 1 THEN greatest(p_size % 40, 7)::BIGINT WHEN 3 THEN (p_size % 40)::BIGINT END AS n FROM part",
    "json_props": "SELECT event_type, count(k) AS n, sum(k)::BIGINT AS total, max(k) AS most FROM (SELECT event_type, (props::JSON->>'$.k')::INT AS k FROM events) GROUP BY 1",
    "html_text": "WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<h1>(.*?)</h1>', 1) AS h FROM pages) SELECT page_id, title, sha256(trim(regexp_replace(regexp_replace(h, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) AS heading, CASE WHEN instr(lower(title), 'the') > 0 THEN substr(title, greatest(instr(lower(title), 'the') - 5, 1), least(instr(lower(title), 'the') - 1, 5) + 8) END AS context FROM t",
    "string_tools": """SELECT p_partkey, '\\"' || p_name || '\\\\\\t' AS escaped, p_name AS bare, 'host=x password=*** user=y' AS redacted, sha256(p_name) AS sha, 'https://example.org/q?a=' || p_partkey || '&b=' || replace(url_encode(p_name), '%20', '+') AS url FROM part""",
    "window_ends": "SELECT DISTINCT d AS day, CASE WHEN month(d) = 2 AND day(d) = 29 THEN make_date(year(d) + 3, 3, 1) ELSE (d + INTERVAL 3 YEAR)::DATE END AS day_end, greatest(d + 9000 - 7, DATE '2021-01-01') AS next_since FROM (SELECT o_orderdate::DATE AS d FROM orders)",
    "backoff": "SELECT i AS attempt, least(pow(2.0, i - 1), 30.0)::DOUBLE AS seconds FROM range(1, 9) t(i)",
    "incremental_harvest": """WITH e AS (SELECT event_id AS id, ts::DATE AS day, event_type || '|' || value::DECIMAL(12,2) AS content FROM events), m AS (SELECT max(day) - 7 AS since FROM e WHERE id % 10 < 6),
        f AS (SELECT e.* FROM e, m WHERE day >= since AND NOT (id % 10 < 6 AND id % 20 <> 1)) SELECT count(*) AS fresh, max(day) AS next_mark, count(*) FILTER (id % 20 = 1) AS changed FROM f""",
    "latest_versions": """WITH e AS (SELECT event_type AS artifact, strftime(ts, '%Y%m%dT%H%M%SZ') AS version, sha256(coalesce(props, '')) AS sha, event_id FROM events), l AS (SELECT *, lag(sha) OVER (PARTITION BY artifact ORDER BY version, event_id) AS prior FROM e),
        k AS (SELECT * FROM l WHERE prior IS NULL OR prior <> sha) SELECT artifact, count(*) AS landed, max(version) AS latest, (list(sha ORDER BY version DESC, event_id DESC))[1] AS sha FROM k GROUP BY 1""",
}
