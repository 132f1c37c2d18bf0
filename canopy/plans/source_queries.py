"""Landed text, harvests, staging, snapshots and parsers over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions import dates, spatial, text
from canopy.operators import graph as g
from canopy.operators import resolve
from canopy.plans import bindings as b
from canopy.plans import graph_queries
from canopy.plans.relations import plain, relation
from canopy.sources import landing, pagers, pages, snapshots
from canopy.sources.files import Files, own_dir
from canopy.streaming.harvest import Cursor

# Parsers -----------------------------------------------------------------

_XML = r"""SELECT p_partkey AS id, CASE p_partkey % 7
    WHEN 0 THEN '<?xml version="1.0" encoding="UTF-8"?><r><t:title> </t:title><t:title> ' || p_name || ' </t:title></r>'
    WHEN 1 THEN '<r><meta><title>' || p_name || '</title></meta><geo>POINT(' || p_size || ' ' || p_partkey || '.5)</geo></r>'
    WHEN 2 THEN '<r><title>' || p_name || '</r>'
    WHEN 3 THEN '<m><metadata name="a" content="b"/><metadata name="OVERHEIDop.referentienummer" content="Z' || p_partkey || '"/></m>'
    WHEN 4 THEN '<s:r><s:numberOfRecords>' || p_size || '</s:numberOfRecords></s:r>'
    WHEN 5 THEN 'no & xml <' END AS xml FROM {part}"""


def xml_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Texts, attributes, totals and points out of records, some with a declaration, some malformed, some absent."""
    x = F.col("xml")
    point = spatial.point_from_wkt(text.xml_text(x, "geo"))
    return relation(spark, sf, _XML).select("id", text.xml_text(x, "title").alias("title"), text.xml_attribute(x).alias("reference"), text.sru_total(x).alias("total"), point["x"].alias("x"), point["y"].alias("y"), text.well_formed(x).alias("well_formed"))


_TITLES = """SELECT p_partkey AS id, CASE p_partkey % 5
    WHEN 0 THEN 'Omgevingsvergunning kap nabij  Laan' || p_size || ' ' || p_partkey || '-2 1012 lg Stad' WHEN 1 THEN 'Aanvraag (kap) Lange Straat ' || p_size || ' 1012AB'
    WHEN 2 THEN 'kap t.h.v. Kade ' || p_size || 'H' WHEN 3 THEN 'zonder nummer' END AS title FROM {part}"""


def title_places(spark: SparkSession, sf: str) -> DataFrame:
    p = text.title_place(F.col("title"))
    return relation(spark, sf, _TITLES).select("id", *[p[c].alias(c) for c in ("marker", "street", "huisnummer", "suffix", "postcode")])


def dutch_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Number words up to a hundred, of part sizes, read back."""
    n = F.col("p_size") % 100
    word = lambda table, value: F.element_at(F.create_map(*[F.lit(x) for k, v in table.items() for x in (v, k)]), value)
    small = word({k: v for k, v in text.UNITS.items() if k != "één"} | text.TEENS, n)
    round_ = word(text.TENS, n - n % 10)
    spelled = F.when(n < 20, small).when(n % 10 == 0, round_).otherwise(F.concat(word({k: v for k, v in text.UNITS.items() if k != "één"}, n % 10), F.when((n % 10).isin(2, 3), "ën").otherwise("en"), round_))
    return b.table(spark, sf, "part").select("p_partkey", text.dutch_number(F.coalesce(spelled, F.lit("nul"))).alias("n"), text.dutch_number(F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit("),"))).alias("digits"))


_NAMES = """SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'Ulmus x hollandica en ELS, els; boomnr. ' || p_partkey WHEN 1 THEN 'project Noord Oever, boom nummer 7 en boomnummer ' || p_size
    WHEN 2 THEN 'iep en Acer ''Goldrush''' END AS t FROM {part}"""


def name_mentions(spark: SparkSession, sf: str) -> DataFrame:
    m = text.mentions(F.col("t"), ["els", "iep"], ["Ulmus", "Acer"])
    joined = lambda c: F.array_join(m[c], ",").alias(c)
    return relation(spark, sf, _NAMES).select("id", joined("dutch"), joined("latin"), m["cultivar"].alias("cultivar"), m["project"].alias("project"), joined("numbers"))


_DATES = "SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10) WHEN 1 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || 'T07:08:09Z' WHEN 2 THEN 'soon' END AS t FROM {orders}"


def lenient_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of two forms; what is no date is null, and counts as the floor."""
    d = dates.lenient_date(F.col("t"))
    return relation(spark, sf, _DATES).select("id", d.alias("day"), dates.since(d).alias("since"))


_SPECIES = """SELECT CASE p_partkey % 3 WHEN 0 THEN 'Boom' || (p_size % 7) || ' (Genus' || chr(97 + p_size % 9) || ' sp' || p_partkey || ')' WHEN 1 THEN 'Genus' || chr(97 + p_size % 9) || ' sp' || p_partkey ELSE 'onbekend' END AS name FROM {part}"""


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Genera with their labels, how many names they gather, and the Latin name beside a Dutch one."""
    v = snapshots.vocabulary(relation(spark, sf, _SPECIES), "scheme/trees")
    return v.select("concept", "label", F.size("notations").alias("names"), "alt")


# Landed text ---------------------------------------------------------------


def landed_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as landed JSON: two values a line, the second over several lines; read back as rows."""
    at = own_dir(spark, "landed")
    value = F.format_string('{"_embedded": {"k": [{"id": 1%d234567890123, "soort": "a\\"}{"}]}} {"features": [\n {"properties":\n  {"id": %d, "soort": null},\n "geometry": {"type": "Point", "coordinates": [%d, 2.5]}}]}\n', "p_partkey", "p_partkey", "p_size")
    b.spread(b.table(spark, sf, "part").select("p_partkey", "p_size")).select(value.alias("value")).write.text(at)
    rows = landing.read_envelopes(spark, at, "k", {"id": "string", "soort": "string"})
    point = spatial.point_from_geojson(F.col("geometry"))
    return rows.select("id", "soort", point["x"].alias("x"), point["y"].alias("y"))


def landed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as landed XML records, some with sidecars, some malformed or strangely named: what is read and what is skipped."""
    at, files = own_dir(spark, "records"), Files(spark)
    for r in b.table(spark, sf, "nation").collect():  # the 25 nations
        k, name = r["n_nationkey"], r["n_name"]
        file = f"note-{k}" if k % 7 == 3 else f"gmb-2022-{k}"
        files.write(f"{at}/{file}.xml", (f"<r><title>{name}</title>" + ("" if k % 5 == 1 else "</r>")).encode())
        if k % 2 == 0:
            files.write(f"{at}/{file}.metadata.xml", f'<m><metadata name="{text.REFERENCE_KEY}" content="Z{k}"/></m>'.encode())
    good, skipped = landing.read_records(spark, at)
    read = good.select("id", text.xml_text(F.col("record"), "title").alias("title"), F.nullif(text.xml_attribute(F.col("metadata")), F.lit("")).alias("reference"), F.lit(None).cast("string").alias("why"))
    return read.unionByName(skipped.select("id", F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("reference"), "why"))


def landed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """What the provenance log says after each region landed, landed unchanged, and landed anew."""
    from datetime import UTC, datetime, timedelta

    now = iter(datetime(2024, 1, 1, tzinfo=UTC) + timedelta(seconds=k) for k in range(1 << 20))
    store, out = landing.Landing(own_dir(spark, "landing"), lambda: next(now), spark), None
    for r in sorted(b.table(spark, sf, "region").collect()):  # the 5 regions
        for content in (r["r_name"], r["r_name"], r["r_name"].lower(), r["r_name"]):
            store.land_version(r["r_name"], f"https://example.org/{r['r_regionkey']}", content.encode())
        log = store.provenance(spark, r["r_name"]).select(F.lit(r["r_name"]).alias("name"), "source_url", "byte_size", "content_sha256")
        out = log if out is None else out.unionByName(log)
    return out.groupBy("name", "source_url", "byte_size", "content_sha256").agg(F.count("*").alias("n"))


def registry_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as registry XML of two municipalities; those of one are read."""
    at = own_dir(spark, "registry")
    own = F.concat(F.when(F.col("c_custkey") % 3 == 0, "NL.0999.").otherwise("NL.0363."), F.col("c_custkey").cast("string"))
    b.table(spark, sf, "customer").select(own.alias("identificatie"), (F.col("c_custkey") % 97 + 1).cast("int").alias("huisnummer")).write.format("xml").option("rowTag", "Nummer").option("rootTag", "bag").save(at)
    return landing.read_bag(spark, at, "Nummer", "identificatie string, huisnummer int", "0363")


def area_features(spark: SparkSession, sf: str) -> DataFrame:
    """Areas as one feature collection, without those that ended or have no shape, read back as polygons."""
    at = own_dir(spark, "features")
    nk = F.col("n_nationkey")
    shape = F.format_string('{"type":"Polygon","coordinates":[[[%d,0],[%d,0],[%d,9],[%d,0]]]}', nk, nk + 4, nk, nk)
    rows = b.table(spark, sf, "nation").select(F.col("n_name").alias("naam"), F.when(nk % 4 == 1, "2020-01-01").alias("eindGeldigheid"), F.when(nk % 6 != 2, shape).alias("geometry"))
    landing.feature_collection(rows, ["naam"]).write.text(at)
    p = landing.read_polygons(spark, at, {"naam": "string"})
    return p.select("naam", "srid", F.size(F.get("polygon", F.lit(0))).alias("points"), F.get(F.get("polygon", F.lit(0)), F.lit(1))["x"].alias("x"))


# Harvests --------------------------------------------------------------------


def harvests(spark: SparkSession, sf: str) -> DataFrame:
    """A search, linked pages and numbered pages as DataFrames, each as long as the nation table."""
    import json

    total = b.table(spark, sf, "nation").count()

    def get(url: str) -> bytes:
        from urllib.parse import parse_qs, urlparse

        q = {k: int(v[0]) for k, v in parse_qs(urlparse(url).query).items() if v[0].isdigit()}
        if "startRecord" in q:  # a server that gives at most three records a page
            rows = range(q["startRecord"], min(q["startRecord"] + min(q["maximumRecords"], 3), total + 1))
            return f'<r xmlns="u"><numberOfRecords>{total}</numberOfRecords>{"".join(f"<recordData><id>{k}</id></recordData>" for k in rows)}</r>'.encode()
        if "at" in q:
            return json.dumps({"n": q["at"], "_links": {"next": {"href": f"x?at={q['at'] + 1}"}} if q["at"] < total else {}}).encode()
        return json.dumps({"_embedded": {"k": [{"n": k} for k in range((q["page"] - 1) * 4, min(q["page"] * 4, total))]}}).encode()

    search = pages.sru(spark, get, "https://example.org/sru", "q", page=4, span=10, pace=0.0).select(F.lit("sru").alias("kind"), F.regexp_extract("value", r">(\d+)<", 1).cast("int").alias("n"))
    linked = pages.hal(spark, get, "x?at=1").select(F.lit("hal").alias("kind"), F.get_json_object("value", "$.n").cast("int").alias("n"))
    listed = pages.numbered(spark, get, "x", "k", 4).select(F.lit("numbered").alias("kind"), F.explode(F.from_json("value", "array<struct<n:int>>")).alias("r")).select("kind", "r.n")
    return search.unionByName(linked).unionByName(listed)


def request_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of a search from a date on and of a layer, and the sources a run names."""
    query = pagers.lower_bound_query("keyword=kap", "2024-01-01")
    rows = [("sru", pagers.sru_url("https://example.org/sru", query, 101, 100)), ("wfs", pagers.wfs_url("https://example.org/wfs", "buurten", "gemeente", "GM0363"))]
    rows += [(f"source {k}", n) for k, n in enumerate(pagers.select_sources(["a", "b", "c"], []))] + [(f"named {k}", n) for k, n in enumerate(pagers.select_sources(["a", "b", "c"], ["c", "a"]))]
    return spark.createDataFrame(rows, "name string, value string")


def harvest_marks(spark: SparkSession, sf: str) -> DataFrame:
    """The cursor before, between and after two harvests, the second one of older and of broken dates."""
    cursor, rows = Cursor(f"{own_dir(spark, 'cursor')}/mark.json"), []
    o = b.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    late = o.select(F.date_format(F.add_months("d", 360), "yyyy-MM-dd").alias("available"))
    rows.append((0, cursor.read(), cursor.since(spark)))
    cursor.advance(late)
    rows.append((1, cursor.read(), cursor.since(spark)))
    cursor.advance(o.select(F.date_format("d", "yyyy-MM-dd").alias("available")).unionByName(late.limit(1).select(F.lit("9999-99-99").alias("available"))))
    rows.append((2, cursor.read(), cursor.since(spark)))
    return spark.createDataFrame(rows, "step int, mark string, since string")


# Staging, snapshots and stores -------------------------------------------------

_STAGED = "SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10) WHEN 1 THEN '' ELSE 'bad' END AS day, CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS customer FROM {orders}"


def staged_rows(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows are staged, and why the others aren't."""
    at = own_dir(spark, "staged")
    bad = landing.stage_rows(relation(spark, sf, _STAGED), {"day": F.try_to_date("day", "yyyy-MM-dd"), "customer": F.col("customer").try_cast("long")}, at)
    good = spark.read.parquet(at).agg(F.lit("").alias("why"), F.count("*").alias("n"), F.max("day").alias("last"))
    return good.unionByName(bad.groupBy("why").agg(F.count("*").alias("n"), F.lit(None).cast("date").alias("last")))


def truncated_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Each load takes the place of the one before."""
    at, nation = own_dir(spark, "loads"), b.table(spark, sf, "nation")
    landing.truncate_and_load(nation, at)
    landing.truncate_and_load(nation.filter("n_regionkey = 1"), at)
    return spark.read.parquet(at).select("n_nationkey", "n_name")


def snapshot_restore(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the tables that a snapshot brings back; the skipped one stays out."""
    at, to = own_dir(spark, "snapshot"), own_dir(spark, "restored")
    snapshots.export({n: b.table(spark, sf, n) for n in ("nation", "region", "supplier")}, at, skip=("supplier",))
    names, out = snapshots.restore(spark, at, to), None
    for n in names:
        part = spark.read.parquet(f"{to}/{n}").select(F.lit(n).alias("table"), F.col(f"{n[0]}_name").alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


def graph_dump(spark: SparkSession, sf: str) -> DataFrame:
    """The live facts as N-Quads and back, the dump's graphs in the place of older ones."""
    at = own_dir(spark, "dump")
    live = graph_queries._live(spark, sf)[0].select("graph", "s", "p", "o")
    snapshots.write_graph(live, at)
    older = live.filter("graph = 'run:load-2'").limit(1).withColumn("o", F.lit("old")).unionByName(spark.createDataFrame([("other", "a", "b", "c")], live.schema))
    return snapshots.restore_graph(older, snapshots.parse_nquads(spark.read.text(at)))


def turtle_blocks(spark: SparkSession, sf: str) -> DataFrame:
    live = graph_queries._live(spark, sf)[0].filter(F.col("s").startswith(g.DATA + "place/"))
    return snapshots.turtle(live)


def committed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two commits of two tables, then a reset of one."""
    root = own_dir(spark, "committed")
    nation, region = b.table(spark, sf, "nation"), b.table(spark, sf, "region")
    snapshots.commit_tables(spark, {"a": nation.limit(1), "b": region}, root)
    snapshots.commit_tables(spark, {"a": nation.filter("n_regionkey <> 2")}, root)
    snapshots.reset_tables(spark, ["b"], root)
    gone = not Files(spark).exists(f"{root}/b")
    return spark.read.parquet(f"{root}/a").select("n_nationkey", F.lit(gone).alias("b_gone"))


def gates(spark: SparkSession, sf: str) -> DataFrame:
    """Which checks let a batch through: reference tables, constraints, identifiers."""
    def passes(check) -> bool:
        try:
            check()
        except ValueError:
            return False
        return True

    nation, quads = b.table(spark, sf, "nation"), graph_queries._live(spark, sf)[0]
    unsafe = quads.unionByName(spark.createDataFrame([("run:load-1", "a b", "p", "o")], quads.schema)) if quads.columns == ["graph", "s", "p", "o"] else quads
    checks = {
        "reference": lambda: resolve.require_reference({"nation": nation}), "empty reference": lambda: resolve.require_reference({"nation": nation.limit(0)}),
        "safe": lambda: g.require_none(g.unsafe(quads), "unsafe"), "unsafe": lambda: g.require_none(g.unsafe(unsafe), "unsafe"),
        "shapes": lambda: g.require_none(g.shape_violations(*graph_queries._live(spark, sf)), "shapes"),
    }
    return spark.createDataFrame([(k, passes(c)) for k, c in checks.items()], "check string, passes boolean")


_HITS = """SELECT o_orderkey AS id, lpad(CAST(c_custkey AS STRING), 9, '0') AS ident, CAST(c_custkey % 50 AS DOUBLE) AS ax, CAST(c_custkey % 40 AS DOUBLE) AS ay, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 50 AS DOUBLE) END AS x,
    CAST(o_orderkey % 40 AS DOUBLE) AS y, c_custkey % 4 <> 0 AS valid FROM {orders} JOIN {customer} ON o_custkey % 100 = c_custkey % 100 AND o_custkey < c_custkey + 300 AND c_custkey <= o_custkey + 300"""


def nearest_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Of each order's hits, valid ones before others, the nearest to its own point.

    A customer is handed to the few keys that its range reaches, so that the join is by one key;
    orders are dealt out, as a task sorts the hits of all of its orders.
    """
    reach = F.array(*[F.lit(100 * k) for k in range(-3, 4)])
    c = b.table(spark, sf, "customer").select("c_custkey", F.explode(F.transform(reach, lambda d: F.col("c_custkey") + d)).alias("at"))
    near = (F.col("o_custkey") % 100 == F.col("c_custkey") % 100) & (F.col("o_custkey") < F.col("c_custkey") + 300) & (F.col("c_custkey") <= F.col("o_custkey") + 300)
    pairs = b.spread(b.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 1 << 18).join(c, F.col("o_custkey") == F.col("at")).filter(near)
    hits = spark.sql(_HITS[: _HITS.index(" FROM {")] + " FROM {pairs}", pairs=pairs)
    return resolve.nearest_of(hits, "id", "x", "y").withColumn("dist", F.round("dist", 6))


QUERIES = {f.__name__: f for f in (
    xml_fields, title_places, dutch_numbers, name_mentions, lenient_dates, vocabulary, landed_envelopes, landed_records, landed_versions, registry_numbers, area_features, harvests, request_urls, harvest_marks, staged_rows,
    truncated_loads, snapshot_restore, graph_dump, turtle_blocks, committed_tables, gates, nearest_hits)}

_BLOCK = "'<' || s || '>' || chr(10) || '    ' || string_agg(po, ' ;' || chr(10) || '    ' ORDER BY po) || ' .'"
ORACLE = {
    "xml_fields": """SELECT p_partkey AS id, CASE WHEN p_partkey % 7 IN (0, 1) THEN p_name END AS title, CASE WHEN p_partkey % 7 = 3 THEN 'Z' || p_partkey ELSE '' END AS reference, CASE WHEN p_partkey % 7 = 4 THEN p_size::INT WHEN p_partkey % 7 IN (0, 1, 3) THEN 0 END AS total,
        CASE WHEN p_partkey % 7 = 1 THEN p_size::DOUBLE END AS x, CASE WHEN p_partkey % 7 = 1 THEN p_partkey + 0.5::DOUBLE END AS y, p_partkey % 7 IN (0, 1, 3, 4) AS well_formed FROM part""",
    "title_places": """SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 'nabij' WHEN 2 THEN 't.h.v.' END AS marker, CASE p_partkey % 5 WHEN 0 THEN 'Laan' || p_size WHEN 1 THEN 'Lange Straat' WHEN 2 THEN 'Kade' WHEN 3 THEN 'zonder nummer' END AS street,
        CASE p_partkey % 5 WHEN 0 THEN p_partkey WHEN 1 THEN p_size WHEN 2 THEN p_size END::INT AS huisnummer, CASE p_partkey % 5 WHEN 0 THEN '2' WHEN 2 THEN 'H' END AS suffix, CASE p_partkey % 5 WHEN 0 THEN '1012LG' WHEN 1 THEN '1012AB' END AS postcode FROM part""",
    "dutch_numbers": "SELECT p_partkey, nullif(p_size % 100, 0)::INT AS n, p_size::INT AS digits FROM part",
    "name_mentions": """SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'els' WHEN 2 THEN 'iep' ELSE '' END AS dutch, CASE p_partkey % 4 WHEN 0 THEN 'Ulmus' WHEN 2 THEN 'Acer' ELSE '' END AS latin, p_partkey % 4 IN (0, 2) AS cultivar,
        CASE WHEN p_partkey % 4 = 1 THEN 'Noord Oever' END AS project, CASE p_partkey % 4 WHEN 0 THEN p_partkey::VARCHAR WHEN 1 THEN '7,' || p_size ELSE '' END AS numbers FROM part""",
    "lenient_dates": "WITH d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 < 2 THEN o_orderdate::DATE END AS day FROM orders) SELECT id, day, greatest(coalesce(day - 7, DATE '2021-01-01'), DATE '2021-01-01') AS since FROM d",
    "vocabulary": f"""WITH n AS (SELECT DISTINCT name FROM ({plain(_SPECIES).replace('chr(97 + p_size % 9)', 'chr((97 + p_size % 9)::INT)')})), x AS (SELECT name, regexp_extract(name, 'Genus[a-i]') AS genus, CASE WHEN name LIKE 'Boom%' THEN split_part(name, ' (', 1) END AS dutch FROM n WHERE name <> 'onbekend')
        SELECT 'scheme/trees/' || lower(genus) AS concept, coalesce(min(dutch), genus) AS label, count(*)::INT AS names, CASE WHEN min(dutch) IS NOT NULL THEN genus END AS alt FROM x GROUP BY genus""",
    "landed_envelopes": "SELECT '1' || p_partkey || '234567890123' AS id, 'a\"}{' AS soort, NULL::DOUBLE AS x, NULL::DOUBLE AS y FROM part UNION ALL SELECT p_partkey::VARCHAR, NULL, p_size::DOUBLE, 2.5::DOUBLE FROM part",
    "landed_records": f"""WITH n AS (SELECT CASE WHEN n_nationkey % 7 = 3 THEN 'note-' ELSE 'gmb-2022-' END || n_nationkey AS id, n_nationkey AS k, n_name, CASE WHEN n_nationkey % 7 = 3 THEN 'name' WHEN n_nationkey % 5 = 1 THEN 'malformed' END AS why FROM nation)
        SELECT id, CASE WHEN why IS NULL THEN n_name END AS title, CASE WHEN why IS NULL AND k % 2 = 0 THEN 'Z' || k END AS reference, why FROM n""",
    "landed_versions": """WITH r AS (SELECT r_name AS name, 'https://example.org/' || r_regionkey AS source_url, unnest([r_name, lower(r_name), r_name]) AS c FROM region) SELECT name, source_url, strlen(c)::BIGINT AS byte_size, sha256(c) AS content_sha256, count(*) AS n FROM r GROUP BY ALL""",
    "registry_numbers": "SELECT 'NL.0363.' || c_custkey AS identificatie, (c_custkey % 97 + 1)::INT AS huisnummer FROM customer WHERE c_custkey % 3 <> 0",
    "area_features": "SELECT n_name AS naam, 28992 AS srid, 4 AS points, (n_nationkey + 4)::DOUBLE AS x FROM nation WHERE n_nationkey % 4 <> 1 AND n_nationkey % 6 <> 2",
    "harvests": "WITH n AS (SELECT (row_number() OVER ())::INT AS n FROM nation) SELECT unnest(['sru', 'hal']) AS kind, n FROM n UNION ALL SELECT 'numbered', n - 1 FROM n",
    "request_urls": """SELECT * FROM (VALUES ('sru', 'https://example.org/sru?version=2.0&operation=searchRetrieve&startRecord=101&maximumRecords=100&query=keyword%3Dkap+and+dt.available%3E%3D2024-01-01'),
        ('wfs', 'https://example.org/wfs?service=WFS&version=2.0.0&request=GetFeature&typeNames=buurten&outputFormat=application%2Fjson&count=10000&filter=%3CFilter%3E%3CPropertyIsEqualTo%3E%3CPropertyName%3Egemeente%3C%2FPropertyName%3E%3CLiteral%3EGM0363%3C%2FLiteral%3E%3C%2FPropertyIsEqualTo%3E%3C%2FFilter%3E'),
        ('source 0', 'a'), ('source 1', 'b'), ('source 2', 'c'), ('named 0', 'c'), ('named 1', 'a')) t(name, value)""",
    "harvest_marks": "WITH m AS (SELECT max((o_orderdate::DATE + INTERVAL 360 MONTH)::DATE) AS d FROM orders) SELECT 0::INT AS step, '2021-01-01' AS mark, '2021-01-01' AS since UNION ALL SELECT unnest([1, 2])::INT, d::VARCHAR, greatest(d - 7, DATE '2021-01-01')::VARCHAR FROM m",
    "staged_rows": """WITH s AS (SELECT o_orderdate::DATE AS d, o_orderkey % 3 AS k, concat_ws(',', CASE WHEN o_orderkey % 3 = 2 THEN 'day' END, CASE WHEN o_orderkey % 5 = 0 THEN 'customer' END) AS why FROM orders)
        SELECT why, count(*) AS n, max(CASE WHEN why = '' AND k = 0 THEN d END) AS last FROM s GROUP BY why""",
    "truncated_loads": "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1",
    "snapshot_restore": "SELECT 'nation' AS \"table\", n_name AS name FROM nation UNION ALL SELECT 'region', r_name FROM region",
    "graph_dump": f"WITH {graph_queries._Q} SELECT graph, s, p, o FROM q UNION ALL SELECT 'other', 'a', 'b', 'c'",
    "turtle_blocks": f"""WITH {graph_queries._Q}, t AS (SELECT DISTINCT s, '<' || p || '> ' || CASE WHEN regexp_full_match(o, '[a-z][a-z0-9+.-]*:\\S*') THEN '<' || o || '>' ELSE '"' || o || '"' END AS po FROM q WHERE s LIKE '{g.DATA}place/%') SELECT s, {_BLOCK} AS turtle FROM t GROUP BY s""",
    "committed_tables": "SELECT n_nationkey, true AS b_gone FROM nation WHERE n_regionkey <> 2",
    "gates": "SELECT * FROM (VALUES ('reference', true), ('empty reference', false), ('safe', true), ('unsafe', false), ('shapes', false)) t(\"check\", passes)",
    "nearest_hits": f"""WITH h AS ({plain(_HITS)}), d AS (SELECT id, ident, valid, sqrt((ax - x) * (ax - x) + (ay - y) * (ay - y)) AS dist FROM h) SELECT id, ident, round(dist, 6) AS dist, valid FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY NOT valid, dist NULLS LAST, ident) AS rn FROM d) WHERE rn = 1""",
}
