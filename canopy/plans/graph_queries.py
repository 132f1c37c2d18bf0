"""Versioned graph facts: signatures, classification, closing, invariants, constraints and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.text import safe_iri
from canopy.operators import graph as g
from canopy.plans import bindings as b
from canopy.plans.relations import plain, relation

_D, _N = g.DATA, g.NS
_PLACE, _LINK, _FRESH = f"'{_D}place/' || n_nationkey", f"'{_D}auditlink/' || c_custkey", f"'{_D}auditlink/s' || s_suppkey"


def _q(text: str) -> str:
    return f"'{text}'"


def _live_rows() -> list[tuple]:
    """(table, condition, graph, s, p, o): nations as places, every customer an audit link with one or two periods; a condition gives a link its state."""
    links = "true"
    out = [
        ("nation", "true", _q("run:load-1"), _PLACE, _q("rdf:type"), _q(_N + "Place")), ("nation", "true", _q("run:load-1"), _PLACE, _q("rdfs:label"), "n_name"),
        ("nation", "true", _q("run:load-1"), _PLACE, _q(_N + "active"), _q("true")), ("nation", "n_nationkey % 5 = 0", _q("run:load-2"), _PLACE, _q(_N + "active"), _q("false")),
        ("customer", links, _q("run:load-1"), _LINK, _q("rdf:type"), _q(_N + "AuditLink")), ("customer", "c_custkey % 40 <> 1", _q("run:load-1"), _LINK, _q(_N + "coversIntervention"), f"'{_D}intervention/' || c_custkey"),
    ]
    for v in (1, 2):
        own = links if v == 1 else "c_custkey % 3 = 0"
        graph, node = _q(f"run:load-{v}"), f"{_LINK} || '/k{v}'"
        out += [
            ("customer", own, graph, node, _q("rdf:type"), _q(_N + "CoveragePeriod")), ("customer", own, graph, node, _q(g.OF), _LINK), ("customer", own, graph, node, _q(g.FROM), _q(f"2024-0{v}-01")),
            ("customer", f"{own} AND c_custkey % 60 <> 7", graph, node, _q(_N + "evidence"), "'seen ' || c_mktsegment"),
        ]
    first = f"{_LINK} || '/k1'"
    return out + [
        ("customer", "c_custkey % 2 = 0", _q("run:load-1"), first, _q(_N + "noSourceFound"), _q("true")),
        ("customer", "c_custkey % 2 = 1 OR c_custkey % 50 = 0", _q("run:load-1"), first, _q(_N + "confidence"), "CASE WHEN c_custkey % 31 = 0 THEN '1.5' ELSE '0.70' END"),
        ("customer", "c_custkey % 3 = 0 AND c_custkey % 50 <> 0", _q("run:load-1"), first, _q(g.TO), _q("2024-02-01")),
    ]


_NAME = "CASE WHEN n_nationkey % 4 = 0 THEN n_name || ' x' ELSE n_name END"
_ACTIVE = "CASE WHEN n_nationkey % 5 = 0 THEN 'false' ELSE 'true' END"
LIVE = _live_rows()
NOTES = [
    ("nation", "true", _q("run:load-1"), _PLACE, _q(_N + "active"), _q("true"), _q(g.FROM), _q("2024-01-01")), ("nation", "n_nationkey % 5 = 0", _q("run:load-1"), _PLACE, _q(_N + "active"), _q("true"), _q(g.TO), _q("2024-02-01")),
    ("nation", "n_nationkey % 5 = 0", _q("run:load-2"), _PLACE, _q(_N + "active"), _q("false"), _q(g.FROM), _q("2024-02-01")), ("nation", "n_nationkey % 2 = 0", _q("run:load-1"), _PLACE, _q("rdfs:label"), "n_name", _q(_N + "confidence"), _q("0.9")),
]
STAGED = [
    ("nation", "true", _q("stage"), _PLACE, _q("rdf:type"), _q(_N + "Place")), ("nation", "true", _q("stage"), _PLACE, _q("rdfs:label"), _NAME), ("nation", "true", _q("stage"), _PLACE, _q(_N + "active"), _ACTIVE),
    ("customer", "true", _q("stage"), _LINK, _q("rdf:type"), _q(_N + "AuditLink")), ("supplier", "true", _q("stage"), _FRESH, _q("rdf:type"), _q(_N + "AuditLink")),
    ("customer", "c_custkey % 40 <> 1", _q("stage"), _LINK, _q(_N + "coversIntervention"), f"'{_D}intervention/' || (CASE WHEN c_custkey % 90 = 89 THEN c_custkey + 1 ELSE c_custkey END)"),
]
STAGED_NOTES = [
    ("nation", "true", _q("stage"), _PLACE, _q(_N + "active"), _ACTIVE, _q(g.FROM), _q("2024-03-01")), ("nation", "n_nationkey % 2 = 0", _q("stage"), _PLACE, _q("rdfs:label"), _NAME, _q(_N + "confidence"), _q("0.9")),
]
_COLUMNS = ["graph", "s", "p", "o", "ap", "av"]


def _as_sql(rows: list[tuple]) -> str:
    return " UNION ALL ".join(f"SELECT {', '.join(f'{x} AS {c}' for x, c in zip(r[2:], _COLUMNS))} FROM {r[0]} WHERE {r[1]}" for r in rows)


def _as_frame(spark: SparkSession, sf: str, rows: list[tuple]) -> DataFrame:
    """The same rows with one scan of each table, which is dealt out before each row becomes up to twenty."""
    out = None
    for name in dict.fromkeys(r[0] for r in rows):
        each = [f"CASE WHEN {r[1]} THEN named_struct({', '.join(f'{_q(c)}, {x}' for x, c in zip(r[2:], _COLUMNS))}) END" for r in rows if r[0] == name]
        part = b.spread(b.table(spark, sf, name)).select(F.explode(F.array_compact(F.array(*map(F.expr, each)))).alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    return out


def _live(spark, sf):
    return _as_frame(spark, sf, LIVE), _as_frame(spark, sf, NOTES)


def _staged(spark, sf):
    return _as_frame(spark, sf, STAGED), _as_frame(spark, sf, STAGED_NOTES)


def graph_signatures(spark: SparkSession, sf: str) -> DataFrame:
    return g.signatures(*_live(spark, sf)).select("s", F.sha2("signature", 256).alias("signature"), "evolving")


def graph_classify(spark: SparkSession, sf: str) -> DataFrame:
    return g.classify(g.signatures(*_staged(spark, sf)), g.signatures(*_live(spark, sf)))


def graph_delta(spark: SparkSession, sf: str) -> DataFrame:
    return g.delta(_staged(spark, sf)[0], graph_classify(spark, sf), g.run_graph(F.lit("2024-03-01 12:00:00").cast("timestamp")))


def graph_close_annotations(spark: SparkSession, sf: str) -> DataFrame:
    changed = graph_classify(spark, sf).filter("state = 'changed'").select("s", F.lit("2024-03-01").alias("valid_from"))
    return g.close_annotations(_live(spark, sf)[1], changed)


def graph_close_series(spark: SparkSession, sf: str) -> DataFrame:
    fresh = relation(spark, sf, f"SELECT '{_D}auditlink/' || c_custkey || '/k9' AS s, '{_D}auditlink/' || c_custkey AS anchor, '2024-03-01' AS valid_from FROM {{customer}}")
    return g.close_series(_live(spark, sf)[0], fresh)


def graph_open_violations(spark: SparkSession, sf: str) -> DataFrame:
    return g.open_violations(_live(spark, sf)[0])


def shape_violations(spark: SparkSession, sf: str) -> DataFrame:
    return g.shape_violations(*_live(spark, sf)).groupBy("path", "message").agg(F.count("*").alias("n"))


def within_closure(spark: SparkSession, sf: str) -> DataFrame:
    edges = relation(spark, sf, _WITHIN)
    return g.closure(spark, edges).select("child", "ancestor", F.col("depth").cast("int").alias("depth"))


_WITHIN = "SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM {nation} UNION ALL SELECT 'r' || r_regionkey, 'world' FROM {region} UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM {customer}"


def edge_annotations(spark: SparkSession, sf: str) -> DataFrame:
    """Edges of places with their confidence, where there is one."""
    q, a = _live(spark, sf)
    c = a.filter(F.col("ap") == g.n("confidence")).select("graph", "s", "p", "o", F.col("av").alias("confidence"))
    return q.filter(F.col("p") == "rdfs:label").join(c, ["graph", "s", "p", "o"], "left").orderBy("s")


def named_graphs(spark: SparkSession, sf: str) -> DataFrame:
    return _live(spark, sf)[0].filter(F.col("graph").startswith(g.RUNS)).groupBy("graph").agg(F.count("*").alias("n"))


def place_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as places: live ones active, deleted ones not, within their region if it is known."""
    n = b.table(spark, sf, "nation").withColumn("deleted", F.when(F.col("n_nationkey") % 6 == 0, "2024-02-02")).withColumn("known", F.col("n_regionkey") != 3)
    place = lambda c: F.concat(F.lit(_D + "place/"), c.cast("string"))
    return g.melt(n, place(F.col("n_nationkey")), "Place", {
        "rdfs:label": F.col("n_name"), g.n("active"): F.when(F.col("deleted").isNull(), "true").otherwise("false"), g.n("within"): F.when(F.col("known"), place(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")))),
    })


def felling_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as fellings with their trees, each tree once; rows without a tree are skipped."""
    f = b.fellings(spark, sf).withColumn("tree", F.split("felling", "-")[2]).filter(F.col("tree").cast("long") % 9 != 0)
    felled = g.melt(f, F.concat(F.lit(_D + "felling/"), "felling"), "Felling", {g.n("felledTree"): F.concat(F.lit(_D + "tree/"), F.col("tree")), g.n("felledOn"): F.date_format("felled", "yyyy-MM-dd")})
    trees = g.melt(f.select("tree").distinct(), F.concat(F.lit(_D + "tree/"), "tree"), "Tree", {})
    return felled.unionByName(trees).groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("s").alias("subjects"), F.max("o").alias("last"))


def permit_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Permits as interventions with a claim and a place."""
    p = b.permits(spark, sf).withColumn("z", F.col("zaak").cast("string"))
    q = g.melt(p, F.concat(F.lit(_D + "intervention/"), "z"), "Intervention", {
        g.AVAILABLE: F.date_format("pub", "yyyy-MM-dd"), g.n("activity"): F.lit("act:vellen"), g.n("claims"): F.concat(F.lit(_D + "claim/"), F.col("z")), g.n("locatedAt"): F.concat(F.lit(_D + "place/"), F.col("area").cast("string")),
    })
    return q.groupBy("p").agg(F.count("*").alias("n"), F.min("o").alias("first"), F.max("o").alias("last"))


def unsafe_iris(spark: SparkSession, sf: str) -> DataFrame:
    raw = relation(spark, sf, _IRIS)
    return raw.select("id", safe_iri(F.col("iri")).alias("safe"))


_IRIS = "SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN 'x>' || p_name WHEN 1 THEN p_name WHEN 2 THEN 'a{{b' WHEN 3 THEN NULL WHEN 4 THEN '' ELSE 'iri/' || p_partkey END AS iri FROM {part}".replace("a{{b", "a|b")


def cross_graph(spark: SparkSession, sf: str) -> DataFrame:
    """Run data joined with what the model graph says of its run."""
    q = _live(spark, sf)[0]
    about = q.select("graph").distinct().select(F.col("graph").alias("run"), F.when(F.col("graph").endswith("1"), "2024-01-01").otherwise("2024-02-01").alias("generated"))
    return q.filter(F.col("p") == g.OF).join(about, F.col("graph") == F.col("run")).groupBy("generated").agg(F.count("*").alias("n"))


def graph_bindings(spark: SparkSession, sf: str) -> DataFrame:
    """Periods with the intervention that their link covers and what was seen: three patterns with shared variables."""
    return g.match(_live(spark, sf)[0], [("?node", g.OF, "?link"), ("?link", _N + "coversIntervention", "?intervention"), ("?node", _N + "evidence", "?seen")]).select("node", "link", "intervention", "seen")


def graph_starts(spark: SparkSession, sf: str) -> DataFrame:
    """When each changed subject's new state begins, out of its staged node or annotation."""
    changed = graph_classify(spark, sf).filter("state = 'changed'")
    return g.starts_of(*_staged(spark, sf), changed)


def _runs(spark, sf):
    """Two loads of customers' links, one period each; the second has new periods for a third of them."""
    rows = [("l", "rdf:type", f"'{_N}AuditLink'"), ("l", _N + "coversIntervention", f"'{_D}intervention/' || c_custkey"), ("k", "rdf:type", f"'{_N}CoveragePeriod'"), ("k", g.OF, "l"), ("k", _N + "noSourceFound", "'true'"), ("k", _N + "evidence", "'none'")]

    def link(v: int) -> DataFrame:
        each = ", ".join(f"named_struct('graph', 'stage', 's', {s}, 'p', '{p}', 'o', {o})" for s, p, o in [*rows, ("k", g.FROM, f"'2024-0{v}-01'")])
        key = f"CASE WHEN {v} = 2 AND c_nationkey % 3 = 0 THEN '/k2' ELSE '/k1' END"
        return relation(spark, sf, f"SELECT inline(array({each})) FROM (SELECT c_custkey, {_LINK} AS l, {_LINK} || {key} AS k FROM {{customer}})", lambda *a: b.spread(b.table(*a)))

    none = spark.createDataFrame([], "graph string, s string, p string, o string, ap string, av string")
    quads, notes = spark.createDataFrame([], "graph string, s string, p string, o string"), none
    for v in (1, 2):
        quads, notes, _ = g.upsert_run(spark, quads, notes, link(v), none, F.lit(f"2024-0{v}-01 00:00:00").cast("timestamp"))
    return quads


def graph_load(spark: SparkSession, sf: str) -> DataFrame:
    """What two whole loads leave behind, gates, closing and provenance included."""
    return _runs(spark, sf).groupBy("graph", "p").agg(F.count("*").alias("n"), F.count_distinct("s").alias("subjects"))


def graph_reset(spark: SparkSession, sf: str) -> DataFrame:
    """The model stays when all runs are dropped."""
    model = b.table(spark, sf, "nation").select(F.lit("model").alias("graph"), F.concat(F.lit(_D + "place/"), F.col("n_nationkey").cast("string")).alias("s"), F.lit("rdfs:label").alias("p"), F.col("n_name").alias("o"))
    return g.drop_runs(_live(spark, sf)[0].unionByName(model).unionByName(spark.range(1).select(F.explode(g.provenance(g.run_graph(F.lit("2024-01-01 00:00:00").cast("timestamp")), F.lit("2024-01-01 00:00:00").cast("timestamp"))).alias("r")).select("r.*")))


def run_record(spark: SparkSession, sf: str) -> DataFrame:
    """A run's name and the rows that record it, one run an order day."""
    day = F.col("day").cast("timestamp")
    days = b.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select(F.explode(g.provenance(g.run_graph(day), day)).alias("r")).select("r.*")


QUERIES = {f.__name__: f for f in (graph_signatures, graph_classify, graph_delta, graph_close_annotations, graph_close_series, graph_open_violations, shape_violations, within_closure, edge_annotations, named_graphs, place_projection, felling_projection, permit_projection, unsafe_iris, cross_graph, graph_bindings, graph_starts, graph_load, graph_reset, run_record)}

_Q = f"q AS ({_as_sql(LIVE)}), a AS ({_as_sql(NOTES)}), sq AS ({_as_sql(STAGED)}), sa AS ({_as_sql(STAGED_NOTES)})"


def _sig(q: str, a: str, name: str) -> str:
    return f"""{name}_rows AS (SELECT DISTINCT s, row FROM (
        SELECT s, p || ' ' || o AS row FROM {q} q WHERE s LIKE '{_D}%' AND p NOT IN ('{g.FROM}', '{g.TO}') AND NOT EXISTS (SELECT 1 FROM {q} c WHERE c.graph = q.graph AND c.s = q.s AND c.p = '{g.TO}')
          AND NOT EXISTS (SELECT 1 FROM {a} c WHERE c.graph = q.graph AND c.s = q.s AND c.p = q.p AND c.o = q.o AND c.ap = '{g.TO}')
        UNION ALL SELECT s, 'ann ' || p || ' ' || o || ' ' || ap || ' ' || av FROM {a} q WHERE ap NOT IN ('{g.FROM}', '{g.TO}') AND NOT EXISTS (SELECT 1 FROM {a} c WHERE c.graph = q.graph AND c.s = q.s AND c.p = q.p AND c.o = q.o AND c.ap = '{g.TO}'))),
    {name} AS (SELECT s, string_agg(row, chr(31) ORDER BY row) AS signature, s IN (SELECT s FROM {q} WHERE p = '{g.FROM}') OR s IN (SELECT s FROM {a} WHERE ap = '{g.FROM}') AS evolving FROM {name}_rows GROUP BY s)"""


_CLASS = f"""{_Q}, {_sig('q', 'a', 'live')}, {_sig('sq', 'sa', 'cand')}, cls AS (SELECT c.s, CASE WHEN l.s IS NULL THEN 'new' WHEN l.signature = c.signature THEN 'unchanged' WHEN c.evolving THEN 'changed' ELSE 'immutableConflict' END AS state FROM cand c LEFT JOIN live l USING (s))"""
ORACLE = {
    "graph_signatures": f"WITH {_Q}, {_sig('q', 'a', 'live')} SELECT s, sha256(signature) AS signature, evolving FROM live",
    "graph_classify": f"WITH {_CLASS} SELECT * FROM cls",
    "graph_delta": f"WITH {_CLASS} SELECT 'run:load-20240301T120000Z' AS graph, s, p, o FROM sq WHERE s IN (SELECT s FROM cls WHERE state IN ('new', 'changed'))",
    "graph_close_annotations": f"WITH {_CLASS} SELECT graph, s, p, o, '{g.TO}' AS ap, '2024-03-01' AS av FROM a WHERE ap = '{g.FROM}' AND s IN (SELECT s FROM cls WHERE state = 'changed') AND NOT EXISTS (SELECT 1 FROM a c WHERE c.graph = a.graph AND c.s = a.s AND c.p = a.p AND c.o = a.o AND c.ap = '{g.TO}')",
    "graph_close_series": f"WITH {_Q} SELECT graph, s, '{g.TO}' AS p, '2024-03-01' AS o FROM q WHERE p = '{g.OF}' AND NOT EXISTS (SELECT 1 FROM q c WHERE c.graph = q.graph AND c.s = q.s AND c.p = '{g.TO}')",
    "graph_open_violations": f"WITH {_Q} SELECT o AS anchor, count(*) FILTER (NOT EXISTS (SELECT 1 FROM q c WHERE c.graph = q.graph AND c.s = q.s AND c.p = '{g.TO}')) AS n_open FROM q WHERE p = '{g.OF}' GROUP BY o HAVING n_open <> 1",
    "shape_violations": f"""WITH {_Q}, cp AS (SELECT DISTINCT s FROM q WHERE p = 'rdf:type' AND o = '{_N}CoveragePeriod'), al AS (SELECT DISTINCT s FROM q WHERE p = 'rdf:type' AND o = '{_N}AuditLink'),
        f AS (SELECT s, count(*) FILTER (p = '{_N}linksObservation') AS ob, count(*) FILTER (p = '{_N}confidence') AS cf, count(*) FILTER (p = '{_N}noSourceFound') AS ns FROM q WHERE s IN (SELECT s FROM cp) GROUP BY s),
        v AS (SELECT s, '{_N}coversIntervention' AS path, 'AuditLink needs 1 to any' AS message FROM al WHERE s NOT IN (SELECT s FROM q WHERE p = '{_N}coversIntervention')
        UNION ALL SELECT s, '{_N}evidence', 'CoveragePeriod needs 1 to any' FROM cp WHERE s NOT IN (SELECT s FROM q WHERE p = '{_N}evidence')
        UNION ALL SELECT s, '{_N}confidence', 'must be within [0, 1]' FROM q WHERE p = '{_N}confidence' AND TRY_CAST(o AS DOUBLE) NOT BETWEEN 0 AND 1 AND s IN (SELECT s FROM cp)
        UNION ALL SELECT s, '{_N}linksObservation', 'neither or both of matched and without source' FROM f WHERE (ob > 0 AND cf > 0 AND ns = 0) = (ns > 0 AND ob = 0 AND cf = 0))
        SELECT path, message, count(*) AS n FROM v GROUP BY 1, 2""",
    "within_closure": f"WITH RECURSIVE e AS ({plain(_WITHIN)}), up AS (SELECT child, parent AS ancestor, 1 AS depth FROM e UNION ALL SELECT up.child, e.parent, up.depth + 1 FROM up JOIN e ON up.ancestor = e.child) SELECT child, ancestor, min(depth)::INT AS depth FROM up GROUP BY 1, 2",
    "edge_annotations": f"WITH {_Q} SELECT q.graph, q.s, q.p, q.o, c.av AS confidence FROM q LEFT JOIN a c ON c.graph = q.graph AND c.s = q.s AND c.p = q.p AND c.o = q.o AND c.ap = '{_N}confidence' WHERE q.p = 'rdfs:label'",
    "named_graphs": f"WITH {_Q} SELECT graph, count(*) AS n FROM q WHERE graph LIKE 'run:load-%' GROUP BY graph",
    "place_projection": f"""WITH n AS (SELECT '{_D}place/' || n_nationkey AS s, * FROM nation) SELECT s, 'rdf:type' AS p, '{_N}Place' AS o FROM n UNION ALL SELECT s, 'rdfs:label', n_name FROM n
        UNION ALL SELECT s, '{_N}active', CASE WHEN n_nationkey % 6 = 0 THEN 'false' ELSE 'true' END FROM n UNION ALL SELECT s, '{_N}within', '{_D}place/r' || n_regionkey FROM n WHERE n_regionkey <> 3""",
    "felling_projection": f"""WITH {b.FELLINGS_SQL}, f AS (SELECT felling, felled, split_part(felling, '-', 3) AS tree FROM fellings WHERE split_part(felling, '-', 3)::BIGINT % 9 <> 0),
        q AS (SELECT '{_D}felling/' || felling AS s, 'rdf:type' AS p, '{_N}Felling' AS o FROM f UNION ALL SELECT '{_D}felling/' || felling, '{_N}felledTree', '{_D}tree/' || tree FROM f UNION ALL SELECT '{_D}felling/' || felling, '{_N}felledOn', strftime(felled, '%Y-%m-%d') FROM f
        UNION ALL SELECT DISTINCT '{_D}tree/' || tree, 'rdf:type', '{_N}Tree' FROM f) SELECT p, count(*) AS n, count(DISTINCT s) AS subjects, max(o) AS last FROM q GROUP BY p""",
    "permit_projection": f"""WITH {b.PERMITS_SQL}, q AS (SELECT 'rdf:type' AS p, '{_N}Intervention' AS o FROM permits UNION ALL SELECT 'dct:available', strftime(pub, '%Y-%m-%d') FROM permits UNION ALL SELECT '{_N}activity', 'act:vellen' FROM permits
        UNION ALL SELECT '{_N}claims', '{_D}claim/' || zaak FROM permits UNION ALL SELECT '{_N}locatedAt', '{_D}place/' || area FROM permits) SELECT p, count(*) AS n, min(o) AS first, max(o) AS last FROM q GROUP BY p""",
    "unsafe_iris": f"SELECT id, iri IS NOT NULL AND iri <> '' AND NOT regexp_matches(iri, '[\\x00-\\x20<>\"{{}}|^`\\\\]') AS safe FROM ({plain(_IRIS)})",
    "cross_graph": f"WITH {_Q} SELECT CASE WHEN graph LIKE '%1' THEN '2024-01-01' ELSE '2024-02-01' END AS generated, count(*) AS n FROM q WHERE p = '{g.OF}' GROUP BY 1",
    "graph_bindings": f"WITH {_Q} SELECT DISTINCT k.s AS node, k.o AS link, i.o AS intervention, e.o AS seen FROM q k JOIN q i ON i.s = k.o AND i.p = '{_N}coversIntervention' JOIN q e ON e.s = k.s AND e.p = '{_N}evidence' WHERE k.p = '{g.OF}'",
    "graph_starts": f"WITH {_CLASS}, v AS (SELECT s, o AS v FROM sq WHERE p = '{g.FROM}' UNION ALL SELECT s, av FROM sa WHERE ap = '{g.FROM}') SELECT s, min(v) AS valid_from FROM cls JOIN v USING (s) WHERE state = 'changed' GROUP BY s",
    "graph_load": f"""WITH c AS (SELECT c_custkey AS k, c_nationkey % 3 = 0 AS moved FROM customer), p AS (SELECT unnest(['rdf:type', '{_N}coversIntervention', '{g.OF}', '{g.FROM}', '{_N}noSourceFound', '{_N}evidence']) AS p),
        r AS (SELECT 'run:load-20240101T000000Z' AS graph, p, count(*) * CASE p WHEN 'rdf:type' THEN 2 ELSE 1 END AS n FROM c, p GROUP BY p UNION ALL SELECT 'run:load-20240101T000000Z', '{g.TO}', count(*) FROM c WHERE moved
        UNION ALL SELECT 'run:load-20240201T000000Z', p, count(*) FROM c, p WHERE moved AND p <> '{_N}coversIntervention' GROUP BY p UNION ALL SELECT 'run:_provenance', unnest(['rdf:type', 'prov:generatedAtTime']), 2)
        SELECT graph, p, n::BIGINT AS n, n::BIGINT AS subjects FROM r WHERE n > 0""",
    "graph_reset": f"SELECT 'model' AS graph, '{_D}place/' || n_nationkey AS s, 'rdfs:label' AS p, n_name AS o FROM nation",
    "run_record": """WITH d AS (SELECT DISTINCT 'run:load-' || strftime(o_orderdate::DATE, '%Y%m%dT000000Z') AS s, strftime(o_orderdate::DATE, '%Y-%m-%dT00:00:00Z') AS made FROM orders)
        SELECT 'run:_provenance' AS graph, s, 'rdf:type' AS p, 'prov:Activity' AS o FROM d UNION ALL SELECT 'run:_provenance', s, 'prov:generatedAtTime', made FROM d""",
}
