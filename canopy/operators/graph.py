"""Versioned graph facts: quads(graph, s, p, o) and annotations(graph, s, p, o, ap, av).

Openness is judged per named graph and subject, so the same content-keyed
subject may be closed in an old graph and open in a new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.functions.text import safe_iri
from canopy.sources.files import written

NS = "https://example.org/ns#"
DATA = "https://example.org/id/"
TYPE, LABEL, AVAILABLE = "rdf:type", "rdfs:label", "dct:available"
FROM, TO, OF = NS + "validFrom", NS + "validTo", NS + "versionOf"
RUNS = "run:load-"
SEPARATOR = "\x1f"


def n(name: str) -> str:
    return NS + name


def _closed(quads: DataFrame, annotations: DataFrame) -> tuple[DataFrame, DataFrame]:
    nodes = quads.filter(F.col("p") == TO).select("graph", "s").distinct()
    edges = annotations.filter(F.col("ap") == TO).select("graph", "s", "p", "o").distinct()
    return nodes, edges


def signatures(quads: DataFrame, annotations: DataFrame, prefix: str = DATA) -> DataFrame:
    """(s, signature, evolving) for each subject under the prefix: its open rows in order, times left out."""
    nodes, edges = _closed(quads, annotations)
    own = quads.filter(F.col("s").startswith(prefix) & ~F.col("p").isin(FROM, TO))
    plain = own.join(edges, ["graph", "s", "p", "o"], "left_anti").join(nodes, ["graph", "s"], "left_anti").select("s", F.concat_ws(" ", "p", "o").alias("row"))
    ann = annotations.filter(F.col("s").startswith(prefix) & ~F.col("ap").isin(FROM, TO, "rdf:reifies")).join(edges, ["graph", "s", "p", "o"], "left_anti")
    noted = ann.select("s", F.concat_ws(" ", F.lit("ann"), "p", "o", "ap", "av").alias("row"))
    rows = plain.unionByName(noted).distinct()
    signed = rows.groupBy("s").agg(F.array_join(F.array_sort(F.collect_list("row")), SEPARATOR).alias("signature"))
    evolving = quads.filter(F.col("p") == FROM).select("s").unionByName(annotations.filter(F.col("ap") == FROM).select("s")).distinct().withColumn("evolving", F.lit(True))
    return signed.join(evolving, "s", "left").select("s", "signature", F.coalesce("evolving", F.lit(False)).alias("evolving"))


def classify(candidate: DataFrame, live: DataFrame) -> DataFrame:
    """new, unchanged, changed, or a conflict where an immutable subject would change."""
    old = live.select("s", F.col("signature").alias("_old"), F.col("evolving").alias("_was"))
    joined = candidate.join(old, "s", "left")
    state = F.when(F.col("_old").isNull(), "new").when(F.col("signature") == F.col("_old"), "unchanged").when(F.col("evolving"), "changed").otherwise("immutableConflict")
    return joined.select("s", state.alias("state"))


def close_annotations(annotations: DataFrame, stamps: DataFrame) -> DataFrame:
    """Rows that close the open annotated edges of subjects in stamps(s, valid_from)."""
    opened = annotations.filter(F.col("ap") == FROM)
    shut = annotations.filter(F.col("ap") == TO).select("graph", "s", "p", "o").distinct()
    return opened.join(shut, ["graph", "s", "p", "o"], "left_anti").join(stamps, "s").select("graph", "s", "p", "o", F.lit(TO).alias("ap"), F.col("valid_from").alias("av"))


def close_series(quads: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows that close other open nodes of an anchor, for fresh(s, anchor, valid_from)."""
    series = quads.filter(F.col("p") == OF).select("graph", F.col("s").alias("node"), F.col("o").alias("anchor"))
    shut = quads.filter(F.col("p") == TO).select("graph", F.col("s").alias("node")).distinct()
    opened = series.join(shut, ["graph", "node"], "left_anti").join(fresh, "anchor").filter(F.col("node") != F.col("s"))
    return opened.select("graph", F.col("node").alias("s"), F.lit(TO).alias("p"), F.col("valid_from").alias("o")).distinct()


def open_violations(quads: DataFrame) -> DataFrame:
    """Anchors that haven't exactly one open version."""
    series = quads.filter(F.col("p") == OF).select("graph", "s", F.col("o").alias("anchor"))
    shut = quads.filter(F.col("p") == TO).select("graph", "s").distinct().withColumn("shut", F.lit(1))
    return series.join(shut, ["graph", "s"], "left").groupBy("anchor").agg(F.count_if(F.col("shut").isNull()).alias("n_open")).filter("n_open <> 1")


def delta(quads: DataFrame, classified: DataFrame, graph: Column) -> DataFrame:
    """Rows of new and changed subjects, in the run's own graph; no rows where nothing changed."""
    return quads.join(classified.filter(F.col("state").isin("new", "changed")), "s", "left_semi").select(graph.alias("graph"), "s", "p", "o")


def provenance(graph: Column, at: Column) -> Column:
    """The rows that record a run, as an array."""
    row = lambda p, o: F.struct(F.lit("run:_provenance").alias("graph"), graph.alias("s"), F.lit(p).alias("p"), o.alias("o"))
    return F.array(row(TYPE, F.lit("prov:Activity")), row("prov:generatedAtTime", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")))


def run_graph(at: Column) -> Column:
    return F.concat(F.lit(RUNS), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"))


def unsafe(quads: DataFrame) -> DataFrame:
    """Subjects and predicates that must not be written back."""
    return quads.filter(~safe_iri(F.col("s")) | ~safe_iri(F.col("p")))


def melt(df: DataFrame, subject: Column, kind: str, columns: dict[str, Column]) -> DataFrame:
    """(s, p, o) of a table: a type row and one row per non-null column."""
    pairs = [F.struct(F.lit(TYPE).alias("p"), F.lit(n(kind)).alias("o"))] + [F.struct(F.lit(p).alias("p"), c.cast("string").alias("o")) for p, c in columns.items()]
    return df.select(subject.alias("s"), F.explode(F.array(*pairs)).alias("_x")).select("s", "_x.p", "_x.o").filter("o IS NOT NULL")


# Constraints: each gives (focus, path, message) of what breaks it.

SCHEME = DATA + "scheme/trees"
CAVEATS = ["unresolvedLocation", "timeMismatch", "weakLink", "transplantOrigin"]


def _subject_rules() -> list[tuple[str, str, int, int | None, Column | None, str]]:
    """(class, path, least, most, what each value must be, message if it isn't)."""
    o = F.col("o")
    iri = lambda kind: safe_iri(o) & o.startswith(DATA + kind + "/")
    date = F.try_to_date(o, "yyyy-MM-dd").isNotNull()
    return [
        ("Intervention", n("locatedAt"), 1, None, None, ""),
        ("Intervention", AVAILABLE, 1, 1, date, "must be a date"),
        ("AuditLink", n("coversIntervention"), 1, None, iri("intervention"), "must be an intervention"),
        ("Felling", n("felledTree"), 1, None, iri("tree"), "must be a tree"),
        ("Felling", n("felledOn"), 1, None, date, "must be a date"),
        ("Observation", n("includesFelling"), 1, None, iri("felling"), "must be a felling"),
        ("CoveragePeriod", OF, 1, None, None, ""),
        ("CoveragePeriod", FROM, 1, None, None, ""),
        ("CoveragePeriod", n("evidence"), 1, None, None, ""),
        ("CoveragePeriod", n("confidence"), 0, None, o.try_cast("decimal(6,3)").between(0, 1), "must be within [0, 1]"),
        ("CoveragePeriod", n("granularity"), 0, None, o.isin([n(g) for g in ("address", "postcode", "buurt")]), "unknown granularity"),
    ]


CLASSES = ["Intervention", "AuditLink", "Felling", "Observation", "CoveragePeriod", "Place"]


def _classes() -> list[Column]:
    """How often a subject is of each class of the model: plain counts, which a hash aggregate keeps; sets would be sorted in memory."""
    return [F.count_if((F.col("p") == TYPE) & (F.col("o") == n(k))).alias(f"is{k}") for k in CLASSES]


def _subjects(quads: DataFrame) -> DataFrame:
    """By subject: its classes, and for each rule how many values there are and how many are wrong.

    One pass for all rules, summed up before the shuffle.
    """
    counts = []
    for k, (_, path, _, _, fits, _) in enumerate(_subject_rules()):
        counts.append(F.count_if(F.col("p") == path).alias(f"n{k}"))
        counts.append((F.count_if((F.col("p") == path) & ~F.coalesce(fits, F.lit(False))) if fits is not None else F.lit(0)).alias(f"bad{k}"))
    period = [F.count_if(F.col("p") == n(x)).alias(x) for x in ("linksObservation", "noSourceFound")]
    true = F.count_if((F.col("p") == n("noSourceFound")) & (F.col("o") == "true")).alias("no_source_true")
    return quads.select("s", "p", "o").distinct().groupBy("s").agg(
        *_classes(), *counts, *period, true
    )


def subject_violations(quads: DataFrame) -> DataFrame:
    """Cardinalities, value rules, and a coverage period's two forms: with observation and confidence, or without source."""
    found = []
    told = lambda path, message: F.struct(F.lit(path).alias("path"), F.lit(message).alias("message"))
    none = F.array().cast("array<struct<path:string,message:string>>")
    confidence = None
    for k, (kind, path, least, most, _, message) in enumerate(_subject_rules()):
        own = F.col(f"is{kind}") > 0
        broken = (F.col(f"n{k}") < least) | (F.lit(False) if most is None else F.col(f"n{k}") > most)
        found.append(F.when(own & broken, F.array(told(path, f"{kind} needs {least} to {'any' if most is None else most}"))).otherwise(none))
        found.append(F.when(own, F.array_repeat(told(path, message), F.col(f"bad{k}").cast("int"))).otherwise(none))
        confidence = F.col(f"n{k}") if path == n("confidence") else confidence
    matched = (F.col("linksObservation") > 0) & (confidence > 0) & (F.col("noSourceFound") == 0)
    without = (F.col("no_source_true") > 0) & (F.col("linksObservation") == 0) & (confidence == 0)
    one_form = F.when((F.col("isCoveragePeriod") > 0) & (matched == without), F.array(told(n("linksObservation"), "neither or both of matched and without source")))
    each = F.explode(F.flatten(F.array(*found, F.coalesce(one_form, none))))
    return _subjects(quads).select(F.col("s").alias("focus"), each.alias("v")).select("focus", "v.path", "v.message")


def value_violations(quads: DataFrame) -> DataFrame:
    """Values that must be of a class, or concepts of the scheme."""
    of = {n("locatedAt"): ("Intervention", "Place"), OF: ("CoveragePeriod", "AuditLink"), n("linksObservation"): ("CoveragePeriod", "Observation")}
    coded = [n(p) for p in ("activity", "species", "status")]
    edges = quads.filter(F.col("p").isin([*of, *coded])).select("s", "p", "o").distinct()
    kinds = quads.filter((F.col("p") == TYPE) | (F.col("p") == "skos:inScheme")).groupBy("s").agg(*_classes(), F.max((F.col("p") == "skos:inScheme") & (F.col("o") == SCHEME)).alias("concept"))
    subject = kinds.select("s", *[F.col(f"is{k}").alias(f"own{k}") for k in CLASSES])
    value = kinds.select(F.col("s").alias("o"), *[f"is{k}" for k in CLASSES], "concept")
    j = edges.join(value, "o", "left").join(subject, "s", "left")
    message = F.when(F.col("p").isin(coded) & ~F.coalesce("concept", F.lit(False)), "values must be concepts of the scheme")
    for path, (kind, target) in of.items():
        wrong = (F.col("p") == path) & (F.col(f"own{kind}") > 0) & ~F.coalesce(F.col(f"is{target}") > 0, F.lit(False))
        message = message.when(wrong, f"values must be {target}")
    return j.select(F.col("s").alias("focus"), F.col("p").alias("path"), message.alias("message")).filter("message IS NOT NULL")


def edge_violations(quads: DataFrame, annotations: DataFrame, path: str, allowed: list[str]) -> DataFrame:
    """An annotated edge needs a confidence in [0, 1], a caveat where it is below 1, and only controlled caveats."""
    edges = quads.filter(F.col("p") == path).select("s", "o").distinct()
    value = F.when(F.col("ap") == n("confidence"), F.col("av").try_cast("decimal(6,3)"))
    caveat = F.col("ap") == n("caveat")
    notes = annotations.filter(F.col("p") == path).groupBy("s", "o").agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(caveat).alias("caveats"), F.count_if(caveat & ~F.col("av").isin([n(a) for a in allowed])).alias("strange")
    )
    rules = [(F.col("low").isNull(), "no confidence"), ((F.col("low") < 0) | (F.col("high") > 1), "confidence out of range"), ((F.col("low") < 1) & (F.col("caveats") == 0), "inexact without caveat"), (F.col("strange") > 0, "unknown caveat")]
    found = F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in rules]))
    return edges.join(notes, ["s", "o"], "left").select(F.col("s").alias("focus"), F.lit(path).alias("path"), F.explode(found).alias("message"))


def shape_violations(quads: DataFrame, annotations: DataFrame) -> DataFrame:
    """Every constraint of the model at once."""
    return subject_violations(quads).unionByName(value_violations(quads)).unionByName(edge_violations(quads, annotations, n("locatedAt"), CAVEATS))


def require_none(violations: DataFrame, what: str) -> None:
    """The gate: fails with a few examples, before anything is written."""
    found = violations.limit(20).collect()
    if found:
        raise ValueError(f"{what}: " + "; ".join(str(tuple(r)) for r in found))


def closure(spark, edges: DataFrame) -> DataFrame:
    """(child, ancestor, depth): the shortest way up over edges(child, parent).

    Each round goes one step further from the pairs that were new in the last one and
    leaves out those already known, so cycles end; a node on a cycle is its own
    ancestor. Rounds are written, and stop when nothing new is found.
    """
    steps = written(edges.select("child", "parent").filter("child IS NOT NULL AND parent IS NOT NULL").distinct(), "edges")
    known = fresh = steps.select("child", F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("depth"))
    while True:
        further = fresh.join(steps.select(F.col("child").alias("ancestor"), F.col("parent").alias("_up")), "ancestor").select("child", F.col("_up").alias("ancestor"), (F.col("depth") + 1).alias("depth")).distinct()
        fresh = written(further.join(known, ["child", "ancestor"], "left_anti"), "closure")
        if fresh.isEmpty():
            return known
        known = known.unionByName(fresh)


def upsert_run(spark, live: DataFrame, live_notes: DataFrame, staged: DataFrame, staged_notes: DataFrame, at: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole load: gate, classify, close priors and append the delta. Gives quads, annotations and states."""
    require_none(unsafe(staged).select("s", "p", "o"), "unsafe identifiers")
    current = live.filter(F.col("graph").startswith(RUNS))
    states = classify(signatures(staged, staged_notes), signatures(current, live_notes))
    states = written(states, "states")
    graph = run_graph(at)
    fresh = states.filter("state IN ('new', 'changed')").select("s")
    anchors = staged.filter(F.col("p") == OF).select("s", F.col("o").alias("anchor"))
    starts = staged.filter(F.col("p") == FROM).select("s", F.col("o").alias("valid_from"))
    series = anchors.join(starts, "s").join(fresh, "s", "left_semi")
    stamps = staged_notes.filter(F.col("ap") == FROM).join(states.filter("state = 'changed'"), "s", "left_semi").groupBy("s").agg(F.min("av").alias("valid_from"))
    added = delta(staged, states, graph)
    quads = live.unionByName(close_series(current, series)).unionByName(added)
    if not added.isEmpty():
        rows = spark.range(1).select(F.explode(provenance(graph, at)).alias("r")).select("r.*")
        quads = quads.unionByName(rows)
    noted = staged_notes.join(fresh, "s", "left_semi").withColumn("graph", graph).select(live_notes.columns)
    notes = live_notes.unionByName(close_annotations(live_notes, stamps)).unionByName(noted)
    require_none(open_violations(quads.filter(F.col("graph").startswith(RUNS))), "more or less than one open version")
    return quads, notes, states


def drop_runs(quads: DataFrame) -> DataFrame:
    """A reset: every run's graph and the record of runs go, the model stays."""
    return quads.filter(~F.col("graph").startswith(RUNS) & (F.col("graph") != "run:_provenance"))


def starts_of(staged: DataFrame, staged_notes: DataFrame, changed: DataFrame) -> DataFrame:
    """(s, valid_from) of changed subjects, from their node or an annotated edge; a missing one fails."""
    nodes = staged.filter(F.col("p") == FROM).select("s", F.col("o").alias("v"))
    edges = staged_notes.filter(F.col("ap") == FROM).select("s", F.col("av").alias("v"))
    found = changed.select("s").distinct().join(nodes.unionByName(edges).groupBy("s").agg(F.min("v").alias("valid_from")), "s", "left")
    require_none(found.filter("valid_from IS NULL"), "no validFrom")
    return found


def match(quads: DataFrame, patterns: list[tuple[str, str, str]]) -> DataFrame:
    """Bindings of a basic graph pattern: ?names are variables, joined where they recur; others are constants."""
    out = None
    for pattern in patterns:
        part, own = quads, {}
        for column, term in zip(("s", "p", "o"), pattern, strict=True):
            if not term.startswith("?"):
                part = part.filter(F.col(column) == term)
            elif term[1:] in own:
                part = part.filter(F.col(column) == F.col(own[term[1:]]))
            else:
                own[term[1:]] = column
        part = part.select(*[F.col(c).alias(v) for v, c in own.items()]).distinct()
        shared = [v for v in own if out is not None and v in out.columns]
        if out is not None and not shared:
            raise ValueError(f"pattern shares no variable with those before it: {pattern}")
        out = part if out is None else out.join(part, shared)
    return out
