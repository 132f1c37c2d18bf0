"""Versioned graph facts: runs, closing, invariants and the constraint gate."""

import pytest
from pyspark.sql import functions as F

from canopy.operators import graph as g

Q, A = "graph string, s string, p string, o string", "graph string, s string, p string, o string, ap string, av string"
D, N = g.DATA, g.NS


def at(text):
    return F.lit(text).cast("timestamp")


def period(case, key, start, graph="stage"):
    a, s = f"{D}auditlink/{case}", f"{D}auditlink/{case}/{key}"
    return [(graph, a, g.TYPE, N + "AuditLink"), (graph, a, N + "coversIntervention", f"{D}intervention/{case}"), (graph, s, g.TYPE, N + "CoveragePeriod"), (graph, s, g.OF, a), (graph, s, g.FROM, start), (graph, s, N + "noSourceFound", "true"), (graph, s, N + "evidence", "none")]


def run(spark, live, notes, staged, staged_notes, when):
    quads, annotations, states = g.upsert_run(spark, spark.createDataFrame(live, Q), spark.createDataFrame(notes, A), spark.createDataFrame(staged, Q), spark.createDataFrame(staged_notes, A), at(when))
    return [tuple(r) for r in quads.collect()], [tuple(r) for r in annotations.collect()], {r.s: r.state for r in states.collect()}


def test_versions_of_a_period(spark):
    first, notes, states = run(spark, [], [], period("Z", "k1", "2024-01-01"), [], "2024-01-01 00:00:00")
    assert set(states.values()) == {"new"} and {q[0] for q in first} == {"run:load-20240101T000000Z", "run:_provenance"}
    again, _, states = run(spark, first, notes, period("Z", "k1", "2024-01-02"), [], "2024-01-02 00:00:00")
    assert set(states.values()) == {"unchanged"} and sorted(again) == sorted(first)
    moved, _, states = run(spark, first, notes, period("Z", "k2", "2024-02-01"), [], "2024-02-01 00:00:00")
    assert states[f"{D}auditlink/Z/k2"] == "new" and states[f"{D}auditlink/Z"] == "unchanged"
    assert ("run:load-20240101T000000Z", f"{D}auditlink/Z/k1", g.TO, "2024-02-01") in moved
    # The same content opens again in a new graph although an older one holds a closed copy.
    back, _, states = run(spark, moved, notes, period("Z", "k1", "2024-03-01"), [], "2024-03-01 00:00:00")
    assert states[f"{D}auditlink/Z/k1"] == "new" and ("run:load-20240201T000000Z", f"{D}auditlink/Z/k2", g.TO, "2024-03-01") in back


def place(active, start, label="Noord", graph="stage"):
    s = f"{D}place/1"
    return [(graph, s, g.TYPE, N + "Place"), (graph, s, g.LABEL, label), (graph, s, N + "active", active)], [(graph, s, N + "active", active, g.FROM, start)]


def test_annotated_edges(spark):
    q, a = place("true", "2024-01-01")
    live, notes, _ = run(spark, [], [], q, a, "2024-01-01 00:00:00")
    q, a = place("false", "2024-02-01")
    live2, notes2, states = run(spark, live, notes, q, a, "2024-02-01 00:00:00")
    assert states[f"{D}place/1"] == "changed"
    assert ("run:load-20240101T000000Z", f"{D}place/1", N + "active", "true", g.TO, "2024-02-01") in notes2


def test_immutable_conflict_is_kept_out(spark):
    live, notes, _ = run(spark, [], [], [("stage", f"{D}tree/1", g.TYPE, N + "Tree")], [], "2024-01-01 00:00:00")
    after, _, states = run(spark, live, notes, [("stage", f"{D}tree/1", g.TYPE, N + "Tree"), ("stage", f"{D}tree/1", g.LABEL, "x")], [], "2024-02-01 00:00:00")
    assert states == {f"{D}tree/1": "immutableConflict"} and sorted(after) == sorted(live)


def test_gates(spark):
    with pytest.raises(ValueError, match="unsafe"):
        run(spark, [], [], [("stage", f"{D}x> DROP", g.TYPE, "y")], [], "2024-01-01 00:00:00")
    two = period("Z", "k1", "2024-01-01") + period("Z", "k2", "2024-01-01")
    with pytest.raises(ValueError, match="open version"):
        run(spark, [], [], two, [], "2024-01-01 00:00:00")


def test_shapes(spark):
    i, p = f"{D}intervention/1", f"{D}place/1"
    good = [("g", i, g.TYPE, N + "Intervention"), ("g", i, g.AVAILABLE, "2024-01-01"), ("g", i, N + "locatedAt", p), ("g", i, N + "activity", "act:vellen"), ("g", p, g.TYPE, N + "Place"), ("g", "act:vellen", "skos:inScheme", D + "scheme/trees"), *period("Z", "k", "2024-01-01", "g"),
            ("g", f"{D}felling/1", g.TYPE, N + "Felling"), ("g", f"{D}felling/1", N + "felledTree", f"{D}tree/1"), ("g", f"{D}felling/1", N + "felledOn", "2024-01-01")]
    notes = [("g", i, N + "locatedAt", p, N + "confidence", "0.9"), ("g", i, N + "locatedAt", p, N + "caveat", N + "weakLink")]

    def broken(quads, annotations=notes):
        return sorted((r.path.removeprefix(N), r.message) for r in g.shape_violations(spark.createDataFrame(quads, Q), spark.createDataFrame(annotations, A)).collect())

    assert broken(good) == []
    assert broken(good, notes[:1]) == [("locatedAt", "inexact without caveat")]
    assert broken(good, [("g", i, N + "locatedAt", p, N + "caveat", N + "countUnknown")]) == [("locatedAt", "no confidence"), ("locatedAt", "unknown caveat")]
    assert broken([q for q in good if q[3] != p]) == [("locatedAt", "Intervention needs 1 to any")]
    assert broken([*good, ("g", i, g.AVAILABLE, "soon")]) == [("dct:available", "Intervention needs 1 to 1"), ("dct:available", "must be a date")]
    assert broken([q for q in good if q[1] != "act:vellen"]) == [("activity", "values must be concepts of the scheme")]
    both = [*good, ("g", f"{D}auditlink/Z/k", N + "confidence", "0.5")]
    assert broken(both) == [("linksObservation", "neither or both of matched and without source")]
    assert broken([q for q in good if q[2] != N + "felledTree"]) == [("felledTree", "Felling needs 1 to any")]


def test_closure(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "c")], "child string, parent string")
    assert sorted((r.child, r.ancestor, r.depth) for r in g.closure(spark, edges).collect()) == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1), ("x", "c", 1)]


def test_closure_of_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("x", "b"), ("y", "y"), (None, "a"), ("a", "b")], "child string, parent string")
    got = {(r.child, r.ancestor): r.depth for r in g.closure(spark, edges).collect()}
    assert got == {("a", "b"): 1, ("a", "c"): 2, ("a", "a"): 3, ("b", "c"): 1, ("b", "a"): 2, ("b", "b"): 3, ("c", "a"): 1, ("c", "b"): 2, ("c", "c"): 3, ("x", "a"): 1, ("x", "b"): 1, ("x", "c"): 2, ("y", "y"): 1}
    assert g.closure(spark, edges.limit(0)).collect() == []


def test_patterns_starts_and_reset(spark):
    quads = spark.createDataFrame([("m", "a", "knows", "b"), ("m", "b", "knows", "c"), ("m", "b", "age", "3"), ("run:load-1", "c", "knows", "c"), ("run:_provenance", "run:load-1", "x", "y")], Q)
    assert sorted(map(tuple, g.match(quads, [("?x", "knows", "?y"), ("?y", "age", "?n")]).select("x", "y", "n").collect())) == [("a", "b", "3")]
    assert [r.x for r in g.match(quads, [("?x", "knows", "?x")]).collect()] == ["c"]
    assert {r.graph for r in g.drop_runs(quads).collect()} == {"m"}
    staged = spark.createDataFrame([("s", "n1", g.FROM, "2024-01-01")], Q)
    notes = spark.createDataFrame([("s", "e1", "p", "o", g.FROM, "2024-02-02")], A)
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "s string")
    assert {r.s: r.valid_from for r in g.starts_of(staged, notes, names("n1", "e1")).collect()} == {"n1": "2024-01-01", "e1": "2024-02-02"}
    with pytest.raises(ValueError, match="no validFrom"):
        g.starts_of(staged, notes, names("z"))


def test_version_stream(spark, tmp_path):
    from datetime import datetime

    from canopy.streaming import versions

    folder, store, check = (str(tmp_path / x) for x in ("in", "store", "check"))

    def stage(rows, at):
        spark.createDataFrame([(*r, None, None, at) for r in rows], versions.STAGED).coalesce(1).write.mode("append").parquet(folder)

    stage(period("Z", "k1", "2024-01-01"), datetime(2024, 1, 1))
    quads, _ = versions.version_stream(spark, folder, store, check)
    assert {r.graph for r in quads.collect()} == {"run:load-20240101T000000Z", "run:_provenance"}
    stage(period("Z", "k2", "2024-02-01"), datetime(2024, 2, 1))
    quads, _ = versions.version_stream(spark, folder, store, check)
    again, _ = versions.version_stream(spark, folder, store, check)
    rows = {tuple(r) for r in quads.collect()}
    assert ("run:load-20240101T000000Z", f"{D}auditlink/Z/k1", g.TO, "2024-02-01") in rows and rows == {tuple(r) for r in again.collect()}
