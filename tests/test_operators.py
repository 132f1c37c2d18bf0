"""Audit, resolution, reconciliation and selection against the domain's golden cases."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from canopy.functions import spatial
from canopy.operators import audit, dedup, merge, resolve


@pytest.mark.parametrize("tier, dist, lag, registry, permit, contenders, cents, caveats", [
    ("buurt", None, 400, 1, None, 1, 70, ["countUnknown"]), ("buurt", None, 730, 1, None, 1, 70, ["countUnknown"]), ("buurt", None, 731, 1, None, 1, 60, ["countUnknown"]), ("buurt", None, 1095, 1, None, 1, 60, ["countUnknown"]),
    ("buurt", None, 400, 1, None, 2, 62, ["countUnknown"]), ("buurt", None, 400, 1, None, 6, 50, ["countUnknown", "weakLink"]), ("buurt", None, 400, 1, None, 10, 50, ["countUnknown", "weakLink"]),
    ("buurt", None, 1095, 1, None, 5, 43, ["countUnknown", "weakLink"]), ("address", 1.0, 400, 3, 3, 1, 100, []), ("buurt", None, 1095, 1, 100, 50, 30, ["weakLink"]),
    ("address", 50.0, 1096, 9, 10, 1, 100, []), ("address", 200.0, 400, 1, None, 1, 90, ["countUnknown"]), ("postcode", 10.0, 400, 1, None, 1, 90, ["countUnknown"]), ("address", 201.0, 400, 1, None, 1, 70, ["countUnknown"]),
])
def test_scores(spark, tier, dist, lag, registry, permit, contenders, cents, caveats):
    row = spark.createDataFrame([(tier, dist, lag, contenders, registry, permit)], "tier string, dist double, lag int, contenders int, registry int, permit int")
    c = audit.score_cents(*[F.col(x) for x in row.columns])
    got = row.select(c.alias("c"), audit.caveats(c, F.col("permit")).alias("v")).first()
    assert (got.c, got.v) == (cents, caveats)


PERMITS = [
    ("Z-STRONG", date(2022, 1, 1), "S", "address", 121500.0, 487400.0), ("Z-CONTEND-1", date(2021, 1, 1), "C", "buurt", None, None), ("Z-CONTEND-2", date(2021, 1, 1), "C", "buurt", None, None),
    ("Z-CONTEST-A", date(2022, 1, 1), "T", "address", 135000.0, 480500.0), ("Z-CONTEST-B", date(2022, 1, 1), "T", "buurt", None, None), ("Z-MULTI", date(2022, 1, 1), "M", "address", 150000.0, 490000.0),
    ("Z-CROSS", date(2022, 1, 1), "X", "address", 160000.0, 495000.0), ("Z-NONE", date(2022, 1, 1), "N", "address", 108000.0, 500000.0),
]
FELLINGS = [
    ("f1", datetime(2022, 6, 1), "S", 121530.0, 487400.0), ("f2", datetime(2023, 6, 1), "C", 1.0, 1.0), ("f3", datetime(2022, 6, 1), "T", 135010.0, 480510.0), ("m1", datetime(2022, 6, 1), "M", 150010.0, 490000.0),
    ("m2", datetime(2022, 6, 1), "M", 150020.0, 490000.0), ("m3", datetime(2022, 6, 1), "M", 150000.0, 490030.0), ("m4", datetime(2022, 6, 1), "M", 150250.0, 490000.0), ("x1", datetime(2022, 6, 1), "Y", 160150.0, 495000.0),
    ("late", datetime(2026, 1, 1), "N", 108000.0, 500000.0), ("edge", datetime(2025, 1, 1, 0, 0, 1), "N", 108000.0, 500000.0),
]


@pytest.mark.parametrize("parts", [1, 5])
def test_coverage(spark, parts):
    permits = spark.createDataFrame(PERMITS[:: 1 if parts == 1 else -1], "zaak string, pub date, area string, tier string, x double, y double").repartition(parts)
    fellings = spark.createDataFrame(FELLINGS, "felling string, felled timestamp_ntz, area string, x double, y double").repartition(parts)
    pairs = audit.candidate_pairs(permits, fellings)
    assert pairs.count() == pairs.select("zaak", "felling").distinct().count()
    got = {r.zaak: r for r in audit.outcomes(permits, pairs).collect()}
    brief = {z: (r.matched, r.cents, r.granularity, r.fellings, r.caveats) for z, r in got.items()}
    assert brief == {
        "Z-STRONG": (True, 100, "address", ["f1"], ["countUnknown"]), "Z-CONTEND-1": (True, 52, "buurt", ["f2"], ["countUnknown", "weakLink"]), "Z-CONTEND-2": (False, None, None, [], []),
        "Z-CONTEST-A": (True, 100, "address", ["f3"], ["countUnknown"]), "Z-CONTEST-B": (False, None, None, [], []), "Z-MULTI": (True, 100, "address", ["m1", "m2", "m3", "m4"], ["countUnknown"]),
        "Z-CROSS": (True, 90, "postcode", ["x1"], ["countUnknown"]), "Z-NONE": (False, None, None, [], []),
    }
    assert (got["Z-CONTEND-2"].candidate_count, got["Z-NONE"].candidate_count) == (1, 0)
    assert got["Z-CROSS"].nearest_dist == 150.0


def test_keys(spark):
    row = spark.range(1).select(
        audit.felling_set_key(F.array(F.lit("b"), F.lit("a"))).alias("k1"), audit.felling_set_key(F.array(F.lit("a"), F.lit("b"))).alias("k2"),
        audit.content_key(F.lit(True), F.lit("o"), F.lit(70), F.lit("buurt"), F.array(F.lit("weakLink"), F.lit("countUnknown"))).alias("c1"), audit.content_key(F.lit(True), F.lit("o"), F.lit(70), F.lit("buurt"), F.array(F.lit("countUnknown"), F.lit("weakLink"))).alias("c2"),
        audit.content_key(F.lit(True), F.lit("o"), F.lit(71), F.lit("buurt"), F.array(F.lit("countUnknown"), F.lit("weakLink"))).alias("c3"),
        audit.controlled_caveats(F.lit(90), F.array(F.lit("countUnknown"))).alias("v1"), audit.controlled_caveats(F.lit(100), F.array(F.lit("weakLink"))).alias("v2"), audit.controlled_caveats(F.lit(50), F.array(F.lit("weakLink"), F.lit("x"))).alias("v3"),
    ).first()
    assert row.k1 == row.k2 and len(row.k1) == 16 and row.c1 == row.c2 != row.c3
    assert (row.v1, row.v2, row.v3) == (["unresolvedLocation"], [], ["weakLink"])


def registry(spark):
    streets = spark.createDataFrame([("s1", "Teststraat"), ("s2", "Kadeweg")], "ident string, naam string")
    n = [("num-1", "1000AB", 1, "s1", date(2010, 1, 1), None), ("num-4", "1000AE", 4, "s1", date(2010, 1, 1), None), ("num-2", "1000AC", 2, "s1", date(2010, 1, 1), date(2012, 1, 1)), ("tie-num-b", "1099TT", 50, "s2", date(2010, 1, 1), None), ("tie-num-a", "1099TT", 50, "s2", date(2010, 1, 1), None), ("tie-num-0", "1099TT", 50, "s2", date(2010, 1, 1), date(2011, 1, 1))]
    numbers = spark.createDataFrame(n, "ident string, postcode string, huisnummer int, street string, begin date, end date")
    objects = spark.createDataFrame([("num-1", 121000.0, 487000.0), ("num-4", 121030.0, 487030.0), ("num-2", 1.0, 1.0), ("tie-num-b", 2.0, 2.0), ("tie-num-a", 3.0, 3.0), ("tie-num-0", 4.0, 4.0)], "number string, x double, y double")
    box = lambda x, y, n: spatial.rectangle(F.lit(x), F.lit(y), F.lit(x + n), F.lit(y + n))
    a = [("buurt-noord", box(120000, 486000, 2000)), ("tie-buurt-b", box(139000, 499000, 2000)), ("tie-buurt-a", box(139000, 499000, 2000))]
    areas = spark.createDataFrame([(0,)], "z int")
    out = None
    for name, poly in a:
        part = areas.select(F.lit(name).alias("area"), poly.alias("polygon"))
        out = part if out is None else out.unionByName(part)
    return streets, numbers, objects, out


@pytest.mark.parametrize("parts", [1, 4])
def test_resolver(spark, parts):
    at = date(2024, 6, 1)
    q = [(1, "1000AB", 1, None, at, None, None), (2, None, 4, "TESTSTRAAT", at, None, None), (3, "1000AB", 999, None, at, None, None), (4, None, None, None, at, 120900.0, 486900.0), (5, "1000AC", 2, None, at, None, None), (6, "9999ZZ", 1, None, at, None, None), (7, "1099TT", 50, None, at, None, None), (8, None, None, None, at, 140000.0, 500000.0), (9, None, 4, "Testsraat", at, None, None), (10, None, None, None, at, 121000.0, 487000.0)]
    requests = spark.createDataFrame(q, "id int, postcode string, huisnummer int, street string, at date, x double, y double").repartition(parts)
    streets, numbers, objects, areas = registry(spark)
    got = {r.id: r for r in resolve.resolve(requests, streets, numbers.repartition(parts), objects, areas).collect()}
    brief = {k: (r.level, r.via, r.ident, r.area, r.cents, r.time_match, r.caveats) for k, r in got.items()}
    ok = ("valid_at_date", [])
    assert brief == {
        1: ("address", "postcode_number", "num-1", None, 90, *ok), 2: ("address", "street", "num-4", None, 90, *ok), 3: ("postcode", None, None, None, 70, None, []),
        4: ("buurt", None, None, "buurt-noord", 50, None, ["unresolvedLocation"]), 5: ("address", "postcode_number", "num-2", None, 90, "any_time", ["timeMismatch"]), 6: (None, None, None, None, None, None, []),
        7: ("address", "postcode_number", "tie-num-a", None, 90, *ok), 8: ("buurt", None, None, "tie-buurt-a", 50, None, ["unresolvedLocation"]), 9: ("address", "fuzzy", "num-4", None, 90, *ok), 10: ("buurt", None, None, "buurt-noord", 50, None, ["unresolvedLocation"]),
    }
    assert (got[1].ax, got[1].ay) == (121000.0, 487000.0)


def test_merge_policies(spark):
    old, now = datetime(2024, 1, 1), F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    t = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", old), (4, "d", old)], "id int, raw string, source_deleted_at timestamp_ntz")
    s = spark.createDataFrame([(1, "A"), (3, "C"), (5, "e")], "id int, raw string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    new = datetime(2024, 6, 1)
    first = merge.keep_first_load(t, s, ["id"], now)
    assert rows(first) == [(1, "a", None), (2, "b", new), (3, "c", None), (4, "d", old), (5, "e", None)]
    assert rows(merge.keep_first_load(first, s, ["id"], F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))) == rows(first)
    kept = t.withColumn("via", F.concat(F.lit("v"), "id"))
    assert rows(merge.refresh(kept, s, ["id"], "raw", ["via"], now)) == [(1, "A", "v1", None), (2, "b", "v2", new), (3, "C", "v3", None), (4, "d", "v4", old), (5, "e", None, None)]
    loaded = t.select("id", "raw", F.lit(old).cast("timestamp_ntz").alias("loaded_at"))
    again = s.unionByName(spark.createDataFrame([(2, "b")], "id int, raw string"))
    assert rows(merge.upsert(loaded, again, ["id"], "loaded_at", now)) == [(1, "A", new), (2, "b", old), (3, "C", new), (4, "d", old), (5, "e", new)]
    runs = merge.upsert_metrics(t.select("id", "raw", F.lit("r1").alias("run_id")), again.withColumn("run_id", F.lit("r2")), ["id"])
    assert rows(runs) == [(1, "A", "r2"), (2, "b", "r1"), (3, "C", "r2"), (4, "d", "r1"), (5, "e", "r2")]


def test_decisions(spark):
    d = lambda n: date(2022, 1, n)
    p = [("b2", "Z1", "besluit", d(5)), ("b1", "Z1", "besluit", d(5)), ("o9", "Z1", "ontwerpbesluit", d(9)), ("a1", "Z2", "aanvraag", d(1)), ("o1", "Z3", "ontwerpbesluit", d(1)), ("o2", "Z3", "ontwerpbesluit", d(2)), ("k", "", "besluit", d(1)), ("k2", None, "besluit", d(1))]
    got = {r.zaaknummer: (r.decision, r.pending) for r in dedup.audited_decisions(spark.createDataFrame(p, "id string, zaaknummer string, kind string, available date")).collect()}
    assert got == {"Z1": ("b1", False), "Z2": (None, True), "Z3": ("o2", False)}


def test_fallback(spark):
    rows = spark.createDataFrame([(1, "t1", "t2"), (2, "", "t2"), (3, "no", "t2"), (4, None, "no"), (5, "", "")], "id int, a string, b string")
    master = spark.createDataFrame([("t1", 1.0, 1.0), ("t2", 2.0, 2.0), ("", 9.0, 9.0)], "tree string, x double, y double")
    assert sorted((r.id, r.via, r.x) for r in resolve.fallback(rows, master, "a", "b").collect()) == [(1, "a", 1.0), (2, "b", 2.0), (3, "b", 2.0), (4, "unresolved", None), (5, "unresolved", None)]


def test_placement_and_reference(spark):
    _, _, _, areas = registry(spark)
    areas = areas.withColumn("code", F.when(F.col("area") == "buurt-noord", "N01").otherwise("A01"))
    resolved = spark.createDataFrame([(1, "address", 121000.0, 487000.0, None), (2, "postcode", None, None, None), (3, "postcode", None, None, None), (4, "buurt", None, None, "tie-buurt-a"), (5, None, None, None, None)], "id int, level string, ax double, ay double, area string")
    requests = spark.createDataFrame([(1, 1.0, 1.0), (2, 140000.0, 500000.0), (3, None, None), (4, 1.0, 1.0), (5, 121000.0, 487000.0)], "id int, x double, y double")
    got = {r.id: (r.placed, r.unresolved, r.in_scope) for r in resolve.placement(resolved, requests, areas).collect()}
    assert got == {1: ("buurt-noord", False, True), 2: ("tie-buurt-a", False, False), 3: (None, True, False), 4: ("tie-buurt-a", False, False), 5: (None, True, False)}
    with pytest.raises(ValueError, match="empty"):
        resolve.require_reference({"streets": requests.limit(0), "x": requests})


def test_mentions_operators(spark):
    from canopy.operators import mentions

    texts = spark.createDataFrame([(1, "De Zomer eik, zomereik en ZOMER-EIK"), (2, ""), (3, None)], "id int, text string")
    forms = spark.createDataFrame([("zomer eik", "c1"), ("Zomereik", "c1"), ("en", "c2")], "form string, concept string")
    assert sorted(map(tuple, mentions.phrase_matches(texts, forms, 2).collect())) == [(1, 1, 2, "c1"), (1, 3, 1, "c1"), (1, 4, 1, "c2"), (1, 5, 2, "c1")]
    rows = spark.createDataFrame([(1, 0, None, "boom", None, True), (1, 1, "kappen", None, None, False), (1, 2, None, "bomen", 3, False), (1, 3, None, "boom", None, True), (1, 4, None, "bomen", None, False)], "id int, at int, activity string, noun string, number int, singular boolean")
    assert sorted((r["at"], r.activity, r.number) for r in mentions.bind_left(rows, "id", ["at"]).collect()) == [(0, None, 1), (2, "kappen", 3), (3, "kappen", 1), (4, "kappen", None)]


def test_unique_interventions(spark):
    rows = spark.createDataFrame([("a", date(2022, 2, 1)), ("a", date(2022, 1, 1)), ("", date(2022, 1, 1)), (None, None)], "iri string, pub date")
    unique, skipped = dedup.unique_interventions(rows)
    assert [tuple(r) for r in unique.collect()] == [("a", date(2022, 1, 1))] and skipped.first().skipped == 2


def test_similar_names_by_brute_force(spark):
    import random

    rng = random.Random(3)
    words = ["straat", "van", "laan", "kade", "plein", "noord", "zuid", "eik", "els"]
    names = [" ".join(rng.choice(words) + rng.choice(["", "", "s", "e"]) for _ in range(rng.randrange(1, 4))) for _ in range(60)] + ["", "straat", "x"]
    streets = [n[:-1] + rng.choice("abc") if rng.random() < 0.5 else n for n in names]

    def grams(t):
        import re

        return {f"  {w} "[i : i + 3] for w in re.split(r"[^\w]+", t.lower()) if w for i in range(len(w) + 1)}

    for least in (0.3, 0.55, 0.9):
        want = {(a, b): len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for a in set(names) for b in set(streets) if grams(a) | grams(b)}
        want = {k: v for k, v in want.items() if v > least}
        got = resolve.similar_streets(spark.createDataFrame([(n,) for n in [*names, None]], "wanted string"), spark.createDataFrame([(n,) for n in [*streets, None]], "naam string"), least).collect()
        assert len(got) == len(want) and all(abs(want[(r.wanted, r.naam)] - r.sim) < 1e-9 for r in got)


def test_nearest_of(spark):
    hits = spark.createDataFrame([(1, "b", 0.0, 3.0, True), (1, "a", 0.0, 3.0, True), (1, "c", 0.0, 1.0, False), (2, "z", None, None, True)], "id int, ident string, ax double, ay double, valid boolean").withColumn("x", F.lit(0.0)).withColumn("y", F.lit(0.0))
    assert sorted((r.id, r.ident, r.dist, r.valid) for r in resolve.nearest_of(hits, "id", "x", "y").collect()) == [(1, "a", 3.0, True), (2, "z", None, True)]


def test_landed_versions_over_buckets(spark):
    rows = [("a", f"{d}{k}", "xxyyxzzx"[(d * 3 + k) % 8], k) for d in range(4) for k in range(5)] + [("b", "00", "x", 0)]
    df = spark.createDataFrame(rows, "name string, version string, sha string, tie int")
    got = {r.name: (r.landed, r.latest, r.sha) for r in dedup.landed_versions(df, "name", "version", "sha", "tie", F.substring("version", 1, 1)).collect()}
    seen = [sha for _, sha in sorted((v, s) for n, v, s, _ in rows if n == "a")]
    assert got == {"a": (1 + sum(x != y for x, y in zip(seen, seen[1:])), "34", seen[-1]), "b": (1, "00", "x")}
