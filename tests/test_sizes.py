"""What must not grow faster than the input: rows between steps, memory of a task, bytes handed on."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from canopy.functions import spatial
from canopy.operators import resolve

DAY = date(2020, 1, 1)


def days(n):
    return None if n is None else DAY + timedelta(n)


def crowd(spark, n, rng):
    """Addresses of few codes and streets, each valid for a while, and requests for them by code, by name and by misspelt name."""
    streets = [("s1", "Lange Kade"), ("s2", "Lange Kadee"), ("s3", "Plein")]
    numbers = [(f"n{k:04}", rng.choice(["1000AA", "1000AB", None]), rng.choice([1, 2, None]), rng.choice(["s1", "s2", "s3", "no"]), rng.choice([None, *range(30)]), rng.choice([None, None, *range(40)])) for k in range(n)]
    asked = [(k, rng.choice(["1000AA", "1000AC", None]), rng.choice([1, 2, None]), rng.choice(["lange KADE", "Lange Kadeee", "Plain", None]), rng.choice([None, *range(-3, 45)])) for k in range(n)]
    dated = lambda rows, at: [(*r[:at], *map(days, r[at:])) for r in rows]
    frames = (
        spark.createDataFrame(dated(asked, 4), "id int, postcode string, huisnummer int, street string, at date").withColumns({"x": F.lit(None).cast("double"), "y": F.lit(None).cast("double")}),
        spark.createDataFrame(streets, "ident string, naam string"), spark.createDataFrame(dated(numbers, 4), "ident string, postcode string, huisnummer int, street string, begin date, end date"),
        spark.createDataFrame([(r[0], float(k), 0.0) for k, r in enumerate(numbers)], "number string, x double, y double"),
        spark.range(1).select(F.lit("a").alias("area"), spatial.rectangle(F.lit(0), F.lit(0), F.lit(1), F.lit(1)).alias("polygon")),
    )
    return frames, streets, numbers, asked


def test_ladder_by_brute_force(spark):
    frames, streets, numbers, asked = crowd(spark, 300, random.Random(5))
    name = {s: n.lower() for s, n in streets}
    holds = lambda a, at: at is not None and a[4] is not None and a[4] <= at and (a[5] is None or a[5] > at)
    sims = {("lange kadeee", "lange kade"): 9 / 13, ("lange kadeee", "lange kadee"): 11 / 12}

    def best(found, at):
        return min((not holds(a, at), a[0]) for a in found) if found else None

    want = {}
    for k, code, number, street, at in asked:
        ask = None if street is None else street.lower()
        tiers = {"postcode_number": [a for a in numbers if code and number and a[1:3] == (code, number)]}
        if ask and number:
            named = [a for a in numbers if a[2] == number and name.get(a[3])]
            tiers["street"] = [a for a in named if name[a[3]] == ask]
            near = max((sims.get((ask, name[a[3]]), 0) for a in named), default=0)
            tiers["fuzzy"] = [a for a in named if near and sims.get((ask, name[a[3]]), 0) == near]
        via = next((v for v, found in tiers.items() if found), None)
        want[k] = (via, *(best(tiers[via], at)[::-1] if via else (None, None)))
    got = {r.id: (r.via, r.ident, None if r.time_match is None else r.time_match == "any_time") for r in resolve.resolve(*frames).collect()}
    assert got == want and {"postcode_number", "street", "fuzzy", None} == {v for v, *_ in got.values()}


def test_a_request_is_paired_with_one_address_a_tier(spark, monkeypatch):
    frames, *_ = crowd(spark, 400, random.Random(6))
    seen, pick = [], resolve._pick
    monkeypatch.setattr(resolve, "_pick", lambda joined, tier, *a: seen.append((tier, joined.count())) or pick(joined, tier, *a))
    resolve.resolve(*frames).count()
    assert {t for t, _ in seen} == {"postcode_number", "street", "fuzzy"} and all(0 < n <= 400 for _, n in seen), seen


def test_hits_are_joined_by_one_key(spark):
    import re

    from canopy.plans.source_queries import nearest_hits

    plan = nearest_hits(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Join \[[^\]]*o_custkey#\d+L?\], \[.*at#", plan), plan


def test_tasks_grow_in_number_not_in_size(spark, tmp_path):
    from canopy.plans import bindings as b
    from canopy.plans import graph_queries

    for name, key, rows in (("customer", "c_custkey", 40000), ("nation", "n_nationkey", 5)):
        columns = ["id AS " + key, *{"customer": ["'x' AS c_mktsegment"], "nation": ["'n' AS n_name"]}[name]]
        spark.range(rows).coalesce(1).selectExpr(*columns).write.parquet(str(tmp_path / f"{name}.parquet"))
    quads = graph_queries._live(spark, str(tmp_path))[0].filter(F.col("s").contains("auditlink"))
    most = quads.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct(F.split("s", "/")[5]).alias("customers")).agg(F.max("customers")).scalar()
    assert spark.range(1).select(most.alias("n")).first().n < 1.2 * b.SPREAD


def test_landed_values_hold_only_the_open_one():
    from canopy.sources.landing import _Values

    values, most = _Values(), 0
    for k in range(2000):
        assert values.add('{"a": "}{", "b": [') == ([] if k == 0 else [f'{{"a": "}}{{", "b": [\n{k - 1}]}}'][:0])
        assert values.add(f'{k}]}} {{"c": [') == [f'{{"a": "}}{{", "b": [\n{k}]}}']
        assert values.add("]}") == ['{"c": [\n]}']
        most = max(most, len(values.text) + sum(map(len, values.lines)))
    assert most < 100 and values.taken(True) == []


def test_pairs_are_reduced_before_they_are_sorted(spark):
    import pyarrow as pa

    from canopy.operators import audit

    rows = [("f1", "z2", 5.0, 90), ("f1", "z1", 5.0, 90), ("f1", "z0", None, 90), ("f2", "z9", None, 70), ("f2", "z8", 1.0, 60), ("f1", "z0", 9.0, 95)]
    batch = pa.RecordBatch.from_pylist([{"zaak": z, "felling": f, "dist": d, "lag": 1, "cents": c} for f, z, d, c in rows])
    led = [(r["felling"], r["zaak"], r["contenders"]) for out in audit._leaders(iter([batch])) for r in out.to_pylist()]
    assert led == [("f1", "z1", 3), ("f2", "z9", 2), ("f1", "z0", 1)]
    scored = spark.createDataFrame([(f, z, "address", d, 1, c) for f, z, d, c in rows], "felling string, zaak string, tier string, dist double, lag int, cents int")
    assert sorted(map(tuple, audit.assign(scored).select("felling", "zaak", "contenders").collect())) == [("f1", "z0", 4), ("f2", "z9", 2)]
