"""Rows that repeat, lack an identifier or bring clashing columns, in every operator that hands rows on."""

import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
import zlib
from pyspark.sql import functions as F

from canopy.llm import decontaminate, exact_dedup, hilbert_shards, quality, simhash

CLASHES = ["__kept_id", "__kept_hash", "__hit_id", "_shard", "__shard", "_slot", "row", "whole", "_whole", "_row", "fp", "doc", "sig", "hash", "text_hash", "keep_id", "kept", "root", "component_id", "_norm", "n", "term", "pos", "perplexity", "threshold", "_rank", "_at", "_part", "key", "first", "size"]


def clashing(docs, texts):
    out = docs(texts)
    for k, name in enumerate(c for c in CLASHES if c not in out.columns):
        out = out.withColumn(name, F.concat(F.lit(f"{k}:"), F.coalesce(F.col("text"), F.lit("-"))))
    return out


def multiset(df):
    return Counter(tuple(r) for r in df.collect())


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


LEAK = "alpha beta gamma delta epsilon zeta eta theta iota"
AWKWARD = [(1, "x"), (1, "x"), (5, "x"), (5, "y y y y"), (None, "x"), (None, None), (None, "z " * 9), (3, ""), (7, f"so {LEAK}"), (None, f"so {LEAK}"), (7, "clean text here"), (8, "x" * 70_000)]


def test_columns_pass_whatever_their_names(spark, docs, tmp_path):
    df = clashing(docs, AWKWARD)
    whole = multiset(df)
    labels = spark.createDataFrame([(5, 1, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    stages = {
        "quality": quality.keep_quality(spark, df, labels),
        "exact": exact_dedup.keep_first(spark, df),
        "near": simhash.keep_representatives(spark, df),
        "leaks": decontaminate.keep_uncontaminated(spark, df, bench(spark, LEAK)),
    }
    for name, kept in stages.items():
        assert kept.columns == df.columns, name
        assert multiset(kept) <= whole, name
    assert multiset(stages["leaks"]) == Counter({r: n for r, n in whole.items() if LEAK not in (r[1] or "")})
    column = hilbert_shards.write_shards(spark, df, str(tmp_path / "shards"), 3)
    assert column not in df.columns
    assert multiset(spark.read.parquet(str(tmp_path / "shards")).select(df.columns)) == whole


def test_near_copies_keep_one_row_a_component(spark, docs):
    out = Counter(map(tuple, simhash.simhash_components(spark, docs(AWKWARD)).select("doc_id", "component_id").collect()))
    assert out[(1, 1)] == 2 and out[(5, 1)] == 1 and out[(5, 5)] == 1 and out[(None, 1)] == 1
    kept = [(r.doc_id, r.text) for r in simhash.keep_representatives(spark, docs(AWKWARD)).collect()]
    assert Counter(kept) == Counter({(1, "x"): 1, (5, "y y y y"): 1, (3, ""): 1, (None, "z " * 9): 1, (7, f"so {LEAK}"): 1, (7, "clean text here"): 1, (8, "x" * 70_000): 1})
    nameless = [(None, "a b c d"), (None, "a b c d"), (None, "e f g h")]
    assert simhash.keep_representatives(spark, docs(nameless)).count() == 2
    assert {r.component_id for r in simhash.simhash_components(spark, docs(nameless)).collect()} == {None}
    assert simhash.keep_representatives(spark, docs([])).collect() == []


def test_leaks_of_rows_without_identifier(spark, docs):
    got = Counter(tuple(r)[:5:2] + (r.n_items,) for r in decontaminate.contamination(spark, docs([*AWKWARD, (7, None)]), bench(spark, LEAK)).collect())
    assert sum(got.values()) == 13 and sum(n for r, n in got.items() if r[1]) == 2
    rows = {(r.doc_id, r.n_words): r.n_hit for r in decontaminate.contamination(spark, docs(AWKWARD), bench(spark, LEAK)).collect()}
    assert rows[(None, 10)] == rows[(7, 10)] == 9 and rows[(7, 3)] == 0


def test_leak_thresholds(spark, docs):
    df = docs([(0, "solo flight"), (1, LEAK), (2, f"{LEAK} solo"), (3, "none")])
    items = bench(spark, LEAK, "solo")
    kept = lambda **k: sorted(r.doc_id for r in decontaminate.keep_uncontaminated(spark, df, items, **k).collect())
    assert kept() == [3] and kept(least_items=2) == [0, 1, 3] and kept(least_words=8) == [0, 3]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_leaks_with_and_without_broadcasts(spark, docs, monkeypatch, broadcast):
    """More wanted terms than buckets, and joins that all shuffle: the same answers, and no document's words in an exchange."""
    from test_text import brute_leaks, prose

    rng = random.Random(6)
    items = [(k, prose(30, rng, 400)) for k in range(40)]
    pairs = [(k, f"{prose(20, rng, 400)} {items[k][1] if k % 3 else ''} {prose(9, rng, 400)}") for k in range(30)]
    monkeypatch.setattr(decontaminate, "BUCKETS", 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        out = decontaminate.contamination(spark, docs(pairs), spark.createDataFrame(items, "item_id long, text string"))
        assert sorted(map(tuple, out.collect())) == brute_leaks(pairs, items)
        index = decontaminate.PositionalIndex(spark, docs(pairs), spark.createDataFrame(items, "item_id long, text string"))
        assert not {"words", "w"} & set(index.postings.columns)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rare_term_before_its_place_in_the_window(spark, docs):
    from test_text import brute_leaks

    items = [(1, "common rare one two three four five six"), (2, "one rarer"), (3, "two three common scarce five six one four")]
    pairs = [(k, t) for k, t in enumerate(["rare one two three four", "rarer", "scarce five", "x scarce", "one rarer", "common " * 5 + "rare one two three four five six", "rare common rare one two three four five six"])]
    for parts in (1, 3):
        out = decontaminate.contamination(spark, docs(pairs).repartition(parts), spark.createDataFrame(items, "item_id long, text string"))
        assert sorted(map(tuple, out.collect())) == brute_leaks(pairs, items)
        assert decontaminate.keep_uncontaminated(spark, docs(pairs).repartition(parts), spark.createDataFrame(items, "item_id long, text string")).count() == 4


def brute_hilbert(pairs, shards, bits=6):
    """Places from plain Python: exact quantiles, hashed categories, the published axes-to-index algorithm."""
    h = lambda t: (x := xxhash.xxh64_intdigest(t.encode(), 42)) - (x >> 63 << 64)
    lang = lambda i: None if not (i or 0) % 3 else "en"  # noqa: E731 - as the fixture makes them
    rows = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), h(t or "")) for i, t in pairs]
    def quantiles(values):
        v = sorted(x for x in values if x is not None)
        return sorted({v[k * len(v) >> bits] for k in range(1, 1 << bits)}) if v else []
    sizes, ids = quantiles(r[1] for r in rows), quantiles(r[0] for r in rows)
    lead = {}
    for r in rows:
        if r[1:] not in lead or (r[0] is None, r[0] or 0) < (lead[r[1:]][0] is None, lead[r[1:]][0] or 0):
            lead[r[1:]] = r
    cat = lambda x: 0 if x is None else (h(x) >> 7) % (1 << bits)

    def index(r):
        i = lead[r[1:]][0]
        x = [cat(lang(i)), cat(f"s{(i or 0) % 2}"), sum(b < r[1] for b in sizes), 0 if i is None else sum(b < i for b in ids)]
        q = 1 << (bits - 1)
        while q > 1:
            p = q - 1
            for k in range(4):
                if x[k] & q:
                    x[0] ^= p
                else:
                    t = (x[0] ^ x[k]) & p
                    x[0] ^= t
                    x[k] ^= t
            q >>= 1
        for k in range(1, 4):
            x[k] ^= x[k - 1]
        t, q = 0, 1 << (bits - 1)
        while q > 1:
            if x[3] & q:
                t ^= q - 1
            q >>= 1
        x = [v ^ t for v in x]
        return sum((x[k] >> b & 1) << (b * 4 + 3 - k) for b in range(bits) for k in range(4))

    order = sorted(rows, key=lambda r: (index(r), r[3], r[1], r[2], r[0] is not None, r[0] or 0))
    n, out, at = len(order), [], Counter()
    for rank, r in enumerate(order):
        s = rank * shards // n
        out.append((r[0], r[1], r[2], s, at[s], index(r)))
        at[s] += 1
    return Counter(out)


def test_hilbert_shards_by_brute_force_however_dealt(spark, docs):
    rng = random.Random(12)
    pairs = [(k, " ".join("w" * rng.randrange(1, 6) for _ in range(rng.randrange(0, 40)))) for k in range(500)]
    pairs += [(k + 900, pairs[k][1]) for k in range(60)] + [(None, "no id"), (None, None), (3, pairs[3][1]), (2**40, "far")] + [(k + 2000, "hot") for k in range(150)]
    want = brute_hilbert(pairs, 16)
    for n in (1, 5, 13):
        out = hilbert_shards.shard_by_hilbert(spark, docs(pairs).repartition(n))
        assert Counter(map(tuple, out.select("doc_id", "size", "text_crc32", "shard", "slot", "hilbert").collect())) == want


def test_written_shards_keep_rows_whole(spark, docs, tmp_path):
    df = docs([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")])
    name = hilbert_shards.write_shards(spark, df, str(tmp_path / "five"), 2)
    back = spark.read.parquet(str(tmp_path / "five"))
    assert multiset(back.select(df.columns)) == multiset(df) and {r[0] for r in back.select(name).collect()} == {0, 1}


def test_quality_rows(spark, docs):
    rng = random.Random(1)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(40)) for _ in range(80)]
    rows = [*enumerate(good), (70, "#%&* ZQXJ " * 30), (70, good[70]), (None, good[5]), (None, None)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    judged = Counter((r.doc_id, r.kept) for r in quality.judge_quality(spark, docs(rows), labels).collect())
    assert sum(judged.values()) == len(rows) and judged[(70, False)] == 1 and judged[(70, True)] == 2
    kept = Counter((r.doc_id, r.text) for r in quality.keep_quality(spark, docs(rows), labels).collect())
    assert kept[(70, good[70])] == 2 and kept[(70, "#%&* ZQXJ " * 30)] == 0 and kept[(None, good[5])] == 1 and kept[(None, None)] == 0
