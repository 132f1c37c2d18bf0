"""Operators on copies, near copies and packing against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import xxhash

from canopy.llm import exact_dedup, hilbert_shards, pack, simhash
from canopy.llm._store import Work

RANDOM = random.Random(5)
VOCABULARY = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa"]


def prose(n, rng=RANDOM):
    return " ".join(rng.choice(VOCABULARY) + str(rng.randrange(40)) for _ in range(n))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


AWKWARD = [None, "", " ", "\t\n", "a", "a", "A", "a  b", "a\tb", "a b", "\x1ca", "é", "z" * 70_000, "z" * 70_000 + " ", " lead", "lead"]


def same_texts(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return groups


def test_exact_dedup(spark, docs):
    pairs = list(enumerate(AWKWARD + ["hot copy"] * 400 + [prose(5) for _ in range(50)]))
    RANDOM.shuffle(pairs)
    want = sorted((i, min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in same_texts(pairs).items() for i in g)
    for n in (1, 3, 7):
        assert sorted(rows(exact_dedup.exact_dedup(spark, docs(pairs).repartition(n)))) == want
    kept = exact_dedup.keep_first(spark, docs(pairs))
    assert kept.columns == docs([]).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in same_texts(pairs).values())


def test_exact_dedup_edges(spark, docs):
    assert rows(exact_dedup.exact_dedup(spark, docs([]))) == []
    out = exact_dedup.exact_dedup(spark, docs([(3, "x"), (3, "x"), (None, "x")])).collect()
    assert sum(r.kept for r in out) == 1 and {r.keep_id for r in out} == {3} and {r.group_size for r in out} == {3}
    assert exact_dedup.keep_first(spark, docs([(3, "x"), (3, "x"), (None, "x")])).count() == 1


def near(text, rng):
    words = text.split()
    words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def brute_components(pairs):
    def fp(t):
        w = (t or "").encode().lower().split()
        if not w:
            return 0
        grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
        hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    prints = {i: fp(t) for i, t in pairs}
    comp = {i: i for i in prints}
    for a in sorted(prints):
        for b in sorted(prints):
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = comp[a], comp[b]
                comp = {k: min(x, y) if v in (x, y) else v for k, v in comp.items()}
    return sorted((i, f"{prints[i]:016x}", comp[i]) for i in prints)


def test_simhash(spark, docs):
    base = [prose(60) for _ in range(6)]
    pairs = list(enumerate(AWKWARD + ["one two"] * 30 + [near(b, RANDOM) for b in base for _ in range(15)] + base))
    want = brute_components(pairs)
    assert len({c for _, _, c in want}) < len(want)
    for most in (4096, 2):  # the second sends every shared bucket through all levels and into blocks
        assert sorted(map(tuple, simhash.simhash_components(spark, docs(pairs), most=most).collect())) == want
    assert rows(simhash.simhash_components(spark, docs([]))) == []


def test_covering_masks_cover(spark):
    rng = random.Random(1)
    levels = simhash.mask_levels(2)
    assert [len(x) for x in levels] == [15, 225]
    for _ in range(2000):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not diff & m for m in levels[0])
        assert any(not diff & m for m in levels[1])


def test_links_chain_through_hot_bucket(spark):
    prints = [(k, k) for k in range(0, 64)]
    df = spark.createDataFrame(prints, "fp long, rep long")
    for most in (4096, 5):
        edges = simhash.near_links(Work(spark, "t"), df, most=most).collect()
        parent = list(range(64))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in edges:
            parent[max(find(a), find(b))] = min(find(a), find(b))
        assert {find(i) for i in range(64)} == {0}


def hilbert_point(h, n, bits):
    """The usual transpose-to-axes inverse, for the round trip."""
    x = [0] * n
    for b in range(bits * n):
        x[b % n] |= (h >> (bits * n - 1 - b) & 1) << (bits - 1 - b // n)
    t = x[n - 1] >> 1
    for i in range(n - 1, 0, -1):
        x[i] ^= x[i - 1]
    x[0] ^= t
    q = 2
    while q != 1 << bits:
        p = q - 1
        for i in range(n - 1, -1, -1):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q <<= 1
    return x


def test_hilbert_index_round_trip(spark):
    from pyspark.sql import functions as F

    for n, bits in ((2, 3), (3, 2), (4, 2)):
        grid = spark.range(1 << (n * bits)).select(*[F.shiftright("id", bits * i).bitwiseAND(F.lit((1 << bits) - 1)).alias(f"a{i}") for i in range(n)])
        out = grid.withColumn("h", hilbert_shards.hilbert_index([F.col(f"a{i}") for i in range(n)], bits)).collect()
        assert sorted(r.h for r in out) == list(range(1 << (n * bits)))
        for r in out:
            assert hilbert_point(r.h, n, bits) == [r[f"a{i}"] for i in range(n)]
        path = [hilbert_point(h, n, bits) for h in range(1 << (n * bits))]
        assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(path, path[1:]))


def test_shards(spark, docs, tmp_path):
    pairs = list(enumerate(AWKWARD + ["hot"] * 300 + [prose(1 + k % 30) for k in range(200)]))
    out = hilbert_shards.shard_by_hilbert(spark, docs(pairs)).collect()
    assert len(out) == len(pairs)
    by = defaultdict(list)
    for r in out:
        t = (dict(pairs)[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "rows", None)
        by[r.shard].append(r.slot)
    assert sorted(by) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert rows(hilbert_shards.shard_by_hilbert(spark, docs([]))) == []
    hilbert_shards.write_shards(spark, docs(pairs), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(pairs)


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(pack.VOCABULARY))
    texts = AWKWARD + [prose(1 + RANDOM.randrange(90)) for _ in range(150)] + ["<|endoftext|>x y", "a b 　", "it's don't 12 34"] + [prose(3000)]
    coded = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    out = pack.pack(spark, docs(texts)).collect()
    again, bins = defaultdict(dict), defaultdict(list)
    for r in out:
        again[r.doc_id][r.piece] = r
        bins[r.sequence_id].append((r.offset, r.length))
    for i, ids in coded.items():
        pieces = [again[i][k] for k in range(len(again[i]))]
        assert [p.length for p in pieces] == [len(ids[k : k + 2048]) for k in range(0, len(ids), 2048)]
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[p.start : p.start + p.length]))
    for seats in bins.values():
        at = 0
        for offset, length in sorted(seats):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(map(len, coded.values()))
    assert len(bins) == -(-total // 2048)
    assert rows(pack.pack(spark, docs([]))) == []


def test_fullest_bin_is_fullest():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 9))]
        left = {s: sizes.count(s) for s in set(sizes)}
        used = pack.fullest_bin(dict(left), 40)
        lead = max(sizes)
        rest = list(sizes)
        rest.remove(lead)
        sums = {0}
        for s in rest:
            sums |= {x + s for x in sums}
        assert sum(s * n for s, n in used.items()) == lead + max(x for x in sums if x <= 40 - lead)
        assert all(n <= left[s] for s, n in used.items())
