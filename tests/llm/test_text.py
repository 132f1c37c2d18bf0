"""Operators on words, models, links and personal data against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from canopy.llm import _text, decontaminate, lm_score, pseudonyms, quality, substring_dedup, url_trust
from canopy.llm._store import Work

WORDS = ["of", "the", "alpha", "Beta", "gämma", "delta", "eps", "zeta"]


def prose(n, rng, spread=30):
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(spread)) if rng.random() < 0.7 else "") for _ in range(n))


def brute_substrings(pairs, n=13):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in pairs}
    least = {}
    for i in sorted(words):
        for k in range(len(words[i]) - n + 1):
            least.setdefault(tuple(words[i][k : k + n]), i)
    out = []
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - n + 1):
            if least[tuple(w[k : k + n])] < i:
                gone |= set(range(k, k + n))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


@pytest.mark.parametrize("hot", [4096, 1])
def test_substring_dedup(spark, docs, hot):
    rng = random.Random(7)
    line, long = prose(16, rng), prose(60, rng)
    texts = [None, "", "  \n ", "one", prose(12, rng), line, "tail " + line, line + " x", long]
    texts += [f"{prose(5, rng)} {line} {prose(5, rng)}" for _ in range(25)]
    texts += [long, " ".join(long.split()[3:50]), long.replace(" ", "\n"), "a " * 40, "a " * 30 + "b", prose(400, rng) + " " + long, "of the " * 20]
    texts += [" ".join(long.split()[k : k + 14]) for k in range(0, 40, 3)]
    pairs = list(enumerate(texts))
    rng.shuffle(pairs)
    got = sorted(map(tuple, substring_dedup.substring_dedup(spark, docs(pairs), hot=hot).collect()))
    assert got == brute_substrings(pairs)


def test_substring_edges(spark, docs):
    assert substring_dedup.substring_dedup(spark, docs([])).collect() == []
    text = " ".join(f"w{k}" for k in range(20))
    got = substring_dedup.substring_dedup(spark, docs([(1, text), (1, text), (None, text), (2, text)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 20)]


def test_automaton_matches_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        seqs = [[rng.choice("abc") for _ in range(rng.randrange(1, 14))] for _ in range(5)]
        automaton = substring_dedup.Automaton()
        for owner, s in enumerate(seqs):
            automaton.add(s, owner)
        automaton.close()
        for s in [*seqs, [rng.choice("abcd") for _ in range(12)]]:
            n = rng.randrange(1, 5)
            want = [min((o for o, t in enumerate(seqs) if any(t[j : j + n] == s[k : k + n] for j in range(len(t)))), default=None) for k in range(len(s) - n + 1)]
            assert automaton.owners(s, n) == want


def test_word_hashes(spark):
    texts = ["a b", None, "", " b  a\tb", "é\x1ca b", "ab"]
    buf, starts, ends, first = _text.words(pa.array(["skip", *texts]).slice(1))
    got = [buf[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert [got[a:b] for a, b in zip(first, first[1:])] == [(t or "").encode().split() and [w.decode() for w in (t or "").encode().split()] for t in texts]
    hashes = _text.word_hashes(buf, starts, ends)
    assert len(set(hashes.tolist())) == len(set(got)) and len({(w, h) for w, h in zip(got, hashes.tolist())}) == len(set(got))


def brute_leaks(pairs, items, n=8):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans(decontaminate.UPPER, decontaminate.LOWER)))
    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[k : k + n])].add(i)
    out = []
    for d, t in pairs:
        w, hit, found = split(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (x := tuple(w[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[x]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), len(found) >= 2))
    return sorted(out)


def test_decontaminate(spark, docs):
    rng = random.Random(4)
    items = [(k, prose(20, rng)) for k in range(12)] + [(20, "Solo!"), (21, None), (22, "..."), (23, "the the the the the the the the the"), (24, "two words"), (25, "É É, não"), (26, prose(8, rng))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [None, "", "...", "x " * 50, "solo", "THE the. the the the the the the the", "two-words here", "É é É não"]
    texts += [f"{prose(6, rng)}; {items[k][1].upper() if k % 2 else items[k][1]} -- {items[k + 1][1]}!" for k in range(10)]
    texts += [prose(6, rng) + " " + " ".join(items[2][1].split()[5:15]), prose(3000, rng), "(" + items[3][1]]
    pairs = list(enumerate(texts))
    got = sorted(map(tuple, decontaminate.contamination(spark, docs(pairs), bench).collect()))
    assert got == brute_leaks(pairs, items)
    clean = [r.doc_id for r in decontaminate.keep_uncontaminated(spark, docs(pairs), bench).collect()]
    assert sorted(clean) == [r[0] for r in got if not r[2]]
    assert decontaminate.contamination(spark, docs([]), bench).collect() == []
    assert {r.n_items for r in decontaminate.contamination(spark, docs(texts), bench.limit(0)).collect()} == {0}


def test_proximity(spark, docs):
    bench = spark.createDataFrame([(1, "red fox jumps over lazy dogs at noon")], "item_id long, text string")
    index = decontaminate.PositionalIndex(spark, docs(["red fox really jumps over very lazy dogs at noon", "fox " + "x " * 30 + "red over", "red fox jumps over lazy dogs at noon"]), bench)
    assert {r.doc_id for r in index.phrases().collect()} == {2}
    assert {r.doc_id for r in index.proximity(3).collect()} >= {2} and 1 not in {r.doc_id for r in index.proximity(3).collect()}


def brute_kneser_ney(train, order, discounts):
    """log p(text) under the same definition, by recursion over plain dictionaries."""
    counts = {order: Counter()}
    for t in train:
        s = [256] * (order - 1) + list(t)
        counts[order].update(tuple(s[k : k + order]) for k in range(len(s) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / 256
        after = [c for g, c in counts[k].items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        d = lambda c: discounts[k][min(c, 3) - 1]
        c = counts[k][gram]
        return ((c - d(c)) if c else 0) / sum(after) + sum(map(d, after)) / sum(after) * p(gram[1:])

    return lambda t: sum(math.log(p(tuple(([256] * (order - 1) + list(t))[k : k + order]))) for k in range(len(t)))


def test_kneser_ney(spark, docs, monkeypatch):
    train = ["abcab cabc", "abba", "cab", "aabbcc abc"]
    df = docs(train).select("text")
    seen = {}
    whole = quality._discounts

    def spy(x):
        seen[len(seen) + 1] = whole(x)
        return seen[len(seen)]

    monkeypatch.setattr(quality, "_discounts", spy)
    work = Work(spark, "t")
    model = quality.KneserNey(work, df, 3)
    texts = ["abc", "cabba", "zz", "a", "", None, "é abc"]
    corpus = quality.count_ngrams(docs(texts), quality.coder(3))
    logs = quality.log_probabilities(work, corpus, {"log": model}, 3).withColumn("log", quality.fixed("log"))
    brute = brute_kneser_ney([t.encode() for t in train], 3, seen)
    for head in (0, 3, 1 << 20):  # all by the sharded table, or some or all by the broadcast
        got = {r.doc_id: r for r in quality.sums_by_row(work, docs(texts).select("doc_id", "text"), logs, quality.coder(3), ["log"], head).collect()}
        assert [got[k].n_tokens for k in range(len(texts))] == [len((t or "").encode()) for t in texts]
        assert np.allclose([got[k].log / quality.SCALE for k in range(len(texts))], [brute((t or "").encode()) for t in texts], atol=1e-4)


def test_quality_thresholds_by_brute_force(spark, docs):
    """Perplexity, toxicity, quantiles and decisions against plain Python over the model's own tables."""
    rng = random.Random(21)
    good = [prose(rng.randrange(5, 60), rng) for _ in range(160)]
    bad = [" ".join(w if k % 7 else "moron" for k, w in enumerate(prose(30, rng).split())) for _ in range(40)]
    texts = good + bad + ["#%&* " * 40]
    labels = labels_of(spark, [(k, 1, 0) for k in range(150)] + [(k, 1, 1) for k in range(160, 190)])
    out = {r.doc_id: r for r in quality.judge_quality(spark, docs(texts), labels).collect()}
    fold = {r.doc_id: r.f for r in docs(texts).select("doc_id", (F.pmod(F.xxhash64(F.xxhash64("text"), F.lit("fold")), F.lit(1 << 20)) / (1 << 20)).alias("f")).collect()}
    tables = {}
    for name, ids in (("trusted", range(150)), ("toxic", range(160, 190))):
        model = quality.KneserNey(Work(spark, "t"), docs([texts[k] for k in ids if fold[k] < quality.TRAIN_SHARE]).select("text"))
        tables[name] = ({k: {r.code: r.p for r in model.p[k].collect()} for k in model.p}, {k: {r.context: r.g for r in model.g[k].collect()} for k in model.g})

    def log(name, code):
        p, g = tables[name]
        total = 0.0
        for k in range(quality.ORDER, 0, -1):
            own = code & ((1 << 9 * k) - 1)
            if own in p[k]:
                return total + math.log(p[k][own])
            total += math.log(g[k].get(own >> 9, 1.0))
        return total - math.log(256)

    want = {}
    for k, t in enumerate(texts):
        code = quality.codes(pa.array([t]), quality.ORDER)[0].tolist()
        a, b = [log("trusted", c) for c in code], [log("toxic", c) for c in code]
        want[k] = (math.exp(-sum(a) / len(code)), sum(max(y - x - quality.SLACK, 0) for x, y in zip(a, b)) / math.sqrt(len(code)))
        assert math.isclose(out[k].perplexity, want[k][0], rel_tol=1e-5) and math.isclose(out[k].toxicity, want[k][1], abs_tol=1e-4)
    lang = lambda k: "en" if k % 3 else None
    for code in ("en", None):
        held = [out[k] for k in range(150) if fold[k] >= quality.TRAIN_SHARE and lang(k) == code]
        for name in ("perplexity", "toxicity"):
            values = sorted(r[name] for r in held)
            exact = values[math.ceil(quality.QUANTILE * len(values)) - 1]
            got = {r[f"{name}_threshold"] for r in out.values() if r.lang == code}
            assert len(got) == 1 and exact <= got.pop() <= exact + (1 + exact) * 2 / quality.GRAIN
    assert all(r.kept == (r.perplexity <= r.perplexity_threshold and r.toxicity <= r.toxicity_threshold) for r in out.values())
    assert not any(out[k].kept for k in range(160, 201)) and sum(out[k].kept for k in range(160)) >= 130  # about 16 unseen texts set a threshold


def test_quality_learns_from_every_trusted_text(spark, docs):
    """16 MB of trusted and 10 MB of toxic texts: each in the fold to learn from counts, copies once; the probes tell which."""
    rng = random.Random(31)
    line = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(90, 110)))
    lines = [line() for _ in range(52)]
    texts = [x * 5000 for x in lines] + lines + [lines[0] * 5000, None, ""]
    labels = labels_of(spark, [(k, 1, 0) for k in [*range(32), 104]] + [(k, 0, 1) for k in range(32, 52)])
    out = {r.doc_id: r for r in quality.judge_quality(spark, docs(texts), labels).collect()}
    fold = {r.doc_id: r.f for r in docs(texts).select("doc_id", (F.pmod(F.xxhash64(F.xxhash64("text"), F.lit("fold")), F.lit(1 << 20)) / (1 << 20)).alias("f")).collect()}
    learnt = [k for k in range(52) if fold[k] < quality.TRAIN_SHARE]
    assert sum(len(texts[k]) for k in learnt if k < 32) > 10_000_000 and sum(len(texts[k]) for k in learnt if k >= 32) > 6_000_000
    work = Work(spark, "t")
    models = {m: quality.KneserNey(work, docs([texts[k] for k in ids]).select("text"), name=m) for m, ids in (("trusted", [k for k in learnt if k < 32]), ("toxic", [k for k in learnt if k >= 32]))}
    logs = quality.log_probabilities(work, quality.count_ngrams(docs(texts), quality.coder(quality.ORDER)), models, quality.ORDER)
    logs = logs.withColumn("log", quality.fixed("trusted"))
    want = {r.doc_id: r for r in quality.sums_by_row(work, docs(texts).select("doc_id", "text"), logs, quality.coder(quality.ORDER), ["log"]).collect()}
    assert len(out) == len(texts) and out[104].perplexity == out[0].perplexity
    for k in range(104):
        assert math.isclose(out[k].perplexity, math.exp(-want[k].log / quality.SCALE / want[k].n_tokens), rel_tol=1e-6)
    for k in range(52):  # what is learnt is foreseen, what isn't is not
        if k < 32:
            assert (out[k].perplexity < 5) == (k in learnt)
        else:
            assert out[k].perplexity > 5 and (out[k].toxicity > 1000) == (k in learnt)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality(spark, docs):
    rng = random.Random(9)
    good = [prose(60, rng) for _ in range(200)]
    junk = ["#%&* " * 40, "ZXQJ KVWX " * 30, "||||9999" * 30]
    texts = good + junk + [None, ""]
    labels = labels_of(spark, [(k, 1, 0) for k in range(150)] + [(200, 0, 0), (5, 0, 0)])
    out = {r.doc_id: r for r in quality.judge_quality(spark, docs(texts), labels).collect()}
    assert len(out) == len(texts)
    assert all(not out[k].kept for k in range(200, 205)) and sum(out[k].kept for k in range(200)) >= 190
    assert out[203].perplexity is None and out[204].n_bytes == 0
    kept = quality.keep_quality(spark, docs(texts), labels)
    assert kept.columns == docs([]).columns and sorted(r.doc_id for r in kept.collect()) == sorted(k for k, r in out.items() if r.kept)
    assert quality.judge_quality(spark, docs([]), labels).collect() == []
    assert sum(r.kept for r in quality.judge_quality(spark, docs(["a", None]), labels.limit(0)).collect()) == 1


def test_lm_score(spark, docs):
    texts = ["abab abab", "abab ab", "zq zq!", "abz", None, ""]
    labels = labels_of(spark, [(0, 1, 0), (1, 1, 0), (2, 0, 0), (3, 1, 1)])
    order, symbols = 3, 7
    out = {r.doc_id: r for r in lm_score.cross_entropy_difference(spark, docs(texts), labels, order, symbols).collect()}
    count = Counter(b for t in texts for b in (t or "").encode())
    top = {b: k + 1 for k, (b, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0]))[: symbols - 2])}
    code = lambda t: [top.get(b, symbols - 1) for b in t.encode()]

    def model(train):
        grams = Counter()
        for t in train:
            s = [0] * (order - 1) + code(t)
            grams.update(tuple(s[k : k + order]) for k in range(len(s) - order + 1))

        def p(g):
            if not g:
                return 1 / symbols
            own = Counter()
            for x, n in grams.items():
                if x[order - len(g) : order - 1] == g[:-1]:
                    own[x[-1]] += n
            total, kinds = sum(own.values()), len(own)
            return (own[g[-1]] + kinds * p(g[1:])) / (total + kinds) if total else p(g[1:])

        def loss(t):
            s = [0] * (order - 1) + code(t)
            return -sum(math.log(p(tuple(s[k : k + order]))) for k in range(len(s) - order + 1)) / len(t)

        return loss

    target, background = model(texts[:2]), model([t for t in texts if t])
    for k, t in enumerate(texts):
        if t:
            assert abs(out[k].target_loss - target(t)) < 1e-4 and abs(out[k].background_loss - background(t)) < 1e-4
            assert abs(out[k].score - target(t) + background(t)) < 1e-4 and out[k].n_tokens == len(t)
        else:
            assert out[k].score is None and out[k].n_tokens == 0
    assert out[0].score < out[2].score
    assert lm_score.cross_entropy_difference(spark, docs([]), labels).collect() == []
    assert {r.score for r in lm_score.cross_entropy_difference(spark, docs(["ab", "c"]), labels.limit(0)).collect()} == {0.0}


PERSONAL = [
    "card 4111 1111 1111 1111, again 4111111111111111, bad 4111111111111112",
    "mail und.34@mail7.example.com, UPPER.x@a-b.example.org!",
    "ip 97.51.17.173. not 300.1.1.1 nor 1.2.3.4.5",
    "tel +1 (017) 555-7713 and 555-123-4567 and +49 30 1234567",
    "on 2024-02-29 or 31.12.1999, not 02/30/2001, 2023-02-29; 12/31/2001",
    "iban GB82 WEST 1234 5698 7654 32, bad GB83 WEST 1234 5698 7654 32; ssn 123-45-6789 not 000-12-1234",
    None, "", "nothing here", "x" * 50_000 + " 4111111111111111 " + "y" * 50_000, "4111111111111111",
]


def test_pseudonyms(spark, docs):
    out = pseudonyms.pseudonymise(docs(PERSONAL), "k1")
    got = {r.doc_id: r for r in out.collect()}
    assert [got[k].n_found for k in range(11)] == [2, 2, 1, 3, 3, 2, 0, 0, 0, 1, 1]
    assert (got[0].n_card, got[1].n_email, got[2].n_ip, got[3].n_phone, got[4].n_date, got[5].n_iban, got[5].n_ssn) == (2, 2, 1, 3, 3, 1, 1)
    for k, t in enumerate(PERSONAL):
        if got[k].n_found:
            shape = lambda x: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", x)))
            assert got[k].text != t and (k == 2 or shape(got[k].text) == shape(t))
        else:
            assert got[k].text == t
    cards = re.findall(r"\d{16}|\d{4} \d{4} \d{4} \d{4}", got[0].text)
    assert cards[0].replace(" ", "") == cards[1] == got[10].text == got[9].text.split()[1] and cards[2] == "4111111111111112"
    digits = [int(c) for c in reversed(cards[1])]
    assert sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2]) == sum(digits[::2]) + sum((2 * d - 9) if d > 4 else 2 * d for d in digits[1::2])
    assert (sum(digits[::2]) + sum((2 * d - 9) if d > 4 else 2 * d for d in digits[1::2])) % 10 == 0
    again = {r.doc_id: r.text for r in pseudonyms.pseudonymise(out.select("doc_id", "text"), "k1", back=True).collect()}
    assert [again[k] for k in range(11)] == PERSONAL
    other = {r.doc_id: r.text for r in pseudonyms.pseudonymise(docs(PERSONAL), "k2").collect()}
    assert other[10] != got[10].text
    assert pseudonyms.pseudonymise(docs([]), "k").collect() == []


def test_pseudonyms_of_endless_runs(spark, docs):
    texts = ["x@" + "a." * 50_000, "1" * 100_000, "+1 " * 30_000, "(" * 50_000, "1-" * 50_000, "ab@cd.ef, " * 500, "GB82 " * 20_000]
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(docs(texts), "k").collect()}
    assert [len(got[k].text) for k in range(len(texts))] == [len(t) for t in texts] and got[5].n_email == 500


def test_feistel_is_a_permutation(spark):
    moved = spark.range(1000).select("id", pseudonyms.permute(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("a"), pseudonyms.permute_number(F.col("id"), (40, 25), "k", "t").alias("b"))
    got = moved.collect()
    assert len({r.a for r in got}) == 1000 == len({r.b for r in got}) and {r.b for r in got} == set(range(1000))
    back = moved.select("id", pseudonyms.permute(F.col("a"), "k", "t", True).alias("a"), pseudonyms.permute_number(F.col("b"), (40, 25), "k", "t", True).alias("b")).collect()
    assert all(int(r.a) == r.id == r.b for r in back)


def test_host_path_and_rules(spark):
    cases = {
        "HTTP://WWW.Example.COM/en/71?x#y": ("www.example.com", "/en/71", "example.com/en/7", "allow"),
        "http://a.example.com/en/8": ("a.example.com", "/en/8", "com/en/", "block"),
        "http://example.net/de/80": ("example.net", "/de/80", "example.net/de/8", "block"),
        "http://notexample.net/de/80": ("notexample.net", "/de/80", "net/de/", "allow"),
        "http://x.org": ("x.org", "", None, "allow"), "http://x.org?/es/": ("x.org", "", None, "allow"),
        "nothing": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://É.org/es/#": ("É.org", "/es/", "org/es/", "block"),
    }
    pages = spark.createDataFrame([(k, u, None, "x") for k, u in enumerate(cases)], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_trust.judge_urls(spark, pages).collect()}
    assert [got[k] for k in range(len(cases))] == list(cases.values())
    assert url_trust.judge_urls(spark, pages.limit(0)).collect() == []


def test_propagation(spark):
    edges = [("a", "b", 3), ("a", "c", 1), ("b", "c", 1), ("c", "a", 2), ("d", "a", 1), ("e", "d", 1)]
    seeds = {"a": 2.0, "d": 1.0}
    rank = {h: 0.15 * s / 3 for h, s in seeds.items()}
    for _ in range(300):
        new = defaultdict(float, {h: 0.15 * s / 3 for h, s in seeds.items()})
        for a, b, n in edges:
            new[b] += 0.85 * rank.get(a, 0) * n / sum(x[2] for x in edges if x[0] == a)
        rank = new
    work = Work(spark, "t")
    got = {r.host: r["rank"] for r in url_trust.propagate(work, spark.createDataFrame(list(seeds.items()), "host string, seed double"), spark.createDataFrame(edges, "a string, b string, n long"), "t", rounds=120).collect()}
    assert all(abs(got.get(h, 0) - rank[h]) < 1e-6 for h in rank)
    page = lambda k, host, path, *to: (k, f"http://{host}{path}", "".join(f'<a HREF="https://{t}/x">' for t in to))
    pages = [page(0, "bad.com", "/en/1"), page(1, "friend.org", "/", "bad.com"), page(2, "good.net", "/de/1", "peer.org"), page(3, "peer.org", "/"), page(4, "far.org", "/")]
    got = {r.page_id: r.verdict for r in url_trust.judge_urls(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {0: "block", 1: "block", 2: "allow", 3: "allow", 4: "allow"}


def test_pipeline(spark, docs, tmp_path):
    import zlib

    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    from canopy.llm import simhash

    rng = random.Random(11)
    item = prose(20, rng)
    good = [prose(80, rng) for _ in range(120)]
    texts = [*good, good[3], good[4].replace(" ", "\n"), good[5] + " x", "leak " + item + " " + prose(30, rng), "#%&* " * 40, None, ""]
    where = str(tmp_path / "sf")
    docs(texts).write.parquet(f"{where}/documents.parquet")
    labels_of(spark, [(k, 1, 0) for k in range(100)]).write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    now = spark.read.parquet(f"{where}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        was, now = now, spark.createDataFrame(stage(spark, now, where).collect(), now.schema)
        assert now.columns == was.columns and now.count() <= was.count()
    left = {r.doc_id: r.text for r in now.collect()}
    quality_kept = {r.doc_id for r in quality.judge_quality(spark, docs(texts), spark.read.parquet(f"{where}/labels.parquet")).collect() if r.kept}
    first = {}
    for k in sorted(quality_kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[k]), k)
    prints = {k: simhash.fingerprint(texts[k].encode()) for k in first.values()}
    comp = {k: k for k in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    comp[a] = comp[b] = min(comp[a], comp[b])
        break
    want = {k for k in prints if comp[k] == k and item not in texts[k]}
    assert set(left) == want and 124 not in want and 120 not in want and len(want) > 100
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = corpus_pipeline.run(spark, where).collect()
    got = sorted((r.doc_id, r.length, r.ids_crc32) for r in out)
    ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for k, t in left.items()}
    assert got == sorted((k, len(x), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x))) for k, x in ids.items())


def test_chunks_and_long_texts():
    texts = ["a" * n for n in (0, 5, 3, 40, 1, 1, 1)] + [None, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(_text.chunks(batch, "text", 10))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts and all(p.num_rows == 1 or sum(len(t or "") for t in p.column(0).to_pylist()) <= 10 for p in parts)
    assert list(_text.chunks(batch.slice(0, 0))) == []
    long = " ".join(f"w{k % 977}" for k in range(700_000))
    buf, starts, ends, first = _text.words(pa.array(["x", long, "w5 tail"]))
    hashes = _text.word_hashes(buf, starts, ends)
    assert len(starts) == 700_003 and first.tolist() == [0, 1, 700_001, 700_003]
    assert hashes[1 + 5] == hashes[1 + 5 + 977 * 700] == hashes[700_001] and len(set(hashes.tolist())) == 979


def test_lm_score_tells_all_bytes_apart(spark, docs):
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pairs = [*enumerate([letters * 30, letters * 20, "7777 7777", "8888 8888", "жжж жжж", "яяя яяя", None, ""]), (0, "8888")]
    labels = labels_of(spark, [(0, 1, 0), (2, 1, 0), (4, 1, 0)])
    whole = sorted(map(tuple, lm_score.cross_entropy_difference(spark, docs(pairs), labels).collect()), key=repr)
    scores = {r[0]: r[4] for r in whole if r[0]}
    assert scores[2] < scores[3] and scores[4] < scores[5]
    for head in (0, 9):  # all n-grams, or all but the most frequent, by the distributed table
        assert sorted(map(tuple, lm_score.cross_entropy_difference(spark, docs(pairs), labels, head=head).collect()), key=repr) == whole


def test_proximity_of_a_frequent_second_term(spark, docs):
    bench = spark.createDataFrame([(1, "fox over"), (2, "twin twin")], "item_id long, text string")
    index = decontaminate.PositionalIndex(spark, docs(["fox " + "x " * 30 + "over", "over " * 20, "fox really over", "a twin", "twin twin"]), bench)
    assert {r.doc_id for r in index.phrases().collect()} == {4}
    assert {(r.doc_id, r.phrase) for r in index.proximity(2).collect()} == {(2, "fox over"), (4, "twin twin")}


def test_distrust_goes_down_a_long_chain(spark):
    edges = spark.createDataFrame([(f"h{k}", f"h{k + 1}", 1) for k in range(40)], "a string, b string, n long")
    got = {r.host: r["rank"] for r in url_trust.propagate(Work(spark, "t"), spark.createDataFrame([("h0", 1.0)], "host string, seed double"), edges, "t").collect()}
    assert len(got) == 41 and all(abs(got[f"h{k}"] - 0.15 * 0.85**k) < 1e-9 for k in range(41))


def test_words_that_a_linear_hash_confuses(spark, docs):
    """A Thue-Morse word and its complement have one polynomial hash modulo 2^64, for any base."""
    for size in (2048,):
        bits = [bin(k).count("1") % 2 for k in range(size)]
        a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
        lead = " ".join(f"w{k}" for k in range(12))
        for pairs in ([(1, f"{lead} {a}"), (2, f"{lead} {b}")], [(1, f"{a} {lead}"), (2, f"{b} {lead}"), (3, f"{b} {lead}")]):
            got = sorted(map(tuple, substring_dedup.substring_dedup(spark, docs(pairs)).collect()))
            assert got == brute_substrings(pairs)
    eight = ["ab" * 4, "ba" * 4]
    blocks = ["".join(eight[bin(k).count("1") % 2 ^ c] for k in range(2048)) for c in (0, 1)]
    rng = random.Random(3)
    words = [*blocks, *("".join(rng.choice("ab") for _ in range(n)) for n in range(1, 80) for _ in range(40))]
    data = pa.array([" ".join(words)])
    buf, starts, ends, _ = _text.words(data)
    one, two = _text.word_digests(buf, starts, ends)
    assert len(set(one.tolist())) == len(set(words)) == len(set(two.tolist())) == len(set(zip(words, one.tolist(), two.tolist())))
