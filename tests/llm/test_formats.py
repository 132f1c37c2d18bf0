"""Pseudonyms against an independent Feistel network, and URL verdicts against plain PageRank."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from canopy.llm import pseudonyms, url_trust

LOW, UP, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def digest(key, kind, step, half):
    return hashlib.sha512(f"{key}|{kind}|{step}|{half}".encode()).hexdigest()


def turned(c, by):
    for alphabet in (LOW, UP, DIGITS):
        if c in alphabet:
            return alphabet[(alphabet.index(c) + by) % len(alphabet)]
    return c


def feistel(value, key, kind):
    if len(value) == 1:
        for alphabet in (LOW, UP, DIGITS):
            if value in alphabet:
                return sorted((digest(key, kind, 0, c), c) for c in alphabet)[alphabet.index(value)][1]
        return value
    half = len(value) // 2
    a, b = value[:half], value[half:]
    for k in range(1, 9):
        d = digest(key, kind, k, b)
        a, b = b, "".join(turned(c, int(d[4 * (i % 32) : 4 * (i % 32) + 4], 16)) for i, c in enumerate(a))
    return a + b


def feistel_number(n, sizes, key, kind):
    a, b = divmod(n, sizes[1])
    for k in range(1, 9):
        if k % 2:
            a = (a + int(digest(key, kind, k, b)[:12], 16)) % sizes[0]
        else:
            b = (b + int(digest(key, kind, k, a)[:12], 16)) % sizes[1]
    return a * sizes[1] + b


def walked(n, sizes, key, kind, fits):
    n = feistel_number(n, sizes, key, kind)
    while not fits(n):
        n = feistel_number(n, sizes, key, kind)
    return n


def laid(value, chars):
    rest = iter(chars)
    return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in value)


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(digits))) % 10


def day_of(y, m, d):
    try:
        return date(int(y), int(m), int(d))
    except ValueError:
        return None


def moved_date(value, key):
    parts = re.split("[-./]", value)
    iso, slash = "-" in value, "/" in value
    month_first = slash and day_of(parts[2], parts[0], parts[1]) is not None
    if iso:
        day, wide_d, wide_m = day_of(*parts), True, True
    elif month_first:
        day, wide_d, wide_m = day_of(parts[2], parts[0], parts[1]), len(parts[1]) == 2, len(parts[0]) == 2
    else:
        day, wide_d, wide_m = day_of(parts[2], parts[1], parts[0]), len(parts[0]) == 2, len(parts[1]) == 2
    number = (day - date(1800, 1, 1)).days
    base = number // 146097 * 146097

    def at(n):
        k = base + n + date(1800, 1, 1).toordinal()
        return date.fromordinal(k) if 1 <= k <= date.max.toordinal() else None

    def fits(n):
        x = at(n)
        return x is not None and (wide_d or x.day < 10) and (wide_m or x.month < 10) and (not slash or month_first or x.day > 12)

    x = at(walked(number - base, (189, 773), key, "date", fits))
    y, m, d = f"{x.year:04}", f"{x.month:02}" if wide_m else str(x.month), f"{x.day:02}" if wide_d else str(x.day)
    return f"{y}-{m}-{d}" if iso else f"{m}/{d}/{y}" if month_first else f"{d}/{m}/{y}" if slash else f"{d}.{m}.{y}"


def moved(value, kind, key):
    bare = re.sub("[^0-9A-Za-z]", "", value)
    digits = re.sub("[^0-9]", "", value)
    if kind == "email":
        name, _, host = value.partition("@")
        return feistel(name, key, "email") + "@" + host
    if kind == "iban":
        body = feistel(bare[4:], key, "iban")
        check = 98 - int("".join(str(int(c, 36)) for c in body + bare[:2] + "00")) % 97
        return laid(value, f"{bare[:2]}{check:02}{body}")
    if kind == "ip":
        octets = [int(x) for x in value.split(".")]
        n = int.from_bytes(bytes(octets))
        wide = len(value) == 15
        n = feistel_number(n, (65536, 65536), key, "ip") if wide else walked(n, (65536, 65536), key, "ip", lambda x: min(x.to_bytes(4)) < 100)
        return ".".join(f"{x:03}" if wide else str(x) for x in n.to_bytes(4))
    if kind == "date":
        return moved_date(value, key)
    if kind == "card":
        payload = feistel(digits[:-1], key, "card")
        return laid(value, payload + str(-luhn(payload + "0") % 10))
    if kind == "phone":
        return laid(value, digits[:-7] + feistel(digits[-7:], key, "phone"))
    area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
    n = ((area - (2 if area > 666 else 1)) * 99 + group - 1) * 9999 + serial - 1
    n = feistel_number(n, (898 * 99, 9999), key, "ssn")
    i = n // (99 * 9999)
    return laid(value, f"{i + (2 if i >= 665 else 1):03}{n // 9999 % 99 + 1:02}{n % 9999 + 1:04}")


VALUES = {
    "card": ["4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004"],
    "email": ["und.34@mail7.example.com", "a@b.org", "b@b.org", "Z@b.org", "7@b.org", "_@b.org", "ab@b.org"],
    "iban": ["GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432"],
    "ip": ["97.51.17.173", "1.2.3.4", "197.151.217.173", "010.001.002.003", "0.0.0.0"],
    "ssn": ["123-45-6789", "665-01-0001", "667-99-9999"],
    "phone": ["+1 (017) 555-7713", "555-123-4567", "+49 30 1234567"],
    "date": ["2024-02-29", "31.12.1999", "1.2.2020", "01.2.2020", "1.02.2020", "1/2/2020", "12/31/2001", "13/02/2020", "31/1/2020", "0001-01-01", "9999-12-31", "1.1.1650", "29.2.2000", "2199-12-31", "1800-01-01"],
}


def test_against_an_independent_network(spark, docs):
    texts = [(k, v) for k, v in enumerate(v for values in VALUES.values() for v in values)]
    kinds = [kind for kind, values in VALUES.items() for _ in values]
    out = pseudonyms.pseudonymise(docs(texts), "secret")
    got = {r.doc_id: r for r in out.collect()}
    key = pseudonyms.sealed("secret")
    for (k, value), kind in zip(texts, kinds):
        assert got[k][f"n_{kind}"] == got[k].n_found == 1, (value, kind)
        assert got[k].text == moved(value, kind, key), (value, kind)
        if kind not in ("ip",):
            shape = lambda x: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", x)))
            assert shape(got[k].text) == shape(value)
    back = {r.doc_id: r.text for r in pseudonyms.pseudonymise(out.select("doc_id", "text"), "secret", back=True).collect()}
    assert back == dict(texts)


@pytest.mark.parametrize("form", ["{d}.{m}.{y}", "{d:02}.{m}.{y}", "{d}/{m:02}/{y}", "{d:02}/{m:02}/{y}"])
def test_dates_of_a_format_are_permuted_among_themselves(spark, docs, form):
    days = [date(1999, 1, 1) + timedelta(days=k) for k in range(0, 700, 3)]
    fields = {f: form.format(d=x.day, m=x.month, y=x.year) for f, x in enumerate(days)}
    out = pseudonyms.pseudonymise(docs(list(fields.items())), "k")
    got = {r.doc_id: r.text for r in out.collect()}
    assert len(set(got.values())) == len(set(fields.values())) and all(len(got[k]) == len(v) and [len(x) for x in re.split("[./]", got[k])] == [len(x) for x in re.split("[./]", v)] for k, v in fields.items())
    assert {r.doc_id: r.text for r in pseudonyms.pseudonymise(out.select("doc_id", "text"), "k", back=True).collect()} == fields


def test_strange_octets_stay_and_keys_are_asked_for(spark, docs):
    texts = ["1.02.3.4", "010.1.2.3", "256.1.1.1"]
    assert [r.text for r in pseudonyms.pseudonymise(docs(texts), "k").orderBy("doc_id").collect()] == texts
    with pytest.raises(TypeError):
        pseudonyms.pseudonymise(docs(texts))
    with pytest.raises(ValueError):
        pseudonyms.pseudonymise(docs(texts), "")
    pseudonyms.session_key(spark)
    plan = pseudonyms.pseudonymise(docs(texts), "hidden")._jdf.queryExecution().toString()
    assert "hidden" not in plan and pseudonyms.sealed("hidden") not in plan


def brute_verdicts(pages, rules, damping=0.85):
    """(host, path, rule, verdict, trust, distrust) by plain Python, ranks iterated until they stand still."""
    at = {}
    for k, url, _ in pages:
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0].translate(str.maketrans(UP, LOW))
            path = re.match("[^?#]*", rest[len(host) :])[0]
        fit = max(((len(own + start), own + start, verdict) for verdict, own, start in rules if (host == own or host.endswith("." + own)) and path.startswith(start)), default=None)
        at[k] = (host, path, fit and fit[1], fit and fit[2])
    edges, seeds = Counter(), {"allow": Counter(), "block": Counter()}
    for k, _, html in pages:
        for to in re.findall(r'(?:href|src)="https?://([^/"]+)', html or ""):
            if at[k][0] and to.lower() != at[k][0]:
                edges[(at[k][0], to.lower())] += 1
        if at[k][3]:
            seeds[at[k][3]][at[k][0]] += 1

    def rank(seed, links):
        total, out = sum(seed.values()), Counter()
        for (a, _), n in links.items():
            out[a] += n
        base = {h: (1 - damping) * s / total for h, s in seed.items()}
        now = dict(base)
        for _ in range(250):
            then = defaultdict(float, base)
            for (a, b), n in links.items():
                then[b] += damping * now.get(a, 0) * n / out[a]
            now = then
        return now

    trust, distrust = rank(seeds["allow"], edges), rank(seeds["block"], Counter({(b, a): n for (a, b), n in edges.items()}))
    out = {}
    for k, (host, path, rule, verdict) in at.items():
        t, d = trust.get(host, 0.0), distrust.get(host, 0.0)
        out[k] = (host, path, rule, verdict or ("block" if d > t else "allow"), t, d)
    return out


def test_verdicts_by_brute_force(spark):
    rng = random.Random(8)
    hosts = [f"{a}{k}.{b}" for k in range(6) for a in ("x", "www.y") for b in ("com", "net", "org")] + ["example.com", "a.example.com", "example.net"]
    pages = []
    for k in range(150):
        host = rng.choice(hosts)
        path = rng.choice(["/en/1", "/de/80", "/es/", "/en/71", "/", "", "/fr/2?q=/en/"])
        links = "".join(f'<a href="https://{rng.choice(hosts)}/p">' for _ in range(rng.randrange(0, 4))) + '<a href="/own">'
        pages.append((k, f"http://{host.upper() if k % 5 == 0 else host}{path}", links))
    pages += [(150, None, "x"), (151, "no scheme", '<a href="http://example.com/">'), (152, pages[0][1], None), (153, pages[1][1], pages[1][2])]
    want = brute_verdicts(pages, url_trust.RULES)
    got = {r.page_id: r for r in url_trust.judge_urls(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert set(got) == set(want) and {"block", "allow"} == {w[3] for w in want.values() if w[2] is None}
    for k, (host, path, rule, verdict, trust, distrust) in want.items():
        r = got[k]
        assert (r.host, r.path, r.rule) == (host, path, rule) and abs(r.trust - trust) < 1e-7 and abs(r.distrust - distrust) < 1e-7
        assert r.verdict == verdict or (rule is None and abs(trust - distrust) < 1e-7)
