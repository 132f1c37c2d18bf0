"""PII: format-preserving Feistel pseudonyms.

Numbers, dates and addresses are found by one pattern, and each is validated:
card numbers by Luhn's sum, IBANs by their remainder of 97, IPv4 addresses by
their octets, social security numbers by their reserved ranges, dates by the
calendar, telephone numbers by their digit count. A valid one is permuted by a
keyed Feistel network within its format: digits become digits, letters letters
of their case, marks stay; check digits are computed anew; a date stays in its
400-year cycle and in its order and widths of day and month; an address keeps
four wide octets or has a narrow one. Where a format isn't a whole product of
two sizes, the network is gone through again until the result is of the format
(cycle walking), which is still a permutation. So equal values get equal
pseudonyms in every document, in whatever way their digits are spaced.
Without the key they can't be undone; with it permute(..., back=True) does.

The key is asked for; a deployment names it in spark.canopy.pseudonym.secret,
which Spark redacts as it does all secrets. Plans hold only a digest of it,
marked so that Spark's redaction of plan strings can find it.

Only built-in column functions are used; there is no shuffle.

Defined cases: a null text stays null with no finds; values that fail
validation stay as they are; a date with slashes is read month first where it
can be; very long texts are scanned whole; rows that repeat, or have no
identifier, are treated alike; finds that touch are separate finds; other
columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm._store import table
from canopy.llm.decontaminate import LOWER, UPPER

ROUNDS = 8
SECRET = "spark.canopy.pseudonym.secret"
MARK = "canopy-key:"  # what a key's digest in a plan is told by
SAMPLE_KEY = "for the query alone"  # where a session has no secret
DAY_ZERO, CYCLE = "1800-01-01", (189, 773)  # 189 * 773 days are 400 years
WALK = 256  # of the narrowest format a fifth is left out in each step, so this many never run out

# Fixed formats.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}+"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
WHOLE_OCTET = "^(0|[1-9][0-9]{0,2})$"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4})(?![./-]?[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])"
PHONE = r"(?<![0-9+])\+?[0-9]{0,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9+.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![.-]?[0-9])"
CARD = r"(?<![0-9.-])[0-9](?:[ -]?[0-9]){12,18}(?![.-]?[0-9])"
FORMATS = {"email": EMAIL, "iban": IBAN, "ip": IP, "date": DATE, "ssn": SSN, "phone": PHONE, "card": CARD}
ANY = "|".join(f"(?:{p})" for p in FORMATS.values()).replace(r"([./])", r"(?<mark>[./])").replace(r"\1", r"\k<mark>")


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sealed(key: str) -> str:
    """What plans hold in a key's place."""
    return MARK + hashlib.sha256(key.encode()).hexdigest()


def session_key(spark: SparkSession) -> str | None:
    """The session's secret; plans that are shown from then on don't show what stands for it."""
    if not spark.conf.get("spark.sql.redaction.string.regex", None):
        spark.conf.set("spark.sql.redaction.string.regex", f"{MARK}[0-9a-f]+")
    return spark.conf.get(SECRET, None)


def _digest(key: str, kind: str, step: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), half), 512)


def _number(digest: Column, at: Column, digits: int = 4) -> Column:
    return F.conv(F.substring(digest, at * digits + 1, digits), 16, 10).cast("long")


def _turn(char: Column, by: Column) -> Column:
    code = F.ascii(char)
    within = lambda low, n: F.chr(low + F.pmod(code - low + by, F.lit(n)))
    return F.when(char.rlike("^[0-9]$"), within(48, 10)).when(char.rlike("^[a-z]$"), within(97, 26)).when(char.rlike("^[A-Z]$"), within(65, 26)).otherwise(char)


def _single(char: Column, key: str, kind: str, back: bool) -> Column:
    """One digit or letter by a shuffle of its class in the order of keyed digests: there is no other half to turn it by."""
    out = char
    for alphabet in ("0123456789", LOWER, UPPER):
        plain = F.array(*[F.lit(c) for c in alphabet])
        drawn = F.transform(F.array_sort(F.transform(plain, lambda c: F.struct(_digest(key, kind, F.lit(0), c).alias("d"), c.alias("c")))), lambda x: x["c"])
        at = F.array_position(drawn if back else plain, char)
        out = F.when(at > 0, F.element_at(plain if back else drawn, F.nullif(at, F.lit(0)).cast("int"))).otherwise(out)
    return out


def permute(value: Column, key: str, kind: str, back: bool = False) -> Column:
    """A string with each digit and ASCII letter permuted within its own class."""
    return F.when(F.length(value) == 1, _single(value, key, kind, back)).otherwise(_halves(value, key, kind, back))


def _halves(value: Column, key: str, kind: str, back: bool) -> Column:
    half = F.floor(F.length(value) / 2).cast("int")
    sign = -1 if back else 1

    def mixed(part: Column, other: Column, step: Column) -> Column:
        return _let(
            _digest(key, kind, step, other),
            lambda d: F.array_join(F.transform(F.split(part, ""), lambda c, i: _turn(c, sign * _number(d, F.pmod(i, F.lit(32))))), ""),
        )

    start = F.struct(F.substring(value, F.lit(1), half).alias("l"), F.substring(value, half + 1, F.length(value)).alias("r"))
    steps = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    if back:
        step = lambda a, k: F.struct(mixed(a["r"], a["l"], k).alias("l"), a["l"].alias("r"))
    else:
        step = lambda a, k: F.struct(a["r"].alias("l"), mixed(a["l"], a["r"], k).alias("r"))
    return F.aggregate(steps, start, step, lambda a: F.concat(a["l"], a["r"]))


def permute_number(value: Column, sizes: tuple[int, int], key: str, kind: str, back: bool = False) -> Column:
    """A whole number below sizes[0] * sizes[1], permuted."""
    sign = -1 if back else 1
    shift = lambda d, k: sign * F.conv(F.substring(d, 1, 12), 16, 10).cast("long")

    def step(a: Column, k: Column) -> Column:
        left = F.pmod(a["l"] + shift(_digest(key, kind, k, a["r"].cast("string")), k), F.lit(sizes[0]).cast("long"))
        right = F.pmod(a["r"] + shift(_digest(key, kind, k, a["l"].cast("string")), k), F.lit(sizes[1]).cast("long"))
        odd = k % 2 == 1
        return F.struct(F.when(odd, left).otherwise(a["l"]).alias("l"), F.when(odd, a["r"]).otherwise(right).alias("r"))

    start = F.struct(F.floor(value / sizes[1]).cast("long").alias("l"), F.pmod(value, F.lit(sizes[1])).cast("long").alias("r"))
    steps = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(steps, start, step, lambda a: a["l"] * sizes[1] + a["r"])


def _walked(value: Column, sizes: tuple[int, int], key: str, kind: str, back: bool, fits) -> Column:
    """A number permuted within those that fit: permuted again until it does. value itself must fit."""
    start = F.struct(permute_number(value, sizes, key, kind, back).alias("n"))

    def step(a: Column, _: Column) -> Column:
        return F.struct(F.when(fits(a["n"]), a["n"]).otherwise(permute_number(a["n"], sizes, key, kind, back)).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, step, lambda a: a["n"])


def _bare(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9A-Za-z]", "")


def _laid(value: Column, chars: Column) -> Column:
    """chars in the places of value's digits and letters."""
    place = lambda i: F.length(_bare(F.substring(value, F.lit(1), i + 1)))
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("^[0-9A-Za-z]$"), F.substring(chars, place(i), F.lit(1))).otherwise(c)), "")


def luhn(digits: Column) -> Column:
    """Luhn's sum over digits whose last one is the check digit."""
    double = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, double(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10


def mod97(text: Column) -> Column:
    """The remainder of a string of digits and capitals, read as IBANs are."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + value(c)) % 97).otherwise((a * 100 + value(c)) % 97))


def _octets(value: Column) -> Column:
    return F.transform(F.split(value, r"\."), lambda x: x.cast("long"))


def _field(value: Column, k: int) -> Column:
    return F.get(F.split(value, "[./]"), F.lit(k - 1))


def _date_of(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def _month_first(value: Column) -> Column:
    return value.contains("/") & _date_of(_field(value, 3), _field(value, 1), _field(value, 2)).isNotNull()


def as_day(value: Column) -> Column:
    """The date a string gives: ISO, day first with dots, month first with slashes if that is one; else null."""
    day_first = _date_of(_field(value, 3), _field(value, 2), _field(value, 1))
    return F.when(value.contains("-"), F.try_to_date(value, "yyyy-MM-dd")).when(value.contains("/"), F.coalesce(_date_of(_field(value, 3), _field(value, 1), _field(value, 2)), day_first)).otherwise(day_first)


def _day_number(value: Column) -> Column:
    return F.datediff(as_day(value), F.to_date(F.lit(DAY_ZERO)))


def _moved_date(value: Column, key: str, back: bool) -> Column:
    """A valid date's pseudonym: of its own 400-year cycle, order of fields and widths of day and month."""
    days = CYCLE[0] * CYCLE[1]
    iso, month_first = value.contains("-"), _month_first(value)
    d, m = F.when(month_first, 2).otherwise(1), F.when(month_first, 1).otherwise(2)
    parts = F.split(value, "[./]")
    wide = lambda k: iso | (F.length(F.get(parts, k - 1)) == 2)
    only_day_first = value.contains("/") & ~month_first
    date = lambda n: F.date_add(F.to_date(F.lit(DAY_ZERO)), n.cast("int"))

    def within(x: Column) -> Column:
        def fits(n: Column) -> Column:
            day = date(x["base"] + n)
            return F.year(day).between(1, 9999) & (x["wide_d"] | (F.dayofmonth(day) < 10)) & (x["wide_m"] | (F.month(day) < 10)) & (~x["late"] | (F.dayofmonth(day) > 12))

        return x["base"] + _walked(x["n"] - x["base"], CYCLE, key, "date", back, fits)

    number = _day_number(value)
    base = F.floor(number / days).cast("long") * days
    own = F.struct(number.cast("long").alias("n"), base.alias("base"), wide(d).alias("wide_d"), wide(m).alias("wide_m"), only_day_first.alias("late"))

    def written(n: Column) -> Column:
        day = date(n)
        two = lambda part, is_wide: F.when(is_wide, F.lpad(part.cast("string"), 2, "0")).otherwise(part.cast("string"))
        year, month, of_month = F.lpad(F.year(day).cast("string"), 4, "0"), two(F.month(day), wide(m)), two(F.dayofmonth(day), wide(d))
        mark = F.when(value.contains("/"), "/").otherwise(".")
        return F.when(iso, F.concat_ws("-", year, month, of_month)).when(month_first, F.concat_ws("/", month, of_month, year)).otherwise(F.concat(of_month, mark, month, mark, year))

    return _let(_let(own, within), written)


def _moved_ip(value: Column, key: str, back: bool) -> Column:
    """Four octets of three digits stay that wide, with leading zeros; others get at least one that is narrower, without."""
    octets = _octets(value)
    at = lambda i: F.element_at(octets, i)
    number = ((at(1) * 256 + at(2)) * 256 + at(3)) * 256 + at(4)
    parts = lambda n: [F.shiftright(n, s).bitwiseAND(F.lit(255)) for s in (24, 16, 8, 0)]
    wide = F.length(value) == 15
    narrow = lambda n: F.least(*parts(n)) < 100
    sizes = (1 << 16, 1 << 16)
    moved = F.when(wide, permute_number(number, sizes, key, "ip", back)).otherwise(_walked(number, sizes, key, "ip", back, narrow))
    return _let(moved, lambda n: F.concat_ws(".", *[F.when(wide, F.lpad(p.cast("string"), 3, "0")).otherwise(p.cast("string")) for p in parts(n)]))


def kind_of(value: Column) -> Column:
    """Which valid kind a find is, null if it fails validation."""
    whole = lambda p: value.rlike("^(?:" + p + ")$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    bare = _bare(value)
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))
    number = _day_number(value)
    return (
        F.when(value.contains("@"), "email")
        .when(whole(IBAN), F.when(mod97(turned) == 1, "iban"))
        .when(whole(IP), F.when(F.forall(_octets(value), lambda x: x < 256) & ((F.length(value) == 15) | F.forall(F.split(value, r"\."), lambda x: x.rlike(WHOLE_OCTET))), "ip"))
        .when(whole(DATE), F.when(number.isNotNull(), "date"))
        .when(whole(SSN), F.when(~value.rlike("^(?:000|666|9)|-00-|-0000$"), "ssn"))
        .when(whole(CARD) & (luhn(digits) == 0), "card")
        .when(whole(PHONE), F.when(F.length(digits).between(7, 15), "phone"))
    )


def pseudonym(value: Column, kind: Column, key: str, back: bool = False) -> Column:
    """A valid find's pseudonym under a sealed key, of the same kind and format; with back, what the pseudonym stands for."""
    bare, digits = _bare(value), F.regexp_replace(value, "[^0-9]", "")
    name = F.substring_index(value, "@", 1)
    email = F.concat(permute(name, key, "email", back), F.substring(value, F.length(name) + 1, F.length(value)))
    body = permute(F.substring(bare, F.lit(5), F.length(bare)), key, "iban", back)
    land = F.substring(bare, 1, 2)
    iban = _let(body, lambda b: F.concat(land, F.lpad((98 - mod97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0"), b))
    payload = permute(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", back)
    card = _let(payload, lambda p: F.concat(p, F.pmod(-luhn(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))
    # A telephone number keeps what stands before its last seven digits: country and area say who can't be reached by them.
    lead = F.length(digits) - 7
    phone = F.concat(F.substring(digits, F.lit(1), lead), permute(F.substring(digits, lead + 1, F.lit(7)), key, "phone", back))
    return (
        F.when(kind == "email", email)
        .when(kind == "iban", _laid(value, iban))
        .when(kind == "ip", _moved_ip(value, key, back))
        .when(kind == "date", _moved_date(value, key, back))
        .when(kind == "card", _laid(value, card))
        .when(kind == "phone", _laid(value, phone))
        .when(kind == "ssn", _laid(value, _ssn(digits, key, back)))
        .otherwise(value)
    )


def _ssn(digits: Column, key: str, back: bool) -> Column:
    """Area, group and serial each stay within their valid range."""
    area, group, serial = (F.substring(digits, a, n).cast("long") for a, n in ((1, 3), (4, 2), (6, 4)))
    index = area - F.when(area > 666, 2).otherwise(1)  # 898 areas
    number = (index * 99 + group - 1) * 9999 + serial - 1
    moved = permute_number(number, (898 * 99, 9999), key, "ssn", back)

    def written(n: Column) -> Column:
        index = F.floor(n / (99 * 9999))
        area = index + F.when(index >= 665, 2).otherwise(1)
        return F.concat(F.lpad(area.cast("string"), 3, "0"), F.lpad((F.floor(n / 9999) % 99 + 1).cast("string"), 2, "0"), F.lpad((n % 9999 + 1).cast("string"), 4, "0"))

    return _let(moved, written)


def pseudonymise(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """doc_id, pseudonymised text, how many valid finds of each kind and in all, for each row of docs(doc_id, text)."""
    if not key:
        raise ValueError("pseudonyms need a secret key")
    key = sealed(key)
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("_text"),
        F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("_found"),
    )
    marked = found.withColumn("_found", F.transform("_found", lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind"))))
    moved = marked.withColumn("_new", F.transform("_found", lambda x: pseudonym(x["value"], x["kind"], key, back)))
    # Zipped, not looked up by place: inside a lambda the pseudonyms would be made again for each piece.
    pairs = F.arrays_zip(F.split("_text", ANY, -1).alias("piece"), F.col("_new").alias("new"))
    joined = F.array_join(F.transform(pairs, lambda x: F.concat(x["piece"], F.coalesce(x["new"], F.lit("")))), "")
    valid = F.filter(F.coalesce(F.col("_found"), F.array()), lambda x: x["kind"].isNotNull())

    def count(kind: str) -> Column:
        return F.size(F.filter(valid, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    text = F.when(F.coalesce(F.size("_found"), F.lit(0)) > 0, joined).otherwise(F.col("_text"))
    return moved.select("doc_id", text.alias("text"), *map(count, FORMATS), F.size(valid).cast("long").alias("n_found"))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), session_key(spark) or SAMPLE_KEY)


QUERIES = {"op6_pseudonyms": op6_pseudonyms}
ORACLE: dict[str, str] = {}
