"""Parsing of titles, abstracts, XML, JSON and identifiers as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dutch words of the domain.
KINDS = ["ontwerpbesluit", "besluit", "aanvraag", "verlenging", "ingetrokken"]
DOCTYPES = ["ingetrokken", "verlengd", "kennisgeving", "besluit", "aanvraag"]
MARKERS = ["t.h.v.", "ter hoogte van", "nabij", "t.o.v.", "tegenover"]
VERB_STEMS = [("verplant", "verplanten"), ("herplant", "herplanten"), ("rooi", "rooien"), ("vell", "vellen"), ("kap", "kappen"), ("plant", "herplanten")]
FELLING_VERBS = ["kappen", "vellen", "rooien", "verplanten"]
REPLANT_VERBS = ["herplanten"]
UNITS = {"een": 1, "één": 1, "twee": 2, "drie": 3, "vier": 4, "vijf": 5, "zes": 6, "zeven": 7, "acht": 8, "negen": 9}
TEENS = {"tien": 10, "elf": 11, "twaalf": 12, "dertien": 13, "veertien": 14, "vijftien": 15, "zestien": 16, "zeventien": 17, "achttien": 18, "negentien": 19}
TENS = {"twintig": 20, "dertig": 30, "veertig": 40, "vijftig": 50, "zestig": 60, "zeventig": 70, "tachtig": 80, "negentig": 90}
SPELLED = UNITS | TEENS | {"twintig": 20}
COUNTLESS = ["diverse", "meerdere", "een aantal", "enkele", "verschillende", "aantal"]
NOUN = r"(?:bo{1,2}m|bomen|houtopstand(?:en)?)"
POSTCODE = r"\d{4}\s?[A-Z]{2}"
REFERENCE_KEY = "OVERHEIDop.referentienummer"
# Fixed patterns.
REFERENCE_NUMBER = r"(?i)\bOLO\s*\d+"
TREE_NUMBER = r"(?i)boomnummer\s*\d+"
CLAUSE_END = r"\s+en\s+|[,;]"
WORD = r"[A-Za-zéï'-]+"
HOUSE_NUMBER = r"(\d+)\s*[-–]?\s*([0-9A-Za-z]{1,4})?\s*$"
TITLE_POSTCODE = r"\b(\d{4})\s?([A-Za-z]{2})\b"


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _lookup(value: Column, table: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), value)


def _try_element(table: dict, value: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), value)


# XML ---------------------------------------------------------------------


_ROOT = "canopy-root"


def _rooted(xml: Column) -> Column:
    """A record in a root of its own, without a byte order mark and an XML declaration."""
    return F.concat(F.lit(f"<{_ROOT}>"), F.regexp_replace(xml, r"^\uFEFF?\s*<\?xml[^>]*\?>|^\uFEFF", ""), F.lit(f"</{_ROOT}>"))


def well_formed(xml: Column) -> Column:
    """Whether a record can be parsed; false for null and for blank text."""
    bad = F.from_xml(_rooted(xml), "_bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})["_bad"]
    return xml.isNotNull() & (F.trim(xml) != "") & ~xml.contains(_ROOT) & bad.isNull()


def xml_text(xml: Column, name: str) -> Column:
    """The first non-empty text of an element with this local name, at any depth, under any prefix; null if the record is malformed."""
    values = F.transform(F.xpath(_rooted(xml), F.lit(f'//*[local-name()="{name}"]/text()')), lambda v: F.trim(v))
    return F.when(well_formed(xml), F.get(F.filter(values, lambda v: v != ""), F.lit(0)))


def xml_attribute(xml: Column, key: str = REFERENCE_KEY) -> Column:
    """The content of the metadata entry with this name; empty if there is none or the record is malformed."""
    found = F.xpath(_rooted(xml), F.lit(f'//*[local-name()="metadata"][@name="{key}"]/@content'))
    return F.coalesce(F.when(well_formed(xml), F.get(found, F.lit(0))), F.lit(""))


def sru_total(xml: Column) -> Column:
    return F.when(well_formed(xml), F.xpath_int(_rooted(xml), F.lit('//*[local-name()="numberOfRecords"]')))


def strip_xml(xml: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(xml, "<[^>]+>", " "), r"\s+", " "))


# Titles ------------------------------------------------------------------


def title_kind(title: Column) -> Column:
    low = F.lower(F.trim(title))
    return reduce(lambda other, k: F.when(low.startswith(k), F.lit(k)).otherwise(other), reversed(KINDS), F.lit("other"))


def doctype(title: Column) -> Column:
    low = F.lower(F.coalesce(title, F.lit("")))
    return reduce(lambda other, k: F.when(low.contains(k), F.lit(k)).otherwise(other), reversed(DOCTYPES), F.lit("other"))


def title_address(title: Column) -> Column:
    """struct(postcode, huisnummer, street): the first postcode, the whole number before it, the word before that."""
    found = _blank_to_null(F.regexp_extract(title, POSTCODE, 0))
    before = F.filter(F.split(F.substring(title, F.lit(1), F.locate("\x00", F.regexp_replace(title, f"^(.*?){POSTCODE}", "$1\x00")) - 1), r"\s+"), lambda w: w != "")
    number = F.try_element_at(before, F.lit(-1)).try_cast("int")
    word = F.try_element_at(before, F.lit(-2))
    return F.struct(
        F.upper(F.replace(found, F.lit(" "), F.lit(""))).alias("postcode"),
        F.when(found.isNotNull(), number).alias("huisnummer"),
        F.when(found.isNotNull() & number.isNotNull() & word.rlike(r"^\p{L}[\p{L}'.-]*$"), word).alias("street"),
    )


def title_place(title: Column) -> Column:
    """struct(marker, street, huisnummer, suffix, postcode) from "<activity> <marker> <street> <number[-suffix]> <postcode>"."""
    t = F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"\s+", " "))
    code = TITLE_POSTCODE
    has = t.rlike(code)
    head = F.when(has, F.trim(F.regexp_extract(t, f"^(.*?){code}", 1))).otherwise(t)
    low = F.lower(head)
    marker = reduce(lambda other, m: F.when(F.instr(low, m) > 0, F.lit(m)).otherwise(other), reversed(MARKERS), F.lit(None).cast("string"))
    after = lambda m: F.trim(F.substring(head, F.instr(low, m) + len(m), F.length(head)))
    rest = reduce(lambda other, m: F.when(marker == m, after(m)).otherwise(other), MARKERS, F.when(F.instr(low, "(kap)") > 0, after("(kap)")).otherwise(head))
    ending = HOUSE_NUMBER
    number = F.regexp_extract(rest, ending, 1)
    street = F.when(rest.rlike(ending), F.trim(F.regexp_extract(rest, f"^(.*?){ending}", 1))).otherwise(rest)
    return F.struct(
        marker.alias("marker"),
        _blank_to_null(F.regexp_replace(street, r"[,\s]+$", "")).alias("street"),
        number.try_cast("int").alias("huisnummer"),
        _blank_to_null(F.regexp_extract(rest, ending, 2)).alias("suffix"),
        F.when(has, F.concat(F.regexp_extract(t, code, 1), F.upper(F.regexp_extract(t, code, 2)))).alias("postcode"),
    )


# Counts ------------------------------------------------------------------


def naive_count(text: Column) -> Column:
    """The largest whole number right before the tree noun."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)(\d+)\s*(?:bo{1,2}m|bomen)"), F.lit(1))
    return F.array_max(F.transform(found, lambda n: n.try_cast("long")))


def dutch_number(token: Column) -> Column:
    """Digits or a Dutch number word below one hundred."""
    t = F.regexp_replace(F.lower(token), r"^[.,()'\"]+|[.,()'\"]+$", "")
    compound = "^(" + "|".join(UNITS) + ")(?:en|ën)(" + "|".join(TENS) + ")$"
    both = _try_element(UNITS, F.regexp_extract(t, compound, 1)) + _try_element(TENS, F.regexp_extract(t, compound, 2))
    return F.coalesce(F.when(t.rlike(r"^\d+$"), t.try_cast("int")), _try_element(UNITS | TEENS | TENS, t), both)


def activities(text: Column) -> Column:
    """array<struct<verb, count, spelled_out, bucket>>, one per clause that states a size.

    Clauses are split on "en", commas and semicolons; a clause without a verb
    goes on with the last one, which a fold over the clauses carries along.
    """
    clean = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), REFERENCE_NUMBER, " "), TREE_NUMBER, " ")
    clean = F.trim(F.regexp_replace(clean, r"\s+", " "))
    clauses = F.filter(F.transform(F.split(clean, CLAUSE_END), lambda c: F.trim(c)), lambda c: c != "")

    def verb_of(word: Column) -> Column:
        low = F.lower(word)
        return reduce(lambda other, sv: F.when(low.startswith(sv[0]), F.lit(sv[1])).otherwise(other), reversed(VERB_STEMS), F.lit(None).cast("string"))

    def read(clause: Column) -> Column:
        low = F.lower(clause)
        verbs = F.array_compact(F.transform(F.regexp_extract_all(clause, F.lit(WORD), F.lit(0)), verb_of))
        countless = low.rlike("(?:" + "|".join(COUNTLESS) + r")\s+" + NOUN)
        token = F.regexp_replace(F.regexp_extract(low, r"(\S+)\s+" + NOUN, 1), r"^[.,()]+|[.,()]+$", "")
        digits, word = F.when(token.rlike(r"^\d+$"), token.try_cast("int")), _try_element(SPELLED, token)
        return F.struct(
            F.get(verbs, F.lit(0)).alias("verb"),
            F.when(~countless, F.coalesce(digits, word)).alias("count"),
            F.coalesce(~countless & digits.isNull() & word.isNotNull(), F.lit(False)).alias("spelled_out"),
            countless.alias("countless"),
        )

    entry = "struct<verb:string,count:int,spelled_out:boolean,bucket:string>"
    start = F.struct(F.lit(None).cast("string").alias("last"), F.array().cast(f"array<{entry}>").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        verb = F.coalesce(c["verb"], acc["last"])
        made = F.struct(verb.alias("verb"), c["count"].alias("count"), c["spelled_out"].alias("spelled_out"), F.when(c["countless"], "countless").otherwise("counted").alias("bucket"))
        keeps = verb.isNotNull() & (c["count"].isNotNull() | c["countless"])
        return F.struct(verb.alias("last"), F.when(keeps, F.concat(acc["out"], F.array(made))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.transform(clauses, read), start, step, lambda a: a["out"])


def felling_total(acts: Column) -> Column:
    counts = F.filter(F.transform(F.filter(acts, lambda a: a["verb"].isin(FELLING_VERBS)), lambda a: a["count"]), lambda n: n.isNotNull())
    return F.when(F.size(counts) > 0, F.aggregate(counts, F.lit(0), lambda s, n: s + n))


def conflated(acts: Column) -> Column:
    """Felling and replanting counts in one text."""
    some = lambda verbs: F.exists(acts, lambda a: a["verb"].isin(verbs) & a["count"].isNotNull())
    return some(FELLING_VERBS) & some(REPLANT_VERBS)


def mentions(text: Column, dutch: list[str], latin: list[str]) -> Column:
    """struct(dutch, latin, cultivar, project, numbers): what a text names."""
    of = lambda words, flag: r"%s\b(%s)\b" % (flag, "|".join(sorted(set(words), key=len, reverse=True)))
    t = F.coalesce(text, F.lit(""))
    low = F.transform(F.regexp_extract_all(t, F.lit(of(dutch, "(?i)")), F.lit(1)), lambda w: F.lower(w))
    return F.struct(
        F.array_sort(F.array_distinct(low)).alias("dutch"),
        F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(of(latin, "")), F.lit(1)))).alias("latin"),
        t.rlike(r"\b[A-Z][a-z]+\s+(?:'[^']+'|x\s+[a-z]+)").alias("cultivar"),
        _blank_to_null(F.trim(F.regexp_extract(t, r"\b[Pp]roject\w*\s+['\"]?([A-Z][\w /()-]{2,40})", 1))).alias("project"),
        F.regexp_extract_all(t, F.lit(r"(?i)boom\s*(?:nummer|nr)\.?\s*(\d+)"), F.lit(1)).alias("numbers"),
    )


# Strings -----------------------------------------------------------------


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def escape_literal(text: Column) -> Column:
    """Backslash first, then quotes and control characters."""
    pairs = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def trigrams(text: Column) -> Column:
    """Distinct 3-grams of each lower-cased word padded with two blanks before and one after."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))))


def similarity(a: Column, b: Column) -> Column:
    """Shared over all trigrams."""
    x, y = trigrams(a), trigrams(b)
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union).otherwise(F.lit(0.0))


def safe_iri(text: Column) -> Column:
    return text.isNotNull() & (text != "") & ~text.rlike("[\\x00-\\x20<>\"{}|^`\\\\]")


def publication_id(text: Column) -> Column:
    return text.rlike(r"^gmb-\d{4}-\d+$")


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 1 << 20)).otherwise(text)


def redact(text: Column) -> Column:
    """Passwords in connection strings and key=value arguments."""
    return F.regexp_replace(F.regexp_replace(text, r"(?i)(password=)\S+", "$1***"), r"(://[^:/@\s]+:)[^@\s]+@", "$1***@")


def keyword_context(text: Column, keyword: str, width: int) -> Column:
    at = F.instr(F.lower(text), keyword.lower())
    return F.when(at > 0, F.substring(text, F.greatest(at - width, F.lit(1)), F.least(at - 1, F.lit(width)) + len(keyword) + width))


def build_url(base: Column, params: dict[str, Column]) -> Column:
    pairs = [F.concat(F.lit(k + "="), F.url_encode(v)) for k, v in sorted(params.items())]
    return F.concat(base, F.lit("?"), F.concat_ws("&", *pairs))


def genus(name: Column) -> Column:
    """struct(dutch, latin genus) of "Dutch (Latin epithet)" or plain "Latin epithet"."""
    both = r"^(.*?)\s*\(([A-Z][a-z]+)[^)]*\)\s*$"
    return F.struct(
        F.when(name.rlike(both), _blank_to_null(F.regexp_extract(name, both, 1))).alias("dutch"),
        F.coalesce(_blank_to_null(F.regexp_extract(name, both, 2)), _blank_to_null(F.regexp_extract(name, r"^([A-Z][a-z]+)", 1))).alias("genus"),
    )
