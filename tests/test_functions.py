"""Column expressions against worked examples."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from canopy.functions import dates, spatial, text

XML = '<gzd:record><gzd:meta><dcterms:title> </dcterms:title><dcterms:title> Besluit kap Örehof 8 1024BB </dcterms:title></gzd:meta><x:geometrie>POINT(122000 490000.5)</x:geometrie><t:activiteit>kappen</t:activiteit></gzd:record>'


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def plain(x):
    if hasattr(x, "asDict"):
        return {k: plain(v) for k, v in x.asDict().items()}
    return [plain(v) for v in x] if isinstance(x, list) else x


def test_xml(spark):
    x = F.lit(XML.replace("gzd:", "").replace("dcterms:", "").replace("x:", "").replace("t:", ""))
    assert one(spark, text.xml_text(x, "title"), text.xml_text(x, "absent"), text.xml_text(x, "activiteit")) == ("Besluit kap Örehof 8 1024BB", None, "kappen")
    assert plain(one(spark, spatial.point_from_wkt(text.xml_text(x, "geometrie")))[0]) == {"x": 122000.0, "y": 490000.5}
    side = F.lit('<meta><metadata name="a" content="b"/><metadata name="OVERHEIDop.referentienummer" content="Z1"/></meta>')
    assert one(spark, text.xml_attribute(side), text.xml_attribute(F.lit("<m/>"))) == ("Z1", "")
    sru = F.lit("<r><numberOfRecords>17</numberOfRecords></r>")
    assert one(spark, text.sru_total(sru), text.strip_xml(F.lit("<a>x <b>y</b>\n</a>"))) == (17, "x y")


def test_undeclared_prefixes(spark):
    assert one(spark, text.xml_text(F.lit(XML), "title")) == ("Besluit kap Örehof 8 1024BB",)


@pytest.mark.parametrize("title, want", [
    ("Besluit kap Örehof 8 1024BB Amsterdam", ("1024BB", 8, "Örehof")), ("Besluit kap Örehof 8-H 1024 BB", ("1024BB", None, None)), ("1024BB", ("1024BB", None, None)),
    ("geen postcode 8", (None, None, None)), ("x 9a 8 1024BB", ("1024BB", 8, None)), ("8 1024BB en 9 1025CC", ("1024BB", 8, None)),
])
def test_title_address(spark, title, want):
    assert tuple(plain(one(spark, text.title_address(F.lit(title)))[0]).values()) == want


def test_titles(spark):
    kinds = {" Ontwerpbesluit x": "ontwerpbesluit", "BESLUIT": "besluit", "aanvraag": "aanvraag", "Verlenging": "verlenging", "ingetrokken": "ingetrokken", "een besluit": "other"}
    assert one(spark, *[text.title_kind(F.lit(t)) for t in kinds]) == tuple(kinds.values())
    assert one(spark, text.doctype(F.lit("Kennisgeving besluit")), text.doctype(F.lit(None).cast("string"))) == ("kennisgeving", "other")
    place = lambda t: plain(one(spark, text.title_place(F.lit(t)))[0])
    assert place("Omgevingsvergunning kap nabij  Damrak 12-2 1012 lg Amsterdam") == {"marker": "nabij", "street": "Damrak", "huisnummer": 12, "suffix": "2", "postcode": "1012LG"}
    assert place("Aanvraag (kap) Lange Straat 5 1012AB") == {"marker": None, "street": "Lange Straat", "huisnummer": 5, "suffix": None, "postcode": "1012AB"}
    assert place("zonder nummer") == {"marker": None, "street": "zonder nummer", "huisnummer": None, "suffix": None, "postcode": None}


def test_abstracts(spark):
    acts = lambda t: [tuple(a.values()) for a in plain(one(spark, text.activities(F.lit(t).cast("string")))[0])]
    assert acts("het kappen van 33 bomen en het herplanten van vier bomen") == [("kappen", 33, False, "counted"), ("herplanten", 4, True, "counted")]
    assert acts("kappen van een boom, diverse bomen; OLO 123456") == [("kappen", 1, True, "counted"), ("kappen", None, False, "countless")]
    assert acts("vellen 7 houtopstanden boomnummer 99") == [("vellen", 7, False, "counted")]
    assert acts(None) == acts("") == acts("12 bomen") == acts("kappen zonder aantal") == []
    both = F.lit("kappen van 3 bomen en verplanten van 2 bomen en herplanten van 5 bomen")
    assert one(spark, text.felling_total(text.activities(both)), text.conflated(text.activities(both)), text.felling_total(text.activities(F.lit("x")))) == (5, True, None)
    assert one(spark, text.naive_count(F.lit("12 bomen, 3 boom")), text.naive_count(F.lit("geen"))) == (12, None)
    numbers = {"44": 44, "vierenveertig": 44, "tweeëntwintig": 22, "zestien,": 16, "negentig": 90, "honderd": None, "een": 1}
    assert one(spark, *[text.dutch_number(F.lit(n)) for n in numbers]) == tuple(numbers.values())


def test_mentions(spark):
    got = plain(one(spark, text.mentions(F.lit("Ulmus x hollandica en ELS, els; project 'Noord Oever' boomnr. 12"), ["els", "iep"], ["Ulmus", "Acer"]))[0])
    assert got == {"dutch": ["els"], "latin": ["Ulmus"], "cultivar": True, "project": "Noord Oever", "numbers": ["12"]}


def test_strings(spark):
    assert one(spark, text.slug(F.lit(" Zomer-eik (Quercus) ")), text.escape_literal(F.lit('a\\"\n'))) == ("zomer-eik-quercus", 'a\\\\\\"\\n')
    assert one(spark, text.safe_iri(F.lit("a:b")), text.safe_iri(F.lit("a b")), text.safe_iri(F.lit("a>b")), text.publication_id(F.lit("gmb-2022-1")), text.publication_id(F.lit("../x"))) == (True, False, False, True, False)
    assert one(spark, text.redact(F.lit("PG:host=h password=s x")), text.redact(F.lit("postgres://u:pw@h/db"))) == ("PG:host=h password=*** x", "postgres://u:***@h/db")
    sim = one(spark, text.similarity(F.lit("word"), F.lit("words")), text.similarity(F.lit(""), F.lit("")))
    assert abs(sim[0] - 4 / 7) < 1e-9 and sim[1] == 0
    assert plain(one(spark, text.genus(F.lit("Zomereik (Quercus robur)")), text.genus(F.lit("Acer campestre")))[0]) == {"dutch": "Zomereik", "genus": "Quercus"}
    assert one(spark, text.keyword_context(F.lit("abc tree def"), "tree", 2)) == ("c tree d",)


def test_dates(spark):
    d = lambda s: F.lit(s).cast("date")
    assert one(spark, dates.plus_years(d("2020-02-29"), 3), dates.plus_years(d("2020-02-29"), 4), dates.plus_years(d("2021-12-31"), 3)) == (date(2023, 3, 1), date(2024, 2, 29), date(2024, 12, 31))
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(spark, *[dates.in_window(t(x), d("2021-01-01")) for x in ("2021-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-01 00:00:01", "2020-12-31 23:59:59")]) == (True, True, False, False)
    assert one(spark, dates.lenient_date(F.lit("2021-05-06T07:08:09Z")), dates.lenient_date(F.lit("2021-05-06")), dates.lenient_date(F.lit("no"))) == (date(2021, 5, 6), date(2021, 5, 6), None)
    assert one(spark, dates.since(d("2021-01-03")), dates.since(d("2022-01-10")), dates.since(F.lit(None).cast("date"))) == (date(2021, 1, 1), date(2022, 1, 3), date(2021, 1, 1))


SQUARE, HOLE = [(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]


def ring(points):
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def test_polygons(spark):
    poly = F.array(ring(SQUARE), ring(HOLE))
    cases = {(5, 1): True, (5, 5): False, (0, 5): False, (10, 10): False, (4, 5): False, (11, 5): False, (-1, 10): False, (3, 4): True, (7, 10): False}
    assert one(spark, *[spatial.contains(poly, F.lit(float(x)), F.lit(float(y))) for x, y in cases]) == tuple(cases.values())
    assert plain(one(spark, spatial.centroid(ring([(0, 0), (9, 0), (0, 9)])))[0]) == {"x": 3.0, "y": 3.0}
    lshape = plain(one(spark, spatial.centroid(ring([(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4), (0, 0)])))[0])
    assert abs(lshape["x"] - 9.5 / 7) < 1e-9 and lshape["x"] == lshape["y"]


def test_projection(spark):
    got = plain(one(spark, spatial.rd_from_wgs84(F.lit(5.38720621), F.lit(52.15517440)), spatial.rd_from_wgs84(F.lit(4.90093), F.lit(52.37298)))[0])
    assert got == {"x": 155000.0, "y": 463000.0}
    dam = plain(one(spark, spatial.rd_from_wgs84(F.lit(4.893056), F.lit(52.373056)))[0])
    assert abs(dam["x"] - 121394) < 60 and abs(dam["y"] - 487383) < 60


def test_points(spark):
    assert plain(one(spark, spatial.point_from_ewkt(spatial.ewkt(F.lit(1.5), F.lit(2.0))))[0]) == {"srid": 28992, "x": 1.5, "y": 2.0}
    geo = lambda s: plain(one(spark, spatial.point_from_geojson(F.lit(s).cast("string")))[0])
    assert geo('{"type":"Point","coordinates":[4.9,52.3]}') == {"x": 4.9, "y": 52.3} and geo("{}") is None and geo(None) is None
