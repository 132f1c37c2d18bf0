"""Landing, pagers, archives, snapshots and streams."""

import json
import tarfile
import zipfile
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from canopy.functions import text
from canopy.sources import landing, pagers, pages, snapshots
from canopy.streaming import harvest


def ticking():
    now = datetime(2024, 1, 1, tzinfo=UTC)

    def clock():
        nonlocal now
        now += timedelta(seconds=1)
        return now

    return clock


def test_landing(spark, tmp_path):
    store = landing.Landing(str(tmp_path), ticking())
    assert store.land_version("a", "u", b"one") and store.land_version("a", "u", b"two")
    assert store.land_version("a", "u", b"two") is None
    assert store.land_version("a", "u", b"one")["version"] == store.latest_version("a")
    assert [r.byte_size for r in store.provenance(spark, "a").collect()] == [3, 3, 3] and store.provenance(spark, "none").count() == 0
    store.land("b", "u", b"x")
    store.land("b", "u", b"yy")
    assert (tmp_path / "b/data").read_bytes() == b"yy" and [r.byte_size for r in store.provenance(spark, "b").collect()] == [1, 2]
    for bad in ("../x", "", "/etc/x", "a/../../x"):
        with pytest.raises(ValueError):
            store.land(bad, "u", b"")


def test_records(spark, tmp_path):
    for name in ("gmb-2022-1.xml", "gmb-2022-1.metadata.xml", "gmb-2022-2.xml", "_skip.xml", "other.xml", "note.txt"):
        (tmp_path / name).write_text(f"<r>{name}</r>")
    good, bad = landing.read_records(spark, str(tmp_path))
    assert sorted((r.id, r.metadata is not None) for r in good.collect()) == [("gmb-2022-1", True), ("gmb-2022-2", False)]
    assert [r.id for r in bad.collect()] == ["other"]


def test_envelopes(spark, tmp_path):
    fields = {"id": "string", "soort": "string"}
    (tmp_path / "p.json").write_text('{"_embedded": {"k": [{"id": 4301189, "soort": "iep"}, {"id": 12345678901234567890}]}}\n{"_embedded": {"k": []}}\n')
    (tmp_path / "g.json").write_text('{"features": [{"properties": {"id": 7, "soort": "els"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"properties": {"id": 8}, "geometry": null}]}\n')
    assert sorted((r.id, r.soort) for r in landing.read_envelopes(spark, str(tmp_path / "p.json"), "k", fields).collect()) == [("12345678901234567890", None), ("4301189", "iep")]
    got = {r.id: r.geometry for r in landing.read_envelopes(spark, str(tmp_path / "g.json"), "k", fields).collect()}
    assert json.loads(got["7"])["coordinates"] == [1, 2] and got["8"] is None
    (tmp_path / "x.json").write_text('{"rows": []}\n')
    with pytest.raises(Exception, match="unknown envelope"):
        landing.read_envelopes(spark, str(tmp_path / "x.json"), "k", fields).collect()


def test_staging_and_features(spark, tmp_path):
    raw = spark.createDataFrame([("1", "2024-01-01"), ("2", "bad"), ("3", "")], "id string, day string")
    bad = landing.stage_rows(raw, {"day": F.try_to_date("day", "yyyy-MM-dd")}, str(tmp_path / "s"))
    assert [(r.id, r.why) for r in bad.collect()] == [("2", "day")] and spark.read.parquet(str(tmp_path / "s")).count() == 2
    rows = spark.createDataFrame([("a", None, '{"type":"Point","coordinates":[1,2]}'), ("b", "2020", "{}"), ("c", None, None)], "naam string, eindGeldigheid string, geometry string")
    assert [f["properties"]["naam"] for f in json.loads(landing.feature_collection(rows, ["naam"]).first().value)["features"]] == ["a"]


def sru_body(total, n):
    return f'<r xmlns="u"><numberOfRecords>{total}</numberOfRecords>{"<recordData><x/></recordData>" * n}</r>'.encode()


def test_pagers():
    bodies, asked, slept = [sru_body(5, 2), sru_body(5, 2), sru_body(5, 1)], [], []

    def get(url):
        asked.append(url)
        if len(asked) == 2:
            raise pagers.Transient
        return bodies.pop(0)

    assert len(list(pagers.sru(get, "http://x", "q", 2, sleep=slept.append))) == 5
    assert "startRecord=3" in asked[1] and asked[1] == asked[2] and slept.count(1.0) == 1
    assert list(pagers.sru(lambda u: sru_body(9, 0), "http://x", "q", sleep=slept.append)) == []

    def down(url):
        raise pagers.Transient

    waits = []
    with pytest.raises(pagers.Transient):
        pagers.with_retries(down, "u", sleep=waits.append)
    assert waits == [1, 2, 4, 8, 16, 30, 30]
    pages = {"a": {"_links": {"next": {"href": "b"}}, "n": 1}, "b": {"n": 2}}
    assert [p["n"] for p in pagers.hal(lambda u: json.dumps(pages[u]).encode(), "a")] == [1, 2]
    rows = lambda u: json.dumps({"_embedded": {"k": [{}] * (3 if u.endswith("page=1") else 1)}}).encode()
    assert [len(p) for p in pagers.numbered(rows, "u", "k", 3)] == [3, 1]
    feeds = {"http://x/a.xml": b'<feed><link href="b.xml"/></feed>', "http://x/b.xml": b'<feed><link href="c.xml"/><link href="d.zip"/></feed>'}
    assert pagers.atom_download(feeds.__getitem__, "http://x/a.xml") == "http://x/d.zip"
    assert "PropertyIsEqualTo" in pagers.wfs_url("http://x", "l", "f", "GM0363")
    assert pagers.select_sources(["a", "b"], []) == ["a", "b"] and pagers.select_sources(["a", "b"], ["b"]) == ["b"]
    with pytest.raises(ValueError):
        pagers.select_sources(["a"], ["z"])


def test_breaker():
    def get(url):
        if url == "gone":
            raise pagers.Missing
        if url == "down":
            raise pagers.Transient
        return b"x"

    ids = [("1", "ok"), ("2", "gone"), ("3", "down"), ("4", "ok"), ("5", "down"), ("6", "down"), ("7", "ok")]
    take = lambda breaker: [k for k, _ in pagers.sidecars(get, iter(ids), lambda n: n != "4x", breaker, sleep=lambda s: None)]
    assert take(2) == ["1", "2", "4"] and take(0) == ["1", "2", "4", "7"]


def test_snapshots(spark, tmp_path):
    tables = {"t": spark.range(5).toDF("id"), "bag_x": spark.range(3).toDF("id")}
    at = str(tmp_path / "snap")
    snapshots.export(tables, at, skip=("bag_x",))
    assert snapshots.restore(spark, at, str(tmp_path / "out")) == ["t"] and spark.read.parquet(str(tmp_path / "out/t")).count() == 5
    f = next((tmp_path / "snap/t").glob("*.parquet"))
    f.write_bytes(f.read_bytes()[:-1] + b"?")
    with pytest.raises(ValueError, match="checksum"):
        snapshots.restore(spark, at, str(tmp_path / "out2"))
    assert not (tmp_path / "out2").exists()


def test_graph_text(spark, tmp_path):
    quads = spark.createDataFrame([("run:1", "id:a", "rdf:type", "ns:T"), ("run:1", "id:a", "rdfs:label", 'say "x"\\n\n\t'), ("run:2", "id:b", "rdf:type", "ns:T")], "graph string, s string, p string, o string")
    snapshots.write_graph(quads, str(tmp_path / "g"))
    back = snapshots.parse_nquads(spark.read.text(str(tmp_path / "g")))
    rows = lambda df: sorted(map(tuple, df.select("graph", "s", "p", "o").collect()))
    assert rows(back) == rows(quads)
    live = spark.createDataFrame([("run:1", "id:z", "rdf:type", "ns:T"), ("run:9", "id:y", "rdf:type", "ns:T")], quads.schema)
    assert {r[0] + r[1] for r in rows(snapshots.restore_graph(live, back))} == {"run:1id:a", "run:2id:b", "run:9id:y"}
    assert snapshots.turtle(quads).filter("s = 'id:b'").first().turtle == "<id:b>\n    <rdf:type> <ns:T> ."


def test_archives(tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/x").write_text("1")
    snapshots.capture(str(tmp_path / "c"), str(tmp_path / "c.tgz"))
    snapshots.release(str(tmp_path / "c.tgz"), str(tmp_path / "d"))
    assert (tmp_path / "d/x").read_text() == "1"
    snapshots.capture(str(tmp_path / "none"), str(tmp_path / "e.tgz"))
    snapshots.release(str(tmp_path / "e.tgz"), str(tmp_path / "f"))
    with tarfile.open(tmp_path / "bad.tgz", "w:gz") as t:
        t.add(tmp_path / "c/x", arcname="../evil")
    with pytest.raises(ValueError):
        snapshots.release(str(tmp_path / "bad.tgz"), str(tmp_path / "g"))
    with zipfile.ZipFile(tmp_path / "o.zip", "w") as z:
        z.writestr("x/9999NUM01.zip", b"inner")
        z.writestr("9999VBO01.zip", b"other")
    assert snapshots.inner_zip(str(tmp_path / "o.zip"), str(tmp_path / "z"), "NUM").read_bytes() == b"inner"
    with pytest.raises(FileNotFoundError):
        snapshots.inner_zip(str(tmp_path / "o.zip"), str(tmp_path / "z"), "PND")


def test_vocabulary(spark):
    names = spark.createDataFrame([("Zomereik (Quercus robur)",), ("Quercus petraea",), ("Acer campestre",), ("onbekend",)], "name string")
    got = {r.concept: (r.label, r.notations, r.alt) for r in snapshots.vocabulary(names, "s").collect()}
    assert got == {"s/quercus": ("Zomereik", ["Quercus petraea", "Zomereik (Quercus robur)"], "Quercus"), "s/acer": ("Acer", ["Acer campestre"], None)}


def test_cursor(spark, tmp_path):
    c = harvest.Cursor(str(tmp_path / "cursor.json"))
    assert c.read() == "2021-01-01" and c.since(spark) == "2021-01-01"
    rows = spark.createDataFrame([("2022-03-10",), ("2021-01-01",), ("broken",), ("9999-99-99",)], "available string")
    assert c.advance(rows) == "2022-03-10" and c.since(spark) == "2022-03-03"
    assert c.advance(rows.filter("available < '2022'")) == "2022-03-10" and c.advance(rows.limit(0)) == "2022-03-10"


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    schema = "id long, ts string, v string"
    src = str(tmp_path / "src")
    call = lambda: harvest.harvest_stream(spark, src, schema, str(tmp_path / "target"), str(tmp_path / "check"), ["id"], "ts")
    spark.createDataFrame([(1, "1", "a"), (2, "1", "b")], schema).write.mode("append").parquet(src)
    assert sorted((r.id, r.v) for r in call().collect()) == [(1, "a"), (2, "b")]
    spark.createDataFrame([(2, "2", "B"), (1, "0", "late"), (3, "1", "c")], schema).write.mode("append").parquet(src)
    want = [(1, "a"), (2, "B"), (3, "c")]
    assert sorted((r.id, r.v) for r in call().collect()) == want and sorted((r.id, r.v) for r in call().collect()) == want


def test_polygons_bodies_and_commits(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"features": [{"properties": {"code": "N1"}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[4,0],[4,4],[0,0]]]}}]}\n')
    row = landing.read_polygons(spark, str(tmp_path / "a.json"), {"code": "string"}).first()
    assert row.code == "N1" and row.srid == 28992 and row.polygon[0][1].x == 4.0 and len(row.polygon[0]) == 4
    size, _ = landing.stream_to_file(iter([b"ab", b"c"]), str(tmp_path / "body"))
    assert size == 3 and (tmp_path / "body").read_bytes() == b"abc" and not (tmp_path / "body.part").exists()
    root = str(tmp_path / "db")
    snapshots.commit_tables(spark, {"a": spark.range(2), "b": spark.range(3)}, root)
    snapshots.commit_tables(spark, {"a": spark.read.parquet(f"{root}/a").unionByName(spark.range(5, 6))}, root)
    assert (spark.read.parquet(f"{root}/a").count(), spark.read.parquet(f"{root}/b").count()) == (3, 3)
    snapshots.reset_tables(spark, ["a"], root)
    assert not (tmp_path / "db/a").exists() and (tmp_path / "db/b").exists()


def test_registry_xml(spark, tmp_path):
    rows = "".join(f"<o:Nummer><o:identificatie>{i}</o:identificatie><o:huisnummer>{k}</o:huisnummer></o:Nummer>" for k, i in enumerate(("NL.0363.1", "NL.0999.1", "0363200000")))
    (tmp_path / "n.xml").write_text(f'<x xmlns:o="u">{rows}</x>')
    got = landing.read_bag(spark, str(tmp_path / "n.xml"), "Nummer", "identificatie string, huisnummer int", "0363")
    assert sorted((r.identificatie, r.huisnummer) for r in got.collect()) == [("0363200000", 2), ("NL.0363.1", 0)]


def test_bad_records_are_set_aside(spark, tmp_path):
    texts = {"gmb-2022-1": "<r>ok</r>", "gmb-2022-2": "<r><title>x</r>", "gmb-2022-3": "", "gmb-2022-4": '<?xml version="1.0"?>\n<r><x:title>y</x:title></r>', "odd": "<r/>"}
    for name, body in texts.items():
        (tmp_path / f"{name}.xml").write_text(body)
    (tmp_path / "gmb-2022-4.metadata.xml").write_text("<m><broken")
    good, bad = landing.read_records(spark, str(tmp_path))
    assert {r.id: r.why for r in bad.collect()} == {"gmb-2022-2": "malformed", "gmb-2022-3": "malformed", "odd": "name"}
    got = {r.id: (r.t, r.a) for r in good.select("id", text.xml_text(F.col("record"), "title").alias("t"), text.xml_attribute(F.col("metadata")).alias("a")).collect()}
    assert got == {"gmb-2022-1": (None, ""), "gmb-2022-4": ("y", "")}
    with pytest.raises(Exception, match="(?i)path"):
        landing.read_records(spark, str(tmp_path / "absent"))[0].collect()


def test_json_values_follow_one_another(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": "}{"}{"b":\n [1,\n 2]}\n\n  3 "x"[4.10]')
    assert sorted(r.value for r in landing.json_values(spark, str(tmp_path / "a.json")).collect()) == sorted(['{"a": "}{"}', '{"b":\n [1,\n 2]}', "3", '"x"', "[4.10]"])
    (tmp_path / "b.json").write_text('{"a": 1} {"b": ')
    with pytest.raises(Exception, match="not JSON after 1 values"):
        landing.json_values(spark, str(tmp_path / "b.json")).collect()
    (tmp_path / "c.json").write_text(" \n")
    assert landing.json_values(spark, str(tmp_path / "c.json")).collect() == []


def test_search_spans(spark):
    def get(url):
        start, most = (int(url.split(f"{k}=")[1].split("&")[0]) for k in ("startRecord", "maximumRecords"))
        rows = range(start, min(start + min(most, 2), 8))
        return f'<r><numberOfRecords>7</numberOfRecords>{"".join(f"<recordData>{k}</recordData>" for k in rows)}</r>'.encode()

    out = pages.sru(spark, get, "http://x", "q", page=3, span=4, pace=0.0)
    assert sorted((r.page, r.value) for r in out.collect()) == [(k, f"<recordData>{k}</recordData>") for k in range(1, 8)] and out.rdd.getNumPartitions() == 2
    none = pages.sru(spark, lambda u: b"<r><numberOfRecords>0</numberOfRecords></r>", "http://x", "q", pace=0.0)
    assert none.collect() == []
