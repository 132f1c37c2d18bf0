"""Landed artifacts with provenance, in one or several versions.

Layout: <root>/<name>/data or <root>/<name>/<version>, and an append-only
provenance log beside it, on any store that Spark can reach. Bytes are small
driver-side payloads as fetched; what is done with them afterwards is
distributed.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.text import publication_id, well_formed
from canopy.sources.files import Files

PROVENANCE = "source_url string, fetched_at timestamp, byte_size long, content_sha256 string, version string"
VERSION = "%Y%m%dT%H%M%SZ"
_NOT_BLANK = re.compile(r"[^ \t\r\n]").search
_NO_BRACKET = re.compile(r'"(?:[^"\\]|\\.)*"|[^][{}"]+|"')


class Landing:
    """Artifacts under a root that Spark can reach."""

    def __init__(self, root: str, clock: Callable[[], datetime] = lambda: datetime.now(UTC), spark: SparkSession | None = None):
        self.root, self.clock, self.spark = root.rstrip("/"), clock, spark

    @property
    def files(self) -> Files:
        return Files(self.spark)

    def _inside(self, name: str) -> str:
        path = posixpath.normpath(f"/{name}")
        if not name or name.startswith("/") or path == "/" or ".." in name.split("/"):
            raise ValueError(f"artifact name leaves the landing folder: {name!r}")
        return self.root + path

    def _record(self, folder: str, url: str, content: bytes, version: str) -> dict:
        row = {"source_url": url, "fetched_at": self.clock().isoformat(), "byte_size": len(content), "content_sha256": hashlib.sha256(content).hexdigest(), "version": version}
        log = f"{folder}/provenance.jsonl"
        self.files.write(log, (self.files.read(log) or b"") + (json.dumps(row) + "\n").encode())
        return row

    def land(self, name: str, url: str, content: bytes) -> dict:
        """Overwrites the bytes; provenance is appended."""
        folder = self._inside(name)
        self.files.write(f"{folder}/data", content)
        return self._record(folder, url, content, "")

    def land_version(self, name: str, url: str, content: bytes) -> dict | None:
        """A new version, unless the content is that of the latest one; an older version's content lands anew."""
        folder = self._inside(name)
        latest = self.latest_version(name)
        if latest is not None and self.files.read(f"{folder}/{latest}") == content:
            return None
        version = self.clock().strftime(VERSION)
        self.files.write(f"{folder}/{version}", content)
        return self._record(folder, url, content, version)

    def latest_version(self, name: str) -> str | None:
        return max((n for n in self.files.names(self._inside(name)) if n != "provenance.jsonl"), default=None)

    def provenance(self, spark: SparkSession, name: str) -> DataFrame:
        """Oldest first; a missing log is empty."""
        log = self._inside(name) + "/provenance.jsonl"
        if not self.files.exists(log):
            return spark.createDataFrame([], PROVENANCE)
        rows = spark.read.schema(PROVENANCE).json(log)
        return rows.withColumn("seq", F.monotonically_increasing_id()).orderBy("seq").drop("seq")


def read_records(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(id, record, metadata) of landed XML with optional sidecars, and what was skipped: (id, why), a strange name or a malformed record.

    A malformed record never fails the read; a missing folder does.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.decode("content", "UTF-8").alias("xml"))
    files = files.filter(~F.col("name").startswith("_"))
    side = files.filter(F.col("name").endswith(".metadata.xml")).select(F.regexp_replace("name", r"\.metadata\.xml$", "").alias("id"), F.col("xml").alias("metadata"))
    main = files.filter(~F.col("name").endswith(".metadata.xml")).select(F.regexp_replace("name", r"\.xml$", "").alias("id"), F.col("xml").alias("record"))
    why = F.when(~publication_id(F.col("id")), "name").when(~well_formed(F.col("record")), "malformed")
    judged = main.withColumn("why", why)
    good = judged.filter("why IS NULL").drop("why")
    empty = [(n.removesuffix(".xml"), "malformed") for n in Files(spark).empty(folder) if n.endswith(".xml") and not n.startswith("_") and not n.endswith(".metadata.xml")]
    skipped = judged.filter("why IS NOT NULL").select("id", "why").unionByName(spark.createDataFrame(empty, "id string, why string"))
    return good.join(side, "id", "left"), skipped


class _Values:
    """Top-level JSON values of one file, line by line: no more is held than the value that is open."""

    def __init__(self):
        self.decode = json.JSONDecoder().raw_decode
        self.text, self.lines, self.depth, self.count, self.passed = "", [], 0, 0, 0

    def add(self, line: str) -> list[str]:
        """The values that this line completes; brackets tell when that may be, as no string goes on over a line's end."""
        self.lines.append(line)
        brackets = _NO_BRACKET.sub("", line)
        low = self.depth
        for c in brackets:
            self.depth += 1 if c in "{[" else -1
            low = min(low, self.depth)
        return self.taken(self.depth <= 0) if low <= 0 else []

    def taken(self, whole: bool) -> list[str]:
        text, at, found = "\n".join([self.text, *self.lines] if self.text else self.lines), 0, []
        while (start := _NOT_BLANK(text, at)) is not None:
            try:
                _, end = self.decode(text, start.start())
            except json.JSONDecodeError as e:
                if not whole:
                    break  # the value goes on
                raise ValueError(f"not JSON after {self.count} values, at character {self.passed + start.start()}: {e}") from e
            found.append(text[start.start() : end])
            at, self.count = end, self.count + 1
        self.text, self.lines, self.passed = text[at:] if start else "", [], self.passed + (at if start else len(text) + 1)
        return found


def _json_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, value) in order to values; a value is handed on with a few others."""
    file, values, found, size = None, None, [], 0
    batch = lambda: pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["value"])
    for some in batches:
        for name, line in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
            if name != file:
                found += values.taken(True) if values else []
                file, values = name, _Values()
            new = values.add(line)
            found += new
            size += sum(map(len, new))
            if size > 1 << 22:
                yield batch()
                found, size = [], 0
    found += values.taken(True) if values else []
    if found:
        yield batch()


def json_values(spark: SparkSession, path: str) -> DataFrame:
    """(value): the top-level JSON values of files one after the other, whatever the lines; each as it was written.

    A file's lines come to one task in their order, so it never holds a whole file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("_metadata.file_path", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    ordered = lines.repartition("file_path").sortWithinPartitions("file_path", "block", "at")
    return ordered.select("file_path", "value").mapInArrow(_json_values, "value string")


def read_envelopes(spark: SparkSession, path: str, key: str, fields: dict[str, str]) -> DataFrame:
    """Rows of paged {"_embedded": {key: [...]}} values or of {"features": [...]}; any other envelope fails.

    Values follow one another, on one line or over several. Fields keep their digits as strings where the schema says so.
    """
    schema = f"_embedded map<string, array<struct<{', '.join(f'`{k}`: {t}' for k, t in fields.items())}>>>, features array<struct<properties: struct<{', '.join(f'`{k}`: {t}' for k, t in fields.items())}>, geometry: string>>"
    parsed = json_values(spark, path).select(F.from_json("value", schema).alias("j"))
    known = F.col("j.features").isNotNull() | F.element_at("j._embedded", key).isNotNull()
    checked = parsed.withColumn("j", F.when(known, F.col("j")).otherwise(F.raise_error(F.lit(f"unknown envelope: neither {key} nor features")).cast(parsed.schema["j"].dataType)))
    paged = checked.select(F.explode(F.element_at("j._embedded", key)).alias("r")).select(*[F.col(f"r.{k}").alias(k) for k in fields], F.lit(None).cast("string").alias("geometry"))
    featured = checked.select(F.explode("j.features").alias("f")).select(*[F.col(f"f.properties.{k}").alias(k) for k in fields], F.nullif(F.col("f.geometry"), F.lit("{}")).alias("geometry"))
    return paged.unionByName(featured)


def read_bag(spark: SparkSession, path: str, tag: str, schema: str, code: str) -> DataFrame:
    """Registry objects of one municipality out of XML, by row tag, whatever their prefixes."""
    return spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").schema(schema).load(path).filter(F.col("identificatie").like(f"%.{code}%") | F.col("identificatie").startswith(code))


def feature_collection(rows: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON document of the current rows with a geometry; for bounded area sets."""
    kept = rows.filter("eindGeldigheid IS NULL AND geometry IS NOT NULL")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.parse_json("geometry").alias("geometry"))
    return kept.agg(F.sort_array(F.collect_list(F.to_json(feature))).alias("f")).select(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("f", ","), F.lit("]}")).alias("value"))


def truncate_and_load(good: DataFrame, path: str) -> None:
    """Staging that fails as a whole."""
    good.write.mode("overwrite").parquet(path)


def stage_rows(raw: DataFrame, casts: dict[str, F.Column], path: str) -> DataFrame:
    """Staging that skips bad rows: those where a non-empty value won't cast come back with their reasons."""
    typed = raw.select("*", *[c.alias(f"_{k}") for k, c in casts.items()])
    why = F.array_compact(F.array(*[F.when(F.col(k).isNotNull() & (F.col(k) != "") & F.col(f"_{k}").isNull(), F.lit(k)) for k in casts]))
    marked = typed.withColumn("_why", why)
    marked.filter(F.size("_why") == 0).select(*[c for c in raw.columns if c not in casts], *[F.col(f"_{k}").alias(k) for k in casts]).write.mode("overwrite").parquet(path)
    return marked.filter(F.size("_why") > 0).select(*raw.columns, F.array_join("_why", ",").alias("why"))


def safe_name(name: str) -> bool:
    return re.fullmatch(r"gmb-\d{4}-\d+", name) is not None


def read_polygons(spark: SparkSession, path: str, fields: dict[str, str], srid: int = 28992) -> DataFrame:
    """GeoJSON polygon features, one collection a line, as polygons of rings of points with their reference system."""
    rows = read_envelopes(spark, path, "_none", fields)
    rings = F.from_json(F.get_json_object("geometry", "$.coordinates"), "array<array<array<double>>>")
    polygon = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    return rows.select(*fields, F.when(F.get_json_object("geometry", "$.type") == "Polygon", polygon).alias("polygon"), F.lit(srid).alias("srid"))


def stream_to_file(blocks, path: str) -> tuple[int, str]:
    """A body too large to hold, block by block; the file appears whole or not at all."""
    digest, size = hashlib.sha256(), 0

    def passing():
        nonlocal size
        for block in blocks:
            digest.update(block)
            size += len(block)
            yield block

    Files().write(path, passing())
    return size, digest.hexdigest()
