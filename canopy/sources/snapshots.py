"""Snapshots: tables as files with a manifest that is written last and checked first; archives of plain folders."""

from __future__ import annotations

import json
import re
import shutil
import tarfile
import zipfile
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.sources.files import Files

FORMAT, TOOL = 1, "canopy"


def _sums(spark: SparkSession, folder: str) -> dict[str, tuple[int, str]]:
    """Size and checksum of each data file of a table, worked out where Spark reads them."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length", F.sha2("content", 256).alias("sha"))
    return {r["name"]: (r["length"], r["sha"]) for r in rows.collect()}  # a row a file


def export(tables: dict[str, DataFrame], folder: str, skip: tuple[str, ...] = ()) -> dict:
    """Writes each table that isn't skipped, then the manifest."""
    artifacts = []
    for name, df in sorted(tables.items()):
        if name in skip:
            continue
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        for file, (size, sha) in sorted(_sums(df.sparkSession, f"{folder}/{name}").items()):
            artifacts.append({"filename": f"{name}/{file}", "table": name, "format": "parquet", "size": size, "sha256": sha})
    manifest = {"format_version": FORMAT, "created_at": datetime.now(UTC).isoformat(), "tool_version": TOOL, "skipped": list(skip), "artifacts": artifacts}
    Files().write(f"{folder}/manifest.json", json.dumps(manifest, indent=1).encode())
    return manifest


def verify(spark: SparkSession, folder: str) -> dict:
    """The manifest, once every file's size and checksum agree with it."""
    manifest = json.loads(Files(spark).read(f"{folder}/manifest.json") or b"{}")
    if manifest.get("format_version") != FORMAT:
        raise ValueError(f"unknown snapshot format {manifest.get('format_version')}")
    for a in manifest["artifacts"]:
        if a["filename"].split("/") != [a["table"], a["filename"].rpartition("/")[2]] or a["table"] in ("", ".", ".."):
            raise ValueError(f"artifact leaves the snapshot: {a['filename']}")
    for name in sorted({a["table"] for a in manifest["artifacts"]}):
        try:
            found = _sums(spark, f"{folder}/{name}")
        except Exception as e:  # a store with checksums of its own may refuse to read a damaged file
            raise ValueError(f"size or checksum differs: {name} can't be read") from e
        for a in manifest["artifacts"]:
            if a["table"] == name and found.get(a["filename"].rpartition("/")[2]) != (a["size"], a["sha256"]):
                raise ValueError(f"size or checksum differs: {a['filename']}")
    return manifest


def restore(spark: SparkSession, folder: str, target: str) -> list[str]:
    """Replaces only the tables the snapshot names; nothing is touched before all of it is verified."""
    names = sorted({a["table"] for a in verify(spark, folder)["artifacts"]})
    for n in names:
        spark.read.parquet(f"{folder}/{n}").write.mode("overwrite").parquet(f"{target}/{n}")
    return names


def nquads(quads: DataFrame) -> DataFrame:
    """One N-Quads line per row, literals escaped; IRIs are told by their scheme or prefix."""
    from canopy.functions.text import escape_literal

    iri = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    is_iri = F.col("o").rlike(r"^[a-z][a-z0-9+.-]*:\S*$")
    term = F.when(is_iri, iri(F.col("o"))).otherwise(F.concat(F.lit('"'), escape_literal(F.col("o")), F.lit('"')))
    return quads.select(F.concat_ws(" ", iri(F.col("s")), iri(F.col("p")), term, iri(F.col("graph")), F.lit(".")).alias("value"))


def parse_nquads(lines: DataFrame) -> DataFrame:
    pattern = r'^<([^>]*)> <([^>]*)> (?:<([^>]*)>|"((?:[^"\\]|\\.)*)") <([^>]*)> \.$'
    part = lambda k: F.regexp_extract("value", pattern, k)
    plain = part(4)
    for code, char in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"')):
        plain = F.replace(F.replace(plain, F.lit("\\\\"), F.lit("\x00")), F.lit(code), F.lit(char))
    plain = F.replace(plain, F.lit("\x00"), F.lit("\\"))
    return lines.select(part(5).alias("graph"), part(1).alias("s"), part(2).alias("p"), F.when(part(3) != "", part(3)).otherwise(plain).alias("o"))


def write_graph(quads: DataFrame, path: str) -> None:
    nquads(quads).write.mode("overwrite").option("compression", "gzip").text(path)


def restore_graph(live: DataFrame, dump: DataFrame) -> DataFrame:
    """The dump's graphs take the place of those of the same name; others stay."""
    named = dump.select("graph").distinct()
    return live.join(named, "graph", "left_anti").unionByName(dump)


def turtle(quads: DataFrame) -> DataFrame:
    """Triples grouped by subject in a stable order, one block a row."""
    iri = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    from canopy.functions.text import escape_literal

    is_iri = F.col("o").rlike(r"^[a-z][a-z0-9+.-]*:\S*$")
    po = F.concat(iri(F.col("p")), F.lit(" "), F.when(is_iri, iri(F.col("o"))).otherwise(F.concat(F.lit('"'), escape_literal(F.col("o")), F.lit('"'))))
    blocks = quads.select("s", po.alias("po")).groupBy("s").agg(F.array_join(F.array_sort(F.collect_set("po")), " ;\n    ").alias("body"))
    return blocks.select("s", F.concat(iri(F.col("s")), F.lit("\n    "), "body", F.lit(" .")).alias("turtle"))


def capture(folder: str, archive: str) -> None:
    """A folder as .tar.gz; an absent one gives a valid empty archive."""
    with tarfile.open(archive, "w:gz") as out:
        root = Path(folder)
        for f in sorted(root.rglob("*")) if root.exists() else []:
            if f.is_file():
                out.add(f, arcname=str(f.relative_to(root)))


def release(archive: str, folder: str) -> None:
    """Adds an archive's files to a folder; paths that leave it are refused before any is written."""
    root = Path(folder).resolve()
    with tarfile.open(archive, "r:gz") as got:
        members = got.getmembers()
        for m in members:
            if not m.isfile() or root not in (root / m.name).resolve().parents:
                raise ValueError(f"refused: {m.name}")
        for m in members:
            to = root / m.name
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_bytes(got.extractfile(m).read())


def inner_zip(outer: str, folder: str, code: str) -> Path:
    """The member named 9999<code>*.zip of an archive, extracted once and as a whole."""
    with zipfile.ZipFile(outer) as z:
        name = next((n for n in sorted(z.namelist()) if re.fullmatch(rf"9999{code}.*\.zip", n.rpartition("/")[2])), None)
        if name is None:
            raise FileNotFoundError(f"no member 9999{code}*.zip")
        to = Path(folder) / name.rpartition("/")[2]
        if not to.exists():
            to.parent.mkdir(parents=True, exist_ok=True)
            part = to.with_suffix(".part")
            with z.open(name) as src, part.open("wb") as dst:
                shutil.copyfileobj(src, dst)
            part.rename(to)
        return to


def vocabulary(names: DataFrame, scheme: str) -> DataFrame:
    """(concept, label, notations, alt): genera out of "Dutch (Latin epithet)" names, a Dutch label winning over the Latin one."""
    from canopy.functions.text import genus, slug

    g = names.select(F.col("name"), genus(F.col("name")).alias("g")).filter("g.genus IS NOT NULL")
    grouped = g.groupBy("g.genus").agg(F.min("g.dutch").alias("dutch"), F.array_sort(F.collect_set("name")).alias("notations"))
    return grouped.select(F.concat(F.lit(scheme + "/"), slug(F.col("genus"))).alias("concept"), F.coalesce("dutch", "genus").alias("label"), "notations", F.when(F.col("dutch").isNotNull(), F.col("genus")).alias("alt"))


def commit_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> None:
    """Several tables at once: all are written beside the old ones before any is swapped in."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/_next/{name}")
    for name in tables:
        Files(spark).move(f"{root}/_next/{name}", f"{root}/{name}")


def reset_tables(spark: SparkSession, names: list[str], root: str) -> None:
    """Drops target tables; staging and other tables stay."""
    for name in names:
        Files(spark).delete(f"{root}/{name}")
