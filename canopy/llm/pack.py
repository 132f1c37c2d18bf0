"""Best-fit packing by minimum bin slack.

Texts become token ids; longer ones are cut into pieces of the sequence
length. How full bins can get depends only on how many pieces of each length
there are, so minimum bin slack runs on that histogram (at most one entry a
length, whatever the corpus): for each bin a bitset holds the sums that the
lengths still there can reach, the fullest one that takes in the longest
length left is traced back to its lengths, and this bin is repeated as often
as the lengths allow before they are removed. Pieces then take their places
by their rank among the pieces of their length, which is found from counts by
partition, so no task ever holds all pieces of a length.

Defined cases: a null text is empty and gives the one closing id; an empty
table gives no rows; rows that repeat are packed as often as they occur; a
row with a null identifier is packed like any other; a very long text fills as
many sequences as it needs; pieces of one length take their places in any
order; other columns are not looked at.
"""

from __future__ import annotations

import gc
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopy.llm._store import Work, table

LENGTH = 2048
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 600_000
CACHED_BYTES = 64
# Fixed values of the vocabulary's own pattern: letters, and marks that are neither letters, digits nor apostrophes.
LATIN = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß"
_MARKS = r"[!-&(-/:-@\[-`{-~]*"
PLAIN = re.compile(f"({_MARKS})([{LATIN}]*)({_MARKS})").fullmatch

_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, seat long"


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Token ids of whole texts, as little-endian 32-bit words.

    The tokenizer drops ASCII white space and never joins across it, so a text's
    ids are those of its space-separated chunks in a row; a chunk seen before is
    looked up. A chunk of Latin letters between ASCII marks is cut as the
    tokenizer's own pattern cuts it, so that its letters are shared with other
    spellings and go to the merges straight away; any other chunk takes the whole
    way. The tables are emptied when full, which costs time and changes nothing.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in LATIN}
        self.seen: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            if len(self.parts) > CACHED_WORDS:
                self.parts = {"": b""}
            tokens = self.merge(part if part.isascii() else part.translate(self.bytes))
            found = self.parts[part] = _packed([t.id for t in tokens])
        return found

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        found = PLAIN(text.lower()) if len(chunk) <= CACHED_BYTES and b"<|" not in chunk else None
        if found is None:
            ids = _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        else:
            parts, (lead, core, tail) = self.parts, found.groups()
            middle = parts.get(core)
            ids = self._part(core) if middle is None else middle
            if lead or tail:
                ids = self._part(lead) + ids + self._part(tail)
        if len(chunk) <= CACHED_BYTES:
            if len(self.seen) > CACHED_WORDS:
                self.seen.clear()
            self.seen[chunk] = ids
        return ids

    def __call__(self, text: bytes) -> bytes:
        known = self.seen.get
        return b"".join([known(c) or self._chunk(c) for c in text.split()])


def _piece_maker(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        collecting = gc.isenabled()
        gc.disable()  # the tables below are large and hold no cycles
        try:
            yield from cut(batches)
        finally:  # the worker is used again
            if collecting:
                gc.enable()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), Encoder(path)
        seats = np.zeros(length + 1, np.int64)
        for batch in batches:
            doc, piece, start, size, crc, seat = [], [], [], [], [], []
            texts = batch.column("text").cast(pa.binary())
            for who, text in zip(batch.column("doc_id"), texts, strict=True):
                ids = encode(text.as_py() or b"") + b"\0\0\0\0"
                who = who.as_py()
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    cut = ids[at : at + 4 * length]
                    n = len(cut) // 4
                    doc.append(who)
                    piece.append(k)
                    start.append(at // 4)
                    size.append(n)
                    crc.append(zlib.crc32(cut))
                    seat.append(seats[n])
                    seats[n] += 1
            if doc:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
                cols = (doc, piece, start, size, crc, [part] * len(doc), seat)
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "seat"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return run


def fullest_bin(left: dict[int, int], room: int) -> dict[int, int]:
    """The combination of the longest length left with others that wastes least.

    reach[k] is a bitset of the sums reachable with the first k item groups;
    counts are split in powers of two, so each group is one shift.
    """
    lead = max(left)
    space = room - lead
    mask = (1 << (space + 1)) - 1
    reach, groups = [1], []
    for size in sorted(left, reverse=True):
        count = min(left[size] - (size == lead), space // size)
        k = 1
        while count > 0:
            take = min(k, count)
            now = reach[-1] | (reach[-1] << (size * take)) & mask
            count -= take
            k *= 2
            if now != reach[-1]:
                reach.append(now)
                groups.append((size, take))
        if reach[-1] >> space & 1:
            break
    total = reach[-1].bit_length() - 1
    used = {lead: 1}
    for (size, take), before in zip(reversed(groups), reversed(reach[:-1]), strict=True):
        if not before >> total & 1:
            total -= size * take
            used[size] = used.get(size, 0) + take
    return used


def minimum_bin_slack(counts: dict[int, int], room: int) -> list[tuple[int, dict[int, int]]]:
    """(how often, the lengths in it) for each kind of bin."""
    left = {s: c for s, c in counts.items() if c > 0}
    bins = []
    while left:
        used = fullest_bin(left, room)
        times = min(left[s] // u for s, u in used.items())
        bins.append((times, used))
        for s, u in used.items():
            left[s] -= times * u
            if not left[s]:
                del left[s]
    return bins


def _seating(bins: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first bin, how many in a bin, first offset)."""
    rows: dict[int, list] = {}
    rank: dict[int, int] = {}
    first = 0
    for times, used in bins:
        offset = 0
        for size in sorted(used, reverse=True):
            n = used[size]
            rows.setdefault(size, []).append((rank.get(size, 0), first, n, offset))
            rank[size] = rank.get(size, 0) + times * n
            offset += size * n
        first += times
    return {s: np.array(r, np.int64) for s, r in rows.items()}


def _seater(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seating = shared.value
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            bin_id, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                rows, own = seating[int(s)], np.flatnonzero(size == s)
                of = rows[np.searchsorted(rows[:, 0], rank[own], "right") - 1]
                past = rank[own] - of[:, 0]
                bin_id[own] = of[:, 1] + past // of[:, 2]
                offset[own] = of[:, 3] + past % of[:, 2] * s
            cols = [batch.column(c) for c in ("doc_id", "piece", "start")] + [pa.array(size, pa.int64()), batch.column("ids_crc32"), pa.array(bin_id), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """A row per piece of docs(doc_id, text) with its sequence and offset."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    work = Work(spark, "pack")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = work.save(source.mapInArrow(_piece_maker(vocabulary, length), _PIECES), "pieces")
    held = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = held.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # At most one row for each length.
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(_seating(minimum_bin_slack(counts, length)))
    ranked = pieces.join(start, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("seat")).alias("rank"))
    return ranked.mapInArrow(_seater(shared), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op5_pack": op5_pack}
ORACLE: dict[str, str] = {}
