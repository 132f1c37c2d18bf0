"""Substring dedup with suffix automata over sharded reference spans.

A word goes if a window of LENGTH words around it also starts in a document
with a smaller identifier. Which reference spans can matter for a window is
settled by its anchor, the ANCHOR-word sequence with the smallest hash in it:
equal windows have equal anchors. Consecutive windows with one anchor form a
segment. Anchors held by one document only are left out; for the rest, the
distinct segments of an anchor, if there are several, are brought together as
a reference shard, a suffix automaton is built over its words, each state knowing the smallest
identifier that holds its substrings, and the segments are streamed through
it for matching statistics cut at LENGTH. So a shard meets only segments that
can match it, and the automata never hold the whole corpus, which grows with
the data and can't be broadcast.

Segments are told apart by a 128-bit digest of their words, made of two hashes
that aren't linear in the letters; windows of several segments are compared
word by word in the automaton or the aggregate. An anchor with one distinct
segment needs no automaton: it would give back the segment's smallest holder.

An anchor with more than HOT distinct segments (the edge of a line that a
third of all documents hold) is split into its single windows, which are
summed up before they are shuffled. What is found goes back to documents by
segment, and each document is cut in one pass over its whole text.

Defined cases: null texts have no words; rows that share an identifier aren't
each other's references; rows without identifier are nobody's reference, have
none and lose nothing; repeated rows each get a row; very long texts are read
whole, 2 MB of text or one document at a time; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm import _text
from canopy.llm._store import Work, table

LENGTH = 13
ANCHOR = 6
HOT = 4096
SHARD_WORDS = 60_000
WHOLE = -1  # in the place of a window: all windows of the segment


class Automaton:
    """A suffix automaton of several word sequences; least[v]: the smallest owner of state v's substrings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]

    def _state(self, length: int, link: int, edges: dict, least) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.least.append(least)
        return len(self.link) - 1

    def _split(self, p: int, word, q: int) -> int:
        twin = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), self.least[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = twin
            p = self.link[p]
        self.link[q] = twin
        return twin

    def add(self, sequence: list, owner) -> None:
        last = 0
        for word in sequence:
            q = self.next[last].get(word)
            if q is not None:
                now = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
            else:
                now, p = self._state(self.length[last] + 1, 0, {}, owner), last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = now
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    self.link[now] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            if self.least[now] is None or owner < self.least[now]:
                self.least[now] = owner
            last = now

    def close(self) -> None:
        """Owners of long substrings own their suffixes."""
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[v]
            if up > 0 and self.least[v] < self.least[up]:
                self.least[up] = self.least[v]

    def owners(self, sequence: list, window: int) -> list:
        """For each window of the sequence its smallest owner, None if it isn't here."""
        v, matched, found = 0, 0, []
        for at, word in enumerate(sequence):
            while v and word not in self.next[v]:
                v = self.link[v]
                matched = self.length[v]
            if word in self.next[v]:
                v, matched = self.next[v][word], matched + 1
            while v and self.length[self.link[v]] >= window:
                v = self.link[v]
            matched = min(matched, self.length[v], window)
            if at >= window - 1:
                found.append(self.least[v] if matched == window else None)
        return found


class Segments:
    """The segments of all texts of an array: doc (index), start (word in its text), windows, anchor hash and digest (seg, check)."""

    def __init__(self, texts: pa.Array, window: int, anchor: int):
        self.buf, self.starts, self.ends, self.first = _text.words(texts)
        n = len(self.starts)
        self.hashes = pair = _text.word_digests(self.buf, self.starts, self.ends)
        h = pair[0]
        count = np.diff(self.first)
        of = np.repeat(np.arange(len(count)), count)
        grams = n - anchor + 1
        valid = np.flatnonzero(np.arange(n) + window <= self.first[1:][of]) if n else np.zeros(0, np.int64)
        if not len(valid):
            self.doc = self.start = self.windows = np.zeros(0, np.int64)
            self.anchor = self.seg = self.check = np.zeros(0, np.uint64)
            return
        at = np.arange(grams)
        least, where = _text.span_hashes(h, at, at + anchor), at
        span, most = 1, window - anchor + 1
        while span < most:  # the smallest gram of spans that double, the first one of equals
            step = min(span, most - span)
            a, b = least[:-step], least[step:]
            better = b < a
            least, where = np.where(better, b, a), np.where(better, where[step:], where[:-step])
            span += step
        least, where = least[valid], where[valid]
        doc = of[valid]
        head = np.ones(len(valid), bool)
        head[1:] = (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(head)
        self.windows = np.diff(np.append(heads, len(valid)))
        self.at = valid[heads]
        self.doc = doc[heads]
        self.start = self.at - self.first[self.doc]
        self.anchor = least[heads]
        self.seg, self.check = _text.span_digests(pair, self.at, self.at + self.windows + window - 1)

    def text(self, word: int, n: int) -> bytes:
        return self.buf[self.starts[word] : self.ends[word + n - 1]].tobytes()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchorer(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _text.chunks(whole):
                s = Segments(batch.column("text"), window, anchor)
                ids = batch.column("doc_id").take(pa.array(s.doc))
                yield pa.RecordBatch.from_arrays([_signed(s.anchor), ids, _signed(s.seg), _signed(s.check)], names=["anchor", "doc_id", "seg", "check"])

    return run


def _fetcher(window: int, anchor: int):
    """Words of the wanted segments; of hot ones, a row per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _text.chunks(whole):
                s = Segments(batch.column("text"), window, anchor)
                wanted = batch.column("wanted")
                of = wanted.value_lengths().to_numpy()
                flat = wanted.flatten()
                seg, check = (flat.field(c).to_numpy().view(np.uint64) for c in ("seg", "check"))
                hot = flat.field("hot").to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(of)), of)
                asked = {(d, x, c): y for d, x, c, y in zip(doc.tolist(), seg.tolist(), check.tolist(), hot.tolist(), strict=True)}
                out: list[list] = [[], [], [], [], [], []]
                ids = batch.column("doc_id").to_pylist()
                for k in np.flatnonzero(np.isin(s.seg, seg)).tolist():
                    d, x, c = int(s.doc[k]), int(s.seg[k]), int(s.check[k])
                    split = asked.pop((d, x, c), None)
                    if split is None:
                        continue
                    at, n = int(s.at[k]), int(s.windows[k])
                    if split:
                        places = np.arange(at, at + n)
                        keys = _text.span_hashes(s.hashes[0][at : at + n + window - 1], places - at, places - at + window).tolist()
                        rows = [(key, x, c, j, ids[d], s.text(at + j, window)) for j, key in enumerate(keys)]
                    else:
                        rows = [(int(s.anchor[k]), x, c, -1, ids[d], s.text(at, n + window - 1))]
                    for row in rows:
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                cols = [*(_signed(np.array(x, np.uint64)) for x in out[:3]), pa.array(out[3], pa.int32()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "seg", "check", "place", "owner", "words"])

    return run


def _judge(window: int):
    """Smallest owners of each segment's windows, a shard of whole anchors at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size = 0

        def judged() -> pa.RecordBatch:
            automaton = Automaton()
            for _, _, owner, sequence in shard:
                automaton.add(sequence, owner)
            automaton.close()
            found = [automaton.owners(sequence, window) for *_, sequence in shard]
            return pa.RecordBatch.from_arrays([*(pa.array([x[k] for x in shard], pa.int64()) for k in (0, 1)), pa.array(found, pa.list_(pa.int64()))], names=["seg", "check", "owners"])

        last = None
        for batch in batches:
            for key, seg, check, owner, text in zip(*(batch.column(c).to_pylist() for c in ("key", "seg", "check", "owner", "words")), strict=True):
                if key != last and size > SHARD_WORDS:
                    yield judged()
                    shard, size = [], 0
                sequence = text.split()
                shard.append((seg, check, owner, sequence))
                size += len(sequence)
                last = key
        if shard:
            yield judged()

    return run


def _cutter(window: int, anchor: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _text.chunks(whole):
                texts = batch.column("text").cast(pa.binary())
                hits = batch.column("hits")
                has = np.flatnonzero(hits.is_valid().to_numpy(zero_copy_only=False))
                gone: dict[int, np.ndarray] = {}
                if len(has):
                    s = Segments(texts.take(pa.array(has)), window, anchor)
                    own = hits.take(pa.array(has))
                    of = np.repeat(np.arange(len(has)), own.value_lengths().to_numpy())
                    flat = own.flatten()
                    digests = (flat.field(c).to_numpy().tolist() for c in ("seg", "check"))
                    marks = dict(zip(zip(of.tolist(), *digests, strict=True), flat.field("at").to_pylist(), strict=True))
                    masks = [np.zeros(b - a + 1, np.int64) for a, b in zip(s.first, s.first[1:], strict=False)]
                    signed, check = s.seg.view(np.int64), s.check.view(np.int64)
                    for k in np.flatnonzero(np.isin(signed, flat.field("seg").to_numpy())).tolist():
                        for j in marks.get((int(s.doc[k]), int(signed[k]), int(check[k])), ()):
                            a = int(s.start[k]) + max(j, 0)
                            masks[s.doc[k]][a] += 1
                            masks[s.doc[k]][a + window + (int(s.windows[k]) - 1 if j == WHOLE else 0)] -= 1
                    gone = {int(d): np.cumsum(m)[:-1] > 0 for d, m in zip(has, masks, strict=True)}
                n_words, n_gone, sha, kept = [], [], [], []
                for k, text in enumerate(texts):
                    parts = (text.as_py() or b"").split()
                    n_words.append(len(parts))
                    out = gone.get(k)
                    n_gone.append(0 if out is None else int(out.sum()))
                    if n_gone[-1]:
                        parts = [p for p, x in zip(parts, out.tolist(), strict=True) if not x]
                    rest = b" ".join(parts)
                    sha.append(hashlib.sha256(rest).hexdigest())
                    if with_text:
                        kept.append(rest.decode())
                cols = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(sha, pa.string())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.string())] * with_text, names=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text)

    return run


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) for each row of docs(doc_id, text)."""
    work = Work(spark, "substring")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = docs.filter("doc_id IS NOT NULL")
    occurs = known.mapInArrow(_anchorer(window, anchor), "anchor long, doc_id long, seg long, check long")
    shared = occurs.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).filter("a < z").select("anchor")
    shared = work.save(shared, "shared")
    held = work.save(occurs.join(shared, "anchor", "left_semi"), "held")
    seg = ["seg", "check"]
    segs = work.save(held.groupBy("anchor", *seg).agg(F.min("doc_id").alias("doc_id")), "segs")
    counts = work.save(segs.groupBy("anchor").agg(F.count("*").alias("n"), F.min(F.struct(*seg)).alias("one"), F.min("doc_id").alias("owner")), "counts")
    # An automaton of one segment would give back its smallest holder for each window; the others need their words.
    alone = counts.filter("n = 1").select("one.seg", "one.check", F.lit(WHOLE).alias("at"), "owner")
    some_hot = not counts.filter(F.col("n") > hot).isEmpty()
    marked = segs.join(counts.filter("n > 1").select("anchor", (F.col("n") > hot).alias("hot")), "anchor")
    wanted = marked.groupBy("doc_id").agg(F.collect_list(F.struct(*seg, "hot")).alias("wanted"))
    fetched = work.save(docs.join(wanted, "doc_id").mapInArrow(_fetcher(window, anchor), "key long, seg long, check long, place int, owner long, words binary"), "fetched")
    shards = fetched.filter("place < 0").repartition("key").sortWithinPartitions("key").select("key", *seg, "owner", "words")
    judged = shards.mapInArrow(_judge(window), "seg long, check long, owners array<long>")
    owned = alone.unionByName(judged.select(*seg, F.posexplode("owners").alias("at", "owner")))
    if some_hot:
        single = fetched.filter("place >= 0")
        least = single.groupBy("key", "words").agg(F.min("owner").alias("least"))
        owned = owned.unionByName(single.join(least, ["key", "words"]).select(*seg, F.col("place").alias("at"), F.col("least").alias("owner")))
    # Of one segment a window may be asked about by many documents: kept per segment, not per document.
    by_seg = work.save(owned.groupBy(*seg).agg(F.collect_list(F.struct("at", "owner")).alias("owners")), "owners")
    at = F.transform(F.filter("owners", lambda x: x["owner"] < F.col("doc_id")), lambda x: x["at"])
    hits = held.select("doc_id", *seg).distinct().join(by_seg, seg).select("doc_id", *seg, at.alias("at")).filter(F.size("at") > 0)
    by_doc = work.save(hits.groupBy("doc_id").agg(F.collect_list(F.struct(*seg, "at")).alias("hits")), "hits")
    work.drop("shared", "held", "segs", "counts", "fetched", "owners")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return docs.join(by_doc, "doc_id", "left").mapInArrow(_cutter(window, anchor, with_text), schema)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark, table(spark, sf_dir, "documents"), with_text=False)


QUERIES = {"op3_substring_dedup": op3_substring_dedup}
ORACLE = {
    "op3_substring_dedup": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        win AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
        least AS (SELECT x, min(doc_id) AS m FROM win GROUP BY x HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS p FROM win JOIN least USING (x) WHERE m < doc_id),
        words AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
        n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""
}
