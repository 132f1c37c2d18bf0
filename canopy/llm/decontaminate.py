"""Benchmark decontamination by a distributed positional inverted index.

Test items are cut into windows of consecutive words. The corpus frequency of
each test term is counted, and each window is looked for by its two rarest
positions: their postings (term, document, position) are stored with the few
words around them, the two lists are shifted by the terms' offsets in the
window and intersected, and what remains is compared word by word with the
window. Frequent words are never posted unless a window has no rarer one.

Only built-in column functions are used, and one plan at every size. Words are
first sifted by BUCKETS hash buckets of the wanted terms, a broadcast of at
most that many numbers; what passes is cut down to a posting before the join
with the terms themselves, which Spark broadcasts or shuffles by their size.
No exchange ever holds a document's words.

A document is known by its identifier and a hash of its text, so rows that
share or lack an identifier are told apart.

Defined cases: null texts have no words and no hits; an item of fewer words
than a window is one window, one without words none; repeated rows each get a
row, as do rows without identifier; very long texts are read whole; equally
frequent terms are taken by their place in the window; other columns are not
looked at, or pass through whatever their names; empty tables give no rows,
or rows without hits; null item identifiers are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm._store import KEY, Work, doc_id, keyed, table

WINDOW = 8
BUCKETS = 1 << 18
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RARER = 4


def lowered(text: Column) -> Column:
    """A-Z lower-cased; other letters stay, so the quick lower() serves plain ASCII only."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def _tokens(df: DataFrame, *keep: str) -> DataFrame:
    """A row per word: keep, words (may begin and end with an empty string), shift, pos and term."""
    split = df.select(*keep, F.split(lowered(F.coalesce("text", F.lit(""))), GAP).alias("words"))
    return split.select(*keep, "words", F.posexplode("words").alias("at", "term"))


def _place() -> Column:
    """A word's position, not counting an empty string before the first word."""
    return F.col("at") - F.when(F.element_at("words", 1) == "", 1).otherwise(0)


def _windows(bench: DataFrame, size: int) -> DataFrame:
    """(item_id, phrase, words) of each window of each item."""
    words = F.filter(F.split(lowered(F.col("text")), GAP), lambda w: w != "")
    items = bench.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", words.alias("_w")).filter(F.size("_w") > 0)
    last = F.greatest(F.size("_w") - size, F.lit(0))
    cut = items.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_w", i + 1, size))).alias("words"))
    return cut.select("item_id", F.array_join("words", " ").alias("phrase"), "words")


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS))


def _sifted(tokens: DataFrame, wanted: DataFrame) -> DataFrame:
    """Tokens whose hash bucket is one of a wanted term's; the broadcast has at most BUCKETS rows."""
    buckets = wanted.select(_bucket(F.col("term")).alias("_bucket")).distinct()
    return tokens.join(F.broadcast(buckets), _bucket(F.col("term")) == F.col("_bucket"), "left_semi")


class PositionalIndex:
    """Postings of the rarest terms of the test windows over docs(doc_id, text)."""

    def __init__(self, spark: SparkSession, docs: DataFrame, bench: DataFrame, size: int = WINDOW):
        self.work = work = Work(spark, "leaks")
        self.size = size
        self.docs = docs = keyed(docs, F.col("text").cast("string").alias("text"))
        self.items = work.save(_windows(bench, size).distinct(), "items")
        phrases = work.save(self.items.select("phrase", "words").distinct(), "phrases")
        terms = phrases.select(F.posexplode("words").alias("off", "term"), "phrase")
        vocabulary = work.save(terms.select("term").distinct(), "vocabulary")
        counted = _sifted(_tokens(docs).select("term"), vocabulary).groupBy("term").agg(F.count("*").alias("n"))
        seen = work.save(counted.join(vocabulary, "term", "left_semi"), "frequency")
        # By phrase at most a window of rows; a phrase with an absent term can't occur.
        ranked = terms.join(seen, "term").groupBy("phrase").agg(F.sort_array(F.collect_list(F.struct("n", "off", "term"))).alias("by"))
        whole = phrases.join(ranked, "phrase").filter(F.size("by") == F.size("words"))
        # A second term RARER times as frequent as the first costs more to post than the first's matches to compare.
        second = F.when((F.size("by") > 1) & (F.get("by", F.lit(1))["n"] <= RARER * F.get("by", F.lit(0))["n"]), F.lit(2)).otherwise(F.lit(1))
        pick = lambda i: F.element_at("by", F.lit(1) if i == 1 else second)
        true_second = F.element_at("by", F.when(F.size("by") > 1, F.lit(2)).otherwise(F.lit(1)))
        self.probes = work.save(
            whole.select(
                "phrase", "words", pick(1)["term"].alias("t1"), pick(1)["off"].alias("o1"), pick(2)["term"].alias("t2"), pick(2)["off"].alias("o2"),
                true_second["term"].alias("t3"), true_second["off"].alias("o3"),
            ), "probes"
        )  # t3 is the second rarest term however frequent, for proximity
        rare = work.save(self.probes.select(F.explode(F.array("t1", "t2")).alias("term")).distinct(), "rare")
        first = F.greatest(F.col("at") - (size - 1), F.lit(0))
        posting = _sifted(_tokens(docs, *KEY), rare).select(*KEY, "term", _place().alias("pos"), (F.col("at") - first).cast("int").alias("behind"), F.slice("words", first + 1, 2 * size - 1).alias("near"))
        self.postings = work.save(posting.join(rare, "term", "left_semi"), "postings")

    def _matches(self) -> DataFrame:
        """Exact matches: (doc, sig, phrase, start, length)."""
        one = self.postings.join(self.probes.withColumnRenamed("t1", "term"), "term")
        one = one.select(*KEY, "phrase", "words", (F.col("pos") - F.col("o1")).alias("start"), "near", (F.col("behind") - F.col("o1")).alias("skip"))
        two = self.postings.join(self.probes.select(F.col("t2").alias("term"), "phrase", "o2"), "term")
        two = two.select(*KEY, "phrase", (F.col("pos") - F.col("o2")).alias("start"))
        both = one.filter("start >= 0 AND skip >= 0").join(two, [*KEY, "phrase", "start"], "left_semi")
        # Spark may look at the words before it looks at skip, and has no place 0 in an array.
        same = F.slice("near", F.greatest(F.col("skip") + 1, F.lit(1)), F.size("words")) == F.col("words")
        return both.filter(same).select(*KEY, "phrase", "start", F.size("words").alias("length")).distinct()

    def phrases(self) -> DataFrame:
        """Exact matches: (doc_id, phrase, start, length)."""
        return self._matches().select(doc_id(), "phrase", "start", "length")

    def proximity(self, slop: int) -> DataFrame:
        """(doc_id, phrase, start) where the two rarest terms stand within slop of their distance in the phrase."""
        one = self.postings.join(self.probes.withColumnRenamed("t1", "term"), "term").select(*KEY, "phrase", (F.col("pos") - F.col("o1")).alias("start"), F.col("pos").alias("p1"), (F.col("o1") == F.col("o3")).alias("alone"))
        # Exact phrases need no postings of a frequent second term; those are made here, in documents that hold the first.
        second = self.probes.select(F.col("t3").alias("term"), "phrase", "o3")
        held = self.docs.join(one.select(*KEY).distinct(), KEY, "left_semi")
        terms = second.select("term").distinct()
        posts = _sifted(_tokens(held, *KEY), terms).select(*KEY, "term", _place().alias("p2"))
        two = posts.join(second, "term").select(*KEY, "phrase", (F.col("p2") - F.col("o3")).alias("other"), "p2")
        cell = slop + 1  # starts within slop lie in the same or the next cell
        one = one.withColumn("cell", F.explode(F.array(*[F.floor(F.col("start") / cell) + k for k in (-1, 0, 1)])))
        two = two.withColumn("cell", F.floor(F.col("other") / cell))
        near = one.join(two, [*KEY, "phrase", "cell"]).filter((F.abs(F.col("start") - F.col("other")) <= slop) & (F.col("alone") | (F.col("p1") != F.col("p2"))))
        return near.select(*KEY, "phrase", "start").distinct().select(doc_id(), "phrase", "start")


def contamination(spark: SparkSession, docs: DataFrame, bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """A row per row of docs(doc_id, text) against bench(item_id, text)."""
    index = PositionalIndex(spark, docs, bench, size)
    hits = index.work.save(index._matches(), "hits")
    index.work.drop("phrases", "vocabulary", "frequency", "probes", "rare", "postings")
    words = hits.select(*KEY, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    hit = words.groupBy(*KEY).agg(F.count("*").alias("n_hit"))
    items = hits.select(*KEY, "phrase").distinct().join(index.items.select("phrase", "item_id"), "phrase").select(*KEY, "item_id").distinct()
    names = items.groupBy(*KEY).agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ","), 256).alias("items_sha256"))
    found = hit.join(names, KEY)
    split = keyed(docs, F.split(F.coalesce("text", F.lit("")), ANY_CASE_GAP).alias("w"))
    blank = lambda k: F.when(F.element_at("w", k) == "", 1).otherwise(0)
    base = split.select(*KEY, F.greatest(F.size("w") - blank(1) - blank(-1), F.lit(0)).cast("long").alias("n_words"))
    n = F.coalesce("n_items", F.lit(0)).cast("long")
    return base.join(found, KEY, "left").select(
        doc_id(), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), n.alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n >= 2).alias("contaminated")
    )


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, bench: DataFrame, size: int = WINDOW, least_items: int = 1, least_words: int = 1) -> DataFrame:
    """The rows of docs that hold windows of fewer than least_items items, as they are.

    Windows of fewer than least_words words are passed over: with the default of
    one, an item of a single word makes every document with that word go.
    """
    index = PositionalIndex(spark, docs, bench, size)
    hits = index._matches().filter(F.col("length") >= least_words)
    if least_items > 1:
        named = hits.select(*KEY, "phrase").distinct().join(index.items.select("phrase", "item_id"), "phrase")
        hits = named.groupBy(*KEY).agg(F.count_distinct("item_id").alias("n")).filter(F.col("n") >= least_items)
    hit = hits.select(*KEY).distinct()
    return keyed(docs, F.struct("*").alias("whole")).join(hit, KEY, "left_anti").select("whole.*")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SPLIT = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
QUERIES = {"op9_decontaminate": op9_decontaminate}
ORACLE = {
    "op9_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
        b AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, list_slice(w, i, i + 7) AS x FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 7, 1))) AS i FROM b WHERE len(w) > 0)),
        lens AS (SELECT DISTINCT len(x) AS n FROM bw),
        dw AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS x FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)),
        occ AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (x)),
        pos AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM occ),
        hit AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY 1),
        its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM occ) GROUP BY 1)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""
}
