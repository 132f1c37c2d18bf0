"""The smallest confident place: address, postcode, area, or none.

requests(id, postcode, huisnummer, street, at, x, y); streets(ident, naam),
numbers(ident, postcode, huisnummer, street, begin, end), objects(number, x, y)
hold best-known versions only; areas(area, polygon).
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopy.functions.spatial import bounds, cell, contains
from canopy.functions.text import trigrams
from canopy.sources.files import written

SIMILAR = 0.55
CONFIDENCE = {"address": 90, "postcode": 70, "buurt": 50}
CELL = 400.0


def best_known(versions: DataFrame) -> DataFrame:
    return versions.filter("eindregistratie IS NULL")


def addresses(streets: DataFrame, numbers: DataFrame, objects: DataFrame) -> DataFrame:
    """Street, number and point of every address object."""
    s = streets.select(F.col("ident").alias("street"), "naam")
    o = objects.select(F.col("number").alias("ident"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    return numbers.join(s, "street", "left").join(o, "ident")


class _Timeline:
    """The steps of one key, out of its addresses by day of beginning: who answers from which day on."""

    def __init__(self, key: tuple):
        self.key, self.heap, self.steps, self.any = key, [], [], None

    def _step(self, since) -> None:
        answer = self.heap[0] if self.heap else None
        if self.steps and self.steps[-1][0] == since:
            self.steps.pop()
        if answer is not (self.steps[-1][1] if self.steps else None):
            self.steps.append((since, answer))

    def _expire(self, until) -> None:
        """The first in rank gives way at its end to the next one that still holds."""
        while self.heap and (end := self.heap[0][1]) is not None and (until is None or end <= until):
            while self.heap and self.heap[0][1] is not None and self.heap[0][1] <= end:
                heappop(self.heap)
            self._step(end)

    def add(self, begin, end, rank: int, payload: tuple) -> None:
        if self.any is None or rank < self.any[0]:
            self.any = (rank, end, payload)
        if begin is None or (end is not None and end <= begin):
            return
        self._expire(begin)
        if self.heap and self.heap[0][0] < rank and (self.heap[0][1] is None or (end is not None and end <= self.heap[0][1])):
            return  # never the first while it holds
        heappush(self.heap, (rank, end, payload))
        self._step(begin)

    def rows(self) -> Iterator[tuple]:
        self._expire(None)
        for since, answer in [(None, None), *self.steps]:
            yield (*self.key, since, answer is not None, *(answer or self.any)[2])


def _timelines(width: int, schema: pa.Schema):
    """Rows (keys..., begin, end, rank, ident, ax, ay), sorted by keys and beginning, to steps (keys..., since, valid, ident, ax, ay)."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line, out = None, []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        for some in batches:
            for row in zip(*[c.to_pylist() for c in some.columns]):
                if line is None or line.key != row[:width]:
                    out.extend(line.rows() if line else ())
                    line = _Timeline(row[:width])
                    if len(out) >= 10000:
                        yield batch()
                        out = []
                line.add(*row[width : width + 3], row[width + 3 :])
        out.extend(line.rows() if line else ())
        if out:
            yield batch()

    return sweep


def answers(addresses: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., since, valid, ident, ax, ay): which address of a key answers a request from a day on, until the next such day.

    Of those valid then the first in the order of ident, ax and ay, else the first of all;
    the row without a day stands for what is before them. A key has no more rows than days at
    which its addresses change, so requests meet one row each, however many share a key.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    known = addresses.select(*keys, "begin", "end", "ident", "ax", "ay").dropna(subset=keys)
    ranked = known.select(*keys, "begin", "end", F.row_number().over(Window.partitionBy(*keys).orderBy("ident", "ax", "ay")).alias("rank"), "ident", "ax", "ay")
    ordered = ranked.repartition(*keys).sortWithinPartitions(*keys, F.col("begin").asc_nulls_first())
    schema = known.select(*keys, F.col("begin").alias("since"), F.lit(True).alias("valid"), "ident", "ax", "ay").schema
    return ordered.mapInArrow(_timelines(len(keys), to_arrow_schema(schema)), schema)


def answered(requests: DataFrame, steps: DataFrame, keys: list[str]) -> DataFrame:
    """requests(id, at, keys...) with the address that answers: looked up once for each day asked of a key, by one sort of both."""
    asked = requests.select(*keys, "at").distinct().withColumn("_step", F.lit(None).cast(steps.select(F.struct("valid", "ident", "ax", "ay")).schema[0].dataType))
    both = asked.unionByName(steps.select(*keys, F.col("since").alias("at"), F.struct("valid", "ident", "ax", "ay").alias("_step")))
    until = Window.partitionBy(*keys).orderBy(F.col("at").asc_nulls_first(), F.col("_step").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    told = both.withColumn("_told", F.last("_step", ignorenulls=True).over(until)).filter("_step IS NULL AND _told IS NOT NULL")
    told = told.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("at").alias("_at"), "_told")
    same = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("at").eqNullSafe(F.col("_at"))]
    return requests.join(told, same).select(*requests.columns, "_told.*")


def _pick(joined: DataFrame, tier: str, similar=None) -> DataFrame:
    """One address per request: most similar, valid at the date first, then the smallest identifier."""
    score = F.lit(0.0) if similar is None else -similar
    order = F.struct(score.alias("s"), (~F.col("valid")).alias("v"), F.col("ident"), F.col("ax"), F.col("ay"))
    best = joined.groupBy("id").agg(F.min(order).alias("b"))
    return best.select("id", F.lit(tier).alias("via"), F.col("b.ident").alias("ident"), F.col("b.ax").alias("ax"), F.col("b.ay").alias("ay"), (~F.col("b.v")).alias("valid"))


def _prefixed(names: DataFrame, name: str, frequency: DataFrame, least: float) -> DataFrame:
    """(name, grams, prefix): a name's trigrams, rarest first, and as many of them as must hold one of any name's so similar."""
    grams = names.select(name).distinct().select(name, F.explode(trigrams(F.col(name))).alias("g")).join(frequency, "g")
    whole = grams.groupBy(name).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "g"))), lambda x: x["g"]).alias("grams"))
    size = F.size("grams")
    return whole.withColumn("prefix", F.slice("grams", F.lit(1), (size - F.ceil(size * least - 1e-9) + 1).cast("int")))


def similar_streets(names: DataFrame, streets: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(wanted, naam, sim) for distinct names over the threshold, by shared trigrams and set sizes.

    Prefix filtering: of names so similar, the rarest trigrams of each, as many as the
    threshold leaves open, share one. Only those are indexed, so a trigram that is in
    every name brings nobody together; a pair is compared at its first shared one.
    """
    both = names.select(F.col("wanted").alias("t")).distinct().unionAll(streets.select(F.col("naam").alias("t")).distinct())
    frequency = written(both.select(F.explode(trigrams(F.col("t"))).alias("g")).groupBy("g").agg(F.count("*").alias("n")), "trigrams")
    a = _prefixed(names, "wanted", frequency, least).select("wanted", F.col("grams").alias("_g"), F.col("prefix").alias("_p"), F.explode("prefix").alias("g"))
    b = _prefixed(streets, "naam", frequency, least).select("naam", F.col("grams").alias("_h"), F.col("prefix").alias("_q"), F.explode("prefix").alias("g"))
    n, m = F.size("_g"), F.size("_h")
    met = a.join(b, "g").filter((m >= n * least) & (n >= m * least)).filter(F.element_at(F.array_intersect("_p", "_q"), 1) == F.col("g"))
    shared = F.size(F.array_intersect("_g", "_h"))
    return met.select("wanted", "naam", (shared / (n + m - shared)).alias("sim")).filter(F.col("sim") > least)


def areas_of(points: DataFrame, areas: DataFrame, size: float = CELL) -> DataFrame:
    """(id, area): the smallest area that strictly contains the point, by grid cell, box and ray."""
    boxed = areas.withColumn("_b", bounds(F.col("polygon")))
    span = lambda a, b: F.sequence(cell(F.col(f"_b.{a}"), size), cell(F.col(f"_b.{b}"), size))
    cells = boxed.withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("y0", "y1")))
    placed = points.filter("x IS NOT NULL AND y IS NOT NULL").withColumn("cx", cell(F.col("x"), size)).withColumn("cy", cell(F.col("y"), size))
    inside = placed.join(cells, ["cx", "cy"]).filter(contains(F.col("polygon"), F.col("x"), F.col("y")))
    return inside.groupBy("id").agg(F.min("area").alias("area"))


def resolve(requests: DataFrame, streets: DataFrame, numbers: DataFrame, objects: DataFrame, areas: DataFrame) -> DataFrame:
    """A row per request: level, confidence in hundredths, identifier, point, area, time match and caveats.

    Each tier sees only what the finer ones missed, so the fuzzy one stays small;
    what several tiers read is written once. No request is paired with the addresses
    that share its code or street, only with the one that answers it.
    """
    found = written(addresses(streets, numbers, objects), "addresses")
    by_code = ["postcode", "huisnummer"]
    one = written(_pick(answered(requests.select("id", "at", *by_code).dropna(subset=by_code), answers(found, by_code), by_code), "postcode_number"), "by-code")
    left = requests.join(one.select("id"), "id", "left_anti").filter("street IS NOT NULL AND huisnummer IS NOT NULL")
    named = left.select("id", "at", "huisnummer", F.lower("street").alias("wanted"))
    lower = found.select("ident", "huisnummer", "begin", "end", "ax", "ay", F.lower("naam").alias("naam"))
    by_name = ["naam", "huisnummer"]
    steps = written(answers(lower, by_name), "by-name")
    two = written(_pick(answered(named.withColumnRenamed("wanted", "naam"), steps, by_name), "street"), "by-street")
    rest = written(named.join(two.select("id"), "id", "left_anti"), "misspelt")
    # Of the similar streets only the most similar with the number can answer, whatever the day.
    asked = rest.select("wanted", "huisnummer").distinct().join(similar_streets(rest, lower), "wanted").join(steps.select(*by_name).distinct(), by_name)
    most = asked.withColumn("_most", F.max("sim").over(Window.partitionBy("wanted", "huisnummer"))).filter(F.col("sim") == F.col("_most")).drop("_most")
    three = _pick(answered(rest.join(most, ["wanted", "huisnummer"]).select("id", "at", *by_name, "sim"), steps, by_name), "fuzzy", F.col("sim"))
    hits = one.unionByName(two).unionByName(three)
    codes = numbers.select("postcode").distinct().withColumn("known", F.lit(True))
    floor = areas_of(requests.select("id", "x", "y"), areas)
    joined = requests.join(hits, "id", "left").join(codes, "postcode", "left").join(floor, "id", "left")
    level = F.when(F.col("ident").isNotNull(), "address").when(F.col("known"), "postcode").when(F.col("area").isNotNull(), "buurt")
    any_time = (level == "address") & ~F.col("valid")
    return joined.withColumn("level", level).select(
        "id",
        "level",
        "via",
        "ident",
        "ax",
        "ay",
        F.when(F.col("level") == "buurt", F.col("area")).alias("area"),
        F.when(F.col("level") == "address", CONFIDENCE["address"]).when(F.col("level") == "postcode", CONFIDENCE["postcode"]).when(F.col("level") == "buurt", CONFIDENCE["buurt"]).alias("cents"),
        F.when(F.col("level") == "address", F.when(any_time, "any_time").otherwise("valid_at_date")).alias("time_match"),
        F.array_compact(F.array(F.when(any_time, "timeMismatch"), F.when(F.col("level") == "buurt", "unresolvedLocation"))).alias("caveats"),
    )


def scope(cases: DataFrame) -> DataFrame:
    """What is done with a case: keyless, pending, unresolved, excluded or audited."""
    return cases.withColumn(
        "status",
        F.when(F.col("zaaknummer").isNull() | (F.col("zaaknummer") == ""), "keyless")
        .when(F.col("decision").isNull(), "pending")
        .when(F.col("area_code").isNull(), "unresolved")
        .when(F.col("area_code").startswith("N"), "audited")
        .otherwise("excluded"),
    )


def fallback(rows: DataFrame, master: DataFrame, first: str, second: str) -> DataFrame:
    """Look an id up under the first, else the second column; empty ids are skipped."""
    m = lambda a: master.select(F.col("tree").alias(f"_{a}"), F.col("x").alias(f"_x{a}"), F.col("y").alias(f"_y{a}"))
    joined = rows.join(m("a"), F.nullif(F.col(first), F.lit("")) == F.col("_a"), "left").join(m("b"), F.nullif(F.col(second), F.lit("")) == F.col("_b"), "left")
    via = F.when(F.col("_a").isNotNull(), first).when(F.col("_b").isNotNull(), second).otherwise("unresolved")
    pick = lambda c: F.when(F.col("_a").isNotNull(), F.col(f"_{c}a")).otherwise(F.col(f"_{c}b"))
    return joined.select(*rows.columns, via.alias("via"), pick("x").alias("x"), pick("y").alias("y"))


def placement(resolved: DataFrame, requests: DataFrame, areas: DataFrame) -> DataFrame:
    """The area a resolved request is audited in, and whether that is in scope.

    An address is placed by its own point, a postcode by the request's, an area
    is itself; a postcode without a point that lies in an area stays unresolved.
    """
    own = requests.select("id", F.col("x").alias("rx"), F.col("y").alias("ry"))
    at = lambda a, r: F.when(F.col("level") == "address", F.col(a)).when(F.col("level") == "postcode", F.col(r))
    chosen = resolved.join(own, "id").withColumn("x", at("ax", "rx")).withColumn("y", at("ay", "ry"))
    inside = areas_of(chosen.select("id", "x", "y"), areas).withColumnRenamed("area", "_inside")
    codes = areas.select(F.col("area").alias("placed"), "code")
    placed = chosen.join(inside, "id", "left").withColumn("placed", F.when(F.col("level") == "buurt", F.col("area")).otherwise(F.col("_inside")))
    return placed.join(codes, "placed", "left").select("id", "level", "placed", "code", F.col("placed").isNull().alias("unresolved"), F.coalesce(F.col("code").startswith("N"), F.lit(False)).alias("in_scope"))


def require_reference(tables: dict[str, DataFrame]) -> None:
    """An empty reference table is a fault, not a miss."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"empty reference tables: {', '.join(empty)}")


def nearest_of(hits: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """One hit per key: valid ones first, then the nearest to the request's own point, then the smallest identifier."""
    d = F.sqrt((F.col("ax") - F.col(x)) ** 2 + (F.col("ay") - F.col(y)) ** 2)
    best = hits.withColumn("dist", d).groupBy(key).agg(F.min(F.struct((~F.col("valid")).alias("v"), F.col("dist").isNull().alias("n"), "dist", "ident")).alias("b"))
    return best.select(key, F.col("b.ident").alias("ident"), F.col("b.dist").alias("dist"), (~F.col("b.v")).alias("valid"))
