"""Places: polygons and names in text, as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ring_edges(rings: DataFrame) -> DataFrame:
    """(id, x1, y1, x2, y2) from rings (id, ring, n, x, y); a ring closes on its first point."""
    w = W.partitionBy("id", "ring").orderBy("n")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(whole))
    return rings.select("id", F.col("x").alias("x1"), F.col("y").alias("y1"), nxt("x").alias("x2"), nxt("y").alias("y2")).where("y1 <> y2 OR x1 <> x2")


def _across(y: Column) -> Column:
    """Where an edge meets the height ``y``."""
    return (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")


def polygon_cells(edges: DataFrame, cell: float) -> DataFrame:
    """(id, cx, cy, corner, edges): the grid cells that a polygon touches or covers.

    A cell with ``edges`` is touched by the boundary and lists the edges that touch it; ``corner`` says whether its lower
    right corner lies inside. A cell without edges lies inside as a whole. Cells between two touched ones of a row are
    all inside or all outside, so one corner decides them together.
    """
    up = lambda c: F.ceil(c / cell - 1e-9).cast("long")
    down = lambda c: F.floor(c / cell + 1e-9).cast("long")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("cy", F.explode(F.sequence(up(low) - 1, down(high))))
    part = lambda y: F.when(F.col("y1") != F.col("y2"), _across(y))
    ends = [part(F.greatest(low, F.col("cy") * cell)), part(F.least(high, (F.col("cy") + 1) * cell))]
    left, right = F.coalesce(F.least(*ends), F.least("x1", "x2")), F.coalesce(F.greatest(*ends), F.greatest("x1", "x2"))
    touched = rows.withColumn("cx", F.explode(F.sequence(up(left) - 1, down(right)))).groupBy("id", "cx", "cy").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    nxt = F.lead("cx").over(W.partitionBy("id", "cy").orderBy("cx"))
    spans = touched.select("id", "cy", "cx", "edges", nxt.alias("nxt"))
    gaps = spans.where("nxt > cx + 1").select("id", "cy", (F.col("cx") + 1).alias("cx"), (F.col("nxt") - 1).alias("last"))
    crossings = edges.where("y1 <> y2").withColumn("cy", F.explode(F.sequence(up(low) - 1, down(high) + 1))).where("(y1 > cy * {0}) <> (y2 > cy * {0})".format(f"CAST({cell!r} AS DOUBLE)"))
    lines = crossings.groupBy("id", "cy").agg(F.collect_list(_across(F.col("cy") * cell)).alias("line"))
    inside = F.size(F.filter(F.coalesce("line", F.array().cast("array<double>")), lambda x: (F.col("cx") + 1) * cell < x)) % 2 == 1
    known = lambda df: df.join(lines, ["id", "cy"], "left").withColumn("corner", inside)
    whole = known(gaps).where("corner").select("id", F.explode(F.sequence("cx", "last")).alias("cx"), "cy", "corner", F.lit(None).cast(touched.schema["edges"].dataType).alias("edges"))
    return known(spans).select("id", "cx", "cy", "corner", "edges").unionByName(whole)


def points_in_polygons(points: DataFrame, edges: DataFrame, cell: float = 1.0) -> DataFrame:
    """(point_id, id) by the even-odd rule, holes included: a ray east from (px, py) crosses an odd number of edges.

    Polygons are cut into grid cells once; a point meets the cells at its own place by equality. In a cell that is covered
    nothing is left to do. In one that the boundary touches, the ray is followed to the cell's right border only, and
    from there along the border to the corner whose side is known: no edge of another cell is looked at. On the border the
    path runs just right of and above the lattice, as the rule puts points that lie on an edge.
    """
    here = polygon_cells(edges.select("id", "x1", "y1", "x2", "y2"), cell)
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    border, floor = (F.col("cx") + 1) * cell, F.col("cy") * cell

    def meets(e: Column, y: Column) -> Column:
        return (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]

    def spans(e: Column, y: Column) -> Column:
        return (e["y1"] > y) != (e["y2"] > y)

    def on_ray(e: Column) -> Column:
        at = meets(e, F.col("py"))
        return spans(e, F.col("py")) & (F.col("px") < at) & ~(border < at)

    def on_border(e: Column) -> Column:
        rising = (e["y2"] - e["y1"]) * (e["x2"] - e["x1"]) > 0
        # whether the edge passes above the point of the border at y, by the ray's own formula: rounding can't tell them apart
        above = lambda y: F.when(~spans(e, y), e["y1"] > y).when(rising, ~(border < meets(e, y))).otherwise(border < meets(e, y))
        return ((e["x1"] > border) != (e["x2"] > border)) & (above(floor) != above(F.col("py")))

    crossed = lambda rule: F.size(F.filter("edges", lambda e: F.coalesce(rule(e), F.lit(False))))
    odd = (F.col("corner").cast("int") + F.when(F.col("edges").isNull(), 0).otherwise(crossed(on_ray) + crossed(on_border))) % 2 == 1
    met = points.withColumns({"cx": at("px"), "cy": at("py")}).join(here, ["cx", "cy"])
    return met.where(odd).select("point_id", "id")


def centroids(edges: DataFrame) -> DataFrame:
    """F32: area-weighted centroids by the shoelace sums; the middle of the box when there is no area."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    s = edges.groupBy("id").agg(F.sum(cross).alias("a"), F.sum((F.col("x1") + F.col("x2")) * cross).alias("cx"), F.sum((F.col("y1") + F.col("y2")) * cross).alias("cy"), ((F.min("x1") + F.max("x1")) / 2).alias("mx"), ((F.min("y1") + F.max("y1")) / 2).alias("my"))
    return s.select("id", F.when(F.col("a") != 0, F.col("cx") / (3 * F.col("a"))).otherwise(F.col("mx")).alias("x"), F.when(F.col("a") != 0, F.col("cy") / (3 * F.col("a"))).otherwise(F.col("my")).alias("y"))


def arc_neighbours(arcs: DataFrame) -> DataFrame:
    """§1 adjacency: places(id, arc) that share a boundary arc, both ways, without self-loops."""
    a = arcs.select(F.col("id").alias("a"), "arc").distinct()
    return a.join(a.withColumnRenamed("a", "b"), "arc").where("a <> b").select("a", "b").distinct()


def name_trie(gazetteer: DataFrame, longest: int) -> list[DataFrame]:
    """The tokens of gazetteer(name, place_id) as a trie, a frame for each level: (prefix, places, place_id, goes_on).

    A level has the first n words of all names; ``places`` counts those that a name of just these words may mean (null if it
    is only the start of longer ones). Names of more than ``longest`` words are left out.
    """
    words = F.filter(F.split(F.lower("name"), "[^a-z0-9]+"), lambda w: w != "")
    named = gazetteer.select(words.alias("w"), "place_id").where(F.size("w").between(1, longest)).distinct()
    levels = []
    for n in range(1, longest + 1):
        at = named.where(F.size("w") >= n).withColumn("prefix", F.array_join(F.slice("w", 1, n), " "))
        whole = F.when(F.size("w") == n, F.col("place_id"))
        levels.append(at.groupBy("prefix").agg(F.nullif(F.count_distinct(whole), F.lit(0)).alias("places"), F.min(whole).alias("place_id"), F.bool_or(F.size("w") > n).alias("goes_on")))
    return levels


def named_spans(texts: DataFrame, gazetteer: DataFrame, longest: int = 3) -> DataFrame:
    """(text_id, start, words, places, place_id): the names in texts(text_id, text), from left to right, the longest at each place, none within another.

    A text's words walk down the trie: each level is an equality join of the words so far, and only those that begin a longer
    name go on to the next, so few of the words get beyond the first. Then each text's matches are read in order and a match
    that starts before the end of the last one taken is passed over.
    """
    # a word's row has the words after it in columns of their own, so that no list is made for a word
    words = [f"w{n}" for n in range(longest)]
    reach = texts.select("text_id", F.array_remove(F.split(F.lower("text"), "[^a-z0-9]+"), "").alias("w0"))
    ahead = F.arrays_zip("w0", *(F.slice("w0", n + 1, F.size("w0")).alias(f"w{n}") for n in range(1, longest)))
    at = reach.where(F.size("w0") > 0).select("text_id", F.posexplode(ahead).alias("start", "ahead")).select("text_id", "start", *(F.col("ahead").getField(w).alias(w) for w in words))
    found = None
    for n, level in enumerate(name_trie(gazetteer, longest), 1):
        at = at.where(F.col(words[n - 1]).isNotNull()).withColumn("prefix", F.concat_ws(" ", *words[:n])).join(level, "prefix")
        here = at.where("places IS NOT NULL").select("text_id", F.struct("start", F.lit(n).alias("words"), "places", "place_id").alias("m"))
        found = here if found is None else found.unionByName(here)
        at = at.where("goes_on").select("text_id", "start", *words)
    longest_here = found.groupBy("text_id", F.col("m.start").alias("start")).agg(F.max(F.struct(F.col("m.words").alias("words"), "m")).alias("best"))
    lists = longest_here.groupBy("text_id").agg(F.array_sort(F.collect_list("best.m")).alias("all"))
    empty = F.slice("all", 1, 0)
    taken = F.aggregate("all", F.struct(F.lit(0).alias("end"), empty.alias("taken")), lambda s, m: F.when(m["start"] >= s["end"], F.struct((m["start"] + m["words"]).alias("end"), F.concat(s["taken"], F.array(m)).alias("taken"))).otherwise(s), lambda s: s["taken"])
    return lists.select("text_id", F.explode(taken).alias("m")).select("text_id", "m.*")


def locate_names(texts: DataFrame, gazetteer: DataFrame, *, longest: int = 3, roundup: int = 3) -> DataFrame:
    """(text_id, place_id, verdict): the one place a text names, else why there is none.

    Names are those of ``named_spans``: "new york city" isn't also "york". A name of several places is ambiguous, ``roundup``
    or more places make a round-up, and neither is guessed. Texts of a null id are one text.
    """
    spans = named_spans(texts, gazetteer, longest).withColumnRenamed("text_id", "__id")
    sure = F.when(F.col("places") == 1, F.col("place_id"))
    met = spans.groupBy("__id").agg(F.count_distinct(sure).alias("sure"), F.bool_or(F.col("places") > 1).alias("doubtful"), F.min(sure).alias("place"))
    verdict = F.when(F.col("sure") >= roundup, "roundup").when(F.col("sure") > 1, "several").when(F.col("sure") == 1, "placed").when(F.col("doubtful"), "ambiguous").otherwise("none")
    out = texts.select("text_id").join(met, F.col("text_id").eqNullSafe(F.col("__id")), "left").withColumn("verdict", verdict)
    return out.select("text_id", F.when(F.col("verdict") == "placed", F.col("place")).alias("place_id"), "verdict")
