"""Names in text, placement and diffusion over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import placement, places
from cairn.plans.base import query

TOKENS = "regexp_extract_all(lower(text), '[a-z0-9]+')"


SPANS = f"""
WITH RECURSIVE iw AS (SELECT item_id, {TOKENS} AS w FROM benchmark),
g AS (SELECT item_id, array_to_string(w[(j // 2) * 5 + (j % 2) * 2 + 1 : (j // 2) * 5 + (j % 2) * 2 + 2 + j % 2], ' ') AS name FROM iw, range(0, 1000) r(j) WHERE (j // 2) * 5 + (j % 2) * 2 + 2 + j % 2 <= len(w)),
n AS (SELECT name, count(DISTINCT item_id) AS places, min(item_id) AS place_id FROM g GROUP BY 1),
dw AS (SELECT doc_id, {TOKENS} AS w FROM documents),
m AS (SELECT doc_id, s, k, places, place_id FROM dw, range(2, 4) z(k), LATERAL (SELECT unnest(range(0, len(w) - k + 1)) AS s) JOIN n ON name = array_to_string(w[s + 1 : s + k], ' ')),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY doc_id, s ORDER BY k DESC) = 1),
p AS (SELECT a.*, x.s AS nxt FROM b a ASOF LEFT JOIN b x ON a.doc_id = x.doc_id AND a.s + a.k <= x.s),
t AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s) = 1 UNION ALL SELECT p.* FROM t JOIN p ON p.doc_id = t.doc_id AND p.s = t.nxt)"""


def names(t):
    """Names of two and three words in turn, cut one after the other from whole items; the item is the place."""
    w = F.filter(F.split(F.lower("text"), "[^a-z0-9]+"), lambda x: x != "")
    at, size = F.floor(F.col("j") / 2) * 5 + (F.col("j") % 2) * 2, F.col("j") % 2 + 2
    pieces = t.benchmark.select("item_id", w.alias("w")).withColumn("j", F.explode(F.sequence(F.lit(0), F.size("w")))).where(at + size <= F.size("w"))
    return pieces.select(F.array_join(F.slice("w", (at + 1).cast("int"), size.cast("int")), " ").alias("name"), F.col("item_id").alias("place_id"))


@query(SPANS + " SELECT doc_id AS text_id, CAST(s AS INT) AS start, CAST(k AS INT) AS words, places, place_id FROM t")
def q_named_spans(t):
    """The names in all documents, the longest at each place, none within another."""
    return places.named_spans(t.documents.select(F.col("doc_id").alias("text_id"), "text"), names(t), longest=3)


@query(
    SPANS
    + """, f AS (SELECT doc_id, count(DISTINCT CASE WHEN places = 1 THEN place_id END) AS sure, bool_or(places > 1) AS doubtful, min(CASE WHEN places = 1 THEN place_id END) AS place FROM t GROUP BY 1),
v AS (SELECT d.doc_id, place, CASE WHEN sure >= 3 THEN 'roundup' WHEN sure > 1 THEN 'several' WHEN sure = 1 THEN 'placed' WHEN doubtful THEN 'ambiguous' ELSE 'none' END AS verdict FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id)
SELECT doc_id AS text_id, CASE WHEN verdict = 'placed' THEN place END AS place_id, verdict FROM v"""
)
def q_geotag(t):
    """The one item that a document's names point to, or why there is none."""
    return places.locate_names(t.documents.select(F.col("doc_id").alias("text_id"), "text"), names(t), longest=3)


@query("""
WITH c AS (SELECT n_nationkey AS nk, n_name AS name, 'S' || n_regionkey AS st, lpad((n_nationkey + 1)::VARCHAR, 5, '0') AS fips FROM nation),
w AS (SELECT DISTINCT st, 't' || s_suppkey % 40 AS tk, fips FROM supplier JOIN c ON nk = s_nationkey), h AS (SELECT st, tk, list(fips ORDER BY fips) AS h FROM w GROUP BY ALL),
o AS (SELECT o_orderkey AS record_id, o_orderkey % 12 AS m, c.nk, c.fips, b.fips AS other, h, coalesce(len(h), 0) AS n FROM orders JOIN c ON c.nk = o_custkey % 25 JOIN c b ON b.nk = (o_custkey + 5) % 25 LEFT JOIN h ON h.st = c.st AND h.tk = 't' || o_custkey % 40)
SELECT record_id, CASE WHEN m IN (0, 1, 4, 5) THEN [fips] WHEN m IN (2, 3) THEN [fips, other] WHEN m IN (6, 7, 8) AND n = 1 THEN h WHEN m = 7 AND n > 1 AND list_contains(h, other) THEN [other] WHEN m = 8 THEN [fips] WHEN m = 10 THEN [other] WHEN m = 11 AND nk % 2 = 0 THEN [fips] ELSE []::VARCHAR[] END AS fips,
  CASE WHEN m IN (0, 1, 4) THEN 'name' WHEN m IN (2, 3) THEN 'names' WHEN m = 5 THEN 'point' WHEN m IN (6, 7, 8) AND n = 1 THEN 'place' WHEN m = 7 AND n > 1 AND list_contains(h, other) THEN 'place_text' WHEN m IN (6, 7) AND n > 1 THEN 'place_ambiguous' WHEN m = 8 THEN 'source_fips' WHEN m = 10 THEN 'override' WHEN m = 11 AND nk % 2 = 0 THEN 'name' END AS method FROM o""")
def q_placement(t):
    """A record for each order, told in one of twelve ways; all eight methods answer some."""
    c = t.nation.select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("name"), F.concat(F.lit("S"), "n_regionkey").alias("st"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 5, "0").alias("fips"))
    towns = t.supplier.join(c, F.col("nk") == F.col("s_nationkey")).select(F.col("st").alias("state"), F.concat(F.lit("t"), F.col("s_suppkey") % 40).alias("place"), "fips")
    towns = towns.unionByName(c.where("nk % 2 = 0").select(F.col("st").alias("state"), placement.town_key(F.col("name")).alias("place"), "fips"))
    other = c.select(F.col("nk").alias("other_nk"), F.col("name").alias("other"), F.col("fips").alias("other_fips"))
    o = t.orders.select(F.col("o_orderkey").alias("record_id"), (F.col("o_orderkey") % 12).alias("m"), (F.col("o_custkey") % 25).alias("nk"), ((F.col("o_custkey") + 5) % 25).alias("other_nk"), (F.col("o_custkey") % 40).alias("k")).join(c, "nk").join(other, "other_nk")
    m, village = F.col("m"), F.concat(F.lit("Village of T"), "k")
    county = F.when(m == 0, F.concat("name", F.lit(" County"))).when(m == 1, F.concat("name", F.lit(" (solar only)"))).when(m == 2, F.concat(F.lower("name"), F.lit(", "), "other", F.lit(" and Nowhere"))).when(m == 3, F.concat(F.lit("Various ("), "name", F.lit("; "), "other", F.lit(")"))).when(m == 5, "Nowhere").when(m == 10, F.col("name"))
    town = F.when(m == 4, F.concat("name", F.lit(" County"))).when(m.isin(6, 7, 8), village).when(m == 11, F.col("name"))
    text = F.when(m == 7, F.concat(F.lit("a town of "), "other", F.lit(" County, near Elsewhere"))).when(m == 11, F.concat(F.lit("the City and County of "), "name"))
    records = o.select("record_id", F.lower("st").alias("state"), county.alias("county"), town.alias("town"), text.alias("text"), F.when(m == 8, F.col("fips")).when(m == 9, "99999").alias("source_fips"))
    corner = F.explode(F.array(*(F.struct(F.lit(n).alias("n"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for n, (dx, dy) in enumerate(((0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0))))))
    rings = c.select(F.col("fips").alias("id"), "nk", corner.alias("c")).select("id", F.lit(0).alias("ring"), "c.n", ((F.col("nk") % 5) * 10 + F.col("c.dx")).alias("x"), (F.floor(F.col("nk") / 5) * 10 + F.col("c.dy")).alias("y"))
    spots = o.where("m = 5").select("record_id", ((F.col("nk") % 5) * 10 + 3.5).alias("longitude"), (F.floor(F.col("nk") / 5) * 10 + 7.25).alias("latitude"))
    points = placement.placed_by_coordinates(spots, places.ring_edges(rings), 10.0)
    return placement.place_records(records, c.select(F.col("st").alias("state"), F.col("name").alias("county"), "fips"), towns, points, o.where("m = 10").select("record_id", F.col("other_fips").alias("fips")))


@query("""
WITH n AS (SELECT DISTINCT c_custkey AS node FROM customer), e AS (SELECT a.node AS a, b.node AS b FROM n a JOIN n b ON abs(a.node - b.node) IN (1, 7)),
p AS (SELECT p_partkey AS i, p_partkey * 3 % 1500 AS node, DATE '1999-01-01' + CAST(p_size * 40 AS INT) AS day FROM part WHERE p_size > 30 UNION ALL SELECT p_partkey, (p_partkey * 3 + 1) % 1500, CASE WHEN p_size % 3 > 0 THEN DATE '1999-01-01' + CAST(p_size * 40 AS INT) END FROM part WHERE p_size > 30 AND p_size % 2 = 0),
s AS (SELECT a, b, max(day) AS newest FROM e JOIN p ON p.node = e.b WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.i = p.i AND q.node = e.a) GROUP BY a, b),
r AS (SELECT a, count(*) AS neighbours, count(*) FILTER (WHERE newest >= DATE '2004-06-30' - INTERVAL 18 MONTH) AS recent, max(newest) AS newest FROM s GROUP BY a), u AS (SELECT DISTINCT c_custkey AS node FROM customer WHERE c_acctbal < 0)
SELECT n.node, coalesce(neighbours, 0) AS neighbours, coalesce(recent, 0) AS recent, newest, u.node IS NOT NULL AS unresolved, CASE WHEN recent > 0 AND u.node IS NOT NULL THEN 1 WHEN neighbours >= 3 THEN 2 WHEN recent > 0 THEN 3 WHEN neighbours > 0 THEN 4 ELSE 0 END AS tier
FROM n LEFT JOIN r ON r.a = n.node LEFT JOIN u ON u.node = n.node""")
def q_diffusion(t):
    """Tiers 0 to 4 from neighbours and records; some instruments stand in two places that are neighbours."""
    nodes = t.customer.select(F.col("c_custkey").alias("node")).distinct()
    step = nodes.select(F.col("node").alias("a"), F.explode(F.array(*(F.col("node") + d for d in (-7, -1, 1, 7)))).alias("b"))
    edges = step.join(nodes.withColumnRenamed("node", "b"), "b").select("a", "b")
    p = t.part.where("p_size > 30")
    day = F.date_add(F.lit("1999-01-01").cast("date"), (F.col("p_size") * 40).cast("int"))
    first = p.select(F.col("p_partkey").alias("instrument_id"), (F.col("p_partkey") * 3 % 1500).alias("node"), day.alias("enacted"))
    second = p.where("p_size % 2 = 0").select(F.col("p_partkey").alias("instrument_id"), ((F.col("p_partkey") * 3 + 1) % 1500).alias("node"), F.when(F.col("p_size") % 3 > 0, day).alias("enacted"))
    open_ = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("node"))
    return placement.diffusion(first.unionByName(second), edges, open_, "2004-06-30", nodes)


#: Corners of a shape of ten points that isn't convex.
STAR = ((50, 0), (20, 15), (15, 48), (-6, 19), (-40, 29), (-25, 0), (-40, -30), (-6, -19), (15, -47), (20, -15))
_EDGES = " UNION ALL ".join(f"SELECT {dx} AS dx, {dy} AS dy, {ex} AS ex, {ey} AS ey" for (dx, dy), (ex, ey) in zip(STAR, STAR[1:] + STAR[:1], strict=True))


@query(f"""
WITH k AS ({_EDGES}), s AS (SELECT n_nationkey AS id, (n_nationkey * 37 % 101) * 3.0 AS cx, (n_nationkey * 53 % 97) * 3.0 AS cy, 1.0 + n_nationkey % 4 AS z FROM nation),
e AS (SELECT id, cx + z * dx AS x1, cy + z * dy AS y1, cx + z * ex AS x2, cy + z * ey AS y2 FROM s, k), p AS (SELECT c_custkey AS point_id, c_custkey * 7 % 701 - 150 + c_nationkey / 32.0 AS px, c_custkey * 11 % 691 - 150.0 AS py FROM customer)
SELECT point_id, id FROM p JOIN e ON (y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 GROUP BY point_id, id HAVING count(*) % 2 = 1""")
def q_points_in_stars(t):
    """Shapes that overlap and aren't convex, on a grid much finer than they are."""
    k = F.col("n_nationkey")
    corner = F.explode(F.array(*(F.struct(F.lit(n).alias("n"), F.lit(float(dx)).alias("dx"), F.lit(float(dy)).alias("dy")) for n, (dx, dy) in enumerate(STAR))))
    z = 1.0 + k % 4
    rings = t.nation.select(k.alias("id"), ((k * 37 % 101) * 3.0).alias("cx"), ((k * 53 % 97) * 3.0).alias("cy"), z.alias("z"), corner.alias("c")).select("id", F.lit(0).alias("ring"), "c.n", (F.col("cx") + F.col("z") * F.col("c.dx")).alias("x"), (F.col("cy") + F.col("z") * F.col("c.dy")).alias("y"))
    points = t.customer.select(F.col("c_custkey").alias("point_id"), (F.col("c_custkey") * 7 % 701 - 150 + F.col("c_nationkey") / 32.0).alias("px"), (F.col("c_custkey") * 11 % 691 - 150.0).alias("py"))
    return places.points_in_polygons(points, places.ring_edges(rings), 20.0)
