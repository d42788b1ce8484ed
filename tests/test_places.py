"""Points in polygons by cells against the plain even-odd rule, on shapes and points that meet the lattice."""

import numpy as np
import pytest

from cairn.operators import places
from cairn.operators.places import points_in_polygons, polygon_cells, ring_edges


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def shapes():
    rng = np.random.default_rng(4)
    out = {
        0: [[(0, 0), (8, 0), (8, 8), (0, 8)], [(2, 2), (6, 2), (6, 6), (2, 6)]],  # on the lattice, with a hole
        1: [[(1, 1), (9, 1), (5, 9)]],
        2: [[(0, 0), (10, 0), (10, 1), (1, 1), (1, 9), (10, 9), (10, 10), (0, 10)]],  # a bracket
        3: [[(5, -3), (7, 5), (15, 5), (8, 9), (11, 17), (5, 12), (-2, 17), (2, 9), (-5, 5), (3, 5)]],  # a star
        4: [[(0.5, 0.5), (0.75, 0.5), (0.75, 0.75)]],  # within one cell
    }
    for k in range(5, 12):  # rings that cross themselves, whole and broken coordinates
        out[k] = [[tuple(map(float, p)) for p in (rng.integers(-6, 14, (9, 2)) if k % 2 else np.round(rng.uniform(-6, 14, (9, 2)), 2))]]
    return out


@pytest.mark.parametrize("cell", [1.0, 0.7, 0.1, 40.0])
def test_equals_the_plain_rule(spark, cell):
    polygons = shapes()
    rows = [(k, r, n, float(x), float(y)) for k, rings in polygons.items() for r, ring in enumerate(rings) for n, (x, y) in enumerate(ring)]
    edges = ring_edges(spark.createDataFrame(rows, "id int, ring int, n int, x double, y double"))
    rng = np.random.default_rng(1)
    places = [(x / 2, y / 2) for x in range(-14, 32) for y in range(-14, 38)] + [tuple(p) for p in rng.uniform(-8, 18, (500, 2)).tolist()]
    points = spark.createDataFrame([(k, *p) for k, p in enumerate(places)] + [(-1, None, 1.0)], "point_id int, px double, py double")
    got = {tuple(r) for r in points_in_polygons(points, edges, cell).collect()}
    assert got == {(k, i) for k, (x, y) in enumerate(places) for i, rings in polygons.items() if inside(x, y, rings)}


def test_only_boundary_cells_hold_edges(spark):
    ring = [(0, 0, n, x, y) for n, (x, y) in enumerate([(0.5, 0.5), (99.5, 0.5), (99.5, 99.5), (0.5, 99.5)])]
    cells = polygon_cells(ring_edges(spark.createDataFrame(ring, "id int, ring int, n int, x double, y double")), 1.0)
    rows = cells.selectExpr("edges IS NULL AS whole", "coalesce(size(edges), 0) AS n").groupBy("whole").agg({"*": "count", "n": "max"}).collect()
    assert {r.whole: (r["count(1)"], r["max(n)"]) for r in rows} == {True: (98 * 98, 0), False: (4 * 99, 2)}


def test_no_list_is_made_for_a_word_of_a_text(spark):
    texts = spark.createDataFrame([(1, "New York City, and york; York City"), (2, "york"), (3, ""), (4, None), (5, "new")], "text_id int, text string")
    names = spark.createDataFrame([("new york city", 7), ("york", 8), ("York", 9), ("york city", 8)], "name string, place_id int")
    found = places.named_spans(texts, names, 3)
    assert sorted(map(tuple, found.collect())) == [(1, 0, 3, 1, 7), (1, 4, 1, 2, 8), (1, 5, 2, 1, 8), (2, 0, 1, 2, 8)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(arrays_zip" in plan and "explode(transform" not in plan
