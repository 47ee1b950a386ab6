"""The core operators for locations, quantities and packed cells: brute force, round trips and awkward input."""

import csv
import io
import json

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gavelbase.functions.numerals import han_number
from gavelbase.operators import slabs, units
from gavelbase.operators.packed import split_cells, split_packed

ITEM = st.text(alphabet='ab标 "、', max_size=6)


@settings(max_examples=200, deadline=None)
@given(st.lists(ITEM, min_size=2, max_size=5), st.sampled_from(";,|，；"))
def test_quoted_cells_round_trip(items, mark):
    cell = mark.join('"' + x.replace('"', '""') + '"' for x in items)
    got = split_cells(pa.array([cell, None, cell]), "plain").to_pylist()
    assert got[0] == [x.strip() for x in items] and got[1] == [] and got[2] == got[0]


@settings(max_examples=100, deadline=None)
@given(st.lists(ITEM, min_size=2, max_size=5))
def test_json_cells_round_trip(items):
    for ascii_only in (True, False):
        assert split_cells(pa.array([json.dumps(items, ensure_ascii=ascii_only)]), "plain").to_pylist() == [[x.strip() for x in items]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abc;", min_size=1, max_size=5), min_size=2, max_size=5))
def test_csv_rows_agree_with_the_csv_reader(items):
    out = io.StringIO()
    csv.writer(out, delimiter=",", quoting=csv.QUOTE_ALL, lineterminator="").writerow(items)
    assert split_cells(pa.array([out.getvalue()]), "plain").to_pylist() == [next(csv.reader([out.getvalue()]))]


def test_shapes_keep_delimiters_that_belong_to_a_value():
    assert split_cells(pa.array(["询价结果,复核件.pdf；看样|预约表.pdf；须知3.jpg"]), "file").to_pylist() == [["询价结果,复核件.pdf", "看样|预约表.pdf", "须知3.jpg"]]
    assert split_cells(pa.array(["https://f/A?a=1;b=66\nhttps://f/B?ids=2,3；https://f/C?k=a|8"]), "link").to_pylist() == [["https://f/A?a=1;b=66", "https://f/B?ids=2,3", "https://f/C?k=a|8"]]
    assert split_cells(pa.array(["；a.pdf；"]), "file").to_pylist() == [["", "a.pdf", ""]]


def test_split_packed_awkward_input(spark):
    rows = [(1, "a;b", "x", 1), (1, "a;b", "x", 1), (2, None, None, None), (3, "", "y", 2), (4, 'un"closed;b', None, 3), (None, "p;q", None, 4), (5, "z" * 300_000 + ";w", None, 5)]
    df = spark.createDataFrame(rows, "row_id bigint, cell string, _id string, item_text int")
    got = [tuple(r) for r in split_packed(df, {"cell": "plain"}).collect()]
    assert got.count((1, "cell", 1, "a", 2)) == 2 and (None, "cell", 2, "q", 2) in got
    assert (4, "cell", 1, 'un"closed', 2) in got and (5, "cell", 2, "w", 2) in got and not any(r[0] in (2, 3) for r in got)
    assert split_packed(df.limit(0), {"cell": "plain"}).count() == 0
    with pytest.raises(ValueError):
        split_packed(df, {"cell": "odd"})


CASES = [
    ("area", "94.33平方", "", 94.33), ("area", "七十五点八二平方米", "", 75.82), ("area", "约47.78M2", "", 47.78), ("area", "4.33坪", "", 4.33 * 400 / 121), ("area", "1,853.7 sq.ft", "", 1853.7 * 0.09290304), ("area", "0.3957ha", "", 3957.0),
    ("area", "建筑面积55.90㎡（套内45.84㎡）", "", 55.90), ("area", "套内45.84㎡，建筑面积55.90㎡", "", 55.90), ("area", "1148.5", "建筑面积为1148.5平方英尺。", 1148.5 * 0.09290304), ("area", "71.90", "建筑面积71.90平方米。", 71.9), ("area", "846.4", "面积数据846.4单位为平方英尺。", 846.4 * 0.09290304),
    ("area", "详见评估报告", "", None), ("area", "见第3页", "", None), ("area", "", "", None), ("floor", "25/45层", "", 25), ("floor", "负1楼", "", -1), ("floor", "地下一层", "", -1), ("floor", "B1", "", -1), ("floor", "架空层", "", None), ("floor", "底层一楼", "", 1), ("floor", "首层", "", 1), ("floor", "第十四层", "", 14), ("floor", "10层/共28层", "", 10),
    ("floors", "总高二十八层", "", 28), ("floors", "地上45层", "", 45), ("floors", "１７层", "", 17), ("floors", "/", "", None), ("money", "人民币113.46万元整", "", 1134600), ("money", "0.008921亿元", "", 892100), ("money", "1208.3千元", "", 1208300), ("money", "1，512，900元", "", 1512900), ("money", "壹佰零捌万零叁佰元整", "", 1080300),
    ("money", "RMB 472,700.00", "", 472700), ("money", "157.33", "评估总价为人民币157.\n33万元。", 1573300), ("money", "105.13", "（金额单位：万元）估价结果：105.13。", 1051300), ("money", "5.13", "（金额单位：万元）估价结果：105.13。", 5.13), ("money", "详见报告", "", None),
    ("area", "约1148.5", "建筑面积为1148.5平方英尺。", 1148.5 * 0.09290304), ("area", "1,148.5", "建筑面积为1148.5平方英尺。", 1148.5 * 0.09290304), ("area", "1148.5", "建筑面积为1,148.5平方英尺。", 1148.5 * 0.09290304), ("floors", "25/四十五层", "", 45), ("floor", "25/四十五层", "", 25), ("floor", "共28层", "", None), ("floor", "1.5层", "", None), ("money", "壹佰零捌万零叁佰元伍角贰分", "", 1080300.52), ("money", "壹佰万", "", 1000000),
]


@pytest.mark.parametrize("kind,cell,text,want", CASES)
def test_quantities(kind, cell, text, want):
    got = units.READERS[kind](cell, text)
    assert (got is None) if want is None else got[0] * units.UNITS[got[1]][2] == pytest.approx(want)


@given(st.integers(0, 10**9 - 1))
def test_formal_numerals_round_trip(n):
    digits, small = "零壹贰叁肆伍陆柒捌玖", ("", "拾", "佰", "仟")

    def four(k):
        s = ""
        for p in (3, 2, 1, 0):
            d = k // 10**p % 10
            s += digits[d] + small[p] if d else ("零" if s and not s.endswith("零") else "")
        return s.rstrip("零")

    parts = [(n // 10**8, "亿"), (n // 10**4 % 10**4, "万"), (n % 10**4, "")]
    text = "".join(four(k) + unit for k, unit in parts if k) or "零"
    assert han_number(text) == n


def test_convert_units_awkward_input(spark):
    rows = [(1, "10平", "t", 1), (1, "10平", "t", 1), (2, None, None, None), (3, " ", None, None), (4, "9" * 400, None, None), (5, "x" * 200_000 + "7平方米", None, None)]
    df = spark.createDataFrame(rows, "row_id bigint, `面/积` string, unit string, kind int")
    got = sorted((r.row_id, r.value) for r in units.convert_units(df, {"面/积": "area"}, "unit").collect())
    assert got == [(1, 10.0), (1, 10.0), (5, 7.0)]
    assert units.convert_units(df.limit(0), {"面/积": "area"}).count() == 0


def places(n, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    return [(int(i), float(a), float(b)) for i, a, b in zip(range(n), rng.normal(23, spread, n), rng.normal(113, spread, n))]


@pytest.mark.parametrize("limit", [slabs.BROADCAST_EDGES, 0])
def test_within_distance_against_brute_force(spark, limit):
    points, centres = places(400, 1) + [(9000, 23.0, 113.0), (9000, 23.0, 113.0), (9001, 89.99, 10.0), (9002, 10.0, 179.99)], places(60, 2) + [(700, 89.985, -170.0), (701, 10.0, -179.99), (702, 23.0, 113.0)]
    p = spark.createDataFrame([(*r, "x", 1) for r in points] + [(1, None, 3.0, "x", 1), (None, 23.0, 113.0, "x", 1)], "row_id bigint, lat double, lon double, pid string, region_id int")
    c = spark.createDataFrame(centres, "poi bigint, y double, x double")
    got = sorted((r.point_id, r.centre_id) for r in slabs.within_distance(p, c, 5000.0, ("row_id", "lat", "lon"), ("poi", "y", "x"), broadcast_edges=limit).collect() if r.point_id is not None)
    want = sorted((i, j) for i, a, b in points for j, u, v in centres if slabs.great_circle_m(a, b, u, v) <= 5000.0)
    assert got == want and (9001, 700) in want and (9002, 701) in want and want.count((9000, 702)) == 2
    assert slabs.within_distance(p.limit(0), c, 5000.0, ("row_id", "lat", "lon"), ("poi", "y", "x"), broadcast_edges=limit).count() == 0
    assert slabs.within_distance(p, c.limit(0), 5000.0, ("row_id", "lat", "lon"), ("poi", "y", "x"), broadcast_edges=limit).count() == 0


def test_centres_of_different_reach(spark):
    p = spark.createDataFrame([(1, 23.0, 113.0), (2, 23.02, 113.0)], "row_id bigint, lat double, lon double")
    c = spark.createDataFrame([(5, 23.0, 113.0, 1000.0), (6, 23.0, 113.0, 3000.0), (7, 23.0, 113.0, None), (8, 23.0, 113.0, -1.0)], "poi bigint, y double, x double, m double")
    for limit in (slabs.BROADCAST_EDGES, 0):
        assert sorted((r.point_id, r.centre_id) for r in slabs.within_distance(p, c, "m", ("row_id", "lat", "lon"), ("poi", "y", "x"), broadcast_edges=limit).collect()) == [(1, 5), (1, 6), (2, 6)]


def test_floors_come_from_the_automaton(monkeypatch):
    """Without the aliases of roles no floor below ground and no total is read."""
    assert units.floor("负1楼", "")[0] == -1 and units.floors("地上45层", "")[0] == 45
    monkeypatch.setattr(units, "roles_in", lambda text: {})
    assert units.floor("负1楼", "") is None and units.floors("地上45层", "") is None


@pytest.mark.parametrize("limit", [slabs.BROADCAST_EDGES, 0])
def test_points_in_crossing_regions_and_holes(spark, limit):
    star = [(0.0, 0.0), (1.0, 3.0), (2.0, 0.0), (-0.5, 2.0), (2.5, 2.0)]
    square, hole = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)], [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5)]
    regions = {1: [star], 2: [square, hole]}
    rng = np.random.default_rng(3)
    points = [(i, float(y), float(x)) for i, (x, y) in enumerate(rng.uniform(-1, 3, (500, 2)))]

    def inside(rings, x, y):  # even-odd ray casting
        odd = False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if (x1 > x) != (x2 > x) and y1 + (x - x1) * (y2 - y1) / (x2 - x1) < y:
                    odd = not odd
        return odd

    p = spark.createDataFrame(points, "id bigint, lat double, lon double")
    r = spark.createDataFrame([(k, [[{"lon": x, "lat": y} for x, y in ring] for ring in rings]) for k, rings in regions.items()], "rid bigint, rings array<array<struct<lon:double,lat:double>>>")
    got = sorted((x.point_id, x.region_id) for x in slabs.points_in_regions(p, r, ("id", "lat", "lon"), ("rid", "rings"), broadcast_edges=limit).collect())
    assert got == sorted((i, k) for i, y, x in points for k, rings in regions.items() if inside(rings, x, y))


def test_read_number(spark):
    df = spark.createDataFrame([(" 23.1 ",), ("nan",), ("1d",), ("",), (None,), ("　22.5　",), ("-1e2",), ("inf",)], "c string")
    assert [r[0] for r in df.select(slabs.read_number(F.col("c"))).collect()] == [23.1, None, None, None, None, 22.5, -100.0, None]
