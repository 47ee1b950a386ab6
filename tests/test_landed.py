"""Landed documents, pieces of text and assembled rows: planted cases and awkward input."""

import json

import pytest
from pyspark.sql import functions as F

from gavelbase.functions import extract, pieces
from gavelbase.operators import assemble, merge, nearest
from gavelbase.sources import landed, sinks, workbook


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("x")).first()[0]


def test_second_pages_unwrap_scenes_and_name_errors(spark):
    good = {"ret": ["SUCCESS::调用成功"], "data": {"data": {"scenes": [{"schemeList": [{"totalCount": "23", "page": 2, "pageSize": 0, "contentList": [{"itemId": "6.0", "consultPrice": 12345, "coordinate": "[113.2,23.1]", "tags": [{"alias": "变卖"}, {"name": "贷款"}, {}], "extraMap": {"bail": "500"}, "endTime": 1700000000000, "picURL": "//img/x"}]}]}]}}}
    pages = spark.createDataFrame([(1, "cb(" + json.dumps(good, ensure_ascii=False) + ");"), (2, json.dumps({"ret": ["FAIL"]})), (3, "<html>"), (4, None), (5, json.dumps({"ret": ["SUCCESS::调用成功"], "data": {}}))], "n int, body string")
    got = {r.n: (r.ok, r.total, r.page, r.page_size, r.error) for r in landed.second_pages(pages, keep=["n"]).collect()}
    assert got[1] == (True, 23, 2, 10, None) and got[2][0] is False and "FAIL" in got[2][4] and got[3][4].startswith("call failed") and got[4][0] is False and got[5] == (True, 0, 1, 10, None)
    r = landed.second_index(pages, keep=["n"]).collect()
    assert len(r) == 1 and (r[0]["标的物ID"], r[0]["评估价_元"], r[0]["保证金_元"], r[0]["经度"], r[0]["标签"], r[0]["图片链接"], r[0]["结束时间"]) == ("6", 123.45, 5.0, 113.2, "变卖、贷款", "https://img/x", "2023-11-14 22:13:20")


def test_first_index_and_configs(spark):
    body = json.dumps({"datas": [{"id": 7, "title": " 甲 ", "courtCityName": "某市", "currentPriceStr": "1万", "currentPrice": 10000, "bidCount": "3"}, {"id": "８.0"}]}, ensure_ascii=False)
    pages = spark.createDataFrame([(body,), ("",), ("[1]",), (None,)], "body string")
    got = {r["标的物ID"]: (r["标题"], r["城市"], r["当前价"], r["当前价_元"], r["出价次数"], r["链接"]) for r in landed.first_index(pages).collect() if r["标的物ID"]}
    assert got == {"7": ("甲", "某市", "1万", 10000.0, 3, "https://paimai.jd.com/7"), "8": ("", "", "", None, None, "https://paimai.jd.com/8")}
    conf = spark.createDataFrame([(json.dumps({"data": {"7": {"isSupport": True}}}),)], "body string")
    assert [(r["标的物ID"], r.config["isSupport"]) for r in landed.configs(conf).collect()] == [("7", "true")]


def test_detail_calls_and_chunks(spark):
    calls = spark.createDataFrame([("1", "basic", '{"a":1}', 1), ("1", "basic", "broken{", 2), ("1", "notice", "<p>x</p>", 1), ("2", "basic", None, 1), ("3", "basic", '{"a":1}', 1)], "id string, kind string, body string, _at int")
    got = {r.id: (r.errors, r.status, r.basic) for r in landed.detail_calls(calls, "id", "kind", "body", ("basic", "notice")).collect()}
    assert got == {"1": ("", "成功", '{"a":1}'), "2": ("basic；notice", "失败", None), "3": ("notice", "部分成功", '{"a":1}')}
    ids = spark.range(1000).select(F.concat(F.lit("id"), (F.col("id") % 700).cast("string")).alias("k"))
    chunks = landed.id_chunks(ids, "k", 50).collect()
    assert max(c.n for c in chunks) <= 50 and sorted(x for c in chunks for x in c.ids.split(",")) == sorted(f"id{k}" for k in range(700))
    assert landed.id_chunks(ids.limit(0), "k").count() == 0


def test_geocodes_and_elements(spark):
    answers = [{"geocodes": [{"location": "113.1,23.2", "city": "某市"}]}, {"result": {"location": {"lng": 113.5, "lat": 23.5}, "addressComponent": {"district": "某区"}}}, [{"lon": "1.5", "lat": "2.5"}], {"geocodes": []}]
    df = spark.createDataFrame([(k, json.dumps(a, ensure_ascii=False)) for k, a in enumerate(answers)] + [(9, None)], "k int, body string")
    got = {r.k: (r.lon, r.lat, r.city, r.district, r.found) for r in landed.geocodes(df, keep=["k"]).collect()}
    assert got == {0: (113.1, 23.2, "某市", "", True), 1: (113.5, 23.5, "", "某区", True), 2: (1.5, 2.5, "", "", True), 3: (None, None, "", "", False), 9: (None, None, "", "", False)}
    body = json.dumps({"elements": [{"id": 5, "center": {"lat": 1.0, "lon": 2.0}, "tags": {"a": "b"}}, {"id": 5, "center": {"lat": 1.0, "lon": 2.0}, "tags": {"a": "b"}}, {"id": 6, "lat": 3.0, "lon": 4.0}]})
    assert rows(landed.map_elements(spark.createDataFrame([(body,), ("broken",)], "body string")), "poi_id", "lat", "tags") == [(5, None, {"a": "b"}), (6, 3.0, {})]


def test_paths(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "b.txt").write_text("y")
    assert landed.first_path(spark, str(tmp_path / "none"), str(tmp_path / "empty"), str(tmp_path / "a.txt")).endswith("a.txt")
    assert landed.newest_path(spark, str(tmp_path / "*.txt")).endswith("b.txt") and landed.newest_path(spark, str(tmp_path / "*.no")) is None
    with pytest.raises(FileNotFoundError):
        landed.first_path(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("f,value,want", [
    (lambda c: pieces.labelled_amount(c, ["评估价", "市场价"], 1e3, 1e11), "评估价为5元，市场价：人民币12.5万元", 125000.0), (lambda c: pieces.labelled_amount(c, ["评估价"]), None, None), (lambda c: pieces.labelled_whole(c, ["报名人数"]), "报名人数：1,204人", 1204),
    (lambda c: pieces.windows(c, ["甲", "乙"], 1, 2, 2), "a甲b乙c", "a甲b；b乙c"), (pieces.amount_between, "5元", None), (pieces.dotted_day, "2024.3.05", None), (lambda c: pieces.dotted_day(c).cast("string"), "2024.03.05", "2024-03-05"),
    (pieces.lookup_address, "某人名下位于甲路1号（二拍）的不动产", "甲路1号"), (pieces.lookup_address, "住宅", "住宅"), (lambda c: pieces.photo_links(F.split(c, " ")), "//a/1.jpg http://b/logo.jpg //a/1.jpg http://c/2.PNG", ["https://a/1.jpg"]),
    (lambda c: pieces.compact_json(F.split(c, ","), c == ""), "a,b", '["a","b"]'), (lambda c: pieces.compact_json(F.split(c, ","), c == ""), "", ""), (lambda c: landed.bid_block(c)["保证金"], "起拍价：¥1,000 保证金 200.5 元", "200.5"),
    (lambda c: pieces.rights_passages(c)["rights"], "权利限制情况：已抵押\n成交后提供", "已抵押"), (lambda c: pieces.rights_passages(c)["house"], "标的物情况：两房\n特别提示：无", "两房"), (lambda c: pieces.rights_passages(c)["land"], "房屋权属状况：甲 土地权属状况：出让", "出让"),
])
def test_pieces(spark, f, value, want):
    assert one(spark, value, f) == want


def test_best_bid_and_attachments(spark):
    bids = spark.createDataFrame([(1, [("ok", 9.0, 5), ("deal", 8.0, 1), ("deal", 8.0, 2)]), (2, [("ok", 9.0, 5), ("ok", None, 7)]), (3, [])], "k int, b array<struct<status string, price double, time bigint>>")
    assert {r.k: r.t for r in bids.select("k", pieces.best_bid(F.col("b"))["time"].alias("t")).collect()} == {1: 2, 2: 5, 3: None}
    payload = json.dumps({"data": [{"name": "a.pdf", "fileId": 3, "href": "//x/a"}, {"title": "b.doc"}]})
    s = spark.createDataFrame([(payload,), ("{}",), (None,)], "c string").select(pieces.attachment_summary(pieces.attachments(F.col("c"))).alias("s")).collect()
    assert tuple(s[0].s) == (2, "a.pdf；b.doc", "3", "https://x/a") and [r.s.n for r in s[1:]] == [0, 0]


def test_maps_and_regions(spark):
    m = spark.createDataFrame([({"a": " ", "b": "1"}, {"a": "2", "b": "3", "c": "nan"}), (None, {"a": "4"})], "x map<string,string>, y map<string,string>")
    assert [r.m for r in m.select(pieces.first_said_map(F.col("x"), F.col("y")).alias("m")).collect()] == [{"a": "2", "b": "1"}, {"a": "4"}]
    df = spark.createDataFrame([("甲路", "某省", "某市", "某市"), ("某市甲路", "某省", "", ""), (None, "某省", "", "")], "a string, p string, c string, d string")
    assert [r[0] for r in df.select(pieces.with_region(F.col("a"), F.col("p"), F.col("c"), F.col("d"))).collect()] == ["某省某市甲路", "某市甲路", ""]


def test_fill_or_repair(spark):
    df = spark.createDataFrame([(1, " a  b ", "x"), (2, "", "y"), (3, "c", "z"), (4, None, "nan"), (5, "bad", "w")], "id int, v string, p string")
    clean = {"v": lambda c: F.when(c != "bad", F.regexp_replace(F.trim(c), " +", " "))}
    done = assemble.fill_or_repair(df, {"v": F.col("p")}, clean, "s")
    assert rows(done, "id", "v", "filled", "repaired", "fill_source") == [(1, "a b", [], ["v"], "s"), (2, "y", ["v"], [], "s"), (3, "c", [], [], ""), (4, None, [], [], ""), (5, "w", [], ["v"], "s")]
    assert rows(assemble.fill_counts(done, ["v"]), "field_name", "filled", "repaired", "kept") == [("v", 1, 2, 1)]
    assert assemble.copies(df, {"w": "v", "none": "q", "p": "v"}).columns == ["id", "v", "p", "w", "none"]
    patch = spark.createDataFrame([(1, "", "n"), (3, "new", "m")], "id int, v string, more string")
    assert rows(assemble.update_said(df.drop("p"), patch, "id"), "id", "v", "more")[:3] == [(1, " a  b ", "n"), (2, "", None), (3, "new", "m")]


def test_scopes_trees_and_ranges(spark):
    df = spark.createDataFrame([("g", "4401"), ("g", "4402"), ("g", None), ("g", "5101"), ("h", "5101")], "g string, code string")
    assert rows(assemble.in_scope(df, F.col("g"), F.col("code"), F.lit("44"), 0.7), "group", "coded", "inside", "in_scope") == [("g", 3, 3, True), ("h", 1, 0, False)]
    tree = spark.createDataFrame([("1", "甲", [("11", "子"), ("12", "丑")]), ("2", "乙", [])], "code string, name string, children array<struct<code string, name string>>")
    old = spark.createDataFrame([("1", "甲", [("19", "旧")]), ("2", "乙", [("21", "寅")])], "code string, name string, children array<struct<code string, name string>>")
    more = spark.createDataFrame([("丙", "镇", "31", 0)], "parent string, child string, code string, pos bigint")
    assert rows(assemble.tree_children({"new": tree, "old": old}, more), "parent", "child", "vintage") == [("丙", "镇", "override"), ("乙", "寅", "old"), ("甲", "丑", "new"), ("甲", "子", "new")]
    r = spark.sql("select 'k' as k, date'2022-06-01' as s, date'2024-02-01' as e, 9 as n")
    assert [str(x) for t in rows(assemble.day_ranges(r, ["k"], F.col("s"), F.col("e")), "range_start", "range_end") for x in t] == ["2022-06-01", "2022-12-31", "2023-01-01", "2023-12-31", "2024-01-01", "2024-02-01"]
    assert assemble.halved(r, "s", "e", F.col("n"), 5).count() == 2 and assemble.halved(r, "s", "e", F.col("n"), 9).count() == 1
    day = spark.sql("select date'2022-06-01' as s, date'2022-06-01' as e, 9 as n")
    assert assemble.halved(day, "s", "e", F.col("n"), 5).count() == 1


def test_row_contexts(spark):
    df = spark.createDataFrame([(1, "第3层 证号12345", "甲\n乙\n第 3层 | 住宅\n丙\n丁\n戊"), (2, "无", "第3层"), (3, None, None), (4, "第9层", "没有")], "row_id int, title string, t string")
    assert rows(assemble.row_contexts(df, "row_id", F.col("title"), F.col("t"), ["(第[0-9]+层)", "([0-9]{5,})"]), "row_id", "line_no", "context") == [(1, 3, "乙 第 3层 | 住宅 丙 丁")]


@pytest.mark.parametrize("text,want", [
    ("建筑面积约 88.5 平方米，所在层：第12层/共30层", {"建筑面积": "88.5", "所在层": "12", "总层数": "30"}), ("土地面积200平方米，套内建筑面积70㎡，总面积80㎡", {"建筑面积": "80"}), ("标的位于3楼，建成于1998年5月", {"所在层": "3", "竣工时间": "1998年5月"}), ("共 18层，第 5层", {"所在层": "5", "总层数": "18"}), ("建成年份：2003", {"竣工时间": "2003"}), ("六层砖混结构", {"总层数": "六"}), ("", {}), (None, {}),
])
def test_inline_tiers(spark, text, want):
    assert (one(spark, text, extract.inline_fields) or {}) == want and extract.inline(text) == want


def test_sheets_are_replaced_or_written_below(tmp_path):
    p = str(tmp_path / "a.xlsx")
    workbook.write_sheets({"甲&": [["a"], ["1"]], "乙": [["b"]]}, p)
    workbook.write_sheets({"乙": [["c"]]}, p, "replace")
    workbook.write_sheets({"甲&": [["2"]], "丙": [["d"]]}, p, "overlay")
    assert workbook.sheet_names(p) == ["甲&", "乙", "丙"]
    assert [list(r) for r in workbook.read_sheets(p)] == [[["a"], ["1"], ["2"]], [["c"]], [["d"]]]


def test_results_are_kept_when_a_place_fails(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    df = spark.range(3)
    aside = sinks.write_or_aside(df, str(tmp_path / "t"))
    assert aside.endswith("t") and spark.read.parquet(aside).count() == 3
    with pytest.raises(RuntimeError):
        sinks.save_then_raise(df, str(tmp_path / "w"), lambda: (_ for _ in ()).throw(RuntimeError("x")))
    assert any(p.name.startswith("w_error_") for p in tmp_path.iterdir())
    report = sinks.manifest(spark, str(tmp_path), {"北": aside})
    assert report["rows"] == [{"region": "北", "path": aside, "n": 3}]
    sinks.write_csv(spark.createDataFrame([("v",)], "c string"), str(tmp_path / "csv"), mark=True)
    assert any(p.read_bytes().startswith(b"\xef\xbb\xbf") for p in (tmp_path / "csv").glob("*.csv"))


def test_full_rules_equal_the_whole_fold(spark):
    import random

    r = random.Random(11)
    cols = ["链接", "标的物ID", "标题", "结束时间", "地址", "标的物名称", "建筑面积", "起拍价_元", "当前价_元", "评估价_元", "处置机构", "附件数量"]
    data = []
    for n in range(300):
        u = r.randrange(30)
        some = lambda v: r.choice(["", v, v])
        data.append(("jd" if n % 2 else "ali", n, {"链接": "", "标的物ID": str(r.randrange(150)), "标题": some(f"很长的标题文字编号甲乙{u % 7}"), "结束时间": some(f"2024-01-{u % 28 + 1:02}"), "地址": some(f"某路某号某花园第{u}栋"), "标的物名称": some(f"某花园第{u}栋不动产名"), "建筑面积": some(f"{u + 50}.5㎡"), "起拍价_元": some(f"{u}万"), "当前价_元": some(f"{u + 1}万"), "评估价_元": some(f"{u + 9}万"), "处置机构": some(f"某某法院{u % 3}"), "附件数量": r.choice(["", "3", "99"])}))
    df = spark.createDataFrame([(s, n, *(row[c] for c in cols)) for s, n, row in data], "source string, o bigint, " + ", ".join(f"`{c}` string" for c in cols))
    got = merge.merge_platforms(df, "source", "o", merge.FULL_RULES).collect()
    fold = merge.Fold(merge.FULL_RULES)
    for s, n, row in data:
        fold.add(dict(row), s, n)
    assert sorted(tuple(x.members) for x in got) == sorted(tuple(m) for m in fold.members) and any(len(x.sources) == 2 for x in got)


def test_surroundings_by_place(spark):
    e = spark.createDataFrame([(1, 23.0, 113.0, None, {"leisure": "park", "shop": "mall"}), (2, None, None, (23.001, 113.0), {"amenity": "school", "name": "某小学"})], "poi_id bigint, lat double, lon double, center struct<lat double, lon double>, tags map<string,string>")
    p = spark.createDataFrame([(1, 23.0, 113.0), (2, 23.0, 113.0), (3, 20.0, 110.0), (4, None, 1.0)], "row_id bigint, lat double, lon double")
    got = {r.coord_key: (r["公园-公园"], r["购物-商场"], r["教育-小学"], r["教育-中学"]) for r in nearest.surroundings_by_place(p, e).collect()}
    assert got == {"23.000000,113.000000": ("0m", "0m", "111m", ""), "20.000000,110.000000": ("", "", "", "")}
