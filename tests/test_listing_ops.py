"""Listing operators, sources, sinks and streams."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from gavelbase.functions import clean, extract
from gavelbase.functions.text import is_blank, norm_id, time_seconds
from gavelbase.operators import conform, dedupe, joins, merge, sequences
from gavelbase.sources import documents, jsonlines, sinks, workbook
from gavelbase.streaming.append_log import current_version, read_latest, upsert_log, windowed_counts


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("x")).first()[0]


@pytest.mark.parametrize("f,value,want", [
    (clean.one_line, " a　 b\n c ", "a b c"), (clean.tidy_lines, "a\r\n\n\nb  c", "a\nb c"), (clean.compact, "a  b", "a b"), (clean.label, "建筑 面积：", "建筑面积"),
    (clean.url, "//x.y/a/", "https://x.y/a"), (clean.number_in_link, "https://x/123456?x", "123456"), (clean.jsonp, 'cb({"a":1});', '{"a":1}'), (clean.jsonp, "plain", "plain"),
    (clean.money, "约1,234.5万元", 12345000.0), (clean.money, "0.5亿", 5e7), (clean.day, "2024年3月5日", "2024-03-05"), (clean.day, "unknown-date-x", "unknown-da"), (clean.number, "1d", None), (clean.number, "nan", None), (clean.number, "1,200.5", 1200.5),
    (clean.division, "清远市", "清远"), (clean.division, "市区", "市区"), (clean.code_prefix, "440000", "44"), (clean.code_prefix, "440100", "4401"), (clean.epoch_text, "1700000000000", "2023-11-14 22:13:20"), (clean.epoch_text, "0", None), (clean.legal, "a\x01b", "ab"),
    (norm_id, " 123.0 ", "123"), (norm_id, "６２００００３３６３０２", "620000336302"), (norm_id, "１２３．０", "123"), (time_seconds, "2024/4/7 4:22:44", 1712463764), (time_seconds, "2024年09月08日 05时30分33秒", 1725773433), (time_seconds, "none", None), (lambda c: clean.truncate(c, 2), "abc", "ab..."),
])
def test_scalars(spark, f, value, want):
    assert one(spark, value, f) == want


def test_blank_words(spark):
    df = spark.createDataFrame([(x,) for x in (None, "", "　", "NaN", " / ", "N/A", "0", "x")], "c string")
    assert [r[0] for r in df.select(is_blank(F.col("c"))).collect()] == [True] * 6 + [False] * 2


def test_text_key_and_array_functions(spark):
    assert clean.text_key_of("网络司法拍卖 Ａ１栋&amp;（一套）") == "网络a1栋&一套" and clean.text_key_of("第一次拍卖 位于某路的住宅") == "某路的" and clean.text_key_of("NaN") == clean.text_key_of(None) == ""
    df = spark.createDataFrame([("甲；乙|丙\n丁",)], "c string")
    assert df.select(clean.split_joined(F.col("c"))).first()[0] == ["甲", "乙", "丙", "丁"]
    assert df.select(clean.add_to_set(F.lit("a；b"), "b"), clean.add_to_set(F.lit(None).cast("string"), "b")).first()[:] == ("a；b", "b")
    assert spark.range(1).select(F.array_join(clean.keyword_sentences(F.lit("近地铁。有学校！无"), ["学校"]), "|")).first()[0] == "有学校！"
    assert one(spark, "甲。乙！\n丙1.5米. 丁；；甲。", clean.sentences, "string") == ["甲。", "乙！", "丙1.5米.", "丁；"]


def test_keep_most_complete_and_group_reduce(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("a", 2, "v", "y"), ("a", 3, "w", "z"), ("b", 4, "", "")], "k string, s int, p string, q string")
    assert sorted(r.s for r in dedupe.keep_most_complete(df, F.col("k"), F.col("s"), ["p", "q"]).collect()) == [2, 4]
    assert sorted(r.s for r in dedupe.keep_last(df, F.col("k"), F.col("s")).collect()) == [3, 4]
    got = {r.k: (r.first_seen, r.p, r.q) for r in dedupe.group_reduce(df, "k", ["p", "q"], F.col("s") == 3, F.col("s")).collect()}
    assert got == {"a": (1, "w", "z"), "b": (4, None, None)}
    assert dedupe.keep_last(df.limit(0), F.col("k"), F.col("s")).count() == 0
    assert {r.k: r.joined for r in dedupe.joined_values(df, "k", F.col("q"), F.col("s"), 2).collect()} == {"a": "x；y"}


def test_join_rules(spark):
    base = spark.createDataFrame([(1, "b1", "x"), (2, "b2", "")], "id int, v string, w string")
    detail = spark.createDataFrame([(1, "", "n1")], "id int, v string, n string")
    rows = lambda df, *c: sorted(tuple(r[x] for x in c) for r in df.collect())
    assert rows(joins.base_wins(base, detail, "id"), "id", "v", "n") == [(1, "b1", "n1"), (2, "b2", None)]
    assert rows(joins.base_wins(base, detail, "id", "inner"), "id") == [(1,)]
    assert rows(joins.detail_wins(base, detail, "id").fillna("-"), "id", "v") == [(1, ""), (2, "-")]
    assert rows(joins.override(base, detail, "id"), "id", "v") == [(1, ""), (2, "b2")]
    got = joins.fill_from(base, spark.createDataFrame([(2, "new")], "id int, s string"), "id", {"w": "s"}).collect()
    assert {r.id: (r.w, r.changed) for r in got} == {1: ("x", []), 2: ("new", ["w"])}
    patch = spark.createDataFrame([(2, "p", "p"), (3, "q", "q")], "id int, v string, w string")
    assert rows(joins.overlay(base, patch, "id"), "id", "v") == [(1, "b1"), (2, "p"), (3, "q")]
    assert rows(joins.overlay(base, patch, "id", append=False), "id", "v") == [(1, "b1"), (2, "p")]
    assert rows(joins.pending(base, detail, "id", F.lit(True)), "id") == [(2,)] and rows(joins.only(base, detail, "id"), "id") == [(1,)]


def test_conform_and_headers(spark):
    df = spark.createDataFrame([("1", " ", "面")], "a string, b string, c string")
    got = conform.conform(df, ["b", "z", "a"], {"b": ["x", "c"]}, {"a": F.col("c")}, {"z": "未知"}).first()
    assert got.asDict() == {"b": "面", "z": "未知", "a": "面"}
    assert conform.unique_headers(["a", "", "a", None]) == ["a", "列2", "a_2", "列4"]
    assert conform.ordered(df, ["c", "n"]).columns == ["c", "n", "a", "b"]
    with pytest.raises(ValueError):
        conform.require(df, ["q"])


def test_sequences_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sequences, "RANGE_ROWS", 7)
    values = [(k * 3, (k * 7919) % 5) for k in range(100)]
    df = spark.createDataFrame(values, "o bigint, v bigint")
    got = {r.o: r.s for r in sequences.running(df, F.col("o"), F.col("v"), "s").collect()}
    total, want = 0, {}
    for o, v in values:
        total += v
        want[o] = total
    assert got == want
    assert sequences.until(df, F.col("o"), F.col("o") >= 30).count() == 11 and sequences.until(df, F.col("o"), F.col("o") > 999).count() == 100
    assert sequences.after_last(df, F.col("o"), F.col("o") == 30).count() == 89


RULES = merge.Rules("link", "id", "title", "end", ("addr", "title"), {"area": ("area",), "price": ("price",), "date": ("end",)}, (("area", "price"), ("area", "date"), ("price", "date")), {"area": 2})


def brute(rows):
    f = merge.Fold(RULES)
    for source, n, row in rows:
        f.add(dict(row), source, n)
    return sorted(tuple(m) for m in f.members)


def test_platform_merge_equals_the_whole_fold(spark):
    import random

    r = random.Random(5)
    cols = ["link", "id", "title", "end", "addr", "area", "price"]
    rows = []
    for n in range(240):
        unit = r.randrange(40)
        row = {"link": r.choice(["", f"l{r.randrange(90)}"]), "id": f"{r.randrange(120)}.0", "title": r.choice(["", f"很长的标题文字编号{unit % 9}"]), "end": r.choice(["", f"2024-01-{unit % 28 + 1:02}"]), "addr": r.choice(["", f"某路某号某花园{unit}栋"]), "area": r.choice(["", f"{unit + 50}.5㎡"]), "price": r.choice(["", f"{unit + 10}万"])}
        rows.append(("jd" if n < 120 else "ali", n, row))
    df = spark.createDataFrame([(s, n, *(row[c] for c in cols)) for s, n, row in rows], "source string, o bigint, " + ", ".join(f"{c} string" for c in cols))
    got = merge.merge_platforms(df, "source", "o", RULES).collect()
    assert sorted(tuple(x.members) for x in got) == brute(rows)
    assert any(len(x.sources) == 2 for x in got)


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"1","v":"a"}\n\n[1]\nbroken{\n{"id":"1","v":"b"}\n{"id":"","v":"c"}\n', encoding="utf-8")
    rows = jsonlines.read_lines(spark, str(tmp_path / "a.jsonl"), ["id", "v", "none"])
    assert rows.count() == 3 and [r.v for r in jsonlines.latest(rows, "id", "_at").collect()] == ["b"]
    jsonlines.append(rows.select("id"), str(tmp_path / "out"))
    jsonlines.append(rows.select("id"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 6
    assert jsonlines.read_state(spark, str(tmp_path / "none.json"), "a string").count() == 0


def test_workbook_round_trip(spark, tmp_path):
    spark.dataSource.register(workbook.WorkbookSource)
    df = spark.createDataFrame([("1", "a<&>\x01"), ("2", None)], "`编号` string, v string")
    workbook.write_workbook(df, str(tmp_path / "x.xlsx"))
    got = spark.read.format("workbook").option("path", str(tmp_path / "x.xlsx")).load()
    assert got.columns == ["编号", "v", "_row"] and sorted(tuple(r) for r in got.collect()) == [("1", "a<&>", 1), ("2", "", 2)]


def test_attachments_and_pages(spark, tmp_path):
    folder = tmp_path / "77"
    folder.mkdir()
    (folder / "a.txt").write_bytes("文本内容".encode("gb18030"))
    (folder / "b.txt").write_bytes(b"<!DOCTYPE html><html>")
    (folder / "d.bin").write_bytes(b"x")
    with zipfile.ZipFile(folder / "c.docx", "w") as z:
        z.writestr("word/document.xml", "<w:p><w:t>一段</w:t></w:p><w:p><w:t>二段&amp;</w:t></w:p>")
    got = {r.name: (r.item_id, r.text) for r in documents.read_attachments(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": ("77", "文本内容"), "c.docx": ("77", "一段\n二段&")}
    text, rows = documents.page_parts("<style>x</style><p>标题&nbsp;一</p><table><tr><td>面积</td><td>80 <b>㎡</b></td></tr></table>")
    assert text.startswith("标题 一") and rows == [["面积", "80 ㎡"]] and documents.page_parts(None) == ("", [])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a\x02", 1), ("b", 2)], "c string, n int")
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert sorted(r.c for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()) == ["a", "b"]
    sinks.write_table(df, str(tmp_path / "t"), ["n"])
    assert spark.read.parquet(str(tmp_path / "t")).where("n = 2").count() == 1
    sinks.write_report(df, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())["rows"][1] == {"c": "b", "n": 2}
    with pytest.raises(ValueError):
        sinks.write_report(df, str(tmp_path / "r.json"), 1)


def test_extractors():
    assert extract.sections("拍品名称：甲宅\n欠费情况：无欠费\n拍品名称：乙") == {"拍品名称": "甲宅", "欠费情况": "无欠费"}
    assert extract.labelled("产权证号：粤123；建筑总面积：80㎡\n所在楼层\n3层") == {"权证情况": "粤123", "建筑面积": "80㎡", "所在层": "3层"}
    assert extract.form_rows([["标的名称", "甲宅", "用途", "/"], ["序号", "建筑面积", "所在层", "总层数"], ["1", "80", "3", "9"]]) == {"标的物名称": "甲宅", "建筑面积": "80", "所在层": "3", "总层数": "9"}
    assert extract.inline("建筑面积为80.5平方米，所在层为第3层，总层数9层，建成于2010年") == {"建筑面积": "80.5", "所在层": "3", "总层数": "9", "竣工时间": "2010年"}
    assert extract.label_section("介绍\n周边配套：近公园、学校\n其他") == "近公园、学校"
    assert extract.description(None) == {} and extract.form_rows(None) == {}


@pytest.mark.parametrize("text,want", [
    ("岭海省碧江市绿洲区某路", ("岭海省", "碧江市", "绿洲区")), ("岭海鹤洲市孝感县某路", ("岭海", "鹤洲市", "孝感县")), ("碧江市绿洲区某路", ("", "碧江市", "绿洲区")), ("广东省东莞市东莞市南城街道1号", ("广东", "东莞市", "")), ("广东广州市天河区天河路", ("广东", "广州市", "天河区")), ("北京市朝阳区某路", ("北京市", "北京市", "朝阳区")), (None, ("", "", "")),
])
def test_regions(spark, text, want):
    assert tuple(one(spark, text, extract.region_parts)) == want


def test_all_sheets_of_a_workbook(tmp_path, spark):
    parts = {f"xl/worksheets/sheet{k}.xml": f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{rows}</sheetData></worksheet>' for k, rows in ((1, '<row r="1"><c r="A1" t="inlineStr"><is><t>甲</t></is></c></row>'), (2, ""), (3, '<row r="1"><c r="B1" t="inlineStr"><is><t>乙</t></is></c></row>'))}
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        for n, t in parts.items():
            z.writestr(n, t)
    assert documents.attachment_text("a.xlsx", (tmp_path / "a.xlsx").read_bytes()) == "甲\n乙"
    spark.dataSource.register(workbook.WorkbookSource)
    workbook.write_workbook(spark.createDataFrame([(str(k), f"v{k}", "x") for k in range(10)], "a string, b string, c string").orderBy("a"), str(tmp_path / "b.xlsx"))
    got = spark.read.format("workbook").option("path", str(tmp_path / "b.xlsx")).option("columns", "c|b|none").option("start", "3").option("limit", "2").load()
    assert got.columns == ["c", "b", "_row"] and sorted(tuple(r) for r in got.collect()) == [("x", "v3", 4), ("x", "v4", 5)]


def test_append_log_stream_equals_batch(spark, tmp_path):
    log, table, mark = (str(tmp_path / x) for x in ("log", "table", "mark"))
    first = [("a", 1, "x"), ("b", 1, "y"), ("a", 3, "z")]
    second = [("a", 2, "late"), ("b", 5, "new"), ("c", 1, "c"), ("c", 1, "c")]
    for part in (first, second):
        spark.createDataFrame(part, "id string, t int, v string").write.mode("append").json(log)
        upsert_log(spark.readStream.schema("id string, t int, v string").json(log), table, mark, "id", ["t"]).awaitTermination()
    assert {r.id: r.v for r in read_latest(spark, table).collect()} == {"a": "z", "b": "new", "c": "c"}
    assert current_version(spark, table) == 1 and not list((tmp_path / "table").glob("_next*")) and read_latest(spark, str(tmp_path / "none")) is None


def test_windowed_counts(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.sql("select timestamp'2024-01-01 00:10:00' as ts, 'a' as kind union all select timestamp'2024-01-01 00:50:00', 'a' union all select timestamp'2024-01-01 02:00:00', 'b'").write.parquet(path)
    stream = windowed_counts(spark.readStream.schema("ts timestamp, kind string").parquet(path), "ts", "kind")
    q = stream.writeStream.format("memory").queryName("w_counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.kind, r.n) for r in spark.table("w_counts").collect()) == [("a", 2), ("b", 1)]


def test_a_query_finds_all_categories(spark):
    from gavelbase.operators.nearest import CATEGORIES
    from gavelbase.plans.listings import QUERIES

    got = QUERIES["nearest_all_categories"](spark, "/root/testdata/sf0.001")
    assert {r.category for r in got.select("category").distinct().collect()} == set(CATEGORIES)


def test_pipeline_resumes(spark, tmp_path):
    from gavelbase.plans.pipeline import Pipeline

    p, fail = Pipeline(spark, str(tmp_path)), [True]
    p.stage("a")(lambda run: spark.range(3))

    @p.stage("b")
    def b(run):
        if fail[0]:
            raise RuntimeError("stop")
        return run.table("a").where("id > 0")

    assert [r["ran"] for r in p.run(dry=True)] == [False, False]
    with pytest.raises(RuntimeError):
        p.run()
    fail[0] = False
    assert [r["ran"] for r in p.run()] == [False, True] and p.table("b").count() == 2
    assert [r["ran"] for r in p.run(again=("a",))] == [True, True] and [r["ran"] for r in p.run(until="a")] == [False]


def test_pipeline_over_the_tables(spark, tmp_path):
    import run_pipeline

    d = "/root/testdata/sf0.001"
    p = run_pipeline.build(spark, d, str(tmp_path))
    assert [n for n, _ in p.stages] == ["index", "jd_detail", "ali_detail", "ali_second_pass", "aligned", "merged", "organised", *run_pipeline.OPERATORS, *run_pipeline.AFTER]
    p.run(until="organised")
    assert {r.source for r in p.table("aligned").select("source").distinct().collect()} == {"jd", "ali"}
    # every aligned row is a member of one organised row
    members = [m for r in p.table("organised").select("members").collect() for m in r.members]
    assert sorted(members) == sorted(r.row_id for r in p.table("aligned").select("row_id").collect())
    assert {"traffic", "services", "setting", "words", "标题"} <= set(p.table("organised").columns)
    landed = [F.struct(norm_id(F.col("标的物ID")))]
    for stage, name in (("jd_detail", "jd_api_detail_backfill"), ("ali_detail", "ali_sf_api_detail_backfill")):
        ids = spark.read.parquet(f"{d}/{name}.parquet").where("`标的物ID` is not null").select(*landed).distinct().count()
        assert p.table(stage).where("`标的物ID` is not null").count() == ids


def test_documents_kept(spark):
    import run_pipeline

    docs = spark.createDataFrame([(k,) for k in range(1, 7)], "doc_id bigint")
    leaks = spark.createDataFrame([(1, 9), (6, 9)], "doc_id bigint, item_id bigint")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "doc_id_a bigint, doc_id_b bigint")
    assert sorted(r.doc_id for r in run_pipeline.kept(docs, leaks, pairs).collect()) == [2, 4, 5]


def test_queries_of_whole_columns(spark, tmp_path):
    from gavelbase.plans.listings import ALI2, QUERIES

    d = str(tmp_path)
    spark.createDataFrame([(1,), (2,)], "c_nationkey int").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame([(7, 1)], "s_suppkey int, s_nationkey int").write.parquet(f"{d}/supplier.parquet")
    assert [r.k for r in QUERIES["except_all_keys"](spark, d).collect()] == [2]
    spark.createDataFrame([(1, None), (2, "b|a；b"), (3, "所在层,")], "row_id bigint, `附件正文二次解析更新列` string").write.parquet(f"{d}/{ALI2}.parquet")
    assert {r.row_id: r.names for r in QUERIES["changed_column_sets"](spark, d).collect()} == {1: "所在层", 2: "a；b；所在层", 3: "所在层"}
