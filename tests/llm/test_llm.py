"""The training-data operators against brute force, planted cases and awkward input."""

import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from gavelbase.functions.text import id_number, time_seconds
from gavelbase.llm import consensus, entities, glyphs, leakage, linkage, mixing, scans
from gavelbase.llm.address import PARSED, Places, ending, features, parse, sound
from gavelbase.llm.queries import usable_area, usable_text

PLACES = Places.of([("碧江市", "绿洲区"), ("岚山市", "蓝湾区"), ("珠溪市", "枫桥区")], ["岭海"])


# 1 -- representatives
def best(df, weights="recency"):
    return consensus.representatives(df, id_number(F.col("标的物ID")), {"a": usable_text(F.col("a")), "b": usable_area(F.col("b"))}, time_seconds(F.col("at")), weights=weights)


def test_representatives_take_the_latest_usable_value(spark):
    rows = [
        (1, "７.0", "2024-01-01 00:00:00", "旧的说法", "80㎡", "x"), (2, " 7", "2024/1/2 0:00:00", "新的说法", "0㎡", "x"), (3, "7", "2024-01-03T00:00:00", "详见附件", None, "x"), (4, "7", "2024年01月02日 00时00分00秒", "新的说法", "见附件", "x"),
        (5, "8", None, "只此一句", "", "x"), (6, "8", "2024-01-01 00:00:00", "被截断……", "61.88", "x"), (7, None, "2024-01-01 00:00:00", "无号", "1", "x"), (8, "9", "2024-01-01 00:00:00", "nan", "未知", "x"), (9, "9", "2024-01-01 00:00:00", "附件下载失败:timeout", "/", "x"),
    ]
    df = spark.createDataFrame(rows, "row_id bigint, `标的物ID` string, at string, a string, b string, v string").withColumn("item", F.lit("clash")).withColumn("t", F.lit(1)).withColumn("n", F.lit(2))
    got = {(r.item, r.field_name): (r.value, r.row_id, r.n_rows, r.n_usable) for r in best(df).collect()}
    assert got == {(7, "a"): ("新的说法", 2, 4, 3), (7, "b"): ("80㎡", 1, 4, 1), (8, "a"): ("只此一句", 5, 2, 1), (8, "b"): ("61.88", 6, 2, 1)}
    assert best(df.limit(0)).count() == 0


def test_consensus_votes_per_column():
    votes = [consensus.tokens(x) for x in ("空置钥匙已移交", "空置钥匙未移交", "空置，钥匙已移交")]
    assert "".join(consensus.consensus(votes, [1.0, 1.0, 1.0])) == "空置钥匙已移交"
    long = "字" * 5000
    assert consensus.edits(consensus.tokens(long + "甲"), consensus.tokens(long + "乙丙")) == 2
    assert consensus.edits(consensus.tokens("a" * 3000), ()) == 1


def test_long_differing_middles_are_aligned_exactly(monkeypatch):
    r = random.Random(7)
    a = [chr(0x4E00 + r.randrange(3000)) for _ in range(900)]
    b = a[:5] + ["甲"] + a[5:450] + a[451:895] + ["乙"] + a[895:]
    b[0], b[-1] = "丙", "丁"
    assert consensus.edits(tuple(a), tuple(b)) == 5
    monkeypatch.setattr(consensus, "CELLS", 50)
    for _ in range(40):
        x, y = (tuple(r.choice("甲乙丙") for _ in range(r.randrange(1, 40))) for _ in "ab")
        cost = list(range(len(y) + 1))
        for i, t in enumerate(x, 1):
            last, cost = cost, [i]
            for j, u in enumerate(y, 1):
                cost.append(min(last[j - 1] + (t != u), last[j] + 1, cost[j - 1] + 1))
        assert consensus._align.__wrapped__ and sum(i < 0 or j < 0 or x[i] != y[j] for i, j in consensus._align.__wrapped__(x, y)) == cost[-1]


def test_mixed_weights_prefer_what_is_full_trusted_and_recent(spark):
    rows = [(1, "1", "2024-01-01 00:00:00", "房屋空置，钥匙已移交法院", "1", 1.0), (2, "1", "2024-01-02 00:00:00", "房屋空置，钥匙已移交法院", "1", 1.0), (3, "1", "2024-01-03 00:00:00", "空置", "1", 0.5), (4, "2", "2024-01-01 00:00:00", "由承租人使用", "1", 0.0), (5, "2", "2024-01-02 00:00:00", "已腾空并移交", "1", None), (6, "2", "2024-01-03 00:00:00", "由产权人使用", "1", 1.0)]
    df = spark.createDataFrame(rows, "row_id bigint, `标的物ID` string, at string, a string, b string, sure double")
    get = lambda weights: {r.item: r.value for r in consensus.representatives(df, id_number(F.col("标的物ID")), {"a": usable_text(F.col("a"))}, time_seconds(F.col("at")), weights=weights, trust=F.col("sure")).collect()}
    assert get("mixed") == {1: "房屋空置，钥匙已移交法院", 2: "由产权人使用"} and get("recency") == {1: "空置", 2: "由产权人使用"}


def test_the_latest_value_needs_no_alignment(spark):
    """Votes that could change no row aren't counted; the mixed weights' votes are."""
    rows = [(k, str(k % 3), f"2024-01-{k % 5 + 1:02} 00:00:00", ["空置", "由承租人使用", None, "已腾空", "空置"][k % 7 % 5], "1") for k in range(60)]
    df = spark.createDataFrame(rows, "row_id bigint, `标的物ID` string, at string, a string, b string")
    plan = lambda weights: best(df, weights)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan("recency") and "ArrowEvalPython" not in plan("recency") and "InPandas" in plan("mixed")
    got = {(r.item, r.field_name): r.row_id for r in best(df).collect()}
    usable = lambda g, f: [(r[2], -r[0]) for r in rows if int(r[1]) == g and r[3 + (f == "b")]]
    assert got == {(g, f): -max(usable(g, f))[1] for g in range(3) for f in "ab"}


def test_hot_group_is_folded_in_chunks(spark):
    r = random.Random(1)
    rows = [(k, "1", f"2024-01-{k // 1440 % 28 + 1:02} {k // 60 % 24:02}:{k % 60:02}:00", f"第{r.randrange(10**6)}号说法", "1") for k in range(900)]
    df = spark.createDataFrame(rows, "row_id bigint, `标的物ID` string, at string, a string, b string")
    got = {r.field_name: (r.value, r.row_id) for r in best(df).collect()}
    assert got == {"a": (rows[-1][3], 899), "b": ("1", 899)}


def test_count_weights(spark):
    rows = [(k, "1", "2024-01-01 00:00:00", v, "1") for k, v in enumerate(["由承租人使用"] * 3 + ["由承租人经营"] * 2)]
    df = spark.createDataFrame(rows, "row_id bigint, `标的物ID` string, at string, a string, b string")
    assert {r.field_name: r.value for r in best(df, "count").collect()}["a"] == "由承租人使用"


# 10 -- glyphs
def test_forms_equal_the_plain_version(spark):
    r = random.Random(2)
    alphabet = "aeA不，,。１ éЕеѐο​­　 \n²①‰ﬁ⽉́̂̀行不가각"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 30))) for _ in range(300)] + [None, "", "长文é" * 50_000]
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in enumerate(texts)], "doc_id bigint, text string, canonical string, at int")
    got = {x._id: x.canonical for x in glyphs.same_form(df).collect()}
    for k, t in enumerate(texts):
        a, b = got[k], glyphs.canonical_text(t, glyphs.decompositions(spark))
        assert (a is None) == (b is None) and (a is None or unicodedata.normalize("NFD", a) == unicodedata.normalize("NFD", b)), (t, a, b)
    assert glyphs.same_form(df.limit(0)).count() == 0


def test_look_alikes(spark):
    rows = [(1, "Résidence 价格１００元"), (2, "Résidenсe 价格100元"), (3, "Résidence 价格１００元"), (4, "Residence 价格100元"), (5, None), (6, "résidence 价格100元"), (7, "Rési​dence 价格100元")]
    got = sorted(tuple(r) for r in glyphs.look_alikes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(1, 2), (1, 7), (2, 3), (2, 7), (3, 7)]


def test_marks_and_letters_of_all_scripts(spark):
    pairs = [("\u0915\u093c\u0902", "\u0958\u0902"), ("\u0e01\u0e38\u0e48", "\u0e01\u0e48\u0e38"), ("\U0001d400bc", "Abc"), ("\u0251\u0261e", "age"), ("\uac01", "\u1100\u1161\u11a8"), ("\u0627\u0653", "\u0622"), ("\u05e9\u05bc\u05c1", "\ufb2c")]
    rows = [(2 * k + i, t) for k, p in enumerate(pairs) for i, t in enumerate(p)] + [(90, "10"), (91, "lO"), (92, "x²"), (93, "x2")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in glyphs.look_alikes(df).collect()) == [(2 * k, 2 * k + 1) for k in range(len(pairs))]
    assert {(r.id, r.class_id, r.texts, r.rows) for r in glyphs.form_classes(df.unionByName(df.where("doc_id = 1").selectExpr("cast(80 as bigint) as doc_id", "text"))).collect()} >= {(0, 0, 2, 3), (80, 0, 2, 3), (3, 2, 2, 2)}


def test_copies_of_one_text_do_not_meet(spark):
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("价格１００元").alias("text")).unionByName(spark.createDataFrame([(99_999, "价格100元")], "doc_id bigint, text string"))
    assert glyphs.look_alikes(rows).count() == 60_000


# 8 -- leaks
def test_leaks_find_planted_passages(spark):
    r = random.Random(3)
    words = [chr(x) for x in range(0x4E00, 0x5200)]
    items = [(k, "".join(r.choice(words) for _ in range(160))) for k in range(30)] + [(90, None), (91, "短"), (92, "")]
    filler = lambda n: "".join(r.choice(words) for _ in range(n))

    def slip(s):
        s = list(s)
        for p in range(9, len(s), 31):
            s[p] = r.choice(["", "错", s[p] * 2])
        return "".join(s)

    docs, want = [(1000, None), (1001, ""), (1002, filler(300)), (1003, filler(1_200_000))], set()
    for k in range(30):
        t = items[k][1]
        docs += [(k, filler(50) + t + filler(50)), (100 + k, filler(30) + slip(t[40:130]).replace("的", " 的\n") + filler(30)), (200 + k, t[:50] + filler(80) + t[100:150]), (300 + k, filler(30) + t[:60] + filler(30)), (400 + k, t[:30] + filler(20) + t[50:75] + filler(25) + t[110:135])]
        want |= {(k, k), (100 + k, k), (200 + k, k)}
    d = spark.createDataFrame([(*x, "c") for x in docs], "doc_id bigint, text string, item_id string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    assert {(x.doc_id, x.item_id) for x in leakage.leaks(d, i).collect()} == want
    assert {(x.doc_id, x.item_id) for x in leakage.leaks(d, i, block_chars=1500).collect()} == want
    assert leakage.leaks(d.limit(0), i).count() == 0 and leakage.leaks(d, i.limit(0)).count() == 0


def test_leaks_see_through_form_and_case(spark):
    t = "Within 55 hours of the flood, two cousins holding shares in trust bricked up the weathercock on shed 21."
    d = spark.createDataFrame([(1, "x" + t.upper().replace("A", "А").replace(" ", "　\n"))], "doc_id bigint, text string")
    assert leakage.leaks(d, spark.createDataFrame([(5, t)], "item_id bigint, text string")).count() == 1


# 9 -- mixing
def mixed(spark, monkeypatch, rows, targets, **more):
    monkeypatch.setattr(mixing, "token_counts", lambda df, i, t, keep, tok: df.select(F.col(i).alias("doc_id"), *keep, F.length(t).cast("bigint").alias("tokens")).where("tokens is not null"))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    goal = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    m, r = mixing.mix(docs, goal, **more)
    return m.collect(), {x.source: x for x in r.collect()}


def test_mix_reaches_its_shares(spark, monkeypatch):
    r = random.Random(4)
    rows = [(k, "x" * r.randrange(1, 40), "big" if k % 10 else "small") for k in range(4000)] + [(9001, None, "big"), (9002, "y", None), (9003, "y", "other")]
    m, report = mixed(spark, monkeypatch, rows, [("big", 0.6, 2), ("small", 0.4, 3)], block_tokens=100)
    total = sum(x.tokens for x in m)
    for s, share, most in (("big", 0.6, 2), ("small", 0.4, 3)):
        own = [x for x in m if x.source == s]
        assert abs(sum(x.tokens for x in own) / total - share) < 0.01 and abs(report[s].actual_share - share) < 0.01
        uses = {}
        for x in own:
            uses[x.doc_id] = uses.get(x.doc_id, 0) + 1
        assert max(uses.values()) <= most
    assert report["small"].repeats_used == 3 and not {x.doc_id for x in m} & {9001, 9002, 9003}
    early = [x for x in m if x.slot_no < 20]
    assert abs(sum(x.tokens for x in early if x.source == "big") / sum(x.tokens for x in early) - 0.6) < 0.15


def test_mix_of_nothing(spark, monkeypatch):
    m, report = mixed(spark, monkeypatch, [(1, "x", "big")], [("big", 0.5, 1), ("none", 0.5, 1)])
    assert m == [] and report["none"].actual_share == 0
    m, report = mixed(spark, monkeypatch, [], [])
    assert m == [] and report == {}


@pytest.mark.parametrize("n_big,n_small", [(60, 40), (4000, 9)])
def test_mix_of_few_blocks(spark, monkeypatch, n_big, n_small):
    rows = [(k, "x" * (10 + k % 21), "big" if k < n_big else "small") for k in range(n_big + n_small)]
    m, report = mixed(spark, monkeypatch, rows, [("big", 0.8, 2), ("small", 0.2, 2)])
    have = {s: sum(len(t) for _, t, x in rows if x == s) for s in ("big", "small")}
    limit = min(have["big"] * 2 / 0.8, have["small"] * 2 / 0.2)
    assert abs(sum(x.tokens for x in m) - limit) < 0.1 * limit and abs(report["big"].actual_share - 0.8) < 0.03
    assert len({(x.doc_id, x.repeat_no) for x in m}) == len(m) and {x.repeat_no for x in m} <= {1, 2}


def test_mix_ends_where_a_source_has_no_block_left(spark, monkeypatch):
    rows = [(k, "x" * 10, "abc"[k % 3]) for k in range(3000)]
    shares = [("a", 0.49, 1), ("b", 0.02, 1), ("c", 0.49, 1)]
    m, report = mixed(spark, monkeypatch, [r for r in rows if r[2] != "b"] + [r for r in rows if r[2] == "b"][:41], shares, block_tokens=10)
    slots = {x.slot_no for x in m}
    assert slots == set(range(max(slots) + 1)) and all(abs(report[s].actual_share - p) < 0.01 for s, p, _ in shares)


def test_tokens_of_whole_texts(spark):
    df = spark.createDataFrame([(1, "标的物 abc\n"), (2, None), (3, "")], "doc_id bigint, text string")
    got = {r.doc_id: r.tokens for r in mixing.token_counts(df, "doc_id", "text", []).collect()}
    assert got[3] == 0 and got[1] > 3 and 2 not in got


# 6 -- addresses
@pytest.mark.parametrize("text,want", [
    ("岭海省 碧江市 绿洲区 南渡镇 迎康路119 号 第7栋701房", ("碧江", "绿洲", "迎康路", "119", "7", "", "701")), ("坐落：岭海碧江市绿洲区建康中路一百六十四号恒洲雅筑５-１６０３的不动产", ("碧江", "绿洲", "建康中路", "164", "5", "", "1603")),
    ("1座2单元三〇六房, 瑞原豪园, 朝乐路151号, 蓝湾区, 岚山市, 岭海省", ("岚山", "蓝湾", "朝乐路", "151", "1", "2", "306")), ("荷华公寓7座地下一层B-285车位（岭海省碧江市绿洲区广山北路71#）", ("碧江", "绿洲", "广山北路", "71", "7", "", "b285")),
    ("6号楼5层509房", ("", "", "", "", "6", "", "509")), ("珠溪市 南渡街 光湖路109 号 枫桥新城 2栋808", ("珠溪", "", "光湖路", "109", "2", "", "808")),
])
def test_addresses_are_taken_apart(text, want):
    p = parse(text, PLACES)
    assert tuple(p[k] for k in ("city", "district", "road", "number", "house", "unit", "room")) == want


def test_names_that_sound_alike():
    assert sound("恒洲") == sound("洲恒恒") and features("恒恒洲雅竺2-101", PLACES)["estate_key"] == features("洲恒雅筑2-101", PLACES)["estate_key"]
    assert "花园" in ending("甲乙花圆") and ending("甲乙公") == {"公寓", "公馆"} and not ending("甲乙")
    assert features(None, PLACES)["room"] == "" and features("未知", PLACES)["room"] == ""


ADDRESSES = [
    (1, "岭海省碧江市绿洲区迎康路119号松堤家园7栋701房"), (2, "碧江绿洲迎康路一百一十九号松松堤家园7-701"), (3, "松堤家圆第7栋七〇一单位（碧江市绿洲区）"), (4, "碧江市绿洲区迎康路119号7栋1单元701"), (5, "碧江市绿洲区迎康路121号松坡家园7栋701"), (6, "碧江市绿洲区迎康路119号松堤家园7栋702"),
    (7, "岚山市蓝湾区育凌中路5号松堤家园7栋701房"), (8, None), (9, ""), (10, "岭海省碧江市"), (11, "岭海省碧江市绿洲区迎康路119号松堤家园7栋701房"), (12, "甲" * 100_000), (13, "碧江市绿洲区松堤家园7栋2单元701"),
]


def test_linked_addresses(spark):
    df = spark.createDataFrame([(*r, "x", "y") for r in ADDRESSES], "row_id bigint, a string, city string, rec string")
    rows = linkage.parsed(df, "row_id", F.col("a"), PLACES)
    got = {(r.row_id_a, r.row_id_b) for r in linkage.linked(rows).collect()}
    assert {(1, 2), (1, 3), (1, 4), (1, 11), (2, 3), (2, 11), (3, 11), (4, 11)} <= got
    assert not any(x in (5, 6, 7, 8, 9, 10, 12) for p in got for x in p) and (4, 13) not in got
    assert linkage.linked(rows.limit(0)).count() == 0


def shuffled_last(df):
    """What the plan does behind its last shuffle."""
    return df._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]


def test_many_copies_are_paired_behind_the_last_shuffle(spark, monkeypatch):
    monkeypatch.setattr(linkage, "LIST", 7, raising=False)
    rows = [(k, "岭海省碧江市绿洲区迎康路119号松堤家园7栋701房") for k in range(40)] + [(100 + k, "碧江绿洲迎康路一百一十九号松松堤家园7-701") for k in range(25)] + [(3, "岭海省碧江市绿洲区迎康路119号松堤家园7栋701房"), (4, "碧江绿洲迎康路一百一十九号松松堤家园7-701")]
    want = lambda ids: sorted((a, b) for a in ids for b in ids if a < b)
    for some in (rows[:-2], rows[:-1]):  # once with an id that comes twice
        out = linkage.linked(linkage.parsed(spark.createDataFrame(some, "row_id bigint, a string"), "row_id", F.col("a"), PLACES))
        assert shuffled_last(out).count("Generate explode") == 2
        assert sorted((r.row_id_a, r.row_id_b) for r in out.collect()) == want([k for k, _ in rows[:65]])
    # an id with two addresses of the unit
    out = linkage.linked(linkage.parsed(spark.createDataFrame(rows, "row_id bigint, a string"), "row_id", F.col("a"), PLACES)).where("row_id_a <> row_id_b")
    assert sorted((r.row_id_a, r.row_id_b) for r in out.collect()) == want([k for k, _ in rows[:65]])


def test_left_out_houses_and_swapped_long_names_meet(spark):
    rows = [(1, "碧江市绿洲区迎康路119号松堤家园7栋701房"), (2, "碧江市绿洲区迎康路119号701房"), (3, "绿洲区松堤家园 701室"), (4, "碧江市绿洲区盈口路5号桂岛小区1栋302房"), (5, "碧江市绿洲区盈口路5号桂岛小区2栋302房"), (6, "碧江市绿洲区盈口路5号302房")]
    rows += [(7, "碧江市绿洲区建国门大街9号3栋801房"), (8, "碧江市绿洲区建门国大街9号3栋801房"), (9, "碧江市绿洲区建国门大街9号4栋801房")]
    parts = linkage.parsed(spark.createDataFrame(rows, "row_id bigint, a string"), "row_id", F.col("a"), PLACES)
    got = {(r.row_id_a, r.row_id_b) for r in linkage.linked(parts).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (7, 8)}


def test_all_provinces_are_known(spark):
    courts = spark.createDataFrame([("岭海省碧江市绿洲区人民法院",)], "c string")
    names = [(chr(0x4E00 + k // 40) + chr(0x5000 + k % 40) + "省",) for k in range(1500)]
    got = linkage.learn_places([courts], spark.createDataFrame(names, "c string"))
    assert got == Places.of([("碧江市", "绿洲区")], sorted(n for (n,) in names))
    with pytest.raises(ValueError):
        linkage.learn_places([courts], spark.range(linkage.MAX_PLACES + 1).selectExpr("concat(id, '省') as c"))


def test_lines_return_behind_many_with_an_equal_third():
    body = ["甲乙丙" + c * 6 for c in "子丑寅卯辰巳"]
    assert scans.returning([*body, "甲乙丙丁戊己庚辛壬", "甲乙丙丁戊己庚申酉"]) == [False] * 6 + [True] * 2
    long = "".join(chr(0x4E00 + k) for k in range(90))
    assert scans.returning([long, "另一行不同的字", long[:-1] + "末"]) == [True, False, True]
    r = random.Random(3)
    keys = ["".join(r.choice("甲乙") for _ in range(r.choice((0, 3, 6, 8, 70)))) for _ in range(60)]
    near = lambda a, b: a == b != "" or len(a) == len(b) >= 6 and sum(x != y for x, y in zip(a, b)) <= 2
    assert scans.returning(keys) == [any(i != j and near(a, b) for j, b in enumerate(keys)) for i, a in enumerate(keys)]


def test_expectation_maximization_parts_the_patterns():
    known = [((0, 0, 0, 0, 1), 300), ((0, 1, 0, 1, 1), 300)]
    w = linkage.estimate([((0, 0, 0, 0, 1), 500), ((0, 1, 0, 0, 1), 200), ((0, 2, 2, 2, 1), 400), ((0, 0, 2, 3, 1), 100)], known)
    assert w[(0, 0, 0, 0, 1)] > 0.9 and w[(0, 1, 0, 0, 1)] > 0.9 and w[(0, 2, 2, 2, 1)] < 0.1 and w[(0, 0, 2, 3, 1)] < 0.1
    # few chance meetings are told apart as well, and a part left out says nothing
    w = linkage.estimate([((0, 0, 0, 0, 1), 500), ((1, 1, 0, 1, 1), 1), ((0, 1, 2, 2, 1), 2), ((0, 1, 2, 3, 1), 2)], known)
    assert w[(1, 1, 0, 1, 1)] > 0.9 and w[(0, 1, 2, 2, 1)] < 0.1 and w[(0, 1, 2, 3, 1)] < 0.1
    assert linkage.estimate([]) == {}


def test_posterior_decides(spark):
    """With the weights taken out, addresses that only sound alike are linked as well."""
    rows = [(k, f"碧江市绿洲区迎康路{k // 2 + 1}号松堤家园{k // 2 + 1}栋701") for k in range(60)] + [(900, "碧江市绿洲区迎康路500号松堤家园9栋808"), (901, "碧江市蓝湾区盈口路500号申同公寓9栋808")]
    df = spark.createDataFrame(rows, "row_id bigint, a string")
    parts = linkage.parsed(df, "row_id", F.col("a"), Places.of([("碧江市", "绿洲区"), ("碧江市", "蓝湾区")], []))
    pairs = lambda least: {(r.row_id_a, r.row_id_b) for r in linkage.linked(parts, least).collect()}
    want = {(k, k + 1) for k in range(0, 60, 2)}
    assert pairs(0.5) == want and pairs(-1.0) == want | {(900, 901)}


@pytest.mark.parametrize("text,want", [
    ("万科城市之光12栋10203房", ("万科城市之光", "12", "", "10203")), ("人民路5弄3号601室", ("", "3", "", "601")), ("碧江市绿洲区松堤家园3栋1单元12号", ("松堤家园", "3", "1", "12")), ("松堤家园A座1201", ("松堤家园", "a", "", "1201")), ("海棠公寓128号车位", ("海棠公寓", "", "", "#128")), ("中山道15号兰亭里8号楼1门302", ("兰亭里", "8", "1", "302")), ("松堤家园7号楼七〇一（绿洲区）", ("松堤家园", "7", "", "701")),
])
def test_other_forms_of_rooms(text, want):
    p = parse(text, PLACES)
    assert tuple(p[k] for k in ("estate", "house", "unit", "room")) == want


def test_whole_names_are_compared():
    assert features("万科城市之光12栋1203", PLACES)["estate_key"] != features("万科金域蓝湾12栋1203", PLACES)["estate_key"]


def test_learned_places(spark):
    df = spark.createDataFrame([("碧江市绿洲区人民法院",), (None,), ("某公司",)], "c string")
    p = linkage.learn_places([df], spark.createDataFrame([("岭海",), ("",)], "c string"))
    assert p.districts == {"绿洲": "碧江"} and p.provinces == {"岭海"}


# 3 -- entities
def side(spark, rows):
    df = spark.createDataFrame(rows, "row_id bigint, a string, area double, price double")
    parts = linkage.parsed(df, "row_id", F.coalesce("a", F.lit("")), PLACES)
    return parts.join(df.select("row_id", "area", "price"), "row_id")


def test_entities_match(spark):
    left = [(1, "岭海省碧江市绿洲区迎康路119号松堤家园7栋701房", 94.33, 875400.0), (2, "碧江市绿洲区松堤家园", 61.5, 500000.0), (3, "岚山市蓝湾区育凌中路5号桂岛小区1幢3407号", 75.82, 921100.0), (4, None, 94.33, 875400.0), (5, "岭海省碧江市绿洲区迎康路119号松堤家园7栋701房", 94.33, 875400.0)]
    right = [(11, "绿洲区迎康路119号7栋701室的住宅", None, 875400.0), (12, "碧江绿洲区松堤家园3栋902房住宅一套", 61.5, 510000.0), (13, "蓝湾区育凌中路5号1幢3408", 75.82, 921100.0), (14, "松堤家园7号楼七〇一（绿洲区迎康路119号）不动产", 94.0, 880000.0), (15, "", None, None)]
    got = {(r.left_id, r.right_id): r.confidence for r in entities.match(side(spark, left), side(spark, right)).collect()}
    assert set(got) == {(1, 11), (1, 14), (5, 11), (5, 14), (2, 12)} and all(0 < c <= 1 for c in got.values())
    none = side(spark, left).limit(0)
    assert entities.match(none, none).count() == 0


def test_vectors_decide_which_records_meet(spark):
    """A road and the estate on it are near because other records name both; with untrained vectors their records don't meet."""
    roads, names = [chr(0x5000 + 7 * k) + chr(0x5800 + 11 * k) + "路" for k in range(40)], [chr(0x6000 + 13 * k) + chr(0x6800 + 17 * k) + "花园" for k in range(40)]
    both = [(k, f"碧江市{roads[k % 40]}{k % 40 + 1}号{names[k % 40]}1栋{100 + k}", 50.0 + k, None) for k in range(400)]
    left = both + [(1000 + k, f"碧江市{roads[k]}{k + 1}号9栋901", 80.0 + k, 1e6 + k) for k in range(40)]
    right = [(2000 + k, f"碧江市{names[k]}9栋901", 80.0 + k, 1e6 + k) for k in range(40)]
    a, b = side(spark, left), side(spark, right)
    pairs = lambda epochs: {(r.left_id, r.right_id) for r in entities.match(a, b, epochs).collect()}
    want = {(1000 + k, 2000 + k) for k in range(40)}
    got, chance = pairs(entities.EPOCHS), pairs(0)
    assert got <= want and len(got) >= 0.9 * len(want) and len(chance) < 0.7 * len(want)


def test_near_records_equal_all_pairs(monkeypatch):
    """Records meet by code and room or figure in any table as in a plain search, in steps of any size."""
    rng = np.random.default_rng(5)
    node, side, room = rng.integers(0, 25, 200), rng.integers(0, 2, 200), rng.integers(0, 6, 200)
    figures = [rng.integers(0, 40, k % 4) for k in range(200)]
    vectors = rng.standard_normal((25, 4)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    codes = rng.integers(0, 4, (25, 3))
    shares = lambda i, j: room[i] == room[j] if room[i] and room[j] else bool(set(figures[i]) & set(figures[j]))
    near = lambda i, j: node[i] == node[j] or (codes[node[i]] == codes[node[j]]).any() and vectors[node[i]] @ vectors[node[j]] >= np.cos(np.radians(entities.WIDEST))
    want = {(i, j) for i in range(200) for j in range(200) if side[i] == 0 and side[j] == 1 and shares(i, j) and near(i, j)}
    for step in (entities.STEP, 3):
        monkeypatch.setattr(entities, "STEP", step)
        monkeypatch.setattr(entities.together, "__defaults__", (step,))
        a, b, cosine = entities.near_records(node, side, room, figures, vectors, codes)
        assert len(want) > 50 and set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want) and (cosine[node[a] == node[b]] == 1).all()


def test_codes_stay_in_their_task_and_pairs_of_rows_are_not_shuffled(spark):
    left = [(k, "碧江市绿洲区迎康路119号松堤家园7栋701房", 94.33, 875400.0) for k in range(120)]
    right = [(1000 + k, "碧江绿洲迎康路119号7栋701", 94.33, 875400.0) for k in range(90)]
    out = entities.match(side(spark, left), side(spark, right))
    assert shuffled_last(out).count("Generate explode") == 2
    assert {(r.left_id, r.right_id) for r in out.collect()} == {(a, 1000 + b) for a in range(120) for b in range(90)} and out.count() == 120 * 90


def test_skip_gram_brings_neighbours_together():
    road = np.arange(0, 80, 2)
    a, b, n = np.concatenate([road, road, road + 1]), np.concatenate([road + 1, road, road + 1]), np.full(120, 5)
    v = entities.skip_gram([f"{'RE'[k % 2]}|{k // 2}" for k in range(80)], a, b, n)
    nearest = (v[road] @ v[road + 1].T).argmax(axis=1)
    assert np.isfinite(v).all() and (nearest == np.arange(40)).mean() > 0.95
    assert entities.skip_gram([], a[:0], b[:0], n[:0]).shape == (0, entities.DIM)
    assert entities.isotonic([(1, 0, 10), (2, 5, 10), (3, 4, 10), (4, 10, 10)])[2] == entities.isotonic([(1, 0, 10), (2, 5, 10), (3, 4, 10), (4, 10, 10)])[3]


def test_codes_grow_with_the_places():
    assert entities.code_size(0)[0] == 1 and entities.code_size(10**6)[0] > entities.code_size(10**3)[0]
    for places in (10, 10**4, 10**6):
        bits, tables = entities.code_size(places)
        assert 1 - (1 - (1 - entities.ANGLE / 180) ** bits) ** tables >= entities.RECALL


# 7 -- scans
BODY = "估价对象位于某路某号，登记用途为住宅，经现场查勘维护状况良好，周边有农贸市场和学校，交通便利，生活配套较为完善。"


def scan(n, seed, wrong=0.0):
    r = random.Random(seed)
    lines, kinds = [], []
    head = f"某某估价报告 20{seed % 90 + 10}-{seed % 9000 + 1000}"
    text = "".join(BODY.replace("某路", f"第{r.randrange(90)}路") for _ in range(3))
    k = page = 0
    while k < len(text):
        page += 1
        lines.append(head), kinds.append({"header"})
        for _ in range(4):
            part, own = list(text[k : k + 30]), set()
            for i, c in enumerate(part):
                if c == "场" and r.random() < wrong:
                    part[i], own = "圮", {"misread"}
            if part:
                lines.append("".join(part)), kinds.append(own)
            k += 30
        lines.append(f"- {page} -"), kinds.append({"page_no"})
    return "\n".join(lines), kinds


def test_lines_are_labelled(spark):
    texts = [scan(0, s, 0.05) for s in range(300)]
    rows = [(k, "f", t) for k, (t, _) in enumerate(texts)] + [(900, "f", None), (901, "f", ""), (902, "f", "一行"), (903, "f", "查勘情况综合确定 neighb-\n- 1 -\nourhood committee 的说明。\n以上。")]
    df = spark.createDataFrame(rows, scans.SCHEMA)
    lines = scans.labelled(df).cache()
    wrong = scans.misread(lines)
    got = {}
    for r in scans.noise(lines, wrong).collect():
        got.setdefault((r.row_id, r.line_no), set()).add(r.noise_kind)
    want = {(k, i + 1): s for k, (_, kinds) in enumerate(texts) for i, s in enumerate(kinds) if s}
    hits = sum(got.get(k) == s for k, s in want.items())
    assert hits >= 0.97 * len(want) and sum(k not in want for k in got if k[0] < 900) <= 0.02 * len(want)
    assert got[(903, 1)] == {"hyphen"} and got[(903, 2)] == {"page_no"} and (902, 1) not in got
    put = {(r.row_id, r.para_no): r.paragraph for r in scans.paragraphs(lines, wrong).collect()}
    assert "neighbourhood committee" in put[(903, 1)] and put[(902, 1)] == "一行" and "圮" not in "".join(put.values())
    empty = scans.labelled(df.limit(0))
    assert empty.count() == 0 and scans.misread(empty).count() == 0


def test_texts_ignore_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "row_id bigint, text string, field_name string, c string")
    assert [tuple(r) for r in scans.texts(df, ["text"]).collect()] == [(1, "text", "a")]


def test_very_long_scan():
    r = random.Random(6)
    lines = ["".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(28)) + "，" for _ in range(20_000)]
    assert set(scans.decode(scans.symbols(lines, set()), tuple(x.tolist() for x in scans.first_guess()))) == {scans.BODY}


def test_states_of_many_sequences_equal_plain_search(monkeypatch):
    import itertools

    start, step, emit = scans.first_guess()
    r = random.Random(8)
    seqs = [[r.randrange(scans.SYMBOLS) for _ in range(r.choice((0, 1, 2, 3, 5)))] for _ in range(60)]
    score = lambda seq, path: start[path[0]] + emit[path[0]][seq[0]] + sum(step[a][b] + emit[b][o] for a, b, o in zip(path, path[1:], seq[1:]))
    for cells in (scans.DECODED, 7):
        monkeypatch.setattr(scans, "DECODED", cells)
        for seq, got in zip(seqs, scans.decode_all(seqs, (start, step, emit))):
            best = max((score(seq, p) for p in itertools.product(range(4), repeat=len(seq))), default=0) if seq else 0
            assert len(got) == len(seq) and (not seq or abs(score(seq, got.tolist()) - best) < 1e-9)


def test_characters_that_came_apart(spark):
    """A character read as two is found by its contexts; two that belong together anyway are left alone."""
    r = random.Random(9)
    rows = []
    for k in range(400):
        t = "".join(r.choice(["委托银行监管账户余额，", "商场附近葡萄园林开放，", "经现场查勘室内装修，"]) for _ in range(6))
        rows.append((k, "f", t.replace("银行监", "银彳亍监") if k % 12 == 0 else t))
    df = spark.createDataFrame(rows, scans.SCHEMA)
    lines = scans.labelled(df).cache()
    assert {("彳", "亍"), ("葡", "萄")} <= {(chr(k >> 21), chr(k & 0x1FFFFF)) for k in scans.signs_of(lines).keys.tolist()}
    wrong = scans.misread(lines)
    got = {(x.row_id, x.place, chr(x.right), x.size) for x in wrong.collect()}
    assert got == {(k, i, "行", 2) for k, _, t in rows for i in range(len(t)) if t.startswith("彳亍", i)} and got
    put = {x.row_id: x.paragraph for x in scans.paragraphs(lines, wrong).collect()}
    assert "银行监管" in "".join(put[k] for k in put if k % 12 == 0) and "彳" not in "".join(put.values()) and "亍" not in "".join(put.values())


def test_parsed_schema_matches():
    assert list(features("x", PLACES)) == [c.split()[0] for c in PARSED.split(", ")]
