"""Golden vectors and properties of the text functions."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from folioforge.functions import naming, notices as N, text as T


def one(spark, column, **values):
    row = spark.range(1)
    for k, v in values.items():
        row = row.withColumn(k, v if not isinstance(v, str) else F.lit(v))
    return row.select(column.alias("x")).first()["x"]


def plain_truncate(text, limit):
    """The rule of truncation in plain Python."""
    if len(text) <= limit:
        return text
    start = limit - 500 if limit >= 500 else max(0, len(text) + limit - 500)
    for s in T.SEPARATORS:
        at = text.rfind(s, start, limit)
        if start < limit and at >= 0:
            return text[: at + len(s)]
    return text[:limit]


TRUNCATIONS = [
    ("abc", 5, 3), ("a" * 300 + "\n" + "b" * 200 + "。" + "c" * 200, 600, 301), ("a" * 700, 600, 600), ("a" * 550 + "。" + "b" * 100, 600, 551), ("a" * 599 + "。" + "b" * 9, 600, 600), ("a" * 600 + "。" + "b" * 9, 600, 600),
    ("a" * 50 + "\n" + "b" * 649, 600, 600), ("a" * 50 + "\n" + "b" * 949, 100, 100), ("a" * 50 + "\n" + "b" * 249, 100, 51), ("a" * 200 + "\n\n" + "b" * 300 + "\n" + "c" * 200, 600, 202), ("a" * 599 + "\n\n" + "b" * 9, 600, 600),
]


@pytest.mark.parametrize("text,limit,size", TRUNCATIONS)
def test_truncate_goldens(spark, text, limit, size):
    got = one(spark, T.smart_truncate(F.lit(text), limit))
    assert got == text[:size] == plain_truncate(text, limit)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab。；.!?\n", max_size=900), min_size=1, max_size=20), st.sampled_from([1, 40, 300, 499, 500, 501, 700]))
def test_truncate_properties(spark, texts, limit):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.smart_truncate("t", limit).alias("x")).withColumn("y", T.smart_truncate("x", limit)).collect()
    for r in rows:
        assert r["x"] == plain_truncate(r["t"], limit) and r["t"].startswith(r["x"]) and len(r["x"]) <= limit and r["y"] == r["x"]


def test_strip_is_pythons(spark):
    odd = ["　a　", "\x1c\x1fb\x85", "\xa0 c\t\n", "", " ", "d"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select("t", T.strip("t").alias("x")).collect()
    assert all(r["x"] == r["t"].strip() for r in rows)


@pytest.mark.parametrize("text,out", [("（一）物证审查", "物证审查"), ("(一)物证", "(一)物证"), ("（二十一） x", "x"), ("（1）x", "（1）x"), ("（百）x", "（百）x")])
def test_enumeration(spark, text, out):
    assert one(spark, T.strip_enumeration(F.lit(text))) == out


def test_titles(spark):
    text = "1. 关于适用刑法的解释（法释1号）\n2、关于适用刑法的解释（法释1号）\n短\n3. 该条文暂无相关的司法解释。\n说明文字没有序号但够长\n4) 半角括号不算序号\n１、全角数字也是序号的"
    titles = one(spark, T.parse_titles(F.lit(text)))
    assert titles == ["关于适用刑法的解释（法释1号）", "说明文字没有序号但够长", "4) 半角括号不算序号", "全角数字也是序号的"]
    assert one(spark, T.title_list(F.array(F.lit("甲"), F.lit("乙")))) == "司法解释目录：\n1. 甲\n2. 乙\n"
    assert one(spark, T.title_list(F.array().cast("array<string>"))) == "司法解释目录：\n该条文暂无相关的司法解释。\n"


LAYOUTS = [
    ("要点：甲\n\n定性:乙\n法律依据: 【A】第一条【B】第二条\n【C】第三条\n其他\n处理：丙", "要点：甲\n\n定性:乙\n\n法律依据：\n【A】第一条\n【B】第二条\n【C】第三条\n其他\n\n处理：丙\n"),
    ("法律依据：", "法律依据：\n"),
    ("法律依据：甲", "法律依据：\n甲\n"),
    ("正文\n法律依据:\n甲【B】乙\n要点:丙", "正文\n\n法律依据：\n甲\n【B】乙\n\n要点:丙\n"),
    ("无字段\n\n\n第二行", "无字段\n第二行\n"),
    (" 　\n", ""),
]


@pytest.mark.parametrize("text,out", LAYOUTS)
def test_layout(spark, text, out):
    assert one(spark, T.format_output(F.lit(text))) == out
    assert one(spark, T.format_output(F.lit(out))) == out


def test_brackets_and_names(spark):
    assert one(spark, T.split_by_brackets(F.lit("前言【甲】x 【乙】y"))) == ["【甲】x", "【乙】y"]
    assert one(spark, T.safe_name(F.lit('a/b:c*?"<>|\\d'))) == "abcd"
    assert one(spark, T.trim_brackets(F.lit(" [[总则]] "))) == "总则"


def test_markdown_table(spark):
    rows = F.array(F.array(F.lit("a"), F.lit(None).cast("string"), F.lit("x\ny")), F.array(F.lit("1"), F.lit("b\\nc"), F.lit("")))
    assert one(spark, T.markdown_table(rows)) == "| a |  | x\ny |\n|---|---|---|\n| 1 | b c |  |"
    assert one(spark, T.markdown_table(rows, join_lines=True)) == "| a |  | x y |\n|---|---|---|\n| 1 | b c |  |"


def test_template(spark):
    assert one(spark, T.fill(F.lit("{text}-{label}"), ("text", F.lit("T{label}")), ("label", F.lit("L")))) == "TL-L"
    assert one(spark, T.fill(F.lit("{a}"), ("a", F.lit(None).cast("string")))) == ""
    assert one(spark, T.fill_from_map(F.lit("{a}{b}{c}"), F.create_map(F.lit("a"), F.lit("{b}"), F.lit("b"), F.lit("2")))) == "22{c}"


def test_paths(spark):
    assert [one(spark, f(F.lit("d/x.tar.gz"))) for f in (T.base_name, T.file_stem, T.extension)] == ["x.tar.gz", "x.tar", ".gz"]
    assert one(spark, T.file_stem(F.lit(".hidden"))) == ".hidden"


TASK = "task_id string, type string, num string, title string, evidence string, yaodian_name string, sub_name string, point string, meta map<string,string>, ord long"


def test_output_names(spark):
    rows = [("t1", "interp", "12", "a/b:c", None, None, None, None, {"num": "12", "title": "a/b:c"}, 0), ("t2", "evidence_sub", None, None, "物证", "来源", "保管", None, {}, 1), ("t3", "evidence", None, None, "物证", "来源", None, None, {}, 2), ("t4", "json_dict", None, None, "物证", None, None, "点", {}, 3), ("t/5", "custom", None, None, None, None, None, None, {}, 4)]
    tasks = spark.createDataFrame(rows, TASK)
    plain = {r["task_id"]: (r["file"], r["title_line"]) for r in naming.output_names(tasks, suffix="司法解释").collect()}
    assert plain["t1"] == ("第12条【abc】司法解释.md", "第12条【abc】司法解释：")
    assert plain["t2"] == ("证据分析【物证】来源（保管）.md", "证据分析【物证】来源（保管）：")
    assert plain["t3"][0] == "证据分析【物证】来源.md" and plain["t4"][0] == "证据分析【物证】非法证据排除（点）.md" and plain["t/5"][0] == "t5.md"
    filled = naming.output_names(tasks.limit(1), "{num}_{title}").first()
    assert (filled["file"], filled["title_line"]) == ("12_abc.md", "12_abc")
    assert naming.output_names(tasks.limit(1), "{num}_{title}", "规则").first()["title_line"] == "规则："
    same = naming.unique_names(spark.createDataFrame([("a.md", 0), ("a.md", 1), ("b.md", 2), ("a.md", 3)], "file string, ord long"))
    assert [r["file"] for r in same.orderBy("ord").collect()] == ["a.md", "a_1.md", "b.md", "a_2.md"]


def test_notices(spark):
    colours = [one(spark, N.completion_colour(F.lit(f), F.lit(100))) for f in (0, 9, 10)]
    assert colours == ["green", "orange", "red"]
    assert one(spark, N.one_decimal(N.percent(F.lit(37), F.lit(80)))) == "46.2" and one(spark, N.bar(F.lit(37), F.lit(80))) == "█" * 9 + "░" * 11
    assert one(spark, N.percent(F.lit(3), F.lit(0))) == 0 and one(spark, N.bar(F.lit(0), F.lit(0))) == "░" * 20
    assert [one(spark, N.eta_text(F.lit(x).cast("double"))) for x in (None, 0.0, 2.5, 3.5)] == ["计算中...", "计算中...", "约2分钟", "约4分钟"]
    assert one(spark, N.classify(F.lit("请确认并取消"))) == "confirm" and one(spark, N.classify(F.lit("好的"))) == "custom" and one(spark, N.classify(F.lit("Please CANCEL"), chinese=False)) == "cancel"
    assert one(spark, N.message_text(F.lit('{"text":" 　好 "}'))) == "好"
    card = json.loads(one(spark, N.error_card(F.lit("n"), F.lit("i"), F.lit("e" * 300), F.lit(True), F.lit(1))))
    assert card["header"]["template"] == "red" and len(card["elements"]) == 3 and card["elements"][2]["content"].count("e") == 200
    streak = json.loads(one(spark, N.error_card(F.lit("n"), F.lit("i"), F.lit("e"), F.lit(False), F.lit(4))))
    assert streak["header"]["template"] == "orange" and "4次" in streak["elements"][3]["content"]
    step = json.loads(one(spark, N.progress_card(F.lit("n"), F.lit(37), F.lit(80), F.lit(30), F.lit(5), F.lit(2), F.lit(0.25), F.lit(None).cast("double"), F.lit(""))))
    assert "46.2%" in step["elements"][0]["content"] and "0.2分钟" in step["elements"][2]["content"] and step["elements"][3]["content"].endswith("-")
    assert [b["type"] for b in one(spark, N.buttons([("a", "confirm"), ("b", "cancel"), ("c", "retry")]))] == ["primary", "danger", "default"]
    assert json.loads(one(spark, N.start_card(F.lit("n"), F.lit(3), F.lit(""), F.current_timestamp())))["elements"][3]["content"].endswith("无")


def test_chunks(spark):
    text = "".join(f"第{i}句话。" + ("\n" if i % 7 == 0 else "") for i in range(400))
    for limit in (100, 600):
        got = one(spark, T.text_chunks(F.lit(text), limit))
        assert "".join(got) == text and max(map(len, got)) <= limit
    assert one(spark, T.text_chunks(F.lit(""), 600)) == []


def test_chunks_of_null(spark):
    got = spark.createDataFrame([(1, None), (2, ""), (3, "a")], "n int, t string").select("n", T.text_chunks("t", 600).alias("c")).collect()
    assert {r["n"]: r["c"] for r in got} == {1: None, 2: [], 3: ["a"]}
