"""Sources, joins, flow control, model map, run, streams and the catalogue."""

import json
import os

import pytest
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import commands, flow, model_map, pages as P, resume, rollup
from folioforge.plans import catalogue, run as R
from folioforge.sources import config as C, mailbox, pages as page_source, progress, sinks, tasks as S
from folioforge.streaming import commands as streams

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# -- configuration ------------------------------------------------------------
RAW = {"api": {"url": "http://x", "key": "k"}, "output": {"dir": ""}}


def test_config(monkeypatch, tmp_path):
    monkeypatch.delenv(C.KEY_VARIABLE, raising=False)
    cfg = C.parse(RAW)
    assert (cfg.api.max_retries, cfg.api.api_interval, cfg.run.chunk_size, cfg.run.max_workers, cfg.data_source, cfg.api.verify_tls) == (3, 2.0, 20_000, 5, "json", True)
    for bad in ({"api": RAW["api"]}, {"output": {}}, {**RAW, "api": {"key": "k"}}, {**RAW, "api": {"url": "u"}}, {**RAW, "input": {"data_source": "x"}}, {**RAW, "output": {"format": "pdf"}}, {**RAW, "input": {"page_ranges": {"g": [0, 2]}}}):
        with pytest.raises(ValueError):
            C.parse(bad)
    with pytest.raises(ValueError):
        C.parse(RAW, need_pdf=True)
    monkeypatch.setenv(C.KEY_VARIABLE, "from-env")
    assert C.parse({**RAW, "api": {"url": "u"}}).api.key == "from-env"
    assert C.from_base64(C.to_base64(RAW)) == {"api": {"url": "http://x"}, "output": {"dir": ""}}
    (tmp_path / "c.json").write_text(json.dumps({**RAW, "settings": {"retry_failed": True}, "notify": {"chat_id": "c"}}))
    loaded = C.load(str(tmp_path / "c.json"))
    assert loaded.run.retry_failed and loaded.run.chat_id == "c"


# -- task sources -------------------------------------------------------------
def test_toc(spark, tmp_path):
    path = tmp_path / "toc.json"
    path.write_text('[["1"," [总则] ",3],[2,"罪刑法定",7],["2之一","时效",9]]', encoding="utf-8")
    got = rows(S.read_tasks(spark, "toc", str(path)).orderBy("ord"), "task_id", "label", "num", "title", "start_page", "end_page", "next_num")
    assert got == [("1_总则", "第1条 [总则]", "1", "总则", 3, 7, "2"), ("2_罪刑法定", "第2条 [罪刑法定]", "2", "罪刑法定", 7, 9, "2之一"), ("2之一_时效", "第2之一条 [时效]", "2之一", "时效", 9, 14, None)]


def test_json_shapes(spark, tmp_path):
    def read(value, source="json"):
        path = tmp_path / "x.json"
        path.write_text(json.dumps(value, ensure_ascii=False, indent=1), encoding="utf-8")
        return S.read_tasks(spark, source, str(path)).orderBy("ord")

    assert rows(read(["甲", "乙"]), "task_id", "type", "label") == [("甲", "json_list", "甲"), ("乙", "json_list", "乙")]
    mixed = read([{"id": "a", "text": "t", "pages": [2, 4]}, {"evidence": "e", "point": "p"}, {"num": 7}, {"x": 1}, "s"])
    assert rows(mixed, "task_id", "type") == [("a", "json_dict"), ("e｜p", "json_dict"), ("7", "json_dict"), ("3", "json_dict"), ("s", "json_list")]
    assert mixed.first()["pages"] == [2, 4] and mixed.first()["meta"]["text"] == "t"
    nested = read({"yaodians": [{"evidence": "物证", "name": "来源", "sub_items": ["（一）保管", "移送"]}, {"evidence": "书证", "yaodian_name": "真实"}], "items": [{"name": "no"}]})
    assert rows(nested, "task_id", "label", "grp", "type", "sub_name") == [("物证|来源|（一）保管", "来源 -> （一）保管", "物证", "evidence_sub", "保管"), ("物证|来源|移送", "来源 -> 移送", "物证", "evidence_sub", "移送"), ("书证|真实", "真实", "书证", "evidence", None)]
    assert read({"yaodians": [], "items": [{"name": "hidden"}]}).count() == 0
    assert rows(S.colliding_ids(read(["a", "a", "b"])), "task_id", "n") == [("a", 2)]


# -- pages ---------------------------------------------------------------------
def test_range_text(spark):
    pages = spark.createDataFrame([("p", i, t) for i, t in enumerate(["one", "", None, "four", "five"], 1)], "pdf_id string, page_no int, text string")
    entries = spark.createDataFrame([("p", "a", 1, 4), ("p", "b", 4, 99), ("p", "c", 7, 9), ("q", "d", 1, 2)], "pdf_id string, k string, start_page int, end_page int")
    out = P.range_text(entries, pages, ["k"])
    assert {r["k"]: (r["n_pages"], r["text"]) for r in out.collect()} == {"a": (2, "one\nfour"), "b": (2, "four\nfive"), "c": (0, ""), "d": (0, "")}
    assert "BroadcastNestedLoopJoin" not in out._jdf.queryExecution().executedPlan().toString()
    tables = spark.createDataFrame([("p", 2, 0, [["a"]]), ("p", 2, 1, []), ("p", 1, 0, [["b"], ["c"]])], page_source.PAGE_TABLES)
    drawn = P.range_tables(entries.where("k = 'a'"), tables, ["k"]).first()["text"]
    assert drawn == "| b |\n|---|\n| c |\n\n| a |\n|---|"
    with pytest.raises(Exception, match="before page 1"):
        entries.withColumn("start_page", F.lit(0)).select(P.valid_pages()).collect()


def test_pdf_needs_a_parser(spark, tmp_path):
    if page_source.pdfplumber is None:
        with pytest.raises(RuntimeError, match="pdfplumber"):
            page_source.read_pages(spark, str(tmp_path / "x.pdf"))


# -- resume and progress --------------------------------------------------------
PROGRESS = "task_id string, status string, error string, elapsed double, updated timestamp"


def state(spark, **statuses):
    return spark.createDataFrame([(k, v, None, 1.0, None) for k, v in statuses.items()], PROGRESS)


@pytest.mark.parametrize("resuming,retry,expected", [(True, False, {"new", "failed"}), (True, True, {"failed"}), (False, False, {"new", "failed", "success", "skipped"}), (False, True, {"failed"})])
def test_resume_and_retry(spark, resuming, retry, expected):
    tasks = spark.createDataFrame([(x,) for x in ("new", "failed", "success", "skipped")], "task_id string")
    done = state(spark, failed="failed", success="success", skipped="skipped")
    assert {r["task_id"] for r in resume.pending(tasks, done, resuming, retry).collect()} == expected


def test_upsert_and_counts(spark):
    merged = resume.upsert(state(spark, a="success", b="failed"), state(spark, b="success", c="failed"))
    assert {r["task_id"]: r["status"] for r in merged.collect()} == {"a": "success", "b": "success", "c": "failed"}
    tasks = spark.createDataFrame([("a",), ("b",), ("n",)], "task_id string")
    assert tuple(resume.initial_counts(tasks, state(spark, a="success", b="failed")).first()) == (3, 1, 2)
    assert tuple(resume.initial_counts(tasks, state(spark, a="success"), resume=False).first()) == (3, 0, 3)


def test_progress_versions(spark, tmp_path):
    place = str(tmp_path / "progress")
    assert progress.load(spark, place).count() == 0
    for n in range(4):
        progress.save(state(spark, a=str(n)), place)
    assert progress.load(spark, place).first()["status"] == "3" and len(progress.versions(spark, place)) == 2
    os.makedirs(f"{place}/v99999999999999999999")  # not finished: does not count
    assert progress.load(spark, place).first()["status"] == "3"
    assert rows(progress.from_json(progress.to_json(state(spark, x="failed"), "n")), "task_id", "status") == [("x", "failed")]


def test_rollup(spark):
    done = spark.createDataFrame([("a", "success", 0), ("b", "failed", 2), ("c", "failed", 1), ("d", "skipped", 3)], "task_id string, status string, ord int")
    out = rollup.summary(done, 2.0).first()
    assert (out["total"], out["success"], out["failed"], out["skipped"], out["failed_ids"]) == (4, 1, 2, 1, ["c", "b"])
    eta = rollup.with_eta(spark.createDataFrame([(10, 4, 40.0), (10, 0, 0.0)], "total int, current int, elapsed_s double")).collect()
    assert [(r["avg_s"], r["eta_min"]) for r in eta] == [(10.0, 1.0), (None, None)]
    listed = spark.createDataFrame([(0, "a"), (1, ""), (2, "a"), (3, "b")], "ord int, grp string")
    assert [r["heading"] for r in rollup.dry_run(listed).orderBy("ord").collect()] == ["a", None, None, "b"]


# -- flow -----------------------------------------------------------------------
def test_rate_schedule(spark):
    calls = spark.createDataFrame([(0,), (1,), (2,), (10,)], "arrival long")
    assert rows(flow.rate_schedule(calls, 2).orderBy("arrival"), "start") == [(0,), (2,), (4,), (10,)]


def test_breaker_golden(spark):
    calls = [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (30, 1), (65, 1), (70, 0), (126, 0), (127, 1)]
    df = spark.createDataFrame([("c", t, bool(f)) for t, f in calls], "client string, t long, failed boolean")
    got = {r["t"]: r["outcome"] for r in flow.breaker(df, ["client"], ["t"], "t", "failed", 5, 60).collect()}
    assert got == {0: "failed", 1: "failed", 2: "failed", 3: "failed", 4: "failed", 30: "rejected", 65: "failed", 70: "rejected", 126: "success", 127: "failed"}


def test_throttle_golden(spark):
    steps = spark.createDataFrame([("k", n, n * 40, 25) for n in range(1, 26)], "k string, n long, sec long, total long")
    sent = [r["n"] for r in flow.throttle(steps, ["k"], "n", "sec", "total", 10, 300).where("emit").orderBy("n").collect()]
    assert sent == [1, 9, 10, 18, 20, 25]


def test_backoff(spark):
    got = spark.range(1).select(F.explode(flow.backoff(5.0, 3)).alias("b")).select("b.*").collect()
    assert [tuple(r) for r in got] == [(1, 5.0, 5.0), (2, 10.0, 15.0), (3, 20.0, 35.0)]


# -- model map --------------------------------------------------------------------
class Clock:
    now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds


class Flaky:
    def __init__(self, *answers):
        self.answers = list(answers)

    def complete(self, prompt, system):
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a


def client(*answers, **config):
    clock = Clock()
    return model_map.Client(Flaky(*answers), C.ApiConfig("u", "k", **config), 2.0, clock, clock.sleep), clock


def test_client_retries_and_spaces():
    seen = []
    c, clock = client(RuntimeError("x"), "ok", "ok2")
    c.on_retry = lambda *a: seen.append(a)
    assert c.call("p")["attempts"] == 2 and seen == [(1, "RuntimeError: x", 5.0)] and clock.now == 5.0
    assert c.call("p")["content"] == "ok2" and clock.now == 7.0
    assert c.stats() == {"total_calls": 2, "total_failures": 0, "consecutive_failures": 0, "breaker_open": False}


def test_client_breaker_and_timeout():
    c, clock = client(*[RuntimeError("x")] * 20, max_retries=1)
    assert [c.call("p")["error"] for _ in range(6)][-2:] == ["RuntimeError: x", "circuit breaker open"] and c.stats()["breaker_open"]
    clock.now += 61
    assert c.call("p")["error"] == "RuntimeError: x" and c.call("p")["error"] == "circuit breaker open"
    c.reset()
    assert c.call("p")["error"] == "RuntimeError: x"
    slow, _ = client(RuntimeError("x"), "never", retry_base_delay=400.0)
    assert slow.call("p")["error"].startswith("TaskTimeoutError")


def test_read_answer():
    assert model_map.read_answer({"choices": [{"message": {"content": " hi\n"}}]}) == "hi"
    with pytest.raises(model_map.RateLimitError):
        model_map.read_answer({"error": {"message": "Rate limit"}})
    for bad in ({"error": {"message": "no"}}, {"choices": []}, {}):
        with pytest.raises(RuntimeError):
            model_map.read_answer(bad)


# -- run ---------------------------------------------------------------------------
def config(tmp_path, task_list=(), source="list", data=None, **more):
    raw = {"api": {"url": "mock:", "key": "k"}, "input": {"data_source": source, "task_list": list(task_list), "pdf_path": "book", **more.pop("input", {})}, "output": {"dir": str(tmp_path / "out"), **more.pop("output", {})}, "settings": {"api_interval": 0, "retry_base_delay": 0, "max_retries": 1, "max_consecutive_failures": 1000, **more.pop("settings", {})}, "prompt": more.pop("prompt", {"template": "{text}|{label}"})}
    if data is not None:
        (tmp_path / "data.json").write_text(json.dumps(data, ensure_ascii=False), encoding="utf-8")
        raw["input"]["data_path"] = str(tmp_path / "data.json")
    return C.parse(raw)


@pytest.fixture
def book(spark):
    text = ["page one 甲甲甲甲甲甲甲甲甲甲甲甲", "1. 关于适用刑法的解释一\n2. 关于适用刑法的解释二", "short", "", "第五页的正文写在这里，超过二十个字才行，一二三四五。"]
    pages = spark.createDataFrame([("book", i, t) for i, t in enumerate(text, 1)], page_source.PAGES)
    tables = spark.createDataFrame([("book", 2, 0, [["h"], ["v"]])], page_source.PAGE_TABLES)
    return R.Inputs(pages, tables, "book")


class Answers(model_map.MockBackend):
    def complete(self, prompt, system):
        if "boom" in prompt:
            raise RuntimeError("boom")
        return prompt


def outputs(spark, tmp_path):
    return {r["task_id"]: (r["file"], r["body"]) for r in spark.read.parquet(str(tmp_path / "out/outputs.parquet")).collect()}


def test_run_custom_resume_and_retry(spark, tmp_path, book):
    tasks = [{"id": "a", "pages": [1, 2]}, {"id": "b/x", "pages": [3], "label": "boom"}, {"id": "c", "pages": []}, {"id": "d", "type": "odd", "label": "L"}]
    log = sinks.LogNotifier()
    out = R.run(spark, config(tmp_path, tasks), book, Answers(), log)
    assert (out["total"], out["success"], out["failed"], out["failed_ids"]) == (4, 3, 1, ["b/x"]) and len(log.cards) == 2
    got = outputs(spark, tmp_path)
    assert got["a"] == ("a.md", "page one 甲甲甲甲甲甲甲甲甲甲甲甲\n1. 关于适用刑法的解释一\n2. 关于适用刑法的解释二|a") and got["c"] == ("c.md", "|c") and got["d"][1] == "{text}|L"
    assert (tmp_path / "out/a.md").read_text(encoding="utf-8") == got["a"][1]
    again = R.run(spark, config(tmp_path, tasks), book, model_map.MockBackend())
    assert (again["total"], again["success"], again["resumed"]) == (1, 1, 3)
    assert R.run(spark, config(tmp_path, tasks), book, Answers())["total"] == 0


def test_names_and_outputs_over_resumed_runs(spark, tmp_path, book):
    """A task that is done later takes no other task's file; the product has one row a task."""
    tasks = [{"id": "a/b", "pages": [1]}, {"id": "ab", "pages": [3], "label": "boom"}, {"id": "ab_1", "pages": [1]}]
    R.run(spark, config(tmp_path, tasks), book, Answers())
    R.run(spark, config(tmp_path, tasks), book, model_map.MockBackend())
    got = outputs(spark, tmp_path)
    assert {k: v[0] for k, v in got.items()} == {"a/b": "ab.md", "ab_1": "ab_1.md", "ab": "ab_2.md"}
    for file, body in got.values():
        assert (tmp_path / "out" / file).read_text(encoding="utf-8") == body
    R.run(spark, config(tmp_path, tasks, settings={"resume": False}), book, model_map.MockBackend())
    table = spark.read.parquet(str(tmp_path / "out/outputs.parquet"))
    assert sorted(r["task_id"] for r in table.collect()) == ["a/b", "ab", "ab_1"] and table.select("file").distinct().count() == 3


def test_outputs_survive_a_crash_between_tables(spark, tmp_path):
    place = str(tmp_path / "outputs.parquet")
    row = lambda i, body: spark.createDataFrame([(i, i + ".md", body)], "task_id string, file string, body string")
    sinks.write_outputs(row("a", "one"), place)
    sinks.write_outputs(row("b", "two"), place)
    sinks.write_outputs(row("a", "three"), place)
    os.rename(place, place + ".new")  # the old one is gone, the new one not in its place
    assert sorted(rows(sinks.load_outputs(spark, place), "task_id", "body", "chars")) == [("a", "three", 5), ("b", "two", 3)]


def test_unique_names(spark):
    from folioforge.functions import naming

    df = spark.createDataFrame([(i, n) for i, n in enumerate(["a.md", "a.md", "a_1.md", "a_1.md", "b.md", "c", "c", "d.md"])], "ord int, file string")
    plain = [r["file"] for r in naming.unique_names(df).orderBy("ord").collect()]
    assert plain == ["a.md", "a_2.md", "a_1.md", "a_1_1.md", "b.md", "c", "c_1", "d.md"]
    taken = spark.createDataFrame([("b.md",), ("d_7.md",), ("c_4",)], "file string")
    got = [r["file"] for r in naming.unique_names(df, taken=taken).orderBy("ord").collect()]
    assert got == ["a.md", "a_2.md", "a_1.md", "a_1_1.md", "b_1.md", "c", "c_5", "d.md"]


def test_progress_notices_and_pieces(spark, tmp_path, book):
    """Prompts are answered in pieces, with a notice between two of them."""
    raw = [{"id": f"t{i}", "pages": [1]} for i in range(30)]
    cfg = config(tmp_path, raw)
    cfg = type(cfg)(**{**cfg.__dict__, "run": type(cfg.run)(**{**cfg.run.__dict__, "notify_tasks": 10})})
    log = sinks.LogNotifier()
    out = R.run(spark, cfg, book, Answers(), log)
    assert out["success"] == 30
    titles = [json.loads(c)["header"]["title"]["content"].split(" - ")[0] for c in log.cards]
    assert titles == ["任务开始", "进度报告", "进度报告", "任务完成"]
    (answers,) = (tmp_path / "out/_answers").iterdir()
    assert len(list(answers.iterdir())) == 3


class Page:
    def __init__(self, text, tables):
        self.text, self.tables = text, tables

    def extract_text(self):
        return self.text

    def extract_tables(self):
        return self.tables


class Book:
    """A stand-in for a parsed file: pages are separated by form feeds, cells by bars."""

    def __init__(self, content):
        pages = content.decode().split("\f")
        self.pages = [Page(p, [[x.split("|") for x in p.split("\n") if "|" in x]] if "|" in p else []) for p in pages]

    def __enter__(self):
        return self

    def __exit__(self, *error):
        return None


def test_pdf_run_from_the_command_line(spark, tmp_path, monkeypatch, capsys):
    """Pages and tables of the file that the configuration names reach the tasks."""
    monkeypatch.setattr(page_source, "parser", Book)
    pdf = tmp_path / "book.pdf"
    pdf.write_bytes("第一页的正文写在这里，超过二十个字才行，一二三四五六七。\fh|k\nv|w".encode())
    raw = {"api": {"url": "mock:", "key": "k"}, "input": {"data_source": "list", "task_list": [{"id": "text", "pages": [1]}, {"id": "drawn", "type": "table", "pages": [2]}], "pdf_path": str(pdf)}, "output": {"dir": str(tmp_path / "out")}, "settings": {"api_interval": 0}, "prompt": {"template": ""}}
    (tmp_path / "table.json").write_text("{}")
    assert R._main(raw, [], mock=True) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["success"] == 2
    got = outputs(spark, tmp_path)
    assert got["drawn"][1] == "| h | k |\n|---|---|\n| v | w |"
    texts = spark.read.parquet(str(tmp_path / "out/_routes/*"))
    assert {r["task_id"]: r["text"] for r in texts.collect()}["text"].startswith("第一页")


def test_retry_hook_is_reachable(spark, tmp_path):
    place = str(tmp_path / "retries")

    def note(attempt, error, wait):
        with open(place, "a") as f:
            f.write(f"{attempt} {wait}\n")

    prompts = spark.createDataFrame([("a", "boom")], "task_id string, prompt string")
    config = C.ApiConfig("mock:", "", max_retries=3, retry_base_delay=0.01, api_interval=0.0)
    assert not model_map.call_model(prompts, Answers(), config, on_retry=note).first()["success"]
    assert open(place).read().splitlines() == ["1 0.01", "2 0.02"]


def test_run_dry(spark, tmp_path, book):
    out = R.run(spark, config(tmp_path, source="json", data={"items": [{"evidence": "e", "name": "n"}, {"evidence": "e", "name": "m"}]}), book, dry_run=True)
    assert out == {"total": 2, "dry_run": True, "labels": [("e", "n"), (None, "m")]}


def test_run_interp(spark, tmp_path, book):
    out = R.run(spark, config(tmp_path, source="toc", data=[["1", "甲", 2], ["2", "乙", 3], ["3", "丙", 9]], prompt={"template": "{text}"}), book, Answers())
    got = outputs(spark, tmp_path)
    assert out["success"] == 3
    assert got["1_甲"] == ("第1条【甲】司法解释.md", "司法解释目录：\n1. 关于适用刑法的解释一\n2. 关于适用刑法的解释二\n")
    assert got["3_丙"][1] == T.TITLE_HEAD + "\n" + T.NO_TITLES + "\n"


def test_run_evidence_and_dicts(spark, tmp_path, book):
    data = {"items": [{"evidence": "物证", "name": "来源", "sub_items": ["（一）保管"]}, {"evidence": "无", "name": "缺"}]}
    out = R.run(spark, config(tmp_path, source="json", data=data, input={"page_ranges": {"物证": [5, 5]}}, prompt={"template": "要点：{label}\n{text}"}), book, Answers())
    assert (out["success"], out["failed"]) == (1, 1)
    file, body = outputs(spark, tmp_path)["物证|来源|（一）保管"]
    assert file == "证据分析【物证】来源（保管）.md" and body.startswith("证据分析【物证】来源（保管）：\n要点：(保管)\n第五页")


def test_run_dict_texts(spark, tmp_path, book):
    data = [{"id": "t", "text": "内容", "evidence": "e", "point": "p"}, {"id": "n", "label": "L", "x": "X"}, "字符串"]
    R.run(spark, config(tmp_path, source="json", data=data, prompt={"template": "{label}/{text}/{x}"}), book, Answers())
    got = outputs(spark, tmp_path)
    assert got["t"][1] == "证据分析【e】非法证据排除（p）：\n/内容/{x}\n"
    assert got["n"] == ("n.md", "L/{text}/X") and got["字符串"][1] == "字符串/字符串/{x}"


def test_run_raw_tables(spark, tmp_path, book):
    R.run(spark, config(tmp_path, [{"id": "t", "pages": [1, 3]}], source="table", prompt={}), book, Answers("never"))
    assert outputs(spark, tmp_path)["t"] == ("t.md", "| h |\n|---|\n| v |")


def test_crash_and_resume_end_alike(spark, tmp_path, book):
    tasks = [{"id": str(i), "pages": [1]} for i in range(6)]
    whole = config(tmp_path / "a", tasks)
    R.run(spark, whole, book, Answers())
    R.run(spark, config(tmp_path / "b", tasks[:3]), book, Answers())
    rest = R.run(spark, config(tmp_path / "b", tasks), book, Answers())
    assert rest["total"] == 3
    state = lambda p: sorted(rows(progress.load(spark, str(tmp_path / p / "out/_progress")), "task_id", "status"))
    assert state("a") == state("b")


# -- sinks ---------------------------------------------------------------------------
def test_project_folder(spark, tmp_path):
    folders = sinks.scaffold(str(tmp_path), "p")
    (tmp_path / "x").mkdir()
    for p in ("f.txt", "x/f.txt"):
        (tmp_path / p).write_text(p)
    placed = sinks.place_inputs(spark, folders, [str(tmp_path / "f.txt"), str(tmp_path / "x/f.txt"), str(tmp_path / "missing"), 3])
    assert [os.path.basename(p) for p in placed] == ["f.txt", "f_1.txt"]
    assert "k" not in json.loads(open(sinks.save_config(folders, RAW), encoding="utf-8").read())["api"]
    script = open(sinks.save_script(folders, RAW), encoding="utf-8").read()
    compile(script, "run.py", "exec")
    assert sinks.HttpNotifier("http://127.0.0.1:9/none", timeout=0.2).send("{}") is False


# -- commands ---------------------------------------------------------------------------
COMMANDS = [("u", "confirm", 1.0), ("u", "retry", 5.0), ("u", "custom", 6.0), ("v", "cancel", 2.0)]


def test_commands_batch(spark):
    df = spark.createDataFrame(COMMANDS, "user string, action string, time double")
    assert set(rows(commands.latest(df, ["user"], ["time"]), "user", "action")) == {("u", "custom"), ("v", "cancel")}
    assert commands.latest(df, ["user"], ["time"], F.col("time") > 100).count() == 0
    assert set(rows(commands.keep_newest(df, ["user"], ["time"], 2), "time")) == {(5.0,), (6.0,), (2.0,)}
    waits = spark.createDataFrame([("u", 1.0, 4.5), ("v", 2.0, 10.0), ("w", 0.0, 1.0)], "user string, t0 double, timeout double")
    assert set(rows(commands.wait_for_reply(waits, df, ["user"], "time"), "user", "action")) == {("u", "retry"), ("v", None), ("w", None)}
    late = waits.withColumn("timeout", F.lit(9.0))
    assert ("u", None) in set(rows(commands.wait_for_reply(late, df, ["user"], "time", ["retry"]), "user", "action"))


def test_mailbox_and_streams(spark, tmp_path):
    events = spark.createDataFrame([("text", '{"text":" 请重试 "}', None, None, 3.0), ("text", '{"text":" "}', None, None, 4.0), ("card", None, "cancel", None, 5.0), ("card", None, None, "好", 6.0), ("image", "{}", None, None, 7.0)], "kind string, content string, action string, label string, time double").withColumn("open_id", F.lit("o")).withColumn("user_id", F.lit(None).cast("string"))
    box = str(tmp_path / "box")
    mailbox.append(mailbox.from_events(events), box)
    got = sorted(rows(mailbox.read(spark, box), "time", "action", "value"))
    assert got == [(3.0, "retry", "请重试"), (5.0, "cancel", "cancel"), (6.0, "confirm", "好")]
    stream = mailbox.stream(spark, box)
    streams.drain(streams.latest(stream, ["open_id"], ["time"]), str(tmp_path / "s1"), "", "complete", lambda b, _: b.write.mode("overwrite").parquet(str(tmp_path / "o1")))
    batch = commands.latest(mailbox.read(spark, box).drop("written"), ["open_id"], ["time"])
    assert rows(spark.read.parquet(str(tmp_path / "o1")), "open_id", "action", "time") == rows(batch, "open_id", "action", "time")
    streams.drain(streams.wait_for_reply(stream, "open_id", "time", 3.0, 60.0, ["confirm", "cancel"]), str(tmp_path / "s2"), str(tmp_path / "o2"))
    assert rows(spark.read.parquet(str(tmp_path / "o2")), "open_id", "action", "replied") == [("o", "cancel", 5.0)]


def test_waiting_for_a_reply(spark, tmp_path):
    box, clock, log = str(tmp_path / "box"), Clock(), sinks.LogNotifier()
    put = lambda action, at: mailbox.append(spark.createDataFrame([(action, "v", at, "", "")], mailbox.SCHEMA).coalesce(1), box)
    clock.now = 10.0
    waiting = {"clock": clock, "sleep": clock.sleep}
    assert mailbox.wait_for_reply(spark, box, 5.0, **waiting) is None and clock.now == 16.0
    put("confirm", 5.0)  # before the call
    assert mailbox.wait_for_reply(spark, box, 3.0, **waiting) is None
    put("retry", 1000.0)
    assert mailbox.wait_for_reply(spark, box, 3.0, expected=["cancel"], **waiting) is None
    got = mailbox.send_and_wait(spark, log, "t", ["x"], box, timeout=3.0, expected=["retry"], **waiting)
    assert got["action"] == "retry" and [a["type"] for a in json.loads(log.cards[0])["actions"]] == ["primary", "default", "danger"]
    for i in range(3):
        put("pause", 2000.0 + i)
    assert mailbox.retain(spark, box, 0) == 0 and mailbox.retain(spark, box, 2) == 3 and mailbox.read(spark, box).count() == 2


def test_newest_command_hides_earlier_ones_in_a_stream(spark, tmp_path):
    """Each file is one look: the newest command decides, a later look may still answer."""
    schema = "user string, action string, time double"
    looks = [[("a", "confirm", 2.0), ("a", "pause", 3.0), ("b", "confirm", 2.0), ("b", "retry", 4.0), ("c", "pause", 5.0)], [("a", "confirm", 2.5), ("b", "cancel", 6.0), ("c", "retry", 6.0)], [("a", "retry", 7.0), ("c", "confirm", 8.0), ("a", "confirm", 50.0)]]
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for rows_of in looks:
        spark.createDataFrame(rows_of, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streams.drain(streams.newest_reply(stream, "user", "time", 1.0, 20.0, ["confirm", "retry"]), str(tmp_path / "s"), str(tmp_path / "o"))
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "o")).collect()))
    assert got == [("a", "retry", 7.0), ("b", "retry", 4.0), ("c", "retry", 6.0)]


def test_listener(spark, tmp_path):
    schema = "kind string, content string, action string, label string, open_id string, user_id string, time double"
    (tmp_path / "events").mkdir()
    listener = streams.Listener(spark.readStream.schema(schema).json(str(tmp_path / "events")), str(tmp_path / "box"), str(tmp_path / "state"))
    assert listener.start() and listener.start() and listener.running
    spark.createDataFrame([("card", None, "pause", None, "o", None, 1.0)], schema).coalesce(1).write.mode("append").json(str(tmp_path / "events"))
    listener.query.processAllAvailable()
    listener.stop()
    assert not listener.running and mailbox.newest(spark, str(tmp_path / "box"))["action"] == "pause"


def test_throttle_stream(spark, tmp_path):
    steps = spark.createDataFrame([("k", n, 25, n * 40.0) for n in range(1, 26)], "k string, current long, total long, at double")
    steps.coalesce(1).write.parquet(str(tmp_path / "in"))
    streams.drain(streams.throttle(spark.readStream.schema(steps.schema).parquet(str(tmp_path / "in")), "k", 10, 300.0), str(tmp_path / "s"), str(tmp_path / "o"))
    assert sorted(r["current"] for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 9, 10, 18, 20, 25]


# -- catalogue ----------------------------------------------------------------------------
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_catalogue(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    df = catalogue.QUERIES[name](spark, SF)
    table = con.sql(catalogue.ORACLES[name]).to_arrow_table()
    columns = sorted(df.columns)
    assert columns == sorted(table.column_names)
    plain = lambda x: round(x, 6) if isinstance(x, float) else x
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(plain(r[c]) for c in columns) for r in table.to_pylist()), key=repr)


def test_chunks_of_odd_texts(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    texts = [None, "", " ", "\n" * 3001, "a" * 3000, "b" * 3001, "c" * 2500 + "\n" + "\U0001f600" * 9000, None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(catalogue.ORACLES["q46_chunks"]).fetchall()
    assert sorted(rows(catalogue.QUERIES["q46_chunks"](spark, str(tmp_path)), "doc_id", "joined_md5", "fits")) == sorted(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
