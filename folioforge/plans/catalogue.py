"""Query catalogue: every operator on the driver's tables, with its SQL.

Stand-ins: a page is a ``documents`` row (book = source, page number by
doc_id); every seventh page opens a table-of-contents entry; progress is
``labels``; calls and commands are ``events``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import naming, notices as N, text as T
from ..operators import commands, flow, model_map, pages as P, resume, rollup
from ..sources import mailbox, progress as progress_source, sinks, tasks as S
from ..sources.config import ApiConfig, RunConfig
from ..sources.scratch import scratch
from ..streaming import commands as streams
from . import run as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# -- SQL pieces ---------------------------------------------------------------
_WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _safe(x: str) -> str:
    return rf"""regexp_replace({x}, '[\\/:*?"<>|]', '', 'g')"""


_PAGES = "pages AS (SELECT source AS pdf_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS page_no, text, doc_id FROM documents)"
_TOC = _PAGES + ", toc AS (SELECT pdf_id, CAST(doc_id AS VARCHAR) AS num, page_no AS start_page, coalesce(lead(page_no) OVER w, page_no + 5) AS end_page, lead(CAST(doc_id AS VARCHAR)) OVER w AS next_num FROM pages WHERE page_no % 7 = 1 WINDOW w AS (PARTITION BY pdf_id ORDER BY page_no))"
_PROGRESS = "progress AS (SELECT CAST(doc_id AS VARCHAR) AS task_id, CASE WHEN toxic = 1 THEN 'failed' WHEN quality = 1 THEN 'success' ELSE 'skipped' END AS status, CASE WHEN toxic = 1 THEN 'rejected' END AS error, CAST(quality AS DOUBLE) AS elapsed FROM labels)"
_ACTIONS = {"view": "confirm", "click": "retry", "signup": "resume", "error": "cancel", "purchase": "pause"}
_ACTION = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _ACTIONS.items()) + " END"
_US = "epoch_us(ts)"
HOUR = 3_600_000_000


# -- stand-ins ----------------------------------------------------------------
def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark, d) -> DataFrame:
    number = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    return _t(spark, d, "documents").select(F.col("source").alias("pdf_id"), number.alias("page_no"), "text", "doc_id")


def _toc(spark, d) -> DataFrame:
    rows = _pages(spark, d).where("page_no % 7 = 1").select("pdf_id", F.col("page_no").cast("long").alias("ord"), F.col("doc_id").alias("num"), F.concat(F.lit(" ["), F.col("doc_id").cast("string"), F.lit("] ")).alias("title"), F.col("page_no").alias("start_page"))
    by = Window.partitionBy("pdf_id").orderBy("ord")
    return rows.withColumn("num", F.col("num").cast("string")).withColumn("end_page", F.coalesce(F.lead("start_page").over(by), F.col("start_page") + S.LAST_PAGES)).withColumn("next_num", F.lead("num").over(by))


def _progress(spark, d) -> DataFrame:
    status = F.when(F.col("toxic") == 1, "failed").when(F.col("quality") == 1, "success").otherwise("skipped")
    return _t(spark, d, "labels").select(F.col("doc_id").cast("string").alias("task_id"), status.alias("status"), F.when(F.col("toxic") == 1, "rejected").alias("error"), F.col("quality").cast("double").alias("elapsed"))


def _tasks(spark, d) -> DataFrame:
    return _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("task_id"), "doc_id", "source", "n_chars")


def micros(ts: str = "ts") -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def _action() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for p in _ACTIONS.items() for x in p]), F.col("event_type"))


def _events(spark, d) -> DataFrame:
    return _t(spark, d, "events").select("event_id", "user_id", "event_type", "ts", micros().alias("us"), _action().alias("action"))


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# -- text ---------------------------------------------------------------------
def _truncate_sql(limit: int) -> str:
    seps = ["chr(10) || chr(10)", "chr(10)", *[f"'{s}'" for s in T.SEPARATORS[2:]]]
    cuts = ", ".join(f"CASE WHEN instr(r, reverse({s})) > 0 THEN {limit - 500} + length(w) - instr(r, reverse({s})) + 1 END" for s in seps)
    return f"SELECT doc_id, CASE WHEN length(text) <= {limit} THEN text ELSE left(text, coalesce({cuts}, {limit})) END AS cut_text FROM (SELECT doc_id, text, w, reverse(w) AS r FROM (SELECT doc_id, text, substring(text, {limit - 499}, 500) AS w FROM documents))"


@query(f"SELECT doc_id, cut_text, CAST(length(cut_text) AS INTEGER) AS out_len FROM ({_truncate_sql(2000)})")
def q01_truncate(spark, d):
    cut = _t(spark, d, "documents").select("doc_id", T.smart_truncate("text", 2000).alias("cut_text"))
    return cut.withColumn("out_len", F.length("cut_text"))


@query(f"WITH {_TOC} SELECT pdf_id, num, start_page, end_page, next_num FROM toc")
def q02_toc_ranges(spark, d):
    return _toc(spark, d).select("pdf_id", "num", "start_page", "end_page", "next_num")


@query(f"WITH {_TOC} SELECT t.pdf_id, t.num, CAST(count(nullif(p.text, '')) AS INTEGER) AS n_pages, coalesce(string_agg(nullif(p.text, ''), chr(10) ORDER BY p.page_no), '') AS text FROM toc t LEFT JOIN pages p ON p.pdf_id = t.pdf_id AND p.page_no BETWEEN t.start_page AND t.end_page GROUP BY t.pdf_id, t.num")
def q03_range_concat(spark, d):
    return P.range_text(_toc(spark, d), _pages(spark, d), ["pdf_id", "num"])


def _interp_tasks(spark, d) -> DataFrame:
    """Documents as tasks with their text."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("task_id"), F.col("doc_id").cast("string").alias("num"), F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"), F.lit("interp").alias("type"), F.col("source").alias("label"), F.col("doc_id").alias("ord"), F.create_map(F.lit("lang"), "lang", F.lit("source"), "source").alias("meta"), "text")
    return S._whole(docs.drop("text")).join(docs.select("task_id", "text"), "task_id").withColumn("missing", F.lit(None).cast("string"))


@query("SELECT CAST(doc_id AS VARCHAR) AS task_id, CASE WHEN length(text) < 20 THEN 'empty' ELSE 'model' END AS route FROM documents")
def q04_interp_route(spark, d):
    docs = _interp_tasks(spark, d)
    return R.routed(docs, RunConfig(template="{text}")).select("task_id", "route")


# -- resume, upsert, rollup ---------------------------------------------------
@query(f"WITH {_PROGRESS} SELECT doc_id, source FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT task_id FROM progress WHERE status IN ('success', 'skipped'))")
def q05_resume_pending(spark, d):
    return resume.pending(_tasks(spark, d), _progress(spark, d)).select("doc_id", "source")


@query(f"WITH {_PROGRESS} SELECT doc_id, source FROM documents WHERE CAST(doc_id AS VARCHAR) IN (SELECT task_id FROM progress WHERE status = 'failed')")
def q06_retry_pending(spark, d):
    return resume.pending(_tasks(spark, d), _progress(spark, d), resume=True, retry_failed=True).select("doc_id", "source")


@query(f"WITH {_PROGRESS}, fresh AS (SELECT CAST(doc_id AS VARCHAR) AS task_id, n_chars / 1000.0 AS elapsed FROM documents WHERE lang <> 'en') SELECT coalesce(f.task_id, p.task_id) AS task_id, CASE WHEN f.task_id IS NOT NULL THEN 'success' ELSE p.status END AS status, CASE WHEN f.task_id IS NULL THEN p.error END AS error, CASE WHEN f.task_id IS NOT NULL THEN CAST(f.elapsed AS DOUBLE) ELSE p.elapsed END AS elapsed FROM progress p FULL JOIN fresh f ON p.task_id = f.task_id")
def q07_upsert(spark, d):
    fresh = _t(spark, d, "documents").where("lang <> 'en'").select(F.col("doc_id").cast("string").alias("task_id"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"), (F.col("n_chars") / 1000.0).alias("elapsed"))
    return resume.upsert(_progress(spark, d), fresh).select("task_id", "status", "error", "elapsed")


_COUNTS = f"WITH {_PROGRESS}, c AS (SELECT source, count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'skipped') AS skipped, count(status) AS current, sum(CASE WHEN status IS NOT NULL THEN n_chars ELSE 0 END) AS chars FROM documents LEFT JOIN progress ON task_id = CAST(doc_id AS VARCHAR) GROUP BY source)"


def _counts(spark, d) -> DataFrame:
    joined = _tasks(spark, d).join(_progress(spark, d), "task_id", "left")
    chars = F.sum(F.when(F.col("status").isNotNull(), F.col("n_chars")).otherwise(F.lit(0).cast("long"))).alias("chars")
    return rollup.with_progress(rollup.status_counts(joined, ["source"], chars))


@query(_COUNTS + " SELECT source, total, success, failed, skipped, current, round(current * 100.0 / total, 6) AS pct, repeat('█', CAST(current * 100 // (total * 5) AS INTEGER)) || repeat('░', CAST(20 - current * 100 // (total * 5) AS INTEGER)) AS bar FROM c")
def q08_rollup(spark, d):
    return _counts(spark, d).select("source", "total", "success", "failed", "skipped", "current", F.round("pct", 6).alias("pct"), "bar")


@query(_COUNTS + " SELECT source, round(chars / 100.0 / current, 6) AS avg_s, round(chars / 100.0 / current * (total - current) / 60, 6) AS eta_min FROM c")
def q09_eta(spark, d):
    timed = rollup.with_eta(_counts(spark, d).withColumn("elapsed_s", F.col("chars") / 100.0))
    return timed.select("source", F.round("avg_s", 6).alias("avg_s"), F.round("eta_min", 6).alias("eta_min"))


_NUMBERED = r"'^\s*\p{Nd}+[.\x{3000}、]" + _WS + r"*(.+)'"
_TITLES = f"""
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
s AS (SELECT doc_id, i, {_strip('line')} AS line FROM l),
b AS (SELECT doc_id, i, CASE WHEN regexp_matches(line, {_NUMBERED}) THEN {_strip(f"regexp_extract(line, {_NUMBERED}, 1)")} ELSE line END AS title FROM s WHERE line <> ''),
k AS (SELECT doc_id, title, min(i) AS i FROM b WHERE length(title) >= 6 AND {' AND '.join(f"NOT contains(title, '{n}')" for n in T.NOISE)} GROUP BY doc_id, title)"""


@query(f"WITH {_TITLES} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) AS n, title FROM k")
def q10_titles_explode(spark, d):
    titles = _t(spark, d, "documents").select("doc_id", T.parse_titles("text").alias("t"))
    return titles.select("doc_id", F.posexplode("t").alias("n", "title")).select("doc_id", (F.col("n") + 1).alias("n"), "title")


#: What stands before a line of an answer, by its number modulo eight: fields, brackets, nothing.
_BEFORE = ("要点：", "", "定性:", "法律依据: 【A】", "【B】", "【C】", "", "处理：")
_ANSWERS = f"answers AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: [{', '.join(f"'{b}'" for b in _BEFORE)}][(i - 1) % 8 + 1] || CASE WHEN i % 8 = 5 THEN replace(x, ' ', '【') ELSE x END), chr(10)) AS answer FROM documents)"


def _answers(spark, d) -> DataFrame:
    """Answers made of every line of a document, with fields and brackets put in."""
    before = F.array(*map(F.lit, _BEFORE))
    line = lambda x, i: F.concat(F.element_at(before, i % 8 + 1), F.when(i % 8 == 4, F.replace(x, F.lit(" "), F.lit("【"))).otherwise(x))
    return _t(spark, d, "documents").select("doc_id", F.array_join(F.transform(F.split("text", "\n", -1), line), "\n").alias("answer"))


def _pieces(x: str) -> str:
    return f"list_filter(list_transform(string_split(replace({x}, '【', chr(1) || '【'), chr(1)), lambda y: {_strip('y')}), lambda y: y <> '')"


_FORMAT = f"""WITH {_ANSWERS},
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split({_strip('answer')}, chr(10)) AS ls FROM answers)),
s AS (SELECT * FROM (SELECT doc_id, i, {_strip('line')} AS s FROM l) WHERE s <> ''),
k AS (SELECT *, CASE WHEN regexp_matches(s, '^法律依据[：:]') THEN 'law' WHEN regexp_matches(s, '^(要点|定性|处理)[：:]') THEN 'other' END AS kind FROM s),
f AS (SELECT *, last_value(kind IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM k),
p AS (SELECT doc_id, i, CASE WHEN kind = 'law' THEN list_concat(['', '法律依据：'], {_pieces(f"regexp_replace(s, '^法律依据[：:]{_WS}*', '')")}) WHEN kind = 'other' THEN ['', s] WHEN state = 'law' THEN {_pieces('s')} ELSE [s] END AS ps FROM f)
SELECT doc_id, {_strip("array_to_string(flatten(list(ps ORDER BY i)), chr(10))")} || chr(10) AS laid FROM p GROUP BY doc_id"""


@query(_FORMAT)
def q11_format_output(spark, d):
    return _answers(spark, d).select("doc_id", T.format_output("answer").alias("laid"))


@query(f"WITH {_ANSWERS} SELECT doc_id, array_to_string(list_filter({_pieces('answer')}, lambda y: starts_with(y, '【')), '|') AS items FROM answers")
def q12_brackets(spark, d):
    return _answers(spark, d).select("doc_id", F.array_join(T.split_by_brackets("answer"), "|").alias("items"))


_NAMES = f"""WITH x AS (SELECT 'part' AS kind, p_partkey AS id, CAST(p_size AS VARCHAR) AS num, p_name AS title FROM part UNION ALL SELECT 'page', page_id, CAST(page_id % 3 AS VARCHAR), url FROM pages),
n AS (SELECT kind, id, left({_safe("num || '_' || title")}, 200) AS name FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY kind, name ORDER BY id) - 1 AS k FROM n)
SELECT kind, id, name || CASE WHEN k > 0 THEN '_' || k ELSE '' END || '.md' AS file FROM r"""


@query(_NAMES)
def q13_filenames(spark, d):
    part = _t(spark, d, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_size").cast("string").alias("num"), F.col("p_name").alias("title"))
    page = _t(spark, d, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), (F.col("page_id") % 3).cast("string").alias("num"), F.col("url").alias("title"))
    meta = F.create_map(F.lit("num"), "num", F.lit("title"), "title")
    out = []
    for rows in (part, page):
        named = naming.output_names(rows.withColumn("meta", meta).withColumn("type", F.lit("custom")).withColumn("task_id", F.col("id").cast("string")), "{num}_{title}")
        out.append(naming.unique_names(named, "file", "id").select("kind", "id", "file"))
    return out[0].union(out[1])


@query("SELECT doc_id, replace(replace(replace('<{text}|{label}|{evidence}>', '{text}', text || '{label}'), '{label}', source), '{evidence}', lang) AS filled, replace(replace('{lang}/{source}/{none}', '{lang}', lang), '{source}', source) AS mapped FROM documents")
def q14_prompts(spark, d):
    docs = _t(spark, d, "documents")
    filled = T.fill(F.lit("<{text}|{label}|{evidence}>"), ("text", F.concat("text", F.lit("{label}"))), ("label", F.col("source")), ("evidence", F.col("lang")))
    return docs.select("doc_id", filled.alias("filled"), T.fill_from_map(F.lit("{lang}/{source}/{none}"), F.create_map(F.lit("lang"), "lang", F.lit("source"), "source")).alias("mapped"))


@query("SELECT r_name, '| name | key | note |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |  |', chr(10) ORDER BY n_nationkey) AS md FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def q15_md_table(spark, d):
    nation, region = _t(spark, d, "nation"), _t(spark, d, "region")
    cell = F.struct("n_nationkey", F.array("n_name", F.col("n_nationkey").cast("string"), F.lit(None).cast("string")).alias("row"))
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey).groupBy("r_name").agg(F.array_sort(F.collect_list(cell)).alias("c"))
    head = F.array(F.array(F.lit("name"), F.lit("key"), F.lit("note")))
    return rows.select("r_name", T.markdown_table(F.concat(head, F.transform("c", lambda c: c["row"]))).alias("md"))


@query("SELECT doc_id, n_nationkey + 1 AS range_start, CASE WHEN n_nationkey IS NULL THEN 'failed' ELSE 'ok' END AS status FROM documents LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 15) ON source = 'src' || n_nationkey")
def q16_page_lookup(spark, d):
    ranges = _t(spark, d, "nation").where("n_nationkey < 15").select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("grp"), (F.col("n_nationkey") + 1).alias("start_page"), (F.col("n_nationkey") + 3).alias("end_page"))
    found = P.lookup_ranges(_t(spark, d, "documents").select("doc_id", F.col("source").alias("grp")), ranges)
    return found.select("doc_id", "range_start", F.when(F.col("range_start").isNull(), "failed").otherwise("ok").alias("status"))


@query("""WITH n AS (SELECT r_name, n_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT *, unnest(['（一）' || n_name, '(二)' || n_name]) AS sub FROM n WHERE n_nationkey % 2 = 0)
SELECT r_name || '|' || n_name || '|' || sub AS task_id, n_name || ' -> ' || sub AS label, r_name AS grp, 'evidence_sub' AS type, CASE WHEN starts_with(sub, '（一）') THEN n_name ELSE sub END AS sub_name FROM s
UNION ALL SELECT r_name || '|' || n_name, n_name, r_name, 'evidence', NULL FROM n WHERE n_nationkey % 2 = 1""")
def q17_nested_tasks(spark, d):
    nation, region = _t(spark, d, "nation"), _t(spark, d, "region")
    subs = F.when(F.col("n_nationkey") % 2 == 0, F.array(F.concat(F.lit("（一）"), "n_name"), F.concat(F.lit("(二)"), "n_name"))).otherwise(F.array().cast("array<string>"))
    item = F.struct(F.col("r_name").alias("evidence"), F.col("n_name").alias("name"), subs.alias("sub_items"))
    docs = nation.join(region, nation.n_regionkey == region.r_regionkey).groupBy("r_name").agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("json"))
    return S.from_nested(S.nested_rows(docs)).select("task_id", "label", "grp", "type", "sub_name")


@query("""SELECT * FROM (VALUES ('1_总则', '第1条 [总则]', 'interp'), ('2_罪刑法定', '第2条 [罪刑法定]', 'interp'), ('a', 'a', 'custom'), ('b', 'B', 'special'), ('0', '表格内容', 'table'), ('t', 'T', 'table'),
('plain', 'plain', 'json_list'), ('k1', 'k1', 'json_dict'), ('k2', 'L', 'json_dict'), ('only', 'only', 'json_dict'), ('e｜p', 'e｜p', 'json_dict'), ('9', '9', 'json_dict'), ('5', '5', 'json_dict')) v(task_id, label, type)""")
def q18_task_union(spark, d):
    toc = S.from_toc(S.toc_rows(spark.createDataFrame([('[["1"," [总则] ",3],[2,"罪刑法定",7]]',)], "json string")))
    items = lambda rows: S.item_rows(spark, rows)
    listed = S.from_list(items([{"id": "a"}, {"id": "b", "label": "B", "type": "special"}]))
    table = S.from_table(items([{"pages": [1]}, {"id": "t", "label": "T"}]))
    strings = S.from_strings(spark.createDataFrame([(0, "plain")], "ord long, value string"))
    dicts = S.from_dicts(items([{"task_id": "k1"}, {"id": "k2", "label": "L"}, {"label": "only"}, {"evidence": "e", "point": "p"}, {"num": 9}, {"evidence": "e"}]))
    return S.unite(toc, listed, table, strings, dicts).select("task_id", "label", "type")


# -- commands -----------------------------------------------------------------
@query(f"SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max({_ACTION}, ts) AS action FROM events GROUP BY user_id")
def q19_latest_cmd(spark, d):
    return commands.latest(_events(spark, d), ["user_id"], ["us", "event_id"]).select("user_id", "event_id", "action")


@query("SELECT user_id, event_id, greatest(n - 10, 0) AS n_dropped FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE k <= 10")
def q20_retention(spark, d):
    events = _events(spark, d).select("user_id", "event_id", "us")
    sizes = events.groupBy("user_id").agg(F.greatest(F.count("*") - 10, F.lit(0)).alias("n_dropped"))
    return commands.keep_newest(events, ["user_id"], ["us", "event_id"], 10).join(sizes, "user_id").select("user_id", "event_id", "n_dropped")


@query(f"""WITH w AS (SELECT user_id, min({_US}) + {120 * HOUR} AS t0 FROM events GROUP BY user_id),
c AS (SELECT e.user_id, {_US} AS us, {_ACTION} AS action FROM events e), j AS (SELECT w.user_id, arg_max(action, us) AS action, max(us) AS us FROM w JOIN c ON c.user_id = w.user_id AND us > t0 AND us < t0 + {48 * HOUR} GROUP BY w.user_id)
SELECT w.user_id, CASE WHEN action IN ('confirm', 'retry') THEN action END AS action, CASE WHEN action IN ('confirm', 'retry') THEN us END AS replied FROM w LEFT JOIN j ON w.user_id = j.user_id""")
def q21_wait_reply(spark, d):
    events = _events(spark, d).select("user_id", "event_id", "us", "action")
    waits = events.groupBy("user_id").agg((F.min("us") + 120 * HOUR).alias("t0")).withColumn("timeout", F.lit(48 * HOUR))
    return commands.wait_for_reply(waits, events, ["user_id"], "us", ["confirm", "retry"], "event_id").select("user_id", "action", "replied")


_WORDS = ("请确认并取消", "重试一下", "好的", "先暂停", "继续吧", "取消")
_CHINESE = "CASE " + " ".join(f"WHEN contains(x, '{w}') THEN '{a}'" for w, a in N.CHINESE_ACTIONS) + " ELSE 'custom' END"
_ENGLISH = "CASE " + " ".join(f"WHEN contains(lower(x), '{a}') THEN '{a}'" for a in N.ENGLISH_ACTIONS) + " ELSE 'custom' END"


@query(f"WITH a AS (SELECT x AS id, {_CHINESE} AS action FROM (SELECT unnest([{', '.join(f"'{w}'" for w in _WORDS)}]) AS x) UNION ALL SELECT conv_id || '-' || turn, {_ENGLISH} FROM (SELECT conv_id, turn, text || CASE WHEN turn % 3 = 0 THEN ' Please RETRY' ELSE '' END AS x FROM conversations)) SELECT id, action, CASE action WHEN 'confirm' THEN 'primary' WHEN 'cancel' THEN 'danger' ELSE 'default' END AS style FROM a")
def q22_classify(spark, d):
    inline = spark.createDataFrame([(w,) for w in _WORDS], "id string").withColumn("action", N.classify(F.col("id")))
    talk = _t(spark, d, "conversations")
    text = F.concat("text", F.when(F.col("turn") % 3 == 0, " Please RETRY").otherwise(""))
    english = talk.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), N.classify(text, chinese=False).alias("action"))
    return inline.union(english).withColumn("style", N.button_style(F.col("action")))


# -- flow control -------------------------------------------------------------
@query(f"""WITH k AS (SELECT user_id, event_id, {_US} AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events),
s AS (SELECT *, k * {6 * HOUR} + max(us - k * {6 * HOUR}) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS start FROM k) SELECT event_id, start, start - us AS delay FROM s""")
def q23_rate_schedule(spark, d):
    events = _events(spark, d).select("user_id", "event_id", "us").withColumn("_o", F.struct("us", "event_id"))
    return flow.rate_schedule(events, 6 * HOUR, ["user_id"], "us", "_o").select("event_id", "start", "delay")


@query(f"""WITH m AS (SELECT user_id, {_US} AS us, event_type = 'error' AS f, row_number() OVER w - sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w AS g FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, min(us) AS run_start, count(*) AS run_length FROM m WHERE f GROUP BY user_id, g""")
def q24_failure_runs(spark, d):
    return flow.failure_runs(_events(spark, d), ["user_id"], "us", F.col("event_type") == "error")


@query(f"""WITH RECURSIVE e AS (SELECT user_id, event_id, {_US} AS us, event_type = 'error' AS f, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT user_id, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS c, CAST(NULL AS BIGINT) AS until, CAST(NULL AS BIGINT) AS event_id, CAST('' AS VARCHAR) AS outcome FROM (SELECT DISTINCT user_id FROM e)
 UNION ALL SELECT user_id, n, CASE WHEN shut THEN c WHEN f THEN c + 1 ELSE 0 END, CASE WHEN shut THEN until WHEN f AND c + 1 >= 2 THEN us + {12 * HOUR} WHEN NOT f THEN NULL ELSE until END, event_id, CASE WHEN shut THEN 'rejected' WHEN f THEN 'failed' ELSE 'success' END
 FROM (SELECT e.user_id, e.n, r.c, r.until, e.event_id, e.us, e.f, coalesce(e.us < r.until, false) AS shut FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1))
SELECT event_id, outcome FROM r WHERE n > 0""")
def q25_breaker(spark, d):
    events = _events(spark, d).withColumn("failed", F.col("event_type") == "error")
    return flow.breaker(events, ["user_id"], ["us", "event_id"], "us", "failed", 2, 12 * HOUR).select("event_id", "outcome")


@query("SELECT event_id, CAST(a AS INTEGER) AS attempt, CAST(5 * power(2, a - 1) AS DOUBLE) AS wait_s, CAST(5 * (power(2, a) - 1) AS DOUBLE) AS waited_s FROM (SELECT event_id, unnest(range(1, 4)) AS a FROM events WHERE event_type = 'error')")
def q26_backoff(spark, d):
    waits = _events(spark, d).where("event_type = 'error'").select("event_id", F.explode(flow.backoff(5.0, 3)).alias("b"))
    return waits.select("event_id", "b.attempt", "b.wait_s", "b.waited_s")


@query(f"""WITH RECURSIVE e AS (SELECT user_id, {_US} // 1000000 AS sec, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, count(*) OVER (PARTITION BY user_id) AS total FROM events),
r AS (SELECT user_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS last, false AS emit FROM (SELECT DISTINCT user_id FROM e)
 UNION ALL SELECT user_id, n, CASE WHEN emit THEN sec ELSE last END, emit FROM (SELECT e.user_id, e.n, e.sec, r.last, (e.n = e.total OR e.n % 10 = 0 OR r.last IS NULL OR e.sec - r.last >= 172800) AS emit FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1))
SELECT user_id, n FROM r WHERE emit""")
def q27_throttle(spark, d):
    by = Window.partitionBy("user_id")
    steps = _events(spark, d).select("user_id", F.row_number().over(by.orderBy("us", "event_id")).cast("long").alias("n"), F.floor(F.col("us") / 1_000_000).cast("long").alias("sec"), F.count("*").over(by).alias("total"))
    return flow.throttle(steps, ["user_id"], "n", "sec", "total", 10, 172_800).where("emit").select("user_id", "n")


@query("WITH s AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS total_calls, count(*) FILTER (WHERE event_type = 'error') AS total_failures FROM events GROUP BY 1, 2) SELECT user_id, CAST(d AS VARCHAR) AS day, total_calls, total_failures, total_calls - coalesce(lag(total_calls) OVER (PARTITION BY user_id ORDER BY d), 0) AS delta_calls FROM s")
def q28_call_stats(spark, d):
    calls = _events(spark, d).select("user_id", F.to_date("ts").cast("string").alias("day"), (F.col("event_type") != "error").alias("ok"))
    return rollup.call_delta(rollup.call_stats(calls, ["user_id", "day"]), ["user_id"], "day")


@query("""WITH g AS (SELECT doc_id, lang, CASE WHEN doc_id % 5 <> 0 THEN source ELSE '' END AS grp FROM documents),
b AS (SELECT *, last_value(nullif(grp, '') IGNORE NULLS) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g)
SELECT doc_id, CASE WHEN grp <> '' AND grp IS DISTINCT FROM before THEN grp END AS heading FROM b""")
def q29_dry_run(spark, d):
    tasks = _t(spark, d, "documents").select(F.col("doc_id").alias("ord"), "lang", F.when(F.col("doc_id") % 5 != 0, F.col("source")).otherwise("").alias("grp"))
    return rollup.dry_run(tasks, ["lang"]).select(F.col("ord").alias("doc_id"), "heading")


@query(f"SELECT CAST(doc_id AS VARCHAR) AS task_id, CASE WHEN contains(cut_text, 'idiot') THEN 'failed' ELSE 'success' END AS status, CASE WHEN NOT contains(cut_text, 'idiot') THEN 'answer: ' || split_part(cut_text, chr(10), 1) END AS content, CASE WHEN contains(cut_text, 'idiot') THEN 'RuntimeError: mock failure' END AS error, CAST(CASE WHEN contains(cut_text, 'idiot') THEN 2 ELSE 1 END AS INTEGER) AS attempts FROM ({_truncate_sql(600)})")
def q30_llm_mock(spark, d):
    prompts = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("task_id"), T.smart_truncate("text", 600).alias("prompt"))
    # No waits and no breaker here: its state would depend on how rows are dealt out.
    config = ApiConfig("mock:", "", max_retries=2, retry_base_delay=0.0, api_interval=0.0, max_consecutive_failures=1 << 30)
    return model_map.to_status(model_map.call_model(prompts, model_map.MockBackend("idiot"), config)).select("task_id", "status", "content", "error", "attempts")


_ERRORS = ("Rate limit reached", "too many RATE", "Read timed out", "circuit breaker open", "boom", "TaskTimeout: task timeout")


@query(f"SELECT m AS message, CASE WHEN contains(lower(m), 'rate') THEN 'rate_limit' WHEN contains(lower(m), 'timeout') OR contains(lower(m), 'timed out') THEN 'timeout' WHEN contains(lower(m), 'circuit') THEN 'breaker' ELSE 'error' END AS class FROM (SELECT unnest([{', '.join(f"'{e}'" for e in _ERRORS)}]) AS m)")
def q31_error_class(spark, d):
    return spark.createDataFrame([(m,) for m in _ERRORS], "message string").withColumn("class", flow.error_class(F.col("message")))


@query(_COUNTS + " SELECT source, CASE WHEN failed = 0 THEN 'green' WHEN failed < total * 0.1 THEN 'orange' ELSE 'red' END AS colour, '任务完成 - ' || source AS title, '**总计** ' || total || ' **成功** ' || success || ' **失败** ' || failed || ' **跳过** ' || skipped AS figures FROM c")
def q32_card_json(spark, d):
    made = _counts(spark, d).select("source", N.complete_card(F.col("source"), F.col("total"), F.col("success"), F.col("failed"), F.col("skipped"), F.lit(1.25)).alias("j"))
    return made.select("source", F.get_json_object("j", "$.header.template").alias("colour"), F.get_json_object("j", "$.header.title.content").alias("title"), F.get_json_object("j", "$.elements[1].content").alias("figures"))


@query(f"SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max({_ACTION}, ts) AS action FROM events GROUP BY user_id")
def q33_cmd_stream(spark, d):
    """The newest command through a file stream that is drained into a table."""
    schema = _t(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet").select("event_id", "user_id", "event_type", micros().alias("us"), _action().alias("action"))
    place = scratch(spark, "stream")
    streams.drain(streams.latest(stream, ["user_id"], ["us", "event_id"]), f"{place}/state", "", "complete", lambda batch, _: batch.write.mode("overwrite").parquet(f"{place}/out"))
    return spark.read.parquet(f"{place}/out").select("user_id", "event_id", "action")


@query("SELECT * FROM (VALUES (1, 'a'), (2, ''), (3, 'b'), (4, 'c'), (5, '')) v(id, text)")
def q34_json_text_key(spark, d):
    rows = spark.createDataFrame([(1, '{"text":"a","raw":"x"}'), (2, '{"text":"","raw":"x"}'), (3, '{"raw":"b","content":"x"}'), (4, '{"content":"c"}'), (5, '{"label":"l"}')], "id int, j string")
    return rows.select("id", T.text_of_map(F.from_json("j", "map<string,string>")).alias("text"))


@query(f"SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%H:%M:%S') AS clock, {_US} // 1000 AS ms, CASE WHEN event_id % 4 = 0 THEN '计算中...' ELSE '约' || CAST(CASE WHEN (event_id % 8) * 1.25 - floor((event_id % 8) * 1.25) = 0.5 THEN 2 * round((event_id % 8) * 1.25 / 2) ELSE round((event_id % 8) * 1.25) END AS INTEGER) || '分钟' END AS eta FROM events")
def q35_time_format(spark, d):
    eta = F.when(F.col("event_id") % 4 == 0, F.lit(0.0)).otherwise((F.col("event_id") % 8) * 1.25)
    return _events(spark, d).select("event_id", N.timestamp_text(F.col("ts")).alias("stamp"), N.clock_text(F.col("ts")).alias("clock"), F.floor(F.col("us") / 1000).cast("long").alias("ms"), N.eta_text(eta).alias("eta"))


@query(f"WITH {_PROGRESS} SELECT count(*) AS total, count(*) FILTER (WHERE status IN ('success', 'skipped')) AS resumed, count(*) - count(*) FILTER (WHERE status IN ('success', 'skipped')) AS pending FROM documents LEFT JOIN progress ON task_id = CAST(doc_id AS VARCHAR)")
def q36_initial_counts(spark, d):
    return resume.initial_counts(_tasks(spark, d), _progress(spark, d))


@query(f"WITH {_PROGRESS} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'skipped') AS skipped, string_agg(task_id, ',' ORDER BY CAST(task_id AS BIGINT)) FILTER (WHERE status = 'failed') AS failed_ids, CAST(1.5 AS DOUBLE) AS elapsed_min FROM progress")
def q37_run_summary(spark, d):
    done = _progress(spark, d).withColumn("ord", F.col("task_id").cast("long"))
    return rollup.summary(done, 1.5).withColumn("failed_ids", F.array_join("failed_ids", ","))


@query(f"WITH {_PROGRESS} SELECT task_id, status, error, elapsed FROM progress")
def q38_progress_json(spark, d):
    """Progress through its JSON document and back."""
    some = _progress(spark, d).withColumn("updated", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return progress_source.from_json(progress_source.to_json(some, "x")).select("task_id", "status", "error", "elapsed")


# -- tables, routing, bodies, figures -----------------------------------------
_GRID = "'| ' || d.source || ' | ' || d.doc_id || ' |' || chr(10) || '|---|---|' || chr(10) || '| ' || d.lang || ' |  |'"


@query(f"WITH {_TOC}, tables AS (SELECT p.pdf_id, p.page_no, CASE WHEN d.lang <> 'en' THEN {_GRID} END AS md FROM pages p JOIN documents d ON p.doc_id = d.doc_id) SELECT t.pdf_id, t.num, CAST(count(md) AS INTEGER) AS n_pages, coalesce(string_agg(md, chr(10) || chr(10) ORDER BY x.page_no), '') AS text FROM toc t LEFT JOIN tables x ON x.pdf_id = t.pdf_id AND x.page_no BETWEEN t.start_page AND t.end_page GROUP BY t.pdf_id, t.num")
def q39_range_tables(spark, d):
    """A table on every page, empty on English ones, put together by page range."""
    pages = _pages(spark, d).select("pdf_id", "page_no", "doc_id").join(_t(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    grid = F.array(F.array(F.col("pdf_id"), F.col("doc_id").cast("string")), F.array(F.col("lang"), F.lit(None).cast("string")))
    tables = pages.select("pdf_id", "page_no", F.lit(0).alias("table_ix"), F.when(F.col("lang") != "en", grid).otherwise(F.array().cast("array<array<string>>")).alias("rows"))
    return P.range_tables(_toc(spark, d), tables, ["pdf_id", "num"])


_MESSAGE = _strip("coalesce(json_extract_string(content, '$.text'), '')")
_CLASSIFIED = "CASE " + " ".join(f"WHEN contains(message, '{w}') THEN '{a}'" for w, a in N.CHINESE_ACTIONS) + " ELSE 'custom' END"


@query(f"""WITH e AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'text' ELSE 'image' END AS kind, CASE WHEN turn % 5 = 1 THEN '{{"x":1}}' ELSE json_object('text', '  ' || text || CASE WHEN conv_id % 2 = 0 THEN ' 请重试' ELSE '' END || ' ') END AS content, CASE WHEN conv_id % 4 = 0 THEN 'pause' END AS action, CASE WHEN conv_id % 3 = 0 THEN 'L' || turn END AS label FROM conversations),
m AS (SELECT *, {_MESSAGE} AS message FROM e)
SELECT CAST(conv_id AS VARCHAR) AS user_id, turn AS at_turn, CASE WHEN kind = 'card' THEN coalesce(action, 'confirm') ELSE {_CLASSIFIED} END AS action, CASE WHEN kind = 'card' THEN coalesce(label, action, 'confirm') ELSE message END AS value FROM m WHERE kind = 'card' OR (kind = 'text' AND message <> '')""")
def q40_mailbox_events(spark, d):
    """Chat events to commands: cards carry an action, texts are classified, empty texts and other kinds go."""
    body = F.to_json(F.struct(F.concat(F.lit("  "), "text", F.when(F.col("conv_id") % 2 == 0, " 请重试").otherwise(""), F.lit(" ")).alias("text")))
    events = _t(spark, d, "conversations").select(
        F.when(F.col("turn") % 3 == 0, "card").when(F.col("turn") % 3 == 1, "text").otherwise("image").alias("kind"),
        F.when(F.col("turn") % 5 == 1, F.lit('{"x":1}')).otherwise(body).alias("content"),
        F.when(F.col("conv_id") % 4 == 0, "pause").alias("action"),
        F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("L"), F.col("turn").cast("string"))).alias("label"),
        F.lit(None).cast("string").alias("open_id"), F.col("conv_id").cast("string").alias("user_id"), F.col("turn").alias("time"),
    )
    return mailbox.from_events(events).select("user_id", F.col("time").alias("at_turn"), "action", "value")


_KINDS = {"en": "interp", "de": "table", "fr": "evidence_sub", "es": "evidence"}
_TYPE = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _KINDS.items()) + " ELSE 'custom' END"


def _typed(spark, d) -> DataFrame:
    """Documents as tasks of a type by language, with the columns that routing and names use."""
    of = F.create_map(*[F.lit(x) for p in _KINDS.items() for x in p])
    docs = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("task_id"), F.col("doc_id").alias("ord"), F.coalesce(of[F.col("lang")], F.lit("custom")).alias("type"), "text", "lang", "source", "doc_id")
    return (
        docs.withColumn("num", F.col("task_id")).withColumn("title", F.concat(F.lit("T/"), "source")).withColumn("next_num", F.when(F.col("doc_id") % 2 == 0, (F.col("doc_id") + 1).cast("string")))
        .withColumn("evidence", F.col("source")).withColumn("yaodian_name", F.concat(F.lit("N"), "task_id")).withColumn("point", F.lit(None).cast("string"))
        .withColumn("sub_item", F.when(F.col("doc_id") % 3 != 0, F.lit("s"))).withColumn("sub_name", F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("S"), "source")))
        .withColumn("label", F.col("source")).withColumn("meta", F.create_map(F.lit("lang"), "lang")).withColumn("missing", F.when((F.col("type") == "evidence") & (F.col("doc_id") % 4 == 0), F.lit("no pages")))
    )


_ROUTES = f"""WITH c AS ({_truncate_sql(20000)}),
x AS (SELECT d.doc_id, {_TYPE} AS type, d.text, cut_text, source FROM documents d JOIN c ON c.doc_id = d.doc_id),
t AS (SELECT *, CASE WHEN doc_id % 3 <> 0 THEN '(S' || source || ')' ELSE '(N' || doc_id || ')' END AS target FROM x)
SELECT CAST(doc_id AS VARCHAR) AS task_id, CASE WHEN type = 'evidence' AND doc_id % 4 = 0 THEN 'error' WHEN type = 'interp' AND length(text) < 20 THEN 'empty' WHEN type = 'table' THEN 'raw' ELSE 'model' END AS route, CASE type WHEN 'interp' THEN 'titles' WHEN 'evidence' THEN 'titled' WHEN 'evidence_sub' THEN 'titled' ELSE 'plain' END AS kind,
md5(CASE type WHEN 'interp' THEN '以下文本取自第' || doc_id || '条（T/' || source || '）至第' || CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id + 1 AS VARCHAR) ELSE '?' END || '条之间。' || chr(10) || '请逐行列出其中全部司法文件的标题及文号，每行以序号开头；没有则只写：{T.NO_TITLES}' || chr(10) || chr(10) || cut_text
WHEN 'table' THEN '' WHEN 'custom' THEN '' ELSE '请从下面的正文中找出与' || target || '有关的段落，将审查规则归纳为连续的文字，不列序号，不收法规索引。' || chr(10) || chr(10) || text END) AS prompt_md5 FROM t"""


@query(_ROUTES)
def q41_routes(spark, d):
    """Route, kind and default prompt by task type."""
    return R.routed(_typed(spark, d), RunConfig()).select("task_id", "route", "kind", F.md5("prompt").alias("prompt_md5"))


_BODIES = f"""WITH t AS (SELECT doc_id, {_TYPE} AS type, text, source FROM documents),
n AS (SELECT *, CASE type WHEN 'interp' THEN '第' || doc_id || '条【' || left({_safe("'T/' || source")}, 50) || '】司法解释' WHEN 'evidence' THEN '证据分析【' || source || '】N' || doc_id || CASE WHEN doc_id % 3 <> 0 THEN '（S' || source || '）' ELSE '' END
WHEN 'evidence_sub' THEN '证据分析【' || source || '】N' || doc_id || CASE WHEN doc_id % 3 <> 0 THEN '（S' || source || '）' ELSE '' END ELSE CAST(doc_id AS VARCHAR) END AS name FROM t)
SELECT CAST(doc_id AS VARCHAR) AS task_id, name || '.md' AS file, CASE WHEN type = 'interp' AND text = '' THEN '{T.TITLE_HEAD}' || chr(10) || '{T.NO_TITLES}' || chr(10) WHEN type = 'interp' THEN '{T.TITLE_HEAD}' || chr(10) || array_to_string(list_transform(string_split(text, chr(10)), lambda y, i: i || '. ' || y || chr(10)), '') WHEN type IN ('evidence', 'evidence_sub') THEN name || '：' || chr(10) || text ELSE text END AS body FROM n"""


@query(_BODIES)
def q42_output_bodies(spark, d):
    """Default file names and the texts of output files: title lists, titled and plain."""
    kind = F.when(F.col("type") == "interp", "titles").when(F.col("type").isin("evidence", "evidence_sub"), "titled").otherwise("plain")
    titles = F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(F.split("text", "\n", -1))
    named = naming.output_names(_typed(spark, d), suffix=R.INTERP_SUFFIX)
    return sinks.with_content(named.withColumn("kind", kind).withColumn("titles", titles).withColumn("content", F.col("text"))).select("task_id", "file", "body")


@query(f"SELECT event_id, printf('%.1f', event_id % 160 * 0.0625) AS one_digit, {_US} // 1000 AS key_ms, CASE WHEN event_type = 'error' THEN '严重' ELSE '警告' END AS level, CASE WHEN event_type = 'error' THEN 'red' ELSE 'orange' END AS colour FROM events")
def q43_figures(spark, d):
    """Numbers with one digit (ties to even), keys from times, and levels of alerts."""
    critical = F.col("event_type") == "error"
    return _events(spark, d).select("event_id", N.one_decimal(F.col("event_id") % 160 * 0.0625).alias("one_digit"), N.epoch_key(F.timestamp_micros("us")).alias("key_ms"), N.alert_level(critical).alias("level"), N.alert_colour(critical).alias("colour"))


@query(f"WITH {_PAGES} SELECT pdf_id AS grp, coalesce(string_agg(nullif(text, ''), chr(10) ORDER BY page_no), '') AS text FROM pages WHERE page_no BETWEEN 2 AND 30 GROUP BY pdf_id")
def q44_group_text(spark, d):
    """Each group's pages put together once."""
    pages = _pages(spark, d).drop("doc_id")
    ranges = pages.where("page_no >= 2").select("pdf_id").distinct().select("pdf_id", F.col("pdf_id").alias("grp"), F.lit(2).alias("start_page"), F.lit(30).alias("end_page"))
    return P.group_text(ranges, pages)


@query(f"WITH {_PROGRESS}, fresh AS (SELECT CAST(doc_id AS VARCHAR) AS task_id FROM documents WHERE lang = 'de') SELECT coalesce(f.task_id, p.task_id) AS task_id, CASE WHEN f.task_id IS NOT NULL THEN 'success' ELSE p.status END AS status FROM progress p FULL JOIN fresh f ON p.task_id = f.task_id")
def q45_progress_versions(spark, d):
    """Progress is saved, loaded, put together with new results, saved as a new version and loaded again."""
    place = scratch(spark, "progress")
    progress_source.save(_progress(spark, d).withColumn("updated", F.lit(None).cast("timestamp")), place)
    fresh = _t(spark, d, "documents").where("lang = 'de'").select(F.col("doc_id").cast("string").alias("task_id"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(1.0).alias("elapsed"), F.lit(None).cast("timestamp").alias("updated"))
    progress_source.save(resume.upsert(progress_source.load(spark, place), fresh), place)
    return progress_source.load(spark, place).select("task_id", "status")


@query("SELECT doc_id, md5(text) AS joined_md5, true AS fits FROM documents")
def q46_chunks(spark, d):
    """Whole texts in pieces of at most 3,000 characters: the pieces make the text again.

    A null or empty text has no piece, so none that is too long.
    """
    cut = _t(spark, d, "documents").select("doc_id", T.text_chunks("text", 3000).alias("c"))
    fits = F.coalesce(F.forall("c", lambda x: F.length(x) <= 3000), F.lit(True))
    return cut.select("doc_id", F.md5(F.array_join("c", "")).alias("joined_md5"), fits.alias("fits"))
