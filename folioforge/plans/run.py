"""The run: tasks, resume, page text, prompts, model, answers, outputs, progress.

Everything up to the model call is one lazy plan, which is written down once;
answers are written piece by piece, and files, progress and figures derive from
these tables.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import naming, notices as N, text as T
from ..operators import model_map, pages as P, resume, rollup
from ..sources import config as C, progress, sinks, tasks as S

# Fixed values --------------------------------------------------------------
SHORT_TEXT = 20
INTERP_SUFFIX = "司法解释"
#: The prompts of a run are answered in so many pieces at most, with a progress notice between two.
MOST_PIECES = 20
# ---------------------------------------------------------------------------


def interp_prompt(text: Column) -> Column:
    """Own wording of the default prompt for title lists."""
    head = F.concat(F.lit("以下文本取自第"), F.col("num"), F.lit("条（"), F.coalesce("title", F.lit("")), F.lit("）至第"), F.coalesce(F.nullif("next_num", F.lit("")), F.lit("?")), F.lit("条之间。\n"))
    return F.concat(head, F.lit(f"请逐行列出其中全部司法文件的标题及文号，每行以序号开头；没有则只写：{T.NO_TITLES}\n\n"), text)


def evidence_prompt(target: Column, text: Column) -> Column:
    """Own wording of the default prompt for review rules."""
    return F.concat(F.lit("请从下面的正文中找出与"), target, F.lit("有关的段落，将审查规则归纳为连续的文字，不列序号，不收法规索引。\n\n"), text)


def with_text(tasks: DataFrame, pages: DataFrame, page_tables: DataFrame | None, ranges: DataFrame, pdf_id: str) -> DataFrame:
    """Adds ``text`` and ``missing`` (an error) by task type."""
    first = F.when(F.size("pages") > 0, F.element_at("pages", 1))
    last = F.when(F.size("pages") > 0, F.element_at("pages", -1))
    spans = tasks.select("task_id", F.lit(pdf_id).alias("pdf_id"), "type", F.coalesce("start_page", first).alias("a"), F.coalesce("end_page", last).alias("b"))
    own = P.range_text(spans.where(F.col("type").isin("interp", "custom") & F.col("a").isNotNull()), pages, ["task_id"], "a", "b").select("task_id", F.col("text").alias("_own"))
    tables = P.range_tables(spans.where((F.col("type") == "table") & F.col("a").isNotNull()), page_tables, ["task_id"], "a", "b").select("task_id", F.col("text").alias("_drawn")) if page_tables is not None else None
    chapters = P.group_text(ranges.withColumn("pdf_id", F.lit(pdf_id)), pages).select(F.col("grp").alias("_g"), F.col("text").alias("_chapter"))
    out = tasks.join(own, "task_id", "left")
    out = out.join(tables, "task_id", "left") if tables is not None else out.withColumn("_drawn", F.lit(None).cast("string"))
    group = T.first_filled("grp", "evidence")
    out = out.withColumn("_group", group).join(chapters, F.col("_group") == F.col("_g"), "left")
    evidence, fact = F.col("type").isin("evidence", "evidence_sub"), F.col("type") == "json_dict"
    in_range = F.col("_g").isNotNull()
    text = (
        F.when(F.col("type").isin("interp", "custom"), F.coalesce("_own", F.lit("")))
        .when(F.col("type") == "table", F.coalesce("_drawn", F.lit("")))
        .when(evidence | (fact & in_range), F.coalesce("_chapter", F.lit("")))
        .when(fact, T.text_of_map("meta"))
        .when(F.col("type") == "json_list", F.coalesce(F.element_at("meta", "raw"), F.lit("")))
    )
    missing = F.when((evidence | (fact & in_range)) & (F.coalesce("_chapter", F.lit("")) == ""), F.concat(F.lit("no pages for group "), F.coalesce("_group", F.lit(""))))
    return out.withColumn("text", text).withColumn("missing", missing).drop("_own", "_drawn", "_group", "_g", "_chapter")


def routed(tasks: DataFrame, run: C.RunConfig) -> DataFrame:
    """Adds route (model, empty, raw, error), prompt and kind of output."""
    fact_text = (F.col("type") == "json_dict") & (F.col("text") != "")
    ruled = F.col("type").isin("evidence", "evidence_sub") | fact_text
    route = (
        F.when(F.col("missing").isNotNull(), "error")
        .when((F.col("type") == "interp") & (F.length("text") < SHORT_TEXT), "empty")
        .when((F.col("type") == "table") & F.lit(not run.system and not run.template), "raw")
        .otherwise("model")
    )
    short = T.smart_truncate("text", run.chunk_size)
    field = lambda c: F.coalesce(F.element_at("meta", c), F.lit(""))
    template = F.lit(run.template)
    has_sub = F.coalesce(F.col("sub_item"), F.lit("")) != ""
    bracketed = F.concat(F.lit("("), F.coalesce("sub_name", F.lit("")), F.lit(")"))
    name = F.coalesce("yaodian_name", F.lit(""))
    if run.template:
        interp = T.fill(template, ("text", short), ("num", F.col("num")), ("title", F.col("title")))
        rule = T.fill(template, ("text", F.col("text")), ("label", F.when(has_sub, bracketed).otherwise(name)), ("evidence", F.coalesce("evidence", F.lit(""))), ("point", F.coalesce("point", name)), ("nature", field("nature")), ("treatment", field("treatment")))
    else:
        interp = interp_prompt(short)
        rule = evidence_prompt(F.when(has_sub, bracketed).otherwise(F.concat(F.lit("("), name, F.lit(")"))), F.col("text"))
    prompt = (
        F.when(F.col("type") == "interp", interp)
        .when(ruled, rule)
        .when(F.col("type") == "custom", T.fill(template, ("text", short), ("label", F.col("label"))))
        .when(F.col("type").isin("table", "json_list"), T.fill(template, ("text", F.col("text")), ("label", F.col("label"))))
        .when(F.col("type") == "json_dict", T.fill_from_map(template, "meta"))
        .otherwise(T.fill(template, ("label", F.col("label"))))
    )
    kind = F.when(F.col("type") == "interp", "titles").when(ruled, "titled").otherwise("plain")
    return tasks.withColumn("route", route).withColumn("prompt", prompt).withColumn("kind", kind)


def named(tasks: DataFrame, run: C.RunConfig, taken: DataFrame | None = None) -> DataFrame:
    """Adds file and title_line; plain outputs go by their id.  ``taken`` holds the file names of other tasks."""
    out = naming.output_names(tasks, run.filename_pattern, run.title_prefix, INTERP_SUFFIX)
    empty = F.concat(F.lit("第"), F.coalesce("num", F.lit("")), F.lit("条【"), T.safe_name(F.coalesce("title", F.lit("")), naming.TITLE_MOST), F.lit(f"】{INTERP_SUFFIX}.md"))
    plain = F.concat(T.safe_name("task_id", naming.NAME_MOST), F.lit(".md"))
    out = out.withColumn("file", F.when(F.col("route") == "empty", empty).when(F.col("kind") == "plain", plain).otherwise(F.col("file")))
    return naming.unique_names(out, taken=taken)


def answered(routes: DataFrame, answers: DataFrame) -> DataFrame:
    """Results of all routes: status, content, titles, error."""
    joined = routes.join(answers.select("task_id", "success", F.col("content").alias("_answer"), F.col("error").alias("_error"), "attempts", "elapsed"), "task_id", "left")
    content = F.when(F.col("route") == "raw", F.col("text")).when(F.col("kind") == "titled", T.format_output("_answer")).when(F.col("route") == "empty", F.lit("")).otherwise(F.col("_answer"))
    titles = F.when(F.col("kind") == "titles", F.when(F.col("route") == "model", T.parse_titles("_answer")).otherwise(F.array().cast("array<string>")))
    ok = F.col("route").isin("empty", "raw") | F.coalesce("success", F.lit(False))
    error = F.when(~ok, F.left(F.coalesce("missing", "_error", F.lit("no answer")), F.lit(model_map.ERROR_MOST)))
    return joined.withColumn("content", content).withColumn("titles", titles).withColumn("status", F.when(ok, "success").otherwise("failed")).withColumn("error", error).drop("_answer", "_error")


@dataclass
class Inputs:
    """Tables that a run reads."""

    pages: DataFrame
    page_tables: DataFrame | None = None
    pdf_id: str = ""


def plan(spark: SparkSession, cfg: C.Config, inputs: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all tasks, tasks to do with route, prompt and names, progress so far)."""
    tasks = S.read_tasks(spark, cfg.data_source, cfg.data_path, cfg.task_list)
    done = progress.load(spark, cfg.run.progress_path)
    todo = resume.pending(tasks, done, cfg.run.resume, cfg.run.retry_failed)
    texts = with_text(todo, inputs.pages, inputs.page_tables, P.ranges_table(spark, cfg.page_ranges), inputs.pdf_id)
    # Tasks that are not done again keep the files that they have.
    taken = None
    if cfg.run.output_dir:
        taken = sinks.load_outputs(spark, _outputs_at(cfg)).join(todo.select("task_id"), "task_id", "left_anti").select("file")
    return tasks, named(routed(texts, cfg.run), cfg.run, taken), done


def _outputs_at(cfg: C.Config) -> str:
    return f"{cfg.run.output_dir or '.'}/outputs.parquet"


def _answers(prompts: DataFrame, folder: str, call, pieces: int, report) -> DataFrame:
    """Answers of all prompts, written piece by piece; ``report(counts)`` after each piece but the last.

    What is written is never asked again: a lost executor repeats calls of its own piece only.
    """
    spark, places = prompts.sparkSession, []
    piece = F.pmod(F.xxhash64("task_id"), F.lit(pieces))
    for i in range(pieces):
        places.append(f"{folder}/{i}")
        call(prompts.where(piece == i)).write.parquet(places[-1])
        if i < pieces - 1:
            report(spark.read.schema(model_map.RESULT).parquet(*places).agg(F.count_if("success").alias("success"), F.count_if(~F.col("success")).alias("failed"), F.max("task_id").alias("item")).first())
    return spark.read.schema(model_map.RESULT).parquet(*places)


def listing(tasks: DataFrame) -> Iterator[tuple[str | None, str]]:
    """(heading, label) of the tasks in order, a partition at a time; see ``rollup.dry_run`` for lists by key."""
    before = None
    for r in tasks.select("ord", "grp", "label").orderBy("ord").toLocalIterator():
        group = r["grp"] or None
        yield (group if group and group != before else None), r["label"]
        before = group or before


def run(spark: SparkSession, cfg: C.Config, inputs: Inputs, backend: model_map.Backend | None = None, notifier: sinks.Notifier | None = None, dry_run: bool = False) -> dict:
    """Run a configuration; the summary as a dict (or counts and labels of a dry run)."""
    tasks, routes, done = plan(spark, cfg, inputs)
    if dry_run:
        return {"total": tasks.count(), "dry_run": True, "labels": list(listing(tasks))}
    began, folder = time.time(), cfg.run.output_dir or "."
    stamp = f"{time.time_ns()}"
    counts = resume.initial_counts(tasks, done, cfg.run.resume).first()
    name = F.lit(cfg.run.name)
    if notifier and cfg.run.notify:
        sinks.send_all(spark.range(1).select(N.start_card(name, F.lit(counts["total"]), F.lit(""), F.current_timestamp()).alias("card")), notifier)
    # Routes and answers are written down once and everything else derives from these tables.
    routes_at = f"{folder}/_routes/{stamp}"
    routes.write.parquet(routes_at)
    routes = spark.read.schema(routes.schema).parquet(routes_at)
    # Only prompts of the model route reach the backend: a Python stage would run for every row otherwise.
    prompts = routes.where("route = 'model'").select("task_id", "prompt")
    asked, noticed = prompts.count(), [0.0]
    pieces = max(1, min(MOST_PIECES, asked // max(1, cfg.run.notify_tasks)))

    def report(counts) -> None:
        current, minutes = counts["success"] + counts["failed"], (time.time() - began) / 60
        every = asked // pieces >= cfg.run.notify_tasks
        if not (notifier and cfg.run.notify) or not (every or time.time() - noticed[0] >= cfg.run.notify_seconds):
            return
        noticed[0] = time.time()
        left = F.lit(minutes / current * (asked - current)) if current else F.lit(None).cast("double")
        card = N.progress_card(name, F.lit(current), F.lit(asked), F.lit(counts["success"]), F.lit(counts["failed"]), F.lit(0), F.lit(minutes), left, F.lit(counts["item"]))
        sinks.send_all(spark.range(1).select(card.alias("card")), notifier)

    call = lambda some: model_map.call_model(some, backend or model_map.HttpBackend(cfg.api), cfg.api, cfg.run.max_workers, cfg.run.system)
    answers = _answers(prompts, f"{folder}/_answers/{stamp}", call, pieces, report)
    results_at = f"{folder}/_results/{stamp}"
    columns = ["task_id", "ord", "status", "error", "elapsed", "file", "title_line", "kind", "content", "titles"]
    answered(routes, answers).select(columns).write.parquet(results_at)
    results = spark.read.parquet(results_at)
    good = sinks.with_content(results.where("status = 'success'"))
    sinks.write_outputs(good, _outputs_at(cfg))
    if cfg.run.output_dir:
        sinks.export_markdown(good, folder).count()
    if cfg.run.progress_path:
        fresh = results.select("task_id", "status", "error", "elapsed", F.current_timestamp().alias("updated"))
        progress.save(resume.upsert(done, fresh), cfg.run.progress_path)
    minutes = (time.time() - began) / 60
    out = rollup.summary(results, minutes).first().asDict()
    out["resumed"] = counts["resumed"]
    if notifier and cfg.run.notify:
        card = N.complete_card(name, F.lit(out["total"]), F.lit(out["success"]), F.lit(out["failed"]), F.lit(out["skipped"]), F.lit(minutes), F.lit(folder))
        sinks.send_all(spark.range(1).select(card.alias("card")), notifier)
    return out


def _main(raw: dict, argv: list[str], mock: bool) -> int:
    from ..sources import pages

    parser = argparse.ArgumentParser()
    parser.add_argument("--dry-run", action="store_true")
    parser.add_argument("--retry-failed", action="store_true")
    parser.add_argument("--pages", help="table of pages, or a PDF file")
    parser.add_argument("--page-tables", help="table of the tables on the pages; a PDF file is read for them as well")
    args = parser.parse_args(argv)
    cfg = C.parse(raw)
    if args.retry_failed:
        cfg = reduce(lambda c, _: type(c)(**{**c.__dict__, "run": type(c.run)(**{**c.run.__dict__, "retry_failed": True})}), [0], cfg)
    spark = SparkSession.builder.getOrCreate()
    source = args.pages or cfg.pdf_path
    book = cfg.pdf_path or source
    drawn = args.page_tables or (None if source.endswith((".parquet", ".json", ".jsonl")) else source)
    inputs = Inputs(pages.read_pages(spark, source, book), pages.read_tables(spark, drawn, book) if drawn else None, book)
    result = run(spark, cfg, inputs, model_map.MockBackend() if mock else None, dry_run=args.dry_run)
    print(json.dumps(result, ensure_ascii=False, default=str))
    return 1 if result.get("failed") else 0


def main(argv: list[str] | None = None) -> int:
    """``python -m folioforge.plans.run CONFIG [--dry-run] [--retry-failed] [--pages TABLE]``."""
    argv = sys.argv[1:] if argv is None else argv
    with open(argv[0], encoding="utf-8") as f:
        return _main(json.load(f), argv[1:], mock=False)


def main_base64(config: str) -> int:
    return _main(C.from_base64(config), sys.argv[1:], mock=False)


if __name__ == "__main__":
    sys.exit(main())
