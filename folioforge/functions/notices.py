"""Notification texts, colours and cards, as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip

# Fixed values --------------------------------------------------------------
CHINESE_ACTIONS = (("确认", "confirm"), ("重试", "retry"), ("取消", "cancel"), ("暂停", "pause"), ("继续", "resume"))
ENGLISH_ACTIONS = ("confirm", "retry", "cancel", "pause", "resume")
BAR_CELLS = 20
# ---------------------------------------------------------------------------


def classify(text: Column, chinese: bool = True) -> Column:
    """The first action whose word the text holds, else ``custom``."""
    pairs = CHINESE_ACTIONS if chinese else tuple((a, a) for a in ENGLISH_ACTIONS)
    where = text if chinese else F.lower(text)
    out = F.lit("custom")
    for word, action in reversed(pairs):
        out = F.when(F.contains(where, F.lit(word)), F.lit(action)).otherwise(out)
    return out


def message_text(content: Column) -> Column:
    """Stripped ``text`` field of a JSON message body."""
    return strip(F.coalesce(F.get_json_object(content, "$.text"), F.lit("")))


def action_or_default(action: Column) -> Column:
    return F.coalesce(action, F.lit("confirm"))


def label_or_action(label: Column, action: Column) -> Column:
    return F.coalesce(label, action_or_default(action))


def button_style(action: Column) -> Column:
    return F.when(action == "confirm", "primary").when(action == "cancel", "danger").otherwise("default")


def percent(current: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(current / total * 100)


def one_decimal(x: Column) -> Column:
    """Python's ``.1f``: ties go to the even digit."""
    return F.format_string("%.1f", F.bround(x.cast("double"), 1))


def bar(current: Column, total: Column) -> Column:
    filled = F.when(total == 0, F.lit(0)).otherwise(F.floor(current / total * 100 / (100 / BAR_CELLS))).cast("int")
    return F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(BAR_CELLS) - filled))


def eta_text(minutes: Column) -> Column:
    return F.when(minutes.isNull() | (minutes == 0), F.lit("计算中...")).otherwise(F.concat(F.lit("约"), F.format_string("%.0f", F.bround(minutes.cast("double"), 0)), F.lit("分钟")))


def completion_colour(failed: Column, total: Column) -> Column:
    return F.when(failed == 0, "green").when(failed < total * 0.1, "orange").otherwise("red")


def alert_colour(critical: Column) -> Column:
    return F.when(critical, "red").otherwise("orange")


def alert_level(critical: Column) -> Column:
    return F.when(critical, "严重").otherwise("警告")


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def epoch_key(ts: Column) -> Column:
    """Milliseconds since the epoch."""
    return F.unix_millis(ts)


def _line(*parts: Column | str) -> Column:
    body = F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.struct(F.lit("markdown").alias("tag"), body.alias("content"))


def card(title: Column, colour: Column, *lines: Column) -> Column:
    """JSON of a card: header with colour, then one element a line (null lines are left out)."""
    header = F.struct(F.struct(F.lit("plain_text").alias("tag"), title.alias("content")).alias("title"), colour.alias("template"))
    elements = F.filter(F.array(*lines), lambda x: x["content"].isNotNull())
    return F.to_json(F.struct(F.struct(F.lit(True).alias("wide_screen_mode")).alias("config"), header.alias("header"), elements.alias("elements")))


def start_card(name: Column, total: Column, note: Column, ts: Column) -> Column:
    return card(F.concat(F.lit("任务开始 - "), name), F.lit("blue"), _line("**任务** ", name), _line("**时间** ", clock_text(ts)), _line("**总数** ", total), _line("**说明** ", F.coalesce(F.nullif(note, F.lit("")), F.lit("无"))))


def progress_card(name: Column, current: Column, total: Column, success: Column, failed: Column, skipped: Column, elapsed_min: Column, eta_min: Column, item: Column) -> Column:
    return card(
        F.concat(F.lit("进度报告 - "), name),
        F.lit("blue"),
        _line(bar(current, total), " ", one_decimal(percent(current, total)), "%"),
        _line("**完成** ", current, "/", total, " **成功** ", success, " **失败** ", failed, " **跳过** ", skipped),
        _line("**耗时** ", one_decimal(elapsed_min), "分钟 **剩余** ", eta_text(eta_min)),
        _line("**当前** ", F.coalesce(F.nullif(item, F.lit("")), F.lit("-"))),
    )


def error_card(name: Column, item: Column, error: Column, critical: Column, consecutive: Column) -> Column:
    streak = F.when(consecutive > 1, F.concat(F.lit("**连续失败** "), consecutive.cast("string"), F.lit("次")))
    return card(F.concat(F.lit("异常告警 - "), name), alert_colour(critical), _line("**级别** ", alert_level(critical)), _line("**任务项** ", item), _line("**错误** ", F.left(error, F.lit(200))), _line(streak))


def complete_card(name: Column, total: Column, success: Column, failed: Column, skipped: Column, elapsed_min: Column, path: Column | None = None, extra: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    where = F.concat(F.lit("**输出** "), F.nullif(path, F.lit(""))) if path is not None else none
    return card(
        F.concat(F.lit("任务完成 - "), name),
        completion_colour(failed, total),
        _line("**任务** ", name),
        _line("**总计** ", total, " **成功** ", success, " **失败** ", failed, " **跳过** ", skipped),
        _line("**耗时** ", one_decimal(elapsed_min), "分钟"),
        _line(where),
        _line(F.nullif(extra, F.lit("")) if extra is not None else none),
    )


def buttons(actions: list[tuple[str, str]]) -> Column:
    """Array of button structs from (label, action) pairs."""
    return F.array(*[F.struct(F.lit("button").alias("tag"), F.lit(label).alias("text"), button_style(F.lit(action)).alias("type"), F.struct(F.lit(action).alias("action"), F.lit(label).alias("label")).alias("value")) for label, action in actions])
