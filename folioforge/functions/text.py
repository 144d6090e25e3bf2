"""Text functions on columns, with exact Python text semantics.

Everything is a Catalyst expression: no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values --------------------------------------------------------------
#: Cut points of truncation, in order of priority.
SEPARATORS = ("\n\n", "\n", "。", "；", "！", "？", ".", "!", "?")
#: A cut point is searched for in so many characters before the limit.
SEARCH_WINDOW = 500
#: Lines that are not titles.
NOISE = ("该条文暂无相关的司法解释", "待处理文本", "【输出格式", "【任务")
LEAST_TITLE = 6
LAW_FIELD = "法律依据"
OTHER_FIELDS = ("要点", "定性", "处理")
TITLE_HEAD = "司法解释目录："
NO_TITLES = "该条文暂无相关的司法解释。"
# ---------------------------------------------------------------------------

_SPACE = r"[\s\x1c-\x1f]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python's ``str.strip()``: all Unicode white space at both ends."""
    return F.regexp_replace(_col(c), rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def smart_truncate(c: Column | str, limit: int) -> Column:
    """At most ``limit`` characters, cut after the best separator near the limit.

    The first separator of ``SEPARATORS`` that occurs in the last
    ``SEARCH_WINDOW`` characters before the limit decides, at its last
    occurrence; without one the cut is hard.
    """
    text = _col(c)
    size = F.length(text)
    start = F.lit(limit - SEARCH_WINDOW) if limit >= SEARCH_WINDOW else F.greatest(F.lit(0), size + (limit - SEARCH_WINDOW))
    window = F.substring(text, start + 1, F.greatest(F.lit(0), F.lit(limit) - start)) if limit < SEARCH_WINDOW else F.substring(text, limit - SEARCH_WINDOW + 1, SEARCH_WINDOW)
    backwards = F.reverse(window)

    def cut_after(separator: str) -> Column:
        at = F.locate(separator[::-1], backwards)
        return F.when(at > 0, start + F.length(window) - at + 1)

    end = F.coalesce(*[cut_after(s) for s in SEPARATORS], F.lit(limit))
    return F.when(size <= limit, text).otherwise(F.left(text, end))


def text_chunks(c: Column | str, limit: int) -> Column:
    """The whole text in pieces of at most ``limit`` characters, each cut like ``smart_truncate``; no pieces of an empty text, null of null."""
    text = _col(c)
    least = max(1, limit - SEARCH_WINDOW)  # a piece is no shorter, unless the limit is below the window
    begin = F.struct(text.alias("rest"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, _: Column) -> Column:
        piece = smart_truncate(s["rest"], limit)
        return F.when(s["rest"] == "", s).otherwise(F.struct(F.substring(s["rest"], F.length(piece) + 1, F.length(s["rest"])).alias("rest"), F.concat(s["out"], F.array(piece)).alias("out")))

    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.length(text) / least).cast("int")))
    return F.when(text.isNotNull(), F.aggregate(steps, begin, step, lambda s: s["out"]))


def fill(template: Column | str, *pairs: tuple[str, Column]) -> Column:
    """Literal, sequential replacement of ``{name}``; later pairs see what earlier ones inserted."""
    return reduce(lambda t, p: F.replace(t, F.lit("{" + p[0] + "}"), F.coalesce(p[1], F.lit(""))), pairs, _col(template))


def fill_from_map(template: Column | str, values: Column | str) -> Column:
    """``fill`` with every entry of a string map, in the map's order."""
    return F.aggregate(F.map_entries(_col(values)), _col(template), lambda t, e: F.replace(t, F.concat(F.lit("{"), e["key"], F.lit("}")), F.coalesce(e["value"], F.lit(""))))


def trim_brackets(c: Column | str) -> Column:
    """Strip, then leading ``[`` and trailing ``]``."""
    return F.rtrim(F.ltrim(strip(c), F.lit("[")), F.lit("]"))


def strip_enumeration(c: Column | str) -> Column:
    """Drop a leading Chinese number in full-width brackets."""
    return strip(F.regexp_replace(_col(c), r"\A（[一二三四五六七八九十]+）", ""))


def safe_name(c: Column | str, most: int | None = None) -> Column:
    """Delete the characters that file names may not hold."""
    out = F.regexp_replace(_col(c), r"""[\\/:*?"<>|]""", "")
    return F.left(out, F.lit(most)) if most else out


def parse_titles(c: Column | str) -> Column:
    """Array of the titles in a model's answer: numbering and noise removed, first occurrences kept."""
    lines = F.filter(F.transform(F.split(_col(c), "\n", -1), strip), lambda x: x != "")

    def bare(line: Column) -> Column:
        # (?d) lets a dot stand for anything but \n, (?U) gives Unicode digits and blanks.
        found = F.regexp_extract(line, r"(?Ud)\A\s*\d+[.　、]\s*(.+)", 1)
        return F.when(found != "", strip(found)).otherwise(line)

    wanted = lambda x: reduce(lambda a, n: a & ~F.contains(x, F.lit(n)), NOISE, F.length(x) >= LEAST_TITLE)
    return F.array_distinct(F.filter(F.transform(lines, bare), wanted))


def title_list(titles: Column | str) -> Column:
    """Numbered text of a title array, or the fixed line for none."""
    t = _col(titles)
    rows = F.transform(t, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x, F.lit("\n")))
    return F.concat(F.lit(TITLE_HEAD + "\n"), F.when(F.size(t) > 0, F.array_join(rows, "")).otherwise(F.lit(NO_TITLES + "\n")))


def split_before_brackets(c: Column | str) -> Column:
    """Stripped parts of a text that is split before every ``【``."""
    return F.transform(F.split(_col(c), "(?=【)", -1), strip)


def split_by_brackets(c: Column | str) -> Column:
    """The parts of a text that start with ``【``."""
    return F.filter(split_before_brackets(c), lambda x: F.startswith(x, F.lit("【")))


def format_output(c: Column | str) -> Column:
    """Lay out an answer: fields set apart, legal bases one to a line, one line end at the end."""
    lines = F.filter(F.transform(F.split(strip(c), "\n", -1), strip), lambda x: x != "")
    heads = "|".join((LAW_FIELD, *OTHER_FIELDS))
    # Each section begins with a field's line; lines before the first field are one as well.
    sections = F.split(F.array_join(lines, "\n"), rf"\n(?=(?:{heads})[：:])", -1)

    def laid(section: Column) -> Column:
        own = F.split(section, "\n", -1)
        pieces = lambda x: F.filter(split_before_brackets(x), lambda p: p != "")
        rest = lambda x, i: F.when(i == 0, F.regexp_replace(x, rf"(?U)\A{LAW_FIELD}[：:]\s*", "")).otherwise(x)
        law = F.concat(F.array(F.lit(""), F.lit(LAW_FIELD + "：")), F.flatten(F.transform(F.transform(own, rest), pieces)))
        return F.when(F.regexp_like(section, F.lit(rf"\A{LAW_FIELD}[：:]")), law).when(F.regexp_like(section, F.lit(rf"\A(?:{heads})[：:]")), F.concat(F.array(F.lit("")), own)).otherwise(own)

    text = F.array_join(F.flatten(F.transform(sections, laid)), "\n")
    return F.when(F.size(lines) == 0, F.lit("")).otherwise(F.concat(strip(text), F.lit("\n")))


def markdown_table(rows: Column | str, join_lines: bool = False) -> Column:
    """Markdown of an ``array<array<string>>``; null cells are empty.

    The two characters backslash and n become a blank; real line ends stay
    unless ``join_lines``.
    """

    def cell(x: Column) -> Column:
        plain = F.replace(F.coalesce(x, F.lit("")), F.lit("\\n"), F.lit(" "))
        return F.replace(plain, F.lit("\n"), F.lit(" ")) if join_lines else plain

    def line(row: Column, i: Column) -> Column:
        text = F.concat(F.lit("| "), F.array_join(F.transform(row, cell), " | "), F.lit(" |"))
        rule = F.concat(F.lit("|"), F.array_join(F.transform(row, lambda _: F.lit("---")), "|"), F.lit("|"))
        return F.when(i == 0, F.concat(text, F.lit("\n"), rule)).otherwise(text)

    return F.array_join(F.transform(_col(rows), line), "\n")


def first_filled(*columns: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in columns])


def text_of_map(values: Column | str) -> Column:
    """``text``, else ``raw``, else ``content``, by presence of the key; else empty."""
    m = _col(values)
    out = F.lit("")
    for key in ("content", "raw", "text"):
        out = F.when(F.map_contains_key(m, key), F.element_at(m, key)).otherwise(out)
    return F.coalesce(out, F.lit(""))


def file_stem(c: Column | str) -> Column:
    """Base name of a path without its last extension."""
    return F.regexp_replace(base_name(c), r"(?<=.)\.[^.]*\z", "")


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(_col(c), "/", -1), -1)


def extension(c: Column | str) -> Column:
    return F.regexp_extract(base_name(c), r"(?<=.)(\.[^.]*)\z", 1)
