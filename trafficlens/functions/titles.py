"""Title cleaning and line parsing as Column expressions.

Every function returns a Column, so the whole rule set compiles into the
scan's whole-stage-codegen span; no Python runs per row.

Regex notes: Java ``.`` stops at more line terminators than Python's; the
``(?d)`` flag (UNIX_LINES) restores the Python meaning (only ``\\n``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source behaviour (do not edit).
# Line shape: project "en", then page, count, bytes; prefix match, greedy.
LINE_PATTERN = "^en (.*) ([0-9].*) ([0-9].*)"
# Titles outside the main namespace start with one of these names and ":".
EXCLUDED_NAMESPACES = (
    "Media", "Special", "Talk", "User", "User_talk", "Project", "Project_talk",
    "File", "File_talk", "MediaWiki", "MediaWiki_talk", "Template",
    "Template_talk", "Help", "Help_talk", "Category", "Category_talk",
    "Portal", "Wikipedia", "Wikipedia_talk",
)
# Image / file suffixes; the source pattern leaves the dot unescaped.
FILE_EXTENSIONS = ("jpg", "gif", "png", "JPG", "GIF", "PNG", "txt", "ico")
# Exact titles that are never counted.
BLACKLIST = ("404_error/", "Main_Page", "Hypertext_Transfer_Protocol",
             "Favicon.ico", "Search")
# ---------------------------------------------------------------------------

_UNIX = "(?d)"
# The characters of Java's \s class (also Python's str.strip() set for bytes).
WHITESPACE = " \t\n\r\f\x0b"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def namespace_pattern(namespaces: Sequence[str] = EXCLUDED_NAMESPACES) -> str:
    return "^(" + "|".join(namespaces) + "):"


def extension_pattern(strict: bool = False,
                      extensions: Sequence[str] = FILE_EXTENSIONS) -> str:
    alt = "|".join(extensions)
    # Source rule: any char, then any char, then a suffix -> a substring match
    # starting at position >= 1 (so "Mexico" is dropped). strict: a real suffix.
    return f"\\.({alt})$" if strict else f"^.*.({alt})"


# F1 -------------------------------------------------------------------------
def line_shape(line) -> Column:
    """True when the raw line has the `en page count bytes` shape."""
    return _c(line).rlike(_UNIX + LINE_PATTERN)


def line_group(line, i: int) -> Column:
    return F.regexp_extract(_c(line), _UNIX + LINE_PATTERN, i)


# F2 / F3 --------------------------------------------------------------------
def project_is(project, code: str = "en") -> Column:
    return _c(project) == F.lit(code)


def keyword_in_line(line, keyword: str) -> Column:
    """Case-insensitive substring test over the whole line."""
    return F.lower(_c(line)).contains(keyword.lower())


# F4-F8 ----------------------------------------------------------------------
def in_excluded_namespace(title, namespaces: Sequence[str] = EXCLUDED_NAMESPACES) -> Column:
    """Starts with NAME + ':' (NAME in the list). Names hold no ':', so this is
    exactly: there is a ':' and the text before the first one is a NAME."""
    t = _c(title)
    return t.contains(":") & F.substring_index(t, ":", 1).isin(list(namespaces))


def starts_lowercase(title) -> Column:
    """First character in [a-z] (a one-character string compare)."""
    first = F.substring(_c(title), 1, 1)
    return (first >= F.lit("a")) & (first <= F.lit("z"))


def looks_like_file(title, strict: bool = False,
                    extensions: Sequence[str] = FILE_EXTENSIONS) -> Column:
    t = _c(title)
    if strict:
        return t.rlike(extension_pattern(True, extensions))
    # The source rule (any char, any char, suffix; '.' stops at a newline) is
    # exactly: a suffix occurs at position >= 2 of the first line. A plain
    # alternation search does that without backtracking.
    first_line = F.substring_index(t, "\n", 1)
    return F.substring(first_line, 2, 1 << 30).rlike("(" + "|".join(extensions) + ")")


def has_space(title) -> Column:
    return _c(title).contains(" ")


def blacklisted(title, blacklist: Sequence[str] = BLACKLIST) -> Column:
    return _c(title).isin(list(blacklist))


def exclude_titles(df: DataFrame, exclusions: DataFrame, title: str = "title", excluded: str = "title",
                   broadcast_bytes: int = 8 << 20) -> DataFrame:
    """F8 with a list of any length: the rows whose title is not among the
    ``excluded`` ones (rows without a title stay). The list is broadcast where
    its distinct titles are measured to be small; else both sides meet by a
    shuffle, in which a frequent title of ``df`` may be split."""
    names = exclusions.select(F.col(excluded).alias("_x")).where("_x is not null").distinct()
    rows, size = names.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_x")), F.lit(0))).first()
    if size + 32 * rows <= broadcast_bytes:
        names = F.broadcast(names)
    return df.join(names, F.col(title) == F.col("_x"), "left_anti")


def is_valid_title(title, strict_ext: bool = False,
                   blacklist: Sequence[str] = BLACKLIST,
                   namespaces: Sequence[str] = EXCLUDED_NAMESPACES) -> Column:
    """F4..F8 on the *undecoded* title, as one predicate."""
    t = _c(title)
    return ~(in_excluded_namespace(t, namespaces) | starts_lowercase(t)
             | looks_like_file(t, strict_ext) | has_space(t)
             | blacklisted(t, blacklist))


# X1 / X2 / F10 ----------------------------------------------------------------
def url_decode_plus(s) -> Column:
    """Lenient unquote_plus: '+' -> ' ', %XX decoded as UTF-8, a '%' that is
    not followed by two hex digits is kept literally. Text without '%' or
    '+' is returned as is (the decoder would not change it)."""
    c = _c(s)
    escaped = F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(c.contains("%") | c.contains("+"), F.try_url_decode(escaped)).otherwise(c)


def cut_anchor(s) -> Column:
    """Text before the first '#'."""
    return F.substring_index(_c(s), "#", 1)


def clean_title(page) -> Column:
    return cut_anchor(url_decode_plus(page))


def nonempty_title(title) -> Column:
    t = _c(title)
    return (F.length(t) > 0) & ~t.startswith("#")


# P1 ---------------------------------------------------------------------------
def parse_count(s) -> Column:
    """Integer count as the source's int(): surrounding blanks allowed,
    anything else (12x, '12 x') gives NULL instead of a crash."""
    # Same as matching ^\s*([0-9]+)\s*$, without a regex (which would decode
    # every value into a Java string): strip the \s set, then digits only.
    t = F.trim(_c(s), F.lit(WHITESPACE))
    return F.when((F.length(t) > 0) & (F.translate(t, "0123456789", "") == ""), t) \
        .try_cast("bigint")


def _first_is_digit(c: Column) -> Column:
    """First character in [0-9] (a one-character string compare, no regex)."""
    first = F.substring(c, 1, 1)
    return (first >= F.lit("0")) & (first <= F.lit("9"))


def once(df: DataFrame, keep: Sequence[str], *cols: Column) -> DataFrame:
    """(keep..., cols...) with every column of ``cols`` evaluated once a row.

    Catalyst pushes a filter below the projection it reads and puts the
    projection's expressions in its place, once for each reference, level by
    level. It does not push one below a generator on what that generates:
    a row of one-element arrays ends the inlining here.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*cols))))


def _split(lines: DataFrame, line_col: str, keep: Sequence[str]) -> DataFrame:
    """Project the line and its space-split fields once (``_p``); measured
    faster than repeated ``split_part`` calls or the regex groups alone."""
    line = F.col(line_col)
    return lines.select(*keep, line.alias("_line"), F.split(line, " ", -1).alias("_p"))


def _fields():
    """(shape, page, raw_count) over the columns of ``_split``.

    Fast path, exact: a line with exactly three spaces and no newline
    matches the shape iff its fields are (en, page, digit.., digit..), and
    then the groups are the fields. Other lines take the regex.
    """
    line, p = F.col("_line"), F.col("_p")
    simple = (F.size(p) == 4) & ~line.contains("\n")
    fast_ok = (F.get(p, 0) == "en") & _first_is_digit(F.get(p, 2)) & _first_is_digit(F.get(p, 3))
    shape = F.when(simple, fast_ok).otherwise(line_shape(line))
    page = F.when(simple, F.get(p, 1)).otherwise(line_group(line, 1))
    raw = F.when(simple, F.get(p, 2)).otherwise(line_group(line, 2))
    return shape, page, raw


def parse_lines(lines: DataFrame, line_col: str = "value", strict_ext: bool = False,
                blacklist: Sequence[str] = BLACKLIST,
                namespaces: Sequence[str] = EXCLUDED_NAMESPACES,
                keyword: str | None = None,
                keep: Sequence[str] = (),
                extra_rule=None) -> DataFrame:
    """Raw lines -> (keep..., page, title, views, status).

    status is 'ok' for a counted row, otherwise the reason it was rejected:
    'shape', 'keyword', 'title', 'empty', 'count'. ``extra_rule`` is a user
    predicate (Column -> Column, True = keep) on the undecoded page, checked
    with the built-in title rules (Z3). For the accepted rows only, use
    ``accepted_lines`` (cheaper: it filters stage by stage).
    """
    shape, page, raw = _fields()
    kw_ok = keyword_in_line(F.col("_line"), keyword) if keyword else F.lit(True)
    d2 = _split(lines, line_col, keep).select(*keep, shape.alias("_shape"), kw_ok.alias("_kw"),
                                              page.alias("_pg"), raw.alias("_rc"))
    # groups of a line that does not match are empty, as with the regex
    sh = F.col("_shape")
    d2 = d2.select(*keep, "_shape", "_kw",
                   F.when(sh, F.col("_pg")).otherwise(F.lit("")).alias("_page"),
                   F.when(sh, F.col("_rc")).otherwise(F.lit("")).alias("_raw_count"))
    valid = is_valid_title("_page", strict_ext, blacklist, namespaces)
    if extra_rule is not None:
        valid = valid & extra_rule(F.col("_page"))
    d3 = d2.select(*keep, "_shape", "_kw", "_page",
                   clean_title(F.col("_page")).alias("title"),
                   parse_count(F.col("_raw_count")).alias("views"),
                   valid.alias("_valid"))
    status = (F.when(~F.col("_shape"), "shape")
               .when(~F.col("_kw"), "keyword")
               .when(~F.col("_valid"), "title")
               .when(~F.coalesce(nonempty_title("title"), F.lit(False)), "empty")
               .when(F.col("views").isNull(), "count")
               .otherwise("ok"))
    return once(d3, keep, F.col("_page").alias("page"), F.col("title"), F.col("views"), status.alias("status"))


def accepted_lines(lines: DataFrame, line_col: str = "value", strict_ext: bool = False,
                   blacklist: Sequence[str] = BLACKLIST,
                   namespaces: Sequence[str] = EXCLUDED_NAMESPACES,
                   keyword: str | None = None,
                   keep: Sequence[str] = (),
                   extra_rule=None, require_count: bool = True) -> DataFrame:
    """(keep..., title, views) of the lines ``parse_lines`` marks 'ok'
    (with ``require_count=False`` also those rejected only for the count).

    The fields of a line are evaluated once, and so is its title; the rules
    between them are filters on those columns, so rejected lines stop early.
    """
    shape, page, raw = _fields()
    kw_ok = [keyword_in_line(F.col("_line"), keyword).alias("_kw")] if keyword else []
    d1 = once(_split(lines, line_col, keep), keep, shape.alias("_shape"), page.alias("_page"),
               raw.alias("_raw_count"), *kw_ok).where("_shape")
    if keyword:
        d1 = d1.where("_kw")
    valid = is_valid_title("_page", strict_ext, blacklist, namespaces)
    if extra_rule is not None:
        valid = valid & extra_rule(F.col("_page"))
    d3 = once(d1.where(valid), keep, clean_title(F.col("_page")).alias("title"),
               parse_count(F.col("_raw_count")).alias("views"))
    cond = F.coalesce(nonempty_title("title"), F.lit(False))
    return d3.where(cond & F.col("views").isNotNull() if require_count else cond)


def counted_lines(lines: DataFrame, line_col: str = "value", strict_ext: bool = False,
                  blacklist: Sequence[str] = BLACKLIST,
                  namespaces: Sequence[str] = EXCLUDED_NAMESPACES,
                  keyword: str | None = None,
                  keep: Sequence[str] = (),
                  extra_rule=None) -> DataFrame:
    """(keep..., title, views) of every line, both NULL where ``parse_lines``
    marks another status than 'ok': a rejected line still tells its hour.
    A rule is evaluated only on lines that met those before it."""
    shape, page, raw = _fields()
    kw_ok = keyword_in_line(F.col("_line"), keyword) if keyword else F.lit(True)
    d1 = once(_split(lines, line_col, keep), keep, (shape & kw_ok).alias("_shape"), page.alias("_page"),
              raw.alias("_raw_count"))
    valid = is_valid_title("_page", strict_ext, blacklist, namespaces)
    if extra_rule is not None:
        valid = valid & extra_rule(F.col("_page"))
    d2 = once(d1, keep, F.when(F.col("_shape") & valid, F.struct(clean_title("_page").alias("title"),
                                                                 parse_count("_raw_count").alias("views"))).alias("_l"))
    ok = nonempty_title("_l.title") & F.col("_l.views").isNotNull()
    return d2.select(*keep, F.when(ok, F.col("_l.title")).alias("title"), F.when(ok, F.col("_l.views")).alias("views"))


def shaped_pages(lines: DataFrame, line_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., page) of the lines of the right shape (F1, then the page group)."""
    shape, page, _ = _fields()
    return once(_split(lines, line_col, keep), keep, shape.alias("_shape"), page.alias("page")) \
        .where("_shape").drop("_shape")


# P2 ---------------------------------------------------------------------------
def split_line(lines: DataFrame, line_col: str = "value", lower_page: bool = True,
               keep: Sequence[str] = ()) -> DataFrame:
    """Space split into (project, page, views, bytes); page lower-cased."""
    parts = F.split(F.col(line_col), " ")
    page = F.get(parts, 1)
    return lines.select(
        *keep,
        F.get(parts, 0).alias("project"),
        (F.lower(page) if lower_page else page).alias("page"),
        F.get(parts, 2).try_cast("bigint").alias("views"),
        F.get(parts, 3).try_cast("bigint").alias("bytes"),
    )
