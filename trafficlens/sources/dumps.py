"""SQL dump reader (S6): `INSERT INTO `t` VALUES (..),(..);` -> rows.

Each statement line is split into its tuples with one quote-aware regex
(a parenthesis inside a quoted string does not end a tuple), and each tuple
into its values with another. Both use possessive repeats, which Java's
matcher runs without recursion, so long strings do not exhaust the stack.
Escapes in quoted strings are undone; only the bare word NULL is null. All
of it is per-row Column work; a dump file of any size is read in parallel as
text (uncompressed or splittable codecs split by size, gz by file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A tuple: '(' then any mix of non-quote/non-paren chars and quoted strings, ')'.
QUOTED = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
TUPLE_PATTERN = r"(?s)\(((?:[^'()]++|" + QUOTED + r")*+)\)"
VALUE_PATTERN = r"(?s)" + QUOTED + r"|[^,']++"
# What a backslash and a letter stand for; any other letter is itself.
ESCAPED = {"n": "\n", "r": "\r", "t": "\t", "0": "\0", "b": "\b", "Z": "\x1a"}
INSERT_PATTERN = r"^INSERT INTO `([^`]*)` VALUES "

PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("page_namespace", T.IntegerType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("page_restrictions", T.StringType()),
    T.StructField("page_counter", T.LongType()),
    T.StructField("page_is_redirect", T.IntegerType()),
    T.StructField("page_is_new", T.IntegerType()),
    T.StructField("page_random", T.DoubleType()),
    T.StructField("page_touched", T.StringType()),
    T.StructField("page_latest", T.LongType()),
    T.StructField("page_len", T.LongType()),
])
REDIRECT_SCHEMA = T.StructType([
    T.StructField("rd_from", T.LongType()),
    T.StructField("rd_namespace", T.IntegerType()),
    T.StructField("rd_title", T.StringType()),
])


def dump_tuples(lines: DataFrame, line_col: str = "value", table: str | None = None) -> DataFrame:
    """(table, tuple_text) for every tuple of every INSERT line."""
    v = F.col(line_col)
    df = lines.where(v.rlike(INSERT_PATTERN))
    if table is not None:
        df = df.where(F.regexp_extract(v, INSERT_PATTERN, 1) == F.lit(table))
    return df.select(F.regexp_extract(v, INSERT_PATTERN, 1).alias("table"),
                     F.explode(F.regexp_extract_all(v, F.lit(TUPLE_PATTERN), F.lit(1))).alias("tuple"))


def _unescape(quoted):
    """The string that a quoted value stands for; pairs of backslashes are
    set apart first, so that the second of a pair escapes nothing."""
    def piece(x):
        for letter, char in ESCAPED.items():
            x = F.replace(x, F.lit("\\" + letter), F.lit(char))
        return F.regexp_replace(x, r"(?s)\\(.)", "$1")

    inner = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    return F.array_join(F.transform(F.split(inner, r"\\\\", -1), piece), "\\")


def parse_tuples(tuples: DataFrame, schema: T.StructType, col: str = "tuple") -> DataFrame:
    """Tuple text -> typed columns."""
    raw = F.regexp_extract_all(F.col(col), F.lit(VALUE_PATTERN), F.lit(0))
    values = F.transform(raw, lambda x: F.when(x.startswith("'"), _unescape(x)).when(x != "NULL", x))
    return tuples.select(values.alias("_v")).select(
        *[F.get("_v", k).try_cast(f.dataType).alias(f.name) for k, f in enumerate(schema.fields)])


def read_dump(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    return parse_tuples(dump_tuples(spark.read.text(path), table=table), schema)


def to_dump_lines(rows: DataFrame, table: str, batch: str, cols: list[str],
                  quoted: set[str]) -> DataFrame:
    """Render rows as dump INSERT lines, one statement per ``batch`` group
    (a bounded group: the caller's batch key caps the tuples per line)."""
    def fmt(c):
        if c in quoted:
            esc = F.col(c)
            for plain, code in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
                esc = F.replace(esc, F.lit(plain), F.lit(code))
            return F.concat(F.lit("'"), esc, F.lit("'"))
        return F.col(c).cast("string")
    tup = F.concat(F.lit("("), F.concat_ws(",", *[fmt(c) for c in cols]), F.lit(")"))
    g = rows.groupBy(batch).agg(F.array_sort(F.collect_list(F.struct(F.col(cols[0]).alias("k"),
                                                                       tup.alias("t")))).alias("_t"))
    return g.select(F.concat(F.lit(f"INSERT INTO `{table}` VALUES "),
                             F.array_join(F.col("_t.t"), ","), F.lit(";")).alias("value"))
