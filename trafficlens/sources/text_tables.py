"""Delimited text tables.

Fixed schemas, no inference; no quoting (titles may hold quotes), Hive's
``\\N`` for NULL. Backslash, separator, CR and LF inside a string are written
as ``\\\\``, ``\\s``, ``\\r`` and ``\\n``, so every string reads back as it was,
the empty one included. Writes always overwrite their target (S10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL = r"\N"
CORRUPT = "_corrupt"


def _codes(sep: str) -> list[tuple[str, str]]:
    return [(sep, r"\s"), ("\r", r"\r"), ("\n", r"\n")]


def _escape(value: Column, sep: str) -> Column:
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for plain, code in _codes(sep):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return F.coalesce(out, F.lit(NULL))


def _unescape(value: Column, sep: str) -> Column:
    """Pairs of backslashes are set apart first: the second escapes nothing."""
    def piece(x: Column) -> Column:
        for plain, code in _codes(sep):
            x = F.replace(x, F.lit(code), F.lit(plain))
        return x

    whole = F.array_join(F.transform(F.split(value, r"\\\\", -1), piece), "\\")
    return F.when(value != NULL, whole)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str,
                   sep: str = "|") -> DataFrame:
    """Typed columns; a value that does not fit its type is NULL. If the schema
    ends in a string column ``_corrupt``, it holds the lines whose number of
    values is wrong."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = [f for f in schema.fields if f.name != CORRUPT]
    values = F.split("value", F.concat(F.lit(r"\Q"), F.lit(sep), F.lit(r"\E")), -1)
    columns = [_unescape(F.get("_v", k), sep).try_cast(f.dataType).alias(f.name) for k, f in enumerate(fields)]
    if len(fields) < len(schema.fields):
        columns.append(F.when(F.size("_v") != len(fields), F.col("value")).alias(CORRUPT))
    return spark.read.text(path).select("value", values.alias("_v")).select(*columns)


def write_delimited(df: DataFrame, path: str, sep: str = "|", single_file: bool = False,
                    max_rows: int = 100_000) -> str:
    """S14 export; ``single_file`` = S17, for outputs of ``max_rows`` at most."""
    if single_file:
        if df.limit(max_rows + 1).count() > max_rows:
            raise ValueError(f"more than {max_rows} rows for a single file")
        df = df.coalesce(1)
    line = F.concat_ws(sep, *[_escape(F.col(c).cast("string"), sep) for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").text(path)
    return path
