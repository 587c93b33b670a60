"""Pattern search over titles by an index of their three-letter grams (T4).

``write_title_index`` stores one row per (gram, title), bucketed and sorted by
gram, and a row count per gram. A search takes the grams that every match of
the pattern must hold from the pattern's literal runs, reads the posting
lists of the rarest of them (one bucket each) and verifies the titles that
are in all of them with the pattern itself. A pattern without a literal run
of three letters has no grams: all titles are tried.
"""

from __future__ import annotations

from re import _constants as RC
from re import _parser as RP

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.sources.catalog import save_table

SIZE = 3


def grams_of(title) -> F.Column:
    """The distinct three-letter grams of a title."""
    n = F.length(title) - (SIZE - 1)
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(title, i, F.lit(SIZE))))) \
        .otherwise(F.array().cast("array<string>"))


def required_grams(pattern: str) -> list[str]:
    """Grams that stand in every text the pattern matches somewhere."""
    try:
        tree = RP.parse(pattern)
    except Exception:  # noqa: BLE001  a pattern of Java's own syntax is verified on all titles
        return []
    if tree.state.flags & RC.SRE_FLAG_IGNORECASE:
        return []
    runs: list[str] = []

    def walk(items) -> None:
        run = ""
        for op, arg in items:
            if op is RC.LITERAL:
                run += chr(arg)
                continue
            if op is RC.AT:  # an anchor has no width
                continue
            runs.append(run)
            run = ""
            if op is RC.SUBPATTERN:
                _, add, _, inner = arg
                if not add & RC.SRE_FLAG_IGNORECASE:
                    walk(inner)
            elif op is RC.MAX_REPEAT or op is RC.MIN_REPEAT:
                least, _, inner = arg
                if least > 0:
                    walk(inner)
        runs.append(run)

    walk(tree)
    return sorted({r[i:i + SIZE] for r in runs for i in range(len(r) - SIZE + 1)})


def write_title_index(titles: DataFrame, name: str, path: str, buckets: int = 64, title: str = "title") -> str:
    """Tables ``name`` (gram, title) and ``name``_counts (gram, n)."""
    postings = titles.select(F.col(title).alias("title")).where("title is not null").distinct() \
        .select(F.explode(grams_of(F.col("title"))).alias("gram"), "title")
    save_table(postings.repartition(buckets, "gram"), name, bucket_by=(buckets, "gram"), path=f"{path}/postings")
    counts = postings.sparkSession.table(name).groupBy("gram").agg(F.count("*").alias("n"))
    save_table(counts, f"{name}_counts", bucket_by=(buckets, "gram"), path=f"{path}/counts")
    return name


def candidates(spark: SparkSession, name: str, pattern: str, use: int = 3) -> DataFrame | None:
    """Titles that hold the ``use`` rarest grams the pattern requires; None if
    it requires none."""
    grams = required_grams(pattern)
    if not grams:
        return None
    known = spark.table(f"{name}_counts").where(F.col("gram").isin(grams)).orderBy("n", "gram").collect()  # of the pattern
    if len(known) < len(grams):  # a gram that no title holds
        return spark.table(name).select("title").limit(0)
    rare = [r.gram for r in known[:use]]
    found = spark.table(name).where(F.col("gram").isin(rare))
    return found.groupBy("title").agg(F.count("*").alias("n")).where(F.col("n") == len(rare)).select("title")


def search_titles(spark: SparkSession, name: str, titles: DataFrame, pattern: str) -> DataFrame:
    """The titles that match a pattern: by the index, or of ``titles`` if the
    pattern requires no gram."""
    found = candidates(spark, name, pattern)
    found = titles.select("title").distinct() if found is None else found
    return found.where(F.col("title").rlike(pattern))


def trend_search_indexed(trends: DataFrame, name: str, pattern: str) -> DataFrame:
    """T4: all points of the titles that match a pattern."""
    found = search_titles(trends.sparkSession, name, trends, pattern)
    return trends.join(found, "title", "left_semi")
