"""Bindings of the driver tables to the shapes the engine consumes.

The engine's natural inputs are hourly page-count files and wiki dumps. The
driver ships generic parquet tables instead, so each binding below maps a
table onto one input shape. Every binding is a plain projection (no
aggregation), so all downstream work still grows with the tables.

- ``*_hits``: (title, ts, views) rows, one per observed view record.
- ``*_lines``: raw page-count text lines `project page views bytes` + stamp.
- ``wiki_page`` / ``wiki_redirect``: the two dump tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Base hour of the synthetic file stamps derived below.
BASE_STAMP = "2015-03-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an input that scans into fewer partitions than the
    session has cores (one big file, one row group) before heavy per-row
    work; the check plans the scan but runs no job."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def _hits(df: DataFrame, title, ts) -> DataFrame:
    return df.select(title.alias("title"), F.col(ts).cast("timestamp_ntz").alias("ts"),
                     F.lit(1).cast("bigint").alias("views"))


def event_hits(spark, sf_dir) -> DataFrame:
    """V1/V2 source: each event is one view of the page named by its type."""
    return _hits(table(spark, sf_dir, "events"), F.col("event_type"), "ts")


def user_event_hits(spark, sf_dir) -> DataFrame:
    """V9 source: each event is one view of the page named by its type and
    the user's group (12 of them)."""
    group = F.concat(F.col("event_type"), F.lit("/"), (F.col("user_id") % 12).cast("string"))
    return _hits(table(spark, sf_dir, "events"), group, "ts")


def order_hits(spark, sf_dir) -> DataFrame:
    """V3 source: each order is one view of its priority, on its order date."""
    return _hits(table(spark, sf_dir, "orders"), F.col("o_orderpriority"), "o_orderdate")


def customer_title(key) -> F.Column:
    """'Customer_' + 9-digit key: the wiki title a customer key stands for."""
    return F.concat(F.lit("Customer_"), F.lpad(key.cast("string"), 9, "0"))


def customer_order_hits(spark, sf_dir) -> DataFrame:
    """V8: each order is one view of its customer's page, on its order date."""
    o = table(spark, sf_dir, "orders")
    return _hits(o, customer_title(F.col("o_custkey")), "o_orderdate")


def _stamp(hours_col) -> F.Column:
    """'yyyyMMddHHmmss' of the hour ``hours_col`` after the base hour, built
    from date parts (no session time zone involved)."""
    h = hours_col.cast("int")
    d = F.date_add(F.to_date(F.lit(BASE_STAMP[:10])), (h / 24).cast("int"))
    return F.concat(F.year(d).cast("string"), F.lpad(F.month(d).cast("string"), 2, "0"),
                    F.lpad(F.dayofmonth(d).cast("string"), 2, "0"),
                    F.lpad((h % 24).cast("string"), 2, "0"), F.lit("0000"))


def page_lines(spark, sf_dir) -> DataFrame:
    """V4: one page-count line per web page: `lang Host/path views bytes`.

    stamp = hour (page_id % 72) after the base hour, i.e. 72 hourly files.
    """
    p = table(spark, sf_dir, "pages")
    r = r"^https?://([^/]+)/([a-z]+)/(.*)$"
    host = F.regexp_extract("url", r, 1)
    lang = F.regexp_extract("url", r, 2)
    rest = F.regexp_extract("url", r, 3)
    line = F.concat_ws(" ", lang,
                       F.concat(F.upper(F.substring(host, 1, 1)), F.substring(host, 2, 1 << 30),
                                F.lit("/"), rest),
                       (F.col("page_id") % 97 + 1).cast("string"),
                       F.length("html").cast("string"))
    return p.select("page_id", line.alias("value"), _stamp(F.col("page_id") % 72).alias("stamp"))


def host_lines(spark, sf_dir) -> DataFrame:
    """As V4 but the page is the bare host, so (project, page) repeats."""
    p = table(spark, sf_dir, "pages")
    r = r"^https?://([^/]+)/([a-z]+)/(.*)$"
    line = F.concat_ws(" ", F.regexp_extract("url", r, 2), F.regexp_extract("url", r, 1),
                       (F.col("page_id") % 97 + 1).cast("string"),
                       F.length("html").cast("string"))
    return p.select("page_id", line.alias("value"))


TOKEN_SPLIT = "[ \t\r\n]+"


def token_lines(spark, sf_dir) -> DataFrame:
    """V7: every whitespace token of every document is one page-count line
    `lang token views bytes`, stamped on day (doc_id % 30) of the base month
    at hour 6 * (doc_id % 4): two hours per day. Whole texts are used."""
    d = spread(table(spark, sf_dir, "documents"))
    hours = (F.col("doc_id") % 30) * 24 + (F.col("doc_id") % 4) * 6
    # per-document parts first, so each token costs a single concat
    per_doc = d.select("doc_id", "text", F.concat(F.col("lang"), F.lit(" ")).alias("_pre"),
                       F.concat_ws(" ", F.lit(""), (F.col("doc_id") % 97 + 1).cast("string"),
                                   F.col("n_chars").cast("string")).alias("_suf"),
                       _stamp(hours).alias("stamp"))
    t = per_doc.select("doc_id", "_pre", "_suf", "stamp",
                       F.explode(F.split("text", TOKEN_SPLIT)).alias("token"))
    return t.select("doc_id", F.concat("_pre", "token", "_suf").alias("value"), "stamp")


def token_files(spark, sf_dir) -> DataFrame:
    """The lines of V7 for files: one row a document, its lines in order with
    a newline between them, so that a document and not each of its lines is
    shuffled and sorted by hour. Documents without a text have no lines; those
    without a lang have empty ones, as null lines are written."""
    d = spread(table(spark, sf_dir, "documents"))
    hours = (F.col("doc_id") % 30) * 24 + (F.col("doc_id") % 4) * 6
    return d.where("text is not null").select(
        "text", F.concat(F.col("lang"), F.lit(" ")).alias("_pre"),
        F.concat_ws(" ", F.lit(""), (F.col("doc_id") % 97 + 1).cast("string"),
                    F.col("n_chars").cast("string")).alias("_suf"),
        _stamp(hours).alias("stamp"))


def token_block() -> F.Column:
    """The lines of a row of ``token_files`` as one value."""
    tokens = F.split("text", TOKEN_SPLIT)
    joined = F.concat(F.col("_pre"), F.call_function("array_join", tokens, F.concat(F.col("_suf"), F.lit("\n"), F.col("_pre"))),
                      F.col("_suf"))
    return F.when(F.col("_pre").isNull(), F.repeat(F.lit("\n"), F.size(tokens) - 1)).otherwise(joined)


def tricky_lines(spark, sf_dir) -> DataFrame:
    """V6: the lines of V7 with every title decorated by ``(doc_id + token
    length) % 16``, so that each cleaning rule meets lines it must drop or
    change: namespaces, suffixes, spaces, excluded titles, escapes, anchors
    and counts that are no number. No line of V7 is left out."""
    d = spread(table(spark, sf_dir, "documents"))
    hours = (F.col("doc_id") % 30) * 24 + (F.col("doc_id") % 4) * 6
    # per-document parts first; each token then costs compiled expressions, no lambda
    t = d.select("doc_id", "lang", F.col("n_chars").cast("string").alias("_bytes"), _stamp(hours).alias("stamp"),
                 (F.col("doc_id") % 97 + 1).cast("string").alias("_views"),
                 F.explode(F.split("text", TOKEN_SPLIT)).alias("_tok")) \
        .withColumn("_m", ((F.col("doc_id") + F.length("_tok")) % 16).cast("int"))
    m = F.col("_m")
    head = F.element_at(F.array(*[F.lit(v) for v in (
        "User_talk:", "Wikipedia:", "X", "X", "Mexico", "Big ", "Main_Page", "Search",
        "Caf%C3%A9_", "%23", "A%zz+", "Big#", "T", "", "", "")]), m + 1)
    title = F.concat(head, F.when(m.isin(6, 7), "").otherwise(F.col("_tok")),
                     F.when(m == 2, ".png").when(m == 3, ".JPG").otherwise(""))
    views = F.concat("_views", F.when(m == 12, "x").otherwise(""))
    return t.select("doc_id", F.concat_ws(" ", "lang", title, views, "_bytes").alias("value"), "stamp")


def listing_pages(spark, sf_dir) -> DataFrame:
    """Directory listings: every web page with a link to its hourly file
    (the stamp of V4) put in front of its html."""
    s = _stamp(F.col("page_id") % 72)
    name = F.concat(F.lit("pagecounts-"), F.substring(s, 1, 8), F.lit("-"), F.substring(s, 9, 6), F.lit(".gz"))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit('<li><a href="'), name, F.lit('">'), name, F.lit("</a></li>"), "html").alias("html"))


def wiki_page(spark, sf_dir) -> DataFrame:
    """V5 page: one wiki page per customer; every 10th key is outside ns 0."""
    c = table(spark, sf_dir, "customer")
    title = F.concat(F.split_part("c_name", F.lit("#"), F.lit(1)), F.lit("_"),
                     F.split_part("c_name", F.lit("#"), F.lit(2)))
    return c.select(F.col("c_custkey").alias("page_id"),
                    ((F.col("c_custkey") % 10) / 9).cast("int").alias("page_namespace"),
                    title.alias("page_title"),
                    (F.col("c_custkey") + 100000).alias("page_latest"))


def wiki_redirect(spark, sf_dir) -> DataFrame:
    """V5 redirect: every 4th customer page redirects to key (7k mod 2000)."""
    c = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 4 == 0)
    return c.select(F.col("c_custkey").alias("rd_from"),
                    F.lit(0).cast("bigint").alias("rd_namespace"),
                    customer_title((F.col("c_custkey") * 7) % 2000).alias("rd_title"))
