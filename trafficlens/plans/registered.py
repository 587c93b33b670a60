"""Registered queries: one per operator key, plus the DuckDB oracle SQL.

Each query reads the driver tables through ``trafficlens.sources.bindings``
and runs the library operator over the whole table. Oracle SQL is written
independently against the same tables; every computed column is aliased
to the same name on both sides, and integer results are BIGINT on both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficlens.functions import scalars as S
from trafficlens.functions import titles as X
from trafficlens.operators import counts as C
from trafficlens.operators import documents as D
from trafficlens.operators import forecast as M
from trafficlens.operators import gaps as G
from trafficlens.operators import lookups as L
from trafficlens.operators import ranking as RK
from trafficlens.operators import timelines as TL
from trafficlens.operators import title_index as TI
from trafficlens.operators import topn as TN
from trafficlens.operators import trends as T
from trafficlens.operators import udf as U
from trafficlens.plans import batch_trends as BT
from trafficlens.plans import merge_rank as MR
from trafficlens.session import fresh_path
from trafficlens.sources import bindings as B
from trafficlens.sources import catalog as CT
from trafficlens.sources import doc_store as DS
from trafficlens.sources import dumps as DP
from trafficlens.sources import manifest as MF
from trafficlens.sources import pagecounts as PC
from trafficlens.sources import search_docs as SD
from trafficlens.sources import text_tables as TT
from trafficlens.sources import trend_lines as TLN
from trafficlens.streaming import hourly as HS
from trafficlens.streaming import store as ST

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


# ----------------------------------------------------------------------------
# Oracle building blocks (DuckDB)
V1 = """v1 as (select event_type as title, strftime(ts, '%Y%m%d') as dt,
               count(*)::BIGINT as views from events group by 1, 2)"""
V2 = """v2 as (select event_type as title, date_trunc('hour', ts) as ts,
               count(*)::BIGINT as views from events group by 1, 2)"""
V9 = """v9 as (select event_type || '/' || (user_id % 12)::VARCHAR as title, date_trunc('hour', ts) as ts,
               count(*)::BIGINT as views from events group by 1, 2)"""
V3 = """v3 as (select o_orderpriority as title, strftime(o_orderdate, '%Y%m%d') as dt,
               count(*)::BIGINT as views from orders group by 1, 2)"""


def trend_sql(src: str) -> str:
    """Oracle for W10 on a (title, dt, views) CTE named ``src``."""
    return f"""
, f as (
  select title, dt, views,
    (row_number() over w - 1)::INTEGER as idx,
    lag(views) over w as prev,
    sum(views) over (w rows between 7 preceding and 1 preceding) as wa1,
    sum(views) over (w rows between 14 preceding and 8 preceding) as wa0,
    sum(views) over (w rows between 8 preceding and 2 preceding) as wp1,
    sum(views) over (w rows between 15 preceding and 9 preceding) as wp0,
    sum(views) over (w rows between 30 preceding and 1 preceding) as ma1,
    sum(views) over (w rows between 60 preceding and 31 preceding) as ma0,
    sum(views) over (w rows between 31 preceding and 2 preceding) as mp1,
    sum(views) over (w rows between 61 preceding and 32 preceding) as mp0
  from {src} window w as (partition by title order by dt))
, trend as (
  select title, dt, views, idx,
    case when idx = 0 then 0.0::DOUBLE else views::DOUBLE / nullif(prev, 0) - 1 end as daily_trend,
    case when idx > 13 then wa1::DOUBLE / nullif(wa0, 0) - 1 else 0.0::DOUBLE end as weekly_trend_at,
    case when idx > 59 then ma1::DOUBLE / nullif(ma0, 0) - 1 else 0.0::DOUBLE end as monthly_trend_at,
    case when idx > 14 then wp1::DOUBLE / nullif(wp0, 0) - 1 else 0.0::DOUBLE end as weekly_trend,
    case when idx > 60 then mp1::DOUBLE / nullif(mp0, 0) - 1 else 0.0::DOUBLE end as monthly_trend
  from f)"""


# ----------------------------------------------------------------------------
# Data views used by several queries (Spark side)

def v1(spark, sf) -> DataFrame:
    return C.daily_counts(B.event_hits(spark, sf))


def v2(spark, sf) -> DataFrame:
    return C.hourly_counts(B.event_hits(spark, sf))


def v3(spark, sf) -> DataFrame:
    return C.daily_counts(B.order_hits(spark, sf))


# ----------------------------------------------------------------------------
# A1 / A2 / W1-W4 / W10

@register("daily_counts", f"with {V1} select * from v1")
def q_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    return v1(spark, sf)


@register("hourly_counts", f"with {V2} select * from v2")
def q_hourly_counts(spark, sf):
    return v2(spark, sf)


@register("trend_table", f"with {V1} {trend_sql('v1')} select * from trend")
def q_trend_table(spark, sf):
    return T.trend_table(v1(spark, sf))


@register("daily_trend", f"with {V1} {trend_sql('v1')} select title, dt, views, daily_trend from trend")
def q_daily_trend(spark, sf):
    return T.daily_trend(v1(spark, sf))


@register("weekly_trend", f"with {V1} {trend_sql('v1')} "
          "select title, dt, views, weekly_trend_at, weekly_trend from trend")
def q_weekly_trend(spark, sf):
    return T.weekly_trend(v1(spark, sf))


@register("monthly_trend", f"with {V3} {trend_sql('v3')} "
          "select title, dt, views, monthly_trend_at, monthly_trend from trend")
def q_monthly_trend(spark, sf):
    return T.monthly_trend(v3(spark, sf))


@register("aligned_trends", f"with {V3} {trend_sql('v3')} select * from trend")
def q_aligned_trends(spark, sf):
    return T.trend_table(v3(spark, sf))


# ----------------------------------------------------------------------------
# Lines: V4 (web page urls) and V7 (every token of every document)

V4 = r"""v4 as (
  select page_id,
    concat_ws(' ', regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(.*)$', 2),
      upper(substring(regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(.*)$', 1), 1, 1))
        || substring(regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(.*)$', 1), 2)
        || '/' || regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(.*)$', 3),
      (page_id % 97 + 1)::VARCHAR, length(html)::VARCHAR) as value,
    strftime(TIMESTAMP '2015-03-01 00:00:00' + to_hours((page_id % 72)::BIGINT), '%Y%m%d%H%M%S') as stamp
  from pages)"""
V7 = r"""v7 as (
  select doc_id, concat_ws(' ', lang, tok, (doc_id % 97 + 1)::VARCHAR, n_chars::VARCHAR) as value,
    strftime(TIMESTAMP '2015-03-01 00:00:00'
             + to_hours(((doc_id % 30) * 24 + (doc_id % 4) * 6)::BIGINT), '%Y%m%d%H%M%S') as stamp
  from (select doc_id, lang, n_chars, unnest(regexp_split_to_array(text, '[ \t\r\n]+')) as tok
        from documents))"""
LINE_RE = "'^en (.*) ([0-9].*) ([0-9].*)'"
V6 = r"""v6 as (
  select doc_id, concat_ws(' ', lang,
      case m when 0 then 'User_talk:' || tok when 1 then 'Wikipedia:' || tok when 2 then 'X' || tok || '.png'
             when 3 then 'X' || tok || '.JPG' when 4 then 'Mexico' || tok when 5 then 'Big ' || tok
             when 6 then 'Main_Page' when 7 then 'Search' when 8 then 'Caf%C3%A9_' || tok
             when 9 then '%23' || tok when 10 then 'A%zz+' || tok when 11 then 'Big#' || tok
             when 12 then 'T' || tok else tok end,
      (doc_id % 97 + 1)::VARCHAR || case when m = 12 then 'x' else '' end, n_chars::VARCHAR) as value,
    strftime(TIMESTAMP '2015-03-01 00:00:00'
             + to_hours(((doc_id % 30) * 24 + (doc_id % 4) * 6)::BIGINT), '%Y%m%d%H%M%S') as stamp
  from (select *, (doc_id + length(tok)) % 16 as m
        from (select doc_id, lang, n_chars, unnest(regexp_split_to_array(text, '[ \t\r\n]+')) as tok
              from documents)))"""
# Fixed values that must equal the source behaviour, for the oracle alone.
NS_RE = ("'^(Media|Special|Talk|User|User_talk|Project|Project_talk|File|File_talk|MediaWiki|MediaWiki_talk"
         "|Template|Template_talk|Help|Help_talk|Category|Category_talk|Portal|Wikipedia|Wikipedia_talk):'")
EXT_RE = "'^.*.(jpg|gif|png|JPG|GIF|PNG|txt|ico)'"
BLACK = "'404_error/', 'Main_Page', 'Hypertext_Transfer_Protocol', 'Favicon.ico', 'Search'"


def parsed_sql(src: str, keep: str, keyword: str | None = None) -> str:
    """Oracle for P1 (parse_lines) on CTE ``src`` -> CTE ``parsed``."""
    kw = f"when not contains(lower(value), '{keyword}') then 'keyword'" if keyword else ""
    return f"""
, g as (
  select {keep}, value,
    regexp_extract(value, {LINE_RE}, 1) as page,
    regexp_extract(value, {LINE_RE}, 2) as raw_count
  from {src})
, h as (
  select *, split_part(url_decode(replace(page, '+', ' ')), '#', 1) as title,
    try_cast(nullif(regexp_extract(raw_count, '^[ \t\n\r\f]*([0-9]+)[ \t\n\r\f]*$', 1), '') as BIGINT) as views
  from g)
, parsed as (
  select {keep}, page, title, views,
    case when not regexp_matches(value, {LINE_RE}) then 'shape'
         {kw}
         when regexp_matches(page, {NS_RE}) or regexp_matches(page, '^[a-z]')
              or regexp_matches(page, {EXT_RE}) or contains(page, ' ')
              or page in ({BLACK}) then 'title'
         when title = '' or starts_with(title, '#') then 'empty'
         when views is null then 'count'
         else 'ok' end as status
  from h)"""


def v4_lines(spark, sf):
    return B.page_lines(spark, sf)


def v7_lines(spark, sf):
    return B.token_lines(spark, sf)


def v6_lines(spark, sf):
    return B.tricky_lines(spark, sf)


def v7_parsed(spark, sf):
    return X.parse_lines(v7_lines(spark, sf), keep=["doc_id", "stamp"])


def v6_pages(spark, sf):
    """en-shaped V6 lines -> (doc_id, page) (F1 then the page group)."""
    return X.shaped_pages(v6_lines(spark, sf), keep=["doc_id"])


V6_PAGES = f"v6p as (select doc_id, regexp_extract(value, {LINE_RE}, 1) as page from v6 " \
           f"where regexp_matches(value, {LINE_RE}))"


@register("line_shape", f"with {V4} select page_id, value from v4 where regexp_matches(value, {LINE_RE})")
def q_line_shape(spark, sf):
    return v4_lines(spark, sf).where(X.line_shape("value")).select("page_id", "value")


@register("parse_line", f"with {V7} {parsed_sql('v7', 'doc_id, stamp')} select * from parsed")
def q_parse_line(spark, sf):
    return v7_parsed(spark, sf)


@register("parse_tricky", f"with {V6} {parsed_sql('v6', 'doc_id, stamp')} select * from parsed")
def q_parse_tricky(spark, sf):
    return X.parse_lines(v6_lines(spark, sf), keep=["doc_id", "stamp"])


@register("keyword_filter", f"with {V7} select doc_id, value from v7 where contains(lower(value), 'the')")
def q_keyword_filter(spark, sf):
    return v7_lines(spark, sf).where(X.keyword_in_line("value", "the")).select("doc_id", "value")


@register("ns_filter", f"with {V6}, {V6_PAGES} select doc_id, page from v6p "
          f"where not regexp_matches(page, {NS_RE})")
def q_ns_filter(spark, sf):
    return v6_pages(spark, sf).where(~X.in_excluded_namespace("page"))


@register("lowercase_filter", f"with {V6}, {V6_PAGES} select doc_id, page from v6p "
          "where not regexp_matches(page, '^[a-z]')")
def q_lowercase_filter(spark, sf):
    return v6_pages(spark, sf).where(~X.starts_lowercase("page"))


@register("ext_filter", f"with {V6}, {V6_PAGES} select doc_id, page from v6p "
          f"where not regexp_matches(page, {EXT_RE})")
def q_ext_filter(spark, sf):
    return v6_pages(spark, sf).where(~X.looks_like_file("page"))


@register("space_filter", f"with {V6}, {V6_PAGES} select doc_id, page from v6p "
          "where not contains(page, ' ')")
def q_space_filter(spark, sf):
    return v6_pages(spark, sf).where(~X.has_space("page"))


@register("blacklist", f"with {V6}, {V6_PAGES} select doc_id, page from v6p where page not in ({BLACK})")
def q_blacklist(spark, sf):
    return v6_pages(spark, sf).where(~X.blacklisted("page"))


@register("valid_title", f"with {V6}, {V6_PAGES} select doc_id, page from v6p "
          f"where not (regexp_matches(page, {NS_RE}) or regexp_matches(page, '^[a-z]') "
          f"or regexp_matches(page, {EXT_RE}) or contains(page, ' ') or page in ({BLACK}))")
def q_valid_title(spark, sf):
    return v6_pages(spark, sf).where(X.is_valid_title("page"))


@register("clean_nonempty", f"with {V6} {parsed_sql('v6', 'doc_id, stamp')} "
          "select doc_id, title from parsed where status not in ('shape', 'title') "
          "and title <> '' and not starts_with(title, '#')")
def q_clean_nonempty(spark, sf):
    return X.accepted_lines(v6_lines(spark, sf), keep=["doc_id"], require_count=False) \
        .select("doc_id", "title")


@register("scalar_title_clean", f"with {V6}, {V6_PAGES} select doc_id, page, "
          "replace(page, '+', ' ') as plus_spaced, url_decode(replace(page, '+', ' ')) as decoded, "
          "split_part(url_decode(replace(page, '+', ' ')), '#', 1) as title, "
          "trim(split_part(url_decode(replace(page, '+', ' ')), '#', 1)) as trimmed, "
          "lower(split_part(url_decode(replace(page, '+', ' ')), '#', 1)) as lowered from v6p")
def q_scalar_title_clean(spark, sf):
    p = v6_pages(spark, sf)
    dec = X.url_decode_plus("page")
    return p.select("doc_id", "page", F.replace("page", F.lit("+"), F.lit(" ")).alias("plus_spaced"),
                    dec.alias("decoded"), X.cut_anchor(dec).alias("title"),
                    F.trim(X.cut_anchor(dec)).alias("trimmed"),
                    F.lower(X.cut_anchor(dec)).alias("lowered"))


V4_SPLIT = """v4s as (select page_id, split_part(value, ' ', 1) as project,
  lower(split_part(value, ' ', 2)) as page, try_cast(nullif(split_part(value, ' ', 3), '') as BIGINT) as views,
  try_cast(nullif(split_part(value, ' ', 4), '') as BIGINT) as bytes from v4)"""


@register("split_line", f"with {V4}, {V4_SPLIT} select * from v4s")
def q_split_line(spark, sf):
    return X.split_line(v4_lines(spark, sf), keep=["page_id"])


@register("project_filter", f"with {V4}, {V4_SPLIT} select * from v4s where project = 'en'")
def q_project_filter(spark, sf):
    return X.split_line(v4_lines(spark, sf), keep=["page_id"]).where(X.project_is("project"))


@register("min_views", f"with {V4}, {V4_SPLIT} select * from v4s where project = 'en' and views > 50")
def q_min_views(spark, sf):
    s = X.split_line(v4_lines(spark, sf), keep=["page_id"]).where(X.project_is("project"))
    return C.min_views(s, 50)


# ----------------------------------------------------------------------------
# Ranking (W5-W9), top-N (T1-T4), forecast (M1), gaps (S22), documents

V8 = """v8 as (select 'Customer_' || lpad(o_custkey::VARCHAR, 9, '0') as title,
               strftime(o_orderdate, '%Y%m%d') as dt, count(*)::BIGINT as views
               from orders group by 1, 2)"""

# Doubles that pass through log/regression are compared at a fixed number of
# decimals on both sides; plain ratios and square roots are exact.
LOG_DECIMALS = 9
FIT_DECIMALS = 6


def rank_sql(src: str, order: str = "dt") -> str:
    """Oracle for W5-W8 on CTE ``src`` (title, order, views) -> CTE ``ranked``."""
    return f"""
, rr as (select title, views, row_number() over (partition by title order by {order} desc) as r from {src})
, rg as (
  select title, count(*)::BIGINT as n, sum(views)::BIGINT as total_pageviews,
    coalesce(sum(views) filter (where r <= 15), 0) as last15,
    coalesce(sum(views) filter (where r between 16 and 30), 0) as prev15,
    max(views) filter (where r = 1) as y2, max(views) filter (where r = 8) as y1,
    coalesce(sum(views) filter (where r between 2 and 8), 0) as wk
  from rr group by title)
, ranked as (
  select title, total_pageviews, n,
    case when n >= 8 and total_pageviews > 0 then (last15 - prev15)::DOUBLE else 0.0::DOUBLE end as monthly_trend,
    case when n >= 8 and total_pageviews > 0
         then round((y2 - y1)::DOUBLE * (1.0 + ln(1.0 + wk::DOUBLE)), {LOG_DECIMALS})
         else 0.0::DOUBLE end as daily_trend,
    case when n >= 8 and total_pageviews > 0 then 1.0 / sqrt(total_pageviews::DOUBLE)
         else 0.0::DOUBLE end as error
  from rg)"""


def rounded_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("daily_trend", F.round("daily_trend", LOG_DECIMALS))


def v8(spark, sf):
    return C.daily_counts(B.customer_order_hits(spark, sf))


@register("rank_monthly", f"with {V1} {rank_sql('v1')} select title, total_pageviews, monthly_trend from ranked")
def q_rank_monthly(spark, sf):
    return RK.rank_long(v1(spark, sf)).select("title", "total_pageviews", "monthly_trend")


@register("rank_daily", f"with {V1} {rank_sql('v1')} select title, daily_trend from ranked")
def q_rank_daily(spark, sf):
    return rounded_rank(RK.rank_long(v1(spark, sf))).select("title", "daily_trend")


@register("rank_error", f"with {V3} {rank_sql('v3')} select title, total_pageviews, error from ranked")
def q_rank_error(spark, sf):
    return RK.rank_long(v3(spark, sf)).select("title", "total_pageviews", "error")


@register("rank_all", f"with {V8} {rank_sql('v8')} select * from ranked")
def q_rank_all(spark, sf):
    return rounded_rank(RK.rank_long(v8(spark, sf)))


@register("consecutive_ratio", f"""with {V2} select * from (
  select title, ts, lag(ts) over w as prev_ts,
    views::DOUBLE / (case when lag(views) over w = 0 then 1 else lag(views) over w end) - 1.0 as ratio
  from v2 window w as (partition by title order by ts)) where prev_ts is not null""")
def q_consecutive_ratio(spark, sf):
    return RK.consecutive_ratio(v2(spark, sf))


@register("top_24h", f"""with {V9}
, recent as (select * from v9 where ts > (select max(ts) from v9) - interval 24 hour
                                and ts <= (select max(ts) from v9))
{rank_sql('recent', 'ts')}
select *, row_number() over (order by daily_trend desc, total_pageviews desc, title)::INTEGER as rank
from (select * from ranked order by daily_trend desc, total_pageviews desc, title limit 10)""")
def q_top_24h(spark, sf):
    return rounded_rank(top_24h(spark, sf))


def top_24h(spark, sf):
    recent = C.hourly_counts(PC.hour_range(B.user_event_hits(spark, sf), 0, 23))
    return TN.top_by(recent, 10, "daily_trend", "ts")


@register("top_30d", f"""with {V8}
, recent as (select * from v8 where strptime(dt, '%Y%m%d')::DATE >
               (select max(strptime(dt, '%Y%m%d'))::DATE from v8) - 30)
{rank_sql('recent')}
select *, row_number() over (order by monthly_trend desc, total_pageviews desc, title)::INTEGER as rank
from (select * from ranked order by monthly_trend desc, total_pageviews desc, title limit 10)""")
def q_top_30d(spark, sf):
    return rounded_rank(top_30d(spark, sf))


def top_30d(spark, sf):
    recent = C.daily_counts(PC.day_range(B.customer_order_hits(spark, sf), 30))
    return TN.top_by(recent, 10, "monthly_trend", "dt")


@register("top_30d_pages", f"""with {V8}
, recent as (select * from v8 where strptime(dt, '%Y%m%d')::DATE >
               (select max(strptime(dt, '%Y%m%d'))::DATE from v8) - 30)
{rank_sql('recent')}
select *, row_number() over (order by monthly_trend desc, total_pageviews desc, title)::INTEGER as rank
from (select * from ranked order by monthly_trend desc, total_pageviews desc, title limit 10)""")
def q_top_30d_pages(spark, sf):
    return rounded_rank(TN.top_recent_days(v8(spark, sf), n=10, days=30))


@register("forecast_trending", f"""with {V9}
, recent as (select * from v9 where ts > (select max(ts) from v9) - interval 24 hour)
{rank_sql('recent', 'ts')}
, best as (select title from ranked order by daily_trend desc, total_pageviews desc, title limit 10)
, pts as (select title, views::DOUBLE as y, (row_number() over (partition by title order by ts) - 1)::DOUBLE as x
          from v9 where title in (select title from best))
, fit as (select title, count(*)::BIGINT as n, regr_slope(y, x) as slope, regr_intercept(y, x) as intercept
          from pts group by title)
select title, n, round(slope, {FIT_DECIMALS}) as slope, round(intercept, {FIT_DECIMALS}) as intercept,
  round(intercept + slope * (n - 1 + 1), {FIT_DECIMALS}) as forecast_1,
  round(intercept + slope * (n - 1 + 24), {FIT_DECIMALS}) as forecast_24
from fit""")
def q_forecast_trending(spark, sf):
    """T1 then M1: the hourly series of the titles trending now, carried on."""
    series = C.hourly_counts(B.user_event_hits(spark, sf)).join(top_24h(spark, sf).select("title"), "title", "left_semi")
    f = M.forecast(series, horizons=(1, 24), order="ts")
    return f.select("title", "n", *[F.round(c, FIT_DECIMALS).alias(c)
                                    for c in ("slope", "intercept", "forecast_1", "forecast_24")])


@register("top_per_day", f"""with {V3} {trend_sql('v3')}
select * from (select dt, title, views, daily_trend,
  row_number() over (partition by dt order by daily_trend desc nulls last, title)::INTEGER as rank
  from trend) where rank <= 3""")
def q_top_per_day(spark, sf):
    return TN.top_per_day(T.trend_table(v3(spark, sf)), n=3)


@register("trend_search", f"with {V3} {trend_sql('v3')} select * from trend "
          "where regexp_matches(title, '^[12]-')")
def q_trend_search(spark, sf):
    return TN.trend_search(T.trend_table(v3(spark, sf)), pattern="^[12]-")


def stored_trends(spark, sf) -> DataFrame:
    """The trend table, stored for searches by title."""
    path = fresh_path(spark, "trends")
    name = CT.save_table(T.trend_table(v3(spark, sf)), "tl_trends_" + path.rsplit("-", 1)[1],
                         bucket_by=(16, "title"), path=path)
    return spark.table(name)


@register("trend_of_title", f"with {V3} {trend_sql('v3')} select * from trend where title = '1-URGENT'")
def q_trend_of_title(spark, sf):
    return TN.trend_search(stored_trends(spark, sf), title="1-URGENT")


@register("forecast", f"""with {V1}
, pts as (select title, views::DOUBLE as y, (row_number() over (partition by title order by dt) - 1)::DOUBLE as x
          from v1)
, fit as (select title, count(*)::BIGINT as n, regr_slope(y, x) as slope, regr_intercept(y, x) as intercept
          from pts group by title)
select title, n, round(slope, {FIT_DECIMALS}) as slope, round(intercept, {FIT_DECIMALS}) as intercept,
  round(intercept + slope * (n - 1 + 1), {FIT_DECIMALS}) as forecast_1,
  round(intercept + slope * (n - 1 + 7), {FIT_DECIMALS}) as forecast_7
from fit""")
def q_forecast(spark, sf):
    f = M.forecast(v1(spark, sf), horizons=(1, 7))
    return f.select("title", "n", *[F.round(c, FIT_DECIMALS).alias(c)
                                    for c in ("slope", "intercept", "forecast_1", "forecast_7")])


@register("missing_hours", f"""with {V2}
, span as (select title, unnest(generate_series(min(ts), max(ts), interval 1 hour)) as ts
           from v2 group by title)
select title, ts from span s
where not exists (select 1 from v2 where v2.title = s.title and v2.ts = s.ts)""")
def q_missing_hours(spark, sf):
    return G.missing_hours(v2(spark, sf), "ts", by="title")


DOCS_SQL = """select sha1(title || dt) as _id, title, strptime(dt, '%Y%m%d')::DATE as page_date,
  views as page_views, daily_trend::FLOAT as daily_trend,
  weekly_trend::FLOAT as weekly_trend, monthly_trend::FLOAT as monthly_trend from trend"""


@register("search_docs", f"with {V3} {trend_sql('v3')} {DOCS_SQL}")
def q_search_docs(spark, sf):
    return D.search_documents(T.trend_table(v3(spark, sf)))


@register("scalar_doc_id", f"""with {V1} select title, dt, sha1(title || dt) as _id,
  strptime(dt, '%Y%m%d')::DATE as page_date from v1""")
def q_scalar_doc_id(spark, sf):
    return v1(spark, sf).select("title", "dt", S.doc_id(F.col("title"), F.col("dt")).alias("_id"),
                                S.stamp_to_date("dt").alias("page_date"))


@register("series_arrays", f"""with {V1} select title,
  '[' || string_agg(dt, ',' order by dt) || ']' as dates,
  '[' || string_agg(views::VARCHAR, ',' order by dt) || ']' as pageviews,
  count(*)::INTEGER as n from v1 group by title""")
def q_series_arrays(spark, sf):
    s = C.series_arrays(v1(spark, sf))
    return s.select("title", S.json_array_text("dates").alias("dates"),
                    S.json_array_text("views").alias("pageviews"), F.size("dates").alias("n"))


@register("scalar_series", f"""with {V1}
, s as (select title, list(views order by dt) as v, sum(views)::BIGINT as total from v1 group by title)
select title, total, len(v)::INTEGER as n,
  list_sum(v[-7:])::BIGINT as last7_sum,
  round(ln(1.0 + list_sum(v[-7:])::DOUBLE), {LOG_DECIMALS}) as log_week,
  1.0 / sqrt(total::DOUBLE) as inv_sqrt_total from s""")
def q_scalar_series(spark, sf):
    s = C.series_arrays(v1(spark, sf))
    v = F.col("views")
    n = F.size(v)
    last7 = S.sum_array(F.slice(v, F.greatest(n - 6, F.lit(1)), 7))
    return s.select("title", S.sum_array(v).alias("total"), n.alias("n"), last7.alias("last7_sum"),
                    F.round(F.log(F.lit(1.0) + last7.cast("double")), LOG_DECIMALS).alias("log_week"),
                    (F.lit(1.0) / F.sqrt(S.sum_array(v).cast("double"))).alias("inv_sqrt_total"))


HOST_LINES = r"""v4b as (select concat_ws(' ', regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(.*)$', 2),
  regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(.*)$', 1),
  (page_id % 97 + 1)::VARCHAR, length(html)::VARCHAR) as value from pages)"""


@register("dup_pages", f"""with {HOST_LINES}
select lower(split_part(value, ' ', 2)) as page, count(*)::BIGINT as n from v4b
group by split_part(value, ' ', 1), lower(split_part(value, ' ', 2)) having count(*) > 1""")
def q_dup_pages(spark, sf):
    return C.duplicates(X.split_line(B.host_lines(spark, sf)))


@register("distinct_rows", f"""with {V7} {parsed_sql('v7', 'doc_id, stamp')}
select distinct title, stamp from parsed where status = 'ok'""")
def q_distinct_rows(spark, sf):
    return X.accepted_lines(v7_lines(spark, sf), keep=["stamp"]).select("title", "stamp").distinct()


@register("sorted_counts", f"with {V2} select * from v2 order by title, ts")
def q_sorted_counts(spark, sf):
    return C.sorted_counts(v2(spark, sf))


@register("load_stats", f"""with {V7} {parsed_sql('v7', 'doc_id, stamp')}
select stamp, count(*)::BIGINT as lines, count(*) filter (where status = 'ok')::BIGINT as accepted,
  sum(views) filter (where status = 'ok')::BIGINT as views from parsed group by stamp""")
def q_load_stats(spark, sf):
    return C.load_stats(v7_parsed(spark, sf))


# ----------------------------------------------------------------------------
# Lookups (F13, L1-L5, S6) and timelines

V5 = """v5p as (select c_custkey as page_id, (c_custkey % 10 // 9)::INTEGER as page_namespace,
    split_part(c_name, '#', 1) || '_' || split_part(c_name, '#', 2) as page_title,
    c_custkey + 100000 as page_latest from customer)
, v5r as (select c_custkey as rd_from, 0::BIGINT as rd_namespace,
    'Customer_' || lpad(((c_custkey * 7) % 2000)::VARCHAR, 9, '0') as rd_title
    from customer where c_custkey % 4 = 0)
, p0 as (select * from v5p where page_namespace = 0)
, r0 as (select * from v5r where rd_namespace = 0)
, l1 as (select s.page_title as redirect_title, replace(d.page_title, '_', ' ') as true_title,
    d.page_id, d.page_latest from r0 join p0 s on r0.rd_from = s.page_id join p0 d on r0.rd_title = d.page_title)
, l2 as (select page_title as redirect_title, replace(page_title, '_', ' ') as true_title, page_id, page_latest
    from p0 where not exists (select 1 from r0 where r0.rd_from = p0.page_id))
, lookup as (select * from l1 union all select * from l2)"""


def v5_lookup(spark, sf):
    return L.build_lookup(B.wiki_page(spark, sf), B.wiki_redirect(spark, sf))


@register("redirects", f"with {V5} select * from l1")
def q_redirects(spark, sf):
    p = L.main_namespace(B.wiki_page(spark, sf), "page_namespace")
    r = L.main_namespace(B.wiki_redirect(spark, sf), "rd_namespace")
    return L.resolve_redirects(p, r)


@register("nonredirects", f"with {V5} select * from l2")
def q_nonredirects(spark, sf):
    p = L.main_namespace(B.wiki_page(spark, sf), "page_namespace")
    r = L.main_namespace(B.wiki_redirect(spark, sf), "rd_namespace")
    return L.non_redirects(p, r)


@register("page_lookups", f"with {V5} select * from lookup")
def q_page_lookups(spark, sf):
    return v5_lookup(spark, sf)


def v5_dump_lines(spark, sf):
    """V5 rendered as SQL dump text (page and redirect statements, at most
    100 tuples per statement, all eleven page columns)."""
    p = (B.wiki_page(spark, sf).withColumn("_b", (F.col("page_id") / 100).cast("bigint"))
         .withColumn("page_restrictions", F.lit("")).withColumn("page_counter", F.lit(0))
         .withColumn("page_is_redirect", F.lit(0)).withColumn("page_is_new", F.lit(0))
         .withColumn("page_random", F.lit(0.5)).withColumn("page_touched", F.lit("20150301000000"))
         .withColumn("page_len", F.lit(0)))
    r = B.wiki_redirect(spark, sf).withColumn("_b", (F.col("rd_from") / 100).cast("bigint"))
    pl = DP.to_dump_lines(p, "page", "_b", DP.PAGE_SCHEMA.fieldNames(),
                          {"page_title", "page_restrictions", "page_touched"})
    rl = DP.to_dump_lines(r, "redirect", "_b", DP.REDIRECT_SCHEMA.fieldNames(), {"rd_title"})
    return pl.unionByName(rl)


@register("dump_tuples", f"with {V5} select * from v5r")
def q_dump_tuples(spark, sf):
    t = DP.dump_tuples(v5_dump_lines(spark, sf), table="redirect")
    r = DP.parse_tuples(t, DP.REDIRECT_SCHEMA)
    return r.select("rd_from", F.col("rd_namespace").cast("bigint").alias("rd_namespace"), "rd_title")


@register("lookup_build", f"with {V5} select * from lookup")
def q_lookup_build(spark, sf):
    """L4 end to end: dump text written to shared storage, read back with
    the dump reader, namespace filter, L1 + L2, union."""
    path = fresh_path(spark, "dump")
    v5_dump_lines(spark, sf).write.mode("overwrite").text(path)
    page = DP.read_dump(spark, path, "page", DP.PAGE_SCHEMA)
    red = DP.read_dump(spark, path, "redirect", DP.REDIRECT_SCHEMA)
    return L.build_lookup(page, red).select(
        "redirect_title", "true_title", "page_id", "page_latest")


V8_ID = f"""{V8}, {V5}
, cid as (select l.page_id, v8.dt, sum(v8.views)::BIGINT as views
          from v8 join lookup l on l.redirect_title = v8.title group by 1, 2)
, cut as (select strftime(max(strptime(dt, '%Y%m%d')) - interval 30 day, '%Y%m%d') as c from v8)
, hist as (select * from cid where dt <= (select c from cut))
, newc as (select * from cid where dt > (select c from cut))
, merged as (select * from cid where page_id in (select page_id from hist))"""


def v8_page_counts(spark, sf):
    return MR.page_day_counts(v8(spark, sf), v5_lookup(spark, sf))


def stored_counts(spark, sf):
    """V8 counts by page, written once: both halves of a merge read them."""
    path = fresh_path(spark, "page_counts")
    v8_page_counts(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def split_history(counts: DataFrame, as_of_source: DataFrame, days: int = 30):
    """History = all but the last ``days`` days; new batch = the last days.
    The time reference is the latest day of the input counts (a cheap scalar
    subquery over the input, not over the joined result)."""
    last = F.to_date(TN.latest(as_of_source, "dt"), "yyyyMMdd")
    cut = F.date_format(F.date_sub(last, days), "yyyyMMdd")
    return counts.where(F.col("dt") <= cut), counts.where(F.col("dt") > cut)


@register("counts_with_id", f"with {V8_ID} select * from cid")
def q_counts_with_id(spark, sf):
    return v8_page_counts(spark, sf)


@register("timeline_merge", f"""with {V8_ID}
select page_id, '[' || string_agg(dt, ',' order by dt) || ']' as dates,
  '[' || string_agg(views::VARCHAR, ',' order by dt) || ']' as pageviews,
  sum(views)::BIGINT as total_pageviews from merged group by page_id""")
def q_timeline_merge(spark, sf):
    hist, new = split_history(stored_counts(spark, sf), v8(spark, sf))
    m = TL.merge_timelines(TL.timelines_from_counts(hist), new)
    return m.select("page_id", S.json_array_text("dates").alias("dates"),
                    S.json_array_text("pageviews").alias("pageviews"), "total_pageviews")


def rank_sql_key(src: str, key: str) -> str:
    return rank_sql(src).replace("partition by title", f"partition by {key}") \
        .replace("select title,", f"select {key},").replace("group by title", f"group by {key}")


@register("rank_timelines", f"""with {V8_ID} {rank_sql_key('merged', 'page_id')}
select page_id, total_pageviews, monthly_trend, daily_trend, error from ranked""")
def q_rank_timelines(spark, sf):
    counts = v8_page_counts(spark, sf)
    hist, new = split_history(counts, v8(spark, sf))
    m = TL.merge_timelines(TL.timelines_from_counts(hist), new)
    return rounded_rank(RK.rank_arrays(m)).select("page_id", "total_pageviews", "monthly_trend",
                                                  "daily_trend", "error")


PAGES_SQL = """, pages as (select page_id, 'https://en.wikipedia.org/wiki/' || page_title as url,
  replace(page_title, '_', ' ') as title, page_latest from p0)"""


@register("new_pages", f"""with {V8_ID} {rank_sql_key('merged', 'page_id')} {PAGES_SQL}
select distinct p.page_id, p.url, p.title, p.page_latest, r.total_pageviews, r.monthly_trend
from pages p join ranked r on p.page_id = r.page_id""")
def q_new_pages(spark, sf):
    return _merge_result(spark, sf).pages


@register("new_daily_trends", f"""with {V8_ID} {rank_sql_key('merged', 'page_id')} {PAGES_SQL}
select distinct p.page_id, r.daily_trend as trend, r.error from pages p join ranked r on p.page_id = r.page_id""")
def q_new_daily_trends(spark, sf):
    d = _merge_result(spark, sf).daily_trends
    return d.withColumn("trend", F.round("trend", LOG_DECIMALS))


def _merge_result(spark, sf) -> "MR.MergeResult":
    """Entry 3 on the bindings: history = V8 days before the last 30, the
    new batch = V8 counts of the last 30 days entering by title."""
    v8c = v8(spark, sf)
    hist, new = split_history(stored_counts(spark, sf), v8c)
    page = L.main_namespace(B.wiki_page(spark, sf), "page_namespace")
    return MR.rank_merged(TL.timelines_from_counts(hist), new, TL.pages_table(page),
                          L.unmatched_titles(v8c, v5_lookup(spark, sf)), persist=False)


# ----------------------------------------------------------------------------
# Files and sinks (S1-S5, S7-S17, S20, S23) and the batch entries


def staged(spark, lines: DataFrame, name: str) -> str:
    """Lay derived lines out as hourly gz page-count files in shared storage."""
    return PC.write_pagecount_files(lines, fresh_path(spark, name))


def staged_v7(spark, sf, root: str | None = None, where: str = "true") -> str:
    """The lines of V7 (of the stamps that meet ``where``) as files, document by document."""
    return PC.write_pagecount_files(B.token_files(spark, sf).where(where), root or fresh_path(spark, "v7files"),
                                    mode="append", value=B.token_block())


TS_OF_STAMP = "strptime(stamp, '%Y%m%d%H%M%S')"


@register("scan_lines", f"with {V4} select value, stamp, {TS_OF_STAMP} as ts from v4")
def q_scan_lines(spark, sf):
    root = staged(spark, v4_lines(spark, sf), "v4files")
    return PC.read_pagecounts(spark, root).select("value", "stamp", "ts")


@register("file_time", f"with {V4} select distinct stamp, {TS_OF_STAMP} as ts from v4")
def q_file_time(spark, sf):
    root = staged(spark, v4_lines(spark, sf), "v4files")
    return PC.read_pagecounts(spark, root).select("stamp", "ts").distinct()


@register("file_pattern", f"with {V4} select value, stamp from v4 where stamp like '20150301%'")
def q_file_pattern(spark, sf):
    root = staged(spark, v4_lines(spark, sf), "v4files")
    return PC.read_pagecounts(spark, f"{root}/{PC.hour_glob('20150301')}").select("value", "stamp")


@register("union_sources", f"with {V4}, {V7} select value, stamp from v4 union all select value, stamp from v7")
def q_union_sources(spark, sf):
    a = PC.read_pagecounts(spark, staged(spark, v4_lines(spark, sf), "v4files"))
    b = PC.read_pagecounts(spark, staged_v7(spark, sf))
    return PC.union_sources(a.select("value", "stamp"), b.select("value", "stamp"))


@register("recent_hours", f"""with {V2} select * from v2
where ts >= (select max(ts) from v2) - interval 70 hour and ts <= (select max(ts) from v2) - interval 48 hour""")
def q_recent_hours(spark, sf):
    return C.hourly_counts(PC.hour_range(B.event_hits(spark, sf), 48, 70))


V7_DAY = f"""{V7} {parsed_sql('v7', 'doc_id, stamp')}
, v7d as (select title, substring(stamp, 1, 8) as dt, sum(views)::BIGINT as views
          from parsed where status = 'ok' group by 1, 2)"""


@register("batch_trends", f"with {V7_DAY} {trend_sql('v7d')} select * from trend")
def q_batch_trends(spark, sf):
    root = staged_v7(spark, sf)
    return BT.run(spark, root, grain="day")


@register("latest_trends", f"""with {V7} {parsed_sql('v7', 'doc_id, stamp')}
, recent as (select * from parsed where status = 'ok'
  and {TS_OF_STAMP} >= (select max({TS_OF_STAMP}) from v7) - interval 70 hour
  and {TS_OF_STAMP} <= (select max({TS_OF_STAMP}) from v7) - interval 48 hour)
, v7h as (select title, stamp as dt, sum(views)::BIGINT as views from recent group by 1, 2)
{trend_sql('v7h')} select * from trend""")
def q_latest_trends(spark, sf):
    return BT.run_latest(spark, staged_v7(spark, sf))


@register("rejects", f"with {V6} {parsed_sql('v6', 'doc_id, stamp', keyword='a')} "
          "select status, count(*)::BIGINT as n from parsed where status <> 'ok' group by status")
def q_rejects(spark, sf):
    return BT.rejects(v6_lines(spark, sf), keyword="a").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("trend_lines", f"""with {V3} {trend_sql('v3')}
select title, string_agg(dt, ',' order by dt) as dates, string_agg(views::VARCHAR, ',' order by dt) as views,
  count(*)::INTEGER as n_daily,
  (case when count(*) > 13 then count(*) + 1 else 1 end)::INTEGER as n_weekly,
  (case when count(*) > 13 then count(*) + 1 else 1 end)::INTEGER as n_monthly
from trend group by title""")
def q_trend_lines(spark, sf):
    path = fresh_path(spark, "trendlines")
    TLN.write_trend_lines(T.trend_table(v3(spark, sf)), path)
    f = F.split("value", r"\|", -1)
    return spark.read.text(path).select(
        F.get(f, 0).alias("title"), F.get(f, 1).alias("dates"), F.get(f, 2).alias("views"),
        F.size(F.split(F.get(f, 3), ",")).alias("n_daily"),
        F.size(F.split(F.get(f, 4), ",")).alias("n_weekly"),
        F.size(F.split(F.get(f, 5), ",")).alias("n_monthly"))


@register("trend_lines_roundtrip", f"""with {V3} {trend_sql('v3')}
select title, dt, views, daily_trend, weekly_trend, monthly_trend from trend""")
def q_trend_lines_roundtrip(spark, sf):
    path = fresh_path(spark, "trendlines")
    TLN.write_trend_lines(T.trend_table(v3(spark, sf)), path)
    s = TLN.read_trend_lines(spark, path).where(~F.col("bad"))
    z = s.select("title", F.posexplode("dates").alias("i", "dt"), "views", "daily", "weekly", "monthly")
    i = F.col("i") + 1
    at = lambda c: F.when(i <= F.size(c), F.try_element_at(c, i)).otherwise(F.lit(0.0))
    return z.select("title", "dt", F.element_at("views", i).alias("views"), at("daily").alias("daily_trend"),
                    at("weekly").alias("weekly_trend"), at("monthly").alias("monthly_trend"))


@register("search_docs_scan", f"with {V3} {trend_sql('v3')} {DOCS_SQL}")
def q_search_docs_scan(spark, sf):
    path = fresh_path(spark, "docs")
    SD.write_search_docs(D.search_documents(T.trend_table(v3(spark, sf))), path)
    return SD.read_search_docs(spark, path)


@register("publish_upsert", f"""with {V3} {trend_sql('v3')}, d as ({DOCS_SQL})
select _id, title, page_date, case when day(page_date) % 2 = 0 and title > '2' then page_views else page_views + 1000 end
  as page_views, daily_trend, weekly_trend, monthly_trend from d""")
def q_publish_upsert(spark, sf):
    """All documents, then newer ones of some titles on the even days."""
    path = fresh_path(spark, "docs_store")
    docs = D.search_documents(T.trend_table(v3(spark, sf)))
    SD.publish_search_docs(docs.withColumn("page_views", F.col("page_views") + 1000), path)
    SD.publish_search_docs(docs.where((F.day("page_date") % 2 == 0) & (F.col("title") > "2")), path)
    return SD.read_search_docs(spark, path).drop("part")


@register("delimited_table", f"with {V5} select * from lookup")
def q_delimited_table(spark, sf):
    path = fresh_path(spark, "lookup_txt")
    TT.write_delimited(v5_lookup(spark, sf), path, sep="|")
    return TT.read_delimited(spark, path, "redirect_title string, true_title string, "
                                          "page_id bigint, page_latest bigint", sep="|")


@register("table_roundtrip", f"with {V1} select * from v1")
def q_table_roundtrip(spark, sf):
    """Create a table from the first half of the days, append the
    second half with INSERT INTO, read the table."""
    name = "tl_counts_" + fresh_path(spark, "t").rsplit("-", 1)[1]
    counts = v1(spark, sf)
    first = counts.where(F.col("dt") < "20240116")
    (first.write.mode("overwrite").format("parquet")
          .option("path", fresh_path(spark, "tables") + "/" + name).saveAsTable(name))
    CT.load_into(counts.where(F.col("dt") >= "20240116"), name, overwrite=False)
    return spark.table(name)


@register("sql_view", f"""with {HOST_LINES}, st as (select split_part(value, ' ', 1) as project,
  split_part(value, ' ', 2) as page from v4b)
select page from st group by project, page having count(*) > 1""")
def q_sql_view(spark, sf):
    stats = X.split_line(B.host_lines(spark, sf), lower_page=False)
    return CT.sql_view(spark, stats, "stats",
                       "SELECT page FROM stats GROUP BY project, page HAVING COUNT(*) > 1")


@register("listing_manifest", r"""select page_id, name, strptime(regexp_extract(name, 'pagecounts-([0-9]{8})-([0-9]{6})', 1)
  || regexp_extract(name, 'pagecounts-([0-9]{8})-([0-9]{6})', 2), '%Y%m%d%H%M%S') as ts,
  (hour(strptime(regexp_extract(name, 'pagecounts-([0-9]{8})-([0-9]{6})', 1)
  || regexp_extract(name, 'pagecounts-([0-9]{8})-([0-9]{6})', 2), '%Y%m%d%H%M%S')) // 8)::INTEGER as shard
from (select page_id, unnest(regexp_extract_all('<a href="pagecounts-' || strftime(
    TIMESTAMP '2015-03-01 00:00:00' + to_hours((page_id % 72)::BIGINT), '%Y%m%d-%H%M%S') || '.gz">' || html,
    'href="([^"]*)"', 1)) as name from pages)
where starts_with(name, 'pagecounts-')""")
def q_listing_manifest(spark, sf):
    return MF.listing_manifest(B.listing_pages(spark, sf))


@register("missing_files", f"""with {V7}
, h as (select distinct {TS_OF_STAMP} as ts from v7)
select ts from (select unnest(generate_series((select min(ts) from h), (select max(ts) from h),
                                              interval 1 hour)) as ts)
where ts not in (select ts from h)""")
def q_missing_files(spark, sf):
    """Expected hourly files that are not there."""
    return G.missing_hours(PC.file_hours(spark, staged_v7(spark, sf)))


@register("page_links", r"""select page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as name from pages""")
def q_page_links(spark, sf):
    return MF.links(B.table(spark, sf, "pages"))


# ----------------------------------------------------------------------------
# Structured Streaming (R1-R6): results after an availableNow run

STREAM_DELAY_HOURS = 3
V7_CLOSED = f"""{V7} {parsed_sql('v7', 'doc_id, stamp')}
, closed as (select title, {TS_OF_STAMP} as ts, sum(views)::BIGINT as views from parsed
  where status = 'ok' and {TS_OF_STAMP} + interval 1 hour
        <= (select max({TS_OF_STAMP}) from v7) - interval {STREAM_DELAY_HOURS} hour
  group by 1, 2)"""


@register("stream_hourly", f"with {V7_CLOSED} select * from closed")
def q_stream_hourly(spark, sf):
    root = staged_v7(spark, sf)
    out, chk = fresh_path(spark, "stream_out"), fresh_path(spark, "stream_chk")
    counts = HS.hourly_counts_stream(HS.line_stream(spark, root), delay=f"{STREAM_DELAY_HOURS} hours")
    HS.run_to_parquet(counts, out, chk)
    return spark.read.parquet(out)


@register("stream_merge", f"""with {V7_CLOSED}
, d as (select title, strftime(ts, '%Y%m%d') as dt, sum(views)::BIGINT as views from closed group by 1, 2)
select title, '[' || string_agg(dt, ',' order by dt) || ']' as dates,
  '[' || string_agg(views::VARCHAR, ',' order by dt) || ']' as pageviews,
  sum(views)::BIGINT as total_pageviews from d group by title""")
def q_stream_merge(spark, sf):
    root = staged_v7(spark, sf)
    mroot, chk = fresh_path(spark, "merge_root"), fresh_path(spark, "merge_chk")
    counts = HS.hourly_counts_stream(HS.line_stream(spark, root), delay=f"{STREAM_DELAY_HOURS} hours")
    HS.run_merge(counts, mroot, chk)
    t = HS.latest_version(spark, mroot)
    return t.select("title", S.json_array_text("dates").alias("dates"),
                    S.json_array_text("pageviews").alias("pageviews"), "total_pageviews")


# ----------------------------------------------------------------------------
# User-code surface (Z1, Z3) and the optional behaviours (D5 gap filling,
# D6 keep_new, D4 strict extension rule)


@register("rank_script", f"""with {V8_ID} {rank_sql_key('merged', 'page_id')}
select page_id, total_pageviews, monthly_trend, daily_trend, error from ranked""")
def q_rank_script(spark, sf):
    """The ranking rule as a user pandas script over timeline batches."""
    hist, new = split_history(v8_page_counts(spark, sf), v8(spark, sf))
    m = TL.merge_timelines(TL.timelines_from_counts(hist), new)
    return rounded_rank(U.script_transform(m, U.rank_batch, U.RANK_SCHEMA))


@register("title_rule", f"""with {V7} {parsed_sql('v7', 'doc_id, stamp')}
select p.doc_id, p.title, p.views from parsed p where status = 'ok' and length(page) <= 8""")
def q_title_rule(spark, sf):
    return X.accepted_lines(v7_lines(spark, sf), keep=["doc_id"], extra_rule=lambda pg: F.length(pg) <= 8)


@register("strict_ext", f"""with {V6}, {V6_PAGES} select doc_id, page from v6p
where not regexp_matches(page, '\\.(jpg|gif|png|JPG|GIF|PNG|txt|ico)$')""")
def q_strict_ext(spark, sf):
    return v6_pages(spark, sf).where(~X.looks_like_file("page", strict=True))


@register("filled_trends", f"""with {V3}
, span as (select title, unnest(generate_series(min(strptime(dt, '%Y%m%d')), max(strptime(dt, '%Y%m%d')),
           interval 1 day)) as d from v3 group by title)
, v3f as (select s.title, strftime(s.d, '%Y%m%d') as dt, coalesce(v3.views, 0)::BIGINT as views
          from span s left join v3 on v3.title = s.title and v3.dt = strftime(s.d, '%Y%m%d'))
{trend_sql('v3f')} select * from trend""")
def q_filled_trends(spark, sf):
    return T.trend_table(G.fill_gaps(v3(spark, sf)))


@register("timeline_merge_keep_new", f"""with {V8_ID}
select page_id, '[' || string_agg(dt, ',' order by dt) || ']' as dates,
  '[' || string_agg(views::VARCHAR, ',' order by dt) || ']' as pageviews,
  sum(views)::BIGINT as total_pageviews from cid group by page_id""")
def q_timeline_merge_keep_new(spark, sf):
    # most of the history is the new batch, so many pages enter without any
    hist, new = split_history(v8_page_counts(spark, sf), v8(spark, sf), days=1500)
    m = TL.merge_timelines(TL.timelines_from_counts(hist), new, keep_new=True)
    return m.select("page_id", S.json_array_text("dates").alias("dates"),
                    S.json_array_text("pageviews").alias("pageviews"), "total_pageviews")


@register("unmatched_titles", f"""with {V8}, {V5}
select title, dt, views from v8 where not exists (select 1 from lookup l where l.redirect_title = v8.title)""")
def q_unmatched_titles(spark, sf):
    return L.unmatched_titles(v8(spark, sf), v5_lookup(spark, sf))


# ----------------------------------------------------------------------------
# More sink paths: bounded single-file export (S14, S17), documents from the
# trend-line text (S8 -> W-docs, X21), streamed documents
TOP30 = f"""with {V8}
, recent as (select * from v8 where strptime(dt, '%Y%m%d')::DATE >
               (select max(strptime(dt, '%Y%m%d'))::DATE from v8) - 30)
{rank_sql('recent')}
select *, row_number() over (order by monthly_trend desc, total_pageviews desc, title)::INTEGER as rank
from (select * from ranked order by monthly_trend desc, total_pageviews desc, title limit 10)"""


@register("report_export", TOP30)
def q_report_export(spark, sf):
    """The top-30-days report (at most N rows, so one file is safe) exported
    as one tab-separated file and read back."""
    path = fresh_path(spark, "report")
    top = rounded_rank(top_30d(spark, sf))
    TT.write_delimited(top, path, sep="\t", single_file=True)
    return TT.read_delimited(spark, path, "title string, total_pageviews bigint, n bigint, "
                             "monthly_trend double, daily_trend double, error double, rank int",
                             sep="\t")


@register("search_docs_from_lines", f"with {V3} {trend_sql('v3')} {DOCS_SQL}")
def q_search_docs_from_lines(spark, sf):
    path = fresh_path(spark, "trendlines")
    TLN.write_trend_lines(T.trend_table(v3(spark, sf)), path)
    series = TLN.read_trend_lines(spark, path).where(~F.col("bad"))
    return D.documents_from_series(series)


@register("filled_docs_from_lines", f"""with {V3}
, span as (select title, unnest(generate_series(min(strptime(dt, '%Y%m%d')), max(strptime(dt, '%Y%m%d')),
           interval 1 day)) as d from v3 group by title)
, v3f as (select s.title, strftime(s.d, '%Y%m%d') as dt, coalesce(v3.views, 0)::BIGINT as views
          from span s left join v3 on v3.title = s.title and v3.dt = strftime(s.d, '%Y%m%d'))
{trend_sql('v3f')} {DOCS_SQL}""")
def q_filled_docs_from_lines(spark, sf):
    """Series with zero counts (trends that are NULL) through the text."""
    path = fresh_path(spark, "trendlines")
    TLN.write_trend_lines(T.trend_table(G.fill_gaps(v3(spark, sf))), path)
    return D.documents_from_series(TLN.read_trend_lines(spark, path).where(~F.col("bad")))


@register("stream_docs", f"""with {V7_CLOSED}
, d as (select title, strftime(ts, '%Y%m%d') as dt, sum(views)::BIGINT as views from closed group by 1, 2)
{trend_sql('d')} {DOCS_SQL}""")
def q_stream_docs(spark, sf):
    root = staged_v7(spark, sf)
    mroot, chk = fresh_path(spark, "merge_root"), fresh_path(spark, "merge_chk")
    counts = HS.hourly_counts_stream(HS.line_stream(spark, root), delay=f"{STREAM_DELAY_HOURS} hours")
    HS.run_merge(counts, mroot, chk)
    docs = SD.read_search_docs(spark, f"{mroot}/docs")
    # the newest version of every document id (R6: ids are idempotent)
    w = Window.partitionBy("_id").orderBy(F.col("version").desc())
    return (docs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
                .drop("_r", "version"))


# ----------------------------------------------------------------------------
# Late lines, compaction and trend tails of the stream (R3-R5): the files come
# in several runs, and the result is that of one run over all of them

MERGED_DAYS = f"""with {V7_CLOSED}
, d as (select title, strftime(ts, '%Y%m%d') as dt, sum(views)::BIGINT as views from closed group by 1, 2)"""
STREAM_TIMELINES = MERGED_DAYS + """
select title, '[' || string_agg(dt, ',' order by dt) || ']' as dates,
  '[' || string_agg(views::VARCHAR, ',' order by dt) || ']' as pageviews,
  sum(views)::BIGINT as total_pageviews from d group by title"""


def store_runs(spark, sf, runs, after=None) -> "ST.StreamStore":
    """Feed a store from the files of V7: a run for each condition on the stamp."""
    files, store = fresh_path(spark, "v7files"), ST.StreamStore(fresh_path(spark, "store"), delay_hours=STREAM_DELAY_HOURS)
    checkpoint = fresh_path(spark, "store_chk")
    for condition in runs:
        staged_v7(spark, sf, files, condition)
        ST.run_store(HS.line_stream(spark, files), store, checkpoint)
        if after:
            after(store)
    return store


def store_timelines(spark, store) -> DataFrame:
    return store.timelines(spark, store.version(spark)).select(
        "title", S.json_array_text("dates").alias("dates"), S.json_array_text("pageviews").alias("pageviews"), "total_pageviews")


DAY_OF_STAMP = "cast(substring(stamp, 7, 2) as int)"


@register("stream_late", STREAM_TIMELINES)
def q_stream_late(spark, sf):
    """Every third day's files come in a second run, long after their hours closed."""
    return store_timelines(spark, store_runs(spark, sf, [f"{DAY_OF_STAMP} % 3 <> 1", f"{DAY_OF_STAMP} % 3 = 1"]))


@register("stream_compacted", STREAM_TIMELINES)
def q_stream_compacted(spark, sf):
    """Compaction and expiry after every run."""
    def tidy(store):
        store.expire(spark, store.compact(spark))
    return store_timelines(spark, store_runs(spark, sf, [f"{DAY_OF_STAMP} <= 20", f"{DAY_OF_STAMP} > 20"], tidy))


@register("stream_tail_trends", f"{MERGED_DAYS} {trend_sql('d')} select title, dt, views, idx::BIGINT as idx, daily_trend, "
          "weekly_trend_at, monthly_trend_at, weekly_trend, monthly_trend from trend")
def q_stream_tail_trends(spark, sf):
    """Trends of each run from the tails that the runs before it left."""
    store = store_runs(spark, sf, [f"{DAY_OF_STAMP} <= 24", f"{DAY_OF_STAMP} > 24"])
    return store.trends(spark, store.version(spark))


# ----------------------------------------------------------------------------
# Declared tables and INSERT OVERWRITE (S11, S13), text history (X12, W8),
# co-bucketed merge (L7), script over lines (Z1), exclusion table (F8),
# pattern search by an index (T4)

MERGED_TEXT = f"""with {V8_ID}
select page_id, '[' || string_agg(dt, ',' order by dt) || ']' as dates,
  '[' || string_agg(views::VARCHAR, ',' order by dt) || ']' as pageviews,
  sum(views)::BIGINT as total_pageviews from merged group by page_id"""


def timeline_text(timelines: DataFrame) -> DataFrame:
    return timelines.select("page_id", S.json_array_text("dates").alias("dates"),
                            S.json_array_text("pageviews").alias("pageviews"), "total_pageviews")


@register("table_overwrite", MERGED_TEXT)
def q_table_overwrite(spark, sf):
    """The merge job on its declared tables: counts and lookup are loaded, the
    day counts by page replace those of an earlier run, and the timelines are
    replaced by their merge with them, which reads them."""
    root = fresh_path(spark, "warehouse")
    tables = CT.create_tables(spark, "tl_" + root.rsplit("-", 1)[1], root)
    old, new = split_history(v8(spark, sf), v8(spark, sf))
    raw = lambda df: df.select(F.col("title").alias("redirect_title"), F.col("dt").alias("dates"),
                               F.col("views").alias("pageviews"))
    CT.insert_overwrite(v5_lookup(spark, sf), tables["redirect_table"])
    lookup = spark.table(tables["redirect_table"])
    CT.insert_overwrite(timeline_text(TL.timelines_from_counts(MR.page_day_counts(old, lookup))), tables["daily_timelines"])
    for counts in (old, new):  # the second load replaces the first
        CT.insert_overwrite(raw(counts), tables["raw_daily_pagecounts_table"])
        CT.insert_overwrite(spark.table(tables["raw_daily_pagecounts_table"]).join(lookup, "redirect_title"),
                            tables["daily_pagecounts_table"])
    days = spark.table(tables["daily_pagecounts_table"]).select(
        "page_id", F.col("dates").alias("dt"), F.col("pageviews").cast("bigint").alias("views"))
    CT.replace_from(spark, tables["daily_timelines"],
                    lambda t: timeline_text(TL.merge_timelines(TL.parse_timelines(t), days)), root)
    return spark.table(tables["daily_timelines"])


def text_history(spark, sf):
    """The timelines as delimited text, in which the lines of pages that end in
    3 occur a second time, cut short; and the new counts."""
    hist, new = split_history(stored_counts(spark, sf), v8(spark, sf))
    text = timeline_text(TL.timelines_from_counts(hist))
    cut = text.where("page_id % 10 = 3").withColumn("dates", F.expr("left(dates, length(dates) - 1)"))
    path = fresh_path(spark, "timelines_txt")
    TT.write_delimited(text.unionByName(cut), path, sep="|")
    rows = TT.read_delimited(spark, path, "page_id bigint, dates string, pageviews string, total_pageviews string", sep="|")
    return (*TL.split_corrupt(rows), new)


@register("timeline_merge_text", MERGED_TEXT)
def q_timeline_merge_text(spark, sf):
    good, _, new = text_history(spark, sf)
    return timeline_text(TL.merge_timelines(good, new))


@register("timeline_corrupt", f"""with {V8_ID}
select page_id, sum(views)::BIGINT as total_pageviews, 0.0::DOUBLE as monthly_trend, 0.0::DOUBLE as daily_trend,
  0.0::DOUBLE as error from hist where page_id % 10 = 3 group by page_id""")
def q_timeline_corrupt(spark, sf):
    """Rows that do not parse score zero and keep their total."""
    _, bad, _ = text_history(spark, sf)
    return RK.rank_arrays(TL.parse_timelines(bad)).select("page_id", "total_pageviews", "monthly_trend", "daily_trend", "error")


def stored_timelines(spark, sf, buckets: int) -> tuple[DataFrame, DataFrame]:
    """History bucketed and sorted by page, and the new counts."""
    hist, new = split_history(stored_counts(spark, sf), v8(spark, sf))
    path = fresh_path(spark, "timelines")
    name = "tl_timelines_" + path.rsplit("-", 1)[1]
    CT.save_table(TL.timelines_from_counts(hist).repartition(buckets, "page_id"), name, bucket_by=(buckets, "page_id"), path=path)
    return spark.table(name), new


@register("timeline_merge_bucketed", MERGED_TEXT)
def q_timeline_merge_bucketed(spark, sf):
    """The history stays where it is: as many buckets as a shuffle has
    partitions, so only the new counts move to them."""
    hist, new = stored_timelines(spark, sf, max(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return timeline_text(TL.merge_timelines(hist, new))


@register("rank_transform", f"""with {V8_ID} {rank_sql_key('merged', 'page_id')}
select page_id, total_pageviews, monthly_trend, daily_trend, error from ranked""")
def q_rank_transform(spark, sf):
    """The ranking rule as an external script over tab-separated lines."""
    hist, new = split_history(v8_page_counts(spark, sf), v8(spark, sf))
    m = timeline_text(TL.merge_timelines(TL.timelines_from_counts(hist), new))
    return rounded_rank(U.line_transform(m, U.RANK_LINES, U.RANK_SCHEMA))


@register("blacklist_table", f"""with {V8}, {V5}
select title, dt, views from v8 where title not in (select rd_title from v5r)""")
def q_blacklist_table(spark, sf):
    """F8: the counts without the titles that redirects point to."""
    return X.exclude_titles(v8(spark, sf), B.wiki_redirect(spark, sf), excluded="rd_title")


def indexed_trends(spark, sf) -> tuple[DataFrame, str]:
    """The trends of V8 stored by title, and the index of their titles."""
    path = fresh_path(spark, "trends")
    name = "tl_search_" + path.rsplit("-", 1)[1]
    CT.save_table(T.trend_table(v8(spark, sf)), name, bucket_by=(16, "title"), path=f"{path}/trends")
    return spark.table(name), TI.write_title_index(spark.table(name), f"{name}_grams", path)


@register("trend_search_pattern", f"with {V8} {trend_sql('v8')} select * from trend "
          "where regexp_matches(title, '^Customer_0+[1-9]?77$')")
def q_trend_search_pattern(spark, sf):
    return TI.trend_search_indexed(*indexed_trends(spark, sf), "^Customer_0+[1-9]?77$")


# ----------------------------------------------------------------------------
# Metrics observed on the write (S24), seasonal forecast (M1), the connector

@register("load_stats_observed", f"""with {V7} {parsed_sql('v7', 'doc_id, stamp')}
select count(*)::BIGINT as lines, count(*) filter (where status = 'ok')::BIGINT as accepted,
  sum(views) filter (where status = 'ok')::BIGINT as views from parsed""")
def q_load_stats_observed(spark, sf):
    """The write of the accepted lines counts what it reads."""
    parsed, seen = C.observed(v7_parsed(spark, sf), "load")
    parsed.where("status = 'ok'").select("title", "views", "stamp").write.parquet(fresh_path(spark, "accepted"))
    got = seen.get
    return spark.createDataFrame([(got["lines"], got["accepted"], got["views"])], "lines bigint, accepted bigint, views bigint")


SEASONAL = f"""with recursive {V1}
, pts as (select title, views::DOUBLE as y, (row_number() over (partition by title order by dt) - 1)::INTEGER as i from v1)
, fold as (
  select title, 0 as i, y as level, [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]::DOUBLE[] as s, 0.0::DOUBLE as off from pts where i = 0
  union all
  select f.title, f.i + 1, f.level + 0.3::DOUBLE * e, list_transform(range(1, 8), lambda k:
      case when k = f.i % 7 + 1 then f.s[k] + (0.2::DOUBLE * (1 - 0.3::DOUBLE)) * e else f.s[k] end),
    f.off + case when f.i >= 7 then abs(e) else 0.0 end
  from fold f join lateral (select y - f.level - f.s[f.i % 7 + 1] as e from pts where pts.title = f.title and pts.i = f.i) p on true)
, done as (select f.* from fold f join (select title, count(*) as n from pts group by title) c on c.title = f.title and c.n = f.i)
select title, i::BIGINT as n, round(level, {FIT_DECIMALS}) as level, round(off / (i - 7), {FIT_DECIMALS}) as error,
  round(level + s[i % 7 + 1], {FIT_DECIMALS}) as forecast_1, round(level + s[(i + 6) % 7 + 1], {FIT_DECIMALS}) as forecast_7
from done"""


@register("forecast_seasonal", SEASONAL)
def q_forecast_seasonal(spark, sf):
    f = M.seasonal_forecast(v1(spark, sf), horizons=(1, 7))
    return f.select("title", "n", *[F.round(c, FIT_DECIMALS).alias(c) for c in ("level", "error", "forecast_1", "forecast_7")])


@register("publish_connector", f"with {V3} {trend_sql('v3')} {DOCS_SQL}")
def q_publish_connector(spark, sf):
    """All documents, with other counts on the even days, then the documents of
    the even days again: each id holds what was sent last."""
    root = fresh_path(spark, "doc_store")
    docs = D.search_documents(T.trend_table(v3(spark, sf)))
    even = F.day("page_date") % 2 == 0
    DS.publish(docs.withColumn("page_views", F.when(even, F.col("page_views") + 1000).otherwise(F.col("page_views"))), root)
    DS.publish(docs.where(even), root)
    return DS.read_docs(spark, root)


@register("file_regex", f"with {V4} select value, stamp from v4 where regexp_matches(stamp, '^2015030[12](0[0-9]|1[0-2])')")
def q_file_regex(spark, sf):
    """Files chosen by a regex on their names."""
    root = staged(spark, v4_lines(spark, sf), "v4files")
    return PC.read_pagecounts(spark, root, name_regex="pagecounts-2015030[12]-(0[0-9]|1[0-2])").select("value", "stamp")
