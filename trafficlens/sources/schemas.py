"""Declared tables of the merge job (S11): names, columns and separators are
fixed values of the data model."""

# name: (columns, field separator of its text form)
TABLES = {
    "raw_daily_pagecounts_table": ("redirect_title STRING, dates STRING, pageviews STRING", "|"),
    "daily_pagecounts_table": ("page_id BIGINT, dates STRING, pageviews STRING", "|"),
    "redirect_table": ("redirect_title STRING, true_title STRING, page_id BIGINT, page_latest BIGINT", "|"),
    "pages": ("page_id BIGINT, url STRING, title STRING, page_latest BIGINT, total_pageviews BIGINT, "
              "monthly_trend DOUBLE", "|"),
    "daily_timelines": ("page_id BIGINT, dates STRING, pageviews STRING, total_pageviews BIGINT", "|"),
    "new_daily_timelines": ("page_id BIGINT, dates STRING, pageviews STRING, total_pageviews BIGINT", "|"),
    "new_pages_raw": ("page_id BIGINT, total_pageviews BIGINT, monthly_trend DOUBLE, daily_trend DOUBLE, "
                      "error DOUBLE", "|"),
    "new_pages": ("page_id BIGINT, url STRING, title STRING, page_latest BIGINT, total_pageviews BIGINT, "
                  "monthly_trend DOUBLE", "\t"),
    "new_daily_trends": ("page_id BIGINT, trend DOUBLE, error DOUBLE", "\t"),
}
