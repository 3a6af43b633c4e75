"""The same queries in SQL for another engine, written from the semantics.

Nothing here is derived from the DataFrame code: session reports are put
together from separate counts with outer joins.
"""

# ------------------------------------------------------------------ input views

EVENTS = """
ga4 AS (
  SELECT
    CASE WHEN event_id % 97 <> 0 THEN strftime(ts, '%Y%m%d') END AS event_date,
    CASE event_type
      WHEN 'view' THEN 'page_view'
      WHEN 'signup' THEN 'session_start'
      WHEN 'click' THEN 'user_engagement'
      ELSE event_type
    END AS event_name,
    CASE WHEN event_id % 89 <> 0 THEN user_id END AS session_id,
    CASE WHEN event_type = 'view' AND event_id % 83 = 0 THEN 'camp_unstarted'
         WHEN k % 5 <> 0 THEN 'camp_' || (k % 5) END AS campaign,
    CASE WHEN user_id % 7 <> 0 THEN 'src_' || (user_id % 7) END AS source,
    CASE user_id % 3
      WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet'
    END AS device,
    CASE event_id % 4
      WHEN 0 THEN list_slice([item0], 2, 1)
      WHEN 1 THEN [item0]
      WHEN 2 THEN [item0, item7]
    END AS items
  FROM (
    SELECT
      *,
      CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
      {'item_name': 'sku_' || (event_id % 20),
       'quantity': CASE WHEN event_id % 11 <> 0
                        THEN 1 + event_id % 3 END} AS item0,
      {'item_name': 'sku_' || ((event_id + 7) % 20),
       'quantity': CASE WHEN (event_id + 7) % 11 <> 0
                        THEN 1 + (event_id + 7) % 3 END} AS item7
    FROM events
  )
)"""


def _grouped(number: str) -> str:
    return (
        f"CASE WHEN {number} < 1000 THEN CAST({number} AS VARCHAR)"
        f" ELSE ({number} // 1000) || chr(8239)"
        f" || lpad(CAST({number} % 1000 AS VARCHAR), 3, '0') END"
    )


HISTORY = f"""
ua AS (
  SELECT
    strftime(o_orderdate, '%Y-%m-%d') AS date,
    CASE WHEN o_custkey % 5 <> 0 THEN 'camp_' || (o_custkey % 5) END AS campaign,
    CASE WHEN o_custkey % 7 <> 0 THEN 'src_' || (o_custkey % 7) END AS source,
    CASE WHEN o_custkey % 7 <> 0
      THEN 'src_' || (o_custkey % 7) END AS channelgrouping,
    CASE o_custkey % 3
      WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet'
    END AS device,
    'sku_' || (o_custkey % 20) AS product,
    {_grouped('n')} AS sessions,
    {_grouped('(2 * n)')} AS pageviews,
    {_grouped('n')} AS unique_purchases,
    {_grouped('(3 * n)')} AS product_revenue,
    CASE o_orderkey % 6
      WHEN 0 THEN '<0.01%' WHEN 1 THEN '0,4567' WHEN 2 THEN '0.45'
      WHEN 3 THEN '(not set)' WHEN 4 THEN ''
    END AS bounce_rate
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS n FROM orders)
)"""

DAY = "CAST(strptime(event_date, '%Y%m%d') AS DATE)"


def _clean(column: str, dtype: str) -> str:
    return f"CAST(replace({column}, chr(8239), '') AS {dtype}) AS {column}"


# The pattern, the text for a tiny share and its value.
SHARE = """CAST(
    CASE WHEN regexp_matches(bounce_rate, '^[0-9.,<%]+$')
         THEN replace(replace(bounce_rate, '<0.01%', '0.0001'), ',', '.')
         ELSE '0' END AS DOUBLE)"""

# --------------------------------------------------------------- event aggregates


def _list(*columns: str | None) -> str:
    return ", ".join(c for c in columns if c)


def _count_of(event: str, dim: str | None, field: str | None) -> str:
    picked = f"{field} AS {dim}" if dim else None
    return (
        f"SELECT {_list(f'{DAY} AS date', picked, 'count(*) AS total')}"
        f" FROM ga4 WHERE event_name = '{event}' GROUP BY ALL"
    )


def _visits(dim: str | None, field: str | None) -> str:
    picked = f"{field} AS {dim}" if dim else None
    return f"""
  SELECT
    {_list(f'{DAY} AS date', 'session_id', picked)},
    count(*) FILTER (WHERE event_name = 'page_view') AS views,
    count(*) FILTER (WHERE event_name = 'user_engagement') AS engagements
  FROM ga4
  WHERE event_name = 'page_view' OR event_name = 'user_engagement'
  GROUP BY ALL"""


def _rates(dim: str | None) -> str:
    bounced = "views = 1 AND engagements = 0"
    return f"""
  SELECT
    {_list('date', dim)},
    count(*) FILTER (WHERE {bounced}) / count(*) AS bounce_rate
  FROM visits GROUP BY ALL"""


def _session_ctes(dim: str | None, field: str | None) -> str:
    return f"""
starts AS ({_count_of('session_start', dim, field)}),
views AS ({_count_of('page_view', dim, field)}),
visits AS ({_visits(dim, field)}),
rates AS ({_rates(dim)})"""


def _session_select(dim: str | None, label: str) -> str:
    keys = _list("date", dim)
    return f"""
SELECT
  {keys}, starts.total AS sessions, coalesce(views.total, 0) AS pageviews,
  coalesce(rates.bounce_rate, 0) * 100 AS bounce_rate, 'GA4' AS {label}
FROM starts
LEFT JOIN views USING ({keys})
LEFT JOIN rates USING ({keys})"""


def _ua_session_select(dim: str | None, label: str, scale: str) -> str:
    return f"""
SELECT
  {_list('CAST(date AS DATE) AS date', dim)},
  {_clean('sessions', 'BIGINT')}, {_clean('pageviews', 'BIGINT')},
  {SHARE} {scale} AS bounce_rate, 'UA' AS {label}
FROM ua"""


PURCHASES = f"""
bought AS (
  SELECT {DAY} AS date, session_id, i.item_name AS product, i.quantity AS quantity
  FROM (SELECT * FROM ga4 WHERE event_name = 'purchase') AS p,
       unnest(p.items) AS u(i)
)"""

GA4_PRODUCTS = """
SELECT date, product, count(DISTINCT session_id) AS unique_purchases,
  CAST(sum(quantity) AS BIGINT) AS product_revenue, 'GA4' AS source_type
FROM bought GROUP BY date, product"""

UA_PRODUCTS = f"""
SELECT CAST(date AS DATE) AS date, product,
  {_clean('unique_purchases', 'DOUBLE')}, {_clean('product_revenue', 'DOUBLE')},
  'UA' AS source_type
FROM ua"""

# Report -> (dimension, event field, label column, history scale).
SESSION_REPORTS = {
    "traffic": (None, None, "source", "* 100"),
    "campaign": ("campaign", "campaign", "source_type", "* 100"),
    "channelgrouping": ("channelgrouping", "source", "source", "* 10"),
    "sources": ("source", "source", "source_type", "* 100"),
    "device": ("device", "device", "source", "/ 100"),
}


REPORT_NAMES = (*SESSION_REPORTS, "ecommerce")


def _with(*parts: str) -> str:
    *ctes, select = parts
    return "WITH " + ",".join(ctes) + select


def _report_queries() -> dict[str, str]:
    out = {}
    for name, (dim, field, label, scale) in SESSION_REPORTS.items():
        ctes = _session_ctes(dim, field)
        recent = _session_select(dim, label)
        older = _ua_session_select(dim, label, scale)
        out[f"ga4_{name}"] = _with(EVENTS, ctes, recent)
        out[f"ua_{name}"] = _with(HISTORY, older)
        out[f"report_{name}"] = _with(
            EVENTS, HISTORY, ctes, recent + "\nUNION ALL" + older
        )
    out["ga4_ecommerce"] = _with(EVENTS, PURCHASES, GA4_PRODUCTS)
    out["ua_ecommerce"] = _with(HISTORY, UA_PRODUCTS)
    out["report_ecommerce"] = _with(
        EVENTS, HISTORY, PURCHASES, GA4_PRODUCTS + "\nUNION ALL" + UA_PRODUCTS
    )
    return out


def _all_session_reports() -> str:
    branches = []
    for name in ("traffic", "campaign", "sources", "device"):
        dim, field, label, _ = SESSION_REPORTS[name]
        one = _with(_session_ctes(dim, field), _session_select(dim, label))
        kind = f"'{dim or 'total'}'"
        value = dim or "CAST(NULL AS VARCHAR)"
        branches.append(
            f"SELECT {kind} AS dimension, {value} AS value, date, sessions,"
            f" pageviews, bounce_rate FROM ({one})"
        )
    return _with(EVENTS, "\n" + "\nUNION ALL\n".join(branches))


def oracle_queries() -> dict[str, str]:
    reports = _report_queries()
    campaign = ("campaign", "campaign")

    def bounce(scale: str) -> str:
        return _with(
            HISTORY,
            f"\nSELECT bounce_rate AS text, {SHARE} {scale} AS bounce_rate FROM ua",
        )

    return {
        **reports,
        "ga4_all_session_reports": _all_session_reports(),
        "sink_replace_table": reports["report_traffic"],
        **{f"refresh_{name}": reports[f"report_{name}"] for name in REPORT_NAMES},
        "order_report": reports["report_campaign"] + "\nORDER BY date, campaign",
        "union_all_widen": reports["report_ecommerce"],
        "left_join_date": reports["ga4_traffic"],
        "left_join_date_dim": reports["ga4_campaign"],
        "scan_ga4_events": _with(
            EVENTS,
            """
SELECT event_date, event_name, session_id, campaign, source, device,
  coalesce(len(items), -1) AS item_count
FROM ga4""",
        ),
        "scan_ua_history": _with(HISTORY, "\nSELECT * FROM ua"),
        "struct_field_access": _with(
            EVENTS, "\nSELECT event_name, campaign, source, device FROM ga4"
        ),
        "filter_event_in": _with(
            EVENTS,
            """
SELECT event_date, event_name, session_id FROM ga4
WHERE event_name IN ('session_start', 'page_view', 'user_engagement')""",
        ),
        "event_flags": _with(
            EVENTS,
            """
SELECT event_name, session_id,
  CAST(event_name = 'page_view' AS INTEGER) AS is_page_view,
  CAST(event_name = 'session_start' AS INTEGER) AS is_session_start,
  CAST(event_name = 'purchase' AS INTEGER) AS is_purchase
FROM ga4""",
        ),
        "parse_event_date": _with(
            EVENTS, f"\nSELECT event_date, {DAY} AS date FROM ga4"
        ),
        "unnest_items": _with(
            EVENTS,
            """
SELECT event_date, session_id, i.item_name AS product, i.quantity AS quantity
FROM (SELECT * FROM ga4 WHERE event_name = 'purchase') AS p,
     unnest(p.items) AS u(i)""",
        ),
        "session_counts": _with(
            EVENTS,
            f"""
SELECT date, campaign, total AS sessions
FROM ({_count_of('session_start', *campaign)})""",
        ),
        "pageview_counts": _with(
            EVENTS,
            f"""
SELECT date, campaign, total AS pageviews
FROM ({_count_of('page_view', *campaign)})""",
        ),
        "coalesce_zero": _with(
            EVENTS,
            _session_ctes(*campaign),
            """
SELECT date, campaign, coalesce(views.total, 0) AS pageviews
FROM starts LEFT JOIN views USING (date, campaign)""",
        ),
        "count_if_events": _with(
            EVENTS,
            f"""
SELECT {DAY} AS date,
  count(*) FILTER (WHERE event_name = 'page_view') AS page_views,
  count(*) FILTER (WHERE event_name = 'user_engagement') AS engagements
FROM ga4 GROUP BY ALL""",
        ),
        "session_metrics": _with(EVENTS, _visits(*campaign)),
        "bounce_rate": _with(
            EVENTS, f"\nvisits AS ({_visits(*campaign)})", _rates("campaign")
        ),
        "count_distinct_purchases": _with(
            EVENTS,
            PURCHASES,
            """
SELECT date, product, count(DISTINCT session_id) AS unique_purchases
FROM bought GROUP BY date, product""",
        ),
        "sum_quantity": _with(
            EVENTS,
            PURCHASES,
            """
SELECT date, product, CAST(sum(quantity) AS BIGINT) AS product_revenue
FROM bought GROUP BY date, product""",
        ),
        "cast_ua_date": _with(
            HISTORY,
            """
SELECT date AS text, CAST(date AS DATE) AS date, CAST(date AS DATE) AS day_of_time
FROM ua""",
        ),
        "strip_nnbsp": _with(
            HISTORY,
            """
SELECT replace(sessions, chr(8239), '') AS sessions,
  replace(product_revenue, chr(8239), '') AS product_revenue
FROM ua""",
        ),
        "clean_int": _with(
            HISTORY,
            f"""
SELECT {_clean('sessions', 'BIGINT')}, {_clean('pageviews', 'BIGINT')} FROM ua""",
        ),
        "clean_double": _with(
            HISTORY,
            f"""
SELECT {_clean('unique_purchases', 'DOUBLE')},
  {_clean('product_revenue', 'DOUBLE')} FROM ua""",
        ),
        "regexp_guard": _with(
            HISTORY,
            """
SELECT bounce_rate,
  regexp_matches(bounce_rate, '^[0-9.,<%]+$') AS number_like
FROM ua""",
        ),
        "parse_ua_bounce_x100": bounce("* 100"),
        "parse_ua_bounce_x10": bounce("* 10"),
        "parse_ua_bounce_div100": bounce("/ 100"),
    }
