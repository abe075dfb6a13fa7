"""DuckDB SQL for every query, written against the test tables and not against the library."""

from __future__ import annotations

VIEW_COLUMNS = """
    CASE WHEN user_id % 50 = 1 AND event_id % 4 = 3 THEN NULL
         WHEN event_id % 4 = 0 THEN CAST(user_id AS VARCHAR)
         ELSE user_id || '-' || (event_id % 4) END AS "Contract",
    CASE event_type
         WHEN 'view' THEN 'CHANNEL'
         WHEN 'click' THEN 'RELAX'
         WHEN 'signup' THEN 'CHILD'
         WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'VOD' ELSE 'FIMS' END
         WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 'KPLUS' WHEN 1 THEN 'SPORT' ELSE 'BHD' END
    END AS "AppName",
    value AS "TotalDuration"
"""

VIEW_LOG = f"""
view_log AS (
  SELECT {VIEW_COLUMNS}, strftime(ts, '%Y%m%d') AS "Date" FROM events
)"""

VIEW_LOG_WEEK = f"""
view_log AS (
  SELECT {VIEW_COLUMNS}, '2024010' || ((day(ts) - 1) % 7 + 1) AS "Date" FROM events
)"""

# The app codes, written out for the same reason.
VIEWS = """
typed AS (
  SELECT *,
    CASE WHEN "AppName" = 'CHANNEL' THEN 'Truyen_Hinh'
         WHEN "AppName" = 'RELAX' THEN 'Giai_Tri'
         WHEN "AppName" = 'CHILD' THEN 'Thieu_Nhi'
         WHEN "AppName" IN ('FIMS', 'VOD') THEN 'Phim_Truyen'
         WHEN "AppName" IN ('KPLUS', 'SPORT') THEN 'The_Thao'
         ELSE 'Other' END AS "Type"
  FROM view_log
),
valid AS (SELECT * FROM typed WHERE "Contract" <> '0' AND "Type" <> 'Other')"""


def _watched(category: str) -> str:
    return (
        f"""CAST(COALESCE(SUM(CAST("TotalDuration" AS DECIMAL(18,2))) """
        f"""FILTER (WHERE "Type" = '{category}'), 0) AS DOUBLE) AS "Total_{category}\""""
    )


# The categories in tie-break order; the columns of results carry their names.
WATCH = ["Giai_Tri", "Phim_Truyen", "The_Thao", "Thieu_Nhi", "Truyen_Hinh"]
SEARCH = ["TruyenHinh", "TheThao", "ThieuNhi", "Phim", "GiaiTri"]


def _largest(cols: list[str], labels: list[str]) -> str:
    best = f"GREATEST({', '.join(cols)})"
    return "CASE " + " ".join(f"WHEN {c} = {best} THEN '{x}'" for c, x in zip(cols, labels)) + " END"


_TOTALS = [f'"Total_{c}"' for c in WATCH]
_MOST = _largest(_TOTALS, WATCH)
_TASTE = (
    "COALESCE(NULLIF(CONCAT_WS('-', "
    + ", ".join(f"CASE WHEN {t} > 0 THEN '{c.replace('_', ' ')}' END" for t, c in zip(_TOTALS, WATCH))
    + "), ''), 'None')"
)

CONTENT = f"""
totals AS (
  SELECT "Contract", {', '.join(_watched(c) for c in WATCH)}, COUNT(DISTINCT "Date") AS "DayCount"
  FROM valid GROUP BY "Contract"
),
day_limit AS (
  SELECT CASE WHEN COUNT(DISTINCT "Date") <= 7 THEN 4 ELSE 15 END AS n FROM view_log
),
content AS (
  SELECT "Contract", {', '.join(_TOTALS)}, {_MOST} AS "MostWatch", {_TASTE} AS "Taste",
    CASE WHEN "DayCount" > (SELECT n FROM day_limit) THEN 'High' ELSE 'Low' END AS "Active"
  FROM totals
)"""

SEARCH_LOG = """
search_all AS (
  SELECT
    CASE WHEN l_linenumber = 4 AND l_orderkey % 5 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS "eventID",
    CASE WHEN o_custkey % 50 = 0 THEN '' WHEN o_custkey % 50 = 1 THEN NULL
         ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
    CASE l_partkey % 12 WHEN 0 THEN 'KÊNH VTV3' WHEN 1 THEN 'Bóng Đá U23' WHEN 2 THEN 'NARUTO tập 5'
         WHEN 3 THEN 'phim season 2' WHEN 4 THEN NULL WHEN 5 THEN 'ep.1' ELSE p_name END AS keyword,
    CASE l_returnflag WHEN 'A' THEN 'enter' WHEN 'R' THEN 'quit' END AS category,
    NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS platform,
    NULLIF(n_name, 'NATION_0') AS proxy_isp,
    CASE o_custkey % 4 WHEN 1 THEN CAST([] AS VARCHAR[]) WHEN 2 THEN [p_type || ':' || p_brand]
         WHEN 3 THEN [NULL, p_type || ':' || p_brand, p_brand] END AS "userPlansMap",
    strftime(DATE '2022-06-01' + CAST((date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) % 28) * 11 // 7 AS INTEGER),
             '%Y%m%d') AS "Date"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
search_log AS (SELECT * FROM search_all WHERE user_id IS NOT NULL AND user_id <> '')"""

# The keyword patterns, written out here so that the SQL stands on its own.
KEYWORD_CASE = r"""
    CASE WHEN regexp_matches(lower(keyword), 'kênh|vtv|htv|channel|trực tiếp|live tv') THEN 'TruyenHinh'
         WHEN regexp_matches(lower(keyword), 'bóng đá|u23|u20|ngoại hạng|running man|thể thao|sport|world cup|champion') THEN 'TheThao'
         WHEN regexp_matches(lower(keyword), 'siêu nhân|naruto|boruto|fairy tail|doraemon|conan|pokemon|hoạt hình|anime|thiếu nhi') THEN 'ThieuNhi'
         WHEN regexp_matches(lower(keyword), 'phim|tập \d|season|episode|ep\.|movie|drama') THEN 'Phim'
         ELSE 'GiaiTri' END AS "ContentType"
"""

BEHAVIOR = """
behavior AS (
  SELECT *, CAST(ROUND(CAST(CAST("SearchQuit" AS DOUBLE) / NULLIF("SearchCount", 0) AS DECIMAL(38,10)), 4) AS DOUBLE)
    AS "QuitRate"
  FROM (
    SELECT user_id, COUNT("eventID") AS "SearchCount", COUNT(DISTINCT keyword) AS "UniqueKeyword",
      COUNT(DISTINCT "Date") AS "SearchDays",
      COUNT(*) FILTER (WHERE category = 'enter') AS "SearchEnter",
      COUNT(*) FILTER (WHERE category = 'quit') AS "SearchQuit"
    FROM search_log GROUP BY user_id
  )
)"""

_INTERESTS = [f'"Interest_{c}"' for c in SEARCH]
INTEREST = f"""
interest AS (
  SELECT user_id, {', '.join(f'''COUNT(*) FILTER (WHERE "ContentType" = '{c}') AS "Interest_{c}"''' for c in SEARCH)}
  FROM (SELECT user_id, {KEYWORD_CASE} FROM search_log) GROUP BY user_id
)"""
_TOP = _largest(_INTERESTS, SEARCH)


def _main(column: str, alias: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT user_id, {column} AS "{alias}" FROM (
    SELECT user_id, {column}, COUNT(*) AS n FROM search_log WHERE {column} IS NOT NULL GROUP BY user_id, {column}
  ) QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n DESC, {column}) = 1
)"""


PLATFORM = _main("platform", "MainPlatform", "main_platform")
ISP = _main("proxy_isp", "MainISP", "main_isp")

EXPLODED = """
exploded AS (
  SELECT user_id, plan_raw, split_part(plan_raw, ':', 1) AS plan_name FROM (
    SELECT user_id, UNNEST(CASE WHEN "userPlansMap" IS NULL OR len("userPlansMap") = 0
                                THEN [NULL] ELSE "userPlansMap" END) AS plan_raw
    FROM search_log
  )
)"""

PLAN = f"""{EXPLODED},
first_plan AS (
  SELECT user_id, plan AS "PlanName" FROM (
    SELECT user_id, "Date", "eventID",
      split_part(list_filter("userPlansMap", lambda x: x IS NOT NULL)[1], ':', 1) AS plan
    FROM search_log
  ) WHERE plan IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY "Date", "eventID" NULLS LAST, plan) = 1
),
plans AS (
  SELECT user_id, "PlanName", "PlanCount", "PlanCount" > 0 AS "HasPlan"
  FROM (SELECT user_id, COUNT(plan_raw) AS "PlanCount" FROM exploded GROUP BY user_id)
  LEFT JOIN first_plan USING (user_id)
)"""

_SEARCH_COLUMNS = f"""
    user_id, "SearchCount", "UniqueKeyword", "SearchDays", "SearchEnter", "SearchQuit", "QuitRate",
    {', '.join(_INTERESTS)}, {_TOP} AS "TopInterest",
    COALESCE("MainPlatform", 'unknown') AS "MainPlatform", COALESCE("MainISP", 'unknown') AS "MainISP",
    COALESCE("PlanName", 'None') AS "PlanName", "PlanCount", "HasPlan",
    CASE WHEN "SearchDays" >= 4 THEN 'High' ELSE 'Low' END AS "SearchActive"
"""

SEARCHES = f"""{BEHAVIOR},{INTEREST},{PLATFORM},{ISP},{PLAN},
search AS (
  SELECT {_SEARCH_COLUMNS} FROM behavior JOIN interest USING (user_id) LEFT JOIN main_platform USING (user_id)
  LEFT JOIN main_isp USING (user_id) LEFT JOIN plans USING (user_id)
)"""


def _views(query: str, log: str = VIEW_LOG) -> str:
    return f"WITH {log},{VIEWS},{CONTENT} {query}"


def _searches(query: str) -> str:
    return f"WITH {SEARCH_LOG},{SEARCHES} {query}"


def _half_up(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _sum(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(28,6))) AS DOUBLE)"


def _avg(column: str, digits: int) -> str:
    return _half_up(f"{_sum(column)} / COUNT({column})", digits)


def _count(column: str, alias: str, source: str, exclude: str = "", k: int | None = None) -> str:
    where = f"""WHERE "{column}" <> '{exclude}'""" if exclude else ""
    limit = f"ORDER BY 2 DESC, 1 LIMIT {k}" if k else "ORDER BY 2 DESC, 1"
    return f"""SELECT "{column}" AS "{alias}", COUNT(*) AS "count" FROM {source} {where} GROUP BY 1 {limit}"""


_HOURS = ", ".join(f'{_half_up(_sum(t) + " / 3600", 1)} AS {c.lower()}_h' for t, c in zip(_TOTALS, WATCH))
# Names of the interest totals, and below the labels of charts and figures.
_SUM_NAMES = ["truyen_hinh", "the_thao", "thieu_nhi", "phim", "giai_tri"]
_SUMS = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {n}" for c, n in zip(_INTERESTS, _SUM_NAMES))

_TOP_CONTRACTS = f"""
SELECT "Contract" AS contract,
  {_half_up('("Total_Giai_Tri" + "Total_Phim_Truyen" + "Total_The_Thao" + "Total_Thieu_Nhi" + "Total_Truyen_Hinh") / 3600', 1)}
    AS total_hours,
  "MostWatch" AS "mostWatch", "Active" AS active, "Taste" AS taste
FROM content ORDER BY total_hours DESC, contract LIMIT 20"""

_TOP_USERS = f"""
SELECT user_id, "SearchCount", "UniqueKeyword", "SearchDays",
  {_half_up('CAST("QuitRate" AS DECIMAL(10,4)) * 100', 1)} AS quit_pct, "TopInterest", "MainPlatform", "SearchActive"
FROM search ORDER BY "SearchCount" DESC, user_id LIMIT 20"""

_SEARCH_KPI = f"""
SELECT COUNT(*) AS total_users, {_avg('"SearchCount"', 1)} AS avg_search_count,
  {_avg('"UniqueKeyword"', 1)} AS avg_unique_kw, {_avg('"QuitRate"', 4)} AS avg_quit_rate,
  COUNT(*) FILTER (WHERE "SearchActive" = 'High') AS high_active,
  COUNT(*) FILTER (WHERE "SearchActive" = 'Low') AS low_active,
  COUNT(*) FILTER (WHERE "HasPlan") AS has_plan, COUNT(*) FILTER (WHERE NOT "HasPlan") AS no_plan
FROM search"""


def _pct(condition: str) -> str:
    return f"FLOOR(CAST(COUNT(*) FILTER (WHERE {condition}) AS DOUBLE) / COUNT(*) * 100 + 0.5)"


def _cells(source: str, first: str, cells: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{first}' AS a, '{label}' AS b, CAST({value} AS DOUBLE) AS value FROM {source}" for label, value in cells
    )


_SHARES = _cells(
    "content",
    "content",
    [("high_active_pct", _pct("\"Active\" = 'High'")), ("categories", 'COUNT(DISTINCT "MostWatch")')],
) + " UNION ALL " + _cells(
    "search",
    "search",
    [
        ("high_active_pct", _pct("\"SearchActive\" = 'High'")),
        ("has_plan_pct", _pct('"HasPlan"')),
        ("avg_search_count", _avg('"SearchCount"', 1)),
        ("avg_unique_kw", _avg('"UniqueKeyword"', 1)),
        ("avg_quit_pct", _half_up(f"CAST({_avg(chr(34) + 'QuitRate' + chr(34), 4)} AS DECIMAL(10,4)) * 100", 1)),
        ("categories", 'COUNT(DISTINCT "TopInterest")'),
    ],
)

_LONG = " UNION ALL ".join(
    [
        _cells(
            "content",
            "watch_hours",
            list(
                zip(
                    ["Giải Trí", "Phim Truyện", "Thể Thao", "Thiếu Nhi", "Truyền Hình"],
                    [_half_up(_sum(t) + " / 3600", 1) for t in _TOTALS],
                )
            ),
        ),
        _cells(
            "content",
            "active",
            [
                ("High Active", "COUNT(*) FILTER (WHERE \"Active\" = 'High')"),
                ("Low Active", "COUNT(*) FILTER (WHERE \"Active\" = 'Low')"),
            ],
        ),
        _cells(
            "search",
            "interest",
            list(
                zip(
                    ["Truyền Hình", "Thể Thao", "Thiếu Nhi", "Phim", "Giải Trí"],
                    [f"SUM({c})" for c in _INTERESTS],
                )
            ),
        ),
        _cells(
            "search",
            "plan",
            [
                ("Có gói cước", 'COUNT(*) FILTER (WHERE "HasPlan")'),
                ("Không có gói", 'COUNT(*) FILTER (WHERE NOT "HasPlan")'),
            ],
        ),
    ]
)

_BOTH = f"WITH {VIEW_LOG},{VIEWS},{CONTENT},{SEARCH_LOG},{SEARCHES}"


def _ranked(table: str, order: str) -> str:
    rank = f"ROW_NUMBER() OVER (ORDER BY {order})"
    return f"SELECT *, {rank} AS rank, {rank} <= 3 AS is_top3 FROM ({table})"


# Another platform's rules, as in `checks.queries`.
_SCREEN = """CASE WHEN "AppName" IN ('CHANNEL', 'VOD') THEN 'Screen' ELSE 'Rest' END"""
_OTHER_VIEWS = f"""WITH {VIEW_LOG},
valid AS (
  SELECT *, {_SCREEN} AS "Type" FROM view_log
  WHERE "Contract" <> '1' AND "AppName" IN ('CHANNEL', 'VOD', 'RELAX', 'CHILD', 'BHD')),
totals AS (
  SELECT "Contract", {_watched("Screen")}, {_watched("Rest")}, COUNT(DISTINCT "Date") AS d FROM valid GROUP BY "Contract"),
day_limit AS (SELECT CASE WHEN COUNT(DISTINCT "Date") <= 7 THEN 1 ELSE 3 END AS n FROM view_log)
SELECT "Contract", "Total_Screen", "Total_Rest",
  CASE WHEN "Total_Screen" >= "Total_Rest" THEN 'Screen' ELSE 'Rest' END AS "MostWatch",
  CASE WHEN "Total_Screen" > 0 AND "Total_Rest" > 0 THEN 'Screen-Rest' WHEN "Total_Screen" > 0 THEN 'Screen'
       WHEN "Total_Rest" > 0 THEN 'Rest' ELSE 'None' END AS "Taste",
  CASE WHEN d > (SELECT n FROM day_limit) THEN 'High' ELSE 'Low' END AS "Active"
FROM totals"""

_OTHER_KINDS = ["News", "Letters", "None"]
_OTHER_COUNTS = [f'"Interest_{k}"' for k in _OTHER_KINDS]
_OTHER_SEARCHES = f"""WITH {SEARCH_LOG},{BEHAVIOR},{PLATFORM},{ISP},{PLAN},
interest AS (
  SELECT user_id, {', '.join(f"COUNT(*) FILTER (WHERE kind = '{k}') AS {c}" for k, c in zip(_OTHER_KINDS, _OTHER_COUNTS))}
  FROM (SELECT user_id, CASE WHEN regexp_matches(lower(keyword), 'vtv') THEN 'News'
          WHEN regexp_matches(lower(keyword), '[aeiou]{{2}}') THEN 'Letters' ELSE 'None' END AS kind FROM search_log)
  GROUP BY user_id)
SELECT user_id, "SearchCount", "UniqueKeyword", "SearchDays", "SearchEnter", "SearchQuit", "QuitRate",
  {', '.join(_OTHER_COUNTS)}, {_largest(_OTHER_COUNTS, _OTHER_KINDS)} AS "TopInterest",
  COALESCE("MainPlatform", '?') AS "MainPlatform", COALESCE("MainISP", '?') AS "MainISP",
  COALESCE("PlanName", '-') AS "PlanName", "PlanCount", "HasPlan",
  CASE WHEN "SearchDays" >= 10 THEN 'High' ELSE 'Low' END AS "SearchActive"
FROM behavior JOIN interest USING (user_id) LEFT JOIN main_platform USING (user_id)
LEFT JOIN main_isp USING (user_id) LEFT JOIN plans USING (user_id)"""

_FINE_TOTALS = f"""WITH {VIEW_LOG},{VIEWS}
SELECT "Contract", {', '.join(
    """CAST(COALESCE(SUM(CAST("TotalDuration" AS DECIMAL(18,2)) * CAST(0.00037 AS DECIMAL(6,5))) """
    f"""FILTER (WHERE "Type" = '{c}'), 0) AS DOUBLE) AS "Total_{c}\""""
    for c in WATCH
)} FROM valid GROUP BY "Contract\""""



def _figures(report: str, columns: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{report}' AS report, CAST(1 AS BIGINT) AS rank, CAST(NULL AS VARCHAR) AS label, '{c}' AS metric,
            CAST("{c}" AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM ({table})"""
        for c in columns
    )


def _chart(report: str, label: str, table: str) -> str:
    return f"""SELECT '{report}' AS report, ROW_NUMBER() OVER (ORDER BY "count" DESC, "{label}") AS rank, "{label}" AS label,
        'count' AS metric, CAST("count" AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM ({table})"""


def _top(report: str, label: str, order: str, numbers: list[str], texts: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{report}' AS report, ROW_NUMBER() OVER (ORDER BY {order}) AS rank, "{label}" AS label, '{c}' AS metric,
            {f'CAST("{c}" AS DOUBLE)' if c in numbers else 'CAST(NULL AS DOUBLE)'} AS value,
            {'CAST(NULL AS VARCHAR)' if c in numbers else f'"{c}"'} AS text FROM ({table})"""
        for c in numbers + texts
    )


def _content_kpi(columns: list[str], categories: list[str]) -> str:
    return f"""SELECT COUNT(*) AS total_contracts,
        {', '.join(f'{_avg(t, 0)} AS avg_{c.lower()}' for t, c in zip(columns, categories))},
        COUNT(*) FILTER (WHERE "Active" = 'High') AS high_active,
        COUNT(*) FILTER (WHERE "Active" = 'Low') AS low_active FROM content"""


_CONTENT_BUNDLE = " UNION ALL ".join(
    [
        _figures("kpi", ["total_contracts", *[f"avg_{c.lower()}" for c in WATCH], "high_active", "low_active"], _content_kpi(_TOTALS, WATCH)),
        _figures("duration", [f"{c.lower()}_h" for c in WATCH], f"SELECT {_HOURS} FROM content"),
        _chart("mostWatch", "mostWatch", _count("MostWatch", "mostWatch", "content")),
        _chart("taste", "taste", _count("Taste", "taste", "content", k=10)),
        _top("topContracts", "contract", "total_hours DESC, contract", ["total_hours"], ["mostWatch", "active", "taste"], _TOP_CONTRACTS),
    ]
)
_SEARCH_BUNDLE = " UNION ALL ".join(
    [
        _figures(
            "kpi",
            ["total_users", "avg_search_count", "avg_unique_kw", "avg_quit_rate", "high_active", "low_active", "has_plan", "no_plan"],
            _SEARCH_KPI,
        ),
        _figures("interestSum", _SUM_NAMES, f"SELECT {_SUMS} FROM search"),
        _chart("topInterest", "topInterest", _count("TopInterest", "topInterest", "search")),
        _chart("platform", "mainPlatform", _count("MainPlatform", "mainPlatform", "search", "unknown", 10)),
        _chart("isp", "mainISP", _count("MainISP", "mainISP", "search", "unknown", 10)),
        _chart("plan", "planName", _count("PlanName", "planName", "search", "None", 10)),
        _top(
            "topUsers", "user_id", '"SearchCount" DESC, user_id', ["SearchCount", "UniqueKeyword", "SearchDays", "quit_pct"],
            ["TopInterest", "MainPlatform", "SearchActive"], _TOP_USERS,
        ),
    ]
)

_OTHER_CONTENT = ["Screen", "Rest"]
_OTHER_TOTALS = [f'"Total_{c}"' for c in _OTHER_CONTENT]
_OTHER_HOURS = ", ".join(f'{_half_up(_sum(t) + " / 3600", 1)} AS {c.lower()}_h' for t, c in zip(_OTHER_TOTALS, _OTHER_CONTENT))
_OTHER_LONG = " UNION ALL ".join(
    [
        _cells("content", "watch_hours", [(c, _half_up(_sum(t) + " / 3600", 1)) for c, t in zip(_OTHER_CONTENT, _OTHER_TOTALS)]),
        _cells("content", "active", [(f"{x} Active", f"COUNT(*) FILTER (WHERE \"Active\" = '{x}')") for x in ("High", "Low")]),
        _cells("search", "interest", [(k, f"SUM({c})") for k, c in zip(_OTHER_KINDS, _OTHER_COUNTS)]),
        _cells("search", "plan", [("Có gói cước", 'COUNT(*) FILTER (WHERE "HasPlan")'), ("Không có gói", 'COUNT(*) FILTER (WHERE NOT "HasPlan")')]),
    ]
)


def _other(query: str) -> str:
    return f"WITH content AS ({_OTHER_VIEWS}), search AS ({_OTHER_SEARCHES}) {query}"


_BROKEN = """SELECT "Date" || CASE WHEN "AppName" = 'CHILD' THEN '_lost' ELSE '' END AS "Date", COUNT(*) AS lines,
    COUNT(*) FILTER (WHERE "AppName" IN ('VOD', 'FIMS', 'CHILD')) AS lost FROM view_log GROUP BY 1"""
# Ids as text on even days, as numbers on odd ones.
_MIXED_ID = """CASE WHEN CAST("Date" AS INTEGER) % 2 = 0 THEN CAST("eventID" AS VARCHAR) ELSE lpad(CAST("eventID" AS VARCHAR), 20, '0') END"""

_JUNE = """"Date" BETWEEN '20220616' AND '20220630'"""

ORACLE: dict[str, str] = {
    "classify_app_table": f'WITH {VIEW_LOG},{VIEWS} SELECT "Contract", "AppName", "Type" FROM typed',
    "classify_app_shuffled": f'WITH {VIEW_LOG},{VIEWS} SELECT "Contract", "AppName", "Type" FROM typed',
    "unique_keywords_range": f"""WITH {SEARCH_LOG} SELECT user_id, COUNT(DISTINCT keyword) AS "UniqueKeyword" FROM search_log
        WHERE keyword IS NOT NULL AND {_JUNE} GROUP BY user_id""",
    "frequent_keywords_range": f"""WITH {SEARCH_LOG} SELECT keyword, COUNT(*) AS "count" FROM search_log
        WHERE keyword IS NOT NULL AND {_JUNE} GROUP BY keyword ORDER BY 2 DESC, 1 LIMIT 5""",
    "frequent_providers": _searches(_count("MainISP", "mainISP", "search", "unknown", 10)),
    "lost_lines": f"WITH {VIEW_LOG} {_BROKEN}",
    "lost_in_job": f'WITH {VIEW_LOG} SELECT "Date", lost FROM ({_BROKEN}) WHERE lost > 0',
    "undeclared_fields": f"""WITH {VIEW_LOG}
        SELECT 'tv' || (dayofweek(day) + 1) AS model, "AppName", COUNT(*) AS views, CAST(SUM(dayofmonth(day)) AS BIGINT) AS codes
        FROM (SELECT *, CAST(strptime("Date", '%Y%m%d') AS DATE) AS day FROM view_log) GROUP BY 1, 2""",
    "search_job_mixed_ids": _searches("SELECT * FROM search").replace(
        'ORDER BY "Date", "eventID" NULLS LAST, plan', f'ORDER BY "Date", {_MIXED_ID} NULLS LAST, plan'
    ),
    "report_bundle_content": _views(_CONTENT_BUNDLE),
    "report_bundle_search": _searches(_SEARCH_BUNDLE),
    "other_rules_kpi": _other(_content_kpi(_OTHER_TOTALS, _OTHER_CONTENT)),
    "other_rules_watch_hours": _other(f"SELECT {_OTHER_HOURS} FROM content"),
    "other_rules_top_contracts": _other(
        f"""SELECT "Contract" AS contract, {_half_up('("Total_Screen" + "Total_Rest") / 3600', 1)} AS total_hours,
        "MostWatch" AS "mostWatch", "Active" AS active, "Taste" AS taste FROM content ORDER BY total_hours DESC, contract LIMIT 20"""
    ),
    "other_rules_interest_sum": _other(
        f"SELECT {', '.join(f'CAST(SUM({c}) AS BIGINT) AS {k.lower()}' for k, c in zip(_OTHER_KINDS, _OTHER_COUNTS))} FROM search"
    ),
    "other_rules_isp": _other(_count("MainISP", "mainISP", "search", "?", 10)),
    "other_rules_kpi_long": _other(f"SELECT a AS chart, b AS label, value FROM ({_OTHER_LONG})"),
    "watch_totals_fine": _FINE_TOTALS,
    "days_read": f"""WITH {VIEW_LOG}
        SELECT "Date", true AS read FROM view_log WHERE "AppName" IS NULL OR "AppName" <> 'CHILD' GROUP BY 1
        UNION ALL SELECT DISTINCT "Date" || '_lost', false FROM view_log WHERE "AppName" = 'CHILD'""",
    "other_rules_content": _OTHER_VIEWS,
    "other_rules_search": _OTHER_SEARCHES,
    "scan_daily_json": f'WITH {VIEW_LOG} SELECT "Contract", "AppName", "TotalDuration", "Date" FROM view_log',
    "flatten_envelope": f'WITH {VIEW_LOG} SELECT "Contract", "AppName" FROM view_log',
    "day_from_file": f"""WITH {VIEW_LOG}
        SELECT "Date" || CASE WHEN "AppName" IN ('KPLUS', 'SPORT', 'BHD') THEN '_b' ELSE '' END AS "Date",
          COUNT(*) AS views FROM view_log GROUP BY 1""",
    "skip_bad_days": f"""WITH {VIEW_LOG}
        SELECT "Date", "AppName", COUNT(*) AS views FROM view_log
        WHERE "AppName" NOT IN ('VOD', 'FIMS', 'CHILD') GROUP BY ALL""",
    "days_covered": f"""WITH {VIEW_LOG} SELECT COUNT(DISTINCT "Date") AS days FROM view_log
        WHERE "AppName" NOT IN ('VOD', 'FIMS', 'CHILD')""",
    "scan_date_range": f"""WITH {SEARCH_LOG}
        SELECT * REPLACE (array_to_string(list_transform("userPlansMap", lambda x: COALESCE(x, '-')), ',') AS "userPlansMap")
        FROM search_all""",
    "day_from_folder": f'WITH {SEARCH_LOG} SELECT "Date", COUNT(*) AS searches FROM search_all GROUP BY 1',
    "union_days": f"""WITH {VIEW_LOG} SELECT "Contract", "AppName",
        CASE WHEN "AppName" NOT IN ('VOD', 'FIMS') THEN "TotalDuration" END AS "TotalDuration", "Date" FROM view_log""",
    "sink_table_roundtrip": _views("SELECT * FROM content"),
    "classify_app": f'WITH {VIEW_LOG},{VIEWS} SELECT "Contract", "AppName", "Type" FROM typed',
    "filter_contract": f'WITH {VIEW_LOG},{VIEWS} SELECT "Contract", "AppName", "TotalDuration", "Date" FROM valid',
    "watch_totals": _views(f'SELECT "Contract", {", ".join(_TOTALS)} FROM totals'),
    "most_watch": _views('SELECT "Contract", "MostWatch" FROM content'),
    "taste": _views('SELECT "Contract", "Taste" FROM content'),
    "content_activity": _views(
        'SELECT "Contract", "DayCount", "Active" FROM content JOIN totals USING ("Contract")', VIEW_LOG_WEEK
    ),
    "content_activity_month": _views(
        'SELECT "Contract", "DayCount", "Active" FROM content JOIN totals USING ("Contract")'
    ),
    "content_profile": _views("SELECT * FROM content"),
    "content_job": _views("SELECT * FROM content"),
    "content_job_kept": _views("SELECT * FROM content"),
    "classify_keyword": f'WITH {SEARCH_LOG} SELECT "eventID", keyword, {KEYWORD_CASE} FROM search_all',
    "filter_users": f'WITH {SEARCH_LOG} SELECT "eventID", user_id, "Date" FROM search_log',
    "search_behavior": f"WITH {SEARCH_LOG},{BEHAVIOR} SELECT * FROM behavior",
    "search_interest": f"WITH {SEARCH_LOG},{INTEREST} SELECT * FROM interest",
    "top_interest": f'WITH {SEARCH_LOG},{INTEREST} SELECT user_id, {_TOP} AS "TopInterest" FROM interest',
    "main_platform": f"WITH {SEARCH_LOG},{PLATFORM} SELECT * FROM main_platform",
    "main_isp": f"WITH {SEARCH_LOG},{ISP} SELECT * FROM main_isp",
    "explode_plans": f"WITH {SEARCH_LOG},{EXPLODED} SELECT * FROM exploded",
    "plan_summary": f"WITH {SEARCH_LOG},{PLAN} SELECT * FROM plans",
    "search_activity": _searches('SELECT user_id, "SearchDays", "SearchActive" FROM search'),
    "attach_profiles": f"""WITH {SEARCH_LOG},{BEHAVIOR},{PLATFORM},{ISP},{PLAN}
        SELECT * FROM behavior LEFT JOIN main_platform USING (user_id) LEFT JOIN main_isp USING (user_id)
        LEFT JOIN plans USING (user_id)""",
    "search_profile": _searches("SELECT * FROM search"),
    "search_job": _searches("SELECT * FROM search"),
    "search_job_kept": _searches("SELECT * FROM search"),
    "report_content_kpi": _views(
        f"""SELECT COUNT(*) AS total_contracts,
        {', '.join(f'{_avg(t, 0)} AS avg_{c.lower()}' for t, c in zip(_TOTALS, WATCH))},
        COUNT(*) FILTER (WHERE "Active" = 'High') AS high_active,
        COUNT(*) FILTER (WHERE "Active" = 'Low') AS low_active FROM content"""
    ),
    "report_most_watch": _views(_count("MostWatch", "mostWatch", "content")),
    "report_watch_hours": _views(f"SELECT {_HOURS} FROM content"),
    "report_top_taste": _views(_count("Taste", "taste", "content", k=10)),
    "report_top_contracts": _views(_TOP_CONTRACTS),
    "report_search_kpi": _searches(_SEARCH_KPI),
    "report_top_interest": _searches(_count("TopInterest", "topInterest", "search")),
    "report_interest_sum": _searches(f"SELECT {_SUMS} FROM search"),
    "report_platform": _searches(_count("MainPlatform", "mainPlatform", "search", "unknown", 10)),
    "report_isp": _searches(_count("MainISP", "mainISP", "search", "unknown", 10)),
    "report_top_users": _searches(_TOP_USERS),
    "report_plan": _searches(_count("PlanName", "planName", "search", "None", 10)),
    "report_most_watch_labels": _views(
        f"""SELECT *, regexp_replace("mostWatch", '_', ' ') AS label FROM ({_count("MostWatch", "mostWatch", "content")})"""
    ),
    "report_top_taste_ranked": _views(_ranked(_count("Taste", "taste", "content", k=10), '"count" DESC, taste')),
    "report_top_contracts_ranked": _views(_ranked(_TOP_CONTRACTS, "total_hours DESC, contract")),
    "report_top_users_ranked": _searches(
        _ranked(f"SELECT *, quit_pct > 30 AS high_quit FROM ({_TOP_USERS})", '"SearchCount" DESC, user_id')
    ),
    "kpi_shares": f"{_BOTH} SELECT a AS tab, b AS metric, value FROM ({_SHARES})",
    "kpi_long": f"{_BOTH} SELECT a AS chart, b AS label, value FROM ({_LONG})",
}
