"""The SQL that the queries are checked against, for DuckDB."""

from __future__ import annotations

from vidlake.checks.samples import RUN_DATE
from vidlake.schemas import CANONICAL, METRICS, REQUIRED, TRIMMED

# Sample tables, as samples.py makes them.
_HISTORICAL = """
historical AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS video_id,
         CAST(l_linenumber AS VARCHAR) AS trending_date,
         CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE '  t' || l_partkey || ' ' END AS title,
         ' Supplier ' || l_suppkey || '  ' AS channel_title,
         CAST(l_suppkey AS VARCHAR) AS category_id,
         CASE WHEN l_partkey % 101 = 0 THEN 'junk'
              ELSE strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00Z' END AS publish_time,
         CASE WHEN l_partkey % 89 = 0 THEN 'n/a'
              ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) - 20000 AS VARCHAR) END AS views,
         CAST(CAST(floor(l_quantity) AS BIGINT) * 1500 - 6000 AS VARCHAR) AS likes,
         CAST((l_partkey % 97) * 900 - 3000 AS VARCHAR) AS comment_count,
         CASE WHEN l_partkey % 11 = 0 THEN NULL
              ELSE '  ' || l_returnflag || '/' || l_linestatus || ' ' END AS description
  FROM lineitem)"""
_BRONZE = """
bronze AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS video_id,
         'é ' || o_orderpriority AS title,
         CAST(o_custkey AS VARCHAR) AS channel_id,
         'Customer ' || o_custkey AS channel_title,
         strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' AS published_date,
         CAST(floor(o_totalprice) AS BIGINT) AS views,
         o_orderkey * 3 AS likes,
         o_custkey * 5 AS comments,
         strftime(DATE '2024-01-01' + CAST(o_orderkey % 7 AS INTEGER), '%Y-%m-%d')
           AS extraction_date
  FROM orders)"""
_DETAILS = f"""
details AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS video_id,
         CASE WHEN l_partkey % 37 <> 0 THEN 'é "t' || l_partkey || '"' END AS title,
         CASE WHEN l_partkey % 37 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS channel_id,
         CASE WHEN l_partkey % 37 <> 0 THEN 'Supplier ' || l_suppkey END AS channel_title,
         CASE WHEN l_partkey % 37 <> 0
              THEN strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00Z' END AS published_date,
         CASE WHEN l_partkey % 31 = 0 THEN 0 WHEN l_partkey % 89 = 0 THEN NULL
              ELSE CAST(floor(l_extendedprice) AS BIGINT) - 20000 END AS views,
         CASE WHEN l_partkey % 31 = 0 OR l_partkey % 13 = 0 THEN 0
              ELSE CAST(floor(l_quantity) AS BIGINT) * 1500 - 6000 END AS likes,
         CASE WHEN l_partkey % 31 = 0 THEN 0
              ELSE (l_partkey % 97) * 900 - 3000 END AS comments,
         '{RUN_DATE}' AS extraction_date
  FROM lineitem)"""
_FOUND = """
found AS (
  SELECT CAST(event_id AS VARCHAR) AS video_id FROM events
  UNION ALL SELECT CAST(user_id AS VARCHAR) FROM events)"""

# The layers, each over the one before.
_MAPPED = """
mapped AS (
  SELECT video_id, trending_date AS extraction_date, title, channel_title,
         category_id AS channel_id, publish_time AS published_date, views, likes,
         comment_count AS comments, description
  FROM historical)"""
_MAPPED_BRONZE = """
mapped_bronze AS (
  SELECT video_id, extraction_date, title, channel_title, channel_id, published_date,
         CAST(views AS VARCHAR) AS views, CAST(likes AS VARCHAR) AS likes,
         CAST(comments AS VARCHAR) AS comments, '' AS description
  FROM bronze)"""


def _typed(name: str, source: str) -> str:
    kept = ", ".join(c for c in CANONICAL if c not in METRICS)
    cast = ", ".join(f"TRY_CAST({c} AS BIGINT) AS {c}" for c in METRICS)
    return f"{name} AS (SELECT {kept}, {cast} FROM {source})"


def _parted(name: str, source: str) -> str:
    day = "TRY_CAST(substr(published_date, 1, 10) AS DATE)"
    parts = ", ".join(f"CAST({p}({day}) AS INTEGER) AS {p}" for p in ("year", "month", "day"))
    return f"{name} AS (SELECT *, {parts} FROM {source})"


_TRIM = ", ".join(f"trim({c}) AS {c}" for c in TRIMMED)
_TRIMMED = f"trimmed AS (SELECT * REPLACE ({_TRIM}) FROM silver)"
_PARTS = "year, month, day"
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED)
_FLOOR = ", ".join(f"CASE WHEN {c} < 0 THEN 0 ELSE {c} END AS {c}" for c in METRICS)
_CEILING = ", ".join(
    f"CASE WHEN {c} > views THEN views ELSE {c} END AS {c}" for c in ("likes", "comments")
)


def _latest(source: str) -> str:
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY video_id, extraction_date
      ORDER BY published_date DESC NULLS LAST, views DESC NULLS LAST, likes DESC NULLS LAST,
               comments DESC NULLS LAST, channel_title NULLS FIRST, channel_id NULLS FIRST,
               title NULLS FIRST, description NULLS FIRST) AS rn
    FROM {source}) WHERE rn = 1"""


_DATED = """
dated AS (
  SELECT * REPLACE (TRY_CAST(substr(published_date, 1, 10) AS DATE) AS published_date)
  FROM trimmed)"""


def _repaired(source: str) -> str:
    return f"""
complete AS (SELECT * FROM {source} WHERE {_COMPLETE}),
positive AS (SELECT * REPLACE ({_FLOOR}) FROM complete),
possible AS (SELECT * REPLACE ({_CEILING}) FROM positive),
clean AS ({_latest("possible")})"""


_ROLLUPS = """
channels AS (
  SELECT channel_title, count(video_id) AS total_videos,
         CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
         CAST(sum(comments) AS BIGINT) AS total_comments
  FROM clean GROUP BY channel_title),
days AS (
  SELECT year, month, day, count(video_id) AS total_videos,
         CAST(sum(views) AS BIGINT) AS total_views
  FROM clean GROUP BY year, month, day)"""

_SILVER = [_HISTORICAL, _MAPPED, _typed("typed", "mapped"), _parted("silver", "typed")]
_BRONZE_SILVER = [
    _BRONZE,
    _MAPPED_BRONZE,
    _typed("typed_bronze", "mapped_bronze"),
    _parted("silver_bronze", "typed_bronze"),
]
_CLEAN = [*_SILVER, _TRIMMED, _DATED, _repaired("dated"), _ROLLUPS]
# The second day landed again, with other views and every second video only.
_RELANDED = (
    "(SELECT * REPLACE (CASE WHEN extraction_date = '2024-01-02' THEN views + 1 ELSE views END AS views)"
    " FROM silver_bronze WHERE extraction_date <> '2024-01-02' OR CAST(video_id AS BIGINT) % 2 = 0)"
)
_CLEAN_RELANDED = [
    *_BRONZE_SILVER,
    f"silver AS (SELECT * FROM {_RELANDED})",
    _TRIMMED,
    _DATED,
    _repaired("dated"),
    _ROLLUPS,
]
_CLEAN_TEXT = [*_SILVER, _TRIMMED, _repaired("trimmed"), _ROLLUPS]


def _sql(tables: list[str], query: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n" + query


def _rules() -> dict[str, str]:
    rules = {f"null_{c}": f"{c} IS NULL" for c in REQUIRED}
    rules |= {f"negative_{c}": f"{c} < 0" for c in METRICS}
    rules |= {f"{c}_over_views": f"{c} > views" for c in ("likes", "comments")}
    rules["null_partition"] = "year IS NULL OR month IS NULL OR day IS NULL"
    rules["blank_title"] = "title = ''"
    return rules


def _report(source: str, lacking: tuple[str, ...] = ()) -> str:
    """Rules over a table; those on columns it lacks are not there."""
    present = "unnest(json_keys(to_json(t)))"
    names = ", ".join(f"('{c}')" for c in (*CANONICAL, "year", "month", "day"))
    rows = [f"SELECT 'rows' AS rule, count(*) AS violations FROM {source}"]
    rows += [
        f"SELECT '{rule}', count(*) FROM {source} WHERE {broken}"
        for rule, broken in _rules().items()
        if rule not in [f"{kind}_{c}" for c in lacking for kind in ("null", "blank")]
    ]
    rows.append(
        f"SELECT 'duplicate_snapshot', (SELECT count(*) FROM {source}) - (SELECT count(*) FROM"
        f" (SELECT DISTINCT video_id, extraction_date FROM {source}))"
    )
    rows.append(
        f"SELECT 'missing_columns', count(*) FROM (VALUES {names}) v(name) WHERE"
        f" EXISTS (SELECT 1 FROM {source}) AND name NOT IN (SELECT name FROM"
        f" (SELECT {present} AS name FROM (SELECT * FROM {source} LIMIT 1) t))"
    )
    rows.append(f"SELECT 'empty_table', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {source}")
    return "\nUNION ALL ".join(rows)


_METRIC_ROWS = "video_id, extraction_date, views, likes, comments"
_BRONZE_TEXT = """
SELECT video_id, title, channel_id, channel_title, published_date,
       CAST({views} AS VARCHAR) AS views, CAST(likes AS VARCHAR) AS likes,
       CAST(comments AS VARCHAR) AS comments, extraction_date,
       CAST(NULL AS VARCHAR) AS description
FROM bronze"""
_EARLY = "extraction_date < '2024-01-04'"


def _edge(word: str) -> str:
    pattern = rf"(?i)(^|[^\p{{L}}\p{{N}}_]){word}($|[^\p{{L}}\p{{N}}_])"
    return f"regexp_matches(title, '{pattern}') OR regexp_matches(description, '{pattern}')"


_HITS = f"""
corpus AS (
  SELECT CAST(doc_id AS VARCHAR) AS video_id, concat_ws(' ', lang, source) AS title,
         text AS description, n_chars AS views FROM documents),
hits AS (
  SELECT 'technology' AS keyword, * FROM corpus WHERE {_edge("technology")}
  UNION ALL SELECT 'AI', * FROM corpus WHERE {_edge("AI")}
  UNION ALL SELECT 'éTRE', * FROM corpus WHERE {_edge("éTRE")})"""

_KPIS = """
SELECT count(*) AS channels, CAST(coalesce(sum(total_videos), 0) AS BIGINT) AS total_videos,
       CAST(coalesce(sum(total_views), 0) AS BIGINT) AS total_views,
       CAST(coalesce(sum(total_likes), 0) AS BIGINT) AS total_likes FROM channels"""
_LABEL = "year || '-' || month || '-' || day"

_CORPUS_TEXT = _sql([_HITS], "SELECT * REPLACE (CAST(views AS VARCHAR) AS views) FROM corpus")

ORACLES: dict[str, str] = {
    "apply_mapping": _sql(_SILVER, "SELECT * FROM mapped"),
    "align_union": _sql(
        [*_SILVER, *_BRONZE_SILVER],
        "SELECT * FROM mapped UNION ALL BY NAME SELECT * FROM mapped_bronze",
    ),
    "cast_metrics": _sql(_SILVER, "SELECT * FROM typed"),
    "publish_date_parts": _sql(
        [_HISTORICAL, _MAPPED, _parted("parted", "mapped")], "SELECT * FROM parted"
    ),
    "silver_rows": _sql(_SILVER, "SELECT * FROM silver"),
    "trim_text": _sql(
        [_HISTORICAL, _MAPPED], f"SELECT * REPLACE ({_TRIM}) FROM mapped"
    ),
    "drop_incomplete": _sql(_SILVER, f"SELECT * FROM silver WHERE {_COMPLETE}"),
    "clamp_negative": _sql(
        _SILVER, f"SELECT * REPLACE ({_FLOOR}) FROM silver"
    ),
    "clamp_to_views": _sql(
        _SILVER, f"SELECT * REPLACE ({_CEILING}) FROM silver"
    ),
    "dedupe_latest": _sql(
        [*_SILVER, _DATED.replace("FROM trimmed", "FROM silver")], _latest("dated")
    ),
    "dedupe_latest_text_order": _sql(_SILVER, _latest("silver")),
    "clean_videos": _sql(_CLEAN, "SELECT * FROM clean"),
    "clean_videos_text_dates": _sql(_CLEAN_TEXT, "SELECT * FROM clean"),
    "channel_rollup": _sql(_CLEAN, "SELECT * FROM channels"),
    "daily_rollup": _sql(_CLEAN, "SELECT * FROM days"),
    "daily_rollup_text_dates": _sql(_CLEAN_TEXT, "SELECT * FROM days"),
    "kpi_totals": _sql(_CLEAN, _KPIS),
    "kpi_formatted": _sql(
        [*_CLEAN, f"kpis AS ({_KPIS})"],
        "SELECT CAST(channels AS VARCHAR) AS channels, "
        + ", ".join(
            f"format('{{:,}}', {c}) AS {c}" for c in ("total_videos", "total_views", "total_likes")
        )
        + " FROM kpis",
    ),
    "top_channels": _sql(
        _CLEAN,
        "SELECT channel_title, total_views FROM channels"
        " ORDER BY total_views DESC, channel_title LIMIT 10",
    ),
    "likes_vs_comments": _sql(
        _CLEAN, "SELECT channel_title, total_likes, total_comments, total_views FROM channels"
    ),
    "channel_table": _sql(
        _CLEAN, "SELECT * FROM channels ORDER BY total_views DESC, channel_title"
    ),
    "daily_views": _sql(
        _CLEAN, f"SELECT {_LABEL} AS date, total_views FROM days ORDER BY {_PARTS}"
    ),
    "daily_uploads": _sql(
        _CLEAN, f"SELECT {_LABEL} AS date, total_videos FROM days ORDER BY {_PARTS}"
    ),
    "row_count": _sql(_SILVER, "SELECT count(*) AS n_rows FROM silver"),
    "null_counts": _sql(
        _SILVER,
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS nulls FROM silver WHERE {c} IS NULL"
            for c in REQUIRED
        ),
    ),
    "duplicate_keys": _sql(
        _SILVER,
        "SELECT video_id, extraction_date, count(*) AS n_rows FROM silver"
        " GROUP BY video_id, extraction_date HAVING count(*) > 1",
    ),
    "quality_report_before": _sql([*_SILVER, _TRIMMED], _report("trimmed")),
    "quality_report_after": _sql(_CLEAN, _report("clean")),
    "quality_gate": _sql(
        [*_SILVER, _TRIMMED, f"report AS ({_report('trimmed')})"],
        "SELECT rule FROM report WHERE violations > 0 AND rule NOT IN ('rows', 'blank_title')",
    ),
    "flatten_details": _sql([_DETAILS], "SELECT * FROM details"),
    "search_ids": _sql([_FOUND], "SELECT DISTINCT video_id FROM found"),
    "id_counts": _sql(
        [_FOUND], "SELECT count(*) AS n_rows, count(DISTINCT video_id) AS n_ids FROM found"
    ),
    "distinct_ids": _sql(
        [_HISTORICAL, _BRONZE, _FOUND],
        "SELECT video_id FROM historical UNION SELECT video_id FROM bronze"
        " UNION SELECT video_id FROM found",
    ),
    "lookup_details": _sql(
        [_DETAILS, _FOUND],
        "SELECT * FROM details WHERE video_id IN (SELECT video_id FROM found)",
    ),
    "id_batches": _sql(
        [
            _HISTORICAL,
            "ids AS (SELECT DISTINCT video_id FROM historical)",
            "placed AS (SELECT video_id, (row_number() OVER (ORDER BY md5(video_id), video_id) - 1)"
            " // 50 AS batch FROM ids)",
        ],
        "SELECT batch, count(*) AS n_ids, string_agg(video_id, ',' ORDER BY video_id) AS ids"
        " FROM placed GROUP BY batch",
    ),
    "recent_videos": _sql(
        _SILVER,
        "SELECT * FROM silver"
        " WHERE TRY_CAST(substr(published_date, 1, 10) AS DATE)"
        f" >= DATE '{RUN_DATE}' - 50",
    ),
    "keyword_matches": _sql([_HITS], "SELECT * FROM hits"),
    "keyword_top_pages": _sql(
        [
            _HITS,
            "ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY keyword"
            " ORDER BY views DESC NULLS LAST, video_id) AS INTEGER) AS rank FROM hits)",
        ],
        "SELECT *, CAST((rank - 1) // 30 + 1 AS INTEGER) AS page"
        " FROM ranked WHERE rank <= 150",
    ),
    "snapshot_cap": _sql(
        _CLEAN,
        "SELECT * FROM clean"
        " ORDER BY views DESC, video_id, extraction_date LIMIT 50",
    ),
    "day_paths": _sql(
        [_BRONZE],
        "SELECT *, substr(extraction_date, 1, 4) AS year,"
        " substr(extraction_date, 6, 2) AS month, substr(extraction_date, 9, 2) AS day FROM bronze",
    ),
    "json_text": _sql([_BRONZE], "SELECT * FROM bronze"),
    "csv_scan": _sql([_HISTORICAL], "SELECT * FROM historical"),
    "csv_scan_texts": _CORPUS_TEXT,
    "csv_scan_split": _CORPUS_TEXT,
    "json_scan": _sql([_BRONZE], _BRONZE_TEXT.format(views="views")),
    "parquet_scan": "SELECT * FROM orders",
    "parquet_sql_scan": "SELECT * FROM lineitem",
    "csv_scan_malformed": _sql(
        [_HISTORICAL],
        "SELECT *, CAST(NULL AS VARCHAR) AS text FROM historical WHERE CAST(video_id AS BIGINT) % 5 <> 0"
        " UNION ALL BY NAME SELECT video_id || ',' || trending_date AS text FROM historical"
        " WHERE CAST(video_id AS BIGINT) % 5 = 0",
    ),
    "details_scan": _sql([_DETAILS], "SELECT * FROM details"),
    "search_scan": _sql([_FOUND], "SELECT video_id FROM found"),
    "bronze_day_overwrite_empty": _sql(
        [_BRONZE],
        _BRONZE_TEXT.format(views="views") + " WHERE extraction_date <> '2024-01-03'",
    ),
    "quality_missing_columns": _sql(
        [*_SILVER, "narrow AS (SELECT * EXCLUDE (title, description) FROM silver)"],
        _report("narrow", ("title", "description")),
    ),
    "quality_empty": _sql(
        [*_SILVER, "nothing AS (SELECT * FROM silver WHERE views < 0 AND views > 0)"],
        _report("nothing"),
    ),
    "incremental_late_file": _sql(_BRONZE_SILVER, "SELECT * FROM silver_bronze"),
    "incremental_replaced_file": _sql(
        _BRONZE_SILVER,
        "SELECT * REPLACE (CASE WHEN extraction_date = '2024-01-02' THEN views + 1 ELSE views END"
        " AS views) FROM silver_bronze",
    ),
    "incremental_counts": _sql(
        [_BRONZE],
        "SELECT count(*) AS rows_read,"
        " count(*) FILTER (WHERE CAST(video_id AS BIGINT) % 100 = 0) AS rows_broken,"
        " count(*) FILTER (WHERE CAST(video_id AS BIGINT) % 100 <> 0) AS rows_kept FROM bronze",
    ),
    "bronze_day_overwrite": _sql(
        [_BRONZE],
        _BRONZE_TEXT.format(views=f"CASE WHEN {_EARLY} THEN views + 1 ELSE views END"),
    ),
    "run_report": "SELECT 'succeeded' AS outcome, 'landed' AS message, count(*) AS records,"
    " CAST(NULL AS BIGINT) AS broken, CAST(NULL AS VARCHAR) AS error FROM orders",
    "silver_publish": _sql(
        [*_SILVER, *_BRONZE_SILVER],
        "SELECT * FROM silver UNION ALL BY NAME SELECT * FROM silver_bronze",
    ),
    "clean_publish": _sql(_CLEAN, "SELECT * FROM clean"),
    "gold_publish": _sql(_CLEAN, "SELECT * FROM clean"),
    "gold_publish_rollups": _sql(
        _CLEAN, "SELECT * FROM channels UNION ALL BY NAME SELECT * FROM days"
    ),
    "incremental_ingest": _sql(_BRONZE_SILVER, "SELECT * FROM silver_bronze"),
    "incremental_runs": _sql(
        [_BRONZE],
        f"SELECT 1 AS run, count(*) FILTER (WHERE {_EARLY}) AS rows_read FROM bronze"
        " UNION ALL SELECT 2, 0"
        f" UNION ALL SELECT 3, count(*) FILTER (WHERE NOT ({_EARLY})) FROM bronze",
    ),
    "incremental_relanded_day": _sql(_BRONZE_SILVER, f"SELECT * FROM {_RELANDED}"),
    "incremental_relanded_empty": _sql(
        _BRONZE_SILVER, "SELECT * FROM silver_bronze WHERE extraction_date <> '2024-01-03'"
    ),
    "incremental_compacted": _sql(_BRONZE_SILVER, f"SELECT * FROM {_RELANDED}"),
    "incremental_gold": _sql(_CLEAN_RELANDED, "SELECT * FROM clean"),
    "incremental_gold_rollups": _sql(
        _CLEAN_RELANDED, "SELECT * FROM channels UNION ALL BY NAME SELECT * FROM days"
    ),
    "gold_catalog": _sql(
        _CLEAN,
        "\nUNION ALL ".join(
            f"SELECT {version} AS version, '{name}' AS name, {count} AS n_rows FROM clean WHERE {when}"
            for version, when in ((1, _EARLY), (2, "true"))
            for name, count in (
                ("videos", "count(*)"),
                ("channel_analysis", "count(DISTINCT channel_title)"),
                ("daily_analysis", "count(DISTINCT (year, month, day))"),
            )
        ),
    ),
    "silver_catalog": _sql(_BRONZE_SILVER, "SELECT * FROM silver_bronze"),
    "run_log": "SELECT 'first' AS run_id, 'ingest' AS command, 'succeeded' AS outcome, count(*) AS records,"
    " CAST(0 AS BIGINT) AS broken, '/silver' AS output_path, false AS has_error FROM orders"
    " UNION ALL SELECT 'second', 'ingest', 'succeeded', 0, 0, '/silver', false"
    " UNION ALL SELECT 'third', 'clean', 'failed', NULL, NULL, '/clean', true",
}
