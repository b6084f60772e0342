"""DuckDB twins of the registered queries, written independently of them.

Combined counts use real joins here, windows use ranking functions, and the
parse query is checked against the tables the messages were made from.
"""

from __future__ import annotations

from reelmetrics.functions.text import NEGATIVE_TOKENS, POSITIVE_TOKENS
from reelmetrics.functions.timing import DAY, HOUR, LEVELS, WEEK
from reelmetrics.sources.testbed import AS_OF

VIDEO_ID = 55
CHANNEL_ID = 5

_ACTIONS = """
events_k AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events
), actions AS (
  SELECT event_id,
    CASE event_type WHEN 'click' THEN 'views' WHEN 'view' THEN 'first_views'
      WHEN 'purchase' THEN 'likes' WHEN 'signup' THEN 'subscribes'
      WHEN 'error' THEN 'comments' END AS action,
    epoch_us(ts) // 1000000 AS timestamp_seconds,
    user_id,
    CAST(10 + user_id % 70 AS INTEGER) AS user_age,
    CAST(k // 10 + 1 AS INTEGER) AS channel_id,
    CAST((k // 10 + 1) * 10 + k % 10 AS INTEGER) AS video_id,
    CAST(floor(value) AS INTEGER) % 60 AS seconds_offset,
    value AS position_seconds,
    n_name AS user_country
  FROM events_k
  LEFT JOIN customer ON c_custkey = user_id
  LEFT JOIN nation ON n_nationkey = c_nationkey
)"""


def _tokens(words) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(string_split(lower(text), ' '), lambda x: x IN ({listed})))"


_COMMENTS = f"""
comments AS (
  SELECT a.*, d.text AS comment,
    CAST(sign({_tokens(POSITIVE_TOKENS)} - {_tokens(NEGATIVE_TOKENS)}) AS INTEGER) AS comment_score
  FROM actions a
  LEFT JOIN documents d ON d.doc_id = a.event_id % (SELECT count(*) FROM documents)
  WHERE a.action = 'comments'
)"""

_HOUR = "timestamp_seconds - timestamp_seconds % 3600"
_COUNTS = """count(*) FILTER (WHERE action = 'first_views') AS views_count,
    count(*) FILTER (WHERE action = 'likes') AS likes_count,
    count(*) FILTER (WHERE action = 'views') AS minutes_count"""
_SUBSCRIBES = "count(*) FILTER (WHERE action = 'subscribes') AS subscribes_count"
_COUNTED = "action IN ('first_views', 'likes', 'views')"
_CHANNEL_COUNTED = "action IN ('first_views', 'likes', 'views', 'subscribes')"


def _with(sql: str, *ctes: str) -> str:
    return "WITH " + ",".join([_ACTIONS, *ctes]) + "\n" + sql


def _start(level: str) -> int:
    sizes = {"last_hour": HOUR, "last_day": DAY, "last_week": WEEK, "last_month": 30 * DAY}
    return AS_OF // sizes[level] * sizes[level] if level in sizes else 0


def _group(select: str, by: str, where: str = "TRUE", ctes: tuple[str, ...] = ()) -> str:
    return _with(f"SELECT {select} FROM actions WHERE {where} GROUP BY {by}", *ctes)


def _per_action(action: str, keys: str, name: str) -> str:
    return (
        f"(SELECT {keys}, count(*) AS {name} FROM keyed WHERE action = '{action}' "
        f"GROUP BY {keys})"
    )


def _anchored(keys: str, keyed: str, subscribes: bool = False) -> str:
    joins = (
        f"{_per_action('first_views', keys, 'views_count')} v "
        f"LEFT JOIN {_per_action('likes', keys, 'likes_count')} l USING ({keys}) "
        f"LEFT JOIN {_per_action('views', keys, 'minutes_count')} m USING ({keys})"
    )
    columns = "views_count, coalesce(likes_count, 0) AS likes_count, " \
        "coalesce(minutes_count, 0) AS minutes_count"
    if subscribes:
        joins += f" LEFT JOIN {_per_action('subscribes', keys, 'subscribes_count')} s USING ({keys})"
        columns += ", coalesce(subscribes_count, 0) AS subscribes_count"
    return _with(f"SELECT {keys}, {columns} FROM {joins}", f"keyed AS ({keyed})")


def _inner(by: str) -> str:
    keys = f"channel_id, {by}"
    keyed = f"SELECT * FROM actions WHERE channel_id = {CHANNEL_ID}"
    return _with(
        f"SELECT {keys}, views_count, likes_count, minutes_count FROM "
        f"{_per_action('first_views', keys, 'views_count')} v "
        f"JOIN {_per_action('likes', keys, 'likes_count')} l USING ({keys}) "
        f"JOIN {_per_action('views', keys, 'minutes_count')} m USING ({keys})",
        f"keyed AS ({keyed})",
    )


_SILVER_COUNTRIES = f"""silver AS (
  SELECT video_id, channel_id, user_country AS country, {_COUNTS}
  FROM actions WHERE {_COUNTED} GROUP BY ALL
)"""
_SILVER_AGES = f"""silver AS (
  SELECT video_id, channel_id, user_age AS age, {_COUNTS}
  FROM actions WHERE {_COUNTED} GROUP BY ALL
)"""
_SUMS = """CAST(sum(views_count) AS BIGINT) AS views_count,
    CAST(sum(likes_count) AS BIGINT) AS likes_count,
    CAST(sum(minutes_count) AS BIGINT) AS minutes_count"""


def _gold_by(by: str, silver: str, where: str = "TRUE") -> str:
    return _with(
        f"SELECT channel_id, {by}, {_SUMS} FROM silver WHERE {where} GROUP BY channel_id, {by}",
        silver,
    )


def _shares(by: str, silver: str) -> str:
    def share(m: str) -> str:
        return (
            f"round({m}_count / nullif(sum({m}_count) OVER (PARTITION BY channel_id), 0), 6) "
            f"AS {m}_share"
        )

    return _with(
        f"SELECT channel_id, {by}, {share('views')}, {share('likes')}, {share('minutes')} "
        f"FROM (SELECT channel_id, {by}, {_SUMS} FROM silver GROUP BY channel_id, {by})",
        silver,
    )


def _interaction(where: str = "TRUE") -> str:
    return _with(
        f"""SELECT channel_id, country, hour_offset AS max_interaction_time FROM (
  SELECT channel_id, user_country AS country, timestamp_seconds % 86400 // 3600 AS hour_offset,
    row_number() OVER (PARTITION BY channel_id, user_country
      ORDER BY count(*) DESC, timestamp_seconds % 86400 // 3600 DESC) AS rn
  FROM actions WHERE action = 'first_views' GROUP BY 1, 2, 3
) WHERE rn = 1 AND {where}"""
    )


def _gold_window(entity: str, level: str) -> str:
    counted = _COUNTED if entity == "video" else _CHANNEL_COUNTED
    return _group(
        f"{entity}_id, {_COUNTS}",
        f"{entity}_id",
        f"{counted} AND timestamp_seconds >= {_start(level)}",
    )


def _gold_levels(entity: str) -> str:
    counted = _COUNTED if entity == "video" else _CHANNEL_COUNTED
    parts = [
        f"SELECT '{level}' AS level, {entity}_id, {_COUNTS} FROM actions "
        f"WHERE {counted} AND timestamp_seconds >= {_start(level)} GROUP BY {entity}_id"
        for level in LEVELS
    ]
    return _with(" UNION ALL ".join(parts))


def _board(entity: str, measure: str, level: str) -> str:
    return _with(
        f"""SELECT *, CAST(row_number() OVER (ORDER BY {measure} DESC, {entity}_id) AS INTEGER) AS rank
FROM (SELECT {entity}_id, {_COUNTS} FROM actions
  WHERE {_COUNTED} AND timestamp_seconds >= {_start(level)} GROUP BY {entity}_id)
QUALIFY rank <= 10"""
    )


def _rolling(seconds: int) -> str:
    return _with(
        f"""SELECT video_id, count(*) AS view_count,
  CAST(row_number() OVER (ORDER BY count(*) DESC, video_id) AS INTEGER) AS rank
FROM actions WHERE action = 'first_views' AND timestamp_seconds >= {AS_OF - seconds}
GROUP BY video_id QUALIFY rank <= 10"""
    )


def _category(key: str, seconds: int) -> str:
    return _with(
        f"""SELECT p_type AS category, {key}, count(*) AS view_count,
  CAST(row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, {key}) AS INTEGER)
    AS rank
FROM actions JOIN part ON p_partkey = video_id
WHERE action = 'first_views' AND timestamp_seconds >= {AS_OF - seconds}
GROUP BY p_type, {key} QUALIFY rank <= 10"""
    )


def _history(key: str, value: int) -> str:
    parts = [
        f"SELECT '{level}' AS level, {_COUNTS} FROM actions "
        f"WHERE {key} = {value} AND timestamp_seconds >= {_start(level)}"
        for level in LEVELS
    ]
    return _with(" UNION ALL ".join(parts))


def _peak(actions: str) -> str:
    return _with(
        f"""SELECT timestamp_seconds % 86400 // 3600 AS interaction_hour, user_country,
  count(*) AS interaction_count
FROM actions WHERE action IN ({actions}) GROUP BY 1, 2
ORDER BY interaction_count DESC, interaction_hour DESC, user_country LIMIT 1"""
    )


def _dedup(keys: str, where: str) -> str:
    return _with(
        f"""SELECT action, {keys}, hour AS timestamp_seconds, user_id, event_id
FROM (SELECT *, {_HOUR} AS hour FROM actions WHERE {where})
QUALIFY row_number() OVER (PARTITION BY action, {keys}, hour ORDER BY event_id DESC) = 1"""
    )


_MINUTES = """SELECT video_id, seconds_offset AS minutes_offset,
  count(*) FILTER (WHERE action = 'views') AS views_count,
  count(*) FILTER (WHERE action = 'likes') AS likes_count
FROM actions WHERE action IN ('views', 'likes')"""

_SCORES = """count(*) FILTER (WHERE comment_score <> 0) AS comments_count,
  count(*) AS all_comments_count,
  count(*) FILTER (WHERE comment_score = 1) AS positive_count"""

_POLARITY = """SELECT video_id, positive_count, negative_count
FROM (SELECT video_id, count(*) AS positive_count FROM comments
  WHERE comment_score = 1 GROUP BY video_id) p
JOIN (SELECT video_id, count(*) AS negative_count FROM comments
  WHERE comment_score = -1 GROUP BY video_id) n USING (video_id)"""

_ACCURACY = f"""truth AS (
  SELECT channel_id, user_country AS country, count(*) AS truth
  FROM actions WHERE action = 'first_views' GROUP BY 1, 2
), gold AS (
  SELECT channel_id, user_country AS country,
    count(*) FILTER (WHERE action = 'first_views') AS gold
  FROM actions WHERE {_COUNTED} AND timestamp_seconds < {AS_OF - DAY} GROUP BY 1, 2
), report AS (
  SELECT coalesce(t.channel_id, g.channel_id) AS channel_id,
    coalesce(t.country, g.country) AS country, truth, gold,
    round((truth - coalesce(gold, 0)) / truth, 6) AS signed_error,
    round(abs((truth - coalesce(gold, 0)) / truth), 6) AS absolute_error
  FROM truth t FULL OUTER JOIN gold g
    ON t.channel_id = g.channel_id AND t.country = g.country
)"""

_VIDEO_HOUR = _group(f"video_id, {_HOUR} AS hour_timestamp, {_COUNTS}", "ALL", _COUNTED)

ORACLE: dict[str, str] = {
    "parse_actions_json": _with(
        """SELECT a.action, a.timestamp_seconds, CAST(a.user_id AS INTEGER) AS user_id,
  a.user_country, a.user_age, a.channel_id,
  CASE WHEN a.action <> 'subscribes' THEN a.video_id END AS video_id,
  CASE WHEN a.action IN ('views', 'likes') THEN a.seconds_offset END AS seconds_offset,
  c.comment,
  CASE WHEN a.action <> 'comments' THEN p_type END AS category
FROM actions a
LEFT JOIN comments c USING (event_id)
LEFT JOIN part ON p_partkey = a.video_id""",
        _COMMENTS,
    ),
    "event_time_render": _with(
        "SELECT event_id, timestamp_seconds, "
        "strftime(make_timestamp(timestamp_seconds * 1000000), '%Y-%m-%d %H:%M:%S') AS event_time "
        "FROM actions"
    ),
    "json_rows": _with(
        """SELECT '{' || concat_ws(',', '"video_id":' || video_id,
  '"minutes_offset":' || minutes_offset,
  '"views_count":' || nullif(views_count, 0),
  '"likes_count":' || nullif(likes_count, 0)) || '}' AS json FROM m""",
        f"m AS ({_MINUTES} GROUP BY ALL)",
    ),
    "dedup_video_key": _dedup("video_id, channel_id", "TRUE"),
    "dedup_age_key": _dedup("channel_id, user_age, video_id", _COUNTED),
    "dedup_country_key": _dedup("channel_id, user_country, video_id", _COUNTED),
    "videos_dim": _with(
        f"""SELECT DISTINCT video_id AS id, CAST(p_partkey // 10 AS INTEGER) AS channel_id,
  p_partkey * {DAY} AS creation_date, p_type AS category, p_size AS duration_minutes
FROM actions JOIN part ON p_partkey = video_id WHERE action <> 'comments'"""
    ),
    "channels_dim": _with(
        "SELECT DISTINCT channel_id AS id, CAST(NULL AS INTEGER) AS owner_id, "
        "CAST(NULL AS BIGINT) AS creation_date FROM actions"
    ),
    "increment_slice": _with(
        "SELECT event_id, action, timestamp_seconds FROM actions "
        f"WHERE timestamp_seconds >= {AS_OF - 2 * WEEK} AND timestamp_seconds < {AS_OF - WEEK}"
    ),
    "high_water_marks": _group("action, max(timestamp_seconds) AS high_water", "action"),
    "window_bounds": _with(
        " UNION ALL ".join(
            f"SELECT '{level}' AS level, CAST({_start(level)} AS BIGINT) AS window_start, "
            f"count(*) AS actions FROM actions WHERE timestamp_seconds >= {_start(level)}"
            for level in LEVELS
        )
    ),
    "hour_bucket": _group(f"{_HOUR} AS hour_timestamp, count(*) AS actions", "1"),
    "hour_of_day": _group(
        "timestamp_seconds % 86400 // 3600 AS hour_offset, count(*) AS actions", "1"
    ),
    "minute_index": _with(
        "SELECT event_id, action, CAST(floor(position_seconds / 60) AS INTEGER) AS minutes_offset "
        "FROM actions WHERE action IN ('views', 'likes')"
    ),
    "clean_comments": """SELECT doc_id,
  '"' || replace(replace(text, '''', ''), '"', '') || '"' AS comment FROM documents""",
    "scored_comments": _with("SELECT event_id, video_id, comment_score FROM comments", _COMMENTS),
    "silver_video_hour": _VIDEO_HOUR,
    "silver_channel_hour": _group(
        f"channel_id, {_HOUR} AS hour_timestamp, {_COUNTS}, {_SUBSCRIBES}", "ALL", _CHANNEL_COUNTED
    ),
    "silver_ages": _group(
        f"video_id, channel_id, user_age AS age, {_COUNTS}", "ALL", _COUNTED
    ),
    "silver_countries": _group(
        f"video_id, channel_id, user_country AS country, {_COUNTS}", "ALL", _COUNTED
    ),
    "silver_interaction": _group(
        "video_id, channel_id, user_country AS country, "
        "timestamp_seconds % 86400 // 3600 AS hour_offset, count(*) AS views_count",
        "ALL",
        "action = 'first_views'",
    ),
    "country_views": _group(
        "user_country AS country, count(*) AS views_count", "ALL", "action = 'first_views'"
    ),
    "silver_comments": _with(
        f"SELECT video_id, {_SCORES} FROM comments GROUP BY video_id", _COMMENTS
    ),
    "video_hour_anchored": _anchored(
        "video_id, hour_timestamp", f"SELECT *, {_HOUR} AS hour_timestamp FROM actions"
    ),
    "channel_hour_anchored": _anchored(
        "channel_id, hour_timestamp", f"SELECT *, {_HOUR} AS hour_timestamp FROM actions", True
    ),
    "ages_anchored": _anchored(
        "video_id, channel_id, age", "SELECT *, user_age AS age FROM actions"
    ),
    "countries_anchored": _anchored(
        "video_id, channel_id, country", "SELECT *, user_country AS country FROM actions"
    ),
    "video_minute_anchored": _with(
        f"""SELECT video_id, minutes_offset, coalesce(views_count, 0) AS views_count, likes_count
FROM {_per_action('likes', 'video_id, minutes_offset', 'likes_count')} l
LEFT JOIN {_per_action('views', 'video_id, minutes_offset', 'views_count')} v
  USING (video_id, minutes_offset)""",
        "keyed AS (SELECT *, seconds_offset AS minutes_offset FROM actions)",
    ),
    "channel_countries_inner": _inner("user_country"),
    "channel_ages_inner": _inner("user_age"),
    "comments_pos_neg": _with(_POLARITY, _COMMENTS),
    "histogram_outer": _with(
        f"""SELECT CAST({VIDEO_ID} AS INTEGER) AS video_id, minutes_offset, views_count, likes_count
FROM {_per_action('views', 'minutes_offset', 'views_count')} v
FULL OUTER JOIN {_per_action('likes', 'minutes_offset', 'likes_count')} l USING (minutes_offset)""",
        "keyed AS (SELECT *, seconds_offset AS minutes_offset FROM actions "
        f"WHERE video_id = {VIDEO_ID})",
    ),
    "country_shares": _shares("country", _SILVER_COUNTRIES),
    "age_shares": _shares("age", _SILVER_AGES),
    "gold_ages": _gold_by("age", _SILVER_AGES),
    "gold_countries": _gold_by("country", _SILVER_COUNTRIES),
    "gold_interaction": _interaction(),
    "gold_comments": _with(
        f"SELECT video_id, comments_count, positive_count FROM "
        f"(SELECT video_id, {_SCORES} FROM comments GROUP BY video_id)",
        _COMMENTS,
    ),
    "gold_video_minute": _with(f"{_MINUTES} GROUP BY ALL"),
    "gold_video_levels": _gold_levels("video"),
    "gold_channel_levels": _gold_levels("channel"),
    "channel_views_by_country": _group(
        "channel_id, user_country, count(*) AS channel_views", "ALL", "action = 'first_views'"
    ),
    "channel_views_by_age": _group(
        "channel_id, user_age, count(*) AS channel_views", "ALL", "action = 'first_views'"
    ),
    "channel_views": _group(
        "channel_id, count(*) AS channel_views", "ALL", "action = 'first_views'"
    ),
    "channel_weighted_views": _group(
        "channel_id, seconds_offset, count(*) AS weighted_channel_views",
        "ALL",
        "action = 'views'",
    ),
    "video_totals": _group(
        "video_id, channel_id, count(*) AS views_count", "ALL", "action = 'first_views'"
    ),
    "record_counts": _with(
        "SELECT action, count(*) AS records FROM actions GROUP BY action "
        "UNION ALL SELECT 'all', count(*) FROM actions"
    ),
    "record_total": _with("SELECT count(*) AS records FROM actions"),
    "merge_additive_video_hour": _VIDEO_HOUR,
    "merge_additive_comments": _with(
        f"SELECT video_id, {_SCORES} FROM comments GROUP BY video_id", _COMMENTS
    ),
    "merge_additive_video_minute": _with(f"{_MINUTES} GROUP BY ALL"),
    "merge_overwrite_gold": _with(
        """SELECT * FROM today
UNION ALL SELECT * FROM yesterday WHERE video_id NOT IN (SELECT video_id FROM today)""",
        f"""today AS (SELECT video_id, {_COUNTS} FROM actions
  WHERE {_COUNTED} AND timestamp_seconds >= {_start("last_day")} GROUP BY video_id)""",
        f"""yesterday AS (SELECT video_id, {_COUNTS} FROM actions
  WHERE {_COUNTED} AND timestamp_seconds >= {_start("last_day") - DAY}
    AND timestamp_seconds <= {AS_OF - DAY} GROUP BY video_id)""",
    ),
    "top_positive_videos": _with(
        "SELECT *, CAST(row_number() OVER (ORDER BY positive_count DESC, video_id) AS INTEGER) AS rank "
        f"FROM ({_POLARITY}) QUALIFY rank <= 10",
        _COMMENTS,
    ),
    "global_peak_hour": _peak("'first_views'"),
    "global_peak_hour_all_actions": _peak("'first_views', 'likes', 'subscribes'"),
    "latest_actions": _with(
        "SELECT event_id, action, timestamp_seconds, channel_id, video_id FROM actions "
        "ORDER BY timestamp_seconds DESC, event_id DESC LIMIT 100"
    ),
    "video_history": _history("video_id", VIDEO_ID),
    "channel_history": _history("channel_id", CHANNEL_ID),
    "video_comments": _with(
        f"SELECT positive_count AS comments_positive_count, "
        f"comments_count AS comments_total_count FROM "
        f"(SELECT video_id, {_SCORES} FROM comments GROUP BY video_id) "
        f"WHERE video_id = {VIDEO_ID}",
        _COMMENTS,
    ),
    "channel_interaction": _interaction(f"channel_id = {CHANNEL_ID}"),
    "channel_countries": _gold_by("country", _SILVER_COUNTRIES, f"channel_id = {CHANNEL_ID}"),
    "channel_ages": _gold_by("age", _SILVER_AGES, f"channel_id = {CHANNEL_ID}"),
    "video_histogram": _with(
        "SELECT minutes_offset, views_count, likes_count FROM m ORDER BY minutes_offset",
        f"m AS ({_MINUTES} AND video_id = {VIDEO_ID} GROUP BY ALL)",
    ),
    "accuracy_countries": _with("SELECT * FROM report", _ACCURACY),
    "accuracy_summary": _with(
        """SELECT count(*) AS compared_pairs, round(avg(signed_error), 6) AS mean_signed_error,
  round(avg(absolute_error), 6) AS mean_absolute_error
FROM report WHERE truth IS NOT NULL AND gold IS NOT NULL""",
        _ACCURACY,
    ),
    "freshness_lag": _with(
        f"""SELECT log_high_water, rollup_high_water,
  log_high_water - log_high_water % 3600 - rollup_high_water AS lag_seconds
FROM (SELECT max(timestamp_seconds) AS log_high_water FROM actions WHERE {_COUNTED}),
  (SELECT max({_HOUR}) AS rollup_high_water FROM actions WHERE {_COUNTED})"""
    ),
    "stream_video_hour": _VIDEO_HOUR,
    "stream_hourly_window": _with(
        f"""SELECT video_id, {_HOUR} AS hour_timestamp, {_COUNTS} FROM actions
WHERE {_COUNTED} GROUP BY ALL"""
    ),
}

for _entity in ("video", "channel"):
    for _level in LEVELS:
        ORACLE[f"gold_{_entity}_{_level}"] = _gold_window(_entity, _level)
        ORACLE[f"top_watched_{_entity}s_{_level}"] = _board(_entity, "views_count", _level)
        ORACLE[f"top_liked_{_entity}s_{_level}"] = _board(_entity, "likes_count", _level)

for _period, _seconds in (("hour", HOUR), ("day", DAY), ("week", WEEK)):
    ORACLE[f"rolling_top_videos_{_period}"] = _rolling(_seconds)
    ORACLE[f"top_videos_per_category_{_period}"] = _category("video_id", _seconds)
    ORACLE[f"top_channels_per_category_{_period}"] = _category("channel_id", _seconds)

ORACLE["lake_rolling_day"] = _rolling(DAY)
ORACLE["lake_category_week"] = _category("video_id", WEEK)
ORACLE["lake_channel_category_week"] = _category("channel_id", WEEK)
