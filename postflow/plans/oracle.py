"""The same queries as SQL for DuckDB, over the test tables as views."""

from __future__ import annotations

POSTS = """posts AS (
  SELECT event_id AS tweet_id, 'user_' || user_id AS username,
         'saw #' || event_type || ' #k' || json_extract_string(props, '$.k') AS text,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS retweets,
         CAST(floor(value) AS INTEGER) AS likes, ts AS timestamp
  FROM events)"""

TAGS = POSTS + r""", tags AS (
  SELECT tweet_id, unnest(regexp_extract_all(text, '#([\p{L}\p{N}_]+)', 1)) AS hashtag,
         username, timestamp
  FROM posts)"""

_END = ("time_bucket(INTERVAL 5 MINUTE, timestamp, TIMESTAMP '1970-01-01')"
        " + (o + 1) * INTERVAL 5 MINUTE")

# The posts in four slices of their time span, and the newest post of all later slices.
SLICED = POSTS + """, span AS (
  SELECT CAST(floor(epoch(min(timestamp))) AS BIGINT) AS first,
         CAST(floor(epoch(max(timestamp))) AS BIGINT) AS last FROM posts),
sliced AS (
  SELECT posts.*, (CAST(floor(epoch(timestamp)) AS BIGINT) - first) // ((last - first) // 4 + 1)
         AS slice FROM posts, span),
ends AS (
  SELECT slice, max(max(timestamp)) OVER (
    ORDER BY slice ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later
  FROM sliced GROUP BY slice)"""

HASHTAG_WINDOWS = TAGS + f""", hw AS (
  SELECT hashtag, count(*) AS count, {_END} AS window_end, max(timestamp) AS timestamp
  FROM tags CROSS JOIN range(3) r(o) GROUP BY hashtag, window_end)"""

_USERS = f"""
  SELECT username, count(*) AS tweet_count, CAST(sum(likes) AS BIGINT) AS total_likes,
         CAST(sum(retweets) AS BIGINT) AS total_retweets, {_END} AS window_end,
         max(timestamp) AS timestamp"""

USER_WINDOWS = POSTS + f""", uw AS ({_USERS}
  FROM posts CROSS JOIN range(3) r(o) GROUP BY username, window_end)"""

BOTH_WINDOWS = HASHTAG_WINDOWS + USER_WINDOWS[len(POSTS):]

ISO = """CASE WHEN date_trunc('second', {0}) = {0} THEN strftime({0}, '%Y-%m-%dT%H:%M:%S')
 ELSE strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') END"""

TWEET_JSON = """CAST(json_object('tweet_id', tweet_id, 'username', username, 'text', text,
 'retweets', retweets, 'likes', likes, 'timestamp', CAST(timestamp AS VARCHAR)) AS VARCHAR)"""

MESSAGES = TAGS + f""", messages AS (
  SELECT 'tweets_topic' AS topic, {TWEET_JSON} AS value FROM posts
  UNION ALL
  SELECT 'hashtags_topic', CAST(json_object('tweet_id', tweet_id, 'hashtag', hashtag,
    'username', username, 'timestamp', CAST(timestamp AS VARCHAR)) AS VARCHAR) FROM tags
  UNION ALL
  SELECT 'user_activity_topic', CAST(json_object('username', username, 'tweet_count', 1,
    'hashtag_count', 2, 'retweets', retweets, 'likes', likes,
    'timestamp', {ISO.format('timestamp')}) AS VARCHAR) FROM posts)"""

BROKEN = POSTS + f""", sent AS (SELECT *, {TWEET_JSON} AS raw, tweet_id % 10 AS kind FROM posts)"""

AS_STORED = "timestamp AS last_updated"

_DOCUMENT_POSTS = r"""SELECT CAST(doc_id AS BIGINT) AS tweet_id,
 source || CASE WHEN doc_id % 3 = 0 THEN ' 5"' ELSE '' END AS username,
 regexp_replace(text, '\r\n?', chr(10), 'g') AS text,
 CAST(n_chars % 100 AS INTEGER) AS retweets,
 CASE WHEN lang = 'en' THEN CAST(n_chars AS INTEGER) END AS likes,
 TIMESTAMP '2023-01-01' + to_seconds(doc_id) AS timestamp FROM documents"""

METRICS = """metrics AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'batch_' || event_type
              ELSE 'spark_streaming_' || event_type || '_counts' END AS query_id,
         CASE WHEN event_id % 2 = 0 THEN 'batch' ELSE 'streaming' END AS execution_mode,
         value AS execution_time
  FROM events),
summary AS (
  SELECT query_id, execution_mode, avg(execution_time) AS avg_time, count(*) AS executions
  FROM metrics GROUP BY ALL),
compared AS (
  SELECT replace(b.query_id, 'batch_', '') AS query_type, s.query_id AS stream_id,
         s.avg_time AS stream_avg, b.avg_time AS batch_avg,
         abs(s.avg_time - b.avg_time) AS difference,
         CASE WHEN s.avg_time < b.avg_time THEN 'Streaming' ELSE 'Batch' END AS faster,
         greatest(s.avg_time, b.avg_time) / least(s.avg_time, b.avg_time) AS factor
  FROM summary b JOIN summary s
    ON NOT starts_with(b.execution_mode, 'streaming') AND starts_with(s.execution_mode, 'streaming')
   AND contains(s.query_id, replace(b.query_id, 'batch_', ''))
  WHERE b.avg_time > 0 AND s.avg_time > 0)"""

TOP_HASHTAGS = """SELECT hashtag, CAST(sum(count) AS BIGINT) AS total_count FROM hw
 GROUP BY hashtag ORDER BY total_count DESC NULLS FIRST, hashtag LIMIT 10"""
TOP_USERS = """SELECT username, CAST(sum(tweet_count) AS BIGINT) AS total_tweets FROM uw
 GROUP BY username ORDER BY total_tweets DESC NULLS FIRST, username LIMIT 10"""
TOP_AVERAGES = """SELECT username, CAST(sum(total_likes) AS BIGINT) AS sum_likes,
 CAST(sum(tweet_count) AS BIGINT) AS sum_tweets,
 CASE WHEN sum(tweet_count) > 0
      THEN CAST(sum(total_likes) AS DOUBLE) / CAST(sum(tweet_count) AS BIGINT)
      ELSE 0 END AS avg_likes_per_tweet
 FROM uw GROUP BY username ORDER BY avg_likes_per_tweet DESC NULLS FIRST, username LIMIT 10"""
RATIO = """CASE WHEN tweet_count > 0 THEN CAST(total_likes AS DOUBLE) / tweet_count ELSE 0 END
 AS avg_likes_per_tweet"""

INSERT_IGNORE = """
SELECT tweet_id, username, {text}, retweets, likes, timestamp FROM (
  SELECT * REPLACE (CAST(split_part(username, '_', 2) AS {id}) AS tweet_id),
         row_number() OVER (PARTITION BY username ORDER BY retweets % {n}, timestamp,
                            text, retweets, likes) AS n
  FROM posts) WHERE n = 1"""

OVERWRITE = """
SELECT username, tweet_count, total_likes, total_retweets, window_end, last_updated FROM (
  SELECT *, row_number() OVER (PARTITION BY username, window_end ORDER BY batch DESC) AS n FROM (
    SELECT username, count(*) AS tweet_count, CAST(sum(likes) AS BIGINT) AS total_likes,
      CAST(sum(retweets) AS BIGINT) AS total_retweets,
      time_bucket(INTERVAL 5 MINUTE, timestamp, TIMESTAMP '1970-01-01')
        + (o + 1) * INTERVAL 5 MINUTE AS window_end, max(timestamp) AS last_updated,
      retweets % {n} AS batch
    FROM posts CROSS JOIN range(3) r(o) GROUP BY username, window_end, batch)) WHERE n = 1"""

INCREMENT_HASHTAGS = """
SELECT hashtag, CAST(sum(count) AS BIGINT) AS count, window_end,
       arg_max(last_updated, batch) AS last_updated
FROM (SELECT hashtag, date_trunc('hour', t.timestamp) AS window_end, retweets % {n} AS batch,
             count(*) AS count, max(t.timestamp) AS last_updated
      FROM tags t JOIN posts USING (tweet_id) GROUP BY ALL)
GROUP BY hashtag, window_end"""

INCREMENT_USERS = """
SELECT username, CAST(sum(n) AS BIGINT) AS tweet_count, CAST(sum(l) AS BIGINT) AS total_likes,
       CAST(sum(r) AS BIGINT) AS total_retweets, window_end,
       arg_max(last_updated, batch) AS last_updated
FROM (SELECT username, date_trunc('hour', timestamp) AS window_end, retweets % {n} AS batch,
             count(*) AS n, sum(likes) AS l, sum(retweets) AS r, max(timestamp) AS last_updated
      FROM posts GROUP BY ALL)
GROUP BY username, window_end"""

STORED_HASHTAGS = f"SELECT hashtag, count, window_end, {AS_STORED} FROM hw"
STORED_USERS = f"""SELECT username, tweet_count, total_likes, total_retweets, window_end,
 {AS_STORED} FROM uw"""

_HASHTAG_SIZE = "(SELECT count(*) FROM hw), (SELECT CAST(sum(count) AS BIGINT) FROM hw)"
_USER_SIZE = "(SELECT count(*) FROM uw), (SELECT CAST(sum(total_likes) AS BIGINT) FROM uw)"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


ORACLE = {
    "hashtag_extract": _with(POSTS, r"""SELECT tweet_id,
 array_to_string(regexp_extract_all(text, '#([\p{L}\p{N}_]+)', 1), ' ') AS hashtags FROM posts"""),
    "hashtag_explode": _with(TAGS, "SELECT * FROM tags"),
    "hashtag_count_per_post": _with(POSTS, r"""SELECT tweet_id,
 CAST(len(regexp_extract_all(text, '#([\p{L}\p{N}_]+)', 1)) AS INTEGER) AS hashtag_count
 FROM posts"""),
    "url_fragments": r"""SELECT page_id,
 unnest(regexp_extract_all(url, '#([\p{L}\p{N}_]+)', 1)) AS fragment FROM pages""",
    "page_hashtags": r"""SELECT hashtag, count(*) AS count FROM (
 SELECT unnest(regexp_extract_all(replace(html, '<p>', '<p>#'), '#([\p{L}\p{N}_]+)', 1)) AS hashtag
 FROM pages)
 GROUP BY hashtag""",
    "document_hashtag_counts": r"""SELECT doc_id,
 CAST(coalesce(len(regexp_extract_all(replace(text, '. ', '. #'), '#([\p{L}\p{N}_]+)', 1)), 0) AS INTEGER)
 AS hashtag_count FROM documents""",
    "escape_quotes": """SELECT doc_id,
 replace(replace(text, 'e', ''''), '''', '''''') AS text FROM documents""",
    "iso_times": _with(POSTS, f"""SELECT tweet_id, {ISO.format('timestamp')} AS iso,
 {ISO.format("date_trunc('minute', timestamp)")} AS iso_minute FROM posts"""),
    "post_project_cast": _with(POSTS, """SELECT CAST(tweet_id AS BIGINT) AS tweet_id, username,
 text, CASE WHEN NOT contains(text, '#error') THEN retweets END AS retweets, likes, timestamp
 FROM posts"""),
    "user_activity_rows": _with(POSTS, """SELECT username, 1 AS tweet_count, 2 AS hashtag_count,
 retweets, likes, timestamp FROM posts"""),
    "csv_scan": _DOCUMENT_POSTS,
    "csv_record_sep_scan": _DOCUMENT_POSTS,
    "post_sample": _with(POSTS, "SELECT * FROM posts ORDER BY tweet_id LIMIT 200"),
    "json_roundtrip": _with(POSTS, """SELECT CAST(tweet_id AS BIGINT) AS tweet_id, username,
 text, retweets, likes, timestamp FROM posts"""),
    "json_wide_ids": _with(POSTS, """SELECT tweet_id + 3000000000 AS tweet_id, username,
 text AS tweet_text, retweets, likes, timestamp FROM posts"""),
    "json_rejects": _with(BROKEN, """SELECT 'tweets_topic' AS topic,
 CASE kind WHEN 1 THEN raw[:len(raw) - 9]
   WHEN 3 THEN replace(raw, '"likes":' || likes, '"likes":99999999999')
   WHEN 5 THEN replace(raw, '"likes":' || likes, '"likes":null')
   ELSE replace(raw, '"timestamp":"2024', '"timestamp":"x') END AS raw,
 CASE kind WHEN 1 THEN 'tweet_id,username,text,retweets,likes,timestamp' WHEN 7 THEN 'timestamp' ELSE 'likes' END AS missing
 FROM sent WHERE kind IN (1, 3, 5, 7)"""),
    "json_accepted": _with(BROKEN, """SELECT CAST(tweet_id AS BIGINT) AS tweet_id, username,
 text, retweets, likes, timestamp FROM sent WHERE kind NOT IN (1, 3, 5, 7)"""),
    "message_fanout": _with(MESSAGES, "SELECT topic, value FROM messages"),
    "window_republish": _with(BOTH_WINDOWS, f"""SELECT 'hashtag_windows_topic' AS topic,
 CAST(json_object('hashtag', hashtag, 'count', count, 'window_end', {ISO.format('window_end')},
   'timestamp', {ISO.format('timestamp')}) AS VARCHAR) AS value FROM hw
 UNION ALL SELECT 'user_windows_topic',
 CAST(json_object('username', username, 'tweet_count', tweet_count, 'total_likes', total_likes,
   'total_retweets', total_retweets, 'window_end', {ISO.format('window_end')},
   'timestamp', {ISO.format('timestamp')}) AS VARCHAR) FROM uw"""),
    "hashtag_windows": _with(HASHTAG_WINDOWS, "SELECT * FROM hw"),
    "hashtag_windows_direct": _with(HASHTAG_WINDOWS, "SELECT * FROM hw"),
    "user_windows": _with(USER_WINDOWS, "SELECT * FROM uw"),
    "user_windows_direct": _with(USER_WINDOWS, "SELECT * FROM uw"),
    "top_hashtags": _with(HASHTAG_WINDOWS, TOP_HASHTAGS),
    "top_users": _with(USER_WINDOWS, TOP_USERS),
    "avg_likes_per_user": _with(USER_WINDOWS, TOP_AVERAGES),
    "top_hashtags_exact": _with(TAGS, """SELECT hashtag, count(*) AS total_count FROM tags
 GROUP BY hashtag ORDER BY total_count DESC, hashtag LIMIT 10"""),
    "top_users_exact": _with(POSTS, """SELECT username, count(*) AS total_tweets FROM posts
 GROUP BY username ORDER BY total_tweets DESC, username LIMIT 10"""),
    "top_hashtag_rows": _with(HASHTAG_WINDOWS, """SELECT hashtag, count FROM hw
 ORDER BY count DESC NULLS FIRST, hashtag, window_end LIMIT 10"""),
    "top_user_rows": _with(USER_WINDOWS, """SELECT username, tweet_count FROM uw
 ORDER BY tweet_count DESC NULLS FIRST, username, window_end LIMIT 10"""),
    "avg_likes_rows": _with(USER_WINDOWS, f"""SELECT username, total_likes, tweet_count, {RATIO}
 FROM uw ORDER BY avg_likes_per_tweet DESC NULLS FIRST, username, window_end LIMIT 10"""),
    "stored_hashtag_rows": _with(HASHTAG_WINDOWS, """SELECT * FROM hw
 ORDER BY count DESC NULLS FIRST, hashtag, window_end LIMIT 10"""),
    "stored_user_rows": _with(USER_WINDOWS, """SELECT * FROM uw
 ORDER BY tweet_count DESC NULLS FIRST, username, window_end LIMIT 10"""),
    "row_ratios": _with(USER_WINDOWS, f"SELECT username, total_likes, tweet_count, {RATIO} FROM uw"),
    "report_lines": _with(BOTH_WINDOWS, f"""
 SELECT 'batch_top_hashtags' AS report, printf('#%s: %d', hashtag, total_count) AS line
 FROM ({TOP_HASHTAGS})
 UNION ALL SELECT 'batch_top_users', printf('%s: %d tweets', username, total_tweets)
 FROM ({TOP_USERS})
 UNION ALL SELECT 'batch_avg_likes',
   printf('%s: %.2f avg likes (%d total likes over %d tweets)',
          username, avg_likes_per_tweet, sum_likes, sum_tweets)
 FROM ({TOP_AVERAGES})"""),
    "sql_reports": _with(BOTH_WINDOWS, f"""
 SELECT hashtag AS name, total_count AS total FROM ({TOP_HASHTAGS})
 UNION ALL SELECT username, total_tweets FROM ({TOP_USERS})"""),
    "merge_insert_ignore": _with(POSTS, INSERT_IGNORE.format(text="text", id="BIGINT", n=2)),
    "merge_overwrite": _with(POSTS, OVERWRITE.format(n=2)),
    "merge_increment_hashtags": _with(TAGS, INCREMENT_HASHTAGS.format(n=2)),
    "merge_increment_users": _with(POSTS, INCREMENT_USERS.format(n=2)),
    "table_insert_ignore": _with(
        POSTS, INSERT_IGNORE.format(text="text AS tweet_text", id="BIGINT", n=3)),
    "table_overwrite": _with(POSTS, OVERWRITE.format(n=3)),
    "table_increment": _with(POSTS, INCREMENT_USERS.format(n=3)),
    "metrics_summary": _with(METRICS, """SELECT query_id, execution_mode,
 round(avg_time, 4) AS avg_time, executions FROM summary ORDER BY query_id, execution_mode"""),
    "metrics_total": "SELECT round(sum(value), 4) AS total_time FROM events",
    "metrics_compare": _with(METRICS, """SELECT query_type, stream_id,
 round(stream_avg, 4) AS stream_avg, round(batch_avg, 4) AS batch_avg,
 round(difference, 4) AS difference, faster, round(factor, 4) AS factor FROM compared"""),
    "metrics_compare_lines": _with(METRICS, """SELECT
 printf('%-25s %-20s %-20s %-15s %s is %.2fx faster', query_type, printf('%.2f', stream_avg),
        printf('%.2f', batch_avg), printf('%.2f', difference), faster, factor) AS line
 FROM compared"""),
    "user_name_matches": _with(POSTS + ", names AS (SELECT DISTINCT username FROM posts)", """
 SELECT a.username AS part, b.username AS whole
 FROM names a JOIN names b ON contains(b.username, a.username)"""),
    "stream_append_raw": _with(POSTS, """SELECT CAST(tweet_id AS BIGINT) AS tweet_id, username,
 text AS tweet_text, retweets, likes, timestamp FROM posts"""),
    "stream_complete_hashtags": _with(HASHTAG_WINDOWS, STORED_HASHTAGS),
    "stream_complete_users": _with(USER_WINDOWS, STORED_USERS),
    "stream_complete_hashtags_direct": _with(HASHTAG_WINDOWS, STORED_HASHTAGS),
    "stream_complete_users_direct": _with(USER_WINDOWS, STORED_USERS),
    "stream_update_merge_hashtags": _with(HASHTAG_WINDOWS, STORED_HASHTAGS),
    "stream_update_merge_users": _with(USER_WINDOWS, STORED_USERS),
    "stream_increment_hashtags": _with(TAGS, """SELECT hashtag, count(*) AS count,
 timestamp AS window_end, timestamp AS last_updated FROM tags GROUP BY hashtag, timestamp"""),
    "stream_increment_users": _with(POSTS, """SELECT username, count(*) AS tweet_count,
 CAST(sum(likes) AS BIGINT) AS total_likes, CAST(sum(retweets) AS BIGINT) AS total_retweets,
 timestamp AS window_end, timestamp AS last_updated FROM posts GROUP BY username, timestamp"""),
    "stream_rejects": _with(MESSAGES, """SELECT topic, value[:len(value) - 9] AS raw,
 count(*) AS n FROM messages
 WHERE CASE WHEN topic = 'hashtags_topic' THEN contains(value, '"hashtag":"k1')
       ELSE CAST(json_extract_string(value, '$.likes') AS INTEGER) % 10 = 3 END
 GROUP BY ALL"""),
    "metrics_logged": _with(BOTH_WINDOWS, """
 SELECT 'batch_top_hashtags' AS query_id, 'batch' AS execution_mode, 'all' AS window_size,
        least(10, count(DISTINCT hashtag)) AS records_processed FROM hw
 UNION ALL SELECT name, 'batch', 'all', least(10, count(DISTINCT username))
 FROM uw, (VALUES ('batch_top_users'), ('batch_avg_likes')) v(name) GROUP BY name"""),
    "stream_metrics_logged": _with(MESSAGES, """
 SELECT CASE topic WHEN 'tweets_topic' THEN 'spark_streaming_load_tweets'
             WHEN 'hashtags_topic' THEN 'spark_streaming_load_hashtag_counts'
             ELSE 'spark_streaming_load_user_activity' END AS query_id,
        'streaming' AS execution_mode, '15 minutes' AS window_size, count(*) AS records
 FROM messages GROUP BY topic"""),
    "metrics_compare_families": """WITH runs AS (
  SELECT CASE event_type WHEN 'click' THEN 'hashtag' WHEN 'view' THEN 'user' ELSE 'tweets' END AS kind,
         event_id % 2 = 0 AS batch, avg(value) AS mean
  FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY ALL)
SELECT rtrim(b.kind, 's') || 's' AS query_family, 'batch_of_' || b.kind AS batch_id,
       'streaming_of_' || s.kind AS stream_id, round(s.mean, 4) AS stream_avg,
       round(b.mean, 4) AS batch_avg, round(abs(s.mean - b.mean), 4) AS difference,
       CASE WHEN s.mean < b.mean THEN 'Streaming' ELSE 'Batch' END AS faster,
       round(greatest(s.mean, b.mean) / least(s.mean, b.mean), 4) AS factor
FROM runs b JOIN runs s ON b.kind = s.kind AND b.batch AND NOT s.batch
WHERE b.mean > 0 AND s.mean > 0""",
    "processed_results": _with(BOTH_WINDOWS, """
 SELECT 'hashtags' AS result, hashtag AS name, CAST(sum(count) AS BIGINT) AS count,
        CAST(NULL AS BIGINT) AS likes, CAST(NULL AS BIGINT) AS retweets FROM hw GROUP BY hashtag
 UNION ALL SELECT 'users', username, CAST(sum(tweet_count) AS BIGINT),
        CAST(sum(total_likes) AS BIGINT), CAST(sum(total_retweets) AS BIGINT)
 FROM uw GROUP BY username"""),
    "stored_results": _with(BOTH_WINDOWS, """
 SELECT side || '_hashtags' AS result, hashtag AS name, CAST(sum(count) AS BIGINT) AS count,
        CAST(NULL AS BIGINT) AS total_likes, CAST(NULL AS BIGINT) AS total_retweets
 FROM hw, (VALUES ('stream'), ('batch')) v(side) GROUP BY side, hashtag
 UNION ALL SELECT side || '_users', username, CAST(sum(tweet_count) AS BIGINT),
        CAST(sum(total_likes) AS BIGINT), CAST(sum(total_retweets) AS BIGINT)
 FROM uw, (VALUES ('stream'), ('batch')) v(side) GROUP BY side, username"""),
    "stream_republish": _with(USER_WINDOWS, f"""SELECT 'user_windows_topic' AS topic,
 CAST(json_object('username', username, 'tweet_count', tweet_count, 'total_likes', total_likes,
   'total_retweets', total_retweets, 'window_end', {ISO.format('window_end')},
   'timestamp', {ISO.format('timestamp')}) AS VARCHAR) AS value FROM uw"""),
    "stream_fanout": _with(MESSAGES, "SELECT topic, value FROM messages"),
    "stream_analysis": _with(BOTH_WINDOWS, f"""
 SELECT 'tweets' AS table_name, count(*) AS n_rows, CAST(sum(likes) AS BIGINT) AS total FROM posts
 UNION ALL SELECT 'hashtag_counts', {_HASHTAG_SIZE}
 UNION ALL SELECT 'hashtag_counts_direct', {_HASHTAG_SIZE}
 UNION ALL SELECT 'user_activity', {_USER_SIZE}
 UNION ALL SELECT 'user_activity_direct', {_USER_SIZE}"""),
    "stream_loads": _with(TAGS, """
 SELECT 'tweets' AS table_name, count(*) AS n_rows, CAST(sum(likes) AS BIGINT) AS total FROM posts
 UNION ALL SELECT 'hashtag_counts', (SELECT count(*) FROM (
   SELECT DISTINCT hashtag, timestamp FROM tags)), (SELECT count(*) FROM tags)
 UNION ALL SELECT 'user_activity', (SELECT count(*) FROM (
   SELECT DISTINCT username, timestamp FROM posts)), (SELECT CAST(sum(likes) AS BIGINT) FROM posts)
 """),
    "stream_shared_hashtags": _with(HASHTAG_WINDOWS, STORED_HASHTAGS),
    "stream_shared_users": _with(USER_WINDOWS, STORED_USERS),
    "stream_batch_parity": _with(USER_WINDOWS, """SELECT count(*) AS left_rows,
 count(*) AS right_rows, CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right
 FROM uw"""),
    "stream_metrics_keyed": _with(POSTS, """SELECT 'spark_streaming_keyed' AS query_id,
 CAST(2 AS BIGINT) AS n_runs, CAST(4 AS BIGINT) AS n_batches, count(*) AS records,
 count(*) AS accepted, CAST(0 AS BIGINT) AS rejected FROM posts"""),
    "stream_observed": _with(POSTS, """SELECT count(*) FILTER (likes % 10 <> 3) AS accepted,
 count(*) FILTER (likes % 10 = 3) AS rejected, count(*) FILTER (likes % 10 <> 3) AS stored,
 count(*) FILTER (likes % 10 = 3) AS kept FROM posts"""),
    "stream_late_rows": _with(SLICED, """SELECT CAST(tweet_id AS BIGINT) AS tweet_id, window_end
 FROM (SELECT s.*, """ + _END + """ AS window_end FROM sliced s CROSS JOIN range(3) r(o)) w
 JOIN ends USING (slice) WHERE window_end <= later - INTERVAL 20 MINUTE"""),
    "stream_chained_windows": _with(HASHTAG_WINDOWS, f"""{STORED_HASHTAGS}
 WHERE window_end <= (SELECT max(timestamp) FROM posts) - INTERVAL 20 MINUTE"""),
    "catalog_hashtags": _with(HASHTAG_WINDOWS, """SELECT CAST(window_end AS DATE) AS day, hashtag,
 count(*) AS n_windows, CAST(sum(count) AS BIGINT) AS n_tags FROM hw GROUP BY ALL"""),
    "stream_state_rows": _with(USER_WINDOWS, """SELECT window_end, count(*) AS n_keys FROM uw
 WHERE window_end > (SELECT max(timestamp) FROM posts) - INTERVAL 20 MINUTE GROUP BY window_end"""),
    "stream_republish_once": _with(SLICED, f"""SELECT 'user_windows_topic' AS topic,
 CAST(json_object('username', username, 'tweet_count', tweet_count, 'total_likes', total_likes,
   'total_retweets', total_retweets, 'window_end', {ISO.format('window_end')},
   'timestamp', {ISO.format('timestamp')}) AS VARCHAR) AS value
 FROM (SELECT username, window_end, slice,
         CAST(sum(n) OVER upto AS BIGINT) AS tweet_count,
         CAST(sum(likes) OVER upto AS BIGINT) AS total_likes,
         CAST(sum(retweets) OVER upto AS BIGINT) AS total_retweets,
         max(last) OVER upto AS timestamp
       FROM (SELECT username, slice, {_END} AS window_end, count(*) AS n, sum(likes) AS likes,
               sum(retweets) AS retweets, max(timestamp) AS last
             FROM sliced CROSS JOIN range(3) r(o) GROUP BY username, slice, window_end) parts
       WINDOW upto AS (PARTITION BY username, window_end ORDER BY slice))"""),
}
