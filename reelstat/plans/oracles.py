"""The same queries as SQL over the same tables, to check results against another engine."""

from __future__ import annotations

AS_OF = "2001-07-31"

MOVIE = """
movie AS (
  SELECT p_partkey AS mid, p_name AS movie_name, 'img/' || p_partkey AS img_urls,
         p_type AS directors, replace(p_name, ' ', '|') AS main_actors,
         replace(p_name, ' ', '|') || '|' || p_type AS categories,
         p_brand AS location, 'lang' || (p_size % 5) AS language,
         strftime(DATE '1990-01-01' + CAST(p_partkey % 3650 AS INTEGER), '%Y-%m-%d') AS release_date,
         p_retailprice AS rating_num,
         CAST(p_size % 7 = 0 AS INTEGER) AS off_shelf
  FROM part)"""

RATING = """
rating AS (
  SELECT o_custkey AS uid, l_partkey AS mid, l_quantity * 2 AS rating,
         strftime(l_shipdate, '%Y-%m-%d') AS date, l_orderkey, l_linenumber, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

HOT = MOVIE + """,
counts AS (
  SELECT l_partkey AS mid, count(*) AS rating_count,
         count(*) FILTER (WHERE l_returnflag = 'R') AS comment_count,
         count(*) FILTER (WHERE l_linestatus = 'O') AS collection_count,
         count(*) FILTER (WHERE l_tax >= 0.04) AS play_count
  FROM lineitem GROUP BY 1),
activity AS (
  SELECT movie.*, coalesce(rating_count, 0) AS rating_count,
         coalesce(comment_count, 0) AS comment_count,
         coalesce(collection_count, 0) AS collection_count,
         coalesce(play_count, 0) AS play_count
  FROM movie LEFT JOIN counts USING (mid)),
hot AS (
  SELECT *, (rating_count - 1) * 0.5::DOUBLE + comment_count * 0.1::DOUBLE
            + collection_count * 0.2::DOUBLE
            + play_count * 1.0::DOUBLE / pow(greatest(24 * date_diff('day', CAST(release_date AS DATE), DATE '2001-07-31'), 0) + 2, 1.8::DOUBLE)
            AS hot_degree
  FROM activity)"""

ENTRY = "mid, movie_name, round(hot_degree, 6) AS hot_degree, img_urls, rating_num, categories"


def _top(source: str, order: str, columns: str = "", shown: str = ENTRY) -> str:
    return f"""
SELECT '{AS_OF}' AS date, {columns} rank, {shown}
FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM {source}) WHERE rank <= 10"""


def _period(condition: str) -> str:
    return f"""
WITH {MOVIE},
counted AS (
  SELECT l_partkey AS mid, count(*) AS rating_count FROM lineitem WHERE {condition} GROUP BY 1),
rated AS (SELECT *, 0.0::DOUBLE AS hot_degree FROM movie JOIN counted USING (mid))
{_top("rated", "rating_count DESC, mid", shown=ENTRY + ", rating_count")}"""


EVENT = """
event AS (
  SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

ACTION = EVENT + """,
action AS (
  SELECT CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS date, user_id AS userId,
         user_id || '-' || strftime(ts, '%Y-%m-%d') AS sessionId,
         CASE event_type WHEN 'view' THEN 'index' WHEN 'click' THEN 'detail'
              WHEN 'purchase' THEN 'play' WHEN 'signup' THEN 'comment'
              ELSE CASE WHEN k % 2 = 0 THEN 'rating' ELSE 'collect' END END AS pageId,
         event_type AS searchKeyword,
         CASE WHEN event_type = 'click' THEN k % 10 END AS clickCategoryId,
         CASE WHEN event_type = 'purchase' THEN k % 10 END AS collectCategoryId,
         CASE WHEN event_type = 'signup' THEN k % 10 END AS ratingCategoryId,
         CASE WHEN event_type = 'error' THEN k % 10 END AS commentCategoryId,
         CASE WHEN event_type = 'click' THEN k END AS clickMovieId,
         CASE WHEN event_type = 'purchase' THEN k END AS collectMovieId,
         CASE WHEN event_type = 'signup' THEN k END AS ratingMovieId,
         CASE WHEN event_type = 'error' THEN k END AS commentMovieId,
         user_id % 25 AS cityId, event_id
  FROM event)"""

LOG = EVENT + """,
log AS (
  SELECT user_id AS uid, '10.0.0.' || (user_id % 256) AS ip, k AS mid,
         CASE event_type WHEN 'purchase' THEN 'play' ELSE event_type END AS event,
         epoch_us(ts) // 1000 AS timestamp
  FROM event)"""

USERS = """
users AS (
  SELECT c_custkey AS userId, CAST(18 + c_custkey % 50 AS INTEGER) AS age,
         c_mktsegment AS professional, n_name AS city, CAST(c_custkey % 2 AS INTEGER) AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

SESSION = ACTION + "," + USERS + """,
folded AS (
  SELECT sessionId, min(userId) AS userId,
         coalesce(array_to_string(list_sort(list_distinct(list(searchKeyword))), '-'), '') AS searchKeywords,
         coalesce(list_sort(list_distinct(list(clickCategoryId) FILTER (WHERE clickCategoryId IS NOT NULL))), []) AS categories,
         max(date) - min(date) AS visitLength, count(*) AS stepLength, min(date) AS startTime
  FROM action GROUP BY sessionId),
session AS (
  SELECT sessionId, searchKeywords, coalesce(array_to_string(categories, '-'), '') AS clickCategoryIds,
         categories, visitLength, stepLength, startTime, age, professional, city, sex
  FROM folded JOIN users USING (userId))"""

SESSION_COLUMNS = (
    "sessionId, searchKeywords, clickCategoryIds, visitLength, stepLength, startTime, age, "
    "professional, city, sex"
)

TOP_CATEGORY = """
uses AS (
  SELECT clickCategoryId AS categoryId, 1 AS c, 0 AS o, 0 AS r, 0 AS m FROM action
  UNION ALL SELECT collectCategoryId, 0, 1, 0, 0 FROM action
  UNION ALL SELECT ratingCategoryId, 0, 0, 1, 0 FROM action
  UNION ALL SELECT commentCategoryId, 0, 0, 0, 1 FROM action),
category AS (
  SELECT categoryId, CAST(sum(c) AS BIGINT) AS clickCount, CAST(sum(o) AS BIGINT) AS collectCount,
         CAST(sum(r) AS BIGINT) AS ratingCount, CAST(sum(m) AS BIGINT) AS commentCount
  FROM uses WHERE categoryId IS NOT NULL GROUP BY 1),
top_category AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      ORDER BY clickCount DESC, collectCount DESC, ratingCount DESC, commentCount DESC, categoryId) AS rank
    FROM category) WHERE rank <= 10)"""

TOP_SESSION = TOP_CATEGORY + """,
tagged AS (
  SELECT sessionId, userId,
         CASE WHEN commentCategoryId > 0 THEN commentCategoryId WHEN ratingCategoryId > 0 THEN ratingCategoryId
              WHEN collectCategoryId > 0 THEN collectCategoryId WHEN clickCategoryId > 0 THEN clickCategoryId
              ELSE 0 END AS categoryId
  FROM action),
session_count AS (
  SELECT categoryId, sessionId, min(userId) AS userId, count(*) AS count FROM tagged
  WHERE categoryId > 0 AND categoryId IN (SELECT categoryId FROM top_category) GROUP BY 1, 2),
top_session AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY categoryId ORDER BY count DESC, sessionId) AS rank
    FROM session_count) WHERE rank <= 50)"""

STEP = ACTION + """,
known AS (
  SELECT sessionId, pageId AS kind,
         lead(pageId) OVER (PARTITION BY sessionId ORDER BY date, event_id) AS next
  FROM action),
totals AS (
  SELECT count(*) FILTER (WHERE kind = 'index') AS "index",
         count(*) FILTER (WHERE kind = 'detail') AS detail,
         count(*) FILTER (WHERE kind = 'index' AND next = 'detail') AS index_detail,
         count(*) FILTER (WHERE kind = 'detail' AND next = 'comment') AS detail_comment,
         count(*) FILTER (WHERE kind = 'detail' AND next = 'rating') AS detail_rating,
         count(*) FILTER (WHERE kind = 'detail' AND next = 'collect') AS detail_collect,
         count(*) FILTER (WHERE kind = 'detail' AND next = 'play') AS detail_play
  FROM known)"""


def _rate(first: str, second: str, name: str) -> str:
    return (
        f"round(coalesce({first}_{second}::DOUBLE / nullif(\"{first}\", 0), 0.0), 6) AS \"{name}\""
    )


VISIT = (
    ("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 30, 60),
    ("1m_3m", 60, 180), ("3m_10m", 180, 600), ("10m_30m", 600, 1800), ("30m", 1800, None),
)
STEPS = (
    ("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 30, 60), ("60", 60, None),
)


def _bucket_case(value: str, buckets) -> str:
    arms = " ".join(
        f"WHEN {value} > {low} THEN '{label}'" if high is None
        else f"WHEN {value} BETWEEN {low} AND {high} THEN '{label}'"
        for label, low, high in buckets
    )
    return f"CASE {arms} END"


def _stat_rows() -> str:
    rows = ["SELECT 'session_count' AS key, count(*)::DOUBLE AS value FROM bucketed"]
    for kind, buckets in (("visit", VISIT), ("step", STEPS)):
        for label, _, _ in buckets:
            rows.append(
                f"SELECT '{kind}_length_ratio_{label}', coalesce(round("
                f"count(*) FILTER (WHERE {kind} = '{label}')::DOUBLE / nullif(count(*), 0), 6), 0.0) FROM bucketed"
            )
    return "\nUNION ALL ".join(rows)


VECTOR_PAIRS = """
vector AS (SELECT vec_id AS mid, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pair AS (
  SELECT a.mid, b.mid AS mid2, round(list_cosine_similarity(a.v, b.v), 10) AS score
  FROM vector a JOIN vector b ON a.mid <> b.mid)"""


def _similar(pairs: str) -> str:
    """Best 30 of each movie above 0.1 from a relation (mid, mid2, score)."""
    return f"""
SELECT '{AS_OF}' AS date, n.mid, n.rank, n.mid2, movie_name, 0.0::DOUBLE AS hot_degree, img_urls,
       rating_num, replace(categories, ' ', '|') AS categories, round(n.score, 4) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY score DESC, mid2) AS rank
      FROM {pairs} WHERE score > 0.1) n
JOIN movie ON movie.mid = n.mid2 WHERE n.rank <= 30"""


def _mul(x: str, factor: int) -> str:
    return f"(({x}) * {factor}::HUGEINT) % 4294967296"


def _rotl(x: str, bits: int) -> str:
    return f"(({x}) * {1 << bits}::HUGEINT) % 4294967296 + ({x}) // {1 << (32 - bits)}::HUGEINT"


# Term hash of ASCII tokens: 32-bit Murmur3 with seed 42, step by step.
HASHED = f"""
token AS (
  SELECT mid, unnest(string_split(lower(replace(directors, '|', ' ') || ' ' || replace(main_actors, '|', ' ')
         || ' ' || replace(categories, '|', ' ') || ' ' || replace(language, '|', ' ') || ' '
         || replace(location, '|', ' ')), ' ')) AS word
  FROM movie),
word AS (SELECT DISTINCT word, length(word) AS len FROM token),
code AS (
  SELECT word, len, list_transform(range(1, len + 1), lambda i: ascii(substr(word, CAST(i AS BIGINT), 1))::HUGEINT) AS b
  FROM word),
chunk AS (
  SELECT word, len, list_transform(range(0, len // 4),
           lambda i: b[4*i+1] + b[4*i+2] * 256 + b[4*i+3] * 65536 + b[4*i+4] * 16777216) AS ks,
         coalesce(b[4*(len//4)+1], 0) * CAST(len % 4 >= 1 AS INTEGER)
         + coalesce(b[4*(len//4)+2], 0) * CAST(len % 4 >= 2 AS INTEGER) * 256
         + coalesce(b[4*(len//4)+3], 0) * CAST(len % 4 >= 3 AS INTEGER) * 65536 AS rest
  FROM code),
m1 AS (SELECT word, len, list_transform(ks, lambda k: {_mul('k', 0xcc9e2d51)}) AS ks, {_mul('rest', 0xcc9e2d51)} AS rest FROM chunk),
m2 AS (SELECT word, len, list_transform(ks, lambda k: {_rotl('k', 15)}) AS ks, {_rotl('rest', 15)} AS rest FROM m1),
m3 AS (SELECT word, len, list_transform(ks, lambda k: {_mul('k', 0x1b873593)}) AS ks, {_mul('rest', 0x1b873593)} AS rest FROM m2),
h0 AS (
  SELECT word, len, rest, list_reduce(list_prepend(42::HUGEINT, ks),
         lambda h, k: (({_rotl('xor(h, k)', 13)}) * 5 + {0xe6546b64}::HUGEINT) % 4294967296) AS h
  FROM m3),
h1 AS (SELECT word, xor(xor(h, rest), len::HUGEINT) AS h FROM h0),
h2 AS (SELECT word, {_mul('xor(h, h // 65536)', 0x85ebca6b)} AS h FROM h1),
h3 AS (SELECT word, {_mul('xor(h, h // 8192)', 0xc2b2ae35)} AS h FROM h2),
h4 AS (SELECT word, xor(h, h // 65536) AS h FROM h3),
slot AS (
  SELECT word, CAST((((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 500) + 500) % 500 AS BIGINT) AS idx
  FROM h4),
tf AS (SELECT mid, idx, count(*) AS tf FROM token JOIN slot USING (word) GROUP BY 1, 2),
df AS (SELECT idx, ln(((SELECT count(*) FROM movie) + 1)::DOUBLE / (count(*) + 1)) AS idf FROM tf GROUP BY 1),
feature AS (SELECT mid, idx, tf * idf AS weight FROM tf JOIN df USING (idx) WHERE tf * idf <> 0)"""

CONTENT_PAIRS = """
norm AS (SELECT mid, sqrt(sum(weight * weight)) AS norm FROM feature GROUP BY 1),
unit AS (SELECT mid, idx, weight / norm AS w FROM feature JOIN norm USING (mid)),
pair AS (
  SELECT a.mid, b.mid AS mid2, round(sum(a.w * b.w), 10) AS score
  FROM unit a JOIN unit b ON a.idx = b.idx AND a.mid <> b.mid GROUP BY 1, 2)"""

RECOMMEND = f"""
WITH {MOVIE}, {RATING}, {VECTOR_PAIRS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY date DESC, l_orderkey DESC, l_linenumber DESC,
                               mid DESC, l_suppkey DESC) AS place
  FROM rating),
request AS (SELECT uid, mid FROM placed WHERE place = 1),
recent AS (SELECT uid, mid AS seen, rating FROM placed WHERE place BETWEEN 2 AND 11),
near AS (
  SELECT q.uid, q.mid, p.mid2 AS candidate,
         row_number() OVER (PARTITION BY q.uid, q.mid ORDER BY p.score DESC, p.mid2) AS n
  FROM request q JOIN pair p ON p.mid = q.mid
  WHERE NOT EXISTS (SELECT 1 FROM rating r WHERE r.uid = q.uid AND r.mid = p.mid2)),
compared AS (
  SELECT n.uid, n.mid, n.candidate, r.rating, coalesce(p.score, 0.0) AS s
  FROM near n JOIN recent r ON r.uid = n.uid
  LEFT JOIN pair p ON p.mid = n.candidate AND p.mid2 = r.seen
  WHERE n.n <= 30),
leveled AS (
  SELECT uid, mid, candidate,
         round(avg(s * rating) + log10(greatest(count(*) FILTER (WHERE rating > 60), 1))
               - log10(greatest(count(*) FILTER (WHERE rating <= 60), 1)), 10) AS level
  FROM compared WHERE s >= 0 GROUP BY 1, 2, 3)
SELECT '{AS_OF}' AS date, uid, l.mid AS rated_mid, 1::BIGINT AS copy,
       row_number() OVER (PARTITION BY uid, l.mid ORDER BY level DESC, candidate) AS rank,
       candidate AS mid, movie_name, 0.0::DOUBLE AS hot_degree, img_urls, rating_num, categories,
       round(level, 4) AS score
FROM leveled l JOIN movie ON movie.mid = candidate AND off_shelf = 0"""

HOUR_COUNT = """
SELECT strftime(epoch_ms(hour * 3600000), '%Y-%m-%d-%H') AS "startTime",
       strftime(epoch_ms((hour + 1) * 3600000), '%Y-%m-%d-%H') AS "endTime", count"""

UV_EXACT = f"""
WITH {LOG},
visit AS (SELECT DISTINCT timestamp // 3600000 AS hour, uid, ip FROM log),
total AS (SELECT hour, count(*) AS count FROM visit GROUP BY 1)
{HOUR_COUNT} FROM total"""

UV_BITMAP = f"""
WITH {LOG},
visit AS (SELECT DISTINCT timestamp // 3600000 AS hour, uid || ip AS who FROM log),
bit AS (
  SELECT hour, list_reduce(list_prepend(0::BIGINT, list_transform(string_split(who, ''), lambda c: ascii(c)::BIGINT)),
                           lambda a, c: (a * 61 + c) & 8388607) AS pos
  FROM visit),
total AS (SELECT hour, count(DISTINCT pos) AS count FROM bit GROUP BY 1)
{HOUR_COUNT} FROM total"""

HOT_WINDOW = f"""
WITH {LOG},
covered AS (
  SELECT DISTINCT uid, mid, (timestamp // 300000 - i) * 300000 AS start
  FROM log, (SELECT unnest(range(12)) AS i) WHERE event = 'play' AND mid IS NOT NULL),
total AS (SELECT start, mid, count(*) AS count FROM covered GROUP BY 1, 2)
SELECT CAST(start AS BIGINT) AS "windowStart", CAST(start + 3600000 AS BIGINT) AS "windowEnd", mid, count, rank
FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY count DESC, mid) AS rank FROM total)
WHERE rank <= 10"""

WARN = """
login AS (
  SELECT user_id AS uid, event_type = 'error' AS failed, epoch_us(ts) // 1000 AS timestamp, event_id FROM events),
following AS (
  SELECT *, lead(failed) OVER w AS next_failed, lead(timestamp) OVER w AS next_time
  FROM login WINDOW w AS (PARTITION BY uid ORDER BY timestamp, event_id)),
warning AS (
  SELECT uid, CAST(timestamp AS VARCHAR) AS time,
         'repeated login failures within a short time, possible malicious login' AS message,
         timestamp + 1800000 AS no_login_time
  FROM following WHERE failed AND next_failed AND next_time - timestamp < 21600000)"""


# Streams report what lies behind their watermark.
UV_CLOSED = f"""
{UV_EXACT} WHERE (hour + 1) * 3600000 <= (SELECT max(timestamp) FROM log) - 120000"""

HOT_CLOSED = f"""
{HOT_WINDOW} AND start + 3600000 <= (SELECT max(timestamp) FROM log WHERE event = 'play') - 30000"""


MIXED = """
line AS (
  SELECT *, event_id % 7 = 0 AS short, event_id % 7 <> 0 AND event_id % 11 = 0 AS broken
  FROM (SELECT user_id AS uid, '10.0.0.' || (user_id % 256) AS ip, k AS mid,
          CASE event_type WHEN 'purchase' THEN 'play' ELSE event_type END AS event,
          epoch_us(ts) // 1000 AS timestamp, event_id FROM event))"""

def arrived(late_ms: int) -> str:
    """Rows arrive in four stretches of time, every 97th in the last; late ones come after their hour has closed."""
    return EVENT + f""",
part AS (
  SELECT user_id AS uid, '10.0.0.' || (user_id % 256) AS ip, k AS mid,
         CASE event_type WHEN 'purchase' THEN 'play' ELSE event_type END AS event,
         epoch_us(ts) // 1000 AS timestamp, event_id FROM event),
numbered AS (
  SELECT *, CASE WHEN event_id % 97 = 0 THEN 3 ELSE CAST(floor((timestamp - lo) * 4 / (hi - lo + 1)) AS INTEGER) END AS arrival
  FROM part, (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM part)),
newest AS (SELECT arrival, max(timestamp) AS t FROM numbered GROUP BY 1),
judged AS (
  SELECT n.*, coalesce((timestamp // 3600000 + 1) * 3600000 <= (SELECT max(t) FROM newest w WHERE w.arrival < n.arrival) - {late_ms}, false) AS late
  FROM numbered n)"""


ARRIVED = arrived(120_000)
ON_TIME = f"""
visit AS (SELECT DISTINCT timestamp // 3600000 AS hour, uid, ip FROM judged WHERE NOT late),
total AS (SELECT hour, count(*) AS count FROM visit GROUP BY 1)
{HOUR_COUNT} FROM total"""


def oracle_sql() -> dict[str, str]:
    return {
        "movie_activity_counts": f"""
WITH {HOT}
SELECT mid, movie_name, categories, release_date, location, rating_count, comment_count,
       collection_count, play_count FROM activity""",
        "hot_degree": f"""
WITH {HOT}
SELECT mid, movie_name, categories, round(hot_degree, 6) AS hot_degree, location FROM hot""",
        "top_movies_by_category": f"""
WITH {HOT},
tagged AS (SELECT *, unnest(string_split(categories, '|')) AS category FROM hot)
SELECT '{AS_OF}' AS date, category, rank, {ENTRY}
FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY hot_degree DESC, mid) AS rank FROM tagged)
WHERE rank <= 10""",
        "top_movies": f"""
WITH {HOT}, kept AS (SELECT * FROM hot WHERE NOT contains(categories, 'widget'))
{_top("kept", "hot_degree DESC, mid")}""",
        "top_comics": f"""
WITH {HOT}, kept AS (SELECT * FROM hot WHERE contains(categories, 'widget'))
{_top("kept", "hot_degree DESC, mid")}""",
        "hot_ranking": f"""
WITH {HOT} {_top("hot", "hot_degree DESC, mid", "'hot_ranking' AS category,")}""",
        "region_ranking_na": f"""
WITH {HOT}, kept AS (SELECT * FROM hot WHERE contains(location, 'Brand#1') OR contains(location, 'Brand#24'))
{_top("kept", "hot_degree DESC, mid", "'north_america' AS category,")}""",
        "region_ranking_mainland": f"""
WITH {HOT}, kept AS (SELECT * FROM hot WHERE contains(location, 'Brand#3'))
{_top("kept", "hot_degree DESC, mid", "'mainland_ranking' AS category,")}""",
        "good_ranking": f"""
WITH {MOVIE}, rated AS (SELECT *, 0.0::DOUBLE AS hot_degree FROM movie)
{_top("rated", "rating_num DESC, release_date DESC, mid", "'good_ranking' AS category,")}""",
        "top_movies_of_month": _period("strftime(l_shipdate, '%Y-%m') = '2001-07'"),
        "top_movies_of_week": _period(
            "l_shipdate >= TIMESTAMP '2001-07-30' AND l_shipdate < TIMESTAMP '2001-08-06'"
        ),
        "similarity_matrix": f"""
WITH {VECTOR_PAIRS} SELECT mid, mid2, round(score, 4) AS score FROM pair WHERE score <> 0""",
        "similar_movies": f"WITH {MOVIE}, {VECTOR_PAIRS} {_similar('pair')}",
        "similar_movies_from_vectors": f"WITH {MOVIE}, {VECTOR_PAIRS} {_similar('pair')}",
        "content_features": f"""
WITH {MOVIE}, {HASHED} SELECT mid, idx, round(weight, 6) AS weight FROM feature""",
        "updated_features": f"""
WITH {MOVIE}, {HASHED} SELECT mid, idx, round(weight, 6) AS weight FROM feature""",
        "content_similarity": f"WITH {MOVIE}, {HASHED}, {CONTENT_PAIRS} {_similar('pair')}",
        "realtime_recommend": RECOMMEND,
        "session_aggregate": f"WITH {SESSION} SELECT {SESSION_COLUMNS} FROM session",
        "session_filter": f"""
WITH {SESSION} SELECT {SESSION_COLUMNS} FROM session
WHERE age BETWEEN 25 AND 50 AND sex = 1
  AND CAST(replace(city, 'NATION_', '') AS INTEGER) < 15
  AND professional IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY', 'HOUSEHOLD')
  AND list_has_any(categories, [1, 3, 5, 7, 9])""",
        "session_length_stats": f"""
WITH {SESSION},
bucketed AS (
  SELECT {_bucket_case("visitLength // 1000", VISIT)} AS visit,
         {_bucket_case("stepLength", STEPS)} AS step FROM session),
stat AS ({_stat_rows()})
SELECT '{AS_OF}' AS date, key, value FROM stat""",
        "top10_categories": f"""
WITH {ACTION}, {TOP_CATEGORY}
SELECT '{AS_OF}' AS date, categoryId, clickCount, collectCount, ratingCount, commentCount, rank
FROM top_category""",
        "top_sessions_of_category": f"""
WITH {ACTION}, {TOP_SESSION}
SELECT '{AS_OF}' AS date, categoryId, userId, sessionId, count, rank FROM top_session""",
        "top_session_details": f"""
WITH {ACTION}, {TOP_SESSION}
SELECT '{AS_OF}' AS date, userId, sessionId, pageId, date AS actionTime, searchKeyword, clickCategoryId,
       collectCategoryId, ratingCategoryId, commentCategoryId, clickMovieId, collectMovieId,
       ratingMovieId, commentMovieId, cityId
FROM action WHERE sessionId IN (SELECT sessionId FROM top_session)""",
        "page_transitions": f"""
WITH {STEP}
SELECT key, count FROM (UNPIVOT totals ON COLUMNS(*) INTO NAME key VALUE count)""",
        "page_convert_rate": f"""
WITH {STEP}
SELECT '{AS_OF}' AS date, {_rate("index", "detail", "indexToDetail")},
       {_rate("detail", "rating", "detailToRating")}, {_rate("detail", "comment", "detailToComment")},
       {_rate("detail", "collect", "detailToCollect")}, {_rate("detail", "play", "detailToPlay")}
FROM totals""",
        "top_movies_of_area": f"""
WITH {ACTION},
seen AS (
  SELECT DISTINCT userId, cityId,
         CASE WHEN clickMovieId > 0 THEN clickMovieId WHEN collectMovieId > 0 THEN collectMovieId
              WHEN ratingMovieId > 0 THEN ratingMovieId WHEN commentMovieId > 0 THEN commentMovieId END AS movieId
  FROM action),
total AS (SELECT cityId, movieId, count(*) AS count FROM seen WHERE movieId IS NOT NULL GROUP BY 1, 2),
best AS (
  SELECT *, row_number() OVER (PARTITION BY cityId ORDER BY count DESC, movieId) AS rank FROM total)
SELECT '{AS_OF}' AS date, cityId, n_name AS "cityName", movieId, p_name AS "movieName", count, rank
FROM best JOIN nation ON cityId = n_nationkey JOIN part ON movieId = p_partkey WHERE rank <= 10""",
        "parsed_log_events": f"WITH {LOG} SELECT uid, ip, mid, event, timestamp FROM log",
        "mixed_log_events": f"""
WITH {EVENT}, {MIXED} SELECT uid, ip, mid, event, timestamp FROM line WHERE NOT short AND NOT broken""",
        "rejected_log_lines": f"""
WITH {EVENT}, {MIXED} SELECT concat_ws('|', uid, ip, mid, event, CASE WHEN broken THEN 'soon' END) AS value
FROM line WHERE short OR broken""",
        "actions_in_range": f"""
WITH {ACTION} SELECT event_id, date * 1000 AS date, userId, sessionId, pageId FROM action
WHERE date * 1000 BETWEEN epoch_ms(TIMESTAMP '2024-01-05') AND epoch_ms(TIMESTAMP '2024-01-12')""",
        "uv_approx": f"""
WITH {LOG}, total AS (SELECT DISTINCT timestamp // 3600000 AS hour FROM log)
SELECT "startTime", "endTime", true AS close FROM (SELECT * FROM ({HOUR_COUNT.replace(', count', '')} FROM total))""",
        "uv_on_time_stream": f"WITH {ARRIVED}, {ON_TIME}",
        "uv_running_stream": f"WITH {ARRIVED}, {ON_TIME}",
        "uv_corrected_stream": f"""
WITH {arrived(60_000 + 10 * 86_400_000)}, {ON_TIME}
WHERE (hour + 1) * 3600000 <= (SELECT max(timestamp) FROM judged) - 60000""",
        "uv_late_stream": f"WITH {ARRIVED} SELECT uid, ip, mid, event, timestamp FROM judged WHERE late",
        "uv_exact": UV_EXACT,
        "uv_bitmap": UV_BITMAP,
        "late_rows": f"""
WITH {LOG} SELECT uid, ip, mid, event, timestamp FROM log
WHERE (timestamp // 3600000 + 1) * 3600000 <= (SELECT max(timestamp) FROM log) - 120000""",
        "hot_movies_window": HOT_WINDOW,
        "uv_stream": UV_CLOSED,
        "uv_stream_bitmap": UV_BITMAP,
        "hot_movies_stream": HOT_CLOSED,
        "login_fail_stream": f"WITH {WARN} SELECT * FROM warning",
        "recommend_stream": RECOMMEND,
        "login_fail_detect": f"WITH {WARN} SELECT * FROM warning",
        "lock_table_stream": f"""
WITH {WARN} SELECT uid, max(no_login_time) AS no_login_time FROM warning GROUP BY 1""",
        "current_locks": f"""
WITH {WARN} SELECT uid, max(no_login_time) AS no_login_time FROM warning GROUP BY 1""",
    }
