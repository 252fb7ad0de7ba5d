"""DuckDB SQL that gives the same result as each deterministic query of the catalog."""

RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS BIGINT) AS userId, CAST(l_partkey AS BIGINT) AS productId,
         CAST(1 + CAST(l_quantity AS INT) % 5 AS DOUBLE) AS score,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS "timestamp",
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS yearmonth
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS BIGINT) AS productId, p_name AS name, '' AS imageUrl,
         p_type AS categories,
         concat_ws('|', replace(p_name, ' ', '|'), p_type, p_brand) AS tags
  FROM part)"""

EVENTS = """rating_events AS (
  SELECT CAST(user_id AS BIGINT) AS userId,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS productId,
         CAST(1 + event_id % 5 AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp", ts, event_id, event_type
  FROM events)"""

REQUESTS = """requests AS (
  SELECT DISTINCT productId FROM rating_events WHERE event_type = 'purchase')"""

AVERAGES = """averages AS (
  SELECT productId, avg(score) AS avg FROM ratings GROUP BY productId)"""

INFO = """info AS (
  SELECT p.productId, name, categories, tags, round(coalesce(avg, 0.0), 6) AS score
  FROM products p LEFT JOIN averages a ON p.productId = a.productId)"""

MONTHLY = """monthly AS (
  SELECT productId, yearmonth, count(*) AS month_count FROM ratings GROUP BY ALL)"""

# Windows of two days, one every twelve hours.
WINDOWED = """windowed AS (
  SELECT start AS window_start, start + 4 * 43200 AS window_end, productId, count(*) AS count, sum(score) AS score_sum
  FROM (SELECT productId, score, unnest([("timestamp" // 43200 - k) * 43200 for k in range(4)]) AS start
        FROM rating_events)
  GROUP BY ALL)"""

ITEMCF = """item_counts AS (SELECT productId, count(*) AS c FROM ratings GROUP BY productId),
co AS (
  SELECT a.productId AS product1, b.productId AS product2, count(*) AS co
  FROM ratings a JOIN ratings b ON a.userId = b.userId AND a.productId <> b.productId
  GROUP BY ALL),
itemcf AS (
  SELECT product1, product2, co, x.c AS count1, y.c AS count2,
         co / sqrt(CAST(x.c * y.c AS DOUBLE)) AS score
  FROM co JOIN item_counts x ON product1 = x.productId
          JOIN item_counts y ON product2 = y.productId),
itemcf_top AS (
  SELECT product1 AS productId, CAST(rank AS INT) AS rank, product2 AS recId, score
  FROM (SELECT *, row_number() OVER (PARTITION BY product1 ORDER BY score DESC, product2) AS rank
        FROM itemcf) WHERE rank <= 10)"""

WEIGHTS = """tokens AS (
  SELECT productId, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term
  FROM products),
tf AS (SELECT productId, term, count(*) AS tf FROM tokens GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (
  SELECT productId, tf.term,
         tf * ln(((SELECT count(*) FROM products) + 1.0) / (df + 1.0)) AS weight
  FROM tf JOIN df ON tf.term = df.term),
norms AS (
  SELECT productId, sqrt(sum(weight * weight)) AS norm FROM weights
  GROUP BY productId HAVING sum(weight * weight) > 0),
profiles AS (
  SELECT productId, min(productId) OVER (PARTITION BY bag) AS profileId
  FROM (SELECT productId, string_agg(term, ' ' ORDER BY term) AS bag
        FROM tokens GROUP BY productId))"""

CONTENT = (
    WEIGHTS
    + """,
dots AS (
  SELECT a.productId AS product1, b.productId AS product2, sum(a.weight * b.weight) AS dot
  FROM weights a JOIN weights b ON a.term = b.term AND a.productId <> b.productId
  GROUP BY ALL),
content_sim AS (
  SELECT product1, product2, dot / (x.norm * y.norm) AS score
  FROM dots JOIN norms x ON product1 = x.productId JOIN norms y ON product2 = y.productId
  WHERE dot / (x.norm * y.norm) > 0.4),
content_ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY product1 ORDER BY round(score, 9) DESC, product2) AS rank
  FROM content_sim)"""
)

_MASK = 4294967295


def _mixed(k: str) -> str:
    scaled = f"(({k}::HUGEINT * 3432918353) & {_MASK})::UBIGINT"
    turned = f"((({scaled} << 15) & {_MASK}) | ({scaled} >> 17))"
    return f"(({turned}::HUGEINT * 461845907) & {_MASK})::UBIGINT"


def _little(text: str, n_bytes: int) -> str:
    turned = " || ".join(f"substr({text}, {2 * i + 1}, 2)" for i in reversed(range(n_bytes)))
    return f"('0x0' || {turned})::UBIGINT"


# MurmurHash3 of every word, seed 42, and its bucket of 800.
HASHED = f"""words AS (
  SELECT term, hex(encode(term)) AS code FROM (
    SELECT DISTINCT unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term FROM products)),
blocks AS (
  SELECT term, code, list_reduce(
    list_prepend(42::UBIGINT, [{_mixed(_little("substr(code, 8 * i + 1, 8)", 4))} FOR i IN range(length(code) // 8)]),
    lambda h, k: ((((xor(h, k) << 13) & {_MASK}) | (xor(h, k) >> 19)) * 5 + 3864292196) & {_MASK}) AS h
  FROM words),
ended AS (
  SELECT term, xor(xor(h, {_mixed(_little("substr(code, 8 * (length(code) // 8) + 1)", 3))}),
                   (length(code) // 2)::UBIGINT) AS h FROM blocks),
once AS (SELECT term, ((xor(h, h >> 16)::HUGEINT * 2246822507) & {_MASK})::UBIGINT AS h FROM ended),
twice AS (SELECT term, ((xor(h, h >> 13)::HUGEINT * 3266489909) & {_MASK})::UBIGINT AS h FROM once),
buckets AS (
  SELECT term, CAST(CASE WHEN xor(h, h >> 16) > 2147483647
                         THEN ((xor(h, h >> 16)::BIGINT - 4294967296) % 800 + 800) % 800
                         ELSE xor(h, h >> 16) % 800 END AS INT) AS bucket FROM twice)"""

# The same weights and pairs with buckets as terms.
HASHED_CONTENT = CONTENT.replace(
    "SELECT productId, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term\n  FROM products",
    """SELECT productId, bucket AS term
  FROM (SELECT productId, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term FROM products) t
  JOIN buckets b ON t.term = b.term""",
)

BASE = """base AS (
  SELECT userId, productId, arg_max(score, struct_pack(t := "timestamp", s := score)) AS score,
         min("timestamp") AS "timestamp"
  FROM ratings GROUP BY userId, productId)"""

QUEUE = """queue AS (
  SELECT * FROM (
    SELECT userId, productId, score, CAST(row_number() OVER (
             PARTITION BY userId ORDER BY ts DESC, event_id DESC) AS INT) AS rank
    FROM rating_events) WHERE rank <= 40)"""

_ASKED = "ts >= TIMESTAMP '2024-01-16'"

RATE_REQUESTS = f"""rate_requests AS (
  SELECT userId, productId, round(CAST(event_id % 41 AS DOUBLE) / 4 / 2, 2) AS score,
         "timestamp", ts, event_id
  FROM rating_events WHERE {_ASKED}),
queued AS (
  SELECT userId, productId, score, ts, event_id FROM rating_events WHERE NOT {_ASKED}
  UNION ALL SELECT userId, productId, score, ts, event_id FROM rate_requests)"""


def _upsert(updates: str) -> str:
    return f"""updates AS (
  SELECT userId, productId, arg_max(score, struct_pack(t := ts, e := event_id)) AS score,
         min("timestamp") AS "timestamp"
  FROM {updates} GROUP BY userId, productId)
SELECT coalesce(b.userId, u.userId) AS userId, coalesce(b.productId, u.productId) AS productId,
       coalesce(u.score, b.score) AS score, coalesce(b."timestamp", u."timestamp") AS "timestamp"
FROM base b FULL OUTER JOIN updates u ON b.userId = u.userId AND b.productId = u.productId"""


ONLINE = """last_event AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, event_id DESC) AS place
    FROM rating_events) WHERE place = 1),
rated AS (
  SELECT DISTINCT userId, productId FROM (
    SELECT userId, productId FROM ratings UNION ALL SELECT userId, productId FROM rating_events)),
candidates AS (
  SELECT * FROM (
    SELECT t.userId, s.product2 AS candidate, s.score, CAST(row_number() OVER (
             PARTITION BY t.userId ORDER BY round(s.score, 9) DESC, s.product2) AS INT) AS rank
    FROM last_event t JOIN content_sim s ON s.product1 = t.productId
    WHERE NOT EXISTS (SELECT 1 FROM rated r
                      WHERE r.userId = t.userId AND r.productId = s.product2))
  WHERE rank <= 20),
scores AS (
  SELECT c.userId, c.candidate AS productId,
         avg(s.score * q.score)
         + log2(greatest(count(*) FILTER (WHERE q.score > 3), 1))
         - log2(greatest(count(*) FILTER (WHERE q.score <= 3), 1)) AS score
  FROM candidates c JOIN queue q ON c.userId = q.userId AND q.rank <= 21
  JOIN content_sim s ON s.product1 = c.candidate AND s.product2 = q.productId
  WHERE s.score > 0.6
  GROUP BY c.userId, c.candidate),
online_lists AS (
  SELECT userId, productId, score, CAST(row_number() OVER (
    PARTITION BY userId ORDER BY round(score, 9) DESC, productId) AS INT) AS rank
  FROM scores)"""

# The live path on vectors of embeddings, both steps above the first threshold.
FACTORS = (
    """vectors AS (
  SELECT CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
content_sim AS (
  SELECT a.id AS product1, b.id AS product2, list_cosine_similarity(a.v, b.v) AS score
  FROM vectors a JOIN vectors b ON a.id <> b.id
  WHERE list_cosine_similarity(a.v, b.v) > 0.4),
"""
    + ONLINE.replace("s.score > 0.6", "s.score > 0.4")
    .replace("s.product1 = t.productId", "s.product1 = t.productId % (SELECT max(id) + 1 FROM vectors)")
    .replace("s.product2 = q.productId", "s.product2 = q.productId % (SELECT max(id) + 1 FROM vectors)")
)

USER_ITEM = """halves AS (
  SELECT vec_id % 2 AS odd, CAST(vec_id // 2 AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings),
users AS (SELECT id, v FROM halves WHERE odd = 0),
items AS (SELECT id, v FROM halves WHERE odd = 1),
moved AS (
  SELECT CAST(userId % (SELECT max(vec_id) // 2 + 1 FROM embeddings) AS BIGINT) AS userId,
         CAST(productId % (SELECT max(vec_id) // 2 + 1 FROM embeddings) AS BIGINT) AS productId, score
  FROM base),
predicted AS (
  SELECT userId, productId, score, u.v AS u, i.v AS i, list_inner_product(u.v, i.v) AS prediction
  FROM moved JOIN users u ON u.id = userId JOIN items i ON i.id = productId),
factor_lists AS (
  SELECT u.id AS userId, i.id AS productId, list_inner_product(u.v, i.v) AS score,
         CAST(row_number() OVER (
           PARTITION BY u.id ORDER BY round(list_inner_product(u.v, i.v), 9) DESC, i.id) AS INT) AS rank
  FROM users u CROSS JOIN items i WHERE list_inner_product(u.v, i.v) > 0)"""

TWO_BATCHES = """means AS (
  SELECT userId, productId, ts >= TIMESTAMP '2024-01-30' AS late, avg(score) AS score
  FROM rating_events GROUP BY ALL),
lists AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (
      PARTITION BY userId, late ORDER BY round(score, 9) DESC, productId) AS INT) AS rank
    FROM means))"""

_SERVED = "productId, name, categories, tags, score"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_LOG_EVENTS = """SELECT event_id, userId, productId, score, "timestamp" FROM rating_events
WHERE event_type NOT IN ('error', 'signup')"""


def _top_windows(counts: str) -> str:
    return f"""SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY count DESC, productId) AS INT) AS rank
  FROM {counts}) WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    online = _with(RATINGS, PRODUCTS, EVENTS, CONTENT, QUEUE, ONLINE)
    served = _with(RATINGS, PRODUCTS, EVENTS, REQUESTS, AVERAGES, INFO)
    content_lookup = (
        _with(RATINGS, PRODUCTS, EVENTS, REQUESTS, AVERAGES, INFO, CONTENT)
        + """SELECT product1 AS requested, CAST(rank AS INT) AS rank, product2 AS productId,
       round(s.score, 6) AS rec_score, name, i.score
FROM content_ranked s JOIN requests r ON product1 = r.productId
JOIN info i ON i.productId = product2"""
    )
    # Log lines carry seconds only; of two events in one second the larger product is later.
    in_lines = EVENTS.replace("FROM events", "FROM events WHERE event_type NOT IN ('error', 'signup')")
    by_line = "ORDER BY \"timestamp\" DESC, productId DESC, score DESC"
    job = _with(RATINGS, PRODUCTS, in_lines, CONTENT, QUEUE, ONLINE).replace(
        "ORDER BY ts DESC, event_id DESC", by_line
    )
    queue_rows = "SELECT userId, rank, productId, score FROM queue"
    return {
        "rate_more_products": _with(RATINGS)
        + 'SELECT productId, count(*) AS "count" FROM ratings GROUP BY productId',
        "rate_more_recently": _with(RATINGS, MONTHLY)
        + 'SELECT productId, yearmonth, month_count AS "count" FROM monthly',
        "average_products": _with(RATINGS)
        + 'SELECT productId, round(avg(score), 6) AS "avg" FROM ratings GROUP BY productId',
        "statistics_all_in_one_scan": _with(RATINGS, MONTHLY)
        + """, totals AS (
  SELECT productId, count(*) AS total_count, round(avg(score), 6) AS "avg"
  FROM ratings GROUP BY productId)
SELECT m.productId, yearmonth, month_count, total_count, "avg"
FROM monthly m JOIN totals t ON m.productId = t.productId""",
        "statistics_sql_views": _with(RATINGS, MONTHLY)
        + """, totals AS (
  SELECT productId, count(*) AS total_count FROM ratings GROUP BY productId)
SELECT m.productId, yearmonth, month_count, total_count
FROM monthly m JOIN totals t ON m.productId = t.productId""",
        "statistics_incremental": _with(RATINGS, EVENTS)
        + """, every AS (
  SELECT productId, yearmonth, score FROM ratings
  UNION ALL SELECT productId, CAST(year(ts) * 100 + month(ts) AS INT), score FROM rating_events),
totals AS (
  SELECT productId, count(productId) AS total_count, round(avg(score), 6) AS "avg" FROM every GROUP BY productId)
SELECT productId, yearmonth, count(productId) AS month_count, total_count, "avg"
FROM every JOIN totals USING (productId) GROUP BY ALL""",
        "trending_windowed": _with(EVENTS, WINDOWED) + _top_windows("windowed"),
        "stream_trending": _with(EVENTS, WINDOWED)
        + _top_windows(
            """(SELECT * FROM windowed
  WHERE window_end <= (SELECT max("timestamp") - 6 * 3600 FROM rating_events))"""
        ),
        "distinct_ids": _with(RATINGS)
        + """SELECT DISTINCT 'user' AS kind, userId AS id FROM ratings
UNION ALL SELECT DISTINCT 'product' AS kind, productId AS id FROM ratings""",
        "delimited_group_count": """SELECT c_mktsegment, c_nationkey, count(*) AS "count"
FROM customer GROUP BY c_mktsegment, c_nationkey""",
        "hot_products": _with(RATINGS, PRODUCTS, AVERAGES, INFO, MONTHLY)
        + f"""SELECT yearmonth, month_count AS "count", i.{_SERVED}
FROM (SELECT * FROM monthly ORDER BY yearmonth DESC, month_count DESC, productId LIMIT 20) m
JOIN info i ON m.productId = i.productId""",
        "most_rated_products": _with(RATINGS, PRODUCTS, AVERAGES, INFO)
        + f"""SELECT "count", i.{_SERVED}
FROM (SELECT productId, count(*) AS "count" FROM ratings GROUP BY productId
      ORDER BY 2 DESC, 1 LIMIT 20) m
JOIN info i ON m.productId = i.productId""",
        "product_info": served
        + f"SELECT {_SERVED} FROM info WHERE productId IN (SELECT productId FROM requests)",
        "search_products": served
        + f"SELECT {_SERVED} FROM info WHERE regexp_matches(name, 'red|ring$')",
        "search_products_raw": served
        + f"SELECT {_SERVED} FROM info WHERE regexp_matches(name, 'red|ring$|é')",
        "search_triples": _with(PRODUCTS)
        + """SELECT triple, count(DISTINCT productId) AS "count"
FROM (SELECT productId, unnest([substr(name, i, 3) FOR i IN range(1, length(name) - 1)]) AS triple
      FROM products)
GROUP BY triple""",
        "search_products_indexed": served
        + f"""SELECT pattern, {_SERVED}
FROM info JOIN (SELECT unnest(['red|ring$', 'spring.*(blush|green)', 'ora?nge?', 'l[aeiou]ce',
                               '^.[aeiou]']) AS pattern)
ON regexp_matches(name, pattern)""",
        "itemcf_pairs": _with(RATINGS, ITEMCF)
        + """SELECT product1, product2, co, count1, count2, round(score, 6) AS score
FROM itemcf WHERE product1 < product2""",
        "itemcf_top10": _with(RATINGS, ITEMCF)
        + "SELECT productId, rank, recId, round(score, 6) AS score FROM itemcf_top",
        "itemcf_recs": _with(RATINGS, ITEMCF)
        + """SELECT c.productId, CAST(count(recId) AS INT) AS n_recs,
       coalesce(string_agg(CAST(recId AS VARCHAR), ',' ORDER BY rank), '') AS ids
FROM item_counts c LEFT JOIN itemcf_top t ON c.productId = t.productId GROUP BY c.productId""",
        "itemcf_lookup": _with(RATINGS, PRODUCTS, EVENTS, REQUESTS, AVERAGES, INFO, ITEMCF)
        + """SELECT t.productId AS requested, rank, recId AS productId,
       round(t.score, 6) AS rec_score, name, i.score
FROM itemcf_top t JOIN requests r ON t.productId = r.productId
JOIN info i ON i.productId = recId""",
        "content_tfidf_weights": _with(PRODUCTS, WEIGHTS)
        + "SELECT productId, term, round(weight, 6) AS weight FROM weights WHERE weight > 0",
        "content_profile_similar": _with(PRODUCTS, CONTENT)
        + """SELECT product1 AS profile1, product2 AS profile2, round(score, 6) AS score
FROM content_sim WHERE product1 < product2
AND product1 IN (SELECT profileId FROM profiles) AND product2 IN (SELECT profileId FROM profiles)""",
        "content_similar": _with(PRODUCTS, CONTENT)
        + "SELECT product1, product2, round(score, 6) AS score FROM content_sim",
        "content_hashed_counts": _with(PRODUCTS, HASHED)
        + """SELECT productId, bucket, count(*) AS tf
FROM (SELECT productId, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term FROM products) t
JOIN buckets b ON t.term = b.term GROUP BY ALL""",
        "content_similar_hashed": _with(PRODUCTS, HASHED, HASHED_CONTENT)
        + "SELECT product1, product2, round(score, 6) AS score FROM content_sim",
        "content_similar_top10": _with(PRODUCTS, CONTENT)
        + """SELECT product1 AS productId, CAST(rank AS INT) AS rank, product2 AS recId,
       round(score, 6) AS score FROM content_ranked WHERE rank <= 10""",
        "content_pages": _with(PRODUCTS, CONTENT)
        + """SELECT product1 AS productId, CAST((rank - 1) // 50 AS INT) AS page,
       CAST(count(*) AS INT) AS n_recs,
       string_agg(CAST(product2 AS VARCHAR), ',' ORDER BY rank) AS ids
FROM (SELECT product1, product2, row_number() OVER (
        PARTITION BY product1 ORDER BY round(score, 6) DESC, product2) AS rank FROM content_sim)
GROUP BY product1, (rank - 1) // 50""",
        "content_lookup": content_lookup,
        "content_stored_lookup": content_lookup,
        "dense_similar": """WITH vectors AS (
  SELECT CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT a.id AS product1, b.id AS product2, round(list_cosine_similarity(a.v, b.v), 6) AS score
FROM vectors a JOIN vectors b ON a.id <> b.id
WHERE list_cosine_similarity(a.v, b.v) > 0.4""",
        "rating_upsert": _with(RATINGS, EVENTS, BASE, _upsert("rating_events")),
        "rating_merge": _with(RATINGS, EVENTS, BASE, _upsert("rating_events")),
        "rating_lookup": _with(RATINGS)
        + """SELECT 'userId' AS "by", userId, productId, score, "timestamp" FROM ratings
JOIN customer ON c_custkey = userId WHERE c_nationkey = 7
UNION ALL SELECT 'productId', userId, productId, score, "timestamp" FROM ratings
JOIN part ON p_partkey = productId WHERE p_size = 1""",
        "recent_queue_batch": _with(EVENTS, QUEUE) + queue_rows,
        "recent_queue_items": _with(EVENTS, QUEUE) + queue_rows + " WHERE rank <= 21",
        "score_halving": _with(EVENTS, RATE_REQUESTS) + "SELECT event_id, score FROM rate_requests",
        "rate_products": _with(RATINGS, EVENTS, RATE_REQUESTS, BASE, _upsert("rate_requests")),
        "rate_products_queue": _with(EVENTS, RATE_REQUESTS, QUEUE.replace("rating_events", "queued"))
        + queue_rows,
        "rate_products_log": _with(EVENTS, RATE_REQUESTS)
        + """SELECT 'PRODUCT_RATING_PREFIX:' || concat_ws('|', userId, productId, score, "timestamp")
  AS "value" FROM rate_requests""",
        "user_id_from_name": """SELECT c_name, CAST(CASE WHEN h >= 2147483648
  THEN h - 4294967296 ELSE h END AS INT) AS userId
FROM (SELECT c_name, list_reduce(
        list_prepend(CAST(0 AS BIGINT),
          list_transform(string_split(c_name, ''), lambda x: CAST(ord(x) AS BIGINT))),
        lambda a, b: (a * 31 + b) % 4294967296) AS h FROM customer)""",
        "tag_aggregate": _with(EVENTS)
        + """SELECT productId, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS tags
FROM rating_events GROUP BY productId""",
        "load_products": _with(PRODUCTS) + "SELECT * FROM products",
        "load_ratings": _with(RATINGS)
        + 'SELECT userId, productId, score, "timestamp" FROM ratings',
        "log_emit": _with(EVENTS)
        + """SELECT 'PRODUCT_RATING_PREFIX:' || concat_ws('|', userId, productId, score, "timestamp")
  AS "value" FROM rating_events""",
        "log_filter_batch": _with(EVENTS) + _LOG_EVENTS,
        "stream_log_filter": _with(EVENTS) + _LOG_EVENTS.replace("event_id, ", ""),
        "stream_log_tail": _with(EVENTS) + _LOG_EVENTS.replace("event_id, ", ""),
        "stream_recent_queue": _with(EVENTS, QUEUE) + queue_rows,
        "state_recent_queue": _with(EVENTS, QUEUE) + queue_rows,
        "latest_events": _with(EVENTS)
        + """SELECT userId, productId, score, "timestamp", event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, event_id DESC) AS place
  FROM rating_events) WHERE place = 1""",
        "online_candidates": online
        + "SELECT userId, rank, candidate, round(score, 6) AS score FROM candidates",
        "factor_predictions": _with(RATINGS, BASE, USER_ITEM)
        + "SELECT userId, productId, score, round(prediction, 6) AS prediction FROM predicted",
        "factor_rmse": _with(RATINGS, BASE, USER_ITEM)
        + "SELECT round(sqrt(avg((score - prediction) ** 2)), 6) AS rmse FROM predicted",
        "factor_user_recs": _with(RATINGS, BASE, USER_ITEM)
        + """SELECT userId, rank, productId, round(score, 6) AS score FROM factor_lists
WHERE rank <= 20""",
        "factor_recs_lookup": _with(RATINGS, PRODUCTS, BASE, USER_ITEM)
        + """SELECT userId, rank, l.productId, round(score, 6) AS rec_score, name
FROM factor_lists l JOIN customer ON c_custkey = userId JOIN products p ON p.productId = l.productId
WHERE rank <= 10 AND c_mktsegment = 'BUILDING'""",
        "factor_grid": _with(RATINGS, BASE, USER_ITEM)
        + """, grid AS (
  SELECT CAST(r AS INT) AS rank, CAST(0 AS DOUBLE) AS "lambda",
         sqrt(avg((score - list_inner_product(u[1:r], i[1:r])) ** 2)) AS rmse
  FROM predicted CROSS JOIN (SELECT unnest([5, 10, 20, 50]) AS r) GROUP BY r)
SELECT rank, "lambda", round(rmse, 6) AS rmse,
       rank = (SELECT arg_min(rank, struct_pack(e := rmse, r := rank)) FROM grid) AS best
FROM grid""",
        "online_factor_candidates": _with(RATINGS, EVENTS, QUEUE, FACTORS)
        + "SELECT userId, rank, candidate, round(score, 6) AS score FROM candidates",
        "online_factor_scores": _with(RATINGS, EVENTS, QUEUE, FACTORS)
        + "SELECT userId, productId, round(score, 6) AS score FROM scores",
        "online_scores": online + "SELECT userId, productId, round(score, 6) AS score FROM scores",
        "stream_recs": online
        + "SELECT userId, rank, productId, round(score, 6) AS score FROM online_lists",
        "stream_online_job": job
        + "SELECT userId, rank, productId, round(score, 6) AS score FROM online_lists",
        "stream_recs_lookup": _with(
            RATINGS, PRODUCTS, EVENTS, AVERAGES, INFO, CONTENT, QUEUE, ONLINE
        )
        + """SELECT c_name AS username, userId AS requested, rank, l.productId,
       round(l.score, 6) AS rec_score, name, i.score
FROM online_lists l JOIN customer ON c_custkey = userId JOIN info i ON i.productId = l.productId
WHERE c_mktsegment = 'BUILDING' AND rank <= 5""",
        "replace_stream_recs": _with(EVENTS, TWO_BATCHES)
        + """SELECT userId, rank, productId, round(score, 6) AS score FROM lists
WHERE late OR userId NOT IN (SELECT userId FROM lists WHERE late)""",
        "merge_stream_recs": _with(EVENTS, TWO_BATCHES)
        + """, merged AS (
  SELECT userId, productId, max(score) AS score FROM lists GROUP BY ALL)
SELECT * FROM (
  SELECT userId, productId, round(score, 6) AS score, CAST(row_number() OVER (
    PARTITION BY userId ORDER BY round(score, 9) DESC, productId) AS INT) AS rank
  FROM merged) WHERE rank <= 20""",
        "hybrid_blend": _with(RATINGS, PRODUCTS, EVENTS, ITEMCF, CONTENT, QUEUE, ONLINE)
        + """, sources AS (
  SELECT userId, recId AS productId, t.score, 1 AS source, 0.5 AS weight
  FROM last_event e JOIN itemcf_top t ON e.productId = t.productId
  UNION ALL
  SELECT userId, product2, s.score, 2, 0.2
  FROM last_event e JOIN content_ranked s ON e.productId = product1 
  UNION ALL SELECT userId, productId, score, 3, 0.3 FROM scores),
shares AS (
  SELECT userId, productId, CAST(weight AS DOUBLE) * coalesce(score / nullif(
    max(abs(score)) OVER (PARTITION BY userId, source), 0), 0.0) AS share FROM sources),
blended AS (SELECT userId, productId, sum(share) AS score FROM shares GROUP BY ALL)
SELECT * FROM (
  SELECT userId, productId, round(score, 6) AS score, CAST(row_number() OVER (
    PARTITION BY userId ORDER BY round(score, 9) DESC, productId) AS INT) AS rank
  FROM blended) WHERE rank <= 20""",
        "rmse_of_product_means": _with(RATINGS, AVERAGES)
        + """SELECT round(sqrt(avg((score - "avg") * (score - "avg"))), 6) AS rmse
FROM ratings r JOIN averages a ON r.productId = a.productId""",
    }
