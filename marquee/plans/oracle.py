"""Independent DuckDB SQL for the registered plans (the correctness oracle).

Written from the operator definitions, not from the Spark code: brute force
where the Spark plan prunes (content scores over every user x movie pair,
window sums where Spark aggregates).  The driver pre-registers the tables as
views; ``rat``, ``mov`` and ``ans`` below are the adapter views.
"""

from __future__ import annotations

from marquee.operators.seen import DENSE
from marquee.plans.registry import LIGHT_USER_RATINGS, TARGET_USER, VOCAB

_RAT = """
rat AS (
  SELECT userId, movieId, max_by(rating, (ts, rating)) AS rating, max(ts) AS "timestamp"
  FROM (SELECT o_custkey AS userId, l_partkey AS movieId,
               ceil(l_quantity / 5) / CAST(2 AS DOUBLE) AS rating,
               CAST(epoch(o_orderdate) AS BIGINT) AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x
  GROUP BY userId, movieId)"""

_MOV = """
mov AS (
  SELECT p_partkey AS movieId, p_name AS title,
         CASE WHEN p_size <= 2 THEN '(no genres listed)'
              ELSE concat(lower(p_type), '|', replace(p_name, ' ', '|')) END AS genres
  FROM part)"""

_ANS = """
ans_base AS (
  SELECT -1 - o_custkey AS userId,
         CAST('0x' || substr(md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                           CAST(trunc(l_quantity) AS BIGINT),
                                           CAST(epoch(l_shipdate) AS BIGINT))), 1, 15)
              AS BIGINT) AS candidate_rank,
         l_partkey AS movieId, CAST(trunc(l_quantity) AS BIGINT) % 9 AS q9, l_partkey AS pk
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ans AS MATERIALIZED (
  SELECT userId, candidate_rank, CAST(1 AS BIGINT) AS attempt, movieId,
         CASE WHEN q9 = 0 THEN 'x' WHEN q9 = 7 THEN '0' WHEN q9 = 8 THEN '4.5'
              WHEN pk % 13 = 0 THEN ' ' || CAST(q9 AS VARCHAR)
              ELSE CAST(q9 AS VARCHAR) END AS answer
  FROM ans_base
  UNION ALL
  SELECT userId, candidate_rank, CAST(2 AS BIGINT), movieId, CAST(1 + pk % 7 AS VARCHAR)
  FROM ans_base WHERE q9 IN (0, 7, 8) OR pk % 13 = 0),
ans_cls AS MATERIALIZED (
  SELECT *, CASE WHEN value IS NULL THEN 'rejected_not_integer' WHEN value = 6 THEN 'skipped'
                 WHEN value BETWEEN 1 AND 5 THEN 'accepted' ELSE 'rejected_out_of_range' END AS cls
  FROM (SELECT *, CASE WHEN regexp_full_match(answer, '[+-]?[0-9]+')
                       THEN TRY_CAST(answer AS INTEGER) END AS value FROM ans) a),
ans_dec AS MATERIALIZED (
  SELECT userId, candidate_rank, attempt AS decision_attempt, answer AS decision_answer,
         cls AS decision, value AS dvalue, movieId AS dmovie FROM (
    SELECT *, row_number() OVER (PARTITION BY userId, candidate_rank ORDER BY attempt, answer) AS k
    FROM ans_cls WHERE cls IN ('accepted', 'skipped')) WHERE k = 1),
ans_first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY userId ORDER BY candidate_rank) AS k
    FROM ans_dec WHERE decision = 'accepted') WHERE k <= 20),
acc AS (SELECT userId, dmovie AS movieId, CAST(dvalue AS DOUBLE) AS rating FROM ans_first)"""

# The log in one pass of windows over the answers: the first deciding answer of a question, the running number of
# accepted questions of a user, and the question with which the limit is reached.
_ANSWER_LOG = """
SELECT userId, candidate_rank, attempt, movieId, answer, value,
       CASE WHEN candidate_rank > last_rank THEN 'unused_after_limit'
            WHEN (attempt, answer) > decided THEN 'unused_after_decision' ELSE cls END AS status
FROM (
  SELECT *, min(CASE WHEN n_accepted >= 20 THEN candidate_rank END) OVER (PARTITION BY userId) AS last_rank
  FROM (
    SELECT *, sum(CASE WHEN cls = 'accepted' AND (attempt, answer) = decided THEN 1 ELSE 0 END)
             OVER (PARTITION BY userId ORDER BY candidate_rank) AS n_accepted
    FROM (
      SELECT *, min(CASE WHEN cls IN ('accepted', 'skipped') THEN (attempt, answer) END)
               OVER (PARTITION BY userId, candidate_rank) AS decided
      FROM (
        SELECT *, CASE WHEN value IS NULL THEN 'rejected_not_integer' WHEN value = 6 THEN 'skipped'
                       WHEN value BETWEEN 1 AND 5 THEN 'accepted' ELSE 'rejected_out_of_range' END AS cls
        FROM (
          SELECT -1 - o_custkey AS userId, CAST('0x' || substr(key, 1, 15) AS BIGINT) AS candidate_rank,
                 attempt, l_partkey AS movieId, answer,
                 CASE WHEN regexp_full_match(answer, '[+-]?[0-9]+') THEN TRY_CAST(answer AS INTEGER) END AS value
          FROM (
            SELECT o_custkey, l_partkey, key, CAST(1 AS BIGINT) AS attempt,
                   CASE WHEN q = 0 THEN 'x' WHEN q = 7 THEN '0' WHEN q = 8 THEN '4.5'
                        WHEN l_partkey % 13 = 0 THEN ' ' || CAST(q AS VARCHAR) ELSE CAST(q AS VARCHAR) END AS answer
            FROM (SELECT *, CAST(trunc(l_quantity) AS BIGINT) % 9 AS q, md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey,
                         l_suppkey, CAST(trunc(l_quantity) AS BIGINT), CAST(epoch(l_shipdate) AS BIGINT))) AS key
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) a
            UNION ALL
            SELECT o_custkey, l_partkey, key, 2, CAST(1 + l_partkey % 7 AS VARCHAR)
            FROM (SELECT *, CAST(trunc(l_quantity) AS BIGINT) % 9 AS q, md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey,
                         l_suppkey, CAST(trunc(l_quantity) AS BIGINT), CAST(epoch(l_shipdate) AS BIGINT))) AS key
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) b
            WHERE q IN (0, 7, 8) OR l_partkey % 13 = 0) c) d) e) f) g) h"""

_SIM = f"""
t AS (SELECT DISTINCT userId, movieId, rating FROM rat WHERE userId = {TARGET_USER}),
co AS (
  SELECT t.userId AS userId1, t.movieId, t.rating AS rat1, r.userId AS userId2, r.rating AS rat2
  FROM t JOIN (SELECT DISTINCT userId, movieId, rating FROM rat) r
    ON t.movieId = r.movieId AND r.userId <> t.userId),
g AS (
  SELECT userId1, userId2, sum(rat1 * rat2) AS dot, sum(rat1 * rat1) AS n1, sum(rat2 * rat2) AS n2
  FROM co GROUP BY userId1, userId2),
sim AS (
  SELECT userId1, userId2,
         coalesce(dot / (sqrt(sum(n1) OVER (PARTITION BY userId1)) * sqrt(n2)), 0) AS cosineSim
  FROM g),
nrows AS (
  SELECT s.userId1 AS userId, s.cosineSim AS cosSim, r.movieId, m.title, r.rating
  FROM sim s JOIN rat r ON r.userId = s.userId2 JOIN mov m ON m.movieId = r.movieId
  WHERE NOT EXISTS (SELECT 1 FROM rat x WHERE x.userId = s.userId1 AND x.movieId = r.movieId)),
pred AS (
  SELECT userId, movieId, sum(rating * cosSim) / sum(cosSim) AS ratingPredicted
  FROM nrows GROUP BY userId, movieId HAVING sum(cosSim) <> 0),
ntop AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY round(cosSim, 9) DESC,
                   round(ratingPredicted, 9) DESC, movieId, rating) AS INTEGER) AS rank
    FROM (SELECT DISTINCT n.userId, n.movieId, n.title, n.cosSim, n.rating, p.ratingPredicted
          FROM nrows n JOIN pred p USING (userId, movieId)) d) WHERE rank <= 20)"""


_LIGHT = f"(SELECT userId FROM rat GROUP BY userId HAVING count(*) <= {LIGHT_USER_RATINGS})"
_SIM_SET = _SIM.replace(f"rat WHERE userId = {TARGET_USER})", f"rat WHERE userId IN {_LIGHT})")


def _mask_sql(col: str) -> str:
    return " + ".join(f"(CASE WHEN list_contains({col}, '{g}') THEN {1 << i} ELSE 0 END)"
                      for i, g in enumerate(VOCAB))


_VOCAB_VALUES = ", ".join(f"({i}, '{g}')" for i, g in enumerate(VOCAB))

_CONTENT = f"""
vocab AS (SELECT * FROM (VALUES {_VOCAB_VALUES}) v(i, genre)),
liked AS (
  SELECT userId, movieId, rating, "timestamp", CAST(recency AS INTEGER) AS recency FROM (
    SELECT r.*, row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, movieId) AS recency
    FROM rat r
    WHERE rating >= 3
      AND NOT EXISTS (SELECT 1 FROM mov m WHERE m.movieId = r.movieId
                      AND m.genres = '(Nessun genere elencato)')) x
  WHERE recency <= 5),
gm AS (
  SELECT movieId, CAST({_mask_sql('gl')} AS BIGINT) AS mask, gl
  FROM (SELECT movieId, string_split(genres, '|') AS gl FROM mov
        WHERE genres IS NOT NULL AND genres <> '(no genres listed)') y),
prof AS (
  SELECT l.userId, v.i, v.genre,
         sum(CASE WHEN gm.movieId IS NOT NULL AND list_contains(gm.gl, v.genre) THEN l.rating ELSE 0 END)
           AS weight
  FROM liked l LEFT JOIN gm USING (movieId) CROSS JOIN vocab v
  GROUP BY l.userId, v.i, v.genre),
pnorm AS (SELECT userId, sqrt(sum(weight * weight)) AS norm_p FROM prof GROUP BY userId),
sigs AS (SELECT DISTINCT mask FROM gm),
sdot AS (
  SELECT p.userId, s.mask, sum(CASE WHEN (s.mask >> p.i) & 1 = 1 THEN p.weight ELSE 0 END) AS dot
  FROM prof p CROSS JOIN sigs s GROUP BY p.userId, s.mask),
sscore AS (
  SELECT d.userId, d.mask,
         5 * CASE WHEN n.norm_p * sqrt(bit_count(d.mask)) <> 0
                  THEN d.dot / (n.norm_p * sqrt(bit_count(d.mask))) ELSE d.dot END AS score
  FROM sdot d JOIN pnorm n USING (userId)),
cscore AS (
  SELECT s.userId, gm.movieId, s.score
  FROM sscore s JOIN gm USING (mask)
  WHERE NOT EXISTS (SELECT 1 FROM rat x WHERE x.userId = s.userId AND x.movieId = gm.movieId)),
ctop AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY round(score, 9) DESC, movieId)
                   AS INTEGER) AS rank
    FROM cscore) z WHERE rank <= 20)"""


# Outputs are rounded to 6 places through an integer count of 1e-9 units,
# floor((round(x * 1e9) + 500) / 1000) / 1e6: every step is exact or correctly
# rounded, so Spark and DuckDB give the same double even at a 6-place half.


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


ORACLE: dict[str, str] = {
    "o01_ratings": _with(_RAT) + 'SELECT userId, movieId, rating, "timestamp" FROM rat',
    "o02_movies": _with(_MOV) + "SELECT movieId, title, genres FROM mov",
    "o03_titles": _with(_RAT, _MOV) + """
SELECT r.movieId, r.userId, r.rating, m.title FROM rat r LEFT JOIN mov m USING (movieId)""",
    "o04_popularity": _with(_RAT, _MOV) + """
SELECT m.movieId, m.title, s.total / (SELECT CAST(count(*) AS DOUBLE) FROM rat) AS score
FROM mov m JOIN (SELECT movieId, sum(rating) AS total FROM rat GROUP BY movieId) s USING (movieId)""",
    "o05_popular_candidates": _with(_RAT, _MOV) + """
SELECT CAST(row_number() OVER (ORDER BY score DESC, movieId) AS INTEGER) AS rank, movieId, title, score
FROM (SELECT m.movieId, m.title, s.total / (SELECT CAST(count(*) AS DOUBLE) FROM rat) AS score
      FROM mov m JOIN (SELECT movieId, sum(rating) AS total FROM rat GROUP BY movieId) s USING (movieId)
      ORDER BY score DESC, movieId LIMIT 150) x""",
    "o06_unseen_movies": _with(_RAT, _MOV) + f"""
SELECT CAST({TARGET_USER} AS BIGINT) AS userId, movieId, title FROM mov m
WHERE NOT EXISTS (SELECT 1 FROM rat r WHERE r.userId = {TARGET_USER} AND r.movieId = m.movieId)""",
    "o06_unseen_movies_set": _with(_RAT, _MOV) + f"""
SELECT u.userId, m.movieId, m.title FROM {_LIGHT} u CROSS JOIN mov m
WHERE NOT EXISTS (SELECT 1 FROM rat r WHERE r.userId = u.userId AND r.movieId = m.movieId)""",
    "o07_random_candidates": _with(_RAT, _MOV) + f"""
SELECT CAST({TARGET_USER} AS BIGINT) AS userId,
       CAST(row_number() OVER (ORDER BY k, movieId) AS INTEGER) AS rank, movieId, title
FROM (SELECT movieId, title, md5(concat(CAST(movieId AS VARCHAR), ':42')) AS k FROM mov m
      WHERE NOT EXISTS (SELECT 1 FROM rat r WHERE r.userId = {TARGET_USER} AND r.movieId = m.movieId)
      ORDER BY k, movieId LIMIT 150) x""",
    "o07_random_candidates_set": _with(_RAT, _MOV) + f"""
SELECT userId, CAST(rank AS INTEGER) AS rank, movieId, title FROM (
  SELECT u.userId, m.movieId, m.title,
         row_number() OVER (PARTITION BY u.userId ORDER BY md5(concat(CAST(m.movieId AS VARCHAR), ':42')), m.movieId) AS rank
  FROM {_LIGHT} u CROSS JOIN mov m
  WHERE NOT EXISTS (SELECT 1 FROM rat r WHERE r.userId = u.userId AND r.movieId = m.movieId)) x
WHERE rank <= 150""",
    "o08_accepted_ratings": _with(_ANS) + "SELECT userId, movieId, rating FROM acc",
    "o08_answer_log": _ANSWER_LOG,
    "o09_appended_ratings": _with(_RAT, _ANS) + """
SELECT userId, movieId, rating, "timestamp" FROM rat
UNION ALL SELECT userId, movieId, rating, CAST(NULL AS BIGINT) FROM acc""",
    "o09_rating_store": _with(_RAT, _ANS) + """
SELECT userId, movieId, rating, "timestamp" FROM rat
UNION ALL SELECT userId, movieId, rating, CAST(NULL AS BIGINT) FROM acc""",
    "o10_als_check": _with(_RAT) + "SELECT userId, count(*) AS n_ratings, true AS solved FROM rat GROUP BY userId",
    "o11_als_check": _with(_RAT) + "SELECT userId, count(*) AS n_scored, true AS sound FROM rat GROUP BY userId",
    "o12_als_check": _with(_RAT, _MOV) + """
SELECT userId, count(*) AS n_requests,
       md5(string_agg(said, chr(10) ORDER BY said)) AS titles_md5, true AS sound
FROM (SELECT r.userId, concat(CAST(r.movieId AS VARCHAR), ' ', coalesce(m.title, '')) AS said
      FROM rat r LEFT JOIN mov m USING (movieId)) x GROUP BY userId""",
    "o13_als_check": _with(_RAT) + """
SELECT userId, least(20, (SELECT count(DISTINCT movieId) FROM rat)) AS n_items, true AS sound FROM rat GROUP BY userId""",
    "o14_als_check": _with(_RAT) + "SELECT count(*) AS n, true AS is_mean, true AS beats_mean FROM rat",
    "o27_refresh_check": _with(_RAT, _ANS) + """
SELECT userId, count(*) AS n_ratings, true AS solved
FROM (SELECT userId, movieId FROM rat UNION ALL SELECT userId, movieId FROM acc) x GROUP BY userId""",
    "o15_co_rated": _with(_RAT, _SIM) + "SELECT userId1, movieId, rat1, userId2, rat2 FROM co",
    "o16_user_cosine": _with(_RAT, _SIM) + """
SELECT userId1, userId2, floor((round((cosineSim) * 1e9) + 500) / 1000) / 1e6 AS cosineSim FROM sim""",
    "o16_user_cosine_corated": _with(_RAT, _SIM) + """
SELECT userId1, userId2, floor((round((coalesce(dot / (sqrt(n1) * sqrt(n2)), 0)) * 1e9) + 500) / 1000) / 1e6 AS cosineSim FROM g""",
    "o16_user_cosine_set": _with(_RAT, _SIM_SET) + """
SELECT userId1, userId2, floor((round((cosineSim) * 1e9) + 500) / 1000) / 1e6 AS cosineSim FROM sim""",
    "o17_neighbour_predictions": _with(_RAT, _MOV, _SIM) + """
SELECT userId, movieId, floor((round((ratingPredicted) * 1e9) + 500) / 1000) / 1e6 AS ratingPredicted FROM pred""",
    "o18_neighbour_top20": _with(_RAT, _MOV, _SIM) + """
SELECT userId, rank, movieId, title, floor((round((cosSim) * 1e9) + 500) / 1000) / 1e6 AS cosSim, rating,
       floor((round((ratingPredicted) * 1e9) + 500) / 1000) / 1e6 AS ratingPredicted FROM ntop""",
    "o18_neighbour_top20_set": _with(_RAT, _MOV, _SIM_SET) + """
SELECT userId, rank, movieId, title, floor((round((cosSim) * 1e9) + 500) / 1000) / 1e6 AS cosSim, rating,
       floor((round((ratingPredicted) * 1e9) + 500) / 1000) / 1e6 AS ratingPredicted FROM ntop""",
    "o19_recommendations_as_ratings": _with(_RAT, _MOV, _SIM) + """
SELECT userId, movieId, floor((round((rating) * 1e9) + 500) / 1000) / 1e6 AS rating, "timestamp" FROM rat
UNION ALL SELECT userId, movieId, floor((round((ratingPredicted) * 1e9) + 500) / 1000) / 1e6, CAST(NULL AS BIGINT) FROM ntop""",
    "o20_liked_ratings": _with(_RAT, _MOV, _CONTENT) + """
SELECT userId, movieId, rating, "timestamp", recency FROM liked""",
    "o21_genre_matrix": _with(_RAT, _MOV, _CONTENT) + """
SELECT movieId, mask AS genre_mask, CAST(bit_count(mask) AS INTEGER) AS n_genres FROM gm""",
    "o22_user_profiles": _with(_RAT, _MOV, _CONTENT) + "SELECT userId, genre, weight FROM prof",
    "o23_seen_items": _with(_RAT) + "SELECT DISTINCT userId, movieId FROM rat",
    "o23_seen_containers": _with(_RAT) + f"""
SELECT userId, bucket, n_seen, CASE WHEN n_seen < {DENSE} THEN array_to_string(list_sort(ps), ',') END AS positions,
       CASE WHEN n_seen >= {DENSE} THEN array_to_string(list_transform(range(4096), lambda b: printf('%02X', list_sum(
         list_prepend(0, list_transform(list_filter(ps, lambda p: p // 8 = b), lambda p: 1 << (p % 8))))::INTEGER)), '') END AS bits
FROM (SELECT userId, bucket, CAST(count(DISTINCT p) AS INTEGER) AS n_seen, list(DISTINCT p) AS ps
      FROM (SELECT userId, CAST(CASE WHEN movieId > 0 THEN (movieId - 1) // 32768 + 1 ELSE -((-movieId) // 32768) END AS INTEGER) AS bucket,
                   CASE WHEN movieId > 0 THEN (movieId - 1) % 32768 ELSE (-movieId) % 32768 END AS p FROM rat) y
      GROUP BY userId, bucket) x""",
    "o24_content_scores": _with(_RAT, _MOV, _CONTENT) + """
SELECT r.userId, r.movieId, floor((round((s.score) * 1e9) + 500) / 1000) / 1e6 AS score
FROM rat r JOIN gm USING (movieId) JOIN sscore s ON s.userId = r.userId AND s.mask = gm.mask""",
    "o24_content_top_scores": _with(_RAT, _MOV, _CONTENT) + """
SELECT userId, movieId, floor((round((score) * 1e9) + 500) / 1000) / 1e6 AS score FROM ctop""",
    "o25_content_top20": _with(_RAT, _MOV, _CONTENT) + """
SELECT c.userId, c.rank, c.movieId, m.title, floor((round((c.score) * 1e9) + 500) / 1000) / 1e6 AS score
FROM ctop c LEFT JOIN mov m USING (movieId)""",
    "o26_content_report": _with(_RAT, _MOV, _CONTENT) + """,
first_users AS (SELECT DISTINCT userId FROM ctop ORDER BY userId LIMIT 5)
SELECT c.userId,
       'utente: ' || CAST(c.userId AS VARCHAR) || ' -> ' ||
       string_agg(printf(chr(9) || '%d)''%s'' score: %s/5', c.rank, coalesce(m.title, 'null'),
                         CAST(floor((round((c.score) * 1e9) + 500) / 1000) / 1e6 AS VARCHAR)), ';' ORDER BY c.rank) AS line
FROM ctop c JOIN first_users f USING (userId) LEFT JOIN mov m USING (movieId)
GROUP BY c.userId""",
}
