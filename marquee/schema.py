"""Declared schemas and the fixed values every operator shares.

Ids are whatever integral type the input carries (the CSV readers declare
``int``, the driver's tables carry ``bigint``); only the latent-factor
operators cast to ``int`` because Spark ML's ALS needs int-range ids.
"""

from __future__ import annotations

from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("userId", T.IntegerType(), False),
        T.StructField("movieId", T.IntegerType(), False),
        T.StructField("rating", T.DoubleType(), False),
        T.StructField("timestamp", T.LongType(), True),
    ]
)

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.IntegerType(), False),
        T.StructField("title", T.StringType(), True),
        T.StructField("genres", T.StringType(), True),
    ]
)

ANSWERS = T.StructType(
    [
        T.StructField("userId", T.LongType(), False),
        T.StructField("candidate_rank", T.LongType(), False),
        T.StructField("attempt", T.LongType(), False),
        T.StructField("movieId", T.LongType(), False),
        T.StructField("answer", T.StringType(), True),
    ]
)

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
# ---------------------------------------------------------------------------

# Default genre vocabulary of the content-based recommender (MovieLens genres).
DEFAULT_GENRES = (
    "Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
    "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "IMAX",
    "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western",
)
# Genre string of a movie without genres (the genre matrix skips it).
NO_GENRE_LABEL = "(no genres listed)"
# Sentinel the liked-ratings step excludes; it differs from NO_GENRE_LABEL on
# purpose (the original excluded a localised label that MovieLens never uses).
EXCLUDE_LABEL = "(Nessun genere elencato)"
# Genre separator inside the genres string.
GENRE_SEPARATOR = "|"

# Popularity: the original divides the rating sum by this constant.
REFERENCE_POPULARITY_DENOMINATOR = 100836
# Cold start: number of candidates offered, answers accepted, skip code.
N_CANDIDATES = 150
MAX_ACCEPTED = 20
ANSWER_MIN = 1
ANSWER_MAX = 5
ANSWER_SKIP = 6
# Latent factors: rank, iterations, regularisation.
ALS_RANK = 6
ALS_MAX_ITER = 5
ALS_REG_PARAM = 0.01
# Recommendation list length for known users and for the neighbourhood method.
N_RECOMMENDATIONS = 20
# Content-based: liked threshold, liked ratings per user, score scale,
# users shown in the report.
LIKED_THRESHOLD = 3.0
N_LIKED = 5
SCORE_SCALE = 5.0
REPORT_USERS = 5
# Report line pieces: "utente: <id> -> \t1)'<title>' score: <s>/5;\t2)..."
REPORT_USER_PREFIX = "utente: "
REPORT_USER_SUFFIX = " -> "
REPORT_ITEM_FORMAT = "\t%d)'%s' score: %s/5"
REPORT_ITEM_SEPARATOR = ";"

# Our own defaults (not taken from the original).
DEFAULT_SEED = 42
