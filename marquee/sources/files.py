"""O1 / O2: typed ratings and movies from delimited files or Parquet.

* With a header, columns are found by name: their order does not matter, other
  columns are ignored, a missing one fails (``timestamp`` and ``genres`` may be
  absent and are null then).  All files of a read must have the same header.
* Without one, ratings are ``userId,movieId,rating[,anything...]`` and movies
  ``movieId,title[,genres[,anything...]]``: fields past the known ones are
  ignored.
* A number must be one: a malformed or missing value, or one with blanks around
  it, fails the job instead of turning into a silent null.  Blank lines are
  skipped.
* Movie files go through the CSV source so that quoted titles containing commas
  stay whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schema import MOVIES, RATINGS

OPTIONAL = frozenset({"timestamp", "genres", "title"})


def _number(value: Column, field: T.StructField) -> Column:
    """``value`` as the field's number; blanks, junk and (unless optional) null fail."""
    kind = field.dataType
    bad = value.isNull() | (value != F.trim(value)) | value.try_cast(kind).isNull()
    if field.name in OPTIONAL:
        bad = value.isNotNull() & bad
    error = F.raise_error(F.concat(F.lit(f"{field.name} is not a number: "), F.coalesce(value, F.lit("(missing)"))))
    return F.when(bad, error.cast(kind)).otherwise(value.try_cast(kind)).alias(field.name)


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, by name, from a frame of strings."""
    missing = [f.name for f in schema.fields if f.name not in df.columns and f.name not in OPTIONAL]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {df.columns}")
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.col(f.name))
        else:
            out.append(_number(F.col(f.name), f))
    return df.select(*out)


def _with_header(spark: SparkSession, path: str | list[str], sep: str, schema: T.StructType) -> DataFrame:
    # enforceSchema=false compares every file's header with the first one's
    df = (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
          .option("enforceSchema", False).csv(path))
    return _typed(df, schema)


def _from_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_ratings(spark: SparkSession, path: str | list[str], *, header: bool = False,
                 fmt: str = "csv", sep: str = ",") -> DataFrame:
    """O1: ratings as ``(userId, movieId, rating, timestamp)``."""
    if fmt == "parquet":
        return _from_parquet(spark, path, RATINGS)
    if header:
        return _with_header(spark, path, sep, RATINGS)
    parts = F.split(F.col("value"), _regex_literal(sep))
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    user, movie, rating, _ = RATINGS.fields
    return lines.select(
        _number(F.get(parts, F.lit(0)), user), _number(F.get(parts, F.lit(1)), movie),
        _number(F.get(parts, F.lit(2)), rating),
        # extra fields are ignored; a 4th one is kept as the epoch when it parses
        F.trim(F.get(parts, F.lit(3))).try_cast("long").alias("timestamp"))


def read_movies(spark: SparkSession, path: str | list[str], *, header: bool = True,
                fmt: str = "csv", sep: str = ",", check_unique: bool = True) -> DataFrame:
    """O2: movies as ``(movieId, title, genres)``; quoted titles are kept whole.

    ``check_unique`` fails on a repeated movie id (one aggregation job) instead
    of letting one copy silently win.
    """
    if fmt == "parquet":
        df = _from_parquet(spark, path, MOVIES)
    elif header:
        df = _with_header(spark, path, sep, MOVIES)
    else:
        # by position; a line may have fewer fields (null) or more (ignored)
        strings = T.StructType([T.StructField(f.name, T.StringType()) for f in MOVIES.fields])
        df = _typed(spark.read.schema(strings).option("sep", sep).option("quote", '"').option("escape", '"')
                    .option("mode", "PERMISSIVE").csv(path), MOVIES)
    return assert_unique(df, "movieId") if check_unique else df


def duplicate_ids(df: DataFrame, key: str = "movieId") -> DataFrame:
    """Ids that occur more than once (partial aggregation, no collect)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def assert_unique(df: DataFrame, key: str = "movieId") -> DataFrame:
    """Fail when ``key`` is not unique (the original silently kept the last copy).

    Runs one aggregation job that returns at most one row to the driver.
    """
    dup = duplicate_ids(df, key).limit(1).collect()
    if dup:
        raise ValueError(f"{key} is not unique, e.g. {dup[0][key]} occurs {dup[0]['copies']} times")
    return df


def _regex_literal(sep: str) -> str:
    return "".join("\\" + c if c in r".^$*+?{}[]\|()" else c for c in sep)
