"""Target users: one id, a list of ids, or a DataFrame of ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Targets = int | Iterable[int] | DataFrame


def target_frame(like: DataFrame, targets: Targets, col: str = "userId") -> DataFrame:
    """The distinct target ids as ``(col)``, with the type that ``like`` has there."""
    kind = like.schema[col].dataType
    if isinstance(targets, DataFrame):
        return targets.select(F.col(targets.columns[0]).cast(kind).alias(col)).distinct()
    ids = [targets] if isinstance(targets, int) else sorted(set(targets))
    return like.sparkSession.createDataFrame([(int(i),) for i in ids], f"{col} long").select(F.col(col).cast(kind))


def restrict_to(df: DataFrame, targets: Targets, col: str = "userId") -> DataFrame:
    """Rows of ``df`` whose ``col`` is a target: a pushed-down filter for one id, else a semi join."""
    if isinstance(targets, int):
        return df.where(F.col(col) == targets)
    return df.join(target_frame(df, targets, col), col, "left_semi")


def frozen(targets: Targets) -> int | tuple[int, ...] | DataFrame:
    """An iterable of ids that can be read more than once."""
    return targets if isinstance(targets, (int, DataFrame)) else tuple(targets)
