"""Classification of one typed answer of a cold-start user.

An answer counts as a number only if it is an optional sign and digits with
no blanks and fits an int (a SQL cast would trim blanks; the console did
not).  1..5 rates the movie, 6 skips it, anything else is rejected and the
same movie is asked again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.schema import ANSWER_MAX, ANSWER_MIN, ANSWER_SKIP

ACCEPTED = "accepted"
SKIPPED = "skipped"
NOT_INTEGER = "rejected_not_integer"
OUT_OF_RANGE = "rejected_out_of_range"
AFTER_DECISION = "unused_after_decision"
AFTER_LIMIT = "unused_after_limit"


def answer_value(answer: Column) -> Column:
    """The answer as int, or null when it is not an integer token."""
    # \z is the end of the input ($ would also match before a final newline)
    return F.when(answer.rlike(r"^[+-]?[0-9]+\z"), answer.try_cast("int"))


def answer_class(answer: Column) -> Column:
    v = answer_value(answer)
    return (F.when(v.isNull(), F.lit(NOT_INTEGER))
            .when(v == ANSWER_SKIP, F.lit(SKIPPED))
            .when((v >= ANSWER_MIN) & (v <= ANSWER_MAX), F.lit(ACCEPTED))
            .otherwise(F.lit(OUT_OF_RANGE)))
