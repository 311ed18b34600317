"""Text measures from Spark's own functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of other characters than these.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null has none. Each word shrinks to one mark, so no array is built."""
    marks = F.regexp_replace(text, WORD, "w")
    return F.coalesce(F.length(F.regexp_replace(marks, "[^w]+", "")), F.lit(0)).cast("long")
