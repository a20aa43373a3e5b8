"""Text helpers: names, words, and concatenation of a group in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ids one partial list may span. A group of any size is first joined up in pieces of at most
# this many members, each piece a task of its own; only the finished text meets in one row.
PIECE = 4096

# The stop words of the English text search configuration.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "a an the and but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now"
).split()


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def joined_name(first: str = "first_name", last: str = "last_name") -> Column:
    """First letter up and the rest down in both names, with nothing between them."""

    def shaped(name: str) -> list[Column]:
        text = F.col(name)
        return [F.upper(F.substring(text, 1, 1)), F.lower(F.expr(f"substring({name}, 2)"))]

    return F.concat(*shaped(first), *shaped(last))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def group_concat(
    df: DataFrame, keys: list[str], value: str, order: str, out: str, separator: str = ", ",
    piece: int = PIECE,
) -> DataFrame:
    """One text per group: the values in ``order`` (an integer id), NULL values left out.

    Runs in two steps over pieces of consecutive ids, so that a hot group is spread over many
    tasks. A group with no value at all keeps its row with NULL.
    """
    mark = separator.replace("'", "''")
    part = F.floor(F.col(order) / F.lit(piece)).cast("bigint")
    pieces = (
        df.select(*keys, F.col(value).alias("_value"), F.col(order).alias("_order"), part.alias("_piece"))
        .groupBy(*keys, "_piece")
        .agg(F.expr(f"listagg(_value, '{mark}') WITHIN GROUP (ORDER BY _order)").alias("_text"))
    )
    return pieces.groupBy(*keys).agg(
        F.expr(f"listagg(_text, '{mark}') WITHIN GROUP (ORDER BY _piece)").alias(out)
    )
