"""Column helpers shared by the operators."""

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body
    or a lambda inside it refers to it."""
    return F.transform(F.array(value), body)[0]


def whole(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"))


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def boxed(docs: DataFrame) -> DataFrame:
    """The rows as one struct column ``_row`` beside copies of doc_id, text, lang and
    source where present, so that no column added later can clash with one of theirs."""
    used = [c for c in ("doc_id", "text", "lang", "source") if c in docs.columns]
    return docs.select(F.struct("*").alias("_row"), *used)


def unboxed(rows: DataFrame) -> DataFrame:
    return rows.select("_row.*")
