"""Helpers of several operators: table access, text normal forms, row ids, written intermediate tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargelens.session import configure, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII characters outside 0-9 and A-Z a-z
SEPARATORS = "".join(chr(i) for i in range(128) if not chr(i).isalnum())
#: bytes table: A-Z to lower case, ASCII separators to a blank, all else as it is
WORD_BYTES = bytes(32 if i < 128 and not chr(i).isalnum() else i + 32 if 65 <= i <= 90 else i for i in range(256))

__all__ = ["table", "stage", "ascii_lower", "alnum_words", "id_crc", "spare", "rows_with_uid", "WORD_BYTES", "alnum_split", "blank_split"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(text, UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    """Lower-cased words of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`; null and empty texts have none."""
    flat = F.translate(F.coalesce(text, F.lit("")), UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS))
    return F.filter(F.split(flat, " "), lambda w: w != "")


def alnum_split(text: str | None) -> list[bytes]:
    """The same words, as UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def blank_split(text: str | None) -> list[bytes]:
    """Lower-cased words of `[^\\x20\\x09-\\x0D]+`, as UTF-8 (bytes methods touch ASCII only)."""
    return (text or "").encode("utf-8", "replace").lower().split()


def id_crc(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def spare(df: DataFrame, name: str) -> str:
    """`name`, or the first longer form of it that no column has (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_with_uid(df: DataFrame, name: str) -> DataFrame:
    """Written once with a number per row, so that the number stays the same in every later read."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()))
