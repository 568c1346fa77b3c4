"""Expressions and small helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import scratch_dir

SPACES = r"[\x20\x09-\x0D]+"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else. Texts of ASCII only take the byte-wise path."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    spelled = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(text)).otherwise(spelled)


def words(text: Column, gaps: str = SPACES) -> Column:
    """The pieces of ``text`` between ``gaps``, none of them empty; of a null text, no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gaps), "")


def id_text(column: str) -> Column:
    """An identifier as text, a null one as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_fold(column: str, folds: int) -> Column:
    """CRC-32 of the identifier's text, modulo ``folds``."""
    return F.crc32(id_text(column)) % folds


def md5_number(text: Column) -> Column:
    """The first 32 bits of the text's MD5 as a long: a spread that any SQL engine can repeat."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def sifted(df: DataFrame, chosen: DataFrame, hashed: str, bits: int) -> DataFrame:
    """Rows of ``df`` whose ``hashed`` may be among those of ``chosen``: false hits, no false misses.

    The chosen ones' bits, ``bits`` at most (a power of two), are a frame of fixed size that is broadcast,
    so that a shuffle which follows need not carry all of ``df``.
    """
    place = f"{hashed} & {bits - 1}L"
    marks = (
        chosen.select(F.expr(place).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("_word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(at & 63)))").alias("_set"))
    )
    return (
        df.withColumn("_word", F.expr(f"shiftright({place}, 6)"))
        .join(F.broadcast(marks), "_word")
        .filter(f"(shiftrightunsigned(_set, int({hashed} & 63)) & 1L) = 1")
        .drop("_word", "_set")
    )


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and it outlives executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled_once(df: DataFrame) -> DataFrame:
    """``df``, which ends in a shuffle, in a form whose later jobs find that shuffle's files again.

    Each job on a plain DataFrame plans and shuffles anew; jobs on one RDD skip stages that have run.
    Lost files are made again, as for any shuffle.
    """
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.javaRDD(), df._jdf.schema()), spark)
