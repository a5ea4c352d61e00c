"""Expressions on text that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: White space between words: blank and \t to \r.
SPACE = r"[\x20\x09-\x0D]+"


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    """The runs of characters that are not white space."""
    return F.array_remove(F.split(text, SPACE), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def boxed(docs: DataFrame, *cols: str) -> DataFrame:
    """`row_in`, a struct of all columns, beside the columns an operator works on: other columns can't clash with its own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_in"), *cols)


def unboxed(df: DataFrame, like: DataFrame, **changed: Column) -> DataFrame:
    """The columns of `like` out of `row_in`, those in `changed` by new values."""
    return df.select(*[changed.get(c, F.col("row_in")[c]).alias(c) for c in like.columns])


def one_each(df: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """One row of each `key` that isn't null; counts: (key) of all rows, without the wide columns. Only rows whose key repeats are
    shuffled."""
    many = counts.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_many")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_many")
    if many.isEmpty():
        return df
    again = df.join(many, F.col(key).eqNullSafe(F.col("_many")), "left_semi").dropDuplicates([key])
    return df.join(many, F.col(key).eqNullSafe(F.col("_many")), "left_anti").union(again)


def _joined(col: str, offset: int):
    return lambda x, i: F.xxhash64(x, F.get(col, i + offset))


def with_windows(df: DataFrame, tokens: str, k: int, out: str) -> DataFrame:
    """Add `out`: 64-bit names of all windows of k words in the array `tokens`, repeats included; empty if there are fewer.

    Names of 1, 2, 4, ... words are combined, so that a word is hashed once and not k times.
    """
    have, at, names, offset = 1, "_x1", F.transform(tokens, lambda w: F.xxhash64(w)), 0
    df = df.withColumn(at, names)
    done, sizes = None, {1: at}
    while 2 * have <= k:
        nxt = f"_x{2 * have}"
        df = df.withColumn(nxt, F.transform(at, _joined(at, have)))
        have, at = 2 * have, nxt
        sizes[have] = at
    for part in [p for p in sorted(sizes, reverse=True) if k & p]:
        if done is None:
            done, offset = sizes[part], part
        else:
            nxt = f"_y{offset + part}"
            df = df.withColumn(nxt, F.transform(done, _joined(sizes[part], offset)))
            done, offset = nxt, offset + part
    df = df.withColumn(out, F.slice(done, 1, F.greatest(F.lit(0), F.size(tokens) - (k - 1))))
    return df.drop(*[c for c in df.columns if c.startswith(("_x", "_y"))])


def keyed_crc(col: str = "doc_id") -> Column:
    """crc32 of an id as text; the id null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")))


def numbered(df: DataFrame, group: str, order: list[str], out: str, salts: int = 0) -> DataFrame:
    """Add `out`: a gapless number from 0 within each `group`, without bringing a group into one task.

    Rows get a salt from the hash of `order`; they are numbered within (group, salt), and what smaller salts hold is
    added. The salts follow the number of shuffle partitions, so that even a group with all rows spreads evenly.
    """
    salts = salts or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    counts = salted.groupBy(group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("_group"), F.col("_salt").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(group, "_salt").orderBy(*order)
    return (
        salted.withColumn("_row", F.row_number().over(within))
        .join(offsets, (F.col(group).eqNullSafe(F.col("_group"))) & (F.col("_salt") == F.col("_s")))
        .withColumn(out, F.col("_before") + F.col("_row") - 1)
        .drop("_salt", "_s", "_group", "_before", "_row")
    )
