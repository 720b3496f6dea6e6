"""Joins inside groups of any size, in blocks: a group larger than a block is cut into blocks, and each pair of blocks is a task's work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, settle


def block_pairs(rows: DataFrame, group: list[str], order: Column, block: int, least_buckets: int, size: Column, each: int = 32 << 20) -> DataFrame:
    """rows, replicated to the block pairs of their group, with i, j (the pair), side (0: block i, 1: block j) and bucket.

    A group of m rows has ceil(m / block) blocks; a row in block b is needed in the pairs (b, j) and (i, b), so a group
    within one block is not replicated at all. Rows go to blocks by a hash, so no group is ever sorted or gathered.
    bucket: packs many small groups into one call; the blocks of a large group spread over the buckets.
    size: bytes of a row. There are at least least_buckets buckets, and one for `each` replicated bytes, so that what a
    call holds does not grow with the data.
    """
    sizes = settle(rows.groupBy(*group).agg(F.count("*").alias("_m"), F.sum(size.cast("long")).alias("_s")).filter(F.col("_m") > 1), "sizes")
    total = sizes.agg(F.sum(F.col("_s") * F.ceil(F.col("_m") / F.lit(block)))).first()[0] or 0
    buckets = max(least_buckets, -(-int(total) // each))
    sized = rows.join(sizes.drop("_s"), group)
    sized = sized.withColumn("_n", F.ceil(F.col("_m") / F.lit(block)).cast("int")).withColumn("_b", F.pmod(F.xxhash64(order), F.col("_n")).cast("int"))
    pairs = F.expr("flatten(array(transform(sequence(_b, _n - 1), j -> struct(_b as i, j as j)), transform(filter(sequence(0, _b), x -> x < _b), i -> struct(i as i, _b as j))))")
    out = sized.withColumn("_p", F.explode(pairs)).withColumn("i", F.col("_p.i")).withColumn("j", F.col("_p.j")).withColumn("side", (F.col("_b") != F.col("i")).cast("int"))
    return out.withColumn("bucket", F.pmod(F.xxhash64(*group, "i", "j"), F.lit(buckets)).cast("int")).drop("_m", "_n", "_b", "_p")


def _marks(keys: DataFrame, key: str, words: int) -> DataFrame:
    """A bit table of the keys: at most `words` rows (word, bits)."""
    return settle(keys.select(_word(F.col(key), words).alias("word"), _bit(F.col(key)).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")), "marks")


def _word(c: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(words))


def _bit(c: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(F.xxhash64(c), 32), F.lit(64)).cast("int"))


def sift(rows: DataFrame, column: Column, keys: DataFrame, key: str, words: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """(rows whose column may equal a key, the others), before an exact join of the first: a row that equals one is always
    there, nulls as a value.

    The keys become bits in words of 64, so what is broadcast has at most `words` rows, whatever the number of keys; with
    many more keys than bits most rows are in the first part and the join does the work alone.
    """
    word, bits, hit = free(rows, "mark_word", "mark_bits", "mark_hit")
    both = rows.join(F.broadcast(_marks(keys, key, words).toDF(word, bits)), _word(column, words) == F.col(word), "left")
    both = both.withColumn(hit, F.coalesce(F.col(bits).bitwiseAND(_bit(column)) != 0, F.lit(False)))
    return both.filter(hit).select(rows.columns), both.filter(~F.col(hit)).select(rows.columns)


def may_meet(rows: DataFrame, column: str, keys: DataFrame, key: str, words: int = 1 << 20) -> DataFrame:
    """The first part of sift()."""
    return sift(rows, F.col(column), keys, key, words)[0]
