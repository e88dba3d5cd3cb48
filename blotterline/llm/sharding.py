"""Sharding: a Feistel permutation over global row numbers.

Rows are numbered in the order of ``doc_id``; a keyed Feistel network with cycle walking maps
each number to another one below the number of rows, one to one. The new number alone gives
shard and slot, so anybody who knows a row's number, the number of rows and the seed can compute
its place, and the place of all rows is a shuffle that repeats.

All of it is built-in Spark: one range shuffle of (doc_id, size, CRC), no text in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterline.llm.common import crc32_of, numbered_rows

#: Rounds of the network, and the longest cycle walk (see ``permuted``).
ROUNDS = 8
LONGEST_WALK = 128


def permuted(number: Column, total: int, seed: int = 0) -> Column:
    """Where a row number below ``total`` goes: a permutation of 0 .. total - 1.

    The network works on the smallest number of bits that holds ``total - 1``, in two halves:
    even rounds change the upper half by a hash of the lower one, odd rounds the other way
    round, so each round can be undone and the whole is one to one. A result that is not below
    ``total`` is put through the network again until one is (cycle walking). As the domain is
    less than twice ``total``, a walk of n steps has a chance of about 2**-n; one that is longer
    than 128 steps raises an error that asks for another seed, rather than misplacing the row.
    """
    bits = max(2, (total - 1).bit_length())
    low = bits // 2
    low_mask, high_mask = (1 << low) - 1, (1 << (bits - low)) - 1

    def one_round(x: Column, i: Column) -> Column:
        by_low = F.xxhash64(x.bitwiseAND(low_mask), i, F.lit(seed)).bitwiseAND(high_mask)
        by_high = F.xxhash64(F.shiftright(x, low), i, F.lit(seed)).bitwiseAND(low_mask)
        changed = F.when(i % 2 == 0, F.shiftleft(by_low, low)).otherwise(by_high)
        return x.bitwiseXOR(changed)

    def network(x: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), x, one_round)

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(LONGEST_WALK)),
        number.cast("long"),
        lambda x, i: F.when((i > 1) & (x < total), x).otherwise(network(x)),
    )
    failed = F.raise_error(F.lit("a cycle walk did not end; choose another seed")).cast("long")
    return F.when(walked < total, walked).otherwise(failed)


def shard_rows(
    docs: DataFrame, shards: int = 16, seed: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row with its shard and its slot there, by the law ``rows``.

    Returns doc_id, size (UTF-8 bytes + 1; null text: 1), text_crc32 (null text: as the empty
    one), law, shard, slot (gapless from 0 in each shard), grown_shard (null: this law moves rows
    between all shards when one is added) and row_number. Shards differ by one row at most.

    Row numbers follow doc_id (null first), then CRC, then size. Rows equal in all three swap
    places freely, which no result shows. Equal texts are rows like any others: a third of all
    rows may be copies, which no single shard could hold under this law. An empty table gives no
    rows. Other columns of ``docs`` are not read.
    """
    body = F.col(text).cast("string")
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        crc32_of(body).alias("text_crc32"),
    )
    rows, total = numbered_rows(sized, "doc_id", "text_crc32", "size")
    placed = rows.withColumn("_to", permuted(F.col("row_number"), max(total, 1), seed))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_to") % shards).cast("int").alias("shard"),
        F.expr(f"_to div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
