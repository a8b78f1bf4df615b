"""Id sets and the details look-up by id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from vidlake.schemas import LOOKUP_BATCH
from vidlake.session import scratch_dir

# The id side is broadcast if it has no more ids and no more text than this.
BROADCAST_IDS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Beyond that, a bit map of the ids is: bits for each id, and at most so many rows of it.
BITS_PER_ID = 16
MAX_BITMAPS = BROADCAST_BYTES // 4096


def distinct_ids(*frames: DataFrame, column: str = "video_id") -> DataFrame:
    """The set union of the ids in all the inputs."""
    return reduce(DataFrame.unionByName, [df.select(column) for df in frames]).distinct()


def count_ids(df: DataFrame, column: str = "video_id") -> DataFrame:
    """Rows and distinct ids."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(column).alias("n_ids"))


def lookup_details(
    details: DataFrame,
    ids: DataFrame,
    column: str = "video_id",
    broadcast_up_to: int = BROADCAST_IDS,
) -> DataFrame:
    """Detail rows of the wanted ids; ids without details vanish.

    The distinct ids are made once, into a table in the shared scratch folder. There
    they are measured, in parallel, and broadcast if they are within the limits, which
    spares the details a shuffle. Beyond them both sides shuffle, and Spark splits the
    detail rows of an oversized id at run time; detail rows whose id is not in a bit map
    of the wanted ids are left out before that. The bit map has a bounded size whatever
    the number of ids: the more there are, the less it leaves out.
    """
    path = scratch_dir(ids.sparkSession)
    distinct_ids(ids, column=column).write.parquet(path)
    wanted = ids.sparkSession.read.schema(ids.select(column).schema).parquet(path)
    text = F.sum(F.octet_length(F.col(column).cast("string"))).alias("bytes")
    size = wanted.agg(F.count(F.lit(1)).alias("ids"), text).first()
    if size["ids"] <= broadcast_up_to and (size["bytes"] or 0) <= BROADCAST_BYTES:
        return details.join(F.broadcast(wanted), column, "left_semi")
    return maybe_wanted(details, wanted, size["ids"], column).join(wanted.hint("merge"), column, "left_semi")


def maybe_wanted(details: DataFrame, wanted: DataFrame, ids: int, column: str = "video_id") -> DataFrame:
    """Detail rows whose id may be among the wanted ones: all that are, and of the others
    about one in BITS_PER_ID, or more once the bit map has its full size. The map is a
    row of 4 kB per 32,768 hashes, of which there are MAX_BITMAPS at most."""
    bitmaps = min(MAX_BITMAPS, max(1, -(-ids * BITS_PER_ID >> 15)))
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(bitmaps << 15))
    bits = wanted.select(place.alias("_place")).groupBy(F.shiftright("_place", 15).alias("_map")).agg(
        F.bitmap_construct_agg(F.col("_place").bitwiseAND(F.lit(32767))).alias("_bits")
    )
    within = F.col("_place").bitwiseAND(F.lit(32767))
    byte = F.substring(F.col("_bits"), F.shiftright(within, 3).cast("int") + 1, F.lit(1))
    there = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.col("_place").bitwiseAND(F.lit(7)).cast("int")) == 1
    bits = F.broadcast(bits.withColumnRenamed("_map", "_of"))
    placed = details.withColumn("_place", place)
    # A semi join, as Spark would move the look-up's own one below any other.
    test = (F.shiftright("_place", 15) == F.col("_of")) & there
    return placed.join(bits, test, "left_semi").select(*details.columns)


def id_batches(
    ids: DataFrame, size: int = LOOKUP_BATCH, column: str = "video_id", bucket_digits: int = 3
) -> DataFrame:
    """Distinct ids in numbered batches of ``size``, all full but the last.

    A row number over the whole table would run in one task. Here ids are put in
    the order of their md5, which is the same on every run and splits them
    evenly by its leading digits: number the ids in each bucket, then add the
    ids in the buckets before. The bucket table, the only thing that meets in
    one task or is broadcast, has 16 ** bucket_digits rows whatever the input.
    """
    if not 1 <= bucket_digits <= 4:
        raise ValueError("bucket_digits must be 1 to 4")
    digest = F.md5(F.col(column).cast("binary"))
    hashed = distinct_ids(ids.filter(F.col(column).isNotNull()), column=column)
    hashed = hashed.withColumn("_digest", digest)
    hashed = hashed.withColumn("_bucket", F.substring("_digest", 1, bucket_digits))

    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )

    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", column)) - 1
    # Every bucket has a start. The left join only keeps Spark from putting a NULL
    # test into one of the two readings of the ids, which then share a shuffle.
    placed = hashed.withColumn("_place", place).join(F.broadcast(starts), "_bucket", "left")
    batch = F.floor((F.col("_start") + F.col("_place")) / size).cast("bigint")
    return placed.select(batch.alias("batch"), column)


def batch_lists(batches: DataFrame, column: str = "video_id") -> DataFrame:
    """Each batch as one comma-separated text; a batch is bounded by its size."""
    listed = F.concat_ws(",", F.array_sort(F.collect_list(column)))
    return batches.groupBy("batch").agg(F.count(F.lit(1)).alias("n_ids"), listed.alias("ids"))
