"""Sharding by a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets of a set size by a seeded
hash; Spark's shuffle files are the external buckets. Pass two shuffles each
bucket in memory (Fisher-Yates, seeded by the bucket) and writes it. Bucket
after bucket is a random order of all rows, and cutting it at equal counts gives
shards whose row counts differ by one at most.

A task holds one bucket. What grows with the data is the number of buckets; the
window that adds up their sizes sees one short row for each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arearisk.llm.common import quoted
from arearisk.scratch import materialize

#: Text bytes of a bucket on average.
BUCKET_BYTES = 32 << 20

#: Equal rows that one task writes out in a stretch.
STRETCH = 10_000


def _order(t: pa.Table, seed: int) -> np.ndarray:
    """Fisher-Yates order of a bucket's rows, whatever order they arrived in."""
    at = pc.sort_indices(t["_hash"]).to_numpy()
    order = at.astype(np.int64)
    rng = np.random.Generator(np.random.PCG64([seed & (2 ** 64 - 1), int(t["_bucket"][0].as_py())]))
    for i, j in zip(range(len(order) - 1, 0, -1), rng.integers(0, np.arange(len(order), 1, -1)).tolist()):
        order[i], order[j] = order[j], order[i]
    return order


def numbered_copies(whole: DataFrame, seed: int) -> DataFrame:
    """`row`, the seeded `_hash` of it and `_number`, 0 unless several rows have that hash: then equal rows count from 0.

    Hashes that occur more than once are found first; only their rows are grouped, each kind being counted where
    it lies and unfolded again after the sum, so the numbers do not depend on the order of the rows.
    """
    hashed = whole.withColumn("_hash", F.xxhash64(F.lit(seed), "row"))
    often = materialize(hashed.groupBy("_hash").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("_hash").alias("_often")), "often")
    alone = hashed.join(often, F.col("_hash") == F.col("_often"), "left_anti").withColumn("_number", F.lit(0).cast("long"))
    kinds = hashed.join(often, F.col("_hash") == F.col("_often"), "left_semi").groupBy("_hash", "row").agg(F.count("*").alias("n"))
    # A kind of very many rows is unfolded in stretches that lie in different tasks.
    stretches = kinds.withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(STRETCH).cast("long"))))
    stretches = stretches.repartition("_hash", "_first")
    copies = stretches.select("row", "_hash", F.explode(F.sequence("_first", F.least(F.col("_first") + STRETCH, F.col("n")) - 1)).alias("_number"))
    return alone.unionByName(copies)


def external_shuffle(docs: DataFrame, seed: int = 42, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """All rows in a seeded random order, stored: `row` (the whole row as a struct), `doc_id`, `text`, `bucket`, `place`.

    The order is the same for the same rows, seed and number of buckets, however the input is split. NULL ids and
    texts are scattered like any value. Rows equal in all columns are numbered and scattered by their number too, so
    no key fills a bucket; an empty table gives an empty result. The input's columns stay inside `row`, so their
    names cannot clash.
    """
    whole = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"))
    own_id, own_text = F.col("row").getField(id_col), F.col("row").getField(text_col)
    size = whole.agg(F.sum(F.coalesce(F.octet_length(own_text), F.lit(0)).cast("long") + 16).alias("n")).first()["n"] or 0
    buckets = max(1, -(-size // bucket_bytes))
    scattered = numbered_copies(whole, seed).withColumn("_hash", F.xxhash64("_hash", "_number"))
    scattered = scattered.select("row", "_hash", F.pmod(F.xxhash64(F.lit(seed + 1), "_hash"), F.lit(buckets)).alias("_bucket"))

    def shuffle(t: pa.Table) -> pa.Table:
        t = t.take(pa.array(_order(t, seed))).drop_columns(["_hash"])
        return t.append_column("place", pa.array(np.arange(len(t))))

    kept = scattered.select("row", "_bucket").schema.add("place", "long")
    done = materialize(scattered.groupBy("_bucket").applyInArrow(shuffle, kept), "shuffled")
    return done.select("row", own_id.alias("doc_id"), own_text.alias("text"), F.col("_bucket").alias("bucket"), "place")


def shards(shuffled: DataFrame, n: int = 8) -> DataFrame:
    """Add `shard` (0 to n - 1) and `slot` (gapless from 0 in the shard) to the result of `external_shuffle`."""
    if n < 1:
        raise ValueError("at least one shard")
    sizes = shuffled.groupBy("bucket").agg(F.count("*").alias("rows"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Stored, so that its size is known before the join and the texts need not be shuffled again.
    starts = materialize(sizes.select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"),
                                      F.sum("rows").over(Window.partitionBy(F.lit(0))).alias("total")), "bucket-starts")
    out = shuffled.join(starts, "bucket").withColumn("shard", F.expr(f"CAST((first + place) * {n} div total AS INT)"))
    begin = F.expr(f"(CAST(shard AS BIGINT) * total + {n - 1}) div {n}")
    return out.withColumn("slot", F.col("first") + F.col("place") - begin).drop("first", "total")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the rows of every shard under `path`/shard=k, sorted by slot inside each file.

    Where the rows have a column `shard` or `slot` themselves, ours get underscores at the end until no name clashes.
    """
    own = {c.lower() for c in sharded.schema["row"].dataType.names}
    names = []
    for name in ("shard", "slot"):
        while name in own:
            name += "_"
        names.append(name)
    out = sharded.select(F.col("shard").alias(names[0]), F.col("slot").alias(names[1]), "row.*")
    out.repartitionByRange(*names).sortWithinPartitions(*names).write.partitionBy(names[0]).parquet(path)
