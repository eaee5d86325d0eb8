"""Exact duplicates by a tree merge of sorted digest runs.

Every partition sorts the digests of its rows into a run with one entry per
digest. Runs are then exchanged in binomial rounds: the nodes that agree in all
digits of their number but one split their runs by that digit of the digest, and
each merges what it receives. An entry is (SHA-256, length, second digest);
only entries that agree in all three merge, at every level the best identifier
so verified is retained and the sizes are added. After the last round each node
holds the finished entries of its own share of the digests.

A group of copies, however large, is one entry per run before anything moves.
Merging streams over sorted rows, so a task holds one batch; sorting spills.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.llm.common import quoted
from arearisk.scratch import materialize

#: Most runs that one node merges in a round.
FAN_IN = 8

KEY = ["sha", "n_bytes", "second"]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    row = context.partitionId() << 33
    for b in batches:
        texts = [t.lower() for t in b.column("text").to_pylist()]  # lower-cases A-Z only, as it works on bytes
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array(np.arange(row, row + len(texts))),
            pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) for t in texts], pa.int64()),
        ], ["doc_id", "row", *KEY])
        row += len(texts)


def _with_digests(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pc.fill_null(b.column("whole").field(text_col), "").cast(pa.binary())
            own = pa.RecordBatch.from_arrays([pa.nulls(len(b)), texts], ["doc_id", "text"])
            (made,) = _digests([own])
            yield pa.RecordBatch.from_arrays([b.column("whole"), b.column("row"), *made.columns[2:]], ["whole", "row", *KEY])
    return run


def drop_copies(docs: DataFrame, keep: str = "max", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, that `exact_groups` keeps: one of each group of equal texts."""
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("whole"), F.monotonically_increasing_id().alias("row"))
    schema = T.StructType([*rows.schema.fields, T.StructField("sha", T.BinaryType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("second", T.LongType())])
    own = materialize(rows.mapInArrow(_with_digests(text_col), schema), "rows-with-digests")
    slim = own.select(F.col("whole").getField(id_col).alias("doc_id"), "row", *KEY)
    groups = materialize(merged_runs(slim, keep).filter("n > 1"), "digest-groups")
    groups = groups.select(*[F.col(k).alias(f"g_{k}") for k in KEY], "keep_row")
    gone = materialize(slim.join(groups, [F.col(k) == F.col(f"g_{k}") for k in KEY]).filter("row <> keep_row").select("row"), "copies")
    return own.join(gone.hint("merge"), "row", "left_anti").select("whole.*")


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, a row number, SHA-256, length and a second digest of every normalised text."""
    rows = docs.select(quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_digests, f"doc_id {kind}, row long, sha binary, n_bytes long, second long")


def _same(t: pa.Table) -> np.ndarray:
    """True where a row has the key of the row before it."""
    sha = t["sha"].combine_chunks()
    raw = np.frombuffer(b"".join(sha.to_pylist()), np.uint8).reshape(len(sha), -1)
    out = np.zeros(len(sha), bool)
    out[1:] = (raw[1:] == raw[:-1]).all(axis=1)
    for c in KEY[1:]:
        v = t[c].to_numpy()
        out[1:] &= v[1:] == v[:-1]
    return out


def _merger(last: bool):
    """Merge adjacent rows of one key; the last or the first of them names the one to keep."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.table({c: b.column(c) for c in b.schema.names})
            t = pa.concat_tables([held, t]) if held is not None else t
            if not len(t):
                continue
            starts = np.flatnonzero(~_same(t))
            ends = np.append(starts[1:], len(t)) - 1
            n = np.add.reduceat(t["n"].to_numpy(), starts)
            t = t.take(pa.array(ends if last else starts))
            t = pa.table({c: pa.array(n) if c == "n" else t[c] for c in t.column_names})
            held = t.slice(len(t) - 1)
            yield from t.slice(0, len(t) - 1).to_batches()
        if held is not None:
            yield from held.to_batches()
    return merge


def merged_runs(digests: DataFrame, keep: str = "max", nodes: int | None = None) -> DataFrame:
    """One row per distinct text: its key, `keep_id`, `keep_row` and the size `n` of its group."""
    if keep not in ("max", "min"):
        raise ValueError("keep is max or min")
    spark = digests.sparkSession
    wanted = max(2, nodes or int(spark.conf.get("spark.sql.shuffle.partitions")))
    rounds = max(1, math.ceil(math.log(wanted, FAN_IN) - 1e-9))
    radix = next(r for r in range(2, FAN_IN + 1) if r ** rounds >= wanted)
    count = radix ** rounds
    share = F.pmod(F.conv(F.hex(F.substring("sha", 1, 7)), 16, 10).cast("long"), F.lit(count))
    named = F.col("keep_id").asc_nulls_first() if keep == "max" else F.col("keep_id").asc_nulls_last()

    def merge(df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions(*KEY, named, "keep_row").mapInArrow(_merger(keep == "max"), df.schema)

    runs = digests.select(
        *KEY, F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("n"),
        F.pmod(F.spark_partition_id().cast("long"), F.lit(count)).alias("node"))
    runs = merge(runs)
    for k in range(rounds):
        step = radix ** k
        own = F.floor(F.col("node") / step) % radix
        theirs = F.floor(share / step) % radix
        runs = runs.withColumn("node", (F.col("node") + (theirs - own) * step).cast("long"))
        runs = merge(runs.repartitionById(count, F.col("node").cast("int")))
    return runs.drop("node")


def exact_groups(docs: DataFrame, keep: str = "max", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with `keep_id`, `group_size`, `kept` and `text_sha256`; also its digest key and row number.

    Texts are equal if identical after lower-casing A-Z; a NULL text is empty. The row with the largest (`keep`
    "min": smallest) id stays; NULL ids lose to any other, and of rows that repeat the winning id one stays.
    An empty table gives an empty result. Other columns are not read.
    """
    own = materialize(text_digests(docs, id_col, text_col), "digests")
    groups = materialize(merged_runs(own, keep).filter("n > 1"), "digest-groups")
    groups = groups.select(*[F.col(k).alias(f"g_{k}") for k in KEY], "keep_id", "keep_row", "n")
    out = own.join(groups, [F.col(k) == F.col(f"g_{k}") for k in KEY], "left")
    single = F.col("n").isNull()
    return out.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "row", "n_bytes")
