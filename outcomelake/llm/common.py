"""Helpers shared by the operators of this folder: words, batches, bounded samples, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Words a worker remembers before it starts anew; bounds its memory, never its results.
WORD_CACHE = 100_000
#: Bytes of input that a task holds at once beside Spark's batch; a longer row is a chunk of its own.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that all executors share.

    ``spark.checkpoint.dir`` names it; only where it is unset, as in tests, the
    warehouse folder stands in, which a cluster shares as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm_scratch"
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, and its path for ``discard``: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder that stays."""
    return stored(df, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no result reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` with ``number``, its rows' place (from 0) in the order of columns that tell all rows apart.

    Range partitions are sorted and written; the driver gets one count per partition.
    """
    at = F.monotonically_increasing_id()
    stored = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", at.alias("__at")), label)
    part, inside = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["n"] for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [0], 0
    for k in range(max(sizes, default=-1)):
        total += sizes.get(k, 0)
        before.append(total)
    offsets = F.array(*[F.lit(x).cast("long") for x in before])
    return stored.withColumn("number", F.element_at(offsets, (part + 1).cast("int")) + inside).drop("__at")


class WordIds(dict):
    """Word bytes -> 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_IDS = WordIds()


def word_ids(words: list[bytes]) -> np.ndarray:
    """One 64-bit id per word."""
    return np.fromiter(map(_IDS.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive ids."""
    n = len(ids) - width + 1
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + ids[k:n + k])
    return h


def chunks(batch: pa.RecordBatch, columns: list[int]) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows of about ``CHUNK_BYTES`` in ``columns``."""
    if not batch.num_rows:
        return
    sizes = np.full(batch.num_rows, 16, np.int64)
    for i in columns:
        column = batch.column(i)
        if pa.types.is_list(column.type):
            sizes += 4 * column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        elif pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    which = (np.cumsum(sizes) - sizes) // CHUNK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def append_columns(
    df: DataFrame, fields: list[T.StructField], fill: Callable[[dict[str, pa.Array]], list[pa.Array]],
    inputs: list[str], keep: list[str] | None = None,
) -> DataFrame:
    """Add columns computed batch by batch in tasks; those of the same name (any case) are replaced.

    ``fill`` gets the Arrow arrays of ``inputs`` and returns one array per field.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    kept_at = [df.columns.index(c) for c in kept]
    inputs_at = [df.columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (chunk for whole in batches for chunk in chunks(whole, inputs_at)):
            made = fill({c: batch.column(i) for c, i in zip(inputs, inputs_at)})
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept_at] + made, names=kept + [f.name for f in fields]
            )

    return df.mapInArrow(run, schema)


def hash_mod(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as decimal text, modulo; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def labelled_sample(
    rows: DataFrame, texts: DataFrame, label: str, per_class: int, max_chars: int, seed: int = 1, max_classes: int = 200,
) -> list[tuple[int, str, object]]:
    """At most ``per_class`` labelled texts of each of the ``max_classes`` largest classes, chosen by a seeded hash of the id.

    ``rows`` has ``doc_id`` and ``label``; ``texts`` has ``doc_id`` and ``text``.  Ids are
    chosen first, from two narrow columns; only then are texts read, so what reaches
    the driver is bounded by ``max_classes * per_class * max_chars``.  Rows with a null
    id or label, or an id with two labels, are left out.
    """
    spark = rows.sparkSession
    # A number in [0, 1) by hash; ids below a bound that leaves a little more than enough go into the ranking.
    order = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    marked = rows.select("doc_id", F.col(label).alias("label")).where("doc_id is not null and label is not null")
    counts = marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(max_classes).collect()
    if not counts:
        return []
    kind = rows.schema[label].dataType
    sizes = spark.createDataFrame([(r.label, r.n) for r in counts], T.StructType([T.StructField("label", kind), T.StructField("n", T.LongType())]))
    enough = per_class + 8 * int(per_class ** 0.5) + 50
    ids = (
        marked.join(F.broadcast(sizes), "label").where(order <= enough / F.col("n"))
        .withColumn("k", F.row_number().over(Window.partitionBy("label").orderBy(order, "doc_id"))).where(F.col("k") <= per_class)
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other").select("doc_id", "label").collect()
    )
    if not ids:
        return []
    bound = len(ids)
    fields = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("label", kind)])
    chosen = spark.createDataFrame([(r.doc_id, r.label) for r in ids], fields)
    found = (
        texts.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .select("doc_id", F.substring(F.coalesce("text", F.lit("")), 1, max_chars).alias("text"), "label")
        .orderBy(order, "doc_id", "text").limit(bound)
    )
    return [(r.doc_id, r.text, r.label) for r in found.collect()]
