"""Corpora: JSON lines or parquet in, with a dense document index; results out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from corpusgrove.schema import CORPUS, STAGE_COLUMNS
from corpusgrove.storage import broadcast_within, materialize, scratch_path

# documents in one folder of a stored range, and the most files of one
FOLDER = 1 << 14
FILES = 32
# documents of the first stored range; each further one holds as many times more
RANGE = 1 << 16
RANGE_GROWTH = 16

# rows of the broadcast table of input blocks, one for each 128 MB or so of input
BLOCK_LIMIT = 2_000_000



def file_order(raw: DataFrame, out: str) -> DataFrame:
    """Dense row number in file order, without sorting or shuffling the rows.

    One pass writes the rows to shared storage, each with the file and block it
    came from and its number in the task that read it.  All later steps read
    that table, so how another job would split the files does not matter.
    Numbers of earlier blocks are added up from one row for each block.
    """
    tagged = raw.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"),
    )
    stored = materialize(tagged, "numbered", "zstd")
    split = ["__file", "__start"]
    sizes = stored.groupBy(*split).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = W.orderBy(*split).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*split, "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    offsets = materialize(offsets, "blocks")
    numbered = (
        stored.join(broadcast_within(offsets, BLOCK_LIMIT), split, "left")
        .withColumn(out, F.coalesce(F.col("__offset") + F.col("__id") - F.col("__first"), F.raise_error(F.lit("a row lies in no known block")).cast("long")))
        .drop(*split, "__id", "__first", "__offset")
    )
    if offsets.agg(F.count(F.lit(1))).first()[0] and stored.count() != sizes.agg(F.sum("__n")).first()[0]:
        raise RuntimeError("rows were lost while numbering a file")
    return numbered


def read_corpus(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """JSON lines ``id, text, label`` (and stage columns) as documents.

    The schema is explicit, so ids stay strings; ``doc_idx`` is the row number
    in file order.
    """
    fields = list(CORPUS.fields) + [T.StructField(c, STAGE_COLUMNS[c]) for c in columns or []]
    raw = spark.read.schema(T.StructType(fields)).json(path)
    indexed = file_order(raw, "doc_idx")
    return indexed.select("doc_idx", *[f.name for f in fields])


def read_documents(spark: SparkSession, path: str, id_column: str, text_column: str = "text", label_column: str | None = None) -> DataFrame:
    """A parquet table whose integer id already orders the documents."""
    raw = spark.read.parquet(path)
    keep = [c for c in raw.columns if c not in (id_column, text_column)]
    label = F.col(label_column).cast("string") if label_column else F.lit(None).cast("string")
    named = raw.select(
        F.col(id_column).cast("long").alias("doc_idx"),
        F.col(id_column).cast("string").alias("id"),
        F.col(text_column).alias("text"),
        *keep,
    )
    if "label" not in keep:
        named = named.withColumn("label", label)
    return named


class StoredRanges:
    """Consecutive ranges of documents, each read from the files that hold it.

    The documents ahead are written to shared storage, a folder for every
    ``FOLDER`` numbers, in stretches that grow: a corpus of any layout is scanned
    a logarithmic number of times for any number of ranges, and a run that ends
    early has written little more than it used.
    """

    def __init__(self, docs: DataFrame):
        self.docs, self.size, self.upto = docs, RANGE, None

    def _store(self, low: int, high: int) -> None:
        spark = self.docs.sparkSession
        self.path, self.upto = scratch_path(spark, "ranges"), max(high, low + self.size)
        self.size *= RANGE_GROWTH
        files = min(spark.sparkContext.defaultParallelism, FILES)
        ahead = self.docs.filter((F.col("doc_idx") >= low) & (F.col("doc_idx") < self.upto))
        # dealt in turn, so that the files of a folder are equally long
        dealt = ahead.withColumn("folder", F.expr(f"doc_idx div {FOLDER}")).repartition(files)
        dealt.write.partitionBy("folder").parquet(self.path, compression="zstd")
        self.schema = dealt.schema

    def rows(self, low: int, high: int) -> DataFrame:
        """Documents ``low <= doc_idx < high``; calls come in ascending order."""
        if self.upto is None or high > self.upto:
            self._store(low, high)
        stored = self.docs.sparkSession.read.schema(self.schema).parquet(self.path)
        folders = F.col("folder").between(int(low / FOLDER), int((high - 1) / FOLDER))
        return stored.filter(folders & (F.col("doc_idx") >= low) & (F.col("doc_idx") < high)).drop("folder")


def write_documents(df: DataFrame, path: str) -> None:
    """Corpus and result columns as JSON lines, one part file per task, compressed by gzip; a rerun replaces them."""
    df.drop("doc_idx").write.mode("overwrite").option("zlib.compress.level", "BEST_SPEED").json(path, compression="gzip")


def sample_corpus(df: DataFrame, n: int, seed: int = 0, id_column: str = "doc_idx") -> DataFrame:
    """Exactly ``n`` documents without replacement, the same ones for a seed.

    Documents rank by the MD5 sum of id and seed, ties by id.  A histogram of
    its first four digits finds the bucket where the n-th document lies: lower
    buckets are kept whole by a narrow filter and only that one bucket, a
    65,536th of the corpus, is sorted.
    """
    digest = F.md5(F.concat_ws("-", F.col(id_column).cast("string"), F.lit(str(seed))))
    ranked = df.withColumn("__h", digest).withColumn("__b", F.substring("__h", 1, 4))
    sizes = ranked.groupBy("__b").agg(F.count(F.lit(1)).alias("size"))
    so_far = F.sum("size").over(W.orderBy("__b"))
    cuts = sizes.select("__b", "size", so_far.alias("upto"))
    edge = cuts.filter(F.col("upto") >= n).orderBy("__b").limit(1).first()
    if edge is None:
        raise ValueError(f"cannot sample {n} documents: the corpus is smaller")
    below = ranked.filter(F.col("__b") < edge["__b"])
    last = ranked.filter(F.col("__b") == edge["__b"]).orderBy("__h", id_column).limit(n - (edge["upto"] - edge["size"]))
    return below.unionByName(last).drop("__h", "__b")
