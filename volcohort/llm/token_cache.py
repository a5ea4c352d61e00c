"""Token counts with a digest cache.

A document's text is named by its SHA-256; a tokenizer by the SHA-256 of its file. Counts are looked up by both; each text
that isn't there yet is encoded once, by the document that has its smallest doc_id, and appended to the cache. The cache is
a Parquet table in a folder that all executors share; runs only add files to it.

Normalisation: none beyond null being the empty text, as counts must be those of the text as it is.

Nulls: a null text has no tokens; a null doc_id gets its row. Copies are encoded once. Very long texts are encoded whole,
a few at a time. An empty table gives no rows and adds nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm.storage import shared_dir, stage
from volcohort.llm.text import text_of

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CACHE_SCHEMA = "digest binary, version string, n_tokens long"
#: Bytes of text that are encoded in one call.
CALL_BYTES = 1 << 20
ARROW_ROWS = 2000
HOT = 1000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def version_of(name: str) -> str:
    with open(tokenizer_path(name), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def counter(name: str):
    """A function from texts to their numbers of tokens, as the library for the file gives them."""
    path = tokenizer_path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x.ids) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def _encoded(docs: DataFrame, name: str) -> DataFrame:
    """(digest, n_tokens) for rows of (digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(name)
        for b in batches:
            out, part, size = [], [], 0
            for t in b.column("text").to_pylist():
                part.append(t)
                size += len(t)
                if size >= CALL_BYTES:
                    out += count(part)
                    part, size = [], 0
            out += count(part) if part else []
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(out, pa.int64())], names=["digest", "n_tokens"])

    return docs.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def read_cache(spark, path: str) -> DataFrame:
    """The cache at `path`; an empty one if there is none yet."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def count_tokens(docs: DataFrame, name: str = TOKENIZER, cache: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of `docs`. cache: a folder, by default one of the shared folder."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    cache, version = cache or f"{shared_dir(spark)}/token-counts", version_of(name)
    held = docs.select("doc_id", text_of().alias("text"))
    held = held.withColumn("digest", F.unhex(F.sha2("text", 256)))
    stored = read_cache(spark, cache).where(F.col("version") == version).select("digest", "n_tokens").dropDuplicates(["digest"])
    # The document of each text that isn't stored; copies are gathered by digest, without their texts, and the texts are
    # then shuffled by document: a text with many copies brings one row.
    groups = stage(held.groupBy("digest").agg(F.min(F.struct("doc_id")).alias("f"), F.count(F.lit(1)).alias("n")), "token-digests")
    first = groups.join(stored, "digest", "left_anti").select(F.col("digest").alias("_d"), F.col("f.doc_id").alias("_id"))
    misses = held.join(first, (F.col("digest") == F.col("_d")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select("digest", "text")
    added = _encoded(misses, name).select("digest", F.lit(version).alias("version"), "n_tokens")
    added.write.mode("append").option("compression", "zstd").parquet(cache)
    counts = read_cache(spark, cache).where(F.col("version") == version).groupBy("digest").agg(F.first("n_tokens").alias("n_tokens"))
    # Texts with more than one in HOT of all rows, fewer than HOT of them, are looked up by broadcast; their rows then join
    # by keys of their own that match nothing, so no task gets all copies of a text.
    total = groups.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = groups.where(F.col("n") * HOT > total).select("digest").join(counts, "digest")
    hot = F.broadcast(hot.select(F.col("digest").alias("_hot"), F.col("n_tokens").alias("_n")))
    out = held.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    out = out.join(hot, F.col("digest") == F.col("_hot"), "left")
    key = F.when(F.col("_hot").isNull(), F.col("digest")).otherwise(F.concat("digest", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    out = out.withColumn("_key", key).join(counts.withColumnRenamed("digest", "_of"), F.col("_key") == F.col("_of"), "left")
    n = F.coalesce("_n", "n_tokens")
    return out.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > LIMIT).alias("over_limit"))
