"""Shards by vector bin packing: bytes, tokens and rows are balanced jointly.

Equal texts form a group, which stays together. Groups smaller than a cell, 1/GRAIN of a shard, are gathered into cells by
digest, a fixed number whatever the input; a larger group is placed by itself. Only a group that exceeds a shard's fair share of
bytes, tokens or rows is split, into pieces of a cell each, so that a text with a third of all rows spreads over the shards.
Cells, groups and pieces, a few for each cell whatever the input, largest first, each go where the dot product of their sizes
with the residual capacity is highest; ties go to the lower shard.

Nulls: a null text has no bytes and no tokens; it is a group like any other. A null doc_id is kept; within a group that is
split, rows of one doc_id go to one piece. Repeated rows each get a slot. Very long texts are measured whole; a text larger than
a shard's share is a shard's largest item. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm.storage import stage
from volcohort.llm.text import n_words, numbered, text_of

SHARDS = 40
#: Cells for each shard: a cell is about 1/256 of a shard.
GRAIN = 256
ROW_BYTES = 16


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each row of sizes (items x kinds), largest first, by the highest dot product with residual capacity."""
    total = items.sum(axis=0)
    unit = items / np.where(total > 0, total, 1)
    free = np.full((shards, items.shape[1]), 1 / shards)
    out = np.zeros(len(items), dtype=np.int64)
    for i in np.lexsort((np.arange(len(items)), -unit.max(axis=1))):
        out[i] = int(np.argmax(np.round(free @ unit[i], 12)))  # what differs by rounding alone ties
        free[out[i]] -= unit[i]
    return out


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of `docs`."""
    t = text_of()
    sized = docs.select(
        "doc_id", (F.octet_length(t) + ROW_BYTES).cast("long").alias("size"), F.crc32(t).alias("text_crc32"),
        n_words(t).alias("tokens"), F.xxhash64(t).alias("digest"),
    )
    sized = stage(sized, "shard-sizes")
    cells = shards * GRAIN
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = sized.agg(*sums).first()
    most, share = ([max(1, (total[k] or 0) // n) for k in ("size", "tokens", "rows")] for n in (cells, shards))
    group = ["digest", "text_crc32", "size"]
    # Only groups of more than one cell are returned: at most 3 * cells of them, since each kind adds up to the total.
    groups = sized.groupBy(*group).agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    times = lambda of: F.greatest(*[F.ceil(F.col(c) / m) for c, m in zip(("bytes", "tokens", "rows"), of, strict=True)])
    pieces = F.when(times(share) > 1, F.least(times(most), F.col("rows"))).otherwise(F.lit(1).cast("long"))
    large = groups.where(times(most) > 1).select(F.col("digest").alias("_d"), F.col("text_crc32").alias("_c"), F.col("size").alias("_s"), pieces.alias("_pieces"))
    large = F.broadcast(large)
    same = (F.col("digest") == F.col("_d")) & (F.col("text_crc32") == F.col("_c")) & (F.col("size") == F.col("_s"))
    piece = F.when(F.col("_d").isNotNull(), F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.col("_pieces"))).cast("long")
    celled = sized.join(large, same, "left").withColumn("_piece", piece)
    # A cell is named by a number, a piece by its group's digest and its own number.
    item = F.struct(
        F.when(F.col("_piece").isNull(), F.pmod("digest", F.lit(cells))).otherwise(F.col("digest")).alias("a"),
        F.coalesce("_piece", F.lit(-1).cast("long")).alias("b"),
    )
    celled = celled.withColumn("_item", item)
    found = celled.groupBy("_item").agg(*sums).orderBy("_item").collect()
    at = place(np.array([[r["size"], r["tokens"], r["rows"]] for r in found], dtype=np.float64).reshape(-1, 3), shards)
    where = [(r["_item"]["a"], r["_item"]["b"], int(s)) for r, s in zip(found, at, strict=True)]
    placed = F.broadcast(docs.sparkSession.createDataFrame(where, "_a long, _b long, shard int"))
    out = celled.join(placed, (F.col("_item.a") == F.col("_a")) & (F.col("_item.b") == F.col("_b")))
    return numbered(out.select("doc_id", "size", "text_crc32", "shard"), "shard", ["doc_id", "text_crc32"], "slot")
