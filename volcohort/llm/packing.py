"""Optimal length buckets, then batches under a token budget.

Documents longer than MAX_LEN tokens are cut into pieces of MAX_LEN and a rest, so that every token is packed. A piece is
padded to the length of its bucket. Bucket boundaries minimise the padding of all pieces: dynamic programming over the
histogram of lengths, which has at most MAX_LEN entries however large the input. A batch of a bucket holds
floor(TOKEN_BUDGET / bucket length) pieces.

Nulls and empty texts have no tokens and no piece: one row with chunk null tells that. Repeated rows are packed each, a null
doc_id like any other. Boundaries that tie are those with the most lengths in the last bucket. An empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm.text import n_words, numbered, text_of

MAX_LEN = 2048
BUCKETS = 16
TOKEN_BUDGET = 65536


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> tuple[list[int], int]:
    """Upper bounds of at most `buckets` buckets with the least padding, and that padding."""
    if not lengths:
        return [], 0
    order = np.argsort(lengths)
    x, c = np.asarray(lengths, dtype=np.float64)[order], np.asarray(counts, dtype=np.float64)[order]
    n, k = len(x), min(buckets, len(x))
    cum, tokens = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(c * x)])
    best = np.full((k + 1, n + 1), np.inf)
    cut = np.zeros((k + 1, n + 1), dtype=np.int64)
    best[0, 0] = 0
    for b in range(1, k + 1):
        for j in range(b, n + 1):  # lengths i..j-1 share a bucket of length x[j-1]
            i = np.arange(b - 1, j)
            cost = best[b - 1, i] + x[j - 1] * (cum[j] - cum[i]) - (tokens[j] - tokens[i])
            at = int(np.argmin(cost))
            best[b, j], cut[b, j] = cost[at], i[at]
    bounds, j = [], n
    for b in range(k, 0, -1):
        bounds.append(int(x[j - 1]))
        j = int(cut[b, j])
    return bounds[::-1], int(best[k, n])


def pack(docs: DataFrame, buckets: int = BUCKETS, max_len: int = MAX_LEN, budget: int = TOKEN_BUDGET) -> DataFrame:
    """(doc_id, chunk, n_tokens, bucket, bucket_len, batch, slot): tokens are words; batch numbers run on across buckets."""
    sized = docs.select("doc_id", n_words(text_of()).alias("n"))
    full = F.floor(F.col("n") / max_len)
    # Whole pieces all have max_len tokens: they count by arithmetic, without a row for each.
    hist: dict[int, int] = {}
    found = sized.groupBy((F.col("n") % max_len).alias("rest")).agg(F.sum(full).alias("full"), F.count(F.lit(1)).alias("rows")).collect()
    for r in found:  # at most max_len rows
        hist[max_len] = hist.get(max_len, 0) + r["full"]
        if r["rest"]:
            hist[r["rest"]] = hist.get(r["rest"], 0) + r["rows"]
    hist = {k: v for k, v in hist.items() if v}
    bounds, _ = boundaries(list(hist), list(hist.values()), buckets)
    pieces = sized.withColumn("pieces", F.ceil(F.col("n") / max_len)).select(
        "doc_id", "n", F.explode_outer(F.expr("if(pieces > 0, sequence(0L, pieces - 1), null)")).alias("chunk")
    )
    tokens = F.when(F.col("chunk").isNotNull(), F.least(F.lit(max_len), F.col("n") - F.col("chunk") * max_len)).otherwise(0)
    pieces = pieces.withColumn("n_tokens", tokens.cast("long")).drop("n")
    bound = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    pieces = pieces.withColumn("bucket", F.when(F.col("n_tokens") > 0, F.size(F.filter(bound, lambda b: b < F.col("n_tokens")))))
    pieces = pieces.withColumn("bucket_len", F.get(bound, F.col("bucket")))
    placed = numbered(pieces, "bucket", ["doc_id", "chunk"], "_at")
    # Batches before a bucket follow from the histogram.
    first, starts = 0, []
    low = 0
    for b in bounds:
        starts.append(first)
        rows = sum(v for k, v in hist.items() if low < k <= b)
        first += -(-rows // max(1, budget // b))
        low = b
    start = F.array(*[F.lit(s).cast("long") for s in starts]) if starts else F.array().cast("array<bigint>")
    per = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("bucket_len")))
    return placed.select(
        "doc_id", "chunk", "n_tokens", F.col("bucket").cast("int").alias("bucket"), "bucket_len",
        (F.get(start, F.col("bucket")) + F.floor(F.col("_at") / per)).alias("batch"),
        F.when(F.col("bucket").isNotNull(), F.col("_at") % per).alias("slot"),
    )
