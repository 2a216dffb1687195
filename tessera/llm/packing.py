"""Sharding by vector bin packing.

Documents with equal texts are a group. Each group is a vector (bytes, tokens, rows), measured in
shares of one shard's capacity, and goes to the shard where the dot product of the vector with the
residual capacity is highest, among those that have the bytes left for it if there are any; large
vectors go first. Bytes weigh most in the product, so that sizes end nearly equal even where a
group of short texts makes that impossible for rows.

The number of vectors placed is bounded whatever the input: groups that hold a ``1 / SMALL`` of a
shard's capacity or more in some measure (at most three times ``SMALL`` per shard) are placed
one by one, all smaller ones in ``CELLS`` cells per shard by the hash of their text. So a group is
never torn, except one that exceeds a whole shard in some measure: that is dealt out in pieces by
the hash of the document's id.

Results in special cases: a null text has size 1, like an empty one, but is another group; null
ids are allowed; repeated rows each get a slot of their own; ties go to the lower shard; an empty
table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import materialize

SHARDS = 16
SMALL, CELLS = 64, 256
#: Rows numbered together in one task, about.
NUMBERED = 20_000

_MEASURES = ("bytes", "tokens", "rows")
#: What each measure counts for in the dot product.
WEIGHTS = (8.0, 1.0, 1.0)


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item; a row of ``items`` holds shares of one shard's capacity."""
    residual = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), int)
    for i in np.lexsort((np.arange(len(items)), -items.max(axis=1, initial=0))):
        dot = residual @ (items[i] * WEIGHTS)
        fits = residual[:, 0] >= items[i, 0] - 1e-12
        out[i] = np.where(fits, dot, -np.inf).argmax() if fits.any() else dot.argmax()
        residual[out[i]] -= items[i]
    return out


def measured(documents: DataFrame, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, tokens, text_crc32, h): what placing needs of each row."""
    text = F.col(text_col).cast("string")
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint").alias("tokens"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )


def pack(documents: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, tokens, text_crc32, shard, slot): every row with its shard and a gapless number in it."""
    spark = documents.sparkSession
    rows = materialize(measured(documents, doc_id, text_col), "measured")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = rows.agg(*sums).first()
    capacity = {m: max(total[m] or 0, 1) / shards for m in _MEASURES}
    share = F.greatest(*(F.col(m) / F.lit(capacity[m]) for m in _MEASURES))

    # each group by itself or in a cell: at most 3 * SMALL * shards + CELLS * shards rows
    groups = rows.groupBy("h", "size").agg(*sums)
    large = share >= 1.0 / SMALL
    cell = F.pmod("h", F.lit(CELLS * shards))
    items = (
        groups.select(F.when(large, F.col("h")).otherwise(cell).alias("key"), F.when(large, F.col("size")).otherwise(F.lit(-1)).alias("of"), *_MEASURES)
        .groupBy("key", "of").agg(*(F.sum(m).alias(m) for m in _MEASURES)).orderBy("of", "key").collect()
    )
    vector = lambda r: [r[m] / capacity[m] for m in _MEASURES]
    pieces = {(r.key, r.of): int(np.ceil(2 * max(vector(r)))) for r in items if r.of >= 0 and max(vector(r)) > 1}
    known = spark.createDataFrame([(r.key, r.of, pieces.get((r.key, r.of), 1)) for r in items if r.of >= 0], "h bigint, size bigint, pieces int")
    keyed = rows.join(F.broadcast(known), ["h", "size"], "left").select(
        *rows.columns,
        F.when(F.col("pieces").isNull(), cell).otherwise(F.col("h")).alias("key"),
        F.when(F.col("pieces").isNull(), F.lit(-1)).otherwise(F.col("size")).cast("bigint").alias("of"),
        F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("doc_id"), F.col("pieces"))).otherwise(F.lit(0)).cast("int").alias("piece"),
    )
    if pieces:  # some 2 * 3 * shards pieces at most
        torn = keyed.join(F.broadcast(known.filter("pieces > 1").select("h", "size")), ["h", "size"]).groupBy("key", "of", "piece").agg(*sums).orderBy("of", "key", "piece").collect()
    else:
        torn = []
    placed = [(r.key, r.of, 0, vector(r)) for r in items if (r.key, r.of) not in pieces] + [(r.key, r.of, r.piece, vector(r)) for r in torn]
    shard = place(np.array([p[3] for p in placed]).reshape(-1, len(_MEASURES)), shards).tolist()
    plan = spark.createDataFrame([(*p[:3], s) for p, s in zip(placed, shard)], "key bigint, of bigint, piece int, shard int")
    dealt = keyed.join(F.broadcast(plan), ["key", "of", "piece"]).select("doc_id", "size", "tokens", "text_crc32", "shard", "h")
    return _numbered(dealt, total["rows"], shards)


def _numbered(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each shard, numbered in parts so that no task takes a whole shard."""
    parts = 16 + n // (shards * NUMBERED)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "h"), F.lit(parts)).cast("int"))
    sizes = rows.groupBy("shard", "part").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", "part", F.coalesce(before, F.lit(0)).alias("start"))
    at = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "h", "size"))
    return rows.withColumn("at", at).join(starts, ["shard", "part"]).select("doc_id", "size", "tokens", "text_crc32", "shard", (F.col("start") + F.col("at") - 1).alias("slot"))
