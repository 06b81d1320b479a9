"""Sharding by vector bin packing.

Documents with equal texts form a group, and a group has a vector: its bytes,
tokens and rows.  Groups are gathered into a fixed number of pieces by a hash
of the text, some pieces taking a sixteenth of the hash range of others, so
small pieces remain for the end.  A group of more than a 64th of a shard is a
piece of its own, and one that does not fit into a shard, by any measure, is
split into chunks by a hash of the document id; all of this is plain keyed
aggregation.  Only the pieces, a bounded number whatever the number of rows,
reach the driver.  There they are placed, largest first, each into the shard
whose residual capacity has the largest dot product with the piece; a last
pass moves pieces from the fullest to the emptiest shards while that brings
their bytes closer.  Rows then get their shard by a join with the piece table
and a gapless slot: the offset of their piece plus their number within it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weatherlake.llm.shared import cut, table

COARSE, FINE = 8192, 8192  # pieces of 15/16 and of 1/16 of the hash range
GRAIN = 64  # a group above one GRAIN-th of a shard, by any measure, is a piece of its own
CHUNKS = 16  # chunks per shard of a group that fits into none
OVERHEAD = 16


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every piece (pieces x measures).  The result depends on
    the order of equal pieces only."""
    capacity = np.maximum(vectors.sum(0) / shards, 1e-9)
    size = vectors / capacity
    left, out = np.ones((shards, size.shape[1])), np.zeros(len(size), int)
    for i in np.argsort(-size.max(1), kind="stable"):
        out[i] = int(np.argmax(left @ size[i]))
        left[out[i]] -= size[i]
    _level(vectors[:, 0], out, shards)
    return out


def _level(size: np.ndarray, shard: np.ndarray, shards: int) -> None:
    """Even out the first measure: move or swap pieces between the fullest and
    the emptiest shard as long as that narrows their gap."""
    load = np.bincount(shard, size, shards)
    for _ in range(50 * shards):
        high, low = int(load.argmax()), int(load.argmin())
        gap = load[high] - load[low]
        ours, theirs = np.flatnonzero(shard == high), np.flatnonzero(shard == low)
        if gap <= 1 or not len(ours):
            return
        # the best single move, and the best swap of two pieces
        gain, give, take = abs(gap - 2 * size[ours]), ours, np.full(len(ours), -1)
        if len(theirs):
            order = theirs[np.argsort(size[theirs], kind="stable")]
            at = np.clip(np.searchsorted(size[order], size[ours] - gap / 2), 0, len(order) - 1)
            for near in (at, np.maximum(at - 1, 0)):
                gain = np.append(gain, abs(gap - 2 * (size[ours] - size[order[near]])))
                give, take = np.append(give, ours), np.append(take, order[near])
        best = int(gain.argmin())
        if gain[best] >= gap:
            return
        moved = size[give[best]] - (size[take[best]] if take[best] >= 0 else 0)
        shard[give[best]] = low
        if take[best] >= 0:
            shard[take[best]] = high
        load[high] -= moved
        load[low] += moved


def shard_documents(docs: DataFrame, shards: int = 40, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard and slot of every row, with nearly equal bytes per shard, and
    tokens and rows balanced along with them.

    Columns: ``doc_id``, ``size`` (UTF-8 bytes of the text plus 16),
    ``text_crc32`` (0 for a null text), ``tokens`` (runs of other than white
    space), ``piece``, ``shard`` (0 to shards - 1), ``slot`` (gapless from 0
    in each shard).  Equal texts share a shard unless their group alone has more
    bytes, tokens or rows than a shard: then it is split by id.  Null texts are equal to
    each other; repeated rows are separate rows of one group; an empty table
    gives no rows; other columns are ignored.
    """
    t = F.col(text)
    rows = docs.select(
        F.col(id).cast("long").alias("doc_id"), (F.coalesce(F.octet_length(t), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.coalesce(F.crc32(t.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.size(F.split(F.trim(t), r"\s+")) - (F.trim(t) == "").cast("int"), F.lit(0)).cast("long").alias("tokens"),
        F.when(t.isNull(), F.lit(0)).otherwise(F.xxhash64(t)).alias("group"))
    rows = cut(rows)
    measures = ["size", "tokens", "rows"]
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    total = rows.agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).first()
    share = F.greatest(*[F.col(m) / F.lit(float(max(total[m] or 0, 1)) / (shards * GRAIN)) for m in measures])
    parts = F.when(share > GRAIN, F.ceil(share * CHUNKS / GRAIN)).otherwise(F.lit(1))
    # at most 3 * shards * GRAIN groups can be this large
    large = groups.filter(share > 1).select("group", parts.alias("parts"))

    spot = F.pmod("group", F.lit(16 * 65536))
    piece = F.when(F.col("parts").isNotNull(), F.lit(COARSE + FINE) + F.pmod(F.xxhash64("group"), F.lit(1 << 40)) * (1 << 20)
                   + F.pmod(F.xxhash64("doc_id", F.lit(5)), "parts")
                   ).when(F.pmod(spot, F.lit(16)) == 0, F.lit(COARSE) + F.pmod(F.xxhash64("group", F.lit(3)), F.lit(FINE))
                          ).otherwise(F.pmod(F.xxhash64("group", F.lit(4)), F.lit(COARSE)))
    rows = rows.join(F.broadcast(large), "group", "left").select("doc_id", "size", "text_crc32", "tokens", piece.alias("piece"))
    found = (rows.groupBy("piece").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
             .orderBy("piece").collect())  # at most COARSE + FINE + 3 * shards * (GRAIN + 2 * CHUNKS) rows
    shard = place(np.array([[r.size, r.tokens, r.rows] for r in found], float).reshape(-1, 3), shards)
    offset, used = [], [0] * shards
    for r, s in zip(found, shard.tolist(), strict=True):
        offset.append(used[s])
        used[s] += r.rows
    placed = docs.sparkSession.createDataFrame(
        [(r.piece, s, o) for r, s, o in zip(found, shard.tolist(), offset, strict=True)], "piece long, shard int, offset long")
    within = Window.partitionBy("piece").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("n", F.row_number().over(within)).join(F.broadcast(placed), "piece")
            .select("doc_id", "size", "text_crc32", "tokens", "piece", "shard", (F.col("offset") + F.col("n") - 1).alias("slot")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens")
