"""Vector similarity: cosine as columns, and exact neighbours in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of query vectors that one scan takes along, and queries that a task scores at once.
QUERY_BYTES, AT_ONCE = 16 << 20, 512


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, within [-1, 1]; 0 for unequal lengths and zero vectors."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    size = norm(a) * norm(b)
    return F.when((F.size(a) != F.size(b)) | (size == 0), 0.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / size)))


def nearest_vectors(vectors: DataFrame, every: int = 20, k: int = 1, block: int | None = None) -> DataFrame:
    """(query_id, vec_id, place, cosine): the ``k`` nearest other rows of each query row.

    Queries are all rows whose id is divisible by ``every``; a scan takes along
    ``block`` of them (as many as QUERY_BYTES hold) and each task reports its
    own best ``k`` for each, so the result is exact.  Null vectors are left out.
    """
    rows = vectors.select("vec_id", "embedding").where("vec_id is not null and embedding is not null")
    asked = rows.where(F.col("vec_id") % every == 0)
    schema = "query_id long, vec_id long, cosine double"
    if block is None:
        one = rows.select(F.size("embedding")).first()
        block = max(AT_ONCE, QUERY_BYTES // (8 * max(1, one[0]))) if one else AT_ONCE
    lower, parts = None, []
    while True:
        page = asked if lower is None else asked.where(F.col("vec_id") > lower)
        q = page.orderBy("vec_id").limit(block).collect()
        if not q:
            break
        ids, m = np.array([r[0] for r in q]), np.array([r[1] for r in q], np.float64)
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)

        def run(batches: Iterator[pa.RecordBatch], ids=ids, m=m) -> Iterator[pa.RecordBatch]:
            best_s = np.full((len(ids), k), -np.inf)
            best_i = np.full((len(ids), k), -1)
            for b in batches:
                v = np.array(b.column(1).to_pylist(), np.float64)
                if not len(v):
                    continue
                n = b.column(0).to_numpy()
                unit = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)).T
                for lo in range(0, len(ids), AT_ONCE):
                    part = slice(lo, lo + AT_ONCE)
                    s = m[part] @ unit
                    s[ids[part, None] == n[None, :]] = -np.inf
                    all_s, all_i = np.concatenate([best_s[part], s], 1), np.concatenate([best_i[part], np.broadcast_to(n, s.shape)], 1)
                    at = np.lexsort((all_i, -all_s), axis=1)[:, :k]
                    best_s[part], best_i[part] = np.take_along_axis(all_s, at, 1), np.take_along_axis(all_i, at, 1)
            ok = np.isfinite(best_s.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, k)[ok]), pa.array(best_i.ravel()[ok]), pa.array(best_s.ravel()[ok])], ["query_id", "vec_id", "cosine"])

        parts.append(rows.mapInArrow(run, schema))
        lower = int(ids[-1])
        if len(q) < block:
            break
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, place int, cosine double")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select("query_id", "vec_id", "place", F.round("cosine", 6).alias("cosine"))
