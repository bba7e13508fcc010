"""BM25 scoring expressions (Robertson & Zaragoza 2009).

``idf(t) = ln(1 + (N - df + 0.5) / (df + 0.5))``
``tfnorm = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))``

N and avgdl are driver-side scalars of the snapshot (index metadata), so the
whole score is one codegen'd arithmetic expression per posting row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BM25_B, BM25_K1
from .indexing import CorpusStats


def idf(df: Column, stats: CorpusStats) -> Column:
    n = F.lit(float(stats.n_docs))
    d = df.cast("double")
    return F.log(F.lit(1.0) + (n - d + F.lit(0.5)) / (d + F.lit(0.5)))


def tf_norm(tf: Column, dl: Column, stats: CorpusStats) -> Column:
    avgdl = stats.avgdl if stats.avgdl > 0 else 1.0
    t = tf.cast("double")
    norm = F.lit(BM25_K1) * (
        F.lit(1.0 - BM25_B) + F.lit(BM25_B) * dl.cast("double") / F.lit(float(avgdl))
    )
    return t * F.lit(BM25_K1 + 1.0) / (t + norm)


def order_key() -> list[Column]:
    """Result order: score descending (compared after rounding to 9 digits,
    so float summation order can't flip a tie), then id, then doc_key."""
    return [F.round("score", 9).desc(), F.col("id").asc(), F.col("doc_key").asc()]
