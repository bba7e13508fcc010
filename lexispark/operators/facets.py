"""Search with facet counts by header_key.

The scored hits are computed once and feed both consumers: the top-k and
the facet count (``groupBy(header_key)``, partial aggregation map-side).
Every match counts. Only non-zero counts appear.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indexing import Index
from .search import _check_k, search_hits, top_k


class SearchResult(NamedTuple):
    results: DataFrame  # rank, id, score
    facets: DataFrame  # header_key, count
    hits: DataFrame | None = None  # the shared scored hits (persisted)

    def release(self) -> None:
        """Drop the cached hits once both outputs have been consumed."""
        if self.hits is not None:
            self.hits.unpersist()


def facet_counts(hits: DataFrame) -> DataFrame:
    """``query_id, header_key, count`` over all hits. The score is asked for
    too, so that the hits are the same plan as those of the top-k, and Spark
    makes them once where both are read by one query."""
    return hits.where(F.col("score").isNotNull()).groupBy("query_id", "header_key").agg(F.sum("copies").cast("long").alias("count"))


def search_with_facets(index: Index, query: str, k: int = 5, persist: bool = True) -> SearchResult:
    """E5: top-k results and facet counts of one query from one scoring.

    With ``persist`` the hits are kept (memory, spilling to disk) so the two
    outputs don't score twice when they are read one after the other;
    ``result.release()`` drops them when done. One query that reads both (a
    union) shares the hits' exchange without it."""
    _check_k(k)
    hits = search_hits(index, query)
    if persist:
        hits = hits.persist(StorageLevel.MEMORY_AND_DISK)
    res = top_k(hits.where(F.col("score").isNotNull()), k, one_query=True).select("rank", "id", "score")
    fac = facet_counts(hits).select("header_key", "count")
    return SearchResult(res, fac, hits if persist else None)
