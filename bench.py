"""Benchmark: the registered queries, by their registered names, plus the
build of the stored index and the write paths.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Timings are wall-clock seconds until every result row is made (``noop``
sink). The given tables are single-row-group files, so the session deals
their rows out to BENCH_CPUS partitions.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexispark.plans import workloads as W  # noqa: E402
from lexispark.session import fresh_path, local_session  # noqa: E402
from lexispark.sources.corpus import Corpus  # noqa: E402
from lexispark.sources.tables import PARTITIONS, documents_corpus  # noqa: E402

#: registered searches and tables; each is timed once on the stored index
QUERIES = [
    "token_counts",
    "token_table",
    "postings",
    "term_df",
    "corpus_stats",
    "bm25_search",
    "bm25_batch",
    "phrase_search",
    "phrase_top10",
    "search_facets",
    "facets",
    "fuzzy_search_d1",
    "fuzzy_search_d2",
    "fuzzy_top10",
    "fuzzy_batch",
    "bool_must",
    "bool_nested",
    "phrase_slop",
    "phrase_prefix",
    "match_all",
    "filtered_search",
    "conversation_search",
    "pages_search",
    "upsert",
    "change_feed",
]


def timed(fn) -> float:
    t0 = time.perf_counter()
    df = fn()
    if df is not None:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus, app="lexispark-bench")
    spark.conf.set(PARTITIONS, str(cpus))
    m = re.search(r"sf([0-9.]+)", sf_dir)

    res: dict[str, float] = {}
    res["build_index"] = timed(lambda: W.stored(spark, sf_dir) and None)
    for name in ("conversations", "pages"):
        W.stored(spark, sf_dir, name)  # built before the searches are timed
    for name in QUERIES:
        res[name] = timed(lambda: W.REGISTRY[name](spark, sf_dir))
    res["bm25_search_rerun"] = timed(lambda: W.bm25_search(spark, sf_dir))

    path = fresh_path(spark, "bench-corpus")
    corpus = Corpus(spark, path, create=True)
    corpus.rebuild(documents_corpus(spark, sf_dir))
    res["corpus_change_10_rows"] = timed(lambda: corpus.add_or_update([(str(i), "new", f"row {i}") for i in range(10)]))
    res["corpus_change_feed"] = timed(lambda: corpus.apply_changes(W.conversation_changes(spark, sf_dir)))
    res["search_after_changes"] = timed(lambda: corpus.search(W.BM25_QUERY, W.TOP_K))
    res["corpus_compact"] = timed(corpus.compact)

    out = {
        "metric": "total_sec",
        "value": round(sum(res.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in res.items()},
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
