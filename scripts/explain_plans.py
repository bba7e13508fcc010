"""Write PLANS.md: physical plans of the main searches on a stored index.

Usage: python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexispark.operators import fuzzy as FZ  # noqa: E402
from lexispark.operators import search as S  # noqa: E402
from lexispark.operators.indexing import postings_of, with_doc_key, with_terms  # noqa: E402
from lexispark.plans import query as Q  # noqa: E402
from lexispark.session import fresh_path, local_session  # noqa: E402
from lexispark.sources.corpus import Corpus  # noqa: E402
from lexispark.sources.tables import benchmark_queries, documents_corpus  # noqa: E402

KEEP = re.compile(
    r"(PartitionFilters|PushedFilters|ReadSchema|Exchange|Broadcast|WindowGroupLimit|HashAggregate|"
    r"ObjectHashAggregate|SortMergeJoin|BroadcastHashJoin|TakeOrdered|Generate|Window \(|Scan parquet)"
)


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    tree = text.split("\n\n")[0]
    details = [ln for ln in text.splitlines() if ln.startswith(("PartitionFilters", "PushedFilters", "ReadSchema"))]
    details = [ln if len(ln) < 300 else ln[:300] + " ..." for ln in details]
    return tree + "\n\n" + "\n".join(details)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    c = Corpus(spark, fresh_path(spark, "plans"), create=True)
    c.rebuild(documents_corpus(spark, sf_dir))
    idx = c.index()
    items = [
        ("BM25 top-10, one query (stored index)", S.search(idx, "the and anble", 10)),
        ("Phrase top-10 (stored index)", S.search_phrase(idx, "of the", 10)),
        ("Batch BM25: benchmark texts as queries", S.search_batch(idx, benchmark_queries(spark, sf_dir), 10)),
        ("Fuzzy d=2 top-10", FZ.search_fuzzy(idx, "thtion", 2, 10)),
        (
            "Bool: must the, should phrase, must_not header_key=de",
            Q.run(idx, Q.Bool(must=(Q.Match("the"),), should=(Q.Phrase("of the"),),
                              must_not=(Q.Field("header_key", "de"),)), 10),
        ),
        ("Index build: postings of a document table (no copies)",
         postings_of(with_terms(with_doc_key(documents_corpus(spark, sf_dir))), 64, copies_possible=False)),
    ]
    out = ["# Physical plans", "", f"Generated by `scripts/explain_plans.py` on `{sf_dir}` (local[8]).", ""]
    for title, df in items:
        out += [f"## {title}", "", "```", summary(plan_text(df)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
