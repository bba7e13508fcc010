"""Schemas and fixed constants."""

from __future__ import annotations

from pyspark.sql import types as T

#: a stored document: three non-null strings
DOC_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("header_key", T.StringType(), False),
        T.StructField("text", T.StringType(), False),
    ]
)

#: a change record for upsert / delete-by-category feeds
CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("op", T.StringType(), False),  # 'upsert' | 'delete_header'
        T.StructField("id", T.StringType(), True),
        T.StructField("header_key", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)

# --- fixed values: BM25 parameters of the scoring the reference relies on ---
BM25_K1 = 1.2
BM25_B = 0.75
# ---------------------------------------------------------------------------

#: number of term buckets postings / term statistics are partitioned into on
#: disk; a query reads only the buckets of its terms
DEFAULT_BUCKETS = 64

#: largest edit distance a fuzzy clause accepts
MAX_FUZZY_DISTANCE = 2
