"""Derive the search tables ("the index") from a document DataFrame.

Tables (see README for the layout):

* ``docs``       doc_key, id, header_key, text            one row per stored document
* ``doc_stats``  doc_key, id, header_key, dl, copies      one row per distinct document
* ``postings``   bucket, term, doc_key, id, header_key, dl, tf, copies, positions
* ``term_stats`` bucket, term, df, cf, term_len
* corpus statistics N, total tokens, avgdl (three scalars, see ``CorpusStats``)

Identity of a document is ``(doc_key, id)`` with
``doc_key = xxhash64(id, header_key, text)``: reproducible on recomputation
and, because ``id`` takes part in every grouping and join, two different
documents only merge if both the id and the 64-bit hash agree.

Exact copies (same id, header_key and text) are indexed once and carry their
multiplicity in ``copies``: every copy yields identical posting rows, which a
hash aggregation keyed by the whole posting counts; a group of copies, however
large, never lands in one task -- partial aggregation collapses it map-side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import terms as terms_of
from ..functions.tokenize import tokens
from ..schema import DEFAULT_BUCKETS, MAX_FUZZY_DISTANCE

DOC_KEY_COLS = ["doc_key", "id", "header_key"]

#: when a row came: the ``seq`` of its change, and a count of the calls made
#: at that point of the feed
ORDER = ["seq", "sub"]
_ORDER_FIELDS = [T.StructField("seq", T.LongType()), T.StructField("sub", T.LongType())]
_KEY_FIELDS = [T.StructField("doc_key", T.LongType()), T.StructField("id", T.StringType()), T.StructField("header_key", T.StringType())]
TERMS_TYPE = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("positions", T.ArrayType(T.IntegerType()))]))

# stored schemas (explicit, so that an empty version reads back)
DOCS_SCHEMA = T.StructType(
    [
        *_KEY_FIELDS,
        T.StructField("text", T.StringType()),
        T.StructField("dl", T.IntegerType()),
        *_ORDER_FIELDS,
        T.StructField("check", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
DOC_STATS_SCHEMA = T.StructType(
    [*_KEY_FIELDS, T.StructField("dl", T.IntegerType()), T.StructField("copies", T.IntegerType()), *_ORDER_FIELDS]
)
POSTINGS_SCHEMA = T.StructType(
    [
        T.StructField("term", T.StringType()),
        *_KEY_FIELDS,
        T.StructField("dl", T.IntegerType()),
        T.StructField("tf", T.IntegerType()),
        T.StructField("copies", T.IntegerType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
        *_ORDER_FIELDS,
        T.StructField("bucket", T.IntegerType()),
    ]
)
TERM_STATS_SCHEMA = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("df", T.LongType()),
        T.StructField("cf", T.LongType()),
        T.StructField("term_len", T.IntegerType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)

VARIANTS_SCHEMA = T.StructType(
    [
        T.StructField("variant", T.LongType()),
        T.StructField("deleted", T.IntegerType()),
        T.StructField("prefix", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
#: characters of a term whose deletions are stored, and how many of them are
PREFIX = 7
MOST_DELETED = MAX_FUZZY_DISTANCE


def term_bucket(term, n_buckets: int):
    """Bucket of a term: ``pmod(xxhash64(term), n_buckets)`` (INT)."""
    return F.pmod(F.xxhash64(term), F.lit(n_buckets)).cast("int")


def with_doc_key(docs: DataFrame) -> DataFrame:
    """``docs(id, header_key, text)`` -> adds ``doc_key``."""
    return docs.select(
        F.xxhash64("id", "header_key", "text").alias("doc_key"), "id", "header_key", "text"
    )


#: a tokeniser: text column -> ARRAY<STRING> column (C10 plug-in point)
Tokenizer = Callable[[Column], Column]


def doc_stats_of(docs_keyed: DataFrame, tokenizer: Tokenizer = tokens) -> DataFrame:
    """D3: one row per distinct document, zero-token documents kept."""
    return (
        docs_keyed.select(*DOC_KEY_COLS, F.size(tokenizer(F.col("text"))).cast("int").alias("dl"))
        .groupBy(*DOC_KEY_COLS, "dl")
        .agg(F.count(F.lit(1)).cast("int").alias("copies"))
    )


def keyword_rows(index: Index) -> DataFrame:
    """``doc_key, id, header_key, copies`` for queries on the keyword fields
    and for match-all: from the stored statistics, or, where these are lazy,
    from the documents without tokenising them."""
    if index.lazy:
        return index.docs.groupBy(*DOC_KEY_COLS).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return index.doc_stats


def with_terms(docs: DataFrame, tokenizer: Tokenizer = tokens) -> DataFrame:
    """``docs`` with ``dl`` and ``terms`` in place of ``text``: the document's
    postings, computed inside its own row, without a shuffle. The tokens of
    the default analyzer are cut where they are grouped; those of another one
    are its expression's."""
    kept = [c for c in docs.columns if c not in ("text", "dl")]
    own = F.coalesce(F.col("text"), F.lit("")) if tokenizer is tokens else tokenizer(F.col("text"))
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("dl", T.IntegerType()), T.StructField("terms", TERMS_TYPE)])
    return docs.select(*kept, own.alias("_own")).mapInArrow(terms_of.postings, schema)


def folded(docs: DataFrame) -> DataFrame:
    """``docs`` with equal rows as one, and their number in ``copies``: the
    texts are shuffled (partial aggregation map-side), not their postings."""
    return docs.groupBy(*docs.columns).agg(F.count(F.lit(1)).cast("int").alias("copies"))


def term_rows(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, term, positions``: one row for each entry of ``terms``.

    explode_outer + an explicit filter: a plain explode lets Catalyst infer
    ``size(...) > 0`` and push it down to where the terms are made."""
    t = docs.select(*keys, F.explode_outer("terms").alias("p")).filter(F.col("p").isNotNull())
    return t.select(*keys, F.col("p.term").alias("term"), F.col("p.positions").alias("positions"))


def postings_by_token_rows(
    docs_keyed: DataFrame, n_buckets: int = DEFAULT_BUCKETS, tokenizer: Tokenizer = tokens
) -> DataFrame:
    """D1, the filter-friendly form for lazy (ephemeral) indexes: one row per
    token, then ``groupBy(term, document)``. A query's ``term IN (...)``
    filter lands right after the explode, so a search over raw documents
    aggregates only its own terms' tokens. Copies: every copy adds the same
    positions, so ``copies = rows / distinct positions``."""
    toks = docs_keyed.select(*DOC_KEY_COLS, tokenizer(F.col("text")).alias("toks"))
    rows = toks.select(
        *DOC_KEY_COLS,
        F.size("toks").cast("int").alias("dl"),
        F.posexplode_outer("toks").alias("pos", "term"),
    ).filter(F.col("term").isNotNull())
    agg = rows.groupBy("term", *DOC_KEY_COLS, "dl").agg(
        F.sort_array(F.collect_set(F.col("pos").cast("int"))).alias("positions"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return agg.select(
        term_bucket(F.col("term"), n_buckets).alias("bucket"),
        "term",
        *DOC_KEY_COLS,
        "dl",
        F.size("positions").cast("int").alias("tf"),
        (F.col("n_rows") / F.size("positions")).cast("int").alias("copies"),
        "positions",
    )


def postings_of(
    docs: DataFrame,
    n_buckets: int = DEFAULT_BUCKETS,
    copies_possible: bool = True,
    order: list[str] | None = None,
) -> DataFrame:
    """(term, document) postings with tf and sorted positions, from
    documents ``with_terms``.

    Exact copies of a document (same id, header_key, text) give identical
    rows; ``folded`` documents bring their ``copies``. Of others, with
    ``copies_possible``, the copies are folded into one row with their
    count by a hash aggregation keyed by the whole posting (partial map-side,
    so a hot group of copies never reaches one task whole). Without copies --
    known from ``doc_stats`` -- there is no shuffle here at all. ``order``:
    more columns of the documents to carry."""
    carried = [*DOC_KEY_COLS, "dl", *(order or [])]
    if "copies" in docs.columns:
        rows = term_rows(docs, [*carried, "copies"])
    elif copies_possible:
        rows = term_rows(docs, carried).groupBy("term", *carried, "positions").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    else:
        rows = term_rows(docs, carried).withColumn("copies", F.lit(1))
    return rows.select(
        term_bucket(F.col("term"), n_buckets).alias("bucket"),
        "term",
        *carried,
        F.size("positions").cast("int").alias("tf"),
        "copies",
        "positions",
    )


def term_stats_of(postings: DataFrame) -> DataFrame:
    """Document frequency (copies counted) and collection frequency."""
    return postings.groupBy("bucket", "term").agg(
        F.sum("copies").alias("df"),
        F.sum(F.col("tf") * F.col("copies")).alias("cf"),
    ).withColumn("term_len", F.char_length("term").cast("int"))


def prefix_of(term: Column) -> Column:
    return F.substring(term, 1, PREFIX)


def prefix_variants(p: Column, deletions: int) -> Column:
    """A prefix with up to ``deletions`` of its characters deleted, as an
    array of strings, each once for a number of deletions: every choice of
    places is spelled out, as a prefix has few (those beyond its end are
    null), so that nothing is called for each element of an array."""

    def less(*gone: int) -> Column:
        """The prefix without the characters at these places."""
        cuts = [-1, *gone, PREFIX]
        kept = [F.substring(p, lo + 2, hi - lo - 1) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True) if hi - lo > 1]
        return F.when(F.char_length(p) > gone[-1], F.concat(*kept))

    found = [F.array(p)]
    found += [F.array_distinct(F.array(*[less(*gone) for gone in combinations(range(PREFIX), k)])) for k in range(1, deletions + 1)]
    return F.flatten(F.array(*found))


def variant_rows(terms: DataFrame, term: str, deletions: int, n_buckets: int) -> DataFrame:
    """``bucket, variant, deleted, prefix``: the variants of the terms'
    distinct prefixes, which fuzzy search joins by equality."""
    # so many partitions, not as few as the prefixes' bytes would make: the
    # work is in what comes of them
    spark = terms.sparkSession
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    rows = terms.select(prefix_of(F.col(term)).alias("prefix")).repartition(n, "prefix").distinct()
    # explode_outer + an explicit filter, see ``term_rows``
    rows = rows.select("prefix", F.explode_outer(prefix_variants(F.col("prefix"), deletions)).alias("v")).where(F.col("v").isNotNull())
    rows = rows.select("prefix", (F.char_length("prefix") - F.char_length("v")).cast("int").alias("deleted"), F.xxhash64("v").alias("variant"))
    return rows.select(F.pmod("variant", F.lit(n_buckets)).cast("int").alias("bucket"), "variant", "deleted", "prefix")


def corpus_stats_df(doc_stats: DataFrame) -> DataFrame:
    """One row ``n_docs, total_tokens, avgdl``."""
    return doc_stats.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("n_docs"),
        F.coalesce(F.sum(F.col("dl") * F.col("copies")), F.lit(0)).cast("long").alias("total_tokens"),
    ).select(
        "n_docs",
        "total_tokens",
        F.when(F.col("n_docs") > 0, F.col("total_tokens") / F.col("n_docs"))
        .otherwise(F.lit(0.0))
        .alias("avgdl"),
    )


@dataclass(frozen=True)
class CorpusStats:
    n_docs: int
    total_tokens: int
    avgdl: float


class Index:
    """The derived tables of one corpus snapshot.

    ``read(name, buckets)`` gives a table, or only its rows of some term
    buckets: a plan over the documents (ephemeral) or a scan of the files of
    these buckets (stored). A table is opened when it is first used."""

    def __init__(
        self,
        spark: SparkSession,
        read: Callable[[str, list[int] | None], DataFrame],
        n_buckets: int = DEFAULT_BUCKETS,
        stats_row: CorpusStats | None = None,
        lazy: bool = False,
        closed: Callable[[], bool] = lambda: False,
        tokenizer: Tokenizer = tokens,
    ):
        self.spark = spark
        self._read = read
        self._tables: dict[str, DataFrame] = {}
        self.n_buckets = n_buckets
        self.stats_row = stats_row
        #: the tables are plans over the documents, not stored
        self.lazy = lazy
        #: set by the corpus that made this snapshot: is it closed?
        self.closed = closed
        #: the analyzer of this corpus; queries are tokenised with the same one
        self.tokenizer = tokenizer

    def table(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        if buckets is not None:
            return self._read(name, buckets)
        if name not in self._tables:
            self._tables[name] = self._read(name, None)
        return self._tables[name]

    @property
    def docs(self) -> DataFrame:
        return self.table("docs")

    @property
    def doc_stats(self) -> DataFrame:
        return self.table("doc_stats")

    @property
    def postings(self) -> DataFrame:
        return self.table("postings")

    @property
    def term_stats(self) -> DataFrame:
        return self.table("term_stats")

    def stats(self) -> CorpusStats:
        """Corpus statistics as driver-side scalars (index metadata; one
        aggregate row)."""
        if self.stats_row is None:
            r = corpus_stats_df(self.doc_stats).first()
            self.stats_row = CorpusStats(int(r.n_docs), int(r.total_tokens), float(r.avgdl))
        return self.stats_row

    def check_open(self) -> None:
        if self.closed():
            raise RuntimeError("the corpus is closed")


def build_index(docs: DataFrame, n_buckets: int = DEFAULT_BUCKETS, tokenizer: Tokenizer = tokens) -> Index:
    """Ephemeral index (A2): lazy plans over ``docs(id, header_key, text)``.
    All postings come from folded documents, those of some buckets from their
    tokens' rows."""
    keyed = with_doc_key(docs.select("id", "header_key", "text"))
    some = postings_by_token_rows(keyed, n_buckets, tokenizer)
    some = {"postings": some, "term_stats": term_stats_of(some)}
    postings = postings_of(with_terms(folded(keyed), tokenizer), n_buckets)
    tables = {"docs": keyed, "doc_stats": doc_stats_of(keyed, tokenizer), "postings": postings, "term_stats": term_stats_of(postings)}
    tables["variants"] = variant_rows(tables["term_stats"], "term", MOST_DELETED, n_buckets)

    def read(name: str, buckets: list[int] | None) -> DataFrame:
        return tables[name] if buckets is None else some.get(name, tables[name]).where(F.col("bucket").isin(buckets))

    return Index(docs.sparkSession, read, n_buckets, lazy=True, tokenizer=tokenizer)
