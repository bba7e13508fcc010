"""Corpus life cycle -- the reference's API as a Spark object.

``Corpus(spark, path)`` opens a durable corpus, ``create=True`` also makes an
empty one; ``Corpus(spark)`` is ephemeral (A2): the same tables in a scratch
folder under the shared ``spark.checkpoint.dir``, deleted on ``close()``.

A commit (A5) is a small immutable file ``_commits/N``: its parent, the parts
it consists of, the bucket count and analyzer, the corpus statistics and the
last batch of each stream. The highest N is current; commits are only ever
added. A writer claims N = parent + 1 by creating ``_commits/N.claim``, which
fails if another writer has, so of two writers with one parent the second
raises and no update is lost. A claim without a commit (its writer died)
stops later writers until ``recover()`` removes it. Parts without any commit
raise on opening. A search reads the commit that was current when it began.

A part holds the rows of one change: ``docs`` (by a hash of the id), ``doc_stats``, ``postings`` and ``term_stats`` (by a hash
of the term), ``variants`` of the terms (for fuzzy search), ``categories`` (which buckets of ``docs`` hold a category) and
``gone`` (ids and categories that the change removed), each under
``<table>/part=<name>``. ``_parts/<name>`` lists the part's files by bucket,
so a search opens the files of its own terms and lists no folder, and a
change opens the document files of its own ids and categories. ``docs`` has
as many buckets as the part's bytes need, so these files are of one size.

Rows and removals carry their place in the order of changes: ``seq`` of the
change feed and ``sub``, a count of the calls made at that point of the feed.
A row is alive unless a removal of its id or category has a higher place, so
a feed may arrive in any order, in any batches: a late change loses to what
came after it, as in a one-by-one replay. A change of the feed that arrives
again (same seq and id) changes nothing. Calls (``add_or_update``,
``remove_by_header``) happen now: after everything before them. A rebuild
begins a new history, older than any change.

A change writes rows in proportion to itself; ``term_stats`` holds the removed
documents' counts as negative rows (from their stored texts), so
frequencies are sums. ``compact()`` folds all parts into one, ``vacuum()``
deletes parts that no kept commit uses.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.packed import dealt as packed_to
from ..functions.tokenize import tokens
from ..operators import changes as C
from ..operators import facets as FC
from ..operators import fuzzy as FZ
from ..operators import search as S
from ..operators.indexing import (
    DOC_KEY_COLS,
    DOC_STATS_SCHEMA,
    DOCS_SCHEMA,
    ORDER,
    POSTINGS_SCHEMA,
    MOST_DELETED,
    TERM_STATS_SCHEMA,
    VARIANTS_SCHEMA,
    CorpusStats,
    Index,
    Tokenizer,
    folded,
    postings_of,
    term_bucket,
    term_rows,
    term_stats_of,
    variant_rows,
    with_terms,
)
from ..plans import query as Q
from ..schema import CHANGE_SCHEMA, DEFAULT_BUCKETS, DOC_SCHEMA
from ..session import create_text_file, delete_path, fresh_path, list_names, path_exists, publish, read_text_file, shared_dir

COMMITS, PARTS = "_commits", "_parts"
GONE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("header_key", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("sub", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
CATEGORIES_SCHEMA = T.StructType([T.StructField("header_key", T.StringType()), T.StructField("at", T.IntegerType())])
SCHEMAS = {
    "docs": DOCS_SCHEMA,
    "doc_stats": DOC_STATS_SCHEMA,
    "postings": POSTINGS_SCHEMA,
    "term_stats": TERM_STATS_SCHEMA,
    "variants": VARIANTS_SCHEMA,
    "categories": CATEGORIES_SCHEMA,
    "gone": GONE_SCHEMA,
}
#: the order inside each file
SORTED = {"docs": ["id"], "postings": ["term", "doc_key"], "term_stats": ["term"], "variants": ["variant"], "gone": ["id"]}
#: bytes of text in a bucket of ``docs``
DOC_BUCKET_BYTES = 64 << 20
#: bytes of text whose postings one task sorts and writes
POSTINGS_BYTES = 16 << 20
#: how tables are stored. Postings repeat their documents' keys: Parquet keeps a
#: column as codes only if that pays in the column's first page, and the keys fit
STORED_AS = {"compression": "zstd", "parquet.page.row.count.limit": 500_000, "parquet.dictionary.page.size": 8 << 20}
#: parts of the ids' hash range whose bytes are counted before a write
SLOTS = 4096
#: so many ids are written into the plan (and pushed to the scan); more are joined
MOST_LITERALS = 1000
#: the place of a rebuild's rows, before every change
BEFORE = (-1, 0)
#: a fixed text that an analyzer is tried on
PROBE = "The Quick-brown fox, it's 42! ÉCOLE straße 北京天气 カナ 한국 a\u3000b\t_x_ 𠀀𠀁"


class ConcurrentWrite(RuntimeError):
    """Another writer has claimed the next commit."""


def _empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOC_SCHEMA)


def _as_docs(spark: SparkSession, docs) -> DataFrame:
    """Accept a DataFrame ``(id, header_key, text)`` or a list of triples;
    nulls become empty strings (the schema is non-null)."""
    if isinstance(docs, DataFrame):
        return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("id", "header_key", "text")])
    return spark.createDataFrame([tuple("" if x is None else str(x) for x in d) for d in docs], DOC_SCHEMA)


def _placed(rows: DataFrame, seq: Column, sub: Column) -> DataFrame:
    return rows.withColumns({"seq": seq.cast("long"), "sub": sub.cast("long")})


def _sizes(docs: DataFrame) -> dict[int, int]:
    """Bytes of text by slot of the id's hash: SLOTS numbers at most."""
    by_slot = docs.groupBy(term_bucket(F.col("id"), SLOTS).alias("slot")).agg(F.sum(F.octet_length("text")).alias("n"))
    return {r.slot: r.n or 0 for r in by_slot.collect()}


#: what _parts says of the parts seen; parts don't change
_KNOWN_PARTS: dict[str, dict] = {}
_FINGERPRINTS: dict[tuple, str] = {}


def analyzer_fingerprint(spark: SparkSession, tokenizer: Tokenizer) -> str:
    """A hash of the analyzer's resolved expression on a fixed column (less
    the numbers that Spark gives to columns and variables) and of its tokens
    of a fixed text."""
    key = (spark.sparkContext.applicationId, tokenizer)
    if key not in _FINGERPRINTS:
        probe = spark.createDataFrame([(PROBE,)], "text string")
        tried = probe.select(tokenizer(F.col("text")).alias("tokens"))
        shown = re.sub(r"#\d+L?|(?<=[a-z])_\d+", "", tried._jdf.queryExecution().analyzed().toString().split("\n+- ")[0])
        _FINGERPRINTS[key] = hashlib.sha256(json.dumps([shown, tried.first().tokens]).encode()).hexdigest()
    return _FINGERPRINTS[key]


class Corpus:
    def __init__(
        self,
        spark: SparkSession,
        path: str | None = None,
        n_buckets: int | None = None,
        tokenizer: Tokenizer = tokens,
        create: bool = False,
        doc_bucket_bytes: int = DOC_BUCKET_BYTES,
    ):
        """``tokenizer`` (C10): the analyzer, a ``Column -> ARRAY<STRING>``
        expression for documents and queries. What is stored of it is a hash
        of its expression and of its tokens of a fixed text; opening with
        another one raises, as does another bucket count. ``doc_bucket_bytes``:
        text in one bucket of documents, the unit that a change opens."""
        self.spark = spark
        self.tokenizer = tokenizer
        self.doc_bucket_bytes = doc_bucket_bytes
        self.ephemeral = path is None
        self.path = (path or fresh_path(spark, "ephemeral")).rstrip("/")
        self._closed = False
        self.n_buckets = n_buckets or DEFAULT_BUCKETS
        number = self._last()
        if number is None:
            if path_exists(spark, f"{self.path}/docs"):
                raise RuntimeError(f"{self.path} holds parts but no commit")
            if not (create or self.ephemeral):
                raise FileNotFoundError(f"no corpus at {self.path}; create=True makes one")
            self._commit(None, [], CorpusStats(0, 0, 0.0), {}, BEFORE)
        else:
            known = self._read(number)
            if known["analyzer"] != self._analyzer():
                raise ValueError("the corpus was built with another analyzer: its expression or its tokens of a fixed text differ")
            if n_buckets not in (None, known["n_buckets"]):
                raise ValueError(f"the corpus has {known['n_buckets']} buckets, not {n_buckets}")
            self.n_buckets = known["n_buckets"]

    # ---- commits -------------------------------------------------------------

    def _analyzer(self) -> str:
        return analyzer_fingerprint(self.spark, self.tokenizer)

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in list_names(self.spark, f"{self.path}/{COMMITS}") if n.isdigit())

    def _last(self) -> int | None:
        return max(self._numbers(), default=None)

    def _read(self, number: int) -> dict:
        return json.loads(read_text_file(self.spark, f"{self.path}/{COMMITS}/{number}"))

    def _commit(self, parent: int | None, parts: list[str], stats: CorpusStats, streams: dict[str, int], last: tuple[int, int]) -> None:
        number, base = 0 if parent is None else parent + 1, f"{self.path}/{COMMITS}"
        body = {
            "parent": parent,
            "parts": parts,
            "n_buckets": self.n_buckets,
            "analyzer": self._analyzer(),
            "n_docs": stats.n_docs,
            "total_tokens": stats.total_tokens,
            "streams": streams,
            "last": list(last),
        }
        if not create_text_file(self.spark, f"{base}/{number}.claim", ""):
            raise ConcurrentWrite(f"commit {number} of {self.path} is claimed by another writer")
        ready = f"{base}/.{number}-{uuid.uuid4().hex[:8]}"
        create_text_file(self.spark, ready, json.dumps(body))
        publish(self.spark, ready, f"{base}/{number}")

    def recover(self) -> None:
        """Remove claims whose writers died before committing. Call it only
        when no writer is at work."""
        done = set(self._numbers())
        for name in list_names(self.spark, f"{self.path}/{COMMITS}"):
            if name.endswith(".claim") and int(name[:-6]) not in done:
                delete_path(self.spark, f"{self.path}/{COMMITS}/{name}")

    def current_version(self) -> int:
        return self._last()

    def last_batch_id(self, stream: str) -> int:
        """Last batch of a stream that was applied (G1); -1 if none."""
        return self._read(self._last())["streams"].get(stream, -1)

    # ---- parts ---------------------------------------------------------------

    def _new_part(self, parent: int) -> str:
        return f"{parent + 1:08d}-{uuid.uuid4().hex[:8]}"

    def _part(self, part: str) -> dict:
        """A part's ``doc_buckets`` and ``files``: table -> bucket -> paths."""
        key = f"{self.path}/{PARTS}/{part}"
        if key not in _KNOWN_PARTS:
            while len(_KNOWN_PARTS) >= 1000:
                _KNOWN_PARTS.pop(next(iter(_KNOWN_PARTS)))
            _KNOWN_PARTS[key] = json.loads(read_text_file(self.spark, key))
        return _KNOWN_PARTS[key]

    def _list_part(self, part: str, doc_buckets: int) -> None:
        """Write down the part's files, once."""
        files: dict[str, dict[str, list[str]]] = {}
        for name, schema in SCHEMAS.items():
            found: dict[str, list[str]] = {}
            for f in self.spark.read.schema(schema).parquet(f"{self.path}/{name}/part={part}").inputFiles():
                inner = f[f.index(f"part={part}/") + len(f"part={part}/") :]
                found.setdefault(inner.split("/")[0][7:] if "/" in inner else "", []).append(inner)
            files[name] = found
        create_text_file(self.spark, f"{self.path}/{PARTS}/{part}", json.dumps({"doc_buckets": doc_buckets, "files": files}))

    def _open(self, name: str, paths: list[str]) -> DataFrame:
        """The rows of some files of a table."""
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).option("basePath", f"{self.path}/{name}").parquet(*paths)

    def _paths(self, name: str, part: str, buckets: list[int] | None = None) -> list[str]:
        files = self._part(part)["files"][name]
        wanted = files if buckets is None else [str(b) for b in buckets if str(b) in files]
        return [f"{self.path}/{name}/part={part}/{f}" for b in wanted for f in files[b]]

    def _table(self, name: str, parts: list[str], buckets: list[int] | None = None) -> DataFrame:
        """A table in the given parts: the files of some buckets, by name, or
        the whole folders."""
        held = [p for p in parts if self._part(p)["files"][name]]
        if buckets is not None:
            return self._open(name, [f for p in held for f in self._paths(name, p, buckets)])
        return self._open(name, [f"{self.path}/{name}/part={p}" for p in held])

    def _alive(self, rows: DataFrame, parts: list[str]) -> DataFrame:
        """``rows`` (with id, header_key and their place) that are not removed."""
        gone = self._table("gone", parts)
        if any(self._part(p)["files"]["gone"] for p in parts):
            own = F.struct(*ORDER)
            for key in ("id", "header_key"):
                last = gone.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(own).alias("_last"))
                rows = rows.join(last, key, "left").where(F.col("_last").isNull() | (F.col("_last") <= own)).drop("_last")
        return rows

    def _frequencies(self, parts: list[str], buckets: list[int] | None = None) -> DataFrame:
        rows = self._table("term_stats", parts, buckets)
        if len(parts) > 1:
            sums = rows.groupBy("bucket", "term", "term_len").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
            rows = sums.where("df > 0")
        return rows.select(*TERM_STATS_SCHEMA.fieldNames())

    def _write(self, name: str, part: str, df: DataFrame, dealt: bool = False) -> None:
        """Write a part's table; one with buckets is first dealt out by them
        (unless it is) and sorted inside its files."""
        names = SCHEMAS[name].fieldNames()
        if "bucket" not in names:
            df.select(*names).write.mode("error").options(**STORED_AS).parquet(f"{self.path}/{name}/part={part}")
            return
        if not dealt:
            df = df.hint("rebalance", "bucket").sortWithinPartitions("bucket", *SORTED[name])
        df.select(*names).write.mode("error").options(**STORED_AS).partitionBy("bucket").parquet(f"{self.path}/{name}/part={part}")

    def _write_docs(self, part: str, docs: DataFrame, sizes: dict[int, int]) -> int:
        """Write the documents to their buckets, their tokens counted where they
        are written; ``sizes``: bytes of text by slot of the id's hash. A bucket
        of more than a piece of the whole (a hot id) is dealt to several
        tasks. Returns the number of buckets."""
        total = sum(sizes.values())
        n = 1 << max(0, (total - 1) // self.doc_bucket_bytes).bit_length()
        piece = max(total // 50_000, min(64 << 20, max(1 << 20, total // (3 * self.spark.sparkContext.defaultParallelism))))
        held = [0] * min(n, SLOTS)
        for slot, size in sizes.items():
            held[slot % len(held)] += size
        share = max(1, n // SLOTS)
        split = [max(1, -(-size // (piece * share))) for size in held]
        slot = F.pmod("bucket", F.lit(len(held))).cast("int") + 1
        salt = F.pmod(F.xxhash64("text", F.spark_partition_id()), F.element_at(F.lit(split), slot))
        # each piece in a partition of its own: by a hash, some would get several and others none
        first = F.element_at(F.lit([sum(split[:i]) for i in range(len(split))]), slot)
        piece_id = (F.floor(F.col("bucket") / len(held)) * sum(split) + first + F.col("_salt")).cast("int")
        out = docs.withColumns(
            {
                "doc_key": F.xxhash64("id", "header_key", "text"),
                "check": F.xxhash64(F.lit(1), F.col("text")),
                "bucket": term_bucket(F.col("id"), n),
            }
        )
        out = packed_to(out.withColumn("_salt", salt), sum(split) * share, piece_id).sortWithinPartitions("bucket", *SORTED["docs"])
        self._write("docs", part, out.withColumn("dl", F.size(self.tokenizer(F.col("text"))).cast("int")), dealt=True)
        return n

    def _write_postings(self, part: str, postings: DataFrame, total: int) -> None:
        """Write the postings of ``total`` bytes of text, dealt to tasks by
        their buckets: several buckets to a task, or, of a large part, each
        bucket to several. Every task gets about POSTINGS_BYTES of the text's."""
        n = max(1, total // POSTINGS_BYTES, min(3 * self.spark.sparkContext.defaultParallelism, total >> 20))
        to = F.floor(F.col("bucket") * n / self.n_buckets)
        if n > self.n_buckets:
            splits = -(-n // self.n_buckets)
            n = splits * self.n_buckets
            to = F.col("bucket") * splits + F.pmod(F.spark_partition_id(), F.lit(splits))
        rows = packed_to(postings, n, to, spread=True).sortWithinPartitions("bucket", *SORTED["postings"])
        self._write("postings", part, rows, dealt=True)

    def _write_part(self, part: str, docs: DataFrame, sizes: dict[int, int], removed: Callable[[], DataFrame] | None = None, gone: DataFrame | None = None) -> CorpusStats:
        """Write one part from its documents (id, header_key, text and their
        place). The texts are shuffled once, to their buckets; the other tables
        come from the stored documents, whose postings are made inside their
        rows. ``removed`` gives the postings (term, tf) of stored documents
        that go. Returns the part's own statistics."""
        doc_buckets = self._write_docs(part, docs, sizes)
        stored = self._open("docs", [f"{self.path}/docs/part={part}"])
        told = Observation()
        rows = stored.groupBy(*DOC_KEY_COLS, "dl", *ORDER).agg(
            F.count(F.lit(1)).cast("int").alias("copies"), F.min("check").alias("lo"), F.max("check").alias("hi")
        )
        rows = rows.observe(
            told,
            F.coalesce(F.sum("copies"), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.col("dl") * F.col("copies")), F.lit(0)).alias("tokens"),
            F.coalesce(F.max("copies"), F.lit(0)).alias("copies"),
            F.count(F.when(F.col("lo") != F.col("hi"), 1)).alias("clashes"),
        )
        with ThreadPoolExecutor(2) as pool:  # small tables beside the large ones
            gone = self.spark.createDataFrame([], GONE_SCHEMA) if gone is None else gone
            aside = [
                pool.submit(self._write, "categories", part, stored.select("header_key", F.col("bucket").alias("at")).distinct()),
                pool.submit(self._write, "gone", part, gone.withColumn("bucket", term_bucket(F.col("id"), doc_buckets))),
            ]
            self._write("doc_stats", part, rows)
            if told.get["clashes"]:
                raise RuntimeError("two different documents of one id have the same doc_key; nothing was committed")
            texts = stored.select(*DOC_KEY_COLS, *ORDER, "text")
            texts = with_terms(folded(texts) if told.get["copies"] > 1 else texts, self.tokenizer)
            self._write_postings(part, postings_of(texts, self.n_buckets, False, ORDER), sum(sizes.values()))
            terms = term_stats_of(self._open("postings", [f"{self.path}/postings/part={part}"]))
            if removed is not None:
                less = removed().groupBy(term_bucket(F.col("term"), self.n_buckets).alias("bucket"), "term").agg(
                    (-F.count(F.lit(1))).alias("df"), (-F.sum("tf")).alias("cf")
                )
                terms = terms.unionByName(less.withColumn("term_len", F.char_length("term").cast("int")))
            self._write("term_stats", part, terms)
            own = self._open("term_stats", [f"{self.path}/term_stats/part={part}"]).where("df > 0")
            self._write("variants", part, variant_rows(own, "term", MOST_DELETED, self.n_buckets))
            for x in aside:
                x.result()
        self._list_part(part, doc_buckets)
        return CorpusStats(int(told.get["n"]), int(told.get["tokens"]), 0.0)

    def index(self, version: int | None = None) -> Index:
        """Snapshot of a commit (default: the current one)."""
        self._check_open()
        known = self._read(self._last() if version is None else version)
        parts, n = known["parts"], known["n_docs"]
        shown = {
            "docs": [*DOC_KEY_COLS, "text"],
            "doc_stats": [*DOC_KEY_COLS, "dl", "copies"],
            "postings": ["bucket", "term", *DOC_KEY_COLS, "dl", "tf", "copies", "positions"],
        }

        def read(name: str, buckets: list[int] | None) -> DataFrame:
            if name == "term_stats":
                return self._frequencies(parts, buckets)
            if name == "variants":  # a term that is gone has no postings
                return self._table(name, parts, buckets)
            return self._alive(self._table(name, parts, buckets), parts).select(*shown[name])

        return Index(
            self.spark,
            read,
            known["n_buckets"],
            CorpusStats(n, known["total_tokens"], known["total_tokens"] / n if n else 0.0),
            closed=lambda: self._closed,
            tokenizer=self.tokenizer,
        )

    # ---- A1 / A4 / B1-B3 -----------------------------------------------------

    def rebuild(self, docs) -> None:
        """A1: replace every document (duplicate ids kept), commit once. What
        was changed before is forgotten, late changes too."""
        self._check_open()
        parent = self._last()
        part = self._new_part(parent)
        rows = _as_docs(self.spark, docs)
        stats = self._write_part(part, _placed(rows, F.lit(BEFORE[0]), F.lit(BEFORE[1])), _sizes(rows))
        self._commit(parent, [part], stats, self._read(parent)["streams"], BEFORE)

    def compact(self) -> None:
        """The same documents in a single part, with their places; of the
        removals, the last of each id and category."""
        self._check_open()
        parent = self._last()
        known = self._read(parent)
        docs = self._alive(self._table("docs", known["parts"]), known["parts"])
        gone = self._table("gone", known["parts"]).groupBy("id", "header_key").agg(F.max(F.struct(*ORDER)).alias("m"))
        part = self._new_part(parent)
        stats = self._write_part(part, docs.select("id", "header_key", "text", *ORDER), _sizes(docs), None, gone.select("id", "header_key", "m.seq", "m.sub"))
        self._commit(parent, [part], stats, known["streams"], tuple(known["last"]))

    def truncate(self) -> None:
        """A4: remove everything."""
        self._check_open()
        parent = self._last()
        self._commit(parent, [], CorpusStats(0, 0, 0.0), self._read(parent)["streams"], BEFORE)

    def vacuum(self, keep: int = 1) -> None:
        """Delete the parts that none of the last ``keep`` commits uses."""
        self._check_open()
        used = {p for n in self._numbers()[-keep:] for p in self._read(n)["parts"]}
        for name in SCHEMAS:
            for folder in list_names(self.spark, f"{self.path}/{name}"):
                if folder.startswith("part=") and folder[5:] not in used:
                    delete_path(self.spark, f"{self.path}/{name}/{folder}")

    def apply_changes(self, changes: DataFrame, stream: tuple[str, int] | None = None) -> None:
        """Apply ``changes(seq, op, id, header_key, text)`` of a feed as
        one commit; ``stream``: the (name, batch id) that they came with.
        Batches of a feed may come in any order."""
        self._apply(changes, stream, feed=True)

    def _apply(self, changes: DataFrame, stream: tuple[str, int] | None, feed: bool) -> None:
        self._check_open()
        parent = self._last()
        known = self._read(parent)
        parts = known["parts"]
        # the change set feeds several tables: written once, in the shared
        # folder; keys of a change set are non-null on entry (DOC_SCHEMA)
        shared_dir(self.spark)
        ch = changes.select(*[F.col(f.name).cast(f.dataType) for f in CHANGE_SCHEMA.fields]).checkpoint()
        size = ch.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.sum(F.octet_length("text")).alias("n_bytes")).first()
        last = tuple(known["last"])
        if size.hi is None:
            ch = _placed(ch, F.col("seq"), F.lit(0))
        elif feed:
            ch = _placed(ch, F.col("seq"), F.lit(0))
            last = max(last, (size.hi, 0))
        else:  # calls, in their own order, after all that was before
            ch = _placed(ch, F.lit(last[0]), F.col("seq") - size.lo + last[1] + 1)
            last = (last[0], last[1] + 1 + size.hi - size.lo)

        ups = ch.where("op = 'upsert'").groupBy("id").agg(F.max(F.struct(*ORDER, "header_key", "text")).alias("m"))
        ups = ups.select("id", F.struct("m.seq", "m.sub").alias("at"), "m.header_key", "m.text")
        dels = ch.where("op = 'delete_header'").groupBy("header_key").agg(F.max(F.struct(*ORDER)).alias("at"))
        gone = (
            ups.select("id", F.lit(None).cast("string").alias("header_key"), "at.*")
            .unionByName(dels.select(F.lit(None).cast("string").alias("id"), "header_key", "at.*"))
            .where(F.coalesce("id", "header_key").isNotNull())
        )

        # an upsert comes in unless something later has removed its category or id
        new = ups.join(dels.select("header_key", F.col("at").alias("_k")), "header_key", "left").where(F.col("_k").isNull() | (F.col("_k") <= F.col("at")))
        before = self._table("gone", parts)
        if any(self._part(p)["files"]["gone"] for p in parts):
            for key, older in (("id", F.col("_g") < F.col("at")), ("header_key", F.col("_g") <= F.col("at"))):
                known_gone = before.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*ORDER)).alias("_g"))
                new = new.join(known_gone, key, "left").where(F.col("_g").isNull() | older).drop("_g")
        new = new.select("id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("header_key", "text")], "at.*")

        # stored rows that go: their texts, written once
        path, told = fresh_path(self.spark, "removed"), Observation()
        own = F.struct(*ORDER)

        def find() -> None:
            rows = self._alive(self._touched(parts, ups, dels), parts)
            rows = rows.join(ups.select("id", F.col("at").alias("_u")), "id", "left").join(dels.select("header_key", F.col("at").alias("_k")), "header_key", "left")
            rows = rows.where((F.col("_u") > own) | (F.col("_k") > own))
            rows = rows.observe(told, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("tokens"))
            rows.select("text").write.parquet(path)

        def removed() -> DataFrame:
            found.result()
            rows = with_terms(self.spark.read.schema("text string").parquet(path), self.tokenizer)
            return term_rows(rows, []).select("term", F.size("positions").alias("tf"))

        part = self._new_part(parent)
        with ThreadPoolExecutor(1) as pool:  # while the new documents are written
            found = pool.submit(find)
            added = self._write_part(part, new, {0: size.n_bytes or 0}, removed, gone)
        stats = CorpusStats(known["n_docs"] + added.n_docs - int(told.get["n"]), known["total_tokens"] + added.total_tokens - int(told.get["tokens"]), 0.0)
        streams = {**known["streams"], **({stream[0]: stream[1]} if stream else {})}
        self._commit(parent, [*parts, part], stats, streams, last)

    def _touched(self, parts: list[str], ups: DataFrame, dels: DataFrame) -> DataFrame:
        """Stored documents, alive or not, among which are all of the ids and
        categories that a change names: opens their buckets only."""
        wanted: dict[str, set[int]] = {p: set() for p in parts if self._part(p)["files"]["docs"]}
        most = max((self._part(p)["doc_buckets"] for p in wanted), default=1)
        # bucket counts are powers of two, so a bucket of many tells that of fewer
        asked = ups.select("id", term_bucket(F.col("id"), most).alias("at"))
        some = asked.limit(MOST_LITERALS + 1).collect()
        ids = [r.id for r in some]
        found = {r.at for r in some} if len(ids) <= MOST_LITERALS else {r.at for r in asked.select("at").distinct().collect()}
        keys = [r.header_key for r in dels.select("header_key").limit(MOST_LITERALS + 1).collect()]
        for p in wanted:
            wanted[p] |= {at % self._part(p)["doc_buckets"] for at in found}
        if keys:
            at = self._table("categories", list(wanted)).withColumn("part", F.regexp_extract(F.input_file_name(), "part=([^/]+)/", 1))
            for r in at.join(dels, "header_key", "left_semi").select("part", "at").distinct().collect():  # buckets of documents
                wanted[r.part].add(r.at)
        rows = self._open("docs", [f for p, at in wanted.items() for f in self._paths("docs", p, sorted(at))])
        if len(ids) <= MOST_LITERALS and len(keys) <= MOST_LITERALS:
            rows = rows.where(F.col("id").isin(ids) | F.col("header_key").isin(keys))
        return rows.select("id", "header_key", "dl", *ORDER, "text")

    def add_or_update(self, docs) -> None:
        """B1: upsert by id; all stored rows with the id go, the latest new
        row comes. A list of triples is in call order. A DataFrame with
        repeated ids needs ``seq`` to tell which is the latest; it orders the
        rows of this call only."""
        if isinstance(docs, DataFrame):
            if "seq" not in docs.columns:
                if docs.groupBy("id").count().where("count > 1").limit(1).count():
                    raise ValueError("repeated ids need a seq column that orders them")
                docs = docs.withColumn("seq", F.lit(0).cast("long"))
            rows = docs.select("seq", "id", "header_key", "text")
        else:
            numbered = [(i, *("" if x is None else str(x) for x in d)) for i, d in enumerate(docs)]
            rows = self.spark.createDataFrame(numbered, "seq long, id string, header_key string, text string")
        self._apply(rows.select("seq", F.lit("upsert").alias("op"), "id", "header_key", "text"), None, feed=False)

    def remove_by_header(self, header_key: str) -> None:
        """B2: delete every document of a category (exact, case-sensitive)."""
        ch = self.spark.createDataFrame([(0, "delete_header", None, header_key, None)], CHANGE_SCHEMA)
        self._apply(ch, None, feed=False)

    # ---- E: searches on the current snapshot ---------------------------------

    def stats(self) -> CorpusStats:
        return self.index().stats()

    def search(self, query: str, top_k: int = 5) -> DataFrame:
        return S.search(self.index(), query, top_k)

    def search_phrase(self, phrase: str, top_k: int = 5) -> DataFrame:
        return S.search_phrase(self.index(), phrase, top_k)

    def search_fuzzy(self, query: str, distance: int = 1, top_k: int = 5) -> DataFrame:
        return FZ.search_fuzzy(self.index(), query, distance, top_k)

    def search_with_facets(self, query: str, top_k: int = 5) -> FC.SearchResult:
        return FC.search_with_facets(self.index(), query, top_k)

    def search_batch(self, queries: DataFrame, top_k: int = 5) -> DataFrame:
        return S.search_batch(self.index(), queries, top_k)

    def query(self, q: Q.Query, top_k: int | None = 10) -> DataFrame:
        return Q.run(self.index(), q, top_k)

    def documents(self) -> DataFrame:
        """Stored fields of the current snapshot."""
        return self.index().docs.select("id", "header_key", "text")

    # ---- A6 ------------------------------------------------------------------

    def close(self) -> None:
        """Later use raises, of this object and of its snapshots. An
        ephemeral corpus is deleted. Closing twice is fine."""
        if not self._closed:
            self._closed = True
            if self.ephemeral:
                delete_path(self.spark, self.path)

    def _check_open(self) -> None:
        if self._closed:
            raise RuntimeError("the corpus is closed")
