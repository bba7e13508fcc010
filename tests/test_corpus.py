"""Life cycle, commits, incremental parts, streams."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lexispark.functions.tokenize import lowercase_tokens
from lexispark.operators import changes as C
from lexispark.operators import search as S
from lexispark.operators.indexing import build_index
from lexispark.session import delete_path, fresh_path, list_names, shared_dir
from lexispark.sources.corpus import ConcurrentWrite, Corpus, analyzer_fingerprint
from lexispark.streaming.maintain import change_stream, maintain

from .conftest import ids

BOOKS = [("b1", "sea", "whale ship storm"), ("b2", "sea", "island ship"), ("b3", "moor", "storm heath house")]


@pytest.fixture()
def books(spark):
    c = Corpus(spark, fresh_path(spark, "corpus"), create=True)
    c.rebuild(BOOKS)
    return c


def stored(c):
    return sorted(tuple(r) for r in c.documents().collect())


def same_as_fresh(spark, c, queries=("ship", "storm house", "whale")):
    """The corpus answers as one built from its documents does."""
    fresh = build_index(c.documents())
    assert c.stats().n_docs == fresh.stats().n_docs and c.stats().total_tokens == fresh.stats().total_tokens
    for q in queries:
        got = [(r.id, pytest.approx(r.score, abs=1e-9)) for r in c.search(q, 10).collect()]
        assert got == [(r.id, r.score) for r in S.search(fresh, q, 10).collect()]
    key = lambda r: (r.term, r.df, r.cf)
    assert sorted(map(key, c.index().term_stats.collect())) == sorted(map(key, fresh.term_stats.collect()))


def test_rebuild_and_reopen(spark, books):
    again = Corpus(spark, books.path)
    assert stored(again) == sorted(BOOKS) and ids(again.search("whale", 5)) == ["b1"]
    again.rebuild([("n", "x", "nothing else")])
    assert ids(books.search("whale", 5)) == [] and ids(books.search("nothing", 5)) == ["n"]
    books.truncate()
    assert books.stats().n_docs == 0 and ids(books.search("nothing", 5)) == []


def test_opening_needs_a_corpus_or_create(spark, books):
    with pytest.raises(FileNotFoundError):
        Corpus(spark, fresh_path(spark, "missing"))
    delete_path(spark, f"{books.path}/_commits")
    with pytest.raises(RuntimeError):  # parts without a commit are no empty corpus
        Corpus(spark, books.path, create=True)


def test_bucket_count_and_analyzer_are_stored(spark):
    path = fresh_path(spark, "corpus")
    Corpus(spark, path, n_buckets=5, tokenizer=lowercase_tokens, create=True).rebuild([("1", "k", "Quiet HARBOUR")])
    c = Corpus(spark, path, tokenizer=lowercase_tokens)
    assert c.n_buckets == 5 and ids(c.search("harbour", 5)) == ["1"]
    with pytest.raises(ValueError):
        Corpus(spark, path)
    with pytest.raises(ValueError):
        Corpus(spark, path, n_buckets=6, tokenizer=lowercase_tokens)


def test_second_writer_raises(spark, books, monkeypatch):
    other = Corpus(spark, books.path)
    parent = other.current_version()
    books.add_or_update([("b4", "sea", "reef")])
    monkeypatch.setattr(other, "_last", lambda: parent)  # it began before the commit
    with pytest.raises(ConcurrentWrite):
        other.add_or_update([("b5", "sea", "cove")])
    assert ids(Corpus(spark, books.path).search("reef cove", 5)) == ["b4"]


def test_writer_that_died_before_its_commit(spark, books, monkeypatch):
    def die(*a):
        raise OSError("lost")

    monkeypatch.setattr("lexispark.sources.corpus.publish", die)
    with pytest.raises(OSError):
        books.add_or_update([("b4", "sea", "reef")])
    monkeypatch.undo()
    assert stored(books) == sorted(BOOKS)  # readers see the last commit
    with pytest.raises(ConcurrentWrite):
        books.add_or_update([("b4", "sea", "reef")])
    books.recover()
    books.add_or_update([("b4", "sea", "reef")])
    assert ids(books.search("reef", 5)) == ["b4"]


def test_upsert_keeps_the_last_call(spark, books):
    books.add_or_update([("b2", "sea", "zebra first"), ("b9", "new", "comet"), ("b2", "sea", "aloe last")])
    assert ids(books.search("aloe", 5)) == ["b2"] and ids(books.search("zebra island", 5)) == []
    same_as_fresh(spark, books, ("ship", "aloe comet"))
    twice = spark.createDataFrame([("x", "k", "a"), ("x", "k", "b")], "id string, header_key string, text string")
    with pytest.raises(ValueError):
        books.add_or_update(twice)
    books.add_or_update(twice.withColumn("seq", F.when(F.col("text") == "a", 2).otherwise(1).cast("long")))
    assert ids(books.search("a", 5)) == ["x"]


def test_delete_by_category(spark, books):
    books.remove_by_header("sea")
    assert [d[0] for d in stored(books)] == ["b3"]
    books.remove_by_header("none such")
    books.add_or_update([("b7", "sea", "ship again")])  # a later part may use the category again
    assert ids(books.search("ship", 5)) == ["b7"]
    same_as_fresh(spark, books)
    rows = spark.createDataFrame([("1", "a", "x"), ("2", None, "y")], "id string, header_key string, text string")
    assert [r.id for r in C.delete_by_header(rows, ["a"]).collect()] == ["2"]  # no category, not deleted


def test_changes_write_rows_in_proportion(spark, books):
    books.add_or_update([("b2", "sea", "tiny")])
    parts = sorted(n for n in list_names(spark, f"{books.path}/docs") if n.startswith("part="))
    assert spark.read.parquet(f"{books.path}/docs/{parts[-1]}").count() == 1
    assert spark.read.parquet(f"{books.path}/postings/{parts[-1]}").count() == 1


def test_snapshots_compaction_and_vacuum(spark, books):
    first = books.current_version()
    books.add_or_update([("b1", "sea", "calm")])
    books.remove_by_header("moor")
    before = stored(books)
    assert ids(S.search(books.index(first), "whale", 5)) == ["b1"]
    books.compact()
    assert stored(books) == before
    same_as_fresh(spark, books, ("calm ship",))
    books.vacuum()
    assert len([n for n in list_names(spark, f"{books.path}/docs") if n.startswith("part=")]) == 1
    assert stored(books) == before


def test_ephemeral_corpus_and_close(spark):
    c = Corpus(spark)
    assert c.stats().n_docs == 0 and ids(c.search("x", 5)) == []
    c.rebuild(BOOKS)
    c.add_or_update([("b1", "sea", "gull")])
    assert ids(c.search("gull", 5)) == ["b1"]
    held = c.index()
    c.close()
    c.close()
    for call in (lambda: c.search("gull", 5), lambda: c.rebuild([]), lambda: S.search(held, "gull", 5)):
        with pytest.raises(RuntimeError):
            call()


def test_repeated_ids_and_copies_are_documents(spark):
    c = Corpus(spark)
    c.rebuild([("d", "k", "moss fern"), ("d", "k", "moss fern"), ("d", "k", "moss"), ("e", "k", "fern")])
    assert c.stats().n_docs == 4
    same_as_fresh(spark, c, ("moss", "fern moss"))
    c.add_or_update([("d", "k", "lichen")])
    assert stored(c) == [("d", "k", "lichen"), ("e", "k", "fern")]
    same_as_fresh(spark, c, ("moss", "fern lichen"))


CHANGE = "seq long, op string, id string, header_key string, text string"


def replay(docs, changes):
    docs = list(docs)
    for _, op, i, h, t in sorted(changes):
        docs = [d for d in docs if (d[0] != i if op == "upsert" else d[1] != h)]
        if op == "upsert":
            docs.append((i, h, t))
    return sorted(docs)


def test_change_feed_is_the_replay(spark, books):
    feed = [
        (1, "upsert", "b1", "moor", "heather"),
        (2, "delete_header", None, "moor", None),
        (3, "upsert", "b6", "moor", "peat"),
        (4, "upsert", "b2", "fen", "reed"),
        (5, "upsert", "b2", "fen", "sedge"),
    ]
    books.apply_changes(spark.createDataFrame(feed[:3], CHANGE))
    books.apply_changes(spark.createDataFrame(feed[3:], CHANGE))
    assert stored(books) == replay(BOOKS, [(s, o, i or "", h, t or "") for s, o, i, h, t in feed])
    same_as_fresh(spark, books, ("peat sedge", "ship"))


def random_feed(rng, n):
    out = []
    for seq in range(n):
        if rng.random() < 0.2:
            out.append((seq, "delete_header", None, rng.choice(["sea", "moor", "fen"]), None))
        else:
            out.append((seq, "upsert", f"b{rng.randint(1, 6)}", rng.choice(["sea", "moor", "fen"]), f"ship word{seq}"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_feed_in_any_order_is_the_replay(spark, seed):
    rng = random.Random(seed)
    c = Corpus(spark, fresh_path(spark, "corpus"), create=True, doc_bucket_bytes=16)
    c.rebuild(BOOKS)
    feed = random_feed(rng, 24)
    late = feed[:]
    rng.shuffle(late)
    for i in range(0, len(late), 6):
        c.apply_changes(spark.createDataFrame(late[i : i + 6], CHANGE))
        if i == 6:
            c.compact()
        if i == 12:
            c.apply_changes(spark.createDataFrame(late[6:12], CHANGE))  # redelivered
    want = replay(BOOKS, [(s, o, i or "", h, t or "") for s, o, i, h, t in feed])
    assert stored(c) == want
    same_as_fresh(spark, c, ("ship",))


def test_late_change_loses_and_calls_happen_now(spark, books):
    books.apply_changes(spark.createDataFrame([(10, "upsert", "b1", "sea", "ten")], CHANGE))
    books.apply_changes(spark.createDataFrame([(5, "upsert", "b1", "sea", "five"), (4, "upsert", "b8", "sea", "four")], CHANGE))
    assert ids(books.search("five", 5)) == [] and ids(books.search("ten", 5)) == ["b1"]
    books.add_or_update([("b1", "sea", "called")])  # after seq 10, before seq 11
    books.apply_changes(spark.createDataFrame([(9, "upsert", "b1", "sea", "nine")], CHANGE))
    assert ids(books.search("called", 5)) == ["b1"] and ids(books.search("nine ten", 5)) == []
    books.remove_by_header("sea")
    books.apply_changes(spark.createDataFrame([(8, "upsert", "b7", "sea", "eight"), (11, "upsert", "b1", "sea", "eleven")], CHANGE))
    assert [d[0] for d in stored(books)] == ["b1", "b3"] and ids(books.search("eleven", 5)) == ["b1"]
    books.rebuild(BOOKS)  # a new history
    books.apply_changes(spark.createDataFrame([(0, "upsert", "b1", "sea", "zero")], CHANGE))
    assert ids(books.search("zero", 5)) == ["b1"]
    same_as_fresh(spark, books)


def test_change_opens_the_files_of_its_own_documents(spark):
    """Ten rows read as many document bytes of a corpus ten times as large."""
    read = {}
    for n in (300, 3000):
        c = Corpus(spark, fresh_path(spark, "corpus"), create=True, doc_bucket_bytes=1024)
        c.rebuild(spark.range(n).selectExpr("cast(id as string) id", "concat('k', id % 100) header_key", "repeat(concat('word', id, ' '), 8) text"))
        parts = c._read(c._last())["parts"]
        ups = spark.createDataFrame([(str(i),) for i in range(0, 30, 3)], "id string")
        none = spark.createDataFrame([], "header_key string")
        files = c._touched(parts, ups, none).inputFiles()
        assert len(files) <= 10 < len(c._paths("docs", parts[0]))
        read[n] = sum(os.path.getsize(f.removeprefix("file://")) for f in files)
        by_key = c._touched(parts, ups.limit(0), spark.createDataFrame([("no such",)], "header_key string"))
        assert by_key.count() == 0 and not by_key.inputFiles()
        c.add_or_update([(str(i), "new", "fresh text") for i in range(0, 30, 3)])
        assert c.stats().n_docs == n and c.documents().where("header_key = 'new'").count() == 10
    assert read[3000] < 1.5 * read[300]


def test_search_opens_the_files_of_its_own_buckets(spark):
    c = Corpus(spark, fresh_path(spark, "corpus"), n_buckets=128, create=True)
    c.rebuild(spark.range(400).selectExpr("cast(id as string) id", "'k' header_key", "concat_ws(' ', 'ship', concat('w', id), concat('v', id % 7)) text"))
    for i in range(3):
        c.add_or_update([(f"n{i}", "k", f"ship extra{i}")])
    index = c.index()
    opened = []
    c._open = lambda name, paths, f=c._open: opened.extend(paths) or f(name, paths)
    assert ids(S.search(index, "extra1 w7", 5)) == ["n1", "7"]
    mine = [p for p in opened if "/gone/" not in p]
    assert mine and all(p.endswith(".parquet") and "/bucket=" in p for p in mine)
    assert len({p.split("/bucket=")[1].split("/")[0] for p in mine}) == 2
    for name in ("postings", "term_stats", "docs"):
        assert sorted(os.path.basename(p) for part in c._read(c._last())["parts"] for p in c._paths(name, part)) == sorted(
            os.path.basename(f) for f in c._table(name, c._read(c._last())["parts"]).inputFiles()
        )


def test_another_analyzer_of_the_same_name_raises(spark):
    path = fresh_path(spark, "corpus")
    Corpus(spark, path, tokenizer=lambda c: F.split(c, " "), create=True).rebuild([("1", "k", "Calm Sea")])
    assert ids(Corpus(spark, path, tokenizer=lambda c: F.split(c, " ")).search("Calm", 5)) == ["1"]
    for other in (lambda c: F.split(F.lower(c), " "), lambda c: F.split(c, "-"), lowercase_tokens):
        with pytest.raises(ValueError):
            Corpus(spark, path, tokenizer=other)
    steps = lambda c: F.transform(F.split(c, " "), lambda x: F.upper(x))
    assert analyzer_fingerprint(spark, steps) == analyzer_fingerprint(spark, lambda c: F.transform(F.split(c, " "), lambda x: F.upper(x)))


def test_streams_are_applied_once_each(spark, books):
    base = fresh_path(spark, "stream")

    def arrive(name, seq, doc):
        spark.createDataFrame([(seq, "upsert", doc, "s", f"word{doc}")], CHANGE).write.mode("append").parquet(f"{base}/{name}")
        maintain(books, change_stream(spark, f"{base}/{name}"), f"{base}/ck-{name}").awaitTermination()

    arrive("one", 1, "x1")
    arrive("one", 2, "x2")
    n = books.current_version()
    arrive("two", 1, "y1")  # another stream: its batch 0 is new
    assert books.current_version() == n + 1
    assert sorted(d[0] for d in stored(books)) == ["b1", "b2", "b3", "x1", "x2", "y1"]
    assert books.last_batch_id(f"{base}/ck-one") == 1 and books.last_batch_id(f"{base}/ck-two") == 0
    batch = spark.createDataFrame([(9, "upsert", "z", "s", "t")], CHANGE)
    books.apply_changes(batch, stream=("s", 4))
    assert books.last_batch_id("s") == 4


def test_shared_folder_is_needed_off_local_masters(spark):
    from types import SimpleNamespace

    def session(master, setting):
        made = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *a: setting), sparkContext=sc)

    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            shared_dir(session(master, None))
        assert shared_dir(session(master, "hdfs:///scratch")) == "hdfs:///scratch"
    own = session("local[2]", None)
    assert shared_dir(own) == shared_dir(own)
