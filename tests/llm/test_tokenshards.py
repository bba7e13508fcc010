import numpy as np
import pytest

from lexispark.llm import queries, tokenshards
from lexispark.session import fresh_path

from .helpers import SF, awkward, frame, with_clashes


@pytest.mark.parametrize("n", [1, 2, 3, 10, 255, 4097])
def test_permutation_is_a_bijection_with_an_inverse(n):
    p = tokenshards.permute(np.arange(n), n, 5)
    assert sorted(p.tolist()) == list(range(n))
    assert tokenshards.permute(p, n, 5, inverse=True).tolist() == list(range(n))
    if n > 100:
        assert p.tolist() != tokenshards.permute(np.arange(n), n, 6).tolist()


def test_shards_hold_every_token_once(spark):
    docs = with_clashes(frame(spark)).repartition(3)
    path = fresh_path(spark, "tokens")
    tokenshards.write_shards(docs, path, length=64, per_shard=16)
    rows = tokenshards.read_slots(spark, path, 0, 64).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all(r.shard == r.slot // 16 and r.byte_offset == r.slot % 16 * 128 and len(r.tokens) == 128 for r in rows)
    with open(tokenshards.VOCABULARY, "rb") as f:
        tokenizer = tokenshards.encoder(f.read())
    # in the order before the permutation the sequences are the packed texts
    numbers = tokenshards.permute(np.arange(len(rows)), len(rows), 11, inverse=True)
    stream, tail = [], 0
    for _, r in sorted(zip(numbers.tolist(), rows, strict=True)):
        stream += np.frombuffer(bytes(r.tokens), dtype="<u2")[: r.n_tokens].tolist()
        tail += r.n_tokens < 64
    texts, held = [], []
    for t in stream:
        if t == tokenshards.END:
            texts.append(tokenizer.decode(held))
            held = []
        else:
            held.append(t)
    assert not held and sorted(texts) == sorted(d[1] for d in awkward() if d[1]) and tail <= 3


def test_reading_goes_on_from_any_slot(spark):
    path = fresh_path(spark, "tokens")
    tokenshards.write_shards(frame(spark), path, length=32, per_shard=8)
    whole = {r.slot: bytes(r.tokens) for r in tokenshards.read_slots(spark, path, 0, 32).collect()}
    rest = {r.slot: bytes(r.tokens) for r in tokenshards.read_slots(spark, path, 19, 32).collect()}
    assert rest == {s: t for s, t in whole.items() if s >= 19} and rest


def test_empty_table(spark):
    assert tokenshards.shards(frame(spark, [])).count() == 0


def test_the_query_reads_the_shards_it_wrote(spark):
    out = queries.op2_token_binary(spark, SF)
    files = [f for f in out.inputFiles() if "/shards-" in f]
    assert files
    written = spark.read.parquet(files[0].rsplit("/", 1)[0])
    assert written.selectExpr("sum(n_sequences)").first()[0] == out.count() and out.selectExpr("min(slot)").first()[0] == 0
