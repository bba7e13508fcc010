"""op12 against a plain tree over the sorted rows, and by tampering."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from lexispark.llm import merkle as K
from lexispark.llm import queries
from tests.llm.helpers import SF, frame, with_clashes


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shown(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(nodes, arity):
    """(last node, proof of each node as lists of siblings)."""
    proofs = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for leaf, i in enumerate(at):
            proofs[leaf].append((i % arity, [h for k, h in enumerate(runs[i // arity]) if k != i % arity]))
        nodes, at = [sha("".join(r)) for r in runs], [i // arity for i in at]
    return nodes[0], proofs


def brute(rows, arity=2):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = sha(shown([doc_id, source, lang, n_chars, text]))
        bad = doc_id is not None and n_chars is not None and crc32(str(doc_id).encode()) % 7 == 0
        groups[lang].append(((doc_id is not None, doc_id or 0), leaf, doc_id, sha(shown([doc_id, source, lang, n_chars + bad if bad else n_chars, text]))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[1] for x in sorted(groups[g], key=lambda x: x[:2])], arity) for g in names}
    root, tops = tree([trees[g][0] for g in names], arity)
    out = []
    for g, top in zip(names, tops, strict=True):
        for (_, leaf, doc_id, given), proof in zip(sorted(groups[g], key=lambda x: x[:2]), trees[g][1], strict=True):
            held = given
            for slot, siblings in proof + top:
                held = sha("".join(siblings[:slot]) + held + "".join(siblings[slot:]))
            out.append((doc_id, leaf, trees[g][0], root, sha("".join(h for _, s in proof + top for h in s)), held, held == root))
    return out


def same(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_awkward_rows(spark, arity):
    df = with_clashes(frame(spark)).repartition(6)
    rows = [tuple(r)[:5] for r in df.collect()]
    same(K.verify_documents(df, arity).collect(), brute(rows, arity))


def test_many_groups_and_one_hot_group(spark):
    rows = [(i, f"t{i}", "hot", None, i) for i in range(300)] + [(i, "t", f"é{i:03d}", "s", i) for i in range(300, 340)] + [(-5, "x", None, "s", None)]
    same(K.verify_documents(frame(spark, rows).repartition(8)).collect(), brute(rows))


def test_small_tables(spark):
    one = [(7, "a", "en", None, 1)]
    got = K.verify_documents(frame(spark, one)).collect()
    same(got, brute(one))
    assert got[0].proof_sha256 == sha("")
    assert K.verify_documents(frame(spark, [])).count() == 0
    _, root = K.manifest(frame(spark, []), K.leaf_text([F.col("text")]), "lang", "doc_id")
    assert root == sha("")


def test_proof_shows_any_change(spark):
    df = frame(spark, [(i, f"text {i}", f"l{i % 3}", "s", 5) for i in range(20)])
    leaf = K.leaf_text([F.col("doc_id"), F.col("text")])
    made, root = K.manifest(df, leaf, "lang", "doc_id")
    ok = made.select(K.fold(F.col("leaf"), F.col("path")).alias("r"), K.fold(F.sha2(F.lit("other"), 256), F.col("path")).alias("x")).collect()
    assert {r.r for r in ok} == {root} and root not in {r.x for r in ok}
    _, other = K.manifest(df.withColumn("text", F.when(F.col("doc_id") == 13, "changed").otherwise(F.col("text"))), leaf, "lang", "doc_id")
    assert other != root
    with pytest.raises(ValueError):
        K.manifest(df, leaf, "lang", "doc_id", arity=1)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    same(queries.op12_merkle_manifest(spark, SF).collect(), brute(rows))
