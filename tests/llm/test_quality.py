from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import quality, queries

from .helpers import awkward, frame, prose, with_clashes


def brute_model(texts, alphabet):
    """Interpolated modified Kneser-Ney over classes, by dictionaries."""
    cls = lambda t: [0] * 3 + [alphabet.index(ord(c)) + 1 if ord(c) in alphabet else quality.OTHER for c in t]
    top = Counter(tuple(s[i - 3 : i + 1]) for s in map(cls, texts) for i in range(3, len(s)))
    levels = {4: top}
    for o in (3, 2, 1):
        levels[o] = Counter(g[1:] for g in levels[o + 1])
    tables = {}
    for o, counts in levels.items():
        d = quality.discounts(Counter(n for n in counts.values() if n <= 4))
        total, reserved = defaultdict(float), defaultdict(float)
        for g, n in counts.items():
            total[g[:-1]] += n
            reserved[g[:-1]] += d[min(n, 3) - 1]
        tables[o] = (counts, d, total, reserved)

    def p(g):
        low = p(g[1:]) if len(g) > 1 else 1 / quality.CLASSES
        counts, d, total, reserved = tables[len(g)]
        h = g[:-1]
        if h not in total:
            return low
        n = counts.get(g, 0)
        return ((n - d[min(n, 3) - 1] if n else 0) + reserved[h] * low) / total[h]

    return lambda t: np.exp(-np.mean([np.log(p(tuple(s[i - 3 : i + 1]))) for s in [cls(t)] for i in range(3, len(s))])) if t else None


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def split(spark, texts, folds=3):
    """(counted, apart) of trusted texts, as the operator deals them."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", quality.left_out(F.col("text"), folds).alias("apart")).collect()
    apart = {r.i for r in rows if r.apart}
    assert 0 < len(apart) < len(texts)
    return [t for i, t in enumerate(texts) if i not in apart], [t for i, t in enumerate(texts) if i in apart]


def test_perplexity_against_brute_force(spark):
    good = [prose(i, 40, lang) for i in range(6) for lang in ("en", "de")]
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(good)] + [(50, prose(77, 30, "es") + " #### QQ", "en", "s", 1), (51, "z", None, "s", 1)])
    out = {r.doc_id: r for r in quality.classify(docs, labels(spark, [(i, 1, 0) for i in range(12)] + [(0, 1, 0)])).collect()}
    counted, apart = split(spark, good)
    alphabet = quality.alphabet_of(frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(counted)]))
    want = brute_model(counted, alphabet)
    for doc, text in [*enumerate(good), (50, prose(77, 30, "es") + " #### QQ"), (51, "z")]:
        assert out[doc].perplexity == pytest.approx(want(text), rel=1e-4)
    assert all(out[i].keep for i, t in enumerate(good) if t in apart) and not out[50].keep
    assert out[50].threshold == pytest.approx(max(map(want, apart)), rel=2e-3)


def test_probabilities_sum_to_one():
    text = prose(3, 50)
    alphabet = sorted({ord(c) for c in text})
    table = quality.class_table(alphabet)
    code, real = quality._codes(quality._points([text, None])[0], table)
    assert real.sum() == len(text) and code[real].max() < quality.N_CODES


def test_junk_goes_and_good_stays_on_the_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), lab).join(lab, "doc_id")
    rate = {r.quality: r.k for r in out.groupBy("quality").agg({"keep": "max"}).selectExpr("quality", "1 k").collect()}
    assert rate.keys() == {0, 1}
    r = out.selectExpr("avg(if(quality = 1 and coalesce(toxic, 0) = 0, cast(keep as int), null)) good", "avg(if(quality = 0, cast(keep as int), null)) bad").first()
    assert r.good > 0.94 and r.bad < 0.1


def test_awkward_rows(spark):
    docs = with_clashes(frame(spark))
    lab = labels(spark, [(i, 1, 0) for i in range(24)] + [(3, 0, None), (None, 1, 0)])
    out = quality.classify(docs, lab)
    rows = out.select("doc_id", "text", "perplexity", "threshold", "keep").collect()
    assert len(rows) == len(awkward()) and out.columns.count("keep") == 1
    for r in rows:
        assert (r.perplexity is None) == (not r.text) and (r.text or not r.keep)
    kept = quality.keep_good(docs, lab)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in rows)
    assert quality.classify(frame(spark, []), lab).count() == 0
    free = quality.classify(frame(spark), labels(spark, [])).collect()
    assert all(r.keep == bool(r.text) for r in free)


def test_the_query_cuts_at_the_exact_quantile_of_each_language(spark):
    sf = "/root/testdata/sf0.001"
    out = queries.op4_quality_classifier(spark, sf).collect()
    trusted = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct()
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(quality.left_out(F.col("text"), 3))
    good = {r.doc_id for r in docs.join(trusted, "doc_id").select("doc_id").collect()}
    for lang in {r.lang for r in out}:
        own = sorted(r.perplexity for r in out if r.lang == lang and r.doc_id in good and r.perplexity is not None)
        cuts = {r.threshold for r in out if r.lang == lang}
        assert len(cuts) == 1
        if own:
            assert cuts.pop() == pytest.approx(own[int(np.ceil(quality.QUANTILE * len(own))) - 1], rel=2e-3)


def test_every_character_of_trusted_text_is_its_own_class(spark):
    """Far more than 64 characters: text of a rare script beats its shuffle."""
    import random

    rng = random.Random(5)
    han = [chr(0x4E00 + i) for i in range(300)]
    words = ["".join(rng.choices(han, k=3)) for _ in range(60)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    good = [prose(i, 200) for i in range(10)] + [text(100) for _ in range(10)]
    real = text(100)
    junk = "".join(rng.sample(real, len(real)))
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate([*good, real, junk])])
    out = {r.doc_id: r for r in quality.classify(docs, labels(spark, [(i, 1, 0) for i in range(20)])).collect()}
    counted, _ = split(spark, good)
    alphabet = quality.alphabet_of(docs.where(F.col("text").isin(counted)))
    assert len(alphabet) > 100 and out[21].perplexity > 5 * out[20].perplexity
    want = brute_model(counted, alphabet)
    assert out[20].perplexity == pytest.approx(want(real), rel=1e-4) and out[21].perplexity == pytest.approx(want(junk), rel=1e-4)


def test_unseen_clean_text_is_kept_at_the_quantile(spark):
    """The threshold holds for texts that neither the counts nor it have
    seen: half of the trusted labels are taken away."""
    sf = "/root/testdata/sf0.1"
    lab = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id", "quality", "toxic").distinct()
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(lab.select("doc_id"), "doc_id")
    hidden = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(2)) == 0
    known = lab.join(docs.where(~hidden).select("doc_id"), "doc_id")
    r = quality.classify(docs, known).where(hidden).selectExpr("avg(cast(keep as int)) k", "count(*) n").first()
    assert r.n > 1000 and abs(r.k - quality.QUANTILE) < 0.01


def test_more_classes_than_two_bytes_hold():
    import random

    text = "".join(chr(c) for c in random.Random(1).sample([*range(1, 0xD800), *range(0xE000, 0x10FFFF)], 70_000)) + "abcabc" * 3
    table = quality.class_table([ord(c) for c in set(text)])
    kinds, n, at, real = quality._types(quality._points([text])[0], table)
    want = Counter(("\0\0\0" + text)[i : i + 4] for i in range(len(text)))
    assert dict(zip(kinds.tolist(), n.tolist(), strict=True)) == want
    assert kinds[at[real]].tolist() == [("\0\0\0" + text)[i : i + 4] for i in range(len(text))]


def test_a_table_too_large_to_send_gives_the_same_values(spark):
    docs = with_clashes(frame(spark))
    good = docs.where("doc_id < 24").select("text")
    sent, kept = quality.train(docs, good), quality.train(docs, good, most_sent=10)
    assert sent.sent is not None and kept.sent is None
    value = lambda df: sorted((tuple(r) for r in df.select("doc_id", "text", "score", "perplexity").collect()), key=str)
    want = value(quality.score(docs, sent))
    assert value(quality.score(docs, kept)) == want
    assert value(quality.score_slices(docs, kept, size=10_000)) == want
