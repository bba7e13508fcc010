import itertools
import math
import random
from collections import Counter

import numpy as np

from lexispark.llm import langid

from .helpers import DOCS, awkward, frame, prose, with_clashes

LANGS = ("en", "de", "es")


def training(spark, n=60):
    return spark.createDataFrame([(i, prose(i, 80, LANGS[i % 3]), LANGS[i % 3], "s", 1) for i in range(n)], DOCS)


def test_held_out_accuracy_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.predict(docs.select("doc_id", "text", "lang"), langid.train(langid.training_rows(docs)))
    r = found.where(langid.held_out(found.doc_id)).selectExpr("avg(cast(lang = lang_pred as int)) a", "min(score) lo", "max(score) hi").first()
    assert r.a > 0.97 and 0 <= r.lo <= r.hi <= 1


def test_training_leaves_the_held_out_rows_and_other_columns_out(spark):
    docs = training(spark, 300)
    model = langid.train(langid.training_rows(docs))
    # other labels on the held-out rows change nothing
    turned = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 4 = 2 then 'zz' else lang end lang")
    other = langid.train(langid.training_rows(turned))
    assert model.langs == other.langs == sorted(LANGS)
    assert all(np.array_equal(getattr(model, x), getattr(other, x)) for x in ("slots", "first", "lang", "n"))


def test_mixture_proportions(spark):
    model = langid.train(training(spark))
    text = prose(1000, 300, "de") + " " + prose(1001, 100, "es")
    share = dict(zip(model.langs, langid.shares([text], model)[0][0], strict=True))
    assert abs(share["de"] - 0.75) < 0.06 and abs(share["es"] - 0.25) < 0.06 and share["en"] < 0.02
    assert max(langid.shares([prose(7, 50, "en")], model)[0][0]) > 0.95


def test_selected_set_is_the_best_penalised_one():
    rng = np.random.default_rng(0)
    sizes = np.array([40, 60, 30])
    like = rng.random((130, 3)) ** 3
    like /= like.max(axis=1, keepdims=True)
    got = langid._pick(like, sizes)
    at = 0
    for row, n in zip(got, sizes, strict=True):
        own, price = like[at : at + n], 0.5 * np.log(n + 1.0) + 3.0
        at += n
        best = None
        for mask in range(1, 8):  # all language sets
            allowed = np.array([[float(mask >> i & 1) for i in range(3)]])
            _, ll = langid._em(own, np.array([0]), np.array([n]), allowed)
            value = ll[0] - price * (allowed.sum() - 1)
            best = max(best or (-np.inf, 0), (value, mask))
        chosen = row > 0
        _, ll = langid._em(own, np.array([0]), np.array([n]), chosen[None].astype(float))
        assert ll[0] - price * (chosen.sum() - 1) >= best[0] - 2.0
        assert abs(row.sum() - 1) < 1e-9


def test_awkward_rows(spark):
    model = langid.train(training(spark))
    out = langid.predict(with_clashes(frame(spark)), model)
    assert out.count() == len(awkward()) and out.columns.count("score") == 1
    found = {r.doc_id: r for r in out.where("doc_id >= 100").collect()}
    for doc in (100, 101, 102):
        assert (found[doc].lang_pred, found[doc].score) == ("und", 0.0)
    assert found[103].lang_pred == "en"
    assert langid.predict(frame(spark, []), model).count() == 0


def test_no_labels_and_the_filter(spark):
    docs = frame(spark, [(1, "abc", None, "s", 1), (2, None, "en", "s", 1)])
    assert {r.lang_pred for r in langid.predict(docs, langid.train(docs)).collect()} == {"und"}
    kept = langid.keep_identified(with_clashes(frame(spark)))
    assert kept.columns == with_clashes(frame(spark)).columns
    gone = {100, 101, 102}
    assert {r.doc_id for r in kept.select("doc_id").collect()}.isdisjoint(gone) and kept.count() >= len(awkward()) - 6


def brute(rows, texts, k=8.0):
    """lang -> proportions of each text, by dictionaries of whole trigrams and
    all language sets."""
    words = lambda t: "".join(c if c.isalpha() else " " for c in t.lower()).split()
    grams = lambda w: [("", "", w[0])] + [(w[i - 2] if i > 1 else "", w[i - 1], c) for i, c in enumerate(w + " ") if i]
    langs = sorted({lang for _, lang in rows})
    tables = {}
    for lang in langs:
        c = [Counter() for _ in range(5)]
        for text, own in rows:
            for w in words(text) if own == lang else ():
                for t, b, x in grams(w):
                    for table, key in zip(c, (x, b, (b, x), (t, b), (t, b, x)), strict=True):
                        table[key] += 1
        tables[lang] = c
    letters = len({x for c in tables.values() for x in c[0]})

    def logp(lang, w):
        uni, after1, pair, after2, triple = tables[lang]
        total = sum(uni.values())
        out = 0.0
        for t, b, x in grams(w):
            p = (uni[x] + 0.5) / (total + 0.5 * letters)
            p = (pair[b, x] + k * p) / (after1[b] + k)
            out += math.log((triple[t, b, x] + k * p) / (after2[t, b] + k))
        return out

    for text in texts:
        like = [[logp(lang, w) for lang in langs] for w in words(text)]
        best = None
        for size in range(1, len(langs) + 1):
            for chosen in itertools.combinations(range(len(langs)), size):
                share = {i: 1 / size for i in chosen}
                for _ in range(12):
                    total = dict.fromkeys(chosen, 0.0)
                    for row in like:
                        top = max(row)
                        part = {i: share[i] * math.exp(row[i] - top) for i in chosen}
                        for i in chosen:
                            total[i] += part[i] / max(sum(part.values()), 1e-30)
                    share = {i: v / len(like) for i, v in total.items()}
                ll = sum(math.log(max(1e-30, sum(share[i] * math.exp(row[i] - max(row)) for i in chosen))) for row in like)
                value = ll - (0.5 * math.log(len(like) + 1) + 3) * (size - 1)
                if best is None or value > best[0] + 1e-9:
                    best = (value, {langs[i]: v for i, v in share.items()})
        yield best[1]


def test_mixtures_against_brute_force(spark):
    rows = [(prose(i, 60, LANGS[i % 3]), LANGS[i % 3]) for i in range(12)] + [("Ελλάδα και γλώσσα", "el")]
    texts = [prose(900 + i, 30, LANGS[i % 3]) + " " + prose(950 + i, 5 * i, LANGS[(i + 1) % 3]) for i in range(6)] + ["και γλώσσα, 42 schung!", "x"]
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(rows)], DOCS)
    asked = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in langid.predict(asked, langid.train(docs)).collect()}
    for i, want in enumerate(brute(rows, texts)):
        top = max(want, key=want.get)
        assert got[i].lang_pred == top and abs(got[i].score - want[top]) < 0.02, (i, want, got[i])
        assert set(got[i].langs) == {lang for lang, v in want.items() if v > 0.005}


def test_scripts_of_any_size_side_by_side(spark):
    """Two hot scripts and four rare ones, all with letters of their own."""
    first = {"en": 0x61, "ru": 0x430, "ka": 0x10D0, "hy": 0x561, "he": 0x5D0, "th": 0xE01, "ja": 0x3042, "zh": 0x4E00}
    size = {"zh": 900, "ja": 60}

    def text(lang, seed):
        rng = random.Random(f"{lang}{seed}")
        letters = [chr(first[lang] + i) for i in range(size.get(lang, 24))]
        common = ["".join(random.Random(f"{lang}{w}").choices(letters, k=2 + w % 4)) for w in range(300)]
        return " ".join(rng.choices(common, k=60))

    rows = [(lang, i) for lang in first for i in range(300 if lang in ("en", "ru") else 12)]
    docs = spark.createDataFrame([(n, text(lang, i), lang, "s", 1) for n, (lang, i) in enumerate(rows)], DOCS)
    asked = spark.createDataFrame([(n, text(lang, 1000 + n), lang, "s", 1) for n, lang in enumerate(list(first) * 20)], DOCS)
    right = langid.predict(asked, langid.train(docs)).selectExpr("lang", "cast(lang = lang_pred as int) ok").groupBy("lang").avg("ok").collect()
    assert len(right) == len(first) and all(r[1] > 0.95 for r in right), right


def test_any_number_of_labels_and_a_narrow_table(spark):
    rows = [(i, prose(i, 40, LANGS[i % 3]), LANGS[i % 3] if i < 60 else f"x{i}", "s", 1) for i in range(260)]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.train(docs)
    assert len(model.langs) == 203 and langid.predict(docs, model).count() == 260
    plain = training(spark)
    whole = langid.train(plain)
    narrow = langid.train(plain, most_entries=len(whole.n) - 1)
    assert narrow.width < whole.width == langid.WIDEST and len(narrow.n) < len(whole.n) and narrow.n.sum() == whole.n.sum()
    ok = langid.predict(training(spark, 90), narrow).selectExpr("avg(cast(lang = lang_pred as int)) a").first().a
    assert ok > 0.9


def test_languages_mixed_in_any_shares_are_kept(spark):
    known = [(i, prose(i, 80, LANGS[i % 3]), LANGS[i % 3], "s", 1) for i in range(90)]
    mixed = " ".join(prose(700 + i, n, lang) for i, (n, lang) in enumerate(((45, "en"), (35, "de"), (20, "es"))))
    odd = [(900, mixed, None, "s", 1), (901, "qxzj wvkq zzxq jqkx wqzx vvkj", None, "s", 1), (902, "1234 !?", None, "s", 1), (903, "жщъ ыэю", None, "s", 1)]
    kept = {r.doc_id for r in langid.keep_identified(spark.createDataFrame(known + odd, DOCS)).collect()}
    assert kept == {*range(90), 900}
