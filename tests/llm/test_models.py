"""Quality, language and toxicity: exact columns by brute force, models on held-out rows."""
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from coldspot.llm import common, langid, quality, queries, toxicity

from .conftest import DATA, ODD_TEXTS, frame

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def brute_base(text):
    words = WORDS.findall(text or "")
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": dup, "n_repeat_words": len(covered),
            "base_failed": n < 20 or 100 * len(covered) > 30 * n}


@pytest.fixture(scope="module")
def quality_rows(spark):
    return queries.op1_quality_rules(spark, DATA).collect()


def test_quality_base_columns(documents, quality_rows):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert len(quality_rows) == len(texts)
    for r in quality_rows:
        want = brute_base(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)


def test_quality_repeats_in_one_batch():
    texts = ["a b c d e f g h " * 3, "a b c d e f g h i", "a b c d e f g h i j", "x " * 30, "", "p q r s t u v w p q r s t u v w"]
    got = quality.base_columns(texts, quality.Words(texts))
    assert got["n_repeat_words"].tolist() == [brute_base(t)["n_repeat_words"] for t in texts]


def test_quality_held_out_accuracy(spark, documents, labels):
    model = quality.train(documents, labels.where("doc_id % 2 = 0"))
    rows = quality.assess(documents, model).join(labels, "doc_id").where("doc_id % 2 = 1 and not base_failed").collect()
    assert len(rows) > 100
    assert np.mean([r["kept"] == bool(r["quality"] >= 0.5) for r in rows]) == 1.0
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert np.mean([r["kept"] == bool(truth[r["doc_id"]]) for r in quality.assess(documents, model).collect()
                    if r["doc_id"] in truth and r["doc_id"] % 2 and not r["base_failed"]]) > 0.97


def test_quality_edge_cases(spark, odd, empty, documents, labels):
    model = quality.train(documents, labels)
    rows = quality.assess(odd, model).collect()
    texts = [t for _, t, _, _ in ODD_TEXTS]
    assert len(rows) == len(texts)
    keys = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(tuple(r[k] for k in keys) for r in rows) == sorted(tuple(brute_base(t)[k] for k in keys) for t in texts)
    assert quality.assess(empty, model).count() == 0
    assert quality.filtered(odd, model).columns == odd.columns
    kept = sum(r["kept"] for r in rows)
    assert quality.filtered(odd, model).count() == kept
    # nothing to learn from: only the base rules decide
    assert quality.train(documents, labels.limit(0)) is None
    assert quality.train(empty, labels) is None
    assert {(r["base_failed"], r["kept"]) for r in quality.assess(documents, None).collect()} == {(True, False), (False, True)}


def test_quality_repeated_and_null_labels(spark, documents, labels):
    more = labels.unionAll(labels).unionAll(labels.selectExpr("doc_id", "cast(null as int)", "toxic"))
    sample, counts = common.labelled_texts(documents, more, "quality", 50, False)
    n = {r["quality"]: r["n"] for r in labels.groupBy("quality").count().withColumnRenamed("count", "n").collect()}
    assert counts == n
    rows = sample.collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) <= 200


def test_calibration():
    rng = np.random.default_rng(1)
    score = rng.normal(0, 3, 4000)
    y = (rng.random(4000) < common.sigmoid(0.5 * score - 1)).astype(float)
    a, b = common.fit_platt(score, y, np.ones(4000))
    assert abs(a - 0.5) < 0.08 and abs(b + 1) < 0.15


def test_language_query_on_held_out_rows(spark, documents):
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = queries.op2_language_id(spark, DATA).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1
    test = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in test]) > 0.95


def test_language_windows_cover_whole_texts():
    texts = ["a" * 700, "", "é" * 128, "abc"]
    x, owner, used = langid.windows(texts)
    assert used.tolist() == [256, 256, 188, 256, 3]
    assert owner.tolist() == [0, 0, 0, 2, 3]
    assert b"".join(bytes(w[:n]) for w, n in zip(x, used)) == "".join(texts).encode()


def test_language_fast_tables_equal_convolution():
    x = np.random.default_rng(0).integers(0, 256, (20, langid.WINDOW), dtype=np.uint8)
    net = langid.fit(x, np.arange(20) % 2, ["a", "b"], epochs=1)
    z, _ = net.pooled(x)
    want = langid._softmax(np.maximum(z, 0) @ net.dense + net.dense_bias)
    assert np.allclose(net.probabilities(x, net.fast_tables()), want, atol=1e-5)


def test_language_edge_cases(spark, odd, empty, documents):
    net = langid.train(documents)
    rows = langid.predict(odd, net).collect()
    assert len(rows) == len(ODD_TEXTS)
    texts = {d: t for d, t, _, _ in ODD_TEXTS}
    for r in rows:
        letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
        assert (r["lang_pred"] != "und") == letters, r
    assert langid.predict(empty, net).count() == 0
    assert langid.train(empty) is None
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}
    # lang, source and doc_id are no inputs
    other = frame(spark, [(d, t, "xx", "other") for d, t, _, _ in ODD_TEXTS])
    assert sorted(map(repr, langid.predict(other, net).collect())) == sorted(map(repr, rows))


@pytest.fixture(scope="module")
def toxic_model(spark):
    base = "/root/testdata/sf0.1"
    return toxicity.train(spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet"), 1500)


def test_toxicity_on_held_out_rows(spark, toxic_model):
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    rows = [r for r in toxicity.score(docs, toxic_model).collect() if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) > 500 and all(held_out(r["doc_id"]) for r in rows)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in rows]) > 0.97
    toxic = [r for r in rows if truth[r["doc_id"]]]
    assert np.mean([r["predicted"] for r in toxic]) > 0.85


@pytest.mark.parametrize("noisy, plain", [
    ("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("iiidddiooot", "idiot"), ("l0s3r", "loser"), ("lo$er", "loser"),
    ("tr@sh", "trash"), ("$cum", "scum"), ("m0r0n!!", "moron"), ("stupid$$$", "stupid"), ("STUPID###", "stupid"),
    ("the", "the"), ("the,", "the"), ("123", ""), ("%%%", "")])
def test_deobfuscation(toxic_model, noisy, plain):
    assert toxicity.Restorer(toxic_model.letters)[noisy] == plain


def test_spaced_letters_and_scores(toxic_model):
    restorer = toxicity.Restorer(toxic_model.letters)
    assert "idiot" in restorer.words("you are an i d i o t here")
    assert restorer.words("a b") == ["a", "b"]
    clean = toxic_model.score("the ed of an oure ing it as")
    hidden = toxic_model.score("the l0s3r of an 1d10t ing m0r0n as $cum tr@sh")
    assert clean < 0.1 and hidden > 0.5


@pytest.mark.parametrize("word", ["l0s", "t4$h", "1d1", "m0r0n!", "$cu|", "a.b"])
def test_decode_is_the_cheapest_reading(toxic_model, word):
    """Viterbi against all readings of short words without repetition, dropped signs included."""
    import itertools

    model = toxic_model.letters
    inner = [i for i, c in enumerate(word) if c.isalnum()]

    def choices(i, c):
        made = [(c, 0.0)] * c.isalpha() + [(x, toxicity.PRICE_LEET) for x in toxicity.LEET.get(c, "")]
        if not made:
            return [("", 0.0)]
        if not c.isalpha():
            inside = inner[0] <= i <= inner[-1]
            made.append(("", toxicity.PRICE_DROP * (2 if c.isdigit() else 1) if inside else toxicity.PRICE_EDGE))
        return made

    readings = []
    for pick in itertools.product(*[choices(i, c) for i, c in enumerate(word)]):
        text = "".join(x for x, _ in pick)
        padded = "\x02\x02" + text + "\x03"
        readings.append((sum(p for _, p in pick) + sum(model.cost(padded[i - 2:i], padded[i]) for i in range(2, len(padded))), text))
    assert toxicity.decode(word, model) == min(readings)[1]


def english_letters():
    words = "you are an idiot the stupid and moron thing this better all see a fool loser of well letter too".split()
    return toxicity.LetterModel.of(toxicity.trigrams_of((w, 1000) for w in words))


def test_words_of_every_length_are_decoded():
    restorer = toxicity.Restorer(english_letters())
    long = "st00pid-and-m0r0n-and-1d1ot-and-5tup1d-th1ng"
    assert len(long) > 40 and "idiot" in restorer[long] and "stupid" in restorer[long] and "thing" in restorer[long]
    assert restorer["1d1ot"] == "idiot" and long in restorer
    huge = "1d1ot" * 4000
    assert restorer[huge].startswith("idiot") and huge not in restorer


def test_doubled_letters_and_signs_only():
    restorer = toxicity.Restorer(toxicity.LetterModel.of(toxicity.trigrams_of((w, 1000) for w in ("idiot", "ass", "better", "all"))))
    assert restorer["iidiott"] == "idiot" and restorer["@$$"] == "ass"
    assert restorer["better"] == "better" and restorer["all"] == "all"
    assert restorer["2023"] == "" and restorer["$100"] == "" and restorer["---"] == ""


def test_spaced_runs_are_words():
    restorer = toxicity.Restorer(english_letters())
    assert {"you", "are", "an", "idiot"} <= set(restorer.words("y o u a r e a n i d i o t"))
    assert "idiot" in restorer.words("i  d  i  o  t") and "idiot" in restorer.words("1 d 1 0 t")
    assert "idiot" in restorer.words("the i\td i o   t and")


def test_letters_are_counted_over_all_documents(spark):
    rows = [(i, f"zqx plain {'toxic' if i % 2 else 'clean'}", "en", "s") for i in range(40)] + [
        (99, "qqz, unlabelled zqx zqx", "en", "s"), (100, None, "en", "s"), (101, "aaa 4zq b-c", "en", "s")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.train(frame(spark, rows), labels, 5).letters
    words = Counter({"zqx": 41, "plain": 40, "toxic": 20, "clean": 20, "qqz": 1, "unlabelled": 1})  # qqz has two alike, but not three
    want = toxicity.LetterModel.of(toxicity.trigrams_of(words.items()))
    assert (model.table == want.table).all() and model.total == want.total


def test_toxicity_edge_cases(spark, odd, empty, toxic_model, documents, labels):
    rows = toxicity.score(odd, toxic_model).collect()
    assert len(rows) == len(ODD_TEXTS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert toxicity.score(empty, toxic_model).count() == 0
    assert toxicity.train(documents, labels.limit(0)) is None and toxicity.train(empty, labels) is None
    assert {r["score"] for r in toxicity.score(odd, None).collect()} == {0.0}
    assert toxicity.filtered(odd, toxic_model).count() == sum(not r["predicted"] for r in rows)


def test_toxicity_query(spark, documents):
    rows = queries.op6_toxicity(spark, DATA).collect()
    assert len(rows) == documents.count()
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)


def test_training_and_scoring_slices_are_small(spark, documents, labels, monkeypatch):
    """A slice of 2 MB takes over 700 MB of a Python worker while its n-grams are counted."""
    seen = []
    map_texts, filter_texts = quality.map_texts, quality.filter_texts
    monkeypatch.setattr(quality, "map_texts", lambda df, fn, schema, max_chars=common.BATCH_CHARS:
                        seen.append(max_chars) or map_texts(df, fn, schema, max_chars))
    monkeypatch.setattr(quality, "filter_texts", lambda df, keep, max_chars=common.BATCH_CHARS:
                        seen.append(max_chars) or filter_texts(df, keep, max_chars))
    model = quality.train(documents, labels, per_class=20)
    quality.assess(documents, model)
    quality.filtered(documents, model)
    assert len(seen) == 3 and max(seen) <= 1 << 19 and seen[0] <= 1 << 18


def test_quality_does_not_depend_on_the_slices(documents):
    texts = [r.text or "" for r in documents.limit(60).collect()]
    whole = quality.Words(texts)
    weights = np.random.default_rng(1).normal(size=quality.WORD_BUCKETS + quality.CHAR_BUCKETS)
    model = quality.QualityModel(weights, 0.1, 1.5, -0.2)
    each = [model.probability([t], quality.Words([t]))[0] for t in texts]
    assert model.probability(texts, whole).tolist() == each


def test_words_are_counted_within_the_tasks(spark):
    """Once a text, whatever the bounds; no row per word and text is made."""
    import pyarrow as pa
    texts = ["a b a\tc", None, "", "b\x0bb d", "\x1c e a"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    want = Counter(w for t in texts if t for w in set(WORDS.findall(t)))
    for most, chars in ((1, 100), (100, 3), (100, 100)):
        got = Counter()
        for made in toxicity.count_words(iter([batch]), most, chars):
            got.update(dict(zip(made.column(0).to_pylist(), made.column(1).to_pylist())))
        assert got == want


def test_hits_are_the_features_of_all_restored_words(toxic_model, monkeypatch):
    """A word is looked up once a text, by what is written; the cache's bounds do not matter."""
    own = toxicity.ToxicityModel(toxic_model.letters, toxic_model.weights, toxic_model.telling, toxic_model.bias,
                                 toxic_model.slope, toxic_model.intercept)
    texts = [t or "" for _, t, *_ in ODD_TEXTS] + ["an 1d10t and a m o r o n i d i o t here", "st-u-pid " * 5, "x" * 60 + " f00ls"]
    for most in (0, 400_000):
        monkeypatch.setattr(toxicity, "HIT_WORDS", most)
        for t in texts:
            own.score(t)
            words = set(toxicity.Restorer(toxic_model.letters).words(t))
            assert own.known.of(t) == toxicity.features(words) & toxic_model.weights.keys()
