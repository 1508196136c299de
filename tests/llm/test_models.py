"""Language identification and perplexity."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.llm import kneser, langid
from statloom.llm.catalogue import QUERIES


def slow_marginals(potentials, moves):
    n, k = potentials.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = sum(moves[s, path[0]] for s in range(k)) * potentials[0, path[0]]
        for t in range(1, n):
            weight *= moves[path[t - 1], path[t]] * potentials[t, path[t]]
        for t, s in enumerate(path):
            out[t, s] += weight
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_forward_backward_against_all_paths(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = np.random.default_rng(block)
    sizes = [0, 1, 5, 0, 7, 2, 3]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    potentials, moves = rng.random((offsets[-1], 3)) + 0.01, rng.random((3, 3)) + 0.1
    forward, backward = langid.forward_backward(potentials, offsets, moves)
    got = langid.scaled(forward * backward)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b > a:
            assert got[a:b] == pytest.approx(slow_marginals(potentials[a:b], moves))


def test_training_learns_words_and_switches():
    rng = np.random.default_rng(0)
    vocab = [["alpha", "beta", "gamma"], ["uno", "dos", "tres"]]
    texts, labels = [], []
    for _ in range(60):
        own = [rng.integers(2)] * 8
        own = own[:4] + [1 - own[0]] * 4 if rng.random() < 0.5 else own
        texts.append(" ".join(vocab[c][rng.integers(3)] for c in own))
        labels.append(np.array(own))
    crf = langid.train(texts, labels, ["greek", "spanish"])
    assert crf.moves[0, 0] > crf.moves[0, 1] and crf.moves[1, 1] > crf.moves[1, 0]
    data = np.frombuffer(b"alpha beta xyz gamma uno dos", np.uint8)
    starts, ends, _ = langid.tx.words(data, np.array([0, len(data)]))
    marginals = langid.word_marginals(crf, langid.Types(data, starts, ends), np.array([0, 6]))
    assert marginals.argmax(axis=1).tolist() == [0, 0, 0, 0, 1, 1]


def test_held_out_accuracy(spark, root, documents):
    rows = QUERIES["op2_langid"](spark, root).join(documents.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    out = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert sum(out) / len(out) > 0.97


def test_labels_and_ids_are_no_inputs(spark, documents):
    crf = langid.fit(documents)
    some = documents.limit(40)
    plain = some.select("text", langid.classify(some, crf).alias("g")).select("text", "g.*").collect()
    other = some.select((F.col("doc_id") + 5).alias("doc_id"), "text", F.lit("fr").alias("lang"))
    again = other.select("text", langid.classify(other, crf).alias("g")).select("text", "g.*").collect()
    assert sorted(plain) == sorted(again)


def sentences(rng, spark, documents, lang, sizes):
    """Texts of the given numbers of words, in the words of one language."""
    pool = [w for r in documents.where(F.col("lang") == lang).select("text").limit(40).collect() for w in r.text.split() if w.isalpha()]
    return [" ".join(rng.choice(pool) for _ in range(n)) for n in sizes]


@pytest.mark.parametrize("sizes", [((6, 9), (6, 9)), ((200, 400), (6, 9)), ((1, 4), (1, 4))])
def test_short_texts_are_learnt(spark, documents, sizes):
    rng = random.Random(3)
    known = [r[0] for r in documents.where("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(2).collect()]
    rows = []
    for lang, (low, high) in zip(known, sizes):
        rows += [(t, lang) for t in sentences(rng, spark, documents, lang, [rng.randrange(low, high) for _ in range(200)])]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    got = langid.identify(table).join(table.drop("text"), "doc_id").collect()
    for lang in known:
        right = [r.lang_pred == lang for r in got if r.lang == lang]
        assert sum(right) > (0.95 if sizes[0][0] > 1 else 0.8) * len(right)


def test_copies_do_not_crowd_out_a_language(spark, documents):
    rng = random.Random(4)
    known = [r[0] for r in documents.where("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(2).collect()]
    own = {lang: sentences(rng, spark, documents, lang, [30] * 30) for lang in known}
    rows = [(t, known[0]) for t in own[known[0]]] + [(own[known[1]][0], known[1])] * 5000 + [(t, known[1]) for t in own[known[1]]]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    crf = langid.fit(table, rows_per_language=20)
    fresh = [(t, lang) for lang in known for t in sentences(rng, spark, documents, lang, [12] * 30)]
    probe = spark.createDataFrame(fresh, "text string, lang string")
    got = probe.select("lang", langid.classify(probe, crf).alias("g")).collect()
    assert sum(r.lang == r.g.lang_pred for r in got) > 0.9 * len(got)


def test_switching_between_languages_is_no_doubt(spark, documents):
    rng = random.Random(5)
    known = sorted(r[0] for r in documents.where("lang is not null").select("lang").distinct().collect())[:3]
    mixed = " ".join(part for _ in range(10) for lang in known for part in sentences(rng, spark, documents, lang, [8]))
    probe = spark.createDataFrame([(mixed,)], "text string")
    got = probe.select(langid.classify(probe, langid.fit(documents)).alias("g")).first().g
    assert got.score < 0.6 and got.certainty > 0.8


def test_language_of_odd_rows(odd, nothing, spark):
    rows = langid.identify(odd).collect()
    assert len(rows) == odd.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (3, 4, 5, 6))
    assert all(r.lang_pred != "und" for r in rows if r.doc_id in (1, 2, 7))
    assert langid.identify(nothing).count() == 0
    unlabelled = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert langid.identify(unlabelled).first().lang_pred == "und"


def slow_symbols(text):
    return [int(kneser.SYMBOL[b]) for b in text.encode()]


def slow_model(texts):
    """Modified Kneser-Ney by its definition, over tuples."""
    order = kneser.ORDER
    counts = [Counter()]
    for text in texts:
        padded = [0] * (order - 1) + slow_symbols(text)
        counts[0].update(tuple(padded[i : i + order]) for i in range(len(padded) - order + 1))
    for _ in range(order - 1):
        counts.append(Counter(g[1:] for g in counts[-1]))
    counts = counts[::-1]

    def discounts(c):
        n = [sum(v == k for v in c.values()) for k in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5 for k in (1, 2, 3)]
        return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw)]

    levels = []
    for c in counts:
        d = discounts(c)
        total, held = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            total[g[:-1]] += v
            held[g[:-1]] += d[min(v, 3) - 1]
        levels.append((c, d, total, held))

    def p(g):
        c, d, total, held = levels[len(g) - 1]
        below = p(g[1:]) if len(g) > 1 else 1 / 32
        if not total[g[:-1]]:
            return below
        return (c[g] - d[min(c[g], 3) - 1] if g in c else 0) / total[g[:-1]] + held[g[:-1]] / total[g[:-1]] * below

    return p


TRUSTED = ["the cat sat on the mat.", "the dog sat on the log; the cat ran", "a mat, a cat, a dog", "école 12 ## the end"]


def test_model_against_definition(spark):
    rows = spark.createDataFrame([(t,) for t in TRUSTED], "body string").select(F.col("body").cast("binary"))
    table = {r.g: r.cost for r in kneser.model(rows).collect()}
    assert len(table) == kneser.GRAMS
    p = slow_model(TRUSTED)
    rng = np.random.default_rng(1)
    seen = [tuple(([0] * 3 + slow_symbols(t))[i : i + 4]) for t in TRUSTED for i in range(len(t))]
    for g in seen + [tuple(rng.integers(0, 32, 4).tolist()) for _ in range(300)]:
        code = sum(s << (5 * (3 - i)) for i, s in enumerate(g))
        assert table[code] == pytest.approx(-math.log(p(g)) / kneser.UNIT, abs=1.0)
    context = [table[(5 << 15) | (20 << 10) | (8 << 5) | s] for s in range(32)]
    assert sum(math.exp(-c * kneser.UNIT) for c in context) == pytest.approx(1, abs=1e-4)


def test_perplexity_against_definition(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*TRUSTED, "zq## ## xx", "the cat"])], "doc_id long, text string, lang string")
    ids = spark.createDataFrame([(i,) for i in range(len(TRUSTED))], "doc_id long")
    p = slow_model(TRUSTED)
    for r in kneser.perplexity(docs, ids).collect():
        text = [*TRUSTED, "zq## ## xx", "the cat"][r.doc_id]
        padded = [0] * 3 + slow_symbols(text)
        mean = -sum(math.log(p(tuple(padded[i : i + 4]))) for i in range(len(padded) - 3)) / (len(padded) - 3)
        assert r.perplexity == pytest.approx(math.exp(mean), rel=3e-3)
        assert r.kept == (r.doc_id != len(TRUSTED)), r


def test_perplexity_query(spark, root):
    labels = spark.read.parquet(f"{root}/labels.parquet")
    shares = QUERIES["op7_perplexity"](spark, root).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in shares.collect()}
    assert kept[1] > 0.97 and kept[0] < 0.5


def test_perplexity_of_odd_rows(spark, odd, nothing):
    ids = spark.createDataFrame([(1,), (8,), (None,)], "doc_id long")
    rows = kneser.perplexity(odd, ids).collect()
    assert len(rows) == odd.count()
    assert all(not r.kept and r.n_grams == 0 for r in rows if r.doc_id in (3, 4))
    assert all(r.cut is not None for r in rows)
    assert kneser.perplexity(nothing, ids).count() == 0
    untrusted = kneser.perplexity(odd, ids.limit(0)).collect()
    assert all(r.kept == (r.n_grams > 0) for r in untrusted)
