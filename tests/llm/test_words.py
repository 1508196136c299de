"""Perplexity under the word model."""

import math
import os
import random
from collections import Counter, defaultdict
from urllib.parse import urlparse

import pytest

from statloom.llm import kneser, wordmodel
from statloom.llm.kneser import GRID, UNIT
from tests.llm.test_models import slow_model, slow_symbols

TRUSTED = ["the cat sat on the mat", "the dog sat on the log and the cat ran on the mat", "a mat a cat a dog", "the cat sat on a mat", "Price 12! the end"]
OTHER = ["Price 12! the cat", "Price 34? the cat", "zq xx the", "the cat sat on the log"]
IDS = "doc_id long, text string, lang string"


def slow_counts(texts):
    counts = [Counter()]
    for text in texts:
        padded = [None, None, *text.split()]
        counts[0].update(tuple(padded[i : i + 3]) for i in range(len(padded) - 2))
    for _ in range(2):
        counts.append(Counter(g[1:] for g in counts[-1]))
    return counts[::-1]


def slow_discounts(c):
    n = [sum(v == k for v in c.values()) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw)]


def slow_mean(text, counted, every):
    """Mean surprisal per byte of a text by counts of the texts `counted`, with the discounts of `every`."""
    counts, ds = slow_counts(counted), [slow_discounts(c) for c in slow_counts(every)]
    total, held = [defaultdict(int) for _ in counts], [defaultdict(float) for _ in counts]
    for i, c in enumerate(counts):
        for g, v in c.items():
            total[i][g[:-1]] += v
            held[i][g[:-1]] += ds[i][min(v, 3) - 1]

    def p(g, base):
        i = len(g) - 1
        below = p(g[1:], base) if i else base
        t, v = total[i][g[:-1]], counts[i][g]
        return (v - ds[i][min(v, 3) - 1] if v else 0) / t + held[i][g[:-1]] / t * below if t else below

    letters = slow_model(every)
    symbols, alike = [0, 0, 0, *slow_symbols(text)], Counter(kneser.SYMBOL.tolist())
    spelling = [letters(tuple(symbols[i : i + 4])) / alike[symbols[i + 3]] for i in range(len(symbols) - 3)]
    padded, out, at = [None, None, *text.split()], 0.0, 0
    for i, word in enumerate(text.split()):
        out -= math.log(p(tuple(padded[i : i + 3]), math.prod(spelling[at : at + len(word) + 1])))
        at += len(word) + 1
    return out / len(text)


def test_words_against_definition(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*TRUSTED, *OTHER])], IDS).coalesce(1)
    ids = spark.createDataFrame([(i,) for i in range(len(TRUSTED))], "doc_id long")
    found = {r.doc_id: r for r in wordmodel.perplexity(docs, ids).collect()}
    for i, text in enumerate([*TRUSTED, *OTHER]):
        counted = [t for k, t in enumerate(TRUSTED) if k != i]
        assert math.log(found[i].perplexity) == pytest.approx(slow_mean(text, counted, TRUSTED), abs=1.1 * GRID * UNIT), text
    # The same byte classes, so the model of 32 symbols gave both the same perplexity.
    assert found[len(TRUSTED)].perplexity < found[len(TRUSTED) + 1].perplexity


def test_words_of_odd_rows(spark, odd, nothing):
    ids = spark.createDataFrame([(1,), (8,), (None,)], "doc_id long")
    rows = wordmodel.perplexity(odd, ids).collect()
    assert len(rows) == odd.count()
    assert all(not r.kept and r.n_grams == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert all(r.cut is not None for r in rows)
    assert wordmodel.perplexity(nothing, ids).count() == 0
    untrusted = wordmodel.perplexity(odd, ids.limit(0)).collect()
    assert all(r.kept == (r.n_grams > 0) for r in untrusted)


def test_what_is_stored_is_less_than_the_texts(spark, monkeypatch):
    """Neither a copy of the texts nor the table of n-grams is written, and shuffle files do not pile up."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(20000)]
    texts = [" ".join(rng.choices(words, k=2000)) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    stored, plain = [], wordmodel.materialise

    def watched(df, name):
        out = plain(df, name)
        stored.append(sum(os.path.getsize(urlparse(f).path) for f in out.inputFiles()))
        return out

    monkeypatch.setattr(wordmodel, "materialise", watched)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    got = wordmodel.perplexity(docs, docs.where("doc_id % 2 = 0").select("doc_id")).collect()
    assert len(got) == 200 and all(r.n_grams == 2000 for r in got)
    assert sum(stored) < 0.6 * sum(map(len, texts))
    assert spark.conf.get(cleanup) == before
