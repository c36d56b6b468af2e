"""Words that hashes cannot tell apart, texts over the merge's bound, bounded samples, and models walked by hand."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import language, lexicon, quality, sampling, warc
from strata.llm.queries import VOCABULARY


def encoded(text):
    encoder = lexicon.Encoder(lexicon.load_vocabulary(VOCABULARY))
    raw = text.encode()
    ids, _ = encoder.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    return ids.tolist()


def test_words_of_equal_hashes_are_told_apart():
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert encoded(f"{word} {other}") == tokenizer.encode(f"{word} {other}", add_special_tokens=False).ids


def test_a_text_of_five_megabytes_of_unseen_words():
    pick = random.Random(2)
    text = " ".join("".join(pick.choice("abcdefghijklmnop") for _ in range(100)) for _ in range(52_000))
    assert len(text) > 5_000_000
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert encoded(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_samples_stay_within_their_bound(spark):
    """A third of the rows under one id, a third without one; most rows repeated."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("page_id"),
        F.concat(F.lit("text "), F.col("id") % 3000).alias("html"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("lang"),
    )
    some = sampling.bounded(rows, 6000, 100, "page_id", "html").collect()
    assert len(some) == 100 == len(set(some))
    assert any(r.page_id is None for r in some) and any(r.page_id == 7 for r in some)
    counts = {"x": 3000, "y": 3000}
    by_label = sampling.bounded_by_label(rows, "lang", counts, 40, "html").groupBy("lang").count().collect()
    assert all(20 <= r["count"] <= 40 for r in by_label) and len(by_label) == 2
    few = sampling.bounded(rows.limit(5), 5, 100, "page_id", "html").count()
    assert few == 5
    assert warc.train_dictionary(rows.limit(0)) == b""


def test_labels_and_texts_of_a_repeated_id_are_learnt_once(spark):
    docs = spark.createDataFrame([(1, f"text {n}") for n in range(300)] + [(None, "none")] * 50 + [(2, "good words here")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)] * 200 + [(2, 1), (2, 0), (2, None), (None, 1)], "doc_id long, quality int")
    seen = []
    grow = quality.grow

    def spied(figures, given):
        seen.append((len(figures), sorted(given.tolist())))
        return grow(figures, given)

    quality.grow = spied
    try:
        quality.fit(docs, labels)
    finally:
        quality.grow = grow
    learnt = [k for k in (1, 2) if not spark.range(1).select(F.lit(k).alias("doc_id")).select(sampling.held_out()).first()[0]]
    assert seen == [(len(learnt), sorted({1: 0.0, 2: 1.0}[k] for k in learnt))]


def test_the_network_by_hand():
    """Every window, width and filter in loops, with weights at random."""
    pick = np.random.default_rng(1)
    width, filters = max(language.WIDTHS), language.FILTERS * len(language.WIDTHS)
    mask = language.Network.mask()
    net = language.Network(
        ["x", "y", "z"],
        pick.standard_normal((256, language.EMBEDDED)).astype(np.float32),
        (pick.standard_normal((width * language.EMBEDDED, filters)) * mask).astype(np.float32),
        pick.standard_normal(filters).astype(np.float32),
        pick.standard_normal((filters, 3)).astype(np.float32),
        pick.standard_normal(3).astype(np.float32),
    )
    windows = pick.integers(0, 256, (3, language.WINDOW)).astype(np.uint8)
    got = net.log_probabilities(windows)
    runs = net.unfolded(windows).shape[1]
    for n, window in enumerate(windows):
        hidden = []
        for f in range(filters):
            best = -np.inf
            for at in range(runs):
                total = 0.0
                for k in range(width):
                    byte = window[at + k] if at + k < len(window) else 0
                    for e in range(language.EMBEDDED):
                        total += float(net.embedding[byte, e]) * float(net.filters[k * language.EMBEDDED + e, f])
                best = max(best, total)
            hidden.append(max(0.0, best + float(net.filter_bias[f])))
        scores = [sum(h * float(net.out[f, c]) for f, h in enumerate(hidden)) + float(net.out_bias[c]) for c in range(3)]
        want = np.array(scores) - np.log(np.sum(np.exp(np.array(scores) - max(scores)))) - max(scores)
        np.testing.assert_allclose(got[n], want, rtol=1e-3, atol=1e-3)


def test_the_trees_by_hand():
    pick = np.random.default_rng(5)
    inner, leaves, trees = 2**quality.DEPTH - 1, 2**quality.DEPTH, 6
    forest = quality.Forest(0.3, pick.integers(0, 4, (trees, inner)), pick.standard_normal((trees, inner)), pick.standard_normal((trees, leaves)))
    figures = pick.standard_normal((40, 4))
    for row, got in zip(figures, forest.score(figures)):
        total = 0.3
        for t in range(trees):
            node = 0
            while node < inner:
                node = 2 * node + (2 if row[forest.feature[t, node]] > forest.threshold[t, node] else 1)
            total += forest.value[t, node - inner]
        assert abs(got - 1 / (1 + np.exp(-total))) < 1e-12
