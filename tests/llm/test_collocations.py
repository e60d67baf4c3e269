"""Collocations against counting every phrase."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import HARD, LOWER, rows

from tickbars.llm import collocations
from tickbars.llm.shared import written


def brute(docs, least, best):
    """docs: (text, lang)."""
    counts = defaultdict(Counter)
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for phrase, c in f.items() if len(phrase) == 1)
        many = {phrase: a for phrase, a in f.items() if len(phrase) > 1 and a >= least}
        found = []
        for phrase, a in many.items():
            inside = any(len(q) > len(phrase) and b >= a and f" {' '.join(phrase)} " in f" {' '.join(q)} " for q, b in many.items())
            if not inside:
                cuts = [(1000 * a * n // (f[phrase[:j]] * f[phrase[j:]]), j) for j in range(1, len(phrase))]
                score, j = min(cuts)
                found.append((score, a, " ".join(phrase), f[phrase[:j]], f[phrase[j:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, phrase, a, left, right, n, score) for i, (score, a, phrase, left, right) in enumerate(found[:best])]
    return sorted(out, key=repr)


def prose(n, seed):
    random = np.random.default_rng(seed)
    words = ["the", "of", "New", "york", "city", "é", "x9", "a", "hot", "dog"]
    fixed = ["in New york city hall", "hot dog stand of the day a"]
    for _ in range(n):
        parts = [random.choice(words, random.integers(1, 9)).tolist() + ([random.choice(fixed)] if random.random() < 0.4 else []) for _ in range(4)]
        yield random.choice([". ", "\n", " \t", ", "]).join(" ".join(part) for part in parts)


@pytest.fixture(scope="module")
def texts():
    return [(text, lang) for i, lang in enumerate(["en", "de", None]) for text in prose(60, i)] + [(row[1], row[2]) for row in HARD]


@pytest.mark.parametrize(("least", "best"), [(3, 2000), (8, 5), (1, 40)])
def test_equal_to_counting_every_phrase(spark, texts, least, best):
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(4)
    texts = [t for t in texts if not t[0] or len(t[0]) < 9000] if least == 1 else texts
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(4)
    assert rows(collocations.collocations(docs, least=least, best=best)) == brute(texts, least, best)


def test_a_full_filter_changes_nothing(spark, texts, monkeypatch):
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(4)
    monkeypatch.setattr(collocations, "filter_of", lambda hashes, slots: np.full(slots // 8, 255, np.uint8))
    assert rows(collocations.collocations(docs, least=4)) == brute(texts, 4, 2000)


def test_edges_and_ends_hold_each_word_once(spark):
    """Five-word edges, and shorter sequences only where a piece ends; flows give every shorter count."""
    texts = spark.createDataFrame([("en", "a b c d e f. a b"), ("en", "a b c d e f")], "lang string, text string")
    full = np.full((1 << 16) // 8, 255, np.uint8)
    found = collocations.edges_and_ends(texts, full, 1 << 16)
    assert rows(found.select("phrase", "k", "n")) == sorted(
        [("a b c d e", 5, 2), ("b c d e f", 5, 2), ("c d e f", 4, 2), ("d e f", 3, 2), ("e f", 2, 2), ("f", 1, 2), ("a b", 2, 1), ("b", 1, 1)], key=repr
    )
    levels = collocations.flows(written(found, "edges"))
    assert rows(levels[0].select("phrase", "n")) == [("a", 3), ("b", 3), ("c", 2), ("d", 2), ("e", 2), ("f", 2)]
    assert rows(levels[1].select("phrase", "n")) == [("a b", 3), ("b c", 2), ("c d", 2), ("d e", 2), ("e f", 2)]


def test_unary_paths_are_compacted(spark):
    phrases = [("en", 2, "a b", 5), ("en", 3, "a b c", 5), ("en", 2, "b c", 6), ("de", 2, "b c", 5), ("en", 4, "a b c d", 4)]
    frame = spark.createDataFrame(phrases, "lang string, k long, phrase string, a long")
    left = {tuple(row) for row in collocations.compacted(frame).select("lang", "phrase").collect()}
    assert left == {("de", "b c"), ("en", "a b c"), ("en", "a b c d"), ("en", "b c")}


def test_scores_past_64_bits(spark):
    a, n = 3_000_000_000_007, 90_000_000_000_000_003
    parts = {"x": 4_000_000_000_001, "y z": 3_500_000_000_003, "x y": 3_000_000_000_011, "z": 9_000_000_000_000_017}
    phrases = spark.createDataFrame([("en", 3, "x y z", a)], "lang string, k long, phrase string, a long")
    counts = spark.createDataFrame([("en", p, c) for p, c in parts.items()], "lang string, phrase string, n long")
    row = collocations.scored(phrases, counts, spark.createDataFrame([("en", n)], "lang string, total long")).first()
    first, second = 1000 * a * n // (parts["x"] * parts["y z"]), 1000 * a * n // (parts["x y"] * parts["z"])
    assert (row.score, row.l, row.r) == (min(first, second), parts["x y"], parts["z"])


def test_of_equal_scores_the_first_cut(spark):
    phrases = spark.createDataFrame([("en", 3, "x y z", 5)], "lang string, k long, phrase string, a long")
    counts = spark.createDataFrame([("en", "x", 6), ("en", "y z", 10), ("en", "x y", 10), ("en", "z", 6)], "lang string, phrase string, n long")
    row = collocations.scored(phrases, counts, spark.createDataFrame([("en", 100)], "lang string, total long")).first()
    assert (row.l, row.r) == (6, 10)


def test_other_columns_and_empty_tables(spark, empty):
    docs = spark.createDataFrame([("b c", "x", 1, 2, 3)] * 4, "body string, tongue string, k int, phrase int, n int")
    found = collocations.collocations(docs, "body", "tongue", least=4)
    assert rows(found) == [("x", 1, "b c", 4, 4, 4, 8, 2000)]
    assert collocations.collocations(empty).count() == 0
    nothing = spark.createDataFrame([(None, None), ("", "en"), (" .\n", "en")], "text string, lang string")
    assert collocations.collocations(nothing).count() == 0
