"""Cases that once gave wrong or unbounded results."""

import json

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import base, rows
from pyspark.sql import functions as F

from tickbars.llm import chat, decontaminate, language_id, lm_scoring, near_dedup, toxicity


@pytest.mark.parametrize("n", range(1, 9))
def test_no_control_string_is_left_inside_a_text(n):
    text = "#" * n + " Assistant: x</turn>" + "#" * n
    inside = chat.escaped(text)
    assert "###" not in inside and "</turn>" not in inside and chat.unescaped(inside) == text
    whole, spans = chat.formatted([("user", text), ("assistant", text)])
    assert chat.read_back(whole) == [("user", text), ("assistant", text)]
    assert whole.count(chat.OPEN) == whole.count(chat.CLOSE) == 2
    assert [chat.unescaped(whole[a:b]) for a, b in spans] == [text]


LAYOUTS = [
    ({"messages": [{"role": "human", "content": "a"}, {"role": "gpt", "content": "#### b"}]}, [("user", "a"), ("assistant", "#### b")]),
    ({"instruction": "do", "input": "it", "output": "done"}, [("user", "do\n\nit"), ("assistant", "done")]),
    ({"prompt": "p", "response": ""}, [("user", "p"), ("assistant", "")]),
    ({"turns": [{"turn": 2, "role": "assistant", "text": "two " * 100_000}, {"turn": 1, "role": "user", "text": ""}]},
     [("user", ""), ("assistant", "two " * 100_000)]),
    ({"other": 1}, []),
]


def test_chats_of_all_layouts_against_their_turns(spark):
    """From JSON to the digests, over more rows than are Python objects at a time, a long text and a clashing column."""
    records = [(i, json.dumps(LAYOUTS[i % 5][0]), "x") for i in range(700)] + [(700, None, "y"), (701, "no json", "y"), (702, "[1]", None)]
    frame = spark.createDataFrame(records, "conv_id long, record string, n_turns string").repartition(2)
    chats = chat.with_format(chat.canonical_turns(frame).select("conv_id", "turns"))
    found = {r.conv_id: r for r in chat.digests(chats, ["conv_id"]).collect()}
    assert len(found) == 703
    for i in range(703):
        turns = LAYOUTS[i % 5][1] if i < 700 else []
        loss = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        wanted = (len(turns), chat._sha256(whole), len(loss), chat._sha256(loss))
        assert (found[i].n_turns, found[i].turns_sha256, found[i].loss_chars, found[i].loss_sha256) == wanted


def test_chats_of_nothing(spark):
    nothing = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    chats = chat.with_format(chat.canonical_turns(chat.records_of_rows(nothing)).select("conv_id", "turns"))
    assert chat.digests(chats, ["conv_id"]).count() == 0


@pytest.mark.parametrize("most", [4_000_000, 0])
def test_large_item_ids_beside_a_null_one(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", most)
    items = spark.createDataFrame([(9007199254740993, "one two three"), (None, "four five"), (2**62 + 1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "zero one two three"), (2, "four five six"), (3, None)], "doc_id long, text string")
    found = decontaminate.with_hits(docs, items).select("doc_id", "items", F.size("spans"))
    assert rows(found) == [(1, [9007199254740993, 2**62 + 1], 1), (2, [], 1), (3, [], 0)]


def test_repeated_ids_do_not_add_to_the_language_sample(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE", 40)
    taken = []
    trained = language_id.trained
    monkeypatch.setattr(language_id, "trained", lambda data, *rest: taken.append(len(data)) or trained(data, *rest))
    texts = [(1, "the house of the river", "en")] * 400 + [(i, "das haus an dem fluss", "de") for i in range(400)]
    model = language_id.fit(spark.createDataFrame(texts, "id long, text string, lang string").repartition(4))
    assert model.languages == ["de", "en"] and taken[0] <= 40


@pytest.mark.parametrize("kind", [0, 1])
def test_labels_of_one_kind_drop_nothing(spark, kind):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, kind) for i in range(10)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.labelled(docs, labels))
    assert toxicity.drop_toxic(docs, model).count() == 50


def test_labels_joined_by_a_shuffle_are_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 40, f"text {i}") for i in range(60)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 30, i % 2 if i % 5 else None) for i in range(70)], "doc_id long, toxic int")
    sent = rows(toxicity.labelled(docs, labels))
    monkeypatch.setattr(toxicity, "MOST_BROADCAST", 0)
    assert rows(toxicity.labelled(docs, labels)) == sent


def test_calibration_of_many_points(spark):
    points = np.linspace(0, 1, 1500)
    model = toxicity.Model(toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros(0)), 0.5, None, points.tolist(), (points**2).tolist())
    frame = spark.range(101).select((F.col("id") / 100).alias("raw"))
    found = [r[0] for r in frame.select(toxicity._calibrated(F.col("raw"), model)).collect()]
    assert np.allclose(found, np.interp(np.arange(101) / 100, points, points**2))


def test_levels_read_one_by_one():
    """The filter's levels against probing every level of every sequence by itself."""
    random = np.random.default_rng(5)
    size, bits = 4 * lm_scoring._SEGMENT, np.zeros(4 * lm_scoring._SEGMENT, bool)
    hashes = random.integers(1 << 63, size=3000).astype(np.uint64)
    high = random.integers(0, 6, size=3000)

    def probes(h, level):
        first, step = lm_scoring.places(np.array([h], np.uint64), level)
        at = int(lm_scoring.segment_of(np.array([h], np.uint64), size)[0]) * lm_scoring._SEGMENT
        return [at + (int(first[0]) + i * int(step[0])) % lm_scoring._SEGMENT for i in range(lm_scoring.PROBES)]

    for h, n in zip(hashes, high, strict=True):
        for level in range(1, n + 1):
            bits[probes(h, level)] = True
    model = lm_scoring.Model(1, 1, 1, size, np.packbits(bits), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    wanted = []
    for h in hashes:
        level = 0
        while all(bits[probes(h, level + 1)]):
            level += 1
        wanted.append(level)
    assert model.level(hashes).tolist() == wanted
    assert (np.array(wanted) >= high).all()


def test_units_are_counted_once_a_text(spark):
    docs = spark.createDataFrame([("ab ab ab", 1), ("ab", 0), ("", 1), (None, 0)], "text string, toxic int").coalesce(1)
    unit = toxicity._units(toxicity._split(pa.array(["ab"])), toxicity._PLAIN[toxicity._split(pa.array(["ab"])).data])[0]
    found = {r.unit: (r.bad, r.good) for r in toxicity.counts_by_label(docs).collect()}
    assert found[int(unit.view(np.int64)[0])] == (1, 1)


def test_an_id_with_two_texts_has_the_links_of_both(spark):
    a, b = base(60), base(60, 500)
    docs = [(1, a), (5, a + " x"), (5, b), (9, b + " y"), (9, b + " y"), (20, base(60, 900)), (20, ""), (21, None), (30, b + " z"), (40, "other words")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.mark_near_copies(frame).collect()}
    assert found == {
        (1, 56): (1, True), (5, 57): (1, False), (5, 56): (1, False), (9, 57): (1, False), (20, 56): (20, True), (20, 0): (20, True),
        (21, 0): (21, True), (30, 57): (1, False), (40, 1): (40, True),
    }
    assert sorted(r.doc_id for r in near_dedup.drop_near_copies(frame).collect()) == [1, 20, 20, 21, 40]


def test_a_component_of_ids_with_two_texts_alone(spark):
    a, b, c = base(60), base(60, 500), base(60, 900)
    docs = [(7, a), (7, b), (8, b + " x"), (8, c), (9, c + " y"), (9, a + " y")]
    found = near_dedup.mark_near_copies(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id, r.kept) for r in found.collect()} == {(7, 7, True), (8, 7, False), (9, 7, False)}


def test_joined_hits_of_a_text_of_hits_alone(spark, monkeypatch):
    """A long text that is nothing but hits, with gaps and touching windows: the same runs by either way, in seconds."""
    item, long_ = base(40), " ".join([base(40), "gap"] * 3000)
    items = spark.createDataFrame([(1, item), (2, base(20, 20)), (3, "w5 w6 w7"), (4, "w7 w8")], "item_id long, text string")
    docs = spark.createDataFrame([(1, long_), (2, f"x {item} {item} y w5 w6 w7 w8"), (3, "w7 w8 w7 w8"), (4, "none")], "doc_id long, text string")
    sent = rows(decontaminate.with_hits(docs, items).select("doc_id", "n_words", "spans", "items"))
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 0)
    assert rows(decontaminate.with_hits(docs, items).select("doc_id", "n_words", "spans", "items")) == sent
    assert len(next(r for r in sent if r[0] == 1)[2]) == 3000 and next(r for r in sent if r[0] == 3)[2] == [(0, 4)]
