"""Every stage of the pipeline, on its own input, against brute force."""

import re
from pathlib import Path

import corpus_pipeline
import pytest
from llm_fixtures import LOWER, WORD
from test_dedup import near_truth

from tickbars.llm import toxicity
from tickbars.llm.shared import table

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def corpus(spark, sf_dir, hard, tmp_path_factory):
    """The given tables with hard rows, a contaminated document and repeated rows."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = table(spark, sf_dir, "documents")
    item = table(spark, sf_dir, "benchmark").where("text is not null").orderBy("item_id").first()
    planted = hard.withColumn("doc_id", hard.doc_id + 1_000_000)
    leaked = spark.createDataFrame([(2_000_000, item.text, None, None, None)], hard.schema)
    docs.unionByName(planted).unionByName(leaked).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, sf_dir, name).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def outputs(spark, corpus):
    """The rows before the first stage and after each one, written and read again."""
    docs = table(spark, corpus, "documents")
    found = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{Path(corpus)}/after-{i}"
        stage(spark, found[-1], corpus).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def around(outputs, name):
    i = NAMES.index(name)
    return outputs[i], outputs[i + 1]


def test_columns_of_documents(outputs):
    assert all(after.columns == outputs[0].columns for after in outputs[:-1])


def test_toxicity(spark, corpus, outputs):
    before, after = around(outputs, "toxicity")
    model = toxicity.fit(toxicity.labelled(before, table(spark, corpus, "labels")))
    clean = toxicity.with_scores(before, model, name="score").where(f"score < {toxicity.THRESHOLD}")
    assert sorted(map(str, after.collect())) == sorted(map(str, clean.drop("score").collect()))


def test_exact_dedup(outputs):
    before, after = around(outputs, "exact dedup")
    kept = {}
    for r in before.collect():
        text = r.text or ""
        kept[text] = max(kept.get(text, -1), -1 if r.doc_id is None else r.doc_id)
    assert {r.text or "": -1 if r.doc_id is None else r.doc_id for r in after.collect()} == kept
    assert after.count() == len(kept) < before.count()


def test_near_dedup(outputs):
    before, after = around(outputs, "MinHash near-dedup")
    truth = near_truth([(r.doc_id, r.text) for r in before.collect() if r.doc_id is not None], 5)
    kept = {r.doc_id for r in after.collect()} - {None}
    assert kept == {id for id, (_, component) in truth.items() if id == component}


def contaminated(text, windows):
    words = ITEM_WORD.findall((text or "").translate(LOWER))
    hit = set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_decontamination(spark, corpus, outputs):
    before, after = around(outputs, "benchmark decontamination")
    windows = set()
    for r in table(spark, corpus, "benchmark").collect():
        words = ITEM_WORD.findall((r.text or "").translate(LOWER))
        windows |= {tuple(words[i : i + 13]) for i in range(max(len(words) - 12, 1)) if words}
    want = sorted(str(r) for r in before.collect() if not contaminated(r.text, windows))
    assert sorted(map(str, after.collect())) == want
    assert not any(r.doc_id == 2_000_000 for r in after.collect())


def test_mixing(outputs):
    before, after = around(outputs, "mixing")
    mixed = after.collect()
    assert sorted(str(r.doc_id) for r in mixed) == sorted(str(r.doc_id) for r in before.collect())
    sizes = {r.doc_id: len(WORD.findall(r.text or "")) for r in before.collect()}
    taken, target, largest = {}, {}, {}
    for r in mixed:
        assert r["size"] == sizes[r.doc_id] and 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest.get(r.source, 0), r["size"])
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] + 1 for s in target)


def test_run_repeats_the_stages(spark, corpus, outputs):
    again = corpus_pipeline.run(spark, corpus)
    assert again.columns == outputs[-1].columns
    assert sorted(map(str, again.collect())) == sorted(map(str, outputs[-1].collect()))


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, sf_dir, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
