"""Token counts against the library itself, text by text."""

from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from llm_fixtures import HARD

from tickbars.llm import token_counts
from tickbars.llm.registry import op13_token_counts

MODEL = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ODD = [
    "", " ", "  ", "a", "a ", " a", "a  b ", "\n", " \n x", "a\n\n b\n", "▁a", "a▁▁b ▁c", "▁", "▁\n", "a ▁", "1 22 3a3",
    "xé　y 12\t", "<s> </s>\n<unk>", "\U0001f600\U0001f600 \u0000z", "q" * 5000, "a b " * 3000, None,
]


def counted(text):
    text = text or ""
    return len(text.encode()), len(LIBRARY.encode(text)), len(LIBRARY.encode(text)) > 4096


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("most", [1 << 21, 30, 0])
def test_counts_equal_the_librarys(spark, most):
    """All pre-tokens broadcast, the frequent ones, none; nulls, repeated rows, a null id, spaces of all kinds."""
    rows = [*enumerate(ODD), *[(row[0], row[1]) for row in HARD]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = token_counts.count_tokens(docs, MODEL, ["doc_id"], most=most)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert ordered(found.collect()) == ordered((i, *counted(text)) for i, text in rows)


def test_every_distinct_pre_token_is_counted_once(spark):
    vocabulary = token_counts.Vocabulary.of(MODEL)
    texts = spark.createDataFrame([("to be or not to be\nto be 12 12",)] * 50, "text string").repartition(5)
    rows = token_counts.distinct_pre_tokens(texts, vocabulary).collect()
    assert dict(map(tuple, rows)) == {" to": 100, " be": 150, " or": 50, " not": 50, "\nto": 50, " ": 100, "12": 100}


def test_columns_with_clashing_names(spark):
    rows = [(1, "a b", "x", 5, "y", 2.0), (2, None, None, None, None, None)]
    names = "doc_id int, body string, __row string, n_tokens int, token string, known double"
    docs = spark.createDataFrame(rows, names)
    found = token_counts.count_tokens(docs, MODEL, ["doc_id", "__row", "n_tokens", "token", "known"], text="body")
    assert found.columns == ["doc_id", "__row", "token", "known", "n_bytes", "n_tokens", "over_limit"]
    assert ordered(found.collect()) == ordered([(1, "x", "y", 2.0, 3, 2, False), (2, None, None, None, 0, 0, False)])


def test_empty_table(empty):
    assert token_counts.count_tokens(empty, MODEL, ["doc_id"]).count() == 0


def test_texts_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert ordered(token_counts.count_tokens(docs, MODEL, ["doc_id"]).collect()) == [(1, 0, 0, False), (2, 0, 0, False)]


def test_query_equals_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert ordered(op13_token_counts(spark, sf_dir).collect()) == ordered((r.doc_id, *counted(r.text)) for r in docs)
