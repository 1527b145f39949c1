"""Token counts against the tokenizer library."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from sunledger.llm import common, token_counts

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
ALPHABET = [
    *("a", "b", "the", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", "é", "漢", "!", "..", "q", "z"),
    *("<|endoftext|>", "<|endof", " ", "　", "‍", "\x00", "\x1f", "\x85", " ", "ﬁ", "🙂"),
    # Characters that the Unicode tables of the two libraries class differently.
    *("՘", "\U0001e6c0", "\U0003d001"),
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_counts.model_path())
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture
def counter():
    return token_counts.Counter(token_counts.model_path())


def test_query_equals_the_library(spark, library):
    texts = common.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    want = {r.doc_id: (len((r.text or "").encode()), library(r.text or "")) for r in texts}
    got = token_counts.op13_token_counts(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want
    assert len(got) == len(texts)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_random_texts(counter, library):
    r = random.Random(5)
    for _ in range(4000):
        text = "".join(r.choices(ALPHABET, k=r.randint(0, 14)))
        assert counter.count(text) == library(text), text


def test_unlike_characters_are_cut_by_the_library(counter, library):
    """The pattern alone would be wrong for a text with such characters."""
    text = "x՘y 1\U0001e6c0\U0001e6c0 z"
    assert counter.count(text) == library(text)
    assert counter.unlike and counter.unlike <= set(text)


@pytest.mark.parametrize("entries", [0, 3])
def test_full_table(counter, library, monkeypatch, entries):
    monkeypatch.setattr(token_counts, "TABLE_ENTRIES", entries)
    text = " ".join(f"word{i % 7}" for i in range(50))
    assert counter.count(text) == library(text)
    assert len(counter) <= max(1, entries)


def test_long_chunks(counter, library):
    r = random.Random(3)
    letters = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=50_000))
    for text in ("a" * 100_000, "ab" * 40_000, letters, " " * 60_000, "é" * 30_000):
        assert counter.count(text) == library(text)


def test_long_chunks_are_cut_where_nothing_merges(counter):
    r = random.Random(4)
    chunk = "".join(r.choices("qxzj", k=500)).encode()
    parts = list(counter.merges.parts(chunk))
    assert b"".join(parts) == chunk and len(parts) > 1
    assert sum(map(counter.merges._merged, parts)) == counter.merges._merged(chunk)


def test_lazy_cutting_of_long_texts(counter, library, monkeypatch):
    monkeypatch.setattr(token_counts, "LIST_CHARS", 10)
    text = "Some words, 12 of them <|endoftext|>  and\n more"
    assert counter.count(text) == library(text)


def test_defined_cases(spark, library):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "same"), (3, "same"), (4, "word " * 200_000), (5, " ")]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = sorted((str(d), len((t or "").encode()), library(t or "")) for d, t in rows)
    path = token_counts.model_path()
    assert sorted((str(r[0]), r[1], r[2]) for r in token_counts.count(frame, path).collect()) == want
    clash = frame.select("*", F.lit("x").alias("n_bytes"), F.lit(1).alias("n_tokens"), F.lit(2).alias("over_limit"))
    assert sorted((str(r[0]), r[1], r[2]) for r in token_counts.count(clash, path).collect()) == want
    assert token_counts.count(spark.createDataFrame([], SCHEMA), path).collect() == []
    flagged = token_counts.count(frame, path, limit=1).where("over_limit").collect()
    assert {r.doc_id for r in flagged} == {None, 4}


def test_other_vocabularies_are_refused(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a")], SCHEMA)
    import public_tokenizers

    with pytest.raises(ValueError, match="normalises|suffix|byte-level"):
        token_counts.count(frame, public_tokenizers.path("word_bpe_49k.json"))
    with open(token_counts.model_path()) as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="pattern"):
        token_counts.count(frame, str(tmp_path / "t.json"))
