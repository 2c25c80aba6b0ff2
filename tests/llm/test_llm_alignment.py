"""Alignment of two tokenizers: against a token-by-token version."""

import random

import duckdb
import pytest

import brute
from netpulse.llm import token_alignment
from netpulse.llm.catalog import QUERIES, public_vocabulary

PARTS = [" ", "  ", "\n", "\n\n", " \n", "\n ", "a", "the", "é", "日本", "'s", "▁", "\t", "\r", "\x00", "!", "...", "1234", "<|endoftext|>",
         "<0x0A>", "<s>", "x" * 70, "　", "ﬁ", "\U0001f600", "\x85", "don", " return", "\xa0", "ß"]


@pytest.fixture(scope="module")
def sides():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    path, (ranks, pattern) = public_vocabulary()
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return slow, pieces, token_alignment.byte_letters(), token_alignment.Vocabularies(path, public_tokenizers.path("piece_bpe_32k.model"), ranks, pattern)


def aligned(docs, vocabularies, **given):
    return sorted((tuple(r) for r in token_alignment.align_tokens(docs, vocabularies, **given).collect()), key=str)


def test_alignment_of_the_table(spark, sf_dir, sides):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    found = sorted((tuple(r) for r in QUERIES["op12_token_alignment"](spark, sf_dir).collect()), key=str)
    short = {d for d, t in texts if len(t or "") < 20_000}
    expected = brute.token_alignment(texts, *sides[:3])
    assert len(short) > 0.8 * len(texts) and found == expected


@pytest.mark.parametrize("broadcast_pairs", [1_000_000, 0])
def test_alignment_of_odd_texts(spark, sides, broadcast_pairs):
    """Blanks of every kind, special strings, other scripts, copies, missing ids and texts; both ways to look up counts."""
    random.seed(2)
    texts = ["".join(random.choices(PARTS, k=random.randint(0, 12))) for _ in range(700)]
    rows = [(i // 2, t) for i, t in enumerate(texts)] + [(None, "the end"), (None, None), (7, None), (8, "")] + [(9, "the same text")] * 50
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, copies int, key string").repartition(5)
    assert aligned(docs, sides[3], broadcast_pairs=broadcast_pairs) == brute.token_alignment(rows, *sides[:3])


def test_alignment_of_long_texts_and_small_memory(spark, sides, monkeypatch):
    rows = [(1, "word " * 30_000), (2, "x" * 40_000), (3, "y \n" * 20_000 + "\tz")]
    found = aligned(spark.createDataFrame(rows, "doc_id long, text string"), sides[3])
    assert [r[0] for r in found] == [1, 2, 3] and all(r[3] == r[4] > 0 for r in found)
    assert found[0][1:4] == (30_001, 30_001, 30_001)
    monkeypatch.setattr(token_alignment, "REMEMBERED", 3)
    memory = token_alignment.Memory(token_alignment.Aligner(sides[3]))
    for _ in range(3):
        m = token_alignment.measured(["the cat sat on the mat", "", "a b c d e"], memory)
        assert (m.n_a.tolist(), m.digests[1]) == ([6, 0, 5], "") and m.counts[: m.starts[1]].sum() == m.links[0]


def test_alignment_of_an_empty_table(spark, sides):
    assert aligned(spark.createDataFrame([], "doc_id long, text string"), sides[3]) == []
