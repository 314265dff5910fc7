import random

import pytest
from conftest import ODD, SF
from pyspark.sql import functions as F

from setforge.llm.bpe import MergeCounter, byte_bpe, op12_token_counts, with_token_counts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(byte_bpe())
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def lowest_rank_first(ranks, piece):
    """Merging by scanning all pairs each time."""
    symbols = list(piece)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in ranks]
        if not found:
            return len(symbols)
        _, i = min(found)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


def test_merging_against_scanning():
    counter = MergeCounter(byte_bpe())
    rng = random.Random(0)
    for _ in range(400):
        piece = "".join(rng.choice("aaabbtheĠinrs") for _ in range(rng.randrange(0, 60)))
        assert counter.merged(piece) == lowest_rank_first(counter.ranks, piece)


ALPHABETS = [
    "ab ", "the cat's we'll I'M  \n", " \t\n\x0b\x0c\r\x1c\x1d\x1f\x85\xa0 ​　᠎x", "aé日本😀ß̈ 1२½²Ⅷ", "'stremdl v", "<|endoftext> ",
    "0123456789 .,;:!?", "\x00\x01\x7f ab", "ªºʰǅͅ۝͸\U0001e030 a",
]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_texts_against_library(library, alphabet):
    counter = MergeCounter(byte_bpe(), limit=50)
    rng = random.Random(alphabet)
    for size in [0, 1, 2, 3, *range(4, 200, 3)]:
        for _ in range(8):
            text = "".join(rng.choice(alphabet) for _ in range(size))
            assert counter.count(text) == library(text), repr(text)


def test_special_strings(library):
    counter = MergeCounter(byte_bpe())
    for text in ("<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", " <|endoftext|>\n\n x", "x  <|endoftext|>  "):
        assert counter.count(text) == library(text)


def test_long_piece(library):
    text = "".join(random.Random(1).choice("etaoinshrdlu") for _ in range(60000))
    assert MergeCounter(byte_bpe()).count(text) == library(text)


def test_query_against_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = op12_token_counts(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), library(text))
        assert r.over_limit == (r.n_tokens > 512)


def test_odd_rows(spark, library, odd, nothing):
    clash = odd.withColumn("n_tokens", F.lit("mine")).withColumn("over_limit", F.lit(1))
    out = with_token_counts(clash, byte_bpe(), limit=10)
    assert out.columns == [*odd.columns, "n_bytes", "n_tokens", "over_limit"]
    rows = out.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), library(r.text or ""))
    assert with_token_counts(nothing, byte_bpe()).count() == 0


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        MergeCounter(public_tokenizers.path("word_bpe_49k.json"))


def test_common_words_outlive_rare_ones(library, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(12))
    text = "".join(f" {word()} common, {word()}-{word()}" for _ in range(400))
    merged, asked = MergeCounter.merged, []
    monkeypatch.setattr(MergeCounter, "merged", lambda self, piece: asked.append(piece) or merged(self, piece))
    counter = MergeCounter(byte_bpe(), limit=60)
    assert counter.count(text) == library(text)
    assert asked.count("Ġcommon") == 1 and asked.count(",") == 1
    assert max(len(counter.chunk_counts), len(counter.piece_counts)) <= 60


def test_letters_and_marks_against_library(library):
    counter = MergeCounter(byte_bpe(), limit=1000)
    for head in ("", " ", "  ", "\n", "\t "):
        for word in ("the", "The", "don't", "x1", "é", ""):
            for tail in ("", ".", "...", ",;", "!?", ".'s", ".a", ". ", "\n"):
                text = f"{head}{word}{tail}"
                assert counter.count(text) == library(text), repr(text)


def test_blocks_against_library(library, monkeypatch):
    text = "".join(random.Random(3).choice(["word", " ", "  ", "\n", "\x1c", "1", ",", "'s", "é"]) for _ in range(3000))
    for block in (1, 2, 7, 100):
        monkeypatch.setattr("setforge.llm.bpe.BLOCK", block)
        assert MergeCounter(byte_bpe()).count(text) == library(text)
