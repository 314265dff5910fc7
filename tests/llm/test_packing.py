import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from setforge.llm.packing import B, K1, Shard, pack, pack_shard
from setforge.llm.tokens import Encoder, blocks, word_bpe


def test_pieces_put_the_documents_together(spark, documents, odd):
    coder = Encoder(word_bpe(), 1)
    rows = [*documents, *((r.doc_id, r.text) for r in odd.collect() if r.doc_id not in (1, 6))]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    ids = {d: coder.ids((t or "").encode()).astype("<u4") for d, t in rows}
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, ids string")
    for shard in (4_000_000, 5000):
        pieces = pack(df, word_bpe(), shard_ids=shard).collect()
        parts, sequences = defaultdict(dict), defaultdict(dict)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) == zlib.crc32(p.ids)
            assert p.doc_tokens == len(ids[p.doc_id]) and p.length > 0
            parts[p.doc_id][p.start] = p.length
            sequences[p.sequence_id][p.offset] = p.length
        for d, x in ids.items():
            at = 0
            while at < len(x):
                at += parts[d].pop(at)
            assert at == len(x) and not parts[d]
        for s in sequences.values():
            at = 0
            while s:
                at += s.pop(at)
            assert at <= 2048 and at & (at - 1) == 0
        again = pack(df, word_bpe(), shard_ids=shard).collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, pieces))


def test_neighbours_are_those_of_plain_bm25():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 40, rng.integers(5, 30)).astype("<u2") for _ in range(60)]
    having = np.array([sum(t in d for d in docs) for t in range(40)])
    idf = np.log1p((60 - having + 0.5) / (having + 0.5))
    mean = np.mean([len(d) for d in docs])
    shard = Shard(docs, idf, mean)

    def weight(t, d):
        tf = (docs[d] == t).sum()
        return idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(docs[d]) / mean))

    free = np.ones(60, np.int64)
    free[7] = 0
    for d in range(0, 60, 7):
        terms = sorted(set(docs[d].tolist()), key=lambda t: -weight(t, d))[:12]
        scores = {o: sum(weight(t, o) for t in terms) for o in range(60) if o != d and free[o]}
        want = sorted((o for o in scores if scores[o] > 0), key=lambda o: (-round(scores[o], 9), o))
        got = shard.neighbours(d, free)
        assert sorted(got) == sorted(want)
        assert np.allclose([scores[o] for o in got], [scores[o] for o in want])


def test_near_texts_share_a_window():
    rng = np.random.default_rng(1)
    topics = [rng.integers(k * 1000, k * 1000 + 300, (6, 100)) for k in range(8)]
    docs = [topics[i % 8][i // 8].astype("<u2") for i in range(48)]
    having = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=9000)
    windows = list(pack_shard(docs, np.log1p((48 - having + 0.5) / (having + 0.5)), 100.0, 256))
    own = sum(len({d % 8 for d, *_ in w}) for w in windows) / len(windows)
    assert own < 2  # windows cut in order would hold about three topics


def test_no_rows(spark, nothing):
    assert pack(nothing, word_bpe()).count() == 0


SPELLINGS = [
    "", " \t\n\x0b\x0c\r", "Hello, World. it's 12,5% a.b, x.. (y) foo' foo'' 'tis", "ÉTÉ straße, Naïve!? Ÿ ÿ À×Ö a÷b", "éa İstanbul ſ K ǅ ß̈ a\u0338 <\u0338",
    "a\x85b c\xa0d\x1ce f\u2028g", "x<|endoftext|>y <|ENDOFTEXT|> word<|endoftext|>. word<| |> <|endoftext|>", "数据 処理 😀😀,", "a" * 3000 + " " + "É" * 500 + "###", "same Same SAME same. Same, same###",
]


@pytest.mark.parametrize("limit", [3, 600_000])
def test_texts_of_a_block_against_the_library(documents, limit):
    coder = Encoder(word_bpe(), 1, limit=limit)
    texts = [*(t.encode() for t in SPELLINGS), None, b"broken \xff\xc3 \xe9t\xc3.", *((t or "").encode() for _, t in documents[:60])]
    want = [[*coder.tokenizer.encode((t or b"").decode("utf-8", "replace"), add_special_tokens=False).ids, 1] for t in texts]
    for kind in (pa.binary(), pa.large_binary()):
        assert [x.tolist() for x in coder.each(pa.array(texts, kind))] == want
        assert [x.tolist() for x in coder.each(pa.array([b"left out", *texts, b"as well"], kind).slice(1, len(texts)))] == want
    assert coder.each(pa.array([], pa.binary())) == []
    assert len(coder) <= limit


def test_vocabularies_that_keep_marks_at_words(monkeypatch):
    coder = Encoder(word_bpe(), 1)
    monkeypatch.setattr(coder, "parts_marks", False)
    texts = ["Hello, World.", "ÉTÉ..."]
    assert [x.tolist() for x in coder.each(pa.array([t.encode() for t in texts]))] == [[*coder.tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_a_word_is_looked_up_once_in_a_block(monkeypatch):
    coder, asked = Encoder(word_bpe(), 1), Counter()
    known = Encoder.__missing__
    monkeypatch.setattr(Encoder, "__missing__", lambda self, word: asked.update([word]) or known(self, word))
    texts = [b"common Common, common. common### rare%d" % i for i in range(500)]
    batch = pa.record_batch({"text": pa.array(texts)})
    rows = [x for part in blocks(batch, "text") for x in coder.each(part.column("text"))]
    assert len(rows) == 500 and b"common" in coder
    assert asked[b"common"] == asked[b"Common,"] == asked[b"common###"] == 0  # learned together, the forms never asked for
    assert not [w for w in coder if w.lower() != w]


def test_blocks_hold_all_rows_in_turn(monkeypatch):
    monkeypatch.setattr("setforge.llm.tokens.BLOCK", 10)
    texts = [b"", None, b"abc", b"x" * 35, b"", None, b"1234567890", b"1", b"2" * 9, b"3"]
    batch = pa.record_batch({"text": pa.array(texts, pa.binary())})
    parts = [part.column("text").to_pylist() for part in blocks(batch, "text")]
    assert [t for part in parts for t in part] == texts
    assert len(parts) > 3 and all(sum(len(t or b"") for t in part[:-1]) <= 10 for part in parts)
    assert [*blocks(batch.slice(0, 0), "text")] == []
