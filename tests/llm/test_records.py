import zlib

import numpy as np
import pytest
from conftest import SF

from setforge.llm.common import new_folder
from setforge.llm.records import frame, masked, op1_token_records, read_frame, read_shuffled, scan_records, with_start, write_index, write_records
from setforge.llm.tokens import Encoder, word_bpe


@pytest.fixture(scope="module")
def coder():
    return Encoder(word_bpe(), 1, limit=50)


def whole(coder, text):
    return [*coder.tokenizer.encode(text, add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("text", ["", "Hello, World. it's 12,5% a.b, x..", "ÉTÉ straße, naïve. Ünïcode", "éa İstanbul ſ ǅ", "a\x85b c\xa0d e", "x<|endoftext|>y <|ENDOFTEXT|>", "don't they'll 'tis ''s", "数据 処理 😀😀,"])
def test_words_give_the_ids_of_the_whole_text(coder, text):
    assert coder.ids(text.encode()).tolist() == whole(coder, text)


def test_whole_documents(coder, documents):
    for _, text in documents[:60]:
        assert coder.ids((text or "").encode()).tolist() == whole(coder, text or "")


def test_frame_round_trip_and_damage():
    for doc_id, ids in ((7, np.array([1, 2, 65535], "<u2")), (None, np.array([70000], "<u4")), (-3, np.array([], "<u2"))):
        data = frame(doc_id, ids) + b"\n"
        got, back, after = read_frame(memoryview(data), 0)
        assert (got, back.tolist(), after) == (doc_id, ids.tolist(), len(data))
        for at in range(len(data) - 1):
            broken = bytearray(data)
            broken[at] ^= 1
            with pytest.raises(ValueError):
                read_frame(memoryview(bytes(broken)), 0)
    assert masked(b"") == 0xA282EAD8


def test_query_against_whole_encoding(spark, coder, documents):
    start = 0
    got = {r.doc_id: r for r in op1_token_records(spark, SF).collect()}
    assert len(got) == len(documents)
    for doc_id, text in sorted(documents):
        ids = whole(coder, text or "")
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_odd_rows_and_shuffled_reads(spark, coder, odd, nothing):
    folder = new_folder(spark, "t")
    write_records(odd, f"{folder}/d", word_bpe(), files=3)
    write_index(spark, f"{folder}/d", f"{folder}/i")
    rows = with_start(spark.read.parquet(f"{folder}/i")).orderBy("start").collect()
    ids = [r.doc_id for r in rows]
    assert ids == [None, None, 1, 1, 2, 3, 4, 5, 6, 6]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    got = read_shuffled(spark, f"{folder}/d", f"{folder}/i", seed=3).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, len(r.ids)) for r in got) == sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in rows)
    long = next(r.ids for r in got if r.doc_id == 5)
    assert long == whole(coder, "word " * 3000)
    write_records(nothing, f"{folder}/n", word_bpe(), files=2)
    assert scan_records(spark, f"{folder}/n").count() == 0
