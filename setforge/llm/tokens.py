"""Token ids of whole texts, by the tokenizers library."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter
from string import punctuation
from sys import byteorder

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters of words whose encoding needs neither normalisation nor splitting: lower-case Latin-1.
PLAIN = "".join(c for c in map(chr, range(256)) if "a" <= c <= "z" or "ß" <= c <= "ÿ" and c != "÷")
#: Words of these letters and of their upper case, ÿ aside, whose own is not Latin-1.
CASED = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
#: Longer words are not remembered; they would fill the memory and hardly come again.
LONGEST = 64
#: Bytes of texts that are encoded at a time, and words whose ids are laid out at a time.
BLOCK, LAID = 1 << 22, 1 << 17


def plain(word: str) -> bool:
    return bool(word) and not word.strip(PLAIN)


class Encoder(dict):
    """Ids of a text, as bytes, put together from the ids of its words.

    The tokenizer drops white space and never joins characters across it, so the ids of a text are those of
    its words in turn. Words seen before come from this dictionary; at ``limit`` words it starts anew and
    takes what it needs from the words before, so memory is bounded and common words stay. A
    plain word goes right to the tokenizer's BPE model, any other through the whole ``encode``; commas and
    full stops at the end of a letter word and the case of ASCII letters are taken off first, which the
    tokenizer does as well. ``each`` encodes many texts: it takes any ASCII marks and the case of Latin-1 letters
    off, asks for each word once, and gives new plain words to the model together.
    """

    def __init__(self, path: str, end_id: int, limit: int = 600_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        #: Numbers that an id can be, the end id among them.
        self.vocabulary = max(self.tokenizer.get_vocab_size(), end_id) + 1
        self.limit, self.before = limit, {}
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {ord(c): level.pre_tokenize_str(c)[0][0] for c in PLAIN}
        self.words_only = self._is_word_bpe()
        #: The model alone, for plain words between spaces; each ends with its only id of a word's end.
        self.plain_words = Tokenizer(self.model)
        self.plain_words.pre_tokenizer = CharDelimiterSplit(" ")
        suffix = getattr(self.model, "end_of_word_suffix", None)
        self.is_end = np.zeros(self.vocabulary, bool)
        self.is_end[[i for token, i in self.tokenizer.get_vocab().items() if suffix and token.endswith(suffix)]] = True
        self.parts_marks = self._parts_marks()

    def _is_word_bpe(self) -> bool:
        """Whether words can be encoded by themselves."""
        probe = "Ab, ça-va  x1\n\tNaïve. the end,"
        whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
        return whole == [i for w in probe.split() for i in self.tokenizer.encode(w, add_special_tokens=False).ids]

    def _parts_marks(self) -> bool:
        """Whether letters are lower-cased and marks behind them are encoded by themselves."""
        whole = self.tokenizer.encode("àÉÖz" + punctuation, add_special_tokens=False).ids
        return whole == [i for w in ("àéöz", punctuation) for i in self.tokenizer.encode(w, add_special_tokens=False).ids]

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.dtype.char, ids).tobytes() if byteorder == "little" else np.array(ids, self.dtype).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        self._make_room()
        if (ids := self.before.get(word)) is not None:
            self[word] = ids
            return ids
        if word.isalpha() and word.islower():  # ASCII letters, which stand for themselves at the byte level
            ids = self._pack([t.id for t in self.model.tokenize(word.decode())])
        elif b"<|" in word:  # may be a special token, which no rule here may touch
            ids = self._pack(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)
        elif (lower := word.lower()) != word:
            ids = self[lower]
        elif word[-1:] in b".," and len(word) > 1 and (word[:-1].isalpha() or plain(word[:-1].decode("utf-8", "replace"))):
            ids = self[word[:-1]] + self[word[-1:]]
        elif plain(text := word.decode("utf-8", "replace")):
            ids = self._pack([t.id for t in self.model.tokenize(text.translate(self.bytes_of))])
        else:
            ids = self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids

    def _make_room(self) -> None:
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()

    def _learn(self, words: list[bytes]) -> None:
        """Remember the ids of plain words."""
        new = [w for w in words if w not in self and w not in self.before and len(w) <= LONGEST]
        if not new:
            return
        ids = np.array(self.plain_words.encode_batch_fast([b" ".join(new).decode().translate(self.bytes_of)], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.flatnonzero(self.is_end[ids]) + 1
        if len(ends) != len(new):
            return  # no such vocabulary; they are encoded one by one
        data, ends = ids.tobytes(), (ends * self.dtype.itemsize).tolist()
        for word, begin, end in zip(new, [0, *ends], ends, strict=False):
            self._make_room()
            self[word] = data[begin:end]

    def _known(self, words: pa.Array) -> list[bytes]:
        """Ids of each of distinct words."""
        if not self.parts_marks:
            return [*map(self.__getitem__, strings(words))]
        # marks may end a special token, but then marks are before its letters, too
        heads = pc.ascii_rtrim(words, characters=punctuation)
        plain = pc.match_substring_regex(heads, CASED)
        lower = pc.utf8_lower(pc.if_else(plain, heads, pa.scalar("", words.type)))
        self._learn(strings(lower.filter(plain).unique()))
        keys = pc.if_else(plain, lower, words).dictionary_encode()
        sizes = pc.if_else(plain, pc.binary_length(heads), pc.binary_length(words))
        known = [*map(self.__getitem__, strings(keys.dictionary))]
        parts = zip(strings(words), sizes.to_numpy().tolist(), keys.indices.to_numpy().tolist(), strict=True)
        return [known[key] if size == len(word) else known[key] + self[word[size:]] for word, size, key in parts]

    def ids(self, text: bytes | None) -> np.ndarray:
        """Ids of a whole text with the end id."""
        text = text or b""
        if not self.words_only:
            return np.frombuffer(self._pack(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids) + self.end, self.dtype)
        words = text.split()
        found = itemgetter(*words)(self) if len(words) > 1 else map(self.__getitem__, words)
        return np.frombuffer(b"".join(found) + self.end, self.dtype)

    def each(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each whole text (binary; null is empty) with the end id."""
        if not self.words_only:
            return [self.ids(text.as_py()) for text in texts]
        kind = pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()
        words = pc.ascii_split_whitespace(texts.fill_null(b"").view(kind))  # gives empty words, too, which have no ids
        ends = np.cumsum(pc.list_value_length(words).to_numpy())
        coded = words.flatten().dictionary_encode()
        del words
        known = [*self._known(coded.dictionary), self.end]
        ids = np.frombuffer(b"".join(known), self.dtype)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        first = np.cumsum(sizes) - sizes
        codes = np.insert(coded.indices.to_numpy(), ends, len(known) - 1)
        del coded, known
        size = sizes[codes]
        after = np.append(0, np.cumsum(size))
        out = np.empty(after[-1], self.dtype)
        for at in range(0, len(codes), LAID):
            part = slice(at, at + LAID)
            begin = after[:-1][part]
            end = begin[-1] + size[part][-1]
            out[begin[0] : end] = ids[np.arange(begin[0], end) + np.repeat(first[codes[part]] - begin, size[part])]
        cuts = after[ends + np.arange(1, len(ends) + 1)].tolist()
        return [out[begin:end] for begin, end in zip([0, *cuts], cuts, strict=False)]


def strings(words: pa.Array) -> list[bytes]:
    """The bytes of each string, without nulls; many times faster than ``to_pylist``."""
    offsets = np.frombuffer(words.buffers()[1], np.int64 if pa.types.is_large_string(words.type) else np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    data = words.buffers()[2]
    data = data.to_pybytes() if data else b""
    return [data[begin:end] for begin, end in zip(offsets, offsets[1:], strict=False)]


def blocks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch in turn, of about BLOCK bytes of ``column`` or one row that is longer."""
    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy().astype(np.int64)
    block = (np.cumsum(size) - size) // BLOCK
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if begin < end:
            yield batch.slice(begin, end - begin)


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    """One encoder for a Python worker."""
    return Encoder(path, end_id)


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
