"""Token counts of byte-level BPE vocabularies by merging on a heap and a linked list, without ids.

A piece of text starts as a list of its bytes. The adjacent pair of the lowest rank, the leftmost among equals,
is merged until no pair has a rank; a count is the number of bytes less that of merges.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: White space and then everything up to the next white space. Pieces never go on from other characters into
#: white space, so a text may be cut there. U+001C to U+001F are white space to Python, not to the tokenizer.
CHUNK = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
#: Where a text may be cut: behind other characters, before white space.
CUT = re.compile(r"[\S\x1c-\x1f](?=[^\S\x1c-\x1f])")
#: A chunk that is a piece of letters, and one of marks or none; any other one goes to the pre-tokenizer.
LETTERS = re.compile(r"( ?[A-Za-z]+)([.,;:!?]*)")
#: A space, written as the pre-tokenizer does.
SPACE = "\u0120"
#: Characters of a text that are cut into chunks at a time.
BLOCK = 1 << 20
#: Longer chunks are not remembered; they would fill the memory and hardly come again.
LONGEST = 64


class Remembered(dict):
    """Counts by string, computed when first asked for. At ``limit`` entries it starts anew and takes what it needs from
    the entries before, so memory is bounded and common ones stay."""

    def __init__(self, compute: Callable[[str], int], limit: int):
        self.compute, self.limit, self.before = compute, limit, {}

    def __missing__(self, name: str) -> int:
        count = self.before.get(name)
        if count is None:
            count = self.compute(name)
        if len(name) <= LONGEST:
            if len(self) >= self.limit:
                self.before = dict(self)
                self.clear()
            self[name] = count
        return count


class MergeCounter:
    """Token counts of texts for a tokenizer file of byte-level BPE.

    Counts of chunks and pieces seen before come from two dictionaries of at most ``limit`` new and as many former
    entries; counts don't depend on them.
    """

    def __init__(self, path: str, limit: int = 300_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = {k: v for k, v in split.items() if k in ("type", "add_prefix_space", "use_regex")}
        odd = [t for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
        unused = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if model["type"] != "BPE" or plain != {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} or spec["normalizer"] or odd or any(map(model.get, unused)):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.chunk_counts, self.piece_counts = Remembered(self._chunk, limit), Remembered(self.merged, limit)

    def merged(self, piece: str) -> int:
        """Tokens of one piece, written with one character for each byte."""
        symbols = list(piece)
        size, rank_of = len(symbols), self.ranks.get
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        # a pair is one number, its rank first and then its place, so that the least is popped first
        pairs = [None if rank is None else rank * size + i for i, rank in enumerate(map(rank_of, zip(symbols, symbols[1:], strict=False)))]
        heap = [pair for pair in pairs if pair is not None]
        heapify(heap)
        pairs.append(None)
        left = size
        while heap and left > 1:
            pair = heappop(heap)
            i = pair % size
            if pairs[i] != pair:
                continue  # one of the two has been merged since
            j = after[i]
            symbol = symbols[i] = symbols[i] + symbols[j]
            pairs[i] = pairs[j] = None
            k = after[i] = after[j]
            left -= 1
            if k < size:
                before[k] = i
                if (rank := rank_of((symbol, symbols[k]))) is not None:
                    pairs[i] = pair = rank * size + i
                    heappush(heap, pair)
            if (h := before[i]) >= 0:
                pairs[h] = None
                if (rank := rank_of((symbols[h], symbol))) is not None:
                    pairs[h] = pair = rank * size + h
                    heappush(heap, pair)
        return left

    def _chunk(self, chunk: str) -> int:
        letters = LETTERS.fullmatch(chunk)
        if letters is None:
            known = self.piece_counts
            return sum([known[piece] for piece, _ in self.pieces(chunk)])
        if letters[2]:
            known = self.chunk_counts
            return known[letters[1]] + known[letters[2]]
        return self.merged(chunk.replace(" ", SPACE))

    def _ordinary(self, text: str) -> int:
        known, total, at = self.chunk_counts.__getitem__, 0, 0
        while at < len(text):
            cut = CUT.search(text, at + BLOCK)
            end = cut.end() if cut else len(text)
            total += sum(map(known, CHUNK.findall(text, at, end)))
            at = end
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings in it are one token each, as is the library's default."""
        if self.special is None:
            return self._ordinary(text)
        total = at = 0
        for match in self.special.finditer(text):
            total += self._ordinary(text[at : match.start()]) + 1
            at = match.end()
        return total + self._ordinary(text[at:] if at else text)


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One counter for a Python worker."""
    return MergeCounter(path)


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def with_token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``docs`` (text) with n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    ``path`` is the tokenizer file's place on the workers. Null texts count as empty: 0 bytes, 0 tokens. Bytes that are not UTF-8
    count as the replacement character. Rows stay as they are, repeated ones too; columns of ``docs`` named like
    a new one are replaced. An empty table gives no rows.
    """

    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(path).count
        for texts in batches:
            yield pa.array((count(text.as_py().decode("utf-8", "replace")) for text in texts), pa.int64(), size=len(texts))

    tokens = F.arrow_udf(counts, "long")
    text = F.coalesce(F.col("text"), F.lit(""))
    own = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    rows = docs.select(*own, F.octet_length(text).cast("long").alias("n_bytes"), tokens(text.cast("binary")).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the byte-level vocabulary of 50,000 merges, against a window of 512."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_counts(docs, byte_bpe()).select("doc_id", "n_bytes", "n_tokens", "over_limit")
