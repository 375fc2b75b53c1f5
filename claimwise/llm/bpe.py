"""Byte-level BPE encoding and decoding over Arrow batches with the tokenizers library.

The vocabulary's characters stand for bytes (printable bytes for themselves, the others for code points
from 256 on).  Encoding splits a text by the vocabulary's pattern and encodes every distinct piece once per
worker; offsets come from the tokens' byte lengths and the text's byte-to-character map, so characters that are
split over tokens get the same character span in each.  Decoding turns ids back into bytes through the reversed table.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwise.llm.common import short_batches

#: Texts of these characters only are split here; their classes are the same in all Unicode versions that the
#: libraries carry.  Any other text is split by the tokenizers library itself.
STEADY = regex.compile("[\x00-՗‐-‧‰-⁞€ぁ-ゖァ-ヺ一-龥가-힣]*")
#: Pieces that a task remembers, and the longest it remembers.
PIECES, PIECE_CHARS = 500_000, 40
#: Characters of the texts that are split at once.
GROUP_CHARS = 1_000_000


def byte_characters() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the rest follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Encoder and decoder of one vocabulary file of the tokenizers library."""

    def __init__(self, vocabulary: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        to_byte = byte_characters()
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes = [bytes(to_byte[c] for c in n) if all(c in to_byte for c in n) else n.encode() for n in names]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}  # piece -> its ids, 32 bits each

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _group(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = [self.split(t) if STEADY.fullmatch(t) else None for t in texts]
        wanted: set[str] = set().union(*[p for p in split if p])
        new = list(wanted.difference(self.known))
        if len(self.known) + len(new) > PIECES:  # what is in use now is remembered on
            self.known = {p: self.known[p] for p in wanted if p in self.known}
        late = dict(zip(new, self._encoded(new), strict=True))
        self.known.update((p, ids) for p, ids in late.items() if len(p) <= PIECE_CHARS)
        late = {p: ids for p, ids in late.items() if len(p) > PIECE_CHARS}
        for text, pieces in zip(texts, split, strict=True):
            if pieces is None:
                ids = self._encoded([text])
            elif late:
                ids = [late[p] if p in late else self.known[p] for p in pieces]
            else:
                ids = map(self.known.__getitem__, pieces)
            yield np.frombuffer(b"".join(ids), np.uint32)

    def encode_batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in groups of about ``GROUP_CHARS`` characters."""
        group, chars = [], 0
        for text in texts:
            group.append(text)
            chars += len(text)
            if chars >= GROUP_CHARS:
                yield from self._group(group)
                group, chars = [], 0
        yield from self._group(group)

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last character of each token; a split character counts to every token that holds a part of it."""
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1  # byte -> character
        ends = np.cumsum(self.lengths[ids])
        return char[ends - self.lengths[ids]], char[ends - 1] + 1

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that form no whole character become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def _loaded(vocabulary: str, pattern: str) -> Codec:
    return Codec(vocabulary, pattern)


def codec(vocabulary: str, pattern: str) -> Codec:
    """The worker process's codec of a vocabulary, loaded once; what it remembers of texts is forgotten."""
    c = _loaded(vocabulary, pattern)
    c.known = {}
    return c


def encode(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array<long>) and, if asked for, ``starts`` and ``ends`` (array<int>, characters).

    Null and empty texts get empty arrays.  Texts of any length are encoded whole; rows are independent of each
    other.  Input columns called like the new ones are replaced."""
    kind = "struct<ids:array<bigint>,starts:array<int>,ends:array<int>>"

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(vocabulary, pattern)
        for texts in batches:
            texts = [t if isinstance(t, str) else "" for t in texts]
            ids = list(c.encode_batch(texts))
            spans = [c.offsets(t, i) for t, i in zip(texts, ids, strict=True)] if offsets else [((), ())] * len(ids)
            yield pd.DataFrame({"ids": [i.astype(np.int64) for i in ids], "starts": [s[0] for s in spans], "ends": [s[1] for s in spans]})

    short_batches(docs.sparkSession)
    out = docs.withColumn("ids", run(F.col(text_col)))
    if offsets:
        return out.withColumns({"starts": F.col("ids.starts"), "ends": F.col("ids.ends"), "ids": F.col("ids.ids")})
    return out.withColumn("ids", F.col("ids.ids"))


def decode(df: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (string): the text of ``ids_col``; null ids give the empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(vocabulary, pattern)
        for ids in batches:
            yield pd.Series([c.decode(np.asarray(x, np.int64)) if x is not None else "" for x in ids], dtype=object)

    short_batches(df.sparkSession)
    return df.withColumn("decoded", run(F.col(ids_col)))


def digests(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", into: str = "coded") -> DataFrame:
    """``docs`` with one added struct column ``into``: ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (the decoded bytes).

    Encodes and decodes in one pass over Arrow batches, so that the ids are not moved.  Null text: as empty (no
    tokens, digests of nothing).  Repeated rows give repeated results; an empty table an empty result."""

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(vocabulary, pattern)
        for texts in batches:
            out = [(len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(c.decode_bytes(ids)).hexdigest())
                   for ids in c.encode_batch([t if isinstance(t, str) else "" for t in texts])]
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    short_batches(docs.sparkSession)
    return docs.withColumn(into, run(F.col(f"`{text_col}`")))
