"""Encoding of a whole corpus with a public byte-level BPE tokenizer, by tree reduction.

A text is halved until its parts are short; parts are encoded alone, and neighbours are joined: the text around the seam
is encoded again in a growing window until, on both sides, a cut between pre-tokens of the window falls on a cut that
the part already had. Pre-tokens are found from left to right, without memory, and looking at most LOOK characters
ahead, so what lies beyond such cuts can no longer change, and the joined ids equal those of the whole text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the public tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# How far ahead of its end the choice of a pre-token of PATTERN can depend on the text, with one to spare.
LOOK = 4


class TreeEncoder:
    """Encodes texts with the ranks in a file, as a tree over parts of at most ``leaf`` characters."""

    def __init__(self, path: str, pattern: str = PATTERN, leaf: int = 1024, window: int = 64) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.enc = tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.find, self.leaf, self.window = regex.compile(pattern).findall, leaf, window
        self.ids_of = lru_cache(1 << 16)(lambda piece: tuple(self.enc.encode_ordinary(piece)))
        self.bytes_of = {i: b for b, i in ranks.items()}

    def _flat(self, text: str, start: int) -> tuple[list[int], list[tuple[int, ...]]]:
        """The places where the pre-tokens of ``text`` start, and their ids; ``start`` is the place of the text."""
        at, ids = [], []
        for piece in self.find(text):
            at.append(start)
            ids.append(self.ids_of(piece) if len(piece) < 64 else tuple(self.enc.encode_ordinary(piece)))
            start += len(piece)
        return at, ids

    def _join(self, text: str, left: tuple, right: tuple, seam: int, end: int) -> tuple:
        (la, li), (ra, ri) = left, right
        k = len(la) - 1
        while k > 0 and la[k] > seam - LOOK:
            k -= 1
        known = {at: j for j, at in enumerate(ra)}
        size = self.window
        while True:
            to = min(seam + size, end)
            wa, wi = self._flat(text[la[k] : to], la[k])
            if to == end:
                return la[:k] + wa, li[:k] + wi
            for n, at in enumerate(wa):
                if at > to - LOOK:
                    break
                if at >= seam and (j := known.get(at)) is not None:
                    return la[:k] + wa[:n] + ra[j:], li[:k] + wi[:n] + ri[j:]
            size *= 2

    def _tree(self, text: str, start: int, end: int) -> tuple:
        if end - start <= self.leaf:
            return self._flat(text[start:end], start)
        seam = (start + end) // 2
        return self._join(text, self._tree(text, start, seam), self._tree(text, seam, end), seam, end)

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; none for an empty or null one."""
        if not text:
            return []
        if len(text) <= self.leaf:
            return self.enc.encode_ordinary(text)
        return [i for ids in self._tree(text, 0, len(text))[1] for i in ids]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, joined as bytes."""
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", errors="replace")


@lru_cache(4)
def encoder(path: str) -> TreeEncoder:
    """One encoder a Python worker."""
    return TreeEncoder(path)


def vocabulary_path(folder: str = TOKENIZERS, name: str = VOCABULARY) -> str:
    """Where the vocabulary lies; ``folder`` must be there on every executor."""
    return os.path.join(folder, name)


def encode_corpus(df: DataFrame, id_col: str, text_col: str, path: str | None = None) -> DataFrame:
    """``id_col`` and ids (array of int): every row once, its text encoded without special tokens.

    Null and empty texts give an empty list; a blank one the ids of its blanks. Strings that look like special tokens
    are ordinary text. Equal rows come out as often as they go in. Texts of any length are encoded whole, and give what
    the tokenizer gives for the whole text. Columns besides the two are not used. One pass, no shuffle.
    """
    file = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(file)
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                rows = batch.slice(part, 512)
                ids = [enc.encode(t) for t in rows.column(1).to_pylist()]
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.fromiter((i for x in ids for i in x), np.int32, offsets[-1])
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(offsets, flat)], ["__id", "ids"])

    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(run, f"__id {kind}, ids array<int>").withColumnRenamed("__id", id_col)
