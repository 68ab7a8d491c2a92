"""Harmonic packing of tokenised documents into fixed-length sequences.

A document's ids are cut into whole sequences and a rest; the rest is cut into
pieces of half, a quarter, an eighth .. of a sequence, down to ``GRAIN`` ids, and one
last piece shorter than that. A piece of length in (C/(k+1), C/k] is of harmonic
class k, and a bin of class k takes exactly k pieces. With pieces of C/2, C/4 .. such
a bin is full, so only the last pieces cause padding. Every task fills its own bins;
what it has left at the end goes together, longest first, into shared bins.

Null texts count as empty and hold the end id alone. Repeated rows and rows without
doc_id are packed like any other. Extra columns are not read. A lost task is run
again over the same split, which gives the same bins and ids of sequences.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import session_limits, slices, table

CAPACITY, GRAIN = 1024, 16
SPECIAL = "<|endoftext|>"
#: A space before white space or the end: there the pieces between spaces aren't independent.
LOOSE = re.compile(r" (?:\s|\Z)")
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Ids of many texts at once, equal to the tokenizer file's own.

    The vocabulary splits texts before every space that stands before other text, so
    each distinct word is encoded once a batch and its ids are copied to all places.
    Texts in which that doesn't hold are encoded whole; those that spell a special
    token go to the tokenizer file itself.
    """

    def __init__(self, ranks_path: str, tokenizer_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.n_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.n_bytes[rank] = len(token)
        self.tokenizer_path, self._slow = tokenizer_path, None

    def whole(self, text: str) -> np.ndarray:
        if SPECIAL in text:
            if self._slow is None:
                from tokenizers import Tokenizer

                self._slow = Tokenizer.from_file(self.tokenizer_path)
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if " " not in text or SPECIAL in text or LOOSE.search(text):
                out[i] = self.whole(text)
            else:
                plain.append(i)
        if not plain:
            return out
        heads, tails = zip(*(texts[i].split(" ", 1) for i in plain))
        split = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
        ends = split.offsets.to_numpy()
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary
        joined = " " + " ".join(distinct.to_pylist())
        ids = np.array(self.fast.encode_ordinary(joined), dtype=np.uint32)
        at = np.concatenate(([0], np.cumsum(pc.binary_length(distinct).to_numpy().astype(np.int64) + 1)))
        cuts = np.searchsorted(np.concatenate(([0], np.cumsum(self.n_bytes[ids]))), at)
        n_ids = np.diff(cuts)
        codes = words.indices.to_numpy()
        counts = n_ids[codes]
        stops = np.concatenate(([0], np.cumsum(counts)))
        flat = ids[np.arange(stops[-1]) + np.repeat(cuts[codes] - stops[:-1], counts)]
        for k, i in enumerate(plain):
            tail = flat[stops[ends[k]] : stops[ends[k + 1]]]
            out[i] = np.concatenate((np.array(self.fast.encode_ordinary(heads[k]), dtype=np.uint32), tail))
        return out


def cut(n: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    out, rest, size = [capacity] * (n // capacity), n % capacity, capacity // 2
    while rest >= grain and size >= grain:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


class Bins:
    """Open bins of every harmonic class, and the sequence number of the next."""

    def __init__(self, first: int, capacity: int = CAPACITY):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list] = {}

    def add(self, piece: tuple, length: int) -> list[tuple]:
        """Rows (piece, sequence, offset) of the bin that this piece fills, if it does."""
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append((piece, length))
        return self._close(self.open.pop(k)) if len(held) == k else []

    def _close(self, held: list) -> list[tuple]:
        rows, at = [], 0
        for piece, length in held:
            rows.append((piece, self.next, at))
            at += length
        self.next += 1
        return rows

    def rest(self) -> list[tuple]:
        """First-fit decreasing over what is left: at most a bin's worth of pieces a class."""
        left = sorted((x for held in self.open.values() for x in held), key=lambda x: -x[1])
        bins: list[list] = []
        room: list[int] = []
        for piece, length in left:
            i = next((i for i, r in enumerate(room) if r >= length), len(bins))
            if i == len(bins):
                bins.append([])
                room.append(self.capacity)
            bins[i].append((piece, length))
            room[i] -= length
        self.open = {}
        return [row for b in bins for row in self._close(b)]


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """One row a piece of every document of ``docs`` (doc_id, text); see SCHEMA."""
    import public_tokenizers

    session_limits(docs.sparkSession)
    paths = public_tokenizers.path(f"{tokenizer}.tiktoken"), public_tokenizers.path(f"{tokenizer}.json"), public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*paths)
        bins = Bins(TaskContext.get().partitionId() << 40, capacity)

        def rows(found: list[tuple]) -> pa.RecordBatch:
            cols = [[f[0][0] for f in found], *([f[0][i] for f in found] for i in range(1, 5)), [f[1] for f in found], [f[2] for f in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in slices(batches, "text", 8 << 20):
            found: list[tuple] = []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.batch(texts)):
                raw = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                n, start = len(raw) // 4, 0
                for length in cut(n, capacity):
                    found += bins.add((doc_id, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), n), length)
                    start += length
            yield rows(found)
        yield rows(bins.rest())

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
