"""Packing by concatenate and cut.

The first pass turns every document into token ids with an end id and writes them with
their place inside the partition. Partition totals give every partition its global
offset by a prefix sum, and the second pass cuts the stream into windows of fixed
length, with one record for each part of a document in a window.

Defined results: a null text is empty, an empty text is the end id alone. Repeated rows
are packed as often as they occur; a null id is kept. No rows give no pieces. Only
``doc_id`` and ``text`` are read, so further columns of any name do not matter. The
order of the stream is the order of the partitions read, so it follows the input files.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import join_small, ship, stage

_SLICE_ROWS = 256
LONG_RUN = 100_000
_LONG_BLANKS = re.compile(rf"\s{{{LONG_RUN},}}")


class Encoder:
    """Token ids of texts under a byte-level vocabulary file of the ``tokenizers`` library.

    The vocabulary runs in ``tiktoken``, which gives the same ids in a third of the time.
    The first texts of every encoder are compared with ``tokenizers`` itself. Texts with
    ``LONG_RUN`` blanks in a row, which exhaust the pattern matcher of ``tiktoken``, go to
    ``tokenizers``, as does any other text that ``tiktoken`` fails on, and texts that hold an
    added token (``<|endoftext|>``), which is one id there.
    """

    CHECKED = 4

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        special = {t.content for t in self.slow.get_added_tokens_decoder().values()}
        self.added = tuple(special)
        to_byte = _bytes_of_signs()
        ranks = {
            bytes(to_byte[c] for c in token): i for token, i in self.slow.get_vocab().items() if token not in special
        }
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        small = self.slow.get_vocab_size() <= 1 << 16
        self.dtype, self.code = ("<u2", "H") if small else ("<u4", "I")
        self.checked = 0

    def _slow_ids(self, text: str) -> list[int]:
        return self.slow.encode(text, add_special_tokens=False).ids

    def _needs_slow(self, text: str) -> bool:
        return any(t in text for t in self.added) or (len(text) >= LONG_RUN and _LONG_BLANKS.search(text) is not None)

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            try:
                ids = self._slow_ids(text) if self._needs_slow(text) else self.fast.encode_ordinary(text)
            except (KeyboardInterrupt, SystemExit, GeneratorExit):
                raise
            except BaseException:  # a panic of the compiled encoder is no Exception
                ids = self._slow_ids(text)
            if self.checked < self.CHECKED:
                self.checked += 1
                if ids != self._slow_ids(text):
                    raise ValueError("tiktoken and tokenizers disagree on this vocabulary")
            out.append(array(self.code, ids).tobytes())
        return out


def _bytes_of_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in byte-level vocabularies, reversed."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, reused by its tasks."""
    return Encoder(path)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


TOKENS = "doc_id bigint, part int, local bigint, n_tokens bigint, ids binary"


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Ids of every document and its offset inside its partition; to be written before use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, own = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        end = np.array([end_id], own.dtype).tobytes()
        for whole in batches:
            for begin in range(0, whole.num_rows, _SLICE_ROWS):
                batch = whole.slice(begin, _SLICE_ROWS)
                ids = [x + end for x in own.encode(batch.column("text").to_pylist())]
                counts = np.array([len(x) for x in ids], np.int64) // len(end)
                local = at + np.cumsum(counts) - counts
                at += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.full(len(ids), part, np.int32)), pa.array(local),
                     pa.array(counts), pa.array(ids, pa.binary())],
                    names=["doc_id", "part", "local", "n_tokens", "ids"],
                )

    ship(docs.sparkSession)
    return docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")
    ).mapInArrow(run, TOKENS)


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def pieces(tokens: DataFrame, length: int = 1024, with_ids: bool = False) -> DataFrame:
    """Cut the stream of a written ``tokenized`` table into windows of ``length`` ids.

    ``with_ids`` adds the ids of each piece as an array, for a training reader.
    """
    totals = stage(tokens.groupBy("part").agg(F.sum("n_tokens").alias("total")), "pack-totals")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, _SLICE_ROWS):
                yield _cut(whole.slice(begin, _SLICE_ROWS), length, with_ids)

    placed = join_small(tokens, bases, ["part"], totals.count(), 16).select(
        "doc_id", (F.col("base") + F.col("local")).alias("place"), "n_tokens", "ids"
    )
    return placed.mapInArrow(run, PIECES + (", ids array<bigint>" if with_ids else ""))


def _cut(batch: pa.RecordBatch, length: int, with_ids: bool) -> pa.RecordBatch:
    place, tokens = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "n_tokens"))
    first = place // length
    count = np.maximum((place + tokens - 1) // length - first + 1, 0)
    row = np.repeat(np.arange(len(place)), count)
    sequence = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    begin = np.maximum(sequence * length, place[row])
    end = np.minimum((sequence + 1) * length, place[row] + tokens[row])
    start, size = begin - place[row], end - begin
    crc, lists, held, ids = np.zeros(len(row), np.int64), [], -1, None
    column = batch.column("ids")
    for i in range(len(row)):
        if row[i] != held:
            held, raw = row[i], column[int(row[i])].as_buffer()
            ids = np.frombuffer(raw, "<u2" if raw.size == 2 * tokens[held] else "<u4").astype("<u4")
        part = ids[start[i] : start[i] + size[i]]
        crc[i] = zlib.crc32(part.tobytes())
        if with_ids:
            lists.append(part.astype(np.int64))
    arrays = [
        batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(size), pa.array(crc),
        pa.array(tokens[row]), pa.array(sequence), pa.array(begin - sequence * length),
    ]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        arrays.append(pa.array(lists, pa.list_(pa.int64())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def packed(docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """All documents in sequences of ``length`` ids: one row per piece of a document."""
    return pieces(stage(tokenized(docs, tokenizer, end_id), "pack-tokens"), length, with_ids)
