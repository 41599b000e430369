"""Hierarchical multi-length packing (operator 7).

A document's ids are its tokens and one end id.  Its full 2048-id windows leave
at once; the rest is routed to the smallest context size (tier) that holds it.
Long windows are closed first: each takes a rest of its own tier, then the
largest shorter rests that fit its gap, then the head of one more, cut to fit.
What the long windows don't need is packed the same way into windows of its
own, shorter tier.  Windows are thus always full; what a task has left at its
end leaves in windows of falling powers of two, so nothing is padded.

Packing needs no shuffle: each task packs its own rows and holds a bounded
buffer of them.  A task that is run again packs the same rows the same way.
Windows of a tier are dealt to step groups of equal token counts.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from functools import lru_cache
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.chunks import CACHE, Remembered
from tickfold.llm.common import text_or_empty

MAX_LENGTH = 2048
TIERS = (256, 512, 1024, 2048)
END = np.array([1], "<u4")
#: Ids that a task holds back before it packs them.
BUFFER_IDS = 1 << 19
#: Ids of a full step group.
STEP_IDS = 1 << 16

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, tier int, step_group bigint")
ARROW = pa.schema([(n, pa.int32() if t == "int" else pa.int64())
                   for n, t in (x.split() for x in SCHEMA.split(", "))])


@lru_cache(1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    return found


class Encoder:
    """Ids of whole texts, as little-endian 32-bit unsigned bytes.

    The vocabulary's splitting rule joins one blank to what follows and looks
    no further, so where every blank is followed by something else than white
    space, a text may be cut before its blanks and the ids of parts remembered.
    By the same rule, a mark after a letter or digit and a line break between other
    characters than white space begin a part.  Other texts are encoded as they are.
    """

    def __init__(self, path: str, most: int = CACHE):
        self.tokenizer = _tokenizer(path)
        self.lists = Remembered(self._encode, self._encode_parts, most=most)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of texts that are a blank and letters: strung together, they are
        split before each blank again, and the library says which ids are whose."""
        strings = [words[at:at + 512] for at in range(0, len(words), 512)]
        out: list[bytes] = []
        for own, found in zip(strings, self.tokenizer.encode_batch(
                ["".join(x) for x in strings], add_special_tokens=False), strict=True):
            ids, of = array("I", found.ids).tobytes(), np.array(found.word_ids)
            at = [*(4 * np.flatnonzero(np.diff(of, prepend=-1))).tolist(), len(ids)]
            out += [ids[a:b] for a, b in pairwise(at)] if len(at) == len(own) + 1 else self._encode(own)
        return out

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        words = [x for x in parts if x.isalpha()]
        others = [x for x in parts if not x.isalpha()]
        found = dict(zip(words, self._encode_words([" " + x for x in words]), strict=True))
        found.update(zip(others, self._encode([x[1:] if x[:1] == "\0" else " " + x for x in others]), strict=True))
        return [found[x] for x in parts]

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for x in self.lists(texts).to_numpy(zero_copy_only=False)]


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path)


class Rest:
    """A stretch of one document that is not packed yet."""

    __slots__ = ("doc_id", "ids", "start", "total")

    def __init__(self, doc_id, start, ids, total):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, ids, total

    def cut(self, n: int) -> tuple[Rest, Rest]:
        return (Rest(self.doc_id, self.start, self.ids[:n], self.total),
                Rest(self.doc_id, self.start + n, self.ids[n:], self.total))


class Packer:
    def __init__(self, partition: int):
        self.base = partition << 40
        self.sequences = 0
        self.rows: list[tuple] = []
        self.step_ids = dict.fromkeys([1 << k for k in range(12)], 0)
        self.held: list[tuple[int, int, Rest]] = []  # sorted by length
        self.held_ids = 0
        self.number = 0

    def hold(self, rest: Rest) -> None:
        self.number += 1
        self.held_ids += len(rest.ids)
        insort(self.held, (len(rest.ids), self.number, rest))

    def take(self, at: int) -> Rest:
        rest = self.held.pop(at)[2]
        self.held_ids -= len(rest.ids)
        return rest

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, full = len(ids), len(ids) // MAX_LENGTH * MAX_LENGTH
        for at in range(0, full, MAX_LENGTH):
            self.emit([Rest(doc_id, at, ids[at:at + MAX_LENGTH], total)], MAX_LENGTH)
        if full < total:
            self.hold(Rest(doc_id, full, ids[full:], total))
        if self.held_ids >= BUFFER_IDS:
            self.pack()

    def emit(self, pieces: list[Rest], tier: int) -> None:
        self.step_ids[tier] += tier
        step = (self.step_ids[tier] - 1) // STEP_IDS * 16 + tier.bit_length()
        offset = 0
        for p in pieces:
            self.rows.append((p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.total,
                              self.base + self.sequences, offset, tier, self.base + step))
            offset += len(p.ids)
        self.sequences += 1

    def pack(self) -> None:
        """Close full windows, the longest tier first; what is left stays held."""
        for low, tier in zip((0, *TIERS)[-2::-1], TIERS[::-1], strict=True):
            while True:
                end = bisect_right(self.held, tier, key=lambda x: x[0])
                if not end or self.held[end - 1][0] <= low or self.held_ids < tier:
                    break
                window = [self.take(end - 1)]
                gap = tier - len(window[0].ids)
                while gap and self.held:
                    fit = bisect_right(self.held, gap, key=lambda x: x[0]) - 1
                    if fit >= 0:
                        window.append(self.take(fit))
                        gap -= len(window[-1].ids)
                        continue
                    head, tail = self.take(bisect_left(self.held, gap, key=lambda x: x[0])).cut(gap)
                    self.hold(tail)
                    window.append(head)
                    gap = 0
                if gap:
                    for rest in window:
                        self.hold(rest)
                    break
                self.emit(window, tier)

    def finish(self) -> None:
        self.pack()
        while self.held:
            tier = min(MAX_LENGTH, 1 << (self.held_ids.bit_length() - 1))
            window, gap = [], tier
            while gap:
                rest = self.take(len(self.held) - 1)
                if len(rest.ids) > gap:
                    rest, tail = rest.cut(gap)
                    self.hold(tail)
                window.append(rest)
                gap -= len(rest.ids)
            self.emit(window, tier)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of ``docs``; see SCHEMA.

    ``tokenizer`` is a file of the tokenizers library on every executor.  A
    null text has only the end id; a null doc_id is kept as null; rows that
    repeat are packed each; an empty table gives no rows.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches):
        encoder, packer = encoder_of(path), Packer(TaskContext.get().partitionId())
        for batch in batches:
            for at, n in slices(batch.column(1)):
                ids = batch.column(0).slice(at, n).to_pylist()
                texts = batch.column(1).slice(at, n).to_pylist()
                found = encoder.lists(texts)
                flat, ends = found.values.to_numpy().astype("<u4"), found.offsets.to_pylist()
                for doc_id, a, b in zip(ids, ends, ends[1:], strict=False):
                    packer.add(doc_id, np.append(flat[a:b], END))
                if len(packer.rows) >= 20_000:
                    yield packer.batch()
        packer.finish()
        yield packer.batch()

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return docs.mapInArrow(run, SCHEMA)


def slices(texts: pa.Array, most: int = 8_000_000):
    """(start, rows) of stretches of about ``most`` bytes of text."""
    at, size = 0, 0
    for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
        size += n
        if size >= most:
            yield at, i + 1 - at
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts) - at
