"""Ids of whole texts, put together from the ids of parts that are remembered.

A text is cut before its blanks, and a chunk's closing marks and line breaks are
parts of their own.  Which texts may be cut so is up to the vocabulary: see
``UNSAFE`` and the two users, ``packing.Encoder`` and ``alignment.pieces``.
Chunks are split off, told apart and put together again as Arrow columns; Python
handles only the different chunks of a call, the vocabulary only new parts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts whose ids are remembered, unless told otherwise.
CACHE = 500_000
#: A blank before white space or the end, and what marks a part without a blank.
UNSAFE = re.compile(r" (?=\s|\Z)|\0")
#: Closing marks; after a letter or digit, none of them is joined to what is before.
MARKS = ".,!?;:"


def cut_after(c: str) -> bool:
    """A letter or digit by every Unicode version in use: at most two bytes of UTF-8."""
    return c < "\u0530" and (c.isalpha() or c.isdecimal())


#: ``cut_after`` by a character's last two bytes; before one of a single byte stands any below 0x80 or above 0xBF.
CUT_AFTER = np.zeros((256, 256), bool)
for _c in filter(cut_after, map(chr, range(0x530))):
    _b = _c.encode()
    CUT_AFTER[_b[0] if len(_b) > 1 else slice(None), _b[-1]] = True


def keys(chunk: str, blank: bool) -> list[str]:
    """The parts of a chunk: as they are if a blank is before them, else after a NUL."""
    lines = chunk.split("\n")
    if len(lines) > 1 and (not all(lines) or any(x[-1].isspace() for x in lines[:-1])
                           or any(x[0].isspace() for x in lines[1:])):
        lines = [chunk]
    out = []
    for line in lines:
        if out:
            out.append("\0\n")
        head = line.rstrip(MARKS)
        if not head or not cut_after(head[-1]):
            head = line
        out.append(head if blank and not out else "\0" + head)
        if len(head) < len(line):
            out.append("\0" + line[len(head):])
    return out


class Remembered:
    """``whole(texts)`` and ``parts(keys)`` give the ids of each, as native 32-bit bytes.

    Texts in which ``unsafe`` is found are not cut; without ``unsafe``, none is.
    """

    def __init__(self, whole: Callable, parts: Callable, unsafe: re.Pattern | None = UNSAFE, most: int = CACHE):
        self.whole, self.parts, self.unsafe, self.most = whole, parts, unsafe, most
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        self.known.update(zip(new, self.parts(new), strict=True))

    def _ids(self, parts: list[str]) -> list[bytes]:
        found = list(map(self.known.get, parts))
        missing = [i for i, x in enumerate(found) if x is None]
        self._learn([parts[i] for i in missing])
        for i in missing:
            found[i] = self.known[parts[i]]
        return found

    def _odd_ids(self, chunks: list[str], blank: bool) -> list[bytes]:
        cut = [keys(x, blank) for x in chunks]
        self._learn(list({x for k in cut for x in k if x not in self.known}))
        return [b"".join([self.known[x] for x in k]) for k in cut]

    def _after_blank(self, chunks: pa.Array) -> pa.ListArray:
        """Ids of different chunks after a blank: most are one part, or one and a mark."""
        heads = pc.utf8_rtrim(chunks, MARKS)
        sizes = pc.binary_length(chunks).to_numpy()
        marks = sizes - pc.binary_length(heads).to_numpy()
        upto = np.cumsum(sizes)
        data = np.concatenate([np.zeros(2, np.uint8), utf8(chunks)])  # byte i is at i + 2
        marked = (marks == 1) & (sizes > 1) & CUT_AFTER[data[upto - 1], data[upto]]
        odd = pc.match_substring(chunks, "\n").to_numpy(zero_copy_only=False) | ((marks > 0) & ~marked)
        marked &= ~odd

        parts = pc.if_else(pa.array(marked), heads, chunks).filter(pa.array(~odd)).dictionary_encode()
        n = len(parts.dictionary)
        places = np.zeros((len(chunks), 2), np.int32)
        places[~odd, 0] = parts.indices.to_numpy()
        places[odd, 0] = n + np.arange(odd.sum())
        mark_ids = [b"", *self._ids(["\0" + x for x in MARKS])]
        of_mark = np.zeros(256, np.int32)
        of_mark[list(MARKS.encode())] = np.arange(len(MARKS)) + 1
        places[:, 1] = n + odd.sum() + np.where(marked, of_mark[data[upto + 1]], 0)
        ids = listed([*self._ids(parts.dictionary.to_pylist()),
                      *self._odd_ids(chunks.filter(pa.array(odd)).to_pylist(), True), *mark_ids])
        both = ids.take(pa.array(places.ravel()))
        return pa.ListArray.from_arrays(both.offsets.take(pa.array(np.arange(0, 2 * len(chunks) + 1, 2))), both.values)

    def _joined(self, texts: list[str]) -> pa.ListArray:
        """Ids of texts that may be cut."""
        if len(self.known) > self.most:
            self.known.clear()
        chunks = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        ends = chunks.offsets.to_numpy()
        every = chunks.values.dictionary_encode()
        later = np.ones(ends[-1], bool)
        later[ends[:-1]] = False  # a text's first chunk has no blank before it
        own = np.zeros(len(every.dictionary), bool)
        own[every.indices.to_numpy()[later]] = True
        first = chunks.values.take(pa.array(ends[:-1])).dictionary_encode()
        at = np.zeros(ends[-1], np.int32)
        at[later] = (np.cumsum(own) - 1)[every.indices.to_numpy()[later]]
        at[~later] = own.sum() + first.indices.to_numpy()
        ids = pa.concat_arrays([self._after_blank(every.dictionary.filter(pa.array(own))),
                                listed(self._odd_ids(first.dictionary.to_pylist(), False))]).take(pa.array(at))
        return pa.ListArray.from_arrays(ids.offsets.take(pa.array(ends)), ids.values)

    def __call__(self, texts: list[str]) -> pa.ListArray:
        safe = [self.unsafe is not None and not self.unsafe.search(x) for x in texts]
        if all(safe):
            return self._joined(texts) if texts else listed([])
        if not any(safe):
            return listed(self.whole(texts))
        both = pa.concat_arrays([self._joined([x for x, ok in zip(texts, safe, strict=True) if ok]),
                                 listed(self.whole([x for x, ok in zip(texts, safe, strict=True) if not ok]))])
        order = np.argsort(np.argsort(np.logical_not(safe), kind="stable"))
        return both.take(pa.array(order))


def listed(found: list[bytes]) -> pa.ListArray:
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array(np.frombuffer(b"".join(found), np.int32)))


def utf8(strings: pa.Array) -> np.ndarray:
    """The bytes of an unsliced large string array, one after the other."""
    data = strings.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
