"""Substring dedup by prefix-partitioned suffix trees (operator 8).

A window is WINDOW consecutive words of one document.  A word goes where a
window that covers it also starts in a document with a smaller doc_id.

Documents are dealt to blocks of bounded text by a hash of their place; a block's
text is shuffled once and that exchange serves all steps:

1. Each block sends the distinct 40-bit hashes of its windows, by hash range;
   a range answers which hashes other blocks have as well.  This only sorts out
   windows that cannot repeat; it decides nothing.
2. The other windows are compared word by word, in groups.  A window belongs to
   the suffix that starts at its anchor (its word with the least hash), and goes
   to the group of that suffix's prefix: 1, 2 or 4 words within the window, as many
   as it takes until no more than GROUP windows of the corpus share the
   prefix's cell, counted beforehand, or else the whole window.  Groups thus fit
   in memory.  Neighbouring windows mostly share their anchor and travel as one
   stretch of text.  A block sends each distinct window once, with the least
   doc_id it has there, so a window in very many documents costs a row for each
   block, not one for each occurrence.
3. A group is the suffix tree of its stretches: from each word that begins a shared
   window a suffix runs to the end of its stretch (13 to 25 words).  Suffixes are
   sorted and get the lengths of the prefixes they have in common with their
   neighbours; an internal node is a run of neighbours that share so many words.
   Two suffixes that share a window share its anchor, so they meet in one group.
   The deepest node of at least WINDOW words that also holds a smaller doc_id is the
   longest repeat at a suffix; those that reach further than the suffix one
   word before are the maximal ones, which are returned.  Repeats longer than a
   stretch come out as one maximal repeat for each stretch, overlapping by
   WINDOW - 1 words.
4. Blocks mark the words of these repeats, and those of copies within the block.

The smallest document that holds a window decides, so a null doc_id counts as
larger than all others (and as alike with the largest of all ids, 2^63 - 1);
rows that repeat a doc_id don't remove each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tickfold.llm.common import text_or_empty

WINDOW = 13
#: Characters of a block of documents.
BLOCK_CHARS = 4_000_000
#: Windows that a group holds at most (but for one window's own, a row per block).
GROUP = 250_000
#: Words of the prefixes, and cells by which their windows are counted.
PREFIXES = (1, 2, 4)
CELLS = 1 << 13
LAST = 2**63 - 1
RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("kept_text", pa.string()), ("removed", pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())])))])

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


class Windows:
    """All windows of some documents, given as lists of words, in their order.

    ``pos``: the place of a window's first word among all words; ``doc``: its
    document; ``hashes``: 64 bits of its words.
    """

    def __init__(self, documents: list[list[bytes]]):
        sizes = np.array([len(x) for x in documents], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.words = [w for x in documents for w in x]
        self.of_word = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        owner = np.repeat(np.arange(len(documents), dtype=np.int32), sizes)
        n = max(0, len(self.words) - WINDOW + 1)
        self.pos = np.flatnonzero(owner[:n] == owner[len(owner) - n:])
        self.doc = owner[self.pos]
        self.hashes = self.prefixes((WINDOW,))[0][self.pos]

    def prefixes(self, lengths: tuple[int, ...]) -> list[np.ndarray]:
        """For each length, the hash of that many words from each word on (0 beyond the last)."""
        out, n = [], len(self.of_word)
        rolled = np.zeros(n, np.uint64)
        for k in range(max(lengths)):
            rolled *= _STEP
            if k < n:  # a block may have fewer words than a prefix
                rolled[:n - k] += self.of_word[k:]
            if k + 1 in lengths:
                out.append(mix(rolled + np.uint64(k)))
        return out

    def anchors(self, which: np.ndarray) -> np.ndarray:
        """The place of the word with the least hash (the first such) of each window."""
        n = max(0, len(self.of_word) - WINDOW + 1)
        least, offset = self.of_word[:n].copy(), np.zeros(n, np.int8)
        for k in range(1, WINDOW):
            h = self.of_word[k:n + k]
            offset[h < least] = k
            np.minimum(least, h, out=least)
        at = self.pos[which]
        return at + offset[at]

    def levels(self, which: np.ndarray):
        """(anchor prefix hashes, whether the window holds the prefix) by level."""
        anchor = self.anchors(which)
        room = self.pos[which] + WINDOW - anchor
        return [(h[anchor], room >= k) for k, h in zip(PREFIXES, self.prefixes(PREFIXES), strict=True)], anchor

    def groups(self, which: np.ndarray, crowded: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
        """The group and the anchor of each window."""
        levels, anchor = self.levels(which)
        key, chosen = self.hashes[which].copy(), np.zeros(len(anchor), bool)
        for (h, fits), full in zip(levels, crowded, strict=True):
            now = fits & ~chosen & ~full[(h % np.uint64(CELLS)).astype(np.int64)]
            key[now] = h[now]
            chosen |= now
        return (mix(key) % np.uint64(groups)).astype(np.int64), anchor

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The first window of each word sequence, and for each window the number of its own."""
        _, first, number = np.unique(self.hashes, return_index=True, return_inverse=True)
        same = first[number]
        ends = (self.of_word[self.pos + k] == self.of_word[self.pos[same] + k] for k in (0, WINDOW - 1))
        if not all(x.all() for x in ends):  # equal hashes of unlike windows: by the words
            seen: dict[bytes, int] = {}
            texts = [b" ".join(self.words[p:p + WINDOW]) for p in self.pos.tolist()]
            number = np.array([seen.setdefault(t, len(seen)) for t in texts], np.int64)
            _, first = np.unique(number, return_index=True)
        return first, number


class Block(Windows):
    """The windows of a block's documents, smallest id first."""

    def __init__(self, docs: pa.Table):
        order = np.argsort(docs["doc_id"].to_numpy(), kind="stable")
        self.ids = docs["doc_id"].to_numpy()[order]
        self.no_id = np.array(docs["no_id"].to_pylist(), bool)[order]
        texts = docs["text"].to_pylist()
        super().__init__([texts[i].encode().split() for i in order.tolist()])


def squeeze(values: np.ndarray) -> bytes:
    """Sorted integers below 2**40 as compressed differences."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return zstandard.compress(np.ascontiguousarray(steps[:, :5].T).tobytes(), 1)


def unsqueeze(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(5, -1)
    steps = np.zeros((raw.shape[1], 8), np.uint8)
    steps[:, :5] = raw.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def count_prefixes(batches):
    """(level, cell, n): windows of these rows by the cell of each anchor prefix."""
    counts = np.zeros((len(PREFIXES), CELLS), np.int64)
    held, size = [], 0
    for batch in batches:
        for text in batch.column(0):
            held.append(text.as_py().encode().split())
            size += len(held[-1])
            if size > 500_000:
                counts += _cells(held)
                held, size = [], 0
    counts += _cells(held)
    level, cell = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(level.astype(np.int32)), pa.array(cell.astype(np.int32)),
         pa.array(counts[level, cell])], names=["level", "cell", "n"])


def _cells(documents: list[list[bytes]]) -> np.ndarray:
    windows = Windows(documents)
    levels, _ = windows.levels(np.arange(len(windows.pos)))
    return np.stack([np.bincount((h[fits] % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
                     for h, fits in levels])


class SuffixTree:
    """Suffixes of stretches of words, sorted, with the lengths of common prefixes.

    ``codes``: the words of all stretches as numbers from 0 on, ``sizes``: how many
    each stretch has.  Suffixes with fewer than WINDOW words are no leaves.
    ``order`` sorts ``leaves`` (places in ``rank`` arrays, which have one place without
    a word after each stretch); ``lcp``: words that sorted leaves share with the next.
    """

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        ends = np.cumsum(sizes + 1) - 1
        self.end = np.repeat(ends, sizes + 1)
        self.stretch = np.repeat(np.arange(len(sizes)), sizes + 1)
        places = np.arange(len(self.end))
        words = np.zeros(len(places), np.int64)
        words[places != self.end] = codes + 1
        self.leaves = np.flatnonzero(self.end - places >= WINDOW)
        # Ranks by 1, 3, 9, ... words: three ranks side by side order three times as many.
        ranks, k = [(1, words)], 1
        while 3 * k <= sizes.max(initial=0):
            ranks.append((3 * k, np.unique(self._key(words, k, places), return_inverse=True)[1].ravel()))
            k, words = ranks[-1]
        self.order = np.argsort(self._key(words, k, self.leaves), kind="stable")
        a, b = self.leaves[self.order[:-1]], self.leaves[self.order[1:]]
        self.lcp = np.zeros(len(a), np.int64)
        for k, rank in reversed(ranks):
            for _ in range(2):
                self.lcp += k * (rank[np.minimum(a + self.lcp, self.end[a])] == rank[np.minimum(b + self.lcp, self.end[b])])
        self.lcp = np.minimum(self.lcp, np.minimum(self.end[a] - a, self.end[b] - b))

    def _key(self, rank: np.ndarray, k: int, at: np.ndarray) -> np.ndarray:
        """Numbers in the order of the 3k words from ``at`` on; ``rank`` orders k words."""
        base, key = int(rank.max(initial=0)) + 1, rank[at]
        for j in (k, 2 * k):
            if (int(key.max(initial=0)) + 1) * base >= 2**63:
                key = np.unique(key, return_inverse=True)[1].ravel()
            key = key * base + rank[np.minimum(at + j, self.end[at])]
        return key

    def maximal_repeats(self, ids: np.ndarray):
        """(stretch, first word within it, words, least id) of the maximal repeats of at
        least WINDOW words that a stretch, whose id is in ``ids``, has in common with a lesser id."""
        own = ids[self.stretch[self.leaves[self.order]]]
        depth, low = np.zeros(len(own), np.int64), own.copy()
        for d in range(WINDOW, int(self.lcp.max(initial=0)) + 1):
            node = np.flatnonzero(np.concatenate([[True], self.lcp < d]))
            least = np.repeat(np.minimum.reduceat(own, node), np.diff(np.append(node, len(own))))
            less = least < own
            if not less.any():  # nor deeper
                break
            depth[less], low[less] = d, least[less]
        words, first = np.zeros(len(self.end), np.int64), np.zeros(len(self.end), np.int64)
        at = self.leaves[self.order]
        words[at], first[at] = depth, low
        reach = np.where(words > 0, np.arange(len(words)) + words, 0)
        found = np.flatnonzero(reach > np.concatenate([[0], reach[:-1]]))
        begin = self.end[found] - np.bincount(self.stretch, minlength=len(ids))[self.stretch[found]] + 1
        return self.stretch[found], found - begin, words[found], first[found]


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the words
    left, joined by one space); with ``texts`` also ``kept_text`` and ``removed``, the
    runs of words that went (first word from 0, number of words), in order.

    A null text has no words; an empty table gives no rows.  Other columns are not read."""
    result = RESULT if texts else pa.schema([RESULT.field(i) for i in range(4)])
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).head()[0]
    n_blocks, n_groups = 1 + chars // BLOCK_CHARS, 1 + 2 * chars // (6 * GROUP)
    crowded = np.zeros((len(PREFIXES), CELLS), bool)
    counts = docs.select("text").mapInArrow(count_prefixes, "level int, cell int, n bigint")
    for level, cell in (counts.groupBy("level", "cell").agg(F.sum("n").alias("n"))
                        .filter(F.col("n") > GROUP).select("level", "cell").collect()):
        crowded[level, cell] = True  # one bit for each prefix length and cell

    def send_hashes(key, table):
        h = np.unique(Block(table).hashes >> np.uint64(24))
        ranges, at = np.unique((h >> np.uint64(10)) * np.uint64(n_groups) >> np.uint64(30), return_index=True)
        blobs = [squeeze(x) for x in np.split(h, at[1:])] if len(h) else []
        return pa.table({"grp": pa.array(ranges.astype(np.int64)), "block": pa.array([key[0].as_py()] * len(blobs), pa.int64()),
                         "blob": pa.array(blobs, pa.binary())})

    def shared_hashes(table):
        sets = [unsqueeze(x) for x in table["blob"].to_pylist()]
        every = np.sort(np.concatenate(sets))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        replies = [x[np.isin(x, twice, assume_unique=True)] for x in sets]
        return pa.table({"block": table["block"], "blob": pa.array(map(squeeze, replies), pa.binary())})

    def send_suffixes(key, table, replies):
        rows = {k: [] for k in ("grp", "block", "places", "blob")}
        known = [unsqueeze(x) for x in replies["blob"].to_pylist()]
        if known and table.num_rows:
            block = Block(table)
            first, _ = block.distinct()
            known = np.sort(np.concatenate(known))
            first = np.sort(first[np.isin(block.hashes[first] >> np.uint64(24), known)])
            group, anchor = block.groups(first, crowded, n_groups)
            pos = block.pos[first]
            # A stretch: windows in a row with the same anchor and group.
            new = np.flatnonzero((np.diff(pos, prepend=-9) != 1) | (np.diff(anchor, prepend=-9) != 0)
                                 | (np.diff(group, prepend=-9) != 0))
            n = np.diff(np.append(new, len(pos)))
            pos, group, doc = pos[new], group[new], block.doc[first[new]]
            order = np.argsort(group, kind="stable")
            _, at = np.unique(group[order], return_index=True)
            for part in np.split(order, at[1:]) if len(order) else ():
                rows["grp"].append(int(group[part[0]]))
                rows["block"].append(key[0].as_py())
                rows["places"].append(zstandard.compress(
                    np.stack([pos[part], n[part], block.ids[doc[part]]]).astype("<i8").tobytes(), 1))
                rows["blob"].append(zstandard.compress(b"\n".join(
                    [b" ".join(block.words[p:p + k + WINDOW - 1])
                     for p, k in zip(pos[part].tolist(), n[part].tolist(), strict=True)]), 1))
        return pa.table(rows, pa.schema([("grp", pa.int64()), ("block", pa.int64()),
                                         ("places", pa.binary()), ("blob", pa.binary())]))

    def subtree(table):
        places = [np.frombuffer(zstandard.decompress(x), "<i8").reshape(3, -1)
                  for x in table["places"].to_pylist()]
        words = b"\n".join(map(zstandard.decompress, table["blob"].to_pylist())).split()
        codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
        pos, n, ids = np.concatenate(places, axis=1)
        stretch, begin, size, low = SuffixTree(codes, n + WINDOW - 1).maximal_repeats(ids)
        # As the windows that a repeat is made of, by block.
        found = np.stack([pos[stretch] + begin, size - WINDOW + 1, low])
        cuts = np.searchsorted(stretch, np.cumsum([x.shape[1] for x in places])[:-1])
        rows = {"block": [], "found": []}
        for block, part in zip(table["block"].to_pylist(), np.split(found, cuts, axis=1), strict=True):
            if part.shape[1]:
                rows["block"].append(block)
                rows["found"].append(zstandard.compress(np.ascontiguousarray(part).astype("<i8").tobytes(), 1))
        return pa.table(rows, pa.schema([("block", pa.int64()), ("found", pa.binary())]))

    def finish(table, replies):
        block = Block(table)
        first, number = block.distinct()
        least = block.ids[block.doc[first]] if len(first) else np.zeros(0, np.int64)
        for found in replies["found"].to_pylist():
            pos, n, low = np.frombuffer(zstandard.decompress(found), "<i8").reshape(3, -1)
            where = np.repeat(pos - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            sent = number[np.searchsorted(block.pos, where)]
            np.minimum.at(least, sent, np.repeat(low, n))
        gone = block.pos[least[number] < block.ids[block.doc]] if len(first) else block.pos
        marks = np.zeros(len(block.words) + WINDOW + 1, np.int64)
        np.add.at(marks, gone, 1)
        np.add.at(marks, gone + WINDOW, -1)
        covered = np.cumsum(marks) > 0
        out = {k: [] for k in RESULT.names}
        for own, none, a, z in zip(block.ids.tolist(), block.no_id.tolist(), block.begin.tolist(),
                                   block.begin[1:].tolist(), strict=False):
            kept = block.words[a:z]
            if covered[a:z].any():
                kept = [kept[i] for i in np.flatnonzero(~covered[a:z]).tolist()]
            text = b" ".join(kept)
            out["doc_id"].append(None if none else own)
            out["n_words"].append(z - a)
            out["n_removed"].append(z - a - len(kept))
            out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
            if texts:
                edges = np.flatnonzero(np.diff(covered[a:z].astype(np.int8), prepend=0, append=0)).tolist()
                out["kept_text"].append(text.decode())
                out["removed"].append([{"first": i, "words": j - i} for i, j in zip(edges[::2], edges[1::2], strict=True)])
        return pa.table({k: out[k] for k in result.names}, result)

    # By place, not by value: repeated rows and null ids are spread like all others.
    blocks = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text",
                         F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks)).alias("block"))
    by_block = blocks.groupBy("block")
    shared = (by_block.applyInArrow(send_hashes, "grp bigint, block bigint, blob binary")
              .groupBy("grp").applyInArrow(shared_hashes, "block bigint, blob binary"))
    suffixes = by_block.cogroup(shared.groupBy("block")).applyInArrow(
        send_suffixes, "grp bigint, block bigint, places binary, blob binary")
    nodes = suffixes.groupBy("grp").applyInArrow(subtree, "block bigint, found binary")
    return by_block.cogroup(nodes.groupBy("block")).applyInArrow(finish, from_arrow_schema(result))
