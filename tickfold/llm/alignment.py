"""Token alignment of two tokenizers (operator 13).

Both tokenizers cut the same bytes (a space and the text).  Where tokens of both
end, the text is cut into groups; tokens whose byte ranges overlap are linked.

Inside a task a block of documents is handled as Arrow columns: ids and their
parent documents by list flatten, token ends by cumulative sums that start again
in each document, shared ends by an Acero hash join on (document, end), links by
filling each end back to the token that covers it, and the counts of linked id
pairs by ``Table.group_by``.  Every block leaves one row per document and one per
id pair of its own.

Spark merges the pair counts of all blocks, and each block then asks for the
corpus-wide counts of just the pairs it holds: a pair is joined once a block, not
once a link, and texts are encoded once.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.chunks import CACHE, MARKS, UNSAFE, Remembered, cut_after
from tickfold.llm.common import stored, text_or_empty
from tickfold.llm.packing import Encoder, slices

#: Bytes of text of a block; a longer text is a block of its own.
BLOCK_BYTES = 3_000_000
#: An id pair is a_id * ID_SPACE + b_id.
ID_SPACE = 1 << 20

#: Texts that are not cut: UNSAFE, and any with the letter that stands for a blank.
BLANK_LETTER = re.compile(UNSAFE.pattern + "|▁")
#: Between ids of a side, sides of a group, and groups.
SEPARATORS = [pa.scalar(x, pa.large_string()) for x in ",|;"]

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
FIRST = ("block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
         "groups_sha256 string, groups string, places array<int>, times array<int>, "
         "place int, pair bigint, n bigint")
RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
          "count_sum bigint, groups_sha256 string")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 for itself, the others by the next letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Encodes texts; knows the bytes of each id as an Arrow array."""

    def __init__(self, entries: list[bytes], encode):
        self.bytes = pa.array(entries, pa.large_binary())
        self.lengths = pc.cast(pc.binary_length(self.bytes), pa.int64())
        self.encode = encode


@lru_cache(1)
def byte_level(path: str) -> Vocabulary:
    encoder, letters = Encoder(path, CACHE // 2), byte_letters()
    known = encoder.tokenizer.get_vocab(with_added_tokens=True)
    entries = [b""] * (max(known.values()) + 1)
    for word, i in known.items():
        entries[i] = bytes(letters[c] for c in word)

    return Vocabulary(entries, lambda texts: wide(encoder.lists([" " + x for x in texts])))


def wide(ids: pa.ListArray) -> pa.ListArray:
    return pa.ListArray.from_arrays(ids.offsets, pc.cast(ids.values, pa.int64()))


def cuttable(model) -> bool:
    """Whether a text's tokens are those of its parts (see ``chunks``): the text is taken as it is,
    and no piece that merges could give goes on where one part ends and the next begins."""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:  # needs protobuf, which the library itself doesn't
        return False
    proto = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    norm, kind, piece = proto.normalizer_spec, proto.trainer_spec, proto.SentencePiece
    return (norm.name == "identity" and not norm.precompiled_charsmap and norm.add_dummy_prefix
            and norm.escape_whitespaces and not norm.remove_extra_whitespaces
            and kind.model_type == kind.BPE and not kind.treat_whitespace_as_suffix
            and all(x.type in (piece.NORMAL, piece.BYTE, piece.UNKNOWN, piece.CONTROL) for x in proto.pieces)
            and len(model.encode("\n")) == 2
            and not any("▁" in x.piece.lstrip("▁") or "\n" in x.piece
                        or any(c in MARKS and cut_after(before) for before, c in pairwise(x.piece))
                        for x in proto.pieces if x.type == piece.NORMAL))


@lru_cache(1)
def pieces(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    entries = [bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]

    def whole(texts: list[str]) -> list[bytes]:
        """The library adds the blank that these texts begin with."""
        return [array("i", x).tobytes() for x in model.encode([x[1:] for x in texts], num_threads=1)]

    def parts(keys: list[str]) -> list[bytes]:
        """A part without a blank is encoded after a line break, two tokens with the blank added."""
        found = model.encode([x.replace("\0", "\n", 1) for x in keys], num_threads=1)
        return [array("i", x[2:] if k[:1] == "\0" else x).tobytes() for k, x in zip(keys, found, strict=True)]

    known = Remembered(whole, parts, BLANK_LETTER if cuttable(model) else None, CACHE // 2)
    return Vocabulary(entries, lambda texts: wide(known([" " + x for x in texts])))


def only(ids: pa.ListArray, keep: np.ndarray) -> pa.ListArray:
    """``ids`` with the lists of all others made empty."""
    lengths = np.where(keep, pc.list_value_length(ids).to_numpy(), 0)
    flat = pc.list_flatten(ids).filter(pa.array(keep).take(pc.list_parent_indices(ids)))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), flat)


def encoded(texts: list[str | None], vocabularies: tuple[Vocabulary, Vocabulary]) -> list[pa.ListArray]:
    """The ids of both; none of texts that are null, empty or not given back byte by byte."""
    raw = [b" " + x.encode() if x else b"" for x in texts]
    sizes = np.array([len(x) for x in raw], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    found, right = [], sizes > 0
    for v in vocabularies:
        ids = only(v.encode([x or "" for x in texts]), sizes > 0)
        parents = pc.list_parent_indices(ids).to_numpy()
        lengths = pc.take(v.lengths, pc.list_flatten(ids)).to_numpy()
        made = np.bincount(parents, lengths, len(raw)).astype(np.int64)
        taken = pc.take(v.bytes, pc.list_flatten(ids)).buffers()[2]  # all bytes, one after the other
        joined = taken.to_pybytes()[:made.sum()] if taken else b""
        if joined != b"".join(raw) or (made != sizes).any():
            at = np.concatenate([[0], np.cumsum(made)])
            right &= np.array([joined[at[i]:at[i + 1]] == x for i, x in enumerate(raw)], bool)
        found.append(ids)
    return [only(ids, right) for ids in found] if (right != (sizes > 0)).any() else found


def ends(ids: pa.ListArray, v: Vocabulary, side: str) -> pa.Table:
    """Of each token: its document, where it ends in it, its place among all tokens."""
    doc = pc.list_parent_indices(ids)
    lengths = pc.take(v.lengths, pc.list_flatten(ids))
    upto = pc.cumulative_sum(lengths).to_numpy()
    offsets = ids.offsets.to_numpy()
    before = np.concatenate([[0], upto])[offsets[:-1]]  # bytes of the block before each document
    end = upto - before[doc.to_numpy()]
    return pa.table({"doc": pc.cast(doc, pa.int64()), "end": end, side: np.arange(len(end))})


def linked(a: pa.ListArray, b: pa.ListArray, va: Vocabulary, vb: Vocabulary) -> dict[str, np.ndarray]:
    """The links of a block in order: document, places of both tokens, and whether a group ends here."""
    both = ends(a, va, "a").join(ends(b, vb, "b"), keys=["doc", "end"], join_type="full outer", use_threads=False)
    both = both.sort_by([("doc", "ascending"), ("end", "ascending")])
    cut = pc.and_(pc.is_valid(both["a"]), pc.is_valid(both["b"]))
    # Where only one ends, the other's token is the one that ends next; a document's last end is shared.
    return {"doc": both["doc"].to_numpy(), "cut": cut.to_numpy(),
            "a": pc.fill_null_backward(both["a"]).to_numpy(), "b": pc.fill_null_backward(both["b"]).to_numpy()}


def group_texts(a: pa.ListArray, b: pa.ListArray, links: dict[str, np.ndarray], n_groups: np.ndarray) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of each document: the ids of its groups."""
    sides = []
    for ids, side in ((a, "a"), (b, "b")):
        ends_at = np.concatenate([[0], links[side][links["cut"]] + 1])
        words = pc.cast(pc.list_flatten(ids), pa.large_string())
        sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), words), SEPARATORS[0]))
    groups = pc.binary_join_element_wise(*sides, SEPARATORS[1])
    of = pa.array(np.concatenate([[0], np.cumsum(n_groups)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(of, groups), SEPARATORS[2])


def block_rows(block: int, doc_ids: pa.Array, texts: pa.Array, va: Vocabulary, vb: Vocabulary,
               keep_groups: bool) -> list[pa.RecordBatch]:
    """The rows of FIRST: one per document, then one per id pair of the block."""
    n = len(texts)
    a, b = encoded(texts.to_pylist(), (va, vb))
    links = linked(a, b, va, vb)
    n_links = np.bincount(links["doc"], minlength=n)
    n_groups = np.bincount(links["doc"], links["cut"], n).astype(np.int64)
    groups = group_texts(a, b, links, n_groups)
    sums = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in groups.to_pylist()]

    pair = (pc.list_flatten(a).to_numpy()[links["a"]] * ID_SPACE + pc.list_flatten(b).to_numpy()[links["b"]])
    own = pa.table({"doc": links["doc"], "pair": pair, "n": np.ones(len(pair), np.int64)}).group_by(
        ["doc", "pair"], use_threads=False).aggregate([("n", "sum")]).sort_by("doc")
    places = own["pair"].combine_chunks().dictionary_encode()
    counts = own.group_by("pair", use_threads=False).aggregate([("n_sum", "sum")])
    order = pc.index_in(counts["pair"], value_set=places.dictionary)
    at = pa.array(np.searchsorted(own["doc"].to_numpy(), np.arange(n + 1)), pa.int32())

    empty = lambda kind, k: pa.nulls(k, kind)
    lists = [pa.ListArray.from_arrays(at, x) for x in (
        pc.cast(places.indices, pa.int32()), pc.cast(own["n_sum"].combine_chunks(), pa.int32()))]
    names = [x.split()[0] for x in FIRST.split(", ")]
    docs = [pa.array([block] * n, pa.int64()), pc.cast(doc_ids, pa.int64()),
            *[pa.array(x, pa.int64()) for x in (pc.list_value_length(a), pc.list_value_length(b), n_groups, n_links)],
            pa.array(sums, pa.string()), pc.cast(groups, pa.string()) if keep_groups else empty(pa.string(), n),
            *lists, empty(pa.int32(), n), empty(pa.int64(), n), empty(pa.int64(), n)]
    k = len(counts)
    ints = pa.list_(pa.int32())
    asks = [pa.array([block] * k, pa.int64()), *[empty(pa.int64(), k)] * 5, *[empty(pa.string(), k)] * 2,
            *[empty(ints, k)] * 2, pc.cast(order, pa.int32()).combine_chunks(),
            counts["pair"].combine_chunks(), counts["n_sum_sum"].combine_chunks()]
    return [pa.RecordBatch.from_arrays(docs, names=names), pa.RecordBatch.from_arrays(asks, names=names)]


def _sums(docs: pa.Table, answers: pa.Table, keep_groups: bool) -> pa.Table:
    """One block: the documents' sums over their links, from the counts of its pairs."""
    order = pc.sort_indices(answers["place"])
    count = answers["count"].take(order).to_numpy()
    best = answers["best"].take(order).to_numpy()
    docs = docs.combine_chunks()
    places, times = docs["places"].combine_chunks(), docs["times"].combine_chunks()
    n = pc.list_flatten(times).to_numpy().astype(np.int64)
    at = pc.list_flatten(places).to_numpy()
    upto = np.concatenate([[0], np.cumsum(pc.list_value_length(places).to_numpy())])

    def total(values):
        sums = np.concatenate([[0], np.cumsum(values)])
        return pa.array(sums[upto[1:]] - sums[upto[:-1]], pa.int64())

    return pa.table({"doc_id": docs["doc_id"], **{c: docs[c] for c in COUNTS},
                     "n_best": total(best[at] * n), "count_sum": total(count[at] * n),
                     "groups_sha256": docs["groups_sha256"], **({"groups": docs["groups"]} if keep_groups else {})})


def align(docs: DataFrame, a: str | None = None, b: str | None = None, keep_groups: bool = False) -> DataFrame:
    """One row per document: the columns of RESULT, and with ``keep_groups`` its ``groups``.

    ``a`` is a byte-level vocabulary of the tokenizers library, ``b`` a model of
    the sentencepiece library, both files on every executor.  A text that is
    null or empty, or whose tokens don't give its bytes back, has no tokens:
    zeros and ''.  Repeated rows and null ids get a row each and their links count
    each; an empty table gives no rows; other columns are not looked at.
    """
    paths = (a or public_tokenizers.path("byte_bpe_50k.json"), b or public_tokenizers.path("piece_bpe_32k.model"))

    def first(batches):
        va, vb = byte_level(paths[0]), pieces(paths[1])
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, n in slices(batch.column(1), BLOCK_BYTES):
                yield from block_rows(block, batch.column(0).slice(at, n), batch.column(1).slice(at, n),
                                      va, vb, keep_groups)
                block += 1

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    rows = stored(rows.mapInArrow(first, FIRST), "aligned")
    asks = rows.filter("pair is not null").select("block", "place", "pair", "n")
    counts = stored(asks.groupBy("pair").agg(F.sum("n").alias("count")), "aligned-pairs")
    b_id = F.expr(f"pair % {ID_SPACE}").alias("b_id")
    highest = counts.groupBy(b_id).agg(F.max("count").alias("highest"))
    known = counts.withColumn("b_id", b_id).join(highest, "b_id").select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("bigint").alias("best"))
    answers = asks.drop("n").join(known, "pair").select(F.col("block").alias("of"), "place", "count", "best")
    own = rows.filter("pair is null").drop("place", "pair", "n")
    schema = RESULT + (", groups string" if keep_groups else "")
    return own.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(
        lambda x, y: _sums(x, y, keep_groups), schema)
