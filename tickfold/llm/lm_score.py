"""Language-model scores over a subword lattice (operator 6).

The pieces are those of a public vocabulary file; it is a merge vocabulary, so
its scores are ranks, and log probabilities come from the training documents:
pieces are counted in the vocabulary's own segmentation of each training word,
with add-one smoothing.  A word's probability is the sum over all its
segmentations into pieces, by forward recursion in log space; pieces don't
cross blanks, so a document's is the product over its words and the end token.

A word's scores are computed once for the corpus.  To get them back to the
documents without a row for each occurrence, and without a broadcast of a
vocabulary that grows with the corpus, documents are dealt to blocks of bounded
text; each block asks for its distinct words and scores its documents with the
answers.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import stored, text_or_empty

HELD_OUT, FOLDS = 2, 7
#: Characters of a block of documents, and distinct words a task counts before it sends them.
BLOCK_CHARS = 16_000_000
COUNTED = 300_000
#: Marks the end of a text among the words; no word holds a blank.
END = " "
START = "▁"  # what the vocabulary writes for the blank before a word


@lru_cache(1)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def lower(text: str) -> bytes:
    return text.encode().lower()  # A-Z only


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")),
                  F.lit(FOLDS)) == HELD_OUT


class Lattice:
    """log10 P(word) summed over its segmentations, given log10 P(piece)."""

    def __init__(self, path: str, counts: dict[int, int]):
        model = _pieces(path)
        size = model.get_piece_size()
        total = sum(counts.values()) + size
        self.end = math.log((counts.get(model.eos_id(), 0) + 1) / total)
        self.trie: dict = {}
        self.byte = [0.0] * 256
        for i in range(size):
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            score = math.log((counts.get(i, 0) + 1) / total)
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:-1], 16)] = score
                continue
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score

    def log10(self, word: str) -> float:
        text = START + word
        n = len(text)
        into: list[list[float]] = [[] for _ in range(n + 1)]
        into[0].append(0.0)
        trie, exp, log = self.trie, math.exp, math.log
        for i in range(n):
            terms = into[i]
            if len(terms) == 1:
                here = terms[0]
            elif terms:
                top = max(terms)
                here = top + log(sum([exp(x - top) for x in terms]))
            else:
                continue
            node, j, single = trie, i, False
            while j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                score = node.get("")
                if score is not None:
                    single |= j == i + 1
                    into[j].append(here + score)
            if not single:  # a character without a piece of its own is spelt in bytes
                into[i + 1].append(here + sum(self.byte[b] for b in text[i].encode()))
        top = max(into[n])
        return (top + log(sum([exp(x - top) for x in into[n]]))) / math.log(10)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): all distinct words, and how often training documents have them."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for text, out in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = lower(text.as_py()).split()
                if out:
                    for w in words:
                        held.setdefault(w, 0)
                else:
                    held.update(words)
                    held[END.encode()] += 1
                if len(held) > COUNTED:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    def rows(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())],
            schema=schema)

    counted = docs.select("text", "held_out").mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def piece_counts(words: DataFrame, path: str) -> dict[int, int]:
    """How often each piece of the vocabulary occurs in training words: at most
    one number for each piece of the file."""
    schema = pa.schema([("piece", pa.int32()), ("n", pa.int64())])

    def count(batches):
        model = _pieces(path)
        total = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            batch = batch.filter(pa.compute.greater(batch.column(1), 0))
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for i, (word, ids) in enumerate(zip(words, model.encode(
                    [w if w != END else "" for w in words], num_threads=1), strict=True)):
                if word == END:
                    ids = [model.eos_id()]
                for p in ids:
                    total[p] += n[i]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], schema=schema)

    counted = words.mapInArrow(count, "piece int, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r.piece: r.n for r in counted.collect()}


def score(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    A null text is empty (its only token is the end); a null doc_id counts as
    the empty string for the split; rows that repeat are scored each; an empty
    table gives no rows.
    """
    path = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"),
                       held_out(F.col("doc_id")).alias("held_out"))
    words = stored(word_counts(docs), "lm-words")
    total, distinct = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).head()
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).head()[0]
    lattice = docs.sparkSession.sparkContext.broadcast(piece_counts(words, path))
    least = math.log10(total + (distinct + 1))

    def marginal(batches):
        model = Lattice(path, lattice.value)
        for batch in batches:
            found = [model.end / math.log(10) if w == END else model.log10(w)
                     for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())],
                names=["word", "n", "marginal"])

    scored = words.mapInArrow(marginal, "word string, n bigint, marginal double")
    # By place, not by value: repeated rows and null ids are spread like all others.
    blocks = docs.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()),
                                             F.lit(1 + chars // BLOCK_CHARS)))
    asked_schema = pa.schema([("block", pa.int64()), ("word", pa.string())])

    def ask(key, table):
        found = {END.encode()}
        for text in table["text"]:
            found.update(lower(text.as_py()).split())
        words = pa.array(list(found), pa.binary()).cast(pa.string())
        return pa.table([pa.repeat(key[0].as_py(), len(words)).cast(pa.int64()), words], schema=asked_schema)

    def answer(table, words):
        at = {w: i for i, w in enumerate(words["word"].cast(pa.binary()).to_pylist())}
        n, marginal = words["n"].to_numpy(), words["marginal"].to_numpy()
        base = np.log10(n + 1.0) - least
        end = at[END.encode()]
        out = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
        for text in table["text"]:
            ids = [at[w] for w in lower(text.as_py()).split()]
            ids.append(end)
            ids = np.array(ids)
            out["n_tokens"].append(len(ids))
            out["n_known"].append(int((n[ids] > 0).sum()))
            out["base_score"].append(math.fsum(base[ids]))
            out["score"].append(math.fsum(marginal[ids]))
        rows = table.num_rows
        return pa.table({"doc_id": table["doc_id"], "held_out": table["held_out"],
                         "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                         "n_known": pa.array(out["n_known"], pa.int64()),
                         "train_tokens": pa.repeat(total, rows).cast(pa.int64()),
                         "base_score": pa.array(out["base_score"], pa.float64()),
                         "score": pa.array(out["score"], pa.float64())})

    by_block = blocks.groupBy("block")
    asked = by_block.applyInArrow(ask, "block bigint, word string")
    # With no training document the end token has no count; it is asked for all the same.
    answers = asked.join(scored, "word", "left").select(
        "block", "word", F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("marginal", F.lit(_end_score(path, lattice.value))).alias("marginal"))
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(
        answer, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double")


def _end_score(path: str, counts: dict[int, int]) -> float:
    return Lattice(path, counts).end / math.log(10)
