"""Sharding, source divergence and token alignment, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest

from tickfold.llm import alignment, divergence, oracle, queries, sharding
from tickfold.llm.packing import _tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, part int, before string, block int, g string"
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    rows = [(1, "One two Three", "en", "web"), (1, "One two Three", "en", "web"), (2, None, "en", "web"),
            (3, "", None, None), (None, "null id, one two", "en", "news"), (None, "null id, one two", "en", "news"),
            (4, LONG, "en", "books"), (5, "Ünï cödé 🙂 one — two\x00 ▁x <s> <|endoftext|>  y ", "de", "web"),
            (6, "   ", "de", "news"), (7, "one two three one", "en", "news"), (8, "one", "", ""), (9, "x" * 5000, "de", "web")]
    return [(*r, 1, "b", 2, "g") for r in rows] + [(100 + i, f"copy of one text {i % 2}", "en", "web", None, None, None, None)
                                                    for i in range(300)]


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.mark.parametrize("order", [("doc_id",), None])
def test_shards_are_contiguous_and_even(spark, order):
    rows = odd_rows()
    docs = frame(spark, rows).withColumn("size", sharding.document_size())
    got = sharding.assign(docs, 7, order=order)
    assert got.columns == [*docs.columns, "shard", "slot"]
    got = got.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    shards = defaultdict(list)
    for r in got:
        assert r.size == len((r.text or "").encode()) + 16
        shards[r.shard].append((r.slot, r.doc_id, r.size))
    assert set(shards) <= set(range(7))
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    last = -1
    for k in sorted(shards):
        own = sorted(shards[k], key=lambda x: x[0])
        assert [s for s, _, _ in own] == list(range(len(own)))
        assert abs(sum(n for _, _, n in own) - total / 7) <= largest
        if order:
            ids = [-1 if i is None else i for _, i, _ in own]
            assert ids == sorted(ids) and ids[0] >= last
            last = ids[-1]


def test_shards_against_running_sums(spark):
    rng = random.Random(3)
    rows = [(i, "a" * rng.choice([0, 1, 7, 300])) for i in rng.sample(range(10_000), 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.assign(docs.withColumn("size", sharding.document_size()), 40).collect()
    total, before, want, slots = sum(len(t) + 16 for _, t in rows), 0, {}, Counter()
    for i, t in sorted(rows):
        n = len(t) + 16
        shard = min(39, (2 * before + n) * 40 // (2 * total))
        want[i] = (shard, slots[shard])
        slots[shard] += 1
        before += n
    assert {r.doc_id: (r.shard, r.slot) for r in got} == want


def test_shard_files_and_none(spark, tmp_path):
    rows = [r for r in odd_rows() if r[0] is not None]
    path = sharding.write_shards(frame(spark, rows), str(tmp_path / "shards"), 3)
    back = spark.read.parquet(path)
    assert sorted(map(str, (r.text for r in back.collect()))) == sorted(str(r[1]) for r in rows)
    assert {r.shard for r in back.select("shard").distinct().collect()} <= {0, 1, 2}
    none = frame(spark, []).withColumn("size", sharding.document_size())
    assert sharding.assign(none).collect() == []


def plain_audit(rows, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for r in rows:
        lang, source = r[2] or "", r[3] or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        names = sorted(s for x, s in groups if x == lang)
        every = sum((counts[lang, s] for s in names), Counter())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        q = shares(every)
        ps = {s: shares(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(sum((ps[s][t] - ps[o][t]) ** 2 // ps[o][t] for t in kept), o) for o in names if o != s]
            terms = [((ps[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found)}
    return out


@pytest.mark.parametrize(("groups", "terms", "held"), [(16, 4096, 750_000), (2, 8, 50), (1, 1, 1)])
def test_divergence_against_plain_python(spark, monkeypatch, groups, terms, held):
    monkeypatch.setattr(divergence, "GROUP_BLOCK", groups)
    monkeypatch.setattr(divergence, "TERM_BLOCK", terms)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rng = random.Random(groups)
    vocabulary = ["alpha", "Beta", "γάμμα", "delta", "ÉPSILON", "zeta", "eta", "éta", "Theta", "x"]
    rows = odd_rows()[:60] + [
        (1000 + i, " ".join(rng.choices(vocabulary, range(1, 11), k=rng.randrange(9))), rng.choice(["en", "de", "", None]),
         rng.choice(["web", "news", "books", None, "a", "b"]), 0, None, None, None) for i in range(150)]
    rows += [(5000, "only here", "fr", "web", 0, None, None, None), (5001, "", "fr", "news", 0, None, None, None)]
    got = divergence.audit(frame(spark, rows), 5)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain_audit(rows, 5)


def test_divergence_limits_ranks_before_the_shuffle(spark):
    plan = divergence.audit(frame(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert divergence.audit(frame(spark, [])).collect() == []


def test_share_is_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    rows = [(c, t, v) for t in (0, 10**13, 9 * 10**14 + 7) for c in (0, 1, t // 3, t) for v in (1, 999, 10**9)]
    got = spark.createDataFrame(rows, "c long, t long, v long").select(
        "c", "t", "v", divergence.share(F.col("c"), F.col("t"), F.col("v")).alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.c + 1) // (r.t + r.v) for r in got if r.c <= r.t)


def plain_alignment(rows):
    """Groups, links and counts with loops over tokens."""
    from sentencepiece import SentencePieceProcessor

    a = _tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_letters()
    out, counts = [], Counter()
    for r in rows:
        text = r[1] or ""
        ta = tb = []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids
            ta = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids]
            tb = [(i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode())
                  for i, p in ((i, b.id_to_piece(i)) for i in b.encode(text))]
            whole = (" " + text).encode()
            if any(b"".join(x for _, x in t) != whole for t in (ta, tb)):
                ta = tb = []
        spans = []
        for t in (ta, tb):
            at, own = 0, []
            for i, x in t:
                own.append((at, at + len(x), i))
                at += len(x)
            spans.append(own)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, links, first = [], [], 0
        for e in cuts:
            ga, gb = ([x for x in s if first <= x[0] < e] for s in spans)
            groups.append(",".join(str(x[2]) for x in ga) + "|" + ",".join(str(x[2]) for x in gb))
            links += [(x[2], y[2]) for x in ga for y in gb if x[0] < y[1] and y[0] < x[1]]
            first = e
        counts.update(links)
        out.append((r[0], len(ta), len(tb), len(groups), links, ";".join(groups)))
    highest = {}
    for (_, j), n in counts.items():
        highest[j] = max(highest.get(j, 0), n)
    return [(i, na, nb, ng, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "", g) for i, na, nb, ng, links, g in out]


@pytest.mark.parametrize("block", [3_000_000, 60])
def test_alignment_against_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    rng = random.Random(block)
    rows = odd_rows()[:40]
    rows[6] = (4, LONG[:30_000], *rows[6][2:])
    alphabet = "ab Zé🙂\n\t  .,'0١中▁\x01"
    rows += [(2000 + i, "".join(rng.choices(alphabet, k=rng.randrange(60))), *rows[0][2:]) for i in range(80)]
    got = alignment.align(frame(spark, rows, 3), keep_groups=True).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted((tuple(r) for r in got), key=key) == sorted(plain_alignment(rows), key=key)


def test_pieces_are_those_of_whole_texts_but_encoded_by_new_parts():
    from sentencepiece import SentencePieceProcessor

    rng = random.Random(5)
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    texts = ["".join(rng.choices("ab Zé,.\n0²▁日\0", k=rng.randrange(40))) for _ in range(800)]
    texts += ["", "a", " a", "a ", "x ². y", "<0x0A> b, <s>.\nc", "a\n\n b"]
    vocabulary = alignment.pieces.__wrapped__(path)
    assert vocabulary.encode(texts).to_pylist() == library.encode(texts)
    given, encode = [], SentencePieceProcessor.encode
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(SentencePieceProcessor, "encode", lambda m, x, **k: (given.extend(x), encode(m, x, **k))[1])
        got = vocabulary.encode([" ".join(["many", "words,", "again."] * 300)]).to_pylist()
    assert got == [library.encode(" ".join(["many", "words,", "again."] * 300))]
    assert sum(map(len, given)) < 30


def test_alignment_of_none_and_of_texts_without_tokens(spark):
    assert alignment.align(frame(spark, [])).collect() == []
    got = alignment.align(frame(spark, [r for r in odd_rows() if not r[1]])).collect()
    assert sorted((r.doc_id, r.n_a, r.n_links, r.count_sum, r.groups_sha256) for r in got) == [(2, 0, 0, 0, ""), (3, 0, 0, 0, "")]


def test_shard_query_has_the_crc_of_the_text(spark):
    got = queries.op11_sharding(spark, "/root/testdata/sf0.001").collect()
    texts = dict(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())
    assert {r.doc_id: r.text_crc32 for r in got} == {i: zlib.crc32((t or "").encode()) for i, t in texts.items()}
    assert "op11_sharding" in oracle.oracle_sql()
