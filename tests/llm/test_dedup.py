"""Exact dedup, SimHash near-dedup and substring dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickfold.llm import exact_dedup, simhash, substring_dedup
from tickfold.llm.components import components

BLANKS = re.compile(r"[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"


def docs_of(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def texts(seed, n, words=("a", "b", "c d"), most=4):
    r = random.Random(seed)
    return [(i, r.choice([" ", "\n", " \t"]).join(r.choices(words, k=r.randint(0, most)))) for i in range(n)]


def digest(text):
    return hashlib.sha256(BLANKS.sub(" ", text or "").encode()).hexdigest()


def by_texts(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(digest(t), []).append(i)
    return groups


@pytest.mark.parametrize("share", [1000, 2])
def test_exact_against_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr("tickfold.llm.common.HOT_SHARE", share)
    rows = [*texts(1, 200), (500, None), (501, ""), (502, "x" * 300_000), (503, "x" * 300_000), (504, "ß  "),
            *[(i, "hot") for i in range(1000, 1100)]]
    groups = by_texts(rows)
    got = exact_dedup.DigestIndex(spark, buckets=4).add(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        own = groups[r.text_sha256]
        assert r.doc_id in own and (r.keep_id, r.group_size, r.kept) == (min(own), len(own), r.doc_id == min(own))


def test_exact_index_persists_between_batches_and_sessions(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    first = exact_dedup.DigestIndex(spark, path, 4).add(docs_of(spark, [(5, "a"), (6, "b")]))
    assert {(r.doc_id, r.kept) for r in first.collect()} == {(5, True), (6, True)}
    again = exact_dedup.DigestIndex(spark, path, 4)  # the files are the index
    second = again.add(docs_of(spark, [(1, "a "), (2, "a"), (3, "c"), (4, "c"), (5, "a")]))
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in second.collect()} == {
        (1, 1, 1, True), (2, 5, 2, False), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 2, False)}
    assert again.rows().count() == 4


def test_a_batch_added_again_gets_the_same_answer(spark, tmp_path, monkeypatch):
    one = docs_of(spark, [(5, "a"), (6, "b"), (7, "b")])
    two = docs_of(spark, [(1, "a"), (2, "c")])
    decided = lambda df: sorted(map(str, df.collect()))
    with exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index", 4) as index:
        first = decided(index.add(one, "day-1"))
        assert sum("kept=True" in x for x in first) == 2
        assert decided(index.add(one, "day-1")) == first
        second = decided(index.add(two, "day-2"))
        # a failure after the append: the digests are there, the caller has no answer
        monkeypatch.setattr(exact_dedup, "join_classes", lambda *x: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            index.add(two, "day-2")
        monkeypatch.undo()
        assert decided(index.add(two, "day-2")) == second and decided(index.add(one, "day-1")) == first
        small = index.compacted(f"file://{tmp_path}/compacted")
        assert small.rows().count() == index.rows().count() == 3
        again = small.add(docs_of(spark, [(9, "c"), (10, "d")])).collect()
        assert {(r.doc_id, r.keep_id, r.kept) for r in again} == {(9, 2, False), (10, 10, True)}
        name = index.name
    assert not spark.catalog.tableExists(name)
    with pytest.raises(ValueError, match="batch id"):
        small.add(one, "../x")


def test_exact_index_needs_no_shuffle_of_its_own(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    index.add(docs_of(spark, [(1, "a")])).collect()
    rows = spark.range(5).selectExpr("sha2(CAST(id AS STRING), 256) AS digest").repartition(4, "digest")
    plan = rows.hint("merge").join(index.rows(), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan


TRICKY = [(1, "same", "x"), (1, "same", "x"), (2, "same", "y"), (None, "same", "z"), (None, "lone", "q"),
          (None, "lone", "r"), (7, None, None), (8, "", "s"), (9, "\n \t", "t")]


def test_exact_keeps_one_row_of_each_text(spark):
    docs = docs_of(spark, TRICKY, DOCS + ", digest string").withColumnRenamed("digest", "Digest")
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert got == [("1", "same"), ("7", ""), ("9", "\n \t"), ("None", "lone")]
    assert exact_dedup.deduplicate(docs.limit(0)).collect() == []


def naive_fingerprint(text):
    words = [w for w in BLANKS.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(ids, prints):
    root = {i: i for i in range(len(ids))}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                root[top(i)] = top(j)
    least = {}
    for i in range(len(ids)):
        least[top(i)] = min(least.get(top(i), ids[i]), ids[i])
    return [least[top(i)] for i in range(len(ids))]


def test_simhash_labels_against_brute_force(spark):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(200)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "One"), (4, "oNE"), (5, "Two Words"), (6, "É é É")]
    for i in range(40):
        words = r.choices(vocabulary, k=400)
        rows.append((10 * i + 10, " ".join(words)))
        words[r.randrange(400)] = "changed"
        rows.append((10 * i + 11, "\t".join(words).upper()))
    prints = [naive_fingerprint(t) for _, t in rows]
    want = dict(zip([i for i, _ in rows], zip(prints, naive_components([i for i, _ in rows], prints),
                                             strict=True), strict=True))
    got = simhash.label(docs_of(spark, rows)).collect()
    assert {x.doc_id: (x.fp % 2**64, x.component_id) for x in got} == want
    assert len({c for _, c in want.values()}) < len(rows) - 10


@pytest.mark.parametrize("crowded,block", [(64, 1024), (2, 8), (1, 1024)])
def test_simhash_links_make_all_components(spark, monkeypatch, crowded, block):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(crowded)
    prints = {0}
    for _ in range(12):
        p = r.getrandbits(64)
        for _ in range(20):
            prints.add(p)
            for b in r.sample(range(64), r.randint(0, 4)):
                p ^= 1 << b
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = components(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")))
    got = {x.node: x.root for x in found.collect()}
    want = naive_components(prints, [p % 2**64 for p in prints])
    assert [got.get(p, p) for p in prints] == want
    assert len(set(want)) > 5


def test_pivot_coordinates_never_discard_a_link(spark):
    r = random.Random(5)
    pairs = []
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for k in r.sample(range(64), 3):
            b ^= 1 << k
        pairs.append((a, b))
    pivots = [simhash.reference(j) % 2**64 for j in range(simhash.PIVOTS)]
    assert all(abs((a ^ p).bit_count() - (b ^ p).bit_count()) <= 3 for a, b in pairs for p in pivots)
    unlike = [(r.getrandbits(64), r.getrandbits(64)) for _ in range(2000)]
    left = sum(all(abs((a ^ p).bit_count() - (b ^ p).bit_count()) <= 3 for p in pivots) for a, b in unlike)
    assert left < 20


def test_near_dedup_keeps_one_row_of_each_component(spark):
    docs = docs_of(spark, TRICKY, DOCS + ", fp string")
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert got == [("1", "same"), ("7", ""), ("None", "lone")]
    assert simhash.near_dedup(docs.limit(0)).collect() == []
    assert simhash.label(docs.limit(0)).collect() == []


def test_components_of_chains_loops_and_nothing(spark):
    chain = [(i, i + 1) for i in range(60)] + [(-5, -5), (100, 90), (90, 100), (None, 3)]
    got = {x.node: x.root for x in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def naive_removal(rows):
    words = [(i, [w for w in BLANKS.split(t or "") if w]) for i, t in rows]
    least = {}
    for i, w in words:
        for s in range(len(w) - 12):
            k = tuple(w[s:s + 13])
            if i is not None:
                least[k] = min(least.get(k, i), i)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - 12):
            first = least.get(tuple(w[s:s + 13]))
            if first is not None and (i is None or first < i):
                gone.update(range(s, s + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("group,chars", [(250_000, 4_000_000), (40, 3000), (1, 500)])
def test_substring_removal_against_brute_force(spark, monkeypatch, group, chars):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    monkeypatch.setattr(substring_dedup, "BLOCK_CHARS", chars)
    r = random.Random(group)
    passages = [" ".join(r.choices([f"p{i}" for i in range(50)], k=k)) for k in (13, 14, 60)]
    common = " ".join(["the"] * 30)
    rows = [(1, None), (2, ""), (3, "\n"), (4, passages[0]), (4, passages[0]), (None, passages[2]), (5, common * 3)]
    for i in range(60):
        body = [" ".join(r.choices([f"w{j}" for j in range(400)], k=r.randint(0, 40))) for _ in range(3)]
        rows.append((r.randrange(10_000), "\n".join([body[0], r.choice(passages), body[1], common, body[2]])))
    rows.append((20_000, rows[-1][1]))
    got = substring_dedup.remove_repeats(docs_of(spark, rows)).collect()
    assert sorted((str(x.doc_id), x.n_words, x.n_removed, x.kept_sha256) for x in got) == naive_removal(rows)


@pytest.mark.parametrize("sizes", [(0,), (1,), (2,), (5, 6), (11,), (12, 1), (13,), (14, 13), (20, 30), (2, 3, 4, 1)])
def test_substring_removal_of_few_words(spark, sizes):
    rows = [(i, " ".join(f"w{k}" for k in range(n))) for i, n in enumerate(sizes)]
    for parts in (1, len(rows)):
        got = substring_dedup.remove_repeats(docs_of(spark, rows).repartition(parts)).collect()
        assert sorted((str(x.doc_id), x.n_words, x.n_removed, x.kept_sha256) for x in got) == naive_removal(rows)


def test_repeated_rows_are_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_CHARS", 3000)
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(7, text)] * 500 + [(None, text)] * 100 + [(9, text), (2**63 - 1, "end of all ids")]
    got = substring_dedup.remove_repeats(docs_of(spark, rows).withColumn("block", F.lit(1)).withColumn("Words", F.lit("x")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "monotonically_increasing_id" in plan
    got = got.collect()
    assert sorted({(str(x.doc_id), x.n_removed) for x in got}) == [("7", 0), ("9", 30), (str(2**63 - 1), 0), ("None", 30)]
    assert len(got) == len(rows)


def naive_repeats(stretches, ids, least):
    """(stretch, first word, words, least id): what a suffix has in common with a
    stretch of a lesser id, where it reaches beyond that of the suffix before."""
    out = []
    for t, w in enumerate(stretches):
        before = 0
        for s in range(len(w) - least + 1):
            found = [(0, 0)]
            for u, v in enumerate(stretches):
                for x in range(len(v) if ids[u] < ids[t] else 0):
                    k = 0
                    while s + k < len(w) and x + k < len(v) and w[s + k] == v[x + k]:
                        k += 1
                    found.append((k, -ids[u]))
            words, low = max(found)
            if words >= least and s + words > before:
                out.append((t, s, words, -low))
            before = s + words if words >= least else 0
    return out


@pytest.mark.parametrize("least", [1, 2, 3, 13])
def test_suffix_tree_against_brute_force(monkeypatch, least):
    monkeypatch.setattr(substring_dedup, "WINDOW", least)
    r = random.Random(least)
    for _ in range(40):
        letters = r.choice([1, 2, 3])
        stretches = [[r.randrange(letters) for _ in range(r.randint(least, least + 30))] for _ in range(r.randint(0, 8))]
        ids = [r.randrange(5) for _ in stretches]
        tree = substring_dedup.SuffixTree(np.array([c for x in stretches for c in x], np.int64),
                                          np.array([len(x) for x in stretches], np.int64))
        # sorted, and the common prefixes are what neighbours share
        suffixes = [stretches[tree.stretch[at]][-int(tree.end[at] - at):] for at in tree.leaves[tree.order]]
        assert suffixes == sorted(suffixes)
        for x, y, k in zip(suffixes, suffixes[1:], tree.lcp.tolist(), strict=False):
            assert x[:k] == y[:k] and (k == min(len(x), len(y)) or x[k] != y[k])
        got = tree.maximal_repeats(np.array(ids, np.int64))
        assert list(zip(*[x.tolist() for x in got], strict=True)) == naive_repeats(stretches, ids, least)


def test_suffix_tree_of_more_words_than_a_number_holds():
    # three ranks side by side don't fit 64 bits: they are put together in steps
    n = 2_200_000
    codes = np.concatenate([np.arange(n, dtype=np.int64)[::-1], np.arange(20, 60)[::-1]])
    got = substring_dedup.SuffixTree(codes, np.array([n - 100, 100, 40])).maximal_repeats(np.array([5, 1, 9]))
    assert [x.tolist() for x in got] == [[2], [0], [40], [1]]


def test_substring_removal_returns_texts_and_runs(spark):
    words = [f"w{k}" for k in range(100)]
    rows = [(1, " ".join(words[10:40])), (2, " ".join(words)), (3, " ".join([*words[50:63], "x", *words[0:10]])), (4, None)]
    got = {x.doc_id: x for x in substring_dedup.remove_repeats(docs_of(spark, rows), texts=True).collect()}
    assert [(x.first, x.words) for x in got[2].removed] == [(10, 30)]
    assert got[2].kept_text == " ".join(words[:10] + words[40:])
    assert [(x.first, x.words) for x in got[3].removed] == [(0, 13)]
    assert got[1].removed == got[4].removed == [] and got[4].kept_text == ""
    assert all(hashlib.sha256(x.kept_text.encode()).hexdigest() == x.kept_sha256 for x in got.values())


def test_substring_removal_of_nothing(spark):
    assert substring_dedup.remove_repeats(docs_of(spark, [])).collect() == []


def test_squeezed_hashes_come_back():
    for n in (0, 1, 1000):
        x = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n, dtype=np.uint64))
        assert (substring_dedup.unsqueeze(substring_dedup.squeeze(x)) == x).all()
