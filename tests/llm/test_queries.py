"""Registered queries against DuckDB, and the pipeline against brute force."""

import collections
import itertools
import os
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tickfold.llm import mixing, oracle, packing, quality_rules, queries, simhash

SF = "/root/testdata/sf0.001"
BLANKS = re.compile(r"[\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, found.fetchall()))


def test_each_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [n for n in range(1, 11) if not any(x.startswith(f"op{n}_") for x in names)] == []
    assert names["pipeline"] is corpus_pipeline.run and set(queries.queries()) <= set(names)


def judged(rows):
    """Plain-Python quality rules: ids that pass."""
    counted = {r["doc_id"]: (r, dict(zip(quality_rules.COUNTS, quality_rules.text_counts(r["text"]), strict=True)))
               for r in rows}

    def fails(c):
        return c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]

    def rates(c):
        return {k: 1_000_000 * c[top] // c[bottom] if c[bottom] else None
                for k, (top, bottom, _, _) in quality_rules.RATES.items()}

    groups = collections.defaultdict(list)
    for r, c in counted.values():
        for k, v in rates(c).items():
            if not fails(c) and v is not None:
                shift = max(0, v.bit_length() - 5)
                for key in ((r["lang"], r["source"]), (r["lang"],), ()):
                    groups[key, k].append(v >> shift << shift)

    def quantiles(key, k):
        x = sorted(groups[key, k])
        return [x[-(-len(x) * a // 4) - 1] for a in (1, 3)]

    kept = []
    for i, (r, c) in counted.items():
        ok = not fails(c)
        for k, v in rates(c).items():
            own = (r["lang"], r["source"])
            if not groups[own, k] or v is None:
                continue
            key = next((x for x in (own, own[:1]) if len(groups[x, k]) >= quality_rules.MIN_GROUP), ())
            low, high = quantiles(key, k)
            _, _, least, side = quality_rules.RATES[k]
            apart = quality_rules.FENCE * ((high - low) or least)
            ok = ok and v <= high + apart and (side != "both" or v >= low - apart)
        if ok:
            kept.append(i)
    return kept


def exact(rows):
    first = {}
    for r in rows:
        key = BLANKS.sub(" ", r["text"] or "")
        first[key] = min(first.get(key, r["doc_id"]), r["doc_id"])
    return sorted(first.values())


def near(rows):
    ids = [r["doc_id"] for r in rows]
    prints = np.array([simhash.fingerprint(r["text"]) for r in rows], np.int64).view(np.uint64)
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if int(prints[i] ^ prints[j]).bit_count() <= 3:
            root[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        least[top(i)] = min(least.get(top(i), d), d)
    return sorted(least.values())


def fitted(rows):
    """Numpy raking: the probability of each cell."""
    cells = collections.Counter()
    for r in rows:
        topic, n = mixing.topic_of(r["text"] or "")
        cells[r["source"], r["lang"], topic] += n
    keys, tokens = list(cells), np.array(list(cells.values()), float)
    weight, total = np.ones(len(keys)), tokens.sum()
    margins = []
    for axis in range(3):
        label = np.unique([str(k[axis]) for k in keys], return_inverse=True)[1]
        goal = np.bincount(label, tokens) ** mixing.TEMPER
        margins.append((label, goal / goal.sum()))
    for _ in range(500):
        for label, goal in margins:
            weight *= (goal * total / np.bincount(label, tokens * weight))[label]
    high = weight[tokens >= mixing.LEAST_SHARE * total].max()
    scale = min(mixing.KEEP * total / (tokens * weight).sum(), 1 / high)
    return dict(zip(keys, np.minimum(1, weight * scale), strict=True))


def test_pipeline_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for (name, stage), brute in zip(corpus_pipeline.STAGES, (judged, exact, near, None, None), strict=True):
        given = docs
        docs = stage(spark, given, SF)
        if brute:
            docs = spark.createDataFrame(docs.toPandas(), docs.schema)
            want = brute([rows[r.doc_id] for r in given.collect()])
            assert sorted(r.doc_id for r in docs.collect()) == sorted(want), name
        elif name == "mixing":
            docs = spark.createDataFrame(docs.toPandas(), docs.schema)
            kept = {r.doc_id for r in docs.collect()}
            chance = {r.doc_id: r.c for r in given.select("doc_id", mixing._chance().alias("c")).collect()}
            goal = fitted([rows[i] for i in chance])
            for i, c in chance.items():
                p = goal[rows[i]["source"], rows[i]["lang"], mixing.topic_of(rows[i]["text"])[0]]
                assert (i in kept) == (c < p) or abs(c - p) < 0.02
            assert len(kept) < len(chance)
        else:
            pieces = docs.collect()
            by_doc = collections.defaultdict(list)
            for p in pieces:
                by_doc[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
            assert set(by_doc) == {r.doc_id for r in given.collect()}
            encoder = packing.Encoder(__import__("public_tokenizers").path("byte_bpe_50k.json"))
            for i, found in by_doc.items():
                ids = np.frombuffer(encoder([rows[i]["text"]])[0] + b"\1\0\0\0", "<u4")
                at = 0
                for start, n, crc, total in sorted(found):
                    assert (start, total) == (at, len(ids)) and crc == zlib.crc32(ids[at:at + n].tobytes())
                    at += n
                assert at == len(ids)
            break
        assert docs.columns == columns


def test_pipeline_of_awkward_rows_and_of_none(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, counts string, fp int"
    body = " ".join(f"word{i}" for i in range(40))
    rows = [(1, body, "en", "s", 1, "x", 1), (1, body, "en", "s", 1, "x", 1), (2, body + " ", None, None, None, None, None),
            (None, body + " z", "en", "s", 0, None, 2), (3, None, "en", "s", 0, None, 2), (4, "", None, "s", 0, None, 2),
            (5, " ".join(f"long{i}" for i in range(60_000)), "de", "t", 5, "y", 3)]
    for data in (rows, []):
        folder = str(tmp_path / str(len(data)))
        os.makedirs(folder)
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert {r.doc_id for r in got} <= {1, 5, None}
        assert bool(got) == bool(data)
