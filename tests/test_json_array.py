"""JSON arrays cut anywhere, and documents taken in as VARIANT."""

import json
import os
import random

import pytest

from tickfold import schemas
from tickfold.operators.explode import explode_transactions
from tickfold.session import checkpoint_root, local_path, scratch_path
from tickfold.sources.documents import document_quality, read_documents, write_documents
from tickfold.sources.json_array import array_elements


def written(spark, texts):
    folder = local_path(scratch_path(spark, "arrays"))
    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(os.path.join(folder, f"{i}.json"), "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def odd_value(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    if kind < 3:
        return "".join(rng.choices('{}[]",:\\ \n\té🙂x ', k=rng.randrange(12)))
    if kind == 3:
        return rng.choice([None, True, 1, -2.5e-7])
    if kind == 4:
        return [odd_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {str(odd_value(rng, 9)): odd_value(rng, depth + 1) for _ in range(rng.randrange(4))}


@pytest.mark.parametrize("split", [7, 64, 1000, None])
def test_elements_of_odd_arrays_from_any_cut(spark, split):
    rng = random.Random(split)
    arrays = [[{"k": i, "v": odd_value(rng)} for i in range(n)] for n in (0, 1, 40, 3)]
    texts = [json.dumps(x, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5) for x in arrays]
    texts[1] = "﻿ \n" + texts[1] + "\n\n"
    got = [json.loads(r.value) for r in array_elements(spark, written(spark, texts), split).collect()]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(map(key, got)) == sorted(key(x) for a in arrays for x in a)


def test_a_long_element_spans_many_splits_and_a_cut_off_one_is_corrupt(spark):
    long = {"timestamp": "2024-10-01 09:00:00", "transactions": [
        {"ticker": f"T{i}", "action": "BUY", "shares": i, "price": 1.5} for i in range(500)]}
    short = {"timestamp": "2024-10-01 10:00:00", "transactions": []}
    text = json.dumps([short, long, short])
    docs = read_documents(spark, written(spark, [text]), json_array=True, split_bytes=256)
    assert sorted(len(r.transactions) for r in docs.collect()) == [0, 0, 500]
    cut = read_documents(spark, written(spark, [text[:-len(json.dumps(short)) // 2]]), json_array=True, split_bytes=256)
    row = document_quality(cut).first()
    assert (row.documents, row.corrupt, row.trades) == (3, 1, 500)
    assert array_elements(spark, written(spark, ["[]", "", "[\n]\n"])).collect() == []


def test_one_file_is_read_by_several_tasks(spark):
    rows = [{"timestamp": "2024-10-01 09:00:00", "transactions": [{"ticker": "A", "shares": i}]} for i in range(2000)]
    path = written(spark, [json.dumps(rows)])
    size = os.path.getsize(os.path.join(path, "0.json"))
    docs = read_documents(spark, path, json_array=True, split_bytes=size // 8)
    root = os.path.join(local_path(checkpoint_root(spark)), "tickfold")
    newest = max((os.path.join(root, x) for x in os.listdir(root) if x.startswith("array-elements")), key=os.path.getmtime)
    assert len([x for x in os.listdir(newest) if x.startswith("part-")]) >= 8
    assert docs.count() == 2000 and explode_transactions(docs).agg({"shares": "sum"}).first()[0] == sum(range(2000))


def test_variant_reads_lines_once_in_the_types_asked_for(spark):
    lines = ['{"timestamp": "2024-10-01 09:06:00", "transactions": [{"ticker": "A", "action": "BUY", "shares": 2.5, "price": 149.7049}]}',
             '{"timestamp": "2024-10-01T09:07:00Z", "transactions": [{"ticker": "B", "shares": "3", "price": "abc", "more": {"x": 1}}]}',
             "no json", "", '{"transactions": null}', "17"]
    path = written(spark, ["\n".join(lines)])
    docs = read_documents(spark, path, variant=True)
    assert docs.drop("_corrupt_record").schema.simpleString() == schemas.DOCUMENT_OPEN.simpleString()
    plan = explode_transactions(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    got = [tuple(r) for r in explode_transactions(docs).collect()]
    assert got == [("2024-10-01 09:06:00", "A", "BUY", 2.5, 149.7049), ("2024-10-01T09:07:00Z", "B", None, 3.0, None)]
    row = document_quality(docs).first()
    assert (row.documents, row.corrupt, row.null_stamps, row.trades, row.null_prices) == (5, 1, 3, 2, 1)


def test_array_files_are_written_and_read(spark):
    docs = spark.range(50).selectExpr(
        "timestamp_ntz'2024-10-01 09:00:00' AS timestamp",
        "array(named_struct('ticker', concat('T', id), 'action', 'BUY', 'shares', int(id), 'price', cast(1.25 AS decimal(18,2)))) AS transactions")
    for frame, n in ((docs, 50), (docs.limit(0), 0)):
        path = write_documents(frame.repartition(3), scratch_path(spark, "array-out"), fmt="json_array")
        for f in os.listdir(local_path(path)):
            if f.startswith("part-"):
                with open(os.path.join(local_path(path), f)) as text:
                    assert isinstance(json.loads(text.read() or "[]"), list)  # no rows, no task
        back = read_documents(spark, path, json_array=True, schema=schemas.DOCUMENT)
        assert back.drop("_corrupt_record").exceptAll(frame).count() == 0 and back.count() == n


def test_a_text_is_parsed_once(spark):
    path = written(spark, ['{"timestamp": "2024-10-01 09:06:00", "transactions": [{"ticker": "A"}]}'])
    plan = explode_transactions(read_documents(spark, path, variant=True))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_splits_grow_with_the_files(spark, monkeypatch):
    from tickfold.sources import json_array

    rows = [{"timestamp": "2024-10-01 09:00:00", "transactions": [{"ticker": f'{{"\\{i}]', "shares": i}]} for i in range(2000)]
    path = written(spark, [json.dumps(rows)])
    size = os.path.getsize(os.path.join(path, "0.json"))
    monkeypatch.setattr(json_array, "MAX_SPLITS", 10)
    assert json_array._split_size(spark, path, size // 100) == size // 10
    assert json_array._split_size(spark, path, size // 5) == size // 5
    elements = array_elements(spark, path, 100)  # would be a split a row
    got = sorted((json.loads(r.value) for r in elements.collect()), key=lambda x: x["transactions"][0]["shares"])
    assert got == rows
    root = os.path.join(local_path(checkpoint_root(spark)), "tickfold")
    newest = max((os.path.join(root, x) for x in os.listdir(root) if x.startswith("array-elements")), key=os.path.getmtime)
    assert len([x for x in os.listdir(newest) if x.startswith("part-")]) <= 11
