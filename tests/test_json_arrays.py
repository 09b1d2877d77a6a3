"""Arrays read in byte ranges against Python's own reader."""

from __future__ import annotations

import json
import random
import re

import pytest

from quillframe.sources import json_arrays, readers
from quillframe.sources.json_arrays import read_json_array, write_json_arrays

SCHEMA = "id long, name string, tags array<string>, inner array<struct<a:string,b:array<long>>>, open map<string,string>"
ODD = ["", "}", "{", '"', '\\"}', "],[{", "\\", "a\nb", "}{é\U0001f600", '{"id": 1}', "[", "tail\\\\"]


@pytest.fixture
def small_blocks(spark):
    """Blocks of 700 bytes."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def records(n: int, seed: int) -> list[dict]:
    rng = random.Random(seed)
    word = lambda: rng.choice(ODD) + rng.choice(ODD)
    return [
        {"id": i, "name": word() * rng.choice([1, 1, 1, 300]), "tags": [word() for _ in range(rng.randint(0, 3))], "inner": [{"a": word(), "b": [1] * rng.randint(0, 2)} for _ in range(rng.randint(0, 3))], "open": {word(): word() for _ in range(rng.randint(0, 2))}}
        for i in range(n)
    ]


def plain(rows) -> list:
    return sorted((r.asDict(recursive=True) for r in rows), key=lambda r: r["id"])


@pytest.mark.parametrize("layout", [{"separators": (",", ":")}, {"indent": 2}, {"indent": 0, "ensure_ascii": False}])
def test_records_of_every_layout(small_blocks, tmp_path, layout):
    want = records(120, 7)
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(json.dumps([r | {"id": r["id"] + 1000 * k} for r in want], **layout), encoding="utf-8")
    read = read_json_array(small_blocks, str(tmp_path), SCHEMA)
    assert small_blocks.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 30
    rows = read.collect()
    assert all(r["_corrupt_record"] is None for r in rows)
    assert [{k: v for k, v in r.items() if k != "_corrupt_record"} for r in plain(rows)] == [r | {"id": r["id"] + 1000 * k} for k in range(3) for r in want]
    whole = readers.read_specs(small_blocks, str(tmp_path), SCHEMA).collect()
    assert plain(whole) == plain(rows)


@pytest.mark.parametrize(
    ("text", "ids", "corrupt"),
    [
        ("", [], []),
        ("[]", [], []),
        (" [ ]\n", [], []),
        ('[{"id":1}]', [1], []),
        ('\n[ {"id":1} , {"id":2, "inner":[{"a":"x"},{"a":"]"}]} ]\n', [1, 2], []),
        ('[{"id":1},{"id":2', [1], ['{"id":2']),
        ('[{"id":1},{"id":23,"name":"cu', [1], ['{"id":23,"name":"cu']),
        ('{"id":1}', [], ['{"id":1']),
        ('[5,{"id":1},"x"]', [], ['5,{"id":1}', '"x"]']),
        ('[{"id":"no number"},{"id":2}]', [2], ['{"id":"no number"}']),
        ("no json", [], ["no json"]),
    ],
)
def test_odd_files(spark, tmp_path, text, ids, corrupt):
    (tmp_path / "one.json").write_text(text)
    rows = read_json_array(spark, str(tmp_path), SCHEMA).collect()
    assert sorted(r["id"] for r in rows if r["_corrupt_record"] is None) == ids
    assert sorted(r["_corrupt_record"] for r in rows if r["_corrupt_record"] is not None) == sorted(corrupt)


def test_texts_are_shuffled_once(spark, tmp_path):
    """By file and block; what follows has a row a block, or only what crosses blocks."""
    (tmp_path / "one.json").write_text(json.dumps(records(5, 1)))
    read = read_json_array(spark, str(tmp_path), SCHEMA)
    lines = [x for x in read._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    assert not [x for x in lines if "block#" not in x and "file#" not in x]
    assert "Python" not in str(lines) and len({re.sub(r"#\d+L?|plan_id=\d+|^\W*", "", x) for x in lines if "block#" in x}) == 1


def test_arrays_written_and_read_back(spark, tmp_path):
    rows = spark.range(50).selectExpr("id", "concat('n}', id) AS name", "array('a', ']') AS tags")
    write_json_arrays(rows, str(tmp_path / "out"), ["id"], files=3)
    files = list((tmp_path / "out").rglob("*.txt"))
    assert len(files) == 3
    assert sorted(r["id"] for f in files for r in json.loads(f.read_text())) == list(range(50))
    back = read_json_array(spark, str(tmp_path / "out" / "*"), "id long, name string, tags array<string>").where("_corrupt_record IS NULL").drop("_corrupt_record")
    assert sorted(back.collect()) == sorted(rows.collect())


def test_a_record_a_line_is_read_without_a_shuffle(small_blocks, tmp_path):
    want = records(120, 8)
    small_blocks.createDataFrame(want, SCHEMA).createOrReplaceTempView("own_records")
    write_json_arrays(small_blocks.table("own_records"), str(tmp_path / "out"), ["id"], files=3)
    read = read_json_array(small_blocks, str(tmp_path / "out" / "*"), SCHEMA)
    assert "Exchange" not in read._jdf.queryExecution().executedPlan().toString()
    rows = read.collect()
    assert all(r["_corrupt_record"] is None for r in rows)
    assert [{k: v for k, v in r.items() if k != "_corrupt_record"} for r in plain(rows)] == want


@pytest.mark.parametrize(
    ("text", "by_lines", "ids", "corrupt"),
    [
        ('[\n{"id":1},\r\n\n {"id":2, "inner":[{"a":"}],[{"}]}\n]\n', True, [1, 2], []),
        ('[{"id":1}\n,{"id":2}]', True, [1, 2], []),
        ('[{"id":1}\n,{"id":"no number"}]', True, [1], ['{"id":"no number"}']),
        ('[{"id":1},{"id":2}\n,{"id":3}]', False, [1, 2, 3], []),
        ('[\n{"id":1,"inner":[\n{"a":"x"}\n]}\n]', False, [1], []),
        ('[{"id":1}\n,{"id":2}', False, [1], ['{"id":2']),
        ('{"id":1}\n,{"id":2}]', False, [], ['{"id":1}', '{"id":2}']),
        ('[{"id":1}\n]{"id":2}\n', False, [1], None),
        ('[{"id":1}\n,5\n,{"id":2}]', False, [1], None),
        ('[{"id":1,"name":"a\n,{"}\n,{"id":2}]', False, [2], None),
        ('[' + '{"id":1},' * 20 + '{"id":1,"name":"' + "x" * 50 + '"}]', False, [1] * 21, []),
    ],
)
def test_lines_that_are_no_records(spark, tmp_path, text, by_lines, ids, corrupt, monkeypatch):
    monkeypatch.setattr(json_arrays, "LONG_LINE", 60)
    at = tmp_path / "a b%20[c]{d}*.json"
    at.write_bytes(text.encode())
    (tmp_path / "empty.json").write_text("")
    assert [r["lines"] for r in json_arrays._by_lines(spark, str(tmp_path)).collect()] == [by_lines]
    rows = read_json_array(spark, str(tmp_path), SCHEMA).collect()
    assert sorted(r["id"] for r in rows if r["_corrupt_record"] is None) == ids
    if corrupt is not None:
        assert sorted(r["_corrupt_record"] for r in rows if r["_corrupt_record"] is not None) == corrupt
