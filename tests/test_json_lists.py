"""Elements of JSON lists read in many small byte ranges, against the standard parser."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.sources.documents import read_entity_document, read_panel_items
from strata.sources.json_lists import json_elements


@pytest.fixture()
def small_ranges(spark):
    """Files are cut every few hundred bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def value(draw, depth=0):
    kind = draw.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return draw.choice([None, True, 12, -3.5, "", 0])
    if kind in (1, 2, 3):
        return "".join(draw.choice(['}', ',', '},', '"', "\\", '\\"', "[", "{", "é日", " ", "a", "\n"])
                       for _ in range(draw.randrange(12)))
    if kind == 4:
        return [value(draw, depth + 1) for _ in range(draw.randrange(4))]
    return {draw.choice(["a", "b}", "c,", "entidades"]): value(draw, depth + 1) for _ in range(draw.randrange(4))}


def write(path, data, **how):
    with open(path, "w", encoding="utf-8") as f:
        f.write(data if isinstance(data, str) else json.dumps(data, **how))
    return path


def parsed(df):
    return sorted((r["file"].rsplit("/", 1)[1], json.dumps(json.loads(r["item"]), sort_keys=True)) for r in df.collect())


def wanted(files):
    return sorted((name, json.dumps(v, sort_keys=True)) for name, values in files.items() for v in values)


@pytest.mark.parametrize("how", [{}, {"indent": 1}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_arrays_and_lists_under_a_key(spark, scratch, small_ranges, how):
    draw, files, keyed = random.Random(str(how)), {}, {}
    for i in range(4):
        files[f"a{i}.json"] = [value(draw) for _ in range(draw.randrange(1, 60))]
        write(f"{scratch}/a{i}.json", files[f"a{i}.json"], **how)
        keyed[f"k{i}.json"] = [{"v": value(draw)} for _ in range(draw.randrange(1, 40))]
        around = {"x": {"entidades": [1, 2]}, "list": [[1], {"y": []}], "entidades": keyed[f"k{i}.json"], "z": [value(draw)]}
        write(f"{scratch}/k{i}.json", around, **how)
    assert parsed(json_elements(spark, f"{scratch}/a*.json")) == wanted(files)
    assert parsed(json_elements(spark, f"{scratch}/k*.json", "entidades")) == wanted(keyed)


def test_one_file_is_read_by_many_tasks(spark, scratch, small_ranges):
    write(f"{scratch}/big.json", [{"n": i, "s": "x" * 40} for i in range(500)])
    from strata.sources.json_lists import _records
    records = _records(spark, f"{scratch}/big.json")
    assert records.select(F.spark_partition_id()).distinct().count() > 20
    assert json_elements(spark, f"{scratch}/big.json").count() == 500


def test_items_that_end_with_a_list_are_read_by_many_tasks(spark, scratch, small_ranges):
    from strata.sources.json_lists import _records
    items = [{"id": i, "up": [{"id": i % 3}]} for i in range(400)]
    lines = "\n,".join(json.dumps(x) for x in items)  # nowhere a comma behind a bracket
    write(f"{scratch}/big.json", f'{{"entidades": [\n{lines}\n]}}\n')
    records = _records(spark, f"{scratch}/big.json")
    assert records.agg(F.max(F.length("value"))).first()[0] < 100
    assert records.select(F.spark_partition_id()).distinct().count() > 20
    assert parsed(json_elements(spark, f"{scratch}/big.json", "entidades")) == wanted({"big.json": items})


@pytest.mark.parametrize("text", ["[1,2],", "[1,2],\n", "[1,2]," + " " * 900, "[1],,", '[{"a":1}],{"b":2}'])
def test_a_comma_after_the_document_raises(spark, scratch, small_ranges, text):
    with pytest.raises(Exception):  # noqa: B017
        json_elements(spark, write(f"{scratch}/d.json", text)).collect()


def test_long_elements_and_empty_lists(spark, scratch, small_ranges):
    long = [{"s": "y},{" * 1000}, 1, ["},"] * 700, "end"]
    write(f"{scratch}/l.json", long)
    assert parsed(json_elements(spark, f"{scratch}/l.json")) == wanted({"l.json": long})
    for name, text in (("e", "[]"), ("s", " [ \n ] \n"), ("w", "[" + " " * 2000 + "]")):
        assert json_elements(spark, write(f"{scratch}/{name}.json", text)).collect() == []
    assert json_elements(spark, write(f"{scratch}/k.json", '{"entidades": [ ], "x": 1}'), "entidades").collect() == []


@pytest.mark.parametrize("text", ['[1,,2]', '[{"a":1},]', '[{"a":1}', '[{"a":"1}]', '{"a":1}', '[1] [2]', '[1] x', 'x [1]',
                                  '[{"a":1},{"b":2}]]', '12', '[{"a":1},{"b":2},' + " " * 900 + ']'])
def test_damaged_arrays_raise(spark, scratch, small_ranges, text):
    with pytest.raises(Exception):  # noqa: B017 - at once or in a task
        json_elements(spark, write(f"{scratch}/d.json", text)).collect()


def test_documents_without_the_key_raise(spark, scratch):
    for text in ('{"other": []}', '{"x": {"entidades": [1]}}'):
        with pytest.raises(KeyError):
            json_elements(spark, write(f"{scratch}/d.json", text), "entidades")


def test_readers_use_them(spark, scratch, small_ranges):
    rows = [{"id": i, "name": f"n{i}", "address": {"city": f"c{i % 3}"}} for i in range(60)]
    write(f"{scratch}/e.json", {"entidades": rows, "total": 60})
    got = read_entity_document(spark, f"{scratch}/e.json", lineage=True)
    assert sorted((r["id"], r["name"], r["address_city"], r["nome_arquivo"]) for r in got.collect()) == [
        (i, f"n{i}", f"c{i % 3}", "e.json") for i in range(60)]
    write(f"{scratch}/bad.json", '{"entidades": [{"id": 1}, {"id": tru}]}')
    with pytest.raises(Exception):  # noqa: B017
        read_entity_document(spark, f"{scratch}/bad.json").collect()
    write(f"{scratch}/p.json", [{f"k{i}": i} for i in range(50)])
    items = read_panel_items(spark, f"{scratch}/p.json").collect()
    assert sorted(json.loads(r["item"]).popitem()[1] for r in items) == list(range(50))
    assert {r["nome_arquivo"] for r in items} == {"p.json"}
    assert os.path.basename(items[0]["nome_arquivo"]) == "p.json"
