"""Sources and sinks: CSV round trip, raw JSON, create-if-absent, inline rows, B4."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.flatten import union_heterogeneous
from strata.sources import sinks, snapshots


def test_csv_round_trip_keeps_leading_zeros(spark, scratch):
    df = spark.createDataFrame([("01310100", "00394460005887", "2026-01")],
                               "cep string, cnpj string, anomes string")
    path = os.path.join(scratch, "csv")
    sinks.write_csv(df, path)
    back = sinks.read_csv(spark, path, schema=sinks.all_string_schema(df.columns))
    assert back.collect() == df.collect()
    inferred = sinks.read_csv(spark, path, infer=True).first()
    assert str(inferred["cep"]) == "1310100"  # what inference does to zero-led codes (T6)


def test_csv_refuses_empty(spark, scratch):
    with pytest.raises(ValueError):
        sinks.write_csv(spark.createDataFrame([], "a string"), os.path.join(scratch, "e"))


def test_raw_json_keeps_utf8(spark, scratch):
    df = spark.createDataFrame([("São Paulo",)], "cidade string")
    path = os.path.join(scratch, "raw")
    sinks.write_raw_json(df, path)
    text = "".join(open(os.path.join(path, f), encoding="utf-8").read()
                   for f in os.listdir(path) if f.endswith(".json"))
    assert "São Paulo" in text


def test_create_if_absent_and_inline_rows(spark):
    sinks.create_if_absent(spark, "t_news_demo", "ID string, N int")
    sinks.create_if_absent(spark, "t_news_demo", "ID string, N int")
    assert spark.table("t_news_demo").count() == 0
    rows = sinks.inline_rows(spark, [("a", 1), ("b'quote", 2)], "ID string, N int")
    assert rows.count() == 2 and rows.filter("ID = \"b'quote\"").count() == 1


def test_union_of_heterogeneous_records(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([(2, "y")], "id long, b string")
    u = union_heterogeneous([a, b])
    assert sorted(u.columns) == ["a", "b", "id"] and u.count() == 2


def test_clustered_write_sorts_within_files(spark, scratch):
    df = spark.range(0, 1000).selectExpr("id % 7 AS k", "id")
    path = os.path.join(scratch, "clu")
    sinks.write_table(df, path, cluster_by=["k"])
    assert spark.read.parquet(path).count() == 1000


def test_a_common_clustering_value_spreads_over_tasks(spark):
    df = spark.range(0, 100_000).selectExpr("IF(id % 20 = 0, 'AC', 'AR') AS k", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny rows would share one task
    try:
        sizes = sinks.clustered(df, ["k"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < 0.4 * 100_000


def test_raw_json_keeps_null_fields(spark, scratch):
    path = os.path.join(scratch, "raw")
    sinks.write_raw_json(spark.createDataFrame([(1, None)], "a int, b string"), path)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".json"))
    assert text.strip() == '{"a":1,"b":null}'


def test_snapshots_take_latest_committed(spark, scratch):
    base = os.path.join(scratch, "snap")
    assert snapshots.read_latest(spark, base) is None
    snapshots.write_next(spark.range(3), base)
    p2 = snapshots.write_next(spark.range(5), base)
    os.makedirs(os.path.join(base, "v1000000"))  # half-written: neither record nor marker
    assert snapshots.latest_path(spark, base).endswith(os.path.basename(p2))
    assert snapshots.read_latest(spark, base).count() == 5
    assert snapshots.write_next(spark.range(6), base).endswith("v1000001")
    assert snapshots.read_latest(spark, base).count() == 6


def test_snapshot_without_success_marker_is_not_lost(spark, scratch):
    base = os.path.join(scratch, "snap")
    path = snapshots.write_next(spark.range(3), base)
    os.rename(os.path.join(path, "_SUCCESS"), os.path.join(path, "_other"))
    assert snapshots.read_latest(spark, base).count() == 3
    os.rename(os.path.join(path, "_COMMITTED"), os.path.join(path, "_gone"))
    with pytest.raises(RuntimeError):
        snapshots.read_latest(spark, base)


def test_damaged_documents_raise(spark, scratch):
    from strata.sources.documents import read_entity_document, read_panel, read_panel_items
    for name, text in (("good.json", '{"entidades": [{"id": 1}, {"id": 2}]}'), ("bad.json", '{"entidades": [{"id": 3')):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    assert read_entity_document(spark, os.path.join(scratch, "good.json")).count() == 2
    with pytest.raises(Exception):
        read_entity_document(spark, os.path.join(scratch, "*.json")).collect()
    for name, text in (("good.txt", '[{"a": 1}, {"b": "2"}]'), ("bad.txt", '[{"a": 1}, {"b"')):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    assert read_panel_items(spark, os.path.join(scratch, "good.txt")).count() == 2
    with pytest.raises(Exception):
        read_panel_items(spark, os.path.join(scratch, "*.txt")).collect()
    with open(os.path.join(scratch, "lines.jl"), "w") as f:
        f.write('{"a": 1}\n{"b": \n')
    with pytest.raises(Exception):
        read_panel(spark, os.path.join(scratch, "lines.jl"), json_lines=True).collect()


def test_a_broken_feed_item_is_counted_and_the_others_load(spark, scratch):
    from strata.operators.watch import Watch
    from strata.sources.feeds import damage, read_feeds, whole
    item = "<item><title>{0}</title><link>http://x/{0}</link></item>"
    good, broken = [item.format(i) for i in range(3)], "<item><title>bad</link></item>"
    more = ('<item rdf:about="x">\n<title><![CDATA[a <b> & c]]></title><media:content url="u"/><dc:creator>z</dc:creator>'
            "<link>http://x/m</link><description>&lt;p&gt;é&lt;/p&gt;</description><pubDate>d</pubDate></item >")
    unended = "<item><title>no end</title>"
    for name, items in (("a", [good[0], broken, good[1], more]), ("b", [unended, good[0], good[2]])):
        with open(f"{scratch}/{name}.xml", "w") as f:
            f.write(f"<rss><channel>{''.join(items)}</channel></rss>")
    feeds = [(f"{scratch}/{n}.xml", n.upper(), "cat") for n in ("a", "b", "missing")]
    items = read_feeds(spark, feeds)
    watch = Watch(damage(["A", "B"]))
    whole(watch.over(items)).write.parquet(f"{scratch}/out")
    assert watch.counts == {"A": 1, "B": 1}
    got = spark.read.parquet(f"{scratch}/out")
    assert sorted(r["title"] for r in got.collect()) == ["0", "1", "2", "a <b> & c"]
    assert got.where("description is not null").first()[2:] == ("a <b> & c", "http://x/m", "d", "<p>é</p>")
    assert got.columns == ["source", "category", "title", "link", "pub_date", "description"]
    assert read_feeds(spark, feeds[2:]) is None


def test_watch_counts_what_is_written(spark, scratch):
    from strata.operators.watch import Watch
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("n"))
    watch = Watch({"three": F.col("k") == 3, "null": F.col("n").isNull(), "unknown": F.col("n") > 10_000})
    sinks.write_table(df, f"{scratch}/w", cluster_by=["k", "n"], watch=watch)
    assert watch.counts == {"three": 143, "null": 100, "unknown": 0}
    assert Watch({}).over(df) is df and Watch({"x": F.lit(True)}).counts == {"x": 0}


def test_csv_header_in_first_seen_order(spark, scratch):
    import csv
    import json
    from strata.plans.refresh import raw_to_csv
    docs = [{"z": "00012", "id": 1, "end": {"uf": "SP", "cep": "0131"}}, {"id": 2, "novo": 'say "hi", é', "z": None},
            {"a": [{"k": 1}, {"k": 2}], "id": 3}, {"id": 4, "z": "line\nbreak"}]
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/entidades.json", "w", encoding="utf-8") as f:
        json.dump({"entidades": docs}, f, ensure_ascii=False)
    written = raw_to_csv(spark, f"{scratch}/in", f"{scratch}/out")
    rows = []
    for name in sorted(os.listdir(written["csv"])):
        if name.endswith(".csv"):
            with open(os.path.join(written["csv"], name), encoding="utf-8", newline="") as f:
                rows += list(csv.DictReader(f))
    assert list(rows[0]) == ["z", "id", "end_cep", "end_uf", "novo", "a_0_k", "a_1_k"]
    by = {r["id"]: r for r in rows}
    assert by["1"]["z"] == "00012" and by["1"]["end_cep"] == "0131" and by["1"]["novo"] == ""
    assert by["2"]["novo"] == 'say "hi", é' and by["3"]["a_1_k"] == "2" and by["4"]["z"] == "line\nbreak"
    raw = spark.read.json(written["raw"])
    assert raw.count() == 4 and raw.where("id = 2").first()["novo"] == 'say "hi", é'
    with pytest.raises(ValueError):
        sinks.write_csv(spark.createDataFrame([], "a string"), f"{scratch}/none", ["a"])
