"""Incremental news load: only new files are processed; merges accumulate."""

import os

from strata.sources import snapshots
from strata.streaming.incremental import run_news_increment

import fixtures as FX


def test_incremental_feed_merge(spark, scratch):
    landing = os.path.join(scratch, "landing")
    table = os.path.join(scratch, "news")
    ckpt = os.path.join(scratch, "ckpt")
    os.makedirs(os.path.join(landing, "ANCD"))
    with open(os.path.join(landing, "ANCD", "day1.xml"), "w", encoding="utf-8") as f:
        f.write(FX.rss(FX.ANCD_ITEMS[:2]))
    run_news_increment(spark, landing, table, ckpt)
    first = snapshots.read_latest(spark, table)
    assert first.count() == 2
    assert {r["DS_CATEGORIA_FONTE"] for r in first.collect()} == {"Associação e Políticas Setoriais"}

    os.makedirs(os.path.join(landing, "CRYPTO ID"))
    with open(os.path.join(landing, "CRYPTO ID", "day2.xml"), "w", encoding="utf-8") as f:
        f.write(FX.rss(FX.CRYPTO_ITEMS))
    run_news_increment(spark, landing, table, ckpt)
    second = snapshots.read_latest(spark, table)
    assert second.count() == 4
    acts = {r["NM_FONTE"]: r["merge_action"] for r in second.collect()}
    assert acts["CRYPTO ID"] == "insert" and acts["ANCD"] == "retain"

    run_news_increment(spark, landing, table, ckpt)  # nothing new: no new snapshot
    assert [n for n, _ in snapshots._folders(spark, table)] == [2, 1]
