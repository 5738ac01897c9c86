"""Whitening, shared windows and the manifest against plain versions; odd rows, hot groups, empty tables."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import merkle, substrings, whitening

# --- whitening


def plain_whitening(vectors, k):
    x = [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors]
    n, width = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(width)]
    d = [[n * c - s for c, s in zip(row, sums)] for row in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in d), n ** 3)) for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    white = np.array([[c / n for c in row] for row in d]) @ axes / np.sqrt(values)
    return [sum(c * c for c in row) for row in d], white, values / np.trace(cov)


def table(spark, vectors, more=""):
    rows = [(i, v) + (None,) * bool(more) for i, v in vectors]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<double>{more}")


def test_whitening_against_exact_fractions(spark):
    draw = random.Random(2)
    vectors = [[draw.gauss(i, 0.2 + i) for i in range(6)] for _ in range(300)]
    got = whitening.whiten(table(spark, enumerate(vectors), ", x string").repartition(7), components=4).collect()
    deviation, white, explained = plain_whitening(vectors, 4)
    assert len(got) == 1200 and {r["n"] for r in got} == {300}
    mine = np.zeros((300, 4))
    for r in got:
        mine[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
    signs = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white * signs).max() < 1e-8
    assert max(r["identity_error"] for r in got) < 1e-9


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [1.0, None]), (5, [inf, 0.0]), (6, []), (7, [1.0, 2.0, 3.0]),
            (None, [0.5, -3.0]), (1, [1.0, 2.0]), (8, [0.0, 0.0]), (9, [-inf, 0.0])]
    got = whitening.whiten(table(spark, rows, ", n long")).collect()
    assert sorted(str(r["vec_id"]) for r in got) == sorted(str(i) for i in (1, 1, None, 8) for _ in range(2))
    deviation, white, _ = plain_whitening([[1, 2], [0.5, -3], [1, 2], [0, 0]], 2)
    assert {r["deviation"] for r in got} == set(deviation)
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    empty = whitening.whiten(table(spark, rows).limit(0))
    assert empty.collect() == [] and empty.columns == whitening.whiten(table(spark, rows)).columns


def test_components_without_variance(spark):
    one = whitening.whiten(table(spark, [(1, [3.0, 4.0])])).collect()
    assert [(r["whitened"], r["deviation"], r["explained"], r["identity_error"]) for r in one] == [(None, 0, None, None)] * 2
    flat = whitening.whiten(table(spark, [(i, [float(i), 5.0]) for i in range(9)])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat)
    assert max(r["identity_error"] for r in flat) < 1e-9


def test_sums_of_squares_are_exact():
    draw = random.Random(7)
    for top in (1 << 20, 1 << 26, 1 << 40, (1 << 52) - 1):
        t = np.array([[draw.randint(-top, top) for _ in range(3)] for _ in range(whitening.BLOCK_ROWS)], np.int64)
        assert whitening.squared_sums(t) == [sum(int(v) ** 2 for v in column) for column in t.T]
    far = np.array([[10 ** 6 + 10 ** 4]])
    assert whitening.centred(far, 10 ** 9, [10 ** 6 * 10 ** 9])[0, 0] == 10 ** 13
    with pytest.raises(OverflowError):
        whitening.centred(far, 10 ** 12, [0])


# --- shared windows


def plain_windows(rows, window):
    """``[(doc_id, n_words, n_removed, kept_sha256)]`` of ``(doc_id, text)``."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    first = {}
    for (doc, _), w in zip(rows, words):
        for i in range(len(w) - window + 1 if doc is not None else 0):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1 if doc is not None else 0):
            if first[tuple(w[i:i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **how):
    return sorted((tuple(r) for r in substrings.deduplicated(df, **how).collect()), key=str)


def copies(seed, documents, words=120):
    draw = random.Random(seed)
    passages = [[f"p{k}w{draw.randrange(30)}" for _ in range(70)] for k in range(6)]
    rows = []
    for i in range(documents):
        text = [f"{draw.choice('abc')}{draw.randrange(40)}" for _ in range(draw.randrange(words))]
        for _ in range(draw.randrange(3)):
            p, at = draw.choice(passages), draw.randrange(len(text) + 1)
            a = draw.randrange(20)
            text[at:at] = p[a:a + draw.randrange(30, 70)]
        rows.append((i, draw.choice([" ", "\n", "\t \x0b"]).join(text)))
        if i % 9 == 0:
            rows.append((i + 1000, rows[-1][1]))
    return rows


@pytest.mark.parametrize("window,run", [(50, 16), (8, 3), (1, 1), (5, 5)])
def test_windows_against_plain_version(spark, window, run):
    rows = copies(window, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, window=window, run=run) == plain_windows(rows, window)


@pytest.mark.parametrize("cells", [64, 1 << 15, 1 << 24])
def test_a_full_sketch_loses_nothing(spark, cells):
    rows = copies(4, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, cells=cells) == plain_windows(rows, 50)


def test_the_sketch_never_counts_less(spark):
    rows = copies(8, 100)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sketch = substrings.sketched(df, 10, cells=1 << 16)
    per_window = {}
    for doc, text in rows:
        part = substrings._Slice([text.encode()], 50)
        words = part.hashes(1)
        if len(part.windows):
            for anchor, key in zip(substrings._anchors(words, part.windows, 50, 16),
                                   substrings._family(1).runs(words, 50)[part.windows].tolist()):
                per_window.setdefault(key, (anchor, set()))[1].add(doc)
    several = [a for a, docs in per_window.values() if len(docs) > 1]
    often = [a for a, docs in per_window.values() if len(docs) >= 10]
    assert several and sketch.passing(np.array(several), 1 << 16, False).all()
    assert not len(often) or sketch.passing(np.array(often), 1 << 16, True).all()


def test_hot_windows_are_decided_where_they_are_read(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_LEAST", 20)
    license = " ".join(f"word{i}" for i in range(80))
    rows = [(i, f"{'x ' * (i % 7)}{i} {license} {i} {'tail ' * (i % 60)}") for i in range(200)] + copies(3, 40)
    df = spark.createDataFrame([(500 - i, t) for i, t in rows], "doc_id long, text string").repartition(4)
    want = plain_windows([(500 - i, t) for i, t in rows], 50)
    assert found(df, hot=10) == want == found(df, hot=1)


def test_windows_of_odd_rows(spark, odd):
    long = " ".join(f"w{i}" for i in range(3000))
    more = [(8, long, None, None, None), (9, long[:4000], None, None, None), (9, f"{long} {'x' * 5000} {long}", None, None, None),
            (10, f"{'y' * 2000} " * 60, None, None, None), (11, f"{'y' * 2000} " * 60, None, None, None),
            (None, long, None, None, None), (8, long, None, None, None)]
    more = spark.createDataFrame([r + (None,) * (len(odd.columns) - 5) for r in more], odd.schema)
    df = odd.union(more)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert found(df) == plain_windows(rows, 50)
    none = substrings.deduplicated(df.limit(0))
    assert none.collect() == [] and none.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert found(df.where("text is null")) == plain_windows([r for r in rows if r[1] is None], 50)


# --- manifest


def plain_hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(fields):
    texts = ["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields]
    return plain_hash(*texts)


def plain_tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([plain_hash(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain_way(tree, at):
    for level in tree[:-1]:
        run = at - at % 3
        yield "".join(level[run:at]), "".join(level[at + 1:run + 3])
        at //= 3


def plain_manifest(rows):
    """``rows``: doc_id, source, lang, n_chars, text."""
    by = {}
    for r in rows:
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        now = r[4].replace("\n", "") if r[4] is not None and even else r[4]
        by.setdefault(r[1], []).append((r[0], plain_leaf(r), plain_leaf((*r[:4], now))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees.append(plain_tree([x[1] for x in by[s]]))
    top = plain_tree([t[-1][0] for t in trees])
    out = []
    for i, (s, tree) in enumerate(zip(order, trees)):
        for at, (doc, leaf, now) in enumerate(by[s]):
            way = [*plain_way(tree, at), *plain_way(top, i)]
            for before, after in way:
                now = plain_hash(before, now, after)
            out.append((doc, leaf, tree[-1][0], top[-1][0], plain_hash(*(b + a for b, a in way)), now, now == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def proofs(df, **how):
    return sorted((tuple(r) for r in merkle.manifest(df, **how).collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest_against_plain_version(spark, height):
    draw = random.Random(height)
    rows = [(i, draw.choice(["hot", "hot", "hot", "a", "é", "Z", None, f"s{i % 40}"]), draw.choice(["xx", None, ""]),
             draw.choice([None, i]), draw.choice([None, "", "a\nb\n", "日本\n", "plain"])) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = proofs(df, height=height)
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_few_and_odd_rows(spark, odd):
    for n in (1, 2, 3, 4):
        rows = [(2 ** 60 + i, "s", None, i, f"t\n{i}") for i in range(n)]
        assert proofs(spark.createDataFrame(rows, SCHEMA)) == plain_manifest(rows)
    rows = [(i, f"s{i:02d}", "x", 1, "t") for i in range(11)]  # trees of one leaf each
    assert proofs(spark.createDataFrame(rows, SCHEMA), height=1) == plain_manifest(rows)
    rows = [tuple(r) for r in odd.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert proofs(odd) == plain_manifest(rows)
    none = merkle.manifest(odd.limit(0))
    assert none.collect() == [] and none.columns == merkle.manifest(odd).columns


def test_a_proof_breaks_with_any_change(spark):
    rows = [(i, f"s{i % 3}", "xx", i, f"text {i}") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    change = lambda text, doc: F.when(doc == 17, F.concat(text, F.lit("!"))).otherwise(text)
    got = merkle.manifest(df, change=change).collect()
    assert [r["doc_id"] for r in got if not r["verified"]] == [17]
    assert len({r["root"] for r in got}) == 1 and len({r["subroot"] for r in got}) == 3


def test_a_hot_source_is_spread(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"), F.lit("x").alias("lang"),
                                    F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    tree = merkle.numbered(df.select(F.col("source").alias("tree"), "doc_id"), ["doc_id"])
    assert [tuple(r) for r in tree.orderBy("at").select("at", "doc_id").collect()] == [(i, i) for i in range(20_000)]
    assert tree.select("size").distinct().collect() == [(20_000,)]
