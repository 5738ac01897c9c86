"""SimHash, components, weighted sampling and the embedding graph against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_helpers import pairs_to_roots  # noqa: I001
from pyspark.sql import functions as F

from strata.llm import components, cws, embed_graph, simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if grams and 2 * ones[b] > len(grams))


def test_fingerprint():
    for text in ["", " \n ", "One", "two words", "A b C d e f É", "x " * 5000, "a\x0bb\x0cc\x85d e\xa0f"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_golay_keys_meet_within_two_bits():
    draw = random.Random(3)
    base = [draw.getrandbits(64) for _ in range(400)]
    for bits in (0, 1, 2):
        other = [x ^ sum(1 << b for b in draw.sample(range(64), bits)) for x in base]
        a, b = simhash.keys(np.array(base, np.uint64)), simhash.keys(np.array(other, np.uint64))
        assert all(set(x) & set(y) for x, y in zip(a.tolist(), b.tolist()))


def test_golay_code_is_perfect():
    code = simhash.Golay()
    words = np.arange(1 << 12) << 11
    assert (code.indices(np.arange(1 << 23)[:: 1 << 11])[:, 0] < 1 << 12).all()
    assert len(set(code.errors[:, 0].tolist())) == 1 << 11  # one leader a syndrome, of three bits at most
    assert max(int(e).bit_count() for e in code.errors[:, 0]) == 3
    assert len(words) == 1 << 12


def _prints(spark, values):
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    return spark.createDataFrame([(v,) for v in sorted(set(signed))], "fp long")


def test_links_against_all_pairs(spark, monkeypatch):
    draw = random.Random(5)
    values = [draw.getrandbits(64) for _ in range(150)]
    values += [v ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) for v in values for _ in range(2)]
    crowd = draw.getrandbits(64)
    values += [crowd ^ 1 << draw.randrange(40) ^ 1 << draw.randrange(40) for _ in range(300)]
    frame = _prints(spark, values)
    u = np.array([r["fp"] for r in frame.collect()], dtype=np.int64).view(np.uint64)
    for distance in (0, 1, 2):
        a, b = np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= distance)
        want = pairs_to_roots(u.view(np.int64).tolist(), [(int(u[x].view(np.int64)), int(u[y].view(np.int64)))
                                                         for x, y in zip(a, b)])
        for crowded in (4, 1000):  # both ways give the same components
            monkeypatch.setattr(simhash, "CROWDED", crowded)
            got = [(r["u"], r["v"]) for r in simhash.links(frame, distance).collect()]
            near = [(x ^ y) & (1 << 64) - 1 for x, y in got]
            assert all(z.bit_count() <= distance for z in near)
            assert pairs_to_roots(u.view(np.int64).tolist(), got) == want


def test_simhash_and_deduplicated(spark):
    rows = [(5, "The same  text once more"), (3, "the same text\nonce more"), (9, "something else entirely here"),
            (1, None), (2, ""), (9, "something else entirely here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in simhash.simhash(df).collect()}
    assert got[5]["fingerprint"] == got[3]["fingerprint"] == f"{plain_fingerprint(rows[0][1]):016x}"
    assert [got[i]["component_id"] for i in (5, 3, 9, 1, 2)] == [3, 3, 9, 1, 1]
    assert got[1]["fingerprint"] == "0" * 16
    assert sorted(r["doc_id"] for r in simhash.deduplicated(df).collect()) == [1, 3, 9]


def test_components_of_chain_star_and_cycle(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(1, 2), (2, 3), (3, 1), (4, 4)]
    pairs += [(None, 5), (7, 8)]
    got = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = pairs_to_roots(sorted({x for p in pairs for x in p if x is not None and x not in (4, 5)}),
                          [p for p in pairs if None not in p and p != (4, 4)])
    assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def _jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_weighted_sampling_estimates_generalised_jaccard():
    draw = random.Random(1)
    texts = []
    for _ in range(60):
        words = [f"w{int(draw.expovariate(0.02))}" for _ in range(draw.randint(50, 400))]
        texts.append(" ".join(words))
        texts.append(" ".join(words[: len(words) * 2 // 3] + [f"v{draw.randrange(90)}" for _ in range(60)]))
    sign = cws.signatures(texts)
    off = [cws.likeness(sign[i], sign[i + 1]) - _jaccard(texts[i], texts[i + 1]) for i in range(0, 120, 2)]
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.07
    assert (cws.signatures(["a b a", "b a a"])[0] == cws.signatures(["a b a", "b a a"])[1]).all()
    assert not cws.signatures(["", "  "]).any()


def test_neighbours_and_edited_texts(spark):
    rows = [(i * 3 % 101, f"text {i} " + "word " * (i % 9)) for i in range(101)] + [(200, ""), (201, None), (202, "end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in cws.fingerprints(df).collect()}
    order = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(order)
    import hashlib
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        n = len(text)
        want = text[:n - n // 4] + following[:n // 4]
        assert got[i]["n_chars"] == n
        assert got[i]["edited_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        own, new, nxt = cws.signatures([text, want, following])
        assert got[i]["near_edited"] == cws.likeness(own, new) and got[i]["near_next"] == cws.likeness(own, nxt)
        assert got[i]["fingerprint"] == cws.written(own) and got[i]["edited_fingerprint"] == cws.written(new)


def test_embedding_graph_against_all_pairs(spark):
    draw = np.random.default_rng(2)
    base = draw.standard_normal((300, 16))
    x = np.concatenate([base, base[:120] + 0.05 * draw.standard_normal((120, 16)),
                        base[:1] + 0.06 * draw.standard_normal((150, 16)), base[5:7], 3 * base[8:10]])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(y @ y.T >= 0.95, 1))
    want = pairs_to_roots(range(len(x)), list(zip(a.tolist(), b.tolist())))
    got = {r["vec_id"]: r for r in embed_graph.near_duplicates(df).collect()}
    degree = np.bincount(np.concatenate([a, b]), minlength=len(x))
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= degree[i] for i in range(len(x))) and found >= 0.97 * degree.sum()
    assert sum(got[i]["component_id"] != want.get(i, i) for i in range(len(x))) <= 2
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_large_shards_are_searched_in_pairs_of_blocks(spark):
    draw = np.random.default_rng(4)
    x = draw.standard_normal((1, 8)) + 0.15 * draw.standard_normal((240, 8))
    nodes = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "node long, vector array<double>, copies long")
    found = embed_graph.graph_links(nodes, 0.95, overlap=1, shard_rows=10_000, block_rows=60)
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = int((y @ y.T >= 0.95).sum()) - len(x)
    links = {(r["node"], z["node"]) for r in found.collect() for z in r["links"]}
    assert all(y[p] @ y[q] >= 0.95 for p, q in links) and len(links) >= 0.97 * want


def group_over_shards():
    """1,500 different vectors in one group, far more than a shard holds, and small groups beside it."""
    draw = np.random.default_rng(7)
    centre, width = draw.standard_normal((1, 64)), 64
    pairs = draw.standard_normal((100, width))
    x = np.concatenate([centre + 0.19 * draw.standard_normal((1500, width)), pairs,
                        pairs + 0.05 * draw.standard_normal((100, width)), draw.standard_normal((200, width))])
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x, y @ y.T >= 0.95


def test_links_of_a_group_over_many_shards(spark):
    x, near = group_over_shards()
    want = near.sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embed_graph.near_duplicates(df, shard_rows=50, block_rows=300).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= want).all() and links.sum() >= 0.999 * want.sum()
    a, b = np.nonzero(np.triu(near, 1))
    roots = pairs_to_roots(range(len(x)), list(zip(a.tolist(), b.tolist())))
    assert sum(got[i]["component_id"] != roots[i] for i in range(len(x))) <= 2


def test_audit_counts_nodes_alike_and_binds(spark, monkeypatch):
    x, near = group_over_shards()
    nodes = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "node long, vector array<double>, copies long")
    have = [(i, int(n) - 1 if i < 1500 else 0) for i, n in enumerate(near.sum(axis=1))]  # no link of the small groups
    found = spark.createDataFrame(have, "node long, n long")
    true = near.sum(axis=1) > 1
    share = embed_graph.audit(nodes, found, queries=len(x))
    assert share == pytest.approx(true[:1500].sum() / true.sum())
    monkeypatch.setattr(embed_graph, "audit", lambda *a, **k: 0.5)
    df = nodes.select(F.col("node").alias("vec_id"), F.col("vector").alias("embedding")).where("node % 20 = 0")
    with pytest.raises(RuntimeError, match="recall 0.5"):
        embed_graph.near_duplicates(df, overlap=embed_graph.MOST_OVERLAP)
