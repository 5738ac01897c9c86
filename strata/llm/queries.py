"""The queries opN_<name> over the given tables, each through its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (attention_lm, cws, embed_graph, gam, langid, merkle, packing, pieces, secrets, simhash,
                        substrings, toxicity, whitening)
from strata.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


@query("op10_harmonic_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    return simhash.simhash(table(spark, sf_dir, "documents"))


@query("op2_secrets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; a source is an owner, a document one of its repositories."""
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return langid.languages(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the toxicity categories of all documents."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_weighted_sampling")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return cws.fingerprints(table(spark, sf_dir, "documents"))


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    return gam.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_ALL_PAIRS = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, MIN(b) AS low FROM reach GROUP BY a),
degree AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_links,
       CAST(LEAST(e.vec_id, COALESCE(low, e.vec_id)) AS BIGINT) AS component_id,
       e.vec_id = LEAST(e.vec_id, COALESCE(low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN lowest ON e.vec_id = lowest.a LEFT JOIN degree ON e.vec_id = degree.a
"""


@query("op3_embedding_graph", _ALL_PAIRS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return embed_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op4_pieces")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and the check of their decoding."""
    return pieces.encode(table(spark, sf_dir, "documents"))


@query("op6_attention_lm")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-model and attention-model scores of all documents."""
    return attention_lm.scores(table(spark, sf_dir, "documents"))


_SHARED_WINDOWS = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS k
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w)),
owners AS (SELECT k, MIN(doc_id) AS owner FROM windows GROUP BY k HAVING MIN(doc_id) < MAX(doc_id)),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN owners USING (k) WHERE doc_id > owner),
kept AS (
    SELECT s.doc_id, COUNT(*) AS n, string_agg(s.word, ' ' ORDER BY s.p) AS text
    FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w) s
    ANTI JOIN covered c ON s.doc_id = c.doc_id AND s.p = c.p GROUP BY s.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - COALESCE(n, 0) AS BIGINT) AS n_removed,
       sha256(COALESCE(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


@query("op12_substring_dedup", _SHARED_WINDOWS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that stand in no window of a smaller document."""
    return substrings.deduplicated(table(spark, sf_dir, "documents"))


_MERKLE = """
WITH RECURSIVE parity AS (  -- CRC-32 of the decimal id, bit by bit
    SELECT doc_id, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT),
                     list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
            lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
    FROM documents),
found AS (
    SELECT d.*, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS now_text
    FROM documents d JOIN parity USING (doc_id)),
fields AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS tree,
           COALESCE(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || COALESCE(strlen(source) || ':' || source, '-') || COALESCE(strlen(lang) || ':' || lang, '-')
           || COALESCE(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
           COALESCE(strlen(text) || ':' || text, '-') AS tail,
           COALESCE(strlen(now_text) || ':' || now_text, '-') AS now_tail
    FROM found),
leaves AS (
    SELECT doc_id, tree, sha256(head || tail) AS leaf, sha256(head || now_tail) AS now,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos FROM fields),
nodes(tree, lvl, pos, digest, size) AS (
    SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
    UNION ALL
    SELECT tree, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(size) + 2) // 3
    FROM nodes WHERE size > 1 GROUP BY tree, lvl, pos // 3),
subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE size = 1),
forest(lvl, pos, digest, size) AS (
    SELECT 0, pos, digest, count(*) OVER () FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(size) + 2) // 3
    FROM forest WHERE size > 1 GROUP BY lvl, pos // 3),
steps AS (
    SELECT tree, lvl, pos,
           COALESCE(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           COALESCE(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM (SELECT tree, lvl, pos, digest, size FROM nodes UNION ALL SELECT '*', lvl, pos, digest, size FROM forest)
    WHERE size > 1 WINDOW w AS (PARTITION BY tree, lvl, pos // 3 ORDER BY pos)),
ways(tree, origin, lvl, pos, proof, doc_id, folded) AS (
    SELECT tree, tree, 0, pos, '', doc_id, now FROM leaves
    UNION ALL
    SELECT w.tree, w.origin, w.lvl + 1, w.pos // 3, w.proof || s.before || s.after, w.doc_id,
           sha256(s.before || w.folded || s.after)
    FROM ways w JOIN steps s ON w.tree = s.tree AND w.lvl = s.lvl AND w.pos = s.pos),
at_subroot AS (
    SELECT w.* FROM ways w JOIN nodes n ON w.tree = n.tree AND w.lvl = n.lvl AND w.pos = n.pos WHERE n.size = 1),
upper(lvl, pos, proof, doc_id, folded, subroot) AS (
    SELECT 0, s.pos, w.proof, w.doc_id, w.folded, s.digest FROM at_subroot w JOIN subroots s ON w.tree = s.tree
    UNION ALL
    SELECT u.lvl + 1, u.pos // 3, u.proof || s.before || s.after, u.doc_id, sha256(s.before || u.folded || s.after),
           u.subroot
    FROM upper u JOIN steps s ON s.tree = '*' AND u.lvl = s.lvl AND u.pos = s.pos)
SELECT l.doc_id, leaf, subroot, f.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = f.digest AS verified
FROM upper u JOIN forest f ON f.size = 1 AND u.lvl = f.lvl JOIN leaves l ON l.doc_id = u.doc_id
"""


@query("op13_merkle_manifest", _MERKLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, root, proof and verification of all documents."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all whole embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
