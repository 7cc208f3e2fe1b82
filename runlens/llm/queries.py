"""Queries of the operators (opN_<name>) with production parameters, and their DuckDB SQL where SQL
can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import read_table
from runlens.llm.embedding_dedup import near_duplicate_vectors
from runlens.llm.exact_dedup import dedup_documents
from runlens.llm.licenses import scan_licenses
from runlens.llm.manifest import verify
from runlens.llm.mixing import draw
from runlens.llm.ngram_join import near_duplicates
from runlens.llm.packing import pack_documents
from runlens.llm.pii import personal_data
from runlens.llm.quality import quality
from runlens.llm.sharding import shard_documents
from runlens.llm.token_files import read_documents, write_files
from runlens.llm.toxicity import toxicity
from runlens.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return put


@query("op1_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY h) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM w""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_documents(read_table(spark, sf_dir, "documents")).drop("in_history")


@query("op2_product_quantisation", """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) BETWEEN 0.93 AND 1.5),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT c.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n ON c.vec_id = n.vec_id""")
def op2_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


@query("op3_elias_fano_files")
def op3_elias_fano_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(write_files(read_table(spark, sf_dir, "documents")))


@query("op4_license_join")
def op4_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


@query("op5_prefix_tree_join")
def op5_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op6_factorization_machine")
def op6_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op7_candidate_boosting")
def op7_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))


@query("op8_temperature_mixing")
def op8_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw(read_table(spark, sf_dir, "documents"))


@query("op9_minimax_sharding")
def op9_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


@query("op10_bin_completion")
def op10_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


# crc32 of a decimal id, bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii(({0})[i])::UBIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
    lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0 END))), 4294967295::UBIGINT)"""
_LEAF = "sha256(concat({}))".format(", ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars", "{text}")))


@query("op11_merkle_manifest", f"""
WITH RECURSIVE l AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS k, {_LEAF.format(text="text")} AS leaf,
         CASE WHEN ({_CRC.format("doc_id::VARCHAR")}) % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} END AS tampered
  FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER () AS id FROM l),
low AS (
  SELECT 0 AS lvl, k, pos, leaf AS h FROM r
  UNION ALL
  SELECT lvl + 1, k, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY k) AS m FROM low)
  WHERE m > 1 GROUP BY lvl, k, pos // 3),
subs AS (SELECT k, arg_max(h, lvl) AS subroot, max(lvl) AS depth FROM low GROUP BY k),
ranked AS (SELECT *, row_number() OVER (ORDER BY k) - 1 AS pos FROM subs),
high AS (
  SELECT 0 AS lvl, pos, subroot AS h FROM ranked
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS m FROM high)
  WHERE m > 1 GROUP BY lvl, pos // 3),
top AS (SELECT arg_max(h, lvl) AS root FROM high),
tree AS (SELECT 0 AS tier, k, lvl, pos, h, count(*) OVER (PARTITION BY k, lvl) AS m FROM low
         UNION ALL SELECT 1, '', lvl, pos, h, count(*) OVER (PARTITION BY lvl) FROM high),
own AS (SELECT r.id, 0 AS tier, r.k, r.pos FROM r UNION ALL SELECT r.id, 1, '', ranked.pos FROM r JOIN ranked ON r.k = ranked.k),
step AS (
  SELECT own.id, own.tier, tree.lvl, coalesce(string_agg(tree.h, '' ORDER BY tree.pos) FILTER (tree.pos < own.pos // (3 ** tree.lvl)::BIGINT), '') AS a,
         coalesce(string_agg(tree.h, '' ORDER BY tree.pos) FILTER (tree.pos > own.pos // (3 ** tree.lvl)::BIGINT), '') AS b
  FROM own JOIN tree ON own.tier = tree.tier AND own.k = tree.k AND tree.m > 1 AND tree.pos // 3 = own.pos // (3 ** (tree.lvl + 1))::BIGINT
  GROUP BY ALL),
path AS (SELECT id, list({{'a': a, 'b': b}} ORDER BY tier, lvl) AS steps, sha256(string_agg(a || b, '' ORDER BY tier, lvl)) AS proof FROM step GROUP BY id),
f AS (SELECT r.doc_id, r.leaf, subs.subroot, top.root, coalesce(path.proof, sha256('')) AS proof_sha256,
             list_reduce(list_prepend({{'a': coalesce(r.tampered, r.leaf), 'b': ''}}, coalesce(path.steps, [])),
                         lambda x, y: {{'a': sha256(y.a || x.a || y.b), 'b': ''}}).a AS folded_root
      FROM r JOIN subs ON r.k = subs.k CROSS JOIN top LEFT JOIN path ON r.id = path.id)
SELECT *, folded_root = root AS verified FROM f""")
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(read_table(spark, sf_dir, "documents"))


@query("op12_pairwise_quality")
def op12_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op13_qd_whitening")
def op13_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
