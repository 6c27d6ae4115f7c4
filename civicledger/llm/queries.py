"""The thin opN queries: each applies one operator to its whole table, by its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bitsliced, jaccard_join, language, license_scan, neardup_graph, packing, pii, prefix_trie, quality, tokens,
               unigram, vector_codes, warc)
from .common import Scratch, read_table

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(spark, docs, tokenizer_path(WORD_TOKENIZER), capacity=4096, end_id=1)


def op2_sentencepiece_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, its ids, and whether they decode to the text again."""
    return unigram.encode(spark, read_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def remainder(spark_id, by: int):
    """crc32 of the id's text modulo ``by``; null for a null id."""
    return F.crc32(spark_id.cast("string").cast("binary")) % by


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame):
    """Learned from ``labels.quality`` outside the held-out fold."""
    labels = read_table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    return quality.fit(spark, docs, labels, "quality")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(spark, docs, quality_model(spark, sf_dir, docs))
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: A deployment passes its own secret.
PII_KEY = "civicledger-example-key"


def op4_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs.withColumn("n_found", pii.values_found(F.col("text")).cast("long")), PII_KEY)


def op5_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, read_table(spark, sf_dir, "pages"))


#: Written independently of the operator: sizes, digests and roles straight from the table.
OP5_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN f.first_id IS NULL OR f.first_id = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return jaccard_join.jaccard_components(spark, docs, words=5, percent=75).select("doc_id", "n_shingles", "component_id")


def op7_neardup_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return neardup_graph.near_duplicates(spark, vectors, least=0.93)


def op8_bitsliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return bitsliced.top_k(spark, vectors, F.col("vec_id") % 20 == 0, k=20, scale=64)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.c, c.c), lambda p: p[1] * p[2])) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.c) = len(q.c)
), r AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 20
"""


def language_model(spark: SparkSession, docs: DataFrame):
    """Learned from text and lang outside the held-out fold."""
    return language.fit(spark, docs.where(remainder(F.col("doc_id"), 4) != 2))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.predict(spark, docs.select("doc_id", "text"), language_model(spark, docs))
    return found.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache starts empty at every call, so the figures hold the whole encoding."""
    docs = read_table(spark, sf_dir, "documents")
    counts = tokens.token_counts(spark, docs, tokenizer_path(WORD_TOKENIZER), Scratch(spark, "cache").path("counts"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text", "matches")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    coded, books = vector_codes.encode(spark, vectors, parts=8, entries=16, rounds=6, scale=4096, keep=("vec_id", "label"))
    return (vector_codes.with_label_errors(coded).withColumn("codebooks_sha256", F.lit(books.digest()))
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))


def _op12_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The rounds written out: squared distances by joins, the least by a window, means by grouping."""
    ctes = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""cut AS MATERIALIZED (
  SELECT vec_id, i // (len(c) // {parts}) AS p, i % (len(c) // {parts}) AS j, c[i + 1] AS v
  FROM (SELECT vec_id, c, unnest(range(len(c))) AS i FROM kept)
)""", f"""book0 AS MATERIALIZED (
  SELECT p, e, j, v FROM cut JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept
                                   QUALIFY e < {entries}) USING (vec_id)
)"""]
    for r in range(rounds + 1):
        ctes.append(f"""near{r} AS MATERIALIZED (
  SELECT vec_id, p, e, far FROM (
    SELECT vec_id, p, e, sum((x.v - b.v) * (x.v - b.v)) AS far FROM cut x JOIN book{r} b USING (p, j) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY far, e) = 1
)""")
        if r < rounds:
            ctes.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT p, e, j, coalesce(n.v, b.v) AS v FROM book{r} b LEFT JOIN (
    SELECT p, e, j, CAST(floor(CAST(sum(v) AS DOUBLE) / count(*)) AS BIGINT) AS v
    FROM cut JOIN near{r} USING (vec_id, p) GROUP BY p, e, j) n USING (p, e, j)
)""")
    return "WITH " + ", ".join(ctes) + f""", coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.of_conversations(spark, read_table(spark, sf_dir, "conversations"),
                                         lender=lambda c: c - c % 5, length=lambda c: remainder(c, 9))
    return nodes.withColumnRenamed("saved", "saved_tokens")


#: crc32 by its definition (reflected polynomial, bit by bit); nodes by their prefixes; sums over all pairs of a node and
#: its descendants.
OP13_SQL = """
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
hs AS (
  SELECT c, c - c % 5 AS lender, xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) % 9 AS h
  FROM ids
), t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS r
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (SELECT c, count(*) AS n FROM t GROUP BY c),
plan AS (SELECT hs.c, lender, h, least(h, coalesce(n.n, 0)) AS taken FROM hs LEFT JOIN n ON n.c = hs.lender),
built AS (
  SELECT plan.c, taken + r - h AS place, role, text FROM plan JOIN t USING (c) WHERE r >= h
  UNION ALL SELECT plan.c, r, role, text FROM plan JOIN t ON t.c = plan.lender WHERE r < taken
), prefix AS MATERIALIZED (
  SELECT c, CAST(place + 1 AS BIGINT) AS depth, strlen(text) AS bytes,
         md5(string_agg(md5(strlen(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY place)) AS k
  FROM built
  UNION ALL SELECT c, 0, 0, '' FROM ids
), node AS MATERIALIZED (
  SELECT k, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM prefix GROUP BY k, depth
), edge AS MATERIALIZED (
  SELECT DISTINCT p.k, q.k AS up FROM prefix p JOIN prefix q ON q.c = p.c AND q.depth = p.depth - 1
), child AS (SELECT up AS k, count(*) AS n_children FROM edge GROUP BY up),
under AS MATERIALIZED (SELECT DISTINCT p.k, q.k AS low FROM prefix p JOIN prefix q ON q.c = p.c AND q.depth >= p.depth),
total AS (
  SELECT under.k, count(*) FILTER (child.n_children IS NULL) AS n_leaves, sum((node.n_convs - 1) * node.bytes) AS saved_tokens
  FROM under JOIN node ON node.k = under.low LEFT JOIN child ON child.k = under.low GROUP BY under.k
), ends AS (
  SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest
  FROM (SELECT c, arg_max(k, depth) AS k FROM prefix GROUP BY c) GROUP BY k
)
SELECT node.conv_id, node.depth, u.conv_id AS parent_conv_id, node.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM node JOIN total USING (k) LEFT JOIN child USING (k) LEFT JOIN ends USING (k)
LEFT JOIN edge ON edge.k = node.k LEFT JOIN node u ON u.k = edge.up
"""


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_sentencepiece_unigram, op3_quality_classifier, op4_feistel_pseudonyms, op5_warc_normaliser, op6_jaccard_join, op7_neardup_graph, op8_bitsliced_top_k,
    op9_token_counts, op10_language_id, op11_license_scan, op12_vector_codes, op13_prefix_trie)}
SQL: dict[str, str] = {"op5_warc_normaliser": OP5_SQL, "op8_bitsliced_top_k": OP8_SQL,
                       "op12_vector_codes": _op12_sql(), "op13_prefix_trie": OP13_SQL}
