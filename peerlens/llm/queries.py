"""The registered queries of this subpackage and their DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.llm import bpe, decontam, embedgraph, hardneg, license, minhash, sharding, spelling, tokencount, tokenfile, topk, toxicity, warc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
TOXIC = 0.7
SHARDS = 24
TOKEN_LIMIT = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and the kept document of every row of ``documents``."""
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "kept")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``pages`` as WARC archives, index them, look up every page's URL and read the records back."""
    pages = _table(spark, sf_dir, "pages")
    index = warc.build_index(warc.write_archives(pages))
    captures = warc.lookup(index, pages.select(warc.url_key(F.col("url"))))
    return warc.read_records(captures).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text of ``documents``; digests of both."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.bpe_encode(docs, RANKS, public_tokenizers.PATTERN, decoded_col="decoded")
    return bpe.with_digests(coded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all ``embeddings``."""
    return embedgraph.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def held_out(id_col: str) -> Column:
    """Rows that no label is learned from: crc32 of the id as text leaves 1 when divided by 3 (null ids: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def toxicity_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.train(docs, _table(spark, sf_dir, "labels").where(~held_out("doc_id")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text of ``documents``."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.with_scores(docs, toxicity_model(docs, spark, sf_dir))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted")
    )


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in SHARDS shards of near equal bytes."""
    placed = sharding.kd_shards(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids to plane files and read them back."""
    index = tokenfile.write_token_files(_table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID)
    return tokenfile.read_token_files(index).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a ``benchmark`` item of which it holds a copy."""
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed licence notices in every whole text of ``documents``."""
    found = license.licence_paragraphs(_table(spark, sf_dir, "documents")).where("confirmed")
    return found.select("doc_id", "paragraph", "family", "probability")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text of ``documents`` by the counting transducer."""
    return tokencount.token_counts(_table(spark, sf_dir, "documents"), PIECE_MODEL, TOKEN_LIMIT)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of at least 5 code points that occurs 3 times or more in ``documents``."""
    counts = spelling.word_counts(_table(spark, sf_dir, "documents"), every=97, least_size=5)
    return spelling.spelling_forms(counts.where("n >= 3"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows of ``embeddings`` for every row whose id is divisible by 50."""
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row of ``embeddings`` whose id is divisible by 100; rows of ids divisible by 7 take the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_warc,
        op3_byte_bpe,
        op4_embedding_near_dedup,
        op5_toxicity,
        op6_kd_sharding,
        op7_token_files,
        op8_license_scan,
        op9_token_counts,
        op10_decontamination,
        op11_spelling_variants,
        op12_exact_top_k,
        op13_hard_negatives,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op2_warc": """
WITH body AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), sized AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM body
), marked AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM marked
""",
    # the crc32 of a word is linear in its bytes: a term per byte value and distance from the end, and one per length
    "op11_spelling_variants": """
WITH RECURSIVE low_bytes AS (
  SELECT i AS b, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS t
  FROM range(256) AS r(i)
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS owner, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), words_of AS (
  SELECT owner, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, count(*) AS n FROM runs GROUP BY ALL
), coded AS (
  SELECT *, hex(encode(owner || ':' || word)) AS code, length(hex(encode(owner || ':' || word))) // 2 AS size FROM words_of
), terms AS (
  SELECT 0 AS d, b, t FROM low_bytes
  UNION ALL
  SELECT d + 1, terms.b, xor(low_bytes.t, terms.t >> 8) FROM terms JOIN low_bytes ON low_bytes.b = terms.t & 255
  WHERE d < (SELECT max(size) FROM coded)
), starts AS (
  SELECT 0 AS size, 4294967295 AS s
  UNION ALL
  SELECT size + 1, xor(low_bytes.t, s >> 8) FROM starts JOIN low_bytes ON low_bytes.b = s & 255
  WHERE size < (SELECT max(size) FROM coded)
), bytes AS (
  SELECT owner, word, n, size, i, ('0x' || substr(code, 2 * i + 1, 2))::BIGINT AS b
  FROM (SELECT *, unnest(range(size)) AS i FROM coded)
), summed AS (
  SELECT owner, word, any_value(n) AS n, bytes.size, bit_xor(t) AS x
  FROM bytes JOIN terms ON terms.b = bytes.b AND terms.d = bytes.size - 1 - i GROUP BY owner, word, bytes.size
), hashed AS (
  SELECT word, n, xor(xor(x, s), 4294967295) AS h FROM summed JOIN starts USING (size)
), kept AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2) ELSE word END AS word, n FROM hashed
), vocab AS (
  SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), holes AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest, length(word) AS size
  FROM (SELECT word, unnest(range(length(word))) AS i FROM vocab)
), links AS (
  SELECT a.word, b.word AS near FROM holes a JOIN holes b ON a.size = b.size AND a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT rest, holes.word FROM holes JOIN vocab ON vocab.word = rest
  UNION SELECT holes.word, rest FROM holes JOIN vocab ON vocab.word = rest
), best AS (
  SELECT links.word, near, n AS near_n, count(*) OVER (PARTITION BY links.word) AS n_near,
         row_number() OVER (PARTITION BY links.word ORDER BY n DESC, encode(near)) AS place
  FROM links JOIN vocab ON vocab.word = near
), forms AS (
  SELECT vocab.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM vocab LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON b.word = vocab.word
), chains AS (
  SELECT word, coalesce(form, word) AS upper FROM forms
  UNION
  SELECT chains.word, forms.form FROM chains JOIN forms ON forms.word = chains.upper WHERE forms.form IS NOT NULL
)
SELECT forms.word, n, n_near, form, form_n, upper AS root
FROM forms JOIN chains ON chains.word = forms.word JOIN (SELECT word FROM forms WHERE form IS NULL) ends ON ends.word = chains.upper
""",
    "op12_exact_top_k": """
WITH ints AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op13_hard_negatives": """
WITH ints AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM ints a JOIN ints r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
""",
}
