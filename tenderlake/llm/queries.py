"""The operators of this subpackage bound to the tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, html_text, knn_join, periodic_runs, pii_spans, quality_rules, secret_scan, simhash_dedup, source_mix, spelling_variants, token_counts, token_orc, warc_store
from .common import written


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    features = written(quality_rules.with_features(docs.select("doc_id", "text"), keep=["doc_id"]), "quality-features")
    judged = quality_rules.judged(features, quality_rules.fit(features))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op2_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    # unusable vectors stay as they are: the operator leaves them out
    vectors = rows.select("vec_id", F.when(knn_join.usable(F.col("embedding")), whole).alias("vector"))
    return knn_join.top_k(vectors, F.col("vec_id") % 50 == 0)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return html_text.extract(pages.select("page_id", "url", "html"), keep=["page_id", "url"])


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.groups(_read(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the figures of quality hold the texts' sizes as well
    docs = quality_rules.figures_with_posterior(_read(spark, sf_dir, "documents"), keep=["doc_id", "source"])
    return source_mix.mix(docs, text="text_hash", size="n_words", quality="quality").drop("copies")


def codec_digest(docs: DataFrame) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    decoded = bpe_codec.encode(docs, path, keep=["doc_id"], decoded="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_digest(_read(spark, sf_dir, "documents"))


def op7_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    archive = warc_store.store(pages.select("page_id", "url", "html"))
    # every page's URL is looked up: what comes back went through the directory, the blocks and the archives
    return archive.records(pages.select("url"), html=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("byte_bpe_50k.json"), keep=["doc_id"])


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_read(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans.digest(_read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(_read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(_read(spark, sf_dir, "documents"))


def op13_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.write(_read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2).digest()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality_rules, op2_knn_join, op3_html_text, op4_simhash_dedup, op5_source_mix, op6_bpe_codec, op7_warc_store, op8_token_counts, op9_secret_scan, op10_pii_spans, op11_periodic_runs, op12_spelling_variants, op13_token_orc)
}

ORACLES: dict[str, str] = {
    "op2_knn_join": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.w, d.w) AS BIGINT) AS score
          FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
        ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op7_warc_store": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest FROM p),
        f AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS first FROM d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
          CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to
        FROM f
    """,
    # CRC-32 by its table, made by eight shifts; near words by the texts that one deletion leaves
    "op12_spelling_variants": """
        WITH RECURSIVE steps AS (
          SELECT i, i AS v, 0 AS k FROM range(256) r(i)
          UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM steps WHERE k < 8
        ), crc AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8),
        found AS (
          SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
        ), runs AS (SELECT doc_id, run, count(*) AS c, hex(encode(concat(doc_id, ':', run))) AS x FROM found GROUP BY ALL),
        hashed AS (
          SELECT run, c, xor(list_reduce(
            list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)),
            lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]), 4294967295), 4294967295) AS h
          FROM runs, crc
        ), edited AS (
          SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, c FROM hashed
        ), words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
        cut AS (SELECT word, n, i, substr(word, 1, CAST(i AS INTEGER)) || substr(word, CAST(i AS INTEGER) + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
        pairs AS (
          SELECT DISTINCT c.word, w.word AS near FROM cut c JOIN words w ON c.rest = w.word
          UNION SELECT DISTINCT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word
          UNION SELECT a.word, b.word FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        ), near AS (
          SELECT p.word, count(*) AS n_near, first(w.word ORDER BY w.n DESC, w.word) AS best, max(w.n) AS best_n FROM pairs p JOIN words w ON p.near = w.word GROUP BY p.word
        ), forms AS (
          SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM words w LEFT JOIN near ON w.word = near.word
        ), walk AS (
          SELECT word, word AS at, form AS further FROM forms
          UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN forms f ON walk.further = f.word
        )
        SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN walk ON walk.word = f.word AND walk.further IS NULL
    """,
}
