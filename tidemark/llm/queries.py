"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    conversation_repair,
    fingerprints,
    html_text,
    jaccard_join,
    line_dedup,
    mtree,
    packing,
    ppm_text,
    quality,
    substring_dedup,
    token_alignment,
    token_counts,
)
from tidemark.llm.shipping import ship
from tidemark.scratch import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public vocabulary lies; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bpe.encode_and_decode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return docs.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents arrive; those of low quality are deleted, twice by mistake; toxic ones are recounted without their first line."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    counts = materialise(token_counts.counted(docs), "counts")  # joins below move counts, never texts
    rollup = token_counts.Rollup(spark)
    rollup.commit(1, token_counts.inserts(counts))
    low = token_counts.deletes(counts.join(marks.filter("quality = 0"), "doc_id"))
    rollup.commit(2, low)
    rollup.commit(2, low)
    toxic = marks.filter("quality = 1 AND toxic = 1")
    rest = F.expr("CASE WHEN instr(text, '\n') > 0 THEN substring(text, instr(text, '\n') + 1) ELSE '' END")
    shorter = token_counts.counted(docs.withColumn("text", rest)).join(toxic, "doc_id")
    rollup.commit(3, token_counts.recounts(counts.join(toxic, "doc_id"), shorter))
    return rollup.totals()


@_query
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_of_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return ppm_text.score(table(spark, sf_dir, "documents"), F.crc32(text_of_id) % 7 == 2)


@_query
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return mtree.exact_top_k(vectors, vectors.filter("vec_id % 100 = 0"), 10)


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    apart = F.coalesce(quality.held_out(5, 0), F.lit(False))
    machine = quality.train(docs.filter(~apart), table(spark, sf_dir, "labels"))
    return quality.score(docs, machine).select(
        "doc_id",
        apart.alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@_query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@_query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


@_query
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with the faults that the contract sets by a checksum of conversation and turn; nulls are one space."""
    word = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat_ws(":", word("conv_id"), word("turn")).cast("binary")) % 20
    text, role = word("text"), word("role")
    return (
        conversations.select("conv_id", "turn", dealt.alias("fault"), role.alias("role"), text.alias("text"))
        .filter("fault <> 0")
        .withColumn("text", F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", "role", "text")
    )


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.plan_repair(damaged(conversations), conversations).digests()


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


_STRIP = "E' \\t\\n\\x0b\\x0c\\r'"

ORACLES = {
    "op2_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (
            SELECT doc_id, pos, line,
                   translate(trim(line, {_STRIP}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), frequent AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), marked AS (
            SELECT k.doc_id, pos, line, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone
            FROM keyed k LEFT JOIN frequent f ON k.key = f.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op5_token_counts": """
        WITH marks AS (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
        now AS (
            SELECT d.source, d.lang,
                   CASE WHEN m.toxic = 1 THEN
                       CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END
                   ELSE coalesce(text, '') END AS text
            FROM documents d LEFT JOIN marks m ON d.doc_id = m.doc_id
            WHERE coalesce(m.quality, 1) <> 0
        ), counted AS (
            SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS tokens FROM now
            UNION ALL
            SELECT source, lang, 'quads-1', CAST(ceil(length(text) / 4.0) AS BIGINT) FROM now
        )
        SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
        FROM counted GROUP BY source, lang, tokenizer""",
    "op7_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pairs
        )
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10""",
}
