"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from potsherd.llm import chat, decontamination, exact_dedup, license_scan, line_dedup, main_text, ngram_jaccard, oracles, packing, quality, spelling, substring_dedup, vector_codes, warc
from potsherd.llm.common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.annotate(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "links", "copies")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, quality.learn(docs, table(spark, sf_dir, "labels"))).drop("text")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.examples(rows))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.with_checksums(pieces)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(line_dedup.annotate(table(spark, sf_dir, "documents")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.annotate(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_packing": op4_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_warc_derivatives": op7_warc_derivatives,
    "op8_license_scan": op8_license_scan,
    "op9_line_dedup": op9_line_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_main_text": op13_main_text,
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": oracles.jaccard(ngram_jaccard.NGRAM, 9, 4),  # a similarity of 4/5: shared / (a + b - shared)
    # formatted_chars follows from the template: each turn adds its escaped role and text and 15 characters to every example that holds it
    "op3_chat_formatting": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        o AS (
            SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
                   15 + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '\</turn>'), ':', '\c'))
                      + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '\</turn>')) AS chars
            FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ),
        e AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM o)
        SELECT conv_id, max(n) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
               (sum(upto) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op7_warc_derivatives": oracles.warc(),
    "op10_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
             g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
        FROM d JOIN g USING (text_sha256)
    """,
    "op11_vector_codes": oracles.lloyd(),
    "op12_spelling_variants": oracles.spelling(),
    # the tables' articles stand in an element of that name
    "op13_main_text": r"""
        WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages),
        b AS (SELECT page_id, url, list_transform(regexp_split_to_array(body, '</?(?:h1|p)>'), lambda x: regexp_replace(replace(x, '<br>', ' '), '</?b>', '', 'g')) AS blocks FROM a),
        c AS (
            SELECT page_id, url, list_transform(blocks, lambda x: trim(regexp_replace(
                regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks FROM b
        ),
        d AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM c)
        SELECT page_id, url, text, length(text) AS n_chars FROM d
    """,
}
