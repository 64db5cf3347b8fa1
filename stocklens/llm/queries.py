"""Registered queries of the text operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stocklens.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from stocklens.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from stocklens.llm.lm import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.decontam import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.pages import main_texts

    return main_texts(table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from stocklens.llm.wordpiece import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.quality import quality_scores

    return quality_scores(spark, sf_dir)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.spans import repeated_spans

    return repeated_spans(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.mtree import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.toxicity import toxicity_scores

    return toxicity_scores(spark, sf_dir)


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.fingerprints import document_fingerprints

    return document_fingerprints(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.audit import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocklens.llm.phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_decontamination": op3_decontamination,
    "op4_html_extraction": op4_html_extraction,
    "op5_token_counts": op5_token_counts,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_toxicity": op10_toxicity,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_source_divergence": op12_source_divergence,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op9_exact_top_k": """
        WITH v AS (
            SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, q.rid AS q_rid, c.vec_id, c.rid, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.rid <> c.rid AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY q_rid ORDER BY score DESC, vec_id, rid) AS r FROM pairs
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5""",
    "op12_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), words AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
        kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY ALL HAVING count(DISTINCT rid) >= 10),
        langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM d),
        counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        totals AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
        p AS (
            SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (t.total + 2 * l.v) AS p,
                   1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
            FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
        ), summed AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ), terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE C) AS r
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 10""",
    "op13_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), lines AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        words AS (SELECT lang, unnest(w) AS phrase FROM lines),
        runs AS (
            SELECT lang, phrase FROM words
            UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM lines
            UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM lines
        ), f AS (SELECT lang, phrase, count(*)::HUGEINT AS a, string_split(phrase, ' ') AS w FROM runs GROUP BY ALL HAVING count(*) >= 10),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, 1000000::HUGEINT * c.a * c.a // (l.a * r.a) AS score
            FROM (SELECT *, unnest(range(1, len(w))) AS k FROM f) c
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
        ), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (
            SELECT lang, array_to_string(w[s:s + 1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT *, unnest([1, 2]) AS s FROM f WHERE len(w) = 3) GROUP BY ALL
        ), kept AS (SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE C) AS rank FROM kept)
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM ranked JOIN (SELECT lang, count(*) AS n FROM words GROUP BY lang) USING (lang) WHERE rank <= 2000""",
}
