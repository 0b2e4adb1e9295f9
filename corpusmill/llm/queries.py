"""The registered queries of this subpackage: one per operator, over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import byte_bpe, conversation_repair, jaccard_join, language_model, mixing, periodic_runs, quality_model, quality_rules, substring_dedup, token_counts, toxicity, url_filter, vantage

BYTE_RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.load_pieces(public_tokenizers.path(PIECES))
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), pieces)


def encode_and_decode(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    ranks = byte_bpe.load_ranks(public_tokenizers.path(BYTE_RANKS))
    decoded = byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def mix_documents(docs: DataFrame, **names: str) -> tuple[DataFrame, DataFrame]:
    """(`docs` with size and taken, one row per source with its words and target) for the standard mix."""
    mixed, sizes, targets = mixing.mix_sources(docs, F.array("source"), mixing.capped_targets, **names)
    rows = [(s, sizes[s], float(targets[s])) for s in sizes]
    return mixed, docs.sparkSession.createDataFrame(rows, "mix_source string, source_size bigint, target double")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, sources = mix_documents(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    # As many rows as sources, which the flow has bounded.
    joined = mixed.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("mix_source")))
    return joined.select("doc_id", "size", "source_size", "target", "taken")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(conversation_repair.damage(_table(spark, sf_dir, "conversations")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(_table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, url_filter.rule_entries(spark, url_filter.RULES).unionByName(url_filter.unwanted_hosts(pages)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_quality_rules, op3_token_counts, op4_byte_bpe, op5_substring_dedup, op6_mixing, op7_jaccard_join,
        op8_nearest_neighbours, op9_language_model, op10_toxicity, op11_conversation_repair, op12_periodic_runs, op13_url_filter,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op6_mixing": rf"""
        WITH sized AS (
            SELECT doc_id, source, len({_WORDS}) AS size, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS draw FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place FROM sized GROUP BY source
        ), weighed AS (
            SELECT *, [3, 1, 2][(place % 3 + 1)::INT] AS w, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM sources
        ), filling AS (
            -- the sources that reach twice their size are those with the least size per weight
            SELECT *, budget - coalesce(sum(2 * source_size) OVER low, 0)::DOUBLE AS remaining, sum(w) OVER high AS weight_left
            FROM weighed WINDOW low AS (ORDER BY source_size::DOUBLE / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                high AS (ORDER BY source_size::DOUBLE / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        ), level AS (
            SELECT arg_min(remaining, source_size::DOUBLE / w) AS remaining, arg_min(weight_left, source_size::DOUBLE / w) AS weight_left
            FROM filling WHERE remaining * w / weight_left <= 2 * source_size
        ), targets AS (
            SELECT source, source_size, least(2.0::DOUBLE * source_size, level.remaining * w / level.weight_left) AS target FROM weighed, level
        ), placed AS (
            SELECT doc_id, size, source_size, target, round(target)::BIGINT // greatest(source_size, 1) AS copies, round(target)::BIGINT % greatest(source_size, 1) AS rest,
                sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id NULLS FIRST) - size AS past
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size::BIGINT AS size, source_size, target, (size * (copies + CASE WHEN 2 * past + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM placed
    """,
    "op8_nearest_neighbours": """
        WITH clean AS (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), normed AS (
            SELECT vec_id, v, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b)) AS norm FROM clean
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                list_reduce(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i]), lambda a, b: a + b) / (q.norm * c.norm) AS score
            FROM normed q JOIN normed c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
        )
        SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_conversation_repair": r"""
        WITH RECURSIVE numbered AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
                list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS spot
            FROM conversations
        ), spots AS (
            SELECT *, xor(list_reduce(spot, lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)), 4294967295), 4294967295) % 20 AS kind
            FROM numbered
        ), damaged AS (
            SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM spots WHERE kind <> 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS pos, substr(role, 1, 1) AS initial FROM damaged
        ), judged AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
                pos > 1 AND lag(initial) OVER (PARTITION BY conv ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS odd
            FROM placed
        ), facts AS (
            SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (odd) AS illegal, count(*) AS n
            FROM judged GROUP BY conv
        ), steps AS (
            -- the cheapest edits from the four states of the grammar (nothing yet, after system, user, assistant), row by row from the end
            SELECT conv, n AS pos, {'c': 0::BIGINT, 'a': ''} AS s0, {'c': 6::BIGINT, 'a': 'II'} AS s1, {'c': 3::BIGINT, 'a': 'I'} AS s2, {'c': 0::BIGINT, 'a': ''} AS s3 FROM facts
            UNION ALL
            SELECT conv, pos - 1,
                list_min([o0, {'c': o2.c + 3, 'a': 'I' || o2.a}, {'c': o3.c + 6, 'a': 'II' || o3.a}]), list_min([o1, {'c': o2.c + 3, 'a': 'I' || o2.a}, {'c': o3.c + 6, 'a': 'II' || o3.a}]),
                list_min([o2, {'c': o3.c + 3, 'a': 'I' || o3.a}]), list_min([o3, {'c': o2.c + 3, 'a': 'I' || o2.a}])
            FROM (SELECT conv, pos,
                    list_min([{'c': s0.c + 4, 'a': 'D' || s0.a}, {'c': s1.c + more + if(initial = 's', 0, 999), 'a': 'K' || s1.a},
                        {'c': s2.c + more + if(initial = 'u', 0, 999), 'a': 'K' || s2.a}, {'c': s2.c + more + 3, 'a': 'R' || s2.a}]) AS o0,
                    list_min([{'c': s1.c + 4, 'a': 'D' || s1.a}, {'c': s2.c + more + if(initial = 'u', 0, 999), 'a': 'K' || s2.a}, {'c': s2.c + more + 3, 'a': 'R' || s2.a}]) AS o1,
                    list_min([{'c': s2.c + 4, 'a': 'D' || s2.a}, {'c': s3.c + more + if(initial = 'a', 0, 999), 'a': 'K' || s3.a}, {'c': s3.c + more + 3, 'a': 'R' || s3.a}]) AS o2,
                    list_min([{'c': s3.c + 4, 'a': 'D' || s3.a}, {'c': s2.c + more + if(initial = 'u', 0, 999), 'a': 'K' || s2.a}, {'c': s2.c + more + 3, 'a': 'R' || s2.a}]) AS o3
                FROM (SELECT s.*, initial, CASE WHEN fault IN ('blank', 'duplicate') THEN 999 WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more
                    FROM steps s JOIN judged j ON s.conv = j.conv AND s.pos = j.pos WHERE s.pos > 0))
        ), audits AS (
            SELECT conv, s0.c AS cost, s0.a AS audit FROM steps WHERE pos = 0
        ), letters AS (
            SELECT conv, audit, unnest(range(1, length(audit) + 1)) AS i FROM audits
        ), edits AS (
            SELECT conv, i, audit[i] AS edit, i - length(replace(audit[1:i], 'I', '')) AS inserted FROM letters
        ), turns AS (
            SELECT e.conv, i, edit, role, text, row_number() OVER (PARTITION BY e.conv ORDER BY i) - 1 AS place,
                coalesce(first_value(edit = 'K' AND initial = 's') OVER (PARTITION BY e.conv ORDER BY i), false) AS led
            FROM edits e LEFT JOIN judged j ON e.conv = j.conv AND j.pos = i - inserted AND edit <> 'I' WHERE edit <> 'D'
        ), repaired AS (
            SELECT conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led::INT) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i) AS lines
            FROM turns GROUP BY conv
        )
        SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
            coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id, conv FROM numbered) LEFT JOIN facts USING (conv) LEFT JOIN audits USING (conv) LEFT JOIN repaired USING (conv)
    """,
    "op13_url_filter": rf"""
        WITH parts AS (
            SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
        ), ruled AS (
            SELECT *, ends_with('.' || host, '.com') AS com, ends_with('.' || host, '.net') AS net, starts_with(path, '/en/') AS en FROM parts
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(host, '(^|[.-])({"|".join(url_filter.UNWANTED)})(-[^.]*)?\.') THEN 'block' ELSE 'allow' END AS verdict
        FROM (SELECT *, CASE
            WHEN en AND ends_with('.' || host, '.www.example.com') THEN 'www.example.com/en/' WHEN en AND ends_with('.' || host, '.example.com') THEN 'example.com/en/'
            WHEN com AND starts_with(path, '/') THEN 'com/' WHEN net AND starts_with(path, '/es/') THEN 'net/es/' WHEN net AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule
            FROM ruled)
    """,
}
