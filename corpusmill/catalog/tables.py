"""Sources, projections, filters, joins, aggregates, set operations and sizing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.common import Group, blanks, table, texts, words
from corpusmill.functions.cleaners import words_of
from corpusmill.functions.labels import TOXICITY_FLAGS, any_flag, any_flag_strict, not_category
from corpusmill.functions.pretokenizers import pretok_whitespace
from corpusmill.operators import relational as R
from corpusmill.operators.sizing import repartition_by_size, target_partitions
from corpusmill.operators.words import token_counts
from corpusmill.session import shared_folder
from corpusmill.sources.files import (
    load_bigrams, load_dictionary, read_version, scan_csv, scan_parquet, scan_tsv, write_csv, write_version,
)

GROUP = Group()
query = GROUP.query

ALL_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"
WHITESPACE = (
    r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{24B6}-\x{24E9}\x{200C}\x{200D}]+"
    r"|[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{24B6}-\x{24E9}\x{200C}\x{200D}\s\x{0B}\x{85}\p{Z}]+"
)
WORD_COUNTS = (
    f"SELECT word, count(*)::BIGINT AS cnt FROM (SELECT unnest(regexp_extract_all(text, '{WHITESPACE}')) AS word FROM documents) GROUP BY word"
)


def document_words(spark, sf):
    return token_counts(texts(spark, sf, "documents"), pretok_whitespace(F.col("text")))


# Sources

@query("scan_tsv", ALL_DOCUMENTS)
def _(spark, sf):
    docs, path = table(spark, sf, "documents"), shared_folder(spark, "tsv")
    write_csv(docs, path, "\t")
    return scan_tsv(spark, path, docs.schema)


@query("scan_csv", ALL_DOCUMENTS)
def _(spark, sf):
    docs, path = table(spark, sf, "documents"), shared_folder(spark, "csv")
    write_csv(docs, path)
    return scan_csv(spark, path, docs.schema)


@query("scan_parquet", "SELECT doc_id, lang, n_chars FROM documents")
def _(spark, sf):
    return scan_parquet(spark, f"{sf}/documents.parquet").select("doc_id", "lang", "n_chars")


@query("versioned_path", "SELECT doc_id, lower(text) AS text, lang AS label FROM documents")
def _(spark, sf):
    """Versions with other schemas beside each other, and names that differ only as text."""
    docs, base = table(spark, sf, "documents"), shared_folder(spark, "versions")
    write_version(docs.select("doc_id", "text"), base, "1")
    write_version(docs.select("doc_id", F.lower("text").alias("text"), F.col("lang").alias("label")), base, "01")
    return read_version(spark, base, "01")


@query("load_dictionary", f"""
    SELECT term, count(*)::BIGINT AS cnt FROM (SELECT replace(unnest({words('text')}), '|', '/') AS term FROM documents) GROUP BY term HAVING count(*) >= 3
""")
def _(spark, sf):
    path = shared_folder(spark, "dictionary")
    counts = token_counts(texts(spark, sf, "documents"), words_of(F.col("text")))
    counts.select(F.concat_ws("|", F.replace("word", F.lit("|"), F.lit("/")), F.col("cnt").cast("string"))).write.text(path)
    return load_dictionary(spark, path, separator="|", count_threshold=3)


@query("load_bigrams", f"""
    WITH w AS (SELECT {words('text')} AS ws FROM documents),
    p AS (SELECT ws[i] AS "left", ws[i + 1] AS "right" FROM (SELECT ws, unnest(range(1, len(ws))) AS i FROM w))
    SELECT "left", "right", count(*)::BIGINT AS cnt FROM p GROUP BY 1, 2
""")
def _(spark, sf):
    path = shared_folder(spark, "bigrams")
    listed = texts(spark, sf, "documents").select(words_of(F.col("text")).alias("ws"))
    n = F.size("ws")
    following = F.zip_with(F.slice("ws", 1, F.greatest(n - 1, F.lit(0))), F.slice("ws", 2, n), lambda a, b: F.concat_ws(" ", a, b))
    pairs = listed.where(n > 1).select(F.explode(following).alias("pair")).groupBy("pair").agg(F.count("*").alias("cnt"))
    pairs.select(F.concat_ws(" ", "pair", F.col("cnt").cast("string"))).write.text(path)
    return load_bigrams(spark, path)


# Projections

@query("rename_text", "SELECT conv_id, turn, text AS tweet_text, role AS category FROM conversations")
def _(spark, sf):
    return R.rename_text(table(spark, sf, "conversations"), {"text": "tweet_text", "role": "category"})


@query("const_columns", "SELECT doc_id, text, 'train' AS split, 'posts' AS dataset_name FROM documents")
def _(spark, sf):
    return R.const_columns(table(spark, sf, "documents").select("doc_id", "text"), split="train", dataset_name="posts")


@query("canonical_select", "SELECT text, 1 AS label, 'test' AS split, lang AS dataset_name FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").withColumns({"label": F.lit(1), "split": F.lit("test"), "dataset_name": F.col("lang")})
    return R.canonical_select(docs)


def post_flags(spark, sf):
    labels = table(spark, sf, "labels")
    joined = texts(spark, sf, "documents").join(labels, "doc_id", "left")
    return joined.select("doc_id", "text", "lang", F.col("toxic").alias("hd"), (1 - F.col("quality")).alias("cv"), F.lit(0).alias("vo"))


POST_FLAGS = """(SELECT d.doc_id, d.text, d.lang, l.toxic AS hd, 1 - l.quality AS cv, 0 AS vo
    FROM documents d LEFT JOIN labels l USING (doc_id))"""


@query("label_any_flag_strict", f"SELECT doc_id, coalesce((hd + cv + vo > 0)::INT, 0) AS label FROM {POST_FLAGS}")
def _(spark, sf):
    return post_flags(spark, sf).select("doc_id", any_flag_strict("hd", "cv", "vo").alias("label"))


@query("label_any_flag", f"SELECT doc_id, (coalesce(hd, 0) + coalesce(cv, 0) + coalesce(vo, 0) > 0)::INT AS label FROM {POST_FLAGS}")
def _(spark, sf):
    return post_flags(spark, sf).select("doc_id", any_flag("hd", "cv", "vo").alias("label"))


@query("label_not_category", "SELECT conv_id, turn, (role IS DISTINCT FROM 'user')::INT AS label FROM conversations")
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", not_category(F.col("role"), "user").alias("label"))


# Filters

def comment_flags(spark, sf):
    """Six flags per document; the first is -1 where a document has no label, the second stays null there."""
    joined = texts(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    flags = [F.coalesce("toxic", F.lit(-1)), F.col("quality"), *[F.lit(0)] * 4]
    return joined.select(F.col("doc_id").cast("string").alias("id"), *[c.cast("int").alias(f) for c, f in zip(flags, TOXICITY_FLAGS)])


COMMENT_FLAGS = """(SELECT d.doc_id::VARCHAR AS id, coalesce(l.toxic, -1) AS toxic, l.quality AS severe_toxic, 0 AS obscene,
    0 AS threat, 0 AS insult, 0 AS identity_hate FROM documents d LEFT JOIN labels l USING (doc_id))"""


@query("drop_sentinel", "SELECT doc_id, toxic, quality FROM (SELECT d.doc_id, toxic, quality FROM documents d LEFT JOIN labels USING (doc_id))"
       " WHERE toxic IS DISTINCT FROM 1")
def _(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return R.drop_sentinel(joined, "toxic", 1).select("doc_id", "toxic", "quality")


@query("drop_sentinel_all", f"SELECT * FROM {COMMENT_FLAGS} WHERE " + " AND ".join(f"{f} IS DISTINCT FROM -1" for f in TOXICITY_FLAGS))
def _(spark, sf):
    return R.drop_sentinel_all(comment_flags(spark, sf), TOXICITY_FLAGS)


@query("filter_split", "SELECT conv_id, turn, text, role AS split FROM conversations WHERE role = 'assistant'")
def _(spark, sf):
    return R.filter_split(table(spark, sf, "conversations").withColumnRenamed("role", "split"), "assistant")


@query("filter_min_words", f"SELECT doc_id, text FROM documents WHERE len({words('text')}) >= 200")
def _(spark, sf):
    return R.filter_min_words(texts(spark, sf, "documents").select("doc_id", "text"), "text", 200)


@query("short_texts", f"SELECT doc_id, text FROM documents WHERE len({words('text')}) < 20")
def _(spark, sf):
    return R.short_texts(texts(spark, sf, "documents").select("doc_id", "text"), "text", 20)


@query("add_cleaned_text", f"SELECT doc_id, text, {blanks('translate(lower(text), chr(10), chr(32))')} AS cleaned_text FROM documents")
def _(spark, sf):
    # Without characters to delete, the punctuation step only normalises blanks.
    spec = ["lowercase", "newline_to_space", ("strip_punctuation", {"punctuation": ""})]
    return R.add_cleaned_text(texts(spark, sf, "documents").select("doc_id", "text"), spec)


# Joins, aggregates

@query("join_labels", f"""
    SELECT d.doc_id::VARCHAR AS id, d.text AS comment_text, toxic, severe_toxic, obscene, threat, insult, identity_hate
    FROM documents d JOIN {COMMENT_FLAGS} f ON d.doc_id::VARCHAR = f.id
""")
def _(spark, sf):
    texts = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("comment_text"))
    return R.join_labels(texts, comment_flags(spark, sf), "id")


@query("distinct_values", "SELECT DISTINCT source FROM documents")
def _(spark, sf):
    return R.distinct_values(table(spark, sf, "documents"), "source")


@query("value_counts", f"SELECT severe_toxic, count(*)::BIGINT AS count FROM {COMMENT_FLAGS} WHERE severe_toxic IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return R.value_counts(comment_flags(spark, sf), "severe_toxic")


@query("table_shape", "SELECT count(*)::BIGINT AS n_rows, 5::BIGINT AS n_columns FROM documents")
def _(spark, sf):
    return R.table_shape(table(spark, sf, "documents"))


@query("table_bytes_nested", "SELECT sum(12 + 4 * len(embedding))::BIGINT AS n_bytes FROM embeddings")
def _(spark, sf):
    return R.table_bytes(table(spark, sf, "embeddings"))


@query("table_bytes", "SELECT sum(16 + strlen(text) + strlen(lang) + strlen(source))::BIGINT AS n_bytes FROM documents")
def _(spark, sf):
    return R.table_bytes(table(spark, sf, "documents"))


@query("token_counts", WORD_COUNTS)
def _(spark, sf):
    return document_words(spark, sf)


# Limits

@query("head", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5")
def _(spark, sf):
    return R.head(table(spark, sf, "documents").select("doc_id", "lang", "source"), 5, "doc_id")


@query("top_k_vocab", f"SELECT word, cnt FROM ({WORD_COUNTS}) WHERE cnt >= 2 ORDER BY cnt DESC, word LIMIT 500")
def _(spark, sf):
    return R.top_k_vocab(document_words(spark, sf), 500, 2)


# Set operations and validation

@query("union_splits", """
    SELECT doc_id AS id, text, 'train' AS split FROM documents
    UNION ALL SELECT item_id, text, 'dev' FROM benchmark UNION ALL SELECT conv_id, text, 'test' FROM conversations
""")
def _(spark, sf):
    frames = [("documents", "doc_id"), ("benchmark", "item_id"), ("conversations", "conv_id")]
    return R.union_splits(*[table(spark, sf, t).select(F.col(i).alias("id"), "text") for t, i in frames])


@query("union_sources", """
    SELECT doc_id, text, lang, NULL::VARCHAR AS role FROM documents
    UNION ALL SELECT NULL, text, NULL, role FROM conversations UNION ALL SELECT doc_id, text, lang, NULL FROM documents
""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return R.union_sources([docs, table(spark, sf, "conversations").select("role", "text"), docs])


@query("require_columns", ALL_DOCUMENTS)
def _(spark, sf):
    return R.require_columns(table(spark, sf, "documents"), ["text", "lang"])


@query("validate_split_domain", "SELECT DISTINCT role AS split FROM (SELECT role FROM conversations UNION ALL SELECT 'dev' FROM documents) WHERE role <> 'dev'")
def _(spark, sf):
    roles = table(spark, sf, "conversations").select(F.col("role").alias("split"))
    return R.validate_split_domain(roles.union(table(spark, sf, "documents").select(F.lit("dev"))))


# Sizing: four workers with the stated memory; parts of at least `least` bytes, ten per worker.
SIZES = [("all in one", 1e9, 10**12), ("few", 1e9, 300_000), ("by memory", 20_000.0, 1_000), ("by size", 1e9, 50_000)]


def _sizing_sql(name: str, memory: float, least: int) -> str:
    return f"""SELECT '{name}' AS rule, n_bytes, (CASE WHEN n_bytes <= {least} THEN 1
        WHEN n_bytes / 4 <= {least} THEN round_even(n_bytes / {least}, 0)
        ELSE greatest(greatest(1, ceil(n_bytes / ({memory} * 4))) * 4, least(ceil(n_bytes / {least}) - 1, 40)) END)::BIGINT AS n_partitions FROM b"""


@query("target_partitions",
       f"WITH b AS ({GROUP.oracles['table_bytes']}) " + " UNION ALL ".join(_sizing_sql(*s) for s in SIZES))
def _(spark, sf):
    docs = table(spark, sf, "documents")
    rows = [target_partitions(docs, 4, memory, least).withColumn("rule", F.lit(name)) for name, memory, least in SIZES]
    return R.union_sources(rows)


@query("repartition_by_size", ALL_DOCUMENTS)
def _(spark, sf):
    return repartition_by_size(table(spark, sf, "documents"), workers=4, memory_per_worker=1e9, min_bytes=100_000)


