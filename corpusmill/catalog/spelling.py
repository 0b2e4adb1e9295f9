"""Spelling correction: dictionary, delete variants, candidates, best terms, whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.catalog.common import Group, texts, words
from corpusmill.functions.cleaners import words_of
from corpusmill.operators import spelling as S
from corpusmill.operators.words import token_counts
from corpusmill.plans.corpus import SPELLING, spell_correct
from corpusmill.session import materialize, shared_folder
from corpusmill.streaming.clean import run_clean_stream

GROUP = Group()
query = GROUP.query

# The checking engine measures distances in bytes, so letters beyond ASCII are written as one hyphen each.
PLAIN = r"regexp_replace(lower(text), '[^\x00-\x7F]', '-', 'g')"
DICTIONARY = f"""(SELECT term, count(*)::BIGINT AS cnt FROM (SELECT unnest({words(PLAIN)}) AS term FROM conversations) GROUP BY term)"""
TOKENS = f"(SELECT unnest({words(PLAIN)}) AS token FROM documents UNION SELECT unnest({words(PLAIN)}) FROM conversations)"


def plain(text):
    return F.regexp_replace(F.lower(text), r"[^\x00-\x7F]", "-")


def dictionary(spark, sf, source="conversations", threshold=1, text=plain):
    counts = token_counts(texts(spark, sf, source), words_of(text(F.col("text"))))
    return materialize(S.build_dictionary(counts, threshold), "dictionary")


def tokens(spark, sf):
    """The distinct words of the documents and the conversations."""
    parts = [texts(spark, sf, name).select(F.explode(words_of(plain(F.col("text")))).alias("token")) for name in ("documents", "conversations")]
    return parts[0].unionByName(parts[1]).distinct()


def bigrams(spark, sf):
    """Neighbouring words of the conversations."""
    listed = texts(spark, sf, "conversations").select(words_of(F.lower("text")).alias("ws"))
    shifted = F.zip_with(F.concat(F.array(F.lit(None).cast("string")), F.col("ws")), "ws", lambda a, b: F.struct(a.alias("left"), b.alias("right")))
    pairs = listed.select(F.explode(shifted).alias("p")).select("p.left", "p.right").dropna()
    return materialize(pairs.groupBy("left", "right").agg(F.count("*").alias("cnt")), "bigrams")


@query("build_dictionary", f"""
    SELECT term, count(*)::BIGINT AS cnt FROM (SELECT unnest({words('lower(text)')}) AS term FROM documents) GROUP BY term HAVING count(*) >= 5
""")
def _(spark, sf):
    return dictionary(spark, sf, "documents", 5, F.lower)


@query("delete_index", f"""
    WITH v0 AS (SELECT term, cnt, substr(term, 1, 7) AS v FROM {DICTIONARY}),
    v1 AS (SELECT DISTINCT term, cnt, substr(v, 1, i - 1) || substr(v, i + 1) AS v FROM (SELECT *, unnest(range(1, length(v) + 1)) AS i FROM v0)),
    v2 AS (SELECT DISTINCT term, cnt, substr(v, 1, i - 1) || substr(v, i + 1) AS v FROM (SELECT *, unnest(range(1, length(v) + 1)) AS i FROM v1))
    SELECT v AS variant, term, cnt FROM (SELECT * FROM v0 UNION SELECT * FROM v1 UNION SELECT * FROM v2)
""")
def _(spark, sf):
    return S.delete_index(dictionary(spark, sf))


# The engine's distance allows edits between swapped letters. Where its plain distance is above 2, a pair
# counts only if it has a swap with at most one more edit on either side of it. Pairs come from common
# variants: the first seven letters without up to two of them.
VARIANTS = """(SELECT DISTINCT {w}, v FROM (
    SELECT {w}, unnest(list_concat([p], list_transform(range(1, length(p) + 1), lambda i: substr(p, 1, i - 1) || substr(p, i + 1)),
        flatten(list_transform(range(1, length(p) + 1), lambda i: list_transform(range(i, length(p)),
            lambda j: substr(p, 1, i - 1) || substr(p, i + 1, j - i) || substr(p, j + 2)))))) AS v
    FROM (SELECT {w}, substr({w}, 1, 7) AS p FROM {source})))"""
CANDIDATES = f"""
    (SELECT token, term, cnt, least(d, 2)::INT AS distance FROM (
        SELECT token, term, cnt, damerau_levenshtein(token, term) AS d
        FROM (SELECT DISTINCT token, term FROM {VARIANTS.format(w='token', source=TOKENS)} JOIN {VARIANTS.format(w='term', source=DICTIONARY)} USING (v)
            WHERE abs(length(token) - length(term)) <= 2) JOIN {DICTIONARY} USING (term))
    WHERE d <= 2 AND (levenshtein(token, term) <= 2 OR len(list_filter(
        range(1, length(token)), lambda i: len(list_filter(range(i - 1, i + 2), lambda j: j >= 1
            AND substr(token, i, 1) = substr(term, j + 1, 1) AND substr(token, i + 1, 1) = substr(term, j, 1)
            AND damerau_levenshtein(substr(token, 1, i - 1), substr(term, 1, j - 1))
              + damerau_levenshtein(substr(token, i + 2), substr(term, j + 2)) <= 1)) > 0)) > 0))"""


@query("spell_candidates", f"SELECT token, term, cnt, distance FROM {CANDIDATES}")
def _(spark, sf):
    return S.spell_candidates(tokens(spark, sf), dictionary(spark, sf))


@query("spell_best", f"""
    SELECT token, term, cnt, distance FROM {CANDIDATES} QUALIFY row_number() OVER (PARTITION BY token ORDER BY distance, cnt DESC, term) = 1
""")
def _(spark, sf):
    return S.spell_best(tokens(spark, sf), dictionary(spark, sf))


@query("spell_compound")
def _(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    return S.spell_compound(docs, "text", ["doc_id"], dictionary(spark, sf, text=F.lower), bigrams(spark, sf)).select("doc_id", "corrected")


@query("spell_correct")
def _(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    return spell_correct(docs, "text", dictionary(spark, sf, text=F.lower), bigrams(spark, sf))


@query("clean_stream_spelling")
def _(spark, sf):
    arrived = texts(spark, sf, "conversations").select("conv_id", "turn", "text")
    folder = shared_folder(spark, "stream")
    arrived.repartition(4, "conv_id").write.parquet(f"{folder}/in")
    words = {"dictionary": dictionary(spark, sf, text=F.lower), "bigrams": bigrams(spark, sf)}
    spec = ["lowercase", "strip_urls", (SPELLING, words), "strip_punctuation"]
    run_clean_stream(spark, f"{folder}/in", arrived.schema, f"{folder}/out", f"{folder}/state", spec)
    return spark.read.parquet(f"{folder}/out").select("conv_id", "turn", "cleaned_text")
