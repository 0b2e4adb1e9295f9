import string
from itertools import groupby

import pytest
from conftest import column_values, same
from pyspark.sql import functions as F

from corpusmill.functions import cleaners as C

STOP = set(C.ENGLISH_STOPWORDS)


# What is wanted, found by walking over the characters.

def is_word(c):
    return c == "_" or c.isalnum()


def without_runs(text, openers, inside):
    """The text without every opener that at least one more character of the wanted kind follows, and all of these."""
    out, i = [], 0
    while i < len(text):
        end = next((i + len(o) for o in openers if text.startswith(o, i)), None)
        if end is not None and end < len(text) and inside(text[end]):
            while end < len(text) and inside(text[end]):
                end += 1
            i = end
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def no_url(text):
    return without_runs(text, ("http", "www"), lambda c: not c.isspace())


def no_mention(text):
    return without_runs(text, ("@",), is_word)


def no_rt(text):
    runs = ["".join(run) for _, run in groupby(text, is_word)]
    return "".join(run for run in runs if run.lower() != "rt")


def no_punctuation(word):
    return "".join(c for c in word if c not in string.punctuation)


def over_words(fn):
    """A text form from a function of a word list."""
    return lambda text: " ".join(fn(text.split()))


def over_text(fn):
    """A word-list form from a function of a text."""
    return lambda words: fn(" ".join(words)).split()


def mapped(fn):
    return lambda words: list(map(fn, words))


def only(keep):
    return lambda words: list(filter(keep, words))


# name: (text form, word-list form, parameters)
CASES = {
    "lowercase": (str.lower, mapped(str.lower), {}),
    "strip_urls": (no_url, mapped(no_url), {}),
    "strip_punctuation": (over_words(mapped(no_punctuation)), mapped(no_punctuation), {}),
    "keep_alpha_words": (over_words(only(str.isalpha)), only(str.isalpha), {}),
    "newline_to_space": (lambda t: " ".join(t.split("\n")), mapped(lambda w: " ".join(w.split("\n"))), {}),
    "keep_ascii_words": (over_words(only(str.isascii)), only(str.isascii), {}),
    "strip_mentions": (no_mention, over_text(no_mention), {}),
    "limit_chars": (lambda t: t[:7], over_text(lambda t: t[:7]), {"limit": 7}),
}

LITERAL = [
    ("lowercase", "Some TEXT", "some text"),
    ("strip_urls", "see http://a.b/c now www.x. http www", "see  now  http www"),
    ("strip_punctuation", "it's  (so) -- good!", "its so  good"),
    ("keep_alpha_words", "abc a1 don't é 3", "abc é"),
    ("newline_to_space", "a\nb\n", "a b "),
    ("keep_ascii_words", "abc é naïve x", "abc x"),
    ("strip_mentions", "hi @bob_1, a@b @ x", "hi , a @ x"),
    ("strip_retweet", "RT: art rt _rt (Rt)", ": art  _rt ()"),
    ("limit_chars", "x" * 400, "x" * 300),
]


@pytest.mark.parametrize("name, text, wanted", LITERAL)
def test_literal_results(spark, name, text, wanted):
    assert spark.createDataFrame([(text,)], "t string").select(C.cleaner(name).text(F.col("t"))).first()[0] == wanted


@pytest.mark.parametrize("name", CASES)
def test_text_mode(string_frame, strings, name):
    text, _, params = CASES[name]
    same(column_values(string_frame, C.cleaner(name, **params).text(F.col("t"))), map(text, strings), strings)


@pytest.mark.parametrize("name", CASES)
def test_word_mode(string_frame, strings, name):
    _, words, params = CASES[name]
    frame = string_frame.select("i", F.split("t", " ").alias("t"))
    wanted = [words(t.split(" ")) for t in strings]
    same(column_values(frame, C.cleaner(name, **params).words(F.col("t"))), wanted, strings)


def test_retweet_marks_are_whole_words(string_frame, strings):
    same(column_values(string_frame, C.cleaner("strip_retweet").text(F.col("t"))), map(no_rt, strings), strings)
    frame = string_frame.select("i", F.split("t", " ").alias("t"))
    wanted = [over_text(no_rt)(t.split(" ")) for t in strings]
    same(column_values(frame, C.cleaner("strip_retweet").words(F.col("t"))), wanted, strings)


def test_stopwords_in_word_mode(string_frame, strings):
    frame = string_frame.select("i", F.split("t", " ").alias("t"))
    wanted = [[w for w in t.split(" ") if w.lower() not in STOP] for t in strings]
    same(column_values(frame, C.cleaner("stopwords").words(F.col("t"))), wanted, strings)


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("I don't know.", ["I", "do", "n't", "know", "."]),
        ("He can't go. She's here!", ["He", "ca", "n't", "go", ".", "She", "'s", "here", "!"]),
        ('Say "yes", please; ok?', ["Say", "``", "yes", "''", ",", "please", ";", "ok", "?"]),
        ("see https://t.co/a @bob", ["see", "https", ":", "//t.co/a", "@", "bob"]),
        ("cannot gonna (a) 3,000 x--y", ["can", "not", "gon", "na", "(", "a", ")", "3,000", "x", "--", "y"]),
        ("Good muffins cost $3.88\nin New York.", ["Good", "muffins", "cost", "$", "3.88", "in", "New", "York", "."]),
        ("They'll wait... we'd go", ["They", "'ll", "wait", "...", "we", "'d", "go"]),
        ("", []),
    ],
)
def test_treebank_tokens(spark, text, tokens):
    row = spark.createDataFrame([(text,)], "t string").select(C.treebank_tokens(F.col("t"))).first()
    assert row[0] == tokens


def test_stopwords_in_text_mode(spark):
    df = spark.createDataFrame([("I don't like THE cat.",), (None,)], "t string")
    assert [r[0] for r in df.select(C.cleaner("stopwords").text(F.col("t"))).collect()] == ["n't like cat .", None]


def test_default_chain_keeps_the_consequences_of_its_order(spark):
    df = spark.createDataFrame([("Look at https://t.co/a @bob RT don't",)], "t string")
    cleaned = df.select(C.clean_text(F.col("t"))).first()[0]
    assert cleaned == "look tcoa bob  nt"


def test_chain_equals_python_chain_and_stays_in_codegen(spark, string_frame, strings):
    spec = [n for n, _ in C.DEFAULT_CHAIN if n != "stopwords"]

    def chain(t):
        for n in spec:
            t = no_rt(t) if n == "strip_retweet" else CASES[n][0](t)
        return t

    cleaned = C.clean_text(F.col("t"), spec)
    same(column_values(string_frame, cleaned), map(chain, strings), strings)
    frame = spark.range(10).select(F.col("id").cast("string").alias("t"))
    plan = frame.select(cleaned)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "*(1) Project" in plan


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    for name in C._registry:
        assert df.select(C.cleaner(name).text(F.col("t"))).first()[0] is None, name


def test_dispatch_and_registration(spark):
    C.register_cleaner("shout", lambda c: F.upper(c))
    df = spark.createDataFrame([("a b", ["a", "b"])], "t string, w array<string>")
    assert df.select(C.clean_column(df, "t", ["shout"])).first()[0] == "A B"
    assert df.select(C.clean_column(df, "w", ["shout"])).first()[0] == ["A", "B"]
    with pytest.raises(ValueError):
        C.cleaner("nothing")
    with pytest.raises(TypeError):
        C.clean_column(spark.range(1), "id", ["lowercase"])


def test_words_are_those_between_blanks(string_frame, strings):
    every = "".join(chr(c) for c in range(0x3002) if c < 0xD800)
    assert column_values(string_frame, C.words_of(F.col("t"))) == [t.split() for t in strings]
    row = string_frame.sparkSession.createDataFrame([(every,), (None,)], "t string").select(C.words_of(F.col("t")).alias("w")).collect()
    assert [r.w for r in row] == [every.split(), None]
