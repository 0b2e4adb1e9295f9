import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions.pretokenizers import pretok_whitespace
from corpusmill.operators import segment
from corpusmill.operators import vocab as V
from corpusmill.operators.words import SPECIAL_TOKENS, token_counts

MERGE_WORDS = ["the cat sat", "the cat ran", "a dog sat", "the hat", "aaa aaaa"]


def counts_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return token_counts(df, pretok_whitespace(F.col("t")))


def merges_of(v):
    return [(r.left, r.right) for r in v.merges.orderBy("rank").collect()]


def tokens_of(v):
    return [r.token for r in v.vocab.orderBy("id").collect()]


def library_bpe(texts, **kw):
    import json

    tk = pytest.importorskip("tokenizers")
    t = tk.Tokenizer(tk.models.BPE(unk_token="[UNK]"))
    t.pre_tokenizer = tk.pre_tokenizers.Whitespace()
    t.train_from_iterator(texts, tk.trainers.BpeTrainer(special_tokens=SPECIAL_TOKENS, show_progress=False, **kw))
    merges = json.loads(t.to_str())["model"]["merges"]
    vocab = t.get_vocab()
    return t, [tuple(m) for m in merges], sorted(vocab, key=vocab.get)


def test_word_level_order(spark):
    v = V.train_word_level(counts_of(spark, MERGE_WORDS))
    assert tokens_of(v) == SPECIAL_TOKENS + "the cat sat a aaa aaaa dog hat ran".split()
    assert tokens_of(V.train_word_level(counts_of(spark, MERGE_WORDS), vocab_size=7)) == SPECIAL_TOKENS + ["the", "cat"]
    assert tokens_of(V.train_word_level(counts_of(spark, MERGE_WORDS), min_frequency=2)) == SPECIAL_TOKENS + ["the", "cat", "sat"]


def test_bpe_first_merges(spark):
    v = V.train_bpe(counts_of(spark, MERGE_WORDS))
    assert merges_of(v)[:10] == [tuple(p.split(",")) for p in "a,a a,t h,e t,he c,at s,at a,n d,o h,at r,an".split()]


@pytest.mark.parametrize("seed", range(4))
def test_bpe_equals_library_on_random_corpora(spark, seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdeé你"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(12)) for _ in range(12)]
    _, merges, tokens = library_bpe(texts, vocab_size=60)
    v = V.train_bpe(counts_of(spark, texts), vocab_size=60)
    assert merges_of(v) == merges
    assert tokens_of(v) == tokens


def test_bpe_equals_library_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in df.collect()]
    _, merges, tokens = library_bpe(texts, vocab_size=260, min_frequency=3, limit_alphabet=60, initial_alphabet=["ß", "Ω"])
    v = V.train_bpe(
        token_counts(df, pretok_whitespace(F.col("text"))), vocab_size=260, min_frequency=3, limit_alphabet=60,
        initial_alphabet=["ß", "Ω"],
    )
    assert merges_of(v) == merges
    assert tokens_of(v) == tokens


def test_bpe_of_the_default_size_equals_library(spark):
    """Many merges in a round come in the order of one-by-one merging, also thousands at a time."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    _, merges, tokens = library_bpe([r.text for r in df.collect()], vocab_size=30_000)
    v = V.train_bpe(token_counts(df, pretok_whitespace(F.col("text"))))
    assert len(merges) > 20_000 and merges_of(v) == merges and tokens_of(v) == tokens


def library_vocabulary(spark, tokenizer, kind, **params):
    import json

    model = json.loads(tokenizer.to_str())["model"]
    if kind == "unigram":
        rows = [(i, t, None, s) for i, (t, s) in enumerate(model["vocab"])]
    else:
        rows = [(i, t, None, None) for t, i in model["vocab"].items()]
    merges = [(i, *m) for i, m in enumerate(model.get("merges", []))]
    return V.vocabulary(spark, kind, rows, merges, **params)


@pytest.fixture(scope="module")
def documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, ""), (-2, None), (-3, "x☃☃y 你好☃ " + "ab" * 90)], df.schema)
    return df.unionByName(odd).withColumn("tokens", pretok_whitespace(F.col("text"))).cache()


MODELS = {
    "bpe": ({"unk_token": "[UNK]"}, {"vocab_size": 300, "limit_alphabet": 40}),
    "bpe_affix": (
        {"unk_token": "[UNK]", "continuing_subword_prefix": "##", "end_of_word_suffix": "</w>"},
        {"vocab_size": 400, "continuing_subword_prefix": "##", "end_of_word_suffix": "</w>"},
    ),
    "bpe_fuse": ({"unk_token": "[UNK]", "fuse_unk": True}, {"vocab_size": 300, "limit_alphabet": 20}),
    "wordpiece": ({"unk_token": "[UNK]"}, {"vocab_size": 400, "limit_alphabet": 60}),
    "word_level": ({"unk_token": "[UNK]"}, {"vocab_size": 500}),
    "unigram": ({}, {"vocab_size": 400, "unk_token": "[UNK]"}),
}


@pytest.mark.parametrize("name", MODELS)
def test_encoding_equals_library(spark, documents, name):
    from corpusmill.operators.encode import encode, encode_by_join

    tk = pytest.importorskip("tokenizers")
    kind = name.split("_affix")[0].split("_fuse")[0]
    model, trainer = {
        "bpe": (tk.models.BPE, tk.trainers.BpeTrainer),
        "wordpiece": (tk.models.WordPiece, tk.trainers.WordPieceTrainer),
        "word_level": (tk.models.WordLevel, tk.trainers.WordLevelTrainer),
        "unigram": (tk.models.Unigram, tk.trainers.UnigramTrainer),
    }[kind]
    options, training = MODELS[name]
    t = tk.Tokenizer(model(**options))
    t.pre_tokenizer = tk.pre_tokenizers.Whitespace()
    texts = {r.doc_id: r.text for r in documents.collect()}
    seen = [x for i, x in texts.items() if i >= 0]
    t.train_from_iterator(seen, trainer(special_tokens=SPECIAL_TOKENS, show_progress=False, **training))
    params = {"unk_token": "[UNK]", **options}
    if kind == "wordpiece":
        params["continuing_subword_prefix"] = "##"
    v = library_vocabulary(spark, t, kind, **params)
    wanted = {i: None if x is None else t.encode(x).ids for i, x in texts.items()}
    for coded in (encode(documents, "tokens", v), encode_by_join(documents, "tokens", v, ["doc_id"])):
        got = {r.doc_id: r.ids for r in coded.collect()}
        wrong = [i for i in wanted if got[i] != wanted[i]]
        assert not wrong, (len(wrong), wrong[0], got[wrong[0]][:20], wanted[wrong[0]][:20])


def test_symbol_pairs_are_summed_in_tasks_and_words_cut_between_others(spark, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abc\u00e9\U0001f600\ue000") for _ in range(rng.randrange(2, 9))) for _ in range(500)]
    table = spark.createDataFrame([(w, rng.randrange(1, 2**52)) for w in dict.fromkeys(words)], "word string, cnt bigint").repartition(2)
    expected = {(r.pair, r.cnt) for r in V.pair_counts(table).collect()}
    monkeypatch.setattr(V, "PAIRS_HELD", 10)
    counted = V.symbol_pair_counts(table)
    assert {(r.pair, r.cnt) for r in counted.collect()} == expected
    assert "Generate" not in counted._jdf.queryExecution().toString()
    heavy = ["ab", "b\U0001f600", "cc"]
    cut = {(r.word, r.cnt) for r in V.cut_words(table, heavy).collect()}
    assert cut == {("".join(c if w[i:i + 2] in heavy else c + "\0" for i, c in enumerate(w)), n) for w, n in table.collect()}
    assert V.symbol_pair_counts(table.limit(0)).collect() == V.cut_words(table.limit(0), heavy).collect() == []


def test_wordpiece_learning(spark):
    counts = counts_of(spark, MERGE_WORDS)
    v = V.train_wordpiece(counts, vocab_size=40)
    tokens = tokens_of(v)
    assert tokens[:5] == SPECIAL_TOKENS and len(tokens) == len(set(tokens)) <= 40
    assert {"the", "##a", "##at", "t"} <= set(tokens)
    tk = pytest.importorskip("tokenizers")
    t = tk.Tokenizer(tk.models.WordPiece(unk_token="[UNK]"))
    t.pre_tokenizer = tk.pre_tokenizers.Whitespace()
    t.train_from_iterator(MERGE_WORDS, tk.trainers.WordPieceTrainer(special_tokens=SPECIAL_TOKENS, vocab_size=1000, show_progress=False))
    assert set(tokens_of(V.train_wordpiece(counts, vocab_size=1000))) == set(t.get_vocab())


WORDS = st.text("ab#é\U0001f600", max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab#é", min_size=1, max_size=5), max_size=25), st.lists(WORDS, max_size=8), st.sampled_from(["##", "a", ""]))
def test_one_pass_is_the_longest_match_again_and_again(texts, words, prefix):
    pieces = {t: (i, None) for i, t in enumerate(sorted(texts))}
    read = segment.reader("wordpiece", pieces, {}, unk_id=99, continuing_subword_prefix=prefix, max_input_chars_per_word=10)
    for w in words:
        assert read(w) == segment.word_pieces(w, pieces, {}, 99, longest=5, continuing_subword_prefix=prefix, max_input_chars_per_word=10)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("ab#é", min_size=1, max_size=5), st.sampled_from([-1.0, -2.5, -3.0, -4.0, -7.5]), max_size=25), st.lists(WORDS, max_size=8), st.sampled_from([None, 99]))
def test_one_pass_finds_the_most_probable_cut(scores, words, unk_id):
    pieces = {t: (i, s) for i, (t, s) in enumerate(sorted(scores.items()))}
    lowest = min(scores.values(), default=0.0)
    read = segment.reader("unigram", pieces, {}, unk_id=unk_id, lowest=lowest)
    for w in words:
        assert read(w) == segment.most_probable(w, pieces, {}, unk_id, longest=5, lowest=lowest)


def test_long_words_are_read_in_linear_time():
    pieces = {t: (i, -1.0) for i, t in enumerate(["a", "##a", "##" + "a" * 400 + "b", "a" * 300])}
    read = segment.reader("wordpiece", pieces, {}, unk_id=None, max_input_chars_per_word=10**6)
    began = time.time()
    assert len(read("a" * 100_000)) == 1 + 100_000 - 300
    plain = {f"{'a' * n}": (n, -float(n)) for n in (1, 2, 300)}
    assert segment.reader("unigram", plain, {}, unk_id=None)("a" * 100_000)
    assert time.time() - began < 20


def test_dropout(spark):
    """0 is the plain encoding, 1 leaves single characters, between them fewer merges the higher it is; reruns and partitions agree."""
    from corpusmill.operators.encode import encode, encode_with_dropout

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).select("doc_id", pretok_whitespace(F.col("text")).alias("tokens"))
    odd = spark.createDataFrame([(-1, []), (-2, None), (None, ["the", "☃"])], docs.schema)
    docs = docs.unionByName(odd)
    v = V.train_bpe(token_counts(docs, F.col("tokens")), vocab_size=300)
    ids = lambda df: {r.doc_id: r.ids for r in df.select("doc_id", "ids").collect()}
    plain = ids(encode(docs, "tokens", v))
    found = {p: ids(encode_with_dropout(docs, "tokens", v, ["doc_id"], p)) for p in (0.0, 0.1, 0.5, 1.0)}
    assert found[0.0] == plain and plain[-2] is None
    assert found[0.1] == ids(encode_with_dropout(docs.repartition(7, "tokens"), "tokens", v, ["doc_id"], 0.1)) != ids(encode_with_dropout(docs, "tokens", v, ["doc_id"], 0.1, seed=1))
    size = {p: sum(len(i or []) for i in x.values()) for p, x in found.items()}
    characters = docs.select(F.sum(F.length(F.array_join("tokens", "")))).first()[0]
    assert size[0.0] < size[0.1] < size[0.5] < size[1.0] == characters
    with pytest.raises(ValueError):
        encode_with_dropout(docs, "tokens", v, ["doc_id"], 1.5)


def test_draws_pass_over_the_right_share():
    numbers = [x for key in range(50) for _, x in zip(range(200), segment.draws_of(3, str(key), key))]
    assert abs(sum(x < 0.1 for x in numbers) / len(numbers) - 0.1) < 0.01 and len(set(numbers)) == len(numbers)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
@pytest.mark.parametrize("unk", [None, "[UNK]"])
def test_dropout_by_masks_is_dropout_word_by_word(spark, dropout, unk):
    """Each row beside one word at a time with its own draws, short words, unknown characters and words of many draws among them;
    words with the same first draws are cut up once."""
    from corpusmill.operators import encode as E

    texts = [(1, ["abab", "ab", "a", "", "☃", "a☃b", "abababababababababab"]), (2, []), (3, None), (None, ["ab"] * 300 + ["bab"]), (5, ["abab"] * 700)]
    docs = spark.createDataFrame(texts, "doc_id long, tokens array<string>").coalesce(1)
    rows = [(0, "[UNK]"), *enumerate(["a", "b", "ab", "ba", "abab", "bab"], 1)]
    merges = [(0, "a", "b"), (1, "ab", "ab"), (2, "b", "a"), (3, "b", "ab")]
    v = V.vocabulary(spark, "bpe", [(i, t, None, None) for i, t in rows], merges, unk_token=unk)
    found = {r.doc_id: r.ids for r in E.encode_with_dropout(docs, "tokens", v, ["doc_id"], dropout).collect()}
    pieces, ranks, unk_id = {t: (i, None) for i, t in rows}, {(a, b): n for n, a, b in merges}, 0 if unk else None
    for key, words in texts:
        name = "{}" if key is None else f'{{"doc_id":{key}}}'
        wanted = None if words is None else [
            i for place, word in enumerate(words)
            for i in segment.byte_pairs(word, pieces, ranks, unk_id, dropout=dropout, draws=segment.draws_of(0, name, place))
        ]
        assert found[key] == wanted


def test_dropout_cuts_a_word_once_for_the_same_draws():
    from corpusmill.operators import encode as E

    masks = E._draw_masks(0, "{}", list(range(2000)), 0.1)
    for place in (0, 7, 1999):
        bits = [x < 0.1 for _, x in zip(range(E.DRAWS_AT_ONCE), segment.draws_of(0, "{}", place))]
        assert [bool(masks[place] >> (E.DRAWS_AT_ONCE - 1 - i) & 1) for i in range(E.DRAWS_AT_ONCE)] == bits
    assert len(set(masks.tolist())) < 100


def test_whole_words_are_joined_without_their_substrings(spark, monkeypatch):
    """A word-level vocabulary is asked for whole words only, so a long word is one row of the join; ids are those of `encode`."""
    from corpusmill.operators import encode as E

    texts = [(1, ["ab", "a", "", "zz", "ab"]), (2, []), (3, None), (4, ["a" * 3000, "b" * 30])]
    docs = spark.createDataFrame(texts, "doc_id long, tokens array<string>")
    rows = [(i, t, 1, None) for i, t in enumerate(["[UNK]", "a", "ab", "a" * 40, "b" * 30])]
    v = V.vocabulary(spark, "word_level", rows, unk_token="[UNK]")
    written = {}

    def recorded(df, purpose, **more):
        written[purpose] = [tuple(r) for r in df.select("key", "_weight").collect()] if purpose == "pieces" else None
        return materialize(df, purpose, **more)

    materialize = E.materialize
    monkeypatch.setattr(E, "materialize", recorded)
    found = {r.doc_id: r.ids for r in E.encode_by_join(docs, "tokens", v, ["doc_id"]).collect()}
    assert found == {r.doc_id: r.ids for r in E.encode(docs, "tokens", v).collect()} == {1: [2, 1, 0, 0, 2], 2: [], 3: None, 4: [0, 4]}
    assert sorted(written["pieces"]) == [("a", 1), ("ab", 1), ("b" * 30, 1)]
