import csv

import pytest
from pyspark.sql import functions as F

import corpusmill.plans.recipes  # noqa: F401
from corpusmill.functions import cleaners as C
from corpusmill.operators.postprocess import pad_batch, post_bert, post_roberta
from corpusmill.plans.corpus import map_text, parse_spec, run_spec, spell_correct, write_corpus
from corpusmill.plans.tokenizer import TokenizerSpec, decode_tokens, encode_texts, token_offsets, train_tokenizer
from corpusmill.sources.files import load_bigrams, load_dictionary, read_version, scan_csv, write_csv, write_version
from corpusmill.sources.registry import register_source
from corpusmill.sources.sinks import load_vocab
from corpusmill.streaming import clean as stream
from corpusmill.streaming.clean import run_clean_stream

FLAGS = ["toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate"]


@pytest.fixture()
def raw_files(tmp_path):
    """The three kinds of files, with quoted line breaks, separators and quotes."""

    def write(name, header, rows, sep=","):
        with open(tmp_path / name, "w", newline="") as f:
            csv.writer(f, delimiter=sep).writerows([header, *rows])
        return str(tmp_path / name)

    text = 'Some "quoted" text,\nnumber {} on\ttwo lines'.format
    posts = [(text(i), i % 2, 0, "" if i % 5 == 0 else 0) for i in range(200)]
    comments = [(f"c{i}", text(i), *[int(i % 7 == f) for f in range(6)]) for i in range(300)]
    labels = [(f"t{i}", *([-1] * 6 if i % 3 == 0 else [int(i % 4 == 0)] + [0] * 5)) for i in range(300)]
    return {
        "posts": {
            "source": "posts",
            "train_path": write("train.tsv", ["text", "hd", "cv", "vo"], posts, "\t"),
            "test_path": write("test.tsv", ["text", "hd", "cv", "vo"], posts[:50], "\t"),
        },
        "comments": {
            "source": "comments",
            "train_path": write("train.csv", ["id", "comment_text", *FLAGS], comments),
            "test_path": write("test.csv", ["id", "comment_text"], [(f"t{i}", text(i)) for i in range(300)]),
            "test_labels_path": write("labels.csv", ["id", *FLAGS], labels),
        },
        "tweets": {
            "source": "tweets",
            "path": write("tweets.csv", ["tweet_text", "cyberbullying_type"],
                          [(text(i), "not_cyberbullying" if i % 3 else "age") for i in range(400)]),
        },
    }


def test_corpus_from_files(spark, raw_files, tmp_path):
    spec = {"sources": raw_files, "cleaners": ["lowercase", "strip_punctuation", ["limit_chars", {"limit": 40}]], "min_words": 2}
    corpus = run_spec(spark, spec)
    assert corpus.columns == ["text", "label", "split", "dataset_name", "cleaned_text"]
    rows = corpus.collect()
    sizes = {}
    for r in rows:
        sizes[r.dataset_name, r.split] = sizes.get((r.dataset_name, r.split), 0) + 1
    assert sizes["posts", "test"] == 50 and sizes["posts", "train"] + sizes["posts", "dev"] == 200
    assert 30 < sizes["posts", "dev"] < 90
    # 200 of the 300 test comments are labelled; about a tenth of them stays.
    assert sum(n for (d, _), n in sizes.items() if d == "comments") == 500 and 5 < sizes["comments", "test"] < 40
    assert sum(n for (d, _), n in sizes.items() if d == "tweets") == 400
    assert all("\n" in r.text and "\n" not in r.cleaned_text for r in rows)
    first = next(r for r in rows if "number 7 on" in r.text)
    assert first.cleaned_text == "some quoted text number 7 on two lines"

    manifest = write_corpus(corpus, str(tmp_path / "out"), image="i", version="v5").first()
    assert manifest.n_rows == len(rows) and manifest.n_train + manifest.n_dev + manifest.n_test == len(rows)
    read = spark.read.parquet(str(tmp_path / "out" / "splits"))
    assert sorted(read.select(*corpus.columns).collect()) == sorted(rows)


def test_each_source_is_read_once(spark, raw_files):
    plan = run_spec(spark, {"sources": {k: raw_files[k] for k in ("tweets",)}, "cleaners": ["lowercase"]})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1, text
    assert "Python" not in text and "Exchange" not in text


def test_spec_is_checked(raw_files):
    with pytest.raises(ValueError, match="unknown keys"):
        parse_spec({"sources": raw_files, "clean": []})
    with pytest.raises(ValueError, match="takes no"):
        parse_spec({"sources": {"t": {"source": "tweets", "path": "x", "ratio": 1}}})
    with pytest.raises(ValueError, match="unknown source"):
        parse_spec({"sources": {"t": {"source": "radio"}}})
    with pytest.raises(ValueError, match="unknown cleaner"):
        parse_spec({"sources": raw_files, "cleaners": ["polish"]})
    with pytest.raises(ValueError, match="at least one source"):
        parse_spec({"sources": {}})


def test_spelling_is_a_step_of_a_declared_chain(spark, tmp_path):
    (tmp_path / "words.txt").write_text("hello 50\nworld 40\n")
    (tmp_path / "pairs.txt").write_text("hello world 9\n")
    register_source("greetings", lambda session: session.createDataFrame([("@bob HELO wrld", 1, "train"), (None, 0, "dev")], "text string, label int, split string"))
    step = ["spell_correct", {"dictionary": str(tmp_path / "words.txt"), "bigrams": str(tmp_path / "pairs.txt")}]
    spec = {"sources": {"g": {"source": "greetings"}}, "cleaners": ["strip_mentions", "lowercase", step, ["limit_chars", {"limit": 8}]]}
    assert [r.cleaned_text for r in run_spec(spark, spec).collect()] == ["hello wo"]
    with pytest.raises(ValueError, match="needs a dictionary"):
        parse_spec({**spec, "cleaners": [["spell_correct", {}]]})


def test_custom_source_of_three_frames(spark):
    def three(session, n):
        return tuple(session.createDataFrame([(f"text {i} {s}", 1) for i in range(n)], "text string, label int") for s in "abc")

    register_source("three", three)
    got = run_spec(spark, {"sources": {"mine": {"source": "three", "n": 2}}, "cleaners": ["lowercase"]})
    assert sorted((r.split, r.text) for r in got.collect()) == sorted(
        (s, f"text {i} {c}") for c, s in zip("abc", ("train", "dev", "test")) for i in range(2)
    )


def test_csv_round_trip_of_odd_texts(spark, strings, tmp_path):
    rows = [(i, t) for i, t in enumerate([*strings, None])]
    df = spark.createDataFrame(rows, "i int, t string")
    for sep in (",", "\t"):
        path = str(tmp_path / ("c" if sep == "," else "t"))
        write_csv(df, path, sep)
        back = {r.i: r.t for r in scan_csv(spark, path, df.schema, sep).collect()}
        assert back == {i: t or None for i, t in rows}


def test_versions_and_dictionaries(spark, tmp_path):
    base = str(tmp_path / "data")
    for v in ("v3", "v5"):
        write_version(spark.createDataFrame([(v,)], "t string"), base, v)
    assert [r.t for r in read_version(spark, base, "v5").collect()] == ["v5"]
    write_version(spark.createDataFrame([("a", 1), ("b", 2)], "t string, label int"), base, "1")
    write_version(spark.createDataFrame([("c", 3)], "t string, label int"), base, "01")
    assert read_version(spark, base, "1").columns == ["t", "label"] and read_version(spark, base, "1").count() == 2
    (tmp_path / "words.txt").write_text("the 23\ncat 2\nrare 1\nthe 2\n\n")
    (tmp_path / "pairs.txt").write_text("the cat 9\na dog 4\n")
    words = load_dictionary(spark, str(tmp_path / "words.txt"), count_threshold=2)
    assert {tuple(r) for r in words.collect()} == {("the", 25), ("cat", 2)}
    pairs = load_bigrams(spark, str(tmp_path / "pairs.txt"))
    assert {tuple(r) for r in pairs.collect()} == {("the", "cat", 9), ("a", "dog", 4)}


def test_other_separators_are_taken_literally(spark, tmp_path):
    (tmp_path / "words.txt").write_text("foo|7\nbar|x\n")
    (tmp_path / "pairs.txt").write_text("a.b.3\n")
    assert [tuple(r) for r in load_dictionary(spark, str(tmp_path / "words.txt"), separator="|").collect()] == [("foo", 7)]
    assert [tuple(r) for r in load_bigrams(spark, str(tmp_path / "pairs.txt"), separator=".").collect()] == [("a", "b", 3)]


def test_single_line_files_are_split(spark, tmp_path):
    rows = spark.range(20_000).select("id", F.concat(F.lit("text "), "id").alias("t"))
    write_csv(rows.coalesce(1), str(tmp_path / "c"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        read = scan_csv(spark, str(tmp_path / "c"), rows.schema, multi_line=False)
        assert read.rdd.getNumPartitions() > 1 and sorted(read.collect()) == sorted(rows.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_split_of_another_name_fails_when_read(spark):
    register_source("odd_split", lambda session: session.createDataFrame([("t", 1, "eval")], "text string, label int, split string"))
    with pytest.raises(Exception, match="invalid split name"):
        run_spec(spark, {"sources": {"odd": {"source": "odd_split"}}, "cleaners": ["lowercase"], "min_words": 1}).collect()


def test_each_table_is_scanned_once_per_source(spark):
    from corpusmill.catalog.corpora import comments, posts

    for made in (posts(spark, folder="/root/testdata/sf0.001"), comments(spark, folder="/root/testdata/sf0.001")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2, plan


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("in", "out", "state")]
    spec = ["lowercase", "strip_mentions"]
    df = spark.createDataFrame([(i, f"Hello @user{i} THERE") for i in range(50)], "i int, text string")
    df.repartition(3).write.parquet(paths[0])
    run_clean_stream(spark, paths[0], df.schema, paths[1], paths[2], spec)
    more = df.withColumn("i", F.col("i") + 50)
    more.write.mode("append").parquet(paths[0])
    run_clean_stream(spark, paths[0], df.schema, paths[1], paths[2], spec)
    batch = df.union(more).select("i", C.clean_text(F.col("text"), spec).alias("cleaned_text"))
    assert sorted(spark.read.parquet(paths[1]).select("i", "cleaned_text").collect()) == sorted(batch.collect())


def test_stream_with_spelling_equals_batch_across_a_restart(spark, tmp_path, monkeypatch):
    """A batch that fails when all but its commit is done runs again and changes nothing; later batches use its answers."""
    terms = [("hello", 900), ("world", 800), ("where", 700), ("are", 650), ("you", 600)]
    dictionary = spark.createDataFrame(terms, "term string, cnt bigint")
    bigrams = spark.createDataFrame([("hello", "world", 50), ("where", "are", 40)], "left string, right string, cnt bigint")
    spec = ["lowercase", ("spell_correct", {"dictionary": dictionary, "bigrams": bigrams}), "strip_punctuation"]
    schema = "i int, text string"
    first = spark.createDataFrame([(1, "Helo WRLD!"), (2, "whereare yuo"), (3, None), (4, ""), (5, "qqqqqqqq helo")], schema)
    second = spark.createDataFrame([(6, "helo wrld"), (7, "wher are yoo"), (8, "helo wrld")], schema)
    paths = [str(tmp_path / p) for p in ("in", "out", "state")]
    first.coalesce(1).write.parquet(paths[0])
    real, calls = stream.clean_texts, []

    def failing(batch, chain):
        done = real(batch, chain)
        calls.append(done.count())
        if len(calls) == 1:
            done.write.mode("overwrite").parquet(f"{paths[1]}/batch=0")
            raise OSError("lost")
        return done

    monkeypatch.setattr(stream, "clean_texts", failing)
    with pytest.raises(Exception, match="lost"):
        run_clean_stream(spark, paths[0], first.schema, paths[1], paths[2], spec)
    run_clean_stream(spark, paths[0], first.schema, paths[1], paths[2], spec)
    second.coalesce(1).write.mode("append").parquet(paths[0])
    run_clean_stream(spark, paths[0], first.schema, paths[1], paths[2], spec)
    run_clean_stream(spark, paths[0], first.schema, paths[1], paths[2], spec)
    assert calls == [5, 5, 3]
    wanted = {r.i: r.cleaned_text for r in real(first.union(second), spec).collect()}
    rows = spark.read.parquet(paths[1]).collect()
    assert len(rows) == 8 and {r.i: r.cleaned_text for r in rows} == wanted
    assert wanted[1] == wanted[6] == "hello world" and wanted[3] is None and wanted[4] == ""
    kept = spark.read.option("basePath", f"{paths[2]}-answers").parquet(f"{paths[2]}-answers/step=1").collect()
    asked = {b: {r.token for r in kept if r.batch == b} for b in (0, 1)}
    assert {"helo", "qqqqqqqq"} <= asked[0] and not asked[0] & asked[1] and "yoo" in asked[1]


def test_map_text(spark):
    df = spark.createDataFrame([("aB",), (None,)], "text string").coalesce(1)
    assert [r[1] for r in map_text(df, F.lower).collect()] == ["ab", None]
    assert [r[1] for r in map_text(df, lambda t: t[::-1], python=True).collect()] == ["Ba", None]


def test_spelling_of_equal_texts_and_word_lists(spark):
    dictionary = spark.createDataFrame([("hello", 900), ("world", 800)], "term string, cnt bigint")
    bigrams = spark.createDataFrame([("hello", "world", 50)], "left string, right string, cnt bigint")
    df = spark.createDataFrame([(1, "helo wrld"), (2, "helo wrld"), (3, None), (4, "helloworld")], "i int, t string")
    got = {r.i: r.t for r in spell_correct(df, "t", dictionary, bigrams).collect()}
    assert got == {1: "hello world", 2: "hello world", 3: None, 4: "hello world"}
    lists = df.select("i", F.split("t", " ").alias("t"))
    assert {r.i: r.t for r in spell_correct(lists, "t", dictionary, bigrams).collect()}[4] == ["hello", "world"]


def test_tokenizer_round_trip(spark, tmp_path):
    tk = pytest.importorskip("tokenizers")
    texts = ["the cat sat", "the cat ran", "a dog sat", "the hat", "aaa aaaa"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    spec = TokenizerSpec("bpe", {"vocab_size": 40}, post_processor="bert", decoder=("bpe", {}))
    train_tokenizer(df, "t", spec, str(tmp_path / "v"))
    v = load_vocab(spark, str(tmp_path / "v"))
    assert v.kind == "bpe" and v.params["unk_token"] == "[UNK]"
    got = {r.i: (r.ids, r.type_ids) for r in encode_texts(df, "t", spec, v).collect()}
    t = tk.Tokenizer(tk.models.BPE(unk_token="[UNK]"))
    t.pre_tokenizer = tk.pre_tokenizers.Whitespace()
    t.train_from_iterator(texts, tk.trainers.BpeTrainer(
        vocab_size=40, special_tokens=["[UNK]", "[CLS]", "[SEP]", "[PAD]", "[MASK]"], show_progress=False))
    t.post_processor = tk.processors.BertProcessing(("[SEP]", 2), ("[CLS]", 1))
    for i, text in enumerate(texts):
        assert got[i] == (t.encode(text).ids, t.encode(text).type_ids)
    tokens = spark.createDataFrame([(["a</w>", "b"],)], "t array<string>")
    assert tokens.select(decode_tokens(F.col("t"), spec)).first()[0] == tk.decoders.BPEDecoder().decode(["a</w>", "b"])
    with pytest.raises(ValueError):
        TokenizerSpec("guess")


def test_sequence_pairs_equal_library(spark):
    tk = pytest.importorskip("tokenizers")
    t = tk.Tokenizer(tk.models.WordLevel({"[CLS]": 1, "[SEP]": 2, "the": 3, "cat": 4, "a": 5, "dog": 6}, "a"))
    t.pre_tokenizer = tk.pre_tokenizers.Whitespace()
    df = spark.createDataFrame([([3, 4], [5, 6])], "a array<int>, b array<int>")
    for ours, theirs in (
        (post_bert, tk.processors.BertProcessing(("[SEP]", 2), ("[CLS]", 1))),
        (post_roberta, tk.processors.RobertaProcessing(("[SEP]", 2), ("[CLS]", 1))),
    ):
        t.post_processor = theirs
        pair = df.select(*ours(F.col("a"), 2, 1, F.col("b"))).first()
        assert [pair[0], pair[1]] == [t.encode("the cat", "a dog").ids, t.encode("the cat", "a dog").type_ids]
        one = df.select(*ours(F.col("a"), 2, 1)).first()
        assert [one[0], one[1]] == [t.encode("the cat").ids, t.encode("the cat").type_ids]


def test_offsets_equal_library(spark, strings):
    tk = pytest.importorskip("tokenizers")
    texts = [s for s in strings if s.isascii()][:300] + ["  two  blanks ", " a b", "x  "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    pre = tk.pre_tokenizers.ByteLevel(add_prefix_space=False)
    vocab = {p: k for k, p in enumerate(sorted({p for t in texts for p, _ in pre.pre_tokenize_str(t)}))}
    t = tk.Tokenizer(tk.models.WordLevel(vocab, ""))
    t.pre_tokenizer = pre
    for prefix in (True, False):
        t.post_processor = tk.processors.ByteLevel(trim_offsets=True, add_prefix_space=prefix)
        got = {}
        spec = TokenizerSpec(post_processor="byte_level", post_params={"add_prefix_space": prefix})
        for r in token_offsets(df, "text", spec, ["i"]).orderBy("i", "position").collect():
            got.setdefault(r.i, []).append((r.start, r.end))
        for i, text in enumerate(texts):
            assert got.get(i, []) == t.encode(text).offsets, (prefix, text)


def test_names_of_special_tokens_and_padding_are_parameters(spark):
    special = ["<unk>", "<s>", "</s>", "<pad>"]
    df = spark.createDataFrame([(1, "a b"), (1, "a"), (2, "b")], "i int, t string")
    for padding, widths in (({"longest": True}, [4, 4, 4]), ({"batch": "i"}, [3, 4, 4]), ({"length": 6}, [6, 6, 6]), (None, [3, 3, 4])):
        spec = TokenizerSpec("word_level", {"vocab_size": 9, "special_tokens": special}, post_processor="roberta", padding=padding,
                             cls_token="<s>", sep_token="</s>", pad_token="<pad>")
        rows = encode_texts(df, "t", spec, train_tokenizer(df, "t", spec)).collect()
        assert sorted(len(r.ids) for r in rows) == widths and all(r.ids[0] == 1 and 2 in r.ids for r in rows)
        assert padding is None or all(sum(r.attention_mask) == len([x for x in r.ids if x != 3]) for r in rows)
    with pytest.raises(ValueError, match="padding"):
        TokenizerSpec(padding={"width": 3})
    with pytest.raises(ValueError, match="options"):
        TokenizerSpec(post_params={"trim": True})


def test_padding(spark):
    df = spark.createDataFrame([(1, [7]), (1, [7, 8, 9]), (2, [5]), (2, [])], "b int, ids array<int>").coalesce(1)
    assert [r.ids for r in pad_batch(df, "ids", 0).collect()] == [[7, 0, 0], [7, 8, 9], [5, 0, 0], [0, 0, 0]]
    by_batch = sorted((r.b, r.ids, r.attention_mask) for r in pad_batch(df, "ids", 0, batch="b").collect())
    assert by_batch == [(1, [7, 0, 0], [1, 0, 0]), (1, [7, 8, 9], [1, 1, 1]), (2, [0], [0]), (2, [5], [1])]
    assert [len(r.ids) for r in pad_batch(df, "ids", 0, length=2).collect()] == [2, 3, 2, 2]
