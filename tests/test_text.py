from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from lexiflow.functions.stopwords import ENGLISH_STOP_WORDS
from lexiflow.functions.text import clean_text
from lexiflow.operators.features import ngrams, stop_words_remover, tokenizer
from lexiflow.operators.lemma import lemmatize
from lexiflow.sources.text import parse_labeled_lines, read_labeled_text


def test_stop_words_equal_spark_list(spark):
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
    assert len(ENGLISH_STOP_WORDS) == 181


def test_clean_edge_row(spark):
    df = spark.createDataFrame([("I'm <b>so</b> happy, it is a joy\nnot sad at 7pm",)], "text string")
    out = df.select(clean_text("text").alias("c")).first()["c"]
    assert out == "  happy    joynot sad  "


def test_tokenizer_java_split_semantics(spark):
    df = spark.createDataFrame([("  A  bb ",), ("",), ("   ",), ("x\ty\n",)], "t string")
    got = [r["w"] for r in tokenizer("t", "w").transform(df).collect()]
    assert got == [["", "", "a", "", "bb"], [""], [], ["x", "y"]]
    dropped = [r["w"] for r in tokenizer("t", "w", drop_empty=True).transform(df).collect()]
    assert dropped[0] == ["a", "bb"]


def test_stop_words_case_insensitive_and_empty_kept(spark):
    df = spark.createDataFrame([(["The", "", "cat", "IS", "here's"],)], "w array<string>")
    got = stop_words_remover("w", "f").transform(df).first()["f"]
    assert got == ["", "cat"]


def test_bigrams(spark):
    df = spark.createDataFrame([(["b", "a", "c", "a"],), (["d", "b", "e"],), (["c"],)], "w array<string>")
    got = [r["g"] for r in ngrams("w", "g", 2).transform(df).collect()]
    assert got == [["b a", "a c", "c a"], ["d b", "b e"], []]


def test_parse_lines_policies(spark):
    lines = spark.createDataFrame([("i feel ok;joy",), ("i am sad, really;sadness",), ('"quoted text";anger',),
                                   ("",), ("no label here",), ("bad;x;y",)], "value string")
    keep = [tuple(r) for r in parse_labeled_lines(lines).collect()]
    assert keep == [("i feel ok", "joy"), ("i am sad, really", "sadness"), ('"quoted text"', "anger"),
                    ("", None), ("no label here", None), ("bad", "x")]
    drop = parse_labeled_lines(lines, malformed="drop").collect()
    assert len(drop) == 4
    import pytest
    with pytest.raises(Exception):
        parse_labeled_lines(lines, malformed="fail").collect()


def test_read_labeled_text(spark, tmp_path):
    p = tmp_path / "train.txt"
    p.write_text("i feel ok;joy\ni am sad, really;sadness\n")
    rows = [tuple(r) for r in read_labeled_text(spark, str(p)).collect()]
    assert rows == [("i feel ok", "joy"), ("i am sad, really", "sadness")]


def test_lemmatize_odd_rows(spark):
    rows = [(1, "running  dogs ran"), (2, ""), (3, None), (4, "walking walking"), (None, "run geese"),
            (5, "dogs home"), (5, "a running"), (5, "a running"), (6, "dogs " * 3000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text_c string, form string")
    lem = spark.createDataFrame([("running", "run"), ("walking", "walk"), ("dogs", "dog"), ("dogs", "doggy"),
                                 ("geese", "goose"), (None, "nothing"), ("home", None), ("ran", "ran")],
                                "form string, lemma string")
    table = {"running": "run", "walking": "walk", "dogs": "dog", "geese": "goose"}
    expected = [(i, None if t is None else " ".join(table.get(w, w) for w in t.split(" "))) for i, t in rows]
    out = lemmatize(docs, lem, "text_c", "l")
    assert out.columns == ["doc_id", "text_c", "form", "l"]
    key = lambda r: (r[0] is None, str(r))
    assert sorted((tuple(r) for r in out.select("doc_id", "l").collect()), key=key) == sorted(expected, key=key)
    assert sorted(str(r[0]) for r in lemmatize(docs, lem.limit(0), "text_c").select("text_c").collect()) == \
        sorted(str(t) for _, t in rows)
    assert lemmatize(docs.limit(0), lem, "text_c").count() == 0


def test_lemmatize_has_one_plan(spark):
    import re
    docs = spark.createDataFrame([(1, "w1 w2 x")], "doc_id long, text_c string")
    shapes = []
    for n in (2, 1_000_000):
        lem = spark.range(n).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("form"),
                                    F.lit("w").alias("lemma"))
        plan = lemmatize(docs, lem, "text_c")._jdf.queryExecution().sparkPlan().toString()
        shapes.append(re.findall(r"\w+(?:Join|Aggregate|Generate)\b", plan))
    assert shapes[0] == shapes[1] and "BroadcastHashJoin" not in shapes[0]


def test_lemmatize_hot_forms_and_random_rows(spark):
    """A form in every row, forms that fill a row, and tokens beside them, against a dictionary."""
    import random
    r = random.Random(4)
    table = {f"f{i}": f"l{i % 7}" for i in range(400)} | {"hot": "cold"}
    rows = [" ".join(["hot"] + [r.choice(["", "x", f"f{r.randrange(600)}", "hot"]) for _ in range(r.randrange(60))])
            for _ in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").repartition(6)
    lem = spark.createDataFrame(list(table.items()), "form string, lemma string")
    got = {x.i: x.t for x in lemmatize(docs, lem, "t").collect()}
    assert got == {i: " ".join(table.get(w, w) for w in t.split(" ")) for i, t in enumerate(rows)}


def test_lemmatize_is_linear_in_a_row(spark):
    """Rows of 1k, 10k and 100k different tokens, all matched: time may grow with the row, not with its square."""
    import time
    seconds = {}
    for n in (1_000, 10_000, 100_000):
        text = " ".join(f"w{i}" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "i int, t string")
        lem = spark.range(n).select(F.format_string("w%d", "id").alias("form"), F.format_string("v%d", "id").alias("lemma"))
        start = time.perf_counter()
        (out,) = lemmatize(docs, lem, "t").collect()
        seconds[n] = time.perf_counter() - start
        assert out.t == text.replace("w", "v")
    assert seconds[100_000] < 5 * seconds[10_000] + 10, seconds


def test_lemma_rules(spark):
    from lexiflow.operators.lemma import rule_table
    words = "walks running glasses parties string was class bus thing jumped ed ing is"
    df = spark.createDataFrame([(words,)], "text_c string")
    got = {r["form"]: r["lemma"] for r in rule_table(df, "text_c").collect()}
    assert got == {"walks": "walk", "running": "runn", "glasses": "glass", "parties": "party", "was": "be",
                   "jumped": "jump"}


def test_clean_matches_plain_regex(spark):
    import re
    texts = ["Hello <i>World</i>!! it's 2023", "àé ok go", "a\nbb ccc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(clean_text("t")).collect()]
    exp = []
    for t in texts:
        t = re.sub(r"<[^>]+>", "", t)
        t = re.sub(r"[^a-zA-Z ]", "", t)
        exp.append(re.sub(r"\b\w{1,2}\b", "", t, flags=re.ASCII))
    assert got == exp
    assert df.select(F.lit(1)).count() == 3
