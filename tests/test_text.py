import random

import regex
from pyspark.sql import functions as F

from corpusgrove.catalog import stub
from corpusgrove.functions import grammar as G, text as X
from corpusgrove.operators import responses as L
from tests import naive

EDGE = [
    "[1] Trade: Mentions trade", "[1] Éducation: écoles", "[1] A B: no-break", "[1] R&D: x", "[1] Women's Rights: x",
    "[1] A, B: x", "[1] A/B: x", "[1] C++ Code: x", "[1] C#: x", "  [1] Lead: x", "[1] Empty:", "[1] Empty: ", "[2] Low: x",
    "None", "Error", "", "[1] Trade (Count: 3): x", "[1] Trade (Count: 3):", "[1] Trade (Count: 3) : x",
    "[1] A (Count: 1): b (Count: 9): c", "[x] A: b", "[1]A: b", "[1] A (Document: 1, 3): text", "[2] B (Documents: 2): more, text",
    "[2] C (Document: 1): has (brackets)", "[2] D (Document: 4)", "[1] E", "[2] F & G's (Document: 1-3): x. y",
    "[1] Merged: All of it ([1] A, [1] B)", "[1] Merged: text. (none)", "[1] M (Count: 2): d ([1] A's, [2] B_c)",
    "[1] X: y: z (quote)", "[1] First: reason\n[1] Second: reason", "x [1] Mid: reason", "[1] Spans\nlines: r", "[12] Twelve: x",
    "[١] Arabic digit: x", "[1] tab\tname: x", "[1] A-B_c: x",
]


def groups(pattern, text, flags=0):
    m = regex.search(pattern, text, flags) if not pattern.startswith("^") else regex.match(pattern, text, flags)
    return None if m is None else tuple(g or "" for g in m.groups())


def test_line_patterns_agree_with_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE)], "i int, t string").orderBy("i")
    patterns = [G.TOPIC_FILE_LINE, G.SEED_FILE_LINE, G.LEVEL1_LINE, G.DOC_TOPIC_LINE, G.SUBTOPIC_LINE, G.MERGE_LINE, G.FIRST_TOPIC]
    for pattern in patterns:
        n = regex.compile(pattern).groups
        got = df.select(X.matches(F.col("t"), pattern).alias("m"), *[X.group(F.col("t"), pattern, k + 1).alias(f"g{k}") for k in range(n)])
        for text, row in zip(EDGE, got.collect()):
            want = groups(pattern, text)
            assert row.m == (want is not None), (pattern, text)
            if want is not None:
                assert tuple(row[1:]) == want, (pattern, text)


def test_assigned_topics_and_originals(spark):
    df = spark.createDataFrame([(t,) for t in EDGE], "t string")
    got = df.select("t", X.assigned_topics(F.col("t")).alias("a"), X.merge_originals(F.col("t")).alias("o")).collect()
    for row in got:
        want = [t.strip() for t in regex.findall(G.ASSIGNED_TOPIC, row.t, regex.MULTILINE)]
        assert row.a == want, row.t
        pairs = regex.findall(G.MERGE_ORIGINAL, row.t)
        assert [o.name for o in row.o] == [name.strip(", ") for _, name in pairs], row.t


def test_tokens_match_naive_counter(spark):
    rng = random.Random(3)
    alphabet = ["word", "été", "a_b", "12", ".", ",", " ", "  ", "\n", " ", "中文", "(", "-", "\t"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(120)] + ["", " ", "\n"]
    rows = [(i, t, rng.randint(-2, 12)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string, n int")
    got = df.select("i", X.count_tokens(F.col("t")).alias("c"), X.truncate_tokens(F.col("t"), F.col("n")).alias("cut")).collect()
    for r in got:
        _, t, n = rows[r.i]
        assert r.c == naive.count(t), repr(t)
        assert r.cut == naive.truncate(t, n), (repr(t), n)


def test_long_text_does_not_overflow_the_matcher(spark):
    text = "word, " * 60000
    row = spark.createDataFrame([(text,)], "t string").select(
        X.count_tokens(F.col("t")).alias("c"), F.length(X.truncate_tokens(F.col("t"), 100001)).alias("n")
    ).first()
    assert row.c == 120000 and row.n == 6 * 50000 + 4


def test_template_is_filled_once(spark):
    row = spark.createDataFrame([("{tree}", "T{Document}")], "d string, t string").select(
        X.fill_template("a{{x}} {Document}|{tree}", Document=F.col("d"), tree=F.col("t")).alias("p")
    ).first()
    assert row.p == "a{x} {tree}|T{Document}"


def test_labels(spark):
    df = spark.createDataFrame([(2, "Tax", 7, "Levies")], "lvl int, name string, count long, desc string")
    row = df.select(X.label_of().alias("a"), X.label_of(desc=True).alias("b"), X.label_of(count=True).alias("c"), X.label_of(True, True).alias("d")).first()
    assert list(row) == ["[2] Tax", "[2] Tax: Levies", "[2] Tax (Count: 7)", "[2] Tax (Count: 7): Levies"]


def test_subtopic_lines(spark):
    text = "[1] Trade\n   [2] Exports (Document: 1, 3): Policies on goods.\n [2] Tariff (Documents: 2): Taxes: yes\n[2] Bad (x): y"
    df = spark.createDataFrame([(0, text)], "p int, r string")
    rows = L.parse_subtopic_lines(df, "r", ["p"]).orderBy("line_idx").collect()
    assert [(r.lvl, r.name, r.documents, r.desc, r.adds) for r in rows] == [
        (1, "Trade", [], "", False),
        (2, "Exports", [1, 3], "Policies on goods.", True),
        (2, "Tariff", [2], "Taxes: yes", True),
    ]


def test_capital_names_stay_the_word_in_any_case(spark):
    words = ["ßausch", "haus", "éclair", "ﬁnden", "ŉabcdef"]
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "k int, w string")
    got = rows.select("w", stub.capital(F.col("w")).alias("c")).withColumn("back", F.lower("c")).orderBy("k").collect()
    assert [r["c"] for r in got] == ["ẞausch", "Haus", "Éclair", "ﬁnden", "ŉabcdef"] == [stub.capital_word(w) for w in words]
    assert all(r["back"] == r["w"] for r in got)


def test_capital_of_letters_whose_upper_case_is_two_letters(spark):
    words = ["ᾳbcdef", "ᾀbcdef", "ᾲbcdef"]
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "k int, w string")
    got = rows.select("w", stub.capital(F.col("w")).alias("c")).withColumn("back", F.lower("c")).orderBy("k").collect()
    assert [r["c"] for r in got] == ["ᾼbcdef", "ᾈbcdef", "ᾲbcdef"] == [stub.capital_word(w) for w in words]
    assert all(r["back"] == r["w"] for r in got)


def test_a_dotted_capital_i_does_not_end_a_word(spark):
    rows = spark.createDataFrame([("İstanbul und İstanbul",), ("DİYARBAKIR",)], "text string")
    assert [r[0] for r in rows.select(stub.top_words(F.col("text"))).collect()] == [["istanbul"], ["diyarbakir"]]
