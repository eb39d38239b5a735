"""The completers that stand in for a model find the same words as the column rule."""

from pyspark.sql import functions as F

from corpusgrove.catalog import stub

TEXTS = ["Quadratm² Quadratm² fläche", "abcdefⅧghijkl", "½abcdefg ①②③④⑤⑥", "İstanbul İstanbul", "ΑΒΓΔΕΖ straße_straße1straßen", "abc123def", ""]


def test_completer_takes_letters_only(spark):
    prompts = ["Known topics:\n\nText:\n" + t for t in TEXTS]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, text string")
    found = [r["w"] for r in rows.select("k", stub.top_words(F.col("text")).alias("w")).orderBy("k").collect()]
    assert found[:3] == [["quadratm", "fläche"], ["abcdef", "ghijkl"], ["abcdefg"]]
    expected = ["\n".join(f"[1] {stub.capital_word(w)}: Documents about {w}." for w in words) or "None" for words in found]
    assert [stub.name_topics(p) for p in prompts] == expected
