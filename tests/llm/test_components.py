"""Connected components: labels, and the files that their rounds write."""

from pathlib import Path

from corpusgrove.llm.components import connected_components, merge_components
from corpusgrove.storage import shared_dir


def files(spark):
    return sum(1 for p in Path(shared_dir(spark).removeprefix("file://")).rglob("part-*.parquet") if p.parent.name.startswith(("labels-", "components-")))


def test_rounds_on_small_tables_write_few_files(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        before = files(spark)
        chain = [(k, k + 1) for k in range(0, 100)] + [(k, k + 1) for k in range(200, 300)]
        labels = connected_components(spark.createDataFrame(chain, "a long, b long"))
        assert {(r["id"], r["component"]) for r in labels.collect()} == {(k, 0) for k in range(101)} | {(k, 200) for k in range(200, 301)}
        labels = merge_components(labels, spark.createDataFrame([(100, 200), (400, 401)], "a long, b long"))
        assert {(r["id"], r["component"]) for r in labels.collect()} == {(k, 0) for k in [*range(101), *range(200, 301)]} | {(400, 400), (401, 400)}
        tables = len([p for p in Path(shared_dir(spark).removeprefix("file://")).rglob("*") if p.is_dir() and p.name.startswith(("labels-", "components-"))])
        assert files(spark) - before <= 8 * tables
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
