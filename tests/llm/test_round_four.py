"""Language models keep every trigram, however many there are."""

import random

from pyspark.sql import functions as F

from ontime.llm import langid, near_dedup


def test_language_model_keeps_every_trigram_of_a_large_corpus(spark):
    r = random.Random(7)
    texts = [("".join(chr(0x4E00 + r.randrange(4000)) for _ in range(2500)), f"l{k:02d}") for k in range(64)]
    want = {t[max(0, i - 2): i + 1].rjust(3) for text, _ in texts for t in (" " + text,) for i in range(1, len(t))}
    assert len(want) > 140_000  # 32 MB of rows for 64 languages hold 131,072
    model = langid.fit(spark.createDataFrame(texts, "text string, lang string"))
    assert len(model.keys3) == len(want)


def test_rounds_of_components_write_few_files(spark):
    """Tables of a few rows are not written as a file for each shuffle partition, and those of many rows not as one."""
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 300) if i % 10 != 9], "a long, b long")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    limit = near_dedup.FILE_ROWS
    try:
        found = near_dedup.components(links)
        assert found.rdd.getNumPartitions() == 1
        near_dedup.FILE_ROWS = 100
        more = near_dedup.components(links)
        assert more.rdd.getNumPartitions() == 6
    finally:
        near_dedup.FILE_ROWS = limit
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r.node, r.root) for r in found.collect()} == {(r.node, r.root) for r in more.collect()} == {(i, i // 10 * 10) for i in range(300)}


def test_size_estimates_stay_small_through_the_rounds_of_components(spark):
    """A path needs several rounds of joins; the estimate of what they find is that of its rows, not the joins' product."""
    order = list(range(40))
    random.Random(3).shuffle(order)
    roots = near_dedup.components(spark.createDataFrame(list(zip(order, order[1:])), "a long, b long"))
    assert {(r.node, r.root) for r in roots.collect()} == {(i, 0) for i in range(40)}
    assert roots._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 20
