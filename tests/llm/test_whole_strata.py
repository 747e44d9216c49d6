"""Small and many strata."""

from tradeloom.llm import quality


def test_quality_small_and_many_strata(spark):
    """600 good labels suffice for a stratum of its own; one with few labels loses nothing, however many
    strata there are."""
    def doc(i, stratum, symbols):
        return (i, stratum, 60, 300, 0, 0, 0, symbols, 0.0, 0.0, 0.0, 0.0, 0.0)

    rows = [doc(i, "en", 0.0) for i in range(600)] + [doc(1000 + i, "en", 1.0) for i in range(200)]
    rows += [doc(2000 + i, f"s{i // 4}", 1.0) for i in range(1200)]
    stats = spark.createDataFrame(rows, f"id long, stratum string, {quality.STATISTICS}")
    labels = spark.createDataFrame([(r[0], int(not 1000 <= r[0] < 2000)) for r in rows], "doc_id long, quality int")
    judged = quality.judge(stats, quality.fit(stats, labels)).where("size(failed) > 0")
    assert judged.groupBy("stratum").count().collect() == [("en", 200)]
