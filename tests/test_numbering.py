from pyspark.sql import functions as F

from walletflow.operators.numbering import dense_number


def test_dense_numbering_is_gap_free_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    for parts in (1, 3, 16):
        out = dense_number(df, ["v", "g"], "no", partitions=parts).orderBy("no").collect()
        assert [r["no"] for r in out] == list(range(1, 5001))
        vals = [(r["v"], r["g"]) for r in out]
        assert vals == sorted(vals)


def test_dense_numbering_with_ties_and_empty(spark):
    df = spark.createDataFrame([("a",)] * 10 + [("b",)] * 3, "k string")
    out = dense_number(df, ["k"], "no").collect()
    assert sorted(r["no"] for r in out) == list(range(1, 14))
    empty = dense_number(df.limit(0), ["k"], "no")
    assert empty.count() == 0
