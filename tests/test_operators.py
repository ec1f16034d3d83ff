import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from builders import rows
from orderlens.operators import ranking
from orderlens.operators.dedup import collapse_copies, surplus_copies
from orderlens.operators.durable import drop, durable, durable_root, store
from orderlens.operators.keysets import flag_known, orphan_count
from orderlens.operators.lookup import lookup
from orderlens.operators.sampling import every, repeat_rows, sample_rows, share


def test_copies_include_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (2, "a")], "a int, b string")
    assert sorted(rows(collapse_copies(df)), key=str) == sorted(
        [(1, None, 2), (None, None, 1), (2, "a", 1)], key=str
    )
    assert surplus_copies(df).first().duplicates == 1
    assert surplus_copies(df.limit(0)).first().duplicates == 0


def test_membership(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    keys = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    flags = flag_known(df, "k", keys, "known")
    assert sorted(rows(flags), key=str) == sorted(
        [(1, False), (2, True), (2, True), (None, False)], key=str
    )
    assert orphan_count(df, "k", keys).first().orphans == 2
    assert orphan_count(df, "k", keys, null_is_orphan=False).first().orphans == 1
    assert orphan_count(df.limit(0), "k", keys).first().orphans == 0


def test_lookup_default(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    table = spark.createDataFrame([(1, 5.0), (3, None)], "k int, v double")
    found = lookup(df, "k", table, "v", "price", F.lit(9.0))
    assert sorted(rows(found)) == [(1, 5.0), (2, 9.0), (3, 9.0)]


def test_selection_is_repeatable(spark):
    df = spark.range(20000)
    hit = share(F.col("id"), 0.05, "a")
    first = {r.id for r in df.filter(hit).collect()}
    assert first == {r.id for r in df.repartition(7).filter(hit).collect()}
    assert 800 < len(first) < 1200
    assert first != {r.id for r in df.filter(share(F.col("id"), 0.05, "b")).collect()}
    assert df.filter(every(F.col("id"), 100, 3)).count() == 200
    sample = rows(sample_rows(df, 15, F.col("id"), "s"))
    assert len(set(sample)) == 15
    assert sample == rows(sample_rows(df.repartition(3), 15, F.col("id"), "s"))
    assert sample_rows(df.limit(4), 15, F.col("id"), "s").count() == 4


def test_appending_and_repeating(spark):
    df = spark.range(6)
    assert repeat_rows(df, every(F.col("id"), 3)).count() == 8
    assert repeat_rows(df, every(F.col("id"), 3)).columns == ["id"]


def test_durable_keeps_rows_and_schema(spark):
    df = spark.range(5).select("id", F.col("id").cast("decimal(38,0)").alias("d"))
    kept = durable(df)
    assert kept.dtypes == df.dtypes and sorted(rows(kept)) == sorted(rows(df))
    assert durable(df.limit(0)).count() == 0
    assert durable_root(spark) in kept.inputFiles()[0]


class _Unset:
    """A session of which only some settings exist."""

    def __init__(self, checkpoints=None, **settings):
        self.settings, self.folder = settings, checkpoints
        self.conf = self.sparkContext = self

    def get(self, name, default=None):
        return self.settings.get(name, default)

    def getCheckpointDir(self):
        return self.folder


def test_durable_folder_is_shared():
    warehouse = {"spark.sql.warehouse.dir": "s3a://shop/warehouse/"}
    named = {"spark.checkpoint.dir": "s3a://shop/scratch/"} | warehouse
    assert durable_root(_Unset(**named)) == "s3a://shop/scratch"
    assert durable_root(_Unset("hdfs://set/later", **warehouse)) == "hdfs://set/later"
    assert durable_root(_Unset(**warehouse)) == "s3a://shop/warehouse/_intermediate"


def test_dropped_tables_are_gone(spark):
    kept, path = store(spark.range(5).toDF("id"))
    assert kept.count() == 5
    drop(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def decimals(spark, data, schema, precision=38):
    """The column v as a whole-number decimal, like sums of cents."""
    df = spark.createDataFrame(data, schema)
    return df.withColumn("v", F.col("v").cast(f"decimal({precision},0)"))


def _values(kind, n, rng):
    if kind == "ties":
        return [rng.choice([5, 5, 5, 7, 1]) for _ in range(n)]
    if kind == "third":
        return [42 if rng.random() < 1 / 3 else rng.randrange(10**9) for _ in range(n)]
    if kind == "constant":
        return [3] * n
    if kind == "nulls":
        return [None if rng.random() < 0.2 else rng.randrange(50) for _ in range(n)]
    return [rng.randrange(10**12) for _ in range(n)]


KINDS = ("ties", "third", "constant", "nulls", "spread")


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("buckets", [2, 7, 64, 1024])
def test_global_rank_equals_the_window(spark, kind, buckets):
    rng = random.Random(f"{kind}{buckets}")
    data = list(enumerate(_values(kind, 400, rng)))
    df = decimals(spark, data, "id long, v long")
    split = ranking.rank_all(df, "v", "id", "r", "d", buckets=buckets)
    order = Window.orderBy(F.desc("v"))
    plain = df.withColumn("r", F.rank().over(order).cast("bigint")).withColumn(
        "d", F.dense_rank().over(order).cast("bigint")
    )
    assert sorted(rows(split.select("id", "r", "d"))) == sorted(rows(plain.select("id", "r", "d")))


def test_global_rank_of_nothing(spark):
    df = spark.createDataFrame([], "id long, v decimal(38,0)")
    ranked = ranking.rank_all(df, "v", "id", "r", "d")
    assert ranked.columns == ["id", "v", "r", "d"] and ranked.count() == 0


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_rank_within_hot_groups(spark, kind, broadcast):
    rng = random.Random(kind)
    groups = [0] * 300 + [1] * 60 + [rng.randrange(2, 40) for _ in range(200)]
    data = [(i, g, v) for i, (g, v) in enumerate(zip(groups, _values(kind, len(groups), rng)))]
    df = decimals(spark, data, "id long, g int, v long", 28)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        split = ranking.rank_within(df, "g", "v", "id", "r", hot_rows=50, buckets=8)
        plain = ranking.rank_within(df, "g", "v", "id", "r")
        assert sorted(rows(split.select("id", "r"))) == sorted(rows(plain.select("id", "r")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_group_is_split_like_any_other(spark):
    rng = random.Random(9)
    data = [(i, None if i % 3 else i % 50, rng.randrange(10**6)) for i in range(3000)]
    df = decimals(spark, data, "id long, g int, v long", 28)
    split = ranking.rank_within(df, "g", "v", "id", "r", hot_rows=100, buckets=16)
    plain = ranking.rank_within(df, "g", "v", "id", "r")
    assert sorted(rows(split.select("id", "r"))) == sorted(rows(plain.select("id", "r")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = split.filter("g IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(held) > 2 and max(r["count"] for r in held) < 1000


def test_slots_follow_the_rows():
    assert [ranking.slots_for(n) for n in (0, 1, 10**7, 10**12)] == [2, 2, 5, 500_000]


@pytest.mark.parametrize("n", [1, 5, 30, 10_000])
def test_leading_rows_by_group(spark, n):
    rng = random.Random(n)
    data = [(i, rng.choice([1, 1, 1, 2, 3, 4]), rng.randrange(9)) for i in range(200)]
    df = decimals(spark, data, "id long, g int, v long", 28)
    whole = ranking.rank_within(df, "g", "v", "id", "r").orderBy("g", "r", "id").limit(n)
    leading = ranking.first_by_group(df, "g", "v", "id", "r", n).orderBy("g", "r", "id").limit(n)
    assert rows(leading) == rows(whole)


def test_top_rank_counts_ties(spark):
    df = decimals(spark, list(enumerate([9, 9, 8, 7, 7, 1])), "id long, v long")
    top = ranking.rank_top(df, "v", "id", "r", "d", 4)
    assert sorted(rows(top.select("id", "r", "d"))) == [(0, 1, 1), (1, 1, 1), (2, 3, 2), (3, 4, 3)]
