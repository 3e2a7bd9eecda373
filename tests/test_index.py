"""Row numbers, interleaving, slices and manifests: properties, skew, plan shape."""

import random

import pytest
from pyspark.sql import functions as F

from larder.operators import index as ix
from larder.operators.sizes import broadcast_if_small


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions, bits, far", [(1, 4, []), (4, 16, [2**62, -(2**62)]), (16, 16, [])])
def test_index_is_the_rank_of_the_key(spark, partitions, bits, far):
    """Also with keys far from the rest, where most cells between are empty."""
    keys = random.Random(partitions).sample(range(-500, 50_000), 700) + far
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(partitions)
    got = {r["k"]: r["idx"] for r in ix.with_index(df, "k", bits=bits).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_index_of_an_empty_frame(spark):
    assert ix.with_index(spark.createDataFrame([], "k long"), "k").collect() == []


def test_hot_group_is_split_into_bounded_cells(spark):
    """Two thirds of the rows in one source: no window group exceeds a cell."""
    df = spark.range(6000).withColumn("s", F.expr("CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('s', id % 30) END"))
    out = ix.with_index(df, "id", "place", by=["s"], bits=6)
    from pyspark.sql import Window

    want = F.row_number().over(Window.partitionBy("s").orderBy("id")) - 1
    assert out.withColumn("want", want).where("place <> want OR place IS NULL").count() == 0
    assert out.count() == 6000
    text = plan(out)
    assert "hashpartitioning(s" in text and "_cell" in text
    assert "SinglePartition" not in text


def test_null_group_has_no_place_and_comes_last(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (2, "b"), (3, "a")], "dish_id long, source string")
    rows = ix.interleave(df).collect()
    assert [(r["dish_id"], r["source_order"]) for r in rows] == [(0, 0), (2, 0), (3, 1), (1, None)]


def test_interleave_keeps_the_order_within_a_source(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "dish_id long, source string").repartition(7)
    out = [(r["dish_id"], r["source"]) for r in ix.interleave(df).collect()]
    for source in ("a", "b", "c"):
        mine = [i for i, s in out if s == source]
        assert mine == sorted(mine)
    assert sorted(out) == sorted(rows)


@pytest.mark.parametrize("bits", [3, 16])
def test_slices(spark, bits):
    df = spark.range(0, 3000, 3).repartition(5)
    got = ix.ordered_slice(df, "id", 120, 330, bits=bits)
    assert sorted(r["id"] for r in got.collect()) == [3 * i for i in range(120, 330)]
    assert ix.head_rows(df, "id", 10**9).count() == 1000
    assert ix.ordered_slice(df, "id", 1000, 1010, bits=bits).count() == 0


def test_slice_reaches_the_scan(spark, tmp_path):
    spark.range(5000).write.parquet(str(tmp_path / "t"))
    out = ix.ordered_slice(spark.read.parquet(str(tmp_path / "t")), "id", 100, 110, bits=5)
    assert sorted(r["id"] for r in out.collect()) == list(range(100, 110))
    pushed = plan(out).split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(id,96)" in pushed and "LessThanOrEqual(id,127)" in pushed


def test_sorted_index(spark):
    words = [f"{random.Random(i).random():.6f}" for i in range(400)]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(6)
    got = {r["w"]: r["idx"] for r in ix.sorted_index(df, ["w"]).collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


def test_shuffle_keeps_rows_and_repeats(spark):
    df = spark.range(200).select((F.col("id") % 5).alias("u"), "id")
    first = [r["id"] for r in ix.seeded_shuffle(df, "id", 1).collect()]
    assert first == [r["id"] for r in ix.seeded_shuffle(df.repartition(5), "id", 1).collect()]
    assert first != [r["id"] for r in ix.seeded_shuffle(df, "id", 2).collect()]
    assert sorted(first) == list(range(200))


@pytest.mark.parametrize("sizes", [[0, 1, 4, 5, 42], [200_001]])
def test_manifest_covers_each_row_once(spark, sizes):
    counts = spark.createDataFrame([(f"f{n}", n) for n in sizes], "file string, n long")
    made = ix.chunk_manifest(counts, "file", "n", 4, block_bits=10)
    got = {(r["file"], r["start_index"]) for r in made.collect()}
    assert got == {(f"f{n}", i * 4 + 1) for n in sizes for i in range((n + 3) // 4)}
    assert made.where("nrows <> 4").count() == 0


def test_chunk_rows_of_any_range(spark):
    rows = spark.range(100).select(F.lit("f").alias("file"), F.col("id").alias("idx"))
    manifest = spark.createDataFrame(
        [("f", 1, 4), ("f", 30, 50), ("f", 99, 9), ("g", 1, 4), ("f", 7, 0)],
        "file string, start_index long, nrows long",
    )
    got = ix.chunk_rows(rows, manifest, "file", "idx", bin_rows=8).select("start_index", "idx").collect()
    want = [(1, i) for i in range(0, 4)] + [(30, i) for i in range(29, 79)] + [(99, 98), (99, 99)]
    assert sorted((r["start_index"], r["idx"]) for r in got) == want


def test_shards(spark):
    out = ix.with_shard(spark.range(10).withColumnRenamed("id", "idx"), "idx", 4).collect()
    assert [r["shard"] for r in sorted(out)] == [1, 1, 1, 1, 2, 2, 2, 2, 3, 3]


def test_broadcast_only_below_the_limit(spark):
    big = spark.range(1000).select("id", F.lit("x" * 50).alias("t"))
    left = spark.range(10)
    small = left.join(broadcast_if_small(big), "id")
    assert "BroadcastHashJoin" in plan(small)
    hinted = broadcast_if_small(big, limit=100)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in hinted.lower()


def _skewed(spark):
    """A third of the rows without a key, a third of one key, and some without a group."""
    return spark.range(3000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 77 ELSE id END").alias("k"),
        F.concat(F.lit("t"), F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("t"),
        F.expr("CASE WHEN id % 7 = 0 THEN NULL WHEN id % 7 < 5 THEN 'hot' ELSE 'cold' END").alias("s"),
    )


@pytest.mark.parametrize("by", [[], ["s"]])
def test_null_and_repeated_keys_fill_no_window(spark, by):
    from pyspark.sql import Window

    df, bits = _skewed(spark).repartition(5), 6
    out = ix.with_index(df, "k", by=by, then=["t", F.desc("s")], bits=bits)
    order = Window.partitionBy(*by).orderBy(F.asc_nulls_last("k"), "t", F.desc("s"))
    want = F.row_number().over(order) - 1
    named = out.where("s IS NOT NULL") if by else out
    assert named.withColumn("want", want).where("NOT idx <=> want").count() == 0
    assert out.count() == 3000 and (not by or out.where("s IS NULL AND idx IS NOT NULL").count() == 0)

    n_cells, null_cell = ix._cell_range(df, "k", bits)
    celled = ix._with_cell(df, "k", bits, null_cell)
    starts = ix.settle(ix._cell_starts(celled, by, n_cells, bits))
    light, full = ix.split_cells(celled, starts, by, bits)
    named = light.where("s IS NOT NULL") if by else light
    largest = named.groupBy(*by, "_cell").count().agg(F.max("count")).first()[0]
    assert largest <= 1 << bits and full.where("k IS NULL").count() > 700


def test_slices_across_null_and_repeated_keys(spark):
    df = _skewed(spark).repartition(5)
    rows = sorted((r["k"] is None, r["k"] or 0, r["t"]) for r in df.collect())
    for start, stop in ((0, 3000), (0, 40), (20, 1200), (1990, 2500), (2990, 4000)):
        got = ix.ordered_slice(df, "k", start, stop, then=["t"], bits=6).collect()
        assert sorted((r["k"] is None, r["k"] or 0, r["t"]) for r in got) == rows[start:stop]
    every_null = df.where("k IS NULL")
    assert ix.head_rows(every_null, "k", 10, ["t"]).count() == 10
    assert ix.with_index(every_null, "k", then=["t"], bits=4).agg(F.max("idx")).first()[0] == 999
