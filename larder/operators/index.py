"""Row numbers, per-group order, slices and chunk manifests without a single-task window.

The order key is a whole number. Its high bits name a cell, so with unique keys a cell holds at
most ``2**bits`` rows whatever the data looks like, and every window below runs inside one cell
(per group) or over at most ``2**bits`` cell totals. Cells that hold more, as keys repeat or are
null, are sorted by range over the whole order instead. One shuffle moves the rows; the totals are
counted from the key columns alone. Nothing is cached and no layout has to stay the same between
two passes, so a lost executor costs only its own tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.sizes import broadcast_if_small
from larder.session import settle

CELL_BITS = 16
# Rows a broadcast of cell starts may hold: three numbers each, under 100 MB.
BROADCAST_CELLS = 1_000_000
# monotonically_increasing_id keeps the partition number above these bits.
_PARTITION_SHIFT = 33


def _cell_range(df: DataFrame, key: str, bits: int) -> tuple[int, int]:
    """How many cells the keys span, and the cell after them, which holds the null keys."""
    low, high = df.agg(F.min(key).cast("bigint"), F.max(key).cast("bigint")).first()
    return (1, 0) if low is None else ((high >> bits) - (low >> bits) + 2, (high >> bits) + 1)


def _starts(totals: DataFrame, by: list[str], n_cells: int, bits: int) -> DataFrame:
    """For each (group, cell): the sum of ``_n`` over the group's earlier cells, as ``_start``."""
    if n_cells <= 1 << bits:
        earlier = (
            Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        )
        start = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
        return totals.select(*by, "_cell", "_n", start.alias("_start"))
    upper = totals.withColumn("_upper", F.shiftright("_cell", bits))
    earlier = (
        Window.partitionBy(*by, "_upper")
        .orderBy("_cell")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = upper.withColumn("_inside", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    above = _starts(
        upper.groupBy(*by, F.col("_upper").alias("_cell")).agg(F.sum("_n").alias("_n")),
        by,
        (n_cells >> bits) + 2,
        bits,
    ).select(*by, F.col("_cell").alias("_upper"), F.col("_start").alias("_above"))
    return inside.join(above, [*by, "_upper"]).select(
        *by, "_cell", "_n", (F.col("_inside") + F.col("_above")).alias("_start")
    )


def _with_cell(df: DataFrame, key: str, bits: int, null_cell: int) -> DataFrame:
    cell = F.shiftright(F.col(key).cast("bigint"), bits)
    return df.withColumn("_cell", F.coalesce(cell, F.lit(null_cell).cast("bigint")))


def _cell_starts(celled: DataFrame, by: list[str], n_cells: int, bits: int) -> DataFrame:
    totals = celled.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    for column in by:
        totals = totals.where(F.col(column).isNotNull())
    return _starts(totals, by, n_cells, bits)


def _on_cells(celled: DataFrame, cells: DataFrame, by: list[str], how: str) -> DataFrame:
    return celled.join(broadcast_if_small(cells), [*by, "_cell"], how)


def split_cells(
    celled: DataFrame, starts: DataFrame, by: list[str], bits: int
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the cells that one window may hold, and those of fuller cells with their ``_start``.

    Only rows of one key, or without a key, can fill a cell beyond its ``2**bits`` keys. ``starts``
    is a written table. The second frame is None if no cell is that full.
    """
    full = starts.where(F.col("_n") > 1 << bits).drop("_n")
    if not full.limit(1).count():
        return celled, None
    light = _on_cells(celled, full.drop("_start"), by, "left_anti")
    return light, _on_cells(celled, full, by, "inner")


def _sorted_positions(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """Rows of full cells with ``_position``, numbered by a sort over splitters of the whole order.

    The sort samples its splitters from key and ``then`` together, so a cell of one key, or of null
    keys, is cut into as many ranges as its size asks for. Rows are numbered by their place in the
    written ranges; a window runs over one total for each range only.
    """
    ordered = rows.orderBy(*by, "_cell", *order)
    laid = settle(ordered.withColumn("_mid", F.monotonically_increasing_id()), "full-cells")
    laid = laid.withColumn("_range", F.shiftright("_mid", _PARTITION_SHIFT))
    ranges = laid.groupBy(*by, "_cell", "_range").agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*by, "_cell").orderBy("_range")
    earlier = F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    placed = ranges.select(
        *by, "_cell", "_range", "_first", F.coalesce(earlier, F.lit(0)).alias("_earlier")
    )
    position = F.col("_start") + F.col("_earlier") + F.col("_mid") - F.col("_first")
    joined = laid.join(broadcast_if_small(placed), [*by, "_cell", "_range"])
    return joined.withColumn("_position", position.cast("bigint"))


def with_index(
    df: DataFrame,
    key: str,
    name: str = "idx",
    by: Sequence[str] = (),
    then: Sequence[str | Column] = (),
    bits: int = CELL_BITS,
) -> DataFrame:
    """Add ``name``: the row's 0-based position by ``key`` (then ``then``), within ``by`` if given.

    ``key`` and ``then`` together must be unique. Null keys come last, in ``then`` order. Any number
    of rows may share a key or have none: no window holds more than ``2**bits`` rows. A null ``by``
    value gives a null position.
    ``df`` is read three times (range, totals, rows): settle an expensive frame first.
    """
    by = list(by)
    n_cells, null_cell = _cell_range(df, key, bits)
    celled = _with_cell(df, key, bits, null_cell)
    starts = settle(_cell_starts(celled, by, n_cells, bits), "cell-starts")
    light, full = split_cells(celled, starts, by, bits)
    order = [F.asc_nulls_last(key), *(F.col(c) if isinstance(c, str) else c for c in then)]
    # Rows that get no position are dealt out, as there may be many of them.
    lost = F.lit(False)
    for column in by:
        lost = lost | F.col(column).isNull()
    salt = F.when(lost, F.floor(F.rand() * (1 << CELL_BITS))).otherwise(0)
    in_cell = Window.partitionBy(*by, "_cell", "_salt").orderBy(*order)
    numbered = light.withColumn("_salt", salt).withColumn("_row", F.row_number().over(in_cell) - 1)
    out = (
        numbered.join(starts.drop("_n"), [*by, "_cell"], "left")
        .withColumn(name, (F.col("_start") + F.col("_row")).cast("bigint"))
        .select(*df.columns, name)
    )
    if full is None:
        return out
    sorted_rows = _sorted_positions(full, by, order).withColumn(name, F.col("_position"))
    return out.unionByName(sorted_rows.select(*df.columns, name))


def ordered_slice(
    df: DataFrame,
    key: str,
    start: int,
    stop: int,
    then: Sequence[str | Column] = (),
    bits: int = CELL_BITS,
) -> DataFrame:
    """Rows ``start`` to ``stop - 1`` in key order, null keys last.

    Cells outside the slice are dropped before any row moves, and the kept cells' key range goes
    down to the file scan. The kept cells number at most the slice's rows, so their starts are
    broadcast only while that bound is small. A cell that holds more than ``2**bits`` rows, of one
    key or without one, is sorted over ranges of its own.
    """
    n_cells, null_cell = _cell_range(df, key, bits)
    celled = _with_cell(df, key, bits, null_cell)
    starts = _cell_starts(celled, [], n_cells, bits)
    touched = starts.where(
        (F.col("_start") < stop) & (F.col("_start") + F.col("_n") > start)
    )
    touched = settle(touched, "cells")
    low, high = touched.agg(F.min("_cell"), F.max("_cell")).first()
    if low is None:
        return df.where(F.lit(False))
    in_range = (F.col(key) >= low << bits) & (F.col(key) <= ((high + 1) << bits) - 1)
    if high == null_cell:
        in_range = in_range | F.col(key).isNull()
    light, full = split_cells(celled.where(in_range), touched, [], bits)
    order = [F.asc_nulls_last(key), *(F.col(c) if isinstance(c, str) else c for c in then)]
    named = touched.drop("_n")
    if stop - start <= BROADCAST_CELLS:
        named = F.broadcast(named)
    in_cell = Window.partitionBy("_cell").orderBy(*order)
    placed = light.join(named, "_cell").withColumn(
        "_position", F.col("_start") + F.row_number().over(in_cell) - 1
    )
    if full is not None:
        sorted_rows = _sorted_positions(full, [], order)
        placed = placed.select(*df.columns, "_position").unionByName(
            sorted_rows.select(*df.columns, "_position")
        )
    asked = (F.col("_position") >= start) & (F.col("_position") < stop)
    return placed.where(asked).select(*df.columns)


def head_rows(df: DataFrame, key: str, n: int, then: Sequence[str | Column] = ()) -> DataFrame:
    """The first ``n`` rows in key order, still spread over tasks however large ``n`` is."""
    return ordered_slice(df, key, 0, n, then)


def sorted_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx") -> DataFrame:
    """Add ``name``: the row's 0-based position in any total order, text columns included.

    The frame is sorted by range, numbered inside each partition and written to the shared
    folder; one count per written partition then turns the numbers into positions. Use it where
    the sorted rows are wanted anyway or the frame is worth settling.
    """
    laid = settle(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_mid", _PARTITION_SHIFT)
    totals = laid.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.col("_mid").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return (
        laid.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*df.columns, (F.col("_start") + inside).cast("bigint").alias(name))
    )


def interleave(df: DataFrame, source: str = "source", key: str = "dish_id") -> DataFrame:
    """Order rows so that the sources alternate: first row of each source, then the second, ...

    Rows without a source come last.
    """
    ranked = with_index(df, key, "source_order", by=[source])
    return ranked.orderBy(F.asc_nulls_last("source_order"), source, key)


def seeded_shuffle(df: DataFrame, key: str | Column, seed: int) -> DataFrame:
    """A random-looking order of a unique key: the same for the same seed under any layout.

    Ordered by the MD5 of seed and key, which other engines have too; of equal keys no order is
    defined.
    """
    key = F.col(key) if isinstance(key, str) else key
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")).cast("binary")))


def with_shard(df: DataFrame, idx: str, rows_per_shard: int, name: str = "shard") -> DataFrame:
    """Shard number from 1, ``rows_per_shard`` rows each."""
    return df.withColumn(name, F.expr(f"`{idx}` div {rows_per_shard}") + 1)


def chunk_manifest(
    counts: DataFrame, file: str, n: str, size: int = 4, block_bits: int = CELL_BITS
) -> DataFrame:
    """One row per chunk of ``size`` rows, from a table of row counts per file.

    The last chunk asks for ``size`` rows too. Chunks are made block by block and blocks are
    spread first, so one huge file does not become one task's work.
    """
    block = 1 << block_bits
    chunks = F.ceil(F.col(n) / F.lit(size)).cast("bigint")
    last_block = F.expr(f"(_chunks - 1) div {block}")
    blocks = (
        counts.select(F.col(file), chunks.alias("_chunks"))
        .where("_chunks > 0")
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
        .repartition(F.col(file), F.col("_block"))
    )
    first = F.col("_block") * block
    last = F.least(first + block, F.col("_chunks")) - 1
    return blocks.select(file, F.explode(F.sequence(first, last)).alias("chunk_no")).select(
        file,
        "chunk_no",
        (F.col("chunk_no") * size + 1).alias("start_index"),
        F.lit(size).cast("bigint").alias("nrows"),
    )


def chunk_rows(
    rows: DataFrame, manifest: DataFrame, file: str, idx: str, bin_rows: int = 4096
) -> DataFrame:
    """Rows each manifest entry asks for: positions ``start_index - 1`` on, ``nrows`` of them.

    A range join, made an equi-join on bins of ``bin_rows`` positions.
    """
    first_bin = F.expr(f"(start_index - 1) div {bin_rows}")
    last_bin = F.expr(f"(start_index + nrows - 2) div {bin_rows}")
    binned = manifest.where("nrows > 0").withColumn(
        "_bin", F.explode(F.sequence(first_bin, last_bin))
    )
    keyed = rows.withColumn("_bin", F.expr(f"`{idx}` div {bin_rows}"))
    position = F.col(idx) + 1
    return (
        keyed.join(binned, [file, "_bin"])
        .where(
            (position >= F.col("start_index"))
            & (position < F.col("start_index") + F.col("nrows"))
        )
        .drop("_bin")
    )


def chunk_sizes(df: DataFrame, idx: str, size: int, by: Sequence[str] = ()) -> DataFrame:
    """First position, last position and row count of each chunk."""
    return df.groupBy(*by, F.expr(f"`{idx}` div {size}").alias("chunk_no")).agg(
        F.min(idx).alias("first_idx"),
        F.max(idx).alias("last_idx"),
        F.count(F.lit(1)).alias("n_rows"),
    )
