"""Unordered pairs of cells that share a day.

A day with ``n`` cells has ``n (n - 1) / 2`` pairs, so a crowded day cannot be
left to one task. Every form below cuts cells into hash blocks and gives each
pair of blocks its own join key, which bounds the work behind one key by the
block size however the rows are spread over days. The number of tasks follows
from the number of pairs, which is known without forming them.

The unique (cell, day) rows are read more than once, so they should come from
a staged table. Where they carry ``n_cells``, the number of cells on their day,
nothing about days is counted again; rows left out since only make it larger
than need be.
"""

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codays.functions import PAIR, cell_block, ordered_pair, precedes
from codays.operators.grid import cells_per_day
from codays.session import shuffle_width

CELLS_PER_BLOCK = 4096
PAIRS_PER_TASK = 2_000_000
TILES_PER_TASK = 3
#: Tiles for each task where they are packed by size.
TILES_PER_PACKED_TASK = 6


def number_of_pairs(unique: DataFrame) -> int:
    """How many (pair, day) rows there are, counted without forming them."""
    if "n_cells" in unique.columns:
        return (unique.agg(F.sum(F.col("n_cells") - 1)).first()[0] or 0) // 2
    return cells_per_day(unique).agg(F.sum("n_pairs")).first()[0] or 0


def tasks_for(spark: SparkSession, pairs: int, num_partitions: int | None = None) -> int:
    """Tasks for so many pairs: the given number, or as many as leave few enough to each."""
    return num_partitions or max(shuffle_width(spark), -(-pairs // PAIRS_PER_TASK))


def packed(sizes: dict[int, int], tasks: int) -> dict[int, int]:
    """A task for each tile: the largest tile left goes to the task with the least so far."""
    loads = [(0, task) for task in range(tasks)]
    given = {}
    for tile in sorted(sizes, key=lambda t: (-sizes[t], t)):
        load, task = heapq.heappop(loads)
        given[tile] = task
        heapq.heappush(loads, (load + sizes[tile], task))
    return given


def _task_of(tile: Column, tasks: int, sizes: dict[int, int] | None) -> Column:
    """The task of a tile: dealt out in turn, or packed where the sizes are known."""
    if not sizes:
        return (tile % tasks).cast("int")
    # One literal, of a few numbers for each task.
    given = packed(sizes, tasks)
    listed = F.split(F.lit(",".join(str(given.get(t, 0)) for t in range(max(given) + 1))), ",")
    return F.coalesce(F.get(listed, tile.cast("int")).cast("int"), F.lit(0))


def _met_sizes(sizes: DataFrame, pairs: Column, tile: Column) -> dict[int, int]:
    """Pairs for each tile from ``sizes`` (date, and two lists of block and count)."""
    a, b = F.col("a"), F.col("b")
    met = sizes.withColumn("a", F.explode("firsts")).withColumn("b", F.explode("seconds"))
    met = met.select(a["block"].alias("i"), b["block"].alias("j"), a["n"].alias("n"), b["n"].alias("m"))
    return dict(met.select(tile.alias("tile"), pairs.alias("k")).groupBy("tile").agg(F.sum("k")).where("tile >= 0").collect())


def _block_counts(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """For each date the list of its blocks with their numbers of cells, at most ``blocks`` entries."""
    counts = rows.groupBy("date", cell_block(F.lit(blocks)).cast("int").alias("block")).agg(F.count("*").alias("n"))
    return counts.groupBy("date").agg(F.collect_list(F.struct("block", "n")).alias(name))


TRIANGLE_TILE = "if(i <= j, j * (j + 1) div 2 + i, -1)"


def triangle_sizes(rows: DataFrame, blocks: int) -> dict[int, int]:
    """The exact number of (pair, day) rows of each tile, counted without forming them."""
    lists = _block_counts(rows, blocks, "firsts").withColumn("seconds", F.col("firsts"))
    return _met_sizes(lists, F.expr("if(i = j, n * (n - 1) div 2, n * m)"), F.expr(TRIANGLE_TILE))


def rectangle_sizes(left: DataFrame, right: DataFrame, blocks: int) -> dict[int, int]:
    """Rows of ``left`` times rows of ``right`` for each tile."""
    lists = _block_counts(left, blocks, "firsts").join(_block_counts(right, blocks, "seconds"), "date")
    return _met_sizes(lists, F.expr("n * m"), F.expr(f"i * {blocks} + j"))


def crowded_days(rows: DataFrame, cells_per_block: int = CELLS_PER_BLOCK) -> DataFrame:
    """Days with more rows than a block holds, and the blocks they need."""
    return (
        rows.groupBy("date")
        .agg(F.ceil(F.count("*") / F.lit(cells_per_block)).cast("int").alias("blocks"))
        .where("blocks > 1")
    )


def with_day_blocks(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """Attach each day's number of blocks; most days have one."""
    blocks = F.coalesce("blocks", F.lit(1))
    return rows.join(crowded, "date", "left").withColumn("blocks", blocks)


def triangular_pairs(
    blocked: DataFrame, num_partitions: int, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Self-join of rows with a ``blocks`` column on (date, block pair).

    Blocks ``i <= j`` of a day meet exactly once, so each pair of cells appears
    once. ``carry`` columns of both cells come along, suffixed 1 and 2.
    """
    placed = blocked.withColumn("block", cell_block(F.col("blocks")))

    def side(n: int, own: str, other: str, partners: Column) -> DataFrame:
        return placed.select(
            F.col("date").alias(f"date{n}"),
            F.col("block").alias(f"{own}{n}"),
            F.explode(partners).alias(f"{other}{n}"),
            *[F.col(c).alias(f"{c}{n}") for c in ("lat", "lon", *carry)],
        ).repartition(num_partitions, f"date{n}", f"i{n}", f"j{n}")

    left = side(1, "i", "j", F.sequence(F.col("block"), F.col("blocks") - 1))
    right = side(2, "j", "i", F.sequence(F.lit(0), F.col("block")))
    meet = (
        (F.col("date1") == F.col("date2"))
        & (F.col("i1") == F.col("i2"))
        & (F.col("j1") == F.col("j2"))
        & ((F.col("i1") < F.col("j1")) | precedes(*[F.col(c) for c in PAIR]))
    )
    # Sizes are estimated before the explode, so a broadcast must not be chosen here.
    return left.hint("merge").join(right, meet).select(
        *ordered_pair(*[F.col(c) for c in PAIR], carry=carry), F.col("date1").alias("date")
    )


def _width(unique: DataFrame, num_partitions: int | None) -> int:
    return tasks_for(unique.sparkSession, number_of_pairs(unique), num_partitions)


def cooccurrences(
    unique: DataFrame, num_partitions: int | None = None, cells_per_block: int = CELLS_PER_BLOCK
) -> DataFrame:
    """Every pair of cells on every day, as a join on the day.

    Days that outgrow a block are split; all others join on the plain day.
    """
    return triangular_pairs(_with_parts(unique, cells_per_block), _width(unique, num_partitions))


def cooccurrences_blocked(
    unique: DataFrame, blocks: int, num_partitions: int | None = None
) -> DataFrame:
    """The same rows with every day cut into a fixed number of blocks."""
    blocked = unique.withColumn("blocks", F.lit(blocks))
    return triangular_pairs(blocked, _width(unique, num_partitions))


def _meetings(rows: DataFrame, block: Column, others: Column, parts: Column, carry: tuple[str, ...]) -> DataFrame:
    """Rows repeated for every pair of blocks, and of parts, in which their cell meets others.

    ``block`` is the row's own block and ``others`` how many there are. Where
    a day has more than one part, the row's part meets each of them. The cell is
    ``first`` in meetings where its block, or part of equal blocks, is not the
    later one, and ``second`` where it is not the earlier one.
    """
    cell = F.struct("lat", "lon", *carry)
    part = F.pmod(F.xxhash64("lon", "lat", F.lit(1)), F.col("parts")).cast("int")
    met = (
        rows.withColumn("parts", parts)
        .withColumn("block", block)
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
        .withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    own, other = F.struct("block", "part"), F.struct(F.col("other").alias("block"), F.col("other_part").alias("part"))
    lower, upper = F.least(own, other), F.greatest(own, other)
    return met.select(
        lower["block"].alias("i"),
        upper["block"].alias("j"),
        lower["part"].alias("si"),
        upper["part"].alias("sj"),
        "date",
        F.when(own <= other, cell).alias("first"),
        F.when(own >= other, cell).alias("second"),
    )


def _array_pairs(meetings: DataFrame, *keys: str, carry: tuple[str, ...] = (), one_sided: bool = False) -> DataFrame:
    """Pairs of first and second cells of every meeting; an array holds one part of one block on one day.

    Where a meeting is of a part with itself, or ``one_sided``, only pairs in
    cell order count.
    """
    arrays = meetings.groupBy(*keys, "si", "sj", "date").agg(
        F.sort_array(F.collect_list("first")).alias("firsts"),
        F.sort_array(F.collect_list("second")).alias("seconds"),
    )
    a, b = F.col("a"), F.col("b")
    in_order = precedes(a.lat, a.lon, b.lat, b.lon)
    apart = (F.col("i") < F.col("j")) | (F.col("si") < F.col("sj"))
    ends = [F.col(f"{end}.{c}").alias(f"{c}{n}") for n, end in ((1, "a"), (2, "b")) for c in ("lat", "lon", *carry)]
    return (
        arrays.withColumn("a", F.explode("firsts"))
        .withColumn("b", F.explode("seconds"))
        .where(in_order if one_sided else apart | in_order)
        .select(*keys, *ends, "date")
        .select(*keys, *ordered_pair(*[F.col(c) for c in PAIR], carry=carry), "date")
    )


def _with_parts(rows: DataFrame, cells: int) -> DataFrame:
    """``blocks`` of a day as the parts that a block of it needs to hold at most ``cells`` cells."""
    if "n_cells" in rows.columns:
        return rows.withColumn("blocks", F.greatest(F.ceil(F.col("n_cells") / cells).cast("int"), F.lit(1)))
    return with_day_blocks(rows, crowded_days(rows, cells))


def tiled_cooccurrences(
    unique: DataFrame,
    num_partitions: int | None = None,
    cells_per_block: int = CELLS_PER_BLOCK,
    carry: tuple[str, ...] = (),
    pairs: int | None = None,
) -> DataFrame:
    """Every pair of cells on every day, laid out for counting days per pair.

    Cells, not days, are cut into blocks, and rows are shuffled once by tile,
    a pair of blocks ``(i, j)``. A pair always falls into the same tile, so
    grouping by (task, i, j, pair) happens where the pairs are made and no pair
    is shuffled. Each row is repeated once per block, of which there are enough
    for a few tiles per task; only rows of days that are too crowded for that are
    cut further, into parts that meet within the tile.

    Tiles are numbered and dealt out in turn to as many tasks as the pairs need.
    Where ``num_partitions`` is given, there are exactly so many tasks, and tiles
    are packed into them by their exact numbers of pairs.
    """
    if num_partitions:
        tasks, blocks = num_partitions, int((2 * TILES_PER_PACKED_TASK * num_partitions) ** 0.5) + 1
        sizes = triangle_sizes(unique, blocks)
    else:
        tasks = tasks_for(unique.sparkSession, number_of_pairs(unique) if pairs is None else pairs)
        blocks, sizes = int((2 * TILES_PER_TASK * tasks) ** 0.5) + 1, None
    rows = _with_parts(unique, cells_per_block * blocks)
    met = _meetings(rows, cell_block(F.lit(blocks)).cast("int"), F.lit(blocks), F.col("blocks"), carry)
    tile = F.expr("j * (j + 1) div 2") + F.col("i")
    dealt = met.withColumn("task", _task_of(tile, tasks, sizes)).repartitionById(tasks, "task")
    return _array_pairs(dealt, "task", "i", "j", carry=carry)


def rectangular_cooccurrences(
    left: DataFrame,
    right: DataFrame,
    pairs: int,
    num_partitions: int | None = None,
    cells_per_block: int = CELLS_PER_BLOCK,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Pairs of a cell of ``left`` and a later cell of ``right`` on every day, in tiles.

    Both sides are cut into blocks, and crowded days into parts, like the
    squares of ``tiled_cooccurrences``; the columns are the same.
    """
    if num_partitions:
        tasks, blocks = num_partitions, int((TILES_PER_PACKED_TASK * num_partitions) ** 0.5) + 1
        sizes = rectangle_sizes(left, right, blocks)
    else:
        tasks = tasks_for(left.sparkSession, pairs)
        blocks, sizes = int((TILES_PER_TASK * tasks) ** 0.5) + 1, None
    cells = cells_per_block * blocks
    crowded = None if "n_cells" in left.columns and "n_cells" in right.columns else crowded_days(right, cells)

    def side(rows: DataFrame, own: str, other: str, name: str) -> DataFrame:
        placed = (
            (_with_parts(rows, cells) if crowded is None else with_day_blocks(rows, crowded))
            .withColumn(own, cell_block(F.lit(blocks)).cast("int"))
            .withColumn(f"s{own}", F.pmod(F.xxhash64("lon", "lat", F.lit(1)), F.col("blocks")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            .withColumn(f"s{other}", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        )
        cell = F.struct("lat", "lon", *carry)
        return placed.select("i", "j", "si", "sj", "date", cell.alias(name))

    met = side(left, "i", "j", "first").unionByName(side(right, "j", "i", "second"), allowMissingColumns=True)
    tile = F.col("i") * blocks + F.col("j")
    dealt = met.withColumn("task", _task_of(tile, tasks, sizes)).repartitionById(tasks, "task")
    return _array_pairs(dealt, "task", "i", "j", carry=carry, one_sided=True)


def cooccurrences_array(
    unique: DataFrame, num_partitions: int | None = None, cells_per_block: int = CELLS_PER_BLOCK
) -> DataFrame:
    """Every pair of cells on every day, from arrays of a day's cells.

    Only crowded days are cut into parts here, so most days stay one array.
    """
    rows = _with_parts(unique, cells_per_block)
    met = _meetings(rows, F.lit(0), F.lit(1), F.col("blocks"), ())
    dealt = met.repartition(_width(unique, num_partitions), "date", "i", "j", "si", "sj")
    return _array_pairs(dealt, "i", "j").select(*PAIR, "date")


def canonical_pairs(unique: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Distinct cell pairs, smaller cell first."""
    tiled = tiled_cooccurrences(unique, num_partitions)
    return tiled.select("task", "i", "j", *PAIR).distinct().select(*PAIR)
