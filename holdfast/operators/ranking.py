"""Exact ranks, order statistics and splits without one-task windows.

The plain forms of these operators order a whole table, or one of a handful of
groups, inside a single task. Here rows first fall into *cells*: ranges of the
ordering value, cut at approximate quantiles of the whole table, whatever their
group. Counts per (group, cell) give exact offsets, so only rows of one cell ever
have to be ordered together. A value so frequent that it would fill a cell is itself
a cut point and gets a cell of its own, where no ordering is needed and rows may be
spread freely.

Cells have two levels. The first has at most ``max_cells`` cut points, known when a
plan is made. On larger tables each of its cells is cut again, at points kept in a
written table of one row per cell, so rows per cell stay the same as tables grow.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import columns as C
from holdfast.session import materialize

CELL = "_cell"
_VALUE = "_value"
_GROUP = "_group"
_ALL = "all"  # group label when the caller has no groups
_CUTS, _TOPS, _TOP, _FREE = "_cuts", "_tops", "_top", "_free"

ROWS_PER_CELL = 200_000
MAX_CELLS = 4096  # of the first level
MAX_GROUPS = 64  # strata of a split
BROADCAST_CUTS = 1 << 24  # cut points of the second level, 8 bytes each
_SAMPLE = 50  # sampled rows per cell
_HOT_CELLS = 1_000_000  # cells whose rows are spread, at most
_SPREAD = 1 << 20
_SALTS = 64
_LEVEL = 32  # bits of a cell number below its first level


class TooManyGroups(ValueError):
    """More strata than a split is meant for."""


# --- cells --------------------------------------------------------------------


def _prepared(df: DataFrame, value: Column | str, group: Column | str | None) -> DataFrame:
    """Add the ordering value (one zero, no NaN) and the group as text."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    g = F.lit(_ALL) if group is None else (F.col(group) if isinstance(group, str) else group)
    v = C.nan_to_null(v) + F.lit(0.0)  # the sum turns -0.0 into 0.0
    return df.withColumn(_VALUE, v).withColumn(_GROUP, g.cast("string"))


def _known() -> Column:
    return F.col(_VALUE).isNotNull() & F.col(_GROUP).isNotNull()


def double_array(values: Sequence[float]) -> Column:
    """A constant array; parsed as one text, so long lists stay cheap to plan."""
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast("array<double>")


def _quantiles(parts: int) -> Column:
    """The values at 1/parts, 2/parts, ... of a sample."""
    return F.percentile_approx(
        _VALUE, double_array([i / parts for i in range(1, parts)]), 10 * parts
    )


def _cut_points(
    prepared: DataFrame, rows_per_cell: int, max_cells: int, n: int | None = None
) -> tuple[int, list[float]]:
    """Row count and cut points of the first level, about one per ``rows_per_cell`` rows.

    The count is exact. Cut points come from a random sample of a fixed size per
    cell: they only decide how evenly the work is spread, never a result, and
    merging quantile sketches of every task would not scale with the input.
    """
    known = prepared.where(_known())
    n = known.count() if n is None else n
    cells = min(max_cells, math.ceil(n / rows_per_cell))
    if cells <= 1:
        return n, []
    sample = known.where(F.rand(0) < min(1.0, _SAMPLE * cells / n))
    return n, _apart(sample.agg(_quantiles(cells)).first()[0] or [])


def _apart(points: Iterable[float]) -> list[float]:
    """Finite points in order, none the direct successor of another."""
    out: list[float] = []
    for p in sorted(set(points)):
        if abs(p) < sys.float_info.max and not (out and p == math.nextafter(out[-1], math.inf)):
            out.append(p)
    return out


def _edges(points: Sequence[float]) -> list[float]:
    """Bucket edges that also give every cut point a cell of its own, at odd numbers."""
    inner = [edge for p in points for edge in (p, math.nextafter(p, math.inf))]
    return [-math.inf, *inner, math.inf]


def _pieces(n: int, rows_per_cell: int, max_cells: int) -> int:
    """Cells of the second level in each of the first."""
    return math.ceil(n / (rows_per_cell * max_cells))


def _with_cells(
    prepared: DataFrame, n: int, points: Sequence[float], rows_per_cell: int, max_cells: int
) -> DataFrame:
    """Add the cell number: non-decreasing in the value, equal for equal values."""
    if not points:
        return prepared.withColumn(CELL, F.lit(0).cast("long"))
    first = Bucketizer(
        splits=_edges(points), inputCol=_VALUE, outputCol=CELL, handleInvalid="keep"
    ).transform(prepared)
    first = first.withColumn(CELL, F.shiftleft(F.col(CELL).cast("long"), _LEVEL))
    pieces = _pieces(n, rows_per_cell, max_cells)
    return first if pieces <= 1 else _cut_again(first, len(points) + 1, pieces, rows_per_cell)


def _cut_again(first: DataFrame, cells: int, pieces: int, rows_per_cell: int) -> DataFrame:
    """The second level: cells that hold more than one value, cut at their own points.

    A value finds its place in two steps, among every ``width``-th cut and then among
    the cuts between two of these.
    """
    columns = first.columns
    width = math.ceil(math.sqrt(pieces))
    mixed = F.shiftright(CELL, _LEVEL).bitwiseAND(F.lit(1)) == 0
    found = (
        first.where(_known() & mixed & (F.rand(0) < min(1.0, _SAMPLE / rows_per_cell)))
        .groupBy(CELL)
        .agg(F.array_sort(F.array_distinct(_quantiles(pieces))).alias(_CUTS))
        .where(F.size(_CUTS) > 0)
    )
    last = F.size(_CUTS)
    steps = F.sequence(F.lit(1), F.ceil(last / F.lit(width)).cast("int"))
    found = found.withColumn(
        _TOPS, F.transform(steps, lambda i: F.element_at(_CUTS, F.least(i * width, last)))
    )
    inner = materialize(found)  # drawn once: every use has the same cells
    if cells * pieces <= BROADCAST_CUTS:
        joined = first.join(F.broadcast(inner), CELL, "left")
    else:
        # rows are dealt by their own hash; cells of one value, which may be large, meet nothing
        whole = [c for c, kind in first.dtypes if "map<" not in kind]
        salted = inner.withColumn(_TOP, F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        salt = F.pmod(F.xxhash64(*whole), F.lit(_SALTS)).cast("int")
        joined = first.withColumn(_TOP, salt).join(salted.hint("merge"), [CELL, _TOP], "left")
    value = F.col(_VALUE)
    skipped = F.size(F.filter(_TOPS, lambda t: t < value)) * F.lit(width)
    near = F.slice(_CUTS, skipped + 1, F.lit(width))
    below = skipped + F.size(F.filter(near, lambda c: c < value))
    place = F.lit(2) * below + F.array_contains(near, value).cast("int")
    inside = F.when(F.col(_CUTS).isNotNull() & value.isNotNull(), place).otherwise(0)
    return joined.withColumn(CELL, F.col(CELL) + inside).select(*columns)


def _one_value() -> Column:
    """Whether the cell is that of a single cut point."""
    return (F.shiftright(CELL, _LEVEL).bitwiseAND(F.lit(1)) == 1) | (
        F.col(CELL).bitwiseAND(F.lit(1)) == 1
    )


def _offsets(cells: DataFrame, sums: Sequence[str], two_levels: bool) -> DataFrame:
    """Per (group, cell): totals of the cells before it and of the whole group.

    Windows run over cells of the first level in a group, and over cells of the
    second in one of the first; neither grows with the table.
    """
    whole = Window.partitionBy(_GROUP)

    def before(parts: list[str], order: str, name: str) -> Column:
        earlier = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(name).over(earlier), F.lit(0))

    if not two_levels:
        for name in sums:
            cells = cells.withColumn(f"{name}_before", before([_GROUP], CELL, name)).withColumn(
                f"{name}_total", F.sum(name).over(whole)
            )
        return cells
    cells = cells.withColumn(_TOP, F.shiftright(CELL, _LEVEL))
    tops = cells.groupBy(_GROUP, _TOP).agg(*[F.sum(name).alias(name) for name in sums])
    for name in sums:
        tops = tops.withColumn(f"_{name}", before([_GROUP], _TOP, name)).withColumn(
            f"{name}_total", F.sum(name).over(whole)
        )
    joined = cells.join(tops.drop(*sums), [_GROUP, _TOP])
    for name in sums:
        inside = before([_GROUP, _TOP], CELL, name)
        joined = joined.withColumn(f"{name}_before", F.col(f"_{name}") + inside)
    return joined.drop(_TOP, *[f"_{name}" for name in sums])


# --- percent rank -------------------------------------------------------------


def _spread(free: Column, key: str) -> Column:
    """Deals rows that need no order over very many small window groups."""
    return F.when(free, F.pmod(F.xxhash64(F.col(key)), F.lit(_SPREAD))).otherwise(
        F.lit(-1).cast("long")
    )


def _plain_percent_rank(prepared: DataFrame, ranked: Column, key: str, output: str) -> DataFrame:
    whole = Window.partitionBy(_GROUP, _spread(~ranked, key))
    order = whole.orderBy(_VALUE)
    place = (F.rank().over(order) + F.count("*").over(order)) / F.lit(2.0)
    return prepared.withColumn(output, F.when(ranked, place / F.count("*").over(whole)))


def average_percent_rank(
    df: DataFrame,
    value: Column | str,
    key: str,
    output: str,
    group: Column | str | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """Rank of ``value`` in its group over the group's size, ties averaged.

    Null where the value or the group is missing. Rows are shuffled once. There may
    be any number of groups, and any of them may hold most of the rows.
    """
    columns = df.columns
    prepared = _prepared(df, value, group)
    n, points = _cut_points(prepared, rows_per_cell, max_cells)
    ranked = _known()
    if not points:
        # the table fits in one cell: order it as it is
        return _plain_percent_rank(prepared, ranked, key, output).select(*columns, output)
    celled = _with_cells(prepared, n, points, rows_per_cell, max_cells)
    sizes = celled.where(ranked).groupBy(_GROUP, CELL).agg(F.count("*").alias("n"))
    offsets = _offsets(sizes, ["n"], _pieces(n, rows_per_cell, max_cells) > 1)
    # large cells of one value: at most _HOT_CELLS of them reach this size
    large = _one_value() & (F.col("n") > max(4 * rows_per_cell, math.ceil(n / _HOT_CELLS)))
    hot = offsets.where(large).select(
        _GROUP, CELL, *[F.col(c).alias(f"hot_{c}") for c in ("n", "n_before", "n_total")]
    )
    # rows of hot cells and unranked rows need no order, so no single task gets them
    dealt = celled.join(F.broadcast(hot), [_GROUP, CELL], "left").withColumn(
        _FREE, _spread(F.col("hot_n").isNotNull() | ~ranked, key)
    )
    rest = offsets.where(~large).withColumn(_FREE, F.lit(-1).cast("long"))
    # no hint: if this join shuffles, the window below reuses its partitioning
    joined = dealt.join(rest, [_GROUP, CELL, _FREE], "left")
    in_cell = Window.partitionBy(_GROUP, CELL, _FREE).orderBy(_VALUE)
    lowest, highest = F.rank().over(in_cell), F.count("*").over(in_cell)
    place = F.when(F.col("hot_n").isNotNull(), (F.col("hot_n") + 1) / F.lit(2.0)).otherwise(
        (lowest + highest) / F.lit(2.0)
    )
    before, total = F.coalesce("hot_n_before", "n_before"), F.coalesce("hot_n_total", "n_total")
    percent = F.when(ranked, (before + place) / total)
    return joined.withColumn(output, percent).select(*columns, output)


# --- running totals over distinct values --------------------------------------


def running_totals(
    df: DataFrame,
    value: Column | str,
    sums: Mapping[str, Column],
    group: Column | str | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """One row per (group, value): each sum, its running total below, its group total.

    Columns: ``_group``, ``_value`` and per sum ``x``, ``x_below``, ``x_total``.
    Rows are aggregated by value before any ordering, so frequent values cost
    nothing; distinct values are then ordered cell by cell. All groups share the
    cut points of the whole table, so there may be many groups.
    """
    prepared = _prepared(df, value, group)
    # cut over the rows handed in, before any grouping: one summary row
    n, points = _cut_points(
        prepared.select(_VALUE, F.lit(_ALL).alias(_GROUP)), rows_per_cell, max_cells
    )
    # declared not null, so that the join below adds no filter to one side only and
    # both sides read the same shuffled table
    keys = {
        _GROUP: F.coalesce(_GROUP, F.lit("")),
        CELL: F.coalesce(F.col(CELL), F.lit(-1).cast("long")),
    }
    table = (
        _with_cells(prepared, n, points, rows_per_cell, max_cells)
        .where(_known())
        .withColumns(keys)
        .groupBy(_GROUP, CELL, _VALUE)
        .agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    )
    names = list(sums)
    if not points:
        # the table fits in one cell: order it as it is
        in_group = Window.partitionBy(_GROUP)
        below = in_group.orderBy(_VALUE).rowsBetween(Window.unboundedPreceding, -1)
        return table.select(
            _GROUP,
            _VALUE,
            *names,
            *[F.coalesce(F.sum(n).over(below), F.lit(0)).alias(f"{n}_below") for n in names],
            *[F.sum(n).over(in_group).alias(f"{n}_total") for n in names],
        )
    cells = table.groupBy(_GROUP, CELL).agg(*[F.sum(name).alias(name) for name in names])
    offsets = _offsets(cells, names, _pieces(n, rows_per_cell, max_cells) > 1).drop(*names)
    # no hint: if this join shuffles, the window below reuses its partitioning
    joined = table.join(offsets, [_GROUP, CELL])
    below = (
        Window.partitionBy(_GROUP, CELL).orderBy(_VALUE).rowsBetween(Window.unboundedPreceding, -1)
    )
    running = [
        (F.col(f"{n}_before") + F.coalesce(F.sum(n).over(below), F.lit(0))).alias(f"{n}_below")
        for n in names
    ]
    return joined.select(_GROUP, _VALUE, *names, *running, *[f"{n}_total" for n in names])


# --- order statistics ---------------------------------------------------------


def values_at_ranks(
    df: DataFrame,
    value: Column | str,
    ranks: Callable[[int], Sequence[int]],
    rows_per_cell: int = ROWS_PER_CELL,
    max_cells: int = MAX_CELLS,
) -> tuple[int, dict[int, float]]:
    """Row count and exact values at 0-based ranks, ``(rows, {rank: value})``.

    ``ranks`` maps the row count to the ranks wanted. Only cells that hold a wanted
    rank are looked into; a large one is cut into cells again. Values of more than one
    cell are written first, as several passes read them.
    """
    if df.count() > rows_per_cell:
        one = F.col(value) if isinstance(value, str) else value
        df, value = materialize(df.select(one.cast("double").alias(_VALUE))), _VALUE
    known = _prepared(df, value, None).select(_VALUE, _GROUP).where(_known())
    n, points = _cut_points(known, rows_per_cell, max_cells)
    wanted = sorted({r for r in ranks(n) if 0 <= r < n})
    return n, _values_at(known, points, wanted, rows_per_cell, max_cells)


def _values_at(
    known: DataFrame, points: Sequence[float], wanted: Sequence[int], rows_per_cell: int, max_cells: int
) -> dict[int, float]:
    if not wanted:
        return {}
    if not points:
        # a few cells' worth of rows, equal values counted together
        upto = known.groupBy(_GROUP, _VALUE).agg(F.count("*").alias("n")).select(
            _VALUE, "n", F.sum("n").over(Window.partitionBy(_GROUP).orderBy(_VALUE)).alias("upto")
        )
        hit = F.lit(False)
        for r in wanted:
            hit = hit | ((F.col("upto") > r) & (F.col("upto") - F.col("n") <= r))
        rows = upto.where(hit).collect()  # at most one row per wanted rank
        return {r: x[_VALUE] for r in wanted for x in rows if x["upto"] - x["n"] <= r < x["upto"]}
    celled = _with_cells(known, 0, points, rows_per_cell, max_cells)  # the first level
    sizes = celled.groupBy(CELL).agg(
        F.count("*").alias("n"), F.min(_VALUE).alias("low"), F.max(_VALUE).alias("high")
    )
    out: dict[int, float] = {}
    before = 0
    for row in sorted(sizes.collect(), key=lambda x: x[CELL]):  # at most 2 x max_cells rows
        here = [r - before for r in wanted if before <= r < before + row["n"]]
        if here and row["low"] == row["high"]:
            out.update({before + r: row["low"] for r in here})
        elif here:
            part = celled.where(F.col(CELL) == row[CELL]).select(_VALUE, _GROUP)
            small = row["n"] <= 4 * rows_per_cell
            cuts = [] if small else _cut_points(part, rows_per_cell, max_cells, row["n"])[1]
            found = _values_at(part, cuts, here, rows_per_cell, max_cells)
            out.update({before + r: v for r, v in found.items()})
        before += row["n"]
    return out


def exact_quantiles(
    df: DataFrame, value: Column | str, quantiles: Sequence[float], **cells: int
) -> tuple[int, list[float]]:
    """Row count and exact interpolated quantiles; no quantiles of no rows."""

    def ranks(n: int) -> list[int]:
        return [r for q in quantiles for r in (math.floor((n - 1) * q), math.ceil((n - 1) * q))]

    n, found = values_at_ranks(df, value, ranks, **cells)
    values = []
    for q in quantiles if n else ():
        position = (n - 1) * q
        low, part = math.floor(position), position - math.floor(position)
        a, b = found[low], found[math.ceil(position)]
        values.append(a if part == 0 or a == b else a * (1 - part) + b * part)
    return n, values


def group_quantiles(
    df: DataFrame, value: Column | str, quantiles: Mapping[str, float], group: Column | str, **cells: int
) -> DataFrame:
    """Exact interpolated quantiles of every group: ``_group`` as text, and one column per name.

    There may be any number of groups, and any of them may hold most of the rows:
    values are counted first, and running counts go cell by cell.
    """
    totals = running_totals(df, value, {"n": F.lit(1).cast("long")}, group, **cells)
    position = {name: (F.col("n_total") - 1) * F.lit(float(q)) for name, q in quantiles.items()}

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("n_below") <= rank) & (rank < F.col("n_below") + F.col("n")), F.col(_VALUE)))

    found = totals.groupBy(_GROUP).agg(
        F.max("n_total").alias("n_total"),
        *[at(F.floor(p)).alias(f"{name}_low") for name, p in position.items()],
        *[at(F.ceil(p)).alias(f"{name}_high") for name, p in position.items()],
    )
    out = []
    for name, p in position.items():
        low, high, part = F.col(f"{name}_low"), F.col(f"{name}_high"), p - F.floor(p)
        between = low * (F.lit(1.0) - part) + high * part
        out.append(F.when((part == 0) | (low == high), low).otherwise(between).alias(name))
    return found.select(_GROUP, *out)


def exact_median(df: DataFrame, value: Column | str, **cells: int) -> float | None:
    """Exact median, the mean of the middle two for an even count."""
    n, values = exact_quantiles(df, value, [0.5], **cells)
    return values[0] if n else None


# --- splits by hashed key -----------------------------------------------------


def key_digest(key: Column | str, seed: int) -> Column:
    """Seeded digest of the key, the same text on any engine; a missing key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def _digest_at(share: float) -> str:
    """Digest prefix below which about ``share`` of all digests lie."""
    return "" if share <= 0 else "~" if share >= 1 else format(int(share * 16**12), "012x")


def digest_cuts(
    df: DataFrame,
    group: Column,
    digest: Column,
    targets: Callable[[dict[object, int]], dict[object, list[int]]],
    max_groups: int = MAX_GROUPS,
) -> dict[object, list[str]]:
    """Digests that end the first k rows of each group, in digest order.

    ``targets`` maps group sizes to ascending values of k per group. Returns, for
    each group and k, the digest of the k-th row ("" for k = 0).

    Digests are uniform, so the k-th of n lies within a few standard deviations,
    about sqrt(n) rows, of the share k / n. Rows below that window are counted,
    and only rows inside it are ordered; a miss is repeated with a wider window.
    """
    rows = df.groupBy(group.alias("g")).count().limit(max_groups + 1)
    sizes = {row["g"]: row["count"] for row in rows.collect()}
    if len(sizes) > max_groups:
        raise TooManyGroups(f"more than {max_groups} strata")
    wanted = {g: [min(k, sizes[g]) for k in ks] for g, ks in targets(sizes).items()}
    found = {(g, k): "" for g, ks in wanted.items() for k in ks if k <= 0}
    reach = 6.0
    while pending := [(g, k) for g, ks in wanted.items() for k in ks if (g, k) not in found]:
        windows = []
        for g, k in pending:
            n = sizes[g]
            half = reach * (math.sqrt(k * max(n - k, 1) / n) + 1) / n
            windows.append((_digest_at(k / n - half), _digest_at(k / n + half)))
        ours = [group.eqNullSafe(F.lit(g)) for g, _ in pending]
        below = df.agg(
            *[
                F.count_if(mine & (digest < low)).alias(f"b{i}")
                for i, (mine, (low, _)) in enumerate(zip(ours, windows))
            ]
        ).first()
        inside = F.array_compact(
            F.array(
                *[
                    F.when(mine & (digest >= low) & (digest < high), i)
                    for i, (mine, (low, high)) in enumerate(zip(ours, windows))
                ]
            )
        )
        ranked = df.select(digest.alias("d"), F.explode(inside).alias("i")).select(
            "d", "i", F.row_number().over(Window.partitionBy("i").orderBy("d")).alias("r")
        )
        hit = F.lit(False)
        for i, (_, k) in enumerate(pending):
            hit = hit | ((F.col("i") == i) & (F.col("r") == k - below[f"b{i}"]))
        for row in ranked.where(hit).collect():  # one row per cut
            found[pending[row["i"]]] = row["d"]
        missing = [x for x, w in zip(pending, windows) if x not in found and w == ("", "~")]
        if missing:
            raise RuntimeError(f"the table changed between passes: no digest ends {missing}")
        reach *= 4
    return {g: [found[g, k] for k in ks] for g, ks in wanted.items()}


def part_by_cuts(group: Column, digest: Column, cuts: Mapping[object, Sequence[str]]) -> Column:
    """0-based part of each row: the number of its group's cuts it lies beyond."""
    part = F.lit(None).cast("int")
    for g, points in cuts.items():
        beyond = F.lit(0)
        for point in points:
            beyond = beyond + (digest > point).cast("int")
        part = F.when(group.eqNullSafe(F.lit(g)), beyond).otherwise(part)
    return part


def _in_order(groups: Mapping[object, object]) -> list:
    """Group labels in order, a missing one last."""
    return sorted(groups, key=lambda g: (g is None, 0 if g is None else g))


def largest_remainder(sizes: Mapping[object, int], total: int) -> dict[object, int]:
    """Share ``total`` over the groups in proportion to their sizes, exactly."""
    n = max(1, sum(sizes.values()))
    quota = {g: total * size // n for g, size in sizes.items()}
    left = total - sum(quota.values())
    order = sorted(_in_order(sizes), key=lambda g: -(total * sizes[g] % n))
    for g in order[:left]:
        quota[g] += 1
    return quota


def stratified_split(
    df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ceil(test_size x n) test rows, shared by label.

    Each side is a row-local filter on the hashed key: no shuffle, and the same
    key always lands on the same side. Keys must be unique and labels not null.
    """
    group, digest = F.col(label), key_digest(key, seed)

    def targets(sizes: dict) -> dict:
        total = math.ceil(test_size * sum(sizes.values()))
        return {g: [k] for g, k in largest_remainder(sizes, total).items()}

    part = part_by_cuts(group, digest, digest_cuts(df, group, digest, targets))
    return df.where(part == 1), df.where(part == 0)


def fold_sizes(sizes: Mapping[object, int], folds: int) -> dict[object, list[int]]:
    """Rows per label and fold; dealt out in turn, so fold totals differ by one at most."""
    out, start = {}, 0
    for g in _in_order(sizes):
        end = start + sizes[g]
        out[g] = [(end - 1 - f) // folds - (start - 1 - f) // folds for f in range(folds)]
        start = end
    return out


def stratified_folds(
    df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42, output: str = "fold"
) -> DataFrame:
    """Add a fold number 0..folds-1, exact per label, by hashed key. No shuffle of rows."""
    group, digest = F.col(label), key_digest(key, seed)

    def targets(sizes: dict) -> dict:
        out = {}
        for g, parts in fold_sizes(sizes, folds).items():
            ends = [sum(parts[: i + 1]) for i in range(folds - 1)]
            out[g] = ends
        return out

    return df.withColumn(
        output, part_by_cuts(group, digest, digest_cuts(df, group, digest, targets))
    )


def time_folds(
    df: DataFrame, time: str, folds: int = 5, output: str = "fold", **cells: int
) -> DataFrame:
    """Add a fold number that grows with ``time``; equal times share a fold.

    Fold f starts at the time that holds rank f x n / folds, so validating on
    fold f against earlier folds never trains on the future.
    """

    def ranks(n: int) -> list[int]:
        return [f * n // folds for f in range(1, folds)]

    starts = sorted(set(values_at_ranks(df, time, ranks, **cells)[1].values()))
    fold = F.lit(0)
    for start in starts:
        fold = fold + (F.col(time) >= F.lit(start)).cast("int")
    return df.withColumn(output, F.when(F.col(time).isNotNull(), fold))
