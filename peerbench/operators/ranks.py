"""Exact order statistics of groups of any size, from mergeable histograms.

``percentile`` keeps every distinct value of a group in one buffer and a ranking window sorts a whole group in one task.
Here one aggregation counts each group's values by bin: 128 bins for each doubling of the size, so that the bins of a
group are bounded by the range of doubles and not by its rows, with the least and the greatest value of every bin. Adding
up bins finds the one that holds a wanted rank. A bin of one value is the answer; otherwise its range is refined: a large one
is cut into 4,096 parts of equal width, counted in the same way, until what is left is few enough to be ordered. All
ranks of all groups are refined together, in one scan per level. Histograms of parts of the data add up, so they can be
stored and carried on (``merge_histograms``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from peerbench.session import materialize, together

OCTAVE = 128  # bins for each doubling
OFFSET = 200_000  # above the bins of all doubles, so that the sign of a bin is that of its values
PARTS = 4_096  # ranges that a large bin is cut into at once
FEW = 10_000  # rows of one bin that are ordered in one place
MISSED = "order statistic fell outside its bin"


def bin_of(value: str) -> Column:
    """An integer that does not fall when the double column rises; NaN comes last."""
    size = f"floor(least(log2(abs({value})), 1025D) * {OCTAVE}) + {OFFSET}"
    return F.expr(
        f"cast(case when isnan({value}) then {2 * OFFSET} when {value} > 0 then {size} when {value} < 0 then -({size}) "
        f"when {value} = 0 then 0 end as int)")


def _values(rows: DataFrame, keys: Sequence[str], value: str, weight: str | None) -> DataFrame:
    """keys, the value as ``_v`` and how often it counts as ``_c``."""
    return rows.select(*keys, F.col(value).cast("double").alias("_v"), F.expr(f"cast({weight or 1} as long)").alias("_c"))


def histogram(rows: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """keys, bin, n, low, high: number, least and greatest of the values per bin; nulls are a bin of no values."""
    return (
        _values(rows, keys, value, weight).withColumn("bin", bin_of("_v")).groupBy(*keys, "bin")
        .agg(F.expr("sum(if(_v is null, 0L, _c)) as n"), F.expr("min(_v) as low"), F.expr("max(_v) as high")))


def merge_histograms(histograms: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Histograms of parts of the data as one."""
    return histograms.groupBy(*keys, "bin").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; null keys meet."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(other, condition, how).drop(*[f"_r_{k}" for k in keys])


def _targets(counts: DataFrame, keys: Sequence[str], ranks: Sequence[str]) -> DataFrame:
    """keys, _n, slots: for each rank (of ``_n`` rows, from 0) the bin that holds it and the rank within; null if none."""
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    placed = counts.select(
        *keys, "n", "low", "high", F.sum("n").over(group).alias("_n"),
        F.sum("n").over(group.orderBy(F.col("bin").asc_nulls_first())).alias("_upto"))
    slots = [
        f"max(case when _upto - n <= {rank} and {rank} < _upto then named_struct('low', low, 'high', high, 'left', cast({rank} as long) - _upto + n, 'n', n) end)"
        for rank in ranks]
    return placed.groupBy(*keys).agg(F.expr("max(_n) as _n"), F.expr(f"array({', '.join(slots)}) as slots"))


def _met(values: DataFrame, keys: Sequence[str], bounds: DataFrame, name: str) -> DataFrame:
    """The values with the bounds of their group."""
    return _join(values, bounds, keys) if keys else values.withColumn(name, bounds.select(name).scalar())


def _refined(values: DataFrame, keys: Sequence[str], targets: DataFrame) -> DataFrame:
    """The targets with every bin of more than ``FEW`` rows replaced by the part of it that holds the rank."""
    number = targets.select(*keys, "_n", F.posexplode("slots").alias("_slot", "_s"))
    large = number.where(f"_s.n > {FEW} and _s.low < _s.high")
    wanted = large.groupBy(*keys).agg(F.expr("collect_list(struct(_slot, _s)) as _wanted"))  # one entry per rank at most
    part = f"cast(least(floor((_v - _w._s.low) / (_w._s.high - _w._s.low) * {PARTS}), {PARTS - 1}) as int) as bin"
    counts = (
        _met(values, keys, wanted, "_wanted")
        .select(*keys, "_v", "_c", F.expr("explode(filter(_wanted, w -> _v between w._s.low and w._s.high)) as _w"))
        .select(*keys, F.expr("_w._slot as _slot"), F.expr("_w._s.left as _left"), F.expr(part), "_v", "_c")
        .groupBy(*keys, "_slot", "_left", "bin").agg(F.expr("sum(_c) as n"), F.expr("min(_v) as low"), F.expr("max(_v) as high")))
    finer = _targets(counts, [*keys, "_slot", "_left"], ["_left"]).select(*keys, "_slot", F.expr("get(slots, 0) as _new"))
    every = _join(number, finer, [*keys, "_slot"], "left")
    return every.groupBy(*keys).agg(
        F.expr("max(_n) as _n"), F.expr("array_sort(collect_list(struct(_slot, coalesce(_new, _s) as _s))) as _all")
    ).select(*keys, "_n", F.expr("transform(_all, a -> a._s) as slots"))


def _stored(targets: DataFrame) -> tuple[DataFrame, int | None]:
    """The targets written, and the rows of the largest bin of more than one value, noted while they are written."""
    seen = Observation()
    largest = F.expr("max(array_max(transform(slots, s -> if(s.low < s.high, s.n, null)))) as size")
    return materialize(targets.observe(seen, largest), "rank-bins"), seen.get["size"]


def order_statistics(
    rows: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, str],
    counts: DataFrame | None = None, weight: str | None = None,
) -> DataFrame:
    """Per group ``_n`` (its values that are not null) and for each name in ``ranks`` three columns.

    A rank is SQL over ``_n`` and counts from 0; one that no row has gives nulls. The column of the name holds the value
    at that rank, ``_skip`` behind it how many equal values come before the rank, ``_ties`` how many there are.
    ``counts`` is a histogram that is known already; ``weight`` is SQL for how often a row counts.
    """
    keys = list(keys)
    values = _values(rows, keys, value, weight).where("_v is not null")
    counts = histogram(rows, keys, value, weight) if counts is None else counts
    targets, size = _stored(_targets(counts, keys, list(ranks.values())))
    while size is not None and size > FEW:
        targets, size = _stored(_refined(values, keys, targets))
    if size is None:  # every bin has one value
        return targets.select(*keys, "_n", *[
            F.expr(f"get(slots, {i}).{field} as {name}{end}")
            for i, name in enumerate(ranks) for field, end in (("low", ""), ("left", "_skip"), ("n", "_ties"))])
    # the rows of the last bins, FEW per rank at most, are ordered per group
    inside = "{s}.low < {s}.high and _v between {s}.low and {s}.high"
    few = _met(values, keys, targets.select(*keys, "slots"), "slots").where(f"exists(slots, s -> {inside.format(s='s')})").select(*keys, "slots", "_v", "_c")
    few = few.union(targets.select(*keys, "slots", F.expr("cast(null as double)"), "_n"))
    lists = [F.expr(f"array_sort(collect_list(case when {inside.format(s=f'get(slots, {i})')} then struct(_v, _c) end)) as _l{i}") for i in range(len(ranks))]
    ordered = few.groupBy(*keys).agg(F.expr("max(if(_v is null, _c, null)) as _n"), F.expr("first(slots) as slots"), *lists)
    found = ordered.select("*", *[F.expr(f"{_reached(i)} as {name}") for i, name in enumerate(ranks)])
    out = []
    for i, name in enumerate(ranks):
        slot, total = f"get(slots, {i})", "aggregate(filter(_l{i}, x -> x._v {op} {name}), 0L, (a, x) -> a + x._c)"
        out += [name, F.expr(f"if({slot}.low = {slot}.high, {slot}.left, {slot}.left - {total.format(i=i, op='<', name=name)}) as {name}_skip"),
                F.expr(f"if({slot}.low = {slot}.high, {slot}.n, if({slot} is null, null, {total.format(i=i, op='=', name=name)})) as {name}_ties")]
    return found.select(*keys, "_n", *out)


def _reached(i: int) -> str:
    """SQL for the value with the rank ``left`` among the ordered (value, count) pairs of a slot."""
    slot = f"get(slots, {i})"
    start = "named_struct('upto', 0L, 'value', cast(null as double))"
    step = f"named_struct('upto', a.upto + x._c, 'value', coalesce(a.value, if({slot}.left < a.upto + x._c, x._v, null)))"
    return (
        f"case when {slot}.low < {slot}.high then coalesce(aggregate(_l{i}, {start}, (a, x) -> {step}).value, "
        f"cast(raise_error('{MISSED}') as double)) else {slot}.low end")


def exact_quantiles(
    rows: DataFrame, keys: Sequence[str], value: str, fractions: Mapping[str, float], extras: Sequence[Column] = (),
    counts: DataFrame | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per name in ``fractions``.

    ``extras`` are further aggregates of the groups. Rows with a null key are left out.
    """
    keys = list(keys)
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    position = {name: f"greatest(_n - 1, 0) * {float(p)!r}D" for name, p in fractions.items()}
    ranks = {f"_{side}_{name}": f"{side}({place})" for name, place in position.items() for side in ("floor", "ceil")}

    def search() -> DataFrame:
        return order_statistics(rows, keys, value, ranks, counts)

    def other() -> DataFrame:
        return materialize(rows.groupBy(*keys).agg(*extras), "extras")

    found, *rest = together(rows.sparkSession, search, *([other] if extras else []))
    quantiles = found.select(*keys, *[
        F.expr(f"_floor_{name} + (_ceil_{name} - _floor_{name}) * ({place} - floor({place})) as {name}") for name, place in position.items()])
    if not rest:
        return quantiles
    if keys:
        return rest[0].join(quantiles, keys, "left")
    one = rest[0].select(F.struct(*rest[0].columns)).scalar()
    return quantiles.select(*[one[c].alias(c) for c in rest[0].columns], *quantiles.columns)


def ntile_cuts(
    rows: DataFrame, group: str, value: str, tiles: int, counts: DataFrame | None = None, weight: str | None = None,
) -> DataFrame:
    """group, _slot, _cut, _skip, _ties: the last row of every tile but the greatest, as value and place among its equals."""
    ranks = {f"_c{j - 1}": f"{j} * floor(_n / {tiles}) + least({j}, _n % {tiles}) - 1" for j in range(1, tiles)}
    found = order_statistics(rows, [group], value, ranks, counts, weight)
    cuts = ", ".join(f"struct({j} as _slot, _c{j} as _cut, _c{j}_skip as _skip, _c{j}_ties as _ties)" for j in range(tiles - 1))
    return found.select(group, F.expr(f"inline(array({cuts}))")).where("_cut is not null")


def exact_ntile(
    rows: DataFrame, group: str, value: str, tie: str, tiles: int, name: str, cuts: DataFrame | None = None,
) -> DataFrame:
    """``ntile(tiles)`` of every row within its group ordered by ``value`` and then ``tie``.

    Only the ``tiles - 1`` cut rows of each group are looked for (or given, see ``ntile_cuts``); every row is then
    placed by comparing it with them. ``tie`` is an evenly spread text, unique within the group, such as an md5: a value
    shared by many rows is narrowed down by the first digits of it. Values must not be null; null groups are a group.
    """
    cuts = materialize(ntile_cuts(rows, group, value, tiles) if cuts is None else cuts, "cuts")
    split = cuts.filter(F.col("_skip") + 1 < F.col("_ties"))
    tied = not split.isEmpty()
    if tied:
        cuts = _join(cuts, materialize(_tie_cuts(rows, group, value, tie, split), "ties"), [group, "_slot"], "left")
    wide = cuts.groupBy(group).agg(*[
        F.max(F.when(F.col("_slot") == j, F.col(column))).alias(f"{column}{j}")
        for j in range(tiles - 1) for column in (["_cut", "_tie"] if tied else ["_cut"])])

    place = F.lit(1)
    for j in range(tiles - 1):
        beyond = F.col(value) > F.col(f"_cut{j}")
        if tied:
            beyond = beyond | ((F.col(value) == F.col(f"_cut{j}")) & (F.col(tie) > F.col(f"_tie{j}")))
        place = place + F.coalesce(beyond.cast("int"), F.lit(0))
    return _join(rows, materialize(wide, "cuts"), [group], "left").select(*rows.columns, place.cast("int").alias(name))


def _tie_cuts(rows, group, value, tie, split, digits: int = 3):
    """The cut inside a run of equal values: count by leading digits, then order one short range."""
    ties = (
        _join(rows.select(group, F.col(value).cast("double").alias("_cut"), F.col(tie).alias("_tie")), split, [group, "_cut"])
        .withColumn("_head", F.substring("_tie", 1, digits))
    )
    reached = F.col("_upto") - F.col("_c")
    heads = (
        ties.groupBy(group, "_slot", "_skip", "_head").agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_upto", F.sum("_c").over(Window.partitionBy(group, "_slot").orderBy("_head")))
        .filter((reached <= F.col("_skip")) & (F.col("_skip") < F.col("_upto")))
        .select(group, "_slot", "_head", (F.col("_skip") - reached).alias("_left"))
    )
    order = Window.partitionBy(group, "_slot").orderBy("_tie")
    return (
        _join(ties.drop("_skip", "_ties"), materialize(heads, "heads"), [group, "_slot", "_head"])
        .withColumn("_at", F.row_number().over(order))
        .filter(F.col("_at") == F.col("_left") + 1)
        .select(group, "_slot", "_tie")
    )
