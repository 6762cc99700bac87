"""Dense series, trailing sums, lags and ranks.

Series are aggregated to one row per entity and period before any of these run, so
an entity contributes at most as many rows as the calendar has periods, however many
raw rows it had. All functions over one entity share one window specification: one
shuffle on the entity, one sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series_window(entity: Sequence[str], date: str) -> WindowSpec:
    return Window.partitionBy(*entity).orderBy(date) if entity else Window.orderBy(date)


def _stretched(
    df: DataFrame, entity: Sequence[str], date: str, upper: Column | None, step: str,
    carried: Mapping[str, Column],
) -> DataFrame:
    """Repeat each row up to the period before the entity's next row; ``_pos`` is 0 on
    the row itself. ``carried`` are window results of the rows as they were."""
    following = F.lead(date).over(series_window(entity, date))
    if step == "day":
        before_next, interval = F.date_sub(following, 1), F.expr("interval 1 day")
    else:
        before_next, interval = F.add_months(following, -1), F.expr("interval 1 month")
    last = F.col(date) if upper is None else F.greatest(F.col(date), upper)
    rows = df.withColumns({**carried, "_until": F.coalesce(before_next, last)})
    kept = [c for c in rows.columns if c not in (date, "_until")]
    return rows.select(
        *kept, F.posexplode(F.sequence(F.col(date), F.col("_until"), interval)).alias("_pos", date)
    )


def _zero_filled(df: DataFrame, measures: Sequence[str]) -> list[Column]:
    return [
        F.when(F.col("_pos") == 0, F.col(m)).otherwise(F.lit(0).cast(df.schema[m].dataType)).alias(m)
        for m in measures
    ]


def densify(
    df: DataFrame,
    entity: Sequence[str],
    date: str,
    measures: Sequence[str],
    upper: Column | None = None,
    step: str = "day",
) -> DataFrame:
    """One row per entity and period from its first to its last one, zero filled.

    Each row is stretched up to the period before the entity's next row, so no calendar
    join is needed. ``upper`` (an expression over the row) extends the last stretch.
    """
    rows = _stretched(df, entity, date, upper, step, {})
    return rows.select(*entity, date, *_zero_filled(df, measures))


def dense_series(
    df: DataFrame,
    entity: Sequence[str],
    date: str,
    measures: Sequence[str],
    upper: Column | None = None,
    step: str = "day",
    events: Mapping[str, Column] | None = None,
    carry: Mapping[str, str] | None = None,
) -> DataFrame:
    """``densify`` with what a window would have to add up again: running totals
    (``_cum_<measure>``), the row's position (``_seen``) and the latest date each of
    ``events`` held. Zero periods change none of them, so they are worked out on the
    rows with data and carried over the stretch. A series that begins in the middle takes what lies before it from
    columns: ``carry`` names them for ``_first`` and the events."""
    running = series_window(entity, date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried, carry = {f"_cum_{m}": F.sum(m).over(running) for m in measures}, carry or {}

    def known(name: str, value: Column, pick) -> Column:
        return pick(value, F.col(carry[name])) if name in carry else value

    carried["_first"] = F.min(known("_first", F.col(date), F.least)).over(running)
    for name, condition in (events or {}).items():
        carried[name] = F.max(known(name, F.when(condition, F.col(date)), F.greatest)).over(running)
    rows = _stretched(df, entity, date, upper, step, carried)
    if step == "day":
        seen = F.datediff(date, "_first") + 1
    else:
        seen = F.months_between(date, "_first").cast("int") + 1
    return rows.select(
        *entity, date, *_zero_filled(df, measures), *[f"_cum_{m}" for m in measures],
        seen.alias("_seen"), *(events or {}),
    )


def trailing(
    df: DataFrame,
    entity: Sequence[str],
    date: str,
    sums: Mapping[str, tuple[str, int]],
    means: Mapping[str, tuple[str, int]] | None = None,
    earlier: Mapping[str, tuple[str, int, int]] | None = None,
    lags: Mapping[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """Sums and means over the last n rows, current one included.

    A running total minus the running total n rows back: cost does not grow with the
    frame. Exact for integers and decimals, which is what the measures are. ``earlier``
    names the same sum k rows back (measure, n, k), ``lags`` plain values k rows back
    (0 where there is none). Running totals of ``dense_series`` are taken as they are;
    then one window operator does everything.
    """
    means, earlier, lags = means or {}, earlier or {}, lags or {}
    w = series_window(entity, date)
    pairs = [*sums.values(), *means.values(), *[(m, n) for m, n, _ in earlier.values()]]
    given = {c for c in df.columns if c.startswith("_cum_") or c == "_seen"}
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    missing = {f"_cum_{m}": F.sum(m).over(running) for m, _ in pairs if f"_cum_{m}" not in given}
    if means and "_seen" not in given:
        missing["_seen"] = F.row_number().over(w)
    cum = df.withColumns(missing) if missing else df
    steps = {(m, n) for m, n in [*sums.values(), *means.values()]}
    for m, n, k in earlier.values():
        steps |= {(m, k), (m, k + n)}
    back = cum.withColumns(
        {
            **{f"_back_{m}_{n}": F.lag(f"_cum_{m}", n).over(w) for m, n in sorted(steps)},
            **{out: F.lag(c, k).over(w) for out, (c, k) in lags.items()},
        }
    )

    def less(total: Column, old: Column) -> Column:
        return F.when(old.isNull(), total).otherwise(total - old)

    def total(m: str, n: int) -> Column:
        return less(F.col(f"_cum_{m}"), F.col(f"_back_{m}_{n}"))

    return back.select(
        *[c for c in df.columns if c not in given],
        *[total(m, n).alias(out) for out, (m, n) in sums.items()],
        *[
            (total(m, n).cast("double") / F.least(F.col("_seen"), F.lit(n))).alias(out)
            for out, (m, n) in means.items()
        ],
        *[
            less(F.col(f"_back_{m}_{k}"), F.col(f"_back_{m}_{k + n}")).alias(out)
            for out, (m, n, k) in earlier.items()
        ],
        *[
            F.coalesce(out, F.lit(0).cast(df.schema[c].dataType)).alias(out)
            for out, (c, _) in lags.items()
        ],
    )


@dataclass(frozen=True)
class Trailing:
    """What is worked out for the dense rows of a series; names and meaning as in ``dense_trailing``."""

    entity: Sequence[str]
    date: str
    measures: Sequence[str]
    sums: Mapping[str, tuple[str, int]]
    means: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    earlier: Mapping[str, tuple[str, int, int]] = field(default_factory=dict)
    lags: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    step: str = "day"
    events: Mapping[str, Column] = field(default_factory=dict)

    @property
    def added(self) -> list[str]:
        """Measures with running totals."""
        return sorted({m for m, *_ in [*self.sums.values(), *self.means.values(), *self.earlier.values()]})

    @property
    def kept(self) -> list[str]:
        return [*self.measures, *[f"_cum_{m}" for m in self.added], *self.events]


def pack_series(df: DataFrame, spec: Trailing, upper: Column | None = None, carry: Mapping[str, str] | None = None) -> DataFrame:
    """One row per entity: its first period, number of periods and the rows with data, with running totals and the length of the stretch
    each begins. ``unpack_series`` makes the dense rows of it."""
    date, carry = spec.date, carry or {}
    w = series_window(spec.entity, date)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def known(name: str, value: Column, pick) -> Column:
        return pick(value, F.col(carry[name])) if name in carry else value

    following, last = F.lead(date).over(w), F.col(date) if upper is None else F.greatest(F.col(date), upper)
    if spec.step == "day":
        gap = F.coalesce(F.datediff(following, date), F.datediff(last, date) + 1)
    else:
        gap = F.coalesce(F.months_between(following, date).cast("int"), F.months_between(last, date).cast("int") + 1)
    # A second row for a date would shift what lies behind it.
    gap = F.when(gap < 1, F.raise_error(F.lit("an entity has two rows of one date")).cast("int")).otherwise(gap)
    rows = df.withColumns({
        "_gap": gap, "_start": known("_first", F.col(date), F.least), **{f"_cum_{m}": F.sum(m).over(running) for m in spec.added},
        **{n: F.max(known(n, F.when(c, F.col(date)), F.greatest)).over(running) for n, c in spec.events.items()}})
    return rows.groupBy(*spec.entity).agg(
        F.min(date).alias("_from"), F.min("_start").alias("_first"), F.sum("_gap").cast("int").alias("_n"),
        F.sort_array(F.collect_list(F.struct(date, "_gap", *spec.kept))).alias("_rows"))


def series_stretches(packed: DataFrame, spec: Trailing) -> DataFrame:
    """Stretches of periods over which nothing changes but dates and means, several rows for each entity: its ``_from`` and ``_first``,
    the places ``_pos`` of the first period and ``_next`` of the one behind the last, and what ``spec`` names for each of them.

    A sum changes only where a row with data enters or leaves its frame, so it is worked out once for all periods up to the next such
    place, of which there are a few for each row with data, however long the calendar is."""
    kinds = packed.schema["_rows"].dataType.elementType
    frames = [(n, 0) for _, n in [*spec.sums.values(), *spec.means.values()]] + [(n, k) for _, n, k in spec.earlier.values()]
    # Places behind a row with data at which a frame takes it in or lets it go, and at which a single value begins and ends.
    steps = {0} | {k + n for n, k in frames} | {k for _, k in frames}
    if spec.measures or spec.lags:
        steps |= {k + d for k in (0, *[k for _, k in spec.lags.values()]) for d in (0, 1)}
    days = spec.step == "day"

    def place(r: Column) -> Column:
        return F.datediff(r[spec.date], "_from") if days else F.months_between(r[spec.date], "_from").cast("int")

    def behind(n: int) -> Column:
        return F.transform("_at", lambda p: p + n)

    # Of each period the row with data that it is or follows; that row's columns are looked up in place.
    laid = packed.select(
        *spec.entity, "_from", "_first", "_n", "_rows", F.transform("_rows", place).alias("_at"),
        F.flatten(F.transform("_rows", lambda r, i: F.array_repeat(i, r["_gap"]))).alias("_row"))
    breaks = F.sort_array(F.array_distinct(F.concat(*[behind(s) for s in sorted(steps)])))
    rows = laid.select("*", breaks.alias("_breaks")).select("*", F.posexplode("_breaks").alias("_i", "_pos")).filter("_pos < _n")

    def row(k: int = 0) -> Column:
        return F.get("_row", F.col("_pos") - k if k else F.col("_pos"))

    def last(c: str, k: int = 0) -> Column:
        return F.get("_rows", row(k))[c]

    def value(c: str, k: int = 0) -> Column:
        if c not in spec.measures:
            return last(c, k)
        # A measure is 0 on periods without data, null before the first.
        here = F.get("_at", row(k)) == F.col("_pos") - F.lit(k)
        return F.when(here, last(c, k)).when(row(k).isNotNull(), F.lit(0).cast(kinds[c].dataType))

    def total(m: str, n: int, k: int = 0) -> Column:
        new, old = last(f"_cum_{m}", k), last(f"_cum_{m}", k + n)
        return F.when(old.isNull(), new).otherwise(new - old)

    return rows.select(
        *spec.entity, "_from", "_first", "_pos", F.least(F.coalesce(F.get("_breaks", F.col("_i") + 1), "_n"), "_n").alias("_next"),
        *[value(m).alias(m) for m in spec.measures], *[last(n).alias(n) for n in spec.events],
        *[total(m, n).alias(out) for out, (m, n) in spec.sums.items()],
        *[total(m, n).alias(out) for out, (m, n) in spec.means.items()],
        *[total(m, n, k).alias(out) for out, (m, n, k) in spec.earlier.items()],
        *[F.coalesce(value(c, k), F.lit(0).cast(kinds[c].dataType)).alias(out) for out, (c, k) in spec.lags.items()],
    )


def stretch_rows(stretches: DataFrame, spec: Trailing) -> DataFrame:
    """The dense rows of ``series_stretches``, made one by one."""
    rest = [c for c in stretches.columns if c not in ("_pos", "_next")]
    dense = stretches.select(*rest, F.explode(F.sequence(F.col("_pos"), F.col("_next") - 1)).alias("_pos"))
    at = F.date_add("_from", F.col("_pos")) if spec.step == "day" else F.add_months("_from", F.col("_pos"))
    seen = F.datediff(at, "_first") + 1 if spec.step == "day" else F.months_between(at, "_first").cast("int") + 1
    made = {out: (F.col(out).cast("double") / F.least(seen, F.lit(n))).alias(out) for out, (_, n) in spec.means.items()}
    return dense.select(
        *spec.entity, at.alias(spec.date), *[made.get(c, F.col(c)) for c in rest if c not in (*spec.entity, "_from", "_first")])


def unpack_series(packed: DataFrame, spec: Trailing) -> DataFrame:
    """The dense rows of packed series: what a stretch of periods has in common is worked out once and repeated."""
    return stretch_rows(series_stretches(packed, spec), spec)


def dense_trailing(
    df: DataFrame,
    entity: Sequence[str],
    date: str,
    measures: Sequence[str],
    sums: Mapping[str, tuple[str, int]],
    means: Mapping[str, tuple[str, int]] | None = None,
    earlier: Mapping[str, tuple[str, int, int]] | None = None,
    lags: Mapping[str, tuple[str, int]] | None = None,
    upper: Column | None = None,
    step: str = "day",
    events: Mapping[str, Column] | None = None,
    carry: Mapping[str, str] | None = None,
) -> DataFrame:
    """``trailing`` of ``dense_series``, with the same columns, but dense rows are never sorted or held.

    Windows run over rows with data. An entity's values and running totals are then laid out as one array each, with an
    element for each period (so an array is bounded by the calendar), and what lies k periods back is an element k places
    before. Dense rows are made from them one by one. Dates of monthly series lie on the same day of the month; columns
    named by ``carry`` are the same on all rows of an entity."""
    spec = Trailing(entity, date, measures, sums, means or {}, earlier or {}, lags or {}, step, events or {})
    return unpack_series(pack_series(df, spec, upper, carry), spec)


def lagged(
    df: DataFrame,
    entity: Sequence[str],
    date: str,
    lags: Mapping[str, tuple[str, int]],
    default: object = None,
) -> DataFrame:
    """Values k rows back, with a default where there is none."""
    w = series_window(entity, date)
    return df.withColumns({out: F.lag(c, k, default).over(w) for out, (c, k) in lags.items()})


def last_event(
    df: DataFrame, entity: Sequence[str], date: str, condition: Column, out: str
) -> DataFrame:
    """Latest date up to the current row on which the condition held."""
    w = series_window(entity, date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.max(F.when(condition, F.col(date))).over(w))


def trailing_days(
    df: DataFrame, entity: Sequence[str], date: str, measure: str, days: int, out: str
) -> DataFrame:
    """Sum over the last ``days`` calendar days of a series with gaps."""
    w = (
        Window.partitionBy(*entity)
        .orderBy(F.unix_date(F.col(date)).cast("int"))
        .rangeBetween(-(days - 1), 0)
    )
    return df.withColumn(out, F.sum(measure).over(w))


def rank_places(df: DataFrame, group: str, value: str, out: str, stretch: str | None = None) -> DataFrame:
    """``rank() over (partition by group order by value desc)`` of every value that a group holds, one row each.

    Rows are first counted per distinct value; only those counts are ordered inside a group. With whole, non-negative values k
    distinct ones need a total of at least k(k-1)/2, so the ordered list stays near the square root of the group's volume.
    ``stretch`` names the number of days, from the group's on, that a row stands for: then rows are counted where they begin and end,
    and a value's running count is laid out from one such day to the next, so cost does not depend on the days a row lasts."""
    if stretch is None:
        counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    else:
        ends = F.array(F.struct(F.col(group), F.lit(1).alias("_d")), F.struct(F.date_add(group, F.col(stretch)).alias(group), F.lit(-1).alias("_d")))
        moves = df.select(value, F.inline(ends)).groupBy(group, value).agg(F.sum("_d").alias("_d")).filter("_d <> 0")
        w = Window.partitionBy(value).orderBy(group)
        lasting = moves.select(
            value, F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_n"), F.col(group).alias("_a"),
            F.date_sub(F.lead(group).over(w), 1).alias("_b"))
        counts = lasting.filter("_n > 0").select(value, "_n", F.explode(F.sequence("_a", "_b", F.expr("interval 1 day"))).alias(group))
    higher = (
        Window.partitionBy(group)
        .orderBy(F.col(value).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.select(
        group, value, (F.coalesce(F.sum("_n").over(higher), F.lit(0)) + 1).alias(out)
    )


def rank_within(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """``rank() over (partition by group order by value desc)`` for groups of any size.

    A value shared by very many rows is one row of ``rank_places`` on the small side of the join back,
    and adaptive execution splits the other side.
    """
    return df.join(rank_places(df, group, value, out), [group, value])
