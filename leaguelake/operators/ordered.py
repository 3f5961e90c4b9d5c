"""Row numbers, running values and rolling frames that stay parallel when one group holds most of the rows.

A window function sorts each of its groups in one task. That is fine for many small groups, but not for a ranking
over a whole table (one group) or for a key that holds a third of all rows. ``OrderedRows`` therefore always works as a
prefix sum over ranges of the total order (group columns, then order columns), in one lazy plan:

* a sketch takes a fixed number of rows, by hash, map-side combined; its quantiles are the borders of as many ranges as
  the session has shuffle partitions. Only borders inside a group that has at least two of them are kept: such a group holds
  more than a range's share of the rows. Other groups are not cut;
* windows run per (group, range);
* what a range needs from earlier ranges of its group - a row count, a running value, the last few rows - is
  aggregated per (group, range) of the cut groups alone, scanned over the ranges and handed back by range number. There are fewer
  cut groups than ranges, so borders, partial values and carry rows are broadcast whatever the size of the data.

The ranges decide only where rows are processed, never the result. Nothing runs before the caller's action. Rows are read up to
three times (sketch, partial values, windows), each time with the columns needed. The order must be unique inside a group (add a
tie-break column), and the rows must be the same whenever they are computed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRAWN = 32  # rows of the sketch for each range
RANGE = "_range"
BORROWED = "_borrowed"
CUTS = "_cuts"
USED = "_used"
KEY = "_key_in_order"
CHUNK = "_chunk"
IS_CUT = "_is_cut"


def descending(name: str) -> bool:
    return name.startswith("-")


def column_name(name: str) -> str:
    return name.removeprefix("-")


def sort_columns(order_by: Sequence[str]) -> list[Column]:
    """``"-points"`` sorts descending with nulls last, ``"team"`` ascending with nulls first."""
    return [
        F.col(column_name(o)).desc_nulls_last() if descending(o) else F.col(o).asc_nulls_first() for o in order_by
    ]


def reverse(order_by: Sequence[str]) -> list[str]:
    return [column_name(o) if descending(o) else f"-{o}" for o in order_by]


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def order_key_sql(df: DataFrame, order_by: Sequence[str]) -> str:
    """One struct that sorts ascending like ``order_by``; descending columns must be numbers, times, texts or booleans.

    A text is turned round as hexadecimal digits, mirrored, with an end that comes after all of them.
    """
    fields: list[str] = []
    for o in order_by:
        name = column_name(o)
        c, kind = quoted(name), df.schema[name].dataType
        if not descending(o):
            fields.append(c)
            continue
        fields.append(f"isnull({c})")
        if isinstance(kind, T.TimestampType | T.TimestampNTZType):
            fields.append(f"-unix_micros(cast({c} AS timestamp))")
        elif isinstance(kind, T.DateType):
            fields.append(f"-unix_date({c})")
        elif isinstance(kind, T.IntegralType):
            fields.append(f"~{c}")
        elif isinstance(kind, T.NumericType):
            fields += [f"NOT isnan({c})", f"-{c}"] if isinstance(kind, T.FractionalType) else [f"-{c}"]
        elif isinstance(kind, T.StringType | T.BinaryType):
            fields.append(f"concat(translate(hex({c}), '0123456789ABCDEF', 'FEDCBA9876543210'), 'G')")
        elif isinstance(kind, T.BooleanType):
            fields.append(f"NOT {c}")
        else:
            raise ValueError(f"cannot sort {o} descending: {kind.simpleString()}")
    return f"struct({', '.join(f'{f} AS k{i}' for i, f in enumerate(fields))})"


def order_key(df: DataFrame, order_by: Sequence[str]) -> Column:
    return F.expr(order_key_sql(df, order_by))


def order_sql(order_by: Sequence[str]) -> str:
    return ", ".join(f"{quoted(column_name(o))} {'DESC NULLS LAST' if descending(o) else 'ASC NULLS FIRST'}" for o in order_by)


class OrderedRows:
    """Windows over the rows of ``df``, grouped by ``partition_by`` and ordered by ``order_by``.

    Each method adds columns and returns the object; ``result()`` gives the DataFrame. ``ranges`` is the number of shuffle
    partitions unless given. Call ``rolling`` and ``previous`` first: they add the borrowed rows, and later windows reuse
    their shuffle and sort. With ``whole`` all passes use all columns: rows that come out of a shuffle are then shuffled
    once and read again from there.
    """

    def __init__(
        self, df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (), ranges: int | None = None, whole: bool = False
    ):
        self.partition_by, self.order_by, self.whole = list(partition_by), list(order_by), whole
        self.columns = df.columns
        self.derived = False  # a filter on the range then passes the windows of the base
        self.ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.key = order_key_sql(df, self.order_by)
        self.groups = ", ".join(map(quoted, self.partition_by))
        self.base = self._in_ranges(df)
        self.frame = self.base

    def _hash(self) -> str:
        names = self.columns if self.whole else [*self.partition_by, *map(column_name, self.order_by)]
        return f"xxhash64({', '.join(map(quoted, names))})"

    def _borders(self, df: DataFrame) -> DataFrame:
        """(group columns, cuts): the borders inside each group that is cut, fewer than there are ranges in all. They are kept in
        chunks of equal size."""
        names = [f"g{i}" for i in range(len(self.partition_by))]
        fields = [f"{quoted(c)} AS {n}" for c, n in zip(self.partition_by, names, strict=True)]
        rows = df.selectExpr(f"struct({', '.join([*fields, f'{self.key} AS key'])}) AS row", f"{self._hash()} AS drawn")
        sample = rows.groupBy(F.expr(f"pmod(drawn, {DRAWN * self.ranges}) AS place")).agg(F.expr("min_by(row, drawn) AS row"))
        ordered = sample.agg(F.expr("array_sort(collect_list(row)) AS rows"))  # at most DRAWN rows a range
        place = f"cast(i * size(rows) div {self.ranges + 1} AS int)"
        border = f"array_distinct(transform(sequence(1, {self.ranges}), i -> get(rows, {place})))"
        each = ordered.selectExpr(f"explode({border}) AS row").where("row IS NOT NULL").select("row.*")
        least = 2 if names else 1
        cut = each.groupBy(*names).agg(F.expr("array_sort(collect_list(key)) AS b")).where(f"size(b) >= {least}")
        width = "cast(ceil(sqrt(size(b))) AS int)"
        chunks = f"transform(sequence(0, (size(b) - 1) div {width}), i -> slice(b, cast(i * {width} + 1 AS int), {width})) AS {CUTS}"
        return cut.selectExpr(*[f"{n} AS {quoted(c)}" for n, c in zip(names, self.partition_by, strict=True)], chunks)

    def _in_ranges(self, df: DataFrame) -> DataFrame:
        """Rows with the number of their range - how many borders are at or below them - which is NULL in groups that are not
        cut. About twice the square root of the number of borders are looked at, once a row: key and chunk are columns of their own, which
        Spark does not repeat in what uses them several times, and a filter on cut groups asks for their borders, not for the number."""
        borders = self._borders(df)
        if self.partition_by:
            on = " AND ".join(f"rows.{quoted(c)} <=> cuts.{quoted(c)}" for c in self.partition_by)
            joined = df.alias("rows").join(F.broadcast(borders).alias("cuts"), F.expr(on), "left").select("rows.*", CUTS)
        else:
            joined = df.withColumn(CUTS, borders.scalar())
        kept = list(map(quoted, self.columns))
        keyed = joined.selectExpr(*kept, CUTS, f"CASE WHEN {CUTS} IS NOT NULL THEN {self.key} END AS {KEY}")
        found = keyed.selectExpr(*kept, CUTS, KEY, f"size(filter({CUTS}, c -> c[0] <= {KEY})) AS {CHUNK}")
        inside = f"size(filter(get({CUTS}, {CHUNK} - 1), b -> b <= {KEY}))"
        number = f"CASE WHEN {CUTS} IS NULL THEN NULL WHEN {CHUNK} = 0 THEN 0 ELSE ({CHUNK} - 1) * size({CUTS}[0]) + {inside} END AS {RANGE}"
        return found.selectExpr(*kept, number, f"{CUTS} IS NOT NULL AS {IS_CUT}")

    def _cut(self) -> DataFrame:
        """Rows of the groups that lie in more than one range."""
        rows = self.base.where(f"{RANGE} IS NOT NULL" if self.derived else IS_CUT)
        return rows.withColumn(USED, F.expr(self._hash())) if self.whole else rows

    def _per_range(self, *partials: str) -> DataFrame:
        """Partial values of each (group, range) of the cut groups."""
        used = [F.expr(f"max({USED}) AS {USED}")] if self.whole else []
        out = self._cut().groupBy(*self.partition_by, RANGE).agg(*map(F.expr, partials), *used)
        return out.where(f"{USED} IS NOT NULL") if self.whole else out

    def _over(self, frame: str = "") -> str:
        return f"OVER (PARTITION BY {', '.join(filter(None, [self.groups, RANGE]))} ORDER BY {order_sql(self.order_by)} {frame})"

    def _earlier(self, frame: str = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING") -> str:
        return f"OVER ({f'PARTITION BY {self.groups}' if self.groups else ''} ORDER BY {RANGE} {frame})"

    def derive(self, **columns: Column) -> OrderedRows:
        """Add row expressions; later windows can use them and the columns added so far."""
        self.frame = self.base = self.frame.withColumns(columns)
        self.columns = [c for c in self.base.columns if c not in (RANGE, IS_CUT)]
        self.derived = True
        return self

    def number(self, name: str, from_end: str | None = None) -> OrderedRows:
        """Row number from 1 in ``name``; with ``from_end`` also the row number counted from the last row."""
        return self.scan(name, from_end)

    def running(self, **aggregates: tuple[str, str]) -> OrderedRows:
        """Running ``sum``, ``count``, ``min``, ``max`` or ``last`` (not null) up to the current row: ``total=("sum", "points")``."""
        return self.scan(**aggregates)

    def scan(self, number: str | None = None, from_end: str | None = None, **aggregates: tuple[str, str]) -> OrderedRows:
        """``number`` and ``running`` in one pass: values within each range, and the exclusive scan of the ranges' partial values
        on top of them. Carry rows exist for cut groups only, at most two per range, so their broadcast is bounded."""
        here, partials, scanned, done = [], [], [], {}
        whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
        if number:
            here.append(f"cast(row_number() {self._over()} AS long) AS _number")
            partials.append("count(1) AS _n")
            scanned.append(f"sum(_n) {self._earlier()} AS _rows_before")
            done[number] = "_number + coalesce(_rows_before, 0)"
        if from_end:
            here.append(f"count(1) {self._over(whole)} AS _rows_here")
            scanned.append(f"sum(_n) {self._earlier(whole)} AS _rows_total")
            done[from_end] = f"coalesce(_rows_total, _rows_here) - ({done[number]}) + 1"
        for i, (name, (how, c)) in enumerate(aggregates.items()):
            c, own, carried = quoted(c), f"_own{i}", f"_carry{i}"
            up_to = self._over("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
            if how == "last":
                here.append(f"last({c}, true) {up_to} AS {own}")
                partials.append(f"max_by({c}, CASE WHEN {c} IS NOT NULL THEN {self.key} END) AS {carried}")
                scanned.append(f"last({carried}, true) {self._earlier()} AS {carried}")
            else:
                here.append(f"{how}({c}) {up_to} AS {own}")
                partials.append(f"{how}({c}) AS {carried}")
                scanned.append(f"{'sum' if how == 'count' else how}({carried}) {self._earlier()} AS {carried}")
            done[name] = {
                "sum": f"coalesce({own} + {carried}, {own}, {carried})",
                "count": f"{own} + coalesce({carried}, 0)",
                "min": f"least({own}, {carried})",
                "max": f"greatest({own}, {carried})",
                "last": f"coalesce({own}, {carried})",
            }[how]
        keys = [*map(quoted, self.partition_by), RANGE]
        carry = self._per_range(*partials).selectExpr(*keys, *scanned)
        on = " AND ".join(f"rows.{c} <=> carry.{c}" for c in keys)
        kept = [quoted(c) for c in self.frame.columns if c not in done]
        rows = self.frame.selectExpr("*", *here).alias("rows")
        joined = rows.join(F.broadcast(carry).alias("carry"), F.expr(on), "left")
        added = [f"carry.{x.rpartition(' AS ')[2]}" for x in scanned]
        values = [f"{e} AS {quoted(name)}" for name, e in done.items()]
        self.frame = joined.selectExpr("rows.*", *added).selectExpr(*kept, *values)
        return self

    def rolling(self, size: int, **aggregates: Column) -> OrderedRows:
        """Aggregates over the current row and the ``size - 1`` rows before it."""
        return self._framed(size - 1, aggregates, lambda w: w.rowsBetween(1 - size, Window.currentRow))

    def previous(self, **columns: str) -> OrderedRows:
        """Values of the row before, NULL on the first row: ``prev_time="time"``."""
        return self._framed(1, {name: F.lag(c) for name, c in columns.items()}, lambda w: w)

    def _framed(self, reach: int, expressions: Mapping[str, Column], frame) -> OrderedRows:
        out = self.frame
        if reach > 0:
            borrowed = self._last_rows(reach).withColumn(BORROWED, F.lit(True))
            out = out.withColumn(BORROWED, F.lit(False)).unionByName(borrowed, allowMissingColumns=True)
        window = frame(Window.partitionBy(*self.partition_by, RANGE).orderBy(*sort_columns(self.order_by)))
        kept = [quoted(c) for c in out.columns if c not in expressions]
        out = out.select(*kept, *[e.over(window).alias(name) for name, e in expressions.items()])
        self.frame = out.where(f"NOT {BORROWED}").drop(BORROWED) if reach > 0 else out
        return self

    def _last_rows(self, reach: int) -> DataFrame:
        """The ``reach`` rows before each range of a cut group, copied into that range.

        Only the last ``reach`` rows of each (group, range) are kept before anything is collected.
        """
        keys = [*map(quoted, self.partition_by), RANGE]
        backwards = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order_sql(reverse(self.order_by))}) AS _back"
        fields = ", ".join(map(quoted, self.columns))
        tails = (
            self._cut()
            .selectExpr("*", backwards)
            .where(f"_back <= {reach}")
            .groupBy(*self.partition_by, RANGE)
            .agg(F.expr(f"array_sort(collect_list(struct(-_back AS _back, {fields}))) AS _tail"))
        )
        nearby = self._earlier(f"ROWS BETWEEN {reach} PRECEDING AND 1 PRECEDING")
        return (
            tails.selectExpr(RANGE, f"flatten(collect_list(_tail) {nearby}) AS _rows")
            .where("size(_rows) > 0")
            .selectExpr(RANGE, f"explode(slice(_rows, -least(size(_rows), {reach}), {reach}))")
            .selectExpr(*[f"col.{quoted(c)}" for c in self.columns], RANGE)
        )

    def result(self) -> DataFrame:
        return self.frame.drop(RANGE, IS_CUT)


def global_row_number(
    df: DataFrame, order_by: Sequence[str], name: str = "position", ranges: int | None = None, whole: bool = False
) -> DataFrame:
    """Rank over the whole table without moving it into one task."""
    return OrderedRows(df, order_by, (), ranges, whole).number(name).result()


def row_number_per(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], name: str, ranges: int | None = None, whole: bool = False
) -> DataFrame:
    return OrderedRows(df, order_by, partition_by, ranges, whole).number(name).result()
