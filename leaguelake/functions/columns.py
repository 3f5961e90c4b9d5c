"""Column functions: names, results, rates, classes, dates and JSON paths.

Every function takes and returns ``Column`` expressions built from Spark's own functions, so they stay inside
whole-stage code generation and can be used in batch and streaming plans alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaguelake import values

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def choose(*cases: tuple[Column, object], default: object = None) -> Column:
    """First matching case wins; plain values become literals."""

    def literal(v: object) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    (first, value), *rest = cases
    out = F.when(first, literal(value))
    for condition, v in rest:
        out = out.when(condition, literal(v))
    return out if default is None else out.otherwise(literal(default))


def literal_map(mapping: Mapping[object, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


# names ------------------------------------------------------------------------------------------------------------


def club_name(c: ColumnLike, trim: bool = False) -> Column:
    """Drop a trailing `` FC`` and a leading ``AFC ``."""
    out = F.regexp_replace(F.regexp_replace(as_column(c), values.CLUB_SUFFIX, ""), values.CLUB_PREFIX, "")
    return F.trim(out) if trim else out


def mapped(c: ColumnLike, mapping: Mapping[str, object], default: ColumnLike | None = None) -> Column:
    """Dictionary lookup; names that are not in it pass through, or become ``default``."""
    c = as_column(c)
    return F.coalesce(F.try_element_at(literal_map(mapping), c), c if default is None else as_column(default))


def short_code(c: ColumnLike, codes: Mapping[str, str] = values.SHORT_CODES) -> Column:
    """Exact name, then the stripped name, then the first three letters in capitals."""
    c = as_column(c)
    known = literal_map(codes)
    return F.coalesce(
        F.try_element_at(known, c),
        F.try_element_at(known, club_name(c, trim=True)),
        F.upper(F.substring(c, 1, 3)),
    )


def last_token(c: ColumnLike) -> Column:
    return F.element_at(F.split(as_column(c), " "), -1)


# results ----------------------------------------------------------------------------------------------------------


def status_bucket(c: ColumnLike) -> Column:
    c = as_column(c)
    return choose(*[(c.isin(*raw), bucket) for bucket, raw in values.STATUS_BUCKETS.items()], default=c)


def winner(home: ColumnLike, away: ColumnLike) -> Column:
    home, away = as_column(home), as_column(away)
    return choose((home > away, "HOME_TEAM"), (home < away, "AWAY_TEAM"), (home == away, "DRAW"))


def side_result(won_by: ColumnLike, side: str) -> Column:
    """W/D/L of one side from the winner label; NULL while there is no winner label."""
    own, other = ("HOME_TEAM", "AWAY_TEAM") if side == "home" else ("AWAY_TEAM", "HOME_TEAM")
    return F.try_element_at(literal_map({own: "W", "DRAW": "D", other: "L"}), as_column(won_by))


def result(scored: ColumnLike, conceded: ColumnLike) -> Column:
    scored, conceded = as_column(scored), as_column(conceded)
    return choose((scored > conceded, "W"), (scored == conceded, "D"), default="L")


def points(scored: ColumnLike, conceded: ColumnLike) -> Column:
    scored, conceded = as_column(scored), as_column(conceded)
    return choose((scored > conceded, values.WIN_POINTS), (scored == conceded, values.DRAW_POINTS), default=0)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


# numbers ----------------------------------------------------------------------------------------------------------


def round_to(c: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back: the rounding of C-based engines on binary doubles.

    Spark's own ``round(double, n)`` rounds the shortest decimal text instead, so 1.005 would become 1.01.
    """
    scale = float(10**digits)
    return F.round(c.cast("double") * scale) / scale


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Double division, NULL for a missing or zero divisor."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def ratio_or_zero(numerator: ColumnLike, denominator: ColumnLike, digits: int, scale: float = 1.0) -> Column:
    """Rounded ``numerator * scale / denominator``, 0 unless the divisor is positive."""
    numerator, denominator = as_column(numerator), as_column(denominator)
    return F.when(denominator > 0, round_to(safe_divide(numerator * F.lit(scale), denominator), digits)).otherwise(
        F.lit(0.0)
    )


def share(numerator: ColumnLike, denominator: ColumnLike, digits: int, scale: float = 1.0) -> Column:
    """Rounded ratio, scaled after the division; NULL for a missing or zero divisor."""
    return round_to(safe_divide(numerator, denominator) * F.lit(scale), digits)


def finite(c: ColumnLike) -> Column:
    """NaN and infinities become NULL."""
    c = as_column(c)
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def number_from_text(c: ColumnLike, dtype: str = "int") -> Column:
    """Empty text counts as missing; text that is no number becomes NULL."""
    return F.nullif(F.trim(as_column(c)), F.lit("")).try_cast(dtype)


# classes ----------------------------------------------------------------------------------------------------------


def zone(position: ColumnLike, middle: str | None = None) -> Column:
    position = as_column(position)
    return choose(
        (position <= 4, "champions_league"),
        (position == 5, "europa_league"),
        (position == 6, "conference_league"),
        (position >= 18, "relegation"),
        default=middle,
    )


def below(c: ColumnLike, steps: Sequence[tuple[float, str]], default: str, inclusive: bool = False) -> Column:
    """Class by ascending upper bounds."""
    c = as_column(c)
    return choose(*[((c <= bound) if inclusive else (c < bound), label) for bound, label in steps], default=default)


def tier(position: ColumnLike) -> Column:
    return below(position, values.TIERS, values.LAST_TIER, inclusive=True)


def temperature_class(celsius: ColumnLike) -> Column:
    return below(celsius, values.TEMPERATURE_CLASSES, values.HOTTEST)


def momentum(points_per_game: ColumnLike, recency: ColumnLike, recent: int = 5) -> Column:
    """Form class of the most recent matches, NULL for older ones."""
    ppg = as_column(points_per_game)
    label = choose(*[(ppg >= bound, name) for bound, name in values.MOMENTUM], default=values.LOWEST_MOMENTUM)
    return F.when(as_column(recency) <= recent, label)


def pitch_condition(code: ColumnLike) -> Column:
    code = as_column(code)
    return choose(
        *[(code.between(low, high), label) for low, high, label in values.PITCH_CONDITIONS],
        default="Unknown",
    )


def weather_text(code: ColumnLike) -> Column:
    code = as_column(code)
    return F.coalesce(
        F.try_element_at(literal_map(values.WEATHER_CODES), code),
        F.concat(F.lit("Unknown ("), code.cast("string"), F.lit(")")),
    )


def matchday_status(live: ColumnLike, completed: ColumnLike, total: ColumnLike) -> Column:
    live, completed, total = as_column(live), as_column(completed), as_column(total)
    return choose(
        (live > 0, "LIVE"), (completed == total, "COMPLETED"), (completed > 0, "IN_PROGRESS"), default="UPCOMING"
    )


def outcome_label(passed: ColumnLike, severity: ColumnLike) -> Column:
    passed, severity = as_column(passed), as_column(severity)
    return choose((passed, "pass"), (severity == "critical", "fail"), default="warn")


def layer(schema: ColumnLike) -> Column:
    return mapped(schema, values.LAYERS, default=F.lit("Gold"))


# time -------------------------------------------------------------------------------------------------------------


def in_window(first: ColumnLike, last: ColumnLike, as_of: ColumnLike, days: int = 1) -> Column:
    """Whether the as-of date lies within [first - days, last + days]; false while a bound is missing."""
    first, last = F.to_date(as_column(first)), F.to_date(as_column(last))
    return F.coalesce(as_column(as_of).between(F.date_sub(first, days), F.date_add(last, days)), F.lit(False))


def monday_week(c: ColumnLike) -> Column:
    """Week of the year 00-53, weeks start on Monday, days before the first Monday are in week 0."""
    c = as_column(c)
    return F.floor((F.dayofyear(c) + 6 - F.weekday(c)) / 7).cast("int")


def minutes_since(earlier: ColumnLike, later: ColumnLike) -> Column:
    """Minute boundaries between two times, never negative."""
    minute = [F.date_trunc("minute", as_column(c)).cast("timestamp").cast("long") for c in (earlier, later)]
    return F.greatest(F.lit(0).cast("long"), ((minute[1] - minute[0]) / 60).cast("long"))


def clock(minute: ColumnLike, second: ColumnLike) -> Column:
    """``mm:ss`` with at least two digits each."""

    def two(c: ColumnLike) -> Column:
        text = as_column(c).cast("string")
        return F.lpad(text, F.greatest(F.length(text), F.lit(2)), F.lit("0"))

    return F.concat(two(minute), F.lit(":"), two(second))


def local_date(c: ColumnLike, zone_id: str = "America/New_York") -> Column:
    """Calendar date of a zone-less UTC time at a place."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone_id), as_column(c)))


# JSON -------------------------------------------------------------------------------------------------------------


def json_field(c: ColumnLike, path: str, dtype: str = "int") -> Column:
    return F.get_json_object(as_column(c), path).try_cast(dtype)
