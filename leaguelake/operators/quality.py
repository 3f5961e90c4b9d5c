"""Data contracts, quarantine, quality checks and reports.

A check result is a row ``(name, category, passed, severity, message, value)``. All measures of one table are taken
in one aggregate over it; results are unions of such one-row aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.functions import columns as C
from leaguelake.operators.joins import absent
from leaguelake.session import new_folder

# contracts --------------------------------------------------------------------------------------------------------


def _field(column: str, path: str, part: str) -> str:
    return f"{column}_{part}_{path.replace('.', '_')}"


class Record:
    """Fields of a JSON record, read once into columns that tell a missing key from a null."""

    def __init__(self, column: str, contract: Mapping):
        self.column = column
        self.valued = [*contract["enums"], *contract["ranges"]]
        nested = [f"{parent}.{c}" for parent, children in contract["nested"].items() for c in children]
        self.typed = list(dict.fromkeys([*contract["types"], *self.valued, *contract["nested"]]))
        self.untyped = [p for p in dict.fromkeys([*contract["required"], *nested]) if p not in self.typed]

    def tops(self) -> list[str]:
        """The keys of the record itself that any rule looks at."""
        return list(dict.fromkeys(p.partition(".")[0] for p in [*self.typed, *self.untyped]))

    def value(self, path: str) -> Column:
        """The value at a path; keys of the record come out of one pass over it."""
        top, _, rest = path.partition(".")
        at = F.col(f"{self.column}.{top}")
        return F.try_variant_get(at, f"$.{rest}", "variant") if rest else at

    def fields(self) -> dict[str, Column]:
        out = {}
        for path in self.typed:
            out[_field(self.column, path, "kind")] = F.schema_of_variant(self.value(path))
        for path in self.untyped:
            out[_field(self.column, path, "missing")] = self.value(path).isNull()
        for path in self.valued:
            for part in ("string", "double"):
                out[_field(self.column, path, part)] = F.try_variant_get(self.value(path), "$", part)
        return out

    def kind(self, path: str) -> Column:
        """Type name of the value, NULL if the key is missing."""
        return F.col(_field(self.column, path, "kind"))

    def missing(self, path: str) -> Column:
        if path in self.typed:
            return self.kind(path).isNull()
        return F.col(_field(self.column, path, "missing"))

    def given(self, path: str) -> Column:
        """Present and not null."""
        return F.coalesce(self.kind(path) != "VOID", F.lit(False))

    def text(self, path: str) -> Column:
        return F.col(_field(self.column, path, "string"))

    def number(self, path: str) -> Column:
        return F.col(_field(self.column, path, "double"))


def _is_type(kind: Column, expected: str) -> Column:
    if expected == "str":
        return kind == "STRING"
    # A whole number too large for 64 bits is a decimal without fraction; 1.0 is a decimal too, but a short one.
    return kind.isin("BIGINT", "BOOLEAN") | kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$")


def _type_name(kind: Column) -> Column:
    return C.choose(
        (_is_type(kind, "int") & (kind != "BOOLEAN"), "int"),
        (kind == "BOOLEAN", "bool"),
        (kind == "STRING", "str"),
        (kind.startswith("ARRAY"), "list"),
        (kind.startswith("OBJECT"), "dict"),
        default="float",
    )


@dataclass(frozen=True)
class Rule:
    """A condition that a record breaks, and how the violation is reported."""

    broken: Column
    field: str
    rule: str
    message: Column
    severity: str = "ERROR"

    def violation(self) -> Column:
        return F.when(
            self.broken,
            F.struct(
                F.lit(self.field).alias("field"),
                F.lit(self.rule).alias("rule"),
                self.message.alias("message"),
                F.lit(self.severity).alias("severity"),
            ),
        )


def _rules(record: Record, contract: Mapping) -> list[Rule]:
    out = [
        Rule(record.missing(f), f, "required", F.lit(f"Missing required field: {f}")) for f in contract["required"]
    ]
    for f, expected in contract["types"].items():
        kind = record.kind(f)
        message = F.concat(F.lit(f"Expected {expected}, got "), _type_name(kind))
        out.append(Rule(record.given(f) & ~_is_type(kind, expected), f, "type", message))
    for f, allowed in contract["enums"].items():
        text = F.coalesce(record.text(f), F.lit("None"))
        fits = record.given(f) & (record.kind(f) == "STRING") & text.isin(*allowed)
        message = F.concat(F.lit("Value '"), text, F.lit(f"' not in allowed values: {list(allowed)}"))
        out.append(Rule(~record.missing(f) & ~fits, f, "enum", message, "WARN"))
    for f, (low, high) in contract["ranges"].items():
        kind = record.kind(f)
        numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL")
        outside = record.given(f) & numeric & ~record.number(f).between(low, high)
        message = F.concat(F.lit("Value "), record.text(f), F.lit(f" outside range [{low}, {high}]"))
        out.append(Rule(outside, f, "range", message))
    for parent, children in contract["nested"].items():
        is_object = F.coalesce(record.kind(parent).startswith("OBJECT"), F.lit(False))
        out.extend(
            Rule(
                is_object & record.missing(f"{parent}.{c}"),
                f"{parent}.{c}",
                "nested_required",
                F.lit(f"Missing nested field: {parent}.{c}"),
            )
            for c in children
        )
    return out


def _read(df: DataFrame, contract: Mapping, record: str) -> tuple[DataFrame, Column, list[Rule]]:
    """The records with their fields as columns, whether a record is no JSON object, and the rules."""
    read = Record("_record", contract)
    shape = ", ".join(f"`{p}`: variant" for p in read.tops())
    once = F.try_variant_get(F.try_parse_json(F.col(record)), "$", f"struct<{shape}>")
    parsed = df.withColumn("_record", once).withColumns(read.fields())
    return parsed, F.col("_record").isNull(), _rules(read, contract)


def _handed_on(parsed: DataFrame, columns: Sequence[str], name: str, value: Column) -> DataFrame:
    """``columns`` and one computed column.

    A filter on that column would be pushed below the projections and repeat all of their work in the filter; it does
    not pass a generator, so the value is handed on through one that yields exactly one row.
    """
    once = F.explode(F.array(F.struct(value.alias(name)))).alias("_once")
    return parsed.select(*columns, once).select(*columns, f"_once.{name}")


def _fails(no_object: Column, rules: Sequence[Rule]) -> Column:
    out = no_object
    for r in rules:
        if r.severity == "ERROR":
            out = out | F.coalesce(r.broken, F.lit(False))
    return out


def _found(df: DataFrame, contract: Mapping, record: str) -> tuple[DataFrame, Column]:
    """The parsed records, and the array of their violations in rule order."""
    parsed, no_object, rules = _read(df, contract, record)
    broken = Rule(F.lit(True), record, "json", F.lit("Record is not a JSON object")).violation()
    found = F.array_compact(F.array(*[r.violation() for r in rules]))
    return parsed, F.when(no_object, F.array(broken)).otherwise(found)


def with_violations(df: DataFrame, contract: Mapping, record: str = "raw_json") -> DataFrame:
    """Add the array ``violations`` to each record, in rule order; empty for a record that meets the contract."""
    parsed, found = _found(df, contract, record)
    return _handed_on(parsed, df.columns, "violations", found)


def violations(
    df: DataFrame, contract: Mapping, keys: Sequence[str], record: str = "raw_json"
) -> DataFrame:
    """One row per violation."""
    parsed, found = _found(df, contract, record)
    each = parsed.select(*keys, F.explode(found).alias("_v"))
    return each.select(*keys, "_v.field", "_v.rule", "_v.message", "_v.severity")


def has_error(column: str = "violations") -> Column:
    return F.exists(column, lambda v: v["severity"] == "ERROR")


def _gate(rows: DataFrame, failed: Column, name: str, threshold: float) -> DataFrame:
    passed = F.col("records_checked") - F.col("_failed")
    return rows.agg(F.count(F.lit(1)).alias("records_checked"), failed.alias("_failed")).select(
        F.lit(name).alias("contract_name"),
        F.coalesce(C.safe_divide("_failed", "records_checked") <= threshold, F.lit(True)).alias("valid"),
        "records_checked",
        passed.alias("records_passed"),
        F.coalesce(C.safe_divide(passed, "records_checked"), F.lit(0.0)).alias("pass_rate"),
    )


def contract_gate(
    df: DataFrame, contract: Mapping, threshold: float = 0.1, record: str = "raw_json"
) -> DataFrame:
    """One row: valid while at most ``threshold`` of the records have an error; an empty batch is valid."""
    parsed, no_object, rules = _read(df, contract, record)
    return _gate(parsed, F.count_if(_fails(no_object, rules)), contract["name"], threshold)


def gate_of(rows: DataFrame, name: str, threshold: float = 0.1) -> DataFrame:
    """The same from records that are judged already."""
    return _gate(rows, F.count_if(F.col("verdict") == "quarantined"), name, threshold)


def judged(df: DataFrame, contract: Mapping, record: str = "raw_json") -> DataFrame:
    """Each record with its violations and the verdict ``accepted`` or ``quarantined``, from one pass."""
    verdict = F.when(has_error(), F.lit("quarantined")).otherwise(F.lit("accepted"))
    return with_violations(df, contract, record).withColumn("verdict", verdict)


def quarantine(df: DataFrame, contract: Mapping, record: str = "raw_json") -> tuple[DataFrame, DataFrame]:
    """Records without errors, and records with errors together with their violations.

    Records are read, parsed and written once, partitioned by verdict; both results read their partition.
    """
    rows = judged(df, contract, record)
    path = new_folder(df.sparkSession, "judged")
    rows.write.partitionBy("verdict").parquet(path)
    stored = df.sparkSession.read.schema(rows.schema).parquet(path)
    good = stored.filter("verdict = 'accepted'").drop("verdict", "violations")
    return good, stored.filter("verdict = 'quarantined'").drop("verdict")


# checks -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named aggregate (as an SQL expression) over a table, when it passes and what it says."""

    name: str
    category: str
    measure: str
    passes: Callable[[Column], Column]
    message: Callable[[Column], Column]
    severity: str = "critical"


def _text(c: Column, suffix: str) -> Column:
    return F.concat(c.cast("string"), F.lit(suffix))


def row_count_check(name: str, least: int, note: str, severity: str = "critical") -> Check:
    return Check(
        f"{name} ≥ {least:,}",
        "row_count",
        "count(1)",
        lambda n: n >= least,
        lambda n: F.concat(F.format_number(n, 0), F.lit(f" rows ({note})")),
        severity,
    )


def exists_check(name: str) -> Check:
    return Check(
        f"{name} exists",
        "schema",
        "count(1)",
        lambda n: n.isNotNull(),
        lambda n: F.concat(F.format_number(n, 0), F.lit(" rows")),
    )


def not_null_check(name: str, column: str) -> Check:
    return Check(
        f"{name}.{column} not null",
        "completeness",
        f"count_if({column} IS NULL)",
        lambda n: n == 0,
        lambda n: _text(n, " nulls found"),
    )


def rule_check(name: str, broken: str, message: str, severity: str = "critical") -> Check:
    """``broken`` is the condition of a row that breaks the rule; NULL does not break it."""
    return Check(
        name,
        "business_rule",
        f"count_if({broken})",
        lambda n: n == 0,
        lambda n: _text(n, message),
        severity,
    )


TABLE_RULES = [
    rule_check("No negative points", "points < 0", " teams with negative points"),
    rule_check("Points = W*3 + D", "points != won * 3 + drawn", " teams with inconsistent points"),
    rule_check("Played = W + D + L", "played != won + drawn + lost", " teams with inconsistent game count"),
    rule_check(
        "GD = GF - GA",
        "goal_difference != goals_for - goals_against",
        " teams with inconsistent goal difference",
    ),
]
RESULT_RULES = [
    rule_check("No negative scores", "home_score < 0 or away_score < 0", " matches with negative scores")
]
SCORER_RULES = [rule_check("All scorers have goals > 0", "goals <= 0", " scorers with 0 goals")]


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in one scan."""
    measured = df.agg(*[F.expr(c.measure).alias(f"m{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.name).alias("name"),
            F.lit(c.category).alias("category"),
            c.passes(F.col(f"m{i}")).alias("passed"),
            F.lit(c.severity).alias("severity"),
            c.message(F.col(f"m{i}")).alias("message"),
            F.col(f"m{i}").cast("string").alias("value"),
        )
        for i, c in enumerate(checks)
    ]
    return measured.select(F.explode(F.array(*rows)).alias("_c")).select("_c.*")


def missing_table(df: DataFrame, name: str, reason: str) -> DataFrame:
    """The failed existence check of a table that cannot be read; ``df`` supplies the session only."""
    row = (f"{name} exists", "schema", False, "critical", reason, None)
    schema = "name string, category string, passed boolean, severity string, message string, value string"
    return df.sparkSession.createDataFrame([row], schema)


def unique_check(df: DataFrame, name: str, column: str) -> DataFrame:
    """Distinct against total count. Counted per key first, so a repeated key is combined before the shuffle."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.sum("_n").alias("total"), F.count(column).alias("distinct"))
    return totals.select(
        F.lit(f"{name}.{column} unique").alias("name"),
        F.lit("uniqueness").alias("category"),
        (F.coalesce("total", F.lit(0)) == F.col("distinct")).alias("passed"),
        F.lit("critical").alias("severity"),
        F.concat(
            F.format_number("distinct", 0), F.lit(" distinct / "), F.format_number(F.coalesce("total", F.lit(0)), 0),
            F.lit(" total"),
        ).alias("message"),
        F.concat_ws("/", "distinct", "total").alias("value"),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def reference_check(
    df: DataFrame,
    column: str,
    parents: DataFrame,
    parent_column: str,
    name: str,
    severity: str = "warning",
    message: str = " orphan teams in results",
) -> DataFrame:
    """Number of distinct values without a parent row."""
    children = df.select(F.col(column).alias(parent_column)).distinct()
    orphans = absent(children, parents, [parent_column]).agg(F.count(F.lit(1)).alias("n"))
    return orphans.select(
        F.lit(name).alias("name"),
        F.lit("referential").alias("category"),
        (F.col("n") == 0).alias("passed"),
        F.lit(severity).alias("severity"),
        _text(F.col("n"), message).alias("message"),
        F.col("n").cast("string").alias("value"),
    )


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def report_summary(checks: DataFrame) -> DataFrame:
    """Totals and the gate: passed unless a critical check failed."""
    failed = F.count_if(~F.col("passed") & (F.col("severity") == "critical"))
    return checks.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("passed").alias("passed"),
        failed.alias("failed"),
        F.count_if(~F.col("passed") & (F.col("severity") == "warning")).alias("warnings"),
        (failed == 0).alias("gate_open"),
    )


def status_totals(tests: DataFrame, status: str = "status") -> DataFrame:
    s = F.col(status)
    return tests.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "pass").alias("passed"),
        F.count_if(s == "fail").alias("failed"),
        F.count_if(s == "warn").alias("warned"),
    )


# inventory and freshness ------------------------------------------------------------------------------------------


def inventory(tables: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """Rows and columns per table: ``{"matches": ("raw", df)}``."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(schema).alias("schema"),
                F.lit(name).alias("table"),
                "row_count",
                F.lit(len(df.columns)).cast("long").alias("column_count"),
                C.layer(F.lit(schema)).alias("layer"),
            )
            for name, (schema, df) in tables.items()
        ],
    )


def layer_totals(tables: DataFrame) -> DataFrame:
    return tables.groupBy("layer").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("total_rows")
    )


def freshness(
    df: DataFrame, name: str, time: str, as_of: Column, warn_hours: float, error_hours: float
) -> DataFrame:
    """Age in hours of the newest row and its class; an empty table is an error."""
    hours = (as_of.cast("timestamp").cast("double") - F.col("last_updated").cast("timestamp").cast("double")) / 3600
    return df.agg(F.max(time).alias("last_updated")).select(
        F.lit(name).alias("table"),
        "last_updated",
        C.round_to(hours, 2).alias("hours_ago"),
        C.choose((hours <= warn_hours, "pass"), (hours <= error_hours, "warn"), default="error").alias("status"),
    )


def live_monitor(
    state: DataFrame, as_of: Column, time: str = "ingested_at", labels=tuple(values.FRESHNESS_LABELS)
) -> DataFrame:
    """Active matches, newest ingest, age in whole minutes and service-level label."""
    minutes = F.col("freshness_minutes")
    return (
        state.agg(F.count(F.lit(1)).alias("active_match_count"), F.max(time).alias("last_ingested_at"))
        .withColumn("freshness_minutes", C.minutes_since("last_ingested_at", as_of))
        .withColumn("freshness_status", C.below(minutes, labels, values.STALE_LABEL, inclusive=True))
        .withColumn("computed_at", as_of)
    )


def recent_rows(tables: Mapping[str, DataFrame], as_of: Column, hours: int = 2, time: str = "ingested_at") -> DataFrame:
    """Rows ingested in the last hours per table; none is a warning, not a failure."""
    since = as_of - F.make_dt_interval(F.lit(0), F.lit(hours))
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count_if(F.col(time) >= since).alias("recent_rows")).select(
                F.lit(name).alias("table"),
                "recent_rows",
                F.when(F.col("recent_rows") > 0, "success").otherwise("warn").alias("status"),
            )
            for name, df in tables.items()
        ],
    )


def active_matchday(state: DataFrame, as_of: Column, time: str = "utc_date", days: int = 1) -> DataFrame:
    """One row: is any match within ``days`` days of the as-of date?"""
    near = F.to_date(time).between(F.date_sub(as_of, days), F.date_add(as_of, days))
    return state.agg(F.count_if(near).alias("matches_near")).withColumn("is_matchday", F.col("matches_near") > 0)
