"""URL filters: dated list entries become validity intervals, and captures are judged by what was listed when they were fetched.

An entry adds a pattern (a host or a parent domain) to a list, or removes it, from its date on. The entries of a list and
pattern, in order of date, become intervals [since, until) in which the pattern is listed. A capture asks for its host and
all parent domains; the as-of join is an equality on the pattern with the interval as a further condition, so a
capture meets one interval of a list and pattern at most. Many captures share a host and a time: they are asked once.

Defined cases: of entries of one list, pattern and date, a removal counts before an addition; an entry without
list, pattern, date or action is ignored, as is a repeated one; a null url has the empty host, which matches nothing; a
capture without a time matches nothing; repeated captures are answered each; without entries nothing is listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.llm.common import null_safe

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def patterns(name: Column) -> Column:
    """The host and its parent domains down to two labels; a single label is itself."""
    labels = F.split(name, r"\.")
    count = F.greatest(F.size(labels) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, since, until) from (list, pattern, dated, action), the action being add or remove."""
    known = entries.where("list IS NOT NULL AND pattern IS NOT NULL AND dated IS NOT NULL AND action IN ('add', 'remove')")
    one = known.groupBy("list", "pattern", "dated").agg(F.max("action").alias("action"))  # remove comes after add
    each = Window.partitionBy("list", "pattern").orderBy("dated")
    until = F.lead("dated").over(each)
    return one.withColumn("until", until).where("action = 'add'").select("list", "pattern", F.col("dated").alias("since"), "until")


def listed(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """All columns of the captures, the host, and ``listings``: (list, pattern) active when each was fetched, sorted."""
    rows = captures.withColumn("host", host(captures[url]))
    asked = rows.select("host", F.col(fetched).alias("at")).distinct()
    wanted = asked.select("host", "at", F.explode(patterns(F.col("host"))).alias("pattern"))
    active = F.col("since").isNotNull() & (F.col("at") >= F.col("since")) & (F.col("until").isNull() | (F.col("at") < F.col("until")))
    met = wanted.join(intervals(entries), "pattern").where(active)
    answer = met.groupBy("host", "at").agg(F.array_sort(F.collect_set(F.struct("list", "pattern"))).alias("listings"))
    none = F.array().cast("array<struct<list:string,pattern:string>>")
    answered = null_safe(rows, answer.withColumnRenamed("at", fetched), ["host", fetched])
    return answered.withColumn("listings", F.coalesce("listings", none))


def decided(rows: DataFrame, blocking: str = "block", allowing: str = "allow") -> DataFrame:
    """Adds ``blocked``: some pattern is on the blocking list and none on the allowing one."""
    on = lambda name: F.exists("listings", lambda x: x["list"] == name)
    return rows.withColumn("blocked", on(blocking) & ~on(allowing))
