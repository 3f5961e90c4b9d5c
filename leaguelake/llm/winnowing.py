"""Benchmark decontamination by winnowing, in DataFrame functions alone.

The least of every six consecutive 5-gram hashes is kept on both sides, so that any ten words which a document and an
item share leave the same fingerprint. Documents with a fingerprint of some item are read again; every place where one of their
5-grams meets an item's fingerprint names an alignment of the two, and along it equal words are sought to both ends: a
run of ten (of the whole item, if it is shorter) is an occurrence. Items of fewer than ten words have no such guarantee
and are sought by the hash of all their words.

Defined cases: null text has no words; an item without words is never found; a null item id counts as the empty string, rows
of equal item id count as one item; a null document id is kept, and repeated rows get the same result each; an empty
benchmark finds nothing. Only the named columns are used, whatever the others are called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import null_safe
from leaguelake.session import stored

WINDOW = 10
GRAM = 5
KEY = ["doc_id", "text_hash"]


def words(text: Column) -> Column:
    """Lower-case words of digits, letters a-z and everything beyond ASCII."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = F.split(F.coalesce(lower, F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def starts(size: Column, n: int) -> Column:
    """0, 1, ... for each window of n entries; empty if there are fewer."""
    return F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))


def with_grams(rows: DataFrame, n: int) -> DataFrame:
    """Adds ``grams``, a hash of each n consecutive entries of ``hashes``."""
    return rows.withColumn("grams", F.transform(starts(F.size("hashes"), n), lambda i: gram_at("hashes", i, n)))


def gram_at(hashes: str, at: Column, n: int) -> Column:
    return F.xxhash64(*(F.get(hashes, at + k) for k in range(n)))


def with_least(rows: DataFrame, n: int) -> DataFrame:
    """Adds ``least``, the distinct minima of n consecutive ``grams``."""
    minima = F.transform(
        starts(F.size("grams"), n), lambda i: F.least(*(F.get("grams", i + k) for k in range(n)))
    )
    return rows.withColumn("least", F.array_distinct(minima))


def hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def items_of(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    name = F.coalesce(benchmark[item_id].cast("string"), F.lit(""))
    rows = benchmark.select(name.alias("item"), benchmark[text].cast("string").alias("text")).distinct()
    items = rows.select("item", words(F.col("text")).alias("item_words"))
    items = items.withColumn("span", F.least(F.lit(window), F.size("item_words"))).where("span > 0")
    return items.withColumn("item_key", F.xxhash64("item", "item_words"))


def fingerprints(items: DataFrame, window: int, gram: int) -> DataFrame:
    """(print, item_key, at): winnowed 5-grams of the items and where they stand."""
    rows = items.where(F.col("span") == window).select("item_key", F.col("item_words").alias("words"))
    rows = with_least(with_grams(hashed(rows), gram), window - gram + 1)
    each = rows.select("item_key", "least", F.posexplode("grams").alias("at", "print"))
    return each.where(F.array_contains("least", F.col("print"))).select("print", "item_key", "at")


def documents_of(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    value = documents[text].cast("string")
    return documents.select(documents[doc_id].cast("long").alias("doc_id"), F.xxhash64(value).alias("text_hash"), value.alias("text"))


def alignments(
    docs: DataFrame, items: DataFrame, window: int, gram: int
) -> tuple[DataFrame, DataFrame]:
    """Per distinct document (key, n_words), and (key, item_key, shift) for each alignment to look along."""
    prints = fingerprints(items, window, gram)
    read = docs.withColumn("words", words(F.col("text"))).drop("text")
    sized = hashed(read).select(*KEY, F.size("words").alias("n_words"), "hashes")
    kept = with_least(with_grams(sized, gram), window - gram + 1)
    probes = kept.select(*KEY, "n_words", F.explode_outer("least").alias("print"))
    known = prints.select("print", F.lit(True).alias("known")).distinct()
    met = probes.join(known, "print", "left").groupBy(*KEY).agg(
        F.max("n_words").alias("n_words"), F.coalesce(F.max("known"), F.lit(False)).alias("met")
    )
    met = stored(met, "winnowed-documents")
    again = null_safe(docs, met.where("met").select(*KEY), KEY, "left_semi").dropDuplicates(KEY)
    grams = with_grams(hashed(again.select(*KEY, words(F.col("text")).alias("words"))), gram)
    places = grams.select(*KEY, F.posexplode("grams").alias("place", "print"))
    found = places.join(prints, "print").select(*KEY, "item_key", (F.col("place") - F.col("at")).alias("shift"))
    spans = sorted(r.span for r in items.where(F.col("span") < window).select("span").distinct().collect())
    if spans:  # one more pass over the documents for all short items
        whole = [
            with_grams(hashed(items.where(F.col("span") == n).select("item_key", F.col("item_words").alias("words"))), n)
            .select("item_key", F.explode("grams").alias("print"))
            for n in spans
        ]
        read = hashed(docs.select(*KEY, words(F.col("text")).alias("words"))).drop("words")

        def windows(n: int) -> Column:
            return F.transform(starts(F.size("hashes"), n), lambda i: F.struct(i.alias("shift"), gram_at("hashes", i, n).alias("print")))

        each = F.concat(*map(windows, spans))
        hits = read.select(*KEY, F.explode(each).alias("hit")).select(*KEY, "hit.*").join(reduce(DataFrame.unionByName, whole), "print")
        found = found.unionByName(hits.select(*KEY, "item_key", "shift"))
    return met.select(*KEY, "n_words"), stored(found.distinct(), "alignments")


def runs_along(shift: Column) -> Column:
    """Along one alignment of ``words`` with ``item_words``: the longest runs of equal words, as (begin, end) in the document, that
    have a span."""
    begin, skip = F.greatest(shift, F.lit(0)), F.greatest(-shift, F.lit(0))
    size = F.greatest(F.least(F.size("words") - begin, F.size("item_words") - skip), F.lit(0))
    same = F.zip_with(F.slice("words", begin + 1, size), F.slice("item_words", skip + 1, size), lambda a, b: F.coalesce(a == b, F.lit(False)))

    def runs(x: Column) -> Column:
        every = F.when(F.size(x) > 0, F.sequence(F.lit(0), F.size(x) - 1)).otherwise(F.array().cast("array<int>"))
        differs = lambda i: ~F.coalesce(F.get(x, i), F.lit(False))
        first = F.filter(every, lambda i: F.get(x, i) & differs(i - 1))
        last = F.filter(every, lambda i: F.get(x, i) & differs(i + 1))
        return F.zip_with(first, last, lambda a, b: F.struct((begin + a).alias("begin"), (begin + b + 1).alias("end")))

    found = F.flatten(F.transform(F.array(same), runs))
    return F.filter(found, lambda r: r["end"] - r["begin"] >= F.col("span"))


def occurrences(docs: DataFrame, items: DataFrame, found: DataFrame) -> DataFrame:
    """(key, item, runs): the words of a document inside windows of an item. Words are joined once to each (document, item), whatever
    the number of its alignments."""
    texts = null_safe(docs, found.select(*KEY).distinct(), KEY, "left_semi").dropDuplicates(KEY)
    read = texts.select(*KEY, words(F.col("text")).alias("words"))
    grouped = found.groupBy(*KEY, "item_key").agg(F.collect_set("shift").alias("shifts"))  # fewer than words on both sides
    both = null_safe(grouped, read, KEY, "inner").join(items, "item_key")
    out = both.select(*KEY, "item", F.flatten(F.transform("shifts", runs_along)).alias("runs"))
    return out.where("size(runs) > 0")


def covered(runs: Column) -> Column:
    """How many places lie in any of the runs."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("until"))

    def add(state: Column, r: Column) -> Column:
        more = F.greatest(F.lit(0), r["end"] - F.greatest(r["begin"], state["until"]))
        return F.struct((state["n"] + more).alias("n"), F.greatest(state["until"], r["end"]).alias("until"))

    return F.aggregate(F.array_sort(runs), start, add)["n"]


def contamination(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """One row per document: (doc_id, text_hash, n_words, n_hit, items)."""
    docs = documents_of(documents, doc_id, text)
    items = items_of(benchmark, item_id, item_text, window)
    sizes, found = alignments(docs, items, window, gram)
    hits = occurrences(docs, items, found)
    named = hits.groupBy(*KEY).agg(
        F.array_sort(F.collect_set("item")).alias("items"), covered(F.flatten(F.collect_list("runs"))).alias("n_hit")
    )
    result = null_safe(sizes, named, KEY)
    out = null_safe(docs.select(*KEY), result, KEY)
    return out.select(
        *KEY,
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
