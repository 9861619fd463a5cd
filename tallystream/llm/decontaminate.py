"""Benchmark decontamination: windows of benchmark words looked for in documents.

A benchmark item's windows are its runs of ten words; an item with fewer words is one window. The
windows' hashes, bounded in number, form a set that goes with the plan to every task; a document's
windows are hashed in its own row and looked up there, so texts are neither moved nor unfolded.
What the set lets through is verified word for word against a broadcast table of the windows.
Beyond the bound every document window is joined to that table instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallystream.operators.joins import lookup_join
from tallystream.session import settle

SPAN = 10
#: Window hashes that may travel in a plan.
SET_LIMIT = 200_000
#: Letters, digits and everything beyond ASCII; upper case only where texts keep theirs.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
ANY_CASE_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def _hashes(of: Column) -> Column:
    return F.transform(of, lambda w: F.xxhash64(w))


def _starts(n: Column, span) -> Column:
    """0 .. n - span; none where n < span."""
    return F.when(n >= span, F.sequence(F.lit(0), (n - span).cast("int"))).otherwise(F.array().cast("array<int>"))


def _window_hash(hashes: Column, at: Column, span) -> Column:
    return F.xxhash64(F.slice(hashes, at + F.lit(1), span))


def _window_text(of: Column, at: Column, span) -> Column:
    return F.array_join(F.slice(of, at + F.lit(1), span), " ")


def benchmark_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per distinct window: span, window, hash, items (ids as sorted strings)."""
    split = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    split = split.where(F.size("w") > 0).withColumn("h", _hashes(F.col("w")))
    split = split.withColumn("span", F.least(F.size("w"), F.lit(span)))
    each = split.withColumn("at", F.explode(_starts(F.size("w"), F.col("span"))))
    return (
        each.groupBy(
            "span",
            _window_text(F.col("w"), F.col("at"), F.col("span")).alias("window"),
            _window_hash(F.col("h"), F.col("at"), F.col("span")).alias("hash"),
        )
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def _hits(windows: DataFrame, spans: list[int], set_limit: int) -> Column:
    """Expression for a document's window starts that may be hits: array of (at, span, window)."""
    known: dict[int, list[int]] = {s: [] for s in spans}
    inline = windows.count() <= set_limit
    if inline:
        for row in windows.select("span", "hash").distinct().collect():
            known[row.span].append(row.hash)

    def of(span: int) -> Column:
        starts = _starts(F.size("w"), F.lit(span))
        if inline:
            starts = F.filter(starts, lambda at: _window_hash(F.col("h"), at, F.lit(span)).isin(known[span]))
        return F.transform(
            starts,
            lambda at: F.struct(
                at.alias("at"), F.lit(span).alias("span"), _window_text(F.col("w"), at, F.lit(span)).alias("window")
            ),
        )

    return F.concat(*[of(s) for s in spans])


def contamination(
    documents: DataFrame, benchmark: DataFrame, span: int = SPAN, set_limit: int = SET_LIMIT
) -> DataFrame:
    """One row per document row: doc_id, text_key, n_words, spans, n_hit, items, contaminated.

    ``spans`` are the (at, span) of occurring windows, ``items`` the sorted ids, as strings, of
    benchmark items they come from. Null and empty texts have no words and no hits, an item
    without words has no window, an empty benchmark contaminates nothing. Repeated rows are
    judged each for itself. Only doc_id and text, item_id and text are read; a null item id
    counts as no item.
    """
    windows = settle(benchmark_windows(benchmark, span))
    spans = sorted(r.span for r in windows.select("span").distinct().collect())
    rows = documents.select(
        F.monotonically_increasing_id().alias("at_row"),
        F.col("doc_id"),
        F.xxhash64("text").alias("text_key"),
        words(F.col("text")).alias("w"),
    )
    rows = rows.withColumn("h", _hashes(F.col("w")))
    if not spans:
        return rows.select(
            "doc_id",
            "text_key",
            F.size("w").cast("long").alias("n_words"),
            F.array().cast("array<struct<at:int,span:int>>").alias("spans"),
            F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<string>").alias("items"),
            F.lit(False).alias("contaminated"),
        )
    found = rows.select(
        "at_row",
        "doc_id",
        "text_key",
        F.size("w").alias("n_words"),
        F.explode_outer(_hits(windows, spans, set_limit)).alias("hit"),
    ).select("at_row", "doc_id", "text_key", "n_words", "hit.at", "hit.span", "hit.window")
    verified = lookup_join(found, windows.select("span", "window", "items"), ["span", "window"])
    hit = F.when(F.col("items").isNotNull(), F.struct("at", "span"))
    per_row = verified.groupBy("at_row", "doc_id", "text_key", "n_words").agg(
        F.array_sort(F.collect_set(hit)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["span"] - 1)))
    return per_row.select(
        "doc_id",
        "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        "spans",
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        "items",
        (F.size("spans") > 0).alias("contaminated"),
    )


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"),
        F.xxhash64("text").alias("text_key"),
    )


def _contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key")
    found = contamination(documents, benchmark).where("contaminated")
    return settle(found.groupBy(key, "text_key").agg(F.first("spans").alias("spans")))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any benchmark window, with all their columns."""
    found = _contaminated(documents, benchmark).select("key", "text_key")
    return lookup_join(_keyed(documents), found, ["key", "text_key"], "left_anti").select("whole.*")


def cut_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents; words inside benchmark windows are cut out of their texts, what stands
    between words stays."""
    joined = lookup_join(_keyed(documents), _contaminated(documents, benchmark), ["key", "text_key"])
    text = F.col("whole.text")
    kept, gaps = F.regexp_extract_all(text, F.lit(ANY_CASE_WORD), F.lit(0)), F.split(text, ANY_CASE_WORD)
    inside = lambda i: F.exists("spans", lambda s: (i >= s["at"]) & (i < s["at"] + s["span"]))
    words_left = F.transform(kept, lambda w, i: F.concat(gaps[i], F.when(inside(i), F.lit("")).otherwise(w)))
    cut = F.concat(F.array_join(words_left, ""), F.element_at(gaps, -1))
    whole = F.col("whole").withField("text", F.when(F.col("spans").isNull(), text).otherwise(cut))
    return joined.select(whole.alias("whole")).select("whole.*")
