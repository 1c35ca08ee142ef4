"""Benchmark passages in documents, by winnowed fingerprints and extension of the hits; native expressions only.

The least ``gram``-word hash of every window of ``window`` words is kept with its
position, for test items and documents alike, so that a shared window always shares
a fingerprint inside it. Hits are extended where they stand: of the document only the
windows that hold the hit are compared, word for word, with the items' windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, fresh, with_rows

#: Words are runs of other characters than these, after A-Z are lower-cased.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Test windows up to this many, of so many bytes, are sent to every executor; more are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def words(text: Column) -> Column:
    """Words of a text as an array; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAK)
    return F.filter(parts, lambda w: w != "")


def _steps(n: Column, width: int) -> Column:
    """1 to n - width + 1, or none."""
    return F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))


#: A fingerprint is a number of 33 bits of hash above 31 bits of position, so that the least of a window says where it stands.
PLACE_BITS = 31


def _packed(w: Column, size: int, i: Column, *seed: Column) -> Column:
    return F.shiftleft(F.xxhash64(*seed, *(F.element_at(w, i + j) for j in range(size))), PLACE_BITS).bitwiseOR(i.cast("long"))


def fingerprints(w: Column, n: Column, gram: int, window: int) -> tuple[Column, Column]:
    """(all runs of ``gram`` words, the distinct least ones of all windows from a column ``grams``); ``w`` has ``n`` words."""
    each = F.transform(_steps(n, gram), lambda i: _packed(w, gram, i))
    width = window - gram + 1
    least = F.transform(_steps(n, window), lambda i: F.array_min(F.slice(F.col("grams"), i, F.lit(width))))
    return each, F.array_distinct(least)


def whole_runs(w: Column, n: Column, size: int) -> Column:
    """All runs of ``size`` words, which short items are looked up by."""
    return F.transform(_steps(n, size), lambda i: _packed(w, size, i, F.lit(size)))


def runs_of(w: Column, n: Column, size: int) -> Column:
    """All runs of ``size`` words, joined by spaces."""
    return F.transform(_steps(n, size), lambda i: F.array_join(F.slice(w, i, F.lit(size)), " "))


def _joined(small: DataFrame, rows: int, size: int = 0) -> DataFrame:
    return F.broadcast(small) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else small.hint("merge")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """What each of ``docs`` (doc_id long, text) shares with ``items`` (item_id, text); more columns are ignored.

    An item's windows are its runs of ``window`` words; an item of fewer words, but
    not none, is one window. A document word inside any occurrence of a window is
    hit. Returns a row for each row: doc_id, n_words, n_hit, n_items (items with
    occurring windows), items_sha256 (of their ids, sorted as strings, joined by
    commas), contaminated. Null and empty texts have no words. Rows of null or
    repeated doc_id are documents of their own; rows of one item_id are one item,
    and those without are the item of the empty id; items with equal windows all
    count; empty tables give an empty result or no hits.
    """
    ws = Workspace(docs.sparkSession, "decontaminate")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plain, _ = with_rows(ws, plain, "doc_id")
    counts = plain.select("_row", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = counts.join(_hits(ws, plain, items, window, gram), "_row", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean_rows(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """Those rows of ``docs``, with all columns, that share no window with ``items``."""
    ws = Workspace(docs.sparkSession, "decontaminate")
    row = fresh(docs, "_number")
    numbered, _ = with_rows(ws, docs, "doc_id", row)
    plain = numbered.select(F.col(row).alias("_row"), F.col("text").cast("string").alias("text"))
    # Written, so that a small table of hits is sent to the texts, and not the texts to it.
    hit = ws.table(_hits(ws, plain, items, window, gram).select(F.col("_row").alias(row)), "hit")
    return numbered.join(hit, row, "left_anti").select(*docs.columns)


def _hits(ws: Workspace, plain: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    """(_row unique, text) -> _row, n_hit, n_items, ids of the documents that are hit."""
    item = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text").cast("string")).alias("w"))
    item = ws.table(item.withColumn("n", F.size("w")).where("n > 0"), "items")
    short, long = item.where(F.col("n") < window), item.where(F.col("n") >= window)
    runs = short.select("item", F.array_join("w", " ").alias("run"), F.col("n").alias("size"))
    runs = runs.unionByName(long.select("item", F.explode(runs_of(F.col("w"), F.col("n"), window)).alias("run"), F.lit(window).alias("size")))
    runs = ws.table(runs.distinct(), "windows")
    # Equal windows of several items are one, so that what a passage has in common with many of them is one hit at each place.
    kinds = ws.table(runs.select("size", "run").distinct().withColumn("window", F.monotonically_increasing_id()), "kinds")
    owners = ws.table(runs.join(kinds, ["size", "run"]).select("window", "item"), "owners")
    sizes = {r["size"]: (r["n"], r["bytes"]) for r in kinds.groupBy("size").agg(F.count("*").alias("n"), F.sum(F.octet_length("run")).alias("bytes")).collect()}  # at most ``window`` lines
    rows, heavy, brief = sum(n for n, _ in sizes.values()), sum(b for _, b in sizes.values()), sorted(s for s in sizes if s < window)

    doc = plain.select("_row", words(F.col("text")).alias("w")).withColumn("n", F.size("w"))
    w, n = F.col("w"), F.col("n")
    grams, least = fingerprints(w, n, gram, window)
    print_of, place_of = F.shiftrightunsigned("packed", PLACE_BITS), F.col("packed").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")

    def prints(df: DataFrame, *keep: str, full: bool, shorter: list[int]) -> DataFrame:
        """One pass: the winnowed prints and, as a run shorter than the window has no winnowing guarantee, all of each shorter size."""
        parts = [*([least] if full else []), *(whole_runs(w, n, s) for s in shorter)]
        each = F.explode(F.concat(*parts) if parts else F.array().cast("array<long>")).alias("packed")
        return df.withColumn("grams", grams).select(*keep, each).select(*keep, print_of.alias("print"), place_of.alias("at"))

    tests = prints(long, full=True, shorter=[]).select("print", F.lit(window).alias("size"))
    for size in brief:
        tests = tests.unionByName(prints(short.where(n == size), full=False, shorter=[size]).select("print", F.lit(size).alias("size")))
    found = prints(doc, "_row", "n", full=window in sizes, shorter=brief).join(_joined(tests.distinct(), rows), "print")
    # The windows that hold the hit; a run of a short item is its own window.
    first = F.when(F.col("size") == window, F.greatest(F.lit(1), F.col("at") - (window - gram))).otherwise(F.col("at"))
    last = F.when(F.col("size") == window, F.least(F.col("at"), n - window + 1)).otherwise(F.col("at"))
    starts = found.select("_row", "size", F.explode(F.sequence(first, last)).alias("at"))
    starts = ws.table(starts.groupBy("_row").agg(F.collect_set(F.struct("size", "at")).alias("starts")), "starts")
    # The texts are shuffled at any size of the table.
    near = ws.table(plain.join(starts.hint("merge"), "_row").select("_row", words(F.col("text")).alias("w"), "starts"), "candidates")
    each = F.explode(F.transform("starts", lambda s: F.struct(s["size"].alias("size"), s["at"].alias("at"), F.array_join(F.slice(w, s["at"], s["size"]), " ").alias("run")))).alias("s")
    spots = near.select("_row", each).select("_row", "s.*").join(_joined(kinds, rows, heavy), ["size", "run"]).select("_row", "at", "size", "window")
    spots = ws.table(spots, "spots")
    reach = spots.groupBy("_row", "at").agg(F.max("size").alias("size"))
    spans = F.array_sort(F.collect_list(F.struct("at", (F.col("at") + F.col("size")).alias("end"))))
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end"))
    union = F.aggregate(
        spans,
        start,
        lambda s, x: F.struct((s["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["at"]))).cast("long").alias("hit"), F.greatest(s["end"], x["end"]).alias("end")),
        lambda s: s["hit"],
    )
    covered = reach.groupBy("_row").agg(union.alias("n_hit"))
    named = spots.select("_row", "window").distinct().join(owners, "window").select("_row", "item").distinct().groupBy("_row").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("ids"))
    return covered.join(named, "_row")
