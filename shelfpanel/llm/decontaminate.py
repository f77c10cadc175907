"""Benchmark decontamination by n-grams of words.

Words are runs of ASCII letters and digits (A-Z folded) and of all characters beyond ASCII. The windows of
the benchmark's items are a hash set that is broadcast; each document's word windows are scanned against it
in one pass, and every hit is verified word by word before it counts. The scan keeps the words of a document
beside its window numbers inside one task, so that only one row per document and task is shuffled.

The broadcast holds distinct windows without their items and is bounded: beyond ``BLOCK`` windows the same join is shuffled, so that
documents are read once however large the benchmark is. Items come in at the end, by a join with the windows that a document holds.

Defined cases: null and empty texts have no words and no hits; an item of fewer words than ``size`` is one
window, an item without words none; windows shared by items count for each; items without an id contaminate
but are not listed; repeated rows (same id and text) are one document; an empty benchmark or table works.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.llm.common import ascii_lower, stored

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK = 200_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def benchmark_windows(benchmark: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of each item: ``item``, ``length``, ``window`` (words), ``code`` (hash) and ``key`` (digest)."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), words_of(F.col(f"`{text_col}`")).alias("all"))
    return (
        items.where(F.size("all") > 0)
        .withColumn("length", F.least(F.size("all"), F.lit(size)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.size("all") - F.col("length") + 1)))
        .select("item", "length", F.expr("slice(all, start, length)").alias("window"))
        .distinct()
        .withColumn("code", F.xxhash64("window"))
        .withColumn("key", F.md5(F.array_join("window", " ")))  # no word holds a blank
    )


def hit_words(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``text_code``, ``n_words``, ``hits`` (first word, words), ``n_hit`` and ``keys`` of the windows."""
    own = windows.select("length", "window", "code", "key").distinct()
    counts = own.groupBy("length").count().collect()  # a row for each length up to that of a window
    lengths = sorted(r["length"] for r in counts) or [1]
    own = own.select("window", "code", "key")
    if sum(r["count"] for r in counts) <= BLOCK:
        own = F.broadcast(own)
    starts = (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
        .select("id", F.xxhash64("text").alias("text_code"), words_of(F.col("text")).alias("words"))
        .withColumn("n_words", F.size("words"))
        .withColumn("length", F.explode(F.array(*[F.lit(k) for k in lengths])))
        # 0 stands for the document itself, so that one without hits has a row as well
        .withColumn("start", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("n_words") - F.col("length") + 1))))
        .withColumn("taken", F.expr("if(start > 0, slice(words, start, length), null)"))
        # the rows of start 0 match nothing; their codes differ, so that a shuffled join deals them evenly
        .withColumn("taken_code", F.expr("if(start > 0, xxhash64(taken), xxhash64(id, text_code))"))
        .drop("words")
    )
    same = (F.col("taken_code") == F.col("code")) & (F.col("taken") == F.col("window"))
    grouped = (
        starts.join(own, same, "left")
        .where((F.col("start") == 0) | F.col("key").isNotNull())
        .groupBy("id", "text_code")
        .agg(
            F.max("n_words").alias("n_words"),
            F.collect_set(F.when(F.col("start") > 0, F.struct("start", "length"))).alias("hits"),
            F.collect_set("key").alias("keys"),
        )
    )
    covered = F.expr(
        """aggregate(array_sort(hits), named_struct('upto', 0L, 'n', 0L),
           (a, h) -> named_struct(
             'upto', greatest(a.upto, bigint(h.start + h.length)),
             'n', a.n + greatest(0L, h.start + h.length - greatest(a.upto, bigint(h.start)))),
           a -> a.n)"""
    )
    return grouped.select(
        "id", "text_code", F.col("n_words").cast("long"), F.array_sort("hits").alias("hits"), covered.alias("n_hit"), "keys"
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``text_code``, ``n_words``, ``hits`` (first word, words), ``n_hit`` and ``items``."""
    windows = benchmark_windows(benchmark, size, item_col, item_text_col)
    found = stored(hit_words(docs, windows, id_col, text_col))
    held = found.where("n_hit > 0").select("id", "text_code", F.explode("keys").alias("key"))
    items = (
        held.join(windows.select("key", "item"), "key")
        .groupBy(F.col("id").alias("own_id"), F.col("text_code").alias("own_code")).agg(F.collect_set("item").alias("items"))
    )
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_code") == F.col("own_code"))
    return found.join(items, same, "left").select(
        F.col("id").alias(id_col), "text_code", "n_words", "hits", "n_hit",
        F.array_sort(F.coalesce("items", F.array().cast("array<string>"))).alias("items"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold a benchmark window; all columns stay as they are."""
    bad = hit_words(docs, benchmark_windows(benchmark, size), id_col, text_col).where("n_hit > 0")
    same = docs[f"`{id_col}`"].eqNullSafe(bad["id"]) & (F.xxhash64(docs[f"`{text_col}`"]) == bad["text_code"])
    return docs.join(bad, same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the hit words taken out of their texts; the blanks and marks between words stay."""
    hit = hit_words(docs, benchmark_windows(benchmark, size), id_col, text_col).where("n_hit > 0")
    hit = hit.select("id", F.col("text_code").alias("code"), "hits")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # so that no name of theirs can clash
    text = F.col("row")[text_col]
    same = F.col("row")[id_col].eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("code"))
    rest = F.zip_with(
        F.split(text, WORD),
        F.transform(
            F.regexp_extract_all(text, F.lit(f"({WORD})"), 1),
            lambda w, i: F.when(
                F.exists("hits", lambda h: (h["start"] <= i + 1) & (i + 1 < h["start"] + h["length"])), F.lit("")
            ).otherwise(w),
        ),
        lambda gap, word: F.concat(gap, F.coalesce(word, F.lit(""))),
    )
    cleaned = F.when(F.col("hits").isNull(), text).otherwise(F.array_join(rest, ""))
    joined = rows.join(hit, same, "left")
    return joined.select(*[cleaned.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
