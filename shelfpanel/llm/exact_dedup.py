"""Exact de-duplication by a sort of the content.

Texts are compared with A-Z in lower case; null counts as empty. Sampled splitters deal the rows out
by ranges of (first bytes, digest); inside a range Spark's external sort brings equal texts together,
and each row is compared in full with its neighbours. The splitters hold a bounded prefix and a digest,
never a whole text, so that the driver's sample stays small whatever the texts' length.

A text that has more than ``1/SHARES`` of all rows is split by a salt into runs of about that share:
the runs meet again by their SHA-256 digest, from counts made before the shuffle. There are fewer than
``SHARES`` such texts, which bounds the broadcast.

Defined cases: empty and null texts are one group; a row with a null id counts in its group and stays
only where no row of it has an id; of repeated rows (same id, same text) one stays; an empty table gives
an empty result; other columns are carried along untouched, whatever their names.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpanel.llm.common import ascii_lower

SHARES = 4096
LEAST_RUN = 256
PREFIX = 16


def _compared(docs: DataFrame, id_col: str, text_col: str, keep: str) -> DataFrame:
    """All rows as ``row``, with ``id``, ``digest``, ``keep_id``, ``group_size`` and ``kept``."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    best = F.min if keep == "smallest" else F.max
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    ident, text = F.col("row").getField(id_col), F.coalesce(F.col("row").getField(text_col), F.lit(""))
    norm = ascii_lower(text)
    run = max(docs.count() / SHARES, LEAST_RUN)
    hot = (
        rows.groupBy(F.sha2(norm, 256).alias("hot_digest"))
        .agg(F.count("*").alias("hot_size"), best(ident).alias("hot_keep"))
        .where(F.col("hot_size") > run)
        .withColumn("salts", F.ceil(F.col("hot_size") / run))
    )
    dealt = (
        rows.withColumn("norm", norm)
        .select("row", F.substring("norm", 1, PREFIX).alias("prefix"), F.sha2("norm", 256).alias("digest"))
        .join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left")
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64(ident), F.col("salts")), F.lit(0)))
        .drop("hot_digest", "salts")
        .repartitionByRange("prefix", "digest", "salt")
        .withColumn("norm", norm)
        .withColumn("id", ident)
    )
    order = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    equal = Window.partitionBy("prefix", "digest", "salt", "norm")
    return (
        dealt.withColumn("place", F.row_number().over(equal.orderBy(order)))
        .withColumn("run_keep", best("id").over(equal))
        .withColumn("run_size", F.count("*").over(equal))
        .withColumn("keep_id", F.when(F.col("hot_size").isNull(), F.col("run_keep")).otherwise(F.col("hot_keep")))
        .withColumn("group_size", F.coalesce("hot_size", "run_size"))
        .withColumn("kept", (F.col("place") == 1) & F.col("run_keep").eqNullSafe(F.col("keep_id")))
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (normalised text)."""
    needed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return _compared(needed, "id", "text", keep).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows that stay, with all their columns."""
    return _compared(docs, id_col, text_col, keep).where("kept").select("row.*")
