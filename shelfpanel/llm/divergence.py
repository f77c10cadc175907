"""How the sources of each language differ in their words, by an Arrow pipeline over whole texts.

1. Inside ``mapInArrow``, ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and hash ``group_by`` count the terms of each
   (language, source), and the documents that hold each. A task hands on merged counts; Spark adds them up before and after its shuffle.
2. Terms in at least ``least`` documents of their language are kept. ``p`` is the smoothed share of a term in its group in billionths, rounded up.
3. The counts are dealt into columnar shards of about ``SHARD`` cells (terms of one language by the hash of the term, times its sources);
   each shard gives the sum of ``|p - q|`` for its pairs of sources, and Spark adds the shards. Within a task no array is larger than a
   shard, whatever the size of the corpus or of one source.

All numbers are whole: shares are divided as decimals of 38 digits.

Defined cases: a null text, language or source counts as empty text; a row counts as a document, repeated rows as several; a group without
terms takes part with its smoothed shares; a language without kept terms has divergence 0 between all its sources;
ties are ordered by the UTF-8 bytes of the item; a very long text is read in pieces; an empty table gives no rows; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpanel.llm.common import LETTERS, batches_of, pieces, stored

#: What lies between terms (ASCII but no letter).
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SHARD = 1 << 16
BATCH = 1 << 20
#: Distinct rows that a counting task holds before it hands them on (some 100 MB with what merging them takes).
HELD = 1 << 17
GROUP = ["lang", "source"]
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def term_rows(texts: pa.Array, rows: pa.Array) -> pa.Table:
    """Terms of each text: ``row``, ``term``, ``n``."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    owner = rows.take(pc.list_parent_indices(parts))
    term = parts.flatten()
    whole = pc.not_equal(term, "")
    encoded = term.filter(whole).dictionary_encode()
    table = pa.table({"row": owner.filter(whole), "code": encoded.indices})
    sums = table.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    return pa.table({"row": sums["row"], "term": encoded.dictionary.take(sums["code"].combine_chunks()), "n": sums["count_all"]})


def row_counts(texts: pa.Array, most: int = BATCH) -> pa.Table:
    """The same, with texts of over ``most`` bytes cut between terms into pieces that are counted one by one."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    long_rows = np.flatnonzero(sizes > most)
    rows = pa.array(np.arange(len(texts)), pa.int64())
    if not len(long_rows):
        return term_rows(texts, rows)
    short = pa.array(np.flatnonzero(sizes <= most), pa.int64())
    found = [term_rows(texts.take(short), short)]
    for i in long_rows:
        whole = None
        for piece in pieces(texts[int(i)].as_py().encode(), LETTERS):
            part = term_rows(pa.array([piece], pa.binary()).cast(pa.string()), pa.array([i], pa.int64()))
            whole = part if whole is None else merged(pa.concat_tables([whole, part]), ["row", "term"], ["n"])
        found.append(whole)
    return pa.concat_tables([t.cast(found[0].schema) for t in found])


def merged(table: pa.Table, keys: list[str], sums: list[str]) -> pa.Table:
    out = table.group_by(keys, use_threads=False).aggregate([(c, "sum") for c in sums])
    return out.rename_columns([c.removesuffix("_sum") for c in out.column_names]).select(keys + sums)


def batch_counts(batch: pa.RecordBatch) -> pa.Table:
    """Counts of one batch, as in ``COUNTS``; a row without a term stands for each (language, source)."""
    groups = pa.table({c: batch.column(c).fill_null("") for c in GROUP})
    found = row_counts(batch.column("text").fill_null(""))
    of = found["row"].combine_chunks()
    counts = pa.table({"lang": groups["lang"].take(of), "source": groups["source"].take(of), "term": found["term"], "n": found["n"]})
    sums = counts.group_by([*GROUP, "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    sums = sums.rename_columns([{"n_sum": "n", "count_all": "docs"}.get(c, c) for c in sums.column_names])
    present = groups.group_by(GROUP, use_threads=False).aggregate([])
    zeros = pa.array(np.zeros(len(present), np.int64))
    present = present.append_column("term", pa.nulls(len(present), pa.string())).append_column("n", zeros).append_column("docs", zeros)
    return pa.concat_tables([t.select(COUNTS.names).cast(COUNTS) for t in (sums, present)])


def counted(batches):
    """Merged counts of a task's batches, handed on whenever they are more than ``HELD`` rows."""
    held: list[pa.Table] = []
    for batch in batches:
        for part in batches_of(batch, BATCH):
            held.append(batch_counts(part))
            if sum(len(t) for t in held) > 2 * HELD:
                held = [merged(pa.concat_tables(held), COUNTS.names[:3], ["n", "docs"]).cast(COUNTS)]
                if len(held[0]) > HELD:
                    yield from held.pop().to_batches(max_chunksize=1 << 15)
    if held:
        yield from merged(pa.concat_tables(held), COUNTS.names[:3], ["n", "docs"]).cast(COUNTS).to_batches(max_chunksize=1 << 15)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` of each (lang, source, term); each (lang, source) has a row with a null term."""
    columns = {"text": text_col, "lang": lang_col, "source": source_col}
    rows = docs.select(*[F.col(f"`{c}`").cast("string").alias(name) for name, c in columns.items()])

    counts = rows.mapInArrow(counted, "lang string, source string, term string, n bigint, docs bigint")
    return counts.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column, add: int, unit: int) -> Column:
    """``1 + floor(unit * (n + add) / (total + add * kept))``, exactly."""
    above = (n.cast("decimal(18,0)") + F.lit(add)).cast("decimal(19,0)") * F.lit(unit).cast("decimal(12,0)")
    below = (total.cast("decimal(18,0)") + F.lit(add).cast("decimal(4,0)") * kept.cast("decimal(12,0)")).cast("decimal(20,0)")
    return F.call_function("div", above, below) + F.lit(1)


def pair_sums(cells: DataFrame, places: DataFrame) -> DataFrame:
    """Sum of ``|p - q|`` over all kept terms for each ordered pair of sources of a language.

    ``cells``: lang, shard, term, source, p. ``places``: lang, shard, source, p0 (the share of a term without occurrences), for every
    shard and source of the language.
    """

    def run(key, left, right):
        sources = right.column("source").combine_chunks()
        index = pc.index_in(left.column("source"), value_set=sources).to_numpy()
        terms = left.column("term").combine_chunks()
        if isinstance(terms, pa.ChunkedArray):
            terms = pa.concat_arrays(terms.chunks) if terms.num_chunks else pa.array([], pa.string())
        coded = terms.dictionary_encode()
        p0 = right.column("p0").to_numpy()
        grid = np.tile(p0, (len(coded.dictionary), 1))
        grid[coded.indices.to_numpy(), index] = left.column("p").to_numpy()
        langs, firsts, seconds, values = [], [], [], []
        for a in range(len(sources)):
            sums = abs(grid - grid[:, a : a + 1]).sum(axis=0)
            others = np.flatnonzero(np.arange(len(sources)) != a)
            firsts.append(np.full(len(others), a))
            seconds.append(others)
            values.append(sums[others])
        first, second = np.concatenate(firsts), np.concatenate(seconds)
        langs = pa.array([key[0].as_py()] * len(first), pa.string())
        return pa.table({
            "lang": langs, "source": sources.take(pa.array(first)), "item": sources.take(pa.array(second)),
            "value": pa.array(np.concatenate(values), pa.int64()),
        })

    shards = cells.groupBy("lang", "shard").cogroup(places.groupBy("lang", "shard"))
    parts = shards.applyInArrow(run, "lang string, source string, item string, value bigint")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame, least: int = 30, add: int = 5, unit: int = 1_000_000_000, top: int = 50,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """Per (lang, source): part ``pair`` with the divergence from each other source, and part ``term`` with the ``top`` terms whose share
    exceeds the language's most. Columns lang, source, part, item, value, rank."""
    counts = stored(term_counts(docs, text_col, lang_col, source_col))
    terms = counts.where(F.col("term").isNotNull())
    known = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(F.col("docs") >= least)
    kept = stored(terms.select(*GROUP, "term", "n").join(known.select("lang", "term", "n_lang"), ["lang", "term"]))
    # one row per group, one per language
    in_group = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    vocabulary = known.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n_lang").alias("lang_total"))
    present = counts.where(F.col("term").isNull()).select(*GROUP)
    width = present.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = (
        present.join(in_group, GROUP, "left").join(vocabulary, "lang", "left").join(width, "lang")
        .na.fill(0, ["total", "kept", "lang_total"])
        .withColumn("shards", F.ceil(F.col("kept") * F.col("sources") / F.lit(SHARD)))
        .withColumn("shards", F.greatest(F.col("shards"), F.lit(1)).cast("int"))
    )
    groups = stored(groups)
    p = share(F.col("n"), F.col("total"), F.col("kept"), add, unit)
    q = share(F.col("n_lang"), F.col("lang_total"), F.col("kept"), add, unit)
    shared = kept.join(groups, GROUP).select(*GROUP, "term", p.alias("p"), q.alias("q"), "shards")
    cells = shared.select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "term", "source", "p")
    p0 = F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.greatest("kept", F.lit(1)), add, unit)).otherwise(F.lit(0))
    places = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "source", p0.alias("p0"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    pairs = pair_sums(cells, places).withColumn("rank", F.row_number().over(order))
    telling = shared.where(F.col("p") > F.col("q")).select(*GROUP, F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    telling = telling.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return (
        pairs.withColumn("part", F.lit("pair")).unionByName(telling.withColumn("part", F.lit("term")))
        .select(F.col("lang"), F.col("source"), "part", "item", "value", "rank")
    )
