"""Near-duplicate detection with bottom-k sketches from one hash function.

A document's set holds its distinct shingles of ``width`` words (a word is a run without white space, A-Z folded).
Its sketch is the ``SKETCH`` smallest hashes of the set. Documents with equal sets are one class from the start.

1. The ``INDEX`` smallest values of each class's sketch are inverted: classes that retain the same value are
   candidates, if the value's list has at most ``HOT`` classes. A pair at the threshold is missed here only if all values that it
   shares have long lists; that has a chance of at most ``LOST`` for a class with at most ``hot_bound`` such values, as the
   smallest values of the pair's union are in both sets with a chance of the similarity each.
2. The sketch of the union estimates the similarity of each candidate pair; pairs are dropped only below a bound
   that a pair at the threshold passes by chance once in ``1 / MISS`` (Chernoff).
3. The full word sets of the two texts decide.

Classes with more values with long lists than that (copies of a popular text, texts made of common passages) are
joined by an exact way that does not depend on chance. Their whole sets are counted and ordered rare first; two similar
sets must share a shingle within a prefix whose length follows from the threshold and both sizes. Short lists give
pairs at once. In a long list all members are compared with one leader, the member with the fewest rare shingles;
only members that the leader does not match meet other members, and only those whose size and place
in the list still allow the threshold. So a group of copies costs a star, not all its pairs.

Links are joined to components by alternating large-star and small-star steps. Every step aggregates before it
shuffles; joins on repeated keys are sort-merge joins that Spark splits where a key is heavy. Nothing but the number of links goes
to the driver.

Defined cases: a document without words (or without text) has an empty set, is linked with nothing and stays; one
with fewer words than ``width`` has its whole sequence as its only shingle; a document without an id is linked with
nothing; rows that repeat an id with other texts are compared each by its own text, equal rows stay together; only the id and text columns are used, except
that ``drop_near_copies`` returns all columns.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpanel.llm.common import (
    BASE, NOT_BLANK, batches_of, mixed, slot, slot_is_taken, stored, taken_slots, text_bytes, word_hashes,
)

SKETCH = 64
INDEX = 24
HOT = 32
LOST = 1e-9
MISS = 1e-12


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 63-bit shingle hashes of a document, from the hashes of its words."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64)
    size = min(width, n)
    with np.errstate(over="ignore"):
        folded = np.full(n - size + 1, size, dtype=np.uint64)
        for k in range(size):
            folded = folded * BASE + hashes[k : n - size + 1 + k]
        return np.unique(mixed(folded) >> np.uint64(1)).astype(np.int64)


def word_shingles(text: bytes, width: int) -> set:
    """The same set in full: tuples of words."""
    words = text.lower().split()  # of bytes: folds A-Z only and splits at ASCII white space only
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(width)]))


def estimate_bound(threshold: float, size: int = SKETCH, miss: float = MISS) -> float:
    """The largest estimate below which a pair at ``threshold`` falls with a chance of at most ``miss``."""

    def tail(x: float) -> float:
        return math.exp(-size * (x * math.log(x / threshold) + (1 - x) * math.log((1 - x) / (1 - threshold))))

    low, high = 1e-9, threshold
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) <= miss else (low, middle)
    return low


def hot_bound(percent: int) -> int:
    """The largest number of a class's index values with long lists at which a pair at the threshold shares no other value with a
    chance of at most ``LOST`` (binomial)."""
    t, chance = percent / 100, 0.0
    for k in range(INDEX + 1):
        chance += math.comb(INDEX, k) * t**k * (1 - t) ** (INDEX - k)
        if chance > LOST:
            return k - 1
    return INDEX


def _sets(batch, width: int):
    """Ids and shingle sets of an Arrow batch with ``id`` and ``text``."""
    hashes, counts = word_hashes(text_bytes(batch.column("text")), NOT_BLANK)
    ends = np.cumsum(counts)
    return [shingle_set(hashes[e - c : e], width) for e, c in zip(ends, counts)]


def sketches(rows: DataFrame, width: int) -> DataFrame:
    """``id``, set size ``n``, two digests of the set, and its sketch, for ``rows`` of ``id`` and ``text``."""

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, 4 << 20):
                sets = _sets(part, width)
                with np.errstate(over="ignore"):
                    first = [int(mixed(s.view(np.uint64)).sum().astype(np.int64)) for s in sets]
                    second = [int(mixed(s.view(np.uint64) ^ BASE).sum().astype(np.int64)) for s in sets]
                kept = [s[:SKETCH] for s in sets]
                offsets = np.concatenate(([0], np.cumsum([len(s) for s in kept]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(first, pa.int64()),
                        pa.array(second, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(kept) if kept else [], pa.int64())),
                    ],
                    ["id", "n", "d1", "d2", "sketch"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n bigint, d1 bigint, d2 bigint, sketch array<bigint>")


def full_sets(rows: DataFrame, width: int) -> DataFrame:
    """``id``, ``n`` and each ``value`` of the whole set, for ``rows`` of ``id`` and ``text``."""

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, 2 << 20):
                sets = _sets(part, width)
                sizes = [len(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(np.repeat(np.arange(len(sets)), sizes))),
                        pa.array(np.repeat(sizes, sizes), pa.int64()),
                        pa.array(np.concatenate(sets) if sets else [], pa.int64()),
                    ],
                    ["id", "n", "value"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n bigint, value bigint")


def _ordered(left, right):
    return F.least(left, right).alias("a"), F.greatest(left, right).alias("b")


def _sizes_fit(n, m, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def short_list_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of classes in one list; ``lists`` (value, id, n) has only lists of at most ``HOT`` classes."""
    x, y = lists.alias("x"), lists.alias("y")
    return (
        x.join(y, F.col("x.value") == F.col("y.value"))
        .where((F.col("x.id") < F.col("y.id")) & _sizes_fit(F.col("x.n"), F.col("y.n"), percent))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .distinct()
    )


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose union sketch does not rule the threshold out."""
    one = classes.select("id", "sketch")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    shared = F.size(F.array_intersect(F.col("u"), F.array_intersect("sa", "sb")))
    return (
        pairs.join(one.withColumnsRenamed({"id": "a", "sketch": "sa"}), "a")
        .join(one.withColumnsRenamed({"id": "b", "sketch": "sb"}), "b")
        .withColumn("u", union)
        .where(shared >= estimate_bound(percent / 100) * F.size("u"))
        .select("a", "b")
    )


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full word sets reach the threshold."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches):
        last, known = None, set()
        for batch in batches:
            for part in batches_of(batch):
                keep = []
                for left, right in zip(text_bytes(part.column("ta")), text_bytes(part.column("tb"))):
                    if left != last:
                        last, known = left, word_shingles(left, width)
                    other = word_shingles(right, width)
                    both = len(known & other)
                    keep.append(100 * both >= percent * (len(known) + len(other) - both))
                yield part.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return (
        pairs.join(texts.withColumnsRenamed({"id": "a", "text": "ta"}), "a")
        .join(texts.withColumnsRenamed({"id": "b", "text": "tb"}), "b")
        .mapInArrow(run, f"a {kind}, b {kind}")
    )


def _needed(n, m, percent: int):
    """Shingles that sets of sizes ``n`` and ``m`` must share."""
    return F.ceil((n + m) * percent / F.lit(100.0 + percent) - 1e-9)


def _bucket(size):
    return F.floor(F.log(size.cast("double")) / math.log(1.05))


def prefixes(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The part of each whole set, rare shingles first, in which a similar set must share one.

    Columns: value, id, n, pos (place in the order), size (of the value's list), rare (short lists in the prefix).
    """
    rows = full_sets(texts, width)
    counts = rows.groupBy("value").agg(F.count("*").alias("size"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("size", "value")) - 1
    part = rows.join(counts, "value").withColumn("pos", place)
    part = part.where(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * percent / F.lit(100.0) - 1e-9))
    rare = F.count(F.when(F.col("size") <= HOT, 1)).over(Window.partitionBy("id"))
    return part.withColumn("rare", rare).where("size > 1")


def popular_links(texts: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between the classes of ``texts`` (id, text), which share most of what they hold with many others."""
    rows = stored(prefixes(texts, width, percent))
    cold = short_list_pairs(rows.where(F.col("size") <= HOT), percent)
    lists = rows.where(F.col("size") > HOT)
    leaders = lists.groupBy("value").agg(F.min(F.struct("rare", "id", "n")).alias("lead"))
    led = lists.join(leaders, "value").where(F.col("id") != F.col("lead.id"))
    stars = (
        led.where(_sizes_fit(F.col("n"), F.col("lead.n"), percent))
        .select(*_ordered(F.col("id"), F.col("lead.id")))
        .distinct()
    )
    first = stored(confirmed(likely(cold.union(stars).distinct(), classes, percent), texts, width, percent))
    pair = led.withColumns(dict(zip(("a", "b"), _ordered(F.col("id"), F.col("lead.id")))))
    loose = pair.join(first, ["a", "b"], "left_anti")
    n, pos = F.col("n"), F.col("pos")
    largest = F.least(F.floor(n * 100 / F.lit(float(percent))), F.floor((n - pos) * (100 + percent) / F.lit(float(percent)) - n))
    smallest = F.ceil(n * percent / F.lit(100.0))
    loose = (
        loose.withColumns({"smallest": smallest, "largest": largest})
        .where(F.col("largest") >= F.col("smallest"))
        .withColumn("bucket", F.explode(F.sequence(_bucket(F.col("smallest")), _bucket(F.col("largest")))))
        .select("value", "bucket", F.col("id").alias("x"), F.col("n").alias("xn"), F.col("pos").alias("xpos"), "lead")
    )
    others = lists.select("value", _bucket(n).alias("bucket"), F.col("id").alias("y"), F.col("n").alias("yn"), F.col("pos").alias("ypos"))
    share = _needed(F.col("xn"), F.col("yn"), percent)
    fits = (
        (F.col("x") != F.col("y")) & (F.col("y") != F.col("lead.id"))
        & (F.col("xpos") <= F.col("xn") - share) & (F.col("ypos") <= F.col("yn") - share)
    )
    rest = (
        loose.alias("l").join(others.alias("o"), (F.col("l.value") == F.col("o.value")) & (F.col("l.bucket") == F.col("o.bucket")) & fits)
        .select(*_ordered(F.col("x"), F.col("y")))
        .distinct()
    )
    return first.unionByName(stored(confirmed(likely(rest, classes, percent), texts, width, percent)))


def components(links: DataFrame) -> DataFrame:
    """``id`` and the smallest id it reaches (``root``), for every id in ``links`` (a < b), by alternating stars."""
    edges, before = stored(links.select("a", "b").distinct()), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return edges.select(F.col("b").alias("id"), F.col("a").alias("root"))
        before = state
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").where(F.col("a") != F.col("m")).select(F.col("m").alias("x"), F.col("a").alias("y"))
        small = small.union(least.select("m", "b")).select(*_ordered(F.col("x"), F.col("y"))).where("a < b").distinct()
        edges = stored(small)


def texts_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` (id, text) of the given ids. Most others are left out before the shuffle by a bit table of fixed size."""
    bits = rows.sparkSession.sparkContext.broadcast(taken_slots(ids))

    def run(batches):
        for batch in batches:
            keep = slot_is_taken(bits.value, batch.column("slot").to_numpy())
            yield batch.filter(pa.array(keep, pa.bool_())).select(["id", "text"])

    near = rows.withColumn("slot", slot(F.col("id"))).mapInArrow(run, rows.schema)
    return near.join(ids, "id", "left_semi").dropDuplicates(["id"])


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (smallest id it reaches) and ``kept``.

    ``percent`` is the least similarity of a link in hundredths.
    """
    return _groups(docs, width, percent, id_col, text_col).select(
        F.col("id.id").alias(id_col), "n_shingles", "component_id", "kept"
    )


def _groups(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The same by ``id`` (the document's id and the hash of its text, so that rows which repeat an id with another text stay apart)."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("code")).alias("id"), text.alias("text"))
    found = stored(sketches(rows, width))
    classes = stored(
        found.where("n > 0 and id.id is not null").groupBy("n", "d1", "d2").agg(F.min("id").alias("id"), F.first("sketch").alias("sketch"))
    )
    index = classes.select("id", "n", F.explode(F.slice("sketch", 1, INDEX)).alias("value"))
    sizes = index.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    lists = stored(index.join(sizes, "value"))
    pairs = stored(likely(short_list_pairs(lists.where(F.col("size") <= HOT), percent), classes, percent))
    hot = lists.where(F.col("size") > HOT).groupBy("id", "n").agg(F.count("*").alias("hot"))
    few = F.when(
        F.col("n") * 100 <= F.lit(INDEX) * percent, (F.col("n") - F.col("hot")) * 100 <= F.col("n") * (100 - percent)
    ).otherwise(F.col("hot") > hot_bound(percent))
    popular = stored(hot.where(few).select("id"))
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(popular).distinct()
    texts = stored(texts_of(rows, needed))
    links = confirmed(pairs, texts, width, percent).unionByName(
        popular_links(texts.join(popular, "id", "left_semi"), classes, width, percent)
    )
    roots = components(links)
    members = classes.join(roots, "id", "left").select(
        F.col("n"), F.col("d1"), F.col("d2"), F.coalesce("root", "id")["id"].alias("root")
    )
    return (
        found.join(members, ["n", "d1", "d2"], "left")
        .withColumn("component_id", F.when(F.col("n") > 0, F.coalesce("root", "id.id")).otherwise(F.col("id.id")))
        .select(
            "id", F.col("n").alias("n_shingles"), "component_id",
            F.coalesce(F.col("id.id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id. All columns stay as they are."""
    gone = _groups(docs, width, percent, id_col, text_col).where(~F.col("kept"))
    same = (docs[f"`{id_col}`"] == gone["id.id"]) & (F.xxhash64(docs[f"`{text_col}`"]) == gone["id.code"])
    return docs.join(gone, same, "left_anti")
