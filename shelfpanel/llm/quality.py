"""Text quality from graded ratings by an ordinal cumulative-link regression.

A text's features are hashed: the shares of its raw byte trigrams (so that case, marks and layout count) and the share of
words that repeat the word before. One weight per bucket is shared by all grades; ordered thresholds cut the
weighted sum into grades: P(grade <= k) = logistic(threshold k - sum). That gives the expected grade, and the chance
of a grade of at least some level, by which texts are selected.

Training reads at most ``SAMPLE`` rated documents of up to ``SAMPLE_BYTES`` bytes, chosen by the hash of their id,
outside the held-out part; that bounds the driver's share and the broadcast model. Scoring is one pass without a
shuffle over whole texts.

Defined cases: null counts as empty; an empty text has no features and the sum 0; null and negative ratings teach nothing; with
ratings of less than two grades every text has that grade (or 0) and is kept; only the id and text columns are used.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.llm.common import CHUNK, NOT_BLANK, batches_of, held_out, stored, text_bytes, word_hashes

SAMPLE = 4000
SAMPLE_BYTES = 1 << 16
BUCKETS = 1 << 16
REPEAT = BUCKETS  # one more weight: share of words that repeat the word before
SCALE = 30.0
SIZE = 3


def trigram_parts(texts: list[bytes]):
    """Chunks of trigram buckets: (text numbers, trigrams of each, buckets). Long texts come in parts that lose none."""
    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - SIZE + 1), CHUNK):
            parts.append(text[at : at + CHUNK + SIZE - 1])
            owners.append(i)
            size += len(parts[-1])
            if size >= CHUNK:
                yield _buckets(parts, owners)
                parts, owners, size = [], [], 0
    if parts:
        yield _buckets(parts, owners)


def _buckets(parts, owners):
    joined = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    lengths = np.array([len(p) for p in parts])
    counts = np.maximum(lengths - SIZE + 1, 0)
    if len(joined) < SIZE:
        return np.array(owners), counts * 0, np.zeros(0, np.uint32)
    codes = (joined[:-2] << np.uint32(16)) | (joined[1:-1] << np.uint32(8)) | joined[2:]
    codes = (codes * np.uint32(0x9E3779B1)) >> np.uint32(16)
    inside = np.ones(len(codes), bool)  # not the two that reach into the next part
    ends = np.cumsum(lengths)
    for k in range(SIZE - 1):
        at = ends - 1 - k
        inside[at[(at >= 0) & (at < len(codes)) & (lengths > k)]] = False
    return np.array(owners), counts, codes[inside]


def repeat_shares(texts: list[bytes]) -> np.ndarray:
    hashes, counts = word_hashes(texts, NOT_BLANK)
    same = np.zeros(len(hashes), np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    ends = np.cumsum(counts)
    starts = (ends - counts)[counts > 0]
    same[starts] = 0
    sums = np.concatenate(([0], np.cumsum(same)))
    return (sums[ends] - sums[ends - counts]) / np.maximum(counts, 1)


class OrdinalModel:
    """Shared weights and ordered thresholds."""

    def __init__(self, grades: int):
        self.grades = grades
        self.weights = np.zeros(BUCKETS + 1, np.float32)
        self.cuts = np.linspace(-1, 1, grades - 1) if grades > 2 else np.zeros(max(0, grades - 1))

    def sums(self, texts: list[bytes]) -> np.ndarray:
        """The weighted sum of each text's features."""
        totals, sizes = np.zeros(len(texts)), np.zeros(len(texts))
        for owners, counts, buckets in trigram_parts(texts):
            sums = np.concatenate(([0.0], np.cumsum(self.weights[buckets], dtype=np.float64)))
            ends = np.cumsum(counts)
            np.add.at(totals, owners, sums[ends] - sums[ends - counts])
            np.add.at(sizes, owners, counts)
        return SCALE * totals / np.maximum(sizes, 1) + self.weights[REPEAT] * repeat_shares(texts)

    def fit(self, texts: list[bytes], grades: np.ndarray, rounds: int = 120, rate: float = 0.3, decay: float = 1e-3) -> "OrdinalModel":
        """Gradient steps over the whole sample with a pace of its own for each weight."""
        where, values, rows = [], [], []
        repeats = repeat_shares(texts)
        for i, text in enumerate(texts):
            buckets = np.concatenate([b for _, _, b in trigram_parts([text])])
            found, counts = np.unique(buckets, return_counts=True)
            where += [found.astype(np.int32), np.array([REPEAT], np.int32)]
            values += [(SCALE * counts / max(1, len(buckets))).astype(np.float32), np.array([repeats[i]], np.float32)]
            rows.append(np.full(len(found) + 1, i, np.int32))
        where, values, rows = map(np.concatenate, (where, values, rows))
        frequency = np.bincount(grades, minlength=self.grades)
        share = len(grades) / (self.grades * np.maximum(frequency, 1))
        weight = np.sqrt(share)[grades] / len(grades)
        below = np.clip(np.cumsum(frequency)[:-1] / len(grades), 0.01, 0.99)
        self.cuts = np.log(below / (1 - below))
        gaps = np.log(np.maximum(np.diff(self.cuts), 1e-2))
        first = self.cuts[:1].copy()
        squares, squares_cut = np.full(len(self.weights), 1e-10), np.full(len(self.cuts), 1e-6)
        for step in range(rounds):
            self.cuts = first + np.concatenate(([0], np.cumsum(np.exp(gaps))))
            sums = np.bincount(rows, values * self.weights[where], minlength=len(grades))
            by_sum, by_cut = self._slopes(sums, grades, weight)
            gradient = np.bincount(where, values * by_sum[rows], minlength=len(self.weights)) + decay * self.weights / len(self.weights)
            squares += gradient**2
            self.weights -= (rate / (1 + 0.02 * step) * gradient / np.sqrt(squares)).astype(np.float32)
            # the first threshold moves all; each gap moves those after it
            inner = np.array([by_cut[k + 1 :].sum() * np.exp(gaps[k]) for k in range(len(gaps))])
            change = np.concatenate(([by_cut.sum()], inner))
            squares_cut += change**2
            moved = 0.1 * change / np.sqrt(squares_cut)
            first, gaps = first - moved[:1], gaps - moved[1:]
        self.cuts = first + np.concatenate(([0], np.cumsum(np.exp(gaps))))
        return self

    def _slopes(self, sums, grades, weight):
        """Slopes of the loss by each text's sum and by each threshold."""
        bounds = np.concatenate(([-np.inf], self.cuts, [np.inf]))
        upper = 1 / (1 + np.exp(-np.clip(bounds[grades + 1] - sums, -30, 30)))
        lower = 1 / (1 + np.exp(-np.clip(bounds[grades] - sums, -30, 30)))
        chance = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper), lower * (1 - lower)
        up[grades == self.grades - 1], low[grades == 0] = 0, 0
        by_sum = weight * (up - low) / chance
        by_cut = np.zeros(len(self.cuts))
        for k in range(len(self.cuts)):
            by_cut[k] = -(weight * up / chance)[grades == k].sum() + (weight * low / chance)[grades == k + 1].sum()
        return by_sum, by_cut

    def tails(self, texts: list[bytes]) -> np.ndarray:
        """Chances of a grade of at least 1, 2, ... (texts x grades - 1)."""
        return 1 / (1 + np.exp(-np.clip(self.sums(texts)[:, None] - self.cuts[None], -40, 40)))


def train(docs: DataFrame, ratings: DataFrame, grade_col: str = "grade", id_col: str = "doc_id", text_col: str = "text", limit: int = SAMPLE) -> OrdinalModel:
    """A model of graded ratings 0, 1, 2, ... outside the held-out part; a document rated more than once counts with its lowest."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.where(F.octet_length("text") <= SAMPLE_BYTES)
    rated = stored(
        ratings.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{grade_col}`").cast("int").alias("grade"))
        .where("grade >= 0 and id is not null").where(~held_out(F.col("id")))
        .groupBy("id").agg(F.min("grade").alias("grade"))
        .join(rows.select("id"), "id", "left_semi")  # only ratings whose text can be read take a place of the sample
    )
    grades = (rated.agg(F.max("grade")).first()[0] or 0) + 1
    picked = rated.orderBy(F.xxhash64("id"), "id").limit(limit)
    sample = (
        rows.join(F.broadcast(picked), "id")
        .orderBy(F.xxhash64("id"), "id", "text").limit(2 * limit).collect()
    )
    y = np.array([r["grade"] for r in sample], np.int64)
    model = OrdinalModel(grades)
    if len(np.unique(y)) < 2:
        model.cuts = np.where(np.arange(1, grades) <= (y[0] if len(y) else 0), -40.0, 40.0)
        return model
    return model.fit([r["text"].encode() for r in sample], y)


def rate(docs: DataFrame, model: OrdinalModel, level: int = 1, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``expected_grade``, ``tail`` (chance of a grade of at least ``level``) and ``kept`` (a tail of at least ``least``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for batch in batches:
            for part in batches_of(batch):
                tails = shared.value.tails(text_bytes(part.column("text")))
                own = tails[:, level - 1] if tails.shape[1] >= level else np.ones(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(tails.sum(axis=1), pa.float64()), pa.array(own, pa.float64())],
                    ["id", "expected_grade", "tail"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, expected_grade double, tail double")
    return out.select(F.col("id").alias(id_col), "expected_grade", "tail", (F.col("tail") >= least).alias("kept"))
