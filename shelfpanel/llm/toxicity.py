"""Toxicity scores from a small convolutional text classifier, trained here in numpy.

A word and its first bytes (prefixes of several lengths) are hashed to buckets; each bucket seen in at least ``SEEN``
training documents has an embedding, all others count as unknown and have none. A word's embedding is the sum of its
buckets' embeddings, so that an unseen word of a known stem is still known by that. Filters of several widths slide
over the whole text, the largest answer of each is kept, and a linear layer gives the score. Thresholds are calibrated
on a part of the training sample for each language group, clean texts weighing more as they are more frequent in
the table; the group comes from the text alone (its function words).

Training reads every labelled document whole, four to eight times, but those held out: three quarters fit the weights, one quarter
the thresholds. Shards of some ``SHARD`` documents train copies of the network, which Spark averages after each round
(``averaging``); the buckets are counted, and the thresholds found, over all documents of their part. The network's
size is bounded: the ``VOCAB`` most frequent buckets have an embedding. Scoring is one pass without a shuffle over whole texts.

Defined cases: null counts as empty; an empty text has the score of a text without known words; without labels of
both kinds every score is the share of toxic labels; documents without a label are scored all the same; only
the id and text columns are used.
"""

import copy

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpanel.llm import averaging
from shelfpanel.llm.common import (
    BASE, LETTERS, LOWER_BYTES, batches_of, held_out, mixed, release_memory, released, slot, slot_is_taken, stored, taken_slots, text_bytes,
    word_chunks,
)

SAMPLE = 6000
SAMPLE_BYTES = 1 << 16
BUCKETS = 1 << 21
SEEN = 3
PREFIXES = (4, 5, 6, 7)
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
GAP = max(WIDTHS) - 1
BLOCK = 1 << 17
#: Places whose answers are held at once when only their maximum is wanted.
PIECE = 1 << 14
VOCAB = 1 << 18
#: Rounds over all documents: so many that ``LEAST`` texts are read, at least and at most as given.
ROUNDS = (4, 8)
LEAST = 48000
SHARD = 8192
TEXTS = 32
#: Logits in a histogram have cells of 1 / CELLS.
CELLS = 256

#: Frequent function words of each language group (fixed values).
FUNCTION_WORDS = {
    "en": "the of and to in is that for was with as on are this it be by from which",
    "de": "der die und das ist nicht ein mit den von dem im sich auf für des eine auch als",
    "fr": "le la les et des est une du que dans pour qui sur pas au par ce il en",
    "es": "el los las y que del una por con para su al como más es lo se un no",
}


def _buckets(hashes, joined, starts, ends) -> np.ndarray:
    """Buckets of words: of the word itself, then of its prefixes; 0 where the word is not longer than that."""
    part = np.zeros((len(hashes), 1 + len(PREFIXES)), np.int32)
    part[:, 0] = hashes & np.uint64(BUCKETS - 1)
    front = np.ones(len(hashes), np.uint64)
    for k in range(max(PREFIXES)):
        front = front * BASE + LOWER_BYTES[joined[np.minimum(starts + k, len(joined) - 1)]]
        if k + 1 in PREFIXES:
            longer = ends - starts > k + 1
            part[:, 1 + PREFIXES.index(k + 1)] = np.where(longer, mixed(front) & np.uint64(BUCKETS - 1), 0)
    return part


def word_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word, and the words of each text."""
    totals, found = np.zeros(len(texts), dtype=np.int64), []
    for owners, counts, hashes, joined, starts, ends in word_chunks(texts, LETTERS):
        np.add.at(totals, owners, counts)
        found.append(_buckets(hashes, joined, starts, ends))
    return (np.concatenate(found) if found else np.zeros((0, 1 + len(PREFIXES)), np.int32)), totals


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each distinct word, the number of the distinct word at every place, and the words of each text.

    ``buckets[numbers]`` is what ``word_buckets`` gives, in a fifth of its memory.
    """
    totals = np.zeros(len(texts), dtype=np.int64)
    known, buckets, places, size = [np.zeros(0, np.uint64)], [np.zeros((0, 1 + len(PREFIXES)), np.int32)], [], 0
    for owners, counts, hashes, joined, starts, ends in word_chunks(texts, LETTERS):
        np.add.at(totals, owners, counts)
        own, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        known.append(own)
        buckets.append(_buckets(own, joined, starts[first], ends[first]))
        places.append((inverse + size).astype(np.int32))
        size += len(own)
    _, first, number = np.unique(np.concatenate(known), return_index=True, return_inverse=True)
    number = number.astype(np.int32)
    numbers = np.concatenate([number[p] for p in places]) if places else np.zeros(0, np.int32)
    return np.concatenate(buckets)[first], numbers, totals


def spaced(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all texts with ``GAP`` zeros after each text, and where each text starts."""
    ends = np.cumsum(counts + GAP)
    out = np.zeros((int(ends[-1]) if len(ends) else 0, *values.shape[1:]), dtype=values.dtype)
    out[np.arange(len(values)) + np.repeat(np.arange(len(counts)) * GAP, counts)] = values
    return out, ends - counts - GAP


def gaps(starts: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie after a text: a filter that starts there would read into the next text."""
    out = np.zeros(size, bool)
    out[(np.append(starts[1:], size)[:, None] - np.arange(1, GAP + 1)).ravel()] = True
    return out


def padded(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.zeros((GAP, rows.shape[1]), rows.dtype)])


def piece_bounds(size: int):
    """Where pieces of ``size`` places start and stop; blocks keep their bounds, and what is left of one goes with its last piece."""
    for at in range(0, size, BLOCK):
        stop = min(at + BLOCK, size)
        cuts = [*range(at, max(stop - PIECE, at) + 1, PIECE), stop]
        yield from zip(cuts, cuts[1:])


class ToxicModel:
    """Weights of the network, thresholds, and the scoring of batches."""

    def __init__(self, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.vocab = np.zeros(0, np.int32)
        self.table: np.ndarray | None = None
        self.embedding = np.zeros((1, DIM), np.float32)
        self.filters = [draw.normal(0, 0.4, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.top = draw.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.offset = np.zeros(1, np.float32)
        self.moved: np.ndarray | None = None  # what training needs: sums of squared steps
        self.squares: list[np.ndarray] = []
        self.thresholds: dict[int, float] = {}
        self.threshold = 0.0
        self.constant: float | None = None

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        """Rows of the embedding; 0 is the unknown word."""
        if self.table is None:
            self.table = np.zeros(BUCKETS, np.int32)
            self.table[self.vocab] = np.arange(1, len(self.vocab) + 1)
        return self.table[buckets]

    def embedded(self, rows: np.ndarray) -> np.ndarray:
        x = self.embedding[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            x += self.embedding[rows[:, k]]
        return x

    def __getstate__(self):
        """The table follows from the vocabulary and is not sent along."""
        return self.__dict__ | {"table": None}

    def answers(self, rows: np.ndarray) -> np.ndarray:
        """Answers of all filters at each place but the last ``GAP``."""
        x, n = self.embedded(rows), len(rows) - GAP
        parts = []
        for f in self.filters:
            z = x[:n] @ f[0]
            for j in range(1, len(f)):
                z += x[j : n + j] @ f[j]
            parts.append(z)
        z = np.concatenate(parts, axis=1)
        z += self.bias
        return z

    def pooled(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Largest answer of each filter in each text, at least 0. Long inputs are read in overlapping pieces."""
        out = np.zeros((len(starts), len(self.bias)), np.float32)
        outside, size = gaps(starts, len(rows)), len(rows)
        for at, stop in piece_bounds(size):
            own = rows[at : stop + GAP] if stop + GAP <= size else padded(rows[at:size])[: stop + GAP - at]
            z = self.answers(own)
            z[outside[at:stop]] = -np.inf
            first = np.searchsorted(starts, at, side="right") - 1
            inside = starts[first + 1 : np.searchsorted(starts, stop)] - at
            cuts = np.concatenate(([0], inside)).astype(np.int64)
            most = np.maximum.reduceat(z, cuts, axis=0)
            texts = np.arange(first, first + len(cuts))
            out[texts] = np.maximum(out[texts], most)
        return out

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(counts):
            return np.zeros(0)
        rows, starts = spaced(self.rows(buckets), counts)
        return (self.pooled(rows, starts) @ self.top + self.offset).astype(np.float64)

    def params(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.top, self.offset]

    def begin(self, vocab: np.ndarray) -> "ToxicModel":
        """First embeddings for the given buckets."""
        self.vocab = vocab.astype(np.int32)
        self.embedding = np.random.default_rng(5).normal(0, 0.1, (len(vocab) + 1, DIM)).astype(np.float32)
        self.embedding[0] = 0
        self.squares = [np.full(p.shape, 1e-6, np.float32) for p in self.params()]
        self.moved = np.full(len(self.embedding), 1e-6, np.float32)
        return self

    def numbers(self) -> np.ndarray:
        """All that training changes: a row for each bucket, then the other weights."""
        rest, n = averaging.flat(self.params() + self.squares, DIM + 1), len(self.embedding)
        out = np.empty((n + len(rest), DIM + 1), np.float32)
        out[:n, :DIM], out[:n, DIM], out[n:] = self.embedding, self.moved, rest
        return out

    def take(self, table: np.ndarray) -> None:
        rows, rest = table[: len(self.embedding)], table[len(self.embedding) :]
        self.embedding, self.moved = rows[:, :DIM].copy(), rows[:, DIM].copy()
        found = averaging.unflat(rest, [p.shape for p in self.params() + self.squares])
        n = len(self.squares)
        *self.filters, self.bias, self.top, self.offset = found[:n]
        self.squares = found[n:]

    def step_through(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray, rate: float, draw) -> None:
        """One step for each few texts, in random order; texts are read whole."""
        buckets, numbers, counts = word_numbers(texts)
        word_rows, ends, params = self.rows(buckets), np.cumsum(counts), self.params()
        order = draw.permutation(len(counts))
        for at in range(0, len(order), TEXTS):
            picked = order[at : at + TEXTS]
            rows = word_rows[np.concatenate([numbers[ends[i] - counts[i] : ends[i]] for i in picked])]
            rows[draw.integers(0, 10, rows.shape, np.uint8) == 0] = 0
            rows, starts = spaced(rows, counts[picked])
            self._step(rows, starts, labels[picked], weights[picked] / len(picked), params, self.squares, self.moved, rate)

    def peaks(self, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of each filter in each text and its place; ``rows`` are padded. Long inputs are read in blocks."""
        size = len(rows) - GAP
        outside, stops = gaps(starts, size), np.append(starts[1:], size)
        best = np.repeat(starts[:, None], len(self.bias), axis=1)
        top = np.full(best.shape, -np.inf, np.float32)
        for at in range(0, size, BLOCK):
            z = self.answers(rows[at : min(at + BLOCK, size) + GAP])
            z[outside[at : at + len(z)]] = -np.inf
            for i in range(np.searchsorted(stops, at, side="right"), np.searchsorted(starts, at + len(z))):
                s, e = max(starts[i], at), min(stops[i], at + len(z))
                place = z[s - at : e - at].argmax(axis=0) + s
                value = z[place - at, np.arange(z.shape[1])]
                better = value > top[i]
                best[i, better], top[i, better] = place[better], value[better]
        return best, top

    def _step(self, rows, starts, labels, weights, params, squares, moved, rate):
        rows = padded(rows)
        best, top = self.peaks(rows, starts)  # texts x filters
        hidden = np.maximum(top, 0)
        chance = 1 / (1 + np.exp(-(hidden @ self.top + self.offset)))
        error = ((chance - labels) * weights).astype(np.float32)
        back = error[:, None] * self.top * (top > 0)
        grads, changes, places = [], [], []
        for i, f in enumerate(self.filters):
            part = slice(i * FILTERS, (i + 1) * FILTERS)
            g, at = back[:, part], best[:, part]
            grad = np.zeros_like(f)
            for j in range(len(f)):
                r = rows[at + j]  # texts x filters x buckets of the word
                grad[j] = np.einsum("tfkd,tf->df", self.embedding[r], g)
                change = (g[:, :, None] * f[j].T[None])[:, :, None]
                changes.append(np.broadcast_to(change, (*r.shape, DIM)).reshape(-1, DIM))
                places.append(r.ravel())
            grads.append(grad + 1e-4 * f)
        grads += [back.sum(axis=0), hidden.T @ error + 1e-4 * self.top, error.sum(keepdims=True)]
        for p, g, s in zip(params, grads, squares):
            s += g * g
            p -= rate * g / np.sqrt(s)
        places, changes = np.concatenate(places), np.concatenate(changes)
        hit, inverse = np.unique(places, return_inverse=True)
        total = np.zeros((len(hit), DIM), np.float32)
        np.add.at(total, inverse, changes)
        moved[hit] += (total**2).sum(axis=1)
        self.embedding[hit] -= rate * total / np.sqrt(moved[hit])[:, None]
        self.embedding[0] = 0

    def calibrate(self, logits, groups, labels, times, clean_weight: float = 1.0, least: int = 20) -> "ToxicModel":
        """The threshold with the fewest errors for each group with enough examples of both kinds, and one for all; each
        example comes ``times`` times."""
        self.threshold = best_threshold(logits, labels, clean_weight, times)
        for g in np.unique(groups):
            own = groups == g
            if min((labels * times)[own].sum(), ((1 - labels) * times)[own].sum()) >= least:
                self.thresholds[int(g)] = best_threshold(logits[own], labels[own], clean_weight, times[own])
        return self

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Chance of toxicity of each text; 0.5 lies at the threshold of its language group."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        buckets, counts = word_buckets(texts)
        groups = language_groups(buckets, counts)
        shift = np.array([self.thresholds.get(int(g), self.threshold) for g in groups])
        return 1 / (1 + np.exp(-np.clip(self.logits(buckets, counts) - shift, -40, 40)))


def best_threshold(logits: np.ndarray, labels: np.ndarray, clean_weight: float = 1.0, times: np.ndarray | None = None) -> float:
    """Midway through the widest range of thresholds with the fewest errors, of which those on clean texts weigh as given."""
    times = np.ones(len(logits), np.int64) if times is None else times
    x, inverse = np.unique(logits, return_inverse=True)
    toxic, clean = (np.bincount(inverse, times * (labels == k), len(x)) for k in (1, 0))
    errors = np.concatenate(([0], np.cumsum(toxic))) + clean_weight * np.concatenate((np.cumsum(clean[::-1])[::-1], [0]))
    low = np.concatenate(([x[0] - 2], x)) if len(x) else np.zeros(1)
    high = np.concatenate((x, [x[-1] + 2])) if len(x) else np.zeros(1)
    best = np.flatnonzero(errors == errors.min())
    widest = best[np.argmax(high[best] - low[best])]
    return float((low[widest] + high[widest]) / 2)


def _function_table() -> np.ndarray:
    """For each bucket a bit mask of the languages whose function words fall in it."""
    table = np.zeros(BUCKETS, np.uint8)
    for i, words in enumerate(FUNCTION_WORDS.values()):
        buckets, _ = word_buckets([words.encode()])
        table[buckets[:, 0]] |= np.uint8(1 << i)
    return table


_table: list[np.ndarray] = []


def language_groups(buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of the language with the most function words in each text (first of equals), or -1 without any."""
    if not _table:
        _table.append(_function_table())
    marks = _table[0][buckets[:, 0]]
    ends = np.cumsum(counts)
    sums = np.zeros((len(FUNCTION_WORDS), len(counts)), np.int64)
    for i in range(len(FUNCTION_WORDS)):
        total = np.concatenate(([0], np.cumsum((marks >> i) & 1)))
        sums[i] = total[ends] - total[ends - counts]
    return np.where(sums.max(axis=0) > 0, sums.argmax(axis=0), -1) if len(counts) else np.zeros(0, np.int64)


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, limit: int = SAMPLE):
    """Words (as ``word_numbers`` gives them) and labels of a bounded sample of labelled documents outside the held-out
    part, and the share of toxic ones among all such documents. For trials; ``train`` reads all documents."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.where(F.octet_length("text") <= SAMPLE_BYTES)
    known = stored(
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("label").alias("label"))
        .join(rows.select("id"), "id", "left_semi")  # only labels whose text can be read take a place of the sample
    )
    mix = F.xxhash64("id")
    shares = {0: limit - limit // 3, 1: limit // 3}
    parts = [known.where(F.col("label") == k).orderBy(mix, "id").limit(n) for k, n in shares.items()]
    picked = F.broadcast(parts[0].union(parts[1]))  # at most ``limit`` rows
    rows = rows.join(picked, "id").select(F.xxhash64("id", "text").alias("mix"), "text", "label")
    found = rows.toArrow().sort_by([("mix", "ascending")])  # the same model whatever the order of tasks
    labels = found.column("label").to_numpy().astype(np.int64)
    texts = text_bytes(found.column("text"))
    del found
    return *word_numbers(texts), labels, known.agg(F.avg("label")).first()[0]


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str) -> DataFrame:
    """Every labelled document outside the held-out part: ``mix`` (hash of the row), ``text``, ``label``, ``later`` (a quarter, by hash);
    stored in shards.

    Texts are shuffled once, straight to their shards, where the labels meet them; a bit table keeps most texts without a label back.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.where(F.col("id").isNotNull() & ~held_out(F.col("id"))).withColumn("mix", F.xxhash64("id", "text"))
    known = stored(
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    bits = docs.sparkSession.sparkContext.broadcast(taken_slots(known.select("id")))

    @F.pandas_udf("boolean")
    def taken(slots: pd.Series) -> pd.Series:
        return pd.Series(slot_is_taken(bits.value, slots.to_numpy()))

    marks = rows.select("id", "mix").join(known, "id").select("id", "mix", F.lit(None).cast("string").alias("text"), "label")
    texts = rows.where(taken(slot(F.col("id")))).select("id", "mix", "text", F.lit(None).cast("int").alias("label"))
    found = averaging.dealt(marks.unionByName(texts), known.count(), SHARD)
    found = found.withColumn("label", F.max("label").over(Window.partitionBy("shard", "mix", "id")))
    found = found.where(F.col("text").isNotNull() & F.col("label").isNotNull()).select("shard", "mix", "text", "label")
    return stored(found.withColumn("later", F.pmod("mix", F.lit(4)) == 0).sortWithinPartitions("shard", "mix", "text"))


def vocabulary(rows: DataFrame) -> np.ndarray:
    """The most frequent buckets of all ``rows``: those in ``SEEN`` documents at least, and no more than ``VOCAB``."""

    def run(batches):
        seen = np.zeros(BUCKETS, np.int32)
        for batch in released(batches):
            for part in batches_of(batch, 2 << 20):
                buckets, numbers, counts = word_numbers(text_bytes(part.column("text")))
                for end, count in zip(np.cumsum(counts), counts):
                    seen[np.unique(buckets[np.unique(numbers[end - count : end])])] += 1
        seen[0] = 0
        places = np.flatnonzero(seen)
        for at in range(0, len(places), 1 << 15):
            own = places[at : at + (1 << 15)]
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(seen[own].astype(np.int64))], ["place", "n"])

    counts = rows.select("text").mapInArrow(run, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    counts = stored(counts.where(F.col("n") >= SEEN))
    least = averaging.most_frequent(counts, VOCAB)
    kept = counts.where(F.col("n") >= least) if least else counts.limit(0)
    return np.sort(kept.select("place").toArrow().column("place").to_numpy())


def fitted(rows: DataFrame, model: ToxicModel, weight: np.ndarray, step: int) -> np.ndarray:
    """``model.numbers()`` after a round over all ``rows``; ``weight``: of a clean and of a toxic document."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    rate = 0.05 / (1 + 0.3 * step)

    def run(batches):
        now, local, draw = None, None, None
        for shard, part in released(averaging.runs_of(batches, 2 << 20)):
            if shard != now:
                if local is not None:
                    yield from averaging.changes(shared.value.numbers(), local.numbers())
                    local = None  # one copy at a time
                now, local, draw = shard, copy.deepcopy(shared.value), np.random.default_rng([step, shard])
            labels = part.column("label").to_numpy().astype(np.int64)
            local.step_through(text_bytes(part.column("text")), labels, weight[labels], rate, draw)
        if local is not None:
            yield from averaging.changes(shared.value.numbers(), local.numbers())

    found = averaging.by_core(rows.select("shard", "label", "text")).mapInArrow(run, averaging.schema(DIM + 1))
    return averaging.averaged(found, model.numbers())


def logit_counts(rows: DataFrame, model: ToxicModel) -> tuple[np.ndarray, ...]:
    """Logits of all ``rows`` in cells, language groups, labels, and how many documents share them."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in released(batches):
            for part in batches_of(batch, 2 << 20):
                buckets, counts = word_buckets(text_bytes(part.column("text")))
                cells = np.rint(np.clip(shared.value.logits(buckets, counts), -64, 64) * CELLS).astype(np.int32)
                groups = language_groups(buckets, counts).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(groups), part.column("label")], ["cell", "lang", "label"])

    cells = rows.select("text", "label").mapInArrow(run, "cell int, lang int, label int")
    found = cells.groupBy("cell", "lang", "label").agg(F.count(F.lit(1)).alias("n")).orderBy("cell", "lang", "label").toArrow()
    cell, lang, label, n = (found.column(c).to_numpy().astype(np.int64) for c in ("cell", "lang", "label", "n"))
    return cell / CELLS, lang, label, n


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> ToxicModel:
    """A model fitted on three quarters of all labelled documents and calibrated on the last quarter."""
    rows = labelled(docs, labels, label_col, id_col, text_col)
    sizes = {(r["later"], r["label"]): r["n"] for r in rows.groupBy("later", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = (sum(n for (_, k), n in sizes.items() if k == kind) for kind in (0, 1))
    model = ToxicModel()
    if min(clean, toxic) == 0:
        model.constant = float(toxic > 0)
        return model
    early, later = rows.where(~F.col("later")), rows.where("later")
    if len(sizes) < 4:  # too few for two parts
        early = later = rows
    count = early.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label").toArrow().column("n").to_numpy()
    weight = 0.5 / count * count.sum()
    model.begin(vocabulary(early))
    for step in range(int(np.clip(-(-LEAST // count.sum()), *ROUNDS))):
        model.take(fitted(early, model, weight, step))
    model.moved, model.squares = None, []  # only training needs them
    logits, groups, y, times = logit_counts(later, model)
    # half way (in proportions) between labels of equal weight and their shares in the table
    balance = np.sqrt(clean / toxic) * times[y == 1].sum() / times[y == 0].sum()
    model.calibrate(logits, groups, y, times, balance)
    release_memory()
    return model


def scored(batches, model: ToxicModel, text_col: str):
    """Slices of Arrow batches, each with the scores of its texts."""
    for batch in released(batches):
        for part in batches_of(batch, 2 << 20):
            yield part, model.scores(text_bytes(part.column(text_col)))


def score(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``score`` and ``predicted`` (1 from a score of 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for part, values in scored(batches, shared.value, "text"):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(values, pa.float64())], ["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double").select(
        F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """The rows that the model does not reject, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, values in scored(batches, shared.value, text_col):
            yield part.filter(pa.array(values < 0.5, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
