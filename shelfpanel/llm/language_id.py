"""Language identification with a linear-chain conditional random field over the words of a text.

A word's features are its first and last bytes (affixes of several lengths), its byte n-grams, and the word itself
(the lexicon); all are hashed to a table of weights per language. Transitions between neighbouring words' languages are
learned with them. Training sequences are made of stretches from documents of different languages, so that the model sees switches
within a text. Forward-backward gives each word's chances; a document's language is the one with the largest mean.

Training reads at most ``SAMPLE`` documents per language of up to ``SAMPLE_BYTES`` bytes, those with the smallest hashes of id
and text, outside the held-out part. Counts per bin of hashes give the cut, so that two passes do for any number of
languages and no task gathers one; that bounds the driver's share and the broadcast model. Labelling is one pass without a
shuffle over whole texts.

Defined cases: a null text and one without a letter are ``und`` with score 0; words without letters are not labelled;
null languages teach nothing; without any language every text is ``und``; only the id and text columns are read for
a prediction.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.llm.common import BASE, LETTERS, LOWER_BYTES, batches_of, held_out, mixed, text_bytes, word_chunks

SAMPLE = 400
SAMPLE_BYTES = 1 << 15
BUCKETS = 1 << 18
AFFIXES = (1, 2, 3, 4)
GRAM = 3
STRETCH = (4, 16)
LENGTH = 48
SEQUENCES = 3000
UNKNOWN = "und"


def _spread(code: np.ndarray, kind: int) -> np.ndarray:
    salt = np.uint64(kind * int(BASE) % (1 << 64))
    return (mixed(code + salt) & np.uint64(BUCKETS - 1)).astype(np.int64)


class WordFeatures:
    """Hashed features of the distinct words of a chunk: affixes and lexicon per word, n-grams in one list."""

    def __init__(self, hashes, joined, starts, ends):
        lengths, last = ends - starts, len(joined) - 1
        columns = [_spread(hashes, 1)]
        front = np.full(len(starts), 7, np.uint64)
        back = np.full(len(starts), 9, np.uint64)
        for k in range(max(AFFIXES)):
            # a word shorter than the affix repeats its outer mark, as its feature is then the whole word
            front = front * BASE + np.where(lengths > k, LOWER_BYTES[joined[np.minimum(starts + k, last)]], 1)
            back = back * BASE + np.where(lengths > k, LOWER_BYTES[joined[np.maximum(ends - 1 - k, 0)]], 1)
            if k + 1 in AFFIXES:
                columns += [_spread(front, 10 + k), _spread(back, 20 + k)]
        self.columns = columns
        counts = np.maximum(lengths - GRAM + 1, 0)
        self.gram_word = np.repeat(np.arange(len(starts)), counts)
        firsts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)
        code = np.full(len(firsts), 11, np.uint64)
        for k in range(GRAM):
            code = code * BASE + LOWER_BYTES[joined[firsts + k]]
        self.grams = _spread(code, 30)
        self.gram_share = (1 / np.maximum(counts, 1))[self.gram_word]
        self.words = len(starts)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Words x languages. The n-grams of a word count as their mean."""
        out = weights[self.columns[0]].astype(np.float64)
        for c in self.columns[1:]:
            out += weights[c]
        for y in range(weights.shape[1]):
            out[:, y] += np.bincount(self.gram_word, self.gram_share * weights[self.grams, y], minlength=self.words)
        return out

    def gradient(self, change: np.ndarray, languages: int) -> np.ndarray:
        out = np.zeros((BUCKETS, languages))
        for y in range(languages):
            for c in self.columns:
                out[:, y] += np.bincount(c, change[:, y], minlength=BUCKETS)
            out[:, y] += np.bincount(self.grams, change[self.gram_word, y] * self.gram_share, minlength=BUCKETS)
        return out


def forward_backward(scores: np.ndarray, moves: np.ndarray, ends: np.ndarray, with_moves: bool = False):
    """Chances of each word's language, for sequences laid end to end.

    ``scores`` (words x languages), ``moves`` (from x to) and ``ends`` (last word of each sequence, exclusive). Sequences are read
    side by side, longest first. Also the summed chances of moves, if asked.
    """
    n, k = scores.shape
    lengths = np.diff(ends, prepend=0)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    starts, sizes = (ends - lengths)[order], lengths[order]
    step = np.exp(moves - moves.max())
    given = np.exp(scores - scores.max(axis=1, keepdims=True))
    forward = np.empty_like(given)
    alive = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")  # sequences longer than t
    state = None
    for t, m in enumerate(alive):
        at = starts[:m] + t
        state = given[at] if t == 0 else (state[:m] @ step) * given[at]
        state = state / state.sum(axis=1, keepdims=True)
        forward[at] = state
    chances = np.empty_like(given)
    total = np.zeros((k, k))
    after = np.ones((len(order), k))
    for t in range(len(alive) - 1, -1, -1):
        m = alive[t]
        at = starts[:m] + t
        both = forward[at] * after[:m]
        chances[at] = both / both.sum(axis=1, keepdims=True)
        if t:
            ahead = given[at] * after[:m]
            if with_moves:
                pair = forward[at - 1][:, :, None] * step[None] * ahead[:, None, :]
                total += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            new = ahead @ step.T
            after[:m] = new / new.sum(axis=1, keepdims=True)
    return (chances, total) if with_moves else chances


class LanguageModel:
    """Weights per hashed feature and language, and transitions."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.weights = np.zeros((BUCKETS, len(languages)), np.float32)
        self.moves = np.zeros((len(languages), len(languages)))

    def fit(self, texts: list[bytes], labels: np.ndarray, rounds: int = 12, batch: int = 250) -> "LanguageModel":
        """Gradient steps with a pace of its own for each weight, on sequences that mix the languages."""
        words = [_words(t) for t in texts]
        own = [[w for w, y in zip(words, labels) if y == k and w] for k in range(len(self.languages))]
        present = [k for k, w in enumerate(own) if w]
        if len(present) < 1:
            return self
        draw = np.random.default_rng(23)
        squares, squares_moves = np.full(self.weights.shape, 1e-8), np.full(self.moves.shape, 1e-8)
        for step in range(rounds):
            for _ in range(max(1, SEQUENCES // batch // 4)):
                parts, truth, ends = [], [], []
                for _ in range(batch):
                    begin = len(truth)
                    while len(truth) - begin < LENGTH:
                        k = present[draw.integers(len(present))]
                        source = own[k][draw.integers(len(own[k]))]
                        size = int(draw.integers(*STRETCH))
                        at = int(draw.integers(max(1, len(source) - size)))
                        piece = source[at : at + size]
                        parts += piece
                        truth += [k] * len(piece)
                    ends.append(len(truth))
                self._step(b" ".join(parts), np.array(truth), np.array(ends), squares, squares_moves, 0.5 / (1 + 0.2 * step))
        return self

    def _step(self, text, truth, ends, squares, squares_moves, rate):
        chunks = [WordFeatures(*c[2:]) for c in word_chunks([text], LETTERS)]
        scores = np.concatenate([c.scores(self.weights) for c in chunks])
        chances, moved = forward_backward(scores, self.moves, ends, with_moves=True)
        seen = np.zeros_like(self.moves)
        inside = np.ones(len(truth), bool)
        inside[np.concatenate(([0], ends[:-1]))] = False
        at = np.flatnonzero(inside)
        np.add.at(seen, (truth[at - 1], truth[at]), 1)
        error = chances
        error[np.arange(len(truth)), truth] -= 1
        errors = np.split(error / len(truth), np.cumsum([c.words for c in chunks])[:-1])
        gradient = sum(c.gradient(e, len(self.languages)) for c, e in zip(chunks, errors)) + 1e-6 * self.weights
        squares += gradient**2
        self.weights -= (rate * gradient / np.sqrt(squares)).astype(np.float32)
        gradient = (moved - seen) / len(truth) + 1e-4 * self.moves
        squares_moves += gradient**2
        self.moves -= 0.2 * rate * gradient / np.sqrt(squares_moves)

    def word_scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all words (words x languages) and the number of words of each text.

        Within a chunk each distinct word is scored once.
        """
        totals, found = np.zeros(len(texts), np.int64), []
        for owners, counts, hashes, joined, starts, ends in word_chunks(texts, LETTERS):
            np.add.at(totals, owners, counts)
            _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            features = WordFeatures(hashes[first], joined, starts[first], ends[first])
            found.append(features.scores(self.weights).astype(np.float32)[inverse])
        return (np.concatenate(found) if found else np.zeros((0, len(self.languages)), np.float32)), totals

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The language of each text and the mean chance of it over the words."""
        scores, counts = self.word_scores(texts)
        ends = np.cumsum(counts)
        if not self.languages or not len(scores):
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        chances = forward_backward(scores.astype(np.float64), self.moves, ends)
        sums = np.concatenate((np.zeros((1, chances.shape[1])), np.cumsum(chances, axis=0)))
        means = (sums[ends] - sums[ends - counts]) / np.maximum(counts, 1)[:, None]
        best = means.argmax(axis=1)
        letters = [c > 0 and has_letter(t) for c, t in zip(counts, texts)]
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
        values = np.clip(means[np.arange(len(best)), best], 0, 1)
        return names, np.where(letters, values, 0.0)


def has_letter(text: bytes) -> bool:
    """Whether any character is a letter; bytes of broken characters are none."""
    return any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def _words(text: bytes) -> list[bytes]:
    _, _, _, joined, starts, ends = next(word_chunks([text], LETTERS))
    raw = joined.tobytes()
    return [raw[s:e] for s, e in zip(starts, ends)]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limit: int = SAMPLE) -> LanguageModel:
    """A model of the languages of the labelled documents outside the held-out part."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    # A finer bin for smaller hashes: a cut between bins leaves little more than ``limit`` documents of any number.
    small = rows.where(F.octet_length("text") <= SAMPLE_BYTES).withColumn("hash", F.xxhash64("id", "text"))
    place = F.floor(F.log2(F.shiftrightunsigned("hash", 1) + 1.0) * 8).cast("int")
    small = small.withColumn("place", place)
    sizes = small.groupBy("lang", "place").agg(F.approx_count_distinct("hash").alias("n")).collect()  # some 500 a language
    cuts, taken = {}, {}
    for r in sorted(sizes, key=lambda r: (r["lang"], r["place"])):
        if taken.get(r["lang"], 0) < 1.25 * limit:
            cuts[r["lang"]] = r["place"]
        taken[r["lang"]] = taken.get(r["lang"], 0) + r["n"]
    bounds = docs.sparkSession.createDataFrame(list(cuts.items()), "lang string, upto int")
    sample = small.join(F.broadcast(bounds), "lang").where("place <= upto").dropDuplicates(["lang", "hash"])
    picked: dict[str, list] = {}
    for r in sorted(sample.select("lang", "hash", "id", "text").collect(), key=lambda r: (r["lang"], r["hash"])):
        picked.setdefault(r["lang"], []).append((r["lang"], r["id"] is not None, r["id"], r["text"].encode()))
    found = sorted(row for own in picked.values() for row in own[:limit])
    languages = sorted({r[0] for r in found})
    if not languages:
        return LanguageModel([])
    number = {name: k for k, name in enumerate(languages)}
    return LanguageModel(languages).fit([r[-1] for r in found], np.array([number[r[0]] for r in found], np.int64))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, 4 << 20):
                names, values = shared.value.predict(text_bytes(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(names, pa.string()), pa.array(values, pa.float64())], ["id", "lang_pred", "score"]
                )

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
