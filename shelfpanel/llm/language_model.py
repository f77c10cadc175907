"""Log-probabilities of whole documents under a gated recurrent language model, trained here in numpy.

Tokens are words (runs without white space, A-Z folded, known by a 64-bit hash) and one end for each document. Counts of all words of
all training documents are gathered by Spark. The ``VOCAB`` - 2 most frequent words, the end and the unknown word make
the vocabulary of the network, in ``CLASSES`` classes by frequency. The output is factored: a softmax over classes, then one
over the words of the class. Its offsets start at the logarithms of the counts of the whole corpus. An unknown word
has the chance of the unknown token, times its share ``(c + 1) / (N' + V' + 1)`` among all training words outside the
vocabulary, so that the chances of all words seen, and of one word never seen, add up to 1.

Weights are fitted by truncated back-propagation through windows of ``WINDOW`` tokens on all training documents, whole: shards
of some ``SHARD`` documents train copies of the network, each on one of its ``SLICES`` slices at a time, and Spark averages the copies
after each slice (``averaging``). Documents are cut into segments of ``SEGMENT`` tokens, which start without a state, so that all
streams are of one length. Fewer than ``LEAST`` documents are read several times. Scoring reads every document whole: documents are laid
end to end in up to ``STREAMS`` streams, the state is carried from window to window and starts anew after an end.

Counts of the most frequent words, at most ``FREQUENT``, travel with the model (a bounded table); rarer words of a document are
joined with the count table by a shuffle, where no key is hot, as each has at most 1 / ``FREQUENT`` of all words (a
word that training never saw can be hot only if documents held out repeat it; Spark splits such a join).

Defined cases: null counts as empty; an empty text is one end; documents with a null id are training documents; repeated rows are
scored each by itself; without training documents every word is unknown, and the network has its first weights; an empty table gives no
rows; only the id and text columns are used.
"""

import copy
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.llm import averaging
from shelfpanel.llm.common import NOT_BLANK, batches_of, release_memory, stored, text_bytes, word_chunks

CLASSES, MEMBERS = 64, 64
VOCAB = CLASSES * MEMBERS
FREQUENT = 1 << 18
DIM = 24
HIDDEN = 32
WINDOW = 16
STREAMS = 256
STEPS = 200
SHARD = 8192
SLICES = 4
SEGMENT = 1024
LEAST = 3000
#: Tokens that a training task holds before it trains on them.
TOKENS = 1 << 21
END, UNKNOWN = 0, 1
#: Tokens that are scored at once, and rows of logits that a processor's cache holds.
SETTLED, BLOCK = 1 << 14, 1 << 10
#: Distinct words that a counting task holds before it hands them on.
HELD = 1 << 19
NEVER = -1e9


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each token occurs in all texts: ``key`` (hash of the word, null for the end), ``n``."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        ends, size, parts = 0, 0, []

        def rows():
            keys, counts = merged(*(np.concatenate(c) for c in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])

        for batch in batches:
            for part in batches_of(batch):
                ends += part.num_rows
                for _, _, hashes, *_ in word_chunks(text_bytes(part.column("text")), NOT_BLANK):
                    keys, counts = np.unique(hashes, return_counts=True)
                    parts.append((keys, counts.astype(np.int64)))
                    size += len(keys)
                if size > 2 * HELD:
                    parts = [merged(*(np.concatenate(c) for c in zip(*parts)))]
                    size = len(parts[0][0])
                    if size > HELD:
                        yield from rows()
                        parts, size = [], 0
        if parts:
            yield from rows()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([ends], pa.int64())], ["key", "n"])

    return texts.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def softmax(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For logits: powers that are the chances of each row times its sum, the sums, and what was taken off the logits."""
    base, ones = x.max(initial=NEVER), np.ones(x.shape[1], x.dtype)
    if base < 60:  # no power is too large
        base = x.dtype.type(0)
        e = np.exp(x)
    else:
        e = x - base
        np.exp(e, out=e)
    sums = e @ ones
    if sums.min(initial=1) < 1e-20:  # rows far below the largest
        base = x.max(axis=1)
        e = np.exp(x - base[:, None])
        sums = e @ ones
    return e, sums, base


class Streams:
    """Documents laid end to end in streams of nearly equal length, longest stream first.

    ``tokens``, and ``before`` with the one that precedes each, lie step by step: first tokens of all streams, then second ones."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, most: int):
        starts = np.cumsum(lengths) - lengths
        loads = [(0, i) for i in range(min(most, len(lengths)))]
        held: list[list[int]] = [[] for _ in loads]
        for doc in np.argsort(-lengths, kind="stable"):
            load, i = heapq.heappop(loads)
            held[i].append(int(doc))
            heapq.heappush(loads, (load + int(lengths[doc]), i))
        sizes = {i: load for load, i in loads}
        order = sorted(sizes, key=lambda i: -sizes[i])
        self.sizes = np.array([sizes[i] for i in order], np.int64)
        self.docs = np.array([d for i in order for d in held[i]], np.int64)
        self.lengths = lengths[self.docs]
        self.starts = np.cumsum(self.lengths) - self.lengths
        mine = np.concatenate([tokens[a : a + n] for a, n in zip(starts[self.docs].tolist(), self.lengths.tolist())]) if len(tokens) else tokens
        before = np.concatenate(([END], mine[:-1])).astype(mine.dtype)
        before[self.starts] = END  # a document, or a segment of one, follows an end
        # streams that run in each step, and where the step begins
        running = np.searchsorted(-self.sizes, -np.arange(int(self.sizes[0]) if len(self.sizes) else 0), side="left")
        self.cuts = np.concatenate(([0], np.cumsum(running))).astype(np.int32)
        self.places = np.concatenate([self.cuts[:n] + np.int32(i) for i, n in enumerate(self.sizes)]) if len(mine) else self.docs
        self.tokens, self.before = np.empty_like(mine), np.empty_like(mine)
        self.tokens[self.places], self.before[self.places] = mine, before

    def windows(self, size: int):
        """The steps of each window, as slices of the tokens."""
        cuts = self.cuts.tolist()
        for first in range(0, len(cuts) - 1, size):
            own = cuts[first : first + size + 1]
            yield [slice(a, b) for a, b in zip(own, own[1:])]


class GatedModel:
    """A gated recurrent network with class-factored output, and the counts that unknown words need."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, ends: int, total: int, distinct: int, seed: int = 7):
        """``keys``: hashes of the most frequent words, most frequent first, with their ``counts``; ``ends``: documents;
        ``total`` and ``distinct``: all training tokens, the end included."""
        draw = np.random.default_rng(seed)
        self.total, self.distinct, self.ends = total, distinct, ends
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        inside = min(len(keys), VOCAB - 2)
        rank = np.arange(len(keys))[order]
        self.token = np.where(rank < inside, rank + 2, UNKNOWN).astype(np.int32)
        known = int(counts[:inside].sum())
        self.rest = total - known - ends + distinct - inside - (ends > 0) + 1  # N' + V' + 1 of the unknown words
        mass = np.zeros(VOCAB)
        mass[END], mass[UNKNOWN] = ends + 1, total - known - ends + 1
        mass[2 : 2 + inside] = counts[:inside]
        mass = mass.reshape(CLASSES, MEMBERS)
        sums = mass.sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            word_offset = np.where(mass > 0, np.log(mass / sums), NEVER)
            class_offset = np.where(sums > 0, np.log(sums / sums.sum()), NEVER)[:, 0]
        self.weights = {
            "inputs": draw.normal(0, 0.1, (VOCAB, DIM)),
            "gates": draw.normal(0, 1 / np.sqrt(DIM), (DIM, 3 * HIDDEN)),
            "gate_offset": np.zeros(3 * HIDDEN),
            "state": draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)),
            "classes": np.zeros((CLASSES, HIDDEN)),
            "class_offset": class_offset,
            "words": np.zeros((CLASSES, MEMBERS, HIDDEN)),
            "word_offset": word_offset,
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}
        self.entry: tuple[np.ndarray, ...] | None = None
        self.starts: np.ndarray | None = None
        self.squares = {k: np.full(v.shape, 1e-4, np.float32) for k, v in self.weights.items()}  # what training needs

    # Tokens

    def numbered(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token of each word, and its count where the word is a frequent one, else -1."""
        if not len(self.keys):
            return np.full(len(hashes), UNKNOWN, np.int32), np.full(len(hashes), -1, np.int64)
        at = self.places(hashes)
        same = self.keys[at] == hashes
        return np.where(same, self.token[at], np.int32(UNKNOWN)), np.where(same, self.counts[at], -1)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of the first key that is not less, or the last place: some steps on from the first key with the same first bits."""
        last = len(self.keys) - 1
        bits = np.uint64(64 - min(last.bit_length() + 2, 20))
        if self.starts is None:
            firsts = np.arange(1 << (64 - int(bits)), dtype=np.uint64) << bits
            self.starts = np.minimum(np.searchsorted(self.keys, firsts), last).astype(np.int32)
        at = self.starts[hashes >> bits]
        less = np.flatnonzero(self.keys[at] < hashes)
        for _ in range(8):
            at[less] += 1
            less = less[at[less] <= last]
            less = less[self.keys[at[less]] < hashes[less]]
        at[less] = np.searchsorted(self.keys, hashes[less])
        return np.minimum(at, last)

    # The network

    def _products(self):
        """What the states are multiplied with: the three gates, and classes and words with their offsets as last column.

        Gates lie one below the other (update, reset, content), so that each is whole in memory; those of the first two are negative."""
        w = self.weights
        state = w["state"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2).copy()
        state[:2] *= -1
        classes = np.concatenate((w["classes"], w["class_offset"][:, None]), axis=1)
        words = np.concatenate((w["words"], w["word_offset"][:, :, None]), axis=2)
        return state, classes, words

    def _entries(self, inputs: np.ndarray) -> np.ndarray:
        """What each of the rows of ``inputs`` adds to the three gates, those of the first two negative."""
        w = self.weights
        out = np.matmul(inputs, w["gates"].reshape(DIM, 3, HIDDEN).transpose(1, 0, 2)) + w["gate_offset"].reshape(3, 1, HIDDEN)
        out[:2] *= -1
        return out

    def _ready(self):
        """Entries of all tokens, and the products; kept until weights change."""
        if self.entry is None:
            self.entry = self._entries(self.weights["inputs"]), *self._products()
        return self.entry

    def steps(self, before: list[np.ndarray], state: np.ndarray, ready=None):
        """States after each step of a window; the last ones; what back-propagation needs, the states one below the other first.

        ``ready``: entries, the entry of each token, and the products of the states; without it those of all tokens serve, and
        nothing is kept for back-propagation."""
        seen, keep = np.concatenate(before), ready is not None
        entry, places, to_gates = ready or (self._ready()[0], seen, self._ready()[1])
        n, most = len(seen), len(before[0])
        states = np.empty((n, HIDDEN), entry.dtype)
        held, cells = (np.empty((n if keep else most, HIDDEN), entry.dtype) for _ in range(2))
        gates = np.empty((4, len(held), HIDDEN), entry.dtype)  # of the content what the state adds, update, reset, of the content the rest
        added = np.empty((2, most, HIDDEN), entry.dtype)
        ends = np.flatnonzero(seen == END)
        cuts = np.cumsum([0, *map(len, before)]).tolist()
        marks = ends.searchsorted(cuts).tolist()
        dead = []
        with np.errstate(over="ignore"):
            for a, b, first, last in zip(cuts, cuts[1:], marks, marks[1:]):
                own = slice(a, b) if keep else slice(0, b - a)
                h, c, (m, z, r, x) = held[own], cells[own], gates[:, own]
                h[:] = state[: b - a]
                dead.append(ends[first:last] - a)
                if first < last:
                    h[dead[-1]] = 0
                for table, out in zip(entry, (z, r, x)):
                    table.take(places[a:b], axis=0, out=out, mode="clip")
                zr = gates[1:3, own]
                zr += np.matmul(h, to_gates[:2], out=added[:, : b - a])
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                np.matmul(h, to_gates[2], out=m)
                np.multiply(r, m, out=c)
                c += x
                np.tanh(c, out=c)
                state = np.subtract(h, c, out=states[a:b])
                state *= z
                state += c
        return [states[a:b] for a, b in zip(cuts, cuts[1:])], state, (states, dead, held, gates, cells)

    def _by_class(self, targets: np.ndarray):
        """An order of the targets by class, and the part of each class in it: (class, start, end)."""
        classes = (targets // MEMBERS).astype(np.int16)
        order = np.argsort(classes, kind="stable")
        cuts = np.searchsorted(classes[order], np.arange(CLASSES + 1))
        return order, [(k, int(a), int(b)) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]

    def _sorted_states(self, states: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The states in the given order, with a last column of ones for the offsets."""
        out = np.empty((len(states), HIDDEN + 1), states.dtype)
        out[:, :HIDDEN] = np.take(states, order, axis=0)
        out[:, HIDDEN] = 1
        return out

    def log_chances(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithm of the chance of each target after its state."""
        _, _, classes, words = self._ready()
        order, parts = self._by_class(targets)
        s, y = self._sorted_states(states, order), targets[order]
        found, rows = np.empty(len(y), s.dtype), np.arange(min(len(y), BLOCK)) * CLASSES
        for a in range(0, len(y), BLOCK):
            x = s[a : a + BLOCK] @ classes.T
            _, sums, base = softmax(x)
            found[a : a + BLOCK] = x.ravel()[rows[: len(x)] + y[a : a + BLOCK] // MEMBERS] - base - np.log(sums)
        rows, held = np.arange(len(y)) * MEMBERS, []
        for k, first, end in parts:
            held.append((k, first, end))
            if end - held[0][1] < BLOCK and k != parts[-1][0]:
                continue
            start = held[0][1]
            x = np.empty((end - start, MEMBERS), s.dtype)
            for k, a, b in held:
                np.matmul(s[a:b], words[k].T, out=x[a - start : b - start])
            held = []
            _, sums, base = softmax(x)
            found[start:end] += x.ravel()[rows[: len(x)] + y[start:end] % MEMBERS] - base - np.log(sums)
        out = np.empty(len(y), s.dtype)
        out[order] = found
        return out

    def score(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Natural logarithm of the chance of each document (its words and its end), read whole."""
        laid = Streams(tokens, lengths, STREAMS)
        found = np.zeros(len(tokens), np.float32)
        state = np.zeros((len(laid.sizes), HIDDEN), np.float32)
        held, done, size = [], 0, 0

        def settle():
            found[done : done + size] = self.log_chances(np.concatenate(held), laid.tokens[done : done + size])

        for window in laid.windows(WINDOW):
            _, state, (states, *_) = self.steps([laid.before[p] for p in window], state)
            held.append(states)
            size += len(states)
            if size >= SETTLED:
                settle()
                held, done, size = [], done + size, 0
        if held:
            settle()
        out = np.zeros(len(lengths))
        if len(lengths):
            out[laid.docs] = np.add.reduceat(found[laid.places].astype(np.float64), laid.starts)
        return out

    def gradients(self, before: list[np.ndarray], targets: list[np.ndarray], state: np.ndarray):
        """Loss per token, gradients of all weights, and the state after the window."""
        w, seen = self.weights, np.concatenate(before)
        times = np.bincount(seen, minlength=VOCAB)
        hit = np.flatnonzero(times)
        place = np.empty(VOCAB, np.int64)
        place[hit] = np.arange(len(hit))
        place, own_inputs = place[seen], w["inputs"][hit]
        to_gates, classes, words = self._products()
        _, last, (states, dead, held, gates, cells) = self.steps(before, state, (self._entries(own_inputs), place, to_gates))
        y = np.concatenate(targets)
        n, rows = len(y), np.arange(len(y))
        order, parts = self._by_class(y)
        s, y = self._sorted_states(states, order), y[order]
        x = s @ classes.T
        error, sums, base = softmax(x)
        at = rows * CLASSES + y // MEMBERS
        loss = -(x.ravel()[at] - base - np.log(sums)).sum()
        error *= (1 / (sums * n))[:, None]
        error.ravel()[at] -= 1 / n
        of_classes = error.T @ s
        back = error @ w["classes"]
        x = np.empty((n, MEMBERS), s.dtype)
        for k, a, b in parts:
            np.matmul(s[a:b], words[k].T, out=x[a:b])
        error, sums, base = softmax(x)
        at = rows * MEMBERS + y % MEMBERS
        loss -= (x.ravel()[at] - base - np.log(sums)).sum()
        error *= (1 / (sums * n))[:, None]
        error.ravel()[at] -= 1 / n
        of_words, more = np.zeros_like(words), np.empty_like(back)
        for k, a, b in parts:
            own = error[a:b]
            np.matmul(own.T, s[a:b], out=of_words[k])
            np.matmul(own, w["words"][k], out=more[a:b])
        back += more
        back_at = np.empty(n, np.int64)
        back_at[order] = rows
        gained = np.take(back, back_at, axis=0)
        later = np.zeros_like(last)
        side = gates  # in its place: content times reset, update, reset, content
        spare = np.empty((4, len(before[0]), HIDDEN), back.dtype)
        to_state = w["state"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 2, 0)[[2, 0, 1]]
        a = n
        for tokens, ended in zip(reversed(before), reversed(dead)):
            a, b = a - len(tokens), a
            d = gained[a:b]
            d[: len(later)] += later  # fewer streams may run in the later step
            h, c, (m, z, r, dc) = held[a:b], cells[a:b], side[:, a:b]
            rest, kept = spare[1, : b - a], spare[3, : b - a]
            np.multiply(d, z, out=kept)
            np.subtract(d, kept, out=dc)
            np.subtract(h, c, out=rest)
            z *= rest
            z *= dc
            c *= c
            np.subtract(1, c, out=c)
            dc *= c
            np.subtract(1, r, out=rest)
            rest *= m
            np.multiply(dc, r, out=m)
            np.multiply(m, rest, out=r)
            later, *others = np.matmul(side[:3, a:b], to_state, out=spare[:3, : b - a])
            for other in (*others, kept):
                later += other
            if len(ended):
                later[ended] = 0
        flat = lambda x: x.transpose(1, 0, 2).reshape(-1, 3 * HIDDEN)
        # summed by token; two columns as one complex number, as each group and column is a call
        pairs = np.take(side[1:], np.argsort(seen.astype(np.int16), kind="stable"), axis=1).view(np.result_type(side, 1j))
        summed = flat(np.add.reduceat(pairs, np.cumsum(times[hit]) - times[hit], axis=1).view(side.dtype))
        grads = {
            "classes": of_classes[:, :HIDDEN],
            "class_offset": of_classes[:, HIDDEN],
            "words": of_words[:, :, :HIDDEN],
            "word_offset": of_words[:, :, HIDDEN],
            "state": flat(np.matmul(held.T, side[:3])[[1, 2, 0]]),
            "gates": own_inputs.T @ summed,
            "gate_offset": summed.sum(axis=0),
        }
        return loss / n, grads, (hit, summed @ w["gates"].T), last

    def numbers(self) -> np.ndarray:
        """All that training changes; a row of inputs is one row."""
        return averaging.flat([*self.weights.values(), *self.squares.values()], DIM)

    def take(self, table: np.ndarray) -> None:
        found = averaging.unflat(table, [v.shape for v in [*self.weights.values(), *self.squares.values()]])
        self.weights = dict(zip(self.weights, found))
        self.squares = dict(zip(self.squares, found[len(self.weights) :]))
        self.entry = None

    def copied(self) -> "GatedModel":
        """A copy with weights of its own."""
        out = copy.copy(self)
        out.weights, out.squares = ({k: v.copy() for k, v in x.items()} for x in (self.weights, self.squares))
        return out

    def fit(self, tokens: np.ndarray, lengths: np.ndarray, streams: int | None = None, rate: float = 0.12) -> "GatedModel":
        """Truncated back-propagation over the documents: steps of Adagrad, the state carried between windows.

        Without ``streams``, 64 of them, and up to ``STREAMS`` where that leaves ``STEPS`` steps."""
        if not len(tokens):
            return self
        squares, w = self.squares, self.weights
        streams = streams or min(max(len(tokens) // (WINDOW * STEPS), 64), STREAMS)
        laid = Streams(tokens, segments(lengths), streams)
        state = np.zeros((len(laid.sizes), HIDDEN), np.float32)
        spare = {k: np.empty_like(v) for k, v in w.items()}
        for window in laid.windows(WINDOW):
            self.entry = None
            before, targets = [laid.before[p] for p in window], [laid.tokens[p] for p in window]
            _, grads, (hit, rows), state = self.gradients(before, targets, state)
            for k, g in grads.items():
                change = np.multiply(g, g, out=spare[k])
                squares[k] += change
                np.sqrt(squares[k], out=change)
                np.divide(g, change, out=change)
                change *= rate
                w[k] -= change
            own = np.take(squares["inputs"], hit, axis=0)
            own += rows * rows
            squares["inputs"][hit] = own
            np.sqrt(own, out=own)
            rows *= rate
            w["inputs"][hit] -= np.divide(rows, own, out=rows)
        self.entry = None
        return self


def segments(lengths: np.ndarray) -> np.ndarray:
    """Lengths of the segments that documents of the given lengths are cut into."""
    parts = -(-lengths // SEGMENT)
    out = np.full(parts.sum(), SEGMENT, np.int64)
    out[np.cumsum(parts) - 1] = lengths - (parts - 1) * SEGMENT
    return out


def joined(words: list[np.ndarray], owners: list[np.ndarray], n: int) -> np.ndarray:
    """Tokens of ``n`` texts, each with its end, from those of their words in order and the text of each."""
    if not words:
        return np.full(n, END, np.int32)
    words, owner = np.concatenate(words), np.concatenate(owners)
    tokens = np.full(len(words) + n, END, np.int32)
    owner += np.arange(len(words), dtype=np.int32)
    tokens[owner] = words
    return tokens


def training_tokens(model: GatedModel, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts with their ends, and lengths."""
    lengths, words, owner_of = np.zeros(len(texts), np.int64), [], []
    for owners, counts, hashes, *_ in word_chunks(texts, NOT_BLANK):
        at = model.places(hashes) if len(model.keys) else None
        words.append(np.full(len(hashes), UNKNOWN, np.int32) if at is None else np.where(model.keys[at] == hashes, model.token[at], np.int32(UNKNOWN)))
        owner_of.append(np.repeat(owners.astype(np.int32), counts))
        np.add.at(lengths, owners, counts)
    return joined(words, owner_of, len(texts)), lengths + 1


def tokens_of(model: GatedModel, texts: list[bytes]):
    """Tokens of all texts with their ends, lengths, and for each text the sums that need the counts: known words, sum
    of ``log10(c + 1)`` of frequent words, the same of those that are unknown to the network, unknown words; then hashes
    of words outside the frequent ones with their texts."""
    n = len(texts)
    lengths, known, logs, unknown_logs, unknown = (np.zeros(n, t) for t in (np.int64, np.int64, float, float, np.int64))
    parts, rare, rare_owner, owner_of = [], [], [], []
    for owners, counts, hashes, *_ in word_chunks(texts, NOT_BLANK):
        tokens, seen = model.numbered(hashes)
        owner = np.repeat(owners, counts)
        np.add.at(lengths, owners, counts)
        log = np.log10(np.maximum(seen, 0) + 1.0)
        out = tokens == UNKNOWN
        known += np.bincount(owner, seen > 0, n).astype(np.int64)
        logs += np.bincount(owner, log, n)
        unknown_logs += np.bincount(owner, log * out, n)
        unknown += np.bincount(owner, out, n).astype(np.int64)
        parts.append(tokens)
        owner_of.append(owner.astype(np.int32))
        rare.append(hashes[seen < 0])
        rare_owner.append(owner[seen < 0])
    tokens = joined(parts, owner_of, n)
    rare = np.concatenate(rare) if rare else np.zeros(0, np.uint64)
    rare_owner = np.concatenate(rare_owner) if rare_owner else np.zeros(0, np.int64)
    return tokens, lengths + 1, (known, logs, unknown_logs, unknown), rare, rare_owner


def lists_of(owner: np.ndarray, keys: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """Distinct keys of each of ``n`` owners and how often each occurs, as two list columns."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    if len(keys):
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])))
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(keys))).astype(np.int32)
        owner, keys = owner[first], keys[first]
    else:
        times = np.zeros(0, np.int32)
    offsets = pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32))
    return (
        pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64))),
        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
    )


def fitted(rows: DataFrame, model: GatedModel) -> np.ndarray:
    """``model.numbers()`` after its copies have read all ``rows`` of their shards."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        first = shared.value.numbers()
        now, local, held, size = None, None, [], 0

        def settle():
            if held:
                local.fit(*(np.concatenate(x) for x in zip(*held)))
                held.clear()

        for shard, part in averaging.runs_of(batches, 2 << 20):
            if shard != now:
                if local is not None:
                    settle()
                    yield from averaging.changes(first, local.numbers())
                now, local, size = shard, shared.value.copied(), 0
            tokens, lengths = training_tokens(local, text_bytes(part.column("text")))
            held.append((tokens, lengths))
            size += len(tokens)
            if size > TOKENS:
                settle()
                size = 0
        if local is not None:
            settle()
            yield from averaging.changes(first, local.numbers())

    return averaging.averaged(averaging.by_core(rows.select("shard", "text")).mapInArrow(run, averaging.schema(DIM)), model.numbers())


def train(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[GatedModel, DataFrame]:
    """The model of the rows of ``docs`` for which ``training`` holds, and the table of all their word counts."""
    own = docs.where(training).select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    counts = stored(word_counts(own))
    total, distinct, ends = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0))
    ).first()
    # the least count of the frequent words, so that no task sorts the words of the others
    least = averaging.most_frequent(counts.where(F.col("key").isNotNull()), FREQUENT)
    top = counts.where(F.col("key").isNotNull() & (F.col("n") >= least)) if least else counts.limit(0)
    top = top.toArrow().sort_by([("n", "descending"), ("key", "ascending")])
    keys = top.column("key").to_numpy().astype(np.int64).view(np.uint64)
    model = GatedModel(keys, top.column("n").to_numpy().astype(np.int64), ends, total, distinct)
    mix = F.xxhash64("id", "text")
    rows = averaging.sharded(own.select(mix.alias("mix"), "text"), ends, SHARD, ["mix", "text"])
    for turn in range(min(8, -(-LEAST // max(ends, 1)))):
        for part in range(SLICES):
            model.take(fitted(rows.where(F.pmod(F.shiftright("mix", 8), F.lit(SLICES)) == part), model))
    model.squares = {}
    del top
    release_memory()
    return model, counts


def score(docs: DataFrame, model: GatedModel, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (smoothed word counts alone) and ``score``
    (the model), both decimal logarithms."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "n_tokens", "n_known", "base_score", "score", "rare", "times"]

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in batches_of(batch, 12 << 20):
                texts = text_bytes(part.column("text"))
                tokens, lengths, (known, logs, unknown_logs, unknown), rare, owner = tokens_of(model, texts)
                chances = model.score(tokens, lengths) / np.log(10)
                base = logs + np.log10(model.ends + 1) - lengths * np.log10(model.total + model.distinct + 1)
                chances += unknown_logs - unknown * np.log10(model.rest)
                known = known + (model.ends > 0)
                columns = [part.column("id"), *map(pa.array, (lengths, known, base, chances)), *lists_of(owner, rare, len(texts))]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, rare array<bigint>, times array<int>"
    scored = stored(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    others = counts.where(F.col("key").isNotNull())
    if len(model.counts):
        others = others.where(F.col("n") < int(model.counts.min()))
    sums = (
        rare.join(others, "key")
        .groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    )
    logs = F.coalesce(F.col("logs"), F.lit(0.0))
    return scored.drop("rare", "times").join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce(F.col("more"), F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base_score") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
