"""BPE encoding and decoding with a given word-level vocabulary (ends of words marked by a suffix).

A word's parts and the ranks of its adjacent pairs lie in two plain lists: the smallest rank is searched, the
boundary there deleted, and the two neighbouring ranks looked up again. A word of more than ``SHORT`` parts is
merged with a heap instead, since searching a long list for each merge takes quadratic time. Words repeat, so
each Python process keeps the ids of up to ``KNOWN`` words.

The vocabulary file is read on the driver, is a few MB whatever the data, and is broadcast. Documents are
encoded where they lie: no shuffle.

Defined cases: null counts as empty; an empty text has no ids and decodes to an empty text; texts of any length
are read whole, in a pass; repeated rows give repeated results; only the id and text columns are used.
"""

import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.llm.common import batches_of

SHORT = 128
KNOWN = 150_000
NONE = 1 << 60
#: White space as Unicode has it. Python's own class also holds four control characters.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The contractions that the vocabulary's splitter knows (fixed values).
TAILS = "'s|'t|'re|'ve|'m|'ll|'d"
WORDS = regex.compile(TAILS + r"|\p{L}+|\p{N}|[^" + BLANK + r"\p{L}\p{N}]+")
ASCII_WORDS = re.compile(TAILS + r"|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def byte_letters() -> list[str]:
    """The letter for each byte: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for one vocabulary file (its content as text)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {}
        for rank, (a, b) in enumerate(pairs):
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.suffix] for c in letters]
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}

    def word_ids(self, word: str) -> list[int]:
        raw = word.encode()
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        return self.merged_short(parts) if len(parts) <= SHORT else self.merged_long(parts)

    def merged_short(self, parts: list[int]) -> list[int]:
        pair = self.merges.get
        ranks = [pair(p, (NONE, 0))[0] for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            parts[i] = pair((parts[i], parts[i + 1]))[1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = pair((parts[i - 1], parts[i]), (NONE, 0))[0]
            if i < len(ranks):
                ranks[i] = pair((parts[i], parts[i + 1]), (NONE, 0))[0]
        return parts

    def merged_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.merges[p][0], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = self.merges[a, b][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (p := (parts[k], parts[after[k]])) in self.merges:
                    heapq.heappush(heap, (self.merges[p][0], k, *p))
        return [p for p in parts if p >= 0]

    def packed(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            ids = self.known[word] = np.array(self.word_ids(word), dtype="<u4").tobytes()
        return ids

    def plain_ids(self, text: str) -> bytes:
        if text.isascii():
            words = ASCII_WORDS.findall(text.lower())
        else:  # each letter is lowered for itself: a final sigma is no exception
            words = WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        packed = self.packed
        return b"".join([packed(w) for w in words])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; special tokens in it get their own ids."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain_ids(text)
        out = []
        for part in self.cut.split(text):
            special = self.special.get(part)
            out.append(self.plain_ids(part) if special is None else np.array([special], dtype="<u4").tobytes())
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Tokens joined by blanks: the vocabulary comes without rules for decoding."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_loaded: dict[int, WordBpe] = {}


def _codec(content) -> WordBpe:
    """The codec of a broadcast file, made once in each Python process."""
    if content.value[0] not in _loaded:
        _loaded.clear()
        _loaded[content.value[0]] = WordBpe(content.value[1])
    return _loaded[content.value[0]]


def encode_decode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids`` (packed little-endian uint32) and ``decoded`` (text made from the ids)."""
    with open(vocab_path, encoding="utf-8") as f:
        text = f.read()
    content = docs.sparkSession.sparkContext.broadcast((hash(text), text))
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def run(batches):
        codec = _codec(content)
        for batch in batches:
            for part in batches_of(batch, 2 << 20):
                ids = [codec.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([codec.decode(x) for x in ids], pa.string()),
                    ],
                    ["id", "n_tokens", "ids", "decoded"],
                )

    kind = picked.schema["id"].dataType.simpleString()
    out = picked.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary, decoded string")
    return out.withColumnRenamed("id", id_col)
