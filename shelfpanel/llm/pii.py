"""Information-theoretic sanitisation of personal data.

Personal values (mail and IP addresses, card and phone numbers) are found by pattern in every whole text. Counts over the whole
corpus tell how strongly a word reveals a value: with p taken from document counts, the disclosure of value v by term t is
PMI(v, t) / IC(v) = log(N n(v,t) / (n(v) n(t))) / log(N / n(v)), which is 1 where t occurs with v only. All counts are of whole
texts: n(v,t) is the number of documents that hold v and, outside values, t at any distance. Terms that reach a threshold,
and hold it in at least two different texts, are marked wherever they stand in a text with the value and, with ``everywhere``, in
all other texts too; ``sanitised`` then puts a general label in place of a value or term, or removes terms of an even higher disclosure.

Counts are aggregated before each shuffle. Only values of two different texts are paired. As n(v,t) is at most n(v), a term of more than
N (n(v) / N) ** threshold documents cannot reach the threshold; bit tables of fixed size, one for each power of 8 of that bound, leave such
pairs out. They let some others pass; the joins after them are exact.

Defined cases: null counts as empty; an empty table gives an empty result; a value in all documents discloses nothing;
repeated rows (same id and text) give repeated results and count as documents; positions are code points, ends exclusive;
only the id and text columns are used.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.llm.common import (
    LETTERS, SLOTS, batches_of, slot_is_taken, stored, taken_slots, text_bytes, word_chunks, word_hashes,
)

KINDS = ["email", "ip", "card", "phone"]
THRESHOLD = 0.8
STEP = 8
REMOVE = 0.98
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits is tried from its first digit only: from a later one the rest is the same.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
TERM = re.compile("[A-Za-z\x80-\U0010ffff]+")


def emails(text: str):
    """Leftmost matches: the local part is the run of its letters before an ``@``, back to the last match at most."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def is_ip(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in value.split("."))


def is_card(value: str) -> bool:
    digits = [ord(c) - 48 for c in value if c not in " -"]
    if not 13 <= len(digits) <= 19:
        return False
    doubled = [d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def is_phone(value: str) -> bool:
    return 9 <= len(DIGIT.findall(value)) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all values, by kind and start."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if is_ip(m.group())]
        out += [("card", *m.span()) for m in CARD.finditer(text) if is_card(m.group())]
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if is_phone(m.group())]
    return out


def entity(kind: str, value: str) -> str:
    """A value by which its spellings count as one."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(DIGIT.findall(value))}"


def entities_of(text: str, spans) -> list[int]:
    """64-bit hashes of the distinct values."""
    names = sorted({entity(kind, text[s:e]) for kind, s, e in spans})
    return [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little", signed=True) for n in names]


def terms_of(text: str, spans) -> list[tuple[int, int]]:
    """(start, end) of all terms, values and what overlaps them left out."""
    taken = sorted((s, e) for _, s, e in spans)
    terms, i = [], 0
    for m in TERM.finditer(text):
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if all(e <= m.start() or s >= m.end() for s, e in taken[i : i + len(KINDS)]):
            terms.append(m.span())
    return terms


def without_values(text: str, spans) -> str:
    """``text`` without its values and the terms that overlap them; the other terms stay apart and in order."""
    out, last = [], 0
    for start, end in sorted((s, e) for _, s, e in spans):
        if TERM.match(text[start]):
            while start > last and TERM.match(text[start - 1]):
                start -= 1
        found = TERM.match(text, end) if TERM.match(text[end - 1]) else None
        if start > last:
            out.append(text[last:start])
        last = max(last, found.end() if found else end)
    return "\n".join([*out, text[last:]])


def slots_of(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) & np.uint64(SLOTS - 1)).astype(np.int64)


def bits_of(keys: DataFrame) -> np.ndarray:
    """The bit table of a column of 64-bit hashes."""
    return taken_slots(keys, F.pmod(F.col(keys.columns[0]), F.lit(SLOTS)))


def find_values(rows: DataFrame) -> DataFrame:
    """For rows of ``id``, ``code`` and ``text``: counts, base spans and entities."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in batches_of(batch):
                counts, bases, entities = [[] for _ in KINDS], [], []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    spans = base_spans(text)
                    for k, name in enumerate(KINDS):
                        counts[k].append(sum(s[0] == name for s in spans))
                    bases.append(",".join(f"{n}:{s}:{e}" for n, s, e in spans))
                    entities.append(entities_of(text, spans))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("code"), *[pa.array(c, pa.int64()) for c in counts], pa.array(bases, pa.string()),
                        pa.array(entities, pa.list_(pa.int64())),
                    ],
                    ["id", "code", *[f"n_{k}" for k in KINDS], "base", "entities"],
                )

    numbers = ", ".join(f"n_{k} bigint" for k in KINDS)
    return rows.mapInArrow(run, f"id {kind}, code bigint, {numbers}, base string, entities array<bigint>")


def held_terms(part, holders: np.ndarray):
    """Of the texts that may hold a shared value: (code, text, spans) and the distinct term hashes of each."""
    codes = part.column("code").to_numpy(zero_copy_only=False)
    at = np.flatnonzero(slot_is_taken(holders, slots_of(codes)))
    texts = [t or "" for t in part.column("text").take(pa.array(at)).to_pylist()]
    spans = [base_spans(t) for t in texts]
    hashes, counts = word_hashes([without_values(t, s).encode() for t, s in zip(texts, spans)], LETTERS)
    groups = np.split(hashes.astype(np.int64), np.cumsum(counts)[:-1]) if len(texts) else []
    return [(int(codes[i]), t, s, np.unique(g)) for i, t, s, g in zip(at, texts, spans, groups)]


def candidate_terms(rows: DataFrame, holders) -> DataFrame:
    """Terms of texts with a shared value (hashes), each once per batch."""

    def run(batches):
        for batch in batches:
            for part in batches_of(batch):
                found = [g for *_, g in held_terms(part, holders.value)]
                terms = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64())], ["term"])

    return rows.select("code", "text").mapInArrow(run, "term bigint")


def pair_counts(rows: DataFrame, holders, levels) -> DataFrame:
    """Documents with both, of each pair of a shared value and a term not too frequent for it: ``entity``, ``term``, ``n_pair``.

    ``levels`` has bit tables of values and of the terms that they may be paired with, by rising bound.
    """

    def run(batches):
        names = ["entity", "term", "code"]
        for batch in batches:
            for part in batches_of(batch):
                for code, text, spans, terms in held_terms(part, holders.value):
                    left = np.array(entities_of(text, spans), np.int64)
                    for values, allowed in reversed(levels.value):
                        here = slot_is_taken(values, slots_of(left))
                        own, left = left[here], left[~here]
                        fit = terms[slot_is_taken(allowed, slots_of(terms))] if len(own) else terms[:0]
                        step = max(1, (1 << 18) // max(1, len(fit)))
                        for k in range(0, len(own) if len(fit) else 0, step):
                            some = own[k : k + step]
                            columns = [np.repeat(some, len(fit)), np.tile(fit, len(some)), np.full(len(some) * len(fit), code)]
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    found = rows.select("code", "text").mapInArrow(run, "entity bigint, term bigint, code bigint")
    return (
        found.groupBy("entity", "term").agg(F.count("*").alias("n_pair"), F.min("code").alias("low"), F.max("code").alias("high"))
        .where("low < high").select("entity", "term", "n_pair")
    )


def places_of(rows: DataFrame, terms: DataFrame, everywhere: bool) -> DataFrame:
    """Where the ``terms`` (hashes) stand outside values, for each text and term: id, ``code``, ``entities`` of the text (none with
    ``everywhere``), ``term``, ``places``."""
    bits = rows.sparkSession.sparkContext.broadcast(bits_of(terms))
    kind = rows.schema["id"].dataType.simpleString()
    place = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in batches_of(batch):
                raw, hit = text_bytes(part.column("text")), set()
                for owners, counts, hashes, *_ in word_chunks(raw, LETTERS):
                    hit.update(np.repeat(owners, counts)[slot_is_taken(bits.value, slots_of(hashes))].tolist())
                ids, codes = part.column("id"), part.column("code")
                for i in sorted(hit):
                    text = raw[i].decode()
                    spans = base_spans(text)
                    found = terms_of(text, spans)
                    hashes, _ = word_hashes(["\n".join(text[a:b] for a, b in found).encode()], LETTERS)
                    kept = np.flatnonzero(slot_is_taken(bits.value, slots_of(hashes)))
                    by_term = {}
                    for k in kept.tolist():
                        by_term.setdefault(int(hashes[k : k + 1].astype(np.int64)[0]), []).append({"start": found[k][0], "end": found[k][1]})
                    if by_term:
                        n, own = len(by_term), [] if everywhere else entities_of(text, spans)
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array([i] * n)), codes.take(pa.array([i] * n)),
                                pa.array([own] * n, pa.list_(pa.int64())),
                                pa.array(list(by_term), pa.int64()), pa.array(list(by_term.values()), pa.list_(place)),
                            ],
                            ["id", "code", "entities", "term", "places"],
                        )

    return rows.select("id", "code", "text").mapInArrow(
        run, f"id {kind}, code bigint, entities array<bigint>, term bigint, places array<struct<start:bigint, end:bigint>>"
    )


def term_counts(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Number of documents of each of the ``terms`` (hashes): ``term``, ``n_term``."""
    bits = rows.sparkSession.sparkContext.broadcast(bits_of(terms))

    def run(batches):
        for batch in batches:
            pending = []
            for part in batches_of(batch):
                held = []
                for owners, counts, hashes, *_ in word_chunks(text_bytes(part.column("text")), LETTERS):
                    keep = slot_is_taken(bits.value, slots_of(hashes))
                    held.append(np.stack([np.repeat(owners, counts)[keep].astype(np.int64), hashes[keep].astype(np.int64)]))
                pairs = np.unique(np.concatenate(held, axis=1), axis=1) if held else np.zeros((2, 0), np.int64)
                pending.append(pairs[1])
            values, counts = np.unique(np.concatenate(pending), return_counts=True) if pending else (np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), pa.array(counts, pa.int64())], ["term", "n"])

    return rows.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n_term"))


def telling_terms(rows: DataFrame, found: DataFrame, total: int, threshold: float) -> DataFrame:
    """``entity``, ``term`` and ``weight`` of each pair that reaches the threshold."""
    shared = stored(
        found.select("code", F.explode("entities").alias("entity")).groupBy("entity")
        .agg(F.count("*").alias("n_entity"), F.min("code").alias("low"), F.max("code").alias("high"))
        .where((F.col("low") < F.col("high")) & (F.col("n_entity") < total)).select("entity", "n_entity")
        .withColumn("level", F.ceil((F.log("n_entity") * threshold + F.log(F.lit(float(total))) * (1 - threshold)) / np.log(STEP).item() + 1e-6))
    )
    context = rows.sparkSession.sparkContext
    holders = found.select("code", F.explode("entities").alias("entity")).join(shared, "entity", "left_semi").select("code")
    holders = context.broadcast(bits_of(holders))
    counts = stored(
        term_counts(rows, candidate_terms(rows, holders)).where("n_term > 1")
        .withColumn("level", F.ceil(F.log("n_term") / np.log(STEP).item() - 1e-6))
    )
    levels = [r[0] for r in shared.select("level").distinct().orderBy("level").collect()]  # one for each power of STEP
    tables = [
        (bits_of(shared.where(F.col("level") == k).select("entity")), bits_of(counts.where(F.col("level") <= k).select("term"))) for k in levels
    ]
    pairs = pair_counts(rows, holders, context.broadcast(tables))
    size = F.lit(float(total))
    weight = F.log(size * F.col("n_pair") / (F.col("n_entity") * F.col("n_term"))) / F.log(size / F.col("n_entity"))
    return (
        pairs.join(counts.drop("level"), "term").join(shared.drop("level"), "entity")
        .withColumn("weight", weight).where(F.col("weight") >= threshold).select("entity", "term", "weight")
    )


def disclosure(
    docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", everywhere: bool = False
) -> DataFrame:
    """One row per row: id, ``code`` (hash of the text), ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base`` (spans as text)
    and ``terms`` (start, end and disclosure of each revealing term). ``everywhere`` marks terms in texts without the value too."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("code", F.xxhash64("text"))
    found = stored(find_values(rows.select("id", "code", "text")))
    telling = stored(telling_terms(rows, found, found.count(), threshold))
    by_term = telling.groupBy("term").agg(
        F.max("weight").alias("largest"), *([] if everywhere else [F.collect_list(F.struct("entity", "weight")).alias("tells")])
    )
    if everywhere:
        weight = F.col("largest")
    else:
        own = F.filter("tells", lambda x: F.array_contains("entities", x["entity"]))
        weight = F.array_max(F.transform(own, lambda x: x["weight"]))
    marks = F.transform("places", lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.col("weight").alias("weight")))
    marked = (
        places_of(rows, telling.select("term"), everywhere).dropDuplicates(["id", "code", "term"]).join(by_term, "term")
        .withColumn("weight", weight).where("weight is not null")
        .groupBy("id", "code").agg(F.array_sort(F.flatten(F.collect_list(marks))).alias("terms"))
        .withColumnsRenamed({"id": "own_id", "code": "own_code"})
    )
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("code") == F.col("own_code"))
    return found.join(marked, same, "left").select(
        F.col("id").alias(id_col), "code", *[f"n_{k}" for k in KINDS], "base",
        F.coalesce("terms", F.array().cast("array<struct<start:bigint,end:bigint,weight:double>>")).alias("terms"),
    )


def all_spans(base, terms):
    """Base spans and terms in one text, as kind:start:end."""
    marks = F.transform(terms, lambda t: F.concat(F.lit("term:"), t["start"].cast("string"), F.lit(":"), t["end"].cast("string")))
    return F.array_join(F.filter(F.concat(F.array(base), marks), lambda x: x != ""), ",")


def cleaned(text: str, base: str, terms: list, remove: float) -> str:
    """``text`` with labels for its values and terms; terms of a disclosure of at least ``remove`` are left out."""
    marks = [(int(s), int(e), f"[{k.upper()}]") for k, s, e in (x.split(":") for x in base.split(",") if x)]
    marks += [(t["start"], t["end"], "" if t["weight"] >= remove else "[TERM]") for t in terms]
    out, last = [], 0
    for start, end, label in sorted(marks):
        if start >= last:
            out += [text[last:start], label]
        last = max(last, end)
    return "".join(out) + text[last:]


def sanitised(
    docs: DataFrame, threshold: float = THRESHOLD, remove: float = REMOVE, id_col: str = "doc_id", text_col: str = "text",
    everywhere: bool = False,
) -> DataFrame:
    """``docs`` with sanitised texts; all other columns stay as they are, and null texts stay null."""
    found = disclosure(docs, threshold, id_col, text_col, everywhere).where("base <> '' or size(terms) > 0").select(
        F.col(id_col).alias("id"), "code", "base", "terms"
    ).dropDuplicates(["id", "code"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # so that no name of theirs can clash
    same = F.col("row")[id_col].eqNullSafe(F.col("id")) & (F.xxhash64(F.col("row")[text_col]) == F.col("code"))
    names = docs.columns

    def run(batches):
        for batch in batches:
            for part in batches_of(batch):
                row = dict(zip(names, part.column("row").flatten()))
                texts = row[text_col].to_pylist()
                bases, terms = part.column("base").to_pylist(), part.column("terms").to_pylist()
                texts = [t if t is None or b is None else cleaned(t, b, m or [], remove) for t, b, m in zip(texts, bases, terms)]
                columns = [pa.array(texts, pa.string()) if n == text_col else row[n] for n in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.join(found, same, "left").select("row", "base", "terms").mapInArrow(run, docs.schema)
