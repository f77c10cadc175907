"""Helpers shared by the operators: the shared folder, ASCII lower-casing, hold-out, word hashes."""

import ctypes
import string
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without it gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage and survives lost executors.

    The table is deleted when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Has a folder deleted when the driver's JVM ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is. ``lower`` does just that to ASCII texts and is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5 (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    """The same for one id in Python."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# A bounded filter before a shuffle: one bit for each slot of hashed keys.

SLOTS = 1 << 24
SLOTS_EACH = 1 << 15  # in one of Spark's bitmaps


def slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS))


def taken_slots(keys: DataFrame, place: Column | None = None) -> np.ndarray:
    """2 MB of bits, whatever the number of rows: which slots hold a key (first column of ``keys``, or ``place``)."""
    number = (slot(F.col(keys.columns[0])) if place is None else place) + 1  # Spark's bitmaps count from 1
    maps = keys.groupBy(F.bitmap_bucket_number(number).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )
    out = np.zeros(SLOTS // 8, np.uint8)
    for part, bits in maps.collect():
        at = (part - 1) * SLOTS_EACH // 8
        out[at : at + SLOTS_EACH // 8] = np.frombuffer(bytes(bits), np.uint8)
    return out


def slot_is_taken(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


# Words and their hashes, for whole batches of texts at once.

CHUNK = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[65:91] += 32


def byte_class(pattern_bytes) -> np.ndarray:
    """A table of 256 flags that is true at the given bytes."""
    table = np.zeros(256, dtype=bool)
    table[list(pattern_bytes)] = True
    return table


NOT_BLANK = ~byte_class([32, *range(9, 14)])
LETTERS = byte_class([*range(65, 91), *range(97, 123), *range(128, 256)])


def mixed(h: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values so that their order is as good as random."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = max(2 * CHUNK, 1 << (n - 1).bit_length())
    if size not in _powers:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        tables = []
        for factor in (BASE, inverse):
            table = np.full(size, factor, dtype=np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table))
        if size > 2 * CHUNK:  # for one huge word only: not worth keeping
            return tables[0], tables[1]
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def _chunk_words(parts: list[bytes], is_word: np.ndarray, fold: bool):
    joined = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    flags = is_word[joined]
    edges = np.flatnonzero(flags[1:] != flags[:-1]) + 1
    if flags[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    up, down = _power_tables(len(joined) + 1)
    codes = LOWER_BYTES[joined] if fold else joined
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(joined)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    bounds = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
    return hashes, counts, joined, starts, ends


def pieces(text: bytes, is_word: np.ndarray):
    """``text`` cut between words into parts of about a chunk, so that a long text needs no long arrays."""
    at = 0
    while len(text) - at > CHUNK:
        cut = at + CHUNK
        while cut < len(text) and is_word[text[cut]]:
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def word_chunks(texts: list[bytes], is_word: np.ndarray, fold: bool = True):
    """Words of UTF-8 texts, in chunks: (text number of each part, words of each part, word hashes, bytes, starts, ends).

    A word is a longest run of bytes for which ``is_word`` holds; line feeds must not be in it.
    Equal words (A-Z folded if asked) have equal hashes in every chunk and process.
    """
    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for part in pieces(text, is_word):
            parts.append(part)
            owners.append(i)
            size += len(part)
            if size >= CHUNK:
                yield _chunk(parts, owners, is_word, fold)
                parts, owners, size = [], [], 0
    if parts:
        yield _chunk(parts, owners, is_word, fold)


def _chunk(parts, owners, is_word, fold):
    hashes, counts, joined, starts, ends = _chunk_words(parts, is_word, fold)
    return np.array(owners), counts, hashes, joined, starts, ends


def word_hashes(texts: list[bytes], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text."""
    totals, found = np.zeros(len(texts), dtype=np.int64), []
    for owners, counts, hashes, *_ in word_chunks(texts, is_word):
        np.add.at(totals, owners, counts)
        found.append(hashes)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), totals


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; null counts as empty."""
    return [b"" if t is None else t for t in column.cast("binary").to_pylist()]


def batches_of(batch, max_bytes: int = 8 << 20):
    """Slices of an Arrow batch with about ``max_bytes`` of data each, one row at least."""
    step = max(1, int(batch.num_rows * max_bytes / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def released(items):
    """The same items; memory that is kept for reuse is handed back before each, and after the last one.

    A Python worker outlives its task and otherwise keeps the most that any task needed.
    """
    for item in items:
        release_memory()
        yield item
    item = None
    release_memory()


def release_memory() -> None:
    """Hands memory that Arrow and the C library keep for reuse back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
