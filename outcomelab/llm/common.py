"""Small helpers that several operators of this subpackage share.

Words are maximal runs of bytes that are not ASCII white space
(``[^\\x20\\x09-\\x0D]+``); ``bytes.split()`` cuts exactly there. Word
hashes are 64-bit xxh3, the same in every process.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.session import scratch_path

WORD_MEMO = 400_000

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="outcomelab-py-"), "outcomelab_py.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def words(text: str | None, lower: bool = False) -> list[bytes]:
    if not text:
        return []
    b = text.encode("utf-8")
    return (b.lower() if lower else b).split()


class WordHash(dict):
    """word -> 64-bit hash; keeps the first ``limit`` words it meets."""

    def __init__(self, limit: int = WORD_MEMO):
        super().__init__()
        self.limit = limit

    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(w)
        if len(self) < self.limit:
            self[w] = h
        return h


_MEMO = WordHash()

# Memos of this worker. Workers are reused by all stages of a job, so the memo of
# an operator is emptied when a task of another one starts.
_MEMOS: dict[str, dict] = {"words": _MEMO}
_ACTIVE: list[str | None] = [None]


def memo(name: str, table: dict) -> dict:
    """Register a table that a worker keeps between tasks."""
    _MEMOS[name] = table
    return table


# glibc's numbers of these settings, and what a worker may hold before freed memory is given back.
_TRIM_THRESHOLD, _MMAP_THRESHOLD, _ARENA_MAX = -1, -3, -8
RELEASE_BYTES = 160 << 20


def _libc():
    try:
        libc = ctypes.CDLL(None)
        return libc if hasattr(libc, "malloc_trim") else None
    except OSError:
        return None


def _held() -> int:
    """Bytes of this process that are not mapped files."""
    try:
        with open("/proc/self/statm") as f:
            _, all_, files = f.read().split()[:3]
        return (int(all_) - int(files)) * os.sysconf("SC_PAGE_SIZE")
    except OSError:
        return RELEASE_BYTES


def _steady() -> None:
    """Large arrays of this worker go back to the system when they are freed:
    by default glibc raises the size from which they do, up to 32 MB, and Arrow
    keeps what it frees, so a worker stays as large as its largest task. Mapping
    them anew costs a tokenizer a quarter of its time, so this is only set where
    a worker goes from one operator to another."""
    libc = _libc()
    if libc is not None:
        for setting, value in ((_MMAP_THRESHOLD, 1 << 20), (_TRIM_THRESHOLD, 4 << 20), (_ARENA_MAX, 2)):
            libc.mallopt(setting, value)
        pa.set_memory_pool(pa.system_memory_pool())


def release() -> None:
    """Give freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = _libc()
    if libc is not None:
        libc.malloc_trim(0)


def use_memos(*names: str) -> None:
    """Called by a task: the memos it uses. All others are emptied, and what
    earlier tasks of this worker freed is given back."""
    wanted = ",".join(names)
    changed = _ACTIVE[0] != wanted
    if changed and _ACTIVE[0] is not None:
        _steady()
    if changed:
        for n, table in _MEMOS.items():
            if n not in names:
                table.clear()
        _ACTIVE[0] = wanted
    if changed or _held() > RELEASE_BYTES:
        release()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_MEMO.__getitem__, ws), np.uint64, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambler."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    return mix(x + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive word hashes (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n] + np.uint64(k)
    for j in range(1, k):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[j:j + n]
    return mix(out)


# Word hashes straight from the bytes of a text: a sum of a number per byte value
# times a power of an odd constant, freed of the word's place by the inverse power.
_ODD = 0x9E3779B97F4A7C15
_CELL = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
BLOCK_BYTES = 1 << 20
LONG_WORD = 256
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p)
    return _POWERS


def _blocks(b: bytes):
    """Pieces of about ``BLOCK_BYTES`` that do not cut a word where a blank or a line end allows it."""
    at = 0
    while len(b) - at > BLOCK_BYTES:
        cut = max(b.rfind(c, at, at + BLOCK_BYTES) for c in (b" ", b"\n")) + 1
        if cut <= at:
            break
        yield b[at:cut]
        at = cut
    yield b[at:]


def text_word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words of a text, in order, without a Python object
    per word; not the values of ``word_hashes``. Words of more than
    ``LONG_WORD`` bytes are hashed by xxh3."""
    if not text:
        return np.empty(0, np.uint64)
    whole = text.encode("utf-8")
    out = []
    for b in _blocks(whole.lower() if lower else whole):
        raw = np.frombuffer(b, np.uint8)
        power, inverse = _powers(len(raw))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[raw], [True]])))
        start, end = edge[0::2], edge[1::2]
        if len(start) == 0:
            continue
        term = _CELL[raw] * power[:len(raw)]
        acc = np.cumsum(term)
        h = mix((acc[end - 1] - acc[start] + term[start]) * inverse[start] + (end - start).astype(np.uint64))
        for i in np.flatnonzero(end - start > LONG_WORD):
            h[i] = xxhash.xxh3_64_intdigest(b[start[i]:end[i]])
        out.append(h)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct k-word shingles of the lower-cased text; a shorter text
    is one shingle, a text without words has none."""
    h = text_word_hashes(text, True)
    if not len(h):
        return h
    s = rolling(h, min(k, len(h)))
    s.sort()
    return s[np.r_[True, s[1:] != s[:-1]]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def batch(**cols) -> pa.RecordBatch:
    """Record batch from name=(type, values)."""
    return pa.RecordBatch.from_arrays([pa.array(v, type=t) for t, v in cols.values()],
                                      names=list(cols))


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage so
    that a lost executor re-reads instead of recomputing."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def membership(df: DataFrame, column: str, log2_bits: int = 26) -> bytes:
    """Bit table of ``2**log2_bits`` cells (8 MB at 26) with the cell of every
    value of a BIGINT column set: a fixed size whatever the input."""
    rows = (df.select(F.pmod(F.col(column), F.lit(1 << log2_bits)).alias("_c"))
            .groupBy(F.bitmap_bucket_number("_c").alias("_b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_c")).alias("_m")).collect())
    out = np.zeros((1 << log2_bits) // 8, np.uint8)
    # buckets of 32768 bits count from 1; value 0 has a bucket of its own
    for r in rows:
        m = np.frombuffer(bytes(r["_m"]), np.uint8)
        at = (r["_b"] - 1) * 4096
        if at >= 0:
            out[at:at + 4096] |= m
    return out.tobytes()


def is_member(table: np.ndarray, values: np.ndarray, log2_bits: int = 26) -> np.ndarray:
    """Boolean mask over unsigned 64-bit values; false positives only."""
    cell = values & np.uint64((1 << log2_bits) - 1)
    # bitmap functions put value v in bucket (v - 1) / 32768 + 1, bit (v - 1) % 32768
    cell = (cell - np.uint64(1)) & np.uint64((1 << log2_bits) - 1)
    hit = (table[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1
    zero = (values & np.uint64((1 << log2_bits) - 1)) == 0
    return (hit == 1) | zero
