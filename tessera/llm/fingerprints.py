"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last seven bytes rolls over the UTF-8 bytes of a text; where its low bits are all
ones at block size ``b`` (a power of two) a chunk ends.  Each chunk hashes to one of 64 signs,
and the signs form the signature.  A fingerprint ``b:sig(b):sig(2b)`` has two signatures, at
most 64 and 32 signs long (what comes after is folded into the last sign); ``b`` starts where
64 chunks would cover the text and is halved while fewer than 16 chunks end.

Two fingerprints are compared where their block sizes meet (equal, or one twice the other):
runs of more than three equal signs are cut to three, signatures that share no seven signs in
a row (a third of the shorter one, if that is less) are unlike, and otherwise the likeness is one minus the
edit distance (insert and delete 1, change 2) over the sum of the lengths.

A local change alters the chunks around it only, so the other signs stay.

Nulls and empty texts have the fingerprint ``4::``.  Equal texts have equal fingerprints, whose
likeness is 1.  Texts are read whole, one at a time; memory is a few arrays of a text's length.
Repeated rows and ids are treated row by row in (id, text) order.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import byte_codes, mixed, powers

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
WINDOW, LEAST_BLOCK, LONG, SHORT, FEW, SHARED = 7, 4, 64, 32, 16, 7

_CODES = byte_codes(2)
_ROLL_CODES = (_CODES >> np.uint64(32)).astype(np.uint32)
_ROLL_STEPS = [np.uint32(pow(0x01000193, j, 1 << 32)) for j in range(WINDOW)]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SIGN = np.frombuffer(SIGNS.encode(), np.uint8)


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(n, _BASE), powers(n, _INVERSE)


def rolled(b: np.ndarray) -> np.ndarray:
    """Hash of the last ``WINDOW`` bytes at every byte."""
    c = _ROLL_CODES[b]
    r = c.copy()
    for j in range(1, min(WINDOW, len(b))):
        r[j:] += c[:-j] * _ROLL_STEPS[j]
    r ^= r >> np.uint32(15)
    r *= np.uint32(0x2C1B3C6D)
    return r ^ (r >> np.uint32(12))


def _signature(ends: np.ndarray, prefix: np.ndarray, inverse: np.ndarray, most: int) -> str:
    """One sign per chunk; ``ends`` are the places after the chunks that were triggered."""
    n = len(prefix) - 1
    ends = ends[: most - 1]
    if not len(ends) or ends[-1] != n:
        ends = np.append(ends, n)
    starts = np.concatenate(([0], ends[:-1]))
    h = mixed((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return _SIGN[(h >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str | None) -> str:
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return f"{LEAST_BLOCK}::"
    b = np.frombuffer(raw, np.uint8)
    r = rolled(b)
    block = LEAST_BLOCK
    while block * LONG < n:
        block *= 2
    def ends(size):
        return np.flatnonzero((r & np.uint32(size - 1)) == np.uint32(size - 1)) + 1
    at = ends(block)
    while block > LEAST_BLOCK and len(at) < FEW:
        block //= 2
        at = ends(block)
    up, down = _powers(1 << max(16, n.bit_length()))
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[b] * up[:n], out=prefix[1:])
    wide = at[(r[at - 1] & np.uint32(2 * block - 1)) == np.uint32(2 * block - 1)]
    return f"{block}:{_signature(at, prefix, down, LONG)}:{_signature(wide, prefix, down, SHORT)}"


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word row at a time."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & at.get(x, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def _short_runs(s: str) -> str:
    return "".join(x for i, x in enumerate(s) if i < 3 or not x == s[i - 1] == s[i - 2] == s[i - 3])


def likeness_of_signatures(a: str, b: str) -> float:
    a, b = _short_runs(a), _short_runs(b)
    k = min(SHARED, max(1, min(len(a), len(b)) // 3))
    if not a or not b or not {a[i:i + k] for i in range(len(a) - k + 1)} & {b[i:i + k] for i in range(len(b) - k + 1)}:
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1 for two fingerprints; 0 where their block sizes don't meet."""
    if a == b:
        return 1.0
    size_a, *sa = a.split(":")
    size_b, *sb = b.split(":")
    p, q = int(size_a), int(size_b)
    if p == q:
        return max(likeness_of_signatures(sa[0], sb[0]), likeness_of_signatures(sa[1], sb[1]))
    if p == 2 * q:
        return likeness_of_signatures(sa[0], sb[1])
    return likeness_of_signatures(sa[1], sb[0]) if q == 2 * p else 0.0


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    column = F.pandas_udf(lambda texts: texts.map(fingerprint), "string")
    return docs.withColumn(out, column(F.coalesce(F.col(text), F.lit(""))))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in (piece, ahead, id, text) order; each is compared with the row after it."""
    names = [f.split()[0] for f in RESULT.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[f.split()[1]]
             for f in RESULT.split(", ")]
    last = None
    for batch in batches:
        out = []
        for piece, ahead, i, text in zip(*(batch.column(c).to_pylist() for c in ("piece", "ahead", "doc_id", "text"))):
            if ahead and (last is None or last[0] != piece):
                continue
            print_ = fingerprint(text)
            if last is not None and last[0] == piece:
                _, j, own, own_print = last
                new = edited(own, text)
                new_print = fingerprint(new)
                out.append((j, len(own), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own_print,
                            new_print, likeness(own_print, new_print), likeness(own_print, print_)))
            last = None if ahead else (piece, i, text, print_)
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def compared_with_next(docs: DataFrame, pieces: int | None = None, most_pieces: int = 4096) -> DataFrame:
    """Every text of ``docs`` (doc_id, text) against its edit and against the next text by id.

    Ids are cut into at most ``most_pieces`` ranges, whose bounds and first ids are the only
    values that reach the driver.  A piece's first row is sent to the piece before it as well
    (the first piece's to the last), so the texts are shuffled once and every row meets the
    row after it in one sorted pass that holds two texts at a time.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    if pieces is None:
        pieces = min(most_pieces, max(1, d.count() // 2_000))
    bounds = d.approxQuantile("doc_id", [k / pieces for k in range(1, pieces)], 0.25 / pieces) if pieces > 1 else []
    bounds = np.unique(np.array(bounds or [], dtype=np.int64))

    @F.pandas_udf("long")
    def piece_of(ids):
        import pandas as pd
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="right"))

    d = d.withColumn("piece", F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long"))
                     .otherwise(piece_of(F.coalesce("doc_id", F.lit(0)))))
    firsts = sorted((r["piece"], r["first"]) for r in
                    d.groupBy("piece").agg(F.min("doc_id").alias("first")).collect())
    before = [(p, f, firsts[k - 1][0]) for k, (p, f) in enumerate(firsts)]
    ahead = F.broadcast(spark.createDataFrame(before, "piece long, first long, before long"))
    d = d.join(ahead, "piece", "left")
    here = F.struct(F.col("piece"), F.lit(0).alias("ahead"))
    there = F.struct(F.col("before").alias("piece"), F.lit(1).alias("ahead"))
    d = d.withColumn("to", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.array(here, there))
                                     .otherwise(F.array(here))))
    d = d.select("to.piece", "to.ahead", "doc_id", "text")
    return (d.repartitionById(len(bounds) + 2, (F.col("piece") + 1).cast("int"))  # one piece a task
            .sortWithinPartitions("piece", "ahead", F.col("doc_id").asc_nulls_first(), "text")
            .mapInArrow(_compared, RESULT))
