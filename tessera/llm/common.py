"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

import tessera
from tessera.session import shared_path
from tessera.sources.tables import read_table

#: a word is a run of characters other than the six ASCII white-space characters
WORD = "[^\\x20\\x09-\\x0D]+"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they were started (once per context)."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    package = Path(tessera.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="tessera-code-")) / "tessera.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._tessera_shipped = True


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", list(columns) or None)


_WRITTEN: list[str] = []


def saved(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below the cluster's checkpoint folder and read it again (cuts lineage).

    The table is deleted by :func:`dropped` or :func:`cleared`, at the latest when the driver ends."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", compression).parquet(path)
    target, fs = _place(spark, path)
    fs.deleteOnExit(target)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(df: DataFrame) -> set[str]:
    return {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in df.inputFiles()}


def dropped(df: DataFrame) -> None:
    """Delete the files of a frame made by :func:`saved` that nothing reads any more."""
    cleared(df.sparkSession, only=_folders(df))


def written() -> int:
    """A mark for :func:`cleared`: the tables written so far."""
    return len(_WRITTEN)


def written_since(mark: int) -> set[str]:
    """Names of the saved tables written after a mark and not deleted since."""
    return {path.rsplit("/", 1)[-1] for path in _WRITTEN[mark:]}


def cleared(spark: SparkSession, since: int = 0, keep: DataFrame | None = None, only: set[str] | None = None) -> None:
    """Delete the saved tables written after the mark ``since``, but those that ``keep`` reads."""
    kept = _folders(keep) if keep is not None else set()
    for path in _WRITTEN[since:]:
        folder = path.rsplit("/", 1)[-1]
        if folder not in kept and (only is None or folder in only):
            target, fs = _place(spark, path)
            fs.delete(target, True)
            _WRITTEN.remove(path)


def released(spark: SparkSession) -> None:
    """Let the driver collect its garbage: Spark keeps the shuffle files of finished jobs until it does."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(fn: Callable) -> Callable:
    """Arrow batches of at most 8 MB in the jobs that ``fn(frame, ...)`` runs, unless the session sets their size."""
    @functools.wraps(fn)
    def run(df: DataFrame, *args, **kw):
        conf = df.sparkSession.conf
        if conf.get(BATCH_BYTES, None) is not None:
            return fn(df, *args, **kw)
        conf.set(BATCH_BYTES, "8m")
        try:
            return fn(df, *args, **kw)
        finally:
            conf.unset(BATCH_BYTES)
    return run


def n_buckets(df: DataFrame, per_bucket: int = 20_000, least: int = 64) -> int:
    """Buckets that hold about ``per_bucket`` rows each, so their number grows with the table."""
    return max(least, -(-df.count() // per_bucket))


def running_offsets(df: DataFrame, key: str, size: str, order: list[str], out: str,
                    buckets: int) -> DataFrame:
    """Start of every row when the rows of a ``key`` are laid end to end, ``size`` long each.

    The rows of a key are ordered by (hash bucket, ``order``).  A key's rows are summed per
    bucket before anything is ordered, so no task holds more than one bucket of a key, however
    many rows the key has.  ``key`` must not be null.
    """
    d = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sums = d.groupBy(key, "_bucket").agg(F.sum(size).alias("_sum"))
    base = sums.withColumn("_base", F.sum("_sum").over(W.partitionBy(key).orderBy("_bucket")) - F.col("_sum")) \
        .drop("_sum")
    w = W.partitionBy(key, "_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order]) \
        .rowsBetween(W.unboundedPreceding, 0)
    return (d.join(base, [key, "_bucket"])
            .withColumn(out, F.col("_base") + F.sum(size).over(w) - F.col(size))
            .drop("_base", "_bucket"))


def scatter_points(n: Column, *seed: Column, rounds: int = 24) -> Column:
    """The points about which the rounds of :func:`scattered` reflect; the same for every index."""
    return F.transform(F.sequence(F.lit(1), F.lit(rounds)), lambda r: F.pmod(F.xxhash64(r, *seed), n))


def scattered(index: Column, n: Column, *seed: Column, rounds: int = 24, points: Column | None = None) -> Column:
    """Pseudorandom permutation of 0..n-1, keyed by ``seed``, applied to ``index``.

    Swap-or-not rounds: each round reflects the index about a keyed point, or not, by a keyed
    coin that both partners of the reflection share, so every round is a bijection on 0..n-1
    and no cycle walking is needed.  ``points`` are the :func:`scatter_points`, if worked out before.
    """
    def one(x, r):
        point = F.pmod(F.xxhash64(r, *seed), n) if points is None else F.get(points, r - 1)
        partner = F.pmod(point + n - x, n)
        coin = F.pmod(F.xxhash64(F.greatest(x, partner), r, F.lit(1), *seed), F.lit(2)) == 1
        return F.when(coin, partner).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), one)


def joined_safely(rows: DataFrame, more: DataFrame, key: list[str], how: str = "left") -> DataFrame:
    """Join on a key that may be null in part; nulls are equal."""
    renamed = more.select(*[F.col(k).alias(f"_{k}_") for k in key], *[c for c in more.columns if c not in key])
    on = [rows[k].eqNullSafe(renamed[f"_{k}_"]) for k in key]
    return rows.join(renamed, on, how).drop(*[f"_{k}_" for k in key])


def bit_table(spots: DataFrame, bits: int) -> np.ndarray:
    """The places (column p) below ``bits`` as a bit set, summed word by word on Spark."""
    words = spots.groupBy(F.shiftright("p", 5).alias("w")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 31 as int))")).alias("b")).toArrow()
    table = np.zeros(bits // 32, np.uint32)
    table[words.column("w").to_numpy()] = words.column("b").to_numpy().astype(np.uint32)
    return table


def member_filter(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str, most_bits: int = 1 << 27) -> DataFrame:
    """The ``rows`` whose key may be among the wanted ones (a Bloom filter).

    The filter is summed on Spark word by word and has at most ``most_bits`` bits, so it may be
    broadcast whatever the number of keys.  It lets all wanted rows through and few others while the keys
    are fewer than its bits; an exact join has to follow where others would do harm.
    """
    bits = min(most_bits, max(1 << 20, 1 << (8 * wanted.count()).bit_length()))

    def place(k, seed):
        return F.pmod(F.xxhash64(F.col(k), F.lit(seed)), F.lit(bits))
    spots = wanted.select(F.explode(F.array(*[place(wanted_key, s) for s in (1, 2)])).alias("p"))
    shared = rows.sparkSession.sparkContext.broadcast(bit_table(spots, bits))

    @F.pandas_udf("boolean")
    def maybe(p, q):
        import pandas as pd
        t = shared.value
        a, b = p.to_numpy(), q.to_numpy()
        return pd.Series(((t[a >> 5] >> (a & 31).astype(np.uint32)) & (t[b >> 5] >> (b & 31).astype(np.uint32)) & 1) > 0)

    return rows.where(maybe(place(key, 1), place(key, 2)))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``links``: rows (node, root), root = least node.

    Every round gives each node the least label among its neighbours' and its own, then lets
    labels jump to the label of their label, so long chains close in a logarithmic number of
    rounds.  The label table is written to the checkpoint folder each round and the one before
    is deleted.  A hub with very many links is an ordinary combinable minimum.
    """
    e = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    e = saved(e.union(e.select("y", "x")).distinct(), "edges")
    lab = saved(e.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"),
                                                                 F.least("x", "m").alias("root")), "labels")
    while True:
        # least label around every node, told to the node and to its present root
        near = (e.join(lab, e.y == lab.node).groupBy("x").agg(F.min("root").alias("m"))
                .join(lab, F.col("x") == F.col("node")).select("node", "root", F.least("m", "root").alias("m")))
        hook = near.groupBy("root").agg(F.min("m").alias("m")).where("m < root")
        got = near.select("node", F.col("m").alias("root")).union(hook.select(F.col("root").alias("node"), "m")) \
            .groupBy("node").agg(F.min("root").alias("root"))
        got = saved(got, "labels")
        up = got.select(F.col("node").alias("p"), F.col("root").alias("pr"))
        new = saved(got.join(up, got.root == up.p, "left")
                    .select("node", F.least("root", F.coalesce("pr", "root")).alias("root")), "labels")
        old = lab.withColumnRenamed("root", "was")
        moved = new.join(old, "node").where("root <> was").limit(1).count()
        dropped(got)
        dropped(lab)
        lab = new
        if not moved:
            dropped(e)
            return lab


# ---- byte-level numpy helpers (used inside tasks) -------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def byte_codes(seed: int) -> np.ndarray:
    """256 fixed odd 64-bit codes, one per byte value."""
    return mixed((np.arange(256, dtype=np.uint64) + np.uint64(seed)) * _MULT) | np.uint64(1)


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def in_slices(batches, rows: int = 1000, most_bytes: int | None = None):
    """The record batches, at most ``rows`` rows (and ``most_bytes`` bytes, or one row) at a time, so a
    worker's objects stay few."""
    for batch in batches:
        todo = [batch.slice(first, rows) for first in reversed(range(0, len(batch), rows))]
        while todo:
            part = todo.pop()
            if most_bytes and len(part) > 1 and part.nbytes > most_bytes:
                half = len(part) // 2
                todo += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def utf8_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column as one array, and its n+1 offsets (nulls are empty)."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def field_list(schema: str) -> T.StructType:
    return T._parse_datatype_string(schema)
