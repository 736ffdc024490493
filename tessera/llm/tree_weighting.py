"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions; the decision after the first bits of a byte is a node of the
byte's code tree.  For every code node there is one context tree: its depth-d node is the last d
bytes.  Each (context, code node) counts zeros and ones and holds the Krichevsky-Trofimov
probability Pe of its counts; the weighted probability is Pw = Pe at the full depth and
Pw = (Pe + product of the children's Pw) / 2 above it.  Given the counts, the next bit's
probability mixes the estimates of all depths on the path: with b = Pe / product of the
children's Pw, a node says ``(b * kt + deeper) / (b + 1)``.  What has no counts says 1/2.

Texts are lower-cased (A-Z), start after ``depth`` zero bytes and end with byte 255, which UTF-8
never has; so the scores of all texts sum to at most one.

On Spark: each task counts the byte strings of length depth + 1 ("grams") of its texts, sums are
combined by gram, and the trees are built level by level by grouping contexts by their shorter
context, and mixed from the root down by joins; each level is one written table.  The result is a
log probability per distinct gram.  The table of grams is broadcast only if it was counted to
have at most ``most_shared`` rows; above that the texts' grams are joined with it by shuffle.

The unigram base counts words likewise.  Words at or above a count that at most ``most_frequent``
words reach are shared with all tasks; all others are joined by shuffle, so no join key is hot.

Nulls: a null text is empty; a null id is in training.  Empty texts have the end token alone.
Long texts are cut into pieces that know the bytes before them, so memory is bounded.  Repeated
rows are counted and scored each.  Empty tables give no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import in_slices, joined_safely, lower_ascii, saved, small_batches, utf8_buffer

END = 255
LN2 = float(np.log(2.0))
#: bytes that a task turns into words at a time
SLICE = 1 << 22


# ---- grams in tasks -------------------------------------------------------------------------

def _grams(stream: np.ndarray, depth: int) -> np.ndarray:
    """The gram of every byte: itself in the lowest eight bits, the bytes before it above, nearest first."""
    g = stream.astype(np.int64)
    for j in range(1, depth + 1):
        g[j:] |= stream[:-j].astype(np.int64) << (8 * j)
    return g


def _long_text(text: np.ndarray, depth: int, most: int) -> Iterator[np.ndarray]:
    """The grams of one text, ``most`` at a time."""
    for lo in range(0, len(text) + 1, most):
        hi = min(lo + most, len(text) + 1)
        before = min(lo, depth)
        stream = np.zeros(depth + hi - lo, np.uint8)
        part = lower_ascii(text[lo - before: hi])
        stream[depth - before: depth - before + len(part)] = part
        if hi > len(text):
            stream[-1] = END
        yield _grams(stream, depth)[depth:]


def gram_pieces(column, depth: int, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(gram of every byte and end mark, number of its text), for pieces of about ``most`` bytes."""
    data, off = utf8_buffer(column)
    n = len(off) - 1
    first = 0
    while first < n:
        if off[first + 1] - off[first] > most:
            for g in _long_text(data[off[first]: off[first + 1]], depth, most):
                yield g, np.full(len(g), first)
            first += 1
            continue
        last = min(n, int(np.searchsorted(off, off[first] + most, side="right")) - 1)
        sizes = np.diff(off[first: last + 1])
        ends = np.cumsum(sizes + depth + 1) - 1
        is_text = np.ones(int(ends[-1]) + 1, bool)
        for j in range(depth):
            is_text[ends - sizes - 1 - j] = False
        is_text[ends] = False
        stream = np.zeros(len(is_text), np.uint8)
        stream[is_text] = lower_ascii(data[off[first]: off[last]])
        stream[ends], is_text[ends] = END, True
        yield _grams(stream, depth)[is_text], np.repeat(np.arange(first, last), sizes + 1)
        first = last


def _added_up(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    grams, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    new = np.flatnonzero(np.diff(grams, prepend=-1))
    return grams[new], np.add.reduceat(n[order], new) if len(new) else n


def _counted(depth: int, most: int = 1 << 19):
    def count(batches):
        parts: list[tuple] = []
        held = 0
        for batch in batches:
            train = batch.column("train").to_numpy(zero_copy_only=False)
            for grams, text in gram_pieces(batch.column("text"), depth):
                own = train[text]
                other = np.unique(grams[~own])
                parts += [np.unique(grams[own], return_counts=True), (other, np.zeros(len(other), np.int64))]
                held += len(parts[-2][0]) + len(other)
                if held > most:  # what was counted piece by piece is added up before it leaves the task
                    parts = [_added_up(parts)]
                    held = len(parts[0][0])
                    if held > most // 2:
                        yield pa.record_batch(list(map(pa.array, parts.pop())), ["gram", "n"])
                        held = 0
        if parts:
            yield pa.record_batch(list(map(pa.array, _added_up(parts))), ["gram", "n"])
    return count


def gram_counts(texts: DataFrame, depth: int) -> DataFrame:
    """Every gram of ``texts`` (train boolean, text) with its count in training texts."""
    return texts.select("train", "text").mapInArrow(_counted(depth), "gram long, n long") \
        .groupBy("gram").agg(F.sum("n").alias("n"))


# ---- the trees ------------------------------------------------------------------------------

def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x >= 1/2 (shifted Stirling series)."""
    x = x.cast("double")
    y = x + 8
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    shift = F.log(x * (x + 1) * (x + 2) * (x + 3)) + F.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    return (y - 0.5) * F.log(y) - y + 0.5 * float(np.log(2 * np.pi)) + series - shift


def log_kt(zeros: Column, ones: Column) -> Column:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - float(np.log(np.pi))


def _with_bits(grams: DataFrame) -> DataFrame:
    b = grams.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(7))))
    return b.select("gram", "n", F.shiftright("gram", 8).alias("ctx"),
                    F.expr("shiftleft(1, i) | shiftright(cast(gram & 255 as int), 8 - i)").alias("node"),
                    F.expr("shiftright(cast(gram & 255 as int), 7 - i) & 1").alias("bit"))


def gram_scores(grams: DataFrame, depth: int) -> DataFrame:
    """(gram, bits): the code length of every gram's last byte after the bytes before it."""
    bits = _with_bits(grams)
    level = bits.groupBy("ctx", "node").agg(F.sum(F.col("n") * (1 - F.col("bit"))).alias("n0"),
                                            F.sum(F.col("n") * F.col("bit")).alias("n1"))
    level = level.withColumn("log_w", log_kt(F.col("n0"), F.col("n1"))).withColumn("share", F.lit(1.0))
    levels = [saved(level, f"tree-{depth}")]
    for d in range(depth - 1, -1, -1):
        mask = (1 << (8 * d)) - 1
        up = levels[-1].groupBy(F.col("ctx").bitwiseAND(F.lit(mask)).alias("ctx"), "node") \
            .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log_w").alias("below"))
        up = up.withColumn("own", log_kt(F.col("n0"), F.col("n1")))
        top = F.greatest("own", "below")
        up = up.withColumn("log_w", top + F.log(F.exp(F.col("own") - top) + F.exp(F.col("below") - top)) - LN2) \
            .withColumn("share", 1 / (1 + F.exp(F.least(F.col("below") - F.col("own"), F.lit(700.0)))))
        levels.append(saved(up.select("ctx", "node", "n0", "n1", "log_w", "share"), f"tree-{d}"))
    one = F.col("share") * (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    path = None
    for d, level in enumerate(reversed(levels)):
        here = level.select("ctx", "node", one.alias("own"), F.col("share"))
        if path is None:
            path = here.select("ctx", "node", F.col("own").alias("p1"), (1 - F.col("share")).alias("rest"))
            continue
        mask = (1 << (8 * (d - 1))) - 1
        above = path.select(F.col("ctx").alias("short"), "node", "p1", "rest")
        path = here.withColumn("short", F.col("ctx").bitwiseAND(F.lit(mask))).join(above, ["short", "node"]) \
            .select("ctx", "node", (F.col("p1") + F.col("rest") * F.col("own")).alias("p1"),
                    (F.col("rest") * (1 - F.col("share"))).alias("rest"))
    p = F.when(F.col("bit") == 1, F.col("p1")).otherwise(1 - F.col("p1"))
    return bits.join(path, ["ctx", "node"]).groupBy("gram").agg(F.sum(-F.log2(p)).alias("bits"))


class GramTable:
    """Code lengths by gram: rows in order of a hash, and the first row of each of its values (20 to 24 bytes a gram)."""

    def __init__(self, grams: np.ndarray, bits: np.ndarray):
        self.order = max(4, len(grams).bit_length())
        slot = self._slot(grams)
        rows = np.argsort(slot, kind="stable")
        self.key, self.bits = grams[rows], bits[rows]
        n = np.bincount(slot, minlength=1 << self.order)
        self.first = (np.cumsum(n) - n).astype(np.int32)

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.order)).astype(np.int64)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        """The code lengths of ``grams``, all of which the table has."""
        row = self.first[self._slot(grams)]
        missed = np.flatnonzero(self.key[row] != grams)
        while len(missed):
            row[missed] += 1
            missed = missed[self.key[row[missed]] != grams[missed]]
        return self.bits[row]


# ---- words ----------------------------------------------------------------------------------

def _word_counts(batches):
    n: Counter = Counter()

    def out():
        return pa.record_batch([pa.array(n.keys(), pa.binary()), pa.array(n.values(), pa.int64())], ["word", "n"])

    for batch in in_slices(batches, most_bytes=SLICE):
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            n.update((text or b"").lower().split())
        if len(n) > 150_000:
            yield out()
            n.clear()
    if n:
        yield out()


def word_counts(texts: DataFrame) -> DataFrame:
    return texts.where("train").select("text").mapInArrow(_word_counts, "word binary, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach, up to rounding to two digits."""
    size = F.length(F.col("n").cast("string"))
    step = F.pow(F.lit(10), F.greatest(size - 2, F.lit(0))).cast("long")
    steps = counts.groupBy((F.floor(F.col("n") / step) * step).alias("from")).count().collect()
    total, least = 0, 1 << 62
    for r in sorted(steps, reverse=True):
        total += r["count"]
        if total > most:
            break
        least = r["from"]
    return int(least)


# ---- scoring --------------------------------------------------------------------------------

@small_batches
def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = 4, fold: int = 2, folds: int = 7,
          most_shared: int = 8_000_000, most_frequent: int = 200_000) -> DataFrame:
    """One row per text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte.  Texts whose crc32 of the id leaves ``fold`` modulo ``folds`` are held out."""
    spark = docs.sparkSession
    rest = F.pmod(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")), F.lit(folds))
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                    F.coalesce(rest != fold, F.lit(True)).alias("train"))

    grams = saved(gram_counts(d, depth), "grams")
    scores = saved(gram_scores(grams, depth), "gram-bits")
    counts = saved(word_counts(d), "words")
    ends = d.where("train").count()
    n_words, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    train_tokens, types = n_words + ends, n_types + (ends > 0)
    least = frequent_from(counts, most_frequent)
    often = counts.where(F.col("n") >= least).toArrow()
    divisor = float(train_tokens + types + 1)
    known = spark.sparkContext.broadcast(dict(zip(often.column("word").to_pylist(),
                                                  np.log10((often.column("n").to_numpy() + 1) / divisor).tolist())))
    shared = scores.count() <= most_shared
    table = None
    if shared:
        t = scores.toArrow()
        table = spark.sparkContext.broadcast(GramTable(t.column("gram").to_numpy(), t.column("bits").to_numpy()))

    def read(batches):
        logs = known.value
        end = np.log10((ends + 1) / divisor)
        for batch in in_slices(batches, most_bytes=SLICE):
            column = batch.column("text")
            n = len(column)
            bits, sizes = np.zeros(n), np.zeros(n, np.int64)
            pieces: list[tuple] = []
            for g, text in gram_pieces(column, depth):
                if shared:
                    bits += np.bincount(text, table.value(g), minlength=n)
                else:
                    order = np.lexsort((g, text))
                    g, text = g[order], text[order]
                    new = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (text[1:] != text[:-1]))))
                    pieces.append((text[new], g[new], np.diff(np.append(new, len(g)))))
                sizes += np.bincount(text, minlength=n)
            tokens, seen, base, rare = [], [], [], []
            for t in column.cast(pa.binary()).to_pylist():
                words = (t or b"").lower().split()
                of = list(map(logs.get, words))
                unseen = [w for w, x in zip(words, of) if x is None]
                tokens.append(len(words) + 1)
                seen.append(len(words) - len(unseen) + (ends > 0))
                base.append(sum(x for x in of if x is not None) + end)
                rare.append(unseen)
            out = [batch.column("doc_id"), batch.column("sig"), batch.column("train"), pa.array(tokens, pa.int64()),
                   pa.array(seen, pa.int64()), pa.array(base, pa.float64()), pa.array(bits), pa.array(sizes),
                   pa.array(rare, pa.list_(pa.binary()))]
            text, g, k = map(np.concatenate, zip(*pieces)) if pieces else [np.zeros(0, np.int64)] * 3
            first = pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32())
            out.append(pa.ListArray.from_arrays(first, pa.StructArray.from_arrays([pa.array(g), pa.array(k)], ["gram", "k"])))
            yield pa.record_batch(out, ["doc_id", "sig", "train", "n_tokens", "n_known", "base", "bits", "n_bytes",
                                        "rare", "grams"])

    id_type = d.schema["doc_id"].dataType.simpleString()
    rows = d.withColumn("sig", F.xxhash64("text")).mapInArrow(
        read, f"doc_id {id_type}, sig long, train boolean, n_tokens long, n_known long, base double, bits double, "
              "n_bytes long, rare array<binary>, grams array<struct<gram: long, k: long>>")
    rows = saved(rows, "texts")
    key = ["doc_id", "sig"]
    unknown = float(np.log10(1 / divisor))
    words = rows.select(*key, F.explode("rare").alias("word")).groupBy(*key, "word").agg(F.count("*").alias("k")) \
        .join(counts.where(F.col("n") < least), "word", "left")
    add = words.groupBy(*key).agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("more_known"),
        F.sum(F.col("k") * F.coalesce(F.log10((F.col("n") + 1) / divisor), F.lit(unknown))).alias("more_base"))
    copies = rows.groupBy(*key).agg(F.count("*").alias("copies"))
    out = joined_safely(joined_safely(rows.drop("rare", "grams"), copies, key), add, key)
    if not shared:
        of = rows.select(*key, F.explode("grams").alias("g")).select(*key, "g.gram", "g.k")
        more = of.join(scores, "gram").groupBy(*key).agg(F.sum(F.col("k") * F.col("bits")).alias("more_bits"))
        out = joined_safely(out, more, key)
    else:
        out = out.withColumn("more_bits", F.lit(0.0))
    def part(c):
        return F.coalesce(F.col(c) / F.col("copies"), F.lit(0.0))
    bits = F.col("bits") + part("more_bits")
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens",
                      (F.col("n_known") + part("more_known").cast("long")).alias("n_known"),
                      F.lit(train_tokens).cast("long").alias("train_tokens"),
                      (F.col("base") + part("more_base")).alias("base_score"),
                      (-bits * float(np.log10(2.0))).alias("score"), (bits / F.col("n_bytes")).alias("bits_per_byte"))

