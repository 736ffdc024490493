"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

The vocabulary is a table (word, n).  Every word's neighbourhood is generated: all strings that one deleted, replaced
or inserted code point makes of it, over the code points that the vocabulary uses.  Each string is
probed against blocked Bloom filters, one for every word length (a filter's words of 64 bits are its
blocks, a key sets up to five bits of one block); only what passes is shuffled, as (candidate, word), to an exact
join with the vocabulary, which removes the false positives.  Hashes are polynomials over the code points, so
the hash of an edit follows from the word's without its string being built.

Filters are summed on Spark, block by block, and broadcast.  They have about ``bits`` bits a word; ``most_blocks``
blocks are broadcast at a time.  A larger vocabulary is probed in as many rounds, each against filters of some
lengths, or of a part of the words of one length, so a broadcast never grows beyond that and nothing is left out.

A word's form is its near word with the largest n (ties: the first by code points) if that is at least
``ratio`` times its own; roots follow the forms by pointer doubling, a logarithmic number of rounds.

Null words and null counts are left out of the vocabulary, equal words are summed, the empty word is
near the words of one code point.  Words of any length are taken whole.  An empty vocabulary gives no rows;
other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import in_slices, mixed
from tessera.tables import dropped, reliable

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: words of this many code points and more share one filter; their hashes tell their lengths apart
LONG = 64
_BASE = 0x9E3779B97F4A7C15
_PROBES = 1 << 17


# ---- vocabulary -------------------------------------------------------------------------------

def small(c: Column) -> Column:
    """A-Z in lower case, nothing else (``translate`` is dear, few words need it)."""
    return F.when(c.rlike("[A-Z]"), F.translate(c, UPPER, LOWER)).otherwise(c)


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least_n: int = 3,
                misspelt: int | None = None) -> DataFrame:
    """Words of at least ``least_length`` code points and how often they occur: word, n.

    Words are the maximal runs of letters of whole texts, A-Z lower-cased.  With ``misspelt`` = m,
    a run for which m divides h, the crc32 of ``<doc_id>:<run>`` in UTF-8 (a null id is empty),
    loses its code point h % length.  Null texts have no words.
    """
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text), F.lit(f"([{LETTERS}]{{{least_length},}})"), F.lit(1))).alias("run"))
    runs = runs.select("id", small(F.col("run")).alias("run"))
    if misspelt:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = F.pmod(F.col("h"), F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.withColumn("h", h).select(F.when(F.pmod("h", F.lit(misspelt)) == 0, cut).otherwise(F.col("run")).alias("run"))
        runs = runs.where(F.length("run") >= least_length)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


# ---- hashes of words and of their edits -------------------------------------------------------

def by_length(words: list[str]):
    """(indices, code points as a matrix, words x length) of the words of every length."""
    of: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        of.setdefault(len(w), []).append(i)
    for n, rows in of.items():
        codes = np.frombuffer("".join(words[i] for i in rows).encode("utf-32-le", "surrogatepass"), np.uint32)
        yield np.array(rows), codes.reshape(len(rows), n).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    """base**(n-1) .. base**0 modulo 2**64."""
    p = np.full(n, _BASE, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)[::-1] if n else p


def _sums(codes: np.ndarray) -> np.ndarray:
    return (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def _finished(h: np.ndarray, length: int) -> np.ndarray:
    return mixed(h + np.uint64((length + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1))


def word_hashes(codes: np.ndarray) -> np.ndarray:
    return _finished(_sums(codes), codes.shape[1])


def edit_hashes(codes: np.ndarray, letters: np.ndarray, kind: str):
    """Slices of (hash, row, place, letter) of all edits of one kind; strings that several edits make come once.

    Deleted: the last of a run of equal code points goes.  Inserted: before the place, not behind its equal.
    """
    rows, n = codes.shape
    pw = _powers(n + 1)  # pw[k] = base**(n-k)
    whole = _sums(codes)
    heads = np.zeros((rows, n + 1), np.uint64)  # hash of the first k code points
    for k in range(n):
        heads[:, k + 1] = heads[:, k] * np.uint64(_BASE) + codes[:, k]
    tails = whole[:, None] - heads * pw[None, :]  # of the rest, at its own powers
    if kind == "deleted":
        last = np.ones((rows, n), bool)
        last[:, :-1] = codes[:, :-1] != codes[:, 1:]
        r, p = np.nonzero(last)
        yield _finished(heads[r, p] * pw[p + 1] + tails[r, p + 1], n - 1), r, p, np.zeros(len(r), np.uint64)
        return
    places = n if kind == "replaced" else n + 1
    step = max(1, _PROBES // max(1, places * len(letters)))
    across = max(1, _PROBES // max(1, len(letters)))
    for r0 in range(0, rows, step):
        r1 = min(rows, r0 + step)
        for p0 in range(0, places, across):
            p1 = min(places, p0 + across)
            if kind == "replaced":
                own = codes[r0:r1, p0:p1, None]
                h = whole[r0:r1, None, None] + (letters - own) * pw[p0 + 1: p1 + 1, None]
                new = letters != own
            else:
                before = np.full((r1 - r0, p1 - p0, 1), 0xFFFFFFFF, np.uint64)  # no letter
                a = max(p0, 1)
                before[:, a - p0:, 0] = codes[r0:r1, a - 1: p1 - 1]
                h = (heads[r0:r1, p0:p1, None] * np.uint64(_BASE) + letters) * pw[p0:p1, None] + tails[r0:r1, p0:p1, None]
                new = letters != before
            r, p, c = np.nonzero(new)
            yield _finished(h[r, p, c], n + (kind == "inserted")), r + r0, p + p0, letters[c]


# ---- filters ----------------------------------------------------------------------------------

@dataclass
class Shard:
    """The filter of one length, or of one part (by hash) of its words."""
    length: int
    part: int
    parts: int
    first: int  # block
    blocks: int  # a power of two


def planned(n_by_length: dict[int, int], bits: int, most_blocks: int) -> list[list[Shard]]:
    """Rounds of filters, each of at most ``most_blocks`` blocks (a power of two)."""
    rounds: list[list[Shard]] = [[]]
    used = 0
    for length in sorted(n_by_length):
        need = max(1, -(-n_by_length[length] * bits // 64))
        parts = -(-need // most_blocks)
        blocks = min(most_blocks, 1 << (-(-need // parts) - 1).bit_length())
        for part in range(parts):
            if used + blocks > most_blocks and rounds[-1]:
                rounds.append([])
                used = 0
            rounds[-1].append(Shard(length, part, parts, used, blocks))
            used += blocks
    return rounds


def _places(h: np.ndarray, shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """(block, bits) of every hash."""
    block = (h >> np.uint64(40)) & np.uint64(shard.blocks - 1)
    bits = np.uint64(1) << (h & np.uint64(63))
    for k in (6, 12, 18, 24):
        bits |= np.uint64(1) << ((h >> np.uint64(k)) & np.uint64(63))
    return block.astype(np.int64) + shard.first, bits


def _of_part(h: np.ndarray, shard: Shard) -> np.ndarray:
    return (mixed(h) >> np.uint64(8)) % np.uint64(shard.parts) == np.uint64(shard.part)


def filled(words: DataFrame, shards: list[Shard]) -> np.ndarray:
    """The filters of a round as one array of blocks."""
    def spots(batches):
        for batch in in_slices(batches, 4096, 1 << 20):
            blocks, bits = [], []
            for _, codes in by_length(batch.column("word").to_pylist()):
                h = word_hashes(codes)
                for s in shards:
                    if s.length == min(codes.shape[1], LONG):
                        b, m = _places(h[_of_part(h, s)] if s.parts > 1 else h, s)
                        blocks.append(b)
                        bits.append(m)
            if blocks:
                yield pa.record_batch([np.concatenate(blocks), np.concatenate(bits).view(np.int64)], ["block", "bits"])

    wanted = words.where(F.least(F.length("word"), F.lit(LONG)).isin([s.length for s in shards]))
    got = wanted.select("word").mapInArrow(spots, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(max(s.first + s.blocks for s in shards), np.uint64)
    table[got.column("block").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return table


def _made(word: str, kind: str, place: int, letter: int) -> str:
    return word[:place] + (chr(letter) if kind != "deleted" else "") + word[place + (kind != "inserted"):]


def candidates(words: DataFrame, shards: list[Shard], table: np.ndarray, letters: np.ndarray) -> DataFrame:
    """(candidate, word, n): the edits that a round's filters let pass."""
    shared = words.sparkSession.sparkContext.broadcast(table)
    kinds = (("deleted", -1), ("replaced", 0), ("inserted", 1))

    def probed(batches):
        filters = shared.value
        for batch in in_slices(batches, 2000, 1 << 20):
            own, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            out, of = [], []
            for rows, codes in by_length(own):
                for kind, more in kinds:
                    length = codes.shape[1] + more
                    for s in shards:
                        if length < 0 or s.length != min(length, LONG):
                            continue
                        for h, r, p, c in edit_hashes(codes, letters, kind):
                            block, bits = _places(h, s)
                            hit = (filters[block] & bits) == bits
                            if s.parts > 1:
                                hit &= _of_part(h, s)
                            hit = np.flatnonzero(hit)
                            for i, place, letter in zip(rows[r[hit]].tolist(), p[hit].tolist(), c[hit].tolist()):
                                out.append(_made(own[i], kind, place, letter))
                                of.append(i)
            if out:
                yield pa.record_batch([pa.array(out), pa.array([own[i] for i in of]), pa.array([n[i] for i in of], pa.int64())],
                                      ["candidate", "word", "n"])

    lengths = {s.length for s in shards}
    near = [F.least(F.greatest(F.length("word") + more, F.lit(0)), F.lit(LONG)).isin(list(lengths)) for _, more in kinds]
    return words.where(near[0] | near[1] | near[2]).select("word", "n").mapInArrow(probed, "candidate string, word string, n long")


# ---- neighbours, forms, roots -----------------------------------------------------------------

def vocabulary(words: DataFrame) -> DataFrame:
    return words.where("word is not null and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))


def near_pairs(words: DataFrame, bits: int = 20, most_blocks: int = 1 << 22) -> DataFrame:
    """Every (word, n, near, near_n) of different words of a written vocabulary one edit apart."""
    sizes = {r["k"]: r["c"] for r in words.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("k"))
             .agg(F.count("*").alias("c")).collect()}
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()
    letters = np.array(sorted(ord(r["c"]) for r in letters), np.uint64)
    passed = None
    for shards in planned(sizes, bits, most_blocks):
        if shards:
            some = candidates(words, shards, filled(words, shards), letters)
            passed = some if passed is None else passed.union(some)
    if passed is None:
        return words.where("false").select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    known = words.select(F.col("word").alias("w"), F.col("n").alias("wn"))
    return passed.join(known, passed["candidate"] == known["w"]).select(F.col("w").alias("word"), F.col("wn").alias("n"),
                                                                       F.col("word").alias("near"), F.col("n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the end of its chain (forms have ever larger n)."""
    known = reliable(forms.select("word", F.col("form").alias("root")))
    while True:
        step = known.select(F.col("word").alias("at"), F.col("root").alias("next"))
        got = reliable(known.join(step, known["root"] == step["at"], "left")
                       .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = got.where("moved").limit(1).count()
        dropped(known)
        known = got.select("word", "root")
        if not moved:
            return known


def variants(words: DataFrame, ratio: int = 2, bits: int = 20, most_blocks: int = 1 << 22) -> DataFrame:
    """One row per word: word, form, root, n, n_near (near words), form_n."""
    words = reliable(vocabulary(words))
    near = near_pairs(words, bits, most_blocks).groupBy("word") \
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = reliable(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                                             *[F.when(-F.col("best.less") >= F.col("n") * ratio, c).alias(a)
                                                               for c, a in ((F.col("best.near"), "form"), (-F.col("best.less"), "form_n"))]))
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
