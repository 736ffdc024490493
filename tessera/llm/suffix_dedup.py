"""Removal of repeated byte strings by sorted suffixes (deep-shallow sorting).

A byte is removed if some string of ``length`` bytes that covers it also starts earlier: in a
text with a smaller id, or earlier in the same text.  What counts is the input, so every start
of such a string has to be judged on its own.

1. Anchors.  Of the ``length - seed + 1`` seeds (strings of ``seed`` bytes) inside a window of
   ``length`` bytes, the one with the least hash, leftmost on ties, is the window's anchor.
   Equal windows have the same anchor at the same place, so they meet under the anchor's hash.
   Neighbouring windows share anchors: an anchor with its windows is one *context*, the bytes
   from its first window's start to its last window's end.
2. Hashes of anchors are counted over all texts, and those seen once are set aside by a filter of
   bounded size that never drops a repeated one.
3. Of equal contexts all but the first are repeats as a whole.  The first by (id, place) is a
   combinable minimum, so a passage that a third of all texts share is no hot group.
4. Anchors with several different contexts are compared byte by byte: per task, the suffixes that
   start at the anchors, and the reversed prefixes that end there, are sorted.  Multikey
   quicksort orders them to a shallow depth; groups that agree that far are put into blind tries,
   which branch on single bytes and are checked with one comparison per string.  Common prefix
   lengths of neighbours in both orders give, for every place of a window about its anchor, the
   classes of equal windows; all but the first of a class are repeats.  An anchor with more than
   ``most_contexts`` different contexts is judged by grouping its windows instead.
5. Repeated windows are joined into runs per text and cut out.

Nulls: a null text is empty; a null id sorts first (the least long counts as null).  Texts shorter than ``length`` are kept.
Long texts are scanned in overlapping pieces.  A repeated row (same id and text) counts as one
place: one of the rows is judged as the first, the others are removed if long enough.  Empty
tables give no rows.  Other columns are carried along by :func:`deduplicated`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bit_table, byte_codes, cleared, member_filter, mixed, powers, saved, utf8_buffer, written

LENGTH, SEED, SHALLOW = 100, 40, 16
NO_ID = -(1 << 63)  # stands for a null id in keys, so joins are on plain columns
PIECE = 1 << 20  # a power of two
_CODES = byte_codes(10)
_BASE = 0xBF58476D1CE4E5B9
_TABLES: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    if not _TABLES:
        _TABLES.extend([powers(4 * PIECE, _BASE), powers(4 * PIECE, pow(_BASE, -1, 1 << 64))])
    return _TABLES


# ---- anchors --------------------------------------------------------------------------------

def _window_least(v: np.ndarray, w: int) -> np.ndarray:
    """Least value of every run of ``w`` neighbours."""
    n = len(v) - w + 1
    pad = -len(v) % w
    x = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    left = np.minimum.accumulate(x, axis=1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1: w - 1 + n])


def _anchors_in(data: np.ndarray, off: np.ndarray, length: int, seed: int):
    """(text, first window, windows, anchor - first window, anchor hash, context hash) in ``data``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none, none
    up, down = _powers()
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[data] * up[:n], out=prefix[1:])
    h = mixed((prefix[seed:] - prefix[:-seed]) * down[: n - seed + 1])
    low = np.uint64(4 * PIECE - 1)
    v = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    at = (_window_least(v, length - seed + 1) & low).astype(np.int64)
    start = np.arange(len(at))
    text = np.searchsorted(off, start, side="right") - 1
    ok = start + length <= off[text + 1]
    start, at, text = start[ok], at[ok], text[ok]
    if not len(start):
        return none, none, none, none, none, none
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]))))
    lo, a, text = start[new], at[new], text[new]
    count = np.diff(np.append(new, len(start)))
    span = (prefix[lo + count - 1 + length] - prefix[lo]) * down[lo]
    ctx = mixed(span + (a - lo).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019) + count.astype(np.uint64))
    return text, lo - off[text], count, a - lo, h[a].view(np.int64), ctx.view(np.int64)


def anchors(column, length: int = LENGTH, seed: int = SEED):
    """Anchors of the texts of an Arrow column, a few texts (or a piece of a long one) at a time."""
    data, off = utf8_buffer(column)
    n, first = len(off) - 1, 0
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(off, off[first] + PIECE, side="right")) - 1))
        if off[last] - off[first] <= 2 * PIECE:
            got = _anchors_in(data[off[first]: off[last]], off[first: last + 1] - off[first], length, seed)
            yield (got[0] + first, *got[1:])
        else:
            for lo in range(int(off[first]), int(off[last]), PIECE):
                hi = min(lo + PIECE + length - 1, int(off[last]))
                got = _anchors_in(data[lo:hi], np.array([0, hi - lo]), length, seed)
                yield (got[0] + first, got[1] + (lo - int(off[first])), *got[2:])
        first = last


# ---- deep-shallow sorting -------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def blind_trie_order(items: list[int], strings: list[bytes]) -> list[int]:
    """``items`` in the order of their strings.  An inner node is [place, {byte: child}], a leaf
    a list of items with equal strings; -1 stands for the end of a string."""
    root = [items[0]]
    inner = None
    for i in items[1:]:
        s = strings[i]
        node = inner or root
        while isinstance(node, tuple):
            place, below = node
            node = below.get(s[place] if place < len(s) else -1) or next(iter(below.values()))
        t = strings[node[0]]
        k = common_prefix(s, t)
        if k == len(s) == len(t):
            node.append(i)
            continue
        new, old = (s[k] if k < len(s) else -1), (t[k] if k < len(t) else -1)
        above, node = None, inner or root
        while isinstance(node, tuple) and node[0] < k:
            above, node = node, node[1][s[node[0]]]
        if isinstance(node, tuple) and node[0] == k:
            node[1][new] = [i]
            continue
        branch = (k, {old: node, new: [i]})
        if above is None:
            inner = branch
        else:
            above[1][s[above[0]]] = branch
    out, todo = [], [inner or root]
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):
            todo.extend(node[1][c] for c in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow_order(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """The order of ``strings``: multikey quicksort on eight bytes at a time down to ``shallow``
    bytes, blind tries for what agrees that far."""
    n = len(strings)
    depth = shallow // 8
    head = b"".join(s[:shallow].ljust(shallow, b"\0") for s in strings)
    words = np.frombuffer(head, ">u8").reshape(n, depth).astype(np.uint64) if n else np.zeros((0, depth), np.uint64)
    out: list[int] = []
    todo = [(np.arange(n), 0)]
    while todo:
        items, d = todo.pop()
        if not len(items):
            continue
        if d == depth or len(items) == 1:
            out.extend(blind_trie_order(items.tolist(), strings) if len(items) > 1 else items.tolist())
            continue
        if len(items) <= 256:  # small parts: sort their words, then split where all agree
            order = items[np.lexsort([words[items, k] for k in range(depth - 1, d - 1, -1)])]
            w = words[order, d:]
            cut = np.flatnonzero((w[1:] != w[:-1]).any(axis=1)) + 1
            todo.extend((part, depth) for part in reversed(np.split(order, cut)))
            continue
        w = words[items, d]
        pivot = np.sort(w[[0, len(w) // 2, -1]])[1]
        todo += [(items[w > pivot], d), (items[w == pivot], d + 1), (items[w < pivot], d)]
    return out


def class_changes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix with the one before in that order)."""
    order = deep_shallow_order(strings)
    lcp = [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])]
    return np.array(order, np.int64), np.array(lcp, np.int64)


def repeated_windows(spans: list[bytes], off: np.ndarray, count: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Which windows of which contexts equal a window of an earlier context.

    Contexts come in the order of their places; ``off`` is the anchor's place in a span, ``count``
    the number of windows.  Row x, column o: the window that starts o bytes before x's anchor.
    """
    n, most = len(spans), length - seed
    r_order, r_lcp = class_changes([s[a:] for s, a in zip(spans, off)])
    l_order, l_lcp = class_changes([s[:a][::-1] for s, a in zip(spans, off)])
    flags = np.zeros((n, most + 1), bool)
    lowest = off - (count - 1)
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(most + 1):
        own = np.flatnonzero((lowest <= o) & (o <= off))
        if len(own) < 2:
            continue
        right[r_order] = np.cumsum(r_lcp < length - o)
        left[l_order] = np.cumsum(l_lcp < o)
        key = right[own] * (n + 1) + left[own]
        order = np.argsort(key, kind="stable")
        k = key[order]
        flags[own[order[1:][k[1:] == k[:-1]]], o] = True
    return flags


# ---- on Spark -------------------------------------------------------------------------------

SPAN = "first long, last long"  # first and last repeated window of a run


def repeated_runs(d: DataFrame, length: int = LENGTH, seed: int = SEED, most_contexts: int = 100_000) -> DataFrame:
    """Runs of repeated windows of ``d`` (doc_id long, sig, text): doc_id, sig, first, last."""
    spark = d.sparkSession

    def hashes(batches):
        for batch in batches:
            for got in anchors(batch.column(0), length, seed):
                h, n = np.unique(got[4], return_counts=True)
                yield pa.record_batch([pa.array(h, pa.int64()), pa.array(n, pa.int64())], ["h", "n"])

    seen = d.select("text").mapInArrow(hashes, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    seen = saved(seen.where("n > 1").select("h"), "repeated-anchors")
    bits = 1 << min(27, max(20, (8 * seen.count()).bit_length()))
    spots = seen.select(F.explode(F.array(F.col("h").bitwiseAND(F.lit(bits - 1)),
                                          F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(bits - 1)))).alias("p"))
    shared = spark.sparkContext.broadcast(bit_table(spots, bits))

    def occurrences(batches):
        table = shared.value
        mask = np.uint64(bits - 1)
        for batch in batches:
            for text, lo, count, off, h, ctx in anchors(batch.column("text"), length, seed):
                u = h.view(np.uint64)
                p, q = (u & mask).astype(np.int64), (u >> np.uint64(32) & mask).astype(np.int64)
                ok = (table[p >> 5] >> (p & 31).astype(np.uint32)) & (table[q >> 5] >> (q & 31).astype(np.uint32)) & 1 > 0
                of = pa.array(text[ok])
                yield pa.record_batch([pa.array(h[ok]), pa.array(ctx[ok]), batch.column("doc_id").take(of),
                                       batch.column("sig").take(of), pa.array(lo[ok]), pa.array(count[ok], pa.int64()),
                                       pa.array(off[ok], pa.int64())], ["h", "ctx", "doc_id", "sig", "lo", "count", "off"])

    found = d.mapInArrow(occurrences, "h long, ctx long, doc_id long, sig long, lo long, count long, off long")
    found = saved(found, "anchors")
    place = F.struct("doc_id", "sig", "lo")
    firsts = found.groupBy("h", "ctx").agg(F.min(place).alias("first"), F.first("count").alias("count"),
                                           F.first("off").alias("off"), F.count("*").alias("holders"))
    firsts = saved(firsts, "contexts")
    again = firsts.where("holders > 1").select("h", "ctx", F.col("first"))
    whole = found.join(again, ["h", "ctx"]).where(place > F.col("first")) \
        .select("doc_id", "sig", F.col("lo").alias("first"), (F.col("lo") + F.col("count") - 1).alias("last"))

    many = firsts.groupBy("h").agg(F.count("*").alias("contexts")).where("contexts > 1")
    parts = firsts.join(many, "h").select("h", "contexts", "first.doc_id", "first.sig", "first.lo", "count", "off")
    lists = parts.groupBy("doc_id", "sig").agg(F.collect_list(F.struct("h", "contexts", "lo", "count", "off")).alias("at"))
    lists = saved(lists, "open-contexts")
    own = member_filter(d, "sig", lists, "sig").dropDuplicates(["doc_id", "sig"])

    def cut(batches):
        for batch in batches:
            rows = []
            for i, sig, text, at in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "sig", "text", "at"))):
                raw = text.encode("utf-8", "surrogatepass")
                rows.extend((x["h"], x["contexts"], i, sig, x["lo"], x["count"], x["off"],
                             raw[x["lo"]: x["lo"] + x["count"] - 1 + length]) for x in at)
            names = ["h", "contexts", "doc_id", "sig", "lo", "count", "off", "span"]
            kinds = [pa.int64()] * 7 + [pa.binary()]
            for k in range(0, len(rows), 20_000):
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[k: k + 20_000]), kinds)], names)

    spans = own.join(lists, ["doc_id", "sig"]).select("doc_id", "sig", "text", "at") \
        .mapInArrow(cut, "h long, contexts long, doc_id long, sig long, lo long, count long, off long, span binary")
    spans = saved(spans, "spans")

    def compare(batches):
        held: list[pa.RecordBatch] = []

        def judged(t: pa.Table):
            t = t.take(pa.array(np.lexsort([t.column(c).to_numpy() for c in ("lo", "sig", "doc_id")])))
            lo, off = t.column("lo").to_numpy(), t.column("off").to_numpy()
            flags = repeated_windows(t.column("span").to_pylist(), off, t.column("count").to_numpy(), length, seed)
            edge = np.zeros((len(flags), 1), np.int8)
            step = np.diff(np.concatenate([edge, flags.astype(np.int8), edge], axis=1), axis=1)
            row, begin = np.nonzero(step == 1)
            _, end = np.nonzero(step == -1)
            a = (lo + off)[row]
            of = pa.array(row)
            return pa.record_batch([t.column("doc_id").take(of).combine_chunks(), t.column("sig").take(of).combine_chunks(),
                                    pa.array(a - (end - 1)), pa.array(a - begin)], ["doc_id", "sig", "first", "last"])

        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= 40_000:
                t = pa.Table.from_batches(held)
                h = t.column("h").to_numpy()
                cut_at = int(np.searchsorted(h, h[-1]))
                if cut_at:
                    yield judged(t.slice(0, cut_at))
                held, size = t.slice(cut_at).to_batches(), len(t) - cut_at
        if size:
            yield judged(pa.Table.from_batches(held))

    run = "doc_id long, sig long, first long, last long"
    near = spans.where(F.col("contexts") <= most_contexts)
    n = max(1, -(-near.count() // 40_000))
    sorted_spans = near.repartition(max(n, spark.sparkContext.defaultParallelism), "h").sortWithinPartitions("h")
    some = sorted_spans.mapInArrow(compare, run)

    crowd = spans.where(F.col("contexts") > most_contexts)
    windows = crowd.select("doc_id", "sig", "lo", "span", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1))
                           .alias("k", "_")) \
        .select("doc_id", "sig", (F.col("lo") + F.col("k")).alias("lo"),
                F.substring(F.col("span"), F.col("k") + 1, F.lit(length)).alias("w"))
    lead = windows.groupBy("w").agg(F.min(place).alias("first"))
    crowd = windows.join(lead, "w").where(place > F.col("first")) \
        .select("doc_id", "sig", F.col("lo").alias("first"), F.col("lo").alias("last"))
    return saved(whole.union(some).union(crowd), "runs")


def removed_spans(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs [from, to) of removed bytes."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [tuple(x) for x in out]


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


CUT = "n_removed long, n_spans long, kept_sha256 string, kept string"


def _cut_texts(d: DataFrame, runs: DataFrame, length: int, with_text: bool) -> DataFrame:
    """doc_id, sig and CUT for every text that loses bytes."""
    lists = saved(runs.groupBy("doc_id", "sig").agg(F.collect_set(F.struct("first", "last")).alias("runs")), "cuts")
    own = member_filter(d, "sig", lists, "sig").dropDuplicates(["doc_id", "sig"])

    def cut(batches):
        for batch in batches:
            rows = []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                spans = removed_spans([(r["first"], r["last"]) for r in runs], length)
                kept = kept_bytes(text.encode("utf-8", "surrogatepass"), spans)
                rows.append((sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest(),
                             kept.decode("utf-8", "ignore") if with_text else None))
            c = list(zip(*rows)) or [[]] * 4
            yield pa.record_batch([batch.column("doc_id"), batch.column("sig"), pa.array(c[0], pa.int64()),
                                   pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()), pa.array(c[3], pa.string())],
                                  ["doc_id", "sig", "n_removed", "n_spans", "kept_sha256", "kept"])

    return own.join(lists, ["doc_id", "sig"]).select("doc_id", "sig", "text", "runs") \
        .mapInArrow(cut, "doc_id long, sig long, " + CUT)


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(body).alias("sig"), body.alias("text"))


def removal(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """One row per text: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    d = _named(docs, doc_id, text)
    cuts = _cut_texts(d, repeated_runs(d, length, seed), length, False).drop("kept")
    raw = F.encode("text", "UTF-8")
    rows = d.groupBy("doc_id", "sig").agg(F.count("*").alias("rows"), F.first(F.length(raw)).cast("long").alias("n_bytes"),
                                          F.first(F.sha2(raw, 256)).alias("sha"))
    out = rows.join(cuts, ["doc_id", "sig"], "left")
    out = out.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    again = (F.col("row") > 1) & (F.col("n_bytes") >= length)
    return out.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_bytes",
                      F.when(again, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                      F.when(again, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
                      F.when(again, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``docs`` with repeats cut out of ``text``; texts of which no byte is left are dropped.  A
    character that a cut splits goes as a whole.  Of rows with equal id and text one stays."""
    d = _named(docs, doc_id, text)
    mark = written()
    cuts = saved(_cut_texts(d, repeated_runs(d, length, seed), length, True), "cut-texts")
    cleared(docs.sparkSession, mark, keep=cuts)
    columns = docs.columns
    rows = docs.withColumn("_id", F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))) \
        .withColumn("_sig", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    longs = F.length(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")) >= length
    rows = rows.where(longs).dropDuplicates(["_id", "_sig"]).unionByName(rows.where(~longs))
    cuts = cuts.select(F.col("doc_id").alias("_id"), F.col("sig").alias("_sig"), F.col("kept").alias("_kept"))
    out = rows.join(cuts, ["_id", "_sig"], "left")
    return out.where(F.col("_kept").isNull() | (F.col("_kept") != "")) \
        .withColumn(text, F.coalesce("_kept", F.col(text))).select(*columns)
