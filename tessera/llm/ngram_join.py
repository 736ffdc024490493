"""N-gram Jaccard join: texts whose sets of word n-grams are alike, and the groups they form.

A text's set holds its distinct n-word shingles (lower-cased A-Z), or its whole word sequence if
it has fewer words.  Texts with equal sets are one node.  Two nodes are linked when
``den * |x & y| >= num * |x | y|``.  The join works on prefixes under one total order of
shingles, rare first: two linked sets of sizes n and m share a shingle among the first
``n - ceil(t n) + 1`` and ``m - ceil(t m) + 1`` of theirs.  The order comes from counting all
shingles of all texts in a fixed number of counters (a shingle's counter is an upper bound of
its frequency); ties go by hash, so every task has the same order whatever the counters hold.

Candidates share a prefix shingle and pass
* the length filter: the sizes alone allow the overlap that is needed;
* the positional filter: what is left of both sets after their first common shingle suffices;
* the suffix filter: with both sets cut by 63 fixed pivots into 64 ranges, the sum over ranges
  of the smaller count suffices.
Each candidate pair is verified once, on the texts.

Groups are found without all pairs of a group: first every prefix shingle's holders are paired
with one leader (linear in the postings, and a combinable minimum finds the leader of a hot
shingle); then only pairs of nodes that are still in different components are joined.  No link
between different components is lost, so the components are those of the full link graph.

Nulls: a null text has no words; a null id is carried along and never the name of a component.
Texts without words have size 0 and link with nothing.  Texts are read whole, long ones too.
Repeated rows are members of one node.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import (bit_table, byte_codes, cleared, components, dropped, in_slices, lower_ascii, member_filter, mixed,
                                powers, released, saved, utf8_buffer, written)

_CODES = byte_codes(1)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = [np.uint64(x | 1) for x in mixed(np.arange(64, dtype=np.uint64) + np.uint64(77)).tolist()]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
RANGES = 64
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, n.bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = powers(size, _BASE), powers(size, _INVERSE)
    return _POWERS[size]


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in ``data`` and the offsets of the texts in them."""
    data = lower_ascii(data)
    n = len(data)
    up, down = _powers(n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[data] * up[:n], out=prefix[1:])
    solid = ~_SPACES[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cut = off[:-1][np.diff(off) > 0]
    begins[cut] = solid[cut]
    starts = np.flatnonzero(begins)
    ends_mask = solid.copy()
    ends_mask[:-1] &= ~solid[1:]
    last = off[1:][np.diff(off) > 0] - 1
    ends_mask[last] = solid[last]
    ends = np.flatnonzero(ends_mask) + 1
    h = mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(starts, off)


def shingle_sets(column, words: int, most: int = 1 << 21):
    """The sorted distinct shingle hashes of every text of an Arrow column, one array a text."""
    data, off = utf8_buffer(column)
    n, first = len(off) - 1, 0
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(off, off[first] + most, side="right")) - 1))
        part, at = data[off[first]: off[last]], off[first: last + 1] - off[first]
        h, wo = word_hashes(part, at)
        m = len(h) - words + 1
        full = np.zeros(max(0, m), np.uint64)
        for j in range(words):
            full += h[j: j + len(full)] * _STEP[j]
        full = mixed(full)
        for i in range(last - first):
            a, b = int(wo[i]), int(wo[i + 1])
            if b - a >= words:
                yield np.unique(full[a: b - words + 1])
            elif b > a:
                s = np.uint64(b - a)
                for j in range(b - a):
                    s = s + h[a + j: a + j + 1] * _STEP[j + words]
                yield mixed(s)
            else:
                yield np.zeros(0, np.uint64)
        first = last


def set_key(s: np.ndarray) -> int:
    """A 64-bit name of a set of hashes."""
    total = np.array([len(s)], np.uint64) * _STEP[0] + np.add.reduce(mixed(s ^ _STEP[1]), keepdims=True)
    return int(mixed(total).view(np.int64)[0])


def shingle_counters(texts: DataFrame, words: int, counters: int) -> np.ndarray:
    """In how many texts (at most) the shingles of each of ``counters`` classes occur."""
    def count(batches):
        total = np.zeros(counters, np.int64)
        for batch in in_slices(batches, 2000, 4 << 20):
            for s in shingle_sets(batch.column(0), words):
                np.add.at(total, (s & np.uint64(counters - 1)).astype(np.int64), 1)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["c", "n"])
    got = texts.select("text").mapInArrow(count, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(counters, np.int64)
    out[got.column("c").to_numpy()] = got.column("n").to_numpy()
    return out


def _least(n, num: int, den: int):
    """ceil(num / den * n)"""
    return -(-num * n // den)


def set_table(texts: DataFrame, words: int, num: int, den: int, counters: int) -> DataFrame:
    """One row per text: doc_id, node, n, prefix (in order), ranges (counts by hash range), text."""
    rank = shingle_counters(texts, words, counters)
    rank = np.minimum(rank, (1 << 23) - 1).astype(np.uint64) << np.uint64(40)
    shared = texts.sparkSession.sparkContext.broadcast(rank)

    def describe(batches):
        rank = shared.value
        mask = np.uint64(counters - 1)
        for batch in in_slices(batches, 2000, 4 << 20):
            node, size, prefix, ranges = [], [], [], []
            for s in shingle_sets(batch.column("text"), words):
                n = len(s)
                node.append(set_key(s))
                size.append(n)
                p = n - _least(n, num, den) + 1 if n else 0
                place = rank[(s & mask).astype(np.int64)] | s >> np.uint64(24)
                if p < n:
                    some = np.argpartition(place, p - 1)[:p]
                    some.sort()
                    first = some[np.argsort(place[some], kind="stable")]
                else:
                    first = np.argsort(place, kind="stable")
                prefix.append(s[first].view(np.int64))
                ranges.append(np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=RANGES).astype(np.int32))
            flat = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
            ends = np.concatenate(([0], np.cumsum([len(x) for x in prefix]))).astype(np.int32)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(node, pa.int64()), pa.array(size, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                 pa.array([x.tobytes() for x in ranges], pa.binary()), batch.column("text")],
                ["doc_id", "node", "n", "prefix", "ranges", "text"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(describe, f"doc_id {kind}, node long, n long, prefix array<long>, ranges binary, text string")


def _verified(pairs: DataFrame, sets: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of nodes whose texts' sets are alike enough."""
    def linked(batches):
        for batch in in_slices(batches, 1000, 4 << 20):
            ok = []
            for x, y in zip(shingle_sets(batch.column("left"), words), shingle_sets(batch.column("right"), words)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    t = _texts_of(sets, pairs)
    links = saved(pairs.join(t.toDF("a", "left"), "a").join(t.toDF("b", "right"), "b")
                  .select("a", "b", "left", "right").mapInArrow(linked, "a long, b long"), "links")
    dropped(t)
    return links


def _range_filter(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose counts by hash range leave room for the overlap needed."""
    @F.pandas_udf("boolean")
    def room(left, right, n, m):
        import pandas as pd
        x = np.frombuffer(b"".join(left), np.int32).reshape(-1, RANGES).astype(np.int64)
        y = np.frombuffer(b"".join(right), np.int32).reshape(-1, RANGES).astype(np.int64)
        most = np.minimum(x, y).sum(axis=1)
        return pd.Series(den * most >= num * (n.to_numpy() + m.to_numpy() - most))

    t = nodes.select("node", "ranges", "n")
    return (pairs.join(t.toDF("a", "left", "n"), "a").join(t.toDF("b", "right", "m"), "b")
            .where(room("left", "right", "n", "m")).select("a", "b"))


def _meet(x: DataFrame, y: DataFrame, num: int, den: int, condition) -> DataFrame:
    """Candidate pairs (a, b) of postings ``x`` and ``y`` that share a shingle and pass the length
    and positional filters; each pair once.

    The positional filter is that of a first common shingle: what stands before it in either set
    is not in the other.  A later common shingle may fail it, but a linked pair passes at its
    first, which is in both prefixes; so no link is lost and few shingles name a pair twice."""
    p, q = x.toDF(*[f"{c}_x" for c in x.columns]), y.toDF(*[f"{c}_y" for c in y.columns])
    n, m, i, j = F.col("n_x"), F.col("n_y"), F.col("pos_x"), F.col("pos_y")
    def enough(overlap):  # J >= num / den  <=>  (num + den) * overlap >= num * (n + m)
        return (num + den) * overlap >= num * (n + m)
    pairs = p.join(q, (p.token_x == q.token_y) & (F.col("node_x") != F.col("node_y")) & enough(F.least(n, m))
                   & enough(F.least(n - i, m - j)) & condition)
    a, b = F.least("node_x", "node_y"), F.greatest("node_x", "node_y")
    return pairs.select(a.alias("a"), b.alias("b")).distinct()


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, num: int = 90,
            den: int = 100, counters: int = 1 << 18) -> DataFrame:
    """One row per text: doc_id, n_shingles, component_id (least id of its component), n_links
    (verified links of its node that the search needed)."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    members = saved(set_table(d, words, num, den, counters), "sets", compression="zstd")  # holds the texts
    nodes = members.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("ranges").alias("ranges"))
    posts = members.where("n > 0").select("node", "n", F.posexplode("prefix").alias("pos", "token"))
    common = posts.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    common = saved(common.select("token"), "common-shingles")
    held = member_filter(posts, "token", common, "token").groupBy("token", "node").agg(F.first("n").alias("n"),
                                                                                       F.first("pos").alias("pos"))
    order = ["token", "node", "n", "pos"]
    held = saved(held.join(common, "token").select(*order), "postings")
    dropped(common)
    released(docs.sparkSession)
    # the holder with the fewest rare shingles before the token stands in the middle of its kind
    leads = held.groupBy("token").agg(F.min(F.struct("pos", "n", "node")).alias("lead")) \
        .select("token", "lead.node", "lead.n", "lead.pos")
    met = saved(_meet(held, leads.select(*order), num, den, F.lit(True)), "led-pairs")
    pairs = saved(_range_filter(met, nodes, num, den), "led-candidates")
    dropped(met)
    links = _verified(pairs, members, words, num, den)
    parts = components(links)

    def part_of(rows, node="node"):
        p = parts.select(F.col("node").alias("_n"), "root")
        return rows.join(p, F.col(node) == F.col("_n"), "left") \
            .withColumn("part", F.coalesce("root", F.col(node))).drop("_n", "root")

    grouped = part_of(held)
    mixed_tokens = grouped.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    rest = saved(grouped.join(mixed_tokens.select("token"), "token", "left_semi").select(*order, "part"), "open-postings")
    met = saved(_meet(rest, rest, num, den, F.col("part_x") < F.col("part_y")).join(pairs, ["a", "b"], "left_anti"),
                "open-pairs")
    again = saved(_range_filter(met, nodes, num, den), "open-candidates")
    more = _verified(again, members, words, num, den)
    joined = part_of(part_of(more, "a").withColumnRenamed("part", "x"), "b").select("x", F.col("part").alias("y"))
    roots = components(joined, "x", "y").select(F.col("node").alias("_r"), F.col("root").alias("top"))
    for done in (held, pairs, rest, met, again):
        dropped(done)

    rows = part_of(members.select("doc_id", "node", "n"))
    rows = rows.join(roots, rows.part == roots._r, "left").withColumn("part", F.coalesce("top", "part")).drop("_r", "top")
    degree = links.union(more)
    degree = degree.select("a").union(degree.select("b")).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n_links"))
    names = rows.where("n > 0").groupBy("part").agg(F.min("doc_id").alias("component_id"))
    some = rows.where("n > 0").join(names, "part").join(degree, "node", "left") \
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                      F.lit(0).cast("long").alias("n_links"))
    return some.unionByName(none)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, num: int = 80,
                den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay when one text of each group does: the one with the least
    id; of a group's rows with this id the one whose text sorts first, of equal rows one.  Where
    an id comes with texts of several groups, each group keeps its own.  Texts without words and
    rows without an id are left as they are."""
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.when(F.col(doc_id).isNotNull(), F.struct(F.col(doc_id).alias("id"), F.xxhash64(body).alias("h")))
    mark = written()
    groups = saved(similar(docs.select(key.alias("_key"), text), "_key", text, words, num, den), "groups")
    cleared(docs.sparkSession, mark, keep=groups)
    first = groups.where("doc_id.id = component_id.id") \
        .select(F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).distinct()
    # texts are ordered only where a group's least id comes with several of them
    first = first.join(first.groupBy("_group").agg(F.count("*").alias("_texts")), "_group")
    solid = body.rlike("[^\\x20\\x09-\\x0D]") & F.col(doc_id).isNotNull()
    found = docs.where(solid).withColumn("_key", key).join(first, "_key")
    w = W.partitionBy("_group").orderBy(text)
    lone = found.where("_texts = 1").dropDuplicates(["_key"]).select(*docs.columns)
    one = found.where("_texts > 1").withColumn("_row", F.row_number().over(w)).where("_row = 1").select(*docs.columns)
    return lone.unionByName(one).unionByName(docs.where(~solid))


def _texts_of(sets: DataFrame, pairs: DataFrame, bits: int = 1 << 23) -> DataFrame:
    """One text for every node of ``pairs`` (and a few others): written once, read by both joins.

    Names of nodes are hashes, so some of their bits say where they stand in a bit set of fixed
    size that tells tasks which texts to send on."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("k"))
    spots = ends.select(F.explode(F.array(F.col("k").bitwiseAND(F.lit(bits - 1)),
                                          F.shiftrightunsigned("k", 32).bitwiseAND(F.lit(bits - 1)))).alias("p"))
    shared = sets.sparkSession.sparkContext.broadcast(bit_table(spots, bits))

    @F.pandas_udf("boolean")
    def wanted(node):
        import pandas as pd
        table, k = shared.value, node.to_numpy()
        p, q = k & (bits - 1), (k.view(np.uint64) >> np.uint64(32)).astype(np.int64) & (bits - 1)
        return pd.Series(((table[p >> 5] >> (p & 31).astype(np.uint32)) & (table[q >> 5] >> (q & 31).astype(np.uint32)) & 1) > 0)

    t = sets.where(wanted("node")).select("node", "text")
    return saved(t.groupBy("node").agg(F.first("text").alias("text")), "node-texts")
