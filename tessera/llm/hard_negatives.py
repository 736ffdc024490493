"""Hard negatives by an inverted multi-index.

Rows are (id, label, vector of whole numbers); a score is an inner product, higher ones come first, ties
by the smaller id.  Both halves of the vectors have a codebook (k-means on at most ``most_sampled`` rows, those with
the least hashes); a row lies in the cell of its two nearest centroids, and every row is indexed.  A cell keeps the
largest distance of its rows' halves from their centroids, so ``q1.c1 + |q1| r1 + q2.c2 + |q2| r2`` bounds every
score in it.

For an anchor the cells are visited by the multi-sequence heap: both codebooks are sorted by their half
bounds (with the largest radius of a code), and the heap gives pairs by falling sums.  An anchor asks
for the ``k`` best rows in each of some windows of scores.  A window is certified when it has k rows
and the next sum is below the least of them, or when the next sum is below the window; an anchor stops when all its
windows are.  So results are exact, whatever the codebooks are worth.

On Spark the anchors still open visit their next cells in rounds, four times as many each time.  Cells
are cut by hash into blocks of about ``block_rows`` rows, anchors gathered into groups of about as many, and
groups meet blocks by (cell, block): hot cells and cells that all anchors want spread over tasks.  The best
rows of an anchor so far travel with it, so that blocks return only what still counts.  These joins never broadcast: a plan
is small as a file, but its visits, laid out one by one, may be many times what a driver holds.  First the windows without ends of
the positives are answered, then those below each positive's score.

Rows with a null id, label or vector or a null or non-finite component take no part.  Equal rows count
once; rows that share an id are rows of their own, but never partners of an anchor with that id.  Short vectors are filled with
zeros.  Anchors without positives and empty tables give no rows.  A ValueError is raised where scores could
reach 2^62, which no long holds safely.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import in_slices, small_batches
from tessera.tables import dropped, reliable

WINDOWS = "array<struct<w: int, lo: long, hi: long, least: long>>"
STATE = f"anchor long, own long, label long, vec binary, windows {WINDOWS}, done long"
PLAN = STATE + ", ends binary, next double, head boolean, visits array<struct<at: long, part: long>>"
FAR = 1 << 62
VISITS = 256  # of a row of a plan


def usable(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    x = F.col(vector)
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return rows.where(F.col(key).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & whole) \
        .select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), x.alias("vector"))


# ---- the index --------------------------------------------------------------------------------

@dataclass
class Index:
    """Codebooks and cells; the size is bounded by the number of codes."""
    books: list[np.ndarray]  # per half: codes x dimensions
    half: int
    kind: str  # of the stored components
    exact: str  # of the products
    cells: np.ndarray  # sorted: first code * codes + second code
    parts: np.ndarray
    radii: np.ndarray  # cells x 2

    def __post_init__(self):
        codes = len(self.books[0])
        self.reach = []  # per half: largest radius of every code, -1 without rows
        for h, of in enumerate((self.cells // codes, self.cells % codes)):
            r = np.full(codes, -1.0)
            np.maximum.at(r, of, self.radii[:, h])
            self.reach.append(r)

    def vectors(self, raw) -> np.ndarray:
        return np.frombuffer(b"".join(raw), self.kind).reshape(len(raw), -1).astype(self.exact)

    def visits(self, q: np.ndarray, windows: list[dict], done: int, take: int):
        """The next cells of an anchor: (cells, places taken from the heap, bound of the next place or None)."""
        codes = len(self.books[0])
        sums, norms, order = [], [], []
        for book, reach, part in zip(self.books, self.reach, (q[:self.half], q[self.half:])):
            part = part.astype(np.float64)
            norm = float(np.sqrt(part @ part))
            own = book @ part
            bound = own + norm * reach
            bound += 1e-9 * (np.abs(own) + norm * reach) + 1e-6  # rounding
            some = np.flatnonzero(reach >= 0)
            some = some[np.argsort(-bound[some], kind="stable")]
            order.append((some, bound[some].tolist()))
            sums.append(own)
            norms.append(norm)
        (first, high1), (second, high2) = order
        need = min((w["lo"] if w["least"] is None else w["least"]) for w in windows)
        top = max(w["hi"] for w in windows)
        heap = [(-(high1[0] + high2[0]), 0, 0)]
        found, places = [], 0
        while heap and -heap[0][0] >= need and len(found) < take:
            some = []  # places that are looked at together
            while heap and -heap[0][0] >= need and len(some) < max(64, take - len(found)):
                place = heappop(heap)
                _, a, b = place
                places += 1
                if b + 1 < len(high2):
                    heappush(heap, (-(high1[a] + high2[b + 1]), a, b + 1))
                if b == 0 and a + 1 < len(high1):
                    heappush(heap, (-(high1[a + 1] + high2[0]), a + 1, 0))
                if places > done:
                    some.append(place)
            if not some:
                break
            c1, c2 = first[[p[1] for p in some]], second[[p[2] for p in some]]
            at = np.minimum(np.searchsorted(self.cells, c1 * codes + c2), len(self.cells) - 1)
            mid = sums[0][c1] + sums[1][c2]
            off = norms[0] * self.radii[at, 0] + norms[1] * self.radii[at, 1]
            slack = 1e-9 * (np.abs(mid) + off) + 1e-6
            fit = np.flatnonzero((self.cells[at] == c1 * codes + c2) & (mid + off + slack >= need) & (mid - off - slack <= top))
            fit = fit[:take - len(found)]
            found += at[fit].tolist()
            if len(found) == take and fit[-1] + 1 < len(some):  # the places after the last one taken are left
                return found, places - (len(some) - int(fit[-1]) - 1), -some[fit[-1] + 1][0]
        return found, places, -heap[0][0] if heap else None

    def blocks_of(self, cells: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(cell, part) of the blocks of some cells."""
        parts = self.parts[cells]
        return np.repeat(cells, parts), np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)


def _matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column as one matrix, short ones filled with zeros."""
    lengths = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def codebook(points: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """Plain k-means from the first different points; codes beyond them repeat the first."""
    _, first = np.unique(points, axis=0, return_index=True)
    book = points[np.sort(first)[:codes]]
    book = np.concatenate([book, np.repeat(book[:1], codes - len(book), axis=0)])
    for _ in range(rounds):
        of = nearest(points, book)[0]
        n = np.bincount(of, minlength=codes)
        total = np.zeros_like(book)
        np.add.at(total, of, points)
        book = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], book)
    return book


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, distance) of the nearest code."""
    of = np.zeros(len(points), np.int64)
    step = max(1, (1 << 22) // max(1, len(book)))
    for i in range(0, len(points), step):
        of[i:i + step] = (-2.0 * (points[i:i + step] @ book.T) + (book * book).sum(axis=1)).argmin(axis=1)
    gap = points - book[of]
    return of, np.sqrt((gap * gap).sum(axis=1))


def sampled(rows: DataFrame, n: int, most: int) -> DataFrame:
    """The vectors of the ``most`` rows with the least hashes, of ``n`` different ones, in one partition."""
    key = F.xxhash64("id", "label", "vector")
    wide = most + 10 * int(most ** 0.5)
    if n > 2 * wide:  # rows far above the limit needn't meet
        rows = rows.where(key < -(1 << 63) + (1 << 64) * wide // n)
    return rows.select("id", "label", "vector").orderBy(key, "id").limit(most).select("vector")


def fitted(sample: DataFrame, width: int, half: int, codes: int) -> list[np.ndarray]:
    """The codebooks of both halves.  One task fits them, so the driver gets the books and no rows."""
    def fit(batches):
        points = np.concatenate([_matrix(b.column("vector"), width).astype(np.float64) for b in batches])
        books = [codebook(points[:, :half], codes), codebook(points[:, half:], codes)]
        yield pa.record_batch([pa.array([b.tobytes() for b in books], pa.binary())], ["book"])

    return [np.frombuffer(r["book"], "<f8").reshape(codes, -1) for r in sample.mapInArrow(fit, "book binary").collect()]


@small_batches
def indexed(rows: DataFrame, cell_rows: int = 200, most_codes: int = 1024, most_sampled: int = 1 << 16,
            block_rows: int = 2048) -> tuple[Index, DataFrame, DataFrame] | None:
    """(index, every row with its cell, blocks) of usable rows; None without rows."""
    spark = rows.sparkSession
    rows = reliable(rows.select("id", "label", F.transform("vector", lambda c: c.cast("long")).alias("vector")).distinct())
    n, width, top = rows.agg(F.count("*"), F.max(F.size("vector")),
                             F.max(F.aggregate("vector", F.lit(0).cast("long"), lambda a, c: F.greatest(a, F.abs(c))))).first()
    if not n:
        return None
    if max(1, width) * int(top) ** 2 >= FAR or top < 0:
        raise ValueError(f"scores of {width} components up to {top} may pass 2^62")
    kind = next(k for k, bits in (("<i1", 7), ("<i2", 15), ("<i4", 31), ("<i8", 63)) if top < 1 << bits)
    exact = "<f8" if max(1, width) * int(top) ** 2 < 1 << 53 else "<i8"
    half = -(-width // 2)
    codes = int(min(most_codes, max(1, round((n / cell_rows) ** 0.5))))
    books = fitted(sampled(rows, n, most_sampled), width, half, codes)
    shared = spark.sparkContext.broadcast(books)

    def placed(batches):
        for batch in batches:
            whole = _matrix(batch.column("vector"), width)
            found = [nearest(part.astype(np.float64), book) for part, book in zip((whole[:, :half], whole[:, half:]), shared.value)]
            packed = whole.astype(kind)
            yield pa.record_batch([batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in packed], pa.binary()),
                                   pa.array(found[0][0] * codes + found[1][0]), pa.array(found[0][1]), pa.array(found[1][1])],
                                  ["id", "label", "vec", "cell", "r1", "r2"])

    filed = reliable(rows.mapInArrow(placed, "id long, label long, vec binary, cell long, r1 double, r2 double"))
    dropped(rows)
    shared.destroy()
    cells = filed.groupBy("cell").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).orderBy("cell").toArrow()
    parts = -(-cells.column("n").to_numpy() // block_rows)
    index = Index(books, half, kind, exact, cells.column("cell").to_numpy(),
                  parts, np.stack([cells.column("r1").to_numpy(), cells.column("r2").to_numpy()], axis=1))
    at = spark.createDataFrame(pa.table({"cell": index.cells, "at": np.arange(len(index.cells)), "parts": parts}))
    dealt = filed.join(F.broadcast(at), "cell").withColumn("part", F.pmod(F.xxhash64("id", "label", "vec"), "parts"))
    return index, filed, reliable(dealt.groupBy("at", "part").applyInArrow(_packed, "at long, part long, ids binary, labels binary, vecs binary"))


def _packed(table: pa.Table) -> pa.Table:
    """One block: its rows by id."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    vecs = table.column("vec").to_pylist()
    return pa.table({"at": table.column("at").slice(0, 1), "part": table.column("part").slice(0, 1),
                     "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                     "labels": pa.array([table.column("label").to_numpy()[order].astype("<i8").tobytes()], pa.binary()),
                     "vecs": pa.array([b"".join(vecs[i] for i in order)], pa.binary())})


# ---- rounds of visits -------------------------------------------------------------------------

@small_batches
def best_in_windows(anchors: DataFrame, index: Index, blocks: DataFrame, same: bool, k: int, first: int = 16,
                    group_rows: int = 1024) -> DataFrame:
    """The ``k`` best rows of the same (or another) label in every window of every anchor.

    ``anchors``: anchor (id), own (a hash that tells rows of one id apart), label, vec, windows.  Gives
    (anchor, own, w, score, id).
    """
    spark = anchors.sparkSession
    shared = spark.sparkContext.broadcast(index)
    open_ = reliable(anchors.withColumn("done", F.lit(0).cast("long")))
    n_open = open_.count()
    tops = None
    take = first

    def planner(most):
        def planned(batches):
            ix = shared.value
            for batch in in_slices(batches, 16):
                yield _planned(ix, batch, most)
        return planned

    def scored(batches):
        ix = shared.value
        for batch in batches:
            asking = batch.column("asking")
            ends = asking.offsets.to_numpy()
            for i in range(len(batch)):
                block = [batch.column(c)[i].as_py() for c in ("ids", "labels", "vecs")]
                yield from _best_of_block(ix, asking.values.slice(ends[i], ends[i + 1] - ends[i]), *block, same, k)

    key = ["anchor", "own"]
    while True:
        groups = max(1, n_open // group_rows)
        tasks = max(n_open // 512, min(n_open // 16 + 1, spark.sparkContext.defaultParallelism))
        plan = reliable(open_.repartition(tasks, *key).mapInArrow(planner(take), PLAN))
        asked = plan.select("anchor", "own", "label", "vec", "ends", F.explode("visits").alias("v")) \
            .select("v.*", F.pmod(F.xxhash64(*key), F.lit(groups)).alias("group"), F.struct("anchor", "own", "label", "vec", "ends").alias("a"))
        asked = asked.repartition("at", "part").groupBy("at", "part", "group").agg(F.collect_list("a").alias("asking"))
        found = asked.join(blocks.hint("merge"), ["at", "part"]).select("asking", "ids", "labels", "vecs") \
            .mapInArrow(scored, "anchor long, own long, w int, score long, id long")
        place = F.row_number().over(W.partitionBy(*key, "w").orderBy(F.desc("score"), "id"))
        new = reliable((found if tops is None else tops.union(found)).withColumn("place", place).where(F.col("place") <= k).drop("place"))
        if tops is not None:
            dropped(tops)
        tops = new
        full = tops.groupBy(*key, "w").agg(F.count("*").alias("c"), F.min("score").alias("least")).where(F.col("c") == k) \
            .groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("full"))
        # a full window needs no place whose bound is below its least score, an unfilled one none below its start
        still = F.filter(F.transform("windows", lambda w: w.withField("least", F.coalesce(F.col("full")[w["w"]], w["least"]))),
                         lambda w: F.col("next") >= F.coalesce(w["least"], w["lo"]))
        more = reliable(plan.where("head and next is not null").join(full.hint("merge"), key, "left").select(*key, "label", "vec", still.alias("windows"), "done")
                        .where(F.size("windows") > 0))
        dropped(plan)
        dropped(open_)
        open_ = more
        n_open = open_.count()
        if not n_open:
            shared.destroy()
            return tops
        take *= 4


def _planned(index: Index, batch: pa.RecordBatch, most: int) -> pa.RecordBatch:
    """The next visits of some anchors; those of one anchor are dealt to rows of ``VISITS``, the first of which is its head."""
    windows, done = batch.column("windows").to_pylist(), batch.column("done").to_pylist()
    bounds = [[(w["lo"] if w["least"] is None else max(w["lo"], w["least"]), w["hi"], w["w"]) for w in ws] for ws in windows]
    packed = pa.array([np.array(b, "<i8").tobytes() for b in bounds], pa.binary())
    places, nexts, of, ends, ats, parts = [], [], [], [0], [], []
    for i, q in enumerate(index.vectors(batch.column("vec").to_pylist())):
        cells, place, bound = index.visits(q, windows[i], done[i], most)
        at, part = index.blocks_of(np.array(cells, np.int64))
        ats.append(at)
        parts.append(part)
        places.append(place)
        nexts.append(bound)
        for start in range(0, max(1, len(at)), VISITS):
            of.append(i)
            ends.append(ends[-1] + min(VISITS, len(at) - start))
    of, take = np.array(of), pa.array(of)
    visits = pa.StructArray.from_arrays([pa.array(np.concatenate(ats)), pa.array(np.concatenate(parts))], ["at", "part"])
    rows = batch.select(["anchor", "own", "label", "vec", "windows"]).take(take)
    return pa.record_batch([*rows.columns, pa.array(places, pa.int64()).take(take), packed.take(take), pa.array(nexts, pa.float64()).take(take),
                            pa.array(np.diff(of, prepend=-1) > 0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), visits)],
                           [*rows.schema.names, "done", "ends", "next", "head", "visits"])


def _ends(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, name) of the windows, anchors x most windows; low is above high where an anchor has fewer."""
    n = np.array([len(x) // 24 for x in packed])
    row = np.repeat(np.arange(len(n)), n)
    ends = np.full((len(n), n.max(initial=0), 3), (1, 0, 0), np.int64)
    ends[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = np.frombuffer(b"".join(packed), "<i8").reshape(-1, 3)
    return ends[..., 0], ends[..., 1], ends[..., 2]


def _best_of_block(index: Index, asking: pa.StructArray, ids: bytes, labels: bytes, vecs: bytes, same: bool, k: int):
    ids, labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
    vecs = np.frombuffer(vecs, index.kind).reshape(len(ids), -1).astype(index.exact).T
    anchors, owns, of = (asking.field(c).to_numpy() for c in ("anchor", "own", "label"))
    asked = index.vectors(asking.field("vec").to_pylist())
    lows, highs, names = _ends(asking.field("ends").to_pylist())
    step = max(1, (1 << 20) // len(ids))
    for i in range(0, len(asked), step):
        score = asked[i:i + step] @ vecs
        reached = np.flatnonzero(score.max(axis=1) >= np.where(lows <= highs, lows, FAR)[i:i + step].min(axis=1))
        if not len(reached):
            continue
        score, at = score[reached], reached + i
        fit = ((labels == of[at, None]) == same) & (ids != anchors[at, None])
        best = []
        for m in range(lows.shape[1]):
            hit = fit & (score >= lows[at, m, None]) & (score <= highs[at, m, None])
            many = np.flatnonzero(hit.sum(axis=1) > k)
            if len(many):  # nothing below the k-th counts
                least = np.partition(np.where(hit[many], score[many], -FAR), len(ids) - k, axis=1)[:, len(ids) - k, None]
                hit[many] &= score[many] >= least
            r, c = np.nonzero(hit)
            order = np.lexsort((c, -score[r, c], r))  # rows lie by id, so ties do too
            r, c = r[order], c[order]
            kept = np.arange(len(r)) - np.searchsorted(r, r) < k
            best.append((r[kept], c[kept], np.full(kept.sum(), m)))
        r, c, m = (np.concatenate(x) for x in zip(*best))
        if len(r):
            yield pa.record_batch([pa.array(anchors[at[r]]), pa.array(owns[at[r]]), pa.array(names[at[r], m].astype(np.int32)),
                                   pa.array(score[r, c].astype(np.int64)), pa.array(ids[c])], ["anchor", "own", "w", "score", "id"])


def mined(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low_pct: int = 80, high_pct: int = 100,
          **sizes) -> DataFrame:
    """Hard negatives of usable rows (id, label, vector of whole numbers): anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    An anchor's positives are its best rows of the same label; each one's negatives the best rows of other labels
    with ``low_pct * positive_score <= 100 * negative_score <= high_pct * positive_score``.  ``is_anchor`` reads id.
    """
    spark = rows.sparkSession
    made = indexed(rows, **sizes)
    if made is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    index, filed, blocks = made
    key = ["anchor", "own"]
    anchors = reliable(filed.where(is_anchor).select(F.col("id").alias("anchor"), F.xxhash64("label", "vec").alias("own"), "label", "vec"))
    whole = F.array(F.struct(F.lit(0).alias("w"), F.lit(-FAR).alias("lo"), F.lit(FAR).alias("hi"), F.lit(None).cast("long").alias("least")))
    ends = anchors.withColumn("windows", whole)
    positives = best_in_windows(ends, index, blocks, True, n_positives).select(*key, F.col("id").alias("positive_id"),
                                                                              F.col("score").alias("positive_score"))
    # equal scores of an anchor's positives share a window; whole numbers, so its ends are rounded inwards
    hundreds, rest = "((positive_score - pmod(positive_score, 100)) div 100)", "pmod(positive_score, 100)"
    lo = F.expr(f"{low_pct} * {hundreds} + ({low_pct} * {rest} + 99) div 100")
    hi = F.expr(f"{high_pct} * {hundreds} + ({high_pct} * {rest}) div 100")
    named = reliable(positives.withColumn("w", F.dense_rank().over(W.partitionBy(*key).orderBy(F.desc("positive_score"))).cast("int"))
                     .withColumns({"lo": lo, "hi": hi}).where("lo <= hi"))
    windows = named.select(*key, F.struct("w", "lo", "hi", F.lit(None).cast("long").alias("least")).alias("x")).distinct() \
        .groupBy(*key).agg(F.sort_array(F.collect_list("x")).alias("windows"))
    asking = anchors.join(windows.hint("merge"), key).select(*key, "label", "vec", "windows")
    negatives = best_in_windows(asking, index, blocks, False, n_negatives)
    rank = F.row_number().over(W.partitionBy(*key, "w").orderBy(F.desc("score"), "id"))
    return named.join(negatives.withColumn("rank", rank).hint("merge"), [*key, "w"]) \
        .select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))
