import math
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest

from tessera.llm import tree_weighting as tw

D = 3
ROWS = [(0, "Abab abab"), (1, None), (2, ""), (3, "the cat sat on the mat"), (4, "the DOG sat on the log é"), (5, "zzz the"),
        (6, "on the mat the cat"), (7, "abra cadabra " * 300), (8, "held out text the cat"), (8, "held out text the cat"),
        (9, "a b"), (10, "the the the"), (None, "no id the")]


def lowered(text):
    return bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode())


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def decisions(text):
    b = bytes(D) + lowered(text) + b"\xff"
    for p in range(D, len(b)):
        for i in range(8):
            yield b[p - D:p], (1 << i) | (b[p] >> (8 - i)), (b[p] >> (7 - i)) & 1


def by_hand(rows):
    """Scores from the recursive definition of the weighted trees."""
    n = defaultdict(lambda: [0, 0])
    for i, t in rows:
        if not held(i):
            for c, node, x in decisions(t):
                for d in range(D + 1):
                    n[c[D - d:], node][x] += 1
    children = defaultdict(set)
    for c, node in list(n):
        if c:
            children[c[1:], node].add((c, node))

    def log_kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def below(c, node):
        return sum(log_w(*k) for k in children[c, node])

    @lru_cache(None)
    def log_w(c, node):
        own = log_kt(*n[c, node])
        if len(c) == D:
            return own
        deep = below(c, node)
        m = max(own, deep)
        return m + math.log(math.exp(own - m) + math.exp(deep - m)) - math.log(2)

    def probability(c, node, x):
        p = None
        for d in range(D, -1, -1):
            k = c[D - d:], node
            a = n.get(k, [0, 0])
            kt = (a[x] + .5) / (sum(a) + 1)
            if p is None:
                p = kt
            else:
                beta = math.exp(log_kt(*a) - below(*k)) if sum(a) else 1.0
                p = (beta * kt + p) / (beta + 1)
        return p

    train = [t for i, t in rows if not held(i)]
    words = Counter(w for t in train for w in lowered(t).split())
    total, types = sum(words.values()) + len(train), len(words) + 1
    out = {}
    for i, t in rows:
        of = lowered(t).split()
        base = sum(math.log10((words[w] + 1) / (total + types + 1)) for w in of) \
            + math.log10((len(train) + 1) / (total + types + 1))
        out[i] = (sum(math.log10(probability(*z)) for z in decisions(t)), len(of) + 1,
                  sum(w in words for w in of) + 1, base, total)
    return out


@pytest.mark.parametrize("shared,frequent", [(10**6, 10**6), (0, 2)])
def test_scores_follow_the_definition(table, shared, frequent):
    want = by_hand(ROWS)
    got = tw.score(table(ROWS), depth=D, most_shared=shared, most_frequent=frequent).collect()
    assert len(got) == len(ROWS)
    for r in got:
        score, tokens, known, base, total = want[r.doc_id]
        assert r.held_out == held(r.doc_id) and (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, total)
        assert r.score == pytest.approx(score, abs=1e-6) and r.base_score == pytest.approx(base, abs=1e-8)


def test_long_texts_are_cut_into_pieces_without_a_trace():
    import numpy as np
    import pyarrow as pa
    column = pa.array(["", None, "abc" * 40, "é" * 9, "zz"])
    whole = [(g.tolist(), t.tolist()) for g, t in tw.gram_pieces(column, 4)]
    small = [(g.tolist(), t.tolist()) for g, t in tw.gram_pieces(column, 4, most=16)]
    for k in (0, 1):
        assert sum((x[k] for x in whole), []) == sum((x[k] for x in small), [])
    assert np.bincount(sum((x[1] for x in small), [])).tolist() == [1, 1, 121, 19, 3]


def test_tasks_hold_small_pieces_and_a_small_table():
    """Memory beside the batch and the counts does not grow with a text or with the texts of a batch."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"abcdef ", np.uint8)
    for sizes in ([4 << 20], [2000] * 2000):
        column = pa.array([letters[rng.integers(0, 7, k)].tobytes().decode() for k in sizes])
        batch = pa.record_batch([column, pa.array([i % 3 > 0 for i in range(len(sizes))])], ["text", "train"])
        tracemalloc.start()
        n = sum(len(g) for g, _ in tw.gram_pieces(column, 4))
        counts = list(tw._counted(4)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n == sum(sizes) + len(sizes) and peak < 60e6
        assert len(counts) == 1 and len(set(counts[0].column(0).to_pylist())) == len(counts[0]) > 7 ** 5
        assert sum(counts[0].column(1).to_pylist()) == sum(k + 1 for i, k in enumerate(sizes) if i % 3)
    grams = np.unique(rng.integers(0, 1 << 40, 70000))
    table = tw.GramTable(grams, grams / 2)
    assert sum(x.nbytes for x in vars(table).values() if isinstance(x, np.ndarray)) <= 24 * len(grams)
    some = rng.permutation(grams)
    assert np.array_equal(table(some), some / 2)


def test_counts_are_added_up_over_pieces_and_leave_in_parts():
    import pyarrow as pa
    batch = pa.record_batch([pa.array(["abcabc", "xyz", None, "abd"] * 50), pa.array([True, False, True, True] * 50)],
                            ["text", "train"])
    want = Counter()
    for t, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        b = bytes(2) + (t or "").encode() + b"\xff"
        for p in range(2, len(b)):
            want[b[p] | b[p - 1] << 8 | b[p - 2] << 16] += own
    for most in (1, 20, 10**6):
        got = Counter()
        for part in tw._counted(2, most)(batch.slice(k, 7) for k in range(0, 200, 7)):
            for g, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                got[g] += n
        assert got == want and set(got) == set(want)
    assert list(tw._counted(2)(iter([]))) == []


def test_batches_are_small_within_and_the_session_is_left_as_it_was(spark, table):
    from tessera.llm.common import BATCH_BYTES, small_batches
    asked = small_batches(lambda df: df.sparkSession.conf.get(BATCH_BYTES, None))
    assert asked(table([])) == "8m" and spark.conf.get(BATCH_BYTES, None) is None
    spark.conf.set(BATCH_BYTES, "3m")
    assert asked(table([])) == spark.conf.get(BATCH_BYTES, None) == "3m"
    spark.conf.unset(BATCH_BYTES)


def test_empty_table(table):
    assert tw.score(table([]), depth=2).count() == 0
