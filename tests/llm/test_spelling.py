import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import spelling as sp


def words(rng, n):
    base = ["".join(rng.choice("abcé𝄞") for _ in range(rng.randrange(0, 9))) for _ in range(n)]
    return sorted({w for w in base} | {w[:k] + w[k + 1:] for w in base for k in range(0, len(w), 3)})


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, g = sorted((a, b), key=len)
    return len(g) == len(s) + 1 and any(g[:i] + g[i + 1:] == s for i in range(len(g)))


def wanted(n, ratio=2):
    out = {}
    for w in n:
        near = [v for v in n if v != w and one_edit(v, w)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = [form, w, n[w], len(near), n[form] if form is not None else None]
    for w, r in out.items():
        while out[r[1]][0] is not None:
            r[1] = out[r[1]][0]
    return {(w, *r) for w, r in out.items()}


@pytest.mark.parametrize("most_blocks", [1 << 22, 4])
def test_equals_all_pairs(spark, most_blocks):
    """Also where a round holds four blocks only, so that lengths are split over many rounds."""
    rng = random.Random(4)
    n = {w: rng.choice([1, 2, 3, 5, 9, 30, 100]) for w in words(rng, 150)} | {"x" * 200: 3, "x" * 201: 9, "x" * 63: 1, "x" * 64: 2, "x" * 65: 5}
    rows = [(w, k, 1) for w, k in n.items()] + [(None, 3, 1), ("abc", None, 1)]
    rows += [("abca", 0, 1), (next(iter(n)), 0, 2)]
    n.setdefault("abca", 0)
    table = spark.createDataFrame(rows, "word string, n long, n_near int").repartition(3)
    got = sp.variants(table, most_blocks=most_blocks)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == wanted(n) and got.count() == len(n)


def test_edit_hashes_are_the_hashes_of_the_edited_words():
    letters = np.array([97, 98, 0x1D11E], np.uint64)
    for word in ("", "a", "aab", "ba𝄞b"):
        (_, codes), = sp.by_length([word, word])
        for kind in ("deleted", "replaced", "inserted"):
            seen = []
            for h, r, p, c in sp.edit_hashes(codes, letters, kind):
                for x, row, place, letter in zip(h, r.tolist(), p.tolist(), c.tolist()):
                    made = sp._made(word, kind, place, letter)
                    (_, own), = sp.by_length([made])
                    assert sp.word_hashes(own)[0] == x
                    seen.append((row, made))
            assert len(seen) == len(set(seen))
            want = {w for w in all_edits(word, "ab𝄞", kind)}
            assert {m for row, m in seen if row == 1} == want


def all_edits(w, letters, kind):
    if kind == "deleted":
        return {w[:i] + w[i + 1:] for i in range(len(w))}
    if kind == "replaced":
        return {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters if c != w[i]}
    return {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}


def test_rounds_are_bounded_and_cover_all_lengths():
    rounds = sp.planned({3: 1, 5: 100_000, 64: 7}, 20, 1 << 10)
    assert len(rounds) > 20 and all(sum(s.blocks for s in r) <= 1 << 10 for r in rounds)
    parts = [s for r in rounds for s in r if s.length == 5]
    assert [s.part for s in parts] == list(range(parts[0].parts))
    assert sp.planned({}, 20, 4) == [[]]


def test_word_counts(table):
    """Counted again here, with the run's own rule for the words that lose a letter."""
    rng = random.Random(1)
    some = ["".join(rng.choice("abÉß") for _ in range(rng.randrange(1, 8))) for _ in range(120)]
    rows = [(i if i % 7 else None, " ".join(rng.choice(some) for _ in range(40)) + "-Äab1÷×aaa_") for i in range(80)]
    rows += [(1, None), (2, ""), (3, "Zuabcdef" * 20000), (4, "ABcde " * 30000), (4, "ABcde " * 30000)]
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    got = {r.word: r.n for r in sp.word_counts(table(rows), misspelt=97).collect()}
    assert got == {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}
    assert sp.word_counts(table([])).count() == 0


def test_empty_vocabulary(spark):
    assert sp.variants(spark.createDataFrame([], "word string, n long")).count() == 0
