import hashlib
import random

import pytest

from tessera.llm import suffix_dedup as sd


def by_hand(rows, length):
    """Windows in order of place; a window seen before removes its bytes."""
    order = sorted(range(len(rows)), key=lambda i: -1 if rows[i][0] is None else rows[i][0])
    seen, out = set(), []
    for i in order:
        b = (rows[i][1] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((rows[i][0], len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "de", "épsilon", "zz", "theta", "io"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))
    p = [text(40), text(25), text(60)]
    rows = [(None, p[0]), (0, None), (1, ""), (2, text(80)), (3, "a" * 500), (4, text(10) + p[0] + text(10)),
            (5, text(12) + p[0] + text(3) + p[1] + p[2]), (6, p[2] + p[2]), (7, text(5) + p[1] + "x" + p[1] + text(9)),
            (8, "short"), (9, "short")]
    for k in range(10, 30):
        rows.append((k, text(rng.randint(0, 30)) + rng.choice(p)[rng.randint(0, 60):] + text(rng.randint(0, 30))))
    base = text(150).split()
    for k in range(30, 45):
        b = list(base)
        for _ in range(rng.randint(0, 4)):
            b[rng.randrange(len(b))] = rng.choice(words) + "q"
        rows.append((k, " ".join(b)))
    return rows + [(50, rows[3][1]), (50, rows[3][1]), (49, "b" * 130 + "a" * 200)]


@pytest.mark.parametrize("seed,most", [(3, 100_000), (4, 2)])
def test_bytes_removed_are_those_of_the_definition(table, monkeypatch, seed, most):
    """Both ways to judge an anchor: sorted suffixes, and grouped windows for crowded anchors."""
    runs = sd.repeated_runs
    monkeypatch.setattr(sd, "repeated_runs", lambda d, length, seed: runs(d, length, seed, most))
    rows = corpus(seed)
    got = sorted([tuple(r) for r in sd.removal(table(rows)).collect()], key=str)
    assert got == by_hand(rows, 100)


def test_pieces_of_long_texts(table, monkeypatch):
    """Anchors do not depend on where a long text is cut."""
    import numpy as np
    import pyarrow as pa
    rng = random.Random(1)
    column = pa.array(["".join(rng.choice("abcd ") for _ in range(5000)), "x" * 300, None])

    def starts():
        out = set()
        for text, lo, count, off, h, _ in sd.anchors(column):
            for t, a, n, o, x in zip(*(np.asarray(v).tolist() for v in (text, lo, count, off, h))):
                out |= {(t, a + k, a + o, x) for k in range(n)}
        return out
    whole = starts()
    monkeypatch.setattr(sd, "PIECE", 512)
    sd._TABLES.clear()
    assert starts() == whole and len(whole) == 4901 + 201
    sd._TABLES.clear()


def test_deep_shallow_order_is_the_order_of_strings():
    rng = random.Random(2)
    for alphabet, most in ((b"ab", 70), (b"abcdefg\0", 30)):
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(most))) for _ in range(900)]
        strings += [b"a" * 20 + s for s in strings[:400]] + [b"a" * k for k in range(40)]
        order = sd.deep_shallow_order(strings)
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)
    assert sd.deep_shallow_order([]) == []


def test_common_prefix():
    assert sd.common_prefix(b"", b"a") == 0 and sd.common_prefix(b"abc", b"abc") == 3
    assert sd.common_prefix(b"abcd", b"abd") == 2 and sd.common_prefix(b"\0a", b"\0b") == 1


def test_texts_left(table):
    rows = corpus(5)
    docs = table(rows)
    left = sd.deduplicated(docs)
    assert left.columns == docs.columns
    want = {(d, s): h for (d, n, gone, s, h) in by_hand(rows, 100) if n > gone}
    got = left.collect()
    assert sum(r.text is not None and r.text != "" for r in got) == sum(
        1 for d, n, gone, s, h in by_hand(rows, 100) if n > gone)
    assert {r.doc_id for r in got if r.text} == {d for d, _ in want}
    assert sd.removal(table([])).count() == 0 and sd.deduplicated(table([])).count() == 0
