import hashlib
import random

from tessera.llm import fingerprints as fp


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (0 if x == y else 2))
    return row[-1]


def test_common_length_gives_the_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(30))) for _ in "ab")
        assert edit_distance(a, b) == len(a) + len(b) - 2 * fp.common_length(a, b)


def chunks_by_hand(raw, block):
    """Chunk ends from the definition: the low bits of the rolled hash are all ones."""
    import numpy as np
    out, start = [], 0
    for i in range(len(raw)):
        window = np.frombuffer(raw[max(0, i - fp.WINDOW + 1): i + 1], np.uint8)
        if int(fp.rolled(window)[-1]) & (block - 1) == block - 1:
            out.append(raw[start:i + 1])
            start = i + 1
    return out + ([raw[start:]] if start < len(raw) else [])


def test_signs_depend_on_chunks_alone():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh éü") for _ in range(900))
    size, sig, _ = fp.fingerprint(text).split(":")
    parts = chunks_by_hand(text.encode(), int(size))
    parts = parts[:fp.LONG - 1] + ([b"".join(parts[fp.LONG - 1:])] if len(parts) >= fp.LONG else [])
    assert len(sig) == len(parts)
    seen = {}
    for p, s in zip(parts, sig):
        assert seen.setdefault(p, s) == s


def test_likeness():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghij ") for _ in range(4000))
    other = "".join(rng.choice("abcdefghij ") for _ in range(4000))
    f = fp.fingerprint(text)
    assert fp.likeness(f, f) == 1.0 and fp.likeness(fp.fingerprint(""), fp.fingerprint(None)) == 1.0
    assert fp.likeness(f, fp.fingerprint(other)) < 0.3
    assert 0.3 < fp.likeness(f, fp.fingerprint(fp.edited(text, other))) < 1
    assert fp.likeness(f, fp.fingerprint(text[:2000] + "Q" + text[2000:])) > 0.8


def test_every_text_meets_the_next_by_id(table):
    rows = [(None, "no id"), (5, "five " * 9), (1, None), (2, ""), (3, "drei é" * 50), (9, "x" * 5000), (9, "a tie"),
            (9, "a tie"), (20, "last")]
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (-1 if r[0] is None else r[0], r[1].encode()))
    want = []
    for k, (i, t) in enumerate(order):
        n = order[(k + 1) % len(order)][1]
        e = fp.edited(t, n)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.fingerprint(t), fp.fingerprint(e),
                     fp.likeness(fp.fingerprint(t), fp.fingerprint(e)), fp.likeness(fp.fingerprint(t), fp.fingerprint(n))))
    for pieces in (1, 4):
        got = fp.compared_with_next(table(rows), pieces=pieces)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert fp.compared_with_next(table([])).count() == 0


def test_column(table):
    got = fp.with_fingerprint(table([(1, None), (2, "abc")]), out="n")
    assert {(r.doc_id, r.n) for r in got.collect()} == {(1, "4::"), (2, fp.fingerprint("abc"))}
