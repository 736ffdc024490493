import random

import pytest

from tessera.llm import ngram_join


def sets_of(text, k):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def brute(rows, k, num, den):
    sets = [sets_of(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and sets[j] and rows[j][0] is not None]
        out.append((d, len(sets[i]), (min(own) if own else None) if sets[i] else d))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    words = ["red", "Green", "blue", "été", "x1", "stone", "river", "cloud", "of", "the"]
    base = [[rng.choice(words) + str(rng.randrange(40)) for _ in range(rng.randrange(20, 90))] for _ in range(6)]
    rows = [(None, "a null id"), (1, None), (2, ""), (3, " \n\t"), (4, "two words"), (5, "TWO words"), (6, "two words"),
            (7, "one"), (8, "a null id"), (8, "a null id")]
    for i in range(10, 70):
        b = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            b[rng.randrange(len(b))] = rng.choice(words)
        if rng.random() < .3:
            b += [rng.choice(words) for _ in range(rng.randrange(1, 6))]
        rows.append((i, " ".join(b)))
    rows.append((90, " ".join(base[0] * 50)))
    return rows


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
def test_groups_are_those_of_all_pairs(table, k, num, den):
    rows = corpus()
    got = ngram_join.similar(table(rows), words=k, num=num, den=den, counters=1 << 10)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], key=str) == brute(rows, k, num, den)


def test_one_of_each_keeps_one_per_group_and_columns(table):
    rows = corpus()
    docs = table(rows)
    left = ngram_join.one_of_each(docs, words=5, num=80, den=100)
    assert left.columns == docs.columns
    want = brute(rows, 5, 80, 100)
    names = {c for d, n, c in want if n and d is not None and d == c}
    got = [r.doc_id for r in left.collect() if r.doc_id is not None and sets_of(r.text, 5)]
    assert sorted(got) == sorted(names)


def test_empty_table(table):
    assert ngram_join.similar(table([])).count() == 0


def test_a_chain_is_one_component(table):
    """Neighbours are linked, ends are not: the component needs links beyond the leaders'."""
    words = [f"w{i}" for i in range(240)]
    rows = [(i, " ".join(words[i * 4: i * 4 + 160])) for i in range(20)]
    got = {r.component_id for r in ngram_join.similar(table(rows), counters=1 << 8).collect()}
    assert got == {c for _, _, c in brute(rows, 3, 90, 100)} == {0}


def test_one_id_with_unrelated_texts_keeps_one_per_group(table):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, b), (1, a), (1, a), (1, a + " more"), (2, b), (3, a + " more"), (None, a), (4, "")]
    left = ngram_join.one_of_each(table(rows)).collect()
    assert sorted([(r.doc_id, r.text) for r in left], key=str) == sorted([(1, a), (1, b), (None, a), (4, "")], key=str)
