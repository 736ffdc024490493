import random
import re
from collections import Counter

import pytest

from tessera.llm import licences as lc

WORDS = [a + b for a in ("ba", "co", "du", "fe", "li", "mo") for b in ("ra", "ne", "sti", "tor", "nd", "x")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def scanner(spark):
    from tessera.llm.common import ship_package
    ship_package(spark)
    rng = random.Random(6)
    rows = [(i, "\n".join(sentence(rng, rng.randrange(1, 40)) for _ in range(6))) for i in range(150)]
    return lc.trained(spark.createDataFrame(rows, "doc_id long, text string"), variants=15, most_plain=500)


def scan(scanner, paragraphs):
    import pyarrow as pa
    counts, found = scanner.scan(pa.array(["\n".join(paragraphs)]))
    return int(counts[0]), [(p, f, s >= scanner.confirm) for _, p, f, _, s in found]


def test_held_out_accuracy(scanner):
    """Notices with other words around them than in training."""
    rng = random.Random(60)
    right = total = 0
    for family in lc.FAMILIES:
        for t in lc.TEMPLATES[family]:
            for _ in range(4):
                p = f"{sentence(rng, rng.randrange(1, 6))} {t} {sentence(rng, rng.randrange(1, 6))}"
                got = scan(scanner, [p])[1]
                right += got == [(p, family, True)]
                total += 1
    assert right >= 0.9 * total
    plain = [sentence(rng, rng.randrange(1, 40)) for _ in range(300)]
    n, found = scan(scanner, plain)
    assert n == 300 and len(found) <= 3 and not any(sure for _, _, sure in found)


LONG = [("bsd", "Redistribution and use"), ("mit", "Permission is hereby"), ("gpl", "This program is free"), ("isc", "Permission to use"),
        ("cc-by-sa", "This work is licensed"), ("mpl", "This Source Code")]


@pytest.mark.parametrize("family,begin", LONG)
def test_notices_wrapped_over_lines_or_within_a_long_one(scanner, family, begin):
    import textwrap
    rng = random.Random(8)
    notice = next(t for t in lc.TEMPLATES[family] if t.startswith(begin))
    around = [sentence(rng, 30) for _ in range(4)]
    wrapped = textwrap.wrap(notice, 40)
    assert len(wrapped) > 1
    n, found = scan(scanner, [*around[:2], *wrapped, *around[2:]])
    assert n == 4 + len(wrapped) and [(f, sure) for _, f, sure in found if sure] == [(family, True)]
    assert "".join(found[0][0].split()).startswith("".join(notice.split())[:20]) and len(found) == 1
    assert [f for _, f, sure in scan(scanner, [" ".join([sentence(rng, 60), notice, sentence(rng, 60)])])[1] if sure] == [family]
    twice = scan(scanner, [*wrapped, "", *wrapped])[1]
    assert [f for _, f, sure in twice if sure] == [family] * 2
    half = len(wrapped) // 2
    assert not any(sure for _, _, sure in scan(scanner, [*wrapped[:half], "", sentence(rng, 30), "", *wrapped[half:]])[1])


def test_stretches_by_hand():
    t = lc.TEMPLATES["isc"][0]
    assert lc.stretches("xx " + t + " yy", 0.8) == [(3, 3 + len(t), "isc", 1.0)]
    assert lc.stretches(t.replace(" ", "\n\n"), 0.8) == [] and lc.stretches("", 0.8) == []
    assert [(f, s) for _, _, f, s in lc.stretches("é " + lc.TEMPLATES["cc-by"][0] + " " + lc.TEMPLATES["cc-by-nc"][0], 0.8)] == \
        [("cc-by", 1.0), ("cc-by-nc", 1.0)]


def test_unknown_notices_are_not_confirmed(scanner):
    for p in ("Licensed under the Bara Fetor License.", "This work is licensed under the Colix Public Terms, version 9."):
        assert not any(sure for _, _, sure in scan(scanner, [p])[1])


def test_rows(scanner, table):
    rows = [(None, "All rights reserved."), (1, None), (2, ""), (3, "\n \n"), (4, "bara " * 60000), (5, "Released under the MIT License."),
            (5, "Released under the MIT License."), (6, "bara cone\nLicensed under CC BY-NC 4.0.\ndusti")]
    got = lc.scanned(table(rows), scanner).collect()
    want = {(None, 1, "proprietary"), (1, 0, None), (2, 0, None), (3, 0, None), (4, 1, None), (5, 1, "mit"), (6, 3, "cc-by-nc")}
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_paragraphs, r.notices[0].family if r.notices else None) for r in got} == want
    assert all(x.confirmed for r in got for x in r.notices)
    assert lc.scanned(table([]), scanner).count() == 0


def test_training_sample_is_bounded_and_repeatable(table):
    docs = table([(i, f"plain text {i}\nlicence text {i}") for i in range(30)])
    a = lc.plain_paragraphs(docs, "text", 10)
    assert len(a) == 10 and a == lc.plain_paragraphs(docs.repartition(2), "text", 10)
    assert not any("licence" in p for p in a)
    assert lc.training_rows(a, 5, 1) == lc.training_rows(a, 5, 1)


def test_the_model_is_not_made_smaller():
    import inspect
    given = inspect.signature(lc.trained).parameters
    assert (given["variants"].default, given["most_plain"].default) == (40, 3000)
    line = " ".join(f"w{i}" for i in range(400))
    assert len(lc.counts_of([line])[0]) >= 0.98 * 799  # words and pairs of a long line seldom collide


def scored_by_hand(scanner, paragraph):
    """Class probabilities from the fitted weights, word by word in plain Python."""
    import math

    import numpy as np
    from tessera.llm.common import mixed
    from tessera.llm.ngram_join import word_hashes

    def number(x):
        return int(mixed(np.array([x % 2**64], np.uint64))[0])
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", paragraph) if w]
    h = [int(word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[0][0]) for w in words]
    a, b = number(11) | 1, number(13) | 1
    count = Counter(x % lc.FEATURES for x in h + [number(x * a + y * b) for x, y in zip(h, h[1:])])
    size = math.sqrt(sum(k * k for k in count.values()))
    margin = [sum(k * float(scanner.weights[f, c]) for f, k in count.items()) / size + float(scanner.intercepts[c])
              for c in range(len(lc.CLASSES))]
    z = [math.exp((m - max(margin)) / scanner.temperature) for m in margin]
    return {c: x / sum(z) for c, x in zip(lc.CLASSES, z)}


def pairs_by_hand(text):
    words = [w for w in (x.strip(".,;:()\"'") for x in text.lower().split()) if w]
    return {(a, b) for a, b in zip(words, words[1:])} or {("", w) for w in words}


def test_scores_and_decisions_by_hand(scanner):
    """Every line of mixed texts: class, probability and template similarity of the scan against plain loops."""
    import pyarrow as pa
    rng = random.Random(77)
    lines = [sentence(rng, rng.randrange(1, 30)) for _ in range(40)]
    for family in lc.FAMILIES:
        for t in lc.TEMPLATES[family]:
            own = t.split()
            lines += [t, " ".join(w for w in own if rng.random() > 0.3) or t, sentence(rng, 3) + " " + t]
    lines += ["Licensed under the Bara Fetor License.", "É " * 500, lines[3], lines[3]]
    for line in lines:
        counts, found = scanner.scan(pa.array([line]))
        p = scored_by_hand(scanner, line)
        best = max(p, key=p.get)
        assert counts[0] == 1
        if best == "none":
            assert not found or found[0][4] >= scanner.confirm  # only a stretch that holds a template
            continue
        want = best if best == "unknown" or p[best] >= scanner.least else "unknown"
        got = [x for x in found if x[1] == line]
        if not got:  # the line gave way to a confirmed stretch of it
            assert found and all(x[4] >= scanner.confirm and x[1] in line for x in found)
            continue
        (_, _, family, prob, alike), = got
        if family != want:  # the whole line is a stretch that is confirmed
            assert alike >= scanner.confirm and want == "unknown"
            continue
        assert prob == pytest.approx(p[best], abs=1e-4)
        if family != "unknown":
            near = max(len(pairs_by_hand(t) & pairs_by_hand(line)) / len(pairs_by_hand(t)) for t in lc.TEMPLATES[family])
            assert alike == pytest.approx(near)
