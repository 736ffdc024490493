import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing
from tessera.llm.common import scatter_points, scattered


def corpus():
    rng = random.Random(8)
    rows = [(None, "no id here", "b"), (1, None, "b"), (2, "", "c"), (3, " \n ", None), (4, "w " * 30000, "a")]
    for k in range(5, 205):
        rows.append((k, "\n".join("x%d y" % i for i in range(rng.randrange(60))), rng.choice(["a", "a", "b", "c", "é", None])))
    return rows + [(300, "tie one", "c"), (300, "tie one", "c")]


def fair_targets(sizes):
    """Shares by weight; whoever is above three times its size is held there, again and again."""
    names = sorted([s for s in sizes if s is not None], key=str.encode) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in held)
        open_weight = sum(weight[s] for s in names if s not in held)
        t = {s: 3 * sizes[s] if s in held else rest * weight[s] / open_weight for s in names}
        above = {s for s in names if s not in held and t[s] > 3 * sizes[s]}
        if not above:
            return t
        held |= above


def sizes_of(rows):
    out = defaultdict(int)
    for _, text, source in rows:
        out[source] += len(re.findall("[^\x20\x09-\x0D]+", text or ""))
    return dict(out)


def mixed(docs, **kw):
    laid, of, drawn = mixing.mixture(docs, ["doc_id"], **kw)
    return laid, of, drawn, mixing.taken_words(laid, of, drawn, kw.get("block_words", 64))


def test_targets_and_words_taken(table):
    rows = corpus()
    laid, of, drawn, got = mixed(table(rows), block_words=16)
    got = got.collect()
    assert len(got) == len(rows)
    sizes, want = sizes_of(rows), fair_targets(sizes_of(rows))
    name = {("1" if s is None else "0" + s): s for s in sizes}
    taken = defaultdict(int)
    for r in got:
        s = name[r.skey]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(48, 0.03 * want[s])
    again = mixed(table(rows, 5), block_words=16)[3].collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_draws_fill_every_slot_once_and_repeat_no_block_in_an_epoch(table):
    laid, of, drawn, _ = mixed(table(corpus()), block_words=16, shard_slots=64)
    d = drawn.collect()
    total = sum(r.n_draws for r in of.collect())
    assert sorted(r.shard * 64 + r.slot for r in d) == list(range(total))
    assert len({(r.skey, r.epoch, r.block) for r in d}) == len(d)
    assert max(r.epoch for r in d) <= 2
    per_shard = defaultdict(lambda: defaultdict(int))
    for r in d:
        per_shard[r.shard][r.skey] += 1
    share = {r.skey: r.n_draws / total for r in of.collect()}
    for shard, n in list(per_shard.items())[:-1]:
        for s, p in share.items():
            assert abs(n[s] - 64 * p) <= 5 * (64 * p * (1 - p)) ** 0.5 + 1


def test_mixed_texts_hold_the_words_taken(table):
    rows = corpus()
    docs = table(rows)
    out = mixing.mixed_texts(docs, ["doc_id"], block_words=16)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert set(r.text.split()) <= set(next(t for i, t, _ in rows if i == r.doc_id).split())
    want = defaultdict(int)
    for r in mixed(docs, block_words=16)[3].collect():
        want[r.doc_id] += r.taken
    assert {k: v for k, v in want.items() if v} == dict(words)


def test_scattered_is_a_permutation(spark):
    for n in (1, 2, 7, 100):
        got = [r.p for r in spark.range(n).select(scattered(F.col("id"), F.lit(n), F.lit("k")).alias("p")).collect()]
        assert sorted(got) == list(range(n))
    assert got != list(range(100))


def test_points_worked_out_before_give_the_same_permutation(spark):
    ids = spark.range(100).withColumn("p", scatter_points(F.lit(100), F.lit("k")))
    got = ids.select(scattered(F.col("id"), F.lit(100), F.lit("k")), scattered(F.col("id"), F.lit(100), F.lit("k"), points=F.col("p")))
    assert all(a == b for a, b in got.collect())


def test_blocks_hold_words_with_the_space_that_follows_them(table):
    rows = [(1, "\t a  b\nc d\u00a0e f ", "s"), (2, "x x x x x x x\r\n", "s"), (3, "one", "s"), (4, None, "s"), (5, " \x0b\f ", "s"),
            (6, "\u2003w " * 40, "t"), (7, "\x0bz" * 9, None)]
    for n in (1, 4, 64):
        laid = mixing.laid_out(table(rows), ["doc_id"])
        got = mixing.block_texts(laid, n).collect()
        text = {(r.skey, r.first_word): r.text for r in laid.where("size > 0").collect()}
        seen = defaultdict(list)
        for r in got:
            assert [p.first_word for p in r.parts] == sorted(p.first_word for p in r.parts)
            for p in r.parts:
                assert r.block == (p.first_word + p.from_word) // n == (p.first_word + p.from_word + p.words - 1) // n
                words = re.findall("[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text[r.skey, p.first_word])
                assert p.text == "".join(words[p.from_word:p.from_word + p.words])
                seen[r.skey, p.first_word].append((p.from_word, p.words))
        for k, t in text.items():
            size = len(re.findall("[^\x20\x09-\x0D]+", t))
            assert [x for a, w in sorted(seen[k]) for x in range(a, a + w)] == list(range(size))


def test_words_are_counted_once_and_buckets_start_where_others_end(table, monkeypatch):
    """The table of all rows is written before the buckets' sums are made, so texts are read once, shared or not."""
    rows, seen = corpus(), []
    monkeypatch.setattr(mixing, "n_buckets", lambda df: 7)
    monkeypatch.setattr(mixing, "saved", lambda df, name, real=mixing.saved: (
        seen.append(df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")), real(df, name))[1])
    for most in (10**6, 0):
        laid = mixing.laid_out(table(rows), ["doc_id"], most_shared=most)
        plan = laid._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp" not in plan and ("strategy=broadcast" in plan) == (most > 0)
        spans = defaultdict(list)
        for r in laid.where("size > 0").collect():
            spans[r.skey].append((r.first_word, r["size"]))
        for own in spans.values():
            at = 0
            for first, size in sorted(own):
                assert first == at
                at += size
    assert seen == [1, 0, 1, 0]


def test_empty_table(table):
    assert mixed(table([]))[3].count() == 0 and mixing.mixed_texts(table([]), ["doc_id"]).count() == 0


def test_no_python_in_the_plan(table):
    plan = mixed(table(corpus()))[3]._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_the_mix_holds_every_slot_with_the_words_of_its_block(table):
    rows = corpus()
    laid, of, mix = mixing.mixed_blocks(table(rows), ["doc_id"], block_words=16, shard_slots=64)
    got, drawn = mix.collect(), mixing.draws(of, 64).collect()
    assert sorted((r.shard, r.slot, r.skey, r.block, r.epoch) for r in got) \
        == sorted((r.shard, r.slot, r.skey, r.block, r.epoch) for r in drawn)
    in_shard, streams = defaultdict(int), defaultdict(list)
    for r in drawn:
        in_shard[r.shard, r.skey] += 1
    for r in sorted(laid.collect(), key=lambda r: (r.skey, r.first_word)):
        streams[r.skey] += (r.text or "").split()
    for r in got:
        assert r.source_draws == in_shard[r.shard, r.skey]
        assert r.words.split() == streams[r.skey][r.block * 16: r.block * 16 + 16]


def test_places_and_documents_are_read_off_the_mix(table):
    import zlib
    rows = corpus()
    docs = table(rows)
    laid, of, mix = mixing.mixed_blocks(docs, ["doc_id"], block_words=16, shard_slots=64)
    slots = {(r.shard, r.slot): r for r in mix.collect()}
    got = mixing.placed_words(laid, of, mix)
    held = defaultdict(int)
    for r in got.collect():
        assert r.taken == sum(p.words for p in r.places)
        for p in r.places:
            held[p.shard, p.slot] += p.words
            assert p.words_crc32 == zlib.crc32(slots[p.shard, p.slot].words.encode())
    assert held == {k: len(r.words.split()) for k, r in slots.items()}
    assert got.count() == len(rows)
    first = {}
    where = {(r.skey, r.first_word): r.doc_id for r in laid.where("size > 0").collect()}
    for r in slots.values():
        for p in r.parts:
            k = (where[r.skey, p.first_word], r.epoch)
            first[k] = min(first.get(k, (r.shard, r.slot)), (r.shard, r.slot))
    out = [r.doc_id for r in mixing.mixed_texts(docs, ["doc_id"], block_words=16, shard_slots=64).collect()]
    want = [k[0] for k in sorted(first, key=first.get)]
    at = {k: i for i, k in enumerate(dict.fromkeys(want))}
    seen = [at[d] for d in dict.fromkeys(out)]
    by_slot = defaultdict(set)
    for d in at:
        by_slot[min(v for k, v in first.items() if k[0] == d)].add(d)
    assert [min(v for k, v in first.items() if k[0] == d) for d in dict.fromkeys(out)] == sorted(
        s for s, ds in by_slot.items() for _ in ds)
    assert len(seen) == len(at)
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().executedPlan().toString())


def test_source_counts_of_shards_are_multinomial_draws(spark):
    """Counts spread like free draws, targets are met all the same, and each source's indices come once."""
    of = spark.createDataFrame([("0a", 700, 7000), ("0b", 1000, 2500), ("0c", 170, 500), ("0d", 1, 3), ("0e", 9, 0)],
                               "skey string, n_blocks long, n_draws long")
    free = mixing.shard_draws(of, 50).collect()
    assert sorted(r.shard * 50 + i for r in free for i in r.slots) == list(range(10003))
    share, n = {"0a": .7, "0b": .25, "0c": .05}, 200
    counts = {(r.shard, r.skey): len(r.slots) for r in free}
    for s, p in share.items():
        c = [counts.get((i, s), 0) for i in range(n)]
        mean = sum(c) / n
        variance = sum((x - mean) ** 2 for x in c) / (n - 1)
        assert abs(mean - 50 * p) < 5 * (50 * p * (1 - p) / n) ** 0.5
        assert 0.6 < variance / (50 * p * (1 - p)) < 1.5
    d = mixing.draws(of, 50).collect()
    assert sorted(r.shard * 50 + r.slot for r in d) == list(range(10003))
    uses = defaultdict(lambda: defaultdict(int))
    for r in d:
        uses[r.skey][r.epoch, r.block] += 1
        assert 0 <= r.block < {"0a": 700, "0b": 1000, "0c": 170, "0d": 1}[r.skey]
    assert {s: sum(u.values()) for s, u in uses.items()} == {"0a": 7000, "0b": 2500, "0c": 500, "0d": 3}
    assert all(set(u.values()) == {1} for u in uses.values())
    of_slot = {(r.shard, r.slot): r.skey for r in d}
    moved = sum(of_slot[r.shard, i] != r.skey for r in free for i in r.slots)
    assert moved <= 5 * (10003 * 0.25) ** 0.5 and len({r.shard for r in free for i in r.slots if of_slot[r.shard, i] != r.skey}) >= min(moved, 20) // 2
    assert d != mixing.draws(of, 50, seed=1).collect()
    assert sorted(map(tuple, d)) == sorted(map(tuple, mixing.draws(of.repartition(7), 50).collect()))


def test_reruns_agree_on_rows_of_one_id(spark, table):
    rows = [(7, "first of many words here", "a"), (7, "second text", "a"), (7, None, "b"), (8, "x " * 500, "b"), (7, "", "a")]
    def run(parts, seed):
        order = rows[:]
        random.Random(seed).shuffle(order)
        d = table(order, parts).withColumn("sig", F.xxhash64("text"))
        laid, of, mix = mixing.mixed_blocks(d, ["doc_id", "sig"], block_words=4, shard_slots=16)
        return sorted(map(str, mixing.placed_words(laid, of, mix).select("doc_id", "size", "taken", "places").collect()))
    assert run(1, 0) == run(4, 1) == run(7, 2)
