import random

import corpus_pipeline
from tessera.llm import line_rules, pieces, suffix_dedup
from tests.llm.test_ngram_join import brute
from tests.llm.test_suffix_dedup import by_hand

WORDS = [a + b + c for a in ("ba", "co", "du") for b in ("ra", "ne", "sti") for c in ("l", "m", "n", "p", "q", "r", "s", "t")]


def corpus():
    rng = random.Random(12)

    def text(n):
        out = []
        while n > 0:
            k = min(n, rng.randrange(8, 15))
            out.append(" ".join(rng.choice(WORDS) for _ in range(k)).capitalize() + ".")
            n -= k
        return "\n".join(out)
    passage = text(60)
    rows = [(i, text(rng.randrange(90, 160)), "en", f"s{i % 4}") for i in range(40)]
    rows += [(40 + i, rows[i][1], "en", "s0") for i in range(8)]
    rows += [(60 + i, text(80) + "\n" + passage + "\n" + text(80), "en", "s1") for i in range(6)]
    rows += [(70, None, "en", "s1"), (71, "", None, None), (None, text(100), "en", None), (72, "Home\nNews\n" * 60, "en", "s2"),
             (73, "ju### nk%%% " * 100, "en", "s2"), (74, text(120) + "\nAll rights reserved.", "en", "s3")]
    return [(i, t, lang, s, len(t) if t else 0) for i, t, lang, s in rows]


def written(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_stages_against_brute_force(spark, tmp_path):
    rows = corpus()
    sf = written(spark, tmp_path, rows)
    docs = spark.read.parquet(sf + "/documents.parquet")
    at = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
        at[k] = docs.collect()

    judged = {i: line_rules.judge(t, line_rules.LineRules(), cleaned=True) for i, t, *_ in rows}
    clean = {i: j[-1] for i, j in judged.items() if j[8]}
    assert {r.doc_id: r.text for r in at[0]} == clean and all(r.n_chars == len(r.text) for r in at[0])
    assert 72 not in clean and 73 not in clean and "rights" not in clean[74]

    groups = brute([(i, t) for i, t in clean.items()], 5, 80, 100)
    assert sorted(r.doc_id for r in at[1] if r.doc_id is not None) == sorted(d for d, n, c in groups if d == c and d is not None)
    assert not any(40 <= (r.doc_id or 0) < 48 for r in at[1])

    left = {r.doc_id: r.text for r in at[1]}
    gone = {d: g for d, _, g, _, _ in by_hand(list(left.items()), suffix_dedup.LENGTH)}
    assert {r.doc_id: len(left[r.doc_id].encode()) - len(r.text.encode()) for r in at[2]} == \
        {d: g for d, g in gone.items() if g < len(left[d].encode())}
    assert sum(g > 0 for g in gone.values()) >= 5

    words = {}
    for r in at[3]:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    size = {r.doc_id: len(r.text.split()) for r in at[2]}
    assert set(words) <= set(size) and all(words[d] <= 3 * size[d] for d in words)
    assert abs(sum(words.values()) - sum(size.values())) <= 0.05 * sum(size.values())

    model = pieces.Pieces.load()
    assert sorted(tuple(r.ids) for r in at[4]) == sorted(tuple(model.encode(r.text).tolist()) for r in at[3])
    assert all(r.round_trip for r in at[4])


def test_run_on_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [])).count() == 0


def test_registered():
    import __spark_entry__ as entry
    qs = entry.queries()
    assert "pipeline" in qs and all(any(q.startswith(f"op{n}_") for q in qs) for n in range(1, 11))
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_strings", "mixture",
                                                              "encoding"]
