from dataclasses import replace

import duckdb
import pytest

from tessera.llm import line_rules as lr
from tessera.llm import oracle

GOOD = "This sentence of ten words ends as sentences should end.\n"
LONG = "".join(f"Line{i} of{i} the{i} text{i} has{i} its{i} words a{i} b{i}.\n" for i in range(12))


def test_lines():
    r = lr.LineRules()

    def fails(line):
        return lr.line_fails(line.encode(), line.encode().split(), r)
    assert fails("Home") and fails("Read more.") and fails("A | B | C | D and more words here.")
    assert fails("wo### rds&&& of%%% ju$$$ nk.") and fails("All rights reserved.")
    assert not fails("Les.") and not fails("Una línea de texto sin punto pero bastante larga")
    assert not fails("A long sentence may mention cookies, since it uses cookies as a word among many other words that "
                     "stand around it here.")


def test_verdicts():
    assert lr.judge(None, lr.LineRules())[:6] == (0, 0, 0, 0, 0, True)
    kept = lr.judge(LONG, lr.LineRules(), cleaned=True)
    assert kept[8] and kept[9] == LONG
    mostly_menu = LONG + "Home | News | About | Contact\n" * 1 + "x y\n" * 80
    assert not lr.judge(mostly_menu, lr.LineRules())[8]
    noisy = lr.judge(LONG + "Home\n" + GOOD + GOOD, lr.LineRules(), cleaned=True)
    assert noisy[8] and noisy[3] == 1 and noisy[9] == LONG + GOOD


@pytest.mark.parametrize("text,n", [("a b c", 0), ("a b c a b c", 6), ("a a a a", 4), ("", 0), ("a b c d a b c", 6)])
def test_repeated_words(text, n):
    assert lr.repeated_words(text.encode().split()) == n


def test_rows_match_the_sql(table):
    rows = [(None, LONG), (1, None), (2, ""), (3, GOOD * 20), (4, LONG + "Home\nNews\n"), (5, LONG * 3), (6, "x" * 100000),
            (7, LONG + "tie"), (7, LONG + "tie"), (8, "    \x1c x\x0by " + LONG), (9, "é| > » / ::\n" + LONG)]
    docs = table(rows)
    got = lr.with_line_rules(docs.select("doc_id", "text"), "q").select("doc_id", "q.*")
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    rel = con.sql(oracle.OP8)
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]

    def key(r):
        return str([r["doc_id"] if r["doc_id"] == r["doc_id"] else None, r["n_words"], r["word_chars"]])
    a, b = sorted((r.asDict() for r in got.collect()), key=key), sorted(want, key=lambda r: key(
        {**r, "doc_id": None if r["doc_id"] is None or r["doc_id"] != r["doc_id"] else int(r["doc_id"])}))
    assert [{k: v for k, v in r.items() if k != "doc_id"} for r in a] == \
        [{k: v for k, v in r.items() if k != "doc_id"} for r in b]


def test_stage_keeps_columns_and_clean_lines(table):
    docs = table([(1, LONG + "Home\n"), (2, "junk"), (3, None)])
    left = lr.keep_clean(docs)
    assert left.columns == docs.columns and [(r.doc_id, r.text) for r in left.collect()] == [(1, LONG)]
    assert lr.keep_clean(table([])).count() == 0
    loose = replace(lr.LineRules(), min_words=1)
    assert lr.keep_clean(table([(1, GOOD)]), rules=loose).count() == 1
