import itertools
import random

import numpy as np

from tessera.llm import pieces as pc

MODEL = pc.Pieces.load()


def small():
    texts = ["<unk>", "▁", "a", "b", "ab", "▁a", "aba", "▁ab", "<0x63>", "<0xC3>", "<0xA9>", "bb"]
    scores = [0.0, -2.0, -2.5, -2.5, -3.0, -2.2, -4.0, -5.5, 0, 0, 0, -5.0]
    return pc.Pieces(texts, scores, {0x63: 8, 0xC3: 9, 0xA9: 10}, frozenset([0])), texts, scores


def best_by_all_paths(s, texts, scores, usable, unknown):
    """Largest score over all ways to cut ``s`` (short) into pieces and single unknown characters."""
    best = None
    for cuts in itertools.product([0, 1], repeat=len(s) - 1):
        parts, start = [], 0
        for k, c in enumerate([*cuts, 1], 1):
            if c:
                parts.append(s[start:k])
                start = k
        total = 0.0
        for p in parts:
            if p in usable:
                total += scores[texts.index(p)]
            elif len(p) == 1:
                total += unknown
            else:
                total = None
                break
        if total is not None and (best is None or total > best):
            best = total
    return best


def test_paths_are_the_best_of_all():
    m, texts, scores = small()
    usable = {t for i, t in enumerate(texts) if i and not m.is_byte[i]}
    rng = random.Random(4)
    for _ in range(150):
        s = "".join(rng.choice("aab ") for _ in range(rng.randrange(1, 10)))
        ids = m.encode(s).tolist()
        got = sum(scores[i] for i in ids)
        assert abs(got - best_by_all_paths("▁" + s.replace(" ", "▁"), texts, scores, usable, m.unknown)) < 1e-9
        assert m.decode(ids) == s


def test_unknown_characters_become_bytes():
    m, _, _ = small()
    assert m.encode("aéc").tolist() == [5, 9, 10, 8]
    assert m.decode([5, 9, 10, 8]) == "aéc" and m.decode([5, 9]) == "a�"


def test_trie_finds_its_keys_and_no_others():
    keys = [MODEL.out[i] for i in range(400, 3000)]
    keys = list(dict.fromkeys(keys))
    base, check, value = pc.double_array(keys)

    def find(k):
        s = 0
        for c in k:
            t = base[s] + c
            if check[t] != s:
                return -1
            s = t
        return value[s]
    assert [find(k) for k in keys] == list(range(len(keys)))
    assert find(b"\xff") == find(keys[0] + b"\xff") == -1


def test_scores_are_at_least_the_librarys():
    import sentencepiece
    raw = open(pc.VOCABULARY, "rb").read()
    k = raw.rindex(b"\x18\x02 \x80\xfa\x01")  # the model type in the trainer's settings: 2, BPE; 1 is unigram
    lib = sentencepiece.SentencePieceProcessor(model_proto=raw[:k + 1] + b"\x01" + raw[k + 2:])
    for s in ["the river", "ertion on the it", "Èauonsky des mentaux", "of words, and numbers 123."]:
        own = sum(map(lib.get_score, MODEL.encode(s).tolist()))
        assert own >= max(sum(lib.get_score(i) for i in ids) for ids in lib.nbest_encode_as_ids(s, 5))


def test_round_trip_and_cases(table):
    rows = [(None, "no id"), (1, None), (2, ""), (3, " two  spaces \n\n\t"), (4, "日本語 😀 \x00 é"), (5, "a▁b"),
            (6, "long " * 30000 + "x" * 5000), (7, "tie"), (7, "tie")]
    docs = table(rows)
    got = pc.with_pieces(docs, MODEL, out="n").collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        assert r.n.decoded == text.replace("▁", " ")
        assert r.n.ids == MODEL.encode(text).tolist()
        assert r.n.n_byte_pieces == sum(bool(MODEL.is_byte[i]) for i in r.n.ids)
    back = pc.decoded(pc.with_pieces(docs.where("doc_id = 3"), MODEL).selectExpr("pieces.ids as ids"), MODEL)
    assert back.first().text == rows[3][1]
    assert pc.with_pieces(table([]), MODEL).count() == 0
    assert isinstance(MODEL.encode("x"), np.ndarray)


def test_words_searched_together_equal_single_searches(monkeypatch):
    """Paths found for thousands of words at once are those of one word, ties, unknown characters and long words included."""
    texts = ["a", "b", "ab", "ba", "aab", "abb", "▁a", "▁", "é", "aé", "bbb", "▁ab"]
    model = pc.Pieces(texts, [-1.0, -1.0, -2.0, -2.0, -3.0, -2.5, -1.5, -4.0, -2.0, -3.0, -3.0, -2.5], {}).ready()
    r = random.Random(5)
    words = {"".join(r.choice("aabbé \x00漢😀\ud800") for _ in range(r.choice([1, 3, 9, 30, 200]))) for _ in range(3000)}
    monkeypatch.setattr(pc, "TOGETHER", 500)
    model.learn(list(words))
    assert {w: np.frombuffer(model.paths[w], np.int32).tolist() for w in words} == {w: model.best_path(w) for w in words}
    assert any(len(w.encode("utf-8", "surrogatepass")) > pc.LONG for w in words)


def test_a_full_cache_changes_no_path(monkeypatch):
    texts = [" ".join(f"a{i}b{i * i}" for i in range(k, k + 40)) for k in range(0, 400, 20)] + [None, "", "a b"]
    large = [i.tolist() for i in pc.Pieces.load().encode_all(texts)]
    monkeypatch.setattr(pc, "KEPT", 50)
    monkeypatch.setattr(pc, "GROUP", 300)
    model = pc.Pieces.load()
    assert [i.tolist() for i in model.encode_all(texts)] == large and len(model.paths) <= 100
