"""SentencePiece encoding and decoding: the best path through pieces with log scores.

The pieces of a vocabulary file stand in a double-array trie over UTF-8 bytes.  A text gets the
dummy prefix, its spaces become the marker U+2581, and Viterbi's recursion finds the sequence of
pieces with the largest sum of scores; of equal sums the one with the longer last piece wins,
and so on backwards.  A character that no piece covers scores ten below the least piece and is
written as its bytes.  Decoding joins the pieces, turns markers into spaces, reads runs of byte
pieces as UTF-8 (bad bytes become U+FFFD) and takes the dummy prefix off.

No piece has a marker or a line break after another character, so the best path of a text is the
best paths of its words one after the other.  Words that a worker has not met are searched together,
one byte at a time for thousands of them; their paths are kept in a bounded cache per worker, which
changes nothing but the speed.  Were a vocabulary to hold such pieces, texts would be searched whole.

Nulls and empty texts have no pieces and decode to ''.  Very long texts and words are searched
in time linear in their length.  Repeated rows are encoded one by one; an empty table gives no
rows; other columns are carried along.  Encoding and decoding give the text back unless it has
U+2581 itself, which comes back as a space.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import field_list

MARKER = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
#: words that a worker remembers; words searched together, and the longest of these in bytes; characters read at once
KEPT, TOGETHER, LONG, GROUP = 1 << 18, 1 << 13, 96, 1 << 20


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a trie of ``keys``: state ``s`` goes by byte ``c`` to
    ``t = base[s] + c`` if ``check[t] == s``; ``value[t]`` is the key's number, or -1."""
    order = sorted(range(len(keys)), key=keys.__getitem__)
    size = 1 << 16
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    free = top = 257  # first free slot, for states with one child; first slot after all used ones, for others
    todo = [(0, 0, 0, len(order))]
    while todo:
        state, depth, lo, hi = todo.pop()
        while lo < hi and len(keys[order[lo]]) == depth:
            value[state] = order[lo]
            lo += 1
        groups = []
        while lo < hi:
            c, end = keys[order[lo]][depth], lo + 1
            while end < hi and keys[order[end]][depth] == c:
                end += 1
            groups.append((c, lo, end))
            lo = end
        if not groups:
            continue
        while check[free] >= 0:
            free += 1
            if free + 512 > len(check):
                for a, x in ((base, 0), (check, -1), (value, -1)):
                    a.extend([x] * size)
        at = max(1, (free if len(groups) == 1 else top - len(groups)) - groups[0][0])
        while any(check[at + c] >= 0 for c, _, _ in groups):
            at += 1
            if at + 512 > len(check):
                for a, x in ((base, 0), (check, -1), (value, -1)):
                    a.extend([x] * size)
        base[state] = at
        top = max(top, at + groups[-1][0] + 1)
        for c, first, end in groups:
            check[at + c] = state
            todo.append((at + c, depth + 1, first, end))
    n = len(check)
    while check[n - 1] < 0 and n > 1:
        n -= 1
    n += 256
    grow = max(0, n - len(check))
    return tuple(np.array((a + [x] * grow)[:n], np.int32) for a, x in ((base, 0), (check, -1), (value, -1)))


class Pieces:
    """A vocabulary: trie, scores, byte pieces and what each id decodes to."""

    def __init__(self, texts: list[str], scores: list[float], byte_ids: dict[int, int],
                 silent: frozenset[int] = frozenset()):
        """``byte_ids``: byte value -> id; ``silent``: ids that no text is encoded to."""
        own = [i for i in range(len(texts)) if i not in silent and i not in byte_ids.values()]
        self.base, self.check, value = double_array([texts[i].encode() for i in own])
        self.value = np.where(value >= 0, np.array([*own, -1])[value], -1)
        self.scores = scores
        self.unknown = min((scores[i] for i in own), default=0.0) - UNKNOWN_PENALTY
        self.byte_ids = [byte_ids.get(b, 0) for b in range(256)]
        self.is_byte = np.zeros(len(texts), bool)
        self.is_byte[list(byte_ids.values())] = True
        self.out = [b"" if i in silent else texts[i].replace(MARKER, " ").encode() for i in range(len(texts))]
        for b, i in byte_ids.items():
            self.out[i] = bytes([b])
        inner = "".join(texts[i].lstrip(MARKER) for i in own)
        cuts = "" if MARKER in inner else "".join(c for c in "\n\t\r" if c not in inner)
        rest = re.escape(" " + cuts)
        self.pattern = f"[{re.escape(cuts)}]| *[^{rest}]+| +" if cuts else (" *[^ ]+| +" if MARKER not in inner else "(?s).+")

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Pieces:
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(m.get_piece_size())
        byte_ids = {int(m.id_to_piece(i)[1:-1], 16): i for i in ids if m.is_byte(i)}
        silent = frozenset(i for i in ids if m.is_control(i) or m.is_unknown(i) or m.is_unused(i))
        return cls([m.id_to_piece(i) for i in ids], [m.get_score(i) for i in ids], byte_ids, silent)

    def ready(self) -> Pieces:
        """Plain lists and the paths by word, made once per process."""
        if not hasattr(self, "paths"):
            self.lists = self.base.tolist(), self.check.tolist(), self.value.tolist()
            self.words = re.compile(self.pattern)
            self.score = np.array(self.scores, np.float64)
            self.paths = {}
        return self

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("lists", "paths", "words", "score")}

    def best_path(self, word: str) -> list[int]:
        """The ids of the best path through a piece of text (spaces stand for markers)."""
        base, check, value = self.lists
        scores, least = self.scores, float("-inf")
        s = word.replace(" ", MARKER).encode("utf-8", "surrogatepass")
        n = len(s)
        best, back, by = [least] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here == least:
                continue
            b = s[i]
            one = i + (1 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4)
            state, covered = 0, False
            for k in range(i, n):
                t = base[state] + s[k]
                if check[t] != state:
                    break
                state = t
                v = value[t]
                if v >= 0:
                    k += 1
                    if k == one:
                        covered = True
                    score = here + scores[v]
                    if score > best[k]:
                        best[k], back[k], by[k] = score, i, v
            if not covered:
                one = min(one, n)
                score = here + self.unknown
                if score > best[one]:
                    best[one], back[one], by[one] = score, i, -1
        out, k = [], n
        while k:
            i = back[k]
            if by[k] >= 0:
                out.append(by[k])
            else:
                out.extend(self.byte_ids[x] for x in reversed(s[i:k]))
            k = i
        return out[::-1]

    def best_paths(self, texts: list[bytes]) -> list[bytes]:
        """The paths of :meth:`best_path` as int32 bytes, for words given as UTF-8 with markers, the longest first.

        All words take a step together: position by position, and from each along the trie until no word goes on."""
        lens = np.array([len(t) for t in texts], np.int32)
        n, most = len(texts), int(lens[0])
        s = np.ascontiguousarray(np.frombuffer(b"".join(t.ljust(most, b"\0") for t in texts), np.uint8).reshape(n, most).T)
        best = np.full((most + 1, n), -np.inf)
        back, by = np.zeros((most + 1, n), np.int32), np.full((most + 1, n), -1, np.int32)
        best[0] = 0.0
        step = 1 + (s >= 0xC0) + (s >= 0xE0) + (s >= 0xF0)
        longer = [int(np.searchsorted(-lens, -i)) for i in range(most + 1)]  # how many words have more than i bytes
        for i in range(most):
            live = np.flatnonzero(best[i, :longer[i]] > -np.inf)
            one = np.minimum(i + step[i, live], lens[live])
            here, covered = best[i], np.zeros(n, bool)
            w, state = live, np.zeros(len(live), np.int32)
            for k in range(i, most):
                end = int(np.searchsorted(w, longer[k]))
                w, state = w[:end], state[:end]
                to = self.base[state] + s[k, w]
                on = self.check[to] == state
                w, state = w[on], to[on]
                if not len(w):
                    break
                v = self.value[state]
                hit = v >= 0
                at, v = w[hit], v[hit]
                covered[at[i + step[i, at] == k + 1]] = True
                score = here[at] + self.score[v]
                up = score > best[k + 1, at]
                at = at[up]
                best[k + 1, at], back[k + 1, at], by[k + 1, at] = score[up], i, v[up]
            bare = ~covered[live]
            w, one = live[bare], one[bare]
            score = here[w] + self.unknown
            up = score > best[one, w]
            w, one = w[up], one[up]
            best[one, w], back[one, w], by[one, w] = score[up], i, -1
        # backwards, a piece a turn, or a byte of a character that no piece covers (down to position ``low``)
        ids, k, low, w = [], lens.copy(), lens.copy(), np.arange(n)
        byte_ids = np.array(self.byte_ids, np.int32)
        while len(w):
            at = k[w]
            new = at == low[w]
            low[w[new]] = back[at[new], w[new]]
            piece = np.where(new, by[at, w], -1)
            known = piece >= 0
            row = np.full(n, -1, np.int32)
            row[w] = np.where(known, piece, byte_ids[s[at - 1, w]])
            ids.append(row)
            k[w] = np.where(known, low[w], at - 1)
            w = w[k[w] > 0]
        table = np.array(ids[::-1]).T
        used = table >= 0
        flat = table[used].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(used.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, new: list[str]) -> None:
        """Put the paths of words into the cache."""
        texts = [w.replace(" ", MARKER).encode("utf-8", "surrogatepass") for w in new]
        lens = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lens, kind="stable")
        n_long = int((lens > LONG).sum())
        for i in order[:n_long]:
            self.paths[new[i]] = array("i", self.best_path(new[i])).tobytes()
        for first in range(n_long, len(new), TOGETHER):
            some = order[first:first + TOGETHER].tolist()
            self.paths.update(zip(map(new.__getitem__, some), self.best_paths([texts[i] for i in some])))

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; about ``GROUP`` characters are split into words at a time."""
        self.ready()
        out, group, size = [], [], 0
        for place, text in enumerate(texts, 1):
            group.append(self.words.findall(" " + text.replace(MARKER, " ")) if text else [])
            size += len(text or "")
            if size < GROUP and place < len(texts):
                continue
            met = set(chain.from_iterable(group))
            new = met.difference(self.paths)
            if len(self.paths) + len(new) > KEPT:  # words of these texts stay, frequent ones among them
                self.paths = {w: self.paths[w] for w in met.difference(new)}
            self.learn(list(new))
            out += [np.frombuffer(b"".join(map(self.paths.__getitem__, words)), np.int32) for words in group]
            group, size = [], 0
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


RESULT = "ids array<int>, n_byte_pieces long, decoded string"


def with_pieces(docs: DataFrame, model: Pieces, text: str = "text", out: str = "pieces", rows: int = 256) -> DataFrame:
    """``docs`` with a struct ``out``: ids, n_byte_pieces and decoded, the text read back.

    Results leave the worker ``rows`` texts at a time, which bounds its memory."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c != out]

    def encode(batches):
        m = shared.value.ready()
        for whole in batches:
            for first in range(0, len(whole), rows):
                batch = whole.slice(first, rows)
                ids = m.encode_all(batch.column(text).to_pylist())
                ends = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                result = pa.StructArray.from_arrays(
                    [lists, pa.array([int(m.is_byte[i].sum()) for i in ids], pa.int64()),
                     pa.array([m.decode(i.tolist()) for i in ids], pa.string())], ["ids", "n_byte_pieces", "decoded"])
                yield pa.record_batch([*[batch.column(c) for c in rest], result], [*rest, out])

    schema = docs.select(*rest).schema.add(out, field_list(RESULT))
    return docs.select(*rest).mapInArrow(encode, schema)


def decoded(tokens: DataFrame, model: Pieces, ids: str = "ids", out: str = "text") -> DataFrame:
    shared = tokens.sparkSession.sparkContext.broadcast(model)
    column = F.pandas_udf(lambda of: of.map(lambda i: shared.value.decode(i.tolist())), "string")
    return tokens.withColumn(out, column(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
