"""Quality rules, line first: clean the lines of a text, then judge what is left.

Every line that has a word is put to three rules.

* punctuation: a line that does not end in a closing mark and has fewer than
  ``min_open_words`` words is a fragment; a line in which more than ``max_symbol_pct`` per cent
  of the word characters are symbols is markup debris.
* navigation: a line with ``min_separators`` or more menu separators standing as words of
  their own.
* boilerplate: a line of at most ``max_boiler_words`` words with a boilerplate phrase, or one
  equal to an earlier line of the text.

Failing lines are removed.  A text fails when more than ``max_lost_pct`` per cent of its words
are gone, or fewer than ``min_words`` are left; before that, the two base rules reject texts of
under ``min_words`` words and those in which more than ``max_repeat_pct`` per cent of the words
stand in three-word windows found twice or more.

Nulls: a null text has no words and is rejected; a null id is carried along.  Empty text: all
counts are 0, rejected.  Very long texts are read whole; a text is the unit of work and memory.
Repeated rows are judged one by one.  Other columns, also ones named like the results of the
query, are left alone: the results stand in one struct column whose name the caller chooses.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import in_slices

# ---- FIXED VALUES: phrases and marks of the line rules --------------------------------------
BOILERPLATE = [
    "all rights reserved", "tous droits réservés", "alle rechte vorbehalten",
    "todos los derechos reservados", "privacy policy", "terms of use", "terms of service",
    "cookie policy", "uses cookies", "use cookies", "enable javascript", "click here",
    "read more", "sign up", "sign in", "log in", "subscribe to", "share this", "powered by",
    "skip to content", "back to top", "lorem ipsum",
]
CLOSING_MARKS = ".!?…:;\"'”’»)。！？"
SEPARATORS = ["|", ">", "»", "›", "•", "·", "/", "::"]
SYMBOLS = "#*$%&|<>"

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, n_lost_words long, n_failed_lines long, kept boolean")


@dataclass(frozen=True)
class LineRules:
    min_words: int = 50
    max_repeat_pct: int = 50
    min_open_words: int = 6
    max_symbol_pct: int = 10
    min_separators: int = 3
    max_boiler_words: int = 20
    max_lost_pct: int = 30


_SYMBOL_BYTES = SYMBOLS.encode()
_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)), re.IGNORECASE)
_SEP_WORDS = {s.encode() for s in SEPARATORS}
_CLOSING = tuple(m.encode() for m in CLOSING_MARKS)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by three-word windows that occur at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    n = Counter(windows)
    return len({j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)})


def n_symbol_bytes(b: bytes) -> int:
    return len(b) - len(b.translate(None, _SYMBOL_BYTES))


def code_points(words: list[bytes]) -> int:
    return len(b"".join(words).decode("utf-8", "surrogatepass"))


def line_fails(line: bytes, words: list[bytes], rules: LineRules) -> bool:
    last = words[-1]
    if len(words) < rules.min_open_words and not last.endswith(_CLOSING):
        return True
    n_sym = n_symbol_bytes(line)
    if n_sym and 100 * n_sym > rules.max_symbol_pct * code_points(words):
        return True
    if n_sym + line.count(b"\xc2") + line.count(b"\xe2") + line.count(b"/") + line.count(b"::") >= rules.min_separators \
            and sum(w in _SEP_WORDS for w in words) >= rules.min_separators:
        return True
    return len(words) <= rules.max_boiler_words and _PHRASE.search(line.decode()) is not None


def judge(text: str | None, rules: LineRules, cleaned: bool = False):
    """The values of RESULT for one text and, if asked for, the lines that stay."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n_words = len(words)
    seen, n_dup, n_lost, n_failed, left = set(), 0, 0, 0, []
    for line in raw.split(b"\n"):
        of = line.split()
        if not of:
            left.append(line)
            continue
        dup = line in seen
        n_dup += dup
        seen.add(line)
        if dup or line_fails(line, of, rules):
            n_lost += len(of)
            n_failed += 1
        else:
            left.append(line)
    n_repeat = repeated_words(words)
    failed = n_words < rules.min_words or 100 * n_repeat > rules.max_repeat_pct * n_words
    kept = not failed and 100 * n_lost <= rules.max_lost_pct * n_words and n_words - n_lost >= rules.min_words
    row = (n_words, code_points(words), n_symbol_bytes(raw), n_dup, n_repeat, failed, n_lost, n_failed, kept)
    return (*row, b"\n".join(left).decode("utf-8", "surrogatepass")) if cleaned else row


def with_line_rules(docs: DataFrame, out: str = "quality", text: str = "text",
                    rules: LineRules = LineRules(), cleaned: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out``: the values of RESULT, and ``clean_text`` if asked for.

    Only the text column goes to Python, in Arrow batches; there is no shuffle.
    """
    schema = RESULT + (", clean_text string" if cleaned else "")
    names = [f.split()[0] for f in schema.split(", ")]

    @F.pandas_udf(schema)
    def quality(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(t, rules, cleaned) for t in texts], columns=names)

    return docs.withColumn(out, quality(F.col(text)))


def keep_clean(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The texts that pass, with their failing lines removed; the other columns as they were.

    Rows are judged and sent back a few at a time, so a task holds little besides its input batch."""
    at = docs.columns.index(text)

    def clean(batches):
        for batch in in_slices(batches, 1000, 2 << 20):
            judged = [judge(t, rules, cleaned=True) for t in batch.column(at).to_pylist()]
            kept = np.array([row[8] for row in judged], bool)
            columns = batch.columns
            columns[at] = pa.array([row[-1] if row[8] else None for row in judged], batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(kept))

    return docs.mapInArrow(clean, docs.schema)


def phrase_pattern() -> str:
    """The boilerplate phrases as one alternation, for SQL."""
    return "|".join(re.escape(p).replace("\\ ", " ") for p in chain(BOILERPLATE))
