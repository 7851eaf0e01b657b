"""Terms of documents with their positions, as an Arrow function over words.

Indexing meets the same few words again and again, so here each distinct word
of a batch is stemmed once, and a worker remembers the stems of words it has
met.  The stemmer is that of ``analysis``, rule by rule, for single words;
queries are analysed by the expressions there.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions import analysis as A

# Words laid out at a time, and words a worker remembers; it forgets all beyond, which only costs time.
PIECE_WORDS = 1 << 19
REMEMBERED = 1 << 19

_m_above_0, _m_above_1, _m_is_1, _has_vowel, _short = (
    re.compile(p).match for p in (A.M_ABOVE_0, A.M_ABOVE_1, A.M_IS_1, A.HAS_VOWEL, A.SHORT_SYLLABLE)
)


def _step_1b(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if _m_above_0(w[:-3]) else w
    if not w.endswith(("ed", "ing")):
        return w
    s = w[:-2] if w.endswith("ed") else w[:-3]
    if not _has_vowel(s):
        return w
    if s.endswith(("at", "bl", "iz")):
        return s + "e"
    if len(s) > 1 and s[-1] == s[-2] and s[-1] not in "aeiouy":
        return s if s[-1] in "lsz" else s[:-1]
    return s + "e" if _m_is_1(s) and _short(s) else s


def _by_last_letter(rules) -> dict[str, list[tuple[str, str]]]:
    groups: dict[str, list[tuple[str, str]]] = {}
    for suffix, new in sorted(rules, key=lambda r: -len(r[0])):
        groups.setdefault(suffix[-1], []).append((suffix, new))
    return groups


_SUFFIX_STEPS = (
    (_by_last_letter(A.STEP2), _m_above_0),
    (_by_last_letter(A.STEP3), _m_above_0),
    (_by_last_letter([(s, "") for s in A.STEP4]), _m_above_1),
)


# A word with another last letter stays as it is.
_CUT_LETTERS = frozenset("sdgyel").union(*(groups for groups, _ in _SUFFIX_STEPS))


def stem_word(word: str) -> str:
    """The Porter stem of a lower-case word, as ``analysis.stem``."""
    if len(word) < 3 or word[-1] not in _CUT_LETTERS:
        return word
    w = word
    if w.endswith("s"):
        w = w[:-2] if w.endswith(("sses", "ies")) else w if w.endswith("ss") else w[:-1]
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = _step_1b(w)
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    for groups, condition in _SUFFIX_STEPS:
        for suffix, new in groups.get(w[-1:], ()):
            if w.endswith(suffix):
                s = w[: -len(suffix)]
                if condition(s) and (suffix != "ion" or s.endswith(("s", "t"))):
                    w = s + new
                break
    if w.endswith("e"):
        s = w[:-1]
        if _m_above_1(s):
            w = w[:-2] if w.endswith("lle") else s
        elif _m_is_1(s) and not _short(s):
            w = s
    elif w.endswith("ll") and _m_above_1(w):
        w = w[:-1]
    return "y" + w[1:] if w.startswith("Y") else w


class Terms(dict):
    """Terms by word, remembered; null for stop words."""

    def __missing__(self, word: str) -> str | None:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = None if word in _stop_words else stem_word(word)
        return value


_stop_words = frozenset(A.STOP_WORDS)
_known = Terms()
_ELEMENT = pa.struct([("term", pa.string()), ("tf", pa.int32()), ("positions", pa.list_(pa.int32()))])


def runs_of(words: pa.ListArray) -> pa.ListArray:
    """Arrays of (term, tf, positions), by term, from arrays of words; null has none."""
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = words.flatten().dictionary_encode()
    terms = [_known[w] for w in encoded.dictionary.to_pylist()]
    names = sorted({t for t in terms if t is not None})  # by code point, which is the order of UTF-8
    number = {t: i for i, t in enumerate(names)} | {None: -1}
    numbers = np.array([number[t] for t in terms], dtype=np.int64)

    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    pos = np.arange(len(doc)) - np.repeat(ends - lengths, lengths)
    term = numbers[encoded.indices.to_numpy(zero_copy_only=False)]
    kept = np.flatnonzero(term >= 0)
    key = doc[kept] * max(len(names), 1) + term[kept]
    order = np.argsort(key, kind="stable")
    key, kept = key[order], kept[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    bounds = np.append(starts, len(key)).astype(np.int32)
    first = kept[starts]
    runs = pa.StructArray.from_arrays(
        [
            pa.array(names, pa.string()).take(pa.array(term[first])),
            pa.array(np.diff(bounds)),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(pos[kept].astype(np.int32))),
        ],
        fields=list(_ELEMENT),
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[first], np.arange(len(lengths) + 1)).astype(np.int32)), runs)


def _pieces(words: pa.ListArray) -> list[pa.ListArray]:
    """The rows in order, in parts of about PIECE_WORDS words; a row is never cut."""
    before = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)) // PIECE_WORDS
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), len(words)]
    return [words.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


def term_runs(words: Column) -> Column:
    """Array of (term, tf, positions), by term, from an array of lower-case words."""

    @F.arrow_udf("array<struct<term: string, tf: int, positions: array<int>>>")
    def runs(batch: pa.Array) -> pa.Array:
        return pa.concat_arrays([runs_of(piece) for piece in _pieces(batch)])

    return runs(words)
