"""Text analysis as column expressions: words, stop words, Porter stems.

Every function maps a column to a column, so the whole chain runs inside the
scan stage: no shuffle, no vocabulary table that would grow with the corpus.
Queries take the whole chain; documents take its words, and ``runs`` stems
them by the same rules.
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.

# Default English stop words.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will",
    "with",
)

# Longest token; longer runs are cut into pieces of this many characters.
MAX_TOKEN_LENGTH = 255

# Character classes of the Unicode word break rules.
#   MID_LETTER joins letters, MID_NUMBER joins digits, EXTEND sticks to
#   whatever comes before it.  Scripts written without spaces are kept out of
#   LETTER: Han and Hiragana give one token per character, Katakana and the
#   South-East Asian scripts give one token per run.
EXTEND = r"\p{M}\x{00AD}\x{200C}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}"
MID_LETTER = r".:'’‘․·‧：﹒﹕＇．"
MID_NUMBER = r".,;'’‘․；，﹐﹒﹔＇．٬،⁄"

# Porter's suffix rules, longest suffix first where two of a group overlap.
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
# ---------------------------------------------------------------------------


def token_pattern(dialect: str = "java") -> str:
    """The word regular expression for lower-case text, for Java or for RE2.

    Both spell the same language.  The Java form tries a plain Latin word
    first, which ends at ASCII white space or punctuation that joins nothing;
    it adds a cheap test that skips such characters, puts Latin letters before
    the script look-ups, and uses possessive quantifiers so that a run of any
    length is scanned without recursion.  Nothing that follows a repetition
    ever needs a character back.
    """
    java = dialect == "java"
    script, keep = (r"\p{Is%s}", "+") if java else (r"\p{%s}", "")
    unspaced = "".join(script % s for s in ("Thai", "Lao", "Khmer", "Myanmar"))
    letter = rf"[^\P{{L}}{script % 'Han'}{script % 'Hiragana'}{script % 'Katakana'}ー{unspaced}]"
    if java:
        letter = rf"[a-zß-öø-ÿ{letter}]"
        letters = rf"{letter}[{letter[1:-1]}{EXTEND}]*+"
    else:
        letters = rf"{letter}(?:{letter}|[{EXTEND}])*"
    digits = rf"\p{{Nd}}[\p{{Nd}}{EXTEND}]*{keep}"
    ends = r"\x00-&(-\-/;-@\[-\^`{-\x7F"
    plain = rf"[a-zß-öø-ÿ]++(?=[{ends}]|\.[{ends}]|\z)|" if java else ""
    skip = r"(?=[^\x00-/:-@\[-\^`{-©])" if java else ""
    return (
        rf"{plain}{skip}(?:"
        rf"(?:{letters}(?:[{MID_LETTER}]{letters})*{keep}"
        rf"|{digits}(?:[{MID_NUMBER}]{digits})*{keep}"
        rf"|[_\p{{Nl}}][{EXTEND}]*{keep})+{keep}"
        rf"|[{script % 'Katakana'}ー][{script % 'Katakana'}ー{EXTEND}]*{keep}"
        rf"|[{script % 'Han'}{script % 'Hiragana'}][{EXTEND}]*{keep}"
        rf"|[{unspaced}][{unspaced}{EXTEND}]*{keep})"
    )


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lowercase(text: Column) -> Column:
    """Lower case per code point.

    Two capitals depend on their neighbours or grow in whole-string lower
    casing; they are replaced first.
    """
    return F.lower(F.replace(F.replace(text, F.lit("Σ"), F.lit("σ")), F.lit("İ"), F.lit("i")))


def tokenize(text: Column) -> Column:
    """Array of lower-case words in text order; the index is the position."""
    words = F.regexp_extract_all(lowercase(text), F.lit(token_pattern()), F.lit(0))

    def cut_long(ws: Column) -> Column:
        pieces = F.transform(
            ws,
            lambda w: F.when(F.length(w) <= MAX_TOKEN_LENGTH, F.array(w)).otherwise(
                F.regexp_extract_all(w, F.lit(rf"(?s).{{1,{MAX_TOKEN_LENGTH}}}"), F.lit(0))
            ),
        )
        too_long = F.exists(ws, lambda w: F.length(w) > MAX_TOKEN_LENGTH)
        return F.when(too_long, F.flatten(pieces)).otherwise(ws)

    return bind(words, cut_long)


def drop_stop_words(words: Column) -> Column:
    """Stop words become null, so that the others keep their positions."""
    return F.transform(words, lambda w: F.when(~w.isin(*STOP_WORDS), w))


# -- Porter stemmer ---------------------------------------------------------
#
# A word is a chain of consonant groups C and vowel groups V.  A leading y is
# written Y, which makes it a consonant for all the patterns below.

_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
M_ABOVE_0 = f"^(?:{_C})?{_V}{_C}"
M_ABOVE_1 = f"^(?:{_C})?{_V}{_C}{_V}{_C}"
M_IS_1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
HAS_VOWEL = f"^(?:{_C})?[aeiouy]"
SHORT_SYLLABLE = f"^{_C}[aeiouy][^aeiouwxy]$"


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _ends(word: Column, suffix: str) -> Column:
    return F.endswith(word, F.lit(suffix))


def _choose(cases, default: Column) -> Column:
    (cond, value), *rest = cases
    expr = F.when(cond, value)
    for cond, value in rest:
        expr = expr.when(cond, value)
    return expr.otherwise(default)


def _suffix_rules(word: Column, rules, condition: str) -> Column:
    """First matching suffix decides; its stem must meet the condition.

    Rules are grouped by last letter, so most words fail a single test.
    """
    groups: dict[str, list] = {}
    for suffix, repl in sorted(rules, key=lambda r: -len(r[0])):
        stem = _cut(word, len(suffix))
        ok = stem.rlike(condition)
        if suffix == "ion":
            ok = ok & stem.rlike("[st]$")
        new = F.concat(stem, F.lit(repl)) if repl else stem
        groups.setdefault(suffix[-1], []).append(
            (_ends(word, suffix), F.when(ok, new).otherwise(word))
        )
    return _choose(
        [(_ends(word, letter), _choose(cases, word)) for letter, cases in groups.items()],
        word,
    )


def _step_1a(w: Column) -> Column:
    return F.when(
        _ends(w, "s"),
        F.when(_ends(w, "sses") | _ends(w, "ies"), _cut(w, 2)).when(_ends(w, "ss"), w).otherwise(_cut(w, 1)),
    ).otherwise(w)


def _start(w: Column) -> Column:
    """A leading y as Y, then step 1a, which leaves first letters alone."""
    marked = F.concat(F.lit("Y"), F.substring(_step_1a(w), 2, 1 << 30))
    return F.when(F.startswith(w, F.lit("y")), marked).otherwise(_step_1a(w))


def _double_consonant(w: Column) -> Column:
    last = F.substring(w, -1, 1)
    return (F.substring(w, -2, 1) == last) & (F.length(w) > 1) & ~last.isin(*"aeiouy")


def _step_1b(w: Column) -> Column:
    def repaired(stem: Column) -> Column:
        fix = bind(
            stem,
            lambda s: F.when(_ends(s, "at") | _ends(s, "bl") | _ends(s, "iz"), F.concat(s, F.lit("e")))
            .when(_double_consonant(s), F.when(s.rlike("[lsz]$"), s).otherwise(_cut(s, 1)))
            .when(s.rlike(M_IS_1) & s.rlike(SHORT_SYLLABLE), F.concat(s, F.lit("e")))
            .otherwise(s),
        )
        return F.when(stem.rlike(HAS_VOWEL), fix).otherwise(w)

    return (
        F.when(
            _ends(w, "eed"),
            F.when(_cut(w, 3).rlike(M_ABOVE_0), _cut(w, 1)).otherwise(w),
        )
        .when(_ends(w, "ed"), repaired(_cut(w, 2)))
        .when(_ends(w, "ing"), repaired(_cut(w, 3)))
        .otherwise(w)
    )


def _step_1c(w: Column) -> Column:
    stem = _cut(w, 1)
    return F.when((_ends(w, "y")) & stem.rlike(HAS_VOWEL), F.concat(stem, F.lit("i"))).otherwise(w)


def _step_2(w: Column) -> Column:
    return _suffix_rules(w, STEP2, M_ABOVE_0)


def _step_3(w: Column) -> Column:
    return _suffix_rules(w, STEP3, M_ABOVE_0)


def _step_4(w: Column) -> Column:
    return _suffix_rules(w, [(s, "") for s in STEP4], M_ABOVE_1)


def _step_5(w: Column) -> Column:
    """Final -e, then one of a final -ll; the e does not count for m."""
    stem = _cut(w, 1)
    long = stem.rlike(M_ABOVE_1)
    return (
        F.when(
            _ends(w, "e"),
            F.when(long, F.when(_ends(w, "lle"), _cut(w, 2)).otherwise(stem))
            .when(stem.rlike(M_IS_1) & ~stem.rlike(SHORT_SYLLABLE), stem)
            .otherwise(w),
        )
        .when(_ends(w, "ll") & w.rlike(M_ABOVE_1), stem)
        .otherwise(w)
    )


_STEPS = (_start, _step_1b, _step_1c, _step_2, _step_3, _step_4, _step_5)


def stem_all(words: Column) -> Column:
    """Porter stems of an array of lower-case words; nulls stay null.

    One ``transform`` per step: the lambda variable is what keeps the word of
    each step from being computed again by every test on it.
    """
    stems = words
    for step in _STEPS:
        stems = F.transform(stems, step)
    return F.zip_with(
        words,
        stems,
        lambda w, s: F.when(F.length(w) < 3, w)
        .when(F.startswith(s, F.lit("Y")), F.lower(s))
        .otherwise(s),
    )


def stem(word: Column) -> Column:
    return F.get(stem_all(F.array(word)), F.lit(0))


def analyze(text: Column) -> Column:
    """The whole chain: array of stems, null where a stop word was."""
    return stem_all(drop_stop_words(tokenize(text)))


_built: dict[tuple[str, str], Column] = {}


def analyze_column(name: str) -> Column:
    """``analyze(F.col(name))``, built once per application.

    The expression has about a thousand nodes, and making them from Python
    takes longer than analysing a short query.
    """
    key = (SparkContext.getOrCreate().applicationId, name)
    if key not in _built:
        _built[key] = analyze(F.col(name))
    return _built[key]
