"""Column expressions for tokenising text.

Token rule (kept exactly): lower-case the text, split on runs of anything that
is not ``a-z``.  Accented letters, digits and apostrophes are separators, so
"Café" gives ``caf`` and "don't" gives ``don`` and ``t``.  Leading/trailing
separators yield empty tokens; callers drop them with ``length(word) > 1``.
All of this stays JVM-side (no Python per row).
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_SPLIT = "[^a-z]+"
MIN_WORD_LENGTH = 2

# The 51 stopwords removed by document frequency and the
# inverted index (must equal the reference list for equal results).
STOPWORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "is", "it", "this", "that", "was", "are", "be", "as",
    "by", "from", "not", "have", "had", "has", "he", "she", "they", "we",
    "you", "i", "do", "did", "so", "if", "up", "out", "no", "its", "my",
    "me", "him", "her", "his", "our", "your", "their", "been", "were",
)

_VALID_TERM = re.compile(r"^[a-z]+$")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_array(text: str | Column) -> Column:
    """``split(lower(text), '[^a-z]+')`` -- array of raw tokens (may hold '')."""
    return F.split(F.lower(_col(text)), TOKEN_SPLIT)


def tokens(text: str | Column) -> Column:
    """Generator column: one row per raw token (inner: NULL text gives none)."""
    return F.explode(token_array(text))


def is_word(word: str | Column, min_length: int = MIN_WORD_LENGTH) -> Column:
    """``length(word) > 1`` -- drops empty tokens and single letters."""
    return F.length(_col(word)) >= min_length


def not_stopword(word: str | Column, stopwords: Iterable[str] = STOPWORDS) -> Column:
    """``word NOT IN (...)``; planned as an InSet hash lookup."""
    return ~_col(word).isin(*list(stopwords))


def normalise_terms(words: Iterable[str]) -> list[str]:
    """Search terms as the tokenizer would produce them, de-duplicated.

    A term must be a single token: after lower-casing it has to be non-empty
    and consist only of ``a-z``; anything else can never match and is
    rejected rather than silently returning nothing.
    """
    out: list[str] = []
    for w in words:
        t = (w or "").strip().lower()
        if not _VALID_TERM.match(t):
            raise ValueError(f"search term {w!r} is not a single a-z token")
        if t not in out:
            out.append(t)
    if not out:
        raise ValueError("no search terms given")
    return out


def term_count(text: str | Column, term: str) -> Column:
    """Tokens of ``text`` equal to ``term``: its occurrences between non-letters.

    One pass of the pattern: the characters that go when the occurrences are
    taken out, so no array of matches is made.
    """
    low = F.lower(_col(text))
    rest = F.regexp_replace(low, f"(?<![a-z]){term}(?![a-z])", "")
    return F.floor((F.length(low) - F.length(rest)) / len(term)).cast("bigint")


def may_contain_all(text: str | Column, terms: list[str]) -> Column:
    """Cheap necessary condition: every term occurs as a substring.

    Runs before the regex split so that rows which cannot match never get
    tokenised; the exact token test follows it.
    """
    low = F.lower(_col(text))
    cond = None
    for t in terms:
        c = low.contains(t)
        cond = c if cond is None else (cond & c)
    return cond
