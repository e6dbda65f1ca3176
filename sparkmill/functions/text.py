"""Text cleaning and tokenising expressions.

Fixed values that must equal the reference's behaviour:
  * whitespace is the ASCII set space, tab, LF, CR, FF, VT;
  * "remove punctuation" lower-cases and deletes every character that is not
    a-z, 0-9 or whitespace (it deletes, it does not blank: ``feed'st`` -> ``feedst``);
  * the simple tokenizer splits on runs of non-word characters (``\\W+``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (character classes, Java regex syntax; RE2 reads them the same way).
WHITESPACE_CLASS = "[ \\t\\n\\r\\f\\x0B]"
NOT_KEPT_CLASS = "[^a-z0-9 \\t\\n\\r\\f\\x0B]"
NON_WORD_RUN = "\\W+"

# The same deletion in two cheap steps: drop every non-ASCII character with a
# single-range class, then the ASCII characters outside the kept set with
# translate (a per-character table lookup).  Java's regex engine is several
# times slower on the negated multi-range class itself.
_KEPT = set("abcdefghijklmnopqrstuvwxyz0123456789 \t\n\r\f\x0b")
NON_ASCII_CLASS = "[^\\x00-\\x7F]"
ASCII_NOT_KEPT = "".join(chr(c) for c in range(128) if chr(c) not in _KEPT)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Lower-case, then delete everything but a-z, 0-9 and whitespace
    (``regexp_replace(lower(c), NOT_KEPT_CLASS, '')``, computed faster)."""
    return F.translate(F.regexp_replace(F.lower(_col(c)), NON_ASCII_CLASS, ""), ASCII_NOT_KEPT, "")


def whitespace_tokens(c) -> Column:
    """Array of non-empty tokens split on whitespace runs (Python ``str.split()``)."""
    parts = F.split(_col(c), WHITESPACE_CLASS + "+")
    return F.filter(parts, lambda t: t != F.lit(""))


def simple_tokens(c) -> Column:
    """Lower-case, split on ``\\W+``, drop empty strings."""
    parts = F.split(F.lower(_col(c)), NON_WORD_RUN)
    return F.filter(parts, lambda t: t != F.lit(""))


def remove_stop_words(tokens: Column, stop_words: list[str]) -> Column:
    """Drop tokens found in a stop-word list; keeps order and duplicates.

    The list travels inside the plan as literals; Catalyst turns the ``IN`` list
    into a hash set (``InSet``), so each token costs one hash probe in the JVM.
    A list that is data itself goes through ``operators.text.clean_documents_by_join``.
    """
    words = sorted(set(stop_words))
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(words))
