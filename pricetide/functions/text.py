"""Text columns: tokens, token tests, previews and length rules."""

import re
import unicodedata
from functools import reduce

from pyspark.sql import functions as F

# A word is a run of letters, marks, digits and underscores; an apostrophe or a
# full stop between two runs belongs to the word. Approximates Unicode word breaks.
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{M}\p{N}_]+)*"


def tokens(column):
    """Lower-cased words of a text column, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(column), F.lit(TOKEN_PATTERN), F.lit(0))


def query_terms(text):
    """Distinct words of a search text, by the same rule as `tokens`."""
    kept = (
        c if c in "_'’." or unicodedata.category(c)[0] in "LMN" else " "
        for c in (text or "").lower()
    )
    words = re.findall(r"[^\s'’.]+(?:['’.][^\s'’.]+)*", "".join(kept))
    return list(dict.fromkeys(words))


def _contained(column, terms, combine):
    return reduce(combine, [F.contains(F.lower(column), F.lit(t)) for t in terms])


def may_have_any_term(column, terms):
    """False only where no term can be a word of `column`: none is part of its text.

    Implied by the token tests and much cheaper, so it keeps rows that cannot match away
    from the tokeniser.
    """
    return _contained(column, terms, lambda a, b: a | b)


def has_all_terms(column, text):
    """True where every word of `text` is a word of `column`."""
    terms = query_terms(text)
    if not terms:
        return F.lit(False)
    missing = F.array_except(F.array(*map(F.lit, terms)), tokens(column))
    return _contained(column, terms, lambda a, b: a & b) & (F.size(missing) == 0)


def has_any_term(column, text):
    """True where at least one word of `text` is a word of `column`."""
    terms = query_terms(text)
    if not terms:
        return F.lit(False)
    return may_have_any_term(column, terms) & F.arrays_overlap(
        tokens(column), F.array(*map(F.lit, terms))
    )


def shorten(column, limit, keep, mark="..."):
    """Texts longer than `limit` characters become their first `keep` plus a mark."""
    return F.when(
        F.length(column) > limit, F.concat(F.substring(column, 1, keep), F.lit(mark))
    ).otherwise(column)


def or_missing(column, default="N/A"):
    return F.coalesce(column, F.lit(default))


def preview(column):
    """First 50 characters of a text, `N/A` where there is none."""
    return or_missing(shorten(column, 50, 50))


def pad_with_phrases(column, phrases, at_least):
    """Append phrases in turn until the text has `at_least` characters."""
    return F.aggregate(
        phrases,
        column,
        lambda text, phrase: F.when(
            F.length(text) < at_least, F.concat_ws(" ", text, phrase)
        ).otherwise(text),
    )
