"""Column expressions for article text. All of them are built-in functions: no Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpus_engine.functions.stopwords import ENGLISH

# (?U) makes \s cover the no-break and other Unicode spaces; \x1c-\x1f are separators as well.
URL_PATTERN = r"(?U)(?:http|www)[^\s\x1c-\x1f]+"
NON_BLANK = r"(?U)[^\s\x1c-\x1f]"


def lowered(text: Column) -> Column:
    return F.lower(text)


def without_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_PATTERN, " ")


def letters_only(text: Column) -> Column:
    """Everything but a-z and white space becomes a space, one for one."""
    return F.regexp_replace(text, r"(?U)[^a-z\s\x1c-\x1f]", " ")


def squeezed(text: Column) -> Column:
    """Runs of white space collapse to one space; none at either end."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def normalize_text(text: Column) -> Column:
    """Lower-case, drop URLs, keep a-z words separated by single spaces.

    Same value as ``squeezed(letters_only(without_urls(lowered(text))))`` in one regex pass fewer.
    """
    return F.trim(F.regexp_replace(without_urls(lowered(text)), "[^a-z]+", " "))


def split_words(normalized: Column, stop: Sequence[str] = ENGLISH) -> Column:
    """Words of a normalised text without stopwords and one-letter words; ``""`` gives ``[]``."""
    return F.filter(
        F.split(normalized, " "),
        lambda w: (F.length(w) > 1) & ~w.isin(list(stop)),
    )


def clean_text(text: Column, stop: Sequence[str] = ENGLISH) -> Column:
    """Normalised text with stopwords and one-letter words removed."""
    return F.array_join(split_words(normalize_text(text), stop), " ")


def combine_text(title: Column, content: Column) -> Column:
    """``title + " " + content``; the content alone where the title is null or empty."""
    return F.when(F.coalesce(title, F.lit("")) == "", content).otherwise(
        F.concat(title, F.lit(" "), content)
    )


def ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams of ``low..high`` words, built inside the row.

    ``words`` should be a stored column, not an expression: it is read several times.
    """
    gram, found = words, [words] if low == 1 else []
    for n in range(2, high + 1):
        count = F.greatest(F.size(words) - (n - 1), F.lit(0))
        gram = F.zip_with(
            F.slice(gram, F.lit(1), count),
            F.slice(words, F.lit(n), count),
            lambda head, word: F.concat(head, F.lit(" "), word),
        )
        if n >= low:
            found.append(gram)
    return F.concat(*found) if len(found) > 1 else found[0]


def preview(text: Column, n: int = 200, ellipsis: bool = True) -> Column:
    """The first ``n`` characters, followed by ``...`` where something was cut."""
    head = F.substring(text, 1, n)
    if not ellipsis:
        return head
    return F.when(F.length(text) > n, F.concat(head, F.lit("..."))).otherwise(head)


def keywords_from_name(name: Column, sep: str = ", ") -> Column:
    """``"3_court_law_judge"`` -> ``"court, law, judge"``."""
    parts = F.split(name, "_")
    return F.array_join(F.slice(parts, F.lit(2), F.size(parts)), sep)


def is_blank(text: Column) -> Column:
    """Null, empty, or nothing but (Unicode) white space."""
    return ~F.coalesce(F.rlike(text, F.lit(NON_BLANK)), F.lit(False))
