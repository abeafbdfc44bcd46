"""Text cleaning, tokenising and sentence splitting as Column expressions.

Three notions of a word are in use and are kept apart on purpose:

* ``clean_words``: letters only, everything else deleted, split on white space;
* ``raw_words``: white-space pieces of the untouched text;
* ``unicode_words``: runs of letters, digits and underscore of any script.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters at which a white-space split without a separator cuts. None of
# them is from ! to ~; saying so first spares most characters the other tests.
ANY_SPACE = r"[[^!-~]&&[\s\x1c-\x1f\x85\p{Z}]]+"
# Longest run whose words are named one by one.
NAMED_WORDS = 8
# Category markup in article text.
CATEGORY_LINK = r"\[\[Category:([^\]|\n]+)"


def _nonempty(pieces: Column) -> Column:
    return F.array_remove(pieces, "")


# "Any character that is not in the class" is written as a look-ahead: it matches
# what a negated class matches and runs about four times as fast.
NOT_LETTER = r"(?s)(?![a-zA-Z\s])."
NOT_SENTENCE = r"(?s)(?![\w\s.,!?])."


def letters_only(text: Column) -> Column:
    """Lower-case, then delete every character that is no letter a-z or space."""
    return F.regexp_replace(F.lower(text), NOT_LETTER, "")


def clean_words(text: Column) -> Column:
    return _nonempty(F.split(letters_only(text), r"\s+"))


def raw_words(text: Column) -> Column:
    return _nonempty(F.split(text, ANY_SPACE))


def spaced_words(text: Column) -> Column:
    """Lower-cased split on white space that keeps the empty edge pieces."""
    return F.split(F.lower(text), r"\s+")


def unicode_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def word_sequences(words: Column, n: int) -> Column:
    """Every run of ``n`` words, joined with a space, in order; none if there are fewer.

    ``words`` is looked at for every run, so it should be a plain column.
    """
    none = F.array().cast("array<string>")
    if n == 1:
        return F.coalesce(words, none)
    if n > NAMED_WORDS:
        places = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
        runs = F.transform(places, lambda i: F.array_join(F.slice(words, i, n), " "))
    else:
        # Words of short runs are named one by one, which takes a fifth of the time.
        heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))
        runs = F.transform(
            heads, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, n)])
        )
    return F.coalesce(runs, none)


def punctuated(text: Column) -> Column:
    """Blank out what is neither an ASCII word character, space nor . , ! ?"""
    return F.regexp_replace(text, NOT_SENTENCE, " ")


def sentences(text: Column) -> Column:
    """Cut after . ! or ? where spaces follow; a trailing empty piece stays."""
    return F.split(text, r"(?<=[.!?]) +")


def sentence_word_counts(text: Column) -> Column:
    return F.transform(sentences(text), lambda s: F.size(_nonempty(F.split(s, r"\s+"))))


def is_sentence(text: Column) -> Column:
    """Last line holds a letter or digit and ends in . ! or ?

    Built from end checks rather than one searching pattern, whose backtracking
    is quadratic on long lines.
    """
    body = F.regexp_replace(text, r"\n\z", "")
    last_line = F.substring_index(body, "\n", -1)
    return F.coalesce(
        F.right(body, F.lit(1)).isin(".", "!", "?") & last_line.rlike("[a-zA-Z0-9]"),
        F.lit(False),
    )


def normal_title(title: Column) -> Column:
    """Drop the category prefix, trim, and write spaces as underscores."""
    return F.translate(F.trim(F.regexp_replace(title, "^Category:", "")), " ", "_")


def preview(text: Column, n: int = 100) -> Column:
    return F.substring(text, 1, n)


def linked_names(text: Column, pattern: str = CATEGORY_LINK) -> Column:
    """Distinct trimmed names captured by ``pattern``, in the order met."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_distinct(F.transform(found, lambda name: F.trim(name)))


def phrase_hits(text: Column, phrase: str) -> Column:
    """Occurrences of a lower-case phrase that is not inside a longer word."""
    quoted = r"\Q" + phrase + r"\E"
    return F.regexp_count(
        F.lower(text), F.lit(rf"(?<![\p{{L}}\p{{N}}_]){quoted}(?![\p{{L}}\p{{N}}_])")
    )
