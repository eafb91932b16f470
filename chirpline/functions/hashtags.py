"""Hashtag rules as column expressions.

Two rules exist on purpose, as their keys differ. The batch rule cuts at single
spaces and keeps the ``#``; the message rule cuts at any whitespace and drops
it. Neither changes case or strips punctuation.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace that separates words in the message rule, which
# is every Unicode space and the four separators U+001C to U+001F.
WORD_SPACE = r"\s\x1c-\x1f"

# A ``#`` with no other letter before it, and the rest of its word. The search
# for ``#`` comes first, as looking back from every letter is several times
# slower.
MESSAGE_TAG = rf"(?U)#(?<![^{WORD_SPACE}]#)([^{WORD_SPACE}]*)"

# Fixed value: the first-tag pattern, ASCII word characters only.
FIRST_TAG = r"(#\w+)"


def message_tags(text: Column) -> Column:
    """Array of tags in ``text`` without their ``#``; null for null text.

    One regular expression finds the words that start with ``#``, so no array
    of all words is built and the step stays within generated code. Most texts
    hold no ``#`` at all and are not searched.
    """
    found = F.regexp_extract_all(text, F.lit(MESSAGE_TAG), F.lit(1))
    return F.when(text.contains("#"), found).when(text.isNotNull(), F.array().cast("array<string>"))


def space_words(text: Column) -> Column:
    """Array of the pieces of ``text`` between single spaces."""
    return F.split(text, " ")


def first_tag(text: Column) -> Column:
    """First tag of ``text`` as an array of one; ``[""]`` where there is none."""
    return F.split(F.regexp_extract(text, FIRST_TAG, 1), " ")


def without_hash(word: Column) -> Column:
    """``word`` less one leading ``#``, if it has one."""
    return F.regexp_replace(word, "^#", "")
