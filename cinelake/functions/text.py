"""Word tokens and n-grams as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Default English stop words, the public list shipped with Spark ML,
# without the contractions and single letters that no token can equal.
ENGLISH_STOP_WORDS = tuple(
    """
    me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too
    very can will just don should now could would ought cannot
    """.split()
)


def word_tokens(text: Column, stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TOKEN_PATTERN})"), F.lit(1))
    if not stop_words:
        return words
    return F.filter(words, lambda word: ~word.isin(*stop_words))


def with_bigrams(tokens: Column) -> Column:
    """The tokens themselves followed by every pair of neighbours."""
    heads = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))
    pairs = F.zip_with(heads, F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(tokens, pairs)
