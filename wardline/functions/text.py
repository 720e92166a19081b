"""Tokens and n-grams as array expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Network-flow tokens counted in a message.
FLOW_TOKENS = ("flow", "src", "dst", "sport", "dport", "proto", "bytes", "packets")

# Unicode blanks and runs of two or more Unicode word characters.
BLANKS = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
WORD = r"[\p{L}\p{N}_]{2,}"


def words_by_space(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), BLANKS)
    return F.filter(parts, lambda w: w != "")


def grams_of_word(word: Column, low: int = 1, high: int = 4) -> Column:
    """Every character n-gram of the blank-padded word, n from low to high.

    A padded word shorter than ``low`` gives itself once.
    """
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    size = F.length(padded)

    def of_size(n: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))),
            lambda start: F.substr(padded, start, n),
        )

    sizes = F.sequence(F.lit(low), F.greatest(F.lit(low), F.least(F.lit(high), size)))
    return F.flatten(F.transform(sizes, of_size))


def char_wb_ngrams(text: Column, low: int = 1, high: int = 4) -> Column:
    return F.flatten(F.transform(words_by_space(text), lambda w: grams_of_word(w, low, high)))


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_ngrams(text: Column, low: int = 1, high: int = 2) -> Column:
    def of_size(words: Column, n: int) -> Column:
        def gram(start: Column) -> Column:
            return F.concat_ws(" ", *[F.element_at(words, (start + i).cast("int")) for i in range(n)])

        last = F.size(words) - n + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1))))
        return F.coalesce(F.transform(starts, gram), F.array().cast("array<string>"))

    # The one-element array binds the tokens, which would otherwise be found again for every n-gram.
    bound = F.array(word_tokens(text))
    return F.transform(bound, lambda words: F.concat(*[of_size(words, n) for n in range(low, high + 1)]))[0]


def flow_token_count(text: Column) -> Column:
    pattern = r"\b(" + "|".join(FLOW_TOKENS) + r")\b"
    return F.regexp_count(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern))
