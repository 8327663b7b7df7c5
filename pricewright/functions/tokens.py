"""Token counting and truncation.

The default pieces are words and single punctuation marks, cut by a regex in
the JVM. Any other encoder plugs in through :class:`EncoderTokens`.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

from ..constants import SUMMARY_TOKEN_BUDGET
from .text import SPACE, WORD

# Leading space belongs to the piece, so joined pieces keep the spacing.
PIECE = rf"[{SPACE}]*(?:[{WORD}]+|[^{WORD}{SPACE}])"


def token_pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


class WordTokens:
    """Words and punctuation marks."""

    def encode(self, text: Column) -> Column:
        return token_pieces(text)

    def count(self, encoded: Column) -> Column:
        return F.size(encoded).cast("bigint")

    def head(self, encoded: Column, limit: int) -> Column:
        return F.array_join(F.slice(encoded, 1, limit), "")


class EncoderTokens:
    """An encoder with ``encode(text) -> ids`` and ``decode(ids) -> text``.

    ``load`` is called once per Python worker batch stream, not per row.
    """

    def __init__(self, load: Callable[[], object]):
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = load()
            for batch in batches:
                yield batch.map(lambda text: list(encoder.encode(text)))

        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = load()
            for batch in batches:
                yield batch.map(lambda ids: encoder.decode(list(ids)))

        encode.__annotations__ = decode.__annotations__ = {
            "batches": Iterator[pd.Series], "return": Iterator[pd.Series],
        }
        self._encode = F.pandas_udf(encode, "array<bigint>")
        self._decode = F.pandas_udf(decode, "string")

    def encode(self, text: Column) -> Column:
        return self._encode(text)

    def count(self, encoded: Column) -> Column:
        return F.size(encoded).cast("bigint")

    def head(self, encoded: Column, limit: int) -> Column:
        return self._decode(F.slice(encoded, 1, limit))


DEFAULT_TOKENS = WordTokens()


def count_tokens(text: Column, tokens=DEFAULT_TOKENS) -> Column:
    return tokens.count(tokens.encode(text))


def truncate_tokens(text: Column, limit: int = SUMMARY_TOKEN_BUDGET, tokens=DEFAULT_TOKENS) -> Column:
    """At most ``limit`` tokens; text within the limit is unchanged."""
    encoded = tokens.encode(text)
    return F.when(tokens.count(encoded) > limit, tokens.head(encoded, limit)).otherwise(text)
