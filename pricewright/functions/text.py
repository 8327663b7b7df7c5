"""Whitespace, part numbers and fallback text.

Character classes are spelled out because ``\\s``, ``\\w`` and ``\\b`` are
ASCII-only in Java unless flagged, and even then differ from the Unicode
meaning used here: a word character is a letter, a number or an underscore.
"""

from pyspark.sql import Column, functions as F

SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
# The look behind comes after the first character: it is only tried on capitals and digits.
PART_NUMBER = rf"[A-Z0-9](?<![{WORD}][A-Z0-9])[A-Z0-9]{{6,}}+(?![{WORD}])"
PART_NUMBER_HINT = "[A-Z0-9]{7}"
TAIL = 256
SPACE_CHARACTERS = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    map(chr, range(0x2000, 0x200B))
) + "\u2028\u2029\u202f\u205f\u3000"


def strip_whitespace(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def collapse_whitespace(text: Column) -> Column:
    """Whitespace runs become one space; none is left at either end."""
    # A single blank stays as it is: only runs and other white space are touched.
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]{{2,}}|[{SPACE}&&[^ ]]", " "))


def words(text: Column) -> Column:
    """Whitespace-separated words; an empty text has none."""
    flat = collapse_whitespace(text)
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def _last_capital_and_digit(text: Column) -> Column:
    """The smaller of the last positions of a capital and of a digit; 0 if one is absent."""
    return F.least(
        F.length(F.regexp_extract(text, r"(?s)^.*[A-Z]", 0)),
        F.length(F.regexp_extract(text, r"(?s)^.*\p{Nd}", 0)),
    )


def last_part_number_start(text: Column) -> Column:
    """Position after which no part number can begin.

    A code counts only if a capital and a digit both stand at or after its
    start, up to the end of the text. So it must begin at or before the last
    capital and the last digit, whichever comes first. 0 if either is absent,
    or if nothing in the text looks like a code.

    Mostly both stand near the end, so the tail is searched before the whole.
    """
    in_tail = _last_capital_and_digit(F.substring(text, -TAIL, TAIL))
    before_tail = F.greatest(F.length(text) - TAIL, F.lit(0))
    last = F.when(in_tail > 0, before_tail + in_tail).otherwise(_last_capital_and_digit(text))
    return F.when(text.rlike(PART_NUMBER_HINT), last).otherwise(F.lit(0))


def word_end(text: Column, position: Column) -> Column:
    """Last position of the word that covers ``position`` (1-based)."""
    rest = F.substr(text, position + 1)
    return position + F.length(F.regexp_extract(rest, rf"^[{WORD}]*", 0))


def drop_part_numbers(text: Column, end: Column) -> Column:
    """Delete part numbers from the first ``end`` characters."""
    head = F.regexp_replace(F.substr(text, F.lit(1), end), PART_NUMBER, "")
    return F.when(end == 0, text).otherwise(F.concat(head, F.substr(text, end + 1)))


def strip_part_numbers(text: Column) -> Column:
    """Delete catalogue codes: words of 7+ capitals and digits (see above).

    Linear in the text. As one expression it names ``text`` several times; on
    a table prefer ``operators.cleaning.with_clean_text``, which evaluates
    each step once.
    """
    start = last_part_number_start(text)
    end = F.when(start == 0, 0).otherwise(word_end(text, start))
    return drop_part_numbers(text, end)


def effective_text(summary: Column, text: Column) -> Column:
    """The summary if there is one, else the text, else an empty string."""
    return F.coalesce(F.nullif(summary, F.lit("")), text, F.lit(""))
