"""The JSON details of a listing: to a map, and back to canonical text."""

from pyspark.sql import Column, functions as F

_MAP = "map<string,string>"
_OPTIONS = {"allowSingleQuotes": "false"}

# Stand-ins for `\\` and `\"` while cutting text into JSON tokens. Raw control
# characters cannot occur in valid JSON.
_BACKSLASH, _QUOTE = "\x01", "\x02"
_TOKEN = r'"[^"]*"|[\[\]{},:]|[^\s\[\]{},:"]+'
_NEEDS_REWRITE = r"[^ -~\x01\x02]|\\[u/]"


def details_pair(details: Column) -> Column:
    """The text parsed as the first of two array elements, so that text after
    the object makes the array malformed or of another size."""
    return F.from_json(F.concat(F.lit("["), details, F.lit(",{}]")), f"array<{_MAP}>", _OPTIONS)


def object_of(pair: Column) -> Column:
    """The map of a JSON object out of its ``details_pair``; null for anything else."""
    return F.when(F.size(pair) == 2, F.get(pair, F.lit(0)))


def details_object(details: Column) -> Column:
    return object_of(details_pair(details))


def _last_value_wins(entries: Column) -> Column:
    """Drop repeated keys: first position, last value."""
    keys = F.map_keys(entries)
    values = F.map_values(entries)
    last = F.transform(
        F.array_distinct(keys),
        lambda key: F.element_at(
            F.filter(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda e: e["k"] == key), -1
        )["v"],
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(
        F.map_from_arrays(F.array_distinct(keys), last)
    )


def parse_details(details: Column) -> Column:
    """JSON object as a map; null, empty, broken or non-object gives an empty map."""
    empty = F.create_map().cast(_MAP)
    return F.coalesce(_last_value_wins(details_object(details)), empty)


def _hex_escape(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def _escape_character(character: Column) -> Column:
    code = F.ascii(character)
    short = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    escaped = F.when(code.between(0x20, 0x7E), character)
    for raw, text in reversed(short.items()):
        escaped = F.when(character == raw, F.lit(text)).otherwise(escaped)
    beyond = code - 0x10000
    pair = F.concat(
        _hex_escape(F.lit(0xD800) + F.shiftright(beyond, 10)),
        _hex_escape(F.lit(0xDC00) + beyond.bitwiseAND(0x3FF)),
    )
    return F.coalesce(escaped, F.when(code > 0xFFFF, pair).otherwise(_hex_escape(code)))


def _restore(token: Column) -> Column:
    return F.replace(F.replace(token, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def _rewrite_string(token: Column) -> Column:
    """Decode one JSON string token and encode it in ASCII."""
    value = F.from_json(F.concat(F.lit('{"v":'), _restore(token), F.lit("}")), "v string")["v"]
    characters = F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))
    return F.concat(F.lit('"'), F.array_join(F.transform(characters, _escape_character), ""), F.lit('"'))


def last_value(entries: Column, key: str) -> Column:
    """Value of the last entry with ``key`` of an object read by ``details_object``; null without one."""
    return F.try_element_at(F.map_values(F.map_filter(entries, lambda k, _: k == key)), F.lit(-1))


def serialize_details(details: Column, entries: Column | None = None) -> Column:
    """Canonical text of the JSON object: ``, `` and ``: `` between items,
    non-ASCII escaped, key order and nesting kept; ``{}`` when there is none.

    Numbers stay as written, and a key repeated in the text stays repeated.
    Pass ``entries``, the stored ``details_object``, to spare another parse.
    """
    marked = F.replace(F.replace(details, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    tokens = F.regexp_extract_all(marked, F.lit(_TOKEN), F.lit(0))
    spaced = F.transform(
        tokens,
        lambda t: F.when(t == ",", F.lit(", "))
        .when(t == ":", F.lit(": "))
        .when(t.startswith('"') & t.rlike(_NEEDS_REWRITE), _rewrite_string(t))
        .otherwise(_restore(t)),
    )
    text = F.array_join(spaced, "")
    known = details_object(details) if entries is None else entries
    return F.when(known.isNotNull(), text).otherwise(F.lit("{}"))
