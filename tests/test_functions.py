"""Column functions against plain Python on edge cases."""

import json
import math
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from pricewright.functions import deals, details, hashing, numbers, prompts, text, tokens


PRICES = {
    "$49.99": 49.99, "$1,299.00": 1299.0, "49.99": 49.99, "": None, None: None, " 5 ": 5.0, "1e2": 100.0, "1.0d": None, "5f": None,
    ".5": 0.5, "5.": 5.0, "10.99 - 20.99": None, "from 3.00": None, "-3": -3.0, "+4": 4.0, "$": None, "0": 0.0,
    "\u00a07\u2003": 7.0, "1E-2": 0.01, "..": None, "inf": math.inf, "Infinity": math.inf, "--1": None,
}


def test_parse_price(one):
    assert one(list(PRICES), numbers.parse_price) == list(PRICES.values())
    assert math.isnan(one(["nan"], numbers.parse_price)[0])


def test_price_range(one):
    values = [0.49, 0.50, 999.49, 999.50, float("nan"), float("inf"), None]
    assert one(values, numbers.price_in_range, "double") == [False, True, True, False, False, False, None]


@pytest.mark.parametrize("value,pounds", [
    ("1.5 pounds", 1.5), ("16 Ounces", 1.0), ("500 grams", 1.1023), ("2 kilograms", 4.4092), ("3 pound", 0.0),
    ("7", 0.0), ("heavy", 0.0), (None, 0.0), ("", 0.0), ("heavy pounds", 0.0), ("1,000 pounds", 0.0),
    ("  2\t POUNDS each ", 2.0), ("5 milligrams", 0.0), ("453592 milligrams", 1.0),
])
def test_weight(one, value, pounds):
    assert one([value], numbers.weight_pounds) == [pounds]


def test_dollars_round_half_to_even(one):
    values = [0.5, 1.5, 2.5, 99.5, 64.3, 999.49]
    assert one(values, numbers.dollars, "double") == [round(v) for v in values]
    assert one([64.3], numbers.completion, "double") == ["64.00"]


#: What each reading makes of an output: signed, notebook, bounded, raw.
OUTPUTS = {
    "-5": (0.0, 5.0, 5.0, 5.0), ".5": (0.5, 5.0, 5.0, 5.0), "99999": (99999.0, 99999.0, 0.0, 99999.0),
    "$1,299.99": (1299.99, 1299.99, 1299.99, 1299.99), "N/A": (0.0, 0.0, 0.0, 0.0), "": (0.0, 0.0, 0.0, 0.0),
    "about $12.50 or so": (12.5, 12.5, 12.5, 12.5), "5.": (5.0, 5.0, 5.0, 5.0), "a1b2": (1.0, 1.0, 1.0, 1.0),
    "+3.25": (3.25, 3.25, 3.25, 3.25), "1.2.3": (1.2, 1.2, 1.2, 1.2), "10000": (10000.0, 10000.0, 0.0, 10000.0),
    "9999.99": (9999.99, 9999.99, 9999.99, 9999.99), "0": (0.0, 0.0, 0.0, 0.0), "Price is $278.00<|end|>": (278.0, 278.0, 278.0, 278.0),
}


@pytest.mark.parametrize("place, mode", list(enumerate(("signed", "notebook", "bounded", "raw"))))
def test_parse_output(one, place, mode):
    assert mode in numbers.OUTPUT_MODES
    assert one(list(OUTPUTS), lambda c: numbers.parse_output(c, mode)) == [found[place] for found in OUTPUTS.values()]
    assert one([None], lambda c: numbers.parse_output(c, mode)) == [0.0]


def test_numeric_outputs(one):
    assert one([-5.0, 2.5, None], numbers.parse_number_output, "float") == [0.0, 2.5, 0.0]


def without_codes(value):
    """Word by word: drop those of 7 and more capitals and digits, where a capital and a digit still follow or stand in them."""
    flat, out, at = " ".join(value.split()), [], 0
    while at < len(flat):
        end = at
        while end < len(flat) and (flat[end].isalnum() or flat[end] == "_"):
            end += 1
        word, rest = flat[at:end], flat[at:]
        plain = len(word) >= 7 and all("A" <= c <= "Z" or "0" <= c <= "9" for c in word)
        if not (plain and any("A" <= c <= "Z" for c in rest) and any(unicodedata.category(c) == "Nd" for c in rest)):
            out.append(word)
        out.append(flat[end:end + 1])
        at = end + 1
    return "".join(out)


TEXTS = [
    "B07XJ8C8F5 knob", "AX-7823-B", "SKU-1234ABC x", "PROFESSIONAL grade drill", "PROFESSIONAL grade 20V",
    "1234567 then Abc", "1234567 then abc", "", "   ", "ABCDEFG1", "ABCDEFG1\u00e9 A1", "\u00c9ABCDEFG1 1A", "ABCDEFG_1234567",
    "a\u00a0b\u2003c\x1cd\x85e", "ABCDEFGH 1 IJKLMNOP", "1234567 ABCDEFG 7654321", "x ABCDEFGHIJ \u0663", "ABCDEF1", "ABCDE1",
    "ABCDEFGH\U0001f600 1", "\U0001f600 ABCDEFGH1 \U0001f600", "ABCDEFG\u00b21 9", "AAAAAAA,BBBBBBB;CCCCCCC 1", "lower 1234567A",
]


def test_part_numbers_equal_the_rule_word_by_word(one):
    got = one(TEXTS, lambda c: text.strip_part_numbers(text.collapse_whitespace(c)))
    assert got == [without_codes(t) for t in TEXTS]


def test_part_numbers_on_random_texts(one):
    import random

    draw = random.Random(7)
    alphabet = ["A", "B", "Z", "0", "9", "a", "\u00e9", "_", "-", " ", " ", "."]
    texts = ["".join(draw.choices(alphabet, k=60)) for _ in range(400)]
    texts += ["".join(draw.choices(["A", "7", " "], [5, 2, 1], k=80)) for _ in range(400)]
    # Around the length of the tail that is searched first, with ends that lack one or both.
    for ending in ("", "a", "A", "7", "A7", "7A", "\u00e9", "\U0001f600"):
        for length in (0, 200, 250, 251, 252, 253, 254, 255, 256, 257, 258, 300, 700):
            texts.append("ABCDEFGH 1234567 B07XJ8C8F5 " + "x" * length + ending)
            texts.append("ABCDEFGH 1234567 " + "\U0001f600 " * (length // 2) + "HIJKLMNO" + ending)
    got = one(texts, lambda c: text.strip_part_numbers(text.collapse_whitespace(c)))
    assert got == [without_codes(t) for t in texts]


def test_whitespace_equals_python(one):
    every = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert set(every) == set(text.SPACE_CHARACTERS)
    values = [f"{every}a{every}b c{every}", every, "plain", "one two", " \u00a0 a\u2003b  c\td "]
    assert one(values, text.collapse_whitespace) == [" ".join(v.split()) for v in values]
    assert one(values, text.strip_whitespace) == [v.strip() for v in values]
    assert one(values, text.words) == [v.split() for v in values]


def python_details(value):
    try:
        parsed = json.loads(value or "{}")
    except json.JSONDecodeError:
        parsed = {}
    return parsed if isinstance(parsed, dict) else {}


DETAILS = [
    "", None, "{}", "{broken", '{"a": 1} trailing', '{"a": 1', "[1]", "null", '"text"', "{'a': 1}", '{"a": 1,}',
    '{"Item Weight": "1.5 pounds", "Brand": "X"}', '{"a":{"b":[1,2,{"c":null}]},"d":true}', '{"a" : "x, y: {z}"}',
    '{"quote": "say \\"hi\\"", "back": "c:\\\\d", "both": "\\\\\\""}', '{"caf\u00e9": "\u00fc\u4e2d\U0001f600"}', '{"e": "\\u00E9\\/x"}',
    '{"tab": "a\\tb\\n", "del": "\x7f"}', '  {"a": 2}\n', '{"n": null, "f": 1.5, "i": -3}', '{"a": "raw\ttab"}', '{"a":1}]',
]


def test_details_map(one):
    got = one(DETAILS, details.parse_details)
    assert [set(m) for m in got] == [set(python_details(v)) for v in DETAILS]
    assert one(['{"a": "1", "b": "2", "a": "3"}'], details.parse_details) == [{"a": "3", "b": "2"}]


def test_details_text(one):
    got = one(DETAILS, lambda c: details.serialize_details(F.coalesce(c, F.lit(""))))
    assert got == [json.dumps(python_details(v)) for v in DETAILS]


def test_details_text_survives_long_values(one):
    value = json.dumps({"a": "x" * 200_000, "b": '"' * 5_000, "c": "\u00e9" * 5_000})
    assert one([value], details.serialize_details) == [value]


PIECE = re.compile(r"\s*(?:\w+|[^\w\s])")


def test_token_pieces_equal_python(one):
    values = TEXTS + ["don't  stop.", "caf\u00e9 na\u00efve \u00b2", "\n lead", "trail \n"]
    assert one(values, tokens.token_pieces) == [PIECE.findall(v) for v in values]


@pytest.mark.parametrize("count", [97, 98, 99])
def test_truncation_budget(one, count):
    value = "  " + " ".join(f"w{i}" for i in range(count)) + "  "
    cut = one([value], tokens.truncate_tokens)[0]
    assert cut == (value if count <= 98 else "  " + " ".join(f"w{i}" for i in range(98)))
    assert one([cut], tokens.count_tokens) == [min(count, 98)]


def test_plugged_encoder(one):
    def load():
        class Characters:
            def encode(self, value):
                return [ord(c) for c in value]

            def decode(self, ids):
                return "".join(map(chr, ids))

        return Characters()

    encoder = tokens.EncoderTokens(load)
    values = ["abc", "abcdefgh", ""]
    assert one(values, lambda c: tokens.count_tokens(c, encoder)) == [3, 8, 0]
    assert one(values, lambda c: tokens.truncate_tokens(c, 4, encoder)) == ["abc", "abcd", ""]


def test_prompts(one):
    prompt = one(["  a mixer\n"], prompts.inference_prompt)[0]
    assert prompt == "What does this cost to the nearest dollar?\n\na mixer\n\nPrice is $"
    full = one(["  a mixer\n"], lambda c: prompts.training_prompt(c, F.lit(2.5)))[0]
    assert full == prompt + "2.00"
    assert one([full], prompts.mask_answer) == [prompt + "[answer hidden]"]


def test_summary_round_trip(spark):
    rows = [("T", "C", "B", "D: x", "F"), ("T", "", None, "D", "")]
    df = spark.createDataFrame(rows, "title string, category string, brand string, description string, details string")
    summary = df.select(prompts.format_summary(*[F.col(c) for c in df.columns]).alias("s"))
    assert [r.s for r in summary.collect()] == ["Title: T\nCategory: C\nBrand: B\nDescription: D: x\nDetails: F", "Title: T\nDescription: D"]
    back = summary.select(prompts.parse_summary(F.col("s")).alias("p")).select("p.*").collect()
    assert [tuple(r) for r in back] == [rows[0], ("T", None, None, "D", None)]
    lines = [("Title: T\nof two lines\nDescription: a\n\nBrandless: b\nDetails: last\nline", ("T\nof two lines", None, None, "a\n\nBrandless: b", "last\nline")),
             ("no label", (None,) * 5), (None, (None,) * 5), ("Brand: \nDetails: x", (None, None, None, None, "x"))]
    read = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(lines)], "i int, s string").select("i", prompts.parse_summary(F.col("s")).alias("p"))
    assert [tuple(r)[1:] for r in read.select("i", "p.*").orderBy("i").collect()] == [want for _, want in lines]
    long = spark.createDataFrame([("Title: " + "x" * 40 + "\nBrand: y",)], "s string")
    assert long.select(prompts.summary_title(F.col("s"))).first()[0] == "x" * 28


def test_deals(one):
    assert one([0.0, -1.0, 100.0, None], lambda c: deals.discount(c, F.lit(60.0)), "double") == [0.0, 0.0, 0.4, 0.0]
    assert one([0.4, 0.3999], deals.alert_label, "double") == ["alert", "skip"]
    titles = ["Stand mixer for $349", "$50 OFF any TV", "Deal ends tonight",
              "Free shipping on orders over $25", "TV for $1,299.99", "$50 off a TV for $300", "Widget for free"]
    assert one(titles, deals.title_price) == [349.0, None, None, None, 1299.99, None, None]


def test_price_interval(spark):
    low, high = numbers.price_interval(F.lit(20.0), F.lit(58.74))
    assert tuple(spark.range(1).select(low, high).first()) == pytest.approx((0.0, 78.74))


def test_hash_matches_its_definition(one):
    import hashlib

    keys = [0, 1, 42, 10**12, -5]
    want = [int(hashlib.md5(f"42:{k}".encode()).hexdigest()[:13], 16) for k in keys]
    assert one(keys, lambda c: hashing.hash52(42, c), "bigint") == want
    assert all(0 < u < 1 for u in one(keys, lambda c: hashing.hash_uniform(42, c), "bigint"))
