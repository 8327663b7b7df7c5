"""Small tables with every kind of row that the operators must bear."""

import random

#: Extra columns whose names the operators use inside.
CLASHES = "_text term fp _doc _gone _row text_key shard size word row _src digest".split()
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} int" for c in CLASHES)


def words(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdeéß") for _ in range(draw.randint(1, 5))) for _ in range(n)]


def prose(seed: int, n: int, per_line: int = 9) -> str:
    found = words(seed, n)
    return "\n".join(" ".join(found[i:i + per_line]) for i in range(0, n, per_line))


SHARED = prose(100, 80)


def texts() -> list[tuple[int | None, str | None, str | None, str | None]]:
    """(doc_id, text, lang, source)"""
    long_text = prose(7, 20_000)
    near = prose(1, 200).split(" ")
    near[20] = "changed"
    return [
        (1, prose(1, 200), "en", "a"), (2, prose(2, 120), "en", "a"), (3, prose(1, 200), "fr", "b"), (4, " ".join(near), "en", "c"),
        (5, None, "en", "a"), (6, "", "en", None), (7, " \t\n \v", None, "b"), (8, long_text, "de", "a"), (9, "one", "en", "a"), (10, "One TWO", "en", None),
        (11, prose(3, 60) + "\n" + SHARED + "\n" + prose(4, 30), "en", "b"), (12, prose(5, 33) + "\n" + SHARED + "\n" + prose(6, 70), "en", "b"),
        (13, SHARED, "en", "a"), (13, SHARED, "en", "a"), (14, prose(8, 90), "en", "a"), (14, prose(9, 90), "en", "b"),
        (None, prose(1, 200), "en", "a"), (None, None, None, None), (None, prose(10, 70), "en", "c"),
        (15, "x" * 30_000, "en", "a"), (16, "éÉ ßſ K ​ zero", "en", "c"), (17, "a b c " * 60, "en", "c"), (18, "a b c " * 60, "en", "c"),
        (19, prose(2, 120).upper(), "en", "a"), (20, "same line\n" * 40, "en", "a"), (21, "same line\n" * 40 + "end", "en", "a"), (-3, SHARED + " tail", "en", "a"),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, lang, source, None if t is None else len(t), *range(len(CLASHES))) for i, t, lang, source in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()
