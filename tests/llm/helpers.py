"""Small tables for the operators: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named as operators name theirs.
CLASH = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, k long, h long, body string, digest string, topic string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(words))


def tricky_rows():
    base, long_text = prose(1, 120), prose(2, 20_000)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base), (2, base.upper()), (3, " ".join(near)), (4, None), (5, ""), (6, "   \n\t "), (7, "one"), (8, "two words"),
        (9, long_text), (10, long_text + " tail"), (11, prose(3, 90) + "\n" + base), (12, "é日本 " * 40), (12, "é日本 " * 40),
        (13, "a" * 1500), (14, "<|endoftext|> it's I'll  we've\n\n x" * 9), (None, base), (None, None), (None, prose(5, 80)),
        (15, prose(6, 80)), (16, prose(6, 80)), (17, "\x00odd\x1fcontrol chars\xa0here " * 5),
    ]
    return [(i, t, None if i == 3 else "en" if (i or 0) % 2 else "de", None if i == 5 else f"s{(i or 0) % 3}", len(t or "")) for i, t in rows]


def tricky(spark):
    return spark.createDataFrame(tricky_rows(), SCHEMA)


def clashing(spark):
    rows = [(*r, 0.5, True, 1, 2, "body", "digest", "topic") for r in tricky_rows()]
    return spark.createDataFrame(rows, CLASH)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def marks(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def lower_az(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
