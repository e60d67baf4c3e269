import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base(n: int, start: int = 0) -> str:
    """n different words."""
    return " ".join(f"w{i}" for i in range(start, start + n))


#: Nulls in every column, empty and long texts, ties, repeated rows, white space of all kinds, non-ASCII.
HARD = [
    (1, base(40), "en", "a", 1),
    (2, base(40), "en", "a", 1),
    (2, base(40), "en", "a", 1),
    (3, base(39) + " x", "en", None, 1),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \t\n\x0b\x0c\r ", "en", "b", 3),
    (7, "one", "de", "b", 3),
    (8, "One two É ñ x", "fr", "é", 3),
    (9, base(30) + "\n" + base(30) + "  " + base(30), "en", "a", 9),
    (10, base(6000, 100), "en", "a", 9),
    (11, "y " + base(5990, 104).upper(), "en", "c", 9),
    (12, "n1ce IDIOT!!! you", "en", "c", 9),
    (None, base(40), "en", "a", 1),
]


def rows(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
