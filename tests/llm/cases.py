"""Documents with every awkward case, and helpers of the brute-force versions."""

import hashlib
import random

SMALL = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def lower_a(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return (text or "").encode().split()


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


# Columns that clash with names the operators use inside.
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, body string, h string, kept boolean, pos int, key long, taken long, size long, target double, first long, start int"


def as_docs(spark, rows):
    """Rows of (doc_id, text, lang, source) with the clashing columns filled in."""
    filled = [(i, t, lang, source, len(t or ""), "x", "y", False, 1, 2, 3, 4, 5.0, 6, 7) for i, t, lang, source in rows]
    return spark.createDataFrame(filled, DOC_SCHEMA)


def messy_rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "naïve", "ß", "X Y", "日本"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, line = prose(40), "A line that many documents share"
    long = "\n".join(prose(300) for _ in range(40))
    rows = [
        (3, None, "en", "a"),
        (1, "", None, None),
        (2, " \t\n ", "en", "b"),
        (4, "one two", "en", "a"),
        (5, "ONE two", "en", "a"),
        (6, long, "de", "hot"),
        (7, long + " tail", "de", "hot"),
        (8, prose(30) + " " + passage + " " + prose(30), "en", "hot"),
        (9, passage, "en", None),
        (10, prose(5) + "\n" + passage + "\n" + prose(3), None, "hot"),
        (11, f"{line}\nown words here 11\n  {line.upper()}  \nshort\nshort", "en", "a"),
        (12, f"\t{line}\nown words here 12\nshort", "en", "a"),
        (12, f"\t{line}\nown words here 12\nshort", "en", "a"),
        (None, f"{line}\nno id", "en", "b"),
        (None, passage, "en", "b"),
        (13, "a" * 50_000, "en", "b"),
        (14, "!!! 123 ...", "en", "b"),
    ]
    for i in range(20, 60):
        rows.append((i, long if i % 4 == 0 else prose(rng.randint(1, 80)), rng.choice(["en", "de"]), "hot"))
    base = prose(120).split()
    for i in range(60, 80):  # near copies
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, " ".join(w), "en", "near"))
    return rows


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def order(i):
    """Null ids first."""
    return (i is not None, i or 0)
