"""Small fixtures of the operator tests: edge rows, an empty table, and the smallest generated tables."""

import random

SF = "/root/testdata/sf0.001"
#: names that operators use inside, as further columns of the input
CLASHING = ["row", "t", "d", "h", "k", "key", "chunk", "gone", "kept", "size", "n", "score", "doc", "id", "node", "root",
            "stats", "pass", "bucket", "part", "n_lines", "passes", "target", "taken", "seq", "extra"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(n))


def edge_texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source): nulls, empties, a very long text, ties, repeated rows, near copies, shared lines."""
    base = words(120, 1)
    near = base.split()
    near[60] = "changed"
    long_line = "This line is found in many documents, word for word."
    passage = words(40, 5)
    return [
        (None, None, None), (None, "an id is missing here " + passage, "a"), (0, "", "a"), (1, None, "b"),
        (2, base, "b"), (3, base, "c"), (3, base, "c"), (4, " ".join(near), None),
        (5, long_line + "\nown line of document five\n\n  " + long_line.upper() + "\t", "a"),
        (6, "\n" + long_line + "\nshort\nshort\n", "a"), (7, "short\n" + words(300, 2) + " " + passage, "d"),
        (8, passage + " " + words(80, 3), "d"), (9, words(6000, 4) + " " + passage + "\n" + words(20000, 6), "d"),
        (10, "one two three", "e"), (11, "ONE  two\nthree", "e"), (12, "x", "e"), (13, "é ß 日本 é" * 40, "f"),
        (14, "a" * 500, "f"), (15, "a" * 350 + "b" + "a" * 350, "f"), (16, "    \n\t ", "f"),
        (17, "<|endoftext|> don't 12 3.5\x85x y  z ", "f"), (9_000_000_000, base + " and more", "a"),
    ]


def edges(spark):
    rows = [(i, t, "en", s, None if t is None else len(t), *["clash"] * len(CLASHING)) for i, t, s in edge_texts()]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def generated(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    """(doc_id, text) of every row, ascending, null ids first, one id's rows by text (null text first)."""
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
