"""Awkward rows that every operator must take, and how results are read."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["row", "n", "hash", "kept", "score", "chunk", "keeper", "entity", "term", "rank", "value", "component", "band", "word"]


def awkward():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"wort{i % 977} is{i % 31}" for i in range(40_000))
    return [
        (1, "Plain words stand here, in one short sentence. And one more.", "en", "a", 5),
        (2, "Plain words stand here, in one short sentence. And one more.", "en", "b", 5),
        (2, "Plain words stand here, in one short sentence. And one more.", "en", "b", 5),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, " \n\t ", "en", "a", 3),
        (None, "A text without an id.", "en", "c", 1),
        (6, long_text, "en", "a", len(long_text)),
        (7, long_text, "en", "d", len(long_text)),
        (8, "x" * 300_000, "en", "a", 300_000),
        (9, "Ünïcödé wörds — 漢字 and 😀 emoji, twice: 😀.", "de", "a", 1),
        (10, "one", "en", "a", 3),
    ]


def with_clashes(docs):
    return docs.withColumns({c: F.lit("clash") for c in CLASHING if c not in docs.columns})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
