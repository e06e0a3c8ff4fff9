"""Documents with every awkward case, and a frame maker."""

import re

from pyspark.sql import types as T

# names that the operators use inside; a table may have them as columns of its own
CLASHES = ("id", "fp", "sha", "key", "row", "points", "copies", "d", "m", "f", "c", "n_words", "kept", "component_id",
           "key_of_row", "chosen_of_row", "repetition_of_row", "form_of_row", "cell_of_row", "round_trip", "found")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       *[T.StructField(c, T.StringType()) for c in CLASHES]])

PROSE = ("The quick brown fox jumps over the lazy dog while seven other animals watch from the green hill and "
         "wonder why anyone would run so fast on such a warm and quiet afternoon in early summer")
TEXTS = [
    (1, PROSE), (2, PROSE + " "), (3, PROSE.replace(" ", "\n")), (4, PROSE + " indeed"), (5, None), (6, ""),
    (7, " \t\n\x0b\x0c\r"), (8, "one"), (9, "one two"), (10, "été à la plage ß ﬁ 日本語 🎉 " * 9),
    (11, ("spam and eggs for everyone here today " * 40).strip()), (12, "A line\nA line\nA line\n" + PROSE),
    (13, " ".join(f"word{i % 997}" for i in range(40_000))), (14, "x" * 100_000),
    (1, PROSE), (1, PROSE),                       # whole rows again
    (15, PROSE), (15, PROSE + "  "),              # one id, equal texts of two lengths
    (None, PROSE), (None, PROSE), (None, "no id but text"), (None, None),
    (16, "| a | b | c |\n" * 20), (17, "### $$$ %%% " * 10 + PROSE), (18, "THE MEAT IS SO CHEAP TODAY " * 5),
    (19, "\x00 \x1c\x1d\x85 　 odd spaces are letters"), (20, "nbsp is no space"),
]


def documents(spark, rows=None):
    rows = TEXTS if rows is None else rows
    full = [(i, t, None if n % 5 == 4 else "en", None if n % 7 == 6 else f"s{n % 2}", None if n % 3 == 2 else len(t or ""),
             *[f"{c}-{n}" if n % 2 else None for c in CLASHES]) for n, (i, t) in enumerate(rows)]
    # the repeated rows are equal in all columns
    first = {}
    full = [first.setdefault((r[0], r[1]), r) if r[0] == 1 else r for r in full]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
