"""Rows that every operator must stand: nulls, empty and long texts, ties, repeats, clashing extra columns."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, id int, label int, key int"


def edge_docs(spark, extra=()):
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "", 0),
        (3, "a b  c\n\nd\té", "en", "s", 10),
        (4, "a b  c\n\nd\té", "en", "s", 10),
        (4, "a b  c\n\nd\té", "en", "s", 10),
        (None, "null id <|endoftext|> text", None, "s", 3),
        (7, "word " * 3000, "en", "t", 15000),
        (8, "!!! ... \U0001f600", "en", "t", 9),
        *extra,
    ]
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
