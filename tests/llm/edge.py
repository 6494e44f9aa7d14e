"""Documents with every awkward shape the operators must take."""

from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, tok string, n long, id long, key string, uid long"

LONG = "alpha beta gamma delta " * 4000


def awkward(spark: SparkSession):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "de", None), (4, "one", "en", "b"), (5, "one", "en", "b"),
        (6, "Two words", None, None), (7, "two WORDS", "de", "a"), (8, LONG, "en", "b"), (9, LONG, "en", "b"), (9, LONG, "en", "b"),
        (None, "no id here at all", "fr", "c"), (None, None, None, None), (12, "x" * 20000, "en", "c"),
        (13, "▁ literal mark ▁ and é中\U0001F600 \x01\x02\x00 tab\there", "es", "c"),
        (14, "   leading  and   double  spaces ", "en", "a"), (15, "<|endoftext|> special", "en", "a"),
        (16, "123 456 !!!", "en", "a"), (-3, "negative id", "en", "a"),
    ]
    full = [(i, t, lang, s, len(t) if t else None, 7, "tok", 8, 9, "k", 10) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark: SparkSession):
    return spark.createDataFrame([], SCHEMA)
