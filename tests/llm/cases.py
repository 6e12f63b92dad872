"""Awkward inputs that every operator and stage must stand."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word and another word. " * 9000 + "\n" + "line of it\n" * 3000


def awkward_documents(spark, *clashing):
    """Null ids, texts, languages and sources, empty, blank and very long texts, repeated rows,
    with further columns of clashing names."""
    rows = [
        (1, "One plain text with a few words in it.", "en", "a", 5), (1, "One plain text with a few words in it.", "en", "a", 5),
        (2, None, "en", "a", None), (3, "", None, None, 0), (4, "   \n\t ", "de", "b", 6),
        (None, "A text without an id, of some length.", "fr", "b", 7), (None, None, None, None, None),
        (5, LONG, "en", "a", 1), (6, "%%% 123 ***", "es", "c", 3), (7, "Zażółć gęślą jaźń 日本語 \U0001f600", None, "c", 9),
        (1, "Another text under the same id.", "en", "a", 2),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    for name in clashing:
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def empty(df):
    return df.limit(0)
