"""Small tables with the awkward cases that every operator must take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 3000


def frame(spark, rows, kinds=DOCS):
    return spark.createDataFrame(rows, kinds)


def docs(spark, texts, lang="en", source="s"):
    """Documents numbered from 0."""
    return frame(spark, [(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)])


def awkward(spark):
    """Null key, null and empty text, a repeated row, a tie, a very long text, null source and language."""
    rows = [
        (1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (2, None, None, None, 0), (3, "", "en", "s", 0), (None, "a b", "en", "t", 3),
        (None, None, "en", None, None), (4, LONG, "en", "s", len(LONG)), (5, "é\U0001f642 x\ty\n\nz", "fr", "t", 9), (6, " \n ", "en", "s", 3)]
    return frame(spark, rows)


def with_clashes(df, *names):
    """df with extra columns of names that an operator may use itself."""
    for name in names:
        if name not in df.columns:
            df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df
