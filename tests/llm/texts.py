"""Small inputs for the text operators."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

NASTY = [
    None,
    "",
    "   ",
    "\n\n\t ",
    "a",
    "don't  stop,  we'll\tgo!! 12345 été 你好世界 \U0001f600\U0001f600",
    "x" * 3000,
    "ab" * 700 + " " + "é" * 500,
    "word " * 4000,
    " leading and trailing ",
    "  nbsp   line",
    "'s't're've'm'll'd ''' \"\"",
]


def documents(spark, texts, source=None):
    rows = [(i, t, "en", None if source is None else source(i), None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)
