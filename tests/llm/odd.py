"""Rows that every operator has to take: nulls, empty and long texts, repeated rows and ids, clashing names."""

CLASHING = ["key", "fp", "hash", "row", "p", "found", "score", "text_", "starts", "whole", "packed", "words", "fits", "n", "at", "lang_pred", "n_tokens", "doc"]
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(20_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog again and again."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, LONG),
    (6, "The quick brown fox jumps over the lazy dog again and again."),
    (6, "The quick brown fox jumps over the lazy dog again and again."),
    (6, "another text of the same id"),
    (None, "no id"),
    (None, None),
    (7, "▁a  b　c 中文字 \U0001f600 <s></s><|endoftext|> \u0000 é ﬁ 1234567 !!??"),
    (8, "x" * 30_000),
]


def frame(spark, texts=TEXTS):
    extra = ", ".join(f"{c} string" for c in CLASHING)
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *CLASHING) for i, t in texts], schema)


def empty(spark):
    return frame(spark).limit(0)
