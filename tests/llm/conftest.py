import os

import pytest

DATA = os.environ.get("WAKELINE_TESTDATA", "/root/testdata")

#: Texts that break things: null, empty, blank, odd white space, ties, repeats, one long text.
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "word",
    "a b c d e",
    "a b c d e",
    "A b C d e f\nA b C d e f\n\nx",
    "naïve Œuvre ÀÉ space　wide  two   three \n b\x1c",
    "it's <|endoftext|> here\t\tdon't",
    "one two three four five six seven eight nine ten " * 400,
    "日本語 テキスト 🙂 é́",
    "x" * 5000,
]


def thue_morse(n):
    text = "a"
    for _ in range(n):
        text += text.translate(str.maketrans("ab", "ba"))
    return text


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd texts, null and repeated ids, and columns whose names clash with derived ones."""
    rows = [(i, t, "en", "s", None, i, "q") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "a null id", None, None, 1, 0, "q"), (3, "word", "de", "", 2, 0, "q"), (-7, "negative id", "en", "s", 3, 0, "q")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, start long, size string")


@pytest.fixture(scope="session")
def sample(spark):
    folder = f"{DATA}/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables absent")
    return spark.read.parquet(f"{folder}/documents.parquet")
