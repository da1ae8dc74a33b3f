import itertools

import pytest

#: A text that nothing is wrong with: 120 different words in sentences of ten.
PROSE = " ".join(("".join(w).capitalize() if i % 10 == 0 else "".join(w)) + ("." if i % 10 == 9 else "") for i, w in enumerate(itertools.islice(itertools.product("bdgklm", ("ara", "eno", "ili"), "nrst", "aeo"), 120)))

#: Rows that every text operator has to stand: nulls, no text, no words, ties, repeats, a very long text, odd characters.
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\x0c\r ", None), (4, "word", "b"), (5, "two words", "b"),
    (6, "same text here\nsame text here\n\nsame text here", "c"), (6, "same text here\nsame text here\n\nsame text here", "c"),
    (None, "a document without an id", "c"), (8, "x" * 60_000, None), (9, "the quick brown fox " * 20_000, "a"),
    (10, "Ünïcödé　text é\xa0and\x1cmore \U0001f600 #tag $5 <b> a|b", "d"), (11, "it's <|endoftext|> we'll  see\n\n 12345 \t", "d"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with extra columns whose names clash with those that operators add."""
    rows = [(i, t, "en", s, None if t is None else len(t), "own", "own", 7) for i, t, s in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string, bits string, ids int").repartition(3)


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Writes tables to a new folder and gives its path, to run queries over them."""

    def write(**frames):
        folder = tmp_path_factory.mktemp("tables")
        for name, df in frames.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write


@pytest.fixture(scope="session")
def prose():
    return PROSE
