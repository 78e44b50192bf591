import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
          "n_tokens long, ids array<int>, fp long, measures string, toxic boolean, part int, "
          "label int, start int, kept boolean, first long, winner long, bad int")

WORDS = ("alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november "
         "oscar papa quebec romeo sierra tango uniform victor whiskey xray yankee zulu").split()


def prose(seed: int, words: int) -> str:
    """Words without repeated windows."""
    return " ".join(f"{WORDS[(seed * 7 + i * (3 + i // 26)) % 26]}{seed * 31 + i}"
                    for i in range(words))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeats, clashing columns."""
    rows = [
        (1, prose(1, 80), "en", "a"), (2, prose(1, 80), "en", "a"), (2, prose(1, 80), "en", "a"),
        (3, "", "en", "a"), (4, None, None, None), (None, prose(2, 60), "en", None),
        (None, None, None, "b"), (5, " \t\r\n ", "de", "b"), (6, "one", "de", "b"),
        (7, "ÀÉ ñandú straße… “quoted” 中文 😀 it's <|endoftext|> x y z", "fr", "b"),
        (8, "spam " * 300 + "\n" + "spam " * 300, "en", "a"),
        (9, "x" * 70_000 + " " * 500 + prose(3, 30_000), "en", "a"),
        (10, "word*** " * 80, "en", "a"), (7, prose(4, 100), "fr", "b"),
    ]
    full = [(d, t, la, s, len(t) if t else None, 1.0, 5, [1], 7, "m", True, 3, 1, 2, False, 1, 1, 0)
            for d, t, la, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(frame, *columns):
    """Rows as sorted tuples, nulls included."""
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
