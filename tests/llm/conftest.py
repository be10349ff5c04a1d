import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def passage(seed, n):
    """n words that follow from the seed."""
    out, x = [], seed * 7919 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x >> 16 & 15] + WORDS[x >> 20 & 7])
    return " ".join(out)


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows], COLUMNS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in any column, empty and blank texts, repeated rows, one word, and a long text."""
    return [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "word"), (5, passage(5, 30)), (5, passage(5, 30)), (None, passage(6, 30)), (None, None), (7, passage(7, 20000)), (8, "é ü 漢字 \x00 𝄞")]
