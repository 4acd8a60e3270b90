import pytest


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with nulls, blanks, ties, repeated rows, a long text and columns with clashing names."""
    base = "One two three four five. Six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen."
    rows = [(i, f"{base} Variant w{i} x{i}.", "en", "s", 1) for i in range(6)]
    rows += [(10, base, "en", "s", 1), (11, base, "en", "s", 1), (11, base, "en", "s", 1), (12, None, None, None, None),
             (13, "", "fr", "s", 0), (14, " \n\t ", None, "s", 4), (None, "Le la les du des et pour dans avec.", "fr", "s", 3),
             (15, "word " * 60_000, "en", "s", 9), (16, "Le la les du des et une pour dans.", "fr", "s", 2), (17, "12 345", "en", "s", 2)]
    cols = "doc_id long, text string, lang string, source string, n_chars int"
    extra = ", rank int, piece int, h long, n long, label string, place int, score double, start long, chunk int, row int, w int"
    return spark.createDataFrame([(*r, *([7] * 4), "x", 7, 0.5, 7, 7, 7, 7) for r in rows], cols + extra)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")
