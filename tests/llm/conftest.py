import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, copies, repeated rows, a missing id, and columns named like those the operators use."""
    long = " ".join(f"w{i % 977} the" for i in range(20_000))
    texts = [
        (1, "Alpha beta gamma"), (2, "alpha BETA gamma"), (3, None), (4, ""), (5, "É alpha"), (6, "é alpha"), (7, long), (8, long + " end"),
        (9, "x"), (9, "x"), (10, "  \t\n "), (None, "alpha beta gamma"), (None, "nobody"), (11, "a\u0000b it's  we'll\n\n12 ½ 中文!! 🙂"),
        (12, " ".join(f"p{i}" for i in range(40))), (13, "start " + " ".join(f"p{i}" for i in range(40)) + " stop"),
    ]
    rows = [(i, t, "en" if n % 3 else None, f"src{n % 2}", len(t) if t else None, n, "k", 1.5, "r") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, key int, edge string, place double, row string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
