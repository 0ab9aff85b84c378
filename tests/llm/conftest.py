import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, v long, size long, h long, bucket string, score double, key int"
WORDS = "the of and is in to a on alpha beta gamma delta river stone cloud green quiet seven under over light paper window".split()


def prose(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (f"{r.randrange(400)}" if r.random() < 0.4 else "") for _ in range(n))


def edge_texts() -> list[str | None]:
    long = prose(1, 30_000)
    base = prose(2, 120)
    words = base.split()
    return [None, "", "   \n\t ", "one", "one two three four", long, base, base, " ".join(words[:60] + ["changed"] + words[60:]),
            prose(3, 50) + "\n" + " ".join(words[20:80]) + "\n" + prose(4, 50), "ther " * 100, "a b " * 60, prose(5, 35), "%% ## !!",
            "é ü 漢字 ½ \x1c x y", prose(6, 200) + " <|endoftext|> " + prose(7, 20)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and names the operators use inside."""
    rows = [(i, t, "en" if i % 3 else None, ["s1", "s2", None][i % 3], None if t is None else len(t), 7, 7, 7, "b", 0.5, 1) for i, t in enumerate(edge_texts())]
    rows += [rows[6], rows[6], (None, "no id here " * 5, "en", "s1", None, 1, 1, 1, None, None, None), (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
