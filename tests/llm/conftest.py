import random

import pytest

#: Names that operators use inside, as columns of the input.
CLASHING = "row string, fp string, id string, version string, n_words string, kept string, shard string, failed string, host string"


@pytest.fixture
def documents(spark):
    """Documents with null ids, texts and sources, empty and long texts, ties and repeated rows, and odd columns."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ünïcode", "###", "the\x0bthe"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = prose(60)
    texts = [
        None, "", " \n\t ", "one", prose(25), prose(25), passage, f"{prose(15)} {passage} {prose(15)}", passage.upper(),
        passage, f"{passage}\n{passage}", "again " * 200, prose(6000), "x" * 30_000, "a b c\x1cd",
    ]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, passage, None, None, None), (None, None, None, None, None), (4, texts[4], "en", "s1", 1), (4, prose(30), "en", "s1", 1)]
    rows = [(*r, *(["clash"] * 9)) for r in rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
