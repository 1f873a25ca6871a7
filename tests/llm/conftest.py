import pytest
import public_tokenizers


@pytest.fixture(scope="session")
def path_of():
    return public_tokenizers.path


@pytest.fixture
def documents(spark):
    """A table of texts with every odd case, and columns whose names the operators use."""
    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "x", 0, None) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, kind int, label int")
    return make


WORDS = "the of and to in that was it for on are as with his they at be this from have or by one had not".split()


def prose(seed: int, n: int) -> str:
    import random
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(200)) for _ in range(n))
