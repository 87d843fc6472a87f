import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text) or longer rows, with columns whose names clash with internal ones."""
    def f(rows, clash=True):
        rows = [(*r, *[None] * (5 - len(r))) for r in rows]
        df = spark.createDataFrame(rows, SCHEMA)
        if clash:
            from pyspark.sql import functions as F

            names = ("size", "shard", "slot", "kept", "_bucket", "_text", "ref", "n", "source_size", "target", "epochs", "locator", "stratum", "score", "ids", "part", "nth", "start", "root", "sign")
            df = df.withColumns({c: F.lit("x") for c in names})
        return df

    return f


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = text(30_000)
    same = text(120)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, long, "en", "s1"), (5, same, "en", "s1"), (6, same, "en", "s2"), (6, same, "en", "s2"), (7, same + " tail", None, None), (None, "null id", "en", "s1"), (8, "four words are here", "de", "s3"), (9, "four words are here", "de", "s3"), (10, "x" * 50_000, "en", "s1"), (11, "Ünïcode ﬁ 漢字 🙂 ▁ İ 'll <|endoftext|> \x1c", "fr", "s2")]
    return rows + [(100 + i, text(rng.randint(1, 300)), rng.choice(["en", "de", "fr", None]), rng.choice(["s1", "s1", "s2", None])) for i in range(150)]
