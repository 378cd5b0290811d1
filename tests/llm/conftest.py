import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, shard int, kept boolean, fp long, size long, "
          "tokens long, epochs int, cell int, word string, band int, node long, units string, epoch long, domain string")


def prose(seed, words, vocabulary=4000):
    """Made-up prose without shared passages."""
    rng = random.Random(seed)
    out = []
    for i in range(words):
        out.append(f"w{rng.randrange(vocabulary)}x{seed}" if rng.random() < 0.5 else rng.choice("the of and to in a is".split()))
        if i % 9 == 8:
            out[-1] += ".\n" if rng.random() < 0.3 else "."
    return " ".join(out)


@pytest.fixture
def documents(spark):
    """Rows of ``documents`` with extra columns whose names the operators use themselves."""

    def make(rows):
        full = [(i, text, lang, source, len(text or ""), 1, True, 2, 3, 4, 5, 6, "x", 7, 8, "y", 9, "z")
                for i, text, lang, source in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def awkward(documents):
    """Nulls in every column, empty, blank, tiny and very long texts, ties and repeated rows."""
    same = prose(1, 80)
    return documents([
        (1, None, "en", "src0"), (2, "", None, None), (3, " \t\n ", "fr", "odd"), (None, prose(2, 70), "en", "src1"),
        (None, None, None, None), (4, same, "de", "src2"), (4, same, "de", "src2"), (5, same, "de", "src3"),
        (6, prose(3, 60_000), "es", "src0"), (7, "word", "en", "src0"), (8, "Ünï ço de 漢字 \x00 done", "en", "src0"),
        (9, "1234 5678 !!! ###", "en", None)])
