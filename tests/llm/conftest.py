import re

import pytest

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(seed: int, n: int) -> str:
    """n invented words, different for every seed."""
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append("".join("bcdfglmnprst"[x >> s & 7] + "aeiou"[(x >> s + 3) % 5] for s in (20, 30, 40)))
    return " ".join(out)


#: Nulls in every column, empty, blank and very long texts, repeated rows and ties.
ODD = [
    (1, prose(1, 60) + ".\n" + prose(2, 30), "en", "a", 1),
    (1, prose(1, 60) + ".\n" + prose(2, 30), "en", "a", 1),
    (2, None, "en", "b", None),
    (3, "", None, "b", 0),
    (4, " \n\t\n ", "de", None, 5),
    (None, prose(3, 40), "fr", "c", 1),
    (None, None, None, None, None),
    (5, "--- ... !!! 123", "en", "d", 1),
    (6, "Ünïcödé 日本語 🙂 é �", "de", "d", 1),
    (7, prose(4, 30_000), "en", "e", 1),
    (8, "x" * 50_000, "fr", "e", 1),
    (9, "one", "en", "f", 1),
    (9, "two words", "en", "f", 1),
    (10, prose(1, 60) + ".\n" + prose(2, 30), "fr", None, 1),
]
#: Columns that operators add or use themselves.
CLASHES = (
    "n_words n_hit n_items items_sha256 contaminated token_ids n_tokens decoded round_trip lang_pred score section start_char end_char n_crossing"
    " n_lines n_removed n_chars_removed line site h1 h2 fingerprint n_shingles class_id class_size node label key band times n words sentence_ids licenses"
    " n_sentences n_known train_tokens base_score held_out host path"
    " keep_id group_size kept text_sha256 level name labels pos _row n_runs runs collapsed start length period"
).split()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
