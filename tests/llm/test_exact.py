"""Exact groups against plain comparison of texts."""

import hashlib
import re

import pytest
from conftest import ODD, prose

from barloom.llm import exact
from barloom.llm.common import Scratch

SPACE = re.compile(r"[\x20\x09-\x0D]")


def plain_groups(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(SPACE.sub("", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for text, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), hashlib.sha256(text.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


def check(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = exact.exact_groups(docs, **how).collect()
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == plain_groups(rows)
    assert sum(r["kept"] for r in got) == len({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    return got


@pytest.mark.parametrize("size", [3, exact.BLOCK])
def test_groups_equal_plain_comparison(spark, size):
    rows = [(x, t) for x, t, *_ in ODD if len(t or "") < 100 or size == exact.BLOCK]
    for i in range(12):
        rows += [(100 + i, "ab" * i), (200 + i, "a b" * i + "\n"), (300 + i, "ba" * i), (400 + i, "a" * i), (500 + i, "é " * i)]
    check(spark, rows, size=size)


def test_one_differing_byte_at_any_place(spark):
    text = prose(1, 16)
    rows = [(0, text), (1, text.replace(" ", "\t\t"))]
    rows += [(10 + i, text[:i] + "#" + text[i + 1 :]) for i in range(0, len(text), 7)]
    got = check(spark, rows, size=16)
    assert {r["doc_id"]: r["keep_id"] for r in got}[0] == 1


def test_a_hot_group_and_a_long_text(spark):
    long = prose(2, 40_000)
    rows = [(i, "the same\ntext") for i in range(3000)] + [(5000, long), (5001, long.replace(" ", "  ")), (5002, long + "x")]
    got = {r["doc_id"]: r for r in check(spark, rows)}
    assert got[7]["group_size"] == 3000 and got[5000]["keep_id"] == 5001 and got[5002]["group_size"] == 1


def test_blocks_under_a_shared_label_are_labelled_anew(spark):
    """Equal labels never make texts equal."""
    def poor(block, seed):
        return b"same" if seed < 2 else exact.label_of(block, seed)

    check(spark, [(1, "aaaabbbb"), (2, "aaaacccc"), (3, "bbbbaaaa"), (4, "aaaa bbbb")], size=4, label=poor)


def test_no_seed_without_clash_is_an_error(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    with pytest.raises(RuntimeError):
        exact.exact_groups(docs, label=lambda block, seed: b"same")


def test_names_are_ranks(spark):
    keys = spark.range(500).selectExpr("(id * 7919) % 1000 as left", "-id as right").repartition(5)
    with Scratch(spark) as scratch:
        got = exact.dense_names(keys, scratch).collect()
    assert [r["name"] for r in sorted(got)] == list(range(500))
    assert sorted((r["left"], r["right"]) for r in got) == [(r["left"], r["right"]) for r in sorted(got, key=lambda r: r["name"])]
