"""Operators that SQL can state, against their SQL; and cases the given tables lack."""

import os

import pytest
from conftest import prose, words
from oracle_check import connect, mismatch
from pyspark.sql import functions as F

from barloom.llm import decontaminate, licenses, lines
from barloom.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    with connect(SF_DIR) as db:
        assert mismatch(QUERIES[name](spark, SF_DIR), db, ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op4_line_spread", "op9_license_sentences"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def plain_contamination(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, other in items:
        own = words(other)
        k = min(10, len(own))
        windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else set()
        for i in range(len(w) - k + 1) if k else ():
            if tuple(w[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add(item)
    return len(w), len(hit), len(found), bool(hit)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_an_item_split_over_two_documents(spark, limit):
    """Both parts are on one diagonal of the block."""
    item = prose(900, 26)
    own = item.split()
    texts = [prose(901, 20) + " " + " ".join(own[:13]), " ".join(own[13:]) + " " + prose(902, 20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench, limit).collect()}
    for i in (0, 1):
        assert (got[i]["n_hit"], got[i]["n_items"], got[i]["contaminated"]) == (13, 1, True)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_contamination_by_both_ways(spark, limit):
    a, b = prose(1, 40), prose(2, 12)
    same = "da " * 30
    items = [(1, a), (2, b), (3, "ABC def, ghi"), (4, "solo"), (5, ""), (6, None), (7, same), (8, prose(1, 40))]
    texts = [a, "x " + a[20:200] + " y", b + " " + b, " ".join(b.split()[:9]), "so abc DEF - ghi!", "Solo", "", None, same * 2, prose(3, 500), prose(4, 50) + " " + a + " " + prose(5, 50) + " " + a]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench, limit).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == plain_contamination(text, items), text


def test_an_item_without_id_hits_but_is_not_listed(spark):
    docs = spark.createDataFrame([(1, "a lone word")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "lone word")], "item_id long, text string")
    for limit in (1 << 20, 0):
        row = decontaminate.contamination(docs, bench, limit).first()
        assert (row["n_hit"], row["n_items"], row["contaminated"]) == (2, 0, True)


def test_lines_on_many_sites_go(spark):
    rows = [(i, f"shared line\n\n{prose(i, 30)}\nsite {i % 12}", f"s{i % 12}") for i in range(60)]
    rows += [(100 + i, f"on nine sites\n{prose(200 + i, 30)}", f"s{i % 9}") for i in range(40)]
    rows += [(200, "shared line", "s1"), (201, f"shared line\nshared line\n{prose(400, 20)}", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    for i, text, _ in rows[:60]:
        assert got[i]["text"] == text.removeprefix("shared line\n") and (got[i]["n_lines"], got[i]["n_removed"], got[i]["n_chars_removed"]) == (4, 1, 11)
    for i, text, _ in rows[60:100]:
        assert got[i]["text"] == text and got[i]["n_removed"] == 0
    assert (got[200]["text"], got[200]["n_removed"]) == ("", 1)
    assert got[201]["text"] == prose(400, 20) and got[201]["n_removed"] == 2


@pytest.mark.parametrize("sites", [9, 10, 11, 60])
def test_the_threshold_is_exact(spark, sites):
    docs = spark.createDataFrame([(i, f"same line\n{prose(i, 10)}", f"s{i % sites}") for i in range(120)], "doc_id long, text string, source string")
    assert lines.boilerplate_lines(docs).count() == (sites >= lines.MIN_SITES)


def test_stubs_of_shared_lines_lose_them(spark):
    rows = [(i, f"a line that stands on every site of all\n{prose(i, 4)}", f"s{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    assert all((got[i]["text"], got[i]["n_removed"]) == (prose(i, 4), 1) for i in range(30))


def test_lines_on_many_sites_by_copies_alone_stay(spark):
    exact = "\n".join(prose(900 + i, 12) for i in range(6))
    near = [prose(950 + i, 12) for i in range(20)]
    rows = [(i, exact, f"s{i}") for i in range(15)]
    for i in range(15):  # each copy has another word in one line
        own = [*near[:i], near[i] + f" w{i}", *near[i + 1 :]]
        rows.append((100 + i, "\n".join(["a line of all sites", *own]), f"s{i}"))
    rows += [(200 + i, f"a line of all sites\n{prose(i, 30)}", f"s{i}") for i in range(10)]
    rows.append((300, f"{near[3]}\n{prose(77, 40)}", "s99"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    for i, text, _ in rows:
        assert got[i]["text"] == text.removeprefix("a line of all sites\n"), i


CASES = {
    "Released under the MIT License.": "MIT",
    "text before.\nLicensed under the Apache License, Version 2.0.\nYou": "Apache-2.0",
    "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0. All rights reserved.": "CC-BY-NC,Proprietary",
    "LICENSED UNDER CC BY 4.0!": "CC-BY",
    "The MIT License is not here": "",
    "": "",
    None: "",
}


def test_licenses(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(docs).withColumn("licenses", F.array_join("licenses", ",")).collect()}
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())


def test_a_long_licence_is_not_its_parts(spark):
    text = ". ".join(licenses.SENTENCES[x][0] for x in ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"))
    docs = spark.createDataFrame([(1, text), (2, text.rsplit(". ", 1)[0])], "doc_id long, text string")
    assert [r["licenses"] for r in licenses.scan_licenses(docs).orderBy("doc_id").collect()] == [["BSD-3-Clause"], ["BSD-2-Clause"]]
