"""Exact duplicates against a plain version: odd rows, hot groups, prefixes that agree, empty tables."""

from collections import defaultdict

import pytest

import __spark_entry__ as entry
from tablewarden.llm import exact
from tests.oracle import connect, differences

LONG = "x" * 300
ODD = [
    (1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "a b"), (None, "q"), (None, "q"), (5, LONG + "y"), (6, LONG + "z"),
    (7, LONG + "y"), (8, "uniq"), (9, "b a"), (10, "long word " * 30_000), (11, "long word " * 30_000), (12, "é"), (13, "é"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr(
        "*", "1 as n_bytes", "'k' as digest", "2 as `row`", "'x' as chunk", "0 as best", "1 as group_size")


@pytest.mark.parametrize("hot_rows", [None, 1, 2])
def test_odd_rows(odd, hot_rows):
    got = exact.exact_groups(odd, hot_rows=hot_rows).collect()
    groups = defaultdict(list)
    for key, text in ODD:
        groups[text or ""].append(key)
    want = sorted(
        (str(k), str(max((x for x in g if x is not None), default=None)), len(g)) for g in groups.values() for k in g)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    digests = {r.text_sha256 for r in got if r.doc_id in (5, 6, 7)}
    assert len(digests) == 2  # all three agree in length and prefix
    assert all(r.text_sha256 is None for r in got if r.doc_id in (8, 9, 12))  # never read as a whole


def test_a_third_of_all_rows_are_one_group(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', concat('t', id div 2)) as text")
    got = exact.exact_groups(df).toPandas()
    hot = got[got.group_size == 1000]
    assert len(hot) == 1000 and set(hot.keep_id) == {2997} and hot.kept.sum() == 1
    assert got.kept.sum() == df.select("text").distinct().count()


def test_empty_table_and_full_bitmaps(odd, monkeypatch):
    assert exact.exact_groups(odd.limit(0)).count() == 0
    before = exact.exact_groups(odd, every_digest=True).toPandas().sort_values(["text_sha256", "doc_id", "kept"])
    monkeypatch.setattr(exact, "BITS", 2)  # nearly every key meets another one
    after = exact.exact_groups(odd, every_digest=True).toPandas().sort_values(["text_sha256", "doc_id", "kept"])
    assert before.reset_index(drop=True).equals(after.reset_index(drop=True))


def test_query_equals_sql(spark, sf_dir):
    got = entry.queries()["op12_exact_duplicates"](spark, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).execute(entry.oracle_sql()["op12_exact_duplicates"]).df()) is None
