"""Spelling variants against a plain version: every pair compared, forms followed one by one."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from tablewarden.llm import variants

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def plain_words(rows, shortest=5, least=3):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= shortest
    return {w: n for w, n in counts.items() if n >= least}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_variants(words):
    partners = {w: [v for v in words if abs(len(v) - len(w)) < 2 and v != w and near(w, v)] for w in words}
    forms = {}
    for w, found in partners.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return sorted((w, str(forms[w]), root(w), n, len(partners[w]), words.get(forms[w], 0)) for w, n in words.items())


def rows_of(df):
    assert set(COLUMNS) <= set(df.columns)
    return sorted((r.word, str(r.form), r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = plain_variants(plain_words(rows))
    got = rows_of(entry.queries()["op11_spelling_variants"](spark, sf_dir))
    assert got == want and sum(r[4] for r in want) > 20 and any(r[1] != "None" for r in want)


@pytest.mark.parametrize("ranges", [1, 7])
def test_dense_words(spark, ranges):
    """Few letters, so that nearly all words are near others; runs of one letter; ranges that share prefixes."""
    rng = np.random.default_rng(11)
    words = {"".join(rng.choice(list("abé"), rng.integers(1, 8))): int(rng.integers(1, 2000)) for _ in range(400)}
    words |= {"a" * k: 3**k for k in range(1, 12)} | {"": 5, "ab" * 3000: 7, "ab" * 2999 + "a": 20, "𝒳y": 4, "𝒳": 9}
    df = spark.createDataFrame([(w, n, 0) for w, n in words.items()], "word string, n long, path int")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(variants.group_variants(df)) == plain_variants(words)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark):
    rows = [(1, "Hello hello HELLO héllo Éhello"), (1, "Hello hello HELLO héllo Éhello"), (2, None), (3, ""), (None, "hallo hallo hallo"),
            (4, "x" * 50_000 + " " + "hello, " * 5000), (5, "jello " * 3 + "×÷×÷× " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'k' as word", "2 as key", "3 as part")
    assert rows_of(variants.spelling_variants(df)) == plain_variants(plain_words(rows))
    assert variants.spelling_variants(df.limit(0)).count() == 0
    assert variants.group_variants(spark.createDataFrame([(None, 3), ("word", 2), ("word", 1)], "word string, n long")).count() == 1


def test_paths_across_batches():
    keys = sorted({"".join(p) for p in np.random.default_rng(3).choice(list("ab"), (60, 6))} | {"a", "ab", "b"})
    whole, offsets, free = variants.trie_paths(keys, None, np.zeros(1, dtype=np.int64), 1)
    prefixes = {k[:d] for k in keys for d in range(len(k) + 1)}
    numbers = {k[:d]: whole[offsets[i] + d] for i, k in enumerate(keys) for d in range(len(k) + 1)}
    assert free == len(prefixes) == len(set(numbers.values())) and numbers[""] == 0
    last, path, at, parts = None, np.zeros(1, dtype=np.int64), 1, []
    for k in range(0, len(keys), 7):
        flat, own, at = variants.trie_paths(keys[k : k + 7], last, path, at)
        last, path = keys[: k + 7][-1], flat[own[-2] :]
        parts.append(flat)
    assert (np.concatenate(parts) == whole).all()
