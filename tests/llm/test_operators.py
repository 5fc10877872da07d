"""Operators as Spark jobs on small tables: odd rows, empty tables, plain versions."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tablewarden.llm import bpe, html, mixture, neardup, pitman_yor, queries, shards, sketch, toxicity, urls, vectors, words
from tests.oracle import connect, differences

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size int, node string"
ODD = [
    (1, "a b c d e f g", "en", "s", 1, 0, "x"), (1, "a b c d e f g", "en", "s", 1, 0, "x"), (2, None, None, None, None, None, None),
    (3, "", "en", "s", 0, 0, ""), (4, "one", "en", "t", 3, 1, "y"), (None, "two words", "en", None, 9, 1, None),
    (5, "long word " * 30_000, "en", "t", 1, 1, "z"), (6, "a b c d e f g", "en", "u", 1, 1, "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.mark.parametrize("operator", [
    mixture.mix, shards.interleave, sketch.edit_likeness, sketch.fingerprints, neardup.groups, pitman_yor.score,
    lambda df: bpe.digests(df, queries.vocabulary()), lambda df: bpe.encode(df, queries.vocabulary()),
])
def test_odd_rows_and_empty_tables(operator, odd, empty):
    assert operator(odd).count() == len(ODD)
    assert operator(empty).count() == 0


def test_mix_equals_sql(spark, sf_dir):
    got = entry.queries()["op1_mix_sources"](spark, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).execute(entry.oracle_sql()["op1_mix_sources"]).df()) is None
    by = got.groupby("source").agg({"taken": "sum", "target": "first", "source_size": "first", "size": "max"})
    assert (by.target <= 2 * by.source_size).all() and ((by.taken - by.target).abs() <= by["size"]).all()


def test_shards_are_even_and_mixed(spark, sf_dir):
    got = entry.queries()["op10_shards"](spark, sf_dir).toPandas()
    counts = got.groupby("shard").size()
    assert counts.max() - counts.min() <= 1 and len(counts) == 24
    assert all(sorted(x) == list(range(len(x))) for _, x in got.groupby("shard").slot)
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32(rows[r.doc_id].encode()) and r.size_ == len(rows[r.doc_id].encode()) + 8
               for r in got.rename(columns={"size": "size_"}).itertuples())


def test_edited_texts(spark, sf_dir):
    import hashlib

    rows = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in entry.queries()["op4_fingerprints"](spark, sf_dir).collect()}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == sketch.fingerprint(sketch.sketches([text])[0])


def test_rules_and_verdicts(spark):
    cases = [
        (1, "http://a.com/x", "com/"), (2, "http://A.Example.COM/en/1?q#f", "example.com/en/"),
        (3, "https://www.example.com/en/", "www.example.com/en/"), (4, "http://b.net/es/", "net/es/"), (5, "http://b.net/de/", None),
        (6, None, None), (7, "nothing", None), (8, "http://notcom/", None), (9, "http://com", None), (10, "http://x.net/fr/1", "net/fr/"),
    ]
    rows = urls.judge(spark.createDataFrame([c[:2] for c in cases], "page_id long, url string")).collect()
    assert {r.page_id: r.rule for r in rows} == {c[0]: c[2] for c in cases}
    assert all(r.verdict in ("allow", "block") for r in rows)
    none = urls.judge(spark.createDataFrame([], "page_id long, url string, host string"))
    assert none.count() == 0


def test_trees_learn_held_out_urls(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    host, path = urls.host_and_path(df["url"])
    rows = df.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = urls.decide(urls.RULES, rows["host"], rows["path"])
    rows = rows.withColumn("label", (verdict == "block").cast("int")).where(rule.isNotNull())
    model = urls.UrlModel.fit(rows.where("page_id % 5 != 0"))
    scored = model.block_probability(rows.where("page_id % 5 = 0")).toPandas()
    right = ((scored.blocked >= 0.5) == scored.label).mean()
    assert right > max(scored.label.mean(), 1 - scored.label.mean())  # better than one verdict for all


def test_suffix_statistics_count_all_labelled_rows(spark, monkeypatch):
    """The trees see a few rows; a domain's rate comes from all of them, and without a row's own label."""
    rows = spark.range(4000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://"), F.when(F.col("id") % 8 == 0, "shop.net").otherwise(
            F.concat(F.lit("a"), F.col("id") % 50, F.lit(".org"))), F.lit("/x/"), F.col("id")).alias("url"),
        (F.col("id") % 8 == 0).cast("int").alias("label"))
    host, path = urls.host_and_path(rows["url"])
    rows = rows.withColumn("host", host).withColumn("path", path)
    model = urls.UrlModel.fit(rows, sample_rows=200)
    assert {r["domain"]: (r["blocked"], r["n"]) for r in model.rates["domain"].collect()}["shop.net"] == (500, 500)
    assert model.rates["top"].count() == 2 and model.labelled == 4000
    folds = {r["f"]: r["n"] for r in rows.where("label = 1").groupBy(urls.fold().alias("f")).agg(F.count("*").alias("n")).collect()}
    asked = urls.lexical(rows.where("label = 1")).withColumn("f", urls.fold())
    for r in model.assembled(asked, counted=True).limit(20).collect():  # rates of the other folds
        rest = 500 - folds[r["f"]]
        assert r["features"][urls.FEATURES.index("domain_rate")] == pytest.approx((rest + 4 * 0.125) / (rest + 4))
    before = sorted(model.block_probability(rows).select("page_id", "blocked").collect())
    monkeypatch.setattr(urls, "BROADCAST_SUFFIXES", 0)
    assert sorted(model.block_probability(rows).select("page_id", "blocked").collect()) == before


def test_pages_as_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (1, "u", "<p"), (None, None, "<article><p>Some text here, long enough.</p></article>")],
                               "page_id long, url string, html string")
    assert sorted(r.text for r in html.extract(df).collect()) == ["", "", "Some text here, long enough."]
    assert html.extract(df.limit(0)).count() == 0


def test_near_documents_equal_brute_force(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r.class_id for r in neardup.groups(df).collect()}
    bags = {r.doc_id: {" ".join(w[k : k + 5]) for w in [(r.text or "").split()] for k in range(max(1, len(w) - 4))} for r in df.collect()}
    for a in bags:
        for b in bags:
            j = len(bags[a] & bags[b]) / len(bags[a] | bags[b])
            if a < b and j >= 0.82:
                assert got[a] == got[b]
    assert sum(i == c for i, c in got.items()) == neardup.deduplicated(df).count() == len(set(got.values()))


def test_copies_in_a_hot_group_are_linked(spark):
    """A third of all rows copies one text at a plain similarity of 0.80 to 0.88, by edits of their own."""
    rng = np.random.default_rng(9)
    word = lambda n: [f"w{k}" for k in rng.integers(0, 10**6, n)]
    base, rows = word(300), []
    for k in range(200):
        copy = list(base)
        for at in np.arange(4 + k % 3) * 45 + rng.integers(5, 30) if k else ():  # an edit changes 5 of 296 shingles
            copy[at] = word(1)[0]
        rows.append((k, " ".join(copy)))
    rows += [(k, " ".join(word(300))) for k in range(200, 600)]
    bag = lambda t: {tuple(w[k : k + 5]) for w in [t.split()] for k in range(len(w) - 4)}
    first = bag(rows[0][1])
    plain = {k: len(first & bag(t)) / len(first | bag(t)) for k, t in rows[1:200]}
    assert all(0.8 <= j <= 0.88 for j in plain.values())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weights = neardup.cell_weights(df)
    sampler = neardup.Sampler(weights)
    values, own, at = sampler.bag(*words.flat(pa.array([t for _, t in rows[:200]])))
    bags = [(values[a:b], own[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert all(neardup.similarity(bags[0], bags[k]) >= neardup.THRESHOLD for k in plain)


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base, base[:10] + 0.05 * rng.normal(size=(10, 16)), base[:3]])
    x = np.concatenate([x, base[0] + 0.1 * rng.normal(size=(300, 16))])  # more than a window
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, [], 1), (905, [1.0, 2.0], 1)]
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")).collect()}
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    for k in range(len(x)):
        assert got[k].n_links == near[k].sum() - 1
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k in range(900, 906))
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_toxicity_on_held_out_rows(spark, odd, empty):
    d = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(documents, labels)
    got = toxicity.score(documents, model).where("held_out").join(labels, "doc_id").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.97
    assert toxicity.score(odd, model).where("score < 0.5").count() == len(ODD)
    assert toxicity.score(empty, model).count() == 0 and toxicity.reject(odd, model).count() == len(ODD)
    unlearned = toxicity.fit(documents, labels.limit(0))
    assert toxicity.score(odd, unlearned).where("score = 0 and predicted = 0").count() == len(ODD)


def test_language_model_counts_and_gain(spark, sf_dir):
    got = pitman_yor.score(spark.read.parquet(f"{sf_dir}/documents.parquet")).toPandas()
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower)), ""] for i, t in rows.items()}
    counts = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    n = sum(counts.values())
    for r in got.itertuples():
        t = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(counts[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (len(counts) + 1))) for w in t), rel_tol=1e-9)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_words_that_are_not_broadcast_have_their_counts_too(spark, sf_dir, monkeypatch):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = pitman_yor.score(df).toPandas().set_index("doc_id").score
    monkeypatch.setattr(pitman_yor, "COMMON", 1.0)  # the driver broadcasts no word
    after = pitman_yor.score(df).toPandas().set_index("doc_id").score
    assert abs(after.sum() / before.sum() - 1) < 0.002


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd, empty, sf_dir):
    """Nulls in any column, repeated and empty rows, clashing names: every stage keeps the columns and its rules."""
    for rows in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, sf_dir)
            if name != "byte_bpe":
                assert out.columns == odd.columns
            counts = {"toxicity": len(ODD), "near_duplicates": 5, "byte_bpe": len(ODD)}
            if name in counts:
                assert out.count() == (counts[name] if rows is odd else 0)
            else:
                assert out.where("text is null or text = ''").count() <= 4 and (rows is odd or out.count() == 0)


def test_pipeline_stages(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == documents.columns
    plain = {i: r for i, r in ((r.doc_id, r.text or "") for r in docs.collect())}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert len(out) == docs.count() > 0
    import hashlib

    assert all(r.decoded_sha256 == hashlib.sha256(plain[r.doc_id].encode()).hexdigest() for r in out)
