"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every five-word shingle hash that lies below a fixed fraction of the hash range. Hashes are
kept by value alone, so sketches of parts merge by union, and the share of one sketch that another holds
estimates the containment of their texts, whatever their lengths. A fingerprint also states the number of
distinct shingles and a checksum of the text, so that texts too short to keep a hash stay apart.

Null texts count as empty. A text of one to four words has one shingle. The likeness of a fingerprint to
an equal one is 1; otherwise a fingerprint without kept hashes is like nothing (0). Rows are ordered by
doc_id from high to low, null last, equal ids by text; a single row is its own next document. Other
columns do not matter, whatever their names.

The edited text of a row needs the row after it. Rows are cut into ranges of doc_id at approximate
quantiles and sorted inside a range; the first row of a range also travels to the range before it. Texts
move once, and a task holds two blocks of rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm import words
from tablewarden.llm.common import col

FRACTION = 8  # one hash in so many is kept


def sketches(texts: list[str], one_in: int = FRACTION) -> list[tuple[np.ndarray, int, str]]:
    """Per text: the kept hashes in rising order, the number of distinct shingles, a checksum."""
    limit = np.uint64((1 << 64) // one_in - 1)
    out = []
    array = pa.array(texts, pa.large_string())
    for i, _, data, offsets in words.blocks(array):
        values, _, first = words.distinct(*words.text_shingles(data, offsets))
        for k in range(len(offsets) - 1):
            own = values[first[k] : first[k + 1]]
            check = hashlib.blake2b(texts[i + k].encode(), digest_size=8).hexdigest()
            out.append((own[own <= limit], len(own), check))
    return out


def fingerprint(sketch: tuple[np.ndarray, int, str]) -> str:
    kept, n, check = sketch
    return f"{n}:{check}:{base64.b64encode(kept.astype('<u8').tobytes()).decode()}"


def kept_hashes(text: str) -> np.ndarray:
    """The hashes in a fingerprint."""
    return np.frombuffer(base64.b64decode(text.rsplit(":", 1)[1]), dtype="<u8")


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The share of the hashes of ``a`` that are in ``b``, both rising; 0 if ``a`` has none."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 0.0


def likeness(a: tuple[np.ndarray, int, str], b: tuple[np.ndarray, int, str]) -> float:
    return 1.0 if a[1:] == b[1:] else containment(a[0], b[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", one_in: int = FRACTION) -> DataFrame:
    """Per row: doc_id, n_chars and fingerprint; a map over the rows."""
    schema = T.StructType([df.schema[key], T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            prints = [fingerprint(s) for s in sketches(texts, one_in)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(prints, pa.string())], names=schema.names
            )

    return df.select(col(key), col(text)).mapInArrow(run, schema)


_RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])


def _compare(rows: list[tuple[int | None, str]], one_in: int) -> pa.RecordBatch:
    """Results of all rows but the last, each against its edited text and the row after it."""
    texts = [t for _, t in rows]
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, texts[1:], strict=False)]
    plain, changed = sketches(texts, one_in), sketches(edited, one_in)
    own = plain[:-1]
    columns = [
        pa.array([i for i, _ in rows[:-1]], pa.int64()),
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(map(fingerprint, own), pa.string()),
        pa.array(map(fingerprint, changed), pa.string()),
        pa.array(map(likeness, own, changed), pa.float64()),
        pa.array(map(likeness, own, plain[1:]), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_RESULT.names)


def edit_likeness(df: DataFrame, key: str = "doc_id", text: str = "text", one_in: int = FRACTION) -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and its likeness to that and to the next row.

    The edited text has the last half of the code points replaced by the first as many (or all) of the
    next row by descending key; the row after the last is the first.
    """
    spark = df.sparkSession
    order = F.coalesce(col(key).cast("double"), F.lit(float("-inf"))).alias("place")
    rows = df.select(col(key).cast("long").alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"), order)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inner = [i / parts for i in range(1, parts)]
    bounds = sorted({x for x in df.select(order).approxQuantile("place", inner, 0.1 / parts) if np.isfinite(x)}) if inner else []
    splits = [float("-inf"), *bounds, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="place", outputCol="part")
    rows = cut.transform(rows) if len(splits) > 2 else rows.withColumn("part", F.lit(0.0))

    # One row per range: its first id, and the range that has to see it.
    heads = sorted(
        ((r["part"], r["head"]) for r in rows.groupBy("part").agg(F.max("doc_id").alias("head")).collect()), reverse=True
    )
    to = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    schema = T.StructType([T.StructField("head", T.LongType()), T.StructField("to", T.DoubleType())])
    visits = F.broadcast(spark.createDataFrame(to, schema))
    visitors = rows.join(visits, F.col("doc_id").eqNullSafe(F.col("head"))).select(
        "doc_id", "text", "place", F.col("to").alias("part"), F.lit(1).alias("visitor"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        size, part, closed = 0, None, False
        for batch in batches:
            columns = [batch.column(k) for k in range(4)]
            for i in range(batch.num_rows):
                doc_id, body, own, visitor = (c[i].as_py() for c in columns)
                if own != part:
                    held, size, part, closed = [], 0, own, False
                if closed:
                    continue
                held.append((doc_id, body))
                size += len(body)
                closed = bool(visitor)
                if len(held) > 1 and (closed or size >= words.BLOCK_BYTES):
                    yield _compare(held, one_in)
                    held, size = held[-1:], len(body)

    return (
        rows.withColumn("visitor", F.lit(0)).unionByName(visitors)
        .repartitionByRange(parts, "part")
        .sortWithinPartitions("part", "visitor", F.col("doc_id").desc_nulls_last(), "text")
        .select("doc_id", "text", "part", "visitor")
        .mapInArrow(run, _RESULT)
    )
