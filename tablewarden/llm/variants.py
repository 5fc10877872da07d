"""Spelling variants: words one edit apart, found by pairs of trie nodes.

All words stand in a trie and, reversed, in a second one. A node of the first is a prefix, a node of the
second a suffix, and both are numbered, so that a word and a position are a pair of integers: ``skip`` i is the
node of the first i code points with the node of all after code point i, ``gap`` i the node of the first i
with the node of all the others. Two words are one replacement apart if and only if they share a skip pair; a word is
another one with one code point inserted if and only if a skip pair of the longer is a gap pair of the shorter. Numbers
of nodes are exact, so no candidate needs a check and none is missed, at any length of word.

Nodes are numbered without a pass per level: words are sorted in ranges, a node is new where a word's prefix is
longer than what it shares with the word before, and new nodes are counted. Only the words at the ends of ranges and
their node numbers are brought together, to give the nodes that two ranges share one number.

A group of equal pairs holds at most one word by its gap and at most one word per code point of the alphabet by
its skips, so it is small however large the vocabulary is. Groups are not expanded into pairs: each of their
members gets its number of partners and the best of them, and these are summed per word.

Null texts have no words, a null key counts as ``null``, empty tables give no rows. Repeated rows
are rows like others: their words count again. Of equally frequent near words the first in the order of code points is
the form. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import col
from tablewarden.session import materialize

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 97


def slipped(key: Column, run: Column) -> Column:
    """``run`` without one code point where 97 divides the checksum of key and run: a seeded misspelling."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % SLIP == 0, without).otherwise(run)


def corpus_words(
    df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 5, least: int = 3, slips: bool = True,
) -> DataFrame:
    """(word, n): words of at least ``shortest`` code points that occur ``least`` times or more in all texts."""
    runs = df.select(col(key).alias("key"), F.explode(F.regexp_extract_all(col(text), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= shortest).select("key", F.translate("run", UPPER, LOWER).alias("run"))
    word = slipped(F.col("key"), F.col("run")) if slips else F.col("run")
    words = runs.select(word.alias("word")).where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def trie_paths(keys: list[str], last: str | None, last_path: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Node numbers of all prefixes of sorted distinct ``keys``: (flat numbers, keys' offsets, next free number).

    ``last`` and ``last_path`` are the key before the first one and its numbers (the root, 0, first); None if none.
    """
    known = last is not None
    rows = ([last] if known else []) + keys
    size = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    letters = np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    start = np.concatenate([[0], np.cumsum(size)])
    common = np.zeros(len(rows), dtype=np.int64)
    both = np.minimum(size[1:], size[:-1])
    if both.sum():
        at = np.concatenate([[0], np.cumsum(both)])
        within = np.arange(at[-1]) - np.repeat(at[:-1], both)
        same = letters[np.repeat(start[1:-1], both) + within] == letters[np.repeat(start[:-2], both) + within]
        some = np.flatnonzero(both)
        common[1:][some] = np.minimum.reduceat(np.where(same, np.iinfo(np.int64).max, within), at[:-1][some])
        common[1:] = np.minimum(common[1:], both)
    depth = np.arange(start[-1]) - np.repeat(start[:-1], size) + 1
    new = depth > np.repeat(common, size)
    own = np.zeros(len(new), dtype=np.int64)
    skipped = int(size[0]) if known else 0
    own[skipped:] = free - 1 + np.cumsum(new[skipped:])
    if known:
        own[:skipped] = last_path[1:]
    free += int(new[skipped:].sum())
    # A prefix that is not new has the number it has in the word before: fill forward along each depth.
    by_depth = np.argsort(depth, kind="stable")
    source = np.maximum.accumulate(np.where(new[by_depth], np.arange(len(new)), 0)) if len(new) else by_depth
    number = np.empty(len(new), dtype=np.int64)
    number[by_depth] = own[by_depth][source]
    rooted = np.zeros(len(new) + len(rows), dtype=np.int64)
    rooted[np.arange(len(new)) + np.repeat(np.arange(len(rows)), size) + 1] = number
    offsets = np.concatenate([[0], np.cumsum(size + 1)])
    return (rooted[offsets[1] :], offsets[1:] - offsets[1], free) if known else (rooted, offsets, free)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted keys of a range with the numbers of their nodes in the range's own trie."""
    part, last, path, free = TaskContext.get().partitionId(), None, np.zeros(1, dtype=np.int64), 1
    for batch in batches:
        keys = batch.column("key").to_pylist()
        if not keys:
            continue
        flat, offsets, free = trie_paths(keys, last, path, free)
        last, path = keys[-1], flat[offsets[-2] :]
        paths = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat)).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("key"), pa.array([part] * len(keys), pa.int32()), paths],
            names=["word", "key", "part", "path"])


def _shared(a: str, b: str) -> int:
    return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def node_paths(words: DataFrame, reverse: bool = False) -> DataFrame:
    """(word, path): the trie nodes of a word's prefixes (suffixes if ``reverse``) of 0 to all code points.

    Numbers follow the order of code points: the last one of a path numbers the word and sorts as the word does.
    """
    spark = words.sparkSession
    key = F.reverse("word") if reverse else F.col("word")
    ranged = words.select("word", key.alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    local = materialize(ranged.mapInArrow(_number, "word string, key string, part int, path array<long>"), "trie")
    ends = local.groupBy("part").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.max_by("path", "key").alias("path"),
        F.max(F.array_max("path")).alias("most")).orderBy("part").collect()
    base, before, before_path, links = 0, None, None, []
    for end in ends:
        shared = before_path[: _shared(before, end["first"]) + 1] if before is not None else []
        # The first word of a range has the numbers 0, 1, 2 and so on; those that it shares are replaced.
        links.append((end["part"], base, shared))
        before = end["last"]
        before_path = [shared[v] if v < len(shared) else base + v for v in end["path"]]
        base += end["most"] + 1
    fixes = spark.createDataFrame(links, "part int, base long, shared array<long>")
    number = F.transform("path", lambda v: F.when(v < F.size("shared"), F.get("shared", v.cast("int"))).otherwise(F.col("base") + v))
    return local.join(F.broadcast(fixes), "part").select("word", number.alias("path"))


def node_pairs(words: DataFrame, forward: DataFrame, backward: DataFrame) -> DataFrame:
    """(prefix, suffix, word_id, n, gap, first): every skip and gap pair of every word of (word, n).

    ``first`` tells the first of several skips that leave the same letters, so that each shorter word counts once.
    """
    paths = forward.join(words, "word").join(backward.select("word", F.col("path").alias("back")), "word")
    long = F.size("path") - 1
    paths = paths.select("n", "path", "back", F.split("word", "").alias("letters"))
    skips = F.transform(F.sequence(F.lit(1), long), lambda i: F.struct(
        F.get("path", i - 1).alias("prefix"), F.get("back", long - i).alias("suffix"), F.lit(False).alias("gap"),
        ((i == 1) | (F.get("letters", i - 1) != F.get("letters", i - 2))).alias("first")))
    gaps = F.transform(F.sequence(F.lit(0), long), lambda i: F.struct(
        F.get("path", i).alias("prefix"), F.get("back", long - i).alias("suffix"), F.lit(True).alias("gap"),
        F.lit(False).alias("first")))
    pairs = F.concat(F.when(long > 0, skips).otherwise(F.slice(gaps, 1, 0)), gaps)
    return paths.select(F.get("path", long).alias("word_id"), "n", F.explode(pairs).alias("p")).select(
        "p.prefix", "p.suffix", "word_id", "n", "p.gap", "p.first")


def _partners(pairs: DataFrame) -> DataFrame:
    """(word_id, n_near, best): partners of each word summed over its groups; best is (n, -word_id)."""
    rank = F.struct("n", (-F.col("word_id")).alias("order"))
    member = F.struct(rank.alias("rank"), "gap", "first")
    groups = pairs.groupBy("prefix", "suffix").agg(F.collect_list(member).alias("members")).where(F.size("members") > 1)
    members = F.col("members")
    parts = groups.select(
        members, F.reverse(F.array_sort(F.transform(F.filter(members, lambda m: ~m["gap"]), lambda m: m["rank"]))).alias("skips"),
        F.reverse(F.array_sort(F.transform(F.filter(members, lambda m: m["first"]), lambda m: m["rank"]))).alias("longer"),
        F.get(F.transform(F.filter(members, lambda m: m["gap"]), lambda m: m["rank"]), F.lit(0)).alias("shorter"),
    ).select(F.explode("members").alias("m"), "skips", "longer", "shorter")
    other = F.when(F.get("skips", F.lit(0)) == F.col("m.rank"), F.get("skips", F.lit(1))).otherwise(F.get("skips", F.lit(0)))
    has_shorter = F.col("m.first") & F.col("shorter").isNotNull()
    near = F.when(F.col("m.gap"), F.size("longer")).otherwise(F.size("skips") - 1 + has_shorter.cast("int"))
    best = F.when(F.col("m.gap"), F.get("longer", F.lit(0))).otherwise(F.greatest(other, F.when(has_shorter, F.col("shorter"))))
    found = parts.select((-F.col("m.rank.order")).alias("word_id"), near.cast("long").alias("near"), best.alias("best"))
    return found.where("near > 0").groupBy("word_id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word_id, root_id) of words with a form, from (word_id, form_id), by doubling.

    Counts at least double along forms, so there are no circles and few turns. Words whose form is a root are done
    and take no part in later joins, so that a root with many words below it is no hot key there.
    """
    heads = forms.select(F.col("word_id").alias("form_id"), F.lit(False).alias("is_root"))
    rows = materialize(
        forms.join(heads, "form_id", "left").select("word_id", F.col("form_id").alias("up"), F.coalesce("is_root", F.lit(True)).alias("done")),
        "variant-roots",
    )
    while not rows.where("not done").isEmpty():
        above = rows.select(F.col("word_id").alias("up"), F.col("up").alias("next"), F.col("done").alias("next_done"))
        moved = rows.where("not done").join(above, "up").select("word_id", F.col("next").alias("up"), F.col("next_done").alias("done"))
        rows = materialize(rows.where("done").unionByName(moved), "variant-roots")
    return rows.select("word_id", F.col("up").alias("root_id"))


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """Per word of (word, n): word, n, form, root, n_near, form_n.

    The form is the most frequent near word, if its count is ``ratio`` (at least 2) times the word's or more. Null
    words are left out, counts of a repeated word are added.
    """
    if ratio < 2:
        raise ValueError("forms of forms end only if counts grow: ratio must be 2 or more")
    words = materialize(words.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "variant-words")
    forward = materialize(node_paths(words), "variant-paths")
    pairs = node_pairs(words, forward, node_paths(words, reverse=True))
    found = materialize(
        _partners(pairs).select(
            "word_id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.order")).alias("best_id")),
        "variant-partners",
    )
    numbered = forward.select("word", F.element_at("path", -1).alias("word_id")).join(words, "word")
    rows = materialize(
        numbered.join(found, "word_id", "left").withColumn("has", F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))).select(
            "word", "word_id", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("has"), F.col("best_id")).alias("form_id"), F.when(F.col("has"), F.col("best_n")).alias("form_n")),
        "variant-forms",
    )
    roots = _roots(rows.where("form_id is not null").select("word_id", "form_id"))
    named = rows.select(F.col("word_id").alias("form_id"), F.col("word").alias("form"))
    tops = rows.select(F.col("word_id").alias("root_id"), F.col("word").alias("root"))
    changed = rows.where("form_id is not null").join(named, "form_id").join(roots, "word_id").join(tops, "root_id")
    alone = rows.where("form_id is null").withColumns({"form": F.lit(None).cast("string"), "root": F.col("word")})
    names = ("word", "n", "form", "root", "n_near", "form_n")
    return changed.select(*names).unionByName(alone.select(*names))


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Variants among the words of all texts, misspelt by the seeded rule of ``slipped``."""
    return group_variants(corpus_words(df, key, text))
