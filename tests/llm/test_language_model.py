"""Scores of the Pitman-Yor model against a plain sampler that seats one customer after the other."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from tablewarden.llm import pitman_yor
from tablewarden.llm.pitman_yor import DISCOUNT, ROOT_DISCOUNT, ROOT_STRENGTH, STRENGTH

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


class Restaurant:
    def __init__(self, d, theta, parent):
        self.d, self.theta, self.parent = d, theta, parent
        self.tables, self.customers, self.n_tables = {}, 0, 0

    def chance(self, w):
        own = self.tables.get(w, [])
        share = (sum(own) - self.d * len(own)) / (self.theta + self.customers) if self.customers else 0.0
        back = (self.theta + self.d * self.n_tables) / (self.theta + self.customers)
        return share + back * self.parent(w)

    def add(self, w, rng, above):
        own = self.tables.setdefault(w, [])
        fresh = (self.theta + self.d * self.n_tables) * self.parent(w)
        pick = rng.random() * (sum(own) - self.d * len(own) + fresh)
        self.customers += 1
        for k, size in enumerate(own):
            pick -= size - self.d
            if pick < 0:
                own[k] += 1
                return
        own.append(1)
        self.n_tables += 1
        if above:
            above.add(w, rng, None)

    def remove(self, w, rng, above):
        own = self.tables[w]
        k = rng.choices(range(len(own)), own)[0]
        own[k] -= 1
        self.customers -= 1
        if not own[k]:
            del own[k]
            self.n_tables -= 1
            if above:
                above.remove(w, rng, None)


def plain_scores(rows, burn_in=6, kept=12):
    """log10 probability per text, averaged over sweeps of a Gibbs sampler."""
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER)), ""] for i, t in rows.items()}
    train = {i: t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 10}
    known = {w for t in train.values() for w in t}
    uniform = 1.0 / (len(known) + 1)
    rng = random.Random(5)
    root = Restaurant(ROOT_DISCOUNT, ROOT_STRENGTH, lambda w: uniform)
    contexts = {}
    seats = [(u, w) for t in train.values() for u, w in zip([None, *t[:-1]], t, strict=True)]
    for u, w in seats:
        contexts.setdefault(u, Restaurant(DISCOUNT, STRENGTH, root.chance)).add(w, rng, root)
    total = {i: np.zeros(len(t)) for i, t in tokens.items()}
    nobody = Restaurant(DISCOUNT, STRENGTH, root.chance)
    for sweep in range(burn_in + kept):
        rng.shuffle(seats)
        for u, w in seats:
            contexts[u].remove(w, rng, root)
            contexts[u].add(w, rng, root)
        if sweep >= burn_in:
            for i, t in tokens.items():
                total[i] += [contexts.get(u, nobody).chance(w) for u, w in zip([None, *t[:-1]], t, strict=True)]
    return {i: float(np.log10(x / kept).sum()) for i, x in total.items()}


def test_scores_equal_a_plain_sampler(spark, sf_dir):
    rows = {r.doc_id: (r.text or "")[:600] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = pitman_yor.score(df).toPandas().set_index("doc_id")
    want = plain_scores(rows)
    for held in (True, False):
        some = got[got.held_out == held]
        total = sum(want[i] for i in some.index)
        print(held, some.score.sum(), total, some.score.sum() / total - 1)
        assert some.score.sum() == pytest.approx(total, rel=0.02)
    apart = np.array([got.score[i] / want[i] - 1 for i in rows if want[i] < -20])
    assert np.abs(apart).mean() < 0.02 and math.isfinite(apart.sum())


def test_counts_beyond_32_bits():
    counts = np.array([5_000_000_000, 1, 0])
    assert (pitman_yor._unz(pitman_yor._z(counts, "<u8"), "<u8") == counts).all()
    rising = np.array([3, 3, 2**63 + 5, 2**64 - 1], dtype=np.uint64)
    assert (pitman_yor._unz_rising(pitman_yor._z_rising(rising)) == rising).all()
