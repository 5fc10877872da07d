"""Operators' array code against plain versions; no Spark."""

import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tablewarden.llm import bpe, html, labelled_pages, neardup, pitman_yor, sketch, toxicity, words
from tablewarden.llm.queries import RANKS


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(RANKS))


def test_encoding_equals_the_library(vocabulary):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    rng = random.Random(1)
    alphabet = list("abcsStmdrevlL'' ''  \n\t.!-19é中 　ß²Ⅷ🙂́") + ["'re", "'ve", "'ll", "'s", '"', "  "]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(4000)]
    texts += ["a" * 3000, " " * 900, "'" * 600, "", "\n", " ", "xyz" * 2000]
    for i, j, data, offsets in words.blocks(pa.array(texts), 20_000):
        ids, first = vocabulary.encode(data, offsets)
        assert vocabulary.decode(ids)[0].tobytes() == data.tobytes()
        for k in range(i, j):
            assert ids[first[k - i] : first[k - i + 1]].tolist() == library.encode_ordinary(texts[k])


def test_texts_whose_hashes_are_equal(vocabulary):
    """Thue-Morse words and their complements collide in every polynomial hash modulo a power of two."""
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    for n in (1024, 4096):
        one, other = ("".join("ab"[(k.bit_count() + flip) % 2] for k in range(n)) for flip in (0, 1))
        data, offsets = words.flat(pa.array([one, other, f"{other} {one} {other}"]))
        start, end, _ = words.spans(data, offsets)
        assert len(set(words.hashes(data, start, end)[:2].tolist())) == 1
        ids, first = vocabulary.encode(data, offsets)
        got = [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
        assert got == [library.encode_ordinary(t) for t in (one, other, f"{other} {one} {other}")]


def test_every_toxic_passage_is_found():
    """A passage that comes three times is three passages; for the text's score it counts once."""
    bad = "vile awful nasty rotten foul"
    plain = " ".join(f"word{chr(97 + k % 26)}" for k in range(40))
    of = lambda *texts: words.flat(pa.array(texts))
    levels, _, _ = toxicity.tokens(*of(bad))
    keys = np.sort(levels[-1])
    model = toxicity.ToxicModel(keys, np.full(len(keys), 1.2), log_k=0.0, slope=1.0, intercept=0.0)
    (n, found, once), (_, thrice, again) = model.assess(*of(f"{plain} {bad} {plain}", f"{plain} {bad} {plain} {bad} {plain} {bad}"))
    assert [(b - a, round(s, 9)) for a, b, s in found] == [(5, 6.0)] and n == 85
    assert [(b - a, round(s, 9)) for a, b, s in thrice] == [(5, 6.0)] * 3
    assert all(model.excess(s, 135) > 0 for *_, s in thrice)
    assert once - again == pytest.approx(np.log(135 / 85))  # the same tokens, in a longer text


def test_words_and_shingles():
    texts = ["a bb  c\td e f", None, "", "x y", " \n ", "a bb c d e f"]
    data, offsets = words.flat(pa.array(texts))
    start, end, first = words.spans(data, offsets)
    found = [data[a:b].tobytes().decode() for a, b in zip(start, end, strict=True)]
    assert found == " ".join(t or "" for t in texts).split()
    assert np.diff(first).tolist() == [6, 0, 0, 2, 0, 6]
    values, at = words.text_shingles(data, offsets)
    assert np.diff(at).tolist() == [2, 0, 0, 1, 0, 2]
    assert values[at[0] : at[1]].tolist() == values[at[5] : at[6]].tolist()


def _plain_segments(scores):
    """All maximal scoring segments by their definition: split around the best one."""
    best, where = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-12:
                best, where = total, (i, j + 1)
    if where is None:
        return []
    i, j = where
    right = [(a + j, b + j, s) for a, b, s in _plain_segments(scores[j:])]
    return [*_plain_segments(scores[:i]), (i, j, best), *right]


def test_segments_equal_their_definition():
    rng = np.random.default_rng(2)
    for _ in range(200):
        scores = rng.normal(-0.3, 1.0, rng.integers(0, 25))
        got, want = toxicity.segments(scores), _plain_segments(scores.tolist())
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in got], [x[2] for x in want])


def test_sketch_keeps_low_hashes_and_estimates_containment():
    rng = random.Random(3)
    long = [f"w{rng.randrange(10**6)}" for _ in range(8000)]
    whole, part, none, other = sketch.sketches([" ".join(long), " ".join(long[:1000]), "", "q " * 50])
    values, _, _ = words.distinct(*words.text_shingles(*words.flat(pa.array([" ".join(long)]))))
    assert whole[0].tolist() == [v for v in values.tolist() if v <= (1 << 64) // sketch.FRACTION - 1]
    assert sketch.containment(part[0], whole[0]) > 0.98 and abs(sketch.containment(whole[0], part[0]) - 0.125) < 0.04
    assert sketch.likeness(none, none) == 1.0 and sketch.likeness(none, other) == 0.0
    assert sketch.kept_hashes(sketch.fingerprint(whole)).tolist() == whole[0].tolist()


def test_pages():
    model = html.trained()
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a></ul></nav>
    <div class="cookie-notice">We use cookies. Accept them.</div><article><h1>Head &amp; line</h1><p>First  para,
    with <b>bold</b>&nbsp;words and a sentence.<p>Second para &lt;x&gt; follows here.<script>var a="</p>";</script>
    <div class="comments"><p>Reader says this is great.</p></div></article><aside>Side text here</aside>
    <form><label>Mail</label><input></form><footer>&copy; site</footer>"""
    assert html.main_text(page, model) == (
        "Head & line\nFirst para, with bold words and a sentence.\nSecond para <x> follows here.")
    for odd in (None, "", "<", "<!--", "<script>", "<p", "</", "<div " * 50, "&#x;&bogus;"):
        html.main_text(odd, model)
    assert html.main_text(None, model) == ""
    unseen = [html.read(p, labelled=True) for p in labelled_pages.pages(100, seed=77)]
    wrong = sum(b.main != x for p in unseen for b, x in zip(p, model.decode(p), strict=True))
    assert wrong <= 0.01 * sum(map(len, unseen))


def test_decoding_is_the_best_path():
    model = html.trained()
    for page in labelled_pages.pages(40, seed=5):
        blocks = html.read(page)[:8]
        if not blocks:
            continue

        def value(path, blocks=blocks):
            total = model.ends[0, path[0]] + model.ends[1, path[-1]]
            total += sum(model.moves[a, b] for a, b in zip(path, path[1:], strict=False))
            return total + sum(model.weights[model.index[f], y] for b, y in zip(blocks, path, strict=True) for f in b.features if f in model.index)

        paths = [[(k >> i) & 1 for i in range(len(blocks))] for k in range(1 << len(blocks))]
        assert np.isclose(value([int(x) for x in model.decode(blocks)]), max(map(value, paths)))


def test_samples_agree_as_often_as_weighted_jaccard_says():
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**5)}" for _ in range(600)]
    texts = [" ".join(base), " ".join(base[:480] + [f"v{k}" for k in range(60)])]
    sampler = neardup.Sampler(np.ones(neardup.CELLS), 2000)
    data, offsets = words.flat(pa.array(texts))
    values, weights, first = sampler.bag(data, offsets)
    codes = sampler.draw(values, weights, first)
    a, b = ((values[first[k] : first[k + 1]], weights[first[k] : first[k + 1]]) for k in (0, 1))
    assert abs((codes[0] == codes[1]).mean() - neardup.similarity(a, b)) < 0.04


def test_seats():
    rng = np.random.default_rng(1)
    c = np.array([1, 2, 50, 5000, 0])
    tables = pitman_yor.gibbs(c, np.zeros(5, dtype=int), np.full(5, 0.01), 0.8, 1.0, rng)
    assert tables[0] == 1 and tables[4] == 0 and (tables <= c).all() and (tables[:4] >= 1).all()
    packed = np.array([0, 5, (1 << 40) - 1], dtype=np.uint64)
    assert pitman_yor._unpack40(pitman_yor._pack40(packed)).tolist() == packed.tolist()


def test_seats_follow_the_law_one_by_one():
    """Large dishes have the tables of customers that come one after the other."""
    def plain(c, rng):
        opens = rng.random((c, 1500))
        t, log_total = np.ones(1500), np.zeros(1500)
        for n in range(1, c):
            opening = (1.0 + 0.8 * (30 + t)) * 0.02
            total = opening + n - 0.8 * t
            t += opens[n] < opening / total
            log_total += np.log(total)
        return t, log_total

    t, log_total = plain(4000, np.random.default_rng(2))
    many = np.full(60_000, 4000)
    got, weight = pitman_yor.seat(many, np.full(len(many), 30.0), np.full(len(many), 0.02), 0.8, 1.0, np.random.default_rng(3))
    for own, law in ((got, t), (weight, log_total)):
        assert abs(own.mean() - law.mean()) < 4 * law.std() / len(law) ** 0.5
    few, _ = zip(*(pitman_yor._seat_one(4000, 1, 1.0, 30.0, 0.02, 0.8, 1.0, np.random.default_rng(k)) for k in range(1500)), strict=True)
    assert abs(np.mean(few) - t.mean()) < 6 * t.std() / 1500**0.5
    one, alone = pitman_yor.seat(np.array([700]), np.zeros(1), np.zeros(1), 0.8, 1.0, np.random.default_rng(4))
    assert one[0] == 1 and np.isclose(alone[0], np.log(np.arange(1, 700) - 0.8).sum())


def test_the_parent_is_seated_among_its_own_tables():
    customers = np.full(200, 400.0)
    few = pitman_yor._root_seats(customers, 0, 10**6, [200.0] * 6)[1].mean()
    many = pitman_yor._root_seats(customers, 0, 10**6, [10.0**6] * 6)[1].mean()
    assert few < 1.1 and many > 1.5


def test_text_of_every_element_is_kept():
    model = html.trained()
    paragraph = "<p>A plain paragraph of an article, with commas, as there are many of them.</p>"
    page = (f"<article>{paragraph}<p>Energy is <math><mi>E</mi><mo>=</mo><mi>mc</mi></math> by law, as everyone knows well.</p>{paragraph}"
            f"<p>The <button>quick</button> fox <span hidden>always</span> jumps over the lazy dog.</p>{paragraph}"
            f"<xmp>if (a < b && c) {{ <b>run</b>(); }}</xmp><object>No plugin, so this text.</object>{paragraph}</article>")
    text = html.main_text(page, model)
    for kept in ("Energy is E=mc by law", "The quick fox always jumps", "if (a < b && c) { <b>run</b>(); }", "No plugin, so this text."):
        assert kept in text
    assert "none" not in html.main_text(f"<article>{paragraph}<p>x<script>none</script><svg><text>none</text></svg></p></article>", model)


def test_unclosed_elements_take_linear_time():
    model = html.trained()
    page = "<body><article>" + "".join(f"<span><div>Some words of text {i}, more of them.</div></a>" for i in range(40_000))
    started = time.perf_counter()
    assert html.main_text(page, model).count("\n") > 30_000 and len(page) > 2_000_000
    assert time.perf_counter() - started < 20
