"""Labelled pages for training the block model: layouts of many kinds with their main text marked.

Every page is put together from parts: a wrapper around the main text, and menus, headers, footers,
sidebars, notices, adverts, forms, reader comments and link lists around, between and inside it. Parts of
the main text carry ``data-main``, which only the trainer reads. Words are made up, so the model learns
structure and shape, not vocabulary.
"""

from __future__ import annotations

import random

_SYLLABLES = "ba co di fu ge hi jo ka lu me no pi ra so tu ve wa xe yo zu än ör él ça ño".split()


def _words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def _sentences(rng: random.Random, low: int, high: int) -> str:
    out = []
    for _ in range(rng.randint(low, high)):
        words = _words(rng, rng.randint(3, 18))
        if len(words) > 6:
            words[rng.randrange(2, 5)] += ","
        out.append(" ".join(words).capitalize() + rng.choice("...?!"))
    return " ".join(out)


def _links(rng: random.Random, low: int = 2, high: int = 7) -> list[str]:
    return [f'<a href="/{i}">{" ".join(_words(rng, rng.randint(1, 4)))}</a>' for i in range(rng.randint(low, high))]


def _list(rng: random.Random, high: int = 7) -> str:
    return "<ul>" + "".join(f"<li>{x}</li>" for x in _links(rng, 2, high)) + "</ul>"


def _named(rng: random.Random, names: str, inner: str, tags: str = "div section") -> str:
    tag = rng.choice(tags.split())
    name = rng.choice(names.split())
    attribute = rng.choice(("class", "id"))
    return f'<{tag} {attribute}="{name}">{inner}</{tag}>'


def _paragraphs(rng: random.Random, low: int, high: int) -> str:
    return "".join(f"<p>{_sentences(rng, 1, 4)}</p>" for _ in range(rng.randint(low, high)))


def _noise(rng: random.Random) -> str:
    kind = rng.randrange(12)
    if kind == 0:
        return rng.choice((f"<nav>{_list(rng)}</nav>", _named(rng, "nav menu navbar navigation topnav main-menu", _list(rng))))
    if kind == 1:
        inner = rng.choice((f"<p>{_sentences(rng, 1, 2)}</p>", _sentences(rng, 1, 2), _list(rng, 3)))
        return rng.choice((f"<aside>{inner}</aside>", _named(rng, "sidebar side aside widget rail sidebar-right", f"<h3>{' '.join(_words(rng, 2))}</h3>{inner}")))
    if kind == 2:
        inner = rng.choice((_sentences(rng, 1, 3), f"<p>{_sentences(rng, 1, 2)}</p>", _links(rng)[0]))
        return _named(rng, "ad ads advert advertisement banner promo sponsor sponsored ad-slot adbox", inner, "div div aside section")
    if kind == 3:
        inner = rng.choice((_sentences(rng, 1, 2), f"<p>{_sentences(rng, 1, 2)}</p><button>OK</button>"))
        return _named(rng, "cookie cookies notice alert consent gdpr cookie-banner notification warning message", inner)
    if kind == 4:
        fields = f"<label>{' '.join(_words(rng, 2))}</label><input name=q><p>{_sentences(rng, 1, 1)}</p>"
        return f"<form action='/s'>{fields}</form>"
    if kind == 5:
        each = "".join(
            f"<{t}><p>{' '.join(_words(rng, 2))}</p><p>{_sentences(rng, 1, 3)}</p></{t}>"
            for t in [rng.choice(("li", "div", "article"))] for _ in range(rng.randint(1, 4)))
        return _named(rng, "comments comment-list comment responses discussion reader-comments replies disqus", f"<h3>{' '.join(_words(rng, 2))}</h3>{each}", "div section ol")
    if kind == 6:
        return _named(rng, "related recommended more read-more popular trending see-also", f"<h3>{' '.join(_words(rng, 3))}</h3>{_list(rng)}")
    if kind == 7:
        return _named(rng, "share social share-buttons follow tags breadcrumb breadcrumbs pagination pager", " | ".join(_links(rng)), "div p ul")
    if kind == 8:
        return _named(rng, "newsletter subscribe signup popup modal overlay", f"<p>{_sentences(rng, 1, 2)}</p>")
    if kind == 9:
        return f"<p>{' | '.join(_links(rng, 3, 6))}</p>"
    if kind == 10:
        return f"<script>var a='<p>{' '.join(_words(rng, 5))}</p>';</script><style>p{{margin:0}}</style>"
    return f"<!-- {_sentences(rng, 1, 1)} -->"


def _head(rng: random.Random) -> str:
    name = " ".join(_words(rng, 2))
    inner = rng.choice((f"<h1>{name}</h1>", f"<a href=/>{name}</a>", f"<p>{_sentences(rng, 1, 1)}</p>", f"<div>{name}</div>{_list(rng)}"))
    return rng.choice((f"<header>{inner}</header>", _named(rng, "header masthead top site-header", inner)))


def _foot(rng: random.Random) -> str:
    inner = rng.choice(("&copy; ", "Copyright ", "")) + _sentences(rng, 1, 2)
    inner = rng.choice((inner, f"<p>{inner}</p>", f"{inner}{_list(rng)}"))
    return rng.choice((f"<footer>{inner}</footer>", _named(rng, "footer bottom site-footer copyright legal", inner)))


def _article(rng: random.Random) -> str:
    parts = [f"<h1 data-main>{' '.join(_words(rng, rng.randint(1, 9))).capitalize()}</h1>"] if rng.random() < 0.85 else []
    for _ in range(rng.randint(1, 7)):
        kind = rng.random()
        if kind < 0.62:
            parts.append(f"<p data-main>{_sentences(rng, 1, 6)}</p>")
        elif kind < 0.70:
            parts.append(f"<p data-main>{' '.join(_words(rng, rng.randint(1, 5)))}.</p>")
        elif kind < 0.76:
            parts.append(f"<h2 data-main>{' '.join(_words(rng, rng.randint(1, 5)))}</h2>")
        elif kind < 0.81:
            parts.append("<ul data-main>" + "".join(f"<li>{_sentences(rng, 1, 1)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>")
        elif kind < 0.85:
            parts.append(f"<blockquote data-main><p>{_sentences(rng, 1, 2)}</p></blockquote>")
        elif kind < 0.88:
            parts.append(f"<pre data-main>{' '.join(_words(rng, 8))}</pre>")
        elif kind < 0.91:
            parts.append(f"<p data-main>{_sentences(rng, 1, 2)} {_links(rng, 1, 1)[0]} {_sentences(rng, 1, 1)}</p>")
        elif kind < 0.94:
            parts.append("<table data-main><tr><td>" + "</td><td>".join(_words(rng, 3)) + "</td></tr></table>")
        else:
            parts.append(_noise(rng))
    inner = "".join(parts)
    if rng.random() < 0.3:
        inner += _noise(rng)
    names = "content article post entry main story body text article-body post-content entry-content main-content".split()
    wrapper = rng.random()
    if wrapper < 0.35:
        return f"<article>{inner}</article>"
    if wrapper < 0.5:
        return f"<main>{inner}</main>"
    if wrapper < 0.6:
        return f"<main><article>{inner}</article></main>"
    if wrapper < 0.9:
        return f'<div {rng.choice(("class", "id"))}="{rng.choice(names)}">{inner}</div>'
    return inner if rng.random() < 0.5 else f"<div>{inner}</div>"


def pages(n: int, seed: int = 11) -> list[str]:
    """``n`` labelled pages, the same for the same seed."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        before = [_head(rng)] if rng.random() < 0.6 else []
        before += [_noise(rng) for _ in range(rng.randint(0, 3))]
        after = [_noise(rng) for _ in range(rng.randint(0, 3))] + ([_foot(rng)] if rng.random() < 0.8 else [])
        bare = rng.random()  # some pages end with the article, some hold nothing else
        before, after = ([] if bare < 0.15 else before), ([] if bare < 0.3 else after)
        main = _article(rng) if rng.random() < 0.97 else ""
        out.append(f"<!DOCTYPE html><html><head><title>{' '.join(_words(rng, 4))}</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>")
    return out
