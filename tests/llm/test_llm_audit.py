"""Main text, hard negatives and divergence against plain versions on small tables."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import coinstrata.llm.divergence as div
import coinstrata.llm.hard_negatives as hard
from coinstrata.llm.divergence import divergence, skyband
from coinstrata.llm.hard_negatives import Block, hard_negatives, scan
from coinstrata.llm.html_text import FEED_CHARS, extracted, main_blocks, smoothed

LONG = "A sentence of the article that goes on for quite a while, as articles do, with more."


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"


ARTICLE = f"<h1>Title</h1><p>{LONG} 1</p><p>Short.</p><p>{LONG} 2</p>"
BLOCKS = ["Title", LONG + " 1", "Short.", LONG + " 2"]


@pytest.mark.parametrize(
    "body",
    [
        f"<nav><ul><li><a href='/'>Home</a></li></ul></nav><article>{ARTICLE}</article><footer>&copy; x</footer>",
        f"<div id='menu'><a href='/'>Home</a> <a href='/b'>B</a></div><div class='content'>{ARTICLE}</div>"
        "<div class='footer'>Imprint and other things of the site, in quite a long line of text.</div>",
        f"<header><h1>Site</h1></header><main>{ARTICLE}<aside>Related: {LONG}</aside></main>",
        f"<div class='cookie-notice'><p>{LONG}</p></div><div><div class='post'>{ARTICLE}</div>"
        f"<div id='comments'><div class='comment'><p>{LONG}</p></div></div></div>",
        f"<div class='sideBar'><p>{LONG}</p></div><section>{ARTICLE}</section><form><p>{LONG}</p></form>",
        f"<article>{ARTICLE}<div class='ad'>{LONG}</div><script>var x='<p>{LONG}</p>';</script></article>",
        f"<article><header><h1>Title</h1></header>{ARTICLE[14:]}<section class='reader-comments'><p>{LONG}</p>"
        "</section></article>",
        f"<div><ul><li><a href='a'>One</a></li><li><a href='b'>Two</a></li></ul></div><div>{ARTICLE}</div>",
        f"<div class='wrap has-sidebar'>{ARTICLE}</div><p role='contentinfo'>{LONG}</p>",
        # Broken: unclosed paragraphs and inline elements, unfinished markup at the end.
        f"<article><h1>Title</h1><p><b>{LONG} 1<p>Short.<br><p>{LONG} 2</article><footer>x",
        f"<article>{ARTICLE}</article><![if IE]><p hidden>{LONG}</p><!-- {LONG} --><foo bar='",
    ],
)
def test_layouts(body):
    assert main_blocks(page(body)) == BLOCKS


def test_blocks_of_an_article():
    body = (
        "<article><h2>Head</h2><p>One&nbsp;two\n three<br>four <b>fi</b>ve &amp; &lt;six&gt; &#233;</p>"
        "bare text<ul><li>first<li>second</ul><blockquote><p>said</p></blockquote>"
        "<table><tr><td>a</td><td>b</td></tr></table><pre>x\n  y</pre></article>"
    )
    assert main_blocks(page(body)) == [
        "Head", "One two three four five & <six> é", "bare text", "first", "second", "said", "a", "b", "x y",
    ]


def test_without_text():
    for html in (None, "", " \n ", "<html><nav><a>x</a></nav></html>", "<p></p>", "<!-- x", "<a", "<script>x"):
        assert main_blocks(html) == []
    assert main_blocks("only words") == ["only words"]


def test_parser_survives_anything():
    rng = random.Random(5)
    parts = ["<p>", "</p>", "<div class='ad'>", "</div>", "<b", ">", "<", "&", "&amp", ";", "<![x[", "]]>", "<!",
             "<?", "</", "text ", "\0", "é", "<table><tr><td>", "<li>", "</article>", "<article>", "<script>",
             "</script>", "<br/>", "<a href=x>", "</a>", "<p/>", "--", "<!--", "-->", "\"", "'"]
    for _ in range(1500):
        main_blocks("".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))))


def test_slices_make_no_difference(monkeypatch):
    import coinstrata.llm.html_text as module

    html = page(f"<article>{ARTICLE}<p>a &amp; b &#8212; c</p></article><div class=ad>x</div>" * 20)
    whole = main_blocks(html)
    for size in (1, 7, 100):
        monkeypatch.setattr(module, "FEED_CHARS", size)
        assert main_blocks(html) == whole
    assert len(html) < FEED_CHARS


def test_smoothing_is_a_weighted_mean():
    values = np.array([1.0, 5.0, 0.0, 0.0, 9.0, 2.0])
    for i, got in enumerate(smoothed(values)):
        near = [(j, np.exp(-((i - j) ** 2) / 2)) for j in range(max(0, i - 2), min(6, i + 3))]
        assert got == pytest.approx(sum(w * values[j] for j, w in near) / sum(w for _, w in near))


def test_extracted_rows(spark):
    big = page("<article>" + "".join(f"<p>{LONG} {i}</p>" for i in range(30_000)) + "</article>")
    rows = [(1, None, "t", "r"), (2, "", "t", "r"), (3, page(ARTICLE), "t", "r"), (3, page(ARTICLE), "t", "r"),
            (None, page(ARTICLE), None, "r"), (4, big, "t", "r")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, row string")
    out = extracted(df)
    assert out.columns == ["page_id", "html", "row", "text", "n_chars"]
    got = sorted(((r.page_id, r.text, r.n_chars, r.row) for r in out.collect()), key=repr)
    text = "\n\n".join(BLOCKS)
    whole = "\n\n".join(f"{LONG} {i}" for i in range(30_000))
    assert got == sorted(
        [(1, "", 0, "r"), (2, "", 0, "r"), *[(3, text, len(text), "r")] * 2,
         (None, text, len(text), "r"), (4, whole, len(whole), "r")], key=repr)
    assert extracted(df.limit(0)).count() == 0


def plain_negatives(rows, every=100, k=5, scale=256):
    used = {}
    for i, label, vector in rows:
        if None in (i, label, vector) or any(x is None or not np.isfinite(x) for x in vector):
            continue
        made = (label, [int(np.floor(x * scale)) for x in vector])
        used[i] = min(used.get(i, made), made)
    out = []
    for a, (label, va) in used.items():
        if a % every:
            continue
        score = {b: sum(x * y for x, y in zip(va, vb)) for b, (_, vb) in used.items() if b != a}
        first = lambda ids: sorted(ids, key=lambda b: (-score[b], b))[:k]
        for p in first(b for b in score if used[b][0] == label):
            near = first(
                b for b in score if used[b][0] != label and 80 * score[p] <= 100 * score[b] <= 100 * score[p]
            )
            out += [(a, p, r + 1, n, score[p], score[n]) for r, n in enumerate(near)]
    return sorted(out)


VECTORS = "vec_id long, label int, embedding array<float>, rank string, score string"


def vector_rows(seed, n=700, width=12):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(3)), rng.normal(size=width).round(1).tolist()) for i in range(n)]
    same = rng.normal(size=width).round(1).tolist()
    rows = [(i, label, same if i % 3 == 0 else v) for i, label, v in rows]  # ties
    return rows


@pytest.mark.parametrize("group_bytes", [16_000_000, 300])
def test_hard_negatives(spark, monkeypatch, group_bytes):
    rows = vector_rows(1)
    rows += [(1000, None, [1.0] * 12), (1100, 1, None), (1200, 1, [float("nan")] * 12), (1300, 1, [None] * 12),
             (None, 1, [1.0] * 12), (1400, 2, []), (1500, 1, [2.0, -1.0]), (3, 0, rows[3][2]), rows[5],
             (1600, 1, [float("inf")] + [0.0] * 11)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    exact = [(i, label, v and [x if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]
    got = sorted(tuple(r) for r in hard_negatives(df, group_bytes=group_bytes).collect())
    assert got == plain_negatives(exact) and len(got) > 50
    assert hard_negatives(df.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, [float(x) for x in rng.integers(-(2**21), 2**21, 8)]) for i in range(120)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS.replace("float", "double"))
    got = sorted(tuple(r) for r in hard_negatives(df, every=20).collect())
    assert got == plain_negatives(rows, every=20) and got


def test_scan_keeps_what_is_wanted_and_drops_most():
    rng = np.random.default_rng(3)
    columns = np.floor(rng.normal(size=(64, 4000)) * 100)
    block = Block(np.arange(4000), np.zeros(4000, np.int64), columns)
    anchor = np.floor(rng.normal(size=64) * np.exp(-np.arange(64) / 6) * 100)
    scores = anchor @ columns
    top = set(np.argsort(-scores)[:5])
    alive, exact = scan(block, anchor, np.arange(4000), [-(2**200)], [2**200], 5)
    assert top <= set(alive) and len(alive) < 100 and (exact == scores[alive]).all()
    windows = [(100_000, 120_000), (0, 10)]
    alive, exact = scan(block, anchor, np.arange(4000), *map(list, zip(*windows)), 5)
    for low, high in windows:
        inside = [i for i in np.lexsort((np.arange(4000), -scores)) if low <= scores[i] <= high][:5]
        assert set(inside) <= set(alive)


def test_skyband():
    rng = random.Random(4)
    for _ in range(60):
        n, k = rng.randrange(1, 60), rng.randrange(1, 5)
        points = [(rng.randrange(6), rng.randrange(8), r) for r in rng.sample(range(1000), n)]
        ours, all_, rank = (np.array(c) for c in zip(*points))
        expected = {
            i
            for i, (o, a, r) in enumerate(points)
            if sum(x >= o and y <= a and z < r for x, y, z in points) < k
        }
        assert set(skyband(ours, all_, rank, k)) == expected


def plain_divergence(rows, least, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    import re

    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = ["".join(c.lower() if c.isascii() else c for c in w) for w in found]
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in docs.keys() | {g[0] for g in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        mine = {s: c for (of, s), c in counts.items() if of == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = shares(sum(mine.values(), Counter())), {s: shares(c) for s, c in mine.items()}
        for s in mine:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in mine if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_divergence(spark, monkeypatch, small):
    if small:  # many blocks, slices, runs and flushes; workers get these values with the code
        for name, value in (("SOURCES", 2), ("TASK_ROWS", 40), ("COUNTED", 50), ("HELD", 30), ("PARTS", 3)):
            monkeypatch.setattr(div, name, value)
    rng = random.Random(6)
    words = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyzäß"] + ["Élan", "ÉLAN", "x1y", "z_z"]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(7)}"
        text = " ".join(rng.choices(words, k=rng.randrange(12)))
        rows.append((rng.choice(["de", "en"]), source, text))
    rows += [("fr", "only", "un deux"), ("fr", "other", ""), (None, None, None), (None, "s1", "wa " * 50_000)]
    df = spark.createDataFrame(
        [(*r, "x", "y", "z") for r in rows], "lang string, source string, text string, term string, n string, item string"
    )
    got = sorted(tuple(r) for r in divergence(df, least_documents=20, top=5).collect())
    assert got == plain_divergence(rows, 20, 5)
    assert divergence(df.limit(0)).count() == 0
