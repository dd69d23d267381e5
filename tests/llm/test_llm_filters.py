"""Toxicity, url filter, benchmark windows."""

import random

import numpy as np
import pytest

from coinstrata.llm import decontaminate, toxicity
from coinstrata.llm.decontaminate import WindowSet, scan_texts
from coinstrata.llm.toxicity import ToxicityModel, nn_pu
from coinstrata.llm.url_filter import Rule, UrlTrie, host_and_path, judge_urls

RULES = [
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "a.net/e"),
]


def test_nn_pu_finds_positives_among_unlabelled():
    rng = np.random.default_rng(3)
    toxic = np.r_[np.ones(200, bool), rng.random(800) < 0.15]
    rows = [np.flatnonzero(rng.random(40) < np.where(np.arange(40) < 5, 0.6 * t + 0.02, 0.2)) for t in toxic]
    confirmed = np.arange(1000) < 200
    w, b = nn_pu(rows, confirmed, 40, 0.15)
    score = np.array([w[r].sum() + b for r in rows])[200:]
    hidden = toxic[200:]
    assert ((score > 0) == hidden).mean() > 0.93


def test_toxicity_on_held_out_labels(spark):
    """Accuracy on labels that the fit has not seen."""
    from coinstrata.llm.queries import op1_toxicity

    sf = "/root/testdata/sf0.01"
    scored = op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = scored.filter("held_out").toPandas()
    ranks = rows["score"].rank()
    p = rows["toxic"] == 1
    auc = (ranks[p].sum() - p.sum() * (p.sum() + 1) / 2) / (p.sum() * (~p).sum())
    assert auc > 0.75  # 34 confirmed toxic texts to learn from
    assert rows["score"].between(0, 1).all()


def test_toxicity_edges(spark, edges, nothing, documents):
    labels = spark.createDataFrame([(5, 1), (5, None), (None, 1), (4, 0), (99, 1)], "doc_id long, toxic int")
    for docs in (edges, nothing):
        model = ToxicityModel.fit(docs, labels)
        scored = docs.select(model.score(docs["text"], spark).alias("score"))
        assert scored.count() == docs.count()
        assert scored.filter("score is null or score < 0 or score > 1").count() == 0
    model = ToxicityModel.fit(edges, labels.limit(0))
    assert model.weights == {}


def test_toxicity_scores_whole_texts(spark, documents):
    model = ToxicityModel({"scum": 9.0}, -3.0)
    docs = documents((1, "fine " * 30_000 + "scum"), (2, "fine"), (3, None), (4, "SCUM."))
    got = {r.doc_id: r.s > 0.5 for r in docs.select("doc_id", model.score(docs["text"], spark).alias("s")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        (None, ("", "")),
        ("", ("", "")),
        ("no scheme", ("", "")),
        ("http://A.Com", ("a.com", "")),
        ("http://a.com?q=/x", ("a.com", "")),
        ("http://a.com/x/y?q#f", ("a.com", "/x/y")),
        ("http://a.com#f/x", ("a.com", "")),
        ("x://b://c/d", ("b:", "//c/d")),
        ("http://Ä.COM/Ä", ("Ä.com", "/Ä")),
    ],
)
def test_host_and_path(url, expected):
    assert host_and_path(url) == expected


def longest_by_scan(host, path):
    fits = [
        r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host)), default=None)
    return best and best.text


def test_trie_is_the_longest_rule(spark):
    hosts = ["com", "example.com", "www.example.com", "x.www.example.com", "a.net", "b.a.net", "net", "", "notexample.com", ".com"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/", "/e", "/es/en/", "//", "/en//x"]
    trie = UrlTrie(RULES)
    for host in hosts:
        for path in paths:
            found = trie.longest(host, path)
            assert (found and found[1]) == longest_by_scan(host, path), (host, path)
    both = UrlTrie([Rule("block", "a.org/"), Rule("allow", "a.org/")])
    assert both.longest("a.org", "/x")[2] == "block"


def test_judged_urls(spark, monkeypatch):
    rows = [(1, "http://www.example.com/en/1", "c"), (1, None, "c"), (None, "https://x.net/es/", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, row string").selectExpr("*", "url as host")
    got = {(r.page_id, r.verdict, r.rule, r.row) for r in judge_urls(pages, RULES).collect()}
    assert got == {(1, "allow", "www.example.com/en/", "c"), (1, "allow", None, "c"), (None, "block", "net/es/", "c")}
    assert judge_urls(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in judge_urls(pages, [], default="block").collect()} == {"block"}
    monkeypatch.setattr("coinstrata.llm.url_filter.RULES_PER_TRIE", 2)
    assert {(r.page_id, r.verdict, r.rule, r.row) for r in judge_urls(pages, RULES).collect()} == got


def hits_by_scan(text, items, window=10):
    words = decontaminate.words(text)
    hit, found = set(), set()
    for item_id, item in items:
        w = decontaminate.words(item)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == w[k : k + n]:
                    hit.update(range(i, i + n))
                    found.add(item_id)
    return len(words), len(hit), sorted(found)


def test_windows_by_brute_force(spark, documents, monkeypatch):
    rng = np.random.default_rng(1)
    say = lambda n: " ".join(rng.choice(["a", "B", "c!", "dé"], n))
    items = [(i, say(n)) for i, n in enumerate([12, 10, 3, 1, 15])] + [(9, None), (10, ""), (11, "...")]
    items[3] = (3, "rare")
    docs = [(i, say(60) + (" RARE-" if i % 3 == 0 else "")) for i in range(30)]
    docs.append((30, "x " * 500 + items[0][1] + " y" * 500))
    benchmark = spark.createDataFrame([*items, (None, "a b c")], "item_id long, text string")
    frame = documents(*docs)
    expected = {i: hits_by_scan(t, items) for i, t in docs}
    for limit in (10**6, 40):  # one block, then several
        scanned = scan_texts(frame, benchmark, block_bytes=limit)
        assert scanned.columns[-1] == "scan" and "row" in scanned.columns
        got = {r.doc_id: (r.scan.n_words, r.scan.n_hit, sorted(r.scan["items"])) for r in scanned.collect()}
        assert got == expected
    assert WindowSet.of([(1, "a a a")]).scan("a a a a")[1] == 4


def test_windows_edges(spark, edges, nothing):
    benchmark = spark.createDataFrame([(1, "one two three"), (1, "one two three")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.scan.n_hit) for r in scan_texts(edges, benchmark).collect())
    assert got == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 3), (5, 3), (6, 0), (7, 0)]
    assert scan_texts(edges, benchmark.limit(0)).filter("scan.n_hit > 0").count() == 0
    assert scan_texts(nothing, benchmark).count() == 0


def test_sample_bound_is_documented():
    assert toxicity.POSITIVES + toxicity.UNLABELLED <= 20_000


def plain_verdict(host, path, rules):
    """Longest rule that fits, by comparing with all."""
    fits = [
        ((len(r.host) + len(r.path), len(r.host), r.verdict == "block"), r)
        for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda f: f[0], default=None)
    return (best[1].text, best[1].verdict) if best else (None, "allow")


def test_urls_of_all_kinds(spark):
    """Random hosts and paths with NUL, empty segments and dots, against all rules."""
    rng = random.Random(21)
    segment = lambda: rng.choice(["", "a", "b", "ab", "\0path", "\0ends", "\0", ".", "é"])
    hosts = [".".join(segment() for _ in range(rng.randint(1, 3))) for _ in range(300)]
    paths = ["".join("/" + segment() for _ in range(rng.randint(0, 4))) for _ in range(300)]
    rules = [Rule(rng.choice(["allow", "block"]), rng.choice(hosts) + (rng.choice(paths) or "/")) for _ in range(60)]
    rules = list({(r.host, r.path): r for r in rules}.values())
    rows = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(600)] + [(-1, None), (-2, "://")]
    rows.append((-3, "http://a.com/\0ends//x"))
    out = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    for r in out:
        host, path = host_and_path(r.url)
        assert (r.rule, r.verdict) == plain_verdict(host, path, rules), r.url


def test_items_with_one_prompt_build_fast():
    import time

    prompt = " ".join(f"p{i}" for i in range(30))
    started = time.time()
    made = WindowSet.of([(i, f"{prompt} own {i}") for i in range(100_000)])
    assert time.time() - started < 30
    assert len(max(made.items[10].values(), key=len)) == 100_000


def test_risk_and_its_gradient_by_finite_differences():
    from coinstrata.llm.toxicity import risks

    rng = np.random.default_rng(22)
    positive = rng.random(60) < 0.4
    for shift, prior in ((0.0, 0.1), (4.0, 0.5), (-4.0, 0.5)):
        g = rng.normal(size=60) + np.where(positive, shift, 0)
        toxic, clean, slope = risks(g, positive, prior)
        loss = lambda z: np.log1p(np.exp(-z))
        assert toxic == pytest.approx(prior * loss(g[positive]).mean())
        assert clean == pytest.approx(loss(-g[~positive]).mean() - prior * loss(-g[positive]).mean())
        made_smaller = lambda z: sum(risks(z, positive, prior)[:2]) if clean >= 0 else -risks(z, positive, prior)[1]
        for i in range(60):
            step = np.zeros(60)
            step[i] = 1e-6
            assert slope[i] == pytest.approx((made_smaller(g + step) - made_smaller(g - step)) / 2e-6, abs=1e-6)
