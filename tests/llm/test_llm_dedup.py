"""Line dedup, near duplicates, repeated passages."""

import random

import numpy as np
import pytest

from coinstrata.llm import passages, probminhash
from coinstrata.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines
from coinstrata.llm.passages import aligned, chains, repeated_passages
from coinstrata.llm.probminhash import WordHashes, near_duplicates, shingles, signatures, similarity


def kept_by_hand(docs, least=10):
    """Kept text of each document, from (doc_id, text) with distinct ids."""
    strip = lambda line: "".join(
        c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r")
    )
    holders = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(strip(line), set()).add(doc_id)
    out = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        keep = [
            x for x in lines
            if len(strip(x)) < least or len(holders[strip(x)]) < 2 or min(holders[strip(x)]) == doc_id
        ]
        out[doc_id] = (len(lines), "\n".join(keep))
    return out


LINES = ["A line long enough", "a LINE long enough \t", "short", "ÄÖ line of ten", "äÖ line of ten", "x" * 10, "", " ", "no one has it "]


def some_docs(n, seed):
    rng = random.Random(seed)
    docs = [(i, "\n".join(rng.choice(LINES) + rng.choice(["", "", str(i)]) for _ in range(rng.randint(0, 8)))) for i in range(n)]
    return [*docs, (n, None), (n + 1, "")]


def as_text(frame):
    return {r.doc_id: (len(r.lines), "\n".join(r.kept)) for r in frame.collect()}


def test_lines_by_brute_force(documents):
    docs = some_docs(60, 1)
    out = dedup_lines(documents(*docs))
    assert as_text(out) == kept_by_hand(docs)
    assert {"row", "key", "n_words"} <= set(out.columns)


def test_lines_edges(documents, edges, nothing):
    assert dedup_lines(nothing).count() == 0
    assert dedup_lines(edges).count() == edges.count()
    # Rows that repeat an id are one document; a null id is the smallest.
    docs = documents((2, "the same old line"), (2, "the same old line"))
    assert [r.kept for r in dedup_lines(docs).collect()] == [["the same old line"]] * 2
    docs = documents((2, "the same old line"), (None, "the same old line"), (3, "other\nthe same old line"))
    assert {r.doc_id: r.kept for r in dedup_lines(docs).collect()} == {
        None: ["the same old line"], 2: [], 3: ["other"]
    }


def state(index):
    counts = sorted((bytes(r.key), r.n_docs, r.keeper) for r in index.counts.collect())
    references = sorted((bytes(r.key), r.doc_id) for r in index.references.collect())
    return counts, references


def test_inserts_and_deletes_are_reversible(documents):
    docs = some_docs(40, 2)
    first, rest = docs[:25], docs[25:]
    whole = LineIndex.build(documents(*docs), keys_per_shard=10)
    part = LineIndex.build(documents(*first), keys_per_shard=10)
    grown = part.insert(documents(*rest))
    assert state(grown) == state(whole)
    assert as_text(grown.kept_lines(documents(*docs))) == kept_by_hand(docs)
    again = grown.insert(documents(*rest[:5]))  # ids that are in already change nothing
    assert state(again) == state(whole)
    shrunk = grown.delete(documents(*rest, (999, "x")))
    assert state(shrunk) == state(part)
    # The keeper itself goes: the next smallest holder takes its place.
    gone = whole.delete(documents(*docs[:10]))
    assert state(gone) == state(LineIndex.build(documents(*docs[10:]), keys_per_shard=10))
    for index in (whole, grown, shrunk, gone):
        assert index.filters.agg({"n_keys": "sum"}).first()[0] == index.counts.count()


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    held = CuckooFilter(len(keys))
    held.insert(keys[:12_000])
    held.insert(keys[12_000:])
    assert held.contains(keys).all() and len(held) == len(keys)
    other = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    assert held.contains(other).mean() < 0.002
    row = held.row(3)
    held = CuckooFilter.of_row(row["buckets"], row["slots"], row["spilt"])
    held.delete(keys[:15_000])
    assert held.contains(keys[15_000:]).all() and len(held) == 5_000
    assert held.contains(keys[:15_000]).mean() < 0.002
    tight = CuckooFilter(4)  # far too small: what finds no place is spilt, not lost
    tight.insert(keys[:100])
    assert tight.contains(keys[:100]).all() and tight.spilt
    tight.delete(keys[:100])
    assert len(tight) == 0


def similar_by_hand(a, b):
    a, b = (dict(zip(s[0].tolist(), s[1].tolist())) for s in (a, b))
    either = a.keys() | b.keys()
    return sum(
        1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in either) for d in a.keys() & b.keys()
    )


def test_similarity_and_its_estimate():
    rng = np.random.default_rng(4)
    sets, exact = [], []
    for _ in range(150):
        items = np.sort(probminhash.mixed(rng.integers(0, 1 << 60, 50).astype(np.uint64)))
        a, b = items[rng.random(50) < 0.9], items[rng.random(50) < 0.9]
        pair = [(x, rng.integers(1, 5, len(x)).astype(float)) for x in (a, b)]
        exact.append(similar_by_hand(*pair))
        assert similarity(*pair) == pytest.approx(exact[-1], abs=1e-9)
        sets += pair
    signed = signatures(sets, 512)
    error = (signed[::2] == signed[1::2]).mean(axis=1) - exact
    assert abs(error.mean()) < 0.005 and error.std() < 0.03
    empty = (np.zeros(0, np.uint64), np.zeros(0))
    assert signatures([empty, sets[0]], 8).shape == (2, 8) and similarity(empty, empty) == 1.0


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.random()}"
    return out


def classes_by_hand(docs):
    hashes, parent = WordHashes(), {i: i for i, _ in docs}
    sets = {i: shingles(t, hashes) for i, t in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in parent:
        for j in parent:
            if i < j and len(sets[i][0]) and len(sets[j][0]) and similarity(sets[i], sets[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in parent}


def test_near_duplicates_by_brute_force(documents):
    rng = random.Random(5)
    docs = []
    for base in range(6):  # groups whose members are near the first, not all near each other
        words = [f"g{base}w{rng.randint(0, 400)}" for _ in range(rng.choice([60, 150, 300]))]
        docs.append((len(docs), " ".join(words)))
        for n in range(14):
            docs.append((len(docs), " ".join(edited(rng, words, rng.choice([0, 1, 2, 3, 5, 9])))))
    docs += [(len(docs) + k, t) for k, t in enumerate(["one two", "One, two!", "spam eggs " * 99, "spam eggs " * 70, "other"])]
    order = list(range(len(docs)))
    rng.shuffle(order)
    docs = [(i, docs[k][1]) for i, k in enumerate(order)]
    out = near_duplicates(documents(*docs)).collect()
    assert {r.doc_id: r.class_id for r in out} == classes_by_hand(docs)
    sizes = {r.class_id: r.class_size for r in out}
    assert sum(sizes.values()) == len(docs)


def test_near_duplicates_edges(edges, nothing):
    got = {r.doc_id: r.class_id for r in near_duplicates(edges).collect()}
    assert got == {i: i for i in range(1, 8)}
    assert near_duplicates(nothing).count() == 0


def chained_by_hand(p, q):
    """Best chain score over all increasing chains."""
    order = sorted(range(len(p)), key=lambda i: (p[i], q[i]))
    best = {}
    for i in order:
        before = [
            best[j] - passages.GAP_COST * float(p[i] - p[j] + q[i] - q[j])
            for j in best
            if p[j] < p[i] and q[j] < q[i]
        ]
        best[i] = passages.SEED + max([0.0, *before])
    return max(best.values())


def test_chains_are_optimal():
    rng = random.Random(6)
    for _ in range(100):
        n = rng.randint(1, 30)
        pairs = sorted({(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(n)})
        p, q = (np.array(x) for x in zip(*pairs))
        found = chains(p, q)
        assert sorted(i for c in found for i in c.tolist()) == list(range(len(pairs)))
        for c in found:
            assert (np.diff(p[c]) > 0).all() and (np.diff(q[c]) > 0).all()
        gap = lambda c: float(p[c][-1] - p[c][0] + q[c][-1] - q[c][0])
        top = max(passages.SEED * len(c) - passages.GAP_COST * gap(c) for c in found)
        assert top == pytest.approx(chained_by_hand(p, q))


def test_alignment_goes_over_edits():
    a = list(range(100))
    b = [-1, -2, *range(10, 30), -3, *range(31, 50), *range(52, 80), -4]
    first, end, other_first, other_end, equal = aligned(a, b, [12, 60], [4, 50])
    assert (first, end, other_first, other_end) == (10, 80, 2, 70)
    assert equal == 67


def words_of(rng, n, mark):
    return [f"{mark}{rng.randint(0, 10**6)}" for _ in range(n)]


def test_passages_are_found_where_planted(documents):
    rng = random.Random(7)
    docs, planted, clean = [], {}, []
    shared = words_of(rng, 80, "p")
    fuzzy = words_of(rng, 120, "f")
    line = words_of(rng, 14, "l")
    for i in range(40):
        words = words_of(rng, 200, f"d{i}x")
        if i % 4 == 0:
            words[50:50] = shared
            planted[i] = (50, 130)
        elif i % 4 == 1:
            words[20:20] = edited(rng, fuzzy, 5)
            planted[i] = (20, 140)
        elif i % 4 == 2:
            words[10:10] = line  # shared by many, but too short
        else:
            clean.append(i)
        docs.append((i, " ".join(words)))
    found = repeated_passages(documents(*docs)).collect()
    got = {}
    for r in found:
        got[r.doc_id] = (r.passage_first, r.passage_end)
        assert r.match_doc_id < r.doc_id and r.match_doc_id % 4 == r.doc_id % 4
    assert set(got) == set(planted) - {0, 1}
    for i, (first, end) in got.items():
        assert abs(first - planted[i][0]) <= 12 and abs(end - planted[i][1]) <= 12
        if i % 4 == 0:
            assert (first, end) == planted[i]


def test_chains_are_cut_at_bad_gaps(documents):
    rng = random.Random(11)
    own = lambda n: words_of(rng, n, "o")
    one, two, copy = (words_of(rng, n, m) for n, m in ((60, "a"), (60, "b"), (500, "c")))
    docs, planted = [], []
    for gap in (30, 60, 100, 140):  # two passages in both texts, other words between
        for _ in range(2):
            docs.append((len(docs), " ".join(own(40) + one + own(gap) + two + own(40))))
            planted.append([(40, 100), (100 + gap, 160 + gap)])
        one, two = words_of(rng, 60, "a"), words_of(rng, 60, "b")
    for middle in (100, 140, 200, 400):  # near copies whose middle was written anew
        half = (500 - middle) // 2
        docs.append((len(docs), " ".join(copy)))
        docs.append((len(docs), " ".join(copy[:half] + own(middle) + copy[500 - half :])))
        planted += [[], [(0, half), (500 - half, 500)]]
        copy = words_of(rng, 500, "c")
    # A changed stretch between two short ones stays within its passage.
    short = words_of(rng, 60, "s")
    docs.append((len(docs), " ".join(own(30) + short + own(30))))
    docs.append((len(docs), " ".join(own(30) + short[:25] + own(10) + short[35:] + own(30))))
    planted += [[], [(30, 90)]]
    got = {}
    for r in repeated_passages(documents(*docs)).collect():
        assert r.match_doc_id == r.doc_id - 1 and r.n_equal >= 0.7 * (r.end_word - r.first_word)
        got.setdefault(r.doc_id, set()).add((r.passage_first, r.passage_end))
    for i, want in enumerate(planted):
        assert sorted(got.get(i, [])) == (want if i % 2 else []), i


def test_passages_whose_seeds_have_other_first_holders(documents):
    rng = random.Random(12)
    hashes = passages.WordHashes()
    docs, planted = [], {}
    for n in (50, 55, 60, 60):
        shared = words_of(rng, n, "p")
        pair = [words_of(rng, 80, "b") + shared + words_of(rng, 80, "b") for _ in range(2)]
        for words in pair:  # each seed by itself in an earlier document
            for at in passages.seeds(hashes.of(" ".join(words)))[1].tolist():
                if 80 <= at <= 72 + n:
                    docs.append((len(docs), " ".join(words[at : at + 8])))
        for words in pair:
            docs.append((len(docs), " ".join(words)))
        planted[len(docs) - 1] = (len(docs) - 2, 80, 80 + n)
    got = {r.doc_id: (r.match_doc_id, r.passage_first, r.passage_end) for r in repeated_passages(documents(*docs)).collect()}
    assert got == planted


def test_passages_edges(documents, edges, nothing):
    assert repeated_passages(nothing).count() == 0
    assert repeated_passages(edges).count() == 0
    chant = documents((1, "x y " * 90), (2, "a b c " + "x y " * 50 + "d"), (3, "x y " * 9))
    assert {r.doc_id for r in repeated_passages(chant).collect()} == {2}
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents((1, text), (1, text), (2, text), (None, text), (3, f"{text} {text}"))
    got = sorted((r.doc_id, r.passage_first, r.passage_end) for r in repeated_passages(docs).collect())
    assert {g[0] for g in got} == {2, 3}
    assert got[0] == (2, 0, 60)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_gap_is_the_longest_common_subsequence():
    from coinstrata.llm.passages import _gap

    rng = random.Random(11)
    for size, words in ((6, 3), (40, 4), (40, 400), (200, 3), (200, 90)):
        for _ in range(30):
            a, b = ([rng.randrange(words) for _ in range(rng.randrange(size + 1))] for _ in "ab")
            assert _gap(a, b) == plain_lcs(a, b)


def test_long_gaps_take_little_time():
    import time

    from coinstrata.llm.passages import _gap

    rng = random.Random(12)
    started = time.time()
    for words in (50, 100_000):
        a, b = ([rng.randrange(words) for _ in range(30_000)] for _ in "ab")
        assert _gap(a, b) > 0
    assert time.time() - started < 20


def test_template_documents_make_few_candidates(spark, monkeypatch, tmp_path):
    """Documents that share half their shingles by a template are not held against each
    other, and near copies among them are still found."""
    import coinstrata.llm.probminhash as near

    rng = random.Random(13)
    template = " ".join(f"t{i}" for i in range(60))
    docs = [(i, template + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(56))) for i in range(2000)]
    docs += [(5000 + i, docs[7 * i][1].rsplit(" ", 1)[0] + " other") for i in range(50)]
    candidates = []
    plain = near._similar

    def counted(pairs, texts, similar):
        candidates.append(pairs.count())
        return plain(pairs, texts, similar)

    monkeypatch.setattr(near, "_similar", counted)
    out = near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    classes = {r.doc_id: r.class_id for r in out}
    assert all(classes[5000 + i] == 7 * i for i in range(50))
    assert sum(k == v for k, v in classes.items()) == 2000
    assert sum(candidates) < 8 * len(docs)


def test_ids_of_other_types(spark):
    from coinstrata.llm.probminhash import near_duplicates

    text = " ".join(f"w{i}" for i in range(100))
    rows = [("b", text), ("a", text + " more"), ("c", "else"), ("d", text)]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in out} == {
        "a": ("a", 3), "b": ("a", 3), "d": ("a", 3), "c": ("c", 1)
    }


def test_random_inserts_and_deletes_from_an_empty_index(documents):
    """Any sequence leaves the counts of the documents that are in; shards grow with them."""
    rng = random.Random(14)
    lines = [f"a line of text {i}" for i in range(60)]
    docs = {i: (i, "\n".join(rng.sample(lines, rng.randint(1, 12)))) for i in range(40)}
    index, held = LineIndex.build(documents(docs[0]).limit(0), keys_per_shard=10), {}
    assert index.counts.count() == 0 and index.shards == 1
    for turn in range(5):
        if turn % 3 == 2:
            gone = rng.sample(sorted(held), len(held) // 2)
            index = index.delete(documents(*[docs[i] for i in gone]))
            held = {i: d for i, d in held.items() if i not in gone}
        else:
            more = rng.sample([i for i in docs if i not in held], 10)
            index = index.insert(documents(*[docs[i] for i in more]))
            held |= {i: docs[i] for i in more}
        by_line = {}
        for i, (_, text) in held.items():
            for line in text.split("\n"):
                by_line.setdefault(line, set()).add(i)
        got = sorted((r.n_docs, r.keeper) for r in index.counts.collect())
        assert got == sorted((len(ids), min(ids)) for ids in by_line.values())
        assert index.filters.agg({"n_keys": "sum"}).first()[0] == len(by_line)
    assert index.shards > 2


def test_lines_come_through_the_filters(documents, monkeypatch):
    """A filter that misses keys it holds makes them new ones, which the rows show."""
    text = "a line that both documents have\nand one of its own "
    rows = [(i, text + str(i)) for i in range(6)]
    assert sum(len(r.kept) for r in dedup_lines(documents(*rows)).collect()) == 7
    monkeypatch.setattr(CuckooFilter, "contains", lambda self, keys: np.zeros(len(keys), bool))
    assert sum(len(r.kept) for r in dedup_lines(documents(*rows)).collect()) != 7
