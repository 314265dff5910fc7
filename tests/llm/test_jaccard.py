import random
import re
from collections import Counter, defaultdict

import numpy as np

from setforge.llm.common import components
from setforge.llm.jaccard import can_link, can_link_wide, crossing, folded, jaccard_components, one_of_each, parity_of, prefix_of, shingles


def brute(rows):
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])
    lists, common = defaultdict(list), Counter()
    for doc_id, s in sets.items():
        for x in s:
            lists[x].append(doc_id)
    for ids in lists.values():
        common.update((a, b) for i, a in enumerate(ids) for b in ids[:i])
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return {d: (len(s), top(d)) for d, s in sets.items()}


def test_near_copies_against_all_pairs(spark):
    """Chains of near copies around the threshold, hot passages, exact copies, short texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(3))
    passage = [word() for _ in range(30)]
    rows = []
    for _ in range(25):
        text = [word() for _ in range(rng.choice([3, 5, 8, 30, 90]))]
        if rng.random() < 0.7:
            text = text + passage
        for _ in range(8):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = word().upper()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for bits, hubs in ((19, (1, 6)), (6, ())):  # few counters: the estimates say nothing, the result is the same
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, bits=bits, hubs=hubs).collect()}
        assert got == want
    assert sum(c != d for d, (_, c) in want.items()) > 50


def test_prefixes_meet():
    """Sets that link share as many kept keys as the smaller l asks, whatever the counters say."""
    rng = np.random.default_rng(0)
    for _ in range(300):
        counts = rng.integers(0, 50, 64)
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(-(2**63), 2**63, n))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(-(2**62), 2**62, int(rng.integers(0, 4)))]))
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 80 * (len(a) + len(b) - common):
            (la, x), (lb, y) = (prefix_of(s, counts, 5.0, 6, 80) for s in (a, b))
            assert len(np.intersect1d(x, y)) >= min(la, lb)


def test_odd_rows(spark, odd, nothing):
    got = [tuple(r) for r in jaccard_components(odd).collect()]
    assert len(got) == odd.count()
    assert sorted(x for x in got if x[0] == 1) == [(1, 18, 1)] * 2
    assert {x for x in got if x[0] in (2, 3, 4)} == {(2, 0, 2), (3, 0, 3), (4, 0, 4)}
    assert all(c is None for d, _, c in got if d is None)
    assert (5, 1, 5) in got
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 2), (False, 3), (False, 4), (False, 5), (False, 6), (False, 6), (True, 0), (True, 0)]
    assert jaccard_components(nothing).count() == 0 and one_of_each(nothing).count() == 0


def test_one_document_of_a_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(3, text), (1, text + " end"), (2, text.upper()), (9, "other words that link with nothing at all")]
    got = one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == [1, 9]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 199)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[200] == got[199] == 199


def test_bitmaps_leave_room_for_links(spark):
    """No pair that links is left out, whatever the bitmaps' sizes; pairs far apart are."""
    rng = np.random.default_rng(1)
    rows, near = [], []
    for k, n in enumerate([1, 4, 300, 500, 520, 1000, 1020, 1030, 2100, 5000] * 8):
        a = np.unique(rng.integers(-(2**63), 2**63, n))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.choice([0.6, 0.85, 0.95])], rng.integers(-(2**63), 2**63, int(n * rng.choice([0, 0.1])))]))
        if not len(b):
            continue
        share = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        rows.append((k, len(a), len(b), *(x.tolist() for s in (a, b) for x in (folded(parity_of(s)), parity_of(s)))))
        near.append((k, share))
    df = spark.createDataFrame(rows, "k long, a_n long, b_n long, a_parity array<long>, a_wide array<long>, b_parity array<long>, b_wide array<long>")
    for percent in (80, 45):
        few = {r.k for r in df.where(can_link(percent)).collect()}
        wide = {r.k for r in df.where(can_link_wide(percent)).collect()}
        linked = {k for k, share in near if 100 * share >= percent}
        assert linked and linked <= few and linked <= wide
        assert not wide & {k for k, share in near if 100 * share < percent - 12}


def test_hashes_tell_runs_of_words_apart():
    """As many distinct hashes as distinct runs: orders of few words, long blocks, words longer than a block."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(5)) for _ in range(200)]
    texts += [" ".join(rng.choice(["x", "yy", "zx", "\u00e9"]) for _ in range(3000)), "\n".join(str(i * i) for i in range(40_000)), "q" * 70_000 + " a b c d e", "q" * 70_001 + " a b c d"]
    for width in (1, 2, 5):
        runs = set()
        for text in texts:
            words = text.split()
            runs |= {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        assert len(set(np.concatenate([shingles(t.encode(), width) for t in texts]).tolist())) == len(runs)


def test_shingles_of_bytes():
    assert len(shingles(None)) == len(shingles(b" \t\n\x0b\x0c\r")) == 0
    assert len(shingles(b"a b c")) == 1 and len(shingles(b"a b c d e f")) == 2
    assert shingles(b"A b").tolist() == shingles(b"a\x0bB").tolist() != shingles(b"a b c").tolist()


def test_near_copies_meet_a_few_times(spark):
    """Members of a family share most lists; all their pairs come out, hardly one for each shared list."""
    rng = random.Random(7)
    kept = {k: sorted(t for t in range(60) if rng.random() < 0.85) for k in range(40)}
    kept |= {100: [3], 101: [59], 102: [200, 201], 103: [200, 201]}
    lists = spark.createDataFrame([(t, k, k) for k, tokens in kept.items() for t in tokens], "token long, node long, component long")
    nodes = spark.createDataFrame([(k, 60, [0] * 8) for k in kept], "node long, n long, parity array<long>")
    got = [(r.a, r.b) for r in crossing(lists, nodes, 80).collect()]
    want = {(a, b) for a in kept for b in kept if a < b and set(kept[a]) & set(kept[b])}
    assert set(got) == want
    assert len(got) <= 2 * len(want) < sum(len(set(kept[a]) & set(kept[b])) for a, b in want) / 10
