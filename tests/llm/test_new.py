"""Spelling variants, SimHash groups and the Merkle manifest against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from pastline.llm import merkle, simhash, spelling
from pastline.llm.components import components

FOLD = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)


# -- spelling variants ------------------------------------------------------

def brute_words(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in map(FOLD, re.findall("[A-Za-zÀ-ÿ]+", text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words):
    out, form = {}, {}
    for w, n in words.items():
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best
        out[w] = n, len(near)
    for w in words:
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, *out[w], words.get(form.get(w))


def mutated(draw, word):
    at, kind = draw.randrange(len(word)), draw.randrange(3)
    letter = draw.choice("abñÀÿxz")
    return word[:at] + (letter, letter + word[at], "")[kind] + word[at + 1:]


@pytest.mark.parametrize("heavy", [2, 64])
def test_spelling_variants_equal_brute_force(spark, documents, edge_rows, monkeypatch, heavy):
    monkeypatch.setattr(spelling, "HEAVY", heavy)
    draw = random.Random(3)
    base = ["separate", "necessary", "año" * 3, "banana" * 2, "Ààbcdef", "rhythm", "aaaaaa", "aaaaaaa", "ababab", "Straße" + "r" * 50]
    rows = list(edge_rows)
    for i in range(60):
        words = []
        for _ in range(120):
            w = draw.choice(base)
            for _ in range(draw.choice([0, 0, 0, 1, 1, 2])):
                w = mutated(draw, w)
            words.append(draw.choice([w, w.upper()]))
        rows.append((100 + i, draw.choice([" ", ", ", "1"]).join(words), "en", "s"))
    expected = list(brute_variants(brute_words(rows)))
    got = spelling.spelling_variants(documents(rows).repartition(4)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(expected) > 60 and any(f for _, f, *_ in expected)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


def test_grams_of_an_edited_word_survive():
    """The grams that ``affected`` leaves out stand in every edited word, at the same place or one further."""
    draw = random.Random(7)
    words = ["".join(draw.choices("abc", k=draw.randint(6, 9))) for _ in range(300)]
    n = Counter(w[i:i + q] for w in words for q in (2, 3) for i in range(len(w) - q + 1))
    grams = spelling.Grams({g: k for g, k in n.items() if len(g) == 2 or (n[g[:2]] > 20 and draw.random() < 0.6)})
    for w in words:
        spans = grams.cut(w)
        for gap in (False, True):
            for at, bits in enumerate(grams.affected(w, spans, gap)):
                for c in ("abcd" if gap else ["", *"abcd"]):
                    edited = w[:at] + c + w[at + (not gap):]
                    there = {(edited[s:e], s) for s, e in grams.cut(edited)}
                    for k, (s, e) in enumerate(spans):
                        if not bits >> k & 1:
                            assert (w[s:e], s + (len(edited) - len(w) if s >= at else 0)) in there
            assert grams.probes(w, spans, gap)


def test_spelling_of_an_empty_table(documents):
    assert spelling.spelling_variants(documents([]).limit(0)).collect() == []


def test_checksums_of_long_runs():
    texts = [b"a" * 5000 + b" " + b"b" * 49, "é".encode() * 60, b"", b"abcdef"]
    got = spelling.runs_counted([1, 2, 3, None], texts, drop=1)
    want = Counter()
    for i, t in zip(["1", "2", "3", ""], texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t.decode()):
            at = zlib.crc32(f"{i}:{run}".encode()) % len(run)
            if len(run) > 6:
                want[run[:at] + run[at + 1:]] += 1
    assert dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist())) == dict(want)


# -- SimHash ------------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", FOLD(text or ""))
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_groups(fps):
    """fingerprint -> representative of its component, over all pairs."""
    u = np.unique(np.array(list(fps), np.uint64))
    up = list(range(len(u)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i + 1:] ^ u[i]) <= 4).tolist():
            a, b = sorted((root(i), root(i + 1 + j)))
            up[b] = a
    return {int(u[i]): int(u[root(i)]) for i in range(len(u))}


@pytest.mark.parametrize("leaf", [3, 4096])
def test_simhash_groups(documents, edge_rows, leaf):
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = list(edge_rows)
    for g in range(25):
        text = draw.choices(vocabulary, k=draw.choice([3, 30, 200]))
        for c in range(draw.choice([1, 2, 12])):
            copy = list(text)
            for _ in range(draw.randint(0, 2)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append((1000 + 20 * g + c, " ".join(copy), "en", "s"))
    got = simhash.simhash_near_dedup(documents(rows).repartition(3), leaf).collect()
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    comp, low = brute_groups(fps), {}
    for f, (i, *_) in zip(fps, rows):
        if i is not None:
            low[comp[f]] = min(low.get(comp[f], i), i)
    want = [(i, f"{f:016x}", low.get(comp[f])) for f, (i, *_) in zip(fps, rows)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert simhash.simhash_near_dedup(documents([]).limit(0)).collect() == []


def test_dense_fingerprints(spark):
    """A cluster with thousands of fingerprints, split over many tasks, and links at the edge of the budget."""
    draw = random.Random(2)
    centres = [draw.getrandbits(64) for _ in range(12)]
    fps = {draw.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1}
    for k in range(2500):
        x = centres[0 if k % 3 else draw.randrange(12)]
        for b in draw.sample(range(64), draw.randint(0, 6)):
            x ^= 1 << b
        fps.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    links = simhash.trie_links(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), leaf=100)
    comp = {r.node & ((1 << 64) - 1): r.comp for r in components(links).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for x, c in brute_groups(fps).items():
        want[c].add(x)
        groups[comp.get(x, ("alone", x))].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_hub_and_a_chain(spark):
    edges = [(0, i) for i in range(1, 500)] + [(i, i + 1) for i in range(1000, 1200)] + [(2000, 2000), (499, 499)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(500)} | {i: 1000 for i in range(1000, 1201)}


# -- Merkle manifest ----------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    framed = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: H(*map(framed, (r[0], r[3], r[2], r[4], text)))

    def tree(level):
        """Root, and for each leaf its list of (left siblings, right siblings)."""
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for leaf_, k in enumerate(at):
                run = level[k // 3 * 3:k // 3 * 3 + 3]
                paths[leaf_].append(("".join(run[:k % 3]), "".join(run[k % 3 + 1:])))
            level = [H(*level[i:i + 3]) for i in range(0, len(level), 3)]
            at = [k // 3 for k in at]
        return level[0], paths

    sources = defaultdict(list)
    for r in rows:
        sources[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    root, tops = tree([trees[s][0] for s in order])
    for top, s in zip(tops, order):
        for (_, _, l, r), path in zip(sorted(sources[s], key=lambda x: x[:3]), trees[s][1]):
            broken = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            acc = leaf(r, r[1].replace("\n", "") if broken and r[1] is not None else r[1])
            for before, after in path + top:
                acc = H(before, acc, after)
            yield r[0], l, trees[s][0], root, H(*[b + a for b, a in path + top]), acc, acc == root


@pytest.mark.parametrize("tier", [1, 2, 5])
def test_manifest(documents, edge_rows, tier):
    rows = [(i, t and t.replace(" ", "\n", 2), l, s) for i, t, l, s in edge_rows]
    rows += [(i, f"line {i}\nline", "en", "hot") for i in range(100, 186)] + [(7, "x\n", None, "ü"), (8, "x\n", None, "z"), (9, "", None, "")]
    want = list(brute_manifest([(*r, len(r[1]) if r[1] is not None else None) for r in rows]))
    got = merkle.merkle_manifest(documents(rows).repartition(4), tier).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_one_row_and_of_none(documents):
    [row] = merkle.merkle_manifest(documents([(5, None, None, None)])).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == H("")
    assert merkle.merkle_manifest(documents([]).limit(0)).collect() == []
