"""Near-duplicates, toxicity, language ID, surrogates and the pipeline against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from pastline.llm import langid, minhash, pii, toxicity
from pastline.llm.common import source_table
from pastline.llm.queries import QUERIES
from tests.conftest import SF001, SF01


def linked(rows, words, percent=80):
    """Smallest doc_id reachable, by comparing all pairs that share a shingle."""
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j:j + words]) for j in range(max(1, len(w) - words + 1))) if w else frozenset()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    by = defaultdict(list)
    for i in sorted(sets):
        near = Counter(j for s in sets[i] for j in by[s])
        for j, both in near.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        for s in sets[i]:
            by[s].append(i)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def test_near_dedup_equals_brute_force(spark):
    docs = source_table(spark, SF01, "documents", "doc_id", "text")
    comp, size = linked(docs.collect(), 2)
    got = {r.doc_id: r for r in QUERIES["op10_minhash_near_dedup"](spark, SF01).collect()}
    assert {i: r.component_id for i, r in got.items()} == comp
    assert {i: r.n_shingles for i, r in got.items()} == size
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_dedup_large_group_of_near_copies(spark, documents):
    """Copies with 0 to 14 % of the words changed: many pairs lie just under the threshold."""
    draw = random.Random(4)
    base = [f"w{draw.randint(0, 5000)}" for _ in range(120)]
    rows = []
    for i in range(400):
        w = list(base)
        for j in draw.sample(range(len(w)), draw.randint(0, 16)):
            w[j] = f"e{draw.randint(0, 30)}"
        rows.append((i, " ".join(w), "en", "s"))
    rows += [(400 + i, " ".join(base[:60] + [f"u{i}_{j}" for j in range(60)]), "en", "s") for i in range(200)]  # a passage in common
    comp, _ = linked(rows, 2)
    got = {r.doc_id: r.component_id for r in minhash.near_dedup(documents(rows), words=2).collect()}
    assert got == comp and len(set(comp.values())) > 200


def test_near_dedup_edges(documents, edge_rows):
    got = minhash.near_dedup(documents(edge_rows), words=2).collect()
    assert len(got) == len(edge_rows)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert by[4] == {(0, 4, True)} and by[5] == {(0, 5, True)} and by[6] == {(0, 6, True)}
    assert {c for _, c, _ in by[3]} == {1} and {c for _, c, _ in by[8] | by[7]} == {1}  # the same few shingles
    assert by[9] == {(1, 9, True)} and by[10] == {(1, 10, True)}
    assert minhash.near_dedup(documents([])).count() == 0


def test_block_overlaps_are_exact():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 3000, draw.integers(1, 900)).astype(np.uint64)) for _ in range(40)]
    got = minhash.overlaps(sets[:25], sets[10:], width=64)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets[:25]) for j, b in enumerate(sets[10:]))


def test_signature_agreement_is_the_similarity():
    m = minhash.MinMax(600, 2)
    a, b = np.arange(1, 101, dtype=np.uint64), np.arange(21, 121, dtype=np.uint64)
    a, b = np.sort(minhash._mix(a)), np.sort(minhash._mix(b))
    keys = m.bands([a, b])  # a band of one function: both its values agree
    assert abs((keys[0] == keys[1]).mean() - (80 / 120) ** 2) < 0.07


# -- toxicity -------------------------------------------------------------

def test_block_max_search_is_exact():
    draw = np.random.default_rng(2)
    examples = []
    for i in range(300):
        t = np.unique(draw.integers(0, 40, draw.integers(0, 9)))
        examples.append((i, int(i % 2), t.tolist(), draw.integers(1, 4, len(t)).tolist()))
    index = toxicity.BlockMaxIndex(draw.uniform(0.5, 3, 40), examples, block=16)
    for _ in range(50):
        t = np.unique(draw.integers(0, 40, 5)).tolist()
        tf = draw.integers(1, 4, len(t)).tolist()
        place, score = index.nearest(t, tf, 10)
        q = np.zeros(40, np.float32)
        q[t] = index.weights(t, tf)
        every = np.sort(index.vectors @ q)[::-1][:10]
        assert np.allclose(score, every[every > 0][:len(score)], atol=1e-5) and len(score) == min(10, (every > 0).sum())


def test_toxicity_on_held_out_labels(spark):
    got = {r.doc_id: r for r in toxicity.toxicity_query(spark, SF01).collect()}
    told = source_table(spark, SF01, "labels", "doc_id", "toxic").collect()
    test = [(got[r.doc_id], r.toxic) for r in told if got[r.doc_id].held_out]
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert not any(p.predicted and not y for p, y in test)
    assert sum(p.predicted for p, y in test if y) >= 0.6 * sum(y for _, y in test)


def test_toxicity_calibrates_on_both_classes(spark, documents):
    """More clean labels than examples and fewer toxic ones: either class has to reach the calibration."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("bcdfgklmnprst", k=7))
    plain = [word() for _ in range(400)]
    rows = [(i, " ".join([*draw.choices(plain, k=30), *(["vilest", "scumbags"] if i % 6 == 0 else [])]), "en", "s") for i in range(2700)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i, *_ in rows], "doc_id long, toxic int")
    got = toxicity.toxicity(documents(rows), labels).collect()
    assert all(r.predicted == (r.doc_id % 6 == 0) for r in got if r.held_out)


def test_toxicity_finds_neighbours_by_any_word(spark, documents):
    """No word is frequent in either class, yet a copy of an example has it as its nearest."""
    draw = random.Random(4)
    rows = [(i, " ".join("".join(draw.choices("bcdfgklmnprst", k=6)) for _ in range(20)), "en", "s") for i in range(60)]
    told = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    copies = [(1000 + i, t, "en", "s") for i, t, *_ in told]
    labels = spark.createDataFrame([(i, i % 2) for i, *_ in told], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(documents(told + copies), labels).collect()}
    assert all(got[1000 + i].evidence[0].doc_id == i and got[1000 + i].evidence[0].cosine > 0.999 for i, *_ in told)


def test_toxicity_edges(spark, documents, edge_rows):
    labels = spark.createDataFrame([(1, 1), (None, 1), (3, None), (3, 7)], "doc_id long, toxic int")
    got = toxicity.toxicity(documents(edge_rows), labels).collect()
    assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(documents([]), labels).count() == 0
    assert {r.score for r in toxicity.toxicity(documents(edge_rows), labels.limit(0)).collect()} == {0.0}


# -- language -------------------------------------------------------------

def test_language_on_held_out_rows(spark):
    docs = source_table(spark, SF01, "documents", "doc_id", "text", "lang")
    want = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in langid.identify_language(docs).collect() if r.held_out]
    assert np.mean([r.lang_pred == want[r.doc_id] for r in got]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(documents, edge_rows):
    got = langid.identify_language(documents(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    assert {r.lang_pred for r in got if r.doc_id in (4, 5, 6, 12)} == {"und"}
    assert langid.identify_language(documents([])).count() == 0
    assert {r.lang_pred for r in langid.identify_language(documents([(1, "text", None, "s")])).collect()} == {"und"}


# -- surrogates -----------------------------------------------------------

def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def test_surrogates_keep_type_format_and_identity(documents):
    rows = [
        (1, "Mail Ann.Lee42@mail.example.com or ann.lee42@mail.example.com, call +1 (988) 555-2485.", "en", "s"),
        (2, "Call (988) 555-2485; card 4041-8949 7460 8795; ip 42.144.35.254. SSN 123-45-6789", "en", "s"),
        (3, "Mrs. Anna Smith met Mr. John Smith and Г-жа Анна Иванова.", "en", "s"),
        (4, "nothing here 12 3.4", "en", "s"), (5, None, "en", "s"), (5, None, "en", "s"), (None, "ip 42.144.35.254", None, None),
    ]
    got = pii.surrogate_pii(documents(rows)).collect()
    t = {r.doc_id: r.text for r in got}
    mails = re.findall(r"\S+@\S+[a-z]", t[1])
    assert mails[0].lower() == mails[1] and re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z][a-z]{2}\d\d@[a-z]{4}\.[a-z]{7}\.com", mails[0])
    phone = re.search(r"\+1 (\(\d{3}\) \d{3}-\d{4})", t[1])[1]
    assert f"Call {phone};" in t[2] and phone != "(988) 555-2485"
    card = re.search(r"card (\d{4}-\d{4} \d{4} \d{4})", t[2])[1]
    assert card[0] == "4" and luhn(re.sub(r"\D", "", card)) and card != "4041-8949 7460 8795"
    ip = re.search(r"ip ([\d.]+)\. SSN \d{3}-\d\d-\d{4}$", t[2])[1]
    assert t[None] == f"ip {ip}" and ip != "42.144.35.254"
    m = re.fullmatch(r"Mrs\. ([A-Z][a-z]+) ([A-Z][a-z]+) met Mr\. ([A-Z][a-z]+) ([A-Z][a-z]+) and Г-жа ([А-Я][а-я]+) ([А-Я][а-я]+)\.", t[3])
    assert m[2] == m[4] != "Smith" and m[1].endswith("a") and m[3].endswith("o") and m[5].endswith("а")
    assert t[4] == rows[3][1] and t[5] is None and len(got) == 7
    assert {r.doc_id: r.n_entities for r in got} == {1: 3, 2: 4, 3: 3, 4: 0, 5: 0, None: 1}


def iban_ok(x):
    x = x.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def test_a_person_is_not_named_beside_the_surrogate(documents):
    text = ("Mrs Anna Weber called. Later Weber and Anna Weber wrote; Dr Anna Weber too. Annabel and Weberian stay. "
            "Tel +14155550123 and +33 6 12 34 56 78 and 4155550123.")
    other = "Prof Anna Berg, IBAN DE89 3704 0044 0532 0130 00, host 2001:db8:85a3::8a2e:370:7334 at 12:34:56, GB82WEST12345698765432."
    got = {r.doc_id: r.text for r in pii.surrogate_pii(documents([(1, text, "en", "s"), (2, other, "en", "s")])).collect()}
    m = re.fullmatch(r"Mrs (\w+) (\w+) called\. Later (\w+) and (\w+) (\w+) wrote; Dr (\w+) (\w+) too\. Annabel and Weberian stay\. "
                     r"Tel \+1(\d{10}) and \+33( \d(?: \d\d){4}) and (\d{10})\.", got[1])
    given, surname = m[1], m[2]
    assert given.endswith("a") and "Anna" != given and "Weber" != surname and given != surname
    assert (m[3], m[4], m[5], m[6], m[7]) == (surname, given, surname, given, surname)
    assert m[8] == m[10] != "4155550123" and m[9] != " 6 12 34 56 78"
    n = re.fullmatch(r"Prof (\w+) (\w+), IBAN (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d), host ([0-9a-f:]+) at 12:34:56, (GB\d\d[A-Z]{4}\d{14})\.", got[2])
    assert n[1] == given and n[2] != "Berg" and iban_ok(n[3]) and iban_ok(n[5]) and "3704 0044" not in n[3]
    assert [len(x) for x in n[4].split(":")] == [4, 3, 4, 0, 4, 3, 4] and "db8" not in n[4]


def test_names_are_one_space(documents):
    """Given names of either gender and surnames never share a surrogate, and none is a name that occurs."""
    names = ["Mr Bo Lee", "Mrs Bo Lee", "Mr Ba Bu", "Mrs Bi Be", "Dr Bu Ba", "Mrs Lee Bo"] + [f"Mr {a}{b} X{b}" for a in "BCD" for b in "aeiou"]
    got = pii.surrogate_pii(documents([(i, n, "en", "s") for i, n in enumerate(names)])).collect()
    to = {}
    for r in got:
        for a, b in zip(names[r.doc_id].split()[1:], r.text.split()[1:]):
            assert to.setdefault(a, b) == b
    assert len(set(to.values())) == len(to) and not set(to) & set(to.values())


def test_surrogates_stay_distinct(spark, documents):
    """Short names leave few values: first draws collide and are drawn again."""
    names = ["Mr. " + a + b for a in "BCDFGHKLMN" for b in "aeiou"]
    got = pii.surrogate_pii(documents([(i, n, "en", "s") for i, n in enumerate(names)])).collect()
    out = [r.text for r in got]
    assert len(set(out)) == len(names) and not set(out) & set(names)


def test_surrogates_never_run_out(documents):
    """Letters outside the sound classes, and more two-letter names than there are two-letter surrogates."""
    names = ["Mr Đỗ", "Mr Արամ"] + ["Mr " + a + b + " Lee" for a in "BCDFGH" for b in "aeiou"]
    out = [r.text for r in pii.surrogate_pii(documents([(i, n, "en", "s") for i, n in enumerate(names)])).collect()]
    assert len(set(out)) == len(names) and not set(out) & set(names)
    assert not any(set("ĐđỗỖ") & set(t) for t in out) and any(re.fullmatch("Mr [Ա-Ֆ][ա-ֆ]{3}", t) for t in out)


def test_surrogates_on_documents_and_edges(spark, documents, edge_rows):
    docs = {r.doc_id: r.text for r in source_table(spark, SF001, "documents", "doc_id", "text").collect()}
    mapped = {}
    for r in QUERIES["op9_pii_surrogates"](spark, SF001).collect():
        for a, b in zip(re.findall(r"[\w.]+@[\w.]+\w", docs[r.doc_id]), re.findall(r"[\w.]+@[\w.]+\w", r.text)):
            assert a.lower() != b.lower() and mapped.setdefault(a.lower(), b.lower()) == b.lower()
        assert len(re.findall(r"\S+", docs[r.doc_id])) == len(re.findall(r"\S+", r.text))
    assert mapped and len(set(mapped.values())) == len(mapped)
    got = pii.surrogate_pii(documents(edge_rows)).collect()
    assert len(got) == len(edge_rows) and not any("a@b.example.com" in (r.text or "") for r in got)
    assert pii.surrogate_pii(documents([])).count() == 0


# -- pipeline -------------------------------------------------------------

def test_pipeline_stages_equal_brute_force(spark):
    docs = source_table(spark, SF001, "documents")
    columns = docs.columns
    quality_rows = {r.doc_id: r.kept for r in QUERIES["op2_quality_rules"](spark, SF001).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {i for i in texts if quality_rows[i]}
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["quality_rules"](spark, docs, SF001)
    assert {r.doc_id for r in docs.collect()} == want and docs.columns == columns
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    best = {}
    for i in sorted(want):
        best[fold(texts[i])] = i
    want = set(best.values())
    docs = stages["exact_dedup"](spark, docs, SF001)
    assert {r.doc_id for r in docs.collect()} == want and docs.columns == columns
    comp, _ = linked([(i, texts[i]) for i in want], 5)
    want = {i for i in want if comp[i] == i}
    docs = stages["minhash_near_dedup"](spark, docs, SF001)
    assert {r.doc_id for r in docs.collect()} == want and docs.columns == columns
    docs = stages["secret_scans"](spark, docs, SF001)
    rows = docs.collect()
    assert {r.doc_id for r in rows} == want and docs.columns == columns
    for r in rows:
        assert not re.search(r"AKIA[A-Z0-9]{16}|(?i:password|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{6}", r.text)
        assert "[secret]" in r.text or r.text == texts[r.doc_id]
        assert r.n_chars == len(r.text)
    pieces = stages["packing"](spark, docs, SF001).collect()
    assert {p.doc_id for p in pieces} == want


def test_pipeline_runs_and_keeps_repeated_rows_once(spark, documents, edge_rows):
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF001).collect()}
    docs = documents(edge_rows)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        if name == "exact_dedup":
            assert Counter(r.doc_id for r in docs.collect())[1] == 0  # 3 has the same text
    assert docs.count() < len(edge_rows)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stage_on_an_empty_table(spark, documents, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, documents([]), SF001).count() == 0
