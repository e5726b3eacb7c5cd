import hashlib
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm import blocks
from textmill.llm.components import components
from textmill.llm.factors import factored, remove_copied_words
from textmill.llm.neardup import Shingles, alike, drop_near_duplicates, near_duplicates, near_links, signatures
from textmill.llm.suffixes import LENGTH, PERIOD, Stretches, remove_repeated_bytes, repeated_positions, sort_suffixes

WORDS = [f"w{i}" for i in range(30)] + ["é", "日本", "x."]
DOCS = "doc_id long, text string"


def text(r, n):
    return "".join(r.choice(WORDS) + r.choice([" ", "  ", "\n", "\t"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    r = random.Random(4)
    base = [text(r, r.randint(1, 200)) for _ in range(20)]
    out = []
    for i in range(70):
        k, b, c = r.random(), r.choice(base), r.choice(base)
        a = r.randint(0, len(b))
        made = [text(r, r.randint(0, 150)), b, b[:a] + c[r.randint(0, len(c)) :], "a" * r.randint(0, 700), b * 2, None, "ab c " * 90]
        out.append((None if i % 17 == 3 else 2 * (i - i % 2), made[int(k * len(made))]))
    return out


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 3000)


def test_copied_words_are_those_of_the_definition(spark, docs, small_blocks):
    order = lambda i: 2**63 - 1 if i is None else i
    words = [(i, (t or "").encode().split()) for i, t in docs]
    first = {}
    for i, w in words:
        for p in range(len(w) - 12):
            run = tuple(w[p : p + 13])
            first[run] = min(first.get(run, 2**64), order(i))
    expected = Counter()
    for i, w in words:
        gone = set()
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < order(i):
                gone.update(range(p, p + 13))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        expected[(i, len(w), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    found = remove_copied_words(spark.createDataFrame(docs, DOCS).repartition(4)).collect()
    assert Counter(tuple(x) for x in found) == expected
    assert sum(k[2] for k in expected) > 500


def test_factors_name_their_source(spark):
    w = [f"t{i}" for i in range(60)]
    rows = [(1, " ".join(w[:30])), (2, " ".join(w[25:60])), (3, " ".join(["new", *w[5:28], *w[30:50], "end"]))]
    from pyspark.sql import functions as F

    found = {r["doc_id"]: r for r in factored(spark.createDataFrame(rows, DOCS), F.struct("doc_id")).collect()}
    assert [tuple(f) for f in found[3]["factors"]] == [(1, 23, 1), (24, 20, 2)]
    assert found[3]["kept"] == "new end" and found[1]["kept"] == rows[0][1]


def test_repeated_bytes_are_those_of_the_definition(spark, docs, small_blocks):
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[p : p + 200] for _, b in raw for p in range(len(b) - 199))
    expected = Counter()
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        expected[(i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    found = remove_repeated_bytes(spark.createDataFrame(docs, DOCS).repartition(4)).collect()
    assert Counter(tuple(x) for x in found) == expected
    assert sum(k[2] for k in expected) > 5000


def test_lone_periodic_texts_repeat_themselves(spark):
    units = [b"-", b"ab", b"spam ", bytes(range(65, 96)), bytes(range(33, 126)) + b"1234567", bytes(range(33, 126)) * 2]
    bodies = [(unit * 400)[:n] for unit in units for n in range(200, 321)]
    found, rows = {}, []
    for i, body in enumerate(bodies):
        rows.append((i, body.decode()))
        seen = Counter(body[p : p + 200] for p in range(len(body) - 199))
        gone = {q for p in range(len(body) - 199) if seen[body[p : p + 200]] > 1 for q in range(p, p + 200)}
        block = SimpleNamespace(text=np.frombuffer(body, np.uint8), starts=np.array([0]), ends=np.array([len(body)]))
        assert Stretches(block).distinct_keys()[1].any() or not gone, (body[:10], len(body))
        found[i] = len(gone)
    # One text at a time, so that none is repeated by another one.
    for i in (2 * 121 + 50, 4 * 121 + 101):
        removed = remove_repeated_bytes(spark.createDataFrame([rows[i]], DOCS)).collect()
        assert [(r["doc_id"], r["n_removed"]) for r in removed] == [(i, found[i])]
        assert found[i] == len(bodies[i])


@pytest.mark.parametrize("alphabet", [1, 2, 26])
def test_the_cover_sorts_long_ties(alphabet):
    r = np.random.default_rng(alphabet)
    body = r.integers(97, 97 + alphabet, 900).astype(np.uint8)
    body[500:800] = body[100:400]
    data = np.concatenate([body, np.zeros(LENGTH + 2 * PERIOD, np.uint8)])
    at = np.arange(len(body))
    order, _ = sort_suffixes(data, at)
    keys = [bytes(data[p : p + LENGTH]) for p in order]
    assert keys == sorted(keys)
    at = np.arange(len(body) - LENGTH + 1)
    n = Counter(bytes(data[p : p + LENGTH]) for p in at)
    assert repeated_positions(data, at).tolist() == [p for p in at.tolist() if n[bytes(data[p : p + LENGTH])] > 1]


def test_signatures_estimate_the_weighted_similarity():
    a = [f"w{i}" for i in range(400)]
    b = a[:360] + [f"x{i}" for i in range(40)]
    found = Shingles(pa.array([" ".join(a), " ".join(b), " ".join(a * 2), "q", ""]))
    kept = signatures(found.doc, found.cells(), 5)
    assert abs((kept[0] == kept[1]).mean() - 356 / 436) < 0.08
    assert abs((kept[0] == kept[2]).mean() - 396 / 796) < 0.1
    assert (kept[3] != 0).all() and (kept[4] == 0).all()


def test_near_duplicates_miss_no_link(spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    base = [[r.choice(words) for _ in range(r.randint(3, 200))] for _ in range(25)]
    rows = []
    for i in range(200):
        t = list(r.choice(base))
        for _ in range(int(len(t) * r.choice([0, 0, 0.01, 0.02, 0.06]))):
            t[r.randrange(len(t))] = r.choice(words)
        rows.append((i, None if i % 40 == 7 else " ".join(t)))
    bags = []
    for _, t in rows:
        w = (t or "").split()
        bags.append(Counter([tuple(w[j : j + 5]) for j in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)]))
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and 5 * sum((bags[i] & bags[j]).values()) >= 4 * sum((bags[i] | bags[j]).values()):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    found = near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {x["doc_id"]: x["class_id"] for x in found} == dict(enumerate(label))
    assert sum(x["kept"] for x in found) == len(set(label))


def test_a_stranger_meets_the_texts_that_match_the_hub(spark):
    a = [f"w{i}" for i in range(400)]
    b = list(a)
    b[100:300:25] = [f"y{i}" for i in range(8)]
    other = [f"z{i}" for i in range(400)]
    for n in range(100):
        hub = [*a[:10], f"x{n}", *a[11:20], "x", *a[21:]]
        found = Shingles(pa.array([" ".join(t) for t in (hub, a, b, other)]))
        nodes = found.nodes.view(np.int64).tolist()
        if nodes[0] == min(nodes):
            break
    runs = np.split(found.runs, np.searchsorted(found.doc, [1, 2, 3]))
    assert [alike(runs[i], runs[j]) for i, j in ((0, 1), (1, 2), (0, 2))] == [True, True, False]
    texts = [(" ".join(t),) for t in (hub, a, b, other)]
    signed = spark.createDataFrame([(n, [7]) for n in nodes], "node long, bands array<long>")
    links = near_links(spark.createDataFrame(texts, "text string"), signed)
    stars = {r["a"]: r["b"] for r in components(links).collect()}
    assert stars == {nodes[1]: nodes[0], nodes[2]: nodes[0]}


def test_repeated_rows_leave_one(spark):
    rows = [(5, "a b c d e f g", 1), (5, "a b c d e f g", 1), (None, "a b c d e f g", 2), (7, "", 3), (8, None, 4), (7, "z", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long")
    kept = sorted((tuple(r) for r in drop_near_duplicates(docs).collect()), key=str)
    assert kept == [(5, "a b c d e f g", 1), (7, "", 3), (7, "z", 5)]


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7)]
    stars = {r["a"]: r["b"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert stars == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100}


@pytest.mark.parametrize("operator", [remove_copied_words, remove_repeated_bytes, near_duplicates])
def test_empty_tables_give_empty_results(spark, operator):
    assert operator(spark.createDataFrame([], DOCS)).collect() == []


def nodes_of(texts):
    return Shingles(pa.array(texts), False).nodes.view(np.int64)


def test_links_of_many_near_copies_stay_few(spark):
    base = [f"w{i}" for i in range(300)]
    copies = [" ".join([*base[: i % 300], f"x{i}", *base[i % 300 + 1 :]]) for i in range(1000)]
    others = [" ".join(f"z{i}-{j}" for j in range(300)) for i in range(3000)]
    # The hub of the band, its smallest node, is like none of the others.
    outlier = others[int(nodes_of(others).argmin())]
    nodes = nodes_of([outlier, *copies]).tolist()
    assert min(nodes) == nodes[0]
    signed = spark.createDataFrame([(n, [7]) for n in nodes], "node long, bands array<long>")
    links = near_links(spark.createDataFrame([(t,) for t in [outlier, *copies]], "text string"), signed).collect()
    assert len(links) < 2000
    assert {x for r in links for x in (r["a"], r["b"])} == set(nodes[1:])


def test_hashes_tell_repeated_patterns_apart(spark):
    # Words over two letters that a sum of powers modulo 2**64 cannot tell apart.
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, other = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    words = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join([one, *words])), (2, " ".join([other, *words]))]
    found = remove_copied_words(spark.createDataFrame(rows, DOCS)).collect()
    assert [r["n_removed"] for r in found] == [0, 0]
    texts = [" ".join(one), " ".join(other)]
    assert len(set(nodes_of([*texts, one, other]).tolist())) == 4
