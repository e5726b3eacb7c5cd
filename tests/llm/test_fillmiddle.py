import hashlib
import random
import re

import pytest

from textmill.llm import fillmiddle
from textmill.llm.fillmiddle import Middle, digest_middles, fill_in_middle

DOCS = "doc_id long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, seed=7, percent=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def sample(n):
    r = random.Random(8)
    pool = ["\n", "\n\n", "a line\n", "ünï 日本 𝒳", "<", "<S", "<M\n", "P>", ">", "<<", "\r\n", "word ", "\x00", "x" * 50]
    rows = [(i, "".join(r.choice(pool) for _ in range(r.randint(0, 30)))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "has <S> in it\nand more\n"), (None, "no\nid\n"), (None, None), rows[1], rows[1]]
    rows += [(n + 3, "y" * 100_000 + "\n" + "short\n" * 20_000), (n + 4, "\n" * 30_000), (n + 5, "日" * 30_000)]
    return rows


@pytest.mark.parametrize("size", [8 << 10, 3])
def test_outputs_and_their_digests(spark, monkeypatch, size):
    monkeypatch.setattr(fillmiddle, "PIECE_BYTES", size)
    rows = sample(300) if size > 10 else [x for x in sample(150) if len(x[1] or "") < 2000]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS row", "2 AS position", "'x' AS piece", "'y' AS form").repartition(5)
    expected = sorted((brute(*x) for x in rows), key=str)
    assert sorted((tuple(r) for r in fill_in_middle(docs).collect()), key=str) == expected
    texts = sorted(((*brute(*x)[:5], sha(brute(*x)[5]), sha(x[1] or "")) for x in rows), key=str)
    assert sorted((tuple(r) for r in digest_middles(docs).collect()), key=str) == texts


def test_shares_and_seed(spark):
    rows = sample(200)[:200]
    docs = spark.createDataFrame(rows, DOCS)
    found = fill_in_middle(docs, Middle(11, 60, 0)).collect()
    assert {r["doc_id"]: tuple(r) for r in found} == {x[0]: brute(*x, 11, 60, 0) for x in rows}
    assert {r["form"] for r in found} == {"plain", "psm"}


def test_markers_that_cannot_be_found_again(spark):
    for marks in (("<P>", "<P>", "<M>"), ("<P>", "<<P>", "<M>"), ("aa", "ab", "ac"), ("", "<S>", "<M>"), ("<P>", "[S]", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle(spark.createDataFrame([], DOCS), Middle(markers=marks))


def test_texts_move_through_one_shuffle(spark, capsys):
    docs = spark.createDataFrame([(1, "a\nb")], DOCS)
    digest_middles(docs).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2


def test_an_empty_table(spark):
    assert fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []
    assert digest_middles(spark.createDataFrame([], DOCS)).collect() == []
