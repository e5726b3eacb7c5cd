import random
import re
from collections import Counter, defaultdict

import pytest

from textmill.llm import divergence
from textmill.llm.divergence import audit_sources

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, lang string, source string"


def brute(rows, least=3, most=200):
    groups, totals, found = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        terms = Counter(re.findall(TERM, low))
        groups[lang, source].update(terms)
        totals[lang].update(terms)
        found[lang].update(terms.keys())
    out = set()
    for (lang, source), counts in groups.items():
        kept = [t for t, n in found[lang].items() if n >= least]

        def shares(of, kept=kept):
            n = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 1) // (n + len(kept)) for t in kept}

        own = shares(counts)
        pairs = []
        for (other_lang, other), more in groups.items():
            if other_lang == lang and other != source:
                q = shares(more)
                pairs.append((sum((own[t] - q[t]) ** 2 // q[t] for t in kept), other))
        whole = shares(totals[lang])
        terms = [((own[t] - whole[t]) ** 2 // whole[t], t) for t in kept if counts[t] and own[t] > whole[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            for rank, (value, item) in enumerate(items[: most if part == "term" else None], 1):
                out.add((lang, source, part, item, value, rank))
    return out


def sample(seed, n):
    r = random.Random(seed)
    words = ["the", "The,", "the-THE", "é", "É", "x\x00y", "日本 語", "a b", "1", "|", " ", "𝒳1𝒴", "Ünï", "ZZ"]
    words += [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = []
    for i in range(n):
        space = r.choice([" ", "\n", "\x0b\t", "  "])
        text = None if i % 19 == 5 else space.join(r.choice(words) for _ in range(r.randint(0, 40)))
        rows.append((i, text, r.choice(["en", "en", None, "", "fr"]), r.choice([None, "", "s", "t", "Ä", f"own{i % 9}"])))
    return rows + rows[:3] + [(n, "once only", "xx", "a"), (n + 1, "1 2 3", "xx", "b"), (None, None, "yy", "c")]


def plain(found):
    rows = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_audit_equals_counting_by_hand(spark):
    rows = sample(3, 150)
    assert plain(audit_sources(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_small_blocks_tiles_and_cells_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "CELL_ROWS", 40)
    monkeypatch.setattr(divergence, "PART_BYTES", 20)
    rows = sample(4, 120)
    found = plain(audit_sources(spark.createDataFrame(rows, DOCS).repartition(7), most_terms=5))
    assert found == brute(rows, most=5)


@pytest.mark.parametrize("least", [1, 10**6])
def test_other_bounds(spark, least):
    rows = sample(5, 40)
    assert plain(audit_sources(spark.createDataFrame(rows, DOCS), least)) == brute(rows, least)


def test_names_that_clash_and_empty_tables(spark):
    docs = spark.createDataFrame(sample(6, 30), DOCS)
    named = docs.selectExpr("*", "1 AS block", "2 AS term", "3 AS n", "4 AS rank", "5 AS chunks", "6 AS value")
    assert plain(audit_sources(named)) == plain(audit_sources(docs))
    assert audit_sources(spark.createDataFrame([], DOCS)).collect() == []


def test_one_very_long_text(spark):
    long = " ".join(["aa bb", "Cc"] * 400_000)
    rows = [(0, long, "en", "s"), (1, "aa cc", "en", "t"), (2, "aa bb cc dd", "en", "t")]
    assert plain(audit_sources(spark.createDataFrame(rows, DOCS))) == brute(rows)
