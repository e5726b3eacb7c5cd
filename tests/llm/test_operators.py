import hashlib
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm.extraction import BlockLabeller, Features, extract_main_text, fit_labeller, labelled, leaves, training_pages
from textmill.llm.fingerprints import BITS, fingerprint_edits, hex_fingerprint, near_fingerprints, simhash
from textmill.llm.language import Lattice, fit_languages, held_out, identify, read_pieces
from textmill.llm.mixing import mix_sources, source_targets
from textmill.llm.packing import fit_repeats, pack_documents, plan_sequences, vocabulary
from textmill.llm.revisits import attach_payload, canonical_url, merge_headers, resolve_revisits
from textmill.llm.topk import quantised, top_k

DOCS = "doc_id long, text string, source string, lang string"


def test_targets_are_filled_up_to_their_limits(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1), (None, 0)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in source_targets(sizes).collect()}
    # c and b stop at three times their size, a gets the rest; an empty source gets nothing.
    assert found == {"a": pytest.approx(78), "b": 30.0, "c": 3.0, None: 0.0}


def test_the_mix_takes_each_target_to_the_word(spark):
    rows = [(i, "w " * (i % 23), ["a", "b", "c", None][i % 7 % 4], "en") for i in range(400)] + [(3, None, "b", "en")] * 2
    found = mix_sources(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    sums = {}
    for r in found:
        key = (r["source_size"], r["target"])
        sums[key] = sums.get(key, 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(n - target) <= 0.5 for (_, target), n in sums.items())
    again = mix_sources(spark.createDataFrame(rows[::-1], DOCS).repartition(3)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    assert mix_sources(spark.createDataFrame([], DOCS)).collect() == []


FIELD = "struct<name:string,value:string>"
RECORDS = (
    "record_id long, url string, time long, kind string, status int, etag string, last_modified string, digest string, "
    f"headers array<{FIELD}>"
)


def test_revisits_find_the_latest_earlier_response(spark):
    own, new = [("ETag", "1"), ("Content-Length", "9"), ("Via", "x"), ("via", "y")], [("etag", "2"), ("content-length", "0")]
    rows = [
        (1, "http://www.A.com/x/", 10, "response", 200, '"v1"', None, "d1", own),
        (2, "https://a.com/x#f", 20, "response", 200, '"v2"', None, "d2", own),
        (3, "a.com/x", 20, "revisit", 304, 'W/"v1"', None, None, new),
        (4, "a.com/x?utm_source=q", 21, "revisit", 304, '"v2"', None, None, None),
        (5, "a.com/x", 25, "revisit", 304, '"v1"', None, None, new),
        (6, "a.com/x", 5, "revisit", 304, None, None, None, new),
        (7, None, 30, "revisit", 304, None, None, None, new),
        (8, "a.com/x", None, "revisit", 304, None, None, None, new),
        (9, "a.com/x", 40, "response", 503, '"v9"', None, "d9", own),
        (10, "a.com/x", 50, "revisit", 304, None, None, None, new),
        (11, "b.com", 50, "response", 200, None, "monday", "d", None),
        (12, "b.com/", 60, "revisit", 304, None, "monday", None, None),
    ]
    found = {r["revisit_id"]: r for r in resolve_revisits(spark.createDataFrame(rows, RECORDS)).collect()}
    assert {i: (r["outcome"], r["response_id"]) for i, r in found.items()} == {
        3: ("resolved", 1), 4: ("resolved", 2), 5: ("mismatch", None), 6: ("unresolved", None), 7: ("unresolved", None),
        8: ("unresolved", None), 10: ("unchecked", 2), 12: ("resolved", 11),
    }
    assert [tuple(h) for h in found[3]["headers"]] == [("Content-Length", "9"), ("Via", "x"), ("via", "y"), ("etag", "2")]
    payloads = spark.createDataFrame([(1, "one"), (2, "two")], "record_id long, payload string")
    beside = attach_payload(resolve_revisits(spark.createDataFrame(rows, RECORDS)), payloads).collect()
    assert {r["revisit_id"]: r["payload"] for r in beside}[10] == "two"
    assert resolve_revisits(spark.createDataFrame([], RECORDS)).collect() == []


def test_canonical_urls(spark):
    rows = [("HTTPS://user@WWW.a.Com:443/p/?utm_x=1&q=2&ref=z#t", "a.com/p?q=2"), ("m.b.org", "b.org"), ("http://a.com/p?", "a.com/p"), (None, None)]
    found = spark.createDataFrame(rows, "u string, e string").select(canonical_url(F.col("u")).alias("c"), "e").collect()
    assert [r["c"] for r in found] == [r["e"] for r in found]
    assert spark.range(1).select(merge_headers(F.lit(None), F.lit(None)).alias("h")).first()["h"] == []


def test_top_k_equals_sorting_all_scores(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(0, 0.3, 5).round(1)]) for i in range(150)]
    rows += [(150, None), (151, [0.1, None, 0.2, 0.3, 0.4]), (152, [float("nan")] * 5), (153, [1.0, 2.0]), (160, [3.0, -1.0]), (180, [])]
    q = quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = top_k(q.filter("id % 20 = 0"), q, 20).collect()
    usable = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows
              if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    expected = set()
    for i, own in usable.items():
        if i % 20 == 0:
            others = sorted((-int(own @ v), j) for j, v in usable.items() if j != i and len(v) == len(own))
            expected |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(others[:20])}
    assert {tuple(r) for r in found} == expected


def test_top_k_of_wide_values_and_repeated_rows(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(0, 0.3, 4).round(1)]) for i in range(40)]
    rows += [(50, [3e7, -1e7, 1.0, 0.0]), (60, [2e7, 0.0, 0.0, -2e7]), (61, [-2e7, 1e7, 2e7, 0.5]), (20, [0.5, 0.5, 0.0, 0.1]), (3, [0.5] * 4), (3, [0.5] * 4)]
    q = quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = Counter(tuple(x) for x in top_k(q.filter("id % 20 = 0"), q, 9).collect())
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows]
    expected = Counter()
    for i, own in whole:
        if i % 20 == 0:
            others = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), j) for j, v in whole if j != i)
            expected.update((i, n + 1, j, -s) for n, (s, j) in enumerate(others[:9]))
    assert found == expected
    with pytest.raises(Exception, match="too large"):
        quantised(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")).collect()
    empty = quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert top_k(empty, empty, 3).collect() == []


def test_fingerprints_of_edited_texts(spark):
    texts = ["the quick brown fox jumps over the lazy dog " * 3, "", None, "the quick brown fox", "häß 日本 words", "\n "]
    rows = [(10 * i, t) for i, t in enumerate(texts)] + [(90, texts[0])]
    found = {r["doc_id"]: r for r in fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    plain = [(i, t or "") for i, t in rows]
    for n, (i, t) in enumerate(plain):
        after = plain[(n + 1) % len(plain)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert found[i]["n_chars"] == len(t)
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert found[0]["fingerprint"] == found[90]["fingerprint"] and found[90]["near_next"] == 1.0
    assert found[10]["fingerprint"] == "0" * (BITS // 4)
    assert fingerprint_edits(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_near_documents_of_every_hundredth(spark):
    base = " ".join(f"word{i}" for i in range(400))
    texts = [base, base + " more", base, "other text altogether", None, "", base + " and more"]
    rows = [(100 * i if i % 2 == 0 else 7 * i + 1, t) for i, t in enumerate(texts)] + [(None, base), (200, "x y z"), (201, "x y z")]
    found = fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = [int(r["fingerprint"], 16) for r in found]
    for r, own in zip(found, prints, strict=True):
        near = sum((own ^ other).bit_count() <= 3 for other in prints) - 1
        assert r["n_near"] == (near if r["doc_id"] is not None and r["doc_id"] % 100 == 0 else None)
    assert sorted(r["n_near"] for r in found if r["n_near"] is not None)[-1] >= 2


def test_the_next_document_crosses_ranges_of_ids(spark):
    rows = [(i * i, f"text number {i} with words") for i in range(3000)]
    found = {r["doc_id"]: r for r in fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) == len(rows)
    for n, (i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        assert found[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()


def test_permuted_tables_find_all_within_the_radius(spark):
    r = np.random.default_rng(3)
    base = [int(x) for x in r.integers(-(2**62), 2**62, 8)]
    rows = []
    for i in range(120):
        two = [base[i % 8], base[(i + 1) % 8]]
        for bit in r.choice(BITS, int(r.integers(0, 6)), replace=False).tolist():
            two[bit // 64] ^= (1 << bit % 64) - (1 << 64) * (bit % 64 == 63)
        rows.append((i, two))
    table = spark.createDataFrame(rows, "id long, fingerprint array<long>")
    found = {(x["query_id"], tuple(x["fingerprint"])) for x in near_fingerprints(table, table, 3).collect()}
    apart = lambda a, b: sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a, b, strict=True))
    assert found == {(i, tuple(b)) for i, a in rows for _, b in rows if apart(a, b) <= 3}


def test_simhash_counts_votes(spark):
    rows = [(1, "x"), (2, "x x"), (3, " ")]
    found = {r["id"]: r["h"] for r in simhash(spark.createDataFrame(rows, "id long, t string"), "id", "t").select("id", hex_fingerprint(F.col("fingerprint")).alias("h")).collect()}
    one = spark.range(1).select(*[F.lower(F.hex(F.xxhash64(F.lit("x"), F.lit(p)))) for p in (0, 1)]).first()
    two = spark.range(1).select(*[F.lower(F.hex(F.xxhash64(F.lit("x"), F.lit("x"), F.lit(p)))) for p in (0, 1)]).first()
    assert found == {1: "".join(x.zfill(16) for x in one), 2: "".join(x.zfill(16) for x in two), 3: "0" * 32}


def test_plans_use_every_document_once():
    r = np.random.default_rng(1)
    histogram = {int(n): int(c) for n, c in zip(*np.unique(r.integers(1, 4097, 20_000), return_counts=True), strict=True)}
    plan = plan_sequences(histogram)
    used = {}
    for n, lengths in plan:
        assert n > 0 and sum(lengths) <= 4096
        for x in lengths:
            used[x] = used.get(x, 0) + n
    assert used == histogram
    # No sequence holds two documents of more than half of it, nor more than its length.
    least = max(sum(c for n, c in histogram.items() if n > 2048), -(-sum(n * c for n, c in histogram.items()) // 4096))
    # Uniform lengths are the hard case: about 1 % more than the bound.
    assert sum(n for n, _ in plan) <= 1.02 * least


def test_repeats_fit_an_exact_histogram():
    patterns = np.array([[1, 3, -1], [2, 2, -1], [1, 1, 2]])
    assert np.allclose(fit_repeats(np.array([0, 9, 8, 5, 0]), patterns, 2000)[0], 5, atol=0.3)


def test_packed_pieces_are_the_tokenised_texts(spark):
    from tokenizers import Tokenizer

    texts = ["Hello, World! don't  stop.", "", None, "é İ <|endoftext|> x\x1cy", "many words. " * 5000, "a b 日本語 I'LL 12,5."]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, "")] * 2
    found = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), with_ids=True).collect()
    whole = Tokenizer.from_file(vocabulary())
    pieces = {}
    for p in found:
        assert p["length"] == len(p["ids"]) <= 4096
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        pieces.setdefault(p["doc_id"], []).append(p)
    for i, t in enumerate(texts):
        own = sorted(pieces[i], key=lambda p: p["piece"])[:: 3 if i == 1 else 1]
        assert [x for p in own for x in p["ids"]] == [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        assert [p["start"] for p in own] == list(range(0, 4096 * len(own), 4096))
    by_sequence = {}
    for p in found:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_languages_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = identify(docs, fit_languages(docs))
    right = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    counts = right.agg(F.count("*").alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("k")).first()
    assert counts["n"] > 20 and counts["k"] >= 0.9 * counts["n"]
    assert found.filter("score < 0 or score > 1").count() == 0


def test_forward_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "aba", "▁a", "▁ab", "abababababababab", "▁"]
    lattice = Lattice(pieces)
    r = np.random.default_rng(1)
    probs = r.random((len(pieces) + 1, 3)) / 10

    def total(word):
        if not word:
            return np.ones(3)
        out = np.zeros(3)
        for n in range(1, len(word) + 1):
            i = pieces.index(word[:n]) if word[:n] in pieces else len(pieces) if n == 1 else None
            if i is not None:
                out = out + probs[i] * total(word[n:])
        return out

    words = ["", "a", "ab", "abab", "cab", "bac", "aba" * 3, "b" + "ab" * 8, "ccccc"]
    for places, chars in lattice.groups(words):
        found = np.exp(lattice.forward(chars, probs))
        assert np.allclose(found, [total("▁" + words[i]) for i in places], rtol=1e-9)
        # Expected uses: how the logarithm of the probability follows each piece's.
        uses = lattice.expected(chars, probs[:, 0], np.ones(len(places)))
        for i in range(len(pieces) + 1):
            more = probs.copy()
            more[i] *= 1 + 1e-6
            slope = (lattice.forward(chars, more)[:, 0] - lattice.forward(chars, probs)[:, 0]).sum() / 1e-6
            assert abs(slope - uses[i]) < 1e-3


def test_long_words_count(spark):
    r = np.random.default_rng(3)
    rows = []
    for i in range(60):
        rows.append((2 * i, "".join(chr(0x4E00 + c) for c in r.integers(0, 300, 150)), "s", "zh"))
        rows.append((2 * i + 1, "".join(chr(0xE01 + c) for c in r.integers(0, 40, 350)), "s", "th"))
    docs = spark.createDataFrame(rows, DOCS)
    model = fit_languages(docs)
    assert model.languages == ["th", "zh"]
    truth = {i: lang for i, _, _, lang in rows}
    found = identify(docs, model).collect()
    assert {x["doc_id"]: x["lang_pred"] for x in found} == truth
    lattice = Lattice(read_pieces(model.path))
    flat = np.full(lattice.size, 1 / lattice.size)
    lengths = np.append([len(p) for p in read_pieces(model.path)], 1)
    for word in ("中" * 100, "the" * 30, "qx" * 50):
        [(_, chars)] = lattice.groups([word])
        # The pieces of each segmentation cover the word and its mark.
        assert lattice.expected(chars, flat, np.array([3.0])) @ lengths == pytest.approx(3 * (len(word) + 1))


def test_texts_without_letters_have_no_language(spark):
    rows = [(i, t, None, lang) for i, (t, lang) in enumerate([("one two", "en"), ("uno dos", "es"), (None, "en"), ("12 ?!", "en"), ("two", None)] * 4)]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r["doc_id"]: r for r in identify(docs, fit_languages(docs)).collect()}
    assert {found[2]["lang_pred"], found[3]["lang_pred"]} == {"und"} and found[3]["score"] == 0
    kept = docs.select(held_out(F.col("doc_id")).alias("h"), "doc_id").collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in kept)
    assert identify(docs, fit_languages(docs.limit(0))).select("lang_pred").distinct().collect()[0][0] == "und"


def test_leaves_of_odd_markup():
    page = leaves('<p>a<p>b <i>c</i>&amp;d<br>e<script>if (1 < 2) "</p>"</script><ul><li>x<li>y</ul><!-- no --><td>z<div')
    assert [x.text for x in page] == ["a", "b c&d e", "x", "y", "z<div"]
    assert leaves("") == [] and leaves("<><//>")[0].text


@pytest.fixture(scope="module")
def model(spark, sf):
    return fit_labeller(spark.read.parquet(f"{sf}/pages.parquet"))


def test_articles_of_the_pages(spark, sf, model):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in extract_main_text(pages, model).collect()}
    truth = {r["page_id"]: "\n".join(x.text for x in leaves(r["html"]) if "article" in x.path) for r in pages.collect()}
    assert np.mean([found[i] == t for i, t in truth.items()]) > 0.97


def test_unseen_layouts(model):
    made = [labelled(p) for p in training_pages(["ein", "wort", "the", "word", "of", "pages"], 60, seed=77)]
    right = [((model.scores([Features(p)])[0] > 0.5) == t).mean() for p, t in made if p]
    assert np.mean(right) > 0.95


def test_gradients_are_those_of_the_loss():
    pages = [labelled(p) for p in training_pages(["a", "bc", "d"], 3)]
    net = BlockLabeller()
    before = net.scores([Features(pages[0][0])])[0]
    net.fit([Features(p) for p, _ in pages], [t for _, t in pages])
    after = net.scores([Features(pages[0][0])])[0]
    truth = pages[0][1]
    assert np.abs(after - truth).mean() < np.abs(before - truth).mean()


def test_empty_pages(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "v", "<html>" * 10)]
    found = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()
    assert [tuple(r) for r in found] == [(1, "u", "", 0), (2, None, "", 0), (3, "v", "", 0)]


class Reader(HTMLParser):
    """The text inside ``article`` elements, read by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"

    def handle_endtag(self, tag):
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.parts.append(data)


def test_leaves_hold_the_text_that_another_parser_finds(spark, sf):
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        reader = Reader()
        reader.feed(r["html"])
        own = "".join(x.text for x in leaves(r["html"]) if "article" in x.path)
        assert "".join(own.split()) == "".join("".join(reader.parts).split())


@pytest.mark.parametrize(
    "html", ["<a " * 350_000, "<a href='x " * 90_000, "<a" * 500_000, "<div class='c'>t" * 60_000, "<p>" + "<b>" * 100_000 + "<div>" * 50_000,
             "<div>" * 50_000 + "</x>" * 100_000, "<!" * 400_000, "\"<b '" * 200_000],
)
def test_broken_markup_takes_linear_time(html):
    began = time.process_time()
    leaves(html)
    assert time.process_time() - began < 20


def test_tags_without_an_end_are_text():
    assert [x.text for x in leaves("<p>one <b title='x>two</b> three")] == ["one <b title='x>two three"]
    assert [x.text for x in leaves("a < b <i and 'c' > d")] == ["a < b d"]
    assert leaves("") == [] and [x.text for x in leaves("<a")] == ["<a"]
