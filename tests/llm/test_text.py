"""Language ID, extraction, url filter, decontamination, fingerprints."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tidemark.llm import decontaminate, extraction, fingerprints, language, url_filter

SF = "/root/testdata/sf0.01"


def phrases(text, sample):
    """Longest matches by substring search."""
    n = at = 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at : at + k + 1] in sample:
            k += 1
        n, at = n + 1, at + k
    return n


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("abcx", min_size=1, max_size=900), min_size=1, max_size=4), st.text("abc", min_size=70, max_size=120), st.sampled_from([1, 7, 64, 256]), st.sampled_from([1, 4096]))
def test_phrases_are_longest_matches(texts, sample, segment, together):
    """Whole texts, whatever the segments they are parsed in."""
    held = language.SEGMENT, language.TOGETHER
    language.SEGMENT, language.TOGETHER = segment, together
    try:
        samples = {"l": sample, "m": "zzz" * 30, "n": sample[::-1] + "xx"}
        found = language.Parser({k: [v] for k, v in samples.items()}).judge([None, *texts])[1:]
        for text, r in zip(texts, found, strict=True):
            counts = {k: phrases(text, v) for k, v in samples.items()}
            best = min(sorted(counts), key=counts.get)
            assert (r["lang"], round(r["phrases"] * len(text))) == (best, counts[best])
    finally:
        language.SEGMENT, language.TOGETHER = held


def test_a_phrase_over_many_segments():
    sample = "".join(random.Random(5).choices("abcdefgh", k=4000))
    parser = language.Parser({"l": [sample], "m": ["q" * 80]})
    text = sample[100:3000] + "xyz" + sample[7:1500]
    found = parser.judge([text, "q" * 999])
    assert round(found[0]["phrases"] * len(text)) == phrases(text, sample) == 5
    assert found[1]["lang"] == "m"


@pytest.mark.parametrize("alphabet", [0, 3, 124])
def test_every_letter_of_the_samples_counts(monkeypatch, alphabet):
    monkeypatch.setattr(language, "ALPHABET", alphabet)
    rng = random.Random(alphabet)
    scripts = {"han": (0x4E00, 2000), "hangul": (0xAC00, 900), "greek": (0x3B1, 17), "latin": (97, 26), "gothic": (0x10330, 17)}
    samples, tries = {}, []
    for lang, (first, letters) in scripts.items():
        lexicon = ["".join(chr(first + rng.randrange(letters)) for _ in range(rng.randrange(2, 6))) for _ in range(300)]
        samples[lang] = [" ".join(rng.choices(lexicon, k=400))]
        tries += [(lang, " ".join(rng.choices(lexicon, k=20))) for _ in range(5)]
    tries += [(None, " ".join(x.split()[0] for _, x in rng.sample(tries, 6))) for _ in range(20)] + [(None, "\u4dff\u3400 \u4e00\u4e00a")]
    parser = language.Parser(samples)
    for lang, text in tries:
        text = f"{text} {text}"
        found = parser.judge([text])[0]
        counts = {k: phrases(text, sample[0]) for k, sample in samples.items()}
        best = min(sorted(counts), key=counts.get)
        assert (found["lang"], round(found["phrases"] * len(text))) == (best, counts[best])
        assert lang in (None, best)
        assert lang is None or found["phrases"] < language.MOST_PHRASES


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language.op7_language_id(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    tried = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in tried) > 0.97 * len(tried)


def test_sample_is_bounded_where_ids_repeat(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 3)
    monkeypatch.setattr(language, "Parser", lambda samples: samples)
    free = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5]
    rows = [(free[0], f"text {k}", "en") for k in range(40)] + [(free[1], "same", "de")] * 40 + [(free[0], "mot", "fr"), (free[1], "mots", "fr")]
    got = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3))
    assert {k: len(v) for k, v in got.items()} == {"en": 3, "de": 3, "fr": 2}
    assert len(set(got["en"])) == 3 and set(got["de"]) == {"same"} and sorted(got["fr"]) == ["mot", "mots"]


def test_language_of_odd_rows(spark, odd, none):
    parser = language.fit(odd)
    got = language.identify(odd, parser).collect()
    for r in got:
        assert (r.language.lang == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert {r.language.lang for r in language.identify(odd, language.fit(none)).collect()} == {"und"}
    assert language.accepted(odd, parser).columns == odd.columns
    assert language.identify(none, parser).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="x"><header>Site name</header>
<nav><ul><li><a href=/>Home</a><li><a href=/b>News, and more.</a></ul></nav><div class="ad">Buy this, now. Really, do.</div>
<div id="cookie-notice">We use cookies. Accept, please.</div>
<div class="post"><h1>A title</h1><p>First &amp; <b>bold</b>ly written, as it goes on.<br>New line, with a nbsp&nbsp;here.<p>Second one,
with   spaces &#228; &lt;tag&gt;. And more, more, more.<ul><li>An item, too.</ul></div>
<div class="comments"><p>I disagree, strongly. Very much so.</p></div><aside>Related, things.</aside><form>Name: <input></form><footer>(c) me, 2024.</footer>"""


def test_extracts_the_article():
    text = extraction.main_text(PAGE)
    assert text == "A title First & boldly written, as it goes on. New line, with a nbsp here. Second one, with spaces ä <tag>. And more, more, more. An item, too."
    assert extraction.main_text(None) == extraction.main_text("") == extraction.main_text("<nav>x</nav>") == ""
    assert extraction.main_text("just text, no marks") == "just text, no marks"
    assert extraction.main_text("<p>open <!-- never closed") == "open"
    assert extraction.main_text('<p>a < b, <c and <a href="x') == 'a < b, <c and <a href="x'


ARTICLE = "<h1>A title here</h1><p>First one, with commas, and a long enough text to count. Again.</p><p>Second, also long, with marks; it goes on.</p>"
TITLED = "A title here First one, with commas, and a long enough text to count. Again. Second, also long, with marks; it goes on."
AROUND = '<html><body><nav><ul><li><a>x</a></ul></nav><div class="ad">Buy now, cheap. Really.</div>%s<div id="comments"><div class="comment"><p>I like, really, this. So good.</p></div></div><div class="cookie-banner">We use cookies, ok? Yes.</div><footer>c 2020, all, rights.</footer></body></html>'


@pytest.mark.parametrize("around", ['<div class="content has-sidebar">%s</div>', '<article class="overflow-hidden">%s</article>', '<div class="side-by-side">%s</div>', '<main class="site search-enabled">%s</main>', '<div class="post share-buttons-top">%s</div>', '<div class="comments">%s</div>'])
def test_names_alone_dont_empty_a_page(around):
    assert TITLED in extraction.main_text(AROUND % around % ARTICLE)
    if "comments" not in around:
        assert extraction.main_text(AROUND % around % ARTICLE) == TITLED


def test_parts_of_an_article_stay():
    parts = '<article><header class="entry-header header"><h2>Big title</h2></header>%s<ul><li><a href=x>one link</a></li><li><a href=y>two</a></li></ul><table><tr><td>1</td><td>2</td></tr></table></article>'
    assert extraction.main_text(AROUND % parts % ARTICLE) == f"Big title {TITLED} one link two 1 2"


def test_ratios_choose(monkeypatch):
    """Without the threshold, or with one that only long text passes, results change."""
    pages = [h for (h,) in duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet'").fetchall()]
    whole = [extraction.main_text(h) for h in pages]
    monkeypatch.setattr(extraction, "THRESHOLD", 0.0)
    assert all(a != extraction.main_text(h) for a, h in zip(whole, pages, strict=True))
    plain = AROUND.replace(' class="ad"', "").replace(' class="cookie-banner"', "") % '<div class="x">%s</div>' % (ARTICLE * 3)
    monkeypatch.setattr(extraction, "THRESHOLD", 0.3)
    assert extraction.main_text(plain) == " ".join([TITLED] * 3)


@pytest.mark.parametrize("mark", ["<a ", '<a "', "<a b='", '<a ="', "<div>", "</div><x>", "<!--", "<script>", "<li><ul><x>", "<p>x"])
def test_broken_pages_take_linear_time(mark):
    import time

    began = time.process_time()
    extraction.main_text(mark * (400_000 // len(mark)) + ">")
    assert time.process_time() - began < 10


def test_articles_of_the_pages(spark):
    rows = extraction.op3_tag_path_extract(spark, SF).collect()
    html = {i: h for i, h in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()}
    for r in rows:
        body = re.sub(r"</?(?:b|i|em|a)\b[^>]*>", "", re.search("<article>(.*?)</article>", html[r.page_id], re.S)[1])
        want = " ".join(extraction.entities.unescape(re.sub("<[^>]*>", " ", body)).split())
        assert r.text == want and r.n_chars == len(want)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("<>/pdivbr &;!-'\"=anav \n"), max_size=80))
def test_any_markup_is_read(page):
    assert isinstance(extraction.main_text(page), str)


def test_url_rules(spark):
    urls = ["http://a.example.org/en/12", "https://example.org/es/", "x://ORG", "http://org.com/de/x", "http://b.com/fr/?/de/", "no url", None, "http://forg/x", "://com/de/", "http://notexample.org/es/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id bigint, url string")
    rules = spark.createDataFrame([(h, p, v) for v, h, p in url_filter.LISTED], url_filter.RULES_SCHEMA)
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got[0] == ("a.example.org", "example.org/en/1", "block") and got[1][1:] == ("example.org/es/", "block")
    assert got[2] == ("org", None, "allow")  # no path: /-rules don't fit
    assert got[3][1:] == ("com/de/", "block") and got[4][1:] == ("com/fr/", "allow")
    assert got[5] == ("", None, "allow") == got[6] and got[7][1] is None and got[8][1:] == ("com/de/", "block")
    assert got[9][1:] == ("org/", "allow")
    assert url_filter.filter_urls(pages, rules).count() == 11
    none = spark.createDataFrame([], url_filter.RULES_SCHEMA)
    assert {r.verdict for r in url_filter.filter_urls(pages, none, default="block").collect()} == {"block"}
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").lower())


def brute_leaks(docs, items):
    """(doc_id, item_id) with a window of 0.8 similarity."""
    out = set()
    for d, text in docs:
        w = words(text)
        for k, item in items:
            v = words(item)
            size = min(5, len(v))
            if not v:
                continue
            grams = lambda x, s=size: Counter(tuple(x[i : i + s]) for i in range(len(x) - s + 1))
            g = grams(v)
            for i in range(len(w) - len(v) + 1):
                c = grams(w[i : i + len(v)])
                shared = sum((c & g).values())
                if shared >= 0.8 * (sum(c.values()) + sum(g.values()) - shared):
                    out.add((d, k))
                    break
    return out


def test_leaks(spark, odd, none):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(90)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([2, 5, 20, 45])))) for k in range(12)] + [(50, None), (51, "")]
    docs = []
    for d in range(40):
        parts = [word() for _ in range(60)]
        item = items[d % 12][1].split()
        if d % 3:
            for _ in range(d % 4):
                item[rng.randrange(len(item))] = "changed"
        docs.append((d, " ".join(parts[:30] + item + parts[30:])))
    docs += [(90, None), (91, ""), (92, "WORD " * 3)]
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect()} == want
    assert {r.doc_id for r in decontaminate.clean(frame, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert decontaminate.leaks(odd, bench.limit(0)).count() == 0 == decontaminate.leaks(none, bench).count()
    assert decontaminate.clean(odd, bench).columns == odd.columns


def brute_short_leaks(docs, items):
    """(doc_id, item_id) of texts that have fewer words than an item and a similarity of 0.8 with it."""
    out = set()
    for d, text in docs:
        for k, item in items:
            w, v = words(text), words(item)
            c, g = (Counter(tuple(x[i : i + min(5, len(v))]) for i in range(len(x) - min(5, len(v)) + 1)) for x in (w, v))
            shared = sum((c & g).values())
            if len(w) < len(v) and shared and shared >= 0.8 * (sum(c.values()) + sum(g.values()) - shared):
                out.add((d, k))
    return out


def test_texts_shorter_than_an_item(spark):
    rng = random.Random(9)
    items = [(k, " ".join(f"w{rng.randrange(70)}" for _ in range(n))) for k, n in enumerate([2, 4, 5, 6, 9, 10, 14, 30, 55, 55])]
    texts = []
    for _, item in items:
        w = item.split()
        texts += [w[:n] for n in range(len(w))] + [w[n:] for n in range(len(w))]
        texts += [w[:n] + w[n + 1 :] for n in range(len(w))] + [w[: n - 2] + ["changed"] + w[n:-1] for n in range(2, len(w))]
    docs = [(d, " ".join(w)) for d, w in enumerate(texts)] + [(-1, "a " * 70), (-2, None)]
    items += [(k, "a " * n) for k, n in ((20, 75), (21, 95))] + [(22, None), (23, "")]
    index = decontaminate.Index([i for i in items if i[1]])
    found = {(d, f[0]): f for d, text in docs for run in decontaminate.word_runs(pa.array([text], pa.string()), fold=True) for f in index.search(run.hashes)}
    sizes = dict((d, len(words(text))) for d, text in docs)
    want = brute_leaks(docs, items) | brute_short_leaks(docs, items)
    assert set(found) == want and len(brute_short_leaks(docs, items)) > 100
    assert all(f[2:] == (0, sizes[d]) for (d, k), f in found.items() if sizes[d] < len(words(dict(items)[k])))
    few = [(d, text) for d, text in docs if d % 7 == 0 or d < 0]
    assert {r.doc_id for r in decontaminate.clean(spark.createDataFrame(few, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()} == {d for d, _ in few} - {d for d, _ in want}


def test_windows_beyond_the_radius(spark, tmp_path):
    """Runs of two words shift a few shingles and half of all bits: such windows are counted exactly."""
    items = [(k, "x " * a + "y " * b) for k, (a, b) in enumerate([(41, 49), (60, 50), (20, 30), (9, 4)])] + [(9, "p q r s t")]
    docs = [(0, "x " * 49 + "y " * 41), (1, "c d " * 40 + "x " * 49 + "y " * 41 + "c d " * 40), (2, "X " * 50 + "y " * 60), (3, "x " * 30 + "y " * 20), (4, "x " * 200), (5, "p q r s t"), (6, "c d " * 60)]
    index = decontaminate.Index(items)
    assert np.bitwise_count(index.prints[0] ^ decontaminate.Index(docs[:1]).prints[0]) > decontaminate.RADIUS
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_leaks(docs, items) | brute_short_leaks(docs, items)
    assert (0, 0) in want and (1, 0) in want
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect()} == want
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    left = corpus_pipeline.decontaminate_stage(spark, frame, str(tmp_path))
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_one_index_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS_TOGETHER", 2)
    events, made, spread = [], decontaminate.Index.__init__, decontaminate.checkpointed
    monkeypatch.setattr(decontaminate.Index, "__init__", lambda self, items: events.append(len(items)) or made(self, items))
    monkeypatch.setattr(decontaminate, "checkpointed", lambda df: events.append("kept") or spread(df))
    items = [(k, f"item {k} has some words of its own {k}") for k in range(5)]
    docs = [(k, t) for k, t in items] + [(9, "clean text"), (9, None), (9, "clean text")]
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string").coalesce(1)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect()) == [(k, k) for k in range(5)]
    assert sorted(str(r.text) for r in decontaminate.clean(frame, bench).collect()) == ["None", "clean text", "clean text"]
    assert events == [2, "kept", 2, "kept", 1, "kept"] * 2


def paragraphs(text):
    return {p.strip(" ") for p in re.split(r"(?<=[.!?])[ \t\n\x0b\f\r]+|[\r\n]+", text) if p.strip(" ")}


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_prints(rows):
    out = {}
    for i, (d, x) in enumerate(rows):
        y = rows[(i + 1) % len(rows)][1]
        k = len(x) // 3
        e = x[: len(x) - k] + y[:k]
        out[d] = (len(x), hashlib.sha256(e.encode()).hexdigest(), round(alike(paragraphs(x), paragraphs(e)), 9), round(alike(paragraphs(x), paragraphs(y)), 9))
    return out


@pytest.mark.parametrize("ranges", [2000, 7])
def test_fingerprints(spark, monkeypatch, ranges):
    monkeypatch.setattr(fingerprints, "RANGE_DOCS", ranges)
    rng = random.Random(3)
    rows = [(i * 3, " ".join(f"S{rng.randrange(400)} has é words." for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(40)]
    rows += [(200, rows[0][1]), (201, rows[7][1])]
    rows.sort(reverse=True)
    found = fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in found} == brute_prints(rows)
    texts = dict(rows)
    assert len({(texts[r.doc_id], r.fingerprint) for r in found}) == len(set(texts.values()))


def test_fingerprints_of_odd_rows(spark, odd, none):
    assert fingerprints.fingerprint_documents(odd).count() == odd.count()
    assert fingerprints.fingerprint_documents(none).count() == 0
    one = fingerprints.fingerprint_documents(odd.filter("doc_id = 1")).first()
    assert one.near_next == 1.0 and one.near_edited <= 1.0


def test_long_regions_are_summed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SUMMED", 40)
    monkeypatch.setattr(decontaminate, "LOOKED_UP", 3)
    rng = random.Random(4)
    items = [(k, " ".join(f"w{rng.randrange(40)}" for _ in range(n))) for k, n in enumerate([5, 12, 30, 41, 90])]
    docs = [(d, " ".join(" ".join(rng.choice(items)[1].split()[rng.randrange(3) :]) for _ in range(12))) for d in range(8)]
    index = decontaminate.Index(items)
    run = next(iter(decontaminate.word_runs(pa.array([t for _, t in docs]), fold=True)))
    got = {(docs[i][0], f[0]) for i, words_ in decontaminate._texts(run) for f in index.search(words_)}
    assert got == brute_leaks(docs, items)


def test_many_items_in_one_turn(spark):
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randrange(5000)}" for _ in range(25))) for k in range(20_000)]
    docs = [(k, " ".join(["before it"] * 4 + [items[k][1]] + ["after it"] * 4)) for k in range(0, 20_000, 400)] + [(-1, "nothing of it at all")]
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert len(list(decontaminate._turns(bench))) == 1
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect()) == [(k, k) for k in range(0, 20_000, 400)]


def test_recall_of_fingerprints():
    """At a similarity of 0.8 and more, pairs further apart than RADIUS are very rare."""
    rng = np.random.default_rng(11)
    missed = tried = 0
    for n in (14, 25, 40, 80, 150, 300):
        for _ in range(60):
            words_ = rng.integers(0, 1 << 62, n).astype(np.uint64)
            other = words_.copy()
            for at in rng.integers(0, n, max(1, n // 50)):
                other[at] = rng.integers(0, 1 << 62)
            a, b = (decontaminate._grams(x, 5) for x in (words_, other))
            shared = len(np.intersect1d(a, b))
            if shared >= 0.8 * (len(a) + len(b) - shared):
                p, q = (decontaminate._packed(decontaminate._signs(x).sum(0, dtype=np.int64)[None])[0] for x in (a, b))
                tried, missed = tried + 1, missed + (np.bitwise_count(p ^ q) > decontaminate.RADIUS)
    assert tried > 150 and missed <= 1


def test_fingerprints_of_one_id(spark, monkeypatch):
    """Many rows of one id, and of none, follow each other by text hash over many ranges."""
    monkeypatch.setattr(fingerprints, "RANGE_DOCS", 5)
    texts = [f"Text number {i}. It says {i % 7}. End {i % 3}." for i in range(60)]
    frame = spark.createDataFrame([(7 if i % 3 else None, t) for i, t in enumerate(texts)] + [(9, "first of all. Yes."), (1, "then this.")], "doc_id bigint, text string")
    order = {r.text: r.h for r in frame.selectExpr("text", "xxhash64(text) AS h").collect()}
    rows = sorted(((r.doc_id, r.text) for r in frame.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), order[r[1]]))
    want = []
    for i, (d, x) in enumerate(rows):
        y, k = rows[(i + 1) % len(rows)][1], len(x) // 3
        want.append((d, len(x), hashlib.sha256((x[: len(x) - k] + y[:k]).encode()).hexdigest()))
    got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprints.fingerprint_documents(frame).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_url_ties_and_long_urls(spark):
    long = "http://a.b.example.org/en/1" + "x" * 50_000
    pages = spark.createDataFrame([(1, long, "r", "v"), (2, "http://t.net/aa", None, None), (3, None, None, None)] + [(4, "http://t.net/", None, None)] * 50, "page_id bigint, url string, rule string, key string")
    rules = spark.createDataFrame([("example.org", "/en/1", "block"), ("t.net", "/a", "allow"), ("t.net", "/a", "block"), ("net", "/aa", "block"), ("t.net", "/", "block")], url_filter.RULES_SCHEMA)
    got = {r.page_id: (r.path == long[22:] if r.page_id == 1 else r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got[1][1:] == ("example.org/en/1", "block") and got[3] == ("", None, "allow")
    assert got[2] == ("/aa", "t.net/a", "allow")  # longer host and path together, then the alphabet
    assert got[4] == ("/", "t.net/", "block") and url_filter.filter_urls(pages, rules).count() == 53
