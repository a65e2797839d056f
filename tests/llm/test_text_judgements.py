"""Language, quality, licenses, personal data, page text and vector search on small tables."""

import re

import numpy as np
import pytest

from corpus_engine.llm import langid, licenses, pages, pii, quality, rotated
from corpus_engine.llm.linear import calibration

SAMPLES = {
    "en": "the weather was fine and they went to the river with their dog before it rained again on the hills",
    "de": "das wetter war schön und sie gingen mit ihrem hund an den fluss bevor es wieder auf die hügel regnete",
    "fr": "le temps était beau et ils sont allés à la rivière avec leur chien avant que la pluie ne revienne",
    "es": "el tiempo era bueno y fueron al río con su perro antes de que volviera a llover sobre las colinas",
    "xx": "zuqa wiko pelu zuqa rimo wiko zuqa pelu rimo tasu wiko zuqa pelu tasu rimo zuqa wiko pelu",
}


def sentences(lang, n, seed):
    rng = np.random.default_rng(seed)
    words = SAMPLES[lang].split()
    return [" ".join(rng.choice(words, 25)) for _ in range(n)]


def test_languages_are_told_apart_on_held_out_texts(spark):
    known = [(i, t, lang) for lang in SAMPLES for i, t in enumerate(sentences(lang, 40, 1), 1000 * len(SAMPLES[lang]))]
    model = langid.train(spark.createDataFrame([*known, (1, None, "en"), (2, "text", None)], "doc_id long, text string, lang string"))
    assert set(model.languages) == set(SAMPLES)
    fresh = [(lang, t) for lang in SAMPLES for t in sentences(lang, 20, 2)]
    docs = spark.createDataFrame(
        [(i, t, "?", 0.5) for i, (_, t) in enumerate(fresh)] + [(900, None, "en", 1.0), (901, "", "en", 1.0), (902, "12 !?", "en", 1.0), (902, "12 !?", "en", 1.0)],
        "doc_id long, text string, lang_pred string, score double",
    )
    got = langid.identify(docs, model).collect()
    right = [r.lang_pred == fresh[r.doc_id][0] for r in got if r.doc_id < 900]
    assert np.mean(right) >= 0.98
    assert [(r.lang_pred, r.score) for r in got if r.doc_id >= 900] == [("und", 0.0)] * 4
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(docs.limit(0), model).count() == 0


def test_without_labels_every_language_is_unknown(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.identify(docs, langid.train(docs)).collect()] == ["und"]
    one = spark.createDataFrame([(1, "some text", "en"), (2, "7", "en")], "doc_id long, text string, lang string")
    assert sorted(r.lang_pred for r in langid.identify(one, langid.train(one)).collect()) == ["en", "und"]


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = text.split("\n")
    repeats = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


def test_quality_counts_and_verdicts(spark):
    good = [(i, " ".join(["fine", *sentences("en", 4, i)]), 1) for i in range(60)]
    junk = [(100 + i, " | ".join(sentences("xx", 4, i)), 0) for i in range(60)]
    odd = [(200, None), (201, ""), (202, "a b c a b c a b\nx\nx\n\n\n x"), (203, "é\x85b\xa0c # |"), (204, "word " * 30000), (204, "word " * 30000)]
    docs = spark.createDataFrame([(i, t, "p", True) for i, t, _ in good + junk] + [(*o, "p", False) for o in odd], "doc_id long, text string, probability string, kept boolean")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + junk] + [(None, 1), (5000, 0), (3, None)], "doc_id long, quality int")
    rows = quality.judge(docs, quality.train(docs, labels)).collect()
    assert len(rows) == len(good) + len(junk) + len(odd)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        if r.doc_id != 204:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(text[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
        assert r.base_failed or r.kept == (r.doc_id < 100)
    assert quality.train(docs, labels.where("quality = 1")) is None
    plain = quality.judge(docs, None).collect()
    assert all(r.probability is None and r.kept == (not r.base_failed) for r in plain)
    assert quality.judge(docs.limit(0), None).count() == 0


def test_calibration_of_separable_margins_is_finite():
    slope, offset = calibration(np.array([-3.0, -2, 2, 3]), np.array([0.0, 0, 1, 1]))
    assert 0 < slope < 100 and abs(offset) < 10


LICENSED = {
    1: ("Released under the MIT License.", "mit", "mit"),
    2: ("Licensed under CC BY-NC 4.0, cc-by-nc", "cc-by-nc", "cc-by-nc"),
    3: ("Licensed under the Apache License, Version 2.0.", "apache-2", "apache-2"),
    4: ("licensed under the GNU General Public License, version 3. A limit license", "", "gpl-3"),
    5: ("nothing here, an accident", "", ""),
    6: ("GNU General Public License v2 and the GNU Lesser General Public License", "", "gpl-2,lgpl"),
    7: (None, "", ""),
    8: ("", "", ""),
    9: ("under\nthe--MIT...license under the mit license", "mit", "mit"),
    10: ("under the Kmit license; premit license; mit licenses", "", ""),
}


def test_license_labels_and_positions(spark):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, (t, _, _) in LICENSED.items()] + [(1, LICENSED[1][0], "x", 0)], "doc_id long, text string, hits string, base int")
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(LICENSED) + 1
    for r in rows:
        text, base, labels = LICENSED[r.doc_id]
        words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        low = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
        starts = [i for p in licenses.BASE for i in range(len(low)) if low[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(starts), min(starts, default=None), max(starts, default=None))
        assert (r.base_labels, r.labels) == (base, labels)
        assert (r.score > 0) == bool(labels)
    assert licenses.scan(docs.limit(0)).count() == 0
    assert len(licenses.rules()) > 300


def test_contained_hits_of_lower_levels_are_dropped(spark):
    found = licenses.detect(spark.createDataFrame([(1, "licensed under the terms of the Mozilla Public License 2.0")], "doc_id long, text string"))
    kept = licenses.kept_hits(found).collect()
    assert [(r.label, r["first"], r["last"]) for r in kept] == [("mpl-2", 0, 10)]


def plain_pii(text):
    shapes = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, shape in shapes.items():
        for m in re.finditer(shape, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19 and pii.luhn(d),
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


PERSONAL = [
    "write to a.b+c@mail.example.com, x@y or @z.de; a@b.com_x@y.org é q@r.s.t.", "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 00000255.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 " + "7" * 4000, "+1 (017) 555-7713 +49 30 1234567890123456 +1+2", None, "", "@@@ ... +++", "1.1.1.1.1",
]


def test_plain_patterns_match_leftmost(spark):
    for text in PERSONAL:
        assert pii.base_spans(text) == plain_pii(text), text


def test_contexts_discover_identifiers(spark):
    rng = np.random.default_rng(4)
    rows = [(i, f"note {i} my mail: u{i}@example.com end") for i in range(30)]
    rows += [(100 + i, f"note my mail: user{rng.integers(10**6, 10**7)} end") for i in range(3)]
    rows += [(200 + i, f"the order no {rng.integers(10**6, 10**7)} end") for i in range(30)] + [(300, None), (0, rows[0][1])]
    docs = spark.createDataFrame([(*r, "b") for r in rows], "doc_id long, text string, base string")
    found = pii.find(docs, min_confidence=0.85).collect()
    assert len(found) == len(rows)
    for r in found:
        text = next(t for i, t in rows if i == r.doc_id)
        assert [tuple(s) for s in r.base] == plain_pii(text)
        assert bool(r.added) == (100 <= r.doc_id < 200)
    text = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert text[0] == "note 0 my mail: <email> end" and text[300] is None
    assert pii.redact(docs).columns == docs.columns
    assert pii.find(docs.limit(0)).count() == 0


def test_discovered_values_give_new_patterns_and_are_found_everywhere(spark):
    rows = [(i, f"note {i} my mail: u{i}@example.com end") for i in range(60)]
    rows += [(100 + i, f"note my mail: {7100000 + i} end") for i in range(6)]  # met by the first pattern
    rows += [(200 + i, f"with passport no {7100000 + i} here") for i in range(6)]  # the same ones elsewhere
    rows += [(300 + i, f"with passport no {8200000 + i} here") for i in range(3)]  # met by the second pattern
    rows += [(400, "8200001"), (401, "stands at 8200002 here")] + [(500 + i, f"the order no {9300000 + i} end") for i in range(30)]
    rows += [(600, "note my mail: 2019 end")] + [(610 + i, f"back in {w} of 2019 end") for i, w in enumerate("abc")]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got, text = {r.doc_id: r.added for r in found}, dict(rows)
    assert {i for i, spans in got.items() if spans} == {i for i in text if 100 <= i < 500 or i == 600}
    assert {text[i][s.start : s.end] for i, spans in got.items() for s in spans} == {
        *(str(7100000 + i) for i in range(6)), *(str(8200000 + i) for i in range(3)), "2019"
    }


def test_secrets_are_seeds_of_their_own(spark):
    rows = [(i, f'call it with token = "{i:04d}ab77{i}9c1de" then go') for i in range(8)]
    rows += [(20 + i, f"note API_Key: {i:04d}xyz{i}12345 end") for i in range(2)]
    rows += [(30, 'the value "0003ab7739c1de" stands alone'), (40, "the token: 12 items"), (41, "a token of thanks in 2019"), (42, "passwords=none12345x")]
    got = {r.doc_id: [dict(rows)[r.doc_id][s.start : s.end] for s in r.added] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[3] == got[30] == ["0003ab7739c1de"] and got[20] == ["0000xyz012345"]
    assert all(got[i] for i in range(8)) and not any(got[i] for i in (40, 41, 42))


def test_candidates_span_joined_groups():
    def found(text):
        return {(v, p) for _, _, p, v, seed in pii.candidates(text, pii.base_spans(text)) if p and not seed}

    assert found("the phone number is 555 123 4567, and") == {("555 123 4567", "number is")}
    assert found("the phone number is (555) 123-4567 and") == {("555) 123-4567", "is (")}
    assert found("pay to IBAN DE89 3704 0044 0532 now") == {("DE89 3704 0044 0532", "to iban")}
    assert found("pay to iban GB29 NWBK 6016 1331 9268 19 NOW it") == {("GB29 NWBK 6016 1331 9268 19", "to iban")}
    assert found("his employee id AB-123. Then") == {("AB-123", "employee id")}
    assert found("in the year 2019, 15 people") == {("2019", "the year"), ("15", "year 0000,")}
    assert found("employee id is" + " " * 200 + "AB-123") == {("AB-123", "id is")}
    long = [found(f"the {'x' * 300}{end} AB-123") for end in ("y", "y", "z")]
    assert long[0] == long[1] != long[2] and all(long)
    parts = {v for _, _, p, v, _ in pii.candidates("at 3 555 123 4567", [])}
    assert {"3", "555 123 4567", "3 555 123 4567"} <= parts
    assert len(pii.candidates("word of " + "12345 " * 1000, [])) == 1000


def test_grouped_identifiers_are_found_whole(spark):
    rows = [(i, f"note {i} my number is u{i}@example.com end") for i in range(60)]
    rows += [(100, "note my number is 555 123 4567 end"), (101, "note my number is AB-123 end"), (102, "call 555 123 4567")]
    text = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [text[k] for k in (100, 101, 102)] == ["note my number is <id> end"] * 2 + ["call <id>"]


ARTICLE = "<p>{0} long running text of the story goes on &amp; on,\n with <a href='#'>one</a>&nbsp;link.</p><p>More {0} text here<br>and here.</p>"
AROUND = "<nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"


def page(main, extra=""):
    return f"<!doctype html><html><head><title>T</title><script>var a='<p>x</p>';</script></head><body>{AROUND}{main}{extra}<aside>Side words</aside><footer>&copy; x</footer></body>"


def test_pages_give_their_article_alone(spark):
    body = lambda k: f"<div class='post-{k}'><h1>Title {k}</h1>{ARTICLE.format(k)}</div><div id='comments'><p>I liked it a lot, dear reader</p></div>"
    rows = [(k, "https://a.example.com/x", page(body(k))) for k in range(5)]
    rows += [(10, "http://b.example.org", page(f"<article><h1>A</h1>{ARTICLE.format(1)}</article>")), (11, None, None), (12, "x", ""), (12, "x", "")]
    rows += [(13, "http://c.example.org", "plain words only"), (14, "http://c.example.org", "<div><p>un<b>closed <p>a < b &lt;i&gt;"), (15, "http://c.example.org", "<!-- <p>gone</p> -->")]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, paths int")
    got = pages.extract(docs).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    story = "{0} long running text of the story goes on & on, with one link.\n\nMore {0} text here and here."
    for k in range(5):
        assert text[k] == f"Title {k}\n\n" + story.format(k)
    assert text[10] == "A\n\n" + story.format(1)
    assert text[11] == text[12] == text[15] == ""
    assert text[13] == "plain words only" and text[14] == "unclosed\n\na < b <i>"
    assert pages.extract(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "tags",
    ["div class='content has-sidebar'", "article class='post category-legal'", "article class='hentry comments-open'",
     "article class='form'", "div class='layout has-header'", "div class='related'", "section id='search'"],
)
def test_class_words_do_not_drop_the_article(tags):
    body = "Long running text of the story goes on and on. " * 5
    html = page(f"<{tags}><p>{body}</p><div class='share-buttons'>Share</div></{tags.split()[0]}><div class='sidebar-left'>Links and words</div>")
    assert pages.Page(html).text([]) == body.strip()


def test_long_comments_do_not_replace_the_article():
    body, said = "Long running text of the story. " * 5, "I liked it a lot, dear reader. " * 8
    html = page(f"<div class='post'><p>{body}</p></div><div id='comments'><p>{said}</p></div>")
    assert pages.Page(html).text([]) == body.strip()


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>first <svg class='i'/> second</p><p>third</p>", "first second\n\nthird"),
        ("<p>first <svg><title>icon</title><text>x</text></svg> second</p><p>third</p>", "first second\n\nthird"),
        ("<p>a <svg><g><svg>x</svg></g>y</svg> b</p>", "a b"),
        ("<p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds, <math/> too</p><p>end</p>", "where x=2 holds, too\n\nend"),
        ("<p>one <button>Share</p><p>two</p><p>three</p>", "one\n\ntwo\n\nthree"),
        ("<p>one <button><div>Share</div></button> more</p><p>two</p>", "one more\n\ntwo"),
        ("<select><option>A<p>one</p><p>two</p><select><option>B</select><p>three</p>", "one\n\ntwo\n\nthree"),
        ("<div><button>Share<p>one</p></div><p>two</p></button><p>three</p>", "one\n\ntwo\n\nthree"),
        ("<p>one</p><object data='x'><p>fallback</p></object><iframe>no</iframe><p>two</p>", "one\n\nfallback\n\ntwo"),
        ("<p>one</p><noscript><p>no</p></noscript><template><p>no</p></template><p>two <iframe src='x'/> end</p>", "one\n\ntwo end"),
        ("<p>one</p><script>var a = '<p>x</p>';", "one"),
    ],
)
def test_inserts_end_where_they_end(html, text):
    assert pages.Page(f"<article>{html}</article>" if "script" not in html else html).text([]) == text


def test_an_article_in_two_parts_is_kept_whole(spark):
    part = "Long running text of the story, part {0}, goes on and on. " * 6
    usual = f"<div class='wrap'><div class='story'><p>{part.format(1)}</p></div><div class='bar'><p><a href='#'>{'Share it here ' * 20}</a></p></div></div>"
    apart = f"<div class='wrap'><div class='story'><p>{part.format(1)}</p></div><div class='story-more'><p>{part.format(2)}</p></div></div>"
    tail = f"<div class='wrap'><div class='story'><p>{part.format(1) * 9}</p></div><div class='story-more'><p>{part.format(2)[:140]}</p></div></div>"
    rows = [(k, "http://a.example.org", page(usual)) for k in range(9)]
    rows += [(10, "http://a.example.org", page(apart)), (11, "http://a.example.org", page(tail))]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == part.format(1).strip() for k in range(9))
    assert got[10] == part.format(1).strip() + "\n\n" + part.format(2).strip()
    assert got[11].endswith(part.format(2)[:140].strip())


@pytest.mark.parametrize("block", [8192, 40])
def test_search_finds_nearly_all_neighbours(spark, block, monkeypatch):
    monkeypatch.setattr(rotated, "BASE_BLOCK", block)
    monkeypatch.setattr(rotated, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(400, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(400, None), (401, [0.0] * 24), (402, [float("nan")] * 24), (403, [1.0, None]), (5, vectors[5].tolist()), (404, vectors[7].tolist()), (None, vectors[1].tolist()), (405, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in rotated.nearest(table, table.where("vec_id % 20 = 0"), 10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    usable = {i: np.array(v) for i, v in rows if i is not None and i < 400 or i == 404}
    assert set(got) == {i for i in usable if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(abs(s - usable[v] @ usable[q]) < 1e-9 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        true = sorted((-(v @ usable[q]), i) for i, v in usable.items() if i != q)[:10]
        hits += len({i for _, i in true} & {v for _, v, _ in found})
    assert hits >= 0.9 * 10 * len(got)
    assert rotated.nearest(table.limit(0), table.limit(0)).count() == 0
