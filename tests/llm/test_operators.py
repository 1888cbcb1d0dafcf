"""Operators against brute force on small frames, and the cases that each docstring defines."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartmetrics.llm import html_text, packing, pii
from cartmetrics.llm.common import shared_folder
from cartmetrics.llm.line_rules import line_rules
from cartmetrics.llm.lm_score import backoff_scores
from cartmetrics.llm.mixing import count_words, mix_sources
from cartmetrics.llm.ngram_join import ngram_jaccard_components, ngram_jaccard_link_counts
from cartmetrics.llm.quality_pu import quality_scores
from cartmetrics.llm.ngram_prefix import near_copy_components
from cartmetrics.llm.topk import exact_top_k
from cartmetrics.llm.toxicity import SEED_TERMS, Lexicon, mine_terms, toxicity_scores, word_terms

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Null columns, empty and long texts, repeated rows and a column whose name clashes."""
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, None), (3, " \n\t ", "en", "a", 4, None), (4, LONG, "en", None, 1, "x"), (4, LONG, "en", None, 1, "x"), (None, "one two three", "de", "b", 13, "x"), (6, "one two three", "de", "b", 13, "x")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) or (frozenset([tuple(w)]) if w else frozenset())


def test_ngram_join_equals_brute_force(spark):
    rng = random.Random(5)
    rows, base = [], None
    for i in range(160):
        if i % 8 == 0:
            base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([5, 12, 60, 150, 300]))]
        words = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 4, 7])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        rows.append((i * 3, " ".join(words).upper() if i % 5 == 0 else " ".join(words)))
    rows += [(9001, None), (9002, ""), (9003, "a b"), (9004, "A  b")]
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 90 * len(sets[a] | sets[b]) and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (len(sets[i]), label[i]) for i in sets}
    assert len(set(label.values())) < len(sets) - 20


@pytest.mark.parametrize(("words", "percent"), [(5, 80), (3, 90), (2, 60)])
def test_ngram_join_with_passages_and_chains(spark, monkeypatch, words, percent):
    """Passages that most texts share, and chains of near copies whose ends don't link: all steps of the search run."""
    monkeypatch.setattr("cartmetrics.llm.ngram_prefix.BLOCK_GRAMS", 700)
    rng = random.Random(words)
    passage = [f"p{i}" for i in range(40)]
    texts = {}
    for c in range(30):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([30, 80, 150]))]
        at = rng.randrange(len(base))
        base = base[:at] + passage + base[at:] if c % 3 else base
        for i in range(8):  # every text changes a few more words of the one before
            texts[100 * c + i] = list(base)
            for _ in range(max(1, len(base) * (100 - percent) // 100 // words // 3)):
                base[rng.randrange(len(base))] = f"x{rng.randrange(10**6)}"
    for i in range(60):
        texts[5000 + i] = [f"w{rng.randrange(3000)}" for _ in range(25)] + passage
    grams = {i: {tuple(w[j : j + words]) for j in range(len(w) - words + 1)} for i, w in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    links = 0
    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(grams[a] & grams[b])
        if 100 * both >= percent * len(grams[a] | grams[b]):
            links += 1
            x, y = sorted((root(a), root(b)))
            label[y] = x
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string").repartition(3)
    for find in (near_copy_components, ngram_jaccard_components) if percent != 60 else (near_copy_components,):
        got = {r.doc_id: r.component_id for r in find(frame, words, percent).collect()}
        assert got == {i: root(i) for i in texts} and 100 < links and len(set(got.values())) > 60


def test_ngram_join_odd_rows(odd, none):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_jaccard_components(odd).collect())
    assert got == [(0, 1, 6), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 977, 4), (4, 977, 4), (6, 1, 6)]
    assert ngram_jaccard_components(none).count() == 0


def test_ngram_link_counts_equal_brute_force(spark, none, monkeypatch):
    monkeypatch.setattr("cartmetrics.llm.ngram_join.ROWS", 8)
    rng = random.Random(7)
    base = [[f"w{rng.randrange(900)}" for _ in range(n)] for n in (90, 60)]
    rows = []
    for i in range(70):
        words = list(base[i % 2])
        for _ in range(rng.choice([0, 1, 1, 2])):
            words[rng.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(None, rows[0][1]), (900, None), (901, "a b")]
    sets = [(i, shingles(t)) for i, t in rows]
    link = lambda a, b: a != b and bool(a & b) and 100 * len(a & b) >= 90 * len(a | b)
    want = {i: sum(j is not None and i is not None and link(s, t) for j, t in sets) for i, s in sets}
    got = {r.doc_id: r.n_links for r in ngram_jaccard_link_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and max(want.values()) > 20 and min(want.values()) == 0
    assert ngram_jaccard_link_counts(none).count() == 0


def test_pii_equals_the_plain_patterns():
    rng = random.Random(3)
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    for _ in range(4000):
        text = "".join(rng.choice("a.@-1 29+%_\n(5)25.é") for _ in range(rng.randint(0, 60)))
        digits = lambda m: re.sub("[^0-9]", "", m.group())
        want = [("email", *m.span()) for m in email.finditer(text)]
        want += [("ip", *m.span()) for m in ip.finditer(text) if all(int(p) < 256 for p in m.group().split("."))]
        want += [("card", *m.span()) for m in card.finditer(text) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
        want += [("phone", *m.span()) for m in phone.finditer(text) if 8 <= len(digits(m)) <= 15]
        assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == want
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    found = pii.find_spans("iban GB82 WEST 1234 5698 7654 32, card 4111 1111 1111 1111, tel 555-123-4567")
    assert [s[0] for s in found] == ["card", "iban", "local_phone"]
    assert pii.redact("mail a.b@c.de now", pii.find_spans("mail a.b@c.de now")) == "mail <EMAIL> now"
    assert pii.find_spans("1" * 200_000) == [] and pii.find_spans("a" * 200_000) == []


def test_pii_ends_an_iban_before_the_next_word():
    ibans = lambda text: [text[a:b] for k, a, b, _ in pii.find_spans(text) if k == "iban"]
    de, gb = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    assert ibans(f"{de} BIC COBADEFF") == [de] and ibans(f"IBAN: {de.replace(' ', '')} BIC COBADEFFXXX") == [de.replace(" ", "")]
    assert ibans("DE89370400440532013000 100 EUR") == ["DE89370400440532013000"]
    assert ibans(f"{de} {gb} AND MORE") == [de, gb] and ibans(f"AB12 CODE 99 {de} X") == [de]
    assert ibans(f"{de[:-1]}1 BIC") == [] and ibans("ZZ" + de[2:] + " BIC") == []
    assert pii.redact(f"{de} BIC A", pii.find_spans(f"{de} BIC A")) == "<IBAN> BIC A"
    assert ibans("DE89 " * 20_000) == []


def test_pii_odd_rows(odd, none):
    rows = pii.pii_spans(odd, redacted=True).collect()
    assert len(rows) == 7 and {r.base_sha256 for r in rows} == {"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"}
    assert pii.pii_spans(none).count() == 0


PAGE = """<html><head><title>T</title><script>var x = "<p>no</p>";</script></head><body class="page">
<header><a href="/">Home</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>First  <b>para</b>graph<br>goes on for a while, with words.
<p>Second one &lt;here&gt; <a href="/x">linked</a>.<ul><li>item one<li>item two</ul><aside>Related</aside>
<div id="comments"><p>A reader says much about everything.</p></div></article><div class="sidebar">Side</div><form><p>Name</p></form><footer>&copy; all</footer></body></html>"""


def test_html_keeps_the_article_only(spark):
    want = "Head & line\nFirst paragraph goes on for a while, with words.\nSecond one <here> linked.\nitem one\nitem two"
    assert html_text.main_text(PAGE) == want
    assert html_text.main_text(PAGE.replace("article>", "div>")) == want
    assert html_text.main_text(None) == "" and html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    rows = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "y"), (2, None, None, "y")], "page_id long, url string, html string, text string")
    assert sorted((r.page_id, r.n_chars) for r in html_text.extract_main_text(rows).collect()) == [(1, len(want)), (2, 0), (2, 0)]
    assert html_text.extract_main_text(rows.limit(0)).count() == 0


def test_html_names_do_not_drop_most_of_the_page():
    text = "\n".join(f"Paragraph {i} of the article has some words, and then a few more of them." for i in range(6))
    body = "<h1>Head</h1>" + "".join(f"<p>{p}</p>" for p in text.split("\n"))
    side = "<div class='sidebar'><p>Other things to read are listed here.</p></div>"
    for name in ("layout has-sidebar", "no-sidebar", "with-comments", "search-results"):
        assert html_text.main_text(f"<body><div class='{name}'><div>{body}</div>{side}</div></body>") == f"Head\n{text}"
    comments = f"<div id='comments'>{'<p>A reader says very much about everything in the text above.</p>' * 20}</div>"
    assert html_text.main_text(f"<body><article>{body}</article>{comments}</body>") == f"Head\n{text}"
    assert html_text.main_text(f"<body><article>{body}{comments}</article></body>") == f"Head\n{text}"


WORDS = "time house water field morning letter window river story market garden winter people summer bridge music paper light".split()


def sentences(rng, n):
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(9, 22))).capitalize() + "." for _ in range(n)]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div class='content'>{}</div>", "<main><div id='x1'>{}</div></main>", "<div id='page'><div class='col-8'>{}</div></div>", "<table><tr><td>{}</td></tr></table>"])
def test_html_keeps_all_parts_of_the_article(wrap):
    """Parts of the article whose names are also those of boilerplate stay, with and without landmarks."""
    rng = random.Random(len(wrap))
    for _ in range(25):
        text = sentences(rng, rng.randint(6, 14))
        parts = [f"<p>{t}</p>" for t in text]
        at = rng.sample(range(1, len(parts)), 5)
        parts[at[0]] = f"<div class='legal'><p>{text[at[0]]}</p></div>"
        parts[at[1]] = f"<p class='side'>{text[at[1]]}</p>"
        parts[at[2]] = f"<div class='related-work'>{text[at[2]]}</div>"
        parts[at[3]] = f"<p>{text[at[3]][:-1]} <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.</p>"
        parts[at[4]] = f"<section class='discussion'><p>{text[at[4]]}</p></section>"
        text[at[3]] = f"{text[at[3]][:-1]} x=2."
        noise = f"<nav><a href=/>Home</a> <a href=/n>News</a></nav><div class='ad'>Buy {rng.choice(WORDS)} now</div>"
        more = "<div class='related'>" + "".join(f"<a href=/{i}>{rng.choice(WORDS)} {rng.choice(WORDS)}</a> " for i in range(6)) + "</div><footer>All rights reserved</footer>"
        page = f"<html><body>{noise}{wrap.format(''.join(parts))}{more}</body></html>"
        assert html_text.main_text(page) == "\n".join(text)


def test_html_header_of_an_article_is_its_headline():
    body = "".join(f"<p>{t}</p>" for t in sentences(random.Random(1), 8))
    text = "\n".join(sentences(random.Random(1), 8))
    head = "<header><a href=/>Site</a></header>"
    assert html_text.main_text(f"<body>{head}<article><header><h1>The headline</h1></header>{body}</article></body>") == f"The headline\n{text}"
    drop = "<div class='comments'><p>A reader says something.</p></div><div class='share'>Share this</div><form><p>Name</p></form><div class='newsletter'>Sign up</div>"
    assert html_text.main_text(f"<body>{head}<article>{body}{drop}</article><p class='legal'>Imprint</p></body>") == text


def test_top_k_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() if i % 7 else 0.25 for _ in range(8)]) for i in range(300)]
    rows += [(900, None), (901, [float("nan")] * 8), (902, [None] * 8), (904, [0.5, 0.5]), (903, [0.5, 0.25]), (None, [0.1] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = Counter((r.query_id, r.rank, r.vec_id, r.score) for r in exact_top_k(frame, frame.where("vec_id % 50 = 0"), k=5).collect())
    import numpy as np

    ints = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in rows[:300]}
    want = Counter()
    for q in range(0, 300, 50):
        best = sorted((-sum(a * b for a, b in zip(ints[q], ints[i], strict=True)), i) for i in ints if i != q)[:5]
        want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(best))
    assert got == want
    assert exact_top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_mixing_moves_shortages_to_siblings_first(spark, odd, none):
    rows = [(i, "w " * 10, "en", "a" if i < 40 else "b" if i < 50 else "c") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("domain", F.when(F.col("source") == "c", "y").otherwise("x"))
    out = mix_sources(docs, ["domain", "source"], {}, share=0.6, max_epochs=1)
    got = {r.source: (r.n, r.b) for r in out.groupBy("source").agg(F.count("*").alias("n"), F.first("budget").alias("b")).collect()}
    # 600 tokens: 300 for each domain; b can give only 100 of its 150, a takes the rest of x's.
    assert got == {"a": (20, 200), "b": (10, 100), "c": (30, 300)}
    more = mix_sources(docs, ["domain", "source"], {("y",): 3.0}, share=1.0, max_epochs=3).groupBy("source", "doc_id").count()
    times = {r.source: {x["count"] for x in more.where(F.col("source") == r.source).collect()} for r in more.select("source").distinct().collect()}
    assert times["c"] == {1, 2} and times["a"] == {1}
    first = {r.doc_id for r in out.collect()}
    assert first == {r.doc_id for r in mix_sources(docs.repartition(7), ["domain", "source"], {}, share=0.6, max_epochs=1).collect()}
    assert mix_sources(odd, ["lang", "source"], {}, max_epochs=1).count() == 4 and mix_sources(none, ["lang"], {}).count() == 0


def test_packing_bounds_are_optimal(spark, odd, none):
    rng = random.Random(4)
    for _ in range(60):
        tops = sorted(rng.sample(range(0, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 9) for _ in tops]
        k = rng.randint(1, 5)
        cost = lambda bounds: sum(c * min(b for b in bounds if b >= t) for t, c in zip(tops, counts, strict=True))
        best = min(cost((*inner, tops[-1])) for n in range(k) for inner in itertools.combinations(tops[:-1], min(n, len(tops) - 1)))
        bounds = packing.optimal_bounds(tops, counts, k)
        assert len(bounds) <= k and cost(bounds) == best
    docs = spark.createDataFrame([(i, "w " * (1 + i % 40)) for i in range(500)], "doc_id long, text string")
    rows = packing.pack_batches(docs, buckets=4, batch_tokens=200).collect()
    assert len(rows) == 500 and all(r.n_tokens <= r.bucket for r in rows)
    batches = Counter((r.bucket, r.batch) for r in rows)
    assert len({(r.bucket, r.batch, r.place) for r in rows}) == 500 and all(n * b <= 200 for (b, _), n in batches.items())
    last = {b: max(x for c, x in batches if c == b) for b, _ in batches}
    assert all(n == 200 // b for (b, x), n in batches.items() if x < last[b])
    assert packing.pack_batches(odd).count() == 7 and packing.pack_batches(none).count() == 0


def test_packing_keeps_rows_and_tells_copies_apart(spark):
    rows = [(i, "w " * (1 + i % 40), f"s{i % 3}", 7) for i in range(300)] + [(None, "same text", "n", 7)] * 500 + [(1, "w w ", "s1", 7)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, part int").repartition(6)
    got = packing.pack_batches(docs, buckets=4, batch_tokens=200, keep=("doc_id", "text", "source", "part")).collect()
    assert Counter((r.doc_id, r.text, r.source, r.part) for r in got) == Counter(rows)
    assert len({(r.bucket, r.batch, r.place) for r in got}) == len(rows)
    assert sorted(r.copy for r in got if r.doc_id is None) == list(range(500)) and sorted(r.copy for r in got if r.doc_id == 1) == list(range(41))
    sizes = Counter((r.bucket, r.batch) for r in got)
    assert all(b * n <= 200 or n == 1 for (b, _), n in sizes.items())
    plain = packing.pack_batches(docs, buckets=4, batch_tokens=200)
    cells = lambda rows: Counter((r.doc_id, r.n_tokens, r.bucket, r.batch, r.place) for r in rows)
    assert cells(plain.collect()) == cells(packing.pack_batches(docs.repartition(2), buckets=4, batch_tokens=200).collect()) == cells(got)


def test_packing_moves_what_it_keeps_once(spark, capsys):
    """Before, texts went through a window and two joins."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 40), "s") for i in range(50)], "doc_id long, text string, source string")
    capsys.readouterr()
    packing.pack_batches(docs, keep=("text", "source")).explain("formatted")
    nodes = re.findall(r"\(\d+\) (\w+).*\n((?:.+\n)+)", capsys.readouterr().out)
    held = [name for name, body in nodes if re.search(r"(Input|Output)[^\n]*kept#", body)]
    assert "Scan" in held and "Window" not in held and held.count("Exchange") + held.count("BroadcastExchange") <= 1 and any(name == "Window" for name, _ in nodes)


def test_packing_loss_of_a_rounded_histogram_is_bounded(spark):
    rng = random.Random(8)
    lengths = [int(rng.paretovariate(0.8) * 20) for _ in range(3000)]
    docs = spark.createDataFrame([(i, "", n) for i, n in enumerate(lengths)], "doc_id long, text string, n long")
    padded = {bits: sum(r.bucket for r in packing.pack_batches(docs, 5, 4096, tokens=F.col("n"), bits=bits).collect()) for bits in (None, 5)}
    assert padded[None] <= padded[5] <= padded[None] * (1 + 2**-4)


def test_mixing_counts_words_without_holding_them(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "a", " a\x0bb\u00a0c\u2003 \U0001f600x\r\n", "$1 \\ x\u0085y", "\x1c \x1f"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", "text", count_words(F.col("text")).alias("n"))
    assert {r.i: r.n for r in df.collect()} == {i: len(re.findall("[^\\x20\\x09-\\x0D]+", t or "")) for i, t in enumerate(texts)}
    docs = spark.createDataFrame([(1, "a b", "en"), (2, "c", "de")], "doc_id long, text string, lang string")
    plan = mix_sources(docs, ["lang"], {}, max_epochs=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_mixing_with_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "a b c", "en", 1, 2, 3, 4, 5, 6) for i in range(10)], "doc_id long, text string, lang string, _epochs int, _last int, _leaf0 int, row int, budget int, key int")
    out = mix_sources(docs, ["lang"], {}, share=1.0, max_epochs=1)
    assert out.columns == ["doc_id", "text", "lang", "_epochs", "_last", "_leaf0", "row", "key", "epoch", "n_tokens", "budget"]
    assert {(r._epochs, r._last, r._leaf0, r.row, r.key, r.budget) for r in out.collect()} == {(1, 2, 3, 4, 6, 30)} and out.count() == 10


def test_steps_need_a_shared_folder():
    class Session:
        conf = sparkContext = property(lambda self: self)
        applicationId = "app"

        def __init__(self, setting, checkpoint=None):
            self.setting, self.checkpoint = setting, checkpoint

        def get(self, key, default):
            return self.setting or default

        def getCheckpointDir(self):
            return self.checkpoint

    assert shared_folder(Session("/shared/")) == "/shared/llm-app" and shared_folder(Session(None, "/ck")) == "/ck/llm-app"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(None))


def test_line_rules_counts_and_boilerplate(spark, odd, none):
    shared = [f"Share  this{k} PAGE{k} with your{k} friends{k}" for k in range(5)]
    page = lambda i, n: "\n".join(f"{' '.join(f't{i}x{k}y{j}' for j in range(n))}\n{line}" for k, line in enumerate(shared))
    rows = [(i, page(i, 6), "h") for i in range(80)] + [(100 + i, page(100 + i, 1), "h") for i in range(3)]
    rows += [(200, "a b c d e f g h " * 6, "h"), (201, "x # $\nsame line\nsame line\n", "z")]
    got = {r.doc_id: r for r in line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].kept and got[0].n_words_left == 30 and got[0].n_words == 60
    assert not got[100].base_failed and not got[100].kept and got[100].n_words_left == 5
    assert got[200].n_repeat_words == 48 and got[200].base_failed and got[201].n_dup_lines == 1 and got[201].n_symbols == 2 and got[201].word_chars == 19
    assert [r.base_failed for r in line_rules(odd).where("doc_id < 4").collect()] == [True] * 3
    assert line_rules(odd).count() == 7 and line_rules(none).count() == 0


def test_line_rules_take_a_banner_at_any_number_of_documents(spark):
    for n in (6, 300):
        rows = [(i, "Accept our cookies before you read on\n" + "\n".join(" ".join(f"w{i}x{k}y{j}" for j in range(8)) for k in range(4)), "h") for i in range(n)]
        got = line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
        assert {(r.n_words, r.n_words_left, r.kept) for r in got} == {(39, 32, True)}
        block = [f"navigation entry {k} of the site" for k in range(12)]
        own = lambda i, k: "\n".join(" ".join(f"w{i}x{m}y{j}" for j in range(4)) for m in range(k))
        # pages with content of their own show that the block is one, and pages of the block alone go with it
        pages = [(i, "\n".join([*block, own(i, 12)]), "h") for i in range(n)] + [(1000 + i, "\n".join([*block, own(1000 + i, 5)]), "h") for i in range(n)]
        got = line_rules(spark.createDataFrame(pages, "doc_id long, text string, source string")).collect()
        assert {(r.doc_id < 1000, r.n_words_left, r.kept) for r in got} == {(True, 48, True), (False, 20, False)}


def test_line_rules_spare_near_copies(spark):
    rng = random.Random(3)
    lines = [" ".join(f"c{k}x{j}" for j in range(9)) for k in range(20)]
    rows = []
    for i in range(400):
        own = list(lines)
        own[rng.randrange(20)] = f"edited in copy {i}"
        rows.append((i, "\n".join(own), "h"))
    rows += [(1000 + i, "\n".join(" ".join(f"o{i}x{k}y{j}" for j in range(9)) for k in range(6)), "h") for i in range(800)]
    got = line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(r.kept for r in got)


def shuffled_rows(df):
    """Rows that the exchanges of df wrote when it was collected; exchanges that are used again count once."""

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        inner = [walk(node.children().apply(i)) for i in range(node.children().size())]
        own = node.metrics().get("shuffleRecordsWritten") if node.nodeName() == "Exchange" else None
        return sum(inner) + (own.get().value() if own is not None and own.isDefined() else 0)

    rows = df.collect()
    return rows, walk(df._jdf.queryExecution().executedPlan())


def test_line_rules_move_few_rows_without_broadcasts(spark):
    """Beyond the broadcast threshold, the join of all lines with the shared ones once moved all lines a second time behind it."""
    rows = [(i, "\n".join([*(f"line {i} {k} " + "own words " * 3 for k in range(20)), *(f"banner {k % 5} of all" for k in range(i % 7))]), f"h{i % 3}") for i in range(400)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out, moved = shuffled_rows(line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lines = sum(len(text.split("\n")) for _, text, _ in rows)
    assert len(out) == 400 and 2 * lines < moved < 2.6 * lines, (moved, lines)


def test_backoff_scores_equal_the_definition(spark, odd, none):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 12))) for _ in range(30)] + ["zzz", None, ""]
    split = [(t or "").split() for t in texts]
    for order in (1, 2, 3):
        got = {r.doc_id: r.log_score for r in backoff_scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), order).collect()}
        for d, w in enumerate(split):
            counts = Counter()
            for o, v in enumerate(split):
                if o != d:
                    counts.update(tuple(v[i : i + n]) for n in range(1, order + 1) for i in range(len(v) - n + 1))
            rest, total = sum(map(len, split)) - len(w), 0.0
            for i in range(len(w)):
                top = min(order, i + 1)
                for n in range(top, 0, -1):
                    c, ctx = counts[tuple(w[i - n + 1 : i + 1])], counts[tuple(w[i - n + 1 : i])] if n > 1 else rest
                    if c and ctx:
                        total += math.log(0.4 ** (top - n) * c / ctx)
                        break
                else:
                    total += math.log(0.4**top / (rest + 1))
            assert got[d] == pytest.approx(total, abs=1e-9)
    assert backoff_scores(odd).count() == 7 and backoff_scores(none).count() == 0


@pytest.mark.parametrize(("operator", "label"), [(toxicity_scores, "toxic"), (quality_scores, "quality")])
def test_classifiers_on_held_out_rows(spark, odd, none, operator, label):
    """Recall and precision of each class on held-out rows. Some toxic labels have no trace in the text, hence 0.88."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = operator(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 800 and all(0 <= r.score <= 1 for r in rows)
    least = {("toxic", 1): (0.88, 0.97), ("toxic", 0): (0.99, 0.97), ("quality", 1): (0.98, 0.96), ("quality", 0): (0.85, 0.95)}
    for value in (0, 1):
        own, called = [r for r in rows if r[label] == value], [r for r in rows if r.predicted == value]
        both = sum(r.predicted == value for r in own)
        recall, precision = least[label, value]
        assert both >= recall * len(own) and both >= precision * len(called), (label, value, both, len(own), len(called))
    assert operator(odd, labels.limit(0)).count() == 7 and operator(none, labels).count() == 0


def test_toxicity_lexicon_takes_all_terms_if_asked(spark):
    insults = [f"{a}{b}rotz" for a in ("gra", "blu", "tri", "sko") for b in ("ba", "de", "fi", "go", "hu")]
    rows = [(i, f"this page says {insults[i % 20]} and {insults[(i + 1) % 20]} about text {i}") for i in range(200)]
    rows += [(1000 + i, f"this page says good things about text {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows], "doc_id long, toxic int")
    terms = {n: mine_terms(docs, labels, n)[0] for n in (5, None)}
    assert {f"={w}" for w in insults} <= set(terms[None]) and len(terms[5]) == 5 + len(SEED_TERMS)
    scores = {r.doc_id: r.predicted for r in toxicity_scores(docs, labels, max_terms=None).collect()}
    assert all(scores[i] == int(i < 1000) for i in scores)


def test_toxicity_lexicon_looks_up_few_words():
    """Words that begin like no term were once looked up again and again, as more of them came than a lexicon remembers."""

    class Counted(dict):
        asked = 0

        def __contains__(self, key):
            self.asked += 1
            return super().__contains__(key)

    lexicon = Lexicon(["=ox", "=stupid", "idio-", "moron-2"], ["grump-"])
    lexicon.index = Counted(lexicon.index)
    letters = "abcdefghjklnpqrtuvwxyz"
    rare = ["".join(w) + "ee" for w in itertools.product(letters, repeat=4)][:120_000]
    lexicon.rows([" ".join(rare[i : i + 1000]) for i in range(0, len(rare), 1000)] * 2 + ["an ox and an oxbow, idiots"])
    assert lexicon.index.asked < 50 and len(lexicon.seen) < 10


def test_toxicity_lexicon_hits_equal_the_terms_of_a_text():
    rng = random.Random(5)
    words = ["".join(rng.choice("abß") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words).title() for _ in range(rng.randrange(40))) for _ in range(60)] + ["", None, "a", "12 _ ?!"]
    every = sorted(set().union(*map(word_terms, texts)))
    for _ in range(20):
        terms = rng.sample(every, 30)
        x, _ = Lexicon(terms[:20], terms[20:]).rows(texts)
        for text, row in zip(texts, x, strict=True):
            assert {t for t, v in zip(terms, row, strict=True) if v > 0} == set(terms) & word_terms(text)
