"""Stages of the pipeline on a small table with planted cases."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartmetrics.llm import ngram_prefix
from cartmetrics.llm.pii import find_spans, redact
from cartmetrics.llm.queries import ORACLE_SQL, QUERIES
from cartmetrics.llm.toxicity import toxicity_scores

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    text = "a plain text about the weather in the north and what it does to the crops of the land there every year again"
    planted = [(900_000, text, "en", "src1", 1), (900_001, text, "en", "src1", 1), (900_002, f"{text} write to a@b.cd", "en", "src1", 1), (None, None, None, None, None)]
    return spark.read.parquet(f"{FOLDER}/documents.parquet").union(spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, n_chars long"))


def test_stages_keep_columns_and_take_effect(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["ngram_jaccard_join"](spark, docs, FOLDER)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    # 900002 shares 19 of 22 shingles of five words with 900000
    assert kept.columns == corpus_pipeline.COLUMNS and 900_000 in ids and 900_001 not in ids and 900_002 not in ids and len(ids) == len(set(ids))
    clean = stages["pii"](spark, docs, FOLDER).where("doc_id = 900002").first()
    assert clean.text.endswith("<EMAIL>") and clean.n_chars == len(clean.text)
    safe = stages["toxicity"](spark, docs, FOLDER)
    assert {900_000, 900_002} <= {r.doc_id for r in safe.select("doc_id").collect()} and safe.count() < docs.count()
    assert stages["mixing"](spark, docs, FOLDER).columns == corpus_pipeline.COLUMNS
    packed = stages["packing"](spark, docs, FOLDER)
    assert packed.columns == [*corpus_pipeline.COLUMNS, "epoch", "n_tokens", "bucket", "batch", "place"]
    assert sorted(map(str, packed.select("doc_id", "text", "lang", "source").collect())) == sorted(map(str, docs.select("doc_id", "text", "lang", "source").collect()))


def test_every_stage_takes_odd_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, epoch string, bucket int"
    rows = [(1, None, None, None, None, "x", 1), (2, "", "en", "a", 0, "x", 1), (None, "one two three", "de", "b", 13, "x", 1), (4, "w " * 30_000, "en", None, 1, "x", 1), (4, "w " * 30_000, "en", None, 1, "x", 1)]
    frame = spark.createDataFrame(rows, schema)
    sizes = {name: stage(spark, frame, FOLDER).count() for name, stage in corpus_pipeline.STAGES}
    assert sizes == {"toxicity": 5, "ngram_jaccard_join": 4, "pii": 5, "mixing": sizes["mixing"], "packing": 5}
    assert all(stage(spark, frame.limit(0), FOLDER).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_run_equals_the_stages_by_hand(spark):
    """run() against plain Python over the same decisions of each stage."""
    out = corpus_pipeline.run(spark, FOLDER).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    scores = toxicity_scores(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
    safe = sorted(r.doc_id for r in scores if not r.predicted)
    words = {i: (docs[i].text or "").encode().lower().split() for i in safe}
    grams = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in words.items()}
    first = {i: i for i in safe}
    for i in safe:
        for j in safe:
            if j < i and grams[i] & grams[j] and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]):
                a, b = sorted((first[i], first[j]))
                first = {k: a if v == b else v for k, v in first.items()}
    left = {i for i in safe if first[i] == i}
    text = {i: redact(docs[i].text, find_spans(docs[i].text)) for i in left}
    assert {r.doc_id for r in out} <= left and all(r.text == text[r.doc_id] and r.n_chars == len(r.text) and r.n_tokens == len(r.text.encode().split()) for r in out)
    # mixing by the SQL of op3 over what was left
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [(i, text[i], docs[i].lang, docs[i].source) for i in sorted(left)])
    mixed = con.execute(f"SELECT doc_id, count(*) FROM ({ORACLE_SQL['op3_mixing']}) GROUP BY doc_id").fetchall()
    assert Counter(r.doc_id for r in out) == Counter(dict(mixed)) and len(out) > 100
    epochs = Counter(r.doc_id for r in out)
    assert all(sorted(r.epoch for r in out if r.doc_id == i) == list(range(n)) and n <= 3 for i, n in epochs.items())
    batches = Counter((r.bucket, r.batch) for r in out)
    assert all(b * n <= 16384 or n == 1 for (b, _), n in batches.items()) and all(r.n_tokens <= r.bucket for r in out)
    bounds = sorted({r.bucket for r in out})
    assert all(r.bucket == min(b for b in bounds if b >= r.n_tokens) for r in out) and len({(r.bucket, r.batch, r.place) for r in out}) == len(out)


def test_stages_bound_the_batches_of_python_workers(spark):
    """Before, a batch held 10,000 rows or 64 MB."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame([(i, f"w{i} " * 200, "en", "a", 1) for i in range(5)], schema)
    batch = F.pandas_udf(lambda t: pd.Series([len(t)] * len(t)), "long")
    long_texts = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("word "), 1000).alias("text"))
    for name in ("toxicity", "ngram_jaccard_join", "pii"):
        spark.conf.unset(corpus_pipeline.BATCH_SETTING)
        assert dict(corpus_pipeline.STAGES)[name](spark, frame, FOLDER).count() == 5
        largest = long_texts.select(batch("text").alias("n")).agg(F.max("n")).first()[0]
        assert largest * 5000 <= 1.1 * corpus_pipeline.BATCH_BYTES, name
    spark.conf.set(corpus_pipeline.BATCH_SETTING, "4321")  # a session's own value stays
    assert not corpus_pipeline.bound_batches(spark) and spark.conf.get(corpus_pipeline.BATCH_SETTING) == "4321"
    spark.conf.unset(corpus_pipeline.BATCH_SETTING)


def test_near_copies_at_five_words_equal_brute_force(spark):
    rng = random.Random(8)
    texts = {}
    for i in range(0, 60, 3):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([40, 90, 200]))]
        texts[i] = words
        texts[i + 1] = words + [f"x{i}y{j}" for j in range(len(words) * rng.choice([13, 18, 23]) // 100)]
        texts[i + 2] = words + [f"z{i}y{j}" for j in range(len(words) * 40 // 100)]
    grams = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in texts.items()}
    similar = lambda a, b: len(grams[a] & grams[b]) / len(grams[a] | grams[b])
    assert sum(0.8 <= similar(i, i + 1) < 0.9 for i in range(0, 60, 3)) >= 15
    want = {i for i in texts if not any(j < i and similar(i, j) >= 0.8 for j in texts)}
    docs = spark.createDataFrame([(i, " ".join(w), "en", "src1", 1) for i, w in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want and len(want) < len(texts) - 14
    assert corpus_pipeline.drop_near_copies(spark, docs, FOLDER, words=3, percent=90).count() > len(want)


def _chained_texts(rng: random.Random) -> dict[int, list[str]]:
    """Documents that hold most of one before them, some of them near copies; all lists of n-grams hang together."""
    texts = {0: [f"w{rng.randrange(10**6)}" for _ in range(120)]}
    for i in range(1, 40):
        words = list(texts[rng.randrange(max(0, i - 6), i)])
        at, n = rng.randrange(len(words)), rng.choice([6, 24, 30, 36])
        words[at : at + n] = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts[i] = words
    return texts


def test_leftover_lists_give_pairs_without_a_product(spark, monkeypatch):
    """Before, each block of a group's documents was moved to each other one, whose disk grows with the square of the
    input, however few documents meet in a list."""
    texts = _chained_texts(random.Random(5))
    grams = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in texts.items()}
    first = {i: i for i in texts}
    for i in texts:
        for j in range(i):
            if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]):
                a, b = sorted((first[i], first[j]))
                first = {k: a if v == b else v for k, v in first.items()}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()] + [(39, " ".join(texts[39])), (None, " ".join(texts[3]))], "doc_id long, text string")
    found = lambda: {r.doc_id: r.component_id for r in ngram_prefix.near_copy_components(docs).where("doc_id IS NOT NULL").collect()}
    products, sent = ngram_prefix._product_links, []
    monkeypatch.setattr(ngram_prefix, "_product_links", lambda members, *a: sent.append(members.count()) or products(members, *a))
    assert found() == first and len(set(first.values())) > 10 and not sent
    # lists with more outsiders go to the product, in blocks of a few documents
    monkeypatch.setattr(ngram_prefix, "OUTSIDERS", 0)
    monkeypatch.setattr(ngram_prefix, "BLOCK_GRAMS", 300)
    assert found() == first and sent


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert set(ORACLE_SQL) < set(QUERIES)
