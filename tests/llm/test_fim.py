"""Fill-in-the-middle against a plain rewrite of its definition, and round trips."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from cartmetrics.llm.fim import fim_restore, fim_transform

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def by_hand(doc_id, text):
    text = text or ""
    units, digest = UNIT.findall(text), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_equals_the_definition_and_restores_the_text(spark):
    rng = random.Random(1)
    bits = [" ", "\n", "\t\t", "a", "Wort", "é", "\U0001f600", "<", ">", "P", "S", "M", "$1", "\\", "{2}", "\xa0", "\x1c", " ", "\r\n"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(3000)]
    rows += [(9001, None), (9002, ""), (9003, " \n "), (9004, "<M>"), (None, "no id here"), (5, rows[5][1]), (5, rows[5][1])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, output string, n int")
    out = fim_transform(docs)
    got = sorted(((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in out.collect()), key=str)
    assert got == sorted(((i, *by_hand(i, t)) for i, t in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = count_rows((r.doc_id, r.text) for r in out.select("doc_id", fim_restore(F.col("output"), F.col("form")).alias("text")).collect())
    assert back == count_rows((i, t or "") for i, t in rows)


def count_rows(rows):
    counts = {}
    for r in rows:
        counts[r] = counts.get(r, 0) + 1
    return counts


def test_very_long_texts_and_empty_tables(spark):
    texts = ["word " * 400_000, " " * 1_000_000, "x" * 1_000_000, ("  a\n" * 300_000) + " \n" * 100_000]
    rows = [(100 * k + i, t) for k, t in enumerate(texts) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    out = fim_transform(docs).withColumn("back", F.md5(fim_restore(F.col("output"), F.col("form")))).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "back").collect()
    want = {i: by_hand(i, t) for i, t in rows}
    assert all((r.n, r.form, r.prefix_chars, r.middle_chars) == (want[r.doc_id][0], want[r.doc_id][1], *want[r.doc_id][3:]) for r in out)
    assert {r.doc_id: r.back for r in out} == {i: hashlib.md5(t.encode()).hexdigest() for i, t in rows} and any(r.form != "plain" for r in out)
    empty = fim_transform(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"]
