"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmetrics.llm.common import table
from cartmetrics.llm.conv_trie import conversation_trie
from cartmetrics.llm.fim import fim_restore, fim_transform
from cartmetrics.llm.html_text import extract_main_text
from cartmetrics.llm.lang_crf import language_scores
from cartmetrics.llm.line_rules import line_rules
from cartmetrics.llm.lm_score import backoff_scores
from cartmetrics.llm.mixing import mix_sources
from cartmetrics.llm.ngram_join import ngram_jaccard_components
from cartmetrics.llm.packing import pack_batches
from cartmetrics.llm.pii import pii_spans
from cartmetrics.llm.quality_pu import quality_scores
from cartmetrics.llm.topk import exact_top_k
from cartmetrics.llm.toxicity import toxicity_scores

#: Mixing: the crawl is the source src0, everything else is curated.
MIX_WEIGHTS = {("curated",): 2.0, ("curated", "en"): 3.0, ("crawl", "en"): 3.0}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 1.0, 3, 42
SPACE_SQL = r"[\x20\x09-\x0D]+"


def domain() -> Column:
    return F.when(F.col("source") == "src0", "crawl").otherwise("curated")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("domain", domain())
    mixed = mix_sources(docs, ["domain", "lang", "source"], MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "budget")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(table(spark, sf_dir, "documents")).drop("found")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), divisor=4, held_out=2)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(table(spark, sf_dir, "documents"), host="source", percent=2.0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder=5)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_batches(table(spark, sf_dir, "documents"), buckets=8, batch_tokens=16384)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return exact_top_k(rows, rows.where("vec_id % 50 = 0"), k=5, scale=256)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = backoff_scores(table(spark, sf_dir, "documents"), order=2, backoff=0.4)
    return scores.withColumns({c: F.round(c, 4) for c in ("log_score", "word_score")})


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim_transform(table(spark, sf_dir, "documents"), seed=42, percent=50, spm_percent=80)
    digest = lambda text: F.sha2(text, 256)
    restored = digest(fim_restore(F.col("output"), F.col("form")))
    return rows.withColumns({"output_sha256": digest(F.col("output")), "restored_sha256": restored}).drop("output")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"), group=20, heads=4)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"), divisor=3, held_out=1)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_html_extraction, op3_mixing, op4_pii, op5_quality_classifier,
        op6_quality_rules, op7_toxicity, op8_packing, op9_exact_top_k, op10_lm_scoring, op11_fill_in_middle,
        op12_conversation_trie, op13_language_id, pipeline,
    )
}

# Two documents link by the definition itself; the recursion follows links to the smallest id.
OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i+1] || ' ' || w[i+2] for i in range(1, len(w) - 1)]) END AS s FROM w),
g AS (SELECT min(doc_id) AS rep, list_sort(s) AS s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY 2, 3),
e AS (SELECT rep, n, unnest(s) AS x FROM g),
f AS (SELECT x FROM e GROUP BY x HAVING count(*) > 1),
p AS (SELECT a.rep AS a, b.rep AS b, a.n + b.n AS n2 FROM (SELECT e.* FROM e JOIN f USING (x)) a JOIN (SELECT e.* FROM e JOIN f USING (x)) b USING (x)
      WHERE a.rep < b.rep AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN g ga ON ga.rep = p.a JOIN g gb ON gb.rep = p.b
      WHERE 190 * len(list_intersect(ga.s, gb.s)) >= 90 * n2),
r(v, c) AS (SELECT rep, rep FROM g UNION SELECT u.v, r.c FROM r JOIN (SELECT a AS v, b AS o FROM l UNION ALL SELECT b, a FROM l) u ON u.o = r.v),
c AS (SELECT v, min(c) AS c FROM r GROUP BY v)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.c, s.doc_id) AS component_id,
  coalesce(count(*) OVER (PARTITION BY g.rep), 1) * (g.rep IS NOT NULL)::BIGINT + (g.rep IS NULL)::BIGINT AS n_copies
FROM s LEFT JOIN g ON g.s = list_sort(s.s) LEFT JOIN c ON c.v = g.rep
"""

_WORDS = r"""list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""


def _weight_sql(depth: int, names: list[str]) -> str:
    cases = [f"WHEN {' AND '.join(f'{n} = {v!r}' for n, v in zip(names, k, strict=False))} THEN {w}" for k, w in MIX_WEIGHTS.items() if len(k) == depth]
    return f"CASE {' '.join(cases)} ELSE 1.0 END" if cases else "1.0"


def _mix_sql() -> str:
    path = ["domain", "lang", "source"]
    steps = []
    for depth in (1, 2, 3):
        names, parent = ", ".join(path[:depth]), ", ".join(path[: depth - 1])
        given = f"(SELECT least(sum(tokens) * {MIX_SHARE}, sum(cap)) FROM leaf)" if depth == 1 else "p.given"
        source = f"FROM n{depth}" + (f" JOIN g{depth - 1} p USING ({parent})" if depth > 1 else "")
        part = f"PARTITION BY {parent}" if parent else ""
        steps.append(f"n{depth} AS (SELECT {names}, sum(cap) AS cap, {_weight_sql(depth, path)} AS w FROM leaf GROUP BY {names})")
        steps.append(f"""l{depth} AS (SELECT {names}, cap, w, ({given} - coalesce(sum(cap) OVER b, 0)) / nullif(sum(w) OVER ({part}) - coalesce(sum(w) OVER b, 0), 0) AS level
            {source} WINDOW b AS ({part} ORDER BY cap / w, {names} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
        steps.append(f"g{depth} AS (SELECT {names}, least(cap, max(level) OVER ({part}) * w) AS given FROM l{depth})")
    return f"""
WITH d AS (SELECT doc_id, lang, source, CASE WHEN source = 'src0' THEN 'crawl' ELSE 'curated' END AS domain, CAST(len({_WORDS}) AS BIGINT) AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * {MIX_EPOCHS} AS DOUBLE) AS cap FROM d GROUP BY ALL),
{", ".join(steps)},
b AS (SELECT domain, lang, source, tokens, CAST(floor(round(given, 6)) AS BIGINT) AS budget FROM leaf JOIN g3 USING (domain, lang, source)),
q AS (SELECT *, coalesce(budget // nullif(tokens, 0), 0) AS epochs FROM b),
k AS (SELECT d.*, q.budget, q.epochs, q.budget - q.epochs * q.tokens AS rest, md5(concat_ws(':', '{MIX_SEED}', q.epochs, d.doc_id)) AS key FROM d JOIN q USING (domain, lang, source)),
u AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM k),
t AS (SELECT *, epochs + (upto <= rest)::BIGINT AS times FROM u)
SELECT doc_id, domain, lang, source, unnest(range(0, times)) AS epoch, n_tokens, budget FROM t
"""


OP3_SQL = _mix_sql()

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
i AS (SELECT row_number() OVER () AS rid, * FROM d),
x AS (SELECT rid, unnest(range(1, len(w) - 6)) AS pos, w FROM i WHERE len(w) > 8),
y AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, w[pos:pos+7]) AS c FROM x),
z AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(pos, pos + 8)) AS p FROM y WHERE c > 1) GROUP BY rid),
b AS (SELECT i.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda l: regexp_replace(l, '{SPACE_SQL}', '', 'g') <> '') AS lines, coalesce(z.n, 0) AS n_repeat_words
  FROM i LEFT JOIN z USING (rid)),
n AS (SELECT host, text, list_filter([lower(trim(regexp_replace(l, '{SPACE_SQL}', ' ', 'g'))) for l in string_split(text, chr(10))], lambda l: l <> '') AS lines FROM (SELECT DISTINCT host, text FROM i)),
g AS (SELECT host, text, unnest(lines) AS line FROM n),
h AS (SELECT host, text, line, CAST('0x' || md5(line)[1:15] AS BIGINT) AS no, len(string_split(line, ' ')) AS words FROM g),
e AS (SELECT host, count(DISTINCT text) AS texts FROM h GROUP BY host),
s AS (SELECT host, line FROM h JOIN e USING (host) GROUP BY host, line, texts HAVING count(DISTINCT text) >= 3 AND 100 * count(DISTINCT text) > 2 * texts),
u AS (SELECT host, text, sum(words) AS w, sum(words) FILTER (s.line IS NULL) AS own, min(no) FILTER (s.line IS NULL) AS first_own, min(no) FILTER (s.line IS NOT NULL) AS first_shared
  FROM h LEFT JOIN s USING (host, line) GROUP BY host, text),
t AS (SELECT host, text, CASE WHEN 100 * coalesce(own, 0) >= 30 * w THEN 'own ' || first_own ELSE 'shared ' || first_shared END AS witness FROM u),
c AS (SELECT host, line FROM h JOIN s USING (host, line) JOIN t USING (host, text) JOIN e USING (host) GROUP BY host, line, texts
  HAVING count(DISTINCT witness) >= 3 AND 100 * count(DISTINCT witness) > 2 * texts),
r AS (SELECT host, text, sum(words) AS removed FROM h JOIN c USING (host, line) GROUP BY host, text),
v AS (SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_words - coalesce(removed, 0) AS n_words_left FROM b LEFT JOIN r USING (host, text))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND n_words_left >= 20 AND 100 * n_words_left >= 30 * n_words AS kept, CAST(n_words_left AS BIGINT) AS n_words_left FROM v
"""

OP9_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
o AS (SELECT rid, unnest(range(1, len(w) + 1)) AS pos, w FROM d),
g AS (SELECT rid, pos, w[pos] AS x, CASE WHEN pos > 1 THEN w[pos-1] END AS p, len(w) AS n FROM o),
u1 AS (SELECT x, count(*) AS c FROM g GROUP BY x), o1 AS (SELECT rid, x, count(*) AS c FROM g GROUP BY ALL),
u2 AS (SELECT p, x, count(*) AS c FROM g WHERE p IS NOT NULL GROUP BY ALL), o2 AS (SELECT rid, p, x, count(*) AS c FROM g WHERE p IS NOT NULL GROUP BY ALL),
t AS (SELECT count(*) AS c FROM g),
k AS (SELECT g.rid, g.pos, (SELECT c FROM t) - g.n AS rest, u1.c - o1.c AS c1, up.c - op.c AS cp, u2.c - o2.c AS c2
  FROM g JOIN u1 ON u1.x = g.x JOIN o1 ON o1.rid = g.rid AND o1.x = g.x LEFT JOIN u1 up ON up.x = g.p LEFT JOIN o1 op ON op.rid = g.rid AND op.x = g.p
  LEFT JOIN u2 ON u2.p = g.p AND u2.x = g.x LEFT JOIN o2 ON o2.rid = g.rid AND o2.p = g.p AND o2.x = g.x),
s AS (SELECT rid, CASE WHEN c2 > 0 AND cp > 0 THEN ln(c2 / cp) WHEN c1 > 0 AND rest > 0 THEN (pos > 1)::INT * ln(0.4) + ln(c1 / rest) ELSE least(pos, 2) * ln(0.4) - ln(rest + 1.0) END AS s FROM k),
a AS (SELECT rid, sum(s) AS s FROM s GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(s, 0.0), 4) AS log_score, round(s / nullif(len(w), 0), 4) AS word_score FROM d LEFT JOIN a USING (rid)
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t FROM documents),
h AS (SELECT *, CAST(len(t) AS BIGINT) AS n, [CAST('0x' || x[8*i+1:8*i+8] AS BIGINT) for i in range(4)] AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
       WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(t[1:a], '') AS p, array_to_string(t[a+1:b], '') AS m, array_to_string(t[b+1:n], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""

# crc32 bit by bit over the digits of conv_id; nodes by the list of their turns' digests; subtrees by the members' paths.
OP12_SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key, turn,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'key': key, 'words': words} ORDER BY turn NULLS FIRST, key, words) AS own FROM t GROUP BY conv_id),
k(conv_id, own, rest, bit, c) AS (SELECT conv_id, own, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM o
  UNION ALL SELECT conv_id, own, CASE WHEN bit = 0 THEN rest[2:] ELSE rest END, (bit + 1) % 9,
    CASE WHEN bit = 0 THEN xor(c, CAST(ascii(rest) AS BIGINT)) WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END FROM k WHERE rest <> '' OR bit > 0),
h AS (SELECT conv_id, own, CAST(xor(c, CAST(4294967295 AS BIGINT)) % 4 AS INTEGER) AS h FROM k WHERE rest = '' AND bit = 0),
r AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h+1:]) AS p FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 20),
e AS (SELECT conv_id, len(p) AS size, d AS depth, sha256(array_to_string([x.key for x in p[1:d]], '')) AS node,
  CASE WHEN d > 0 THEN sha256(array_to_string([x.key for x in p[1:d-1]], '')) END AS parent, CASE WHEN d > 0 THEN p[d].words ELSE 0 END AS words
  FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM r)),
n AS (SELECT node, min(conv_id) AS conv_id, depth, min(parent) AS parent, count(*) AS n_convs, min(words) AS words,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256 FROM e GROUP BY node, depth),
c AS (SELECT parent AS node, count(*) AS n_children FROM n GROUP BY parent),
s AS (SELECT e.node, count(*) FILTER (c.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM n JOIN e ON e.conv_id = n.conv_id AND e.depth <= n.depth LEFT JOIN c ON c.node = n.node GROUP BY e.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s USING (node) LEFT JOIN n p ON p.node = n.parent LEFT JOIN c ON c.node = n.node
"""

#: op2, op4, op5, op7, op8, op13 and the pipeline have none: trees, checksums without retries, models and
#: dynamic programming are tested against brute force, planted cases and held-out rows.
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op3_mixing": OP3_SQL,
    "op6_quality_rules": OP6_SQL,
    "op9_exact_top_k": OP9_SQL,
    "op10_lm_scoring": OP10_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_conversation_trie": OP12_SQL,
}
