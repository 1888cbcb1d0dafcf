"""Packing into optimal length buckets.

Lengths are counted over all documents; dynamic programming over the histogram chooses the bucket
boundaries with the least padding; inside a bucket, batches of a token budget form in seeded order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartmetrics.llm.common import cut
from cartmetrics.llm.mixing import count_words

#: Rows of a bucket that one task numbers.
GROUP_ROWS = 200_000


def histogram_cell(length: Column, bits: int) -> Column:
    """Number of the histogram cell: the length with all but its `bits` leading binary digits dropped."""
    drop = F.greatest(F.length(F.bin(length)) - bits, F.lit(0))
    return F.floor(length / F.pow(F.lit(2.0), drop)).cast("long") * F.pow(F.lit(2.0), drop).cast("long")


def optimal_bounds(tops: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets over rising lengths with the least sum of bound * documents.

    best[j] = min over i of previous[i] + tops[j] * (total[j] - total[i]): lines in tops[j], whose
    lower hull is walked once per bucket."""
    size = len(tops)
    total = [0]
    for c in counts:
        total.append(total[-1] + int(c))
    previous: list[float] = [0] + [float("inf")] * size
    choices: list[list[int]] = []
    for _ in range(min(buckets, size)):
        current, choice = [float("inf")] * (size + 1), [0] * (size + 1)
        hull: list[tuple[int, int, int]] = []  # slope, intercept, i
        at = 0
        for j in range(1, size + 1):
            if previous[j - 1] != float("inf"):
                line = (-total[j - 1], int(previous[j - 1]), j - 1)
                while len(hull) >= 2 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]):
                    hull.pop()
                hull.append(line)
                at = min(at, len(hull) - 1)
            x = int(tops[j - 1])
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            if hull:
                current[j], choice[j] = x * total[j] + hull[at][0] * x + hull[at][1], hull[at][2]
        choices.append(choice)
        if current[size] >= previous[size]:
            choices.pop()
            break
        previous = current
    bounds, j = [], size
    for choice in reversed(choices):
        if j == 0:
            break
        bounds.append(int(tops[j - 1]))
        j = choice[j]
    return bounds[::-1]


def length_histogram(lengths: DataFrame, bits: int | None = None) -> DataFrame:
    """top (largest length of the cell) and count, for lengths (n_tokens)."""
    cell = F.col("n_tokens") if bits is None else histogram_cell(F.col("n_tokens"), bits)
    cells = lengths.groupBy(cell.alias("cell")).agg(F.max("n_tokens").alias("top"), F.count("*").alias("count"))
    return cells.select("top", "count")


def pack_batches(
    docs: DataFrame, buckets: int = 8, batch_tokens: int = 16384, seed: int = 0, tokens: Column | None = None,
    keep: Sequence[str] = (), bits: int | None = None,
) -> DataFrame:
    """doc_id, n_tokens, bucket (its bound), batch and place for each row of docs (doc_id, text), and with `keep` these
    columns and copy (0, 1, ... over rows of one doc_id and text).

    A bucket's batch holds as many rows as its bound fits into `batch_tokens`, one at least; only the
    last batch of a bucket holds fewer. Batches are numbered from 0 in each bucket, places in each batch.
    n_tokens: `tokens`, or the number of words of the whole text; null and empty texts have 0. Equal
    lengths share a bucket. Repeated rows are packed each; their order among themselves is open. Null
    doc_ids are packed like others. An empty table gives an empty result. Other columns are ignored.

    The driver gets one number per distinct length, and bounds are optimal. With `bits`, lengths of more binary digits
    are rounded up within their leading ones: at most 2^bits numbers per doubling, at a loss in padding of at most
    2^(1 - bits) of the tokens. Rows are ordered by a hash of seed, doc_id and text and dealt into groups by it; equal
    rows travel as one with their number, so that no task gets the copies of a document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    count = count_words(F.col("text")) if tokens is None else tokens
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    fields = ["doc_id", count.alias("n_tokens"), name.alias("name"), F.xxhash64(F.lit(seed), name, text).alias("order")]
    kept = [F.struct(*keep).alias("kept"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")] if keep else []
    rows = cut(docs.select(*fields, *kept))
    cells = sorted((r["top"], r["count"]) for r in length_histogram(rows, bits).collect())
    bounds = optimal_bounds([c[0] for c in cells], [c[1] for c in cells], buckets)
    n_groups = max(1, -(-sum(c[1] for c in cells) // GROUP_ROWS))
    bucket = F.array_min(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds or [0]]), lambda b: b >= F.col("n_tokens")))
    same = ["n_tokens", "name", "order"]
    placed = rows.groupBy("doc_id", *same).agg(F.count("*").alias("copies")).withColumns({"bucket": bucket, "group": F.pmod("order", F.lit(n_groups))})
    groups = placed.groupBy("bucket", "group").agg(F.sum("copies").alias("n"))
    start = F.sum("n").over(Window.partitionBy("bucket").orderBy("group")) - F.col("n")
    starts = cut(groups.select("bucket", "group", start.alias("start")))
    # Groups deal a bucket's rows over tasks; each numbers its own rows from where the group begins.
    upto = F.sum("copies").over(Window.partitionBy("bucket", "group").orderBy("order", "name", "n_tokens"))
    numbered = placed.withColumn("upto", upto).join(starts, ["bucket", "group"]).withColumn("first", F.col("start") + F.col("upto") - F.col("copies"))
    per = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.greatest("bucket", F.lit(1)))).cast("long")
    out = ["doc_id", "n_tokens", "bucket", F.floor(F.col("i") / per).cast("long").alias("batch"), (F.col("i") % per).cast("long").alias("place")]
    if not keep:
        each = numbered.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        return each.withColumn("i", F.col("first") + F.col("copy")).select(*out)
    # Equal rows are told apart by the parts that they were written in, and inside a part by their number.
    parts = rows.groupBy(*same, "part").agg(F.count("*").alias("n"))
    parts = parts.withColumn("before", F.sum("n").over(Window.partitionBy(*same).orderBy("part")) - F.col("n")).drop("n")
    # What is kept stays behind meanwhile and moves once, to the place of its row.
    inside = F.row_number().over(Window.partitionBy(*same, "part").orderBy("row")) - 1
    copies = rows.select(*same, "part", "row").withColumn("inside", inside).join(parts, [*same, "part"]).withColumn("copy", (F.col("before") + F.col("inside")).cast("long"))
    each = copies.join(numbered, same).withColumn("i", F.col("first") + F.col("copy")).select("row", "copy", *(out[1:] if "doc_id" in keep else out))
    return each.join(rows.select("row", "kept"), "row").select(*each.columns[2:], "copy", "kept.*")
