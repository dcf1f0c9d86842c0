"""Mixing sources to target weights by systematic sampling over exact prefix sums of expected copies.

Within a source every document has the same expected number of copies, target / size of the source. Documents stand in a
fixed order (size class, then a hash); the k-th gets one copy for each integer that lies in (u + k e, u + (k + 1) e], so its
count is e rounded up or down, and the words taken from each size class keep its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walrill.llm.common import WORD_PATTERN, fresh_name, materialise

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its size, and all together so many hundredths of all sizes.
MOST, SHARE_PERCENT = 2, 150
#: Rows ranked by one task at most, about.
CELL_ROWS = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.expr("0") + F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """``target`` for each row of ``sources`` (source, source_size): weights share the whole, full sources' excess is reshared.

    A source is full if, in the order of size / weight, its cap is within the share left by the full ones before it. One row
    for each source goes through the windows here, never rows of documents."""
    order = Window.orderBy(F.col("source").isNull(), F.expr("cast(source as binary)"))
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int")).cast("decimal(20,0)")
    d = sources.select("source", "source_size", w.alias("w"), F.col("source_size").cast("decimal(30,0)").alias("s"))
    by_ratio = Window.orderBy(F.col("s").cast("double") / F.col("w").cast("double"), F.col("source").isNull(), F.expr("cast(source as binary)"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    d = d.select("*", F.sum("s").over(every).alias("all_s"), F.sum("w").over(every).alias("all_w"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s_before"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before"))
    # All in doubles of integers below 2**53: exact up to the last division.
    left = F.col("all_s").cast("double") * (SHARE_PERCENT / 100) - MOST * F.col("s_before").cast("double")
    full = MOST * F.col("s").cast("double") * (F.col("all_w") - F.col("w_before")).cast("double") <= F.col("w").cast("double") * left
    d = d.select("*", full.alias("full"))
    full_s = F.sum(F.when(F.col("full"), F.col("s")).otherwise(F.lit(0))).over(every).cast("double")
    full_w = F.sum(F.when(F.col("full"), F.col("w")).otherwise(F.lit(0))).over(every).cast("double")
    rest = F.col("all_s").cast("double") * (SHARE_PERCENT / 100) - MOST * full_s
    share = F.col("w").cast("double") * rest / (F.col("all_w").cast("double") - full_w)
    return d.select("source", "source_size", F.when(F.col("full"), MOST * F.col("s").cast("double")).otherwise(share).alias("target"))


def with_copies(docs: DataFrame, text: str = "text", source: str = "source", row_id: str = "doc_id", carry: list[str] | None = None, stored: bool = False) -> DataFrame:
    """``docs`` with size, source_size, target and copies (how often the mix takes the row). The same rows give the same mix.

    Null texts and texts without words have size 0; a null source is a source of its own, last; rows with a null or repeated
    id are rows of their own. An empty table gives an empty result. New names get underscores in front where taken.
    The prefix sum has three levels: rows are ranked inside cells (source, size class, hash) of bounded size, the counts of the
    cells are summed per source and class, and those of the classes per source, so a source with a third of all rows needs no
    task of its own. Texts are read twice, for the counts and for the result; with ``stored``, for rows of which little is
    carried, once."""
    kept = docs.columns if carry is None else carry
    size, source_size, target, copies = (fresh_name(docs.select(*kept), n) for n in ("size", "source_size", "target", "copies"))
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(row_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).cast("binary"))
    rows = docs.select(F.struct(*kept).alias("mix_row"), F.col(source).alias("mix_source"), n_words(F.col(text)).alias("mix_size"), digest.alias("mix_hash"))
    klass = F.when(F.col("mix_size") == 0, F.lit(-1)).otherwise(F.floor(F.log2(F.col("mix_size").cast("double")) * 4)).cast("int")
    narrow = rows = materialise(rows) if stored else rows
    if not stored:
        narrow = materialise(rows.select("mix_source", "mix_size", "mix_hash"))
    counted = materialise(narrow.groupBy("mix_source", klass.alias("mix_class")).agg(F.count(F.lit(1)).alias("n"), F.sum("mix_size").alias("s")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    cells = max(1, -(-total // CELL_ROWS))
    cell = F.pmod(F.conv(F.substring("mix_hash", 1, 8), 16, 10).cast("long"), F.lit(cells)).cast("int")
    rows, narrow = (df.select("*", klass.alias("mix_class"), cell.alias("mix_cell")) for df in (rows, narrow))
    by_source = targets(counted.groupBy(F.col("mix_source").alias("source")).agg(F.sum("s").alias("source_size")))
    # A row for each cell: all rows / CELL_ROWS for each source and size class.
    sizes = narrow.groupBy("mix_source", "mix_class", "mix_cell").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.unboundedPreceding, -1
    cells_before = Window.partitionBy("mix_source", "mix_class").orderBy("mix_cell").rowsBetween(*upto)
    classes_before = Window.partitionBy("mix_source").orderBy("mix_class").rowsBetween(*upto)
    so_far = lambda over: F.coalesce(F.sum("n").over(over), F.lit(0))
    bases = sizes.select(F.col("mix_source").alias("b_source"), F.col("mix_class").alias("b_class"), F.col("mix_cell").alias("b_cell"), so_far(cells_before).alias("cells_base"))
    classes = counted.select(F.col("mix_source").alias("c_source"), F.col("mix_class").alias("c_class"), so_far(classes_before).alias("class_base"))
    bases = bases.join(classes, F.col("b_source").eqNullSafe(F.col("c_source")) & (F.col("b_class") == F.col("c_class"))).withColumn("mix_base", F.col("cells_base") + F.col("class_base"))
    bases = materialise(bases.join(by_source, F.col("b_source").eqNullSafe(F.col("source"))).select("b_source", "b_class", "b_cell", "mix_base", "source_size", "target"))
    inside = Window.partitionBy("mix_source", "mix_class", "mix_cell").orderBy("mix_size", "mix_hash")
    ranked = rows.select("*", F.row_number().over(inside).alias("mix_rank"))
    joined = ranked.join(bases, F.col("mix_source").eqNullSafe(F.col("b_source")) & (F.col("mix_class") == F.col("b_class")) & (F.col("mix_cell") == F.col("b_cell")))
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(MOST)), F.col("target") / F.col("source_size").cast("double"))).otherwise(0.0)
    offset = F.conv(F.substring(F.md5(F.coalesce(F.col("mix_source"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / 2.0**32
    k = (F.col("mix_base") + F.col("mix_rank")).cast("double")
    # Rounding of very large k may give one copy more than the rate allows.
    n = F.least(F.lit(MOST), F.floor(offset + k * rate) - F.floor(offset + (k - 1) * rate))
    return joined.select("mix_row.*", F.col("mix_size").alias(size), F.col("source_size").alias(source_size), F.col("target").alias(target), n.cast("int").alias(copies))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", row_id: str = "doc_id") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its own columns."""
    rows = with_copies(docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"), F.col(source).alias("source"), F.col(row_id).alias("doc_id")), carry=["row"])
    return rows.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def mixture(docs: DataFrame) -> DataFrame:
    """The digest of :func:`with_copies` for each row of ``docs`` (doc_id, text, source)."""
    out = with_copies(docs.select("doc_id", "text", "source"), carry=["doc_id"], stored=True)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


MIXTURE_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS h FROM documents),
c AS (SELECT *, CASE WHEN size = 0 THEN -1 ELSE floor(log2(size::DOUBLE) * 4)::INT END AS class,
             ('0x' || substr(h, 1, 8))::BIGINT % greatest(1, ((SELECT count(*) FROM d) + 99999) // 100000) AS cell FROM d),
s AS (SELECT source, sum(size)::DOUBLE AS s FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY (source IS NULL), source::BLOB) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM s),
b AS (SELECT *, sum(s) OVER () AS all_s, sum(w) OVER () AS all_w,
             coalesce(sum(s) OVER o, 0) AS s_before, coalesce(sum(w) OVER o, 0) AS w_before FROM w
      WINDOW o AS (ORDER BY s / w, (source IS NULL), source::BLOB ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 2 * s * (all_w - w_before) <= w * (all_s * 1.5 - 2 * s_before) AS is_full FROM b),
t AS (SELECT source, s::BIGINT AS source_size, CASE WHEN is_full THEN 2 * s ELSE
        w * (all_s * 1.5 - 2 * sum(CASE WHEN is_full THEN s ELSE 0 END) OVER ()) / (all_w - sum(CASE WHEN is_full THEN w ELSE 0 END) OVER ()) END AS target FROM f),
r AS (SELECT c.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN least(2.0::DOUBLE, t.target / t.source_size::DOUBLE) ELSE 0.0 END AS rate,
             ('0x' || substr(md5(coalesce(c.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u,
             row_number() OVER (PARTITION BY c.source ORDER BY class, cell, size, h)::DOUBLE AS k
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * least(2, floor(u + k * rate) - floor(u + (k - 1) * rate)))::BIGINT AS taken FROM r
"""
