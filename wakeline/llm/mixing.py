"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected copies, target / size of the source. Within a source the
expected copies are summed up along an order, one random offset is added, and a document is taken once for every
whole number that its stretch of the sum crosses. So each document is taken floor or ceil of its expectation, and,
since the order is by size, the words taken are within one document's size of the target.

The order inside a source is (size, md5 of seed and id). A source may hold a third of all rows, and so may
one size of a source: rows are counted per (source, size, chunk of the md5) first, the counts are summed up, and
only rows of one such chunk are ranked together.

The result of a run depends on the seed and the rows alone.

``mixed`` gives the rows themselves; ``mix_sources`` the copies of each row, for tables without wide columns.

Defined cases: a null or wordless text has size 0 and weighs nothing, but is taken as often as its neighbours in the
order; a null source is a source of its own, the last; a source without words is not taken at all; rows that agree
in source, size and id may change places (they are alike for the mix); an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import read, stored

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the md5 that make up a chunk: 256 chunks to a size.
DIGITS = 2


def size_of(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, most=MOST) -> DataFrame:
    """Targets of (source, source_size): weights repeat in code point order of the sources, nulls last.

    A target is ``min(most * size, level * weight)`` with the level at which targets add up to the budget, which is
    what sharing the excess by weight again and again comes to. Sources reach their limit in the order of
    limit / weight, so the level follows from sums along that order. There is one row per source here.
    """
    at = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    rows = sizes.withColumn("__weight", F.element_at(F.array(*map(F.lit, weights)), at + 1).cast("double"))
    rows = rows.withColumn("__limit", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("__limit") / F.col("__weight"), F.col("source").asc_nulls_last())
    to_here = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    rows = rows.withColumns(
        {
            "__total": F.sum("source_size").over(whole).cast("double") * F.lit(float(budget)),
            "__before": F.coalesce(F.sum("__limit").over(to_here), F.lit(0.0)),
            "__lighter": F.sum("__weight").over(whole) - F.coalesce(F.sum("__weight").over(to_here), F.lit(0.0)),
        }
    )
    # If this source and all after it were below their limits, the level would be this; the first such one is it.
    level = (F.col("__total") - F.col("__before")) / F.col("__lighter")
    rows = rows.withColumn("__level", level).withColumn("__free", F.col("__level") * F.col("__weight") <= F.col("__limit"))
    rows = rows.withColumn("__level", F.min(F.when(F.col("__free"), F.struct("__before", "__level"))).over(whole)["__level"])
    target = F.when(F.col("__level").isNull(), F.col("__limit")).otherwise(
        F.least("__limit", F.col("__level") * F.col("__weight"))
    )
    return rows.select("source", "source_size", target.alias("target"))


def source_offset(source: Column, seed: str) -> Column:
    """The random offset of a source, from 0 to 1."""
    name = F.concat(F.lit(f"{seed}/"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix_sources(
    docs: DataFrame,
    weights=WEIGHTS,
    budget: float = BUDGET,
    most: int = MOST,
    seed: str = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The rows with ``__size``, ``__source_size``, ``__target`` and ``__copies``; columns of docs stay as they are."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null"))))
    rows = docs.withColumns({"__source": F.col(source_column), "__size": size_of(text_column), "__key": key})
    rows = rows.withColumn("__chunk", F.substring("__key", 1, DIGITS))
    chunk = ["__source", "__size", "__chunk"]

    counts = rows.groupBy(*chunk).agg(F.count("*").alias("__n"))
    sizes = counts.groupBy(F.col("__source").alias("source")).agg(F.sum(F.col("__size") * F.col("__n")).alias("source_size"))
    targets = source_targets(sizes, weights, budget, most)
    before = Window.partitionBy("__source").orderBy("__size", "__chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    counts = counts.join(targets, F.col("__source").eqNullSafe(F.col("source"))).select(
        *(F.col(c).alias(f"{c}_") for c in chunk), "__before", F.col("source_size").alias("__source_size"), F.col("target").alias("__target")
    )
    same = F.lit(True)
    for c in chunk:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    rows = rows.join(counts, same).drop(*(f"{c}_" for c in chunk))
    rank = F.row_number().over(Window.partitionBy(*chunk).orderBy("__key")) + F.col("__before")
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumns({"__rank": rank.cast("double"), "__rate": rate, "__offset": source_offset(F.col("__source"), seed)})
    copies = F.floor(F.col("__rank") * F.col("__rate") + F.col("__offset")) - F.floor(
        (F.col("__rank") - 1) * F.col("__rate") + F.col("__offset")
    )
    return rows.withColumn("__copies", copies.cast("long")).drop("__source", "__key", "__chunk", "__before", "__rank", "__rate", "__offset")


def mixed(
    docs: DataFrame,
    weights=WEIGHTS,
    budget: float = BUDGET,
    most: int = MOST,
    seed: str = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, their columns as they are.

    Copies are worked out on (source, size, key) of rows without their texts, a row for all that are wholly alike; texts are
    shuffled once, to meet their number of copies.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    own_id, own_text, own_source = (names[docs.columns.index(c)] for c in (id_column, text_column, source_column))
    others = F.to_json(F.struct(*(n for n in names if n != own_text)), {"ignoreNullFields": "false"})
    digest = F.md5(F.concat(F.coalesce(F.md5(own_text), F.lit("null")), others))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(own_id).cast("string"), F.lit("null"))))
    plain = docs.toDF(*names).withColumn("digest", digest)
    narrow = plain.select("digest", F.col(own_source).alias("source"), size_of(own_text).alias("size"), key.alias("key"))
    groups = stored(narrow.groupBy("digest", "source", "size", "key").agg(F.count("*").alias("n")), "mix")
    # The key orders a size, and the digest what has one id.
    groups = groups.withColumn("chunk", F.substring(F.md5(F.concat("key", "digest")), 1, DIGITS))
    counts = groups.groupBy("source", "size", "chunk").agg(F.sum("n").alias("n"))
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, weights, budget, most).withColumnRenamed("source", "source_")
    before = Window.partitionBy("source").orderBy("size", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    starts = starts.join(targets, F.col("source").eqNullSafe(F.col("source_"))).select(
        *(F.col(c).alias(f"{c}_") for c in ("source", "size", "chunk")), "before", "source_size", "target"
    )
    same = F.col("source").eqNullSafe(F.col("source_")) & (F.col("size") == F.col("size_")) & (F.col("chunk") == F.col("chunk_"))
    within = Window.partitionBy("source", "size", "chunk").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = groups.join(starts, same).select("digest", "n", "source", rank.alias("rank"), rate.alias("rate"))
    offset = source_offset(F.col("source"), seed)
    copies = F.floor((F.col("rank") + F.col("n")) * F.col("rate") + offset) - F.floor(F.col("rank") * F.col("rate") + offset)
    taken = rows.select(F.col("digest").alias("digest_"), copies.cast("int").alias("copies")).where("copies > 0")
    found = plain.dropDuplicates(["digest"]).join(taken, F.col("digest") == F.col("digest_"))
    found = found.select(F.explode(F.array_repeat(F.struct(*names), F.col("copies"))).alias("row"))
    return found.select(*(F.col(f"row.{n}").alias(c) for n, c in zip(names, docs.columns)))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).alias("taken"),
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3e0 WHEN 1 THEN 1e0 ELSE 2e0 END AS w,
         source_size * 2e0 AS lim FROM per),
ordered AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5e0 AS total,
         coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS filled,
         sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS rest
  FROM weighted),
leveled AS (
  SELECT (total - filled) / rest AS level FROM ordered
  WHERE (total - filled) / rest * w <= lim ORDER BY filled, level LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN (SELECT level FROM leveled) IS NULL THEN lim ELSE least(lim, (SELECT level FROM leveled) * w) END AS target
  FROM ordered),
ranked AS (
  SELECT doc_id, size, source_size, target, row_number() OVER (PARTITION BY source ORDER BY size, k) AS r,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0e0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix-1/' || coalesce('s' || source, 'null')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296e0 AS u
  FROM sized JOIN targets USING (source))
SELECT doc_id, size, source_size, target,
       size * CAST(floor(r * rate + u) - floor((r - 1) * rate + u) AS BIGINT) AS taken
FROM ranked
"""
