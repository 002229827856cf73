"""Sharding by extendible hashing.

Rows are placed by the leading bits of a hash.  The directory starts at one
depth and only the buckets over the byte limit split on their next bit,
until every bucket fits.  A directory entry is a (depth, prefix); the rows
find theirs with one equi join on (depth, prefix) over the depths in use, so
the directory is never doubled to the deepest one.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .shared import fresh_name, materialise

# Fixed value: leading bits of the MD5 that are used, 15 hex digits.
HASH_BITS = 60


def row_hash(*columns: Column) -> Column:
    """Leading 60 bits of the MD5 of the columns' text; nulls count as
    empty, fields are separated so that they cannot run together."""
    joined = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def _prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, HASH_BITS - depth)


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """Buckets (depth, prefix, shard_bytes, shard_rows) of ``rows`` (h,
    n_bytes).  A bucket is final when it fits ``limit`` or when all its rows
    have one hash, which no further bit can part.

    Each level aggregates map-side to one row per bucket; only buckets that
    must split are looked at again.  The loop ends because a bucket of two
    hashes parts at one of the 60 bits at the latest.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    # The depth at which an even spread would fill half of each bucket; the
    # levels below it are reached by the same test, merged up first.
    depth = min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total) / limit))) if total > limit else 0)
    final = []
    # Top-down from depth 0 is what "only oversized buckets split" means; a
    # histogram at ``depth`` answers all the levels above without the rows.
    cells = materialise(rows.groupBy(_prefix(F.col("h"), depth).alias("cell")).agg(
        F.sum("n_bytes").alias("b"), F.count("*").alias("n"),
        F.min("h").alias("lo"), F.max("h").alias("hi")), "shard_cells")
    open_cells = cells
    for d in range(depth + 1):
        sums = open_cells.groupBy(F.shiftright("cell", depth - d).alias("prefix")).agg(
            F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows"),
            F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        sums = materialise(sums.withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi"))),
                           f"shard_level_{d}")
        final.append(sums.where("fits").select(F.lit(d).alias("depth"), "prefix", "shard_bytes", "shard_rows"))
        split = sums.where("not fits").select(F.col("prefix").alias("open"))
        if split.isEmpty():
            return reduce(DataFrame.unionByName, final)
        open_cells = open_cells.join(split, F.shiftright("cell", depth - d) == F.col("open"), "left_semi")
    d = depth
    while True:
        rows = rows.join(split, _prefix(F.col("h"), d) == F.col("open"), "left_semi")
        d += 1
        sums = materialise(rows.groupBy(_prefix(F.col("h"), d).alias("prefix")).agg(
            F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"),
            F.min("h").alias("lo"), F.max("h").alias("hi"))
            .withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi"))),
            f"shard_level_{d}")
        final.append(sums.where("fits").select(F.lit(d).alias("depth"), "prefix", "shard_bytes", "shard_rows"))
        split = sums.where("not fits").select(F.col("prefix").alias("open"))
        if split.isEmpty():
            return reduce(DataFrame.unionByName, final)


def assign_shards(df: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id, n_bytes, shard`` (the bucket's bits, empty for the
    whole table), ``depth, page, shard_bytes, shard_rows``.

    Every shard (bits and page) holds at most ``limit`` bytes of text, or a
    single row longer than that.  Rows hash by id and text, so a hot id or
    source spreads.  Exact repeats of a row share their whole hash and no bit
    can part them: such a bucket is cut into ``page``s of as many copies as
    fit, numbered in two steps (per part of the ordinals, then within it) so
    that no task holds all copies.  Null ids and texts hash as empty and a
    null text has 0 bytes.  Empty tables give an empty result; other columns
    are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialise(df.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
                                 row_hash(F.col(id_col), text).alias("h")), "shard_rows")
    buckets = materialise(directory(rows.select("h", "n_bytes"), limit), "shard_directory")
    depths = [r.depth for r in buckets.select("depth").distinct().collect()]  # 61 at most
    if not depths:
        return rows.select("id", "n_bytes", F.lit("").alias("shard"), F.lit(0).alias("depth"),
                           F.lit(0).cast("long").alias("page"), F.col("n_bytes").alias("shard_bytes"),
                           F.lit(1).cast("long").alias("shard_rows")).limit(0)
    at = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(F.col("h"), d).alias("prefix")) for d in sorted(depths)])
    # A row meets exactly one bucket: prefixes of one hash are nested and
    # only one of them is a leaf.
    placed = (rows.select("id", "n_bytes", "h", F.explode(at).alias("at"))
              .select("id", "n_bytes", "h", "at.depth", "at.prefix")
              .join(buckets, ["depth", "prefix"]))
    bits = F.when(F.col("depth") == 0, "").otherwise(
        F.expr("right(lpad(conv(cast(prefix as string), 10, 2), 64, '0'), depth)"))
    placed = placed.withColumn("shard", bits)
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
    columns = ("id", "n_bytes", "shard", "depth", "page", "shard_bytes", "shard_rows")
    whole = placed.where(fits).withColumn("page", F.lit(0).cast("long")).select(*columns)
    return whole.unionByName(_pages(placed.where(~fits), limit).select(*columns))


def _pages(copies: DataFrame, limit: int) -> DataFrame:
    """Number the equal rows of over-full buckets.  The rows are equal, so
    only their counts matter: they are counted, dealt out in runs of at most
    1,024 and unfolded run by run."""
    run = 1024
    counted = copies.groupBy("id", "n_bytes", "shard", "depth").agg(F.count("*").alias("n"))
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1)))).cast("long")
    counted = counted.withColumn("per_page", per_page)
    # Runs of runs: both sequences stay short where one row repeats billions of times.
    outer = F.expr(f"sequence(0L, (n - 1) div {run * run})")
    inner = F.expr(f"sequence(0L, {run - 1}L)")
    unfolded = (counted.withColumn("a", F.explode(outer)).repartition("shard", "a")
                .withColumn("b", F.explode(inner))
                .withColumn("first", (F.col("a") * run + F.col("b")) * run).where("first < n")
                .withColumn("at", F.explode(F.expr(f"sequence(first, least(n, first + {run}) - 1)"))))
    unfolded = unfolded.withColumn("page", F.floor(F.col("at") / F.col("per_page")).cast("long"))
    in_page = F.least("per_page", F.col("n") - F.col("page") * F.col("per_page"))
    return unfolded.select("id", "n_bytes", "shard", "depth", "page",
                           (in_page * F.col("n_bytes")).alias("shard_bytes"), in_page.alias("shard_rows"))


def write_shards(df: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``df`` with one folder per shard; ``placed`` is the result of
    ``assign_shards``.  Rows find their shard by their id, so an id that
    repeats (no id is one, too), which would multiply its rows, raises."""
    if not placed.groupBy("id").count().where("count > 1").isEmpty():
        raise ValueError("ids repeat; write_shards needs unique ones")
    name = fresh_name(df, "__id")
    at = placed.select(F.col("id").alias(name), F.concat_ws("-", "shard", "page").alias("shard_page"))
    joined = df.join(at, F.col(id_col).eqNullSafe(F.col(name))).drop(name)
    joined.repartition("shard_page").write.partitionBy("shard_page").parquet(path)
