"""Shards that each hold the whole mixture: proportional stratified interleaving.

Every source's rows are shuffled by a seeded hash and ranked; row number r of a
source with n rows stands at (r - 1 + phase) / n on a line from 0 to 1, with a
seeded phase for each source. All rows sorted by that place are cut into `shards`
runs of equal length. A run of the line holds the same share of every source, so a
shard has its share of each source to within two rows, and no two shards differ by
more than one row in all (law `rows`). Without the phase all sources of one row
would meet in the middle shard.

Ranks are counted, not gathered: a source is cut by the leading bits of the hash,
the line by place, into buckets of about `BUCKET_ROWS` rows; a row's rank is the
count of the buckets before its own and its number inside. So a source with a third
of all rows is as many tasks as its rows need. Equal rows (id, source, size and
checksum) are numbered first, in buckets of the parts they were read in, and the
number is hashed along, which spreads a row that comes a million times like
any others, and makes the result the same whatever the partitions.

Null text: no bytes, size 8, checksum 0. A null source is a source of its own, a
null doc_id an id like others. Repeated rows are rows of their own. An empty
table gives no rows. With more shards than rows some stay empty. Columns beside
doc_id, source and text may have any name and type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.llm.common import Scratch

SHARDS = 24
BUCKET_ROWS = 4_000
SEED = "shards-1"
# Bytes that a row counts besides its text.
ROW_BYTES = 8


def _marked(column: str) -> Column:
    """Text of a value; null differs from every text."""
    return F.coalesce(F.concat(F.lit("+"), F.col(column).cast("string")), F.lit("-"))


def _hash32(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _before(counts: DataFrame, group: list[str], by: str) -> DataFrame:
    """Running total of `n` over the buckets before each one, as `start`."""
    order = Window.partitionBy(*group).orderBy(by)
    earlier = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("start", F.coalesce(earlier, F.lit(0))).drop("n")


def _slim(docs: DataFrame, row: Column) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = docs.select(
        row.alias("row"), "doc_id",
        _marked("source").alias("source"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    who = F.concat_ws(":", _marked("doc_id"), "size", "text_crc32", "source")
    return parts.withColumn("who", F.md5(who))


def _copies(slim: DataFrame) -> DataFrame:
    """Numbers equal rows from 0, as `copy`; others get 0."""
    repeated = Scratch(slim.sparkSession, "sharding").write(
        slim.groupBy("who").agg(F.count("*").alias("n")).where("n > 1").select("who"),
        "repeated",
    )
    if repeated.isEmpty():
        return slim.withColumn("copy", F.lit(0).cast("long"))
    # The high bits of a row's number are the part it was read in.
    parts = slim.withColumn("part", F.shiftright("row", 33))
    again = parts.join(repeated, "who", "left_semi")
    starts = _before(
        again.groupBy("who", "part").agg(F.count("*").alias("n")), ["who"], "part"
    )
    inside = F.row_number().over(Window.partitionBy("who", "part").orderBy("row"))
    numbered = again.withColumn("inside", inside).join(starts, ["who", "part"])
    return slim.join(repeated, "who", "left_anti").withColumn(
        "copy", F.lit(0).cast("long")
    ).unionByName(
        numbered.withColumn("copy", F.expr("start + inside - 1")).select(*slim.columns, "copy")
    )


def _ranked(rows: DataFrame, key: list[str], bucket: str, order: list[str]) -> DataFrame:
    """The rank from 0 of each row among those with its `key`, as `rank`. `bucket`
    numbers parts of them that follow each other in `order`."""
    counts = rows.groupBy(*key, bucket).agg(F.count("*").alias("n"))
    inside = F.row_number().over(Window.partitionBy(*key, bucket).orderBy(*order))
    return (
        rows.withColumn("inside", inside)
        .join(_before(counts, key, bucket), [*key, bucket])
        .withColumn("rank", F.expr("start + inside - 1"))
        .drop("inside", "start")
    )


def _placed(slim: DataFrame, shards: int, seed: str) -> DataFrame:
    """(row, doc_id, size, text_crc32, shard, slot) for each row of `_slim`."""
    scratch = Scratch(slim.sparkSession, "sharding")
    sources = scratch.write(
        slim.groupBy("source").agg(F.count("*").alias("rows")).withColumn(
            "phase",
            (_hash32(F.md5(F.concat(F.lit(f"{seed}:"), "source"))) + 0.5) / 4294967296.0,
        ),
        "sources",
    )
    total = sources.agg(F.sum("rows")).first()[0] or 0
    key = F.md5(F.concat_ws(":", F.lit(seed), "who", "copy"))
    shuffled = (
        _copies(slim).withColumn("place", key).join(sources, "source")
        .withColumn("bucket", F.expr(
            f"CAST(shiftright(CAST(conv(substring(place, 1, 8), 16, 10) AS BIGINT)"
            f" * ceil(rows / {BUCKET_ROWS}D), 32) AS INT)"
        ))
    )
    cells = max(1, -(-total // BUCKET_ROWS))
    line = scratch.write(
        _ranked(shuffled, ["source"], "bucket", ["place"])
        .withColumn("at", F.expr("(rank + phase) / rows"))
        .select("row", "doc_id", "size", "text_crc32", "place", "at",
                F.floor(F.col("at") * cells).cast("long").alias("cell")),
        "line",
    )
    first = f"(shard * {total} + {shards - 1}) div {shards}"
    return (
        _ranked(line, [], "cell", ["at", "place"])
        .withColumn("shard", F.expr(f"CAST(rank * {shards} div {max(total, 1)} AS INT)"))
        .withColumn("slot", F.expr(f"rank - {first}"))
        .drop("place", "at", "cell", "rank")
    )


def shard_plan(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    The text is read once, for its size and checksum; all else runs on these.
    """
    slim = Scratch(docs.sparkSession, "sharding").write(
        _slim(docs, F.monotonically_increasing_id()), "rows"
    )
    return _placed(slim, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, seed: str = SEED,
    files_per_shard: int = 1,
) -> None:
    """The rows themselves as (slot, document), in folders `shard=<n>`, in slot order
    inside a file and from file to file. The input is written once with row numbers,
    which its rows keep if an executor is lost, and joined with their places."""
    scratch = Scratch(docs.sparkSession, "sharding")
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    numbered = scratch.write(
        docs.select(F.monotonically_increasing_id().alias("row"), whole.alias("whole")),
        "numbered",
    )
    slim = scratch.write(
        _slim(numbered.select("row", "whole.doc_id", "whole.source", "whole.text"),
              F.col("row")),
        "rows",
    )
    places = _placed(slim, shards, seed).select("row", "shard", "slot")
    (
        numbered.join(places, "row")
        .select("shard", "slot", F.col("whole").alias("document"))
        .repartitionByRange(shards * files_per_shard, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )
