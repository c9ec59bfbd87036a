"""Documents of very many lines, in chunks: gathered, stored and read back by parts.

An invoice's document is one text. Documents of more than a chunk's lines are cut: each
run of `chunk_lines` of their distinct lines in order becomes a document of its own,
stored under a numbered qualifier. One with a tenth of all lines would be gathered by
one task, so the lines of long ones are ranked and gathered by many. A read puts the
texts end to end again; nobody parses them, and the result is that of one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.functions.sizing import written
from cellframe.model import FAMILY, INVOICE_COLUMNS, ORDER_FIELDS, PUT, TOMBSTONE
from cellframe.operators.layout import octets

CHUNK_LINES = 100_000

# Lines of an invoice that one task may gather, and bytes of lines that it gets in all.
GATHERED, TASK_BYTES = 1000, 16 << 20


def nest_chunks(lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """(Invoice, chunk, orders): the distinct lines of each invoice in order, as JSON
    texts of at most `chunk_lines` lines, numbered from 0.

    The lines are read twice, to count and to gather them, so what is costly to make is
    to be written first. They cross one exchange, by ranges of invoices, and each invoice
    is cut where it was gathered; so the chunks lie in ranges of keys, a range a task.
    Only invoices of more than `GATHERED` lines are ranked before, by many tasks, and
    dealt by their chunks. A null invoice is one of its own.
    """
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = lines.select("Invoice", octets([F.col(c) for c in lines.columns]).alias("bytes")).groupBy(
        "Invoice"
    ).agg(F.count("*").alias("lines"), F.sum("bytes").alias("bytes"))
    is_long = F.col("lines") > GATHERED
    found = counts.agg(F.sum("bytes").alias("bytes"), F.bool_or(is_long).alias("long")).first()
    ranges = -(-(found["bytes"] or 0) // TASK_BYTES) or 1

    packed = lines.select("Invoice", F.struct(*ORDER_FIELDS).alias("Order"))
    place = ["Invoice"]
    if found["long"]:
        long = written(
            lines.sparkSession, counts.where(is_long).select(F.col("Invoice").alias("of")), "long"
        )
        same = F.col("Invoice").eqNullSafe(F.col("of"))
        short = packed.join(long, same, "left_anti").withColumn("part", F.lit(None).cast("int"))
        packed = short.unionByName(_ranked(packed.join(long, same, "left_semi"), chunk_lines))
        place, ranges = ["Invoice", "part"], max(ranges, tasks)
    gathered = packed.repartitionByRange(ranges, *place).groupBy(*place).agg(
        F.sort_array(F.collect_set("Order")).alias("Orders")
    )
    texts = F.expr(f"""transform(sequence(0, (size(Orders) - 1) div {chunk_lines}), i -> struct(
        CAST(i AS INT) AS i,
        to_json(slice(Orders, CAST(i * {chunk_lines} + 1 AS INT), {chunk_lines}),
                map('ignoreNullFields', 'true')) AS orders))""")
    # A part is one chunk, and has its number.
    chunk = F.coalesce("part", "text.i") if "part" in place else F.col("text.i")
    return gathered.select(*place, F.explode(texts).alias("text")).select(
        "Invoice", chunk.alias("chunk"), F.col("text.orders").alias("orders")
    )


def _ranked(packed: DataFrame, chunk_lines: int) -> DataFrame:
    """The distinct lines of long invoices, each with the chunk that it belongs to as `part`.

    Repeats fold before the first shuffle, which deals lines, not invoices. Ranks are
    counted: lines are sorted into ranges, a range's lines of an invoice are numbered, and
    the counts of the ranges before give where its numbers begin.
    """
    spark = packed.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The ranges must stay as they are while they are counted and numbered.
    ranged = written(
        spark,
        packed.distinct().repartitionByRange(tasks, "Invoice", "Order")
        .withColumn("range", F.spark_partition_id()),
        "chunk-lines",
    )
    of_invoice = Window.partitionBy("Invoice").orderBy("range")
    before = F.sum("held").over(of_invoice.rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        ranged.groupBy("Invoice", "range").agg(F.count("*").alias("held"))
        .select(
            F.col("Invoice").alias("of"), F.col("range").alias("in_range"),
            F.coalesce(before, F.lit(0)).alias("start"),
        )
    )
    inside = F.row_number().over(Window.partitionBy("Invoice", "range").orderBy("Order"))
    return ranged.withColumn("inside", inside).join(
        starts, F.col("Invoice").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in_range"))
    ).select(
        "Invoice", "Order",
        F.expr(f"CAST((start + inside - 1) div {chunk_lines} AS INT)").alias("part"),
    )


def chunk_cells(chunks: DataFrame) -> DataFrame:
    """(row_key, qualifier, value) of chunked documents: the first chunk has the plain
    qualifier, the others a numbered one; the key field is a cell, too. Each chunk
    expands in place."""
    key, field = INVOICE_COLUMNS

    def cell(qualifier: Column, value: str) -> Column:
        return F.struct(qualifier.alias("qualifier"), F.col(value).alias("value"))

    first = F.array(cell(F.lit(field), "orders"), cell(F.lit(key), key))
    later = F.array(cell(F.format_string(f"{field}#%06d", "chunk"), "orders"))
    return chunks.select(
        F.col(key).alias("row_key"), F.inline(F.when(F.col("chunk") == 0, first).otherwise(later))
    )


def whole_documents(log: DataFrame, family: str = FAMILY) -> DataFrame:
    """(Invoice, orders): the newest live document of every row, put together.

    A run has one time and commit number; only the chunks of the run that wrote the
    newest first chunk belong to it, so a shorter document leaves nothing of the
    longer one before it. The texts, older ones too, cross one exchange, by row: it serves both
    groupings.
    """
    key, field = INVOICE_COLUMNS
    chunk = (F.col("qualifier") == field) | F.col("qualifier").startswith(f"{field}#")
    newest = (
        log.where((F.col("kind") == PUT) & (F.col("family") == family) & chunk)
        .select("row_key", "qualifier", "ts", "seq", "value")
        .repartition("row_key")
        .groupBy("row_key", "qualifier")
        .agg(F.max(F.struct("ts", "seq", "value")).alias("v"))
    )
    documents = newest.groupBy("row_key").agg(
        F.max(F.when(F.col("qualifier") == field, F.struct("v.ts", "v.seq"))).alias("head"),
        F.sort_array(F.collect_list(F.struct("qualifier", "v"))).alias("parts"),
    )
    deleted = log.where(F.col("kind") == TOMBSTONE).groupBy("row_key").agg(
        F.max("ts").alias("deleted_ts")
    )
    live = documents.join(deleted, "row_key", "left").where(
        "deleted_ts IS NULL OR head.ts > deleted_ts"
    )
    return live.selectExpr(
        f"row_key AS {key}",
        f"""concat('[', array_join(transform(
              filter(parts, p -> p.v.ts = head.ts AND p.v.seq = head.seq),
              p -> substring(p.v.value, 2, length(p.v.value) - 2)), ','), ']') AS {field}""",
    )
