"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources share a budget by weight; none gets more than `max_epochs` times its
own words, and what is cut off goes to the others by weight. A source that is cut
off is taken whole that often. The rest of the budget is dealt among the other
sources as equal blocks of `block_words` words: the highest quotients
`weight / (2k - 1)` get a block each, first among sources, then among the
shards of a source (weighed by their words). A shard lays its documents in
seeded order on one line of words, cut into blocks; its quota is whole rounds of
the line and one cyclic run of words from a seeded block on. So a source takes its
quota to the word, which is its target to a block or two, and a run of neighbouring
blocks leaves all but two documents of a shard whole.

Everything is DataFrame code. The text is read once, for its word count; all
else runs on (doc_id, source, size). Shards hold about `shard_docs` documents
whatever a source's share, so a hot source is many tasks.

Null text: size 0, taken 0. A null source is a source of its own, last in
order. Repeated rows are documents of their own. An empty table gives none. Columns
beside doc_id, source and text may have any name and type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.llm.common import Scratch, row_digest, same, word_count

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 32
SHARD_DOCS = 2_000
SEED = "mix-1"


def _hash32(text: Column) -> Column:
    """32 bits of MD5, the same in any SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def fill(
    entries: DataFrame, group: Sequence[str], total: str, level: str = "level"
) -> DataFrame:
    """Shares of `total` by `weight`, none above `cap`: adds `full`, `rest_total`
    and `rest_weight`; an entry that is not full gets weight * rest_total /
    rest_weight. `total` is a column that is constant in each group.
    """
    by_ratio = Window.partitionBy(*group).orderBy(
        F.col("cap") / F.col("weight"), "entry"
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    marked = entries.withColumns({
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "weight_all": F.sum("weight").over(whole),
    }).withColumn(
        "full",
        F.expr(f"({total} - cap_before) * weight >= cap * (weight_all - weight_before)"),
    )
    return marked.withColumns({
        "rest_total": F.col(total) - F.sum(F.expr("IF(full, cap, 0)")).over(whole),
        "rest_weight": F.sum(F.expr("IF(full, 0, weight)")).over(whole),
    }).drop("cap_before", "weight_before", "weight_all")


def sainte_lague(entries: DataFrame, group: Sequence[str], seats: str) -> DataFrame:
    """Seats by the highest quotients weight / (2k - 1), k up to `cap`.

    `entries` has the group columns, `entry` (unique in its group, the lower one
    wins a tie), `weight` and `cap` (long, above 0) and the column `seats`,
    constant in a group. Returns (group, entry, quota).

    The shares by weight bracket the answer: half a seat of the lightest entry
    below them no more than `seats` are dealt, as much above them no fewer. So
    only the few quotients in between are ranked, at any number of seats.
    """
    keys = [*group, "entry"]
    light = F.min(F.expr("IF(full, NULL, weight)")).over(Window.partitionBy(*group))
    bracket = (
        fill(entries, group, seats)
        .withColumn("light", light)
        .withColumn("share", F.expr("IF(full, cap, weight * rest_total / rest_weight)"))
        .withColumn("reach", F.expr("IF(full, 0, weight / (2 * light))"))
        .withColumn("low", F.expr(
            "CAST(least(cap, greatest(0, floor(share - reach - 0.5))) AS LONG)"))
        .withColumn("high", F.expr("CAST(least(cap, ceil(share + reach + 1.5)) AS LONG)"))
    )
    open_seats = F.col(seats) - F.sum("low").over(Window.partitionBy(*group))
    bracket = bracket.withColumn("open", open_seats)
    quotients = bracket.where("high > low").withColumn(
        "k", F.explode(F.expr("sequence(low + 1, high)"))
    )
    best = Window.partitionBy(*group).orderBy(F.expr("(2 * k - 1) / weight"), "entry")
    won = (
        quotients.withColumn("place", F.row_number().over(best))
        .where("place <= open")
        .groupBy(*keys)
        .agg(F.count("*").alias("won"))
    )
    return bracket.join(won, keys, "left").select(
        *keys, F.expr("low + coalesce(won, 0)").alias("quota")
    )


def _plan(
    docs: DataFrame,
    carried: Sequence[str],
    weights: Sequence[int] = WEIGHTS,
    budget_percent: int = 150,
    max_epochs: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_docs: int = SHARD_DOCS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, size, source_size, target, carried columns, taken) of every document."""
    spark = docs.sparkSession
    slim = Scratch(spark, "mixing").write(
        docs.select(
            "doc_id", *carried,
            F.col("source").isNull().alias("no_source"),
            F.coalesce("source", F.lit("")).alias("source"),
            word_count("text").alias("size"),
        ),
        "sizes",
    )
    source = ["no_source", "source"]
    in_order = Window.orderBy(*source)  # one row per source
    sources = (
        slim.groupBy(*source)
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
        .withColumns({
            "entry": F.row_number().over(in_order),
            "all_size": F.sum("source_size").over(Window.partitionBy()),
            "shards": F.ceil(F.col("docs") / shard_docs),
        })
        .withColumn("weight", F.element_at(
            F.lit(list(weights)),
            F.pmod(F.col("entry") - 1, F.lit(len(weights))).cast("int") + 1,
        ).cast("long"))
        # Everything in hundredths of a word, so that the shares are exact.
        .withColumn("cap", F.col("source_size") * (100 * max_epochs))
        .withColumn("total", F.col("all_size") * budget_percent)
    )
    sources = fill(sources, [], "total").withColumn(
        "target",
        F.expr("IF(full, cap / 100D, weight * rest_total / (100D * rest_weight))"),
    )
    # One row per source and a few columns: the plans below start from it.
    sources = Scratch(spark, "mixing").write(
        sources.select(*source, "entry", "weight", "source_size", "full", "rest_total",
                       "shards", "target"),
        "sources",
    )
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = slim.join(sources, source).select(
        "doc_id", *carried, "size", "entry", "source_size", "target",
        F.md5(key).alias("place"),
        F.pmod(_hash32(key), F.col("shards")).alias("shard"),
    )
    shards = (
        placed.where("size > 0").groupBy("entry", "shard")
        .agg(F.sum("size").alias("shard_size"))
        # So many blocks hold the most that a shard may give.
        .withColumn("cap", F.expr(
            f"(shard_size * {max_epochs} + {block_words - 1}) div {block_words}"))
    )
    # The sources that take part in the apportionment, and their blocks in all.
    caps = shards.groupBy("entry").agg(F.sum("cap").alias("cap"))
    seats = sources.where("NOT full").join(caps, "entry").select(
        "entry", "weight", "cap",
        F.expr(f"(rest_total + {50 * block_words}) div {100 * block_words}").alias("seats"),
    )
    quotas = sainte_lague(seats, [], "seats").select(
        F.col("entry").alias("source_no"), F.col("quota").alias("seats")
    )
    shard_entries = shards.join(quotas, F.col("entry") == F.col("source_no")).select(
        "source_no", F.col("shard").alias("entry"), F.col("shard_size").alias("weight"),
        "cap", "seats",
    )
    shard_quotas = sainte_lague(shard_entries, ["source_no"], "seats").select(
        F.col("source_no").alias("entry"), F.col("entry").alias("shard"), "quota"
    )
    first = F.concat(F.lit(f"{seed}:"), "shard", F.lit(":"), "entry")
    # Shards of a full source have no quota: all of their words are taken.
    most = f"shard_size * {max_epochs}"
    runs = (
        shards.join(shard_quotas, ["entry", "shard"], "left")
        .withColumn("words", F.expr(f"coalesce(least(quota * {block_words}, {most}), {most})"))
        .select(
            "entry", "shard", "shard_size",
            F.expr("words div shard_size").alias("rounds"),
            F.expr("words % shard_size").alias("run"),
            (F.pmod(_hash32(first), F.ceil(F.col("shard_size") / block_words))
             * block_words).alias("from_word"),
        )
    )
    line = Window.partitionBy("entry", "shard").orderBy("place", "doc_id", "size", *carried)
    end = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))
    return (
        placed.withColumn("end", end)
        .join(runs, ["entry", "shard"], "left")
        .select(
            "doc_id", "size", "source_size", "target", *carried,
            F.expr("""
                CASE WHEN size = 0 THEN 0L ELSE rounds * size
                  + greatest(0L, least(end, from_word + run) - greatest(end - size, from_word))
                  + greatest(0L, least(end, from_word + run - shard_size) - (end - size)) END
            """).cast("long").alias("taken"),
        )
    )


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every document; options as in
    `_plan`."""
    return _plan(docs.select("doc_id", "source", "text"), [], **options)


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as its taken words say.

    Only documents at the ends of a run are taken in part; they are rounded to
    whole copies. A document without words is in no mix. Equal rows are decided
    together; rows that share a doc_id and differ in text or source are not.
    """
    own = docs.select("doc_id", "source", "text").withColumn("digest", row_digest())
    copies = (
        _plan(own, ["digest"], **options)
        .where("size > 0")
        .groupBy("doc_id", "digest")
        .agg(F.expr("round(sum(taken) / sum(size))").cast("int").alias("mix_copies"))
        .where("mix_copies >= 1")
        .select(F.col("doc_id").alias("mix_id"), F.col("digest").alias("mix_digest"), "mix_copies")
    )
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    return (
        docs.where(F.col("text").isNotNull())
        .select(whole, F.col("doc_id").alias("own_id"), row_digest().alias("own_digest"))
        .join(copies, same(F.col("own_id"), F.col("mix_id"))
              & (F.col("own_digest") == F.col("mix_digest")))
        .withColumn("copy", F.explode(F.expr("sequence(1, mix_copies)")))
        .select("row.*")
    )
