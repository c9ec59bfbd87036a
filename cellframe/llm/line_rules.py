"""Quality rules: base counts of a text, and line frequency across documents.

A line is frequent on a host when more than `max_docs` distinct texts of the
host hold it and these are more than `max_share` of the host's distinct texts.
Frequent lines are removed, and a document of which more than `max_removed` of
the words go that way is depleted and rejected. The distinct text with the
smallest doc_id keeps a frequent line, so passages that many documents share
stay in one of them, and exact copies do not make a line frequent.

Lines are compared by their words (lower case, single spaces) through a 64-bit
hash that includes the host; only hashes are shuffled, and counts are combined
on the map side, so a line in a third of all documents costs one row a task.

Null or empty text: no words, `base_failed`. A null source is a host of its own.
Verdicts and lost lines belong to a row's host and text: repeated rows each get a
row with the same verdict, rows that only share a doc_id, or have none, don't. An
empty table gives none. Columns beside doc_id, source and text may have any name
and type.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.llm.common import Scratch, map_columns, row_digest, same, words_of

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCS = 20
MAX_SHARE = 0.01
MAX_REMOVED = 0.5


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside a window of `width` words that occurs twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    numbers = np.fromiter(
        (known.setdefault(w, len(known)) for w in words), np.int64, len(words)
    )
    # Windows as exact numbers: fold in one word at a time, renumbering.
    windows = numbers[:n]
    for step in range(1, width):
        pairs = windows * len(known) + numbers[step : step + n]
        windows = np.unique(pairs, return_inverse=True)[1]
    repeated = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(words), bool)
    for step in range(width):
        covered[step : step + n] |= repeated
    return int(covered.sum())


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _salt(host: str | None) -> bytes:
    return b"\0" if host is None else b"\1" + host.encode() + b"\0"


def _line_key(salt: bytes, own: list[bytes]) -> int:
    """Hash of a line's words in lower case, on its host."""
    normal = b" ".join(own).decode().lower().encode()
    return _signed(xxhash.xxh64_intdigest(salt + normal))


def _profile(host: str | None, text: str | None) -> tuple:
    """Base counts, the hash and words of each distinct line, and the hash of every
    line in order (null for blank ones)."""
    words = words_of(text)
    if not words:
        symbols = sum(text.count(chr(c)) for c in SYMBOLS) if text else 0
        return 0, 0, symbols, 0, 0, [], [], []
    raw = text.encode()
    word_chars = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    salt = _salt(host)
    seen: set[bytes] = set()
    lines: dict[int, int] = {}
    keys: list[int | None] = []
    repeats = 0
    for line in raw.split(b"\n"):
        own = line.split()
        if not own:
            keys.append(None)
            continue
        repeats += line in seen
        seen.add(line)
        key = _line_key(salt, own)
        keys.append(key)
        lines[key] = lines.get(key, 0) + len(own)
    return (
        len(words), word_chars, symbols, repeats, repeated_words(words),
        list(lines), list(lines.values()), keys,
    )


def line_profiles(docs: DataFrame) -> DataFrame:
    """One row per document: digest of the row, base counts, distinct lines as (hash,
    words), and all lines in order by their hashes."""

    def run(ids: list, hosts: list, digests: list, texts: list) -> list[list]:
        columns = list(zip(*map(_profile, hosts, texts))) or [[] for _ in range(8)]
        return [ids, hosts, digests, *map(list, columns)]

    return map_columns(
        docs.select("doc_id", "source", row_digest().alias("digest"), "text"),
        "doc_id long, host string, digest long, n_words long, word_chars long, "
        "n_symbols long, n_dup_lines long, n_repeat_words long, "
        "lines array<long>, line_words array<int>, line_keys array<long>",
        run,
    )


def base_failed() -> Column:
    return F.expr(
        f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    )


def frequent_lines(profiles: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """(line, carrier): hashes of the lines above both limits of their host, and
    the digest of the text that keeps the line."""
    texts = profiles.where("n_words > 0").groupBy("host", "digest")
    sizes = (
        texts.agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("texts"))
    )
    found = (
        profiles.select("host", "digest", "doc_id", F.explode("lines").alias("line"))
        .groupBy("host", "line", "digest")
        .agg(F.min("doc_id").alias("doc_id"))
        .groupBy("host", "line")
        .agg(
            F.count("*").alias("docs"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first"),
        )
        .where(F.col("docs") > max_docs)
    )
    sizes = sizes.withColumnRenamed("host", "size_host")
    return found.join(sizes, F.col("host").eqNullSafe(F.col("size_host"))).where(
        F.col("docs") > F.col("texts") * max_share
    ).select("line", F.col("first.digest").alias("carrier"))


def _verdicts(
    docs: DataFrame, max_docs: int, max_share: float, max_removed: float
) -> DataFrame:
    """Base counts, words left after the removal of frequent lines, verdict, and the
    hashes of the lines that go; the profiles are written once."""
    profiles = Scratch(docs.sparkSession, "lines").write(line_profiles(docs), "profiles")
    frequent = frequent_lines(profiles, max_docs, max_share)
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return (
        profiles.drop("lines", "line_words", "host")
        .join(_gone(profiles, frequent), "digest", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("n_kept_words", left)
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (F.col("n_kept_words") >= F.col("n_words") * (1 - max_removed)),
        )
    )


def _gone(profiles: DataFrame, frequent: DataFrame) -> DataFrame:
    """(digest, gone, removed): hashes of the lines that a text loses, and their words.

    By text, not by document: copies share their lines and their fate. The hash
    of a line holds its host.
    """
    return (
        profiles.select("digest", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
        .select("digest", F.col("l.lines").alias("line"), F.col("l.line_words").alias("w"))
        .join(frequent, "line")
        .where(F.col("digest") != F.col("carrier"))
        .groupBy("digest", "line").agg(F.max("w").alias("w"))
        .groupBy("digest")
        .agg(F.collect_list("line").alias("gone"), F.sum("w").alias("removed"))
    )


def judge(
    docs: DataFrame,
    max_docs: int = MAX_DOCS,
    max_share: float = MAX_SHARE,
    max_removed: float = MAX_REMOVED,
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_kept_words) of every document."""
    return _verdicts(docs, max_docs, max_share, max_removed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "n_kept_words",
    )


def _with_gone(docs: DataFrame, profiles: DataFrame, how: str) -> DataFrame:
    """Whole documents, joined with the `profiles` of their rows: their texts are
    without the lines whose hashes are in `gone`."""
    places = F.expr("""
        filter(transform(line_keys, (k, i) -> IF(array_contains(gone, k), i, -1)), i -> i >= 0)
    """)
    said = profiles.groupBy("doc_id", "digest").agg(F.first(places).alias("places"))
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    own = docs.select(whole, F.col("doc_id").alias("own_id"), row_digest().alias("own_digest"))
    joined = own.join(
        said, same(F.col("own_id"), F.col("doc_id")) & (F.col("own_digest") == F.col("digest")),
        how,
    )

    def column(name: str) -> Column:
        value = F.col(f"row.`{name}`")
        if name.lower() != "text":
            return value
        left = F.filter(
            F.split(value, "\n", -1), lambda _, i: ~F.array_contains(F.col("places"), i)
        )
        cut = F.when(F.size("places") > 0, F.array_join(left, "\n")).otherwise(value)
        return cut.cast(docs.schema[name].dataType).alias(name)

    return joined.select(*map(column, docs.columns))


def clean_lines(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """All documents, their texts without frequent lines; `frequent` comes from
    `frequent_lines`. Other columns, a stored length too, stay as they are."""
    profiles = line_profiles(docs)
    return _with_gone(docs, profiles.join(_gone(profiles, frequent), "digest"), "left")


def keep_documents(
    docs: DataFrame,
    max_docs: int = MAX_DOCS,
    max_share: float = MAX_SHARE,
    max_removed: float = MAX_REMOVED,
) -> DataFrame:
    """The documents that the rules keep, their texts without frequent lines, and all
    other columns as they are. Verdicts go by row: rows that share a doc_id, or have
    none, and differ in text or source are kept or rejected each by its own."""
    verdicts = _verdicts(docs, max_docs, max_share, max_removed)
    return _with_gone(docs, verdicts.where("kept"), "inner")
