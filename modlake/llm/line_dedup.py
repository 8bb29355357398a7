"""Line dedup with DataFrame functions only.

A line's key is the line stripped of ASCII white space with A-Z lower-cased. Keys long enough that
occur in enough documents lose all their lines, except those in the smallest doc_id that holds the
key. The text itself is read twice and shuffled once, by document; what is exploded and shuffled by
key is 40 bytes a line, and keys are counted partially before the shuffle. Keys that hold over one in
HOT_SHARE of all repeated lines, of which there are HOT_SHARE at most, are broadcast, and their lines are
dealt evenly in the join that marks lines dropped; so no line, however common, meets in one task.

Edge cases: a null or empty text is one empty line; a text whose lines are all dropped becomes empty;
rows with the same doc_id are one document for the counts, and each keeps or loses its own lines;
a null doc_id never keeps a key that another document holds; columns of docs pass through untouched, and if
docs has a column n_lines or n_dropped, the count of that name gets an underscore after its name.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.llm.store import free_name, stored

HOT_SHARE = 1024
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with `text` rebuilt, and the columns n_lines and n_dropped (long) added."""
    name = lambda n: free_name(n, docs.columns)
    row, d, r, gone_at = (name(n) for n in ("row_hash", "of_doc", "of_row", "gone_at"))
    rows = docs.withColumn(row, F.xxhash64(F.col(doc_id), F.col(text)))
    lines = rows.select(F.col(doc_id).alias("d"), F.col(row).alias("r"), F.posexplode(lines_of(F.col(text))).alias("pos", "line"))
    keyed = lines.select("d", "r", "pos", line_key(F.col("line")).alias("k")).where(F.char_length("k") >= min_chars)
    hashed = keyed.select("d", "r", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(17), F.col("k")).alias("h2"))
    if min_docs == 2:  # two documents: the smallest and the largest id differ
        counted = hashed.groupBy("h1", "h2").agg(F.min("d").alias("keeper"), F.max("d").alias("last"), F.max(F.col("d").isNull()).alias("nulls"), F.count(F.lit(1)).alias("n"))
        common = counted.where((F.col("keeper") < F.col("last")) | (F.col("keeper").isNotNull() & F.col("nulls")))
    else:
        held = hashed.groupBy("h1", "h2", "d").agg(F.count(F.lit(1)).alias("n"))
        counted = held.groupBy("h1", "h2").agg(F.min("d").alias("keeper"), F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"))
        common = counted.where(F.col("docs") >= min_docs)
    common = stored(common.select("h1", "h2", "keeper", "n"), "common")
    limit = (common.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE
    hot = common.where(F.col("n") > limit).select(F.col("h1").alias("x1"), F.col("h2").alias("x2"), F.col("keeper").alias("hot_keeper"), F.lit(True).alias("hot"))
    cold = common.where(F.col("n") <= limit).select(F.col("h1").alias("y1"), F.col("h2").alias("y2"), F.col("keeper").alias("cold_keeper"), F.lit(True).alias("cold"))
    lines = hashed.join(F.broadcast(hot), (F.col("h1") == F.col("x1")) & (F.col("h2") == F.col("x2")), "left")
    lines = lines.withColumn("h1", F.when(F.col("hot"), F.xxhash64("r", "pos")).otherwise(F.col("h1")))
    lines = lines.join(cold, (F.col("h1") == F.col("y1")) & (F.col("h2") == F.col("y2")), "left")
    keeper = F.when(F.col("hot"), F.col("hot_keeper")).otherwise(F.col("cold_keeper"))
    gone = (
        lines.where((F.col("hot") | F.col("cold")) & ~F.col("d").eqNullSafe(keeper))
        .groupBy(F.col("d").alias(d), F.col("r").alias(r))
        .agg(F.sort_array(F.collect_set("pos")).alias(gone_at))
    )
    # a table of its own, so that the join with it can split a row that repeats very often
    out = rows.join(stored(gone, "gone"), F.col(doc_id).eqNullSafe(F.col(d)) & (F.col(row) == F.col(r)), "left")
    all_lines = lines_of(F.col(text))
    kept = F.filter(F.zip_with(all_lines, _flags(F.col(gone_at), F.size(all_lines)), lambda line, drop: F.when(~drop, line)), lambda x: x.isNotNull())
    return out.withColumns(
        {
            name("n_lines"): F.size(all_lines).cast("long"),
            name("n_dropped"): F.when(F.col(gone_at).isNull(), 0).otherwise(F.size(gone_at)).cast("long"),
            text: F.when(F.col(gone_at).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")),
        }
    ).drop(row, d, r, gone_at)


def _flags(gone: Column, n: Column) -> Column:
    """An array of n booleans, true at the sorted positions in gone, in time linear in n.

    The gaps between positions become runs of false.
    """
    ends = F.concat(gone, F.array(n))
    before = F.concat(F.array(F.lit(-1)), gone)
    runs = F.zip_with(before, ends, lambda a, b: F.concat(F.when(a >= 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")), F.array_repeat(F.lit(False), b - a - 1)))
    return F.flatten(runs)
