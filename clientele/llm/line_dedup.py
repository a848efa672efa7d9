"""Repeated runs of lines, deleted but for their first copy. DataFrame operations only.

Each repeated line has a line ID; a document is a sequence of IDs. Prefix doubling over all suffixes of the sequences
gives, level by level, the rank class of the first 2**j lines of every suffix: a class of level j + 1 is a pair of
classes of level j, 2**j lines apart. Suffixes whose class has one member are done (nothing that begins there repeats)
and leave, so every level is smaller than the one before. Suffixes with a common prefix of n lines, 2**j <= n < 2**(j+1),
are those that agree in the two overlapping classes of level j at both ends of the n lines: an interval of the suffix
array whose longest common prefix is n or more. The order of classes within the array is not needed, and not computed.

A line is deleted if it lies in a run of lines with ``min_words`` words or more that occurs before, that is, at an earlier
place in the order of ids, texts with one id, and lines. It suffices to look up, for each line, the shortest run of so
many words that begins with it and the shortest that ends with it: each line of a longer repeated run is in the former of
the run's first line or ends the latter, and all lines of both belong to the longer run. Deleted neighbours make up the
maximal repeated runs.

Nulls and edge cases: a null text has no lines and stays null; an empty text is one empty line. Words are counted by
blanks. Rows with the same id and text are one document: each gets the same result. A null id comes before all others.
A run may overlap its earlier occurrence: of one line many times in a row, the first stays. Other columns are kept as
they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import Scratch

MIN_WORDS = 50
NO_ID = -(1 << 63)


def _key(id_column: str, text_column: str) -> list[Column]:
    return [F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_column).alias("print")]


def _numbered(frame: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """A number for each row, in row order, fixed by writing it."""
    return scratch.save(frame.withColumn(name, F.monotonically_increasing_id()))


def repeated_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc, print, line)`` of every line to delete; doc and print (a hash of the text) name a document."""
    scratch = Scratch(docs.sparkSession)
    split = docs.where(F.col(text_column).isNotNull())
    split = split.select(*_key(id_column, text_column), F.posexplode(F.split(text_column, "\n", -1)).alias("line", "own"))
    blanks = F.length(F.trim("own")) - F.length(F.translate(F.trim("own"), " ", ""))
    words = F.when(F.trim("own") == "", 0).otherwise(blanks + 1)
    lines = split.select(
        "doc", "print", "line", words.alias("words"),
        F.xxhash64("own").alias("h1"), F.xxhash64(F.lit(1), "own").alias("h2"),
    )
    lines = scratch.save(lines)

    # Line IDs, for lines that repeat, and documents in order.
    ids = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    ids = _numbered(ids, "rank", scratch)
    active = scratch.save(lines.join(ids, ["h1", "h2"]).select("doc", "print", "line", "words", "rank"))
    scratch.drop(lines)
    order = _numbered(active.select("doc", "print").distinct().orderBy("doc", "print"), "d", scratch)
    active = active.join(order, ["doc", "print"]).groupBy("d", "line").agg(F.max("words").alias("words"), F.max("rank").alias("rank"))
    active = scratch.save(active)

    # Runs: the shortest one of enough words from each line on, and up to each line, within neighbouring lines.
    by_line = Window.partitionBy("d").orderBy("line")
    spans = active.select("d", "line", "words", (F.col("line") - F.row_number().over(by_line)).alias("stretch"))
    within = Window.partitionBy("d", "stretch")
    sofar = within.orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.withColumn("upto", F.sum("words").over(sofar).cast("long"))
    spans = spans.withColumn("before", F.col("upto") - F.col("words"))
    ahead = within.orderBy("before").rangeBetween(Window.unboundedPreceding, min_words - 1)
    behind = within.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)
    spans = spans.select(
        "d", "line", "upto", "before",
        F.min("line").over(within).alias("first"), F.max("upto").over(within).alias("all"),
        F.count("*").over(ahead).alias("ahead"), F.count("*").over(behind).alias("behind"),
    )
    forward = spans.where(F.col("all") - F.col("before") >= min_words)
    forward = forward.select("d", F.col("line").alias("s"), (F.col("first") + F.col("ahead") - 1).cast("int").alias("e"))
    backward = spans.where(F.col("upto") >= min_words)
    backward = backward.select("d", (F.col("first") + F.col("behind")).cast("int").alias("s"), F.col("line").alias("e"))
    runs = forward.union(backward).distinct().withColumn("n", F.col("e") - F.col("s") + 1)
    level = F.floor(F.log2("n") + 1e-9).cast("int")
    runs = scratch.save(runs.withColumn("level", level).withColumn("t", F.col("e") - F.pow(2.0, "level").cast("int") + 1))

    # Prefix doubling, up to the level that the longest run asks for.
    last = runs.agg(F.max("level")).first()[0]
    ranks = active.select("d", "line", "rank", F.lit(0).alias("level"))
    now, step = active.select("d", "line", "rank"), 1
    for j in range(1, (last or 0) + 1):
        following = now.select("d", (F.col("line") - step).alias("line"), F.col("rank").alias("rank2"))
        pairs = scratch.save(now.join(following, ["d", "line"]))
        classes = pairs.groupBy("rank", "rank2").agg(F.count("*").alias("m")).where("m > 1").drop("m")
        classes = _numbered(classes, "next", scratch)
        now = scratch.save(pairs.join(classes, ["rank", "rank2"]).select("d", "line", F.col("next").alias("rank")))
        scratch.drop(pairs)
        ranks = ranks.union(now.select("d", "line", "rank", F.lit(j).alias("level")))
        step *= 2

    # Runs that agree at both ends are one interval; all but its first member are later copies.
    starts = ranks.select("d", F.col("line").alias("s"), "level", F.col("rank").alias("r1"))
    ends = ranks.select("d", F.col("line").alias("t"), "level", F.col("rank").alias("r2"))
    known = runs.join(starts, ["d", "s", "level"]).join(ends, ["d", "t", "level"])
    place = (F.col("d").cast("decimal(20,0)") * F.lit(10**10).cast("decimal(11,0)") + F.col("s")).alias("place")
    known = scratch.save(known.select("d", "s", "e", "n", "r1", "r2", place))
    firsts = known.groupBy("n", "r1", "r2").agg(F.min("place").alias("least"), F.count("*").alias("m"))
    firsts = scratch.save(firsts.where("m > 1").drop("m"))
    later = known.join(firsts, ["n", "r1", "r2"]).where("place > least")
    reach = later.groupBy("d", F.col("s").alias("line")).agg(F.max("e").alias("e"))
    covered = active.select("d", "line").join(reach, ["d", "line"], "left")
    covered = covered.withColumn("reach", F.max("e").over(by_line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return scratch.save(covered.where("reach >= line").select("d", "line").join(order, "d").select("doc", "print", "line"))


def without_repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents with three more columns: ``kept_text``, ``n_lines`` and ``n_deleted``."""
    gone = repeated_lines(docs, min_words, id_column, text_column)
    gone = gone.groupBy("doc", "print").agg(F.collect_list("line").alias("_gone"))
    gone = gone.withColumnsRenamed({"doc": "_doc", "print": "_print"})
    key = dict(zip(("_doc", "_print"), _key(id_column, text_column), strict=True))
    # Never broadcast: what is deleted grows with the documents.
    joined = docs.withColumns(key).join(gone.hint("merge"), ["_doc", "_print"], "left")
    # The split lines are bound once, as a lambda variable, and looked up by place.
    bound = F.array(F.struct(F.split(text_column, "\n", -1).alias("lines"), F.col("_gone").alias("gone")))

    def rest(x: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["gone"])
        return F.array_join(F.transform(places, lambda i: F.element_at(x["lines"], i + 1)), "\n")

    kept = F.when(F.col("_gone").isNull(), F.col(text_column)).otherwise(F.transform(bound, rest)[0])
    count = F.when(F.col(text_column).isNull(), 0).otherwise(F.size(F.split(text_column, "\n", -1)))
    return joined.select(
        *(F.col(c) for c in docs.columns),
        kept.alias("kept_text"),
        count.cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_deleted"),
    )
