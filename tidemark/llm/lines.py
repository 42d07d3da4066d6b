"""Line dedup by a suffix array over line ids, in DataFrame functions only.

The corpus is read as one sequence of lines, in order of doc_id and line. Prefix doubling ranks its suffixes: rank k
orders positions by their next 2**k lines (within their document), and rank k + 1 comes from sorting the pairs of
rank k at a position and 2**k lines on. Pairs are ranked by range-partitioned sorting. A suffix whose pair is
unique has no repeat of that length, so it keeps its place and drops out; what is left shrinks fast.

Positions that share a rank form an interval of the suffix array whose longest common prefix is at least that many
lines. A run of lines counts as repeated if it has `min_words` words (a line counts one at least) and its interval
holds an earlier position. Every maximal repeated run is the union of its shortest long-enough stretches, from each
start forwards and from each end backwards, so only their intervals are looked up: for n lines, from the ranks of
the first and the last 2**k of them. As such stretches have `min_words` lines at most, doubling ends there.

All copies of a run but the first in the corpus are deleted. Copies may overlap: a line repeated over and over
leaves what comes before the first repetition.

Defined cases: lines are compared exactly; null text has no lines and stays null; rows with null doc_id come first.
Rows with the same doc_id and text are one document and share its fate, so they aren't each other's copies. Among
equal positions nothing else decides, so results don't depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, apart, whole_row

_BLANKS = " \t\n\x0b\x0c\r"
_FIRST = -(1 << 63)
#: A document: its id (null as the smallest number) and a hash of its text.
_DOC = ["__tm_d", "__tm_h"]


def _words(line: Column) -> Column:
    trimmed = F.btrim(line, F.lit(_BLANKS))
    return F.when(trimmed == "", 1).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+")))


def _document_key(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"__tm_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)), "__tm_h": F.xxhash64("text")})


def _ranked(classes: DataFrame, keys: list[str]) -> DataFrame:
    """Increasing numbers for the keys that occur more than once, in their order."""
    repeated = classes.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
    return repeated.orderBy(*keys).withColumn("r", F.monotonically_increasing_id())


def line_table(docs: DataFrame) -> DataFrame:
    """A row for each line: its document, number, words and two hashes that stand for its text."""
    lines = _document_key(docs.where(F.col("text").isNotNull()).select("doc_id", "text")).select(*_DOC, F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return lines.select(*_DOC, "i", _words(F.col("line")).alias("w"), F.xxhash64("line").alias("a"), F.xxhash64(F.lit(7), F.col("line")).alias("b"))


def suffix_ranks(scratch: Scratch, lines: DataFrame, longest: int) -> list[DataFrame]:
    """For k = 0, 1, ..: document, i and r of the positions whose next 2**k lines occur elsewhere too."""
    first = lines.join(_ranked(lines, ["a", "b"]), ["a", "b"]).select(*_DOC, "i", "w", "r").dropDuplicates([*_DOC, "i"])
    ranks = [scratch.keep(first)]
    step = 1
    while 2 * step <= longest:
        here = ranks[-1].select(*_DOC, "i", F.col("r").alias("a"))
        ahead = ranks[-1].select(*_DOC, (F.col("i") - step).alias("i"), F.col("r").alias("b"))
        pairs = scratch.keep(here.join(ahead, [*_DOC, "i"]))
        found = scratch.keep(pairs.join(_ranked(pairs, ["a", "b"]), ["a", "b"]).select(*_DOC, "i", "r"))
        scratch.drop(pairs)
        if found.isEmpty():
            break
        ranks.append(found)
        step *= 2
    return ranks


def stretches(repeated: DataFrame, min_words: int) -> DataFrame:
    """Document, i and n of the shortest stretches of repeated lines with min_words words, from each start and each end."""
    by_doc = Window.partitionBy(*_DOC).orderBy("i")
    islands = repeated.withColumn("g", F.col("i") - F.row_number().over(by_doc))
    island = Window.partitionBy(*_DOC, "g")
    upto = islands.withColumn("c", F.sum("w").over(island.orderBy("i"))).withColumn("c0", F.col("c") - F.col("w"))
    forwards, backwards = island.orderBy("c0"), island.orderBy("c")
    sized = upto.select(
        *_DOC,
        "i",
        F.when(F.max("c").over(island) - F.col("c0") >= min_words, F.count("*").over(forwards.rangeBetween(0, min_words - 1))).alias("f"),
        F.when(F.col("c") - F.min("c0").over(island) >= min_words, F.count("*").over(backwards.rangeBetween(1 - min_words, 0))).alias("n"),
    )
    ahead = sized.where("f is not null").select(*_DOC, "i", F.col("f").alias("n"))
    behind = sized.where("n is not null").select(*_DOC, (F.col("i") - F.col("n") + 1).cast("int").alias("i"), "n")
    return ahead.union(behind).distinct()


def later_copies(scratch: Scratch, ranks: list[DataFrame], min_words: int) -> DataFrame:
    """Document, i and n of the stretches that occur earlier in the corpus."""
    power = F.floor(F.log2("n") + 1e-9).cast("int")
    wanted = stretches(ranks[0], min_words).withColumn("k", power).withColumn("j", (F.col("i") + F.col("n") - F.expr("shiftleft(1, k)")).cast("int"))
    level = [found.select(*_DOC, "i", "r", F.lit(k).alias("k")) for k, found in enumerate(ranks)]
    every = level[0]
    for found in level[1:]:
        every = every.union(found)
    begins = every.select(*_DOC, "k", "i", F.col("r").alias("a"))
    ends = every.select(*_DOC, "k", F.col("i").alias("j"), F.col("r").alias("b"))
    classed = scratch.keep(wanted.join(begins, [*_DOC, "k", "i"]).join(ends, [*_DOC, "k", "j"]).select(*_DOC, "i", "n", "a", "b"))
    place = F.struct(*_DOC, "i")
    heads = classed.groupBy("n", "a", "b").agg(F.min(place).alias("head"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    return classed.join(apart(heads), ["n", "a", "b"]).where(place != F.col("head")).select(*_DOC, "i", "n")


def dedup(spark: SparkSession, docs: DataFrame, min_words: int = 50) -> DataFrame:
    """docs without later copies of repeated runs, with __tm_lines and __tm_removed: lines before, and removed.

    A text that loses all its lines becomes empty. Other columns stay as they are; two of the names above give way.
    """
    docs = docs.drop("__tm_lines", "__tm_removed")
    scratch = Scratch(spark)
    lines = scratch.keep(line_table(docs))
    ranks = suffix_ranks(scratch, lines, min_words)
    copies = later_copies(scratch, ranks, min_words)
    numbers = F.explode(F.sequence(F.col("i"), (F.col("i") + F.col("n") - 1).cast("int")))
    removed = scratch.keep(copies.select(*_DOC, numbers.alias("i")).groupBy(*_DOC).agg(F.collect_set("i").alias("gone")))
    scratch.drop_all_but(removed)
    # The texts meet their removed lines by sorting at every size, so the plan doesn't depend on an estimate.
    keyed = _document_key(docs.select(whole_row(docs.drop("text")), "doc_id", "text")).drop("doc_id")
    out = keyed.join(removed.hint("merge"), _DOC, "left").withColumn("lines", F.split("text", "\n"))
    out = out.withColumn("left", F.when(F.col("gone").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")))
    rest = F.array_join(F.transform("left", lambda k: F.get("lines", k)), "\n")
    text = F.when(F.col("left").isNotNull(), rest).otherwise(F.col("text"))
    counts = (F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("__tm_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("__tm_removed"))
    return out.select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns), *counts)


def oracle_sql(min_words: int = 50) -> str:
    """DuckDB SQL for the registered query."""
    return f"""
WITH l0 AS (SELECT doc_id::bigint AS doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
l1 AS (SELECT *, greatest(1, len(list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))) AS w FROM l0),
l AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS c, sum(w) OVER (PARTITION BY doc_id ORDER BY i) - w AS c0 FROM l1),
s AS (SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.c - a.c0 >= {min_words} GROUP BY ALL
  UNION SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.c - a.c0 >= {min_words} GROUP BY ALL),
t AS (SELECT s.doc_id, s.s, s.e, string_agg(l.line, chr(10) ORDER BY l.i) AS run FROM s JOIN l ON l.doc_id = s.doc_id AND l.i BETWEEN s.s AND s.e GROUP BY ALL),
r AS (SELECT doc_id, s, e FROM t QUALIFY row_number() OVER (PARTITION BY run, e - s ORDER BY doc_id, s) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM r),
o AS (SELECT l.doc_id, count(*)::bigint AS n_lines, count(g.i)::bigint AS n_removed, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text
  FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, text FROM o
UNION ALL SELECT doc_id::bigint, 0, 0, NULL FROM documents WHERE text IS NULL
"""
