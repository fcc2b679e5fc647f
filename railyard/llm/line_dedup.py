"""Repeated line runs by a distributed suffix array (operator 3, DataFrame functions only).

A document is the sequence of its lines that hold a word; lines are equal if they are after trimming white space. The
suffixes of all documents are ranked by their first 1, 2, 4, ... lines (prefix doubling): the pair of ranks of a suffix
and of the one that many lines later is looked up among the distinct pairs, which a range sort has numbered in order.
Suffixes of equal rank share that many lines, so groups of equal rank are the intervals of the suffix array whose
longest common prefix has that length at least. A run counts as repeated from ``MIN_WORDS`` words on; the shortest such
prefix of a suffix is between two lengths, and two overlapping ranks name it. Of each interval the copy that comes
first (by doc_id, then line) stays and the others are deleted. As a line holds a word at least, no more than
log2(MIN_WORDS) + 1 rounds are needed.

A line of a maximal repeated run with ``MIN_WORDS`` words up to it is in the shortest window of so many words that ends
there, any other in the shortest one that starts the run. So both kinds of windows are looked up, and later copies of
maximal repeated runs go whole: a line is deleted if any run of ``MIN_WORDS`` words through it has an earlier copy.
Common prefixes of more lines than such a window need not be known for that: each window inside a longer run is
repeated itself.

Only lines that occur twice take part: a bounded Bloom filter lets no others shuffle, and runs that are single drop out
round by round. Pairs are summed before they are sorted, so a line that a third of the documents hold is one row there.

Defined cases: null and blank texts have no lines. Rows of equal id and text are one document and get equal results;
a null doc_id counts as the largest. Where copies overlap within a document, the first one may lose lines in which a
later copy starts. Other columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm import bloom
from railyard.llm.common import SPACES, documents, once, stored

MIN_WORDS = 50
_LAST_ID = (1 << 63) - 1
_KEY = ["did", "text_hash"]


def _with_lines(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """did, text_hash and the array ``lines``, beside the columns ``keep``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    blank = F.lit(" \t\n\x0b\x0c\r")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.call_function("btrim", x, blank)), lambda x: x != "")
    t = docs.select(*keep, F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("did"), F.xxhash64(text).alias("text_hash"), lines.alias("l"))
    return once(t, F.col("l"), "lines", *keep, *_KEY)


def _line_table(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """did, text_hash, at, h, need, back: how many lines from this one on, and up to it, hold ``min_words`` words (0: too
    few)."""
    t = _with_lines(docs, id_col, text_col, [])
    t = once(t, F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("h"), F.size(F.split(x, SPACES)).alias("w"))), "hw", *_KEY)
    start = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"))

    def enough(lines: Column) -> Column:
        return F.aggregate(
            lines, start,
            lambda a, x: F.when(a["w"] >= min_words, a).otherwise(F.struct((a["w"] + x["w"]).alias("w"), (a["n"] + 1).alias("n"))),
            lambda a: F.when(a["w"] >= min_words, a["n"]).otherwise(0))

    def windows(own: Column, i: Column) -> Column:
        before = F.slice("hw", F.greatest(i + 2 - min_words, F.lit(1)), F.least(i + 1, F.lit(min_words)))
        return F.struct(own["h"].alias("h"), enough(F.slice("hw", i + 1, F.lit(min_words))).alias("need"),
                        enough(F.reverse(before)).alias("back"))

    t = t.select(*_KEY, F.posexplode(F.transform("hw", windows)).alias("at", "x"))
    return t.select(*_KEY, "at", "x.*")


def _later_copies(windows: DataFrame) -> DataFrame:
    """(did, text_hash, at, need) of all but the first of each group of equal (a, b, need)."""
    group = ["a", "b", "need"]
    first = windows.groupBy(*group).agg(F.min(F.struct(*_KEY, "at")).alias("first"), F.max(F.struct(*_KEY, "at")).alias("last")).where("first <> last")
    # a table on either side of the join, so that the partition of a hot run is split
    found = windows.join(stored(first.drop("last"), "first-copies"), group)
    return found.where(F.struct(*_KEY, "at") != F.col("first")).select(*_KEY, "at", "need")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, text_hash, at): the lines to delete."""
    lines = stored(_line_table(docs, min_words, id_col, text_col), "lines")
    n_words = bloom.words_for(lines.count())
    table = bloom.filter_table(lines, "h", n_words, at_least=2)
    some = bloom.probe(lines, "h", table, n_words, "maybe").where("maybe").drop("maybe")
    twice = stored(some.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated-lines")
    # the hash of a line is its rank for one line: any fixed order of lines will do
    suffixes = some.join(twice, "h").select(*_KEY, "at", "need", "back", F.col("h").alias("rank"))
    suffixes = stored(suffixes.dropDuplicates([*_KEY, "at"]), "suffixes")  # rows of equal id and text are one document
    # the windows that end at a line, by their first one
    ending = suffixes.where("back > 0").select(*_KEY, (F.col("at") - F.col("back") + 1).alias("at"), F.col("back").alias("need"))
    suffixes = suffixes.drop("back")
    marks, length = [], 1
    while True:
        # suffixes whose shortest long enough prefix has from ``length`` to 2 * length - 1 lines
        is_due = (F.col("need") >= length) & (F.col("need") < 2 * length)
        due = suffixes.where(is_due).unionByName(suffixes.drop("need").join(ending.where(is_due), [*_KEY, "at"]))
        second = suffixes.select(*_KEY, F.col("at").alias("to"), F.col("rank").alias("b"))
        windows = due.withColumn("to", F.col("at") + F.col("need") - length).join(second, [*_KEY, "to"]).select(
            *_KEY, "at", "need", F.col("rank").alias("a"), "b").distinct()
        marks.append(stored(_later_copies(stored(windows, "windows")), "later-copies"))
        if 2 * length > min_words:
            break
        ahead = Window.partitionBy(*_KEY).orderBy("at").rangeBetween(length, length)
        paired = suffixes.withColumn("next", F.first("rank").over(ahead)).where("next is not null")
        paired = stored(paired, "paired")
        pairs = paired.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rank", "next")
        # numbered in order: the partitions' ranges ascend, and so do the numbers within and across them
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        numbered = stored(pairs.repartitionByRange(n, "rank", "next").sortWithinPartitions("rank", "next").withColumn(
            "new", F.monotonically_increasing_id()), "ranked-pairs")
        suffixes = stored(paired.join(numbered, ["rank", "next"]).select(*_KEY, "at", "need", F.col("new").alias("rank")), "suffixes")
        length *= 2
        if suffixes.isEmpty():
            break
    found = marks[0]
    for m in marks[1:]:
        found = found.unionByName(m)
    return found.select(*_KEY, F.explode(F.sequence("at", F.col("at") + F.col("need") - 1)).alias("at")).distinct()


def _dropped(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(did, text_hash, dropped): sorted numbers of the lines to delete, of documents that have any."""
    runs = repeated_runs(docs, min_words, id_col, text_col)
    return runs.groupBy(*_KEY).agg(F.sort_array(F.collect_set("at")).alias("dropped"))


def line_report(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, dropped_lines (numbers among the lines that hold a word, from 0), one row per input row."""
    dropped = _dropped(docs, min_words, id_col, text_col)
    each = _with_lines(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text", ["doc_id"])
    each = each.select("doc_id", *_KEY, F.size("lines").cast("long").alias("n_lines"))
    out = each.join(dropped, _KEY, "left").withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
    return out.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
                      F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped_lines"))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without later copies of repeated runs. A text that loses lines loses its blank ones and
    the white space around its lines too; others stay as they are."""
    dropped = stored(_dropped(docs, min_words, id_col, text_col).withColumn("h", F.xxhash64(*_KEY)), "dropped-lines")
    n_words = bloom.words_for(dropped.count())
    table = stored(bloom.filter_table(dropped, "h", n_words), "dropped-bits")
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    keyed = packed.withColumn("did", F.coalesce(F.col(f"row.`{id_col}`").cast("long"), F.lit(_LAST_ID))).withColumn(
        "text_hash", F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))))
    flagged = bloom.probe(keyed.withColumn("h", F.xxhash64(*_KEY)), "h", table, n_words, "maybe")
    hit = flagged.where("maybe").select("row", *_KEY).join(dropped.drop("h"), _KEY, "left")
    hit = _with_lines(hit.withColumn("t", F.col(f"row.`{text_col}`")).withColumn("i", F.col("did")), "i", "t", ["row", "dropped"])
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    text = F.when(F.col("dropped").isNull(), F.col(f"row.`{text_col}`")).when(F.size("dropped") == F.size("lines"), "").otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    changed = hit.select(F.col("row").withField(f"`{text_col}`", text).alias("row"))
    return flagged.where(~F.col("maybe")).select("row").unionByName(changed).select("row.*")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
                                            lambda x: trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13))), lambda x: x <> '') AS lines
  FROM documents),
w AS (
  SELECT doc_id, lines, list_transform(lines, lambda x: len(string_split_regex(x, '[\x20\x09-\x0D]+'))) AS words FROM d),
s AS (
  SELECT doc_id, lines, words, unnest(range(len(lines))) AS pos FROM w),
n AS (
  SELECT doc_id, lines, pos, list_filter(range(1, 51), lambda n: pos + n <= len(lines) AND list_sum(words[pos + 1 : pos + n]) >= 50)[1] AS need FROM s),
b AS (
  SELECT doc_id, lines, pos, list_filter(range(1, 51), lambda n: n <= pos + 1 AND list_sum(words[pos + 2 - n : pos + 1]) >= 50)[1] AS need FROM s),
v AS (
  SELECT doc_id, pos, need, lines[pos + 1 : pos + need] AS run FROM n WHERE need IS NOT NULL
  UNION SELECT doc_id, pos + 1 - need, need, lines[pos + 2 - need : pos + 1] FROM b WHERE need IS NOT NULL),
c AS (
  SELECT doc_id, pos, need, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS copy FROM v),
g AS (
  SELECT doc_id, list_sort(list_distinct(flatten(list(range(pos, pos + need))))) AS dropped FROM c WHERE copy > 1 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.lines) AS BIGINT) AS n_lines, CAST(coalesce(len(g.dropped), 0) AS BIGINT) AS n_dropped,
       coalesce(array_to_string(g.dropped, ','), '') AS dropped_lines
FROM d LEFT JOIN g USING (doc_id)
"""
