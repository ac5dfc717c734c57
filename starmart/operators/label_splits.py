"""Label documents of any size: lines read in splits by many tasks, the dictionary of the in-row form.

What a line means depends on what is before it: whether it is inside a comment, on which line the text
that it ends began, and in which section it is. So each line is cleaned for both cases, inside of a
comment and outside, and what it does to the state is noted: it ends outside, or inside, or as it
began, or the other way round. These effects are composed along each block of the file and over its
blocks, which picks the case of every line; line numbers and sections are carried the same way. Lines
are brought together by block once; only the few that end a comment of several lines are joined with
the line that it began on.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.text import remove_characters
from starmart.operators.labels import NUMBER_END, PART_END, entries_of_lines
from starmart.operators.trailing import latest_per_key
from starmart.sources.splits import BLOCK, before, block_starts, file_lines, line_number, toggled

# A line that opens a section, in a comment or not; a comment up to its end or to the end of the line,
# which it then takes away; quoted text after the start of the line or an equals sign is kept.
_MARKER = r"^[ \t]*(?i:value)[ \t]+\$?(\w+)[ \t]*;?[ \t]*$"
_COMMENT = r"((?:\x01|=)[ \t]*+(?:'[^']*+')++)|/\*[^\x02]*?(?:\*/|\x02)|\*/"


def _cleaned(start: str, text: Column) -> Column:
    """A line without its comments, from outside (``\\x01``) or inside (``/*``) of one; ``\\x02`` at its
    end is gone if a comment goes on."""
    return F.regexp_replace(F.concat(F.lit(start), text, F.lit(PART_END)), _COMMENT, "$1")


def _bare(text: Column) -> Column:
    return remove_characters(text, NUMBER_END + PART_END)


def _located_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``block``, ``line_no``, ``own`` (the line is no continuation) and ``text`` without comments."""
    lines = file_lines(spark, path)
    text = _bare(F.col("value"))
    lines = lines.select(*BLOCK, "seq", text.alias("text")).withColumns({
        "marker": F.col("text").rlike(_MARKER),
        "outside": _cleaned(NUMBER_END, F.col("text")),
        "inside": _cleaned("/*", F.col("text")),
    })
    end_of_outside = ~F.contains("outside", F.lit(PART_END))
    # A section begins outside of comments, whatever was before it.
    end_of_inside = F.when(F.col("marker"), end_of_outside).otherwise(~F.contains("inside", F.lit(PART_END)))
    lines = lines.withColumns({"from_outside": end_of_outside, "from_inside": end_of_inside})
    known = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside"))
    lines = toggled(lines, known, F.col("from_outside"), "seq", BLOCK, "state")

    def after(entry: Column) -> Column:
        now = F.coalesce(F.col("state"), entry != F.col("state_odd"))
        return F.when(now, F.col("from_inside")).otherwise(F.col("from_outside"))

    last = F.max_by(F.struct(after(F.lit(False)).alias("from_outside"), after(F.lit(True)).alias("from_inside")), "seq")
    ends = lines.groupBy(*BLOCK).agg(last.alias("end")).select(*BLOCK, "end.*")
    known = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside"))
    ends = toggled(ends, known, F.col("from_outside"), "block", ["path"], "entry")
    # A file starts outside of comments.
    entries = ends.select(*BLOCK, F.coalesce("entry", F.col("entry_odd")).alias("entry"))
    starts = block_starts(file_lines(spark, path)).join(entries, BLOCK)
    located = lines.join(starts, BLOCK)
    inside = F.coalesce(F.col("state"), F.col("entry") != F.col("state_odd")) & ~F.col("marker")
    return located.select(
        *BLOCK,
        line_number().cast("int").alias("line_no"),
        (~inside).alias("own"),
        _bare(F.when(inside, F.col("inside")).otherwise(F.col("outside"))).alias("text"),
    )


def _carried(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with the last ``value`` that is not NULL up to each line of its file, as ``name``."""
    df = df.withColumn("__own", value)
    up_to = before("line_no").rowsBetween(-(1 << 63), 0)
    df = df.withColumn("__in_block", F.last("__own", ignorenulls=True).over(up_to))
    blocks = df.groupBy(*BLOCK).agg(F.max_by("__own", F.when(F.col("__own").isNotNull(), F.col("line_no"))).alias("__last"))
    earlier = before("block", within=["path"])
    blocks = blocks.select(*BLOCK, F.last("__last", ignorenulls=True).over(earlier).alias("__before"))
    found = df.join(blocks, BLOCK)
    return found.withColumn(name, F.coalesce("__in_block", "__before")).drop("__own", "__in_block", "__before")


def _counted(df: DataFrame, flag: Column, name: str) -> DataFrame:
    """``df`` with the number of lines of its file up to each line that have the flag."""
    up_to = before("line_no").rowsBetween(-(1 << 63), 0)
    df = df.withColumn("__in_block", F.sum(flag.cast("int")).over(up_to))
    blocks = df.groupBy(*BLOCK).agg(F.max("__in_block").alias("__n"))
    earlier = F.sum("__n").over(before("block", within=["path"]))
    blocks = blocks.select(*BLOCK, F.coalesce(earlier, F.lit(0)).alias("__before"))
    found = df.join(blocks, BLOCK)
    return found.withColumn(name, (F.col("__in_block") + F.col("__before")).cast("int")).drop("__in_block", "__before")


def split_label_entries(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of every section of the files at ``path``: path, section, section_no, code, label, line_no."""
    lines = _located_lines(spark, path)
    lines = lines.filter((F.col("own")) | (F.col("text") != ""))
    lines = _carried(lines, F.when(F.col("own"), F.col("line_no")), "first")
    more = lines.filter("NOT own").groupBy("path", "first").agg(
        F.sort_array(F.collect_list(F.struct("line_no", "text"))).alias("more")
    )
    whole = lines.filter("own").drop("first").join(
        more.select(F.col("path").alias("p"), F.col("first"), "more"),
        (F.col("path") == F.col("p")) & (F.col("line_no") == F.col("first")),
        "left",
    )
    rest = F.coalesce(F.array_join(F.transform("more", lambda part: part["text"]), ""), F.lit(""))
    whole = whole.select(*BLOCK, "line_no", F.concat("text", rest).alias("text"))
    marker = F.col("text").rlike(_MARKER)
    wanted = whole.filter(marker | F.contains("text", F.lit("=")))
    wanted = _carried(wanted, F.when(marker, F.regexp_extract("text", _MARKER, 1)), "section")
    wanted = _counted(wanted.filter("section IS NOT NULL"), marker, "section_no")
    line = F.concat(F.col("line_no").cast("string"), F.lit(NUMBER_END), F.col("text"))
    entries = wanted.filter(~marker).select("path", "section", "section_no", line.alias("line"))
    return entries_of_lines(entries).select("path", "section", "section_no", "code", "label", "line_no")


def split_label_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary that ``label_dictionary(read_documents(spark, path))`` gives, for files of any size.

    Columns: path, section, code, label, line_no. A file is read by as many tasks as it has blocks of
    ``spark.sql.files.maxPartitionBytes``.
    """
    entries = split_label_entries(spark, path)
    return latest_per_key(entries, ["path", "section", "code"], ["line_no"], ["label", "line_no"])
