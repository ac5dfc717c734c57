r"""Code dictionaries from label documents.

A label document holds sections of ``code = label`` lines. A line ``value <name>`` or
``value $<name>`` opens a section::

    /* how people travel */
    value modes
       1 = 'Air'
       2 = 'Sea' ;

A line that holds nothing but ``value`` and a name opens a section within a comment too.

Everything below works inside the row of a document, so documents are never shuffled or sorted:
lines are numbered, cleaned and split into sections as text and arrays of one row. Only the choice
between repeated codes groups rows, and that aggregates within each task first.
"""

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.text import first_part, last_part, remove_characters, strip
from starmart.operators.trailing import latest_per_key

# Control characters that are removed from the text and then used between its parts.
NUMBER_END = "\x01"
PART_END = "\x02"

_MARKER = r"\d+\x01[ \t]*(?i:value)[ \t]+\$?\w+[ \t]*;?[ \t]*(?=\n|\z)"
_SECTION_START = rf"\n(?={_MARKER})"
_SECTION_NAME = r"^\d+\x01[ \t]*(?i:value)[ \t]+\$?(\w+)"

# A quoted code or label is kept, a comment is removed up to its end or to a section inside of it.
# Other quotes, as in "Men's", shield nothing. The possessive group is matched in a loop: a plain one
# would go as deep as there are quotes.
_COMMENT = rf"((?:\x01|=)[ \t]*+(?:'[^'\n]*+')++)|/\*[\s\S]*?(?:\*/|(?=\n{_MARKER})|\z)|\*/"

# line number, then: quoted or plain code = the rest. No part can match in two ways, so the time
# is linear in the line; white space and the quotes of the label are taken off afterwards.
_ENTRY = r"(?s)^(\d+)\x01\s*+(?:'(.*?)'\s*+|([^'=]*+))=(.*)\z"

# Fixed values of the line-by-line rules.
_SKIPPED_LINES = 5
_MIN_LINE_LENGTH = 10
_DROPPED_PHRASE = "permament format"


def _plain_text(text: Column) -> Column:
    for line_end in ("\r\n", "\r"):
        text = F.replace(text, F.lit(line_end), F.lit("\n"))
    return remove_characters(text, NUMBER_END + PART_END)


def kept_lines(
    text: Column,
    drop_pattern: str = "/",
    skip: int = 0,
    min_length: int = 0,
    drop_phrases: Sequence[str] = (),
    line_end: bool = False,
) -> Column:
    """The lines of a text that pass all filters: an array of ``struct<line_no, line>``.

    Lines matching ``drop_pattern`` go first, then the first ``skip`` of the others, then lines
    shorter than ``min_length`` and lines with one of ``drop_phrases``. ``line_end`` keeps the
    newline at the end of each line and counts it.
    """
    ends = r"(?<=\n)" if line_end else r"\n"
    kept = F.transform(
        F.split(text, ends), lambda line, i: F.struct((i + 1).alias("line_no"), line.alias("line"))
    )
    # A pattern without special characters is searched as it is, without a conversion per line.
    literal = re.escape(drop_pattern) == drop_pattern
    search = F.contains if literal else F.rlike
    kept = F.filter(kept, lambda x: ~search(x["line"], F.lit(drop_pattern)))
    if skip:
        kept = F.filter(kept, lambda _, i: i >= skip)

    def passes(x: Column) -> Column:
        tests = [F.length(x["line"]) >= min_length]
        tests += [~F.contains(x["line"], F.lit(phrase)) for phrase in drop_phrases]
        return reduce(lambda left, right: left & right, tests)

    return F.filter(kept, passes) if min_length or drop_phrases else kept


def document_lines(docs: DataFrame, text: str, **filters) -> DataFrame:
    """Numbered lines: the other columns of ``docs``, ``line_no`` and ``line``."""
    others = [name for name in docs.columns if name != text]
    return docs.select(*others, F.inline(kept_lines(F.col(text), **filters)))


def _numbered(text: Column) -> Column:
    """Every line as ``<number>\\x01<line>``, comments removed, a newline in front."""
    lines = F.transform(
        F.split(_plain_text(text), "\n"),
        lambda line, i: F.concat((i + 1).cast("string"), F.lit(NUMBER_END), line),
    )
    numbered = F.concat(F.lit("\n"), F.array_join(lines, "\n"))
    return F.regexp_replace(numbered, _COMMENT, "$1")


def _numbered_parity(text: Column) -> Column:
    """The same form by the line rules: any line with a slash goes, quotes and tabs vanish."""
    lines = kept_lines(
        _plain_text(text), "/", skip=_SKIPPED_LINES, min_length=_MIN_LINE_LENGTH, line_end=True
    )

    def clean(x: Column) -> Column:
        line = remove_characters(strip(remove_characters(x["line"], ";")), "'\t")
        return F.concat(x["line_no"].cast("string"), F.lit(NUMBER_END), line)

    kept = F.filter(
        F.transform(lines, clean), lambda line: ~F.contains(line, F.lit(_DROPPED_PHRASE))
    )
    return F.concat(F.lit("\n"), F.array_join(kept, "\n"))


_PARITY_SECTION_START = r"\n(?=\d+\x01[^=\n]*value)"
_PARITY_SECTION_NAME = r"^\d+\x01[^=\n]*?value\s*\$?(\w*)"


def label_entries(
    docs: DataFrame, text: str = "value", doc: Sequence[str] = ("path",), parity: bool = False
) -> DataFrame:
    """Every entry of every section: ``doc`` columns, section, section_no, code, label, line_no.

    ``section_no`` counts the marker lines of the document up to the entry.
    """
    body = _numbered_parity(F.col(text)) if parity else _numbered(F.col(text))
    start = _PARITY_SECTION_START if parity else _SECTION_START
    name = _PARITY_SECTION_NAME if parity else _SECTION_NAME
    blocks = docs.select(*doc, F.posexplode(F.split(body, start)).alias("section_no", "block"))
    # Block 0 is what precedes the first marker; the marker is the first line of its block.
    sections = blocks.filter(F.col("section_no") > 0).select(
        *doc, F.regexp_extract("block", name, 1).alias("section"), "section_no", "block"
    )
    lines = F.split("block", "\n")
    if parity:
        lines = F.filter(lines, lambda _, i: i >= 1)
    lines = sections.select(*doc, "section", "section_no", F.explode(lines).alias("line"))
    entries = _parity_entries(lines) if parity else entries_of_lines(lines)
    return entries.select(*doc, "section", "section_no", "code", "label", "line_no")


def entries_of_lines(lines: DataFrame) -> DataFrame:
    """The lines ``<number>\\x01<text>`` in ``line`` that are entries, with ``line_no``, ``code``, ``label``.

    White space, the semicolon at the end and the quotes of the label go; ``''`` is a quote. Each step
    is a column of its own, so no part of it is computed more than once for a line.
    """
    entry = F.regexp_replace(strip(F.col("line")), _ENTRY, "$1\x02$2$3\x02$4")
    parts = lines.withColumn("__parts", F.split(entry, PART_END)).filter(F.size("__parts") == 3)
    part = [F.col("__parts").getItem(n) for n in range(3)]
    entries = parts.withColumns({
        "line_no": part[0].cast("int"), "code": F.replace(strip(part[1]), F.lit("''"), F.lit("'")), "label": strip(part[2])
    })
    label = F.col("label")
    ended = F.when(F.endswith(label, F.lit(";")), strip(F.left(label, F.length(label) - 1))).otherwise(label)
    entries = entries.withColumn("label", ended)
    quoted = F.startswith(label, F.lit("'")) & F.endswith(label, F.lit("'")) & (F.length(label) > 1)
    plain = F.when(quoted, strip(F.substr(label, F.lit(2), F.length(label) - 2))).otherwise(label)
    return entries.withColumn("label", F.replace(plain, F.lit("''"), F.lit("'"))).drop("__parts", "line")


def _parity_entries(lines: DataFrame) -> DataFrame:
    rest = last_part(F.col("line"), NUMBER_END)
    return lines.withColumns({
        "line_no": first_part(F.col("line"), NUMBER_END).cast("int"),
        "code": first_part(rest, "="),
        "label": last_part(rest, "="),
    })


def last_wins(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """One row per ``keys`` with the ``value`` of the largest ``order``, of ties the largest one."""
    return latest_per_key(df, keys, [order], [value])


def label_dictionary(
    docs: DataFrame, text: str = "value", doc: Sequence[str] = ("path",), parity: bool = False
) -> DataFrame:
    """Code dictionary of label documents: ``doc`` columns, section, code, label, line_no.

    Of a repeated code the last one counts. By default comments are removed but not the lines
    around them, codes and labels are trimmed, and ``''`` inside quotes is an apostrophe.
    ``parity`` keeps to the original line rules instead: every line with a slash is lost, every
    quote removed, and white space around ``=`` belongs to code and label.
    """
    entries = label_entries(docs, text, doc, parity)
    return latest_per_key(entries, [*doc, "section", "code"], ["line_no"], ["label", "line_no"])
