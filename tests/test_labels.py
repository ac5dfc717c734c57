import random
import time

from conftest import rows
from pyspark.sql import functions as F

from starmart import document_lines, label_dictionary, read_documents
from starmart.operators.labels import kept_lines, label_entries, last_wins

DOCUMENT = """libname library 'folder' ;
proc format library=library ;

/* YEAR - 4 digit year */


/* COUNTRY - all codes, valid
   or = not, it's the list */
  value country
   582 =  'MEXICO Air Sea, (I-94)'
   236 =  'AFGHANISTAN'
    0  =  'INVALID: STATELESS' /* none = here */
   149 =  'HOLY SEE/VATICAN'
   10.5 = 'DOTTED' ;

/* PORT */
  value $port
   'ALC'\t=\t'ALCAN, AK             '
   'INT'\t=\t'INT''L FALLS, MN      '
   'NK ' \t=\t'Code with = and ; (NK)'
   'ALC'\t=\t'ALCAN AGAIN, AK  '
;

/* MODE is a number that a
   permament format has not been applied. */
value mode
\t1 = 'Air'
\t9 = 'Not reported' ;
\t
/* VISA = codes in a comment:
value visa
   1 = Business
   2 = Pleasure trip
*/

/* END */
run ;
"""

DEFAULT = {
    ("country", "582", "MEXICO Air Sea, (I-94)", 10),
    ("country", "236", "AFGHANISTAN", 11),
    ("country", "0", "INVALID: STATELESS", 12),
    ("country", "149", "HOLY SEE/VATICAN", 13),
    ("country", "10.5", "DOTTED", 14),
    ("port", "ALC", "ALCAN AGAIN, AK", 21),
    ("port", "INT", "INT'L FALLS, MN", 19),
    ("port", "NK", "Code with = and ; (NK)", 20),
    ("mode", "1", "Air", 27),
    ("mode", "9", "Not reported", 28),
    ("visa", "1", "Business", 32),
    ("visa", "2", "Pleasure trip", 33),
}

# The line with the slash in its label and the line with a comment are lost; "= and ;" splits at
# the last "=" and loses its semicolon.
PARITY = {
    ("country", "582 ", "  MEXICO Air Sea, (I-94)", 10),
    ("country", "236 ", "  AFGHANISTAN", 11),
    ("country", "10.5 ", " DOTTED", 14),
    ("port", "ALC", "ALCAN AGAIN, AK  ", 21),
    ("port", "INT", "INTL FALLS, MN      ", 19),
    ("port", "NK  ", " and  (NK)", 20),
    ("mode", "1 ", " Air", 27),
    ("mode", "9 ", " Not reported", 28),
    ("visa", "1 ", " Business", 32),
    ("visa", "2 ", " Pleasure trip", 33),
}


def _docs(spark, *texts):
    return spark.createDataFrame(
        [(f"doc{n}", text) for n, text in enumerate(texts)], "path string, value string"
    )


def _set(df):
    return {tuple(row) for row in df.select("section", "code", "label", "line_no").collect()}


def test_default_rules(spark):
    assert _set(label_dictionary(_docs(spark, DOCUMENT))) == DEFAULT


def test_parity_rules(spark):
    assert _set(label_dictionary(_docs(spark, DOCUMENT), parity=True)) == PARITY


def test_line_ends_and_control_characters(spark):
    for variant in (
        DOCUMENT.replace("\n", "\r\n"),
        DOCUMENT.replace("\n", "\r"),
        DOCUMENT.replace("ALCAN", "AL\x01C\x02AN"),
        DOCUMENT.rstrip("\n"),
    ):
        assert _set(label_dictionary(_docs(spark, variant))) == DEFAULT


def test_documents_are_independent(spark):
    other = "value mode\n 1 = 'Rail'\n"
    found = label_dictionary(_docs(spark, DOCUMENT, other)).filter("section = 'mode'")
    assert rows(found.select("path", "code", "label")) == [
        ("doc0", "1", "Air"),
        ("doc0", "9", "Not reported"),
        ("doc1", "1", "Rail"),
    ]


def test_section_numbers_count_markers(spark):
    entries = label_entries(_docs(spark, DOCUMENT))
    found = entries.groupBy("section").agg(F.min("section_no"), F.max("section_no"))
    assert rows(found) == [("country", 1, 1), ("mode", 3, 3), ("port", 2, 2), ("visa", 4, 4)]


def test_first_line_may_be_a_marker_and_entries_need_a_section(spark):
    assert _set(label_dictionary(_docs(spark, "value a\n'x'='y'"))) == {("a", "x", "y", 2)}
    assert _set(label_dictionary(_docs(spark, "'x'='y'\nvalue a\n"))) == set()
    assert _set(label_dictionary(_docs(spark, "", None))) == set()


def test_rendered_dictionary_parses_to_itself(spark):
    wanted = {
        (section, f"{section}{n}", label, n)
        for section in ("one", "two")
        for n, label in enumerate(["it's", "a, b", "x / y", "p = q", "semi ; colon", "--"])
    }
    lines = []
    for section in ("one", "two"):
        lines.append(f"value ${section}")
        for name, code, label, _ in sorted(wanted):
            if name == section:
                escaped = label.replace("'", "''")
                lines.append(f"  '{code}' = '{escaped}'")
        lines.append(";")
    found = label_dictionary(_docs(spark, "\n".join(lines)))
    assert {(s, c, l) for s, c, l, _ in _set(found)} == {(s, c, l) for s, c, l, _ in wanted}


def test_large_document(spark):
    lines = ["value $big"] + [f"   'k{n}' = 'label {n} / x'" for n in range(20_000)]
    text = "/* " + "long comment 'x' " * 20_000 + "*/\n" + "\n".join(lines)
    found = label_dictionary(_docs(spark, text))
    assert found.count() == 20_000
    assert found.filter("label = concat('label ', substr(code, 2), ' / x')").count() == 20_000


def test_read_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text(DOCUMENT)
    (tmp_path / "b.txt").write_text("value mode\n 1 = 'Rail'\n")
    docs = read_documents(spark, str(tmp_path))
    assert docs.columns == ["path", "value"] and docs.count() == 2
    assert label_dictionary(docs).count() == len(DEFAULT) + 1


def test_kept_lines(spark):
    text = "a/b\none\ntwo\nthree long\n\nfour phrase\nfive long"
    df = spark.createDataFrame([(text,)], "t string")

    def lines(**filters):
        return [
            tuple(row) for row in df.select(F.inline(kept_lines(F.col("t"), **filters))).collect()
        ]

    assert [n for n, _ in lines()] == [2, 3, 4, 5, 6, 7]
    assert lines(skip=2, min_length=6, drop_phrases=["phrase"]) == [(4, "three long"), (7, "five long")]
    assert lines(skip=50) == []
    assert lines(drop_pattern="long|^o", min_length=3) == [(1, "a/b"), (3, "two"), (6, "four phrase")]
    # With its newline a line of nine characters has ten; the last line has no newline.
    nine = spark.createDataFrame([("123456789\n123456789",)], "t string")
    kept = nine.select(F.inline(kept_lines(F.col("t"), min_length=10, line_end=True)))
    assert rows(kept) == [(1, "123456789\n")]


def test_document_lines_keeps_other_columns(spark):
    df = spark.createDataFrame([(7, "a\nb/c\nd")], "id int, text string")
    assert rows(document_lines(df, "text")) == [(7, 1, "a"), (7, 3, "d")]


def test_no_shuffle_before_the_choice_of_codes(spark):
    plan = label_entries(_docs(spark, DOCUMENT))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def _random_document(rng):
    """A document and its dictionary, known because both are made together."""
    alphabet = "ab/=;, -*.'()"
    lines, wanted = [], {}

    def comment():
        words = ["it's", "a = b", "value of it", "'q'", "x / y", "x;"]
        return [
            "/* " + rng.choice(words),
            *[f"  {rng.choice(words)}" for _ in range(rng.randint(0, 2))],
            " end */" + rng.choice(["", "  "]),
        ]

    for number in range(rng.randint(1, 4)):
        section = f"sec{number}"
        lines += comment() if rng.random() < 0.6 else [""]
        inside = rng.random() < 0.2
        if inside:
            lines.append("/* a section in a comment:")
        lines.append(rng.choice(["value ", "  value $", "\tVALUE  "]) + section + rng.choice(["", " "]))
        for _ in range(rng.randint(0, 8)):
            code = str(rng.randint(0, 5))
            label = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))).strip()
            if "/*" in label or "*/" in label:
                label = "plain"
            escaped = label.replace("'", "''")
            shown = rng.choice([code, f"'{code}'", f"'{code} '"])
            space = rng.choice(["", " ", "\t", "   "])
            quoted = f"'{rng.choice(['', ' '])}{escaped}  '"
            end = rng.choice(["", " ;", ";"])
            lines.append(f"{space}{shown}{space}={space}{quoted}{end}")
            wanted[section, code] = (label, len(lines))
            if rng.random() < 0.2 and not inside:
                lines += comment()
        lines.append("*/" if inside else ";")
    return "\n".join(lines), {(s, c, *value) for (s, c), value in wanted.items()}


def test_random_documents(spark):
    rng = random.Random(20)
    made = [_random_document(rng) for _ in range(400)]
    found = label_dictionary(_docs(spark, *[text for text, _ in made]))
    by_document = {}
    for row in found.collect():
        by_document.setdefault(row["path"], set()).add(
            (row["section"], row["code"], row["label"], row["line_no"])
        )
    for number, (text, wanted) in enumerate(made):
        assert by_document.get(f"doc{number}", set()) == wanted, text


def test_long_lines_take_linear_time(spark):
    blanks = " " * 100_000
    body = [blanks, f"1 = '{blanks}", f"2{blanks}= {blanks}two{blanks};", f"'{blanks}"]
    text = "value $s\n" + "\n".join(body) + "\n"
    docs = spark.createDataFrame([("d", text)], "path string, value string")
    label_dictionary(docs).collect()  # the first run compiles
    start = time.perf_counter()
    found = {r["code"]: r["label"] for r in label_dictionary(docs).collect()}
    assert time.perf_counter() - start < 20
    assert found == {"1": "'", "2": "two"}


def test_only_quotes_of_codes_and_labels_shield_comments(spark):
    text = "value $s\n1 = Men's /* don't */\n'a''b' = 'It''s /* kept */ ok' ;\n2 = ; /* none */\n"
    docs = spark.createDataFrame([("d", text)], "path string, value string")
    found = {r["code"]: r["label"] for r in label_dictionary(docs).collect()}
    assert found == {"1": "Men's", "a'b": "It's /* kept */ ok", "2": ""}


def test_last_wins_settles_ties(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("a", "z", 0)], "k string, v string, o int")
    assert rows(last_wins(df, ["k"], "v", "o")) == [("a", "y")]
