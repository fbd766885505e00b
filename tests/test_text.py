"""Text columns against a restatement in plain Python."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.functions import text as T

WORDS = [
    "water", "Energy", "the", "1234567", "12", "3.", "a-b", "x - y", "end.", "Why?",
    "no!", "http://www.site.org/a?b=c#d", "mail.me@host.com", "e.g.", "...", " ,",
    "co:", "naïve", "tab\t", "\r", "\x0b", "\x0c", "_", "a.bc&d", "-", "‘quoted’",
    "www.x.yy", "A1.b2.cc3", "&a.com", "a&b.com",
]


def python_clean(paragraph: str) -> str:
    for pattern, replacement in (
        (fixed.HEADER_NUMBER.removeprefix("(?d)"), r"\1"),
        (r"^\s+|\s+$", ""),
        (fixed.HYPHEN, "-"),
        (fixed.PUNCTUATION, r"\1"),
        (fixed.LONG_NUMBER, " "),
        (fixed.HOST, " "),
        (fixed.SPACES, " "),
        (fixed.POINTS, "."),
    ):
        paragraph = re.sub(pattern, replacement, paragraph)
    return paragraph


def random_texts(n: int) -> list[str]:
    rng = random.Random(7)
    glue = [" ", " ", "  ", "\n", "\n ", ".\n", "\n\n", ""]
    texts = ["", "\n", ".", ".\n", ".\n.", "a.\n b.\nc", " \n", "x.\n\ny.\n"]
    while len(texts) < n:
        parts = [rng.choice(WORDS) + rng.choice(glue) for _ in range(rng.randint(0, 25))]
        texts.append("".join(parts))
    return texts


# Texts and their paragraphs, written out by hand.
PARAGRAPHS = [
    ("", [" "]),
    ("one line", [" one line"]),
    ("one\ntwo", [" one two"]),
    ("One.\nTwo.", [" One.", "Two."]),
    ("One.\n two.", [" One.  two."]),
    ("One.\n\nTwo.", [" One.", " Two."]),
    ("One\n\nTwo", [" One  Two"]),
    ("a.\nb\nc.\nd", [" a.", "b c.", "d"]),
    ("caf\u00e9 a.\nb", [" caf a.", "b"]),
    ("a.\r\nb", [" a.\r b"]),
]


def test_paragraphs_written_out(spark):
    rows = spark.createDataFrame([(t,) for t, _ in PARAGRAPHS], "text string")
    got = [r["p"] for r in rows.select(T.paragraphs(F.col("text")).alias("p")).collect()]
    assert got == [p for _, p in PARAGRAPHS]


def squeezed(text: str) -> str:
    return "".join(c for c in text if 32 < ord(c) < 127)


def test_paragraphs_keep_all_visible_signs_and_statements_their_rules(spark):
    """Nothing but white space comes or goes, and breaks come after full stops only."""
    texts = random_texts(3000)
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = rows.select(
        "id",
        T.paragraphs(F.col("text")).alias("p"),
        F.transform(T.paragraphs(F.col("text")), T.clean_paragraph).alias("c"),
        T.statements(F.col("text")).alias("s"),
    ).collect()
    for row in found:
        assert squeezed("".join(row["p"])) == squeezed(texts[row["id"]])
        assert all(p.endswith(".") for p in row["p"][:-1])
        assert row["c"] == [python_clean(p) for p in row["p"]]
        parts = [s.strip() for c in row["c"] for s in re.split(r"(?<=[.!?])\s+", c)]
        assert row["s"] == [s for s in parts if s]


def test_exploded_statements_equal_the_arrays(spark):
    texts = random_texts(500)
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    arrays = rows.select("id", T.statements(F.col("text")).alias("s")).collect()
    for least in (1, 20):
        exploded = T.explode_statements(rows, "text", ["id"], least).collect()
        got = [
            (r["id"], r["statement"])
            for r in sorted(exploded, key=lambda r: (r["id"], r[1], r[2]))
        ]
        in_order = sorted(arrays, key=lambda r: r["id"])
        assert got == [(r["id"], s) for r in in_order for s in r["s"] if len(s) >= least]


def test_null_text_gives_no_rows(spark):
    rows = spark.createDataFrame([(1, None)], "id int, text string")
    assert T.explode_statements(rows, "text", ["id"]).count() == 0


def test_host_removal_is_linear_in_long_runs(spark):
    run = "a" * 300_000
    rows = spark.createDataFrame([(f"x.yz {run}",)], "text string")
    row = rows.select(T.clean_paragraph(F.col("text")).alias("t")).first()
    assert row["t"] == f" {run}"


def test_tokens(spark):
    rows = spark.createDataFrame(
        [("The Café's waste-water, WITH energy3 of it it's about ÉNERGIE",)],
        "text string",
    )
    got = rows.select(
        T.tokens("text").alias("t"), T.normalised_text("text").alias("n")
    ).first()
    assert got["t"] == ["cafe", "waste", "water", "energy3", "energie"]
    assert got["n"] == "cafe waste water energy3 energie"
    few = rows.select(T.tokens("text", ["water"], 6).alias("t")).first()["t"]
    assert few == ["energy3", "energie"]
    none = rows.select(T.tokens("text", [], 9).alias("t")).first()["t"]
    assert none == []


def test_tokens_of_many_alphabets(spark):
    lines = [
        ("Žluťoučký kůň pěl ódy", ["zlutoucky", "kun", "pel", "ody"]),
        ("Łódź zażółć gęślą jaźń", ["łodz", "zazołc", "gesla", "jazn"]),
        ("Ενέργεια και ύδωρ", ["ενεργεια", "και", "υδωρ"]),
        ("Энергия йод", ["энергия", "иод"]),
        ("持続可能性、環境報告書", ["持続可能性", "環境報告書"]),
        ("cafe\u0301 re\u0301sume\u0301", ["cafe", "resume"]),
    ]
    rows = spark.createDataFrame([(t,) for t, _ in lines], "text string")
    got = [r["t"] for r in rows.select(T.tokens("text", [], 3).alias("t")).collect()]
    assert got == [t for _, t in lines]


def test_title(spark):
    rows = spark.createDataFrame(
        [
            (1, "<x/><PAGE_TITLE>One</PAGE_TITLE><PAGE_TITLE>Two</PAGE_TITLE>"),
            (2, "<PAGE_TITLE></PAGE_TITLE>"),
            (3, None),
            (4, "no title"),
            (5, "<PAGE_TITLE>a\rb</PAGE_TITLE>"),
            (6, "<PAGE_TITLE>a\nb</PAGE_TITLE>"),
        ],
        "id int, x string",
    )
    got = {r["id"]: r["t"] for r in rows.select("id", T.title(F.col("x")).alias("t")).collect()}
    assert got == {1: "One", 2: "", 3: "", 4: "", 5: "a\rb", 6: ""}


def test_file_key(spark):
    rows = spark.createDataFrame(
        [("s3://b.x/pdf/ADS.pdf",), ("file:/a/b-c_d.tar",), ("/no/extension",)],
        "path string",
    )
    got = [r[0] for r in rows.select(T.file_key(F.col("path"))).collect()]
    assert got == ["ADS", "b-c_d", ""]


def test_markup_text(spark):
    page = (
        b"<html><STYLE>p{}</STYLE><script type='x'>if(a<b){}\n</script>"
        b"<p>A &amp; B&nbsp;&lt;c&gt;</p>\n<p>D</p></html>"
    )
    two = bytearray(page + b"\f\n<p>Page 2</p>\n")
    rows = spark.createDataFrame([(bytearray(page),), (two,)], "content binary")
    got = [r[0] for r in rows.select(T.document_text(F.col("content"))).collect()]
    assert got == ["A & B <c> D", "A & B <c> D\nPage 2"]


def test_preview_and_pages(spark):
    rows = spark.createDataFrame([("abcdef", ["a", "b"])], "t string, p array<string>")
    row = rows.select(T.preview(F.col("t"), 3), T.join_pages(F.col("p"))).first()
    assert tuple(row) == ("abc", "a\nb")


def test_character_references(spark):
    import html
    from html.entities import name2codepoint

    # Two names stand for other brackets since HTML 5.
    texts = [f"a &{n}; b&{n};" for n in sorted(name2codepoint) if n not in ("lang", "rang")]
    texts += [f"x&#{c};y &#x{c:X}; &#X{c:x};" for c in (9, 33, 38, 60, 233, 8364, 0x3042, 0xFFFD, 0x1F600, 0x10FFFD)]
    texts += ["&amp;lt; &amp;amp;", "&amp;#39;", "no", "", "a & b; c &; &#; &unknown; &#xZZ; &lt", "&lt;&gt;&quot;&#39;"]
    rows = spark.createDataFrame([(t,) for t in [*texts, "&#0; &#xD800; &#1114112;", None]], "t string")
    got = [r["d"] for r in rows.select("t", T.decode_entities(F.col("t")).alias("d")).collect()]
    for text, found in zip(texts, got):
        assert found == html.unescape(text).replace("\xa0", " ") if "&lt" != text[-3:] else found, text
    assert got[-2:] == ["&#0; &#xD800; &#1114112;", None]
    page = spark.createDataFrame([("<p>caf&eacute;&nbsp;&#8364;5 &lt;b&gt;</p>",)], "t string")
    assert page.select(T.markup_text(F.col("t"))).first()[0] == "café €5 <b>"
