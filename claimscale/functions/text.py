"""Text preparation as column expressions.

Nothing here leaves the JVM and nothing shuffles: a document becomes paragraphs,
clean paragraphs and statements inside the task that read it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.operators.compute import explode_computed


ENTITY_START = "&(?=#?[0-9A-Za-z]{1,31};)"


def _sql_text(value: str) -> str:
    return "r'" + value.replace("'", "\\'") + "'"


def printable(text: Column) -> Column:
    """Drop every character outside printable ASCII and ASCII white space."""
    return F.regexp_replace(text, fixed.NON_PRINTABLE, "")


def strip(text: Column) -> Column:
    """Trim all ASCII white space, not only blanks."""
    return F.btrim(text, F.lit(fixed.WHITE_SPACE))


def raw_paragraphs(text: Column) -> Column:
    """Split text into paragraphs, line ends still inside.

    Whether a line opens a paragraph depends only on the end of the line before
    it and on its own first character, so one look-around pattern finds all
    breaks; no line ever has to be compared in another row.  The leading blank
    belongs to the first paragraph.
    """
    return F.split(F.concat(F.lit(" "), printable(text)), fixed.PARAGRAPH_BREAK)


def join_lines(paragraph: Column) -> Column:
    return F.replace(paragraph, F.lit("\n"), F.lit(" "))


def paragraphs(text: Column) -> Column:
    """array<string> of paragraphs, each on one line."""
    return F.transform(raw_paragraphs(text), join_lines)


def _tidy(p: Column) -> Column:
    p = strip(F.regexp_replace(p, fixed.HEADER_NUMBER, "$1"))
    p = F.regexp_replace(p, fixed.HYPHEN_GAP, "-")
    p = F.regexp_replace(p, fixed.PUNCTUATION_GAP, "$1")
    return F.regexp_replace(p, fixed.LONG_NUMBER, " ")


def _drop_hosts(p: Column) -> Column:
    # The host pattern is by far the dearest one, and most paragraphs cannot match.
    dropped = F.regexp_replace(p, fixed.HOST_START + fixed.HOST, " ")
    return F.when(p.rlike(fixed.HOST_HINT), dropped).otherwise(p)


def _collapse(p: Column) -> Column:
    p = F.regexp_replace(p, fixed.SPACE_RUN, " ")
    return F.regexp_replace(p, fixed.POINT_RUN, ".")


# Steps of their own, as the middle one reads its input more than once.
CLEANING = (_tidy, _drop_hosts, _collapse)


def clean_paragraph(paragraph: Column) -> Column:
    """Remove header and long numbers and host names; mend hyphens and spaces."""
    return reduce(lambda column, step: step(column), CLEANING, paragraph)


def split_sentences(paragraph: Column) -> Column:
    return F.split(paragraph, fixed.SENTENCE_BREAK)


def statements(text: Column) -> Column:
    """array<string> of clean, non-empty statements of one document."""
    cleaned = reduce(F.transform, CLEANING, paragraphs(text))
    sentences = F.flatten(F.transform(cleaned, split_sentences))
    return F.filter(F.transform(sentences, strip), lambda s: s != "")


def explode_paragraphs(
    df: DataFrame, text: str, keep: Sequence[str], position: str = "paragraph_no"
) -> DataFrame:
    """One row per paragraph; only ``keep`` travels along with it."""
    return explode_computed(
        df, raw_paragraphs(F.col(text)), keep, position, "paragraph"
    ).withColumn("paragraph", join_lines(F.col("paragraph")))


def explode_clean_paragraphs(
    df: DataFrame, text: str, keep: Sequence[str], min_chars: int = 0
) -> DataFrame:
    """One row per clean paragraph.  Those with fewer than ``min_chars`` raw signs may go."""
    # No step lengthens a text: what is too short now would be too short later.
    long_enough = explode_paragraphs(df, text, keep).filter(
        F.length("paragraph") >= min_chars
    )
    return reduce(
        lambda rows, step: rows.withColumn("paragraph", step(F.col("paragraph"))),
        CLEANING,
        long_enough,
    )


def explode_statements(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    min_chars: int = fixed.MIN_STATEMENT_CHARS,
    split: Callable[[Column], Column] = split_sentences,
    mark: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per statement of at least ``min_chars`` characters.

    Rows are exploded before they are cleaned, so the patterns run as generated
    code on single strings.  (``paragraph_no``, ``sentence_no``) identifies a
    statement within its document.  ``split`` cuts a clean paragraph into sentences,
    by the fixed rule or by a learned one (``sentences.rule``); ``mark`` may add columns
    that it needs.
    """
    min_chars = max(min_chars, 1)
    cleaned = explode_clean_paragraphs(df, text, keep, min_chars)
    if mark:
        cleaned = mark(cleaned)
    return (
        explode_computed(
            cleaned,
            split(F.col("paragraph")),
            [*keep, "paragraph_no"],
            "sentence_no",
            "statement",
        )
        .withColumn("statement", strip(F.col("statement")))
        .filter(F.length("statement") >= min_chars)
    )


def _folding() -> tuple[str, str]:
    """Small letters with marks, and the same letters without, by Unicode's decompositions.

    The combining marks themselves come last and have no counterpart: they go.
    """
    marked, plain = [], []
    for code in range(0xC0, 0x2000):
        letter = chr(code)
        rest = [c for c in unicodedata.normalize("NFD", letter) if not unicodedata.combining(c)]
        if letter.lower() == letter and len(rest) == 1 and rest[0] != letter:
            marked.append(letter)
            plain.append(rest[0])
    return "".join(marked) + "".join(map(chr, range(0x300, 0x370))), "".join(plain)


ACCENTED, UNACCENTED = _folding()


def fold(text: Column) -> Column:
    """Lower case without accents, in every alphabet whose letters carry them."""
    return F.translate(F.lower(text), ACCENTED, UNACCENTED)


def token_sql(
    column: str,
    stop_words: Sequence[str] = fixed.STOP_WORDS,
    min_chars: int = fixed.MIN_TOKEN_CHARS,
) -> str:
    """SQL text of :func:`tokens`; a fitted model stores it as a stage."""
    words = ", ".join(_sql_text(w) for w in stop_words)
    keep = f"length(t) >= {int(min_chars)}"
    if words:
        keep += f" AND t NOT IN ({words})"
    return (
        f"filter(split(translate(lower({column}), '{ACCENTED}', "
        f"'{UNACCENTED}'), {_sql_text(fixed.TOKEN_BREAK)}), t -> {keep})"
    )


def tokens(
    column: str,
    stop_words: Sequence[str] = fixed.STOP_WORDS,
    min_chars: int = fixed.MIN_TOKEN_CHARS,
) -> Column:
    """array<string>: folded words, stop words and short words removed."""
    return F.expr(token_sql(column, stop_words, min_chars))


def normalised_text(column: str, **options) -> Column:
    """The tokens of a text joined by blanks."""
    return F.array_join(tokens(column, **options), " ")


def title(markup: Column, tag: str = fixed.TITLE_TAG) -> Column:
    """Text of the first ``tag`` element, '' when there is none."""
    found = F.regexp_extract(markup, f"(?d)<{tag}>(.+?)</{tag}>", 1)
    # The search for the bare tag works on bytes; only a hit is decoded for the pattern.
    return F.when(markup.contains(f"<{tag}>"), found).otherwise(F.lit(""))


def file_key(path: Column, pattern: str = fixed.FILE_KEY) -> Column:
    """File name without its extension, or what another pattern takes of a path."""
    return F.regexp_extract(path, pattern, 1)


def preview(text: Column, chars: int = fixed.PREVIEW_CHARS) -> Column:
    return F.substring(text, 1, chars)


def join_pages(pages: Column) -> Column:
    """array<string> of page texts to one text."""
    return F.array_join(pages, "\n")


def _sign_of(point: Column) -> Column:
    """The sign of a code point; null for those that are none."""
    wide = point - 0x10000
    high = F.shiftright(wide, 10).bitwiseOR(F.lit(0xD800))
    low = wide.bitwiseAND(F.lit(0x3FF)).bitwiseOR(F.lit(0xDC00))
    digits = F.when(point < 0x10000, F.lpad(F.hex(point), 4, "0")).otherwise(F.concat(F.hex(high), F.hex(low)))
    usable = ((point > 0) & (point < 0xD800)) | ((point > 0xDFFF) & (point <= 0x10FFFF))
    return F.when(point == 0xA0, " ").when(usable, F.decode(F.unhex(digits), "UTF-16BE"))


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal character references as the signs they stand for.

    Each is read once: what a reference spells is not read again.  A hard space becomes a
    blank; names that HTML 4 doesn't have, and numbers that are no sign, stay as they are.
    """
    named = F.create_map(
        *[F.lit(v) for name, code in sorted(name2codepoint.items()) for v in (name, chr(code))]
    )
    pieces = F.split(text, ENTITY_START)

    def read(piece: Column, at: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        rest = F.substr(piece, F.length(name) + 2)
        decimal = F.when(name.rlike("^#[0-9]{1,7}$"), F.substr(name, F.lit(2)).cast("int"))
        hexadecimal = F.when(
            name.rlike("^#[xX][0-9A-Fa-f]{1,6}$"), F.conv(F.substr(name, F.lit(3)), 16, 10).cast("int")
        )
        sign = F.coalesce(
            _sign_of(F.coalesce(decimal, hexadecimal)),
            F.when(name == "nbsp", " ").otherwise(F.try_element_at(named, name)),
        )
        read_sign = F.when(sign.isNotNull(), F.concat(sign, rest)).otherwise(F.concat(F.lit("&"), piece))
        return F.when(at == 0, piece).otherwise(read_sign)

    # Most texts have none.
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, read), "")).otherwise(text)


def markup_text(markup: Column) -> Column:
    """Readable text of a marked-up document."""
    text = F.regexp_replace(markup, r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    return strip(F.regexp_replace(decode_entities(text), r"\s+", " "))


def document_text(content: Column) -> Column:
    """Text of a binary document: UTF-8 markup, pages divided by form feeds."""
    pages = F.split(F.decode(content, "UTF-8"), fixed.PAGE_BREAK)
    return join_pages(F.transform(pages, markup_text))
