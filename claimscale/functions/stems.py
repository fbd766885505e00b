"""Base forms of words: stems by suffix rules, lemmas by endings that the corpus confirms.

Both work on a table of distinct terms, so each word is worked out once however often
it occurs, and counts or texts take the result by a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.operators.joins import lookup_join
from claimscale.sources.staging import stage

# Y is a y that is read as a consonant; a bar parts a word from the suffix that was
# found, # marks a word that lost "ed" or "ing", and E an e that stays.
_V, _C = "[aeiouy]", "[b-df-hj-np-tv-xzY]"
_LEFT = {
    "": "(.*)",
    "v": f"(.*{_V}.*)",
    "m0": f"(.*{_V}{_C}.*)",
    "m1": f"(.*{_V}{_C}.*{_V}{_C}.*)",
    "st": f"(.*{_V}{_C}.*{_V}(?:{_C}.*)?[st])",
}
_SHORT = f"{_C}+{_V}[b-df-hj-np-tvz]"  # one sequence, ending in consonant, vowel, consonant


def _step(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str]]:
    """Patterns of one step: part the longest suffix, replace it where it may go, join again."""
    longest = sorted((suffix for suffix, _, _ in rules), key=len, reverse=True)
    found = [(f"({'|'.join(longest)})$", "|$1")]
    # Rules that put nothing in a suffix's place and ask for the same are one pattern.
    alike: dict[tuple[str, str], list[str]] = {}
    for suffix, new, condition in rules:
        alike.setdefault((new, condition), []).append(suffix)
    for (new, condition), suffixes in alike.items():
        found.append((rf"^{_LEFT[condition]}\|(?:{'|'.join(suffixes)})$", f"$1{new}"))
    return [*found, (r"\|", "")]


def stem_patterns() -> list[tuple[str, str]]:
    """(pattern, replacement) in the order of their use, on a word of small Latin letters."""
    past = [
        ("(eed|ed|ing)$", "|$1"),
        (rf"^{_LEFT['m0']}\|eed$", "$1ee"),
        (rf"^{_LEFT['v']}\|(?:ed|ing)$", "$1#"),
        (r"\|", ""),
        ("at#$", "ate"),
        ("bl#$", "ble"),
        ("iz#$", "ize"),
        (r"([b-df-hjkmnp-rtv-xY])\1#$", "$1"),
        (f"^({_SHORT})#$", "$1e"),
        ("#$", ""),
    ]
    last = [
        (f"^{_LEFT['m1']}e$", "$1"),
        (f"^({_SHORT})e$", "$1E"),
        (f"^({_C}*{_V}+{_C}+{_V}*)e$", "$1"),
        (f"^(.*{_V}{_C}.*{_V}(?:{_C}.*)?l)l$", "$1"),
    ]
    consonants = [(f"(?<=(?:^|[aeiou])(?:yy){{0,20}})y", "Y")]
    return [
        *consonants,
        *_step(fixed.STEM_PLURALS),
        *past,
        (f"^{_LEFT['v']}[yY]$", "$1i"),
        *_step(fixed.STEM_STEP_2),
        *_step(fixed.STEM_STEP_3),
        *_step(fixed.STEM_STEP_4),
        *last,
    ]


def stem(word: Column) -> Column:
    """The stem of an English word in small letters; other words stay as they are.

    A word reads as consonants and vowels, and a suffix goes if enough of these are
    left.  Words of one or two letters, and those with other signs, have no suffix.
    """
    found = word
    for pattern, replacement in stem_patterns():
        found = F.regexp_replace(found, pattern, replacement)
    return F.when(word.rlike("^[a-z]{3,}$"), F.lower(found)).otherwise(word)


def stems(terms: DataFrame) -> DataFrame:
    """term, base: of a table of distinct terms."""
    return terms.select("term", stem(F.col("term")).alias("base"))


def lemmas(
    terms: DataFrame,
    exceptions: DataFrame | None = None,
    endings: Sequence[tuple[str, str]] = fixed.LEMMA_ENDINGS,
    min_chars: int = 3,
) -> DataFrame:
    """term, base: what an inflected word is a form of, of a table of distinct terms.

    An ending is replaced only where the outcome, of ``min_chars`` signs at least, is
    itself a term of the table; the first of ``endings`` that fits decides.  A row of
    ``exceptions`` (term, base) comes before all rules.  A word without a base is its own.
    The terms are joined with themselves by candidate, so no list of them is held anywhere.
    """
    held = stage(terms.select("term"), "terms")
    offers = F.array(
        *[
            F.when(
                F.col("term").endswith(old),
                F.struct(
                    F.lit(i).alias("at"),
                    F.concat(F.expr(f"left(term, length(term) - {len(old)})"), F.lit(new)).alias("base"),
                ),
            )
            for i, (old, new) in enumerate(endings)
        ]
    )
    offered = held.select("term", F.explode(F.filter(offers, lambda o: o.isNotNull())).alias("o"))
    offered = offered.select("term", "o.at", "o.base").filter(F.length("base") >= min_chars)
    known = held.select(F.col("term").alias("base"))
    confirmed = lookup_join(offered, known, ["base"])
    first = confirmed.groupBy("term").agg(F.min(F.struct("at", "base")).alias("first"))
    found = first.select("term", F.col("first.base").alias("found"))
    joined = held.join(found, "term", "left")
    base = F.coalesce("found", "term")
    if exceptions is not None:
        named = exceptions.select("term", F.col("base").alias("named")).dropDuplicates(["term"])
        joined = joined.join(named, "term", "left")
        base = F.coalesce("named", "found", "term")
    return joined.select("term", base.alias("base"))
