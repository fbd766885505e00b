"""Sentence ends learned from the corpus: abbreviations, openings and fixed pairs.

A word that nearly always has a full stop after it, though it is short, is an
abbreviation; a word that stands after sentence ends far more often than elsewhere opens
sentences; and a pair of words around a full stop may belong together.  All three are
likelihood ratios of counts over the whole corpus.  What was learned is three lists, whole.
While they are short a text is cut by them in the task that reads it; longer ones stay
tables that sentence ends are joined with (``rule``).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.operators.compute import explode_computed
from claimscale.operators.joins import held_bytes, lookup_join, measured
from claimscale.sources.staging import stage

PLAN_BYTES = 1 << 20  # of a list that the plan may hold; a longer one stays a table


@dataclass(frozen=True)
class Sentences:
    """What was learned; words in small letters, without the full stop."""

    abbreviations: tuple[str, ...] = ()
    starters: tuple[str, ...] = ()
    pairs: tuple[tuple[str, str], ...] = ()


def bare(word: Column) -> Column:
    """A word in small letters without signs around it; full stops at its end stay."""
    inner = F.regexp_replace(F.lower(word), "^[^a-z0-9]+", "")
    return F.regexp_replace(inner, "[^a-z0-9.]+$", "")


def word_type(word: Column) -> Column:
    """The same without the last full stop."""
    return F.regexp_replace(bare(word), r"\.$", "")


def word_places(paragraphs: DataFrame, text: str) -> DataFrame:
    """word, stopped, next: every word, whether it has a full stop, and the one after it.

    Signs around words go from a whole paragraph at a time (as ``bare`` and ``word_type``
    do from a word), so each pattern runs once a paragraph and not several times a word.
    """
    line = F.btrim(F.regexp_replace(F.lower(F.col(text)), " {2,}", " "), F.lit(" "))
    line = F.regexp_replace(line, "(?<![^ ])[^a-z0-9 ]+", "")
    # Within a run of signs the pattern gives up at once, as the run was tried from its start.
    line = F.regexp_replace(line, "[^a-z0-9. ](?<![^a-z0-9. ]{2})[^a-z0-9. ]*+(?![^ ])", "")
    # A text without words has no pieces; a word of nothing but signs is an empty one.
    has_words = F.length(F.replace(F.col(text), F.lit(" "), F.lit(""))) > 0
    lines = explode_computed(paragraphs.filter(has_words), F.array(line), [], "_at", "line")
    words = F.split(F.regexp_replace("line", r"\.(?![^ ])", ""), " ")
    stopped = F.transform(F.split("line", " "), lambda w: w.endswith("."))
    lists = explode_computed(lines, F.array(F.struct(words.alias("words"), stopped.alias("stopped"))), [], "_at", "l")
    following = F.slice("l.words", 2, F.greatest(F.size("l.words") - 1, F.lit(0)))
    place = F.arrays_zip(F.col("l.words"), F.col("l.stopped"), following)
    rows = explode_computed(lists, place, [], "_at", "place")
    return rows.select(*[F.col(f"place.`{n}`").alias(c) for n, c in zip(("words", "stopped", "2"), ("word", "stopped", "next"))])


def place_counts(places: DataFrame) -> DataFrame:
    """word, stopped, next, n: equal places as one row; what follows counts behind full stops only."""
    following = F.when(F.col("stopped"), F.col("next")).alias("next")
    return places.groupBy("word", "stopped", following).agg(F.count(F.lit(1)).alias("n"))


def stops_of(counted: DataFrame) -> DataFrame:
    """``word_stops`` from counted places."""
    n = F.when(F.col("stopped"), F.col("n")).otherwise(0), F.when(F.col("stopped"), 0).otherwise(F.col("n"))
    return counted.groupBy("word").agg(F.sum(n[0]).alias("stopped"), F.sum(n[1]).alias("open"))


def word_stops(places: DataFrame) -> DataFrame:
    """word, stopped, open: how often each word has a full stop and how often not."""
    return places.groupBy("word").agg(
        F.count_if("stopped").alias("stopped"), F.count_if(~F.col("stopped")).alias("open")
    )


def _log(p: Column) -> Column:
    """Logarithm of a share, kept off 0 and 1 by a hair."""
    return F.log(F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12)))


def _binomial(hits: Column, tries: Column, share: Column) -> Column:
    return hits * _log(share) + (tries - hits) * _log(1 - share)


def abbreviation_scores(stops: DataFrame) -> DataFrame:
    """word, stopped, open, score: how surely a word is an abbreviation.

    The ratio of "has a full stop almost always" to "as often as any word", less for long
    words and for every time it stands without one, more for full stops inside.
    """
    rows = stops.filter((F.col("stopped") > 0) & F.col("word").rlike("[a-z]"))
    tries = F.col("stopped") + F.col("open")
    # Both sums are scalar subqueries.
    n, n_stopped = (stops.select(F.sum(c)).scalar() for c in (tries, F.col("stopped")))
    usual, always = n_stopped / n, F.lit(0.99)
    ratio = -2 * (_binomial(F.col("stopped"), tries, usual) - _binomial(F.col("stopped"), tries, always))
    points = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    signs = F.length("word") - points
    score = ratio * F.exp(-signs) * (points + 1) * F.pow(signs, -F.col("open"))
    return rows.select("word", "stopped", "open", score.alias("score"))


def pair_ratio(a: Column, b: Column, both: Column, n: Column) -> Column:
    """Likelihood ratio of "b comes with a more often than elsewhere", from counts of n."""
    p, p1, p2 = b / n, both / a, (b - both) / (n - a)
    apart = _binomial(both, a, p) + _binomial(b - both, n - a, p)
    own = F.when(a == both, 0.0).otherwise(_binomial(both, a, p1))
    own += F.when(b == both, 0.0).otherwise(_binomial(b - both, n - a, p2))
    return -2 * (apart - own)


def _joined_counts(rows: DataFrame, counts: DataFrame, key: str, name: str) -> DataFrame:
    named = counts.select(F.col("word").alias(key), F.col("tries").alias(name))
    return lookup_join(rows, named, [key])


def starter_scores(counted: DataFrame, counts: DataFrame, shortened: DataFrame) -> DataFrame:
    """word, at_start, tries, score: words by how much sentence starts attract them.

    A full stop ends a sentence here if its word is neither an abbreviation nor a letter.
    """
    ends = counted.filter(F.col("stopped") & F.col("next").isNotNull() & ~F.col("word").rlike("^[a-z]$"))
    ends = ends.join(measured(shortened.select("word")), "word", "left_anti")
    starts = ends.groupBy(F.col("next").alias("word")).agg(F.sum("n").alias("at_start"))
    starts = stage(starts, "starts")
    n = counts.select(F.sum("tries")).scalar()
    all_ends = starts.select(F.sum("at_start")).scalar()
    rows = _joined_counts(starts.filter(F.col("word").rlike("[a-z]")), counts, "word", "tries")
    score = pair_ratio(all_ends, F.col("tries"), F.col("at_start"), n)
    more = F.col("at_start") * n > F.col("tries") * all_ends
    return rows.filter(more).select("word", "at_start", "tries", score.alias("score"))


def pair_scores(
    counted: DataFrame, counts: DataFrame, shortened: DataFrame, starters: DataFrame
) -> DataFrame:
    """word, next, together, score: pairs around the full stop of an abbreviation or a letter."""
    held = counted.filter("stopped").filter(F.col("next").rlike("[a-z]"))
    short = measured(shortened.select("word", F.lit(True).alias("short")))
    held = held.join(short, "word", "left").filter(F.col("short") | F.col("word").rlike("^[a-z]$"))
    held = held.groupBy("word", "next").agg(F.sum("n").alias("together"))
    opens = measured(starters.select(F.col("word").alias("next")))
    held = held.filter(F.col("together") > 1).join(opens, "next", "left_anti")
    rows = _joined_counts(_joined_counts(held, counts, "word", "a"), counts, "next", "b")
    n = counts.select(F.sum("tries")).scalar()
    score = pair_ratio(F.col("a"), F.col("b"), F.col("together"), n)
    more = F.col("together") * n > F.col("a") * F.col("b")
    return rows.filter(more).select("word", "next", "together", score.alias("score"))


def scores(
    paragraphs: DataFrame, text: str = "paragraph", most: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables of abbreviations, starters and pairs that reach their thresholds.

    The paragraphs are read once: words, and pairs behind full stops, are counted with
    partial sums in every task, and all three lists come from these counts.  The lists may
    grow with the corpus and are whole; only a caller who sets ``most`` gets the best of each.
    """
    counted = stage(place_counts(word_places(paragraphs, text)), "places")
    stops = stage(stops_of(counted), "stops")
    counts = stops.select("word", (F.col("stopped") + F.col("open")).alias("tries"))
    order = [F.desc("score"), F.asc("word")]

    def best(rows: DataFrame, least: float, *ties: str) -> DataFrame:
        kept = rows.filter(F.col("score") >= least).orderBy(*order, *ties)
        return stage(kept if most is None else kept.limit(most), "learned")

    shortened = best(abbreviation_scores(stops), fixed.ABBREVIATION_SCORE)
    starters = best(starter_scores(counted, counts, shortened), fixed.STARTER_SCORE)
    pairs = pair_scores(counted, counts, shortened, starters)
    return shortened, starters, best(pairs, fixed.PAIR_SCORE, "next")


def train(
    paragraphs: DataFrame, text: str = "paragraph", most: int | None = None
) -> Sentences:
    """Learn from clean paragraphs (words parted by single blanks).

    The lists come to the driver; ``rule`` also does with lists that don't fit there.
    """
    return _collected(*scores(paragraphs, text, most))


def _collected(shortened: DataFrame, starters: DataFrame, pairs: DataFrame) -> Sentences:
    return Sentences(
        tuple(sorted(r["word"] for r in shortened.collect())),
        tuple(sorted(r["word"] for r in starters.collect())),
        tuple(sorted((r["word"], r["next"]) for r in pairs.collect())),
    )


def _around(piece: Column, following: Column) -> tuple[Column, Column, Column, Column]:
    """The words around the end of a piece, whether the first is a letter, the second has a capital."""
    last, first = F.regexp_extract(piece, r"(?<!\S)(\S+)$", 1), F.regexp_extract(following, r"^(\S+)", 1)
    word = word_type(last)
    return word, word_type(first), word.rlike("^[a-z]$"), first.rlike("^[^a-z]*[A-Z]")


def _goes_on(piece: Column, following: Column, known: Sentences) -> Column:
    """Whether the full stop at the end of a piece ends no sentence."""
    word, after, letter, capital = _around(piece, following)
    short = word.isin(list(known.abbreviations)) if known.abbreviations else F.lit(False)
    opens = after.isin(list(known.starters)) if known.starters else F.lit(False)
    pair = F.concat(word, F.lit(" "), after)
    fixed_pair = pair.isin([f"{a} {b}" for a, b in known.pairs]) if known.pairs else F.lit(False)
    ends = short & ~letter & opens & capital & ~fixed_pair
    return piece.endswith(".") & (letter | short) & ~ends


def split_learned(paragraph: Column, known: Sentences) -> Column:
    """array<string> of sentences of a clean paragraph.

    ``!`` and ``?`` end a sentence, and so does a full stop, but after single letters
    (initials) and abbreviations.  An abbreviation ends one where a word follows that
    opens sentences, with a capital, unless the two are a fixed pair.
    """

    def marked(pieces: Column) -> Column:
        return F.transform(
            pieces,
            lambda p, i: F.concat(
                p,
                F.when(i + 1 >= F.size(pieces), "")
                .when(_goes_on(p, F.get(pieces, i + 1), known), " ")
                .otherwise("\n"),
            ),
        )

    # As a value of an array the pieces are cut once, not once for each of them.
    pieces = F.split(paragraph, fixed.SENTENCE_BREAK)
    joined = F.transform(F.array(pieces), lambda cut: F.array_join(marked(cut), ""))
    return F.split(F.get(joined, F.lit(0)), "\n")


def going_on(
    rows: DataFrame, key: str, shortened: DataFrame, starters: DataFrame, pairs: DataFrame
) -> DataFrame:
    """key, going: the pieces of each paragraph whose full stop ends no sentence, by place.

    What ``_goes_on`` says, by joins with lists of any length: distinct pairs of words
    around a full stop meet the lists, and the places meet these pairs.  Paragraphs
    without such a piece have no row.
    """
    # As a value of an array the pieces are cut once.
    pieces = F.transform(
        F.array(F.split("paragraph", fixed.SENTENCE_BREAK)),
        lambda cut: F.transform(
            cut, lambda p, i: F.struct(p.alias("piece"), F.get(cut, i + 1).alias("following"))
        ),
    )
    each = explode_computed(rows, F.get(pieces, F.lit(0)), [key], "at", "p").select(key, "at", "p.*")
    names = ("word", "after", "letter", "capital")
    said = [c.alias(n) for n, c in zip(names, _around(F.col("piece"), F.col("following")))]
    places = stage(
        each.filter(F.col("piece").endswith(".") & F.col("following").isNotNull()).select(key, "at", *said), "places"
    )
    around = places.filter("not letter").select("word", "after").distinct()
    around = around.join(measured(shortened.select("word")), "word", "left_semi")
    opens = measured(starters.select(F.col("word").alias("after"), F.lit(True).alias("opens")))
    held = measured(pairs.select("word", F.col("next").alias("after"), F.lit(True).alias("held")))
    around = around.join(opens, "after", "left").join(held, ["word", "after"], "left")
    may_end = F.col("opens").isNotNull() & F.col("held").isNull()
    around = stage(around.select("word", "after", may_end.alias("may_end")), "around")
    known = lookup_join(places.filter("not letter"), around, ["word", "after"])
    going = known.filter("not (may_end and capital)").select(key, "at")
    going = going.unionByName(places.filter("letter").select(key, "at"))
    return going.groupBy(key).agg(F.sort_array(F.collect_list("at")).alias("going"))


def split_marked(paragraph: Column, going: Column) -> Column:
    """``split_learned`` where the places of pieces that go on are known, in order (null: none)."""

    def flags(places: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(places, i - 1)).otherwise(-1)
        ends = lambda at, i: F.array_repeat(F.lit(False), at - before(i) - 1)
        return F.flatten(F.transform(places, lambda at, i: F.concat(ends(at, i), F.array(F.lit(True)))))

    none = F.array().cast("array<boolean>")
    marked = F.zip_with(
        F.split(paragraph, fixed.SENTENCE_BREAK),
        F.coalesce(flags(going), none),
        lambda piece, on: F.concat(piece, F.when(on, " ").otherwise("\n")),
    )
    # Every piece has a sign behind it, the last one too.
    joined = F.transform(
        F.array(F.array_join(marked, "")), lambda text: F.substr(text, F.lit(1), F.length(text) - 1)
    )
    return F.split(F.get(joined, F.lit(0)), "\n")


@dataclass(frozen=True)
class Rule:
    """How ``text.explode_statements`` cuts: what it marks paragraphs with, and what splits them."""

    split: Callable[[Column], Column]
    mark: Callable[[DataFrame], DataFrame] | None = None


def rule(paragraphs: DataFrame, text: str = "paragraph", plan_bytes: int = PLAN_BYTES) -> Rule:
    """Learn from clean paragraphs, and cut by all that was learned.

    Lists of at most ``plan_bytes`` each travel in the plan, and no text moves.  Longer
    ones stay tables: sentence ends are joined with them, and paragraphs with the outcome.
    """
    lists = scores(paragraphs, text)
    words = [t.select(*(c for c in ("word", "next") if c in t.columns)) for t in lists]
    if all(held_bytes(w) <= plan_bytes for w in words):
        known = _collected(*words)
        return Rule(lambda paragraph: split_learned(paragraph, known))

    def mark(cleaned: DataFrame) -> DataFrame:
        # Keys may repeat or be null: paragraphs get numbers, which are written with them.
        rows = stage(cleaned.withColumn("_row", F.monotonically_increasing_id()), "marked")
        going = going_on(rows, "_row", *words).withColumnRenamed("going", "_going")
        return rows.join(going, "_row", "left")

    return Rule(lambda paragraph: split_marked(paragraph, F.col("_going")), mark)


def save(known: Sentences, path: str) -> None:
    spark = SparkSession.active()
    one = spark.createDataFrame([(json.dumps(asdict(known)),)], "known string")
    one.coalesce(1).write.mode("overwrite").text(path)


def load(path: str) -> Sentences:
    said = json.loads(SparkSession.active().read.text(path).collect()[0][0])
    pairs = tuple((a, b) for a, b in said["pairs"])
    return Sentences(tuple(said["abbreviations"]), tuple(said["starters"]), pairs)
