"""Quality rules: a table of thresholds over text measures, compiled into one Spark projection.

Every measure is a native column of the document alone, so a scan of the documents is all the work there is: no
shuffle, no user function.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES_RE, let, split_words, strip_spaces

WINDOW = 8
SYMBOLS_RE = "[#*$%&|<>]"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he this are or his from at which but have an they you "
    "der die das und in zu den von mit ist des sich ein dem nicht eine als auch es an werden aus er hat dass "
    "le la les de des et un une du en que qui dans pour par sur pas au est plus ce il elle ou se ne son "
    "el los las del y en un una que con por para no su al lo como más pero sus se es"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; an open side is None, an empty denominator passes."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.col(self.numerator)
        if self.denominator:
            value = value / F.when(F.col(self.denominator) > 0, F.col(self.denominator))
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.high is not None:
            ok = ok & (value <= self.high)
        return F.coalesce(ok, F.lit(True))


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbols", "n_symbols", "n_words", high=0.2),
    Rule("stop_words", "n_stop_words", "n_words", low=0.05),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
)


def _either_case(words: list[str]) -> list[str]:
    return sorted({x for w in words for x in (w, w.capitalize())})


def _window_hashes(words: Column) -> Column:
    """A hash of each window of eight words, by three doublings of neighbouring hashes."""
    def doubled(hashes: Column, step: int) -> Column:
        # the shifted array is shorter, so the last entries pair with null and are cut off
        return let(hashes, lambda a: F.slice(
            F.zip_with(a, F.slice(a, F.lit(1 + step), F.size(a)), lambda x, y: F.xxhash64(x, y)),
            F.lit(1), F.greatest(F.size(a) - step, F.lit(0))))

    return doubled(doubled(doubled(F.transform(words, lambda w: F.xxhash64(w)), 1), 2), 4)


def _covered_by_repeats(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more.

    Sorting (hash, start) pairs puts equal windows side by side; the starts that have an equal neighbour, sorted
    again, cover eight words each minus the overlap with the next one.
    """
    def starts(pairs: Column) -> Column:
        n = F.size(pairs)
        h = lambda i: F.get(pairs, i)["h"]
        same = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(h(i) == h(i + 1), F.lit(False))
                        | F.coalesce((i > 0) & (h(i) == h(F.greatest(i - 1, F.lit(0)))), F.lit(False)))
        return F.array_sort(F.transform(same, lambda i: F.get(pairs, i)["at"]))

    def cover(at: Column) -> Column:
        gaps = F.zip_with(F.slice(at, F.lit(2), F.size(at)), at, lambda nxt, cur: F.coalesce(nxt - cur, F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + F.least(gap, F.lit(WINDOW)))

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    return let(let(pairs, starts), cover)


def _repeat_words(words: Column) -> Column:
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(
        let(_window_hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
            .otherwise(_covered_by_repeats(h))))


def measures(text: Column) -> Column:
    """The measures of one text as a struct; a null text counts as empty."""
    stops = _either_case(STOP_WORDS)
    text = F.coalesce(text, F.lit(""))

    def line_counts(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"))

    def build(t: Column) -> Column:
        def counted(words: Column) -> Column:
            lines = F.filter(F.split(t, "\n"), lambda x: F.length(strip_spaces(x)) > 0)
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.regexp_count(t, F.lit(SYMBOLS_RE)).cast("long").alias("n_symbols"),
                let(lines, line_counts).alias("lines"),
                F.size(F.filter(words, lambda w: w.isin(stops))).cast("long").alias("n_stop_words"),
                _repeat_words(words).alias("n_repeat_words"),
            )
        return let(split_words(t, SPACES_RE), counted)

    return let(text, build)


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 20, max_repeat_percent: int = 30,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the measures, ``base_failed``, ``failed`` (names of the rules not met) and ``kept``.

    A null or empty text has no words and fails the base rule. Repeated rows each get their row; other columns of
    the input are not carried. An empty table gives an empty table.
    """
    m = docs.select(F.col(id_col), measures(F.col(text_col)).alias("m")).select(
        id_col, "m.n_words", "m.word_chars", "m.n_symbols", F.col("m.lines.dup").alias("n_dup_lines"),
        "m.n_repeat_words", F.col("m.lines.n").alias("n_lines"), "m.n_stop_words")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]))
    return (m.withColumn("base_failed", base).withColumn("failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))
