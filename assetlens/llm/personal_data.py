"""Personal data: fixed patterns, and identifiers that are found by the words they stand beside.

Mentions are the spans of the fixed patterns (the seeds) and every other run of marks that could be an identifier. The two
words before a mention and the two after it are its patterns. Patterns and instances (the mentions' texts) form a graph,
kept as a table of counted edges. In each round Spark scores the patterns by the instances they stand beside, then the
instances by their patterns:

    confidence of a pattern for a kind = mentions beside it, each weighted by its instance's score / places of the pattern
    score of an instance for a kind    = 1 for a seed, else 1 - product of (1 - confidence) over its patterns

A pattern counts if it stands beside enough different seeds of a kind. Its places are counted in the whole corpus, whatever
stands there, so that words as common as "of the" find nothing. In the end, confident patterns mark the mentions
beside them that no fixed pattern knows.

All graph steps are joins and aggregations with a map-side combine, over tables that hold mentions, not texts. Texts are read
twice: for the mentions, and to count the places of the patterns. The second pass drops most word pairs by a bit map of
fixed size; the exact join comes after it, so a fuller map costs time, not results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import slices, stored

KINDS = ("email", "ip", "card", "phone")
LEARNED = "learned_"

# The patterns of the text contract. Character runs are possessive, which changes no match: what follows a
# run never begins with one of its characters.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_END, _MARKS = r"(?![^\s\"'<>\[\]{}|,;:!?])", r"[^\s\"'<>\[\]{}|,;:!?]"
_GROUP = rf"(?=[0-9()+./-]*+{_END})[()+./-]*+[0-9][0-9()+./-]*+"
#: What else may be an identifier: groups of digits, or a run of marks with a digit or an @ in it. It is looked for where
#: a run begins and never goes back, so long runs cost no more than others.
RUN = re.compile(rf"(?<!{_MARKS})(?:{_GROUP}(?:\x20{_GROUP})*+|(?:(?![0-9@]){_MARKS})*+[0-9@]{_MARKS}*+)")
WORD = re.compile(r"[^\W\d_]+")
ASIDE = 64  # code points looked at on either side of a mention
MAP_BITS = 1 << 26  # bits of the map of patterns (8 MB)

MIN_SEEDS, MIN_CONFIDENCE, ROUNDS = 3, 0.8, 3


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def _is_byte(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def luhn(digits: list[int]) -> bool:
    """The check sum of card numbers: every second digit from the right is doubled."""
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @: what stands before it is scanned once, however long it is."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at - len(text[free:at]) + len(text[free:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def fixed_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start, in code points: leftmost matches that do not overlap within a
    kind; a match that fails its check is dropped."""
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(_is_byte, m[0].split(".")))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text)
            if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def other_runs(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs that could be identifiers and touch none of the spans, without marks at their ends."""
    spans = sorted((a, b) for _, a, b in taken)
    k = 0
    for m in RUN.finditer(text):
        body = m[0].lstrip(".(-/").rstrip(".)-/(")
        if not body or ("@" not in body and len(_digits(body)) < 4):
            continue
        a = m.start() + m[0].index(body)
        b = a + len(body)
        while k < len(spans) and spans[k][1] <= a:
            k += 1
        if k == len(spans) or spans[k][0] >= b:
            yield a, b


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One signed number per pair of word hashes, in order."""
    h = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second + np.uint64(0x632BE59BD9B4E019))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def _pattern(words: list[str], side: int) -> list[int]:
    """The number of a pattern: pairs of words, of which the lowest bit says on which side the mention stands."""
    if len(words) < 2:
        return []
    h = np.array([_hash(w) for w in words], np.uint64)
    return [int(_pair(h[:1], h[1:])[0]) & ~1 | side]


def patterns(text: str, start: int, end: int) -> list[int]:
    """The patterns of a mention: the two words before it (lowest bit 0) and the two after it (1), where there are two
    within ``ASIDE`` code points. Words are runs of letters in lower case."""
    before = WORD.findall(text[max(0, start - ASIDE):start].lower())[-2:]
    after = WORD.findall(text[end:end + ASIDE].lower())[:2]
    return _pattern(before, 0) + _pattern(after, 1)


_MENTIONS = ("base array<struct<kind:string,start:long,end:long>>, others array<struct<start:long,end:long>>, "
             "mentions array<struct<instance:bigint,kind:string,patterns:array<bigint>>>")


def read_mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, id, base, others, mentions``: the spans of the fixed patterns, those of other runs, and for all of them, in
    this order, the hash of their lower-cased text, their kind (null for others) and their patterns. Written as a table,
    in which ``row`` numbers the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                base, others, mentions = [], [], []
                for text in part.column("text").to_pylist():
                    spans = fixed_spans(text) if text else []
                    runs = list(other_runs(text, spans)) if text else []
                    base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                    others.append([{"start": a, "end": b} for a, b in runs])
                    mentions.append([
                        {"instance": _hash(text[a:b].lower()) - (1 << 63), "kind": k, "patterns": patterns(text, a, b)}
                        for k, a, b in [*spans, *((None, a, b) for a, b in runs)]])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(base, _SPANS), pa.array(others, _RUNS), pa.array(mentions, _FOUND)],
                    ["id", "base", "others", "mentions"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, {_MENTIONS}")
    return stored(found.select(F.monotonically_increasing_id().alias("row"), "*"), "mentions")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.list_(pa.struct([("instance", pa.int64()), ("kind", pa.string()), ("patterns", pa.list_(pa.int64()))]))


def pattern_map(wanted: DataFrame, bits: int = MAP_BITS) -> bytes:
    """A bit map of ``bits`` bits with those of the patterns set: Spark builds it piece by piece, the driver puts the
    pieces together."""
    place = F.pmod(F.shiftright(F.col("pattern"), 1), F.lit(bits))
    pieces = (wanted.select(place.alias("place"))
              .groupBy(F.call_function("bitmap_bucket_number", F.col("place") + 1).alias("piece"))
              .agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("place") + 1)).alias("bits")))
    out = bytearray(bits // 8)
    for r in pieces.toLocalIterator():  # 4 KB a row, bits / 2^15 rows at most
        out[(r["piece"] - 1) * 4096:r["piece"] * 4096] = r["bits"]
    return bytes(out)


def count_places(docs: DataFrame, wanted: DataFrame, text_col: str = "text", bits: int = MAP_BITS) -> DataFrame:
    """``pattern, places``: how often each wanted pattern's two words follow each other in the corpus."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(pattern_map(wanted, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        bitmap = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            for part in slices(batch, "text"):
                hits = []
                for text in part.column("text").to_pylist():
                    words = WORD.findall(text.lower()) if text else []
                    if len(words) < 2:
                        continue
                    if len(known) > 1 << 18:
                        known = {}
                    for w in set(words).difference(known):
                        known[w] = _hash(w)
                    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                    pairs = _pair(h[:-1], h[1:])
                    at = (pairs >> 1) & (bits - 1)
                    hits.append(pairs[(bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1] & ~1)
                found, n = np.unique(np.concatenate([np.zeros(0, np.int64), *hits]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], ["pair", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "pair long, n long")
    places = stored(counted.groupBy("pair").agg(F.sum("n").alias("places")), "pattern-places")
    return (wanted.withColumn("pair", F.col("pattern").bitwiseAND(F.lit(~1))).join(places, "pair", "left")
            .select("pattern", F.coalesce("places", F.lit(0)).alias("places")))


def learn_patterns(docs: DataFrame, mentions: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE,
                   rounds: int = ROUNDS, text_col: str = "text", bits: int = MAP_BITS) -> DataFrame:
    """``pattern, kind, confidence`` of the confident patterns, from the graph of patterns and instances."""
    found = mentions.select(F.explode("mentions").alias("m")).select("m.instance", "m.kind", F.explode("m.patterns").alias("pattern"))
    edges = stored(found.groupBy("pattern", "instance", "kind").agg(F.count(F.lit(1)).alias("n")), "pattern-edges")
    # patterns with enough different seeds of a kind; nothing else can become confident in the first round
    backed = edges.where("kind is not null").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    wanted = stored(backed.where(F.col("seeds") >= min_seeds).select("pattern", "kind"), "backed-patterns")
    places = stored(count_places(docs, wanted.select("pattern").distinct(), text_col, bits), "wanted-patterns")
    # edges of the wanted patterns, once per kind that the pattern is backed for
    beside = stored(edges.withColumnRenamed("kind", "seed").join(wanted, "pattern").join(places, "pattern"), "wanted-edges")
    confident = None
    for _ in range(rounds):
        if confident is None:
            weight = F.when(F.col("seed") == F.col("kind"), F.col("n")).otherwise(0).cast("double")
            scored = beside.withColumn("weight", weight)
        else:
            # the product as a sum of logarithms; a sure pattern counts as nearly sure
            doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(1 - 1e-9))))
            unknown = beside.where("seed is null").join(confident, ["pattern", "kind"])
            scores = stored(unknown.groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score")), "instance-scores")
            scored = beside.join(scores, ["instance", "kind"], "left").withColumn("weight", F.when(
                F.col("seed").isNull(), F.col("n") * F.coalesce("score", F.lit(0.0))).otherwise(
                F.when(F.col("seed") == F.col("kind"), F.col("n")).otherwise(0).cast("double")))
        sums = scored.groupBy("pattern", "kind").agg(F.sum("weight").alias("weight"), F.max("places").alias("places"), F.sum("n").alias("n"))
        confident = stored(sums.select("pattern", "kind", (F.col("weight") / F.greatest("places", "n")).alias("confidence")), "pattern-scores")
    return confident.where(F.col("confidence") >= min_confidence)


def find_personal_data(docs: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, rounds: int = ROUNDS,
                       id_col: str = "doc_id", text_col: str = "text", bits: int = MAP_BITS) -> DataFrame:
    """``id, base, learned`` per input row: arrays of (kind, start, end) in code points, end exclusive. ``base`` holds the
    spans of the fixed patterns by kind as listed, then start; ``learned`` those found by their context, with the kind of
    their surest pattern, in the same order.

    A null text counts as empty, repeated rows get a row each (a repeated text adds mentions, but no new instances), null ids
    stay, other columns are not read, and an empty table gives an empty table. Of kinds that are equally sure, the first
    one listed is taken.
    """
    mentions = read_mentions(docs, id_col, text_col)
    sure = learn_patterns(docs, mentions, min_seeds, min_confidence, rounds, text_col, bits)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    # others come after the base spans in the list of mentions
    unknown = mentions.select("row", F.size("base").alias("skip"), "others", F.posexplode("mentions").alias("at", "m")).where("m.kind is null")
    unknown = unknown.select("row", F.get("others", F.col("at") - F.col("skip")).alias("span"), F.explode("m.patterns").alias("pattern"))
    marked = unknown.join(sure, "pattern").groupBy("row", "span").agg(
        F.max_by("kind", F.struct("confidence", -rank)).alias("kind"))
    learned = marked.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct(rank.alias("rank"), "span.start", "span.end", "kind"))).alias("found"))
    spans = F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return mentions.join(learned, "row", "left").select("id", "base", F.coalesce(
        spans, F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")).alias("learned"))


def span_text(spans: Column, prefix: str = "") -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.concat(F.lit(prefix), s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
