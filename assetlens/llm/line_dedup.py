"""Corpus-wide line removal: lines whose key occurs in many documents are dropped everywhere.

Two passes. The first explodes lines to 128-bit key hashes, keeps one row per (hash, document) and counts
documents per hash; both aggregations combine map-side, so a line that half of the corpus shares costs one row
per task. The second joins the frequent hashes back to (document, position) rows (a plain sort-merge join, which
AQE splits when one hash is hot), gathers the positions to drop per document and rebuilds the text from the
positions that stay. Line texts are never shuffled; each document's text is, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import hash128, lower_ascii, stored, strip_spaces


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return lower_ascii(strip_spaces(line))


def split_lines(text: Column) -> Column:
    """Lines between ``\\n``; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row_key(id_col: str, text_col: str) -> Column:
    """Null-safe row identity: rows with the same id and text are interchangeable, others are kept apart."""
    doc = F.struct(F.col(id_col).isNull().alias("is_null"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"))
    return F.struct(doc.alias("doc"), F.xxhash64(F.col(text_col)).alias("text"))


def dropped_positions(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row_key, dropped)``: the distinct positions to drop, for every row that loses a line.

    The hashed lines (some 40 bytes each) are stored once, as both passes read them. The frequent hashes are stored
    too: the join then reads them without an aggregation of its own, so that AQE may split the lines of a hot hash.
    """
    lines = stored(
        docs.select(_row_key(id_col, text_col).alias("row_key"),
                    F.posexplode(F.transform(split_lines(F.col(text_col)), line_key)).alias("pos", "key"))
        .where(F.length("key") >= max(min_chars, 1))
        .select("row_key", "pos", hash128(F.col("key")).alias("key")), "line-hashes")
    frequent = stored(lines.select("key", "row_key.doc").distinct()
                      .groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
                      .where(F.col("docs") >= min_docs).select("key"), "frequent-lines")
    return (lines.join(frequent, "key", "left_semi")
            .groupBy("row_key").agg(F.collect_set("pos").alias("dropped")))


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Remove every line whose key is in at least ``min_docs`` documents.

    Returns ``row`` (a struct of the columns of ``docs``, with the text rebuilt, so that no column of the input can
    clash with those added), ``n_lines`` and ``n_dropped``. Documents are counted by id: rows that repeat an id
    count once, rows with a null id count as one document. Keys shorter than ``min_chars`` are never dropped (an
    empty key never is). A null text stays null; a text that loses all its lines becomes empty. An empty table
    gives an empty table.
    """
    drops = dropped_positions(docs, min_docs, min_chars, id_col, text_col)
    joined = (docs.select(_row_key(id_col, text_col).alias("row_key"),
                          F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
              .join(drops, "row_key", "left")
              .select("row", "dropped", split_lines(F.col(f"row.`{text_col}`")).alias("lines")))
    kept_at = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(kept_at, lambda i: F.get(F.col("lines"), i)), "\n")
    return joined.select(
        F.when(F.col("dropped").isNull(), F.col("row")).otherwise(F.col("row").withField(f"`{text_col}`", kept)).alias("row"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
    )
