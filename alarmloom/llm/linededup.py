"""Line deduplication over overlapping windows of three consecutive lines.

Blank lines are passed over. A window's two 64-bit hashes find it in the whole corpus; the first
occurrence, by document id, row and place, stays, and all lines that a later occurrence covers
go. Only windows met more than once are joined back, by the hashes, and only line numbers are
gathered per document.

Defined results: null text stays null and has no lines; texts of fewer than three non-blank lines
stay as they are; of repeated rows the first in the table keeps its lines, and the others lose what it
has; a null id comes after all others; an empty table gives an empty table; extra columns pass, and the
count of removed lines takes a name that no column has.
"""

from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.llm import common
from alarmloom.session import stage

WINDOW = 3


def _lines(text_col: str) -> Column:
    return F.split(common.text_or_empty(text_col), "\n", -1)


def windows(
    docs: DataFrame, number: str, id_col: str, text_col: str, size: int = WINDOW
) -> DataFrame:
    """Rows (h1, h2, place, covered): `place` orders all windows, `covered` are line numbers.
    `number` is the column that tells rows apart."""
    numbered = F.transform(
        _lines(f"`{text_col}`"), lambda line, at: F.struct(at.alias("at"), line.alias("line"))
    )
    rows = docs.select(
        F.col(number).alias("row_key"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.filter(numbered, lambda x: F.trim(x["line"]) != "").alias("lines"),
    ).filter(F.size("lines") >= size)

    def window(i):
        parts = [F.get("lines", i + k) for k in range(size)]
        lines = [p["line"] for p in parts]
        return F.struct(
            F.xxhash64(*lines).alias("h1"),
            F.xxhash64(F.lit(1), *reversed(lines)).alias("h2"),
            F.array(*[p["at"] for p in parts]).alias("covered"),
        )

    each = F.transform(F.sequence(F.lit(0), F.size("lines") - size), window)
    spread = rows.select("row_key", "doc_id", F.explode(each).alias("w"))
    return spread.select(
        "w.h1",
        "w.h2",
        F.struct(
            F.col("doc_id").isNull().alias("none"), "doc_id", "row_key",
            F.get("w.covered", F.lit(0)).alias("at"),
        ).alias("place"),
        "w.covered",
    )


def repeated_lines(
    docs: DataFrame, number: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(row_key, removed): number of a row and the line numbers that later occurrences cover."""
    found = stage(windows(docs, number, id_col, text_col), "line-windows")
    firsts = stage(
        found.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min("place").alias("first"))
        .filter("n > 1")
        .drop("n"),
        "line-firsts",
    )
    later = found.join(firsts, ["h1", "h2"]).filter(F.col("place") != F.col("first"))
    covered = later.select(F.col("place.row_key").alias("row_key"), F.explode("covered").alias("at"))
    return covered.groupBy("row_key").agg(F.collect_set("at").alias("removed"))


def deduplicated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count: str = "removed"
) -> DataFrame:
    """All rows and columns, the text without the removed lines, plus their count: `count`, or if a
    column has that name, the first free one of `count`_1, `count`_2 ..."""
    rows, number = common.numbered(docs, "line-rows")
    lines = common.free_name(rows, "lines")
    removed = stage(repeated_lines(rows, number, id_col, text_col), "line-removed")
    removed = removed.withColumnsRenamed({"row_key": number, "removed": lines})
    # The list grows with the texts, so it is never broadcast: one plan at every size.
    joined = rows.join(removed.hint("merge"), number, "left")
    split = _lines(f"`{text_col}`")
    # The difference of two lists of numbers is taken by hash, in the order of the first.
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(lines))
    kept = F.transform(stay, lambda at: F.get(split, at))
    own = F.col(f"`{text_col}`")
    text = F.when(F.col(lines).isNull(), own).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    counted = F.coalesce(F.size(lines), F.lit(0)).alias(common.free_name(docs, count))
    return joined.select(*columns, counted)


def op4_line_dedup(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    # Before the operator removes lines, they are counted; the rows stay those of the files.
    counted = docs.withColumn("n_lines", F.size(_lines("text"))).select(
        "doc_id", "n_lines", "text"
    )
    return deduplicated_lines(counted, count="n_removed").select(
        "doc_id", "n_lines", "n_removed", "text"
    )


OP4_SQL = """
WITH split AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
numbered AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split),
filled AS (SELECT * FROM numbered WHERE trim(line) <> ''),
windows AS (
  SELECT doc_id, place, line,
         lead(line, 1) OVER w AS second, lead(line, 2) OVER w AS third,
         lead(place, 1) OVER w AS place2, lead(place, 2) OVER w AS place3
  FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, place) AS turn
  FROM windows WHERE place3 IS NOT NULL),
covered AS (
  SELECT DISTINCT doc_id, unnest([place, place2, place3]) AS place FROM ranked WHERE turn > 1),
kept AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.place)
           FILTER (c.place IS NULL) AS text,
         CAST(count(c.place) AS INTEGER) AS n_removed
  FROM numbered n LEFT JOIN covered c USING (doc_id, place) GROUP BY n.doc_id)
SELECT s.doc_id, CAST(len(parts) AS INTEGER) AS n_lines, n_removed,
       CASE WHEN s.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM split s JOIN kept k USING (doc_id)
"""
