"""Line dedup: remove every line that a repeated three-line window covers, but in the first place it occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.rows import replace_columns
from docspark.session import materialize

#: Lines per window.
WINDOW = 3
_FAR = 2**31 - 1


def line_windows(docs: DataFrame, text: str = "text", id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Rows (id, version, pos, digest): one per window; version tells texts apart that share an id.

    digest has 128 bits; windows without any letter or sign are left out.
    """
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("version"), F.split(F.col(text), "\n").alias("lines"))
    shifted = [F.slice("lines", k + 1, F.greatest(F.size("lines") - k, F.lit(0))).alias(f"l{k}") for k in range(window)]
    rows = rows.select("id", "version", F.posexplode(F.arrays_zip(*shifted)).alias("pos", "w"))
    rows = rows.filter(F.col(f"w.l{window - 1}").isNotNull())
    line = [F.trim(F.col(f"w.l{k}"), F.lit(" \t\r")) for k in range(window)]
    rows = rows.select("id", "version", "pos", F.concat_ws("\n", *line).alias("w")).filter(F.length("w") >= window)
    return rows.select("id", "version", "pos", F.unhex(F.md5("w")).alias("digest"))


def repeated_windows(docs: DataFrame, text: str = "text", id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Rows (id, version, starts): the windows of each text that occurred before, in an earlier place.

    Places are ordered by id, version and position; a digest's first place and count are summed up
    per task before the shuffle, so one very common window is one row per task. The join back is on
    the digest alone, which Spark splits where one digest owns many rows. The windows are written
    once as a narrow table and read twice.
    """
    windows = materialize(line_windows(docs, text, id, window), "windows")
    place = F.struct("id", "version", "pos")
    first = windows.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    later = windows.join(first.filter(F.col("n") > 1), "digest").filter(place > F.col("first"))
    return later.groupBy("id", "version").agg(F.collect_set("pos").alias("starts"))


def dedup_lines(docs: DataFrame, text: str = "text", id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` cleared of repeated lines, plus n_lines and n_removed (long).

    Lines end at newlines and are compared without blanks, tabs and carriage returns at their ends.
    Every overlapping run of ``window`` lines is hashed; each occurrence after the first one in the
    whole table (by id, then position) covers its lines, covered stretches merge, and covered lines
    go. Windows of blank lines only, and texts with fewer lines than a window, are left alone. Null
    text stays null with 0 lines, empty text stays empty with 1. Rows that repeat an id with the
    same text are one document and are changed alike; with other texts they are documents of their
    own. A null id counts as the lowest. Columns named n_lines or n_removed are replaced.
    """
    starts = repeated_windows(docs, text, id, window).select(F.col("id").alias("_id"), F.col("version").alias("_version"), "starts")
    rows = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), F.xxhash64(text).alias("version"))
    rows = rows.join(starts, F.col("id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left")
    lines = F.split(F.col(f"row.`{text}`"), "\n")
    # covered positions as a bit per line, so that each line costs one lookup
    rows = rows.select("row", lines.alias("lines"), "starts")
    first = F.array_sort("starts")
    ends = F.concat(F.slice(first, 2, F.greatest(F.size(first) - 1, F.lit(0))), F.array(F.lit(_FAR)))
    spans = F.zip_with(first, ends, lambda s, n: F.sequence(s, F.least(s + window, n) - 1))
    rows = rows.select("row", "lines", F.flatten(spans).alias("covered"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "covered")
    new = F.when(F.col("covered").isNull(), F.col(f"row.`{text}`"))
    new = new.otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    out = {
        text: new,
        "n_lines": F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long"),
        "n_removed": F.when(F.col("covered").isNull(), 0).otherwise(F.size("covered")).cast("long"),
    }
    return replace_columns(rows, docs, out)


ORACLE = r"""
WITH lined AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
trimmed AS (SELECT doc_id, lines, list_transform(lines, lambda x: trim(x, ' ' || chr(9) || chr(13))) AS keys FROM lined),
windows AS (
  SELECT doc_id, i AS pos, keys[i] || chr(10) || keys[i + 1] || chr(10) || keys[i + 2] AS w
  FROM (SELECT doc_id, keys, unnest(range(1, len(keys) - 1)) AS i FROM trimmed)
),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS n
  FROM windows WHERE length(replace(w, chr(10), '')) > 0
),
covered AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 3)) AS pos FROM ranked WHERE n > 1),
lists AS (SELECT doc_id, list(pos) AS gone FROM covered GROUP BY doc_id)
SELECT doc_id,
  CASE WHEN gone IS NULL THEN text ELSE
    array_to_string(list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(gone, i)), lambda i: lines[i]), chr(10))
  END AS text,
  CASE WHEN lines IS NULL THEN 0 ELSE len(lines) END::BIGINT AS n_lines,
  coalesce(len(gone), 0)::BIGINT AS n_removed
FROM lined LEFT JOIN lists USING (doc_id)
"""
