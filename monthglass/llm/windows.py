"""Line dedup over overlapping windows of three lines.

A text's lines are cut at line feeds; blank ones (white space only) are passed over.
Three successive lines form a window. Of equal windows, anywhere in the table, the
first one by (doc_id, text hash, place) stays; the lines that any later one covers
are removed. What remains keeps its order, and each removed line still stands at an
earlier place.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .batches import small_batches
from .names import fresh

SIZE = 3
BLANK = " \t\r\x0b\x0c"


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, at (the window's number among the text's windows), key, key2."""
    lines = F.filter(F.split(text_col, "\n"), lambda x: F.trim(x, F.lit(BLANK)) != "")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), lines.alias("lines"))
    own = own.where(F.size("lines") >= SIZE)
    starts = F.sequence(F.lit(1), F.size("lines") - F.lit(SIZE - 1))
    parts = lambda i: [F.element_at("lines", i + k) for k in range(SIZE)]
    keyed = F.transform(starts, lambda i: F.struct(F.xxhash64(*parts(i)).alias("key"), F.xxhash64(F.lit(1), *parts(i)).alias("key2")))
    return own.select("doc_id", "text_hash", F.posexplode(keyed).alias("at", "w")).select("doc_id", "text_hash", "at", "w.key", "w.key2")


def later_windows(windows: DataFrame) -> DataFrame:
    """doc_id, text_hash, at of the windows that are not the first of their key.

    Counts and first places are added up before the shuffle, and only keys that occur
    at two places are joined back, each window with one row; a key with very many windows
    is split by the join at run time.
    """
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash", "at")
    first = windows.groupBy("key", "key2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    first = first.select(F.col("key").alias("k"), F.col("key2").alias("k2"), "first")
    both = windows.join(first, (F.col("key") == F.col("k")) & (F.col("key2") == F.col("k2")))
    return both.where(place != F.col("first")).select("doc_id", "text_hash", "at")


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its texts cut, and the columns n_lines, n_removed.

    All other columns stay as they are. Rows that agree in id and text are one document:
    both lose the same lines. Texts with fewer than three non-blank lines have no window
    and stay as they are; so do null texts (n_lines is 0). A text that loses all its lines
    is empty. Ties between documents without id are decided by the text's hash. Columns
    named n_lines or n_removed in the input are replaced.
    """
    windows = stage_table(line_windows(small_batches(docs), id_col, text_col), "windows")
    cut = later_windows(windows).groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("late"))
    ids, hashes, late, made = fresh(docs, "_id", "_hash", "_late", "_made")
    cut = cut.select(F.col("doc_id").alias(ids), F.col("text_hash").alias(hashes), F.col("late").alias(late))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(ids)) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(hashes))
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    out = docs.select([F.col(f"`{c}`") for c in kept_columns]).join(cut, same, "left").drop(ids, hashes)
    out = out.withColumn(made, F.pandas_udf(_cut_text, "text string, n_lines long, n_removed long")(F.col(f"`{text_col}`"), F.col(late)))
    filled = [F.col(made)["text"].alias(c) if c == text_col else F.col(f"`{c}`") for c in kept_columns]
    return out.select(*filled, *[F.col(made)[c].alias(c) for c in ("n_lines", "n_removed")])


def _cut_text(texts: pd.Series, lates: pd.Series) -> pd.DataFrame:
    """Texts without the lines that the windows numbered in `lates` cover; window w covers full lines w to w + 2."""
    out = []
    for text, late in zip(texts, lates):
        if text is None:
            out.append((None, 0, 0))
            continue
        lines = text.split("\n")
        full = np.array([bool(x.strip(BLANK)) for x in lines])
        covered = np.zeros(int(full.sum()), bool)
        if late is not None:
            for k in range(SIZE):
                covered[np.asarray(late, np.int64) + k] = True
        gone = np.zeros(len(lines), bool)
        gone[full] = covered
        kept = text if not gone.any() else "\n".join(x for x, g in zip(lines, gone.tolist()) if not g)
        out.append((kept, len(covered), int(covered.sum())))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])
