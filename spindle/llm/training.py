"""A bounded sample of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(id_col: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text, modulo ``folds``, is ``fold``."""
    own = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.encode(own.cast("string"), "UTF-8")), F.lit(folds)) == fold


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text"
) -> list[tuple[str, int]]:
    """At most ``most`` labelled texts of each class (0 and 1), the ones whose hashed
    ids come first, in a fixed order.  This bound is the only limit on training data;
    rows with a null id, text or label are left out, and of an id that occurs in several
    rows the last text in alphabetical order is used, so that at most ``2 * most`` texts
    reach the driver."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(id_col).agg(F.max(label).cast("int").alias("y"))
    mixed = F.xxhash64(F.col(id_col).cast("string"))
    picked = [known.where(F.col("y") == y).orderBy(mixed, id_col).limit(most) for y in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * most rows
    texts = docs.select(id_col, F.col(text_col).alias("t")).where(F.col("t").isNotNull()).join(chosen, id_col)
    rows = texts.groupBy(id_col).agg(F.max("t").alias("t"), F.first("y").alias("y")).collect()  # bounded as above
    rows.sort(key=lambda r: str(r[id_col]))
    return [(r["t"], r["y"]) for r in rows]
