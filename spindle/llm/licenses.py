"""License scans by diagonal voting, with DataFrame functions only.

Every run of three words of a text is hashed, and the runs whose hash is one of the license
templates' (a fixed table) are joined with the templates' positions.  A match at text word p
and template word t votes for the diagonal p - t.  Votes of one diagonal are counted,
neighbouring diagonals of a template are merged (words left out or put in), and a span stands
if its votes cover enough of the template.  Of templates that begin at the same word the
fullest wins.  Matches are verified word by word before they vote, so equal hashes of
different words do not count.  Exact phrases need all votes of one diagonal.

Runs are hashed and looked up within the text's row, and only hits become rows, so the time
grows in proportion to a text's length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases whose places are counted exactly, and their labels (fixed values).
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Notices in common use, as words, and their labels (fixed values).
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("gnu general public license as published by the free software foundation either version 3 of the license", "gpl-3"),
    ("gnu general public license as published by the free software foundation either version 2 of the license", "gpl-2"),
    ("gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("gnu affero general public license as published by the free software foundation", "agpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("dedicated to the public domain under the cc0 1 0 universal", "cc0"),
)


def template_grams(spark: SparkSession, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row per template position: its hash, words, and the template's size."""
    rows = []
    for i, (text, label) in enumerate([*phrases, *templates]):
        words = text.split()
        size = len(words) - K + 1
        if size < 1:
            raise ValueError(f"fewer than {K} words: {text}")
        rows += [(i, t, size, i < len(phrases), label, *words[t : t + K]) for t in range(size)]
    names = "template int, tpos int, size int, exact boolean, label string, " + ", ".join(f"w{j} string" for j in range(K))
    own = spark.createDataFrame(rows, names)
    return own.withColumn("gram", F.xxhash64(*(f"w{j}" for j in range(K))))


def words(text) -> F.Column:
    """The words of a text column: A-Z lowered, split at all other ASCII signs."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def scan(
    docs: DataFrame, least: float = 0.8, slack: int = 2, id_col: str = "doc_id", text_col: str = "text",
    phrases=PHRASES, templates=TEMPLATES,
) -> DataFrame:
    """``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score`` per
    row of ``docs``.

    ``least``: share of a template's word runs that its merged diagonals must match;
    ``slack``: distance of diagonals that merge.  A null or empty text has no words, no
    labels and score 0; repeated rows give repeated results; an empty table gives none.  A
    long text is one row, as it is in ``docs``; its time is linear in its length."""
    grams = template_grams(docs.sparkSession, phrases, templates)
    known = F.broadcast(grams)  # fixed size
    wanted = sorted({r["gram"] for r in grams.select("gram").collect()})  # one number per template word
    own = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), words(F.col(text_col)).alias("words")
    )
    later = [f"get(words, i + {j})" for j in range(1, K)]
    hashed = own.withColumn("grams", F.expr(f"transform(words, (w, i) -> xxhash64(w, {', '.join(later)}))"))
    places = F.when(F.size("grams") > 0, F.sequence(F.lit(0), F.size("grams") - 1)).otherwise(F.array().cast("array<int>"))
    hit = F.filter(places, lambda i: F.get("grams", i).isin(wanted))
    each = F.transform(hit, lambda i: F.struct(i.alias("pos"), F.get("grams", i).alias("gram"), F.slice("words", i + 1, K).alias("run")))
    # The last entry, without a hash, stands at position n_words and keeps the row.
    end = F.struct(F.size("words").alias("pos"), F.lit(None).cast("long").alias("gram"), F.lit(None).cast("array<string>").alias("run"))
    each = hashed.select("row", "id", F.explode(F.concat(each, F.array(end))).alias("e")).select("row", "id", "e.*")
    same = " and ".join(f"get(run, {j}) = w{j}" for j in range(K))
    hits = each.join(known, "gram", "left").where(f"gram is null or (template is not null and {same})")
    hits = hits.select("row", "id", "pos", "template", "tpos", "size", "exact", "label", (F.col("pos") - F.col("tpos")).alias("diagonal"))
    by_row = hits.repartition("row")
    votes = by_row.groupBy("row", "template", "diagonal").agg(
        F.first("id").alias("id"), F.first("size").alias("size"), F.first("exact").alias("exact"), F.first("label").alias("label"),
        F.count("*").alias("votes"), F.max("pos").alias("pos"),
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("exact"), 0).otherwise(slack), F.lit(True))
    runs = votes.withColumn("run", F.sum(gap.cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("row", "template", "run").agg(
        F.first("id").alias("id"), F.first("exact").alias("exact"), F.first("label").alias("label"), F.max("pos").alias("pos"),
        F.min("diagonal").alias("at"), F.least(F.lit(1.0), F.sum("votes") / F.first("size")).alias("share"),
    )
    best = F.max(F.when(~F.col("exact"), F.col("share"))).over(Window.partitionBy("row", "at"))
    spans = spans.withColumn("best", best)
    base = F.col("exact") & (F.col("share") == 1.0)
    labelled = base | (~F.col("exact") & (F.col("share") >= least) & (F.col("share") == F.col("best")))
    listed = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(F.when(c, F.col("label")))))
    out = spans.groupBy("row").agg(
        F.first("id").alias(id_col),
        F.max(F.when(F.col("template").isNull(), F.col("pos"))).cast("long").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("at"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("at"))).cast("long").alias("last_word"),
        listed(base).alias("base_labels"),
        listed(labelled).alias("labels"),
        F.coalesce(F.max(F.when(labelled | ~F.col("exact"), F.col("share"))), F.lit(0.0)).alias("score"),
    )
    return out.drop("row")
