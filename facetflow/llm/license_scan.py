"""License notices by diagonal voting.

Every run of three words of a document is joined to the places where templates
have it. A match votes for the diagonal "place in the document minus place in the
template"; votes are summed per diagonal, neighbouring diagonals (words put in or
left out) are merged into spans, and a span is verified: it counts by the different
places of its template that stand in it, however often each does.
DataFrame functions only; templates are a fixed list and broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 3
#: Share of a template's word runs that a span must hold.
LEAST_SCORE = 0.8
#: Words that may be put in or left out between two pieces of one notice.
DRIFT = 3

# Phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Wordings from public licenses and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2 0": "mpl-2",
    "licensed under the mit license": "mit",
    "released under the mit license": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "creative commons attribution 4 0 international license": "cc-by",
    "creative commons attribution sharealike 4 0 international license": "cc-by-sa",
}

#: Everything that isn't a word, once A-Z are lower-cased.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text whose A-Z are lower-cased; null counts as empty.

    ``lower`` takes other letters with it, which moves no word boundary; the only
    other letter that would become one of a-z, the Kelvin sign, is put aside.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    return F.array_remove(F.split(plain, NO_WORD), "")


def _templates(spark: SparkSession) -> DataFrame:
    """Every word run of every template with its place; the empty run marks a row."""
    rows = [(-1, "", False, 1, 0, "")]
    for number, (text, label) in enumerate([*BASE.items(), *NOTICES.items()]):
        w = re.sub(NO_WORD, " ", text).split()
        runs = len(w) - GRAM + 1
        rows += [(number, label, number < len(BASE), runs, at, " ".join(w[at : at + GRAM])) for at in range(runs)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, runs int, at int, t_run string")


def votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Votes per document, template and diagonal; template -1 has one row per document.

    ``held`` marks the places of the template that voted, one bit each, so a
    template has 63 runs at most.

    A document is a pair of id and text: ``id``, ``digest`` (of the text),
    ``n_words``; rows that repeat it add to ``votes``.
    """
    read = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"), words(F.col(text_col)).alias("w"))
    last = F.size("w") - GRAM
    runs = F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat_ws(" ", *(F.get("w", i + k) for k in range(GRAM))))
    ).otherwise(F.array().cast("array<string>"))
    placed = read.select("id", "digest", F.size("w").cast("long").alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), runs)).alias("place", "run"))
    templates = F.broadcast(_templates(docs.sparkSession).withColumn("t_hash", F.xxhash64("t_run")))
    hits = placed.join(templates, (F.xxhash64("run") == F.col("t_hash")) & (F.col("run") == F.col("t_run")))
    word = F.col("place").cast("long") - 1
    hits = hits.select("id", "digest", "n_words", "template", "label", "base", "runs", (word - F.col("at")).alias("diagonal"), word.alias("word"), F.expr("shiftleft(1L, at)").alias("held"))
    return hits.groupBy("id", "digest", "n_words", "template", "label", "base", "runs", "diagonal").agg(
        F.count("*").alias("votes"), F.min("word").alias("first"), F.max("word").alias("last"), F.bit_or("held").alias("held")
    )


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans per document and template, and for each document one row of template -1.

    ``copies`` says how often the row occurs, ``score`` which share of the
    template's runs the span holds, each counted once, ``places`` how many of its
    diagonals hold all.
    """
    by_document = votes(docs, id_col, text_col).repartition("id", "digest")
    whole = Window.partitionBy("id", "digest")
    counted = by_document.withColumn("copies", F.max(F.when(F.col("template") == -1, F.col("votes"))).over(whole))
    line = Window.partitionBy("id", "digest", "template").orderBy("diagonal")
    back, end = F.lag("diagonal").over(line), F.lag("last").over(line)
    near = (F.col("diagonal") - back <= DRIFT) & (F.abs(F.col("first") - end) <= F.col("runs") + GRAM)
    marked = counted.withColumn("new", F.when(near, 0).otherwise(1))
    marked = marked.withColumn("span", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    votes_once = F.col("votes") / F.col("copies")
    return marked.groupBy("id", "digest", "n_words", "copies", "template", "label", "base", "runs", "span").agg(
        (F.bit_count(F.bit_or("held")) / F.first("runs")).alias("score"),
        F.sum((votes_once >= F.col("runs")).cast("long")).alias("places"),
        F.min(F.when(votes_once >= F.col("runs"), F.col("diagonal"))).alias("first_place"),
        F.max(F.when(votes_once >= F.col("runs"), F.col("diagonal"))).alias("last_place"),
        F.min("first").alias("first_word"),
        (F.max("last") + GRAM - 1).alias("last_word"),
    )


def _labels(which: Column) -> Column:
    """Distinct labels in order, comma-joined."""
    return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """One row per document: places of the base phrases, labels and the best score.

    Base phrases count where all their words stand in a row. ``labels`` are those
    of spans with ``least_score`` or more and of base places, ``score`` is the
    best share found (0 without any). Null and empty texts have no words and no
    labels; a null id stays null; repeated rows come back as often as they occur;
    empty input gives no rows; other columns are not read.
    """
    found = spans(docs, id_col, text_col)
    base = F.col("base") & (F.col("places") > 0)
    real = F.col("template") >= 0
    rows = found.groupBy("id", "digest", "n_words", "copies").agg(
        F.sum(F.when(F.col("base"), F.col("places")).otherwise(0)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_place"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("last_place"))).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(base | (real & (F.col("score") >= least_score))).alias("labels"),
        F.coalesce(F.max(F.when(real, F.col("score"))), F.lit(0.0)).alias("score"),
    )
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
