"""Licence scans by diagonal voting, in DataFrame operations alone.

All rolling hashes of `k` words of every text join the positions of the same hash in the templates. A match votes for
the diagonal of its text position less its template position, which is where the template would start. Diagonals next
to one another are taken together, since a word put in or left out shifts the rest by one, and the words of the span
are then compared with the template's own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Between words, after A-Z are lower-cased: all ASCII but digits and a-z.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 2
#: Phrases that count wherever their words stand consecutively.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Names and passages of each label of the method itself. A name is there in full and in one piece. Of a passage, one of
#: WHOLE_BELOW words and more, most words are there, and what stands in brackets, which tells licences apart, in one piece.
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction"
    ),
    "mit-notice": "released under the mit license",
    "apache-2.0": [
        "apache license version 2.0",
        "licensed under the [apache license] [version 2.0] the license you may not use this file except in compliance with the license",
    ],
    "gpl-3.0": [
        "gnu general public license version 3",
        "[gnu general public license] as published by the free software foundation either [version 3]",
    ],
    "gpl-2.0": [
        "gnu general public license version 2",
        "[gnu general public license] as published by the free software foundation either [version 2]",
    ],
    "lgpl": "gnu lesser general public license",
    "agpl": "gnu affero general public license",
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met"
    ),
    "mpl-2.0": [
        "mozilla public license version 2.0",
        "mozilla public license v 2.0",
        "this source code form is subject to the terms of the [mozilla public license] v [2.0]",
    ],
    "cc-by-4.0": [
        "licensed under cc by 4.0",
        "this work is licensed under a [creative commons attribution 4.0 international] license",
    ],
    "cc-by-sa-4.0": [
        "licensed under cc by sa 4.0",
        "this work is licensed under a [creative commons attribution sharealike 4.0 international] license",
    ],
    "cc-by-nc-4.0": [
        "licensed under cc by nc 4.0",
        "this work is licensed under a [creative commons attribution noncommercial 4.0 international] license",
    ],
    "creative-commons": "creative commons attribution",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
#: Fewer words than this are a name.
WHOLE_BELOW = 10
#: Hash of the entry that stands for the text itself.
WHOLE = 0


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATOR, text.lower()) if w]


def bracketed(text: str) -> list[list[int]]:
    """Positions of the words of each part in brackets."""
    out, at = [], 0
    for i, part in enumerate(re.split(r"[\[\]]", text)):
        n = len(template_words(part))
        if i % 2 and n:
            out.append(list(range(at, at + n)))
        at += n
    return out


def positions(spark: SparkSession, phrases: dict[str, str], templates: dict[str, str | list[str]]) -> DataFrame:
    """A row (hash, kind, name, no, start, words, must) for every k-gram of the templates and one for the text itself: as many
    as the templates have words."""
    rows = [(None, "text", "", 0, 0, [], [])]
    texts = [("phrase", label, phrase) for phrase, label in phrases.items()]
    texts += [("template", label, text) for label, held in templates.items() for text in ([held] if isinstance(held, str) else held)]
    for no, (kind, label, text) in enumerate(texts):
        words = template_words(text)
        if len(words) < K:
            raise ValueError(f"a template needs {K} words: {text}")
        must = bracketed(text) if kind == "template" else []
        rows += [(words[i : i + K], kind, label, no, i, words, must) for i in range(len(words) - K + 1)]
    made = spark.createDataFrame(rows, "gram array<string>, kind string, name string, no int, start int, words array<string>, must array<array<int>>")
    hashed = F.when(F.col("gram").isNotNull(), gram_hash(F.col("gram")[0], F.col("gram")[1])).otherwise(F.lit(WHOLE).cast("long"))
    return made.select(hashed.alias("hash"), "kind", "name", "no", "start", "words", "must")


def gram_hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def text_words(text: Column) -> Column:
    """Lower-cased words of a text; null has none.

    lower() also changes letters beyond ASCII, but never into a separator, and of these only the Kelvin sign becomes an
    ASCII letter, a k, which no phrase has: words and matches are those of a text with A-Z alone lower-cased.
    """
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def scan_licenses(docs: DataFrame, *, phrases: dict[str, str] | None = None, templates: dict[str, str | list[str]] | None = None, slack: int = 2, least: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    n_base counts the places of `phrases`, first_word and last_word are their smallest and largest start. `spans` lists the
    places of `templates` (label, first word, end word, part of the template's words that stand there in place), where
    diagonals up to `slack` apart count as one place and the part is at least `least`; a name counts in full and in one piece
    alone, and so does what a passage has in brackets. Templates of one label are looked for singly. labels joins the labels of both;
    score is the largest part found, 1 for a phrase, 0 for nothing. Null and empty texts have no words and no labels.
    Ids may be null. Equal rows (id and text) are worked out once and returned as often as they came. Other columns are
    ignored. The broadcast side is the template table, whose size the templates set.
    """
    spark = docs.sparkSession
    table = positions(spark, PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("mark"), text_words(F.col(text).cast("string")).alias("w"))
    known = [r.hash for r in table.where("kind <> 'text'").select("hash").distinct().collect()]  # the templates' own, a fixed few
    size = F.size("w")
    # the join's keys that have no partner are left out while they are still an array, which spares most of the explode
    places = F.when((size >= K) & F.lit(bool(known)), F.filter(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda i: gram_hash(F.get("w", i - 1), F.get("w", i)).isin(known)))
    spread = rows.select("id", "mark", "w", F.explode(F.concat(F.array(F.lit(0)), F.coalesce(places, F.array().cast("array<int>")))).alias("at"))
    spread = spread.withColumn("hash", F.when(F.col("at") == 0, F.lit(WHOLE).cast("long")).otherwise(gram_hash(F.get("w", F.col("at") - 1), F.get("w", F.col("at")))))
    met = spread.join(F.broadcast(table), "hash").where((F.col("kind") == "text") == (F.col("at") == 0))
    begin = F.col("at") - 1 - F.col("start")  # the text's own entry stands at 0, so the first k-gram at 1
    window_start = F.greatest(begin - slack, F.lit(0))
    met = met.select(
        "id", "mark", "kind", "name", "no", "start", "words", "must", begin.alias("diagonal"), F.size("w").cast("long").alias("n_words"),
        F.when(F.col("kind") != "text", F.slice("w", window_start + 1, begin + slack + F.size("words") - window_start)).alias("around"),
        window_start.alias("around_at"),
    )
    template = ["id", "mark", "kind", "name", "no"]
    votes = met.groupBy(*template, "diagonal").agg(
        F.count("*").alias("votes"), F.max("n_words").alias("n_words"), F.max("words").alias("words"), F.max("must").alias("must"),
        F.max("around").alias("around"), F.max("around_at").alias("around_at"),
    )
    # phrases: the words at the diagonal itself
    there = F.slice("around", F.col("diagonal") - F.col("around_at") + 1, F.size("words"))
    exact = (F.col("diagonal") >= 0) & (there == F.col("words"))
    # templates: diagonals next to one another are one place; its words stand where any of them puts them
    order = Window.partitionBy(*template).orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > slack, F.lit(True))
    placed = votes.withColumn("place", F.when((F.col("kind") == "template") & (F.size("words") >= WHOLE_BELOW), F.sum(far.cast("int")).over(order)).otherwise(F.col("diagonal")))
    hits = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: (F.col("diagonal") + i >= 0) & F.coalesce(F.get("around", (F.col("diagonal") + i - F.col("around_at")).cast("int")) == F.get("words", i.cast("int")), F.lit(False)),
    )
    placed = placed.withColumn("hits", F.when(F.col("kind") == "template", hits))
    # numbers of the bracketed parts that stand in one piece at this diagonal
    kept = F.filter(F.transform("must", lambda part, g: F.when(F.forall(part, lambda i: F.array_contains("hits", i)), g)), lambda g: g.isNotNull())
    placed = placed.withColumn("kept", F.when(F.col("kind") == "template", kept))
    places = placed.groupBy(*template, "place").agg(
        F.max("n_words").alias("n_words"), F.max("votes").alias("copies"), F.max(F.size("words")).alias("size"), F.min("diagonal").alias("first"),
        F.max("diagonal").alias("last"), F.max(F.when(F.col("kind") == "phrase", exact)).alias("exact"),
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hit"),
        (F.size(F.array_distinct(F.flatten(F.collect_list("kept")))) == F.max(F.size("must"))).alias("told_apart"),
    )
    share = F.col("hit") / F.col("size")
    needed = F.when(F.col("size") >= WHOLE_BELOW, least).otherwise(1.0)
    is_phrase, is_span = (F.col("kind") == "phrase") & F.col("exact"), (F.col("kind") == "template") & (share >= needed) & F.col("told_apart")
    span = F.struct(F.col("name").alias("label"), F.greatest("first", F.lit(0)).cast("long").alias("first"), (F.col("last") + F.col("size")).cast("long").alias("end"), share.alias("part"))
    found = places.groupBy("id", "mark").agg(
        F.max("n_words").alias("n_words"), F.max(F.when(F.col("kind") == "text", F.col("copies"))).alias("copies"),
        F.count(F.when(is_phrase, 1)).alias("n_base"), F.min(F.when(is_phrase, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(is_phrase, F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_phrase, F.col("name")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_phrase | is_span, F.col("name")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(is_phrase, F.lit(1.0)).when(is_span, F.least(share, F.lit(1.0)))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(is_span, span))).alias("spans"),
    )
    once = found.select(F.col("id").alias(doc_id), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans", "copies")
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies")
