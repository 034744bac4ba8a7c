"""License scans: phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm.common import lower_ascii, whole, written

#: Phrases of words, and their labels: fixed values.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Statements that announce a license, and their labels. A block of text is compared with each as a set of words.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike license"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced without permission"),
]
CONTAINMENT = 0.8

#: All characters that end a word: ASCII but for digits and small letters, after lower-casing A-Z.
_GAP = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
_GAP_IN_LINE = r"\x00-\x09\x0B\x0C\x0E-\x2F\x3A-\x60\x7B-\x7F"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def phrase_scan(text: Column, phrases: dict[str, str]) -> dict[str, Column]:
    """n_words, n_base, first_word, last_word and base_labels of a text.

    The text is brought to the form " w0 w1 ... " and split before each place
    where a phrase stands; the parts then hold the numbers of words between.
    """
    joined = F.regexp_replace(F.concat(F.lit(" "), text, F.lit(" ")), f"[{_GAP}]+", " ")
    places = "|".join(sorted(phrases, key=len, reverse=True))
    parts = F.split(joined, f"(?<= )(?=(?:{places}) )")
    count = lambda part: F.length(part) - F.length(F.translate(part, " ", ""))
    n_words = (count(joined) - 1).cast("long")
    n_base = (F.size(parts) - 1).cast("long")
    labels = F.array_compact(
        F.array(*[F.when(F.contains(joined, F.lit(f" {p} ")), F.lit(label)) for p, label in phrases.items()])
    )
    return {
        "n_words": n_words,
        "n_base": n_base,
        "first_word": F.when(n_base > 0, (count(F.element_at(parts, 1)) - 1).cast("long")),
        "last_word": F.when(n_base > 0, n_words - count(F.element_at(parts, -1))),
        "base_labels": F.array_sort(F.array_distinct(labels)),
    }


def similar_blocks(blocks: DataFrame, templates: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """All pairs of a block and a template with at least `containment` of the template's words in the block.

    blocks: row, block, words (array of distinct words; words that no template
    has may be left out); templates: template, words. Returns row, block,
    template, share. Exact: a template of n words needs o = ceil(containment * n)
    common words. With words in ascending order of their frequency over all
    blocks, both the template's first n - o + 1 words and the block's first
    m - o + 1 hold a common one (prefix), m >= o (length), and from the places
    i, j of the first common word, min(n - i, m - j) >= o (position).
    The templates are a bounded list, and so are their words and the counts of
    those; a frequent word has one count per task before the shuffle.
    """
    vocabulary = templates.select(F.explode("words").alias("word")).distinct()
    seen = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = vocabulary.join(seen, "word", "left").fillna(0, ["n"]).collect()  # a row per word of the templates
    place = {r["word"]: i for i, r in enumerate(sorted(counts, key=lambda r: (r["n"], r["word"])))}
    if not place:
        return blocks.select("row", "block", F.lit(0).alias("template"), F.lit(0.0).alias("share")).limit(0)
    places = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])
    ordered = F.array_sort(F.transform("words", lambda w: places[w]))
    sets = templates.select("template", ordered.alias("theirs"), F.size("words").alias("n"))
    sets = sets.withColumn("o", F.greatest(F.ceil(F.col("n") * F.lit(containment) - 1e-9), F.lit(1)).cast("int"))
    prefix = sets.select("*", F.posexplode(F.slice("theirs", F.lit(1), F.col("n") - F.col("o") + 1)).alias("i", "word"))
    least = sets.agg(F.min("o").alias("o")).first()["o"]
    own = blocks.filter(F.size("words") >= least).select("row", "block", ordered.alias("ours"))
    tokens = own.select("row", "block", "ours", F.posexplode(F.slice("ours", F.lit(1), F.size("ours") - least + 1)).alias("j", "word"))
    m = F.size("ours")
    meets = (F.col("j") <= m - F.col("o")) & (F.least(F.col("n") - F.col("i"), m - F.col("j")) >= F.col("o"))
    pairs = tokens.join(F.broadcast(prefix), "word").filter(meets)
    common = F.size(F.array_intersect("ours", "theirs"))
    found = pairs.withColumn("common", common).filter(F.col("common") >= F.col("o"))
    return found.select("row", "block", "template", (F.col("common") / F.col("n")).alias("share")).distinct()


def license_scan(
    docs: DataFrame, phrases: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None,
    containment: float = CONTAINMENT, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of digits, a-z (A-Z is lowered) and characters beyond ASCII.
    n_base: places where a phrase's words stand one after the other, overlaps
    included. labels adds those of templates that a block of the text, which is
    a line, contains by at least `containment`. score: 1 if a phrase stands in
    the text, else the largest such share, else 0. Null texts are empty: no
    words, null first_word and last_word, no labels, score 0. Repeated rows and
    ids give a row each; an empty table none; other columns are ignored.

    The text is read once; a narrow table keeps, per document, the base columns
    and for each line the words that some template has.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    sets = [sorted(set(words.split())) for _, words in templates]
    vocabulary = sorted({w for s in sets for w in s})
    least = max(1, min((math.ceil(containment * len(s) - 1e-9) for s in sets), default=1))
    lowered = lower_ascii(whole(text))
    lines = F.split(F.regexp_replace(lowered, f"[{_GAP_IN_LINE}]+", " "), r"[\n\r]+")
    known = lambda line: F.array_distinct(F.filter(F.split(line, " "), lambda w: w.isin(*vocabulary)))
    blocks = F.filter(F.transform(lines, known), lambda words: F.size(words) >= least)
    base = phrase_scan(lowered, phrases)
    scanned = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *[c.alias(n) for n, c in base.items()], blocks.alias("blocks"))
    scanned = written(scanned.withColumn("row", F.monotonically_increasing_id()), "license-blocks")
    spark = docs.sparkSession
    listed = _template_table(spark, sets)
    exploded = scanned.select("row", F.posexplode("blocks").alias("block", "words"))
    found = similar_blocks(exploded, listed, containment)
    names = F.array(*[F.lit(label) for label, _ in templates])
    by_row = found.groupBy("row").agg(
        F.collect_set(F.element_at(names, F.col("template") + 1)).alias("more"), F.max("share").alias("share")
    )
    rows = scanned.drop("blocks").join(by_row, "row", "left")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )


def _template_table(spark: SparkSession, sets: list[list[str]]) -> DataFrame:
    rows = spark.range(1).select(
        F.posexplode(F.array(*[F.array(*[F.lit(w) for w in s]) for s in sets])).alias("template", "words")
    )
    return rows
