"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

Texts are lower-cased and cut into words of letters and digits; a shingle is five words. A text is covered by windows of
``WINDOW`` shingles, one every ``STRIDE``; a template is covered by all its windows of that many shingles (shorter
templates by one window). Each window has one minimum per band, under ``BANDS`` permutations (xor with evenly spread
constants of a 64-bit hash), and is retrieved when it shares a (band, minimum) with a template window. A window that holds
a whole short template of one shingle has a Jaccard similarity of at least 1/4, so with one row per band it is missed with
a chance of at most 0.75^32 = 0.0001; two shingles or more lie below 0.5^32. Copies of four shingles or more contain equal
windows, which always collide.

Retrieved windows give hits: shingles that the template holds too, compared by their 64-bit hashes. Hits of a template closer than the
template is long form a stretch; a stretch counts when it holds at least ``CONTAINMENT`` of the template's shingles.

Templates are a fixed list of at most ``MAX_TEMPLATES``, so their bands fit into literals of the plan.

Defined cases: null, blank and short texts have no shingles and no matches; every row is a text of its
own, so repeated ids (null included) report once a row; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailframe.llm.common import let, whole

SHINGLE = 5
WINDOW, STRIDE = 4, 2
BANDS = 32
CONTAINMENT = 0.8
MAX_TEMPLATES = 500
BREAK = r"[^\p{L}\p{N}]+"

#: Names and wording of public license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files, to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the "
                         "License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                      "or (at your option) any later version.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def constants() -> list[int]:
    """One 64-bit constant per band, spread evenly by multiples of the golden ratio."""
    step = 0x9E3779B97F4A7C15
    return [((k * step + (1 << 63)) % (1 << 64)) - (1 << 63) for k in range(BANDS)]


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(whole(text)), BREAK), "")


def shingle_hashes(words: Column) -> Column:
    made = F.transform(words, lambda x, i: F.xxhash64(x, *[F.get(words, i + j) for j in range(1, SHINGLE)]))
    return F.slice(made, F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0)))


def minima(hashes: list[Column]) -> list[Column]:
    """The minimum of each band; absent shingles are null."""
    return [F.least(*[h.bitwiseXOR(F.lit(c)) for h in hashes]) for c in constants()]


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(template, words, hashes) of a bounded list."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    rows = spark.createDataFrame([(k, v) for k, v in templates.items()], "template string, text string")
    return rows.select("template", split_words(F.col("text")).alias("words")).select(
        "template", "words", let(F.col("words"), shingle_hashes).alias("hashes"))


def template_bands(templates: DataFrame) -> DataFrame:
    """Distinct (band, minimum, template) over all windows of all templates."""
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("hashes") - WINDOW, F.lit(0))))
    windows = templates.filter(F.size("hashes") > 0).select("template", "hashes", starts.alias("at"))
    pieces = [F.get("hashes", F.col("at") + i) for i in range(WINDOW)]
    return windows.select("template", F.posexplode(F.array(*minima(pieces))).alias("band", "low")).distinct()


def retrieve(docs: DataFrame, bands: DataFrame) -> DataFrame:
    """(row, doc_id, template, at, h0..) of text windows that share a band with a template window.

    A shared minimum is a shingle of both, so windows without any template minimum are put aside before their bands are
    computed; this loses none.
    """
    lows = {(r["band"], r["low"]) for r in bands.select("band", "low").distinct().collect()}  # bounded by MAX_TEMPLATES
    known = sorted({low ^ constants()[band] for band, low in lows})
    hashed = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), let(split_words(F.col("text")), shingle_hashes).alias("h0"))
    shifted = [F.slice("h0", i + 1, F.size("h0")).alias(f"h{i}") for i in range(1, WINDOW)]
    cells = hashed.filter(F.size("h0") > 0).select("row", "doc_id", F.posexplode(F.arrays_zip("h0", *shifted)).alias("at", "w"))
    cells = cells.filter(F.col("at") % STRIDE == 0).select("row", "doc_id", "at", *[F.col(f"w.h{i}").alias(f"h{i}") for i in range(WINDOW)])
    touched = F.lit(False)
    for i in range(WINDOW):
        touched = touched | F.col(f"h{i}").isin(known)
    touching = cells.filter(F.coalesce(touched, F.lit(False))).repartition("row")
    marks = F.posexplode(F.array(*minima([F.col(f"h{i}") for i in range(WINDOW)]))).alias("band", "low")
    names = [f"h{i}" for i in range(WINDOW)]
    return touching.select("row", "doc_id", "at", *names, marks).join(F.broadcast(bands), ["band", "low"]).select(
        "row", "doc_id", "template", "at", *names).distinct()


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per stretch of a document that contains a template."""
    spark = docs.sparkSession
    known = template_table(spark, TEMPLATES if templates is None else templates)
    found = retrieve(docs, template_bands(known))
    shingles = found.select("row", "doc_id", "template", "at", F.posexplode(F.array(*[F.col(f"h{i}") for i in range(WINDOW)])).alias("i", "shingle"))
    shingles = shingles.select("row", "doc_id", "template", (F.col("at") + F.col("i")).alias("pos"), "shingle")
    own = known.select("template", F.explode(F.array_distinct("hashes")).alias("shingle"))
    own = own.withColumn("total", F.count(F.lit(1)).over(W.partitionBy("template")))
    hits = shingles.join(F.broadcast(own), ["template", "shingle"]).distinct()
    ordered = W.partitionBy("row", "template").orderBy("pos")
    far = F.coalesce(F.col("pos") - F.lag("pos").over(ordered) > F.col("total"), F.lit(True))
    stretches = hits.withColumn("far", far.cast("int")).withColumn("stretch", F.sum("far").over(ordered))
    return (stretches.groupBy("row", "doc_id", "template", "stretch")
            .agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count_distinct("shingle").alias("matched"),
                 F.first("total").alias("total"))
            .filter(F.col("matched") * 10 >= F.col("total") * int(CONTAINMENT * 10))
            .select("doc_id", "template", F.col("first").cast("long").alias("start_word"),
                    (F.col("last") + SHINGLE).cast("long").alias("end_word"), F.col("matched").cast("long").alias("matched"),
                    F.col("total").cast("long").alias("shingles")))


def _oracle() -> str:
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
    later = ", ".join(f"lead(x, {j}) OVER o AS x{j}" for j in range(1, SHINGLE))
    five = "x || ' ' || " + " || ' ' || ".join(f"x{j}" for j in range(1, SHINGLE))

    def shingles(key: str, source: str) -> str:
        return (f"SELECT {key}, p - 1 AS pos, {five} AS s FROM (SELECT {key}, p, x, {later} FROM "
                f"(SELECT {key}, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM {source}) "
                f"WINDOW o AS (PARTITION BY {key} ORDER BY p)) WHERE x{SHINGLE - 1} IS NOT NULL")

    return f"""
WITH t AS (
  SELECT template, list_filter(regexp_split_to_array(lower(x), '{BREAK}'), lambda s: s <> '') AS w FROM (VALUES {rows}) v(template, x)),
ts AS (
  SELECT DISTINCT template, s FROM ({shingles('template', 't')})),
tot AS (
  SELECT template, count(*) AS total FROM ts GROUP BY template),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{BREAK}'), lambda s: s <> '') AS w FROM documents),
ds AS (
  {shingles('doc_id', 'd')}),
hits AS (
  SELECT DISTINCT doc_id, template, pos, s, total FROM ds JOIN ts USING (s) JOIN tot USING (template)),
far AS (
  SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id, template ORDER BY pos) <= total THEN 0 ELSE 1 END AS far FROM hits),
st AS (
  SELECT *, sum(far) OVER (PARTITION BY doc_id, template ORDER BY pos) AS stretch FROM far)
SELECT doc_id, template, min(pos) AS start_word, max(pos) + {SHINGLE} AS end_word, count(DISTINCT s) AS matched,
  any_value(total) AS shingles FROM st
GROUP BY doc_id, template, stretch HAVING count(DISTINCT s) * 10 >= any_value(total) * {int(CONTAINMENT * 10)}
"""


ORACLE = _oracle()
