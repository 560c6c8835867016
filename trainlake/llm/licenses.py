"""Licence scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

A shingle is two words. Templates are grouped by length; for a group whose longest template
has m words, windows are 2 m words long and m apart, so that each place of a template lies whole
in a window, whose Jaccard similarity with it is then at least (m / 2 - 1) / (2 m - 1), about a quarter.
With bands of one MinHash each, a window and its template meet with probability 1 - (1 - J) ** bands.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts of licence notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "mit": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
}
CONTAINED = 0.9
#: With J of a quarter, 1 - 0.75 ** 32 is above 0.9998.
BANDS = 32


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(found: Column) -> Column:
    """Hashes of all pairs of neighbouring words; of the only word if there is one."""
    n = F.size(found)
    pairs = F.zip_with(F.slice(found, 1, F.greatest(n - 1, F.lit(0))), F.slice(found, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    return F.when(n == 1, F.transform(found, lambda w: F.xxhash64(w))).when(n > 1, pairs).otherwise(F.array().cast("array<bigint>"))


def bands(of: Column) -> Column:
    """Band number and MinHash for each band."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda k: F.struct(k.alias("band"), F.array_min(F.transform(of, lambda h: F.xxhash64(h, k))).alias("least")))


def _templates(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """license, of (distinct shingles), and span: the power of two that its words do not pass."""
    schema = T.StructType([T.StructField("license", T.StringType()), T.StructField("text", T.StringType())])
    given = spark.createDataFrame(sorted(templates.items()), schema).withColumn("words", words(F.col("text"))).filter(F.size("words") > 0)
    span = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.size("words"), F.lit(2))))).cast("int")
    return given.select("license", F.array_distinct(shingles(F.col("words"))).alias("of"), span.alias("span"))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, containment and n_places of every template that a text holds, one row for each row of docs and template.

    docs needs doc_id and text; other columns are not looked at. containment is the largest share of a
    template's shingles in one window, CONTAINED at least; n_places counts the windows (neighbours overlap).
    NULL and empty texts hold nothing. Repeated rows give repeated results, a NULL doc_id stays NULL. Whole texts are read.
    """
    spark = docs.sparkSession
    known = _templates(spark, templates)
    # The set of templates is a parameter of the job: a few rows, none of them from the data.
    listed = known.collect()
    if not listed:
        return spark.createDataFrame([], "doc_id long, license string, containment double, n_places long")
    parts = sorted({h for r in listed for h in r.of})
    spans = sorted({r.span for r in listed})
    every = F.array(*[F.lit(h) for h in parts])
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text").cast("string")).alias("words"))
    hashed = found.select("row", "doc_id", shingles(F.col("words")).alias("hashes"))
    # A window without any shingle of a template has similarity 0 with all: only texts and windows with one are cut and hashed.
    some = hashed.filter(F.arrays_overlap("hashes", every))
    each = some.select("row", "doc_id", "hashes", F.explode(F.array(*map(F.lit, spans))).alias("span"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("hashes"), F.lit(1)), F.col("span"))
    windows = each.select("row", "doc_id", "span", F.posexplode(F.transform(starts, lambda s: F.slice("hashes", s, 2 * F.col("span") - 1))).alias("window", "part"))
    windows = windows.filter(F.arrays_overlap("part", every))
    retrieved = windows.select("row", "doc_id", "span", "window", "part", F.explode(bands(F.col("part"))).alias("b")).select("row", "doc_id", "span", "window", "part", "b.*")
    wanted = known.select("license", "of", "span", F.explode(bands(F.col("of"))).alias("b")).select("license", "of", "span", "b.*")
    met = retrieved.join(F.broadcast(wanted), ["span", "band", "least"])
    share = F.size(F.array_intersect("of", "part")) / F.size("of")
    verified = met.select("row", "doc_id", "license", "window", share.alias("share")).filter(F.col("share") >= CONTAINED)
    return verified.groupBy("row", "doc_id", "license").agg(F.max("share").alias("containment"), F.count_distinct("window").alias("n_places")).drop("row")
