"""License scans by diagonal voting.

Texts become words of letters and digits. All rolling k-grams of a document are named by
hashes and joined with the positions of the same k-grams in license templates. A hit votes
for the diagonal (document position minus template position) it lies on; votes are summed
per document, template and diagonal before the shuffle. Neighbouring diagonals, as words put
in or left out make them, are merged into spans. Spans are then verified word by word against
the template. Short phrases are templates whose every k-gram must lie on one diagonal: these
are the base places. The templates are a fixed, small table; what grows is never broadcast.

Defined results: null text is empty and has no words; rows of equal id are scanned as rows; a phrase
that stands inside another place counts; no label gives an empty string.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodmark.llm.base import keep, query, table
from floodmark.llm.words import U64, encoded, in_slabs, named, windows

# Phrases and their labels (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Openings of public licenses' notices and the labels they stand for (fixed values).
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit-notice": "released under the mit license",
    "apache-2": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

#: Words of a k-gram, of phrases and of templates.
PHRASE_K, TEMPLATE_K = 2, 3
#: Diagonals apart by up to this many words make one span.
GAP = 4
#: Share of a template's k-grams that a span needs, and share of its words that verify it.
LEAST_VOTES, LEAST_WORDS = 0.4, 0.9

_GAPS = np.ones(256, bool)
_GAPS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words, without what is not a letter, a digit or beyond ASCII."""
    return encoded(text).lower().translate(_SPACED).split()


_SPACED = bytes(0x20 if _GAPS[b] else b for b in range(256))


def grams(texts: list[bytes], k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and names of all k-grams of each text."""
    names, first = named(texts, _GAPS)
    for a, b in zip(first[:-1], first[1:], strict=True):
        yield int(b - a), windows(names[a:b], k)


def template_rows(phrases: dict[str, str], templates: dict[str, str]) -> list[tuple[int, int, str, bool, int, int]]:
    """(gram, position, label, is a phrase, k-grams, words) of all templates."""
    out = []
    for texts, phrase, k in ((phrases, True, PHRASE_K), ({v: n for n, v in templates.items()}, False, TEMPLATE_K)):
        for text, label in texts.items():
            ((n, found),) = grams([encoded(text)], k)
            out += [(int(g.astype(np.int64)), p, label, phrase, len(found), n) for p, g in enumerate(_tagged(found, k))]
    return out


def _tagged(found: np.ndarray, k: int) -> np.ndarray:
    return found * U64(2 * k + 1)  # names of different k do not meet


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None
) -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label, first, end, share)."""
    spark = docs.sparkSession
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    known = spark.createDataFrame(template_rows(phrases, templates), "gram long, at int, label string, phrase boolean, n_grams int, n_words int").coalesce(1)
    flat = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # Rows with equal id and text are alike: what is found for one holds for all of them.
    flat = flat.withColumn("key", F.xxhash64("id", "text"))

    def rolling(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            since = 0
            for texts in in_slabs([encoded(t).lower() for t in batch["text"]]):
                out = []
                for (n, two), (_, three) in zip(grams(texts, PHRASE_K), grams(texts, TEMPLATE_K), strict=True):
                    found = np.concatenate([_tagged(two, PHRASE_K), _tagged(three, TEMPLATE_K)]).view(np.int64)
                    out.append((n, len(two), found))
                rows = batch[["key", "id"]].iloc[since : since + len(texts)]
                more = pd.DataFrame(out, columns=["words", "n_two", "grams"], index=rows.index)
                yield pd.concat([rows, more], axis=1)
                since += len(texts)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = flat.mapInPandas(rolling, f"key long, id {kind}, words long, n_two int, grams array<long>")
    places = rows.select("key", "n_two", F.posexplode("grams").alias("place", "gram"))
    hits = places.join(F.broadcast(known), "gram")  # the fixed templates
    position = F.when(F.col("place") < F.col("n_two"), F.col("place")).otherwise(F.col("place") - F.col("n_two"))
    diagonal = (position - F.col("at")).cast("long")
    votes = hits.groupBy("key", "label", "phrase", "n_grams", "n_words", diagonal.alias("diagonal")).agg(
        F.countDistinct("at").alias("votes"), F.min(position).alias("low"), F.max(position).alias("high")
    )
    votes = keep(votes, "diagonals")

    # A repeated row brings its hits again, not other ones; positions are distinct for a diagonal.
    base = votes.where("phrase and votes = n_grams")
    order = Window.partitionBy("key", "label").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order)) > GAP
    merged = votes.where("not phrase").withColumn("run", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order))
    spans = merged.groupBy("key", "label", "run", "n_grams", "n_words").agg(F.sum("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"))
    spans = keep(spans.where(F.col("votes") >= F.ceil(F.col("n_grams") * LEAST_VOTES)), "spans")
    text_of = {label: words_of(text) for label, text in templates.items()}

    @F.pandas_udf("first long, end long, share double")
    def verified(text: pd.Series, label: pd.Series, low: pd.Series, high: pd.Series) -> pd.DataFrame:
        out = []
        for t, name, a, b in zip(text, label, low, high, strict=True):
            want, have = text_of[name], words_of(t)
            a, b = max(0, a - GAP), b + TEMPLATE_K + GAP
            match = [m for m in SequenceMatcher(None, have[a:b], want, autojunk=False).get_matching_blocks() if m.size]
            share = sum(m.size for m in match) / len(want)
            out.append((a + match[0].a, a + match[-1].a + match[-1].size, share) if match else (a, a, 0.0))
        return pd.DataFrame(out, columns=["first", "end", "share"])

    text = flat.select("key", "text").join(spans.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    checked = spans.join(text, "key").select("key", "label", verified("text", "label", "low", "high").alias("v")).select("key", "label", "v.*")
    checked = keep(checked.where(F.col("share") >= LEAST_WORDS), "verified")

    found = base.groupBy("key").agg(
        F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"), F.collect_set("label").alias("base_set")
    )
    own = checked.groupBy("key").agg(
        F.collect_set("label").alias("own_set"),
        F.max("share").alias("share"),
        F.sort_array(F.collect_list(F.struct("first", "end", "label", "share"))).alias("spans"),
    )
    both = keep(found.join(own, "key", "full"), "found")
    words = flat.select("key", "id", _count(F.col("text")).alias("n_words"))
    none = F.array().cast("array<string>")
    base_set, own_set = F.coalesce("base_set", none), F.coalesce("own_set", none)
    return words.join(both, "key", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(F.array_sort(base_set), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_set, own_set)), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.coalesce("share", F.lit(0.0))).alias("score"),
        "spans",
    )


def _count(text):
    """Number of words: a word starts where a word byte follows another byte."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        counts = [np.diff(named(some, _GAPS)[1]) for some in in_slabs([encoded(t).lower() for t in texts])]
        return pd.Series(np.concatenate(counts) if counts else [], dtype="int64")

    return count(text)


@query()
def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan(table(spark, sf, "documents"))
