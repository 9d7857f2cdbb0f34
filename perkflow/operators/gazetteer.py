"""Distances by place names from a list of any length.

A name stands in an address if its words stand there in a row, as whole words. Names and addresses are
therefore compared as runs of words: each name is one run, each different address gives its runs of the
lengths that occur among the names, and an equi join brings them together. Of several names in an address
the one that comes first in the list counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkflow.model import ACCENTED, UNACCENTED
from perkflow.sources.scratch import materialise


def place_words(text: Column) -> Column:
    """Words of an address or name, in lower case without accents; none for null."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), ACCENTED, UNACCENTED)
    return F.filter(F.split(plain, r"[^\p{L}\p{N}]+"), lambda word: word != "")


def word_runs(words: Column, lengths: Sequence[int]) -> Column:
    """The different runs of so many words, each as text."""
    runs = [
        F.when(
            F.size(words) >= n,
            F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda at: F.array_join(F.slice(words, at, n), " ")),
        ).otherwise(F.array().cast("array<string>"))
        for n in lengths
    ]
    return F.array_distinct(F.concat(*runs)) if runs else F.array().cast("array<string>")


def place_index(gazetteer: DataFrame) -> DataFrame:
    """_run, n_words, position and _located from rows of (name, position, low_km, high_km).

    A name that is there twice counts at its first position. Names without a word are left out.
    """
    words = place_words(F.col("name"))
    middle = F.round((F.col("low_km") + F.col("high_km")) / 2, 2).cast("double")
    rows = gazetteer.select(
        F.array_join(words, " ").alias("_run"), F.size(words).alias("n_words"), "position", middle.alias("_located")
    ).filter("n_words > 0")
    first = F.min(F.struct("position", "_located")).alias("_first")
    return rows.groupBy("_run", "n_words").agg(first).select("_run", "n_words", "_first.*")


def located_places(hr: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """_place (trimmed address) and _located (km) of each different address that holds a known name.

    Each address is looked up once, however many employees share it. Store the result for
    `commute.with_distance`.
    """
    index = materialise(place_index(gazetteer), "place_index")
    lengths = sorted(row[0] for row in index.select("n_words").distinct().collect())  # lengths of names
    places = hr.select(F.trim("adresse").alias("_place")).filter(F.col("_place").isNotNull()).distinct()
    runs = places.select("_place", F.explode(word_runs(place_words(F.col("_place")), lengths)).alias("_run"))
    found = runs.join(index, "_run").groupBy("_place").agg(F.min(F.struct("position", "_located")).alias("_first"))
    return found.select("_place", "_first._located")
