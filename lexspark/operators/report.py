"""How an entity's evidence is shown: a table, no wording of a user interface."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions.text import citation, source_of_reference


def present_evidence(localised: DataFrame, catalog: DataFrame, sources_shown: int = 2, locators_shown: int = 8) -> DataFrame:
    """Per concept: conflict, label class, names of its first sources and how many more, variants, locators.

    localised: concept_id, evidence_status, disposition, source_refs, variants, locators.
    """
    refs = localised.select("concept_id", F.posexplode("source_refs").alias("pos", "ref")).withColumn("id", source_of_reference("ref"))
    first = refs.groupBy("concept_id", "id").agg(F.min("pos").alias("pos"))
    names = catalog.select("id", citation("institution", "authors", "title", "publication_year").alias("label"))
    shown = first.join(names, "id", "left").groupBy("concept_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("label", "id").alias("label")))), lambda x: x["label"]).alias("labels"))
    d = localised.join(shown, "concept_id", "left")
    conflict = (F.col("disposition") == "SOURCE_CONFLICT") | (F.size("variants") > 1)
    label = F.when(conflict, "CONFLICT").when(F.col("evidence_status") == "VERIFIED", "VERIFIED").when(F.col("evidence_status") == "PROVISIONAL_SOURCED", "SOURCED").when(F.col("evidence_status") == "PROVISIONAL_TRANSLATED", "TRANSLATED").otherwise("NONE")
    more = F.greatest(F.coalesce(F.size("labels"), F.lit(0)) - sources_shown, F.lit(0))
    return d.select("concept_id", conflict.alias("conflict"), label.alias("label_class"), F.slice("labels", 1, sources_shown).alias("sources"), more.alias("more_sources"), F.array_sort(F.array_distinct("variants")).alias("variants"), F.slice("locators", 1, locators_shown).alias("locators"))


def truncated_lists(df: DataFrame, keys: Sequence[str], value: str, most: int, order: Sequence[Column] = ()) -> DataFrame:
    """Per keys: the first `most` distinct values in order, how many there are, and how many more than shown.

    Values are ranked, and those beyond `most` dropped, before any list is made; nulls are no values.
    """
    distinct = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    w = Window.partitionBy(*keys).orderBy(*order, F.col(value))
    first = distinct.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= most)
    shown = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", value))), lambda x: x[value]).alias("shown"))
    n = distinct.groupBy(*keys).agg(F.count("*").alias("values"))
    return n.join(shown, list(keys)).select(*keys, "shown", "values", F.greatest(F.col("values") - most, F.lit(0)).alias("more"))
