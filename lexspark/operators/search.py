"""Substring search over term keys, one query or many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions.text import fold_key
from lexspark.operators.topk import first_k


def search(terms: DataFrame, query: str, limit: int = 80, by_length: bool = True, default: Sequence[str] = ()) -> DataFrame:
    """Entities (concept_id, display_name, pos, keys) with a key that contains the folded query: shortest name first, then input order.

    by_length False: in input order. An empty query gives the default list: for each of its names, in
    its order, the first entity that has that name as a key; none without a list.
    """
    if not query.strip():
        return default_list(terms, default)
    q = fold_key(F.lit(query))
    hit = (q != "") & F.exists("keys", lambda k: F.contains(k, q))
    order = [F.length("display_name"), F.col("pos")] if by_length else [F.col("pos")]
    return terms.filter(hit).orderBy(*order).limit(limit).select("concept_id", "display_name", "pos")


def default_list(terms: DataFrame, names: Sequence[str]) -> DataFrame:
    """The first entity, in input order, of each name, in the order of the names; names without an entity are left out."""
    wanted = terms.sparkSession.createDataFrame(list(enumerate(names)), "_at int, _name string").withColumn("_key", fold_key("_name"))
    met = terms.select("concept_id", "display_name", "pos", F.explode("keys").alias("_key")).join(F.broadcast(wanted), "_key")
    first = met.groupBy("_at").agg(F.min(F.struct("pos", "concept_id", "display_name")).alias("f"))
    return first.orderBy("_at").select("f.concept_id", "f.display_name", "f.pos")


def grams(c, n: int = 3):
    """Distinct substrings of n characters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substr(c, i, F.lit(n))))


def batch_search(terms: DataFrame, queries: DataFrame, limit: int = 80, n: int = 3) -> DataFrame:
    """Per query_id the first hits: (query_id, rank, concept_id, display_name).

    terms: concept_id, display_name, pos, key. queries: query_id, query. Each distinct query meets
    each distinct key once, by its rarest gram in the keys, an equi-join, and is then confirmed: of
    n characters, or all of its own if it is shorter. A key stands for its first `limit` terms,
    among which are all that a query can show of it, so neither terms of one name nor queries of
    one text make rows for their pairs.
    """
    order = [F.length("display_name"), F.col("pos"), F.col("concept_id")]
    asked = queries.select("query_id", fold_key("query").alias("q")).filter("q <> ''")
    q = asked.select("q").distinct()
    heads = first_k(terms.select("key", "concept_id", "display_name", "pos").distinct(), ["key"], order, limit).drop("rank")
    sized = lambda c, k: F.filter(grams(c, k), lambda g: F.length(g) == k)
    every = F.array_distinct(F.concat(*[F.when(F.length("key") >= k, sized(F.col("key"), k)).otherwise(F.array().cast("array<string>")) for k in range(1, n + 1)]))
    index = terms.select("key").distinct().select("key", F.explode(every).alias("g"))
    wanted = None
    for k in range(1, n + 1):
        wanted = F.when(F.length("q") == k, sized(F.col("q"), k)) if wanted is None else wanted.when(F.length("q") == k, sized(F.col("q"), k))
    q_grams = q.select("q", F.explode(wanted.otherwise(sized(F.col("q"), n))).alias("g"))
    index = index.join(q_grams.select("g").distinct(), "g", "left_semi")
    rarest = q_grams.join(index.groupBy("g").count(), "g", "left").groupBy("q").agg(F.min_by("g", F.struct(F.coalesce("count", F.lit(0)), "g")).alias("g"))
    met = rarest.join(index, "g").filter(F.contains("key", F.col("q"))).select("q", "key")
    best = met.join(heads, "key").select("q", "concept_id", "display_name", "pos").distinct()
    # Ranked in parts first: a query of one letter has hits without number.
    top = first_k(best, ["q"], order, limit)
    return asked.join(top, "q").select("query_id", "rank", "concept_id", "display_name")


def visible(df: DataFrame, categories: Sequence[str], ids: Sequence[str], isolate: bool = False, category: str = "category", key: str = "id") -> DataFrame:
    """Rows of the categories or with the ids; isolated, those with the ids alone."""
    chosen = F.col(key).isin(list(ids))
    return df.filter(chosen if isolate else chosen | F.col(category).isin(list(categories)))
