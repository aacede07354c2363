"""Registered queries of one patch set over four tables that parts make."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexspark.operators import integrate
from lexspark.operators.integrate import Integration, Rules
from lexspark.plans.queries import query, read
from lexspark.sources.io import shared_path
from lexspark.sources.versions import TableSet

LOOSE = "status = 'PROVISIONAL'"
HOW = Integration({"records": Rules(evidence=LOOSE), "generated": Rules(evidence=LOOSE), "catalog": Rules(), "quality": Rules(drift=False)})
TABLES_SQL = """records AS (SELECT p_partkey AS concept_id, p_name AS "pivot", p_brand AS target, CASE WHEN p_type = 'PROMO' THEN 'VERIFIED' ELSE 'PROVISIONAL' END AS status FROM part),
generated AS (SELECT concept_id, "pivot", CASE WHEN p_size = 30 THEN 'other' ELSE target END AS target, status FROM records JOIN part ON p_partkey = concept_id WHERE p_size <= 45),
catalog AS (SELECT concept_id, CASE WHEN p_size = 20 THEN upper("pivot") ELSE "pivot" END AS "pivot", target, status FROM records JOIN part ON p_partkey = concept_id WHERE p_size >= 3),
quality AS (SELECT concept_id, "pivot", p_type AS target, status FROM records JOIN part ON p_partkey = concept_id WHERE p_retailprice > 950)"""
#: A column's sum less a limit a row, exact: an average of doubles at the limit lies on a side that the order of its rows decides.
ABOVE = "sum(CAST({c} AS DECIMAL(18, 6))) - CAST({limit} AS DECIMAL(18, 6)) * count({c})"
MANY, TAXED, UNTAXED, CHEAP = (ABOVE.format(c=c, limit=limit) for c, limit in (("l_quantity", "30"), ("l_tax", "0.055"), ("l_tax", "0.03"), ("l_discount", "0.052")))
PATCHES_SQL = f"""patches AS (SELECT l_partkey + CASE WHEN max(l_quantity) = 50 AND min(l_quantity) < 2 THEN (SELECT count(*) FROM part) ELSE 0 END AS concept_id, p_name AS "pivot",
CASE WHEN {MANY} > 0 THEN 'else' ELSE p_brand END AS old, CASE WHEN {TAXED} > 0 THEN ' ' WHEN {UNTAXED} < 0 THEN CASE WHEN {MANY} > 0 THEN 'else' ELSE p_brand END ELSE concat('new ', p_brand) END AS new
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey, l_linestatus, p_name, p_brand HAVING l_linestatus = 'F' OR {CHEAP} > 0)"""


def parts_tables(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    status = F.when(F.col("p_type") == "PROMO", "VERIFIED").otherwise("PROVISIONAL").alias("status")
    key, name, brand = F.col("p_partkey").alias("concept_id"), F.col("p_name"), F.col("p_brand")
    return {
        "records": p.select(key, name.alias("pivot"), brand.alias("target"), status),
        "generated": p.filter("p_size <= 45").select(key, name.alias("pivot"), F.when(F.col("p_size") == 30, "other").otherwise(brand).alias("target"), status),
        "catalog": p.filter("p_size >= 3").select(key, F.when(F.col("p_size") == 20, F.upper(name)).otherwise(name).alias("pivot"), brand.alias("target"), status),
        "quality": p.filter("p_retailprice > 950").select(key, name.alias("pivot"), F.col("p_type").alias("target"), status),
    }


def part_patches(spark, sf_dir):
    """A patch for each part and line status, as its line items have it."""
    part = read(spark, sf_dir, "part")
    n = part.agg(F.count("*").alias("parts"))
    g = read(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linestatus").agg(F.expr(MANY).alias("q"), F.max("l_quantity").alias("hi"), F.min("l_quantity").alias("lo"), F.expr(TAXED).alias("t"), F.expr(UNTAXED).alias("u"), F.expr(CHEAP).alias("d"))
    g = g.filter("l_linestatus = 'F' or d > 0").join(part.hint("merge"), F.col("l_partkey") == F.col("p_partkey")).crossJoin(F.broadcast(n))  # n is one row
    old = F.when(F.col("q") > 0, "else").otherwise(F.col("p_brand"))
    new = F.when(F.col("t") > 0, " ").when(F.col("u") < 0, old).otherwise(F.concat(F.lit("new "), "p_brand"))
    return g.select((F.col("l_partkey") + F.when((F.col("hi") == 50) & (F.col("lo") < 2), F.col("parts")).otherwise(0)).alias("concept_id"), F.col("p_name").alias("pivot"), old.alias("old"), new.alias("new"))


def by_table(sql: str) -> str:
    return " UNION ALL ".join(sql.format(t=t) for t in HOW.tables)


CHECKED_SQL = """SELECT unnest(list_concat([]::VARCHAR[], CASE WHEN t.concept_id IS NULL THEN ['missing-record'] ELSE [] END, CASE WHEN t."pivot" <> p."pivot" THEN ['identity-mismatch'] ELSE [] END,
CASE WHEN '{t}' <> 'quality' AND t.target <> p.old AND t.target <> p.new THEN ['drift'] ELSE [] END, CASE WHEN '{t}' IN ('records', 'generated') AND t.status <> 'PROVISIONAL' THEN ['evidence-mismatch'] ELSE [] END)) AS code, p.concept_id::VARCHAR AS entity_id, '{t}' AS "table"
FROM one p LEFT JOIN {t} t ON t.concept_id = p.concept_id"""
FINDINGS_SQL = f"""found AS (SELECT 'duplicate-id' AS code, concept_id::VARCHAR AS entity_id, '' AS "table" FROM patches GROUP BY concept_id HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'blank-value', concept_id::VARCHAR, '' FROM patches WHERE trim(new) = ''
UNION ALL SELECT DISTINCT 'unchanged-value', concept_id::VARCHAR, '' FROM patches WHERE new = old UNION ALL {by_table(CHECKED_SQL)})"""
ONE_SQL = '''one AS (SELECT concept_id, x.p AS "pivot", x.old AS old, x.new AS new FROM (SELECT concept_id, min({'p': "pivot", 'old': old, 'new': new}) AS x FROM patches GROUP BY 1))'''


@query(f"WITH {TABLES_SQL}, {PATCHES_SQL}, {ONE_SQL}, {FINDINGS_SQL} SELECT * FROM found")
def patch_batch_findings(spark, sf_dir):
    """Patches against four tables: repeated, blank and unchanged ones; missing rows, other identities, drift and evidence by table."""
    return integrate.patch_findings(parts_tables(spark, sf_dir), part_patches(spark, sf_dir), HOW)


@query(f"""WITH {TABLES_SQL}, {PATCHES_SQL}, {ONE_SQL}, {FINDINGS_SQL}, sound AS (SELECT * FROM one WHERE concept_id::VARCHAR NOT IN (SELECT entity_id FROM found))
{by_table('''SELECT '{t}' AS "table", t.concept_id, t."pivot", coalesce(s.new, t.target) AS target, t.status FROM {t} t LEFT JOIN sound s ON s.concept_id = t.concept_id''')}""")
def integrated_tables(spark, sf_dir):
    """The sound patches laid over four tables, staged, compared and committed as one version, which is read back."""
    store = TableSet(spark, shared_path(spark, "tables"))
    store.write(parts_tables(spark, sf_dir))
    at = shared_path(spark, "patches")
    part_patches(spark, sf_dir).write.parquet(at)  # findings and tables must see the same patches
    patches = spark.read.parquet(at)
    bad = integrate.patch_findings(store.tables(), patches, HOW).select(F.col("entity_id").cast("long").alias("concept_id")).distinct()
    integrate.integrate(store, patches.join(bad.hint("merge"), "concept_id", "left_anti"), HOW)
    out = None
    for name, df in store.tables().items():
        df = df.select(F.lit(name).alias("table"), "concept_id", "pivot", "target", "status")
        out = df if out is None else out.union(df)
    return out
