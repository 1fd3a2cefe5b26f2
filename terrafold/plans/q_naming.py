"""Queries over texts and figures: who names what, figures by surface, coincidences, acceptance by perturbation."""

from pyspark.sql import functions as F

from terrafold.functions import figures as Z
from terrafold.operators import naming as M
from terrafold.plans.registry import register
from terrafold.sources import derived as D


@register("producers", """WITH n AS (SELECT DISTINCT h[2:] AS name FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS h FROM pages) WHERE len(h) > 4)
SELECT 'document ' || doc_id AS path, name FROM documents, n WHERE contains(text, name)""")
def producers(spark, d):
    """Which documents name which of the pages' link targets."""
    links = D.table(spark, d, "pages").select(F.explode(Z.found(F.col("html"), r'href="([^"]*)"', 1)).alias("h"))
    names = links.where(F.length("h") > M.GRAM).select(F.substring("h", F.lit(2), F.length("h")).alias("name"))
    return M.naming(D.table(spark, d, "documents").select(F.concat(F.lit("document "), F.col("doc_id").cast("string")).alias("path"), "text"), names)


@register("surface_figures")
def surface_figures(spark, d):
    """Figures and exemptions of every page as a reader sees it; a plain Python scan checks it."""
    return M.surface_figures(D.table(spark, d, "pages").withColumnRenamed("html", "text"), "page_id", True)


@register("registry_coincidences", """WITH l AS (SELECT 'part ' || p_partkey AS name, p_retailprice / 100.0 AS value, CASE WHEN p_size % 2 = 0 THEN 'km²' ELSE '%' END AS unit FROM part),
t AS (SELECT DISTINCT name, unit, format('{:.' || p || 'f}', value) AS number FROM l, range(3) r(p)),
k AS (SELECT DISTINCT format('{:.1f}', s_acctbal / 100.0) AS number, CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'km²' ELSE '%' END AS own FROM supplier WHERE abs(s_acctbal) < 99000)
SELECT DISTINCT k.number || coalesce(' ' || own, '') AS figure, name FROM k JOIN t USING (number) WHERE own IS NULL OR own = unit""")
def registry_coincidences(spark, d):
    """Prices as live values, balances as registered figures of one place."""
    live = D.table(spark, d, "part").select(F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("name"), (F.col("p_retailprice").cast("double") / 100.0).alias("value"), F.when(F.col("p_size") % 2 == 0, "km2").otherwise("pct").alias("unit"))
    k = F.col("s_suppkey") % 3
    s = D.table(spark, d, "supplier").where("abs(s_acctbal) < 99000")
    return M.coincidences(s.select(F.concat_ws(" ", F.format_number(F.col("s_acctbal").cast("double") / 100.0, 1), F.when(k == 1, "km²").when(k == 2, "%")).alias("figure")), live)


@register("perturbed_figures", """WITH b AS (SELECT count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q, max(year(l_shipdate)) AS y, count(DISTINCT l_suppkey) AS s FROM lineitem)
SELECT 'rows' AS figure, CAST(n AS VARCHAR) AS before, CAST(n AS VARCHAR) AS after, false AS moved FROM b UNION ALL SELECT 'quantity', CAST(q AS VARCHAR), CAST(q + n AS VARCHAR), true FROM b
UNION ALL SELECT 'last year', CAST(y AS VARCHAR), CAST(y AS VARCHAR), false FROM b UNION ALL SELECT 'suppliers', CAST(s AS VARCHAR), '1', true FROM b UNION ALL SELECT 'constant', '7', '7', false""")
def perturbed_figures(spark, d):
    """Quantities are raised and suppliers made one; what does not depend on either stays, and so does a constant."""
    q = F.col("l_quantity")
    figures = {"rows": F.count("*"), "quantity": F.sum(q.cast("bigint")), "last year": F.max(F.year("l_shipdate")), "suppliers": F.count_distinct("l_suppkey"), "constant": F.max(F.lit(7))}
    return M.perturbed(D.table(spark, d, "lineitem"), figures, {"l_quantity": q + 1, "l_suppkey": F.lit(1)})
