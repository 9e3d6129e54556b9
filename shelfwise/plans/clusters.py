"""Clustering queries over scaled recency, frequency and monetary value of all customers.

Quality measures are checked on labels given by rule: the RFM segment's number.
"""

from pyspark.sql import functions as F

from shelfwise.functions.storage import cut
from shelfwise.operators import cluster, dbscan
from shelfwise.operators.encode import scale
from shelfwise.operators.features import SEGMENTS
from shelfwise.plans.common import RFM, rfm_table, rounded
from shelfwise.plans.registry import query

RAW = ["recency", "frequency", "monetary"]
X = [f"{c}_scaled" for c in RAW]
_NUMBERED = ", ".join(f"'{s}'" for s in SEGMENTS)
_POINTS = RFM + f""", numbered AS (SELECT *, CAST(list_position([{_NUMBERED}], segment) - 1 AS INTEGER) AS cluster FROM rfm),
st AS (SELECT avg(recency) AS mr, stddev_pop(recency) AS sr, avg(frequency) AS mf, stddev_pop(frequency) AS sf,
              avg(monetary) AS mm, stddev_pop(monetary) AS sm FROM numbered),
pts AS (SELECT customer_id AS id, cluster, (recency - mr) / sr AS x, (frequency - mf) / sf AS y, (monetary - mm) / sm AS z FROM numbered, st),
cen AS (SELECT cluster, count(*) AS n, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, avg(x * x + y * y + z * z) AS sq FROM pts GROUP BY cluster)"""


def customers(spark, sf_dir):
    """Customers with their segment's number and scaled features, written once."""
    return cut(scale(rfm_table(spark, sf_dir), RAW, "standard"))


def segmented(spark, sf_dir):
    numbers = F.array(*[F.lit(s) for s in SEGMENTS])
    return customers(spark, sf_dir).withColumn("cluster", (F.array_position(numbers, F.col("segment")) - 1).cast("int"))


_DBI = """sc AS (SELECT p.cluster, avg(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy) + (z - cz) * (z - cz))) AS s
  FROM pts p JOIN cen c ON p.cluster = c.cluster GROUP BY p.cluster),
cs AS (SELECT cen.*, sc.s FROM cen JOIN sc USING (cluster)),
dbi AS (SELECT avg(worst) AS v FROM (SELECT a.cluster, max((a.s + b.s) / sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy)
  + (a.cz - b.cz) * (a.cz - b.cz))) AS worst FROM cs a JOIN cs b ON a.cluster <> b.cluster GROUP BY a.cluster))"""
_CH = """g AS (SELECT avg(x) AS gx, avg(y) AS gy, avg(z) AS gz, count(*) AS n FROM pts),
ch AS (SELECT ((SELECT sum(c.n * ((cx - gx) * (cx - gx) + (cy - gy) * (cy - gy) + (cz - gz) * (cz - gz))) FROM cen c, g)
    / ((SELECT count(*) FROM cen) - 1))
  / ((SELECT sum((x - cx) * (x - cx) + (y - cy) * (y - cy) + (z - cz) * (z - cz)) FROM pts p JOIN cen c ON p.cluster = c.cluster)
    / ((SELECT n FROM g) - (SELECT count(*) FROM cen))) AS v)"""
_SQ = """dist AS (SELECT p.id, p.cluster = c.cluster AS mine, c.n,
    greatest(x * x + y * y + z * z - 2 * (x * cx + y * cy + z * cz) + sq, 0) AS d FROM pts p, cen c),
ab AS (SELECT id, max(d * n / nullif(n - 1, 0)) FILTER (mine) AS a, min(d) FILTER (NOT mine) AS b FROM dist GROUP BY id),
sil AS (SELECT avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS v FROM ab)"""


@query("clu_davies_bouldin", f"WITH {_POINTS}, {_DBI} SELECT round(v, 6) AS davies_bouldin FROM dbi")
def clu_davies_bouldin(spark, sf_dir):
    return rounded(cluster.davies_bouldin(segmented(spark, sf_dir), X), 6)


@query("clu_calinski_harabasz", f"WITH {_POINTS}, {_CH} SELECT round(v, 4) AS calinski_harabasz FROM ch")
def clu_calinski_harabasz(spark, sf_dir):
    return rounded(cluster.calinski_harabasz(segmented(spark, sf_dir), X))


@query("clu_silhouette_squared", f"WITH {_POINTS}, {_SQ} SELECT round(v, 6) AS silhouette FROM sil")
def clu_silhouette_squared(spark, sf_dir):
    return rounded(cluster.silhouette(segmented(spark, sf_dir), "customer_id", X, "squared"), 6)


@query("clu_silhouette_exact", f"""WITH {_POINTS},
dist AS (SELECT p.id, p.cluster AS own, q.cluster AS other, sum(sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)
  + (p.z - q.z) * (p.z - q.z))) AS d FROM pts p, pts q GROUP BY ALL),
ab AS (SELECT id, any_value(own) AS own, max(d / nullif(n - 1, 0)) FILTER (own = other) AS a, min(d / n) FILTER (own <> other) AS b
  FROM dist JOIN cen ON cen.cluster = other GROUP BY id)
SELECT round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab""")
def clu_silhouette_exact(spark, sf_dir):
    return rounded(cluster.silhouette(segmented(spark, sf_dir), "customer_id", X, "euclidean"), 6)


@query("clu_evaluate", f"""WITH {_POINTS}, {_DBI}, {_CH}, {_SQ}
SELECT 'n_clusters' AS metric, CAST(count(*) AS DOUBLE) AS value FROM cen
UNION ALL SELECT 'silhouette', round(v, 4) FROM sil UNION ALL SELECT 'davies_bouldin', round(v, 4) FROM dbi
UNION ALL SELECT 'calinski_harabasz', round(v, 4) FROM ch
UNION ALL SELECT 'size_' || cluster, CAST(n AS DOUBLE) FROM cen""")
def clu_evaluate(spark, sf_dir):
    return rounded(cluster.evaluate(segmented(spark, sf_dir), "customer_id", X, "squared"))


_STATS = ", ".join(
    f"round(avg({c}), 4) AS {c}, round(stddev_samp({c}), 4) AS {c}_std, round(min({c}), 4) AS {c}_min, round(max({c}), 4) AS {c}_max"
    for c in RAW)


@query("clu_profiles", f"""WITH {_POINTS} SELECT cluster, {_STATS}, count(*) AS size,
  round_even(count(*) / (SELECT count(*) FROM numbered) * 100, 2) AS percentage FROM numbered GROUP BY cluster""")
def clu_profiles(spark, sf_dir):
    table = cluster.profiles(segmented(spark, sf_dir), RAW)
    doubles = {f"{c}_{s}": F.col(f"{c}_{s}").cast("double") for c in RAW for s in ("min", "max")}
    table = table.withColumns(doubles)
    return rounded(table, 4, [c for c, kind in table.dtypes if kind == "double" and c != "percentage"])


_PROFILE = """prof AS (SELECT cluster, avg(recency) AS r, avg(frequency) AS f, avg(monetary) AS m, count(*) AS size,
  round_even(count(*) / (SELECT count(*) FROM numbered) * 100, 2) AS pct FROM numbered GROUP BY cluster),
med AS (SELECT median(r) AS r, median(f) AS f, median(m) AS m FROM prof),
descr AS (SELECT p.cluster, 'Cluster ' || p.cluster || ': ' || CASE WHEN p.r < med.r THEN 'Bought lately' ELSE 'Quiet for long' END || ', '
  || CASE WHEN p.f > med.f THEN 'Orders often' ELSE 'Orders rarely' END || ', ' || CASE WHEN p.m > med.m THEN 'Spends much' ELSE 'Spends little' END
  || ' (' || p.size || ' customers, ' || p.pct || '%)' AS description FROM prof p, med)"""


@query("clu_descriptions", f"WITH {_POINTS}, {_PROFILE} SELECT cluster, description FROM descr")
def clu_descriptions(spark, sf_dir):
    return cluster.descriptions(cluster.profiles(segmented(spark, sf_dir), RAW))


@query("clu_profiles_normalized", f"""WITH {_POINTS}, {_PROFILE}
SELECT cluster, round(r / (SELECT max(r) FROM prof), 4) AS recency, round(f / (SELECT max(f) FROM prof), 4) AS frequency,
       round(m / (SELECT max(m) FROM prof), 4) AS monetary FROM prof""")
def clu_profiles_normalized(spark, sf_dir):
    return rounded(cluster.normalized_profiles(cluster.profiles(segmented(spark, sf_dir), RAW), RAW))


@query("rep_cluster", f"""WITH {_POINTS}, {_PROFILE}
SELECT 'n_clusters' AS section, 1 AS seq, CAST(count(*) AS VARCHAR) AS text FROM prof
UNION ALL SELECT 'cluster_size', cluster, size || ' customers (' || pct || '%)' FROM prof
UNION ALL SELECT 'description', cluster, description FROM descr
UNION ALL (SELECT 'largest_cluster', 1, 'Largest cluster: ' || cluster || ' with ' || size || ' customers (' || pct || '%)'
  FROM prof ORDER BY size DESC, cluster LIMIT 1)
UNION ALL (SELECT 'smallest_cluster', 1, 'Smallest cluster: ' || cluster || ' with ' || size || ' customers (' || pct || '%)'
  FROM prof ORDER BY size, cluster LIMIT 1)""")
def rep_cluster(spark, sf_dir):
    return cluster.cluster_report(cluster.profiles(segmented(spark, sf_dir), RAW))


@query("clu_kmeans")
def clu_kmeans(spark, sf_dir):
    clustered, _ = cluster.fit_kmeans(customers(spark, sf_dir), X, 4)
    return clustered.select("customer_id", "cluster")


@query("clu_hac_ward")
def clu_hac_ward(spark, sf_dir):
    return cluster.fit_hac(customers(spark, sf_dir), "customer_id", X, 4).select("customer_id", "cluster")


@query("clu_find_k")
def clu_find_k(spark, sf_dir):
    return cluster.find_k(customers(spark, sf_dir), "customer_id", X, range(2, 8), method="squared")


@query("clu_pca")
def clu_pca(spark, sf_dir):
    return cluster.pca_2d(customers(spark, sf_dir), "customer_id", X)


_NEAR = "(p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) + (p.z - q.z) * (p.z - q.z) <= {eps} * {eps}"


def _dbscan_sql(eps, least):
    return f"""WITH RECURSIVE {_POINTS},
near AS MATERIALIZED (SELECT p.id AS a, q.id AS b FROM pts p JOIN pts q ON {_NEAR.format(eps=eps)}),
core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {least}),
link AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT id, id AS root FROM core UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id WHERE link.b > reach.root),
roots AS MATERIALIZED (SELECT id, min(root) AS root FROM reach GROUP BY id),
named AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM roots),
edge AS (SELECT a AS id, min(cluster) AS cluster FROM near JOIN named ON named.id = b GROUP BY a)
SELECT p.id AS customer_id, CAST(coalesce(n.cluster, e.cluster, -1) AS INTEGER) AS cluster
FROM pts p LEFT JOIN named n ON n.id = p.id LEFT JOIN edge e ON e.id = p.id"""


@query("clu_dbscan", _dbscan_sql(0.5, 5))
def clu_dbscan(spark, sf_dir):
    return dbscan.fit_dbscan(customers(spark, sf_dir), "customer_id", X, 0.5, 5).select("customer_id", "cluster")


@query("clu_dbscan_fine", _dbscan_sql(0.22, 5))
def clu_dbscan_fine(spark, sf_dir):
    return dbscan.fit_dbscan(customers(spark, sf_dir), "customer_id", X, 0.22, 5).select("customer_id", "cluster")
