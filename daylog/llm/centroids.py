"""Centroid clustering on an integer grid (Lloyd's rounds), wholly in Spark expressions.

A component x becomes floor(256 * x). All later figures are integers, so results are equal on every run and cluster:
``zip_with`` and ``aggregate`` give the product of a vector with each centroid, which stand in the plan as literals;
``array_min`` of (distance, number) structs picks the nearest, ties to the smaller number; sums of the 64 columns by cluster
move the centroids. A round shuffles one row a task and cluster and brings as many rows to the driver as there are centroids.

Defined cases: a vector that is null, of another length, or holds null or non-finite components takes no part. Grid values
beyond 2^27 are held at that edge, so that every squared distance fits a long. A row with a null id is assigned like others
and is the last choice as a first centroid. Repeated rows count each time. Fewer vectors than centroids give fewer centroids;
an empty table gives no rows. Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.llm.common import ship_code, stored

CENTROIDS, ROUNDS, DIMS, SCALE = 40, 5, 64, 256
#: Largest grid value. 64 squares of differences of such values stay below 2^63.
EDGE = 1 << 27
#: Sums are longs while a cluster has fewer than 2^36 vectors at the edge.
LONG_MAX = (1 << 63) - 1
RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


@dataclass(frozen=True)
class Centroid:
    """A centroid and the digest of its components as decimal integers joined by commas."""

    values: tuple[int, ...]

    @property
    def digest(self) -> str:
        return sha256(",".join(map(str, self.values)).encode()).hexdigest()


def grid_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and the grid values ``v`` of every vector that takes part."""
    given = F.col(vector)
    finite = F.forall(given, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.where((F.size(given) == DIMS) & finite)
    at_edge = F.lit(float(EDGE))
    values = F.transform(given, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, at_edge), -at_edge)))
    return kept.select(F.col(vec_id).cast("bigint").alias("vec_id"), values.alias("v"))


def first_centroids(vectors: DataFrame, n: int = CENTROIDS) -> list[Centroid]:
    """The vectors with the smallest sha256 of ``2:<vec_id>``; each task sends ``n`` rows at most."""
    mark = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(mark.asc_nulls_last(), "vec_id", "v").limit(n).collect()
    return [Centroid(tuple(r.v)) for r in rows]


def nearest(vector: Column, centroids: list[Centroid]) -> Column:
    """The struct (distance, cluster) of the nearest centroid, from |v|^2 + |c|^2 - 2 v c."""

    def written(number: int, c: Centroid) -> str:
        values = ",".join(f"{x}L" for x in c.values)
        return f"named_struct('cluster',{number},'norm',{sum(x * x for x in c.values)}L,'centre',array({values}))"

    def product(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("bigint"), lambda s, x: s + x)

    literals = F.expr(f"array({','.join(written(i, c) for i, c in enumerate(centroids))})")
    # A list of one binds |v|^2 to a name, so it is worked out once a vector.
    norms = F.transform(F.array(product(vector, vector)), lambda norm: F.transform(literals, lambda c: F.struct(
        (norm + c["norm"] - 2 * product(vector, c["centre"])).alias("distance"), c["cluster"].alias("cluster")
    )))
    return F.array_min(F.element_at(norms, 1))


def moved(vectors: DataFrame, centroids: list[Centroid]) -> list[Centroid]:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays."""
    placed = vectors.select("v", nearest(F.col("v"), centroids)["cluster"].alias("cluster"))
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(DIMS)]
    out = list(centroids)
    for row in placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # a row a centroid
        out[row.cluster] = Centroid(tuple(row[f"s{i}"] // row.n for i in range(DIMS)))
    return out


def fit(vectors: DataFrame, n: int = CENTROIDS, rounds: int = ROUNDS) -> list[Centroid]:
    """The centroids after ``rounds`` rounds over grid vectors."""
    centroids = first_centroids(vectors, n)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids)
    return centroids


def cluster_vectors(vectors: DataFrame, n: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """Every vector that takes part with its cluster, its squared distance, the sums of distances over its cluster and over
    all, and the digest of its final centroid. Sums beyond a long are given as the largest long."""
    spark = vectors.sparkSession
    grid = grid_vectors(vectors)
    centroids = fit(grid, n, rounds)
    if not centroids:
        return spark.createDataFrame([], RESULT)
    placed = stored(grid.select("vec_id", nearest(F.col("v"), centroids).alias("near")).select("vec_id", "near.*"), "clusters")
    sums = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}

    def long(x: int) -> Column:
        return F.lit(min(x, LONG_MAX)).cast("bigint")

    def of_cluster(values: list[Column]) -> Column:
        return F.get(F.array(*values), F.col("cluster"))

    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([long(sums.get(i, 0)) for i in range(len(centroids))]).alias("cluster_inertia"),
        long(sum(sums.values())).alias("inertia"),
        of_cluster([F.lit(c.digest) for c in centroids]).alias("centroid_sha256"),
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(n: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The same in SQL: each round is two tables, assignments and centroids."""
    apart = "list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(kept.v, c.v)])::BIGINT"
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings WHERE len(embedding) = {DIMS} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {DIMS})""",
        f"""c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY mark, vec_id, v) - 1)::INTEGER AS k, v
  FROM (SELECT sha256('2:' || vec_id) AS mark, vec_id, v FROM kept ORDER BY mark NULLS LAST, vec_id, v LIMIT {n}))""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"a{i} AS MATERIALIZED (SELECT rid, min({{'distance': {apart}, 'k': c.k}}) AS near FROM kept CROSS JOIN c{i} c GROUP BY rid)"
        )
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT k, list(mean ORDER BY i) AS v FROM (
      SELECT k, i, ((s - ((s % m) + m) % m) // m)::BIGINT AS mean FROM (
        SELECT near.k AS k, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS m
        FROM kept JOIN a{i} USING (rid), range(1, {DIMS + 1}) AS t(i) GROUP BY ALL)) GROUP BY k) m USING (k))""")
    return f"""WITH {", ".join(parts)}
SELECT kept.vec_id, near.k AS cluster, near.distance AS distance,
  (sum(near.distance) OVER (PARTITION BY near.k))::BIGINT AS cluster_inertia, (sum(near.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} USING (rid) JOIN c{rounds} c ON c.k = near.k"""


SQL = _sql()
