"""A stored index for approximate maximum-inner-product search: built once,
loaded anywhere, read only where a query looks.

``build`` augments the items as ``ann`` does (inner-product order becomes
distance order), finds cell centres by k-means on a bounded sample of them, puts
every item into its nearest cell and writes the posting lists as Parquet,
partitioned by cell.  It also stores how much of the exact lists of a bounded
sample of queries lies within a query's 1, 2, 3, ... nearest cells, which ties the
search effort to a recall target.

``search`` orders the cells by their distance to the query, takes as many as the
target asks for (more where they hold fewer than k items, so that every list is
full), and reads the posting lists of the probed cells only.  A task holds a
block of queries with their cells and lists and reads the posting lists past it,
a bounded tile at a time; a hot cell's queries are spread by blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_recs.operators.ann import SAMPLE_QUERIES, SLACK, ProbeBits, item_stats, sample_queries, search_buckets
from spark_recs.operators.scoring import blocked_topk

SAMPLE_ROWS = 1 << 16         # items that the centres are fitted on, about
ROWS_PER_CENTRE = 32          # of the sample, at least: bounds the cells
CELL_ROWS = 1 << 16           # items or queries of a cell scored by one task
KMEANS_ITERATIONS = 10

_META = "n_items long, dim int, m2 double, k int, n_cells int, seed long"
_CELLS = "cell int, centre array<double>, n_items long"
_EFFORT = "probes int, recall double"


@dataclass(frozen=True)
class Index:
    """A loaded index: the centres (cells × dimensions, bounded by the build's
    sample) and the effort curve are held here, the posting lists stay stored."""
    path: str
    m2: float
    n_items: int
    centres: np.ndarray
    sizes: np.ndarray
    recalls: list[float]      # share of the exact lists within the nearest 1, 2, ... cells

    def probes_for(self, recall: float, slack: float = SLACK) -> int:
        """Least cells that reached the target on the sample."""
        return next((p for p, r in enumerate(self.recalls, 1) if r >= min(1.0, recall + slack)), max(1, len(self.sizes)))


def default_cells(n_items: int, sample_rows: int = SAMPLE_ROWS) -> int:
    return max(1, min(math.isqrt(n_items), sample_rows // ROWS_PER_CENTRE))


def _augmented(features: pd.Series, m2: float) -> np.ndarray:
    x = np.vstack(features.to_numpy()).astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(m2 - np.einsum("ij,ij->i", x, x), 0.0))[:, None]])


def _cell_order(features: np.ndarray, centres: np.ndarray, m2: float) -> np.ndarray:
    """Cells by the distance of their centres to the query, which is scaled to
    the items' length; a query of zeros takes them as numbered."""
    norm = np.sqrt(np.einsum("ij,ij->i", features, features))
    scale = np.divide(math.sqrt(m2), norm, out=np.zeros_like(norm), where=norm > 0)
    away = np.einsum("ij,ij->i", centres, centres) - 2 * (features * scale[:, None]) @ centres[:, :-1].T
    return np.argsort(away, axis=1, kind="stable")


def _fit_centres(items: DataFrame, n: int, m2: float, cells: int, sample_rows: int, seed: int) -> np.ndarray:
    some = items.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(1, n // sample_rows))) == 0)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def augment(features: pd.Series) -> pd.Series:
        return pd.Series(list(_augmented(features, m2)))

    model = KMeans(k=cells, seed=seed, maxIter=KMEANS_ITERATIONS).fit(some.select(array_to_vector(augment("features")).alias("features")))
    return np.array(model.clusterCenters())


def _assign(items: DataFrame, centres: np.ndarray, m2: float) -> DataFrame:
    half = np.einsum("ij,ij->i", centres, centres) / 2

    @F.pandas_udf(T.IntegerType())
    def nearest(features: pd.Series) -> pd.Series:
        step, out = 4096, []
        for a in range(0, len(features), step):
            out.append((_augmented(features.iloc[a: a + step], m2) @ centres.T - half).argmax(axis=1))
        return pd.Series(np.concatenate(out) if out else [], dtype="int32")

    return items.select(F.col("id").cast("long").alias("item_id"), "features", nearest("features").alias("cell"))


def build(items: DataFrame, path: str, cells: int | None = None, k: int = 100, queries: DataFrame | None = None,
          sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> str:
    """Writes the index of ``items`` (id, features) under ``path``.  The effort
    curve is measured on a sample of ``queries`` (default: the items
    themselves, none of which finds itself)."""
    spark = items.sparkSession
    m2, dim, n = item_stats(items)
    cells = cells or default_cells(n, sample_rows)
    centres = _fit_centres(items, n, m2, cells, sample_rows, seed) if n else np.zeros((0, dim + 1))
    salt = F.pmod(F.xxhash64("item_id"), F.lit(max(1, -(-n // (cells * CELL_ROWS)))))
    (_assign(items, centres, m2).repartition("cell", salt).sortWithinPartitions("cell")
        .write.partitionBy("cell").parquet(f"{path}/postings"))
    sizes = dict(_postings(spark, path).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()) if n else {}
    rows = [(c, [float(x) for x in v], sizes.get(c, 0)) for c, v in enumerate(centres)]
    spark.createDataFrame(rows, _CELLS).coalesce(1).write.parquet(f"{path}/cells")
    curve = _effort_curve(_postings(spark, path), items, queries, centres, m2, k, seed) if n else []
    spark.createDataFrame([(p, float(r)) for p, r in enumerate(curve, 1)], _EFFORT).coalesce(1).write.parquet(f"{path}/effort")
    spark.createDataFrame([(n, dim, m2, k, len(centres), seed)], _META).coalesce(1).write.parquet(f"{path}/meta")  # last: marks a whole index
    return path


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/postings")


def _effort_curve(postings: DataFrame, items: DataFrame, queries: DataFrame | None, centres: np.ndarray, m2: float, k: int,
                  seed: int) -> list[float]:
    """Share of the sample's exact top-k in each query's nearest 1, 2, ... cells;
    the sample's queries and lists (bounded) are brought to the driver."""
    chosen = sample_queries(queries if queries is not None else items, seed).collect()
    if not chosen:
        return []
    sample = items.sparkSession.createDataFrame(chosen, (queries if queries is not None else items).select("id", "features").schema)
    exact = blocked_topk(sample, items, k, exclude_self=queries is None).select("user_id", "item_id")
    met = exact.join(postings.select("item_id", "cell"), "item_id").select("user_id", "cell").collect()
    order = _cell_order(np.array([r["features"] for r in chosen], dtype=np.float64), centres, m2)
    place = np.argsort(order, axis=1)
    row = {r["id"]: i for i, r in enumerate(chosen)}
    found = np.bincount([place[row[u], c] for u, c in met], minlength=len(centres))
    return (np.cumsum(found) / max(1, found.sum())).tolist()


def load(spark: SparkSession, path: str) -> Index:
    meta = spark.read.schema(_META).parquet(f"{path}/meta").first()
    cells = sorted(spark.read.schema(_CELLS).parquet(f"{path}/cells").collect())
    effort = sorted(spark.read.schema(_EFFORT).parquet(f"{path}/effort").collect())
    centres = np.array([r["centre"] for r in cells]).reshape(len(cells), meta["dim"] + 1)
    return Index(path, meta["m2"], meta["n_items"], centres, np.array([r["n_items"] for r in cells], dtype=np.int64), [r["recall"] for r in effort])


def _nearest_cells(index: Index, probes: int, k: int):
    def of(features: np.ndarray) -> list[list[int]]:
        order = _cell_order(features, index.centres, index.m2)
        enough = (np.cumsum(index.sizes[order], axis=1) <= k).sum(axis=1) + 1
        return [o[: max(probes, e)].tolist() for o, e in zip(order, enough.tolist())]
    return of


def _cell_bits(index: Index, probes: int, k: int):
    """For a block of queries their nearest cells, as ``ProbeBits``."""
    nearest = _nearest_cells(index, probes, k)

    def of(features: np.ndarray) -> ProbeBits:
        bits = np.zeros((len(features), -(-len(index.sizes) // 8)), np.uint8)
        for a in range(0, len(features), 1024):
            some = nearest(features[a: a + 1024])
            met = np.zeros((len(some), len(index.sizes)), bool)
            for row, cells in zip(met, some):
                row[cells] = True
            bits[a: a + 1024] = np.packbits(met, axis=1, bitorder="little")
        return ProbeBits(bits)
    return of


def cells_of(queries: DataFrame, index: Index, probes: int, k: int) -> DataFrame:
    """(id, features, probes): each query's nearest ``probes`` cells, and further
    ones until they hold more than ``k`` items (itself may be one)."""
    nearest = _nearest_cells(index, probes, k)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def cells(features: pd.Series) -> pd.Series:
        return pd.Series([c for a in range(0, len(features), 1024)
                          for c in nearest(np.vstack(features.iloc[a: a + 1024].to_numpy()).astype(np.float64))], dtype=object)

    return queries.select("id", "features", cells("features").alias("probes"))


def probed_cells(queries: DataFrame, index: Index, probes: int, k: int) -> DataFrame:
    """(user_id, features, cell): one row per query and probed cell."""
    return cells_of(queries, index, probes, k).select(F.col("id").cast("long").alias("user_id"), "features", F.explode("probes").alias("cell"))


def read_postings(spark: SparkSession, index: Index, cells: list[int]) -> DataFrame:
    """The posting lists of ``cells``; the others' files are not read."""
    return _postings(spark, index.path).filter(F.col("cell").isin(cells))


def search(spark: SparkSession, index: Index, queries: DataFrame, k: int, recall: float = 0.9, probes: int | None = None,
           exclude_self: bool = False, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(user_id, rank, item_id, score): each query's (id, features) best ``k``
    items of its probed cells, by inner product, ties to the smaller id."""
    if not index.n_items:
        return spark.createDataFrame([], "user_id long, rank long, item_id long, score double")
    asked = cells_of(queries, index, probes or index.probes_for(recall), k)
    # one row per cell: which are probed, and by how many
    by_cell = dict(asked.select(F.explode("probes").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect())
    n_queries = queries.count()
    items = read_postings(spark, index, sorted(by_cell)).select("item_id", "features", F.array("cell").alias("codes"))
    return search_buckets(queries, items, k, n_queries, sum(int(index.sizes[c]) for c in by_cell),
                          _cell_bits(index, probes or index.probes_for(recall), k), len(index.sizes), exclude_self, cell_rows)
