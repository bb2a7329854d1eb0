"""Exact top-k search by inner product with a vector-approximation file.

Every component becomes a whole number; its range is cut into 2^bits cells, and the approximation of a vector is its cell
numbers. Cells bound a score from above and below. A scan of the approximations keeps, for each query, the vectors
whose upper bound reaches the kth best lower bound; exact vectors are then read in the order of their bounds - first
those with the highest upper bounds, then only those whose upper bound still reaches the kth exact score - so the
result is that of a full scan.

Equal vectors are one class with the k + 1 least ids of its rows, of which a query can use no more; so a vector that many
rows share is scanned, bounded and scored once. Queries are a stated set, met with all classes block by block; a block pair
gives at most what can still be in the result.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do those with a component
beyond 2^500, whose products no double holds; vectors are compared with those of the same number of components; rows equal
in vec_id and vector count once; an id with several vectors asks with each of them and gets the k best of all; a null
vec_id is never a query and comes last among ties; an empty table or one vector gives no rows; fewer than k others gives
all of them. Scores are exact as long as the sum of the products' absolute values is below 2^63; beyond, they are ranked by
their value as a double and given as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BROADCAST_BYTES, BROADCAST_ROWS, small, written

BLOCK = 4096
QUERY_BLOCK = 512
LANES = 4096
#: Bytes of query vectors that a task of the scan holds.
TILE = 16 << 20
SHARES = 8
LARGEST = 2.0**500
SHARED = -(2**63) + 1  # in place of an owner, for a class that several ids share


def scaled(embedding: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component x, as doubles, which hold them exactly; null for vectors that take no part."""
    values = F.transform(embedding, lambda x: x.cast("double") * factor)
    whole = F.transform(values, lambda x: F.when(F.abs(x) < 2.0**52, F.floor(F.when(F.abs(x) < 2.0**52, x)).cast("double")).otherwise(x))
    good = embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= LARGEST))
    return F.when(good, whole)


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def cell_bounds(codes: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each component's cell; wider by what rounding may take where numbers don't fit a double's 53 bits."""
    span = codes * width
    least, most = low + span, low + span + width - 1
    size = np.abs(low) + span + width
    slack = np.where(size < 2.0**52, 0.0, size * 2.0**-50)
    return least - slack, most + slack


def score_bounds(queries: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of every query's score with every vector."""
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    lower = plus @ least.T + minus @ most.T
    upper = plus @ most.T + minus @ least.T
    size = np.abs(queries) @ np.maximum(np.abs(least), np.abs(most)).T
    slack = np.where(size < 2.0**52, 0.0, size * (queries.shape[1] + 8) * 2.0**-51)
    return lower - slack, upper + slack


def keyed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, h1, h2): the rows that take part, and 128 bits of hash of the vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col)).alias("v")).where("v is not null")
    return rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})


def vector_classes(rows: DataFrame, k: int) -> DataFrame:
    """(row, dim, v, ids, owner): a row per distinct vector with the k + 1 least ids that have it, null last; owner is its only
    id, or ``SHARED``. Ids are limited before they are shuffled, so a very common vector sends a few rows a task."""
    order = Window.partitionBy("h1", "h2").orderBy(F.col("vec_id").isNull(), "vec_id")
    least = rows.select("h1", "h2", "vec_id").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    names = least.groupBy("h1", "h2").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id"))).alias("ids"))  # k + 1 at most
    found = rows.groupBy("h1", "h2").agg(F.first("v").alias("v")).join(names, ["h1", "h2"])
    ids = F.transform("ids", lambda x: x["vec_id"])
    owner = F.when(F.size(ids) > 1, F.lit(SHARED)).otherwise(F.coalesce(F.get(ids, F.lit(0)), F.lit(SHARED)))
    return found.select(F.monotonically_increasing_id().alias("row"), F.size("v").alias("dim"), "v", ids.alias("ids"), owner.alias("owner"))


def approximations(vectors: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of cell numbers (dim, ids, owners, codes) and the cell geometry per number of components (dim, low, width)."""
    spread = vectors.select("dim", F.posexplode("v").alias("at", "x")).groupBy("dim", "at").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    cell = F.ceil(F.least((F.col("hi") - F.col("lo") + 1) / (1 << bits), F.lit(2.0**50))).cast("double")
    cell = F.when(cell < 2.0**50, cell).otherwise((F.col("hi") - F.col("lo")) / (1 << bits) * (1 + 2.0**-40))
    grid = spread.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("at", "lo", cell.alias("w")))).alias("g"))  # one entry a component
    grid = written(grid.select("dim", F.col("g.lo").alias("low"), F.col("g.w").alias("width")), "va-grid")
    coded = vectors.join(grid, "dim")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                for start in range(0, len(part), BLOCK):
                    rows = part.iloc[start : start + BLOCK]
                    low, width = np.asarray(rows["low"].iloc[0], np.float64), np.asarray(rows["width"].iloc[0], np.float64)
                    codes = np.clip((_matrix(rows["v"]) - low) // width, 0, (1 << bits) - 1).astype(np.uint16 if bits > 8 else np.uint8)
                    yield pd.DataFrame({"dim": [dim], "ids": [rows["row"].to_numpy(np.int64).tobytes()], "owners": [rows["owner"].to_numpy(np.int64).tobytes()], "codes": [codes.tobytes()]})

    return written(coded.select("dim", "row", "owner", "v", "low", "width").mapInPandas(pack, "dim int, ids binary, owners binary, codes binary"), "va-cells"), grid


def query_blocks(queries: DataFrame) -> DataFrame:
    """Blocks of (query, query_id, v)."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                for start in range(0, len(part), QUERY_BLOCK):
                    rows = part.iloc[start : start + QUERY_BLOCK]
                    yield pd.DataFrame({"qdim": [dim], "queries": [rows["query"].to_numpy(np.int64).tobytes()], "qowners": [rows["query_id"].to_numpy(np.int64).tobytes()], "values": [_matrix(rows["v"]).tobytes()]})

    return written(queries.repartition(max(1, -(-queries.count() // QUERY_BLOCK)), "query").mapInPandas(pack, "qdim int, queries binary, qowners binary, values binary"), "va-queries")


def scan(cells: DataFrame, grid: DataFrame, queries: DataFrame, k: int, bits: int) -> DataFrame:
    """(query, row, lower, upper) for what a tile's cells can still add to a query's k best.

    Cells are dealt over lanes and query blocks over lanes of their own; each pair of lanes is a tile, whose task holds its
    query blocks, about ``TILE`` bytes, and sees its cells one after another. No join, so nothing of it is ever broadcast."""
    n, size = cells.count(), queries.agg(F.sum(F.length("values"))).first()[0] or 0
    lanes, qlanes = max(1, min(LANES, -(-n // min(64, max(4, n // 64))))), max(1, -(-size // TILE))
    dealt = lambda column, of: F.pmod(F.xxhash64(column), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    coded = cells.join(grid, "dim").select(dealt("ids", lanes).alias("lane"), every(qlanes).alias("qlane"), F.lit(True).alias("cell"), "dim", "ids", "owners", "codes", "low", "width")
    none = F.lit(None).cast("array<double>")
    asked = queries.select(every(lanes).alias("lane"), dealt("queries", qlanes).alias("qlane"), F.lit(False), F.col("qdim"), "queries", "qowners", "values", none, none)
    tiles = asked.toDF(*coded.columns).union(coded).repartition(min(LANES, lanes * qlanes), "lane", "qlane").sortWithinPartitions("lane", "qlane", "cell")
    schema = pa.schema([("query", pa.int64()), ("row", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64())])
    kind = np.uint16 if bits > 8 else np.uint8

    def bound(batches):
        tile, blocks = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                dim, ids, owners = r["dim"], np.frombuffer(r["ids"], np.int64), np.frombuffer(r["owners"], np.int64)
                if tile != (r["lane"], r["qlane"]):
                    tile, blocks = (r["lane"], r["qlane"]), []
                if not r["cell"]:
                    blocks.append((dim, ids, owners, np.frombuffer(r["codes"], np.float64).reshape(len(ids), dim), np.full((len(ids), k), -np.inf)))
                    continue
                if not any(b[0] == dim for b in blocks):
                    continue
                least, most = cell_bounds(np.frombuffer(r["codes"], kind).reshape(len(ids), dim).astype(np.float64), np.array(r["low"], np.float64), np.array(r["width"], np.float64))
                for qdim, names, own, values, best in blocks:
                    if qdim != dim:
                        continue
                    lower, upper = score_bounds(values, least, most)
                    mine = own[:, None] == owners[None, :]  # a query's own rows take no part
                    lower[mine] = upper[mine] = -np.inf
                    top = np.partition(lower, len(ids) - k, axis=1)[:, -k:] if len(ids) > k else lower
                    best[:] = np.partition(np.hstack([best, top]), top.shape[1], axis=1)[:, -k:]  # of all cells of the tile so far
                    q, c = np.nonzero((upper >= best.min(1)[:, None]) & ~mine)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (names[q], ids[c], lower[q, c], upper[q, c])], schema=schema)

    return tiles.mapInArrow(bound, "query long, row long, lower double, upper double")


def best_of(rows: DataFrame, key: str, order: list[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first k rows of each ``key``, found by shares of its rows first, so that a key with very many rows, as a query in a
    dense cluster has, isn't sorted in one task."""
    share = F.pmod(F.xxhash64("row"), F.lit(SHARES))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy(key, share).orderBy(*order))).where(F.col("n") <= k)
    name = rank or "n"
    rows = rows.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col(name) <= k)
    return rows if rank else rows.drop("n")


def beside(queries: DataFrame) -> DataFrame:
    """(query, query_id, q), with a broadcast hint if the rows are small in memory. Files hold components in a byte or so each, so
    they don't tell; where the rows are large, the engine, which goes by files, is kept from a broadcast of its own."""
    n, size = queries.agg(F.count("*"), F.sum(8 * F.size("v") + 64)).first()
    side = queries.select("query", "query_id", F.col("v").alias("q"))
    return F.broadcast(side) if n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else side.hint("merge")


def exact_scores(pairs: DataFrame, asked: DataFrame, classes: DataFrame) -> DataFrame:
    """(query, query_id, row, ids, score, wide, slack), reading the exact vectors of ``pairs`` only; ``asked`` is ``beside`` of the
    queries; wide is the score as a double, which is off by at most slack."""
    joined = pairs.join(classes.select("row", "v", "ids"), "row").join(asked, "query")
    total = lambda values, kind: F.aggregate(values, F.lit(0).cast(kind), lambda a, x: a + x)
    products = F.zip_with("q", "v", lambda x, y: x * y)
    joined = joined.withColumns({"wide": total(products, "double"), "size": total(F.transform(products, F.abs), "double")})
    long_fits = (F.col("size") < 2.0**62) & F.forall("q", lambda x: F.abs(x) < 2.0**62) & F.forall("v", lambda x: F.abs(x) < 2.0**62)
    as_longs = total(F.zip_with("q", "v", lambda x, y: x.cast("long") * y.cast("long")), "long")
    nearest = F.when(F.abs("wide") < 2.0**63, F.col("wide").cast("long")).when(F.col("wide") > 0, F.lit(2**63 - 1)).otherwise(F.lit(-(2**63)))
    score = F.when(F.col("size") < 2.0**53, F.col("wide").cast("long")).when(long_fits, as_longs).otherwise(nearest)
    slack = F.when(F.col("size") < 2.0**53, F.lit(0.0)).otherwise(F.col("size") * (F.size("v") + 8) * 2.0**-51)
    return joined.select("query", "query_id", "row", "ids", score.alias("score"), "wide", slack.alias("slack"))


def top_k(vectors: DataFrame, *, k: int = 5, bits: int = 7, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, its k best others."""
    rows = keyed(vectors, id_col, vector_col)
    classes = written(vector_classes(rows, k), "va-exact")
    chosen = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "h1", "h2").agg(F.first("v").alias("v"))
    queries = written(chosen.select(F.monotonically_increasing_id().alias("query"), F.col("vec_id").alias("query_id"), F.size("v").alias("dim"), "v"), "va-asked")
    asked = beside(queries)
    cells, grid = approximations(classes, bits)
    bounds = written(scan(cells, grid, query_blocks(queries), k, bits), "va-bounds")
    # lower bounds of all blocks together: what cannot be among the k best any more is never read
    best = best_of(bounds, "query", [F.desc("lower")], k)
    kth = written(best.groupBy("query").agg(F.min("lower").alias("least"), F.count("*").alias("have")), "va-least")
    n = kth.count()
    left = bounds.join(small(kth, n), "query").where((F.col("have") < k) | (F.col("upper") >= F.col("least")))
    left = written(left.select("query", "row", "upper"), "va-left")
    first = best_of(left, "query", [F.desc("upper"), F.col("row")], 2 * k).drop("upper")
    first = written(exact_scores(first, asked, classes), "va-first")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.desc("wide")))  # 2k rows a query
    sure = written(first.withColumn("n", nth).where(F.col("n") == k).select("query", (F.col("wide") - F.col("slack")).alias("sure")), "va-sure")
    rest = left.join(small(sure, n), "query").where(F.col("upper") >= F.col("sure")).select("query", "row").join(first.select("query", "row"), ["query", "row"], "left_anti")
    found = first.unionByName(exact_scores(rest, asked, classes))
    each = found.select("query_id", "row", "score", "wide", F.explode("ids").alias("vec_id")).where(~F.col("vec_id").eqNullSafe(F.col("query_id")))
    beyond = F.when(F.abs("wide") >= 2.0**63, F.col("wide")).otherwise(0.0)
    return best_of(each, "query_id", [F.desc("score"), F.desc(beyond), F.col("vec_id").isNull(), F.col("vec_id")], k, "rank").select("query_id", "rank", "vec_id", "score")


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.e) = len(c.e)
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""
