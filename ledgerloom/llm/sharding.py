"""K-d tree shards of near-equal bytes, by DataFrame operations alone.

A node of the tree is split at the weighted median (for an odd number of shards: the matching quantile) of its widest
dimension. The split is exact: a histogram pass over all rows finds the bin that holds it, further passes
refine that bin until it holds one value, and rows with that very value are split on a hash of the document in
the same way. All nodes of a level share a pass and its bins. What reaches the driver is one row a node and pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import dense_index, forget, table, written

SHARDS = 16
#: Bins that the nodes of a level share in a histogram pass, the fewest that a node gets, and bits of the hash by which rows of one value are split.
BINS, LEAST_BINS, TIE_BITS = 1 << 16, 4096, 24
#: Metadata dimensions, in the order that decides between equally wide ones: numbers as they are, names as the ranks of their values.
NUMBERS = {"k_id": "doc_id", "k_chars": "n_chars"}
NAMES = {"k_lang": "lang", "k_source": "source"}
DIMENSIONS = ["k_id", "k_lang", "k_source", "k_chars"]


def with_ranks(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """``rows`` with a column for each of ``names`` (new column: text column): the number of smaller values that occur, null being
    the smallest. The text columns are dropped."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("v")) for k, c in names.items()])).alias("p")
    values = rows.select(pairs).select("p.k", "p.v").distinct()
    ranks = written(dense_index(values, ["k"], [F.col("v").asc_nulls_first()], "rank"))
    for k, c in names.items():
        here = ranks.where(F.col("k") == k).select(F.col("v").alias("__value"), F.col("rank").alias(k))
        rows = rows.join(here, F.col(c).eqNullSafe(F.col("__value"))).drop("__value", c)
    return rows


def _of_node(values: dict[int, int]) -> Column:
    """A column that looks ``node`` up in a small map of longs."""
    pairs = [x for node, value in values.items() for x in (F.lit(node), F.lit(value).cast("long"))]
    return F.element_at(F.create_map(*pairs), F.col("node"))


def _among(nodes) -> Column:
    return _of_node({n: 1 for n in nodes}).isNotNull()


def _search(rows: DataFrame, spans: dict[int, tuple[int, int, int]]) -> dict[int, tuple[int, int, int, int]]:
    """Exact weighted quantiles. ``rows``: (node, v, size); ``spans``: node -> (lowest v, highest v, goal).

    Gives for each node the least v at which the sum of sizes reaches the goal, the sum below v, and the
    sum and the number of rows at v.
    """
    todo = {n: (low, high, goal, 0) for n, (low, high, goal) in spans.items()}
    found = {}
    while todo:
        bins = max(LEAST_BINS, BINS // len(todo))
        step = {n: -(-(high - low + 1) // bins) for n, (low, high, _, _) in todo.items()}
        low, high = _of_node({n: x[0] for n, x in todo.items()}), _of_node({n: x[1] for n, x in todo.items()})
        live = rows.where((F.col("v") >= low) & (F.col("v") <= high))  # other nodes have no bounds
        at = F.expr("(v - low) div step").alias("bin")
        sums = live.withColumn("low", low).withColumn("step", _of_node(step)).groupBy("node", at).agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("v").alias("first"), F.max("v").alias("last"))
        upto = F.sum("size").over(Window.partitionBy("node").orderBy("bin"))  # at most ``bins`` rows a node
        want = _of_node({n: x[2] - x[3] for n, x in todo.items()})
        hit = sums.withColumn("upto", upto).where(F.col("upto") >= want).groupBy("node").agg(F.min(F.struct("bin", "upto", "size", "n", "first", "last")).alias("m"))
        for r in hit.select("node", "m.*").collect():  # a row a node
            _, _, goal, below = todo.pop(r["node"])
            below += r["upto"] - r["size"]
            if r["first"] == r["last"]:
                found[r["node"]] = (r["first"], below, r["size"], r["n"])
            else:
                todo[r["node"]] = (r["first"], r["last"], goal, below)
    return found


def kd_shards(rows: DataFrame, dimensions: list[str], ties: dict[str, tuple[int, int] | None], shards: int = SHARDS) -> DataFrame:
    """``rows`` (long columns ``dimensions`` and ``ties``, size) plus ``shard`` from 0 to ``shards`` - 1.

    Rows that are equal in the splitting dimension are split by the columns ``ties`` in turn (each with its least and greatest value, or None where
    that isn't known; the first one's are known, and its least is 0). A dimension's width in a node is its range
    there over its range in all rows.
    """
    ranges = [f(F.col(d)).alias(f"{p}_{d}") for d in dimensions for p, f in (("low", F.min), ("high", F.max))]
    now = written(rows.withColumn("node", F.lit(1)))
    spread: dict[str, int] = {}
    width = {1: (0, shards)}  # node -> first shard, number of shards
    leaves: dict[int, int] = {}
    while True:
        leaves |= {n: at for n, (at, k) in width.items() if k == 1}
        width = {n: x for n, x in width.items() if x[1] > 1}
        stats = {r["node"]: r for r in now.where(_among(width)).groupBy("node").agg(F.sum("size").alias("total"), *ranges).collect()} if width else {}
        for n in set(width) - set(stats):  # no rows: any of its shards stands for all
            leaves[n] = width.pop(n)[0]
        if not width:
            break
        spread = spread or {d: max(1, stats[1][f"high_{d}"] - stats[1][f"low_{d}"]) for d in dimensions}
        axis = {n: max(dimensions, key=lambda d: ((r[f"high_{d}"] - r[f"low_{d}"]) / spread[d], -dimensions.index(d))) for n, r in stats.items()}
        goal = {n: -(-r["total"] * (width[n][1] // 2) // width[n][1]) for n, r in stats.items()}
        chosen = F.element_at(F.array(*dimensions), _of_node({n: dimensions.index(d) + 1 for n, d in axis.items()}).cast("int"))
        low, high = ({n: r[f"{end}_{axis[n]}"] for n, r in stats.items()} for end in ("low", "high"))
        # value and first tie are one number where that fits in a long, so one search finds both
        (tie, (_, last_tie)), *_ = ties.items()
        factor = {n: last_tie + 1 if (high[n] - low[n] + 1) * (last_tie + 1) < 1 << 62 else 1 for n in stats}
        joint = (chosen - _of_node(low)) * _of_node(factor) + F.col(tie) % _of_node(factor)
        spans = {n: (0, (high[n] - low[n] + 1) * factor[n] - 1, goal[n]) for n in stats}
        levels = [joint, *map(F.col, ties)]
        edges = [None, *ties.values()]
        # where differences don't fit in a long: first the halves of values, then what halving leaves
        if wide := {n: low[n] >> 1 for n in stats if high[n] - low[n] >= 1 << 62}:
            levels[:1] = [F.when(_among(wide), F.shiftright(chosen, 1) - _of_node(wide)).otherwise(joint), F.when(_among(wide), F.pmod(chosen, F.lit(2).cast("long"))).otherwise(F.lit(0).cast("long"))]
            edges[:1] = [None, (0, 1)]
            spans |= {n: (0, (high[n] >> 1) - half, goal[n]) for n, half in wide.items()}
        part, left, equal = now, F.lit(False), F.lit(True)
        for i, v in enumerate(levels):
            if i:
                part = part.where(_among(spans) & equal)
                span = edges[i]
                ends = {n: span for n in spans} if span else {r["node"]: (r["low"], r["high"]) for r in part.groupBy("node").agg(F.min(v).alias("low"), F.max(v).alias("high")).collect()}  # a row a node
                spans = {n: (*ends[n], spans[n][2]) for n in spans}
            found = _search(part.select("node", v.alias("v"), "size"), spans)
            cut = {n: x[0] for n, x in found.items()}
            more = {n: (0, 0, spans[n][2] - x[1]) for n, x in found.items() if x[3] > 1 and i < len(levels) - 1}
            # a single row, or rows that nothing tells apart, go to the side that they unbalance less
            take = {n: x[0] for n, x in found.items() if n not in more and x[1] + x[2] - spans[n][2] <= spans[n][2] - x[1]}
            at = F.coalesce(v == _of_node(cut), F.lit(False))
            below = F.coalesce(v < _of_node(cut), F.lit(False))
            if take:
                below = below | F.coalesce(v == _of_node(take), F.lit(False))
            left = left | (equal & below)
            equal, spans = equal & at, more
            if not more:
                break
        node = F.when(_among(width), 2 * F.col("node") + F.when(left, 0).otherwise(1)).otherwise(F.col("node"))
        before, now = now, written(now.withColumn("node", node))
        forget(before)
        width = {m: x for n, (at0, k) in width.items() for m, x in ((2 * n, (at0, k // 2)), (2 * n + 1, (at0 + k // 2, k - k // 2)))}
    return now.withColumn("shard", _of_node(leaves).cast("int")).drop("node")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs`` under the law ``bytes``.

    size: UTF-8 bytes of the text and one more; a null text counts and sums as an empty one. A null number counts as
    -1, a null name sorts before all names. Very long texts are rows like others, however far over a shard's share. Rows that agree in all dimensions, repeated rows included, are dealt by hash and then by position,
    so shards stay even. slot numbers a shard's rows from 0 by doc_id. An empty table gives no rows.
    """
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    crc = F.coalesce(F.crc32("text"), F.lit(0)).cast("long")
    numbers = [F.coalesce(F.col(c).cast("long"), F.lit(-1).cast("long")).alias(k) for k, c in NUMBERS.items()]
    slim = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), *numbers, *[F.col(c).cast("string").alias(f"name_{k}") for k, c in NAMES.items()])
    slim = slim.withColumn("tie_hash", F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32"), 64 - TIE_BITS)).withColumn("tie_row", F.monotonically_increasing_id())
    ranked = with_ranks(written(slim), {k: f"name_{k}" for k in NAMES})
    placed = kd_shards(ranked, DIMENSIONS, {"tie_hash": (0, (1 << TIE_BITS) - 1), "tie_row": None}, shards).select("doc_id", "size", "text_crc32", "shard", "tie_hash")
    slotted = dense_index(placed, ["shard"], [F.col("doc_id").asc_nulls_first(), F.col("tie_hash").asc()], "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
