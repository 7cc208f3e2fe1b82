"""Temperature mixing of sources.

A source's share p of all tokens becomes the weight p^a / sum p^a. At a = 1 the mix is the corpus as it is,
towards 0 all sources weigh the same. The exponent is bisected (16 parts a round) to the wanted entropy of the
weights, given as a share of the largest one, and raised where needed until no source is repeated more than
`max_epochs` times. The budget is that of the corpus, or with cover=True the least one at which every
document is drawn at least once.

The weights are realised by block permutations. Each source is cut into blocks of about BLOCK_DOCS documents by
a hash; an epoch is a permutation of the blocks (by a hash of seed, epoch and block), and inside a block a permutation of
its documents. Whole epochs draw everything; the last one draws blocks in order until the source's budget is
used up, and documents of the one block that crosses it. So a source's draws are within one document of its budget.

Tokens are counted as words plus one end mark. A null source counts as the empty one. Null text is empty.
Repeated rows are drawn one by one; null ids are allowed. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import row_key, stored, text_of

BLOCK_DOCS = 1000
ROUNDS, PARTS = 8, 16


def token_count(text_col: str = "text") -> Column:
    trimmed = F.trim(F.regexp_replace(text_of(text_col), r"[\x09-\x0D ]+", " "))
    return (F.octet_length(trimmed) - F.octet_length(F.replace(trimmed, F.lit(" "), F.lit("")))
            + F.when(trimmed == "", 0).otherwise(1) + 1).cast("long")


def _curve(stats: DataFrame, exponents: list[float], cover: bool) -> dict[float, tuple[float, float]]:
    """exponent -> (entropy of the weights, largest number of epochs), over all sources."""
    a = F.explode(F.array(*[F.lit(float(x)) for x in exponents])).alias("a")
    powered = stats.select(a, "p").withColumn("q", F.pow("p", "a"))
    rows = powered.groupBy("a").agg(
        F.sum("q").alias("z"), F.sum(F.col("q") * F.col("a") * F.log("p")).alias("s"),
        F.max(F.col("q") / F.col("p")).alias("most"), F.min(F.col("q") / F.col("p")).alias("least")).collect()
    return {r["a"]: (math.log(r["z"]) - r["s"] / r["z"], r["most"] / (r["least"] if cover else r["z"])) for r in rows}


def _smallest(ok, low: float, high: float) -> float:
    """Smallest exponent in [low, high] for which `ok` (true from some exponent on) holds, by repeated cutting."""
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / PARTS for i in range(PARTS + 1)]
        fine = ok(grid)
        first = next((i for i, x in enumerate(grid) if fine[x]), PARTS)
        low, high = grid[max(0, first - 1)], grid[first]
    return high


def find_exponent(stats: DataFrame, entropy: float | None, max_epochs: float | None, cover: bool) -> float:
    """stats: source, p. Entropy and epochs fall as the exponent grows from 0 to 1."""
    n = stats.count()
    if n < 2:
        return 1.0
    least = 0.0
    if entropy is not None:
        goal = entropy * math.log(n)
        least = _smallest(lambda g: {a: h <= goal for a, (h, _) in _curve(stats, g, cover).items()}, 0.0, 1.0)
    if max_epochs is not None:
        limit = max_epochs * (1 + 1e-12)
        least = max(least, _smallest(lambda g: {a: e <= limit for a, (_, e) in _curve(stats, g, cover).items()}, 0.0, 1.0))
    return least


def draw(docs: DataFrame, entropy: float | None = 0.95, max_epochs: float | None = 4.0, cover: bool = False, seed: int = 17,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per drawn document and epoch."""
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("key"),
                              token_count(text_col).alias("n_tokens")), "mix-rows")
    sums = stored(rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "mix-sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 1
    stats = sums.withColumn("p", F.col("tokens") / F.lit(float(total)))
    exponent = find_exponent(stats, entropy, max_epochs, cover)
    powered = stats.withColumn("q", F.pow("p", F.lit(exponent)))
    z = powered.agg(F.sum("q").alias("z"), F.min(F.col("q") / F.col("p")).alias("least")).first()
    norm, least = z["z"] or 1.0, z["least"] or 1.0
    epochs = F.col("q") / F.col("p") / F.lit(least if cover else norm)
    epochs = F.when(F.abs(epochs - F.round(epochs)) < 1e-9, F.round(epochs)).otherwise(epochs)
    plan = stored(powered.select(
        "key", (F.col("q") / F.lit(norm)).alias("weight"), F.floor(epochs).cast("int").alias("whole"),
        ((epochs - F.floor(epochs)) * F.col("tokens")).alias("left"),
        F.ceil(F.col("n") / F.lit(BLOCK_DOCS)).alias("blocks")), "mix-plan")

    placed = rows.join(plan, "key").withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("blocks"))).drop("blocks")
    placed = stored(placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole")))).withColumn(
        "block_key", F.xxhash64("block", "epoch", "key", F.lit(seed))).withColumn(
        "place_key", F.xxhash64("doc_id", "epoch", F.lit(seed + 1))), "mix-placed")
    blocks = placed.groupBy("key", "epoch", "block_key").agg(F.sum("n_tokens").alias("b"), F.max("left").alias("left"),
                                                            F.max("whole").alias("whole"))
    inside = Window.partitionBy("key", "epoch").orderBy("block_key")          # one row per block
    blocks = blocks.withColumn("block_rank", F.row_number().over(inside) - 1).withColumn(
        "before", F.sum("b").over(inside) - F.col("b"))
    last = F.col("epoch") == F.col("whole")
    blocks = stored(blocks.where(~last | (F.col("before") < F.col("left"))).select(
        "key", "epoch", "block_key", "block_rank", "before",
        (last & (F.col("before") + F.col("b") > F.col("left"))).alias("crosses")), "mix-blocks")
    drawn = placed.join(blocks, ["key", "epoch", "block_key"])
    columns = ["doc_id", "source", "epoch", "block_rank", "place_key", "n_tokens", "weight", F.lit(exponent).alias("exponent")]
    through = F.sum("n_tokens").over(Window.partitionBy("key", "block_key").orderBy("place_key", "doc_id"))   # one block of a source
    cut = drawn.where("crosses").withColumn("through", F.col("before") + through).where(F.col("through") <= F.col("left"))
    return drawn.where("NOT crosses").select(*columns).unionByName(cut.select(*columns))


def mix_documents(docs: DataFrame, entropy: float | None = None, max_epochs: float | None = 1.25, cover: bool = True,
                  seed: int = 17) -> DataFrame:
    """The drawn documents themselves, with the columns of `docs`: a document drawn in two epochs is there
    twice. Rows that share an id are drawn together."""
    drawn = draw(docs, entropy, max_epochs, cover, seed).groupBy(row_key("doc_id").alias("_mix_id")).agg(
        (F.max("epoch") + 1).alias("_mix_n"))
    keyed = docs.withColumn("_mix_id", row_key("doc_id"))
    return keyed.join(drawn, "_mix_id").withColumn("_mix_n", F.explode(F.sequence(F.lit(1), F.col("_mix_n")))).drop("_mix_id", "_mix_n")
