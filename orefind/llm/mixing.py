"""A mixture of sources with target shares of its tokens.

Token counts come from one pass over the texts. Each source is cut into shards by a seeded hash, and each shard, in
seeded order, into blocks of about equal tokens. Sainte-Laguë apportionment hands the blocks of the mixture to the
sources by highest quotients, then each source's blocks to its shards, so all choices are whole numbers known before any
record is chosen; a block beyond a shard's own starts its next repetition.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orefind.llm.tokens import encoder, vocabulary_path
from orefind.sources.shared import written


def apportion(weights: dict, seats: int) -> dict:
    """Seats by Sainte-Laguë: each in turn to the highest weight / (2 s + 1), s being the seats held; ties go to the
    smaller key. Null, zero and negative weights hold none."""
    held = {k: 0 for k in weights}
    real = {k: w for k, w in weights.items() if w and w > 0}
    whole = sum(real.values())
    if not real or seats <= 0:
        return held
    for k, w in real.items():  # highest quotients give everyone at least about this: no need to hand it out one by one
        held[k] = max(0, int(seats * w / whole) - len(real))
    queue = [(-w / (2 * held[k] + 1), k) for k, w in real.items()]
    heapq.heapify(queue)
    for _ in range(seats - sum(held.values())):
        _, k = heapq.heappop(queue)
        held[k] += 1
        heapq.heappush(queue, (-real[k] / (2 * held[k] + 1), k))
    return held


def token_sizes(df: DataFrame, id_col: str, text_col: str, keep: list[str], path: str | None = None) -> DataFrame:
    """``id_col``, ``keep`` and tokens (bigint), the number of tokens of the text; 0 for null and empty texts."""
    file = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(file)
        for batch in batches:
            sizes = pa.array([len(enc.encode(t)) for t in batch.column("__text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), sizes], [*batch.schema.names[:-1], "tokens"])

    kinds = dict(df.dtypes)
    rows = df.select(*(F.col(f"`{c}`") for c in (id_col, *keep)), F.col(f"`{text_col}`").cast("string").alias("__text"))
    return rows.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in (id_col, *keep)) + ", tokens bigint")


def source_tokens(sizes: DataFrame) -> DataFrame:
    """source, tokens, records: one row a source, written, so that what is asked of the sources reads no text again."""
    return written(sizes.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("records")), "sources")


def source_report(own: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source of ``targets``: source, target_share, max_repeats, tokens, all_tokens, wanted_tokens, reachable; ``own`` is source_tokens.

    A source without records has 0 tokens. reachable is false where target_share times the tokens of all records, those of
    sources without a target included, is more than max_repeats times the source's tokens. A null share counts as 0, a
    null or negative max_repeats as 0. Repeated rows of ``targets`` count once.
    """
    whole = own.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("bigint").alias("all_tokens"))
    wanted = targets.select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).cast("bigint").alias("max_repeats")).dropDuplicates(["source"])
    rows = wanted.join(own.select("source", "tokens"), "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0).cast("bigint")))
    rows = rows.join(F.broadcast(whole)).withColumn("wanted_tokens", F.col("target_share") * F.col("all_tokens"))  # one row
    return rows.withColumn("reachable", F.col("wanted_tokens") <= F.col("max_repeats") * F.col("tokens"))


def source_quotas(own: DataFrame, targets: DataFrame, blocks: int = 20_000) -> DataFrame:
    """source_report with blocks (the mixture's in all), quota (those that Sainte-Laguë gives the source by target_share) and most (those
    that its tokens fill, each taken max_repeats times, a last part of one counted as one).

    A quota is less than a block away from what is wanted or, of many sources, a few: a source whose quota comes near ``most``, or is
    beyond it, can't reach its target or is checked by its tokens, which is what ``reachable`` says. Targets are a row a source that is to be mixed.
    """
    rows = [r.asDict() for r in source_report(own, targets).collect()]
    schema = "source string, target_share double, max_repeats bigint, tokens bigint, all_tokens bigint, wanted_tokens double, reachable boolean, blocks bigint, quota bigint, most bigint"
    whole = rows[0]["all_tokens"] if rows else 0
    blocks = min(blocks, whole)
    shares = {r["source"]: r["target_share"] for r in rows}
    # shares may leave a part to nobody, and need not add up to 1
    quota = apportion(shares | {"": max(0.0, 1 - sum(shares.values()))}, round(blocks * max(1.0, sum(shares.values()))))
    near = len(rows) + 2
    for r in rows:
        r["blocks"], r["quota"] = blocks, quota[r["source"]]
        r["most"] = -(-r["max_repeats"] * r["tokens"] * blocks // whole) if whole else 0
        r["reachable"] = r["reachable"] if r["quota"] + near > r["most"] else True
    return own.sparkSession.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)


def mixture(sizes: DataFrame, targets: DataFrame, id_col: str, blocks: int = 20_000, shard_tokens: int = 1 << 26, seed: int = 7) -> DataFrame:
    """``id_col``, source, tokens, copies: how often each record stands in the mixture, records with no copy left out.

    The mixture is as large as all records together, in ``blocks`` blocks of equal tokens. Sainte-Laguë gives each
    source its blocks by target_share. A source that can't reach its target gives all its records max_repeats times; what it can't
    give isn't given to others. Another source's blocks go to its shards, of about ``shard_tokens`` each, by their tokens; a shard's blocks
    are taken in seeded order, all of them before any a second time. Records without tokens have no copy. Records of
    equal id and source are ordered as one and share their copies. What reaches the driver is a row a source and shard.
    """
    plan = source_quotas(source_tokens(sizes), targets, blocks)
    known = {r["source"]: r for r in plan.collect() if r["tokens"]}
    if not known:
        return sizes.select(id_col, "source", "tokens", F.lit(0).cast("bigint").alias("copies")).limit(0)
    whole, blocks = next(iter(known.values()))["all_tokens"], next(iter(known.values()))["blocks"]
    spark, size = sizes.sparkSession, whole / blocks
    full = spark.createDataFrame([(s, r["max_repeats"]) for s, r in known.items() if not r["reachable"]], "source string, copies bigint")
    every = sizes.filter("tokens > 0").join(F.broadcast(full), "source").filter("copies > 0").select(id_col, "source", "tokens", "copies")
    cuts = spark.createDataFrame([(s, max(1, -(-r["tokens"] // shard_tokens))) for s, r in known.items() if r["reachable"]], "source string, __shards bigint")
    placed = sizes.filter("tokens > 0").join(F.broadcast(cuts), "source").withColumn("__shard", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.col("__shards"))).drop("__shards")
    order = Window.partitionBy("source", "__shard").orderBy(F.xxhash64(F.col(id_col), F.lit(seed + 1)), F.col(id_col))
    middle = F.sum("tokens").over(order) - F.col("tokens") / 2
    parts: dict[str, dict[int, int]] = {}
    for r in placed.groupBy("source", "__shard").agg(F.sum("tokens").alias("tokens")).collect():
        parts.setdefault(r["source"], {})[r["__shard"]] = r["tokens"]
    placed = placed.withColumn("__block", F.floor(middle / size))
    rows = []
    for s, own in parts.items():
        most = known[s]["max_repeats"]
        for shard, q in apportion(own, min(known[s]["quota"], known[s]["most"])).items():
            times, rest = divmod(min(q * size, most * own[shard]), own[shard])
            rows.append((s, shard, int(times), round(rest / size)))
    chosen = spark.createDataFrame(rows, "source string, __shard bigint, __whole bigint, __rest bigint")
    copies = F.col("__whole") + F.when(F.col("__block") < F.col("__rest"), 1).otherwise(0)
    out = placed.join(F.broadcast(chosen), ["source", "__shard"]).withColumn("copies", copies.cast("bigint"))
    return out.filter("copies > 0").select(id_col, "source", "tokens", "copies").unionByName(every)


def mixture_shares(mixed: DataFrame, report: DataFrame) -> DataFrame:
    """source, target_share, tokens, max_repeats, reachable, mixed_tokens, actual_share of each source of the targets; actual_share is of the mixture."""
    own = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"))
    own = written(own, "mixed")
    whole = own.agg(F.sum("mixed_tokens")).scalar()
    rows = report.join(own, "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0).cast("bigint")))
    return rows.select("source", "target_share", "tokens", "max_repeats", "reachable", "mixed_tokens", F.coalesce(F.col("mixed_tokens") / whole, F.lit(0.0)).alias("actual_share"))
