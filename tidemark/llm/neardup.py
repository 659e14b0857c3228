"""Near-duplicate records with small edits (problem 4).

Exact copies are folded to their smallest key first. Fingerprints then go to overlapping shards, one per band key of
their minwise signature, and each shard is searched by vantage-point partitioning in Hamming space (vptree.py), so that
only pairs within the radius leave a shard; their exact Jaccard index decides. One vantage-point tree over the whole
collection could not prune: distances between unrelated fingerprints concentrate (median 96 of 200 bits, nearly all
between 70 and 130) while the radius has to be 56, so every ball's boundary shell holds every point; shards by band
keep the triangle bounds for where they cut. Shards up to SMALL members are compared at once and only larger ones are
partitioned; the README says how many those are. A shard above HOT members is cut into parts and searched part against
part in separate tasks, so no key gathers an unbounded group. Pairs of copies are expanded last, PART members at a time.

Defined results: null texts belong to no group and no pair; texts under MIN_WORDS words form no pair, equal ones
neither, but equal ones share a group; keys are unique (a row repeated with the same text counts once).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import minwise
from tidemark.llm.vptree import near_pairs
from tidemark.session import drop_path, durable, durable_path

#: Members of a shard that one task takes; larger shards are split into parts of this size.
HOT = 8192
#: Members of a shard up to which all pairs are compared without partitioning.
SMALL = 16
#: Copies of one text that one task expands against as many others.
PART = 512
FP = ["f0", "f1", "f2", "f3"]


def _search(id_type: T.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rb: pa.Table) -> Iterator[pa.RecordBatch]:
            key, side = rb.column(0).to_numpy(), rb.column(1).to_numpy()
            ids = rb.column(2).combine_chunks() if isinstance(rb.column(2), pa.ChunkedArray) else rb.column(2)
            fp = np.stack([rb.column(3 + i).to_numpy() for i in range(4)], axis=1).view(np.uint64)
            cut = np.concatenate(([0], np.nonzero(np.diff(key))[0] + 1, [len(key)]))
            size = np.diff(cut)
            left, right = [], []
            for m in np.unique(size[(size > 1) & (size <= SMALL)]):  # small shards of one size at once
                rows = cut[:-1][size == m][:, None] + np.arange(m)
                i, j = np.triu_indices(m, 1)
                for lo in range(0, len(rows), 4096):
                    x, y = rows[lo : lo + 4096, i].reshape(-1), rows[lo : lo + 4096, j].reshape(-1)
                    near = (np.bitwise_count(fp[x] ^ fp[y]).sum(axis=1) <= minwise.RADIUS) & ((side[x] == 2) | (side[x] != side[y]))
                    left.append(x[near])
                    right.append(y[near])
            for g in np.nonzero(size > SMALL)[0]:
                lo, hi = cut[g], cut[g + 1]
                x, y = near_pairs(fp[lo:hi], minwise.RADIUS, side[lo:hi])
                left.append(x + lo)
                right.append(y + lo)
            if left and sum(map(len, left)):
                x, y = pa.array(np.concatenate(left)), pa.array(np.concatenate(right))
                yield pa.RecordBatch.from_arrays([_flat(ids.take(x)), _flat(ids.take(y))], names=["x", "y"])

        for b in batches:
            if not b.num_rows:
                continue
            key = b.column(0).to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if last or (held and held[-1].column(0)[0].as_py() != key[0]):
                yield from flush(pa.Table.from_batches([*held, b.slice(0, last)]))
                held = []
            held.append(b.slice(last))
        if held:
            yield from flush(pa.Table.from_batches(held))

    return run, T.StructType([T.StructField("x", id_type), T.StructField("y", id_type)])


def _flat(a):
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def hot_keys(bands: DataFrame, most: int | None = None) -> DataFrame:
    """(key, n) of keys that more than `most` rows share, at most rows / most of them; written, so that Spark knows their
    size and chooses the join by it."""
    return durable(bands.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > (most or HOT)), "hot-keys")


def shard_pairs(bands: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Distinct pairs (a, b), a < b, that share a shard and lie within the radius. bands has (key, id, f0..f3); sizes:
    their hot keys, where they are known."""
    sizes = hot_keys(bands) if sizes is None else sizes
    parts = bands.join(sizes, "key", "left").withColumn("p", F.coalesce(F.ceil(F.col("n") / HOT), F.lit(1)).cast("int"))
    cold = parts.filter("p = 1").select("key", F.lit(2).cast("byte").alias("side"), "id", *FP)
    hot = parts.filter("p > 1").withColumn("own", F.pmod(F.xxhash64("id"), F.col("p")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("p") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")).cast("byte")
    block = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    rows = cold.unionByName(hot.select(block.alias("key"), side.alias("side"), "id", *FP))
    run, schema = _search(bands.schema["id"].dataType)
    got = rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)
    return got.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def folded(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(signed, members): signatures of all texts with their digest, and (id, rep, long) of every document with a text.

    Only digests are shuffled to fold copies; a hot text becomes one row per map task before that. long: MIN_WORDS
    words or more.
    """
    src = docs.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("t"), F.sha2(F.col(text), 256).alias("digest"))
    signed = durable(minwise.sign(src, ["id", "digest"], "t"), "signed")
    reps = signed.groupBy("digest").agg(F.min("id").alias("rep"))
    members = signed.select("id", "digest", F.col("f0").isNotNull().alias("long")).join(reps, "digest").select("id", "rep", "long").distinct()
    return signed, durable(members, "members")


def rep_pairs(docs: DataFrame, key: str, text: str, signed: DataFrame, members: DataFrame) -> DataFrame:
    """Similar pairs (a, b), a < b, of representatives."""
    reps = members.filter("id = rep").select("id")
    bands = signed.filter("f0 is not null").join(reps, "id", "left_semi").select(F.explode("keys").alias("key"), "id", *FP)
    pairs = durable(shard_pairs(durable(bands, "bands")), "near")
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).filter("t is not null")
    return minwise.verified(pairs, texts, texts, "a", "b")


def expanded(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of members from pairs of representatives, and of each representative's own members.

    Members of one representative are cut into parts of about PART, and a join key is a pair of parts, so a text with
    many copies is expanded by many tasks.
    """
    size = members.groupBy("rep").agg(F.ceil(F.count("*") / PART).cast("int").alias("p"), F.count("*").alias("n"))
    placed = members.join(size, "rep").select("id", "rep", F.pmod(F.xxhash64("id"), F.col("p")).cast("int").alias("part"))
    parts = lambda k: size.select(F.col("rep").alias(k), F.explode(F.sequence(F.lit(0), F.col("p") - 1)).alias(f"p{k}"))
    own = size.filter("n > 1").select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    blocks = pairs.select("a", "b").unionByName(own).join(parts("a"), "a").join(parts("b"), "b").filter("a <> b or pa <= pb")
    m = lambda k, x: placed.select(F.col("rep").alias(k), F.col("part").alias(f"p{k}"), F.col("id").alias(x))
    both = blocks.join(m("a", "x"), ["a", "pa"]).join(m("b", "y"), ["b", "pb"])
    return both.filter("a <> b or pa < pb or x < y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def similar_pairs(docs: DataFrame, key: str = "ord", text: str = "texto") -> DataFrame:
    """All pairs (a, b), a < b, of similar documents, copies included, as TESTDATA.md asks for them."""
    signed, members = folded(docs, key, text)
    return expanded(durable(rep_pairs(docs, key, text, signed, members), "similar"), members.filter("long"))


def copies(docs: DataFrame, key: str = "ord", text: str = "texto") -> DataFrame:
    """(key, primeiro, n) of every document with a text: the smallest key with the same text, and how many have it."""
    _, members = folded(docs, key, text)
    size = members.groupBy("rep").agg(F.count("*").alias("n"))
    return members.join(size, "rep").select(F.col("id").alias(key), F.col("rep").alias("primeiro"), "n")


def groups(docs: DataFrame, key: str = "ord", text: str = "texto") -> DataFrame:
    """(key, group_id, n_links) of every document with a text: components of similar representatives, named by their
    smallest key; n_links counts the representatives a document's own one is similar to."""
    signed, members = folded(docs, key, text)
    edges = durable(rep_pairs(docs, key, text, signed, members), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = components(both)
    links = both.groupBy("a").agg(F.count("*").alias("n_links"))
    out = members.join(label.select(F.col("id").alias("rep"), "label"), "rep", "left").join(links.select(F.col("a").alias("rep"), "n_links"), "rep", "left")
    return out.select(F.col("id").alias(key), F.coalesce("label", "rep").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def components(both: DataFrame) -> DataFrame:
    """(id, label) of the endpoints of symmetric edges (a, b): smallest id of each component.

    Every round takes the smallest label among neighbours and then jumps to the label's own label, so paths halve;
    rounds are written to the shared folder and stop when no label changes.
    """
    spark = both.sparkSession
    start = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label"))
    at = durable_path(start, "labels")
    while True:
        label = spark.read.parquet(at).select("id", "label")
        seen = both.join(label.select(F.col("id").alias("b"), F.col("label").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        near = label.join(seen.withColumnRenamed("a", "id"), "id", "left").select("id", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = label.select(F.col("id").alias("label"), F.col("label").alias("far"))
        before, at = at, durable_path(near.join(jump, "label", "left").select("id", "old", F.least("label", "far").alias("label")), "labels")
        drop_path(spark, before)
        new = spark.read.parquet(at)
        if new.filter("label <> old").isEmpty():
            return new.select("id", "label")
