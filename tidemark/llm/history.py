"""Deduplicating new batches against all history (problem 3).

`HistoryIndex` keeps, below a root in a shared folder, the minwise band keys of everything seen, each with its document's
fingerprint. The keys lie in a table bucketed by key hash, so a probe joins a batch with it bucket by bucket: the batch
is shuffled to the buckets, the history is not, and only the partitions of the batch's own keys are read. A batch is
signed once, probes, its candidate pairs are verified by the exact Jaccard index, and its keys are appended, those of
accepted rows and those of rows already known apart (`aceito`). No text is signed twice while the root is kept, and a
batch that is run again replaces its own part.

`known` joins this with the exact rules: page identity and text hash against the catalogue and earlier rows, text hash
and source id against the saved state of a source. TESTDATA.md counts earlier rows whether or not they are duplicates
themselves, so a probe reads the keys of known rows too; `accepted_only` leaves them out.

Defined results: a null address, hash, source id or text matches nothing by that rule; texts under MIN_WORDS words are
compared by hash alone; rows with equal text share one signature, the earliest row standing for them; rows without a
batch number come last.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import url as U
from tidemark.llm import minwise
from tidemark.llm.neardup import FP, HOT, hot_keys, shard_pairs
from tidemark.session import drop_path, durable, make_path, path_exists, scratch, step

#: Buckets of the key table, and partitions by key within a batch; a large history needs thousands of buckets.
BUCKETS, PARTS = 8, 1


class HistoryIndex:
    """Band keys with fingerprints of all batches so far, below `root`.

    keys: slot, id, aceito, f0..f3 by batch and part, bucketed by slot, the hash of a band key. hot: keys that more than
    HOT rows of a batch share; their rows are spread over several slots, all of which a probe asks for. done: what is
    indexed. texts: those texts that no table of documents keeps.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = BUCKETS, parts: int = PARTS):
        self.spark, self.root, self.buckets, self.parts = spark, root or scratch(spark, "history"), buckets, parts
        self.table = f"tidemark_history_{sha256(self.root.encode()).hexdigest()[:16]}"
        make_path(spark, f"{self.root}/keys")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (slot BIGINT, id STRING, aceito BOOLEAN, f0 BIGINT, f1 BIGINT, f2 BIGINT, f3 BIGINT, batch STRING, part INT) "
            f"USING parquet PARTITIONED BY (batch, part) CLUSTERED BY (slot) INTO {buckets} BUCKETS LOCATION '{self.root}/keys'"
        )
        spark.sql(f"MSCK REPAIR TABLE {self.table}")  # what earlier sessions appended

    def _side(self, name: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.root}/{name}")

    def indexed(self) -> DataFrame:
        """(id) of everything indexed, texts too short for keys included."""
        return self._side("done", "id string")

    def _hot(self) -> DataFrame | None:
        """(key, parts) of the hot keys of all batches, at most rows / HOT of them; None where there are none."""
        return self._side("hot", "key long, parts int") if path_exists(self.spark, f"{self.root}/hot") else None

    def _slots(self, bands: DataFrame, hot: DataFrame | None, which) -> DataFrame:
        if hot is None:  # as nearly always: then no row has to meet anything
            rows = bands.withColumns({"parts": F.lit(1), "salt": F.lit(0)})
        else:
            rows = bands.join(hot.groupBy("key").agg(F.max("parts").alias("parts")), "key", "left").withColumn("salt", which(F.coalesce("parts", F.lit(1))))
        slot = F.when(F.col("salt") == 0, F.col("key")).otherwise(F.xxhash64("key", "salt"))
        return rows.withColumn("slot", slot).withColumn("part", F.pmod(F.shiftrightunsigned("slot", 17), F.lit(self.parts)).cast("int")).drop("key", "parts", "salt")

    def append(self, signed: DataFrame, batch: str, hot: DataFrame | None = None, named: bool = True) -> None:
        """Add (id string, aceito, f0..f3, keys) as a batch; what an earlier attempt of the same batch left is replaced.

        hot: the batch's hot keys, where they are known. named: whether `indexed` has to know the batch's ids.
        """
        self.forget(batch)
        bands = signed.filter("f0 is not null").select(F.explode("keys").alias("key"), "id", "aceito", *FP)
        hot = (hot_keys(bands, HOT) if hot is None else hot).select("key", F.ceil(F.col("n") / HOT).cast("int").alias("parts"))
        hot = None if hot.isEmpty() else hot
        if hot is not None:
            hot.write.mode("overwrite").parquet(f"{self.root}/hot/batch={batch}")
        rows = self._slots(bands, hot, lambda n: F.pmod(F.xxhash64("id"), n).cast("int"))
        rows = rows.select("slot", "id", "aceito", *FP, F.lit(batch).alias("batch"), "part")
        # the exchange is the table's own, so each task writes the files of its own bucket
        rows.repartition(self.buckets, "slot").write.insertInto(self.table)
        if named:
            signed.select("id").write.mode("overwrite").parquet(f"{self.root}/done/batch={batch}")

    def keep_texts(self, texts: DataFrame, batch: str) -> None:
        """Keep (id, t) of a batch, to verify later ones against."""
        texts.select("id", "t").write.mode("overwrite").parquet(f"{self.root}/texts/batch={batch}")

    def texts(self) -> DataFrame:
        return self._side("texts", "id string, t string")

    def forget(self, batch: str) -> None:
        for name in ("done", "hot"):
            drop_path(self.spark, f"{self.root}/{name}/batch={batch}")
        if path_exists(self.spark, f"{self.root}/keys/batch={batch}"):
            for p in range(self.parts):
                self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (batch = '{batch}', part = {p})")
            drop_path(self.spark, f"{self.root}/keys/batch={batch}")

    def probe(self, signed: DataFrame, accepted_only: bool = False) -> DataFrame:
        """Distinct (id, other) of batch rows and indexed rows that share a key and lie within the radius.

        The table side of the join has no exchange; its partitions are pruned to those that the batch's keys fall in.
        """
        bands = signed.filter("f0 is not null").select(F.explode("keys").alias("key"), "id", *FP)
        new = self._slots(bands, self._hot(), lambda n: F.explode(F.sequence(F.lit(0), n - 1)))
        old = self.spark.table(self.table)
        if self.parts > 1:
            hit = sorted(r.part for r in new.select("part").distinct().collect())  # at most `parts` rows
            old = old.filter(F.col("part").isin(hit))
        if accepted_only:
            old = old.filter("aceito")
        n, o = new.alias("n").hint("shuffle_hash"), old.alias("o")
        near = n.join(o, (F.col("n.slot") == F.col("o.slot")) & (minwise.hamming("n", "o") <= minwise.RADIUS))
        return near.select(F.col("n.id").alias("id"), F.col("o.id").alias("other")).distinct()

    def close(self) -> None:
        """Take the table out of the session's catalogue; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _repeated(rows: DataFrame, value: str, order: str) -> DataFrame:
    """Rows that aren't the first of their value. First rows are taken out by their own number, so that a value which many
    rows share is never a join key; it folds before the shuffle."""
    some = rows.filter(F.col(value).isNotNull())
    return some.join(some.groupBy(value).agg(F.min(order).alias(order)).select(order), order, "left_anti")


def exact(batch: DataFrame, catalog: DataFrame, saves: DataFrame) -> DataFrame:
    """cand_no of rows known by page identity, text hash or source id."""
    rows = batch.filter(F.col("cand_no").isNotNull()).select("cand_no", "id_na_fonte", F.nullif("hash_texto", F.lit("")).alias("hash_texto"), U.identity(F.nullif("url", F.lit(""))).alias("page"))
    rows = durable(rows, "batch-keys")
    seen = saves.select(F.explode("vistos").alias("k", "h"))
    hashes = catalog.select(F.col("hash_texto").alias("v")).unionByName(seen.select(F.col("h").alias("v"))).filter("v <> ''").distinct()
    by = [
        rows.join(catalog.select(F.col("id").alias("page")).filter("page <> ''"), "page", "left_semi"),
        rows.join(hashes.withColumnRenamed("v", "hash_texto"), "hash_texto", "left_semi"),
        rows.join(seen.select(F.col("k").alias("id_na_fonte")).distinct(), "id_na_fonte", "left_semi"),
        _repeated(rows, "page", "cand_no"),
        _repeated(rows, "hash_texto", "cand_no"),
    ]
    out = by[0].select("cand_no")
    for x in by[1:]:
        out = out.unionByName(x.select("cand_no"))
    return out.distinct()


def _name(kind: str, key: str) -> Column:
    return F.concat(F.lit(kind), F.col(key).cast("string"))


def index_history(index: HistoryIndex, accepted: DataFrame) -> int:
    """Sign and append those accepted texts that aren't indexed yet, each distinct text once; returns how many that were.

    A kept index therefore signs nothing on a second call with the same history.
    """
    rows = accepted.filter("texto is not null and ord is not null").select("ord", "texto", F.sha2("texto", 256).alias("digest"))
    first = rows.groupBy("digest").agg(F.min("ord").alias("ord")).select("ord", _name("d", "ord").alias("id"))
    new = durable(first.join(index.indexed(), "id", "left_anti"), "unsigned")
    n = new.count()
    if n:
        bounds = new.agg(F.min("ord"), F.max("ord")).first()
        signed = minwise.sign(rows.join(new, "ord").select("id", "texto"), ["id"], "texto")
        index.append(durable(signed.withColumn("aceito", F.lit(True)), "signed"), f"history-{bounds[0]}-{bounds[1]}-{n}")
    return n


def near(index: HistoryIndex, lot: DataFrame, stored: DataFrame, known_rows: DataFrame, batch: str) -> DataFrame:
    """cand_no of those rows of one batch whose text is similar to one in the index or to an earlier row of the batch.

    stored: (id, t) of the documents in the index, by their names there; known_rows: cand_no known otherwise. The batch
    is appended to the index before this returns.
    """
    src = lot.filter("texto is not null").select(F.col("cand_no").alias("no"), "texto", F.sha2("texto", 256).alias("digest"))
    signed = durable(minwise.sign(src, ["no", "digest"], "texto"), "batch-signed")
    reps = signed.groupBy("digest").agg(F.min("no").alias("rep"), F.bool_or(F.col("f0").isNotNull()).alias("long"))
    members = durable(signed.select("no", "digest").join(reps, "digest").select("no", "rep", "long"), "members")
    unique = durable(signed.join(members.filter("no = rep").select("no"), "no", "left_semi").withColumn("id", _name("c", "no")), "unique")
    index.keep_texts(src.join(members.filter("long and no = rep").select("no"), "no", "left_semi").select(_name("c", "no").alias("id"), F.col("texto").alias("t")), batch)
    texts = stored.unionByName(index.texts())
    number = F.expr("cast(substring(other, 2) as bigint)")
    to_old = index.probe(unique).filter(~F.startswith("other", F.lit("c")) | (number < F.expr("cast(substring(id, 2) as bigint)")))
    bands = unique.filter("f0 is not null").select(F.explode("keys").alias("key"), F.col("no").alias("id"), *FP)
    hot = hot_keys(bands)
    among = shard_pairs(bands, hot)
    pairs = durable(to_old.select(F.col("id").alias("x"), F.col("other").alias("y")).unionByName(among.select(_name("c", "b").alias("x"), _name("c", "a").alias("y"))), "candidates")
    got = minwise.verified(pairs, texts, texts, "x", "y").select(F.expr("cast(substring(x, 2) as bigint)").alias("rep"), F.col("y").alias("other"))
    # all rows of x follow what is in the index; of two texts of this batch, those rows that follow the other's first one
    got = durable(got.withColumn("after", F.when(F.startswith("other", F.lit("c")), F.expr("cast(substring(other, 2) as bigint)")).otherwise(-1)), "alike")
    turned = got.filter("after >= 0").select(F.col("after").alias("rep"), F.col("rep").alias("after"))
    bound = got.select("rep", "after").unionByName(turned).groupBy("rep").agg(F.min("after").alias("after"))
    found = members.join(bound, "rep", "left").filter("(long and no > rep) or no > after")
    out = durable(found.select(F.col("no").alias("cand_no")), "near", lasting=True)
    refused = out.unionByName(known_rows.select("cand_no")).distinct().select(F.col("cand_no").alias("no"), F.lit(False).alias("aceito"))
    index.append(unique.join(refused, "no", "left").select("id", F.coalesce("aceito", F.lit(True)).alias("aceito"), *FP, "keys"), batch, hot, named=False)
    return out


def known(batch: DataFrame, catalog: DataFrame, documents: DataFrame, saves: DataFrame, root: str | None = None) -> DataFrame:
    """(cand_no) of the rows of `lotes` that are already known, exactly or nearly.

    The batches are processed one after the other, in order of `lote`: each is held against the index as the batches
    before left it, and then appended. root: where the index is kept; None takes a fresh one that goes with the session.
    """
    spark = batch.sparkSession
    index = HistoryIndex(spark, root)
    accepted = documents.join(catalog.filter("hash_texto <> ''").select("hash_texto").distinct(), "hash_texto", "left_semi")
    index_history(index, accepted)
    rows = batch.filter(F.col("cand_no").isNotNull())
    by_rule = durable(exact(rows, catalog, saves), "exact")
    stored = documents.filter("texto is not null and ord is not null").select(_name("d", "ord").alias("id"), F.col("texto").alias("t"))
    out = by_rule
    numbers = rows.select("lote").distinct().orderBy(F.col("lote").asc_nulls_last()).collect()  # one row per batch
    for r in numbers:
        lot = rows.filter(F.col("lote").eqNullSafe(F.lit(r.lote)))
        with step(spark):
            got = near(index, lot, stored, by_rule.join(lot.select("cand_no"), "cand_no", "left_semi"), f"lote-{r.lote}")
        out = out.unionByName(got)
    index.close()
    return out.distinct()
