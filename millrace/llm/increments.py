"""Deduplication of new batches against all history, by a segment index for edit distance.

A string of length l is cut into tau + 1 segments at fixed places; a string within tau edits of it holds at least one of
them unchanged, at most tau places away. The index stores the segments of accepted strings by length, number and content;
a batch probes it with its own substrings at the places where a segment can stand, and candidates are verified by their
distance. Only accepted records are stored, as only they can reject.

Here a segment's key also holds a slot of the file's size, as records with other sizes can't match: slots twice as wide
as the greatest difference, on two grids half a slot apart, so that sizes that may match share a slot of one. The same
index holds the whole hash and, for cut-off hashes, its beginning. Index entries are a key and a class's number; hashes,
sizes and records stand once per class beside them and are only read for candidates. Both are stored by buckets: a batch
reads the buckets that its own keys fall in, and keeps of them what its keys ask for.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.graph import accepted_in_order
from millrace.runtime import Table, cut

#: A key held by more strings than this is cut further before they are paired.
CROWDED = 500
#: How often, at most: each cut takes tau + 1 entries per entry. Of 64 digits 45 agree by then; what is still crowded is paired.
DEPTH = 2
#: Buckets of a stored index.
BUCKETS = 32
FULL, PREFIX, SPREAD, TAU = 64, 16, 64, 2
EQUAL, SEGMENT, HEAD = 0, 1, 2


def _bounds(length: Column, i: Column, parts: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``i``."""
    start = F.floor(length * i / F.lit(parts)).cast("int")
    stop = F.floor(length * (i + 1) / F.lit(parts)).cast("int")
    return start, stop - start


def segments(strings: DataFrame, tau: int) -> DataFrame:
    """``(s, i, key)``: the tau + 1 segments of each distinct string ``s`` of more than tau characters."""
    df = strings.select("s").where(F.length("s") > tau)
    df = df.withColumn("i", F.explode(F.array(*[F.lit(i) for i in range(tau + 1)])))
    start, n = _bounds(F.length("s"), F.col("i"), tau + 1)
    return df.select("s", "i", F.xxhash64(F.length("s"), "i", F.col("s").substr(start + 1, n)).alias("key"))


def probes(strings: DataFrame, tau: int, substitutions: bool) -> DataFrame:
    """``(s, i, key)``: the substrings of ``s`` that may be segment ``i`` of a string within tau edits.

    With ``substitutions`` only strings of the same length and the same place are meant.
    """
    if substitutions:
        return segments(strings, tau)
    df = strings.select("s", F.length("s").alias("own"))
    df = df.withColumn("len", F.explode(F.array(*[F.col("own") + x for x in range(-tau, tau + 1)]))).where(F.col("len") > tau)
    df = df.withColumn("i", F.explode(F.array(*[F.lit(i) for i in range(tau + 1)])))
    start, n = _bounds(F.col("len"), F.col("i"), tau + 1)
    df = df.withColumn("n", n).withColumn("at", F.explode(F.array(*[start + x for x in range(-tau, tau + 1)])))
    # no more edits may lie before the segment than are needed, nor after it
    d = F.col("own") - F.col("len")
    df = df.where((F.col("at") >= 0) & (F.col("at") + F.col("n") <= F.col("own")) & (F.abs(F.col("at") - start) + F.abs(d - (F.col("at") - start)) <= tau))
    return df.select("s", "i", F.xxhash64("len", "i", F.col("s").substr(F.col("at") + 1, F.col("n"))).alias("key")).distinct()


def _distance_within(a: Column, b: Column, tau: int, substitutions: bool) -> Column:
    if substitutions:
        differ = F.filter(F.sequence(F.lit(1), F.length(a)), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))
        return (F.length(a) == F.length(b)) & (F.size(differ) <= tau)
    return F.levenshtein(a, b, tau) >= 0


def _deeper(df: DataFrame, tau: int) -> DataFrame:
    """The rows of a crowded segment key, once for each part of what is left of the string, cut again into tau + 1 parts.

    With substitutions the string's rest must agree in one of them, too. A rest of at most tau characters isn't cut:
    whatever it holds, the strings are within tau.
    """
    start, n = _bounds(F.length("rest"), F.col("i"), tau + 1)
    left = F.concat(F.col("rest").substr(F.lit(1), start), F.col("rest").substr(start + n + 1, F.length("rest")))
    df = df.withColumn("rest", F.when(F.length("rest") > tau, left).otherwise(F.col("rest")))
    more = F.when(F.length("rest") > tau, F.array(*[F.lit(j) for j in range(tau + 1)])).otherwise(F.array(F.lit(0)))
    df = df.withColumn("i", F.explode(more))
    start, n = _bounds(F.length("rest"), F.col("i"), tau + 1)
    part = F.when(F.length("rest") > tau, F.xxhash64("key", "i", F.col("rest").substr(start + 1, n))).otherwise(F.col("key"))
    return df.withColumn("key", part)


def _prefixes(df: DataFrame, asks: bool) -> DataFrame:
    """The rows of a crowded head key, by the prefixes under which a shorter hash meets a longer one.

    A row stands once for itself and once for each shorter prefix of up to ``FULL`` characters; of two rows that meet one
    stands for itself, so that only hashes meet of which one begins with the other (beyond ``FULL``: with its first ``FULL`` characters).
    """
    n = F.length("sha")
    own = F.struct(F.lit(asks).alias("side"), F.least(n, F.lit(FULL)).alias("len"))
    upto = F.least(n - 1, F.lit(FULL))
    shorter = F.when(upto >= PREFIX, F.transform(F.sequence(F.lit(PREFIX), upto), lambda k: F.struct(F.lit(not asks).alias("side"), k.alias("len"))))
    df = df.withColumn("x", F.explode(F.concat(F.array(own), F.coalesce(shorter, F.array().cast("array<struct<side: boolean, len: int>>")))))
    return df.withColumn("key", F.xxhash64("key", "x.side", F.col("sha").substr(F.lit(1), F.col("x.len")))).drop("x")


def _meeting(ask: DataFrame, held: DataFrame, pool: DataFrame, crowded: int, on, deeper, load) -> DataFrame:
    """The join ``on`` of ``ask`` and ``held`` by ``key``, that of crowded keys after both have been cut ``deeper``, up to ``DEPTH`` times.

    ``pool`` has the entries of both, each once: most keys stand there alone, and only those that don't are joined. ``load``
    adds what ``deeper`` needs to the entries of crowded keys.
    """
    shared = Table(pool.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared", count=F.col("n") > crowded)
    some = shared.df.where(F.col("n") <= crowded).select("key")
    found = on(ask.join(some, "key", "left_semi"), held.join(some, "key", "left_semi"))
    if not shared.counted:
        return found
    heavy = shared.df.where(F.col("n") > crowded).select("key")
    ask, held = load(ask.join(heavy, "key", "left_semi"), held.join(heavy, "key", "left_semi"))
    for _ in range(DEPTH):
        ask, held = cut(deeper(ask, True), "ask"), cut(deeper(held, False), "held")
        many = Table(held.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select("key"), "crowded", count=F.lit(True))
        if not many.counted:
            break
        found = found.unionByName(on(ask.join(many.df, "key", "left_anti"), held.join(many.df, "key", "left_anti")))
        ask, held = ask.join(many.df, "key", "left_semi"), held.join(many.df, "key", "left_semi")
    return found.unionByName(on(ask, held))


def near_strings(batch: DataFrame, stored: DataFrame | None, tau: int, substitutions: bool = False, crowded: int = CROWDED) -> DataFrame:
    """``(a, b)``, a before b: distinct pairs of strings within tau edits, both of ``batch`` (s) or one of it and one stored.

    ``stored`` holds segments as ``segments`` gives them, of strings that aren't in ``batch``. With substitutions the strings of a segment held by more
    than ``crowded`` are paired only if some part of the rest agrees, too, and so on for ``DEPTH`` cuts, which loses no pair.
    """
    ask, held = probes(batch, tau, substitutions), segments(batch, tau)
    if stored is not None:  # of the history only what the batch asks for
        held = held.unionByName(stored.join(ask.select("key").distinct(), "key", "left_semi"))
    pair = lambda x, y: x.select("key", F.col("s").alias("a")).join(y.select("key", F.col("s").alias("b")), "key").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    load = lambda ask, held: (ask.withColumn("rest", F.col("s")), held.withColumn("rest", F.col("s")))
    pairs = _meeting(ask, held, held, crowded, pair, lambda df, _: _deeper(df, tau), load) if substitutions else pair(ask, held)
    return pairs.distinct().where(_distance_within(F.col("a"), F.col("b"), tau, substitutions))


def classes_of(records: DataFrame) -> DataFrame:
    """Records (id, ts, sha, bytes) of the same hash and size as one row ``(cid, sha, bytes, first, n)``.

    They match the same records and one another, so that they share their fate: ``first``, the earliest, stands for all ``n``.
    """
    c = records.where("sha <> ''").groupBy("sha", "bytes").agg(F.min(F.struct("ts", "id")).alias("first"), F.count("*").alias("n"))
    return c.withColumn("cid", F.unhex(F.md5(F.concat_ws("/", "sha", F.coalesce(F.col("bytes").cast("string"), F.lit(""))))))


def entries(classes: DataFrame) -> DataFrame:
    """``(cid, kind, i, key)``: what stands in the index for ``classes``, and what they ask it for: the hash; its segments, where it is
    whole and its size known, each with its size's slot on either grid; its beginning, where it is long enough and its size known.
    """
    width = 2 * (SPREAD + 1)
    found = [f"named_struct('kind', {EQUAL}, 'i', 0, 'key', xxhash64({EQUAL}, sha))"]
    for i in range(TAU + 1):
        a, b = FULL * i // (TAU + 1), FULL * (i + 1) // (TAU + 1)
        found += [
            f"CASE WHEN whole THEN named_struct('kind', {SEGMENT}, 'i', {i}, 'key', xxhash64({SEGMENT}, {FULL}, {i}, substring(sha, {a + 1}, {b - a}), {grid}, floor((bytes + {grid * width // 2}) / {width}))) END"
            for grid in (0, 1)
        ]
    found.append(f"CASE WHEN bytes IS NOT NULL AND length(sha) >= {PREFIX} THEN named_struct('kind', {HEAD}, 'i', 0, 'key', xxhash64({HEAD}, substring(sha, 1, {PREFIX}), bytes)) END")
    rows = classes.selectExpr("cid", "sha", "bytes", f"bytes IS NOT NULL AND sha RLIKE '^[0-9a-f]{{{FULL}}}$' AS whole")
    return rows.selectExpr("cid", f"explode(array({', '.join(found)})) AS e").where("e IS NOT NULL").select("cid", "e.*")


def _matches() -> Column:
    """Whether two classes that met under a key, ``sha`` and ``bytes`` of the later and ``sha2`` and ``bytes2`` of the earlier one, match."""
    differ = "size(filter(sequence(1, length(sha)), i -> substring(sha, i, 1) <> substring(sha2, i, 1)))"
    near = f"sha <> sha2 AND abs(bytes - bytes2) <= {SPREAD} AND length(sha) = length(sha2) AND {differ} <= {TAU}"
    short, long = "if(length(sha) < length(sha2), sha, sha2)", "if(length(sha) < length(sha2), sha2, sha)"
    begins = f"length(sha) <> length(sha2) AND bytes = bytes2 AND {short} RLIKE '^[0-9a-f]{{{PREFIX},}}$' AND startswith({long}, {short})"
    return F.expr(f"CASE kind WHEN {EQUAL} THEN sha = sha2 WHEN {SEGMENT} THEN {near} ELSE {begins} END")


def matches(new: DataFrame, asked: DataFrame | None = None, stored: DataFrame | None = None, crowded: int = CROWDED) -> DataFrame:
    """``(late, early, first, old)``: classes of ``new`` with each class before them that they match, stored ones being ``old``.

    Those of ``new`` with equal hashes aren't paired. ``asked`` are the stored entries whose keys ``new`` has, too, ``stored`` all stored classes.
    """
    ask = entries(new)
    held, pool = ask.where(F.col("kind") != EQUAL).withColumn("old", F.lit(False)), ask.select("key")
    if asked is not None:
        held, pool = held.unionByName(asked.withColumn("old", F.lit(True))), pool.unionByName(asked.select("key"))
    own = new.select("cid", "sha", "bytes", "first")

    def known(of: DataFrame) -> DataFrame:
        """Classes of the batch, and those of history that ``of`` (cid) names."""
        return own if stored is None else own.unionByName(stored.join(of.select("cid").distinct(), "cid", "left_semi").select(own.columns)).distinct()

    def load(ask: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
        text = lambda df: df.withColumn("rest", F.col("sha"))
        return text(ask.join(own.select("cid", "sha"), "cid")), text(held.join(known(held).select("cid", "sha"), "cid"))

    def pair(x: DataFrame, y: DataFrame) -> DataFrame:
        y = y.select("key", F.col("cid").alias("early"), "old")
        return x.select("key", "kind", F.col("cid").alias("late")).join(y, "key").where("old OR late <> early").select("late", "early", "kind", "old")

    def deeper(df: DataFrame, asks: bool) -> DataFrame:
        return _deeper(df.where(F.col("kind") == SEGMENT), TAU).unionByName(_prefixes(df.where(F.col("kind") == HEAD), asks)).unionByName(df.where(F.col("kind") == EQUAL))

    pairs = cut(_meeting(ask, held, pool, crowded, pair, deeper, load).distinct(), "pairs")
    late = own.select(F.col("cid").alias("late"), "sha", "bytes", F.col("first").alias("mine"))
    early = known(pairs.where("old").select(F.col("early").alias("cid"))).select(F.col("cid").alias("early"), F.col("sha").alias("sha2"), F.col("bytes").alias("bytes2"), "first")
    met = pairs.join(late, "late").join(early, "early").where("first < mine").where(_matches())
    return cut(met.select("late", "early", "first", "old").distinct(), "matches")


def decide(new: DataFrame, asked: DataFrame | None = None, stored: DataFrame | None = None, crowded: int = CROWDED) -> DataFrame:
    """``(cid, sha, bytes, first, n, rep)`` for the new classes: ``rep`` is the earliest accepted record that rejects it, or null.

    Records are taken in the order of ``first``, and one is rejected if it matches one accepted before. Stored classes are
    accepted, so that what matches one is settled at once; of the rest, only those that match one another wait for one another.
    Of equal hashes with different sizes the first accepted one rejects all later ones. ``new`` is read several times and
    should be a written table.
    """
    edges = matches(new, asked, stored, crowded)
    known = edges.where("old").groupBy(F.col("late").alias("cid")).agg(F.min("first").alias("rep"))
    rest = new.join(known, "cid", "left_anti")
    ids = rest.select("cid")
    within = edges.where("NOT old").join(ids.toDF("late"), "late", "left_semi").join(ids.toDF("early"), "early", "left_semi")
    within = cut(within.select("late", "early", "first"), "within")
    shared = rest.groupBy("sha").agg(F.count("*").alias("k"), F.min("first").alias("lead")).where("k > 1").select("sha", "lead")
    tied = within.select(F.col("late").alias("cid")).union(within.select("early")).distinct()
    mixed = rest.join(tied, "cid", "left_semi").select("sha").distinct()
    nodes = rest.join(mixed, "sha", "left_semi").select(F.col("cid").alias("id"), F.col("sha").alias("clique"), F.col("first").alias("rank"))
    settled = accepted_in_order(nodes, within.select("late", "early"), cliques=True)
    good = settled.where("ok")
    by_edge = within.join(good.select(F.col("id").alias("early")), "early").select(F.col("late").alias("cid"), F.col("first").alias("rep"))
    lead = good.select(F.col("clique").alias("sha"), F.col("rank").alias("lead"))
    by_hash = settled.where("NOT ok").join(lead, settled["clique"] == lead["sha"]).where("lead < rank").select(F.col("id").alias("cid"), F.col("lead").alias("rep"))
    lost = by_edge.join(settled.where("NOT ok").select(F.col("id").alias("cid")), "cid", "left_semi").unionByName(by_hash)
    plain = rest.join(shared.join(mixed, "sha", "left_anti"), "sha").where("lead < first").select("cid", F.col("lead").alias("rep"))
    best = lost.unionByName(plain).groupBy("cid").agg(F.min("rep").alias("rep")).unionByName(known)
    return new.join(best, "cid", "left").select("cid", "sha", "bytes", "first", "n", "rep")


def rejected(records: DataFrame, decided: DataFrame) -> DataFrame:
    """``(id, repeats)``: the rejected records, and the earliest accepted one that each repeats.

    Of an accepted class the first record is accepted and the rest repeat it; of a rejected one all repeat what it repeats.
    """
    # single records that are accepted, most of them as a rule, need not be looked for
    d = decided.where("rep IS NOT NULL OR n > 1").select("sha", F.col("bytes").alias("b"), "first", F.coalesce("rep.id", "first.id").alias("repeats"), F.col("rep").isNotNull().alias("out"))
    r = records.join(d, (records["sha"] == d["sha"]) & records["bytes"].eqNullSafe(d["b"]))
    return r.where(F.col("out") | (F.struct("ts", "id") != F.col("first"))).select("id", "repeats").distinct()


class History:
    """The index of what has been accepted so far, in a folder.

    Each batch adds a run: its classes and their entries, by buckets. A log file per batch names the runs that
    count and is written last, by a rename, so that a batch that fails midway leaves nothing that is read; the folder
    alone tells what is stored, and another object, driver or day goes on where the last one ended. One writer at a time.
    A batch that is added again, as after a lost driver, has the same rejects and stores no class twice.
    """

    def __init__(self, path: str, buckets: int = BUCKETS):
        self.path, self.buckets = path.rstrip("/"), buckets

    def _hadoop(self, spark, name: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def _log(self, spark) -> tuple[int, dict]:
        """Number and contents of the last log file."""
        fs, path = self._hadoop(spark, "log")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        last = max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)
        if not last:
            return 0, {"buckets": self.buckets, "runs": []}
        file = fs.open(self._hadoop(spark, f"log/{last:08}.json")[1])
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        file.close()
        return last, json.loads(text)

    def _commit(self, spark, n: int, log: dict) -> None:
        fs, path = self._hadoop(spark, f"log/{n:08}.json")
        _, draft = self._hadoop(spark, f"log/{n:08}.draft")
        out = fs.create(draft, True)
        out.write(json.dumps(log).encode())
        out.close()
        if not fs.rename(draft, path):
            raise RuntimeError(f"another writer has stored batch {n}")

    def _read(self, like: DataFrame, name: str, key: str, of: DataFrame | None) -> DataFrame | None:
        """A stored table, ``like`` which it is; of it the buckets that the keys ``of`` fall in, where they are few."""
        spark = like.sparkSession
        _, log = self._log(spark)
        if not log["runs"]:
            return None
        root = f"{self.path}/{name}"
        shape = like.schema.add("run", "integer").add("b", "integer")
        df = spark.read.schema(shape).option("basePath", root).parquet(*[f"{root}/run={r}" for r in log["runs"]])
        if of is not None:
            few = of.select(key).limit(4 * log["buckets"] + 1).collect()  # bounded; with more keys all buckets are asked for
            if len(few) <= 4 * log["buckets"]:
                asked = of.select(F.pmod(F.xxhash64(key), F.lit(log["buckets"])).cast("int")).distinct().collect()
                df = df.where(F.col("b").isin(sorted(r[0] for r in asked)))
        return df.drop("run", "b")

    def index(self, new: DataFrame) -> DataFrame | None:
        """Stored entries, at least those that the classes ``new`` ask for."""
        e = entries(new)
        return self._read(e, "index", "key", e)

    def _write(self, classes: DataFrame, index: DataFrame, run: int, buckets: int) -> None:
        for name, key, df in (("classes", "cid", classes), ("index", "key", index)):
            df = df.withColumn("b", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
            df.repartition("b").write.mode("overwrite").partitionBy("b").parquet(f"{self.path}/{name}/run={run}")

    def add(self, records: DataFrame) -> DataFrame:
        """Rejects of a batch ``records`` (id, ts, sha, bytes) later than all before it; what is accepted is appended."""
        spark = records.sparkSession
        new = cut(classes_of(records), "classes")
        index, stored, asked = self.index(new), self._read(new, "classes", "cid", None), None
        if index is not None:
            asked = cut(index.join(entries(new).select("key"), "key", "left_semi"), "asked")
        decided = cut(decide(new, asked, stored), "decided")
        out = cut(rejected(records, decided), "rejected")
        good = decided.where("rep IS NULL").select("cid", "sha", "bytes", "first", "n")
        if asked is not None:  # a batch that is added again finds itself
            good = good.join(asked.where(F.col("kind") == EQUAL).select("cid"), "cid", "left_anti")
        n, log = self._log(spark)
        self._write(good, entries(good), n + 1, log["buckets"])
        self._commit(spark, n + 1, {"buckets": log["buckets"], "runs": [*log["runs"], n + 1]})
        return out

    def compact(self, spark, buckets: int | None = None) -> None:
        """All runs as one, with ``buckets`` buckets: more of them as history grows keep what a small batch reads the same."""
        n, log = self._log(spark)
        if not log["runs"]:
            return
        whole = [spark.read.parquet(*[f"{self.path}/{name}/run={r}" for r in log["runs"]]).drop("b") for name in ("classes", "index")]
        self._write(*whole, n + 1, buckets or log["buckets"])
        self._commit(spark, n + 1, {"buckets": buckets or log["buckets"], "runs": [n + 1]})
        for r in log["runs"]:
            for name in ("classes", "index"):
                fs, path = self._hadoop(spark, f"{name}/run={r}")
                fs.delete(path, True)
