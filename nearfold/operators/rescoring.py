"""Neighbour lists that are kept as rows are added; stored rows are never scored against each other.

Stored are, in bucketed tables: the digest of every row, numbered terms, the vector of every digest and
its list. A batch of new rows is collapsed to entries, one for each digest with the smallest new ids.
New targets are scored against everything, and stored targets against the new entries, each from the
score that its stored list needs; the results are merged with the stored lists, of which only those
that change are written again.

The stored vectors are scanned where they lie, without a shuffle, and meet the new entries in blocks of
bounded size that all tasks hold. So a batch costs its entries times the stored vectors that can score
high enough, and where the batch is more than `ROWS_PER_SCAN` entries, another scan. A batch of many scans
is first tried by heads: targets then meet only the rows that have one of their rarest terms, see `heads.py`.
For batches that are a large part of the whole, building anew is cheaper.

An entry is never changed. Ids that join a digest later are an entry of their own with its own least
id, which is what orders entries of equal score; the best entries by (score, least id) hold the best
ids, as each brings at least its least one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfold.fixed import NEIGHBOURS
from nearfold.functions.text import sorted_tokens
from nearfold.operators.dictionary import more_terms, sparse_postings, term_dictionary
from nearfold.operators.heads import COMMON, frequent_terms, offers_by_heads, raised, too_long, with_heads
from nearfold.operators.joins import anti_keys, hot_keys, spread_lookup
from nearfold.operators.products import new_entries, scan_scorer
from nearfold.operators.topk import MAX_OFFERS, MAX_SLOTS, collapse, group_lists, lists_of_rows, require_unique, text_digest
from nearfold.session import Steps, freeze
from nearfold.sources.buckets import BUCKETS, BucketTable

# What all tasks hold of a batch at a time.
ROWS_PER_SCAN = 4096
POSTINGS_PER_SCAN = 1_000_000
# Batches of more scans are tried by heads.
MANY_SCANS = 4


class NeighbourState:
    """Lists of `k` neighbours of the rows of one growing table, stored under `path`.

    Ids must be unique and not null, otherwise `ValueError`. An id that is stored already keeps its
    text; a changed text needs a new state. Null text counts as no tokens.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        id_type: T.DataType,
        k: int = NEIGHBOURS,
        min_token_len: int = 2,
        buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.id_type, self.k, self.min_token_len = spark, id_type, k, min_token_len
        self.keep = k + 1  # a list holds its own row too
        whole, real, digest = T.LongType(), T.DoubleType(), T.StructField("digest", T.BinaryType())
        entry = T.StructType([T.StructField("id", id_type), T.StructField("score", real)])

        def table(name: str, key: str, *fields: T.StructField) -> BucketTable:
            return BucketTable(spark, f"{path.rstrip('/')}/{name}", T.StructType(list(fields)), key, buckets)

        self.rows = table("rows", "id", T.StructField("id", id_type), digest)
        self.terms = table(
            "terms", "term", T.StructField("term", T.StringType()), T.StructField("df", whole), T.StructField("number", whole)
        )
        self.vectors = table(
            "vectors", "digest", digest, T.StructField("gid", id_type), T.StructField("members", T.ArrayType(id_type)),
            T.StructField("terms", T.ArrayType(whole)), T.StructField("tfs", T.ArrayType(whole)), T.StructField("n2", whole),
            T.StructField("leads", T.BooleanType()), T.StructField("floor", real),
        )
        self.lists = table("lists", "digest", digest, T.StructField("members", T.ArrayType(entry)))

    def neighbours(self, pad_zero: bool = True) -> DataFrame:
        """`target_id, neighbours` of all rows, as `neighbour_lists` gives them."""
        rows, lists = freeze(self.rows.read(), "rows"), freeze(self.lists.latest(), "lists")
        return lists_of_rows(rows, lists, self.k, pad_zero)

    def add(self, df: DataFrame, id_col: str, text_col: str) -> None:
        """Take up the rows of `df` that are not stored yet; run again after a failure, it begins anew."""
        batch = self.rows.next_batch()
        with Steps(self.spark) as steps:
            ordered = sorted_tokens(F.coalesce(F.col(text_col), F.lit("")), self.min_token_len)
            texts = df.select(F.col(id_col).alias("id"), ordered.alias("ordered"))
            texts = steps.freeze(texts.withColumn("digest", text_digest(F.col("ordered"))), "delivered")
            if batch:
                known = self.rows.read(["id"], batch, self.rows.touched(texts))
                texts = steps.freeze(anti_keys(texts, known, "id"), "texts")
            require_unique(texts.select("id"))
            groups = steps.freeze(collapse(texts, self.keep), "groups")
            postings = steps.freeze(groups.select("digest", F.inline("counts")), "postings")
            entries = self._entries(groups, postings, batch, steps)
            lists = self._lists(groups, entries, batch, steps)
            floor = F.when(F.size("members") >= self.keep, F.element_at("members", self.keep)["score"]).otherwise(0.0)
            floors = lists.select("digest", floor.alias("floor"))
            vectors = entries.withColumnRenamed("fresh", "leads").join(floors, "digest", "left")
            vectors = vectors.withColumn("floor", F.coalesce("floor", F.lit(0.0)))
            self.vectors.append(vectors.select(*self.vectors.schema.names), batch)
            self.lists.append(lists, batch)
            self.rows.append(texts.select("id", "digest"), batch)  # last: it marks the batch as done
        for table in (self.terms, self.vectors, self.rows):
            table.merge()
        self.lists.merge(only_latest=True)

    def _entries(self, groups: DataFrame, postings: DataFrame, batch: int, steps: Steps) -> DataFrame:
        """`digest, gid, members, terms, tfs, n2, fresh` of the new rows; new terms are numbered and stored."""
        if batch:
            touched = self.terms.touched(postings)
            known = steps.freeze(self.terms.read(before=batch, touched=touched), "known-terms")
            size = self.terms.read(["number"], batch).agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
            more = more_terms(known, postings, size)
            words = known.unionByName(more)
            stored = self.vectors.read(["digest"], batch, self.vectors.touched(groups))
            known = stored.distinct().withColumn("known", F.lit(True))
        else:
            more = words = term_dictionary(postings)
            known = groups.select("digest").limit(0).withColumn("known", F.lit(True))
        self.terms.append(more, batch)
        # Rare terms first, as the bounds want them.
        by_digest = sparse_postings(postings, words).groupBy("digest")
        arrays = by_digest.agg(F.sort_array(F.collect_list(F.struct("df", "number", "tf"))).alias("t"))
        entries = groups.select("digest", "gid", "members", "n2").join(arrays, "digest").join(known, "digest", "left")
        return steps.freeze(
            entries.select(
                "digest", "gid", "members", F.col("t.number").alias("terms"), F.col("t.tf").alias("tfs"), "n2",
                F.col("known").isNull().alias("fresh"),
            ),
            "entries",
        )

    def _lists(self, groups: DataFrame, entries: DataFrame, batch: int, steps: Steps) -> DataFrame:
        """`digest, members` of the lists that are new or change."""
        if not batch:
            return steps.freeze(group_lists(groups, self.keep, None, steps), "lists")
        offers = steps.freeze(self._offers(entries, batch, steps), "offers")
        best = Window.partitionBy("digest").orderBy(F.desc("score"), "other")
        ranked = offers.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= self.keep)
        ids = F.flatten(
            F.transform(
                F.collect_list(F.struct("score", "members")),
                lambda g: F.transform(g["members"], lambda m: F.struct((-g["score"]).alias("below"), m.alias("id"))),
            )
        )
        offered = steps.freeze(ranked.groupBy("digest").agg(ids.alias("ids")), "offered")
        before = self.lists.latest(before=batch, touched=self.lists.touched(offered))
        both = offered.join(before, "digest", "left")
        none = F.array().cast(both.schema["ids"].dataType)
        stored = F.transform("members", lambda m: F.struct((-m["score"]).alias("below"), m["id"].alias("id")))
        merged = F.slice(F.sort_array(F.array_distinct(F.concat("ids", F.coalesce(stored, none)))), 1, self.keep)
        after = F.transform(merged, lambda m: F.struct(m["id"].alias("id"), (-m["below"]).alias("score")))
        changed = both.withColumn("after", after).filter(F.col("members").isNull() | (F.col("after") != F.col("members")))
        return steps.freeze(changed.select("digest", F.col("after").alias("members")), "lists")

    def _offers(self, entries: DataFrame, batch: int, steps: Steps) -> DataFrame:
        """`digest, score, other, members`: what new entries and targets bring, see `scan_scorer`."""
        mine = entries.select("*", F.lit(0.0).alias("floor"), F.col("fresh").alias("leads"), F.lit(False).alias("stored"))
        columns = ["digest", "gid", "members", "terms", "tfs", "n2", "leads", "floor"]
        rows = self.vectors.read(columns, batch).withColumn("stored", F.lit(True))
        rows = rows.unionByName(mine.select(*rows.columns))
        n, postings = entries.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
        schema = T.StructType(
            [self.vectors.schema["digest"], T.StructField("score", T.DoubleType()), T.StructField("other", self.id_type),
             self.vectors.schema["members"]]
        )
        scans = max(1, math.ceil(n / ROWS_PER_SCAN), math.ceil(postings / POSTINGS_PER_SCAN))
        if n and scans > MANY_SCANS and (offers := self._offers_by_heads(rows, steps)) is not None:
            return offers
        share = F.pmod(F.xxhash64("digest"), F.lit(scans))
        offers = self.spark.createDataFrame([], schema)
        for scan in range(scans if n else 0):
            # About the bound of a scan, by the even hash: the part of a batch that is sent around.
            shared = self.spark.sparkContext.broadcast(new_entries(entries.filter(share == scan).toArrow()))
            offers = offers.unionByName(rows.mapInArrow(scan_scorer(shared, self.keep), schema))
        return offers

    def _offers_by_heads(self, rows: DataFrame, steps: Steps) -> DataFrame | None:
        """The same by the rarest terms of the targets; None if scans are the better way."""
        vectors = rows.select(
            "gid", F.lit(-1).cast("bigint").alias("block"), "floor", F.size("members").alias("n_members"), "terms", "tfs", "n2",
            F.col("leads").alias("target"), F.lit(True).alias("found"), "stored",
        )
        old, new = (vectors.filter(F.col("stored") == s).drop("stored") for s in (True, False))
        # Added targets against all rows. Their floors come from each other, in two orders.
        frequent, postings = frequent_terms(vectors)
        if too_long(frequent, postings):
            return None
        near = raised(new, frequent, self.keep, frequent.n)
        targets = steps.freeze(with_heads(raised(near, frequent, self.keep, COMMON), frequent), "headed-new")
        others = old.withColumns({"target": F.lit(False), "n_head": F.lit(0)})
        added = offers_by_heads(targets.unionByName(others), frequent, postings, self.keep, self.id_type)
        if added is None:
            return None
        # Stored targets against added rows.
        frequent, postings = frequent_terms(new)
        leading = old.filter("target").withColumn("found", F.lit(False))
        targets = steps.freeze(with_heads(leading, frequent), "headed-old")
        others = new.withColumns({"target": F.lit(False), "n_head": F.lit(0)})
        changed = offers_by_heads(targets.unionByName(others), frequent, postings, self.keep, self.id_type)
        if changed is None:
            return None
        (added, n_added), (changed, n_changed) = added, changed
        best = Window.partitionBy("gid").orderBy(F.desc("score"), "other")
        n_tasks = min(-(-(n_added + n_changed) // MAX_OFFERS), MAX_SLOTS)
        found = added.unionByName(changed)
        if n_tasks > int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            found = found.repartition(n_tasks, "gid")
        ranked = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= self.keep)
        ranked = steps.freeze(ranked.drop("place"), "found")
        ranked = ranked.join(rows.select("gid", "digest"), "gid")
        members = rows.select(F.col("gid").alias("other"), "members")
        members = members.join(F.broadcast(hot_keys(ranked, "other")), "other", "left")
        found = spread_lookup(ranked, members, "other", F.col("hot").isNotNull(), spread_by="gid")
        return found.select("digest", "score", "other", "members")
