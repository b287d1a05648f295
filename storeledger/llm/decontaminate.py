"""Benchmark decontamination by MinHash containment, in DataFrame functions only.

A test item is tiny beside most documents, so the similarity of the two whole sets
tells nothing; what counts is the share of the item's shingles that the document
holds. MinHash therefore samples the items: each of ``K`` hash functions picks the
item's least shingle, and the share of those picks found in a document estimates
the containment without bias, however long the document is (containment MinHash,
Koslicki and Zabeti, 2019). Items are partitioned by size: the smallest are sampled
whole, the others by ``K`` functions, and each partition has the least number of hits
that a document of sufficient containment all but never falls short of.
Candidates are then verified by exact shingle containment.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, staged, text_of

WORDS = 5
CONTAINMENT = 0.8
FUNCTIONS = 32
#: Items of at most so many shingles are sampled whole.
WHOLE = 16
#: Chance that a document of just the least containment gets fewer hits than asked for.
MISS = 1e-7
_BREAK = r"[\x20\x09-\x0D]+"


def least_hits(functions: int, containment: float, miss: float) -> int:
    """The largest number that a binomial count of ``functions`` trials is below with at most the chance ``miss``."""
    below, hits = 0.0, 0
    while hits < functions:
        below += math.comb(functions, hits) * containment**hits * (1 - containment) ** (functions - hits)
        if below > miss:
            break
        hits += 1
    return max(1, hits)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _BREAK), lambda w: w != "")


def shingles(text: Column, width: int = WORDS) -> Column:
    """64-bit hashes of every ``width`` lower-case words in a row; fewer words than that are one shingle, none are none."""
    words = _words(text)

    def at(w: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + k) for k in range(width)])

    first = F.lit(0)
    # through transform over one element, so that the words are split once
    per_text = F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(first, F.greatest(first, F.size(w) - width)), lambda i: at(w, i))
        ),
    )
    return F.get(per_text, 0)


def _items(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct items with a key of their own, their distinct shingles, how many there are, and their number of words."""
    text = text_of().alias("text")
    rows = benchmark.select("item_id", text).distinct().select("item_id", F.xxhash64("item_id", "text", F.lit(1)).alias("item"), "text")
    return rows.select("item_id", "item", F.array_distinct(shingles(F.col("text"), width)).alias("set"), F.size(_words(F.col("text"))).alias("n_words")).select("*", F.size("set").alias("n_item")).where("n_item > 0")


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key of their text, which tells rows of equal or null ids apart."""
    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.withColumn("key", F.xxhash64("text", F.length("text")))


def leaks(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT, width: int = WORDS, functions: int = FUNCTIONS) -> DataFrame:
    """Documents that hold at least ``containment`` of the shingles of a test item.

    Per document text and item: ``doc_id, key, item_id, n_shared, n_item``, ``key`` telling
    texts of one id apart. Shingles are five lower-case words in a row. Documents stream
    past the item samples; what is shuffled are hits. The samples are written first, so
    that the planner broadcasts them by their true size or, if they are large, shuffles.

    Null and empty texts hold and match nothing; an item of fewer than five words is one
    shingle of all its words, and is held by every document with these words in a row; repeated
    rows count once; empty tables give no rows; extra columns are left out.
    """
    items = staged(_items(benchmark, width), "benchmark-items")
    # shorter shingles of documents are looked up only in the sizes that items have, at most four numbers
    short = sorted(r.n_words for r in items.where(F.col("n_words") < width).select("n_words").distinct().collect())

    def of_document(text: Column) -> Column:
        return F.concat(*(shingles(text, k) for k in [width, *short]))

    whole = items.where(F.col("n_item") <= WHOLE).select("item", F.explode("set").alias("shingle"), F.lit(1).alias("picks"), F.ceil(F.col("n_item") * containment).cast("int").alias("least"))
    drawn = (
        items.where(F.col("n_item") > WHOLE)
        .select("item", F.explode("set").alias("shingle"))
        .select("item", "shingle", F.explode(F.sequence(F.lit(1), F.lit(functions))).alias("f"))
        .groupBy("item", "f")
        .agg(F.min_by("shingle", F.xxhash64("shingle", "f")).alias("shingle"))
        .groupBy("item", "shingle")
        .agg(F.count(F.lit(1)).cast("int").alias("picks"))
        .select("item", "shingle", "picks", F.lit(least_hits(functions, containment, MISS)).alias("least"))
    )
    samples = staged(whole.unionByName(drawn), "benchmark-samples")

    rows = _keyed(docs)
    hits = rows.select("doc_id", "key", F.explode(of_document(F.col("text"))).alias("shingle")).join(samples, "shingle")
    found = hits.groupBy("doc_id", "key", "item", "shingle").agg(F.first("picks").alias("picks"), F.first("least").alias("least"))
    likely = staged(found.groupBy("doc_id", "key", "item").agg(F.sum("picks").alias("hits"), F.first("least").alias("least")).where("hits >= least").select("doc_id", "key", "item"), "benchmark-candidates")

    wanted = likely.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "item").groupBy("d", "k").agg(F.collect_set("item").alias("of_doc"))
    suspects = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")))
    held = suspects.select("doc_id", "key", "of_doc", F.explode(F.array_distinct(of_document(F.col("text")))).alias("shingle"))
    shared = held.join(items.select("item", "item_id", "n_item", F.explode("set").alias("shingle")), "shingle").where(F.array_contains("of_doc", F.col("item")))
    per_pair = shared.groupBy("doc_id", "key", "item").agg(F.first("item_id").alias("item_id"), F.countDistinct("shingle").alias("n_shared"), F.first("n_item").cast("long").alias("n_item"))
    return per_pair.where(F.col("n_shared") >= F.ceil(F.col("n_item") * containment - 1e-9)).drop("item")


def contained_items(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item`` of every leak, the fullest one of a pair of ids."""
    found = leaks(docs, benchmark, **options).groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("m"))
    return found.select("doc_id", "item_id", "m.n_shared", "m.n_item")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no test item, with their columns as they were."""
    bad = staged(leaks(docs, benchmark, **options).select(F.col("doc_id").alias("d"), F.col("key").alias("k")).distinct(), "contaminated")
    key = free_name(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64(text_of(), F.length(text_of())))
    id_, text_key = free_name(keyed, "bad_id"), free_name(keyed, "bad_key")
    bad = bad.select(F.col("d").alias(id_), F.col("k").alias(text_key))
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(bad[id_]) & (keyed[key] == bad[text_key]), "left_anti").select(*docs.columns)


SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t-\r]+'), lambda x: x <> '') AS w, text FROM documents),
b AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t-\r]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, text, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM b),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
p AS (SELECT doc_id, text, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, max(n_shared) AS n_shared, n_item FROM p JOIN n USING (item_id)
WHERE 5 * n_shared >= 4 * n_item GROUP BY doc_id, item_id, n_item
"""
