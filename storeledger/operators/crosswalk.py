"""Proposing one legacy product for every new product.

The score of a pair is .7 name + .2 brand + .1 price similarity. Scoring every
pair is quadratic, so the work is cut down without changing any result:

1. similarity depends on names and brands only, so products are grouped into
   families (one normalised name, one normalised brand);
2. name pairs are looked for in rounds of falling similarity. What a round finds
   raises the second-best score of a family, and a name is done once that score
   is out of reach for every pair the round could have missed. Names that reach a
   similarity must share substrings, which an equi-join on rare substrings finds.
   What is left after the rounds is bounded by its brands as well;
3. only families within .1 of the second-best base score go on, and within each
   the nearest prices decide (``price_neighbours``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import similarity as S
from ..functions.text import normalize_name, squash
from ..frames import side_by_side, spread
from ..staging import staged
from .price_neighbours import Points, legacy_points, nearest, prepare

_SLACK = 1e-9  # room for floating-point error in the bounds
_PRICE_OR_BRAND = K.BRAND_WEIGHT + K.PRICE_WEIGHT
_GRAM_SIZES = (3, 2, 1)
#: Name similarities of the rounds. Two products of the same name, of whatever brands, settle the first.
ROUNDS = (0.57, 0.3)
_ONE_SHARED = 1e-6  # less than any pair with a shared character has
ANY = "*"  # no normalised text holds this character
_FAMILY_COLUMNS = (
    "n", "b", "m", "c", "name_similarity", "brand_similarity", "base", "is_exact")


def new_side(new: DataFrame) -> DataFrame:
    return new.select(
        F.col("new_product_id").alias("new_id"), F.col("item_name").alias("new_name"),
        normalize_name(F.col("item_name")).alias("n"),
        normalize_name(F.col("brand_name")).alias("b"),
        F.col("msrp").cast("double").alias("price"),
    )


def legacy_side(legacy: DataFrame) -> DataFrame:
    return legacy.select(
        F.col("product_id").cast("string").alias("id"), F.col("product_name").alias("legacy_name"),
        normalize_name(F.col("product_name")).alias("m"),
        normalize_name(F.col("brand")).alias("c"),
        F.col("base_price").cast("double").alias("price"),
    )


def normalised_sides(new: DataFrame, legacy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides as written tables: they are read some ten times, and each text is normalised once."""
    return (staged(new_side(spread(new, "new_product_id")), "new-side"),
            staged(legacy_side(spread(legacy, "product_id")), "legacy-side"))


def similarity_of(pairs: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Text similarity of distinct (left, right) values, sorted so that the
    Python side sets up each right text once."""
    distinct = pairs.select(left, right).distinct().sortWithinPartitions(right)
    return distinct.withColumn(name, S.matching_ratio(F.col(left), F.col(right)))


def second_best_bound(new_families: DataFrame, pairs: DataFrame, legacy_families: DataFrame) -> DataFrame:
    """Per new family a score that at least two legacy products reach.

    ``pairs`` are scored name pairs. A name counts with its products of
    the same brand (brand similarity one) and its other products (at least zero).
    """
    per_name = legacy_families.groupBy("m").agg(F.sum("products").alias("all_products"))
    same = legacy_families.select("m", F.col("c").alias("b"), F.col("products").alias("same_brand"))
    scored = (
        new_families.join(pairs, "n").join(per_name, "m").join(same, ["m", "b"], "left")
        .withColumn("same_brand", F.coalesce("same_brand", F.lit(0)))
    )
    name_part = F.lit(K.NAME_WEIGHT) * F.col("name_similarity")
    entries = F.explode(F.array(
        F.struct((name_part + K.BRAND_WEIGHT).alias("score"), F.col("same_brand").alias("products")),
        F.struct(name_part.alias("score"), (F.col("all_products") - F.col("same_brand")).alias("products")),
    ))
    listed = scored.select("n", "b", entries.alias("e")).select("n", "b", "e.*").where("products > 0")
    return new_families.join(_second_best(listed, "score", "bound"), ["n", "b"], "left").select(
        "n", "b", F.coalesce("bound", F.lit(0.0)).alias("bound"))


def _second_best(scored: DataFrame, score: str, name: str) -> DataFrame:
    """Score reached by at least two products, per (n, b), given product counts."""
    rank = F.row_number().over(Window.partitionBy("n", "b").orderBy(F.desc(score)))
    top = scored.select("n", "b", score, "products").withColumn("_rank", rank).where("_rank <= 2")
    first = F.max(F.when(F.col("_rank") == 1, F.col(score)))
    counts = F.max(F.when(F.col("_rank") == 1, F.col("products")))
    second = F.max(F.when(F.col("_rank") == 2, F.col(score)))
    return top.groupBy("n", "b").agg(
        F.when(counts >= 2, first).otherwise(F.coalesce(second, F.lit(0.0))).alias(name))


def needed_ratio(bound):
    """Name similarity below which a pair cannot reach ``bound``."""
    return (bound - F.lit(_PRICE_OR_BRAND)) / F.lit(K.NAME_WEIGHT) - F.lit(_SLACK)


def required_grams(ratio, total, size: int):
    """Substrings of ``size`` that two texts of joint length ``total`` share at least
    when their matching ratio reaches ``ratio``.

    With M matched characters in k blocks, k is at most total - 2M + 1, and each
    block of length l holds l - size + 1 shared substrings.
    """
    matched = ratio * total / 2
    return matched - (size - 1) * (total - 2 * matched + 1)


def name_candidates(needed: DataFrame, legacy_names: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """All name pairs that may reach the ratio each new name needs.

    ``needed``: n, ratio (> 0). For each new name the largest substring size
    with a positive requirement is probed; if r substrings must be shared, one
    of them is among any G - r + 1 of its G, so only its rarest are looked up.
    Both sides hold the columns ``within`` as well, and pairs agree in them.
    """
    length = F.length("n")
    shortest_total = length * 2 / (2 - F.col("ratio"))
    sized = needed.withColumn(
        "size",
        F.coalesce(*[
            F.when(required_grams(F.col("ratio"), shortest_total, q) - 1e-6 >= 1, F.lit(q))
            for q in _GRAM_SIZES[:-1]
        ], F.lit(1)))
    required = F.greatest(F.lit(1), F.ceil(
        F.coalesce(*[
            F.when(F.col("size") == q, required_grams(F.col("ratio"), shortest_total, q))
            for q in _GRAM_SIZES
        ]) - 1e-6))

    probes = numbered_grams(
        sized.withColumn("required", required).withColumn(
            "total_grams", F.length("n") - F.col("size") + 1), "n")
    index = numbered_grams(legacy_names.select(
        "m", *within, F.explode(F.array(*[F.lit(q) for q in _GRAM_SIZES])).alias("size")), "m")
    gram = [*within, "size", "gram", "copy"]
    frequency = index.groupBy(*gram).agg(F.count(F.lit(1)).alias("frequency"))
    rarest = F.row_number().over(
        Window.partitionBy("n", *within).orderBy(F.coalesce("frequency", F.lit(0)), "gram", "copy"))
    chosen = (
        probes.join(frequency, gram, "left")
        .withColumn("_rank", rarest)
        .where(F.col("_rank") <= F.col("total_grams") - F.col("required") + 1)
        .select("n", "ratio", *gram)
    )
    shorter = F.least(F.length("n"), F.length("m"))
    total = F.length("n") + F.length("m")
    close = chosen.join(index, gram).where(
        2.0 * shorter >= F.col("ratio") * total - _SLACK
    ).groupBy("n", "m").agg(F.min("ratio").alias("ratio"))
    # Symbols are counted once per name, not once per pair.
    return (
        close.join(needed.select("n", S.symbol_counts(F.col("n")).alias("in_n")).distinct(), "n")
        .join(legacy_names.select("m", S.symbol_counts(F.col("m")).alias("in_m")).distinct(), "m")
        .where(S.shared_symbols_bound(F.col("in_n"), F.col("in_m"), total) >= F.col("ratio") - _SLACK)
        .select("n", "m")
    )


def numbered_grams(names: DataFrame, text: str) -> DataFrame:
    """Substrings of each name, one row per occurrence, equal ones numbered from 1.

    ``names`` holds ``size``. Numbering makes an equi-join count like multisets.
    """
    columns = names.columns
    return (
        names.withColumn("gram", F.explode(S.substrings(F.col(text), F.col("size"))))
        .groupBy(*columns, "gram").agg(F.count(F.lit(1)).alias("copies"))
        .select(*columns, "gram", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    )


def scored_families(new: DataFrame, legacy: DataFrame) -> DataFrame:
    """Family pairs that may hold the winner or the runner-up, with base scores.

    Columns n, b, m, c, name_similarity, brand_similarity, base, is_exact, leads.
    """
    new_families = staged(new.select("n", "b").distinct(), "new-families")
    # Two is as good as many here: only "at least two" matters.
    legacy_families = staged(legacy.groupBy("m", "c").agg(
        F.least(F.count(F.lit(1)), F.lit(2)).alias("products")), "legacy-families")
    pairs, bounds, unsettled = name_pairs(new_families, legacy_families)
    extra = []
    if not unsettled.isEmpty():
        brands = brand_pairs(unsettled, legacy_families)
        pairs = pairs.unionByName(staged(remaining_pairs(unsettled, brands, legacy_families), "name-pairs")).distinct()
        extra = [unrelated_families(unsettled, brands)]
    families = (
        pairs.withColumn("is_exact", squash(F.col("n")) == squash(F.col("m"))).join(bounds, "n")
        .where(F.col("is_exact") | (
            F.lit(K.NAME_WEIGHT) * F.col("name_similarity") + _PRICE_OR_BRAND + _SLACK
            >= F.col("bound")))
        .join(legacy_families, "m")
        .select("n", "b", "m", "c", "products", "name_similarity", "is_exact")
    )
    brand_scores = similarity_of(families, "b", "c", "brand_similarity")
    based = families.join(brand_scores, ["b", "c"]).withColumn(
        "base", S.base_score(F.col("name_similarity"), F.col("brand_similarity")))
    # families of everything unrelated may hold products of others, so they settle nothing about these
    return staged(reduce(DataFrame.unionByName, extra, reaching_families(based)), "candidate-families")


def name_pairs(new_families: DataFrame, legacy_families: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scored name pairs, a bound of the second-best score per family, and the families no round settled.

    A round finds all pairs of a name that reach its similarity. Once the bounds they give its families ask
    for at least that, no other pair of the name can matter.
    """
    legacy_names = legacy_families.select("m").distinct()
    close = (
        new_families.select("n").distinct().withColumn("key", squash(F.col("n")))
        .join(legacy_names.withColumn("key", squash(F.col("m"))), "key").select("n", "m")
    )  # equal names first
    open_ = new_families.withColumn("needed", F.lit(0.0))
    found, settled = [], []
    for ratio in ROUNDS:
        asked = open_.groupBy("n").agg(F.greatest(F.min("needed"), F.lit(ratio)).alias("ratio"))
        close = name_candidates(asked, legacy_names).unionByName(close)
        found.append(staged(similarity_of(close, "n", "m", "name_similarity"), "name-pairs"))
        pairs = reduce(DataFrame.unionByName, found).distinct() if len(found) > 1 else found[0]
        bounds = second_best_bound(open_.select("n", "b"), pairs, legacy_families)
        least = F.min(needed_ratio(F.col("bound"))).over(Window.partitionBy("n")).alias("needed")
        bounds = staged(bounds.select("*", least), "score-bounds")
        settled.append(bounds.where(F.col("needed") >= ratio).select("n", "b", "bound"))
        open_, close = bounds.where(F.col("needed") < ratio), close.limit(0)
        if open_.isEmpty():
            break
    unsettled = open_.select("n", "b", "bound")
    return pairs, reduce(DataFrame.unionByName, [*settled, unsettled]), unsettled


def brand_pairs(unsettled: DataFrame, legacy_families: DataFrame) -> DataFrame:
    """``b, c, brand_similarity`` of brands that share a character, or are both blank."""
    brands = unsettled.select("b").distinct()
    shared = name_candidates(
        brands.select(F.col("b").alias("n"), F.lit(_ONE_SHARED).alias("ratio")),
        legacy_families.select(F.col("c").alias("m")).distinct())
    scored = similarity_of(shared.select(F.col("n").alias("b"), F.col("m").alias("c")), "b", "c", "brand_similarity")
    blank = brands.where("b = ''").join(legacy_families.where("c = ''").select("c").distinct(), F.col("b") == F.col("c"))
    return staged(scored.unionByName(blank.select("b", "c", F.lit(1.0).alias("brand_similarity"))), "brand-pairs")


def remaining_pairs(unsettled: DataFrame, brands: DataFrame, legacy_families: DataFrame) -> DataFrame:
    """Scored name pairs that can still matter to ``unsettled(n, b, bound)`` families.

    Products of the same brand can lack more in name than products of others, whose brand similarity is known;
    so the former are looked for within their brand, and the latter by a higher similarity.
    """
    other = brands.where("b <> c").groupBy("b").agg(F.max("brand_similarity").alias("other"))

    def needs(brand_part):
        lacking = F.col("bound") - K.PRICE_WEIGHT - F.lit(K.BRAND_WEIGHT) * brand_part
        return F.greatest(lacking / K.NAME_WEIGHT - _SLACK, F.lit(_ONE_SHARED)).alias("ratio")

    own = name_candidates(
        unsettled.select("n", "b", needs(F.lit(1.0))),
        legacy_families.select("m", F.col("c").alias("b")).distinct(), within=("b",))
    rest = unsettled.join(other, "b", "left").select("n", needs(F.coalesce("other", F.lit(0.0))))
    foreign = name_candidates(
        rest.groupBy("n").agg(F.min("ratio").alias("ratio")), legacy_families.select("m").distinct())
    return similarity_of(own.unionByName(foreign), "n", "m", "name_similarity")


def reaching_families(based: DataFrame) -> DataFrame:
    """Drop family pairs that even an equal price cannot lift to the second-best
    base score, or for exact names to the best exact one; ``leads`` marks the two
    best, and the best exact one.

    Everything is decided within one new family at a time, by one shuffle.
    """
    own = Window.partitionBy("n", "b")
    by_base = own.orderBy(F.desc("base"), "m", "c")
    exact = F.when(F.col("is_exact"), F.col("base"))
    second = F.max(F.when((F.col("_rank") == 2) | ((F.col("_rank") == 1) & (F.col("products") >= 2)), F.col("base"))).over(own)
    reach = F.col("base") + K.PRICE_WEIGHT + _SLACK
    ranked = (
        based.withColumn("_rank", F.row_number().over(by_base))
        .withColumn("_exacts", F.count(exact).over(by_base))
        .withColumns({"_second": F.coalesce(second, F.lit(0.0)), "_best_exact": F.max(exact).over(own)})
    )
    leads = (F.col("_rank") <= 2) | (F.col("is_exact") & (F.col("_exacts") == 1))
    return ranked.where(leads | (reach >= F.col("_second")) | (F.col("is_exact") & (reach >= F.col("_best_exact")))).select(
        *_FAMILY_COLUMNS, leads.alias("leads"))


def similar_names(new: DataFrame, legacy: DataFrame, ratio: float) -> DataFrame:
    """All pairs of different or equal names that reach ``ratio``: ``n, m, name_similarity``."""
    close = name_candidates(new.select("n").distinct().withColumn("ratio", F.lit(ratio)), legacy.select("m").distinct())
    return similarity_of(close, "n", "m", "name_similarity").where(F.col("name_similarity") >= ratio)


def exact_name_match(new: DataFrame, legacy: DataFrame) -> DataFrame:
    """How many legacy products share the squashed name of each new product."""
    counts = legacy.groupBy(squash(F.col("m")).alias("key")).agg(F.count(F.lit(1)).alias("legacy_products"))
    return new.withColumn("key", squash(F.col("n"))).join(counts, "key").select("new_id", "key", "legacy_products")


def unrelated_families(unsettled: DataFrame, brands: DataFrame) -> DataFrame:
    """Families for new products whose bound is too low to rule any name out.

    Legacy names that share a character are found as pairs. The
    others have name similarity zero, so only brand and price count: they stand
    together as one family per brand that shares a character, and one of
    everything (``*``). These scores never exceed the true ones, and the best
    two products reach their true score in one of the families.
    """
    low = unsettled.where(F.col("bound") <= _PRICE_OR_BRAND + _SLACK).select("n", "b")
    zero = F.lit(0.0)
    by_brand = low.join(brands, "b").select(
        "n", "b", F.lit(ANY).alias("m"), "c", zero.alias("name_similarity"), "brand_similarity",
        S.base_score(zero, F.col("brand_similarity")).alias("base"), F.lit(False).alias("is_exact"), F.lit(True).alias("leads"))
    everything = low.select(
        "n", "b", F.lit(ANY).alias("m"), F.lit(ANY).alias("c"), zero.alias("name_similarity"),
        zero.alias("brand_similarity"), zero.alias("base"), F.lit(False).alias("is_exact"), F.lit(True).alias("leads"))
    return by_brand.unionByName(everything)


def family_points(legacy: DataFrame, families: DataFrame) -> DataFrame:
    """Price points of the families in use: real ones, and the ``*`` ones asked for."""
    real = legacy_points(legacy.select(F.struct("m", "c").alias("family"), "id", "price"))
    if families.where(F.col("m") == ANY).isEmpty():
        return real
    asked = families.where(F.col("m") == ANY).select(F.struct("m", "c").alias("family")).distinct()
    for brand in (F.col("c"), F.lit(ANY)):
        wide = legacy_points(legacy.select(
            F.struct(F.lit(ANY).alias("m"), brand.alias("c")).alias("family"), "id", "price"))
        real = real.unionByName(wide.join(asked, "family", "left_semi"))
    return real


PER_KEY = ["n", "b", "price"]


def _score(probes: DataFrame, points: Points) -> DataFrame:
    """Scored candidates of the probes, one row per (probe, legacy product).

    A legacy product may be met in more than one family; its best score is the
    true one. One shuffle by probe serves this aggregate and later windows.
    """
    scored = nearest(probes, points).select(
        *PER_KEY, "id", "is_exact",
        S.full_score(F.col("base"), S.price_similarity(F.col("price"), F.col("legacy_price"))).alias("score"))
    return scored.repartition(*PER_KEY).groupBy(*PER_KEY, "id").agg(
        F.max("score").alias("score"), F.max("is_exact").alias("is_exact"))


def _places(scored: DataFrame) -> DataFrame:
    """Best and second-best candidate, and the best exact-name one, per probe."""
    by_score = Window.partitionBy(*PER_KEY).orderBy(F.desc("score"), "id")
    hit = F.struct("score", "id")
    placed = scored.withColumn("_rank", F.row_number().over(by_score))
    exact = F.col("is_exact")
    return placed.groupBy(*PER_KEY).agg(
        F.max(F.when(F.col("_rank") == 1, hit)).alias("first"),
        F.max(F.when(F.col("_rank") == 2, hit)).alias("second"),
        F.min_by(hit, F.when(exact, F.col("_rank"))).alias("exact"),
    )


def rank_candidates(new: DataFrame, legacy: DataFrame, families: DataFrame) -> DataFrame:
    """Winner and runner-up per distinct (name, brand, price) of the new products.

    ``families``: n, b, m, c, base, is_exact, read more than once. The winner
    is the best exact-name candidate, or else the best of all; the runner-up is
    the best of the rest and may out-score an exact-name winner. Ties go to the
    smaller id.

    The leading families are priced first. What they reach rules out most of
    the others, since a price adds at most its weight to a base score.
    """
    points = prepare(staged(family_points(legacy, families), "price-points"))
    asked = new.select(*PER_KEY).distinct()
    family = F.struct("m", "c").alias("family")

    probes = asked.join(families, ["n", "b"])
    kept = [family, *PER_KEY[::-1], "base", "is_exact"]
    lead = staged(_score(probes.where("leads").select(kept), points), "leading-candidates")
    reached = _places(lead).select(
        F.col("n").alias("_n"), F.col("b").alias("_b"), F.col("price").alias("_price"),
        F.col("second.score").alias("second"), F.col("exact.score").alias("exact"))
    same = (F.col("n") == F.col("_n")) & (F.col("b") == F.col("_b")) & (
        F.col("price").eqNullSafe(F.col("_price")))
    most = F.col("base") + K.PRICE_WEIGHT + _SLACK
    rest = probes.where("not leads").join(reached, same).where(
        F.col("second").isNull() | (most >= F.col("second"))
        | (F.col("is_exact") & (most >= F.col("exact"))))
    others = staged(_score(rest.select(kept), points), "other-candidates")
    scored = lead.unionByName(others).groupBy(*PER_KEY, "id").agg(
        F.max("score").alias("score"), F.max("is_exact").alias("is_exact"))
    return staged(
        _places(scored)
        .withColumn("best", F.coalesce("exact", "first"))
        .withColumn("runner_up", F.when(F.col("best.id") == F.col("first.id"), F.col("second"))
                    .otherwise(F.col("first")))
        .select(*PER_KEY, "best", "runner_up", F.col("exact").isNotNull().alias("is_exact")),
        "ranked-candidates")


def describe_proposals(new: DataFrame, legacy: DataFrame, ranked: DataFrame) -> DataFrame:
    """The proposal table: one row per new product, with status and note.

    Legacy names are looked up for the ranked winners, which many products may share.
    """
    names = legacy.select(F.col("id").alias("legacy_id"), "legacy_name").join(
        ranked.select(F.col("best.id").alias("legacy_id")).distinct(), "legacy_id", "left_semi")
    ranked = ranked.join(names, F.col("best.id") == F.col("legacy_id"), "left")
    same = (F.col("p.n") == F.col("r.n")) & (F.col("p.b") == F.col("r.b")) & (
        F.col("p.price").eqNullSafe(F.col("r.price")))
    rows = new.alias("p").join(ranked.alias("r"), same, "left").select(
        "p.new_id", "p.new_name", "r.best", "r.runner_up", "r.is_exact", "r.legacy_name")
    described = rows.select(
        F.col("new_id").alias("new_product_id"),
        F.col("new_name").alias("new_product_name"),
        F.col("best.id").alias("proposed_legacy_product_id"),
        F.col("legacy_name").alias("proposed_legacy_product_name"),
        F.when(F.col("is_exact"), K.EXACT_MATCH).otherwise(K.NEEDS_REVIEW).alias("match_status"),
        S.rounded_score(F.col("best.score")).alias("match_score"),
        F.col("runner_up.id").alias("runner_up_legacy_product_id"),
        S.rounded_score(F.col("runner_up.score")).alias("runner_up_score"),
        F.when(F.col("is_exact"), K.NOTE_EXACT).otherwise(K.NOTE_SUGGESTION).alias("review_note"),
    )
    return demote_repeated(described)


def repeated_candidates(proposals: DataFrame) -> DataFrame:
    """Legacy products that more than one new product proposes."""
    return (
        proposals.groupBy("proposed_legacy_product_id")
        .agg(F.count(F.lit(1)).alias("proposal_count")).where("proposal_count > 1")
    )


def demote_repeated(proposals: DataFrame) -> DataFrame:
    """Send repeated candidates to review, exact names too.

    Counts are aggregated and joined back, so a candidate that a third of all
    products propose does not gather in one window task.
    """
    repeated = repeated_candidates(proposals).select(
        F.col("proposed_legacy_product_id").alias("_id"), F.lit(True).alias("_repeated"))
    joined = proposals.join(
        repeated, F.col("proposed_legacy_product_id").eqNullSafe(F.col("_id")), "left")
    again = F.coalesce("_repeated", F.lit(False))
    return joined.withColumns({
        "match_status": F.when(again, K.NEEDS_REVIEW).otherwise(F.col("match_status")),
        "review_note": F.when(again, K.NOTE_REPEATED).otherwise(F.col("review_note")),
    }).drop("_id", "_repeated")


def propose_crosswalk(new: DataFrame, legacy: DataFrame) -> DataFrame:
    """Propose one legacy product for every new product."""
    left, right = normalised_sides(new, legacy)
    return describe_proposals(left, right, rank_candidates(left, right, scored_families(left, right)))


def match_status_counts(proposals: DataFrame) -> DataFrame:
    return proposals.groupBy("match_status").agg(F.count(F.lit(1)).alias("proposal_count"))


def crosswalk_summary(new: DataFrame, legacy: DataFrame, proposals: DataFrame) -> DataFrame:
    """The one-row summary written beside the proposals."""
    statuses = match_status_counts(proposals).agg(F.map_from_entries(
        F.collect_list(F.struct("match_status", "proposal_count"))).alias("status_counts"))
    counts = side_by_side(
        legacy.agg(F.count(F.lit(1)).alias("legacy_rows")),
        new.agg(F.count(F.lit(1)).alias("new_rows")), statuses)
    return (
        counts.withColumn("scoring", F.struct(
            F.lit(K.NAME_WEIGHT).alias("name"), F.lit(K.BRAND_WEIGHT).alias("brand"),
            F.lit(K.PRICE_WEIGHT).alias("price")))
        .withColumn("note", F.lit(K.NOTE_SUMMARY))
    )
