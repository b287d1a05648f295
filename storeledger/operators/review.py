"""Human review of proposals and the canonical crosswalk it yields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..frames import side_by_side
from ..functions.text import trim_ws


def apply_review(proposals: DataFrame, reviews: DataFrame) -> DataFrame:
    """Canonical crosswalk: exact matches stand, reviewed rows take the decision.

    ``no_legacy_predecessor`` leaves the legacy id empty; the name is the new one.
    """
    decided = reviews.select(
        "new_product_id", "review_decision", F.col("canonical_legacy_product_id").alias("_reviewed"))
    legacy = F.when(F.col("match_status") == K.EXACT_MATCH, F.col("proposed_legacy_product_id")).when(
        F.col("review_decision").isin("accepted", "corrected"), F.col("_reviewed"))
    return proposals.join(decided, "new_product_id", "left").select(
        legacy.alias("legacy_product_id"),
        F.col("new_product_id").alias("canonical_product_id"),
        F.col("new_product_name").alias("canonical_product_name"),
    )


def review_rules(proposals: DataFrame, reviews: DataFrame) -> DataFrame:
    """Violations of the review register, one count per rule (all zero when sound)."""
    flagged = proposals.where(F.col("match_status") == K.NEEDS_REVIEW).select(
        "new_product_id", F.lit(True).alias("is_flagged"))
    per_id = reviews.groupBy("new_product_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(trim_ws(F.coalesce("review_basis", F.lit(""))) == "").alias("blank"),
        F.count_if(~F.coalesce(F.col("reviewed_on").cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$"),
                               F.lit(False))).alias("bad_date"),
        F.count_if(~F.coalesce(F.col("review_decision").isin(*K.REVIEW_DECISIONS),
                               F.lit(False))).alias("bad_decision"),
        F.count_if(~F.coalesce(F.col("match_score").cast("double").between(0, 1),
                               F.lit(True))).alias("bad_score"),
        F.count_if(F.col("review_decision") == "corrected").alias("corrected"),
    )
    both = flagged.join(per_id, "new_product_id", "full")
    return both.agg(
        F.count_if(F.col("reviews").isNull()).alias("unreviewed"),
        F.count_if(F.col("is_flagged").isNull()).alias("not_flagged"),
        F.count_if(F.col("reviews") > 1).alias("repeated_reviews"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (
            ("blank", "blank_basis"), ("bad_date", "invalid_dates"),
            ("bad_decision", "invalid_decisions"), ("bad_score", "scores_out_of_range"))],
        F.when(F.coalesce(F.sum("corrected"), F.lit(0)) == 0, 1).otherwise(0).cast("bigint")
        .alias("no_correction"),
    )


def review_alignment(reviews: DataFrame, canonical: DataFrame) -> DataFrame:
    """Reviewed products whose canonical legacy id or name differs, or is absent."""
    left = reviews.select("new_product_id", "new_product_name", "canonical_legacy_product_id")
    right = canonical.select(
        F.col("canonical_product_id").alias("new_product_id"), "legacy_product_id",
        "canonical_product_name", F.lit(True).alias("_there"))
    return (
        left.join(right, "new_product_id", "left")
        .where(F.col("_there").isNull()
               | ~F.col("canonical_legacy_product_id").eqNullSafe(F.col("legacy_product_id"))
               | ~F.col("new_product_name").eqNullSafe(F.col("canonical_product_name")))
        .drop("_there")
    )


def review_outcomes(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("review_decision").agg(F.count(F.lit(1)).alias("review_count"))


def crosswalk_coverage(proposals: DataFrame, new: DataFrame, legacy: DataFrame) -> DataFrame:
    """Products without a proposal, proposals for unknown products, unknown legacy ids."""
    def count(df, name):
        return df.agg(F.count(F.lit(1)).alias(name))

    offered = proposals.select("new_product_id")
    candidates = proposals.where("proposed_legacy_product_id is not null").select(
        F.col("proposed_legacy_product_id").alias("product_id"))
    return side_by_side(
        count(new.join(offered, "new_product_id", "left_anti"), "without_proposal"),
        count(offered.join(new, "new_product_id", "left_anti"), "unknown_new"),
        count(candidates.join(legacy, "product_id", "left_anti"), "unknown_legacy"),
    )


def collision_price_rank(proposals: DataFrame, new: DataFrame, legacy: DataFrame) -> DataFrame:
    """Among new products that propose one legacy product, the closest price.

    Advisory: every proposal keeps its row, with the price gap and whether it is
    the closest (ties go to the smaller id). The closest is found by a
    pre-aggregating minimum, so a widely proposed product is no bottleneck.
    """
    priced = (
        proposals.join(new.select("new_product_id", F.col("msrp").cast("double").alias("msrp")), "new_product_id")
        .join(legacy.select(F.col("product_id").alias("proposed_legacy_product_id"),
                            F.col("base_price").cast("double").alias("base_price")),
              "proposed_legacy_product_id")
        .select("proposed_legacy_product_id", "new_product_id",
                F.abs(F.col("msrp") - F.col("base_price")).alias("price_gap"))
    )
    closest = priced.groupBy("proposed_legacy_product_id").agg(
        F.min(F.struct("price_gap", "new_product_id")).alias("c"),
        F.count(F.lit(1)).alias("proposal_count"))
    return (
        priced.join(closest.where("proposal_count > 1"), "proposed_legacy_product_id")
        .select("proposed_legacy_product_id", "new_product_id", "price_gap", "proposal_count",
                (F.col("new_product_id") == F.col("c.new_product_id")).alias("is_closest"))
    )
