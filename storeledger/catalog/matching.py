"""Product matching, review and crosswalk queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import similarity as SIM
from ..operators import crosswalk as X
from ..operators import review as R
from ..plans.crosswalk import build_crosswalk
from . import testbed as T


def _sides(spark, sf):
    return X.new_side(T.new_products(spark, sf)), X.legacy_side(T.legacy_products(spark, sf))


def _ranked(spark, sf):
    """Winner and runner-up of every new product."""
    new, legacy = X.normalised_sides(T.new_products(spark, sf), T.legacy_products(spark, sf))
    ranked = X.rank_candidates(new, legacy, X.scored_families(new, legacy)).withColumnsRenamed(
        {"n": "_n", "b": "_b", "price": "_price"})
    same = (F.col("n") == F.col("_n")) & (F.col("b") == F.col("_b")) & F.col("price").eqNullSafe(F.col("_price"))
    return new.join(ranked, same)


def _place(ranked, place):
    return ranked.where(F.col(place).isNotNull()).select(
        "new_id", F.col(f"{place}.id").alias("legacy_id"), F.col(f"{place}.score").alias("score"))


def exact_name_match(spark, sf):
    return X.exact_name_match(*_sides(spark, sf))


def best_candidate(spark, sf):
    return _place(_ranked(spark, sf), "best")


def runner_up(spark, sf):
    return _place(_ranked(spark, sf), "runner_up")


def price_similarity(spark, sf):
    """Price of each line against the retail price of its part."""
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    part = T.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return li.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        SIM.price_similarity(F.col("l_extendedprice"), F.col("p_retailprice")).alias("similarity"))


def text_similarity(spark, sf):
    """Every pair of a new and a legacy name of a similarity of 0.6 or more."""
    return X.similar_names(*_sides(spark, sf), 0.6)


def product_match_candidates(spark, sf):
    """The scored pairs that decide about each new product: its winner and its runner-up."""
    places = F.array(*[F.struct(F.lit(p).alias("place"), F.col(p).alias("hit")) for p in ("best", "runner_up")])
    return _ranked(spark, sf).select("new_id", F.inline(places)).where("hit is not null").select(
        "new_id", F.col("hit.id").alias("legacy_id"), F.col("hit.score").alias("score"), "place")


def propose_crosswalk(spark, sf):
    return build_crosswalk(T.legacy_products(spark, sf), T.new_products(spark, sf))


def match_status_counts(spark, sf):
    return X.match_status_counts(propose_crosswalk(spark, sf))


def repeated_candidates(spark, sf):
    return X.repeated_candidates(propose_crosswalk(spark, sf))


def collision_price_rank(spark, sf):
    return R.collision_price_rank(
        propose_crosswalk(spark, sf), T.new_products(spark, sf), T.legacy_products(spark, sf))


def crosswalk_coverage(spark, sf):
    """Proposals against registers that know some products under other ids."""
    new = T.new_products(spark, sf).withColumn(
        "new_product_id", F.when(F.col("class") == "size 7", F.concat(F.lit("X"), "new_product_id")).otherwise(F.col("new_product_id")))
    legacy = T.legacy_products(spark, sf).withColumn(
        "product_id", F.when(F.col("subcategory") == "size 8", F.concat(F.lit("X"), "product_id")).otherwise(F.col("product_id")))
    return R.crosswalk_coverage(propose_crosswalk(spark, sf), new, legacy)


# Part attributes stand in for proposals and a register: promoted parts are
# flagged, and how they were decided follows from brand and size. The register
# holds all parts; most of those that are not flagged stand under foreign ids, two to an id.

def _proposals(spark, sf):
    return T.table(spark, sf, "part").select(
        F.concat(F.lit("NP"), "p_partkey").alias("new_product_id"),
        F.col("p_name").alias("new_product_name"),
        F.concat(F.lit("P"), "p_partkey").alias("proposed_legacy_product_id"),
        F.when(F.col("p_type") == "PROMO", K.NEEDS_REVIEW).otherwise(K.EXACT_MATCH).alias("match_status"))


def _reviews(spark, sf):
    size = F.col("p_size")
    known = F.expr("p_size > 2 and (p_type = 'PROMO' or (p_type = 'LARGE' and p_size = 50))")
    foreign = F.concat(F.lit("XX"), F.expr("p_partkey - p_partkey % 2"))
    return T.table(spark, sf, "part").select(
        F.when(known, F.concat(F.lit("NP"), "p_partkey")).otherwise(foreign).alias("new_product_id"),
        F.col("p_name").alias("new_product_name"),
        (F.col("p_retailprice") / 950).alias("match_score"),
        F.when(size > 10, F.concat(F.lit("P"), F.col("p_partkey") + F.when(size > 45, 1).otherwise(0)))
        .alias("canonical_legacy_product_id"),
        F.when(size <= 10, "no_legacy_predecessor").when(size > 45, "corrected")
        .when(size == 30, "undecided").otherwise("accepted").alias("review_decision"),
        F.when(size == 20, " ").otherwise("Same family and brand.").alias("review_basis"),
        F.when(size == 25, "09/08/2026").otherwise("2026-09-08").alias("reviewed_on"))


def apply_review(spark, sf):
    return R.apply_review(_proposals(spark, sf), _reviews(spark, sf))


def review_rules(spark, sf):
    return R.review_rules(_proposals(spark, sf), _reviews(spark, sf))


def review_alignment(spark, sf):
    return R.review_alignment(_reviews(spark, sf), T.crosswalk(spark, sf))


def review_outcomes(spark, sf):
    return R.review_outcomes(_reviews(spark, sf))


def _norm(column):
    return f"array_to_string(regexp_extract_all(replace(lower({column}), '&', ' and '), '[a-z0-9]+'), ' ')"


def _block(x, y):
    """The longest block that x and y share, earliest in x, as 1000 times its length less its place in x."""
    return f"""list_max(flatten(list_transform(range(1, length({x}) + 1), lambda i: list_transform(
      list_filter(range(1, length({x}) - i + 2), lambda k: contains({y}, substr({x}, i, k))), lambda k: 1000 * k - i))))"""


def _ratios(pairs):
    """CTEs that end in ``ratios(x, y, ratio)`` for the rows of ``pairs(x, y)``: the longest shared block, then
    the parts before it and the parts after it, each in the same way."""
    return f"""
asked AS ({pairs}),
steps AS (
  SELECT x, y, x AS p, y AS q, {_block('x', 'y')} AS block FROM asked
  UNION ALL
  SELECT x, y, p, q, {_block('p', 'q')} FROM (
    SELECT x, y, unnest([substr(p, 1, s - 1), substr(p, s + k)]) AS p, unnest([substr(q, 1, t - 1), substr(q, t + k)]) AS q
    FROM (SELECT *, instr(q, substr(p, s, k)) AS t FROM (
      SELECT x, y, p, q, (block + 999) // 1000 AS k, (block + 999) // 1000 * 1000 - block AS s FROM steps WHERE block IS NOT NULL)))
  WHERE p <> '' AND q <> ''),
ratios AS MATERIALIZED (
  SELECT x, y, CASE WHEN x = '' AND y = '' THEN CAST(1 AS DOUBLE)
         ELSE 2 * CAST(coalesce(sum((block + 999) // 1000), 0) AS DOUBLE) / (length(x) + length(y)) END AS ratio
  FROM steps GROUP BY x, y)"""


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


_SIDES = f"""WITH RECURSIVE {T.PRODUCTS},
n AS (SELECT new_product_id, item_name, {_norm('item_name')} AS n, {_norm('brand_name')} AS b, msrp AS price FROM new_products),
l AS (SELECT product_id, product_name, {_norm('product_name')} AS m, {_norm('brand')} AS c, base_price AS price FROM legacy_products),"""

# Every pair of products, scored: quadratic, for comparison only.
_PAIRS = _SIDES + _ratios("""SELECT x, y FROM (SELECT DISTINCT n AS x FROM n), (SELECT DISTINCT m AS y FROM l)
  UNION SELECT x, y FROM (SELECT DISTINCT b AS x FROM n), (SELECT DISTINCT c AS y FROM l)""") + """,
scored AS (
  SELECT new_product_id, product_id, replace(n.n, ' ', '') <> replace(l.m, ' ', '') AS differs,
         -((CAST(0.7 AS DOUBLE) * names.ratio + CAST(0.2 AS DOUBLE) * brands.ratio)
         + CAST(0.1 AS DOUBLE) * coalesce(greatest(0, 1 - abs(n.price - l.price) / greatest(n.price, l.price, 1)), 0)) AS minus
  FROM n CROSS JOIN l JOIN ratios names ON names.x = n.n AND names.y = l.m JOIN ratios brands ON brands.x = n.b AND brands.y = l.c),
placed AS MATERIALIZED (
  SELECT new_product_id, min({'differs': differs, 'minus': minus, 'id': product_id}) AS best, min({'minus': minus, 'id': product_id}, 2) AS two
  FROM scored GROUP BY 1),
winners AS (
  SELECT new_product_id, item_name, n.price AS msrp, l.product_id, product_name, l.price AS base_price, NOT best.differs AS exact, -best.minus AS score,
         two, count(*) OVER (PARTITION BY l.product_id) AS proposals
  FROM placed JOIN n USING (new_product_id) JOIN l ON l.product_id = best.id),
runners AS (
  SELECT new_product_id, two.id AS product_id, -two.minus AS score
  FROM (SELECT new_product_id, CASE WHEN two[1].id = product_id THEN two[2] ELSE two[1] END AS two FROM winners) WHERE two IS NOT NULL)
"""
_REVIEWS = """
reviews AS (
  SELECT CASE WHEN p_size > 2 AND (p_type = 'PROMO' OR (p_type = 'LARGE' AND p_size = 50)) THEN 'NP' || p_partkey
         ELSE 'XX' || (p_partkey - p_partkey % 2) END AS new_product_id, p_name AS new_product_name, p_retailprice / 950 AS match_score,
         CASE WHEN p_size > 45 THEN 'P' || (p_partkey + 1) WHEN p_size > 10 THEN 'P' || p_partkey END AS canonical_legacy_product_id,
         CASE WHEN p_size <= 10 THEN 'no_legacy_predecessor' WHEN p_size > 45 THEN 'corrected' WHEN p_size = 30 THEN 'undecided' ELSE 'accepted' END AS review_decision,
         p_size
  FROM part)
"""

QUERIES = {
    "exact_name_match": (exact_name_match, _SIDES[:-1] + """SELECT n.new_product_id AS new_id, replace(n.n, ' ', '') AS key, count(*) AS legacy_products
        FROM n JOIN l ON replace(n.n, ' ', '') = replace(l.m, ' ', '') GROUP BY 1, 2"""),
    "best_candidate": (best_candidate, _PAIRS + "SELECT new_product_id AS new_id, product_id AS legacy_id, score FROM winners"),
    "runner_up": (runner_up, _PAIRS + "SELECT new_product_id AS new_id, product_id AS legacy_id, score FROM runners"),
    "price_similarity": (price_similarity, """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        greatest(0, 1 - abs(l_extendedprice - p_retailprice) / greatest(l_extendedprice, p_retailprice, 1)) AS similarity
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "text_similarity": (text_similarity, _SIDES + _ratios("SELECT DISTINCT n.n AS x, l.m AS y FROM n CROSS JOIN l") + """
        SELECT x AS n, y AS m, ratio AS name_similarity FROM ratios WHERE ratio >= CAST(0.6 AS DOUBLE) AND x <> ''"""),
    "product_match_candidates": (product_match_candidates, _PAIRS + """SELECT new_product_id AS new_id, product_id AS legacy_id, score, 'best' AS place FROM winners
        UNION ALL SELECT new_product_id, product_id, score, 'runner_up' FROM runners"""),
    "propose_crosswalk": (propose_crosswalk, _PAIRS + f"""SELECT w.new_product_id, w.item_name AS new_product_name,
        w.product_id AS proposed_legacy_product_id, w.product_name AS proposed_legacy_product_name,
        CASE WHEN w.exact AND w.proposals = 1 THEN '{K.EXACT_MATCH}' ELSE '{K.NEEDS_REVIEW}' END AS match_status,
        CAST(printf('%.4f', w.score) AS DOUBLE) AS match_score, r.product_id AS runner_up_legacy_product_id,
        CAST(printf('%.4f', r.score) AS DOUBLE) AS runner_up_score,
        CASE WHEN w.proposals > 1 THEN {_quoted(K.NOTE_REPEATED)} WHEN w.exact THEN {_quoted(K.NOTE_EXACT)} ELSE {_quoted(K.NOTE_SUGGESTION)} END AS review_note
        FROM winners w LEFT JOIN runners r USING (new_product_id)"""),
    "match_status_counts": (match_status_counts, _PAIRS + f"""SELECT CASE WHEN exact AND proposals = 1 THEN '{K.EXACT_MATCH}' ELSE '{K.NEEDS_REVIEW}' END AS match_status,
        count(*) AS proposal_count FROM winners GROUP BY 1"""),
    "repeated_candidates": (repeated_candidates, _PAIRS + """SELECT product_id AS proposed_legacy_product_id, count(*) AS proposal_count
        FROM winners GROUP BY 1 HAVING count(*) > 1"""),
    "collision_price_rank": (collision_price_rank, _PAIRS + """SELECT product_id AS proposed_legacy_product_id, new_product_id,
        abs(msrp - base_price) AS price_gap, proposals AS proposal_count,
        row_number() OVER (PARTITION BY product_id ORDER BY abs(msrp - base_price), new_product_id) = 1 AS is_closest
        FROM winners WHERE proposals > 1"""),
    "crosswalk_coverage": (crosswalk_coverage, _PAIRS + """SELECT (SELECT count(*) FROM new_products WHERE "class" = 'size 7') AS without_proposal,
        (SELECT count(*) FROM new_products WHERE "class" = 'size 7') AS unknown_new,
        (SELECT count(*) FROM winners JOIN legacy_products USING (product_id) WHERE subcategory = 'size 8') AS unknown_legacy"""),
    "apply_review": (apply_review, f"""WITH {_REVIEWS} SELECT CASE WHEN p_type <> 'PROMO' THEN 'P' || p_partkey
          WHEN r.review_decision IN ('accepted', 'corrected') THEN r.canonical_legacy_product_id END AS legacy_product_id,
        'NP' || p_partkey AS canonical_product_id, p_name AS canonical_product_name
        FROM part LEFT JOIN reviews r ON r.new_product_id = 'NP' || p_partkey"""),
    "review_rules": (review_rules, f"""WITH {_REVIEWS} SELECT
        (SELECT count(*) FROM part WHERE p_type = 'PROMO' AND 'NP' || p_partkey NOT IN (SELECT new_product_id FROM reviews)) AS unreviewed,
        (SELECT count(DISTINCT new_product_id) FROM reviews WHERE new_product_id NOT IN (SELECT 'NP' || p_partkey FROM part WHERE p_type = 'PROMO')) AS not_flagged,
        (SELECT count(*) FROM (SELECT new_product_id FROM reviews GROUP BY 1 HAVING count(*) > 1)) AS repeated_reviews,
        count(*) FILTER (WHERE p_size = 20) AS blank_basis, count(*) FILTER (WHERE p_size = 25) AS invalid_dates,
        count(*) FILTER (WHERE p_size = 30) AS invalid_decisions, count(*) FILTER (WHERE match_score > 1) AS scores_out_of_range,
        CASE WHEN count(*) FILTER (WHERE p_size > 45) = 0 THEN 1 ELSE 0 END AS no_correction FROM reviews"""),
    "review_alignment": (review_alignment, f"""WITH {_REVIEWS}, {T.PRODUCTS} SELECT r.new_product_id, r.new_product_name, r.canonical_legacy_product_id,
        x.legacy_product_id, x.canonical_product_name FROM reviews r LEFT JOIN crosswalk x ON x.canonical_product_id = r.new_product_id
        WHERE x.canonical_product_id IS NULL OR r.canonical_legacy_product_id IS DISTINCT FROM x.legacy_product_id
          OR r.new_product_name IS DISTINCT FROM x.canonical_product_name"""),
    "review_outcomes": (review_outcomes, f"WITH {_REVIEWS} SELECT review_decision, count(*) AS review_count FROM reviews GROUP BY 1"),
}
