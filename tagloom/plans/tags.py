"""The tag jobs. Each turns (source, rules) into ``(userId string, tagsId string)``.

Sources hold text columns or typed ones; numbers and times are cast where they
enter a job. Order times are epoch seconds. ``rules`` is ``(id, rule)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import compact_date, days_since, epoch_to_timestamp
from tagloom.functions.scores import RFE_BINS, RFM_BINS, Bins, bin_score, price_sensitivity
from tagloom.functions.shopping import (COLOUR_CODES, FEMALE, FEMALE_COLOURS, FEMALE_TYPES, MALE, TYPE_CODES,
                                        dictionary_code, purchase_label, vote_rule)
from tagloom.functions.texts import item_of_url
from tagloom.operators.aggregates import discount_totals, implicit_ratings, last_event, rfe, rfm, usage_counts
from tagloom.operators.classify import class_labels, hash_split, tree_pipeline
from tagloom.operators.cluster import Centres, assign, clusters_to_tags, elbow, fit_kmeans, rank_tags, select_k
from tagloom.operators.joins import lookup_join
from tagloom.operators.match import match_exact, match_range
from tagloom.operators.ordering import top_n_per_group
from tagloom.operators.recommend import fit_als, items_as_csv, number_ids, numeric_ids, restore_ids, top_items
from tagloom.operators.rules import range_rules
from tagloom.session import materialised
from tagloom.sources.stores import stored_centres


def _tagged(df: DataFrame, user: str) -> DataFrame:
    """Tags by user; rows without a user tag nobody."""
    return df.where(F.col(user).isNotNull()).select(F.col(user).cast("string").alias("userId"),
                                                    F.col("tagsId").cast("string").alias("tagsId"))


# --- rule match -------------------------------------------------------------------------------------------------

def exact_tag(users: DataFrame, rules: DataFrame, value: str, user: str = "id", on_missing: str = "error",
              default: str | None = None) -> DataFrame:
    """Gender and job: the rule equals the user's value."""
    values = users.select(user, F.col(value).cast("string").alias("_value"))
    return _tagged(match_exact(values, "_value", rules, on_missing, default, [user]), user)


def age_tag(users: DataFrame, rules: DataFrame, user: str = "id", birthday: str = "birthday") -> DataFrame:
    """Birth decade: the birthday as ``yyyyMMdd`` lies in the band."""
    days = users.select(user, compact_date(F.col(birthday).cast("string")).try_cast("long").alias("_day"))
    return _tagged(match_range(days, "_day", range_rules(rules), [user]), user)


# --- statistics -------------------------------------------------------------------------------------------------

def recency(orders: DataFrame, as_of: str, shift_days: int = 0) -> DataFrame:
    """``(memberId, days)`` since the last order."""
    times = orders.select("memberId", F.col("finishTime").try_cast("long").alias("finishTime"))
    last = last_event(times, "memberId", "finishTime")
    return last.select("memberId", days_since(epoch_to_timestamp(F.col("last_time")), as_of, shift_days).alias("days"))


def cycle_tag(orders: DataFrame, rules: DataFrame, as_of: str, shift_days: int = 0) -> DataFrame:
    """Consumption cycle: the days since the last order lie in the band."""
    return _cycle(recency(orders, as_of, shift_days), rules)


def cycle_of_state(state: DataFrame, rules: DataFrame, as_of: str, shift_days: int = 0) -> DataFrame:
    """``cycle_tag`` from the orders' state."""
    last = state.groupBy("memberId").agg(days_since(epoch_to_timestamp(F.max("last_time")), as_of, shift_days).alias("days"))
    return _cycle(last, rules)


def _cycle(days: DataFrame, rules: DataFrame) -> DataFrame:
    return _tagged(match_range(days, "days", range_rules(rules), ["memberId"]), "memberId")


def payment_tag(orders: DataFrame, rules: DataFrame, default: str = "other") -> DataFrame:
    """Most used payment method, ties by name; a method without a rule counts as ``default``."""
    methods = orders.select("memberId", F.col("paymentCode").cast("string").alias("paymentCode"))
    return _payment(usage_counts(methods, "memberId", "paymentCode"), rules, default)


def payment_of_state(state: DataFrame, rules: DataFrame, default: str = "other") -> DataFrame:
    """``payment_tag`` from the orders' state."""
    return _payment(state.select("memberId", "paymentCode", F.col("codes").alias("counts")), rules, default)


def _payment(counts: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    top = top_n_per_group(counts, "memberId", [F.desc("counts"), F.asc("paymentCode")], 1)
    return _tagged(match_exact(top.select("memberId", "paymentCode"), "paymentCode", rules, default=default,
                               spread_by=["memberId"]), "memberId")


# --- clustering -------------------------------------------------------------------------------------------------

def rfm_features(orders: DataFrame, as_of: str, shift_days: int = 0) -> DataFrame:
    typed = orders.select("memberId", "orderSn", F.col("orderAmount").try_cast("double").alias("orderAmount"),
                          F.col("finishTime").try_cast("long").alias("finishTime"))
    return (rfm(typed, "memberId", "orderSn", "orderAmount", "finishTime", as_of, shift_days)
            .withColumnRenamed("memberId", "userId"))


def rfe_features(logs: DataFrame, as_of: str, shift_days: int = 0) -> DataFrame:
    typed = logs.select("global_user_id", "loc_url", F.col("log_time").try_cast("timestamp_ntz").alias("log_time"))
    return (rfe(typed, "global_user_id", "loc_url", "log_time", as_of, shift_days)
            .withColumnRenamed("global_user_id", "userId"))


def rfm_of_state(state: DataFrame, as_of: str, shift_days: int = 0) -> DataFrame:
    """``rfm_features`` from the orders' state."""
    return state.groupBy(F.col("memberId").alias("userId")).agg(
        days_since(epoch_to_timestamp(F.max("last_time")), as_of, shift_days).alias("recency"),
        F.sum("orders").alias("frequency"), F.sum("amount").alias("monetary"))


def rfe_of_state(state: DataFrame, as_of: str, shift_days: int = 0) -> DataFrame:
    """``rfe_features`` from the logs' state, which has a row for each page of a user."""
    return state.groupBy(F.col("global_user_id").alias("userId")).agg(
        days_since(F.max("last_visit"), as_of, shift_days).alias("recency"),
        F.sum("views").alias("frequency"), F.count("loc_url").alias("engagements"))


def psm_of_state(state: DataFrame, zero_discount: str = "drop") -> DataFrame:
    """``psm_features`` from the orders' state."""
    totals = state.groupBy("memberId").agg(*[F.sum(c).alias(c) for c in ("tdon", "ton", "tda", "tra")])
    return _sensitivity(totals, zero_discount)


def score(features: DataFrame, bins: Mapping[str, Bins]) -> DataFrame:
    """Replace each feature by its score; a user with a value in a gap has null there."""
    return features.select("userId", *[bin_score(F.col(c), b).cast("int").alias(c) for c, b in bins.items()])


def psm_features(orders: DataFrame, zero_discount: str = "drop") -> DataFrame:
    """``(userId, psm)``. A user without discounted order has none and is dropped, or counts as least
    sensitive (0) with ``zero_discount='least_sensitive'``."""
    typed = orders.select("memberId", F.col("orderAmount").try_cast("double").alias("orderAmount"),
                          F.col("couponCodeValue").try_cast("double").alias("couponCodeValue"))
    return _sensitivity(discount_totals(typed, "memberId", "orderAmount", "couponCodeValue"), zero_discount)


def _sensitivity(totals: DataFrame, zero_discount: str) -> DataFrame:
    psm = totals.select(F.col("memberId").alias("userId"), price_sensitivity(
        F.col("tdon"), F.col("ton"), F.col("tda"), F.col("tra")).alias("psm"))
    if zero_discount == "least_sensitive":
        return psm.withColumn("psm", F.coalesce("psm", F.lit(0.0)))
    return psm.where(F.col("psm").isNotNull())


def cluster_tag(features: DataFrame, columns: Sequence[str], rules: DataFrame, centres: Centres | None = None,
                seed: int = 200, max_iter: int = 20, model_path: str | None = None, refresh: bool = False,
                numeric_rank: bool = False) -> DataFrame:
    """Cluster the users into as many groups as there are rules; the group with the highest centre sum gets
    the first rule. Users with a null feature are left out. Given ``centres`` are used as they are."""
    spark = features.sparkSession
    users = features.dropna(subset=list(columns))
    if centres is None:
        k = rules.count()

        def fit():
            # Read by the fit and by the assignment; far smaller than the source it sums up.
            nonlocal users
            users = materialised(users)
            return fit_kmeans(users, columns, k, seed, max_iter)

        centres = stored_centres(spark, model_path, k, columns, fit, refresh) if model_path else fit()
    return clusters_to_tags(assign(users, columns, centres), rank_tags(features, centres, rules, numeric_rank))


def rfm_tag(orders: DataFrame, rules: DataFrame, as_of: str, shift_days: int = 0,
            bins: Mapping[str, Bins] = RFM_BINS, **clustering) -> DataFrame:
    """Customer value from recency, frequency and monetary scores."""
    return cluster_tag(score(rfm_features(orders, as_of, shift_days), bins), list(bins), rules, **clustering)


def rfm_elbow(orders: DataFrame, as_of: str, shift_days: int = 0, bins: Mapping[str, Bins] = RFM_BINS,
              ks: Sequence[int] = range(3, 10), seed: int = 200) -> DataFrame:
    """Error of the customer-value clusters for each k."""
    return elbow(score(rfm_features(orders, as_of, shift_days), bins), list(bins), ks, seed)


def rfe_tag(logs: DataFrame, rules: DataFrame, as_of: str, shift_days: int = 0,
            bins: Mapping[str, Bins] = RFE_BINS, seed: int = 100, **clustering) -> DataFrame:
    """Activity from recency, frequency and engagement scores of web visits."""
    return cluster_tag(score(rfe_features(logs, as_of, shift_days), bins), list(bins), rules, seed=seed, **clustering)


def psm_tag(orders: DataFrame, rules: DataFrame, zero_discount: str = "drop", seed: int = 100, **clustering) -> DataFrame:
    """Price sensitivity."""
    return cluster_tag(psm_features(orders, zero_discount), ["psm"], rules, seed=seed, **clustering)


def psm_cluster_count(orders: DataFrame, ks: Sequence[int] = range(2, 10), seed: int = 100) -> int:
    """Number of price-sensitivity groups suggested by the elbow of the error."""
    return select_k(elbow(psm_features(orders), ["psm"], ks, seed))


# --- supervised -------------------------------------------------------------------------------------------------

def purchases(goods: DataFrame, orders: DataFrame, colours: Mapping[str, int] = COLOUR_CODES,
              types: Mapping[str, int] = TYPE_CODES, female_colours: Sequence[str] = FEMALE_COLOURS,
              female_types: Sequence[str] = FEMALE_TYPES) -> DataFrame:
    """``(userId, cOrderSn, color, productType, gender, n)``: bought goods as codes with the rule label.

    The items are counted per order before they meet the orders, so an order
    brings at most as many rows to the join as there are code pairs.
    """
    counted = goods.groupBy(
        "cOrderSn", dictionary_code(F.col("ogColor"), colours).alias("color"),
        dictionary_code(F.col("productType"), types).alias("productType"),
        purchase_label(F.col("ogColor"), F.col("productType"), female_colours, female_types).alias("gender"),
    ).agg(F.count("*").alias("n"))
    users = orders.select("orderSn", F.col("memberId").alias("userId"))
    return counted.join(users, F.col("cOrderSn") == F.col("orderSn")).drop("orderSn")


def vote_tag(predicted: DataFrame, rules: DataFrame, prediction: str) -> DataFrame:
    """Tag of the gender that most of a user's ``n`` purchases are predicted as."""
    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("double")

    counted = predicted.groupBy("userId").agg(
        total(F.col(prediction) == MALE).alias("male"), total(F.col(prediction) == FEMALE).alias("female"),
        F.sum("n").cast("double").alias("total"))
    outcome = counted.withColumn("_rule", vote_rule(F.col("male"), F.col("female"), F.col("total")))
    return _tagged(match_exact(outcome.select("userId", "_rule"), "_rule", rules, spread_by=["userId"]), "userId")


def label_tag(bought: DataFrame, rules: DataFrame) -> DataFrame:
    """Shopping gender with the rule label taken as the prediction."""
    return vote_tag(bought, rules, "gender")


def train_purchase_tree(bought: DataFrame, train_share: float = 0.8, seed: int = 100, trees: int = 1
                        ) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Learn the label from the codes; returns the model, the predicted purchases per user and the confusion
    counts by ``part``.

    Purchases are counted per user and code pair first. The tree is grown on
    the counted code pairs, whose number is bounded by the two dictionaries.
    """
    split = hash_split(bought, ["cOrderSn", "color", "productType"], train_share, seed)
    per_user = materialised(split.groupBy("userId", "color", "productType", "gender", "part")
                            .agg(F.sum("n").alias("n")))
    cases = materialised(per_user.groupBy("color", "productType", "gender", "part")
                         .agg(F.sum("n").cast("double").alias("weight")))
    labels = class_labels(cases, "gender")
    model = tree_pipeline(["color", "productType"], "gender", labels, trees, seed=seed).fit(
        cases.where(F.col("part") == "train"))
    codes = F.struct("color", "productType")
    predictions = (model.transform(cases.dropDuplicates(["color", "productType"]))
                   .select(codes.alias("_pair"), "predict_string"))
    predicted = lookup_join(per_user.withColumn("_codes", codes), predictions, "_codes", "_pair", "inner",
                            ["userId", "gender", "part"]).drop("_codes")
    counts = predicted.groupBy("part", F.col("gender").alias("label"), F.col("predict_string").alias("prediction")
                               ).agg(F.sum("n").alias("n"))
    return model, predicted, counts


def usg_tag(goods: DataFrame, rules: DataFrame, orders: DataFrame, trees: int = 1, **codes) -> DataFrame:
    """Shopping gender: what a tree learned from the purchases says about each of them, by majority."""
    _, predicted, _ = train_purchase_tree(purchases(goods, orders, **codes), trees=trees)
    return vote_tag(predicted, rules, "predict_string")


# --- recommendation ---------------------------------------------------------------------------------------------

def clicks(logs: DataFrame) -> DataFrame:
    """``(user, item, rating)``: clicks per user and visited product."""
    visits = logs.select(F.col("global_user_id").alias("user"), item_of_url(F.col("loc_url")).alias("item"))
    return implicit_ratings(visits, "user", "item")


def bp_ratings(logs: DataFrame) -> DataFrame:
    """The clicks with integer ids."""
    return numeric_ids(clicks(logs), "user", "item")


def bp_tag(logs: DataFrame, rules: DataFrame | None = None, n: int = 5, seed: int = 1) -> DataFrame:
    """Preferred products: the ``n`` best items by implicit feedback, as a list of item ids.

    ALS takes 32-bit ids, so all ids, of any size or text, are numbered first and put back at the end.
    """
    ratings, users, items = number_ids(clicks(logs), "user", "item")
    return items_as_csv(restore_ids(top_items(fit_als(ratings, implicit=True, seed=seed), n), users, items))
