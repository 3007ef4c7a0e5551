"""Registered queries: every operator applied to whole tables of the given data set."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.missing import member_of
from tallyframe.functions.numeric import matches
from tallyframe.functions.text import id_to_text, normalize_label, recode, trim_lower
from tallyframe.operators import assoc, cardinality, drift, encode, metrics, outliers, profile, rates, split, states, tables
from tallyframe.operators.boosting import BINS, SecondOrderBoosting
from tallyframe.operators.models import BOOSTED, FOREST, LOGISTIC, default_models, older_models, source_models
from tallyframe.plans import adversarial, benchmark, pipeline, prepare, scoring
from tallyframe.session import checkpoint_dir, small_table, stage
from tallyframe.sources.files import read_csv, write_checked, write_csv
from tallyframe.spec import TableSpec
from workload.views import SPLIT_DAY, base, dirty, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

LINEITEM_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DIRTY_NUMS = ["price", "cost", "hours"]
DIRTY_CATS = ["segment_raw", "priority_raw", "priority_got", "nation"]


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison: the last bits of a sum depend on the order of addition."""
    return df.withColumns({n: F.round(n, digits) for n, kind in df.dtypes if kind == "double"})


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("y", (F.col("event_type") == "purchase").cast("int"))


def staged(spark: SparkSession, sf: str, *columns: str, balance: bool = False) -> DataFrame:
    """The joined input written once, for operators that read it several times: a rescan of a few
    columns is cheap, repeating the join is not.
    """
    rows = dirty(spark, sf)
    return stage(rows.select(*columns) if columns else rows, "labelled-rows", balance)


def early(df: DataFrame) -> DataFrame:
    return df.where(F.col("d") < F.lit(SPLIT_DAY))


def late(df: DataFrame) -> DataFrame:
    return df.where(F.col("d") >= F.lit(SPLIT_DAY))


# ---- target rates ---------------------------------------------------------------------------

@register
def rate_by_category(spark, sf):
    return rounded(rates.rate_by_category(base(spark, sf), "segment", "y"))


@register
def rate_by_category_clean(spark, sf):
    clean = rates.normalized(dirty(spark, sf).select("segment_raw", "y"), ["segment_raw"])
    return rounded(rates.rate_by_category(clean, "segment_raw", "y", min_count=20, top_n=5))


@register
def rate_by_id(spark, sf):
    return rounded(rates.rate_by_id(dirty(spark, sf), "agent_id", "y"))


@register
def rate_nonnull(spark, sf):
    clean = rates.normalized(dirty(spark, sf).select("priority_raw", "y"), ["priority_raw"])
    return rounded(rates.rate_nonnull(clean, "priority_raw", "y"))


@register
def overall_rate(spark, sf):
    return rounded(rates.overall_rate(base(spark, sf), "y"))


@register
def top_category_rates(spark, sf):
    return rounded(rates.top_category_rates(base(spark, sf), "nation", "y"))


@register
def rate_by_bins(spark, sf):
    return rounded(rates.rate_by_bins(stage(base(spark, sf).select("bal", "y"), "labelled-rows"), "bal", "y", bins=8))


@register
def rate_by_bins_repeats(spark, sf):
    return rounded(rates.rate_by_bins(lineitem(spark, sf), "l_discount", "y", bins=16))


@register
def rate_by_bins_events(spark, sf):
    return rounded(rates.rate_by_bins(events(spark, sf), "value", "y", bins=6))


@register
def rate_over_time(spark, sf):
    return rounded(rates.rate_over_time(dirty(spark, sf), "date_raw", "y"))


@register
def rate_over_time_daily(spark, sf):
    return rounded(rates.rate_over_time(events(spark, sf), "ts", "y", freq="D"))


@register
def missing_vs_target(spark, sf):
    return rates.missing_vs_target(dirty(spark, sf), ["agent_id", "company_id", "cost", "priority_raw"], "y")


@register
def freq_and_rate(spark, sf):
    return rounded(rates.freq_and_rate(dirty(spark, sf), "segment_raw", "y"))


@register
def cat_rate_table(spark, sf):
    return rates.cat_rate_table(dirty(spark, sf), DIRTY_CATS, "y", normalize=True)


@register
def presence_rate(spark, sf):
    return rounded(rates.presence_rate(dirty(spark, sf), "company_id", "y"))


@register
def leading_ids(spark, sf):
    return rounded(rates.rate_by_id(lineitem(spark, sf), "l_partkey", "y", min_count=5, many_values=True))


@register
def leading_ids_table(spark, sf):
    return rates.cat_rate_table(lineitem(spark, sf), ["l_partkey", "l_suppkey", "l_orderkey"], "y", many_values=True, min_count=2)


@register
def leading_ids_by_target(spark, sf):
    return profile.top_counts_by_target(lineitem(spark, sf), "l_suppkey", "l_returnflag", many_values=True)


@register
def presence_describe(spark, sf):
    return rounded(rates.presence_describe(staged(spark, sf, "company_id", "y"), "company_id", "y"))


@register
def segment_means(spark, sf):
    return rounded(rates.segment_means(dirty(spark, sf), "cost", "y", 5000.0))


@register
def group_zscore(spark, sf):
    return rounded(rates.group_zscore(dirty(spark, sf), "agent_id", "y"))


@register
def group_zscore_display(spark, sf):
    return rounded(rates.group_zscore(base(spark, sf), "nation", "y", percent=True))


# ---- profiles -------------------------------------------------------------------------------

@register
def table_shape(spark, sf):
    return tables.shape(table(spark, sf, "lineitem"))


@register
def table_shapes(spark, sf):
    rows = dirty(spark, sf)
    a, b = early(rows), late(rows).drop("y")
    return tables.shapes({"train": a, "test": b, "combined": drift.tag_sources(a, b)})


@register
def column_catalogue(spark, sf):
    return tables.column_catalogue(dirty(spark, sf))


@register
def first_rows(spark, sf):
    return tables.first_rows(table(spark, sf, "orders"), 20, "o_orderkey").withColumn("o_orderdate", F.to_date("o_orderdate"))


@register
def key_check(spark, sf):
    orders = tables.key_check(table(spark, sf, "orders"), "o_orderkey")
    lines = tables.key_check(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return tables.stack_tables([
        orders.withColumn("data", F.lit("orders")), lines.withColumn("data", F.lit("lineitem")),
    ])


@register
def value_counts(spark, sf):
    return rounded(profile.value_counts(dirty(spark, sf), "segment_raw"))


@register
def value_counts_with_missing(spark, sf):
    return rounded(profile.value_counts(dirty(spark, sf), "agent_id", dropna=False))


@register
def target_balance(spark, sf):
    return profile.target_balance(base(spark, sf), "y")


@register
def null_summary(spark, sf):
    return rounded(profile.null_summary(dirty(spark, sf)))


@register
def missing_compare(spark, sf):
    rows = dirty(spark, sf)
    return rounded(profile.missing_compare(early(rows), late(rows).drop("company_id")))


@register
def cat_summary(spark, sf):
    return profile.cat_summary(dirty(spark, sf), [*DIRTY_CATS, "agent_id", "company_id"])


@register
def cat_summary_clean(spark, sf):
    return profile.cat_summary(dirty(spark, sf), DIRTY_CATS, normalize=True)


@register
def distinct_counts(spark, sf):
    return profile.distinct_counts(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey", "l_returnflag", "l_tax"])


@register
def describe(spark, sf):
    return rounded(profile.describe(lineitem(spark, sf), ["l_orderkey", *LINEITEM_NUMS]), 4)


@register
def num_summary(spark, sf):
    return rounded(profile.num_summary(staged(spark, sf, *DIRTY_NUMS, "y"), DIRTY_NUMS, "y"))


@register
def num_summary_lineitem(spark, sf):
    return rounded(profile.num_summary(lineitem(spark, sf), LINEITEM_NUMS, "y"), 4)


@register
def quantile_ladder(spark, sf):
    return rounded(profile.quantile_ladder(staged(spark, sf, *DIRTY_NUMS), DIRTY_NUMS))


@register
def largest_values(spark, sf):
    return profile.largest_values(lineitem(spark, sf), LINEITEM_NUMS)


@register
def histogram(spark, sf):
    return rounded(profile.histogram(lineitem(spark, sf), "l_extendedprice"))


@register
def histogram_by_target(spark, sf):
    return rounded(profile.histogram(events(spark, sf), "value", "y"))


@register
def box_stats(spark, sf):
    return rounded(profile.box_stats(staged(spark, sf, "price", "y"), "price", "y"))


@register
def top_counts_by_target(spark, sf):
    return profile.top_counts_by_target(dirty(spark, sf), "agent_id", "y")


# ---- correlation ----------------------------------------------------------------------------

@register
def corr_target(spark, sf):
    return rounded(assoc.corr_target(dirty(spark, sf), DIRTY_NUMS, "y"))


@register
def corr_matrix(spark, sf):
    return rounded(assoc.corr_matrix(lineitem(spark, sf), LINEITEM_NUMS))


@register
def corr_pairs(spark, sf):
    capped, _ = outliers.capped_copy(staged(spark, sf, *DIRTY_NUMS, "agent_id", "company_id", "y"), ["hours", "cost"])
    return rounded(assoc.corr_pairs(capped, [*DIRTY_NUMS, "agent_id", "company_id", "y"], threshold=0.005))


# ---- outliers -------------------------------------------------------------------------------

@register
def cap_report(spark, sf):
    return rounded(outliers.capped_copy(dirty(spark, sf), ["hours", "cost"])[1])


@register
def capped_values(spark, sf):
    return rounded(outliers.capped_copy(dirty(spark, sf).select("id", "hours", "cost"), ["hours", "cost"])[0])


@register
def clip_fixed(spark, sf):
    rows = dirty(spark, sf).select("id", "hours", "cost")
    return outliers.clip_fixed(rows, {"hours": (0, 8), "cost": (None, 500), "absent": (0, 1)})


@register
def sus_columns(spark, sf):
    return rounded(outliers.sus_columns(staged(spark, sf, *DIRTY_NUMS), DIRTY_NUMS))


@register
def contradictions(spark, sf):
    rules = {
        "tax above discount": F.col("l_tax") > F.col("l_discount"),
        "quantity above line number": F.col("l_quantity") > F.col("l_linenumber"),
    }
    return tables.contradictions(table(spark, sf, "lineitem"), rules)


# ---- cleaning -------------------------------------------------------------------------------

@register
def normalize_categories(spark, sf):
    return dirty(spark, sf).select("id", *[normalize_label(F.col(c)).alias(c) for c in DIRTY_CATS])


@register
def normalize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", normalize_label(F.col("source")).alias("source"),
                                                trim_lower(F.col("lang")).alias("lang"))


@register
def trim_lower_labels(spark, sf):
    return dirty(spark, sf).select("id", *[trim_lower(F.col(c)).alias(c) for c in DIRTY_CATS])


@register
def identifiers_as_text(spark, sf):
    return dirty(spark, sf).select("id", *[id_to_text(F.col(c)).alias(c) for c in ("agent_id", "company_id")])


@register
def recode_and_membership(spark, sf):
    nation = recode(F.col("nation"), {"nation7": "nation8", "nation9": "NINE"})
    return dirty(spark, sf).select(
        "id", nation.alias("nation"), member_of(F.col("segment_raw"), ["BUILDING", "?"]).alias("is_listed")
    )


@register
def match_flag(spark, sf):
    return dirty(spark, sf).select("id", matches(F.col("priority_raw"), F.col("priority_got")).alias("received"))


# ---- cardinality ----------------------------------------------------------------------------

@register
def coverage(spark, sf):
    return rounded(cardinality.coverage(dirty(spark, sf), "agent_id", thresholds=(150, 310, 320)))


@register
def keep_set(spark, sf):
    return cardinality.keep_by_min_count(base(spark, sf), "nation", 600)


@register
def keep_describe(spark, sf):
    rows = dirty(spark, sf)
    return rounded(cardinality.describe_keep(rows, "agent_id", cardinality.keep_by_min_count(rows, "agent_id", 310)))


@register
def reduce_cardinality(spark, sf):
    rows = dirty(spark, sf).select("id", "d", "nation", id_to_text(F.col("agent_id")).alias("agent_id"), "company_id")
    reduced = cardinality.reduce_cardinality(
        rows, early(rows), {"nation": 460, "agent_id": 240}, {"nation": {"nation7": "nation8"}}, drop=["company_id"]
    )
    return reduced.select("id", "nation", "agent_id")


# ---- splits and samples ---------------------------------------------------------------------

@register
def stratified_split(spark, sf):
    return split.mark_stratified(staged(spark, sf, "id", "y"), "id", "y").select("id", "is_valid")


@register
def stratified_split_classes(spark, sf):
    return split.mark_stratified(staged(spark, sf, "id", "nation"), "id", "nation", share=0.25).select("id", "is_valid")


@register
def chronological_split(spark, sf):
    return split.mark_chronological(staged(spark, sf, "id", "d"), "d", "id").select("id", "is_valid")


@register
def sample_n(spark, sf):
    return split.sample_n(table(spark, sf, "orders"), "o_orderkey", 1000).withColumn("o_orderdate", F.to_date("o_orderdate"))


# ---- preparation and encoding ---------------------------------------------------------------

def dirty_spec(df: DataFrame) -> TableSpec:
    return TableSpec.infer(df, id="id", target="y", date="date_raw", id_like=("agent_id", "company_id"))


DIRTY_RULES = prepare.PrepareRules(
    presence={"company_id": "has_company_id"},
    missing_flags=("agent_id", "cost", "priority_raw"),
    min_counts={"agent_id": 250, "nation": 480},
    aliases={"nation": {"nation7": "nation8"}},
    drop_reduced=("company_id", "agent_id_missing"),
    match=("received_requested", "priority_raw", "priority_got"),
    drop_features=("priority_got",),
    caps={"hours": (0, 8), "cost": (None, 500), "absent": (0, 1)},
)


@register
def prepare_full(spark, sf):
    rows = staged(spark, sf, balance=True).drop("d")
    train, _ = split.stratified_split(rows, "id", "y")
    return rounded(prepare.prepare_from(rows, train, dirty_spec(rows), DIRTY_RULES))


@register
def prepare_calendar(spark, sf):
    rows = dirty(spark, sf).drop("date_raw")
    return prepare.prepare_calendar(rows, "d", ["agent_id", "cost", "priority_raw"], {"company_id": "has_company_id"})


@register
def fitted_medians(spark, sf):
    rows = staged(spark, sf, balance=True).drop("d")
    train, _ = split.stratified_split(rows, "id", "y")
    fitted = prepare.fit_prepare(train, dirty_spec(rows), DIRTY_RULES)
    return rounded(tables.one_pass(train, [
        {"column": F.lit(c), "median": F.lit(m), "rows_below": F.count_if(F.col(c) < m)}
        for c, m in fitted.medians.items()
    ]))


@register
def impute_plain(spark, sf):
    rows = dirty(spark, sf).select("id", "y", "d", *DIRTY_NUMS, *DIRTY_CATS)
    halves = (half.drop("d") for half in (early(rows), late(rows)))
    both = benchmark.impute_plain(*halves, id="id", target="y")
    return rounded(both[0].unionByName(both[1], allowMissingColumns=True))


@register
def scale_standard(spark, sf):
    rows = dirty(spark, sf).select("id", "d", *DIRTY_NUMS)
    return rounded(encode.scale_standard(rows, DIRTY_NUMS, reference=early(rows)).drop("d"))


@register
def onehot_long(spark, sf):
    rows = dirty(spark, sf)
    return encode.onehot_long(rows, "id", ["segment_raw", "priority_raw", "agent_id"], reference=early(rows))


@register
def csv_round_trip(spark, sf):
    rows = dirty(spark, sf).select("id", "segment_raw", "agent_id", "cost", "date_raw", "nation")
    as_text = rows.withColumn("nation", F.when(F.col("nation") == "nation7", F.lit("n/a")).otherwise(F.col("nation")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-round-trip-{spark.range(1).select(F.uuid()).first()[0]}"
    write_csv(as_text, path)
    return read_csv(spark, path)


@register
def checked_write(spark, sf):
    """Shape, present values and contradictions of a table, observed while it is written."""
    rules = {"hours out of range": (F.col("hours") < 0) | (F.col("hours") > 24), "cost above price": F.col("cost") > F.col("price")}
    rows = dirty(spark, sf).select("id", "price", "cost", "hours", "segment_raw", "agent_id")
    return write_checked(rows, f"{checkpoint_dir(spark).rstrip('/')}/checked-{uuid.uuid4().hex}", rules)


# ---- stored profiles ------------------------------------------------------------------------

@register
def profile_from_states(spark, sf):
    """Two recordings, of which the second scans the last day only; quartiles are made exact."""
    rows = events(spark, sf).withColumn("day", F.to_date("ts"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/event-states-{uuid.uuid4().hex}"
    last = rows.agg(F.max("day")).first()[0]
    for part in (rows.where(F.col("day") < F.lit(last)), rows.where(F.col("day") == F.lit(last))):
        states.record_states(part, ["value", "user_id", "event_type"], "day", path)
    merged = states.merge_states(states.read_states(spark, path))
    report = states.describe_states(merged, {}).withColumn("distinct", F.when(F.col("distinct") < 100, F.col("distinct")))
    quarts = states.exact_quantiles(rows, merged, (0.25, 0.5, 0.75))
    exact = small_table(spark, [(c, *q) for c, q in quarts.items()], "column string, q25 double, q50 double, q75 double")
    return rounded(report.join(exact, "column", "left"), 4)


@register
def overlap_from_states(spark, sf):
    rows = dirty(spark, sf)
    columns = ["segment_raw", "nation", "agent_id", "hours"]
    found = states.value_overlap(*[states.merge_states(states.column_states(side, columns)) for side in (early(rows), late(rows))])
    return rounded(found)


# ---- drift ----------------------------------------------------------------------------------

def tagged_halves(spark, sf) -> DataFrame:
    rows = dirty(spark, sf)
    return drift.tag_sources(early(rows), late(rows).drop("y"))


@register
def date_audit(spark, sf):
    rows = base(spark, sf)
    report = drift.date_audit(rows.where("y = 1"), rows.where("y = 0"), "d")
    return rounded(report).withColumns({c: F.to_date(c) for c in ("min_date", "max_date")})


@register
def source_share(spark, sf):
    return drift.source_share(tagged_halves(spark, sf))


@register
def numeric_shift(spark, sf):
    return rounded(drift.numeric_shift(tagged_halves(spark, sf), DIRTY_NUMS))


@register
def categorical_shift(spark, sf):
    return rounded(drift.categorical_shift(tagged_halves(spark, sf), "segment_raw"))


@register
def prepare_sources(spark, sf):
    return rounded(adversarial.prepare_sources(tagged_halves(spark, sf), "id", leaks=["y", "d", "date_raw"]))


@register
def importance_by_column(spark, sf):
    part = table(spark, sf, "part")
    weights = part.select(
        F.col("p_type").alias("model"),
        F.when(F.col("p_partkey") % 10 == 0, F.col("p_brand"))
        .otherwise(F.concat(F.lit("ohe__"), F.col("p_brand"), F.lit("__"), F.col("p_name")))
        .alias("feature"),
        F.col("p_retailprice").alias("importance"),
    )
    return rounded(drift.importance_by_column(weights, top_n=5))


@register
def top_features(spark, sf):
    part = table(spark, sf, "part")
    by_column = part.groupBy(F.col("p_type").alias("model"), F.col("p_brand").alias("feature")).agg(
        F.sum("p_retailprice").alias("importance")
    )
    return rounded(drift.top_features(by_column))


@register
def compare_scores(spark, sf):
    rows = base(spark, sf)
    score = lambda half: half.groupBy("nation").agg(F.avg("y").alias("auc"))
    return rounded(tables.compare_scores(score(early(rows)), score(late(rows)), "nation", "auc", "with", "no"))


# ---- models ---------------------------------------------------------------------------------

@register
def auc_rank(spark, sf):
    return rounded(metrics.auc(base(spark, sf), "price", "y"), 9)


@register
def auc_ties(spark, sf):
    return rounded(metrics.auc(lineitem(spark, sf), "l_quantity", "y"), 9)


# Fewer trees and rounds than the library's defaults (300 trees of depth 12, 300 rounds of depth 5), so that a run over all
# queries stays short. The logistic regression has its default settings.
SMALL = {"forest": {"trees": 10, "depth": 5}, "boosted": {"rounds": 5, "depth": 3}}


@register
def model_benchmark(spark, sf):
    rows = staged(spark, sf, balance=True).drop("d")
    return benchmark.run_benchmark(rows, dirty_spec(rows), DIRTY_RULES, models=default_models(**SMALL))


@register
def model_split_compare(spark, sf):
    rows = staged(spark, sf, balance=True).drop("date_raw")
    spec = dirty_spec(rows).with_roles(date="d")
    models = default_models(**SMALL)
    return tables.stack_tables(
        benchmark.run_benchmark(rows, spec, DIRTY_RULES, kind=k, models=models) for k in ("random", "chronological")
    )


@register
def model_ablation(spark, sf):
    rows = staged(spark, sf, balance=True).drop("d", "date_raw")
    train, valid = split.stratified_split(rows, "id", "y")
    fitted = prepare.fit_prepare(train, dirty_spec(rows), DIRTY_RULES)
    return benchmark.ablation(
        prepare.prepare(train, fitted), prepare.prepare(valid, fitted), "id", "y", "priority_raw", default_models(**SMALL)
    )


@register
def model_importance(spark, sf):
    rows = staged(spark, sf, balance=True).drop("d")
    fitted = prepare.fit_prepare(rows, dirty_spec(rows), DIRTY_RULES)
    return benchmark.feature_importance(prepare.prepare(rows, fitted), "id", "y", default_models(**SMALL)[FOREST])


@register
def model_raw_vs_clean(spark, sf):
    rows = staged(spark, sf, balance=True).drop("date_raw")
    clean = prepare.prepare_calendar(rows, "d", ["agent_id", "cost"], {"company_id": "has_company_id"})
    versions = {"raw": rows.drop("d"), "clean": clean}
    halves = {name: split.stratified_split(df, "id", "y") for name, df in versions.items()}
    return benchmark.raw_vs_clean(halves, "id", "y", default_models(**SMALL)[LOGISTIC])


@register
def predict_best(spark, sf):
    rows = staged(spark, sf, balance=True).drop("date_raw")
    spec = dirty_spec(rows).with_roles(date="d")
    best = scoring.predict_best(early(rows), late(rows), spec, DIRTY_RULES, default_models(**SMALL))
    return scoring.prediction_table(best.predictions, "id", "client_id", "drop_probability")


def _sources(spark, sf):
    rows = staged(spark, sf, balance=True)
    tagged = drift.tag_sources(early(rows), late(rows))
    prepared = adversarial.prepare_sources(tagged, "id", leaks=["y", "d", "date_raw"])
    return tagged, adversarial.fit_source_models(
        prepared, "id", models=source_models(forest={"trees": 10, "depth": 5}, boosted={"rounds": 5, "depth": 3})
    )


@register
def adversarial_scores(spark, sf):
    return _sources(spark, sf)[1].scores


@register
def adversarial_drift(spark, sf):
    tagged, fitted = _sources(spark, sf)
    return adversarial.drift_report(tagged, fitted)


@register
def strict_calendar(spark, sf):
    """The earlier preparation over dates held as text, each of which must be one."""
    rows = base(spark, sf).withColumn("day", F.date_format("d", "yyyy-MM-dd")).drop("d")
    return rounded(prepare.prepare_calendar(rows, "day", ["bal"], {}, strict=True))


@register
def features_and_target(spark, sf):
    """The two sides of a model's table, put together again by the id."""
    features, target = tables.features_and_target(base(spark, sf).select("id", "y", "price", "segment"), "y", "id")
    return rounded(features.join(target, "id"))


@register
def drift_of_given_features(spark, sf):
    """The drift report of features that are given, not found by models."""
    rows = staged(spark, sf)
    return rounded(drift.feature_shifts(drift.tag_sources(early(rows), late(rows)), [*DIRTY_NUMS, "segment_raw", "priority_raw"]))


def _first_tree(rows: DataFrame, depth: int):
    encoder = encode.fit_encoder(rows, ["segment", "priority", "nation"], ["price", "bal"])
    coded = encoder.transform(rows.withColumn("label", F.col("y").cast("double")), keep=["id", "label"], parts=True)
    return encoder, SecondOrderBoosting(rounds=1, depth=depth, share=1.0, columns=1.0, bins=16, exact=True).grow(coded).trees[0]


@register
def boosting_first_tree(spark, sf):
    """All nodes of the first second-order tree: rows, sums of gradients and hessians, split, gain and Newton step."""
    encoder, root = _first_tree(stage(base(spark, sf), "labelled-rows"), 3)
    found, waiting = [], [(0, 0, root)]
    while waiting:
        depth, at, node = waiting.pop()
        slot, least = divmod(node.code, BINS) if node.code is not None else (None, None)
        found.append((depth, at, node.rows, node.gradient, node.hessian, slot, least, node.gain if node.children else None, node.value(1.0)))
        waiting += [(depth + 1, 2 * at + i, c) for i, c in enumerate(node.children)]
    nodes = small_table(spark, found, "depth int, place int, rows long, gradient double, hessian double, slot long, least_bin int, gain double, step double")
    return rounded(nodes.join(encoder.feature_names(spark), "slot", "left").drop("slot"))


# What is exact about the models: rows, classes, encoded features, ids, class weights, and conditions that must hold.

def _split_and_fit(rows: DataFrame, kind: str, names=None):
    """Prepared halves, AUC of each model, encoder and fitted models of one split."""
    spec = dirty_spec(rows).with_roles(date="d")
    train, valid = split.make_split(rows, kind, "id", "y", "d")
    fitted = prepare.fit_prepare(train, spec, DIRTY_RULES)
    train, valid = prepare.prepare(train, fitted), prepare.prepare(valid, fitted)
    models = {k: m for k, m in default_models(**SMALL).items() if names is None or k in names}
    return train, valid, *benchmark.fit_models(train, valid, "id", "y", models)


def _close(a: float | None, b: float, by: float = 1e-6) -> bool:
    return a is not None and abs(a - b) <= by


@register
def checked_scores(spark, sf):
    """Each model on both splits: rows, whether scores are probabilities, and whether the AUC is that of MLlib's evaluator."""
    rows, found = staged(spark, sf, balance=True).drop("date_raw"), []
    for kind in ("random", "chronological"):
        train, valid, scores, (encoder, models) = _split_and_fit(rows, kind)
        n = train.count()
        with benchmark.cached(encoder.transform(valid).withColumn("label", F.col("y").cast("double")), scaler=encoder.scaler) as (coded,):
            for name, model in models.items():
                scored = benchmark.positive_probability(model.transform(coded), "id", "label")
                seen = scored.agg(F.count("*"), F.count_if(F.col("label") == 1), F.count_if(F.col("probability").between(0, 1))).first()
                judge = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0)
                found.append((kind, name, n, seen[0], seen[1], seen[2] == seen[0], _close(scores[name], judge.evaluate(scored))))
    return small_table(spark, found, "split string, model string, rows long, held_out long, positives long, are_probabilities boolean, auc_agrees boolean")


@register
def checked_encoding(spark, sf):
    """The encoded features that the tree models were fitted on, with conditions on their importances."""
    rows = staged(spark, sf, balance=True).drop("date_raw")
    *_, (encoder, models) = _split_and_fit(rows, "random", (FOREST, BOOSTED))
    found = []
    for name, model in models.items():
        weights = benchmark.importance_table(spark, model, encoder)
        whole = F.lit(_close(float(model.featureImportances.toArray().sum()), 1.0))
        found.append(weights.select("feature", F.lit(name).alias("model"), F.col("importance").between(0, 1).alias("in_range"), whole.alias("sums_to_one")))
    return tables.stack_tables(found)


@register
def checked_logistic(spark, sf):
    """The gradient of the penalised mean loss is zero at the fitted coefficients."""
    rows = staged(spark, sf, balance=True).drop("date_raw")
    train, _, _, (encoder, models) = _split_and_fit(rows, "random", (LOGISTIC,))
    model = models[LOGISTIC]
    scored = model.transform(encoder.transform(train)).select(
        (vector_to_array("probability")[1] - F.col("y")).alias("off"), vector_to_array("scaled_features").alias("x"), "y"
    )
    sums = scored.select("off", F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.avg(F.col("off") * F.col("x")).alias("slope"))
    slopes = {r["i"]: r["slope"] for r in sums.collect()}
    total = scored.agg(F.count("*").alias("rows"), F.sum("y").alias("positives"), F.avg("off").alias("slope")).first()
    penalty, weights = model.getRegParam(), model.coefficients.toArray()
    steep = max(abs(total["slope"]), *(abs(slopes[i] + penalty * w) for i, w in enumerate(weights)))
    return small_table(
        spark, [(encoder.width, total["rows"], total["positives"], bool(steep < 1e-3))],
        "features long, rows long, positives long, is_optimum boolean",
    )


@register
def checked_ablation(spark, sf):
    """Each model with and without a column: both scores are shares, and their difference is that of the two."""
    rows = model_ablation(spark, sf)
    share = lambda c: F.coalesce(F.col(c).between(0, 1), F.lit(False))
    agrees = F.abs(F.col("diff") - (F.col("auc_with") - F.col("auc_without"))) < 1e-12
    return rows.select("model", share("auc_with").alias("with_in_range"), share("auc_without").alias("without_in_range"), agrees.alias("diff_agrees"))


@register
def checked_raw_vs_clean(spark, sf):
    """Both versions of the table have a score, best first."""
    return model_raw_vs_clean(spark, sf).select("data", F.coalesce(F.col("auc").between(0, 1), F.lit(False)).alias("auc_in_range"))


@register
def older_pipeline(spark, sf):
    """The earlier pipeline on a split: rows, encoded width, iterations of the solver, trees, and whether each AUC is that of MLlib's evaluator."""
    rows = staged(spark, sf, balance=True).drop("d", "date_raw")
    train, valid = split.stratified_split(rows, "id", "y", 0.25)
    scores, (encoder, models) = benchmark.older_benchmark(train, valid, "id", "y", older_models(forest={"trees": 20}))
    found = []
    a, b = benchmark.impute_plain(train, valid, id="id", target="y")
    with benchmark.cached(encoder.transform(b.withColumn("label", F.col("y").cast("double"))), scaler=encoder.scaler) as (coded,):
        for name, model in models.items():
            scored = benchmark.positive_probability(model.transform(coded), "id", "label")
            judge = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0)
            size = model.getNumTrees if name == FOREST else model.getMaxIter()
            found.append((name, encoder.rows, scored.count(), encoder.width, size, _close(scores[name], judge.evaluate(scored))))
    return small_table(spark, found, "model string, rows long, held_out long, features int, size int, auc_agrees boolean")


@register
def checked_predictions(spark, sf):
    """One probability for each row to be scored."""
    scored = predict_best(spark, sf)
    return scored.select("client_id", F.coalesce(F.col("drop_probability").between(0, 1), F.lit(False)).alias("is_probability"))


@register
def reloaded_pipeline(spark, sf):
    """Raw rows scored by a pipeline of preparation, encoding and model, before it is saved and after it is loaded again."""
    rows = staged(spark, sf, balance=True).drop("date_raw")
    spec, found = dirty_spec(rows).with_roles(date="d"), None
    for name in (LOGISTIC, BOOSTED):
        fitted = pipeline.fit_pipeline(early(rows), spec, DIRTY_RULES, default_models(**SMALL)[name])
        path = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
        fitted.write().save(path)
        before, after = (pipeline.score(m, late(rows).drop("y"), "id") for m in (fitted, PipelineModel.load(path)))
        both = before.join(after.withColumnRenamed("probability", "again"), "id", "full")
        both = both.select(F.lit(name).alias("model"), "id", F.coalesce(F.col("probability") == F.col("again"), F.lit(False)).alias("is_same"))
        found = both if found is None else found.unionByName(both)
    return found


@register
def checked_sources(spark, sf):
    """Rows, class weights and conditions of the models that tell two tables apart."""
    fitted = _sources(spark, sf)[1]
    sums = {r["model"]: r["total"] for r in fitted.importance.groupBy("model").agg(F.sum("importance").alias("total")).collect()}
    rows = [
        (r["model"], fitted.rows, fitted.held_out, fitted.weights[0.0], fitted.weights[1.0], bool(r["source_auc"] is not None and 0 <= r["source_auc"] <= 1), _close(sums[r["model"]], 1.0))
        for r in fitted.scores.collect()
    ]
    return rounded(small_table(
        spark, rows, "model string, rows long, held_out long, train_weight double, test_weight double, auc_in_range boolean, sums_to_one boolean"
    ))
