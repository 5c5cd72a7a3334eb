"""Raw tables by logical name, and the readers that turn them into clean streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import clean
from tideline.functions.dates import shift
from tideline.operators.keep import latest, top_k
from tideline.session import materialise
from tideline.sources.versions import Folder, current

_S, _D, _L, _B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
_N = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# Declared tables, column by column
WEIGHTS = _schema(("model_version", _S), ("feature", _S), ("feature_level", _S), ("coef", _D), ("loaded_at", _N))
LEDGER = _schema(
    ("phone_number", _S), ("phone9", _S), ("audience", _S), ("arm", _S), ("was_sent", _B),
    ("selected_date", T.DateType()), ("rank_on_day", _L), ("model_version", _S), ("p_click", _D),
    ("prior_discount_percentage", _D), ("psm_rmd", _D), ("offered_discount_percentage", _L),
    ("premium_without_any_discounts", _D), ("last_quoted_premium", _D), ("new_premium_offered", _D),
    ("logged_at", _N),
)
REGISTRY = _schema(
    ("model_version", _S), ("status", _S), ("created_at", _N), ("promoted_at", _N), ("trained_through", T.DateType()),
    ("train_rows", _L), ("train_clicks", _L), ("test_batch", _S), ("test_rows", _L), ("test_clicks", _L),
    ("test_auc", _D), ("test_top10_capture", _D), ("champion_version", _S), ("champion_test_auc", _D), ("notes", _S),
)
TEMPLATES = _schema(("template_id", _S), ("description", _S), ("added_at", _N))
DECLARED = {"model_weights": WEIGHTS, "ledger": LEDGER, "model_registry": REGISTRY, "discount_templates": TEMPLATES}


# Odd column names of the raw tables and our plain ones
RENAMES = {
    "event_log": {"key_entity_details/user_id": "user_id"},
    "opt_outs": {"client_numebr": "client_number"},
}


class Sources(Protocol):
    """Anything that returns a DataFrame for a logical table name."""

    def table(self, name: str) -> DataFrame: ...


class FolderSources:
    """One folder of parquet (or one CSV/catalog table) per logical name.

    ``locations`` overrides single names: a path, or ``table:db.name`` for a catalog table.
    ``renames`` maps odd source column names to ours, per table. A declared table that does not
    exist yet reads as empty.
    """

    def __init__(
        self, spark: SparkSession, root: str, locations: Mapping[str, str] | None = None,
        renames: Mapping[str, Mapping[str, str]] | None = None,
    ) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.locations = dict(locations or {})
        self.renames = {**RENAMES, **(renames or {})}

    def path(self, name: str) -> str:
        return self.locations.get(name, f"{self.root}/{name}")

    def table(self, name: str) -> DataFrame:
        where = self.path(name)
        if where.startswith("table:"):
            df = self.spark.table(where.removeprefix("table:"))
        elif name in DECLARED:
            df = self._declared(name, where)
        else:
            df = self.spark.read.parquet(current(self.spark, where))
        return rename(df, self.renames.get(name, {}))

    def _declared(self, name: str, where: str) -> DataFrame:
        if not Folder(self.spark, where).exists():
            return self.spark.createDataFrame([], DECLARED[name])
        return self.spark.read.schema(DECLARED[name]).parquet(current(self.spark, where))


class FrameSources:
    """Logical names to DataFrames (or to functions that build them on first use)."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> None:
        self.frames = dict(frames)

    def table(self, name: str) -> DataFrame:
        got = self.frames[name]
        if not isinstance(got, DataFrame):
            got = self.frames[name] = got()
        return rename(got, RENAMES.get(name, {}))

    def with_tables(self, **frames: DataFrame) -> FrameSources:
        return FrameSources({**self.frames, **frames})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Case-sensitive or odd source names (``a/b``, ``from``) to plain ones."""
    return df.withColumnsRenamed(dict(names)) if names else df


def rows(spark: SparkSession, data: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Small literal relation."""
    return spark.createDataFrame(list(data), schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Exported frame or weights with a header; the schema is given, never inferred."""
    return spark.read.csv(path, header=True, schema=schema)


RAW_LINE = "_raw_line"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(typed rows, broken lines) of an export with a header.

    A line that does not fit the schema is kept as it is, with its file, and never reaches the typed rows. The scan is
    written once, so both parts come from the same read.
    """
    full = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType())])
    read = spark.read.csv(path, header=True, schema=full, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW_LINE)
    kept = materialise(read.withColumn("_file", F.input_file_name()))
    typed = kept.where(F.col(RAW_LINE).isNull()).select(*schema.fieldNames())
    return typed, kept.where(F.col(RAW_LINE).isNotNull()).select(F.col(RAW_LINE).alias("line"), F.col("_file").alias("file"))


# ---- clean streams -------------------------------------------------------------------


def quotes(src: Sources) -> DataFrame:
    """Every quote journey: user_id, phone9, discount_activity_id, quote_no, quote_ts, sold_at."""
    q = src.table("quotes")
    return q.select(
        "user_id", "discount_activity_id", F.col("quote_no").cast("string").alias("quote_no"),
        F.coalesce("quoted_at", "quote_journey_start_at", F.col("quote_date").cast("timestamp_ntz")).alias("quote_ts"),
        "sold_at", "quoted_at", "formatted_phone",
        clean.phone9(F.coalesce("formatted_phone", F.lit(""))).alias("phone9"),
    )


def leads(src: Sources, all_src: str | None = None) -> DataFrame:
    """Leads with a readable time and at least nine digits; ``all_src`` names one source, whose rows alone are parsed."""
    raw = src.table("leads")
    if all_src is not None:
        raw = raw.filter(clean.cat("all_sources") == all_src)
    number = F.coalesce("contact_number", F.lit(""))
    return raw.select(
        clean.phone9(number).alias("phone9"),
        clean.ts("usercreatedat").alias("lead_ts"),
        "user_id", "first_name", "last_name",
        clean.cat("final_attributed_source_fixed").alias("attr_source"),
        clean.cat("all_sources").alias("all_src"),
        clean.channel_key("final_attributed_source_fixed", "sub_sources", "all_sources").alias("channel_key"),
        F.coalesce("lead_source_reference_ucid", F.lit("")).alias("ucid"),
        clean.has_phone(number).alias("_ok"),
    ).filter(F.col("_ok") & F.col("lead_ts").isNotNull()).drop("_ok")


def outcome_calls(src: Sources) -> DataFrame:
    """Outbound calls that have an outcome: phone9, start_time, name."""
    calls = src.table("call_interactions").filter(F.col("direction") == "outbound")
    number = F.coalesce("subject", F.lit(""))
    return (
        calls.filter(clean.has_phone(number))
        .select(clean.phone9(number).alias("phone9"), "start_time", "outcome_id")
        .join(src.table("call_outcomes").select(F.col("id").alias("outcome_id"), "name"), "outcome_id")
        .select("phone9", "start_time", "name")
    )


def sales_calls(src: Sources, campaign_ids: Sequence[str], local_hours: int) -> DataFrame:
    """Outbound calls of the sales campaigns, local time moved to UTC: phone9, call_ts, outcome."""
    calls = src.table("call_interactions").filter(
        (F.col("direction") == "outbound") & F.col("start_time").isNotNull() & F.col("campaign_id").isin(*campaign_ids))
    names = src.table("call_outcomes").select(F.col("id").alias("outcome_id"), "name")
    return calls.join(names, "outcome_id", "left").select(
        clean.phone9(F.coalesce("subject", F.lit(""))).alias("phone9"),
        shift(F.col("start_time"), timedelta(hours=-local_hours)).alias("call_ts"),
        F.coalesce("name", F.lit("")).alias("outcome"),
    )


# Request types that create a policy, and the answer code that says it worked
POLICY_TYPES = ("createPolicy", "additionalVehiclePolicy")
POLICY_OK = 200


def policy_sales(src: Sources) -> DataFrame:
    """Successful policy requests: phone9, sale_ts, number text."""
    p = src.table("policy_requests")
    return p.filter(F.col("type").isin(*POLICY_TYPES) & (clean.try_int("response_status") == POLICY_OK)).select(
        clean.phone9_from_numeric_text("vehicle_ownerperson_cellphonenumber").alias("phone9"),
        clean.ts_or_nanos("createdat").alias("sale_ts"),
        F.split_part(F.col("vehicle_ownerperson_cellphonenumber").cast("string"), F.lit("."), F.lit(1)).alias("number"),
    )


def sent_messages(src: Sources) -> DataFrame:
    """Template messages: phone9, sid, template_id, audience_id, message_body."""
    return src.table("wa_templates_sent").select(
        clean.phone9_from_numeric_text("number").alias("phone9"), F.col("message_sid").alias("sid"),
        "template_id", "audience_id", "message_body")


def status_events(src: Sources) -> DataFrame:
    """Status events: sid, status, date_sent, from_phone9, error_code."""
    return src.table("wa_status").select(
        "sid", "status", "date_sent", clean.phone9(F.coalesce("from", F.lit(""))).alias("from_phone9"), "error_code")


def only(df: DataFrame, wanted: DataFrame | None, key: str, wanted_key: str) -> DataFrame:
    """Raw rows of the wanted keys, cut before anything is parsed or ordered; all rows when none are named."""
    if wanted is None:
        return df
    keys = wanted.select(F.col(wanted_key).cast(df.schema[key].dataType).alias(key)).where(F.col(key).isNotNull()).distinct()
    return marked(df, keys, key).join(keys, key, "left_semi")


# Wanted keys are marked in so many bits (8 MB, whatever their number), 4,096 to a row.
MARK_BITS, ROW_BITS, WORD_BITS = 1 << 26, 1 << 12, 1 << 6


def marked(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key may be among ``keys``: none of theirs is lost, most others go before they are shuffled."""
    place = F.pmod(F.xxhash64(key), F.lit(MARK_BITS))
    words = keys.select(place.alias("_at")).groupBy(F.floor(F.col("_at") / ROW_BITS).alias("_row"), F.expr(f"int(_at % {ROW_BITS} div {WORD_BITS})").alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, int(_at % {WORD_BITS}))")).alias("_bits"))
    rows = words.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_words")).select(
        "_row", F.transform(F.sequence(F.lit(0), F.lit(ROW_BITS // WORD_BITS - 1)), lambda i: F.coalesce(F.try_element_at("_words", i), F.lit(0).cast("long"))).alias("_words"))
    word = F.element_at("_words", (F.floor((place % ROW_BITS) / WORD_BITS) + 1).cast("int"))
    hit = (F.floor(place / ROW_BITS) == F.col("_row")) & (F.getbit(word, place % WORD_BITS) == 1)
    return df.join(F.broadcast(rows), hit, "left_semi")


def premiums(src: Sources, wanted: DataFrame | None = None) -> DataFrame:
    """Newest row per discount activity (of the wanted ones) with both premiums and the discount amount."""
    a = only(src.table("discount_activity"), wanted, "id", "discount_activity_id").select(
        F.col("id").alias("discount_activity_id"),
        clean.money("premium_comprehensive", "premium_car_hire", "premium_credit_shortfall").alias("last_prem"),
        clean.money("discount_zar").alias("discount_zar"),
        clean.alnum_key("vehicle_registration").alias("reg_norm"),
        clean.try_number(F.col("policy_line_no").cast("string")).cast("bigint").alias("line_no"),
        clean.ts("updatedat").alias("updated_ts"), clean.ts("createdat").alias("created_ts"),
    )
    newest = latest(a, ["discount_activity_id"], "updated_ts", "created_ts")
    return newest.select(
        "discount_activity_id", (F.col("last_prem") + F.col("discount_zar")).alias("pre_prem"),
        "last_prem", "discount_zar", "reg_norm", "line_no")


def vehicles_by_line(src: Sources, wanted: DataFrame | None = None) -> DataFrame:
    """Newest make and model per policy line (of the wanted ones)."""
    o = only(src.table("policy_objects"), wanted, "agr_line_no", "line_no").filter(
        F.col("agr_line_no").isNotNull() & F.col("make").isNotNull() & (F.trim("make") != ""))
    order = [F.col("seq_no").desc_nulls_first(), F.col("make").asc_nulls_last(), F.col("model").asc_nulls_last()]
    return top_k(o, ["agr_line_no"], order).select(
        F.col("agr_line_no").alias("line_no"), F.col("make").alias("line_make"), F.col("model").alias("line_model"))


def vehicles_by_registration(src: Sources) -> DataFrame:
    v = src.table("vehicle_lookup").select("reg_norm", F.col("make").alias("reg_make"), F.col("model").alias("reg_model"))
    return v.filter(F.col("reg_norm").isNotNull())


def price_sensitivity(src: Sources, wanted: DataFrame | None = None) -> DataFrame:
    """Newest recommendation per quote number (of the wanted ones): psm_rmd, alpha_active, alpha_locked."""
    p = only(src.table("price_sensitivity").filter(F.col("motor_quote_no").isNotNull()), wanted, "motor_quote_no", "quote_no").select(
        F.col("motor_quote_no").cast("string").alias("quote_no"),
        clean.try_double("recommended_discount_percentage").alias("psm_rmd"),
        F.coalesce(clean.try_bool("alpha_group_is_active"), F.lit(False)).alias("alpha_active"),
        clean.try_double("alpha_group_locked_dut").alias("alpha_locked"),
        clean.ts("updatedat").alias("updated_ts"),
    )
    return latest(p, ["quote_no"], "updated_ts").drop("updated_ts")


def discount_templates(src: Sources) -> DataFrame:
    return src.table("discount_templates").select("template_id").distinct()


def campaign_phone(df: DataFrame) -> DataFrame:
    return df.withColumn("phone9", clean.phone9(F.col("phone_number").cast("string")))


def messaged(df: DataFrame) -> DataFrame:
    """Phones of a campaign table that really got the message."""
    return campaign_phone(df.filter(F.col("has_been_messaged"))).select("phone9")
