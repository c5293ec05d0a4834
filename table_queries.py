"""Every operator and model run over the benchmark tables."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from table_feeds import feed_bytes, spark_feed
from vigil.functions import keys, measures, numeric as num, rules, temporal as tm, text as tx
from vigil.operators import calendar as cal, conform, dedup, lookup, rollup
from vigil.plans import dimensions as dim, facts, gold, silver
from vigil.plans.pipeline import MODELS, Settings, Warehouse
from vigil.session import METHOD_LIMIT, STORED, configure, freed_shuffles, shared_dir, size_shuffles, small_methods, stored_bytes
from vigil.sources.files import exists, list_files
from vigil.sources.flatten import exact_json, flatten, leaf_rows, leaf_types, record_hash
from vigil.sources.landing import LandingTable
from vigil.sources.preview import preview_schema
from vigil.sources.specs import source_for
from vigil.streaming.ingest import ingest


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as doubles, so that two engines print alike."""
    casts = {}
    for f in df.schema:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            casts[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
    return df.withColumns(casts) if casts else df


# --- models ---------------------------------------------------------------------------


def settings(spark: SparkSession, sf: str) -> Settings:
    """Calendar bounds from the tables, as part of the plan; the last order day stands for today."""
    (today,) = read(spark, sf, "orders").agg(F.to_date(F.max("o_orderdate"))).first()
    return Settings(as_of=today, spine_bounds=spine_bounds(spark, sf))


def spine_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """first_day and last_day: from the first order to the last event."""
    none = F.lit(None).cast("date")
    first = read(spark, sf, "orders").select(F.to_date("o_orderdate").alias("first_day"), none.alias("last_day"))
    later = read(spark, sf, "events").select(none, F.to_date("ts"))
    return first.union(later).agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


SPLIT_BYTES = 4 << 20  # Spark cuts files no smaller

_warehouses: dict[tuple[str, str], Warehouse] = {}


def _landing(spark: SparkSession, sf: str, root: str, name: str) -> DataFrame:
    """A landing table, rendered from the benchmark tables and stored on first use."""
    path = f"{root}/{name}"
    if not exists(spark, f"{path}/_SUCCESS"):
        feed = spark_feed(spark, sf, name)
        # Files of fewer splits than tasks are one task each; stored landing tables have many.
        # Asking the rows for their partitions would run every shuffle below them twice.
        tasks, size = spark.sparkContext.defaultParallelism, feed_bytes(spark, sf, name)
        size_shuffles(spark, size)
        narrow = size < tasks * SPLIT_BYTES
        with small_methods(spark), freed_shuffles(spark):
            (feed.repartition(tasks) if narrow else feed).write.options(**STORED).mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    size_shuffles(spark, stored_bytes(stored))
    return stored


def warehouse(spark: SparkSession, sf: str) -> Warehouse:
    """One store per application and table folder, shared by the model queries."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _warehouses:
        root = f"{shared_dir(spark)}/vigil-{uuid.uuid4().hex}"
        _warehouses[key] = Warehouse(
            spark, root, partial(_landing, spark, sf, f"{root}/landing"), settings(spark, sf)
        )
    return _warehouses[key]


def model(name: str, layer: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = warehouse(spark, sf).prepared(name)
        if layer == "silver":
            # Runs when the caller reads it; the next query sets its own.
            spark.conf.set(METHOD_LIMIT, "8000")
        return df

    return run


def confirmed_by_week_and_county(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain in one plan: landing rows to confirmed cases per week and county."""
    s = settings(spark, sf)
    dates = dim.dim_date(spark, bounds=s.spine_bounds)
    cases = silver.cases(spark_feed(spark, sf, "adam_cases_raw"))
    report = gold.case_investigation(
        facts.case_investigations(cases, dates), dates, dim.dim_epiweek(dates, s.as_of)
    )
    return rollup.totals(
        report.filter(F.col("reporting_case_classification") == "CONFIRMED"),
        ["reporting_epi_week_label", "reporting_county"],
        {"confirmed_cases": "total_investigation_count"},
    )


# --- landing --------------------------------------------------------------------------


def nested_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as nested JSON records whose shape differs from row to row."""
    e = read(spark, sf, "events")
    kind = F.col("event_type")
    body = F.struct(
        F.col("event_id").alias("eventId"),
        F.struct(
            F.col("user_id").alias("id"),
            F.struct(kind.alias("Type"), F.round(F.col("value") * 100).cast("bigint").alias("cents")).alias("act"),
        ).alias("user"),
        F.when(kind != "signup", F.from_json("props", "k bigint")).alias("props"),
        F.when(kind == "click", F.col("value") > 50).alias("big"),
        F.slice(F.array(kind, F.lit("x"), F.lit("y")), F.lit(1), (F.col("event_id") % 4).cast("int")).alias("tags"),
    )
    return e.select("event_id", F.parse_json(F.to_json(body)).alias("record"))


def flatten_events(spark, sf):
    df = flatten(nested_events(spark, sf), "record", "event_id", ["event_id"])
    return df.drop("_rescued_data")


def flatten_paths(spark, sf):
    """Columns a landing table would get, with their types and first record."""
    found = leaf_types(nested_events(spark, sf), "record", "event_id")
    return found.select(
        F.translate("steps", "\u0001", "/").alias("steps"),
        F.when(F.col("is_boolean"), "boolean").otherwise("text").alias("type"),
        F.col("first_seen").alias("first_event"),
    )


def flatten_leaf_counts(spark, sf):
    rows = leaf_rows(nested_events(spark, sf), "record", "event_id")
    return rows.groupBy(F.translate("steps", "\u0001", "/").alias("steps")).agg(
        F.count("*").alias("n_leaves"), F.countDistinct("event_id").alias("n_records")
    )


def record_hash_dedup(spark, sf):
    """Each event twice with its keys in another order, and once with another spelling of its
    number, which makes it another record; against a half-loaded table."""
    e = read(spark, sf, "events")
    one = F.to_json(F.struct("event_id", "event_type", F.struct("user_id", "value").alias("x")))
    two = F.to_json(F.struct(F.struct("value", "user_id").alias("x"), "event_type", "event_id"))
    pointed = F.regexp_replace(one, r'^\{"event_id":([0-9]+)', r'{"event_id":$1.0')
    texts = F.array(one, two, pointed)
    each = e.select("event_id", "event_type", F.posexplode(texts).alias("form", "text"))
    every = each.withColumn("id", F.col("event_id") + F.col("form") * F.lit(10**12))
    exact = F.try_parse_json(exact_json(F.col("text")))
    hashed = every.withColumn("_raw_hash", record_hash(F.parse_json("text"), exact))
    # Each record is parsed once, not once for every side of the comparison.
    path = f"{shared_dir(spark)}/vigil-{uuid.uuid4().hex}/hashed"
    hashed.select("event_id", "event_type", "id", "_raw_hash").write.parquet(path)
    hashed = spark.read.parquet(path)
    stored = hashed.filter(F.col("event_type") == "view")
    return dedup.unseen(hashed, "_raw_hash", "id", stored).select("event_id", "id")


def _landed_orders(spark, sf) -> tuple[str, str]:
    """Orders written as JSON files into a sending system's folder; returns its root."""
    root = f"{shared_dir(spark)}/vigil-{uuid.uuid4().hex}"
    o = read(spark, sf, "orders")
    body = o.select(
        F.col("o_orderkey").alias("order"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("rank")).alias("customer"),
        (F.col("o_orderstatus") == "F").alias("done"),
    )
    folder = f"{root}/raw/lims_raw/records"
    body.write.json(folder)
    # The same records again, packed: every one of them is a repeat.
    body.write.mode("append").option("compression", "gzip").json(folder)
    return root, folder


def stream_ingest(spark, sf):
    root, _ = _landed_orders(spark, sf)
    ingest(
        spark, source_for("lims_raw"), f"{root}/raw", f"{root}/landing", f"{root}/ckpt",
        archive=False,
    )
    table = LandingTable(spark, f"{root}/landing", "lims_raw").read()
    return table.select("order", "customer__id", "customer__rank", "done", "_source", "_processed")


def _place(spark, df: DataFrame, folder: str, name: str, packed: bool = False) -> None:
    """One JSON file of this name; packed ones do not say so in their name."""
    apart = f"{folder}-{uuid.uuid4().hex}"
    # Many tasks make the lines and one puts them into the file.
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.parquet(f"{apart}-lines")
    writer = spark.read.parquet(f"{apart}-lines").coalesce(1).write
    (writer.option("compression", "gzip") if packed else writer).text(apart)
    (file,) = [f for f in list_files(spark, apart) if f.length]
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path(folder))
    store.delete(path(f"{folder}/{name}"), False)
    assert store.rename(path(file.path), path(f"{folder}/{name}"))


def ingest_archived(spark, sf):
    """Two loads with archiving on: a plain file, a packed one that does not say so and one named
    `_late.json`; then other records under the first name, and a file that is older than all.
    Also how many files are left where they arrived, and how many are in the archive."""
    root = f"{shared_dir(spark)}/vigil-{uuid.uuid4().hex}"
    folder = f"{root}/raw/lims_raw/records"
    o = read(spark, sf, "orders")
    body = o.select(F.col("o_orderkey").alias("order"), F.struct(F.col("o_custkey").alias("id")).alias("customer"))
    part = [body.filter(F.col("order") % 5 == k) for k in range(5)]
    _place(spark, part[0], folder, "a.json")
    _place(spark, part[1], folder, "b.json", packed=True)
    _place(spark, part[2].union(part[0]), folder, "_late.json")
    for turn in range(2):
        if turn:
            _place(spark, part[3], folder, "a.json")
            _place(spark, part[4].union(part[1]), folder, "old.json")
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/old.json")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(path, 1_000_000_000_000, -1)
        ingest(spark, source_for("lims_raw"), f"{root}/raw", f"{root}/landing", f"{root}/ckpt")
    left, kept = (len([f for f in list_files(spark, x) if f.length]) for x in (folder, f"{root}/raw/_processed_lims_raw/records"))
    table = LandingTable(spark, f"{root}/landing", "lims_raw").read()
    return table.select("order", "customer__id", F.lit(left).alias("n_left"), F.lit(kept).alias("n_archived"))


def ingest_array_document(spark, sf):
    """Orders as one pretty-printed array, a document of the size of the table."""
    root = f"{shared_dir(spark)}/vigil-{uuid.uuid4().hex}"
    o = read(spark, sf, "orders")
    body = F.struct(
        F.col("o_orderkey").alias("order"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("rank")).alias("customer"),
        F.array(F.struct(F.concat(F.lit('],{"'), "o_orderstatus").alias("status"))).alias("marks"),
    )
    # Many tasks make the elements and one puts them into the document. Only there is it known
    # which comes first: the first partition of a table may hold no rows.
    o.select(F.to_json(body, {"pretty": "true"}).alias("value")).write.parquet(f"{root}/elements")
    first = F.monotonically_increasing_id() == 0
    elements = spark.read.parquet(f"{root}/elements").coalesce(1).select(F.concat(F.when(first, "").otherwise(","), "value").alias("value"))
    edge = [spark.range(1).select(F.lit(c).alias("value")) for c in "[]"]
    edge[0].union(elements).union(edge[1]).coalesce(1).write.text(f"{root}/raw/lims_raw/records")
    ingest(spark, source_for("lims_raw"), f"{root}/raw", f"{root}/landing", f"{root}/ckpt", archive=False)
    table = LandingTable(spark, f"{root}/landing", "lims_raw").read()
    return table.select("order", "customer__id", "customer__rank", "marks__0__status")


def stream_ingest_loads(spark, sf):
    """What the load reports: files, new rows, repeats, added columns."""
    root, _ = _landed_orders(spark, sf)
    ingest(
        spark, source_for("lims_raw"), f"{root}/raw", f"{root}/landing", f"{root}/ckpt",
        archive=False,
    )
    loads = spark.read.parquet(LandingTable(spark, f"{root}/landing", "lims_raw").loads)
    return loads.groupBy().agg(
        F.sum("rows_inserted").alias("rows_inserted"),
        F.sum("rows_deduped").alias("rows_deduped"),
        F.array_join(F.array_sort(F.flatten(F.collect_list("columns_added"))), ",").alias("columns_added"),
    )


def preview_columns(spark, sf):
    _, folder = _landed_orders(spark, sf)
    return preview_schema(spark, folder, sample=None).select("column", "type", "is_new")


# --- cleaning -------------------------------------------------------------------------


def blank_to_null(spark, sf):
    c = read(spark, sf, "conversations")
    padded = F.concat(F.lit("  "), F.when(F.col("turn") % 3 != 0, F.col("role")).otherwise(" "), F.lit(" "))
    raw = F.when(F.col("turn") % 5 != 4, padded)
    return c.select(
        "conv_id", "turn",
        tx.blank_to_null(raw).alias("cleaned"),
        tx.empty_to_null(F.trim(raw)).alias("emptied"),
        F.upper(tx.empty_to_null(F.trim(raw))).alias("code"),
        tx.folded(F.col("text")).alias("folded_text"),
        tx.blank_to_null(F.concat(F.lit(" "), "text", F.lit("  "))).alias("whole_text"),
    )


def yes_no_flag(spark, sf):
    e = read(spark, sf, "events")
    word = F.element_at(
        F.array(*map(F.lit, ["Yes", " y", "TRUE", "1", "no", "N ", "false", "0", "maybe", ""])),
        (F.col("event_id") % 10 + 1).cast("int"),
    )
    return e.select(
        "event_id", tx.yes_no(word).alias("flag"), tx.yes_flag(word).alias("yes_count"),
        F.coalesce(F.when(F.col("event_id") % 2 == 0, True), F.lit(False)).alias("defaulted"),
    )


def sex_normalised(spark, sf):
    c = read(spark, sf, "customer")
    word = F.when(F.col("c_custkey") % 4 == 0, "m").when(F.col("c_custkey") % 4 == 1, " FEMALE").when(
        F.col("c_custkey") % 4 == 2, " ").otherwise(F.concat("c_mktsegment", F.lit("-x_y z#1a"), "c_name"))
    return c.select("c_custkey", tx.normalise_sex(word).alias("sex"))


def _order_text(form: str):
    return F.date_format("o_orderdate", form)


def safe_date_parse(spark, sf):
    o = read(spark, sf, "orders")
    k = F.col("o_orderkey") % 8
    text = (
        F.when(k == 0, _order_text("yyyy-MM-dd"))
        .when(k == 1, _order_text("dd/MM/yyyy"))
        .when(k == 2, _order_text("yyyy/MM/dd"))
        .when(k == 3, F.concat(_order_text("yyyy-MM"), F.lit("-31")))
        .when(k == 4, F.concat(F.lit("29/02/"), _order_text("yyyy")))
        .when(k == 5, F.concat(F.lit("0000"), _order_text("-MM-dd")))
        .when(k == 6, F.concat(F.lit(" "), _order_text("yyyy-MM-dd"), F.lit("  ")))
        .otherwise(F.concat(_order_text("yyyy-MM-dd"), F.lit("\n")))
    )
    return o.select("o_orderkey", tm.safe_date(text).alias("parsed_date"))


def safe_timestamp_parse(spark, sf):
    e = read(spark, sf, "events")
    k = F.col("event_id") % 8
    stamp = F.col("ts").cast("string")
    text = (
        F.when(k == 0, stamp)
        .when(k == 1, F.translate(stamp, " ", "T"))
        .when(k == 2, F.substring(stamp, 1, 19))
        .when(k == 3, F.substring(stamp, 1, 10))
        .when(k == 4, F.date_format("ts", "dd/MM/yyyy"))
        .when(k == 5, F.concat(stamp, F.lit("+00")))
        .when(k == 6, F.concat(F.substring(stamp, 1, 11), F.lit("24:61:00")))
        .otherwise(F.lit(""))
    )
    return e.select(
        "event_id",
        tm.safe_timestamp(text).alias("with_day_first"),
        tm.safe_timestamp(text, day_first=False).alias("iso_only"),
        tm.instant(text).alias("instant"),
    )


def timestamp_profile(spark, sf):
    feed = spark_feed(spark, sf, "adam_travellers_raw")
    profile = silver.traveller_timestamp_profile(feed)
    return profile.groupBy("timestamp_pattern_status", "parsed_screening_date").agg(
        F.count("*").alias("n_rows"),
        F.count("parsed_created_timestamp").alias("n_parsed"),
        F.min("raw_character_length").alias("shortest"),
        F.max("trimmed_character_length").alias("longest"),
    )


def bounded_numbers(spark, sf):
    c = read(spark, sf, "customer")
    k = F.col("c_custkey") % 6
    text = (
        F.when(k < 3, F.concat(F.lit(" "), (F.floor("c_acctbal") % 250).cast("string"), F.lit(".75")))
        .when(k == 3, F.lit("1e2"))
        .when(k == 4, F.concat(F.lit("+"), F.col("c_custkey").cast("string")))
        .otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(".")))
    )
    return c.select(
        "c_custkey",
        num.latitude(text).alias("latitude"),
        num.longitude(text).alias("longitude"),
        num.safe_decimal(text).alias("amount"),
    )


# --- one row per key ------------------------------------------------------------------


def latest_per_key(spark, sf):
    e = read(spark, sf, "events")
    key = F.coalesce(
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")),
        F.concat(F.lit("row "), F.col("event_id").cast("string")),
    )
    minute = e.withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.date_trunc("hour", "ts")))
    return dedup.latest_per_key(minute, key, "ts", "event_id").select(
        "event_id", "user_id", "event_type", "value"
    )


def representative_row(spark, sf):
    p = read(spark, sf, "part")
    odd = F.col("p_partkey") % 3
    spelled = p.select(
        F.when(odd == 0, F.lower("p_brand")).when(odd == 1, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("brand"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("kind"),
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("label"),
    )
    order = [F.col(c).asc_nulls_last() for c in ("label", "brand", "kind")]
    return dedup.representative_row(spelled, ["brand", "kind"], order)


def duplicate_fact_keys(spark, sf):
    """Record ids by another priority than the one rows were deduplicated on."""
    lab = warehouse(spark, sf).prepared("fct_lab_result")
    return dedup.duplicate_keys(lab, "lab_result_key")


# --- calendar -------------------------------------------------------------------------


def _spine(spark, sf) -> DataFrame:
    bounds = read(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.date_add(F.to_date(F.max("o_orderdate")), 1).alias("last_day")
    )
    return cal.date_attributes(cal.spine_over(bounds))


def calendar_activity(spark, sf):
    """Every calendar day with its orders, days without any included."""
    orders = read(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.count("*").alias("n")
    )
    days = _spine(spark, sf)
    joined = days.join(orders, F.col("full_date") == F.col("d"), "left").drop("d")
    return joined.withColumn("n_orders", F.coalesce("n", F.lit(0))).drop("n")


def date_key_lookup(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    half = _spine(spark, sf).filter("month < 7")
    return lookup.date_keys(o, half, {"order_date_key": F.to_date("o_orderdate")}).select(
        "o_orderkey", "order_date_key"
    )


def role_playing_dates(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    both = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    roles = {"order_date_key": F.to_date("o_orderdate"), "ship_date_key": F.to_date("l_shipdate")}
    keyed = lookup.date_keys(both, _spine(spark, sf), roles)
    return keyed.groupBy(*roles).agg(F.count("*").alias("n_lines"))


def epi_week_range_join(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    weeks = cal.epi_weeks(_spine(spark, sf), settings(spark, sf).as_of)
    found = lookup.enclosing_week(
        o, weeks, F.col("d"),
        {"epi_week_label": "epi_week_label", "start_of_week": "start_of_week",
         "current_epi_week_flag": "current_epi_week_flag"},
    )
    return found.groupBy("epi_week_label", "start_of_week", "current_epi_week_flag").agg(
        F.count("*").alias("n_orders"), F.sum("o_orderkey").alias("key_sum")
    )


def local_date(spark, sf):
    e = read(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    return e.groupBy(tm.local_date(ts).alias("screening_date"), F.to_date(ts).alias("utc_date")).agg(
        F.count("*").alias("n_events")
    )


def age_years(spark, sf):
    li = read(spark, sf, "lineitem")
    ship = F.to_date("l_shipdate")
    birth = F.date_sub(ship, (F.col("l_partkey") * 17 % 33000 - 500).cast("int"))
    age = tm.full_years(ship, birth)
    return li.select(
        age.alias("age"),
        tm.case_age(ship, birth).alias("case_age"),
        tm.case_age_group(ship, birth).alias("case_age_group"),
        tm.person_age_group(age).alias("person_age_group"),
    ).groupBy("age", "case_age", "case_age_group", "person_age_group").agg(
        F.count("*").alias("n_lines")
    )


def turnaround(spark, sf):
    li = read(spark, sf, "lineitem")
    done = (F.col("l_shipdate") + F.make_dt_interval(mins=(F.col("l_partkey") % 1440).cast("int"))).cast("timestamp")
    start = F.date_sub(F.to_date("l_shipdate"), (F.col("l_suppkey") % 10 - 1).cast("int"))
    asked = F.when(F.col("l_linenumber") != 7, start)
    return li.select(
        "l_returnflag",
        tm.turnaround_days(asked, done).alias("turnaround_time_days"),
        tm.turnaround_band(asked, done).alias("turnaround_time_band"),
        tm.turnaround_hours(asked, done).alias("hours"),
    ).groupBy("l_returnflag", "turnaround_time_days", "turnaround_time_band").agg(
        F.count("*").alias("n_lines"),
        F.sum("hours").cast("decimal(28,2)").alias("hours_sum"),
    )


def iso_week_label(spark, sf):
    o = read(spark, sf, "orders")
    day = F.when(F.col("o_orderkey") % 10 != 0, F.to_date("o_orderdate"))
    parts = tm.calendar_parts(day)
    return o.select(*(c.alias(n) for n, c in parts.items())).groupBy(*parts).agg(
        F.count("*").alias("n_orders")
    )


# --- keys, lookups, unions ------------------------------------------------------------


def surrogate_key(spark, sf):
    c = read(spark, sf, "customer")
    name = F.when(F.col("c_custkey") % 3 != 0, F.col("c_name"))
    segment = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    return c.select(
        "c_custkey",
        keys.surrogate_key(name, segment, F.col("c_nationkey")).alias("customer_key"),
        keys.record_id(F.col("c_custkey"), F.when(F.col("c_custkey") % 5 == 0, " "),
                       F.concat(F.lit(" "), name, F.lit(" ")), segment).alias("record_id"),
    )


def lookup_cascade(spark, sf, direct: bool | None = None):
    """Lines to parts by name and size, then name, then brand; gaps stay unresolved."""
    p = read(spark, sf, "part")
    brand = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    known = p.filter((F.col("p_size") < 30) & (brand < 20)).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("part_key"),
        F.initcap("p_name").alias("name"),
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).alias("size"),
        F.upper("p_brand").alias("brand"),
    )
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    asked = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        F.concat(F.lit(" "), "p_name").alias("part_name"),
        F.col("p_size").cast("string").alias("part_size"),
        "p_brand",
    )
    steps = [{"name": "part_name", "size": "part_size"}, {"name": "part_name"}, {"brand": "p_brand"}]
    found = lookup.cascade(asked, known, "part_key", steps, "found_key", direct=direct)
    return found.groupBy("found_key").agg(
        F.count("*").alias("n_lines"),
        F.sum(F.col("found_key").isNotNull().cast("int")).alias("n_matched"),
        F.sum("l_orderkey").alias("order_sum"),
    )


def unknown_member_default(spark, sf):
    nations = read(spark, sf, "nation").filter("n_nationkey % 3 > 0").select(
        "n_nationkey", keys.surrogate_key(F.col("n_name")).alias("nation_key")
    )
    s = read(spark, sf, "supplier")
    found = lookup.attributes(
        s, nations, F.col("s_nationkey"), {"nation_key": "nation_key"}, "n_nationkey"
    )
    return found.select("s_suppkey", F.coalesce("nation_key", keys.unknown_key()).alias("nation_key"))


def not_yet_loaded(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_name")
    big = read(spark, sf, "orders").filter("o_totalprice > 300000")
    buyers = big.select(F.col("o_custkey").alias("c_custkey"))
    return lookup.not_in(c, buyers, "c_custkey")


def case_folded_distinct(spark, sf):
    c = read(spark, sf, "customer")
    word = F.when(F.col("c_custkey") % 3 == 0, F.lower("c_mktsegment")).when(
        F.col("c_custkey") % 3 == 1, F.concat(F.lit(" "), "c_mktsegment")).otherwise(" ")
    return conform.canonical_spelling(c.select(word.alias("segment")), "segment")


def conformed_union(spark, sf):
    c = read(spark, sf, "customer").select(
        F.lit("CUSTOMER").alias("source_system"), F.col("c_custkey").alias("row_id"),
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
    )
    s = read(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.lit("SUPPLIER").alias("source_system"),
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("row_id"),
    )
    return conform.conformed_union([c, s])


def distinct_places(spark, sf):
    c = read(spark, sf, "customer").select(F.col("c_nationkey").alias("place"))
    s = read(spark, sf, "supplier").select(F.col("s_nationkey").alias("place"))
    return conform.conformed_union([c.distinct(), s.distinct()]).distinct()


# --- rules and measures ---------------------------------------------------------------


def _rule_words(key, words):
    return F.element_at(F.array(*map(F.lit, words)), (key % len(words) + 1).cast("int"))


def classification_rules(spark, sf):
    o = read(spark, sf, "orders")
    k = F.col("o_orderkey")
    c = _rule_words(k, ["Suspected", " probable ", "CONFIRMED", "no case", "Not A Case", "negative", " ", "in review"])
    return o.select(
        "o_orderstatus",
        rules.initial_classification(c).alias("initial"),
        rules.final_classification(c).alias("final"),
        rules.screening_outcome(c).alias("screening"),
        rules.reporting_classification(
            rules.final_classification(F.when(k % 3 != 0, c)), rules.initial_classification(c)
        ).alias("reporting"),
        rules.investigation_status(rules.final_classification(c)).alias("status"),
    ).groupBy("o_orderstatus", "initial", "final", "screening", "reporting", "status").agg(
        F.count("*").alias("n_orders")
    )


def result_and_outcome_rules(spark, sf):
    li = read(spark, sf, "lineitem")
    k = F.col("l_partkey")
    result = _rule_words(k, ["Positive", "not detected", "equivocal", "present", "Not_Detected", "", "odd", "nonreactive"])
    outcome = _rule_words(F.col("l_suppkey"), ["Died", "deceased /dead", "Living", "alive and discharged", "ongoing",
                                               "referred", "lost", "", "moved away"])
    died_on = F.when(F.col("l_linenumber") < 4, F.to_date("l_shipdate"))
    final = _rule_words(F.col("l_orderkey"), ["CONFIRMED", "SUSPECTED", "CONFIRMED"])
    rows = li.select(
        result.alias("result"), outcome.alias("outcome"), died_on.alias("died_on"),
        final.alias("final"),
    ).withColumns(
        {
            "lab_category": rules.lab_result_category(F.col("result")),
            "case_category": rules.case_result_category(F.col("result")),
        }
    )
    lab = F.col("case_category")
    rows = rows.withColumns(
        {
            "source_outcome": rules.source_outcome(F.col("outcome"), lab),
            "died_flag": rules.validated_death(F.col("died_on"), F.col("final"), lab),
            "validation": rules.outcome_validation(F.col("died_on"), F.col("final"), lab),
        }
    ).withColumn(
        "treatment_outcome", rules.treatment_outcome(F.col("died_flag"), F.col("source_outcome"))
    )
    out = ["lab_category", "case_category", "source_outcome", "died_flag", "validation", "treatment_outcome"]
    return rows.groupBy(*out).agg(F.count("*").alias("n_lines"))


def category_measures(spark, sf):
    o = read(spark, sf, "orders")
    status, n = F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 4 != 0, F.lit(1))
    cols = [
        *measures.counts_by_value(status, {"F": "finished", "O": "open", "P": "partial"}, n),
        measures.count_when(status.isin("O", "P"), n).alias("pending"),
        measures.count_when(F.col("o_totalprice") > 200000).alias("large"),
    ]
    names = ["finished", "open", "partial", "pending", "large"]
    return rollup.totals(o.select("o_orderpriority", *cols), ["o_orderpriority"], {c: c for c in names})


# --- rollups --------------------------------------------------------------------------


def _weekly(spark, sf) -> DataFrame:
    o = read(spark, sf, "orders")
    day = F.to_date("o_orderdate")
    end = F.date_add(tm.epi_week_start(day), 6)
    rows = o.select(
        "o_orderpriority",
        tm.epi_year(end).alias("epi_year"),
        tm.epi_week_number(end).alias("epi_week"),
        F.lit(1).alias("n"),
        measures.count_when(F.col("o_orderstatus") == "F").alias("finished"),
    )
    return rollup.totals(
        rows, ["o_orderpriority", "epi_year", "epi_week"], {"total": "n", "finished": "finished"}
    )


BY, ORDER = ["o_orderpriority"], ["epi_year", "epi_week"]


def weekly_rollup(spark, sf):
    return _weekly(spark, sf)


def running_total(spark, sf):
    return rollup.year_to_date(_weekly(spark, sf), BY, "epi_year", "epi_week", {"cumulative": "total"})


def moving_average(spark, sf):
    return rollup.moving_average(_weekly(spark, sf), BY, ORDER, "total", 4, "mean_of_4")


def week_change(spark, sf):
    return rollup.change_from_previous(
        _weekly(spark, sf), BY, ORDER, "total", ("previous", "change", "change_percent")
    )


def rates(spark, sf):
    weekly = _weekly(spark, sf).withColumn("rest", F.col("total") - F.col("finished"))
    return rollup.with_rates(
        weekly, {"finished_rate": ("finished", "total"), "finished_to_rest": ("finished", "rest")}
    )


def domain_union_summary(spark, sf):
    o = read(spark, sf, "orders").select(
        F.date_format("o_orderdate", "MM-dd").alias("day"), F.lit(1).alias("orders")
    )
    e = read(spark, sf, "events").select(
        F.date_format("ts", "MM-dd").alias("day"), F.lit(1).alias("events"),
        measures.count_when(F.col("event_type") == "error").alias("errors"),
    )
    li = read(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "MM-dd").alias("day"), F.lit(1).alias("lines")
    )
    names = ["orders", "events", "errors", "lines"]
    parts = [
        rollup.totals(d, ["day"], {m: m for m in names if m in d.columns}) for d in (o, e, li)
    ]
    stacked = conform.zero_filled_union(parts, names)
    return rollup.with_rates(
        rollup.totals(stacked, ["day"], {m: m for m in names}), {"error_rate": ("errors", "events")}
    )


OPERATORS = [
    confirmed_by_week_and_county, flatten_events, flatten_paths, flatten_leaf_counts,
    record_hash_dedup, stream_ingest, ingest_array_document, ingest_archived, stream_ingest_loads, preview_columns, blank_to_null,
    yes_no_flag, sex_normalised, safe_date_parse, safe_timestamp_parse, timestamp_profile,
    bounded_numbers, latest_per_key, representative_row, duplicate_fact_keys,
    calendar_activity, date_key_lookup, role_playing_dates, epi_week_range_join, local_date,
    age_years, turnaround, iso_week_label, surrogate_key, lookup_cascade,
    unknown_member_default, not_yet_loaded, case_folded_distinct, conformed_union,
    distinct_places, classification_rules, result_and_outcome_rules, category_measures,
    weekly_rollup, running_total, moving_average, week_change, rates, domain_union_summary,
]


def _prepared(build):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        configure(spark)
        return comparable(build(spark, sf.rstrip("/")))

    return run


def all_queries():
    named = {f.__name__: f for f in OPERATORS}
    named["lookup_cascade_large"] = partial(lookup_cascade, direct=False)
    named |= {name: model(name, layer) for layer, name, _ in MODELS}
    return {name: _prepared(f) for name, f in named.items()}
