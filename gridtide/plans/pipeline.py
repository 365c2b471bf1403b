"""One incremental run of everything: control table to gold."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Dataset, Layout
from ..functions.typing import to_typed
from ..operators import control
from ..operators.silver import CONSUMPTION, SOLAR, TRANSFORMATIONS, WIND, consumption, dispatch
from ..operators.windows import place_records, plan_windows
from ..schemas import CONTROL, SILVER_CONSUMPTION, SILVER_GENERATION
from ..session import join_path, pin
from ..sources.catalog import create_schemas, publish_table, publish_views, schema_name
from ..sources.landing import archive_landed, rejected_counts, write_landing
from ..sources.sliced import SlicedTable
from ..sources.tables import create_once, delete_folder, literal_rows, path_exists, read_text, write_static
from ..streaming.bronze import RULE_COUNTS, bronze_schema, run_bronze
from ..streaming.gold import (
    CHANGING_TABLES,
    DIMENSIONS,
    run_dim_customer_type,
    run_fact_consumption,
    run_fact_generation,
    store_dimensions,
)
from ..streaming.metrics import MetricsTable, ObservedCounts
from ..streaming.runs import finish
from ..streaming.silver import run_silver

# Gets the planned windows, gives the records of (at least) those windows:
# source_dataset_id next to the landing fields.
Feed = Callable[[DataFrame], DataFrame]


def control_table(layout: Layout) -> SlicedTable:
    """One row per dataset and environment, kept as one slice."""
    return SlicedTable(layout.control, CONTROL, lambda: F.lit(0).cast("bigint"), ("id",))


def gold_tables(layout: Layout) -> dict[str, SlicedTable]:
    return {name: make(layout.gold(name)) for name, make in CHANGING_TABLES.items()}


def ensure_control(
    spark: SparkSession, layout: Layout, seed: DataFrame, now: Column | None = None
) -> SlicedTable:
    """Create the control table and seed the environment if it has no rows."""
    table = control_table(layout)
    table.create(spark)
    existing = table.read(spark)
    if existing.where(F.col("environment") == layout.environment).isEmpty():
        table.replace(spark, control.bootstrap(existing, seed, layout.environment, now))
    return table


# Rules for the mark of a dataset after a run: the time of the run, or the end of its newest reading.
RUN_TIME, NEWEST_READING = "run time", "newest reading"


def land(
    active: DataFrame, feed: Feed, layout: Layout, now: Column, gathered: bool = False, newest: bool = False
) -> dict[int, str]:
    """Fetch what the windows ask for and store it per dataset and window; records that
    no window takes are landed as rejected, by reason.

    With ``newest`` it gives the end of the newest reading of each dataset, observed in the
    same pass: one maximum per active dataset.
    """
    placed = place_records(feed(plan_windows(active, now)), active, now)
    if not newest:
        write_landing(placed, layout.landing, gathered)
        return {}
    ids = [r.source_dataset_id for r in active.select("source_dataset_id").distinct().collect()]  # one row per dataset
    # A record without a start, which bronze will drop, moves no mark.
    started = F.col("rejected").isNull() & to_typed("startTime", "timestamp").isNotNull()
    taken = F.when(started, to_typed("endTime", "timestamp"))
    of_dataset = [F.max(F.when(F.col("source_dataset_id") == i, F.unix_micros(taken))).alias(str(i)) for i in ids]
    if not ids:
        write_landing(placed, layout.landing, gathered)
        return {}
    seen = Observation("newest readings")
    write_landing(placed.observe(seen, *of_dataset), layout.landing, gathered)
    told = {i: seen.get[str(i)] for i in ids}
    return {i: (EPOCH + dt.timedelta(microseconds=m)).isoformat() for i, m in told.items() if m is not None}


EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class PendingRun:
    """The end of a run that is not complete, and whether its windows are landed. A run
    that is repeated takes the same end, and does not land again what streams may have
    read already: files under new names would be read once more."""

    def __init__(self, spark: SparkSession, layout: Layout):
        self.spark, self.folder = spark, layout.at("landing_admin", "pending_run")

    def end(self, proposed: dt.datetime) -> dt.datetime:
        path = join_path(self.folder, "end")
        if path_exists(self.spark, join_path(path, "_SUCCESS")):
            return dt.datetime.fromisoformat(self.spark.read.schema("until string").parquet(path).first().until)
        write_static(literal_rows(self.spark, [(proposed.isoformat(),)], until="string"), path)
        return proposed

    def landed(self) -> dict[int, str] | None:
        """What was observed while landing; None if that is still to do."""
        path = join_path(self.folder, "landed.json")
        if not path_exists(self.spark, path):
            return None
        return {int(i): mark for i, mark in json.loads(read_text(self.spark, path)).items()}

    def mark_landed(self, newest: dict[int, str]) -> None:
        create_once(self.spark, join_path(self.folder, "landed.json"), json.dumps(newest))

    def finish(self) -> None:
        delete_folder(self.spark, self.folder)


def marks_at(active: DataFrame, environment: str, now: Column) -> DataFrame:
    """Every dataset that had windows is complete up to the time of the run."""
    planned = active.where(to_typed("last_timestamp", "timestamp") < now)
    return planned.select(
        "source_dataset_id", F.lit(environment).alias("environment"), now.alias("mark")
    )


def marks_of(records: DataFrame, environment: str) -> DataFrame:
    """Every dataset is complete up to the end of its newest reading, so data
    published late is still fetched by the next run."""
    ended = to_typed("endTime", "timestamp")
    return (
        records.groupBy("source_dataset_id")
        .agg(F.max(ended).alias("mark"))
        .withColumn("environment", F.lit(environment))
    )


def marks_seen(spark: SparkSession, newest: dict[int, str], environment: str) -> DataFrame:
    """Marks from what landing observed; a dataset without readings keeps its mark."""
    rows = [(i, environment, mark) for i, mark in newest.items()]
    frame = literal_rows(spark, rows, source_dataset_id="int", environment="string", mark="string")
    return frame.withColumn("mark", to_typed("mark", "timestamp"))


def run_streams(
    spark: SparkSession,
    layout: Layout,
    datasets: Sequence[Dataset],
    now: Column | None = None,
    bronze_options: dict[str, str] | None = None,
    silver_options: dict[str, str] | None = None,
    gold_options: dict[str, str] | None = None,
    **limits: str,
) -> dict[str, dict[str, int]]:
    """Bring bronze, silver and gold up to date; gives the rule counts per table.

    The streams of a layer do not depend on each other and run side by side.
    ``limits`` are options of the file source for all layers, the others for one: what
    moves or deletes files that were read, cleanSource, is for bronze alone.
    """
    of_bronze, of_silver, of_gold = ({**limits, **(o or {})} for o in (bronze_options, silver_options, gold_options))
    store_dimensions(spark, layout)
    history = MetricsTable(spark, layout.at("landing_admin", "rule_metrics"))
    with ObservedCounts(spark, RULE_COUNTS, history=history) as counts:
        raw = finish(run_bronze(spark, layout, d, now, **of_bronze) for d in datasets)
        totals = {d.bronze_table: counts.of(query) for d, query in zip(datasets, raw)}
    typed = dispatch(datasets, TRANSFORMATIONS)
    finish(run_silver(spark, layout, d, transform, now, **of_silver) for d, transform in typed)

    generating = [d for d in datasets if d.id in (WIND, SOLAR)]
    consuming = [d for d in datasets if d.id == CONSUMPTION]
    gold = []
    if generating:
        gold.append(run_fact_generation(spark, layout, generating, now, **of_gold))
    for dataset in consuming:
        gold.append(run_fact_consumption(spark, layout, dataset, now, **of_gold))
        gold.append(run_dim_customer_type(spark, layout, dataset, **of_gold))
    finish(gold)
    return totals


def publish(spark: SparkSession, layout: Layout, datasets: Sequence[Dataset]) -> None:
    """Give every table of the layers its SQL name."""
    create_schemas(spark, layout)
    for d in datasets:
        comment = f"Raw readings of {d.key} from the landing zone."
        publish_table(
            spark,
            layout,
            "bronze",
            d.bronze_table,
            layout.bronze(d),
            bronze_schema(d.extra_fields),
            comment,
        )
    for d, transform in dispatch(datasets, TRANSFORMATIONS):
        schema = SILVER_CONSUMPTION if transform is consumption else SILVER_GENERATION
        comment = f"Typed readings of {d.name}."
        publish_table(spark, layout, "silver", d.silver_table, layout.silver(d), schema, comment)
    for name, build in DIMENSIONS.items():
        comment = f"Generated dimension {name}."
        publish_table(spark, layout, "gold", name, layout.gold(name), build(spark).schema, comment)
    publish_views(spark, layout, changing_tables(layout))


def changing_tables(layout: Layout) -> list[tuple[str, str, SlicedTable]]:
    gold = [("gold", name, table) for name, table in gold_tables(layout).items()]
    return [*gold, ("landing_admin", "meta_control_table", control_table(layout))]


def republish(spark: SparkSession, layout: Layout) -> None:
    """Point the names of changing tables at their newest versions, if they are published."""
    if spark.catalog.databaseExists(schema_name(layout, "gold")):
        publish_views(spark, layout, changing_tables(layout))


def run_pipeline(
    spark: SparkSession,
    layout: Layout,
    datasets: Sequence[Dataset],
    feed: Feed,
    now: dt.datetime | None = None,
    seed: DataFrame | None = None,
    keep_versions: int | None = 10,
    gathered: bool = False,
    marks: str = RUN_TIME,
    archive: bool = True,
    **limits,
) -> dict[str, dict[str, int]]:
    """Control table, landing, streams, and last the watermark.

    One time, ``now``, ends the windows, is the arrival time in all layers, and becomes
    the watermark; with ``marks=NEWEST_READING`` the watermark is where the newest landed
    reading of a dataset ends, so data published late is still asked for by the next run. A run that stops anywhere before its end is repeated with the same
    end, whatever ``now`` says, and windows that are landed are not landed again, so
    bronze and silver do not double. Counts of records that no window took come under
    ``rejected``. Of changing tables ``keep_versions`` versions stay. A feed whose records
    come window by window is ``gathered``. ``limits`` may hold options of one layer,
    see ``run_streams``. With ``archive`` windows that bronze has read move
    to ``landing_archive``, so the next run lists only what is new.
    """
    pin(spark)
    pending = PendingRun(spark, layout)
    until = F.lit(pending.end(now or dt.datetime.now(dt.timezone.utc))).cast("timestamp")
    first_rows = control.default_seed(spark) if seed is None else seed
    table = ensure_control(spark, layout, first_rows, until)
    rows = table.read(spark)
    active = control.active_datasets(rows, layout.environment)
    if marks not in (RUN_TIME, NEWEST_READING):
        raise ValueError(f"marks: {marks!r} is neither {RUN_TIME!r} nor {NEWEST_READING!r}")
    newest = pending.landed()
    if newest is None:
        newest = land(active, feed, layout, until, gathered, marks == NEWEST_READING)
        pending.mark_landed(newest)
    totals = run_streams(spark, layout, datasets, until, **limits)
    refused = {r.reason: r.n for r in rejected_counts(spark, layout.landing, until).collect()}  # one row per reason
    if refused:
        totals["rejected"] = refused
    told = marks_at(active, layout.environment, until) if marks == RUN_TIME else marks_seen(spark, newest, layout.environment)
    table.replace(spark, control.advance_watermark(rows, told))
    pending.finish()
    if archive:
        for d in datasets:
            archive_landed(spark, layout.landing_of(d), layout.at("landing_archive", f"dataset={d.key}"))
    republish(spark, layout)
    if keep_versions:
        for changing in (table, *gold_tables(layout).values()):
            changing.prune(spark, keep_versions)
    return totals
