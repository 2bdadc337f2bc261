"""The warehouse: a root folder with one Parquet table per name, and the runs that fill it."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from tramline import schemas
from tramline.functions import to_date_or_null
from tramline.operators.columns import audit_stamp
from tramline.plans import clean, dims, facts, staging
from tramline.session import configure, place_of, scratch_path, scratch_scope, together
from tramline.sinks.commits import CommittedTable
from tramline.sinks.conform import align_by_name
from tramline.sinks.files import write_parquet_chunked
from tramline.sinks.tables import complete_days, full_refresh
from tramline.sources.audit import IncompleteLanding, landing_audit
from tramline.sources.catalog import RAW_SOURCES
from tramline.sources.census import landed_days, read_range
from tramline.sources.files import broken_files, scan_hourly_json, scan_json_rows
from tramline.sources.payloads import array_position_seq, promised_by_day, scan_xml_pages
from tramline.sources.ranges import MissingDays, date_hour_spine, previous_month_bounds

DAY = "usage_date"
#: Tables that change by committed batches, with the column of their folders; others are replaced as a whole.
COMMITTED = {
    "bike_usage": DAY,
    "bike_usage_by_hour": DAY,
    "bus_usage": DAY,
    "subway_usage": DAY,
    "fact_bike_usage": "date_id",
    "fact_bus_usage": "date_id",
    "fact_subway_usage": "date_id",
}
#: Logical source name -> table, for those the warehouse loads.
_SOURCE_TABLES = {
    "bike_hour": "bike_usage",
    "bike_location": "bike_location",
    "bus": "bus_usage",
    "bus_location": "bus_stop_location",
    "subway": "subway_usage",
    "subway_location": "subway_location",
}


def _days(start: date, end: date) -> list[date]:
    return [start + timedelta(days=n) for n in range((end - start).days + 1)]


class Warehouse:
    """Runs are plain methods; each is one lazy plan up to its write."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> CommittedTable:
        """A table that changes by committed batches."""
        return CommittedTable(self.spark, self.path(name), schemas.table_schema(name), COMMITTED[name])

    def read(self, name: str) -> DataFrame:
        if name in COMMITTED:
            return self.table(name).read()
        return self.spark.read.schema(schemas.table_schema(name)).parquet(self.path(name))

    def _aligned(self, rows: DataFrame, name: str) -> DataFrame:
        return align_by_name(rows, schemas.table_schema(name))

    # Daily usage: the day before the run replaces what the table holds for it.

    def load_bike_day(self, landing: str, run: datetime, array_files: bool = False) -> None:
        raw = scan_json_rows(self.spark, landing, schemas.RAW_BIKE_USAGE, array_files)
        if raw.isEmpty():
            raise IncompleteLanding(f"no rows below {landing}")
        batch = self._aligned(clean.clean_bike_usage(raw, run), "bike_usage")
        self.table("bike_usage").replace_days(batch, [run.date() - timedelta(days=1)])

    def _bus_pages(self, landing: str) -> DataFrame:
        """The landed pages, read and parsed once, as a written table."""
        place = scratch_path(self.spark, "bus-pages")
        scan_xml_pages(self.spark, landing, schemas.RAW_BUS_USAGE).write.parquet(place)
        return self.spark.read.parquet(place)

    def _bus_batch(self, pages: DataFrame, run: datetime) -> DataFrame:
        return self._aligned(clean.clean_bus_usage(pages.select(F.inline("rows")), run), "bus_usage")

    def load_bus_day(self, landing: str, run: datetime) -> None:
        """Replace the day, but only if every page has its total and all promised rows came."""
        pages = self._bus_pages(landing)
        seen = pages.agg(
            F.max("list_total_count").alias("promised"),
            F.count(F.when(F.col("list_total_count").isNull(), 1)).alias("without"),
            F.coalesce(F.sum(F.size("rows")), F.lit(0)).alias("landed"),
        ).first()
        if seen["without"] or seen["promised"] is None:
            raise IncompleteLanding(f"a page below {landing} has no total")
        if seen["landed"] != seen["promised"]:
            raise IncompleteLanding(f"{seen['landed']} of {seen['promised']} rows below {landing}")
        self.table("bus_usage").replace_days(self._bus_batch(pages, run), [run.date() - timedelta(days=1)])

    def load_bus_days_if_complete(self, landing: str, run: datetime) -> list[date]:
        """Replace only the days of which every page has the day's total and all promised rows came.

        The landing may hold pages of many days. A day with a missing or broken page, a page
        landed twice or pages that promise different totals keeps its earlier rows. All whole days
        change at one moment; returns them.
        """
        pages = self._bus_pages(landing)
        batch = self._bus_batch(pages, run)
        promised = promised_by_day(pages, lambda row: to_date_or_null(row["USE_YMD"]), DAY)
        audit = landing_audit(batch, promised, promised.select(DAY), [DAY])
        days = complete_days(audit)
        if days:
            self.table("bus_usage").replace_days(batch.where(F.col(DAY).isin(days)), days)
        return days

    def load_bike_days_if_complete(
        self, landing: str, promised: DataFrame, run: datetime, array_files: bool = False
    ) -> list[date]:
        """Replace only the days for which every hour brought the rows it promised.

        ``promised`` has usage_date, usage_time and list_total_count; an hour it does not
        mention counts as missing. Returns the days that were replaced.
        """
        raw = scan_json_rows(self.spark, landing, schemas.RAW_BIKE_USAGE, array_files)
        batch = self._aligned(clean.clean_bike_usage(raw, run), "bike_usage")
        span = promised.agg(F.min(DAY).alias("start"), F.max(DAY).alias("end"))
        audit = landing_audit(batch, promised, date_hour_spine(span), [DAY, "usage_time"])
        days = complete_days(audit)
        if days:
            self.table("bike_usage").replace_days(batch.where(F.col(DAY).isin(days)), days)
        return days

    def load_bike_day_by_hour(self, landing: str, run: datetime, partial: bool = False) -> list[str]:
        """The strict variant, from a folder of hour files; returns the unreadable ones.

        An unreadable file stops the load before the day changes, unless ``partial`` allows a
        day without it. Rows the strict rules would stop at are kept aside as landed, with the
        names of the bad columns, in ``bike_usage_by_hour_rejects``. The landing is judged once,
        into a written table that both outcomes are read from.
        """
        broken = broken_files(self.spark, landing, schemas.RAW_BIKE_USAGE)
        if broken and not partial:
            raise IncompleteLanding(f"unreadable: {broken}")
        name = "bike_usage_by_hour"
        raw = scan_hourly_json(self.spark, landing, schemas.RAW_BIKE_USAGE)
        place = scratch_path(self.spark, "judged-hours")
        raw.withColumn("_rejected_columns", clean.bike_usage_faults(raw)).write.parquet(place)
        judged = self.spark.read.parquet(place)
        good = judged.where("size(_rejected_columns) = 0").drop("_rejected_columns")
        bad = judged.where("size(_rejected_columns) > 0").select(
            F.to_json(F.struct(*(f"`{column}`" for column in raw.columns))).alias("_raw"), "_rejected_columns"
        )
        batch = self._aligned(clean.clean_bike_usage_strict(good), name)
        self.table(name).replace_days(batch, [run.date() - timedelta(days=1)])
        full_refresh(bad, self.path(f"{name}_rejects"))
        return broken

    # Bike history: cleaned once into files of bounded size, then loaded by file name.

    def stage_bike_history(
        self, raw: DataFrame, staging_path: str, run: datetime | None = None
    ) -> None:
        """Without a ``run`` the rows carry no load stamp, and the fact build leaves them out."""
        rows = clean.clean_bike_usage_bulk(raw)
        write_parquet_chunked(audit_stamp(rows, run) if run else rows, staging_path)

    def load_bike_history(self, staging_path: str, pattern: str = "part-*.parquet") -> list[str]:
        """Add the staged files that were not loaded before; return them. A repeated run adds nothing."""

        def rows(files: list[str]) -> DataFrame:
            return self._aligned(self.spark.read.parquet(*files), "bike_usage")

        return self.table("bike_usage").load_files(staging_path, rows, pattern)

    # Subway: landed as one Parquet folder per day (usage_date=...).

    def load_subway_range(
        self, landing: str, start: date, end: date, run: datetime, append: bool = False
    ) -> dict[date, str]:
        """Load the days of a range that were landed and fit; the others are left as they are.

        Returns why each day was left out: not landed, unreadable, or of types that cannot be
        widened to the raw schema. All loaded days change at one moment.
        """
        raw, left_out = read_range(
            self.spark, landing, DAY, start, end, schemas.RAW_SUBWAY_USAGE, schemas.RAW_SUBWAY_OPTIONAL
        )
        batch = self._aligned(clean.clean_subway_usage(raw, run), "subway_usage")
        loaded = [day for day in _days(start, end) if day not in left_out]
        if append and loaded:
            self.table("subway_usage").append(batch, gather=True)
        elif loaded:
            self.table("subway_usage").replace_days(batch, loaded)
        return left_out

    def load_subway_month(self, landing: str, run: datetime, strict: bool = False) -> dict[date, str]:
        """Load the calendar month before the run and return the days left out; ``strict`` raises before anything is loaded if a day was not landed or cannot be read."""
        start, end = previous_month_bounds(run.date())
        if strict:
            whole = {found.day for found in landed_days(self.spark, landing, DAY, start, end) if not found.fault}
            absent = [day for day in _days(start, end) if day not in whole]
            if absent:
                raise MissingDays(f"no rows for {absent}")
        return self.load_subway_range(landing, start, end, run)

    # Places: replaced as a whole, unless nothing was landed.

    def refresh_bike_locations(self, landing: str, array_files: bool = False) -> None:
        raw = scan_json_rows(self.spark, landing, schemas.RAW_BIKE_STATION, array_files)
        self._refresh_places("bike_location", raw, clean.clean_bike_station(raw))

    def refresh_bus_stops(self, landing: str, array_files: bool = False) -> None:
        raw = scan_json_rows(self.spark, landing, schemas.RAW_BUS_STOP, array_files)
        self._refresh_places("bus_stop_location", raw, clean.clean_bus_stop(raw))

    def refresh_metro_stations(self, landing: str, created: date) -> None:
        """``landing`` holds the record array as text, one document per file."""
        documents = self.spark.read.text(landing, wholetext=True)
        raw = array_position_seq(documents, "value", schemas.RAW_METRO_STATION)
        self._refresh_places("subway_location", raw, clean.clean_metro_station(raw, created))

    def _refresh_places(self, name: str, raw: DataFrame, rows: DataFrame) -> None:
        if raw.isEmpty():
            raise IncompleteLanding(f"nothing was landed for {name}")
        self._refresh(name, rows)

    def _refresh(self, name: str, rows: DataFrame) -> None:
        full_refresh(self._aligned(rows, name), self.path(name))

    # Models.

    def register_sources(self, prefix: str = "") -> dict[str, DataFrame]:
        """A temporary view over each loaded table under its raw-layer name, for SQL; returns them."""
        frames = {}
        for logical, physical in RAW_SOURCES.items():
            if not self._has(_SOURCE_TABLES[logical]):
                continue
            frames[physical] = self.read(_SOURCE_TABLES[logical])
            frames[physical].createOrReplaceTempView(prefix + physical)
        return frames

    def _has(self, name: str) -> bool:
        if name in COMMITTED:
            return self.table(name).exists()
        place, fs = place_of(self.spark, self.path(name))
        return fs.exists(place)

    def staged(self) -> dict[str, DataFrame]:
        return {
            "bike": staging.src_bike_usage(self.read("bike_usage")),
            "bike_locations": staging.src_bike_location(self.read("bike_location")),
            "bus": staging.src_bus_usage(self.read("bus_usage")),
            "bus_locations": staging.src_bus_stop_location(self.read("bus_stop_location")),
            "subway": staging.src_subway_usage(self.read("subway_usage")),
            "subway_locations": staging.src_subway_location(self.read("subway_location")),
        }

    def build_dim_date(self) -> None:
        src = self.staged()
        self._refresh("dim_date", dims.dim_date(src["bike"], src["bus"], src["subway"]))

    def build_dim_user(self) -> None:
        self._refresh("dim_user", dims.dim_user(self.staged()["bike"]))

    def build_dim_station(self, dedupe: bool = False) -> None:
        self._refresh("dim_station", dims.dim_station(**self.staged(), dedupe=dedupe))

    def build_dimensions(self, dedupe: bool = False) -> None:
        """All three dimensions; each usage table is read once, into the keys it contributes."""
        src = self.staged()

        def keys_of(kind: str) -> DataFrame:
            place = scratch_path(self.spark, f"{kind}-keys")
            dims.usage_keys(kind, src[kind]).write.parquet(place)
            return self.spark.read.parquet(place)

        with scratch_scope(self.spark):
            keys = together({kind: partial(keys_of, kind) for kind in dims.USAGE_SETS})
            locations = {name: rows for name, rows in src.items() if name.endswith("_locations")}
            made = dims.dimensions(keys, locations, dedupe)
            together({name: partial(self._refresh, name, rows) for name, rows in made.items()})

    def append_fact_bike_usage(self) -> str | None:
        rows = facts.fact_bike_usage(
            self.staged()["bike"], self.read("dim_date"), self.read("dim_station"), self.read("dim_user")
        )
        return self._append_fact("fact_bike_usage", rows)

    def append_fact_bus_usage(self) -> str | None:
        rows = facts.fact_bus_usage(
            self.staged()["bus"], self.read("dim_date"), self.read("dim_station")
        )
        return self._append_fact("fact_bus_usage", rows)

    def append_fact_subway_usage(self) -> str | None:
        rows = facts.fact_subway_usage(
            self.staged()["subway"], self.read("dim_date"), self.read("dim_station")
        )
        return self._append_fact("fact_subway_usage", rows)

    def append_facts(self) -> None:
        self.append_fact_bike_usage()
        self.append_fact_bus_usage()
        self.append_fact_subway_usage()

    def _append_fact(self, name: str, rows: DataFrame) -> str | None:
        """The mark is a literal on the stamp, so it travels below the joins into the usage scan."""
        return self.table(name).append_above_mark(self._aligned(rows, name))
