"""The warehouse load, start to end."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh import schema
from saleswh.operators import buckets, files
from saleswh.operators.key_index import KeyIndex
from saleswh.operators.steps import run_steps
from saleswh.operators.tables import VersionedTable
from saleswh.plans import dims, fact, fx, quality, views
from saleswh.plans.star import Star
from saleswh.session import finer_shuffles, use_buckets, use_exact_decimals
from saleswh.sources import conform, generators
from saleswh.sources.bundle import Sources

#: Shuffle partitions a load begins with, for each bucket of the fact.
SHUFFLES_PER_BUCKET = 4

REFUSED = T.StructField("refused", T.BooleanType())


class StaleTableError(RuntimeError):
    pass


class Warehouse:
    """The tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        use_exact_decimals(spark)
        use_buckets(spark)
        self.root = root.rstrip("/")

        def table(name: str, columns: T.StructType, **options: str) -> VersionedTable:
            return VersionedTable(spark, f"{self.root}/{name}", columns, **options)

        self.dim_date = table("dim_date", schema.DIM_DATE)
        self.dim_time = table("dim_time", schema.DIM_TIME)
        self.dim_customer = table("dim_customer", schema.DIM_CUSTOMER, partition="bucket", surrogate="customer_sk")
        self.dim_product = table("dim_product", schema.DIM_PRODUCT, partition="bucket", surrogate="product_sk")
        self.dim_fx_rate = table("dim_fx_rate", schema.DIM_FX_RATE, partition="fx_year")
        self.fact = table(
            "fact_sales_item",
            schema.FACT_STORED,
            partition=schema.FACT_PARTITION,
            surrogate="sales_item_sk",
            key=fact.KEY,
        )
        self.refused = table("fact_refused", schema.FACT_REFUSED)
        self.hourly_sales = table("hourly_sales", schema.HOURLY_SALES, partition=schema.FACT_PARTITION)
        self._refresh_error: Exception | None = None
        self.tables = [
            self.dim_date,
            self.dim_time,
            self.dim_customer,
            self.dim_product,
            self.dim_fx_rate,
            self.fact,
            self.refused,
            self.hourly_sales,
        ]

    def create_tables(self) -> None:
        for table in self.tables:
            table.create_if_absent()

    def fill_calendar(self, as_of: date, years_back: int = 5, days_ahead: int = 365) -> None:
        days = generators.calendar(self.spark, F.lit(as_of), years_back, days_ahead)
        dims.add_missing(self.dim_date, days, "date_key")

    def fill_minutes(self) -> None:
        dims.add_missing(self.dim_time, generators.minutes(self.spark), "time_key")

    def create_schema(self, as_of: date, years_back: int = 5, days_ahead: int = 365) -> None:
        """Creates what is absent and fills the calendar and the day's minutes."""
        self.create_tables()
        self.fill_calendar(as_of, years_back, days_ahead)
        self.fill_minutes()

    def load_customers(self, sources: Sources, name_candidates: Sequence[str] = conform.CUSTOMER_NAME) -> None:
        dims.upsert_dimension(self.dim_customer, dims.customer_rows(sources.customers, name_candidates), "customer_id")

    def load_products(self, sources: Sources) -> None:
        dims.upsert_dimension(self.dim_product, dims.product_rows(sources.products), "product_id")

    def load_fx_rates(
        self,
        sources: Sources,
        loaded_at: datetime,
        run_date: date | None = None,
    ) -> None:
        """Rates for ``run_date`` alone, else for every order day."""
        rows = fx.fx_rate_rows(
            conform.orders(sources.orders),
            sources.fx_snapshot,
            sources.fx_provider,
            loaded_at,
            run_date,
        )
        fx.upsert_fx_rates(self.dim_fx_rate, rows)

    def load_fact(self, sources: Sources, loaded_at: datetime) -> tuple[int, list[int]]:
        """Checks and upserts the facts.

        The new rows are written once to the shared folder, sound and broken ones
        apart, and what they break is counted in that write. If any is broken, the
        broken rows go to the table of refused ones and the load is refused.
        Returns the change number of the fact before, and the days touched.
        """
        number = fact.buckets_for(self.fact, conform.order_items(sources.order_items))
        if number == 1:
            return self._load_fact(sources, loaded_at, number)
        with finer_shuffles(self.spark, SHUFFLES_PER_BUCKET * number):
            return self._load_fact(sources, loaded_at, number)

    def _load_fact(self, sources: Sources, loaded_at: datetime, number: int) -> tuple[int, list[int]]:
        rows = fact.fact_rows(
            conform.order_items(sources.order_items),
            conform.orders(sources.orders),
            self.dim_fx_rate.read(),
        )
        checked = quality.with_broken(rows, self.dim_date.read(), self.dim_time.read())
        path = files.scratch_path(self.spark, "staged")
        counts = Observation()
        observed = checked.observe(counts, *quality.broken_counts())
        refused = F.size("broken") > 0
        try:
            marked = observed.withColumn("refused", refused)
            if number > 1:
                buckets.write(marked, path, "refused", fact.KEY, number)
            else:
                marked.write.partitionBy("refused").option("compression", "zstd").parquet(path)
            if any(counts.get.values()):
                staged = self.spark.read.schema(T.StructType([*checked.schema, REFUSED])).parquet(path)
                moment = F.lit(loaded_at).cast("timestamp").alias("refused_at")
                self.refused.append(staged.filter("refused").select("*", moment))
            quality.refuse(counts.get)
            before = self.fact.change()
            with self._staged(path, T.StructType([*checked.schema, REFUSED]), number) as sound:
                return before, fact.upsert_fact(self.fact, sound.select(*rows.columns), loaded_at, number)
        finally:
            files.delete(self.spark, path)

    @contextmanager
    def _staged(self, path: str, columns: T.StructType, number: int) -> Iterator[DataFrame]:
        """The sound rows of a staged load, by bucket if there are several."""
        if number == 1:
            yield self.spark.read.schema(columns).parquet(path).filter("NOT refused")
            return
        sound = {"false": f"{path}/refused=false"} if files.exists(self.spark, f"{path}/refused=false") else {}
        with buckets.opened(self.spark, columns, path, "refused", fact.KEY, number, sound) as rows:
            yield rows

    def refresh_hourly_sales(self, changed: tuple[int, list[int]] | None = None) -> str:
        """Brings the hourly table up to date, as a whole unless ``changed`` is what ``load_fact`` returned.

        A failure is reported, not raised, and leaves the table behind the facts: ``current_hourly_sales``
        refuses it until the next refresh, which then does it all.
        """
        self._refresh_error = None
        try:
            fact.refresh_hourly(self.hourly_sales, self.fact, self.dim_date.read(), self.dim_time.read(), changed)
        except (PySparkException, Py4JJavaError) as error:
            self._refresh_error = error
            return f"hourly sales not refreshed: {error}"
        return "hourly sales refreshed"

    def current_hourly_sales(self) -> DataFrame:
        """The hourly table, if it stands for the facts as they are now; raises if it does not, as after a failed refresh."""
        if not fact.hourly_is_current(self.hourly_sales, self.fact):
            cause = f": {self._refresh_error}" if self._refresh_error else ""
            raise StaleTableError(f"hourly sales do not stand for the present facts{cause}") from self._refresh_error
        return self.hourly_sales.read()

    def star(self) -> Star:
        return Star(
            fact=self.fact.read(),
            dim_product=self.dim_product.read(),
            dim_customer=self.dim_customer.read(),
            dim_date=self.dim_date.read(),
            dim_time=self.dim_time.read(),
            dim_fx_rate=self.dim_fx_rate.read(),
        )

    def check(self, non_iso_max_share: float = quality.NON_ISO_MAX_SHARE) -> list[str]:
        """Runs the quality checks; returns the warnings, raises on any issue."""
        star = self.star()
        clean = views.clean_sales(star.fact, star.dim_product)
        return quality.verdict(
            quality.dq_checks(star.fact, star.dim_date, star.dim_time, clean, non_iso_max_share)
        )

    def run(
        self,
        sources: Sources,
        as_of: date,
        run_date: date | None = None,
        years_back: int = 5,
        days_ahead: int = 365,
        name_candidates: Sequence[str] = conform.CUSTOMER_NAME,
        loaded_at: datetime | None = None,
    ) -> list[str]:
        """Schema, dimensions, rates, facts, views, checks. Returns the messages.

        Steps begin as soon as those they need are done: calendar, minutes, both
        dimensions and the rates at once, then the facts, then the refresh, the
        views and the checks.
        """
        moment = loaded_at or datetime.now(timezone.utc)
        self.create_tables()
        dimensions = ["calendar", "minutes", "customers", "products"]
        changed: list[tuple[int, list[int]]] = []
        done = run_steps(
            self.spark,
            {
                "calendar": ([], lambda: self.fill_calendar(as_of, years_back, days_ahead)),
                "minutes": ([], self.fill_minutes),
                "customers": ([], lambda: self.load_customers(sources, name_candidates)),
                "products": ([], lambda: self.load_products(sources)),
                "rates": ([], lambda: self.load_fx_rates(sources, moment, run_date)),
                "fact": (["calendar", "minutes", "rates"], lambda: changed.append(self.load_fact(sources, moment))),
                "hourly": (["fact"], lambda: self.refresh_hourly_sales(changed[0])),
                "views": (["fact", *dimensions], self.register_views),
                "checks": (["fact", *dimensions], self.check),
            },
        )
        return [done["hourly"], *done["checks"]]

    def register_views(self) -> None:
        star = self.star()
        views.register_views(star.fact, star.dim_product)

    def remove_old_versions(self) -> None:
        """Deletes what no table consists of any more. Not while someone reads an earlier state."""
        for table in self.tables:
            table.remove_old_versions()
        state = self.fact.notes().get("index")
        if state:
            KeyIndex(self.spark, f"{self.fact.path}/key_index", fact.KEY).remove_unused(state)
