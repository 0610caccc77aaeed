"""Named tables: namespaces, listings and the materialised star schema."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.plans import analytics, marts
from joulemart.plans.marts import Star
from joulemart.plans.staging import stage_certificates
from joulemart.sources.versions import Versions


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def replace_table(df: DataFrame, name: str) -> None:
    """Create the catalog entry, or replace its content and schema, in one step of the catalog.

    Rows are written to a new folder beside the namespace's tables; then the name, a view, is pointed at
    it. Until then, and if the write fails, readers get the old rows; who has them keeps them.
    """
    spark = df.sparkSession
    *namespace, table = name.split(".")
    home = spark.catalog.getDatabase(namespace[0] if namespace else spark.catalog.currentDatabase()).locationUri
    folder = f"{home}/{table}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    quoted = ".".join(f"`{part}`" for part in [*namespace, table])
    spark.sql(f"CREATE OR REPLACE VIEW {quoted} AS SELECT * FROM parquet.`{folder}`")


def list_tables(spark: SparkSession) -> DataFrame:
    """Every namespace's tables: ``(table_schema, table_name)``."""
    names = [
        (db.name, table.name)
        for db in spark.catalog.listDatabases()
        for table in spark.catalog.listTables(db.name)
        if not table.isTemporary
    ]
    return spark.createDataFrame(names, "table_schema string, table_name string")


def write_json_summary(summary: DataFrame, path: str) -> None:
    """A one-row result as one JSON file."""
    summary.coalesce(1).write.mode("overwrite").json(path)


@dataclass(frozen=True)
class Warehouse:
    """The star schema as Parquet tables below one root folder.

    Certificates are staged once; every other table is built from the staged
    table, so the text is parsed a single time however many reports follow.
    Tables are neither bucketed nor partitioned: one property may own a third
    of all certificates, and a fixed layout would pin those to one file group,
    whereas a shuffle join lets adaptive execution split them.

    A build writes new folders and commits them together at its end: readers see the tables of the
    last whole build, all of one version, and a build that fails leaves them as they are.
    """

    spark: SparkSession
    root: str
    version: int | None = None
    #: Folders written so far by the build that this is a view of.
    building: dict[str, str] | None = None

    def versions(self) -> Versions:
        return Versions(self.spark, self.root, self.version)

    def pinned(self) -> Warehouse:
        """A view of the tables as they are now, whatever is built later."""
        return replace(self, version=self.versions().latest())

    def table(self, name: str) -> DataFrame:
        if self.building is not None:
            return self.spark.read.parquet(f"{self.root}/{self.building[name]}")
        return self.versions().read(name)

    def _write(self, df: DataFrame, name: str) -> None:
        folder = self.versions().new_folder(name)
        df.write.parquet(f"{self.root}/{folder}")
        self.building[name] = folder

    def build(self, raw: DataFrame) -> Warehouse:
        """Write all tables, inputs before the tables that read them, and make them visible; see _write_tables."""
        draft = replace(self, building={})
        draft._write_tables(raw)
        self.versions().commit(draft.building)
        return self

    def _write_tables(self, raw: DataFrame) -> None:
        """Inputs before the tables that read them; what is independent, together."""
        self._write(stage_certificates(raw, ("walls_description",)), "stg_certificates")
        staged = self.table("stg_certificates")
        self._write_together({
            "dim_properties": lambda: marts.dim_properties(staged),
            "dim_locations": lambda: marts.dim_locations(staged),
            "fct_certificates": lambda: marts.certificate_facts(staged),
            "fct_property_energy_performance": lambda: marts.fct_energy_performance(staged),
        })
        # The improvable rows are read twice, for the score scale and for the scores.
        self._write_together({
            "fct_property_aggregations": lambda: marts.fct_property_aggregations(self.star()),
            "improvable": lambda: analytics.improvable(self.star()),
        })
        self._write(analytics.retrofit_priority(self.star(), self.table("improvable")), "v_retrofit_priority")

    def _write_together(self, tables: dict[str, Callable[[], DataFrame]]) -> None:
        """Write tables at the same time: Spark runs their jobs side by side where there is room."""
        with ThreadPoolExecutor(len(tables)) as pool:
            writes = [pool.submit(lambda n=name, b=build: self._write(b(), n)) for name, build in tables.items()]
        for write in writes:
            write.result()

    def star(self) -> Star:
        """All tables of one version."""
        if self.building is None and self.version is None:
            return self.pinned().star()
        return Star(
            self.table("stg_certificates"),
            self.table("fct_certificates"),
            self.table("dim_properties"),
            self.table("dim_locations"),
        )

    def views(self) -> dict[str, Callable[[Star], DataFrame]]:
        """Cheap analytics that stay views over the tables."""
        return {
            "v_construction_age_analysis": analytics.construction_age,
            "v_regional_energy_performance": analytics.regional_performance,
            "v_property_efficiency_gaps": analytics.efficiency_gaps,
        }

    TABLES = (
        "stg_certificates", "dim_properties", "dim_locations", "fct_certificates",
        "fct_property_energy_performance", "fct_property_aggregations", "v_retrofit_priority",
    )

    def register(self) -> None:
        """Make every table and view available to SQL by name."""
        for name in self.TABLES:
            df = marts.fct_certificates(self.table(name)) if name == "fct_certificates" else self.table(name)
            df.createOrReplaceTempView(name)
        star = self.star()
        for name, build in self.views().items():
            build(star).createOrReplaceTempView(name)

    def row_counts(self) -> DataFrame:
        counts = [
            self.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name in self.TABLES
        ]
        united = counts[0]
        for one in counts[1:]:
            united = united.unionByName(one)
        return united
