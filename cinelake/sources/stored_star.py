"""The star's tables as stored files or session tables, under any accepted name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from cinelake.sources.readers import read_json_array, read_table, resolve_table
from cinelake.sources.schemas import SCHEMAS, TABLE_NAMES


class StoredStar:
    """Tables from a directory of Parquet, CSV or JSON files, or from the session catalog
    when no directory is given. JSON files hold a record per line, but for the roles in
    ``array_roles``, whose files hold one array each (for dimensions: one task reads a file)."""

    def __init__(self, spark: SparkSession, directory: str | None = None, array_roles: frozenset[str] = frozenset()):
        self.spark = spark
        self.directory = directory
        self.array_roles = array_roles

    def table(self, role: str) -> DataFrame:
        names = TABLE_NAMES[role]
        if self.directory is None:
            return resolve_table(self.spark, names)
        for name in names:
            for extension in (".parquet", ".csv", ".json"):
                try:
                    return self._read(f"{self.directory}/{name}{extension}", SCHEMAS.get(role), role in self.array_roles)
                except AnalysisException:
                    continue
        raise LookupError(f"no file for {role} in {self.directory}: " + ", ".join(names))

    def _read(self, path: str, schema: str | None, array: bool) -> DataFrame:
        if path.endswith(".json") and array:
            if schema is None:
                return self.spark.read.option("multiLine", True).json(path)
            return read_json_array(self.spark, path, schema)
        return read_table(self.spark, path, schema)

    def customer(self) -> DataFrame:
        return self.table("customer")

    def content(self) -> DataFrame:
        return self.table("content")

    def geography(self) -> DataFrame:
        return self.table("geography")

    def category(self) -> DataFrame:
        return self.table("category")

    def content_category(self) -> DataFrame:
        return self.table("content_category")

    def provider(self) -> DataFrame:
        return self.table("provider")

    def plan(self) -> DataFrame:
        return self.table("plan")

    def event(self) -> DataFrame:
        return self.table("event")

    def payment(self) -> DataFrame:
        return self.table("payment")

    def subscription(self) -> DataFrame:
        return self.table("subscription")

    def availability(self) -> DataFrame:
        return self.table("availability")

    def date(self) -> DataFrame:
        return self.table("date")

    def language(self) -> DataFrame:
        return self.table("language")

    def payment_method(self) -> DataFrame:
        return self.table("payment_method")

    def talent(self) -> DataFrame:
        return self.table("talent")

    def content_talent(self) -> DataFrame:
        return self.table("content_talent")

    # the narrower views of the events that single plans read
    def content_event(self) -> DataFrame:
        return self.event()

    def activity(self) -> DataFrame:
        return self.event()

    def viewing(self) -> DataFrame:
        return self.event()

    def catalog_documents(self) -> DataFrame:
        return self.table("catalog")
