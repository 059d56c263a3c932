"""The ride-event archive: day and city partitions, one schema evolution step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.schemas import RIDE_EVENT_V1
from fareflow.sources.versions import VersionedTable

PARTITION = ("event_day", "city_id")
PROMO = T.StructField("promo_code", T.StringType())
LAKE_V1 = T.StructType(
    [
        *RIDE_EVENT_V1.fields,
        T.StructField("is_synthetic", T.BooleanType()),
        T.StructField("event_day", T.DateType()),
    ]
)


class Lake(VersionedTable):
    """Version-1 columns until the first version-2 event arrives, then ``promo_code`` as well."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        super().__init__(spark, root, LAKE_V1, PARTITION)

    @staticmethod
    def should_evolve(events: DataFrame, schema: T.StructType) -> bool:
        if PROMO.name in schema.names:
            return False
        return not events.where(F.col("payload_version") >= 2).isEmpty()

    def append(self, events: DataFrame, batch: str) -> int | None:
        """Archive a batch of ride events as a new snapshot; a batch already there is skipped."""
        if self.is_committed(batch):
            return None
        _, schema = self.state()
        if self.should_evolve(events, schema):
            schema = T.StructType([*schema.fields, PROMO])
        rows = events.withColumns(
            {"is_synthetic": F.lit(True), "event_day": F.to_date("event_ts")}
        )
        return self._commit(self._write(rows.select(*schema.names), batch), schema)
