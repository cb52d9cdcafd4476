"""The measures the warehouse needs on top of the cleaned columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.functions import measures as m


def add_measures(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns(
        {
            "OcupPasajeros": m.passenger_load(c("Passengers"), c("Seats")),
            "OcupCarga": m.freight_load(c("Freight"), c("Payload")),
            "DemoraPista": m.runway_delay(c("RampTime"), c("AirTime")),
            "Estacion": m.season(c("Month")),
        }
    )
