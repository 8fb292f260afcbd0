"""One batch run over landed messages, the counterpart of a poll."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headway.sources.tables import Layers
from headway.streaming.medallion import MedallionWriter


def load_messages(messages: DataFrame, layers: Layers, *, agency_id: str, batch_id: int, as_of=None,
                  refresh_gold: bool = True) -> DataFrame:
    """Bronze, alerts, silver and gold for one set of messages; returns the layer metrics."""
    layers.init()
    MedallionWriter(layers, agency_id=agency_id, as_of=as_of, gold_every=batch_id + 2)(messages, batch_id)
    if refresh_gold:
        layers.refresh_hourly(batch_id)
        layers.refresh_route_performance(batch_id)
    return layers.metrics()
