"""The datasets behind the two coverage maps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headway.operators.coverage import coverage_gaps, isolated_stops
from headway.operators.schedule import coverage_classes


def stop_sample(stops: DataFrame, *, top: int = 500) -> DataFrame:
    """The first stops from the south-west, drawn for context."""
    return (
        stops.select("stop_id", "stop_name", "stop_lat", "stop_lon")
        .orderBy("stop_lat", "stop_lon", "stop_id", "stop_name")
        .limit(top)
    )


def map_layers(stops: DataFrame) -> dict[str, DataFrame]:
    return {
        "gaps": coverage_gaps(stops),
        "isolated_stops": isolated_stops(stops),
        "stop_sample": stop_sample(stops),
        "coverage_cells": coverage_classes(stops),
    }


def write_map_layers(stops: DataFrame, folder: str, *, file_format: str = "json") -> None:
    for name, layer in map_layers(stops).items():
        layer.write.mode("overwrite").format(file_format).save(f"{folder}/{name}")
