"""Views that join what is stored apart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from punctual.operators.marts import enriched
from punctual.plans.datasets import route_hour_weather

VIEWS = {
    "silver_vehicle_positions_enriched": (enriched, ("silver_vehicle_positions", "dim_routes")),
    "gold_route_hour_weather": (route_hour_weather, ("gold_route_hour_performance", "silver_weather_hourly")),
}


def publish(lake) -> dict[str, DataFrame]:
    """Temporary views over the tables in force now; a view whose tables aren't there is left out."""
    done = {}
    for name, (make, needs) in VIEWS.items():
        if all(map(lake.exists, needs)):
            done[name] = make(*map(lake.read, needs))
            done[name].createOrReplaceTempView(name)
    return done
