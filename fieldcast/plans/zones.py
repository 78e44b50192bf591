"""Agro-climatic zones: features, clustering, naming, export."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame

from fieldcast.operators.ml import build_ml_pipeline, map_zones, train_kmeans
from fieldcast.operators.rollup import extract_climate_features
from fieldcast.session import checkpoint
from fieldcast.sources.sinks import save_model, write_dataset

ZONE_COLUMNS = ("city_id", "state_id", "region_id", "cluster_id", "agro_climatic_zone",
                "recommended_crops", "kharif_temp", "rabi_temp", "zaid_temp",
                "annual_mean_temp", "kharif_rainfall", "rabi_rainfall", "annual_rainfall",
                "avg_humidity", "avg_cloud_cover")


def build_zones(daily: DataFrame, k: int = 8, seed: int = 42
                ) -> tuple[DataFrame, KMeansModel, PipelineModel]:
    """Zone of each city with the fitted models.

    The features (one row per city) are checkpointed, since scaling and the iterations of
    the clustering read them many times.
    """
    features = checkpoint(extract_climate_features(daily))
    scaled, pipeline = build_ml_pipeline(features)
    model, predicted = train_kmeans(scaled, k, seed)
    return map_zones(predicted).select(*ZONE_COLUMNS), model, pipeline


def run_zones(daily: DataFrame, out: str, k: int = 8, seed: int = 42) -> None:
    """Fit, then save the models and the zone table."""
    zones, model, pipeline = build_zones(daily, k, seed)
    save_model(model, f"{out}/models/zone_kmeans")
    save_model(pipeline, f"{out}/models/zone_pipeline")
    write_dataset(zones, f"{out}/agro_climatic_zones", coalesce_num=1)
