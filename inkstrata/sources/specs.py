"""Datasets named by short specifications."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.operators.cleaning import require_field
from inkstrata.sources.tables import read_table


@dataclass(frozen=True)
class DatasetSpec:
    """``name:split:field`` or ``name:config:split:field``."""

    name: str
    split: str
    text_field: str
    config: str | None = None

    @classmethod
    def parse(cls, text: str) -> DatasetSpec:
        parts = text.split(":")
        if len(parts) not in (3, 4):
            raise ValueError(f"'{text}' is neither name:split:field nor name:config:split:field")
        name, *config, split, field = parts
        return cls(name, split, field, config[0] if config else None)

    @property
    def directory(self) -> str:
        flat = self.name.replace("/", "_")
        return f"{flat}__{self.config}" if self.config else flat


def read_dataset(
    spark: SparkSession, spec: DatasetSpec, root: str, layout: str = "{root}/{directory}/{split}"
) -> DataFrame:
    """Scan of one dataset: ``dataset, split, text`` and the license if there is one.

    ``layout`` says where a dataset lies; its fields are ``root``, ``name``,
    ``directory``, ``config`` and ``split``.
    """
    path = layout.format(
        root=root, name=spec.name, directory=spec.directory, config=spec.config or "", split=spec.split
    )
    raw = read_table(spark, path)
    require_field(raw, spec.text_field)
    carried = [F.col("license").cast("string").alias("license")] if "license" in raw.columns else []
    return raw.select(
        F.lit(spec.directory).alias("dataset"),
        F.lit(spec.split).alias("split"),
        *[c for c in raw.columns if c not in ("dataset", "split", "license", spec.text_field, "text")],
        F.col(spec.text_field).cast("string").alias("text"),
        *carried,
    )


def read_datasets(
    spark: SparkSession,
    specs: Sequence[str],
    root: str,
    layout: str = "{root}/{directory}/{split}",
    skip_failed: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Union of several datasets, and a table of those that could not be read."""
    scans: list[DataFrame] = []
    failed: list[tuple[str, str]] = []
    for text in specs:
        spec = DatasetSpec.parse(text)
        try:
            scans.append(read_dataset(spark, spec, root, layout))
        except (AnalysisException, KeyError) as error:
            if not skip_failed:
                raise
            failed.append((text, type(error).__name__))
    if not scans:
        raise ValueError("none of the datasets could be read")
    union = scans[0]
    for scan in scans[1:]:
        union = union.unionByName(scan, allowMissingColumns=True)
    return union, spark.createDataFrame(failed, "spec string, error string")
