"""The append-only prediction ledger and immutable model bundles."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import LedgerError, PersistenceError
from .snapshot import exists, read_json, write_json


def current_view(ledger: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """The last prediction of each day and group, of one model version; which one must be said if there are several."""
    if version is None:
        found = [r[0] for r in ledger.select("model_version").distinct().limit(2).collect()]
        if len(found) > 1:
            raise LedgerError("the ledger holds several model versions; name one")
    else:
        ledger = ledger.where(F.col("model_version") == version)
    return latest(ledger, ["run_date", *keys, "model_version"], "scored_at")


def latest(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(F.col(by).desc())
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


class PredictionLedger:
    """Parquet at root/frame=<f>/scored_at=<t>; nothing written is ever changed."""

    def __init__(self, spark: SparkSession, root: str, frame: str, keys: Sequence[str]):
        self.spark, self.root, self.frame, self.keys = spark, root.rstrip("/"), frame, list(keys)

    @property
    def path(self) -> str:
        return f"{self.root}/frame={self.frame}"

    def append(self, predictions: DataFrame, version: str, scored_at: datetime) -> str:
        grain = ["run_date", *self.keys]
        if predictions.groupBy(*grain).count().where("count > 1").limit(1).count():
            raise LedgerError(f"predictions repeat on {grain}")
        at = scored_at.strftime("%Y%m%dT%H%M%S%f")
        out = f"{self.path}/scored_at={at}"
        predictions.withColumn("model_version", F.lit(version)).write.mode("error").parquet(out)
        return out

    def read_all(self) -> DataFrame:
        rows = self.spark.read.option("mergeSchema", "true").option("basePath", self.path).parquet(f"{self.path}/scored_at=*")
        return rows.withColumn("scored_at", F.col("scored_at").cast("string"))

    def current(self, version: str | None = None) -> DataFrame:
        return current_view(self.read_all(), self.keys, version)

    # The mark is a small file for each version.

    def _mark(self, version: str) -> str:
        return f"{self.root}/_watermark/{self.frame}-{version}.json"

    def watermark(self, version: str) -> date | None:
        if not exists(self.spark, self._mark(version)):
            return None
        return date.fromisoformat(read_json(self.spark, self._mark(version))["run_date"])

    def advance(self, version: str, day: date) -> None:
        old = self.watermark(version)
        if old is not None and day < old:
            raise LedgerError(f"the watermark of {version} is {old} and can't go back to {day}")
        write_json(self.spark, self._mark(version), {"run_date": day.isoformat()})


@dataclass
class ModelCard:
    """What a bundle declares: the features in order with their types, frozen levels, versions."""

    frame: str
    version: str
    target: str
    group_keys: list[str]
    feature_names: list[str]
    dtypes: dict[str, str]
    levels: dict[str, list[str]] = field(default_factory=dict)
    boosters: list[str] = field(default_factory=list)
    transform: str = "asinh"
    horizon: int = 1
    filter_tiers: bool = True

    @property
    def schema_hash(self) -> str:
        return schema_hash(self.feature_names, self.dtypes)


def schema_hash(names: Sequence[str], dtypes: dict[str, str]) -> str:
    return hashlib.sha256(json.dumps([[n, dtypes[n]] for n in names]).encode()).hexdigest()


def save_bundle(spark: SparkSession, path: str, boosters: dict[str, dict], card: ModelCard, margins: DataFrame | None = None) -> None:
    """Write a bundle where none is. The declared boosters are the given ones."""
    if exists(spark, f"{path}/card.json"):
        raise PersistenceError(f"{path} holds a bundle already")
    if set(boosters) != set(card.boosters):
        raise PersistenceError(f"the card declares {sorted(card.boosters)}, given are {sorted(boosters)}")
    for name, b in boosters.items():
        write_json(spark, f"{path}/booster_{name}.json", b)
    if margins is not None:
        margins.write.mode("error").parquet(f"{path}/margins.parquet")
    write_json(spark, f"{path}/card.json", asdict(card) | {"schema_hash": card.schema_hash})


def load_bundle(spark: SparkSession, path: str) -> tuple[ModelCard, dict[str, dict], DataFrame | None]:
    try:
        raw = read_json(spark, f"{path}/card.json")
        stated = raw.pop("schema_hash")
        card = ModelCard(**raw)
        if card.schema_hash != stated:
            raise PersistenceError("the card's features don't match its hash")
        boosters = {b: read_json(spark, f"{path}/booster_{b}.json") for b in card.boosters}
    except FileNotFoundError as e:
        raise PersistenceError(f"the bundle lacks {e}") from e
    margins = spark.read.parquet(f"{path}/margins.parquet") if exists(spark, f"{path}/margins.parquet") else None
    return card, boosters, margins
