"""Versioned model store.

Each save writes a new version folder ``v<time>-<id>`` holding the scalar
model as one JSON line and, when given, the MLlib pipeline.  A version is
complete once its ``model/_SUCCESS`` marker exists; loading takes the newest
complete version, so readers never see a half-written model and an old
version stays usable while a new one is written.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..model import MeterModel


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def save_model(spark: SparkSession, root: str, model: MeterModel,
               pipeline: PipelineModel | None = None) -> str:
    model.validate()
    version = f"{root.rstrip('/')}/v{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    if pipeline is not None:
        pipeline.write().save(f"{version}/pipeline")
    (spark.createDataFrame([(model.to_json(),)], "model string")
         .coalesce(1).write.mode("error").text(f"{version}/model"))
    return version


def list_versions(spark: SparkSession, root: str) -> list[str]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v"):
            marker = spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "model/_SUCCESS")
            if fs.exists(marker):
                out.append(st.getPath().toString())
    return sorted(out)


def promote(spark: SparkSession, root: str, version: str) -> int:
    """Makes a saved version the one that running streams use from their next batch on; returns the pointer's number.

    Pointers are numbered files, each written aside and renamed, so a reader
    sees one whole; going back is promoting an older version again.
    """
    name = version.rstrip("/").rpartition("/")[2]
    if name not in [v.rpartition("/")[2] for v in list_versions(spark, root)]:
        raise FileNotFoundError(f"no complete version {name} under {root}")
    folder = f"{root.rstrip('/')}/_current"
    number = max((n for n, _ in _pointers(spark, folder)), default=0) + 1
    fs, aside = _fs(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    try:
        out.write(name.encode())
    finally:
        out.close()
    if not fs.rename(aside, _fs(spark, f"{folder}/{number:012d}={name}")[1]):
        raise RuntimeError(f"pointer {number} of {root} is there already")
    return number


def _pointers(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(number, version); the version is part of the file's name, so a listing is all it takes."""
    fs, p = _fs(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted((int(n.partition("=")[0]), n.partition("=")[2]) for n in names if n[:1].isdigit())


def current_version(spark: SparkSession, root: str) -> str:
    """The promoted version's folder name, or the newest complete one where none was promoted."""
    pointers = _pointers(spark, f"{root.rstrip('/')}/_current")
    if pointers:
        return pointers[-1][1]
    versions = list_versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"no complete model under {root}")
    return versions[-1].rpartition("/")[2]


class CurrentModel:
    """The model in use, looked up again by each batch; a version is loaded once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.loaded = spark, root.rstrip("/"), {}

    def get(self) -> tuple[str, MeterModel]:
        version = current_version(self.spark, self.root)
        if version not in self.loaded:
            self.loaded = {version: load_model(self.spark, f"{self.root}/{version}")}
        return version, self.loaded[version]


def load_model(spark: SparkSession, root_or_version: str, with_pipeline: bool = False):
    """Newest complete version under a root (or the given version folder)."""
    path = root_or_version.rstrip("/")
    versions = list_versions(spark, path)
    version = versions[-1] if versions else path
    fs, mp = _fs(spark, f"{version}/model/_SUCCESS")
    if not fs.exists(mp):
        raise FileNotFoundError(f"no complete model under {root_or_version}")
    text = spark.read.text(f"{version}/model").first()[0]
    model = MeterModel.from_dict(json.loads(text))
    if not with_pipeline:
        return model
    pipe_path = f"{version}/pipeline"
    fs2, pp = _fs(spark, pipe_path)
    pipeline = PipelineModel.load(pipe_path) if fs2.exists(pp) else None
    if pipeline is not None and hasattr(pipeline.stages[-1], "clusterCenters"):
        k = len(pipeline.stages[-1].clusterCenters())
        if k != model.k:
            raise ValueError(f"pipeline has k={k}, scalar model k={model.k}")
        cols = tuple(pipeline.stages[0].getInputCols())
        if cols != model.features:
            raise ValueError(f"pipeline features {cols} differ from {model.features}")
    return model, pipeline
