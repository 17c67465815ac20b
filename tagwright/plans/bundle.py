"""Save and load a fitted plan or stack: models as Spark ML folders, the rest as tables.

Everything goes into a fresh folder. What is written last names that folder and
lists its files with their lengths and digests: a failure on the way leaves the
former bundle as it was, and a folder that is not what was written is refused.
All settings of the plan travel, so a changed or custom plan predicts the same
after loading.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, fields

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tagwright.operators.bundling import Bundles
from tagwright.operators.scaling import Scale, VectorScale
from tagwright.operators.tfidf import TfidfSettings, Vocabulary
from tagwright.plans.presets import PricePlan
from tagwright.plans.training import FittedFeatures, FittedPlan, Stack


#: what of a plan is not a plain value
_APART = ("tfidf", "members", "weights")


class BundleError(ValueError):
    """A saved folder is not what was written."""


def _files(spark: SparkSession, path: str) -> list[list]:
    """Name, length and digest of every file below a folder; tasks read them."""
    name = path.rsplit("/", 1)[-1] + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.substring_index("path", name, -1).alias("name"), "length", F.sha2("content", 256).alias("digest"))
    return sorted([r["name"], r["length"], r["digest"]] for r in found.collect())


def _finish(spark: SparkSession, root: str, version: str) -> None:
    about = json.dumps({"version": version, "files": _files(spark, f"{root}/{version}")})
    spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{root}/current")


def _opened(spark: SparkSession, root: str) -> str:
    """The folder of the current version, after a look at all its files."""
    root = root.rstrip("/")
    current = json.loads(spark.read.text(f"{root}/current").first()["value"])
    path = f"{root}/{current['version']}"
    if _files(spark, path) != current["files"]:
        raise BundleError(f"{path} is not what was saved: files are missing, added or changed")
    return path


def _save_models(models: dict, path: str) -> None:
    for name, model in models.items():
        PipelineModel([model]).write().overwrite().save(f"{path}/{name}")


def _load_models(names: list[str], path: str) -> dict:
    return {name: PipelineModel.load(f"{path}/{name}").stages[0] for name in names}


def _write_about(spark: SparkSession, about: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def save_stack(spark: SparkSession, stack: Stack, path: str) -> None:
    """Members, the model that blends them, and the predictions it learned from."""
    root, version = path.rstrip("/"), f"v-{uuid.uuid4().hex}"
    path = f"{root}/{version}"
    _save_models(stack.members, f"{path}/members")
    _save_models({"blender": stack.blender}, path)
    stack.out_of_fold.write.parquet(f"{path}/out_of_fold")
    _write_about(spark, {"members": list(stack.members)}, path)
    _finish(spark, root, version)


def load_stack(spark: SparkSession, path: str) -> Stack:
    path = _opened(spark, path)
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    return Stack(
        _load_models(about["members"], f"{path}/members"), _load_models(["blender"], path)["blender"],
        spark.read.parquet(f"{path}/out_of_fold"))


def save(spark: SparkSession, fitted: FittedPlan, path: str) -> None:
    f, root = fitted.features, path.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    path = f"{root}/{version}"
    f.vocabulary.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocabulary")
    dense = [(i, c, float(s.centre), float(s.width)) for i, (c, s) in enumerate(f.dense.items())]
    spark.createDataFrame(
        dense, "position int, column string, centre double, width double"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/dense_scales")
    centres = dict(f.sparse.centred)
    slots = [(i, float(w), centres.get(i)) for i, w in enumerate(f.sparse.widths)]
    spark.createDataFrame(slots, "idx int, width double, centre double").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/sparse_scales")
    about = {
        "plan": {n.name: getattr(fitted.plan, n.name) for n in fields(PricePlan) if n.name not in _APART},
        "plan_tfidf": asdict(fitted.plan.tfidf), "weights": fitted.plan.weights, "preset": f.preset, "rows": f.vocabulary.rows,
        "tfidf": {**asdict(f.vocabulary.settings), "stop_words": f.vocabulary.settings.stop_list}, "image": f.image, "models": list(fitted.models),
        "status": fitted.status, "best_params": fitted.best_params, "feature_names": f.names,
        "bundles": fitted.bundles and {n: getattr(fitted.bundles, n) for n in ("output", "alone", "bundles", "levels")},
    }
    _write_about(spark, about, path)
    _save_models(fitted.models, f"{path}/models")
    if fitted.bundles:
        fitted.bundles.stages.write().overwrite().save(f"{path}/bundles")
    _finish(spark, root, version)


def _tfidf(saved: dict) -> TfidfSettings:
    stop = saved["stop_words"]
    return TfidfSettings(**{
        **saved, "ngrams": tuple(saved["ngrams"]), "stop_words": None if stop is None else tuple(stop),
    })


def load(spark: SparkSession, path: str) -> FittedPlan:
    """The plan as saved; it has no member factories, its members are fitted."""
    path = _opened(spark, path)
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    settings = _tfidf(about["tfidf"])
    plan = PricePlan(
        **about["plan"], tfidf=_tfidf(about["plan_tfidf"]), members={},
        weights=[(least, weights) for least, weights in about["weights"]],
    )
    terms = spark.read.parquet(f"{path}/vocabulary").orderBy("idx").collect()
    vocabulary = Vocabulary(
        settings, tuple(r["term"] for r in terms), tuple(r["df"] for r in terms),
        tuple(r["idf"] for r in terms), about["rows"],
    )
    dense = spark.read.parquet(f"{path}/dense_scales").orderBy("position").collect()
    slots = spark.read.parquet(f"{path}/sparse_scales").orderBy("idx").collect()
    features = FittedFeatures(
        about["preset"], vocabulary,
        {r["column"]: Scale(r["centre"], r["width"]) for r in dense},
        VectorScale(
            len(slots), tuple(r["width"] for r in slots),
            tuple((r["idx"], r["centre"]) for r in slots if r["centre"] is not None),
        ),
        tuple(about["image"]) if about["image"] else None,
        about["bundles"] and Bundles(
            PipelineModel.load(f"{path}/bundles"), about["bundles"]["output"], tuple(about["bundles"]["alone"]),
            tuple(map(tuple, about["bundles"]["bundles"])), about["bundles"]["levels"]),
    )
    return FittedPlan(
        plan, features, _load_models(about["models"], f"{path}/models"),
        [tuple(s) for s in about["status"]], about["best_params"],
    )
