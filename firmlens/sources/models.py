"""Saving and loading fitted models.

Spark's own models keep Spark's format. The ensembles that Spark has none of are written as Parquet
tables and a description; their parts that are Spark models are saved below them.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import SparkSession, functions as F

from firmlens.operators.ensembles import StackingModel, Trees, WeightedMembers
from firmlens.operators.growing import PIECES, Tails, Trees as GrownTrees
from firmlens.operators.grown import FarForest, GrownModel
from firmlens.operators.margins import Lift, MarginModel
from firmlens.operators.models import HighestOutput, Neighbours, NeighboursModel

# Arrays of the upper nodes of a forest.
_UPPER = {"feature": np.int16, "cut": float, "left": np.int32, "gap_left": bool, "value": float, "size": float, "gain": float, "owner": np.int32, "depth": np.int16}


def save_model(model: Model, path: str) -> None:
    spark = SparkSession.getActiveSession()

    def describe(**what) -> None:
        spark.createDataFrame([(json.dumps(what),)], "description string").coalesce(1).write.mode("overwrite").parquet(f"{path}/firmlens")

    if isinstance(model, WeightedMembers):
        if model.trees is None:
            for i, member in enumerate(model.members):
                save_model(member, f"{path}/member{i}")
        else:
            nodes = spark.createDataFrame([(i, *map(float, n)) for i, n in enumerate(model.trees.nodes)], "id long, " + ", ".join(f"{c} double" for c in Trees.COLUMNS))
            nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        starts = model.trees.starts if model.trees else None
        describe(kind="members", votes=model.votes, classes=model.classes, mean=model.mean, starts=starts, n=len(model.members))
    elif isinstance(model, GrownModel):
        nodes = [
            pa.table({
                "group": np.full(len(t.feature), g, np.int32), "id": np.arange(len(t.feature), dtype=np.int32), "feature": t.feature.astype(np.int32), "cut": t.cut,
                "left": t.left, "gap_left": t.gap_left, "value": pa.array(list(t.value)), "gain": t.gain, "owner": t.owner,
            })
            for g, t in enumerate(model.trees)
        ]
        spark.createDataFrame(pa.concat_tables(nodes)).write.mode("overwrite").parquet(f"{path}/nodes")
        outputs = [o.tolist() for o in model.outputs]
        describe(kind="grown", outputs=outputs, base=model.base.tolist(), classes=model.classes, link=model.link, n_columns=model.n_columns)
    elif isinstance(model, FarForest):
        model.tails.pieces.write.mode("overwrite").parquet(f"{path}/pieces")
        upper = {n: getattr(model.upper, n).tolist() for n in _UPPER}
        describe(
            kind="far", upper=upper, places=model.tails.places.tolist(), part=model.tails.part.tolist(), edges=[e.tolist() for e in model.edges],
            random_cuts=model.random_cuts, classes=model.classes, scale=list(model.scale), n_rows=model.n_rows, hard=model.hard,
        )
    elif isinstance(model, MarginModel):
        parts = {"mean": model.lift.mean, "spread": model.lift.spread, "landmarks": model.lift.landmarks, "root": model.lift.root, "weights": model.weights}
        arrays = {n: a.tolist() for n, a in parts.items() if a is not None}
        describe(kind="margins", arrays=arrays, gamma=model.lift.gamma, classes=model.classes, gap=model.gap, rounds=model.rounds)
    elif isinstance(model, StackingModel):
        for i, member in enumerate([*model.level0.values(), model.level1]):
            save_model(member, f"{path}/level{i}")
        describe(kind="stacking", names=list(model.level0), classes=model.classes)
    elif isinstance(model, HighestOutput):
        for i, member in enumerate(model.fits):
            save_model(member, f"{path}/fit{i}")
        describe(kind="highest", classes=model.classes)
    elif isinstance(model, NeighboursModel):
        model.train.write.mode("overwrite").parquet(f"{path}/train")
        describe(kind="neighbours", task=model.spec.task, k=model.spec.k, weights=model.spec.weights, key=model.spec.key)
    elif isinstance(model, PipelineModel) and any(type(s).__module__.startswith("firmlens.operators") and not hasattr(s, "write") for s in model.stages):
        for i, stage in enumerate(model.stages):
            save_model(stage, f"{path}/stage{i}")
        describe(kind="pipeline", n=len(model.stages))
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> Model:
    spark = SparkSession.getActiveSession()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/firmlens")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return DefaultParamsReader.loadParamsInstance(path, spark)
    what = json.loads(spark.read.parquet(f"{path}/firmlens").first()[0])
    if what["kind"] == "members":
        if what["starts"] is None:
            return WeightedMembers([load_model(f"{path}/member{i}") for i in range(what["n"])], what["votes"], what["classes"], what["mean"])
        rows = spark.read.parquet(f"{path}/nodes").orderBy("id").select(*(F.col(c) for c in Trees.COLUMNS)).collect()
        return WeightedMembers([], what["votes"], what["classes"], what["mean"], Trees(np.array(rows, float).reshape(-1, 5), what["starts"]))
    if what["kind"] == "grown":
        outputs = [np.array(o, int) for o in what["outputs"]]
        trees = [GrownTrees(len(o), 1) for o in outputs]
        found = spark.read.parquet(f"{path}/nodes").orderBy("group", "id").toArrow()
        group = found.column("group").to_numpy()
        for g, t in enumerate(trees):
            part = found.slice(int(np.searchsorted(group, g)), int((group == g).sum()))
            kinds = {"feature": np.int16, "cut": float, "left": np.int32, "gap_left": bool, "gain": float, "owner": np.int32}
            for name, kind in kinds.items():
                setattr(t, name, np.array(part.column(name).to_pylist(), kind))
            t.value = np.array(part.column("value").to_pylist(), float)
        return GrownModel(trees, outputs, what["base"], what["classes"], what["link"], what["n_columns"])
    if what["kind"] == "far":
        upper = GrownTrees(what["upper"]["owner"].count(0) and max(what["upper"]["owner"]) + 1, 1)
        for name, kind in _UPPER.items():
            setattr(upper, name, np.array(what["upper"][name], kind))
        tails = Tails(np.array(what["places"], int), np.array(what["part"], int), spark.read.schema(PIECES).parquet(f"{path}/pieces"))
        edges = [np.array(e, float) for e in what["edges"]]
        return FarForest(upper, tails, edges, what["random_cuts"], what["classes"], tuple(what["scale"]), what["n_rows"], what.get("hard", False))
    if what["kind"] == "margins":
        a = {n: np.array(v, float) for n, v in what["arrays"].items()}
        lift = Lift(a["mean"], a["spread"], a.get("landmarks"), a.get("root"), what["gamma"])
        return MarginModel(lift, a["weights"], what["classes"], what["gap"], what["rounds"])
    if what["kind"] == "stacking":
        parts = [load_model(f"{path}/level{i}") for i in range(len(what["names"]) + 1)]
        return StackingModel(dict(zip(what["names"], parts[:-1], strict=True)), parts[-1], what["classes"])
    if what["kind"] == "highest":
        return HighestOutput(what["classes"], [load_model(f"{path}/fit{i}") for i in range(len(what["classes"]))])
    if what["kind"] == "neighbours":
        spec = Neighbours(what["task"], what["k"], what["weights"], what["key"])
        return NeighboursModel(spec, spark.read.parquet(f"{path}/train"))
    return PipelineModel([load_model(f"{path}/stage{i}") for i in range(what["n"])])
