"""Publishing a model: readers get the old or the new one; a job that dies on the way changes nothing."""

import os
import threading

import pytest
from pyspark.ml.classification import LogisticRegression

import riskloom.sources.registry as registry
from riskloom.errors import ModelUnavailable
from riskloom.operators.features import SCALED, assembler, scaler
from riskloom.operators.models import pipeline_model


@pytest.fixture(scope="module")
def models(spark):
    rows = [(float(i % 10), float(i % 10 > 4)) for i in range(100)]
    asm = assembler(["x"])
    train = asm.transform(spark.createDataFrame(rows, "x double, label double"))
    scale = scaler().fit(train)
    scaled = scale.transform(train)
    return [pipeline_model([asm, scale, LogisticRegression(featuresCol=SCALED, labelCol="label", regParam=p).fit(scaled)]) for p in (0.1, 1.0, 5.0)]


def slope(model):
    return float(model.stages[2].coefficients[0])


def test_replacing(spark, models, tmp_dir):
    path = f"{tmp_dir}/model"
    for model in models:
        assert registry.save_pipeline(model, path) == path
        assert slope(registry.load_pipeline(path)) == slope(model)
    first = registry.current_version(spark, path)
    for _ in range(4):
        registry.save_pipeline(models[0], path)
    kept = os.listdir(f"{path}/versions")
    assert len(kept) <= registry.SPARE_VERSIONS + 2 and registry.current_version(spark, path).rpartition("/")[2] in kept
    assert not os.path.exists(first)  # versions that nobody can be reading any more are gone


def test_plainly_saved_models_load_too(spark, models, tmp_dir):
    models[0].write().save(f"{tmp_dir}/plain")
    assert slope(registry.load_pipeline(f"{tmp_dir}/plain")) == slope(models[0])


def test_a_crash_leaves_the_old_model(spark, models, tmp_dir, monkeypatch):
    path = registry.save_pipeline(models[0], f"{tmp_dir}/model")

    def crash(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(registry, "_point_to", crash)
    with pytest.raises(RuntimeError):
        registry.save_pipeline(models[1], path)
    assert slope(registry.load_pipeline(path)) == slope(models[0])
    monkeypatch.undo()
    registry.save_pipeline(models[2], path)
    assert slope(registry.load_pipeline(path)) == slope(models[2])


def test_a_crash_of_the_first_leaves_none(models, tmp_dir, monkeypatch):
    monkeypatch.setattr(registry, "_point_to", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        registry.save_pipeline(models[0], f"{tmp_dir}/model")
    with pytest.raises(ModelUnavailable):
        registry.load_pipeline(f"{tmp_dir}/model")


def test_reading_while_it_is_replaced(models, tmp_dir):
    path = registry.save_pipeline(models[0], f"{tmp_dir}/model")
    known, seen, stop = {slope(m) for m in models[:2]}, [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(slope(registry.load_pipeline(path)))

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(6):
        registry.save_pipeline(models[(i + 1) % 2], path)
    stop.set()
    reader.join()
    assert len(seen) >= 2 and set(seen) <= known
