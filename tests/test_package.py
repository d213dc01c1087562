import json

import pytest
from pyspark.ml import Pipeline

from txguard.plans.training import preprocessing
from txguard.schema import FEATURES
from txguard.sources.package import load_package, save_package


@pytest.fixture(scope="module")
def fitted(spark):
    names = ", ".join(f"{n} {'string' if n == 'location' else 'double'}" for n in FEATURES)
    rows = spark.createDataFrame([tuple("US" if n == "location" else 1.0 for n in FEATURES)], names)
    return Pipeline(stages=preprocessing()).fit(rows), rows


def rewrite(path, **changes):
    (part,) = (path / "metadata").glob("part-*.json")
    row = {**json.loads(part.read_text()), **changes}
    for crc in (path / "metadata").glob(".part-*.crc"):
        crc.unlink()
    part.write_text(json.dumps({key: value for key, value in row.items() if value is not None}) + "\n")


def saved(spark, fitted, tmp_path):
    model, rows = fitted
    save_package(spark, str(tmp_path / "p"), model, 0.25, rows.schema)
    return tmp_path / "p"


def test_loads_what_was_saved(spark, fitted, tmp_path):
    package = load_package(spark, str(saved(spark, fitted, tmp_path)))
    assert package.threshold == 0.25
    assert [field["name"] for field in json.loads(package.feature_schema)["fields"]] == FEATURES
    assert package.model.transform(fitted[1]).count() == 1


def test_missing_directory(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_package(spark, str(tmp_path / "nothing"))


def test_not_a_package(spark, tmp_path):
    (tmp_path / "p").mkdir()
    with pytest.raises(ValueError, match="complete"):
        load_package(spark, str(tmp_path / "p"))


def test_no_model(spark, fitted, tmp_path):
    path = saved(spark, fitted, tmp_path)
    (path / "model").rename(tmp_path / "elsewhere")
    with pytest.raises(ValueError, match="no model"):
        load_package(spark, str(path))


def test_no_threshold(spark, fitted, tmp_path):
    path = saved(spark, fitted, tmp_path)
    rewrite(path, threshold=None)
    with pytest.raises(ValueError, match="no threshold"):
        load_package(spark, str(path))


def test_other_features(spark, fitted, tmp_path):
    path = saved(spark, fitted, tmp_path)
    rewrite(path, feature_columns=["amount"])
    with pytest.raises(ValueError, match="other features"):
        load_package(spark, str(path))


def test_version_defaults_to_unknown(spark, fitted, tmp_path):
    path = saved(spark, fitted, tmp_path)
    rewrite(path, feature_version=None)
    assert load_package(spark, str(path)).feature_version == "unknown"


def test_merchant_list_travels_with_the_model(spark, fitted, tmp_path):
    model, rows = fitted
    save_package(spark, str(tmp_path / "own"), model, 0.25, rows.schema, ["ShopX"])
    package = load_package(spark, str(tmp_path / "own"))
    assert package.high_risk == ("ShopX",)
    package.require_same_list(None)
    package.require_same_list(["ShopX"])
    with pytest.raises(ValueError):
        package.require_same_list(["QuickCash"])
    outputs = [field["name"] for field in json.loads(package.output_schema)["fields"]]
    assert outputs == ["fraud_probability", "prediction"]
