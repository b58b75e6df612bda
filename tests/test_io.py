"""Sources and sinks: the reference's own tests (CSV load, missing file) and round trips."""
import pytest
from pyspark.sql import functions as F

from strata.sources import Stages, latest_model, load_latest_model, save_model_version, scan_csv, sink_csv
from strata.sources.registry import read_index


def test_csv_load_two_rows_with_country_name(spark, tmp_shared):
    df = spark.createDataFrame([("Brazil", "BRA", 2020, 3.2), ("Brazil", "BRA", 2021, 8.3)],
                               "country_name string, country_id string, year int, `Inflation (CPI %)` double")
    sink_csv(df, tmp_shared)
    back = scan_csv(spark, tmp_shared, infer=True)
    assert back.count() == 2 and "country_name" in back.columns
    assert dict(back.dtypes)["Inflation (CPI %)"] == "double"


def test_csv_missing_file_raises(spark):
    with pytest.raises(FileNotFoundError):
        scan_csv(spark, "/nonexistent/strata/data.csv")


def test_csv_na_tokens_become_null(spark, tmp_shared):
    df = spark.createDataFrame([("a", "NA"), ("b", "n/a"), ("c", "1.5"), ("d", "null")], "k string, v string")
    sink_csv(df, tmp_shared)
    back = scan_csv(spark, tmp_shared, schema="k string, v double").orderBy("k").collect()
    assert [r["v"] for r in back] == [None, None, 1.5, None]


def test_stages_round_trip(spark, tmp_shared):
    st = Stages(tmp_shared)
    df = spark.range(5).withColumn("y", F.col("id") * 2)
    st.write("processed", df)
    assert st.read(spark, "processed").count() == 5
    with pytest.raises(KeyError):
        st.path("nope")


def test_model_versions_and_latest(spark, tmp_shared):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer
    df = spark.range(3)
    m = Pipeline(stages=[SQLTransformer(statement="SELECT *, id * 2 AS prediction FROM __THIS__")]).fit(df)
    v1, _ = save_model_version(spark, m, tmp_shared, "rule")
    v2, p2 = save_model_version(spark, m, tmp_shared, "rule")
    assert (v1, v2) == (1, 2)
    top = latest_model(read_index(spark, tmp_shared)).first()
    assert top["version"] == 2 and top["path"] == p2
    assert load_latest_model(spark, tmp_shared, "rule").transform(df).count() == 3


def test_page_orders_by_id(spark):
    from strata.sources.records import page
    df = spark.createDataFrame([(i, f"c{i}") for i in (5, 3, 9, 1)], "id long, client_id string")
    assert [r["id"] for r in page(df, skip=1, limit=2).collect()] == [3, 5]


def test_validate_columns_and_processed(spark, tmp_shared):
    from strata.operators.profile import validate_columns, validate_processed
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert validate_columns(df, ["a", "c"]).missing == ["c"]
    assert validate_columns(df, ["a"]).ok
    df.write.parquet(tmp_shared)
    assert validate_processed(spark, tmp_shared, "a") and not validate_processed(spark, tmp_shared, "z")
    assert not validate_processed(spark, tmp_shared + "-missing", "a")


def test_csv_dialect_of_pandas(spark, tmp_path):
    """Doubled quotes, commas, line feeds in quotes and outer spaces, as pandas writes them."""
    import pandas as pd
    rows = pd.DataFrame({"k": [1, 2, 3, 4], "t": ['a "q" b, c', "x\ny", " lead and trail ", "back\\slash"]})
    rows.to_csv(tmp_path / "f.csv", index=False)
    back = scan_csv(spark, f"file://{tmp_path}/f.csv", schema="k int, t string").orderBy("k").collect()
    assert [r.t for r in back] == rows["t"].tolist()
    sink_csv(spark.createDataFrame(rows), f"file://{tmp_path}/out")
    again = scan_csv(spark, f"file://{tmp_path}/out", schema="k int, t string").orderBy("k").collect()
    assert [r.t for r in again] == rows["t"].tolist()


def test_registry_never_overwrites_a_version(spark, tmp_shared):
    """A lost index doesn't make the next save overwrite a stored version."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f")]).fit(spark.createDataFrame([(1.0,)], "x double"))
    save_model_version(spark, model, tmp_shared, "m")
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_shared}/_index")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    assert save_model_version(spark, model, tmp_shared, "m")[0] == 2
