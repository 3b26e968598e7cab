"""Reading CSV loses no value silently."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import types as T

from ledgerloom.operators.modelling import vif
from ledgerloom.operators.profile import correlation
from ledgerloom.sources import io

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.LongType()), T.StructField("x", T.DoubleType()),
                       T.StructField("s", T.StringType())])


def written(tmp_path, lines):
    path = tmp_path / "t.csv"
    path.write_text("\n".join(["s,x,extra,b,a", *lines]) + "\n")
    return f"file://{path}"


def test_csv_reads_what_pandas_writes(spark, tmp_path):
    path = written(tmp_path, ["u,1.5,9,365243.0,1.0", "NaN,NaN,9,9007199254740993,", ",1e3,9,1e3,-2", "NA,null,9,-5.000,None"])
    got = io.read_table(spark, path, "csv", SCHEMA).collect()
    assert [tuple(r) for r in got] == [(1, 365243, 1.5, "u"), (None, 9007199254740993, None, None), (-2, 1000, 1000.0, None), (None, -5, None, None)]
    assert io.rejected_cells(spark, path, SCHEMA).count() == 0


def test_csv_reports_bad_cells_and_columns(spark, tmp_path):
    path = written(tmp_path, ["u,1.5,9,1,oops", "u,one,9,1.5,1", "u,2,9,99999999999999999999,2147483648"])
    with pytest.raises(Exception, match="a: not a int: oops"):
        io.read_table(spark, path, "csv", SCHEMA).collect()
    assert io.read_table(spark, path, "csv", SCHEMA).select("s").count() == 3
    got = {r["column"]: (r.rejected, r.example) for r in io.rejected_cells(spark, path, SCHEMA).collect()}
    assert got == {"a": (2, "2147483648"), "b": (2, "1.5"), "x": (1, "one")}
    with pytest.raises(ValueError, match="no column missing"):
        io.read_table(spark, path, "csv", T.StructType([T.StructField("missing", T.StringType())]))


def test_csv_without_schema_has_no_nan(spark, tmp_path):
    got = io.read_table(spark, written(tmp_path, ["u,1.5,9,1,1", "NaN,NaN,9,2,2"]), "csv").select("s", "x").collect()
    assert [tuple(r) for r in got] == [("u", 1.5), (None, None)]


def test_wide_correlations_and_factors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(400, 5))
    x = np.column_stack([base @ rng.normal(size=5) + rng.normal(size=400) + 1e6 * (k % 3) for k in range(60)])
    frame = pd.DataFrame(x, columns=[f"f {k}" for k in range(60)])
    df = spark.createDataFrame(frame).repartition(5)
    got = vif(df, list(frame.columns), centred=True)
    r = np.linalg.inv(np.corrcoef(x.T))
    np.testing.assert_allclose([got[c] for c in frame.columns], np.diag(r), rtol=1e-5)
    frame = frame.mask(rng.random(frame.shape) < 0.2).assign(flat=3.3, none=np.nan)
    rows = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), ", ".join(f"`{c}` double" for c in frame.columns))
    want = frame.corr()
    pairs = correlation(rows, list(frame.columns)).collect()
    assert len(pairs) == 62 * 61 // 2
    for p in pairs:
        w = want.loc[p["row"], p["column"]]
        assert p["corr"] is None if np.isnan(w) else p["corr"] == pytest.approx(w, rel=1e-8, abs=1e-10)
