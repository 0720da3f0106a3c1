import importlib.util
import os

from helpers import ROOT


def _entry():
    spec = importlib.util.spec_from_file_location("se", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    se = _entry()
    rows = se.entry(spark).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["total"] == r["tp"] + r["fp"] + r["fn"] + r["tn"]
    # 1000 splits x ceil(0.1 * n) test rows
    assert r["total"] % 1000 == 0


def test_contract_keys():
    se = _entry()
    q, s = se.queries(), se.oracle_sql()
    assert set(s) <= set(q)
    assert "eval_shuffle_cv" in s


def test_imports_from_zipped_pyspark_without_session(tmp_path):
    """As under spark-submit: PySpark comes from pyspark.zip, no session exists,
    and neither the import nor queries()/oracle_sql() may start a JVM."""
    import glob
    import subprocess
    import sys

    import pyspark

    home = os.path.dirname(pyspark.__file__)
    zips = glob.glob(os.path.join(home, "python", "lib", "*.zip"))
    code = ("import sys; sys.path[:0] = %r; import pyspark, __spark_entry__ as e;"
            "assert 'pyspark.zip' in pyspark.__file__, pyspark.__file__;"
            "from pyspark import SparkContext;"
            "q, s = e.queries(), e.oracle_sql();"
            "assert SparkContext._gateway is None and set(s) <= set(q);"
            "print(len(q), len(s))") % ([ROOT, *zips],)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path,
                         env={**os.environ, "SPARK_HOME": home}, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
