import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["Activity", "TotalTime", "Percentage"]


def test_every_value_key_has_oracle():
    from strider.plans.oracle import ORACLE
    from strider.plans.queries import QUERIES
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q) and set(ORACLE) <= set(o)
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"tree_metrics", "tree_depth_sweep", "bagged_trees", "isolation_forest",
                         "anomaly_by_feature", "kmeans_outliers", "next_location"}


def test_core_queries_without_a_module_of_the_training_operators():
    """In a process of its own, where the modules are not loaded yet."""
    import subprocess
    import sys
    from pathlib import Path
    code = ("import sys; sys.modules['tiktoken'] = None; import __spark_entry__ as e; "
            "q, o = e.queries(), e.oracle_sql(); print('clean_motion' in q, 'clean_motion' in o, 'op8_packing' in q)")
    root = Path(entry.__file__).parent
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120, check=True)
    assert out.stdout.split() == ["True", "True", "False"]
