import subprocess
import sys

import __spark_entry__ as entry


def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["Location", "ts", "latitude", "longitude", "value"] and df.count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_does_not_need_the_optional_parts():
    code = "import sys; sys.modules['aeroquarry.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'superob_mean' in e.queries() and not any(q.startswith('op') for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True)
