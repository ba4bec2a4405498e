import re

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "sampled", "complete"]
    assert {r.split for r in rows} <= {"train", "validation", "test"} and rows


def test_every_query_has_oracle_or_is_listed():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    # the corpus operators that SQL cannot express are tested against brute force
    assert all(re.match(r"op\d+_|pipeline$", k) for k in set(qs) - set(sql))


def test_queries_run_on_smoke_tables(spark):
    for name, fn in E.queries().items():
        if re.match(r"op\d+_|pipeline$", name):        # run by the tests of the corpus operators
            continue
        rows = fn(spark, "/root/testdata/sf0.001").collect()
        assert rows or name == "assemble_patch", name
