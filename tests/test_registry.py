"""Registry hygiene: names, oracles, docs, bench set."""

import re

from __spark_entry__ import oracle_sql, queries


def test_every_oracle_has_a_query_and_names_are_clean():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own <= set(o)  # every query on the library's own operators has an oracle
    assert not [n for n in own if "pipeline" in n]


def test_every_query_is_documented():
    assert not [n for n, fn in queries().items() if not (fn.__doc__ or "").strip()]


def test_bench_headline_queries_exist():
    import bench

    assert set(bench.HEADLINE) <= set(queries())
