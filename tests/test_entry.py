"""Driver contract: entry runs at sf0.001, every key has a callable, oracles are SQL."""

import __spark_entry__ as E


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cnpj" in df.columns


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 45
    for k, sql in o.items():
        assert sql.strip().upper().startswith(("SELECT", "WITH")), k
