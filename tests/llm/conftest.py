import itertools

import pytest


@pytest.fixture
def recut(spark, monkeypatch):
    """From now on Spark cuts the files of each scan in another way after every pinned table of the given modules."""
    from civitas.llm import common
    sizes, keys = itertools.cycle(("1k", "128m", "3k", "9k")), ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def pin(df, name):
        out = common_pin(df, name)
        spark.conf.set(keys[0], next(sizes))
        spark.conf.set(keys[1], "1")
        return out

    common_pin = common.pin
    yield lambda *modules: [monkeypatch.setattr(m, "pin", pin) for m in modules]
    for k in keys:
        spark.conf.unset(k)
