"""Queries leave the session as it was."""

from __future__ import annotations

import pytest

from aerolog.llm import queries
from __spark_entry__ import queries as registered

SF = "/root/testdata/sf0.001"


def settings(spark):
    return {name: value for name, value in spark.conf.getAll.items()}


@pytest.mark.parametrize("name", [*queries.registered(), "pipeline"])
def test_no_setting_is_left_changed(spark, name):
    before = settings(spark)
    registered()[name](spark, SF).write.format("noop").mode("overwrite").save()
    assert settings(spark) == before
