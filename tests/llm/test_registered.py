"""Every operator and the pipeline are registered, so that no import fault hides them."""

import __spark_entry__
from tessella.llm import queries


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())
