import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

DOCUMENTS = "doc_id long, text string"


@pytest.fixture
def frame(spark):
    """Rows as a DataFrame over several partitions."""

    def make(rows, schema=DOCUMENTS, partitions=3):
        return spark.createDataFrame(list(rows), schema).repartition(partitions)

    return make
