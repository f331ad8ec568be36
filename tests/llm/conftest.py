import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture()
def docs(spark):
    """Build a small documents table: docs([(doc_id, text, lang, source), ...])."""
    def build(rows):
        rows = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return build
