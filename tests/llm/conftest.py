import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def frame(spark):
    """``frame(rows)``: a documents table of (doc_id, text[, lang]) rows with extra, clashing columns."""
    def make(rows):
        rows = [(*r, None)[:3] if len(r) < 3 else r for r in rows]
        rows = [(i, t, q, "src", None if t is None else len(t), "x", 1, 2, 3, "y", 4, 5, "r", 6) for i, t, q in rows]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, "
                  "row int, shard int, rank int, h string, length int, "
                  "id int, runs string, text_hash int")
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
