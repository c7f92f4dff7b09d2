from __future__ import annotations

import pytest
from pyspark.sql import Row


@pytest.fixture
def documents(spark):
    """Makes a table like ``documents``, with columns whose names the operators
    use themselves."""

    def make(rows):
        full = [
            Row(
                doc_id=r[0],
                text=r[1],
                lang=r[2] if len(r) > 2 else "en",
                source=r[3] if len(r) > 3 else "s",
                n_chars=len(r[1]) if r[1] is not None else None,
                score="clash",
                start="clash",
                spans="clash",
                simhash="clash",
            )
            for r in rows
        ]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, score string, "
            "start string, spans string, simhash string"
        )
        return spark.createDataFrame(full, schema)

    return make
