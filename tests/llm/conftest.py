from __future__ import annotations

import pytest

from tidemark.llm.workers import let_workers_import

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size int, digest string"


@pytest.fixture(autouse=True)
def workers(spark):
    let_workers_import(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with three more columns whose names the operators use themselves."""

    def make(rows):
        full = [(i, t, "en", "src0", len(t or ""), False, 7, "x") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


def runs_python(df) -> bool:
    """Whether the plan of a frame sends rows to Python."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return any(node in plan for node in ("EvalPython", "MapIn", "FlatMapGroups", "FlatMapCoGroups"))
