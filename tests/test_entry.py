"""The contract without the operators for training data, and appends that are run again."""

import os
import subprocess
import sys

import pytest

from sensorlens.sources import files

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
sys.modules[{hidden!r}] = None
import __spark_entry__ as contract
names = contract.queries()
assert "series_avg" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
assert set(contract.oracle_sql()) <= set(names)
print("DONE")
"""


@pytest.mark.parametrize("hidden", ["sensorlens.llm", "corpus_pipeline", "public_tokenizers"])
def test_entry_without(hidden):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo, hidden=hidden)], capture_output=True, text=True, timeout=120
    )
    assert "DONE" in run.stdout, run.stderr[-2000:]


def test_appends_run_again(spark, folder):
    def rows(*values):
        return spark.createDataFrame([(v, v % 2) for v in values], "v int, part int")

    def stored():
        return sorted(r.v for r in spark.read.parquet(folder).collect())

    files.append_table(rows(1, 2, 3), folder, ["part"], batch=7)
    files.append_table(rows(4), folder, ["part"], batch="2024-01-01")
    for _ in range(2):
        files.append_table(rows(5, 7), folder, ["part"], batch=7)  # fewer folders than before
    assert stored() == [4, 5, 7]
    for bad in ("", "a/b", "..", " "):
        with pytest.raises(ValueError):
            files.append_table(rows(1), folder, batch=bad)
