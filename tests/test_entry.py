import subprocess
import sys

import pytest

from workload.oracles import ORACLES
from workload.queries import REGISTRY


@pytest.mark.parametrize("absent", ["ahocorasick", "tallyframe.llm", "corpus_pipeline"])
def test_the_entry_does_without_what_only_training_data_needs(absent):
    """With a library or the package itself out of reach, all other queries are still there."""
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= len(REGISTRY) and int(out[1]) >= len(ORACLES)
    assert out[2] == "False" or absent not in ("tallyframe.llm", "corpus_pipeline")
