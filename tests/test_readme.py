"""The README's example, as it stands."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from callpulse.operators import kpis
from callpulse.plans.queries import calls
from callpulse.streaming.jobs import stored_measures
from conftest import SMALL


def test_the_example_runs(spark, tmp_path, capsys):
    text = (Path(__file__).parent.parent / "README.md").read_text()
    (example,) = re.findall(r"```python\n(.*?)```", text, re.S)
    exec(example, {"tables": SMALL, "folder": str(tmp_path)})
    assert "services_name" in capsys.readouterr().out
    stored = stored_measures(spark, f"{tmp_path}/job")
    assert stored.agg(F.sum("calls")).first()[0] == calls(spark, SMALL).count()
    assert not kpis.figures_of(stored).isEmpty()
