"""panelwatch: panel analytics and model monitoring on Spark DataFrames.

Every operator takes a DataFrame plus a :class:`PanelSpec` (column roles) and
returns a DataFrame.  Work is expressed with Spark SQL, ``pyspark.ml`` and
Structured Streaming; Python only runs on small per-group result tables.
"""

from panelwatch.spec import PanelSpec, RegimeSpec

__all__ = ["PanelSpec", "RegimeSpec"]
