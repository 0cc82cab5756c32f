"""chronoreg: keep bitemporal registers in step with full snapshots, on Spark.

Layout:
    model       fixed values, column names, schemas, run parameters
    functions   column expressions (open rows, second arithmetic, rounding)
    sources     snapshot/state readers and the inputs derived from the test tables
    operators   select, diff, apply, report, checks
    plans       a whole run, the versioned publish, registered queries and their oracle SQL
"""

from chronoreg.model import DWELLINGS, RunParams, Spec

__all__ = ["DWELLINGS", "RunParams", "Spec"]
