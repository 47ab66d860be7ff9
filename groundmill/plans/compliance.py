"""The parcel-compliance flow: predictions against parcels, exempt plots and categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundmill.functions.pixels import exclude_category, to_acres
from groundmill.operators.metrics import workflow_summary
from groundmill.operators.spatial import candidate_pairs, key_semi, spatial_anti, spatial_semi


def find_column(columns: list[str], *parts: str) -> str | None:
    """The first column whose lower-case name holds all parts."""
    return next((c for c in columns if all(p in c.lower() for p in parts)), None)


def parcel_compliance(pred: DataFrame, parcels: DataFrame, exempt: DataFrame, pred_id: str, parcel_id: str, exempt_id: str, area: Column, cell: float,
                      category: str | None = None, rs_no: str | None = None, dropped: str = "Land Acquisition") -> dict[str, DataFrame]:
    """The four results and their summary.

    r2: predictions with their parcels (unmatched ones kept) and the whole prediction's acres; r3: parcels with a
    prediction; r4: r2 off exempt plots and without the dropped category, null categories kept; r5: r3 likewise, if
    their RS number occurs in r4, null matching null.
    """
    category = category or find_column(parcels.columns, "category")
    rs_no = rs_no or find_column(parcels.columns, "rs", "no")
    pairs = candidate_pairs(pred, parcels, pred_id, parcel_id, cell).toDF("_p", "_q")
    right = parcels.drop("bbox", "ring").withColumnRenamed(parcel_id, "_q")
    r2 = pred.withColumn("acres", to_acres(area)).join(pairs.join(right, "_q"), F.col(pred_id) == F.col("_p"), "left").drop("_p").withColumnRenamed("_q", parcel_id)
    r3 = spatial_semi(parcels, pred, parcel_id, pred_id, cell)
    free = pred.join(spatial_anti(pred, exempt, pred_id, exempt_id, cell).select(pred_id), pred_id, "left_semi").select(pred_id)
    r4 = exclude_category(r2.join(free, pred_id, "left_semi"), category, dropped)
    r5 = key_semi(exclude_category(spatial_anti(r3, exempt, parcel_id, exempt_id, cell), category, dropped), r4, rs_no)
    out = {"r2": r2, "r3": r3, "r4": r4, "r5": r5}
    return {**out, "summary": workflow_summary(out)}
