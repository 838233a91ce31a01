"""End-to-end run: landed files -> clean -> transform -> merge -> warehouse
-> RFM -> tiers -> report tables, every output written as a table/folder.

This is the batch run a user schedules; each step is the library operator
used by the checked queries, so the run is one lazy plan per output with
stage tables where a step makes several passes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..operators import cluster as CU
from ..operators import features as FE
from ..operators import merge as MG
from ..operators import reports as RP
from ..operators import rfm as R
from ..operators import transform as TR
from ..operators import warehouse as WH
from ..session import materialize
from ..sources import files as FS
from ..sources.registry import SOURCES


#: The scaled features, written beside the customer they belong to.
SCALED = ("R_scaled", "F_scaled", "M_scaled")


@dataclass
class PipelineResult:
    audit: DataFrame
    merged: DataFrame
    warehouse: WH.Warehouse
    rfm: DataFrame
    labeled: DataFrame
    outputs: dict[str, str]


def run_pipeline(spark: SparkSession, specs=SOURCES, out_dir: str | None = None, k: int = 2,
                 n_init: int = 10, tiers=CU.DEFAULT_TIERS) -> PipelineResult:
    """Run the whole batch flow over the landed sources in ``specs``."""
    present = {s.name: (s, df) for s in specs if (df := FS.read_source(spark, s)) is not None}
    if not present:
        raise ValueError("no landed source found")
    audit = None
    cleaned = {}
    for name, (spec, raw) in present.items():
        cleaned[name] = materialize(C.clean_source(raw, spec), f"clean-{name}")
        a = C.cleaning_audit(raw, spec)
        audit = a if audit is None else audit.unionByName(a)
    frames = TR.transform_sources([(present[n][0], df) for n, df in cleaned.items()])
    merged = materialize(MG.merge_sources(frames, ranks={s.name: s.rank for s, _ in present.values()}), "merged")
    wh = WH.build_warehouse(merged)
    lines = R.realign_years(R.positive_sales(WH.star_join_rfm(wh)))
    rfm = R.rfm(lines).withColumn("Monetary", F.col("Monetary").cast("double"))
    model = CU.fit_segmentation(FE.remove_outliers(rfm), k=k, n_init=n_init)
    labeled = materialize(CU.label_customers(model, rfm, names=tiers), "labeled")
    outputs = {}
    if out_dir:
        base = out_dir.rstrip("/")
        writes = {
            "cleaning_audit": audit, "merged": merged, **{n: t for n, t in wh.tables().items()},
            "rfm": rfm, "data_labeled": labeled.drop("features", *SCALED),
            "data_scaled": labeled.select("customer_id", *SCALED),
            "segment_profile": RP.segment_profile(labeled),
            "segment_ids": RP.segment_groups(labeled, "Segment"),
        }
        for name, df in writes.items():
            path = f"{base}/{name}"
            if name == "segment_ids":
                FS.write_groups(df, path, ["segment_group"])
            else:
                FS.write_stage(df, path)
            outputs[name] = path
        CU.save_model(model, f"{base}/model")
        outputs["model"] = f"{base}/model"
    return PipelineResult(audit, merged, wh, rfm, labeled, outputs)
